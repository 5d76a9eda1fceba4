"""Problem 5: visually identical text with different characters.

Null and empty values are in form. A text of any length is one value. Repeated rows of a record give one row. Extra
columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corvida.llm.lookalike_transducer import TRIGGER, canonical
from corvida.session import table

FIELDS = ("asr_google", "asr_internal", "asr_phowhisper", "final_asr_text")


@F.pandas_udf(StringType())
def canonical_text(values: pd.Series) -> pd.Series:
    return values.map(canonical, na_action="ignore")


def in_one_form(value: Column) -> Column:
    """The value in its one form; only values that hold a character of the mapping go through the transducer."""
    return F.when(value.rlike(TRIGGER), canonical_text(value)).otherwise(value)


def long_values(df: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """(key, field_name, value) with one row for each non-null value."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields))
    return df.select(F.col(key), F.explode(pairs).alias("pair")).select(key, "pair.field_name", "pair.value").where("value is not null")


def not_in_form(df: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """(key, field_name, value, canonical) of the values that their one form differs from.

    The filter on the characters of the mapping runs in the JVM, so that only values that may change reach Python.
    """
    suspects = long_values(df, key, fields).where(F.col("value").rlike(TRIGGER))
    return suspects.withColumn("canonical", canonical_text("value")).where("canonical <> value")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = not_in_form(table(spark, sf_dir, "samples"), "id", FIELDS)
    return found.select(F.col("id").alias("sample_id"), "field_name").distinct()


def p5_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the four fields in its one form, with a mark on those that changed."""
    values = long_values(table(spark, sf_dir, "samples"), "id", FIELDS).withColumn("canonical", in_one_form(F.col("value")))
    return values.select(F.col("id").alias("sample_id"), "field_name", "canonical", (F.col("canonical") != F.col("value")).alias("changed")).distinct()


QUERIES = {"p5_found": p5_found, "p5_canonical": p5_canonical}
SQL: dict[str, str] = {}
