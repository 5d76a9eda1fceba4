"""Problem 4: missing or wrong language labels, and texts of several languages.

A null text is no case; a text without a word of any language has none and gives no row. A null, blank or unreadable
label is missing. Repeated rows of a record give one row for each language. Without labelled documents only languages
with their own script are told apart, and all else counts as the expected one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvida.llm.langid import Identifier, fit_profiles
from corvida.session import table

EXPECTED = "vi"
# Names and codes by which labels spell a language, before any region.
SPELLINGS = {
    "vi": "vi vie vietnamese vietnam tiếng_việt việt",
    "en": "en eng english",
    "de": "de deu ger german deutsch",
    "es": "es spa spanish español castilian",
    "fr": "fr fra fre french français",
    "id": "id in ind indonesian bahasa",
    "ja": "ja jp jpn japanese 日本語",
    "ko": "ko kr kor korean 한국어",
    "pt": "pt por portuguese português",
    "zh": "zh zho chi cmn yue cn chinese mandarin 中文 汉语",
}

STRETCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("lang", T.StringType()),
            T.StructField("confidence", T.DoubleType()),
        ]
    )
)


def label_language(label: Column) -> Column:
    """The language that a label names; null when it names none."""
    cleaned = F.regexp_replace(F.lower(F.trim(label)), r"\s+", "_")
    head = F.regexp_extract(cleaned, r"^([^-_.(]+)", 1)
    codes = {spelling: code for code, names in SPELLINGS.items() for spelling in names.split()}
    lookup = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))
    return F.coalesce(lookup[cleaned], lookup[head])


def divided(profiles: dict[str, dict[str, int]], expected: str = EXPECTED):
    """A UDF from a text to its stretches of one language each."""

    @F.pandas_udf(STRETCHES)
    def stretches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        identifier = Identifier(profiles, expected)
        for texts in batches:
            yield texts.map(lambda t: [(s.start, s.end, s.lang, s.confidence) for s in identifier.stretches(t)])

    return stretches.asNondeterministic()  # so that a filter on it does not make Spark call it twice


def labelled_texts(samples: DataFrame, results: DataFrame) -> DataFrame:
    """(table_name, record_key, text, label): samples carry no label, as they are meant to be Vietnamese."""
    return samples.select(
        F.lit("samples").alias("table_name"), F.col("id").alias("record_key"), F.col("asr_rover").alias("text"), F.lit(EXPECTED).alias("label")
    ).unionByName(
        results.select(
            F.lit("asr_results").alias("table_name"), F.col("result_id").cast("string").alias("record_key"), "text",
            label_language(F.col("detected_language")).alias("label"),
        )
    ).where("text is not null")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled texts with `stretches` and `langs`, the distinct languages in them."""
    profiles = fit_profiles(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    texts = labelled_texts(table(spark, sf_dir, "samples"), table(spark, sf_dir, "asr_results"))
    return texts.withColumn("stretches", divided(profiles)("text")).withColumn("langs", F.array_distinct("stretches.lang"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = (F.size("langs") == 1) & (F.get("langs", F.lit(0)) == F.col("label"))
    cases = languages(spark, sf_dir).where(~F.coalesce(right, F.lit(False)))
    return cases.select("table_name", "record_key", F.explode("langs").alias("lang")).distinct()


def p4_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stretch of each text with its language and confidence; positions count code points from 0."""
    found = languages(spark, sf_dir).select("table_name", "record_key", F.posexplode("stretches").alias("position", "s"))
    return found.select("table_name", "record_key", "position", "s.start", "s.end", "s.lang", "s.confidence").distinct()


QUERIES = {"p4_found": p4_found, "p4_stretches": p4_stretches}
SQL: dict[str, str] = {}
