"""Problem 8: garbled text from wrong character encoding.

A null text is no case. An empty text has no span. Texts are processed whole, whatever their length. Rows with the same
key give one row of p8_found. Extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvida.llm import mojibake
from corvida.session import table

RESULT = T.StructType(
    [
        T.StructField("garbled", T.BooleanType()),
        T.StructField("restored", T.StringType()),
        T.StructField("spans", T.IntegerType()),
        T.StructField("lost", T.IntegerType()),
        T.StructField("pages", T.StringType()),
    ]
)


@F.pandas_udf(RESULT)
def repaired(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        if not text or not mojibake.may_be_garbled(text):
            rows.append((False, None, 0, 0, None))
            continue
        r = mojibake.repair(text)
        rows.append((r.garbled, r.text, r.spans, r.lost, ", ".join(r.pages)))
    return pd.DataFrame(rows, columns=["garbled", "restored", "spans", "lost", "pages"])


def garbled_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, restored, spans, lost, pages) of the documents with at least one garbled or lost span."""
    texts = docs.select(F.col(key), F.col(text).alias("text")).where("text is not null")
    return texts.withColumn("r", repaired.asNondeterministic()("text")).where("r.garbled").select(key, "r.restored", "r.spans", "r.lost", "r.pages")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled_documents(table(spark, sf_dir, "documents")).select("doc_id").distinct()


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each garbled document with its restored text, the number of spans decoded and lost, and the pages involved."""
    return garbled_documents(table(spark, sf_dir, "documents"))


QUERIES = {"p8_found": p8_found, "p8_restored": p8_restored}
SQL: dict[str, str] = {}
