"""Problem 1: text cut off by field limits or in transfer.

The self-join is by recording: `copies_by_recording` keeps, of each kind of transcript, the longest copy, so that what
a value is held against is bounded by the number of kinds however often a recording was transcribed (the warm-up clip
may hold a third of all rows). The join back to the values is on the recording; adaptive execution splits a hot one.

Null texts (failed calls) are no cases. An empty text, or one of signs only, ends nowhere and is no case. Repeated rows
of a record give one row. A recording with a single transcript has no copy, and nothing can be told. Extra columns are
ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvida.llm.prefix_cut import LEAST_GAP, cut_of
from corvida.session import table

#: The fields of a sample with the kind of transcript they hold; a model's answers are of the same kind as its field.
SAMPLE_KINDS = {"asr_google": "google", "asr_internal": "internal", "asr_phowhisper": "phowhisper", "asr_rover": "rover", "final_asr_text": "final"}
MODEL_KINDS = {"chirp3": "google", "internal_whisper": "internal", "phowhisper": "phowhisper"}


def transcripts(samples: DataFrame, results: DataFrame) -> DataFrame:
    """(recording, kind, table_name, record_key, origin, text): one row for each stored transcript."""
    fields = F.array(
        *(F.struct(F.lit(kind).alias("kind"), F.col(f).alias("text"), F.lit(f == "asr_phowhisper").alias("checked")) for f, kind in SAMPLE_KINDS.items())
    )
    of_samples = samples.select(
        F.regexp_replace("id", "::", "/").alias("recording"), F.col("id").alias("record_key"), F.col("source_dataset").alias("origin"), F.explode(fields).alias("v")
    ).select("recording", "v.kind", F.lit("samples").alias("table_name"), "record_key", "origin", "v.text", "v.checked")
    kind = F.coalesce(*(F.when(F.col("model_name") == m, k) for m, k in MODEL_KINDS.items()), F.col("model_name"))
    of_results = results.select(
        F.col("audio_relpath").alias("recording"), kind.alias("kind"), F.lit("asr_results").alias("table_name"),
        F.col("result_id").cast("string").alias("record_key"), F.col("model_name").alias("origin"), "text", F.lit(True).alias("checked"),
    )
    return of_samples.unionByName(of_results).where("text is not null and recording is not null")


def copies_by_recording(values: DataFrame) -> DataFrame:
    """(recording, copies): the longest transcript of each kind. Combined before the shuffle."""
    longest = values.groupBy("recording", "kind").agg(F.max_by("text", F.struct(F.length("text"), F.col("text"))).alias("text"))
    return longest.groupBy("recording").agg(F.sort_array(F.collect_list("text")).alias("copies"))


GAP = T.StructType([T.StructField("missing", T.IntegerType()), T.StructField("prefix", T.BooleanType())])


@F.pandas_udf(GAP)
def letters_missing(texts: pd.Series, copies: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([cut_of(t, list(c)) for t, c in zip(texts, copies)], columns=["missing", "prefix"]).astype({"missing": "int32", "prefix": bool})


def cut_values(values: DataFrame) -> DataFrame:
    """The checked transcripts with `missing`, the letters of speech behind their end: 0 for whole ones; and `prefix`,
    whether a copy goes on letter for letter."""
    checked = values.where("checked").drop("checked", "kind")
    return checked.join(copies_by_recording(values), "recording").withColumn("gap", letters_missing.asNondeterministic()("text", "copies")).select("*", "gap.*").drop("copies", "gap")


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts(table(spark, sf_dir, "samples"), table(spark, sf_dir, "asr_results"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_values(_values(spark, sf_dir)).where(F.col("missing") >= LEAST_GAP).select("table_name", "record_key").distinct()


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source_dataset and each model_name, how many of its transcripts are cut, and how many of these are strict
    prefixes of a copy. Repeated rows count once."""
    records = cut_values(_values(spark, sf_dir)).groupBy("table_name", "origin", "record_key").agg(F.max(F.struct("missing", "prefix")).alias("gap")).select("*", "gap.*")
    cut = F.count_if(F.col("missing") >= LEAST_GAP)
    return records.groupBy("table_name", "origin").agg(
        F.count("*").alias("transcripts"), cut.alias("cut"), F.count_if((F.col("missing") >= LEAST_GAP) & F.col("prefix")).alias("prefixes"), F.round(cut / F.count("*"), 6).alias("share")
    )


QUERIES = {"p1_found": p1_found, "p1_shares": p1_shares}
SQL: dict[str, str] = {}
