"""Problem 2: broken prompt and response pairs.

A null prompt or response, or a missing key, is no pair; an empty one is a pair and its response empty. Repeated rows
of a record give one row. Of a unit that was written again with other content each response counts. Without pairs to
learn from, no response is long enough to be called cut unless it leaves something open. Extra columns are ignored.

Renderings are learned from all pairs of a direction, in groups of about GROUP by the hash of their key, so the same ones
whatever the partitions: each is fitted by one task, letters are the mean of the groups by the weight of the pairs that
have the feature, and endings are counts over all. Only responses of under eight characters are not learned from, as
most of them stand for nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvida.llm.langid import Identifier, fit_profiles
from corvida.llm.pair_defects import LEAST_SEEN, Rendering, defect, fit_part, rendering
from corvida.session import table

#: Pairs that are fitted together, about.
GROUP = 12_000


def pairs(samples: DataFrame, units: DataFrame, results: DataFrame) -> DataFrame:
    """(table_name, record_key, field_name, expected, prompt, response, question_response)."""
    none = F.lit(None).cast("string")
    speech = samples.select(
        F.lit("samples").alias("table_name"), F.col("id").alias("record_key"), F.lit("mt_en").alias("field_name"), F.lit("en").alias("expected"),
        F.col("asr_rover").alias("prompt"), F.col("mt_en").alias("response"), none.alias("question_response"),
    )
    prompts = units.select("sample_index", F.explode("fields").alias("field_name", "prompt"))
    answers = results.select("sample_index", F.col("attempted_fields")["question"].alias("question"), F.explode("attempted_fields").alias("field_name", "response"))
    texts = prompts.join(answers, ["sample_index", "field_name"]).select(
        F.lit("translation_results").alias("table_name"), F.col("sample_index").cast("string").alias("record_key"), "field_name", F.lit("vi").alias("expected"),
        "prompt", "response", F.when(F.col("field_name") == "answer", F.col("question")).alias("question_response"),
    )
    return speech.unionByName(texts).where("prompt is not null and response is not null").distinct()


def _parts(batch: pd.DataFrame) -> pd.DataFrame:
    """The part of one group: a row for each prompt feature and each ending."""
    rows = batch.sort_values(["record_key", "field_name", "prompt", "response"])
    part = fit_part(list(zip(rows["prompt"], rows["response"])))
    keys = [(kind, key) for kind, found in (("letters", part.letters), ("ends", part.ends)) for key in found]
    first, second = ([key if isinstance(key, str) else key[0] for _, key in keys], [None if isinstance(key, str) else key[1] for _, key in keys])
    sums = pd.DataFrame([*part.letters.values(), *part.ends.values()], columns=["x", "y"], dtype=float)
    return sums.assign(expected=batch["expected"].iloc[0], kind=[kind for kind, _ in keys], first=first, second=pd.Series(second, dtype=object))


def learned(all_pairs: DataFrame, group: int = GROUP) -> dict[str, Rendering]:
    """The rendering of each expected language. As many rows reach the driver as there are features."""
    sizes = {r["expected"]: r["count"] for r in all_pairs.groupBy("expected").count().collect()}
    groups = F.coalesce(*(F.when(F.col("expected") == e, F.lit(-(-n // group))) for e, n in sizes.items()), F.lit(1))
    rows = all_pairs.where(F.length("response") >= 8).withColumn("group", F.pmod(F.xxhash64("record_key", "field_name"), groups))
    parts = rows.groupBy("expected", "group").applyInPandas(_parts, "expected string, kind string, first string, second string, x double, y double")
    sums = parts.groupBy("expected", "kind", "first", "second").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).where((F.col("kind") == "letters") | (F.col("x") >= LEAST_SEEN))
    found: dict[str, dict[str, dict]] = {e: {"letters": {}, "ends": {}} for e in sizes}
    for expected, kind, first, second, x, y in zip(*sums.toArrow().to_pydict().values()):
        found[expected][kind][first if second is None else (first, second)] = (x, y)
    return {e: rendering(**sums) for e, sums in found.items()}


def with_defects(all_pairs: DataFrame, profiles: dict[str, dict[str, int]]) -> DataFrame:
    """The pairs with `defect`, null for usable responses."""
    renderings = learned(all_pairs)

    @F.pandas_udf("string")
    def find(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        identifiers = {e: Identifier(profiles, e) for e in renderings}
        for prompts, responses, questions, expected in batches:
            yield pd.Series([defect(p, r, q, e, identifiers[e], renderings[e]) for p, r, q, e in zip(prompts, responses, questions, expected)], dtype=object)

    return all_pairs.withColumn("defect", find.asNondeterministic()("prompt", "response", "question_response", "expected"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("samples", "translation_units", "translation_results")
    profiles = fit_profiles(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return with_defects(pairs(*(table(spark, sf_dir, n) for n in names)), profiles)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).where("defect is not null").select("table_name", "record_key", "field_name", "defect").distinct()


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pairs of each field have each defect; usable ones count as 'none'."""
    kind = F.coalesce("defect", F.lit("none"))
    return _pairs(spark, sf_dir).groupBy("table_name", "field_name", kind.alias("defect")).agg(F.count("*").alias("pairs"))


QUERIES = {"p2_found": p2_found, "p2_rates": p2_rates}
SQL: dict[str, str] = {}
