"""Problem 7: mixing sources to target weights.

Every document gets a hash-random key; within a source documents are ranged by it, token counts are summed up along
that order in a distributed way (sums of key ranges first, then within each range), and the source is cut where its
budget ends. A source whose budget exceeds its tokens is used in whole epochs first, max_repeats at most; the last
epoch is cut. The cut is at the document that brings the sum nearest to the budget, so a source misses its budget by
half a document at most, unless its cap or lack of documents ends it sooner; the shares reached are reported.

Null and empty texts have no tokens and are never drawn. Documents without a source count in the total that
size_factor refers to, but no mix can name them. A source that a mix names and that is absent reaches 0. Copies of a
document under another id are documents of their own. Repeated rows of a target count once. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvida.session import checkpointed, table

#: Session setting that names the vocabulary file, and where it lies by default.
TOKENIZER_SETTING, TOKENIZER_FILE = "spark.corvida.tokenizer", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public word pattern of byte-level vocabularies of this family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents in one range of keys, about; a range of one source is summed up in one task.
RANGE_DOCUMENTS = 50_000
SEED = 7


def token_counter(path: str):
    """A UDF from a text to its number of tokens. The vocabulary is read by each worker from its path."""

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield texts.map(lambda t: len(encoding.encode_ordinary(t)) if t else 0)

    return tokens


def counted(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, source, key, tokens): what mixing needs of each document; texts are read once and not kept."""
    key = F.xxhash64(F.lit(SEED), "doc_id")
    return checkpointed(docs.select("doc_id", "source", key.alias("key"), token_counter(path)(F.coalesce("text", F.lit(""))).alias("tokens")))


def prefix_sums(docs: DataFrame) -> DataFrame:
    """The documents of each source with `before`, the tokens of the source's documents with smaller keys."""
    ranges = max(1, math.ceil(docs.count() / RANGE_DOCUMENTS))
    ranged = docs.where("source is not null and tokens > 0").withColumn("range", F.floor((F.col("key") / F.lit(2.0**64) + 0.5) * ranges).cast("long"))
    sums = ranged.groupBy("source", "range").agg(F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "range", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(offsets, ["source", "range"]).withColumn("before", F.col("offset") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).drop("range", "offset")


def budgets(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, budget, available, epochs, rest): whole epochs and tokens of the cut one."""
    total = docs.agg(F.sum("tokens")).first()[0] or 0
    available = docs.where("source is not null").groupBy("source").agg(F.sum("tokens").alias("available"))
    wanted = targets.select("mix_name", "source", "target_share", "max_repeats", "size_factor").distinct()
    wanted = wanted.withColumn("budget", F.col("target_share") * F.col("size_factor") * F.lit(float(total)))
    wanted = wanted.join(available, "source", "left").fillna(0, ["available"])
    capped = F.least("budget", F.when(F.col("max_repeats").isNotNull(), F.col("available") * F.col("max_repeats")).otherwise(F.col("budget")))
    used = F.when(F.col("available") > 0, capped).otherwise(0.0)
    epochs = F.when(F.col("available") > 0, F.floor(used / F.col("available"))).otherwise(0)
    return wanted.withColumn("epochs", epochs).withColumn("rest", used - F.col("epochs") * F.col("available")).select(
        "mix_name", "source", "target_share", "budget", "available", "epochs", "rest"
    )


def mixed(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, doc_id, tokens, copies) of the drawn documents."""
    plan = budgets(docs, targets)
    more = (F.col("before") + F.col("tokens") / 2 <= F.col("rest")).cast("int")
    return prefix_sums(docs).join(plan, "source").withColumn("copies", (F.col("epochs") + more).cast("int")).where("copies > 0").select("mix_name", "source", "doc_id", "tokens", "copies")


def shares(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, budget_tokens, tokens, share, most_copies): the shares that the mixes reach."""
    reached = mixed(docs, targets).groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    rows = budgets(docs, targets).join(reached, ["mix_name", "source"], "left").fillna(0, ["tokens", "most_copies"])
    whole = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return rows.select(
        "mix_name", "source", "target_share", F.round("budget").cast("long").alias("budget_tokens"), "tokens",
        F.round(F.when(whole > 0, F.col("tokens") / whole).otherwise(0.0), 6).alias("share"), "most_copies",
    )


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = spark.conf.get(TOKENIZER_SETTING, TOKENIZER_FILE)
    return counted(table(spark, sf_dir, "documents"), path), table(spark, sf_dir, "mix_targets")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(*_inputs(spark, sf_dir))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(*_inputs(spark, sf_dir))


QUERIES = {"p7_mix": p7_mix, "p7_shares": p7_shares}
SQL: dict[str, str] = {}
