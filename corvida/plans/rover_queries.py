"""Queries of transcript voting: weights, alignment and the voted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvida.functions import text as T
from corvida.operators import rover as R
from corvida.operators.tables import wins
from corvida.plans.text_queries import norm_sql
from corvida.session import table

#: Voters in fixed order with the factor on their confidence; without a confidence a voter weighs 0.5.
VOTERS = (("chirp3", 1.0), ("internal_whisper", 1.15), ("phowhisper", 1.0))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last successful answer of each voter for each recording; failed ones are left out, empty texts are not."""
    rows = table(spark, sf_dir, "asr_results").where("error is null and text is not null")
    return wins(rows.select("audio_relpath", "model_name", "text", "confidence", "loaded_at", "result_id"), ["audio_relpath", "model_name"], ["loaded_at", "result_id"])


def _weighted(spark, sf_dir) -> DataFrame:
    factor = F.coalesce(*(F.when(F.col("model_name") == m, w) for m, w in VOTERS), F.lit(1.0))
    order = F.coalesce(*(F.when(F.col("model_name") == m, i) for i, (m, _) in enumerate(VOTERS)), F.lit(len(VOTERS)))
    return _answers(spark, sf_dir).select("audio_relpath", "model_name", order.alias("ord"), F.round(F.coalesce("confidence", F.lit(0.5)) * factor, 9).alias("weight"), T.normalized(F.col("text")).alias("text"))


def rover_weights(spark, sf_dir):
    return _weighted(spark, sf_dir).select("audio_relpath", "model_name", F.round("weight", 6).alias("weight"), F.md5("text").alias("digest"))


def _networks(spark, sf_dir) -> DataFrame:
    item = F.struct("ord", T.words(F.col("text")).alias("words"), "weight")
    gathered = _weighted(spark, sf_dir).groupBy("audio_relpath").agg(F.array_sort(F.collect_list(item)).alias("voters"))
    return gathered.withColumn("network", R.aligned.asNondeterministic()("voters"))


def rover_align(spark, sf_dir):
    return _networks(spark, sf_dir).select("audio_relpath", F.size("network").cast("bigint").alias("columns"), R.voted_text(F.col("network")).alias("text"))


def rover_single_voter(spark, sf_dir):
    """Recordings with one voter: the voted text is that voter's own."""
    nets = _networks(spark, sf_dir).where("size(voters) = 1")
    return nets.select("audio_relpath", F.md5(R.voted_text(F.col("network"))).alias("digest"))


QUERIES = {f.__name__: f for f in (rover_weights, rover_align, rover_single_voter)}
_ANSWERS = """(select * from asr_results where error is null and text is not null
qualify row_number() over (partition by audio_relpath, model_name order by loaded_at desc nulls last, result_id desc) = 1)"""
SQL = {
    "rover_weights": f"""select audio_relpath, model_name, round(coalesce(confidence, 0.5) * case when model_name = 'internal_whisper' then 1.15 else 1.0 end, 6) weight, md5({norm_sql('text')}) digest from {_ANSWERS}""",
    "rover_single_voter": f"select audio_relpath, md5({norm_sql('max(text)')}) digest from {_ANSWERS} group by audio_relpath having count(*) = 1",
}
