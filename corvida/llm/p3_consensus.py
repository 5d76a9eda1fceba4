"""Problem 3: consensus from several annotators' labels.

The counting vote of an annotator on a sample is the one with the latest voted_at; of equal times the highest vote_id
counts, and a vote without a time comes before all others. If it is unreadable or null, the annotator has no counting
vote there. Votes without sample or annotator are left out. Exact repeats change nothing. A draft that is null cannot
be the right one; of a sample that is not in the table any label may be right. Extra columns are ignored.

The labels name drafts, and how far these lie from each other tells most of their errors. So the drafts have a vote on
each sample too: for the one with the fewest errors, or for none. They vote under a few names by how clear the case is,
and how far a name is to be trusted is fitted with the annotators. A name must stand for all labels: one that always
says "none" would be a guesser to the fit. Counts and agreement are those of the annotators alone. Samples with under
three drafts, or with two equally good ones, get no such vote.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvida.llm import truth_mixture
from corvida.llm.draft_errors import errors
from corvida.session import checkpointed, table

LABELS = ("google", "internal", "phowhisper", "rover", "none")
DRAFTS = tuple(f"asr_{name}" for name in LABELS if name != "none")
LEAST_VOTES = 3
#: From so many wrong words on, the drafts' own vote is that none will do.
NONE_FROM = 3.0
#: The names are by whole words that would have to be wrong for another label, from this on one name. They begin with a
#: sign that no annotator's has.
CLEAR, DRAFTS_NAME = 2, "\u0001drafts"


def readable(label: Column) -> Column:
    """The index in LABELS that a spelling stands for; null when it is unreadable."""
    letters = F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z]", ""), "^asr", "")
    letters = F.regexp_replace(letters, "^noneofthem$", "none")
    return F.coalesce(*(F.when(letters == name, i) for i, name in enumerate(LABELS)))


def counting_votes(votes: DataFrame) -> DataFrame:
    """(item, annotator, label) with one row for each readable counting vote."""
    latest = F.max_by(F.struct("label"), F.struct("voted_at", "vote_id", "label"))["label"]
    last = votes.where("sample_id is not null and annotator_id is not null").groupBy("sample_id", "annotator_id").agg(latest.alias("label"))
    return last.select(F.col("sample_id").alias("item"), F.col("annotator_id").alias("annotator"), readable(F.col("label")).alias("label")).where("label is not null")


def barred_labels(samples: DataFrame) -> DataFrame:
    """(item, barred): a bit for each label that names a draft the sample does not have. Repeated rows count once."""
    bits = sum((F.when(F.col(f"asr_{name}").isNull(), 1 << i).otherwise(0) for i, name in enumerate(LABELS) if name != "none"), F.lit(0))
    return samples.where("id is not null").groupBy(F.col("id").alias("item")).agg(F.bit_and(bits).alias("barred"))


def votes_by_item(votes: DataFrame, barred: DataFrame) -> DataFrame:
    """(item, votes, barred): an item has one vote of an annotator at most, so an array is no longer than there are annotators."""
    grouped = votes.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("annotator", "label"))).alias("votes"))
    return grouped.join(barred, "item", "left").select("item", "votes", F.coalesce("barred", F.lit(0)).alias("barred"))


def vote_of_drafts(drafts: list[str | None]) -> tuple[str, int] | None:
    """The name and label under which the drafts of a sample vote."""
    ranked = sorted((e, i) for i, e in enumerate(errors(drafts)) if e is not None)
    if not ranked:
        return None
    (fewest, label), lead = ranked[0], ranked[1][0] - ranked[0][0]
    if fewest >= NONE_FROM:
        label, clear = LABELS.index("none"), fewest - NONE_FROM
    elif lead:
        clear = min(lead, NONE_FROM - fewest)
    else:
        return None
    return f"{DRAFTS_NAME} {min(int(clear), CLEAR)}", label


def votes_of_drafts(samples: DataFrame, items: DataFrame) -> DataFrame:
    """(item, own struct<annotator, label>) of the items; of a sample written again the latest row counts."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [vote_of_drafts([t if isinstance(t, str) else None for t in drafts]) for drafts in zip(*(batch[c] for c in DRAFTS))]
            names, labels = ([v and v[k] for v in found] for k in range(2))
            yield pd.DataFrame({"item": batch["id"], "updated_at": batch["updated_at"], "annotator": pd.Series(names, dtype=object), "label": pd.array(labels, "Int32")})

    voted = samples.select("id", "updated_at", *DRAFTS).join(items.select(F.col("item").alias("id")), "id", "left_semi")
    found = voted.mapInPandas(vote, "item string, updated_at timestamp, annotator string, label int")
    return found.groupBy("item").agg(F.max(F.struct("updated_at", F.struct("annotator", "label").alias("own")))["own"].alias("own")).where("own.annotator is not null")


def with_drafts(items: DataFrame, drafts: DataFrame) -> DataFrame:
    """The items with the votes of their drafts behind those of the annotators."""
    votes = F.when(F.col("own").isNull(), F.col("votes")).otherwise(F.concat("votes", F.array("own")))
    return items.join(drafts, "item", "left").select("item", votes.alias("votes"), "barred")


def _fitted(spark: SparkSession, sf_dir: str):
    """All votes, those that are no copies of others with the drafts' votes, and the fit on these."""
    samples = table(spark, sf_dir, "samples")
    items = checkpointed(votes_by_item(counting_votes(table(spark, sf_dir, "draft_votes")), barred_labels(samples.select("id", *DRAFTS))))
    drafts = checkpointed(votes_of_drafts(samples, items))
    rough = truth_mixture.fit(with_drafts(items, drafts), len(LABELS), truth_mixture.ROUGH)
    own = checkpointed(with_drafts(truth_mixture.without_copies(items, rough), drafts))
    return items, own, truth_mixture.fit(own, len(LABELS))


def p3_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consensus of every voted sample with its confidence, votes and agreement (share of agreeing pairs of votes)."""
    found = truth_mixture.consensus(*_fitted(spark, sf_dir), LABELS)
    return found.select(F.col("item").alias("sample_id"), "label", F.round("confidence", 6).alias("confidence"), "votes", F.round("agreement", 6).alias("agreement"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_consensus(spark, sf_dir).where(F.col("votes") >= LEAST_VOTES).select("sample_id", "label")


def p3_annotators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reliability of each annotator: trust, the share of copied votes, labels mixed up, and the distribution of guesses."""
    return truth_mixture.annotators(*_fitted(spark, sf_dir), LABELS)


QUERIES = {"p3_found": p3_found, "p3_consensus": p3_consensus, "p3_annotators": p3_annotators}
SQL: dict[str, str] = {}
