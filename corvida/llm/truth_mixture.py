"""Consensus of labels by a competence-and-spamming mixture, fitted with expectation-maximisation.

Each label is either truthful (with the annotator's trust) or a guess from the annotator's own distribution. Two habits
would bend the fit, so they are part of it. An annotator may mix labels up always in the same way: the truthful label
passes through the annotator's `reading`, an exchange of labels, which is only assumed where the votes show it. And an
annotator may repeat another's votes: `without_copies` leaves such votes out, as they are no evidence of their own.

An item is (item, votes array<struct<annotator string, label int>>, barred int): at most one vote of an annotator, and
a bit set for each label that the item cannot have. The expectation step runs where the votes are. The parameters are
one vector for each annotator; up to MAX_LOCAL annotators they go with the tasks, beyond that they stay a table that is
joined to the votes and written to the checkpoint folder after each step. Both ways give the same fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvida.session import checkpointed

MAX_LOCAL, ITEMS_A_TASK = 100_000, 200_000
#: The fit ends when a step raises the log-likelihood by less than this share of it. The rough fit is for finding copies.
TOLERANCE, ROUGH = 1e-6, 1e-4
SMOOTHING = 0.1
FIRST_TRUST = 0.7
#: Steps with every label read as it stands, before exchanged labels are looked for.
STEPS_AS_READ = 3
#: An exchange of two labels is assumed where its votes outnumber those of the plain reading by so many deviations.
EXCHANGE_DEVIATIONS = 3.0
#: What is left of the probability of a barred label.
BARRED = 1e-6
#: Two annotators depend on each other if, on so many shared items at least, they give so large a share of equal labels,
#: and so many deviations more than their trusts and guesses explain.
LEAST_SHARED, LEAST_EQUAL, LEAST_EXCESS = 20, 0.9, 4.0

ITEMS = "item string, votes array<struct<annotator: string, label: int>>, barred int"


@dataclass(frozen=True)
class Parameters:
    """By annotator: trust, guess[label], and reading[true label], the label that a truthful vote gives."""

    trust: np.ndarray
    guess: np.ndarray
    reading: np.ndarray

    @staticmethod
    def first(annotators: int, labels: int) -> Parameters:
        return Parameters(np.full(annotators, FIRST_TRUST), np.full((annotators, labels), 1 / labels), np.tile(np.arange(labels), (annotators, 1)))

    def emissions(self) -> np.ndarray:
        """[annotator, true label, label]: the probability of a vote."""
        found = np.repeat(((1 - self.trust)[:, None] * self.guess)[:, None, :], self.guess.shape[1], axis=1)
        at = np.arange(len(self.trust))[:, None], np.arange(self.guess.shape[1])[None, :], self.reading
        found[at] += self.trust[:, None]
        return found

    def updated(self, counts: np.ndarray, exchange: bool) -> Parameters:
        """The maximisation step: counts[annotator, true label, label] are the expected votes."""
        labels = self.guess.shape[1]
        reading = _readings(counts) if exchange else self.reading
        at = np.arange(len(counts))[:, None], np.arange(labels)[None, :], reading
        guessing = ((1 - self.trust)[:, None] * self.guess)[np.arange(len(counts))[:, None], reading]
        meant = counts[at] * (self.trust[:, None] / np.maximum(self.trust[:, None] + guessing, 1e-300))
        rest = counts.copy()
        rest[at] -= meant
        guessed, truth = rest.sum(axis=1), meant.sum(axis=1)
        trust = (truth + SMOOTHING) / (truth + guessed.sum(axis=1) + 2 * SMOOTHING)
        return Parameters(trust, (guessed + SMOOTHING) / (guessed + SMOOTHING).sum(axis=1, keepdims=True), reading)


def _readings(counts: np.ndarray) -> np.ndarray:
    """The labels exchanged pair by pair, the best exchange first, as long as the counts speak for one."""
    n, labels, _ = counts.shape
    reading, rows = np.tile(np.arange(labels), (n, 1)), np.arange(n)
    pairs = [(t, u) for t in range(labels) for u in range(t)]
    for _ in range(labels if pairs else 0):
        gains = np.empty((n, len(pairs)))
        for i, (t, u) in enumerate(pairs):
            a, b = reading[:, t], reading[:, u]
            plain, crossed = (counts[rows, t, a], counts[rows, u, b]), (counts[rows, t, b], counts[rows, u, a])
            both = (crossed[0] > plain[0]) & (crossed[1] > plain[1])
            gains[:, i] = np.where(both, sum(crossed) - sum(plain) - EXCHANGE_DEVIATIONS * np.sqrt(sum(crossed) + sum(plain)), -1.0)
        best = gains.argmax(axis=1)
        better = gains[rows, best] > 0
        if not better.any():
            break
        for i, (t, u) in enumerate(pairs):
            own = rows[better & (best == i)]
            reading[own, t], reading[own, u] = reading[own, u], reading[own, t]
    return reading


@dataclass(frozen=True)
class Fit:
    """names and parameters of the annotators, or the table (annotator, trust, guess, reading) beyond MAX_LOCAL."""

    names: list[str]
    parameters: Parameters | None
    table: DataFrame | None
    prior: tuple[float, ...]
    steps: int
    log_likelihood: float

    def as_table(self, spark: SparkSession) -> DataFrame:
        if self.table is not None:
            return self.table
        schema = "annotator string, trust double, guess array<double>, reading array<int>"
        p = self.parameters
        return spark.createDataFrame([(n, float(t), g.tolist(), r.tolist()) for n, t, g, r in zip(self.names, p.trust, p.guess, p.reading)], schema)


@dataclass
class Votes:
    """The votes of a batch of items as parallel arrays: item row, annotator index, label."""

    rows: np.ndarray
    who: np.ndarray
    what: np.ndarray
    barred: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, names: pa.Array) -> Votes:
        votes = batch.column("votes")
        flat = votes.flatten()
        who, what = (flat.field(k) if isinstance(flat, pa.StructArray) else None for k in range(2))
        lengths = pc.fill_null(pc.list_value_length(votes), 0).to_numpy(zero_copy_only=False)
        index = pc.index_in(who, value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
        return Votes(np.repeat(np.arange(len(lengths)), lengths), index, what.to_numpy(zero_copy_only=False).astype(np.int64), batch.column("barred").to_numpy(zero_copy_only=False))

    def posterior(self, emissions: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each item's distribution of the true label, and its log-likelihood."""
        n, labels = len(self.barred), len(prior)
        logs = np.log(prior)[None, :] + np.where((self.barred[:, None] >> np.arange(labels)) & 1, np.log(BARRED), 0.0)
        for t in range(labels):
            logs[:, t] += np.bincount(self.rows, np.log(emissions[self.who, t, self.what]), n)
        top = logs.max(axis=1, keepdims=True) if n else logs
        weights = np.exp(logs - top)
        sums = weights.sum(axis=1, keepdims=True)
        return weights / sums, (np.log(sums) + top).ravel()


def _local_step(items: DataFrame, names: list[str], parameters: Parameters, prior: np.ndarray):
    """One expectation step with the parameters in the tasks: the expected votes, labels and the log-likelihood."""
    k, n = len(prior), len(names)
    emissions = parameters.emissions()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, classes, likelihood, known = np.zeros(n * k * k), np.zeros(k), 0.0, pa.array(names, pa.string())
        for batch in batches:
            votes = Votes.of(batch, known)
            posterior, logs = votes.posterior(emissions, prior)
            for t in range(k):
                counts += np.bincount((votes.who * k + t) * k + votes.what, posterior[votes.rows, t], n * k * k)
            classes += posterior.sum(axis=0)
            likelihood += float(logs.sum())
        table = counts.reshape(n, k * k)
        seen = np.flatnonzero(table.sum(axis=1))
        last = np.zeros((1, k * k))
        last[0, :k] = classes
        values = np.concatenate([table[seen], last])
        columns = [pa.array(np.append(seen, -1)), pa.array(np.append(np.zeros(len(seen)), likelihood)), *(pa.array(values[:, i]) for i in range(k * k))]
        yield pa.RecordBatch.from_arrays(columns, ["who", "ll", *(f"c{i}" for i in range(k * k))])

    cells = [f"c{i}" for i in range(k * k)]
    found = items.mapInArrow(sums, "who long, ll double, " + ", ".join(f"{c} double" for c in cells))
    counts, classes, likelihood = np.zeros((n, k * k)), np.zeros(k), 0.0
    if (n + 1) * items.rdd.getNumPartitions() > MAX_LOCAL:
        found = found.groupBy("who").agg(F.sum("ll").alias("ll"), *(F.sum(c).alias(c) for c in cells))
    for row in found.collect():  # about MAX_LOCAL rows at most
        values = np.array([row[c] for c in cells])
        if row["who"] < 0:
            classes, likelihood = classes + values[:k], likelihood + row["ll"]
        else:
            counts[row["who"]] += values
    return counts.reshape(n, k, k), classes, likelihood


def _ended(likelihood: float | None, before: float, tolerance: float) -> bool:
    return not likelihood or abs(likelihood - before) <= tolerance * abs(likelihood)


def fit(items: DataFrame, labels: int, tolerance: float = TOLERANCE, max_local: int = MAX_LOCAL) -> Fit:
    """The fit on items as above, votes in any order."""
    tasks = max(items.sparkSession.sparkContext.defaultParallelism, items.count() // ITEMS_A_TASK)
    items = checkpointed(items.repartition(tasks))
    some = items.select(F.explode("votes.annotator").alias("a")).distinct().orderBy("a").limit(max_local + 1).collect()
    names = [r[0] for r in some]
    if len(names) > max_local:
        return fit_by_join(items, labels, tolerance)
    parameters, prior, before, steps, likelihood = Parameters.first(len(names), labels), np.full(labels, 1 / labels), -np.inf, 0, 0.0
    while names:
        counts, classes, likelihood = _local_step(items, names, parameters, prior)
        steps += 1
        parameters = parameters.updated(counts, steps > STEPS_AS_READ)
        prior = (classes + 1) / (classes.sum() + labels)
        if steps > STEPS_AS_READ + 1 and _ended(likelihood, before, tolerance):
            break
        before = likelihood
    return Fit(names, parameters, None, tuple(prior.tolist()), steps, likelihood)


def _exploded(items: DataFrame) -> DataFrame:
    return items.select("item", F.explode("votes").alias("v")).select("item", "v.annotator", "v.label")


def _posterior_by_join(items: DataFrame, params: DataFrame, prior: list[float]) -> DataFrame:
    """(item, ll, p array<double>)."""
    labels = range(len(prior))
    guessing = (1 - F.col("trust")) * F.get("guess", F.col("label"))
    terms = [F.log(guessing + F.when(F.get("reading", F.lit(t)) == F.col("label"), F.col("trust")).otherwise(0.0)) for t in labels]
    logs = _exploded(items).join(params, "annotator").groupBy("item").agg(*(F.sum(x).alias(f"l{t}") for t, x in zip(labels, terms)))
    barred = [F.when(F.getbit("barred", F.lit(t)) == 1, float(np.log(BARRED))).otherwise(0.0) for t in labels]
    logs = logs.join(items.select("item", "barred"), "item").select("item", *((F.col(f"l{t}") + barred[t] + float(np.log(prior[t]))).alias(f"l{t}") for t in labels))
    logs = logs.withColumn("top", F.greatest(*(F.col(f"l{t}") for t in labels)) if len(prior) > 1 else F.col("l0"))
    logs = logs.withColumn("sum", sum((F.exp(F.col(f"l{t}") - F.col("top")) for t in labels), F.lit(0.0)))
    return logs.select("item", (F.log("sum") + F.col("top")).alias("ll"), F.array(*(F.exp(F.col(f"l{t}") - F.col("top")) / F.col("sum") for t in labels)).alias("p"))


def fit_by_join(items: DataFrame, labels: int, tolerance: float = TOLERANCE) -> Fit:
    """The same fit with the parameters as a table, for any number of annotators."""
    schema = "annotator string, trust double, guess array<double>, reading array<int>"
    first = Parameters.first(1, labels)
    params = _exploded(items).select("annotator").distinct().select(
        "annotator", F.lit(FIRST_TRUST).alias("trust"), F.array(*map(F.lit, first.guess[0].tolist())).alias("guess"), F.array(*map(F.lit, range(labels))).alias("reading")
    )
    prior, before, steps, likelihood = [1 / labels] * labels, -np.inf, 0, 0.0
    while True:
        found = checkpointed(_posterior_by_join(items, params, prior))
        total = found.agg(F.sum("ll"), *(F.sum(F.get("p", F.lit(t))) for t in range(labels))).first()
        cells = [F.sum(F.when(F.col("label") == u, F.get("p", F.lit(t))).otherwise(0.0)) for t in range(labels) for u in range(labels)]
        counts = _exploded(items).join(found, "item").groupBy("annotator").agg(F.array(*cells).alias("counts")).join(params, "annotator")
        steps += 1

        def maximise(batches: Iterator[pd.DataFrame], exchange=steps > STEPS_AS_READ) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    old = Parameters(batch["trust"].to_numpy(), np.stack(batch["guess"]), np.stack(batch["reading"]))
                    new = old.updated(np.stack(batch["counts"]).reshape(-1, labels, labels), exchange)
                    yield pd.DataFrame({"annotator": batch["annotator"], "trust": new.trust, "guess": list(new.guess), "reading": list(new.reading)})

        params = checkpointed(counts.mapInPandas(maximise, schema))
        classes, likelihood = np.array([x or 0.0 for x in total[1:]]), total[0]
        prior = ((classes + 1) / (classes.sum() + labels)).tolist()
        if steps > STEPS_AS_READ + 1 and _ended(likelihood, before, tolerance) or likelihood is None:
            return Fit([], None, params, tuple(prior), steps, likelihood or 0.0)
        before = likelihood


def posteriors(items: DataFrame, fitted: Fit) -> DataFrame:
    """(item, p array<double>): each item's distribution of the true label."""
    if fitted.table is not None:
        return _posterior_by_join(items, fitted.table, list(fitted.prior)).select("item", "p")
    names, emissions, prior = fitted.names, fitted.parameters.emissions(), np.array(fitted.prior)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names, pa.string())
        for batch in batches:
            found, _ = Votes.of(batch, known).posterior(emissions, prior)
            p = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(prior), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("item"), p], ["item", "p"])

    return items.mapInArrow(decide, "item string, p array<double>")


def _pair_sums(rated: DataFrame) -> DataFrame:
    """(a, b, shared, equal, right_a, right_b) by pair of annotators a < b: summed up in the tasks before anything is sent.

    An item is held by one task and has one vote of an annotator at most.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = batch.column("rated")
            flat = votes.flatten()
            lengths = pc.fill_null(pc.list_value_length(votes), 0).to_numpy(zero_copy_only=False)
            if not len(flat):
                continue
            coded = flat.field(0).dictionary_encode()
            names, who = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            rank = np.argsort(np.argsort(np.array(names.to_pylist(), dtype=object)))
            label, right = (flat.field(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            rows, n = np.repeat(np.arange(len(lengths)), lengths), len(names)
            keys, parts = [], []
            for step in range(1, int(lengths.max())):
                i = np.flatnonzero(rows[step:] == rows[:-step])
                j = i + step
                i, j = np.where(rank[who[i]] < rank[who[j]], i, j), np.where(rank[who[i]] < rank[who[j]], j, i)
                keys.append(who[i] * n + who[j])
                parts.append(np.stack([np.ones(len(i)), label[i] == label[j], right[i], right[j]]))
                if sum(map(len, keys)) > 4_000_000:  # what is held at once
                    keys, parts = _combined(keys, parts)
            keys, parts = _combined(keys, parts) if keys else ([np.zeros(0, np.int64)], [np.zeros((4, 0))])
            a, b = np.divmod(keys[0], n)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), *map(pa.array, parts[0])], ["a", "b", "shared", "equal", "right_a", "right_b"])

    found = rated.mapInArrow(sums, "a string, b string, shared double, equal double, right_a double, right_b double")
    return found.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("shared", "equal", "right_a", "right_b")))


def _combined(keys: list[np.ndarray], parts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    values = np.concatenate(parts, axis=1)
    return [distinct], [np.stack([np.bincount(at, v, len(distinct)) for v in values])]


def _rated(items: DataFrame, fitted: Fit, params: DataFrame) -> DataFrame:
    """(item, rated array<struct<annotator, label, right>>): each vote with the chance that it is right."""
    read = F.array_position("reading", F.col("v.label")).cast("int") - 1
    votes = items.join(posteriors(items, fitted), "item").select("item", "p", F.explode("votes").alias("v")).withColumn("annotator", F.col("v.annotator"))
    votes = votes.join(params.select("annotator", "reading"), "annotator").withColumn("right", F.get("p", read))
    return votes.groupBy("item").agg(F.collect_list(F.struct("annotator", F.col("v.label").alias("label"), "right")).alias("rated"))


def _copiers(items: DataFrame, fitted: Fit, params: DataFrame, known: DataFrame) -> DataFrame:
    """(annotator, leader) of the pairs that depend on each other. Of two the one that copies is known as a copier, or
    else the one whose votes are of another quality where the other has not voted."""
    rated = checkpointed(_rated(items, fitted, params))
    pairs = _pair_sums(rated).where((F.col("shared") >= LEAST_SHARED) & (F.col("equal") >= LEAST_EQUAL * F.col("shared")))
    own = rated.select(F.explode("rated").alias("v")).groupBy("v.annotator").agg(F.count("*").alias("n"), F.sum("v.right").alias("right"))
    prior = F.array(*(F.lit(float(p)) for p in fitted.prior for _ in fitted.prior))
    of = params.join(own, "annotator").join(known.withColumn("known", F.lit(1)), "annotator", "left").withColumn("emission", _emission_column(len(fitted.prior)))

    def side(name: str) -> DataFrame:
        return of.select(*(F.col(c).alias(c2) for c, c2 in (("annotator", name), ("n", f"n_{name}"), ("right", f"all_{name}"), ("known", f"known_{name}"), ("emission", f"e_{name}"))))

    pairs = pairs.join(side("a"), "a").join(side("b"), "b")
    chance = F.aggregate(F.zip_with(F.zip_with("e_a", "e_b", lambda x, y: x * y), prior, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    excess = (F.col("equal") - F.col("shared") * chance) / F.sqrt(F.greatest(F.col("shared") * chance * (1 - chance), F.lit(1e-9)))

    def differs(x: str) -> Column:
        elsewhere = F.col(f"n_{x}") - F.col("shared")
        return F.when(elsewhere > 0, F.abs(F.col(f"right_{x}") / F.col("shared") - (F.col(f"all_{x}") - F.col(f"right_{x}")) / elsewhere)).otherwise(0.0)

    first = F.struct(F.coalesce("known_a", F.lit(0)), differs("a")) > F.struct(F.coalesce("known_b", F.lit(0)), differs("b"))
    return pairs.where(excess >= LEAST_EXCESS).select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("annotator"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("leader"))


def _emission_column(labels: int) -> Column:
    cells = [(1 - F.col("trust")) * F.get("guess", F.lit(u)) + F.when(F.get("reading", F.lit(t)) == u, F.col("trust")).otherwise(0.0) for t in range(labels) for u in range(labels)]
    return F.array(*cells)


def without_copies(items: DataFrame, fitted: Fit) -> DataFrame:
    """The items without the votes that repeat another's: of a pair that depends on each other the copier's equal votes.

    A copier who repeats whoever is there shows first with the most frequent leader; further rounds look at the votes
    that are left. Each round takes votes away, and the rounds end when no pair is found.
    """
    spark = items.sparkSession
    params = fitted.as_table(spark)
    known = spark.createDataFrame([], "annotator string")
    while True:
        leaders = checkpointed(_copiers(items, fitted, params, known))
        if leaders.isEmpty():
            return items
        votes = _exploded(items)
        led = votes.join(leaders, "annotator").join(votes.withColumnRenamed("annotator", "leader"), ["item", "leader", "label"])
        copied = led.groupBy("item").agg(F.collect_set("annotator").alias("copied"))
        rest = F.filter("votes", lambda v: ~F.coalesce(F.array_contains("copied", v["annotator"]), F.lit(False)))
        items = checkpointed(items.join(copied, "item", "left").select("item", rest.alias("votes"), "barred"))
        known = checkpointed(known.union(leaders.select("annotator")).distinct())


def consensus(items: DataFrame, own: DataFrame, fitted: Fit, names: tuple[str, ...]) -> DataFrame:
    """(item, label, confidence, votes, agreement) by the votes in `own`, the items without copied votes.

    votes and agreement, the share of agreeing pairs of votes, are of all votes in `items`. Of equally likely labels
    the first in the order of names holds.
    """
    best = F.array_max("p")
    label = F.element_at(F.array(*map(F.lit, names)), F.array_position("p", best).cast("int"))
    counts = [F.size(F.filter("votes", lambda v, i=i: v["label"] == i)) for i in range(len(names))]
    n = F.size("votes")
    agreement = F.when(n > 1, sum((c * (c - 1) for c in counts), F.lit(0)) / (n * (n - 1))).otherwise(1.0)
    return items.join(posteriors(own, fitted), "item").select("item", label.alias("label"), best.alias("confidence"), n.alias("votes"), agreement.alias("agreement"))


def annotators(items: DataFrame, own: DataFrame, fitted: Fit, names: tuple[str, ...]) -> DataFrame:
    """(annotator, votes, copied, trust, reading, guess_*): the reliability of each annotator on votes of their own.

    copied is the share of votes that repeat another's; reading names, for each label, what the annotator says for it.
    """
    said = _exploded(items).groupBy("annotator").agg(F.count("*").alias("votes"))
    kept = _exploded(own).groupBy("annotator").agg(F.count("*").alias("kept"))
    text = F.array(*map(F.lit, names))
    reading = F.array_join(F.transform("reading", lambda i: F.get(text, i)), " ")
    found = said.join(kept, "annotator", "left").join(fitted.as_table(items.sparkSession), "annotator", "left")
    return found.select(
        "annotator", "votes", F.round(1 - F.coalesce("kept", F.lit(0)) / F.col("votes"), 6).alias("copied"), F.round("trust", 6).alias("trust"), reading.alias("reading"),
        *(F.round(F.get("guess", F.lit(i)), 6).alias(f"guess_{name}") for i, name in enumerate(names)),
    )
