"""Voting of several transcripts word by word: alignment into a word network, weights, votes, text.

Each recording is aligned in one row, as its voters are few: the transcripts come as an array gathered in fixed order,
so an Arrow batch holds many recordings and nothing is grouped in Python.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NETWORK = T.ArrayType(T.ArrayType(T.StructType([T.StructField("voter", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("weight", T.DoubleType())])))


def fold(columns: list[list[tuple]], words: list[str], voter: int, weight: float) -> list[list[tuple]]:
    """Align a further transcript: a column that holds the word costs nothing, a change, a gap or a new column one.

    Of equal costs a match or change is taken before skipping a column, and that before a new one. A new column has the
    vote of its voter only: earlier voters cast no empty vote in it.
    """
    n, m = len(columns), len(words)
    held = [{v[1] for v in c} for c in columns]
    cost = [list(range(m + 1))]
    for i in range(n):
        row = [i + 1]
        for j in range(m):
            row.append(min(cost[i][j] + (words[j] not in held[i]), cost[i][j + 1] + 1, row[j] + 1))
        cost.append(row)
    out, i, j = [], n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (words[j - 1] not in held[i - 1]):
            i, j = i - 1, j - 1
            out.append([*columns[i], (voter, words[j], weight)])
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append([*columns[i], (voter, None, weight)])
        else:
            j -= 1
            out.append([(voter, words[j], weight)])
    return out[::-1]


def network(transcripts: list[tuple[list[str], float]]) -> list[list[tuple]]:
    """The network of all transcripts, folded by weight, highest first; equal weights in the given order."""
    columns: list[list[tuple]] = []
    for voter, (words, weight) in sorted(enumerate(transcripts), key=lambda t: -t[1][1]):
        columns = fold(columns, list(words), voter, weight) if columns else [[(voter, w, weight)] for w in words]
    return columns


@F.pandas_udf(NETWORK)
def aligned(voters: pd.Series) -> pd.Series:
    return voters.map(lambda vs: network([(v["words"], v["weight"]) for v in vs]))


def winner(column: Column) -> Column:
    """Word of a column with the highest weight, then most votes, then a word before none, then the first cast."""
    words = F.array_distinct(F.transform(column, lambda v: v["word"]))

    def scored(w: Column, at: Column) -> Column:
        own = F.filter(column, lambda v: v["word"].eqNullSafe(w))
        weight = F.aggregate(own, F.lit(0.0), lambda a, v: a + v["weight"])
        return F.struct(F.round(weight, 9).alias("weight"), F.size(own).alias("n"), w.isNotNull().alias("real"), (-at).alias("first"), w.alias("word"))

    return F.array_max(F.transform(words, scored))["word"]


def voted_text(net: Column) -> Column:
    return F.concat_ws(" ", F.transform(net, winner))
