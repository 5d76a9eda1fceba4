"""Problem 6: evaluation texts leaking into training text.

The passages are a stated set held against all documents in blocks of BLOCK_CHARACTERS at most: the index of a block,
whose size that bounds, is built once and broadcast, and further blocks are further passes. Documents are read whole,
however long; nothing of them is shuffled but the pairs found. What is counted over all passages, the words that most of
them share, is counted where they are. A null text or passage leaks nothing; neither does a passage of under twelve
words. Repeated rows give one row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvida.llm.cgk_lsh import COMMON_SHARE, LEAST_COMMON, PassageIndex, letters_of
from corvida.session import table

#: Characters of passages in one index, which takes about 40 bytes a character where it is held.
BLOCK_CHARACTERS = 4_000_000
#: Characters of documents that are looked through at once.
SLICE_CHARACTERS = 1_500_000


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    size = batch["text"].str.len().cumsum() // SLICE_CHARACTERS
    for _, part in batch.groupby(size.to_numpy()):
        yield part


def _words_of_passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = letters_of(batch["passage"].tolist())
        pairs = pd.DataFrame({"word": found.hashes().view(np.int64), "owner": found.owner}).drop_duplicates()
        yield pairs.groupby("word", as_index=False).size().rename(columns={"size": "n"})


def common_words(distinct: DataFrame, count: int) -> set[int]:
    """cgk_lsh.common_words of a table of passages: at most 1 / COMMON_SHARE times a passage's words reach the driver."""
    words = distinct.mapInPandas(_words_of_passages, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"] % 2**64 for r in words.where(F.col("n") > max(LEAST_COMMON, count * COMMON_SHARE)).collect()}


def leaks(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, passage, first_word, words): each document with each passage of passages(passage) that it leaks.

    One row for each run of passage words; first_word counts the passage's words from 0.
    """
    distinct = passages.where("passage is not null").select("passage").distinct()
    count, total = distinct.agg(F.count("*"), F.sum(F.length("passage"))).first()
    blocks = 1 + int(total or 0) // BLOCK_CHARACTERS
    common, parts = common_words(distinct, count), []
    for block in range(blocks):
        own = sorted(r[0] for r in distinct.where(F.pmod(F.xxhash64("passage"), F.lit(blocks)) == block).collect())
        shared = docs.sparkSession.sparkContext.broadcast(PassageIndex(own, common))

        def find(batches, shared=shared):
            for batch in batches:
                for part in _slices(batch):
                    ids, texts = part["doc_id"].tolist(), part["text"].tolist()
                    rows = [(ids[t], shared.value.texts[p], first, n) for t, p, first, n in shared.value.leaks(texts)]
                    yield pd.DataFrame(rows, columns=["doc_id", "passage", "first_word", "words"])

        texts = docs.select("doc_id", "text").where("text is not null and doc_id is not null")
        parts.append(texts.mapInPandas(find, "doc_id long, passage string, first_word int, words int"))
    return reduce(DataFrame.unionByName, parts)


def p6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each leak with the item and the length of the run: what a report on leaked items is made of."""
    items = table(spark, sf_dir, "eval_items").select("item_id", "passage", "split")
    found = leaks(table(spark, sf_dir, "documents"), items.select("passage"))
    return found.join(items, "passage").select("item_id", "doc_id", "split", "first_word", "words").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_leaks(spark, sf_dir).select("item_id", "doc_id").distinct()


QUERIES = {"p6_found": p6_found, "p6_leaks": p6_leaks}
SQL: dict[str, str] = {}
