"""Lexicon against corpus: which entries stand in which texts, literally and between word boundaries.

The containment join is a theta join. It runs as an equi join on word n-grams, which generates candidates, with the
literal boundary test as a residual filter, so no pair of entry and text is formed that shares no n-gram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvida.functions.text import WORD_CLASS, lowered

_WORD = f"([{WORD_CLASS}]+)"
#: Joins the words of an n-gram; no text holds it.
_GLUE = "\x01"
#: Entries up to which a lexicon goes to every task.
BROADCAST_ENTRIES = 100_000


def boundary_words(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(_WORD), F.lit(1))


def stands_in(text: Column, entry: Column) -> Column:
    """The entry occurs literally, with no word character on either side."""
    quoted = F.concat(F.lit(r"\Q"), entry, F.lit(r"\E"))
    pattern = F.concat(F.lit(f"(?<![{WORD_CLASS}])"), quoted, F.lit(f"(?![{WORD_CLASS}])"))
    return text.contains(entry) & F.regexp_like(text, pattern)


def prepared(lexicon: DataFrame, word: str) -> DataFrame:
    """The lexicon with `entry`, the word as matched, its first n-gram key and its length in words."""
    entry = lowered(F.trim(F.col(word)))
    return lexicon.withColumn("entry", entry).withColumn("entry_words", boundary_words(F.col("entry"))).where("size(entry_words) > 0").withColumn(
        "gram", F.concat_ws(_GLUE, "entry_words")
    )


def matches(corpus: DataFrame, lexicon: DataFrame, word: str, text: str = "text") -> DataFrame:
    """Corpus rows × lexicon rows for each entry that stands in the text; one row for each pair.

    The n-grams are of the lengths that the lexicon has, which one small aggregate finds; a text's are made distinct in
    its own row before they are spread out.
    """
    entries = prepared(lexicon, word)
    sizes = {r[0]: r[1] for r in entries.groupBy(F.size("entry_words")).count().collect()}  # as many rows as entries have words
    lengths = sorted(sizes)
    lowered_corpus = corpus.withColumn("matched_text", lowered(F.col(text)))
    none = F.expr("cast(array() as array<string>)")

    def of_length(ws: Column, n: int) -> Column:
        if n == 1:
            return ws
        places = F.sequence(F.lit(1), F.size(ws) - (n - 1))
        return F.when(F.size(ws) >= n, F.transform(places, lambda i: F.concat_ws(_GLUE, *(ws[i + (k - 1)] for k in range(n))))).otherwise(none)

    # the array of one array binds the words, so that they are found once and not once an n-gram
    tokens = F.transform(F.array(boundary_words(F.col("matched_text"))), lambda ws: F.array_distinct(F.concat(none, *(of_length(ws, n) for n in lengths))))[0]
    grams = lowered_corpus.withColumn("gram", F.explode(tokens))
    entries = entries.drop("entry_words")
    if sum(sizes.values()) <= BROADCAST_ENTRIES:  # counted, so that texts are not shuffled; a larger lexicon is joined by n-gram
        entries = F.broadcast(entries)
    return grams.join(entries, "gram").where(stands_in(F.col("matched_text"), F.col("entry"))).drop("gram", "matched_text")


def occurring(corpus: DataFrame, lexicon: DataFrame, word: str) -> DataFrame:
    """The lexicon entries that occur in any text: a semi join, all columns of the lexicon kept."""
    found = matches(corpus, lexicon.select(word).distinct(), word).select(word).distinct()
    return lexicon.join(found, word, "left_semi")


def annotated(corpus: DataFrame, lexicon: DataFrame, word: str, metadata: tuple[str, ...] = (), key: str = "doc_id") -> DataFrame:
    """Texts that hold an entry, with `entries`: their words and metadata, longest first, then in lexicon order (_pos).

    Matches are gathered by the corpus's key, and the texts come back by a join on it, so that no text is a group's key.
    """
    found = matches(corpus.select(key, "text"), lexicon, word)
    item = F.struct((-F.length("entry")).alias("rank"), F.col("_pos"), F.col(word), *metadata)
    gathered = found.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("entries"))
    return corpus.join(gathered, key)


def coverage(corpus: DataFrame, lexicon: DataFrame, word: str, source: str = "source") -> DataFrame:
    """(word, total_hits, sources): texts that hold each entry, in all and by source; entries without a hit stay."""
    found = matches(corpus, lexicon.select(word).distinct(), word)
    by_source = found.groupBy(word, F.coalesce(source, F.lit("unknown")).alias("origin")).agg(F.count("*").alias("hits"))
    by_word = by_source.groupBy(word).agg(
        F.sum("hits").alias("total_hits"), F.concat_ws(", ", F.array_sort(F.collect_list(F.concat("origin", F.lit("="), "hits")))).alias("hits_by_source")
    )
    return lexicon.select(word).distinct().join(by_word, word, "left").select(word, F.coalesce("total_hits", F.lit(0)).alias("total_hits"), F.coalesce("hits_by_source", F.lit("")).alias("hits_by_source"))


def cloze(corpus: DataFrame, lexicon: DataFrame, word: str, base: str) -> DataFrame:
    """(text row, word): the base of an entry stands in the text and the whole entry does not."""
    bases = matches(corpus, lexicon.select(word, base).distinct(), base).drop("entry")
    wholes = matches(corpus, lexicon.select(word).distinct(), word).select("doc_id", word)
    return bases.join(wholes, ["doc_id", word], "left_anti")
