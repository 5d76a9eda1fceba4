"""Language by rank-order profiles: n-grams of a text against each language's most frequent ones, by out-of-place distance.

A profile ranks the most frequent character n-grams (1 to 4, with word boundaries) of a language. A stretch's own
n-grams are ranked by how often they occur, tied ones sharing a rank; its distance to a language is the sum, over them,
of how far the two ranks lie apart, or a maximum where the profile lacks the n-gram. The least distance names the
language, and how much farther the next one lies is the confidence. A text is divided into stretches first: in one word
nearly all n-grams occur once and share the first rank, so that the distance is a sum over words, and the languages of
neighbouring words are the path of least distance with a price on each change (Viterbi). Han, kana and Hangul are told
by script.

Profiles are fitted on a bounded sample of labelled documents, about SAMPLE_PER_LANGUAGE of each language, read whole.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvida.llm.common import plain
from corvida.llm.lookalike_transducer import canonical

SAMPLE_PER_LANGUAGE = 250
PROFILE_SIZE = 2500
SCRIPT_LANGUAGES = ("ja", "ko", "zh")
#: Vietnamese is also met without its marks; that profile stands for the same language.
UNMARKED = "vi-unmarked"

_TOKEN = regex.compile(r"(?P<cjk>[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}ー々〆]+)|(?P<word>\p{Latin}[\p{Latin}\p{M}]*(?:['’]\p{Latin}+)*)|(?P<stop>[.?!…。？！]+(?=\s|$|[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}])|\n|[。？！])")
_CLUSTER = regex.compile(r"[\s\S]\u200b*(?:\p{M}\u200b*)*")
_KANA, _HANGUL = regex.compile(r"[\p{Hiragana}\p{Katakana}]"), regex.compile(r"\p{Hangul}")


def grams(word: str) -> list[str]:
    padded = f"_{word}_"
    found = [padded[i : i + n] for n in (2, 3, 4) for i in range(len(padded) - n + 1)]
    return found + list(word)


def _lowered(text: str) -> tuple[str, list[tuple[int, int]] | None]:
    """The composed text in lower case without zero-width spaces, and for each of its characters the place in the stored
    text that it comes from; None where the places are the same."""
    lowered = text.lower()
    if len(lowered) == len(text) and "\u200b" not in text and unicodedata.is_normalized("NFC", lowered):
        return lowered, None
    out, places = [], []
    for m in _CLUSTER.finditer(text):
        piece = unicodedata.normalize("NFC", m[0].replace("\u200b", "").lower())
        out.append(piece)
        places += [m.span()] * len(piece)
    return "".join(out), places


def _counts(batches):
    counts: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            forms = [(lang, canonical(text).lower())]
            if lang == "vi":
                forms.append((UNMARKED, plain(text)))
            for name, form in forms:
                for word, n in Counter(m["word"] for m in _TOKEN.finditer(form) if m["word"]).items():
                    for g in grams(word):
                        counts[name, g] += n
    yield pd.DataFrame([(lang, g, n) for (lang, g), n in counts.items()], columns=["lang", "gram", "n"])


def fit_profiles(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, size: int = PROFILE_SIZE) -> dict[str, dict[str, int]]:
    """The profiles of the languages in docs(doc_id, lang, text), ranks from 0. At most size n-grams of each reach the driver."""
    totals = {r["lang"]: r["n"] for r in docs.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    for lang, n in totals.items():
        share = min(1.0, per_language / n)
        chosen = chosen | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)))
    sample = docs.where(chosen & F.col("text").isNotNull()).select("lang", "text")
    counts = sample.mapInPandas(_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    profiles: dict[str, dict[str, int]] = {}
    for lang, gram, rank in counts.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "gram", "rank").collect():
        profiles.setdefault(lang, {})[gram] = rank - 1
    return {lang: p for lang, p in profiles.items() if lang not in SCRIPT_LANGUAGES}


@dataclass(frozen=True)
class Stretch:
    start: int
    end: int
    lang: str
    confidence: float
    words: int
    sentences: int


class Identifier:
    """Languages of texts by fitted profiles. The cost of a word is kept, as words recur."""

    #: Price of changing the language between words, and where a sentence ends.
    CHANGE, CHANGE_AT_STOP = 7.0, 3.5
    #: Words of a stretch at least; one at the edge of a text or between stops may be shorter.
    LEAST_WORDS, LEAST_SENTENCE, LEAST_CJK = 5, 3, 4
    #: Share by which another language must be nearer to a stretch than the one of its words.
    CLOSE = 0.05

    def __init__(self, profiles: dict[str, dict[str, int]], expected: str = "vi"):
        self.names = sorted(profiles)
        self.langs = [n.split("-")[0] for n in self.names]
        self.size = max((len(p) for p in profiles.values()), default=1)
        self.ranks: dict[str, list[int]] = {}
        for i, name in enumerate(self.names):
            for gram, rank in profiles[name].items():
                self.ranks.setdefault(gram, [self.size] * len(self.names))[i] = rank
        self.nothing = [self.size] * len(self.names)
        self.expected = expected
        self.own = [i for i, lang in enumerate(self.langs) if lang == expected]
        self.cost = lru_cache(maxsize=500_000)(self._cost)
        self.number = {g: i for i, g in enumerate(self.ranks)}
        self.table = np.array([*self.ranks.values(), self.nothing], dtype=np.int32).reshape(len(self.ranks) + 1, -1)
        self.numbers = lru_cache(maxsize=200_000)(self._numbers)

    def _cost(self, word: str) -> tuple[float, ...]:
        """Out-of-place distance of a word to each profile, in units of the maximum."""
        total = [0] * len(self.names)
        for g in grams(word):
            for i, r in enumerate(self.ranks.get(g, self.nothing)):
                total[i] += r
        return tuple(t / self.size for t in total)

    def stretches(self, text: str | None) -> list[Stretch]:
        """The stretches of one language each, in order; short ones of another language belong to their neighbours."""
        if not text:
            return []
        lowered, places = _lowered(text)
        tokens: list[tuple[str, str, int, int, bool]] = []  # kind, word, start, end, after a stop
        stop = True
        for m in _TOKEN.finditer(lowered):
            kind = m.lastgroup
            if kind == "stop":
                stop = True
                continue
            word = m[0]
            start, end = m.span()
            tokens.append((kind, word, places[start][0], places[end - 1][1], stop) if places else (kind, word, start, end, stop))
            stop = False
        if not tokens:
            return []
        return self._divide(tokens)

    def _divide(self, tokens) -> list[Stretch]:
        runs: list[list] = []  # [lang or None for Latin words, tokens]
        for t in tokens:
            lang = None
            if t[0] == "cjk":
                lang = "ko" if _HANGUL.search(t[1]) else "ja" if _KANA.search(t[1]) else "zh"
            if runs and (runs[-1][0] == lang or (lang in ("zh", "ja") and runs[-1][0] in ("zh", "ja"))):
                runs[-1][1].append(t)
                if "ja" in (lang, runs[-1][0]):
                    runs[-1][0] = "ja" if lang in ("zh", "ja") else lang
            else:
                runs.append([lang, [t]])
        labelled: list[tuple[str, tuple]] = []
        for lang, run in runs:
            if lang:
                labelled += [(lang, t) for t in run]
            else:
                labelled += zip(self._path([t[1] for t in run], [t[4] for t in run]), run)
        return self._merge(labelled)

    def _path(self, words: list[str], stops: list[bool]) -> list[str]:
        """The languages of least distance with a price on each change."""
        if not self.names:
            return [self.expected] * len(words)
        k = range(len(self.names))
        best = list(self.cost(words[0]))
        back: list[list[int]] = []
        for word, stop in zip(words[1:], stops[1:]):
            cost = self.cost(word)
            low = min(k, key=best.__getitem__)
            change = best[low] + (self.CHANGE_AT_STOP if stop else self.CHANGE)
            came = [i if best[i] <= change else low for i in k]
            best = [min(best[i], change) + cost[i] for i in k]
            back.append(came)
        at = min(k, key=best.__getitem__)
        path = [at]
        for came in reversed(back):
            at = came[at]
            path.append(at)
        return [self.langs[i] for i in reversed(path)]

    def _merge(self, labelled) -> list[Stretch]:
        groups: list[list] = []
        for lang, t in labelled:
            if groups and groups[-1][0] == lang:
                groups[-1][1].append(t)
            else:
                groups.append([lang, [t]])

        def stands(i: int) -> bool:
            lang, run = groups[i]
            if lang in SCRIPT_LANGUAGES:
                return sum(len(t[1]) for t in run) >= self.LEAST_CJK
            if len(run) >= self.LEAST_WORDS:
                return True
            closed = run[0][4] and (i + 1 == len(groups) or groups[i + 1][1][0][4])
            return closed and len(run) >= self.LEAST_SENTENCE

        if len(groups) > 1:
            kept = [i for i in range(len(groups)) if stands(i)] or [max(range(len(groups)), key=lambda i: sum(len(t[1]) for t in groups[i][1]))]
            merged: list[list] = []
            for i, (lang, run) in enumerate(groups):
                if i not in kept:
                    before = [j for j in kept if j < i]
                    lang = groups[before[-1] if before else kept[0]][0]
                if merged and merged[-1][0] == lang:
                    merged[-1][1] += run
                else:
                    merged.append([lang, run])
            groups = merged
        return [Stretch(run[0][2], run[-1][3], *self._named(lang, run), len(run), sum(t[4] for t in run)) for lang, run in groups]

    def _numbers(self, word: str) -> np.ndarray:
        return np.array([self.number.get(g, len(self.number)) for g in grams(word)], dtype=np.int32)

    def distances(self, words: list[str]) -> np.ndarray:
        """The out-of-place distance of the words' ranked n-grams to each profile; n-grams of no profile lack in all."""
        numbers = np.concatenate([self.numbers(w) for w in words])
        found, counts = np.unique(numbers, return_counts=True)
        own = np.minimum(len(counts) - np.searchsorted(np.sort(counts), counts, side="right"), self.size)
        ranks = self.table[found]
        return np.where(ranks >= self.size, self.size, np.abs(ranks - own[:, None])).sum(axis=0)

    def _named(self, lang: str, run) -> tuple[str, float]:
        """The stretch's language and how much nearer it is than the next one; by script alone it is sure.

        The profiles decide between languages of the Latin script; where two lie less than CLOSE apart the division holds.
        """
        if lang in SCRIPT_LANGUAGES or not self.names:
            return lang, 1.0
        total = self.distances([t[1] for t in run if t[0] == "word"]).tolist()
        best: dict[str, int] = {}
        for d, name in zip(total, self.langs):
            best[name] = min(d, best.get(name, d))
        nearest = min(best, key=best.__getitem__)
        if lang not in best or best[nearest] < best[lang] * (1 - self.CLOSE):
            lang = nearest
        other = min((d for name, d in best.items() if name != lang), default=0)
        return lang, round(max(0.0, min(1.0, 1 - best[lang] / other if other else 0.0)), 4)
