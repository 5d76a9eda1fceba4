"""How far each draft of one recording is from what was said, told by the drafts alone.

Recognisers mostly fail at different words, so that the distance of two drafts is about the sum of their errors. Three
drafts give three distances and so the errors of each (half of what its two distances exceed the third one by); of more
drafts the median over all pairs of others counts. Distances are edits of words, by bit vectors (Myers, Hyyrö).
"""

from __future__ import annotations

from itertools import combinations
from statistics import median

from corvida.llm.common import WORD
from corvida.llm.lookalike_transducer import canonical


def words(text: str | None) -> list[str] | None:
    """The words of a draft in one form, without case and punctuation; None for a draft that is not there."""
    return None if text is None else WORD.findall(canonical(text).lower())


def distance(a: list[str], b: list[str]) -> int:
    """Words replaced, inserted or left out between a and b."""
    if a == b:
        return 0
    if not a:
        return len(b)
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    every, last, edits = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = every, 0
    for word in b:
        equal = places.get(word, 0)
        diagonal = (((equal & up) + up) ^ up) | equal
        right, left = down | ~(diagonal | up) & every, up & diagonal
        edits += bool(right & last) - bool(left & last)
        right, left = right << 1 | 1, left << 1
        side = equal | down
        up, down = (left | ~(side | right)) & every, right & side & every
    return edits


def errors(drafts: list[str | None]) -> list[float | None]:
    """The words each draft has wrong, in halves; None for all where there are under three, and for missing ones."""
    texts = {i: w for i, w in enumerate(map(words, drafts)) if w is not None}
    apart = {(i, j): distance(texts[i], texts[j]) for i, j in combinations(texts, 2)}
    apart |= {(j, i): d for (i, j), d in apart.items()}
    found = {i: [(apart[i, j] + apart[i, k] - apart[j, k]) / 2 for j, k in combinations(texts, 2) if i not in (j, k)] for i in texts}
    return [median(found[i]) if found.get(i) else None for i in range(len(drafts))]
