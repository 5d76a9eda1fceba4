"""Does a transcript stop before the speech does? Its copies are the other transcripts of the recording.

A value is cut when it is a strict prefix of longer copies. Copies differ by recognition errors, so besides the exact
prefix test on letters there is a tolerant one: the last words of the value are aligned with each copy near the place
where they should stand, and the letters of the copy behind that place are the gap. The middle gap over the copies
decides, so one copy with a stray tail, or one that is cut itself, does not.
"""

from __future__ import annotations

from functools import lru_cache

from corvida.llm.common import plain_words

#: Words at a value's end that are aligned with a copy.
TAIL = 8
#: Least letters of speech behind the end: below that a misheard last word explains the difference.
LEAST_GAP = 4


@lru_cache(maxsize=4096)
def words_of(text: str) -> tuple[str, ...]:
    return tuple(plain_words(text))


def end_gap(value: tuple[str, ...], copy: tuple[str, ...]) -> int | None:
    """Letters of the copy behind the place where the value ends; None when the value's end is not found in it.

    Semi-global alignment of the last words, with unit costs, within the stretch of the copy that dropped or inserted
    words can move them to. Of equal ends the last one holds, so that a misheard last word leaves no gap.
    """
    n = len(value)
    if value[-2:] == copy[-2:] and abs(n - len(copy)) <= 2 + n // 8:
        return 0
    tail = value[-TAIL:]
    slack = 3 + n // 8
    begin, end = max(0, n - len(tail) - slack), min(len(copy), n + slack)
    window = copy[begin:end]
    if not window:
        return None
    row = [0] * (len(window) + 1)
    for i, word in enumerate(tail, 1):
        last = i == len(tail)
        diagonal, row[0] = row[0], i
        for j, other in enumerate(window, 1):
            same = word == other or (last and other.startswith(word))
            diagonal, row[j] = row[j], min(diagonal + (not same), row[j] + 1, row[j - 1] + 1)
    best = min(row)
    if best > max(1, len(tail) // 2):
        return None
    at = max(j for j, cost in enumerate(row) if cost == best)
    rest = sum(map(len, copy[begin + at :]))
    if at and window[at - 1] != tail[-1] and window[at - 1].startswith(tail[-1]):
        rest += len(window[at - 1]) - len(tail[-1])
    return rest


def cut_gap(value: str, copies: list[str]) -> int:
    """Letters of speech that the value lacks at its end; 0 when it is whole or nothing can be told."""
    return cut_of(value, copies)[0]


def cut_of(value: str, copies: list[str]) -> tuple[int, bool]:
    """cut_gap, and whether the value is a strict prefix of a copy: what is left is found by the alignment alone."""
    words = words_of(value)
    if not words:
        return 0, False
    gaps, exact = [], []
    letters = None
    for copy in copies:
        if copy == value:
            continue
        other = words_of(copy)
        gap = end_gap(words, other)
        if gap is None:
            continue
        gaps.append(gap)
        if gap >= LEAST_GAP:
            letters = letters or "".join(words)
            if "".join(other).startswith(letters):
                exact.append(gap)
    if not gaps:
        return 0, False
    gaps.sort()
    middle = gaps[len(gaps) // 2]
    if middle >= LEAST_GAP:
        return middle, bool(exact)
    return (max(exact), True) if len(exact) * 3 >= len(gaps) else (0, False)
