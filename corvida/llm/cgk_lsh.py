"""Approximate passages in long texts: CGK embedding, bit-sampling LSH over windows, edit verification.

Letters are compared without case, marks, signs and spaces. A CGK walk reads a window letter by letter; at each step it
writes the letter it stands on and a random bit of (step, letter) says whether it moves on, so walks over windows that
differ by a few edits fall into step again and their outputs differ in few places: edit distance becomes Hamming
distance. A key samples the outputs at random steps. Every word start of a passage is a window, stock wording included;
of a text every STRIDE-th word start is, which a passage of twelve words cannot miss. A window is not begun where fewer
letters are left than it reads. Each repetition has its own bits and samples.

A collision is verified in two steps, the first for all collisions of a slice of texts at once. A leak has LEAST_WORDS
running passage words of which one at most is missing or replaced, and no figure is: so around the collision such words
must stand, up to SHIFT words from its diagonal, each equal or, up to NEAR_SHIFT words from it, of a shape that a little
changed word may have, and LEAST_EQUAL of them equal. The exact
alignment of words decides: a changed letter keeps a word; a stray word costs little, a missing or replaced one much, and
another figure ends the run.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from corvida.llm.lookalike_transducer import LATIN_STANDINS, LOOKALIKES

WINDOW = 24
STEPS = 2 * WINDOW
SAMPLES = 13
REPETITIONS = 3
STRIDE = 2
#: Collisions that are held at once, about, and that are looked at together.
MOST, CHUNK = 4_000_000, 20_000
LEAST_WORDS, LEAST_EQUAL, SHIFT, NEAR_SHIFT = 12, 6, 2, 1
END, DROP, GAP = 63, 255, 0
HASH = 0x9E3779B97F4A7C15
#: Words on either side of a collision that are aligned.
AROUND = 2 * LEAST_WORDS
#: Prices in the alignment, of a figure that is missing or another one, and the words that it may be off the diagonal.
LOST, STRAY, NEAR, FIGURE, BAND = 5.5, 0.7, 1.6, 1000.0, 8
#: Room around the words of a row, so that those around any of them can be looked up.
ROOM = LEAST_WORDS + SHIFT
#: Code of the last digit: a word of digits only is a figure.
LAST_DIGIT = 10


def _letter_codes() -> np.ndarray:
    """Code point to letter: 0 between words, DROP for marks, 1.. for letters and digits, others folded to 37..62."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000 or 0x3400 <= code < 0xD7A4:
            continue
        char = chr(code)
        kind = unicodedata.category(char)
        if kind[0] == "M" or kind == "Cf":
            table[code] = DROP
        elif kind[0] in "LN":
            char = LATIN_STANDINS.get(char, LOOKALIKES.get(char, char))
            base = unicodedata.normalize("NFKD", char)[0].lower().replace("đ", "d")[:1]
            n = "0123456789abcdefghijklmnopqrstuvwxyz".find(base)
            table[code] = n + 1 if n >= 0 else 37 + ord(base or char) % 26
    folded = np.arange(0x3400, 0xD7A4)
    table[0x3400:0xD7A4] = 37 + folded % 26
    return table


_CODES: np.ndarray | None = None


def _codes() -> np.ndarray:
    global _CODES
    if _CODES is None:
        _CODES = _letter_codes()
    return _CODES


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.full(size, r, dtype=np.uint64)) for r in (HASH, pow(HASH, -1, 1 << 64)))


@dataclass
class Letters:
    """The letters of many texts in a row, END-padded between texts; the first letter of each word, and its text."""

    letters: np.ndarray
    starts: np.ndarray
    owner: np.ndarray
    ends: np.ndarray

    def word(self, i: int) -> bytes:
        return self.letters[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """A number for each word, the same for equal words: polynomials modulo 2**64, divided by the power at the start."""
        powers, inverse = _powers(1 << max(10, (len(self.letters) - 1).bit_length()))
        powers = powers[: len(self.letters)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(powers * (self.letters.astype(np.uint64) + np.uint64(1)))])
        return (sums[self.ends] - sums[self.starts]) * inverse[self.starts]


@dataclass
class Shapes:
    """What the test of collisions looks at in words: number, first and last letter, length, and the letters as bits."""

    number: np.ndarray
    ends: np.ndarray
    length: np.ndarray
    letters: np.ndarray
    figure: np.ndarray

    @staticmethod
    def of(found: Letters, padding: int, nothing: int) -> Shapes:
        """The shapes of all words, with room before the first and behind the last."""
        bits = np.uint64(1) << found.letters.astype(np.uint64)
        bits[found.letters == END] = 0
        edges = np.stack([found.starts, found.ends], axis=1).ravel() if len(found.starts) else np.zeros(0, np.int64)
        letters = np.bitwise_or.reduceat(bits, edges)[::2] if len(edges) else np.zeros(0, np.uint64)
        last = found.letters[np.maximum(found.ends - 1, 0)]
        ends = np.stack([found.letters[found.starts], last]) if len(found.starts) else np.zeros((2, 0), np.uint8)
        figure = (letters >> np.uint64(LAST_DIGIT + 1)) == 0
        room = (padding, padding)
        number = np.pad(found.hashes(), room, constant_values=nothing)
        length = np.minimum(found.ends - found.starts, 100).astype(np.int8)
        return Shapes(number, np.pad(ends, ((0, 0), room)), np.pad(length, room, constant_values=-100), np.pad(letters, room), np.pad(figure, room))


def letters_of(texts: list[str]) -> Letters:
    points = np.frombuffer("\0".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = _codes()[np.minimum(points, 0x10FFFF)]
    kept = codes != DROP
    codes, points = codes[kept], points[kept]
    cjk = (points >= 0x3040) & (points < 0xD7A4)  # each such character is a word
    separator = points == 0
    letter = codes > 0
    first = letter & (np.concatenate([[True], ~letter[:-1]]) | cjk)
    # the place of each letter in the row of letters, with a pad of END after every text
    pad = STEPS + WINDOW
    text_of = np.cumsum(separator)
    place = np.cumsum(letter) - letter + text_of * pad
    row = np.full(int(letter.sum()) + pad * (len(texts) + 1), END, dtype=np.uint8)
    row[place[letter]] = codes[letter]
    starts, owner = place[first].astype(np.int64), text_of[first].astype(np.int32)
    last = np.zeros(len(texts), dtype=np.int64)
    last[text_of[letter]] = place[letter] + 1  # the highest place holds
    ends = np.concatenate([starts[1:], [0]]) if len(starts) else starts
    edge = np.concatenate([owner[1:] != owner[:-1], [True]]) if len(owner) else np.zeros(0, bool)
    return Letters(row, starts, owner, np.where(edge, last[owner], ends))


def _whole_windows(found: Letters, words: np.ndarray) -> np.ndarray:
    """The words after whose start the text has the letters of a whole window."""
    return words[found.letters[np.minimum(found.starts[words] + WINDOW - 1, len(found.letters) - 1)] != END]


def _walks(letters: np.ndarray, starts: np.ndarray, seed: int) -> np.ndarray:
    """The sampled key of the CGK walk from each start."""
    random = np.random.default_rng(seed)
    moves = random.integers(0, 2, size=(STEPS, 64), dtype=np.int64).astype(np.int32)
    sampled = np.zeros(STEPS, dtype=bool)
    sampled[random.choice(STEPS, SAMPLES, replace=False)] = True
    last = int(np.flatnonzero(sampled)[-1])
    at = starts.astype(np.int32)  # a slice of texts is far shorter than 2**31 letters
    key = np.zeros(len(starts), dtype=np.uint64)
    factor = np.uint64(67)
    for step in range(last + 1):
        letter = letters[at]
        if sampled[step]:
            key = key * factor + letter
        at += moves[step][letter]
    return key * np.uint64(0x9E3779B97F4A7C15)


#: Share of all passages above which a word is common, and the passages that have it at least.
COMMON_SHARE, LEAST_COMMON = 1 / 150, 3


def common_words(passages: list[str]) -> set[int]:
    """The words of so many passages that a little changed one still tells something, by their number."""
    found = letters_of(passages)
    numbers, owners = found.hashes(), found.owner
    distinct = np.unique(np.stack([numbers, owners.astype(np.uint64)]), axis=1)[0] if len(numbers) else numbers
    words, counts = np.unique(distinct, return_counts=True)
    return set(words[counts > max(LEAST_COMMON, len(passages) * COMMON_SHARE)].tolist())


def _windows(values: np.ndarray) -> np.ndarray:
    """Sums of LEAST_WORDS neighbouring rows."""
    sums = np.concatenate([np.zeros((1, values.shape[1]), np.int16), np.cumsum(values, axis=0, dtype=np.int16)])
    return sums[LEAST_WORDS:] - sums[:-LEAST_WORDS]


class PassageIndex:
    """All windows of a bounded set of passages; each task holds it whole. common: common_words of all passages there are."""

    def __init__(self, passages: list[str], common: set[int] | None = None):
        self.texts, self.codes = passages, _codes()
        found = self.found = letters_of(passages)
        self.tables = []
        whole = _whole_windows(found, np.arange(len(found.starts)))
        for r in range(REPETITIONS):
            keys = _walks(found.letters, found.starts[whole], r)
            order = np.argsort(keys, kind="stable")
            bits = np.zeros(1 << 22, dtype=bool)
            bits[(keys >> np.uint64(42)).astype(np.int64)] = True
            self.tables.append((keys[order], whole[order].astype(np.int32), bits))
        self.shapes = Shapes.of(found, ROOM, 0)
        common = common_words(passages) if common is None else common
        own = slice(ROOM, ROOM + len(found.starts))
        self.rare = self.shapes.figure[own] | ~np.isin(self.shapes.number[own], np.array(sorted(common), dtype=np.uint64))
        self.first = np.searchsorted(found.owner, np.arange(len(passages) + 1))

    def collisions(self, texts: Letters) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (in the texts, in the passages) of colliding windows around which there may be a leak."""
        none = np.zeros(0, np.int64)
        if not len(texts.starts) or not len(self.found.starts):
            return none, none
        number = np.arange(len(texts.owner))
        first = np.concatenate([[True], texts.owner[1:] != texts.owner[:-1]])
        chosen = np.flatnonzero((number - np.maximum.accumulate(np.where(first, number, 0))) % STRIDE == 0)
        chosen = _whole_windows(texts, chosen)
        hits, loads = [], np.zeros(len(chosen), dtype=np.int64)
        for r, (keys, order, bits) in enumerate(self.tables):
            own = _walks(texts.letters, texts.starts[chosen], r)
            hit = np.flatnonzero(bits[(own >> np.uint64(42)).astype(np.int64)])
            low = np.searchsorted(keys, own[hit], "left")
            counts = np.searchsorted(keys, own[hit], "right") - low
            loads[hit] += counts
            hits.append((order, hit, low, counts))
        parts, count, kept, shapes = np.cumsum(loads) // MOST, len(self.found.starts), [], Shapes.of(texts, ROOM, 1)
        for part in np.unique(parts[loads > 0]):
            pairs = []
            for order, hit, low, counts in hits:
                own = (parts[hit] == part) & (counts > 0)
                at, low, counts = hit[own], low[own], counts[own]
                pairs.append(np.repeat(chosen[at], counts) * count + order[np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())])
            kept.append(self.running(shapes, texts, *np.divmod(np.unique(np.concatenate(pairs)), count)))
        return tuple(np.concatenate([x[k] for x in kept] or [none]) for k in range(2))

    def running(self, texts: Shapes, found: Letters, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The collisions around which LEAST_WORDS running passage words stand, but for one that is no figure.

        Equal words and figures are looked at first, as they exclude nearly all sentences of the same kind with other
        figures; words of a similar shape next, and the letters of such words last.
        """
        chosen = [np.zeros(0, np.int64)]
        owner = np.pad(self.found.owner, ROOM, constant_values=-1)
        for part in np.array_split(np.arange(len(left)), len(left) // CHUNK + 1):
            i, j = (x[part] + ROOM + np.arange(-LEAST_WORDS + 1, LEAST_WORDS)[:, None] for x in (left, right))
            number, lost = self.shapes.number[j], np.ones(i.shape, dtype=np.int8)
            for shift in range(-SHIFT, SHIFT + 1):
                lost[number == texts.number[i + shift]] = 0
            equal = lost == 0
            lost[owner[j] != owner[right[part] + ROOM]] = LEAST_WORDS
            figures = np.nonzero(self.shapes.figure[j] & (lost == 1))
            lost[figures] = np.where(self._near(texts, found, i[figures], j[figures], False), 0, LEAST_WORDS)
            for exactly in (False, True):
                # what is not excluded may have a similar word, but for half of the words that must be the same
                few = (_windows(np.where(lost == LEAST_WORDS, 1, 0)) == 0) & (_windows(equal) >= LEAST_EQUAL)
                few = (few & (_windows(lost) <= 1) if exactly else few).any(axis=0)
                part, i, j, lost, equal = part[few], i[:, few], j[:, few], lost[:, few], equal[:, few]
                open_ = np.nonzero(~equal & (lost < LEAST_WORDS))
                near = self._near(texts, found, i[open_], j[open_], exactly)
                lost[open_] = np.where(near, 0, np.where(self.shapes.figure[j[open_]], LEAST_WORDS, 1))
            chosen.append(part[(_windows(lost) <= 1).any(axis=0)])
        kept = np.concatenate(chosen)
        return left[kept], right[kept]

    def _near(self, texts: Shapes, found: Letters, i: np.ndarray, j: np.ndarray, exactly: bool) -> np.ndarray:
        """Whether a text word up to NEAR_SHIFT from i may be passage word j, by shape or by its letters."""
        own, near = self.shapes, np.zeros(len(i), dtype=bool)
        length, ends, letters, edits = own.length[j], own.ends[:, j], own.letters[j], np.where(own.length[j] >= 7, 4, 2)
        for shift in range(-NEAR_SHIFT, NEAR_SHIFT + 1):
            other = i + shift
            hit = (np.abs(length - texts.length[other]) <= 2) & ((ends[0] == texts.ends[0, other]) | (ends[1] == texts.ends[1, other]))
            hit &= np.bitwise_count(letters ^ texts.letters[other]) <= edits
            if exactly:
                some = np.flatnonzero(hit & ~near)
                hit[some] = [similar(self.found.word(a), found.word(b)) for a, b in zip((j[some] - ROOM).tolist(), (other[some] - ROOM).tolist())]
            near |= hit
        return near

    def places(self, texts: Letters, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of collisions of one shift whose passage words lie in the same LEAST_WORDS words, the first: they share an alignment."""
        passage = self.found.owner[right]
        block = (right - self.first[passage]) // LEAST_WORDS
        keys = np.stack([texts.owner[left].astype(np.int64), passage.astype(np.int64), left - right, block])
        at = np.sort(np.unique(keys, axis=1, return_index=True)[1])
        return left[at], right[at]

    def _surroundings(self, texts: Letters, begins: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bounds of the passage words and of the text words that are aligned around the collisions."""
        passage, text = self.found.owner[j], texts.owner[i]
        start = self.first[passage] + (j - self.first[passage]) // LEAST_WORDS * LEAST_WORDS
        low, high = np.maximum(self.first[passage], start - AROUND), np.minimum(self.first[passage + 1], start + LEAST_WORDS + AROUND)
        return low, high, np.maximum(begins[text], low + i - j - BAND), np.minimum(begins[text + 1], high + i - j + BAND)

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, passage, first passage word, words) of the leaks in the texts; runs of a pair that overlap count as one."""
        global _CODES
        _CODES = self.codes
        letters = letters_of(texts)
        left, right = self.places(letters, *self.collisions(letters))
        if not len(left):
            return []
        begins = np.searchsorted(letters.owner, np.arange(len(texts) + 1))
        found: dict[tuple[int, int], set[tuple[int, int]]] = {}
        word = lru_cache(maxsize=None)(letters.word)
        covered: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for i, j, low, high, a, b in zip(left.tolist(), right.tolist(), *(x.tolist() for x in self._surroundings(letters, begins, left, right))):
            passage = int(self.found.owner[j])
            pair = int(letters.owner[i]), passage
            if any(first <= j < end and abs(i - j - shift) <= 1 for first, end, shift in covered.get(pair, ())):
                continue  # in a run that is known
            # the twelve words around the collision first, close to its diagonal
            p, q = max(low, j - LEAST_WORDS + 1), min(high, j + LEAST_WORDS)
            c, d = max(a, p + i - j - SHIFT), min(b, q + i - j + SHIFT)
            run = align([self.found.word(w) for w in range(p, q)], self.rare[p:q].tolist(), [word(w) for w in range(c, d)], (i - c) - (j - p), SHIFT + 1)
            if not run or run[1] < LEAST_WORDS:
                continue
            own = [self.found.word(w) for w in range(low, high)]
            run = align(own, self.rare[low:high].tolist(), [word(w) for w in range(a, b)], (i - a) - (j - low))
            if run and run[1] >= LEAST_WORDS:
                first = int(low - self.first[passage]) + run[0]
                found.setdefault(pair, set()).add((first, first + run[1]))
                covered.setdefault(pair, []).append((low + run[0], low + run[0] + run[1], i - j))
        rows = []
        for (text, passage), runs in found.items():
            merged: list[list[int]] = []
            for first, end in sorted(runs):
                if merged and first < merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([first, end])
            rows += [(text, passage, first, end - first) for first, end in merged]
        return rows


@lru_cache(maxsize=500_000)
def similar(a: bytes, b: bytes) -> bool:
    """Equal up to small changes of letters: one edit, or two in a long word, or two letters swapped."""
    if a == b:
        return True
    n, m = len(a), len(b)
    if max(a) <= LAST_DIGIT and max(b) <= LAST_DIGIT:
        return False  # another figure
    if abs(n - m) > 1 + (min(n, m) >= 7) or min(n, m) < 2:
        return False
    if n == m:
        different = [i for i in range(n) if a[i] != b[i]]
        if len(different) <= 1:
            return True
        if len(different) == 2 and different[1] == different[0] + 1 and a[different[0]] == b[different[1]] and a[different[1]] == b[different[0]]:
            return True
        return n >= 7 and len(different) <= 2
    row = list(range(m + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(diagonal + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1] <= 1 + (min(n, m) >= 8)


def small(word: bytes, rare: bool, other: bytes) -> bool:
    """Whether a little change from word to other may be chance: of a short word, or two letters of a rare one."""
    return len(other) < 6 and (rare or len(word) < 5) or rare and len(word) == len(other) and sum(x != y for x, y in zip(word, other)) > 1


def align(passage: list[bytes], rare: list[bool], words: list[bytes], shift: int, band: int = BAND) -> tuple[int, int] | None:
    """(first passage word, passage words) of the best run of LEAST_WORDS passage words and more, or else of the best run.

    Local alignment within band words of the place where passage word i meets word i + shift: 1 for a word kept or
    changed a little; a little change of a short word, which may be chance, costs NEAR (two such words in a row, of
    which one is rare, are another name), a replaced or missing word LOST, a figure FIGURE, and a stray word STRAY. So a
    run goes on over a lost word only where it is long on both sides, while sentences of the same kind, which differ in
    each name and figure, fall apart. A run ends where its score is highest, and the words before and behind it that are
    changed a little, no two in a row, belong to it; one of enough words counts though a shorter one has a higher score.
    """
    n, m = len(passage), len(words)
    width = m + 1
    score, begin = [0.0] * width, [0] * width  # begin: of the run, passage word * width + word
    chance: dict[int, bool] = {}  # words of the text that stand for the last passage word by chance perhaps: is it rare
    tops: dict[int, tuple[float, int, int]] = {}
    for i in range(1, n + 1):
        word, unsure = passage[i - 1], rare[i - 1]
        lost = FIGURE if max(word) <= LAST_DIGIT else LOST
        low, high = max(1, i + shift - band), min(m, i + shift + band)
        if low > high:
            continue
        above, above_begin, before = score, begin, chance
        score, begin, chance = [0.0] * width, [0] * width, {}
        for j in range(low, high + 1):
            other = words[j - 1]
            if word == other:
                gain = 1.0
            elif above[j - 1] > 0 and (word[0] == other[0] or word[-1] == other[-1]) and similar(word, other):
                gain = 1.0
                if small(word, unsure, other):
                    gain = -lost if j - 1 in before and (unsure or before[j - 1]) else -NEAR
                    chance[j] = unsure
            else:
                gain = -lost
            s = above[j - 1] + gain
            start = above_begin[j - 1] if above[j - 1] > 0 else (i - 1) * width + j - 1
            if above[j] - lost > s:
                s, start = above[j] - lost, above_begin[j]
            if score[j - 1] - STRAY > s:
                s, start = score[j - 1] - STRAY, begin[j - 1]
            if s > 0:
                score[j], begin[j] = s, start
                if start not in tops or s > tops[start][0]:
                    tops[start] = s, i, j
    best, run = (False, 0.0), None
    for start, (s, end, j) in tops.items():
        first, at = divmod(start, width)
        changed = False  # two changed words in a row do not belong to it
        while first and at and (not changed or passage[first - 1] == words[at - 1]) and similar(passage[first - 1], words[at - 1]):
            first, at = first - 1, at - 1
            changed = passage[first] != words[at]
        changed = False
        while end < n and j < m and (not changed or passage[end] == words[j]) and similar(passage[end], words[j]):
            changed = passage[end] != words[j]
            end, j = end + 1, j + 1
        if (end - first >= LEAST_WORDS, s) > best:
            best, run = (end - first >= LEAST_WORDS, s), (first, end - first)
    return run
