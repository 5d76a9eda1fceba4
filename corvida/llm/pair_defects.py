"""Defects of a prompt's response: empty, refusing, copying, in the wrong language, or cut off.

A pushdown parser finds what a response leaves open (fences, brackets, quotations, markup); greedy string tiling
measures how much of it repeats the prompt; a grammar recognises sentences that decline; language profiles and scripts
tell its language. Whether the prompt's content is rendered to the end is told by how long a rendering should be: each
prompt word and pair of words adds its own letters, with weights fitted on the pairs, and by whether a sentence can end
in the response's last word.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import regex

from corvida.llm.common import plain_words
from corvida.llm.langid import Identifier

KINDS = ("empty_answer", "refusal", "copies_prompt", "wrong_language", "truncated_answer")

# What stands for "nothing" in exported data.
_PLACEHOLDER = regex.compile(
    r"(?i)[\W_]*(?:n\s*/\s*a|na|nan|null|none|nil|undefined|empty|blank|tbd|todo|no (?:answer|response|translation|output|content)"
    r"|translation|placeholder|trống|rỗng|chưa có|(?:không có|chưa có) (?:bản dịch|câu trả lời|nội dung|kết quả))[\W_]*"
)
_LETTER = regex.compile(r"[\p{L}\p{N}]")


def is_empty(response: str) -> bool:
    return not _LETTER.search(response) or _PLACEHOLDER.fullmatch(response) is not None


# The grammar of refusals: someone who answers, that they will not or cannot, and what was asked of them. Speech that
# refuses has other objects, so the object must be the request or the text itself.
_EN_SELF = r"(?:i|we|this (?:model|system|assistant)|the (?:model|system|assistant)|my (?:guidelines|policy|policies))"
_EN_NOT = (
    r"(?:can(?:not|'t| not)|could(?:n't| not)|won't|will not|(?:am|are|is|'m|'re) (?:not (?:able|allowed|permitted|in a position)|unable)|do(?:es)?n't|do(?:es)? not"
    r"|must (?:refuse|decline)|have to (?:refuse|decline)|need to (?:refuse|decline)|(?:refuse|decline|regret)|'d rather not|would rather not|(?:prefer|choose) not|not (?:be )?(?:able|possible|allowed|permitted))"
)
_EN_OBJECT = (
    r"(?:translat\w*|passage|texts?|request\w*|content|reply|item|message|this(?=\s*(?:[,.;!\]\)]|$|because|as|since|right now))|that(?=\s*(?:[,.;!\]\)]|$|because))|question|answer|response|task|instruction\w*|sentence|input|material|guidelines|polic\w+)"
)
_VI_SELF = r"(?:tôi|mình|em|chúng tôi|chúng em|hệ thống|trợ lý|mô hình)"
_VI_NOT = r"(?:không thể|chưa thể|không được phép|không cho phép|không được|xin từ chối|phải từ chối|từ chối|không có khả năng|không đủ khả năng|không tiện|xin phép không|không hỗ trợ|chưa hỗ trợ|không giúp được|rất tiếc không)"
_VI_OBJECT = r"(?:dịch|bản dịch|văn bản|nội dung|yêu cầu|câu này|câu trả lời|câu hỏi|đoạn (?:này|văn|trên|khác)|tin nhắn|thông tin|mục này|nhạy cảm|quy định|chính sách)"
_REFUSALS = (
    regex.compile(rf"(?i)\b{_EN_SELF}\b[^.?!]{{0,25}}?\s?{_EN_NOT}\b[^.?!]{{0,60}}?\b{_EN_OBJECT}"),
    regex.compile(rf"(?i)\bit (?:is|'s) (?:not|im)\s?possible for (?:me|us)\b[^.?!]{{0,60}}?\b{_EN_OBJECT}"),
    regex.compile(rf"(?i)\b{_VI_SELF}\b[^.?!]{{0,20}}?{_VI_NOT}\b[^.?!]{{0,50}}?\b{_VI_OBJECT}"),
)
_SENTENCE = regex.compile(r"(?<=[.?!…])\s+")


def is_refusal(response: str) -> bool:
    """Whether a sentence of the response declines what was asked.

    A greeting or regret may come first; courtesies and advice may follow, however long.
    """
    flat = response.replace("’", "'").strip().strip("[](){}\"“”*_ \n")
    return any(p.search(s) for s in _SENTENCE.split(flat) for p in _REFUSALS)


def tiles(prompt: list[str], response: list[str], least: int = 3) -> tuple[int, int]:
    """Greedy string tiling: prompt and response words covered by common runs of at least `least` words.

    In each round all maximal matches of words that are not marked yet are found; the longest are marked first, and the
    rounds end when none of `least` words is left. A response may repeat the prompt, so when the prompt is used up it
    may be tiled again: the words of the response are marked for good, those of the prompt for one pass.
    """
    places: dict[str, list[int]] = {}
    for i, word in enumerate(prompt):
        places.setdefault(word, []).append(i)
    marked, covered = [False] * len(response), [False] * len(prompt)
    while True:
        free, found = [True] * len(prompt), False
        while True:
            longest, matches = least, []
            for j in range(len(response)):
                if marked[j]:
                    continue
                for i in places.get(response[j], ()):
                    if not free[i] or (i and j and free[i - 1] and not marked[j - 1] and prompt[i - 1] == response[j - 1]):
                        continue  # taken, or no maximal match begins here
                    n = 1
                    while i + n < len(prompt) and j + n < len(response) and free[i + n] and not marked[j + n] and prompt[i + n] == response[j + n]:
                        n += 1
                    if n > longest:
                        longest, matches = n, [(i, j)]
                    elif n == longest:
                        matches.append((i, j))
            if not matches:
                break
            for i, j in matches:
                if all(free[i : i + longest]) and not any(marked[j : j + longest]):
                    found = True
                    free[i : i + longest] = [False] * longest
                    covered[i : i + longest] = [True] * longest
                    marked[j : j + longest] = [True] * longest
        if not found:
            return sum(covered), sum(marked)


def copies(prompt: list[str], response: list[str]) -> bool:
    if not prompt or not response:
        return False
    if prompt == response:
        return True
    common = set(prompt) & set(response)
    if len(common) < 0.6 * len(set(prompt)):
        return False
    of_prompt, of_response = tiles(prompt, response, min(3, len(prompt)))
    return of_prompt >= 0.75 * len(prompt) and of_response >= 0.6 * len(response)


_OPENERS = {"(": ")", "[": "]", "{": "}", "“": "”", "«": "»", "「": "」", "『": "』", "（": "）"}
_TAG = regex.compile(r"<(/?)([A-Za-z][\w-]*)[^<>]*?(/?)>")
_TOKEN = regex.compile(r"```|</?[A-Za-z][^<>]*>|[()\[\]{}“”«»「」『』（）\"`]|\*\*")
_LONE_TAGS = frozenset(("br", "hr", "img", "input", "meta", "link"))


def left_open(text: str) -> list[str]:
    """What the text opens and does not close, outermost first: a pushdown automaton over fences, brackets and markup.

    Inside a fence only the fence's end counts. A closer that matches nothing is ignored (smileys, list marks).
    """
    stack: list[str] = []
    for m in _TOKEN.finditer(text):
        token = m[0]
        if stack and stack[-1] in ("```", "`"):
            if token == stack[-1]:
                stack.pop()
            continue
        if token in ("```", "`", '"', "**"):
            if token in stack:
                del stack[stack.index(token) :]
            else:
                stack.append(token)
        elif token[0] == "<":
            closing, name, alone = _TAG.match(token).groups()
            name = name.lower()
            if name in _LONE_TAGS or alone:
                continue
            if closing:
                if f"<{name}>" in stack:
                    del stack[stack.index(f"<{name}>") :]
            else:
                stack.append(f"<{name}>")
        elif token in _OPENERS:
            stack.append(token)
        else:
            opener = next(o for o, c in _OPENERS.items() if c == token)
            if opener in stack:
                del stack[len(stack) - 1 - stack[::-1].index(opener) :]
    return stack


_ENDED = regex.compile(r"[.?!。？！]['\"”’»」』）)\]}*_`\s]*$")
_TRAILS = regex.compile(r"(?:\.{2,}|…|[-–—,;:])['\"”’)\]\s]*$|\[\s*(?:\.{3}|…)\s*\]\s*$|�\s*$")


def features(words: list[str]) -> list:
    return [*words, *zip(words, [*words[1:], "$"])]


#: Words and pairs of words that are met less often tell nothing of where sentences end.
LEAST_SEEN = 3


@dataclass
class Rendering:
    """How a complete response looks: letters by prompt features, and words in which a sentence ends."""

    weights: dict
    finals: dict

    def letters(self, prompt: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features(prompt))

    def ends(self, words: list[str]) -> float:
        """How often a sentence ends in these two last words, or in the last one where the two are new."""
        return self.finals.get(tuple(words[-2:]), self.finals.get(words[-1], 0.0))

    def known(self, prompt: list[str]) -> float:
        return sum(w in self.weights for w in prompt) / max(1, len(prompt))


@dataclass
class Part:
    """What one group of pairs says: by prompt feature its letters times the weight of its pairs, and that weight; by word
    and two words of responses how often they occur, and how often a whole response ends in them. Parts add up."""

    letters: dict
    ends: dict


def fit_rendering(pairs: list[tuple[str, str]]) -> Rendering:
    part = fit_part(pairs)
    return rendering(part.letters, part.ends)


def rendering(letters: dict, ends: dict) -> Rendering:
    """The rendering that parts, added up, stand for: the mean of their letters by weight, and the shares of endings."""
    means = {f: total / weight for f, (total, weight) in letters.items()}
    return Rendering({f: x for f, x in means.items() if abs(x) > 1e-3 or isinstance(f, str)}, {w: ended / n for w, (n, ended) in ends.items() if n >= LEAST_SEEN})


def fit_part(pairs: list[tuple[str, str]], rounds: int = 3, steps: int = 40, ridge: float = 1.0) -> Part:
    """Least squares of the response's letters on the prompt's words and word pairs (conjugate gradients).

    Pairs far from the fit are given little weight in the next round, so that defective ones do not bend it.
    """
    index: dict = {}
    rows, columns, lengths, last = [], [], [], []
    seen: Counter = Counter()
    for n, (prompt, response) in enumerate(pairs):
        words = plain_words(response)
        lengths.append(sum(map(len, words)))
        for f in features(plain_words(prompt)):
            rows.append(n)
            columns.append(index.setdefault(f, len(index)))
        seen.update(words)
        seen.update(zip(words, words[1:]))
        last.append(tuple(words[-2:]))
    n, m = len(pairs), len(index)
    r, c, y = np.array(rows, int), np.array(columns, int), np.array(lengths, float)
    weight, x, ratio = np.ones(n), np.zeros(m), np.zeros(n)
    for _ in range(rounds if n else 0):
        x = np.zeros(m)
        residual = weight * y
        s = np.bincount(c, (weight * residual)[r], m)
        p, norm = s.copy(), s @ s
        for _ in range(steps):
            if norm < 1e-9:
                break
            q = weight * np.bincount(r, p[c], n)
            step = norm / (q @ q + ridge * (p @ p))
            x += step * p
            residual -= step * q
            s = np.bincount(c, (weight * residual)[r], m) - ridge * x
            norm, before = s @ s, norm
            p = s + norm / before * p
        ratio = y / np.maximum(1, np.bincount(r, x[c], n))
        weight = np.where(np.abs(ratio - 1) < 0.15, 1.0, 0.02)
    # speech that breaks off is rendered so: whole by its length, though without a full stop
    whole = [w for w, near in zip(last, (ratio > 0.985) & (ratio < 1.05)) if w and near]
    ended = Counter(whole) + Counter(w[-1] for w in whole)
    of = np.bincount(c, weight[r], m)
    return Part({f: (float(x[i] * of[i]), float(of[i])) for f, i in index.items()}, {w: (n, ended[w]) for w, n in seen.items()})


#: Shares of the expected letters below which a response is cut: one that ends like a sentence; and one that does not,
#: by how often a sentence ends in its last two words.
ENDED_SHARE = 0.72
OPEN_SHARES = ((0.04, 0.9), (0.008, 0.95), (0.0, 0.99))
LEAST_LETTERS = 12


def is_truncated(prompt_text: str, prompt: list[str], response: str, words: list[str], rendering: Rendering) -> bool:
    if left_open(response) and not left_open(prompt_text):
        return True
    expected = rendering.letters(prompt)
    if expected < LEAST_LETTERS or rendering.known(prompt) < 0.5:
        return False
    share = sum(map(len, words)) / expected
    trails = _TRAILS.search(response) is not None and not _TRAILS.search(prompt_text)
    if _ENDED.search(response) and not trails:
        return share < ENDED_SHARE
    ends = 0.0 if trails else rendering.ends(words)
    return share < next(limit for least, limit in OPEN_SHARES if ends >= least)


_NAME_OR_FIGURE = regex.compile(r"\p{Lu}[\p{L}’']*|\p{N}[\p{N}.,:/%]*")
_WORDS = regex.compile(r"[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}’'.,:/%-]*")


def is_untranslatable(prompt_text: str, prompt: list[str], rendering: Rendering) -> bool:
    """A prompt of names and figures only: no word of it is one that renderings were learned for."""
    if all(_NAME_OR_FIGURE.fullmatch(w.strip(".,:")) for w in _WORDS.findall(prompt_text)) and len(prompt) <= 12:
        return True
    return rendering.known(prompt) < 0.25


def defect(prompt_text: str, response: str, question_response: str | None, expected: str, identifier: Identifier, rendering: Rendering) -> str | None:
    """The first defect that holds, in the order of KINDS; None for a usable response."""
    if is_empty(response):
        return None if is_empty(prompt_text) else "empty_answer"
    if is_refusal(response) and not is_refusal(prompt_text):
        return "refusal"
    prompt, words = plain_words(prompt_text), plain_words(response)
    if prompt:
        if copies(prompt, words):
            return None if is_untranslatable(prompt_text, prompt, rendering) else "copies_prompt"
        if question_response and len(words) > 2 and copies(plain_words(question_response), words):
            return "copies_prompt"
    stretches = identifier.stretches(response)
    total = sum(s.words for s in stretches)
    own = sum(s.words for s in stretches if s.lang == expected)
    if total and own < 0.3 * total and not is_untranslatable(prompt_text, prompt, rendering):
        return "wrong_language"
    if prompt and words and is_truncated(prompt_text, prompt, response, words, rendering):
        return "truncated_answer"
    return None
