"""Repair of text that was decoded with the wrong character encoding.

Characters are mapped back to the bytes of a legacy code page; a byte-structure automaton finds the maximal spans of
well-formed multibyte sequences; only those spans are decoded. Three structures are known: UTF-8, the double-byte
code pages of East Asia, and the single-byte Vietnamese code page, whose structure is that of a syllable.
Spans whose bytes were lost (replacement characters, question marks within words) can be found but not restored.
"""

from __future__ import annotations

import codecs
import re
from dataclasses import dataclass, field
from functools import lru_cache

import regex

#: Code pages in which the bytes of UTF-8 were read, likeliest first.
SINGLE_BYTE_PAGES = ("cp1252", "mac_roman", "cp437", "cp850", "cp1258", "cp1251", "cp1250", "koi8_r", "cp866", "cp1254", "iso8859_15")
#: Double-byte encodings with the code page in which their bytes were read.
DOUBLE_BYTE = (("shift_jis", "cp1252"), ("euc_kr", "cp1252"), ("gb2312", "cp1252"), ("big5", "cp1252"))

UTF8_AUTOMATON = (
    "(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    "|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})"
)
_UTF8_SPAN = regex.compile(UTF8_AUTOMATON + "+")
_UTF8_ONE = regex.compile(UTF8_AUTOMATON)
_HIGH_RUN = re.compile("(?:[\x80-\u0192\u02c6-\u02dc\u2013-\u203a\u20ac\u2122][@-~]?){4}")
_SJIS_SPAN = regex.compile("(?:[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc])+")
_EUC_SPAN = regex.compile("(?:[\xa1-\xfe][\xa1-\xfe]|[ .,?!])*[\xa1-\xfe][\xa1-\xfe]")
_BIG5_SPAN = regex.compile("(?:[\xa1-\xf9][\x40-\x7e\xa1-\xfe])+")

# The single-byte Vietnamese code page TCVN 5712 (lower-case letters, then the capitals it has).
TCVN3 = dict(
    zip(
        bytes.fromhex("a8a9aaabacadae b5b6b7b8b9 bbbcbdbe c6c7c8c9cacb cccecfd0d1 d2d3d4d5d6 d7d8dcddde dfe1e2e3e4 e5e6e7e8e9 eaebecedee eff1f2f3f4 f5f6f7f8f9 fafbfcfdfe a1a2a3a4a5a6a7").decode("latin-1"),
        "ăâêôơưđ" "àảãáạ" "ằẳẵắ" "ặầẩẫấậ" "èẻẽéẹ" "ềểễếệ" "ìỉĩíị" "òỏõóọ" "ồổỗốộ" "ờởỡớợ" "ùủũúụ" "ừửữứự" "ỳỷỹýỵ" "ĂÂÊÔƠƯĐ",
    )
)
_SYLLABLE = regex.compile(
    r"(?i)^(?:ngh|ng|nh|ch|gh|gi|kh|ph|qu|th|tr|[bcdđghklmnpqrstvx])?"
    r"[aăâeêioôơuưyàảãáạằẳẵắặầẩẫấậèẻẽéẹềểễếệìỉĩíịòỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵ]{1,3}(?:ch|ng|nh|[cmnpt])?$"
)
_TONED = regex.compile(r"(?i)[àảãáạằẳẵắặầẩẫấậèẻẽéẹềểễếệìỉĩíịòỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵăâêôơưđ]")
#: Signs of the code page that no word of a European language holds next to a letter.
_TCVN_SIGN = regex.compile("(?<=[^\\W\\d_])[\xa8\xa9\xab\xac\xad\xae\xb5-\xb9\xbb-\xbe\xd7\xf7\xde\xa1-\xa7]|[\xa8\xa9\xab\xac\xad\xae\xb5-\xb9\xbb-\xbe\xd7\xf7\xde\xa1-\xa7](?=[a-z])")
_TCVN_WORD = regex.compile("[A-Za-z\xa1-\xff]+")

#: Characters that text of the corpus is made of; a decoded sequence outside of them was no garbled text.
_PLAUSIBLE = regex.compile(
    "[\u00a0-\u017fƠơƯưƒ\u0218-\u021b\u1ea0-\u1ef9\u0300\u0301\u0302\u0303\u0306\u0309\u031b\u0323\u2010-\u203a\u20ab\u20ac\u2122\u2190-\u2193"
    "\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7a3\uff01-\uff5e\u1100-\u11ff\U0001f300-\U0001faff\ufeff]+"
)
_WIDE = regex.compile("[\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7a3\uff01-\uff5e]")
_TYPOGRAPHIC = frozenset("“”‘’…–—»«›‹„‚•™ ")
LOST = regex.compile(r"�|(?<=\p{L})\?(?=\p{L})|(?<=\p{L})\?\?(?=\p{L}|\?|\s)|(?<![\p{L}\p{N}?!.…])\?+(?=\p{Ll})")
_LINK = regex.compile(r"\S*(?:://|www\.|\w[?&]\w+=)\S*")
_OTHER = "࿿"


@lru_cache(maxsize=None)
def _to_bytes(page: str) -> dict[int, str]:
    """str.translate table from the characters of a code page to their bytes; other characters become one sentinel."""
    table: dict[int, str] = {}
    for byte in range(0x80, 0x100):
        char = codecs.decode(bytes([byte]), page, "replace")
        if char != "�":
            table[ord(char)] = chr(byte)
        if page == "cp1252" and 0x80 <= byte < 0xA0:
            table[byte] = chr(byte)  # what the page leaves undefined passes as a control character
    return table


class _Translate(dict):
    def __init__(self, page: str):
        super().__init__(_to_bytes(page))

    def __missing__(self, code: int) -> str:
        value = chr(code) if code < 0x80 else _OTHER
        self[code] = value
        return value


@lru_cache(maxsize=None)
def _translate(page: str) -> _Translate:
    return _Translate(page)


@lru_cache(maxsize=None)
def _pair(page: str) -> re.Pattern:
    """Two neighbours that can begin a UTF-8 sequence read in this page: a cheap test before the automaton."""
    table = _to_bytes(page)
    lead = "".join(re.escape(chr(c)) for c, b in sorted(table.items()) if "\xc2" <= b <= "\xf4")
    follow = "".join(re.escape(chr(c)) for c, b in sorted(table.items()) if "\x80" <= b <= "\xbf")
    return re.compile(f"[{lead}][{follow}]")


@dataclass
class Repair:
    text: str
    spans: int = 0
    lost: int = 0
    pages: list[str] = field(default_factory=list)

    @property
    def garbled(self) -> bool:
        return self.spans > 0 or self.lost > 0


@lru_cache(maxsize=100_000)
def _word_spans(word: str, page: str) -> tuple[tuple[int, int, str, bool], ...]:
    """(start, end, decoded, sure) of the spans of garbled UTF-8 in one word.

    A word counts whole: if some of its characters can't be bytes of the page, or most of its high bytes are in no
    sequence, an accented capital before a quotation mark is more likely than garbled text.
    """
    mapped = word.translate(_translate(page))
    sequences = len(_UTF8_ONE.findall(mapped))
    if not sequences:
        return ()
    stray = [c for c in _UTF8_ONE.sub("", mapped) if c > "\x7f"]
    found = []
    for m in _UTF8_SPAN.finditer(mapped):
        a, b = m.span()
        try:
            decoded = m[0].encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            continue
        # signs of the page that take three bytes may be the reading of a reading
        rest = "".join(c for c in decoded if c < "\u0800" or ord(c) not in _to_bytes(page))
        if rest and not any("\x80" <= c <= "\x9f" for c in decoded) and not _PLAUSIBLE.fullmatch(rest):
            continue
        wide = _WIDE.search(decoded) is not None
        if wide and len(decoded) < 2:
            continue
        if stray and not (wide and len(decoded) > 3) and len(stray) > sequences:
            continue
        if _OTHER in stray and "\ufffd" not in word and not wide:
            continue
        one = b - a == 2
        sure = not (one and word[a + 1] in _TYPOGRAPHIC and word[a].isalpha() and not (b < len(word) and word[b].isalpha()))
        if page != "cp1252" and one and not ("\xa1" <= decoded <= "\u017f" or decoded in "ƠơƯư"):
            sure = False
        found.append((a, b, decoded, sure))
    return tuple(found)


_WORD = regex.compile(r"[^ \t\r\n\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}、。「」！？，．：；（）・ー]+")


def _utf8_spans(text: str, page: str) -> list[tuple[int, int, str, bool]]:
    """The spans of one page in a text; none when all of them are unsure."""
    if not _pair(page).search(text):
        return []
    found = []
    for m in _WORD.finditer(text):
        word = m[0]
        if not word.isascii():
            found += [(m.start() + a, m.start() + b, decoded, sure) for a, b, decoded, sure in _word_spans(word, page)]
    return found if any(s for *_, s in found) else []


def _replace(text: str, spans) -> str:
    out, at = [], 0
    for a, b, decoded, *_ in spans:
        out += [text[at:a], decoded]
        at = b
    return "".join([*out, text[at:]])


def _repair_utf8(text: str, state: Repair) -> str:
    while True:  # each round undoes one wrong reading and shortens the text; the rounds end when none is found
        best: list = []
        best_page = ""
        for page in SINGLE_BYTE_PAGES:
            spans = _utf8_spans(text, page)
            if sum(b - a for a, b, *_ in spans) > sum(b - a for a, b, *_ in best):
                best, best_page = spans, page
        if not best:
            break
        state.spans += len(best)
        state.pages.append(f"utf-8 as {best_page}")
        text = _replace(text, best)
    return text


def _repair_double_byte(text: str, state: Repair) -> str:
    if not _HIGH_RUN.search(text):
        return text
    best: list = []
    best_score, best_name = 0.0, ""
    for encoding, page in DOUBLE_BYTE:
        mapped = text.translate(_translate(page))
        automaton = {"shift_jis": _SJIS_SPAN, "big5": _BIG5_SPAN}.get(encoding, _EUC_SPAN)
        spans, score = [], 0.0
        for m in automaton.finditer(mapped):
            raw = m[0]
            high = sum(c > "\x7f" for c in raw)
            if high < 8 or (encoding == "shift_jis" and not regex.search("[\x82\x83][\x9f-\xf1\x40-\x96]", raw)):
                continue
            try:
                decoded = raw.encode("latin-1").decode(encoding)
            except UnicodeDecodeError:
                continue
            script = {"shift_jis": r"[\p{Hiragana}\p{Katakana}]", "euc_kr": r"\p{Hangul}"}.get(encoding, r"\p{Han}")
            share = len(regex.findall(script, decoded)) / max(1, sum(not c.isspace() for c in decoded))
            if share < (0.3 if encoding == "shift_jis" else 0.6):
                continue
            spans.append((m.start(), m.end(), decoded, True))
            score += len(raw) * share
        if score > best_score:
            best, best_score, best_name = spans, score, encoding
    if best:
        state.spans += len(best)
        state.pages.append(f"{best_name} as cp1252")
        text = _replace(text, best)
    return text


def _repair_tcvn3(text: str, state: Repair) -> str:
    """Words of which each high byte maps to a Vietnamese letter and that become syllables, near one with a sign of the page."""
    if len(_TCVN_SIGN.findall(text)) < 1:
        return text
    mapped = text.translate(_translate("cp1252"))
    table = str.maketrans(TCVN3)
    words = []
    for m in _TCVN_WORD.finditer(mapped):
        raw = m[0]
        high = [c for c in raw if c > "\x7f"]
        if not high or any(c not in TCVN3 for c in high):
            continue
        decoded = raw.translate(table)
        if not _SYLLABLE.match(decoded) or not _TONED.search(decoded):
            continue
        words.append((m.start(), m.end(), decoded, bool(_TCVN_SIGN.search(text[max(0, m.start() - 1) : m.end() + 1]))))
    signs = [w for w in words if w[3]]
    if len(signs) < 2:
        return text
    first, last = signs[0][0], signs[-1][1]
    spans = [w for w in words if first - 60 <= w[0] <= last + 60 and (w[3] or not _SYLLABLE.match(text[w[0] : w[1]]))]
    state.spans += len(spans)
    state.pages.append("tcvn3 as cp1252")
    return _replace(text, spans)


_HAN_IN_WORD = regex.compile(r"[^\s\p{P}]*(?:[A-Za-z]\p{Han}|\p{Han}[A-Za-z])[^\s]*")
_CYRILLIC_IN_WORD = regex.compile(r"[\p{L}’']*(?:\p{Latin}[\p{Cyrillic}]|\p{Cyrillic}[\p{Latin}])[\p{L}’']*")
_CYRILLIC_WORD = regex.compile(r"(?<!\p{L})\p{Cyrillic}(?!\p{L})")
_BYTES_UTF8 = regex.compile(UTF8_AUTOMATON.encode("latin-1") + b"+")


def _repair_gbk(text: str, state: Repair) -> str:
    """UTF-8 of a Latin script whose bytes were read in pairs as the Chinese code page: Han characters inside words."""
    if not _HAN_IN_WORD.search(text):
        return text
    count = 0

    def word(m: regex.Match) -> str:
        nonlocal count
        raw = m[0].encode("gbk", "replace")

        def span(b: regex.Match) -> bytes:
            nonlocal count
            decoded = b[0].decode("utf-8", "replace")
            if _WIDE.search(decoded) or not _PLAUSIBLE.fullmatch(decoded):
                return b[0]
            count += 1
            return b"\x00" + decoded.encode("utf-16-be").hex().encode() + b"\x01"

        marked = _BYTES_UTF8.sub(span, raw).decode("gbk", "replace")
        return regex.sub("\x00([0-9a-f]*)\x01", lambda h: bytes.fromhex(h[1]).decode("utf-16-be"), marked)

    fixed = _HAN_IN_WORD.sub(word, text)
    if not count:
        return text
    state.spans += count
    state.pages.append("utf-8 as gbk")
    return fixed


def _repair_cyrillic(text: str, state: Repair) -> str:
    """Accented Latin letters whose single bytes were read in a Cyrillic page: both scripts in one word."""
    words = _CYRILLIC_IN_WORD.findall(text)
    foreign = {c for w in words for c in w if "\u0400" <= c <= "\u045f"}
    if not foreign or foreign <= _LOOK_ALIKE:
        return text
    for page in ("cp1251", "koi8_r", "cp866"):
        try:
            table = {ord(c): c.encode(page).decode("cp1252") for c in foreign}
        except UnicodeError:
            continue
        if all("\xc0" <= c <= "\xff" and c not in "×÷" for c in table.values()):
            count = 0

            def word(m: regex.Match) -> str:
                nonlocal count
                count += 1
                return "".join(c.encode(page).decode("cp1252") if "\u0400" <= c <= "\u045f" else c for c in m[0])

            fixed = _CYRILLIC_WORD.sub(word, _CYRILLIC_IN_WORD.sub(word, text))
            state.spans += count
            state.pages.append(f"cp1252 as {page}")
            return fixed
    return text


#: Letters of Cyrillic that look Latin: a word of both scripts with only these was typed so, not misread.
_LOOK_ALIKE = frozenset("аеорсухіѕјАВЕКМНОРСТХУІЅЈ")


#: Letters and marks of clean text. Whatever was misread holds a character outside of them: the continuation bytes of a
#: sequence, or its lead byte, are signs in every page.
_SAFE = frozenset(
    map(chr, (*range(0x80), *range(0x1EA0, 0x1EFA), *range(0xDF, 0xF7), *range(0xF8, 0x100), *range(0xC0, 0xC3), *range(0xC8, 0xCB), 0xCC, 0xCD, *range(0xD2, 0xD6), 0xD9, 0xDA, 0xDD))
) | frozenset("ĂăĐđĨĩŨũƠơƯưœ“”‘’…–—°")
_ASKED = re.compile(r"\?(?:\?|(?=[^\s\"'”’)\]»]))|\s\?[^\W\d_]")


def may_be_garbled(text: str) -> bool:
    """False only for texts in which nothing can be garbled: a cheap test for every text."""
    if text.isascii():
        return "?" in text and _ASKED.search(text) is not None
    odd = set(text) - _SAFE
    if odd and any(c < "\u3000" or c == "\ufffd" for c in odd):
        return True
    if odd and _HAN_IN_WORD.search(text):
        return True
    return "?" in text and _ASKED.search(text) is not None


def repair(text: str) -> Repair:
    """The text with its garbled spans decoded, and how many were found or lost."""
    state = Repair(text)
    fixed = _repair_gbk(text, state)
    fixed = _repair_utf8(fixed, state)
    fixed = _repair_double_byte(fixed, state)
    if not (state.spans and "�" in fixed):
        fixed = _repair_tcvn3(fixed, state)
    fixed = _repair_cyrillic(fixed, state)
    state.text = fixed
    if "\ufffd" in fixed or ("?" in fixed and _ASKED.search(fixed)):
        state.lost = len(LOST.findall(_LINK.sub("", fixed)))
    return state
