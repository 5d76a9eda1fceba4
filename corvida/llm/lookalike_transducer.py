"""A longest-match transducer over grapheme clusters that brings text to one form in one pass.

The mapping is computed once from the Unicode database and the look-alike letters below, and checked for conflicts:
every cluster has one image and every image is its own image, so the transduction is idempotent. Keys are clusters: a
letter with its marks in any order that composes, a character of another width, a ligature, a space, an invisible sign,
a look-alike with or without marks. The automaton reads a text once, always the longest token: a phonetic notation, a
sign in its native width, a word, or a sign of the mapping. In a word it reads cluster by cluster; whether look-alikes
in it are rewritten depends on the word's script, so they have a second image that the word selects.

The form: composed letters (NFC), ordinary spaces, no invisible characters, ordinary-width letters, digits and
signs, and within a word only letters of that word's script.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import permutations

import regex

# Letters of Greek and Cyrillic that look like a Latin letter, with that letter.
LOOKALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "υ": "u", "ι": "i", "α": "a", "ρ": "p", "κ": "k", "γ": "y",
    "τ": "t", "χ": "x", "ϲ": "c", "ϳ": "j",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d",
    "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "ү": "y", "к": "k", "п": "n", "т": "t", "м": "m", "г": "r",
}
# Letters of Armenian, Cherokee and Lisu that look like a Latin letter, with that letter.
LOOKALIKES |= {
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "Օ": "O", "Ս": "U", "Տ": "S",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P",
    "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ꓮ": "A", "ꓐ": "B", "ꓚ": "C", "ꓓ": "D", "ꓰ": "E", "ꓝ": "F", "ꓖ": "G", "ꓧ": "H", "ꓲ": "I", "ꓙ": "J", "ꓗ": "K", "ꓡ": "L",
    "ꓟ": "M", "ꓠ": "N", "ꓳ": "O", "ꓑ": "P", "ꓣ": "R", "ꓢ": "S", "ꓔ": "T", "ꓴ": "U", "ꓦ": "V", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓜ": "Z",
}
# Latin letters of other alphabets that stand for a letter of Vietnamese or English.
LATIN_STANDINS = {"Ð": "Đ", "Ɖ": "Đ", "ð": "đ", "ɖ": "đ", "ɡ": "g", "ɑ": "a", "ı": "i", "ȷ": "j", "ſ": "s"}
# A whole word of these is ambiguous with real Greek or Cyrillic words, so they count only in mixed words.
WEAK = frozenset("γκτпткмгαινρυχ")

_CJK = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}"
_NATIVE_WIDE = frozenset("！（），．：；？＂＇［］｛｝～＆％＋－／＝＜＞＠＊＃＄｜＿＼＾｀")
_JOINERS_NEEDED = regex.compile(r"[\p{Arabic}\p{Devanagari}\p{Bengali}\p{Sinhala}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Emoji_Presentation}]")


def _width_map() -> dict[str, str]:
    """Full-width, half-width and mathematical forms, ligatures and letters for Roman numbers, by the compatibility decomposition."""
    blocks = [range(0xFF01, 0xFFE7), range(0x1D400, 0x1D800), range(0xFB00, 0xFB07), range(0x2160, 0x2180)]
    found = {}
    for block in blocks:
        for code in block:
            char = chr(code)
            kind = unicodedata.decomposition(char).partition(" ")[0]
            if kind in ("<wide>", "<narrow>", "<font>") or kind == "<compat>" and block[0] in (0xFB00, 0x2160):
                found[char] = unicodedata.normalize("NFKC", char)
    return found


def _accent_map() -> dict[str, str]:
    """Letters with their marks apart, in any order that composes, to the composed letter."""
    found = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0x370, 0x530), *range(0x1F00, 0x2000), *range(0x3040, 0x3100)):
        char = chr(code)
        if unicodedata.normalize("NFC", char) != char:
            found[char] = unicodedata.normalize("NFC", char)
        parts = unicodedata.normalize("NFD", char)
        for base in range(1, len(parts)):
            for marks in permutations(parts[base:]):
                # the first marks may be composed with the letter already, whichever they are
                for composed in range(len(marks) + 1):
                    key = unicodedata.normalize("NFC", parts[:base] + "".join(marks[:composed])) + "".join(marks[composed:])
                    if key != char and unicodedata.normalize("NFC", key) == char:
                        found[key] = char
    return found


def _space_map() -> dict[str, str]:
    return {chr(c): " " for c in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)}


def _invisible_map() -> dict[str, str]:
    codes = (0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F,
             *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x2070), 0x3164, *range(0xFE00, 0xFE10), 0xFEFF, 0xFFA0)
    return {chr(c): "" for c in codes}


_SPACES, _INVISIBLE = _space_map(), _invisible_map()
_WIDTHS = {k: v for k, v in _width_map().items() if k not in _INVISIBLE}


def _letter_map() -> dict[str, str]:
    """Look-alikes with and without marks, to the Latin letter with these marks: the second image, which a word selects."""
    found = dict(LATIN_STANDINS)
    for char, latin in LOOKALIKES.items():
        found[char] = latin
        for mark in "\u0300\u0301\u0302\u0303\u0304\u0306\u0308\u0309\u031b\u0323":
            found[unicodedata.normalize("NFC", char + mark)] = unicodedata.normalize("NFC", latin + mark)
    return found


def compile_mapping() -> tuple[dict[str, str], dict[str, str]]:
    """The clusters' images, and those of letters in words; raises when two rules disagree or an image is rewritten again."""
    mapping: dict[str, str] = {}
    letters = _letter_map()
    for part in (_INVISIBLE, _SPACES, _WIDTHS, _accent_map()):
        for key, image in part.items():
            if mapping.setdefault(key, image) != image:
                raise ValueError(f"two images for {key!r}: {mapping[key]!r} and {image!r}")
    for key, image in (*mapping.items(), *letters.items()):
        if any(c in mapping for c in image) or (key in letters and any(c in letters for c in image)):
            raise ValueError(f"the image of {key!r} is itself rewritten")
    if clash := mapping.keys() & letters.keys() - {k for k in letters if mapping.get(k) in letters}:
        raise ValueError(f"images of two kinds for {clash}")
    return mapping, letters


def _class(chars) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in sorted(chars))


#: For rlike in the JVM: a text without any of these characters is already in form. Combining marks and conjoining
#: jamo stand for the sequences that NFC would compose.
TRIGGER = (
    "["
    + _class({*_SPACES, *_INVISIBLE, *LATIN_STANDINS})
    + r"\x{300}-\x{36f}\x{1100}-\x{11ff}\x{3099}\x{309a}\x{ff01}-\x{ffe6}\x{1d400}-\x{1d7ff}\x{370}-\x{3ff}\x{1f00}-\x{1fff}\x{400}-\x{52f}\x{212a}\x{212b}\x{2126}\x{f900}-\x{faff}\x{fb00}-\x{fb06}\x{2160}-\x{217f}\x{530}-\x{58f}\x{13a0}-\x{13ff}\x{a4d0}-\x{a4ff}]"
)
_TRIGGER = regex.compile(regex.sub(r"\\x\{([0-9a-f]+)\}", lambda m: regex.escape(chr(int(m[1], 16)), special_only=True), TRIGGER))
MAPPING, LETTERS = compile_mapping()
_SCRIPTS = r"\p{Greek}\p{Cyrillic}\p{Armenian}\p{Cherokee}\p{Lisu}"
_FOREIGN, _LATIN = regex.compile(f"[{_SCRIPTS}]"), regex.compile(r"\p{Latin}")
_UNSEEN = "".join(map(regex.escape, sorted(_INVISIBLE)))
_LETTER_LIKE = rf"[\p{{L}}\p{{M}}\p{{N}}{_UNSEEN}]"
#: One cluster of a word: a letter with its marks and what is invisible.
_CLUSTER = regex.compile(rf"[\p{{L}}\p{{N}}][\p{{M}}{_UNSEEN}\u1160-\u11ff]*|[\p{{M}}{_UNSEEN}]+")
_PASS = regex.compile(
    r"(?P<spoken>[\[/⟨][^\[\]/⟨⟩\s]{1,12}[\]/⟩])"
    rf"|(?P<native>(?<=[{_CJK}、。「」『』）・ー\d])[！（），．：；？～]|（(?=[{_CJK}]))"
    rf"|(?P<word>{_LETTER_LIKE}+)"
    rf"|(?P<sign>[{''.join(regex.escape(k) for k in sorted(MAPPING) if len(k) == 1)}][\p{{M}}]*)"
)


def _image(cluster: str, joined: bool) -> str:
    """What the mapping makes of one cluster; joined: of a script whose letters are joined by invisible signs."""
    image = MAPPING.get(cluster)
    if image is None or (joined and cluster in "\u200c\u200d\ufe0f"):
        kept = (c if joined and c in "\u200c\u200d\ufe0f" else MAPPING.get(c, c) for c in cluster)
        image = unicodedata.normalize("NFC", "".join(kept))
    return MAPPING.get(image, image)


@lru_cache(maxsize=200_000)
def _word(word: str) -> str:
    """The clusters of one word: of two scripts in it the Latin one holds; a word wholly of look-alikes is Latin."""
    joined = _JOINERS_NEEDED.search(word) is not None
    clusters = [_image(c, joined) for c in _CLUSTER.findall(word)]
    plain = unicodedata.normalize("NFC", "".join(clusters))
    foreign = [c for c in plain if _FOREIGN.match(c)]
    if foreign:
        if _LATIN.search(plain):
            selected = all(c in LETTERS or _base(c) in LOOKALIKES for c in foreign)
        else:
            selected = all(c in LOOKALIKES for c in foreign) and not any(c in WEAK for c in foreign)
        if selected:
            clusters = [LETTERS.get(c) or "".join(LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFD", c)) for c in regex.findall(r"\X", plain)]
            return unicodedata.normalize("NFC", "".join(clusters))
    return "".join(LATIN_STANDINS.get(c, c) for c in plain)


def _base(char: str) -> str:
    return unicodedata.normalize("NFD", char)[0]


def _step(m: regex.Match) -> str:
    kind, token = m.lastgroup, m[0]
    if kind == "word":
        return token if token.isascii() else _word(token)
    if kind == "native":
        return token
    if kind == "spoken":  # its letters stay; what is invisible or of another width does not
        return unicodedata.normalize("NFC", "".join(MAPPING.get(c, c) for c in token))
    if token in "\u200c\u200d\ufe0f":
        around = m.string[max(0, m.start() - 1) : m.start()] + m.string[m.end() : m.end() + 1]
        if _JOINERS_NEEDED.search(around):
            return token
    return _image(token, False)


def canonical(text: str | None) -> str | None:
    """The one form of a text. None stays None and an empty text stays empty."""
    if not text or not _TRIGGER.search(text):
        return text
    out = _PASS.sub(_step, text)
    # marks that belong to a sign outside of the mapping
    return out if unicodedata.is_normalized("NFC", out) else unicodedata.normalize("NFC", out)
