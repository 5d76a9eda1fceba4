"""What several operators of the subpackage share."""

from __future__ import annotations

import unicodedata

import regex

from corvida.llm.lookalike_transducer import canonical

#: A word is a run of letters and digits; of scripts written without spaces each character is one.
WORD = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]|[^\W_\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]+")
_MARKS = regex.compile(r"\p{M}+")


def plain(text: str) -> str:
    """Lower case without accents and other marks; đ becomes d."""
    text = unicodedata.normalize("NFD", canonical(text).lower()).replace("đ", "d")
    return text if text.isascii() else _MARKS.sub("", text)


def plain_words(text: str) -> list[str]:
    return WORD.findall(plain(text))
