"""Scalar text functions as Column expressions; only Unicode composition, which Spark lacks, is a vectorised UDF."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters with Vietnamese marks; the second class leaves out those that other languages use as well.
VI_MARKED = "[àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ]"
VI_EXCLUSIVE = "[ảạăằắẳẵặầấẩẫậẻẽẹềếểễệỉịỏọồốổỗộơờớởỡợủụưừứửữựỳỷỹỵđ]"
# Toned vowels by tone, in the order of the plain vowels.
PLAIN_VOWELS = "aăâeêioôơuưy"
TONED = {
    "sac": "áắấéếíóốớúứý",
    "huyen": "àằầèềìòồờùừỳ",
    "hoi": "ảẳẩẻểỉỏổởủửỷ",
    "nga": "ãẵẫẽễĩõỗỡũữỹ",
    "nang": "ạặậẹệịọộợụựỵ",
}
#: Characters that belong to a word where a lexicon entry must end at a boundary.
WORD_CLASS = r"\p{L}\p{N}_\x{00C0}-\x{1EF9}"


#: Characters without any of which a text is composed already: marks, conjoining jamo, and what never stays in NFC.
UNCOMPOSED = (
    r"[\p{M}\x{1100}-\x{11ff}\x{0340}-\x{0387}\x{0958}-\x{095f}\x{09dc}-\x{09df}\x{0a33}-\x{0a5e}\x{0b5c}\x{0b5d}\x{0f43}-\x{0fb9}\x{1f00}-\x{2001}"
    r"\x{2126}-\x{212b}\x{2329}\x{232a}\x{2adc}\x{f900}-\x{faff}\x{fb1d}-\x{fb4e}\x{1d15e}-\x{1d1c0}\x{2f800}-\x{2fa1d}]"
)


@F.pandas_udf(StringType())
def _composed(values: pd.Series) -> pd.Series:
    return values.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(col: Column) -> Column:
    """Composed letters. Only texts with a character that composition may touch are sent to Python; others go as null."""
    return F.coalesce(_composed(F.when(col.rlike(UNCOMPOSED), col)), col)


def is_blank(col: Column) -> Column:
    """Null or without a visible character. Finalising uses isNull instead: an empty value is a value there."""
    return F.coalesce(F.trim(col) == "", F.lit(True))


def lowered(col: Column) -> Column:
    return F.lower(nfc(col))


def normalized(col: Column) -> Column:
    """Composed, lower case, only letters and digits, single spaces; null becomes ''."""
    kept = F.regexp_replace(F.replace(lowered(F.coalesce(col, F.lit(""))), F.lit("_"), F.lit(" ")), r"[^\p{L}\p{N}\s]", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def words(normal: Column) -> Column:
    """Words of a normalised text; none for ''."""
    return F.filter(F.split(normal, " "), lambda w: w != "")


def raw_words(col: Column) -> Column:
    """Words between white space of a text as it is."""
    return F.filter(F.split(F.regexp_replace(col, r"[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+", " "), " "), lambda w: w != "")


def has_marks(col: Column) -> Column:
    return F.lower(col).rlike(VI_MARKED)


def has_exclusive_marks(col: Column) -> Column:
    return F.lower(col).rlike(VI_EXCLUSIVE)


def looks_vietnamese(col: Column, least_share: float = 0.15, detected: Column | None = None) -> Column:
    """Blank texts pass; up to six words need one word with marks, longer ones a share of them.

    Where marks do not decide, the language that a detector gave decides; where it gave none, any marked word counts.
    """
    all_words = raw_words(col)
    marked = F.size(F.filter(all_words, lambda w: F.lower(w).rlike(VI_MARKED)))
    n = F.size(all_words)
    decided = F.when(n <= 6, marked >= 1).otherwise(marked / F.greatest(n, F.lit(1)) >= least_share)
    fallback = marked > 0
    if detected is not None:
        fallback = F.when(is_blank(detected), fallback).otherwise(F.lower(F.trim(detected)).rlike("^vi"))
    return F.when(is_blank(col), True).otherwise(decided | fallback)


def plausible_length(source: Column, target: Column) -> Column:
    """Ratio of characters in [0.3, 2.0]; a source of up to 40 may have 40 more in its target instead."""
    ratio = F.length(target) / F.length(source)
    return (
        F.when(is_blank(source), True)
        .when(is_blank(target), False)
        .when(ratio < 0.3, False)
        .when(ratio <= 2.0, True)
        .otherwise((F.length(source) <= 40) & (F.length(target) <= F.length(source) + 40))
    )


def is_term_list(col: Column) -> Column:
    """Parts between commas or slashes have three words at most, and there is one."""
    stripped = F.regexp_replace(F.trim(col), r"\.+$", "")
    parts = F.filter(F.transform(F.split(stripped, "[,/]"), lambda p: F.trim(p)), lambda p: p != "")
    return F.coalesce((F.size(parts) > 0) & F.forall(parts, lambda p: F.size(raw_words(p)) <= 3), F.lit(False))


def repetition(col: Column, n: int = 2) -> Column:
    """Share of the words that the most frequent run of n words takes up; 0 under 2n words.

    Runs are counted after sorting them, so the text stays in one row and nothing is shuffled.
    """
    start = F.struct(F.lit("").alias("run"), F.lit(0).alias("now"), F.lit(0).alias("best"))

    def count(acc: Column, run: Column) -> Column:
        now = F.when(acc["run"] == run, acc["now"] + 1).otherwise(F.lit(1))
        return F.struct(run.alias("run"), now.alias("now"), F.greatest(acc["best"], now).alias("best"))

    def share(found: Column) -> Column:
        size = F.size(found)
        runs = F.array_sort(F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.concat_ws(" ", *(found[i + (k - 1)] for k in range(n)))))
        best = F.aggregate(runs, start, count, lambda acc: acc["best"])
        return F.when(size < 2 * n, F.lit(0.0)).otherwise(best * F.lit(float(n)) / size)

    return F.transform(F.array(raw_words(col)), share)[0]  # so that the words are split once, not once a run


def tone(syllable: Column) -> Column:
    """Name of the syllable's tone: that of its first toned vowel."""
    toned = "".join(TONED.values())
    first = F.regexp_extract(F.lower(syllable), f"([{toned}])", 1)
    return F.coalesce(*(F.when(first.rlike(f"[{letters}]"), name) for name, letters in TONED.items()), F.lit("ngang"))


def tone_register(syllable: Column) -> Column:
    return F.when(tone(syllable).isin("ngang", "hoi", "sac"), "cao").otherwise("thap")


def without_tone(syllable: Column) -> Column:
    return F.translate(syllable, "".join(TONED.values()), PLAIN_VOWELS * len(TONED))


def initial(syllable: Column) -> Column:
    """Consonants before the first vowel; the whole syllable where it has none."""
    return F.regexp_extract(without_tone(syllable), f"^([^{PLAIN_VOWELS}]*)", 1)


def rhyme(syllable: Column) -> Column:
    return F.regexp_extract(without_tone(syllable), f"([{PLAIN_VOWELS}].*)$", 1)


def shared_rhyme(word: Column) -> Column:
    """Rhyme that the first two syllables share, if they differ and it has two letters at least; else ''."""
    first, second = F.try_element_at(F.split(word, " "), F.lit(1)), F.try_element_at(F.split(word, " "), F.lit(2))
    same = (first != second) & (rhyme(first) == rhyme(second)) & (F.length(rhyme(second)) >= 2)
    return F.when(F.coalesce(same, F.lit(False)), rhyme(second)).otherwise("")


# Final stops with their nasals, and the tone that each tone changes to in the first syllable.
NASALS = {"ch": "nh", "c": "ng", "p": "m", "t": "n"}
MUTED_TONE = {"sac": "ngang", "nang": "huyen", "hoi": "ngang", "nga": "huyen"}


def mutated(syllable: Column) -> Column:
    """First syllable of a full reduplication: a final stop turns nasal, and the tone into its level partner.

    The new tone stands on the last vowel. All within Column functions.
    """
    bare = without_tone(F.lower(syllable))
    final = F.regexp_extract(bare, "^.+?(ch|c|p|t)$", 1)
    nasal = F.coalesce(*(F.when(final == stop, F.concat(F.expr("''"), F.regexp_replace(bare, f"{stop}$", nose))) for stop, nose in NASALS.items()), bare)
    name = tone(syllable)
    wanted = F.coalesce(*(F.when(name == old, new) for old, new in MUTED_TONE.items()), name)
    head = F.regexp_extract(nasal, f"^(.*)([{PLAIN_VOWELS}])([^{PLAIN_VOWELS}]*)$", 1)
    vowel = F.regexp_extract(nasal, f"^(.*)([{PLAIN_VOWELS}])([^{PLAIN_VOWELS}]*)$", 2)
    tail = F.regexp_extract(nasal, f"^(.*)([{PLAIN_VOWELS}])([^{PLAIN_VOWELS}]*)$", 3)
    toned = F.coalesce(*(F.when(wanted == t, F.translate(vowel, PLAIN_VOWELS, letters)) for t, letters in TONED.items()), vowel)
    return F.when(vowel == "", nasal).otherwise(F.concat(head, toned, tail))


def short_id(prefix: str, seed: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.substring(F.md5(seed), 1, 20))


def snake_case(col: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}_\s]", "")), r"\s+", "_")


def dataset_of_path(path: Column) -> Column:
    """The folder after `16k`, else after `data`, else the one above the file's folder."""
    parts = F.split(path, "/")
    after = lambda name: F.when(F.array_position(parts, name) > 0, F.try_element_at(parts, (F.array_position(parts, name) + 1).cast("int")))
    above = F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(-3)))
    return F.coalesce(after("16k"), after("data"), above, F.lit(""))


def direction(col: Column) -> Column:
    """Class of a shade of meaning; decrease is looked for first."""
    text = F.lower(F.coalesce(col, F.lit("")))
    return F.when(text.contains("giảm"), "giam").when(text.contains("tăng"), "tang").otherwise("trung_tinh")


def base_id(col: Column) -> Column:
    return F.substring_index(col, "__", 1)
