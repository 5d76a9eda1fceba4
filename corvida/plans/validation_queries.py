"""Validation of curated samples: issues with their short circuits, their summary, and the gate."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corvida.functions import text as T
from corvida.plans.join_queries import _LATEST, _latest
from corvida.plans.text_queries import norm_sql, raw_words_sql
from corvida.session import table

REQUIRED = ("id", "text_vi", "text_en", "audio_path", "duration_sec")
WORDS_FOR_LANGUAGE, WORDS_FOR_REPETITION, MOST_REPETITION, DURATION_TOLERANCE = 5, 8, 0.3, 0.5


def _empty(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "") if name != "duration_sec" else F.col(name).isNull()


def issues(samples: DataFrame) -> DataFrame:
    """(id, check) of samples(id, text_vi, text_en, text_vi_cased, text_en_cased, audio_path, duration_sec, there,
    actual_sec, spoken): a missing field ends a sample's checks, a missing recording those that need it.

    there: the recording exists; actual_sec and spoken, what was measured and whether the language was heard, may be
    null where that was not checked.
    """
    missing = F.lit(False)
    for name in REQUIRED:
        missing = missing | _empty(name)

    def check(condition: Column, name: str) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), name)

    def repeats(name: str) -> Column:
        return (F.size(T.raw_words(F.col(name))) >= WORDS_FOR_REPETITION) & (T.repetition(F.col(name)) >= MOST_REPETITION)

    def not_normal(name: str) -> Column:
        return ~_empty(f"{name}_cased") & (T.normalized(F.col(f"{name}_cased")) != F.col(name))

    first = (
        check((F.trim("text_vi") == "") | (F.trim("text_en") == ""), "empty_text"),
        check(T.has_exclusive_marks(F.col("text_en")), "text_en_contains_vietnamese"),
        check((F.size(T.raw_words(F.col("text_vi"))) >= WORDS_FOR_LANGUAGE) & ~T.has_marks(F.col("text_vi")), "text_vi_missing_diacritics"),
        check(~F.col("there"), "audio_missing"),
    )
    then = (
        check(F.abs(F.col("actual_sec") - F.col("duration_sec")) > DURATION_TOLERANCE, "duration_mismatch"),
        check(~F.col("spoken"), "language_id_fail"),
        check(repeats("text_vi"), "degenerate_text_vi"), check(repeats("text_en"), "degenerate_text_en"),
        check(not_normal("text_vi"), "normalization_invariant_vi"), check(not_normal("text_en"), "normalization_invariant_en"),
    )
    found = F.when(missing, F.array(F.lit("missing_field"))).when(~F.coalesce("there", F.lit(False)), F.array_compact(F.array(*first))).otherwise(F.array_compact(F.array(*first, *then)))
    return samples.select("id", F.explode(found).alias("check"))


def raise_if_failed(found: DataFrame, most_examples: int = 20) -> None:
    """The gate: ends with the counts and the first examples when there is any issue."""
    examples = found.orderBy("id", "check").limit(most_examples).collect()
    if examples:
        counts = summary(found).orderBy(F.desc("n"), "check").collect()  # as many rows as there are checks
        lines = [f"  {r['check']}: {r['n']}" for r in counts] + [f"  [{r['check']}] {r['id']}" for r in examples]
        raise ValueError("\n".join([f"validation failed with {sum(r['n'] for r in counts)} issues", *lines]))


def summary(found: DataFrame) -> DataFrame:
    return found.groupBy("check").agg(F.count("*").alias("n"))


def _curated(spark, sf_dir) -> DataFrame:
    spoken = F.max(F.lower("detected_language").rlike("^vi").cast("int"))
    heard = table(spark, sf_dir, "asr_results").where("error is null").groupBy(F.col("audio_relpath").alias("audio_path")).agg(spoken.alias("s"), F.lit(True).alias("there"))
    rows = _latest(spark, sf_dir).where("status = 'done'").select(
        "id", T.normalized(F.col("final_asr_text")).alias("text_vi"), F.lower("final_mt_text").alias("text_en"), F.col("final_asr_text").alias("text_vi_cased"), F.col("final_mt_text").alias("text_en_cased"),
        F.regexp_replace("id", "::", "/").alias("audio_path"), "duration_sec", F.floor("duration_sec").cast("double").alias("actual_sec"),
    )
    return rows.join(heard, "audio_path", "left").withColumn("there", F.coalesce("there", F.lit(False))).withColumn("spoken", F.col("s") == 1)


def validation_issues(spark, sf_dir):
    return issues(_curated(spark, sf_dir))


def issue_summary(spark, sf_dir):
    return summary(issues(_curated(spark, sf_dir)))


TAIL, LEAST_OVERLAP = 120, 8


def joined_captions(texts: list[str]) -> str:
    """Captions of a rolling display joined: what a caption repeats from the end of what is there is left out.

    The longest match of the last TAIL characters with the caption counts if the caption begins with it and it is long
    enough.
    """
    whole = ""
    for n, text in enumerate(texts):
        if n == 0:
            whole = text
        elif text:
            tail = whole[-TAIL:]
            match = difflib.SequenceMatcher(None, tail, text, autojunk=False).find_longest_match(0, len(tail), 0, len(text))
            rolled = match.size >= LEAST_OVERLAP and match.b == 0
            whole = f"{whole} {text[match.size:].strip() if rolled else text}".strip()
    return " ".join(whole.split())


@F.pandas_udf(StringType())
def caption_text(captions: pd.Series) -> pd.Series:
    return captions.map(lambda c: joined_captions(["" if x is None else x for x in c]), na_action="ignore")


def caption_dedupe(spark, sf_dir):
    """Captions made of each document's sentences, each with the end of the one before it: joined, the document is back."""
    sentences = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), r"(?<=[.?!]) ")
    rolling = F.transform(F.col("s"), lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.substring(F.get("s", i - 1), -30, 30), F.lit(" "), x)))
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", sentences.alias("s"))
    return docs.select("doc_id", F.md5(caption_text(rolling)).alias("digest"))


def accepted_edit(spark, sf_dir):
    """The edited text where the edit is safe by its lengths, else the original; a blank original is accepted as it is."""
    rows = _latest(spark, sf_dir).select("id", F.col("asr_rover").alias("a"), F.col("final_asr_text").alias("b"))
    ratio = F.length("b") / F.length("a")
    state = F.when(T.is_blank(F.col("a")), "blank").when(F.coalesce(ratio.between(0.5, 1.6), F.lit(False)), "accepted").otherwise("original")
    return rows.select("id", state.alias("state"), F.md5(F.when(state == "accepted", F.col("b")).otherwise(F.col("a"))).alias("digest"))


QUERIES = {f.__name__: f for f in (validation_issues, issue_summary, caption_dedupe, accepted_edit)}

_RUNS = """coalesce((select max(n) from (select count(*) n from (select unnest(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])) r) group by r)), 0) * 2.0 / greatest(len({w}), 1) >= 0.3 and len({w}) >= 8"""
_CHECKS = f"""(with h as (select audio_relpath p, max(case when lower(detected_language) like 'vi%' then 1 when detected_language is not null then 0 end) s from asr_results where error is null group by 1),
r as (select id, {norm_sql('final_asr_text')} vi, lower(final_mt_text) en, final_asr_text vic, final_mt_text enc, duration_sec d, h.p is not null there, h.s from {_LATEST} l left join h on h.p = replace(l.id, '::', '/') where status = 'done'),
w as (select *, {raw_words_sql('vi')} wv, {raw_words_sql('en')} we from r),
c as (select id, case when coalesce(vi, '') = '' or coalesce(en, '') = '' or d is null then ['missing_field'] else list_concat([
case when trim(vi) = '' or trim(en) = '' then 'empty_text' end, case when regexp_matches(lower(en), '{T.VI_EXCLUSIVE}') then 'text_en_contains_vietnamese' end,
case when len(wv) >= 5 and not regexp_matches(lower(vi), '{T.VI_MARKED}') then 'text_vi_missing_diacritics' end, case when not there then 'audio_missing' end],
case when there then [case when abs(floor(d) - d) > 0.5 then 'duration_mismatch' end, case when s = 0 then 'language_id_fail' end, case when {_RUNS.format(w='wv')} then 'degenerate_text_vi' end, case when {_RUNS.format(w='we')} then 'degenerate_text_en' end,
case when coalesce(vic, '') <> '' and {norm_sql('vic')} <> vi then 'normalization_invariant_vi' end, case when coalesce(enc, '') <> '' and {norm_sql('enc')} <> en then 'normalization_invariant_en' end] else [] end) end cs from w)
select id, ch as "check" from (select id, unnest(cs) ch from c) where ch is not null)"""
SQL = {
    "validation_issues": f"select * from {_CHECKS}",
    "issue_summary": f'select "check", count(*) n from {_CHECKS} group by 1',
    "accepted_edit": f"""with r as (select id, asr_rover a, final_asr_text b, case when coalesce(trim(asr_rover) = '', true) then 'blank' when coalesce(length(final_asr_text) / length(asr_rover) between 0.5 and 1.6, false) then 'accepted' else 'original' end state from {_LATEST})
select id, state, md5(case when state = 'accepted' then b else a end) digest from r""",
}
