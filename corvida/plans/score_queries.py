"""Answers of scorers, verdicts over audio windows, edit similarity, padded cue joins."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from corvida.functions import text as T
from corvida.plans.report_queries import _CUES, _cues
from corvida.session import table

# Classes of errors with their subclasses, in the order in which they are looked for.
ERROR_CLASSES = {
    "accuracy": ("addition", "mistranslation", "omission", "untranslated text"),
    "fluency": ("character encoding", "grammar", "inconsistency", "punctuation", "register", "spelling"),
    "locale convention": ("currency", "date", "name", "telephone", "time"),
    "style": (),
    "terminology": ("inappropriate", "inconsistent"),
    "non-translation": (),
    "other": (),
}
ERRORS = ("accuracy/omission - x", "fluency: grammar and spelling", "style", "locale convention (date or time)", "terminology - inconsistent use", "non-translation", "something else", "other", "nothing")
VERDICTS = ("No meaning preserved", "some meaning preserved, but", "Perfect meaning and grammar", "most meaning preserved; some meaning preserved", "")
# The classes of meaning, worst first.
CLASSES = ("No meaning preserved", "Some meaning preserved", "Most meaning preserved", "Perfect meaning and grammar")
STARS = ("five stars", "3 stars", "★★★★", "**", "one or two", "4", "six", "five stars (5)", "3 stars, not 4")


def error_kind(error: Column) -> Column:
    """First class that the description names; of its subclasses the last one that it names."""
    found = F.lit("unknown")
    for name, subs in reversed(ERROR_CLASSES.items()):
        own = F.coalesce(*(F.when(error.contains(s), f"{name}-{s}") for s in reversed(subs)), F.lit(name))
        found = F.when(error.contains(name), own).otherwise(found)
    return found


def named_class(answer: Column) -> Column:
    """Index of the only class that an answer names; null for none or several."""
    named = F.array_compact(F.array(*(F.when(F.lower(answer).contains(c.lower()), i) for i, c in enumerate(CLASSES))))
    return F.when(F.size(named) == 1, F.get(named, F.lit(0))).cast("bigint")


def stars(answer: Column) -> Column:
    """Stars of an answer: all evidence in it must name one value of 1 to 5."""
    text = F.concat(F.lit(" "), F.lower(answer), F.lit(" "))
    count = lambda sign: F.when(answer.contains(sign), F.length(answer) - F.length(F.replace(answer, F.lit(sign), F.lit(""))))
    named = [F.when(text.contains(f" {w} ") | text.contains(f"{i} star"), i) for i, w in enumerate(("one", "two", "three", "four", "five"), 1)]
    digits = F.regexp_extract_all(answer, F.lit(r"(\d+)"), F.lit(1))
    number = F.when(F.size(digits) == 1, F.get(digits, F.lit(0)).try_cast("int"))
    found = F.array_distinct(F.array_compact(F.array(count("*"), count("★"), *named, number)))
    return F.when((F.size(found) == 1) & F.get(found, F.lit(0)).between(1, 5), F.get(found, F.lit(0))).cast("bigint")


def _answers(spark, sf_dir, examples: tuple[str, ...]):
    """The answers of the test items, and examples of what scorers say."""
    return spark.createDataFrame([(e,) for e in examples], "answer string").unionByName(table(spark, sf_dir, "eval_items").where("answer is not null").select("answer"))


def error_class(spark, sf_dir):
    examples = spark.createDataFrame([(e,) for e in ERRORS], "error string")
    rows = examples.unionByName(table(spark, sf_dir, "asr_results").where("error is not null").select(F.lower("error").alias("error")))
    return rows.select("error", error_kind(F.col("error")).alias("kind"))


def class_answer(spark, sf_dir):
    return _answers(spark, sf_dir, VERDICTS).select("answer", named_class(F.col("answer")).alias("class"))


def star_answer(spark, sf_dir):
    return _answers(spark, sf_dir, STARS).select("answer", stars(F.col("answer")).alias("stars"))


def lid_keep(spark, sf_dir):
    """Recordings kept by language: any of their answers names it with confidence of 0.15 at least; errors keep."""
    named = F.lower(F.trim("detected_language")).startswith("vi") & (F.coalesce("confidence", F.lit(1.0)) >= 0.15)
    keep = F.coalesce(named, F.lit(False)) | F.col("error").isNotNull()
    return table(spark, sf_dir, "asr_results").groupBy("audio_relpath").agg(F.max(keep).alias("keep"))


def lid_chunks(spark, sf_dir):
    """Windows of 30 s of each recording; a tail of under one second is dropped unless it is the only window."""
    rows = table(spark, sf_dir, "samples").where("duration_sec > 0").select("id", "duration_sec").distinct()
    starts = F.filter(F.sequence(F.lit(0), F.floor(F.col("duration_sec") / 30).cast("int")), lambda i: (F.col("duration_sec") - i * 30 >= 1) | (i == 0))
    return rows.select("id", F.size(starts).cast("bigint").alias("windows"))


def cue_padded_join(spark, sf_dir):
    """Signups within 45 s of an error of the same user, over shared time buckets."""
    pad, width = 45.0, 3600.0
    cues = _cues(spark, sf_dir)
    spread = lambda df, by: df.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("start") - by) / width), F.floor((F.col("end") + by) / width))))
    a, b = spread(cues.where("event_type = 'error'"), pad).alias("a"), spread(cues.where("event_type = 'signup'"), 0.0).alias("b")
    joined = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.bucket") == F.col("b.bucket")))
    near = (F.col("b.start") < F.col("a.end") + pad) & (F.col("b.end") > F.col("a.start") - pad)
    return joined.where(near).select(F.col("a.event_id").alias("error_id"), F.col("b.event_id").alias("signup_id")).distinct()


@F.pandas_udf(DoubleType())
def gestalt(before: pd.Series, after: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(before, after)], dtype="float64")


def gestalt_ratio(spark, sf_dir):
    """Similarity of the final text to the draft, and whether the edit is safe: 0.45 at least and lengths in [0.5, 1.6]."""
    rows = table(spark, sf_dir, "samples").where("asr_rover is not null and final_asr_text is not null")
    pairs = rows.select("id", T.normalized(F.col("asr_rover")).alias("a"), T.normalized(F.col("final_asr_text")).alias("b")).where("a <> ''").distinct()
    scored = pairs.withColumn("similarity", gestalt.asNondeterministic()("a", "b"))
    ratio, number = F.length("b") / F.length("a"), F.size(T.words(F.col("b"))) / F.size(T.words(F.col("a")))
    return scored.select("id", F.round("similarity", 6).alias("similarity"), ((F.col("similarity") >= 0.45) & ratio.between(0.5, 1.6) & number.between(0.5, 1.6)).alias("safe"))


QUERIES = {f.__name__: f for f in (error_class, class_answer, star_answer, lid_keep, lid_chunks, cue_padded_join, gestalt_ratio)}


def _values(rows: tuple[str, ...], column: str) -> str:
    return "(values " + ",".join("('" + r.replace("'", "''") + "')" for r in rows) + f") v({column})"


def _answers_sql(examples: tuple[str, ...]) -> str:
    return f"(select answer from {_values(examples, 'answer')} union all select answer from eval_items where answer is not null)"


def _class_sql() -> str:
    cases = ""
    for name, subs in ERROR_CLASSES.items():
        own = "case " + " ".join(f"when contains(error, '{s}') then '{name}-{s}'" for s in reversed(subs)) + f" else '{name}' end" if subs else f"'{name}'"
        cases += f" when contains(error, '{name}') then {own}"
    return f"case{cases} else 'unknown' end"


_NAMED = "list_filter([" + ",".join(f"case when contains(lower(answer), '{c.lower()}') then {i} end" for i, c in enumerate(CLASSES)) + "], lambda x: x is not null)"
_STAR = (
    "list_distinct(list_filter([case when contains(answer,'*') then length(answer) - length(replace(answer,'*','')) end, case when contains(answer,'★') then length(answer) - length(replace(answer,'★','')) end, "
    + ", ".join(f"case when contains(t, ' {w} ') or contains(t, '{i} star') then {i} end" for i, w in enumerate(("one", "two", "three", "four", "five"), 1))
    + r", case when len(regexp_extract_all(answer, '\d+')) = 1 then try_cast(regexp_extract(answer, '\d+') as int) end], lambda x: x is not null))"
)
SQL = {
    "error_class": f"select error, {_class_sql()} kind from (select error from {_values(ERRORS, 'error')} union all select lower(error) from asr_results where error is not null)",
    "class_answer": f"select answer, (case when len({_NAMED}) = 1 then {_NAMED}[1] end)::bigint as class from {_answers_sql(VERDICTS)}",
    "star_answer": f"with s as (select answer, ' ' || lower(answer) || ' ' t from {_answers_sql(STARS)}), f as (select answer, {_STAR} f from s) select answer, (case when len(f) = 1 and f[1] between 1 and 5 then f[1] end)::bigint stars from f",
    "lid_keep": "select audio_relpath, bool_or(coalesce(lower(trim(detected_language)) like 'vi%' and coalesce(confidence, 1.0) >= 0.15, false) or error is not null) keep from asr_results group by 1",
    "lid_chunks": "select id, len(list_filter(range(0, floor(duration_sec / 30)::int + 1), lambda i: duration_sec - i * 30 >= 1 or i = 0))::bigint windows from (select distinct id, duration_sec from samples where duration_sec > 0)",
    "cue_padded_join": f"""select distinct a.event_id error_id, b.event_id signup_id from {_CUES} a join {_CUES} b on a.user_id = b.user_id and b.start < a."end" + 45 and b."end" > a.start - 45
where a.event_type = 'error' and b.event_type = 'signup'""",
}
