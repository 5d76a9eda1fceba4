"""Queries on text scalars: normalisation, language heuristics, phonology, names and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvida.functions import text as T
from corvida.session import table

_NORM = r"trim(regexp_replace(regexp_replace(replace(lower(nfc_normalize(coalesce({c},''))),'_',' '),'[^\p{{L}}\p{{N}}\s]',' ','g'),'\s+',' ','g'))"
_RAW = r"list_filter(string_split(regexp_replace({c},'[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{3000}}]+',' ','g'),' '), lambda w: w <> '')"


def norm_sql(c: str) -> str:
    return _NORM.format(c=c)


def raw_words_sql(c: str) -> str:
    return _RAW.format(c=c)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def normalize_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.normalized(F.col("text"))).alias("digest"), F.length(T.normalized(F.col("text"))).cast("bigint").alias("chars"))


def tokenize_counts(spark, sf_dir):
    tokens = T.words(T.normalized(F.col("text")))
    return _docs(spark, sf_dir).select("doc_id", F.size(tokens).cast("bigint").alias("tokens"), F.size(F.array_distinct(tokens)).cast("bigint").alias("distinct_tokens"))


def diacritic_flags(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.has_marks(F.col("text")).alias("marked"), T.has_exclusive_marks(F.col("text")).alias("exclusive"))


def repetition_ratio(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.round(T.repetition(F.col("text")), 6).alias("ratio"))


def _translated(spark, sf_dir) -> DataFrame:
    """One row for each field of a unit with its attempted text, repeated runs taken once."""
    units = table(spark, sf_dir, "translation_units").select("sample_index", F.explode("fields").alias("field", "source"))
    results = table(spark, sf_dir, "translation_results").select("sample_index", F.explode("attempted_fields").alias("field", "target")).distinct()
    return units.join(results, ["sample_index", "field"])


_UNITS_SQL = """(select u.sample_index, u.field, u.source, r.target from
 (select sample_index, unnest(map_keys(fields)) field, unnest(map_values(fields)) source from translation_units) u
 join (select distinct sample_index, field, target from (select sample_index, unnest(map_keys(attempted_fields)) field, unnest(map_values(attempted_fields)) target from translation_results)) r
 on u.sample_index = r.sample_index and u.field = r.field)"""


def vi_text_heuristic(spark, sf_dir):
    """Transcripts that look Vietnamese; the detector is the voter's own label."""
    rows = table(spark, sf_dir, "asr_results").where("text is not null")
    return rows.select("result_id", T.looks_vietnamese(F.col("text"), detected=F.col("detected_language")).alias("vietnamese")).distinct()


def length_plausibility(spark, sf_dir):
    return _translated(spark, sf_dir).select("sample_index", "field", T.plausible_length(F.col("source"), F.col("target")).alias("plausible")).distinct()


def term_list_shape(spark, sf_dir):
    return _translated(spark, sf_dir).select("sample_index", "field", T.is_term_list(F.col("target")).alias("term_list")).distinct()


def _why(key: str):
    """First reason against a field; null when it passes. A null text is as good as a missing key."""
    source, target = F.col("fields")[key], F.col("answers")[key]
    return F.when(source.isNull(), None).when(target.isNull(), F.concat(F.lit("missing "), F.lit(key))).when(
        ~T.plausible_length(source, target), F.concat(F.lit("length "), F.lit(key))
    ).when(~T.is_term_list(target) & ~T.looks_vietnamese(target), F.concat(F.lit("language "), F.lit(key)))


FIELD_ORDER = ("caption", "question", "answer")


def validate_units(spark, sf_dir):
    """The first failing field of each result, in field order: missing, then length, then language."""
    joined = table(spark, sf_dir, "translation_units").join(
        table(spark, sf_dir, "translation_results").where("attempted_fields is not null").select("sample_index", F.col("attempted_fields").alias("answers"), "ok"), "sample_index"
    )
    return joined.select("sample_index", "ok", F.coalesce(*(_why(k) for k in FIELD_ORDER)).alias("reason"))


_VI = f"regexp_matches(lower(w), '{T.VI_MARKED}')"
_LOOKS = (
    "case when coalesce(trim({t}) = '', true) then true when len({w}) <= 6 then len(list_filter({w}, lambda w: " + _VI + ")) >= 1 or len(list_filter({w}, lambda w: " + _VI + ")) > 0 "
    "else len(list_filter({w}, lambda w: " + _VI + ")) / len({w}) >= 0.15 or len(list_filter({w}, lambda w: " + _VI + ")) > 0 end"
)


def looks_sql(t: str) -> str:
    return _LOOKS.format(t=t, w=raw_words_sql(t))


def length_sql(s: str, t: str) -> str:
    return (
        f"case when coalesce(trim({s}) = '', true) then true when coalesce(trim({t}) = '', true) then false when length({t})/length({s}) < 0.3 then false "
        f"when length({t})/length({s}) <= 2.0 then true else length({s}) <= 40 and length({t}) <= length({s}) + 40 end"
    )


def terms_sql(t: str) -> str:
    parts = rf"list_filter(list_transform(string_split_regex(regexp_replace(trim({t}),'\.+$',''),'[,/]'), lambda x: trim(x)), lambda x: x <> '')"
    return f"coalesce(len({parts}) > 0 and len(list_filter({parts}, lambda p: len({raw_words_sql('p')}) > 3)) = 0, false)"


def _why_sql(key: str) -> str:
    s, t = f"u.fields['{key}']", f"r.attempted_fields['{key}']"
    return (
        f"case when {s} is null then null when {t} is null then 'missing {key}' when not ({length_sql(s, t)}) then 'length {key}' "
        f"when not ({terms_sql(t)}) and not ({looks_sql(t)}) then 'language {key}' end"
    )


def translation_gate(spark, sf_dir):
    """Word ratio of target to source in [0.3, 3.0]; nothing is fallen back to when it fails."""
    source, target = F.size(T.raw_words(F.col("asr_rover"))), F.size(T.raw_words(F.col("mt_en")))
    ratio = F.when(source == 0, True).otherwise((target / source).between(0.3, 3.0))
    gate = F.when(T.is_blank(F.col("mt_en")), False).otherwise(ratio)
    return table(spark, sf_dir, "samples").where("asr_rover is not null").select("id", gate.alias("accepted")).distinct()


def edit_gate_lengths(spark, sf_dir):
    """Character and word ratios of the final text to the draft, and whether both lie in [0.5, 1.6]."""
    before, after = T.normalized(F.col("asr_rover")), T.normalized(F.col("final_asr_text"))
    chars = F.length(after) / F.length(before)
    number = F.size(T.words(after)) / F.size(T.words(before))
    rows = table(spark, sf_dir, "samples").where(F.col("final_asr_text").isNotNull() & (F.coalesce(F.length(before), F.lit(0)) > 0))
    return rows.select("id", F.round(chars, 6).alias("chars"), F.round(number, 6).alias("words"), (chars.between(0.5, 1.6) & number.between(0.5, 1.6)).alias("safe")).distinct()


# The lexicon of phonology examples.
SYLLABLES = "đỏ đo tim tím sạch sành nhẹ khít khin đẹp đèm xốp xôm vàng trắng tốt bát lành lùng rối bối thơm thẩm ngang hạch ách".split()
REDUPLICATIONS = ("lác đác", "bối rối", "tim tím", "đo đỏ", "lúng túng", "co ro", "bát ngát", "xanh xanh", "mơ", "lanh chanh")


def _syllables(spark):
    return spark.createDataFrame([(s,) for s in SYLLABLES], "syllable string").distinct()


_SYLLABLE_VALUES = "(select distinct s syllable from (values " + ",".join(f"('{s}')" for s in SYLLABLES) + ") v(s))"
_TONED = "".join(T.TONED.values())
_TONE_SQL = "coalesce(" + ", ".join(f"case when regexp_matches(regexp_extract(lower(syllable),'[{_TONED}]'),'[{letters}]') then '{name}' end" for name, letters in T.TONED.items()) + ", 'ngang')"
_BARE_SQL = f"translate({{c}}, '{_TONED}', '{T.PLAIN_VOWELS * len(T.TONED)}')"


def tone_register(spark, sf_dir):
    s = F.col("syllable")
    return _syllables(spark).select("syllable", T.tone(s).alias("tone"), T.tone_register(s).alias("register"), T.without_tone(s).alias("bare"), T.initial(s).alias("initial"), T.rhyme(s).alias("rhyme"))


def rhyme(spark, sf_dir):
    return spark.createDataFrame([(w,) for w in REDUPLICATIONS], "word string").select("word", T.shared_rhyme(F.col("word")).alias("rhyme"))


def mutate_first(spark, sf_dir):
    return _syllables(spark).select("syllable", T.mutated(F.col("syllable")).alias("first"))


def cloze_direction(spark, sf_dir):
    rows = [("Giảm nhẹ mức độ",), ("Tăng cường mức độ",), ("Vừa tăng vừa giảm",), ("Bình thường",), (None,)]
    return spark.createDataFrame(rows, "shade string").select("shade", T.direction(F.col("shade")).alias("direction"))


def md5_ids(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.short_id("clip", F.concat_ws("/", "p_brand", "p_name")).alias("id"))


def snake_case(spark, sf_dir):
    return table(spark, sf_dir, "part").select(T.snake_case(F.col("p_type")).alias("category"), T.snake_case(F.col("p_brand")).alias("brand")).distinct()


def path_dataset(spark, sf_dir):
    paths = table(spark, sf_dir, "samples").select("original_audio_path").where("original_audio_path is not null").distinct()
    extra = spark.createDataFrame([("data/vivos/16k/phim/a.wav",), ("x/data/kho/b.wav",), ("kho/nguoi/c.wav",), ("d.wav",)], "original_audio_path string")
    return paths.unionByName(extra).select("original_audio_path", T.dataset_of_path(F.col("original_audio_path")).alias("dataset"))


def qa_text_parse(spark, sf_dir):
    """Question and answer from texts that hold both: `Q: ... A: ...`, over any lines."""
    joined = F.concat(F.lit("Q: "), F.col("question"), F.lit("\nA: "), F.col("answer"))
    items = table(spark, sf_dir, "eval_items").select("item_id", joined.alias("t"))
    return items.select("item_id", F.regexp_extract("t", r"(?s)^Q:\s*(.*?)\s*\nA:", 1).alias("question"), F.regexp_extract("t", r"(?s)\nA:\s*(.*)$", 1).alias("answer"))


def target_word(spark, sf_dir):
    """The word before `:` of quoted examples, else the answer when the passage holds it."""
    quoted = F.regexp_extract("text", "Từ “([^”]+)”", 1)
    return _docs(spark, sf_dir).where(F.col("source") == "so_tay_tu").select("doc_id", F.when(quoted != "", quoted).alias("target"))


def unambiguous_language(spark, sf_dir):
    rows = [("Pháp",), ("Anh / Pháp",), ("Hán",), ("",)]
    return spark.createDataFrame(rows, "origin string").select("origin", (~F.col("origin").contains("/")).alias("unambiguous"))


def alpha_tokens(spark, sf_dir):
    """How often each purely alphabetic lower-case token occurs in a source."""
    tokens = _docs(spark, sf_dir).select("source", F.explode(T.raw_words(T.lowered(F.coalesce("text", F.lit(""))))).alias("w"))
    tokens = tokens.select("source", F.regexp_replace("w", r"[^\p{L}]", "").alias("token")).where("token <> ''")
    return tokens.groupBy("source", "token").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_text, tokenize_counts, diacritic_flags, repetition_ratio, vi_text_heuristic, length_plausibility, term_list_shape, validate_units, translation_gate, edit_gate_lengths,
        tone_register, rhyme, mutate_first, cloze_direction, md5_ids, snake_case, path_dataset, qa_text_parse, target_word, unambiguous_language, alpha_tokens,
    )
}

_TOKENS = f"list_filter(string_split({norm_sql('text')},' '), lambda w: w <> '')"
SQL = {
    "normalize_text": f"select doc_id, md5({norm_sql('text')}) digest, length({norm_sql('text')})::bigint chars from documents",
    "tokenize_counts": f"select doc_id, len({_TOKENS})::bigint tokens, len(list_distinct({_TOKENS}))::bigint distinct_tokens from documents",
    "diacritic_flags": f"select doc_id, regexp_matches(lower(text),'{T.VI_MARKED}') marked, regexp_matches(lower(text),'{T.VI_EXCLUSIVE}') exclusive from documents",
    "repetition_ratio": f"""with w as (select doc_id, {raw_words_sql('text')} ws from documents),
g as (select doc_id, ws[i] || ' ' || ws[i+1] as run from (select doc_id, ws, unnest(range(1, len(ws))) i from w where len(ws) >= 4)),
c as (select doc_id, max(n) best from (select doc_id, run, count(*) n from g group by all) group by 1)
select w.doc_id, round(case when len(ws) < 4 then 0.0 else best * 2.0 / len(ws) end, 6) ratio from w left join c using (doc_id)""",
    "vi_text_heuristic": f"""select distinct result_id, case when coalesce(trim(text) = '', true) then true when m >= (case when n <= 6 then 1 else 0.15 * n end) then true
when coalesce(trim(detected_language) = '', true) then m > 0 else lower(trim(detected_language)) like 'vi%' end vietnamese from
(select *, len({raw_words_sql('text')}) n, len(list_filter({raw_words_sql('text')}, lambda w: {_VI})) m from asr_results where text is not null)""",
    "length_plausibility": f"select distinct sample_index, field, {length_sql('source', 'target')} plausible from {_UNITS_SQL}",
    "term_list_shape": f"select distinct sample_index, field, {terms_sql('target')} term_list from {_UNITS_SQL}",
    "validate_units": f"""select r.sample_index, r.ok, coalesce({', '.join(map(_why_sql, FIELD_ORDER))}) reason
from translation_units u join translation_results r on u.sample_index = r.sample_index where r.attempted_fields is not null""",
    "translation_gate": f"""select distinct id, case when coalesce(trim(mt_en) = '', true) then false when len({raw_words_sql('asr_rover')}) = 0 then true
else len({raw_words_sql('mt_en')}) / len({raw_words_sql('asr_rover')}) between 0.3 and 3.0 end accepted from samples where asr_rover is not null""",
    "edit_gate_lengths": f"""with s as (select id, {norm_sql('asr_rover')} b, {norm_sql('final_asr_text')} a from samples where final_asr_text is not null),
r as (select id, length(a)/length(b) chars, len(list_filter(string_split(a,' '), lambda w: w <> ''))/len(list_filter(string_split(b,' '), lambda w: w <> '')) words from s where length(b) > 0)
select distinct id, round(chars, 6) chars, round(words, 6) words, chars between 0.5 and 1.6 and words between 0.5 and 1.6 safe from r""",
    "tone_register": f"""select syllable, {_TONE_SQL} tone, case when {_TONE_SQL} in ('ngang','hoi','sac') then 'cao' else 'thap' end register,
{_BARE_SQL.format(c='syllable')} bare, regexp_extract({_BARE_SQL.format(c='syllable')}, '^([^{T.PLAIN_VOWELS}]*)', 1) initial, regexp_extract({_BARE_SQL.format(c='syllable')}, '([{T.PLAIN_VOWELS}].*)$', 1) rhyme from {_SYLLABLE_VALUES}""",
    "rhyme": f"""with v as (select w word, string_split(w,' ') p from (values {",".join(f"('{w}')" for w in REDUPLICATIONS)}) t(w)),
r as (select word, p, regexp_extract({_BARE_SQL.format(c='p[1]')}, '([{T.PLAIN_VOWELS}].*)$', 1) a, regexp_extract({_BARE_SQL.format(c='p[2]')}, '([{T.PLAIN_VOWELS}].*)$', 1) b from v)
select word, case when len(p) >= 2 and p[1] <> p[2] and a = b and length(b) >= 2 then b else '' end rhyme from r""",
    "mutate_first": f"""with b as (select syllable, {_BARE_SQL.format(c='lower(syllable)')} bare, {_TONE_SQL} tone from {_SYLLABLE_VALUES}),
n as (select *, case regexp_extract(bare, '^.+?(ch|c|p|t)$', 1) {' '.join(f"when '{stop}' then regexp_replace(bare, '{stop}$', '{nose}')" for stop, nose in T.NASALS.items())} else bare end nasal,
case tone {' '.join(f"when '{old}' then '{new}'" for old, new in T.MUTED_TONE.items())} else tone end wanted from b),
v as (select *, regexp_extract(nasal, '^(.*)([{T.PLAIN_VOWELS}])([^{T.PLAIN_VOWELS}]*)$', 1) h, regexp_extract(nasal, '^(.*)([{T.PLAIN_VOWELS}])([^{T.PLAIN_VOWELS}]*)$', 2) w, regexp_extract(nasal, '^(.*)([{T.PLAIN_VOWELS}])([^{T.PLAIN_VOWELS}]*)$', 3) t from n)
select syllable, case when w = '' then nasal else h || case wanted {' '.join(f"when '{tone}' then translate(w, '{T.PLAIN_VOWELS}', '{letters}')" for tone, letters in T.TONED.items())} else w end || t end as first from v""",
    "cloze_direction": """select shade, case when lower(coalesce(shade,'')) like '%giảm%' then 'giam' when lower(coalesce(shade,'')) like '%tăng%' then 'tang' else 'trung_tinh' end direction
from (values ('Giảm nhẹ mức độ'), ('Tăng cường mức độ'), ('Vừa tăng vừa giảm'), ('Bình thường'), (null)) v(shade)""",
    "md5_ids": "select p_partkey, 'clip_' || left(md5(concat_ws('/', p_brand, p_name)), 20) id from part",
    "snake_case": r"""select distinct regexp_replace(trim(regexp_replace(lower(p_type),'[^\p{L}\p{N}_\s]','','g')),'\s+','_','g') category,
regexp_replace(trim(regexp_replace(lower(p_brand),'[^\p{L}\p{N}_\s]','','g')),'\s+','_','g') brand from part""",
    "path_dataset": """with p as (select distinct original_audio_path from samples where original_audio_path is not null
union all select * from (values ('data/vivos/16k/phim/a.wav'), ('x/data/kho/b.wav'), ('kho/nguoi/c.wav'), ('d.wav')) v(x)), q as (select original_audio_path, string_split(original_audio_path,'/') s from p)
select original_audio_path, coalesce(case when list_position(s,'16k') > 0 then s[list_position(s,'16k')+1] end, case when list_position(s,'data') > 0 then s[list_position(s,'data')+1] end, case when len(s) >= 3 then s[-3] end, '') dataset from q""",
    "qa_text_parse": r"""with t as (select item_id, 'Q: ' || question || chr(10) || 'A: ' || answer t from eval_items)
select item_id, regexp_extract(t, '(?s)^Q:\s*(.*?)\s*\nA:', 1) question, regexp_extract(t, '(?s)\nA:\s*(.*)$', 1) answer from t""",
    "target_word": "select doc_id, nullif(regexp_extract(text, 'Từ “([^”]+)”', 1), '') target from documents where source = 'so_tay_tu'",
    "unambiguous_language": "select origin, not contains(origin, '/') unambiguous from (values ('Pháp'), ('Anh / Pháp'), ('Hán'), ('')) v(origin)",
    "alpha_tokens": rf"""select source, token, count(*) n from (select source, regexp_replace(w, '[^\p{{L}}]', '', 'g') token from
(select source, unnest({raw_words_sql("lower(nfc_normalize(coalesce(text,'')))")}) w from documents)) where token <> '' group by all""",
}
