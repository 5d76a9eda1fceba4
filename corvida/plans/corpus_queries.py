"""Queries on corpora and knowledge: filters, lookups with precedence, merges, distributions, slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvida.functions import text as T
from corvida.operators import tables as O
from corvida.plans.join_queries import _LATEST, _latest
from corvida.plans.text_queries import norm_sql
from corvida.session import table


def relevance_filter(spark, sf_dir):
    """Items whose cached level is one of two; an item without a cached level is not kept."""
    levels = O.wins(table(spark, sf_dir, "translation_results").select("sample_index", "mode", "finished_at"), ["sample_index"], ["finished_at", "mode"])
    kept = levels.where(F.col("mode").isin("batched", "fallback_single")).select("sample_index", "mode")
    return table(spark, sf_dir, "translation_units").select("sample_index", "dataset").join(kept, "sample_index")


def yes_no_excluded(spark, sf_dir):
    rows = table(spark, sf_dir, "eval_items")
    return rows.where(~F.coalesce(F.lower(F.trim("answer")).isin("yes", "no", "có", "không"), F.lit(False))).select("item_id", "answer")


def rerun_filter(spark, sf_dir):
    """Records of the base ids that failed: the id before the double underscore."""
    failed = table(spark, sf_dir, "translation_results").where("error is not null").select(F.col("sample_index").cast("string").alias("base")).distinct()
    records = table(spark, sf_dir, "translation_units").select(F.explode(F.map_keys("fields")).alias("field"), "sample_index").select(F.concat(F.col("sample_index").cast("string"), F.lit("__"), "field").alias("id"))
    return records.withColumn("base", T.base_id(F.col("id"))).join(failed, "base", "left_semi").select("id")


def cased_pair(spark, sf_dir):
    """Texts normalised with their first spelling kept beside them; doing it twice changes nothing."""
    rows = _latest(spark, sf_dir).select("id", F.col("final_asr_text").alias("text"), F.lit(None).cast("string").alias("cased"))
    once = rows.select("id", F.coalesce("cased", F.nullif("text", F.lit(""))).alias("cased")).withColumn("text", T.normalized(F.col("cased")))
    return once.select("id", F.md5("text").alias("digest"), F.md5(F.coalesce("cased", F.lit(""))).alias("cased_digest"))


def derived_pair(spark, sf_dir):
    """The final text pair by direction; a direction that is not known ends the query with its name."""
    rows = _latest(spark, sf_dir).withColumn("direction", F.when(F.col("order_index") % 2 == 0, "vi_en").otherwise("en_vi"))
    vi, en = F.coalesce("final_asr_text", "asr_rover"), F.coalesce("final_mt_text", "mt_en")
    pair = lambda a, b: F.struct(a.alias("source"), b.alias("target"))
    unknown = F.raise_error(F.concat(F.lit("unknown direction "), "direction")).cast("struct<source:string,target:string>")
    chosen = F.when(F.col("direction") == "vi_en", pair(vi, en)).when(F.col("direction") == "en_vi", pair(en, vi)).otherwise(unknown)
    return rows.withColumn("p", chosen).select("id", "direction", F.md5("p.source").alias("source"), F.md5("p.target").alias("target"))


def text_source(spark, sf_dir):
    """The voted text, or else the first draft that is not blank, with where it comes from."""
    order = ("asr_rover", "asr_google", "asr_internal")
    source = F.coalesce(*(F.when(~T.is_blank(F.col(c)), c) for c in order), F.lit("none"))
    return _latest(spark, sf_dir).select("id", F.md5(O.first_of(*(F.col(c) for c in order))).alias("text"), source.alias("source"))


ARTIFACTS = ("done", "pending", "seed", "knowledge", "final", "errors")


def presence_report(spark, sf_dir):
    """Which of the expected artefacts are there."""
    there = table(spark, sf_dir, "samples").select(F.col("status").alias("artifact")).distinct().withColumn("there", F.lit(True))
    return spark.createDataFrame([(a,) for a in ARTIFACTS], "artifact string").join(there, "artifact", "left").fillna(False, ["there"])


def knowledge_precedence(spark, sf_dir):
    """A recording's language: from knowledge, else from the cache, else still to be asked for."""
    result = F.col("detected_language").isNotNull() & (F.trim("detected_language") != "")
    results = table(spark, sf_dir, "asr_results").where(result)
    best = lambda model, name: results.where(F.col("model_name") == model).groupBy("audio_relpath").agg(F.max("detected_language").alias(name))
    paths = table(spark, sf_dir, "samples").select(F.regexp_replace("id", "::", "/").alias("audio_relpath")).distinct()
    joined = paths.join(best("chirp3", "known"), "audio_relpath", "left").join(best("internal_whisper", "cached"), "audio_relpath", "left")
    origin = F.when(F.col("known").isNotNull(), "knowledge").when(F.col("cached").isNotNull(), "cache").otherwise("ask")
    return joined.select("audio_relpath", F.coalesce("known", "cached").alias("language"), origin.alias("origin"))


def term_lookup(spark, sf_dir):
    """For each term of a record its knowledge entry, or else the fallback kept under record and term; terms in order."""
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("terms"))
    part = table(spark, sf_dir, "part")
    knowledge = part.where("p_size % 2 = 0").select(F.col("p_partkey").alias("term"), F.col("p_type").alias("known"))
    fallback = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_partkey").alias("term")).agg(F.max("l_returnflag").alias("fallback"))
    terms = orders.select("l_orderkey", F.posexplode("terms").alias("pos", "term")).join(knowledge, "term", "left").join(fallback, ["l_orderkey", "term"], "left")
    found = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("known", "fallback").alias("value"))))
    return terms.groupBy("l_orderkey").agg(F.concat_ws(" | ", F.transform(found, lambda x: x["value"])).alias("fields"))


def kg_batch_merge(spark, sf_dir):
    """Of several entries for a word the richest, with the most fields that are not blank; of equal ones the first."""
    rich = F.size(F.filter(F.map_values("attempted_fields"), lambda v: ~T.is_blank(v)))
    rows = table(spark, sf_dir, "translation_results").withColumn("rich", F.coalesce(F.when(F.col("attempted_fields").isNotNull(), rich), F.lit(0)))
    best = F.max_by(F.struct("rich", "mode"), F.struct("rich", -F.unix_micros(F.col("finished_at").cast("timestamp"))))
    return rows.groupBy("sample_index").agg(best.alias("b"), F.count("*").alias("entries")).select("sample_index", F.col("b.rich").cast("bigint").alias("rich"), "b.mode", "entries")


def totals_merged(spark, sf_dir):
    """Totals by key of an older and a newer report: the newer one replaces the older by key, and the totals are summed up."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("report"), "o_totalprice")
    reports = rows.groupBy("key", "report").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    latest = reports.groupBy("key").agg(F.max_by(F.struct("n", "total"), "report").alias("r"))
    return latest.agg(F.count("*").alias("keys"), F.sum("r.n").alias("n"), F.round(F.sum("r.total"), 0).alias("total"))


def seed_statistics(spark, sf_dir):
    """Records, records with a word, distinct words, and how often the first record of a word is the only one."""
    word = F.regexp_extract("text", "Từ “([^”]+)”", 1)
    words = table(spark, sf_dir, "documents").select("doc_id", F.nullif(word, F.lit("")).alias("word"))
    firsts = words.where("word is not null").groupBy("word").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    single = firsts.agg(F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("single"), F.coalesce(F.min("first"), F.lit(-1)).alias("first"))
    return words.agg(F.count("*").alias("records"), F.count("word").alias("extracted")).crossJoin(single)  # one row each


def level_distribution(spark, sf_dir):
    level = F.col("p_size") % 3 + 1
    return table(spark, sf_dir, "part").groupBy(level.cast("bigint").alias("level")).agg(F.count("*").alias("n"), F.countDistinct(F.coalesce("p_type", "p_name")).alias("sources"))


def verdict_distribution(spark, sf_dir):
    return table(spark, sf_dir, "translation_results").groupBy(F.coalesce(F.col("ok").cast("string"), F.lit("missing")).alias("verdict"), F.coalesce("mode", F.lit("none")).alias("mode")).agg(F.count("*").alias("n"))


def value_distributions(spark, sf_dir):
    """Counts over several columns at once, and the yes and no among the values of one."""
    rows = table(spark, sf_dir, "samples").select("source_dataset", "status", F.coalesce("speaker_id", F.lit("none")).alias("speaker_id"))
    sets = rows.groupingSets([["source_dataset"], ["status"], ["source_dataset", "status"]], "source_dataset", "status")
    return sets.agg(F.count("*").alias("n"), F.countDistinct("speaker_id").alias("speakers"))


def pairwise_accuracy(spark, sf_dir):
    """How often two voters of a recording are ranked alike by confidence and by length of text: pairs of at most as
    many rows as there are voters, each recording's answers reduced to one a voter first."""
    rows = table(spark, sf_dir, "asr_results").where("confidence is not null and text is not null")
    best = rows.groupBy("audio_relpath", "model_name").agg(F.max("confidence").alias("c"), F.max(F.length("text")).alias("n"))
    own = best.groupBy("audio_relpath").agg(F.array_sort(F.collect_list(F.struct("model_name", "c", "n"))).alias("v"))
    pairs = F.flatten(F.transform("v", lambda a: F.transform(F.filter("v", lambda b: b["model_name"] > a["model_name"]), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    p = own.select(F.explode(pairs).alias("p")).select(F.col("p.a.model_name").alias("first"), F.col("p.b.model_name").alias("second"), F.signum(F.col("p.a.c") - F.col("p.b.c")).alias("x"), F.signum(F.col("p.a.n") - F.col("p.b.n")).alias("y"))
    used = p.where("x <> 0 and y <> 0")
    concordant = F.count_if(F.col("x") == F.col("y"))
    return used.groupBy("first", "second").agg(F.count("*").alias("pairs"), F.round(concordant / F.count("*"), 6).alias("accuracy"), F.round((2 * concordant - F.count("*")) / F.count("*"), 6).alias("kendall"))


def line_zip(spark, sf_dir):
    """Sources, references and hypotheses of several systems by line number; a system without a line has an empty one."""
    sources = table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("line"), F.md5("question").alias("source"), F.md5("answer").alias("reference"))
    hypotheses = table(spark, sf_dir, "asr_results").where("text is not null").groupBy(F.col("result_id").alias("line"), "model_name").agg(F.md5(F.max("text")).alias("hypothesis"))
    systems = F.explode(F.array(*map(F.lit, ("chirp3", "internal_whisper", "phowhisper"))))
    return sources.withColumn("model_name", systems).join(hypotheses, ["line", "model_name"], "left").fillna("", ["hypothesis"])


def unit_slice(spark, sf_dir):
    """A slice of the units in their order: a command that shows some records."""
    return table(spark, sf_dir, "translation_units").select("sample_index", "dataset").orderBy("sample_index").offset(20).limit(50)


def ids_answered(spark, sf_dir):
    """Ids that were sent and came back."""
    sent, back = table(spark, sf_dir, "translation_units").select("sample_index"), table(spark, sf_dir, "translation_results").where("ok").select("sample_index")
    return sent.intersect(back)


def candidate_order(spark, sf_dir):
    """The models that were tried for a recording, each once, in the order of the first try."""
    tries = table(spark, sf_dir, "asr_results").where("model_name is not null").groupBy("audio_relpath", "model_name").agg(F.min(F.struct("loaded_at", "result_id")).alias("first"))
    listed = F.array_sort(F.collect_list(F.struct("first", "model_name")))
    return tries.groupBy("audio_relpath").agg(F.concat_ws(" ", F.array_distinct(F.transform(listed, lambda x: x["model_name"]))).alias("models"))


def blank_cells(spark, sf_dir):
    """Lexicon cells filled from another table where they are blank, by the lower-cased word; others stay."""
    part = table(spark, sf_dir, "part")
    rows = part.select("p_partkey", F.lower("p_name").alias("word"), F.when(F.col("p_size") % 3 != 0, F.col("p_type")).alias("meaning"))
    found = part.groupBy(F.lower("p_name").alias("word")).agg(F.min("p_brand").alias("fresh"))
    return rows.join(found, "word", "left").select("p_partkey", F.when(T.is_blank(F.col("meaning")), F.col("fresh")).otherwise(F.col("meaning")).alias("meaning"))


def prompt_render(spark, sf_dir):
    """Prompts out of a template with named places."""
    rows = table(spark, sf_dir, "eval_items")
    template = F.lit("[{lang}] {question}\n{passage}")
    for name in ("lang", "question", "passage"):
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(name, F.lit("")))
    return rows.select("item_id", F.md5(template).alias("prompt"))


def batch_numbers(spark, sf_dir):
    """Units in batches of 24 in their order, numbered without bringing all rows into one task."""
    numbered = O.numbered(table(spark, sf_dir, "translation_units").select("sample_index"), ["sample_index"], "pos")
    return numbered.select("sample_index", F.floor(F.col("pos") / 24).cast("bigint").alias("batch"))


QUERIES = {
    f.__name__: f
    for f in (
        relevance_filter, yes_no_excluded, rerun_filter, cased_pair, derived_pair, text_source, presence_report, knowledge_precedence, term_lookup, kg_batch_merge, totals_merged, seed_statistics,
        level_distribution, verdict_distribution, value_distributions, pairwise_accuracy, line_zip, unit_slice, ids_answered, candidate_order, blank_cells, prompt_render, batch_numbers,
    )
}

_BLANK = "coalesce(trim({c}) = '', true)"
SQL = {
    "relevance_filter": """with l as (select sample_index, arg_max(struct_pack(m := mode), (finished_at, mode)) x from translation_results group by 1)
select u.sample_index, dataset, x.m as mode from translation_units u join l on l.sample_index = u.sample_index where x.m in ('batched', 'fallback_single')""",
    "yes_no_excluded": "select item_id, answer from eval_items where not coalesce(lower(trim(answer)) in ('yes', 'no', 'có', 'không'), false)",
    "rerun_filter": """select sample_index || '__' || field id from (select sample_index, unnest(map_keys(fields)) field from translation_units)
where sample_index in (select sample_index from translation_results where error is not null)""",
    "cased_pair": f"""select id, md5({norm_sql("nullif(final_asr_text, '')")}) digest, md5(coalesce(nullif(final_asr_text, ''), '')) cased_digest from {_LATEST}""",
    "derived_pair": f"""with r as (select id, order_index % 2 = 0 f, coalesce(final_asr_text, asr_rover) vi, coalesce(final_mt_text, mt_en) en from {_LATEST})
select id, case when f then 'vi_en' else 'en_vi' end direction, md5(case when f then vi else en end) source, md5(case when f then en else vi end) target from r""",
    "text_source": f"""select id, md5(case when not {_BLANK.format(c='asr_rover')} then asr_rover when not {_BLANK.format(c='asr_google')} then asr_google when not {_BLANK.format(c='asr_internal')} then asr_internal end) as text,
case when not {_BLANK.format(c='asr_rover')} then 'asr_rover' when not {_BLANK.format(c='asr_google')} then 'asr_google' when not {_BLANK.format(c='asr_internal')} then 'asr_internal' else 'none' end source from {_LATEST}""",
    "presence_report": f"select artifact, artifact in (select status from samples where status is not null) there from (values {','.join(f'({a!r})' for a in ARTIFACTS)}) v(artifact)",
    "knowledge_precedence": """with r as (select * from asr_results where trim(detected_language) <> ''), k as (select audio_relpath, max(detected_language) l from r where model_name = 'chirp3' group by 1),
c as (select audio_relpath, max(detected_language) l from r where model_name = 'internal_whisper' group by 1), p as (select distinct replace(id,'::','/') audio_relpath from samples)
select p.audio_relpath, coalesce(k.l, c.l) as language, case when k.l is not null then 'knowledge' when c.l is not null then 'cache' else 'ask' end origin
from p left join k on k.audio_relpath = p.audio_relpath left join c on c.audio_relpath = p.audio_relpath""",
    "term_lookup": """with t as (select l_orderkey, l_partkey, max(l_returnflag) f from lineitem group by all)
select l_orderkey, string_agg(case when p_size % 2 = 0 then coalesce(p_type, f) else f end, ' | ' order by l_partkey) fields from t left join part on p_partkey = l_partkey group by 1""",
    "kg_batch_merge": """with r as (select *, case when attempted_fields is null then 0 else len(list_filter(map_values(attempted_fields), lambda v: not coalesce(trim(v) = '', true))) end rich from translation_results)
select sample_index, arg_max(struct_pack(r := rich, m := mode), (rich, -epoch_us(finished_at))).r::bigint rich, arg_max(struct_pack(r := rich, m := mode), (rich, -epoch_us(finished_at))).m as mode, count(*) entries from r group by 1""",
    "totals_merged": """with r as (select o_custkey k, year(o_orderdate) y, count(*) n, round(sum(o_totalprice), 2) t from orders group by all), l as (select k, arg_max(n, y) n, arg_max(t, y) t from r group by 1)
select count(*) keys, sum(n)::bigint n, round(sum(t), 0) total from l""",
    "seed_statistics": """with w as (select doc_id, nullif(regexp_extract(text, 'Từ “([^”]+)”', 1), '') word from documents), f as (select word, min(doc_id) d, count(*) n from w where word is not null group by 1)
select (select count(*) from w) records, (select count(word) from w) extracted, (select count(*) from f) words, (select count(*) from f where n = 1) single, (select coalesce(min(d), -1) from f) as first""",
    "level_distribution": "select (p_size % 3 + 1)::bigint as level, count(*) n, count(distinct coalesce(p_type, p_name)) sources from part group by 1",
    "verdict_distribution": "select coalesce(ok::varchar, 'missing') verdict, coalesce(mode, 'none') as mode, count(*) n from translation_results group by 1, 2",
    "value_distributions": """select source_dataset, status, count(*) n, count(distinct coalesce(speaker_id, 'none')) speakers from samples group by grouping sets ((source_dataset), (status), (source_dataset, status))""",
    "pairwise_accuracy": """with b as (select audio_relpath, model_name, max(confidence) c, max(length(text)) n from asr_results where confidence is not null and text is not null group by all),
p as (select a.model_name as first, b.model_name as second, sign(a.c - b.c) x, sign(a.n - b.n) y from b a join b on a.audio_relpath = b.audio_relpath and b.model_name > a.model_name)
select first, second, count(*) pairs, round(count(*) filter (x = y) / count(*), 6) accuracy, round((2 * count(*) filter (x = y) - count(*)) / count(*), 6) kendall from p where x <> 0 and y <> 0 group by all""",
    "line_zip": """with h as (select result_id, model_name, md5(max(text)) h from asr_results where text is not null group by all), s as (select unnest(['chirp3','internal_whisper','phowhisper']) model_name)
select item_id as line, s.model_name, md5(question) source, md5(answer) reference, coalesce(h, '') hypothesis from eval_items cross join s left join h on h.result_id = item_id and h.model_name = s.model_name""",
    "unit_slice": "select sample_index, dataset from translation_units order by 1 limit 50 offset 20",
    "ids_answered": "select sample_index from translation_units intersect select sample_index from translation_results where ok",
    "candidate_order": """with t as (select audio_relpath, model_name, min((loaded_at, result_id)) f from asr_results where model_name is not null group by all)
select audio_relpath, string_agg(model_name, ' ' order by f, model_name) models from t group by 1""",
    "blank_cells": """with f as (select lower(p_name) word, min(p_brand) b from part group by 1)
select p_partkey, case when p_size % 3 = 0 or coalesce(trim(p_type) = '', true) then b else p_type end meaning from part left join f on f.word = lower(p_name)""",
    "prompt_render": "select item_id, md5('[' || coalesce(lang,'') || '] ' || coalesce(question,'') || chr(10) || coalesce(passage,'')) prompt from eval_items",
    "batch_numbers": "select sample_index, (row_number() over (order by sample_index) - 1) // 24 as batch from translation_units",
}
