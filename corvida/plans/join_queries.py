"""Queries of keyed joins: fill, overlay, upsert, seed merge, caches, finalising."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvida.functions import text as T
from corvida.operators import tables as O
from corvida.session import table


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with repeated rows reduced to the last written."""
    return O.wins(table(spark, sf_dir, "samples"), ["id"], ["updated_at", "order_index"])


_LATEST = "(select * from samples qualify row_number() over (partition by id order by updated_at desc nulls last, order_index desc) = 1)"


def first_last_wins(spark, sf_dir):
    votes = table(spark, sf_dir, "draft_votes").where("label is not null")
    first = O.wins(votes, ["sample_id", "annotator_id"], ["voted_at", "vote_id"], last=False).select("sample_id", "annotator_id", F.col("label").alias("first_label"))
    last = O.wins(votes, ["sample_id", "annotator_id"], ["voted_at", "vote_id"]).select("sample_id", "annotator_id", F.col("label").alias("last_label"))
    return first.join(last, ["sample_id", "annotator_id"])


def exact_text_join(spark, sf_dir):
    """Reviewed texts and voters' answers that are the same up to case and white space; the first of equal answers counts."""
    key = lambda c: F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
    firsts = O.wins(table(spark, sf_dir, "asr_results").where("text is not null").select("result_id", key("text").alias("k")), ["k"], ["result_id"], last=False)
    found = table(spark, sf_dir, "samples").where("final_asr_text is not null").select("id", key("final_asr_text").alias("k")).distinct()
    return found.join(firsts, "k").select(F.format_string("cs-vi-%05d", "result_id").alias("key"), "id", "result_id")


def fill_fields(spark, sf_dir):
    units = table(spark, sf_dir, "translation_units").select("sample_index", "dataset", F.lit("none").alias("mode"), F.lit("none").alias("error"))
    results = O.wins(table(spark, sf_dir, "translation_results").select("sample_index", "mode", "error", "finished_at"), ["sample_index"], ["finished_at"])
    return O.fill(units, results, "sample_index", ["mode", "error"])


def extend_final(spark, sf_dir):
    """Blank texts filled from two sources in turn: the voters' drafts, then the rover draft."""
    base = _latest(spark, sf_dir).select("id", F.col("final_asr_text").alias("text"))
    drafts = _latest(spark, sf_dir).select("id", F.col("asr_google").alias("text"))
    rover = _latest(spark, sf_dir).select("id", F.col("asr_rover").alias("text"))
    return O.extend(O.extend(base, drafts, "id", ["text"]), rover, "id", ["text"]).select("id", F.md5("text").alias("digest"))


def csv_overlay(spark, sf_dir):
    base = _latest(spark, sf_dir).select("id", "asr_rover", "mt_en")
    edits = _latest(spark, sf_dir).where("status = 'done'").select("id", F.col("final_asr_text").alias("asr_rover"), F.col("final_mt_text").alias("mt_en"))
    done = O.overlay(base, edits, "id", ["asr_rover", "mt_en"])
    return done.select("id", F.md5("asr_rover").alias("asr"), F.md5("mt_en").alias("mt"), "touched")


def map_refresh(spark, sf_dir):
    """Fresh rows replace old ones by key and new keys are added."""
    rows = table(spark, sf_dir, "translation_results").groupBy("sample_index").agg(F.min_by("mode", "finished_at").alias("old"), F.max_by("mode", "finished_at").alias("fresh"), F.count("*").alias("n"))
    units = table(spark, sf_dir, "translation_units").select("sample_index", "dataset")
    return units.join(rows, "sample_index", "full").select("sample_index", F.coalesce(F.when(F.col("n") > 1, F.col("fresh")), F.col("old"), F.lit("missing")).alias("mode"))


def upsert_orphans(spark, sf_dir):
    old = _latest(spark, sf_dir).where("order_index % 3 <> 0").select("id", "duration_sec", "status", "speaker_id")
    new = _latest(spark, sf_dir).where("order_index % 4 <> 0").select("id", "duration_sec", F.upper("speaker_id").alias("speaker_id"))
    return O.upsert(old, new, "id", ["duration_sec", "speaker_id"], ["status"])


def apply_knowledge(spark, sf_dir):
    """Knowledge on a lexicon: rejected words go, confirmed, corrected and added ones overwrite non-null fields."""
    lexicon = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("word"), F.col("p_type").alias("meaning"), F.col("p_brand").alias("origin"))
    state = F.element_at(F.array(*map(F.lit, ("confirmed", "corrected", "rejected", "added", "unknown"))), (F.pmod("p_partkey", F.lit(5)) + 1).cast("int"))
    shifted = F.when(state == "added", F.col("p_partkey") + 1_000_000).otherwise(F.col("p_partkey"))
    knowledge = table(spark, sf_dir, "part").where("p_size % 2 = 0").select(shifted.alias("word"), state.alias("status"), F.when(F.col("p_size") > 10, F.col("p_name")).alias("meaning"))
    acting = knowledge.where(F.col("status").isin("confirmed", "corrected", "added")).select("word", F.col("meaning").alias("_meaning"), F.lit(True).alias("_acts"))
    rejected = knowledge.where("status = 'rejected'").select("word")
    return lexicon.join(rejected, "word", "left_anti").join(acting, "word", "full").select("word", F.coalesce("_meaning", "meaning").alias("meaning"), "origin")


def seed_merge(spark, sf_dir):
    """Candidate words: catalogue first, then stock, then demand only with hits; the first source of a word counts."""
    catalogue = table(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").alias("word"), F.lit("csv").alias("origin"))
    web = table(spark, sf_dir, "part").where("p_size between 5 and 20").select(F.col("p_partkey").alias("word"), F.lit("web").alias("origin"))
    hits = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("word")).agg(F.count("*").alias("hits"))
    a, b = catalogue.withColumnRenamed("origin", "_a"), web.withColumnRenamed("origin", "_b")
    merged = a.join(b, "word", "full").join(hits, "word", "full")
    return merged.select("word", F.coalesce("_a", "_b", F.lit("coverage")).alias("origin"), F.coalesce("hits", F.lit(0)).alias("hits"))


def level_lookup(spark, sf_dir):
    """Level by knowledge: a fact gives 3, a hint 2, else 1; rejected knowledge is as none; missing falls back to 1."""
    entries = table(spark, sf_dir, "samples").select(F.col("id").alias("sample_id"), "source_dataset").distinct()
    kinds = table(spark, sf_dir, "samples").groupBy("source_dataset").agg(F.count("*").alias("n"))
    knowledge = kinds.select("source_dataset", F.when(F.col("n") % 3 == 0, "fact").when(F.col("n") % 3 == 1, "hint").otherwise("rejected").alias("kind")).where("kind <> 'rejected'")
    level = F.when(F.col("kind") == "fact", 3).when(F.col("kind") == "hint", 2).otherwise(1)
    return entries.join(knowledge, "source_dataset", "left").select("sample_id", level.cast("bigint").alias("level"))


def audio_listing(spark, sf_dir):
    """Recordings with an answer but no sample, and samples without any answer: what a listing finds missing."""
    samples = table(spark, sf_dir, "samples").select(F.regexp_replace("id", "::", "/").alias("path")).distinct()
    results = table(spark, sf_dir, "asr_results").select(F.col("audio_relpath").alias("path")).distinct()
    return results.join(samples, "path", "left_anti").select("path", F.lit("no sample").alias("missing")).unionByName(samples.join(results, "path", "left_anti").select("path", F.lit("no answer").alias("missing")))


def voter_gather(spark, sf_dir):
    """The voters of each recording in fixed order with their weight; a recording's array has a row for each voter."""
    order = F.when(F.col("model_name") == "chirp3", 0).when(F.col("model_name") == "internal_whisper", 1).otherwise(2)
    rows = table(spark, sf_dir, "asr_results").where("error is null")
    best = rows.groupBy("audio_relpath", "model_name").agg(F.max(F.struct(F.coalesce("confidence", F.lit(0.5)).alias("c"), "result_id")).alias("m"))
    item = F.struct(order.alias("o"), "model_name", F.col("m.c").alias("c"))
    listed = best.groupBy("audio_relpath").agg(F.array_sort(F.collect_list(item)).alias("v"))
    return listed.select("audio_relpath", F.concat_ws(" ", F.transform("v", lambda v: v["model_name"])).alias("voters"), F.round(F.aggregate("v", F.lit(0.0), lambda a, v: a + v["c"]), 6).alias("weight"))


def cache_or_call(spark, sf_dir):
    """Calls that the cache does not answer: pairs of recording and voter without a successful result."""
    recordings = table(spark, sf_dir, "samples").select(F.regexp_replace("id", "::", "/").alias("audio_relpath")).distinct()
    wanted = recordings.withColumn("model_name", F.explode(F.array(*map(F.lit, ("chirp3", "internal_whisper", "phowhisper")))))
    cached = table(spark, sf_dir, "asr_results").where("error is null and text is not null").select("audio_relpath", "model_name").distinct()
    return wanted.join(cached, ["audio_relpath", "model_name"], "left_anti")


def draft_precedence(spark, sf_dir):
    order = ("final_asr_text", "asr_rover", "asr_internal", "asr_google", "asr_phowhisper")
    source = F.coalesce(*(F.when(F.col(c).isNotNull(), c) for c in order))
    return _latest(spark, sf_dir).select("id", source.alias("draft"), F.md5(F.coalesce(*order)).alias("digest"))


def review_export(spark, sf_dir):
    columns = ("id", "original_audio_path", "asr_rover", "final_asr_text", "mt_en", "final_mt_text")
    return _latest(spark, sf_dir).select(F.col("order_index").cast("bigint").alias("order_index"), *(F.coalesce(c, F.lit("")).alias(c) for c in columns)).orderBy("order_index")


def review_state(spark, sf_dir):
    """Submit only what has both texts; everything else is reset to pending without texts."""
    good = ~T.is_blank(F.col("final_asr_text")) & ~T.is_blank(F.col("final_mt_text"))
    return _latest(spark, sf_dir).select("id", F.when(good, "done").otherwise("pending").alias("status"), F.when(good, F.md5(F.trim("final_asr_text"))).alias("asr"))


def judge_filter(spark, sf_dir):
    """Items kept by their last readable verdict; without one an item is kept."""
    verdicts = O.wins(table(spark, sf_dir, "draft_votes").select("sample_id", "label", "voted_at", "vote_id"), ["sample_id"], ["voted_at", "vote_id"])
    keep = F.when(F.lower(F.trim("label")) == "none", False).when(F.col("label").isNotNull(), True)
    items = _latest(spark, sf_dir).select(F.col("id").alias("sample_id"))
    return items.join(verdicts, "sample_id", "left").select("sample_id", F.coalesce(keep, F.lit(True)).alias("keep"), F.coalesce("label", F.lit("")).alias("filter_reason")).where("keep")


def _pre_final(spark, sf_dir) -> DataFrame:
    """Records before finalising: answer and three distractors out of the catalogue, some of them defective."""
    part = table(spark, sf_dir, "part")
    choices = F.array("p_brand", F.concat("p_brand", F.lit("-b")), F.when(F.col("p_size") % 7 == 0, F.col("p_brand")).otherwise(F.col("p_type")), "p_name")
    return part.select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 11 != 0, F.col("p_name")).alias("question"), choices.alias("choices"),
        F.when(F.col("p_size") % 13 == 0, F.lit("absent")).otherwise(F.col("p_brand")).alias("answer"), F.lit(None).cast("string").alias("sub-category"), F.col("p_type").alias("sub category"),
    )


def finalize_records(spark, sf_dir):
    """Final rows: no null, four choices, all different, the answer among them; the hyphenated name comes first."""
    rows = _pre_final(spark, sf_dir).select("id", "question", "choices", "answer", F.coalesce("sub-category", "sub category").alias("category"))
    whole = F.lit(True)
    for c in ("id", "question", "choices", "answer", "category"):
        whole = whole & F.col(c).isNotNull()
    good = whole & (F.size("choices") == 4) & (F.size(F.array_distinct("choices")) == 4) & F.array_contains("choices", F.col("answer"))
    return rows.where(good).select("id", "question", F.concat_ws(" | ", "choices").alias("choices"), "answer", "category")


def finalize_counts(spark, sf_dir):
    kept = finalize_records(spark, sf_dir).select("id", F.lit(1).alias("kept"))
    counts = _pre_final(spark, sf_dir).select("id").join(kept, "id", "left").agg(F.count("*").alias("n_in"), F.count("kept").alias("n_out"))
    return counts.select("n_in", "n_out", (F.col("n_in") - F.col("n_out")).alias("n_skipped"))


def payload_items(spark, sf_dir):
    """Payload of a judge call: fixed columns and only those context fields that are not blank, as JSON."""
    context = [F.when(~T.is_blank(F.col(c)), F.col(c)).alias(c) for c in ("speaker_id", "status")]
    return _latest(spark, sf_dir).select("id", F.md5(F.to_json(F.struct("id", *context))).alias("payload"))


QUERIES = {
    f.__name__: f
    for f in (
        first_last_wins, exact_text_join, fill_fields, extend_final, csv_overlay, map_refresh, upsert_orphans, apply_knowledge, seed_merge, level_lookup, audio_listing, voter_gather, cache_or_call,
        draft_precedence, review_export, review_state, judge_filter, finalize_records, finalize_counts, payload_items,
    )
}

_BLANK = "coalesce(trim({c}) = '', true)"
_PRE = """(select p_partkey id, case when p_size % 11 <> 0 then p_name end question, [p_brand, p_brand || '-b', case when p_size % 7 = 0 then p_brand else p_type end, p_name] choices,
case when p_size % 13 = 0 then 'absent' else p_brand end answer, p_type category from part)"""
_FINAL = f"(select * from {_PRE} where question is not null and len(choices) = 4 and len(list_distinct(choices)) = 4 and list_contains(choices, answer))"
SQL = {
    "first_last_wins": """select sample_id, annotator_id, arg_min(label, (voted_at, vote_id)) first_label, arg_max(label, (voted_at, vote_id)) last_label from draft_votes
where label is not null group by 1, 2""",
    "exact_text_join": r"""with a as (select min(result_id) result_id, trim(regexp_replace(lower(text),'\s+',' ','g')) k from asr_results where text is not null group by 2),
s as (select distinct id, trim(regexp_replace(lower(final_asr_text),'\s+',' ','g')) k from samples where final_asr_text is not null)
select format('cs-vi-{:05d}', result_id) as key, id, result_id from s join a using (k)""",
    "fill_fields": """with r as (select sample_index, arg_max(struct_pack(m := mode, e := error), finished_at) x from translation_results group by 1)
select u.sample_index, u.dataset, case when r.sample_index is not null then x.m else 'none' end mode, case when r.sample_index is not null then x.e else 'none' end error
from translation_units u left join r on u.sample_index = r.sample_index""",
    "extend_final": f"select id, md5(case when not {_BLANK.format(c='final_asr_text')} then final_asr_text when not {_BLANK.format(c='asr_google')} then asr_google else asr_rover end) digest from {_LATEST}",
    "csv_overlay": f"""select id, md5(case when status = 'done' and not {_BLANK.format(c='final_asr_text')} then final_asr_text else asr_rover end) asr,
md5(case when status = 'done' and not {_BLANK.format(c='final_mt_text')} then final_mt_text else mt_en end) mt,
coalesce(status = 'done', false) and (not {_BLANK.format(c='final_asr_text')} or not {_BLANK.format(c='final_mt_text')}) touched from {_LATEST}""",
    "map_refresh": """with r as (select sample_index, arg_min(mode, finished_at) old, arg_max(mode, finished_at) fresh, count(*) n from translation_results group by 1)
select coalesce(u.sample_index, r.sample_index) sample_index, coalesce(case when n > 1 then fresh end, old, 'missing') mode from translation_units u full join r on u.sample_index = r.sample_index""",
    "upsert_orphans": f"""with o as (select id, duration_sec, status, speaker_id from {_LATEST} where order_index % 3 <> 0), n as (select id, duration_sec, upper(speaker_id) speaker_id from {_LATEST} where order_index % 4 <> 0)
select coalesce(o.id, n.id) id, case when n.id is not null then n.duration_sec else o.duration_sec end duration_sec, case when n.id is not null then n.speaker_id else o.speaker_id end speaker_id, o.status,
case when n.id is null then 'deleted' when o.id is null then 'inserted' else 'updated' end change from o full join n on o.id = n.id""",
    "apply_knowledge": """with k as (select case when p_partkey % 5 = 3 then p_partkey + 1000000 else p_partkey end word, ['confirmed','corrected','rejected','added','unknown'][p_partkey % 5 + 1] status,
case when p_size > 10 then p_name end meaning from part where p_size % 2 = 0), l as (select p_partkey word, p_type meaning, p_brand origin from part where p_partkey not in (select word from k where status = 'rejected')),
a as (select word, meaning from k where status in ('confirmed','corrected','added'))
select coalesce(l.word, a.word) word, coalesce(a.meaning, l.meaning) meaning, l.origin from l full join a on l.word = a.word""",
    "seed_merge": """with a as (select p_partkey word from part where p_size < 10), b as (select p_partkey word from part where p_size between 5 and 20), h as (select l_partkey word, count(*) hits from lineitem group by 1),
w as (select word from a union select word from b union select word from h)
select w.word, case when a.word is not null then 'csv' when b.word is not null then 'web' else 'coverage' end origin, coalesce(hits, 0) hits
from w left join a on w.word = a.word left join b on w.word = b.word left join h on w.word = h.word""",
    "level_lookup": """with k as (select source_dataset, count(*) % 3 m from samples group by 1)
select distinct id sample_id, (case m when 0 then 3 when 1 then 2 else 1 end)::bigint as level from samples s left join k on s.source_dataset = k.source_dataset""",
    "audio_listing": """with s as (select distinct replace(id,'::','/') path from samples), r as (select distinct audio_relpath path from asr_results)
select path, 'no sample' missing from r where path not in (select path from s) union all select path, 'no answer' from s where path not in (select path from r)""",
    "voter_gather": """with b as (select audio_relpath, model_name, case model_name when 'chirp3' then 0 when 'internal_whisper' then 1 else 2 end o, max(coalesce(confidence, 0.5)) c from asr_results
where error is null group by all) select audio_relpath, string_agg(model_name, ' ' order by o) voters, round(sum(c), 6) weight from b group by 1""",
    "cache_or_call": """with s as (select distinct replace(id,'::','/') audio_relpath from samples), w as (select audio_relpath, unnest(['chirp3','internal_whisper','phowhisper']) model_name from s)
select * from w where (audio_relpath, model_name) not in (select (audio_relpath, model_name) from asr_results where error is null and text is not null)""",
    "draft_precedence": f"""select id, case when final_asr_text is not null then 'final_asr_text' when asr_rover is not null then 'asr_rover' when asr_internal is not null then 'asr_internal'
when asr_google is not null then 'asr_google' when asr_phowhisper is not null then 'asr_phowhisper' end draft, md5(coalesce(final_asr_text, asr_rover, asr_internal, asr_google, asr_phowhisper)) digest from {_LATEST}""",
    "review_export": f"""select order_index::bigint order_index, id, coalesce(original_audio_path,'') original_audio_path, coalesce(asr_rover,'') asr_rover, coalesce(final_asr_text,'') final_asr_text, coalesce(mt_en,'') mt_en,
coalesce(final_mt_text,'') final_mt_text from {_LATEST} order by order_index""",
    "review_state": f"""select id, case when not {_BLANK.format(c='final_asr_text')} and not {_BLANK.format(c='final_mt_text')} then 'done' else 'pending' end status,
case when not {_BLANK.format(c='final_asr_text')} and not {_BLANK.format(c='final_mt_text')} then md5(trim(final_asr_text)) end asr from {_LATEST}""",
    "judge_filter": f"""with v as (select sample_id, arg_max(struct_pack(l := label), (voted_at, vote_id)) x from draft_votes group by 1)
select s.id sample_id, true keep, coalesce(x.l, '') filter_reason from {_LATEST} s left join v on s.id = v.sample_id where coalesce(lower(trim(x.l)) <> 'none', true)""",
    "finalize_records": f"select id, question, array_to_string(choices, ' | ') choices, answer, category from {_FINAL}",
    "finalize_counts": f"select (select count(*) from {_PRE}) n_in, (select count(*) from {_FINAL}) n_out, (select count(*) from {_PRE}) - (select count(*) from {_FINAL}) n_skipped",
    "payload_items": f"""select id, md5('{{"id":"' || id || '"' || case when not {_BLANK.format(c='speaker_id')} then ',"speaker_id":"' || speaker_id || '"' else '' end ||
case when not {_BLANK.format(c='status')} then ',"status":"' || status || '"' else '' end || '}}') payload from {_LATEST}""",
}
