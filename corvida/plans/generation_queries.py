"""Queries that make questions, distractors, records and lexicons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvida.functions import text as T
from corvida.plans.report_queries import SEED
from corvida.session import table


def seeded(*parts: str) -> Column:
    """An order that depends on the seed and the values only."""
    return F.md5(F.concat_ws("|", F.lit(SEED), *(F.col(p).cast("string") for p in parts)))


def first_candidates(entries: DataFrame, candidates: DataFrame, group: str, word: str, least: int = 3) -> DataFrame:
    """entries(id, group, word) with `near` and `far`: candidates of the same group, and of any, least + 1 of each at most.

    A group's candidates are ranked once, by a seeded order, and only as many as an entry can need are kept: one of them
    may be the entry's own word. So no entry meets all candidates, however large a group is.
    """
    distinct = candidates.select(F.col(group).alias("_g"), F.col(word).alias("_w")).distinct()
    rank = lambda df, by: df.withColumn("_k", seeded("_w")).withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_k", "_w"))).where(F.col("_r") <= 2 * least + 2)
    listed = lambda df: F.transform(F.array_sort(F.collect_list(F.struct("_r", "_w"))), lambda x: x["_w"])
    near = rank(distinct, ["_g"]).groupBy("_g").agg(listed(None).alias("near"))
    # the first of all, found among the first of each bucket, so that no task ranks every candidate
    buckets = rank(distinct.select("_w").distinct().withColumn("_b", F.pmod(F.xxhash64("_w"), F.lit(64))), ["_b"]).drop("_r", "_k")
    far = buckets.withColumn("_k", seeded("_w")).orderBy("_k", "_w").limit(2 * least + 2)
    far = far.agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_w"))), lambda x: x["_w"]).alias("far"))
    return entries.join(near.withColumnRenamed("_g", group), group, "left").crossJoin(F.broadcast(far))  # far is one row


def distractors(own: Column, near: Column, far: Column, n: int = 3) -> Column:
    """The first n candidates that are not the answer: of the same group first; null when there are fewer."""
    some = F.filter(F.array_distinct(F.concat(F.coalesce(near, F.array()), far)), lambda w: w != own)
    return F.when(F.size(some) >= n, F.slice(some, 1, n))


_CLOZE = {"tang": "Câu: {t} Từ láy nào tăng nghĩa?", "giam": "Câu: {t} Từ láy nào giảm nghĩa?", "trung_tinh": "Câu: {t} Từ láy nào hợp nhất?"}


def cloze_questions(spark, sf_dir):
    """Cloze records: the full word is the answer, distractors come from its register first; direction picks the template."""
    part = table(spark, sf_dir, "part").withColumn("register", F.when(F.col("p_size") % 2 == 0, "cao").otherwise("thap")).withColumn("word", F.concat_ws(" ", "p_brand", F.split("p_type", " ")[0]))
    found = first_candidates(part.select("p_partkey", "p_size", "p_name", "register", "word"), part, "register", "word")
    wrong = distractors(F.col("word"), F.col("near"), F.col("far"))
    way = F.when(F.col("p_size") % 3 == 0, "tang").when(F.col("p_size") % 3 == 1, "giam").otherwise("trung_tinh")
    question = F.coalesce(*(F.when(way == k, F.replace(F.lit(t), F.lit("{t}"), F.col("p_name"))) for k, t in _CLOZE.items()))
    rows = found.withColumn("wrong", wrong).where("wrong is not null")
    return rows.select(F.format_string("%d__CLOZE", "p_partkey").alias("id"), F.concat_ws(" | ", F.array_sort(F.array_append("wrong", F.col("word")))).alias("choices"), F.col("word").alias("answer"), question.alias("question"), "register")


def flat_questions(spark, sf_dir):
    """Every (word, aspect) that is not yet an answer of its sample, with a strategy by a seeded threshold."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct()
    aspects = F.explode(F.array(*map(F.lit, ("meaning", "origin", "use"))))
    wanted = lines.withColumn("aspect", aspects)
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_partkey", F.lit("origin").alias("aspect")).distinct()
    todo = wanted.join(done, ["l_orderkey", "l_partkey", "aspect"], "left_anti")
    digit = F.conv(F.substring(seeded("l_orderkey", "l_partkey", "aspect"), 1, 2), 16, 10).cast("int")
    return todo.select(F.concat_ws("__", "l_orderkey", "l_partkey", "aspect").alias("id"), F.when(digit < 128, "rule").when(digit < 205, "model").otherwise("mixed").alias("strategy"))


def question_units(spark, sf_dir):
    """Units of five kinds in one pass: B to E for each term by what is known of it, F once for a record with a relation."""
    terms = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("terms"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("term"), "p_size")
    each = terms.select("l_orderkey", F.posexplode("terms").alias("pos", "term")).join(part, "term")
    size = F.col("p_size")
    kinds = F.array_compact(F.array(F.when((size % 4 == 0) & (size > 10), "B"), F.when(size % 3 == 0, "C"), F.when(size % 5 == 0, "D"), F.when(size % 7 == 0, "E")))
    of_terms = each.select("l_orderkey", "pos", F.explode(kinds).alias("kind")).select(F.format_string("%d__%s__t%d", "l_orderkey", "kind", "pos").alias("id"), "kind", F.lit(1).cast("bigint").alias("terms"))
    whole = terms.where(F.size("terms") >= 4).select(F.format_string("%d__F", "l_orderkey").alias("id"), F.lit("F").alias("kind"), F.size("terms").cast("bigint").alias("terms"))
    return of_terms.unionByName(whole)


def new_word_records(spark, sf_dir):
    """Records of words found in samples, with ids by position and a level by what is known of the word."""
    words = table(spark, sf_dir, "documents").where("source = 'so_tay_tu'").select("doc_id", F.regexp_extract_all("text", F.lit("“([^”]+)”"), F.lit(1)).alias("words"))
    part = F.length("word") % 3 + 1
    return words.select("doc_id", F.posexplode("words").alias("pos", "word")).select(F.format_string("new-%04d-w%d", "doc_id", "pos").alias("id"), "word", part.cast("bigint").alias("level"))


def record_assembly(spark, sf_dir):
    """Records with the constants of their level and a template that the id picks."""
    rows = table(spark, sf_dir, "part").withColumn("level", F.col("p_size") % 3 + 1)
    names = F.create_map(*(F.lit(x) for x in (1, "easy", 2, "medium", 3, "hard")))
    pick = F.conv(F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 4), 16, 10).cast("int") % 3
    template = F.get(F.array(F.lit("What is {w}?"), F.lit("Which one is {w}?"), F.lit("Name {w}.")), pick)
    return rows.select(
        F.format_string("%d__L%d", "p_partkey", "level").alias("id"), names[F.col("level")].alias("difficulty"), F.lit("speech").alias("task"), F.lit("test").alias("split"), F.replace(template, F.lit("{w}"), F.col("p_name")).alias("question")
    )


def domain_distractors(spark, sf_dir):
    """For each part three other types of its domain, the distinct types of all: the first ones after its own in a seeded ring.

    The domain is ranked once; an entry looks at the places behind its own, so nothing meets the whole domain.
    """
    part = table(spark, sf_dir, "part")
    ring = part.select("p_type").distinct().withColumn("k", seeded("p_type")).withColumn("at", F.row_number().over(Window.orderBy("k", "p_type")) - 1)
    size = ring.agg(F.count("*").alias("n"))
    places = part.select("p_partkey", "p_type").join(ring.select("p_type", "at"), "p_type").crossJoin(F.broadcast(size))
    wanted = places.where("n > 3").select("p_partkey", F.explode(F.array(*(((F.col("at") + i) % F.col("n")).alias(f"a{i}") for i in (1, 2, 3)))).alias("at"))
    return wanted.join(ring.select("at", F.col("p_type").alias("wrong")), "at").select("p_partkey", "wrong")


def aspect_value(spark, sf_dir):
    """The field that an aspect asks for; null for an aspect that is not known."""
    rows = table(spark, sf_dir, "part").withColumn("aspect", F.element_at(F.array(*map(F.lit, ("language", "root", "meaning", "other"))), (F.col("p_size") % 4 + 1).cast("int")))
    return rows.select("p_partkey", "aspect", F.when(F.col("aspect") == "language", F.col("p_brand")).when(F.col("aspect") == "root", F.col("p_type")).when(F.col("aspect") == "meaning", F.col("p_name")).alias("value"))


def clean_distractors(spark, sf_dir):
    """Distractors as a model gave them: trimmed, each once, not the answer, three of them; null leaves it to the rules."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("answer"), F.array(F.concat(F.lit(" "), "p_brand"), "p_type", F.concat("p_type", F.lit("  ")), "p_name", F.lit(""), F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit("x")))).alias("given"))
    trimmed = F.filter(F.array_distinct(F.transform(F.array_compact("given"), lambda c: F.trim(c))), lambda c: (c != "") & (c != F.col("answer")))
    return rows.withColumn("c", trimmed).select("p_partkey", F.when(F.size("c") >= 3, F.concat_ws(" | ", F.slice("c", 1, 3))).alias("wrong"))


def lexicon_build(spark, sf_dir):
    """A lexicon of several sources: an earlier source wins by lower-cased word; a note that names a type overrides the source's type."""
    part = table(spark, sf_dir, "part")
    source = lambda order, name, kind, where: part.where(where).select(F.lower("p_name").alias("word"), F.lit(order).alias("o"), F.lit(name).alias("origin"), F.lit(kind).alias("kind"), F.col("p_type").alias("note"), "p_partkey")
    rows = source(0, "curated", "whole", "p_size <= 10").unionByName(source(1, "web", "part", "p_size between 5 and 30")).unionByName(source(2, "mined", "rhyme", "p_size > 25"))
    first = rows.groupBy("word").agg(F.min(F.struct("o", "p_partkey", "origin", "kind", "note")).alias("f"))
    kind = F.when(F.lower("f.note").contains("brass"), "rhyme").when(F.lower("f.note").contains("steel"), "whole").otherwise(F.col("f.kind"))
    return first.select("word", "f.origin", kind.alias("kind"))


def sound_merge(spark, sf_dir):
    """Two sources in one schema with constant task and category; choices may come as a JSON string."""
    a = table(spark, sf_dir, "eval_items").select(F.concat(F.lit("a-"), F.col("item_id").cast("string")).alias("id"), "question", F.array("answer", F.lit("none")).alias("choices"), "answer")
    given = F.to_json(F.array("p_brand", "p_type"))
    b = table(spark, sf_dir, "part").select(F.concat(F.lit("b-"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("question"), F.from_json(given, "array<string>").alias("choices"), F.col("p_brand").alias("answer"))
    return a.unionByName(b).select("id", "question", F.concat_ws(" | ", "choices").alias("choices"), "answer", F.lit("sound").alias("task"), F.lit("perception").alias("category"))


def two_judges(spark, sf_dir):
    """Records that two judges in a row keep, finalised and extended by the field that blank ones lack."""
    part = table(spark, sf_dir, "part")
    first = part.select("p_partkey", F.when(F.col("p_size") % 10 == 0, False).when(F.col("p_size") % 4 != 0, True).alias("keep"))
    second = part.where("p_size % 6 <> 0").select("p_partkey", (F.col("p_size") % 7 != 0).alias("keep2"))
    rows = part.select("p_partkey", "p_name", "p_brand", F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("extra"))
    kept = rows.join(first, "p_partkey", "left").where(F.coalesce("keep", F.lit(True))).join(second, "p_partkey", "left").where(F.coalesce("keep2", F.lit(True)))
    return kept.where("p_name is not null and p_brand is not null").select("p_partkey", "p_name", F.when(T.is_blank(F.col("extra")), F.lit("general")).otherwise(F.col("extra")).alias("extra"))


def rule_addendum(spark, sf_dir):
    """The text that a rule of the knowledge adds to a prompt: nothing when there is none."""
    rules = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("key"), "n_name").groupBy("key").agg(F.max_by("n_name", F.struct(F.length("n_name"), "n_name")).alias("rule"))
    return table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 7).alias("key")).join(rules, "key", "left").select("c_custkey", F.coalesce(F.concat(F.lit("\nRule: "), "rule"), F.lit("")).alias("addendum"))


QUERIES = {
    f.__name__: f
    for f in (
        cloze_questions, flat_questions, question_units, new_word_records, record_assembly, domain_distractors, aspect_value, clean_distractors, lexicon_build, sound_merge, two_judges, rule_addendum,
    )
}

SQL = {
    "cloze_questions": f"""with e as (select p_partkey, p_size, p_name, case when p_size % 2 = 0 then 'cao' else 'thap' end register, p_brand || ' ' || split_part(p_type,' ',1) word from part),
d as (select distinct register g, word w, md5('{SEED}|' || word) k from e), n as (select g, list(w order by k, w) l from (select *, row_number() over (partition by g order by k, w) r from d) where r <= 8 group by 1),
f as (select list(w order by k, w) l from (select distinct w, k from d order by k, w limit 8)),
c as (select e.*, list_filter(list_concat(n.l, f.l), lambda w: w <> word) s from e left join n on n.g = register cross join f), u as (select *, list_filter(s, lambda w, i: list_position(s, w) = i) q from c)
select p_partkey || '__CLOZE' id, array_to_string(list_sort(list_append(q[1:3], word)), ' | ') choices, word answer,
replace(case p_size % 3 when 0 then '{_CLOZE['tang']}' when 1 then '{_CLOZE['giam']}' else '{_CLOZE['trung_tinh']}' end, '{{t}}', p_name) question, register from u where len(q) >= 3""",
    "flat_questions": f"""with w as (select *, unnest(['meaning','origin','use']) aspect from (select distinct l_orderkey o, l_partkey p from lineitem)),
t as (select * from w where not (aspect = 'origin' and (o, p) in (select (l_orderkey, l_partkey) from lineitem where l_returnflag = 'R')))
select o || '__' || p || '__' || aspect id, case when d < 128 then 'rule' when d < 205 then 'model' else 'mixed' end strategy from (select *, ('0x' || left(md5(concat_ws('|','{SEED}',o,p,aspect)), 2))::int d from t)""",
    "question_units": """with t as (select l_orderkey o, list_sort(list(distinct l_partkey)) ts from lineitem group by 1), e as (select o, unnest(ts) term, generate_subscripts(ts, 1) - 1 pos from t),
k as (select o, pos, unnest(list_filter([case when p_size % 4 = 0 and p_size > 10 then 'B' end, case when p_size % 3 = 0 then 'C' end, case when p_size % 5 = 0 then 'D' end, case when p_size % 7 = 0 then 'E' end], lambda x: x is not null)) kind from e join part on p_partkey = term)
select o || '__' || kind || '__t' || pos id, kind, 1::bigint terms from k union all select o || '__F', 'F', len(ts) from t where len(ts) >= 4""",
    "new_word_records": """with w as (select doc_id, regexp_extract_all(text, '“([^”]+)”', 1) ws from documents where source = 'so_tay_tu'), e as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) - 1 pos from w)
select format('new-{:04d}-w{}', doc_id, pos) id, word, (length(word) % 3 + 1)::bigint as level from e""",
    "record_assembly": """select p_partkey || '__L' || (p_size % 3 + 1) id, ['easy','medium','hard'][p_size % 3 + 1] difficulty, 'speech' task, 'test' split,
replace(['What is {w}?','Which one is {w}?','Name {w}.'][('0x' || left(md5(p_partkey::varchar), 4))::int % 3 + 1], '{w}', p_name) question from part""",
    "domain_distractors": f"""with r as (select p_type, row_number() over (order by md5('{SEED}|' || p_type), p_type) - 1 a from (select distinct p_type from part)), n as (select count(*) n from r),
w as (select p_partkey, (a + unnest([1, 2, 3])) % n a from part join r using (p_type) cross join n where n > 3) select p_partkey, r.p_type wrong from w join r on r.a = w.a""",
    "aspect_value": """select p_partkey, ['language','root','meaning','other'][p_size % 4 + 1] aspect, case p_size % 4 when 0 then p_brand when 1 then p_type when 2 then p_name end as value from part""",
    "clean_distractors": """with g as (select p_partkey, p_brand, [trim(x) for x in [' ' || p_brand, p_type, p_type || '  ', p_name, '', case when p_size % 2 = 0 then p_brand || 'x' end] if x is not null] g from part),
c as (select p_partkey, list_filter(g, lambda x, i: x <> '' and x <> p_brand and list_position(g, x) = i) c from g) select p_partkey, case when len(c) >= 3 then array_to_string(c[1:3], ' | ') end wrong from c""",
    "lexicon_build": """with r as (select lower(p_name) word, 0 o, 'curated' origin, 'whole' kind, p_type note, p_partkey from part where p_size <= 10 union all select lower(p_name), 1, 'web', 'part', p_type, p_partkey from part where p_size between 5 and 30
union all select lower(p_name), 2, 'mined', 'rhyme', p_type, p_partkey from part where p_size > 25), f as (select * from r qualify row_number() over (partition by word order by o, p_partkey) = 1)
select word, origin, case when contains(lower(note), 'brass') then 'rhyme' when contains(lower(note), 'steel') then 'whole' else kind end kind from f""",
    "sound_merge": """select 'a-' || item_id id, question, array_to_string([answer, 'none'], ' | ') choices, answer, 'sound' task, 'perception' category from eval_items
union all select 'b-' || p_partkey, p_name, array_to_string([p_brand, p_type], ' | '), p_brand, 'sound', 'perception' from part""",
    "two_judges": """select p_partkey, p_name, case when p_size % 2 = 0 and trim(p_type) <> '' then p_type else 'general' end extra from part
where p_size % 10 <> 0 and (p_size % 6 = 0 or p_size % 7 <> 0) and p_name is not null and p_brand is not null""",
    "rule_addendum": """with r as (select n_regionkey k, arg_max(n_name, (length(n_name), n_name)) rule from nation group by 1) select c_custkey, coalesce(chr(10) || 'Rule: ' || rule, '') addendum from customer left join r on k = c_nationkey % 7""",
}
