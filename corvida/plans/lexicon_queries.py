"""Queries that hold a lexicon against the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvida.functions import text as T
from corvida.operators import lexicon as L
from corvida.operators import tables as O
from corvida.plans.text_queries import norm_sql, raw_words_sql
from corvida.session import table

# The lexicon of the queries: word, group, base word.
LEXICON = (
    ("chiếc đèn dầu", "đồ vật", "đèn"), ("bộ dây đàn mới", "đồ vật", "dây đàn"), ("tấm bản đồ giấy", "đồ vật", "bản đồ"), ("cuốn sổ tay bìa xanh", "đồ vật", "sổ tay"),
    ("người gác đêm", "người", "người"), ("bà hàng xóm", "người", "hàng xóm"), ("anh lái đò", "người", "lái đò"), ("cô thợ may", "người", "thợ may"),
    ("ba hôm nay", "thời gian", "hôm nay"), ("sáng hôm qua", "thời gian", "hôm qua"), ("đêm rằm", "thời gian", "rằm"), ("trời mưa to", "lý do", "mưa"),
    ("the oil lamp", "object", "lamp"), ("the night guard", "person", "guard"), ("yesterday morning", "time", "morning"), ("old tape recorder", "object", "recorder"),
    ("piano", "nhạc", "piano"), ("đàn bầu", "nhạc", "đàn"), ("A)", "dấu", "A"), ("không tồn tại", "khác", "tồn"),
)
# One-token dictionary of the code-switch scan.
DICTIONARY = ("email", "livestream", "review", "laptop", "deadline", "online", "team", "shop", "fan", "format")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *row) for i, row in enumerate(LEXICON)], "_pos long, word string, topic string, base string")


LEXICON_SQL = "(values " + ",".join(f"({i},'{w}','{g}','{b}')" for i, (w, g, b) in enumerate(LEXICON)) + ") l(_pos, word, topic, base)"
_CLS = r"\p{L}\p{N}_\x{00C0}-\x{1EF9}"


def _stands(entry: str) -> str:
    return f"regexp_matches(t, '(^|[^{_CLS}])' || regexp_escape(lower({entry})) || '($|[^{_CLS}])')"


_CORPUS = "(select doc_id, source, lang, lower(nfc_normalize(text)) t from documents)"
def _hits(column: str) -> str:
    """Pairs of text and entry: plain containment first, as a pattern for each pair is slow."""
    with_entry = f"select c.doc_id, c.source, c.t, l.* from texts c join {LEXICON_SQL} on contains(c.t, lower(l.{column}))"
    return f"(with texts as materialized {_CORPUS}, near as materialized ({with_entry}) select * exclude (t) from near where {_stands(column)})"


_HITS = _hits("word")


def _corpus(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def word_coverage(spark, sf_dir):
    return L.coverage(_corpus(spark, sf_dir), lexicon(spark), "word")


def lexicon_filter(spark, sf_dir):
    return L.occurring(_corpus(spark, sf_dir), lexicon(spark), "word").select("word", "topic")


def build_samples(spark, sf_dir):
    """Each text with its entries, longest first; texts without one are dropped."""
    found = L.annotated(_corpus(spark, sf_dir), lexicon(spark), "word", ("topic",))
    return found.select("doc_id", F.concat_ws(" | ", "entries.word").alias("entries"), F.size("entries").cast("bigint").alias("n"))


def cloze_samples(spark, sf_dir):
    return L.cloze(_corpus(spark, sf_dir).select("doc_id", "text"), lexicon(spark), "word", "base").select("doc_id", "word", "base").distinct()


def dedupe_samples(spark, sf_dir):
    """Entries of a text that no reviewed (hoi_dap) text has; texts left without one are dropped."""
    found = L.matches(_corpus(spark, sf_dir), lexicon(spark), "word")
    other = F.coalesce(F.col("source"), F.lit("")) != "hoi_dap"
    covered = found.where(~other).select("word").distinct()
    rest = found.where(other).join(covered, "word", "left_anti")
    return rest.groupBy("doc_id").agg(F.concat_ws(" | ", F.array_sort(F.collect_list("word"))).alias("entries"))


def split_by_prefix(spark, sf_dir):
    """The entries of each text, divided by a prefix of their topic."""
    entries = L.annotated(_corpus(spark, sf_dir), lexicon(spark), "word", ("topic",))
    starts = lambda e: F.trim(e["topic"]).startswith("đồ")
    join = lambda part: F.concat_ws(" | ", F.transform(part, lambda e: e["word"]))
    return entries.select("doc_id", join(F.filter("entries", starts)).alias("matched"), join(F.filter("entries", lambda e: ~starts(e))).alias("rest"))


def corpus_examples(spark, sf_dir):
    """The first three texts, by id, of every entry: the examples of a coverage report."""
    found = L.matches(_corpus(spark, sf_dir), lexicon(spark), "word")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy("doc_id")))
    return ranked.where("rank <= 3").select("word", F.col("rank").cast("bigint").alias("rank"), "doc_id")


def scan_dictionary(spark, sf_dir):
    """Dictionary tokens of each draft in order, repetitions kept; a token is what stands between white space."""
    words = T.raw_words(F.lower("asr_rover"))
    terms = F.filter(words, lambda w: w.isin(*DICTIONARY))
    rows = table(spark, sf_dir, "samples").where("asr_rover is not null").select("id", terms.alias("terms")).distinct()
    return rows.where("size(terms) > 0").select("id", F.concat_ws(" ", "terms").alias("terms"), F.size("terms").cast("bigint").alias("n"))


def term_verification(spark, sf_dir):
    """Proposed terms that the transcript holds literally and whose type is allowed."""
    proposed = spark.createDataFrame([(w, "noun" if i % 3 else "other") for i, w in enumerate(DICTIONARY)], "term string, kind string")
    rows = table(spark, sf_dir, "samples").where("final_asr_text is not null").select("id", "final_asr_text").distinct()
    tokens = rows.select("id", "final_asr_text", F.explode(F.array_distinct(T.raw_words(F.lower("final_asr_text")))).alias("term"))
    return tokens.join(proposed, "term").where(F.col("final_asr_text").contains(F.col("term")) & F.col("kind").isin("noun", "verb")).select("id", "term")


def bigram_mining(spark, sf_dir):
    """Adjacent pairs of different words with a shared rhyme, or the same rhyme's first letter, seen often enough."""
    texts = table(spark, sf_dir, "documents").where(F.col("lang") == "vi").select(T.words(T.normalized(F.col("text"))).alias("ws")).where(F.size("ws") >= 2)
    words = F.transform(F.sequence(F.lit(1), F.size("ws") - 1), lambda i: F.struct(F.get("ws", i - 1).alias("a"), F.get("ws", i).alias("b")))
    pairs = texts.select(F.explode(words).alias("p")).select("p.a", "p.b").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n")).where("n >= 3")
    shared = T.shared_rhyme(F.concat_ws(" ", "a", "b"))
    return pairs.withColumn("rhyme", shared).where("rhyme <> ''")


def merge_sources(spark, sf_dir):
    """Union of three sources with their provenance, numbered across all of them in source and id order."""
    docs = table(spark, sf_dir, "documents").select(F.lit(0).alias("ord"), F.lit("documents").alias("origin"), F.col("doc_id").cast("string").alias("key"))
    samples = table(spark, sf_dir, "samples").select(F.lit(1).alias("ord"), F.lit("samples").alias("origin"), F.col("id").alias("key")).distinct()
    items = table(spark, sf_dir, "eval_items").select(F.lit(2).alias("ord"), F.lit("eval_items").alias("origin"), F.col("item_id").cast("string").alias("key"))
    return O.numbered(docs.unionByName(samples).unionByName(items), ["ord", "key"], "number").select("number", "origin", "key")


QUERIES = {
    f.__name__: f
    for f in (
        word_coverage, lexicon_filter, build_samples, cloze_samples, dedupe_samples, split_by_prefix, corpus_examples, scan_dictionary, term_verification, bigram_mining, merge_sources,
    )
}

_BARE = f"translate({{c}}, '{''.join(T.TONED.values())}', '{T.PLAIN_VOWELS * len(T.TONED)}')"
_DICT = "(" + ",".join(f"'{w}'" for w in DICTIONARY) + ")"
_DROVER = raw_words_sql("lower(asr_rover)")
SQL = {
    "word_coverage": f"""with s as (select word, coalesce(source,'unknown') origin, count(*) hits from {_HITS} group by all),
w as (select word, sum(hits)::bigint total_hits, string_agg(origin || '=' || hits, ', ' order by origin || '=' || hits) hits_by_source from s group by 1)
select l.word, coalesce(total_hits, 0) total_hits, coalesce(hits_by_source, '') hits_by_source from {LEXICON_SQL} left join w on w.word = l.word""",
    "lexicon_filter": f"select distinct word, topic from {_HITS}",
    "build_samples": f"select doc_id, string_agg(word, ' | ' order by -length(word), _pos) entries, count(*) n from {_HITS} group by 1",
    "cloze_samples": f"""select distinct doc_id, word, base from {_hits('base')} where (doc_id, word) not in (select (doc_id, word) from {_HITS})""",
    "dedupe_samples": f"""select doc_id, string_agg(word, ' | ' order by word) entries from {_HITS} where coalesce(source,'') <> 'hoi_dap'
and word not in (select word from {_HITS} where source = 'hoi_dap') group by 1""",
    "split_by_prefix": f"""select doc_id, coalesce(string_agg(word, ' | ' order by -length(word), _pos) filter (topic like 'đồ%'), '') matched,
coalesce(string_agg(word, ' | ' order by -length(word), _pos) filter (topic not like 'đồ%'), '') rest from {_HITS} group by 1""",
    "corpus_examples": f"select word, rank, doc_id from (select word, doc_id, row_number() over (partition by word order by doc_id) rank from {_HITS}) where rank <= 3",
    "scan_dictionary": f"""select id, array_to_string(terms, ' ') terms, len(terms)::bigint n from (select distinct id, list_filter({_DROVER}, lambda w: w in {_DICT}) terms from samples where asr_rover is not null) where len(terms) > 0""",
    "term_verification": f"""with p as (select w term, case when i % 3 <> 0 then 'noun' else 'other' end kind from (values {",".join(f"({i},'{w}')" for i, w in enumerate(DICTIONARY))}) v(i, w)),
s as (select distinct id, final_asr_text from samples where final_asr_text is not null), t as (select id, final_asr_text, unnest(list_distinct({raw_words_sql("lower(final_asr_text)")})) term from s)
select id, t.term from t join p using (term) where contains(final_asr_text, t.term) and kind in ('noun','verb')""",
    "bigram_mining": f"""with w as (select list_filter(string_split({norm_sql('text')},' '), lambda w: w <> '') ws from documents where lang = 'vi'),
p as (select ws[i] a, ws[i+1] b from (select ws, unnest(range(1, len(ws))) i from w)), c as (select a, b, count(*) n from p where a <> b group by all having count(*) >= 3),
r as (select a, b, n, regexp_extract({_BARE.format(c='a')}, '([{T.PLAIN_VOWELS}].*)$', 1) ra, regexp_extract({_BARE.format(c='b')}, '([{T.PLAIN_VOWELS}].*)$', 1) rb from c)
select a, b, n, rb rhyme from r where ra = rb and length(rb) >= 2""",
    "merge_sources": """with r as (select 0 ord, 'documents' origin, doc_id::varchar key from documents union all select distinct 1, 'samples', id from samples union all select 2, 'eval_items', item_id::varchar from eval_items)
select row_number() over (order by ord, left(key, 6), key) - 1 number, origin, key from r""",
}
