"""Reports, question generation, segmentation and score parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvida.session import table


def category_tree(spark, sf_dir):
    """Counts on four levels with subtotals."""
    part = table(spark, sf_dir, "part").withColumn("size_class", (F.col("p_size") / 10).cast("int").cast("string"))
    rolled = part.rollup("p_brand", "p_type", "size_class").agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level"))
    return rolled.select("p_brand", "p_type", "size_class", "n", "level")


def manifest_stats(spark, sf_dir):
    """Totals, distinct values and shares of the review table in one pass."""
    return table(spark, sf_dir, "samples").agg(
        F.count("*").alias("total"), F.countDistinct("id").alias("ids"), F.count_if(F.col("status") == "done").alias("done"),
        F.round(F.count_if(F.col("mt_en").isNull()) / F.count("*"), 6).alias("untranslated"), F.countDistinct("speaker_id").alias("speakers"),
    )


def top_values(spark, sf_dir):
    counts = table(spark, sf_dir, "samples").where("speaker_id is not null").groupBy("speaker_id").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "speaker_id").limit(10)


def system_means(spark, sf_dir):
    """Mean confidence by voter and by voter and data set; missing values are left out of the mean, missing keys out of the table."""
    rows = table(spark, sf_dir, "asr_results").withColumn("domain", F.substring_index("audio_relpath", "/", 1)).where("model_name is not null")
    means = rows.groupBy("model_name", "domain").agg(F.round(F.avg("confidence"), 6).alias("mean"), F.count("confidence").alias("n"))
    total = rows.groupBy("model_name").agg(F.round(F.avg("confidence"), 6).alias("mean"), F.count("confidence").alias("n")).withColumn("domain", F.lit("all"))
    return means.unionByName(total)


def placeholders(spark, sf_dir):
    """A row for each voter and data set, also where it has no answer."""
    rows = table(spark, sf_dir, "asr_results").withColumn("domain", F.substring_index("audio_relpath", "/", 1))
    have = rows.where("error is null").groupBy("model_name", "domain").agg(F.count("*").alias("n"))
    grid = rows.select("domain").distinct().withColumn("model_name", F.explode(F.array(*map(F.lit, ("chirp3", "internal_whisper", "phowhisper", "none")))))
    return grid.join(have, ["model_name", "domain"], "left").fillna(0, ["n"])


def run_counters(spark, sf_dir):
    """Fresh, retried and failed calls by voter."""
    retried = F.col("extra")["attempt"] != "1"
    return table(spark, sf_dir, "asr_results").groupBy("model_name").agg(
        F.count("*").alias("calls"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_if(F.coalesce(retried, F.lit(False))).alias("retried"),
        F.round(F.sum("latency_sec"), 4).alias("seconds"),
    )


def usage_cost(spark, sf_dir):
    """Calls, tokens and cost by dataset at a price for a million tokens, and for a thousand samples."""
    prices = spark.createDataFrame([("batched", 0.25, 1.5), ("fallback_single", 0.5, 3.0)], "mode string, price_in double, price_out double")
    size = lambda c: F.aggregate(F.map_values(c), F.lit(0), lambda a, x: a + F.coalesce(F.length(x), F.lit(0)))
    rows = table(spark, sf_dir, "translation_results").where("attempted_fields is not null").join(table(spark, sf_dir, "translation_units"), "sample_index").join(prices, "mode")
    used = rows.select("dataset", "mode", (size("fields") / 4).alias("i"), (size("attempted_fields") / 4).alias("o"), "price_in", "price_out")
    cost = F.sum((F.col("i") * F.col("price_in") + F.col("o") * F.col("price_out")) / 1e6)
    return used.groupBy("dataset", "mode").agg(F.count("*").alias("calls"), F.round(cost, 6).alias("cost"), F.round(cost / F.count("*") * 1000, 6).alias("per_thousand"))


def success_rates(spark, sf_dir):
    """Success by dataset, and what ten million units would leave failed at that rate."""
    rows = table(spark, sf_dir, "translation_units").join(table(spark, sf_dir, "translation_results"), "sample_index").groupBy("dataset").agg(F.count("*").alias("n"), F.count_if("ok").alias("good"))
    return rows.select("dataset", "n", "good", F.round(F.col("good") / F.col("n") * 100, 4).alias("percent"), F.round((1 - F.col("good") / F.col("n")) * 10_000_000).cast("bigint").alias("failed_of_10m"))


def failed_ids(spark, sf_dir):
    """Units that failed, in the order of their first failure."""
    failed = table(spark, sf_dir, "translation_results").where("error is not null").groupBy("sample_index").agg(F.min("finished_at").alias("first"), F.count("*").alias("failures"))
    return failed.select("sample_index", F.unix_micros(F.col("first").cast("timestamp")).alias("first"), "failures")


def consensus_rounds(spark, sf_dir):
    """First round in which all of a sample's votes agree: rounds are three votes each, in the order of voting."""
    order = Window.partitionBy("sample_id").orderBy("voted_at", "vote_id")
    rounds = table(spark, sf_dir, "draft_votes").withColumn("round", F.floor((F.row_number().over(order) - 1) / 3) + 1)
    agreed = rounds.groupBy("sample_id", "round").agg((F.min(F.coalesce("label", F.lit("?"))) == F.max(F.coalesce("label", F.lit("?")))).alias("same"))
    return agreed.where("same").groupBy("sample_id").agg(F.min("round").cast("bigint").alias("round"))


def last_state(spark, sf_dir):
    """For each vote, the last readable label of its sample before it."""
    before = Window.partitionBy("sample_id").orderBy("voted_at", "vote_id").rowsBetween(Window.unboundedPreceding, -1)
    votes = table(spark, sf_dir, "draft_votes").distinct()
    return votes.select("vote_id", "sample_id", F.last(F.when(F.trim("label") != "", F.col("label")), ignorenulls=True).over(before).alias("state"))


def metric_correlation(spark, sf_dir):
    """Pearson correlation of confidence and latency by voter."""
    return table(spark, sf_dir, "asr_results").where("confidence is not null and latency_sec is not null").groupBy("model_name").agg(F.round(F.corr("confidence", "latency_sec"), 6).alias("r"), F.count("*").alias("n"))


def version_index(spark, sf_dir):
    """The number that the next snapshot gets, and how many rows each day's snapshot would have."""
    days = table(spark, sf_dir, "samples").where("updated_at is not null").groupBy(F.to_date("updated_at").cast("string").alias("day")).agg(F.count("*").alias("rows"))
    return days.select("day", "rows", F.row_number().over(Window.orderBy("day")).cast("bigint").alias("version"))


def explode_levels(spark, sf_dir):
    """A record for each level up to a part's own, with composite ids."""
    part = table(spark, sf_dir, "part").withColumn("top", (F.col("p_size") % 3 + 1).cast("int"))
    return part.select(F.explode(F.sequence(F.lit(1), F.col("top"))).alias("level"), "p_partkey").select(F.format_string("%d__L%d", "p_partkey", "level").alias("id"), F.col("level").cast("bigint").alias("level"))


def position_ids(spark, sf_dir):
    """Ids by position of the field within its unit; fields that are later dropped count as well."""
    rows = table(spark, sf_dir, "translation_units").select("sample_index", F.posexplode(F.array_sort(F.map_keys("fields"))).alias("pos", "field"))
    return rows.where("field <> 'question'").select(F.format_string("unit-%04d-w%d", "sample_index", "pos").alias("id"), "field")


SEED = "42"


def distractors_tiered(spark, sf_dir):
    """Three wrong brands for each part: brands of its type first, then of all, in seeded md5 order.

    A part looks at the first few candidates of its type and at the first few of all, which are ranked once.
    """
    from corvida.plans.generation_queries import distractors, first_candidates

    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    found = first_candidates(part, part, "p_type", "p_brand").withColumn("wrong", distractors(F.col("p_brand"), F.col("near"), F.col("far")))
    return found.where("wrong is not null").select("p_partkey", F.posexplode("wrong").alias("pos", "b")).select("p_partkey", "b", (F.col("pos") + 1).cast("bigint").alias("rank"))


def choice_order(spark, sf_dir):
    """Choices in an order that depends on seed, id and choice only."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array("p_brand", "p_type", "p_name")).alias("c")).distinct()
    item = F.struct(F.md5(F.concat_ws("|", F.lit(SEED), F.col("p_partkey").cast("string"), "c")).alias("k"), "c")
    return rows.groupBy("p_partkey").agg(F.concat_ws(" | ", F.transform(F.array_sort(F.collect_list(item)), lambda x: x["c"])).alias("choices"))


def count_questions(spark, sf_dir):
    """Number questions: how many readable votes a sample has, with the other numbers of 1 to 5 to choose from."""
    n = table(spark, sf_dir, "draft_votes").where("trim(label) <> ''").groupBy("sample_id").agg(F.countDistinct("annotator_id").alias("n"))
    others = F.array_except(F.sequence(F.lit(1), F.lit(5)), F.array(F.col("n").cast("int")))
    return n.where("n >= 2").select("sample_id", "n", F.concat_ws(" ", F.transform(others, lambda x: x.cast("string"))).alias("others"))


def _cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", ts.cast("double").alias("start"), (ts + F.floor("value")).cast("double").alias("end"))


GAP, SPAN = 20_000.0, 200_000.0


def _fold(cues: Column) -> Column:
    """Greedy segments over the sorted cues of one island: too long a span closes one."""
    segment = lambda s, e: F.struct(s.alias("start"), e.alias("end"))
    empty = F.expr("cast(array() as array<struct<start:double,end:double>>)")

    def step(acc: Column, c: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        closes = last.isNull() | (c["end"] - last["start"] > SPAN)
        return F.when(closes, F.concat(acc, F.array(segment(c["start"], c["end"])))).otherwise(
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(segment(last["start"], c["end"])))
        )

    return F.aggregate(cues, empty, step)


def _segments(spark, sf_dir) -> DataFrame:
    """(user_id, start, end): a gap closes a segment whatever came before it, so cues are cut into islands at gaps and
    only an island, which a pause of the speaker ends, is folded in one row."""
    order = Window.partitionBy("user_id").orderBy("start", "event_id", "end")
    opens = F.coalesce(F.col("start") - F.lag("end").over(order) > GAP, F.lit(True))
    cues = _cues(spark, sf_dir).withColumn("opens", opens.cast("int")).withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = cues.groupBy("user_id", "island").agg(F.array_sort(F.collect_list(F.struct("start", "event_id", "end"))).alias("cues"))
    folded = islands.select("user_id", "island", F.posexplode(_fold(F.col("cues"))).alias("pos", "s"))
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("island", "pos")) - 1
    return folded.select("user_id", number.cast("bigint").alias("segment"), "s.start", "s.end")


def segments_greedy(spark, sf_dir):
    return _segments(spark, sf_dir)


LEAST = 30_000.0


def fold_short_segments(spark, sf_dir):
    """Segments shorter than LEAST joined to the one before them, if both together are not too long."""
    segment = lambda s, e: F.struct(s.alias("start"), e.alias("end"))
    empty = F.expr("cast(array() as array<struct<start:double,end:double>>)")

    def step(acc: Column, c: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joins = (c["end"] - c["start"] < LEAST) & last.isNotNull() & (c["end"] - last["start"] <= SPAN)
        return F.when(joins, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(segment(last["start"], c["end"])))).otherwise(F.concat(acc, F.array(segment(c["start"], c["end"]))))

    listed = _segments(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("segment", "start", "end"))).alias("s"))
    return listed.select("user_id", F.posexplode(F.aggregate("s", empty, step)).alias("pos", "s")).select("user_id", F.col("pos").cast("bigint").alias("segment"), "s.start", "s.end")


def segment_ids(spark, sf_dir):
    """Segments with ids by their number; those that are too short are left out after numbering, so numbers have gaps."""
    rows = _segments(spark, sf_dir).where(F.col("end") - F.col("start") >= LEAST)
    return rows.select(F.format_string("%d_seg%04d", "user_id", "segment").alias("id"), "start", "end")


def cue_overlap_join(spark, sf_dir):
    """Purchases that overlap a view of the same user, found over shared time buckets instead of all pairs."""
    width = 3600.0
    kind = lambda k: _cues(spark, sf_dir).where(F.col("event_type") == k)
    spread = lambda df: df.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    a, b = spread(kind("view")).alias("a"), spread(kind("purchase")).alias("b")
    joined = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.bucket") == F.col("b.bucket")))
    hits = joined.where("a.start < b.end and a.end > b.start").select(F.col("a.event_id").alias("view_id"), F.col("b.event_id").alias("purchase_id")).distinct()
    return hits


ANSWERS = (
    "Critical:\nno-error\nMajor:\naccuracy/mistranslation - 'x'\nMinor:\n- fluency/grammar - 'y'\nstyle/awkward - 'z'",
    "Major:\nno other major errors\nMinor:\nno-error", "Critical:\nnon-translation\naccuracy/omission\nMajor:\nfluency/punctuation", "Minor:\nterminology - a\nother - b\nstyle - c\nstyle - d\nstyle - e\nstyle - f",
    "accuracy - before any header",
)
_CATEGORY = "^(accuracy|fluency|locale convention|style|terminology|non-translation|other)"


def mqm_score(spark, sf_dir):
    """Score of an answer: 25, 5 and 1 by severity, the first five errors from critical to minor, 25 at most, negated."""
    rows = spark.createDataFrame(list(enumerate(ANSWERS)), "answer_id long, answer string")
    lines = rows.select("answer_id", F.posexplode(F.split(F.lower("answer"), "\n")).alias("pos", "line")).withColumn("line", F.trim("line"))
    header = F.when(F.col("line").isin("critical:", "major:", "minor:"), F.regexp_replace("line", ":", ""))
    level = F.last(header, ignorenulls=True).over(Window.partitionBy("answer_id").orderBy("pos"))
    body = F.regexp_replace("line", "^[-*• ]+", "")
    errors = lines.withColumn("level", level).where(body.rlike(_CATEGORY) & ~F.col("line").rlike("no-error|no error") & F.col("level").isNotNull())
    errors = errors.withColumn("level", F.when(F.col("line").contains("non-translation"), "critical").otherwise(F.col("level")))
    weight = F.when(F.col("level") == "critical", 25).when(F.col("level") == "major", 5).otherwise(1)
    first = errors.withColumn("w", weight).withColumn("n", F.row_number().over(Window.partitionBy("answer_id").orderBy(F.desc("w"), "pos"))).where("n <= 5")
    scored = first.groupBy("answer_id").agg((-F.least(F.lit(25), F.sum("w"))).cast("bigint").alias("score"))
    return rows.select("answer_id").join(scored, "answer_id", "left").fillna(0, ["score"])


NUMBERS = ("85", "score: 90", "['70']", "3 of 5", "none", "42/100", "0 or 100")


def number_of(answer: Column) -> Column:
    """The one number of an answer, or n of `n/100`; null when it is ambiguous or out of 0 to 100."""
    found = F.regexp_extract_all(answer, F.lit(r"(\d+)"), F.lit(1))
    number = F.when(F.size(found) == 1, F.get(found, F.lit(0))).when(answer.rlike(r"^\d*/100$"), F.substring_index(answer, "/", 1)).try_cast("bigint")
    return F.when(number.between(0, 100), number)


def numeric_answer(spark, sf_dir):
    """The numbers in the answers of the test items, and in examples of what scorers say."""
    rows = spark.createDataFrame([(a,) for a in NUMBERS], "answer string").unionByName(table(spark, sf_dir, "eval_items").where("answer is not null").select("answer"))
    return rows.select("answer", number_of(F.col("answer")).alias("number"))


QUERIES = {
    f.__name__: f
    for f in (
        category_tree, manifest_stats, top_values, system_means, placeholders, run_counters, usage_cost, success_rates, failed_ids, consensus_rounds, last_state, metric_correlation, version_index,
        explode_levels, position_ids, distractors_tiered, choice_order, count_questions, segments_greedy, fold_short_segments, segment_ids, cue_overlap_join, mqm_score, numeric_answer,
    )
}

_CUES = "(select user_id, event_id, event_type, floor(epoch(ts))::double as start, (floor(epoch(ts)) + floor(value))::double as \"end\" from events)"
_SEGMENTS = f"""c as (select *, row_number() over (partition by user_id order by start, event_id, "end") rn from {_CUES}),
w as (select user_id, rn, start, "end", 0::bigint segment from c where rn = 1 union all
select c.user_id, c.rn, case when c.start - w."end" > {GAP} or c."end" - w.start > {SPAN} then c.start else w.start end, c."end", case when c.start - w."end" > {GAP} or c."end" - w.start > {SPAN} then w.segment + 1 else w.segment end
from w join c on c.user_id = w.user_id and c.rn = w.rn + 1),
s as (select user_id, segment, min(start) as start, arg_max("end", rn) as "end" from w group by 1, 2)"""
_SIZE = "list_sum(list_transform(map_values({c}), lambda x: coalesce(length(x), 0)))"
_ANS = "(values " + ",".join(f"({i}, '" + a.replace("'", "''").replace("\n", "' || chr(10) || '") + "')" for i, a in enumerate(ANSWERS)) + ") a(answer_id, answer)"
SQL = {
    "category_tree": """with p as (select p_brand, p_type, cast(floor(p_size / 10) as int)::varchar size_class from part)
select p_brand, p_type, size_class, count(*) n, grouping_id(p_brand, p_type, size_class)::bigint as level from p group by rollup (p_brand, p_type, size_class)""",
    "manifest_stats": """select count(*) total, count(distinct id) ids, count(*) filter (status = 'done') done, round(count(*) filter (mt_en is null) / count(*), 6) untranslated, count(distinct speaker_id) speakers from samples""",
    "top_values": "select speaker_id, count(*) n from samples where speaker_id is not null group by 1 order by 2 desc, 1 limit 10",
    "system_means": """with r as (select *, split_part(audio_relpath,'/',1) as domain from asr_results where model_name is not null)
select model_name, domain, round(avg(confidence), 6) mean, count(confidence) n from r group by all union all select model_name, 'all', round(avg(confidence), 6), count(confidence) from r group by 1""",
    "placeholders": """with r as (select *, split_part(audio_relpath,'/',1) as domain from asr_results), g as (select domain, unnest(['chirp3','internal_whisper','phowhisper','none']) model_name from (select distinct domain from r))
select g.model_name, g.domain, count(r.result_id) n from g left join r on r.model_name = g.model_name and r.domain = g.domain and r.error is null group by all""",
    "run_counters": """select model_name, count(*) calls, count(error) errors, count(*) filter (extra['attempt'] <> '1') retried, round(sum(latency_sec), 4) as seconds from asr_results group by 1""",
    "usage_cost": f"""with p(mode, price_in, price_out) as (values ('batched', 0.25::double, 1.5::double), ('fallback_single', 0.5, 3.0)),
u as (select u.dataset, r.mode, {_SIZE.format(c='u.fields')} / 4 i, {_SIZE.format(c='r.attempted_fields')} / 4 o, price_in, price_out from translation_results r join translation_units u on u.sample_index = r.sample_index join p on p.mode = r.mode where attempted_fields is not null)
select dataset, mode, count(*) calls, round(sum((i * price_in + o * price_out) / 1e6), 6) as cost, round(sum((i * price_in + o * price_out) / 1e6) / count(*) * 1000, 6) per_thousand from u group by all""",
    "success_rates": """with r as (select dataset, count(*) n, count(*) filter (ok) good from translation_units u join translation_results r on u.sample_index = r.sample_index group by 1)
select dataset, n, good, round(good / n * 100, 4) percent, round((1 - good / n) * 10000000)::bigint failed_of_10m from r""",
    "failed_ids": "select sample_index, epoch_us(min(finished_at)) as first, count(*) failures from translation_results where error is not null group by 1",
    "consensus_rounds": """with r as (select sample_id, label, (row_number() over (partition by sample_id order by voted_at, vote_id) - 1) // 3 + 1 as round from draft_votes),
a as (select sample_id, round, min(coalesce(label,'?')) = max(coalesce(label,'?')) same from r group by all) select sample_id, min(round)::bigint as round from a where same group by 1""",
    "last_state": """select vote_id, sample_id, last_value(case when trim(label) <> '' then label end ignore nulls) over (partition by sample_id order by voted_at, vote_id rows between unbounded preceding and 1 preceding) state
from (select distinct * from draft_votes)""",
    "metric_correlation": "select model_name, round(corr(confidence, latency_sec), 6) r, count(*) n from asr_results where confidence is not null and latency_sec is not null group by 1",
    "version_index": "select day, rows, row_number() over (order by day) as version from (select updated_at::date::varchar as day, count(*) as rows from samples where updated_at is not null group by 1)",
    "explode_levels": "select p_partkey || '__L' || l id, l::bigint as level from (select p_partkey, unnest(range(1, p_size % 3 + 2)) l from part)",
    "position_ids": "select format('unit-{:04d}-w{}', sample_index, pos - 1) id, field from (select sample_index, k[pos] field, pos from (select sample_index, list_sort(map_keys(fields)) k, unnest(range(1, len(map_keys(fields)) + 1)) pos from translation_units)) where field <> 'question'",
    "distractors_tiered": f"""with d as (select distinct p_type g, p_brand w, md5('{SEED}|' || p_brand) k from part), n as (select g, list(w order by k, w) l from (select *, row_number() over (partition by g order by k, w) r from d) where r <= 8 group by 1),
f as (select list(w order by k, w) l from (select distinct w, k from d order by k, w limit 8)), c as (select p_partkey, list_filter(list_concat(n.l, f.l), lambda w: w <> p_brand) s from part join n on n.g = p_type cross join f),
u as (select p_partkey, list_filter(s, lambda w, i: list_position(s, w) = i)[1:3] q from c) select p_partkey, unnest(q) b, unnest([1, 2, 3])::bigint as rank from u where len(q) = 3""",
    "choice_order": f"""with r as (select distinct p_partkey, c from (select p_partkey, unnest([p_brand, p_type, p_name]) c from part))
select p_partkey, string_agg(c, ' | ' order by md5(concat_ws('|', '{SEED}', p_partkey, c)), c) choices from r group by 1""",
    "count_questions": """with n as (select sample_id, count(distinct annotator_id) n from draft_votes where trim(label) <> '' group by 1)
select sample_id, n, array_to_string(list_filter([1,2,3,4,5], lambda x: x <> n), ' ') others from n where n >= 2""",
    "segments_greedy": f"with recursive {_SEGMENTS} select user_id, segment, start, \"end\" from s",
    "fold_short_segments": f"""with recursive {_SEGMENTS},
m as (select user_id, segment, 0::bigint g, start, "end" from s where segment = 0 union all
select s.user_id, s.segment, case when s."end" - s.start < {LEAST} and s."end" - m.start <= {SPAN} then m.g else m.g + 1 end, case when s."end" - s.start < {LEAST} and s."end" - m.start <= {SPAN} then m.start else s.start end, s."end"
from m join s on s.user_id = m.user_id and s.segment = m.segment + 1) select user_id, g segment, min(start) as start, arg_max("end", segment) as "end" from m group by 1, 2""",
    "segment_ids": f"""with recursive {_SEGMENTS} select format('{{}}_seg{{:04d}}', user_id, segment) id, start, "end" from s where "end" - start >= {LEAST}""",
    "cue_overlap_join": f"""select distinct a.event_id view_id, b.event_id purchase_id from {_CUES} a join {_CUES} b on a.user_id = b.user_id and a.start < b."end" and a."end" > b.start where a.event_type = 'view' and b.event_type = 'purchase'""",
    "mqm_score": f"""with l as (select answer_id, pos, trim(ls[pos]) line from (select answer_id, ls, unnest(range(1, len(ls) + 1)) pos from (select answer_id, string_split(lower(answer), chr(10)) ls from {_ANS}))),
v as (select *, last_value(case when line in ('critical:','major:','minor:') then replace(line,':','') end ignore nulls) over (partition by answer_id order by pos) lev from l),
e as (select answer_id, pos, case when contains(line,'non-translation') then 25 when lev = 'critical' then 25 when lev = 'major' then 5 else 1 end w from v
where regexp_matches(regexp_replace(line,'^[-*• ]+',''), '{_CATEGORY}') and not regexp_matches(line,'no-error|no error') and lev is not null),
f as (select *, row_number() over (partition by answer_id order by w desc, pos) n from e), s as (select answer_id, -least(25, sum(w))::bigint score from f where n <= 5 group by 1)
select a.answer_id, coalesce(score, 0) score from {_ANS} left join s on s.answer_id = a.answer_id""",
    "numeric_answer": r"""with a as (select answer, regexp_extract_all(answer, '\d+') f from (values """ + ",".join("('" + a.replace("'", "''") + "')" for a in NUMBERS) + r""") v(answer) union all select answer, regexp_extract_all(answer, '\d+') from eval_items where answer is not null),
n as (select answer, (case when len(f) = 1 then f[1] when regexp_matches(answer, '^\d*/100$') then split_part(answer,'/',1) end) as n from a)
select answer, case when try_cast(n as bigint) between 0 and 100 then try_cast(n as bigint) end as number from n""",
}
