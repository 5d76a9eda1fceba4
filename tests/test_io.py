"""Sources, sinks, streams and the model boundary."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvida.operators.models import Fallback, call_in_batches, consensus_vote, lenient_json, relay
from corvida.operators.tables import numbered
from corvida.plans.validation_queries import issues, joined_captions, raise_if_failed
from corvida.sources import records
from corvida.streaming.resume import process_files, sessions


def test_records_in_lines_and_arrays(spark, tmp_path):
    rows = [{"text": "a"}, {"transcript": "b", "audio": "x.wav"}, {"text": ""}]
    (tmp_path / "lines.json").write_text("\n\n".join(map(json.dumps, rows)))
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=1))
    for name in ("lines.json", "array.json"):
        got = records.read_transcripts(spark, str(tmp_path / name))
        assert sorted((r["text"], r["audio"], r["source_file"]) for r in got.collect()) == [("a", None, name), ("b", "x.wav", name)]


def test_lexicon_keeps_last_row_at_first_place(spark, tmp_path):
    (tmp_path / "l.csv").write_text("﻿Từ,Nghĩa\n a ,1\nb,2\n,9\na,3\n", encoding="utf-8")
    got = records.read_lexicon(spark, str(tmp_path / "l.csv"), "Từ").orderBy("_pos").collect()
    assert [(r["Từ"], r["Nghĩa"]) for r in got] == [("a", "3"), ("b", "2")]


def test_cues(spark, tmp_path):
    (tmp_path / "a.srt").write_text("1\n00:00:01,250 --> 00:00:02,500\nxin <i>chào</i>\nbạn\n\n2\n01:00:00,000 --> 01:00:01,000\n\n")
    got = records.read_cues(spark, str(tmp_path / "a.srt")).collect()
    assert [(r["start"], r["end"], r["text"]) for r in got] == [(1.25, 2.5, "xin chào bạn")]


def test_versions_and_resumed_appends(spark, tmp_path):
    path = str(tmp_path / "v")
    assert records.list_versions(spark, path) == []
    assert records.save_version(spark.range(3), path) == 1 and records.save_version(spark.range(5), path) == 2
    assert records.list_versions(spark, path) == [1, 2] and records.load_version(spark, path, 1).count() == 3
    out = str(tmp_path / "o")
    records.append_missing(spark.range(3), out, "id")
    records.append_missing(spark.range(6), out, "id")
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4, 5]


def test_stream_processes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = T.StructType([T.StructField("n", T.LongType())])
    args = (str(source), schema, str(tmp_path / "out"), str(tmp_path / "cp"), lambda df: df.select((F.col("n") * 2).alias("n")))
    for i in range(2):
        (source / f"{i}.json").write_text(json.dumps({"n": i + 1}))
        process_files(spark, *args)
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 4]


def test_sessions_end_after_a_gap(spark):
    rows = spark.createDataFrame([("u", 0), ("u", 10), ("u", 100)], "k string, s long").select("k", F.timestamp_seconds("s").alias("t"))
    assert sorted(r["n"] for r in sessions(rows, "k", "t").collect()) == [1, 2]


def test_model_calls_fall_back(spark):
    def call(payloads):
        return [(p, p.upper()) for p in payloads if p != "c"]

    items = spark.createDataFrame([(x, x) for x in "abc"], "id string, payload string")
    got = {r["id"]: (r["answer"], r["answered"]) for r in call_in_batches(items, call, "none", batch=2).collect()}
    assert got == {"a": ("A", True), "b": ("B", True), "c": ("none", False)}


def test_lenient_answers():
    assert lenient_json('x ```json\n{"a": 1}\n``` y ```json\n{"a": 2}\n```') == {"a": 2}
    assert lenient_json('```json\n{"a": "it\\\'s"}') == {"a": "it's"} and lenient_json("none") is None
    assert consensus_vote("… consensus: final") == "FINAL" and consensus_vote("") is None


def test_polymorphic_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"vivos": [{"text": "x", "audio": "1.wav"}, {"transcript": "y", "audio_filepath": "d/2.wav"}, {"text": ""}]}))
    got = {tuple(r) for r in records.read_grouped_transcripts(spark, str(tmp_path / "a.json")).collect()}
    assert got == {("x", "data/vivos/1.wav", "vivos"), ("y", "d/2.wav", "vivos")}
    (tmp_path / "l.json").write_text('{"n": 1}\n\n{"n": 2}\n')
    (tmp_path / "m.json").write_text("[\n{\n\"n\": 3}]")
    schema = T.StructType([T.StructField("n", T.LongType())])
    assert sorted(r["n"] for r in records.read_tolerant(spark, [str(tmp_path / "l.json"), str(tmp_path / "m.json")], schema).collect()) == [1, 2, 3]
    assert records.read_tolerant(spark, [], schema).count() == 0
    (tmp_path / "w.json").write_text(json.dumps([{"word": " a "}, {"word": "", "note": "x"}]))
    assert [tuple(r) for r in records.read_candidates(spark, str(tmp_path / "w.json")).collect()] == [("a", "")]
    (tmp_path / "d.txt").write_text("OK\n ok\n\nok\nSale\n")
    assert sorted(r[0] for r in records.read_dictionary(spark, str(tmp_path / "d.txt")).collect()) == ["ok", "sale"]
    with pytest.raises(ValueError):
        records.union_of_sources({})
    both = records.union_of_sources({"a": spark.createDataFrame([(1,)], "x int"), "b": spark.createDataFrame([(2,)], "y int")})
    assert sorted((r["origin"], r["x"], r["y"]) for r in both.collect()) == [("a", 1, None), ("b", None, 2)]


def test_line_files_and_cache(spark, tmp_path):
    (tmp_path / "ref").write_text("a\n\nc\n")
    (tmp_path / "sys").write_text("x\ny\nz")
    got = {tuple(r) for r in records.read_line_files(spark, {"ref": str(tmp_path / "ref"), "sys": str(tmp_path / "sys")}).collect()}
    assert got == {("ref", 0, "a"), ("ref", 1, ""), ("ref", 2, "c"), ("sys", 0, "x"), ("sys", 1, "y"), ("sys", 2, "z")}
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "1.json").write_text('{"text": "ok"}\n{"text": \n')
    schema = T.StructType([T.StructField("text", T.StringType())])
    assert [r["text"] for r in records.read_cached(spark, str(tmp_path / "cache"), schema).collect()] == ["ok"]
    assert records.read_cached(spark, str(tmp_path / "none"), schema).count() == 0


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, None), (1, "b"), (3, "c")], "k int, v string")
    records.write_csv(rows, str(tmp_path / "csv"), ["k"], "STT")
    got = sorted(tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect())
    assert [g[:2] for g in got] == [("1", "1"), ("2", "2"), ("3", "3")]
    records.write_split(rows, {str(tmp_path / "all"): None, str(tmp_path / "some"): F.col("v").isNotNull()})
    assert spark.read.json(str(tmp_path / "all")).count() == 3 and spark.read.json(str(tmp_path / "some")).count() == 2
    path = str(tmp_path / "v")
    assert [records.publish_version(rows, path, True), records.publish_version(rows, path, False)] == [1, 2]
    assert sorted((r["version"], r["rows"], r["passed"]) for r in spark.read.json(f"{path}/index").collect()) == [(1, 3, True), (2, 3, False)]
    schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("w", T.LongType())])
    once = records.with_columns_of(rows, schema)
    assert once.columns == ["k", "v", "w"] and records.with_columns_of(once, schema).columns == once.columns
    assert records.markdown_table(rows, ["k"]).first()["report"] == "| k | v |\n|---|---|\n| 1 | b |\n| 2 |  |\n| 3 | c |"


def test_fallback_sticks_to_what_worked_and_moves_on_when_all_fail():
    calls = []

    def model(name, fails):
        def call(payloads):
            calls.append(name)
            if name in fails:
                raise RuntimeError(name)
            return [(p, name) for p in payloads]

        return call

    fails = {"a"}
    policy = Fallback([model(n, fails) for n in "abc"])
    assert policy(["x"]) == [("x", "b")] and policy(["x"]) == [("x", "b")] and calls == ["a", "b", "b"]
    fails |= {"b", "c"}
    with pytest.raises(RuntimeError):
        policy(["x"])
    assert policy.at == 2


def test_relay_ends_with_agreement_or_the_last_round(spark):
    def call(payloads):
        asked = json.loads(payloads[0])
        if asked["model"] == "m1" and asked["state"] is None:
            return [("m1", f'{{"seen": {len(json.loads(asked["units"]))}}} CONSENSUS: CONTINUE')]
        return [(asked["model"], f'{asked["state"]} CONSENSUS: FINAL')]

    units = spark.createDataFrame([(n, f"u{n}") for n in range(5)], "pos long, unit string")
    got = {r["batch"]: (r["rounds"], r["state"], r["consensus"]) for r in relay(units, call, ["m1", "m2"], 4, 3).collect()}
    assert got == {0: (2, '{"seen": 3}', True), 1: (2, '{"seen": 2}', True)}
    assert {r["consensus"] for r in relay(units, call, ["m1", "m2"], 1, 3).collect()} == {False}


def test_failed_calls_are_told_and_tried_alone(spark):
    def call(payloads):
        if len(payloads) > 1:
            raise RuntimeError("too long")
        return [(payloads[0], "ok")]

    items = spark.createDataFrame([(x, x) for x in "abcd"], "id string, payload string").coalesce(1)
    assert {r["error"] for r in call_in_batches(items, call, "none", batch=2).collect()} == {"too long"}
    assert {r["answer"] for r in call_in_batches(items, call, "none", batch=2, one_by_one=True).collect()} == {"ok"}


def test_issues_short_circuit_and_the_gate(spark):
    schema = "id string, text_vi string, text_en string, text_vi_cased string, text_en_cased string, audio_path string, duration_sec double, there boolean, actual_sec double, spoken boolean"
    good = ("a", "xin chào các bạn nhé", "hello", None, None, "p", 1.0, True, 1.2, True)
    rows = [good, ("b", "", *good[2:]), ("c", *good[1:7], False, 9.0, False), ("d", "xin chao cac ban nhe", "đi", "Khác", None, "p", 1.0, True, 1.6, None), (None, *good[1:]), ("e", *good[1:6], 0.0, True, 0.0, None)]
    got = sorted((r["id"] or "", r["check"]) for r in issues(spark.createDataFrame(rows, schema)).collect())
    assert got == sorted([("", "missing_field"), ("b", "missing_field"), ("c", "audio_missing"), ("d", "duration_mismatch"), ("d", "normalization_invariant_vi"), ("d", "text_en_contains_vietnamese"), ("d", "text_vi_missing_diacritics")])
    raise_if_failed(issues(spark.createDataFrame([good], schema)))
    with pytest.raises(ValueError, match=r"7 issues[\s\S]*missing_field: 2"):
        raise_if_failed(issues(spark.createDataFrame(rows, schema)))


def test_rolling_captions_are_joined_once():
    assert joined_captions(["hello there my", "hello there my friend", "friend", "and more"]) == "hello there my friend friend and more"
    assert joined_captions(["the cat sat on", "cat sat on the mat"]) == "the cat sat on the mat" and joined_captions([]) == "" and joined_captions(["a", "", "b"]) == "a b"


def test_rows_are_numbered_in_order_over_all_tasks(spark):
    rows = spark.range(1000).repartition(7).select((F.col("id") * 7919 % 1000).alias("k"))
    got = numbered(rows, ["k"], "n").collect()
    assert {r["k"]: r["n"] for r in got} == {n: n for n in range(1000)} and numbered(rows.limit(0), ["k"], "n").count() == 0
