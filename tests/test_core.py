"""Core operators: queries against their SQL on the smallest tables, and hand cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corvida.functions import text as T
from corvida.operators import lexicon, tables
from corvida.plans import registry
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SF, registry.queries()[name], registry.oracle_sql()[name]) == ""


def test_every_sql_has_a_query():
    assert registry.oracle_sql().keys() <= registry.queries().keys()


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_normalising_is_idempotent_and_composes(spark):
    once = _one(spark, T.normalized(F.lit("Tiếng_Việt,  ĐẸP!")))
    assert once == "tiếng việt đẹp"
    assert _one(spark, T.normalized(F.lit(once))) == once
    assert _one(spark, T.normalized(F.lit(None).cast("string"))) == ""


def test_repetition_counts_overlapping_runs(spark):
    assert _one(spark, T.repetition(F.lit("a b"))) == 0.0
    assert _one(spark, T.repetition(F.lit("la la la la"))) == pytest.approx(1.5)


def test_mutation_of_first_syllable(spark):
    rows = {"đỏ": "đo", "sạch": "sành", "tốt": "tôn", "khít": "khin", "xanh": "xanh", "đẹp": "đèm"}
    got = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k in rows], "s string").select("s", T.mutated(F.col("s"))).collect()}
    assert got == rows


def test_entry_needs_boundaries_and_may_hold_signs(spark):
    corpus = spark.createDataFrame([(1, "ba/má đi"), (2, "bam/ám đi"), (3, None), (4, "")], "doc_id long, text string")
    words = spark.createDataFrame([("ba/má",), ("đi",), ("a",), ("",)], "word string")
    got = {(r["doc_id"], r["word"]) for r in lexicon.matches(corpus, words, "word").collect()}
    assert got == {(1, "ba/má"), (1, "đi"), (2, "đi")}


def test_overlay_keeps_what_edits_leave_blank(spark):
    base = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id long, x string, y string")
    edits = spark.createDataFrame([(1, " ", "new"), (9, "z", "z")], "id long, x string, y string")
    got = {r["id"]: (r["x"], r["y"], r["touched"]) for r in tables.overlay(base, edits, "id", ["x", "y"]).collect()}
    assert got == {1: ("a", "new", True), 2: ("c", "d", False)}


def test_fill_overwrites_with_null_where_matched(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    right = spark.createDataFrame([(1, None)], "id long, x string")
    assert {r["id"]: r["x"] for r in tables.fill(left, right, "id", ["x"]).collect()} == {1: None, 2: "b"}


def test_new_columns_hold_only_their_voter():
    from corvida.operators.rover import network

    columns = network([(["a", "b"], 1.0), (["a", "x", "b"], 0.5)])
    assert [[v[1] for v in c] for c in columns] == [["a", "a"], ["x"], ["b", "b"]]
    assert network([]) == [] and network([([], 1.0), (["a"], 0.5)]) == [[(1, "a", 0.5)]]


def test_votes_by_weight_then_count(spark):
    from corvida.operators import rover

    rows = [([(["một", "hai"], 0.9), (["một", "hay"], 0.5), (["một", "hay"], 0.5)],), ([(["a"], 0.4), ([], 0.4)],)]
    schema = "voters array<struct<words:array<string>,weight:double>>"
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(rover.voted_text(rover.aligned("voters"))).collect()]
    assert got == ["một hay", "a"]
