"""Mixing of sources: odd rows, limits, many sources, copies, and that the plan stays native."""

import pytest
from pyspark.sql import functions as F

from roundhaul.llm import mixing
from roundhaul.llm.common import Scratch
from roundhaul.llm.queries import QUERIES

DOCS = "doc_id long, text string, source string, size string, target int, rate int, copies int, copy int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2, 3, 4) for i, t, s in rows], DOCS)


def words(n):
    return "w " * n


def planned(docs, spark, **settings):
    scratch = Scratch(spark, "test")
    sized = mixing.sizes(docs, scratch)
    return sized, mixing.rates(sized, scratch, **settings)


def shares(sizes, weights, most, wanted):
    """Shares by weight, those above a limit held at it, the rest shared anew: one source a round."""
    held = {}
    while True:
        free = [s for s in sizes if s not in held]
        rest, weight = wanted - sum(held.values()), sum(weights[s] for s in free)
        found = {s: weights[s] * rest / weight for s in free}
        above = [s for s in free if found[s] > most * sizes[s]]
        if not above:
            return held | found
        held[above[0]] = most * sizes[above[0]]


@pytest.mark.parametrize(
    "text", [None, "", " ", "a", " a b\t\n", "a\x0bb\x0cc\r", "a b", " ", "ä\x1fb  c", "x " * 100_000, " " * 100_000]
)
def test_words(spark, text):
    found = spark.createDataFrame([(text,)], "text string").select(mixing.word_count(F.col("text"))).first()[0]
    assert found == len((text or "").encode().split())


def test_sources(spark):
    sizes = {"Z": 1, "a": 500, "b": 2, "é": 900, "\U0001f600": 4, "￮": 10, None: 3000, "": 7}
    rows = [(i, words(n), s) for i, (s, n) in enumerate(sizes.items())]
    _, found = planned(documents(spark, rows), spark)
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    wanted = shares(sizes, weights, 3, sum(sizes.values()))
    for row in found.collect():
        assert (row["size"], row["weight"]) == (sizes[row["source"]], weights[row["source"]])
        assert row["target"] == pytest.approx(wanted[row["source"]]) and row["rate"] <= 3
    assert sum(wanted.values()) == pytest.approx(sum(sizes.values()))


def test_given_weights_and_words(spark):
    docs = documents(spark, [(1, words(100), "a"), (2, words(50), "b"), (3, words(9), "c"), (4, words(5), None)])
    given = spark.createDataFrame([("a", 1), ("b", 4), (None, 1), ("nowhere", 5)], "source string, weight int")
    _, found = planned(docs, spark, weights=given, most=2, words=150)
    by = {r["source"]: (r["target"], r["rate"]) for r in found.collect()}
    assert by == {"a": (40.0, 0.4), "b": (100.0, 2.0), "c": (0.0, 0.0), None: (10.0, 2.0)}
    _, found = planned(docs, spark, most=2, words=10**6)
    assert {r["rate"] for r in found.collect()} == {2.0}


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, "", "a"), (2, words(60_000), "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "x y", None), (4, None, "none")]
    docs = documents(spark, rows)
    sized, found = planned(docs, spark)
    out = mixing.copies(sized, found).collect()
    assert len(out) == len(rows) and {r["rate"] for r in out if r["source"] == "none"} == {0.0}
    assert len({r["copies"] for r in out if r["doc_id"] == 3}) == 1
    assert all(r["copies"] <= 3 for r in out)
    mixed = mixing.emitted(docs, found)
    assert mixed.columns == docs.columns and dict(mixed.dtypes)["size"] == "string"
    times = {r["doc_id"]: r["copies"] for r in out}
    seen = [(r["doc_id"], r["copy"]) for r in mixed.collect() if r["doc_id"] in (2, None)]
    assert sorted(seen, key=str) == sorted([(i, k + 1) for i in (2, None) for k in range(times[i])], key=str)
    sized, found = planned(docs.where("false"), spark)
    assert mixing.copies(sized, found).collect() == [] and mixing.emitted(docs.where("false"), found).collect() == []


def test_many_sources_are_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    rows = [(i, words(i % 7), None if i % 3 == 0 else f"s{i % 500}") for i in range(3000)]
    sized, found = planned(documents(spark, rows), spark)
    parted = mixing.copies(sized, found)
    assert "BroadcastHashJoin [_source" not in parted._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 1 << 30)
    assert sorted(parted.collect(), key=str) == sorted(mixing.copies(sized, found).collect(), key=str)


def test_copies_follow_the_rate(spark):
    docs = documents(spark, [(i, words(10), "a" if i % 4 else "b") for i in range(8000)])
    sized, found = planned(docs, spark)
    taken = mixing.copies(sized, found).groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("n"))
    for row in taken.collect():
        assert row["n"] == pytest.approx(row["target"], rel=0.03)
    other = mixing.copies(sized, found, seed=5)
    assert other.exceptAll(mixing.copies(sized, found)).count() > 0


def test_plan_is_native(spark):
    text = QUERIES["op11_mixed_sources"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not [word for word in ("Python", "MapInArrow", "MapInPandas", "CartesianProduct", "ExternalRDD") if word in text]
