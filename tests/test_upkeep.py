"""Kept profiles, discovery of keys and references, histories, and compaction."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roundhaul.contracts import Contract
from roundhaul.operators import discover, stats
from roundhaul.operators.audit import audit_inclusions
from roundhaul.operators.discover import candidate_keys, references
from roundhaul.operators.validate import differing_rows
from roundhaul.plans import loads
from roundhaul.session import fresh_folder
from roundhaul.sources import NotMigrated, Warehouse

WIDE = Contract.declare(
    "wide",
    {
        "id": "bigint not null",
        "day": "date",
        "moment": "datetime2(6)",
        "amount": "decimal(10,2)",
        "ratio": "float",
        "flag": "bit",
        "label": "nvarchar(400)",
        "raw": "varbinary(max)",
        "empty": "int",
    },
    partition_by=["day"],
)


def wide(spark, n):
    rows = []
    for i in range(n):
        moment = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 97)
        ratio = float("nan") if i % 11 == 0 else i / 7
        rows.append((i, moment.date(), moment, Decimal(i % 50), ratio, i % 2 == 0, f"{'x' * 300}{i % 90}" if i % 3 else None, bytes([i % 5]), None))
    return spark.createDataFrame(rows, WIDE.schema)


def test_profiles_merge_to_that_of_the_whole(spark, folder):
    stored, rows = Warehouse(spark, folder), wide(spark, 4000)
    load = stored.write(rows, WIDE)
    stored.keep_profile(WIDE, load.id)
    for bound in (None, ">= '2024-01-03'", "= '2024-01-02'", "= '1999-01-01'"):
        only = bound and F.expr(f"day_day {bound}")
        part = rows.where(f"day {bound}") if bound else rows
        exact = {r["column_name"]: r for r in stats.profile_columns(part, WIDE.required).collect()}
        n = part.count()
        for r in stored.profile(WIDE, only).collect():
            e = exact[r["column_name"]]
            assert (r["column_type"], r["position"], r["nullable"], r["null_count"]) == (e["column_type"], e["position"], e["nullable"], e["null_count"])
            cut = [v and v[:256] for v in (e["min_value"], e["max_value"])]
            assert r["row_count"] == n and [r["min_value"], r["max_value"]] == cut
            assert abs(r["distinct_estimate"] - e["distinct_count"]) <= 0.08 * e["distinct_count"]
        quartiles = {r["column_name"]: r["quartiles"] for r in stored.profile(WIDE, only).collect()}
        if n:
            ids = sorted(r["id"] for r in part.select("id").collect())
            for q, value in zip((0.25, 0.5, 0.75), quartiles["id"], strict=True):
                assert abs(sum(i <= value for i in ids) / n - q) < 0.02
            assert quartiles["moment"][0] < quartiles["moment"][2] and quartiles["amount"] is not None
        else:
            assert set(quartiles.values()) == {None}
        assert quartiles["label"] is None and quartiles["empty"] is None


def test_profiles_of_a_partial_reload_read_the_new_part_alone(spark, folder):
    stored, rows = Warehouse(spark, folder), wide(spark, 3000)
    first = stored.write(rows, WIDE)
    stored.keep_profile(WIDE, first.id)
    fresh = rows.where("day = '2024-01-02'").limit(10)
    second = stored.reload(fresh, WIDE)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        stored.profile(WIDE).collect()
    stored.keep_profile(WIDE, second.id)
    told = {r["column_name"]: r["row_count"] for r in stored.profile(WIDE).collect()}
    assert set(told.values()) == {second.rows}
    plan = stored.profile(WIDE)._jdf.queryExecution().executedPlan().toString()
    assert "/data/" not in plan
    stored.drop_loads("wide")
    assert {r["row_count"] for r in stored.profile(WIDE).collect()} == {second.rows}


def test_profile_of_an_empty_table(spark, folder):
    stored = Warehouse(spark, folder)
    stored.write(wide(spark, 0), WIDE)
    stored.keep_profile(WIDE, 1)
    assert {(r["row_count"], r["null_count"], r["distinct_estimate"], r["min_value"]) for r in stored.profile(WIDE).collect()} == {(0, 0, 0, None)}


def test_keys(spark):
    rows = [(i, i // 2, i % 2, "x", None if i == 3 else i, i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, half int, odd int, same string, holes int, `a.b` int")
    assert candidate_keys(df) == [("id",), ("half", "odd"), ("half", "a.b")]
    assert candidate_keys(df.drop("id", "half")) == []
    assert candidate_keys(df.drop("id"), most_columns=1) == []
    assert candidate_keys(df.where("false")) == []
    doubled = df.unionAll(df.limit(1))
    assert candidate_keys(doubled, 3) == []
    three = spark.createDataFrame([(a, b, c) for a in range(9) for b in range(9) for c in range(9)], "a int, b int, c int")
    assert candidate_keys(three, 3) == [("a", "b", "c")] and candidate_keys(three, 2) == []


@pytest.fixture
def narrow(monkeypatch):
    """Slices and tasks of few rows, and the sets that are counted by their values."""
    counted = []
    monkeypatch.setattr(discover, "SLICE_ROWS", 300)
    monkeypatch.setattr(discover, "TASK_ROWS", 50)
    audit = discover.audit_unique
    monkeypatch.setattr(discover, "audit_unique", lambda df, key: counted.append(tuple(key)) or audit(df, key))
    return counted


def test_sets_that_nearly_never_repeat_are_not_counted_over_all_rows(spark, narrow):
    rows = spark.range(0, 6000).withColumn("id", F.expr("if(id < 5880, id, (id - 5880) * 49)"))  # 2 % are copies
    df = rows.select("id", F.expr("id % 1000 AS b"), F.expr("id DIV 7 AS c"), F.expr("id * 7 % 5880 AS d"))
    assert candidate_keys(df, 3) == []
    assert narrow == [("id",)]  # the rows of its repeated hashes


def test_one_repeat_is_found_among_all_rows(spark, narrow):
    i = F.col("id")
    df = spark.range(0, 6000).select(
        i.alias("id"),
        F.when(i == 4321, 17).otherwise(i).alias("once"),
        F.when(i % 50 == 0, 0).otherwise(i).alias("hot"),
        F.when(i == 5, F.lit(-0.0)).when(i == 7, F.lit(0.0)).otherwise(i + 1.0).alias("signed"),
        F.collate(F.when(i == 8, F.lit("A")).when(i == 9, F.lit("a")).otherwise(i.cast("string")), "UTF8_LCASE").alias("cased"),
        F.when(i > 0, F.create_map(F.lit("k"), i)).alias("unlike"),
    )
    assert candidate_keys(df, 1) == [("id",)]
    for name in df.columns[:-1]:
        assert discover._repeats(df, (name,), 6000) == (name != "id")
    assert not discover._repeats(df, ("once", "hot"), 6000) and discover._repeats(df.unionAll(df.limit(1)).drop("unlike"), ("id", "once"), 6000)
    pairs = candidate_keys(df.select("once", "hot", "signed"))
    rows = df.select("once", "hot", "signed").collect()
    assert pairs == [s for s in (("once", "hot"), ("once", "signed"), ("hot", "signed")) if len({(r[s[0]], r[s[1]]) for r in rows}) == 6000]


def test_references(spark):
    parents = spark.range(0, 1000).select("id", F.concat(F.lit("p"), "id").alias("code"))
    children = spark.range(0, 5000).select(
        (F.col("id") % 1000).cast("int").alias("parent"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("p"), F.col("id") % 7)).alias("code"),
        F.when(F.col("id") == 77, 1000).otherwise(F.col("id") % 1000).alias("almost"),
        F.when(F.col("id") == 77, F.lit("q")).otherwise(F.concat(F.lit("p"), F.col("id") % 1000)).alias("near"),
        F.lit(None).cast("bigint").alias("none"),
        F.rand().alias("ratio"),
    )
    found = references({"parents": parents, "children": children}, {"parents": ["id", "code"]})
    assert found == [("children", "parent", "parents", "id"), ("children", "code", "parents", "code")]
    assert references({"parents": parents.where("false"), "children": children}, {"parents": ["id"]}) == []
    assert references({"children": children}, {}) == []


def test_inclusions_of_many_columns(spark):
    # Column n holds the multiples of n; 70 columns take more than one word of bits.
    columns = {n: spark.range(0, 420).select(F.when(F.col("id") % n == 0, F.col("id")).alias("a.b")) for n in range(1, 71)}
    pairs = [(a, b) for a in (1, 2, 6, 64, 70) for b in (1, 2, 3, 35, 63, 64, 70)]
    told = audit_inclusions(columns, pairs).first()["orphans"]
    assert told == [len(set(range(0, 420, a)) - set(range(0, 420, b))) for a, b in pairs]
    empty = columns[1].where("false")
    assert audit_inclusions({"a": empty, "b": empty}, [("a", "b")]).first()["orphans"] == [0]


def test_references_are_confirmed_together(spark):
    def jobs(n):
        wide = spark.range(0, 300).select(*[(F.col("id") % (i + 200)).alias(f"c{i}") for i in range(n)])
        spark.sparkContext.setJobGroup(f"refer{n}", "")
        found = references({"parents": spark.range(0, 300), "wide": wide}, {"parents": ["id"]})
        assert found == [("wide", f"c{i}", "parents", "id") for i in range(n)]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"refer{n}"))

    try:
        assert jobs(9) == jobs(1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


ITEMS = Contract.declare("items", {"id": "bigint", "kind": "nvarchar(9)", "n": "int"}, partition_by=["kind"])
STATE = st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "", None]), st.integers(0, 1)), max_size=12)


@settings(max_examples=3, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(states=st.lists(STATE, min_size=2, max_size=4), parts=STATE)
def test_a_history_cut_at_a_load_is_that_load(spark, states, parts):
    stored = Warehouse(spark, fresh_folder(spark, "history"))
    for i, state in enumerate(states):
        contract = ITEMS if i != 1 else ITEMS.partitioned_by()
        stored.write(spark.createDataFrame(state, ITEMS.schema), contract)
    stored.write(spark.createDataFrame(states[0], ITEMS.schema), ITEMS)
    stored.reload(spark.createDataFrame(parts, ITEMS.schema), ITEMS)
    found = loads.history(stored, ITEMS).collect()
    for load_id in stored.loads("items"):
        held = Counter()
        for r in found:
            if r["valid_from"] <= load_id and (r["valid_to"] is None or load_id < r["valid_to"]):
                held[r["id"], r["kind"], r["n"]] += r["copies"]
        assert held == Counter(tuple(r) for r in stored.read(ITEMS, load_id).collect())
    spans = {}
    for r in found:
        spans.setdefault((r["id"], r["kind"], r["n"]), []).append((r["valid_from"], r["valid_to"], r["copies"]))
    for held in spans.values():
        held.sort()
        for (_, end, n), (begin, _, m) in zip(held, held[1:]):
            assert end < begin or end == begin and n != m


def test_a_history_brings_layouts_together(spark, folder):
    stored = Warehouse(spark, folder)
    older = Contract.declare("items", {"id": "int", "kind": "nvarchar(9)"})
    stored.write(spark.createDataFrame([(1, "a"), (2, "b")], older.schema), older)
    stored.write(spark.createDataFrame([(1, "a", None), (2, "b", 5)], ITEMS.schema), ITEMS)
    found = [tuple(r) for r in loads.history(stored, ITEMS).collect()]
    assert sorted(found, key=str) == sorted([(1, "a", None, 1, None, 1), (2, "b", None, 1, 2, 1), (2, "b", 5, 2, None, 1)], key=str)
    assert loads.history(stored, ITEMS, [2]).count() == 2
    assert loads.history(Warehouse(spark, folder, "other"), ITEMS).collect() == []
    with pytest.raises(ValueError, match="copies"):
        loads.history(stored, Contract.declare("items", {"copies": "int"}))


def test_compaction(spark, folder):
    stored = Warehouse(spark, folder)
    rows = spark.range(0, 6000, 1, 12).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "").alias("kind"), F.lit(1).alias("n"))
    stored.write(rows.unionAll(rows.limit(0)), ITEMS, gather=False)
    stored.reload(spark.createDataFrame([(1, "whole", 1)], ITEMS.schema), ITEMS)
    before = stored.files("items", 2)
    assert all(len(held) == 12 for (_, d), held in before.items() if d != "kind=whole")
    total = {d: sum(held) for (_, d), held in before.items()}
    target = max(total.values()) // 3
    load = loads.compact(stored, ITEMS, target)
    after = stored.files("items", load.id)
    assert {d for _, d in after} == set(total) and load.rows == 6001
    for (holder, directory), held in after.items():
        assert len(held) <= max(1, -(-total[directory] // target)) and (holder == 2) == (directory == "kind=whole")
    assert differing_rows(stored.read(ITEMS), stored.read(ITEMS, 2)).isEmpty()
    assert stored.described("items", load.id).digest == stored.described("items", 2).digest
    assert loads.compact(stored, ITEMS, 1 << 30) is not None and loads.compact(stored, ITEMS, 1 << 30) is None
    plain = ITEMS.partitioned_by()
    other = Warehouse(spark, folder, "plain")
    other.write(rows, plain)
    loads.compact(other, plain)
    assert [len(held) for held in other.files("items", 2).values()] == [1] and other.read(plain).count() == 6000
    with pytest.raises(NotMigrated):
        loads.compact(Warehouse(spark, folder, "none"), ITEMS)
