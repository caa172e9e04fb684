import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import Contract
from roundhaul.operators import audit, evolve, stats, validate


def dicts(df):
    return [row.asDict() for row in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "k int, at date")
    assert tuple(stats.load_statistics(empty, "k", "at").first()) == (0, 0, None, None)


def test_profile(spark):
    given = [(1, "b", None, bytearray(b"x")), (1, None, 2.5, None), (3, "a", 2.5, None)]
    rows = spark.createDataFrame(given, "i int, s string, d double, r binary")
    expected = [
        ("i", "int", 1, 0, 0, 2, "1", "3"),
        ("s", "string", 2, 1, 1, 2, "a", "b"),
        ("d", "double", 3, 1, 1, 1, "2.5", "2.5"),
        ("r", "binary", 4, 1, 2, 1, None, None),
    ]
    assert [tuple(r) for r in stats.profile_columns(rows, ["i"]).orderBy("position").collect()] == expected
    assert [tuple(r) for r in stats.profile_columns(rows, ["i"], exact=False).orderBy("position").collect()] == expected


def test_profile_reads_each_column_on_its_own(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    assert plan(stats.profile_columns(customers)).count("FileScan") == 5
    assert plan(stats.profile_columns(customers, exact=False)).count("FileScan") == 1
    assert "Expand" not in plan(stats.profile_columns(customers))


def test_filters_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    both = plan(stats.equal_to(orders, {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}))
    assert "EqualTo(o_orderstatus,F)" in both and "EqualTo(o_orderpriority,1-URGENT)" in both
    assert "In(o_orderstatus, [F,O])" in plan(stats.one_of(orders, "o_orderstatus", ["F", "O"]))
    assert "TakeOrderedAndProject" in plan(stats.latest(orders, "o_orderdate", "o_orderkey"))
    assert "ReadSchema: struct<>" in plan(stats.row_count(orders))


def pair(spark, source, target, schema="k int, v double, s string"):
    return spark.createDataFrame(source, schema), spark.createDataFrame(target, schema)


def test_contents_with_repeats_nulls_and_swaps(spark):
    source = [(1, 1.0, "a"), (1, 1.0, "a"), (2, None, "b"), (3, float("nan"), None)]
    same = validate.content_match(*pair(spark, source, list(reversed(source))))
    assert dicts(same) == [{"source_rows": 4, "target_rows": 4, "status": "PASSED"}]
    fewer = pair(spark, source, source[1:])
    assert dicts(validate.content_match(*fewer))[0]["status"] == "FAILED"
    assert dicts(validate.content_diff(*fewer)) == [{"only_in_source": 1, "only_in_target": 0, "status": "FAILED"}]
    assert dicts(validate.differing_rows(*fewer)) == [{"k": 1, "v": 1.0, "s": "a", "only_in": "source", "copies": 1}]
    moved = pair(spark, [(1, "x", None)], [(1, None, "x")], "k int, a string, b string")
    assert dicts(validate.content_match(*moved))[0]["status"] == "FAILED"
    assert dicts(validate.content_diff(*moved))[0] == {"only_in_source": 1, "only_in_target": 1, "status": "FAILED"}
    assert dicts(validate.keyed_diff(*moved, ["k"])) == [{"k": 1, "change": "changed"}]


def test_empty_sides_match(spark):
    none = pair(spark, [], [])
    assert dicts(validate.content_match(*none)) == [{"source_rows": 0, "target_rows": 0, "status": "PASSED"}]
    assert dicts(validate.content_diff(*none)) == [{"only_in_source": 0, "only_in_target": 0, "status": "PASSED"}]
    assert dicts(validate.row_count_match(*none))[0]["status"] == "PASSED"
    assert tuple(validate.float_tolerance(*none, ["k"]).first()) == ("v", 0.0, True)


def test_contents_need_the_same_columns(spark):
    left, right = spark.range(1), spark.range(1).select(F.col("id").cast("int"))
    with pytest.raises(ValueError, match="differ in columns"):
        validate.content_match(left, right)
    with pytest.raises(ValueError, match="missing_in_target"):
        validate.content_diff(left, right.withColumnRenamed("id", "x"))


def test_column_match():
    source = Contract.declare("s", {"a": "int", "b": "money", "c": "date"})
    target = Contract.declare("t", {"a": "bigint", "b": "decimal(19,4)", "d": "date"})
    assert validate.column_match(source, target) == [
        {"column": "a", "type_match": False, "source_type": "int", "target_type": "bigint"},
        {"column": "b", "type_match": True, "source_type": "decimal(19,4)", "target_type": "decimal(19,4)"},
        {"column": "c", "status": "missing_in_target"},
        {"column": "d", "status": "extra_in_target"},
    ]


def test_keyed_diff(spark):
    source = [(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, None), (5, 5.0, "e"), (5, 5.5, "e")]
    target = [(1, 1.0, "a"), (2, 2.0, "B"), (4, 4.0, "d"), (5, 5.5, "e"), (5, 5.0, "e")]
    found = {tuple(r) for r in validate.keyed_diff(*pair(spark, source, target), ["k"]).collect()}
    assert found == {(2, "changed"), (3, "removed"), (4, "added")}
    fewer = validate.keyed_diff(*pair(spark, source, source[:-1]), ["k"])
    assert [tuple(r) for r in fewer.collect()] == [(5, "changed")]


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    ("source", "target", "diff", "passed"),
    [
        ([(1, 1.0)], [(1, 1.0 + 1e-12)], 1e-12, True),
        ([(1, 1.0)], [(1, 1.5)], 0.5, False),
        ([(1, None)], [(1, 1.5)], 0.0, True),
        ([(1, 1.0)], [(2, 9.0)], 0.0, True),
        ([(1, NAN)], [(1, NAN)], 0.0, True),
        ([(1, INF)], [(1, INF)], 0.0, True),
        ([(1, NAN)], [(1, 1.0)], NAN, False),
        ([(1, INF)], [(1, 1.0)], INF, False),
        ([(1, 1.0), (1, 4.0)], [(1, 2.0), (1, 9.0)], 8.0, False),
        ([(1, 2.0), (1, 2.0)], [(1, 2.0)], 0.0, True),
    ],
)
def test_float_tolerance(spark, source, target, diff, passed):
    row = validate.float_tolerance(*pair(spark, source, target, "k int, v double"), ["k"]).first()
    assert row["within_tolerance"] is passed
    if math.isnan(diff):
        assert math.isnan(row["max_diff"])
    else:
        assert row["max_diff"] == pytest.approx(diff, rel=1e-3)


def test_float_tolerance_equals_the_join_over_all_pairs(spark):
    def side(seed):
        value = F.when(F.rand(seed) > 0.1, F.rand(seed + 1))
        return spark.range(400).select((F.col("id") % 40).alias("k"), value.alias("v"))

    source, target = side(1).persist(), side(5).persist()
    joined = source.alias("s").join(target.alias("t"), "k").agg(F.max(F.abs(F.col("s.v") - F.col("t.v")))).first()[0]
    assert validate.float_tolerance(source, target, ["k"]).first()["max_diff"] == joined


def test_one_key_may_hold_a_third_of_all_rows(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    rows = spark.range(0, 300_000, 1, 8).select(key.alias("k"), F.col("id").cast("double").alias("v"))
    altered = rows.withColumn("v", F.when(F.col("v") == 299_997, -1.0).otherwise(F.col("v")))
    assert dicts(validate.keyed_diff(rows, altered, ["k"])) == [{"k": 0, "change": "changed"}]
    assert validate.float_tolerance(rows, altered, ["k"]).first()["max_diff"] == 299_998.0
    assert dicts(audit.audit_unique(rows, ["k"])) == [{"k": 0, "copies": 100_000}]
    parent = rows.select("k").where("k > 0")
    assert dicts(audit.audit_foreign_key(rows, ["k"], parent, ["k"])) == [{"k": 0, "orphans": 100_000}]


def test_audits(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (1, None), (None, 2), (3, 3), (None, 2)], "a int, b int")
    assert {tuple(r) for r in audit.audit_not_null(child, ["a", "b"]).collect()} == {("a", 2), ("b", 1)}
    copies = {(r["a"], r["b"]): r["copies"] for r in audit.audit_unique(child, ["a", "b"]).collect()}
    assert copies == {(1, 1): 2, (None, 2): 2}
    parent = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "x int, y int")
    assert dicts(audit.audit_foreign_key(child, ["a", "b"], parent, ["x", "y"])) == [{"a": 3, "b": 3, "orphans": 1}]


D = T.DecimalType


@pytest.mark.parametrize(
    ("old", "new", "safe"),
    [
        (T.IntegerType(), T.LongType(), True),
        (T.FloatType(), T.DoubleType(), True),
        (D(10, 2), D(12, 2), True),
        (D(10, 2), D(10, 2), True),
        (D(10, 2), D(9, 2), False),
        (D(10, 2), D(12, 3), False),
        (T.LongType(), T.IntegerType(), False),
        (T.DoubleType(), T.FloatType(), False),
        (T.IntegerType(), T.DoubleType(), False),
        (T.StringType(), T.StringType(), False),
        (T.DateType(), T.TimestampNTZType(), False),
    ],
)
def test_safe_widening(old, new, safe):
    assert evolve.widens_safely(old, new) is safe


def test_drift_goes_by_exact_name():
    old = Contract.declare("o", {"id": "int not null", "Name": "text", "gone": "date"})
    new = Contract.declare("n", {"name": "text", "id": "bigint"})
    drift = evolve.schema_drift(old, new)
    assert [c.name for c in drift.added] == ["name"]
    assert [c.name for c in drift.removed] == ["Name", "gone"]
    assert drift.changed == (("id", T.IntegerType(), T.LongType()),)


def test_evolve_append(spark):
    old = spark.createDataFrame([(1, 1.5, "x")], "id int, v float, gone string")
    new = spark.createDataFrame([(2**40, 2.5, True)], "id bigint, v double, fresh boolean")
    out = evolve.evolve_append(old, new)
    assert out.schema.simpleString() == "struct<id:bigint,v:double,gone:string,fresh:boolean>"
    assert {tuple(r) for r in out.collect()} == {(1, 1.5, "x", None), (2**40, 2.5, None, True)}
    with pytest.raises(evolve.UnsafeChange, match="id: bigint to int"):
        evolve.evolve_append(new.select("id"), old.select("id"))


def test_float_tolerance_takes_floats_on_both_sides_and_whole_keys(spark):
    one = spark.createDataFrame([(1, 1.0, 2.0), (None, 9.0, 0.0)], "k int, x double, y double")
    two = spark.createDataFrame([(1, 1.0, "2.0"), (None, 5.0, "a")], "k int, x double, y string")
    assert [tuple(r) for r in validate.float_tolerance(one, two, ["k"]).collect()] == [("x", 0.0, True)]
    with pytest.raises(ValueError, match="'y'"):
        validate.float_tolerance(one, two, ["k"], columns=["y"])
