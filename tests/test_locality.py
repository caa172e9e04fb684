"""Files laid along a curve through several columns: contents, bounds in the footers, and the key itself."""

import datetime as dt
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roundhaul.contracts import Contract
from roundhaul.functions import locality
from roundhaul.operators.validate import differing_rows
from roundhaul.sources import Warehouse

POINTS = Contract.declare("points", {"id": "bigint", "x": "float", "y": "int", "name": "nvarchar(20)", "kind": "nvarchar(5)"}, partition_by=["kind"])


def points(spark, n=20_000):
    rng = np.random.default_rng(2)
    rows = [
        (i, float(x), int(y), f"{chr(97 + i % 26)}{i}", "ab"[i % 2])
        for i, (x, y) in enumerate(zip(rng.standard_normal(n) ** 3, rng.integers(0, 100_000, n), strict=True))
    ]
    rows += [(n, None, None, None, None), (n + 1, float("nan"), 5, "", "a"), (n + 2, float("inf"), -5, "é", "b")]
    return spark.createDataFrame(rows, POINTS.schema).repartition(16)


def overlapping(top, bounds):
    """Row groups in all, and those whose bounds meet the ranges."""
    met, total = 0, 0
    for folder, _, names in os.walk(top):
        for name in names:
            if not name.endswith(".parquet"):
                continue
            footer = pq.read_metadata(os.path.join(folder, name))
            index = {footer.schema.column(i).name: i for i in range(len(footer.schema))}
            for g in range(footer.num_row_groups):
                total += 1
                held = [footer.row_group(g).column(index[column]).statistics for column in bounds]
                met += all(
                    s is not None and s.has_min_max and s.min <= high and s.max >= low
                    for s, (low, high) in zip(held, bounds.values(), strict=True)
                )
    return met, total


def test_a_range_of_two_columns_meets_few_row_groups(spark, folder):
    rows = points(spark)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        plain, laid = Warehouse(spark, folder, "plain"), Warehouse(spark, folder, "laid")
        plain.write(rows, POINTS, gather=False)
        laid.write(rows, POINTS, cluster=["x", "y"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert differing_rows(plain.read(POINTS), laid.read(POINTS)).isEmpty()
    bounds = {"x": (0.0, 0.1), "y": (20_000, 30_000)}
    met, total = overlapping(f"{plain.folder('points')}/load=1", bounds)
    assert total >= 32 and met > 0.9 * total
    for wanted in (bounds, {"x": (0.0, 0.1)}, {"y": (20_000, 30_000)}):
        met, total = overlapping(f"{laid.folder('points')}/load=1", wanted)
        assert total > 50 and met < total * (0.25 if len(wanted) == 2 else 0.6)
    found = laid.read(POINTS).where("x BETWEEN 0 AND 0.1 AND y BETWEEN 20000 AND 30000")
    assert "GreaterThanOrEqual(y,20000)" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == rows.where("x BETWEEN 0 AND 0.1 AND y BETWEEN 20000 AND 30000").count()


def test_odd_values_and_an_empty_table(spark, folder):
    stored, rows = Warehouse(spark, folder), points(spark, 50)
    for columns in (["name", "kind"], ["y"], ["x", "name", "id"]):
        stored.write(rows, POINTS, cluster=columns)
        assert differing_rows(stored.read(POINTS), rows).isEmpty()
    assert stored.write(rows.where("false"), POINTS, cluster=["x", "y"]).rows == 0
    with pytest.raises(ValueError, match="do not fit"):
        locality.locality_key(rows, ["id"] * 11, [[]] * 11)


def test_key_takes_bits_in_turn(spark):
    grid = spark.range(0, 64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    cuts = [[float(i) for i in range(1, 8)]] * 2
    for row in grid.select("a", "b", locality.locality_key(grid, ["a", "b"], cuts, 3).alias("key")).collect():
        bits = "".join(f"{(row['a'] >> k) & 1}{(row['b'] >> k) & 1}" for k in (2, 1, 0))
        assert row["key"] == int(bits, 2)


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("string", ["", "a", "ab", "b", "ba", "é"]),
        ("date", [dt.date(1960, 1, 1), dt.date(2024, 1, 1)]),
        ("timestamp_ntz", [dt.datetime(1960, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1)]),
        ("boolean", [False, True]),
        ("decimal(10,2)", [-5, 0, 7]),
    ],
)
def test_scales_keep_the_order(spark, kind, values):
    from decimal import Decimal

    given = [(Decimal(v) if kind.startswith("decimal") else v,) for v in values]
    df = spark.createDataFrame(given, f"v {kind}")
    found = [r[0] for r in df.select(locality.scale(F.col("v"), df.schema["v"].dataType)).collect()]
    assert found == sorted(found) and len(set(found)) == len(values)
