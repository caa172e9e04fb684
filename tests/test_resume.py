"""Restores by ranges that fail and go on."""

import pytest
from pyspark.sql import functions as F

from roundhaul.contracts import Contract
from roundhaul.operators.validate import differing_rows
from roundhaul.plans import resume
from roundhaul.plans.targets import WarehouseTarget
from roundhaul.session import fresh_folder
from roundhaul.sources import Warehouse
from roundhaul.sources.warehouse import Ranges

T = Contract.declare("t", {"id": "bigint", "v": "float", "kind": "nvarchar(5)"}, partition_by=["kind"])


def rows(spark, n=1000):
    df = spark.range(-20, n - 22).select(
        "id", F.when(F.col("id") % 10 == 0, float("nan")).otherwise(F.col("id") / 3).alias("v"), F.when(F.col("id") % 2 == 0, "a").alias("kind")
    )
    return df.unionAll(spark.createDataFrame([(None, 1.0, "a"), (-(2**63), 2.0, "b")], T.schema))


class Counting(WarehouseTarget):
    """Counts the rows it is sent, and fails before or after it took the given batch."""

    def __init__(self, warehouse, before=None, after=None):
        super().__init__(warehouse)
        self.sent, self.calls, self.before, self.after = 0, 0, before, after

    def append(self, df, contract):
        self.calls += 1
        if self.calls == self.before:
            raise ConnectionError("gone")
        super().append(df, contract)
        self.sent += df.count()
        if self.calls == self.after:
            raise ConnectionError("gone")


@pytest.fixture
def stored(spark):
    warehouse = Warehouse(spark, fresh_folder(spark, "stored"))
    warehouse.write(rows(spark), T)
    return warehouse


def test_only_missing_ranges_are_sent_again(spark, stored):
    place, ranges = Warehouse(spark, fresh_folder(spark, "target")), Ranges("id", 50)
    first = Counting(place, before=4)
    failed = resume.restore_by_ranges(stored, T, first, ranges, batches=8)
    assert failed.status == "failed" and "gone" in failed.error and first.sent > 300
    second = Counting(place, after=2)  # took its second batch, but it was not entered
    assert resume.restore_by_ranges(stored, T, second, ranges, batches=8).status == "failed"
    third = Counting(place)
    done = resume.restore_by_ranges(stored, T, third, ranges, batches=8)
    assert (done.status, done.validation, done.rows) == ("success", "PASSED", 1000)
    assert first.sent + second.sent + third.sent == 1000 and third.sent < 600
    expected = rows(spark).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    assert differing_rows(expected, third.read(T)).isEmpty()
    again = Counting(place)
    assert resume.restore_by_ranges(stored, T, again, ranges).status == "success" and again.calls == 0
    other = resume.restore_by_ranges(stored, T, Counting(place), ranges, label="elsewhere")
    assert other.status == "success" and other.note == "0 rows sent"


def test_a_range_that_arrived_in_part_stops(spark, stored):
    place, ranges = Warehouse(spark, fresh_folder(spark, "target")), Ranges("id", 50)
    WarehouseTarget(place).append(rows(spark).where("id = 7"), T)
    found = resume.restore_by_ranges(stored, T, Counting(place), ranges)
    assert found.status == "failed" and "arrived in part" in found.error


def test_a_target_that_changes_rows_is_told(spark, stored):
    class Changing(Counting):
        def read(self, contract):
            return super().read(contract).withColumn("kind", F.when(F.col("id") != 11, F.col("kind")))

    place = Warehouse(spark, fresh_folder(spark, "target"))
    found = resume.restore_by_ranges(stored, T, Changing(place), Ranges("id", 100))
    assert (found.status, found.validation) == ("warning", "FAILED")


def test_nothing_to_restore(spark):
    warehouse = Warehouse(spark, fresh_folder(spark, "stored"))
    target = Counting(Warehouse(spark, fresh_folder(spark, "target")))
    assert resume.restore_by_ranges(warehouse, T, target, Ranges("id", 10)).status == "failed"
    warehouse.write(rows(spark).where("false"), T)
    assert resume.restore_by_ranges(warehouse, T, target, Ranges("id", 10)).status == "no_data"


def test_append_names_what_is_there(spark, stored):
    load = stored.append(rows(spark, 10), T)
    assert load.rows == 1010 and stored.read(T).count() == 1010 and stored.read(T, 1).count() == 1000
    assert set(stored.places("t", 2)) == {1, 2}
    digests = resume.digests(stored.read(T), T, Ranges("id", 1 << 62)).agg(F.sum("rows"), F.sum("sum0")).first()
    assert tuple(digests) == (1010, stored.described("t", 2).exported.sums[0])
    with pytest.raises(ValueError, match="other columns"):
        stored.append(rows(spark), T.partitioned_by())


def test_spans_of_neighbours_are_one():
    assert resume._batches({5: resume.Digest(3, ()), None: resume.Digest(1, ()), 0: resume.Digest(3, ())}, 2) == [[0, 5], [None]]
