"""Times of day in a type of their own, and as text where it is not asked for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import Contract
from roundhaul.functions.convert import conform, export_form, lossy_values
from roundhaul.operators.validate import differing_rows
from roundhaul.plans import jobs
from roundhaul.plans.targets import WarehouseTarget
from roundhaul.session import allow_times, fresh_folder
from roundhaul.sources import Warehouse

TEXT = Contract.declare("shifts", {"id": "bigint", "at": "time(7)"}, key=["id"])
GIVEN = [(1, "00:00:00"), (2, "12:34:56.1234560"), (3, None), (4, "23:59:59.999999"), (5, "07:00:00.5")]


@pytest.fixture
def native(spark):
    allow_times(spark)
    return TEXT.with_native_times()


def test_round_trip_range_and_cycle(spark, native):
    rows = spark.createDataFrame(GIVEN, "id bigint, at string")
    assert TEXT.column("at").type == T.StringType() and native.column("at").type == T.TimeType(6)
    typed = conform(rows, native)
    stored = Warehouse(spark, fresh_folder(spark, "times"))
    stored.write(typed, native)
    back = {r["id"]: r["at"] for r in stored.read(native).collect()}
    assert back[2] == dt.time(12, 34, 56, 123456) and back[3] is None and back[4] == dt.time(23, 59, 59, 999999)
    assert stored.layout("shifts", 1)[0].column("at").type == T.TimeType(6)
    found = stored.read_range(native, "at", "07:00:00.5", "23:59:59.999999")
    assert sorted(r["id"] for r in found.collect()) == [2, 5]
    assert "GreaterThanOrEqual(at" in found._jdf.queryExecution().executedPlan().toString()
    assert differing_rows(stored.read(native), typed).isEmpty()
    source = jobs.Source(native, lambda: rows)
    cycle = jobs.full_cycle(stored, [source], WarehouseTarget(Warehouse(spark, fresh_folder(spark, "times-target"))))
    assert cycle[0]["status"] == "PASSED"
    assert [f.dataType for f in export_form(typed, times_as_text=True).schema] == [T.LongType(), T.StringType()]


def test_text_by_default_and_brought_over(spark, native):
    rows = spark.createDataFrame(GIVEN, "id bigint, at string")
    stored = Warehouse(spark, fresh_folder(spark, "times"))
    stored.write(conform(rows, TEXT), TEXT)
    assert {r["id"]: r["at"] for r in stored.read(TEXT).collect()}[2] == "12:34:56.123456"
    assert {r["id"]: r["at"] for r in stored.read(native).collect()}[2] == dt.time(12, 34, 56, 123456)
    stored.write(conform(rows, native), native)
    assert {r["id"]: r["at"] for r in stored.read(TEXT).collect()}[5] == "07:00:00.5"


@pytest.mark.parametrize("text", ["12:34:56.1234567", "24:00:00", "x", "12:61:00"])
def test_what_does_not_fit_is_refused(spark, native, text):
    rows = spark.createDataFrame([(1, text), (2, "01:02:03")], "id bigint, at string")
    with pytest.raises(Exception, match="does not fit"):
        conform(rows, native).collect()
    assert {r["column_name"]: r["changed"] for r in lossy_values(rows, native).collect()}["at"] == 1
    assert conform(rows, native, tolerant=True).where(F.col("at").isNull()).count() == 1


def test_a_time_names_no_directory(native):
    with pytest.raises(ValueError, match="time of day"):
        native.partitioned_by("at")
    assert native.columns[1].restored() == "TIME(7)" and Contract.of("t", TEXT_FRAME).columns[0].restored() == "TIME"


class TEXT_FRAME:
    schema = T.StructType([T.StructField("at", T.TimeType(6))])
