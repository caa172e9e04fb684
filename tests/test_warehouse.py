import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roundhaul.contracts import Contract
from roundhaul.operators.validate import differing_rows
from roundhaul.session import fresh_folder, shared_folder
from roundhaul.sources import NotMigrated, Warehouse, read_directory

EDGES = Contract.declare(
    "edges",
    {
        "id": "bigint not null",
        "flag": "bit",
        "tiny": "tinyint",
        "ratio": "float",
        "single": "real",
        "amount": "decimal(19,4)",
        "wide": "decimal(38,18)",
        "moment": "datetime2(6)",
        "instant": "datetimeoffset",
        "day": "date",
        "label": "nvarchar(50)",
        "raw": "varbinary(max)",
    },
    key=["id"],
)


AWKWARD = ["", "~", "~x", "007", "__HIVE_DEFAULT_PARTITION__", "a/b=c%20", "é ü", " "]
LEVELS = [(), ("label",), ("moment", "tiny"), ("instant",), ("day", "flag"), ("amount",), ("ratio", "wide")]


def values():
    text = st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=8)
    moments = st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2199, 12, 31))
    maybe = st.none
    return st.tuples(
        maybe() | st.booleans(),
        maybe() | st.integers(0, 255),
        maybe() | st.floats(),
        maybe() | st.floats(width=32),
        maybe() | st.decimals("-999999999999999.9999", "999999999999999.9999", places=4),
        maybe() | st.decimals(-(10**19), 10**19, places=18),
        maybe() | moments | st.just(dt.datetime(2024, 2, 29, 23, 59, 59, 999999)),
        maybe() | moments.map(lambda m: m.replace(tzinfo=dt.timezone.utc)),
        maybe() | st.dates(dt.date(1900, 1, 1), dt.date(2199, 12, 31)) | st.just(dt.date(2024, 2, 29)),
        maybe() | text | st.sampled_from(AWKWARD),
        maybe() | st.binary(max_size=8),
    )


@pytest.mark.parametrize("levels", LEVELS)
@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(values(), min_size=1, max_size=25))
def test_round_trip_keeps_every_value(spark, levels, data):
    contract = EDGES.partitioned_by(*levels)
    rows = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], contract.schema)
    stored = Warehouse(spark, fresh_folder(spark, "edges"))
    assert stored.write(rows, contract).rows == len(data)
    back = stored.read(contract)
    assert back.schema == contract.schema
    assert differing_rows(rows, back).collect() == []


def items(spark, *pairs):
    return spark.createDataFrame(pairs, ITEMS.schema)


ITEMS = Contract.declare("items", {"id": "bigint", "kind": "nvarchar(20)"}, partition_by=["kind"])


def test_text_keys_keep_their_values_and_prune(spark, folder):
    stored = Warehouse(spark, folder)
    names = ["007", "", None, "~", "~~", "__HIVE_DEFAULT_PARTITION__", "a/b", "é"]
    stored.write(items(spark, *enumerate(names)), ITEMS)
    back = stored.read(ITEMS)
    assert [r["kind"] for r in back.orderBy("id").collect()] == names
    one = back.where(F.col("kind") == "007")
    assert "PartitionFilters: []" not in plan(one)
    assert one.count() == 1
    assert back.where(F.col("kind") == "").count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reload_replaces_and_earlier_load_stays_readable(spark, folder):
    stored = Warehouse(spark, folder)
    first = stored.write(items(spark, (1, "a"), (2, "b")), ITEMS)
    again = stored.write(items(spark, (1, "a"), (2, "b")), ITEMS)
    third = stored.write(items(spark, (3, "c")), ITEMS)
    assert (first.id, again.id, third.id) == (1, 2, 3)
    assert stored.read(ITEMS).count() == 1
    assert stored.read(ITEMS, as_of=2).count() == 2
    assert stored.read(ITEMS, as_of=99).count() == 1
    assert stored.read(ITEMS, as_of=0).count() == 0


def test_drop_loads(spark, folder):
    stored = Warehouse(spark, folder)
    for n in range(1, 5):
        stored.write(items(spark, (n, "a")), ITEMS)
    with pytest.raises(ValueError, match="current load"):
        stored.drop_loads("items", keep=0)
    assert stored.drop_loads("items", keep=2) == [1, 2]
    assert stored.loads("items") == [3, 4]
    assert [r["id"] for r in stored.read(ITEMS).collect()] == [4]
    assert [r["id"] for r in stored.read(ITEMS, as_of=3).collect()] == [3]
    assert stored.drop_loads("nothing") == []


def test_few_keys_need_no_shuffle(spark, folder):
    stored = Warehouse(spark, folder)
    rows = spark.range(0, 100, 1, 4).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"))
    load = stored.write(rows, ITEMS, gather=False)
    assert load.rows == 100
    assert len(spark.read.parquet(load.path).inputFiles()) == 8
    assert differing_rows(rows, stored.read(ITEMS)).collect() == []


def test_unfinished_load_is_not_read(spark, folder):
    stored = Warehouse(spark, folder)
    stored.write(items(spark, (1, "a")), ITEMS)
    broken = items(spark, (2, "b")).withColumn("kind", F.when(F.col("id") > 0, F.raise_error(F.lit("disk gone"))))
    with pytest.raises(Exception, match="disk gone"):
        stored.write(broken, ITEMS)
    half_written = f"{stored.folder('items')}/load=7"
    unmarked = spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unmarked.parquet(half_written)
    assert [r["id"] for r in stored.read(ITEMS).collect()] == [1]
    assert stored.write(items(spark, (3, "c")), ITEMS).id == 8


def test_empty_table(spark, folder):
    stored = Warehouse(spark, folder)
    assert stored.read(ITEMS).count() == 0
    assert stored.write(items(spark), ITEMS).rows == 0
    unmatched = spark.range(10).select(F.col("id"), F.lit("a").alias("kind")).where(F.col("id") > 10 + F.rand())
    assert stored.write(unmatched, ITEMS).rows == 0
    assert stored.read(ITEMS).count() == 0
    assert [tuple(r) for r in stored.inventory().collect()] == [("sales", "items", 0)]


def test_nothing_migrated_is_an_error(spark, folder):
    with pytest.raises(NotMigrated):
        Warehouse(spark, folder).require_migrated()
    assert Warehouse(spark, folder).inventory().collect() == []


def test_inventory_counts_the_current_load_only(spark, folder):
    stored = Warehouse(spark, folder)
    stored.write(items(spark, (1, "a"), (2, "b")), ITEMS)
    stored.write(items(spark, (1, "a"), (2, "b"), (3, "b")), ITEMS)
    plain = Contract.declare("plain", {"id": "bigint"})
    stored.write(spark.range(7), plain)
    assert {tuple(r) for r in stored.inventory().collect()} == {("sales", "items", 3), ("sales", "plain", 7)}


EVENTS = Contract.declare("events", {"id": "bigint", "at": "datetime2(6)"}, partition_by=["at"])


def test_range_read_opens_only_the_days_asked_for(spark, folder):
    stored = Warehouse(spark, folder)
    start = F.lit(dt.datetime(2024, 2, 27)).cast("timestamp_ntz")
    hours = spark.range(24 * 6).select("id", (start + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("at"))
    stored.write(hours, EVENTS)
    found = stored.read_range(EVENTS, "at", dt.datetime(2024, 2, 29, 12), dt.datetime(2024, 3, 1, 6))
    assert found.columns == ["id", "at"]
    assert found.count() == 18
    text = plan(found)
    assert "PartitionFilters: [isnotnull(at_day" in text
    assert "PushedFilters: [IsNotNull(at), GreaterThanOrEqual(at" in text
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        again = stored.read_range(EVENTS, "at", "2024-02-29 12:00:00", "2024-03-01 06:00:00")
        assert differing_rows(found, again).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_day_that_holds_too_much_is_written_by_several_tasks(spark, folder):
    stored = Warehouse(spark, folder)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    first = F.lit("2024-01-01").cast("date")
    busy = F.when(F.col("id") % 3 == 0, first).otherwise(F.date_add(first, (F.col("id") % 20).cast("int")))
    rows = spark.range(0, 200_000, 1, 8).select("id", busy.cast("timestamp_ntz").alias("at"))
    try:
        spark.conf.set(size, "100k")
        load = stored.write(rows, EVENTS)
    finally:
        spark.conf.set(size, before)
    assert load.rows == 200_000
    hot = spark.read.parquet(f"{load.path}/at_day=2024-01-01")
    assert len(hot.inputFiles()) > 1
    assert stored.read(EVENTS).count() == 200_000


def test_read_directory(spark, folder):
    whole = Contract.declare("t", {"id": "bigint", "name": "nvarchar(10)"})
    assert read_directory(spark, f"{folder}/none", whole).count() == 0
    for i in range(3):
        spark.createDataFrame([(i, str(i))], "id bigint, name string").write.mode("append").parquet(f"{folder}/t")
    with open(f"{folder}/t/notes.txt", "w") as file:
        file.write("not a table")
    back = read_directory(spark, f"{folder}/t", whole)
    assert back.columns == ["id", "name"]
    assert back.count() == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_without_adaptive_execution_no_key_is_gathered_in_one_task(spark, folder):
    stored = Warehouse(spark, folder)
    rows = spark.range(0, 100, 1, 4).select("id", F.lit("a").alias("kind"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        load = stored.write(rows, ITEMS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert load.rows == 100
    assert len(spark.read.parquet(load.path).inputFiles()) == 4


@pytest.mark.parametrize("name", ["we [x]", "a{b,c}", "s*r", "q? é", "p%20+1"])
def test_roots_and_tables_are_taken_as_they_are_named(spark, folder, name):
    stored = Warehouse(spark, f"{folder}/{name}")
    table = Contract.declare(name, {"id": "bigint", "kind": "nvarchar(20)"}, partition_by=["kind"])
    stored.write(items(spark, (1, "a"), (2, ""), (3, None)), table)
    assert stored.read(table).count() == 3
    assert [tuple(r) for r in stored.inventory().collect()] == [("sales", name, 3)]


def test_a_load_is_read_with_the_layout_it_was_written_with(spark, folder):
    stored = Warehouse(spark, folder)
    rows = items(spark, (1, "~x"), (2, ""), (3, "~"), (4, None))
    plain = ITEMS.partitioned_by()
    stored.write(rows, plain)
    stored.write(rows, ITEMS)
    for contract in (plain, ITEMS):
        for load in (1, 2):
            assert differing_rows(rows, stored.read(contract, as_of=load)).isEmpty()
    written, count = stored.layout("items", 2)
    assert (written, count) == (ITEMS, 4)


def test_an_earlier_load_is_brought_to_a_newer_contract(spark, folder):
    stored = Warehouse(spark, folder)
    stored.write(spark.range(3).select(F.col("id").cast("int")), Contract.declare("grown", {"id": "int"}))
    newer = Contract.declare("grown", {"note": "nvarchar(9)", "id": "bigint"})
    back = stored.read(newer)
    assert back.schema == newer.schema
    assert sorted(tuple(r) for r in back.collect()) == [(None, 0), (None, 1), (None, 2)]


def test_range_read_of_a_load_that_was_not_partitioned(spark, folder):
    stored = Warehouse(spark, folder)
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    hours = spark.range(48).select("id", (start + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("at"))
    stored.write(hours, EVENTS.partitioned_by())
    stored.write(hours.limit(1), EVENTS)
    assert stored.read_range(EVENTS, "at", "2024-01-01 12:00:00", "2024-01-02 12:00:00", as_of=1).count() == 24


def test_a_load_without_the_committers_marker_counts(spark, folder):
    stored = Warehouse(spark, folder)
    setting = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark.conf.set(setting, "false")
    try:
        stored.write(items(spark, (1, "a")), ITEMS)
    finally:
        spark.conf.unset(setting)
    assert stored.read(ITEMS).count() == 1


def test_read_directory_of_nested_files(spark, folder):
    whole = Contract.declare("t", {"id": "bigint"})
    spark.range(3).write.parquet(f"{folder}/top/deep [1]")
    assert read_directory(spark, f"{folder}/top", whole).count() == 3
    spark.range(3).select("id", F.lit("a").alias("k")).write.partitionBy("k").parquet(f"{folder}/keyed")
    with pytest.raises(ValueError, match="k=a"):
        read_directory(spark, f"{folder}/keyed", whole)
