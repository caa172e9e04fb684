"""Partial reloads, change feeds, comparison of loads by digests, and the cycle that reads its source once."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roundhaul.contracts import Contract
from roundhaul.functions import digest
from roundhaul.operators.changes import applied, change_feed
from roundhaul.operators.validate import differing_rows
from roundhaul.plans import jobs, loads
from roundhaul.plans.targets import WarehouseTarget
from roundhaul.session import fresh_folder
from roundhaul.sources import NotMigrated, Warehouse
from roundhaul.sources.warehouse import Ranges

STOCK = Contract.declare(
    "stock",
    {"id": "bigint", "day": "date", "kind": "nvarchar(20)", "amount": "decimal(10,2)", "ratio": "float"},
    key=["id"],
    partition_by=["day", "kind"],
)
DAYS = [dt.date(2024, 1, d) for d in range(1, 5)]
KINDS = ["a", "", None, "~x", "a/b=c%20 é", "__HIVE_DEFAULT_PARTITION__"]


def stock(spark, rows):
    return spark.createDataFrame(rows, STOCK.schema)


def row(i, day=0, kind="a", amount=1, ratio=0.5):
    return (i, None if day is None else DAYS[day], kind, Decimal(amount), ratio)


def many(n):
    return [row(i, i % 4, KINDS[i % 6], i, float("nan") if i % 7 == 0 else i / 3) for i in range(n)]


def files(stored, load):
    top = f"{stored.folder('stock')}/load={load}"
    found = {}
    for folder, _, names in os.walk(top):
        found |= {os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns for name in names if name.endswith(".parquet")}
    return found


def same(a, b):
    return differing_rows(a, b).isEmpty()


def told(stored, load):
    """The digests kept with a load are those of its rows."""
    layout = stored.described("stock", load)
    rows = stored.read(STOCK, load)
    values = [F.col(name) for name in STOCK.names]
    assert layout.digest == digest.read_off(rows.agg(*digest.sums(values)).first())
    left = digest.exported(values, [c.type for c in STOCK.columns])
    assert layout.exported == digest.read_off(rows.agg(*digest.sums(left)).first())
    assert layout.rows == rows.count()


def test_a_part_is_replaced_and_the_rest_not_touched(spark, folder):
    stored, before = Warehouse(spark, folder), many(60)
    stored.write(stock(spark, before), STOCK)
    kept = files(stored, 1)
    fresh = [row(1000 + i, 1, "a", 7, None) for i in range(5)]
    load = stored.reload(stock(spark, fresh), STOCK)
    assert files(stored, 1) == kept and stored.directories("stock", 2) == ["day_day=2024-01-02/kind=a"]
    after = [r for r in before if not (r[1] == DAYS[1] and r[2] == "a")] + fresh
    assert load.rows == len(after)
    assert same(stored.read(STOCK), stock(spark, after)) and same(stored.read(STOCK, 1), stock(spark, before))
    assert [tuple(r) for r in stored.inventory().collect()] == [("sales", "stock", len(after))]
    told(stored, 1)
    told(stored, 2)
    third = stored.reload(stock(spark, [row(1, 3, None)]), STOCK)
    assert set(stored.places("stock", third.id)) == {1, 2, 3}
    told(stored, 3)
    one = stored.read(STOCK).where((F.col("kind") == "a") & (F.col("day") == DAYS[1]))
    assert one.count() == 5


def test_directories_chosen_by_a_condition(spark, folder):
    stored, before = Warehouse(spark, folder), many(60)
    stored.write(stock(spark, before), STOCK)
    day = F.col("day_day") == DAYS[2]
    load = stored.reload(stock(spark, [row(7, 2, "")]), STOCK, only=day)
    after = [r for r in before if r[1] != DAYS[2]] + [row(7, 2, "")]
    assert same(stored.read(STOCK), stock(spark, after)) and load.rows == len(after)
    told(stored, 2)
    for kind in ("", None, "~x", "a/b=c%20 é", "__HIVE_DEFAULT_PARTITION__"):
        stored.reload(stock(spark, []), STOCK, only=F.col("kind").eqNullSafe(kind))
        after = [r for r in after if r[2] != kind]
        assert same(stored.read(STOCK), stock(spark, after))
    told(stored, stored.newest("stock"))
    newest = stored.newest("stock")
    with pytest.raises(Exception, match="outside the directories"):
        stored.reload(stock(spark, [row(7, 1)]), STOCK, only=day).rows
    with pytest.raises(Exception, match="outside the directories"):
        stored.reload(stock(spark, [row(7, None)]), STOCK, only=day).rows
    assert stored.newest("stock") == newest
    with pytest.raises(ValueError, match="no directories"):
        stored.reload(stock(spark, []), STOCK.partitioned_by(), only=day)
    with pytest.raises(ValueError, match="other columns or directories"):
        stored.reload(stock(spark, before), STOCK.partitioned_by("day"))


def test_reload_without_a_load_or_directories_writes_all(spark, folder):
    stored, plain = Warehouse(spark, folder), STOCK.partitioned_by()
    assert stored.reload(stock(spark, many(6)), plain).rows == 6
    assert stored.reload(stock(spark, many(4)), plain).rows == 4
    assert stored.read(plain).count() == 4
    with pytest.raises(NotMigrated):
        stored.require_load("nothing")


def test_dropped_loads_leave_what_others_name(spark, folder):
    stored, before = Warehouse(spark, folder), many(60)
    stored.write(stock(spark, before), STOCK, ranges=Ranges("id", 10))
    stored.reload(stock(spark, [row(1, 0, "a")]), STOCK)
    stored.reload(stock(spark, [row(2, 0, "a")]), STOCK)
    expected = [r for r in before if not (r[1] == DAYS[0] and r[2] == "a")] + [row(2, 0, "a")]
    assert stored.drop_loads("stock") == [1, 2] and stored.loads("stock") == [3]
    assert same(stored.read(STOCK), stock(spark, expected))
    assert stored.leaves(STOCK, 3).agg(F.sum("rows")).first()[0] == len(expected)
    assert not files(stored, 2) and stored.directories("stock", 1) == sorted(stored.places("stock", 3)[1])
    stored.write(stock(spark, before), STOCK)
    assert stored.drop_loads("stock") == [1, 2, 3] or stored.drop_loads("stock") == []
    assert stored._attempts("stock") == [4] and same(stored.read(STOCK), stock(spark, before))


def states():
    values = st.tuples(
        st.none() | st.integers(0, 12), st.sampled_from([0, 1, None]), st.sampled_from(KINDS), st.integers(0, 2),
        st.sampled_from([None, 0.0, float("nan"), 1.5]),
    )
    return st.lists(values.map(lambda v: row(*v)), max_size=25)


@settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=states(), after=states())
@example(before=[], after=[])
def test_a_feed_leads_from_one_state_to_the_other(spark, before, after):
    a, b = stock(spark, before), stock(spark, after)
    feed = change_feed(a, b, ["id"])
    assert same(applied(a, feed), b)
    kinds = {}
    for r in feed.collect():
        kinds.setdefault(r["id"], set()).add(r["change_type"])
    here, there = {r[0] for r in before}, {r[0] for r in after}
    for key, found in kinds.items():
        assert found == ({"delete"} if key not in there else {"insert"} if key not in here else {"update_before", "update_after"})
    stored = Warehouse(spark, fresh_folder(spark, "feed"))
    stored.write(a, STOCK, ranges=Ranges("id", 4))
    stored.write(b, STOCK, ranges=Ranges("id", 4))
    assert same(stored.read(STOCK, 2), b)
    wanted, got = differing_rows(a, b), loads.load_difference(stored, STOCK, 1, 2)
    assert same(wanted, got)
    copy = Warehouse(spark, fresh_folder(spark, "copy"))
    copy.write(a, STOCK)
    load = loads.apply_feed(copy, STOCK, loads.feed_between(stored, STOCK, 1, 2))
    assert same(copy.read(STOCK), b) and load.rows == len(after)
    told(copy, 2)


def test_a_feed_rewrites_touched_directories_only(spark, folder):
    stored, before = Warehouse(spark, folder), many(48)
    stored.write(stock(spark, before), STOCK)
    after = [r for r in before if r[0] != 5] + [row(99, 0, "a")]
    feed = change_feed(stock(spark, before), stock(spark, after), ["id"])
    loads.apply_feed(stored, STOCK, feed)
    touched = ["day_day=2024-01-01/kind=a", "day_day=2024-01-02/kind=~__HIVE_DEFAULT_PARTITION__"]
    assert stored.directories("stock", 2) == touched
    assert sorted(stored.places("stock", 2)[1] + touched) == stored.directories("stock", 1)
    assert same(stored.read(STOCK), stock(spark, after))
    with pytest.raises(Exception, match="not in the table"):
        loads.apply_feed(stored, STOCK, feed)
    assert stored.newest("stock") == 2
    again = loads.feed_between(stored, STOCK, 1, 2)
    opened = loads.opened(stored, STOCK, 1, 2)
    assert sorted(d for held in opened.before.values() for d in held) == touched
    assert sorted(r["change_type"] for r in again.collect()) == ["delete", "insert"]
    with pytest.raises(ValueError, match="change_type"):
        change_feed(feed, feed, ["id"])
    with pytest.raises(Exception, match="not a kind of change"):
        applied(stock(spark, before), feed.withColumn("change_type", F.lit("moved"))).collect()


def test_feed_of_a_table_without_directories(spark, folder):
    stored, plain = Warehouse(spark, folder), STOCK.partitioned_by()
    a, b = stock(spark, many(20)), stock(spark, many(23)[2:])
    stored.write(a, plain)
    loads.apply_feed(stored, plain, change_feed(a, b, ["id"]))
    assert same(stored.read(plain), b)


def test_equal_loads_are_compared_without_reading(spark, folder):
    stored, rows = Warehouse(spark, folder), many(100)
    stored.write(stock(spark, rows), STOCK)
    stored.write(stock(spark, rows[::-1]), STOCK, gather=False)
    assert loads.opened(stored, STOCK, 1, 2).nothing
    found = loads.load_difference(stored, STOCK, 1, 2)
    assert "parquet" not in found._jdf.queryExecution().optimizedPlan().toString().lower() and found.isEmpty()


def test_one_changed_row_opens_one_range(spark, folder):
    ranges, rows = Ranges("id", 10), many(400)
    stored = Warehouse(spark, folder)
    stored.write(stock(spark, rows), STOCK, ranges=ranges)
    changed = [*rows[:123], (*rows[123][:4], 99.0), *rows[124:]]
    stored.write(stock(spark, changed), STOCK, ranges=ranges)
    opened = loads.opened(stored, STOCK, 1, 2)
    directory = {d for held in opened.before.values() for d in held}
    assert opened.starts == [120] and len(directory) == 1 and opened.after == {2: list(directory)}
    one, two = loads._pair(stored, STOCK, 1, 2, opened)
    assert one.count() < 10 and all(next(iter(directory)) in name.replace("%25", "%") for name in one.inputFiles())
    assert "GreaterThanOrEqual(id,120)" in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["only_in"] for r in loads.load_difference(stored, STOCK, 1, 2).collect()) == ["source", "target"]
    # A part that both loads name is not looked at, and a part alone keeps its leaves.
    stored.reload(stock(spark, [row(5, 0, "a")]), STOCK)
    opened = loads.opened(stored, STOCK, 2, 3)
    assert {d for held in opened.before.values() for d in held} == {"day_day=2024-01-01/kind=a"}
    assert same(loads.load_difference(stored, STOCK, 2, 3), differing_rows(stored.read(STOCK, 2), stored.read(STOCK, 3)))


def test_ranges_without_a_start_and_many_ranges(spark, folder):
    least = -(2**63)
    stored, ranges = Warehouse(spark, folder), Ranges("id", 10)
    rows = [row(None), row(least), row(least + 3), row(2**63 - 1), row(5)]
    stored.write(stock(spark, rows), STOCK, ranges=ranges)
    stored.write(stock(spark, [row(None, amount=2), row(least, amount=2), *rows[2:]]), STOCK, ranges=ranges)
    assert loads.opened(stored, STOCK, 1, 2).starts[-1] is None
    assert same(loads.load_difference(stored, STOCK, 1, 2), differing_rows(stored.read(STOCK, 1), stored.read(STOCK, 2)))
    stored.write(stock(spark, many(3000)), STOCK, ranges=ranges)
    stored.write(stock(spark, [(*r[:4], 0.25) for r in many(3000)]), STOCK, ranges=ranges)
    assert same(loads.load_difference(stored, STOCK, 3, 4), differing_rows(stored.read(STOCK, 3), stored.read(STOCK, 4)))
    assert loads.load_difference(stored, STOCK, 3, 4).count() == 6000


def test_loads_of_different_layouts_are_read_whole(spark, folder):
    stored = Warehouse(spark, folder)
    stored.write(stock(spark, many(30)), STOCK)
    stored.write(stock(spark, many(31)), STOCK.partitioned_by("kind"))
    assert [r["only_in"] for r in loads.load_difference(stored, STOCK, 1, 2).collect()] == ["target"]
    assert [r["change_type"] for r in loads.feed_between(stored, STOCK, 1, 2).collect()] == ["insert"]


def test_digests_add_up():
    one, two = digest.Digest(2, (1, 2, 3, 4)), digest.Digest(3, (5, 6, 7, 8))
    assert one + two - one == two and one + digest.NOTHING == one


class Flawed(WarehouseTarget):
    """A target that changes one value of what it is given, or loses and repeats a row."""

    def __init__(self, warehouse, flaw):
        super().__init__(warehouse)
        self.flaw = flaw

    def read(self, contract):
        return self.flaw(super().read(contract))


@pytest.mark.parametrize(
    ("flaw", "status"),
    [
        (lambda rows: rows, "PASSED"),
        (lambda rows: rows.withColumn("amount", F.when(F.col("id") == 17, F.lit(3)).otherwise(F.col("amount")).cast("decimal(10,2)")), "FAILED"),
        (lambda rows: rows.withColumn("kind", F.when(F.col("kind") == "", F.lit(None)).otherwise(F.col("kind"))), "FAILED"),
        (lambda rows: rows.where("id <> 3").unionAll(rows.where("id = 4")), "FAILED"),
        (lambda rows: rows.withColumn("amount", F.col("amount").cast("double")), "ERROR"),
    ],
)
def test_full_cycle_reads_its_source_once(spark, flaw, status):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    given_rows = stock(spark, many(50))
    source = jobs.Source(STOCK, lambda: given_rows.mapInArrow(counted, given_rows.schema))
    stored, database = (Warehouse(spark, fresh_folder(spark, name)) for name in ("once", "once-target"))
    found = jobs.full_cycle(stored, [source], Flawed(database, flaw))[0]
    assert read.value == 50
    assert found == {"table_name": "stock", "source_rows": 50, "migrated_rows": 50, "restored_rows": 50, "status": status}
