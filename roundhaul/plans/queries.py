"""The registered queries. Each takes a session and a folder of Parquet tables.

*customer*, *part*, *orders*, *lineitem* and *events* stand for customers, products,
transactions, order details and the time series of stock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhaul.contracts import Contract, ForeignKey
from roundhaul.functions import convert, derive
from roundhaul.operators import audit, discover, evolve, stats, validate
from roundhaul.plans import jobs, loads, resume
from roundhaul.plans.targets import WarehouseTarget
from roundhaul.session import allow_times, fresh_folder, local_table
from roundhaul.sources.warehouse import NotMigrated, Ranges, Warehouse, count_by_table, read_directory

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
COUNTED = ("customer", "part", "orders", "lineitem", "events")

# Labels of the derived categories, in order of the remainder they stand for.
SEGMENTS = ["Premium", "Standard", "Basic", "Enterprise"]
CATEGORIES = ["Electronics", "Clothing", "Home", "Sports", "Books"]
PAYMENTS = ["Credit Card", "Debit Card", "PayPal", "Wire Transfer"]
STATUSES = ["COMPLETED", "SHIPPED", "PROCESSING", "PENDING", "CANCELLED"]
COLOURS = ["Red", "Blue", "Green", "Black", "White"]

# The moment that counts as "now" in derived dates, so that results can be repeated.
NOW = "2024-06-01 12:00:00"

CUSTOMER = Contract.declare(
    "customer",
    {
        "c_custkey": "bigint not null",
        "c_name": "nvarchar(100) not null",
        "c_nationkey": "int",
        "c_acctbal": "decimal(19,4)",
        "c_mktsegment": "nvarchar(50)",
    },
    key=["c_custkey"],
)
PART = Contract.declare(
    "part",
    {
        "p_partkey": "bigint not null",
        "p_name": "nvarchar(255) not null",
        "p_brand": "nvarchar(100) not null",
        "p_type": "nvarchar(100)",
        "p_size": "smallint",
        "p_retailprice": "money",
    },
    key=["p_partkey"],
    partition_by=["p_brand"],
)
ORDERS = Contract.declare(
    "orders",
    {
        "o_orderkey": "bigint not null",
        "o_custkey": "bigint not null",
        "o_orderstatus": "char(1) not null",
        "o_totalprice": "decimal(19,4)",
        "o_orderdate": "datetime2(6) not null",
        "o_orderpriority": "nvarchar(20)",
    },
    key=["o_orderkey"],
    partition_by=["o_orderstatus"],
)
LINEITEM = Contract.declare(
    "lineitem",
    {
        "l_orderkey": "bigint not null",
        "l_partkey": "bigint not null",
        "l_suppkey": "bigint",
        "l_linenumber": "smallint not null",
        "l_quantity": "decimal(10,2)",
        "l_extendedprice": "decimal(19,4)",
        "l_discount": "decimal(5,4)",
        "l_tax": "decimal(5,4)",
        "l_returnflag": "char(1)",
        "l_linestatus": "char(1)",
        "l_shipdate": "date",
    },
)
EVENTS = Contract.declare(
    "events",
    {
        "event_id": "bigint not null",
        "ts": "datetime2(6) not null",
        "user_id": "bigint",
        "event_type": "nvarchar(20)",
        "value": "float",
        "props": "nvarchar(max)",
    },
    key=["event_id"],
    partition_by=["ts", "event_type"],
)
DOCUMENTS = Contract.declare(
    "documents",
    {
        "doc_id": "bigint not null",
        "text": "nvarchar(max)",
        "lang": "nvarchar(20)",
        "source": "nvarchar(50)",
        "n_chars": "bigint",
    },
    key=["doc_id"],
    partition_by=["source"],
)
# The columns that others may refer to.
REFERRED = {
    "customer": ["c_custkey"], "part": ["p_partkey"], "orders": ["o_orderkey"], "events": ["event_id"], "documents": ["doc_id"]
}
# Order statuses are few, so orders are written to their directories without a shuffle.
MOVED = (CUSTOMER, PART, ORDERS, LINEITEM, EVENTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names=COUNTED) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}


def warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, fresh_folder(spark, label))


def changed_orders(orders: DataFrame) -> DataFrame:
    """Orders as a faulty restore could have left them: some lost, some altered, some made up."""
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    lost = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    copied = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "2-HIGH")
    price = F.when(urgent, F.col("o_totalprice") + 0.25).otherwise(F.col("o_totalprice"))
    kept = orders.where(~lost).withColumn("o_totalprice", price)
    return kept.unionAll(orders.where(copied).withColumn("o_orderkey", -1 - F.col("o_orderkey")))


# Counts, statistics and filters


def load_statistics(spark, sf_dir):
    found = stats.load_statistics(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")
    return found.withColumnRenamed("unique_entities", "unique_customers")


def row_count(spark, sf_dir):
    return stats.row_count(table(spark, sf_dir, "lineitem"))


def labelled_counts(spark, sf_dir):
    return stats.labelled_counts(tables(spark, sf_dir))


def total_rows(spark, sf_dir):
    return stats.total_rows(tables(spark, sf_dir))


def total_rows_scalar(spark, sf_dir):
    return stats.total_rows_scalar(tables(spark, sf_dir))


def orders_by_place(region: DataFrame, nation: DataFrame, customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per region, nation and market segment.

    Orders are counted per customer before the first join and counts are added up before
    each further one. The fact table is thus reduced on the map side, whichever customer
    or nation holds most of it, and no join sees more rows than it has keys.
    """
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    per_nation = (
        customer.join(per_customer, "c_custkey")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_nation.join(nation, "n_nationkey")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name", "c_mktsegment")
        .agg(F.sum("n").alias("order_count"))
        .orderBy("r_name", "n_name", "c_mktsegment")
    )


def inventory_join(spark, sf_dir):
    names = ("region", "nation", "customer", "orders")
    return orders_by_place(*(table(spark, sf_dir, name) for name in names))


def table_inventory(spark, sf_dir):
    paths = {name: f"{sf_dir.rstrip('/')}/{name}.parquet" for name in TABLES}
    counted = count_by_table(spark, "sales", paths, r"/([^/]+)\.parquet(?:/|$)")
    with ThreadPoolExecutor(8) as pool:  # each schema is one footer, read by the driver
        widths = list(pool.map(lambda name: (name, len(table(spark, sf_dir, name).columns)), TABLES))
    return counted.join(local_table(spark, widths, "table_name string, column_count int"), "table_name")


def param_filter(spark, sf_dir):
    wanted = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    return stats.equal_to(table(spark, sf_dir, "orders"), wanted)


def in_list_filter(spark, sf_dir):
    chosen = stats.one_of(table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "R"])
    return chosen.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")


def latest_loads(spark, sf_dir):
    return stats.latest(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", n=10)


def profile_columns(spark, sf_dir):
    return stats.profile_columns(convert.conform(table(spark, sf_dir, "customer"), CUSTOMER), CUSTOMER.required)


# Conversions


def conform_types(spark, sf_dir):
    return convert.conform(table(spark, sf_dir, "lineitem"), LINEITEM)


def exact_decimal(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    exact = convert.exact_decimal(text, 19, 4)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", exact.alias("exact_price"), exact.cast("double").alias("double_price")
    )


def rejected_values(spark, sf_dir):
    as_text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
    )
    wanted = Contract.declare("orders", {"o_orderkey": "bigint", "o_totalprice": "decimal(19,4)"})
    return convert.rejected_values(as_text, wanted)


def lossy_values(spark, sf_dir):
    """Line items against types that are too narrow for some of their values."""
    wanted = Contract.declare(
        "lineitem",
        {
            "l_partkey": "tinyint",
            "l_linenumber": "smallint",
            "l_quantity": "int",
            "l_extendedprice": "decimal(12,1)",
            "l_discount": "decimal(5,1)",
        },
    )
    return convert.lossy_values(table(spark, sf_dir, "lineitem").select(*wanted.names), wanted)


def bool_flag(spark, sf_dir):
    bit = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    flag = convert.bit_to_boolean(bit)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", flag.alias("is_final"), convert.boolean_to_bit(flag).alias("final_bit")
    )


def _events_with_nan(spark, sf_dir):
    broken = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").withColumn("value", broken)


def nan_to_null(spark, sf_dir):
    cleaned = convert.nan_to_null(F.col("value")).alias("value")
    return _events_with_nan(spark, sf_dir).select("event_id", cleaned)


def timestamp_ms_text(spark, sf_dir):
    text = convert.timestamp_ms_text(F.col("ts")).alias("ts_text")
    return table(spark, sf_dir, "events").select("event_id", text)


def export_form(spark, sf_dir):
    rows = _events_with_nan(spark, sf_dir).select(
        "event_id",
        "ts",
        "value",
        (F.col("event_type") == "purchase").alias("is_purchase"),
        F.encode("props", "UTF-8").alias("props_bytes"),
    )
    out = convert.export_form(rows, timestamps_as_text=True, booleans_as_bits=True)
    return out.withColumn("props_bytes", F.hex("props_bytes"))


# Derived values


def order_pricing(spark, sf_dir):
    subtotal, tax, total = derive.order_amounts(
        F.col("l_quantity"),
        F.col("l_extendedprice"),
        (F.col("l_discount").cast("decimal(5,4)") * 100).cast("decimal(5,2)"),
        F.col("l_tax"),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        subtotal.alias("subtotal"),
        tax.alias("tax_amount"),
        total.alias("total_amount"),
    )


def case_bucket(spark, sf_dir):
    key = F.col("p_partkey")
    colour = F.concat(F.lit("Color: "), derive.cycle_bucket(key, COLOURS))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        derive.cycle_bucket(key, SEGMENTS).alias("segment"),
        derive.cycle_bucket(key, CATEGORIES).alias("category"),
        derive.cycle_bucket(key, PAYMENTS).alias("payment_method"),
        derive.cycle_bucket(key, STATUSES).alias("order_status"),
        derive.sparse(key % 3 == 0, colour).alias("product_variant"),
        F.when(key % 10 == 0, 12).when(key % 10 == 1, 24).alias("warranty_months"),
        (F.lit(300) + key % 500).cast("double").alias("credit_score"),
    )


def padded_code(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        derive.padded_code("CUST", F.col("c_custkey"), 5).alias("customer_code"),
        derive.padded_code("555-", F.col("c_custkey"), 4).alias("phone"),
    )


def concat_null_safe(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    label = derive.text_concat(F.col("c_name"), F.lit("/"), segment, F.lit("/"), F.col("c_nationkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", label.alias("label"))


def date_shift(spark, sf_dir):
    now = F.lit(NOW).cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        derive.days_before(now, (F.col("o_orderkey") % 30).cast("int")).alias("snapshot_date"),
        derive.minutes_before(F.col("o_orderdate"), (F.col("o_custkey") % 1440).cast("int")).alias("placed_at"),
        F.to_date("o_orderdate").alias("order_day"),
    )


def stock_position(spark, sf_dir):
    on_hand = F.lit(100) + F.col("p_partkey") % 500
    reserved = derive.sparse(F.col("p_size") > 25, F.col("p_size") * 4)
    available = derive.available_stock(on_hand, reserved)
    reorder_point = F.lit(20) + F.col("p_partkey") % 30
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        available.alias("available"),
        derive.below_reorder(available, reorder_point).alias("below_reorder"),
    )


def sparse_defaults(spark, sf_dir):
    note = derive.sparse(F.col("c_acctbal") > 9000, F.lit("large balance"))
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        note.alias("notes"),
        derive.with_default(segment, F.lit("UNASSIGNED")).alias("segment"),
        derive.with_default(derive.sparse(F.col("c_acctbal") < 0, F.lit(True)), F.lit(False)).alias("in_debt"),
    )


# Storage


def write_read_roundtrip(spark, sf_dir):
    stored = warehouse(spark, "roundtrip")
    stored.write(convert.conform(table(spark, sf_dir, "lineitem"), LINEITEM), LINEITEM)
    return stored.read(LINEITEM)


def scan_multi_file(spark, sf_dir):
    folder = fresh_folder(spark, "files")
    parts = table(spark, sf_dir, "part")
    for kind, low in (("small", True), ("large", False)):
        chosen = parts.where(F.coalesce(F.col("p_size") <= 25, F.lit(False)) == low)
        chosen.write.mode("append").parquet(folder)
    return read_directory(spark, folder, Contract.of("part", parts))


def partition_identity(spark, sf_dir):
    stored = warehouse(spark, "identity")
    stored.write(convert.conform(table(spark, sf_dir, "part"), PART), PART)
    return stored.read(PART)


def partition_day(spark, sf_dir):
    stored = warehouse(spark, "day")
    stored.write(table(spark, sf_dir, "events"), EVENTS)
    return stored.read(EVENTS)


def day_range_scan(spark, sf_dir):
    by_day = EVENTS.partitioned_by("ts")
    stored = warehouse(spark, "range")
    stored.write(table(spark, sf_dir, "events"), by_day)
    return stored.read_range(by_day, "ts", dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 13, 18))


def read_as_of(spark, sf_dir):
    orders = convert.conform(table(spark, sf_dir, "orders"), ORDERS)
    stored = warehouse(spark, "asof")
    first = stored.write(orders, ORDERS, gather=False)
    stored.write(orders.where(F.col("o_orderstatus") == "F"), ORDERS, gather=False)
    return stored.read(ORDERS, as_of=first.id)


def replaced_load(spark, sf_dir):
    orders = convert.conform(table(spark, sf_dir, "orders"), ORDERS)
    stored = warehouse(spark, "replace")
    stored.write(orders, ORDERS, gather=False)
    stored.write(orders.where(F.col("o_orderstatus") == "F"), ORDERS, gather=False)
    return stored.read(ORDERS)


def revised_documents(docs: DataFrame) -> DataFrame:
    """Documents as later deliveries of three sources leave them: some gone, some revised, some added."""
    odd = F.col("n_chars") % 2 == 1
    gone = (F.col("source") == "src3") & odd
    revised = (F.col("source") == "src5") & odd
    added = docs.where((F.col("source") == "src7") & odd).withColumn("doc_id", -1 - F.col("doc_id"))
    text = F.when(revised, F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text"))
    n_chars = F.when(revised, F.col("n_chars") + 10).otherwise(F.col("n_chars"))
    return docs.where(~F.coalesce(gone, F.lit(False))).withColumns({"text": text, "n_chars": n_chars}).unionByName(added)


#: The sources that are delivered again, as a condition on the directory key.
REVISED = "source IN ('src3', 'src5', 'src7')"


def _two_loads(spark, sf_dir, label, ranges=None):
    """Documents in a warehouse, and a second load in which three sources are delivered again."""
    docs, stored = table(spark, sf_dir, "documents"), warehouse(spark, label)
    first = stored.write(docs, DOCUMENTS, ranges=ranges)
    second = stored.reload(revised_documents(docs).where(REVISED), DOCUMENTS, only=F.expr(REVISED))
    return stored, first.id, second.id


def partial_reload(spark, sf_dir):
    """Three sources are delivered again, one of them without any row; all others stay where they are."""
    docs, stored = table(spark, sf_dir, "documents"), warehouse(spark, "partial")
    stored.write(docs, DOCUMENTS)
    fresh = revised_documents(docs).where(REVISED).where("source <> 'src3'")
    stored.reload(fresh, DOCUMENTS, only=F.expr(REVISED))
    return stored.read(DOCUMENTS)


def change_feed(spark, sf_dir):
    stored, first, second = _two_loads(spark, sf_dir, "feed")
    return loads.feed_between(stored, DOCUMENTS, first, second)


def feed_applied(spark, sf_dir):
    """The changes from one load to the next are applied to a copy of the first in another warehouse."""
    stored, first, second = _two_loads(spark, sf_dir, "feed-from")
    copy = warehouse(spark, "feed-to")
    copy.write(stored.read(DOCUMENTS, first), DOCUMENTS, gather=False)
    loads.apply_feed(copy, DOCUMENTS, loads.feed_between(stored, DOCUMENTS, first, second))
    return copy.read(DOCUMENTS)


def load_difference(spark, sf_dir):
    """Two loads compared by the digests kept with them; the rows of ranges that differ are read."""
    stored, first, second = _two_loads(spark, sf_dir, "difference", Ranges("doc_id", 1000))
    return loads.load_difference(stored, DOCUMENTS, first, second)


def validity_history(spark, sf_dir):
    """Three loads of the documents: as given, three sources revised, one of those taken back."""
    stored, _, _ = _two_loads(spark, sf_dir, "history")
    docs = table(spark, sf_dir, "documents")
    stored.reload(docs.where("source = 'src5'"), DOCUMENTS, only=F.col("source") == "src5")
    return loads.history(stored, DOCUMENTS)


def compacted(spark, sf_dir):
    """Rows and files of each source after the small files of a load without a shuffle were put together."""
    stored = warehouse(spark, "compact")
    stored.write(table(spark, sf_dir, "documents").repartition(8), DOCUMENTS, gather=False)
    loads.compact(stored, DOCUMENTS)
    sizes = stored.files("documents", stored.newest("documents"))
    names = stored.keyed(DOCUMENTS, stored.places("documents", stored.newest("documents")))
    files = local_table(spark, [(d, len(held)) for (_, d), held in sizes.items()], "_directory string, files int")
    rows = stored.read(DOCUMENTS).groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))
    files = names.join(files, "_directory").select(F.col("source").alias("held"), "files")
    return rows.join(files, F.col("source").eqNullSafe(F.col("held"))).select("source", "row_count", "files")


def profile_range(spark, sf_dir):
    """Profiles kept with each source merged for some sources, beside exact counts, and whether the estimates are close."""
    stored, wanted = warehouse(spark, "profile"), F.col("source") < "src2"
    first = stored.write(table(spark, sf_dir, "documents"), DOCUMENTS)
    stored.keep_profile(DOCUMENTS, first.id)
    told = stored.profile(DOCUMENTS, only=wanted)
    rows = stored.read(DOCUMENTS).where(wanted)
    quartiles = {r["column_name"]: r["quartiles"] for r in told.where("quartiles IS NOT NULL").collect()}  # a row a column
    ranks = [
        F.struct(
            F.lit(name).alias("name"),
            *[(F.count_if(F.col(name) < value) / F.count(name)).alias(f"below{i}") for i, value in enumerate(found)],
            *[(F.count_if(F.col(name) <= value) / F.count(name)).alias(f"up_to{i}") for i, value in enumerate(found)],
        )
        for name, found in quartiles.items()
    ]
    close = reduce(
        lambda a, b: a & b, [(F.col(f"below{i}") <= q + 0.02) & (F.col(f"up_to{i}") >= q - 0.02) for i, q in enumerate((0.25, 0.5, 0.75))]
    )
    near = rows.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks")).select("name", close.alias("quartiles_close"))
    exact = stats.profile_columns(rows, DOCUMENTS.required).select(F.col("column_name").alias("counted"), "distinct_count")
    both = told.join(exact, F.col("counted") == F.col("column_name")).join(near, F.col("name") == F.col("column_name"), "left")
    return both.select(
        "column_name", "column_type", "position", "nullable", "row_count", "null_count", "min_value", "max_value", "distinct_count",
        (F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.08 * F.col("distinct_count")).alias("distinct_close"),
        "quartiles_close",
    )


def discovered_keys(spark, sf_dir):
    """The minimal keys of up to two columns that the rows of the five tables and of the documents' ids obey."""
    held = {**tables(spark, sf_dir), "documents": table(spark, sf_dir, "documents").drop("text")}
    found = [(name, ",".join(key)) for name, df in held.items() for key in discover.candidate_keys(df)]
    return local_table(spark, found, "table_name string, key_columns string")


def discovered_references(spark, sf_dir):
    """Columns whose values all occur in a key of the tables."""
    held = {**tables(spark, sf_dir), **{name: table(spark, sf_dir, name).select("doc_id") for name in ("documents", "labels")}}
    found = discover.references(held, REFERRED)
    return local_table(spark, found, "child string, child_column string, parent string, parent_column string")


def clustered_range(spark, sf_dir):
    """A range of two columns that name no directory, read from files laid along a curve through both."""
    stored = warehouse(spark, "cluster")
    stored.write(table(spark, sf_dir, "documents"), DOCUMENTS, cluster=["doc_id", "n_chars"])
    return stored.read(DOCUMENTS).where("doc_id BETWEEN 100 AND 600 AND n_chars BETWEEN 300 AND 900")


def time_of_day(spark, sf_dir):
    """Times of day from text, held in their own type, and those of the afternoon read back as text."""
    allow_times(spark)
    contract = Contract.declare("times", {"event_id": "bigint not null", "at": "time(6)"}, key=["event_id"]).with_native_times()
    text = F.date_format("ts", "HH:mm:ss.SSSSSS").alias("at")
    stored = warehouse(spark, "times")
    stored.write(convert.conform(table(spark, sf_dir, "events").select("event_id", text), contract), contract)
    found = stored.read_range(contract, "at", "12:00:00", "18:30:00.5")
    return found.select("event_id", F.col("at").cast("string").alias("at"))


def layout_change(spark, sf_dir):
    """A load without directories, read by range with the contract of a later load that has them."""
    events = table(spark, sf_dir, "events")
    stored, by_day = warehouse(spark, "layout"), EVENTS.partitioned_by("ts")
    first = stored.write(events, EVENTS.partitioned_by())
    stored.write(events.where(F.col("event_type") == "error"), by_day)
    bounds = dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 13, 18)
    return stored.read_range(by_day, "ts", *bounds, as_of=first.id)


def date_range_scan(spark, sf_dir):
    """Days count as their first instant: from the 10th at 6 to the 13th at 18 are the 11th to the 13th."""
    contract = replace(LINEITEM, name="shipped").partitioned_by("l_shipdate")
    stored = warehouse(spark, "days")
    stored.write(convert.conform(table(spark, sf_dir, "lineitem"), LINEITEM), contract)
    return stored.read_range(contract, "l_shipdate", dt.datetime(1995, 1, 10, 6), dt.datetime(1995, 3, 13, 18))


# Validation, audits and evolution


def _both(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders, changed_orders(orders)


def row_count_match(spark, sf_dir):
    return validate.row_count_match(*_both(spark, sf_dir))


def statistics_match(spark, sf_dir):
    return validate.statistics_match(*_both(spark, sf_dir), "o_custkey", "o_orderdate")


def float_tolerance(spark, sf_dir):
    return validate.float_tolerance(*_both(spark, sf_dir), ["o_orderkey"])


def content_match(spark, sf_dir):
    return validate.content_match(*_both(spark, sf_dir))


def content_diff(spark, sf_dir):
    return validate.content_diff(*_both(spark, sf_dir))


def differing_rows(spark, sf_dir):
    return validate.differing_rows(*_both(spark, sf_dir))


def keyed_diff(spark, sf_dir):
    return validate.keyed_diff(*_both(spark, sf_dir), ["o_orderkey"])


def audit_not_null(spark, sf_dir):
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    lines = table(spark, sf_dir, "lineitem").withColumn("l_returnflag", flag)
    return audit.audit_not_null(lines, ["l_orderkey", "l_returnflag", "l_shipdate"])


def audit_unique(spark, sf_dir):
    return audit.audit_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def audit_foreign_key(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return audit.audit_foreign_key(table(spark, sf_dir, "orders"), ["o_custkey"], known, ["c_custkey"])


# The stand-ins with keys between them, and faults that break some of their rules.
AUDITED = (
    CUSTOMER,
    PART,
    replace(ORDERS, foreign_keys=(ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)),
    replace(
        LINEITEM,
        key=("l_orderkey", "l_linenumber"),
        foreign_keys=(
            ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
            ForeignKey(("l_partkey",), "part", ("p_partkey",)),
        ),
    ),
    EVENTS,
)


def audit_contracts(spark, sf_dir):
    given = tables(spark, sf_dir)
    given["customer"] = given["customer"].withColumn("c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")))
    given["part"] = given["part"].where(F.col("p_size") > 1)
    given["orders"] = given["orders"].unionAll(given["orders"].where(F.col("o_orderstatus") == "P"))
    return audit.audit_contracts(given, AUDITED)


def validation_report(spark, sf_dir):
    """Every check of five tables, of which the orders came back damaged."""
    given = tables(spark, sf_dir)
    found = {**given, "orders": changed_orders(given["orders"])}
    timed = {"orders": ("o_custkey", "o_orderdate")}
    checks = [validate.validation_checks(n, given[n], found[n], *timed.get(n, ())) for n in COUNTED]
    return reduce(DataFrame.unionAll, checks)


def evolve_append(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    before = parts.select(
        "p_partkey",
        "p_size",
        F.col("p_retailprice").cast("decimal(15,2)").alias("p_retailprice"),
        (F.col("p_retailprice") / 2).cast("float").alias("half_price"),
        "p_brand",
    )
    after = parts.select(
        "p_partkey",
        F.col("p_size").cast("bigint").alias("p_size"),
        F.col("p_retailprice").cast("decimal(19,2)").alias("p_retailprice"),
        (F.col("p_retailprice") / 2).alias("half_price"),
        "p_type",
    )
    return evolve.evolve_append(before, after)


# Jobs


def _sources(spark, sf_dir):
    return [
        jobs.Source(c, lambda name=c.name: table(spark, sf_dir, name), gather=c is not ORDERS) for c in MOVED
    ]


def migrate_report(spark, sf_dir):
    """Five tables go through although the columns of a sixth are not what was agreed."""
    narrow = Contract.declare("supplier", {"s_suppkey": "bigint not null", "s_name": "nvarchar(100)"})
    drifted = jobs.Source(narrow, lambda: table(spark, sf_dir, "supplier"))
    outcomes = jobs.migrate(warehouse(spark, "migrate"), [*_sources(spark, sf_dir), drifted])
    return jobs.report(spark, outcomes).select("table_name", "status", "rows")


def restore_report(spark, sf_dir):
    """Five tables come back; a sixth was never migrated and has nothing to restore."""
    stored, database = warehouse(spark, "stored"), warehouse(spark, "restored")
    jobs.migrate(stored, _sources(spark, sf_dir))
    never = Contract.declare("never_migrated", {"id": "bigint"})
    outcomes = jobs.restore(
        stored,
        [*MOVED, never],
        WarehouseTarget(database),
        statistics={"orders": jobs.Statistics("o_custkey", "o_orderdate")},
    )
    return jobs.report(spark, outcomes).select("table_name", "status", "rows", "validation")


def restore_roundtrip(spark, sf_dir):
    """Events with their properties as bytes, migrated, restored and read back from the target."""
    events = _events_with_nan(spark, sf_dir).withColumn("props", F.encode("props", "UTF-8"))
    contract = Contract.of("events", events, key=["event_id"], partition_by=["ts"])
    stored, target = warehouse(spark, "events"), WarehouseTarget(warehouse(spark, "events-target"))
    jobs.migrate(stored, [jobs.Source(contract, lambda: events)])
    jobs.restore(stored, [contract], target)
    return target.read(contract).withColumn("props", F.hex("props"))


def restore_resumed(spark, sf_dir):
    """The documents are restored by ranges into a target that fails half-way, and then the missing ranges are."""

    class Failing(WarehouseTarget):
        left = 2

        def append(self, df, contract):
            if not self.left:
                raise ConnectionError("the target is gone")
            self.left -= 1
            super().append(df, contract)

    stored, database = warehouse(spark, "resumed"), warehouse(spark, "resumed-target")
    stored.write(table(spark, sf_dir, "documents"), DOCUMENTS)
    ranges = Ranges("doc_id", 50)
    failed = resume.restore_by_ranges(stored, DOCUMENTS, Failing(database), ranges, batches=4)
    done = resume.restore_by_ranges(stored, DOCUMENTS, WarehouseTarget(database), ranges, batches=4)
    statuses = F.lit(f"{failed.status} {done.status}").alias("statuses")
    return WarehouseTarget(database).read(DOCUMENTS).select("*", statuses)


def restore_subset(spark, sf_dir):
    """All five tables are stored, two of them are asked for and restored."""
    stored, database = warehouse(spark, "subset"), warehouse(spark, "subset-target")
    jobs.migrate(stored, _sources(spark, sf_dir))
    outcomes = jobs.restore(stored, MOVED, WarehouseTarget(database), only=["orders", "part"])
    return database.inventory().join(jobs.report(spark, outcomes).select(
        F.concat("table_name", F.lit("_backload")).alias("table_name"), "status", "rows"), "table_name"
    ).select("table_name", "row_count", "status", "rows")


def restore_before_migration(spark, sf_dir):
    """A restore from an empty warehouse is refused; after the migration it goes through."""
    stored, target = warehouse(spark, "early"), WarehouseTarget(warehouse(spark, "early-target"))
    try:
        outcomes = jobs.restore(stored, [CUSTOMER], target)
    except NotMigrated as refused:
        outcomes = [jobs.Outcome("restore", CUSTOMER.name, "refused", error=type(refused).__name__)]
    jobs.migrate(stored, [source for source in _sources(spark, sf_dir) if source.contract is CUSTOMER])
    outcomes += jobs.restore(stored, [CUSTOMER], target)
    return jobs.report(spark, outcomes).select("table_name", "status", "rows", "error")


def full_cycle(spark, sf_dir):
    stored, database = warehouse(spark, "cycle"), warehouse(spark, "cycle-target")
    rows = jobs.full_cycle(stored, _sources(spark, sf_dir), WarehouseTarget(database))
    return local_table(
        spark,
        [tuple(row.values()) for row in rows],
        "table_name string, source_rows bigint, migrated_rows bigint, restored_rows bigint, status string",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        load_statistics,
        row_count,
        labelled_counts,
        total_rows,
        total_rows_scalar,
        inventory_join,
        table_inventory,
        param_filter,
        in_list_filter,
        latest_loads,
        profile_columns,
        conform_types,
        exact_decimal,
        rejected_values,
        lossy_values,
        bool_flag,
        nan_to_null,
        timestamp_ms_text,
        export_form,
        order_pricing,
        case_bucket,
        padded_code,
        concat_null_safe,
        date_shift,
        stock_position,
        sparse_defaults,
        write_read_roundtrip,
        scan_multi_file,
        partition_identity,
        partition_day,
        day_range_scan,
        date_range_scan,
        layout_change,
        read_as_of,
        replaced_load,
        partial_reload,
        change_feed,
        feed_applied,
        load_difference,
        validity_history,
        compacted,
        clustered_range,
        time_of_day,
        profile_range,
        discovered_keys,
        discovered_references,
        row_count_match,
        statistics_match,
        float_tolerance,
        content_match,
        content_diff,
        differing_rows,
        keyed_diff,
        audit_not_null,
        audit_unique,
        audit_foreign_key,
        audit_contracts,
        validation_report,
        evolve_append,
        migrate_report,
        restore_report,
        restore_roundtrip,
        restore_resumed,
        restore_subset,
        restore_before_migration,
        full_cycle,
    )
}
