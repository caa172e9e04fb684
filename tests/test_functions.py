import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roundhaul.contracts import Contract
from roundhaul.functions import convert, derive
from tests import sales_data

T = Contract.declare("t", {"id": "bigint", "tiny": "tinyint", "flag": "bit", "amount": "money"})


def values(df, column):
    return [row[column] for row in df.collect()]


def test_conform_orders_and_types(spark):
    given = [("12.5", 255, 1, 1), (None, None, None, 2)]
    rows = spark.createDataFrame(given, "amount string, tiny int, flag int, id int")
    out = convert.conform(rows, T)
    assert out.schema == T.schema
    assert [tuple(r) for r in out.collect()] == [(1, 255, True, Decimal("12.5000")), (2, None, None, None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_value_that_does_not_fit_stops_the_load_in_any_mode(spark, ansi):
    rows = spark.createDataFrame([(1, 1, 1, "12.5"), (2, 1, 1, "x")], "id int, tiny int, flag int, amount string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="amount: value does not fit"):
            convert.conform(rows, T).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert values(convert.conform(rows, T, tolerant=True), "amount") == [Decimal("12.5000"), None]
    rejected = {r["column_name"]: r["rejected"] for r in convert.rejected_values(rows, T).collect()}
    assert rejected == {"id": 0, "flag": 0, "amount": 1}


def test_times_of_day_have_one_text(spark):
    given = ["12:34:56.1200000", "12:34:50.0000000", "10:00:00", "10:00:00.5", None]
    wanted = Contract.declare("t", {"at": "time(7)"})
    found = convert.conform(spark.createDataFrame([(v,) for v in given], "at string"), wanted)
    assert values(found, "at") == ["12:34:56.12", "12:34:50", "10:00:00", "10:00:00.5", None]


def test_missing_numbers_become_null(spark):
    rows = spark.createDataFrame([(1, float("nan"), float("nan"))], "id int, amount double, ratio double")
    wanted = Contract.declare("t", {"id": "bigint", "amount": "money", "ratio": "float"})
    row = convert.conform(rows, wanted).first()
    assert row["amount"] is None
    assert row["ratio"] != row["ratio"]


def test_conform_refuses_other_columns(spark):
    wrong = r"missing columns \['tiny', 'flag', 'amount'\], unexpected columns \['x'\]"
    with pytest.raises(convert.ShapeMismatch, match=wrong):
        convert.conform(spark.createDataFrame([(1, 2)], "id int, x int"), T)


def test_export_form(spark):
    nan = float("nan")
    rows = spark.createDataFrame(
        [(nan, 1.5, True, Decimal("0.1"), dt.datetime(2024, 2, 29, 1, 2, 3, 999999), bytearray(b""))],
        "a double, b float, c boolean, d decimal(19,4), e timestamp_ntz, f binary",
    )
    native = convert.export_form(rows).first()
    assert native["a"] is None
    assert (native["b"], native["c"], native["d"]) == (1.5, True, Decimal("0.1000"))
    assert (native["e"], bytes(native["f"])) == (dt.datetime(2024, 2, 29, 1, 2, 3, 999999), b"")
    text = convert.export_form(rows, timestamps_as_text=True, booleans_as_bits=True, decimals_as_double=True).first()
    assert (text["c"], text["d"], text["e"]) == (1, 0.1, "2024-02-29 01:02:03.999")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamp_text_is_cut_and_ignores_the_zone(spark, zone):
    moments = [
        (dt.datetime(2024, 3, 10, 2, 30), "2024-03-10 02:30:00.000"),
        (dt.datetime(2024, 3, 10, 2, 30, 0, 1), "2024-03-10 02:30:00.000"),
        (dt.datetime(2024, 3, 10, 2, 30, 0, 120000), "2024-03-10 02:30:00.120"),
        (dt.datetime(1969, 12, 31, 23, 59, 59, 999999), "1969-12-31 23:59:59.999"),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(m,) for m, _ in moments], "at timestamp_ntz")
        assert values(rows.select(convert.timestamp_ms_text(F.col("at")).alias("t")), "t") == [t for _, t in moments]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_exact_decimal(spark):
    rows = spark.createDataFrame([("0.00005",), ("-1.23455",), ("NaN",), ("",), (None,), ("1e3",)], "v string")
    found = values(rows.select(convert.exact_decimal(F.col("v"), 19, 4).alias("d")), "d")
    assert found == [Decimal("0.0001"), Decimal("-1.2346"), None, None, None, Decimal("1000.0000")]
    nan = spark.createDataFrame([(float("nan"),), (float("inf"),)], "v double")
    assert values(nan.select(convert.exact_decimal(F.col("v"), 19, 4).alias("d")), "d") == [None, None]


def test_amounts_are_rounded_once_per_step(spark):
    given = [(3, Decimal("33.3333"), Decimal("12.34"), Decimal("0.0825"))]
    one = spark.createDataFrame(given, "q int, p decimal(19,4), d decimal(5,2), t decimal(5,4)")
    subtotal, tax, total = derive.order_amounts(F.col("q"), F.col("p"), F.col("d"), F.col("t"))
    row = one.select(subtotal.alias("s"), tax.alias("t"), total.alias("o")).first()
    exact = Decimal(3) * Decimal("33.3333") * (1 - Decimal("0.1234"))
    assert row["s"] == exact.quantize(Decimal("0.0001"), "ROUND_HALF_UP")
    assert row["t"] == (row["s"] * Decimal("0.0825")).quantize(Decimal("0.0001"), "ROUND_HALF_UP")
    assert row["o"] == row["s"] + row["t"]


def test_seed_totals(spark):
    orders = sales_data.tables(spark)["transactions"]
    row = orders.agg(
        F.sum(F.col("total_amount") - F.col("tax_amount")).alias("subtotal"),
        F.sum("tax_amount").alias("tax"),
        F.sum("total_amount").alias("total"),
    ).first()
    assert tuple(row) == (Decimal("28054500.0000"), Decimal("2314496.2500"), Decimal("30368996.2500"))


def test_codes_keep_the_last_digits(spark):
    rows = spark.createDataFrame([(7,), (12345,), (123456,), (None,)], "n bigint")
    codes = rows.select(derive.padded_code("C", F.col("n"), 5).alias("c"))
    assert values(codes, "c") == ["C00007", "C12345", "C23456", None]


def test_small_derivations(spark):
    row = spark.range(1).select(
        derive.text_concat(F.lit("a"), F.lit(None), F.lit(1)).alias("text"),
        derive.days_before(F.lit("2000-03-01"), F.lit(1)).alias("day"),
        derive.minutes_before(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"), F.lit(1)).alias("moment"),
        derive.available_stock(F.lit(5), F.lit(None).cast("int")).alias("free"),
        derive.below_reorder(F.lit(5), F.lit(None).cast("int")).alias("low"),
        derive.sparse(F.lit(False), F.lit("x")).alias("none"),
        derive.with_default(F.lit(None).cast("string"), F.lit("USD")).alias("currency"),
    ).first()
    assert tuple(row) == ("a1", dt.date(2000, 2, 29), dt.datetime(2023, 12, 31, 23, 59), 5, False, None, "USD")


LOSSY = [
    ("decimal(19,6)", "1.234560", "decimal(19,4)", True),
    ("decimal(19,6)", "1.230000", "decimal(19,4)", False),
    ("string", "1.23456", "decimal(19,4)", True),
    ("string", "1.23450000", "decimal(19,4)", False),
    ("double", "1.7", "int", True),
    ("double", "5.1000000000000005", "decimal(5,1)", False),
    ("timestamp_ntz", "2024-01-01 13:45:00", "date", True),
    ("timestamp_ntz", "2024-01-01 00:00:00", "date", False),
    ("int", "16777217", "real", True),
    ("int", "16777216", "real", False),
    ("bigint", "9007199254740993", "float", True),
    ("int", "70000", "smallint", True),
    ("int", "-32768", "smallint", False),
    ("int", "300", "tinyint", True),
    ("int", "-1", "tinyint", True),
    ("int", "255", "tinyint", False),
]


@pytest.mark.parametrize(("source", "given", "declared", "lossy"), LOSSY)
def test_values_that_a_type_cannot_hold_are_refused_and_counted(spark, source, given, declared, lossy):
    rows = spark.range(2).select(F.when(F.col("id") == 0, F.lit(given).cast(source)).alias("x"))
    wanted = Contract.declare("t", {"x": declared})
    counted = convert.lossy_values(rows, wanted).collect()
    assert sum(r["changed"] + r["out_of_range"] for r in counted) == lossy
    kept = convert.conform(rows, wanted, tolerant=True).where("x IS NOT NULL").count()
    assert kept == (not lossy)
    if not lossy:
        assert convert.conform(rows, wanted).count() == 2
        return
    with pytest.raises(Exception, match="x: value does not fit"):
        convert.conform(rows, wanted).collect()


def test_rounding_is_allowed_by_column(spark):
    rows = spark.sql("SELECT 1.23456 AS a, 2.34567 AS b")
    wanted = Contract.declare("t", {"a": "decimal(19,4)", "b": "decimal(19,4)"})
    assert convert.conform(rows, wanted, rounding=["a", "b"]).first()["a"] == Decimal("1.2346")
    with pytest.raises(Exception, match="b: value does not fit"):
        convert.conform(rows, wanted, rounding=["a"]).collect()
