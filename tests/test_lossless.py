"""Conversions lose nothing in silence: boundary values over pairs of types, and numbers in text by brute force."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roundhaul.contracts import Contract
from roundhaul.functions.convert import conform, lossy_values, plain_number, rejected_values

NAN, INF = float("nan"), float("inf")
D = Decimal
# Source type, declared type, values that the conversion keeps, values that it would change.
PAIRS = [
    ("double", "bigint", [0.0, -5.0, 1e12, 9007199254740992.0, -(2.0**63)], [1e12 + 0.5, 0.5, -1.25, 2.0**63, 1e19, INF]),
    ("double", "int", [2147483647.0, -2147483648.0], [2147483648.0, 2147483646.5, 1e-9]),
    ("double", "smallint", [32767.0], [32768.0, 0.1]),
    ("double", "decimal(19,4)", [5.1000000000000005, 0.1, 0.1 + 0.2, 12345.6789, 9e14], [0.00001, 1.00005, 1e15, 123456789012.34567]),
    ("double", "decimal(38,0)", [4e15, 1e22], [4e15 + 0.5, 0.5]),
    ("double", "real", [0.5, 16777216.0, NAN, INF], [0.1, 16777217.0, 1e300]),
    ("double", "bit", [0.0, 1.0], [1.5, 5.0, -1.0]),
    ("float", "decimal(19,4)", [0.5, 5.1], [0.00001]),
    ("float", "int", [16777216.0], [0.5]),
    ("bigint", "int", [2**31 - 1], [2**31]),
    ("bigint", "tinyint", [0, 255], [256, -1]),
    ("bigint", "float", [2**53, -(2**60)], [2**53 + 1, 2**63 - 1]),
    ("bigint", "real", [16777216], [16777217]),
    ("bigint", "decimal(5,2)", [999], [1000]),
    ("int", "bit", [0, 1], [5, -1]),
    ("decimal(38,10)", "decimal(19,4)", [D("1.5"), D("123456789012345.1234")], [D("1.00005"), D("1234567890123456")]),
    ("decimal(38,10)", "bigint", [D("7")], [D("7.5")]),
    ("decimal(38,10)", "float", [D("0.5"), D("7"), D("0.1000000001")], [D("12345678901234567.5")]),
    ("string", "bigint", ["7", " 7 ", "+7", "-0", "007"], ["7.5", "9223372036854775808", "x", ""]),
    ("string", "int", ["16777217"], ["1e400", "2147483648"]),
    (
        "string",
        "decimal(19,4)",
        ["1", "1.50", "1.5e3", "-1E-4", "0.00010", ".5", "5.", "0e9", "-0.0"],
        ["1.00000000000000000049", "1e-5", "1.00005", "1e15", "abc", "1e", "."],
    ),
    ("string", "decimal(38,0)", ["12345678901234567890123456789012345678", "1e37"], ["123456789012345678901234.7", "1e-1", "1e38"]),
    ("string", "decimal(38,30)", ["0.123456789012345678901234567890", "1e-30"], ["0.1234567890123456789012345678901", "1e-31"]),
    ("string", "real", ["0.1", "16777216", "1.5e3", "NaN", "-Infinity", "100"], ["16777217", "0.10000000149011612", "1e999", "x"]),
    ("string", "float", ["0.1", "16777217", "1e22", "inf", "0.30000000000000004", "-0"], ["9007199254740993", "0.1000000000000000055", "1e999"]),
    ("string", "date", ["2024-01-01", "2024-1-1", "2024-01-01 00:00:00"], ["2024-01-01 13:45:00", "2024-01-01T00:00:00.1", "2024-02-30", "x"]),
    (
        "string",
        "datetime2(6)",
        ["2024-01-01", "2024-01-01 13:45:00.123456", "2024-01-01T13:45:00.1234560"],
        ["2024-01-01 13:45:00.1234567", "2024-01-01 13:45:00+02:00", "2024-01-01 13:45:00Z", "13 o'clock"],
    ),
    ("string", "datetimeoffset", ["2024-01-01 13:45:00+02:00", "2024-01-01 13:45:00Z"], ["2024-01-01 13:45:00.0000001Z", "x"]),
    ("string", "bit", ["true", "0", "1", "false"], ["5", "x"]),
    ("timestamp_ntz", "date", [dt.datetime(2024, 1, 1)], [dt.datetime(2024, 1, 1, 0, 0, 0, 1)]),
    ("timestamp_ntz", "nvarchar(40)", [dt.datetime(2024, 1, 1, 1)], []),
    ("date", "datetime2(6)", [dt.date(2024, 2, 29)], []),
    ("boolean", "int", [True, False], []),
]


def frame(spark, kind, values):
    return spark.createDataFrame([(v,) for v in [*values, None]], f"v {kind}")


@pytest.mark.parametrize(("kind", "declared", "kept", "changed"), PAIRS, ids=[f"{p[0]}-{p[1]}" for p in PAIRS])
def test_pairs_of_types(spark, kind, declared, kept, changed):
    contract = Contract.declare("t", {"v": declared})
    good, bad = frame(spark, kind, kept), frame(spark, kind, changed)
    assert conform(good, contract).where("v IS NOT NULL").count() == len(kept)
    told = {r["column_name"]: r["changed"] + r["out_of_range"] for r in lossy_values(bad.unionAll(good), contract).collect()}
    assert told.get("v", 0) == len(changed)
    if kind != declared:
        assert sum(r["rejected"] for r in rejected_values(bad.unionAll(good), contract).collect()) == len(changed)
    assert conform(bad, contract, tolerant=True).where("v IS NOT NULL").count() == 0
    for value in changed:
        with pytest.raises(Exception, match="does not fit"):
            conform(frame(spark, kind, [value]), contract).collect()
    if changed and declared.startswith("decimal") and kind == "double":
        rounded = conform(frame(spark, kind, [v for v in changed if abs(v) < 10]), contract, rounding=["v"])
        assert rounded.where("v IS NULL").count() == 1


NUMBERS = st.from_regex(r"\A[+-]?(\d{1,25}\.?\d{0,25}|\.\d{1,25})([eE][+-]?\d{1,2})?\Z")


@settings(max_examples=3, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(texts=st.lists(NUMBERS, min_size=200, max_size=200))
def test_numbers_in_text(spark, texts):
    """Equal digits exactly where the numbers are equal."""
    rows = [(t, format(D(t), "f"), str(D(t) + D("1e-60"))) for t in texts if len(D(t).as_tuple().digits) < 60]
    found = spark.createDataFrame(rows, "a string, b string, c string").select(
        "a", *[plain_number(F.col(name)).alias(f"p{name}") for name in "abc"]
    )
    for r in found.collect():
        assert r["pa"] is not None and r["pa"] == r["pb"], r
        assert (r["pa"] == r["pc"]) == (D(r["a"]) == D(r["a"]) + D("1e-60"))


@pytest.mark.parametrize("text", ["", " ", ".", "e5", "1e", "--1", "1 2", "0x1", "1e9999", "½", "NaN"])
def test_text_without_a_number(spark, text):
    assert spark.createDataFrame([(text,)], "a string").select(plain_number(F.col("a"))).first()[0] is None
