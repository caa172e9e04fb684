import pytest
from pyspark.sql import types as T

from roundhaul.contracts import Contract, SqlType, restored_type, sales, sql_type_for
from tests.sales_data import ROWS

NTZ, TEXT, RAW = T.TimestampNTZType(), T.StringType(), T.BinaryType()


@pytest.mark.parametrize(
    ("declared", "stored", "restored"),
    [
        ("bit", T.BooleanType(), "BIT"),
        ("tinyint", T.IntegerType(), "TINYINT"),
        ("smallint", T.IntegerType(), "SMALLINT"),
        ("int", T.IntegerType(), "INT"),
        ("bigint", T.LongType(), "BIGINT"),
        ("float", T.DoubleType(), "FLOAT"),
        ("real", T.FloatType(), "REAL"),
        ("decimal(12,3)", T.DecimalType(12, 3), "DECIMAL(12,3)"),
        ("decimal(12,0)", T.DecimalType(12, 0), "DECIMAL(12,0)"),
        ("decimal", T.DecimalType(38, 18), "DECIMAL(38,18)"),
        ("NUMERIC(10,4)", T.DecimalType(10, 4), "SMALLMONEY"),
        ("decimal(19,4)", T.DecimalType(19, 4), "MONEY"),
        ("money", T.DecimalType(19, 4), "MONEY"),
        ("smallmoney", T.DecimalType(10, 4), "SMALLMONEY"),
        ("date", T.DateType(), "DATE"),
        ("time", TEXT, "TIME(7)"),
        ("time(6)", TEXT, "TIME"),
        ("time(7)", TEXT, "TIME(7)"),
        ("datetime", NTZ, "DATETIME2(3)"),
        ("datetime2", NTZ, "DATETIME2(7)"),
        ("datetime2(0)", NTZ, "DATETIME2(3)"),
        ("datetime2(3)", NTZ, "DATETIME2(3)"),
        ("datetime2(4)", NTZ, "DATETIME2(6)"),
        ("datetime2(6)", NTZ, "DATETIME2(6)"),
        ("datetime2(7)", NTZ, "DATETIME2(7)"),
        ("datetimeoffset", T.TimestampType(), "DATETIMEOFFSET"),
        ("char(3)", TEXT, "NVARCHAR(MAX)"),
        ("varchar(255)", TEXT, "NVARCHAR(MAX)"),
        ("nchar(3)", TEXT, "NVARCHAR(MAX)"),
        ("nvarchar(max)", TEXT, "NVARCHAR(MAX)"),
        ("text", TEXT, "NVARCHAR(MAX)"),
        ("ntext", TEXT, "NVARCHAR(MAX)"),
        ("binary(8)", RAW, "VARBINARY(MAX)"),
        ("varbinary(max)", RAW, "VARBINARY(MAX)"),
        ("image", RAW, "VARBINARY(MAX)"),
        ("uniqueidentifier", TEXT, "NVARCHAR(MAX)"),
        ("hierarchyid", TEXT, "NVARCHAR(MAX)"),
    ],
)
def test_type_map(declared, stored, restored):
    parsed = SqlType.parse(declared)
    assert parsed.stored() == stored
    assert restored_type(parsed) == restored


def test_unknown_type_is_reported(caplog):
    SqlType.parse("geography").stored()
    assert "geography" in caplog.text


def test_narrow_text_and_types_without_declaration():
    assert sql_type_for(TEXT, wide_text=False) == "VARCHAR(MAX)"
    assert sql_type_for(NTZ) == "DATETIME2(6)"
    assert sql_type_for(T.ShortType()) == "SMALLINT"
    assert sql_type_for(T.ArrayType(TEXT)) == "NVARCHAR(MAX)"


def test_bad_declaration():
    with pytest.raises(ValueError, match="not a type declaration"):
        SqlType.parse("decimal(19,4")


def test_sales_contracts():
    assert [c.name for c in sales.SALES] == list(ROWS)
    assert sum(len(c.columns) for c in sales.SALES) == 77
    keys = {c.name: [p.key for p in c.partitions] for c in sales.SALES}
    assert keys == {
        "customers": [],
        "products": ["category"],
        "transactions": ["transaction_date_day"],
        "order_details": [],
        "inventory_snapshots": ["snapshot_date_day", "warehouse_id"],
    }
    required = ["product_id", "sku", "product_name", "category", "unit_price", "cost", "is_available"]
    assert sales.PRODUCTS.required == required
    assert all(f.nullable for f in sales.PRODUCTS.schema.fields)


def test_shortened_timestamps():
    assert sales.CUSTOMERS.shortened == ["registration_date"]
    assert sales.INVENTORY_SNAPSHOTS.shortened == []
    declared = {"a": "datetime", "b": "datetime2", "c": "datetime2(6)", "d": "datetimeoffset", "e": "time(7)"}
    assert Contract.declare("t", declared).shortened == ["b", "d"]


def test_partition_columns_must_exist_and_not_clash():
    plain = Contract.declare("t", {"d": "date", "d_day": "int", "raw": "varbinary(8)"})
    with pytest.raises(ValueError, match="raw is binary"):
        plain.partitioned_by("raw")
    with pytest.raises(ValueError, match="no column x"):
        plain.partitioned_by("x")
    with pytest.raises(ValueError, match="already has a column"):
        plain.partitioned_by("d")
