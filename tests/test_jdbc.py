"""What is sent to a database; no database runs here."""

import pytest

from roundhaul.contracts import Contract, sales
from roundhaul.plans.targets import JdbcTarget
from roundhaul.sources import jdbc


def test_create_table_statement():
    text = jdbc.create_table_sql("sales", "order_details_backload", sales.ORDER_DETAILS)
    assert text.splitlines()[0] == "DROP TABLE IF EXISTS [sales].[order_details_backload];"
    assert "[order_detail_id] BIGINT NOT NULL" in text
    assert "[line_item_number] SMALLINT NOT NULL" in text
    assert "[warranty_months] TINYINT NULL" in text
    assert "[gift_wrap] BIT NULL" in text
    assert "[extended_warranty_price] MONEY NULL" in text
    narrow = jdbc.create_table_sql("s", "t", sales.ORDER_DETAILS, wide_text=False)
    assert "[product_variant] VARCHAR(MAX) NULL" in narrow


def test_names_are_quoted():
    assert jdbc.quoted("a]b", "c") == "[a]]b].[c]"


def test_splits():
    expected = {"partitionColumn": "id", "lowerBound": 1, "upperBound": 100, "numPartitions": 4}
    assert jdbc.range_splits(1, 100, "id", 4) == expected
    assert jdbc.range_splits(5, 5, "id", 4)["upperBound"] == 6
    assert jdbc.hash_splits(["a", "b"], 2) == [
        "ABS(CAST(BINARY_CHECKSUM([a], [b]) AS BIGINT)) % 2 = 0",
        "ABS(CAST(BINARY_CHECKSUM([a], [b]) AS BIGINT)) % 2 = 1",
    ]


def test_contract_from_column_metadata(spark):
    listed = spark.createDataFrame(
        [
            ("sales", "t", "amount", "decimal", 12, 3, None, "YES", 2),
            ("sales", "t", "id", "bigint", 19, 0, None, "NO", 1),
            ("sales", "t", "at", "datetime2", None, None, 3, "YES", 3),
            ("sales", "t", "ratio", "float", 53, None, None, "YES", 4),
            ("sales", "other", "x", "int", 10, 0, None, "NO", 1),
        ],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, NUMERIC_PRECISION int, "
        "NUMERIC_SCALE int, DATETIME_PRECISION int, IS_NULLABLE string, ORDINAL_POSITION int",
    )
    metadata = jdbc.metadata_rows(listed, "sales", "t")
    assert metadata.columns == ["name", "type", "precision", "scale", "nullable", "position"]
    contract = jdbc.contract_from_metadata("t", metadata, key=["id"], partition_by=["at"])
    assert contract.names == ["id", "amount", "at", "ratio"]
    assert contract.schema.simpleString() == "struct<id:bigint,amount:decimal(12,3),at:timestamp_ntz,ratio:double>"
    assert contract.required == ["id"]
    assert contract.column("at").restored() == "DATETIME2(3)"
    assert contract.partitions[0].key == "at_day"


def test_times_and_unknown_types_are_read_as_text():
    contract = Contract.declare("t", {"id": "bigint", "at": "time(7)", "name": "varchar(9)", "place": "geography"})
    assert jdbc.read_as_text(contract) == {"customSchema": "`at` STRING, `place` STRING"}
    assert jdbc.read_as_text(sales.CUSTOMERS) == {}


NOWHERE = {"url": "jdbc:nowhere:x", "user": "u", "password": "p"}


def no_customers(spark):
    return spark.createDataFrame([], sales.CUSTOMERS.schema)


@pytest.mark.parametrize(
    "use",
    [
        lambda spark: jdbc.read_table(spark, NOWHERE, "sales", sales.CUSTOMERS, split_by="customer_id"),
        lambda spark: jdbc.read_table(spark, NOWHERE, "sales", sales.CUSTOMERS),
        lambda spark: jdbc.column_metadata(spark, NOWHERE, "sales", "customers"),
        lambda spark: JdbcTarget(spark, NOWHERE).read(sales.CUSTOMERS),
        lambda spark: JdbcTarget(spark, NOWHERE).write(no_customers(spark), sales.CUSTOMERS, True),
        lambda spark: JdbcTarget(spark, NOWHERE).write(no_customers(spark), sales.CUSTOMERS, False),
    ],
)
def test_every_call_gets_as_far_as_looking_for_the_driver(spark, use):
    with pytest.raises(Exception, match="No suitable driver"):
        use(spark)


def test_partitions_follow_the_rows():
    assert [jdbc.partitions_for(n) for n in (0, 1, 1_000_000, 1_000_001, 10**12)] == [1, 1, 1, 2, 10**6]
    assert jdbc.partitions_for(10**9, partition_rows=10**8) == 10


def test_contracts_of_a_whole_catalog(spark):
    listed = spark.createDataFrame(
        [("s", "b", "id", "bigint", 1), ("s", "a", "x`y", "geography", 2), ("s", "a", "n", "tinyint", 1), ("other", "c", "z", "int", 1)],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, ORDINAL_POSITION int",
    ).selectExpr(
        "*", "int(null) NUMERIC_PRECISION", "int(null) NUMERIC_SCALE", "int(null) DATETIME_PRECISION", "'NO' IS_NULLABLE"
    )
    found = jdbc.contracts_from_catalog(listed, "s")
    assert [(c.name, c.names) for c in found] == [("a", ["n", "x`y"]), ("b", ["id"])]
    assert jdbc.read_as_text(found[0]) == {"customSchema": "`x``y` STRING"}
    assert [c.name for c in jdbc.contracts_from_catalog(listed, "s", ["b"])] == ["b"]
    with pytest.raises(LookupError, match="missing"):
        jdbc.contracts_from_catalog(listed, "s", ["missing"])
