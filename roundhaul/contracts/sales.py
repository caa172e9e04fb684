"""The five sales tables and the layout they are migrated to."""

from __future__ import annotations

from roundhaul.contracts.table import Contract, ForeignKey

# Column names, declared types, keys, constraints and partition columns of
# the source database.
CUSTOMERS = Contract.declare(
    "customers",
    {
        "customer_id": "bigint not null",
        "customer_code": "nvarchar(20) not null",
        "first_name": "nvarchar(100) not null",
        "last_name": "nvarchar(100) not null",
        "email": "varchar(255) not null",
        "phone": "varchar(20)",
        "birth_date": "date",
        "registration_date": "datetime2(7) not null",
        "last_login_date": "datetime2(3)",
        "credit_score": "float",
        "credit_limit": "decimal(19,4)",
        "is_active": "bit not null",
        "customer_segment": "nvarchar(50)",
        "notes": "nvarchar(max)",
        "profile_image": "varbinary(max)",
        "metadata_json": "nvarchar(max)",
    },
    key=["customer_id"],
    unique=[["customer_code"]],
)

PRODUCTS = Contract.declare(
    "products",
    {
        "product_id": "bigint not null",
        "sku": "varchar(50) not null",
        "product_name": "nvarchar(255) not null",
        "category": "nvarchar(100) not null",
        "subcategory": "nvarchar(100)",
        "unit_price": "money not null",
        "cost": "decimal(19,4) not null",
        "weight_kg": "float",
        "dimensions_length_cm": "decimal(10,2)",
        "dimensions_width_cm": "decimal(10,2)",
        "dimensions_height_cm": "decimal(10,2)",
        "is_available": "bit not null",
        "discontinued": "bit",
        "created_date": "datetime2(7)",
        "modified_date": "datetime2(7)",
        "supplier_id": "int",
        "reorder_level": "int",
        "quantity_per_unit": "smallint",
        "product_image": "varbinary(max)",
    },
    key=["product_id"],
    unique=[["sku"]],
    partition_by=["category"],
)

TRANSACTIONS = Contract.declare(
    "transactions",
    {
        "transaction_id": "bigint not null",
        "transaction_date": "datetime2(7) not null",
        "customer_id": "bigint not null",
        "product_id": "bigint not null",
        "quantity": "int not null",
        "unit_price": "decimal(19,4) not null",
        "discount_percent": "decimal(5,2)",
        "tax_rate": "decimal(5,4) not null",
        "tax_amount": "decimal(19,4) not null",
        "total_amount": "decimal(19,4) not null",
        "payment_method": "nvarchar(50)",
        "currency_code": "char(3)",
        "exchange_rate": "decimal(10,6)",
        "order_status": "nvarchar(20) not null",
        "shipped_date": "datetime2(3)",
        "delivered_date": "date",
        "warehouse_id": "smallint",
        "sales_rep_id": "int",
        "commission_rate": "decimal(5,4)",
        "notes": "nvarchar(max)",
        "created_timestamp": "datetime2(7)",
        "modified_timestamp": "datetime2(7)",
    },
    key=["transaction_id"],
    foreign_keys=[
        ForeignKey(("customer_id",), "customers", ("customer_id",)),
        ForeignKey(("product_id",), "products", ("product_id",)),
    ],
    partition_by=["transaction_date"],
)

ORDER_DETAILS = Contract.declare(
    "order_details",
    {
        "order_detail_id": "bigint not null",
        "transaction_id": "bigint not null",
        "line_item_number": "smallint not null",
        "product_variant": "varchar(100)",
        "special_instructions": "nvarchar(500)",
        "gift_wrap": "bit",
        "gift_message": "nvarchar(500)",
        "warranty_months": "tinyint",
        "extended_warranty_price": "money",
    },
    key=["order_detail_id"],
    unique=[["transaction_id", "line_item_number"]],
    foreign_keys=[ForeignKey(("transaction_id",), "transactions", ("transaction_id",))],
)

INVENTORY_SNAPSHOTS = Contract.declare(
    "inventory_snapshots",
    {
        "snapshot_id": "bigint not null",
        "snapshot_date": "date not null",
        "product_id": "bigint not null",
        "warehouse_id": "smallint not null",
        "quantity_on_hand": "int not null",
        "quantity_reserved": "int",
        "quantity_available": "int",
        "reorder_point": "int",
        "reorder_quantity": "int",
        "last_counted_date": "datetime2(0)",
        "adjustment_reason": "nvarchar(200)",
    },
    key=["snapshot_id"],
    foreign_keys=[ForeignKey(("product_id",), "products", ("product_id",))],
    partition_by=["snapshot_date", "warehouse_id"],
)

SALES = (CUSTOMERS, PRODUCTS, TRANSACTIONS, ORDER_DETAILS, INVENTORY_SNAPSHOTS)
