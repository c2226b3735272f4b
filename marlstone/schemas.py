"""Table definitions: source columns, Silver types and the cleaning rules per table.

Everything that differs between tables is stated here as data; the code that
reads it (``plans.silver``, ``plans.pipeline``) is the same for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_INT, _STR, _TS = T.IntegerType(), T.StringType(), T.TimestampType()

# The shop database's columns, types and value domains.
SOURCE_SCHEMAS = {
    "users": _struct(id=_INT, email=_STR, name=_STR, password_hash=_STR, created_at=_TS, updated_at=_TS),
    "products": _struct(id=_INT, name=_STR, category=_STR, description=_STR, price=MONEY,
                        stock_qty=_INT, image_url=_STR, created_at=_TS),
    "orders": _struct(id=_INT, user_id=_INT, status=_STR, subtotal=MONEY, tax=MONEY, total=MONEY,
                      shipping_address=_STR, created_at=_TS, updated_at=_TS),
    "order_items": _struct(id=_INT, order_id=_INT, product_id=_INT, quantity=_INT,
                           unit_price=MONEY, created_at=_TS),
    "payments": _struct(id=_INT, order_id=_INT, amount=MONEY, method=_STR, status=_STR,
                        transaction_ref=_STR, created_at=_TS),
    "page_views": _struct(id=_INT, user_id=_INT, session_id=_STR, path=_STR, referrer=_STR,
                          duration_ms=_INT, created_at=_TS),
}
ORDER_STATUSES = ("confirmed", "shipped", "delivered", "cancelled")
PAYMENT_STATUSES = ("completed", "failed", "pending", "refunded")
PAYMENT_METHODS = ("card", "paypal", "upi")
# End of fixed values.


#: Directory level of tables dealt by a hash of their key; not a column of the table.
BUCKET = "key_bucket"


@dataclass(frozen=True)
class TableSpec:
    """How one source table becomes a Silver table."""

    name: str
    source: str
    lower: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    #: columns whose blanks become NULL; ``None`` means every string column
    blank_null: tuple[str, ...] | None = ()
    drop: tuple[str, ...] = ()
    keys: tuple[str, ...] = ("id",)
    #: newest first; remaining columns break ties so the choice is reproducible
    newest_by: tuple[str, ...] = ("created_at",)
    #: date columns of the Silver table; the directories are the first of them, see ``LakeConfig.directories``
    partition_by: tuple[str, ...] = ("year", "month", "day")
    #: for a table without dates: number of buckets, by a hash of the key, it is dealt into
    buckets: int = 0

    @property
    def bronze_columns(self) -> list[str]:
        return SOURCE_SCHEMAS[self.source].fieldNames()

    def silver_schema(self, wide_keys: bool = False) -> T.StructType:
        """Silver columns in order. ``wide_keys`` makes every id column 64 bits,
        for sources whose keys have outgrown the original 32."""
        fields = []
        for field in SOURCE_SCHEMAS[self.source].fields:
            if field.name in self.drop:
                continue
            is_id = field.name == "id" or field.name.endswith("_id")
            wide = wide_keys and is_id and field.dataType == _INT
            fields.append(T.StructField(field.name, T.LongType() if wide else field.dataType))
        return T.StructType(fields)


TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("customers", "users", lower=("email",), trim=("email", "name"), blank_null=None,
                  drop=("password_hash",), newest_by=("updated_at",), partition_by=("year", "month")),
        TableSpec("orders", "orders", lower=("status",), trim=("status", "shipping_address"),
                  blank_null=("shipping_address",), newest_by=("updated_at", "created_at")),
        TableSpec("payments", "payments", lower=("status", "method"),
                  trim=("status", "method", "transaction_ref"), blank_null=("transaction_ref",)),
        TableSpec("products", "products", trim=("name", "category", "description"),
                  blank_null=("description",), drop=("image_url",), partition_by=(), buckets=16),
        TableSpec("order_items", "order_items"),
        TableSpec("page_views", "page_views", trim=("session_id", "path", "referrer"),
                  blank_null=("referrer",)),
    )
}

#: child table, its column, parent table: references the lake has to check for itself
FOREIGN_KEYS = (
    ("orders", "user_id", "customers"),
    ("payments", "order_id", "orders"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("page_views", "user_id", "customers"),
)
