"""Explicit schemas of the six raw feeds.

Files are read with these schemas, never inferred; every field is nullable
and kept as text in Bronze (except the JSON review rating and nested arrays),
typing happens in Silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


SALES = T.StructType(
    _strings("sale_id", "branch_id", "product_id", "quantity", "amount", "pay_method", "sale_date", "channel")
)

RETURNS = T.StructType(
    _strings("return_id", "order_id", "branch_id", "product_id", "reason", "refund", "return_date")
)

EMPLOYEES = T.StructType(
    _strings(
        "employee_id",
        "full_name",
        "national_id",
        "email",
        "salary",
        "branch_id",
        "job_title",
        "event_kind",
        "event_at",
    )
)

REPLY = T.StructType(_strings("author", "text"))

REVIEWS = T.StructType(
    _strings("review_id", "product_id", "customer_id")
    + [
        T.StructField("rating", T.IntegerType(), True),
        T.StructField("comment", T.StringType(), True),
        T.StructField("tags", T.ArrayType(T.StringType()), True),
        T.StructField("replies", T.ArrayType(REPLY), True),
        T.StructField("review_date", T.StringType(), True),
    ]
)

PRODUCTS = T.StructType(_strings("product_id", "product_name", "category", "brand", "list_price"))

TRACKING = T.StructType(
    _strings("tracking_id", "order_id", "courier", "delivery_state", "origin_branch", "updated_at_src")
)

BY_SOURCE: dict[str, T.StructType] = {
    "sales": SALES,
    "returns": RETURNS,
    "employees": EMPLOYEES,
    "reviews": REVIEWS,
    "products": PRODUCTS,
    "tracking": TRACKING,
}

# The names that the upstream systems give the fields, by own name.
SOURCE_NAMES: dict[str, dict[str, str]] = {
    "sales": {
        "sale_id": "venta_id",
        "branch_id": "sucursal_id",
        "product_id": "producto_id",
        "quantity": "cantidad",
        "amount": "monto_total",
        "pay_method": "metodo_pago",
        "sale_date": "fecha_venta",
        "channel": "canal",
    },
    "returns": {
        "return_id": "devolucion_id",
        "order_id": "pedido_id",
        "branch_id": "sucursal_id",
        "product_id": "producto_id",
        "reason": "motivo",
        "refund": "monto_reembolso",
        "return_date": "fecha_devolucion",
    },
    "employees": {
        "employee_id": "id_empleado",
        "full_name": "nombre",
        "national_id": "dni",
        "email": "email",
        "salary": "salario",
        "branch_id": "sucursal_id",
        "job_title": "cargo",
        "event_kind": "tipo_evento",
        "event_at": "fecha_evento",
    },
    "reviews": {
        "review_id": "resena_id",
        "product_id": "producto_id",
        "customer_id": "cliente_id",
        "rating": "calificacion",
        "comment": "comentario",
        "tags": "tags",
        "replies": "respuestas",
        "review_date": "fecha_resena",
    },
    "products": {
        "product_id": "producto_id",
        "product_name": "nombre_producto",
        "category": "categoria",
        "brand": "marca",
        "list_price": "precio_lista",
    },
    "tracking": {
        "tracking_id": "tracking_id",
        "order_id": "pedido_id",
        "courier": "courier",
        "delivery_state": "estado_entrega",
        "origin_branch": "sucursal_origen",
        "updated_at_src": "fecha_actualizacion",
    },
}

# The same for the fields of a review's replies.
SOURCE_REPLY = T.ArrayType(T.StructType(_strings("autor", "texto")))

# Each feed's folder below the landing root.
SOURCE_FOLDERS = {
    "sales": "ventas",
    "returns": "devoluciones",
    "employees": "empleados",
    "reviews": "resenas",
    "products": "productos",
}


def under_source_names(source: str) -> T.StructType:
    """A feed's schema as its upstream system names the fields."""
    names = SOURCE_NAMES[source]
    kind = lambda f: SOURCE_REPLY if f.name == "replies" else f.dataType
    return T.StructType([T.StructField(names[f.name], kind(f), True) for f in BY_SOURCE[source].fields])


def to_source_names(df: DataFrame, source: str) -> DataFrame:
    """A frame with own names as the upstream system would send it."""
    target = under_source_names(source)
    return df.select(*[F.col(f.name).cast(t.dataType).alias(t.name) for f, t in zip(BY_SOURCE[source].fields, target.fields)])


# Lineage columns added at ingestion.
INGESTED_AT = "ingested_at"
SOURCE_FILE = "source_file"
SOURCE_SYSTEM = "source_system"
