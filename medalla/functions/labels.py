"""Label standardisation: JVM-side column expressions only.

``standardise`` = optional ``_``-to-space, ``trim`` (spaces only, tabs stay),
``initcap`` (whitespace-split, rest lowered).  ``remap`` then replaces known
spellings with the canonical label and keeps every other value unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These literals must equal the reference's output labels.
# Keys are the spellings *after* standardisation (underscore -> space, trim,
# initcap).
# ---------------------------------------------------------------------------
PAY_METHOD_MAP: dict[str, str] = {
    "Efv": "Efectivo",
    "Tarjeta": "Tarjeta De Credito",
    "Tarjeta Credito": "Tarjeta De Credito",
    "Tc": "Tarjeta De Credito",
    "Transferencia": "Transferencia Bancaria",
}
CATEGORY_MAP: dict[str, str] = {
    "Climatización": "Climatizacion",
    "Electrónica": "Electronica",
    "Línea Blanca": "Linea Blanca",
}
# "Linea_Blanca" and "Tarjeta_Credito" are reached by the underscore step of
# ``standardise``: they become "Linea Blanca" (already canonical) and
# "Tarjeta Credito" (mapped above).
DELIVERY_STATE_MAP: dict[str, str] = {"En Camino": "En Transito"}
VALID_DELIVERY_STATES: tuple[str, ...] = ("En Transito", "Pendiente", "Entregado", "Devuelto")
NO_BRANCH = "Sin Sucursal"
NO_ORDER = "Sin Pedido"
NO_BRAND = "Sin Marca"
NO_EMAIL = "Sin Correo"
NO_COMMENT = "Sin Comentario"
REDACTED = "***REDACTADO***"
TERMINATION_EVENT = "Baja"
# ---------------------------------------------------------------------------


def standardise(c: Column | str, underscores: bool = True) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if underscores:
        col = F.translate(col, "_", " ")
    return F.initcap(F.trim(col))


def remap(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace mapped values; unmapped values (and NULL) pass through."""
    col = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return col
    items = iter(mapping.items())
    k, v = next(items)
    expr = F.when(col == F.lit(k), F.lit(v))
    for k, v in items:
        expr = expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(col)


def default_if_null(c: Column | str, value) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(value))
