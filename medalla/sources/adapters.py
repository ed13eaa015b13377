"""Source-shaped Bronze rows derived from the shared test tables.

The retail feeds are not part of the shared test data, so each feed is derived
from a test table with row-local expressions (no shuffle, no grouping): the
work grows with the tables.  Every mis-typed value, NULL and label spelling
the pipeline must handle is planted by a rule on the row's own ids.  The same
derivations are written in SQL in ``__spark_entry__.oracle_sql`` so DuckDB can
recompute every result independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas
from .jdbc import TRACKING_SYSTEM


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(prefix: str, c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), col.cast("string"))


def _money_text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(T.DecimalType(12, 2)).cast("string")


def _date_text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("date").cast("string")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None).cast("string")).otherwise(value)


def _conform(df: DataFrame, source: str, lineage: list[str]) -> DataFrame:
    cols = [f.name for f in schemas.BY_SOURCE[source].fields]
    return df.select(*cols, *lineage)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pk = F.col("l_partkey")
    amount = (
        F.when(pk % 97 == 0, F.lit(None).cast("string"))
        .when(pk % 89 == 0, F.lit("-5.00"))
        .when(pk % 83 == 0, F.lit("abc"))
        .when(pk % 79 == 0, F.lit("0.004"))
        .otherwise(_money_text("l_extendedprice"))
    )
    ln = F.col("l_linenumber")
    pay = (
        F.when(ln == 1, F.lit(" EFV"))
        .when(ln == 2, F.lit("tarjeta"))
        .when(ln == 3, F.lit("TARJETA_CREDITO"))
        .when(ln == 4, F.lit("tc "))
        .when(ln == 5, F.lit("transferencia"))
        .otherwise(F.lit("efectivo"))
    )
    df = li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")).alias("sale_id"),
        _null_when(F.col("l_suppkey") % 25 == 0, _s("S", "l_suppkey")).alias("branch_id"),
        _s("P", "l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        amount.alias("amount"),
        pay.alias("pay_method"),
        F.when(pk % 101 == 0, F.lit("31/12/2024")).otherwise(_date_text("l_shipdate")).alias("sale_date"),
        F.when(F.col("l_linestatus") == "F", F.lit("tienda")).otherwise(F.lit("web")).alias("channel"),
        F.col("l_shipdate").alias("ingested_at"),
        F.concat(F.lit("sales-"), _date_text("l_shipdate"), F.lit(".csv")).alias("source_file"),
    )
    return _conform(df, "sales", ["ingested_at", "source_file"])


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    pk = F.col("l_partkey")
    m = F.col("l_linenumber") % 4
    reason = (
        F.when(m == 0, F.lit("producto_defectuoso"))
        .when(m == 1, F.lit(" NO_CUMPLE "))
        .when(m == 2, F.lit("arrepentimiento"))
        .otherwise(F.lit("Otro"))
    )
    refund = (
        F.when(pk % 97 == 0, F.lit("0"))
        .when(pk % 89 == 0, F.lit(None).cast("string"))
        .otherwise(_money_text("l_extendedprice"))
    )
    df = li.select(
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "return_id"
        ),
        _null_when(F.col("l_orderkey") % 53 == 0, F.col("l_orderkey").cast("string")).alias("order_id"),
        _s("S", "l_suppkey").alias("branch_id"),
        _s("P", "l_partkey").alias("product_id"),
        reason.alias("reason"),
        refund.alias("refund"),
        _date_text("l_shipdate").alias("return_date"),
        F.col("l_shipdate").alias("ingested_at"),
        F.lit("returns.csv").alias("source_file"),
    )
    return _conform(df, "returns", ["ingested_at", "source_file"])


# Test-table part types -> raw category spellings.
_CATEGORY_BY_TYPE = {
    "ECONOMY": "Climatización",
    "STANDARD": " ELECTRÓNICA",
    "SMALL": "LINEA_BLANCA",
    "LARGE": "línea blanca",
    "PROMO": "muebles",
    "MEDIUM": "Electronica",
}

CATALOG_LOADED_AT = "2024-01-01 00:00:00"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    cat = None
    for k, v in _CATEGORY_BY_TYPE.items():
        cat = (F.when if cat is None else cat.when)(F.col("p_type") == k, F.lit(v))
    price = (
        F.when(pk % 41 == 0, F.lit("0")).when(pk % 43 == 0, F.lit("n/a")).otherwise(_money_text("p_retailprice"))
    )
    df = part.select(
        _s("P", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        cat.alias("category"),
        _null_when(pk % 50 == 0, F.col("p_brand")).alias("brand"),
        price.alias("list_price"),
        F.lit(CATALOG_LOADED_AT).cast("timestamp_ntz").alias("ingested_at"),
        F.lit("catalogo_productos").alias("source_file"),
    )
    return _conform(df, "products", ["ingested_at", "source_file"])


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    df = ev.select(
        _s("V", eid).alias("review_id"),
        _s("P", (eid * 7919) % 2000).alias("product_id"),
        _s("C", "user_id").alias("customer_id"),
        (k % 7).alias("rating"),
        _null_when(eid % 10 == 0, F.col("event_type")).alias("comment"),
        F.array(F.col("event_type")).alias("tags"),
        F.lit(None).cast(T.ArrayType(schemas.REPLY)).alias("replies"),
        _null_when(eid % 61 == 0, _date_text("ts")).alias("review_date"),
        F.col("ts").alias("ingested_at"),
        F.concat(F.lit("reviews-"), _date_text("ts"), F.lit(".json")).alias("source_file"),
    )
    return _conform(df, "reviews", ["ingested_at", "source_file"])


def threaded_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews whose replies are the lines of one conversation turn.

    Each (conv_id, turn) row is one review; its text split on newlines gives
    the reply array (author = the turn's role).  Row-local: no grouping, so
    no conversation, however long, is ever gathered into one task.
    """
    conv = table(spark, sf_dir, "conversations")
    lines = F.split(F.col("text"), "\n")
    replies = F.transform(lines, lambda line: F.struct(F.col("role").alias("author"), line.alias("text")))
    df = conv.select(
        F.concat(F.lit("V"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("review_id"),
        _s("P", F.col("conv_id") % 2000).alias("product_id"),
        F.lit(None).cast("string").alias("customer_id"),
        F.lit(5).alias("rating"),
        F.lit(None).cast("string").alias("comment"),
        F.array(F.col("role")).alias("tags"),
        replies.cast(T.ArrayType(schemas.REPLY)).alias("replies"),
        F.lit(None).cast("string").alias("review_date"),
        F.lit(CATALOG_LOADED_AT).cast("timestamp_ntz").alias("ingested_at"),
        F.concat(F.lit("conversations-"), F.col("conv_id").cast("string"), F.lit(".json")).alias("source_file"),
    )
    return _conform(df, "reviews", ["ingested_at", "source_file"])


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    et = F.col("event_type")
    kind = (
        F.when(et == "signup", F.lit("alta"))
        .when(et == "error", F.lit(" BAJA "))
        .when(et == "purchase", F.lit("CAMBIO_SALARIO"))
        .when(et == "click", F.lit("cambio_cargo"))
        .when(et == "view", F.lit("traslado"))
    )
    df = ev.select(
        _s("E", uid).alias("employee_id"),
        _s("Name ", uid).alias("full_name"),
        _null_when(eid % 89 == 0, _s("D", uid)).alias("national_id"),
        _null_when(uid % 6 == 0, F.concat(F.lit("e"), uid.cast("string"), F.lit("@x.test"))).alias("email"),
        _money_text(F.lit(1000) + F.col("value")).alias("salary"),
        _s("S", uid % 10).alias("branch_id"),
        F.lit("clerk").alias("job_title"),
        kind.alias("event_kind"),
        _null_when(eid % 83 == 0, F.col("ts").cast("string")).alias("event_at"),
        F.col("ts").alias("ingested_at"),
        F.lit("employees.csv").alias("source_file"),
    )
    return _conform(df, "employees", ["ingested_at", "source_file"])




def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    courier = F.when(ck % 3 == 0, F.lit(" dhl")).when(ck % 3 == 1, F.lit("FEDEX")).otherwise(F.lit("olva courier "))
    state = (
        F.when(ok % 71 == 0, F.lit(None).cast("string"))
        .when((pri == "4-NOT SPECIFIED") & (st == "P"), F.lit("perdido"))
        .when((pri == "5-LOW") & (st == "F"), F.lit("DEVUELTO"))
        .when(st == "F", F.lit("ENTREGADO "))
        .when(st == "O", F.lit("en_camino"))
        .otherwise(F.lit("Pendiente"))
    )
    df = o.select(
        _s("T", ok).alias("tracking_id"),
        ok.cast("string").alias("order_id"),
        courier.alias("courier"),
        state.alias("delivery_state"),
        _s("S", ck % 100).alias("origin_branch"),
        _null_when(ok % 59 == 0, F.col("o_orderdate").cast("string")).alias("updated_at_src"),
        F.col("o_orderdate").alias("ingested_at"),
        F.lit(TRACKING_SYSTEM).alias("source_system"),
    )
    return _conform(df, "tracking", ["ingested_at", "source_system"])


BY_SOURCE = {
    "sales": sales,
    "returns": returns,
    "products": products,
    "reviews": reviews,
    "employees": employees,
    "tracking": tracking,
}
