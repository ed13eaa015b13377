"""External table over JDBC (tracking feed).

The reference reads the table in one task; here a partition column splits the
read into ``num_partitions`` parallel range queries: a numeric, date or
timestamp column by Spark's own bounds, a text column by ranges of its values
that hold about equally many rows, with a query of their own for NULLs.
Filters on the returned frame are pushed into the database's WHERE clause.
Every column is carried as text in Bronze, typing happens in Silver.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas

#: Parallel range queries, where a column to cut by is named.
DEFAULT_PARTITIONS = 8

#: Prefixes, and their length, by which a text column is cut at most.
MOST_PREFIXES, MOST_PREFIX_LENGTH = 5_000, 12

TRACKING_SYSTEM = "Azure SQL Database"  # fixed value: lineage name of the tracking system


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """The table, read in parallel range queries when ``partition_column`` (or
    the option ``partitionColumn``) names a column, as SQL spells it.  Bounds
    that aren't given are the column's minimum and maximum, which the database
    computes; a text column is cut by ``text_ranges``."""
    options = {k: v for k, v in (options or {}).items()}
    column = partition_column or options.pop("partitionColumn", None)
    low, high = lower_bound, upper_bound
    low = options.pop("lowerBound", None) if low is None else low
    high = options.pop("upperBound", None) if high is None else high
    parts = num_partitions or int(options.pop("numPartitions", DEFAULT_PARTITIONS))
    reader = spark.read.format("jdbc").options(**options).option("url", url)
    if not column:
        return reader.option("dbtable", table).load()
    if low is None or high is None:
        probe = reader.option("query", f"SELECT {column} AS k FROM {table} WHERE 1 = 0").load()
        if isinstance(probe.schema[0].dataType, T.StringType):
            ranges = text_ranges(spark, url, table, column, parts, options)
            return spark.read.jdbc(url, table, predicates=ranges, properties=dict(options))
        ends = spark.read.format("jdbc").options(**options).option("url", url)
        ends = ends.option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}").load().first()
        if ends[0] is None:  # an empty table, or no value to cut at
            return spark.read.format("jdbc").options(**options).option("url", url).option("dbtable", table).load()
        low, high = ends
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(parts))
        .load()
    )


def quoted(spark: SparkSession, url: str, name: str) -> str:
    """A column's name as the database's SQL spells it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(name)


def text_ranges(
    spark: SparkSession, url: str, table: str, column: str, parts: int, options: Mapping[str, str] | None = None
) -> list[str]:
    """Predicates that part a table by a text column: every row meets just one.

    The database counts its rows by the column's first characters, taking more
    of them until no prefix holds more than half a share (or there would be more
    than ``MOST_PREFIXES``), and lists the prefixes in its own order, by which the
    ranges are compared as well; so any collation gives disjoint ranges.
    """
    read = lambda sql: spark.read.format("jdbc").options(**(options or {})).option("url", url).option("query", sql).load()
    counts: list = []
    for length in range(1, MOST_PREFIX_LENGTH + 1):
        prefix = f"SUBSTR({column}, 1, {length})"
        grouped = f"SELECT {prefix} AS p, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {prefix}"
        size = read(f"SELECT COUNT(*) AS k FROM ({grouped}) g").first()[0]
        if counts and size > MOST_PREFIXES:
            break
        counts = [(r[0], r[1]) for r in read(grouped + f" ORDER BY {prefix}").collect()]  # MOST_PREFIXES rows at most
        total = sum(n for _, n in counts)
        if max((n for _, n in counts), default=0) * 2 * parts <= total:
            break
    cuts, held = [], 0
    for prefix, n in counts:
        if held * parts >= total * (len(cuts) + 1) and prefix:
            cuts.append(prefix)
        held += n
    text = ["'" + c.replace("'", "''") + "'" for c in cuts]
    ends = [None, *text, None]
    ranges = [
        " AND ".join([f"{column} >= {a}"] * (a is not None) + [f"{column} < {b}"] * (b is not None)) or f"{column} IS NOT NULL"
        for a, b in zip(ends, ends[1:])
    ]
    return [*ranges, f"{column} IS NULL"]


def tracking_bronze(raw: DataFrame, system: str = TRACKING_SYSTEM, ingested_at=None) -> DataFrame:
    """Bronze rows of a table whose columns have the upstream names."""
    names = schemas.SOURCE_NAMES["tracking"]
    cols = [F.col(names[f.name]).cast("string").alias(f.name) for f in schemas.TRACKING.fields]
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return raw.select(*cols, stamp.alias(schemas.INGESTED_AT), F.lit(system).alias(schemas.SOURCE_SYSTEM))


def write_table(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None, mode: str = "overwrite") -> None:
    """Write a table.  Spark sends a NULL text to Derby as a CLOB, which a column
    declared as another type refuses: such rows are inserted without the column."""
    options = dict(options or {})

    def save(rows: DataFrame, how: str) -> None:
        rows.write.format("jdbc").options(**options).option("url", url).option("dbtable", table).mode(how).save()

    declared = T.StructType.fromDDL(options["createTableColumnTypes"]).names if "createTableColumnTypes" in options else []
    texts = [c for c in declared if c in df.columns and isinstance(df.schema[c].dataType, T.StringType) and df.schema[c].nullable]
    if not texts or not url.startswith("jdbc:derby:") or len(texts) == len(df.columns):
        return save(df, mode)
    save(df.dropna(subset=texts), mode)
    for n in range(1, len(texts) + 1):
        for gone in itertools.combinations(texts, n):
            rows = df.dropna(subset=[c for c in texts if c not in gone]) if n < len(texts) else df
            for c in gone:
                rows = rows.filter(F.col(c).isNull())
            save(rows.drop(*gone), "append")
