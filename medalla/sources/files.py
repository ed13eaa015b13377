"""File feeds: incremental (stream) and snapshot (batch) readers, and writers
that lay files out in a landing folder the way the upstream systems do.

Readers always pass an explicit schema (no inference) and stamp lineage:
``ingested_at`` (ingestion time) and ``source_file`` (the file's name from the
hidden ``_metadata`` column).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas, storage


@dataclass(frozen=True)
class FileFeed:
    source: str
    fmt: str  # "csv" | "json"
    options: tuple[tuple[str, str], ...]
    streaming: bool = True

    @property
    def schema(self) -> T.StructType:
        return schemas.BY_SOURCE[self.source]

    @property
    def source_schema(self) -> T.StructType:
        """The same fields under the names that the upstream system gives them."""
        return schemas.under_source_names(self.source)

    def renamed(self, df: DataFrame) -> DataFrame:
        """Own names for a frame read with ``source_schema``; file metadata stays."""
        names = schemas.SOURCE_NAMES[self.source]
        cols = [F.col(names[f.name]).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return df.select(*cols, F.col("_metadata"))


_CSV = (("header", "true"), ("sep", ","), ("mode", "PERMISSIVE"))

FEEDS: dict[str, FileFeed] = {
    "sales": FileFeed("sales", "csv", _CSV),
    "returns": FileFeed("returns", "csv", _CSV),
    "employees": FileFeed("employees", "csv", _CSV),
    "reviews": FileFeed("reviews", "json", (("multiLine", "true"), ("mode", "PERMISSIVE"))),
    "products": FileFeed("products", "json", (("mode", "PERMISSIVE"),), streaming=False),
}

#: Files are taken whatever their modification time: a backfill may be years old.
ANY_AGE = "36500d"

PRODUCT_CATALOG = "catalogo_productos"  # fixed value: lineage name of the product snapshot


def _stamp(df: DataFrame, source_file=None) -> DataFrame:
    return df.withColumns(
        {
            schemas.INGESTED_AT: F.current_timestamp(),
            schemas.SOURCE_FILE: source_file if source_file is not None else F.col("_metadata.file_name"),
        }
    ).drop("_metadata")


def read_stream(spark: SparkSession, feed: FileFeed, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Each file is read exactly once across runs (the checkpoint of the query
    that consumes this frame records which files were taken)."""
    reader = spark.readStream.schema(feed.source_schema).options(**dict(feed.options)).option("maxFileAge", ANY_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _stamp(feed.renamed(reader.format(feed.fmt).load(path)))


def read_snapshot(spark: SparkSession, feed: FileFeed, path: str, source_name: str | None = None) -> DataFrame:
    df = feed.renamed(spark.read.schema(feed.source_schema).options(**dict(feed.options)).format(feed.fmt).load(path))
    return _stamp(df, F.lit(source_name) if source_name else None)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_snapshot(spark, FEEDS["products"], path, PRODUCT_CATALOG)


# --------------------------------------------------------------------- writers
def write_csv(df: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """CSV the way the branch systems send it: header, comma, spaces kept.  A
    compressed file is read by one task; there is one for each task of ``df``.
    Gzip at its fastest: a fifth larger than by default, in half the time."""
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("compression", compression)
        .option("zlib.compress.level", "BEST_SPEED")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def write_named_csv(df: DataFrame, path: str, name: Column, rows_per_file: int = 250_000) -> None:
    """CSV files under names of their own: rows with the same ``name`` go into
    files ``<name>.csv``, of about ``rows_per_file`` rows at most.  If one is
    enough for every name they lie in ``path`` itself, else in the folders
    ``part=<n>`` below, one for each file of a name: no task writes more than its
    files' rows.  Files are written aside, where no reader looks, and moved;
    their number is that of the names and of the rows."""
    spark = df.sparkSession
    aside = f"{path}/_{uuid.uuid4().hex}"
    named = df.withColumn("__name", name)
    most, n_names = named.groupBy("__name").count().agg(F.coalesce(F.max("count"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-most // rows_per_file))
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    dealt = named.withColumn("__part", part)
    dealt = dealt.repartition(max(1, n_names * parts), "__part", "__name")
    dealt.write.partitionBy("__part", "__name").option("header", "true").csv(aside)
    for number in storage.partition_values(spark, aside, "__part"):
        folder = path if parts == 1 else f"{path}/part={number}"
        if parts > 1:
            storage.make_folder(spark, folder)
        for value in storage.partition_values(spark, f"{aside}/__part={number}", "__name"):
            for i, file in enumerate(storage.data_files(spark, f"{aside}/__part={number}/__name={value}")):
                storage.move(spark, file, f"{folder}/{value}{f'-{i}' if i else ''}.csv")


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 5000, mode: str = "append") -> None:
    """Multi-line JSON: each output file holds one JSON array of records.

    Rows are spread by a hash of the whole row over ``ceil(rows / rows_per_file)``
    groups, so every array (one file) stays near ``rows_per_file`` records
    whatever the key distribution; the number of files grows with the data.
    """
    files = max(1, -(-df.count() // rows_per_file))
    # the row id keeps identical copies apart too
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.monotonically_increasing_id()), F.lit(files))
    arrays = (
        df.withColumn("__b", bucket)
        .groupBy("__b")
        .agg(F.to_json(F.collect_list(F.struct(*df.columns)), {"ignoreNullFields": "false"}).alias("value"))
    )
    # one directory (hence one file) per array: a multi-line JSON file must
    # hold exactly one document
    arrays.select("__b", "value").write.mode(mode).partitionBy("__b").text(path)
