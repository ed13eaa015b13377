"""Tables as folders: what exists, and snapshot tables published by version.

A snapshot table is a folder of immutable versions ``v=<n>`` and small pointer
files ``_current/<n>``; the highest pointer names the version that readers
take.  A version is written completely before its pointer appears, so a crash
at any point leaves the last published table readable, and no step needs a
rename, which object stores do not have.  The last ``KEEP`` versions stay, so
a reader that planned against the one before can finish.

A patched table is a folder of runs: a compaction ``run=c<n>`` holds the table
as of step n, a patch ``run=r<n>`` what step n changed.  A run counts once its
pointer file ``_live/<run>`` is there, so one that was cut short is ignored.

An appended table is a folder of runs too: ``run=r<n>`` holds the rows of step
n, and a merge ``run=m<a>-<b>`` those of the steps a to b.  Of runs that hold
the same steps the widest counts.  ``merge_small`` merges ``FAN`` runs of a kind
at a time, so a row is rewritten once each time the number of steps grows by
``FAN``, and the files of a partition grow with the logarithm of the steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEEP = 2
#: Codec of the tables' Parquet files: a third smaller than Spark's default.
CODEC = "zstd"
FAN = 8


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries, one listing."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def data_files(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{n}" for n in sorted(_names(spark, path)) if not n.startswith(("_", "."))]


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of one partition column, from the folder listing (no data read)."""
    prefix = f"{column}="
    return sorted(n[len(prefix) :] for n in _names(spark, path) if n.startswith(prefix))


def _published(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in _names(spark, f"{path}/_current") if n.isdigit())


def live(spark: SparkSession, path: str) -> str:
    """The folder to read: a snapshot table's current version, else the path."""
    versions = _published(spark, path)
    return f"{path}/v={versions[-1]}" if versions else path


def readable(spark: SparkSession, path: str) -> bool:
    """The table exists and holds data (a stream that has only committed empty
    batches, or a publish that never finished, leaves a folder without)."""
    if _published(spark, path) or published_runs(spark, path):
        return True
    return any(not n.startswith(("_", ".", "v=")) for n in _names(spark, path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot table, an appended one, or plain files."""
    tags = [] if _published(spark, path) else appended_runs(published_runs(spark, path))
    if not tags:
        return spark.read.parquet(live(spark, path))
    return _rows_of(spark, path, tags)


def _rows_of(spark: SparkSession, path: str, tags: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*[f"{path}/run={t}" for t in tags]).drop("run")


def steps_of(tag: str) -> tuple[int, int]:
    """First and last step of a run of an appended table."""
    ends = [int(x) for x in tag[1:].split("-")]
    return ends[0], ends[-1]


def appended_runs(tags: Sequence[str]) -> list[str]:
    """The runs that make up an appended table, in order: those whose steps no
    wider one holds."""
    out: list[str] = []
    for tag in sorted(tags, key=lambda t: (steps_of(t)[0], -steps_of(t)[1])):
        if not out or steps_of(tag)[1] > steps_of(out[-1])[1]:
            out.append(tag)
    return out


def append_run(df: DataFrame, path: str, step: int, *partition_by: str) -> None:
    """Write the rows of a step (again, if it was written before); none, no run."""
    spark, tag = df.sparkSession, f"r{step:012d}"
    few = df.hint("rebalance", *partition_by) if partition_by else df
    write_run(few, path, tag, *partition_by)
    if run_rows(spark, path, tag, df.schema).isEmpty():  # asked of the files: the rows are made once
        remove_run(spark, path, tag)


def run_rows(spark: SparkSession, path: str, step: int | str, schema: T.StructType) -> DataFrame:
    """The rows of one step's own run; none, if it has no run."""
    tag = step if isinstance(step, str) else f"r{step:012d}"
    if tag not in published_runs(spark, path):
        return spark.createDataFrame([], schema)
    return read_runs(spark, path, [tag], schema).drop("run")


def small_runs(tags: Sequence[str]) -> list[str]:
    """The newest runs that are due to be merged: ``FAN`` or more of one kind,
    by how many steps they span."""
    live, kind = appended_runs(tags), FAN
    while kind <= FAN ** len(live):
        tail: list[str] = []
        for tag in reversed(live):
            first, last = steps_of(tag)
            if last - first + 1 >= kind:
                break
            tail.insert(0, tag)
        if len(tail) >= FAN:
            return tail
        kind *= FAN
    return []


def merge_small(spark: SparkSession, path: str, *partition_by: str) -> int:
    """Merge runs until none are due; returns how many merges were made.  Runs
    stay on disk until the merge that holds them is itself merged, for readers
    that have planned already."""
    done = 0
    while tags := small_runs(published_runs(spark, path)):
        name = f"m{steps_of(tags[0])[0]:012d}-{steps_of(tags[-1])[1]:012d}"
        write_run(_rows_of(spark, path, tags).hint("rebalance", *partition_by), path, name, *partition_by)
        done += 1
        for old in published_runs(spark, path):
            a, b = steps_of(old)
            if any(steps_of(m)[0] <= a and b <= steps_of(m)[1] for m in tags if m.startswith("m") and m != old):
                remove_run(spark, path, old)
    return done


def publish(df: DataFrame, path: str) -> None:
    """Make ``df`` the table's new version."""
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = _published(spark, path)
    version = 1 + max([0, *done, *(int(v) for v in partition_values(spark, path, "v") if v.isdigit())])
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    fs.create(Path(f"{path}/_current/{version}")).close()
    keep = {*done[-(KEEP - 1) :], version}
    for old in partition_values(spark, path, "v"):
        if old.isdigit() and int(old) not in keep:
            fs.delete(Path(f"{path}/_current/{old}"), False)
            fs.delete(Path(f"{path}/v={old}"), True)


def live_runs(tags: list[str]) -> list[str]:
    """Runs that make up the current table: the newest compaction (``c<step>``)
    and every step (``r<step>``) after it.  Steps folded into a compaction are
    never read again, so a crash between writing a compaction and anything
    after it cannot double-count."""
    compactions = [t for t in tags if t.startswith("c")]
    newest = max(compactions, key=lambda t: t[1:]) if compactions else None
    after = [t for t in tags if t.startswith("r") and (newest is None or t[1:] > newest[1:])]
    return ([newest] if newest else []) + sorted(after)


def published_runs(spark: SparkSession, path: str) -> list[str]:
    return sorted(_names(spark, f"{path}/_live"))


def read_runs(spark: SparkSession, path: str, tags: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of some runs (which may have none), with the column ``run``."""
    whole = T.StructType([*schema, T.StructField("run", T.StringType())])
    return spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/run={t}" for t in tags])


def write_run(df: DataFrame, path: str, tag: str, *partition_by: str) -> None:
    """A run's files, then its pointer."""
    spark = df.sparkSession
    fs, _ = _fs(spark, path)
    pointer = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_live/{tag}")
    fs.delete(pointer, False)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/run={tag}", compression=CODEC)
    fs.create(pointer).close()


def remove_run(spark: SparkSession, path: str, tag: str) -> None:
    """Its pointer first, then its files."""
    fs, _ = _fs(spark, path)
    for place in (f"{path}/_live/{tag}", f"{path}/run={tag}"):
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place), True)


def publish_run(df: DataFrame, path: str, tag: str, *partition_by: str) -> None:
    """Write a run; a compaction lets go of what the one before it has folded."""
    write_run(df, path, tag, *partition_by)
    spark = df.sparkSession
    compactions = [t for t in published_runs(spark, path) if t.startswith("c")]
    if tag.startswith("c") and len(compactions) >= KEEP:
        oldest = compactions[-KEEP]
        for old in published_runs(spark, path):
            if old[1:] < oldest[1:] or (old[1:] == oldest[1:] and old.startswith("r")):
                remove_run(spark, path, old)
