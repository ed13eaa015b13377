"""Personal-data tags and masked reads (J1, J2).

Columns are tagged in their Spark metadata (``{"pii": <kind>}``), which travels
with the schema into Parquet.  ``masked`` replaces every tagged column by a
fixed marker unless the reader is privileged; it is a projection, so it runs
inside whole-stage codegen and reads no extra data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import REDACTED

PII_TAGS: dict[str, str] = {"national_id": "dni", "email": "email", "salary": "salario"}


def tag_pii(df: DataFrame, tags: Mapping[str, str] = PII_TAGS) -> DataFrame:
    for name, kind in tags.items():
        if name in df.columns:
            df = df.withMetadata(name, {**df.schema[name].metadata, "pii": kind})
    return df


def pii_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "pii" in f.metadata]


def masked(df: DataFrame, privileged: bool) -> DataFrame:
    """Tagged columns as text for either reader, so the schema is one."""
    value = (lambda c: F.col(c).cast("string")) if privileged else (lambda c: F.lit(REDACTED))
    return df.withColumns({c: value(c) for c in pii_columns(df)})


def masked_by_function(df: DataFrame, name: str = "mask_pii") -> DataFrame:
    """The same, decided by the SQL function ``name`` when the rows are read."""
    return df.withColumns({c: F.call_function(name, F.col(c).cast("string")) for c in pii_columns(df)})


def register_mask_function(spark: SparkSession, privileged_users: Iterable[str] = (), name: str = "mask_pii") -> None:
    """SQL function ``mask_pii(value STRING)``: the value for listed users,
    the marker for everyone else."""
    users = ", ".join("'" + u.replace("'", "''") + "'" for u in privileged_users) or "NULL"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING "
        f"RETURN CASE WHEN current_user() IN ({users}) THEN value ELSE '{REDACTED}' END"
    )


def create_masked_view(
    spark: SparkSession, df: DataFrame, view: str, members: str, group: str, reader: str = "current_user()"
) -> None:
    """A temporary view of ``df`` whose tagged columns only the members of
    ``group`` see.  ``members`` names a table (member, group_name) that is read
    whenever the view is, so a grant or a revocation is a row there and needs no
    new view.  ``reader`` is the SQL expression for who reads."""
    df.createOrReplaceTempView(f"{view}__rows")
    name = group.replace("'", "''")
    allowed = f"(SELECT count(*) > 0 FROM {members} m WHERE m.member = {reader} AND m.group_name = '{name}')"
    hidden = set(pii_columns(df))
    columns = [f"CASE WHEN {allowed} THEN CAST(`{c}` AS STRING) ELSE '{REDACTED}' END AS `{c}`" if c in hidden else f"`{c}`" for c in df.columns]
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {', '.join(columns)} FROM {view}__rows")
