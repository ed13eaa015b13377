"""Silver: typed, standardised, rule-checked and de-duplicated feeds.

Each feed is described by a ``SourceSpec`` (key, label steps, defaults, types,
rules, lineage) and all six run through the same code path:

    bronze --prepare--> typed row + raw struct
        accepted side: filter(all drop rules pass) -> keep_first(key)   (Silver table)
        rejected side: filter(not all pass) -> failed-rule arrays
                       -> quarantine rows                              (no de-dup, S7)

Both sides test the same rules on the same typed row, so they always agree
(S6).  De-duplication runs *after* the drop rules by default, so a valid later
copy survives an invalid earlier one (S4); ``dedup_first=True`` restores the
reference order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels as L
from ..functions.casting import MONEY
from ..operators import dedup, quality
from ..operators.quality import DROP, WARN, Rule
from ..sources import schemas

QUARANTINE_SCHEMA = (
    "source_table string, reason string, failed_rules array<string>, record_key string, rejected_at timestamp, "
    "ingested_at timestamp, source_file string, payload string"
)

RAW = "_raw"
INVALID = "_invalid"

STR, INT, DATE, TS = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampType()


@dataclass(frozen=True)
class SourceSpec:
    name: str
    key: str | None
    columns: tuple[tuple[str, T.DataType], ...]
    derive: Callable[[], dict[str, Column]] = dict
    rules: tuple[Rule, ...] = ()
    lineage: tuple[str, ...] = (schemas.INGESTED_AT, schemas.SOURCE_FILE)
    fill: dict[str, str] = field(default_factory=dict)
    passthrough: tuple[str, ...] = ()

    @property
    def raw_columns(self) -> list[str]:
        return [f.name for f in schemas.BY_SOURCE[self.name].fields]

    @property
    def order(self) -> list[str]:
        return list(self.lineage)

    @property
    def origin_column(self) -> str:
        return self.lineage[1]


def _sales_derive() -> dict[str, Column]:
    return {
        "pay_method": L.remap(L.standardise("pay_method"), L.PAY_METHOD_MAP),
        "sale_date": F.col("sale_date").try_cast(DATE),
        "branch_id": L.default_if_null("branch_id", L.NO_BRANCH),
    }


def _returns_derive() -> dict[str, Column]:
    return {
        "reason": L.standardise("reason"),
        "return_date": F.col("return_date").try_cast(DATE),
        "order_id": L.default_if_null("order_id", L.NO_ORDER),
    }


def _products_derive() -> dict[str, Column]:
    return {
        "category": L.remap(L.standardise("category"), L.CATEGORY_MAP),
        "brand": L.default_if_null("brand", L.NO_BRAND),
    }


def _employees_derive() -> dict[str, Column]:
    return {
        "event_kind": L.standardise("event_kind"),
        "email": L.default_if_null("email", L.NO_EMAIL),
    }


def _tracking_derive() -> dict[str, Column]:
    return {
        "courier": L.standardise("courier", underscores=False),
        "delivery_state": L.remap(L.standardise("delivery_state"), L.DELIVERY_STATE_MAP),
    }


def _present(col: str) -> Rule:
    return Rule(f"{col}_present", f"{col} IS NOT NULL", DROP)


_VALID_STATES_SQL = ", ".join(f"'{s}'" for s in L.VALID_DELIVERY_STATES)

SALES = SourceSpec(
    name="sales",
    key="sale_id",
    columns=(
        ("sale_id", STR),
        ("branch_id", STR),
        ("product_id", STR),
        ("quantity", INT),
        ("amount", MONEY),
        ("pay_method", STR),
        ("sale_date", DATE),
        ("channel", STR),
    ),
    derive=_sales_derive,
    rules=(_present("sale_id"), Rule("amount_valid", "amount IS NOT NULL AND amount > 0")),
)

RETURNS = SourceSpec(
    name="returns",
    key="return_id",
    columns=(
        ("return_id", STR),
        ("order_id", STR),
        ("branch_id", STR),
        ("product_id", STR),
        ("reason", STR),
        ("refund", MONEY),
        ("return_date", DATE),
    ),
    derive=_returns_derive,
    rules=(_present("return_id"), Rule("refund_valid", "refund IS NOT NULL AND refund > 0")),
)

REVIEWS = SourceSpec(
    name="reviews",
    key="review_id",
    columns=(
        ("review_id", STR),
        ("product_id", STR),
        ("customer_id", STR),
        ("rating", INT),
        ("comment", STR),
        ("review_date", DATE),
    ),
    passthrough=("tags", "replies"),
    fill={"comment": L.NO_COMMENT},
    rules=(
        _present("review_id"),
        Rule("rating_valid", "rating BETWEEN 1 AND 5 AND rating IS NOT NULL"),
        Rule("review_date_present", "review_date IS NOT NULL", WARN),
    ),
)

PRODUCTS = SourceSpec(
    name="products",
    key="product_id",
    columns=(
        ("product_id", STR),
        ("product_name", STR),
        ("category", STR),
        ("brand", STR),
        ("list_price", MONEY),
    ),
    derive=_products_derive,
    rules=(_present("product_id"), Rule("list_price_valid", "list_price IS NOT NULL AND list_price > 0")),
)

EMPLOYEES = SourceSpec(
    name="employees",
    key=None,  # an event log: every event is kept, the history is keyed later
    columns=(
        ("employee_id", STR),
        ("full_name", STR),
        ("national_id", STR),
        ("email", STR),
        ("salary", MONEY),
        ("branch_id", STR),
        ("job_title", STR),
        ("event_kind", STR),
        ("event_at", TS),
    ),
    derive=_employees_derive,
    rules=(_present("employee_id"), _present("national_id"), _present("event_at")),
)

TRACKING = SourceSpec(
    name="tracking",
    key="tracking_id",
    columns=(
        ("tracking_id", STR),
        ("order_id", STR),
        ("courier", STR),
        ("delivery_state", STR),
        ("origin_branch", STR),  # a branch id like every other (S15), not a decimal
        ("updated_at_src", TS),
    ),
    derive=_tracking_derive,
    lineage=(schemas.INGESTED_AT, schemas.SOURCE_SYSTEM),
    rules=(
        _present("tracking_id"),
        Rule("delivery_state_valid", f"delivery_state IN ({_VALID_STATES_SQL})"),
        Rule("updated_at_present", "updated_at_src IS NOT NULL", WARN),
    ),
)

SPECS: dict[str, SourceSpec] = {s.name: s for s in (SALES, RETURNS, REVIEWS, PRODUCTS, EMPLOYEES, TRACKING)}


def prepare(spec: SourceSpec, bronze: DataFrame) -> DataFrame:
    """Standardise and type a Bronze frame; keep the raw row, lineage included,
    for the payload."""
    raw = F.struct(*[F.col(c) for c in (*spec.raw_columns, *spec.lineage)]).alias(RAW)
    derived = spec.derive()
    typed = []
    for name, dtype in spec.columns:
        expr = derived.get(name, F.col(name))
        if name in spec.fill:
            expr = F.coalesce(expr, F.lit(spec.fill[name]))
        typed.append(expr.try_cast(dtype).alias(name) if not isinstance(dtype, T.StringType) else expr.cast(dtype).alias(name))
    extra = [F.col(c) for c in spec.passthrough]
    lineage = [F.col(c) for c in spec.lineage]
    return bronze.select(*typed, *extra, *lineage, raw)


def classified(spec: SourceSpec, bronze: DataFrame) -> DataFrame:
    return quality.classify(prepare(spec, bronze), spec.rules)


def business_columns(spec: SourceSpec) -> list[str]:
    return [c for c, _ in spec.columns] + list(spec.passthrough) + list(spec.lineage)


def as_sent(spec: SourceSpec) -> set[str]:
    """Columns whose typed value is the raw text itself."""
    texts = {f.name for f in schemas.BY_SOURCE[spec.name].fields if isinstance(f.dataType, T.StringType)}
    typed = {c for c, t in spec.columns if isinstance(t, T.StringType)}
    return (texts & typed) - set(spec.derive()) - set(spec.fill)


def clean(
    spec: SourceSpec,
    bronze: DataFrame,
    *,
    dedup_first: bool = False,
    run_ts: dt.datetime | None = None,
    observation=None,
) -> DataFrame:
    """The Silver table of one feed.

    The accept side filters on the conjunction of the drop rules (each NULL
    verdict a failure) - the same verdict ``classify`` gives, without building
    the per-row failure arrays only the reject side needs.  ``observation``
    (a ``pyspark.sql.Observation``) receives the pass/fail counters of every
    rule over all input rows.
    """
    typed = prepare(spec, bronze).drop(RAW)
    if observation is not None:  # rule counters, filled by the action that writes
        typed = typed.observe(observation, *quality.counter_columns(spec.rules))
    valid = quality.valid_predicate(spec.rules)
    if spec.key is None:
        out = typed.filter(valid)
    elif dedup_first:
        kept = dedup.keep_first(typed.withColumn(INVALID, ~valid), [spec.key], spec.order)
        out = kept.filter(~F.col(INVALID)).drop(INVALID)
    else:
        out = dedup.keep_first(typed.filter(valid), [spec.key], spec.order)
    out = out.select(*business_columns(spec))
    if run_ts is not None:
        out = out.withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
    return out


def first_copies(spec: SourceSpec, bronze: DataFrame) -> DataFrame:
    """One row per key, preferring a copy that passes the drop rules.

    Used by tables derived from a feed without its rules (review replies,
    S14): they pick the same copy as the Silver table whenever a valid one
    exists.  Rows without a key are no copies of each other and have no place
    in such a table.
    """
    typed = prepare(spec, bronze.filter(F.col(spec.key).isNotNull())).drop(RAW).withColumn(INVALID, ~quality.valid_predicate(spec.rules))
    kept = dedup.keep_first(typed, [spec.key], [INVALID, *spec.order])
    return kept.select(*business_columns(spec))


def review_replies(bronze_reviews: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per reply, with its 0-based position; reviews without replies
    produce no row (``posexplode`` is not outer)."""
    reviews = first_copies(REVIEWS, bronze_reviews)
    out = reviews.select(
        "review_id",
        F.posexplode("replies").alias("reply_pos", "reply"),
        *REVIEWS.lineage,
    ).select(
        "review_id",
        F.col("reply_pos").cast("int").alias("reply_pos"),
        F.col("reply.author").alias("author"),
        F.col("reply.text").alias("text"),
        *REVIEWS.lineage,
    )
    if run_ts is not None:
        out = out.withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
    return out


def rejects(spec: SourceSpec, bronze: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Quarantine rows of one feed: every rejected Bronze row, one each.

    ``reason`` is the first failed rule, ``failed_rules`` all of them (S10);
    the payload is the raw row with NULL fields kept (S12).
    """
    bad = prepare(spec, bronze).filter(~quality.valid_predicate(spec.rules))
    return rejects_of(spec, quality.classify(bad, spec.rules), run_ts)


def rejects_of(spec: SourceSpec, classified_rows: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Quarantine rows from an already classified frame (raw struct kept)."""
    bad = quality.rejected(classified_rows)
    stamp = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.lit(None).cast("timestamp")
    key = F.col(f"{RAW}.{spec.key}") if spec.key else F.col(f"{RAW}.{spec.raw_columns[0]}")
    return bad.select(
        F.lit(spec.name).alias("source_table"),
        F.col(quality.FAILED)[0].alias("reason"),
        F.col(quality.FAILED).alias("failed_rules"),
        key.cast("string").alias("record_key"),
        stamp.alias("rejected_at"),
        F.col(spec.lineage[0]).alias("ingested_at"),
        F.col(spec.origin_column).alias("source_file"),
        F.to_json(F.col(RAW), {"ignoreNullFields": "false"}).alias("payload"),
    )


def rule_counters(spec: SourceSpec, bronze: DataFrame) -> DataFrame:
    """Pass/fail count of every rule of a feed, one row per rule (J6)."""
    prepared = prepare(spec, bronze).drop(RAW)
    agg = prepared.agg(*quality.counter_columns(spec.rules))
    stack = ", ".join(f"'{r.name}', '{r.policy}', `failed_{r.name}`" for r in spec.rules)
    return agg.selectExpr(
        f"'{spec.name}' AS source_table",
        "rows_in",
        f"stack({len(spec.rules)}, {stack}) AS (rule, policy, failed)",
    ).select("source_table", "rule", "policy", "rows_in", "failed", (F.col("rows_in") - F.col("failed")).alias("passed"))
