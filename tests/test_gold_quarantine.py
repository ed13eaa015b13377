import json
from decimal import Decimal

from medalla.functions import labels as L
from medalla.plans import gold, governance, quarantine, silver


def test_products_without_sales_get_zeros(spark):
    products = spark.createDataFrame([("P1", "a", "c", "b"), ("P2", "x", "c", "b")], "product_id string, product_name string, category string, brand string")
    sales = spark.createDataFrame([("1", "P1", 2, Decimal("5.00"))], "sale_id string, product_id string, quantity int, amount decimal(12,2)")
    returns = spark.createDataFrame([], "return_id string, product_id string, refund decimal(12,2)")
    got = {r["product_id"]: r for r in gold.product_sales_returns(products, sales, returns).collect()}
    assert (got["P2"]["units_sold"], got["P2"]["sales_count"], float(got["P2"]["sales_amount"])) == (0, 0, 0.0)
    assert (got["P1"]["units_sold"], got["P1"]["returns_count"]) == (2, 0)


def test_orphan_sales_do_not_reach_product_table(spark):
    products = spark.createDataFrame([("P1", "a", "c", "b")], "product_id string, product_name string, category string, brand string")
    sales = spark.createDataFrame([("1", "P9", 2, Decimal("5.00"))], "sale_id string, product_id string, quantity int, amount decimal(12,2)")
    returns = spark.createDataFrame([], "return_id string, product_id string, refund decimal(12,2)")
    rows = gold.product_sales_returns(products, sales, returns).collect()
    assert [r["product_id"] for r in rows] == ["P1"] and rows[0]["units_sold"] == 0


def test_rate_and_mean_rounding_half_up(spark):
    reviews = spark.createDataFrame(
        [("r1", "P1", 1), ("r2", "P1", 2), ("r3", "P1", 5), ("r4", "P2", 4), ("r5", "P2", 3), ("r6", "P2", 3), ("r7", "P2", 3)],
        "review_id string, product_id string, rating int",
    )
    products = spark.createDataFrame([("P1", "A"), ("P2", "A")], "product_id string, category string")
    r = gold.negative_review_rate(reviews, products).first()
    assert (r["total_reviews"], r["negative_reviews"]) == (7, 2)
    assert r["avg_rating"] == 3.0 and r["negative_rate"] == 28.57


def test_quarantine_payload_keeps_nulls_and_names_first_rule(spark):
    emp = spark.createDataFrame(
        [("E1", "n", "D1", None, "1.00", "S1", "c", "alta", None, None, "f.csv")],
        "employee_id string, full_name string, national_id string, email string, salary string, branch_id string, job_title string, event_kind string, event_at string, ingested_at timestamp, source_file string",
    )
    r = silver.rejects(silver.EMPLOYEES, emp).first()
    assert r["reason"] == "event_at_present" and r["failed_rules"] == ["event_at_present"]
    payload = json.loads(r["payload"])
    assert "email" in payload and payload["email"] is None


def test_raw_valid_label_accepted_and_null_state_quarantined(spark):
    trk = spark.createDataFrame(
        [("T1", "1", "dhl", "EN_TRANSITO", "S1", "2024-01-01", None, "db"), ("T2", "2", "dhl", None, "S1", "2024-01-01", None, "db")],
        "tracking_id string, order_id string, courier string, delivery_state string, origin_branch string, updated_at_src string, ingested_at timestamp, source_system string",
    )
    assert [r["tracking_id"] for r in silver.clean(silver.TRACKING, trk).collect()] == ["T1"]
    assert [r["record_key"] for r in silver.rejects(silver.TRACKING, trk).collect()] == ["T2"]


def test_replies_positions_and_empty_arrays(spark):
    rows = [
        ("V1", "P1", "C", 5, None, None, None, None, None, "f"),
        ("V2", "P1", "C", 5, None, None, [], None, None, "f"),
        ("V3", "P1", "C", 5, None, None, [("a", "x"), ("b", "y")], None, None, "f"),
    ]
    schema = "review_id string, product_id string, customer_id string, rating int, comment string, tags array<string>, replies array<struct<author:string,text:string>>, review_date string, ingested_at timestamp, source_file string"
    out = silver.review_replies(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["review_id"], r["reply_pos"], r["author"]) for r in out) == [("V3", 0, "a"), ("V3", 1, "b")]


def test_summary_sorted_by_count(spark):
    from medalla.sources import adapters

    from .conftest import SF_SMOKE

    bronze = {n: adapters.BY_SOURCE[n](spark, SF_SMOKE) for n in silver.SPECS}
    rows = quarantine.summary(quarantine.quarantine(bronze)).collect()
    counts = [r["count"] for r in rows]
    assert counts == sorted(counts, reverse=True) and sum(counts) > 0


def test_masking_and_tags(spark):
    df = spark.createDataFrame([("E1", "D1", "e@x", Decimal("5.00"))], "employee_id string, national_id string, email string, salary decimal(12,2)")
    tagged = governance.tag_pii(df)
    assert governance.pii_columns(tagged) == ["national_id", "email", "salary"]
    masked = governance.masked(tagged, privileged=False).first()
    assert (masked["national_id"], masked["email"], masked["salary"]) == (L.REDACTED,) * 3
    assert governance.masked(tagged, privileged=True).first()["email"] == "e@x"


def test_sql_mask_function(spark):
    governance.register_mask_function(spark, privileged_users=["nobody-special"])
    assert spark.sql("SELECT mask_pii('12345678') AS v").first()["v"] == L.REDACTED
    me = spark.sql("SELECT current_user() AS u").first()["u"]
    governance.register_mask_function(spark, privileged_users=[me])
    assert spark.sql("SELECT mask_pii('12345678') AS v").first()["v"] == "12345678"
