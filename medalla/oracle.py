"""Independent SQL (DuckDB dialect) for every registered query.

The feeds are re-derived from the test tables in SQL, cleaned with CASE,
TRY_CAST and ROW_NUMBER, and aggregated with plain GROUP BY / COUNT(DISTINCT)
- a different formulation from the DataFrame code, so agreement is evidence.
Rounded means are computed in integer cents with HALF_UP so both engines give
the same double.
"""

from __future__ import annotations

# Expected labels, written out here: the oracle shares no table with what it checks.
PAY_METHOD = {
    "Efv": "Efectivo",
    "Tarjeta": "Tarjeta De Credito",
    "Tarjeta Credito": "Tarjeta De Credito",
    "Tc": "Tarjeta De Credito",
    "Transferencia": "Transferencia Bancaria",
}
CATEGORY = {"Climatización": "Climatizacion", "Electrónica": "Electronica", "Línea Blanca": "Linea Blanca"}
DELIVERY_STATE = {"En Camino": "En Transito"}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def std(x: str, underscores: bool = True) -> str:
    inner = f"replace({x}, '_', ' ')" if underscores else x
    return initcap(f"trim({inner}, ' ')")


def remap(x: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {x} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {x} END)"


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(12,2)) AS VARCHAR)"


def dtext(x: str) -> str:
    return f"CAST(CAST({x} AS DATE) AS VARCHAR)"


def first_by(table: str, key: str, order: list[str], where: str = "TRUE") -> str:
    ob = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (
        f"(SELECT * EXCLUDE (rn_) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {ob}) AS rn_ "
        f"FROM {table} WHERE {where}) WHERE rn_ = 1)"
    )


# ---------------------------------------------------------------- bronze feeds
B_SALES = f"""b_sales AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sale_id,
    CASE WHEN l_suppkey % 25 = 0 THEN NULL ELSE 'S' || CAST(l_suppkey AS VARCHAR) END AS branch_id,
    'P' || CAST(l_partkey AS VARCHAR) AS product_id,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
    CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN '-5.00'
         WHEN l_partkey % 83 = 0 THEN 'abc' WHEN l_partkey % 79 = 0 THEN '0.004'
         ELSE {money('l_extendedprice')} END AS amount,
    CASE l_linenumber WHEN 1 THEN ' EFV' WHEN 2 THEN 'tarjeta' WHEN 3 THEN 'TARJETA_CREDITO'
         WHEN 4 THEN 'tc ' WHEN 5 THEN 'transferencia' ELSE 'efectivo' END AS pay_method,
    CASE WHEN l_partkey % 101 = 0 THEN '31/12/2024' ELSE {dtext('l_shipdate')} END AS sale_date,
    CASE WHEN l_linestatus = 'F' THEN 'tienda' ELSE 'web' END AS channel,
    l_shipdate AS ingested_at,
    'sales-' || {dtext('l_shipdate')} || '.csv' AS source_file
  FROM lineitem)"""

T_SALES = f"""t_sales AS (
  SELECT sale_id, COALESCE(branch_id, 'Sin Sucursal') AS branch_id, product_id,
    TRY_CAST(quantity AS INTEGER) AS quantity, TRY_CAST(amount AS DECIMAL(12,2)) AS amount,
    {remap(std('pay_method'), PAY_METHOD)} AS pay_method,
    TRY_CAST(sale_date AS DATE) AS sale_date, channel, ingested_at, source_file
  FROM b_sales)"""

S_SALES = "s_sales AS " + first_by(
    "t_sales",
    "sale_id",
    ["ingested_at", "source_file", "branch_id", "product_id", "quantity", "amount", "pay_method", "sale_date", "channel"],
    "sale_id IS NOT NULL AND amount IS NOT NULL AND amount > 0",
)

B_RETURNS = f"""b_returns AS (
  SELECT 'R' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS return_id,
    CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
    'S' || CAST(l_suppkey AS VARCHAR) AS branch_id, 'P' || CAST(l_partkey AS VARCHAR) AS product_id,
    CASE l_linenumber % 4 WHEN 0 THEN 'producto_defectuoso' WHEN 1 THEN ' NO_CUMPLE '
         WHEN 2 THEN 'arrepentimiento' ELSE 'Otro' END AS reason,
    CASE WHEN l_partkey % 97 = 0 THEN '0' WHEN l_partkey % 89 = 0 THEN NULL
         ELSE {money('l_extendedprice')} END AS refund,
    {dtext('l_shipdate')} AS return_date, l_shipdate AS ingested_at, 'returns.csv' AS source_file
  FROM lineitem WHERE l_returnflag = 'R')"""

T_RETURNS = f"""t_returns AS (
  SELECT return_id, COALESCE(order_id, 'Sin Pedido') AS order_id, branch_id, product_id,
    {std('reason')} AS reason, TRY_CAST(refund AS DECIMAL(12,2)) AS refund,
    TRY_CAST(return_date AS DATE) AS return_date, ingested_at, source_file
  FROM b_returns)"""

S_RETURNS = "s_returns AS " + first_by(
    "t_returns",
    "return_id",
    ["ingested_at", "source_file", "order_id", "branch_id", "product_id", "reason", "refund", "return_date"],
    "return_id IS NOT NULL AND refund IS NOT NULL AND refund > 0",
)

B_PRODUCTS = f"""b_products AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
    CASE p_type WHEN 'ECONOMY' THEN 'Climatización' WHEN 'STANDARD' THEN ' ELECTRÓNICA'
         WHEN 'SMALL' THEN 'LINEA_BLANCA' WHEN 'LARGE' THEN 'línea blanca'
         WHEN 'PROMO' THEN 'muebles' WHEN 'MEDIUM' THEN 'Electronica' END AS category,
    CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_brand END AS brand,
    CASE WHEN p_partkey % 41 = 0 THEN '0' WHEN p_partkey % 43 = 0 THEN 'n/a'
         ELSE {money('p_retailprice')} END AS list_price,
    TIMESTAMP '2024-01-01 00:00:00' AS ingested_at, 'catalogo_productos' AS source_file
  FROM part)"""

T_PRODUCTS = f"""t_products AS (
  SELECT product_id, product_name, {remap(std('category'), CATEGORY)} AS category,
    COALESCE(brand, 'Sin Marca') AS brand, TRY_CAST(list_price AS DECIMAL(12,2)) AS list_price,
    ingested_at, source_file
  FROM b_products)"""

S_PRODUCTS = "s_products AS " + first_by(
    "t_products",
    "product_id",
    ["ingested_at", "source_file", "product_name", "category", "brand", "list_price"],
    "product_id IS NOT NULL AND list_price IS NOT NULL AND list_price > 0",
)

B_REVIEWS = f"""b_reviews AS (
  SELECT 'V' || CAST(event_id AS VARCHAR) AS review_id,
    'P' || CAST((event_id * 7919) % 2000 AS VARCHAR) AS product_id,
    'C' || CAST(user_id AS VARCHAR) AS customer_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS rating,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS comment,
    event_type AS tags,
    CASE WHEN event_id % 61 = 0 THEN NULL ELSE {dtext('ts')} END AS review_date,
    ts AS ingested_at, 'reviews-' || {dtext('ts')} || '.json' AS source_file
  FROM events)"""

T_REVIEWS = """t_reviews AS (
  SELECT review_id, product_id, customer_id, rating, COALESCE(comment, 'Sin Comentario') AS comment,
    TRY_CAST(review_date AS DATE) AS review_date, tags, ingested_at, source_file
  FROM b_reviews)"""

S_REVIEWS = "s_reviews AS " + first_by(
    "t_reviews",
    "review_id",
    ["ingested_at", "source_file", "product_id", "customer_id", "rating", "comment", "review_date", "tags"],
    "review_id IS NOT NULL AND rating BETWEEN 1 AND 5 AND rating IS NOT NULL",
)

B_EMPLOYEES = f"""b_employees AS (
  SELECT 'E' || CAST(user_id AS VARCHAR) AS employee_id, 'Name ' || CAST(user_id AS VARCHAR) AS full_name,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE 'D' || CAST(user_id AS VARCHAR) END AS national_id,
    CASE WHEN user_id % 6 = 0 THEN NULL ELSE 'e' || CAST(user_id AS VARCHAR) || '@x.test' END AS email,
    {money('1000 + value')} AS salary,
    'S' || CAST(user_id % 10 AS VARCHAR) AS branch_id, 'clerk' AS job_title,
    CASE event_type WHEN 'signup' THEN 'alta' WHEN 'error' THEN ' BAJA ' WHEN 'purchase' THEN 'CAMBIO_SALARIO'
         WHEN 'click' THEN 'cambio_cargo' WHEN 'view' THEN 'traslado' END AS event_kind,
    CASE WHEN event_id % 83 = 0 THEN NULL ELSE CAST(ts AS VARCHAR) END AS event_at,
    ts AS ingested_at, 'employees.csv' AS source_file
  FROM events)"""

T_EMPLOYEES = f"""t_employees AS (
  SELECT employee_id, full_name, national_id, COALESCE(email, 'Sin Correo') AS email,
    TRY_CAST(salary AS DECIMAL(12,2)) AS salary, branch_id, job_title,
    {std('event_kind')} AS event_kind, TRY_CAST(event_at AS TIMESTAMP) AS event_at,
    ingested_at, source_file
  FROM b_employees)"""

S_EMPLOYEES = """s_employees AS (
  SELECT * FROM t_employees
  WHERE employee_id IS NOT NULL AND national_id IS NOT NULL AND event_at IS NOT NULL)"""

EMP_COLS = "employee_id, full_name, national_id, email, salary, branch_id, job_title, event_kind, event_at"

H_EMPLOYEES = f"""u_employees AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY employee_id, event_at
                                 ORDER BY ingested_at DESC, source_file DESC) AS rn_
    FROM s_employees) WHERE rn_ = 1),
h_employees AS (
  SELECT {EMP_COLS}, event_at AS __START_AT,
    LEAD(event_at) OVER (PARTITION BY employee_id ORDER BY event_at) AS __END_AT
  FROM u_employees),
c_employees AS (
  SELECT * FROM h_employees WHERE __END_AT IS NULL AND event_kind <> 'Baja')"""

B_TRACKING = """b_tracking AS (
  SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS tracking_id, CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE o_custkey % 3 WHEN 0 THEN ' dhl' WHEN 1 THEN 'FEDEX' ELSE 'olva courier ' END AS courier,
    CASE WHEN o_orderkey % 71 = 0 THEN NULL
         WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'perdido'
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'DEVUELTO'
         WHEN o_orderstatus = 'F' THEN 'ENTREGADO '
         WHEN o_orderstatus = 'O' THEN 'en_camino' ELSE 'Pendiente' END AS delivery_state,
    'S' || CAST(o_custkey % 100 AS VARCHAR) AS origin_branch,
    CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE CAST(o_orderdate AS VARCHAR) END AS updated_at_src,
    o_orderdate AS ingested_at, 'Azure SQL Database' AS source_system
  FROM orders)"""

T_TRACKING = f"""t_tracking AS (
  SELECT tracking_id, order_id, {std('courier', underscores=False)} AS courier,
    {remap(std('delivery_state'), DELIVERY_STATE)} AS delivery_state,
    origin_branch, TRY_CAST(updated_at_src AS TIMESTAMP) AS updated_at_src, ingested_at, source_system
  FROM b_tracking)"""

S_TRACKING = "s_tracking AS " + first_by(
    "t_tracking",
    "tracking_id",
    ["ingested_at", "source_system", "order_id", "courier", "delivery_state", "origin_branch", "updated_at_src"],
    "tracking_id IS NOT NULL AND delivery_state IN ('En Transito', 'Pendiente', 'Entregado', 'Devuelto')",
)

FEEDS = {
    "sales": [B_SALES, T_SALES, S_SALES],
    "returns": [B_RETURNS, T_RETURNS, S_RETURNS],
    "products": [B_PRODUCTS, T_PRODUCTS, S_PRODUCTS],
    "reviews": [B_REVIEWS, T_REVIEWS, S_REVIEWS],
    "employees": [B_EMPLOYEES, T_EMPLOYEES, S_EMPLOYEES, H_EMPLOYEES],
    "tracking": [B_TRACKING, T_TRACKING, S_TRACKING],
}


def with_feeds(*names: str) -> str:
    parts: list[str] = []
    for n in names:
        parts.extend(FEEDS[n])
    return "WITH " + ",\n".join(parts) + "\n"


def cents_mean(total: str, n: str) -> str:
    """HALF_UP mean of a positive decimal(12,2) sum, in cents, as DOUBLE."""
    return f"CAST((2 * CAST({total} * 100 AS HUGEINT) + {n}) // (2 * {n}) AS DOUBLE) / 100"


# ------------------------------------------------------------------ queries
SQL: dict[str, str] = {}

SQL["sales_clean"] = with_feeds("sales") + """
SELECT sale_id, branch_id, product_id, CAST(quantity AS BIGINT) AS quantity, CAST(amount AS DOUBLE) AS amount,
  pay_method, sale_date, channel, ingested_at, source_file FROM s_sales"""

SQL["returns_clean"] = with_feeds("returns") + """
SELECT return_id, order_id, branch_id, product_id, reason, CAST(refund AS DOUBLE) AS refund, return_date,
  ingested_at, source_file FROM s_returns"""

SQL["products_clean"] = with_feeds("products") + """
SELECT product_id, product_name, category, brand, CAST(list_price AS DOUBLE) AS list_price,
  ingested_at, source_file FROM s_products"""

SQL["reviews_clean"] = with_feeds("reviews") + """
SELECT review_id, product_id, customer_id, CAST(rating AS BIGINT) AS rating, comment, review_date, tags,
  ingested_at, source_file FROM s_reviews"""

SQL["review_replies"] = """
WITH threads AS (
  SELECT 'V' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS review_id, role,
    string_split(text, chr(10)) AS lines, conv_id
  FROM conversations)
SELECT review_id, CAST(i - 1 AS BIGINT) AS reply_pos, role AS author, lines[i] AS text,
  TIMESTAMP '2024-01-01 00:00:00' AS ingested_at,
  'conversations-' || CAST(conv_id AS VARCHAR) || '.json' AS source_file
FROM threads, range(1, len(lines) + 1) AS r(i)
WHERE lines IS NOT NULL"""

SQL["tracking_clean"] = with_feeds("tracking") + """
SELECT tracking_id, order_id, courier, delivery_state, origin_branch, updated_at_src, ingested_at, source_system
FROM s_tracking"""

SQL["employee_events_clean"] = with_feeds("employees") + f"""
SELECT employee_id, full_name, national_id, email, CAST(salary AS DOUBLE) AS salary, branch_id, job_title,
  event_kind, event_at, ingested_at, source_file FROM s_employees"""

EMP_OUT = (
    "employee_id, full_name, national_id, email, CAST(salary AS DOUBLE) AS salary, branch_id, job_title, "
    "event_kind, event_at, __START_AT, __END_AT"
)

SQL["employee_history"] = with_feeds("employees") + f"SELECT {EMP_OUT} FROM h_employees"

SQL["employee_history_collapsed"] = with_feeds("employees") + f""",
runs AS (
  SELECT *, lag(branch_id) OVER k IS NOT DISTINCT FROM branch_id AND lag(job_title) OVER k IS NOT DISTINCT FROM job_title
            AND lag(event_kind) OVER k IS NOT DISTINCT FROM event_kind AND lag(event_at) OVER k IS NOT NULL AS same
  FROM h_employees WINDOW k AS (PARTITION BY employee_id ORDER BY event_at)),
opened AS (
  SELECT * REPLACE (LEAD(event_at) OVER (PARTITION BY employee_id ORDER BY event_at) AS __END_AT) FROM runs WHERE NOT same)
SELECT {EMP_OUT} FROM opened"""
SQL["employee_history_collapsed"] = SQL["employee_history_collapsed"].replace("\n,\nruns AS", ",\nruns AS")

SQL["employees_current"] = with_feeds("employees") + f"SELECT {EMP_OUT} FROM c_employees"

SQL["employees_masked"] = with_feeds("employees") + """
SELECT employee_id, full_name, '***REDACTADO***' AS national_id, '***REDACTADO***' AS email,
  '***REDACTADO***' AS salary, branch_id, job_title, event_kind, event_at, __START_AT, __END_AT
FROM c_employees"""

SQL["sales_by_branch_month"] = with_feeds("sales") + f"""
SELECT branch_id, CAST(year(sale_date) AS BIGINT) AS year, CAST(month(sale_date) AS BIGINT) AS month,
  CAST(COUNT(DISTINCT sale_id) AS BIGINT) AS sales_count, CAST(SUM(quantity) AS BIGINT) AS units_sold,
  CAST(SUM(amount) AS DOUBLE) AS sales_total,
  {cents_mean('SUM(amount)', 'COUNT(amount)')} AS avg_ticket
FROM s_sales GROUP BY branch_id, year(sale_date), month(sale_date)"""

SQL["product_sales_returns"] = with_feeds("products", "sales", "returns") + """,
v AS (SELECT product_id, SUM(quantity) AS units_sold, COUNT(DISTINCT sale_id) AS sales_count,
        SUM(amount) AS sales_amount FROM s_sales GROUP BY product_id),
d AS (SELECT product_id, COUNT(DISTINCT return_id) AS returns_count, SUM(refund) AS refund_amount
      FROM s_returns GROUP BY product_id)
SELECT p.product_id, p.product_name, p.category, p.brand,
  CAST(COALESCE(v.units_sold, 0) AS BIGINT) AS units_sold,
  CAST(COALESCE(v.sales_count, 0) AS BIGINT) AS sales_count,
  CAST(COALESCE(v.sales_amount, 0) AS DOUBLE) AS sales_amount,
  CAST(COALESCE(d.returns_count, 0) AS BIGINT) AS returns_count,
  CAST(COALESCE(d.refund_amount, 0) AS DOUBLE) AS refund_amount
FROM s_products p LEFT JOIN v ON p.product_id = v.product_id LEFT JOIN d ON p.product_id = d.product_id"""
SQL["product_sales_returns"] = SQL["product_sales_returns"].replace("\n,\nv AS", ",\nv AS")

SQL["headcount_by_branch"] = with_feeds("employees") + """
SELECT branch_id, CAST(COUNT(DISTINCT employee_id) AS BIGINT) AS active_employees
FROM c_employees GROUP BY branch_id"""

SQL["negative_review_rate"] = with_feeds("reviews", "products") + """,
base AS (SELECT r.review_id, r.rating, p.category FROM s_reviews r JOIN s_products p ON r.product_id = p.product_id),
agg AS (SELECT category, COUNT(DISTINCT review_id) AS total_reviews,
          COUNT(DISTINCT CASE WHEN rating <= 2 THEN review_id END) AS negative_reviews,
          SUM(rating) AS rating_sum, COUNT(rating) AS rated
        FROM base GROUP BY category)
SELECT category, CAST(total_reviews AS BIGINT) AS total_reviews, CAST(negative_reviews AS BIGINT) AS negative_reviews,
  CAST((200 * rating_sum + rated) // (2 * rated) AS DOUBLE) / 100 AS avg_rating,
  CAST((20000 * negative_reviews + total_reviews) // (2 * total_reviews) AS DOUBLE) / 100 AS negative_rate
FROM agg"""

_REJECTS = {
    "sales": ("t_sales", "sale_id", [("sale_id_present", "sale_id IS NOT NULL"),
                                     ("amount_valid", "amount IS NOT NULL AND amount > 0")], "source_file"),
    "returns": ("t_returns", "return_id", [("return_id_present", "return_id IS NOT NULL"),
                                           ("refund_valid", "refund IS NOT NULL AND refund > 0")], "source_file"),
    "reviews": ("t_reviews", "review_id", [("review_id_present", "review_id IS NOT NULL"),
                                           ("rating_valid", "rating BETWEEN 1 AND 5 AND rating IS NOT NULL")],
                "source_file"),
    "employees": ("t_employees", "employee_id", [("employee_id_present", "employee_id IS NOT NULL"),
                                                 ("national_id_present", "national_id IS NOT NULL"),
                                                 ("event_at_present", "event_at IS NOT NULL")], "source_file"),
    "products": ("t_products", "product_id", [("product_id_present", "product_id IS NOT NULL"),
                                              ("list_price_valid", "list_price IS NOT NULL AND list_price > 0")],
                 "source_file"),
    "tracking": ("t_tracking", "tracking_id", [("tracking_id_present", "tracking_id IS NOT NULL"),
                                               ("delivery_state_valid",
                                                "delivery_state IN ('En Transito', 'Pendiente', 'Entregado', 'Devuelto')")],
                 "source_system"),
}

_WARNS = {
    "reviews": [("review_date_present", "review_date IS NOT NULL")],
    "tracking": [("updated_at_present", "updated_at_src IS NOT NULL")],
}


def _fails(rules) -> str:
    items = ", ".join(f"CASE WHEN COALESCE({expr}, FALSE) THEN NULL ELSE '{name}' END" for name, expr in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


# The raw fields of a rejected row, by name, as its payload must hold them.
_PAYLOAD = {
    "sales": "amount branch_id channel ingested_at pay_method product_id quantity sale_date sale_id source_file",
    "returns": "branch_id ingested_at order_id product_id reason refund return_date return_id source_file",
    "reviews": "comment customer_id ingested_at product_id rating replies review_date review_id source_file tags",
    "employees": "branch_id email employee_id event_at event_kind full_name ingested_at job_title national_id salary source_file",
    "products": "brand category ingested_at list_price product_id product_name source_file",
    "tracking": "courier delivery_state ingested_at order_id origin_branch source_system tracking_id updated_at_src",
}
_PAYLOAD_VALUE = {
    "ingested_at": "strftime(CAST(ingested_at AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S')",
    "replies": "CAST(NULL AS VARCHAR)",
    "tags": """'["' || tags || '"]'""",
}


def _payload(src: str) -> str:
    value = lambda c: _PAYLOAD_VALUE.get(c, f"CAST({c} AS VARCHAR)")
    return " || '|' || ".join(f"'{c}=' || coalesce({value(c)}, '<null>')" for c in _PAYLOAD[src].split())


def _with_payload(src: str) -> str:
    """The typed rows of a feed, with the raw ones' fields in ``payload``."""
    raw = f"FROM b_{src})"
    return FEEDS[src][1].replace(raw, f", {_payload(src)} AS payload {raw}")


def _rejects_union(payload: bool = False) -> str:
    parts, more = [], ", payload" if payload else ""
    for src, (tbl, key, rules, origin) in _REJECTS.items():
        parts.append(
            f"SELECT '{src}' AS source_table, f[1] AS reason, array_to_string(f, '|') AS failed_rules, "
            f"CAST(b_key AS VARCHAR) AS record_key, ingested_at, {origin} AS source_file{more} "
            f"FROM (SELECT {_fails(rules)} AS f, {key} AS b_key, ingested_at, {origin}{more} FROM {tbl}) WHERE len(f) > 0"
        )
    return "\nUNION ALL\n".join(parts)


_ALL = ("sales", "returns", "reviews", "employees", "products", "tracking")
_T_ONLY = ",\n".join(FEEDS[n][i] for n in _ALL for i in (0, 1))

_RAW_AND_TYPED = ",\n".join(x for n in _ALL for x in (FEEDS[n][0], _with_payload(n)))

SQL["quarantine_rows"] = "WITH " + _RAW_AND_TYPED + "\n" + _rejects_union(payload=True)

SQL["quarantine_summary"] = (
    "WITH " + _T_ONLY + ",\nq AS (" + _rejects_union() + ")\n"
    "SELECT source_table, reason, CAST(COUNT(*) AS BIGINT) AS count FROM q GROUP BY source_table, reason"
)


def _counters() -> str:
    parts = []
    for src, (tbl, _key, rules, _o) in _REJECTS.items():
        allr = [(n, e, "drop") for n, e in rules] + [(n, e, "warn") for n, e in _WARNS.get(src, [])]
        for name, expr, pol in allr:
            parts.append(
                f"SELECT '{src}' AS source_table, '{name}' AS rule, '{pol}' AS policy, "
                f"CAST(COUNT(*) AS BIGINT) AS rows_in, "
                f"CAST(COUNT(*) FILTER (WHERE NOT COALESCE({expr}, FALSE)) AS BIGINT) AS failed, "
                f"CAST(COUNT(*) FILTER (WHERE COALESCE({expr}, FALSE)) AS BIGINT) AS passed FROM {tbl}"
            )
    return "\nUNION ALL\n".join(parts)


SQL["rule_counters"] = "WITH " + _T_ONLY + "\n" + _counters()

SQL["gold_row_counts"] = with_feeds(*_ALL) + """
SELECT 'sales_by_branch_month' AS table_name,
  CAST((SELECT COUNT(*) FROM (SELECT DISTINCT branch_id, year(sale_date), month(sale_date) FROM s_sales)) AS BIGINT) AS rows
UNION ALL SELECT 'product_sales_returns', CAST((SELECT COUNT(*) FROM s_products) AS BIGINT)
UNION ALL SELECT 'headcount_by_branch', CAST((SELECT COUNT(DISTINCT branch_id) FROM c_employees) AS BIGINT)
UNION ALL SELECT 'negative_review_rate',
  CAST((SELECT COUNT(DISTINCT p.category) FROM s_reviews r JOIN s_products p ON r.product_id = p.product_id) AS BIGINT)
"""
SQL["gold_row_counts"] = f"SELECT table_name, rows, rows > 0 AS ok FROM ({SQL['gold_row_counts']})"

SQL["latest_events"] = """
SELECT ts AS timestamp, event_type, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  props AS message, event_id
FROM events ORDER BY ts DESC, event_id ASC LIMIT 100"""

# --------------------------------------------------------- connector queries
SQL["history_stream_apply"] = SQL["employee_history"]

SQL["reviews_stream_ingest"] = with_feeds("reviews") + """
SELECT review_id, product_id, customer_id, CAST(rating AS BIGINT) AS rating, comment, review_date, tags
FROM s_reviews"""

SQL["sales_stream_rejects"] = "WITH " + ",\n".join(FEEDS["sales"][:2]) + f"""
SELECT 'sales' AS source_table, f[1] AS reason, array_to_string(f, '|') AS failed_rules, sale_id AS record_key
FROM (SELECT {_fails(_REJECTS['sales'][2])} AS f, sale_id FROM t_sales) WHERE len(f) > 0"""

SQL["sales_stream_ingest"] = f"SELECT * EXCLUDE (ingested_at, source_file) FROM ({SQL['sales_clean']})"

SQL["sales_stream_lineage"] = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sale_id,
  'ventas-' || CAST(l_linenumber AS VARCHAR) || '.csv' AS source_file
FROM lineitem"""

SQL["returns_stream_ingest"] = f"SELECT * EXCLUDE (ingested_at, source_file) FROM ({SQL['returns_clean']})"

SQL["review_replies_stream"] = f"SELECT review_id, reply_pos, author, text FROM ({SQL['review_replies']})"

SQL["stream_rule_counters"] = (
    f"SELECT * FROM ({SQL['rule_counters']}) WHERE source_table IN ('sales', 'returns', 'reviews', 'employees')"
)

SQL["sales_by_branch_month_incremental"] = SQL["sales_by_branch_month"]

SQL["product_sales_returns_incremental"] = SQL["product_sales_returns"]

SQL["products_json_snapshot"] = with_feeds("products") + """
SELECT product_id, product_name, category, brand, CAST(list_price AS DOUBLE) AS list_price, source_file
FROM s_products"""

SQL["employees_masked_by_group"] = with_feeds("employees") + """
SELECT employee_id, full_name, branch_id, job_title, event_kind, event_at, __START_AT, __END_AT, reader,
  CASE WHEN seen THEN national_id ELSE '***REDACTADO***' END AS national_id,
  CASE WHEN seen THEN email ELSE '***REDACTADO***' END AS email,
  CASE WHEN seen THEN CAST(salary AS VARCHAR) ELSE '***REDACTADO***' END AS salary
FROM c_employees CROSS JOIN (
  SELECT n_name AS reader, r_name = 'EUROPE' AS seen FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_name IN ('NATION_3', 'NATION_0'))"""

SQL["tracking_jdbc"] = with_feeds("tracking") + """
SELECT tracking_id, order_id, courier, delivery_state, origin_branch, updated_at_src, source_system
FROM s_tracking"""

SQL["tracking_jdbc_text_key"] = SQL["tracking_jdbc"]
