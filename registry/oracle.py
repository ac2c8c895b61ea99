"""SQL counterparts of the registered queries, runnable on the plain tables.

Each text is a SELECT over the common table expressions below; ``with_ctes`` adds
the ones it needs.
"""

from __future__ import annotations

import re

from registry import expected as S
from registry.expected import BLOCK_BYTES, INNER_PAD, OUTER_PAD
from registry.inputs import GIVEN_CENTROIDS, GIVEN_SUBSAMPLE, GIVEN_TREES, SALT, SNAPSHOT

TIME = "%Y-%m-%d %H:%M:%S"


def stamp(column: str) -> str:
    return f"strftime({column}, '{TIME}') AS {column.split('.')[-1]}"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pad(byte: int) -> str:
    return bytes(b ^ byte for b in SALT.encode().ljust(BLOCK_BYTES, b"\0")).hex()


def hmac(column: str) -> str:
    return (
        f"sha256(unhex('{pad(OUTER_PAD)}') || unhex(sha256(unhex('{pad(INNER_PAD)}')"
        f" || encode(CAST({column} AS VARCHAR)))))"
    )


def floor_days(later: str, earlier: str) -> str:
    return (
        f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"
    )


def mean(value: str) -> str:
    """Exact mean of whole numbers."""
    return f"CAST(sum({value}) AS DOUBLE) / NULLIF(count({value}), 0)"


def cents(value: str) -> str:
    return f"CAST(round({value} * 100) AS BIGINT)"


def case_text(column: str, texts: dict[str, str], otherwise: str) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in texts.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


LABELS = "[" + ", ".join(quoted(s) for s in S.SEGMENT_LABELS) + "]"
BAND = (
    "CASE WHEN {0} >= 0.7 THEN 'anomalous' WHEN {0} >= CAST(0.7 AS DOUBLE) * CAST(0.7 AS DOUBLE)"
    " THEN 'suspicious' ELSE 'normal' END"
)
ENCODED = "CASE segment_label " + " ".join(
    f"WHEN {quoted(s)} THEN {i}" for i, s in enumerate(S.SEGMENT_LABELS)
) + " END"

CTES: dict[str, str] = {}

# --- raw-shaped views ------------------------------------------------------------
CTES["orders_raw"] = """
SELECT o_orderkey AS ingest_seq, o_orderkey AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
       o_orderdate AS order_purchase_timestamp,
       o_orderdate + INTERVAL '1' HOUR * CAST((o_orderkey * 11) % 48 AS INT) AS order_approved_at,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate + INTERVAL '1' HOUR * CAST((o_orderkey * 37) % 720 AS INT) END
         AS order_delivered_customer_date,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate + INTERVAL '1' HOUR * CAST((o_orderkey * 53) % 600 AS INT) END
         AS order_estimated_delivery_date
FROM orders"""
CTES["customers_raw"] = """
SELECT c_custkey AS ingest_seq, c_custkey AS customer_id, c_custkey - c_custkey % 3 AS customer_unique_id,
       concat(' ', n_name, ' ') AS customer_city,
       concat(' ', lower(replace(n_name, 'NATION_', 'N')), ' ') AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
CTES["order_items_raw"] = """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
       l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
FROM lineitem"""
CTES["order_payments_raw"] = """
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
       CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' END AS payment_type,
       CAST(floor(l_quantity) AS INT) % 12 + 1 AS payment_installments,
       CASE WHEN l_partkey % 50 = 0 THEN 0.0 ELSE l_extendedprice END AS payment_value
FROM lineitem"""
CTES["order_reviews_raw"] = """
SELECT event_id AS ingest_seq, event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS review_id,
       event_id % 12000 AS order_id,
       CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 7 END AS review_score,
       ts AS review_creation_date, ts + INTERVAL '1' HOUR * CAST(user_id AS INT) AS review_answer_timestamp
FROM events"""
CTES["products_raw"] = "SELECT p_partkey AS product_id, p_brand AS product_category_name FROM part"
CTES["sellers_raw"] = "SELECT s_suppkey AS seller_id, s_nationkey AS seller_state FROM supplier"

# --- cleaning ----------------------------------------------------------------------
CTES["orders_clean"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingest_seq) AS rn FROM orders_raw
  WHERE order_status IN ('delivered', 'shipped', 'invoiced') AND order_purchase_timestamp IS NOT NULL)
WHERE rn = 1"""
CTES["customers_clean"] = """
SELECT customer_id, customer_unique_id, trim(customer_city) AS customer_city,
       upper(trim(customer_state)) AS customer_state
FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY ingest_seq DESC) AS rn
      FROM customers_raw WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL)
WHERE rn = 1"""
CTES["reviews_clean"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY ingest_seq) AS rn FROM order_reviews_raw
  WHERE review_score BETWEEN 1 AND 5)
WHERE rn = 1"""
CTES["payments_clean"] = (
    "SELECT * FROM order_payments_raw WHERE payment_value > 0 AND payment_type IS NOT NULL"
)
CTES["order_paid"] = f"""
SELECT order_id, CAST(sum({cents("payment_value")}) AS BIGINT) AS paid_cents,
       max(payment_installments) AS payment_installments
FROM payments_clean GROUP BY order_id"""
CTES["transactions"] = """
SELECT i.order_id, o.customer_id, i.product_id, i.seller_id, i.price, i.freight_value,
       CAST(p.paid_cents AS DOUBLE) / 100 AS payment_value, p.paid_cents, p.payment_installments,
       o.order_status, o.order_purchase_timestamp, o.order_delivered_customer_date,
       o.order_estimated_delivery_date
FROM order_items_raw i LEFT JOIN orders_clean o ON i.order_id = o.order_id
LEFT JOIN order_paid p ON i.order_id = p.order_id"""

# --- features -----------------------------------------------------------------------
RECENCY = floor_days(f"TIMESTAMP '{SNAPSHOT}'", "max(order_purchase_timestamp)")
CTES["rfm"] = f"""
SELECT customer_id, {RECENCY} AS recency_days, count(DISTINCT order_id) AS frequency,
       CAST(coalesce(sum(paid_cents), 0) AS DOUBLE) / 100 AS monetary_total,
       CAST(coalesce(sum(paid_cents), 0) AS DOUBLE) / 100 / count(DISTINCT order_id) AS monetary_avg
FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id"""
CTES["review_features"] = f"""
SELECT o.customer_id, {mean("r.review_score")} AS avg_review_score, count(r.review_score) AS review_count
FROM reviews_clean r JOIN orders_clean o ON r.order_id = o.order_id GROUP BY o.customer_id"""
DAYS = floor_days("order_delivered_customer_date", "order_purchase_timestamp")
PLANNED = floor_days("order_estimated_delivery_date", "order_purchase_timestamp")
CTES["delivery_features"] = f"""
SELECT customer_id, {mean("delivery_days")} AS avg_delivery_days,
       coalesce({mean("is_late")}, 0.0) AS late_delivery_rate
FROM (SELECT customer_id, {DAYS} AS delivery_days,
             CASE WHEN order_estimated_delivery_date IS NOT NULL THEN CAST({DAYS} > {PLANNED} AS INT) END AS is_late
      FROM transactions WHERE customer_id IS NOT NULL AND order_delivered_customer_date IS NOT NULL)
GROUP BY customer_id"""
CTES["payment_features"] = f"""
SELECT customer_id, {mean("payment_installments")} AS payment_installments_avg,
       CAST(0 AS BIGINT) AS unique_product_categories
FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id"""
CTES["matrix"] = f"""
SELECT r.customer_id AS customer_hash, TIMESTAMP '{SNAPSHOT}' AS snapshot_date, r.recency_days, r.frequency,
       r.monetary_total, r.monetary_avg, coalesce(v.avg_review_score, 3.0) AS avg_review_score,
       coalesce(v.review_count, 0) AS review_count,
       coalesce(p.payment_installments_avg, 1.0) AS payment_installments_avg,
       coalesce(p.unique_product_categories, 0) AS unique_product_categories,
       coalesce(d.avg_delivery_days, 0.0) AS avg_delivery_days,
       coalesce(d.late_delivery_rate, 0.0) AS late_delivery_rate,
       CAST(NULL AS DOUBLE) AS anomaly_score, CAST(NULL AS VARCHAR) AS segment_label
FROM rfm r LEFT JOIN review_features v ON r.customer_id = v.customer_id
LEFT JOIN delivery_features d ON r.customer_id = d.customer_id
LEFT JOIN payment_features p ON r.customer_id = p.customer_id"""

# --- given scores ---------------------------------------------------------------------
CTES["anomaly_given"] = f"""
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS customer_hash, s AS anomaly_score,
       s >= 0.95 AS is_anomaly, {BAND.format("s")} AS anomaly_flag
FROM (SELECT c_custkey, CAST(c_custkey * 37 % 1000 AS DOUBLE) / 1000 AS s FROM customer)"""
CTES["churn_given"] = """
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS customer_hash, p AS churn_probability,
       p >= 0.6 AS predicted_churn
FROM (SELECT c_custkey, CAST(c_custkey * 53 % 997 AS DOUBLE) / 997 AS p FROM customer)"""
CTES["churn_newer"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_hash,
       CAST((c_custkey * 59 + 7) % 991 AS DOUBLE) / 1100 AS churn_probability
FROM customer"""
CTES["segment_given"] = f"""
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS customer_hash, CAST(c_custkey % 3 AS INT) AS cluster_id,
       {LABELS}[CAST(c_custkey % 5 + 1 AS INT)] AS segment_label
FROM customer"""
CTES["alerts"] = """
SELECT row_number() OVER (ORDER BY alert_type, customer_hash) AS id, * FROM (
  SELECT customer_hash, 'anomaly' AS alert_type, anomaly_score AS score, CAST(0.8 AS DOUBLE) AS threshold
  FROM anomaly_given WHERE anomaly_score >= 0.8
  UNION ALL
  SELECT customer_hash, 'churn_risk', churn_probability, CAST(0.7 AS DOUBLE)
  FROM churn_given WHERE churn_probability >= 0.7)"""
CTES["labelled"] = """
SELECT customer_hash, recency_days, CAST(recency_days > 180 AS INT) AS churned,
       CAST(customer_hash * 53 % 997 AS DOUBLE) / 997 AS churn_probability
FROM matrix"""
CTES["split"] = """
SELECT *, CASE WHEN row_number() OVER (ORDER BY recency_days, customer_hash)
                    <= floor(0.8::DOUBLE * (SELECT count(*) FROM labelled)) THEN 'train' ELSE 'test' END AS split
FROM labelled"""

# --- persons -----------------------------------------------------------------------------
CTES["person_orders"] = """
SELECT customer_unique_id, count(DISTINCT order_id) AS orders
FROM orders_raw o JOIN customers_raw c ON o.customer_id = c.customer_id GROUP BY customer_unique_id"""
CTES["person_lines"] = f"""
SELECT c.customer_unique_id, o.order_id, o.order_purchase_timestamp, {cents("i.price")} AS cents
FROM orders_raw o JOIN customers_raw c ON o.customer_id = c.customer_id
JOIN order_items_raw i ON o.order_id = i.order_id"""
CTES["person_spend"] = """
SELECT customer_unique_id, CAST(sum(cents) AS DOUBLE) / 100 AS spend FROM person_lines GROUP BY customer_unique_id"""
LATEST = "(SELECT max(order_purchase_timestamp) FROM orders_raw)"
CTES["person_rfm"] = f"""
SELECT customer_unique_id, {floor_days(LATEST, "max(order_purchase_timestamp)")} AS recency,
       count(DISTINCT order_id) AS frequency, CAST(sum(cents) AS DOUBLE) / 100 AS monetary
FROM person_lines GROUP BY customer_unique_id"""
CTES["person_z"] = """
SELECT *, (monetary - (SELECT avg(monetary) FROM person_rfm)) / (SELECT stddev_samp(monetary) FROM person_rfm) AS monetary_z,
       (frequency - (SELECT avg(frequency) FROM person_rfm)) / (SELECT stddev_samp(frequency) FROM person_rfm) AS frequency_z
FROM person_rfm"""
CTES["person_state"] = "SELECT DISTINCT customer_unique_id, customer_state FROM customers_raw"
CTES["outlying"] = "SELECT * FROM person_z WHERE abs(monetary_z) > 2 OR abs(frequency_z) > 2"

# --- segmentation on given labels ------------------------------------------------------------
F7 = S.SEGMENT_FEATURES
Z = ", ".join(
    f"({c} - (SELECT avg({c}) FROM matrix)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0"
    f" ELSE stddev_pop({c}) END FROM matrix) AS {c}"
    for c in F7
)
CTES["points"] = f"SELECT customer_hash, {Z} FROM matrix"
CTES["clustered"] = f"""
SELECT k, customer_hash, CAST(customer_hash % k AS INT) AS cluster, {", ".join(F7)},
       {" + ".join(f"{c} * {c}" for c in F7)} AS sq
FROM points CROSS JOIN (SELECT unnest(range({S.K_MIN}, {S.K_MAX + 1})) AS k)"""
CTES["shapes"] = f"""
SELECT k, cluster, CAST(count(*) AS DOUBLE) AS n, sum(sq) AS q, {", ".join(f"sum({c}) AS {c}" for c in F7)}
FROM clustered GROUP BY k, cluster"""
DOT = " + ".join(f"x.{c} * s.{c}" for c in F7)
CTES["spreads"] = f"""
SELECT x.k, x.customer_hash, x.cluster AS own, s.cluster, s.n, x.sq * s.n - 2 * ({DOT}) + s.q AS total
FROM clustered x JOIN shapes s ON x.k = s.k"""
CTES["silhouettes"] = """
SELECT k, customer_hash, max(CASE WHEN cluster = own THEN n END) AS n,
       max(CASE WHEN cluster = own THEN total / NULLIF(n - 1, 0) END) AS a,
       min(CASE WHEN cluster <> own THEN total / n END) AS b
FROM spreads GROUP BY k, customer_hash"""
GAP = " + ".join(f"(x.{c} - s.{c} / s.n) * (x.{c} - s.{c} / s.n)" for c in F7)
CTES["gaps"] = f"""
SELECT x.k, x.cluster, {GAP} AS gap FROM clustered x JOIN shapes s ON x.k = s.k AND x.cluster = s.cluster"""
CTES["scatters"] = f"""
SELECT g.k, g.cluster, g.scatter, {", ".join(f"s.{c} / s.n AS {c}" for c in F7)}
FROM (SELECT k, cluster, avg(sqrt(gap)) AS scatter FROM gaps GROUP BY k, cluster) g
JOIN shapes s ON g.k = s.k AND g.cluster = s.cluster"""
APART = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in F7)
CTES["quality"] = f"""
SELECT i.k AS k_values, i.inertias, s.silhouette_scores, d.davies_bouldin_scores
FROM (SELECT k, sum(gap) AS inertias FROM gaps GROUP BY k) i
JOIN (SELECT k, avg(CASE WHEN n = 1 THEN 0 ELSE coalesce((b - a) / NULLIF(greatest(a, b), 0), 0) END) AS silhouette_scores
      FROM silhouettes GROUP BY k) s ON i.k = s.k
JOIN (SELECT k, avg(worst) AS davies_bouldin_scores FROM (
        SELECT a.k, a.cluster, max((a.scatter + b.scatter) / sqrt({APART})) AS worst
        FROM scatters a JOIN scatters b ON a.k = b.k AND a.cluster <> b.cluster GROUP BY a.k, a.cluster)
      GROUP BY k) d ON i.k = d.k"""
CTES["profiles3"] = f"""
SELECT CAST(customer_hash % 3 AS BIGINT) AS cluster_id, {", ".join(f"avg({c}) AS {c}" for c in F7)}
FROM matrix GROUP BY 1"""


def marks(feature: str) -> str:
    parts = ", ".join(
        f"quantile_cont(CAST({feature} AS DOUBLE), {s}) AS p{round(s * 100)}" for s in (0.25, 0.5, 0.75, 0.9)
    )
    return f"SELECT '{feature}' AS feature, {parts} FROM matrix"


CTES["percentiles"] = " UNION ALL ".join(marks(c) for c in F7)


def mark(feature: str, p: str) -> str:
    return f"(SELECT {p} FROM percentiles WHERE feature = '{feature}')"


R, FQ, M = "recency_days", "frequency", "monetary_total"
RULES = {
    "champions": f"CASE WHEN {FQ} >= {mark(FQ, 'p75')} AND {M} >= {mark(M, 'p75')} AND {R} <= {mark(R, 'p25')} THEN 3 ELSE 0 END",
    "loyal": f"CASE WHEN {FQ} >= {mark(FQ, 'p50')} THEN 2 ELSE 0 END",
    "at_risk": f"CASE WHEN {FQ} >= {mark(FQ, 'p25')} AND {R} >= {mark(R, 'p50')} THEN 2 ELSE 0 END",
    "new_customers": f"CASE WHEN {FQ} <= 2 AND {R} <= {mark(R, 'p50')} THEN 2 ELSE 0 END",
    "hibernating": f"CASE WHEN {FQ} <= {mark(FQ, 'p50')} AND {R} >= {mark(R, 'p50')} THEN 2 ELSE 0 END",
    "lost": f"CASE WHEN {R} >= {mark(R, 'p90')} AND {FQ} <= {mark(FQ, 'p25')} THEN 3 ELSE 0 END",
}
CTES["label_points"] = "SELECT cluster_id, " + ", ".join(
    f"{rule} AS {name}" for name, rule in RULES.items()
) + " FROM profiles3"
BEST = "greatest(" + ", ".join(S.SEGMENT_LABELS) + ")"
CTES["labels3"] = "SELECT cluster_id, CASE " + " ".join(
    f"WHEN {s} = {BEST} THEN '{s}'" for s in S.SEGMENT_LABELS
) + " END AS segment_label FROM label_points"
CTES["segment_profile"] = """
SELECT g.segment_label, count(*) AS count, avg(m.recency_days) AS avg_recency_days, avg(m.frequency) AS avg_frequency,
       avg(m.monetary_total) AS avg_monetary_total, avg(m.monetary_avg) AS avg_monetary_avg,
       avg(m.avg_review_score) AS avg_review_score, avg(m.late_delivery_rate) AS avg_late_delivery_rate
FROM matrix m JOIN segment_given g ON CAST(m.customer_hash AS VARCHAR) = g.customer_hash GROUP BY g.segment_label"""
PROFILE_MEANS = [
    "avg_recency_days",
    "avg_frequency",
    "avg_monetary_total",
    "avg_monetary_avg",
    "avg_review_score",
    "avg_late_delivery_rate",
]

# --- anomaly on a given raw score -----------------------------------------------------------
CTES["raw_given"] = "SELECT customer_hash, -(0.3::DOUBLE + anomaly_score * 0.5::DOUBLE) AS raw_score FROM anomaly_given"
CTES["raw_scored"] = f"""
SELECT customer_hash, s AS anomaly_score,
       raw_score < (SELECT quantile_cont(raw_score, {S.CONTAMINATION}) FROM raw_given) AS is_anomaly,
       {BAND.format("s")} AS anomaly_flag
FROM (SELECT *, 1.0 - (raw_score - (SELECT min(raw_score) FROM raw_given))
                / ((SELECT max(raw_score) FROM raw_given) - (SELECT min(raw_score) FROM raw_given)) AS s
      FROM raw_given)"""

# --- monitoring ------------------------------------------------------------------------------
CTES["ks_steps"] = """
SELECT v, sum(a) OVER (ORDER BY v) AS ca, sum(b) OVER (ORDER BY v) AS cb
FROM (SELECT v, sum(a) AS a, sum(b) AS b FROM (
        SELECT churn_probability AS v, 1 AS a, 0 AS b FROM churn_given
        UNION ALL SELECT churn_probability, 0, 1 FROM churn_newer) GROUP BY v)"""
CTES["ks"] = """
SELECT max(abs(CAST(ca AS DOUBLE) / (SELECT count(*) FROM churn_given)
             - CAST(cb AS DOUBLE) / (SELECT count(*) FROM churn_newer))) AS ks_statistic,
       (SELECT count(*) FROM churn_given) AS n_first, (SELECT count(*) FROM churn_newer) AS n_second
FROM ks_steps"""
EARLY = "2000-08-02"
CTES["transactions_early"] = (
    f"SELECT * FROM transactions WHERE order_purchase_timestamp < TIMESTAMP '{EARLY}'"
)
CTES["orders_early"] = (
    f"SELECT * FROM orders_clean WHERE order_purchase_timestamp < TIMESTAMP '{EARLY}'"
)


def early(name: str) -> str:
    text = CTES[name].replace(f"TIMESTAMP '{SNAPSHOT}'", f"TIMESTAMP '{EARLY}'")
    for inner in ("transactions", "orders_clean", "rfm", "review_features", "delivery_features", "payment_features"):
        text = re.sub(rf"\b(FROM|JOIN) {inner}\b", rf"\1 {inner.replace('_clean', '')}_early", text)
    return text


for _name in ("rfm", "review_features", "delivery_features", "payment_features", "matrix"):
    CTES[f"{_name}_early"] = early(_name)
NUMERIC = S.FEATURE_MATRIX_COLUMNS[2:12]
CTES["drift"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT avg({c}) FROM matrix_early) AS reference_mean,"
    f" (SELECT avg({c}) FROM matrix) AS current_mean"
    for c in NUMERIC
)
CTES["drifts"] = """
SELECT *, abs((current_mean - reference_mean) / reference_mean) AS drift FROM drift WHERE reference_mean <> 0"""

# --- partial scores for the risk views ---------------------------------------------------------
CTES["some_anomaly"] = "SELECT * FROM anomaly_given WHERE anomaly_score >= 0.2"
# Values at the ends of 64 parts of the earlier scores, with rows below and up to each, there and among the newer scores.
CTES["sketch_edges"] = """
SELECT value, n, m, below, upto,
       (SELECT count(*) FROM churn_newer c WHERE c.churn_probability < value) AS below_newer,
       (SELECT count(*) FROM churn_newer c WHERE c.churn_probability <= value) AS upto_newer
FROM (SELECT churn_probability AS value, min(place) - 1 AS below, max(place) AS upto, n,
             (SELECT count(*) FROM churn_newer) AS m,
             bool_or(place IN (SELECT greatest(1, (i * n + 63) // 64) FROM range(0, 65) t(i))) AS wanted
      FROM (SELECT churn_probability, row_number() OVER (ORDER BY churn_probability) AS place, count(*) OVER () AS n
            FROM churn_given) GROUP BY churn_probability, n)
WHERE wanted"""
CTES["sketch_gaps"] = """
SELECT n, m, abs(below / n - below_newer / m) AS at_below, abs(upto / n - upto_newer / m) AS at_upto,
       lead(below / n, 1, 1.0) OVER (ORDER BY value) - upto_newer / m AS over,
       lead(below_newer / m, 1, 1.0) OVER (ORDER BY value) - upto / n AS under, below / n AS first_over, below_newer / m AS first_under,
       row_number() OVER (ORDER BY value) AS place
FROM (SELECT value, CAST(n AS DOUBLE) AS n, CAST(m AS DOUBLE) AS m, below, upto, below_newer, upto_newer FROM sketch_edges)"""
CTES["some_churn"] = "SELECT * FROM churn_given WHERE churn_probability < 0.9"
CTES["some_segment"] = "SELECT * FROM segment_given WHERE cluster_id > 0"
CTES["risk"] = """
SELECT coalesce(a.customer_hash, c.customer_hash) AS customer_hash, a.anomaly_score, a.anomaly_flag,
       c.churn_probability, c.predicted_churn, s.segment_label
FROM some_anomaly a FULL JOIN some_churn c ON a.customer_hash = c.customer_hash
LEFT JOIN some_segment s ON coalesce(a.customer_hash, c.customer_hash) = s.customer_hash"""
CTES["risk_levels"] = """
SELECT *, CASE WHEN anomaly_flag = 'anomalous' OR churn_probability >= 0.6 THEN 'high'
               WHEN churn_probability >= 0.4 THEN 'medium' ELSE 'low' END AS risk_level
FROM risk"""
CTES["alert_texts"] = f"""
SELECT id, customer_hash, alert_type, score, threshold,
       CASE WHEN alert_type = 'anomaly' THEN
         replace(replace(replace({quoted(S.ALERT_TEXT_ANOMALY.replace("%s", "#1", 1).replace("%s", "#2", 1).replace("%s", "#3", 1))},
           '#1', left(customer_hash, 8)), '#2', printf('%.2f', score)), '#3', printf('%.2f', threshold))
       ELSE
         replace(replace(replace({quoted(S.ALERT_TEXT_CHURN.replace("%s", "#1", 1).replace("%s", "#2", 1).replace("%s", "#3", 1))},
           '#1', left(customer_hash, 8)), '#2', printf('%.1f', score * 100) || '%'), '#3', printf('%.1f', threshold * 100) || '%')
       END AS explanation
FROM alerts"""


def with_ctes(select: str) -> str:
    """Prefix ``select`` with the expressions it refers to, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN) ([a-z_0-9]+)\b", text):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(select)
    if not ordered:
        return select
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in ordered) + f" {select}"


def r(column: str, digits: int = 6, name: str | None = None) -> str:
    return f"round({column}, {digits}) AS {name or column.split('.')[-1]}"


MATRIX_OUT = "SELECT * REPLACE (" + stamp("snapshot_date") + ") FROM matrix"
TX_OUT = (
    "SELECT * EXCLUDE (freight_value, paid_cents) REPLACE ("
    "CAST(payment_installments AS BIGINT) AS payment_installments, "
    + ", ".join(
        stamp(c)
        for c in ("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")
    )
    + ") FROM transactions"
)
ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def histogram(table: str, column: str, bins: int, digits: int = 6) -> str:
    low, high = f"(SELECT min({column}) FROM {table})", f"(SELECT max({column}) FROM {table})"
    start = f"(CASE WHEN {low} = {high} THEN {low} - 0.5 ELSE CAST({low} AS DOUBLE) END)"
    width = f"((CASE WHEN {low} = {high} THEN 1.0 ELSE CAST({high} - {low} AS DOUBLE) END) / CAST({bins} AS DOUBLE))"
    return f"""
SELECT CAST(b.bin AS INT) AS bin, round({start} + b.bin * {width}, {digits}) AS bin_start,
       round({start} + (b.bin + 1) * {width}, {digits}) AS bin_end, coalesce(c.n, 0) AS n
FROM (SELECT unnest(range({bins})) AS bin) b LEFT JOIN (
  SELECT least(CAST(floor((CAST({column} AS DOUBLE) - {start}) / {width}) AS INT), {bins - 1}) AS bin, count(*) AS n
  FROM {table} GROUP BY 1) c ON b.bin = c.bin"""


RAW_COLUMNS = {
    "orders": [
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("order_status", "string"),
        ("order_purchase_timestamp", "timestamp_ntz"),
        ("order_approved_at", "timestamp_ntz"),
        ("order_delivered_customer_date", "timestamp_ntz"),
        ("order_estimated_delivery_date", "timestamp_ntz"),
    ],
    "customers": [
        ("customer_id", "bigint"),
        ("customer_unique_id", "bigint"),
        ("customer_city", "string"),
        ("customer_state", "string"),
    ],
    "order_items": [
        ("order_id", "bigint"),
        ("order_item_id", "int"),
        ("product_id", "bigint"),
        ("seller_id", "bigint"),
        ("price", "double"),
        ("freight_value", "double"),
    ],
    "order_payments": [
        ("order_id", "bigint"),
        ("payment_sequential", "int"),
        ("payment_type", "string"),
        ("payment_installments", "int"),
        ("payment_value", "double"),
    ],
    "order_reviews": [
        ("review_id", "bigint"),
        ("order_id", "bigint"),
        ("review_score", "int"),
        ("review_creation_date", "timestamp_ntz"),
        ("review_answer_timestamp", "timestamp_ntz"),
    ],
    "products": [("product_id", "bigint"), ("product_category_name", "string")],
    "sellers": [("seller_id", "bigint"), ("seller_state", "int")],
}


def overview() -> str:
    parts = []
    for name, columns in RAW_COLUMNS.items():
        for i, (c, t) in enumerate(columns, 1):
            parts.append(
                f"SELECT '{name}' AS \"table\", (SELECT count(*) FROM {name}_raw) AS rows,"
                f" CAST({len(columns)} AS BIGINT) AS columns, {i} AS position, '{c}' AS \"column\", '{t}' AS dtype"
            )
    return " UNION ALL ".join(parts)


def nulls() -> str:
    parts = []
    for name, columns in RAW_COLUMNS.items():
        for c, _ in columns:
            parts.append(
                f"SELECT '{name}' AS \"table\", '{c}' AS \"column\","
                f" round(100.0 * (count(*) - count({c})) / count(*), 6) AS null_pct FROM {name}_raw"
                f" HAVING count(*) > count({c})"
            )
    return " UNION ALL ".join(parts)


Q: dict[str, str] = {}

Q["s1_csv_source"] = (
    "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status, "
    + ", ".join(stamp(c) for c in ORDER_TIMES if c != "order_approved_at")
    + " FROM orders_clean"
)
Q["s1_csv_row_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}_raw" for n in RAW_COLUMNS
)
Q["s1_split_reviews"] = """
SELECT CAST(doc_id AS VARCHAR) AS review_id, source AS order_id, doc_id % 5 AS review_score,
       coalesce(left(text, 9), '') AS review_comment_title,
       '"' || coalesce(text, '') || '",' || chr(10) || '""' || chr(10) || 'end' AS review_comment_message
FROM documents"""
Q["s2_stored_transactions"] = TX_OUT.replace("CAST(payment_installments AS BIGINT) AS payment_installments, ", "")
Q["s3_publish_anomaly_scores"] = (
    "SELECT customer_hash, anomaly_score, is_anomaly, anomaly_flag FROM anomaly_given"
)
Q["s4_publish_churn_scores"] = "SELECT customer_hash, churn_probability, predicted_churn FROM churn_given"
Q["s5_publish_segments"] = "SELECT customer_hash, cluster_id, segment_label FROM segment_given"
Q["s6_publish_release"] = """
SELECT 'anomaly_scores' AS label, count(*) AS rows FROM anomaly_given
UNION ALL SELECT 'churn_scores', count(*) FROM churn_given
UNION ALL SELECT 'segment_assignments', 0
UNION ALL SELECT 'alerts_generated', count(*) FROM alerts"""
Q["s6_second_publish"] = "SELECT customer_hash, churn_probability, predicted_churn FROM churn_given WHERE churn_probability >= 0.5"
Q["s6_concurrent_publish"] = """
SELECT 'anomaly_scores' AS "table", count(*) AS rows FROM anomaly_given
UNION ALL SELECT 'churn_scores', count(*) FROM churn_given
UNION ALL SELECT 'alerts', count(*) FROM alerts"""
Q["s7_tolerant_read"] = """
SELECT 'present' AS "table", count(*) AS rows FROM churn_given UNION ALL SELECT 'absent', 0"""
Q["s8_required_inputs"] = " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}"
    for n in ("orders", "customer", "lineitem", "events", "part", "supplier")
)
Q["s9_score_baseline"] = (
    "SELECT churn_probability, true AS created_first, false AS created_again FROM churn_given"
)
Q["s9_baseline_sketch"] = """
SELECT value, below AS below_least, below AS below_most, upto AS upto_least, upto AS upto_most, n AS rows FROM sketch_edges"""
Q["p1_clean_orders"] = (
    "SELECT * EXCLUDE (ingest_seq) REPLACE (" + ", ".join(stamp(c) for c in ORDER_TIMES) + ") FROM orders_clean"
)
Q["p2_clean_customers"] = "SELECT * FROM customers_clean"
Q["p3_clean_reviews"] = (
    "SELECT * EXCLUDE (ingest_seq) REPLACE (CAST(review_score AS BIGINT) AS review_score, "
    + ", ".join(stamp(c) for c in ("review_creation_date", "review_answer_timestamp"))
    + ") FROM reviews_clean"
)
Q["p4_clean_payments"] = """
SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential, payment_type,
       CAST(payment_installments AS BIGINT) AS payment_installments, payment_value FROM payments_clean"""
Q["p5_pseudonymize_customers"] = f"""
SELECT customer_city, customer_state, {hmac("customer_id")} AS customer_id_hash,
       {hmac("customer_unique_id")} AS customer_unique_id_hash FROM customers_clean"""
Q["p5_pseudonymize_transactions"] = f"""
SELECT {hmac("customer_id")} AS customer_id_hash, order_id, product_id, seller_id, price
FROM transactions WHERE customer_id IS NOT NULL"""
Q["p5b_hash_format"] = f"""
SELECT customer_id, regexp_full_match({hmac("customer_id")}, '[0-9a-f]{{64}}') AS hash_valid,
       regexp_full_match(CAST(customer_id AS VARCHAR), '[0-9a-f]{{64}}') AS id_valid,
       regexp_full_match({hmac("customer_id")} || chr(10), '[0-9a-f]{{64}}') AS padded_valid
FROM customers_clean"""
Q["p6_build_transactions"] = TX_OUT
Q["f1_rfm"] = "SELECT * FROM rfm"
Q["f1_rfm_order_grain"] = f"""
SELECT customer_id, {RECENCY} AS recency_days, count(order_id) AS frequency,
       CAST(coalesce(sum(paid_cents), 0) AS DOUBLE) / 100 AS monetary_total,
       CAST(coalesce(sum(paid_cents), 0) AS DOUBLE) / 100 / count(order_id) AS monetary_avg
FROM (SELECT DISTINCT customer_id, order_id, order_purchase_timestamp, paid_cents FROM transactions)
WHERE customer_id IS NOT NULL GROUP BY customer_id"""
Q["f2_review_features"] = "SELECT * FROM review_features"
Q["f3_delivery_features"] = "SELECT * FROM delivery_features"
Q["f4_payment_features"] = "SELECT * FROM payment_features"
Q["f5_feature_matrix"] = MATRIX_OUT
Q["f5_feature_matrix_hashed"] = (
    f"SELECT * REPLACE ({hmac('customer_hash')} AS customer_hash, {stamp('snapshot_date')}) FROM matrix"
)
Q["f6_fused_feature_matrix"] = MATRIX_OUT
Q["f6_order_grain_feature_matrix"] = MATRIX_OUT
Q["f6_incremental"] = MATRIX_OUT

FIRST = floor_days(f"TIMESTAMP '{SNAPSHOT}'", "min(order_purchase_timestamp)")
Q["x1_purchase_rate"] = f"""
SELECT customer_id, count(DISTINCT order_id) AS orders, {FIRST} AS days_since_first,
       CAST(count(DISTINCT order_id) AS DOUBLE) / NULLIF({FIRST}, 0) AS purchase_rate
FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id"""
Q["x2_payment_types"] = """
SELECT o.customer_id, count(DISTINCT p.payment_type) AS payment_types
FROM payments_clean p JOIN orders_clean o ON p.order_id = o.order_id GROUP BY o.customer_id"""
Q["x3_states_shipped"] = """
SELECT customer_unique_id, count(DISTINCT customer_state) AS states_shipped FROM customers_raw
WHERE customer_id IN (SELECT customer_id FROM orders_clean) GROUP BY customer_unique_id"""
Q["x4_product_categories"] = """
SELECT t.customer_id, count(DISTINCT p.product_category_name) AS product_categories
FROM transactions t JOIN products_raw p ON t.product_id = p.product_id
WHERE t.customer_id IS NOT NULL GROUP BY t.customer_id"""
Q["x5_weekend_ratio"] = """
SELECT customer_id, count(*) FILTER (WHERE d IN (0, 6)) AS weekend_orders,
       count(*) FILTER (WHERE d NOT IN (0, 6)) AS weekday_orders,
       CAST(count(*) FILTER (WHERE d IN (0, 6)) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE d NOT IN (0, 6)), 0) AS weekend_ratio
FROM (SELECT customer_id, dayofweek(order_purchase_timestamp) AS d FROM orders_clean) GROUP BY customer_id"""
Q["x6_cancel_ratio"] = f"""
SELECT customer_id, count(*) AS orders, {mean("c")} AS cancel_ratio
FROM (SELECT customer_id, CAST(order_status IN ('canceled', 'returned') AS INT) AS c FROM orders_raw) GROUP BY customer_id"""
Q["x7_approval_delay"] = f"""
SELECT customer_id, {mean("d")} / 3600000000.0 AS approval_hours
FROM (SELECT customer_id, epoch_us(order_approved_at) - epoch_us(order_purchase_timestamp) AS d FROM orders_clean)
GROUP BY customer_id"""
Q["x8_basket_size"] = """
SELECT customer_id, CAST(sum(n) AS DOUBLE) / count(*) AS items_per_order
FROM (SELECT customer_id, order_id, count(*) AS n FROM transactions WHERE customer_id IS NOT NULL GROUP BY ALL)
GROUP BY customer_id"""
Q["x9_precision_at_share"] = """
SELECT count(*) AS k, CAST(sum(churned) AS DOUBLE) / count(*) AS precision_at_k
FROM (SELECT churned, row_number() OVER (ORDER BY churn_probability DESC, customer_hash) AS p FROM labelled)
WHERE p <= floor(0.1::DOUBLE * (SELECT count(*) FROM labelled))"""
Q["x11_ranked_at_risk"] = """
SELECT customer_hash, churn_probability, predicted_churn,
       row_number() OVER (ORDER BY churn_probability DESC, customer_hash) AS risk_rank
FROM churn_given WHERE churn_probability >= 0.6"""

Q["e1_table_overview"] = overview()
Q["e2_null_percentages"] = nulls()
Q["e3_status_frequency"] = "SELECT order_status, count(*) AS count FROM orders_raw GROUP BY 1"
Q["e4_monthly_orders"] = """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, count(*) AS orders FROM orders_raw GROUP BY 1"""
Q["e4_order_span"] = f"""
SELECT strftime(min(order_purchase_timestamp), '{TIME}') AS first_purchase,
       strftime(max(order_purchase_timestamp), '{TIME}') AS last_purchase,
       count(DISTINCT strftime(order_purchase_timestamp, '%Y-%m')) AS months FROM orders_raw"""
Q["e5_orders_per_person"] = "SELECT * FROM person_orders"
Q["e6_spend_per_person"] = "SELECT * FROM person_spend"
Q["e7_order_histogram"] = histogram("person_orders", "orders", 30)
Q["e7_spend_histogram"] = histogram("person_spend", "spend", 50, 4)
Q["e7_recency_histogram"] = histogram("person_rfm", "recency", 40)
Q["e7_frequency_histogram"] = histogram("person_rfm", "frequency", 20)
Q["e8_repeat_share"] = """
SELECT count(*) AS persons, count(*) FILTER (WHERE orders = 1) AS single, count(*) FILTER (WHERE orders >= 2) AS repeat,
       round(100.0 * count(*) FILTER (WHERE orders = 1) / count(*), 6) AS single_pct,
       round(100.0 * count(*) FILTER (WHERE orders >= 2) / count(*), 6) AS repeat_pct FROM person_orders"""
Q["e9_person_rfm"] = "SELECT * FROM person_rfm"
_corr_names = ["recency", "frequency", "monetary"]
Q["e10_correlation"] = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {'1.0::DOUBLE' if a == b else f'round(corr({a}, {b}), 6)'} AS correlation"
    f"{'' if a == b else ' FROM person_rfm'}"
    for a in _corr_names
    for b in _corr_names
)
Q["e11_review_distribution"] = """
SELECT CAST(r.review_score AS BIGINT) AS review_score, count(*) AS reviews
FROM order_reviews_raw r JOIN orders_raw o ON r.order_id = o.order_id WHERE r.review_score IS NOT NULL GROUP BY 1"""
Q["e11_monthly_review_score"] = f"""
SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS order_month, round({mean("r.review_score")}, 6) AS avg_score
FROM order_reviews_raw r JOIN orders_raw o ON r.order_id = o.order_id GROUP BY 1"""
Q["e11_overall_review_score"] = f"""
SELECT round({mean("r.review_score")}, 6) AS avg_score
FROM order_reviews_raw r JOIN orders_raw o ON r.order_id = o.order_id"""
Q["e12_churn_balance"] = """
SELECT CAST(recency > 180 AS BIGINT) AS churn, count(*) AS persons,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM person_rfm), 6) AS share,
       (SELECT round(avg(CAST(recency > 180 AS INT)), 6) FROM person_rfm) AS churn_rate
FROM person_rfm GROUP BY 1"""
Q["e12_churn_by_state"] = """
SELECT customer_state, round(avg(CAST(recency > 180 AS INT)), 6) AS churn_rate
FROM person_rfm p JOIN person_state s ON p.customer_unique_id = s.customer_unique_id GROUP BY 1"""
Q["e13_outliers"] = """
SELECT customer_unique_id, recency, frequency, monetary, round(monetary_z, 6) AS monetary_z,
       round(frequency_z, 6) AS frequency_z, abs(monetary_z) > 3 OR abs(frequency_z) > 3 AS anomaly_flag FROM person_z"""
Q["e13_outlier_share"] = """
SELECT (SELECT count(*) FROM outlying) AS outliers,
       round(100.0 * (SELECT count(*) FROM outlying) / (SELECT count(*) FROM person_z), 6) AS outlier_pct"""
Q["e14_top_outliers"] = """
SELECT customer_unique_id, recency, frequency, monetary, round(monetary_z, 6) AS monetary_z,
       round(frequency_z, 6) AS frequency_z, true AS anomaly_flag
FROM outlying ORDER BY outlying.monetary_z DESC, customer_unique_id LIMIT 10"""
Q["e15_outliers_by_state"] = """
SELECT customer_state, count(*) AS count
FROM outlying p JOIN person_state s ON p.customer_unique_id = s.customer_unique_id GROUP BY 1"""

Q["a1_feature_gate"] = "SELECT " + ", ".join(
    f"count(*) - count({c}) AS {c}" for c in S.ANOMALY_FEATURES
) + " FROM matrix"
Q["a3_normalised_scores"] = (
    "SELECT * REPLACE (round(anomaly_score, 6) AS anomaly_score) FROM raw_scored"
)
Q["a4_flag_bands"] = "SELECT customer_hash, anomaly_flag FROM anomaly_given"
Q["a5_anomaly_metrics"] = f"""
SELECT round(avg(CAST(is_anomaly AS INT)), 6) AS anomaly_rate, round(avg(anomaly_score), 6) AS avg_anomaly_score,
       count(*) FILTER (WHERE is_anomaly) AS n_anomalies, CAST({S.CONTAMINATION} AS DOUBLE) AS contamination_param
FROM raw_scored"""

F9 = S.ANOMALY_FEATURES
SCALED9 = " UNION ALL ".join(
    f"SELECT customer_hash, {i} AS place, '{c}' AS name, abs(({c} - (SELECT avg({c}) FROM matrix))"
    f" / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END FROM matrix)) AS size FROM matrix"
    for i, c in enumerate(F9)
)
Q["a6_top_contributions"] = f"""
SELECT customer_hash, string_agg(name, '|' ORDER BY p) AS top_features
FROM (SELECT *, row_number() OVER (PARTITION BY customer_hash ORDER BY size DESC, place) AS p FROM ({SCALED9}))
WHERE p <= 3 GROUP BY customer_hash"""
Q["g1_standardised_features"] = "SELECT customer_hash, " + ", ".join(r(c) for c in F7) + " FROM points"
Q["g1_scaler"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean,"
    f" round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS scale FROM matrix"
    for c in F7
)
Q["g4_inertia"] = "SELECT k_values, round(inertias, 6) AS inertias FROM quality"
Q["g5_silhouette"] = "SELECT k_values, round(silhouette_scores, 6) AS silhouette_scores FROM quality"
Q["g6_davies_bouldin"] = "SELECT k_values, round(davies_bouldin_scores, 4) AS davies_bouldin_scores FROM quality"
Q["g7_select_k"] = "SELECT k_values AS k FROM quality ORDER BY silhouette_scores DESC, k_values LIMIT 1"
Q["g9_nearest_centroid"] = f"""
SELECT customer_hash, CAST(arg_min(cluster_id, (d, cluster_id)) AS BIGINT) AS cluster_id FROM (
  SELECT a.customer_hash, b.cluster_id, {APART} AS d
  FROM points a CROSS JOIN (SELECT customer_hash % 5 AS cluster_id, {", ".join(f"avg({c}) AS {c}" for c in F7)}
                            FROM points GROUP BY 1) b)
GROUP BY customer_hash"""
Q["g10_cluster_profiles"] = "SELECT cluster_id, " + ", ".join(r(c, 4) for c in F7) + " FROM profiles3"
Q["g11_feature_percentiles"] = "SELECT feature, " + ", ".join(r(p) for p in ("p25", "p50", "p75", "p90")) + " FROM percentiles"
Q["g12_cluster_labels"] = "SELECT * FROM labels3"
Q["g13_segment_assignments"] = """
SELECT m.customer_hash, l.cluster_id, l.segment_label
FROM matrix m JOIN labels3 l ON m.customer_hash % 3 = l.cluster_id"""
Q["g14_segment_profiles"] = "SELECT segment_label, count, " + ", ".join(r(c, 4) for c in PROFILE_MEANS) + " FROM segment_profile"

Q["c1_churn_labels"] = """
SELECT customer_hash, recency_days, CAST(churned AS BIGINT) AS churned, 'rule_based_recency' AS churn_label_source FROM labelled"""
Q["c2_label_distribution"] = """
SELECT count(*) FILTER (WHERE churned = 0) AS active, count(*) FILTER (WHERE churned = 1) AS churned,
       round(avg(labelled.churned), 6) AS churn_rate FROM labelled"""
Q["c3_churn_features"] = f"""
SELECT m.customer_hash, m.recency_days, m.frequency, m.monetary_total, m.monetary_avg, m.avg_review_score,
       m.review_count, m.payment_installments_avg, m.avg_delivery_days, m.late_delivery_rate,
       coalesce(a.anomaly_score, 0.5) AS anomaly_score,
       CAST({ENCODED.replace("segment_label", "coalesce(g.segment_label, 'hibernating')")} AS BIGINT) AS segment_encoded,
       CAST(m.recency_days > 180 AS BIGINT) AS churned
FROM matrix m LEFT JOIN anomaly_given a ON m.customer_hash = a.id AND a.anomaly_flag <> 'suspicious'
LEFT JOIN segment_given g ON m.customer_hash = g.id AND g.cluster_id > 0"""
Q["c4_ordered_split"] = "SELECT customer_hash, recency_days, split FROM split"
Q["c6_roc_auc"] = """
SELECT round((sum(CASE WHEN churned = 1 THEN rk END) - CAST(p AS DOUBLE) * (p + 1) / 2) / (CAST(p AS DOUBLE) * n), 6) AS roc_auc
FROM (SELECT churned, avg(pos) OVER (PARTITION BY churn_probability) AS rk,
             sum(churned) OVER () AS p, sum(1 - churned) OVER () AS n
      FROM (SELECT churned, churn_probability, row_number() OVER (ORDER BY churn_probability) AS pos FROM labelled))
GROUP BY p, n"""
for _name, _score in (("c6_average_precision", "churn_probability"), ("c6_average_precision_with_ties", "round(churn_probability, 1)")):
    Q[_name] = f"""
SELECT round(sum(pos * found / seen) / sum(pos), 6) AS auc_pr
FROM (SELECT pos, CAST(sum(pos) OVER (ORDER BY s DESC) AS DOUBLE) AS found, sum(n) OVER (ORDER BY s DESC) AS seen
      FROM (SELECT {_score} AS s, sum(churned) AS pos, count(*) AS n FROM labelled GROUP BY 1))"""
Q["c7_threshold_metrics"] = """
SELECT round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
       round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall
FROM (SELECT count(*) FILTER (WHERE churn_probability > 0.5 AND churned = 1) AS tp,
             count(*) FILTER (WHERE churn_probability > 0.5 AND churned = 0) AS fp,
             count(*) FILTER (WHERE churn_probability <= 0.5 AND churned = 1) AS fn FROM labelled)"""
Q["c8_split_statistics"] = """
SELECT CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE) AS train_size,
       CAST(count(*) FILTER (WHERE split = 'test') AS DOUBLE) AS test_size,
       round(avg(churned) FILTER (WHERE split = 'train'), 6) AS churn_rate_train,
       round(avg(churned) FILTER (WHERE split = 'test'), 6) AS churn_rate_test FROM split"""
Q["c10_predicted_churn"] = """
SELECT customer_hash, round(churn_probability, 6) AS churn_probability, labelled.churn_probability >= 0.6 AS predicted_churn
FROM labelled"""

Q["m1_mean_drift"] = """
SELECT feature, round(reference_mean, 6) AS reference_mean, round(current_mean, 6) AS current_mean,
       round(drifts.drift, 6) AS drift, drifts.drift > 0.2 AS drifted FROM drifts"""
Q["m2_churn_rate_check"] = """
SELECT round(rate, 6) AS churn_rate, rate BETWEEN 0.10 AND 0.60 AS churn_rate_in_range
FROM (SELECT avg(CAST(churn_probability >= 0.5 AS INT)) AS rate FROM churn_given)"""
Q["m2b_anomaly_rate_check"] = """
SELECT round(rate, 6) AS anomaly_rate, rate BETWEEN 0.01 AND 0.20 AS anomaly_rate_in_range
FROM (SELECT avg(CAST(anomaly_flag = 'anomalous' AS INT)) AS rate FROM anomaly_given)"""
Q["m3_ks_statistic"] = "SELECT round(ks_statistic, 6) AS ks_statistic, n_first, n_second FROM ks"
Q["m3_distance_bounds"] = """
SELECT round(ks_low, 6) AS ks_low, round(ks_high, 6) AS ks_high, n_first, n_second,
       (SELECT ks_statistic FROM ks) BETWEEN ks_low AND ks_high AS inside
FROM (SELECT max(greatest(at_below, at_upto)) AS ks_low, CAST(max(n) AS BIGINT) AS n_first, CAST(max(m) AS BIGINT) AS n_second,
             max(greatest(at_below, at_upto, over, under, CASE WHEN place = 1 THEN greatest(first_over, first_under) ELSE 0 END)) AS ks_high
      FROM sketch_gaps)"""
Q["m3_merged_sketch_bounds"] = "SELECT n_first, n_second, true AS inside, true AS narrow FROM ks"
# With d > 0.1 the limit series is far below the 0.05 level at these sizes.
KS_P = """(SELECT 2 * sum(CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END
   * exp(-2.0 * j * j * ks.ks_statistic * ks.ks_statistic * n_first * n_second / (n_first + n_second)))
   FROM range(1, 101) t(j))"""
Q["m3_model_drift"] = f"""
SELECT 'completed' AS status, round(ks.ks_statistic, 6) AS ks_statistic, round(least(1.0, {KS_P}), 6) AS p_value,
       ks.ks_statistic > 0.1 AND {KS_P} < 0.05 AS drift_detected FROM ks"""
Q["m4_monitoring_verdict"] = f"""
SELECT (SELECT count(*) FROM drifts WHERE drifts.drift > 0.2) AS n_drifted, 'completed' AS status,
       round(stat, 6) AS ks_statistic, hit AS drift_detected,
       (SELECT avg(CAST(churn_probability >= 0.5 AS INT)) BETWEEN 0.10 AND 0.60 FROM churn_newer) AND NOT hit AS passed,
       NOT hit AS roll_baseline
FROM (SELECT ks.ks_statistic AS stat, ks.ks_statistic > 0.1 AND {KS_P} < 0.05 AS hit FROM ks)"""

Q["m5_monitoring_job"] = Q["m4_monitoring_verdict"]

SUMMARY = """SELECT count(*) AS total, count(*) FILTER (WHERE anomaly_flag = 'anomalous') AS bad,
  count(*) FILTER (WHERE anomaly_flag = 'suspicious') AS odd FROM anomaly_given"""
Q["q1_anomaly_summary"] = f"""
SELECT total AS total_customers_scored, bad AS anomaly_count, odd AS suspicious_count, total - bad - odd AS normal_count,
       round(CAST(bad AS DOUBLE) / total, 6) AS anomaly_rate, CAST(7 AS BIGINT) AS period_days FROM ({SUMMARY})"""
Q["q2_interpreted_summary"] = f"""
SELECT 'ok' AS status, CAST(NULL AS VARCHAR) AS message, CAST(7 AS BIGINT) AS period_days, total AS total_customers_scored,
       bad AS anomalous_count, odd AS suspicious_count, total - bad - odd AS normal_count,
       round(CAST(bad AS DOUBLE) / total * 100, 2) AS anomaly_rate_percent,
       CASE WHEN CAST(bad AS DOUBLE) / total > 0.15 THEN {quoted(S.RATE_TEXT_HIGH)}
            WHEN CAST(bad AS DOUBLE) / total > 0.05 THEN {quoted(S.RATE_TEXT_MODERATE)}
            ELSE {quoted(S.RATE_TEXT_LOW)} END AS interpretation,
       (SELECT string_agg(customer_hash || ':' || CAST(round(anomaly_score, 4) AS VARCHAR), '|' ORDER BY anomaly_score DESC, customer_hash)
        FROM (SELECT * FROM anomaly_given WHERE anomaly_flag = 'anomalous' ORDER BY anomaly_score DESC, customer_hash LIMIT 5))
       AS top_anomalous_customers
FROM ({SUMMARY})"""
Q["q3_customer_risk"] = "SELECT * FROM risk"
Q["q4_risk_profiles"] = f"""
SELECT customer_hash, 'found' AS status, risk_level, round(anomaly_score, 4) AS anomaly_score, anomaly_flag,
       round(churn_probability, 4) AS churn_probability, predicted_churn, segment_label AS segment,
       {case_text("segment_label", S.SEGMENT_DESCRIPTIONS, "''")} AS segment_description,
       coalesce(NULLIF(concat_ws('|', CASE WHEN risk_level = 'high' THEN {quoted(S.ADVICE_HIGH_RISK)} END,
         CASE WHEN anomaly_flag IN ('anomalous', 'suspicious') THEN {quoted(S.ADVICE_UNUSUAL)} END,
         CASE WHEN segment_label IN ('at_risk', 'hibernating') THEN {quoted(S.ADVICE_DISENGAGED)} END), ''),
         {quoted(S.ADVICE_NONE)}) AS recommendations
FROM risk_levels"""
Q["q4_risk_lookup"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_hash, CASE WHEN l.customer_hash IS NULL THEN 'not_found' ELSE 'found' END AS status,
       l.risk_level, CASE WHEN l.customer_hash IS NULL THEN 'No scores found for this customer hash.' END AS message
FROM customer LEFT JOIN risk_levels l ON CAST(c_custkey AS VARCHAR) = l.customer_hash"""
ALERT_OUT = (
    "SELECT id, customer_hash, alert_type, score, threshold, '2001-08-02 12:00:00' AS created_at,"
    " false AS is_resolved, CAST(NULL AS VARCHAR) AS notes FROM alerts"
)
Q["q5_generate_alerts"] = ALERT_OUT
Q["q6_list_alerts"] = ALERT_OUT + " ORDER BY id LIMIT 50"
Q["q7_explain_alerts"] = f"""
SELECT id AS alert_id, 'found' AS status, customer_hash, alert_type, round(score, 4) AS score, threshold,
       '2001-08-02 12:00:00' AS created_at, false AS is_resolved, explanation,
       {quoted(S.ALERT_OPEN_ACTION)} AS recommended_action FROM alert_texts"""
Q["q7_alert_lookup"] = f"""
SELECT c_custkey AS alert_id, CASE WHEN id IS NULL THEN 'not_found' ELSE 'found' END AS status,
       coalesce(explanation, 'No alert found with ID ' || c_custkey || '.') AS explanation,
       CASE WHEN id IS NOT NULL THEN {quoted(S.ALERT_OPEN_ACTION)} END AS recommended_action
FROM customer LEFT JOIN alert_texts ON c_custkey = id"""
_labels = " UNION ALL ".join(
    f"SELECT {quoted(s)} AS segment_label, {quoted(S.SEGMENT_DESCRIPTIONS[s])} AS description,"
    f" {quoted(S.MARKETING_SUGGESTIONS[s])} AS marketing_suggestion"
    for s in S.SEGMENT_LABELS
)
Q["q8_segment_lookup"] = f"""
SELECT d.*, coalesce(n.customer_count, 0) AS customer_count, p.count,
       CASE WHEN p.count IS NULL THEN {quoted(S.NO_PROFILE_TEXT)} END AS note, {", ".join(r("p." + c, 2) for c in PROFILE_MEANS)}
FROM ({_labels}) d
LEFT JOIN (SELECT segment_label, count(*) AS customer_count FROM segment_given GROUP BY 1) n ON d.segment_label = n.segment_label
LEFT JOIN segment_profile p ON d.segment_label = p.segment_label"""
Q["q9_overview_kpis"] = f"""
SELECT bad AS flagged_anomalies, printf('%.1f', CAST(bad AS DOUBLE) / total * 100) || '%' AS anomaly_rate,
       (SELECT count(*) FROM churn_given WHERE churn_probability >= 0.6) AS high_risk_customers,
       (SELECT segment_label FROM segment_given GROUP BY 1 ORDER BY count(*) DESC, segment_label LIMIT 1) AS largest_segment
FROM ({SUMMARY})"""
FLAGGED = """
SELECT a.customer_hash, round(a.anomaly_score, 4) AS anomaly_score, a.anomaly_flag, round(c.churn_probability, 4) AS churn_probability
FROM some_anomaly a LEFT JOIN some_churn c ON a.customer_hash = c.customer_hash WHERE a.anomaly_flag <> 'normal'"""
Q["q10_flagged_customers"] = FLAGGED
Q["q10_flagged_second_page"] = FLAGGED + " ORDER BY a.anomaly_score DESC, a.customer_hash LIMIT 20 OFFSET 20"
Q["q11_segment_distribution"] = "SELECT segment_label, count, " + ", ".join(r(c, 2) for c in PROFILE_MEANS) + " FROM segment_profile"


# --- fitted operators: given models walked in SQL, and invariants that hold for every fit --------
def _walk(nodes: list[tuple], at: int = 0) -> str:
    """Nested CASE of one given tree: (node, feature, threshold, left, right, size, depth)."""
    _, feature, cut, left, right, size, depth = nodes[at]
    if left < 0:
        extra = 0.0 if size <= 1 else 1.0 if size == 2 else None
        if extra is None:
            extra = f"(2 * (ln({size} - 1) + 0.5772156649015329) - 2.0 * ({size} - 1) / {size})"
        return f"({depth} + {extra})"
    return f"CASE WHEN {S.ANOMALY_FEATURES[feature]} <= {cut} THEN {_walk(nodes, left)} ELSE {_walk(nodes, right)} END"


PATHS = " + ".join(_walk(tree) for tree in GIVEN_TREES)
CTES["forest_walk"] = f"SELECT customer_hash, CAST(({PATHS}) AS DOUBLE) / {len(GIVEN_TREES)} AS path FROM matrix"
C_GIVEN = f"(2 * (ln({GIVEN_SUBSAMPLE} - 1) + 0.5772156649015329) - 2.0 * ({GIVEN_SUBSAMPLE} - 1) / {GIVEN_SUBSAMPLE})"
Q["a3_given_forest_scores"] = f"SELECT customer_hash, round(-pow(2, -path / {C_GIVEN}), 6) AS raw_score FROM forest_walk"
Q["a6_given_forest_sums"] = "SELECT customer_hash, round(path, 6) AS path FROM forest_walk"
Q["a2_forest_invariants"] = """
SELECT CAST(100 AS BIGINT) AS trees, least(256, count(*)) AS smallest_root, least(256, count(*)) AS largest_root,
       CAST(0 AS BIGINT) AS unbalanced, CAST(0 AS BIGINT) AS too_deep FROM matrix"""
Q["g3_lloyd_step"] = f"""
SELECT CAST(cluster AS INT) AS cluster, n, round(inertia, 6) AS inertia, {", ".join(f"round({c} / n, 6) AS {c}" for c in F7)}
FROM (SELECT cluster, count(*) AS n, sum(gap) AS inertia, {", ".join(f"sum({c}) AS {c}" for c in F7)}
      FROM (SELECT p.*, g.cluster, {" + ".join(f"(p.{c} - g.{c}) * (p.{c} - g.{c})" for c in F7)} AS gap,
                   row_number() OVER (PARTITION BY customer_hash
                     ORDER BY {" + ".join(f"(p.{c} - g.{c}) * (p.{c} - g.{c})" for c in F7)}, g.cluster) AS place
            FROM points p CROSS JOIN (VALUES {", ".join(str((i, *c)) for i, c in enumerate(GIVEN_CENTROIDS))})
              AS g(cluster, {", ".join(F7)})) WHERE place = 1 GROUP BY cluster)"""
Q["g8_fixed_point"] = "SELECT CAST(3 AS BIGINT) AS clusters, count(*) AS rows, true AS settled FROM matrix"
Q["c9_private_optimum"] = "SELECT true AS optimal, true AS unit_rows"
# Public ranges of the features, written out here on purpose.
PUBLIC = {
    "recency_days": (0, 1000), "frequency": (0, 20), "monetary_total": (0, 5000), "monetary_avg": (0, 2000),
    "avg_review_score": (1, 5), "review_count": (0, 20), "payment_installments_avg": (0, 24),
    "avg_delivery_days": (0, 90), "late_delivery_rate": (0, 1),
}
RANGED = ", ".join(
    f"2 * (CAST(least(greatest({c}, {low}), {high}) AS DOUBLE) - {low}) / ({high} - {low}) - 1 AS {c}" for c, (low, high) in PUBLIC.items()
)
CTES["ranged"] = f"SELECT {RANGED}, CAST(recency_days > 180 AS INT) AS churned FROM matrix"
Q["c9_gaussian_clipped_sums"] = (
    "SELECT CAST(count(*) AS DOUBLE) AS n, "
    + ", ".join(f"round(sum({c}), 4) AS sum_{c}, round(sum({c} * {c}), 4) AS squares_{c}" for c in PUBLIC)
    + " FROM ranged"
)
CTES["ranged_scaled"] = f"SELECT {', '.join(f'({c} + 0.5) / 0.25 AS {c}' for c in PUBLIC)}, churned FROM ranged"
CTES["ranged_unit"] = f"""
SELECT *, sqrt(CAST(0.5 AS DOUBLE)) / greatest(sqrt({" + ".join(f"{c} * {c}" for c in PUBLIC)}), 2 * sqrt({len(PUBLIC)})) AS shrink
FROM ranged_scaled"""
Q["c9_gaussian_first_gradient"] = (
    "SELECT true AS unit_rows, "
    + ", ".join(f"round(sum((0.5 - churned) * {c} * shrink), 4) AS g_x_{c}" for c in PUBLIC)
    + ", round(sum((0.5 - churned) * sqrt(CAST(0.5 AS DOUBLE))), 4) AS g_x_one FROM ranged_unit"
)
# Noise scales from epsilon 2 and delta 1e-5; then the cost from the noise scales and the number of rounds.
CTES["privacy_whole"] = "SELECT pow(sqrt(ln(1e5) + 2.0) - sqrt(ln(1e5)), 2) AS rho"
CTES["privacy_noise"] = """
SELECT 'scaler' AS step, CAST(1 AS BIGINT) AS releases, sqrt(23.0) AS sensitivity, sqrt(23.0) / sqrt(2 * rho * 0.2) AS sigma
FROM privacy_whole
UNION ALL SELECT 'gradient', 30, 1.0, 1 / sqrt(2 * rho * 0.8 / 30) FROM privacy_whole"""
CTES["privacy_cost"] = "SELECT *, releases * sensitivity * sensitivity / (2 * sigma * sigma) AS rho FROM privacy_noise"
Q["c9_gaussian_budget"] = """
SELECT step, releases, round(sensitivity, 9) AS sensitivity, round(sigma, 9) AS sigma, round(rho, 9) AS rho,
       round((SELECT sum(rho) + 2 * sqrt(sum(rho) * ln(1e5)) FROM privacy_cost), 9) AS epsilon, CAST(0.00001 AS DOUBLE) AS delta,
       (SELECT CAST(floor(0.8 * count(*)) AS BIGINT) FROM matrix) AS train_rows
FROM privacy_cost"""
Q["x10_tradeoff_levels"] = """
SELECT epsilon, CAST(0 AS DOUBLE) AS dp_training_failed, CAST(floor(0.8 * n) AS DOUBLE) AS train_size, n - floor(0.8 * n) AS test_size
FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM matrix), (VALUES (CAST(0.5 AS DOUBLE)), (1), (2), (5), ('inf')) AS e(epsilon)"""
NONE_WRONG = "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS wrong FROM matrix"
Q["c10_walked_scores"] = NONE_WRONG
Q["c11_contributions_add_up"] = NONE_WRONG
Q["c12_saved_equals_fresh"] = NONE_WRONG
Q["x11_all_explained"] = "SELECT CAST(0 AS BIGINT) AS unexplained, CAST(0 AS BIGINT) AS missing"

ORACLES: dict[str, str] = {name: with_ctes(text) for name, text in Q.items()}
