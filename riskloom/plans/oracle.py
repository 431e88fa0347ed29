"""DuckDB SQL used as an independent oracle for the registered Spark queries.

Each text runs on the driver's parquet tables (registered as views under their table
names), written from the column definitions with DuckDB's own aggregates.
Floating outputs are rounded to 6 decimals on both sides (sums differ in the last bits
with evaluation order).
"""

from __future__ import annotations

AS_OF = "2024-02-15"
HISTORY_DATES = ["2024-01-10", "2024-01-20", "2024-01-30"]

ADAPTER = """
base AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type AS et, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, r.r_name, c.c_mktsegment
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
replay AS (
  SELECT event_id, ts, user_id, et, value, k, r_name, c_mktsegment FROM base
  UNION ALL
  SELECT event_id, ts - INTERVAL 1 HOUR, user_id, et, value + 1000, k, r_name, c_mktsegment
  FROM base WHERE event_id % 20 = 0),
cdc AS (
  SELECT event_id, ts AS event_timestamp, user_id AS customer_id,
    CASE et WHEN 'purchase' THEN 'transaction' WHEN 'signup' THEN 'membership_renewal'
            WHEN 'click' THEN 'campaign_action' WHEN 'view' THEN 'email_engagement'
            ELSE 'contact_request' END AS event_type,
    r_name AS region, c_mktsegment AS membership_tier,
    CASE WHEN k % 17 = 0 THEN NULL ELSE value END AS monthly_transaction,
    CASE WHEN user_id % 12 = 5 THEN (CASE WHEN k % 2 = 0 THEN 'failed' ELSE 'pending' END)
         WHEN k % 3 = 0 THEN 'success' WHEN k % 3 = 1 THEN 'failed' ELSE 'pending' END AS payment_status,
    CAST(CASE WHEN k % 13 = 0 THEN NULL ELSE k % 7 END AS BIGINT) AS payment_attempts_last_30d,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE k / CAST(100.0 AS DOUBLE) END AS engagement_score,
    CAST(CASE WHEN user_id % 33 = 0 THEN NULL ELSE 100 + user_id END AS BIGINT) AS member_since_days,
    CAST(CASE WHEN k % 11 = 0 THEN NULL ELSE k % 5 END AS BIGINT) AS contact_requests_last_30d,
    (user_id + k) % 4 = 0 AS churned,
    CASE (user_id + k) % 6 WHEN 0 THEN 'email' WHEN 1 THEN 'web' WHEN 2 THEN 'mobile'
         WHEN 3 THEN 'direct_mail' WHEN 4 THEN 'in_person' ELSE 'phone' END AS channel,
    CASE WHEN k = 9 THEN TRUE WHEN k = 10 THEN NULL ELSE FALSE END AS anomaly_injected
  FROM replay)"""

# The newest copy of each clean event; four columns are filled, two stay NULL.
STAGING = """
newest AS (
  SELECT event_id, arg_max(cdc, event_timestamp) AS e FROM cdc
  WHERE anomaly_injected IS DISTINCT FROM TRUE GROUP BY event_id),
stg AS (
  SELECT event_id, e.event_timestamp, e.customer_id, e.event_type, e.region, e.membership_tier, e.payment_status,
    e.engagement_score, e.member_since_days, e.channel, ifnull(e.churned, FALSE) AS churned,
    ifnull(e.monthly_transaction, 0.0) AS monthly_transaction,
    ifnull(e.payment_attempts_last_30d, 0) AS payment_attempts_last_30d,
    ifnull(e.contact_requests_last_30d, 0) AS contact_requests_last_30d
  FROM newest)"""


def _mean(column: str, days: int) -> str:
    return f"avg({column}) FILTER (WHERE age <= {days})"


def _events(days: int, more: str = "TRUE") -> str:
    return f"count(*) FILTER (WHERE age <= {days} AND {more})"


def _share(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif({whole}, 0)"


def features_cte(name: str, as_of: str, replay: bool = False, source: str = "stg") -> str:
    """customer_features of one date from the column definitions: one grouped pass over the events
    with their age in days, and a count by channel for the preferred one."""
    failed = "payment_status = 'failed'"
    columns = {
        "membership_tier": "last.membership_tier",
        "region": "last.region",
        "member_since_days": "last.member_since_days",
        "contact_requests_last_30d": "last.contact_requests_last_30d",
        "churned": "last.churned",
        "latest_event_ts": "last.event_timestamp",
    }
    sums = {
        **{f"avg_transaction_{d}d": _mean("monthly_transaction", d) for d in (30, 90)},
        **{f"avg_engagement_{d}d": _mean("engagement_score", d) for d in (30, 90)},
        **{f"payment_failure_rate_{d}d": _share(_events(d, failed), _events(d)) for d in (30, 90)},
        **{f"events_last_{d}d": _events(d) for d in (30, 90)},
        "total_events": "count(*)",
        "total_payment_attempts": "CAST(sum(payment_attempts_last_30d) FILTER (WHERE age <= 90) AS BIGINT)",
        "days_since_last_successful_payment": "CAST(if(bool_or(payment_status = 'success'), least(min(age) FILTER (WHERE payment_status = 'success'), 30), NULL) AS INTEGER)",
        "campaign_participation_rate": _share("count(*) FILTER (WHERE event_type = 'campaign_action')", "count(*)"),
        "renewal_count": _events(90, "event_type = 'membership_renewal'"),
    }
    until = f"WHERE CAST(event_timestamp AS DATE) <= DATE '{as_of}'" if replay else ""
    return f"""
{name}_e AS (SELECT *, date_diff('day', CAST(event_timestamp AS DATE), DATE '{as_of}') AS age FROM {source} {until}),
{name}_by AS (SELECT customer_id, channel, count(*) AS n FROM {name}_e GROUP BY customer_id, channel),
{name}_pref AS (SELECT customer_id, arg_min(channel, ROW(-n, channel)) AS preferred_channel FROM {name}_by GROUP BY customer_id),
{name}_sum AS (
  SELECT customer_id, arg_max({name}_e, ROW(event_timestamp, event_id)) AS last,
    {", ".join(f"{v} AS {k}" for k, v in sums.items())}
  FROM {name}_e GROUP BY customer_id),
{name} AS (
  SELECT customer_id, {", ".join(f"{v} AS {k}" for k, v in columns.items())}, {", ".join(sums)}, preferred_channel,
    TIMESTAMP '{as_of} 02:00:00' AS feature_computed_at, DATE '{as_of}' AS snapshot_date
  FROM {name}_sum JOIN {name}_pref USING (customer_id))"""


def history_cte() -> str:
    parts = [features_cte(f"fh{i}", d, replay=True) for i, d in enumerate(HISTORY_DATES)]
    union = " UNION ALL ".join(f"SELECT * FROM fh{i}" for i in range(len(HISTORY_DATES)))
    return ",".join(parts) + f",\nfeature_history AS ({union})"


PREDICTIONS = """
predictions AS (
  SELECT customer_id,
    ((customer_id * 7919 + dayofyear(snapshot_date) * 104729) % 1000) / 1000.0::DOUBLE AS churn_probability,
    CASE WHEN snapshot_date >= DATE '2024-01-25' THEN 'churn-v2' ELSE 'churn-v1' END AS model_version,
    snapshot_date,
    CAST(snapshot_date AS TIMESTAMP) + INTERVAL 3 HOUR AS predicted_at
  FROM feature_history),
scored AS (
  SELECT customer_id,
    churn_probability,
    churn_probability >= CASE model_version WHEN 'churn-v2' THEN 0.45 ELSE 0.5 END AS churn_prediction,
    model_version, snapshot_date, predicted_at
  FROM predictions)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n" + body


def base_ctes(as_of: str = AS_OF) -> list[str]:
    return [ADAPTER, STAGING, features_cte("features", as_of)]


# --------------------------------------------------------------------------------------
# Drift (baseline + PSI) in the reference's own terms: quantile_cont deciles, list filter
# binning, frequency tables, full outer join of buckets.
# --------------------------------------------------------------------------------------

NULL_BUCKET = 1000000
DECILES = "[" + ", ".join(f"{i / 10:.1f}" for i in range(11)) + "]"


def _melt(src: str, cols: list[str], typ: str) -> str:
    if typ == "DOUBLE":
        sel = "CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END"
    else:
        sel = "CAST({c} AS VARCHAR)"
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {sel.format(c=c)} AS value FROM {src}" for c in cols)


def baseline_ctes(p: str, src: str, numeric: list[str], categorical: list[str], track_nulls: bool = True) -> str:
    """CTE ``{p}`` = baseline bucket table of ``src`` (same columns as the Spark one)."""
    ctes = []
    parts = []
    nr = "CASE WHEN n_rows > 0 THEN (n_rows - n_present) / CAST(n_rows AS DOUBLE) ELSE 0.0 END"
    some_nulls = "(null_rate > 0 AND null_rate < 1)"
    null_rate_out = "null_rate" if track_nulls else "CAST(NULL AS DOUBLE)"
    if categorical:
        ctes.append(f"{p}_mc AS ({_melt(src, categorical, 'VARCHAR')})")
        ctes.append(
            f"{p}_pc AS (SELECT feature, n_rows, n_present, {nr} AS null_rate FROM "
            f"(SELECT feature, COUNT(*) AS n_rows, COUNT(value) AS n_present FROM {p}_mc GROUP BY feature))"
        )
        ctes.append(f"{p}_vc AS (SELECT feature, value, COUNT(*) AS cnt FROM {p}_mc WHERE value IS NOT NULL GROUP BY feature, value)")
        ctes.append(
            f"{p}_cm AS (SELECT pc.*, CAST(COALESCE(nd, 0) AS INTEGER) AS value_cardinality, "
            f"(COALESCE(nd, 0) > 1 OR {some_nulls}) AS monitored FROM {p}_pc pc "
            f"LEFT JOIN (SELECT feature, COUNT(*) AS nd FROM {p}_vc GROUP BY feature) USING (feature))"
        )
        parts.append(
            f"SELECT v.feature, 'categorical' AS kind, CAST(ROW_NUMBER() OVER (PARTITION BY v.feature ORDER BY cnt DESC, value) AS INTEGER) AS bucket, "
            f"value AS bucket_key, CAST(NULL AS DOUBLE) AS bucket_value, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, "
            f"cnt / CAST(n_present AS DOUBLE) AS expected, {null_rate_out} AS null_rate, monitored, value_cardinality, n_rows "
            f"FROM {p}_vc v JOIN {p}_cm m USING (feature)"
        )
        if track_nulls:
            parts.append(
                f"SELECT feature, 'categorical', {NULL_BUCKET}, '__null__', NULL, NULL, NULL, null_rate, null_rate, monitored, value_cardinality, n_rows FROM {p}_cm"
            )
    if numeric:
        ctes.append(f"{p}_mn AS ({_melt(src, numeric, 'DOUBLE')})")
        ctes.append(
            f"{p}_pn AS (SELECT feature, n_rows, n_present, {nr} AS null_rate FROM "
            f"(SELECT feature, COUNT(*) AS n_rows, COUNT(value) AS n_present FROM {p}_mn GROUP BY feature))"
        )
        ctes.append(f"{p}_vn AS (SELECT feature, value, COUNT(*) AS cnt FROM {p}_mn WHERE value IS NOT NULL GROUP BY feature, value)")
        ctes.append(
            f"{p}_kn AS (SELECT pn.*, COALESCE(nd, 0) AS nd, CASE WHEN COALESCE(nd, 0) <= 20 THEN 'discrete' ELSE 'numeric' END AS kind "
            f"FROM {p}_pn pn LEFT JOIN (SELECT feature, COUNT(*) AS nd FROM {p}_vn GROUP BY feature) USING (feature))"
        )
        ctes.append(
            f"{p}_dm AS (SELECT *, CAST(nd AS INTEGER) AS value_cardinality, "
            f"CASE WHEN n_present = 0 THEN FALSE ELSE (nd > 1 OR {some_nulls}) END AS monitored FROM {p}_kn WHERE kind = 'discrete')"
        )
        ctes.append(
            f"{p}_u AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {DECILES}))) AS u FROM {p}_mn "
            f"WHERE value IS NOT NULL AND feature IN (SELECT feature FROM {p}_kn WHERE kind = 'numeric') GROUP BY feature)"
        )
        ctes.append(
            f"{p}_edges AS (SELECT feature, CASE WHEN len(u) < 2 THEN ['-inf'::DOUBLE, 'inf'::DOUBLE] "
            f"ELSE list_concat(['-inf'::DOUBLE], u[2:len(u)-1], ['inf'::DOUBLE]) END AS edges FROM {p}_u)"
        )
        ctes.append(
            f"{p}_nm AS (SELECT k.*, e.edges, CAST(len(e.edges) - 1 AS INTEGER) AS value_cardinality, "
            f"(len(e.edges) > 2 OR {some_nulls}) AS monitored FROM {p}_kn k JOIN {p}_edges e USING (feature))"
        )
        ctes.append(
            f"{p}_nb AS (SELECT feature, len(list_filter(edges[2:len(edges)-1], lambda e: value >= e)) AS bucket, COUNT(*) AS cnt "
            f"FROM {p}_mn JOIN {p}_edges USING (feature) WHERE value IS NOT NULL GROUP BY ALL)"
        )
        ctes.append(
            f"{p}_slots AS (SELECT feature, CAST(b AS INTEGER) AS bucket, edges[b + 1] AS lo, edges[b + 2] AS hi, null_rate, monitored, value_cardinality, n_rows "
            f"FROM (SELECT *, unnest(range(0, len(edges) - 1)) AS b FROM {p}_nm))"
        )
        parts.append(
            f"SELECT v.feature, 'discrete', CAST(ROW_NUMBER() OVER (PARTITION BY v.feature ORDER BY cnt DESC, value) AS INTEGER), "
            f"NULL, value, NULL, NULL, cnt / CAST(n_present AS DOUBLE), {null_rate_out}, monitored, value_cardinality, n_rows "
            f"FROM {p}_vn v JOIN {p}_dm m USING (feature)"
        )
        parts.append(
            f"SELECT s.feature, 'numeric', s.bucket, NULL, NULL, lo, hi, "
            f"COALESCE(cnt, 0) / CAST(GREATEST(SUM(COALESCE(cnt, 0)) OVER (PARTITION BY s.feature), 1) AS DOUBLE), "
            f"{null_rate_out}, monitored, value_cardinality, n_rows FROM {p}_slots s LEFT JOIN {p}_nb nb USING (feature, bucket)"
        )
        if track_nulls:
            parts.append(
                f"SELECT feature, 'discrete', {NULL_BUCKET}, '__null__', NULL, NULL, NULL, null_rate, null_rate, monitored, value_cardinality, n_rows FROM {p}_dm"
            )
            parts.append(
                f"SELECT feature, 'numeric', {NULL_BUCKET}, '__null__', NULL, NULL, NULL, null_rate, null_rate, monitored, value_cardinality, n_rows FROM {p}_nm"
            )
    cols = "feature, kind, bucket, bucket_key, bucket_value, lo, hi, expected, null_rate, monitored, value_cardinality, n_rows"
    ctes.append(f"{p} AS (SELECT * FROM ({' UNION ALL '.join(parts)}) AS _u({cols}))")
    return ",\n".join(ctes)


def psi_ctes(p: str, b: str, src: str, numeric: list[str], categorical: list[str]) -> str:
    """CTE ``{p}`` = PSI per feature of ``src`` against baseline CTE ``{b}``."""
    ctes = []
    melts = []
    if numeric:
        ctes.append(f"{p}_mn AS ({_melt(src, numeric, 'DOUBLE')})")
        melts.append(f"SELECT feature, COUNT(*) AS n_rows, COUNT(value) AS n_present FROM {p}_mn GROUP BY feature")
    if categorical:
        ctes.append(f"{p}_mc AS ({_melt(src, categorical, 'VARCHAR')})")
        melts.append(f"SELECT feature, COUNT(*) AS n_rows, COUNT(value) AS n_present FROM {p}_mc GROUP BY feature")
    ctes.append(
        f"{p}_prof AS (SELECT feature, n_rows, CASE WHEN n_rows > 0 THEN (n_rows - n_present) / CAST(n_rows AS DOUBLE) ELSE 0.0 END AS c_null_rate "
        f"FROM ({' UNION ALL '.join(melts)}))"
    )
    ctes.append(
        f"{p}_meta AS (SELECT bb.feature, ANY_VALUE(bb.kind) AS kind, MAX(bb.null_rate) AS b_null_rate, BOOL_OR(bb.null_rate IS NOT NULL) AS tracks_nulls, "
        f"CASE WHEN ANY_VALUE(bb.kind) = 'numeric' AND BOOL_OR(bb.bucket <> {NULL_BUCKET} AND bb.expected IS NULL) THEN FALSE "
        f"ELSE COALESCE(BOOL_OR(bb.monitored), ANY_VALUE(bb.kind) <> 'numeric') END AS monitored, "
        f"COUNT(*) FILTER (WHERE bb.bucket <> {NULL_BUCKET}) AS n_value_buckets FROM {b} bb GROUP BY bb.feature)"
    )
    ctes.append(
        f"{p}_edges AS (SELECT feature, list_concat(list(lo ORDER BY bucket), [max(hi)]) AS edges FROM {b} "
        f"WHERE kind = 'numeric' AND bucket <> {NULL_BUCKET} GROUP BY feature)"
    )
    keyed = []
    if numeric:
        keyed.append(
            f"SELECT m.feature, CASE WHEN k.kind = 'discrete' THEN 'd:' || CAST(value AS VARCHAR) "
            f"ELSE 'n:' || CAST(len(list_filter(e.edges[2:len(e.edges)-1], lambda x: value >= x)) AS VARCHAR) END AS _k "
            f"FROM {p}_mn m JOIN {p}_meta k USING (feature) LEFT JOIN {p}_edges e USING (feature) WHERE value IS NOT NULL"
        )
    if categorical:
        keyed.append(
            f"SELECT m.feature, 'c:' || CASE WHEN k.tracks_nulls THEN value ELSE COALESCE(value, 'nan') END AS _k "
            f"FROM {p}_mc m JOIN {p}_meta k USING (feature) WHERE (CASE WHEN k.tracks_nulls THEN value ELSE COALESCE(value, 'nan') END) IS NOT NULL"
        )
    ctes.append(
        f"{p}_shares AS (SELECT feature, _k, cnt / CAST(GREATEST(SUM(cnt) OVER (PARTITION BY feature), 1) AS DOUBLE) AS actual "
        f"FROM (SELECT feature, _k, COUNT(*) AS cnt FROM ({' UNION ALL '.join(keyed)}) GROUP BY feature, _k))"
    )
    ctes.append(
        f"{p}_b AS (SELECT b.feature, CASE b.kind WHEN 'categorical' THEN 'c:' || bucket_key WHEN 'discrete' THEN 'd:' || CAST(bucket_value AS VARCHAR) "
        f"ELSE 'n:' || CAST(bucket AS VARCHAR) END AS _k, "
        f"CASE WHEN b.kind = 'numeric' AND expected IS NULL THEN 1.0 / GREATEST(m.n_value_buckets, 1) ELSE expected END AS expected "
        f"FROM {b} b JOIN {p}_meta m USING (feature) WHERE bucket <> {NULL_BUCKET})"
    )
    ctes.append(
        f"{p}_m AS (SELECT m.*, COALESCE(pr.n_rows, 0) AS n_rows, COALESCE(pr.c_null_rate, 0.0) AS c_null_rate "
        f"FROM {p}_meta m JOIN {p}_prof pr USING (feature))"
    )
    ctes.append(
        f"{p}_al AS (SELECT COALESCE(b.feature, s.feature) AS feature, COALESCE(b.expected, 0.0) AS e, COALESCE(s.actual, 0.0) AS a "
        f"FROM {p}_b b FULL OUTER JOIN {p}_shares s ON b.feature = s.feature AND b._k = s._k)"
    )
    ctes.append(
        f"{p}_sc AS (SELECT al.feature, CASE WHEN tracks_nulls THEN e * (1.0 - b_null_rate) ELSE e END AS e, "
        f"CASE WHEN tracks_nulls THEN a * (1.0 - c_null_rate) ELSE a END AS a FROM {p}_al al JOIN {p}_m USING (feature) "
        f"UNION ALL SELECT feature, b_null_rate, c_null_rate FROM {p}_m WHERE tracks_nulls)"
    )
    ctes.append(
        f"{p} AS (SELECT m.feature, m.kind, COALESCE(s.psi, 0.0) AS psi, m.monitored, m.tracks_nulls, m.b_null_rate AS baseline_null_rate, "
        f"CASE WHEN m.tracks_nulls THEN m.c_null_rate END AS current_null_rate, m.n_rows AS current_rows FROM {p}_m m LEFT JOIN "
        f"(SELECT feature, SUM((GREATEST(a, 1e-4) - GREATEST(e, 1e-4)) * ln(GREATEST(a, 1e-4) / GREATEST(e, 1e-4))) AS psi FROM {p}_sc GROUP BY feature) s "
        f"USING (feature))"
    )
    return ",\n".join(ctes)


def lineitem_period_cte(name: str, period: str) -> str:
    every, cmp = (50, "<") if period == "baseline" else (4, ">=")
    return (
        f"{name} AS (SELECT CASE WHEN l_orderkey % {every} = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice, "
        f"l_quantity, l_discount, l_tax, CASE WHEN l_orderkey % 40 = 1 THEN NULL ELSE l_returnflag END AS l_returnflag, "
        f"l_linestatus FROM lineitem WHERE l_shipdate {cmp} TIMESTAMP '1998-07-01 00:00:00')"
    )


LINEITEM_NUMERIC = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
LINEITEM_CATEGORICAL = ["l_returnflag", "l_linestatus"]
FEATURE_NUMERIC = [
    "member_since_days", "contact_requests_last_30d", "avg_transaction_30d", "avg_transaction_90d",
    "payment_failure_rate_30d", "payment_failure_rate_90d", "total_payment_attempts",
    "days_since_last_successful_payment", "avg_engagement_30d", "avg_engagement_90d",
    "campaign_participation_rate", "total_events", "events_last_30d", "events_last_90d", "renewal_count",
]
FEATURE_CATEGORICAL = ["membership_tier", "region", "preferred_channel"]


def drift_feature_ctes() -> list[str]:
    """fb = snapshot rebuilt as of the baseline day, fc = as of the current day."""
    return [ADAPTER, STAGING, features_cte("fb", "2024-01-20", replay=True), features_cte("fc", "2024-01-30", replay=True)]


DRIFT_HISTORY = """
dh AS (SELECT CAST(snapshot_date AS TIMESTAMP) + INTERVAL 6 HOUR AS run_ts, snapshot_date,
  CASE WHEN snapshot_date < DATE '2024-01-15' THEN 'churn-v1' ELSE 'churn-v2' END AS champion_model,
  feature, psi, CAST(0.25 AS DOUBLE) AS threshold, psi > 0.25 AS breached, TRUE AS monitored
  FROM (SELECT CAST(ts AS DATE) AS snapshot_date, event_type AS feature, AVG(value) / 200.0 AS psi FROM events GROUP BY ALL))"""

PROMOTIONS = """
pr AS (SELECT 'churn-predictor' AS model, CAST(d AS TIMESTAMP) + INTERVAL 5 HOUR AS run_ts, promoted
  FROM (SELECT CAST(ts AS DATE) AS d, AVG(value) > 50 AS promoted FROM events WHERE event_type = 'purchase' GROUP BY 1))"""

DEFECTIVE = """
defective AS (
  SELECT * EXCLUDE (renewal_count) FROM (
    SELECT * REPLACE (CASE WHEN customer_id % 3 <> 2 THEN NULL ELSE avg_engagement_30d END AS avg_engagement_30d,
                      'email' AS preferred_channel) FROM fc
    UNION ALL
    SELECT * REPLACE (CASE WHEN customer_id % 3 <> 2 THEN NULL ELSE avg_engagement_30d END AS avg_engagement_30d,
                      'email' AS preferred_channel) FROM fc WHERE region = 'ASIA'))"""


def split_cte(src: str = "features", name: str = "split_rows") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (feature_computed_at, latest_event_ts),
    CASE WHEN PERCENT_RANK() OVER (PARTITION BY churned ORDER BY md5(CAST(customer_id AS VARCHAR))) < 0.8 THEN 'train' ELSE 'test' END AS split,
    TIMESTAMP '2024-02-15 04:00:00' AS assigned_at
  FROM {src})"""


def folds_cte(src: str, name: str = "folds", k: int = 5, seed: int = 42) -> str:
    return f"""{name} AS (
  SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY churned ORDER BY md5('{seed}' || CAST(customer_id AS VARCHAR)), customer_id) - 1) % {k} AS INTEGER) AS fold
  FROM {src})"""


def scores_cte(period: str | None = None, name: str = "scores") -> str:
    where = ""
    if period == "train":
        where = "WHERE l_shipdate < TIMESTAMP '1998-07-01 00:00:00'"
    elif period == "test":
        where = "WHERE l_shipdate >= TIMESTAMP '1998-07-01 00:00:00'"
    return f"""{name} AS (SELECT 'champion' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount AS score FROM lineitem {where}
  UNION ALL SELECT 'challenger', CAST(l_returnflag = 'R' AS INTEGER), l_extendedprice / CAST(120000.0 AS DOUBLE) FROM lineitem {where})"""


def curve_cte(src: str = "scores", name: str = "curve") -> str:
    return f"""{name} AS (SELECT *, SUM(pos) OVER w AS cum_pos, SUM(neg) OVER w AS cum_neg,
    SUM(pos) OVER (PARTITION BY model) AS total_pos, SUM(neg) OVER (PARTITION BY model) AS total_neg
  FROM (SELECT model, score, SUM(y) AS pos, SUM(1 - y) AS neg FROM {src} GROUP BY ALL)
  WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def pr_points_cte(curve: str = "curve", name: str = "pr") -> str:
    return f"""{name} AS (SELECT model, score AS threshold, cum_pos / CAST(cum_pos + cum_neg AS DOUBLE) AS precision,
  cum_pos / CAST(total_pos AS DOUBLE) AS recall FROM {curve} WHERE cum_pos - pos < total_pos)"""


def threshold_cte(pr: str = "pr", name: str = "thr", target: float = 0.8) -> str:
    return f"""{name} AS (SELECT a.model, COALESCE(q.t, a.t) AS threshold FROM
  (SELECT model, arg_min(threshold, (-recall, threshold)) AS t FROM {pr} GROUP BY model) a LEFT JOIN
  (SELECT model, arg_min(threshold, (-precision, threshold)) AS t FROM {pr} WHERE recall >= {target} GROUP BY model) q USING (model))"""


def bundle_cte(scores: str, curve: str, thr: str, name: str = "bundle") -> str:
    return f"""{name} AS (
  SELECT a.model, a.pr_auc, a.roc_auc, f.threshold, f.f1 FROM
  (SELECT model, SUM(pos * (cum_pos / CAST(cum_pos + cum_neg AS DOUBLE))) / CAST(ANY_VALUE(total_pos) AS DOUBLE) AS pr_auc,
     SUM(neg * (cum_pos - pos + pos / 2.0)) / (CAST(ANY_VALUE(total_pos) AS DOUBLE) * ANY_VALUE(total_neg)) AS roc_auc FROM {curve} GROUP BY model) a
  JOIN (SELECT model, threshold, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0.0 END AS f1 FROM
     (SELECT s.model, t.threshold, COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.y = 1) AS tp,
        COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.y = 0) AS fp, COUNT(*) FILTER (WHERE s.score < t.threshold AND s.y = 1) AS fn
      FROM {scores} s JOIN {thr} t USING (model) GROUP BY ALL)) f USING (model))"""


def importance_cte(period: str, name: str) -> str:
    cmp = "<" if period == "train" else ">="
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    sel = ", ".join(f"abs(corr(CAST({c} AS DOUBLE), CAST(l_returnflag = 'R' AS DOUBLE))) AS {c}" for c in feats)
    unions = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS importance FROM {name}_row" for c in feats)
    return f"{name}_row AS (SELECT {sel} FROM lineitem WHERE l_shipdate {cmp} TIMESTAMP '1998-07-01 00:00:00'),\n{name} AS ({unions})"


MART_INDICATORS = [
    "payment_failure_rate_30d", "payment_failure_rate_90d", "days_since_last_successful_payment",
    "avg_engagement_30d", "avg_engagement_90d", "contact_requests_last_30d", "campaign_participation_rate",
    "events_last_30d", "events_last_90d", "renewal_count",
]
DRIVERS = [
    ("payment_failure_rate_30d", "Payment failures (30d)", True, 0),
    ("days_since_last_successful_payment", "Days since last successful payment", True, 1),
    ("contact_requests_last_30d", "Support contacts (30d)", True, 2),
    ("avg_engagement_30d", "Engagement score (30d)", False, 3),
    ("events_last_30d", "Activity events (30d)", False, 4),
    ("campaign_participation_rate", "Campaign participation", False, 5),
]

MART = f"""
mart AS (
  SELECT p.customer_id, p.churn_probability, p.churn_prediction, p.model_version, p.snapshot_date, p.predicted_at,
    f.membership_tier, f.region, f.preferred_channel, f.member_since_days,
    f.avg_transaction_30d AS monthly_value, f.avg_transaction_90d AS monthly_value_90d,
    {", ".join("f." + c for c in MART_INDICATORS)}
  FROM scored p JOIN feature_history f ON p.customer_id = f.customer_id AND p.snapshot_date = f.snapshot_date
  WHERE p.snapshot_date = (SELECT MAX(snapshot_date) FROM scored) AND f.snapshot_date = (SELECT MAX(snapshot_date) FROM scored))"""

BANDED = """
banded AS (SELECT *, CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.4 THEN 'Medium'
  WHEN churn_probability IS NOT NULL THEN 'Low' END AS risk_band FROM mart)"""

COHORT = (
    "ref AS (SELECT feature, CASE WHEN q[2] > 0 THEN q[2] WHEN hw THEN q[3] ELSE q[1] END AS cohort FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {'TRUE' if h else 'FALSE'} AS hw, quantile_cont(CAST({c} AS DOUBLE), [0.1, 0.5, 0.9]) AS q FROM mart WHERE {c} IS NOT NULL"
        for c, _, h, _ in DRIVERS
    )
    + "))"
)

INDICATORS = (
    "drv AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', '{label}', {'TRUE' if h else 'FALSE'}, {i})" for c, label, h, i in DRIVERS)
    + ") t(feature, label, higher_is_worse, driver_order)),\n"
    + "dmelt AS ("
    + " UNION ALL ".join(f"SELECT customer_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM mart" for c, *_ in DRIVERS)
    + "),\n"
    + """fired AS (SELECT m.customer_id, m.feature, d.label, m.value, r.cohort,
    CASE WHEN m.value IS NULL AND m.feature = 'days_since_last_successful_payment' THEN 'inf'::DOUBLE
         WHEN d.higher_is_worse THEN (CASE WHEN r.cohort > 0 THEN m.value / r.cohort ELSE 'inf'::DOUBLE END)
         ELSE (CASE WHEN m.value > 0 THEN r.cohort / m.value ELSE 'inf'::DOUBLE END) END AS severity, d.driver_order
  FROM dmelt m JOIN drv d USING (feature) LEFT JOIN ref r USING (feature)
  WHERE (m.value IS NULL AND m.feature = 'days_since_last_successful_payment')
     OR (m.value IS NOT NULL AND r.cohort IS NOT NULL AND (CASE WHEN d.higher_is_worse THEN (CASE WHEN r.cohort > 0 THEN m.value >= r.cohort * 1.5 ELSE m.value > 0 END)
                                                              ELSE (CASE WHEN r.cohort > 0 THEN m.value <= r.cohort / 1.5 ELSE FALSE END) END)))"""
)

DAILY = """
daily AS (SELECT snapshot_date, COUNT(*) AS customers_scored, COUNT(*) FILTER (WHERE churn_prediction) AS predicted_churners,
  COUNT(*) FILTER (WHERE churn_probability >= 0.7) AS high_risk_customers, AVG(churn_probability) AS mean_churn_probability,
  COUNT(*) FILTER (WHERE churn_prediction) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE) AS predicted_churn_rate,
  COUNT(DISTINCT model_version) AS model_versions_used, MAX(predicted_at) AS last_predicted_at FROM scored GROUP BY snapshot_date)"""


def risk_base() -> list[str]:
    return [ADAPTER, STAGING, history_cte(), PREDICTIONS, MART]


CLEAN_LOG = "clean AS (SELECT * FROM cdc WHERE NOT COALESCE(anomaly_injected, FALSE))"
EXPLORE_NUMERIC = ["monthly_transaction", "payment_attempts_last_30d", "engagement_score", "member_since_days", "contact_requests_last_30d"]
EXPLORE_CATEGORICAL = ["event_type", "region", "membership_tier", "payment_status", "channel"]
LI_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
