"""Reference SQL for the registered queries, written on its own for another engine.

The statements share a chain of common table expressions: requests from a source table, then
the income, risk and loan stages, then the metrics. Nothing here is generated from the Spark
side, so an error in either shows as a difference.
"""

from __future__ import annotations

DAY = 86400000
YEAR = 365 * DAY
WEEK = 7 * DAY


def u(salt: str, key: str = "dk") -> str:
    return (
        f"(CAST('0x' || substr(md5({key} || ':{salt}'), 1, 8) AS BIGINT)"
        " / CAST(4294967296 AS DOUBLE))"
    )


def clock(stage: str) -> str:
    return f"(system_time + CAST(trunc({u('lat_' + stage)} * CAST(5000 AS DOUBLE)) AS BIGINT))"


def d(x: float | int) -> str:
    return f"CAST({x} AS DOUBLE)"


def trunc_int(x: str) -> str:
    return f"CAST(trunc({x}) AS INTEGER)"


def requests(name: str, source: str, key: str, entity: str, date: str, draw_key: str) -> str:
    """Routed requests. ``dk`` is the text that model draws hash."""
    return f"""
{name}_base AS (
  SELECT *, CAST({key} AS VARCHAR) AS k,
         epoch_ms({date}) + ({key} * 1000) % {DAY} AS system_time,
         {u("is_customer", f"CAST({key} AS VARCHAR)")} < {d(0.8)} AS is_customer,
         CAST({entity} % 1000000 AS INTEGER) AS local_id
  FROM {source}
),
{name}_req AS (
  SELECT *, 'req-' || k AS request_id, 'app-' || k AS application_id,
         {draw_key} AS dk,
         CASE WHEN is_customer THEN local_id + 1000000 ELSE 0 END AS customer_id,
         CASE WHEN is_customer THEN 0 ELSE local_id + 2000000 END AS prospect_id,
         CASE WHEN is_customer THEN 'batch' ELSE 'real-time' END AS income_source,
         CASE WHEN is_customer THEN system_time - {DAY} ELSE system_time END
           AS income_requested_at
  FROM {name}_base
)"""


def income_of(id_column: str) -> str:
    return f"{d(50000)} + ({id_column} % 10) * {d(5000)}"


def stages(name: str) -> str:
    """Income, risk and loan rows of the requests in ``{name}_req``."""
    band, val, skew = u("credit_band"), u("credit_val"), u("npl")
    return f"""
{name}_inc AS (
  SELECT *, {income_of("prospect_id")} AS predicted_income,
         'income_prediction_request' AS kafka_source,
         system_time AS e1_produced_at,
         income_requested_at + {clock("e1_consume")} - system_time AS e1_consumed_at,
         income_requested_at + {clock("e2_produce")} - system_time AS e2_stamp
  FROM {name}_req WHERE NOT is_customer
),
{name}_npl AS (
  SELECT request_id, application_id, customer_id, prospect_id, income_requested_at,
         system_time, income_source, is_customer, dk, k,
         CASE WHEN is_customer THEN NULL ELSE system_time END AS e1_produced_at,
         CASE WHEN is_customer THEN 'npl_prediction_request' ELSE 'income_prediction_request' END
           AS kafka_source,
         CASE WHEN is_customer THEN {income_of("customer_id")} ELSE {income_of("prospect_id")} END
           AS predicted_income,
         CASE WHEN is_customer THEN NULL
              ELSE income_requested_at + {clock("e1_consume")} - system_time END AS e1_consumed_at,
         TRUE AS sent_to_npl,
         CASE WHEN is_customer THEN NULL
              ELSE income_requested_at + {clock("e2_produce")} - system_time END AS e2_produced_at,
         CASE WHEN is_customer THEN NULL
              ELSE income_requested_at + {clock("e2_consume")} - system_time END AS e2_consumed_at,
         CASE WHEN is_customer THEN system_time
              ELSE income_requested_at + {clock("e2_consume")} - system_time END
           AS npl_requested_at,
         CASE WHEN is_customer THEN system_time END AS e3_produced_at,
         CASE WHEN is_customer THEN {clock("e3_consume")} END AS e3_consumed_at,
         CASE WHEN {band} < {d(0.16)} THEN 300 + CAST(trunc({val} * {d(279)}) AS BIGINT)
              WHEN {band} < {d(0.33)} THEN 580 + CAST(trunc({val} * {d(89)}) AS BIGINT)
              WHEN {band} < {d(0.54)} THEN 670 + CAST(trunc({val} * {d(69)}) AS BIGINT)
              WHEN {band} < {d(0.80)} THEN 740 + CAST(trunc({val} * {d(59)}) AS BIGINT)
              ELSE 800 + CAST(trunc({val} * {d(50)}) AS BIGINT) END AS credit_score,
         FALSE AS sent_to_ldes, CAST(NULL AS BIGINT) AS e4_produced_at,
         floor((CASE WHEN {skew} < {d(0.5)} THEN {d(0.8)} * {skew}
                     ELSE {d(0.8)} + {d(0.4)} * ({skew} - {d(0.5)}) END) * {d(100)}) / {d(100)}
           AS predicted_npl,
         o_status
  FROM {name}_req
),
{name}_npl_sent AS (
  SELECT * REPLACE (TRUE AS sent_to_ldes,
    CASE WHEN is_customer THEN npl_requested_at ELSE income_requested_at END
      + {clock("e4_produce")} - system_time AS e4_produced_at)
  FROM {name}_npl
),
{name}_e4 AS (
  SELECT * REPLACE (
    coalesce(e1_produced_at, 0) AS e1_produced_at, coalesce(e1_consumed_at, 0) AS e1_consumed_at,
    coalesce(e2_produced_at, 0) AS e2_produced_at, coalesce(e2_consumed_at, 0) AS e2_consumed_at,
    coalesce(e3_produced_at, 0) AS e3_produced_at, coalesce(e3_consumed_at, 0) AS e3_consumed_at)
  FROM {name}_npl_sent
)"""


INDUSTRY = """
industry(i, employment_industry, credibility, dti_base, dti_width, stab_base, stab_width) AS (
  SELECT i, n, CAST(a AS DOUBLE), CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(e AS DOUBLE),
         CAST(f AS DOUBLE)
  FROM (VALUES
    (0, 'Technology', '0.95', '0.25', '0.15', '0.70', '0.20'),
    (1, 'Healthcare', '0.90', '0.28', '0.17', '0.80', '0.15'),
    (2, 'Government', '0.88', '0.30', '0.15', '0.85', '0.10'),
    (3, 'Finance', '0.85', '0.27', '0.18', '0.65', '0.20'),
    (4, 'Education', '0.75', '0.35', '0.20', '0.75', '0.15'),
    (5, 'Manufacturing', '0.70', '0.33', '0.22', '0.55', '0.25'),
    (6, 'Real Estate', '0.65', '0.30', '0.25', '0.45', '0.25'),
    (7, 'Retail', '0.55', '0.40', '0.20', '0.40', '0.25'),
    (8, 'Hospitality', '0.50', '0.42', '0.23', '0.30', '0.30'),
    (9, 'Entertainment', '0.45', '0.35', '0.30', '0.25', '0.35')
  ) AS v(i, n, a, b, c, e, f)
)"""


def decisions(name: str) -> str:
    """Factor scores, decision, loan rows and the handed-over messages (needs INDUSTRY)."""
    half_up = "floor(({}) * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE)"
    dti = half_up.format(f"dti_base + dti_width * {u('dti')}")
    stability = half_up.format(f"stab_base + stab_width * {u('stability')}")
    dec, amt = u("decision"), u("amount")
    return f"""
{name}_profile AS (
  SELECT r.*, p.employment_industry, p.credibility,
         {dti} AS debt_to_income_ratio, {stability} AS employment_stability
  FROM {name}_e4 r JOIN industry p ON p.i = CAST(trunc({u("industry")} * {d(10)}) AS INTEGER)
),
{name}_factors AS (
  SELECT *,
    least(100, {trunc_int(f"predicted_income / {d(1000)}")}) AS income_score,
    {trunc_int(f"(credit_score - 300) / {d(5.5)}")} AS credit_points,
    greatest(0, {trunc_int(f"{d(100)} - predicted_npl * {d(100)}")}) AS npl_points,
    {trunc_int(f"credibility * {d(100)}")} AS industry_points,
    greatest(0, {trunc_int(f"{d(100)} - debt_to_income_ratio * {d(200)}")}) AS debt_points,
    {trunc_int(f"employment_stability * {d(100)}")} AS stability_points
  FROM {name}_profile
),
{name}_scored AS (
  SELECT *, {trunc_int(
      f"credit_points * {d(0.30)} + npl_points * {d(0.25)} + income_score * {d(0.20)}"
      f" + debt_points * {d(0.15)} + stability_points * {d(0.05)}"
      f" + industry_points * {d(0.05)}")} AS total_score
  FROM {name}_factors
),
{name}_decided AS (
  SELECT *, CASE
      WHEN credit_score < 400 OR predicted_npl > {d(0.8)} OR debt_to_income_ratio > {d(0.7)}
        THEN 'REJECTED'
      WHEN total_score >= 80 THEN 'APPROVED'
      WHEN total_score >= 70 THEN
        CASE WHEN {dec} < {d(0.8)} THEN 'APPROVED' ELSE 'MANUAL_REVIEW' END
      WHEN total_score >= 60 THEN
        CASE WHEN {dec} < {d(0.5)} THEN 'APPROVED' ELSE 'MANUAL_REVIEW' END
      WHEN total_score >= 45 THEN
        CASE WHEN {dec} < {d(0.7)} THEN 'MANUAL_REVIEW' ELSE 'REJECTED' END
      WHEN total_score >= 30 THEN
        CASE WHEN {dec} < {d(0.3)} THEN 'MANUAL_REVIEW' ELSE 'REJECTED' END
      ELSE 'REJECTED' END AS decision,
    floor(predicted_income / debt_to_income_ratio
          * (CASE WHEN debt_to_income_ratio < {d(0.3)} THEN {d(0.8)} + {d(0.1)} * {amt}
                  WHEN debt_to_income_ratio < {d(0.5)} THEN {d(0.65)} + {d(0.15)} * {amt}
                  ELSE {d(0.5)} + {d(0.15)} * {amt} END)
          / {d(100)} + {d(0.5)}) * {d(100)} AS loan_amount
  FROM {name}_scored
),
{name}_loan AS (
  SELECT *, decision = 'APPROVED' AS loan_decision,
         CASE WHEN is_customer THEN npl_requested_at ELSE income_requested_at END
           + {clock("e4_consume")} - system_time AS e4_consumed_at,
         FALSE AS sent_to_ns, FALSE AS sent_to_ldis,
         CAST(NULL AS BIGINT) AS e5_produced_at, CAST(NULL AS BIGINT) AS e6_produced_at,
         CASE WHEN is_customer THEN npl_requested_at ELSE income_requested_at END
           + {clock("e6_produce")} - system_time AS e6_stamp
  FROM {name}_decided
),
{name}_e6 AS (
  SELECT *, CASE WHEN is_customer THEN customer_id ELSE prospect_id END AS effective_id
  FROM {name}_loan
)"""


ORDERS = requests(
    "o", "(SELECT *, o_orderstatus AS o_status FROM orders)",
    "o_orderkey", "o_custkey", "o_orderdate", "k",
)
LINES = requests(
    "l", "(SELECT *, l_linestatus AS o_status FROM lineitem)",
    "l_orderkey", "l_suppkey", "l_shipdate", "k || '@' || CAST(system_time AS VARCHAR)",
)

ANALYTICS = f"""
analytics AS (
  SELECT request_id, t AS timestamp, loan_decision AS is_approved,
         CASE WHEN loan_decision THEN loan_amount ELSE {d(0)} END AS loan_amount,
         predicted_npl AS risk_score,
         CASE WHEN is_customer AND npl_requested_at > 0 THEN t - npl_requested_at
              WHEN income_requested_at > 0 THEN t - income_requested_at
              ELSE t - system_time END AS processing_time
  FROM (SELECT *, {clock("analytics")} AS t FROM o_e6)
)"""

# The scores have two decimals, so whole millionths hold them exactly.
METRICS = f"""
metrics AS (
  SELECT b * {DAY} AS bucket_start, (b + 1) * {DAY} AS bucket_end,
         window_start, window_end, approved_count, n - approved_count AS rejected_count,
         approved_count / CAST(n AS DOUBLE) AS approval_rate, total_amount,
         CASE WHEN approved_count > 0 THEN total_amount / approved_count ELSE {d(0)} END
           AS avg_amount,
         risk_micros / {d(1000000)} / n AS avg_risk_score, high_risk_count,
         CAST(proc_sum // n AS DOUBLE) AS avg_proc_time
  FROM (
    SELECT CAST(floor(timestamp / {d(DAY)}) AS BIGINT) AS b, count(*) AS n,
           min(timestamp) AS window_start, max(timestamp) AS window_end,
           count(*) FILTER (WHERE is_approved) AS approved_count,
           sum(loan_amount) AS total_amount,
           CAST(sum(CAST(round(risk_score * {d(1000000)}) AS BIGINT)) AS DOUBLE) AS risk_micros,
           count(*) FILTER (WHERE risk_score > {d(0.7)}) AS high_risk_count,
           CAST(sum(processing_time) AS BIGINT) AS proc_sum
    FROM analytics GROUP BY 1
  )
)"""

NOTES = f"""
notes AS (
  SELECT request_id, application_id, effective_id AS customer_id, loan_decision, loan_amount,
         predicted_npl * {d(0.4)} + debt_to_income_ratio * {d(0.3)}
           + (1000 - credit_score) / {d(1000)} * {d(0.3)} AS risk_score,
         credit_score, t - system_time AS processing_time_ms, t AS event_time
  FROM (SELECT *, {clock("notify")} AS t FROM o_e6)
)"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


REQ = (ORDERS,)
FLOW = (ORDERS, stages("o"), INDUSTRY, decisions("o"))
MET = (*FLOW, ANALYTICS, METRICS)

INCOME_COLUMNS = (
    "request_id, application_id, customer_id, prospect_id, income_requested_at, system_time, "
    "e1_produced_at, income_source, is_customer, kafka_source, predicted_income, "
    "e1_consumed_at, sent_to_npl, e2_produced_at"
)
NPL_COLUMNS = (
    "request_id, application_id, customer_id, prospect_id, income_requested_at, system_time, "
    "e1_produced_at, income_source, is_customer, kafka_source, predicted_income, "
    "e1_consumed_at, sent_to_npl, e2_produced_at, e2_consumed_at, npl_requested_at, "
    "e3_produced_at, e3_consumed_at, credit_score, sent_to_ldes, e4_produced_at, predicted_npl"
)
LOAN_COLUMNS = (
    NPL_COLUMNS + ", e4_consumed_at, debt_to_income_ratio, employment_industry, "
    "employment_stability, loan_decision, loan_amount, sent_to_ns, e5_produced_at, "
    "sent_to_ldis, e6_produced_at"
)
LAST = ["approval_rate", "approved_count", "rejected_count", "total_amount", "avg_amount",
        "high_risk_count", "avg_proc_time"]
FIELDS = ["approved_count", "rejected_count", "approval_rate", "total_amount", "avg_amount",
          "avg_risk_score", "high_risk_count", "avg_proc_time", "window_start", "window_end"]
TREND = ["approval_rate", "total_amount", "avg_amount", "avg_risk_score"]


def camel(column: str) -> str:
    head, *rest = column.split("_")
    return head + "".join(p.capitalize() for p in rest)


def as_message(columns: str) -> str:
    return ", ".join(f'{c} AS "{camel(c)}"' for c in columns.split(", "))


def merged(target: str, batch: str, columns: str, refresh: set[str], reset: set[str]) -> str:
    """Row-by-row upsert semantics: insert the first row of a new key, refresh from the last."""
    out = []
    for c in columns.split(", "):
        if c == "request_id":
            out.append("coalesce(t.request_id, f.request_id) AS request_id")
        elif c in refresh:
            out.append(f"CASE WHEN l.request_id IS NULL THEN t.{c} ELSE l.{c} END AS {c}")
        elif c in reset:
            out.append(
                f"CASE WHEN f.request_id IS NULL THEN t.{c}"
                f" WHEN t.request_id IS NOT NULL OR f.n > 1 THEN FALSE ELSE f.{c} END AS {c}"
            )
        else:
            out.append(f"CASE WHEN t.request_id IS NULL THEN f.{c} ELSE t.{c} END AS {c}")
    order = "system_time, customer_id, prospect_id"
    down = "system_time DESC, customer_id DESC, prospect_id DESC"
    return f"""
SELECT {", ".join(out)}
FROM ({target}) t
FULL OUTER JOIN (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY {order}) AS rn,
           count(*) OVER (PARTITION BY request_id) AS n FROM ({batch}))
  WHERE rn = 1) f ON f.request_id = t.request_id
LEFT JOIN (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY {down}) AS rn FROM ({batch}))
  WHERE rn = 1) l ON l.request_id = f.request_id"""


HELD = "o_status <> 'P'"


def loan_rows(done: str) -> str:
    """The loan table of which the rows that meet ``done`` have been handed over."""
    return f"""SELECT * REPLACE ({done} AS sent_to_ldis,
      CASE WHEN {done} THEN e6_stamp END AS e5_produced_at,
      CASE WHEN {done} THEN e6_stamp END AS e6_produced_at) FROM o_loan"""


def text_times(columns: list[str]) -> str:
    def one(c: str) -> str:
        name = c[:-3] + "_time" if c.endswith("_at") else c + "_text"
        return (
            f"strftime(make_timestamp({c} * 1000), '%Y-%m-%d %H:%M:%S') || '.'"
            f" || lpad(CAST({c} % 1000 AS VARCHAR), 3, '0') AS {name}"
        )

    return ", ".join(one(c) for c in columns)


INCOME_TIMES = ["income_requested_at", "e1_produced_at", "system_time", "e1_consumed_at",
                "e2_produced_at"]
LOAN_TIMES = ["income_requested_at", "e1_produced_at", "system_time", "e1_consumed_at",
              "e2_produced_at", "e2_consumed_at", "npl_requested_at", "e3_produced_at",
              "e3_consumed_at", "e4_produced_at", "e4_consumed_at"]

COUNTED = """
counted AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS event_count
  FROM events
)"""

# Bytes 32..126 are printable; a character of k bytes beyond ASCII counts k times.
PRINTABLE = "length(regexp_replace({t}, '[^ -~]', '', 'g'))"
PAYLOADS = """
payloads AS (
  SELECT 'documents' AS origin, doc_id AS id, text AS t FROM documents
  UNION ALL SELECT 'events', event_id, props FROM events
),
profiled AS (
  SELECT origin, id, CAST(strlen(t) AS BIGINT) AS n_bytes,
         CAST(length(regexp_replace(t, '[^ -~]', '', 'g')) AS BIGINT) AS n_printable,
         CASE WHEN t IS NULL OR t = '' THEN 'empty'
              WHEN starts_with(ltrim(t, ' ' || chr(9) || chr(10) || chr(13)), '{') THEN 'json'
              WHEN starts_with(t, chr(0)) THEN 'avro_like'
              ELSE 'other' END AS kind,
         substr(lower(hex(encode(t))), 1, 150)
           || CASE WHEN strlen(t) * 2 > 150 THEN '...' ELSE '' END AS hex_preview,
         substr(
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
             '[\\x{10000}-\\x{10FFFF}]', '····', 'g'),
             '[\\x{800}-\\x{FFFF}]', '···', 'g'),
             '[\\x{80}-\\x{B6}\\x{B8}-\\x{7FF}]', '··', 'g'),
             '[\\x{00}-\\x{1F}\\x{7F}]', '·', 'g'), 1, 150)
           || CASE WHEN strlen(t) > 150 THEN '...' ELSE '' END AS ascii_preview
  FROM payloads
)"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    npl_done = "o_status = 'F'"

    sql["request_routing"] = with_(*REQ, select=f"""
SELECT request_id, application_id, customer_id, prospect_id, is_customer, income_source,
       income_requested_at, system_time AS npl_requested_at, system_time,
       CASE WHEN is_customer THEN {income_of("customer_id")} ELSE {d(0)} END AS predicted_income
FROM o_req""")
    sql["map_requests"] = with_(*REQ, select="""
SELECT request_id, application_id, customer_id, prospect_id, income_requested_at,
       system_time AS e1_produced_at, system_time, income_source, is_customer FROM o_req""")
    sql["map_disbursement"] = with_(*FLOW, select="""
SELECT request_id, application_id, effective_id AS customer_id, income_requested_at,
       system_time, is_customer, npl_requested_at, credit_score, predicted_npl,
       debt_to_income_ratio, loan_decision, loan_amount, e6_stamp AS e5_produced_at
FROM o_e6""")
    sql["income_prediction"] = with_(*REQ, select=f"""
SELECT request_id, {income_of("(customer_id + prospect_id)")} AS predicted_income FROM o_req""")
    sql["credit_score_bands"] = with_(
        ORDERS, stages("o"), select="SELECT request_id, credit_score FROM o_npl")
    sql["npl_score"] = with_(
        ORDERS, stages("o"), select="SELECT request_id, predicted_npl FROM o_npl")
    sql["industry_profile"] = with_(*FLOW, select="""
SELECT request_id, employment_industry, credibility, debt_to_income_ratio, employment_stability
FROM o_profile""")
    sql["score_factors"] = with_(*FLOW, select="""
SELECT request_id, income_score, credit_points, npl_points, industry_points, debt_points,
       stability_points FROM o_factors""")
    sql["weighted_score"] = with_(*FLOW, select="SELECT request_id, total_score FROM o_scored")
    sql["loan_decision"] = with_(
        *FLOW, select="SELECT request_id, decision, loan_decision FROM o_loan")
    sql["loan_amount"] = with_(*FLOW, select="SELECT request_id, loan_amount FROM o_loan")
    sql["stage_clock"] = with_(*FLOW, select="""
SELECT request_id, e1_consumed_at, e2_produced_at, e2_consumed_at, e3_consumed_at,
       e4_produced_at, e4_consumed_at,
       CASE WHEN is_customer THEN e3_consumed_at ELSE e1_consumed_at END AS event_time
FROM o_loan""")
    sql["stage_latency"] = with_(*FLOW, select="""
SELECT l.request_id, l.is_customer,
       i.e1_consumed_at - l.income_requested_at AS income_ms,
       i.e2_stamp - i.e1_consumed_at AS income_outbox_ms,
       n.e4_produced_at - coalesce(n.e3_consumed_at, n.e2_consumed_at) AS npl_outbox_ms,
       l.e4_consumed_at - CASE WHEN l.is_customer THEN l.npl_requested_at
                               ELSE l.income_requested_at END AS total_ms,
       l.e1_consumed_at = coalesce(i.e1_consumed_at, 0)
         AND l.e2_produced_at = coalesce(i.e2_stamp, 0)
         AND l.e2_consumed_at = coalesce(n.e2_consumed_at, 0)
         AND l.e3_consumed_at = coalesce(n.e3_consumed_at, 0)
         AND l.e4_produced_at = n.e4_produced_at
         AND l.credit_score = n.credit_score AS carried_ok
FROM o_loan l LEFT JOIN o_npl_sent n USING (request_id) LEFT JOIN o_inc i USING (request_id)""")
    sql["decision_analytics"] = with_(*FLOW, ANALYTICS, select="SELECT * FROM analytics")

    sql["risk_category"] = with_(*FLOW, NOTES, select=f"""
SELECT request_id, risk_score,
       CASE WHEN risk_score > {d(0.7)} THEN 'HIGH' WHEN risk_score > {d(0.4)} THEN 'MEDIUM'
            ELSE 'LOW' END AS tag_risk_category,
       CASE WHEN loan_decision THEN 'true' ELSE 'false' END AS tag_loan_decision,
       CAST(customer_id AS VARCHAR) AS tag_customer_id,
       application_id AS tag_application_id, 'development' AS tag_environment
FROM notes""")
    sql["alerts_high_risk"] = with_(*FLOW, NOTES, select=f"""
SELECT event_time AS timestamp, 'HIGH_RISK_APPROVED' AS alert_type, 'HIGH' AS severity,
       'High-risk loan approved: ' || request_id AS message, customer_id, risk_score, loan_amount
FROM notes WHERE loan_decision AND risk_score > {d(0.45)}""")
    note_rows = f"""
note_metrics AS (
  SELECT b * {DAY} AS bucket_start, (b + 1) * {DAY} AS bucket_end, n AS total_count,
         approved_count, n - approved_count AS rejected_count,
         approved_count / CAST(n AS DOUBLE) AS approval_rate, total_amount,
         total_amount / n AS avg_amount, risk_micros / {d(1000000)} / n AS avg_risk_score,
         high_risk_count, proc_sum / CAST(n AS DOUBLE) AS avg_processing_time
  FROM (
    SELECT CAST(floor(event_time / {d(DAY)}) AS BIGINT) AS b, count(*) AS n,
           count(*) FILTER (WHERE loan_decision) AS approved_count,
           sum(loan_amount) AS total_amount,
           CAST(sum(CAST(floor(risk_score * {d(1000000)} + {d(0.5)}) AS BIGINT)) AS DOUBLE)
             AS risk_micros,
           count(*) FILTER (WHERE risk_score > {d(0.7)}) AS high_risk_count,
           CAST(sum(processing_time_ms) AS DOUBLE) AS proc_sum
    FROM notes GROUP BY 1)
)"""
    sql["notification_metrics"] = with_(
        *FLOW, NOTES, note_rows, select="SELECT * FROM note_metrics")
    sql["notification_json"] = with_(*FLOW, NOTES, note_rows, select="""
SELECT bucket_start AS window_start, bucket_end AS window_end,
       total_count AS total_notifications, approved_count AS approved_loans,
       rejected_count AS rejected_loans, approval_rate, total_amount AS total_loan_amount,
       avg_amount AS avg_loan_amount, avg_risk_score, high_risk_count AS high_risk_loans,
       avg_processing_time, bucket_end AS timestamp, '1min' AS "window"
FROM note_metrics""")
    sql["alert_points"] = with_(*FLOW, NOTES, select=" UNION ALL ".join(f"""
SELECT event_time AS time, 'HIGH_RISK_APPROVED' AS alert_type, 'HIGH' AS severity,
       'High-risk loan approved: ' || request_id AS message, '{c}' AS field,
       CAST({c} AS DOUBLE) AS value
FROM notes WHERE loan_decision AND risk_score > {d(0.45)}"""
        for c in ("customer_id", "risk_score", "loan_amount")))

    sql["event_counter"] = with_(
        COUNTED, select="SELECT event_id, user_id, event_count FROM counted")
    sql["counter_messages"] = with_(COUNTED, select="""
SELECT event_id, 'request req-' || event_id || ' - ' || event_count || ' - customer ' || user_id
         AS message FROM counted""")
    sql["json_request_write"] = with_(COUNTED, select="""
SELECT event_id,
       '{"requestId":"req-' || event_id || '","applicationId":"app-' || event_id
       || '","customerId":' || CASE WHEN event_type = 'signup' THEN 0 ELSE user_id END
       || ',"prospectId":' || CASE WHEN event_type = 'signup' THEN user_id ELSE 0 END
       || ',"requestedAt":' || (epoch_us(ts) // 1000)
       || ',"incomeSource":"' || CASE WHEN event_type = 'signup' THEN 'real-time' ELSE 'batch' END
       || '","isCustomer":' || CASE WHEN event_type = 'signup' THEN 'false' ELSE 'true' END
       || ',"eventCount":' || event_count || '}' AS value
FROM counted""")
    sql["json_request_parse"] = """
WITH raw AS (
  SELECT event_id, CASE event_type
    WHEN 'click' THEN '{"requestId":"req-' || event_id || '","customerId":' || user_id
      || ',"incomeSource":"batch","isCustomer":true,"eventCount":' || user_id || '}'
    WHEN 'view' THEN '{"requestId":"req-' || event_id || '","isCustomer":"yes"}'
    WHEN 'purchase' THEN '{"requestId":"req-' || event_id || '","prospectId":' || user_id
    WHEN 'signup' THEN props END AS v
  FROM events
),
typed AS (
  SELECT event_id, v, coalesce(json_valid(v), FALSE) AS ok,
         CASE WHEN json_valid(v) THEN v ELSE '{}' END AS j FROM raw
),
fields AS (
  SELECT event_id, v, ok,
    CASE WHEN ok THEN coalesce(json_extract_string(j, '$.requestId'), 'unknown') END
      AS request_id,
    CASE WHEN ok THEN coalesce(json_extract_string(j, '$.customerId'), 'N/A') END AS customer_id,
    CASE WHEN ok THEN coalesce(json_extract_string(j, '$.prospectId'), 'N/A') END AS prospect_id,
    CASE WHEN ok THEN coalesce(json_extract_string(j, '$.incomeSource'), 'unknown') END
      AS income_source,
    CASE WHEN ok THEN coalesce(json_type(j, '$.isCustomer') = 'BOOLEAN'
      AND json_extract_string(j, '$.isCustomer') = 'true', FALSE) END AS is_customer,
    CASE WHEN ok THEN coalesce(CAST(json_extract(j, '$.eventCount') AS BIGINT), 0) END
      AS event_count
  FROM typed
)
SELECT event_id, request_id, customer_id, prospect_id, income_source, is_customer, event_count,
  CASE WHEN ok THEN 'Processed JSON Request: ID=' || request_id || ', Customer=' || customer_id
         || ', Prospect=' || prospect_id || ', Source=' || income_source
         || ', Customer=' || CASE WHEN is_customer THEN 'true' ELSE 'false' END
         || ', Count=' || event_count
       WHEN v IS NULL THEN 'Received null message from Kafka'
       ELSE 'Error parsing JSON: malformed, Raw data: ' || substr(v, 1, 100)
         || CASE WHEN length(v) > 100 THEN '...' ELSE '' END END AS message
FROM fields"""
    sql["payload_slice"] = """
WITH ids AS (
  SELECT o_orderkey, o_orderpriority, md5(o_orderkey || ':request') AS r,
         md5(o_orderkey || ':application') AS a FROM orders
)
SELECT o_orderkey,
  substr(r, 1, 8) || '-' || substr(r, 9, 4) || '-' || substr(r, 13, 4) || '-'
    || substr(r, 17, 4) || '-' || substr(r, 21, 12) AS request_id,
  substr(a, 1, 8) || '-' || substr(a, 9, 4) || '-' || substr(a, 13, 4) || '-'
    || substr(a, 17, 4) || '-' || substr(a, 21, 12) AS application_id,
  o_orderpriority AS rest
FROM ids"""
    sql["payload_diagnostics"] = with_(PAYLOADS, select="""
SELECT origin, id, n_bytes, n_printable, kind, hex_preview, ascii_preview FROM profiled""")
    sql["payload_profile"] = with_(PAYLOADS, select="""
SELECT origin, kind, count(*) AS n_payloads, CAST(sum(n_bytes) AS BIGINT) AS total_bytes,
       min(n_bytes) AS min_bytes, max(n_bytes) AS max_bytes,
       CAST(sum(n_printable) AS BIGINT) AS printable_bytes
FROM profiled GROUP BY origin, kind""")

    sql["outbox_pending_income"] = with_(*FLOW, select=f"""
SELECT request_id, application_id, customer_id, prospect_id, income_requested_at, system_time,
       e1_produced_at, income_source, is_customer, kafka_source, predicted_income,
       e1_consumed_at, FALSE AS sent_to_npl, CAST(NULL AS BIGINT) AS e2_produced_at
FROM o_inc WHERE NOT ({npl_done}) ORDER BY e1_consumed_at, request_id""")
    sql["outbox_pending_npl"] = with_(*FLOW, select=f"""
SELECT {as_message(NPL_COLUMNS)} FROM o_e4 WHERE NOT ({npl_done})""")
    sql["outbox_pending_loan"] = with_(*FLOW, select=f"""
SELECT request_id AS "requestId", application_id AS "applicationId",
       effective_id AS "customerId", income_requested_at AS "incomeRequestedAt",
       system_time AS "systemTime", is_customer AS "isCustomer",
       npl_requested_at AS "nplRequestedAt", credit_score AS "creditScore",
       predicted_npl AS "predictedNpl", debt_to_income_ratio AS "debtToIncomeRatio",
       loan_decision AS "loanDecision", loan_amount AS "loanAmount", e6_stamp AS "e5ProducedAt"
FROM o_e6 WHERE NOT ({npl_done})""")
    before, now = "credit_score % 3 = 0", "credit_score % 2 = 0"
    start = "CASE WHEN is_customer THEN npl_requested_at ELSE income_requested_at END"
    sent_at = f"""CASE WHEN {before} THEN e6_stamp
      WHEN {now} THEN {start} + {clock("notify")} - system_time END"""
    sql["outbox_mark_sent"] = with_(*FLOW, select=f"""
SELECT {LOAN_COLUMNS} FROM (
  SELECT * REPLACE (({before} OR {now}) AS sent_to_ldis, {sent_at} AS e5_produced_at,
                    {sent_at} AS e6_produced_at) FROM o_loan)""")
    sql["outbox_anti"] = with_(*REQ, select="""
SELECT request_id, is_customer, system_time FROM o_req
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""")

    sql["npl_inputs_union"] = with_(
        ORDERS, stages("o"), select=f"SELECT {NPL_COLUMNS} FROM o_npl")
    both = (ORDERS, stages("o"), LINES, stages("l"))
    held_npl = f"SELECT {NPL_COLUMNS} FROM o_npl_sent WHERE {HELD} AND"
    sql["upsert_income"] = with_(*both, select=merged(
        "SELECT *, TRUE AS sent_to_npl, e2_stamp AS e2_produced_at FROM o_inc WHERE " + HELD,
        "SELECT *, FALSE AS sent_to_npl, CAST(NULL AS BIGINT) AS e2_produced_at FROM l_inc",
        INCOME_COLUMNS, {"predicted_income", "e1_consumed_at"}, {"sent_to_npl"}))
    sql["upsert_npl_income"] = with_(*both, select=merged(
        held_npl + " NOT is_customer", "SELECT * FROM l_npl WHERE NOT is_customer",
        NPL_COLUMNS,
        {"credit_score", "predicted_npl", "npl_requested_at", "e2_consumed_at"},
        {"sent_to_npl"}))
    sql["upsert_npl_request"] = with_(*both, select=merged(
        held_npl + " is_customer", "SELECT * FROM l_npl WHERE is_customer",
        NPL_COLUMNS, {"credit_score", "predicted_npl", "e3_consumed_at"}, {"sent_to_ldes"}))
    sql["upsert_loan"] = with_(*FLOW, LINES, stages("l"), decisions("l"), select=merged(
        f"SELECT * FROM ({loan_rows('TRUE')}) WHERE {HELD}", "SELECT * FROM l_loan",
        LOAN_COLUMNS,
        {"e4_consumed_at", "debt_to_income_ratio", "employment_industry",
         "employment_stability", "loan_decision", "loan_amount"},
        {"sent_to_ns", "sent_to_ldis"}))

    sql["window_metrics"] = with_(*MET, select="SELECT * FROM metrics")
    sql["line_protocol"] = with_(*MET, select="""
SELECT 'loan_decisions,window_type=tumbling' AS head, window_end * 1000000 AS time_ns,
       approved_count || 'i' AS approved_count, rejected_count || 'i' AS rejected_count,
       approval_rate, total_amount, avg_amount, avg_risk_score,
       high_risk_count || 'i' AS high_risk_count, avg_proc_time,
       window_start || 'i' AS window_start, window_end || 'i' AS window_end
FROM metrics""")
    sql["metrics_long"] = with_(*MET, select=" UNION ALL ".join(
        f"SELECT window_end AS time, 'loan_decisions' AS measurement, 'tumbling' AS window_type,"
        f" '{f}' AS field, CAST({f} AS DOUBLE) AS value FROM metrics" for f in FIELDS))
    sql["metrics_pivot"] = with_(*MET, select="SELECT window_end AS time, " + ", ".join(
        f"CAST({f} AS DOUBLE) AS {f}" for f in FIELDS) + " FROM metrics")
    recent = f"""
recent AS (
  SELECT * FROM metrics WHERE window_end >= (SELECT max(window_end) FROM metrics) - {YEAR}
)"""
    sql["dash_series"] = with_(
        *MET, recent, select="SELECT window_end AS time, approval_rate AS value FROM recent")
    sql["dash_latest"] = with_(*MET, recent, select=f"""
SELECT window_end AS time, {", ".join(LAST)} FROM recent
WHERE window_end = (SELECT max(window_end) FROM recent)""")
    sql["dash_trend_30s"] = with_(*MET, recent, select=f"""
SELECT (window_end // {WEEK} + 1) * {WEEK} AS time,
       {", ".join(f"round(avg({f}), 6) AS {f}" for f in TREND)}
FROM recent GROUP BY 1""")
    sql["dash_daily"] = with_(*MET, recent, select="""
SELECT CAST(sum(approved_count) AS BIGINT) AS approved,
       CAST(sum(rejected_count) AS BIGINT) AS rejected,
       CAST(sum(high_risk_count) AS BIGINT) AS high_risk, sum(total_amount) AS total_amount,
       round(avg(avg_amount), 6) AS avg_amount,
       sum(approved_count) / CAST(sum(approved_count) + sum(rejected_count) AS DOUBLE)
         AS daily_approval_rate
FROM recent""")

    # Read from a roll-up, the figures are the same.
    for name in ("latest", "trend_30s", "daily"):
        sql[f"rollup_{name}"] = sql[f"dash_{name}"]

    def count_line(stage: str, rel: str, sent: str) -> str:
        return f"""SELECT '{stage}' AS stage, count(*) AS n_rows,
  count(*) FILTER (WHERE income_source = 'real-time') AS n_real_time,
  count(*) FILTER (WHERE NOT is_customer) AS n_prospects,
  count(*) FILTER (WHERE {sent}) AS n_sent FROM {rel}"""

    sql["stage_counts"] = with_(*FLOW, select=" UNION ALL ".join(
        count_line(*line) for line in [
            ("income_prediction", "o_inc", "CAST(predicted_income AS BIGINT) % 10000 = 0"),
            ("npl_prediction", "o_npl", "sent_to_ldes"),
            ("loan_result", "o_loan", "credit_score % 3 = 0")]))
    sql["latest_by_max"] = with_(*FLOW, select="""
SELECT request_id, e1_produced_at, e1_consumed_at, predicted_income FROM o_inc
WHERE e1_produced_at = (SELECT max(e1_produced_at) FROM o_inc)""")
    sql["latest_prospect_npl"] = with_(*FLOW, select="""
SELECT request_id, is_customer, e4_produced_at, predicted_npl FROM o_npl_sent
WHERE e4_produced_at = (SELECT max(e4_produced_at) FROM o_npl_sent WHERE is_customer = FALSE)""")
    sql["latest_by_source"] = with_(*FLOW, select=" UNION ALL ".join(
        f"""SELECT {NPL_COLUMNS} FROM o_npl_sent WHERE income_source = '{source}'
  AND e4_produced_at = (SELECT max(e4_produced_at) FROM o_npl_sent
                        WHERE income_source = '{source}')"""
        for source in ("real-time", "batch")))
    sql["income_report"] = with_(*FLOW, select=f"""
SELECT {INCOME_COLUMNS}, {text_times(INCOME_TIMES)}
FROM (SELECT *, TRUE AS sent_to_npl, e2_stamp AS e2_produced_at FROM o_inc)
WHERE e1_produced_at = (SELECT max(e1_produced_at) FROM o_inc)""")
    sql["npl_report"] = with_(*FLOW, select=f"""
SELECT {NPL_COLUMNS}, {text_times([c for c in LOAN_TIMES if c != "e4_consumed_at"])}
FROM o_npl_sent
WHERE e4_produced_at = (SELECT max(e4_produced_at) FROM o_npl_sent WHERE NOT is_customer)""")
    sql["source_filters"] = with_(*FLOW, select="""
SELECT request_id, income_source, kafka_source, is_customer FROM o_npl
WHERE (income_source = 'batch' AND kafka_source = 'npl_prediction_request')
   OR (income_source = 'real-time' AND kafka_source <> 'npl_prediction_request')""")
    source_row = "SELECT request_id, income_source, kafka_source, is_customer FROM o_npl WHERE "
    sql["source_batch"] = with_(*FLOW, select=source_row + "income_source = 'batch'")
    sql["source_income_stage"] = with_(
        *FLOW, select=source_row + "kafka_source <> 'npl_prediction_request'")
    sql["source_high_risk_prospects"] = with_(
        *FLOW, select=source_row + f"NOT is_customer AND predicted_npl > {d(0.5)}")
    sql["alerts_default_line"] = with_(*FLOW, NOTES, select=f"""
SELECT event_time AS timestamp, customer_id, risk_score, loan_amount
FROM notes WHERE loan_decision AND risk_score > {d(0.8)}""")
    sql["event_counter_text_key"] = """
SELECT event_id, request_id,
       row_number() OVER (PARTITION BY request_id ORDER BY ts_ms, event_id) AS event_count
FROM (SELECT event_id, epoch_ms(ts) AS ts_ms,
             CASE WHEN user_id % 7 <> 0 THEN 'req-' || (user_id % 50) END AS request_id
      FROM events)"""
    sql["request_lookup"] = with_(*FLOW, select=f"""
SELECT {LOAN_COLUMNS} FROM o_loan
WHERE request_id = (SELECT 'req-' || o_orderkey FROM orders
                    ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1)""")
    sql["loan_report"] = with_(*FLOW, select=f"""
SELECT {LOAN_COLUMNS}, {text_times(LOAN_TIMES)} FROM ({loan_rows('TRUE')})
ORDER BY system_time DESC""")
    sql["epoch_format"] = with_(*FLOW, select=f"""
SELECT request_id, {text_times(INCOME_TIMES)}
FROM (SELECT *, e2_stamp AS e2_produced_at FROM o_inc)""")
    sql["newest_100"] = with_(*FLOW, select="""
SELECT request_id, system_time, credit_score, predicted_npl FROM o_npl
ORDER BY system_time DESC, request_id DESC LIMIT 100""")
    return sql
