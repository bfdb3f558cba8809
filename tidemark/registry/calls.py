"""Sentiment, customer history and call KPIs (SEN, CDC, STR batch side, KPI, JN-9, JN-10) and their SQL."""

from pyspark.sql import functions as F

from tidemark.functions import sentiment as S
from tidemark.operators import history as H
from tidemark.operators import joins
from tidemark.operators import quality as Q
from tidemark.plans import calls as P
from tidemark.registry.base import query, with_tables
from tidemark.session import freeze
from tidemark.sources import adapters as A


def in_list(listing):
    return ", ".join("'" + w + "'" for w in sorted(listing))


def score_sql(tokens, lexicon=S.DEFAULT):
    """Score of a token list: a word counts double iff the token before it is an intensifier."""
    strong, good, bad = (in_list(x) for x in (lexicon.intensifiers, lexicon.positive, lexicon.negative))
    total = f"""coalesce(list_sum(list_transform({tokens}, lambda t, i:
        CASE WHEN t IN ({strong}) THEN 0
             WHEN t IN ({good}) THEN CASE WHEN i > 1 AND {tokens}[i - 1] IN ({strong}) THEN 2 ELSE 1 END
             WHEN t IN ({bad}) THEN CASE WHEN i > 1 AND {tokens}[i - 1] IN ({strong}) THEN -2 ELSE -1 END
             ELSE 0 END)), 0)"""
    return f"round(CAST({total} AS DOUBLE) / (abs(CAST({total} AS DOUBLE)) + 1), 4)"


TOKENS = "regexp_extract_all(lower({0}), '[a-z'']+')"


def label_sql(c):
    return f"CASE WHEN {c} > 0.1::DOUBLE THEN 'positive' WHEN {c} < -0.1::DOUBLE THEN 'negative' ELSE 'neutral' END"


K = r"(SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events)"
CTES = {
    "call_rows": f"""
        SELECT CASE WHEN value >= 0.5::DOUBLE THEN 'C' || event_id END AS call_id,
               CASE WHEN k <> 7 THEN CAST(user_id AS INTEGER) END AS customer_id, 'A' || k AS agent_id,
               CASE WHEN k <> 13 OR value > 3 THEN CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) END AS epoch_timestamp,
               CAST(CASE WHEN value < 1 THEN -1 - floor(value * 10) ELSE floor(value * 10) END AS INTEGER) AS duration_sec,
               CASE WHEN k <> 17 THEN 1 END AS has_segments,
               CASE WHEN k < 50 THEN 'How can I help you today' ELSE 'Glad we solved it' END AS reply,
               CASE WHEN event_type = 'error'
                    THEN 'I am extremely frustrated, this is a terrible problem. It never works!'
                    WHEN event_type = 'purchase' THEN 'Great service, very happy and thanks for the quick help'
                    WHEN event_type = 'view' THEN 'I have a question about my bill'
                    WHEN event_type = 'signup' AND k < 50 THEN 'absolutely brilliant onboarding, totally easy'
                    WHEN event_type = 'signup' THEN 'my refund is delayed'
                    ELSE 'the issue was fixed but it is very very slow' END AS said,
               event_type AS call_type, CASE WHEN k < 60 THEN 'phone' ELSE 'chat' END AS channel,
               CASE WHEN k < 30 THEN 'Delhi' ELSE 'Pune' END AS region
        FROM {K}""",
    "call_events": "SELECT * FROM call_rows UNION ALL SELECT * FROM call_rows WHERE duration_sec > 800",
    "timed_calls": """
        SELECT DISTINCT *, CAST(TIMESTAMP '1970-01-01' + to_seconds(epoch_timestamp) AS TIMESTAMP) AS event_ts
        FROM call_events WHERE duration_sec >= 0 AND epoch_timestamp IS NOT NULL AND call_id IS NOT NULL""",
    "silver": f"""
        SELECT *, {label_sql('sentiment_score')} AS sentiment_label FROM (
            SELECT call_id, customer_id, agent_id, epoch_timestamp, duration_sec, event_ts, call_type, channel, region,
                   speaker, text, start_sec, {score_sql('tok')} AS sentiment_score
            FROM (SELECT *, {TOKENS.format('text')} AS tok FROM (
                SELECT *, 'agent' AS speaker, reply AS text, CAST(0.0 AS DOUBLE) AS start_sec FROM timed_calls
                WHERE has_segments = 1
                UNION ALL SELECT *, 'customer', said, CAST(4.5 AS DOUBLE) FROM timed_calls WHERE has_segments = 1)))""",
    "call_level": f"""
        SELECT * EXCLUDE (mean), round(mean, 6) AS call_sentiment_score, {label_sql('mean')} AS call_label FROM (
            SELECT call_id, customer_id, duration_sec, CAST(event_ts AS DATE) AS date, event_ts,
                   CAST(sum(CAST(sentiment_score AS DECIMAL(10,4))) AS DOUBLE) / count(*) AS mean
            FROM silver GROUP BY ALL)""",
    "changes": f"""
        SELECT CASE WHEN k = 99 THEN NULL WHEN k = 98 THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS customer_id,
               CASE WHEN k < 20 THEN 'Delhi' WHEN k < 40 THEN 'Mumbai' WHEN k < 60 THEN 'Chennai' WHEN k < 80 THEN 'Pune'
                    ELSE 'Jaipur' END AS city,
               CASE WHEN value > 20 THEN 'Premium' ELSE 'Basic' END AS subscription_type, CAST(k AS VARCHAR) AS age,
               CASE WHEN k = 50 THEN 'soon' ELSE '2023-05-17' END AS signup_date,
               CASE WHEN k = 97 THEN 'UPSERT' WHEN k = 96 THEN NULL WHEN event_type = 'signup' THEN 'INSERT'
                    WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
               CASE WHEN k = 95 THEN NULL WHEN k = 94 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END
                   AS update_ts
        FROM {K}""",
    "valid_changes": """
        SELECT TRY_CAST(customer_id AS INTEGER) AS customer_id, city, subscription_type, TRY_CAST(age AS INTEGER) AS age,
               TRY_CAST(signup_date AS DATE) AS signup_date, operation, TRY_CAST(update_ts AS TIMESTAMP) AS update_ts
        FROM changes WHERE TRY_CAST(customer_id AS INTEGER) IS NOT NULL AND operation IN ('INSERT', 'UPDATE', 'DELETE')
             AND TRY_CAST(update_ts AS TIMESTAMP) IS NOT NULL""",
    "moments": """
        SELECT *, operation = 'DELETE' AS gone FROM valid_changes
        QUALIFY row_number() OVER (PARTITION BY customer_id, update_ts ORDER BY operation = 'DELETE' DESC, city DESC,
                                   subscription_type DESC, age DESC, signup_date DESC) = 1""",
    "marked": """
        SELECT *, CASE WHEN lag(update_ts) OVER w IS NULL OR lag(gone) OVER w OR gone
                            OR lag(city) OVER w IS DISTINCT FROM city
                            OR lag(subscription_type) OVER w IS DISTINCT FROM subscription_type THEN 1 ELSE 0 END AS is_new
        FROM moments WINDOW w AS (PARTITION BY customer_id ORDER BY update_ts)""",
    "numbered": """
        SELECT *, sum(is_new) OVER (PARTITION BY customer_id ORDER BY update_ts) AS ver FROM marked""",
    "history": """
        SELECT * EXCLUDE (gone, ver) FROM (
            SELECT customer_id, ver, bool_or(gone) AS gone, arg_max(city, update_ts) AS city,
                   arg_max(subscription_type, update_ts) AS subscription_type, last(age ORDER BY update_ts) AS age,
                   last(signup_date ORDER BY update_ts) AS signup_date, min(update_ts) AS __start_at,
                   lead(min(update_ts)) OVER (PARTITION BY customer_id ORDER BY ver) AS __end_at
            FROM numbered GROUP BY customer_id, ver) WHERE NOT gone""",
    "now_customers": "SELECT customer_id, city, subscription_type, age FROM history WHERE __end_at IS NULL",
    "enriched": """
        SELECT c.*, n.city, n.subscription_type, n.age FROM call_level c
        LEFT JOIN now_customers n ON n.customer_id = c.customer_id""",
    "then_enriched": """
        SELECT c.*, h.city, h.subscription_type, h.age FROM call_level c
        LEFT JOIN history h ON h.customer_id = c.customer_id AND h.__start_at <= c.event_ts
                  AND (h.__end_at IS NULL OR c.event_ts < h.__end_at)""",
}
SILVER = "call_rows call_events timed_calls silver"
LEVEL = SILVER + " call_level"
HISTORY = "changes valid_changes moments marked numbered history"
NOW = LEVEL + " " + HISTORY + " now_customers enriched"
THEN = LEVEL + " " + HISTORY + " then_enriched"


def sql(names, body):
    return with_tables(CTES, names, body)


def sentiment_by_sql(by, source):
    return f"""
        SELECT {by}, count(DISTINCT call_id) AS total_calls,
               count(*) FILTER (call_label = 'positive') AS positive_calls,
               count(*) FILTER (call_label = 'negative') AS negative_calls,
               count(*) FILTER (call_label = 'neutral') AS neutral_calls,
               round(CAST(sum(CAST(call_sentiment_score AS DECIMAL(12,6))) AS DOUBLE) / count(*), 4) AS avg_sentiment_score,
               round(CAST(count(*) FILTER (call_label = 'positive') AS DOUBLE) / count(DISTINCT call_id), 4)
                   AS sentiment_ratio
        FROM {source} GROUP BY {by}"""


def silver(spark, sf):
    return P.silver_calls(A.calls(spark, sf))


def level(spark, sf):
    return P.call_level(silver(spark, sf))


def history(spark, sf):
    valid, _ = P.split_changes(A.customer_changes(spark, sf))
    return P.customer_history(valid)


def enriched(spark, sf):
    return P.with_current_customer(level(spark, sf), H.current(history(spark, sf)))


# ---- sentiment

SEGMENT = "call_id, event_ts, speaker, text, start_sec, sentiment_score, sentiment_label"


@query("sen_1_score_segments", sql(SILVER, "SELECT call_id, event_ts, speaker, text, sentiment_score FROM silver"))
def sen_1(spark, sf):
    return silver(spark, sf).select("call_id", "event_ts", "speaker", "text", "sentiment_score")


@query(
    "sen_2_labels",
    sql(SILVER, "SELECT sentiment_label, speaker, count(*) AS n FROM silver GROUP BY 1, 2"),
)
def sen_2(spark, sf):
    return silver(spark, sf).groupBy("sentiment_label", "speaker").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sen_3_call_scores",
    sql(LEVEL, "SELECT call_id, event_ts, call_sentiment_score, call_label FROM call_level"),
)
def sen_3(spark, sf):
    return level(spark, sf).select("call_id", "event_ts", "call_sentiment_score", "call_label")


CORPUS = S.Lexicon(
    frozenset({"that", "thin", "est", "aux", "der"}), frozenset({"whou", "er", "eron", "la", "und"}),
    frozenset({"the", "in", "le", "die"}),
)


@query(
    "sen_4_own_lexicon_over_documents",
    f"""SELECT doc_id, sentiment_score, {label_sql('sentiment_score')} AS sentiment_label FROM (
            SELECT doc_id, {score_sql('tok', CORPUS)} AS sentiment_score
            FROM (SELECT doc_id, {TOKENS.format('text')} AS tok FROM documents))""",
)
def sen_4(spark, sf):
    rows = S.score_segments(A.table(spark, sf, "documents"), "text", CORPUS)
    return rows.select("doc_id", "sentiment_score", "sentiment_label")


@query(
    "sen_1_score_conversations",
    f"""SELECT conv_id, turn, {score_sql('tok', CORPUS)} AS sentiment_score
        FROM (SELECT *, {TOKENS.format('text')} AS tok FROM conversations)""",
)
def sen_1_conversations(spark, sf):
    return S.score_segments(A.table(spark, sf, "conversations"), "text", CORPUS).select("conv_id", "turn", "sentiment_score")


# ---- customer history


@query(
    "cdc_1_typed_changes",
    sql("changes", """
        SELECT TRY_CAST(customer_id AS INTEGER) AS customer_id, city, subscription_type, TRY_CAST(age AS INTEGER) AS age,
               TRY_CAST(signup_date AS DATE) AS signup_date, operation, TRY_CAST(update_ts AS TIMESTAMP) AS update_ts
        FROM changes"""),
)
def cdc_1(spark, sf):
    return P.typed_changes(A.customer_changes(spark, sf))


@query(
    "dq_8_rejected_changes",
    sql("changes", """
        SELECT * FROM (SELECT *, CASE WHEN customer_id IS NULL THEN 'null_customer_id'
                   WHEN TRY_CAST(customer_id AS INTEGER) IS NULL THEN 'uncastable_customer_id'
                   WHEN operation IS NULL OR operation NOT IN ('INSERT', 'UPDATE', 'DELETE') THEN 'invalid_operation'
                   WHEN update_ts IS NULL THEN 'null_update_ts'
                   WHEN TRY_CAST(update_ts AS TIMESTAMP) IS NULL THEN 'uncastable_update_ts' END AS reject_reason
        FROM changes) WHERE reject_reason IS NOT NULL"""),
)
def dq_8_changes(spark, sf):
    return P.split_changes(A.customer_changes(spark, sf))[1]


@query("cdc_2_scd2_history", sql(HISTORY, "SELECT * FROM history"))
def cdc_2(spark, sf):
    return history(spark, sf)


@query("cdc_2_scd2_history_busy_keys", sql(HISTORY, "SELECT * FROM history"))
def cdc_2_busy(spark, sf):
    return history(spark, sf)


@query("cdc_3_current_snapshot", sql(HISTORY, "SELECT * EXCLUDE (__end_at) FROM history WHERE __end_at IS NULL"))
def cdc_3(spark, sf):
    return H.current(history(spark, sf)).drop(H.END)


@query(
    "cdc_4_as_of_snapshot",
    sql(HISTORY, """
        SELECT * FROM history WHERE __start_at <= TIMESTAMP '2024-01-15'
             AND (__end_at IS NULL OR TIMESTAMP '2024-01-15' < __end_at)"""),
)
def cdc_4(spark, sf):
    return H.as_of(history(spark, sf), F.lit("2024-01-15").cast("timestamp_ntz"))


POINT = sql(THEN, "SELECT call_id, customer_id, event_ts, city, subscription_type, age FROM then_enriched")


def then_enriched(spark, sf):
    versions = history(spark, sf).drop("signup_date")
    return joins.point_in_time(level(spark, sf), versions, "customer_id", "event_ts")


@query("jn_10_point_in_time", POINT)
def jn_10(spark, sf):
    return then_enriched(spark, sf).select("call_id", "customer_id", "event_ts", "city", "subscription_type", "age")


@query("jn_10_point_in_time_many_versions", POINT)
def jn_10_many(spark, sf):
    return then_enriched(spark, sf).select("call_id", "customer_id", "event_ts", "city", "subscription_type", "age")


@query("cdc_5_point_in_time_enrichment", POINT)
def cdc_5(spark, sf):
    return jn_10(spark, sf)


@query(
    "cdc_7_exclude_bookkeeping",
    sql(HISTORY, "SELECT customer_id, age, signup_date, __start_at FROM history"),
)
def cdc_7(spark, sf):
    valid, _ = P.split_changes(A.customer_changes(spark, sf))
    told = valid.withColumns({"source_file": F.lit("changes.csv"), "ingestion_timestamp": F.col("update_ts")})
    versions = P.customer_history(told)
    return versions.select(*[c for c in versions.columns if c not in {"city", "subscription_type", H.END}])


@query("jn_9_current_version_join", sql(NOW, "SELECT call_id, customer_id, event_ts, city, subscription_type, age FROM enriched"))
def jn_9(spark, sf):
    return enriched(spark, sf).select("call_id", "customer_id", "event_ts", "city", "subscription_type", "age")


# ---- steps of the call job, as a batch


@query(
    "str_4_null_event_time_filtered",
    sql("call_rows call_events", """
        SELECT call_id, customer_id, epoch_timestamp, duration_sec FROM call_events
        WHERE epoch_timestamp IS NOT NULL AND duration_sec >= 0 AND call_id IS NOT NULL"""),
)
def str_4(spark, sf):
    rows = Q.expect_or_drop(P.with_event_time(A.calls(spark, sf)), P.silver_call_rules())
    return rows.select("call_id", "customer_id", "epoch_timestamp", "duration_sec")


@query(
    "str_5_flatten_metadata",
    sql("call_rows call_events", "SELECT call_id, agent_id, call_type, channel, region FROM call_events"),
)
def str_5(spark, sf):
    return P.flatten_metadata(A.calls(spark, sf)).select("call_id", "agent_id", "call_type", "channel", "region")


@query(
    "str_6_explode_segments",
    sql("call_rows call_events", """
        SELECT call_id, agent_id, 'agent' AS speaker, reply AS text, CAST(0.0 AS DOUBLE) AS start_sec FROM call_events
        WHERE has_segments = 1
        UNION ALL SELECT call_id, agent_id, 'customer', said, CAST(4.5 AS DOUBLE) FROM call_events WHERE has_segments = 1"""),
)
def str_6(spark, sf):
    return P.explode_segments(A.calls(spark, sf)).select("call_id", "agent_id", "speaker", "text", "start_sec")


@query(
    "str_6_calls_without_segments",
    sql("call_rows call_events", "SELECT count(*) AS calls_without_segments FROM call_events WHERE has_segments IS NULL"),
)
def str_6_without(spark, sf):
    return P.calls_without_segments(A.calls(spark, sf))


@query("str_7_silver_calls", sql(SILVER, "SELECT * FROM silver"))
def str_7(spark, sf):
    return silver(spark, sf)


@query(
    "str_3_lateness_report",
    sql("call_rows call_events", """
        SELECT CAST(floor(((SELECT max(epoch_timestamp) FROM call_events) - epoch_timestamp) / 600) * 10 AS BIGINT)
               AS minutes_behind, count(*) AS n_calls FROM call_events WHERE epoch_timestamp IS NOT NULL GROUP BY 1"""),
)
def str_3(spark, sf):
    return P.lateness(A.calls(spark, sf))


def rules_sql(rules, table):
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS rule, count(*) FILTER (coalesce({c}, false)) AS passed,
                   count(*) FILTER (NOT coalesce({c}, false)) AS failed FROM {table}""" for n, c in rules.items()
    )


@query(
    "dq_6_bronze_calls",
    sql("call_rows call_events", rules_sql(
        {"valid_call_id": "call_id IS NOT NULL", "valid_customer_id": "customer_id IS NOT NULL",
         "valid_epoch": "epoch_timestamp IS NOT NULL",
         "non_negative_duration": "duration_sec IS NULL OR duration_sec >= 0"}, "call_events")),
)
def dq_6_calls(spark, sf):
    return Q.expectation_report(A.calls(spark, sf), P.bronze_call_rules())


@query(
    "dq_6_bronze_changes",
    sql("changes", rules_sql(
        {"valid_customer_id": "customer_id IS NOT NULL", "valid_operation": "operation IN ('INSERT','UPDATE','DELETE')",
         "valid_update_ts": "update_ts IS NOT NULL"}, "changes")),
)
def dq_6_changes(spark, sf):
    return Q.expectation_report(A.customer_changes(spark, sf), P.bronze_change_rules())


# ---- KPI tables


@query("kpi_1_sentiment_daily", sql(LEVEL, sentiment_by_sql("date", "call_level")))
def kpi_1(spark, sf):
    return P.sentiment_daily(level(spark, sf))


@query(
    "kpi_2_call_volume_daily",
    sql(SILVER, """
        WITH c AS (SELECT call_id, CAST(event_ts AS DATE) AS date, max(duration_sec) AS duration_sec FROM silver GROUP BY 1, 2)
        SELECT date, count(DISTINCT call_id) AS total_calls, round(avg(duration_sec), 1) AS avg_duration_sec,
               max(duration_sec) AS max_duration_sec, min(duration_sec) AS min_duration_sec FROM c GROUP BY 1"""),
)
def kpi_2(spark, sf):
    return P.call_volume_daily(silver(spark, sf))


@query(
    "kpi_3_high_risk_customers",
    sql(NOW, """
        SELECT customer_id, city, subscription_type, age, count(DISTINCT call_id) AS total_calls_7d,
               count(*) FILTER (call_label = 'negative') AS negative_call_count_7d,
               max(event_ts) FILTER (call_label = 'negative') AS last_negative_call_ts,
               round(CAST(sum(CAST(call_sentiment_score AS DECIMAL(12,6))) AS DOUBLE) / count(*), 4)
                   AS avg_sentiment_score_7d
        FROM enriched WHERE event_ts >= (SELECT max(event_ts) FROM call_level) - INTERVAL 7 DAYS
        GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (call_label = 'negative') >= 3"""),
)
def kpi_3(spark, sf):
    return P.high_risk_customers(freeze(level(spark, sf)), H.current(history(spark, sf)))


@query("kpi_4_region_sentiment", sql(NOW, sentiment_by_sql("city, date", "enriched")))
def kpi_4(spark, sf):
    return P.region_sentiment(enriched(spark, sf))


@query("kpi_5_subscription_sentiment", sql(NOW, sentiment_by_sql("subscription_type, date", "enriched")))
def kpi_5(spark, sf):
    return P.subscription_sentiment(enriched(spark, sf))


@query("kpi_6_region_sentiment_at_call_time", sql(THEN, sentiment_by_sql("city, date", "then_enriched")))
def kpi_6_region(spark, sf):
    return P.region_sentiment(then_enriched(spark, sf))


@query("kpi_6_subscription_sentiment_at_call_time", sql(THEN, sentiment_by_sql("subscription_type, date", "then_enriched")))
def kpi_6_subscription(spark, sf):
    return P.subscription_sentiment(then_enriched(spark, sf))
