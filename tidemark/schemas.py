"""Fixed schemas of the external files; nothing is inferred from data."""

from pyspark.sql import types as T


def text_schema(columns: list[str], corrupt: str | None = None) -> T.StructType:
    names = [*columns, corrupt] if corrupt else columns
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


SEGMENT = T.StructType(
    [
        T.StructField("speaker", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("start_sec", T.DoubleType()),
    ]
)

CALLS = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("agent_id", T.StringType()),
        T.StructField("epoch_timestamp", T.LongType()),
        T.StructField("duration_sec", T.IntegerType()),
        T.StructField("transcript_segments", T.ArrayType(SEGMENT)),
        T.StructField(
            "metadata",
            T.StructType([T.StructField(c, T.StringType()) for c in ("call_type", "channel", "region")]),
        ),
        T.StructField("_injection_type", T.StringType()),
    ]
)

CHANGES = text_schema(["customer_id", "city", "subscription_type", "age", "signup_date", "operation", "update_ts"])

TYPED_CHANGES = T.StructType(
    [
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("subscription_type", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("operation", T.StringType()),
        T.StructField("update_ts", T.TimestampNTZType()),
    ]
)

HISTORY = T.StructType(
    [
        *[f for f in TYPED_CHANGES.fields if f.name not in {"operation", "update_ts"}],
        T.StructField("__start_at", T.TimestampNTZType()),
        T.StructField("__end_at", T.TimestampNTZType()),
    ]
)

EMPLOYEES = T.StructType(
    [
        T.StructField("employee_id", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("salary", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("join_date", T.StringType()),
        T.StructField("years_exp", T.IntegerType()),
        T.StructField("status", T.StringType()),
    ]
)


# The star schema and event tables, so that reading one starts no job to look at its files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
}
