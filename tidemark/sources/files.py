"""Files in: CSV, newline-delimited JSON and Parquet, as tables or as streams of arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CALLS, CHANGES, text_schema

CORRUPT = "_corrupt"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, null_value: str = "", encoding: str = "UTF-8"
) -> DataFrame:
    """CSV with a given schema. Inferring one is not offered: it reads every file twice and guesses dates."""
    reader = spark.read.schema(schema).option("header", header).option("nullValue", null_value)
    return reader.option("encoding", encoding).csv(path)


def read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every column as text; a malformed line is kept whole in the column _corrupt."""
    reader = spark.read.schema(text_schema(columns, CORRUPT)).option("header", True).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_parquet(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Parquet; a condition on the partition columns skips the other folders."""
    rows = spark.read.parquet(path)
    return rows if where is None else rows.filter(where)


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CALLS).json(path)


def stream_calls(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Call files as they arrive, each taken exactly once by a checkpointed query."""
    reader = spark.readStream.schema(CALLS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_changes(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(CHANGES).option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the file a row came from and when it was read; call it directly on a file source."""
    return df.withColumns({"source_file": F.col("_metadata.file_path"), "ingestion_timestamp": F.current_timestamp()})


def drift_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Top-level keys seen in JSON lines but not declared, and declared keys never seen."""
    lines = spark.read.text(path)
    seen = lines.select(F.explode(F.json_object_keys("value")).alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    declared = spark.createDataFrame([(c,) for c in schema.names], "key string").withColumn("declared", F.lit(True))
    both = seen.join(F.broadcast(declared), "key", "left").withColumn("finding", F.when(F.col("declared"), "known").otherwise("undeclared"))
    missing = declared.join(seen, "key", "left_anti").select("key", F.lit(0).cast("long").alias("n_rows"), F.lit("never_seen").alias("finding"))
    return both.select("key", "n_rows", "finding").unionByName(missing)


#: The JSON kind that each declared type is written as.
KINDS = {"string": "STRING", "boolean": "BOOLEAN"}
FOUND = "array<struct<path:string,finding:string,kind:string,value:variant>>"
RESCUED = "_rescued"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is evaluated once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _kind(value: Column) -> Column:
    """STRING, BOOLEAN, NUMBER, OBJECT, ARRAY or VOID: what a JSON value is."""
    def named(schema: Column) -> Column:
        number = schema.isin("BIGINT", "DOUBLE") | schema.startswith("DECIMAL")
        return F.when(number, "NUMBER").when(schema.startswith("OBJECT"), "OBJECT").when(schema.startswith("ARRAY"), "ARRAY").otherwise(schema)

    return _once(F.schema_of_variant(value), named)


def _object(value: Column) -> Column:
    """A JSON object as a map, NULL for any other value."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _items(value: Column) -> Column:
    """A JSON list as an array, NULL for any other value."""
    return F.try_variant_get(value, "$", "array<variant>")


def _entry(path: Column, finding: Column, piece: Column) -> Column:
    return F.struct(path.alias("path"), finding.alias("finding"), _kind(piece).alias("kind"), piece.alias("value"))


def _strays(value: Column, declared: T.DataType, path: str) -> Column:
    """What of a JSON value the declared type does not hold, with the path of each piece."""
    none = F.array().cast(FOUND)
    # null fits any type
    other_kind = F.when(value.isNotNull() & ~F.is_variant_null(value), F.array(_entry(F.lit(path), F.lit("uncastable"), value))).otherwise(none)
    if isinstance(declared, T.StructType):
        return _once(_object(value), lambda held: F.when(held.isNotNull(), _strays_in(held, declared, path)).otherwise(other_kind))
    if isinstance(declared, T.ArrayType):
        def inside(items: Column) -> Column:
            return F.flatten(F.transform(items, lambda x: _strays(x, declared.elementType, f"{path}[]")))

        return _once(_items(value), lambda items: F.when(items.isNotNull(), inside(items)).otherwise(other_kind))
    kept = F.try_variant_get(value, "$", declared.simpleString())
    bad = F.array(_entry(F.lit(path), F.when(kept.isNull(), "uncastable").otherwise("type_change"), value))
    return F.when(value.isNull() | _fits(value, kept, declared), none).otherwise(bad)


def _fits(value: Column, kept: Column, declared: T.DataType) -> Column:
    """Whether a JSON value is null or of the kind that its declared type is written as, and loses nothing as cast.

    The commonest case is asked first and with one look at the value; lambdas are not compiled, so each call counts there.
    """
    schema = F.schema_of_variant(value)
    kind = KINDS.get(declared.simpleString())
    if kind:
        return schema.isin(kind, "VOID")
    number = F.substring(schema, 1, 7).isin("BIGINT", "DECIMAL", "DOUBLE") & kept.isNotNull()
    if isinstance(declared, T.IntegralType):  # a fraction would be cut off
        number = number & (kept.cast("decimal(38,9)") == F.try_variant_get(value, "$", "decimal(38,9)"))
        number = F.when(schema == "BIGINT", kept.isNotNull()).otherwise(F.coalesce(number, kept.isNotNull()))
    return number | (schema == "VOID")


def _strays_in(held: Column, declared: T.StructType, path: str) -> Column:
    """The same for an object, as a map."""
    dot = f"{path}." if path else ""
    other = F.map_entries(F.map_filter(held, lambda k, v: ~k.isin(declared.names)))
    parts = [F.transform(other, lambda x: _entry(F.concat(F.lit(dot), x["key"]), F.lit("undeclared"), x["value"]))]
    for f in declared.fields:
        parts.append(_strays(held[f.name], f.dataType, dot + f.name))
    return F.concat(*parts)


def _typed(value: Column, declared: T.DataType) -> Column:
    """A JSON value as declared, cast field by field so that one bad field costs no other."""
    if isinstance(declared, T.StructType):
        def fields(held: Column) -> Column:
            return F.when(held.isNotNull(), F.struct(*[_typed(held[f.name], f.dataType).alias(f.name) for f in declared.fields]))

        return _once(_object(value), fields)
    if isinstance(declared, T.ArrayType):
        return F.transform(_items(value), lambda x: _typed(x, declared.elementType))
    return F.try_variant_get(value, "$", declared.simpleString())


def read_rescued(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with the declared columns and _rescued, which holds all that these do not.

    An entry of _rescued has the path (a dot before a key, [] for the elements of a list), the finding, the JSON kind and the
    value as VARIANT. Findings: undeclared, a key that the schema does not know, at any depth; type_change, a value
    of another kind, or a fraction for a whole number, that also stands in its column as cast; uncastable, one that could not and is null there; and
    corrupt, a line that is no JSON object, whole as text.
    """
    # every object is taken apart once, into a map: the work per line grows with what it holds, not with what is asked of it
    lines = spark.read.text(path).select("value", _object(F.try_parse_json("value")).alias("_held"))
    whole = F.to_variant_object(F.struct("value"))
    corrupt = F.array(F.struct(
        F.lit("").alias("path"), F.lit("corrupt").alias("finding"), F.lit("STRING").alias("kind"), F.variant_get(whole, "$.value", "variant").alias("value")
    ))
    held = F.col("_held")
    rescued = F.when(held.isNotNull(), _strays_in(held, schema, "")).otherwise(corrupt)
    return lines.select(*[_typed(held[f.name], f.dataType).alias(f.name) for f in schema.fields], rescued.alias(RESCUED))


def rescue_report(rows: DataFrame) -> DataFrame:
    """path, finding, kind and n_rows: how many rows hold each kind of stray value."""
    found = rows.select(F.explode(F.array_distinct(F.transform(RESCUED, lambda x: F.struct(x["path"], x["finding"], x["kind"])))).alias("x"))
    return found.groupBy("x.path", "x.finding", "x.kind").agg(F.count(F.lit(1)).alias("n_rows"))


def sample_rows(df: DataFrame, n: int, order: list[str], last: bool = False) -> DataFrame:
    """The first or last n rows in a stated order."""
    columns = [F.col(c).desc() if last else F.col(c).asc() for c in order]
    return df.orderBy(*columns).limit(n)
