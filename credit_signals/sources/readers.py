"""Scans with declared schemas, load counts, schema profile and preview."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_signals import schemas


def is_table(spark: SparkSession, name: str) -> bool:
    """True for a catalog table name (as opposed to a file path)."""
    if "/" in name or ":" in name:
        return False
    try:
        return spark.catalog.tableExists(name)
    except Exception:  # noqa: BLE001 - unparsable names are paths
        return False


def register_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int,
                      key: str = "account_id", name: str | None = None) -> str:
    """Register files written bucketed by ``key`` as an external table again
    (same bucket spec), e.g. in a later application; reads are then bucketed
    and a join on ``key`` with an equally bucketed table needs no exchange."""
    import uuid
    name = name or f"credit_signals_ext_{uuid.uuid4().hex[:12]}"
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return name


def _read(spark: SparkSession, source: str, schema: T.StructType) -> DataFrame:
    """A path or a catalog table, conformed to ``schema``.

    Files are read with their own footer schema and then cast: integer
    columns written as 64-bit (pandas' default) cannot be read through a
    declared 32-bit schema, but cast fine (ANSI: an out-of-range value
    raises).  A folder without files (an empty table) is read with the declared
    schema.  A missing column raises.  When the types already match, the
    frame is returned as read (no extra projection).
    """
    try:
        df = spark.table(source) if is_table(spark, source) else spark.read.parquet(source)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        df = spark.read.schema(schema).parquet(source)
    return schemas.conform(df, schema)


def read_accounts(spark: SparkSession, source: str) -> DataFrame:
    """A path, or a catalog table (keeps its bucketing, so joins on the key
    need no exchange); columns conformed to the declared schema."""
    return _read(spark, source, schemas.ACCOUNTS)


def read_bureau(spark: SparkSession, source: str) -> DataFrame:
    return _read(spark, source, schemas.BUREAU)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Hive-partitioned feature table; ``high_risk_flag`` comes from the folder
    names (typed int) and stays last, so a filter on it prunes whole folders."""
    return _read(spark, path, schemas.FEATURES)


def read_published_features(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """A version (the latest by default) of a table that ``writers.publish_features`` writes."""
    from credit_signals.sinks import manifest
    version = manifest.read(table, number)
    return read_features(spark, f"{table.rstrip('/')}/{version.files[0]['file']}")


def load_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count), each a single-pass count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def schema_profile(df: DataFrame) -> DataFrame:
    """The column tree as rows: (position, column_name, data_type, nullable)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType()), T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()), T.StructField("nullable", T.BooleanType()),
    ])
    return df.sparkSession.createDataFrame(rows, schema)


def _walk(kind: T.DataType, path: str, depth: int, nullable: bool):
    yield path, depth, kind.simpleString() if not isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) \
        else kind.typeName(), nullable
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _walk(f.dataType, f"{path}.{f.name}", depth + 1, f.nullable)
    elif isinstance(kind, T.ArrayType):
        yield from _walk(kind.elementType, f"{path}.element", depth + 1, kind.containsNull)
    elif isinstance(kind, T.MapType):
        yield from _walk(kind.keyType, f"{path}.key", depth + 1, False)
        yield from _walk(kind.valueType, f"{path}.value", depth + 1, kind.valueContainsNull)


def schema_tree(df: DataFrame) -> DataFrame:
    """Every node of the column tree: (position, path, depth, data_type, nullable), parents before their parts.

    Columns have depth 0; the parts of a struct are named by their fields, of an
    array ``element``, of a map ``key`` and ``value``.
    """
    nodes = [node for f in df.schema.fields for node in _walk(f.dataType, f.name, 0, f.nullable)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType()), T.StructField("path", T.StringType()),
        T.StructField("depth", T.IntegerType()), T.StructField("data_type", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
    ])
    return df.sparkSession.createDataFrame([(i + 1, *node) for i, node in enumerate(nodes)], schema)


def preview(df: DataFrame, n: int = 5, key: str = "account_id") -> DataFrame:
    """First ``n`` rows by key (a top-k, not an arbitrary sample)."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)
