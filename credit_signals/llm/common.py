"""Small helpers that the operators share."""

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_signals.session import app_id, scratch_path

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = app_id(spark)
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="credit-signals-ship-"), "credit_signals_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)   # Spark copies it to every executor
    _SHIPPED.add(app)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    The shuffle files of the write go when it is done: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string array, a few rows at a time; null counts as empty."""
    for at in range(0, len(texts), 64):
        for value in texts.slice(at, 64).cast(pa.binary()).to_pylist():
            yield value if value is not None else b""


BATCH_CHARS = 2_000_000          # texts are worked on together up to this many characters


def batches(texts: pa.Array, chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Lists of texts of about ``chars`` characters together (one text at least); null counts as empty."""
    out, size = [], 0
    for at in range(0, len(texts), 64):
        for text in texts.slice(at, 64).to_pylist():
            out.append(text or "")
            size += len(out[-1])
            if size >= chars:
                yield out
                out, size = [], 0
    if out:
        yield out


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def keep_chosen(docs: DataFrame, key: Column, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (key, id) is in ``chosen`` (key, id, copies), one row for each.

    ``copies`` tells how many rows share the pair.  Only rows of pairs with
    several copies (repeated rows) are compared: the first by text, then by all
    columns, stays.  Joining on the id too spreads a hot key.
    """
    k, c = free_name(docs, "key_of_row"), free_name(docs, "chosen_of_row")
    keyed = docs.withColumn(k, key)
    wanted = chosen.select(F.struct("key", "id", "copies").alias(c))
    kept = keyed.join(wanted, (F.col(k) == F.col(f"{c}.key")) & keyed[id_col].eqNullSafe(F.col(f"{c}.id")))
    once = kept.where(F.col(f"{c}.copies") == 1).select(*docs.columns)
    row = F.struct(*[F.col(x) for x in docs.columns])
    first = kept.where(F.col(f"{c}.copies") > 1).groupBy(F.col(k), F.col(id_col)) \
        .agg(F.min_by(row, F.struct(F.col(text_col), F.to_json(row))).alias("row")) \
        .select(*[F.col("row").getField(x).alias(x) for x in docs.columns])
    return once.unionByName(first)
