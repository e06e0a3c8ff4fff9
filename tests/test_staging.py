"""Staged inputs follow their files."""

import shutil

from paths import SF001
from pyspark.sql import functions as F

from credit_signals.session import file_state
from credit_signals.sources import fixtures as fx
from credit_signals.sources import readers as RD


def copied(tmp_path):
    folder = tmp_path / "tables"
    folder.mkdir()
    for name in fx.SOURCES:
        shutil.copy(f"{SF001}/{name}.parquet", folder / f"{name}.parquet")
    return folder


def test_a_replaced_file_gives_new_rows(spark, tmp_path):
    folder = copied(tmp_path)
    before = fx.stage_inputs(spark, str(folder))
    assert fx.stage_inputs(spark, f"{folder}/") is before
    n = fx.accounts(spark, str(folder)).count()
    parts = {name: at for (_, path, name), (_, at) in fx._PARTS.items() if path == str(folder)}
    customers = spark.read.parquet(f"{SF001}/customer.parquet")
    customers.union(customers.limit(1).withColumn("c_custkey", F.lit(999_999).cast("long"))) \
        .coalesce(1).toPandas().to_parquet(folder / "customer.parquet")
    after = fx.stage_inputs(spark, str(folder))
    assert after is not before and fx.accounts(spark, str(folder)).count() == n + 1
    # the order and line sums did not read the changed table
    assert {name: at for (_, path, name), (_, at) in fx._PARTS.items() if path == str(folder)} == parts


def test_only_parts_of_changed_tables_are_derived(spark, tmp_path):
    folder = copied(tmp_path)
    fx.stage_inputs(spark, str(folder))
    parts = {name: at for (_, path, name), (_, at) in fx._PARTS.items() if path == str(folder)}
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    lines.where(F.col("l_orderkey") % 2 == 0).coalesce(1).write.parquet(str(tmp_path / "less"))
    (folder / "lineitem.parquet").unlink()
    shutil.copytree(tmp_path / "less", folder / "lineitem.parquet")
    fx.stage_inputs(spark, str(folder))
    new = {name: at for (_, path, name), (_, at) in fx._PARTS.items() if path == str(folder)}
    assert new["order-sums"] == parts["order-sums"] and new["line-counts"] != parts["line-counts"]


def test_file_state(spark, tmp_path):
    folder = copied(tmp_path)
    paths = {name: str(folder / f"{name}.parquet") for name in fx.SOURCES}
    state = file_state(spark, paths)
    assert state == file_state(spark, paths) and all(files == 1 and size > 0 for files, size, _ in state.values())
    (folder / "orders.parquet").touch()
    again = file_state(spark, paths)
    assert again["orders"] != state["orders"] and again["customer"] == state["customer"]


def test_integers_become_the_nearest_end(spark):
    df = spark.createDataFrame([(v,) for v in (2**31, 2**31 - 1, -2**31, -2**31 - 1, 2**62, 0, None)], "v long")
    assert [r[0] for r in df.select(fx.to_int(F.col("v"))).collect()] == \
        [2**31 - 1, 2**31 - 1, -2**31, -2**31, 2**31 - 1, 0, None]


def test_schema_tree(spark):
    df = spark.createDataFrame([], "a int not null, s struct<x: array<map<string, struct<y: double>>>, `odd name`: date>")
    got = [tuple(r) for r in RD.schema_tree(df).collect()]
    assert got == [
        (1, "a", 0, "int", False), (2, "s", 0, "struct", True), (3, "s.x", 1, "array", True), (4, "s.x.element", 2, "map", True),
        (5, "s.x.element.key", 3, "string", False), (6, "s.x.element.value", 3, "struct", True),
        (7, "s.x.element.value.y", 4, "double", True), (8, "s.odd name", 1, "date", True)]
    assert RD.schema_tree(spark.range(1)).count() == 1
