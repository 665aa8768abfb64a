"""Readers, writers, versions and JDBC option building."""

import pytest
from pyspark.sql import functions as F

from broadloom.session import checkpointed, shared_path, shared_root
from broadloom.sources import files, jdbc, tables


def test_trailing_comma_column_is_dropped(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text("SYMBOL,CLOSE,\nINFY,10.5,\nTCS,20,\n")
    df = files.scan_csv_infer(spark, str(path))
    assert df.dtypes == [("SYMBOL", "string"), ("CLOSE", "double")] and df.count() == 2


def test_nested_json(spark, tmp_path):
    path = tmp_path / "movies.json"
    path.write_text(
        '{"title":"A","cast":{"Director":"D1","LeadActor":"L1"},"genres":["x","y"],"ratings":{"i":1.5,"r":2.0}}\n'
        '{"title":"B","cast":{"Director":"D2","LeadActor":"L1"},"genres":["x","z"],"ratings":{"i":3.5,"r":4.0}}\n'
    )
    schema = "title string, cast struct<Director: string, LeadActor: string>, genres array<string>, ratings map<string, double>"
    df = files.scan_json(spark, str(path), schema)
    genres = df.select("title", F.explode("genres").alias("g"), "ratings")
    assert genres.count() == 4 and genres.select("title", "g", F.explode("ratings")).count() == 8
    assert df.groupBy("cast.LeadActor").count().first()["count"] == 2
    assert files.scan_json(spark, str(path)).select("cast.Director").count() == 2


def test_versions(spark):
    path = shared_path(spark, "versions")
    assert tables.versions(spark, path) == []
    assert tables.write_version(spark.range(5), path) == 0
    assert tables.write_version(spark.range(9), path) == 1
    assert tables.read_version(spark, path).count() == 9
    assert tables.read_version(spark, path, 0).count() == 5
    with pytest.raises(ValueError):
        tables.read_version(spark, path, 7)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = checkpointed(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_round_trips(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("k"), (F.col("id") * 3).cast("string").alias("v"))
    a, b = shared_path(spark, "seq"), shared_path(spark, "obj")
    files.sink_sequence(df, "k", "v", a)
    files.sink_object(df, b)
    assert sorted(map(tuple, files.scan_sequence(spark, a).collect())) == sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, files.scan_object(spark, b, df.schema).collect())) == sorted(map(tuple, df.collect()))
    sizes = {r.format: r.bytes for r in files.format_size_report(spark.range(1000), shared_path(spark, "sz")).collect()}
    assert set(sizes) == {"orc", "parquet"} and all(v > 0 for v in sizes.values())


def test_rows_and_views(spark):
    df = spark.createDataFrame([("INFY", 1), ("TCS", 2)], "symbol string, n int")
    df.createOrReplaceTempView("rows_view")
    assert spark.sql("SELECT sum(n) AS s FROM rows_view").first().s == 3


def test_external_table_name_is_checked(spark):
    with pytest.raises(ValueError):
        tables.external_table(spark, "a; DROP TABLE b", "/x")


def test_jdbc_options_and_modes(spark):
    target = jdbc.JdbcTarget("jdbc:x://h/db", "org.example.Driver", {"user": "u", "fetchsize": "1000"})
    assert target.options(dbtable="t") == {
        "url": "jdbc:x://h/db", "driver": "org.example.Driver", "user": "u", "fetchsize": "1000", "dbtable": "t",
    }
    with pytest.raises(ValueError):
        jdbc.sink_jdbc(spark.range(1), target, "t", mode="truncate")


def test_registry_loads_without_a_session():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 200"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
