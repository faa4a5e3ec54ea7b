import os
import tempfile

from pyspark.sql import functions as F

from martforge.session import checkpoint_dir
from martforge.sources.schemas import cols
from martforge.sources.sinks import create_mart_table, with_surrogate_key, write_mart

SCHEMA = cols(["code", ("qty", "decimal(18,3)"), ("flag", "boolean", "a documented flag")])


def test_write_mart_casts_to_declared_schema(spark):
    df = spark.createDataFrame([("a", 1.5, True), ("b", 2.0, False)], "code string, qty double, flag boolean")
    target = os.path.join(checkpoint_dir(spark), "test-write-mart")
    write_mart(df, target, SCHEMA)
    back = spark.read.parquet(target)
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["string", "decimal(18,3)", "boolean"]
    assert back.count() == 2


def test_insert_overwrite_by_name_keeps_table(spark):
    loc = tempfile.mkdtemp(prefix="martforge-tbl-")
    name = "default.martforge_sink_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_mart_table(spark, name, SCHEMA, comment="test table", location=loc)
    swapped = spark.createDataFrame([(True, 3.0, "z")], "flag boolean, qty double, code string")
    write_mart(swapped, name, SCHEMA, table=True, keep_table_schema=True)
    r = spark.table(name).first()
    assert (r.code, float(r.qty), r.flag) == ("z", 3.0, True)
    desc = {row.col_name: row.comment for row in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert desc["flag"] == "a documented flag"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_surrogate_keys(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7 % 2000).cast("string").alias("k"), F.col("id").alias("v"))
    df = df.repartition(5)
    dense = with_surrogate_key(df, ["k"], method="dense")
    ref = [(i + 1, *r) for i, r in enumerate(sorted(map(tuple, df.collect())))]
    assert sorted(tuple(r) for r in dense.collect()) == ref
    hashed = with_surrogate_key(df, ["k"])
    assert hashed.select("surrogate_id").distinct().count() == 2000
