import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martforge.operators.matching import completion_match, running_total

SCHED = "item string, due string, line string, qty decimal(13,3)"
GR = "item string, posted string, doc string, qty decimal(13,3)"


def match(spark, sched_rows, gr_rows):
    s = spark.createDataFrame(sched_rows, SCHED)
    r = spark.createDataFrame(gr_rows, GR)
    out = completion_match(s, r, ["item"], [F.col("due"), F.col("line")], "qty",
                           [F.col("posted"), F.col("doc")], "qty", ["posted", "doc"])
    return {(row.item, row.line): (row.gr_rank, row.doc) for row in out.collect()}


def D(x):
    return None if x is None else Decimal(str(x))


def test_golden_partial_deliveries(spark):
    # Schedule 10,10,10,10; receipts in order 10,2,8,10,6,4 -> lines complete at receipts 1,3,4,6.
    sched = [("A", f"2024010{i}", f"000{i}", D(10)) for i in range(1, 5)]
    gr = [("A", f"2024020{i}", f"G{i}", D(q)) for i, q in enumerate([10, 2, 8, 10, 6, 4], start=1)]
    got = match(spark, sched, gr)
    assert {k[1]: v[0] for k, v in got.items()} == {"0001": 1, "0002": 3, "0003": 4, "0004": 6}


def test_edges(spark):
    sched = [
        ("none", "20240101", "0001", D(5)),                  # no receipts at all
        ("under", "20240101", "0001", D(5)), ("under", "20240102", "0002", D(5)),  # last line stays open
        ("over", "20240101", "0001", D(5)), ("over", "20240102", "0002", D(5)),    # one big receipt completes both
        ("zero", "20240101", "0001", D(0)), ("zero", "20240102", "0002", D(3)),    # zero line completes at 1st receipt
        ("nullq", "20240101", "0001", None), ("nullq", "20240102", "0002", D(2)),  # NULL running qty never completes
    ]
    gr = [("under", "20240201", "G1", D(7)), ("over", "20240201", "G1", D(30)),
          ("zero", "20240201", "G1", D(1)), ("zero", "20240202", "G2", D(2)),
          ("nullq", "20240201", "G0", None), ("nullq", "20240202", "G1", D(2))]
    got = match(spark, sched, gr)
    assert got[("none", "0001")] == (None, None)
    assert got[("under", "0001")] == (1, "G1") and got[("under", "0002")] == (None, None)
    assert got[("over", "0001")] == (1, "G1") and got[("over", "0002")] == (1, "G1")
    assert got[("zero", "0001")] == (1, "G1") and got[("zero", "0002")] == (2, "G2")
    assert got[("nullq", "0001")] == (None, None) and got[("nullq", "0002")] == (2, "G1")


def join_form(s, r):
    """The textbook non-equi join + top-1 form (reference semantics)."""
    ws = Window.partitionBy("item").orderBy("due", "line")
    wr = Window.partitionBy("item").orderBy("posted", "doc")
    s = (s.withColumn("sched_rank", F.row_number().over(ws))
          .withColumn("cum_s", F.sum("qty").over(ws.rowsBetween(Window.unboundedPreceding, 0))))
    r = (r.withColumn("gr_rank", F.row_number().over(wr))
          .withColumn("cum_g", F.sum("qty").over(wr.rowsBetween(Window.unboundedPreceding, 0)))
          .select(F.col("item").alias("r_item"), "gr_rank", "cum_g", "doc"))
    j = s.join(r, (s.item == r.r_item) & (r.cum_g >= s.cum_s), "left")
    w = Window.partitionBy("item", "sched_rank").orderBy(F.col("gr_rank").asc_nulls_last())
    return j.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("item", "line", "gr_rank", "doc")


def test_randomised_equivalence_with_join_form(spark):
    rnd = random.Random(7)
    sched, gr = [], []
    for g in range(60):
        item = f"I{g}"
        for i in range(rnd.randint(0, 12)):
            q = rnd.choice([None, 0, 1, 2, 3, 5, 10, 10, 7])
            sched.append((item, f"2024{rnd.randint(1, 3):02d}{rnd.randint(10, 28)}", f"{i:04d}", D(q)))
        for i in range(rnd.randint(0, 15)):
            q = rnd.choice([None, 0, 1, 2, 4, 5, 6, 10])
            gr.append((item, f"2024{rnd.randint(1, 4):02d}{rnd.randint(10, 28)}", f"G{i:03d}", D(q)))
    s = spark.createDataFrame(sched, SCHED)
    r = spark.createDataFrame(gr, GR)
    fast = completion_match(s, r, ["item"], [F.col("due"), F.col("line")], "qty",
                            [F.col("posted"), F.col("doc")], "qty", ["doc"])
    a = sorted(tuple(x) for x in fast.select("item", "line", "gr_rank", "doc").collect())
    b = sorted(tuple(x) for x in join_form(s, r).collect())
    assert len(a) == len(sched)
    assert a == b


def test_running_total_in_ranges(spark):
    df = spark.range(0, 5000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("o"),
                                      F.when(F.col("id") % 5 > 0, (F.col("id") % 7).cast("decimal(13,3)")).alias("q"))
    w = Window.partitionBy("k").orderBy("o")
    plain = df.select("k", "o", "q", F.sum("q").over(w).alias("cum"), F.row_number().over(w).alias("rk"))
    out = running_total(df.repartition(3), ["k"], [F.col("o")], "q", "cum", rank="rk")
    assert out.schema["cum"].dataType == plain.schema["cum"].dataType
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_sums_are_exact_without_ansi(spark):
    rows = [("A", i, Decimal("900000000000000.001")) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, o int, q decimal(18,3)")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        got = {r.o: r.cum for r in running_total(df, ["k"], [F.col("o")], "q", "cum").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert got == {i: Decimal("900000000000000.001") * (i + 1) for i in range(20)}


def test_large_groups_are_spread_with_same_result(spark):
    rnd = random.Random(11)
    sched, gr = [], []
    for g, (ns, nr) in enumerate([(400, 500), (3, 4), (0, 5), (6, 0), (250, 180)]):
        item = f"I{g}"
        for i in range(ns):
            sched.append((item, f"2024{rnd.randint(1, 9):02d}{rnd.randint(10, 28)}", f"{i:05d}",
                          D(rnd.choice([None, 0, 1, 2, 3, 5]))))
        for i in range(nr):
            gr.append((item, f"2024{rnd.randint(1, 9):02d}{rnd.randint(10, 28)}", f"G{i:05d}",
                       D(rnd.choice([None, 0, 1, 2, 4]))))
    s = spark.createDataFrame(sched, SCHED).repartition(3)
    r = spark.createDataFrame(gr, GR).repartition(3)
    want, sizes = sorted(tuple(x) for x in join_form(s, r).collect()), {}
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n, rows in (("1", "10000"), ("23", "7"), ("60", "10000")):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            out = completion_match(s, r, ["item"], [F.col("due"), F.col("line")], "qty", [F.col("posted"), F.col("doc")], "qty", ["doc"])
            a = sorted(tuple(x) for x in out.select("item", "line", "gr_rank", "doc").collect())
            assert len(a) == len(sched) and a == want
            places = out.where("item = 'I0'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
            sizes[n] = max(p["count"] for p in places)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old[1])
    assert sizes["60"] <= 60 < 400 == sizes["1"]  # the largest item lies in many partitions


def test_four_exchanges_and_one_scan_of_each_input(spark, tmp_path):
    spark.createDataFrame([("A", "20240101", "1", D(1))], SCHED).write.parquet(f"{tmp_path}/s")
    spark.createDataFrame([("A", "20240101", "G", D(1))], GR).write.parquet(f"{tmp_path}/r")
    out = completion_match(spark.read.parquet(f"{tmp_path}/s"), spark.read.parquet(f"{tmp_path}/r"), ["item"],
                           [F.col("due"), F.col("line")], "qty", [F.col("posted"), F.col("doc")], "qty", ["doc"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange "), plan.count("FileScan parquet"), plan.count("Join")) == (4, 2, 0)


def test_sums_need_exact_numbers(spark):
    df = spark.createDataFrame([("A", 1, 0.5, 3, None), ("A", 2, 0.25, -5, D(-1)), (None, 1, 1.0, 2, D(2))], "k string, o int, f double, i int, d decimal(20,2)")
    with pytest.raises(TypeError):
        running_total(df, ["k"], [F.col("o")], "f", "cum")
    assert sorted(r.cum for r in running_total(df, ["k"], [F.col("o")], "i", "cum").collect()) == [-2, 2, 3]
    got = {(r.k, r.o): r.cum for r in running_total(df, ["k"], [F.col("o")], "d", "cum").collect()}
    assert got == {("A", 1): None, ("A", 2): D(-1), (None, 1): D(2)}
    assert running_total(df.limit(0), ["k"], [F.col("o")], "d", "cum", rank="r").collect() == []


def test_planning_starts_no_job(spark):
    s = spark.createDataFrame([("A", "20240101", "1", D(1))], SCHED)
    r = spark.createDataFrame([("A", "20240101", "G", D(1))], GR)
    group = "planning-of-completion-match"
    spark.sparkContext.setJobGroup(group, "no job expected")
    try:
        completion_match(s, r, ["item"], [F.col("due"), F.col("line")], "qty", [F.col("posted"), F.col("doc")], "qty", ["doc"])
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
