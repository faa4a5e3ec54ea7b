"""Plans and operators that must not grow faster than their tables."""

import datetime as dt
from decimal import Decimal as D

import conftest
from martforge.config import MartConfig
from martforge.plans import materials, purchasing
from martforge.sources.base import FrameSources
from pyspark.sql import functions as F

CFG = MartConfig(as_of=dt.date(2024, 6, 1))
Q = "decimal(13,3)"


def frames(spark, **tables):
    return FrameSources(spark, {name: spark.createDataFrame(rows, schema) for name, (schema, rows) in tables.items()})


def test_material_tables_are_not_broadcast_by_their_file_size(spark):
    src = frames(
        spark,
        MARD=(f"MANDT string, MATNR string, WERKS string, LGORT string, LABST {Q}, INSME {Q}, SPEME {Q}, UMLME {Q}, EINME {Q}, RETME {Q}",
              [("400", "M1", "1001", "0003", D(3), D(1), None, None, None, None)]),
        MSKA=(f"MANDT string, MATNR string, WERKS string, LGORT string, KALAB {Q}, KAINS {Q}, KASPE {Q}, KAEIN {Q}", []),
        MSPR=(f"MANDT string, MATNR string, WERKS string, LGORT string, PRLAB {Q}, PRINS {Q}, PRSPE {Q}, PREIN {Q}", []),
        MSSL=(f"MANDT string, MATNR string, WERKS string, SOBKZ string, SLLAB {Q}, SLINS {Q}, SLUML {Q}, SLEIN {Q}", []),
        MARA=("MANDT string, MATNR string, MTART string, SPART string, MEINS string, MATKL string", [("400", "M1", "ZROH", "1", "EA", "G")]),
        MAKT=("MANDT string, MATNR string, SPRAS string, MAKTX string", [("400", "M1", "E", "Steel")]),
        MARC=("MANDT string, MATNR string, WERKS string, PRCTR string, ABCIN string", [("400", "M1", "1001", "PC", "A")]),
        MBEW=("MANDT string, MATNR string, BWKEY string, BWTAR string, BKLAS string, STPRS decimal(11,2), PEINH decimal(5,0)",
              [("400", "M1", "1001", "", "3000", D("10.05"), D(10))]))
    out = materials.inventory(src, CFG)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.material_number, r.total_qty, r.total_value) for r in out.collect()] == [("M1", D(4), D("4.04"))]


def test_status_totals_multiply_counts_not_rows(spark):
    n = 12  # headers, items and schedule lines of one document number: n * n * n rows of the mart
    src = frames(
        spark,
        EKKO=("MANDT string, EBELN string, BSART string, LIFNR string, BEDAT string, EKORG string, EKGRP string",
              [("400", "0004000001", "NB", f"000000000{k % 2}", "20240101", "4000", "G") for k in range(n)] + [("400", "0004000002", "NB", None, None, None, None)]),
        EKPO=("MANDT string, EBELN string, EBELP string, MATNR string, TXZ01 string, WERKS string, MATKL string",
              [("400", "0004000001", "00010", f"M{k % 3}", "t", "1001", "G") for k in range(n)] + [("400", "0004000002", "00010", None, "t", "1001", "G")]),
        EKET=(f"MANDT string, EBELN string, EBELP string, ETENR string, EINDT string, SLFDT string, MENGE {Q}, WEMNG {Q}",
              [("400", "0004000001", "00010", f"{k:04d}", "20240201", None, D(k) if k else None, D(0)) for k in range(n)]
              + [("400", "0004000002", "00010", "1", "20250101", None, D("1.5"), D(0)), ("400", "0004000003", "00010", "1", "20250101", None, D(1), D(0))]),
        EKBE=(f"MANDT string, EBELN string, EBELP string, BEWTP string, SHKZG string, BELNR string, BUZEI string, BUDAT string, MENGE {Q}",
              [("400", "0004000001", "00010", "E", "S", "1", "1", "20240115", D(10)), ("400", "0004000001", "00010", "E", "S", "2", "1", "20240315", D(10))]),
        LFA1=("MANDT string, LIFNR string, NAME1 string", [("400", "0000000000", "Zero"), ("400", "0000000001", "One")]),
        MAKT=("MANDT string, MATNR string, SPRAS string, MAKTX string", [("400", "M1", "E", "a"), ("400", "M2", "E", "b"), ("400", "M2", "E", "b")]))
    whole = purchasing.vendor_otd(src, CFG).select("vendor_account_number", "vendor_name", "otd_status", "scheduled_quantity")
    keys = ["vendor_account_number", "vendor_name", "otd_status"]
    wanted = conftest.rows(whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"), F.sum("scheduled_quantity").cast("decimal(18,3)").alias("scheduled_quantity")))
    got = purchasing.vendor_otd_totals(src, CFG)
    assert conftest.rows(got) == wanted and sum(r[3] for r in wanted) > n ** 3
    got.collect()
    plan, seen = got._jdf.queryExecution().executedPlan(), []

    def walk(p):
        if "Join" in p.nodeName():
            seen.append(p.metrics().apply("numOutputRows").value())
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            walk(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            walk(p.plan())
        else:
            kids = p.children()
            for i in range(kids.size()):
                walk(kids.apply(i))

    walk(plan)
    assert seen and max(seen) < n * n  # before: a join of n * n * n rows


def test_explosion_carries_no_paths_unless_listed(spark):
    from martforge.operators.hierarchy import explode_all, explode_hierarchy, prepare_edges
    from martforge.plans.bom import EXPLOSION_CARRY, bom_roots

    import test_hierarchy as h

    rows = [h.direct_row(f"M{i}", f"M{i + 1}") for i in range(9)] + [h.direct_row("M3", "M0", item="0020")]
    edges = prepare_edges(spark.createDataFrame(rows, h.DIRECT).select("parent_matnr", "component_matnr", *EXPLOSION_CARRY),
                          "parent_matnr", "component_matnr", ["plant", "bom_usage"])
    roots = bom_roots(edges)
    listed = explode_all(roots, ["top_plant", "bom_usage"], "item_number")
    plain = explode_all(roots.drop("sort_path"), ["top_plant", "bom_usage"], "item_number")
    walked = explode_hierarchy(edges, roots.drop("sort_path"), "parent_matnr", "component_matnr",
                               {"top_plant": "plant", "bom_usage": "bom_usage"}, EXPLOSION_CARRY, "item_number")
    assert plain.columns == walked.columns == [c for c in listed.columns if c != "sort_path"]
    assert conftest.rows(plain) == conftest.rows(walked) == conftest.rows(listed.drop("sort_path"))


def test_parts_in_one_row_group_are_shaped_by_all_cores(spark, tmp_path):
    from martforge.sources.shape import DriverSources

    spark.range(1000).select(F.col("id").alias("p_partkey"), F.lit(1).alias("p_size")).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    src = DriverSources(spark, str(tmp_path))
    assert src.raw("part").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert src.table("STPO").select("STLNR", "STLKN", "DATUV").distinct().count() == src.table("STPO").count() > 3000


def shared_number(spark, prefix, n):
    """n headers, items and schedule lines of one document number, an item without lines, one without number, one without header."""
    number, single, orphan = f"{prefix}000001", f"{prefix}000002", f"{prefix}000003"
    item = lambda k, doc, no="00010": ("400", doc, no, f"M{k % 3}", "t", "1001", "1002", "0001", "G", D(k), "EA", D("2.50"), D(10), "X", "X", "0", "", "", "")
    return frames(
        spark,
        EKKO=("MANDT string, EBELN string, BSART string, LIFNR string, WAERS string, BEDAT string, EKORG string, EKGRP string, BUKRS string",
              [("400", number, "NB", f"000000000{k % 2}", "USD", "20240101", "4000", f"G{k}", "0000") for k in range(n)]
              + [("400", single, "NB", None, "USD", None, None, None, None)]),
        EKPO=(f"MANDT string, EBELN string, EBELP string, MATNR string, TXZ01 string, WERKS string, RESWK string, LGORT string, MATKL string, MENGE {Q},"
              " MEINS string, NETPR decimal(11,2), PEINH decimal(5,0), WEPOS string, REPOS string, PSTYP string, KNTTP string, LOEKZ string, ELIKZ string",
              [item(k, number) for k in range(n)] + [item(0, single), item(0, single, None), item(0, orphan)]),
        EKET=(f"MANDT string, EBELN string, EBELP string, ETENR string, EINDT string, SLFDT string, MENGE {Q}, WEMNG {Q}, BANFN string",
              [("400", number, "00010", f"{k:04d}", "20240201", None, D(k), D(0), "0000000007") for k in range(n)] + [("400", orphan, "00010", "1", None, None, D(1), D(0), None), ("400", single, None, "1", None, None, D(1), D(0), None)]),
        EKBE=(f"MANDT string, EBELN string, EBELP string, BEWTP string, SHKZG string, BELNR string, BUZEI string, BUDAT string, MENGE {Q}",
              [("400", number, "00010", "E", "S", "1", "1", "20240115", D(10))]),
        T001=("MANDT string, BUKRS string, WAERS string", [("400", "0000", "EUR")]),
        LFA1=("MANDT string, LIFNR string, NAME1 string", [("400", "0000000000", "Zero")]),
        MAKT=("MANDT string, MATNR string, SPRAS string, MAKTX string", [("400", "M1", "E", "a")]))


def test_lines_of_a_shared_number_are_neither_moved_nor_computed(spark):
    n, limit = 12, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mart, prefix, whole in ((purchasing.purchase_order, "0004", n ** 3 + 2), (purchasing.stock_transfer, "0003", n ** 3 + 2), (purchasing.vendor_otd, "0004", n ** 3)):
            df = mart(shared_number(spark, prefix, n), CFG)
            out = df.collect()
            assert len(out) == whole
            many = [r for r in out if r.purchasing_document_number.endswith("1")]
            assert len({(r.purchasing_group, r.schedule_line_counter) for r in many}) == n * n
            assert {(r.material_number, r.material_description) for r in many} == {("M0", None), ("M1", "a"), ("M2", None)}
            if "vendor_name" in df.columns:
                assert {(r.vendor_account_number, r.vendor_name) for r in many} == {("", "Zero"), ("1", None)}
            if "total_value" in df.columns:
                assert sum(r.total_value for r in many) == n * n * D("0.25") * sum(range(n))
                assert [(r.schedule_line_counter, r.total_value, r.local_currency) for r in out if r not in many] == [(None, None, None)] * 2
            moved = []

            def walk(p):
                if p.nodeName() == "Exchange":
                    moved.append(p.metrics().apply("shuffleRecordsWritten").value())
                if p.nodeName().startswith("AdaptiveSparkPlan"):
                    walk(p.executedPlan())
                elif "QueryStage" in p.nodeName():
                    walk(p.plan())
                else:
                    for i in range(p.children().size()):
                        walk(p.children().apply(i))

            plan = df._jdf.queryExecution().executedPlan()
            walk(plan)
            assert moved and max(moved) < n * n  # before: every combination went through the text look-ups
            assert "RLIKE" not in plan.toString().split("SortMergeJoin")[0]  # and its columns were computed then
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def moved_records(df):
    """Records written by each exchange of a collected frame."""
    moved = []

    def walk(p):
        if p.nodeName() == "Exchange":
            moved.append(p.metrics().apply("shuffleRecordsWritten").value())
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            walk(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            walk(p.plan())
        else:
            for i in range(p.children().size()):
                walk(p.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return moved


def test_lines_and_receipts_of_small_items_move_once(spark):
    items, n = 10, 50
    src = frames(
        spark,
        EKET=(f"MANDT string, EBELN string, EBELP string, ETENR string, EINDT string, SLFDT string, MENGE {Q}, WEMNG {Q}",
              [("400", f"000400000{d}", "00010", f"{k:04d}", "20240201", None, D(2), D(0)) for d in range(items) for k in range(n)]),
        EKBE=(f"MANDT string, EBELN string, EBELP string, BEWTP string, SHKZG string, BELNR string, BUZEI string, BUDAT string, MENGE {Q}",
              [("400", f"000400000{d}", "00010", "E", "S", f"{k:04d}", "1", "20240115", D(1)) for d in range(items) for k in range(n)]))
    out = purchasing.otd_schedule_matches(src, CFG)
    got = out.collect()
    assert {(r.EBELN, r.sched_rank): r.BELNR for r in got} == {(f"000400000{d}", k + 1): f"{2 * k + 1:04d}" if k < n // 2 else None for d in range(items) for k in range(n)}
    assert sum(moved_records(out)) < 2 * 2 * items * n  # before: four times, for the notes of groups that go on


def test_large_and_small_groups_are_matched_alike(spark):
    from martforge.operators.matching import completion_match

    size = {"a": 3, "b": 40, None: 5, "c": 90, "d": 1}
    sched = [(k, f"2024{i % 12 + 1:02d}01", f"{i:03d}", None if i % 7 == 3 else D(i % 4), "x") for k, n in size.items() for i in range(n)]
    got = [(k, f"2024{i % 11 + 1:02d}05", f"{i:03d}", None if i % 5 == 0 else D(i % 3 - (i % 9 == 8))) for k, n in size.items() if k != "d" for i in range(n + 2)]
    s = spark.createDataFrame(sched, f"k string, due string, line string, qty {Q}, more string")
    r = spark.createDataFrame(got, f"k string, posted string, doc string, rq {Q}")
    out = {}
    for whole in (0, 1, 50, 10 ** 6):  # all in ranges, all but the smallest, the large ones, none
        df = completion_match(s, r, ["k"], [F.col("due"), F.col("line")], "qty", [F.col("posted"), F.col("doc")], "rq", ["posted", "doc"], whole=whole)
        out[whole] = (df.schema.simpleString(), conftest.rows(df))
    assert len(out[0][1]) == len(sched) and any(x[-1] for x in out[0][1])
    assert out[1] == out[50] == out[10 ** 6] == out[0]
