import datetime as dt
import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from martforge.operators.hierarchy import (
    childless_nodes, dedup_bom, explode_all, explode_hierarchy, prepare_edges, ragged_hierarchy,
)
from martforge.operators.select import active_only, keep_min, latest_per_key, valid_as_of
from martforge.plans.controlling import TIERS
from martforge.plans.bom import EXPLOSION_CARRY, bom_roots, dedup_tiebreak

DIRECT = ("parent_matnr string, plant string, bom_usage string, bom_category string, bom_number string, "
          "alt_bom string, item_number string, component_matnr string, qty decimal(13,3), uom string, "
          "item_category string, valid_from string, item_node string, item_counter string")


def direct_row(parent, comp, item="0010", plant="1001", usage="1", bom=None, alt="1", node=None, qty=1,
               valid="19900101"):
    return (parent, plant, usage, "M", bom or f"B{parent}", alt, item, comp, Decimal(qty), "EA", "L", valid,
            node or item, "1")


def explode(spark, rows, max_levels=None):
    """The walk from level to level; the doubling must give the same rows."""
    edges = spark.createDataFrame(rows, DIRECT).select("parent_matnr", "component_matnr", *EXPLOSION_CARRY)
    edges = prepare_edges(edges, "parent_matnr", "component_matnr", ["plant", "bom_usage"])
    walked = explode_hierarchy(edges, bom_roots(edges), "parent_matnr", "component_matnr",
                               {"top_plant": "plant", "bom_usage": "bom_usage"}, EXPLOSION_CARRY, "item_number", max_levels)
    doubled = explode_all(bom_roots(edges), ["top_plant", "bom_usage"], "item_number", max_levels)
    assert walked.columns == doubled.columns
    assert sorted(map(str, walked.collect())) == sorted(map(str, doubled.collect()))
    return doubled


def test_explosion_is_complete(spark):
    chain = [direct_row(f"M{i}", f"M{i + 1}") for i in range(14)]
    out = explode(spark, chain)
    assert (out.count(), out.agg(F.max("bom_level")).first()[0]) == (105, 14)
    assert explode(spark, chain, max_levels=3).agg(F.max("bom_level")).first()[0] == 3


def test_explosion_ends_cycles_at_their_closing_row(spark):
    loops = [direct_row("S", "S"), direct_row("X", "Y"), direct_row("Y", "X"), direct_row("T", "X")]
    got = sorted((r.top_material, r.bom_level, r.parent_material, r.component_material) for r in explode(spark, loops).collect())
    assert got == [("S", 1, "S", "S"), ("T", 1, "T", "X"), ("T", 2, "X", "Y"), ("T", 3, "Y", "X"),
                   ("X", 1, "X", "Y"), ("X", 2, "Y", "X"), ("Y", 1, "Y", "X"), ("Y", 2, "X", "Y")]


def test_doubling_equals_the_walk_on_random_graphs(spark):
    rng = random.Random(13)
    rows = []
    for plant, nodes, edges in (("1001", 9, 13), ("1002", 14, 18), ("1003", 30, 36)):
        for k in range(edges):
            a, b = rng.randrange(nodes), rng.randrange(nodes)  # cycles and loops included
            rows.append(direct_row(f"N{a}", f"N{b}", item=rng.choice([f"{k:04d}", None]), plant=plant, usage=rng.choice("112")))
    rows += [direct_row(f"C{i}", f"C{i + 1}", plant="1009") for i in range(11)] + [direct_row("C4", "C0", plant="1009"), direct_row("C2", "C5", plant=None)]
    for limit in (None, 1, 3, 4, 7):
        out = explode(spark, rows, limit)
        assert limit is None or out.agg(F.max("bom_level")).first()[0] == limit


def test_long_lists_of_start_materials_are_joined(spark):
    from martforge.plans.bom import start_materials

    edges = spark.range(100).select(F.concat(F.lit("M"), "id").alias("parent_matnr"))
    wanted = tuple(f"M{3 * i}" for i in range(10_000))
    kept = edges.join(start_materials(spark, wanted), "parent_matnr", "left_semi")
    assert kept.count() == 34
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "M2997" not in plan and len(plan) < 20_000
    assert start_materials(spark, None) is None and start_materials(spark, ()) is None
    frame = spark.createDataFrame([("M1",), ("M1",)], "x string")
    assert edges.join(start_materials(spark, frame), "parent_matnr", "left_semi").count() == 1


def test_dedup_evaluates_its_input_once(spark):
    df = spark.createDataFrame([direct_row("P", "C1")], DIRECT)
    plan = dedup_bom(df, "bom", dedup_tiebreak())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_explosion_shared_component_and_usage(spark):
    rows = [direct_row("A", "C", item="0010"), direct_row("B", "C", item="0020"), direct_row("C", "D"),
            direct_row("C", "E", usage="2"),  # other-usage child: not followed from a usage-1 top
            direct_row("C", "F", plant="1002")]  # other plant: not followed
    out = explode(spark, rows)
    paths = {(r.top_material, r.component_material, r.bom_level, r.sort_path) for r in out.collect()}
    assert ("A", "D", 2, "A_1001|00000010|00000010") in paths
    assert ("B", "D", 2, "B_1001|00000020|00000010") in paths
    assert not any(p[0] in ("A", "B") and p[1] in ("E", "F") for p in paths)


def test_dedup_layers(spark):
    rows = [
        direct_row("P", "100A", item="0010", node="01"), direct_row("P", "100B", item="0020", node="02"),
        direct_row("P", "100", item="0030", node="03"), direct_row("P", "A100", item="0040", node="04"),
        direct_row("P", "100AB", item="0050", node="05"),
        direct_row("P", "Z9", item="0060", node="06", alt="2"),              # higher alternative: layer 1 drops
        direct_row("P", "Q1", item="0070", node="07", valid="19900101", qty=2),
        direct_row("P", "Q1", item="0080", node="08", valid="19950101", qty=2),  # same comp+qty: latest kept
        direct_row("P", "R1", item="0090", node="09"), direct_row("P", "R2", item="0090", node="10"),  # same item no
    ]
    out = dedup_bom(spark.createDataFrame(rows, DIRECT), "bom", dedup_tiebreak())
    comps = sorted(r.component_matnr for r in out.collect())
    assert comps == ["100", "100AB", "100B", "A100", "Q1", "R2"]
    assert out.filter("component_matnr = 'Q1'").first().item_number == "0080"


def test_dedup_scope_shared_bom(spark):
    rows = [direct_row("P", "C1", plant="1001", bom="B1"), direct_row("P", "C1", plant="1002", bom="B1")]
    df = spark.createDataFrame(rows, DIRECT)
    assert dedup_bom(df, "bom", dedup_tiebreak()).count() == 1
    assert dedup_bom(df, "bom_plant", dedup_tiebreak()).count() == 2


def test_ragged_hierarchy(spark):
    tree = spark.createDataFrame([
        ("1", "TOP", "Top", None), ("2", "S1", "Site 1", "TOP"), ("3", "D1", "Dept 1", "S1"),
        ("4", "PC4", "Leaf 4", "D1"), ("3", "PC3", "Leaf 3", "S1"), ("4", "ORPHAN", "Broken", "DX"),
    ], "LEVEL string, CHILD string, CHILD_DESC string, PARENT string")
    got = {r.node: tuple(r)[1:] for r in ragged_hierarchy(tree, TIERS).collect()}
    assert got["PC4"] == ("D1", "Dept 1", "S1", "Site 1", "TOP", "Top")
    assert got["PC3"] == (None, None, "S1", "Site 1", "TOP", "Top")
    assert got["ORPHAN"] == (None, None, None, None, None, None)
    assert "D1" not in got
    assert [r.CHILD for r in childless_nodes(tree).where("LEVEL = 3").collect()] == ["PC3"]


def test_ragged_hierarchy_of_five_levels(spark):
    tree = spark.createDataFrame([("1", "T", "Top", None), ("2", "A", "a", "T"), ("3", "B", "b", "A"), ("4", "C", "c", "B"), ("5", "L5", "x", "C"),
                                  ("4", "L4", "y", "B"), ("3", "L3", "z", "A"), ("5", "LOST", "w", "NONE"), ("2", "X", "no leaf", "T")],
                                 "LEVEL string, CHILD string, CHILD_DESC string, PARENT string")
    tiers = {4: ("l4", "t4"), 3: ("l3", "t3"), 2: ("l2", "t2"), 1: ("l1", "t1")}
    got = {r.node: (r.l4, r.l3, r.l2, r.l1, r.t2) for r in ragged_hierarchy(tree, tiers).collect()}
    assert got == {"L5": ("C", "B", "A", "T", "a"), "L4": (None, "B", "A", "T", "a"), "L3": (None, None, "A", "T", "a"),
                   "LOST": (None,) * 5}


def test_validity_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("99991231", "19990101"), ("9999-12-31", "2000-01-01"), ("20001231", "20010101"), ("x", "x")],
                          "DATBI string, DATUV string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    ended, begun = active_only(df), valid_as_of(df, "DATUV", dt.date(2000, 1, 1))
    assert ended.count() == 2 and begun.count() == 2
    for kept, column in ((ended, "DATBI"), (begun, "DATUV")):
        pushed = re.search(r"PushedFilters: \[(.*?)\]", kept._jdf.queryExecution().executedPlan().toString())[1]
        assert f"({column}," in pushed


def test_latest_per_key_total_order_and_keep_min(spark):
    df = spark.createDataFrame([("k", "20240101", "D1", "0002"), ("k", "20240101", "D1", "0001"),
                                ("k", "20231231", "D9", "0009")], "key string, d string, doc string, item string")
    got = latest_per_key(df, ["key"], [F.col("d").desc(), F.col("doc").desc()], [F.col("item").desc()]).collect()
    assert [(r.d, r.item) for r in got] == [("20240101", "0002")]
    plan = latest_per_key(df, ["key"], [F.col("d").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    alts = spark.createDataFrame([("p", "2", 1), ("p", "1", 2), ("p", "1", 3), (None, "3", 4), (None, "3", 5)],
                                 "k string, alt string, id int")
    assert sorted(r.id for r in keep_min(alts, ["k"], "alt").collect()) == [2, 3, 4, 5]


def test_enrich_checks_dimension_keys(spark):
    import pytest

    from martforge.operators.combine import StackSpec, enrich, stack_sources

    fact = spark.createDataFrame([("m1", 1), ("m2", 2)], "MATNR string, q int")
    good = spark.createDataFrame([("m1", "Bolt")], "MATNR string, MAKTX string")
    bad = spark.createDataFrame([("m1", "Bolt"), ("m1", "Nut")], "MATNR string, MAKTX string")
    assert sorted(tuple(r) for r in enrich(fact, good, "MATNR").collect()) == [
        ("m1", 1, "Bolt"), ("m2", 2, None)]
    with pytest.raises(Exception, match="not unique: m1"):
        enrich(fact, bad, "MATNR").collect()
    assert enrich(fact, bad, "MATNR", check_unique=False).count() == 3
    stacked = stack_sources([StackSpec(fact, {"k": F.col("MATNR"), "kind": F.lit("A")}),
                             StackSpec(good, {"k": F.col("MATNR"), "kind": F.lit("B")})])
    assert sorted(tuple(r) for r in stacked.collect()) == [("m1", "A"), ("m1", "B"), ("m2", "A")]
