"""Atomic refresh, stable keys, quarantine and range layout."""

import os
import uuid
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martforge.plans import purchasing
from martforge.plans.catalog import MARTS, refresh_marts
from martforge.plans.registry import DRIVER_CONFIG
from martforge.session import checkpoint_dir
from martforge.sources import publish as pb
from martforge.sources.base import FrameSources
from martforge.sources.schemas import cols
from martforge.sources.shape import DriverSources
from martforge.sources.sinks import create_mart_table, write_mart

SCHEMA = cols([("id", "bigint"), ("v", "string")])
SF = "/root/testdata/sf0.001"


@pytest.fixture
def base(spark):
    return f"{checkpoint_dir(spark)}/publish-{uuid.uuid4().hex}"


def local(path):
    return path.removeprefix("file:")


def good(spark, v, n=100):
    return spark.range(n).select("id", F.lit(v).alias("v"))


def failing(spark, v, n=100):
    """Fails in its last rows, after others have been written."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken half-way")))
    return spark.range(0, n, 1, 4).select("id", F.coalesce(bad.cast("string"), F.lit(v)).alias("v"))


def test_failed_refresh_leaves_the_old_rows(spark, base):
    with pytest.raises(FileNotFoundError):
        pb.read_published(spark, base)
    pb.refresh(good(spark, "old"), base, SCHEMA)
    before = pb.read_published(spark, base)
    with pytest.raises(Exception, match="broken half-way"):
        pb.refresh(failing(spark, "new"), base, SCHEMA)
    assert {r.v for r in pb.read_published(spark, base).collect()} == {"old"}
    assert len([x for x in os.listdir(local(base)) if x.startswith("version-")]) == 1  # nothing half-written stays
    pb.refresh(good(spark, "new"), base, SCHEMA)
    assert {r.v for r in pb.read_published(spark, base).collect()} == {"new"}
    assert {r.v for r in before.collect()} == {"old"}  # a reader that began earlier
    assert len(pb.remove_old_versions(spark, base)) == 1 and pb.remove_old_versions(spark, base) == []
    assert pb.read_published(spark, base).count() == 100


def test_written_version_is_unseen_until_published(spark, base):
    pb.refresh(good(spark, "old"), base)
    version = pb.write_version(good(spark, "new"), base)
    assert pb.read_published(spark, base).first().v == "old"
    pb.publish(spark, base, version)
    assert pb.read_published(spark, base).first().v == "new"


def test_marts_published_together_or_not_at_all(spark, base):
    a, b = f"{base}/a", f"{base}/b"
    with pb.refresh_together(spark) as written:
        for x in (a, b):
            written[x] = pb.write_version(good(spark, "one"), x)
    with pytest.raises(Exception, match="broken half-way"), pb.refresh_together(spark) as written:
        written[a] = pb.write_version(good(spark, "two"), a)
        written[b] = pb.write_version(failing(spark, "two"), b)
    for x in (a, b):
        assert {r.v for r in pb.read_published(spark, x).collect()} == {"one"}
        assert len([v for v in os.listdir(local(x)) if v.startswith("version-")]) == 1


def test_folder_is_replaced_only_when_all_rows_are_written(spark, base):
    write_mart(good(spark, "old"), base, SCHEMA)
    with pytest.raises(Exception, match="broken half-way"):
        write_mart(failing(spark, "new"), base, SCHEMA)
    assert {r.v for r in spark.read.parquet(base).collect()} == {"old"}
    write_mart(good(spark, "new"), base, SCHEMA)
    assert {r.v for r in spark.read.parquet(base).collect()} == {"new"}
    assert not [x for x in os.listdir(os.path.dirname(local(base))) if os.path.basename(base) in x and x != os.path.basename(base)]


def test_table_is_switched_at_once_and_keeps_its_definition(spark, base):
    name = "default.martforge_switched"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_mart_table(spark, name, cols([("id", "bigint", "the key"), ("v", "string", "the value")]), "switched", location=base)
    pb.refresh_table(good(spark, "old").select("v", "id"), name)
    with pytest.raises(Exception, match="broken half-way"):
        pb.refresh_table(failing(spark, "new"), name)
    assert {(r.id, r.v) for r in spark.table(name).collect()} == {(i, "old") for i in range(100)}
    pb.refresh_table(good(spark, "new", 7), name)
    assert {(r.id, r.v) for r in spark.table(name).collect()} == {(i, "new") for i in range(7)}
    assert {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()} == {"id": "the key", "v": "the value"}
    spark.sql(f"DROP TABLE {name}")


def test_refresh_marts_published_with_lasting_keys(spark, base):
    src = DriverSources(spark, SF)
    names = ["billing_blocks"]
    keys = {"billing_blocks": ["billing_block"]}
    assert "billing_block" in [c.name for c in MARTS["billing_blocks"].schema]
    kept = []
    for _ in range(2):
        done = refresh_marts(src, DRIVER_CONFIG, base, names, surrogate_key=True, published=True, key_registry=f"{base}/keys", business_keys=keys)
        rows = pb.read_published(spark, f"{base}/billing_blocks")
        assert rows.count() == done["billing_blocks"]
        kept.append(sorted(map(str, rows.collect())))
    assert kept[0] == kept[1]


def test_keys_last_through_refreshes(spark, base):
    def rows(pairs):
        return spark.createDataFrame(pairs, "a string, b int, v string")

    def keys(df):
        return {(r.a, r.b): r.surrogate_id for r in df.collect()}

    first = keys(pb.with_registered_key(rows([("x", 1, ""), ("y", None, ""), (None, 2, ""), ("x", 1, "again")]), ["a", "b"], base))
    assert sorted(first.values()) == [1, 2, 3]
    second = keys(pb.with_registered_key(rows([("a", 0, ""), ("y", None, "new text"), ("x", 1, "")]), ["a", "b"], base))
    assert second == {("a", 0): 4, ("y", None): first["y", None], ("x", 1): first["x", 1]}
    third = keys(pb.with_registered_key(rows([(None, 2, ""), ("a", 0, ""), ("0", 0, ""), ("z", 9, "")]), ["a", "b"], base))
    assert third == {(None, 2): first[None, 2], ("a", 0): 4, ("0", 0): 5, ("z", 9): 6}  # the number of a key that was away is its own
    assert pb.with_registered_key(rows([]), ["a", "b"], base).count() == 0
    assert pb.read_published(spark, base).count() == 6


def test_split_dirty(spark):
    df = spark.createDataFrame([("a", "1.5", "7"), ("b", "1,5", "x"), ("c", " ", None), ("d", "99999999999999", "1"), ("e", None, "2147483648"), ("f", " 2.25 ", "-3")],
                               "k string, q string, n string")
    clean, bad = pb.split_dirty(df, {"q": "decimal(13,3)", "n": "int"}, ["k"])
    assert {(r.k, r.q, r.n) for r in clean.collect()} == {("a", Decimal("1.500"), 7), ("c", None, None), ("f", Decimal("2.250"), -3)}
    assert {(r.k, tuple((x.column, x.value) for x in r.reasons)) for r in bad.collect()} == {
        ("b", (("q", "1,5"), ("n", "x"))), ("d", (("q", "99999999999999"),)), ("e", (("n", "2147483648"),))}


def test_one_bad_quantity_does_not_abort_a_mart(spark, base):
    inner = DriverSources(spark, SF)
    names = ["EKKO", "EKPO", "EKET", "LFA1", "T001", "MAKT"]
    frames = {n: inner.table(n) for n in names}
    one = frames["EKET"].where("MANDT = '400' and EBELN between '0004000000' and '0004999999'").orderBy("EBELN", "EBELP", "ETENR").first()
    is_one = (F.col("EBELN") == one.EBELN) & (F.col("EBELP") == one.EBELP) & (F.col("ETENR") == one.ETENR)
    planted = frames["EKET"].where(is_one).count()
    frames["EKET"] = frames["EKET"].withColumn("MENGE", F.when(is_one, "abc").otherwise(F.col("MENGE").cast("string")))
    dirty = FrameSources(spark, frames)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        purchasing.purchase_order(dirty, DRIVER_CONFIG).collect()
    checked = pb.CheckedSources(dirty, {"EKET": {"MENGE": "decimal(13,3)", "WEMNG": "decimal(13,3)"}}, base, {"EKET": ["EBELN", "EBELP", "ETENR"]})
    got = purchasing.purchase_order(checked, DRIVER_CONFIG).count()
    assert checked.counts["EKET"] == (frames["EKET"].count(), planted)
    whole = purchasing.purchase_order(inner, DRIVER_CONFIG)
    assert whole.count() - planted <= got <= whole.count()  # an item whose only line went keeps one row
    reasons = checked.rejected("EKET").collect()
    assert len(reasons) == planted and reasons[0].EBELN == one.EBELN and reasons[0].reasons[0].value == "abc"
    assert checked.table("EKKO").count() == frames["EKKO"].count()


def test_range_layout_gives_disjoint_files(spark, base):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("id"), F.lit("x").alias("v")).repartition(5)
    path = pb.write_version(df, base, SCHEMA, layout=["id"], files=4)
    pb.publish(spark, base, path)
    stats = []
    for name in os.listdir(local(path)):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{local(path)}/{name}").metadata
            groups = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
            stats.append((min(g.min for g in groups), max(g.max for g in groups)))
    stats.sort()
    assert len(stats) > 1 and all(a[1] < b[0] for a, b in zip(stats, stats[1:], strict=False))
    assert pb.read_published(spark, base).count() == 20_000
