import os
from dataclasses import replace

from martforge.plans.catalog import MARTS, create_tables, refresh_marts
from martforge.plans.comments import KEY
from martforge.plans.registry import DRIVER_CONFIG
from martforge.session import checkpoint_dir
from martforge.sources.shape import DriverSources

SF = "/root/testdata/sf0.001"


def test_catalog_covers_all_marts():
    assert len(MARTS) == 26


def test_refresh_writes_declared_schemas(spark):
    target = os.path.join(checkpoint_dir(spark), "refresh-test")
    names = ["payment_terms", "material_class", "vendor_otd"]
    done = refresh_marts(DriverSources(spark, SF), DRIVER_CONFIG, target, names)
    assert list(done) == names
    for n in names:
        assert done[n] == spark.read.parquet(f"{target}/{n}").count()
        back = spark.read.parquet(f"{target}/{n}")
        assert back.columns == [c.name for c in MARTS[n].schema]


def test_create_tables_with_comments(spark):
    db = "martforge_catalog_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{os.path.join(checkpoint_dir(spark), 'catalog-db')}'")
    created = create_tables(spark, db)
    assert len(created) == 26
    columns = 0
    for name, mart in MARTS.items():
        table = [r for r in spark.sql(f"DESCRIBE TABLE {db}.{name}").collect() if not r.col_name.startswith("#")]
        assert [r.col_name for r in table] == [KEY.name, *(c.name for c in mart.schema)]
        assert all(r.comment for r in table)
        columns += len(table)
    assert columns == 317 + 26
    refresh_marts(DriverSources(spark, SF), DRIVER_CONFIG, db, ["billing_blocks", "approved_mfg_part_list"],
                  as_tables=True)
    for name in ("billing_blocks", "approved_mfg_part_list"):
        rows = spark.table(f"{db}.{name}")
        assert rows.columns[0] == KEY.name and sorted(r[0] for r in rows.select(KEY.name).collect()) == list(range(1, rows.count() + 1))
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_bom_listing_is_depth_first_and_scratch_is_removed(spark):
    src = DriverSources(spark, SF)
    target = os.path.join(checkpoint_dir(spark), "listing-test")
    refresh_marts(src, DRIVER_CONFIG, f"{target}/plain", ["bill_of_materials"])
    refresh_marts(src, replace(DRIVER_CONFIG, bom_depth_first=True), f"{target}/listing", ["bill_of_materials"])
    plain, listing = (spark.read.parquet(f"{target}/{x}/bill_of_materials") for x in ("plain", "listing"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, listing.select(plain.columns).collect()))
    rows = [(r.top_material, r.top_plant, r.sort_path) for r in listing.collect()]
    assert rows == sorted(rows)
    base = os.path.dirname(checkpoint_dir(spark).removeprefix("file:"))
    assert not [x for x, _, _ in os.walk(base) if "scratch-" in x]
