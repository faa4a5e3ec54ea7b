import re
import uuid

from martforge.plans import purchasing
from martforge.plans.registry import DRIVER_CONFIG
from martforge.session import checkpoint_dir
from martforge.sources.buckets import store_bucketed
from martforge.sources.shape import DriverSources


def test_document_joins_move_no_rows(spark):
    src = DriverSources(spark, "/root/testdata/sf0.001", stage=True)
    database = f"martforge_buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{checkpoint_dir(spark)}/{database}'")
    keys = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(keys), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        bucketed = store_bucketed(src, database, 6)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lines = {}
        for name, s in (("plain", src), ("bucketed", bucketed)):
            ekko, ekpo, eket = (s.scoped(t, DRIVER_CONFIG) for t in ("EKKO", "EKPO", "EKET"))
            df = ekpo.select("EBELN", "EBELP", "MATNR").join(ekko.select("EBELN", "BSART"), "EBELN").join(eket.select("EBELN", "EBELP", "ETENR"), ["EBELN", "EBELP"], "left")
            lines[name] = len(re.findall(r"Exchange hashpartitioning\(EBELN", df._jdf.queryExecution().executedPlan().toString())), sorted(map(str, df.collect()))
        assert lines["plain"][0] >= 3 and lines["bucketed"][0] == 0
        assert lines["plain"][1] == lines["bucketed"][1]
        plan = purchasing.purchase_order(bucketed, DRIVER_CONFIG)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\(EBELN", plan)
        whole = [sorted(map(str, purchasing.purchase_order(s, DRIVER_CONFIG).collect())) for s in (src, bucketed)]
        assert whole[0] == whole[1]
    finally:
        spark.conf.set(keys, before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
        spark.sql(f"DROP DATABASE {database} CASCADE")
