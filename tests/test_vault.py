from conftest import rows, values
from pyspark.sql import functions as F

from stratavault.catalog.vault_queries import MEMBERS, directory
from stratavault.functions.keys import hash_key
from stratavault.operators import vault as v
from stratavault.plans import revenue as r

L1, L2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stage(spark, data):
    names = [r.CENTER, r.YEAR, r.MONTH, r.CHANNEL, r.SECTOR, r.ROAD, r.PLAN, r.APPROVED, r.FACT]
    return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))


DATA = [
    ("c1", "2024", "1", "ch1", r.SECTOR_PAID, "r1", "10", None, "100.10"),
    ("c1", "2024", "1", "ch1", r.SECTOR_PAID, "r1", "10", None, "100.10"),
    ("c1", "2024", "2", "ch1", r.SECTOR_PAID, "r1", "x", "1", "50"),
    ("c2", "2024", "1", "ch1", "other", "r2", None, None, "7"),
    ("c2", "2024", "1", "ch2", r.SECTOR_PAID, "unknown road", None, None, "9"),
]


def full_stage(spark, data=DATA):
    directories = {name: directory(spark, members) for name, members in MEMBERS.items()}
    named = spark.sql("SELECT * FROM VALUES ('r1'), ('r2') AS t(fullname)")
    centers = spark.sql("SELECT * FROM VALUES ('c1'), ('c2') AS t(fullname)")
    channels = spark.sql("SELECT * FROM VALUES ('ch1'), ('ch2') AS t(shortname)")
    return r.Stage(stage(spark, data), named, centers, channels, directories)


def test_hub_and_satellite(spark):
    raw = r.raw_vault(full_stage(spark), L1)
    hub = raw["hub_revenue"]
    assert hub.count() == 4 and hub.columns == ["revenue_hk", "year", "month", "sales_channel", "medical_center", "period", "load_date", "source_system"]
    sat = raw["sat_revenue"]
    assert sat.count() == 5  # equal rows stay
    assert {str(x) for x in values(sat.select("plan_kdro__rub"))} == {"10.00", "0.00", "None"}
    keys = set(values(hub.select("revenue_hk")))
    assert set(values(sat.select("revenue_hk"))) == keys
    assert set(values(raw["link_sales_channel"].select("revenue_hk"))) == keys


def test_links(spark):
    raw = r.raw_vault(full_stage(spark), L1)
    assert raw["link_road"].count() == 3  # the unknown road has no hub row
    link = raw["link_medical_center"]
    expected = hash_key("medical_center_hk", "revenue_hk")
    assert link.where(F.col("link_medical_center_revenue_hk") != expected).count() == 0
    assert link.select("link_medical_center_revenue_hk").distinct().count() == link.count() == 4
    assert raw["link_discreteness"].count() == 4


def test_missing_constant(spark):
    full = full_stage(spark)
    hub = r.hub_revenue(full.revenue, L1)
    units = v.hub(full.directories["unit"], "unit_hk", ["fullname"], {"fullname": "fullname"}, L1, "s")
    arguments = (full.revenue, units, "unit_hk", "fullname", "no such unit", hub, "revenue_hk", "l_hk", L1, "s")
    assert v.link_to_constant(*arguments).count() == 0
    kept = v.link_to_constant(*arguments, keep_missing=True)
    assert kept.count() == 4 and kept.where("l_hk is null and unit_hk is null").count() == 4
    assert v.link_to_constant(full.revenue.limit(0), *arguments[1:], keep_missing=True).count() == 0


def test_no_cross_products(spark):
    raw = r.raw_vault(full_stage(spark), L1)
    for name in ("link_road", "link_unit", "link_value_type"):
        text = plan(raw[name])
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
    text = plan(r.business_revenue(raw))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_business_layer(spark):
    layers = r.build(full_stage(spark), L1)
    grains = layers["bdv"]["revenue"]
    got = {(x["year"], x["month"]): float(x["value"]) for x in grains.collect()}
    assert got == {(2024, 1): 200.20, (2024, 2): 50.0, (2024, None): 250.20}
    assert layers["bdv"]["hub_revenue"].count() == layers["bdv"]["sat_revenue"].count() == 3
    monthly = grains.where("month is not null").first()
    yearly = grains.where("month is null").first()
    md5 = {n: spark.sql(f"SELECT md5('{n}')").first()[0] for n in (r.STEP_MONTH, r.STEP_YEAR, r.VALUE_RUNNING, r.VALUE_TOTAL, r.UNIT_THOUSAND)}
    assert (monthly["discreteness_hk"], monthly["value_type_hk"]) == (md5[r.STEP_MONTH], md5[r.VALUE_RUNNING])
    assert (yearly["discreteness_hk"], yearly["value_type_hk"]) == (md5[r.STEP_YEAR], md5[r.VALUE_TOTAL])
    report = layers["report"]["pmu_revenue"]
    assert "med_center_hk" in report.columns and set(values(report.select("unit_hk"))) == {md5[r.UNIT_THOUSAND]}
    assert {(str(x["date"]), float(x["value"])) for x in report.collect()} == {
        ("2024-01-01", 0.2002), ("2024-02-01", 0.05), ("2024-01-01", 0.2502)}
    assert layers["mart"]["road"].columns == ["road_hk", "fullname"]
    assert layers["report"]["unit"].columns == ["unit_hk", "full_name"]
    assert layers["bdv"]["link_road"].count() == 3


def test_one_hot_key(spark):
    """A third and more of the stage in one business key: same sums as a plain aggregate."""
    hot = [("c1", "2024", "1", "ch1", r.SECTOR_PAID, "r1", None, None, "1")] * 3000
    rest = [(f"c{i % 2 + 1}", str(2000 + i % 20), str(i % 12 + 1), f"ch{i % 2 + 1}", r.SECTOR_PAID, "r1", None, None, str(i)) for i in range(2000)]
    layers = r.build(full_stage(spark, hot + rest), L1)
    total = layers["bdv"]["revenue"].where("month is null").select(F.sum("value")).first()[0]
    assert total == 3000 + sum(range(2000))


def test_latest(spark):
    def load(data, ts):
        return v.satellite(spark.createDataFrame(data, "name string, a int"), "hk", ["name"], {"name": "name", "a": "a"}, ts, "s")
    history = load([("x", 1), ("y", 1), ("z", 1)], L1).unionByName(load([("x", 2), ("y", 1)], L2))
    assert rows(v.latest_per_key(history, "hk").select("name", "a")) == [("x", 2), ("y", 1), ("z", 1)]
    assert rows(v.latest_batch(history).select("name", "a")) == [("x", 2), ("y", 1)]
    assert "WindowGroupLimit" in plan(v.latest_per_key(history, "hk"))


def test_upsert(frame):
    now, new = frame("(1,'a',1), (2,'b',1)", "k", "v", "t"), frame("(2,'c',2), (3,'d',2), (3,'e',3)", "k", "v", "t")
    assert rows(v.upsert_by_key(now, new, ["k"], [F.desc("t")])) == [(1, "a", 1), (2, "c", 2), (3, "e", 3)]


def test_hot_name_is_spread_without_settings(spark):
    """No broadcast and no adaptive execution: the salted semi-join still deals out a name that holds most pairs."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, value in changed.items():
        spark.conf.set(k, value)
    try:
        pairs = spark.range(20_000).selectExpr("CASE WHEN id % 4 < 3 THEN 'hot' ELSE concat('n', id % 500) END AS hk", "cast(id as string) AS other")
        kept = v.known_keys(pairs, spark.range(250).selectExpr("concat('n', id) AS hk").union(spark.sql("SELECT 'hot'")), "hk", "other")
        sizes = [r["count"] for r in kept.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
        assert sum(sizes) == kept.count() == 20_000 - pairs.where("try_cast(substr(hk, 2) AS int) >= 250").count()
        assert max(sizes) < 20_000 / 5
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_one_satellite_row_per_key(spark):
    rows_ = spark.createDataFrame([("x", 2, "b"), ("x", 1, "z"), ("x", None, "q"), ("y", 1, None)], "name string, a int, b string")
    sat = v.satellite(rows_, "hk", ["name"], {"name": "name", "a": "a", "b": "b"}, L1, "s")
    assert rows(sat.select("name", "a", "b")) == sorted([("x", None, "q"), ("y", 1, None)], key=repr)


def test_last_write_wins(frame):
    now, late = frame("(1,'a',9), (2,'b',1)", "k", "v", "day"), frame("(1,'c',3), (1,'d',4)", "k", "v", "day")
    assert rows(v.upsert_by_key(now, late, ["k"], [F.desc("day")])) == [(1, "d", 4), (2, "b", 1)]
