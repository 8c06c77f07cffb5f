"""Loads that prove themselves: delimited files, verified copies, restarted streams, the layered plan load by load."""

import uuid
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratavault.operators import vault as v
from stratavault.plans import revenue as r
from stratavault.sinks import publish as pb
from stratavault.sinks.bulk import LoadRefused, bulk_load
from stratavault.streaming import jobs

TS = [f"2024-0{m}-01 00:00:00" for m in (1, 2, 3)]


@pytest.fixture
def database(spark):
    name = f"loads_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_bulk_load_counts_filters_and_refuses(spark, tmp_path, database):
    path, name = tmp_path / "in.txt", f"{database}.t"
    path.write_text("1|a\n2\n3|b|c\nx|d\n|e\n4|f\n", encoding="utf-8")
    with pytest.raises(LoadRefused) as refused:
        bulk_load(spark, str(path), name, "k int, v string", "one", max_filter_ratio=0.6, required=("k",))
    assert (refused.value.load.loaded, refused.value.load.filtered) == (2, 4) and not spark.catalog.tableExists(name)
    done = bulk_load(spark, str(path), name, "k int, v string", "one", max_filter_ratio=0.7, required=("k",))
    assert (done.total, done.loaded, done.filtered) == (6, 2, 4)
    bulk_load(spark, str(path), name, "k int, v string", "one", max_filter_ratio=1)  # the label again, one more row fits
    assert rows(spark.table(name)) == [(1, "a", "one"), (4, "f", "one"), (None, "e", "one")]
    assert rows(spark.table(f"{name}__filtered").select("line")) == [("2",), ("3|b|c",), ("x|d",)]
    path.write_text("", encoding="utf-8")
    bulk_load(spark, str(path), name, "k int, v string", "one")
    assert spark.table(name).count() == 0


def test_copies_are_proven_by_content(spark, tmp_path, frame):
    a = frame("(1, null), (null, 1), (2, 2), (2, 2)", "x", "y")
    assert pb.fingerprint_of(a) == pb.fingerprint_of(a.repartition(3)) == (4, *pb.fingerprint_of(a)[1:])
    others = [frame("(1, null), (1, null), (2, 2), (2, 2)", "x", "y"), frame("(1, null), (null, 1), (2, 2)", "x", "y"), frame("(1, null), (null, 1), (2, 2), (2, 3)", "x", "y")]
    assert len({pb.fingerprint_of(f) for f in [a, *others]}) == 4
    assert pb.fingerprint_of(a.where("false")) == (0, 0, 0)
    tables, folder = {"a": a, "b": spark.range(9), "bad": spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))}, str(tmp_path / "out")
    first = {e["table_name"]: e["status"][:7] for e in pb.publish_verified(spark, tables, folder)}
    assert first == {"a": "success", "b": "success", "bad": "error: "}
    pb.copy_files(spark.range(1, 10), folder, "b")  # as many rows, others
    assert pb.differing(spark, tables, folder) == ["b", "bad"]
    del tables["bad"]
    again = {e["table_name"]: e["status"] for e in pb.publish_verified(spark, tables, folder)}
    assert again == {"a": "kept", "b": "success", "bad": "dropped"} and pb.differing(spark, tables, folder) == []


def test_a_batch_counts_when_both_parts_are_written(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(4):
        (source / f"{i}.txt").write_text(f'{{"Organization": "o{i}"}}\njunk {i}\n', encoding="utf-8")
    seen = []

    def stop(batch_id):
        seen.append((batch_id, jobs.staged(spark, target).count() if batch_id else 0))
        if seen.count(seen[-1]) == 1 and batch_id == 2:
            raise RuntimeError("stopped")

    attempts = jobs.with_retries(lambda: jobs.start(jobs.read_files(spark, str(source), 1), "contractor_debt", target, str(tmp_path / "check"), load_ts=TS[0], before_commit=stop))
    assert attempts == 2 and [n for _, n in seen] == [0, 1, 2, 2, 3]  # rows of a stopped batch are not shown
    assert rows(jobs.staged(spark, target).select("Organization")) == [(f"o{i}",) for i in range(4)]
    assert jobs.staged(spark, target, "quarantine").count() == 4
    assert rows(jobs.commits(spark, target).selectExpr("sum(n_messages)", "sum(n_rows)", "sum(n_bad)")) == [(8, 4, 4)]
    with pytest.raises(Exception, match="stopped"):
        jobs.with_retries(lambda: jobs.start(jobs.read_files(spark, str(source)), "rooms", target, str(tmp_path / "c2"), before_commit=lambda _: (_ for _ in ()).throw(RuntimeError("stopped"))), 2)


def test_lasting_ids(frame):
    known = frame("('b', 1), ('d', 2), ('d', 5)", "name", "id")
    names = frame("('a'), ('d'), ('c'), ('a'), (null)", "name")
    assert rows(v.lasting_ids(names, known, "name")) == sorted([("d", 2), (None, 6), ("a", 7), ("c", 8)], key=repr)
    assert rows(v.lasting_ids(names, None, "name")) == sorted([(None, 1), ("a", 2), ("c", 3), ("d", 4)], key=repr)


def stage(spark, revenue):
    text = ", ".join(f"`{c}` string" for c in (r.CENTER, r.YEAR, r.MONTH, r.CHANNEL, r.SECTOR, r.ROAD, r.PLAN, r.APPROVED, r.FACT))
    made = spark.createDataFrame([(c, y, m, "k", r.SECTOR_PAID, "R", "0", "0", str(x)) for c, y, m, x in revenue], text)

    def names(*members):
        return spark.createDataFrame([(m, str(i)) for i, m in enumerate(members)], "fullname string, id string")
    directories = {"unit": names(r.UNIT_ROUBLE, r.UNIT_THOUSAND), "metric": names(r.METRIC_FACT), "data_type": names(r.DATA_PRIMARY, r.DATA_DERIVED),
                   "discreteness": names(r.STEP_MONTH, r.STEP_YEAR), "value_type": names(r.VALUE_DAILY, r.VALUE_RUNNING, r.VALUE_TOTAL)}
    return r.Stage(made, names("R"), names("A", "B"), spark.createDataFrame([("k", "1")], "shortname string, id string"), directories)


def test_untouched_groups_are_not_written(spark, database):
    first = stage(spark, [(c, str(y), str(m), 10) for c in "AB" for y in range(2001, 2009) for m in (1, 2)])
    second = replace(first, revenue=stage(spark, [("A", "2008", "2", 25)]).revenue)
    r.load(first, TS[0], database)
    r.load_business(spark, database, TS[0], rows_per_range=6)
    name = f"{database}.{r.BUSINESS_TABLE}"
    before = {f.rsplit("/", 2)[1]: f for f in spark.table(name).inputFiles()}
    r.load(second, TS[1], database)
    done = r.load_business(spark, database, TS[1], rows_per_range=6)
    after = {f.rsplit("/", 2)[1]: f for f in spark.table(name).inputFiles()}
    assert (done.new, done.changed, done.removed) == (0, 2, 0) and done.unchanged == 1  # month 2 and the year; month 1 is as it was
    assert len(before) > 6 and sum(before[p] != after[p] for p in before) == done.ranges_written <= 2
    sums = {(x.year, x.month): x.value for x in spark.table(name).groupBy("year", "month").agg(F.sum("value").alias("value")).collect()}
    assert sums[2008, 2] == 35 and sums[2008, None] == 55 and sums[2001, None] == 40
    r.load(second, TS[2], database)  # the same delivery under another load time
    assert r.load_business(spark, database, TS[2], rows_per_range=6).ranges_written == 0
    report = r.stored_layers(spark, database, TS[2])["report"]["pmu_revenue"]
    assert float(report.agg(F.sum("value")).first()[0]) * 1000 == 2 * (8 * 40 + 15)


def test_fingerprint_sums_are_exact_and_in_longs(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("x"), F.col("id").cast("string").alias("y"))
    hashes = [df.select(h.alias("h")).collect() for h in pb._row_hashes(df)]
    assert pb.fingerprint_of(df) == (1000, *(sum(r["h"] for r in found) for found in hashes))
    plan = df.agg(*pb.fingerprint(df))._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(" not in plan and "decimal(38,0))" not in plan.split("Project")[-1]
