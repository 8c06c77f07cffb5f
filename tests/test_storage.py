"""Workbooks, file lifecycle, tables, ingestion and publishing on real files."""

import io
import zipfile
from datetime import datetime

import pytest
from conftest import rows, values
from pyspark.sql import functions as F

from stratavault.plans import ingest
from stratavault.sinks import keyed
from stratavault.sinks import publish as pb
from stratavault.sinks import tables as sink
from stratavault.sources import files as fi
from stratavault.sources import tables as src
from stratavault.sources import workbook as wb

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(rows_xml: str, shared: str = "", merged: str = "", sheets: int = 1) -> bytes:
    """A minimal workbook; cell style 1 is a date, style 2 a custom date and time."""
    listed = "".join(f'<sheet name="s{i}" sheetId="{i}" r:id="rId{i}"/>' for i in range(1, sheets + 1))
    links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, sheets + 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{REL}"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{shared}</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts><numFmt numFmtId="170" formatCode="dd/mm/yy\\ hh:mm"/></numFmts>'
                                    '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        for i in range(1, sheets + 1):
            body = rows_xml if i == 1 else ""
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData>{merged if i == 1 else ''}</worksheet>")
    return out.getvalue()


SHARED = "<si><t>Имя, руб.</t></si><si><r><t>day</t></r><r><t>s</t></r></si><si><t>a|b</t></si>"
ROWS = ('<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>n</t></is></c><c r="E1" t="str"><v>n</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2" s="1"><v>45292</v></c><c r="C2"><v>12.0</v></c><c r="D2" t="b"><v>1</v></c><c r="E2"><v>0.5</v></c></row>'
        '<row r="4"><c r="B4" s="2"><v>45292.5</v></c><c r="C4"><v>7</v></c><c r="E4" t="e"><v>#N/A</v></c></row>')
GUID = "12345678-1234-1234-1234-123456789abc"


@pytest.fixture
def book(tmp_path):
    def save(name="a.xlsx", **options):
        path = tmp_path / name
        path.write_bytes(workbook(ROWS, SHARED, **options))
        return str(path)
    return save


def test_read_sheet(spark, book):
    sheet = wb.read_sheet(spark, book())
    assert sheet.columns == ["Имя, руб.", "days", "n", "Unnamed: 3", "n.1"]
    assert rows(sheet) == sorted([("a|b", "2024-01-01 00:00:00", "12", "True", "0.5"), (None, "2024-01-01 12:00:00", "7", None, None)], key=repr)


def test_inspection(spark, book):
    plain, odd = book("a.xlsx"), book("b.xlsx", merged='<mergeCells><mergeCell ref="A1:B1"/></mergeCells>', sheets=2)
    got = {r["path"].rsplit("/", 1)[1]: (r["merged"], list(r["sheets"])) for r in wb.inspect(spark, [plain, odd]).collect()}
    assert got == {"a.xlsx": (False, ["s1"]), "b.xlsx": (True, ["s1", "s2"])}


def test_many_rows(spark, tmp_path):
    body = "".join(f'<row r="{i}"><c r="A{i}"><v>{i}</v></c></row>' for i in range(1, 12_002))
    path = tmp_path / "long.xlsx"
    path.write_bytes(workbook(body))
    assert wb.read_rows(spark, str(path)).count() == 12_001


@pytest.fixture
def schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stage_t")
    yield "stage_t"
    spark.sql("DROP DATABASE stage_t CASCADE")


def test_ingest(spark, book, schema):
    listed = {"file_name": "a.xlsx", "table_name": "a_xlsx", "status": "new", "size": 10}
    done = ingest.load_file(spark, listed, book(sheets=2), schema)
    assert (done.status, done.rows_loaded, done.error) == ("success", 2, None) and done.warnings
    typed = spark.table(f"{schema}.a_xlsx")
    assert dict(typed.dtypes) == {"Имя, руб.": "string", "days": "timestamp_ntz", "n": "int", "n.1": "decimal(38,10)"}
    assert values(typed.select("`Имя, руб.`")) == ["", "a b"]
    assert spark.table(f"{schema}.v_a_xlsx").count() == 2
    assert not sink.exists(spark, f"{schema}.a_xlsx__landing")
    again = ingest.load_file(spark, {**listed, "status": "changed"}, book(), schema)
    assert again.status == "success" and spark.table(f"{schema}.a_xlsx").count() == 2
    merged = ingest.load_file(spark, listed, book("m.xlsx", merged='<mergeCells><mergeCell ref="A1:B1"/></mergeCells>'), schema)
    assert merged.status == "error" and fi.MERGED_CELLS in merged.error
    assert ingest.load_file(spark, {**listed, "status": "error"}, book(), schema).status == "error"
    gone = ingest.clean_missing(spark, spark.createDataFrame([("a.xlsx", "a_xlsx")], "file_name string, table_name string"), schema)
    assert [g.status for g in gone] == ["deleted"] and not sink.exists(spark, f"{schema}.a_xlsx")
    total = fi.run_summary(ingest.results_frame(spark, [done, merged, *gone])).first()
    assert (total["total"], total["successful"], total["failed"], total["deleted"], total["total_rows_loaded"]) == (3, 1, 1, 1, 2)


def test_listing(spark, tmp_path):
    for bucket in ("one", "two"):
        (tmp_path / bucket).mkdir()
    (tmp_path / "one" / f"my file.v1_--_ivan_--_{GUID}.xlsx").write_bytes(b"12345")
    (tmp_path / "two" / "plain+50% name.csv").write_bytes(b"1")
    listing = fi.list_objects(spark, str(tmp_path), ["one", "two"])
    assert listing.columns == fi.LISTING_COLUMNS
    assert rows(listing.select("bucket", "key", "file_name", "user_name", "guid", "table_name", "size")) == [
        ("one", f"my file.v1_--_ivan_--_{GUID}.xlsx", "my file.v1.xlsx", "ivan", GUID, "my_file_v1_xlsx", 5),
        ("two", "plain+50% name.csv", "plain+50% name.csv", "unknown", "unknown", "plain+50%_name_csv", 1)]
    (tmp_path / "one" / "two").mkdir()
    (tmp_path / "one" / "two" / "plain.csv").write_bytes(b"12")
    nested = fi.list_objects(spark, f"file://{tmp_path}", ["one", "two"], "plain.csv")
    assert rows(nested.select("bucket", "key", "size")) == [("one", "two/plain.csv", 2)]
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert bytes(fi.read_object(spark, str(tmp_path / "two" / "plain+50% name.csv")).first()["content"]) == b"1"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        fi.read_object(spark, str(tmp_path / "none")).collect()


def listing_row(name, at, size=1, guid="g", bucket="b", key=None):
    return (key or name, name, "u", guid, bucket, name.replace(".", "_"), at, size)


def listing_of(spark, *data):
    return spark.createDataFrame(list(data), "key string, file_name string, user_name string, guid string, bucket string, table_name string, "
                                             "last_modified timestamp_ntz, size bigint")


def test_changes(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    metadata = listing_of(spark, listing_row("same.xlsx", new), listing_row("same.xlsx", old, size=9, key="k0"), listing_row("moved.xlsx", old),
                          listing_row("grown.xls", new), listing_row("gone.xlsx", old), listing_row("same.xlsx", old, bucket="other"))
    listing = listing_of(spark, listing_row("same.xlsx", new), listing_row("moved.xlsx", new), listing_row("grown.xls", new, size=2),
                         listing_row("fresh.XLSX", new), listing_row("text.csv", new))
    got = dict((r["file_name"], (r["change_code"], r["status"])) for r in fi.classify_changes(listing, metadata).collect())
    assert got == {"same.xlsx": (4, "no_changed"), "moved.xlsx": (2, "changed"), "grown.xls": (2, "changed"), "fresh.XLSX": (1, "new"), "text.csv": (3, "error")}
    assert rows(fi.missing_files(listing, metadata).select("bucket", "file_name")) == [("b", "gone.xlsx"), ("other", "same.xlsx")]
    assert values(fi.nth_latest(metadata).select("key")) == ["k0"]
    assert fi.without_keys(metadata, fi.nth_latest(metadata)).count() == 5


def test_status_log(spark):
    files = listing_of(spark, listing_row("a.xlsx", datetime(2024, 1, 1)))
    moments = [F.lit(f"2024-01-0{i} 00:00:00").cast("timestamp_ntz") for i in (1, 2)]
    log = fi.status_entries(files, fi.READING, moments[0]).unionByName(fi.status_entries(files, fi.DONE, moments[1])).withColumn("entry", F.lit(1))
    assert values(fi.latest_status(log).select("status")) == [fi.DONE]
    with pytest.raises(ValueError):
        fi.status_entries(files, "finished")


def test_table_writes(spark, schema, frame):
    name = f"{schema}.t"
    sink.rebuild(frame("(1,'a')", "k", "v"), name)
    sink.rebuild(spark.table(name).unionByName(frame("(2,'b')", "k", "v")), name)  # reads what it replaces
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    assert sink.append(frame("('c',3), ('d',4)", "v", "k"), name) == 2
    sink.upsert(frame("(3,'z'), (5,'e')", "k", "v"), name, ["k"], [F.desc("v")])  # the last write wins
    assert rows(spark.table(name)) == [(1, "a"), (2, "b"), (3, "z"), (4, "d"), (5, "e")]
    sink.truncate(spark, name)
    assert spark.table(name).count() == 0
    sink.drop_table(spark, name)
    sink.drop_table(spark, name)
    assert not sink.exists(spark, name)
    sink.create_landing(spark, f"{schema}.land", ["x y", "Unnamed: 1"])
    sink.create_landing(spark, f"{schema}.land", ["other"])
    assert spark.table(f"{schema}.land").columns == ["x y"]


def test_history(spark, schema):
    def load(ts):
        return spark.range(2).select("id", F.lit(ts).cast("timestamp_ntz").alias("load_date"))
    name = f"{schema}.sat"
    sink.append_history(load("2024-01-01 00:00:00"), name)
    sink.append_history(load("2024-02-01 00:00:00"), name)
    assert spark.table(name).count() == 4
    sink.append_history(load("2024-03-01 00:00:00"), name, full_refresh=True)
    assert spark.table(name).count() == 2


def test_a_load_that_comes_again_replaces_itself(spark, schema):
    def load(ts, n):
        return spark.range(n).select("id", F.lit(ts).cast("timestamp_ntz").alias("load_date"))
    name = f"{schema}.again"
    for ts, n in (("2024-01-01 00:00:00", 3), ("2024-02-01 00:00:00", 4), ("2024-02-01 00:00:00", 4), ("2024-01-01 00:00:00", 2)):
        sink.append_history(load(ts, n), name)
    assert rows(spark.table(name).groupBy("load_date").count().select("count")) == [(2,), (4,)]


def test_keyed_table_grows_by_ranges(spark, schema):
    name = f"{schema}.keyed"

    def rows_of(low, high, value):
        return spark.range(low, high).select((F.col("id") % 1000).alias("k"), F.lit(value).alias("v"), F.lit("t").alias("load"))

    def files():
        found = {}
        for f in spark.table(name).inputFiles():
            found.setdefault(f.rsplit("/", 2)[1], []).append(f)
        assert all(len(f) == 1 for f in found.values())  # one file per range
        return found

    first = keyed.load_keyed(rows_of(0, 1500, "a"), name, ["k"], rows_per_range=100)
    assert first.new == 1000 and 8 <= first.ranges_written <= 13
    before = files()
    assert len(before) == first.ranges_written
    second = keyed.load_keyed(rows_of(500, 510, "b"), name, ["k"], rows_per_range=100)
    after = files()
    assert (second.changed, second.ranges_written) == (10, sum(before[r] != after[r] for r in before)) and second.ranges_written <= 2
    third = keyed.load_keyed(rows_of(500, 520, "b").unionByName(rows_of(0, 400, "a")), name, ["k"], rows_per_range=100)
    assert (third.new, third.changed, third.unchanged) == (0, 10, 410)
    again = keyed.load_keyed(rows_of(0, 400, "a").withColumn("load", F.lit("u")), name, ["k"], rows_per_range=100, compare=["v"])
    assert (again.unchanged, again.ranges_written) == (400, 0)
    grown = keyed.load_keyed(spark.range(5000, 5600).select(F.col("id").alias("k"), F.lit("c").alias("v"), F.lit("t").alias("load")), name, ["k"], rows_per_range=100)
    assert grown.new == 600 and len(files()) > len(after) + 3
    assert rows(keyed.keyed_rows(spark, name).groupBy("v").count()) == [("a", 980), ("b", 20), ("c", 600)]
    sizes = [r["count"] for r in spark.table(name).groupBy("key_range").count().collect()]
    assert max(sizes) <= 250 and rows(spark.table(name + "__ranges").selectExpr("sum(rows)")) == [(1600,)]


def test_keyed_table_order_nulls_removal_and_recovery(spark, schema, frame):
    name = f"{schema}.keyed2"
    keyed.load_keyed(frame("(1,'a'), (2,'b'), (2,'c'), (null,'d')", "k", "v"), name, ["k"], rows_per_range=1)
    assert rows(keyed.keyed_rows(spark, name)) == [(1, "a"), (2, "b"), (None, "d")]
    spark.sql(f"DROP TABLE {name}__ranges")  # as if the load had ended between the two tables
    done = keyed.load_keyed(frame("(2,'z'), (null,'e'), (0,'n'), (9,'m')", "k", "v"), name, ["k"], [F.desc("v")], rows_per_range=1, removed=frame("(1), (2), (77)", "k"))
    assert (done.new, done.changed, done.removed) == (2, 2, 1)
    assert rows(keyed.keyed_rows(spark, name)) == [(0, "n"), (2, "z"), (9, "m"), (None, "e")]
    keyed.load_keyed(frame("(1,'q')", "k", "v").where("false"), name, ["k"], rows_per_range=1, removed=frame("(0), (9), (2)", "k"))
    keyed.load_keyed(frame("(-5,'x')", "k", "v"), name, ["k"], rows_per_range=1)
    assert rows(keyed.keyed_rows(spark, name)) == [(-5, "x"), (None, "e")]


def test_an_empty_reload_replaces_its_rows(spark, schema):
    name, ts = f"{schema}.emptied", "2024-01-01 00:00:00"
    load = spark.range(3).select("id", F.lit(ts).cast("timestamp_ntz").alias("load_date"))
    sink.append_history(load, name, load_ts=ts)
    sink.append_history(load.where("false"), name, load_ts=ts)
    assert spark.table(name).count() == 0


def test_scratch_is_released(spark, tmp_path):
    from stratavault import session
    session.release(spark)
    stored = session.materialise(spark.range(3), "scratch")
    path = stored.inputFiles()[0].rsplit("/", 1)[0]
    assert stored.count() == 3 and session.release(spark) == 1
    assert not session.list_folder(spark, path) and session.release(spark) == 0


def test_rebuild_keeps_partitions(spark, schema, frame):
    name = f"{schema}.parted"
    frame("(1,'a'), (2,'b')", "k", "v").write.partitionBy("v").saveAsTable(name)
    sink.rebuild(spark.table(name).where("v = 'b'").unionByName(frame("(3,'c')", "k", "v")), name)
    assert rows(spark.table(name).select("k", "v")) == [(2, "b"), (3, "c")]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["v"]


def test_layer_names():
    assert sink.layer_table("rdv", "hub_road") == "main_rdv.hub_road"
    assert sink.layer_table("report", "road_dim", "view") == "main_report.v_road_dim"
    assert sink.layer_table("mart", "road", "table", "dims") == "main_mart.road"
    assert sink.layer_table("mart", "road", "view", "dims") == "main_mart.v_road"
    assert sink.layer_table("bdv", "sat_bdv__road", "view", "satellites") == "main_bdv.v_sat_bdv__road"
    assert sink.layer_table("bdv", "hub_bdv__road", "view", "hubs") == "main_bdv.hub_bdv__road"
    assert sink.layer_table("landing", "x") == "stage.x"


def test_catalogue(spark, schema):
    for name in ("data_events_20180101", "data_events_20180102", "data_other"):
        sink.rebuild(spark.range(1), f"{schema}.{name}")
    spark.sql(f"USE {schema}")
    try:
        assert src.relations_by_prefix(spark, "data_events_", schema) == [f"{schema}.data_events_20180101", f"{schema}.data_events_20180102"]
        assert src.relations_by_pattern(spark, schema.upper(), "DATA%", exclude="%0102") == [f"{schema}.data_events_20180101", f"{schema}.data_other"]
        assert set(values(src.catalogue(spark).where("name like 'data%'").select("kind"))) == {"table"}
    finally:
        spark.sql("USE default")
    assert src.safe_columns(["a", "b`c", "d\\e"]) == ["a"]
    with pytest.raises(ValueError):
        src.column_list(spark.range(1).select())


def test_table_kinds(frame):
    df = frame("('BASE TABLE'), ('EXTERNAL'), ('MATERIALIZED VIEW'), ('View'), ('MANAGED'), ('TEMPORARY')", "k")
    assert [r[0] for r in df.select(src.table_kind("k")).collect()] == ["table", "external", "materializedview", "view", "table", "view"]


def test_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("﻿user_id,event\n1,play\n2,\"pause, then\"\n", encoding="utf-8")
    assert rows(src.read_seed(spark, str(path), "user_id int, event string")) == [(1, "play"), (2, "pause, then")]


def test_publish(spark, tmp_path, frame):
    names = ["decimal(15,2)", "varchar(20)", "string", "array<int>", "timestamp_ntz", "interval(5)"]
    got = spark.createDataFrame([(n,) for n in names], "t string").select(pb.map_type("t")).collect()
    assert [r[0] for r in got] == ["NUMERIC(15,2)", "VARCHAR(20)", "TEXT", pb.FALLBACK_TYPE, "TIMESTAMP", pb.FALLBACK_TYPE]
    tables = {"a": spark.range(3), "b": spark.range(5)}
    outcome = pb.sync({**tables, "bad": spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))},
                      lambda df, name: pb.copy_files(df, str(tmp_path), name))
    assert outcome["a"] == outcome["b"] == "success" and outcome["bad"].startswith("error")
    copied = {n: spark.read.parquet(str(tmp_path / n)) for n in tables}
    assert rows(pb.row_counts(copied)) == rows(pb.row_counts(tables)) == [("a", 3), ("b", 5)]
    folder = str(tmp_path / "published")
    first = pb.publish_files(spark, tables, folder)
    assert [(e["table_name"], e["status"], e["source_rows"], e["target_rows"]) for e in first] == [("a", "success", 3, 3), ("b", "success", 5, 5)]
    second = pb.publish_files(spark, {"b": spark.range(4), "c": spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))}, folder)
    assert [(e["table_name"], e["status"][:7], e["target_rows"]) for e in second] == [("b", "success", 4), ("c", "error: ", None), ("a", "dropped", None)]
    assert "a" not in pb.published(spark, folder) and pb.published(spark, folder)["b"].count() == 4
    source, target = frame("('a'), ('b')", "n"), frame("('b'), ('z'), ('c')", "n")
    assert [r[0] for r in pb.stale_tables(source, target).collect()] == ["c", "z"]
