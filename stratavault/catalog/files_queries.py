"""File lifecycle over a listing made from pages and a status log made from documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavault.catalog.base import Query, own_database, table
from stratavault.functions.parsing import file_name_parts, is_workbook_name, table_name
from stratavault.plans import lifecycle
from stratavault.session import delete_path, list_folder, materialise, move_path, scratch_path
from stratavault.sources import files as fi


def objects(spark, d) -> DataFrame:
    """Pages as stored objects: name, user and identifier in the key; every eighth key is malformed."""
    p = F.col("page_id")
    digest = F.md5(F.col("url"))
    guid = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    extension = F.when(p % 9 == 0, "csv").when(p % 9 == 1, "xls").otherwise("xlsx")
    key = F.concat(F.lit("отчёт "), p.cast("string"), F.lit(".v1"), F.lit("_--_user"), (p % 7).cast("string"), F.lit("_--_"), guid,
                   F.lit("."), extension)
    broken = F.concat(F.lit("plain "), p.cast("string"), F.lit(".XLSX"))
    return table(spark, d, "pages").select(
        "page_id", F.concat(F.lit("bucket"), (p % 3).cast("string")).alias("bucket"), F.when(p % 8 == 7, broken).otherwise(key).alias("key"),
        F.timestamp_add("MINUTE", p.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("last_modified"),
        F.octet_length("html").cast("bigint").alias("size"))


def stored(spark, d) -> DataFrame:
    """Stored metadata: two versions of most files, some with another size, and files that are gone."""
    rows = fi.describe(objects(spark, d)).withColumn("no", F.regexp_extract("file_name", "([0-9]+)", 1).cast("bigint"))
    day = F.timestamp_add("DAY", F.lit(-1), F.col("last_modified"))
    older = rows.where("no % 5 <> 4").withColumn("last_modified", day).withColumn("key", F.concat(F.lit("old "), F.col("key")))
    newer = rows.where("no % 5 <> 4").withColumn("size", F.when(F.col("no") % 5 == 2, F.col("size") + 1).otherwise(F.col("size")))
    gone = rows.where("no % 10 = 3").withColumn("file_name", F.concat(F.lit("gone "), F.col("file_name")))
    return older.unionByName(newer).unionByName(gone).drop("no")


def status_log(spark, d) -> DataFrame:
    docs, n = table(spark, d, "documents"), F.col("doc_id")
    codes = F.array(*[F.lit(c) for c in fi.STATUS_CODES])
    return docs.select(F.col("lang").alias("bucket"), F.col("source").alias("file_name"), F.get(codes, (n % 8).cast("int")).alias("status"),
                       F.timestamp_add("HOUR", (n % 100).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("logged_at"),
                       n.alias("entry"))


def run_results(spark, d) -> DataFrame:
    n = F.col("doc_id")
    return table(spark, d, "documents").select(
        F.when(n % 10 == 0, "error").when(n % 10 == 1, "deleted").otherwise("success").alias("status"),
        F.when(n % 4 == 0, "new").when(n % 4 == 1, "missing").otherwise("changed").alias("file_status"),
        F.col("n_chars").alias("rows_loaded"), (n % 100).cast("decimal(10,2)").alias("processing_time_seconds"),
        (F.col("n_chars") * 4).alias("file_size_bytes"))


def file_parse(spark, d):
    rows = objects(spark, d)
    named = rows.select("page_id", *[c.alias(n) for n, c in file_name_parts("key").items()])
    return named.withColumn("table_name", table_name("file_name")).withColumn("is_workbook", is_workbook_name("file_name"))


def stored_listing(spark, d):
    """Documents stored in nested folders, a folder per language, with the partitions that the table has: whether the listing
    finds files with bytes in a folder, and the rows that these hold."""
    root = scratch_path(spark, "objects")
    docs = table(spark, d, "documents").withColumns({"store": F.concat(F.lit("b"), F.length("lang") % 2), "language": F.col("lang")})
    docs.write.partitionBy("store", "language").parquet(root)
    buckets = [n for n in list_folder(spark, root) if n.startswith("store=")]
    listed = fi.list_objects(spark, root, buckets, "*.parquet").where("size > 0").select("bucket", F.substring_index("key", "/", 1).alias("folder"))
    rows = spark.read.parquet(root).groupBy(F.concat(F.lit("language="), F.col("language")).alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))
    return listed.groupBy("bucket", "folder").agg((F.count(F.lit(1)) > 0).alias("has_files")).join(rows, "folder")


FILE_PARTS = 4


def put_files(spark, df: DataFrame, root: str) -> None:
    """Write the texts of documents as files ``<source> <part>.v1_--_user_--_<id>.<extension>`` in a bucket per language: each
    file by one task, a language and source by several."""
    landing = scratch_path(spark, "landing")
    part = F.pmod(F.col("doc_id"), F.lit(FILE_PARTS))
    extension = F.when(F.col("source") == "src4", "csv").otherwise("xlsx")
    name = F.concat("source", F.lit(" "), part.cast("string"), F.lit(".v1_--_user_--_00000000-0000-0000-0000-00000000000"), part.cast("string"), F.lit("."), extension)
    files = df.select(F.col("lang").alias("bucket"), name.alias("name"), F.coalesce("text", F.lit("")).alias("value"))
    files.repartition("bucket", "name").write.partitionBy("bucket", "name").text(landing)
    for bucket in (b for b in list_folder(spark, landing) if b.startswith("bucket=")):
        for folder in list_folder(spark, f"{landing}/{bucket}"):
            for file in list_folder(spark, f"{landing}/{bucket}/{folder}"):
                if file.startswith("part-"):
                    move_path(spark, f"{landing}/{bucket}/{folder}/{file}", f"{root}/{bucket.split('=')[1]}/{folder.split('=', 1)[1].replace('%20', ' ')}")


def file_lifecycle(spark, d):
    """Three runs over real files, the state of each carried to the next: all sources but one; then that one has come, one has
    changed and one has gone; then nothing has changed. Classes by run, the files' last log entries, and versions kept."""
    root = scratch_path(spark, "store")
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    outcomes = []
    with own_database(spark) as database:
        for number in (1, 2, 3):
            if number == 1:
                put_files(spark, docs.where("source <> 'src0'"), root)
                buckets = list_folder(spark, root)
            elif number == 2:
                for bucket in buckets:
                    for file in list_folder(spark, f"{root}/{bucket}"):
                        if file.startswith(("src1 ", "src2 ")):
                            delete_path(spark, f"{root}/{bucket}/{file}")
                put_files(spark, docs.where("source = 'src0'"), root)
                put_files(spark, docs.where("source = 'src1'").withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" again"))), root)
            outcome = lifecycle.run(spark, root, list_folder(spark, root), database, f"2024-01-0{number} 00:00:00")
            outcomes.append(outcome.select(F.lit(f"run {number}").alias("what"), "bucket", "file_name", "size", "status"))
        log = lifecycle.current_status(spark, database).select(F.lit("log").alias("what"), "bucket", "file_name", F.lit(None).cast("bigint").alias("size"), "status")
        versions = lifecycle.known_versions(spark, database).groupBy("bucket", "file_name").agg(F.count(F.lit(1)).alias("size"))
        kept = versions.select(F.lit("kept").alias("what"), "bucket", "file_name", "size", F.lit("").alias("status"))
        return materialise(reduce(DataFrame.unionByName, [*outcomes, log, kept]), "lifecycle")


LIFECYCLE_SQL = """
WITH parts AS (SELECT lang AS bucket, source, source || ' ' || (doc_id % 4) || '.v1.' || CASE source WHEN 'src4' THEN 'csv' ELSE 'xlsx' END AS file_name,
  CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS size, count(*) AS n FROM documents GROUP BY ALL),
runs AS (
  SELECT 'run 1' AS what, *, CASE source WHEN 'src4' THEN 'error' ELSE 'new' END AS status FROM parts WHERE source <> 'src0'
  UNION ALL SELECT 'run 2', * REPLACE (CASE source WHEN 'src1' THEN CAST(size + 6 * n AS BIGINT) ELSE size END AS size),
    CASE source WHEN 'src4' THEN 'error' WHEN 'src0' THEN 'new' WHEN 'src1' THEN 'changed' WHEN 'src2' THEN 'missing' ELSE 'no_changed' END FROM parts
  UNION ALL SELECT 'run 3', * REPLACE (CASE source WHEN 'src1' THEN CAST(size + 6 * n AS BIGINT) ELSE size END AS size),
    CASE source WHEN 'src4' THEN 'error' ELSE 'no_changed' END FROM parts WHERE source <> 'src2')
SELECT what, bucket, file_name, size, status FROM runs
UNION ALL SELECT 'log', bucket, file_name, NULL, CASE source WHEN 'src4' THEN 'processing_failed' ELSE 'processing_completed' END FROM parts
UNION ALL SELECT 'kept', bucket, file_name, CASE source WHEN 'src1' THEN 2 ELSE 1 END, '' FROM parts WHERE source NOT IN ('src2', 'src4')
"""


def object_bytes(spark, d):
    """The texts of pages stored as files, read back as objects with their bytes: bytes and lines of each part."""
    root = scratch_path(spark, "bytes")
    table(spark, d, "pages").select(F.regexp_replace(F.coalesce("html", F.lit("")), "[\\n\\r]", " ").alias("value"), F.pmod("page_id", F.lit(8)).alias("part")).repartition("part").write.partitionBy("part").text(root)
    found = None
    for part in (n for n in list_folder(spark, root) if n.startswith("part=")):
        one = fi.read_object(spark, f"{root}/{part}").select(F.lit(int(part[5:])).cast("bigint").alias("part"), "length", F.octet_length("content").alias("bytes"),
                                                             F.size(F.split(F.decode("content", "UTF-8"), "\n")).alias("lines"))
        found = one if found is None else found.unionByName(one)
    return found.groupBy("part").agg(F.sum("bytes").cast("bigint").alias("n_bytes"), (F.sum("bytes") == F.sum("length")).alias("whole"),
                                     F.sum(F.col("lines") - 1).cast("bigint").alias("n_lines"))


OBJECTS = """objects AS (SELECT page_id, 'bucket' || (page_id % 3) AS bucket, page_id % 8 <> 7 AS good,
  CASE WHEN page_id % 9 = 0 THEN 'csv' WHEN page_id % 9 = 1 THEN 'xls' ELSE 'xlsx' END AS ext, 'user' || (page_id % 7) AS usr,
  substr(md5(url), 1, 8) || '-' || substr(md5(url), 9, 4) || '-' || substr(md5(url), 13, 4) || '-' || substr(md5(url), 17, 4) || '-' || substr(md5(url), 21, 12) AS gd,
  TIMESTAMP '2024-01-01' + to_minutes(page_id) AS last_modified, CAST(strlen(html) AS BIGINT) AS size FROM pages),
listing AS (SELECT page_id, CASE WHEN good THEN 'отчёт ' || page_id || '.v1_--_' || usr || '_--_' || gd || '.' || ext ELSE 'plain ' || page_id || '.XLSX' END AS key,
  CASE WHEN good THEN 'отчёт ' || page_id || '.v1.' || ext ELSE 'plain ' || page_id || '.XLSX' END AS file_name,
  CASE WHEN good THEN usr ELSE 'unknown' END AS user_name, CASE WHEN good THEN gd ELSE 'unknown' END AS guid, bucket,
  CASE WHEN good THEN 'отчёт_' || page_id || '_v1_' || ext ELSE 'plain_' || page_id || '_XLSX' END AS table_name, last_modified, size FROM objects)"""
STORED = f"""{OBJECTS},
newer AS (SELECT * REPLACE (CASE WHEN page_id % 5 = 2 THEN size + 1 ELSE size END AS size) FROM listing WHERE page_id % 5 <> 4),
older AS (SELECT * REPLACE ('old ' || key AS key, last_modified - INTERVAL 1 DAY AS last_modified) FROM listing WHERE page_id % 5 <> 4),
gone AS (SELECT * REPLACE ('gone ' || file_name AS file_name) FROM listing WHERE page_id % 10 = 3)"""

QUERIES = {
    "file_listing_store": Query(stored_listing, """SELECT 'store=b' || (length(lang) % 2) AS bucket, 'language=' || lang AS folder, true AS has_files,
count(*) AS n_rows FROM documents GROUP BY lang"""),
    "file_lifecycle": Query(file_lifecycle, LIFECYCLE_SQL),
    "object_bytes": Query(object_bytes, """SELECT page_id % 8 AS part, CAST(sum(strlen(coalesce(html, '')) + 1) AS BIGINT) AS n_bytes, true AS whole, count(*) AS n_lines
FROM pages GROUP BY ALL"""),
    "file_listing": Query(lambda s, d: fi.describe(objects(s, d)), f"WITH {OBJECTS} SELECT * EXCLUDE (page_id) FROM listing"),
    "file_parse": Query(file_parse, f"""WITH {OBJECTS} SELECT page_id, file_name, user_name, guid, table_name,
lower(file_name) LIKE '%.xls' OR lower(file_name) LIKE '%.xlsx' AS is_workbook FROM listing"""),
    "file_change_class": Query(lambda s, d: fi.classify_changes(fi.describe(objects(s, d)), stored(s, d)), f"""WITH {OBJECTS},
c AS (SELECT *, CAST(CASE WHEN file_name LIKE '%.csv' THEN 3 WHEN page_id % 5 = 4 THEN 1 WHEN page_id % 5 = 2 THEN 2 ELSE 4 END AS INTEGER) AS change_code FROM listing)
SELECT * EXCLUDE (page_id), CASE change_code WHEN 1 THEN 'new' WHEN 2 THEN 'changed' WHEN 3 THEN 'error' ELSE 'no_changed' END AS status FROM c"""),
    "file_missing": Query(lambda s, d: fi.missing_files(fi.describe(objects(s, d)), stored(s, d)), f"WITH {STORED} SELECT * EXCLUDE (page_id) FROM gone"),
    "file_nth_latest": Query(lambda s, d: fi.nth_latest(stored(s, d), 2), f"WITH {STORED} SELECT * EXCLUDE (page_id) FROM older"),
    "file_delete_old": Query(lambda s, d: fi.without_keys(stored(s, d), fi.nth_latest(stored(s, d), 2)),
                             f"WITH {STORED} SELECT * EXCLUDE (page_id) FROM newer UNION ALL SELECT * EXCLUDE (page_id) FROM gone"),
    "file_status_latest": Query(lambda s, d: fi.latest_status(status_log(s, d)), f"""SELECT lang AS bucket, source AS file_name,
[{', '.join(f"'{c}'" for c in fi.STATUS_CODES)}][doc_id % 8 + 1] AS status, TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 100 AS INTEGER)) AS logged_at, doc_id AS entry
FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY doc_id % 100 DESC, doc_id DESC) = 1"""),
    "run_summary": Query(lambda s, d: fi.run_summary(run_results(s, d)), """WITH r AS (SELECT doc_id AS n, n_chars,
  CASE WHEN doc_id % 10 = 0 THEN 'error' WHEN doc_id % 10 = 1 THEN 'deleted' ELSE 'success' END AS status FROM documents)
SELECT count(*) AS total, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'error') AS failed,
count(*) FILTER (status = 'deleted') AS deleted, count(*) FILTER (status = 'success' AND n % 4 = 0) AS new_files,
count(*) FILTER (status = 'success' AND n % 4 > 1) AS changed_files, count(*) FILTER (n % 4 = 1) AS missing_files,
CAST(sum(n_chars) FILTER (status = 'success') AS BIGINT) AS total_rows_loaded, CAST(sum(n % 100) AS DOUBLE) AS total_processing_time_seconds,
CAST(sum(n_chars * 4) AS BIGINT) AS total_size_bytes FROM r"""),
}
