"""The file lifecycle across runs: each run lists the store, compares it with what earlier runs have seen, and leaves its
state (known versions, status log) in two tables for the next one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.session import materialise
from stratavault.sinks import tables as sinks
from stratavault.sources import files as fi

VERSIONS, LOG = "file_versions", "file_log"
#: Versions of a file that stay known.
KEPT_VERSIONS = 2
_LISTING = ("key string, file_name string, user_name string, guid string, bucket string, table_name string, "
            "last_modified timestamp_ntz, size bigint")


def known_versions(spark: SparkSession, database: str) -> DataFrame:
    """The versions that earlier runs have seen and that are still kept; none before the first run."""
    name = f"{database}.{VERSIONS}"
    return spark.table(name) if sinks.exists(spark, name) else spark.createDataFrame([], _LISTING)


def current_status(spark: SparkSession, database: str) -> DataFrame:
    """The newest log entry of every file."""
    return fi.latest_status(spark.table(f"{database}.{LOG}"))


def run(spark: SparkSession, root: str, buckets: Sequence[str], database: str, logged_at: str, pattern: str = "*") -> DataFrame:
    """One run: list the files below ``root``, classify them against the known versions, note the outcome.

    Returns a row per listed or vanished file: the listing columns and status (new, changed, no_changed, error, missing).
    New and changed files become known versions; of each file the newest ones are kept, and a vanished file is no
    longer known, so that it is missing once and new if it comes back. The log gains an entry for every file that
    was new, changed or faulty. A run that is repeated after a failure finds the state of the run before.
    """
    listing = materialise(fi.list_objects(spark, root, buckets, pattern), "file-listing")
    known = materialise(known_versions(spark, database), "file-versions")
    classes = fi.classify_changes(listing, known).drop("change_code")
    gone = fi.missing_files(listing, known).withColumn("status", F.lit("missing"))
    outcome = materialise(classes.unionByName(gone), "file-outcome")

    moment = F.lit(logged_at).cast("timestamp_ntz")
    loaded = outcome.where(F.col("status").isin("new", "changed"))
    entries = [fi.status_entries(loaded, fi.FILE_LOADED, moment).withColumn("entry", F.lit(1)),
               fi.status_entries(loaded, fi.DONE, moment).withColumn("entry", F.lit(2)),
               fi.status_entries(outcome.where("status = 'error'"), fi.FAILED, moment).withColumn("entry", F.lit(1))]
    log = f"{database}.{LOG}"
    added = entries[0].unionByName(entries[1]).unionByName(entries[2])
    earlier = spark.table(log).where(F.col("logged_at") != moment) if sinks.exists(spark, log) else added.limit(0)
    sinks.rebuild(earlier.unionByName(added), log)  # entries of a run that was cut off are replaced
    stays = known.join(gone.select(*fi.FILE_KEY), fi.FILE_KEY, "left_anti").unionByName(loaded.select(*known.columns))
    sinks.rebuild(fi.without_keys_and_times(stays, fi.nth_latest(stays, KEPT_VERSIONS + 1)), f"{database}.{VERSIONS}")
    return outcome
