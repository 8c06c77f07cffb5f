"""File ingestion: one workbook from validation to its typed table, and the clean-up of vanished files."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stratavault.operators.typing import inferred_types, landing_clean, typed_projection
from stratavault.sinks import tables as sink
from stratavault.sources import files as fi
from stratavault.sources.workbook import inspect, read_sheet

RESULT_SCHEMA = ("file_name string, table_name string, status string, file_status string, rows_loaded bigint, "
                 "processing_time_seconds double, file_size_bytes bigint, warnings array<string>, error string")


@dataclass
class LoadResult:
    file_name: str
    table_name: str
    status: str = "error"
    file_status: str = "new"
    rows_loaded: int = 0
    processing_time_seconds: float = 0.0
    file_size_bytes: int = 0
    warnings: list[str] = field(default_factory=list)
    error: str | None = None


def results_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """Load results as a table for the run summary."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in results], RESULT_SCHEMA)


def load_workbook(spark: SparkSession, path: str, schema: str, table: str) -> tuple[int, list[str]]:
    """Validate, land as text, infer types, write the typed table and its view; rows and warnings.

    The landing table is dropped only after the typed table is complete.
    """
    facts = inspect(spark, path).first()
    if facts["merged"]:
        raise ValueError(f"{fi.MERGED_CELLS}: {path}")
    warnings = [f"{fi.MANY_SHEETS}: {', '.join(facts['sheets'])}"] if len(facts["sheets"]) > 1 else []
    landing, typed = f"{schema}.{table}__landing", f"{schema}.{table}"
    clean = landing_clean(read_sheet(spark, path))
    sink.drop_table(spark, landing)
    sink.create_landing(spark, landing, clean.columns)
    rows = sink.append(clean, landing)
    landed = spark.table(landing)
    sink.rebuild(typed_projection(landed, inferred_types(landed)), typed)
    sink.companion_view(spark, typed)
    sink.drop_table(spark, landing)
    return rows, warnings


def load_file(spark: SparkSession, listed: dict, path: str, schema: str) -> LoadResult:
    """Run :func:`load_workbook` for one listed file and report the outcome."""
    result = LoadResult(listed["file_name"], listed["table_name"], file_status=listed.get("status", "new"),
                        file_size_bytes=listed.get("size", 0))
    started = time.monotonic()
    try:
        if result.file_status not in ("new", "changed"):
            raise ValueError(f"file is {result.file_status}")
        result.rows_loaded, result.warnings = load_workbook(spark, path, schema, result.table_name)
        result.status = "success"
    except Exception as problem:  # noqa: BLE001 - one bad file must not stop the others
        result.error = str(problem).split("\n", 1)[0]
    result.processing_time_seconds = round(time.monotonic() - started, 2)
    return result


def clean_missing(spark: SparkSession, missing: DataFrame, schema: str) -> list[LoadResult]:
    """Drop table and view of every vanished file; errors are collected, not raised."""
    results = []
    for row in missing.select("file_name", "table_name").toLocalIterator():
        result = LoadResult(row["file_name"], row["table_name"], status="deleted", file_status="missing")
        try:
            sink.drop_view(spark, f"{schema}.v_{row['table_name']}")
            sink.drop_table(spark, f"{schema}.{row['table_name']}")
        except Exception as problem:  # noqa: BLE001 - reported with the others
            result.status, result.error = "error", str(problem).split("\n", 1)[0]
        results.append(result)
    return results
