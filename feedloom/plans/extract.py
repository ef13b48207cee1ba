"""An extract: rows out of a source, into files, with count, watermark and manifest."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from feedloom.sinks.datasets import RECORDS_PER_FILE, Written, dated_target, load_manifest, write_dataset, write_watermark
from feedloom.sources.files import WATERMARK
from feedloom.sources.jdbc import extract_query


@dataclass(frozen=True)
class ExtractJob:
    """Settings of an extract.

    ``run_date`` adds a dated subfolder to the target. An incremental extract stores the greatest value of
    ``watermark_column`` under ``watermark_location``. A ``feed_id`` with a ``manifest_location`` makes a load manifest.
    """

    location: str
    file_format: str = "parquet"
    mode: str = "append"
    records_per_file: int | None = RECORDS_PER_FILE
    run_date: date | str | None = None
    incremental: bool = False
    watermark_column: str | None = None
    watermark_type: str = "timestamp"
    watermark_alias: str = WATERMARK
    watermark_location: str | None = None
    watermark_mode: str = "overwrite"
    watermark_format: str = "csv"
    manifest_location: str | None = None
    feed_id: str | None = None
    feed_version: str = "1"
    header: bool = False
    delimiter: str = ","
    run_id: str = "na"

    def __post_init__(self):
        if self.incremental and not (self.watermark_column and self.watermark_location):
            raise ValueError("an incremental extract needs a watermark column and a location for it")
        if self.manifest_location and not self.feed_id:
            raise ValueError("a load manifest needs a feed id")


# Job arguments that go to a setting as they are.
PLAIN_ARGUMENTS = {
    "OUTPUT_LOCATION": "location",
    "FILE_FORMAT": "file_format",
    "SAVE_MODE": "mode",
    "INCREMENTAL_COL_NAME": "watermark_column",
    "INCREMENTAL_COLUMN_DATATYPE": "watermark_type",
    "INCREMENTAL_COLUMN_ALIAS": "watermark_alias",
    "INCREMENTAL_VALUE_OUTPUT_LOC": "watermark_location",
    "INCREMENTAL_FILE_WRITE_MODE": "watermark_mode",
    "INCREMENTAL_FILE_WRITE_FORMAT": "watermark_format",
    "AUDIT_FEED_ID": "feed_id",
    "AUDIT_FEED_VERSION": "feed_version",
    "FIELD_DELIMITER": "delimiter",
}


def _yes(value: str | bool | None) -> bool:
    return str(value or "").strip().lower() in ("y", "yes", "true", "1")


def from_arguments(args: Mapping[str, str], run_date: date | str) -> tuple[str, ExtractJob]:
    """The query and the settings of an extract, from upper-case job arguments.

    What is not given keeps the default of :class:`ExtractJob`. The run date is used only if the
    current date is to be appended to the location.
    """
    query = extract_query(
        args.get("DATABASE_NAME"),
        args.get("TABLE_NAME"),
        _yes(args.get("HISTORY_LOAD")),
        args.get("COMPLETE_QUERY"),
        args.get("FILTER_CONDITION"),
    )
    given = {field: args[name] for name, field in PLAIN_ARGUMENTS.items() if name in args}
    if "MAX_RECORDS_PER_FILE" in args:
        given["records_per_file"] = int(args["MAX_RECORDS_PER_FILE"] or 0) or None
    if args.get("APPEND_CURRENT_DATE", "N") != "N":
        given["run_date"] = run_date
    if _yes(args.get("POPULATE_META_FILE")):
        name = args.get("META_FILE_NAME") or f"{args.get('TABLE_NAME')}_{str(run_date).replace('-', '')}"
        given["manifest_location"] = f"{args['META_FILE_LOCATION'].rstrip('/')}/{name}"
    return query, ExtractJob(
        **given,
        incremental=_yes(args.get("IS_INCREMENTAL")),
        header=_yes(args.get("IS_HEADER")),
        run_id=args.get("CORRELATION_ID") or args.get("DAG_RUN_ID") or "na",
    )


def run(spark: SparkSession, rows: DataFrame, job: ExtractJob) -> Written:
    """Write the rows of any source, such as ``read_jdbc`` or ``extract_rows``, as the job asks."""
    written = write_dataset(
        rows,
        dated_target(job.location, job.run_date),
        job.file_format,
        job.mode,
        job.records_per_file,
        job.watermark_column if job.incremental else None,
        job.watermark_type,
    )
    if job.incremental:
        write_watermark(
            spark,
            written,
            job.watermark_location,
            job.watermark_alias,
            job.watermark_type,
            job.watermark_mode,
            job.watermark_format,
        )
    if job.manifest_location:
        load_manifest(
            spark,
            written,
            job.manifest_location,
            job.feed_id,
            job.feed_version,
            job.file_format,
            job.header,
            job.delimiter,
            job.run_id,
        )
    return written
