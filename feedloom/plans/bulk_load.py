"""Loading staged parquet files into a typed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sinks.publish import publish

# The columns of the flight notification table in their order, and those that
# are cast on loading.
NOTIFICATION_COLUMNS = (
    "notif_dtm",
    "carrier_cd",
    "flt_txt",
    "flt_num",
    "sch_dprt_dtl",
    "orig_arpt_cd",
    "dest_arpt_cd",
    "dvrt_txt",
    "cnxl_ind",
    "fst_notif",
    "proc_compl_dtm",
    "agt_compl",
    "cust_cntct_cd",
    "pax_cnt",
    "mp_cnt",
    "compl_cd",
    "acars_txt",
    "rsn_cd",
    "rsn_txt",
    "email_cd",
    "ez_cd",
    "stat_cd",
    "ready_ind",
    "flt_mnfst_ind",
    "wx_ind",
    "notes_txt",
    "create_dtm",
    "create_by",
    "update_dtm",
    "update_by",
    "load_dtm",
)
NOTIFICATION_CASTS = {
    "notif_dtm": "timestamp",
    "sch_dprt_dtl": "date",
    "proc_compl_dtm": "timestamp",
    "create_dtm": "timestamp",
    "update_dtm": "timestamp",
    "load_dtm": "timestamp",
}


def typed(
    staged: DataFrame,
    columns: Sequence[str] = NOTIFICATION_COLUMNS,
    casts: Mapping[str, str] = NOTIFICATION_CASTS,
    permissive: bool = False,
) -> DataFrame:
    """The listed columns in order, some of them cast; others pass as they are.

    A value that cannot be cast fails the job, or becomes NULL if permissive.
    """

    def one(name: str):
        if name not in casts:
            return F.col(name)
        col = F.col(name)
        return (col.try_cast(casts[name]) if permissive else col.cast(casts[name])).alias(name)

    return staged.select(*[one(c) for c in columns])


def load(
    spark: SparkSession,
    prefix: str,
    target: str,
    columns: Sequence[str] = NOTIFICATION_COLUMNS,
    casts: Mapping[str, str] = NOTIFICATION_CASTS,
) -> None:
    """Replace a dataset by the typed content of a parquet prefix.

    The files are read where they lie, only the listed columns of them. The target is replaced when all
    of the new content is written, so a load that fails leaves it as it was.
    """
    publish(spark, {target: typed(spark.read.parquet(prefix), columns, casts)})


def insert_into(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Insert into a catalog table by position, as an INSERT without a column list does."""
    df.write.insertInto(table)


def replace_rows(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Empty a catalog table and insert by position: one overwrite, so readers never find it half done."""
    df.write.insertInto(table, overwrite=True)
