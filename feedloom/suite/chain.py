"""The inactivation chain over ``lineitem`` (legs, schedules) and ``part`` (paths)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import settled
from feedloom.plans import bulk_load, inactivation
from feedloom.session import scratch
from feedloom.suite.registry import Tables, query

# One day before the first day of a year, so that legs of that year become active "tomorrow".
FEED_DATE = "1999-12-31"

_KEYS = """
    l_linenumber as flt_id,
    cast(date_trunc('year', l_shipdate) as date) as sch_leg_active_dt,
    cast(date_trunc('year', l_shipdate) as date) as sch_leg_eff_dt,
    make_date(year(l_shipdate), 12, 31) as sch_leg_disc_dt,
    l_returnflag as sch_leg_orig_cd,
    l_linestatus as sch_leg_dest_cd"""
LEG = f"""select l_partkey as path_id, {_KEYS}, cast(floor(l_quantity / 10) as int) as leg_freq_bitmask,
    case when l_discount >= 0.08 then cast(l_shipdate as date) else date '3001-01-01' end as sch_leg_inactive_dt
    from lineitem"""
SCH = f"""select {_KEYS}, cast(floor(l_quantity / 10) as int) as sch_leg_freq_bitmask,
    cast(l_shipdate as date) as sch_leg_inactive_dt from lineitem"""
PATH = """select p_partkey as path_id, p_name as path_dscr,
    case when p_size > 10 then date '3001-01-01' else date '1996-06-30' end as path_inactive_dt from part"""


def _day() -> Column:
    return F.col("l_shipdate").cast("date")


def _leg_keys() -> list[Column]:
    year = F.trunc(_day(), "year")
    return [
        F.col("l_linenumber").alias("flt_id"),
        year.alias("sch_leg_active_dt"),
        year.alias("sch_leg_eff_dt"),
        F.last_day(F.add_months(year, 11)).alias("sch_leg_disc_dt"),
        F.col("l_returnflag").alias("sch_leg_orig_cd"),
        F.col("l_linestatus").alias("sch_leg_dest_cd"),
    ]


def _bitmask() -> Column:
    return F.floor(F.col("l_quantity") / 10).cast("int")


def legs(t: Tables) -> DataFrame:
    end = F.when(F.col("l_discount") >= 0.08, _day()).otherwise(F.lit(inactivation.OPEN).cast("date"))
    return t.lineitem.select(
        F.col("l_partkey").alias("path_id"),
        *_leg_keys(),
        _bitmask().alias("leg_freq_bitmask"),
        end.alias(inactivation.END),
    )


def schedules(t: Tables) -> DataFrame:
    return t.lineitem.select(*_leg_keys(), _bitmask().alias("sch_leg_freq_bitmask"), _day().alias(inactivation.END))


def paths(t: Tables) -> DataFrame:
    end = F.when(F.col("p_size") > 10, F.lit(inactivation.OPEN)).otherwise(F.lit("1996-06-30"))
    return t.part.select(
        F.col("p_partkey").alias("path_id"), F.col("p_name").alias("path_dscr"), end.cast("date").alias("path_inactive_dt")
    )


_SAME_LEG = " and ".join(f"a.{c} = o.{c}" for c in inactivation.LEG_KEY)
_SAME_SCH = " and ".join(f"f.{s} = p.{c}" for c, s in inactivation.LEG_TO_SCHEDULE.items())
_SCH_KEYS = ", ".join(inactivation.LEG_TO_SCHEDULE.values())
_LEG_KEYS = ", ".join(f"p.{c}" for c in inactivation.LEG_KEY)
_WITH = f"""with leg as ({LEG}), sch as ({SCH}), path as ({PATH}),
    ded as (select * from leg o where not exists (select 1 from leg a where {_SAME_LEG}
        and o.sch_leg_inactive_dt > a.sch_leg_inactive_dt)),
    fsl as (select {_SCH_KEYS}, max(case when sch_leg_active_dt = date '2000-01-01' then date '3001-01-01'
        else sch_leg_inactive_dt end) as last_end from sch where sch_leg_active_dt <= date '2000-01-01'
        group by {_SCH_KEYS}),
    upd as (select {_LEG_KEYS}, case when f.last_end < p.sch_leg_inactive_dt
        and p.sch_leg_inactive_dt = date '3001-01-01' then f.last_end else p.sch_leg_inactive_dt end
        as sch_leg_inactive_dt from ded p left join fsl f on {_SAME_SCH}),
    vip as (select m.path_id, m.minina from (select path_id, min(sch_leg_inactive_dt) as minina from upd
        group by path_id) m join path p on p.path_id = m.path_id
        where p.path_inactive_dt = date '3001-01-01' and m.minina < p.path_inactive_dt)"""


@query(f"{_WITH} select * from ded")
def scd_dedup_delete(t: Tables) -> DataFrame:
    return inactivation.current_legs(legs(t))


@query(f"{_WITH} select * from fsl")
def scd_sched_max(t: Tables) -> DataFrame:
    return inactivation.schedule_ends(schedules(t), FEED_DATE)


def _ends(t: Tables) -> DataFrame:
    return settled(inactivation.schedule_ends(schedules(t), FEED_DATE), "schedule-ends")


@query(f"{_WITH} select * from upd")
def scd_update_from(t: Tables) -> DataFrame:
    return inactivation.close_legs(inactivation.current_legs(legs(t)), _ends(t))


@query(f"{_WITH} select * from vip")
def scd_path_min(t: Tables) -> DataFrame:
    return inactivation.path_end_rows(paths(t), inactivation.path_ends(legs(t), _ends(t)))


@query(
    f"""{_WITH} select p.path_id, p.path_dscr, coalesce(v.minina, p.path_inactive_dt) as path_inactive_dt
    from path p left join vip v on v.path_id = p.path_id"""
)
def scd_path_update(t: Tables) -> DataFrame:
    return inactivation.close_paths(paths(t), inactivation.path_ends(legs(t), _ends(t)))


@query(f"{_WITH} select v.path_id, p.path_dscr from vip v join path p on v.path_id = p.path_id")
def scd_inactivated(t: Tables) -> DataFrame:
    return inactivation.inactivated(legs(t), schedules(t), paths(t), FEED_DATE)


def _staged_columns() -> str:
    """Staged text columns from lineitem: times and a date as text, the others in turn."""
    plain = ["l_returnflag", "l_linestatus", "cast(l_orderkey as varchar(20))", "cast(l_linenumber as varchar(20))"]
    out = []
    for i, name in enumerate(bulk_load.NOTIFICATION_COLUMNS):
        kind = bulk_load.NOTIFICATION_CASTS.get(name)
        if kind == "timestamp":
            source = "cast(l_shipdate as varchar(30))"
        elif kind == "date":
            source = "cast(cast(l_shipdate as date) as varchar(10))"
        else:
            source = plain[i % len(plain)]
        out.append(f"{source} as {name}")
    return ", ".join(out)


_CASTS = ", ".join(
    f"cast({c} as {bulk_load.NOTIFICATION_CASTS[c]}) as {c}" if c in bulk_load.NOTIFICATION_CASTS else c
    for c in bulk_load.NOTIFICATION_COLUMNS
)


@query(f"select {_CASTS} from (select {_staged_columns()} from lineitem) s")
def bulk_load_typed(t: Tables) -> DataFrame:
    staged = t.spark.sql(f"select {_staged_columns()} from {{lineitem}}", lineitem=t.lineitem)
    out = bulk_load.typed(staged)
    times = [c for c, kind in bulk_load.NOTIFICATION_CASTS.items() if kind == "timestamp"]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@query(f"select {_CASTS} from (select {_staged_columns()} from lineitem) s")
def bulk_load_target(t: Tables) -> DataFrame:
    """A prefix loaded into a target, which is read, and its rows inserted by position into a table that was emptied."""
    out = scratch(t.spark, "bulk-load")
    # A file of one row group is read by one task; rows are spread first, or the first write stays on one core at any size.
    lineitem = t.lineitem.hint("rebalance", "l_orderkey", "l_linenumber")
    t.spark.sql(f"select {_staged_columns()} from {{lineitem}}", lineitem=lineitem).write.parquet(f"{out}/prefix")
    bulk_load.load(t.spark, f"{out}/prefix", f"{out}/target")
    loaded = t.spark.read.parquet(f"{out}/target")
    name = f"bulk_load_{uuid.uuid4().hex}"
    loaded.limit(1).write.option("path", f"{out}/table").saveAsTable(name)
    try:
        bulk_load.replace_rows(t.spark, loaded.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(loaded.columns)]), name)
    finally:
        # The table's folder is its own; dropping the name leaves the rows.
        t.spark.sql(f"drop table {name}")
    times = [c for c, kind in bulk_load.NOTIFICATION_CASTS.items() if kind == "timestamp"]
    return t.spark.read.parquet(f"{out}/table").withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


_LEG_TEXT = "concat_ws('|', " + ", ".join(f"cast({c} as varchar(20))" for c in inactivation.LEG_TO_SCHEDULE) + ")"


@query(
    f"""{_WITH} select 'leg' as what, path_id, {_LEG_TEXT} as described, sch_leg_inactive_dt as ends from upd
    union all select 'path', p.path_id, p.path_dscr, coalesce(v.minina, p.path_inactive_dt) from path p left join vip v on v.path_id = p.path_id
    union all select 'end', path_id, null, minina from vip
    union all select 'closed', v.path_id, p.path_dscr, null from vip v join path p on v.path_id = p.path_id"""
)
def scd_published(t: Tables) -> DataFrame:
    """The whole chain over stored tables, and all that it leaves: legs, paths and both lists, from one input state."""
    out = scratch(t.spark, "chain")
    stored = {name: f"{out}/{name}" for name in ("legs", "schedules", "paths", "ends", "closed")}
    for name, df in (("legs", legs(t)), ("schedules", schedules(t)), ("paths", paths(t))):
        df.write.parquet(stored[name])
    inactivation.run(t.spark, *stored.values(), FEED_DATE)
    read = t.spark.read.parquet
    return all_of(read(stored["legs"]), read(stored["paths"]), read(stored["ends"]), read(stored["closed"]))


def all_of(legs: DataFrame, paths: DataFrame, ends: DataFrame, closed: DataFrame) -> DataFrame:
    """All that the chain leaves, as rows of one form."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in inactivation.LEG_TO_SCHEDULE])

    def rows(df: DataFrame, what: str, described: Column, until: Column) -> DataFrame:
        return df.select(F.lit(what).alias("what"), "path_id", described.alias("described"), until.cast("date").alias("ends"))

    text, none, dscr = F.lit(None).cast("string"), F.lit(None), F.col("path_dscr")
    out = rows(legs, "leg", key, F.col(inactivation.END)).union(rows(paths, "path", dscr, F.col("path_inactive_dt")))
    return out.union(rows(ends, "end", text, F.col("minina"))).union(rows(closed, "closed", dscr, none))
