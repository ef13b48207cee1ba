"""Control tables, read out of ``orders``, ``customer`` and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import dates, text
from feedloom.operators import alerts, controls, documents, feeds, gates, ordering, requests, tables
from feedloom.operators.joins import settled
from feedloom.plans import feed_cycle as cycle
from feedloom.sources.jdbc import extract_rows
from feedloom.suite.registry import Tables, query

TODAY = "2024-01-01"

RUN_CONTROL = """select o_orderpriority as domainname, concat(' Load_', cast(o_custkey as varchar(20))) as loadname,
    cast(o_orderdate as date) as run_date, cast(o_orderdate as date) as feed_date from orders"""
CATCHUP = """select o_orderpriority as domainname, concat('Load_', cast(o_custkey as varchar(20))) as loadname,
    cast(o_orderdate as date) as run_date from orders where o_orderstatus = 'P'"""
LOADS = """select '1-URGENT' as domainname, concat('Load_', cast(c_custkey as varchar(20))) as loadname,
    case c_mktsegment when 'BUILDING' then '1_day' when 'AUTOMOBILE' then '1_month' when 'MACHINERY' then '3_month'
    when 'HOUSEHOLD' then 'current' else 'x_day' end as step, c_acctbal from customer"""
EDGES = """select domainname, loadname, '2-HIGH' as dependent_domainname, loadname as dependent_loadname,
    '>=' as operator, 0 as "offset", 'n' as check_self_dependency from loads
    union all
    select domainname, loadname, '3-Medium', loadname, case when c_acctbal < 0 then 'lt' else '>' end, 30, 'n' from loads
    union all
    select domainname, loadname, domainname, loadname, '<=', 2000, 'y' from loads"""
AUDIT = """select o_orderkey as run_id, lower(o_orderpriority) as domainname, o_orderstatus as dag_name,
    concat('load_', cast(o_custkey as varchar(20))) as loadname, cast(date_trunc('month', o_orderdate) as date) as feeddate,
    case o_orderstatus when 'F' then 'completed' when 'O' then 'started' else 'failed' end as status,
    o_orderdate as end_time from orders"""
# Runs of several rows: all orders of a customer in a month are one run.
RUNS = """select o_custkey as run_id, o_orderpriority as dag_name, o_orderstatus as domainname,
    concat('load', o_orderstatus, '::', o_orderpriority) as loadname,
    cast(date_trunc('month', o_orderdate) as date) as feeddate,
    case when o_totalprice < 100000 then 'started' else 'completed' end as status,
    cast(o_orderdate as timestamp) as end_time from orders"""

_FEEDS = f"""feeds as (select lower(trim(domainname)) as domainname, lower(trim(loadname)) as loadname,
    max(feed_date) as feed_date from ({RUN_CONTROL}) r group by 1, 2)"""
_RUN_DATES = f"""rd as (select lower(l.domainname) as domainname, lower(l.loadname) as loadname, l.step, l.c_acctbal,
    coalesce(c.run_date, date '{TODAY}') as run_date from loads l left join (select lower(domainname) as domainname,
    lower(loadname) as loadname, min(run_date) as run_date from ({CATCHUP}) k group by 1, 2) c
    on c.domainname = lower(l.domainname) and c.loadname = lower(l.loadname))"""
_NEXT = """nxt as (select rd.domainname, rd.loadname, rd.run_date, coalesce(case rd.step
    when '1_day' then cast(f.feed_date + 1 as date)
    when '1_month' then cast(f.feed_date + interval 1 month as date)
    when '3_month' then cast(f.feed_date + interval 3 month as date)
    when 'current' then null else f.feed_date end, rd.run_date) as feed_date
    from rd left join feeds f on f.domainname = rd.domainname and f.loadname = rd.loadname)"""
_DEPS = f"""edges as ({EDGES}), dep as (select lower(e.domainname) as domainname, lower(e.loadname) as loadname,
    lower(e.dependent_domainname) as dependent_domainname, e.operator, e."offset" as gap_wanted, e.check_self_dependency,
    coalesce(date_diff('day', own.feed_date, case when e.check_self_dependency = 'y' then __GIVEN__
    else oth.feed_date end), 0) as diff_days
    from edges e left join feeds own on own.domainname = lower(e.domainname) and own.loadname = lower(e.loadname)
    left join feeds oth on oth.domainname = lower(e.dependent_domainname) and oth.loadname = lower(e.dependent_loadname)),
    checked as (select *, case operator when '>=' then diff_days >= gap_wanted when '>' then diff_days > gap_wanted
    when '<=' then diff_days <= gap_wanted else diff_days < gap_wanted end as met from dep)"""
_WITH = f"with loads as ({LOADS}), {_FEEDS}, {_RUN_DATES}, {_NEXT}, {_DEPS}"
_GIVEN = _WITH.replace("__GIVEN__", "date '2000-06-30'")
_PLAIN = _WITH.replace("__GIVEN__", "oth.feed_date")


def _table(t: Tables, sql: str, name: str) -> DataFrame:
    return t.spark.sql(sql.replace(f"from {name}", f"from {{{name}}}"), **{name: getattr(t, name)})


def loads(t: Tables) -> DataFrame:
    return _table(t, LOADS, "customer")


def edges(t: Tables) -> DataFrame:
    return t.spark.sql(EDGES.replace("from loads", "from {loads}").replace('"', "`"), loads=loads(t))


def latest_feeds(t: Tables) -> DataFrame:
    return feeds.max_feed_date(_table(t, RUN_CONTROL, "orders"))


@query(f"with {_FEEDS} select * from feeds")
def max_feed_date(t: Tables) -> DataFrame:
    return latest_feeds(t)


@query(
    """select lower(event_type) as domainname, cast(user_id as varchar(20)) as loadname,
    max(ts) as start_timestamp from events group by 1, 2"""
)
def max_control_value(t: Tables) -> DataFrame:
    control = t.events.select(
        F.col("event_type").alias("domainname"),
        F.col("user_id").cast("string").alias("loadname"),
        F.col("ts").alias("start_timestamp"),
    )
    return feeds.max_control_value(control, "start_timestamp")


@query(f"{_PLAIN} select domainname, loadname, run_date from rd")
def catchup_run_date(t: Tables) -> DataFrame:
    return feeds.run_dates(loads(t), _table(t, CATCHUP, "orders"), TODAY).select("domainname", "loadname", "run_date")


@query(f"{_PLAIN} select domainname, loadname, run_date, feed_date from nxt")
def feed_date_next(t: Tables) -> DataFrame:
    dated = feeds.run_dates(loads(t), _table(t, CATCHUP, "orders"), TODAY)
    out = feeds.next_feed_dates(dated, latest_feeds(t), F.col("step"))
    return out.select("domainname", "loadname", "run_date", "feed_date")


@query(
    """select o_orderkey, cast(last_day(cast(last_day(o_orderdate) + interval 1 month as date)) as date) as next_month_end,
    cast(cast(o_orderdate as date) + interval 1 month as date) as next_month from orders"""
)
def feed_date_month_end(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        dates.step_date(F.last_day(day), "1_month", month_end=True).alias("next_month_end"),
        dates.step_date(day, "1_month").alias("next_month"),
    )


@query(
    f"""{_PLAIN} select lower(l.loadname) as from_load, coalesce(date_diff('day', a.feed_date, b.feed_date), 0) as gap_days,
    coalesce(date_diff('day', a.feed_date, b.feed_date), 0) >= 3 as met from loads l
    left join feeds a on a.domainname = '1-urgent' and a.loadname = lower(l.loadname)
    left join feeds b on b.domainname = '5-low' and b.loadname = lower(l.loadname)"""
)
def feed_date_gap(t: Tables) -> DataFrame:
    load = F.lower("loadname")
    pairs = loads(t).select(
        F.lit("1-urgent").alias("from_domain"),
        load.alias("from_load"),
        F.lit("5-low").alias("to_domain"),
        load.alias("to_load"),
    )
    out = feeds.feed_date_gaps(pairs, latest_feeds(t), 3)
    return out.select("from_load", F.col("gap_days").cast("long").alias("gap_days"), "met")


@query(f"{_GIVEN} select domainname, loadname, dependent_domainname, diff_days, met from checked")
def dependency_check(t: Tables) -> DataFrame:
    out = feeds.dependencies(edges(t), settled(latest_feeds(t), "latest-feeds"), given=F.lit("2000-06-30"))
    return out.select(
        "domainname", "loadname", "dependent_domainname", F.col("diff_days").cast("long").alias("diff_days"), "met"
    )


@query(f"{_GIVEN} select domainname, loadname, bool_and(met) as ready from checked group by 1, 2")
def dep_all_met(t: Tables) -> DataFrame:
    latest = settled(latest_feeds(t), "latest-feeds")
    return feeds.ready_loads(feeds.dependencies(edges(t), latest, given=F.lit("2000-06-30")))


@query(
    f"""{_PLAIN} select n.domainname, n.loadname, n.run_date, n.feed_date, r.ready,
    case when r.ready then 'ok' else 'dependency not met' end as reason from nxt n
    join (select domainname, loadname, bool_and(met) as ready from checked group by 1, 2) r
    on r.domainname = n.domainname and r.loadname = n.loadname"""
)
def feed_cycle(t: Tables) -> DataFrame:
    run_control, catchup = _table(t, RUN_CONTROL, "orders"), _table(t, CATCHUP, "orders")
    out = cycle.plan_cycle(loads(t), run_control, catchup, edges(t), TODAY, F.col("step"))
    return out.select("domainname", "loadname", "run_date", "feed_date", "ready", "reason")


@query(
    f"""with c as (select distinct domainname, loadname, run_date from ({CATCHUP}) k)
    select 'catchup' as kind, domainname, loadname, run_date, cast(null as date) as feed_date from c where not exists (
    select 1 from ({RUN_CONTROL}) r where r.domainname = c.domainname and trim(r.loadname) = c.loadname and r.run_date = c.run_date + 1)
    union all select 'control', domainname, loadname, run_date, feed_date from ({RUN_CONTROL}) r
    union all select 'control', domainname, trim(loadname), run_date - 1, feed_date from ({RUN_CONTROL}) r"""
)
def catchup_cleared(t: Tables) -> DataFrame:
    run_control, catchup = _table(t, RUN_CONTROL, "orders"), _table(t, CATCHUP, "orders")
    done = run_control.select(
        "domainname", F.trim("loadname").alias("loadname"), F.date_add("run_date", -1).alias("run_date"), "feed_date"
    )
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    before = run_control.select("domainname", "loadname", "run_date", "feed_date", now.alias("insert_timestamp"))
    control, left = cycle.record_cycle(before, catchup.distinct(), done, now)
    columns = ["kind", "domainname", "loadname", "run_date", "feed_date"]
    left = left.select(F.lit("catchup").alias("kind"), "domainname", "loadname", "run_date", F.lit(None).cast("date").alias("feed_date"))
    return left.union(control.withColumn("kind", F.lit("control")).select(*columns))


_AUDIT = f"audit as ({AUDIT})"
_ASKED = "asked as (select '1-urgent' as domainname, concat('load_', cast(c_custkey as varchar(20))) as loadname from customer)"


def _asked(t: Tables) -> DataFrame:
    return t.customer.select(
        F.lit("1-urgent").alias("domainname"), F.concat(F.lit("load_"), F.col("c_custkey").cast("string")).alias("loadname")
    )


@query(
    f"""with {_AUDIT}, {_ASKED} select q.domainname, q.loadname, case when coalesce(n.n, 0) > 0 then 'skip' else 'next' end
    as branch from asked q left join (select domainname, loadname, count(*) as n from audit
    where status in ('started', 'failed') group by 1, 2) n on n.domainname = q.domainname and n.loadname = q.loadname"""
)
def status_gate(t: Tables) -> DataFrame:
    return gates.status_gate(_asked(t), _table(t, AUDIT, "orders"), "skip", "next", ("started", "failed"))


@query(
    f"""with {_AUDIT}, {_ASKED} select q.domainname, q.loadname, case when exists (select 1 from audit a
    where a.domainname = q.domainname and a.loadname = q.loadname and a.status in ('started', 'failed')
    and a.run_id = (select max(x.run_id) from audit x where x.domainname = q.domainname and x.loadname = q.loadname))
    then 'skip' else 'next' end as branch from asked q"""
)
def latest_run_status(t: Tables) -> DataFrame:
    audit = _table(t, AUDIT, "orders")
    return gates.status_gate(_asked(t), audit, "skip", "next", ("started", "failed"), last_run=True)


@query(
    f"""with {_AUDIT}, q as (select distinct a.domainname, p.load_text from audit a
    cross join (values ('load_1'), ('7'), ('99'), ('zzz')) p(load_text)),
    m as (select q.domainname, q.load_text, a.run_id, a.status from q
    left join audit a on a.domainname = q.domainname and contains(a.loadname, q.load_text)),
    z as (select domainname, load_text, max(run_id) as run_id from m group by 1, 2)
    select m.domainname, m.load_text, case when count(case when m.status = 'started' then 1 end) > 0
    then 'skip' else 'next' end as branch from m join z on z.domainname = m.domainname and z.load_text = m.load_text
    and z.run_id is not distinct from m.run_id group by 1, 2"""
)
def status_gate_like(t: Tables) -> DataFrame:
    audit = _table(t, AUDIT, "orders")
    domains = audit.select("domainname").distinct()
    return gates.status_gate_like(domains, audit, ["load_1", "7", "99", "zzz"], "skip", "next", last_run=True)


@query(
    f"""with {_AUDIT}, q as (select case when c_acctbal < 0 then '1-urgent' else '3-medium' end as domainname,
    concat('_', cast(c_custkey as varchar(20))) as load_text from customer union all select '2-high', 'zzz'),
    m as (select q.domainname, q.load_text, a.run_id, a.status from q
    left join audit a on a.domainname = q.domainname and contains(a.loadname, q.load_text)),
    z as (select domainname, load_text, max(run_id) as run_id from m group by 1, 2)
    select m.domainname, m.load_text, case when count(case when m.status = 'started' then 1 end) > 0
    then 'skip' else 'next' end as branch from m join z on z.domainname = m.domainname and z.load_text = m.load_text
    and z.run_id is not distinct from m.run_id group by 1, 2"""
)
def status_gate_requests(t: Tables) -> DataFrame:
    """A request for each customer: whether the last run of the loads whose name contains a text is busy."""
    domain = F.when(F.col("c_acctbal") < 0, "1-urgent").otherwise("3-medium").alias("domainname")
    asked = t.customer.select(domain, F.concat(F.lit("_"), F.col("c_custkey").cast("string")).alias("load_text"))
    asked = asked.union(t.spark.createDataFrame([("2-high", "zzz")], "d string, l string"))
    return requests.status_gate_for(asked, _table(t, AUDIT, "orders"), "skip", "next", last_run=True)


@query(
    """select o_orderkey, case when left(o_orderpriority, 1) = cast(o_custkey % 5 + 1 as varchar(1)) then 'next' else 'skip' end as branch
    from orders"""
)
def equality_gate(t: Tables) -> DataFrame:
    """Whether the file that comes next is the one that moves the feed date."""
    moves = (F.col("o_custkey") % 5 + 1).cast("string")
    return t.orders.select("o_orderkey", gates.equality_gate(F.left("o_orderpriority", F.lit(1)), moves, "next", "skip").alias("branch"))


@query(
    f"""with {_AUDIT} select domainname, loadname, feeddate as feed_date, count(case when status = 'completed' then 1 end)
    as completed, case when count(case when status = 'completed' then 1 end) = 1 then 'next' else 'skip' end as branch
    from audit group by 1, 2, 3"""
)
def count_gate(t: Tables) -> DataFrame:
    audit = _table(t, AUDIT, "orders")
    asked = audit.select("domainname", "loadname", F.col("feeddate").alias("feed_date")).distinct()
    out = gates.count_gate(asked.withColumn("expected_count", F.lit(1)), audit, "next", "skip")
    return out.drop("expected_count")


_RUNS = f"runs as ({RUNS})"
_STEPS = """steps(domain_name, load_name, "current", "next") as (values
    ('F', 'load', '1-URGENT', '2-HIGH'), ('F', 'load', '2-HIGH', '3-MEDIUM'), ('F', 'load', '3-MEDIUM', '4-NOT SPECIFIED'),
    ('O', 'load', '1-URGENT', '5-LOW'), ('O', 'load', '5-LOW', '1-URGENT'), ('P', 'load', '4-NOT SPECIFIED', '1-URGENT'), ('F', 'loadF', '1-URGENT', '5-LOW'),
    ('F', 'loadF', '2-HIGH', '1-URGENT'))"""


@query(
    f"""with {_RUNS}, {_STEPS},
    asked as (select distinct domainname, feeddate, dag_name, asks from runs cross join (values ('load'), ('loadF')) a(asks)),
    top as (select q.domainname, q.feeddate, q.dag_name, q.asks, max(r.run_id) as run_id from asked q left join runs r
        on r.domainname = q.domainname and r.feeddate = q.feeddate and r.status = 'completed' and starts_with(r.loadname, q.asks)
        group by 1, 2, 3, 4),
    cur as (select m.domainname, m.feeddate, m.dag_name, m.asks, r.loadname, row_number() over (
        partition by m.domainname, m.feeddate, m.dag_name, m.asks order by r.end_time desc nulls first, r.loadname desc) as rn
        from top m left join runs r on r.run_id = m.run_id and lower(r.dag_name) = lower(m.dag_name))
    select c.domainname as domain_name, c.asks as load_name, c.feeddate as feed_date, c.dag_name,
    case when c.loadname is null then 'first' else s."next" end as next_file
    from cur c left join steps s on s.domain_name = c.domainname and s.load_name = c.asks and s."current" = split_part(c.loadname, '::', 2)
    where c.rn = 1"""
)
def latest_run_next_file(t: Tables) -> DataFrame:
    runs = _table(t, RUNS, "orders")
    sequence = t.spark.sql(f"with {_STEPS} select * from steps".replace('"', "`"))
    asked = runs.select(
        F.col("domainname").alias("domain_name"),
        F.explode(F.array(F.lit("load"), F.lit("loadF"))).alias("load_name"),
        F.col("feeddate").alias("feed_date"),
        "dag_name",
        F.lit("first").alias("default_file"),
    ).distinct()
    return feeds.next_file(runs, sequence, asked)


@query(
    """select c.c_custkey as feed_id, coalesce(h.s, 0) + 1 as sequence_no from customer c left join (
    select o_custkey, max(o_orderkey) as s from orders where o_orderstatus = 'F' group by 1) h on h.o_custkey = c.c_custkey"""
)
def meta_sequence(t: Tables) -> DataFrame:
    history = t.orders.select(
        F.col("o_custkey").alias("feed_id"),
        F.col("o_orderkey").cast("string").alias("file_sequence_no"),
        F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").otherwise("FAILED").alias("job_status"),
    )
    return controls.next_sequence(t.customer.select(F.col("c_custkey").alias("feed_id")), history)


@query(
    """select key_name, case when length(k) < 8 then lpad(k, 8, '0') else k end as sys_key_val from (
    select cast(c.c_custkey as varchar(20)) as key_name, cast(coalesce(max(e.event_id) + 10, 0) as varchar(20)) as k
    from customer c left join events e on e.user_id = c.c_custkey group by 1) x"""
)
def sys_key_next(t: Tables) -> DataFrame:
    names = t.customer.select(F.col("c_custkey").cast("string").alias("key_name"))
    keys = t.events.select(
        F.col("user_id").cast("string").alias("key_name"), F.col("event_id").cast("string").alias("last_val")
    )
    return controls.next_system_key(names, keys, step=10, width=8)


@query(
    """select o_orderkey, case o_orderstatus when 'F' then 'archive' when 'O' then 'run' when 'P' then 'wait' end as branch
    from orders"""
)
def branch_map(t: Tables) -> DataFrame:
    branches = {"F": "archive", "O": "run", "P": "wait"}
    return t.orders.select("o_orderkey", gates.branch_by(F.col("o_orderstatus"), branches).alias("branch"))


@query(
    """select o_orderkey, case when cast(o_orderdate as date) >= date '1998-06-01' then 'ok' else 'fail' end as branch
    from orders"""
)
def date_gate(t: Tables) -> DataFrame:
    gate = gates.date_gate(F.col("o_orderdate"), F.lit("1998-06-01"), "ok", "fail")
    return t.orders.select("o_orderkey", gate.alias("branch"))


@query(
    """select event_id, case when cast(json_extract_string(props, '$.k') as int) >= 1 then 'new' else 'none' end as branch
    from events"""
)
def json_count_gate(t: Tables) -> DataFrame:
    return t.events.select("event_id", gates.json_count_gate(F.col("props"), "new", "none", "$.k").alias("branch"))


_CONFIG = """select concat('Dag_', cast(c_custkey as varchar(20))) as dag_id, case c_mktsegment when 'BUILDING' then 'View,Click'
    when 'MACHINERY' then 'ERROR' else 'purchase,view' end as task_id_list,
    case when c_acctbal < 5000 then 'y' else 'n' end as skip_alert from customer"""


@query(
    f"""select e.event_id, case when exists (select 1 from ({_CONFIG}) c where lower(c.dag_id) = concat('dag_', cast(e.user_id
    as varchar(20))) and contains(lower(c.task_id_list), lower(e.event_type)) and upper(c.skip_alert) = 'Y')
    then 'skip' else 'send' end as alert from events e"""
)
def alert_config(t: Tables) -> DataFrame:
    failures = t.events.select(
        "event_id",
        F.concat(F.lit("DAG_"), F.col("user_id").cast("string")).alias("dag_id"),
        F.upper("event_type").alias("task_id"),
    )
    return alerts.alert_branch(failures, _table(t, _CONFIG, "customer")).select("event_id", "alert")


@query(
    """select o_orderkey, o_orderpriority = '1-URGENT' and ((o_orderstatus = 'O' and o_totalprice > 250000)
    or o_orderstatus = 'F') as skipped from orders"""
)
def alert_rule(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    task = F.when(status == "O", "ESFTP_to_S3_x").when(status == "F", "Check_Load_Ready_To_Start").otherwise("copy")
    error = F.when(F.col("o_totalprice") > 250000, "raised AirflowSensorTimeout here").otherwise("raised here")
    skipped = text.suppressed_alert(F.col("o_orderpriority"), task, F.lit("PythonOperator"), error, "urgent")
    return t.orders.select("o_orderkey", skipped.alias("skipped"))


@query("select count(*) as n from documents where contains(lower(text), 'the')")
def like_count(t: Tables) -> DataFrame:
    return alerts.count_matching(t.documents, "text", "The")


@query(
    """select c_nationkey, cast(floor(c_custkey / 500) as bigint) as part, string_agg(c_name, ',' order by c_name) as recipients
    from customer group by 1, 2"""
)
def list_agg(t: Tables) -> DataFrame:
    part = F.floor(F.col("c_custkey") / 500)
    return documents.joined_list(t.customer, ["c_nationkey"], "c_name", part, "recipients")


_CHICAGO = "timezone('America/Chicago', timezone('UTC', {}))"


def _local(ts: str) -> str:
    return f"strftime({_CHICAGO.format(ts)}, '%Y-%m-%d %H:%M:%S')"


@query(
    f"""select dag_id, part, cast(to_json(list({{'dag_id': dag_id, 'operator': 'spark', 'task_id': event_type,
    'start_date': start_date, 'end_date': end_date, 'job_id': event_id, 'try_number': 1, 'duration': user_id,
    'state': event_type, 'dag_run_id': run, 'execution_date': start_date}} order by event_type, start_date, end_date, event_id))
    as varchar) as records from (select cast(user_id as varchar(20)) as dag_id, event_type, event_id, user_id,
    cast(floor(event_id / 1000) as bigint) as part, {_local("ts")} as start_date,
    case when value < 10 then '0001-01-01 00:00:00' else {_local("ts + interval 90 minutes")} end as end_date,
    cast(epoch_us(ts) // 1000 as varchar) as run from events where event_type <> 'error') e group by 1, 2"""
)
def audit_json(t: Tables) -> DataFrame:
    ts = F.col("ts")
    tasks = t.events.select(
        F.col("user_id").cast("string").alias("dag_id"),
        F.lit("spark").alias("operator"),
        F.col("event_type").alias("task_id"),
        ts.alias("start_date"),
        F.when(F.col("value") >= 10, ts + F.expr("interval 90 minutes")).alias("end_date"),
        F.col("event_id").alias("job_id"),
        F.lit(1).alias("try_number"),
        F.col("user_id").alias("duration"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("state"),
        ts.alias("execution_date"),
    )
    return documents.audit_records(tasks, F.floor(F.col("job_id") / 1000))


@query(
    """select source, doc_id, running_size, running_size > 20000 as over_cap from (select source, doc_id,
    cast(sum(n_chars) over (partition by source order by doc_id rows between unbounded preceding and current row)
    as bigint) as running_size from documents) x"""
)
def running_cap(t: Tables) -> DataFrame:
    rows = t.documents.select("source", "doc_id", "n_chars")
    out = ordering.over_cap(rows, ["source"], ["doc_id"], "n_chars", 20_000, F.floor(F.col("doc_id") / 1024))
    return out.drop("n_chars")


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_extendedprice, l_orderkey, l_linenumber")
def global_sort(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ordering.global_sort(rows, ["l_extendedprice"], ties=["l_orderkey", "l_linenumber"])


@query("select * from orders where o_orderdate > timestamp '2001-01-01 00:00:00'")
def incremental_filter(t: Tables) -> DataFrame:
    return extract_rows(t.orders, condition="o_orderdate > timestamp_ntz '2001-01-01 00:00:00'")


@query(
    """select c_custkey as k, c_name as name from customer union all
    select s_suppkey, s_name from supplier where s_acctbal >= 0"""
)
def control_append(t: Tables) -> DataFrame:
    table = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    name = F.when(F.col("s_acctbal") >= 0, F.col("s_name"))
    return tables.append_rows(table, t.supplier.select(F.col("s_suppkey").alias("k"), name.alias("name")), ["k", "name"])


@query(
    """select o.* from orders o where not exists (
    select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_quantity > 45)"""
)
def delete_by_keys(t: Tables) -> DataFrame:
    listed = t.lineitem.where(F.col("l_quantity") > 45)
    return tables.delete_by_keys(t.orders, listed, {"o_orderkey": "l_orderkey"})


@query(
    """with t as (select c_mktsegment as domainname, cast(c_custkey as varchar(20)) as loadname, date '1990-01-01' as run_date,
        date '1990-01-01' as feed_date, timestamp '1990-01-02 00:00:00' as insert_timestamp,
        timestamp '1990-01-01 00:00:00' as start_timestamp from customer),
    u as (select 'BUILDING' as domainname, cast(o_custkey as varchar(20)) as loadname, cast(o_orderdate as date) as run_date,
        o_orderdate as start_timestamp, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders)
    select coalesce(t.domainname, u.domainname) as domainname, coalesce(t.loadname, u.loadname) as loadname,
    coalesce(u.run_date, t.run_date) as run_date, coalesce(u.run_date, t.feed_date) as feed_date,
    coalesce(t.insert_timestamp, timestamp '2024-01-01 00:00:00') as insert_timestamp,
    coalesce(u.start_timestamp, t.start_timestamp) as start_timestamp,
    case when t.loadname is not null and u.loadname is not null then timestamp '2024-01-01 00:00:00' end as update_timestamp
    from t full outer join (select * from u where rn = 1) u on u.domainname = t.domainname and u.loadname = t.loadname"""
)
def control_upsert(t: Tables) -> DataFrame:
    day, time = F.lit("1990-01-01").cast("date"), "timestamp_ntz"
    table = t.customer.select(
        F.col("c_mktsegment").alias("domainname"),
        F.col("c_custkey").cast("string").alias("loadname"),
        day.alias("run_date"),
        day.alias("feed_date"),
        F.lit("1990-01-02").cast(time).alias("insert_timestamp"),
        F.lit("1990-01-01").cast(time).alias("start_timestamp"),
        F.lit(None).cast(time).alias("update_timestamp"),
    )
    day = F.col("o_orderdate").cast("date")
    rows = t.orders.select(
        F.lit("BUILDING").alias("domainname"),
        F.col("o_custkey").cast("string").alias("loadname"),
        day.alias("run_date"),
        day.alias("feed_date"),
        F.col("o_orderdate").alias("start_timestamp"),
        "o_orderkey",
    )
    now = F.lit("2024-01-01").cast(time)
    return tables.upsert(table, rows, ["domainname", "loadname"], tables.JOB_CONTROL_UPDATES, now, "o_orderkey")


@query(
    """with t as (select cast(c_custkey * 2 as varchar(20)) as loadname from customer),
    u as (select cast(user_id as varchar(20)) as loadname, max(case when value > 60 then ts end) as start_timestamp
        from events group by 1 having max(case when value > 60 then ts end) is not null)
    select 'events' as domainname, coalesce(t.loadname, u.loadname) as loadname,
    case when u.loadname is null then date '1990-01-01' else date '2024-02-01' end as run_date,
    case when u.loadname is null then date '1990-01-01' else date '2024-01-31' end as feed_date,
    case when t.loadname is null then timestamp '2024-02-01 00:00:00' else timestamp '1990-01-02 00:00:00' end
    as insert_timestamp, u.start_timestamp,
    case when t.loadname is not null and u.loadname is not null then timestamp '2024-02-01 00:00:00' end as update_timestamp
    from t full outer join u on u.loadname = t.loadname"""
)
def watermark_upsert(t: Tables) -> DataFrame:
    day, time = F.lit("1990-01-01").cast("date"), "timestamp_ntz"
    control = t.customer.select(
        F.lit("events").alias("domainname"),
        (F.col("c_custkey") * 2).cast("string").alias("loadname"),
        day.alias("run_date"),
        day.alias("feed_date"),
        F.lit("1990-01-02").cast(time).alias("insert_timestamp"),
        F.lit(None).cast(time).alias("start_timestamp"),
        F.lit(None).cast(time).alias("update_timestamp"),
    )
    marks = t.events.groupBy(F.lit("events").alias("domainname"), F.col("user_id").cast("string").alias("loadname")).agg(
        F.max(F.when(F.col("value") > 60, F.col("ts"))).alias("start_timestamp")
    )
    marks = marks.withColumn("run_date", F.lit("2024-02-01").cast("date")).withColumn("feed_date", F.date_add("run_date", -1))
    return tables.upsert_watermarks(control, marks, F.lit("2024-02-01").cast(time))
