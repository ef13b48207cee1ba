"""File manifests, names and texts, read out of ``pages``, ``documents``, ``orders`` and ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import dates, names, text
from feedloom.operators import filesets, requests
from feedloom.operators.gates import branch
from feedloom.operators.joins import settled
from feedloom.session import scratch
from feedloom.sinks.datasets import max_watermark as top_value
from feedloom.suite.registry import Tables, query

_HOST = "regexp_extract(url, '^[^/]*//([^/]*)', 1)"
_KEY = "regexp_extract(url, '^[^/]*//[^/]*/(.*)$', 1)"


def listing(t: Tables) -> DataFrame:
    """Pages as a manifest."""
    return t.pages.select("page_id", F.col("url").alias("path"), F.length("html").cast("long").alias("length"))


def host() -> Column:
    return names.bucket(F.col("path"))


@query(
    """select page_id, url as path from pages where url like 'https%' and not contains(url, '#') and length(html) > 0
    and not url like '%/' and regexp_matches(url, '/en/[0-9]+')"""
)
def manifest_select(t: Tables) -> DataFrame:
    files = filesets.select_files(listing(t), prefix="https", pattern="/en/[0-9]+", excludes="#", non_empty=True)
    return files.select("page_id", "path")


@query(
    f"""select {_HOST} as folder, count(case when not url like '%/' then 1 end) as n,
    count(case when not url like '%/' then 1 end) > 1 as too_many from pages group by 1
    union all select 'nothing.example.com', 0, false"""
)
def manifest_count_gate(t: Tables) -> DataFrame:
    files = listing(t)
    nothing = t.spark.createDataFrame([("nothing.example.com",)], "folder string")
    return filesets.object_counts(files.select(host().alias("folder")).distinct().union(nothing), files, host())


@query("select o_orderkey, 'in/' || strftime(o_orderdate, '%Y-%m-%d') || '/f.csv' as path from orders where year(o_orderdate) = 1996 and month(o_orderdate) = 2")
def run_date_folder(t: Tables) -> DataFrame:
    """Files in the folders of one month's run dates, all dates in one pass."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    files = t.orders.select("o_orderkey", F.concat(F.lit("in/"), day, F.lit("/f.csv")).alias("path"))
    dates = t.spark.sql("select explode(sequence(date'1996-02-01', date'1996-02-29')) as run_date")
    return filesets.on_run_dates(filesets.select_files(files, prefix="in/", suffix=".csv"), dates).select("o_orderkey", "path")


@query("""select o_orderkey, o_totalprice, cast(date_trunc('month', o_orderdate) as date) as run_date from orders
    where date_trunc('month', o_orderdate) in (select date_trunc('month', c) from (select max(o_orderdate) as c from orders
    group by o_orderpriority union all select min(o_orderdate) from orders group by o_orderpriority))""")
def run_date_partitions(t: Tables) -> DataFrame:
    """A table laid out by run date, read for the dates that another table asks for."""
    path = scratch(t.spark, "by-run-date")
    month = F.trunc("o_orderdate", "month").alias("run_date")
    t.orders.select("o_orderkey", "o_totalprice", month).repartition("run_date").write.partitionBy("run_date").parquet(path)
    ends = t.orders.groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    each = ends.select(F.explode(F.array("low", "high")).alias("day"))
    dates = settled(each.select(F.trunc("day", "month").alias("run_date")).distinct(), "asked-dates")
    return filesets.of_run_dates(t.spark.read.parquet(path), dates).select("o_orderkey", "o_totalprice", "run_date")


_REQUESTS = """select 'h' || host as request_id, 'https://' || host || '/' as prefix, null as suffix, null as contains from hosts
    union all select 's' || last, null, '/' || last, null from lasts
    union all select 'c' || last, 'http', null, '/en/' || last from lasts
    union all select 'none', null, null, 'no such text'"""


@query(
    f"""with hosts as (select distinct {_HOST} as host from pages),
    lasts as (select distinct regexp_extract(url, '([^/]*)$', 1) as last from pages where regexp_extract(url, '([^/]*)$', 1) <> ''),
    r as ({_REQUESTS})
    select request_id, page_id, url as path from pages, r where (prefix is null or (starts_with(url, prefix) and url <> prefix))
    and (suffix is null or ends_with(url, suffix)) and (contains is null or contains(url, contains))
    and length(html) > 0 and not ends_with(url, '/')"""
)
def request_select(t: Tables) -> DataFrame:
    """Files for a request per host, per last part of a path at the end, and per last part within: thousands in one pass."""
    files = listing(t)
    hosts = files.select(host().alias("host")).distinct()
    lasts = files.select(F.substring_index("path", "/", -1).alias("last")).where("last <> ''").distinct()
    asked = t.spark.sql(_REQUESTS.replace("from hosts", "from {hosts}").replace("from lasts", "from {lasts}"), hosts=hosts, lasts=lasts)
    return requests.select_for(files, asked.withColumn("non_empty", F.lit(True))).select("request_id", "page_id", "path")


@query(
    f"""select {_HOST} as folder, case when count(case when contains(url, 'page=') and length(html) > 0 then 1 end) >= 1
    then 'load' else 'wait' end as branch from pages group by 1"""
)
def presence_gate(t: Tables) -> DataFrame:
    files = listing(t)
    folders = files.select(host().alias("folder")).distinct()
    return filesets.presence_gate(folders, filesets.select_files(files, contains="page="), host(), "load", "wait")


@query(
    f"""select folder, suffix, path from (select folder, suffix, path, max(suffix) over (partition by folder) as newest from (
    select {_HOST} as folder, regexp_extract(url, '([^/]*)$', 1) as suffix, max(url) as path from pages
    group by 1, 2) x) y where suffix < newest"""
)
def keep_latest(t: Tables) -> DataFrame:
    return filesets.superseded(listing(t), host(), F.substring_index("path", "/", -1))


@query(
    f"""select folder, suffix, path from (select {_HOST} as folder, regexp_extract(url, '([^/]*)$', 1) as suffix, url as path,
    row_number() over (partition by {_HOST} order by regexp_extract(url, '([^/]*)$', 1) desc, url desc) as rn from pages) x
    where rn = 1"""
)
def latest_file(t: Tables) -> DataFrame:
    return filesets.latest(listing(t), host(), F.substring_index("path", "/", -1))


@query(
    f"""select folder, path from (select {_HOST} as folder, url as path,
    row_number() over (partition by {_HOST} order by url) as rn from pages) x where rn = 2"""
)
def nth_file(t: Tables) -> DataFrame:
    return filesets.nth_file(listing(t), host(), 1)


_FAR = "concat(cast(l_orderkey as varchar(20)), '/', cast(l_linenumber as varchar(20)))"


@query(
    f"""select l_returnflag as folder, path from (select l_returnflag, {_FAR} as path,
    row_number() over (partition by l_returnflag order by {_FAR}) as rn from lineitem) x where rn = 1401"""
)
def nth_file_far(t: Tables) -> DataFrame:
    """A place far on in each folder, found by counts of ranges."""
    files = t.lineitem.select("l_returnflag", F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("path"))
    return filesets.nth_file(files, F.col("l_returnflag"), 1400)


@query(
    f"""select page_id, concat('exp_20240101', case when n = 1 then '' else concat('_', cast(rn as varchar(9))) end, '.txt')
    as new_name from (select page_id, row_number() over (partition by {_HOST} order by {_KEY}, page_id) as rn,
    count(*) over (partition by {_HOST}) as n from pages) x"""
)
def numbered_exports(t: Tables) -> DataFrame:
    files = t.pages.select("page_id", names.bucket(F.col("url")).alias("host"), names.key(F.col("url")).alias("key"))
    order = ["key", "page_id"]
    out = filesets.numbered_names(files, F.col("host"), order, "exp_", F.lit("20240101"), "txt")
    return out.select("page_id", "new_name")


_LISTINGS = """select user_id, cast(ts as date) as day, max(cast(floor(coalesce(value, -1) / 40) as int)) as mark from events group by 1, 2"""


@query(
    f"""with h as ({_LISTINGS}), t as (select day, dense_rank() over (order by day) as k from (select distinct day from h)),
    r as (select h.*, k, k - row_number() over (partition by user_id, mark order by k) as run from h join t on t.day = h.day)
    select user_id, mark, min(day) as first_at, max(day) as last_at, count(*) as n_listings, max(k) = (select max(k) from t) as is_last
    from r group by user_id, mark, run"""
)
def unchanged_runs(t: Tables) -> DataFrame:
    """A history of daily listings, a file for each user: runs of days in which it was listed with one mark."""
    mark = F.floor(F.coalesce("value", F.lit(-1.0)) / 40).cast("int")
    listed = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.max(mark).alias("mark"))
    return filesets.unchanged_runs(listed, "user_id", "mark", "day", chunk=16)


_NEWER = """select e.event_type as domain_name, cast(e.user_id as varchar(20)) as load_name,
    concat('f_', cast(event_id as varchar(20))) as file_name, ts as file_mod_time, value from events e"""


def _picked(first: str) -> str:
    return f"""with f as ({_NEWER}), l as (select domain_name, load_name, file_mod_time as last_time, file_name as last_name
        from (select *, row_number() over (partition by domain_name, load_name order by file_mod_time desc, file_name desc) as rn
        from f where value > 40) x where rn = 1)
        select domain_name, load_name, file_name, file_mod_time from (select f.*, row_number() over (
        partition by f.domain_name, f.load_name order by f.file_mod_time {first}, f.file_name {first}) as rn
        from f left join l on l.domain_name = f.domain_name and l.load_name = f.load_name
        where f.file_mod_time > coalesce(l.last_time, timestamp '1900-05-30 09:59:43')
        and f.file_name is distinct from l.last_name) y where rn = 1"""


def _pick(t: Tables, selection: str) -> DataFrame:
    files = t.spark.sql(_NEWER.replace("from events", "from {events}"), events=t.events)
    last = settled(filesets.last_processed(files.withColumn("is_sensed", F.col("value") > 40)), "last-processed")
    return filesets.pick_newer(files, last, ["domain_name", "load_name"], selection, "FILENAME")


@query(_picked("asc"))
def pick_newer(t: Tables) -> DataFrame:
    return _pick(t, "NEWER_OLDEST")


@query(_picked("desc"))
def pick_newer_latest(t: Tables) -> DataFrame:
    return _pick(t, "NEWER_LATEST")


@query("select page_id, url as path, length(html) as length from pages where not contains(url, '?')")
def stable_files(t: Tables) -> DataFrame:
    before = listing(t)
    grown = F.col("length") + F.contains("path", F.lit("?")).cast("int")
    return filesets.stable_files(before, before.withColumn("length", grown), "page_id", "length")


@query(
    f"""select page_id, {_HOST} as bucket, {_KEY} as key, split_part(regexp_extract(url, '([^/]*)$', 1), '.', 1) as base,
    concat('dst/', split_part(url, '://', 2)) as dest, concat('dst/', regexp_replace(url, '^.*/en/', '')) as after_load,
    case when url like '%/' then url else concat(url, '/') end as folder,
    case when url like '%/' then 'out/' else concat('out/', split_part(regexp_extract(url, '([^/]*)$', 1), '.', 1), '/') end
    as unpacked from pages"""
)
def path_parts(t: Tables) -> DataFrame:
    path = F.col("path")
    return listing(t).select(
        "page_id",
        names.bucket(path).alias("bucket"),
        names.key(path).alias("key"),
        names.base_name(path).alias("base"),
        names.relocated(path, "://", "dst/").alias("dest"),
        names.after_load(path, "en", "dst/").alias("after_load"),
        names.folder(path).alias("folder"),
        names.unpacked_folder("/out", path, own_folder=True).alias("unpacked"),
    )


@query(
    """select * from (select page_id, url as path, regexp_replace(url, '[?=&#]', ' ', 'g') as clean from pages) x
    where path <> clean"""
)
def path_clean(t: Tables) -> DataFrame:
    files = listing(t).select("page_id", "path", names.cleaned(F.col("path"), "[?=&#]").alias("clean"))
    return files.where(F.col("path") != F.col("clean"))


@query(
    """select o_orderkey, cast(o_orderdate as date) as feed_date, cast(o_orderdate as date) as by_name,
    cast(o_orderdate as date) as by_day from orders"""
)
def file_date(t: Tables) -> DataFrame:
    def path(pattern: str) -> Column:
        return F.concat(F.lit("in/feed_"), F.date_format("o_orderdate", pattern), F.lit("1.dat"))

    return t.orders.select(
        "o_orderkey",
        names.date_in_name(path("yyyyMMdd"), "feed_*.dat").alias("feed_date"),
        names.date_in_name(path("ddMMMMyyyy"), "feed_*.dat", "%d%B%Y").alias("by_name"),
        names.date_in_name(path("yyyyDDD"), "feed_*.dat", "%Y%j").alias("by_day"),
    )


@query(
    """select o_orderkey, upper(concat('exp_', strftime(o_orderdate, '%d%b%Y'))) as dated,
    replace('x_FILE_DATE.txt', 'FILE_DATE', strftime(o_orderdate, '%Y%m%d')) as filled,
    concat(strftime(o_orderdate, '%Y%m%d%H'), '-', strftime(o_orderdate + interval 36 hours, '%Y%m%d%H')) as ranged,
    strftime(o_orderdate, '%A, %B %d, %Y') as shown from orders"""
)
def file_name_format(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    filled = names.fill(F.lit("x_FILE_DATE.txt"), {"FILE_DATE": F.date_format(day, "yyyyMMdd")})
    return t.orders.select(
        "o_orderkey",
        names.dated_name(day, "%d%b%Y", "exp_", "u").alias("dated"),
        filled.alias("filled"),
        names.stamp(day, "%Y%m%d%H", ranged=True).alias("ranged"),
        names.dated_name(day, "%A, %B %d, %Y").alias("shown"),
    )


@query("select event_type, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') as watermark from events group by 1")
def watermark_iso(t: Tables) -> DataFrame:
    top = t.events.groupBy("event_type").agg(F.max("ts").alias("ts"))
    return top.select("event_type", dates.watermark_text(F.col("ts")).alias("watermark"))


@query("select max(ts) as max_start_timestamp from events")
def max_watermark(t: Tables) -> DataFrame:
    return top_value(t.events, "ts", "timestamp_ntz")


@query(
    """select doc_id, case when lang = 'en' then 'NA' else source end as domain,
    case when lang in ('en', 'fr') then 'NA' else cast(n_chars as varchar(20)) end as project,
    concat(cast(doc_id as varchar(20)), '~', lang, '~', source) as correlation_id, concat(lang, '_', source) as lineage_id
    from documents"""
)
def pipe_parts(t: Tables) -> DataFrame:
    lang, source = F.col("lang"), F.col("source")
    two = F.concat_ws("|", lang, source)
    three = F.concat_ws("|", two, F.lit("load"))
    four = F.concat_ws("|", three, F.col("n_chars").cast("string"))
    descriptor = F.when(lang == "en", two).when(lang == "fr", three).otherwise(four)
    domain, project = text.descriptor_parts(descriptor)
    correlation = text.correlation_id(F.col("doc_id"), lang, source)
    return t.documents.select(
        "doc_id",
        domain.alias("domain"),
        project.alias("project"),
        correlation.alias("correlation_id"),
        text.lineage_id(correlation).alias("lineage_id"),
    )


@query(
    """select o_orderkey, left(upper(concat_ws(' | ', o_orderstatus, o_orderpriority, cast(o_orderkey as varchar(9)))), 12)
    as subject from orders"""
)
def subject_text(t: Tables) -> DataFrame:
    parts = [F.col(c) for c in ("o_orderstatus", "o_orderpriority", "o_orderkey")]
    return t.orders.select("o_orderkey", text.subject(*parts, width=12).alias("subject"))


@query(
    """select event_id, strftime(timezone('America/Chicago', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') as local_time,
    cast(epoch_us(ts) // 1000 as varchar) as run_id from events"""
)
def local_time(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select("event_id", dates.local_text(ts).alias("local_time"), dates.run_id(ts).alias("run_id"))


@query(
    """select o_orderkey, case when last_day(cast(o_orderdate as date)) = cast(o_orderdate as date) then 'last' else 'other' end
    as branch from orders"""
)
def month_end_flag(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", branch(dates.is_month_end(day), "last", "other").alias("branch"))


@query(
    """select o_orderkey, case when month(o_orderdate) <> 2 and day(o_orderdate) = 30 then 'run'
    when month(o_orderdate) = 3 and day(o_orderdate) = 1 then 'run'
    when month(o_orderdate) <> 3 and day(o_orderdate) = 1 then 'skip' else 'invalid' end as branch from orders"""
)
def monthly30(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", dates.day_30_branch(day, "run", "skip", "invalid").alias("branch"))


@query(
    r"""select doc_id, cast(len(list_filter(string_split_regex(replace(text, '. ', concat('.', chr(13), chr(10), chr(9), chr(13))), '\r\n?|\n'),
    lambda x: regexp_matches(x, '\S'))) as bigint) as n from documents"""
)
def nonblank_counts(t: Tables) -> DataFrame:
    # Sentences become lines of all kinds, with a line of a tab between them.
    lines = F.replace(F.col("text"), F.lit(". "), F.lit(".\r\n\t\r"))
    return t.documents.select("doc_id", filesets.non_blank_lines(lines).cast("long").alias("n"))
