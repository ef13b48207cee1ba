"""Sources, sinks and streams: sample tables written to scratch files and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators import filesets, gates, ordering
from feedloom.operators.joins import lookup, settled
from feedloom.plans import extract
from feedloom.session import scratch
from feedloom.sinks import load_manifest as put_manifest
from feedloom.sinks import write_dataset, write_watermark
from feedloom.sources import archives, files
from feedloom.streaming import (
    file_stream,
    keep_watermarks,
    process_new_files,
    process_sensed,
    read_arrived,
    read_audit,
    read_watermarks,
    sensed_stream,
    watermark_stream,
)
from feedloom.suite.fixtures import put_file, write_zip
from feedloom.suite.registry import Tables, query

#: Unpacked bytes of one packed file.
PACKED_BYTES = 256 << 20


def _texts_by_source(t: Tables) -> str:
    """Document texts as files, one folder per source."""
    out = scratch(t.spark, "texts")
    t.documents.select("source", F.col("text").alias("value")).write.partitionBy("source").text(out)
    return out


def _folder() -> Column:
    return F.regexp_extract("path", "/source=([^/]*)/", 1)


def _written(listed: DataFrame) -> DataFrame:
    """Without the marks and checksums that writing leaves."""
    return listed.where(~F.col("path").rlike(r"\.crc$|/_SUCCESS$"))


@query(
    """select source as folder, cast(sum(strlen(text) + 1) + case when source = 'src1' then 3 else 0 end as bigint) as bytes,
    case when source = 'src1' then 1 else 0 end as n_empty, case when source = 'src1' then 1 else 0 end as n_hidden, true as timed
    from documents group by 1"""
)
def file_manifest(t: Tables) -> DataFrame:
    """Bytes by folder; one of the folders also holds an empty and a hidden file."""
    out = _texts_by_source(t)
    put_file(t.spark, f"{out}/source=src1/empty.txt")
    put_file(t.spark, f"{out}/source=src1/_hidden", b"abc")
    found = _written(files.manifest(t.spark, out)).groupBy(_folder().alias("folder"))
    return found.agg(
        F.sum("length").alias("bytes"),
        F.count_if(F.col("length") == 0).cast("int").alias("n_empty"),
        F.count_if(F.col("path").rlike("/[_.][^/]*$")).cast("int").alias("n_hidden"),
        (F.min("modificationTime") > F.lit("2000-01-01").cast("timestamp")).alias("timed"),
    )


@query(
    r"""select source as folder, source <> 'src1' and bool_or(regexp_matches(text, '\S')) as has_data from documents group by 1"""
)
def data_gate(t: Tables) -> DataFrame:
    """Folders with data; the texts of one source are blanks and tabs."""
    blank = F.when(F.col("source") == "src1", F.lit(" \t ")).otherwise(F.col("text"))
    path = scratch(t.spark, "texts")
    t.documents.select("source", blank.alias("value")).write.partitionBy("source").text(path)
    folders = t.documents.select(F.col("source").alias("folder")).distinct()
    return filesets.data_gate(folders, _written(files.manifest(t.spark, path)), files.read_lines(t.spark, path), _folder())


@query(
    """select concat('l_', lang) as load_name, count(case when n_chars > 300 then 1 end) as count,
    case when count(case when n_chars > 300 then 1 end) >= 1 then 'new' else 'none' end as branch from documents group by 1
    union all select 'l_nothing', 0, 'none'"""
)
def status_documents(t: Tables) -> DataFrame:
    """Status documents written one to a load, read back and judged."""
    out = scratch(t.spark, "status")
    long = F.count_if(F.col("n_chars") > 300).alias("count")
    nothing = t.spark.createDataFrame([("l_nothing", 0)], "load string, count long")
    counts = t.documents.groupBy(F.concat(F.lit("l_"), F.col("lang")).alias("load")).agg(long).union(nothing)
    counts.repartition("load").write.partitionBy("load").json(out)
    load = F.regexp_extract("path", "/load=([^/]*)/", 1)
    found = files.read_status(t.spark, out).select(load.alias("load_name"), "count")
    return found.withColumn("branch", gates.json_count_gate(F.to_json(F.struct("count")), "new", "none"))


@query(
    r"""select concat('doc_', cast(doc_id as varchar(20)), '.txt') as member,
    cast(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S'))) as bigint) as lines,
    cast(length(replace(text, chr(10), '')) as bigint) as chars from documents"""
)
def archive_lines(t: Tables) -> DataFrame:
    out = scratch(t.spark, "zips")
    member = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    rows = t.documents.select(member.alias("member"), "text")
    write_zip(rows.repartition("member"), out, "member", "text").write.format("noop").mode("overwrite").save()
    lines = archives.read_zip_lines(archives.zip_members(t.spark, out))
    counted = lines.groupBy("member").agg(
        F.count_if(filesets.has_content(F.col("value"))).alias("lines"), F.sum(F.length("value")).alias("chars")
    )
    return counted


@query(
    r"""select lang, cast(sum(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')))) as bigint) as lines,
    cast(sum(length(replace(text, chr(10), ''))) as bigint) as chars from documents group by 1"""
)
def gzip_lines(t: Tables) -> DataFrame:
    out = scratch(t.spark, "gzip")
    rows = t.documents.select("lang", F.col("text").alias("value"))
    # A packed file is read by one task, so a file holds what one task reads well.
    each = rows.agg(F.avg(F.length("value") + 1).alias("n")).first().n or 1
    per_file = max(1, int(PACKED_BYTES / each))
    write_dataset(rows, out, "text", records_per_file=per_file, partition_by=["lang"], compression="gzip")
    lang = F.regexp_extract("path", "/lang=([^/]*)/", 1)
    lines = files.read_lines(t.spark, out)
    return lines.groupBy(lang.alias("lang")).agg(
        F.count_if(filesets.has_content(F.col("value"))).alias("lines"), F.sum(F.length("value")).alias("chars")
    )


@query("select * from orders")
def sink_max_records(t: Tables) -> DataFrame:
    job = extract.ExtractJob(scratch(t.spark, "orders"), records_per_file=10_000, run_date="2024-01-01")
    return t.spark.read.parquet(extract.run(t.spark, t.orders, job).location)


@query("select max(ts) as max_start_timestamp from events")
def watermark_roundtrip(t: Tables) -> DataFrame:
    out = scratch(t.spark, "events")
    written = write_dataset(t.events, f"{out}/data", watermark="ts")
    write_watermark(t.spark, written, f"{out}/watermark")
    stored = files.read_watermark(t.spark, f"{out}/watermark")
    return stored.select(F.col(files.WATERMARK).cast("timestamp_ntz").alias(files.WATERMARK))


@query(
    """select 'feed7' as feed_id, '1' as feed_version, count(*) as record_count, 'parquet' as file_format,
    false as is_header, ',' as delimiter from events"""
)
def load_manifest(t: Tables) -> DataFrame:
    out = scratch(t.spark, "manifest")
    written = write_dataset(t.events, f"{out}/data")
    put_manifest(t.spark, written, f"{out}/manifest", "feed7")
    row = t.spark.read.schema(
        "feed_id string, feed_version string, record_count long, file_format string, is_header boolean, delimiter string"
    )
    return row.json(f"{out}/manifest")


@query("select event_id, ts, event_type, value from events")
def stream_new_files(t: Tables) -> DataFrame:
    out = scratch(t.spark, "arrivals")
    stream = file_stream(t.spark, t.path("events") + "*", t.events.schema, files_per_batch=100)
    process_new_files(stream.select("event_id", "ts", "event_type", "value"), f"{out}/data", f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/data")


@query("select event_type, max(ts) as start_timestamp, count(*) as n from events group by 1")
def stream_max_watermark(t: Tables) -> DataFrame:
    out = scratch(t.spark, "watermarks")
    # Several files, one to a batch.
    t.events.repartition(2, "event_id").write.parquet(f"{out}/in")
    stream = file_stream(t.spark, f"{out}/in", t.events.schema, files_per_batch=1)
    keep_watermarks(watermark_stream(stream, "event_type", "ts"), f"{out}/table", f"{out}/checkpoint", "event_type")
    kept = read_watermarks(t.spark, f"{out}/table", "event_type")
    return kept.withColumn("start_timestamp", F.col("start_timestamp").cast("timestamp_ntz"))


@query(
    """select cast(a.event_type as varchar(20)) as load_name, a.n as rows, a.n as arrived, true as same_batch, true as is_sensed
    from (select event_type, count(*) as n from events group by 1) a"""
)
def stream_arrivals_audited(t: Tables) -> DataFrame:
    """Events that arrive in several batches, a load for each type, each batch with its audit rows; what arrived held against them."""
    out = scratch(t.spark, "sensed")
    kinds = sorted(r[0] for r in t.events.select("event_type").distinct().collect())
    t.events.repartition(2, "event_id").write.partitionBy("event_type").parquet(f"{out}/in")
    for kind in kinds:
        stream = sensed_stream(t.spark, f"{out}/in/event_type={kind}", "event_id long, value double", files_per_batch=1)
        process_sensed(stream, f"{out}/data", f"{out}/audit", f"{out}/checkpoint/{kind}", kind, "events", kind, "2024-01-01")
    audit, arrived = read_audit(t.spark, f"{out}/audit"), read_arrived(t.spark, f"{out}/data", f"{out}/audit")
    per_batch = arrived.groupBy("stream", "batch", "file_path").agg(F.count("*").alias("arrived"))
    met = audit.join(per_batch, ["stream", "batch", "file_path"], "left")
    return met.groupBy("load_name").agg(
        F.sum("rows").alias("rows"), F.sum("arrived").alias("arrived"), F.bool_and(F.col("rows") == F.col("arrived")).alias("same_batch"), F.bool_and("is_sensed").alias("is_sensed")
    )


@query(
    """select event_type, max(ts) as start_timestamp, count(*) as n, true as untouched from events group by 1"""
)
def stream_watermark_parts(t: Tables) -> DataFrame:
    """Watermarks per type in a table of parts; a second stream with old rows of one type only leaves every file as it is."""
    out = scratch(t.spark, "watermark-parts")
    t.events.write.parquet(f"{out}/in")
    events = t.events.schema
    keep_watermarks(watermark_stream(file_stream(t.spark, f"{out}/in", events), "event_type", "ts"), f"{out}/table", f"{out}/one", "event_type")
    name = F.col("_metadata.file_name").alias("name")
    before = settled(t.spark.read.parquet(f"{out}/table").select(name).distinct(), "files")
    keep_watermarks(watermark_stream(file_stream(t.spark, f"{out}/in", events), "event_type", "ts"), f"{out}/table", f"{out}/two", "event_type")
    kept = t.spark.read.parquet(f"{out}/table").select("event_type", F.col("start_timestamp").cast("timestamp_ntz"), "n", name)
    return lookup(kept, before.withColumn("untouched", F.lit(True)), ["name"]).drop("name")


@query(
    """select o_orderpriority as priority, count(*) as n, max(o_totalprice) as top from orders group by 1"""
)
def branch_table(t: Tables) -> DataFrame:
    """Orders written by branch, looked up in a table with a branch for each customer."""
    out = scratch(t.spark, "branches")
    named = t.orders.select(F.col("o_orderpriority").alias("value")).distinct().withColumn("branch", F.lower("value"))
    gates.write_branches(t.orders.select("o_orderpriority", "o_totalprice"), "o_orderpriority", named, f"{out}/orders")
    rows = t.spark.read.parquet(f"{out}/orders").where(F.lower("o_orderpriority") == F.col("branch"))
    return rows.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))


@query(
    """select l_orderkey, sum(l_quantity) as quantity, any_value(o_orderpriority) as priority
    from lineitem join orders on o_orderkey = l_orderkey group by 1"""
)
def sorted_runs_join(t: Tables) -> DataFrame:
    """Items and orders written once as sorted runs, joined and grouped without another shuffle or sort."""
    out = scratch(t.spark, "runs")
    names = {n: f"runs_{n}_{uuid.uuid4().hex}" for n in ("items", "orders")}
    ordering.write_sorted_runs(t.lineitem.select("l_orderkey", "l_quantity"), names["items"], f"{out}/items", ["l_orderkey"], 8)
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    ordering.write_sorted_runs(orders, names["orders"], f"{out}/orders", ["l_orderkey"], 8)
    items, orders = (ordering.read_sorted_runs(t.spark, names[n]) for n in ("items", "orders"))
    joined = items.hint("merge").join(orders, "l_orderkey")
    for name in names.values():
        # The files stay, and what has been read is known by them.
        t.spark.sql(f"drop table {name}")
    return joined.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.first("o_orderpriority").alias("priority"))


@query(
    """select rank, l_orderkey, l_linenumber, l_quantity from (select *, row_number() over (order by l_quantity, l_orderkey, l_linenumber) as rank
    from (select l_orderkey, l_linenumber, l_quantity from lineitem)) x"""
)
def stable_sort(t: Tables) -> DataFrame:
    """Items by quantity, those of one quantity in the order in which they are stored: by order and line."""
    out = scratch(t.spark, "stored")
    t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").orderBy("l_orderkey", "l_linenumber").write.parquet(f"{out}/items")
    ordered = ordering.stable_sort(t.spark.read.parquet(f"{out}/items"), ["l_quantity"])
    # Rows are numbered as they come, so the rank shows the order itself.
    ordered.write.parquet(f"{out}/sorted")
    stored = ordering.with_place(t.spark.read.parquet(f"{out}/sorted"))
    return ordering.numbered(stored, [], ordering.PLACE, alias="rank").select("rank", "l_orderkey", "l_linenumber", "l_quantity")
