"""The operators as named queries over whole tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontaminate, html_text, language, licences
from feedloom.llm.mixing import mix, mix_sql
from feedloom.llm.prefix_trie import prefix_trie
from feedloom.llm.quality_rules import BASE, judge
from feedloom.llm.repair import damaged, repair
from feedloom.llm.sharding import shuffle_into_shards
from feedloom.llm.simhash import near_duplicates
from feedloom.llm.substring_dedup import remove_repeated_windows
from feedloom.llm.suffix_dedup import remove_repeats
from feedloom.llm.warc_zip import REVISIT_BYTES, round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in ZIP archives, written and read back by range."""
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


ORACLES["op1_warc_zip"] = f"""
    with p as (select page_id, url, coalesce(html, '') as html from pages),
    k as (select *, strlen(html) as payload_bytes, max(page_id) over (partition by html) as top from p)
    select page_id, payload_bytes, sha1(html) as payload_digest,
      case when payload_bytes >= {REVISIT_BYTES} and page_id <> top then 'revisit' else 'response' end as record_type,
      case when payload_bytes >= {REVISIT_BYTES} and page_id <> top then top end as refers_to, url from k"""


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document once all 100-byte strings that occur earlier are cut."""
    out = remove_repeats(table(spark, sf_dir, "documents"), width=100)
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLES["op2_suffix_dedup"] = r"""
    with d as (select doc_id, encode(coalesce(text, '')) as x, strlen(coalesce(text, '')) as n from documents),
    b as (select doc_id, n, x, unnest(range(1, n + 1)) as i from d),
    k as (select doc_id, i, hex(x[i : i]) as byte, case when i + 99 <= n then x[i : i + 99] end as win from b),
    r as (select doc_id, i, byte, win is not null and row_number() over (partition by win order by doc_id, i) > 1 as again from k),
    c as (select *, bool_or(again) over (partition by doc_id order by i rows between 99 preceding and current row) as gone from r),
    e as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as opens from c),
    s as (select doc_id, count(case when gone then 1 end) as n_removed, count(case when opens then 1 end) as n_spans,
      string_agg(byte, '' order by i) filter (not gone) as kept from e group by doc_id)
    select d.doc_id, d.n::bigint as n_bytes, coalesce(s.n_removed, 0) as n_removed, coalesce(s.n_spans, 0) as n_spans,
      sha256(unhex(coalesce(s.kept, ''))) as kept_sha256 from d left join s on s.doc_id = d.doc_id"""


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: sources weigh 3, 1, 2 in turn, 150 % of all words, no source more than twice."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op3_mixing"] = mix_sql()


@query
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template wording of every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two or fewer differing bits."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document once all 20-word windows that occur earlier are cut."""
    out = remove_repeated_windows(table(spark, sf_dir, "documents"), words=20)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op6_substring_dedup"] = r"""
    with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
    w as (select doc_id, len(ws) as n, unnest(ws) as word, generate_subscripts(ws, 1) as i from d),
    k as (select *, case when i + 19 <= n then string_agg(word, ' ') over (
      partition by doc_id order by i rows between current row and 19 following) end as win from w),
    r as (select *, win is not null and row_number() over (partition by win order by doc_id, i) > 1 as again from k),
    c as (select *, bool_or(again) over (partition by doc_id order by i rows between 19 preceding and current row) as gone from r),
    s as (select doc_id, count(case when gone then 1 end) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from c group by doc_id)
    select d.doc_id, len(d.ws)::bigint as n_words, coalesce(s.n_removed, 0) as n_removed, sha256(coalesce(s.kept, '')) as kept_sha256
    from d left join s on s.doc_id = d.doc_id"""


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every document, and whether the rules' votes taken together keep it."""
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept", "quality")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the four fifths of them that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs)).drop("fits")


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, by windows of five-word shingles similar by 0.8 or more."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 0.8)


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


#: CRC-32 of the UTF-8 bytes of an ASCII text in DuckDB.
CRC32_SQL = (
    "xor(list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::bigint), "
    "lambda c, b: list_reduce(range(0, 8), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295), 4294967295)"
)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prefixes of rebuilt conversations, with what sharing them saves."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = f"""
    with o as (select conv_id as c, conv_id::varchar as d, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) as ts
      from conversations group by conv_id),
    h as (select c, ts, {CRC32_SQL.format("d")} % 9 as h from o),
    b as (select h.c, list_concat(coalesce(f.ts, [])[1 : h.h], h.ts[h.h + 1 :]) as ts from h left join o f on f.c = h.c - h.c % 5),
    p as (select c, ts, len(ts) as n, unnest(range(0, len(ts) + 1)) as depth from b),
    n as (select ts[1 : depth] as pre, depth, min(c) as conv_id, count(*) as n_convs,
      coalesce(string_agg(c::varchar, ',' order by c) filter (n = depth), '') as ends, count(*) filter (n = depth) as n_ends from p group by all),
    w as (select *, case when depth > 0 then (n_convs - 1) * strlen(pre[depth].t) else 0 end as w from n),
    s as (select pre[1 : up] as pre, sum(w) as saved, sum((n_convs = n_ends)::int) as leaves
      from (select *, unnest(range(0, depth + 1)) as up from w) group by 1),
    k as (select pre[1 : depth - 1] as pre, count(*) as k from n where depth > 0 group by 1)
    select n.conv_id, n.depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.k, 0) as n_children, s.leaves::bigint as n_leaves,
      s.saved::bigint as saved_tokens, sha256(n.ends) as ends_sha256
    from n join s on s.pre = n.pre left join k on k.pre = n.pre left join n u on n.depth > 0 and u.pre = n.pre[1 : n.depth - 1]"""


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in uniform random order over eight shards whose counts are at most one apart."""
    placed = shuffle_into_shards(table(spark, sf_dir, "documents"), shards=8)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each damaged conversation, and its cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations)
