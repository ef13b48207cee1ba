"""Many requests for texts at once: which rows start with, end with or contain what each request names.

A request is tied to one key, a part of one of the texts it names, and rows are cut to the keys there are: starts and ends to the
lengths asked for, insides to grams of the length asked for, or of sixteen letters where more are asked. Being equal in a key is a
join; only pairs that are meet the exact test, and an inside of up to sixteen letters is its own key, so those pairs are all met. A request takes the key that the fewest others could take, so thousands of them below one folder are told apart by
what differs. The rows are read once, whatever the number of requests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.gates import branch
from feedloom.operators.joins import lookup, settled, sifted

START, END, INSIDE = "<", ">", "~"
#: Insides longer than this are found by grams of this length. A shorter gram is in far more rows, and those grow with the rows.
GRAM = 16

_TESTS = ("prefix", "suffix", "pattern", "contains", "excludes", "run_date", "non_empty")


def _keys(asks: DataFrame, parts: Sequence[tuple[str, Column]], same: Sequence[str]) -> DataFrame:
    """The key of each request: ``__ask``, ``__kind``, ``__key``."""
    listed = F.array(*[F.struct(F.lit(kind).alias("kind"), part.alias("part")) for kind, part in parts])
    each = asks.select("__ask", *same, F.explode(listed).alias("p")).select("__ask", *same, "p.*").where(F.length("part") > 0)
    size = F.when(F.col("kind") == INSIDE, F.least(F.length("part"), F.lit(GRAM))).otherwise(F.length("part"))
    spots = F.sequence(F.lit(1), F.length("part") - F.col("size") + 1)
    each = each.withColumn("size", size).withColumn("at", F.explode(spots))
    key = F.substring("part", F.col("at"), F.col("size")).alias("key")
    each = each.select("__ask", *same, "kind", key, "size").distinct()
    shared = each.groupBy(*same, "kind", "key").agg(F.count("*").alias("n"))
    each = each.join(shared, [*same, "kind", "key"])
    best = F.min_by(F.struct("kind", "key"), F.struct("n", -F.col("size"), "kind", "key"))
    return each.groupBy("__ask").agg(best.alias("k")).select("__ask", F.col("k.kind").alias("__kind"), F.col("k.key").alias("__key"))


def _spots(text: Column, kind: str, size: int) -> Column:
    """Where keys of a kind and size may start in a text."""
    last = F.length(text) - size + 1
    if kind == INSIDE:
        spots = F.sequence(F.lit(1), last)
    else:
        spots = F.array(F.lit(1) if kind == START else last)
    there = F.transform(spots, lambda at: F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"), F.lit(size).alias("size")))
    return F.when(last >= 1, there).otherwise(F.array().cast("array<struct<kind: string, at: int, size: int>>"))


def indexed_join(
    rows: DataFrame, text: str, asks: DataFrame, parts: Sequence[tuple[str, Column]], same: Mapping[str, str] | None = None
) -> DataFrame:
    """Pairs of a row and a request, all columns of both, where the row's text has the key of the request. Each pair comes once.

    ``parts`` are the texts that a request names and where they must be (``START``, ``END`` or ``INSIDE``); NULL and empty ones are
    passed over, and a request with no other is in no pair. ``same`` maps row columns to request columns that must be equal. Pairs still
    have to be tested: a key is only a part of what is asked for.

    The sizes of keys come to the driver: no more than there are letters in a text.
    """
    pairs = dict(same or {})
    asks = settled(asks.withColumn("__ask", F.monotonically_increasing_id()), "requests")
    keys = _keys(asks, parts, list(pairs.values()))
    asks = settled(lookup(asks, keys, ["__ask"], "inner"), "request-keys")
    sizes = asks.select("__kind", F.length("__key").alias("n")).distinct().collect()
    if not sizes:
        return rows.limit(0).join(asks.drop("__ask", "__kind", "__key").limit(0), F.lit(False))
    spots = F.concat(*[_spots(F.col(text), r["__kind"], r.n) for r in sorted(sizes)])
    cut = rows.select("*", F.explode(spots).alias("__s"))
    cut = cut.select(*rows.columns, F.col("__s.kind").alias("__kind"), F.col("__s.at").alias("__at"), F.substring(text, F.col("__s.at"), F.col("__s.size")).alias("__part"))
    # A gram that is in a text twice counts where it is first.
    cut = cut.where((F.col("__kind") != INSIDE) | (F.instr(F.col(text), F.col("__part")) == F.col("__at")))
    # Most parts of a text are no request's key; they are dropped where they are cut and never shuffled.
    equal = {"__kind": "__kind", "__part": "__key", **pairs}
    cut = sifted(cut, asks, equal)
    named = asks.withColumnsRenamed({c: f"__of_{c}" for c in asks.columns})
    joined = cut.join(named, reduce(lambda a, b: a & b, [F.col(a) == F.col(f"__of_{b}") for a, b in equal.items()]))
    return joined.select(*rows.columns, *[F.col(f"__of_{c}").alias(c) for c in asks.columns if not c.startswith("__")])


def select_for(files: DataFrame, requests: DataFrame, path: str = "path", length: str = "length") -> DataFrame:
    """The files that each request selects: ``request_id`` and the columns of the manifest.

    Requests have any of ``prefix``, ``suffix``, ``pattern``, ``contains``, ``excludes``, ``run_date`` and ``non_empty``, with the meaning that
    :func:`filesets.select_files` gives them; NULL tests nothing. Each must name a prefix, a suffix, a text to contain or a run date, else the job fails:
    it would take every file. Columns of the manifest must not have the names of tests.
    """
    missing = {c: F.lit(None).cast("boolean" if c == "non_empty" else "string") for c in _TESTS if c not in requests.columns}
    asks = requests.withColumns(missing).select("request_id", *_TESTS)
    folder = F.concat(F.lit("/"), F.col("run_date").cast("string"), F.lit("/"))
    named = F.greatest(*[F.coalesce(F.length(c), F.lit(0)) for c in ("prefix", "suffix", "contains", "run_date")]) > 0
    wrong = F.raise_error(F.concat(F.lit("request without a text: "), F.col("request_id").cast("string"))).cast(asks.schema["request_id"].dataType)
    asks = asks.withColumn("request_id", F.when(named, F.col("request_id")).otherwise(wrong)).withColumn("run_date", folder)
    parts = [(START, F.col("prefix")), (END, F.col("suffix")), (INSIDE, F.col("contains")), (INSIDE, F.col("run_date"))]
    found = indexed_join(files, path, asks, parts)
    p = F.col(path)

    def holds(test: str, passed: Column) -> Column:
        return F.col(test).isNull() | passed

    tests = [
        holds("prefix", F.startswith(p, F.col("prefix")) & (p != F.col("prefix"))),
        holds("suffix", F.endswith(p, F.col("suffix"))),
        holds("contains", F.contains(p, F.col("contains"))),
        holds("run_date", F.contains(p, F.col("run_date"))),
        holds("excludes", ~F.contains(p, F.col("excludes"))),
        holds("pattern", F.rlike(p, F.col("pattern"))),
        ~F.coalesce("non_empty", F.lit(False)) | ((F.col(length) > 0) & ~F.endswith(p, F.lit("/"))),
    ]
    return found.where(reduce(lambda a, b: a & b, tests)).select("request_id", *files.columns)


def containing(rows: DataFrame, text: str, asks: DataFrame, part: str, same: Mapping[str, str] | None = None) -> DataFrame:
    """Pairs of a row and a request whose ``part`` the row's text contains, with the columns of ``same`` equal. An empty part is in no text."""
    return indexed_join(rows, text, asks, [(INSIDE, F.col(part))], same).where(F.contains(F.col(text), F.col(part)))


def status_gate_for(requests: DataFrame, audit: DataFrame, busy: str, free: str, statuses: Sequence[str] = ("started",), last_run: bool = False) -> DataFrame:
    """As :func:`gates.status_gate_like`, for a table of requests (``domainname``, ``load_text``) of any length.

    Audit rows are reduced to one per load before they meet the requests, and those of domains that nobody asks for are mostly dropped before that.
    Of a load only its last run matters, and the last run that has one of the statuses: where these two are one run, that run is busy.
    """
    asks = requests.select(F.col("domainname").alias("ask_domain"), "load_text").distinct()
    domains = settled(asks.select("ask_domain").distinct(), "request-domains")
    hit = F.col("status").isin(*statuses)
    marks = {"__last": F.col("run_id"), "__hit": F.when(hit, F.col("run_id"))} if last_run else {"__hit": hit}
    rows = sifted(audit, domains, {"domainname": "ask_domain"}).select("domainname", "loadname", *[c.alias(n) for n, c in marks.items()])
    most = [F.max(n).alias(n) for n in marks]
    loads = rows.groupBy("domainname", "loadname").agg(*most)
    met = containing(loads, "loadname", asks, "load_text", {"domainname": "ask_domain"})
    keys = ["domainname", "load_text"]
    counts = met.groupBy(*keys).agg(*most)
    busy_now = F.col("__hit") == F.col("__last") if last_run else F.col("__hit")
    return lookup(requests, counts, keys).withColumn("branch", branch(busy_now, busy, free)).drop(*marks)
