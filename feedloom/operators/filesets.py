"""Choosing files from a manifest (``path``, ``length``, ``modificationTime``), for all folders at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.gates import branch
from feedloom.operators.joins import lookup, settled
from feedloom.operators.ordering import numbered

SELECTIONS = ("NEWER_OLDEST", "NEWER_LATEST")
VALIDATIONS = ("FILENAME", "FILEMODTIME")
# Fixed value: a source without a known last file starts here.
FIRST_TIME = "1900-05-30 09:59:43"
TEXT_EXTENSIONS = ("dat", "csv", "txt")


def select_files(
    files: DataFrame,
    prefix: str | None = None,
    suffix: str | None = None,
    pattern: str | None = None,
    contains: str | None = None,
    excludes: str | None = None,
    run_date: str | None = None,
    non_empty: bool = False,
    path: str = "path",
    length: str = "length",
) -> DataFrame:
    """Files that pass every test given.

    The folder marker of the prefix itself never counts. ``pattern`` may match anywhere
    in the path; ``run_date`` asks for a folder of that name; ``non_empty`` drops files of
    no length and folder markers.
    """
    p = F.col(path)
    tests = []
    if prefix is not None:
        tests += [F.startswith(p, F.lit(prefix)), p != prefix]
    if suffix is not None:
        tests.append(F.endswith(p, F.lit(suffix)))
    if pattern is not None:
        tests.append(p.rlike(pattern))
    if contains is not None:
        tests.append(F.contains(p, F.lit(contains)))
    if excludes is not None:
        tests.append(~F.contains(p, F.lit(excludes)))
    if run_date is not None:
        tests.append(F.contains(p, F.lit(f"/{run_date}/")))
    if non_empty:
        tests += [F.col(length) > 0, ~F.endswith(p, F.lit("/"))]
    for test in tests:
        files = files.where(test)
    return files


def superseded(files: DataFrame, folder: Column, suffix: Column, path: str = "path") -> DataFrame:
    """Files that a later one in their folder replaces: all suffixes but the greatest.

    Of several files with one suffix only the last by path takes part; the others are
    left where they are, so they are in neither list.
    """
    last = files.groupBy(folder.alias("folder"), suffix.alias("suffix")).agg(F.max(path).alias(path))
    newest = last.groupBy("folder").agg(F.max("suffix").alias("__newest"))
    return lookup(last, newest, ["folder"], "inner", extra=F.col("suffix") < F.col("__newest")).drop("__newest")


def latest(files: DataFrame, folder: Column, suffix: Column, path: str = "path") -> DataFrame:
    """The file with the greatest suffix in each folder; of equal ones the last by path."""
    order = F.struct(suffix.alias("suffix"), F.col(path).alias("path"))
    return files.groupBy(folder.alias("folder")).agg(F.max(order).alias("m")).select(
        "folder", F.col("m.suffix").alias("suffix"), F.col("m.path").alias(path)
    )


#: Up to this place in a folder Spark itself passes on no more rows of a task than that.
NEAR = 1000
#: Files of one folder that are put in order in one task.
ORDERED = 1 << 17


def _shared_start(low: Column, high: Column) -> Column:
    """How many letters two texts have in common at the start."""
    spots = F.sequence(F.lit(0), F.least(F.length(low), F.length(high)))
    same = F.filter(spots, lambda n: F.left(low, n) == F.left(high, n))
    return F.array_max(same)


def _narrowed(rows: DataFrame, path: str) -> DataFrame:
    """Rows of the range of each folder that holds the wanted place, counted from the start of that range.

    Ranges are the next two letters after those that all paths of the folder share, and are only counted.
    """
    ends = rows.groupBy("folder").agg(F.min(path).alias("low"), F.max(path).alias("high"))
    shared = settled(ends.select("folder", _shared_start(F.col("low"), F.col("high")).alias("__shared")), "shared-starts")
    rows = lookup(rows, shared, ["folder"], "inner").withColumn("__part", F.substring(path, F.col("__shared") + 1, F.lit(2)))
    counts = rows.groupBy("folder", "__part").agg(F.count("*").alias("n"), F.first("__want").alias("want"))
    so_far = F.sum("n").over(Window.partitionBy("folder").orderBy("__part"))
    hit = counts.withColumn("upto", so_far).where("want <= upto and want > upto - n")
    hit = settled(hit.selectExpr("folder", "__part", "want - (upto - n) as __left"), "ranges-hit")
    kept = lookup(rows, hit, ["folder", "__part"], "inner")
    return kept.select("folder", path, F.col("__left").alias("__want"))


def nth_file(files: DataFrame, folder: Column, n: int = 0, path: str = "path") -> DataFrame:
    """The n-th file by path in each folder, from 0, for any n. Paths are unique; a folder with fewer files has none.

    For the first thousand places each task passes on no more files than that. For later ones files are counted by ranges of
    their paths, range within range, and only those of the range that holds the place are put in order.
    """
    rows = files.select(folder.alias("folder"), path)
    place = F.row_number().over(Window.partitionBy("folder").orderBy(path))
    if n < NEAR:
        return rows.withColumn("__rank", place).where(F.col("__rank") == n + 1).drop("__rank")
    rows = rows.withColumn("__want", F.lit(n + 1).cast("long"))
    while True:
        sizes = rows.groupBy("folder").agg(F.count("*").alias("n"), F.first("__want").alias("want"))
        if (sizes.where("n >= want").agg(F.max("n")).first()[0] or 0) <= ORDERED:
            break
        rows = _narrowed(rows, path)
    return rows.withColumn("__rank", place).where(F.col("__rank") == F.col("__want")).drop("__rank", "__want")


def on_run_dates(files: DataFrame, dates: DataFrame, path: str = "path", run_date: str = "run_date") -> DataFrame:
    """Files in a folder named after one of the asked dates (unique), with the date. One pass, however many dates."""
    folders = F.split(path, "/")
    between = F.array_distinct(F.slice(folders, F.lit(2), F.greatest(F.size(folders) - 2, F.lit(0))))
    asked = dates.select(F.col(run_date).cast("string").alias("__folder"), F.col(run_date))
    return lookup(files.withColumn("__folder", F.explode(between)), asked, ["__folder"], "inner").drop("__folder")


def of_run_dates(table: DataFrame, dates: DataFrame, run_date: str = "run_date") -> DataFrame:
    """Rows of a table laid out by run date, for a table of asked dates (unique).

    While the table of dates is small enough to be broadcast, the dates are known before the files are listed: folders of other dates are
    not opened. A test that any date passes lets Spark see that the dates leave something out.
    """
    asked = dates.where(F.col(run_date) >= F.lit("0001-01-01").cast(dates.schema[run_date].dataType))
    return table.join(asked.select(run_date), run_date, "left_semi")


def numbered_names(
    files: DataFrame,
    folder: Column,
    order: list[str],
    prefix: str,
    stamp: Column,
    extension: str,
    clock: bool = False,
) -> DataFrame:
    """New names ``<prefix><stamp>_<n>.<extension>`` for the files of each folder, numbered from 1.

    A folder of one file goes without a number. With ``clock`` the stamp is a time, and each
    file is one second later: ``<prefix>_<yyyyMMddHHmmss>.<extension>``.
    """
    out = numbered(files.withColumn("folder", folder), ["folder"], order, alias="n", total="__total")
    end = F.lit("." + extension)
    if clock:
        moved = F.timestamp_add("SECOND", F.col("n").cast("int"), stamp)
        name = F.concat(F.lit(prefix + "_"), F.date_format(moved, "yyyyMMddHHmmss"), end)
    else:
        number = F.when(F.col("__total") == 1, F.lit("")).otherwise(F.concat(F.lit("_"), F.col("n").cast("string")))
        name = F.concat(F.lit(prefix), stamp, number, end)
    return out.withColumn("new_name", name).drop("__total")


def last_processed(audit: DataFrame) -> DataFrame:
    """Last sensed file of each load. A sensed row without a time counts as the last one."""
    order = F.struct(F.col("file_mod_time").isNull(), F.col("file_mod_time"), F.col("file_name"))
    row = F.max_by(F.struct("file_mod_time", "file_name"), order)
    return (
        audit.where(F.col("is_sensed"))
        .groupBy("domain_name", "load_name")
        .agg(row.alias("__r"))
        .select(
            "domain_name",
            "load_name",
            F.col("__r.file_mod_time").alias("last_time"),
            F.col("__r.file_name").alias("last_name"),
        )
    )


def pick_newer(
    files: DataFrame,
    last: DataFrame,
    keys: list[str],
    selection: str = "NEWER_OLDEST",
    validation: str = "FILEMODTIME",
    name: str = "file_name",
    time: str = "file_mod_time",
) -> DataFrame:
    """The oldest or latest file of each source that is newer than its last processed one.

    ``last`` has one row per source with ``last_time`` and ``last_name``. ``FILENAME`` also passes over
    a file of the last one's name. Files of one time are ordered by name.
    """
    if selection not in SELECTIONS:
        raise ValueError(f"selection must be one of {SELECTIONS}")
    if validation not in VALIDATIONS:
        raise ValueError(f"validation must be one of {VALIDATIONS}")
    since = F.coalesce(F.col("last_time"), F.lit(FIRST_TIME).cast(files.schema[time].dataType))
    newer = lookup(files, last, keys).where(F.col(time) > since)
    if validation == "FILENAME":
        newer = newer.where(~F.col("last_name").eqNullSafe(F.col(name)))
    pick = F.min if selection == "NEWER_OLDEST" else F.max
    chosen = newer.groupBy(*keys).agg(pick(F.struct(time, name)).alias("__f"))
    return chosen.select(*keys, F.col(f"__f.{name}").alias(name), F.col(f"__f.{time}").alias(time))


def stable_files(before: DataFrame, after: DataFrame, path: str = "path", mark: str = "modificationTime") -> DataFrame:
    """Files found unchanged by two listings, each with unique paths."""
    later = after.select(path, F.col(mark).alias("__mark"))
    return lookup(before, later, [path], "left_semi", extra=F.col(mark) == F.col("__mark"))


def unchanged_runs(
    listings: DataFrame, path: str = "path", mark: str = "modificationTime", at: str = "listed_at", chunk: int = 1024
) -> DataFrame:
    """Runs of consecutive listings in which a file had one mark: the path, the mark, ``first_at``, ``last_at``, ``n_listings`` and
    ``is_last`` (whether the run goes up to the last listing).

    Takes a history of listings, a row per file and time of listing. A listing without the file ends its run. NULL is a mark like any other. Listings are numbered; as
    long as a file keeps its mark, that number and its own count rise together, so their difference names the run. A file's rows are counted
    in chunks of so many listings, so a history of any length is spread over tasks.
    """
    times = settled(numbered(listings.select(at).distinct(), [], [at], alias="__listing", total="__all"), "listing-times")
    rows = lookup(listings, times, [at], "inner").withColumn("__known", F.col(mark).isNotNull())
    counted = numbered(rows, [path, "__known", mark], ["__listing"], F.expr(f"__listing div {chunk}"), alias="__own")
    runs = counted.groupBy(path, mark, (F.col("__listing") - F.col("__own")).alias("__run")).agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("n_listings"), F.max(F.col("__listing") == F.col("__all")).alias("is_last")
    )
    return runs.drop("__run")


def settled_files(
    listings: DataFrame, for_listings: int | None = None, for_seconds: int | None = None, path: str = "path", mark: str = "modificationTime", at: str = "listed_at"
) -> DataFrame:
    """Files that the last listing shows with a mark they have had for so many listings, or for so long. With both, both must hold."""
    if for_listings is None and for_seconds is None:
        raise ValueError("say for how many listings or how many seconds")
    runs = unchanged_runs(listings, path, mark, at).where("is_last")
    if for_listings is not None:
        runs = runs.where(F.col("n_listings") >= for_listings)
    if for_seconds is not None:
        span = F.col("last_at").cast("timestamp").cast("double") - F.col("first_at").cast("timestamp").cast("double")
        runs = runs.where(span >= for_seconds)
    return runs.drop("is_last")


def object_counts(folders: DataFrame, files: DataFrame, folder: Column, limit: int = 1, path: str = "path") -> DataFrame:
    """Files per folder asked about, folder markers aside, and whether they are more than allowed. An empty folder has 0."""
    real = files.where(~F.endswith(F.col(path), F.lit("/")))
    counts = real.groupBy(folder.alias("folder")).agg(F.count("*").alias("__n"))
    out = lookup(folders, counts, ["folder"]).withColumn("n", F.coalesce("__n", F.lit(0))).drop("__n")
    return out.withColumn("too_many", F.col("n") > limit)


def presence_gate(folders: DataFrame, files: DataFrame, folder: Column, yes: str, no: str) -> DataFrame:
    """Whether a folder has any non-empty file. Takes one row per ``folder`` asked about."""
    found = files.where(F.col("length") > 0).groupBy(folder.alias("folder")).agg(F.count("*").alias("__n"))
    out = lookup(folders, found, ["folder"])
    return out.withColumn("branch", branch(F.col("__n") >= 1, yes, no)).drop("__n")


def has_content(line: Column) -> Column:
    """Whether a line holds anything but white space: blanks, tabs and line ends of any system are none."""
    return line.rlike(r"\S")


def non_blank_lines(text: Column) -> Column:
    """How many lines of a text are not blank; lines end with LF, CR LF or CR."""
    # From the first character that is no white space to the end of its line is one line.
    return F.regexp_count(text, F.lit(r"\S[^\r\n]*"))


def data_gate(
    folders: DataFrame,
    files: DataFrame,
    lines: DataFrame,
    folder: Column,
    extensions: tuple[str, ...] | None = TEXT_EXTENSIONS,
    header: int | None = None,
) -> DataFrame:
    """Whether a folder holds data: some file of any length, and no such file without a line.

    Blank lines do not count, nor do those up to the header, if its index among the others is given.

    Takes one row per ``folder`` asked about, the manifest, and lines as ``path`` and ``value`` (see
    ``sources.files.read_lines``). Files of no length are passed over; one with another extension
    fails the job, unless ``extensions`` is None. The manifest leads, since a file of blank lines
    only has no line to show.
    """
    counts = lines.where(has_content(F.col("value"))).groupBy("path").agg(F.count("*").alias("__lines"))
    sized = files.where(F.col("length") > 0)
    if extensions is not None:
        ext = F.lower(F.substring_index("path", ".", -1))
        bad = F.raise_error(F.concat(F.lit("extension not allowed: "), F.col("path"))).cast("string")
        sized = sized.withColumn("path", F.when(ext.isin(*extensions), F.col("path")).otherwise(bad))
    skipped = 0 if header is None else header + 1
    least = F.min(F.coalesce("__lines", F.lit(0)) - skipped)
    marks = lookup(sized, counts, ["path"]).groupBy(folder.alias("folder")).agg(least.alias("__least"))
    out = lookup(folders, marks, ["folder"])
    return out.withColumn("has_data", F.coalesce(F.col("__least") > 0, F.lit(False))).drop("__least")
