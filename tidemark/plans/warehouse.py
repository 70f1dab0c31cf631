"""The batch pipeline: raw files -> landed table -> fact -> dimensions and rollups.

Each step writes a table that the next one reads. A step can be run again at
any time: it replaces whole partitions or whole tables, and by default it only
works on what is new, told by what the stored tables were built from. The whole
warehouse is built beside the version in use, audited, and only then switched to.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidemark.functions import fixed, schemas
from tidemark.operators import dims, quality, rollups, texts
from tidemark.operators.fact import fact_from_ods
from tidemark.plans import guard, reports
from tidemark.session import delete, side_by_side
from tidemark.sources import raw, tables, versions


@dataclass
class Landing:
    """What a landing run did; ``broken`` lists damaged files, which were left out whole."""

    lines: int
    bad_lines: int
    broken_files: int
    broken: DataFrame | None


class GateClosed(Exception):
    """A blocking rule failed, so nothing was published; ``rules`` has the verdicts."""

    def __init__(self, rules: list[Row]):
        self.rules = rules
        super().__init__("; ".join(f"{r.id} {r.name}: {r.detail}" for r in rules if not r.passed and r.action == quality.BLOCK))


_STATE = ("path string, length long, modificationTime timestamp, error string, line_cnt long, good_cnt long, "
          "text_bytes long, hour int, dt date")
_STATE_COLUMNS = [field.split()[0] for field in _STATE.split(", ")]

#: Partitions of the landed table: an hour holds a folder for each of its raw files.
ODS_PARTITIONS = ("dt", "hour", "file")


def landed_files(spark: SparkSession, ods_path: str) -> DataFrame | None:
    """What is known of every raw file that was read: its size and time then, damage, lines, good lines and unpacked size."""
    path = f"{ods_path.rstrip('/')}_files"
    return None if tables.stored_files(spark, path) is None else spark.read.schema(_STATE).parquet(path)


def _due_files(files: DataFrame, known: DataFrame | None) -> DataFrame:
    """Files that are new, changed or were damaged when they were read."""
    if known is None:
        return files
    return files.join(known.filter("error IS NULL"), ["path", "length", "modificationTime"], "left_anti")


@dataclass
class Staged:
    """Unpacked files that readers do not see yet."""

    spark: SparkSession
    ods_path: str
    rows: DataFrame  # the files' rows, and their verdicts where ``done``
    known: DataFrame | None

    @property
    def folders(self) -> tuple[str, str]:
        return f"{self.ods_path}_staged", f"{self.ods_path}_noted"

    def broken(self) -> DataFrame:
        """Damaged files; the driver's own listing has an entry for each file anyway."""
        return self.rows.filter("done AND error IS NOT NULL").select("raw_path")

    def sound(self) -> DataFrame:
        """Rows of sound files."""
        return self.rows.filter("NOT done").join(F.broadcast(self.broken()), "raw_path", "left_anti").select(
            *[f.name for f in schemas.ODS.fields], "raw_path", *ODS_PARTITIONS)

    def states(self) -> DataFrame:
        """``_STATE`` of these files and of all others of their days that are still part of the table."""
        own = _file_states(self.rows)
        if self.known is None:
            return own
        # Damaged files that are still there are among the own ones.
        kept = tables.on_days(self.known, self.days()).filter("error IS NULL").join(own, "path", "left_anti")
        return own.unionByName(kept.select(_STATE_COLUMNS))

    def days(self) -> list:
        return [r.dt for r in self.rows.filter("done").select("dt").distinct().collect()]  # one per calendar day

    def table(self) -> DataFrame:
        """The landed table as it will be: columns of the schema, ``dt`` and ``hour``."""
        columns = [*[f.name for f in schemas.ODS.fields], "dt", "hour"]
        new = self.sound().select(columns)
        if tables.stored_files(self.spark, self.ods_path) is None:
            return new
        replaced = self.rows.filter("done AND error IS NULL").select("file")
        return self.spark.read.parquet(self.ods_path).join(F.broadcast(replaced), "file", "left_anti").select(
            columns).unionByName(new)

    def publish(self) -> None:
        """The rows of sound files take the place of what their files had, without a shuffle; other files are left."""
        tables.write_days(self.sound(), self.ods_path, *ODS_PARTITIONS, rebalance=False)
        if self.known is not None:
            _drop_emptied(self.spark, self.ods_path, self.known, _file_states(self.rows))

    def note(self) -> Landing:
        """Stores what is known of the files, which ends the landing."""
        staging = self.folders[1]
        self.states().write.mode("overwrite").parquet(staging)
        noted = self.spark.read.schema(_STATE).parquet(staging)
        tables.write_days(noted, f"{self.ods_path}_files", "dt")
        counts = self.rows.filter("done").agg(
            F.sum("line_cnt").alias("lines"), F.count_if(F.col("error").isNotNull()).alias("broken")).first()
        good = self.sound().count()
        if not counts.broken:
            return Landing(counts.lines, counts.lines - good, 0, None)
        broken = tables.on_days(landed_files(self.spark, self.ods_path), self.days()).filter("error IS NOT NULL")
        return Landing(counts.lines, counts.lines - good, counts.broken, broken.select("path", "dt", "hour", "error"))

    def drop(self) -> None:
        for path in self.folders:
            delete(self.spark, path)


def stage(spark: SparkSession, raw_root: str, ods_path: str, overwrite: bool = False, days: list | None = None) -> Staged | None:
    """Unpacks and parses the files that are due, each opened once, beside the table; None where none is."""
    ods_path = ods_path.rstrip("/")
    files, known = raw.raw_files(spark, raw_root, days), landed_files(spark, ods_path)
    due = _due_files(files, None if overwrite else known)
    if due.isEmpty():
        return None
    lines = raw.parse_lines(raw.unpacked(due))
    raw.staged_rows(lines).write.mode("overwrite").option("compression", "zstd").parquet(f"{ods_path}_staged")
    return Staged(spark, ods_path, spark.read.parquet(f"{ods_path}_staged"), known)


def land(spark: SparkSession, raw_root: str, ods_path: str, overwrite: bool = False,
         days: list | None = None) -> Landing:
    """Bring the table up to the landing zone (or to some days of it), or read everything there again.

    Only files that are new, have changed or were damaged are opened, each once: their rows
    are staged while they are unpacked, and those of sound files replace the file's own
    partition. So a file may come late, be repaired, or be archived once it is landed: what was
    landed from it stays, also where it turns up damaged later. What is known of the files is stored
    last: a run that is cut short is done again. One run at a time lands into a table.
    """
    staged = stage(spark, raw_root, ods_path, overwrite, days)
    if staged is None:
        return Landing(0, 0, 0, None)
    staged.publish()
    done = staged.note()
    staged.drop()
    return done


def _file_states(staged: DataFrame) -> DataFrame:
    """``_STATE`` of the staged files."""
    counts = staged.groupBy("raw_path").agg(
        F.count_if(~F.col("done")).alias("good"),
        *(F.max(F.when(F.col("done"), F.col(c))).alias(c)
          for c in ("length", "modificationTime", "error", "line_cnt", "text_bytes", "dt", "hour")))
    good = F.when(F.col("error").isNull(), F.col("good")).otherwise(0).cast("long")
    return counts.select(F.col("raw_path").alias("path"), "length", "modificationTime", "error", "line_cnt",
                         good.alias("good_cnt"), "text_bytes", "hour", "dt")


def _drop_emptied(spark: SparkSession, ods_path: str, known: DataFrame, states: DataFrame) -> None:
    """Deletes the partitions of files that had good lines and have none any more: a few, and only changed files."""
    none = states.filter("error IS NULL AND good_cnt = 0").select("path")
    had = known.filter("good_cnt > 0").join(none, "path", "left_semi").select("path", "dt", "hour")
    for r in had.withColumn("file", raw.file_key("path")).toLocalIterator():
        hour = "__HIVE_DEFAULT_PARTITION__" if r.hour is None else r.hour
        delete(spark, f"{ods_path}/dt={r.dt}/hour={hour}/file={r.file}")


def ingest_volume(spark: SparkSession, raw_root: str, ods_path: str) -> DataFrame:
    """Per day, and in total where ``dt`` is NULL: files and damaged ones, landed hours, lines, bad lines and rows,
    raw and stored size, their ratio and the stored bytes per row.

    All of it comes from listings and from what landing noted, in whichever run; no data is read.
    """
    raw_size = raw.raw_files(spark, raw_root).groupBy("dt").agg(
        F.count("*").alias("raw_files"), F.sum("length").alias("raw_bytes"))
    empty = spark.createDataFrame([], _STATE)
    known = landed_files(spark, ods_path)
    noted = (empty if known is None else known).groupBy("dt").agg(
        F.count_if(F.col("error").isNotNull()).alias("damaged_files"), F.sum("line_cnt").alias("lines"),
        F.sum(F.col("line_cnt") - F.col("good_cnt")).alias("bad_lines"), F.sum("good_cnt").alias("rows"))
    files = tables.stored_files(spark, ods_path)
    stored = (empty if files is None else files).groupBy("dt").agg(
        F.count_distinct("hour").alias("hours"), F.sum("length").alias("stored_bytes"))
    days = raw_size.join(noted, "dt", "full").join(stored, "dt", "full").na.fill(0)
    sums = ["raw_files", "damaged_files", "hours", "lines", "bad_lines", "rows", "raw_bytes", "stored_bytes"]
    return days.rollup("dt").agg(*(F.sum(c).alias(c) for c in sums)).select(
        "dt", *sums, F.try_divide("raw_bytes", "stored_bytes").alias("ratio"),
        F.try_divide("stored_bytes", "rows").alias("bytes_per_row"))


def hour_states(spark: SparkSession, raw_root: str, ods_path: str, first=None, last=None) -> DataFrame:
    """``(dt, hour, state)`` of every expected hour: landed, damaged, pending or missing.

    An hour is damaged if any of its files is, and pending if one waits to be landed. The span defaults
    to the days of the landing zone. Only files that are new, changed or were damaged are opened.
    """
    files = raw.raw_files(spark, raw_root)
    if first is None or last is None:
        expected = quality.hour_grid(files.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")))
    else:
        expected = quality.expected_hours(spark, first, last)
    known = landed_files(spark, ods_path)
    due = raw.gzip_integrity(_due_files(files, known)).select("dt", "hour", F.when(F.col("ok"), 1).otherwise(2).alias("worst"))
    if known is not None:
        due = due.unionByName(known.filter("error IS NULL").select("dt", "hour", F.lit(0).alias("worst")))
    names = F.array(*map(F.lit, ("landed", "pending", "damaged")))
    states = due.groupBy("dt", "hour").agg(F.get(names, F.max("worst")).alias("state"))
    return expected.join(states, ["dt", "hour"], "left").na.fill("missing", ["state"])


def build_fact_days(spark: SparkSession, ods_path: str, fact_path: str, days: list | None = None,
                    overwrite: bool = False) -> list[dt.date]:
    """Write the fact for the given days, by default those that were built from other files or never; returns them.

    What a day is made of is looked up before it is read and noted beside the fact, so an hour that lands
    meanwhile is found by the next run. Days that the source has lost become empty. All days are one job: they
    share the cluster instead of taking turns, and the partition filter keeps the other days unread.
    """
    prints = tables.day_prints(spark, ods_path)
    if days is None:
        built = {} if overwrite else tables.built_from(spark, fact_path)
        gone = [d for d, source in built.items() if d not in prints and source]
        days = [d for d, source in prints.items() if built.get(d) != source] + gone
    days = sorted(map(str, days))
    dates = [dt.date.fromisoformat(d) for d in days]
    if days:
        ods = tables.on_days(spark.read.parquet(ods_path), days)
        tables.write_days(fact_from_ods(ods), fact_path, "dt", asked={(d,) for d in dates})
        tables.note_built(spark, fact_path, {d: prints.get(d, "") for d in days})
    return dates


Build = Callable[[DataFrame], DataFrame]

#: Tables made by day and from which table, in order. Each is built anew for the days that changed.
DAY_TABLES: dict[versions.Table, tuple[versions.Table, Build]] = {
    ("state", "event_grain"): (("dwd", "event_fact"), rollups.daily_grain),
    ("state", "repo_days"): (("state", "event_grain"), dims.repo_days),
    ("state", "actor_days"): (("state", "event_grain"), dims.actor_days),
    **{("state", name): (("state", "event_grain"), build) for name, build in rollups.DAY_STATES.items()},
    **{("ads", name): (("state", "event_grain"), build) for name, build in rollups.ADS_TABLES.items()},
    ("serving", "summary"): (("state", "event_grain"), rollups.daily_summary),
}

#: Whole tables and what they are folded from.
WHOLE_TABLES: dict[versions.Table, tuple[versions.Table, Build]] = {
    ("dwd", "dim_repo"): (("state", "repo_days"), dims.dim_repo),
    ("dwd", "dim_actor"): (("state", "actor_days"), dims.dim_actor),
    ("dwd", "dim_date"): (("serving", "summary"), lambda summary: dims.dim_date(summary, "date")),
    ("serving", "meta"): (("serving", "summary"), rollups.dataset_meta),
}
DIMENSIONS = {"dim_repo": dims.dim_repo, "dim_actor": dims.dim_actor, "dim_date": dims.dim_date}


def build_fact(draft: versions.Draft, ods: DataFrame, prints: dict[str, str], overwrite: bool = False) -> list[str]:
    """The fact days of a draft that were built from other files than ``prints`` tells; returns them."""
    days = draft.stale("dwd", "event_fact", prints, overwrite)
    if days:
        draft.write_days("dwd", "event_fact", fact_from_ods(tables.on_days(ods, days)), {d: prints[d] for d in days})
    return days


def build_tables(draft: versions.Draft, overwrite: bool = False) -> None:
    """All tables behind the fact, for the days that changed: one scan of their fact rows makes the grain.

    Tables that are made from the same ones are built side by side.
    Dimensions are folded from what each day adds to them, so a day that is built anew takes back its old share.
    """
    todo = DAY_TABLES | WHOLE_TABLES
    while todo:  # three rounds: the grain, what is made of it, what is folded from that
        ready = [table for table, (origin, _) in todo.items() if origin not in todo]
        side_by_side(draft.spark, [partial(_build_table, draft, table, overwrite) for table in ready])
        todo = {table: made for table, made in todo.items() if table not in ready}


def _build_table(draft: versions.Draft, table: versions.Table, overwrite: bool) -> None:
    if table in DAY_TABLES:
        origin, build = DAY_TABLES[table]
        sources = draft.version.tokens(*origin)
        days = draft.stale(*table, sources, overwrite)
        filled = [d for d in days if sources[d] != versions.EMPTY]
        if days:
            rows = build(draft.read(*origin, filled)) if filled else None
            draft.write_days(*table, rows, {d: sources[d] for d in days})
    else:
        origin, build = WHOLE_TABLES[table]
        tokens = draft.version.tokens(*origin)
        source = versions.digest(tokens)
        if any(t != versions.EMPTY for t in tokens.values()) and (overwrite or draft.source(*table) != source):
            draft.write(*table, build(draft.read(*origin)), source)


def build_from(spark: SparkSession, ods_path: str, root: str, overwrite: bool = False) -> list[str]:
    """A new version of all tables from a landed table as it lies; the fact days that were built."""
    draft, prints = versions.Draft(spark, root), tables.day_prints(spark, ods_path)
    try:
        days = build_fact(draft, spark.read.parquet(ods_path), prints, overwrite)
        build_tables(draft, overwrite)
        draft.commit()
    except BaseException:
        draft.abandon()
        raise
    return days


def raw_prints(states: DataFrame) -> dict[str, str]:
    """What each landed day is made of: its raw files with their sizes and times. One entry per calendar day."""
    prints = states.filter("error IS NULL").groupBy("dt").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("x"))
    return {str(r.dt): f"{r.n}:{r.x}" for r in prints.collect()}


def audit(ods: DataFrame, fact: DataFrame, days: Iterable[str]) -> list[Row]:
    """The rules' verdicts on the days that a run is about to publish: five rows."""
    return quality.quality_rules(tables.on_days(ods, list(days)), fact).orderBy("id").collect()


def build_warehouse(spark: SparkSession, raw_root: str, root: str, overwrite: bool = False, gate: bool = True) -> DataFrame:
    """The whole pipeline: write, audit, publish. Returns the catalog status of the new version.

    Files are staged and every table is built beside the version in use. Then the rules judge the
    days that are about to be published: if a blocking one fails, all that was written is deleted
    and ``GateClosed`` raised; the old version, the landed table and what is known of the files stay
    as they are, so the next run tries again. Otherwise the landed rows are published and the
    version is switched.
    """
    ods_path = tables.table_path(root, "ods", "events")
    draft, staged = versions.Draft(spark, root), stage(spark, raw_root, ods_path, overwrite)
    try:
        if staged is None:
            states = landed_files(spark, ods_path)
            ods = None if states is None else spark.read.parquet(ods_path)
        else:
            ods, states = staged.table(), staged.states()
            if staged.known is not None:  # and the hours without a file that was due
                states = states.unionByName(staged.known.join(states, "path", "left_anti").select(states.columns))
        days = [] if states is None else build_fact(draft, ods, raw_prints(states), overwrite)
        if gate and days:
            rules = audit(ods, draft.read("dwd", "event_fact", days), days)
            if any(not r.passed and r.action == quality.BLOCK for r in rules):
                raise GateClosed(rules)
        build_tables(draft, overwrite)
        if staged is not None:
            staged.publish()
        draft.commit()
    except BaseException:
        draft.abandon()
        if staged is not None:
            staged.drop()
        raise
    if staged is not None:
        staged.note()
        staged.drop()
    return versions.register_views(spark, root)


def write_extract(spark: SparkSession, root: str, out: str, rows: int = fixed.EXTRACT_ROWS_PER_DAY) -> DataFrame:
    """A small copy: rank tables cut to the top rows of each day, the others whole.

    Returns ``(table, rows, full_rows, pct)``.
    """
    version = versions.current(spark, root)

    def cut(name: str) -> None:
        table = versions.read(spark, root, "ads", name, version)
        ties = rollups.RANK_TIES.get(name)
        top = rollups.top_per_day(table, *ties, rows=rows) if ties else table
        tables.write_table(top, tables.table_path(out, "ads", name))

    summary = versions.read(spark, root, "serving", "summary", version)
    side_by_side(spark, [
        *(partial(cut, name) for name in rollups.ADS_TABLES),
        lambda: tables.write_table(summary, tables.table_path(out, "serving", "summary")),
        lambda: tables.write_table(rollups.dataset_meta(summary, "demo"), tables.table_path(out, "serving", "meta"))])
    return extract_report(spark, root, out)


def extract_report(spark: SparkSession, root: str, out: str) -> DataFrame:
    def sizes(at: str, column: str) -> DataFrame:
        layout = [("ads", name) for name in rollups.ADS_TABLES]
        counts = [versions.read_table(spark, at, layer, name).agg(F.count("*").alias(column))
                  .withColumn("table", F.lit(name)) for layer, name in layout]
        merged = counts[0]
        for one in counts[1:]:
            merged = merged.unionByName(one)
        return merged

    both = sizes(out, "rows").join(sizes(root, "full_rows"), "table")
    return both.withColumn("pct", F.round(F.col("rows") * 100 / F.greatest("full_rows", F.lit(1)), 1))


def answer(spark: SparkSession, root: str, question: str) -> DataFrame | None:
    """The canned report a question asks for, over the stored tables; None where no topic fits."""
    asked = spark.createDataFrame([(question,)], "text string")
    topic = texts.keyword_route(asked).first().topic
    if topic is None:
        return None
    name, report = reports.QUESTIONS[topic]
    layer = "dwd" if name == "event_fact" else "ads"
    return texts.capped_answer(report(versions.read_table(spark, root, layer, name)))


def run_statement(spark: SparkSession, text: str) -> DataFrame:
    """Run a read-only statement over the registered views; refuse anything else."""
    checked = texts.sql_text_audit(spark.createDataFrame([(text,)], "text string")).first()
    if not checked.safe:
        raise ValueError(f"refused: {checked.reason}")
    reason = guard.refusal(spark, checked.statement)
    if reason:
        raise ValueError(f"refused: {reason}")
    return texts.capped_answer(spark.sql(checked.statement))


def write_quality_report(spark: SparkSession, root: str, path: str, day=None) -> DataFrame:
    """Check the stored tables, write the report as JSON and return its summary; stop the run on ``gate_open = false``."""
    scope = "all" if day is None else str(day)
    rules = quality.quality_rules(versions.read_table(spark, root, "ods", "events"),
                                  versions.read_table(spark, root, "dwd", "event_fact"), day)
    quality.quality_document(rules, scope).coalesce(1).write.mode("overwrite").json(path)
    document = spark.read.json(path)
    return document.select("scope", "summary.*").withColumn("gate_open", F.col("blocking_failed") == 0)
