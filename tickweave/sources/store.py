"""Day-partitioned Parquet tables: ticks, gaps, daily quality, manifest.

Loads are idempotent on the row keys, and every load marks its batches, so a load repeated after a lost
executor, a failed job or a replayed micro-batch adds nothing. A mark is an empty file of its own, never
replaced. One writer per table is assumed.

An insert-or-ignore looks only at stored rows that a batch can collide with: the range of seqs, and of times
of seq-less rows, of each of its symbols is pushed down to the files' statistics, so what a micro-batch reads
follows from the batch and not from the day. The highest seq per day and symbol is a table of its own, raised
by each batch, in versions of which the last published one counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedupe
from ..schema import DAILY_QUALITY, GAPS, MANIFEST, TICK_COLUMNS, TICKS, conform, empty
from ..session import delete_folder, listed, path_exists, touch

#: A batch of more days and symbols than this is bounded by one range for all of them.
MOST_RANGES = 256
#: Batches of a load whose marks are kept, and versions of a day's highest seqs.
KEPT_MARKS = 8
BASELINE = "trading_day string, version bigint, symbol string, max_seq bigint"
FILE_PRINTS = "trading_day string, file string, ticks_count bigint, max_ts_ms bigint, row_hashes decimal(38,0)"
#: So many files are opened by name; more are found among those of their days.
MOST_FILES = 500
_FILE = r"(trading_day=[^/]+/[^/]+)$"
ROWS_PER_FILE = 4_000_000  # keeps files near 100 MB, so a checksum task can hold one


@dataclass(frozen=True)
class LoadResult:
    batch: int
    inserted: int

    @property
    def ignored(self) -> int:
        return max(0, self.batch - self.inserted)


def _found(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with a fixed schema; an absent path is an empty table."""
    found = _found(spark, path, schema)
    return empty(spark, schema) if found is None else found


def table_exists(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    return _found(spark, path, schema) is not None


def write_days(
    df: DataFrame, path: str, *, sort: Sequence[str] = (), mode: str = "append", codec: str = "zstd"
) -> None:
    """Write by trading day. The rebalance lets AQE merge small days into few files and split a day
    that holds much of the data over many tasks; the sort gives readers tight min/max ranges."""
    # a partition column that may be NULL would make the writer sort again and lose this order
    out = df.withColumn("trading_day", F.coalesce("trading_day", F.lit("")))
    out = out.hint("rebalance", "trading_day")
    if sort:
        out = out.sortWithinPartitions("trading_day", *sort)
    (
        out.write.mode(mode)
        .option("compression", codec)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("trading_day")
        .parquet(path)
    )


class TickStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def ticks_path(self) -> str:
        return f"{self.root}/ticks"

    @property
    def gaps_path(self) -> str:
        return f"{self.root}/gaps"

    @property
    def quality_path(self) -> str:
        return f"{self.root}/daily_quality"

    @property
    def baseline_path(self) -> str:
        return f"{self.root}/baseline"

    @property
    def prints_path(self) -> str:
        return f"{self.root}/file_prints"

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/manifest"

    def _days(self, table: DataFrame, days: Sequence[str] | None) -> DataFrame:
        return table if days is None else table.where(F.col("trading_day").isin(list(days)))

    def ticks(self, days: Sequence[str] | None = None) -> DataFrame:
        return self._days(read_table(self.spark, self.ticks_path, TICKS), days)

    def gaps(self, days: Sequence[str] | None = None) -> DataFrame:
        return self._days(read_table(self.spark, self.gaps_path, GAPS), days)

    def daily_quality(self) -> DataFrame:
        return read_table(self.spark, self.quality_path, DAILY_QUALITY)

    def manifest(self) -> DataFrame:
        return read_table(self.spark, self.manifest_path, MANIFEST)

    def has_ticks(self) -> bool:
        return table_exists(self.spark, self.ticks_path, TICKS)

    def has_gaps(self) -> bool:
        return table_exists(self.spark, self.gaps_path, GAPS)

    def _stored(self, table: DataFrame, batch: DataFrame) -> DataFrame:
        """Rows of the days that a batch can collide with: a join on its distinct days, so no day is
        listed anywhere and the planner may prune folders by them."""
        days = batch.select("trading_day").distinct()
        return table.join(days, "trading_day", "left_semi")

    def colliding(self, batch: DataFrame) -> DataFrame:
        """Stored ticks whose key a row of the batch may have: within the seqs and times that the batch has
        for their day and symbol. Files and pages beyond them are not read."""
        rows = batch.where(dedupe.storable(batch))
        alone = F.when(F.col("seq").isNull(), F.col("ts_ms"))
        ranges = [F.min("seq").alias("low"), F.max("seq").alias("high"), F.min(alone).alias("first"), F.max(alone).alias("last")]
        found = rows.groupBy("trading_day", "symbol").agg(*ranges).limit(MOST_RANGES + 1).collect()
        if len(found) > MOST_RANGES:
            found = [dict(trading_day=None, symbol=None, **rows.agg(*ranges).first().asDict())]
        near = F.lit(False)
        for r in found:
            within = F.lit(False)
            if r["low"] is not None:
                within = within | F.col("seq").between(r["low"], r["high"])
            if r["first"] is not None:
                within = within | (F.col("seq").isNull() & F.col("ts_ms").between(r["first"], r["last"]))
            if r["symbol"] is not None:
                within = (F.col("trading_day") == r["trading_day"]) & (F.col("symbol") == r["symbol"]) & within
            near = near | within
        return self._stored(self.ticks().where(near), batch)

    def append_ticks(
        self,
        batch: DataFrame,
        arrival: Sequence[str] = dedupe.ARRIVAL,
        load: str | None = None,
        epoch: int = 0,
    ) -> LoadResult:
        """Insert-or-ignore. Rows inserted are counted by the write itself.

        A ``load`` that names its batches by rising ``epoch`` numbers may repeat one: a batch that is
        marked as done adds nothing, and one that was begun is compared row by row, so that rows which
        equal no other are not added twice.
        """
        torn: list[int] = []
        if load is None:
            load, torn = "unnamed", self._torn("unnamed")
            epoch = self._next_epoch(load)
        state, since = self._begin(load, epoch)
        if state == "done":
            return LoadResult(batch.count(), 0)
        if self.has_ticks():
            fresh = dedupe.new_ticks(batch, self.colliding(batch), arrival)
            if state == "begun":
                fresh = dedupe.without_copies(fresh, self._written_since(since, batch))
        else:
            fresh = dedupe.dedupe_ticks(batch, arrival)
        written = Observation()
        fresh = conform(fresh, TICKS).observe(written, F.count(F.lit(1)).alias("n"))
        write_days(fresh, self.ticks_path, sort=("symbol", "ts_ms"))
        # nobody repeats a batch without a name: what a lost one left is taken from the ticks
        self._raise_baseline(self.ticks() if torn else batch)
        for done in [*torn, epoch]:
            self._mark(load, done, "done")
        try:
            inserted = written.get["n"]
        except Py4JJavaError:  # a plan found to be empty while it ran was dropped, and its count too
            inserted = 0
        return LoadResult(batch.count(), inserted)

    def _written_since(self, since: int, batch: DataFrame) -> DataFrame:
        """Rows of files written since a mark, of the batch's days."""
        rows = self.ticks().withColumn("_at", F.unix_millis("_metadata.file_modification_time"))
        return self._stored(rows.where(F.col("_at") >= since).drop("_at"), batch)

    def _mark(self, load: str, epoch: int, kind: str) -> None:
        """A mark of a batch; those of batches long done go."""
        folder = f"{self.root}/loads/{load}"
        touch(self.spark, f"{folder}/{epoch:019d}.{kind}")
        if kind == "done":
            for name in listed(self.spark, folder):
                if int(name.partition(".")[0]) <= epoch - KEPT_MARKS:
                    delete_folder(self.spark, f"{folder}/{name}")

    def _marks(self, load: str) -> dict[str, dict[int, int]]:
        """Epochs of a load's marks with their times, by kind."""
        marks: dict[str, dict[int, int]] = {"begun": {}, "done": {}}
        for name, at in listed(self.spark, f"{self.root}/loads/{load}").items():
            epoch, _, kind = name.partition(".")
            marks[kind][int(epoch)] = at
        return marks

    def _torn(self, load: str) -> list[int]:
        """Batches of a load that were begun and not done."""
        marks = self._marks(load)
        return sorted(set(marks["begun"]) - set(marks["done"]))

    def _next_epoch(self, load: str) -> int:
        marks = self._marks(load)
        return max([-1, *marks["begun"], *marks["done"]]) + 1

    def _begin(self, load: str, epoch: int) -> tuple[str, int]:
        """``done``, ``begun`` or ``new``, and when the batch was begun; marks it as begun."""
        marks = self._marks(load)
        if epoch <= max(marks["done"], default=-1):
            return "done", 0
        if epoch in marks["begun"]:
            return "begun", marks["begun"][epoch]
        self._mark(load, epoch, "begun")
        return "new", 0

    def unfinished(self) -> bool:
        """Whether some load ended within a batch that has not been repeated."""
        return any(self._torn(load) for load in listed(self.spark, f"{self.root}/loads"))

    def _published(self) -> int:
        names = listed(self.spark, f"{self.root}/baseline_versions")
        return max((int(name) for name in names), default=-1)

    def _versions(self, rows: DataFrame, upto: int) -> DataFrame:
        """Each day's newest published highest seqs."""
        rows = rows.where(F.col("version") <= upto)
        newest = rows.groupBy("trading_day").agg(F.max("version").alias("version"))
        rows = rows.join(newest, ["trading_day", "version"], "left_semi")
        # a version that was written in part before a failure is written again beside that part
        return rows.groupBy("trading_day", "symbol").agg(F.max("max_seq").alias("max_seq"))

    def _raise_baseline(self, batch: DataFrame) -> None:
        """Raise the highest seq per day and symbol by a batch; only its days get a new version."""
        version = self._published()
        raised = batch.where(dedupe.storable(batch)).groupBy("trading_day", "symbol").agg(
            F.max("seq").alias("max_seq")
        )
        stored = _found(self.spark, self.baseline_path, BASELINE)
        if stored is not None:
            before = self._stored(self._versions(stored, version), raised)
            raised = raised.unionByName(before).groupBy("trading_day", "symbol").agg(F.max("max_seq").alias("max_seq"))
        out = raised.withColumn("version", F.lit(version + 1)).hint("rebalance", "trading_day")
        out.write.mode("append").partitionBy("trading_day", "version").parquet(self.baseline_path)
        touch(self.spark, f"{self.root}/baseline_versions/{version + 1:019d}")
        for name in listed(self.spark, f"{self.root}/baseline_versions"):
            if int(name) <= version + 1 - KEPT_MARKS:
                delete_folder(self.spark, f"{self.root}/baseline_versions/{name}")

    def highest_seqs(self, days: Sequence[str] | None = None) -> DataFrame:
        """``trading_day, symbol, max_seq`` as the loads maintain it; NULL where no tick has a seq. After a
        load that ended within a batch it is taken from the ticks, until the batch is repeated."""
        stored = None if self.unfinished() else _found(self.spark, self.baseline_path, BASELINE)
        if stored is None:
            return self.ticks(days).groupBy("trading_day", "symbol").agg(F.max("seq").alias("max_seq"))
        return self._versions(self._days(stored, days), self._published())

    def persisted_seqs(self, recent: int = 3) -> DataFrame:
        """The highest stored seq per symbol over the newest days, from the maintained table."""
        from ..operators.stats import recent_max_seq

        return recent_max_seq(self.highest_seqs().withColumnRenamed("max_seq", "seq"), None, recent=recent)

    def drop_old_versions(self) -> None:
        """Delete versions of the highest seqs that a newer published one of their day replaces."""
        upto = self._published()
        for day in listed(self.spark, self.baseline_path):
            found = [n for n in listed(self.spark, f"{self.baseline_path}/{day}") if n.startswith("version=")]
            numbers = sorted(int(n.partition("=")[2]) for n in found)
            for number in [n for n in numbers if n <= upto][:-2]:
                delete_folder(self.spark, f"{self.baseline_path}/{day}/version={number}")

    def day_prints(self, days: Sequence[str] | None = None) -> DataFrame:
        """Per day: rows, largest time and the sum of row hashes, added up from a table of the day's files.

        A file never changes, so each is read once for this, whoever asks first; files that went since
        do not count. What is listed are names, of these days only.
        """
        return file_sums(self.spark, self.ticks_path, self.prints_path, days)

    def compact_days(self, days: Sequence[str]) -> None:
        """Rewrite the many small files of streamed days as few. Rows are copied aside first, so a run
        that fails can be repeated; no load may write to these days meanwhile."""
        aside = f"{self.root}/aside/ticks"
        write_days(self.ticks(days), aside, mode="overwrite")
        copied = self._days(read_table(self.spark, aside, TICKS), days)
        write_days(copied, self.ticks_path, sort=("symbol", "ts_ms"), mode="overwrite")
        for day in days:
            delete_folder(self.spark, f"{aside}/trading_day={day}")

    def append_gaps(self, gaps: DataFrame) -> None:
        fresh = dedupe.new_gaps(gaps, self._stored(self.gaps(), gaps))
        write_days(conform(fresh, GAPS), self.gaps_path, sort=("symbol", "gap_start_ts_ms"))

    def upsert_daily_quality(self, rows: DataFrame) -> None:
        """Last writer wins per day: only the days of ``rows`` are overwritten."""
        last = Window.partitionBy("trading_day").orderBy(F.col("created_at_ms").desc())
        newest = rows.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")
        write_days(conform(newest, DAILY_QUALITY), self.quality_path, mode="overwrite")

    def recent_trading_days(self, limit: int = 3) -> DataFrame:
        from ..operators.stats import recent_days

        return recent_days(self.ticks(), limit)

    def fetch_max_seq_by_symbol(self, day: str, symbols: Sequence[str]) -> DataFrame:
        return dedupe.max_seq_by_symbol(self.ticks([day]), symbols)

    def fetch_max_seq_by_symbol_recent(
        self, symbols: Sequence[str], days: Sequence[str] | None = None, recent: int = 3
    ) -> DataFrame:
        from ..operators.stats import recent_max_seq

        return recent_max_seq(self.ticks(), symbols, days, recent)

    def fetch_tick_stats(self, day: str) -> DataFrame:
        return self.ticks([day]).agg(
            F.count(F.lit(1)).alias("rows"), F.max("ts_ms").alias("max_ts_ms")
        )


def day_files(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """The Parquet files of a table with their content, of some days or of all; other days' folders
    are not listed. Without any such folder there is no row."""
    folder = path if days is None else f"{path}/trading_day={{{','.join(days)}}}"
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if days != [] and path_exists(spark, folder):
        return reader.load(folder)
    nothing = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.createDataFrame([], nothing)


def row_sums(ticks: DataFrame, *keys: str) -> DataFrame:
    """Rows, largest time and an order-free sum of row hashes per key; sums of parts add up."""
    return ticks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("ticks_count"),
        F.max("ts_ms").alias("max_ts_ms"),
        F.sum(F.xxhash64(*TICK_COLUMNS).cast("decimal(20,0)")).cast("decimal(38,0)").alias("row_hashes"),
    )


def file_sums(spark: SparkSession, path: str, kept: str, days: Sequence[str] | None = None) -> DataFrame:
    """``row_sums`` per day of a tick table, from the sums per file kept in the table ``kept``. Files that it
    lacks are read, and added to it."""
    files = day_files(spark, path, days).select(F.regexp_extract("path", _FILE, 1).alias("file"))
    prints = _found(spark, kept, FILE_PRINTS)
    known = files.limit(0) if prints is None else prints.select("file")
    fresh = files.join(known, "file", "left_anti")
    names = [r["file"] for r in fresh.limit(MOST_FILES + 1).collect()]
    if names:
        if len(names) <= MOST_FILES:
            rows = spark.read.schema(TICKS).option("basePath", path).parquet(*[f"{path}/{name}" for name in names])
        else:
            rows = read_table(spark, path, TICKS)
            rows = rows if days is None else rows.where(F.col("trading_day").isin(list(days)))
        rows = rows.withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), _FILE, 1))
        if len(names) > MOST_FILES:
            rows = rows.join(fresh, "file", "left_semi")
        row_sums(rows, "trading_day", "file").coalesce(1).write.mode("append").parquet(kept)
        prints = _found(spark, kept, FILE_PRINTS)
    if prints is None:
        prints = spark.createDataFrame([], FILE_PRINTS)
    # two writers may both have added a file
    each = prints.join(files, "file", "left_semi").dropDuplicates(["file"])
    return each.groupBy("trading_day").agg(
        F.sum("ticks_count").alias("ticks_count"),
        F.max("max_ts_ms").alias("max_ts_ms"),
        F.sum("row_hashes").cast("string").alias("content_hash"),
    )


def footprint(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """Files and bytes per trading day, from a file listing; no file content is read."""
    files = day_files(spark, path, days).select("path", "length")
    day = F.regexp_extract("path", r"trading_day=([^/]+)", 1)
    return files.groupBy(day.alias("trading_day")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
