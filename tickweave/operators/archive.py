"""Archive days, verify them, and select days to retire."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..params import QualityParams
from ..schema import CHECKSUMS, MANIFEST, TICKS, conform
from ..session import delete_folder


def _fingerprint(ticks: DataFrame) -> DataFrame:
    """Per day: count, largest time, and an order-free sum of row hashes."""
    from ..sources.store import row_sums

    sums = row_sums(ticks, "trading_day")
    return sums.withColumn("content_hash", F.col("row_hashes").cast("string")).drop("row_hashes")


def archived_prints(spark: SparkSession, root: str, days: Sequence[str] | None = None) -> DataFrame:
    """Fingerprints of archived days; each archived file is read once for them."""
    from ..sources.store import file_sums

    return file_sums(spark, f"{root}/ticks", f"{root}/file_prints", days)


def archived_ticks(spark: SparkSession, root: str) -> DataFrame:
    from ..sources.store import read_table

    return read_table(spark, f"{root}/ticks", TICKS)


def checksums(spark: SparkSession, root: str, days: Sequence[str] | None = None) -> DataFrame:
    """sha256 and size of each archived file, one file per record; only the files of ``days`` are read."""
    from ..sources.store import day_files

    files = day_files(spark, f"{root}/ticks", days)
    return files.select(
        F.regexp_extract("path", r"trading_day=([^/]+)", 1).alias("trading_day"),
        F.regexp_extract("path", r"(trading_day=.*)$", 1).alias("file"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def recorded_checksums(
    spark: SparkSession, root: str, days: Sequence[str] | None = None
) -> DataFrame:
    from ..sources.store import read_table

    recorded = read_table(spark, f"{root}/checksums", CHECKSUMS)
    return recorded if days is None else recorded.where(F.col("trading_day").isin(list(days)))


def verify_checksums(
    spark: SparkSession, root: str, days: Sequence[str] | None = None
) -> DataFrame:
    """Recorded checksums against the files as they are now; a lost or changed file fails."""
    recorded = recorded_checksums(spark, root, days)
    now = checksums(spark, root, days).select("file", F.col("sha256").alias("_now"))
    return recorded.join(now, "file", "left").withColumn(
        "checksum_ok", F.coalesce(F.col("_now") == F.col("sha256"), F.lit(False))
    )


def verify(source: DataFrame, archived: DataFrame) -> DataFrame:
    """Archived days read back and compared with the source: count, largest time, row hashes."""
    return compare_prints(_fingerprint(source), _fingerprint(archived))


def compare_prints(src: DataFrame, arc: DataFrame) -> DataFrame:
    """Fingerprints of archived days with ``verify_ok``: whether those of the source are the same."""
    want = src.select(
        "trading_day", *[F.col(c).alias(f"_{c}") for c in src.columns if c != "trading_day"]
    )
    same = F.lit(True)
    for name in ("ticks_count", "max_ts_ms", "content_hash"):
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return arc.join(want, "trading_day", "left").select(
        *arc.columns, same.alias("verify_ok")
    )


def archive_days(
    store,
    root: str,
    params: QualityParams,
    now_ms: int,
    days: Sequence[str] | None = None,
    compression: str = "zstd",
    host: str | None = None,
) -> DataFrame:
    """Copy days, record file checksums, verify, and write one manifest row per day.

    All days go in one job. A repeated run replaces the same days, so it can be restarted. Checksums
    are taken of the files of these days only, and those of other days stay as recorded.
    """
    from ..sources.store import write_days
    from .quality import daily_report

    spark = store.spark
    codec = compression.strip().lower()
    if codec not in ("zstd", "none"):
        raise ValueError(f"unsupported compression: {compression}")
    ticks = store.ticks(days)
    write_days(ticks, f"{root}/ticks", sort=("symbol", "ts_ms"), mode="overwrite", codec=codec)
    write_days(checksums(spark, root, days), f"{root}/checksums", sort=("file",), mode="overwrite")
    # the source's fingerprints are kept by the store, so the source is read for the copy and the report
    checked = compare_prints(store.day_prints(days), archived_prints(spark, root, days))
    report = daily_report(ticks, store.gaps(days), params, now_ms)
    summary = report.select(
        "trading_day", "total_rows", "start_ts_ms", "end_ts_ms", "hard_gaps_total",
        "hard_gaps_total_sec", "quality_grade",
    )
    # a day has few files, so their checksums are listed
    each = F.sort_array(F.collect_list(F.struct("file", "sha256")))
    files = (
        recorded_checksums(spark, root, days)
        .groupBy("trading_day")
        .agg(
            F.sum("bytes").alias("archive_bytes"),
            F.sha2(F.to_json(each), 256).alias("archive_sha256"),
        )
    )
    manifest = checked.join(summary, "trading_day", "left").join(files, "trading_day", "left")
    manifest = manifest.withColumns(
        {
            "created_at_ms": F.lit(now_ms).cast("bigint"),
            "archive_path": F.concat(F.lit(f"{root}/ticks/trading_day="), "trading_day"),
            "compression": F.lit(codec),
            "host": F.lit(host or spark.conf.get("spark.driver.host", "")),
            "source_path": F.concat(F.lit(f"{store.ticks_path}/trading_day="), "trading_day"),
        }
    )
    write_days(conform(manifest, MANIFEST), store.manifest_path, mode="overwrite")
    return store.manifest()


def verified_days(days: DataFrame, manifest: DataFrame) -> DataFrame:
    return days.join(manifest.where("verify_ok").select("trading_day"), "trading_day", "left_semi")


def unchanged_days(prints: DataFrame, manifest: DataFrame) -> DataFrame:
    """Days whose stored rows are, now, those that were archived and verified: count, largest time and
    row hashes."""
    marks = ["ticks_count", "max_ts_ms", "content_hash"]
    archived = manifest.where("verify_ok").select("trading_day", *[F.col(m).alias(f"_{m}") for m in marks])
    same = F.lit(True)
    for name in marks:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return prints.join(archived, "trading_day").where(same).select("trading_day")


def older_days(days: DataFrame, manifest: DataFrame, keep_days: int) -> list[str]:
    """Names beyond the newest ``keep_days`` that are archived and verified; one name per day."""
    days = days.select("trading_day").distinct().where(F.col("trading_day").rlike(r"^\d{8}$"))
    rank = F.row_number().over(Window.orderBy(F.col("trading_day").desc()))
    older = days.withColumn("_rank", rank).where(F.col("_rank") > max(0, keep_days)).drop("_rank")
    return sorted(r[0] for r in verified_days(older, manifest).collect())


def expired_days(
    ticks: DataFrame,
    manifest: DataFrame,
    keep_days: int,
    root: str | None = None,
    prints: Callable[[list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Days beyond the newest ``keep_days`` that are archived as they are now. Selecting only; deleting
    is up to the caller.

    A day that got rows since its archive is not selected. With the archive's ``root``, every recorded
    file of the day has to be there and to have its checksum. Only days that may go are looked into:
    ``prints`` gives their fingerprints (``TickStore.day_prints``, which reads new files only); without it
    the ticks of those days are read.
    """
    spark = ticks.sparkSession
    names = older_days(ticks, manifest, keep_days)
    found = prints(names) if prints else _fingerprint(ticks.where(F.col("trading_day").isin(names)))
    older = unchanged_days(found, manifest).where(F.col("trading_day").isin(names))
    if root is None:
        return older
    checked = verify_checksums(spark, root, names).groupBy("trading_day")
    intact = checked.agg(F.bool_and("checksum_ok").alias("_ok")).where("_ok")
    return older.join(intact.select("trading_day"), "trading_day", "left_semi")


def expired_stored_days(store, root: str, keep_days: int) -> DataFrame:
    """``expired_days`` of a store from names and kept fingerprints: of the ticks, only files of days that
    may go and that no fingerprint covers yet are read."""
    from ..sources.store import day_files

    names = day_files(store.spark, store.ticks_path).select(
        F.regexp_extract("path", r"trading_day=([^/]+)", 1).alias("trading_day")
    )
    return expired_days(names, store.manifest(), keep_days, root, store.day_prints)


def delete_expired(store, manifest: DataFrame, keep_days: int, root: str) -> list[str]:
    """Delete the day folders chosen by ``expired_days`` and name them. Opt-in: nothing else deletes.

    Only day names are brought to the driver; a day is one folder below the tick table.
    """
    chosen = expired_days(store.ticks(), manifest, keep_days, root, store.day_prints)
    days = sorted(r[0] for r in chosen.collect())
    for day in days:
        delete_folder(store.spark, f"{store.ticks_path}/trading_day={day}")
    return days


def pending_days(requested: DataFrame, done: DataFrame, *, force: bool = False) -> DataFrame:
    """Requested days without a completion mark; ``force`` takes them all."""
    if force:
        return requested
    return requested.join(done.select("trading_day"), "trading_day", "left_anti")
