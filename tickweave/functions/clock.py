"""Time expressions. Stored times are UTC milliseconds; local fields come from integer arithmetic.

All functions return Columns, need a session time zone of UTC, and never read the wall clock: the
current time is always passed in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT_TZ, Session

DAY_MS = 86_400_000

# fixed values: a feed that stamps local time as UTC is eight hours ahead
FUTURE_GUARD_MS = 7_200_000
ZONE_SHIFT_MS = 28_800_000
SHIFT_TOLERANCE_MS = 1_800_000

# fixed values: bounds between compact clock, epoch seconds and epoch milliseconds
EPOCH_MS_ABOVE = 1_000_000_000_000
EPOCH_SEC_ABOVE = 1_000_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def local_ms(ts_ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Milliseconds of the local wall clock, counted as if the clock were UTC."""
    ts = _c(ts_ms)
    if tz == "UTC":
        return ts
    return F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(ts), tz))


def second_of_day(ts_ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Local seconds since midnight, with the milliseconds as fraction kept out."""
    return F.floor(F.pmod(local_ms(ts_ms, tz), F.lit(DAY_MS)) / 1000).cast("int")


def weekday(ts_ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """0 = Monday .. 6 = Sunday of the local date."""
    days = F.floor(local_ms(ts_ms, tz) / DAY_MS).cast("bigint")
    return F.pmod(days + 3, F.lit(7)).cast("int")


def normalize_day(value: Column | str) -> Column:
    """Trim, empty to NULL, eight digits kept, else drop dashes, else drop slashes; no padding."""
    text = F.trim(_c(value).cast("string"))
    return (
        F.when(text == "", F.lit(None).cast("string"))
        .when(text.rlike(r"^\d{8}$"), text)
        .when(F.instr(text, "-") > 0, F.replace(text, F.lit("-"), F.lit("")))
        .otherwise(F.replace(text, F.lit("/"), F.lit("")))
    )


def calendar_day(value: Column | str) -> Column:
    """Dashes and slashes removed; NULL unless eight digits remain."""
    text = F.regexp_replace(F.trim(_c(value)), "[-/]", "")
    return F.when(text.rlike(r"^\d{8}$"), text)


def trading_day(ts_ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(_c(ts_ms)), tz), "yyyyMMdd")


def dashed_day(day: Column | str) -> Column:
    return F.regexp_replace(_c(day), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")


def local_text(ts_ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    local = F.from_utc_timestamp(F.timestamp_millis(_c(ts_ms)), tz)
    return F.coalesce(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit("n/a"))


def local_to_utc_ms(local: Column, tz: str = DEFAULT_TZ) -> Column:
    """A timestamp holding market-local wall time to UTC milliseconds."""
    return F.unix_millis(F.to_utc_timestamp(local, tz))


def repair_zone_shift(ts_ms: Column, now_ms: Column) -> Column:
    """Undo a stamp that is about one zone offset ahead of its receive time."""
    drift = ts_ms - now_ms
    shifted = (drift > FUTURE_GUARD_MS) & (
        F.abs(drift - ZONE_SHIFT_MS) <= SHIFT_TOLERANCE_MS
    )
    return F.when(shifted, ts_ms - ZONE_SHIFT_MS).otherwise(ts_ms)


_DAY_PARTS = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[0-1]|[1-2]\d|0[1-9]|[1-9])$"
_ZONED = r":\d{2}(\.\d+)?(Z|[+-]\d{2}(:?\d{2})?)$"


def _padded_day(day: Column) -> Column:
    """A compact day with optional one-digit month and day, as yyyyMMdd; NULL where it is none."""
    part = lambda i: F.regexp_extract(day, _DAY_PARTS, i)
    return F.when(F.length(day) == 8, day).when(
        day.rlike(_DAY_PARTS),
        F.concat(part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")),
    )


def with_time(
    df: DataFrame,
    out: str,
    value: Column,
    day: Column,
    now_ms: Column,
    *,
    is_number: Column | bool = False,
    tz: str = DEFAULT_TZ,
) -> DataFrame:
    """Adds ``out``: the feed time ``value`` (as text) in UTC milliseconds, NULL where unreadable.

    ``day`` completes a bare clock; without it the local day of ``now_ms`` is taken. Numbers and text
    differ: fourteen digits are a full date-time as text, but epoch milliseconds as a number. Naive
    text is market-local; an offset or Z overrides that. The steps are separate columns, so each is
    computed once per row.
    """
    number_row = F.lit(is_number) if isinstance(is_number, bool) else is_number
    staged = df.withColumns(
        {
            "_now": now_ms.cast("bigint"),
            "_text": F.trim(value),
            "_number_row": number_row,
            "_given": normalize_day(day),
        }
    )
    text = F.col("_text")
    dated = (F.instr(text, "-") > 0) | (F.instr(text, "/") > 0) | (F.instr(text, " ") > 0)
    staged = staged.withColumns(
        {
            "_digits": text.rlike(r"^\d+$"),
            "_iso": F.when(
                dated & ~F.col("_number_row"), F.replace(text, F.lit("T"), F.lit(" "))
            ),
        }
    )
    short = F.col("_digits") & (F.length(text) <= 6)
    bare_clock = ~F.col("_digits") & F.col("_iso").isNull() & ~F.col("_number_row")
    staged = staged.withColumns(
        {
            "_num": F.when(F.col("_digits"), text.try_cast("bigint")),
            "_day8": F.when(
                short | bare_clock,
                _padded_day(F.coalesce("_given", trading_day("_now", tz))),
            ),
            "_is_zoned": F.col("_iso").rlike(_ZONED),
        }
    )
    six = F.when(F.length(text) <= 6, F.lpad(text, 6, "0"))
    fourteen = F.when((F.length(text) == 14) & ~F.col("_number_row"), text)
    staged = staged.withColumns(
        {
            "_compact": F.when(
                F.col("_digits"),
                F.coalesce(
                    F.when(six.isNotNull(), F.concat("_day8", six)),
                    fourteen,
                ),
            ),
            "_epoch": F.when(
                F.col("_digits") & six.isNull() & fourteen.isNull(),
                F.when(F.col("_num") > EPOCH_MS_ABOVE, F.col("_num")).otherwise(
                    F.col("_num") * 1000
                ),
            ),
            "_zoned": F.when(F.col("_is_zoned"), F.col("_iso")),
            "_local": F.when(~F.col("_is_zoned"), F.replace("_iso", F.lit("/"), F.lit("-"))),
            "_clock": F.when(bare_clock, F.concat_ws(" ", F.col("_day8"), text)),
        }
    )
    wall = F.coalesce(
        F.try_to_timestamp("_compact", F.lit("yyyyMMddHHmmss")),
        F.try_to_timestamp("_clock", F.lit("yyyyMMdd H:m:s[.SSSSSS]")),
        F.try_to_timestamp("_local", F.lit("yyyy-M-d H:m:s[.SSSSSSSSS]")),
        F.try_to_timestamp("_local", F.lit("yyyy-MM-dd[ HH:mm]")),
    )
    zoned = F.try_to_timestamp(
        "_zoned", F.lit("yyyy-MM-dd HH:mm[:ss][.SSSSSSSSS][XXX][XX][X]")
    )
    parsed = F.coalesce("_epoch", local_to_utc_ms(wall, tz), F.unix_millis(zoned))
    # a generator output: without it a later filter on the time (or on the reject reason) would be
    # pushed below these steps and would repeat the whole parse inside one huge predicate
    staged = staged.select("*", F.inline(F.array(F.struct(parsed.alias("_parsed")))))
    return staged.withColumn(out, repair_zone_shift(F.col("_parsed"), F.col("_now"))).drop(
        "_now", "_text", "_number_row", "_given", "_day8", "_digits", "_iso", "_is_zoned", "_num",
        "_compact", "_epoch", "_zoned", "_local", "_clock", "_parsed",
    )


def session_index(
    ts_ms: Column | str, sessions: tuple[Session, ...], tz: str = DEFAULT_TZ
) -> Column:
    """Index of the first session holding the local time; NULL on weekends and outside."""
    local = local_ms(ts_ms, tz)
    second = F.pmod(local, F.lit(DAY_MS))
    chain = None
    for index, session in enumerate(sessions):
        inside = (second >= session.start_sec * 1000) & (second < session.end_sec * 1000)
        chain = (
            F.when(inside, F.lit(index)) if chain is None else chain.when(inside, F.lit(index))
        )
    workday = F.pmod(F.floor(local / DAY_MS).cast("bigint") + 3, F.lit(7)) < 5
    return F.when(workday, chain)


def session_label(index: Column, sessions: tuple[Session, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(s.label) for s in sessions]), index + 1)


# fixed values: local seconds of the market phases
PRE_OPEN_SEC = 9 * 3600
OPEN_SEC = 9 * 3600 + 1800
LUNCH_SEC = 12 * 3600
REOPEN_SEC = 13 * 3600
CLOSE_SEC = 16 * 3600


def market_phase(
    ts_ms: Column | str, is_holiday: Column | None = None, tz: str = DEFAULT_TZ
) -> Column:
    """pre-open, open, lunch-break, after-hours or holiday-closed; weekends win over holidays."""
    sec = second_of_day(ts_ms, tz)
    holiday = F.lit(False) if is_holiday is None else F.coalesce(is_holiday, F.lit(False))
    return (
        F.when(weekday(ts_ms, tz) >= 5, "after-hours")
        .when(holiday, "holiday-closed")
        .when((sec >= PRE_OPEN_SEC) & (sec < OPEN_SEC), "pre-open")
        .when((sec >= OPEN_SEC) & (sec < LUNCH_SEC), "open")
        .when((sec >= LUNCH_SEC) & (sec < REOPEN_SEC), "lunch-break")
        .when((sec >= REOPEN_SEC) & (sec < CLOSE_SEC), "open")
        .otherwise("after-hours")
    )


def is_trading_day(
    ts_ms: Column | str, is_holiday: Column | None = None, tz: str = DEFAULT_TZ
) -> Column:
    holiday = F.lit(False) if is_holiday is None else F.coalesce(is_holiday, F.lit(False))
    return (weekday(ts_ms, tz) < 5) & ~holiday


def seconds_to_open(ts_ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    ms = OPEN_SEC * 1000 - F.pmod(local_ms(ts_ms, tz), F.lit(DAY_MS))
    return F.greatest(F.lit(0), F.floor(ms / 1000)).cast("bigint")


def seconds_since_close(ts_ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    ms = F.pmod(local_ms(ts_ms, tz), F.lit(DAY_MS)) - CLOSE_SEC * 1000
    return F.greatest(F.lit(0), F.floor(ms / 1000)).cast("bigint")


def within_lookback(day: Column | str, today: Column, max_days: int) -> Column:
    """A YYYYMMDD day that is neither in the future nor more than ``max_days`` back."""
    as_date = lambda c: F.try_to_timestamp(c, F.lit("yyyyMMdd")).cast("date")
    age = F.date_diff(as_date(today), as_date(calendar_day(day)))
    return F.coalesce(age.between(0, max_days), F.lit(False))
