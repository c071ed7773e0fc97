"""Text, severity and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def market_of(code: Column | str) -> Column:
    """Text before the first dot, ``HK`` without a dot."""
    text = _c(code)
    return F.when(F.instr(text, ".") > 0, F.substring_index(text, ".", 1)).otherwise("HK")


def clean_text(value: Column | str) -> Column:
    return F.nullif(F.trim(_c(value).cast("string")), F.lit(""))


def to_long(value: Column | str) -> Column:
    """Whole-number text or a number, truncated; anything else is NULL."""
    return _c(value).try_cast("bigint")


def to_float(value: Column | str) -> Column:
    """NaN becomes NULL, as the store keeps no NaN."""
    number = _c(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def first_set(*candidates: Column, numeric: bool = False) -> Column:
    """The first value that is neither NULL nor empty (0 for numbers); else the last one as it is."""
    *heads, last = candidates
    hollow = F.lit(0) if numeric else F.lit("")
    return F.coalesce(*[F.nullif(c, hollow) for c in heads], last)


# fixed values: characters kept in an export file name
_STEM_OTHER = r"[^A-Za-z0-9._-]+"


def file_stem(symbol: Column | str) -> Column:
    stem = F.regexp_replace(_c(symbol), _STEM_OTHER, "_")
    stem = F.regexp_replace(stem, r"^[._]+|[._]+$", "")
    return F.when(stem == "", "UNKNOWN").otherwise(stem)


# fixed values: accepted symbol names
SYMBOL_PATTERN = r"^[A-Za-z0-9._-]{2,24}$"


def is_symbol_name(symbol: Column | str) -> Column:
    return F.upper(F.trim(_c(symbol))).rlike(SYMBOL_PATTERN)


# fixed values: KPI patterns of status lines
LAG_PATTERN = r"(lag|lag_sec|drift|drift_sec)[=:]([0-9.]+)"
PERSIST_PATTERN = r"(persisted_per_min|persisted|min|write|write_per_min)[=:]([0-9.]+)"
QUEUE_PATTERN = r"queue[=:]([0-9]+/[0-9]+)"


def kpi_lag(text: Column | str) -> Column:
    """First lag or drift value in line order."""
    found = F.regexp_extract(_c(text), LAG_PATTERN, 2)
    return F.when(found == "", "n/a").otherwise(F.concat(found, F.lit("s")))


def kpi_persisted(text: Column | str) -> Column:
    found = F.regexp_extract(_c(text), PERSIST_PATTERN, 2)
    return F.when(found == "", "n/a").otherwise(F.concat(found, F.lit("/min")))


def kpi_queue(text: Column | str) -> Column:
    found = F.regexp_extract(_c(text), QUEUE_PATTERN, 1)
    return F.when(found == "", "n/a").otherwise(found)


# fixed values: secrets masked in shown text
BOT_TOKEN_PATTERN = r"(?U)\b\d{8,}:[A-Za-z0-9_-]{20,}\b"
TOKEN_PAIR_PATTERN = r"(?iU)token\s*[=:]\s*\S+"


def redact(text: Column | str) -> Column:
    masked = F.regexp_replace(_c(text), BOT_TOKEN_PATTERN, "[REDACTED_TOKEN]")
    return F.regexp_replace(masked, TOKEN_PAIR_PATTERN, "token=[REDACTED]")


# fixed values: log line filters
OPS_LOG_PATTERN = "health|health_symbols_rollup|persist_summary|WATCHDOG|ERROR|Traceback|telegram_|sqlite_busy|poll_stats|persist_ticks"  # noqa: E501
CORE_LOG_PATTERN = "health|persist_summary|WATCHDOG|ERROR|Traceback|telegram_send_failed|telegram_alert_suppressed"  # noqa: E501
CHAT_LOG_PATTERN = "(ERROR|WARN|WATCHDOG|persist|sqlite_busy|alert_event)"
ALERT_LINE_PATTERN = r"severity=(WARN|ALERT)|WATCHDOG|alert_event code="
HEALTH_LINE_TEXT = "health sid="
STARTED_LINE_TEXT = "telegram_notifier_started"
SCHEMA_LINE_TEXT = "notify_schema="
HEALTH_SENT_TEXT = "telegram_enqueue kind=HEALTH"
WARNING_SENT_PATTERN = "telegram_enqueue kind=.* severity=(WARN|ALERT)"

LOG_TIME_PATTERN = r"^\[?(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:[.,]\d{1,6})?)"


def severity_rank(value: Column | str) -> Column:
    """OK 0, WARN 1, ALERT 2; unknown text counts as OK."""
    text = F.upper(F.trim(_c(value)))
    return F.when(text == "ALERT", 2).when(text == "WARN", 1).otherwise(0)


def queue_utilisation_pct(size: Column | str, capacity: Column | str) -> Column:
    return F.when(_c(capacity) <= 0, F.lit(0.0)).otherwise(_c(size) / _c(capacity) * 100.0)


def write_efficiency_pct(persisted: Column | str, push: Column | str, poll: Column | str) -> Column:
    floor0 = lambda c: F.greatest(F.lit(0), _c(c))
    ingest = F.greatest(F.lit(1), floor0(push) + floor0(poll))
    return F.least(F.lit(999.0), floor0(persisted) / ingest * 100.0)
