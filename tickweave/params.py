"""Parameters of the operators, as frozen values passed by the caller."""

from __future__ import annotations

import re
from dataclasses import dataclass

# fixed values: the defaults of this and the classes below
DEFAULT_TZ = "Asia/Hong_Kong"
DEFAULT_SESSIONS = "09:30-12:00,13:00-16:00"

_HOUR, _MINUTE = r"(?:[01]?[0-9]|2[0-3])", r"[0-5]?[0-9]"
_ITEM = re.compile(
    rf"\s*(?P<h1>{_HOUR}):(?P<m1>{_MINUTE})\s*-\s*(?P<h2>{_HOUR}):(?P<m2>{_MINUTE})\s*"
)
_PLAIN = re.sub(r"\?P<\w+>", "?:", _ITEM.pattern)
_SPEC = re.compile(rf"(?:{_PLAIN}|\s*)(?:,(?:{_PLAIN}|\s*))*")


@dataclass(frozen=True)
class Session:
    """One trading session of the local day; the end is exclusive."""

    start_sec: int
    end_sec: int
    label: str


def parse_sessions(spec: str) -> tuple[Session, ...]:
    """``"09:30-12:00,13:00-16:00"`` to sessions; empty items are passed over.

    The whole text has to follow the grammar, hold a session, and each has to end after it starts.
    """
    if not _SPEC.fullmatch(spec):
        raise ValueError(f"not a list of sessions: {spec!r}")
    sessions = tuple(
        Session(_seconds(m["h1"], m["m1"]), _seconds(m["h2"], m["m2"]), m[0].strip())
        for m in _ITEM.finditer(spec)
    )
    if not sessions or any(s.start_sec >= s.end_sec for s in sessions):
        raise ValueError(f"no session, or one that ends before it starts: {spec!r}")
    return sessions


def _seconds(hour: str, minute: str) -> int:
    return int(hour) * 3600 + int(minute) * 60


@dataclass(frozen=True)
class QualityParams:
    """Thresholds of gap and stall detection.

    ``slice_ms`` cuts the time axis so that one very active symbol is spread over many tasks; it
    changes no result. It is widened to the activity window where that is longer.
    """

    gap_threshold_sec: float = 10.0
    active_window_sec: int = 300
    active_min_ticks: int = 50
    stall_warn_sec: float = 30.0
    tz: str = DEFAULT_TZ
    sessions: str = DEFAULT_SESSIONS
    slice_ms: int = 1_800_000

    @property
    def session_list(self) -> tuple[Session, ...]:
        return parse_sessions(self.sessions)

    @property
    def window_ms(self) -> int:
        return int(self.active_window_sec * 1000)


@dataclass(frozen=True)
class MicroParams:
    """Parameters of minute features, levels and microstructure events."""

    tz: str = DEFAULT_TZ
    bucket_ms: int = 60_000
    price_bin: float = 0.1
    tick_size: float = 0.01
    value_area: float = 0.70
    levels_mode: str = "same_day"
    eps: float = 1e-9
    short_ms: int = 3_600_000
    long_ms: int = 7_200_000
    min_history: int = 20
    accept_buckets: int = 2
    reject_ret_pctl: float = 0.70
    lvn_impact_factor: float = 2.0
    absorb_imbalance: float = 0.35
    absorb_ret_pctl: float = 0.30
    absorb_vol_pctl: float = 0.70
    absorb_near_ticks: int = 5
    init_ret_pctl: float = 0.80
    init_impact_pctl: float = 0.80
    vacuum_impact_pctl: float = 0.90
    vacuum_jumps: int = 1
    jump_ticks: int = 3
    open_auction: tuple[int, int] = (9 * 3600, 9 * 3600 + 20 * 60)
    open_confirm: tuple[int, int] = (9 * 3600 + 30 * 60, 9 * 3600 + 35 * 60)
    open_top3_share: float = 0.60
    close_auction: tuple[int, int] = (16 * 3600, 16 * 3600 + 10 * 60)
    close_share: float = 0.12
    close_distance: float = 0.25
    compress_ms: int = 900_000
    compress_range_pctl: float = 0.20
    compress_ticks_pctl: float = 0.30
    release_ms: int = 3_600_000
    calc_version: str = "1"


@dataclass(frozen=True)
class HealthParams:
    """Thresholds and cadences of health and alert processing."""

    tz: str = DEFAULT_TZ
    drift_warn_sec: int = 120
    quiet_cycles: int = 3
    quiet_p50_age_sec: float = 600.0
    quiet_p95_age_sec: float = 900.0
    fixed_interval_sec: int | None = None
    trading_interval_sec: int = 900
    offhours_interval_sec: int = 900
    preopen_interval_sec: int = 1800
    warn_cadence_sec: int = 600
    alert_cadence_sec: int = 180
    lunch_once: bool = True
    after_close_once: bool = True
    holiday_mode: str = "daily"
    alert_cooldown_sec: int = 600
    escalation_steps: tuple[int, ...] = (0, 600, 1800)
    stall_sec: int = 180
    upstream_window_sec: int = 60
    queue_threshold_rows: int = 100
