"""Rows for small tick tables."""

import datetime as dt

HK = 8 * 3_600_000


def hk_ms(day: str, clock: str) -> int:
    """Milliseconds of a local time such as ('20260216', '09:30:00')."""
    stamp = dt.datetime.strptime(f"{day} {clock}", "%Y%m%d %H:%M:%S")
    return int(stamp.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) - HK


def tick(symbol, day, ts_ms, seq=None, price=100.0, volume=100, turnover=10000.0, **other):
    row = {
        "market": "HK",
        "symbol": symbol,
        "ts_ms": ts_ms,
        "price": price,
        "volume": volume,
        "turnover": turnover,
        "direction": "BUY",
        "seq": seq,
        "tick_type": "AUTO_MATCH",
        "push_type": "push",
        "provider": "feed",
        "trading_day": day,
        "recv_ts_ms": ts_ms + 3,
        "inserted_at_ms": ts_ms + 3,
    }
    row.update(other)
    return row
