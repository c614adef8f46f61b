"""Timeframes, bounds and page counts. Driver-side arithmetic, and the same as columns where queries need it."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The supported timeframes in seconds, and the candles in a page of the exchange.
SECONDS = {"1m": 60, "5m": 300, "15m": 900, "30m": 1800, "1h": 3600, "2h": 7200, "6h": 21600, "1d": 86400}
PAGE = 300
_FORMATS = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S")


def seconds(timeframe: str) -> int:
    if timeframe not in SECONDS:
        raise ValueError(f"unknown timeframe {timeframe!r}; known: {', '.join(SECONDS)}")
    return SECONDS[timeframe]


def minutes(timeframe: str) -> int:
    return seconds(timeframe) // 60


def ratio(timeframe: str, base: str) -> int:
    """How many base candles make one of the timeframe, which must be an exact multiple."""
    w, rest = divmod(seconds(timeframe), seconds(base))
    if rest or not w:
        raise ValueError(f"{timeframe} is not a multiple of {base}")
    return w


def is_base(timeframe: str, base: str) -> bool:
    """Whether candles of base make up the timeframe: it is an exact multiple. Unknown names are False, never an error."""
    try:
        return ratio(timeframe, base) >= 1
    except ValueError:
        return False


def naive_utc(value: str | date | datetime) -> datetime:
    """A bound as naive UTC: ISO text (with Z or an offset), the formats above, a date or a datetime."""
    if isinstance(value, str):
        text = value.strip()
        try:
            value = datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            for f in _FORMATS:
                try:
                    value = datetime.strptime(text, f)  # noqa: DTZ007
                    break
                except ValueError:
                    continue
            else:
                raise ValueError(f"cannot read {text!r} as a date") from None
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)  # noqa: DTZ001
    return value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value


def floor_to(moment: datetime, timeframe: str) -> datetime:
    """The open of the candle that moment lies in, counted from the epoch."""
    epoch = datetime(1970, 1, 1)  # noqa: DTZ001
    whole = (moment - epoch) // timedelta(seconds=seconds(timeframe))
    return epoch + timedelta(seconds=seconds(timeframe)) * whole


def bounds(start, end, timeframe: str) -> tuple[datetime | None, datetime | None]:
    """Inclusive bounds. The end is floored to a candle's open; midnight means the end of that day. The start stays as it is."""
    seconds(timeframe)
    lo = naive_utc(start) if start is not None else None
    hi = naive_utc(end) if end is not None else None
    if hi is not None:
        if (hi.hour, hi.minute, hi.second, hi.microsecond) == (0, 0, 0, 0):
            hi += timedelta(days=1, microseconds=-1)
        hi = floor_to(hi, timeframe)
    if lo is not None and hi is not None and lo > hi:
        raise ValueError(f"start {lo} is after end {hi}")
    return lo, hi


def expected_pages(start: datetime, end: datetime, timeframe: str, page: int = PAGE) -> int:
    span = max(0, int((end - start).total_seconds()))
    return max(1, -(-span // (seconds(timeframe) * page)))


def expected_candles(start: datetime, end: datetime, timeframe: str) -> int:
    return int((end - start).total_seconds()) // seconds(timeframe)


def expected_pages_column(start: Column, end: Column, step: Column, page: int = PAGE) -> Column:
    """expected_pages over columns: microsecond bounds as long, the timeframe's seconds."""
    span = F.greatest(F.lit(0), F.floor((end - start) / 1_000_000))
    return F.greatest(F.lit(1), F.ceil(span / (step * page))).cast("long")


#: The epoch as a timestamp without zone.
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def micros(ntz: Column) -> Column:
    """Microseconds since the epoch of a timestamp without zone that holds UTC. The session's time zone plays no part: nothing is cast to a timestamp with zone."""
    whole = F.unix_date(ntz.cast("date")).cast("long") * 86400 + F.hour(ntz) * 3600 + F.minute(ntz) * 60
    return whole * 1_000_000 + (F.date_part(F.lit("SECOND"), ntz) * 1_000_000).cast("long")


def at_micros(us: Column) -> Column:
    """The timestamp without zone that lies so many microseconds after the epoch; like micros, free of the session's time zone."""
    return F.expr(EPOCH) + F.make_dt_interval(secs=(us.cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)"))
