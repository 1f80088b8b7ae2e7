"""Time and date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86_400_000_000


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(value: str | dt.date) -> dt.date:
    """Validate a run/override date up front (``YYYY-MM-DD``)."""
    if isinstance(value, dt.date):
        return value
    try:
        return dt.date.fromisoformat(str(value).strip())
    except ValueError as exc:
        raise ValueError(f"not an ISO date (YYYY-MM-DD): {value!r}") from exc


def iso_utc(ts: Column | str) -> Column:
    """Instant -> ISO-8601 text in UTC with microseconds and ``+00:00``.
    Computed from the instant itself, so the session zone plays no part."""
    micros = F.pmod(F.unix_micros(_c(ts).cast("timestamp")), F.lit(_DAY))
    seconds = F.floor(micros / 1_000_000)
    return F.when(micros.isNotNull(), F.format_string(
        "%sT%02d:%02d:%02d.%06d+00:00", utc_date(ts).cast("string"), F.floor(seconds / 3600),
        F.floor(seconds / 60) % 60, seconds % 60, micros % 1_000_000))


def utc_date(ts: Column | str) -> Column:
    """The UTC calendar date of an instant, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(_c(ts).cast("timestamp")) / _DAY).cast("int"))


def utc_midnight(ts: Column | str) -> Column:
    """The instant at which the UTC day of ``ts`` begins."""
    micros = F.unix_micros(_c(ts).cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(_DAY)))


def epoch_ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds -> timestamp truncated to whole seconds."""
    return F.timestamp_seconds(F.floor(_c(ms) / 1000))


def add_seconds(ts: Column | str, seconds: Column | str | int) -> Column:
    n = F.lit(seconds) if isinstance(seconds, int) else _c(seconds)
    return F.timestamp_add("SECOND", n, _c(ts))
