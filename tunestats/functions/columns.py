"""Scalar column functions (all built-in, JVM-side, codegen-friendly).

Every function takes and returns a ``Column`` so it can sit anywhere in a
``select`` / ``where`` / ``groupBy`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# These must equal the reference's for right results.
# Milliseconds per minute, as a decimal(6,1) literal, so that ms / 60000.0 is
# a decimal(28,7) per row (rounded half-up to 7 places) and its sum
# decimal(38,7).
MS_PER_MINUTE = Decimal("60000.0")
# Day parts by hour of day, inclusive ranges, in this order; any other hour
# (and a NULL hour) is "Night".
DAY_PARTS = (("Morning", 6, 11), ("Afternoon", 12, 17), ("Evening", 18, 23))
NIGHT = "Night"
# The single listener every aggregate is attributed to.
DEFAULT_USER = "default_user"
# Date formats: short weekday name, short month name, month bucket.
WEEKDAY_FORMAT = "E"
MONTH_NAME_FORMAT = "MMM"
MONTH_BUCKET_FORMAT = "yyyy-MM"
# Play key: SHA-2 digest length in bits.
PLAY_KEY_BITS = 256
# Rows in the ranking reports (artists, tracks) and in the top-genre query.
TOP_ARTISTS_ROWS = 100
TOP_TRACKS_ROWS = 100
TOP_GENRES_ROWS = 10
# ---------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(text: ColumnOrName) -> Column:
    """ISO-8601 text to TIMESTAMP; malformed or NULL text gives NULL (FN-1)."""
    return F.try_to_timestamp(_c(text))


def hour_of_day(ts: ColumnOrName) -> Column:
    """FN-2."""
    return F.hour(_c(ts))


def day_of_week_num(ts: ColumnOrName) -> Column:
    """FN-3: 1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_c(ts))


def weekday_name(ts: ColumnOrName) -> Column:
    """FN-4: short English weekday name (``Sun``)."""
    return F.date_format(_c(ts), WEEKDAY_FORMAT)


def month_name(ts: ColumnOrName) -> Column:
    """FN-5: short English month name (``Jan``)."""
    return F.date_format(_c(ts), MONTH_NAME_FORMAT)


def quarter(ts: ColumnOrName) -> Column:
    """FN-6."""
    return F.quarter(_c(ts))


def year(ts: ColumnOrName) -> Column:
    """FN-7."""
    return F.year(_c(ts))


def month_bucket(ts: ColumnOrName) -> Column:
    """FN-8: ``yyyy-MM``."""
    return F.date_format(_c(ts), MONTH_BUCKET_FORMAT)


def play_key_text(played_at: ColumnOrName, track_id: ColumnOrName) -> Column:
    """FN-9: the two parts concatenated with no separator. NULL when either
    part is NULL (``concat`` propagates NULL)."""
    return F.concat(_c(played_at), _c(track_id))


def hashed_key(text: ColumnOrName) -> Column:
    """FN-10: SHA-256 hex of a key's text."""
    return F.sha2(_c(text), PLAY_KEY_BITS)


def play_key(played_at: ColumnOrName, track_id: ColumnOrName) -> Column:
    """FN-9 + FN-10: SHA-256 hex of the two parts."""
    return hashed_key(play_key_text(played_at, track_id))


def minutes(ms: ColumnOrName) -> Column:
    """FN-11: milliseconds to decimal minutes, ``ms / 60000.0``."""
    return _c(ms) / F.lit(MS_PER_MINUTE)


def day_part(hour: ColumnOrName) -> Column:
    """FN-12 / FLT-2: Morning 6-11, Afternoon 12-17, Evening 18-23, else Night."""
    h = _c(hour)
    expr = None
    for name, lo, hi in DAY_PARTS:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(NIGHT))


def first_or_null(arr: ColumnOrName) -> Column:
    """SRC-7: first element of an array, NULL for a NULL or empty array."""
    return F.get(_c(arr), 0)


def nonempty_ids(arr: ColumnOrName, field: str = "id") -> Column:
    """SRC-8: map an array of structs to ``field`` and drop NULL / empty ids."""
    ids = F.transform(_c(arr), lambda a: a.getField(field))
    return F.filter(ids, lambda x: x.isNotNull() & (F.length(x) > 0))


def typed_null(data_type) -> Column:
    """FN-14: a NULL literal of a given type."""
    return F.lit(None).cast(data_type)
