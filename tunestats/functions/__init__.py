"""Column-level functions (FN-*, SRC-7, SRC-8)."""

from tunestats.functions.columns import (  # noqa: F401
    DAY_PARTS,
    DEFAULT_USER,
    MONTH_BUCKET_FORMAT,
    MONTH_NAME_FORMAT,
    MS_PER_MINUTE,
    NIGHT,
    PLAY_KEY_BITS,
    TOP_ARTISTS_ROWS,
    TOP_GENRES_ROWS,
    TOP_TRACKS_ROWS,
    WEEKDAY_FORMAT,
    day_of_week_num,
    day_part,
    first_or_null,
    hour_of_day,
    minutes,
    month_bucket,
    month_name,
    nonempty_ids,
    parse_ts,
    hashed_key,
    play_key,
    play_key_text,
    quarter,
    typed_null,
    weekday_name,
    year,
)
