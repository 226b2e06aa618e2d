"""Relational operators (projection, de-dup, top-k, explode, joins)."""

from tunestats.operators.core import (  # noqa: F401
    BROADCAST_CONF,
    BROADCAST_MAX_BYTES,
    broadcast_bound,
    broadcast_parts,
    add_missing,
    conform,
    dedupe,
    distinct_rows,
    explode_genres,
    estimated_bytes,
    fits_broadcast,
    in_part,
    left_join_dim,
    measured_bytes,
    stitch_rows,
    top1_by_count,
    top_n,
    unless_large,
)
from tunestats.operators.numbering import in_order, numbered  # noqa: F401
from tunestats.operators.repeats import dedupe_repeats, split_repeats  # noqa: F401
