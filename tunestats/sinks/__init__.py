"""Sinks: full-refresh table writes, loader, schema-enforced write."""

from tunestats.sinks.layers import Layer, clean_layer, open_layer, publish_layer  # noqa: F401
from tunestats.sinks.tables import (  # noqa: F401
    clean_versions,
    current_version,
    ensure_schema,
    in_file_order,
    load_all,
    publish,
    stored,
    switch,
    write_parts,
    write_table,
    write_version,
    write_with_schema,
)
