"""Sources: landed pages → raw tables, ingestion window, key harvest."""

from tunestats.sources.chains import page_chains, parse_links, read_links  # noqa: F401
from tunestats.sources.ingest import enrich, harvest_keys, read_table, recent, window_start  # noqa: F401
from tunestats.sources.pages import (  # noqa: F401
    PAGE_KINDS,
    corrupt_pages,
    flatten_artists,
    flatten_play_history,
    flatten_playlist_tracks,
    flatten_playlists,
    flatten_tracks,
    parse_pages,
    read_artists,
    read_pages,
    read_play_history,
    read_playlist_tracks,
    read_playlists,
    read_raw,
    read_tracks,
)
from tunestats.sources.requests import missing_keys, missing_requests  # noqa: F401
from tunestats.sources.rest import field_counts, read_rest, rest_of_pages  # noqa: F401
