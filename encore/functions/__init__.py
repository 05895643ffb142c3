from encore.functions.scalar import (  # noqa: F401
    album_name, event_month, minutes_for, non_empty, song_label, to_int,
    to_message, to_seconds, to_ts, track_id, with_default,
)
