"""Scalar column functions. All are built-in Spark expressions (codegen'd,
JVM-side); none of them is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the data contract (must stay equal to the
# upstream system's): defaults for missing dimension attributes, the
# per-event minutes of the listening-minutes metric, the fallback song-id
# prefix and bucket count, and the album-name suffix of landed tracks.
DEFAULT_TEXT = "Unknown"          # song_name, artist_name, genre, country
DEFAULT_SUBSCRIPTION = "Free"
DEFAULT_USER_NAME = "Guest"
MISSING_MARK = "N/A"              # remaining null text in gold (event_type)
MINUTES_PLAY = 3.5
MINUTES_SKIP = 0.5
TRACK_ID_PREFIX = "lf_"
TRACK_ID_BUCKETS = 100000         # of the upstream id form, see track_id
TRACK_ID_SEPARATOR = "\x1f"
ALBUM_SUFFIX = " - Single"
LABEL_SEPARATOR = " - "

# A number as the old non-ANSI string->int cast accepted it: optional sign,
# digits, optional fraction (dropped); a point may stand without digits before
# it ('.5' is 0). Exponents and other text are null.
_INT_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)$"
_INT_DIGITS = r"^([+-]?[0-9]*)"
# Characters that cast trimmed from both ends before parsing: ASCII
# control characters and space (0x00-0x20) and the C1 controls (0x7F-0x9F).
_BLANKS = "".join(chr(c) for c in range(0x00, 0x21)) + "".join(chr(c) for c in range(0x7F, 0xA0))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c) -> Column:
    """Lenient text -> int: trims blanks, truncates a fraction ('3.9' -> 3),
    null for non-numbers and for values outside the int range. Never throws
    (Spark 4 runs ANSI mode, where a plain cast would fail the job)."""
    t = F.trim(_c(c).cast("string"), F.lit(_BLANKS))
    digits = F.regexp_extract(t, _INT_DIGITS, 1)
    whole = F.when(digits.isin("", "+", "-"), F.lit("0")).otherwise(digits)
    return F.when(t.rlike(_INT_TEXT), whole.try_cast("int"))


def to_ts(c) -> Column:
    """Text -> timestamp; malformed text gives null instead of an error."""
    return F.try_to_timestamp(_c(c).cast("string"))


def to_seconds(c) -> Column:
    """Truncate a timestamp to whole seconds (the analytical table's
    DateTime resolution)."""
    return F.date_trunc("second", _c(c))


def event_month(c) -> Column:
    """yyyymm as an int: the monthly storage partition of gold."""
    ts = _c(c)
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def with_default(c, value: str) -> Column:
    """Replace null (not '') by a default."""
    return F.coalesce(_c(c), F.lit(value))


def minutes_for(event_type) -> Column:
    """Listening minutes attributed to an event by its type; 0 otherwise
    (including a null type)."""
    et = _c(event_type)
    return (F.when(et == "PLAY", F.lit(MINUTES_PLAY))
            .when(et == "SKIP", F.lit(MINUTES_SKIP))
            .otherwise(F.lit(0.0)))


def song_label(song, artist) -> Column:
    """'song - artist' display label (null if either side is null)."""
    return F.concat(_c(song), F.lit(LABEL_SEPARATOR), _c(artist))


def track_id(mbid, name, artist, buckets: int | None = None) -> Column:
    """Stable surrogate id: the catalogue id when non-empty, else 'lf_' + the
    whole md5 of name and artist with a separator, so different tracks keep
    different ids. Deterministic across runs and processes.

    ``buckets`` (e.g. TRACK_ID_BUCKETS) gives the upstream form instead:
    (first 32 bits of md5(name || artist)) mod buckets, under which
    different tracks can share an id."""
    if buckets is None:
        fallback = F.concat(F.lit(TRACK_ID_PREFIX),
                            F.md5(F.concat(_c(name), F.lit(TRACK_ID_SEPARATOR), _c(artist))))
    else:
        digest = F.conv(F.substring(F.md5(F.concat(_c(name), _c(artist))), 1, 8), 16, 10)
        fallback = F.concat(F.lit(TRACK_ID_PREFIX),
                            (digest.cast("bigint") % F.lit(buckets)).cast("string"))
    m = _c(mbid)
    return F.when(F.coalesce(m, F.lit("")) != "", m).otherwise(fallback)


def album_name(name) -> Column:
    return F.concat(_c(name), F.lit(ALBUM_SUFFIX))


def non_empty(c) -> Column:
    """True when the text is neither null nor ''."""
    return F.coalesce(_c(c), F.lit("")) != ""


def to_message(*cols) -> Column:
    """Row -> JSON text message (struct of the given columns)."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))
