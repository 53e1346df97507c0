"""Time stamps in text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts feeds use for publish dates, weekday already removed.
LAYOUTS = [
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
]


def parse_publish_date(c: Column | str) -> Column:
    """Time stamp of a publish date in any of the known layouts, else NULL.

    Spark's parser has no weekday letter, so a leading 'Mon, ' is cut off first.
    """
    text = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3,9}, *", "")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in LAYOUTS])


def parse_iso(c: Column | str, default: Column | None = None) -> Column:
    """ISO time stamp with every 'Z' removed; ``default`` (now) when it does not parse."""
    text = F.regexp_replace(c, "Z", "")
    fallback = F.current_timestamp() if default is None else default
    return F.coalesce(text.try_cast("timestamp"), fallback)


def now_iso() -> Column:
    """The current time as ISO text with its UTC offset."""
    return iso(F.current_timestamp())


def iso(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
