"""URL expressions: object path from a signed URL, file name from a URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The storage prefix removed from URL paths and the prefix put in front of the rest.
SIGNED_PATH_PREFIX = "/storage/v1/object/sign/audios/processed/"
OBJECT_PREFIX = "processed/"
# RFC 3986 reference: optional scheme, optional authority, then the path (group 1).
URL_PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_path(url) -> Column:
    """Path component of a URL (no query, fragment, or ``;params`` of the last segment)."""
    p = F.regexp_extract(_c(url), URL_PATH_RE, 1)
    return F.when(_c(url).isNotNull(), F.regexp_replace(p, r";[^/]*$", ""))


def object_path(url, strip_prefix: str = SIGNED_PATH_PREFIX, add_prefix: str = OBJECT_PREFIX) -> Column:
    """The URL's path without the storage prefix, wherever it occurs, and without anything from a question mark on, below
    ``add_prefix``. When the prefix is absent the path keeps its leading ``/`` (see :func:`prefix_missing`)."""
    rest = F.substring_index(F.replace(url_path(url), F.lit(strip_prefix), F.lit("")), "?", 1)
    return F.concat(F.lit(add_prefix), rest)


def prefix_missing(url, strip_prefix: str = SIGNED_PATH_PREFIX) -> Column:
    return F.coalesce(~F.contains(url_path(url), F.lit(strip_prefix)), F.lit(True))


def file_name(url) -> Column:
    """What follows the last slash before the query of a URL."""
    return F.substring_index(F.substring_index(_c(url), "?", 1), "/", -1)
