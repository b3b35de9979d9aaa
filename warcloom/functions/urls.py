"""URL expressions: canonical key and resolution of references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.functions.binding import let
from warcloom.functions.literals import empty_strings

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
_NO_QUERY = r"^[^?#]*"
_NO_FRAGMENT = r"^[^#]*"


def url_key(url: Column) -> Column:
    """Canonical URL.

    Lower case; no user, `www` prefix, default port, fragment, or slash at the end of a path; query arguments sorted;
    an empty query is dropped. URLs without `//` are only put in lower case; no URL gives `-`.
    """
    return let(F.lower(F.trim(url)), _url_key)


def _url_key(lower: Column) -> Column:
    whole = F.regexp_extract(lower, _NO_FRAGMENT, 0)
    scheme = F.regexp_extract(whole, _SCHEME, 1)
    host = F.regexp_replace(F.regexp_extract(whole, _AUTHORITY, 1), r"^[^@]*@", "")
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    host = (
        F.when(scheme == "http", F.regexp_replace(host, ":80$", ""))
        .when(scheme == "https", F.regexp_replace(host, ":443$", ""))
        .otherwise(host)
    )
    path = F.regexp_replace(F.regexp_extract(whole, _PATH, 1), "(?<!/)/++$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    arguments = F.array_join(F.array_sort(F.split(F.regexp_extract(whole, r"\?(.*)$", 1), "&")), "&")
    query = F.regexp_replace(F.concat(F.lit("?"), arguments), r"^\?$", "")
    return (
        F.when(F.coalesce(lower, F.lit("")) == "", F.lit("-"))
        .when(~lower.rlike(_AUTHORITY), lower)
        .otherwise(F.concat(scheme, F.lit("://"), host, path, query))
    )


def _without_dot_segments(path: Column) -> Column:
    return let(path, _dot_segments_removed)


def _dot_segments_removed(path: Column) -> Column:
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        empty_strings(),
        lambda done, segment: F.when(
            segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(segment == ".", done)
        .otherwise(F.array_append(done, segment)),
    )
    # a dot segment at the end leaves its folder
    end = F.when(path.rlike(r"(^|/)\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    rooted = F.regexp_replace(F.concat(F.array_join(kept, "/"), end), "^/?", "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), rooted).otherwise(path)


def resolve(reference: Column, base: Column) -> Column:
    """Absolute form of a reference found on the page `base` (RFC 3986); dot segments are removed.

    Without a base the reference stays as it is.
    """
    return let(base, lambda known: let(reference, lambda found: _resolve(found, known)))


def _resolve(reference: Column, base: Column) -> Column:
    origin = F.concat(F.regexp_extract(base, _SCHEME, 1), F.lit("://"), F.regexp_extract(base, _AUTHORITY, 1))
    base_path = F.regexp_extract(base, _PATH, 1)
    base_folder = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(base_path, "(?<![^/])[^/]++$", ""), "^/", ""))
    tail = F.regexp_replace(F.regexp_replace(reference, _NO_QUERY, ""), r"\??#?$", "")
    path = F.regexp_extract(reference, _NO_QUERY, 0)
    merged = F.regexp_replace(F.concat(base_folder, path), "/{2,}", "/")
    return (
        F.when(F.coalesce(base, F.lit("")) == "", reference)
        .when(reference.rlike(_SCHEME), reference)
        .when(reference.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), reference))
        .when(reference.startswith("/"), F.concat(origin, _without_dot_segments(path), tail))
        .when(reference.startswith("?"), F.concat(origin, base_path, tail))
        .when(reference.startswith("#"), F.concat(F.regexp_extract(base, _NO_FRAGMENT, 0), tail))
        .otherwise(F.concat(origin, _without_dot_segments(merged), tail))
    )


def has_scheme_and_host(url: Column) -> Column:
    return url.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]")
