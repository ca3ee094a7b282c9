"""URL scalars: slugs, dedup keys, bases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def text_slug(text: Column, limit: int = 60) -> Column:
    """A lower-case slug of a title; `untitled` if nothing is left."""
    safe = F.left(F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-")), F.lit(limit))
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("untitled"))


def slug(url: Column, fallback: Column | None = None) -> Column:
    """The last path segment as a slug; the fallback's slug, or a hash of the URL, if there is none."""
    tail = F.regexp_extract(F.rtrim(url, F.lit("/")), "([^/]*)$", 1)
    tail = F.when(tail == "", "index").otherwise(F.regexp_replace(tail, "[?#].*$", ""))
    tail = F.regexp_replace(tail, r"(?i)\.[a-z][a-z0-9]{0,4}$", "")
    safe = F.nullif(F.btrim(F.regexp_replace(F.lower(tail), "[^a-z0-9-]+", "-"), F.lit("-")), F.lit(""))
    last = F.left(F.sha1(url), F.lit(10))
    return F.left(F.coalesce(safe, text_slug(fallback), last) if fallback is not None else F.coalesce(safe, last), F.lit(80))


def host(url: Column) -> Column:
    """Host and port in lower case, without `www.`."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(url), PARTS, 1)), r"^www\.", "")


def full_key(url: Column) -> Column:
    """Host and path, whatever the scheme and trailing slashes; host and query where the path is empty."""
    path = F.rtrim(F.regexp_extract(F.trim(url), PARTS, 2), F.lit("/"))
    return F.concat(host(url), F.when(path != "", path).otherwise(F.concat(F.lit("?"), F.regexp_extract(F.trim(url), PARTS, 3))))


def slug_key(url: Column) -> Column:
    """Host and slug: stays the same when a site moves its path prefix."""
    return F.concat_ws("|", host(url), slug(url))


def base_url(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def absolute(base: Column, link: Column) -> Column:
    """A link made absolute against the scheme and host of a page."""
    return F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link).when(link.startswith("/"), F.concat(base_url(base), link)).otherwise(F.concat(base_url(base), F.lit("/"), link))


SLUG_SQL = r"""left(coalesce(nullif(trim(regexp_replace(lower(regexp_replace(
  CASE WHEN regexp_extract(rtrim({u}, '/'), '([^/]*)$', 1) = '' THEN 'index' ELSE regexp_replace(regexp_extract(rtrim({u}, '/'), '([^/]*)$', 1), '[?#].*$', '') END,
  '(?i)\.[a-z][a-z0-9]{{0,4}}$', '')), '[^a-z0-9-]+', '-', 'g'), '-'), ''), left(sha1({u}), 10)), 80)"""
PARTS_SQL = r"'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)(?:\?([^#]*))?'"
HOST_SQL = rf"regexp_replace(lower(regexp_extract(trim({{u}}), {PARTS_SQL}, 1)), '^www\.', '')"
FULL_SQL = f"""({HOST_SQL} || CASE WHEN rtrim(regexp_extract(trim({{u}}), {PARTS_SQL}, 2), '/') <> '' THEN rtrim(regexp_extract(trim({{u}}), {PARTS_SQL}, 2), '/')
  ELSE '?' || regexp_extract(trim({{u}}), {PARTS_SQL}, 3) END)"""
