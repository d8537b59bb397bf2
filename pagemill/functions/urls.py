"""URL columns: pieces, canonical form, scope, resolution.

Everything is built from JVM-side string functions; ``parse_url`` is not used because
it rejects malformed URLs and keeps the host's case.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.binding import bind, literal, over

_PIECES = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
_CONTROL_OR_SPACE = "".join(map(chr, range(0x21)))
# Schemes whose URLs carry an authority and resolve relative references.
_WEB_SCHEMES = ("http", "https", "ftp", "file")
# Characters a URL may hold unescaped (RFC 3986 reserved and unreserved,
# the percent sign and the bar).
_URL_SAFE = r"A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%|"


def _pieces(url: str) -> str:
    """SQL struct of scheme (lower case), netloc, path, query and fragment; missing are ''."""
    pattern = literal(_PIECES)
    groups = (
        f"lower(regexp_extract(raw, {pattern}, 1)) AS scheme",
        f"regexp_extract(raw, {pattern}, 2) AS netloc",
        f"regexp_extract(raw, {pattern}, 3) AS path",
        f"regexp_extract(raw, {pattern}, 4) AS query",
        f"regexp_extract(raw, {pattern}, 5) AS fragment",
    )
    cleaned = f"translate(ltrim({literal(_CONTROL_OR_SPACE)}, {url}), '\\t\\r\\n', '')"
    return bind("raw", cleaned, f"struct({', '.join(groups)})")


def _over_pieces(url: Column, body: str) -> Column:
    """SQL ``body`` over ``u``, the URL, and ``p``, its pieces."""
    return over(url, "u", bind("p", _pieces("u"), body))


def _with_pieces(url: str, body: str) -> str:
    return bind("u", url, bind("p", _pieces("u"), body))


_WEB = ", ".join(map(literal, _WEB_SCHEMES))


def _assembled(scheme: str, netloc: str, path: str, query: str) -> str:
    return f"""concat(
        CASE WHEN {scheme} = '' THEN '' ELSE concat({scheme}, ':') END,
        CASE WHEN {netloc} <> '' THEN concat('//', {netloc})
             WHEN startswith({path}, '//') THEN '//'
             WHEN {scheme} IN ({_WEB}) AND startswith({path}, '/') THEN '//'
             ELSE '' END,
        {path},
        CASE WHEN {query} = '' THEN '' ELSE concat('?', {query}) END)"""


_EMPTY_PARAMETERS = literal(r"^((?:.*/)?[^/;]*);$")
_CANONICAL_PATH = f"""coalesce(nullif(
    CASE WHEN endswith(p.path, ';') THEN regexp_replace(p.path, {_EMPTY_PARAMETERS}, '$1')
         ELSE p.path END, ''), '/')"""
_CANONICAL = bind(
    "path", _CANONICAL_PATH, _assembled("p.scheme", "lower(p.netloc)", "path", "p.query")
)
_HOST = bind(
    "host",
    "substring_index(coalesce(nullif(p.netloc, ''), regexp_extract(p.path, '^[^/]*', 0)), '@', -1)",
    f"""CASE WHEN startswith(host, '[') THEN regexp_extract(host, {literal(r"^\[[^\]]*\]?")}, 0)
             ELSE substring_index(host, ':', 1) END""",
)


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and authority, ``/`` for an empty path, no fragment.

    Path case, parameters, query order, port and trailing slash stay; an empty ``?`` or
    trailing ``;`` goes.
    """
    return _over_pieces(url, _CANONICAL)


def canonical_sql(url: str) -> str:
    return _with_pieces(url, _CANONICAL)


_DOMAIN = f"nullif(lower(btrim(btrim({_HOST}, {literal(_CONTROL_OR_SPACE)}), '.')), '')"


def url_domain(url: Column) -> Column:
    """Host in lower case without user, port or surrounding dots; NULL when there is none."""
    return _over_pieces(url, _DOMAIN)


def domain_sql(url: str) -> str:
    return _with_pieces(url, _DOMAIN)


def url_origin(url: Column) -> Column:
    return _over_pieces(url, _assembled("p.scheme", "lower(p.netloc)", "''", "''"))


def path_sql(url: str) -> str:
    return _with_pieces(url, "p.path")


def seed_url(value: Column, on_error: str = "null") -> Column:
    """A start URL from an HTTP(S) URL or a bare domain.

    Other schemes and empty hosts give NULL, or fail the job with ``on_error='raise'``.
    """
    if on_error == "raise":
        bad_scheme = "raise_error('url must be an HTTP(S) URL or domain')"
        bad_host = "raise_error('url must be non-empty')"
    else:
        bad_scheme = bad_host = "NULL"
    return _over_pieces(
        value,
        f"""CASE WHEN p.scheme IN ('http', 'https') AND p.netloc <> '' THEN u
            WHEN p.scheme <> '' OR p.netloc <> '' THEN CAST({bad_scheme} AS STRING)
            WHEN p.path = '' OR startswith(p.path, '/') THEN CAST({bad_host} AS STRING)
            ELSE concat('https://', u) END""",
    )


def url_matches(url: Column, patterns: str | Sequence[str] | None) -> Column:
    """True when any pattern is found in the URL, or when there is no pattern."""
    patterns = [patterns] if isinstance(patterns, str) else list(patterns or ())
    if not patterns:
        return F.lit(True)
    return reduce(or_, (url.rlike(pattern) for pattern in patterns))


def prefix_scope_pattern(scope: str) -> str:
    """The URL pattern that admits one host and path prefix."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(?=//)", "", scope.strip())
    host, slash, path = re.split(r"[?#]", rest.removeprefix("//"), maxsplit=1)[0].partition("/")
    if not host:
        raise ValueError("url must be non-empty")
    return f"^https?://{re.escape(host)}{re.escape((slash + path).rstrip('/'))}(/.*)?$"


def sitemap_seeds(df: DataFrame, url: str = "url") -> DataFrame:
    """The robots and sitemap addresses of every distinct origin in ``df``."""
    origins = df.select(url_origin(F.col(url)).alias("origin")).distinct()
    return origins.select(
        "origin",
        F.explode(
            F.array(
                F.concat("origin", F.lit("/robots.txt")),
                F.concat("origin", F.lit("/sitemap.xml")),
            )
        ).alias("sitemap_url"),
    )


def escape_url(url: Column) -> Column:
    """Percent-encode what a URL may not hold, as UTF-8; existing escapes stay."""
    return over(url, "given", escape_sql("given"))


def escape_sql(url: str) -> str:
    runs = literal(f"[{_URL_SAFE}]+|[^{_URL_SAFE}]+")
    unsafe = literal(f"[^{_URL_SAFE}]")
    return bind(
        "u",
        url,
        f"""CASE WHEN u RLIKE {unsafe} THEN array_join(transform(
                regexp_extract_all(u, {runs}, 0),
                run -> CASE WHEN run RLIKE {unsafe} THEN regexp_replace(hex(run), '(..)', '%$1')
                            ELSE run END), '')
            ELSE u END""",
    )


_DOT_SEGMENTS = literal(r"(^|/)\.\.?(/|$)")
_CLOSING_DOTS = literal(r"(^|/)\.\.?$")


def _without_dot_segments(path: str) -> str:
    kept = """aggregate(split(dotted, '/'), CAST(array() AS ARRAY<STRING>), (stack, part) ->
        CASE WHEN part = '..' THEN slice(stack, 1, greatest(size(stack) - 1, 0))
             WHEN part = '.' THEN stack
             ELSE array_append(stack, part) END)"""
    joined = f"""concat(array_join({kept}, '/'),
        CASE WHEN dotted RLIKE {_CLOSING_DOTS} THEN '/' ELSE '' END)"""
    rooted = bind("joined", joined, "if(startswith(joined, '/'), joined, concat('/', joined))")
    return bind("dotted", path, f"if(dotted RLIKE {_DOT_SEGMENTS}, {rooted}, dotted)")


def resolve_url(base: Column, reference: Column) -> Column:
    """The absolute URL of ``reference`` seen from ``base`` (dot segments removed)."""
    given = F.struct(base.alias("base"), reference.alias("reference"))
    return over(given, "given", resolve_sql("given.base", "given.reference"))


def resolve_sql(base: str, reference: str) -> str:
    folder = "coalesce(nullif(regexp_extract(b.path, '^.*/', 0), ''), '/')"
    relative = f"regexp_replace(concat({folder}, t.path), '/{{2,}}', '/')"
    rooted = f"if(startswith(t.path, '/'), t.path, {relative})"
    merged = f"if(t.path = '', b.path, {_without_dot_segments(rooted)})"
    parts = f"""struct(
        if(t.netloc <> '', t.netloc, b.netloc) AS netloc,
        if(t.netloc <> '', t.path, {merged}) AS path,
        if(t.netloc = '' AND t.path = '' AND t.query = '', b.query, t.query) AS query)"""
    whole = bind("r", parts, _assembled("b.scheme", "r.netloc", "r.path", "r.query"))
    foreign = f"(t.scheme <> '' AND t.scheme <> b.scheme) OR b.scheme NOT IN ({_WEB})"
    body = f"""CASE WHEN reference = '' THEN base
        WHEN {foreign} THEN reference
        ELSE concat({whole}, if(t.fragment = '', '', concat('#', t.fragment))) END"""
    pieces = bind("b", _pieces("base"), bind("t", _pieces("reference"), body))
    return bind("base", base, bind("reference", reference, pieces))
