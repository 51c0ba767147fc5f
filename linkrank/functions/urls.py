"""URL cleaning and normalisation as Column -> Column expressions.

Everything here is built from Spark's own string functions, so the whole chain
from raw href to graph node stays in the JVM.  The same functions work on plain
columns and on the elements of an array inside ``F.transform``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LINK_TYPES = ("type1", "type2", "type3")  # full URL, host, registered domain
VARIANTS = ("current", "legacy")
ERROR_URL = "http://www.error.com"
UNQUOTE_PASSES = 5
SCHEMES = ("http://", "https://", "http:/", "https:/")
# All characters that count as white space in Unicode, and the separators U+001C to U+001F.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)


def _unquote_once(url: Column) -> Column:
    """``url_decode`` reads ``+`` as a space and raises on a bare ``%``: escape both first."""
    plus_kept = F.replace(url, F.lit("+"), F.lit("%2B"))
    return F.url_decode(F.regexp_replace(plus_kept, "%(?![0-9A-Fa-f]{2})", "%25"))


def unquote(url: Column) -> Column:
    """Percent-decode up to five times; ``+`` and malformed ``%`` stay as they are.

    A pass runs only while a ``%`` is left, so most URLs are not touched and most others
    are decoded once.
    """
    has_escape = lambda text: F.contains(text, F.lit("%"))
    decoded = F.aggregate(
        F.array(*[F.lit(n) for n in range(UNQUOTE_PASSES)]),
        url,
        lambda text, _: F.when(has_escape(text), _unquote_once(text)).otherwise(text),
    )
    return F.when(has_escape(url), decoded).otherwise(url)


def _before_space(url: Column) -> Column:
    return F.substring_index(url, " ", 1)


def clean_parent(url: Column) -> Column:
    """Page URL as used in the graph: trimmed, decoded, cut at the first space.

    A missing URL becomes :data:`ERROR_URL`; callers that drop such rows filter first.
    """
    decoded = F.ltrim(unquote(F.trim(url)), F.lit(WHITESPACE))
    return F.coalesce(_before_space(decoded), F.lit(ERROR_URL))


def is_internal(decoded: Column) -> Column:
    return F.startswith(decoded, F.lit("/"))


def is_external(decoded: Column) -> Column:
    return F.startswith(decoded, F.lit("http"))


def resolve_child(parent: Column, decoded: Column) -> Column:
    """Absolute link for a decoded href, or NULL when it is not a page link.

    A leading ``/`` is appended to the whole parent URL; that includes ``//host``.
    """
    link = _before_space(decoded)
    return F.when(is_internal(decoded), F.concat(parent, link)).when(is_external(decoded), link)


def link_disposition(decoded: Column) -> Column:
    return (
        F.when(is_internal(decoded), "internal")
        .when(is_external(decoded), "external")
        .otherwise("dropped")
    )


def _without_www(url: Column) -> Column:
    return F.replace(url, F.lit("www."), F.lit(""))


def page_name(url: Column, variant: str = "current") -> Column:
    """type1: the URL without query and ``;`` parameters."""
    page = F.substring_index(F.substring_index(url, "?", 1), ";", 1)
    return page if variant == "legacy" else _without_www(page)


def host_name(url: Column, variant: str = "current") -> Column:
    """type2: what stands between the scheme and the first slash."""
    for scheme in SCHEMES:
        url = F.replace(url, F.lit(scheme), F.lit(""))
    host = F.substring_index(url, "/", 1)
    if variant == "legacy":
        return host
    return _without_www(F.substring_index(F.substring_index(host, "?", 1), "#", 1))


def registered_domain(host: Column) -> Column:
    """type3: the last two labels of a host, three below ``.co.``; shorter hosts stay whole."""
    labels = F.when(F.contains(host, F.lit(".co.")), -3).otherwise(-2)
    return F.call_function("substring_index", host, F.lit("."), labels)


def check_names(link_types: Iterable[str], variant: str) -> None:
    unknown = [t for t in link_types if t not in LINK_TYPES]
    if unknown:
        raise ValueError(f"link types must be among {LINK_TYPES}, not {unknown}")
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")


def normalize(url: Column, link_type: str, variant: str = "current") -> Column:
    """Node name of ``url`` at one of the three granularities.

    ``variant='legacy'`` is the rule for links that arrive already extracted: it
    keeps ``www.`` and, in hosts, anything after ``?`` or ``#``.
    """
    check_names([link_type], variant)
    if link_type == "type1":
        return page_name(url, variant)
    host = host_name(url, variant)
    return host if link_type == "type2" else registered_domain(host)
