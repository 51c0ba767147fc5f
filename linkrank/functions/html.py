"""Anchor extraction from raw HTML.

``extract_hrefs`` is one regular-expression pass inside the JVM that walks the tags of a document, steps over comments, scripts and styles, and keeps
what each ``<a>`` gives as ``href``.  Every repetition in the pattern is possessive
or a lazy scan, so neither backtracking nor stack depth grows with the page.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE = r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
_HREF_NAME = r"href(?=[\s=/>]|\z)"
_ATTRIBUTE = r"[\s/]*+[^\s>/][^\s=>/]*+" + _VALUE
_OTHER_ATTRIBUTE = r"[\s/]*+(?!" + _HREF_NAME + r")[^\s>/][^\s=>/]*+" + _VALUE

# Group 1 is the href attribute of an anchor, e.g. ``href="/x"``; for every other
# tag, comment, declaration, script or style it is empty.
_TAGS = (
    r"(?is)<(?:"
    r"a(?=[\s/])(?:" + _OTHER_ATTRIBUTE + r")*+[\s/]*+(" + _HREF_NAME + _VALUE + r")(?:" + _ATTRIBUTE + r")*+"
    r"|!--.*?(?:-->|\z)"
    r"|[!?][^>]*+"
    r"|script(?=[\s/>]).*?(?:</script|\z)"
    r"|style(?=[\s/>]).*?(?:</style|\z)"
    r"|[a-z][^\s/>]*+(?:" + _ATTRIBUTE + r")*+"
    r")"
)
_HREF_TOKEN = r"""(?is)^href\s*(?:=\s*)?(?:"(.*)"|'(.*)'|(.*))$"""

# One piece of text from one ``&`` up to the next.
_ENTITY_PIECE = r"(?s)^&(#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+;)(.*)$"
_NUMBER = r"^#[xX]?0*([0-9a-fA-F]*);?$"
# More digits than these, without leading zeros, are beyond any character.
_MOST_DIGITS = 8
_MAX_CODE_POINT = 0x10FFFF
# "name character" per line: one literal that Spark folds into a map.
_ENTITIES = "\n".join(f"{n} {chr(c)}" for n, c in {**name2codepoint, "apos": 39}.items())


def _code_point_text(code: Column) -> Column:
    """The character with this number, through its UTF-32 bytes; empty when there is none."""
    surrogate = code.between(0xD800, 0xDFFF)
    valid = (code > 0) & (code <= _MAX_CODE_POINT) & ~surrogate
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("")


def _decode_piece(part: Column) -> Column:
    """The text of a struct of a piece, the reference that it begins with and what follows."""
    name = part["name"]
    digits = F.regexp_extract(name, _NUMBER, 1)
    is_hex = F.lower(F.substring(name, 2, 1)) == "x"
    number = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
    code = F.when(F.length(digits) <= _MOST_DIGITS, number)
    names = F.str_to_map(F.lit(_ENTITIES), F.lit("\n"), F.lit(" "))
    text = F.when(F.startswith(name, F.lit("#")), F.coalesce(_code_point_text(code), F.lit(""))).otherwise(
        F.try_element_at(names, F.rtrim(name, F.lit(";")))
    )
    return F.when(name == "", part["piece"]).otherwise(
        F.coalesce(F.concat(text, part["rest"]), part["piece"])
    )


def unescape_entities(text: Column) -> Column:
    """Decode character references: numeric ones, and named ones closed by ``;``.

    An unclosed name stays literal, so ``?a=1&copy=2`` survives.  A number may have any count
    of leading zeros; one that names no character (0, surrogates, beyond U+10FFFF) is removed.
    """
    parts = F.transform(
        F.split(text, "(?=&)"),
        lambda piece: F.struct(
            piece.alias("piece"),
            F.regexp_extract(piece, _ENTITY_PIECE, 1).alias("name"),
            F.regexp_extract(piece, _ENTITY_PIECE, 2).alias("rest"),
        ),
    )
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(parts, _decode_piece), "")
    ).otherwise(text)


def href_tokens(html: Column) -> Column:
    """Raw href attributes in document order, with empty entries for other tags."""
    return F.coalesce(
        F.regexp_extract_all(html, F.lit(_TAGS), F.lit(1)), F.array().cast("array<string>")
    )


def extract_hrefs(html: Column) -> Column:
    """All ``a/@href`` values in document order, duplicates kept; NULL gives no links."""
    tokens = F.filter(href_tokens(html), lambda token: token != "")
    # Two steps, so that the value is cut out once and not at every use in the decoding.
    values = F.transform(tokens, lambda token: F.regexp_replace(token, _HREF_TOKEN, "$1$2$3"))
    return F.transform(values, unescape_entities)
