"""HTML: detection, entity decoding, text extraction."""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweir.functions import patterns as P
from mailweir.functions.binding import let

# A character reference as HTML5 scans it: decimal, hexadecimal, or up to 32
# characters of a name.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "�"


def is_html(text: Column) -> Column:
    """Whether the text holds anything that looks like a tag."""
    return F.contains(text, F.lit("<")) & text.rlike(P.LOOKS_LIKE_HTML)


@lru_cache(maxsize=None)
def _tables() -> tuple[str, str, str]:
    """Named references, numeric overrides and the alternation of names that need no ';'.

    All derived from the standard library's HTML5 table and the Windows-1252 codec.
    """
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    numeric = {"0": REPLACEMENT, "13": "\r"}
    for code in range(0x80, 0xA0):
        try:
            numeric[str(code)] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            numeric[str(code)] = chr(code)
    # A map is searched from its start: the old, short, everyday names go first.
    order = sorted(html5, key=lambda n: (n.rstrip(";") not in name2codepoint, len(n), n))
    return json.dumps({n: html5[n] for n in order}), json.dumps(numeric), "^(?:" + "|".join(bare) + ")"


def _from_code_point(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _code_point(name: Column) -> Column:
    """The number a numeric reference writes; NULL if it is beyond any code point."""
    is_hex = F.substring(name, 2, 1).isin("x", "X")

    def read(digits: Column) -> Column:
        number = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
        # Ten digits, decimal or hexadecimal, hold every code point and fit a long.
        return F.when(digits == "", F.lit(0).cast("bigint")).when(F.length(digits) <= 10, number)

    return let(F.regexp_extract(name, "^#[xX]?0*([0-9a-fA-F]*)", 1), read)


def _numeric(name: Column, overrides: Column) -> Column:
    def character(code: Column) -> Column:
        # Control characters and non-characters, which vanish.
        dropped = (
            code.between(0x1, 0x8)
            | (code == 0xB)
            | code.between(0xE, 0x1F)
            | (code == 0x7F)
            | code.between(0xFDD0, 0xFDEF)
            | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        )
        override = F.when(code < 0xA0, F.try_element_at(overrides, code.cast("string")))
        return (
            F.when(code.isNull() | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), REPLACEMENT)
            .when(dropped, "")
            .otherwise(F.coalesce(override, _from_code_point(code)))
        )

    return let(_code_point(name), character)


def html_unescape(text: Column) -> Column:
    """Decode HTML5 character references, once, as a browser would.

    The text is cut at its references, each is looked up, and the pieces are put
    together again; text without '&' is passed through untouched. All of it runs
    in the JVM, so a whole table can go through without leaving Spark.
    """
    named_json, numeric_json, bare = _tables()
    names = F.from_json(F.lit(named_json), "map<string,string>")
    overrides = F.from_json(F.lit(numeric_json), "map<string,string>")

    def by_prefix(name: Column, reference: Column) -> Column:
        return let(
            F.regexp_extract(name, bare, 0),
            lambda prefix: F.when(
                prefix != "",
                F.concat(
                    F.try_element_at(names, prefix),
                    F.substring(name, F.length(prefix) + 1, F.length(name)),
                ),
            ).otherwise(reference),
        )

    def decode(reference: Column) -> Column:
        return let(
            F.substring(reference, F.lit(2), F.length(reference)),
            lambda name: F.when(F.startswith(name, F.lit("#")), _numeric(name, overrides)).otherwise(
                F.coalesce(F.try_element_at(names, name), by_prefix(name, reference))
            ),
        )

    def rebuild(whole: Column) -> Column:
        references = F.regexp_extract_all(whole, F.lit(REFERENCE), F.lit(0))
        return let(
            F.split(whole, REFERENCE, -1),
            lambda pieces: F.concat(
                F.get(pieces, F.lit(0)),
                F.array_join(
                    F.zip_with(
                        references,
                        F.slice(pieces, F.lit(2), F.size(pieces)),
                        lambda reference, piece: F.concat(decode(reference), piece),
                    ),
                    "",
                ),
            ),
        )

    return let(
        text,
        lambda whole: F.when(F.contains(whole, F.lit("&")), rebuild(whole)).otherwise(whole),
    )


def strip_markup(html: Column) -> Column:
    """Markup, scripts, styles and comments each become one space."""
    return F.regexp_replace(html, P.MARKUP_JAVA, " ")


def tidy_chunks(text: Column) -> Column:
    """Join lines, and chunks set apart by double spaces, with single spaces."""
    return F.btrim(F.regexp_replace(text, P.CHUNK_GAP_JAVA, " "), F.lit(P.SPACE_CHARS))


def html_text(html: Column) -> Column:
    """The readable text of an HTML body."""
    return tidy_chunks(html_unescape(strip_markup(html)))
