"""Cleaning and structuring of body text, and subject keywords."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweir.functions import patterns as P
from mailweir.functions.binding import let
from mailweir.functions.encoding import b64_decode, utf8_replace
from mailweir.functions.html import html_unescape, is_html, strip_markup


def extract_urls(text: Column) -> Column:
    """Every link in order, repeats kept, trailing punctuation removed."""
    found = F.regexp_extract_all(text, F.lit(P.URL), F.lit(0))
    links = F.transform(found, lambda url: F.regexp_replace(url, P.URL_TAIL, ""))
    none = F.when(text.isNotNull(), F.array().cast("array<string>"))
    return F.when(F.contains(text, F.lit("http")), links).otherwise(none)


def _has_odd_space(text: Column) -> Column:
    """Whether the text holds white space other than space, tab and line ends.

    Found by searching its UTF-8 bytes. Those in the general punctuation block
    share their first two bytes with dashes and curly quotes, so they are only
    looked for one by one in a text that has that pair.
    """
    punctuation = [c for c in P.ODD_SPACES if c.encode()[:2] == b"\xe2\x80"]
    others = [c for c in P.ODD_SPACES if c not in punctuation]
    has = lambda c: F.contains(text, F.lit(c))
    either = lambda tests: reduce(lambda a, b: a | b, tests)
    pair = F.contains(text.cast("binary"), F.lit(b"\xe2\x80"))
    return either(map(has, others)) | (pair & either(map(has, punctuation)))


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space.

    Byte searches for the characters at stake are far cheaper than a pattern
    over every character, so patterns run only where one of them is found.
    """
    common = text
    for blank in "\n\r\t":
        common = F.replace(common, F.lit(blank), F.lit(" "))

    def plain_spaces(value: Column) -> Column:
        spaced = F.regexp_replace(value, f"[{P.ODD_SPACES}]", " ")
        return F.when(_has_odd_space(value), spaced).otherwise(value)

    def single(value: Column) -> Column:
        return F.when(
            F.contains(value, F.lit("  ")), F.regexp_replace(value, " {2,}", " ")
        ).otherwise(value)

    return let(let(common, plain_spaces), single)


def _clean(text: Column, urls: Column) -> Column:
    removed = F.aggregate(urls, text, lambda rest, url: F.replace(rest, url, F.lit("")))
    unlinked = F.when(F.size(urls) > 0, removed).otherwise(text)

    def finish(collapsed: Column) -> Column:
        plain = html_unescape(collapsed)
        for invisible in P.INVISIBLE:
            plain = F.replace(plain, F.lit(invisible), F.lit(""))

        def without_leftovers(value: Column) -> Column:
            suspect = F.contains(value, F.lit("http")) | F.contains(value, F.lit("link"))
            return F.when(suspect, F.regexp_replace(value, P.LINK_LEFTOVER, "")).otherwise(value)

        # Most texts come through unchanged and need no second pass.
        return let(
            let(plain, without_leftovers),
            lambda bare: F.when(bare == collapsed, bare).otherwise(collapse_spaces(bare)),
        )

    return F.trim(let(collapse_spaces(unlinked), finish))


def clean_text(text: Column) -> Column:
    """Remove links, entities, invisible characters and link leftovers; collapse white space.

    Links are removed one after the other, in order: a link that begins another
    leaves that one's tail behind.
    """
    return let(
        F.coalesce(text, F.lit("")),
        lambda whole: let(extract_urls(whole), lambda urls: _clean(whole, urls)),
    )


def structure_body(text: Column) -> Column:
    """``{clean_text, urls, length}``; length counts code points."""

    def assemble(whole: Column, urls: Column) -> Column:
        return let(
            _clean(whole, urls),
            lambda cleaned: F.struct(
                cleaned.alias("clean_text"), urls.alias("urls"), F.length(cleaned).alias("length")
            ),
        )

    return let(
        F.coalesce(text, F.lit("")),
        lambda whole: let(extract_urls(whole), lambda urls: assemble(whole, urls)),
    )


def body_text(data: Column) -> Column:
    """Encoded body data to text: decode, then take the text out of markup if there is any.

    White space is left as it is; structuring collapses it.
    """
    return let(
        utf8_replace(b64_decode(data)),
        lambda decoded: F.when(
            is_html(decoded), html_unescape(strip_markup(decoded))
        ).otherwise(decoded),
    )


def decode_and_extract(data: Column) -> Column:
    """Encoded body data to ``{clean_text, urls, length}``; NULL for no data."""
    return let(data, lambda d: F.when(d.isNotNull(), structure_body(body_text(d))))


def long_words(subject: Column) -> Column:
    """Lower-case words of three or more characters."""
    return F.regexp_extract_all(F.lower(subject), F.lit(P.LONG_WORD), F.lit(0))


def is_keyword(word: Column) -> Column:
    return ~word.isin(*P.STOP_WORDS)


def keywords(subject: Column) -> Column:
    """Lower-case words of three or more characters that are not stop words."""
    return F.filter(long_words(subject), is_keyword)


def code_points(text: Column) -> Column:
    """Length in code points; NULL for NULL."""
    return F.length(text)


def size_or_zero(items: Column) -> Column:
    """Array size, 0 for NULL."""
    return F.coalesce(F.when(items.isNotNull(), F.size(items)), F.lit(0))


def nullish_default(value: Column, default: object) -> Column:
    """The value, or a default where it is missing."""
    return F.coalesce(value, F.lit(default))
