"""Byte and transfer encodings of message bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweir.functions.binding import let


# Four letters of the base64 alphabet at a time, up to the first finished padding.
_PADDED = (
    r"\A((?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}(?===)|[A-Za-z0-9+/]{3}(?==))).*\z"
)


def b64_decode(data: Column) -> Column:
    """URL-safe base64 to bytes.

    Missing padding is repaired, characters outside the alphabet are skipped,
    nothing is read after a finished padding, and undecodable input gives no bytes.
    Clean input is decoded as it stands; only what that refuses is tidied up.
    """

    def tidied(standard: Column) -> Column:
        letters = F.regexp_replace(standard, "[^A-Za-z0-9+/=]", "")
        unpadded = F.replace(F.regexp_replace(letters, _PADDED, "$1"), F.lit("="), F.lit(""))
        decoded = F.try_to_binary(unpadded, F.lit("base64"))
        return F.when(~standard.rlike(r"[^\x{0}-\x{7f}]"), decoded)

    def decode(standard: Column) -> Column:
        return F.coalesce(
            F.try_to_binary(standard, F.lit("base64")),
            tidied(standard),
            F.to_binary(F.lit(""), F.lit("utf-8")),
        )

    plus = F.replace(data, F.lit("-"), F.lit("+"))
    return let(F.replace(plus, F.lit("_"), F.lit("/")), decode)


def utf8_replace(data: Column) -> Column:
    """Bytes to text, with U+FFFD for what is not UTF-8."""
    return F.make_valid_utf8(data.cast("string"))


def quoted_printable(text: Column) -> Column:
    """Quoted-printable to text.

    A doubled "=" stands for one, "=" at a line end joins the lines, and "=" before
    anything but two hexadecimal digits stays.
    """
    single = F.replace(text, F.lit("=="), F.lit("=3D"))
    joined = F.regexp_replace(single, r"=(?:\n|\r[^\n]*\n?|\z)", "")
    # Percent-encoding is the one byte escape Spark can decode; protect its own signs first.
    guarded = F.replace(F.replace(joined, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B"))
    percent = F.regexp_replace(guarded, "=([0-9A-Fa-f]{2})", "%$1")
    return F.make_valid_utf8(F.coalesce(F.try_url_decode(percent), text))


def transfer_decode(data: Column, encoding: Column) -> Column:
    """Decode by Content-Transfer-Encoding; an unknown or absent encoding leaves the text as is."""
    return (
        F.when(data.isNull() | (data == ""), "")
        .when(encoding == "base64", utf8_replace(b64_decode(data)))
        .when(encoding == "quoted-printable", quoted_printable(data))
        .otherwise(data)
    )
