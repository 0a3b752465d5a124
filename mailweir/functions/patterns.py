"""Regular expressions shared by the text functions and by the SQL that checks them.

Written in the syntax both Java and RE2 accept.
"""

# The characters Python's ``str`` treats as white space.
SPACE_CLASS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACES = f"[{SPACE_CLASS}]+"
SPACE_CHARS = "".join(
    map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
# All of them but the space, tab, and the two ends of line.
ODD_SPACES = "".join(c for c in SPACE_CHARS if c not in " \t\r\n")
# Java tests a class range by range. Most characters are printable ASCII: one
# look ahead at that single range rules them out several times faster.
_NOT_PRINTABLE = "(?![!-~])"

# The characters at which Python's ``str.splitlines`` breaks a line.
LINE_BREAK_CLASS = r"\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}"

# A link runs over every character from "$" to "_" (digits, capitals and most
# punctuation), "!" and small letters. "#", "~" and white space end it.
URL = r"https?://[!$-_a-z]+"
URL_TAIL = r"[.,;!?)]+$"

# What is removed once the links themselves are gone.
LINK_LEFTOVER = rf"http[^{SPACE_CLASS}]*|\[link\]|\[/link\]|\(link\)|\(/link\)"

# Zero-width characters that are dropped.
INVISIBLE = "\u200c\ufeff"

LOOKS_LIKE_HTML = r"<[^>]+>"

# All markup in one alternation, so that a left-to-right scan decides which
# construct an opening bracket belongs to: a script inside a comment is comment,
# a comment inside a script is script.
_MARKUP_PARTS = (
    r"!--.*?(?:--!?>|\z)",
    r"script(?:\s|\s[^>]*[^>/])?>.*?(?:</script[^>]*>|\z)",
    r"style(?:\s|\s[^>]*[^>/])?>.*?(?:</style[^>]*>|\z)",
    r"[!?][^>]*>",
    r"/[a-z][^>]*>",
)
# A quote delimits a value right after "=" only; elsewhere it is a character like any other.
_START_TAG_RE2 = (
    r"""[a-z][^>=]*(?:=[ \t\n\r\f]*(?:"[^"]*"[^>=]*|'[^']*'[^>=]*|[^ \t\n\r\f>"'=][^ \t\n\r\f>]*[^>=]*)?)*>"""
)
# The same language; possessive repetition keeps Java from recursing on long tags.
_START_TAG_JAVA = (
    r"""[a-z][^>=]*+(?:=[ \t\n\r\f]*+(?:"[^"]*+"[^>=]*+|'[^']*+'[^>=]*+|[^ \t\n\r\f>"'=][^ \t\n\r\f>]*+[^>=]*+)?+)*+>"""
)
MARKUP_RE2 = "(?is)<(?:" + "|".join((*_MARKUP_PARTS, _START_TAG_RE2)) + ")"
MARKUP_JAVA = "(?is)<(?:" + "|".join((*_MARKUP_PARTS, _START_TAG_JAVA)) + ")"

# White space around a line break or a double space separates two chunks of text.
CHUNK_GAP = (
    f"[{SPACE_CLASS}]*(?:[{LINE_BREAK_CLASS}]|  )[{SPACE_CLASS}]*"
)
# The look behind keeps a long run without a gap from being tried at every start.
CHUNK_GAP_JAVA = _NOT_PRINTABLE + f"(?<![{SPACE_CLASS}])" + CHUNK_GAP

# Whole words of three or more characters, for lower-case text.
LONG_WORD = r"[a-z\p{L}\p{N}_]{3,}"
# Words that never count as subject keywords.
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in",
    "on", "at", "to", "for", "of", "with", "by",
)
