"""Unicode blanks.

Java's ``\\s`` is ASCII only and SQL ``trim`` removes U+0020 only, while dumps hold
no-break and thin spaces. ``BLANK`` is the full class; every pattern of this package
uses it instead of ``\\s``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"

# The same class as characters.
BLANK_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# Runs of blanks other than the plain space. Latin-1 characters are listed one by one, which
# makes them one table look-up; the range in front of the rest settles nearly all others.
_OTHER_BLANKS = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]+"
)
_SPACES = " {2,}"

# What ends a line inside an article (after \r\n and \r were folded to \n in a dump).
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def strip(text: Column) -> Column:
    """Remove Unicode blanks at both ends."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def squeeze(text: Column) -> Column:
    """Every run of Unicode blanks becomes one space; none is left at the ends."""
    return F.trim(join_spaces(plain_spaces(text)))


def plain_spaces(text: Column) -> Column:
    """Every run of other blanks becomes one space; runs of spaces stay."""
    return F.regexp_replace(text, _OTHER_BLANKS, " ")


def join_spaces(text: Column) -> Column:
    return F.regexp_replace(text, _SPACES, " ")


def fold_newlines(text: Column) -> Column:
    """CRLF and lone CR become LF, by byte search."""
    unix = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.replace(unix, F.lit("\r"), F.lit("\n"))


def lines(text: Column) -> Column:
    """The lines of a text that has no line end at its own end."""
    return F.split(text, LINE_END)
