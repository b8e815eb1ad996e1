"""Text rules of the feed: white space, blanks, formats, content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of the feed rules is the Unicode set plus the byte-order mark,
# which is wider than the `\s` of Java and the `trim` of Spark.
_WS_CODES = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF,
]
WHITE_SPACE = "".join(map(chr, _WS_CODES))

# The same set for a pattern; as ranges, because a class of single characters is matched one by one.
_WS = r"\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"

# Accepted phone format, and what a cleaned phone loses. `\z` because Java's `$` also
# matches before a final newline.
PHONE_PATTERN = rf"^[0-9{_WS}+\-().]{{7,20}}\z"
PHONE_NOISE = rf"[^0-9+\-(){_WS}]"
ANY_WHITE_SPACE = rf"[{_WS}]"


def trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only text; never null. Looks no further than the first letter."""
    return F.coalesce(F.ltrim(c, F.lit(WHITE_SPACE)) == "", F.lit(True))


def lowercase(c: Column) -> Column:
    return F.lower(trimmed(c))


def uppercase(c: Column) -> Column:
    return F.upper(trimmed(c))


def clean_phone(c: Column) -> Column:
    return trimmed(F.regexp_replace(c, PHONE_NOISE, ""))


def is_email(c: Column) -> Column:
    """`name@domain` without white space, with one `@` and a dot inside the domain.

    Plain text functions: a pattern for this takes fifteen times as long.
    """
    name, domain = F.substring_index(c, "@", 1), F.substring_index(c, "@", -1)
    one_at = (name != "") & (F.concat(name, F.lit("@"), domain) == c)
    dot = F.locate(".", domain, 2)
    return one_at & (dot >= 2) & (dot < F.char_length(domain)) & ~c.rlike(ANY_WHITE_SPACE)


def is_phone(c: Column) -> Column:
    return c.rlike(PHONE_PATTERN)


def content_hash(parts: Sequence[Column]) -> Column:
    """sha256 over the parts joined by `|`, lower-cased and trimmed as a whole; null counts as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.sha2(trimmed(F.lower(joined)), 256)


def country_prefix(c: Column) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, 2)


def empty_to_null(c: Column) -> Column:
    """Only the empty text becomes null; blank text stays."""
    return F.nullif(c, F.lit(""))


def compact_texts(*texts: Column) -> Column:
    """Array of the non-null texts in the given order.

    `array_remove` of a marker, not a lambda filter, so that code generation is kept. No text is empty.
    """
    return F.array_remove(F.array(*[F.coalesce(t, F.lit("")) for t in texts]), "")
