"""Text expressions: cell cleaning, null markers, name normal forms, slugs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import defaults
from .bind import bind

# Unicode white space plus the four ASCII separators that also count as space.
SPACE = r"(?U)[\s\x1c-\x1f]+"


def squeeze(c: Column) -> Column:
    """Collapse every run of white space to one space and strip the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def clean_cell(c: Column) -> Column:
    """Squeeze, blank to NULL, then delete NUL characters."""
    # The blank test looks at the raw cell: testing the squeezed one would squeeze it twice.
    blank = ~c.rlike(r"(?U)[^\s\x1c-\x1f]")
    return F.when(~blank, F.replace(squeeze(c), F.lit("\x00"), F.lit("")))


def flag_nulls(c: Column, flags=None) -> Column:
    """NULL for cells that spell out a missing value."""
    flags = defaults.NULL_FLAGS if flags is None else flags
    return F.when(~c.isin(list(flags)), c)


def text_strip(c: Column) -> Column:
    """Strip Unicode white space from both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def lower_strip(c: Column) -> Column:
    return text_strip(F.lower(c))


def normal_name(c: Column) -> Column:
    """Lower case, word characters only, without `_` and blanks: the matching form of a name."""
    return F.regexp_replace(lower_strip(c), r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]|[ _]", "")


def squeezed_name(c: Column) -> Column:
    """Lower case without `_` and blanks; punctuation stays."""
    return F.translate(F.lower(c), "_ ", "")


def snake_name(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def slug(title: Column, max_chars: int = defaults.SLUG_CHARS) -> Column:
    """A safe file name from a title: ASCII letters, digits and `_`, cut at a word boundary."""
    s = F.regexp_replace(F.lower(title), r"(?U)[^a-z0-9\s\x1c-\x1f]", "")
    s = F.regexp_replace(s, SPACE, "_")

    def cut(whole: Column) -> Column:
        head = F.substring(whole, 1, max_chars)
        return F.when(F.length(whole) > max_chars, F.regexp_replace(head, r"_[^_]*$", "")).otherwise(whole)

    return bind(F.trim(s, F.lit("_")), cut)
