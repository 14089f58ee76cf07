"""Text, defaults and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"


#: Signs (no characters of any text) around what was a tag inside mixed content.
TAG_START, TAG_END = "\ufdd0", "\ufdd1"
FORMS = ("complete", "leading", "markup")


def own_text(runs: Column, text: str = "complete") -> Column:
    """Text of a mixed-content element from its runs.

    `complete` is all of its text, that inside tags too; `leading` the text before the first tag, NULL where the element
    starts with one; `markup` the content as XML, tags included.
    """
    if text == "complete":
        return F.regexp_replace(F.array_join(runs, ""), f"{TAG_START}[^{TAG_END}]*{TAG_END}", "")
    if text == "leading":
        first = F.get(runs, F.lit(0))
        return F.when(~first.startswith(TAG_START), F.substring_index(first, TAG_START, 1))
    if text == "markup":
        out = F.array_join(runs, "")
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), (TAG_START, "<"), (TAG_END, ">")):
            out = F.replace(out, F.lit(sign), F.lit(name))
        return out
    raise ValueError(f"text must be one of {FORMS}, not {text!r}")


def plain(value: Column) -> Column:
    """A text without the tags marked in it."""
    return own_text(F.array(value))


def default(value: Column, fallback: str = "") -> Column:
    return F.coalesce(value, F.lit(fallback))


def strip(value: Column) -> Column:
    return F.trim(value, F.lit(WHITESPACE))


def yes(flag: Column) -> Column:
    """Y/N attribute to boolean; a missing attribute counts as no."""
    return F.coalesce(flag == F.lit("Y"), F.lit(False))


def count_items(items: Column) -> Column:
    return F.coalesce(F.array_size(items), F.lit(0))


def as_int(value: Column) -> Column:
    return value.try_cast("int")


def as_key(value: Column) -> Column:
    """A key of articles; keys may pass 2**31."""
    return value.try_cast("bigint")


def split_ids(value: Column) -> Column:
    """Comma separated request text; blanks and empty items are kept."""
    return F.split(value, ",", -1)
