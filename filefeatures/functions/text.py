"""Column expressions that read numbers and flags out of free text. All stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_pattern(text: str) -> str:
    """A Java regex that matches exactly this text."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def marker_count(source: Column, marker: str, *, regex: bool = False) -> Column:
    """How often the marker occurs: NULL text gives NULL, empty text gives 0."""
    return F.regexp_count(source, F.lit(marker if regex else literal_pattern(marker)))


def labelled_number(source: Column, label: str) -> Column:
    """The digits right after the first label followed by digits, as bigint; NULL when there are none."""
    return F.regexp_extract(source, literal_pattern(label) + r"(\d{1,})", 1).try_cast("bigint")


def keyword_flags(
    source: Column,
    label: str,
    keywords: Sequence[str],
    *,
    prefix: str,
    delimiter: str = "|",
    whole_word: bool = False,
    ignore_case: bool = False,
) -> dict[str, Column]:
    """One 1/0 column per keyword: does it occur after the label and before the next delimiter?

    By default a keyword is a plain, case-sensitive part of the text ("check" is found in "checkout").
    The labelled sections are cut out once per row and shared by all the flags.
    """
    if len(delimiter) != 1:
        raise ValueError("the delimiter is a single character")
    outside = f"[^\\x{{{ord(delimiter):x}}}]*"
    if whole_word or ignore_case:
        mode, edge = ("(?i)" if ignore_case else ""), (r"\b" if whole_word else "")
        found = {
            word: source.rlike(f"{mode}{literal_pattern(label)}{outside}{edge}{literal_pattern(word)}{edge}")
            for word in keywords
        }
    else:
        if any(delimiter in word for word in keywords):
            raise ValueError("a keyword cannot hold the delimiter")
        sections = F.concat_ws(
            delimiter, F.regexp_extract_all(source, F.lit(f"{literal_pattern(label)}({outside})"), F.lit(1))
        )
        found = {word: F.contains(sections, F.lit(word)) for word in keywords}
    return {f"{prefix}{word}": F.coalesce(hit.cast("int"), F.lit(0)) for word, hit in found.items()}


def last_path_segment(path: Column) -> Column:
    """What follows the last slash; empty when there is no slash."""
    return F.regexp_extract(path, "/([^/]*)$", 1)
