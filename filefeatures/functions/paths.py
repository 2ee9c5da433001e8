"""Column expressions over file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from filefeatures.contracts import IN_PATTERN, OUT_PATTERN
from filefeatures.functions.text import literal_pattern


# Scheme and host of a path; the same in Java and Python.
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def without_scheme(uri: str) -> str:
    return re.sub(_SCHEME, "", uri)


def plain_path(uri: Column, root: str = "") -> Column:
    """The path without scheme and host, below `root` when one is given."""
    path = F.regexp_replace(uri, _SCHEME, "")
    return F.regexp_replace(path, "^" + literal_pattern(root.rstrip("/")), "") if root.strip("/") else path


def decoded(encoded: Column) -> Column:
    """A path or name of the file source's `_metadata` as it is on disk (`%20` becomes a blank again)."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def source_file_name(root: str | None = None) -> Column:
    """The file a row was read from: its path below `root`, which is its name for a file in that folder.

    Without a root, or outside of it, the name alone.
    """
    name = decoded(F.col("_metadata.file_name"))
    if root is None:
        return name
    path, folder = plain_path(decoded(F.col("_metadata.file_path"))), root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(folder)), F.substring(path, len(folder) + 1, 1 << 30)).otherwise(name)


def file_route(path: Column, in_pattern: str = IN_PATTERN, out_pattern: str = OUT_PATTERN) -> Column:
    """IN, OUT or SKIP, by matching the whole path. Half-written files are left out by their names."""

    def whole(pattern: str) -> Column:
        return path.rlike(f"^(?:{pattern})\\z")

    return F.when(whole(in_pattern), "IN").when(whole(out_pattern), "OUT").otherwise("SKIP")
