"""Projections that follow a column list, and derivations that depend on a column being there."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filefeatures.problems import FileProblem

log = logging.getLogger(__name__)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def match_columns(existing: Sequence[str], wanted: Iterable[str]) -> dict[str, str]:
    """Wanted name -> existing name, in wanted order; letter case only counts when it must."""
    by_lower = {name.lower(): name for name in reversed(existing)}
    exact = set(existing)
    found = {}
    for name in wanted:
        if name in exact:
            found[name] = name
        elif name.lower() in by_lower:
            found[name] = by_lower[name.lower()]
    return found


def select_wanted(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in wanted order and spelling."""
    found = match_columns(df.columns, wanted)
    if not found:
        raise FileProblem(f"none of the wanted columns is in the input: {df.columns}")
    return df.select(*[F.col(quoted(have)).alias(name) for name, have in found.items()])


def select_strict(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep exactly these columns; a missing one is an analysis error."""
    return df.select(*[F.col(quoted(name)) for name in names])


def add_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


@dataclass(frozen=True)
class Derivation:
    """New columns computed from one source column."""

    source: str
    columns: Callable[[Column], Mapping[str, Column]]


def derive_if_present(df: DataFrame, derivations: Iterable[Derivation]) -> tuple[DataFrame, list[str]]:
    """Add the derivations whose source column exists, all in one projection; also give the new names."""
    new: dict[str, Column] = {}
    for derivation in derivations:
        found = match_columns(df.columns, [derivation.source])
        if found:
            new.update(derivation.columns(F.col(quoted(found[derivation.source]))))
        else:
            log.warning("no column %r in the input, its derivations are left out", derivation.source)
    return (df.withColumns(new) if new else df), list(new)
