"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than space, tab, LF, VT, FF and CR."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row.

    Inside a lambda a plain column may be inlined and then evaluated for every element;
    a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once however often it is read later.

    The generator keeps filters and projections above it from being merged with the
    expression. One row in, one row out.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df has it (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
