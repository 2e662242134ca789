"""Name normalisation (F1) and alias substitution (F2) as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(c: str | Column) -> Column:
    """collapse whitespace runs to one space and trim; null -> ``""``.

    ``(?U)`` makes ``\\s`` match Unicode whitespace, as Python's ``\\s`` does.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(F.regexp_replace(col, r"(?U)\s+", " ")), F.lit(""))


def apply_aliases(c: str | Column, aliases: Mapping[str, str]) -> Column:
    """exact-name substitution from a literal map, before F1."""
    col = F.col(c) if isinstance(c, str) else c
    if not aliases:
        return col
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.element_at(m, col), col)


def entity_name(c: str | Column, aliases: Mapping[str, str]) -> Column:
    """Join key for entity names: aliases first, then normalisation."""
    return normalise_name(apply_aliases(c, aliases))


def plain_feature(name: str | Column) -> Column:
    """a design column's name without its kind (``num__``, ``flags__``, ``cat__``)."""
    return F.regexp_replace(F.col(name) if isinstance(name, str) else name, "^(num|flags|cat)__", "")


def feature_kind(name: str | Column) -> Column:
    """The kind that a design column's name starts with; empty without one."""
    return F.regexp_extract(F.col(name) if isinstance(name, str) else name, "^(num|flags|cat)__", 1)
