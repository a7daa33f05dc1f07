"""Column expressions over rule texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_rule_map(rule: Column) -> Column:
    """``k=v##k=v`` as a map; a piece without ``=`` gets a null value."""
    return F.str_to_map(rule, F.lit("##"), F.lit("="))


def source_rule_field(rule: Column, key: str) -> Column:
    """One value of a source rule, empty when the key is absent."""
    return F.coalesce(F.element_at(source_rule_map(rule), key), F.lit(""))
