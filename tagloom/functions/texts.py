"""Column expressions over URLs, tag lists and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRODUCT_MARK = "/product/"
PAGE_MARK = ".html"


def is_blank(text: Column) -> Column:
    """Null, empty or only whitespace."""
    return F.coalesce(F.regexp_replace(text, r"\s+", ""), F.lit("")) == ""


def item_of_url(url: Column) -> Column:
    """Text between the first ``/product/`` and the first ``.html`` of the whole URL.

    Null when either is missing or ``.html`` comes first.
    """
    start = F.instr(url, PRODUCT_MARK)
    end = F.instr(url, PAGE_MARK)
    item = F.substr(url, start + len(PRODUCT_MARK), end - start - len(PRODUCT_MARK))
    return F.when((start > 0) & (end > start), item)


def tag_set(*tag_lists: Column) -> Column:
    """Sorted union of comma-separated tag lists without duplicates; null when all are blank."""
    filled = [F.when(~is_blank(t), t) for t in tag_lists]
    tags = F.filter(F.split(F.concat_ws(",", *filled), ","), lambda t: t != "")
    joined = F.array_join(F.array_sort(F.array_distinct(tags)), ",")
    return F.when(joined != "", joined)


def struct_field_csv(structs: Column, field: str) -> Column:
    """One field of an array of structs as a comma-separated text, in array order."""
    return F.array_join(F.transform(structs, lambda s: s[field].cast("string")), ",")


def tokens(text: Column) -> Column:
    """Lower-case text split on single whitespace characters, without empty tokens at the end."""
    lower = F.lower(text)
    trimmed = F.regexp_replace(lower, r"\s+$", "")
    empty = F.array().cast("array<string>")
    return F.when((trimmed == "") & (lower != ""), empty).otherwise(F.split(trimmed, r"\s"))
