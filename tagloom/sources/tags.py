"""The tag table in versions, with the models of its tags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.ordering import number_rows
from tagloom.operators.rules import upsert_paths
from tagloom.session import materialised
from tagloom.sources.readers import TAG_SCHEMA
from tagloom.sources.stores import BucketStore, Conflict

MODEL_FIELDS = "model_name string, state int"


def _appended(stacked: DataFrame, keys) -> DataFrame:
    return stacked


class TagStore(BucketStore):
    """Tags with their models, one row a tag, so that a tag and its models appear in one version.

    The manifest of a version holds the next free ids. Ids are given from it before the rows are written, and the version is
    published only if no other one came first; otherwise the ids are given anew from that one. So two writers never give one id
    twice, and the id of a tag that was taken out is not given again. New tags have new ids, so an append rewrites only the
    buckets that these fall into, and looks at no old row.
    """

    def __init__(self, spark: SparkSession, root: str, model_fields: str = MODEL_FIELDS, keep: int | None = None,
                 buckets: int | None = None):
        self.model_columns = T.StructType.fromDDL(model_fields).names
        models = T.ArrayType(T.StructType.fromDDL(f"id long, {model_fields}"))
        super().__init__(spark, root, f"{TAG_SCHEMA}, models {models.simpleString()}", "id", keep, buckets)
        self.model_type = models

    def tags(self, version: int | None = None) -> DataFrame:
        return self.read(version).drop("models")

    def models(self, version: int | None = None) -> DataFrame:
        """``(id, tag_id, fields of the model)``, one row a model."""
        each = self.read(version).select(F.col("id").alias("tag_id"), F.explode("models").alias("m"))
        return each.select("m.id", "tag_id", *[F.col(f"m.{c}") for c in self.model_columns])

    def load(self, tags: DataFrame, models: DataFrame | None = None) -> DataFrame:
        """Write a whole tag table, with the models of its tags, as the next version.

        A model of an unknown tag is an error. A tag keeps the id it has.
        """
        base = self.version()
        rows = tags.select("id", "name", "rule", "level", "pid", F.lit(None).cast(self.model_type).alias("models"))
        top = 0
        if models is not None:
            each = F.struct(F.col("id"), *[F.col(c) for c in self.model_columns]).alias("m")
            # A tag has a handful of models, so its list is short.
            lists = models.select("tag_id", each).groupBy("tag_id").agg(F.sort_array(F.collect_list("m")).alias("lists"))
            known = rows.withColumn("_tag", F.lit(True)).join(lists, F.col("id") == F.col("tag_id"), "full")
            checked = F.when(F.col("_tag").isNull(), F.raise_error(F.lit("a model without its tag"))).otherwise(F.col("id"))
            rows = known.select(checked.cast("long").alias("id"), "name", "rule", "level", "pid",
                                F.col("lists").cast(self.model_type).alias("models"))
            top = models.agg(F.max("id")).first()[0] or 0
        rows = materialised(rows, "tags")
        before = self._free(base)
        last = rows.agg(F.max("id")).first()[0] or 0
        return self.replace(rows, base, {"tag": max(last + 1, before[0]), "model": max(top + 1, before[1])})

    def _free(self, version: int) -> tuple[int, int]:
        note = self.note(version)
        return note.get("tag", 1), note.get("model", 1)

    def _repeated(self, write: Callable[[int], DataFrame], base: int | None, tries: int) -> DataFrame:
        """Write from a stated version once, or from the newest one, anew whenever another writer was first."""
        for left in reversed(range(1 if base is not None else tries)):
            try:
                return write(self.version() if base is None else base)
            except Conflict:
                if not left:
                    raise
        raise ValueError("tries must be 1 or more")

    def _add(self, rows: DataFrame, base: int, note: dict) -> DataFrame:
        """Publish new rows; returns them."""
        self.merge(rows, _appended, base, note)
        return rows

    def append(self, new: DataFrame, order_by: list[str], base: int | None = None, tries: int = 5) -> DataFrame:
        """Give the next free ids to new tags in the order of ``order_by`` and publish them; returns the rows with their ids.

        ``new`` has name, rule, level and parent; where it has the fields of a model as well, each tag gets one model, numbered
        in the same order. An empty table writes nothing.
        """
        fields = [c for c in self.model_columns if c in new.columns]
        if fields and len(fields) != len(self.model_columns):
            raise ValueError(f"a model has the fields {self.model_columns}")
        # Numbered once: a repeated attempt only adds to the numbers.
        numbered = materialised(number_rows(new.select("name", "rule", "level", "pid", *fields), order_by, "_n"), "new-tags")
        count = numbered.count()

        def write(version: int) -> DataFrame:
            tag, model = self._free(version)
            of_tag = F.struct((F.col("_n") + (model - 1)).alias("id"), *fields)
            models = (F.array(of_tag) if fields else F.lit(None)).cast(self.model_type)
            rows = numbered.select((F.col("_n") + (tag - 1)).cast("long").alias("id"), "name", "rule", F.col("level").cast("int"),
                                   F.col("pid").cast("long"), models.alias("models"))
            return self._add(rows, version, {"tag": tag + count, "model": model + (count if fields else 0)}) if count else rows

        return self._repeated(write, base, tries)

    def add_paths(self, paths: DataFrame, base: int | None = None, tries: int = 5) -> DataFrame:
        """Publish the tags of ``(name1, name2, name3)`` paths that are missing; returns these.

        What is missing is found anew in the version of another writer, so two writers of one path make one tag of it.
        """
        paths = materialised(paths.select("name1", "name2", "name3").distinct(), "paths")

        def write(version: int) -> DataFrame:
            tag, model = self._free(version)
            whole = upsert_paths(self.tags(version), paths, tag)
            rows = whole.where(F.col("id") >= tag).withColumn("models", F.lit(None).cast(self.model_type))
            last = rows.agg(F.max("id")).first()[0]
            return rows if last is None else self._add(rows, version, {"tag": last + 1, "model": model})

        return self._repeated(write, base, tries)
