"""Stores for the profile, for state by user and for fitted models, on any file system Spark reaches."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.profile import changed_lists, collect_tags, one_change, united_lists
from tagloom.session import local_frame, materialised, shuffle_partitions

PROFILE_SCHEMA = "userId string, tagsId string"


def _files(spark: SparkSession, path: str):
    """A path of any file system Spark reaches, and that file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear whole under its name, unless that name is taken; tells whether it did.

    It is written under another name first. On a local disk a link is what only one of two writers gets, elsewhere a rename
    that does not overwrite.
    """
    target, files = _files(spark, path)
    own, _ = _files(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getUri().getScheme() == "file":
            os.link(own.toUri().getPath(), target.toUri().getPath())
        else:
            options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(own, target, options)
    except (FileExistsError, Py4JJavaError):
        if not files.exists(target):
            raise
        return False
    finally:
        files.delete(own, False)
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, None where there is none."""
    at, files = _files(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer published the next version first."""


class BucketStore:
    """A keyed table in hash buckets below one folder, with a manifest for every version.

    A manifest names the folder that holds each bucket. A write puts the touched buckets into a new folder and publishes a
    manifest that takes the others over from the version it started from, so what it costs follows what changed. Files that a
    reader may hold are never touched. Of two writers that start from one version the one that publishes second fails and has
    to start anew; a writer that dies has published nothing and is in nobody's way. With ``keep`` a write retires all but that
    many of the newest versions; readers of older ones must be done by then, so it should be 2 or more.

    ``buckets`` counts for the first version, by default as many as shuffle partitions; a bucket should fit in one task.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, keep: int | None = None, buckets: int | None = None):
        if keep is not None and keep < 2:
            raise ValueError("keep must be 2 or more: the next version is made from the newest one")
        self.spark, self.root, self.schema, self.key, self.keep = spark, root.rstrip("/"), schema, key, keep
        self.columns = T.StructType.fromDDL(schema).names
        self.buckets = buckets

    # --- reading ------------------------------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        pattern, files = _files(self.spark, f"{self.root}/manifest-*.json")
        return sorted(int(f.getPath().getName()[9:-5]) for f in files.globStatus(pattern) or [])

    def version(self) -> int:
        """Number of the newest version, 0 when there is none."""
        return max(self._numbers(), default=0)

    def _manifest(self, version: int) -> dict:
        text = read_text(self.spark, f"{self.root}/manifest-{version:06d}.json") if version else None
        if version and text is None:
            raise KeyError(f"no version {version} below {self.root}")
        return json.loads(text) if text else {"buckets": self.buckets or shuffle_partitions(self.spark), "folders": {}, "note": {}}

    def note(self, version: int | None = None) -> dict:
        """What the writer of a version said about it."""
        return self._manifest(self.version() if version is None else version)["note"]

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows of a version, by default the newest one, or those of some buckets."""
        folders = self._manifest(self.version() if version is None else version)["folders"]
        wanted = [b for b in folders if buckets is None or int(b) in set(buckets)]
        if not wanted:
            return local_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{folders[b]}/{BUCKET}={b}" for b in wanted])

    # --- writing ------------------------------------------------------------------------------------------------

    def dealt(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int"))

    def _commit(self, rows: DataFrame, base: int, manifest: dict, folders: dict, note: dict | None) -> DataFrame:
        folder = f"data-{uuid.uuid4().hex}"
        at, files = _files(self.spark, f"{self.root}/{folder}")
        try:
            rows.select(*self.columns, BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
            made = [f.getPath().getName() for f in files.listStatus(at) if f.isDirectory()]
            now = folders | {name.split("=")[1]: folder for name in made if name.startswith(f"{BUCKET}=")}
            text = json.dumps({"buckets": manifest["buckets"], "folders": now, "note": manifest["note"] if note is None else note}, sort_keys=True)
            if self.version() > base or not publish(self.spark, f"{self.root}/manifest-{base + 1:06d}.json", text):
                raise Conflict(f"version {base + 1} was written by another job: start anew from the current version")
        except BaseException:
            files.delete(at, True)
            raise
        self._retire(base + 1)
        return self.read(base + 1)

    def replace(self, rows: DataFrame, base: int | None = None, note: dict | None = None) -> DataFrame:
        """Write a whole table as the next version, and return it as read back.

        ``base`` is the version that ``rows`` were made from, by default the current one.
        """
        base = self.version() if base is None else base
        manifest = self._manifest(base)
        return self._commit(self.dealt(rows, manifest["buckets"]).repartition(BUCKET), base, manifest, {}, note)

    def merge(self, changes: DataFrame, combine: Callable[[DataFrame, Sequence[str]], DataFrame], base: int | None = None,
              note: dict | None = None) -> DataFrame:
        """Write the next version with ``changes`` worked into the buckets that they touch.

        ``combine`` gets the old rows and the changes of these buckets in one frame, told apart by ``_new``, dealt by bucket, and
        the columns that its grouping must begin with, so that no further shuffle is needed.
        """
        base = self.version() if base is None else base
        manifest = self._manifest(base)
        changes = materialised(self.dealt(changes, manifest["buckets"]), "changes")
        # At most as many rows as there are buckets.
        touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
        old = self.dealt(self.read(base, touched), manifest["buckets"]).withColumn("_new", F.lit(False))
        stacked = old.unionByName(changes.withColumn("_new", F.lit(True))).repartition(max(len(touched), 1), BUCKET)
        return self._commit(combine(stacked, [BUCKET, self.key]), base, manifest, manifest["folders"], note)

    def _retire(self, newest: int):
        """Delete the manifests that are ``keep`` or more versions older than the newest, and folders only they name."""
        if self.keep is None:
            return
        numbers = self._numbers()
        held, gone = ([n for n in numbers if (n <= newest - self.keep) is old] for old in (False, True))
        named = {f for n in held for f in self._manifest(n)["folders"].values()}
        for n in gone:
            for old in {*self._manifest(n)["folders"].values()} - named:
                at, files = _files(self.spark, f"{self.root}/{old}")
                files.delete(at, True)
            at, files = _files(self.spark, f"{self.root}/manifest-{n:06d}.json")
            files.delete(at, False)


class ProfileStore(BucketStore):
    """The profile, one row and one tag list a user."""

    def __init__(self, spark: SparkSession, root: str, keep: int | None = None, buckets: int | None = None):
        super().__init__(spark, root, PROFILE_SCHEMA, "userId", keep, buckets)

    def upsert(self, changes: DataFrame) -> DataFrame:
        """Write the profile with the rows of ``changes`` put in place of those of the same users."""
        return self.merge(one_change(changes), changed_lists)

    def add(self, new: DataFrame, base: int | None = None) -> DataFrame:
        """Write the profile with the tags of ``new`` added to those of the same users."""
        return self.merge(collect_tags(new), united_lists, base)


def fingerprint(df: DataFrame, columns: Sequence[str]) -> str:
    """Number and content of the rows, whatever their order: one pass, combined in the tasks."""
    content = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    rows, total = df.agg(F.count("*"), content).first()
    return hashlib.sha256(f"{rows}:{total}".encode()).hexdigest()[:16]


def stored_centres(spark: SparkSession, path: str, k: int, features: Sequence[str],
                   fit: Callable[[], Sequence[Sequence[float]]], refresh: bool = False, data: DataFrame | None = None,
                   parameters: dict | None = None) -> list[list[float]]:
    """Load the cluster centres saved below ``path`` for this ``k`` and these features, or fit and save them.

    With ``data`` or ``parameters`` a model is loaded only for the same rows and the same parameters; other ones are fitted anew
    and kept beside it. Centres are published whole, so one reads those of a complete save or none, and of two jobs that fit at
    once both use what the first one published. ``refresh`` fits anew in any case.
    """
    told = {"k": k, "features": list(features), "parameters": parameters or {}, "data": fingerprint(data, features) if data is not None else None}
    named = "-".join(features) if data is None and not parameters else hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()[:32]
    pattern, files = _files(spark, f"{path.rstrip('/')}/{named}-k{k}.*.json")

    def name(number: int) -> str:
        return f"{path.rstrip('/')}/{named}-k{k}.{number:06d}.json"

    newest = max((int(f.getPath().getName().split(".")[-2]) for f in files.globStatus(pattern) or []), default=0)
    if refresh or not newest:
        centres = [[float(x) for x in centre] for centre in fit()]
        newest += 1
        publish(spark, name(newest), json.dumps(told | {"centres": centres}))
    return json.loads(read_text(spark, name(newest)))["centres"]
