"""A table with one row per key, changed by the bucket and published by the version."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rankdex.operators.upsert import keyed_add, keyed_put
from rankdex.sources import versions

_VERSION = "rankdex.version"
_KEY = "rankdex.key"
_BUCKETS = "rankdex.buckets"
_BUCKET = "_bucket"


class KeyedTable:
    """A catalog table opened, or created empty if absent, under ``name``.

    Rows lie in ``buckets`` by the hash of ``key``. A version is a table in the catalog
    that says where each bucket's folder is. A put or add reads, shuffles and writes only
    the buckets that its keys fall into; the next version takes over all others from the
    one before, by the names of their folders. The tables are bucketed for Spark as well:
    a put that touches all buckets shuffles its updates only, and lookups and joins by
    key read buckets as they are.

    Versions are numbered, and a number is claimed by one writer (``versions.claim``). A
    writer that finds the number after the version it read to be taken fails with a
    ``RuntimeError``, and its rows are not in the table: put them again. So none of two
    concurrent writes is lost unnoticed. ``name`` is a view on the newest version, for
    SQL. A failed or repeated write leaves the table as it was, and readers of the
    version before keep their files; those of older ones are deleted.

    Keys are never NULL. A table opened again has to be given the key, the buckets and
    the types of columns that it has. Columns keep their declared types.

    Files go where the catalog keeps ``name``'s schema; on a cluster that is
    shared storage. Use as many ``buckets`` as give files of about 1 GB.
    """

    def __init__(
        self, spark: SparkSession, name: str, key: str, schema: T.StructType | str, buckets: int = 200
    ):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets
        *schema_name, table = name.split(".")
        of = ".".join(schema_name) or spark.catalog.currentDatabase()
        described = spark.sql(f"DESCRIBE SCHEMA {of}").collect()
        location = next(r["info_value"] for r in described if r["info_name"] == "Location").rstrip("/")
        self._claims, self._data = f"{location}/{table}.versions", f"{location}/{table}.data"
        asked = spark.createDataFrame([], schema).schema
        if not spark.catalog.tableExists(name):
            try:
                self._write(spark.createDataFrame([], asked), versions.latest(spark, self._claims), {})
                return
            except RuntimeError:
                pass  # another one has created it
        self._show()
        known = {f.name: f.dataType for f in self.read().schema}
        own = {_KEY: key, _BUCKETS: str(buckets)}
        for what, value in own.items():
            if (stored := self._property(what)) != value:
                raise ValueError(f"{name} has {what} {stored}, not {value}")
        for field in asked:
            if known.get(field.name) != field.dataType:
                raise ValueError(f"{name} has {field.name} of type {known.get(field.name)}")

    def read(self) -> DataFrame:
        return self._rows(self._manifest())

    def put(
        self, updates: DataFrame, order_by: Sequence[Column] = (), keep: str = "last"
    ) -> None:
        """Replace or insert whole rows; nothing is written when there are none.

        Keys are counted first, which moves keys only, and tells the buckets. Where none
        repeats, which is the usual case, the wide rows are then shuffled once, into
        their buckets.
        """
        if not updates.isEmpty():
            began = self._manifest()
            counts = updates.groupBy(self.key).count()
            repeated, without, touched = counts.agg(
                F.max(F.col("count") > 1), F.max(F.col(self.key).isNull()), F.collect_set(self._bucket(began))
            ).first()
            if without:
                raise ValueError(f"{self.key} is NULL")
            put = keyed_put(self._rows(began, touched), updates, self.key, order_by, keep, unique=not repeated)
            self._publish(put, began[_VERSION], touched)

    def add(self, deltas: DataFrame, column: str) -> None:
        """Add to ``column`` of existing rows, or insert rows. NULL deltas add nothing."""
        if not deltas.isEmpty():
            began = self._manifest()
            if not deltas.where(F.col(self.key).isNull()).isEmpty():
                raise ValueError(f"{self.key} is NULL")
            deltas = deltas.where(F.col(column).isNotNull())
            touched = deltas.agg(F.collect_set(self._bucket(began))).first()[0]
            if touched:
                self._publish(keyed_add(self._rows(began, touched), deltas, self.key, column), began[_VERSION], touched)

    def _bucket(self, manifest: dict) -> Column:
        """The bucket of a key, as Spark numbers them."""
        kind = self.spark.table(manifest[_VERSION]).schema[self.key].dataType
        return F.pmod(F.hash(F.col(self.key).cast(kind)), F.lit(self.buckets))

    def _manifest(self, number: int | None = None) -> dict:
        """What the newest version, or that of ``number``, consists of."""
        number = versions.latest(self.spark, self._claims) if number is None else number
        return {"number": number, **json.loads(versions.content(self.spark, self._claims, number))}

    def _rows(self, manifest: dict, touched: Iterable[int] | None = None) -> DataFrame:
        rows = self.spark.table(manifest[_VERSION])
        if touched is not None and len(set(touched)) < self.buckets:
            rows = rows.where(F.col(_BUCKET).isin(sorted(touched)))
        return rows.drop(_BUCKET)

    def _property(self, name: str) -> str:
        return self._manifest()[name]

    def _publish(self, df: DataFrame, began: str, touched: Iterable[int] | None = None) -> None:
        """Make ``df`` the rows of the buckets ``touched``, or of all, in the version
        after ``began``."""
        manifest = self._manifest()
        if manifest[_VERSION] != began:
            raise RuntimeError(f"{self.name} was written by another writer")
        types = {f.name: f.dataType for f in self.spark.table(began).schema}
        df = df.select(*(F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns))
        gone = set(range(self.buckets) if touched is None else touched)
        kept = {bucket: folder for bucket, folder in manifest["folders"].items() if int(bucket) not in gone}
        self._write(df, manifest["number"], kept)
        self._clean(manifest["number"] - 1)

    def _write(self, df: DataFrame, before: int, kept: dict[str, str]) -> None:
        """Store ``df`` with the buckets ``kept`` as the version after number ``before``."""
        version = f"{self.name}_{uuid.uuid4().hex}"
        path = f"{self._data}/{version.rsplit('_', 1)[1]}"
        bucket = F.pmod(F.hash(self.key), F.lit(self.buckets))
        writer = df.withColumn(_BUCKET, bucket).write.format("parquet").option("path", path).partitionBy(_BUCKET)
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(version)
        written = [row[0].split("=")[1] for row in self.spark.sql(f"SHOW PARTITIONS {version}").collect()]
        folders = {**kept, **{b: f"{path}/{_BUCKET}={b}" for b in written}}
        if kept:
            taken = " ".join(f"PARTITION ({_BUCKET}={b}) LOCATION '{folder}'" for b, folder in kept.items())
            self.spark.sql(f"ALTER TABLE {version} ADD {taken}")
        manifest = {_VERSION: version, _KEY: self.key, _BUCKETS: str(self.buckets), "data": path, "folders": folders}
        if not versions.claim(self.spark, self._claims, before + 1, json.dumps(manifest)):
            self.spark.sql(f"DROP TABLE {version}")
            versions.remove(self.spark, path)
            raise RuntimeError(f"{self.name} was written by another writer")
        self._show()

    def _show(self) -> None:
        """Point the view at the newest version, whoever made it."""
        shown = None
        while shown != (version := self._property(_VERSION)):
            columns = ", ".join(f"`{c}`" for c in self.spark.table(version).columns if c != _BUCKET)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT {columns} FROM {version}")
            shown = version

    def _clean(self, number: int) -> None:
        """Drop a version and delete what only it and older ones consist of."""
        if number < 1:
            return
        old = self._manifest(number)
        used = {folder for n in (number + 1, number + 2) for folder in self._manifest(n)["folders"].values()}
        self.spark.sql(f"DROP TABLE IF EXISTS {old[_VERSION]}")
        for folder in set(old["folders"].values()) - used:
            versions.remove(self.spark, folder)
