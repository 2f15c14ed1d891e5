"""Size-tiered compaction of immutable shards under a versioned manifest, with DataFrame functions only.

A table is a folder: ``data`` holds immutable Parquet shards, one folder for each
append or merge, ``manifests`` the lists of live shards, ``versions`` one small
file for each version, which names a list.  A version is committed by moving its
file to ``versions/<number>``: the move fails if the number is taken, so of two
writers one has to try again, and a reader sees a version whole or not at all.

:meth:`ShardedTable.append` writes arrivals as small shards.
:meth:`ShardedTable.compact` puts shards into tiers by the logarithm of their
size; runs of at least ``RUN`` shards of a tier, up to the target size each (and
``RAW`` times that before compression), are merged into one shard of a higher
tier.  All runs are merged by one distributed job: runs have dense numbers, a run's
rows go to the task of its number, which writes one file.  Shards of the target
size are never read again.

The driver handles folders - as many as there were appends and merges - never the
names of all shards: folders whose shards all live are read as they are, others
are joined with the manifest.  :meth:`ShardedTable.vacuum` deletes folders without
a live shard; a writer marks its folder as pending before it writes and until it
has committed, and such folders stay.

Defined results: every row is kept with all its columns, repeated and null ones
and very long texts too; an empty arrival commits a version without new shards;
shards of equal size are taken by file name; a table without a version reads as
empty; columns may have any names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, stored

ARRIVAL_ROWS = 4096
TARGET_BYTES = 32 << 20
RUN = 4
FANOUT = 4
#: Shards of a tier are planned in lanes of about so many, so that no task plans all of a large table.
LANE_SHARDS = 4096
ATTEMPTS = 8
#: A run may hold so many times the target size in values before they are compressed.
RAW = 16
LISTED = "file string, folder string, of long, rows long, bytes long, raw long"


class ShardedTable:
    def __init__(self, spark: SparkSession, root: str, schema, target: int = TARGET_BYTES):
        self.spark, self.root, self.schema, self.target = spark, root.rstrip("/"), schema, target
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join((self.root, *parts)))

    def version(self) -> int:
        """The newest version; 0: none."""
        folder = self._path("versions")
        if not self._files.exists(folder):
            return 0
        return max((int(s.getPath().getName()) for s in self._files.listStatus(folder) if s.getPath().getName().isdigit()), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """file, folder, shards that its folder was written with, rows, bytes and bytes before compression of a version's shards."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], LISTED)
        named = self.spark.read.text(self._path("versions", str(version)).toString()).first()[0]
        return self.spark.read.schema(LISTED).parquet(named)

    def _commit(self, shards: DataFrame, version: int) -> bool:
        """Make a list of shards the version; False if another writer has made it."""
        name = uuid.uuid4().hex
        listed = f"{self.root}/manifests/{name}"
        shards.write.parquet(listed)
        staged, final = self._path("staging", name), self._path("versions", str(version))
        self._files.mkdirs(self._path("versions"))
        out = self._files.create(staged, False)
        out.write(listed.encode())
        out.close()
        try:
            if self._files.exists(final):
                raise FileExistsError("AlreadyExists")
            context = self._hadoop.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
            options = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 1)
            options[0] = self._hadoop.Options.Rename.NONE
            context.rename(staged, final, options)
        except Exception as e:
            self._files.delete(staged, False)
            self._files.delete(self._hadoop.Path(listed), True)
            if "AlreadyExists" in str(e):
                return False
            raise
        return True

    def _pending(self, folder: str):
        return self._path("pending", folder)

    def _begin(self) -> str:
        """A new folder's name, marked as pending."""
        folder = uuid.uuid4().hex
        self._files.create(self._pending(folder), False).close()
        return folder

    def _rows_of(self, folders: Sequence[str], shard: str) -> DataFrame:
        """All rows of folders, with the shard's file as the column ``shard``."""
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/{f}" for f in folders])
        return rows.withColumn(shard, rows.metadataColumn("_metadata")["file_path"])

    def _written(self, folder: str) -> DataFrame:
        """The manifest's rows of a folder."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{folder}")
        kinds = dict(rows.dtypes)
        sizes = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) if kinds[c] in ("string", "binary") else F.lit(8) for c in rows.columns]
        about = rows.metadataColumn("_metadata")
        sized = rows.select(about["file_path"].alias("file"), about["file_size"].alias("bytes"), sum(sizes, F.lit(0).cast("long")).alias("raw"))
        listed = sized.groupBy("file", "bytes").agg(F.count("*").alias("rows"), F.sum("raw").alias("raw"))
        listed = stored(listed, "shards")
        return listed.select("file", F.lit(folder).alias("folder"), F.lit(listed.count()).cast("long").alias("of"), "rows", "bytes", "raw")

    def append(self, arrivals: DataFrame) -> int:
        """Add arrivals as small shards; the version that has them."""
        folder = self._begin()
        arrivals.select(*[F.col(f"`{n}`") for n in self.schema.names]).write.option("compression", "zstd").option("maxRecordsPerFile", ARRIVAL_ROWS).parquet(f"{self.root}/data/{folder}")
        added = self._written(folder)
        for _ in range(ATTEMPTS):
            now = self.version()
            if self._commit(self.manifest(now).unionByName(added), now + 1):
                self._files.delete(self._pending(folder), False)
                return now + 1
        raise RuntimeError("other writers kept committing")

    def plan(self, manifest: DataFrame) -> DataFrame:
        """file, folder and run of the shards to merge: runs of at least ``RUN`` shards of one tier, of the target size at most."""
        count = manifest.count()
        lane = F.pmod(F.xxhash64("file"), F.lit(max(1, count // LANE_SHARDS)))
        tier = F.floor(F.log(float(FANOUT), F.greatest(F.col("bytes"), F.lit(1)).cast("double")))
        weight = F.greatest(F.col("bytes"), F.floor(F.col("raw") / RAW))
        small = manifest.filter(weight < self.target // 2).select("file", "folder", "bytes", weight.alias("weight"), tier.alias("tier"), lane.alias("lane"))
        order = Window.partitionBy("tier", "lane").orderBy("bytes", "file")
        placed = small.withColumn("run", F.floor((F.sum("weight").over(order) - 1) / self.target))
        whole = Window.partitionBy("tier", "lane", "run")
        return placed.withColumn("size", F.count("*").over(whole)).filter(F.col("size") >= RUN).select("file", "folder", F.concat_ws("-", "tier", "lane", "run").alias("run"))

    def compact(self) -> bool:
        """Merge the runs of the newest version, if there are any; whether it did."""
        for _ in range(ATTEMPTS):
            now = self.version()
            manifest = self.manifest(now)
            plan = stored(self.plan(manifest), "runs")
            folders = [r[0] for r in plan.select("folder").distinct().collect()]
            if not folders:
                return False
            numbered = plan.select("run").distinct().withColumn("number", (F.row_number().over(Window.orderBy("run")) - 1).cast("int"))  # a row for each merged file
            runs, own = numbered.count(), self._begin()
            shard, number = free_name("__shard", self.schema.names), free_name("__run", self.schema.names)
            of_shard = plan.join(numbered, "run").select(F.col("file").alias(shard), F.col("number").alias(number))
            merged = self._rows_of(folders, shard).join(of_shard, shard).drop(shard).repartitionById(runs, number).drop(number)
            merged.write.option("compression", "zstd").parquet(f"{self.root}/data/{own}")
            rest = manifest.join(plan, "file", "left_anti")
            done = self._commit(rest.unionByName(self._written(own)), now + 1)
            self._files.delete(self._pending(own), False)  # not committed: nothing needs it
            if done:
                return True
        raise RuntimeError("other writers kept committing")

    def read(self, version: int | None = None, shard: str | None = None) -> DataFrame:
        """All rows of a version, with the shard's file as the column ``shard`` if that is named."""
        version = self.version() if version is None else version
        if version and version < self.oldest():
            raise ValueError(f"version {version} is not kept; the oldest is {self.oldest()}")
        manifest = self.manifest(version)
        folders = manifest.groupBy("folder").agg((F.count("*") == F.max("of")).alias("whole")).collect()  # one for each append or merge
        own = shard or free_name("__shard", self.schema.names)
        parts = []
        if whole := [r["folder"] for r in folders if r["whole"]]:
            parts.append(self._rows_of(whole, own))
        if partly := [r["folder"] for r in folders if not r["whole"]]:
            parts.append(self._rows_of(partly, own).join(manifest.select(F.col("file").alias(own)), own, "left_semi").select(*[f"`{n}`" for n in self.schema.names], own))
        if not parts:
            parts.append(self.spark.createDataFrame([], self.schema).withColumn(own, F.lit(None).cast("string")))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out if shard else out.drop(own)

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._files.listStatus(at)] if self._files.exists(at) else []

    def oldest(self) -> int:
        """The oldest version that :meth:`vacuum` has left readable."""
        return max((int(n) for n in self._names("vacuumed")), default=1)

    def vacuum(self, keep: int = 1) -> int:
        """Delete folders that none of the newest ``keep`` versions lists and no writer fills; how many.

        Folders are listed before the pending marks, and these before the versions:
        a folder whose mark is gone by then is committed by then, or never will be.
        Older versions can no longer be read.
        """
        folders, pending = self._names("data"), set(self._names("pending"))
        newest = self.version()
        kept = range(max(1, newest - keep + 1), newest + 1)
        if newest:
            self._files.create(self._path("vacuumed", str(max(self.oldest(), kept[0]))), True).close()
        live = {r[0] for v in kept for r in self.manifest(v).select("folder").distinct().collect()}
        gone = [f for f in folders if f not in live and f not in pending]
        for f in gone:
            self._files.delete(self._path("data", f), True)
        return len(gone)


def compacted(docs: DataFrame, root: str, arrivals: int = 4, key: str = "doc_id") -> ShardedTable:
    """A table of ``docs`` that arrive in parts (by the key's remainder) and are compacted after each."""
    table = ShardedTable(docs.sparkSession, root, docs.schema)
    part = F.coalesce(F.pmod(F.col(key), F.lit(arrivals)), F.lit(0))
    for k in range(arrivals):
        table.append(docs.filter(part == k))
        while table.compact():
            table.vacuum()
    return table
