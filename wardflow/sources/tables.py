"""Publishing results: views, full-refresh tables and keyed incremental tables."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardflow.functions import surrogate_key, text_of
from wardflow.operators.ordered import same_keys
from wardflow.session import remove, settle

LAYERS = {"staging": "bronze", "intermediate": "silver", "advanced": "silver", "marts": "gold", "seeds": "seeds"}


def publish_view(df: DataFrame, name: str, layer: str | None = None) -> str:
    """Register a session view, prefixed with its layer."""
    view = f"{layer}_{name}" if layer else name
    df.createOrReplaceTempView(view)
    return view


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it is not there."""
    fs, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()) if fs.exists(at) else []


def _committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders below a path whose write came to its end."""
    done = []
    for name in _folders(spark, path):
        fs, at = _files(spark, f"{path}/{name}/_SUCCESS")
        if fs.exists(at):
            done.append(int(name))
    return sorted(done)


class PublishedTable:
    """A table that is replaced as a whole: each load is written beside the others, then a mark names it.

    A load that dies leaves the rows before it readable. Loads that no mark needs any more go with the
    next load but one, so that readers of the last one end in peace.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def loads(self) -> list[int]:
        """Numbers of the loads that were published, oldest first."""
        return _committed(self.spark, f"{self.path}/marks")

    def current(self) -> str:
        """Folder of the rows published last."""
        loads = self.loads()
        if not loads:
            raise ValueError(f"nothing is published at {self.path}")
        return self._rows(loads[-1])

    def _rows(self, load: int) -> str:
        return f"{self.path}/rows/{load:06d}"

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.current())

    def publish(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Replaces the rows; `df` may read the table it replaces."""
        loads = self.loads()
        load = loads[-1] + 1 if loads else 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._rows(load))
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/{load:06d}")
        for old in loads[:-1]:
            remove(self.spark, f"{self.path}/marks/{old:06d}")
            remove(self.spark, self._rows(old))
        return self._rows(load)


def publish_table(df: DataFrame, root: str, layer: str, name: str, partition_by: list[str] | None = None) -> str:
    """Replace the table at root/layer/name; gives the folder its rows are in now."""
    return PublishedTable(df.sparkSession, f"{root.rstrip('/')}/{layer}/{name}").publish(df, partition_by)


#: Digest of a row, kept beside it.
DIGEST = "__digest"
BUCKET = "__bucket"


class KeyedTable:
    """A Parquet table whose rows are replaced by key, in hash buckets of the key.

    A key holds one row or many: a merge replaces all rows of the keys it names. Rows carry a digest, so keys
    that come again as they are cost a look at keys and digests of their buckets only. Each merge writes the
    buckets it changes anew, below a new version, then a manifest that says which version holds each
    bucket; a run that dies before the manifest leaves the table as it was, and its next attempt overwrites
    the leftover. Reading is a plain scan, of some buckets where that will do. One writer at a time.

    `ignore` names columns that do not make a row differ, such as the time of the load. The number of
    buckets is that of the first merge: take it so that one bucket is what a small merge may rewrite.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str | list[str], buckets: int = 32, ignore: tuple[str, ...] = ("_last_updated",)
    ):
        self.spark, self.path, self.buckets, self.ignore = spark, path.rstrip("/"), buckets, ignore
        self.keys = [key] if isinstance(key, str) else list(key)
        # The manifest read last, by its version; a manifest never changes.
        self._known: tuple[int, dict] | None = None

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return _committed(self.spark, f"{self.path}/manifests")

    def exists(self) -> bool:
        return bool(self.versions())

    def _rows(self, version: int) -> str:
        return f"{self.path}/rows/{version:06d}"

    def _manifest(self) -> dict | None:
        """The newest manifest: schema, number of buckets, watermark, and the version of each bucket that has rows."""
        versions = self.versions()
        if not versions:
            return None
        if self._known and self._known[0] == versions[-1]:
            return self._known[1]
        row = self.spark.read.schema("manifest string").parquet(f"{self.path}/manifests/{versions[-1]:06d}").first()
        held = json.loads(row["manifest"])
        held["holds"] = {int(b): v for b, v in held["holds"].items()}
        self.buckets = held["buckets"]
        self._known = versions[-1], held
        return held

    def _scan(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        """Rows with their digests, of all or of some buckets."""
        schema = StructType.fromJson(manifest["schema"])
        wanted = sorted(manifest["holds"]) if buckets is None else sorted(set(buckets) & set(manifest["holds"]))
        paths = [f"{self._rows(manifest['holds'][b])}/{BUCKET}={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame:
        """All rows."""
        manifest = self._manifest()
        if manifest is None:
            raise ValueError(f"nothing was merged into {self.path}")
        return self._scan(manifest).drop(DIGEST)

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; only their buckets are read."""
        manifest = self._manifest()
        keys = keys.select(*self.keys).distinct()
        held = self._scan(manifest, self._buckets_of(keys))
        return held.join(keys, same_keys(held, keys, self.keys), "left_semi").drop(DIGEST)

    def watermark(self):
        """Highest source value consumed so far; None before the first load or when all were NULL."""
        manifest = self._manifest()
        return manifest and manifest["watermark"]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self._bucket()).distinct().collect()]  # at most one row per bucket

    def _groups(self, rows: DataFrame, name: str) -> DataFrame:
        """One row per key: how many rows it has and the sum of their digests."""
        total = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(DIGEST).cast("decimal(38,0)")).alias("sum"))
        return rows.groupBy(*self.keys).agg(total.alias(name))

    def merge(self, updates: DataFrame, watermark=None, touched: DataFrame | None = None) -> int:
        """Replaces all rows of the keys in `updates`, and removes those of the other keys in `touched`.

        Gives the number of keys that changed. With no change only the watermark is written, if it moved.
        """
        manifest = self._manifest()
        mark = str(watermark) if watermark is not None else manifest and manifest["watermark"]
        counted = [c for c in updates.columns if c not in self.ignore]
        new = settle(updates.withColumn(DIGEST, F.xxhash64(*[F.col(c) for c in sorted(counted)])))
        if manifest is None:
            self._commit(new, 1, {}, mark, new.schema)
            return new.select(*self.keys).distinct().count()
        after = self._groups(new, "after")
        if touched is None:
            # Only keys of the updates can change: they are looked up, and no list of them is made.
            own = self._scan(manifest, self._buckets_of(new)).select(*self.keys, DIGEST)
            before, how = self._groups(own, "before"), "right"
        else:
            named = settle(new.select(*self.keys).unionByName(touched.select(*self.keys)).distinct())
            own = self._scan(manifest, self._buckets_of(named)).select(*self.keys, DIGEST)
            before, how = self._groups(own.join(named, same_keys(own, named, self.keys), "left_semi"), "before"), "full_outer"
        both = before.join(after, same_keys(before, after, self.keys), how).filter(~F.col("before").eqNullSafe(F.col("after")))
        changed = settle(both.select(*[F.coalesce(before[k], after[k]).alias(k) for k in self.keys]))
        sizes = {r["b"]: r["n"] for r in changed.groupBy(self._bucket().alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        buckets = sorted(sizes)
        if not buckets and [f.name for f in new.schema] == [f["name"] for f in manifest["schema"]["fields"]]:
            if mark != manifest["watermark"]:
                self._write_manifest(self.versions()[-1] + 1, manifest | {"watermark": mark})
            return 0
        held = self._scan(manifest, buckets)
        kept = held.join(changed, same_keys(held, changed, self.keys), "left_anti")
        rows = kept.unionByName(new.join(changed, same_keys(new, changed, self.keys), "left_semi"), allowMissingColumns=True)
        holds = {b: v for b, v in manifest["holds"].items() if b not in buckets}
        self._commit(rows, self.versions()[-1] + 1, holds, mark, rows.schema)
        return sum(sizes.values())

    def _commit(self, rows: DataFrame, version: int, holds: dict[int, int], watermark: str | None, schema: StructType) -> None:
        # Files by bucket, large buckets cut into several: that is for the adaptive plan to balance.
        dealt = rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
        dealt.write.mode("overwrite").option("compression", "zstd").partitionBy(BUCKET).parquet(self._rows(version))
        written = [int(name.split("=")[1]) for name in _folders(self.spark, self._rows(version)) if name.startswith(f"{BUCKET}=")]
        held = {"schema": schema.jsonValue(), "buckets": self.buckets, "watermark": watermark}
        self._write_manifest(version, held | {"holds": holds | dict.fromkeys(written, version)})

    def _write_manifest(self, version: int, manifest: dict) -> None:
        text = self.spark.range(1).select(F.lit(json.dumps(manifest)).alias("manifest")).coalesce(1)
        text.write.mode("overwrite").parquet(f"{self.path}/manifests/{version:06d}")

    def compact(self) -> None:
        """Removes manifests but the newest, and rows that it does not need. No reader of older ones may be left."""
        versions, manifest = self.versions(), self._manifest()
        for version in versions[:-1]:
            remove(self.spark, f"{self.path}/manifests/{version:06d}")
            stale = [b for b in _folders(self.spark, self._rows(version)) if manifest["holds"].get(int(b.split("=")[1])) != version]
            for bucket in stale:
                remove(self.spark, f"{self._rows(version)}/{bucket}")
            if version not in manifest["holds"].values():
                remove(self.spark, self._rows(version))


class HistoryTable:
    """The versions of each key over time: open rows in a keyed table, closed rows appended by run.

    A run writes the rows it closes, then merges the rows it opens; the merge's manifest commits both, as
    closed rows of runs that are not committed are not read. `runs` lists what each run did.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, check: list[str], buckets: int = 32):
        self.spark, self.path, self.key, self.check = spark, path.rstrip("/"), key, check
        self.open = KeyedTable(spark, f"{self.path}/open", key, buckets, ignore=())

    def _closed(self) -> list[str]:
        """Folders of closed rows whose run was committed."""
        done = self.open.versions()
        runs = [int(name) for name in _folders(self.spark, f"{self.path}/closed")]
        return [f"{self.path}/closed/{run:06d}" for run in runs if done and run <= done[-1]]

    def read(self) -> DataFrame:
        """All versions of all keys; valid_to is NULL where a version is open."""
        live = self.open.read()
        folders = self._closed()
        return live.unionByName(self.spark.read.schema(live.schema).parquet(*folders), allowMissingColumns=True) if folders else live

    def snapshot(self, current: DataFrame, as_of: Column) -> tuple[int, int]:
        """Takes the state of all keys (one row each) at a time; gives how many versions it closed and opened.

        A key whose checked columns differ gets a new version. One that is not in `current` keeps its open
        version. The same state again, at whatever time, changes nothing.
        """
        stamp = as_of.cast("timestamp_ntz")
        opened = current.select(
            "*",
            stamp.alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            surrogate_key(F.col(self.key), text_of(stamp)).alias("row_id"),
        )
        if not self.open.exists():
            count = self.open.merge(opened, self._stamp(stamp))
            self._note(1, stamp, 0, count)
            return 0, count
        live = self.open.read()
        differs = reduce(or_, [~live[c].eqNullSafe(opened[c]) for c in self.check])
        run = self.open.versions()[-1] + 1
        closing = live.join(opened, (live[self.key] == opened[self.key]) & differs, "left_semi").withColumn("valid_to", stamp)
        closed = f"{self.path}/closed/{run:06d}"
        closing.write.mode("overwrite").parquet(closed)
        ended = self.spark.read.schema(closing.schema).parquet(closed).count()
        same = live.select(F.col(self.key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in self.check])
        unchanged = reduce(and_, [opened[c].eqNullSafe(same[f"__{c}"]) for c in self.check])
        starting = opened.join(same, (opened[self.key] == same["__key"]) & unchanged, "left_anti")
        count = self.open.merge(starting, self._stamp(stamp))
        self._note(run, stamp, ended, count)
        return ended, count

    def _stamp(self, stamp: Column) -> str:
        return self.spark.range(1).select(stamp.cast("string")).first()[0]

    def _note(self, run: int, stamp: Column, closed: int, opened: int) -> None:
        row = self.spark.range(1).select(
            F.lit(run).alias("run"), stamp.alias("as_of"), F.lit(closed).alias("closed"), F.lit(opened).alias("opened")
        )
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/runs/{run:06d}")

    def runs(self) -> DataFrame:
        """One row per run: its number, time, and how many versions it closed and opened."""
        return self.spark.read.parquet(f"{self.path}/runs/*")
