"""A keyed table in versions: key ranges of files under a manifest. A write copies the ranges that its keys fall into and no others.

A version is one small JSON file that lists the ranges, each a folder of Parquet files with its smallest key. Files are never changed; a write makes
new ones for the touched ranges and then publishes a manifest that names them beside the untouched ones. Until then readers see the version before,
and a write that dies leaves files that nothing names. A reader keeps to the manifest that it opened. Ranges that grow past twice the wanted
size are split by key when they are written; a key of any size is dealt over several files of its range.

What the driver holds is the list of ranges, one entry for about `rows` rows. One writer at a time: a second one finds its version taken and
raises Conflict, and nothing of it is seen.

Cases: a null key is in the first range and never matches a group or key; an empty write still makes a version; rows keep the columns
of the first version, others are dropped and missing ones null.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.upsert import replace_groups, upsert


class Conflict(RuntimeError):
    """Another writer has published the version that this one was to be."""


class KeyedStore:
    """The table below `path`, kept by `key` (a number or a string) in ranges of about `rows` rows."""

    def __init__(self, spark: SparkSession, path: str, key: str, rows: int = 1_000_000):
        self.spark, self.path, self.key, self.rows = spark, path.rstrip("/"), key, rows
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # Manifests

    def versions(self) -> list[int]:
        folder = self._at(f"{self.path}/manifests")
        if not self._files.exists(folder):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in self._files.listStatus(folder) if s.getPath().getName().endswith(".json") and s.getPath().getName()[0] not in "._")

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version, of the newest by default; None where there is none."""
        there = self.versions()
        if version is None and not there:
            return None
        name = there[-1] if version is None else version
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{name:012d}.json", wholetext=True).first()[0])

    def _publish(self, manifest: dict) -> None:
        target, draft = (self._at(f"{self.path}/manifests/{name}") for name in (f"{manifest['version']:012d}.json", f"_{uuid.uuid4().hex}"))
        out = self._files.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._files.exists(target) or not self._files.rename(draft, target):
            self._files.delete(draft, False)
            raise Conflict(f"version {manifest['version']} of {self.path} is there already")

    # Reading

    def _read(self, manifest: dict, places: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [r["folder"] for i, r in enumerate(manifest["ranges"]) if r["folder"] and (places is None or i in places)]
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default. What is read stays that version's, whatever is written later, until vacuum() drops it."""
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"{self.path} has no version")
        return self._read(manifest)

    # Writing

    def _place(self, lows: list) -> Column:
        """The range of a key: how many ranges begin at or below it, the first aside, found by halving."""
        if len(lows) < 2:
            return F.lit(0)
        written = lambda x: f"cast(X'{x.encode().hex()}' as string)" if isinstance(x, str) else f"double('{x}')" if isinstance(x, float) else f"{x}L"
        there, key = F.expr(f"array({', '.join(written(x) for x in lows[1:])})"), F.col(self.key)
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(lows).bit_length()))])
        found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(there, at + step - 1) <= key, at + step).otherwise(at))
        return F.when(F.col(self.key).isNull(), 0).otherwise(found).cast("int")

    def _cuts(self, keys: DataFrame, parts: int) -> list:
        """Keys that cut the distinct keys into about as many ranges."""
        dealt = keys.where(F.col(self.key).isNotNull()).distinct().repartitionByRange(parts, self.key)
        lows = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(self.key).alias("low")).collect()
        return sorted(r.low for r in lows)[1:]

    def _write(self, rows: DataFrame, lows: list, version: int) -> dict[int, dict]:
        """Writes the rows' ranges as new files; the range number, folder and count of each that has rows."""
        folder = f"data/{version:012d}-{uuid.uuid4().hex[:8]}"
        rows.withColumn("range_", self._place(lows)).hint("rebalance", "range_").write.partitionBy("range_").parquet(f"{self.path}/{folder}")
        if not any(s.isDirectory() for s in self._files.listStatus(self._at(f"{self.path}/{folder}"))):
            return {}
        counts = self.spark.read.parquet(f"{self.path}/{folder}").groupBy("range_").count().collect()
        return {r["range_"]: {"folder": f"{folder}/range_={r['range_']}", "rows": r["count"]} for r in counts}

    def create(self, rows: DataFrame, batch: int | None = None) -> int:
        """The first version."""
        if self.versions():
            raise Conflict(f"{self.path} has versions already")
        parts = max(1, -(-rows.count() // self.rows))
        lows = [None, *(self._cuts(rows.select(self.key), parts) if parts > 1 else [])]
        made = self._write(rows, lows, 1)
        ranges = [{"low": low, "folder": None, "rows": 0} | made.get(i, {}) for i, low in enumerate(lows)]
        self._publish({"version": 1, "key": self.key, "batch": batch, "schema": rows.schema.jsonValue(), "ranges": ranges})
        return 1

    def commit(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], arriving: DataFrame | None = None, batch: int | None = None) -> int:
        """A version in which the ranges of the keys hold what change() makes of their rows; arriving: the rows that it adds at most.

        batch: a number that is kept with the version; a write with a number at or below the newest one's has been done and does nothing.
        """
        old = self.manifest()
        if batch is not None and old["batch"] is not None and batch <= old["batch"]:
            return old["version"]
        ranges, version = old["ranges"], old["version"] + 1
        place = self._place([r["low"] for r in ranges])
        touched = sorted(r.p for r in keys.select(place.alias("p")).distinct().collect())
        held = self._read(old, touched)
        more = {} if arriving is None else {r.p: r["count"] for r in arriving.groupBy(place.alias("p")).count().collect()}
        known = held.select(self.key) if arriving is None else held.select(self.key).union(arriving.select(self.key))
        cuts: dict[int, list] = {}
        for p in touched:
            parts = (ranges[p]["rows"] + more.get(p, 0)) // self.rows
            if parts > 1:
                cuts[p] = self._cuts(known.where(place == p), parts)
        lows = [(p, low) for p, r in enumerate(ranges) for low in [r["low"], *cuts.get(p, [])]]
        names = [f.name for f in T.StructType.fromJson(old["schema"]).fields]
        made = self._write(change(held).select(*names), [low for _, low in lows], version) if touched else {}
        new = [{"low": low, "folder": None, "rows": 0} | made.get(i, {}) if p in touched else ranges[p] for i, (p, low) in enumerate(lows)]
        self._publish({**old, "version": version, "batch": old["batch"] if batch is None else batch, "ranges": new})
        return version

    def _shaped(self, rows: DataFrame) -> DataFrame:
        fields = T.StructType.fromJson(self.manifest()["schema"]).fields
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    def replace(self, rows: DataFrame, groups: DataFrame | None = None, batch: int | None = None) -> int:
        """Stored rows of the groups (of the rows' keys by default) go, the rows come; a group without rows is cleared."""
        own = self._shaped(rows)
        groups = (own if groups is None else groups).select(self.key)
        return self.commit(groups.union(own.select(self.key)), lambda held: replace_groups(held, own, groups, self.key), own, batch)

    def merge(self, rows: DataFrame, provided: dict[str, Column] | None = None, batch: int | None = None) -> int:
        """Rows overwrite or join those of their key, column by column, as upsert() does."""
        own = rows.select(*[c for c in rows.columns if c in [f["name"] for f in self.manifest()["schema"]["fields"]]])
        return self.commit(own, lambda held: upsert(held, own, self.key, provided), self._shaped(own), batch)

    # Upkeep

    def compact(self) -> int:
        """A version of the same rows in ranges cut anew, for ranges that have become small."""
        old = self.manifest()
        rows = self._read(old)
        parts = max(1, -(-sum(r["rows"] for r in old["ranges"]) // self.rows))
        lows = [None, *(self._cuts(rows.select(self.key), parts) if parts > 1 else [])]
        made = self._write(rows, lows, old["version"] + 1)
        self._publish({**old, "version": old["version"] + 1, "ranges": [{"low": low, "folder": None, "rows": 0} | made.get(i, {}) for i, low in enumerate(lows)]})
        return old["version"] + 1

    def vacuum(self, keep: int = 2) -> None:
        """Drops all but the newest versions and the files that only dropped versions or dead writes have; not while one is written."""
        kept = self.versions()[-keep:]
        named = {r["folder"] for v in kept for r in self.manifest(v)["ranges"] if r["folder"]}
        for version in self.versions()[:-keep]:
            self._files.delete(self._at(f"{self.path}/manifests/{version:012d}.json"), False)
        if self._files.exists(self._at(f"{self.path}/data")):
            for made in self._files.listStatus(self._at(f"{self.path}/data")):
                for part in self._files.listStatus(made.getPath()):
                    if part.isDirectory() and f"data/{made.getPath().getName()}/{part.getPath().getName()}" not in named:
                        self._files.delete(part.getPath(), True)
                if not any(s.isDirectory() for s in self._files.listStatus(made.getPath())):
                    self._files.delete(made.getPath(), True)
