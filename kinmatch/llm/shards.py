"""Sharding with size-tiered compaction and versioned manifests.

A store is a folder with immutable Parquet files and manifests ``manifest/v<number>.json``; the highest number is the
current state. Arrivals are appended as runs of small files. ``compact`` puts runs of similar size (within half and one
and a half times their mean) into a tier; a tier of ``fan_in`` runs is merged into one run of files of about
``target_bytes``. Runs whose files have that size are sealed and never rewritten, so a row is rewritten a logarithmic
number of times.

A commit writes a manifest beside the others and renames it, which fails if another writer took that version; then the
change is tried again on the new state. Readers see one manifest and so one whole state; a job that dies leaves files
that no manifest names. Data is read and written by Spark only; the driver handles file names and sizes, one entry for
each file of the target size.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TARGET_BYTES, FAN_IN = 128 << 20, 4


class Conflict(RuntimeError):
    """Another writer committed a version that this change cannot follow."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN):
        if fan_in < 2 or target_bytes < 1:
            raise ValueError("fan_in of 2 or more and a positive target size are needed")
        self.spark, self.root, self.target_bytes, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in

    # ---- files, through Hadoop's layer: the store may lie anywhere that Spark can write

    def _path(self, rel: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{rel}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, rel: str) -> list[tuple[str, int]]:
        fs, p = self._fs(), self._path(rel)
        if not fs.exists(p):
            return []
        return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(p))

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n, _ in self._list("manifest") if n.startswith("v") and n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """A version's manifest, the last one if none is given; an empty one before the first commit."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "schema": None, "runs": []}
        at = max(known) if version is None else version
        stream = self._fs().open(self._path(f"manifest/v{at:010d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _commit(self, manifest: dict) -> None:
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        own = self._path(f"manifest/.tmp-{uuid.uuid4().hex}")
        out = fs.create(own, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        to = self._path(f"manifest/v{manifest['version']:010d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri() if to.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(own, to, options)
        except Exception as e:
            fs.delete(own, False)
            if "AlreadyExists" in str(e) or fs.exists(to):
                raise Conflict(f"version {manifest['version']} is taken") from e
            raise

    def _change(self, add: list[dict], remove: Iterable[str] = (), schema: str | None = None, tries: int = 10) -> int:
        """Commits a state with runs added and removed on top of the current one."""
        gone = set(remove)
        for _ in range(tries):
            now = self.manifest()
            if gone - {r["id"] for r in now["runs"]}:
                raise Conflict("runs of this change are no longer there")
            if schema and now["schema"] and json.loads(schema) != json.loads(now["schema"]):
                raise ValueError("the arrival's schema differs from the store's")
            runs = [r for r in now["runs"] if r["id"] not in gone] + add
            try:
                self._commit({"version": now["version"] + 1, "schema": now["schema"] or schema, "runs": runs})
            except Conflict:
                continue
            return now["version"] + 1
        raise Conflict("other writers were faster each time")

    def _run(self, rel: str, rows: int) -> dict:
        files = [{"path": f"{rel}/{n}", "bytes": b} for n, b in self._list(rel) if n.endswith(".parquet")]
        return {"id": rel.rsplit("/data/")[-1], "rows": rows, "bytes": sum(f["bytes"] for f in files), "files": files}

    # ---- appending

    def append(self, df: DataFrame) -> int:
        """Commits df's rows as one run of small files; the new version."""
        run, schema = self._write(df)
        return self._change([run], schema=schema)

    def _write(self, df: DataFrame) -> tuple[dict, str]:
        rel, seen = f"data/{uuid.uuid4().hex}", Observation()
        schema = _nullable(df.schema).json()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/{rel}")
        return self._run(rel, seen.get["rows"]), schema

    def stage(self, df: DataFrame, arrival: str, arrivals: Iterable[int]) -> tuple[dict[int, dict], str]:
        """Writes several arrivals, told apart by the whole numbers of column ``arrival``, in one pass over df, without
        committing them: runs by arrival, for ``append_run``. The column isn't stored. Rows with other numbers or null
        there are an error, not lost."""
        arrivals = list(arrivals)
        rel, seen = f"data/{uuid.uuid4().hex}", Observation()
        counts = [F.count_if(F.col(arrival) == a).alias(f"n{a}") for a in arrivals]
        observed = df.observe(seen, F.count(F.lit(1)).alias("all"), *counts)
        observed.write.partitionBy(arrival).parquet(f"{self.root}/{rel}")
        found = seen.get
        if found["all"] != sum(found[f"n{a}"] for a in arrivals):
            raise ValueError("some rows belong to none of the arrivals")
        return {a: self._run(f"{rel}/{arrival}={a}", found[f"n{a}"]) for a in arrivals}, _nullable(df.drop(arrival).schema).json()

    def append_run(self, run: dict, schema: str) -> int:
        return self._change([run], schema=schema)

    # ---- compaction

    def sealed(self, run: dict) -> bool:
        return bool(run["files"]) and run["bytes"] >= self.target_bytes / 2 * len(run["files"])

    def tiers(self, runs: list[dict]) -> list[list[dict]]:
        """Runs that aren't sealed, in groups of similar size."""
        out: list[list[dict]] = []
        for r in sorted((r for r in runs if not self.sealed(r)), key=lambda r: (r["bytes"], r["id"])):
            mean = sum(x["bytes"] for x in out[-1]) / len(out[-1]) if out else None
            if mean is not None and r["bytes"] <= max(1.5 * mean, 1):
                out[-1].append(r)
            else:
                out.append([r])
        return out

    def compact(self) -> int:
        """Merges tiers until none has ``fan_in`` runs; the number of merges."""
        merges = 0
        while group := next((t for t in self.tiers(self.manifest()["runs"]) if len(t) >= self.fan_in), None):
            n = max(1, math.ceil(sum(r["bytes"] for r in group) / self.target_bytes))
            new, _ = self._write(self._read(group).coalesce(n))
            if new["rows"] != sum(r["rows"] for r in group):
                raise RuntimeError("a merge must keep all rows")
            self._change([new], [r["id"] for r in group])
            merges += 1
        return merges

    # ---- reading

    def _read(self, runs: list[dict]) -> DataFrame:
        schema = StructType.fromJson(json.loads(self.manifest()["schema"]))
        paths = [f"{self.root}/{f['path']}" for r in runs for f in r["files"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, of the last one if none is given."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError("nothing has been appended yet")
        return self._read(m["runs"])

    def vacuum(self, keep: int = 1) -> int:
        """Deletes the manifests but the last ``keep`` and the files that only they name; the number of files."""
        known = sorted(self.versions())
        old, stay = known[:-keep], known[-keep:]
        live = {f["path"] for v in stay for r in self.manifest(v)["runs"] for f in r["files"]}
        dead = {f["path"] for v in old for r in self.manifest(v)["runs"] for f in r["files"]} - live
        fs = self._fs()
        for v in old:
            fs.delete(self._path(f"manifest/v{v:010d}.json"), False)
        for p in dead:
            fs.delete(self._path(p), False)
        return len(dead)


def _nullable(schema: StructType) -> StructType:
    from pyspark.sql.types import StructField

    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def in_arrivals(docs: DataFrame, root: str, n_arrivals: int = 16, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN) -> ShardStore:
    """A store to which docs have come in ``n_arrivals`` batches by doc_id, compacted after each, old versions removed.

    Rows stay whole, repeated ones too; rows with a null doc_id come with the first batch. Any columns are stored. An empty
    table makes a store of empty runs.
    """
    store = ShardStore(docs.sparkSession, root, target_bytes, fan_in)
    batch = F.coalesce(F.pmod(F.col("doc_id"), F.lit(n_arrivals)), F.lit(0)).cast("int")
    name = "__arrival"
    while name in docs.columns:
        name += "_"
    runs, schema = store.stage(docs.withColumn(name, batch), name, range(n_arrivals))
    for a in range(n_arrivals):
        store.append_run(runs[a], schema)
        if store.compact():
            store.vacuum()
    return store


SQL = "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents"
