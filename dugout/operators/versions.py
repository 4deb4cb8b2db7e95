"""An incremental store of keyed tables: a manifest names the files of each table and partition.

A batch is merged into the partitions that it changes and into no others. New files lie beside the old ones until a new
manifest names them; manifests are numbered, and a number can be taken once, so of two writers that started from the same
version one has to look again: it keeps its files if the other one changed other partitions, else it merges anew. Readers
see one version as a whole. A batch that changes nothing makes no version, and a numbered batch of a source is applied once.

Deleting games writes their ids beside the partitions, which hide their rows when they are read; a whole partition goes by
leaving it out of the manifest. compact() rewrites what is hidden, forget() removes files that no version names.

The manifest is as large as the number of tables times partitions (seasons); it is the one thing that the driver holds.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

T = TypeVar("T")
#: Tables of a batch that are worked on at the same time.
JOBS = 4


@dataclass(frozen=True)
class Keyed:
    """A table: its key, the SQL expression of a row's partition, whose row stays where a key is there already (the new one,
    or the old), its parents as (table, column), and the column by which rows are deleted, which tells the partition then."""

    keys: tuple[str, ...]
    partition: str = "''"
    keeps: str = "new"
    parents: tuple[tuple[str, str], ...] = ()
    owner: str | None = None


class Taken(RuntimeError):
    """Another writer took the version's number."""


def _place(spec: Keyed) -> Column:
    """The partition of a row; rows whose expression is null have one too."""
    return F.coalesce(F.expr(f"CAST({spec.partition} AS STRING)"), F.lit(""))


def _same(a: str, b: str, columns: Iterable[str]) -> Column:
    return reduce(and_, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns))


class Store:
    """Versions of keyed tables under root. tables: name to Keyed, parents before their children."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Keyed]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- manifests -----------------------------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/versions")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, number: int | None = None) -> dict:
        """{version, sources, tables: {name: {schema, parts: {partition: {dir, hides}}}}} of a version, by default the last."""
        if number is None and not (number := max(self._numbers(), default=0)):
            return {"version": 0, "sources": {}, "tables": {}}
        stream = self._fs.open(self._path(f"{self.root}/versions/{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> int:
        """Makes manifest visible under its number; Taken if that exists."""
        target = self._path(f"{self.root}/versions/{manifest['version']:012d}.json")
        staged = self._path(f"{self.root}/versions/.{uuid.uuid4().hex}")
        out = self._fs.create(staged, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(staged), self._fs.makeQualified(target), none)
        except Py4JJavaError as error:
            self._fs.delete(staged, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Taken(manifest["version"]) from error
            raise
        return manifest["version"]

    def _publish(self, base: dict, changes: dict[str, dict], schemas: dict[str, str], source: tuple[str, int] | None) -> int:
        """Commits changed partitions on top of base, or of what others made of it while they left these partitions alone."""
        while True:
            tables = {n: {"schema": t["schema"], "parts": dict(t["parts"])} for n, t in base["tables"].items()}
            for name, parts in changes.items():
                held = tables.setdefault(name, {"schema": schemas.get(name), "parts": {}})["parts"]
                held.update({p: x for p, x in parts.items() if x})
                for p in [p for p, x in parts.items() if not x]:
                    held.pop(p, None)
            try:
                return self._commit({"version": base["version"] + 1, "sources": base["sources"] | (dict([source]) if source else {}), "tables": tables})
            except Taken:
                now = self.manifest()
                at = lambda m, n, p: m["tables"].get(n, {"parts": {}})["parts"].get(p)
                if any(at(now, n, p) != at(base, n, p) for n, parts in changes.items() for p in parts) or source and now["sources"].get(source[0], -1) >= source[1]:
                    raise
                base = now

    # --- reading -------------------------------------------------------------------------------------------------

    def _read(self, manifest: dict, name: str, partitions: Iterable[str] | None = None) -> DataFrame | None:
        held = manifest["tables"].get(name)
        if held is None:
            return None
        schema, hidden = StructType.fromJson(json.loads(held["schema"])), {}
        for p, x in held["parts"].items():
            if partitions is None or p in partitions:
                hidden.setdefault(tuple(x["hides"]), []).append(f"{self.root}/{x['dir']}")
        out = None
        for hides, folders in hidden.items():
            rows = self.spark.read.schema(schema).parquet(*folders)
            if hides:
                rows = rows.join(self.spark.read.parquet(*(f"{self.root}/{h}" for h in hides)), self.tables[name].owner, "left_anti")
            out = rows if out is None else out.unionByName(rows)
        return out if out is not None else self.spark.createDataFrame([], schema)

    def read(self, name: str, partitions: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """A table of a version, by default the last; only the files of some partitions, if they are named."""
        found = self._read(self.manifest(version), name, set(partitions) if partitions is not None else None)
        if found is None:
            raise KeyError(f"no table {name} is stored in {self.root}")
        return found

    # --- writing -------------------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, folder: str, parts: list[str], order: tuple[str, ...] = ()) -> dict[str, dict]:
        """rows with _part, one folder for each partition: {partition: {dir, hides}}. Partitions without rows are None.

        Rows of a partition come together, but Spark splits a large one over tasks; files are sorted, so that a search by the
        key skips most of them.
        """
        place = F.array_position(F.array(*map(F.lit, parts)), F.col("_part")).cast("int")
        rows.withColumn("_p", place).drop("_part").hint("rebalance", "_p").sortWithinPartitions("_p", *order).write.partitionBy("_p").parquet(f"{self.root}/{folder}")
        made = {s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}"))}
        return {p: {"dir": f"{folder}/_p={i}", "hides": []} if f"_p={i}" in made else None for i, p in enumerate(parts, 1)}

    @staticmethod
    def _each(work: Callable[[str], T], names: list[str]) -> dict[str, T]:
        """The tables' jobs beside each other; all have ended when it returns or fails."""
        with ThreadPoolExecutor(JOBS) as pool:
            return dict(zip(names, pool.map(work, names), strict=True))

    def _incoming(self, name: str, rows: DataFrame, folder: str) -> DataFrame:
        """A batch's rows of a table with _part, written down and checked for repeated keys."""
        spec, path = self.tables[name], f"{self.root}/{folder}/in-{name}"
        rows.withColumn("_part", _place(spec)).write.parquet(path)
        rows = self.spark.read.parquet(path)
        if repeated := rows.groupBy(*spec.keys).agg(F.count("*").alias("n")).where("n > 1").limit(3).collect():
            raise ValueError(f"keys of {name} that more than one row of the batch has: {[tuple(r)[:-1] for r in repeated]}")
        return rows

    def _merged(self, base: dict, name: str, new: DataFrame, folder: str) -> tuple[dict[str, dict], DataFrame]:
        """The partitions that a batch changes, written, and the rows that it adds or changes."""
        spec, columns = self.tables[name], [c for c in new.columns if c != "_part"]
        parts = sorted(r[0] for r in new.select("_part").distinct().collect())  # partitions, not rows
        held = base["tables"].get(name, {"parts": {}})["parts"]
        stored = self._read(base, name, set(parts)) if any(p in held for p in parts) else None
        if stored is not None:
            known = spec.keys if spec.keeps == "old" else columns
            new = new.alias("n").join(stored.alias("s"), _same("n", "s", known), "left_anti").select("n.*")
            parts = sorted(r[0] for r in new.select("_part").distinct().collect())
        if not parts:
            return {}, new
        out = new
        if stored is not None:
            kept = stored.withColumn("_part", _place(spec)).where(F.col("_part").isin(parts))
            kept = kept.alias("s").join(new.select(*spec.keys).alias("n"), _same("s", "n", spec.keys), "left_anti").select("s.*")
            out = kept.unionByName(new, allowMissingColumns=True)
        return self._write(out, f"{folder}/{name}", parts, spec.keys), new

    def _check_parents(self, base: dict, batch: dict[str, DataFrame], added: dict[str, DataFrame]) -> None:
        for name, rows in added.items():
            for parent, key in self.tables[name].parents:
                stored, wanted = self._read(base, parent), rows.where(F.col(key).isNotNull()).select(key).distinct()
                for known in (batch.get(parent), stored):
                    if known is not None:
                        wanted = wanted.join(known.select(key).distinct(), key, "left_anti")
                if missing := wanted.limit(3).collect():
                    raise ValueError(f"rows of {name} without a row of {parent} for their {key}: {[r[0] for r in missing]}")

    def merge(self, batch: dict[str, DataFrame], source: tuple[str, int] | None = None, tries: int = 5) -> int:
        """The version that holds the batch; all of its tables become visible at once, or none.

        source: a stream's name and the batch's number in it; a number that was applied already changes nothing.
        """
        mark = f"data/{uuid.uuid4().hex}"
        try:
            incoming: dict[str, DataFrame] = {}
            for attempt in range(tries):
                base = self.manifest()
                if source and base["sources"].get(source[0], -1) >= source[1]:
                    return base["version"]
                if not incoming:
                    incoming = self._each(lambda n: self._incoming(n, batch[n], mark), [n for n in self.tables if n in batch])
                found = self._each(lambda n: self._merged(base, n, incoming[n], f"{mark}/{attempt}"), list(incoming))  # noqa: B023
                self._check_parents(base, incoming, {n: added for n, (parts, added) in found.items() if parts})
                changes = {n: parts for n, (parts, _) in found.items() if parts}
                fresh = [n for n in incoming if n not in base["tables"]]
                if not changes and not fresh:
                    return base["version"]
                schemas = {n: rows.drop("_part").schema.json() for n, rows in incoming.items()}
                try:
                    number = self._publish(base, {n: {} for n in fresh} | changes, schemas, source)
                except Taken:
                    continue
                for n in incoming:
                    self._fs.delete(self._path(f"{self.root}/{mark}/in-{n}"), True)
                return number
            raise Taken(f"{tries} other versions changed the same partitions")
        except BaseException:
            self._fs.delete(self._path(f"{self.root}/{mark}"), True)
            raise

    # --- deleting ------------------------------------------------------------------------------------------------

    def _owned(self, manifest: dict) -> list[str]:
        return [n for n, t in self.tables.items() if t.owner and n in manifest["tables"]]

    def hidden_by(self, gone: DataFrame) -> DataFrame:
        """(table_name, n): the rows that delete() would hide."""
        base = self.manifest()
        counts = (self._read(base, n).join(gone.select(self.tables[n].owner).distinct(), self.tables[n].owner, "left_semi").agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in self._owned(base))
        return reduce(DataFrame.unionByName, counts)

    def delete(self, gone: DataFrame) -> int:
        """Hides the rows of gone's owners, of all tables that have the column; no data file is written anew."""
        base, mark = self.manifest(), f"data/{uuid.uuid4().hex}"
        changes: dict[str, dict] = {}
        written: dict[tuple[str, str], dict[str, dict]] = {}
        for name in self._owned(base):
            spec, held = self.tables[name], base["tables"][name]["parts"]
            if (at := (spec.owner, spec.partition)) not in written:
                rows = gone.select(spec.owner).distinct().withColumn("_part", _place(spec))
                parts = sorted(r[0] for r in rows.select("_part").distinct().collect())
                written[at] = self._write(rows.where(F.col("_part").isin(parts)), f"{mark}/hides-{len(written)}", parts) if parts else {}
            changes[name] = {p: held[p] | {"hides": [*held[p]["hides"], x["dir"]]} for p, x in written[at].items() if x and p in held}
        if not any(changes.values()):
            self._fs.delete(self._path(f"{self.root}/{mark}"), True)
            return base["version"]
        return self._publish(base, changes, {}, None)

    def delete_partition(self, partition: str) -> int:
        """Leaves a partition of all owned tables out of the next version: no file is written but the manifest."""
        base = self.manifest()
        changes = {n: {partition: None} for n in self._owned(base) if partition in base["tables"][n]["parts"]}
        return self._publish(base, changes, {}, None) if changes else base["version"]

    def compact(self) -> int:
        """Rewrites the partitions of which rows are hidden."""
        base, mark, changes = self.manifest(), f"data/{uuid.uuid4().hex}", {}
        for name, held in base["tables"].items():
            if parts := sorted(p for p, x in held["parts"].items() if x["hides"]):
                # what is left of each is written; one of which nothing is left goes
                rows = self._read(base, name, parts).withColumn("_part", _place(self.tables[name]))
                changes[name] = self._write(rows, f"{mark}/{name}", parts, self.tables[name].keys)
        return self._publish(base, changes, {}, None) if changes else base["version"]

    def forget(self, keep: int = 1, orphan_hours: float = 24) -> None:
        """Removes all but the last versions, the files that only those named, and older ones that none ever did."""
        numbers = self._numbers()
        files = lambda which: {f for n in which for t in self.manifest(n)["tables"].values() for x in t["parts"].values() for f in (x["dir"], *x["hides"])}
        kept, gone = files(numbers[-keep:]), files(numbers[:-keep])
        for folder in gone - kept:
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.root}/versions/{n:012d}.json"), False)
        used, data = {f.split("/")[1] for f in kept}, self._path(f"{self.root}/data")
        for status in self._fs.listStatus(data) if self._fs.exists(data) else []:
            named = status.getPath().getName()
            if named not in used and (named in {f.split("/")[1] for f in gone} or status.getModificationTime() / 1000 < time.time() - 3600 * orphan_hours):
                self._fs.delete(status.getPath(), True)
