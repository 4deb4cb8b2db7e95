"""Shared helpers: reading tables, written intermediate results in the cluster's shared folder, text slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract here.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of text that one vectorised slice works on.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A cluster has to name one; in local mode, as in tests, it may be this machine's own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Intermediate tables, written as Parquet to the shared folder so that a lost executor loses none of them.

    They cut lineage. drop() removes the tables that no later result reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.made = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        self.names: dict[int, str] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.folder}/{self.made:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def save_bucketed(self, df: DataFrame, name: str, buckets: int, keys: list[str], order: list[str] | None = None) -> DataFrame:
        """Like save(), with one file a bucket, sorted by the keys or by order; df has to be partitioned into `buckets` by the keys."""
        self.made += 1
        path, known = f"{self.folder}/{self.made:03d}-{name}", f"scratch_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, *keys).sortBy(*(order or keys)).option("path", path).format("parquet").saveAsTable(known)
        out = self.spark.table(known)
        self.paths[id(out)], self.names[id(out)] = (out, path), known
        return out

    @contextmanager
    def sorted_buckets(self) -> Iterator[None]:
        """While it lasts, plans rely on the order inside the buckets of save_bucketed()."""
        key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        old = self.spark.conf.get(key)
        self.spark.conf.set(key, "true")
        try:
            yield
        finally:
            self.spark.conf.set(key, old)

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables of save() that nothing to come reads."""
        for df in tables:
            if name := self.names.pop(id(df), None):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df))[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop_all(self, *kept: DataFrame) -> None:
        """Removes all tables of save() but these."""
        known = {id(df) for df in kept}
        self.drop(*(df for key, (df, _) in list(self.paths.items()) if key not in known))


#: Items of an array that are folded together: appending to an array copies it, so long ones are folded in parts.
PART = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, also where use reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(items: Column, lead: Callable[[Column], Column], size: Callable[[Column], Column], tail: int = 0, **rest: tuple[str, Callable[[Column], Column]]) -> Column:
    """array<struct<start int, end int, *rest>>: where the items of an array lie, each with `lead` signs before it, `size` of
    its own and `tail` behind. rest: name to (type, value of the item). In time linear in the items."""
    kind = "struct<start:int,end:int" + "".join(f",{n}:{t}" for n, (t, _) in rest.items()) + ">"
    none = F.expr(f"cast(array() as array<{kind}>)")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + lead(x)
        end = start + size(x)
        own = F.struct(start.alias("start"), end.alias("end"), *(f(x).alias(n) for n, (_, f) in rest.items()))
        return F.struct((end + tail).alias("at"), F.concat(acc["found"], F.array(own)).alias("found"))

    def shifted(part: Column, by: Column) -> Column:
        return F.transform(part["found"], lambda x: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end"), *(x[n].alias(n) for n in rest)))

    fold = lambda part: F.aggregate(part, F.struct(F.lit(0).alias("at"), none.alias("found")), add)
    parts = lambda every: F.transform(F.sequence(F.lit(0), F.ceil(F.size(every) / PART).cast("int") - 1), lambda i: fold(F.slice(every, i * PART + 1, F.lit(PART))))
    before = lambda folded: F.slice(F.aggregate(folded, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"]))), F.lit(1), F.size(folded))
    whole = lambda folded: F.flatten(F.zip_with(folded, before(folded), shifted))
    return bound(items, lambda every: F.when(F.size(every) > 0, bound(parts(every), whole)).otherwise(none))


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that further columns of the input cannot clash."""
    return df.select(*(df[old].alias(new) for new, old in columns.items()))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, last row + 1, UTF-8 texts) of pieces of a batch with about `most` bytes; null is empty."""
    texts = batch.column(column).cast(pa.large_binary())
    start, size, held = 0, 0, []
    for i, x in enumerate(texts):
        b = x.as_py() or b""
        held.append(b)
        size += len(b)
        if size >= most:
            yield start, i + 1, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, start + len(held), held


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def n_tokens(text):
    """Words: runs of signs other than white space; none in null. The length that mixing and packing go by."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
