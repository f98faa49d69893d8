"""Rows in buckets as batches change them, on shared storage, without a rewrite of what stays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes that no longer count for each byte that does, at which a bucket is merged.
FOLD = 0.5
#: Parts of a bucket from which all of its changes are taken for such bytes.
PARTS = 32
#: Tasks that the rows of a bucket are laid out for.
SLICES = 16
#: Where rows are laid out: a site lies in one bucket, a file of it in one slice.
PLACE = ["_bucket", "_slice"]


def site_bucket(buckets: int):
    return F.pmod(F.xxhash64("site_url"), F.lit(buckets).cast("bigint")).cast("int")


def lay_out(rows: DataFrame, buckets: int, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows with equal `keys` in one task, those of a bucket in at most SLICES, with PLACE in front of the columns.

    What looks at rows by PLACE and `keys` needs no other shuffle, nor does a write by buckets.
    A large site is spread by its keys. Rows sorted by `order` first travel in fewer bytes.
    """
    slice_ = F.pmod(F.xxhash64(*keys), F.lit(SLICES).cast("bigint")).cast("int")
    placed = rows.select(site_bucket(buckets).alias("_bucket"), slice_.alias("_slice"), "*")
    return (placed.sortWithinPartitions(*order) if order else placed).repartition(*PLACE)


class ChangeLog:
    """Rows of sites: a base for each bucket, and what later batches added to it.

    `merge` makes the rows that count of a base and its changes, laid out by buckets. A batch
    writes its own rows only. Where the rows of a bucket that no longer count have grown to a
    share (FOLD) of those that do, they are merged into a new base: so what is written stays in
    proportion to what changes, and what is read to what counts. `waste` is a column of changes, 1 where
    a row takes the place of another; without it, and where a bucket has many parts (PARTS),
    all changes count as waste. Folders are numbered by batch, and the state before a
    batch stays until the next base, so a batch that runs again gives the same.
    """

    def __init__(
        self, spark: SparkSession, path: str, buckets: int, merge: Callable[[DataFrame], DataFrame], waste: str | None = None
    ):
        self.spark, self.path, self.buckets, self.merge, self.waste = spark, path, buckets, merge, waste

    def append(self, rows: DataFrame, batch_id: int) -> list[int]:
        """Write the rows of a batch in place of an earlier attempt; the buckets it has."""
        self._write(rows, "changes", batch_id)
        return sorted(b for b, numbers in self._versions("changes").items() if batch_id in numbers)

    def changes(self, batch_id: int, buckets: list[int], schema: T.StructType) -> DataFrame:
        return self._read([self._folder("changes", b, batch_id) for b in buckets], schema)

    def rows(self, before: int | None = None, buckets: list[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """Bases and changes of the buckets as the batches before the given one left them, not yet merged."""
        found = []
        bases, changes = self._versions("base", before), self._versions("changes", before)
        for b in sorted(bases.keys() | changes.keys()):
            if buckets is None or b in buckets:
                base = max(bases.get(b, []), default=-1)
                found += [self._folder("base", b, base)] * (base >= 0)
                found += [self._folder("changes", b, n) for n in sorted(changes.get(b, [])) if n > base]
        return self._read(found, schema)

    def fold(self, batch_id: int, buckets: list[int], schema: T.StructType) -> None:
        """Merge the buckets whose changes have become large beside their base; what no retry needs goes."""
        bases, changes = self._versions("base", batch_id), self._versions("changes", batch_id + 1)
        large = {}
        for b in buckets:
            base = max(bases.get(b, []), default=-1)
            parts = [self._folder("base", b, base)] * (base >= 0)
            parts += [self._folder("changes", b, n) for n in sorted(changes.get(b, [])) if n > base]
            first, *rest = (self._size(p) for p in parts)  # a bucket's first changes do for its base
            if rest and sum(rest) >= FOLD * first:
                large[b] = first, sum(rest), parts[1:]
        shares = self._wasted({b: rest for b, (_, _, rest) in large.items() if len(rest) < PARTS})
        due = [b for b, (first, size, _) in large.items() if (w := size * shares.get(b, 1)) >= FOLD * (first + size - w)]
        if not due:
            return
        self._write(self.merge(self.rows(batch_id + 1, due, schema)), "base", batch_id)
        for b in due:
            old = sorted(bases.get(b, []))
            for n in old[:-1]:
                self._delete(self._folder("base", b, n))
            for n in changes.get(b, []):
                if old and n <= old[-1]:
                    self._delete(self._folder("changes", b, n))

    def _wasted(self, parts: dict[int, list[str]]) -> dict[int, float]:
        """By bucket, the share of rows in the given changes that take the place of others."""
        if self.waste is None or not parts:
            return {}
        rows = self.spark.read.schema(f"site_url string, {self.waste} int").parquet(*sum(parts.values(), []))
        counts = rows.groupBy(site_bucket(self.buckets).alias("b")).agg(F.avg(F.coalesce(self.waste, F.lit(1))).alias("share"))
        return {r["b"]: r["share"] for r in counts.collect()}  # a row for each bucket

    def _write(self, rows: DataFrame, part: str, batch_id: int) -> None:
        laid = PLACE[0] in rows.columns
        numbered = rows.drop(*PLACE).withColumns({"bucket": site_bucket(self.buckets), "batch_id": F.lit(batch_id)})
        (
            (numbered if laid else numbered.hint("rebalance", "bucket"))
            .write.partitionBy("bucket", "batch_id")
            .mode("overwrite")
            .options(partitionOverwriteMode="dynamic", compression="zstd")
            .parquet(f"{self.path}/{part}")
        )

    def _read(self, folders: list[str], schema: T.StructType | None) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema or "site_url string")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*folders)

    def _folder(self, part: str, bucket: int, batch_id: int) -> str:
        return f"{self.path}/{part}/bucket={bucket}/batch_id={batch_id}"

    def _file_system(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _versions(self, part: str, before: int | None = None) -> dict[int, list[int]]:
        """Batches by bucket, from folder names: at most `buckets` times what lies between two bases."""
        fs, at = self._file_system(f"{self.path}/{part}")
        if not fs.exists(at):
            return {}
        out: dict[int, list[int]] = {}
        for bucket in fs.listStatus(at):
            name = bucket.getPath().getName()
            if name.startswith("bucket="):
                inner = [f.getPath().getName() for f in fs.listStatus(bucket.getPath())]
                numbers = [int(n[9:]) for n in inner if n.startswith("batch_id=")]
                out[int(name[7:])] = [n for n in numbers if before is None or n < before]
        return out

    def _size(self, path: str) -> int:
        fs, at = self._file_system(path)
        return fs.getContentSummary(at).getLength()

    def _delete(self, path: str) -> None:
        fs, at = self._file_system(path)
        fs.delete(at, True)
