"""A layer published month by month: versioned folders and a manifest that names the current one.

    root/data/v=<version>/year=<y>/month=<m>/*.parquet
    root/manifest/*.parquet      rows (version, folder, year, month, files, bytes, row_count, source)

A write goes to a folder of its own and counts only when its manifest rows are
there: one file, appended last, which is a single rename.  A run that is
killed before leaves the layer as it was.  For each month the row of the
highest version holds, so months can be written one at a time, each write
costs the months it has, and readers see whole months only.

``source`` says what a month was computed from, in the words of the caller; a
store of derived state (sketches, samples) compares it with
:func:`month_identities` of its source layer to find the months to recompute.

Months are few (calendar months), so manifests are handled on the driver.
Rows without a year or month are a "month" of their own.  Two writers at once
may publish different months; of the same month the higher folder name wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .layers import month_bounds, write_partitioned

Month = tuple[int | None, int | None]
MANIFEST_SCHEMA = "version int, folder string, year int, month int, files bigint, bytes bigint, row_count bigint, source string"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed name of the folder of null partition values


@dataclass(frozen=True)
class MonthEntry:
    """What the manifest says of a month; one that has no rows has no files either."""

    version: int
    folder: str
    files: int
    bytes: int
    row_count: int
    source: str | None


class StaleMonths(RuntimeError):
    """State does not cover the months of its source as they are now."""


def in_range(month: Month, months: tuple[str, str] | None) -> bool:
    if months is None:
        return True
    if None in month:
        return False
    low, high = month_bounds(*months)
    return low <= month[0] * 100 + month[1] <= high


class MonthStore:
    """The store under ``root`` (any Hadoop URI)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _manifest(self) -> str:
        return f"{self.root}/manifest"

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self._manifest)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def exists(self) -> bool:
        return self._log() is not None

    def entries(self) -> dict[Month, MonthEntry]:
        """The current entry of each month, months without rows included."""
        log = self._log()
        if log is None:
            return {}
        fields = ["version", "folder", "files", "bytes", "row_count", "source"]
        last = log.groupBy("year", "month").agg(F.max(F.struct(*fields)).alias("last")).collect()  # a row a month
        return {(r["year"], r["month"]): MonthEntry(*(r["last"][f] for f in fields)) for r in last}

    def history(self, months: Iterable[Month]) -> dict[Month, list[MonthEntry]]:
        """All entries of the given months, oldest first: a row a month and publication."""
        log = self._log()
        out: dict[Month, list[MonthEntry]] = {m: [] for m in months}
        if log is None or not out:
            return out
        fields = ["version", "folder", "files", "bytes", "row_count", "source"]
        for r in only_months(log, out).collect():
            out[(r["year"], r["month"])].append(MonthEntry(*(r[f] for f in fields)))
        return {m: sorted(entries, key=lambda e: (e.version, e.folder)) for m, entries in out.items()}

    def identities(self, months: tuple[str, str] | None = None) -> dict[Month, str]:
        """The folder of each month that has rows."""
        return {m: e.folder for m, e in self.entries().items() if e.row_count and in_range(m, months)}

    def write(
        self,
        df: DataFrame,
        months: Iterable[Month] | None = None,
        replace: bool = False,
        sources: Mapping[Month, str] | None = None,
    ) -> int:
        """Publish ``df`` (with year and month) and return the rows written.

        The months of ``df`` are replaced, as are those named in ``months``
        (a named month without rows is then empty); others stay, unless
        ``replace`` empties them.
        """
        entries = self.entries()
        version = max((e.version for e in entries.values()), default=0) + 1
        folder = f"{version:08d}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/data/v={folder}"
        write_partitioned(df, path)
        written = self._written(df.schema, path)
        named = set(months or ()) | (set(entries) if replace else set())
        rows = []
        for m in sorted(named | set(written), key=lambda m: tuple((v is not None, v or 0) for v in m)):
            files, size, count = written.get(m, (0, 0, 0))
            rows.append((version, folder, *m, files, size, count, (sources or {}).get(m)))
        self._append(rows)
        return sum(w[2] for w in written.values())

    def _written(self, schema: T.StructType, path: str) -> dict[Month, tuple[int, int, int]]:
        """{month: (files, bytes, rows)} of a folder; only file footers are read."""
        file = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
        files = self.spark.read.schema(schema).parquet(path).groupBy("year", "month", *file).agg(F.count(F.lit(1)).alias("n"))
        found = files.groupBy("year", "month").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("size"), F.sum("n").alias("n"))
        return {(r["year"], r["month"]): (r["files"], r["size"], r["n"]) for r in found.collect()}  # a row a month

    def _append(self, rows: Sequence[tuple]) -> None:
        self.spark.createDataFrame(list(rows), MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(self._manifest)

    def read(self, schema: T.StructType, months: tuple[str, str] | None = None) -> DataFrame:
        """The current rows, of a range of months if given; only their folders are listed."""
        name = lambda v: _NO_VALUE if v is None else v
        paths = [
            f"{self.root}/data/v={e.folder}/year={name(m[0])}/month={name(m[1])}"
            for m, e in self.entries().items()
            if e.row_count and in_range(m, months)
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("v", T.StringType())]))
        return reader.option("basePath", f"{self.root}/data").parquet(*sorted(paths)).select(*schema.names)

    def vacuum(self, min_age_hours: float = 24.0) -> list[str]:
        """Delete version folders that no current entry names and that are old enough; returns them.

        The age spares writes under way.  Readers that opened an older version
        lose it, so choose an age above that of the longest query.
        """
        jvm = self.spark._jvm
        data = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        fs = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(data):
            return []
        named = {f"v={e.folder}" for e in self.entries().values() if e.row_count}
        oldest = jvm.System.currentTimeMillis() - int(min_age_hours * 3_600_000)
        gone = [
            s.getPath().toString()
            for s in fs.listStatus(data)
            if s.getPath().getName() not in named and s.getModificationTime() <= oldest
        ]
        for path in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
        return gone


def month_identities(spark: SparkSession, path: str, months: tuple[str, str] | None = None) -> dict[Month, str]:
    """What each month of a layer consists of, as a text that changes with its files.

    A published layer answers from its manifest; of a plain ``year=/month=``
    folder the files' names, sizes and times are summed up, in Spark.
    """
    store = MonthStore(spark, path)
    if store.exists():
        return store.identities(months)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    year = F.regexp_extract("path", r"/year=(\d+)/", 1).try_cast("int").alias("year")
    month = F.regexp_extract("path", r"/month=(\d+)/", 1).try_cast("int").alias("month")
    files = listing.load(path).select(year, month, "length", F.xxhash64("path", "length", "modificationTime").alias("h"))
    found = files.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.bit_xor("h").alias("digest")
    )
    out = {(r["year"], r["month"]): f"{r['files']}-{r['bytes']}-{r['digest'] & (1 << 64) - 1:016x}" for r in found.collect()}
    return {m: text for m, text in out.items() if in_range(m, months)}


def stale_months(
    have: Mapping[Month, MonthEntry], source: Mapping[Month, str], months: tuple[str, str] | None = None
) -> list[Month]:
    """Months of ``source`` that ``have`` lacks or computed from something else, and months that only ``have`` has rows of."""
    changed = [m for m, text in source.items() if m not in have or have[m].source != text]
    gone = [m for m, e in have.items() if m not in source and e.row_count and in_range(m, months)]
    return sorted(set(changed) | set(gone), key=str)


def only_months(df: DataFrame, months: Iterable[Month]) -> DataFrame:
    """Rows of the given months; a predicate on the partition columns, null-safe."""
    wanted = F.lit(False)
    for y, m in months:
        wanted = wanted | (F.col("year").eqNullSafe(F.lit(y)) & F.col("month").eqNullSafe(F.lit(m)))
    return df.where(wanted)
