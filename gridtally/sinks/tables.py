"""Tables whose readers always see one whole version.

A version is a list of live Parquet files, written by Spark, with a few statistics of
each. It comes into being by putting one small file that names the list; until then its
data, key index and list are folders nobody reads, and a writer that is cut off, or comes
second, leaves the version before it untouched.

The key index tells which files may hold a key: each file has the least and greatest
first key and a Bloom filter, kept as rows (path, word, bits) so that looking up a
batch's keys is a join on the word. A merge reads and replaces these files only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from gridtally import session
from gridtally.operators import dedup, integrity, upsert

#: Words of a file's Bloom filter. Four bits are set for each key, in one word of 64 bits;
#: a file of a million keys has some eight keys a word.
WORDS = 1 << 17
#: Keys of a batch, times files in its range, that are looked up one by one. A larger batch hits most
#: of these files anyway and takes them all, so the work of a lookup does not grow as keys times files.
LOOKED_UP = 1_000_000
#: How often an append is tried again when other writers commit in between.
TRIES = 10


class Conflict(RuntimeError):
    """Another writer committed first; the change must be made anew on its version."""


@dataclass(frozen=True)
class Table:
    """A versioned table below ``root``.

    schema  columns of the rows
    keys    columns that identify a row
    index   columns by which files are found, the keys unless stated
    cluster columns by which rows are dealt over files and sorted, the index unless stated
    """

    spark: SparkSession
    root: str
    schema: StructType
    keys: list[str]
    index: list[str] = field(default_factory=list)
    cluster: list[str] = field(default_factory=list)

    @property
    def found_by(self) -> list[str]:
        return self.index or self.keys

    # ---- versions

    def version(self) -> int:
        """Number of the newest version; 0 is the empty table."""
        return max((int(n) for n in session.names(self.spark, f"{self.root}/versions") if n.isdigit()), default=0)

    def record(self, version: int | None = None) -> dict:
        """What a version says of itself: operation, run, its list, and the streams' batches it holds."""
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "lists": [], "applied": {}}
        return json.loads(session.read_text(self.spark, f"{self.root}/versions/{version:012d}"))

    def history(self) -> DataFrame:
        """One row per version: version, operation, run_id, files, rows, added, removed (files)."""
        shape = "version bigint, operation string, run_id string, files bigint, rows bigint, added bigint, removed bigint"
        if not self.version():
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).json(f"{self.root}/versions")

    # ---- reading

    @property
    def _list_schema(self) -> StructType:
        first = self.schema[self.found_by[0]].dataType
        own = StructType().add("path", StringType()).add("commit", StringType()).add("run_id", StringType())
        return own.add("rows", LongType()).add("bytes", LongType()).add("low", first).add("high", first)

    def files(self, version: int | None = None) -> DataFrame:
        """The live files of a version: path (below the root), commit, run_id, rows, bytes, low and high (of the first index column)."""
        found = self.record(version)
        if not found.get("commit"):
            return self.spark.createDataFrame([], self._list_schema)
        return self.spark.read.schema(self._list_schema).parquet(f"{self.root}/lists/{found['commit']}")

    def read(self, version: int | None = None, files: DataFrame | None = None) -> DataFrame:
        """Rows of a version, or of some of its files. Spark's scan lists its files on the driver; so does this."""
        paths = [r["path"] for r in (self.files(version) if files is None else files).select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(c).cast(self.schema[c].dataType) for c in self.found_by])

    @staticmethod
    def _bits(h: Column) -> tuple[Column, Column]:
        """The word a key's hash falls into, and the bits it sets there."""
        one = F.lit(1).cast("long")
        bits = [F.call_function("shiftleft", one, F.shiftright(h, shift).bitwiseAND(F.lit(63)).cast("int")) for shift in (0, 6, 12, 18)]
        return F.pmod(F.shiftrightunsigned(h, 32), F.lit(WORDS)).cast("int"), reduce(lambda a, b: a.bitwiseOR(b), bits)

    def holding(self, source: DataFrame, version: int | None = None) -> DataFrame:
        """The files of a version that may hold rows with ``source``'s index columns: none that does is left out."""
        live = self.files(version)
        first = self.found_by[0]
        asked = source.filter(upsert.keyed(self.found_by)).select(*self.found_by).distinct()
        ranges = asked.agg(F.min(first).alias("low"), F.max(first).alias("high"), F.count(F.lit(1)).alias("n")).first()
        near = live.filter((F.col("low") <= F.lit(ranges["high"])) & (F.col("high") >= F.lit(ranges["low"])))
        per_commit = near.groupBy("commit").agg(F.count(F.lit(1)).alias("files")).collect()
        commits = [r["commit"] for r in per_commit]
        if not commits or ranges["n"] * sum(r["files"] for r in per_commit) > LOOKED_UP:
            return near
        word, bits = self._bits(self._hash())
        asked = asked.select(F.col(first).alias("_key"), word.alias("word"), bits.alias("_asked"))
        index = self.spark.read.parquet(*[f"{self.root}/keys/{c}" for c in commits])
        hit = (F.col("bits").bitwiseAND(F.col("_asked")) == F.col("_asked")) & F.col("_key").between(F.col("low"), F.col("high"))
        met = index.join(near.select("path", "low", "high"), "path").join(asked, "word").filter(hit).select("path").distinct()
        return near.join(met, "path", "left_semi")

    # ---- writing

    def commit(
        self, rows: DataFrame | None, base: int, operation: str, run_id: str = "", removed: DataFrame | None = None, applied: dict | None = None
    ) -> int:
        """Write ``rows`` as new files and make the version after ``base``: its files but ``removed``, and the new ones.

        ``applied`` are numbers of stream batches that the version holds, by stream.
        """
        commit, record = uuid.uuid4().hex, self.record(base)
        live = self.files(base)
        kept = live if removed is None else live.join(removed.select("path"), "path", "left_anti")
        added = self._write(rows, commit, run_id) if rows is not None else live.limit(0)
        kept.unionByName(added).write.parquet(f"{self.root}/lists/{commit}")
        listed = self.spark.read.schema(self._list_schema).parquet(f"{self.root}/lists/{commit}")
        n = listed.agg(
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count_if(F.col("commit") == commit).alias("added")
        ).first()
        made = {
            "version": base + 1, "operation": operation, "run_id": run_id, "commit": commit, **n.asDict(),
            "removed": record.get("files", 0) - (n["files"] - n["added"]), "applied": {**record["applied"], **(applied or {})},
        }
        if not session.put_if_absent(self.spark, f"{self.root}/versions/{base + 1:012d}", json.dumps(made)):
            raise Conflict(f"version {base + 1} of {self.root} was made by another writer")
        return base + 1

    def _write(self, rows: DataFrame, commit: str, run_id: str) -> DataFrame:
        """Store rows as files of disjoint ranges, with their key index; returns their list rows."""
        path = f"{self.root}/data/{commit}"
        stored = session.materialize(rows.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.schema.names]), "rows")
        cluster = self.cluster or self.found_by
        stored.repartitionByRange(*cluster).sortWithinPartitions(*cluster).write.parquet(path)
        name = F.concat(F.lit(f"data/{commit}/"), F.col("_metadata.file_name"))
        written = self.spark.read.schema(self.schema).parquet(path)
        first = F.col(self.found_by[0])
        word, bits = self._bits(self._hash())
        keyed = written.filter(upsert.keyed(self.found_by)).select(name.alias("path"), word.alias("word"), bits.alias("bits"))
        keyed.groupBy("path", "word").agg(F.bit_or("bits").alias("bits")).repartition("path").sortWithinPartitions("path", "word").write.parquet(
            f"{self.root}/keys/{commit}"
        )
        sizes = written.select(name.alias("path"), F.col("_metadata.file_size").alias("bytes"), first.alias("first"))
        return sizes.groupBy("path").agg(
            F.lit(commit).alias("commit"), F.lit(run_id).alias("run_id"), F.count(F.lit(1)).alias("rows"), F.first("bytes").alias("bytes"),
            F.min("first").alias("low"), F.max("first").alias("high"),
        )

    def _again(self, change: Callable[[int], int]) -> int:
        """Make a change that fits on any version, again if another writer was first."""
        for _ in range(TRIES - 1):
            try:
                return change(self.version())
            except Conflict:
                pass
        return change(self.version())

    def append(self, rows: DataFrame, run_id: str) -> int:
        """Add a run's rows; what an earlier attempt of the run added goes."""
        rows = session.materialize(rows, "appended")
        return self._again(lambda base: self.commit(rows, base, "append", run_id, self.files(base).filter(F.col("run_id") == run_id)))

    def merge(self, source: DataFrame, how: upsert.Merge, run_id: str = "", applied: dict | None = None) -> int:
        """Merge ``source`` (one row per key) into the files that may hold its keys, and replace these."""
        base = self.version()
        touched = session.materialize(self.holding(source, base), "touched")
        merged = upsert.merge(self.read(files=touched), source, how)
        return self.commit(merged, base, "merge", run_id, touched, applied)

    def insert_new(self, source: DataFrame, *order: str, run_id: str = "") -> int:
        """Add the source rows with unseen keys, one of each; no file is replaced."""
        base = self.version()
        fresh = dedup.first_per_key(source.filter(upsert.keyed(self.keys)), self.keys, *order)
        known = self.read(files=self.holding(fresh, base)).select(*self.keys)
        return self.commit(integrity.without_match(fresh, known, self.keys), base, "insert", run_id)

    def replace(self, stale: DataFrame, rows: DataFrame, run_id: str = "", applied: dict | None = None) -> int:
        """Put ``rows`` in place of all rows whose index columns ``stale`` names."""
        base = self.version()
        touched = session.materialize(self.holding(stale, base), "touched")
        others = integrity.without_match(self.read(files=touched), stale.select(*self.found_by), self.found_by)
        return self.commit(others.unionByName(rows.select(*self.schema.names)), base, "replace", run_id, touched, applied)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders of commits that none of the newest ``keep`` versions reads, half-made ones too; returns their names.

        No other writer may be at work meanwhile.
        """
        newest = self.version()
        kept = [self.record(v) for v in range(max(1, newest - keep + 1), newest + 1)]
        needed = {r["commit"] for r in kept}
        for r in kept:
            needed |= {row["commit"] for row in self.files(r["version"]).select("commit").distinct().collect()}
        unused = set()
        for part in ("data", "keys", "lists"):
            unused |= {n for n in session.names(self.spark, f"{self.root}/{part}") if n not in needed}
        for name in unused:
            session.remove(self.spark, f"{self.root}/*/{name}")
        for v in range(1, newest - keep + 1):
            session.remove(self.spark, f"{self.root}/versions/{v:012d}")
        return sorted(unused)
