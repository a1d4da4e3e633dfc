"""Removal of repeated line runs by suffix sorting over line-ID sequences.

Lines get order-keeping ids, and prefix doubling sorts the suffixes of all documents
by their first 1, 2, 4 ... lines: at each level a suffix is named by the pair of the
names of its two halves, and the distinct pairs are sorted and numbered. Suffixes
whose prefix occurs once drop out, so each level keeps only what is still tied: the
suffixes of the level's longest-common-prefix intervals.

A run counts as repeated when its lines hold ``min_chars`` characters together. For
every line there is a shortest such run that begins with it and one that ends with
it; any longer repeated run is a union of these. A run of n lines is named by the two
names of the largest level that covers it from both ends, equal names make up the
interval, and its first member in (doc_id, row, line) order stays: later copies go.
Levels are sorted as deep as the longest of these shortest runs, which is all that
the decision needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally import session
from gridtally.llm.common import looked_up, numbered_copy, over_batches, set_aside

#: Characters that the lines of a repeated run hold together, at least.
MIN_CHARS = 30


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur more than once, with the keys' place in sorted order as ``name``."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    ordered = repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
    names = session.materialize(ordered.withColumn("_name", F.monotonically_increasing_id()), "names")
    return df.join(names, keys).drop(*keys).withColumnRenamed("_name", "name")


def _least_runs(tied: DataFrame, min_chars: int) -> DataFrame:
    """Shortest runs of neighbouring tied lines that hold ``min_chars``: row, start, n.

    The lines of one document are one group.
    """
    rows = tied.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("line", "chars"))).alias("lines"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, starts, sizes = [], [], []
        for r, lines in zip(batch.column("_row").to_pylist(), batch.column("lines")):
            line = lines.values.field("line").to_numpy(zero_copy_only=False)
            chars = lines.values.field("chars").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(line) != 1) + 1
            runs = set()
            for at, size in zip(np.split(line, cuts), np.split(chars, cuts)):
                total = np.concatenate(([0], np.cumsum(size)))
                last = np.searchsorted(total, total[:-1] + min_chars)  # lines in front of the run's end
                ok = last < len(total)
                runs.update((int(at[s]), int(e - s)) for s, e in zip(np.flatnonzero(ok), last[ok]))
                first = np.searchsorted(total, total[1:] - min_chars, "right") - 1
                ok = first >= 0
                runs.update((int(at[s]), int(e + 1 - s)) for e, s in zip(np.flatnonzero(ok), first[ok]))
            for start, n in runs:
                row.append(r)
                starts.append(start)
                sizes.append(n)
        return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32())], names=["_row", "start", "n"])

    return over_batches(rows, "_row long, start int, n int", work)


def later_copies(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Runs that occur earlier too: row, spans (start, n). ``docs`` has _row, doc_id, text."""
    lines = docs.select("_row", "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "_text"))
    hashed = lines.select("_row", "doc_id", "line", F.char_length("_text").alias("chars"), F.xxhash64("_text").alias("_h1"), F.xxhash64(F.lit(7), "_text").alias("_h2"))
    hashed = session.materialize(hashed, "lines")
    tied = session.materialize(_named(hashed, ["_h1", "_h2"]), "tied")
    runs = _least_runs(tied, min_chars).withColumn("level", F.floor(F.log2("n")).cast("int"))
    runs = session.materialize(runs, "runs")
    deepest = runs.agg(F.max("level")).first()[0]
    levels = [tied.select(F.lit(0).alias("level"), "_row", "line", "name")]
    for level in range(deepest or 0):
        step = 1 << level
        ahead = Window.partitionBy("_row").orderBy("line").rangeBetween(step, step)
        pairs = levels[-1].select("_row", "line", F.col("name").alias("_a"), F.max("name").over(ahead).alias("_b"))
        deeper = session.materialize(_named(pairs.where("_b is not null"), ["_a", "_b"]), "tied")
        levels.append(deeper.select(F.lit(level + 1).alias("level"), "_row", "line", "name"))
    named = levels[0]
    for more in levels[1:]:
        named = named.unionByName(more)
    # a run is covered by the names of its first and its last 2^level lines
    head = named.select("level", "_row", F.col("line").alias("start"), F.col("name").alias("_a"))
    tail = named.select("level", "_row", F.col("line").alias("_end"), F.col("name").alias("_b"))
    width = F.expr("shiftleft(1, level)")
    covered = runs.join(head, ["level", "_row", "start"]).withColumn("_end", F.col("start") + F.col("n") - width).join(tail, ["level", "_row", "_end"])
    ids = docs.select("_row", "doc_id")
    place = F.struct("doc_id", "_row", "start")
    members = session.materialize(covered.join(ids, "_row").select("n", "_a", "_b", "_row", "start", place.alias("_place")), "members")
    firsts = members.groupBy("n", "_a", "_b").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    # stored, so that the join is between two plain shuffles and a very common run can be split
    firsts = session.materialize(firsts, "firsts")
    later = members.join(firsts, ["n", "_a", "_b"]).where("_place != _first")
    spans = later.groupBy("_row").agg(F.collect_list(F.struct("start", "n")).alias("_spans"))
    return session.materialize(spans, "spans")


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents without later copies of repeated line runs.

    Reads ``doc_id`` and ``text``; all other columns are returned as they are, and
    ``text`` loses the removed lines. Adds n_lines, n_removed (lines) and runs (start
    and length of what was removed, as line numbers). Lines end with a newline and are
    compared as they are. A null text has no lines and stays null; an empty one has one
    empty line. Of equal rows one is the first and keeps its lines. A document may
    become empty. Columns named n_lines, n_removed or runs are replaced.
    """
    docs, back = set_aside(docs.drop("n_lines", "n_removed", "runs"), ("_row", "_spans"))
    columns = docs.columns
    copy = numbered_copy(docs, "documents")
    found = later_copies(copy.select("_row", "doc_id", "text"), min_chars)
    joined = looked_up(copy, found, "_row", "left")
    at = columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        made, lines, removed, runs = [], [], [], []
        for text, spans in zip(texts.to_pylist(), batch.column("_spans").to_pylist()):
            n = 0 if text is None else text.count("\n") + 1
            lines.append(n)
            if not spans:
                made.append(text)
                removed.append(0)
                runs.append([])
                continue
            gone = np.zeros(n + 1, np.int64)
            for span in spans:
                gone[span["start"]] += 1
                gone[span["start"] + span["n"]] -= 1
            gone = np.cumsum(gone) > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(np.int8)))
            made.append("\n".join(x for x, off in zip(text.split("\n"), gone) if not off))
            removed.append(int(gone.sum()))
            runs.append([{"start": int(s), "n": int(e - s)} for s, e in zip(edge[::2], edge[1::2])])
        kept = [batch.column(c) for c in columns]
        kept[at] = pa.array(made, texts.type)
        more = [pa.array(lines, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, kind)]
        return pa.RecordBatch.from_arrays(kept + more, names=[*columns, "n_lines", "n_removed", "runs"])

    more = StructType.fromDDL("n_lines long, n_removed long, runs array<struct<start: int, n: int>>")
    made = over_batches(joined.select(*columns, "_spans"), StructType(copy.select(*columns).schema.fields + more.fields), work)
    return made.withColumnsRenamed(back)
