"""Near-duplicates by SimHash fingerprints, found by covering locality-sensitive hashing.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it.
Fingerprints link when they differ in at most ``radius`` bits, and classes are the
components of the links.

The search is exact. Give each bit position a vector of radius + 1 bits; for each vector
v but zero there is a table whose key are the fingerprint's bits at the positions whose
vector has an odd product with v. The vectors of at most ``radius`` positions leave some
v that is orthogonal to them all, so a pair that differs only there has equal keys in
that table. A bucket with too many fingerprints to compare is split by the same
construction over the bits that its key leaves free, which loses no pair either; after a
few turns hardly any bit is free, and distinct fingerprints that agree in all others are few.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally import session
from gridtally.llm.common import over_batches, slices, text_bytes
from gridtally.llm.components import components

BITS, RADIUS = 64, 2
#: Words of a shingle, and the seed of its hash.
SHINGLE, SEED = 3, 42
#: Distinct fingerprints up to which a bucket's are compared with each other, and rows that one Python group holds.
BUCKET, GROUP_ROWS = 1024, 200_000
#: Bytes of a text that are split into words at once.
PIECE = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in parts of some ``PIECE`` bytes, cut between words."""
    at = 0
    while len(data) - at > PIECE:
        gap = _SPACE.search(data, at + PIECE)
        if gap is None:
            break
        yield data[at : gap.start()]
        at = gap.end()
    yield data[at:]


def shingle_hashes(data: bytes, size: int = SHINGLE) -> Iterator[list[int]]:
    """Hashes of all runs of ``size`` words of a text, in parts; a shorter text is one run, an empty one none."""
    digest, held = xxhash.xxh64_intdigest, []
    done = False
    for piece in _pieces(data.lower()):  # bytes: A-Z only
        words = held + piece.split()  # at the spaces of ASCII
        if len(words) >= size:
            flat = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            yield [digest(flat[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())]
            done = True
        held = words[1 - size :] if size > 1 else []
    if held and not done:
        yield [digest(b" ".join(held), SEED)]


def _ones(hashes: np.ndarray, owner_starts: np.ndarray) -> np.ndarray:
    """How many of each owner's hashes have each bit set, highest bit first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduceat(bits, owner_starts, axis=0, dtype=np.int64)


def fingerprint_of(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Fingerprints of some texts; texts without words have zero."""
    ones, total = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    waiting: list[tuple[int, list[int]]] = []

    def add() -> None:
        counts = [len(h) for _, h in waiting]
        flat = np.fromiter((x for _, h in waiting for x in h), np.uint64, sum(counts))
        rows = np.array([row for row, _ in waiting])
        np.add.at(ones, rows, _ones(flat, np.cumsum([0, *counts[:-1]])))
        np.add.at(total, rows, counts)
        waiting.clear()

    held = 0
    for row, data in enumerate(texts):
        for hashes in shingle_hashes(data, size):
            waiting.append((row, hashes))
            held += len(hashes)
            if held > 1 << 18:
                add()
                held = 0
    if waiting:
        add()
    return np.packbits(2 * ones > total[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (a long with the 64 bits) of every row; a null text has no words."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data = text_bytes(batch.column("text"))
        for low, high in slices([len(d) for d in data]):
            made = pa.array(fingerprint_of(data[low:high], size).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), made], names=["doc_id", "fingerprint"])

    chosen = docs.select("doc_id", "text")
    return over_batches(chosen, StructType([chosen.schema["doc_id"]]).add("fingerprint", "long"), work)


def covering_masks(used: int = 0, radius: int = RADIUS) -> list[int]:
    """Masks that contain ``used`` such that any ``radius`` further bits are outside of at least one of them."""
    free = [bit for bit in range(BITS) if not used >> bit & 1]
    kinds = (1 << radius + 1) - 1
    vectors = {bit: 1 + place % kinds for place, bit in enumerate(free)}
    return [used | sum(1 << bit for bit, x in vectors.items() if (x & v).bit_count() % 2) for v in range(1, kinds + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def _tables(rows: DataFrame, radius: int) -> DataFrame:
    """Rows (fingerprint, used) with each finer mask for their ``used`` and the key under it.

    The masks in use are few: seven of the first turn for radius 2, seven times as many of each next one.
    """
    spark = rows.sparkSession
    masks = [r[0] for r in rows.select("used").distinct().collect()]
    finer = [(m, [_signed(x) for x in covering_masks(m % (1 << BITS), radius)]) for m in masks]
    if len(finer) == 1:
        rows = rows.withColumn("masks", F.array(*[F.lit(x).cast("long") for x in finer[0][1]]))
    else:
        rows = rows.join(F.broadcast(spark.createDataFrame(finer, "used long, masks array<long>")), "used")
    dealt = rows.select("fingerprint", F.explode("masks").alias("used"))
    return dealt.withColumn("key", F.col("fingerprint").bitwiseAND(F.col("used")))


def _compared(rows: DataFrame, n_rows: int, radius: int) -> DataFrame:
    """Links (a, b) that join the linked fingerprints of each bucket; no bucket is large here.

    Only one link per fingerprint, to the least one it is connected with, leaves a group.
    """
    groups = -(-n_rows // GROUP_ROWS)

    def compare(table: pa.Table) -> pa.Table:
        column = lambda c: np.asarray(table.column(c)).astype(np.int64).view(np.uint64)
        used, key, prints = column("used"), column("key"), column("fingerprint")
        order = np.lexsort((prints, key, used))
        used, key, prints = used[order], key[order], prints[order]
        new = np.concatenate(([True], (used[1:] != used[:-1]) | (key[1:] != key[:-1])))
        starts = np.flatnonzero(new)
        left = np.repeat(np.concatenate((starts[1:], [len(new)])), np.diff(np.concatenate((starts, [len(new)])))) - np.arange(len(new))
        names, place = np.unique(prints, return_inverse=True)
        root = np.arange(len(names))
        at = np.arange(len(prints))
        step = 1
        while True:
            at = at[left[at] > step]
            if not len(at):
                break
            near = np.bitwise_count(prints[at] ^ prints[at + step]) <= radius
            root = _united(root, place[at[near]], place[at[near] + step])
            step += 1
        a = np.flatnonzero(root != np.arange(len(names)))
        columns = [pa.array(names[a].view(np.int64)), pa.array(names[root[a]].view(np.int64))]
        return pa.Table.from_arrays(columns, names=["a", "b"])

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("used", "key"), F.lit(max(1, groups))))
    return dealt.groupBy("group").applyInArrow(compare, "a long, b long")


def _united(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots (least members) after joining the sets of each x and y."""
    while len(x):
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            higher = root[root]
            if np.array_equal(higher, root):
                break
            root = higher
    return root


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) with the same components as all pairs of ``fingerprint`` values within ``radius`` bits."""
    rows = prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct().withColumn("used", F.lit(0).cast("long"))
    made = None
    while True:
        tables = session.materialize(_tables(rows, radius), "tables")
        sizes = tables.groupBy("used", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # stored, so that the join is between two plain shuffles and a large bucket can be split
        met = session.materialize(tables.join(session.materialize(sizes, "sizes"), ["used", "key"]), "buckets")
        small = met.where(F.col("n") <= BUCKET)
        found = session.materialize(_compared(small.drop("n"), small.count(), radius), "links")
        made = found if made is None else made.union(found)
        rows = met.where(F.col("n") > BUCKET).select("fingerprint", "used").distinct()
        if rows.isEmpty():
            return made


def groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, any other columns): doc_id, fingerprint, component_id.

    ``fingerprint`` is a long that holds the 64 bits, ``component_id`` the smallest doc_id
    that can be reached over links, itself included; a null doc_id is never the smallest
    unless there is no other. Null and empty texts have the fingerprint zero, which is
    linked like any other. Repeated rows and ids do no harm, no rows give none.
    """
    prints = session.materialize(fingerprints(docs, size), "fingerprints")
    first = session.materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(first, radius)).withColumnsRenamed({"node": "fingerprint"})
    rooted = first.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = session.materialize(rooted, "rooted")
    # stored, so that the joins are between plain shuffles and a large component can be split
    names = session.materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "names")
    named = session.materialize(rooted.join(names, "root").select("fingerprint", "component_id"), "named")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
