"""Best-fit packing of documents into sequences, planned on the length histogram.

Every document becomes pieces of at most ``capacity`` ids; only longer ones are cut.
The plan is best-fit decreasing, made over counts: bins that are filled alike stay
together as ranges of bin numbers, so planning depends on the number of different
lengths and not on the number of documents. Pieces are ranked within their length
and take the slot that the plan holds for (length, rank).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally import session
from gridtally.llm.common import over_batches, shuffle_partitions, slices
from gridtally.llm.tokens import default_path, encoder

#: Bits for the rank in a lookup key; a length may have 2^44 pieces.
_RANK_BITS = 44
#: Rows that share a length and a salt, at least.
_LEAST_ROWS = 64


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over counts.

    A row (length, first rank, pieces a bin, first bin, offset) says that pieces of
    the length from that rank on go, so many a bin, to bins from the first one on.
    """
    bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by the room left
    holds = bytearray(capacity + 1)

    def keep(room: int, low: int, high: int) -> None:
        if high > low:
            bins[room].append((low, high))
            holds[room] = 1

    rows, used = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = holds.find(1, length)
            if room < 0:
                room, low, high = capacity, used, used - (-left // (capacity // length))
                used = high
            else:
                low, high = bins[room].pop()
                holds[room] = bool(bins[room])
            fit = room // length
            take = min(left, fit * (high - low))
            full, rest = divmod(take, fit)
            rows.append((length, rank, fit, low, capacity - room))
            keep(room - fit * length, low, low + full)
            if rest:
                keep(room - rest * length, low + full, low + full + 1)
            keep(room, low + full + bool(rest), high)
            rank, left = rank + take, left - take
    return np.array(rows, np.int64).reshape(-1, 5)


def place(planned: np.ndarray, keys: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces; ``keys`` are the plan's sorted (length, first rank)."""
    at = np.searchsorted(keys, (length << _RANK_BITS) + rank, "right") - 1
    _, first, fit, low, offset = planned[at].T
    into = rank - first
    return low + into // fit, offset + into % fit * length


def cut(docs: DataFrame, path: str, end_id: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """Pieces of the encoded documents: doc_id, piece, start, length, ids_crc32 (and ids)."""
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def work(batch: pa.RecordBatch):
        texts = [t or "" for t in batch.column("_text").to_pylist()]
        for low, high in slices([len(t) for t in texts]):
            of, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, data in zip(range(low, high), encoder(path, end_id).encode(texts[low:high])):
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    of.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            made = [pa.array(v, k) for v, k in zip((piece, start, length, crc, ids), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of, pa.int64())), *made], names=names)

    chosen = docs.select("doc_id", F.col("text").alias("_text"))
    more = StructType.fromDDL("piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)
    return over_batches(chosen, StructType(chosen.schema.fields[:1] + more.fields), work)


def pack(docs: DataFrame, path: str | None = None, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Place of every piece of every document in sequences of at most ``capacity`` ids.

    Reads ``doc_id`` and ``text``; other columns are ignored. A null or empty text is
    the end id alone. Rows that are equal in everything are packed one by one, as are
    rows with a null or repeated doc_id. No rows, no result.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. The driver
    sees the histogram (at most ``capacity`` rows), the sizes of the salted groups
    (a few for each shuffle partition) and the plan, which depends on the histogram.
    """
    spark = docs.sparkSession
    pieces = session.materialize(cut(docs, path or default_path(), end_id, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    total = sum(histogram.values())
    if not total:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    # A length may belong to any share of the rows; salts keep the groups to be ranked small.
    most = max(_LEAST_ROWS, total // (4 * shuffle_partitions(spark)))
    salts = spark.createDataFrame([(n, -(-c // most)) for n, c in histogram.items()], "length long, _salts long")
    identity = ["doc_id", "piece", "start", "ids_crc32"]
    salted = pieces.join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64(*identity), "_salts")).drop("_salts")
    base, seen = {}, dict.fromkeys(histogram, 0)
    for r in salted.groupBy("length", "_salt").count().collect():
        base[r["length"], r["_salt"]] = seen[r["length"]]
        seen[r["length"]] += r["count"]
    planned = plan(histogram, capacity)
    planned = planned[np.lexsort((planned[:, 1], planned[:, 0]))]
    keys = (planned[:, 0] << _RANK_BITS) + planned[:, 1]
    groups = np.array(sorted((n << _RANK_BITS | s, b) for (n, s), b in base.items()), np.int64)
    shared = spark.sparkContext.broadcast((planned, keys, groups))

    columns = pieces.columns
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*identity)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        planned, keys, groups = shared.value
        length, salt, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_salt", "_rank"))
        first = groups[np.searchsorted(groups[:, 0], length << _RANK_BITS | salt), 1]
        sequence, offset = place(planned, keys, length, first + rank - 1)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in columns] + [pa.array(sequence), pa.array(offset)],
            names=[*columns, "sequence_id", "offset"],
        )

    schema = StructType(pieces.schema.fields + StructType.fromDDL("sequence_id long, offset long").fields)
    return over_batches(ranked.select(*columns, "_salt", "_rank"), schema, work)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """The sequences themselves: sequence_id, ids, doc_ids. Needs unique doc_ids.

    A sequence holds ``capacity`` ids at most, so its group is bounded.
    """
    ids = cut(docs, path or default_path(), end_id, capacity, keep_ids=True).select("doc_id", "piece", "ids")
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        packed.select("doc_id", "piece", "sequence_id", "offset")
        .join(ids, ["doc_id", "piece"])
        .groupBy("sequence_id")
        .agg(parts.alias("_parts"))
        .select("sequence_id", F.flatten("_parts.ids").alias("ids"), F.col("_parts.doc_id").alias("doc_ids"))
    )
