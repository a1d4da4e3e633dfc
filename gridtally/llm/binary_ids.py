"""Token ids in binary files, coded in 64-bit words (Simple-8b).

A file is a row of blocks, a block a row of little-endian 64-bit words:

    head      magic, words of the block, documents, ids, data words, escapes,
              shard, ids of the shard before this block
    documents doc_id, 1 if the doc_id is null, number of ids          (each document)
    offsets   data words before each segment of 128 ids, and their total
    data      words: a selector in the upper 4 bits, ids in the lower 60
    escapes   values of 2^60 and more, in full
    end       the 8 bytes that end a block

A selector says how many ids a word holds (60, 30, 20 ... 1) with 60 div that many
bits each, lowest first; selector 15 stands for one id, and the word holds its place
among the escapes. Segments begin at a new word and never span documents, so they
are coded and decoded side by side in numpy.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import session
from gridtally.llm.common import over_batches, slices
from gridtally.llm.tokens import as_ids, default_path, encoder

MAGIC = int.from_bytes(b"WORDIDS1", "little")
END = "\nENDBLK\n"
SEGMENT = 128
HEAD = 8
#: Ids a word holds, by selector; the bits of an id are 60 div that many.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = 60 // COUNTS
ESCAPE = 15
#: Bytes of text in a block, about, and blocks in a file.
BLOCK_BYTES = 1 << 20
FILE_BLOCKS = 16


def pack_words(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code runs of values of the given lengths; returns data words, segment offsets, escapes."""
    values = values.astype(np.uint64)
    # segments: first value and the value after the last
    per_run = -(-lengths // SEGMENT)
    run = np.repeat(np.arange(len(lengths)), per_run)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(per_run) - per_run, per_run)
    begin = (np.cumsum(lengths) - lengths)[run] + nth * SEGMENT
    end = np.minimum(begin + SEGMENT, np.cumsum(lengths)[run])
    large = values >> np.uint64(60) != 0
    escapes = values[large]
    # bits that each value needs, and the most needed by the next few of them
    need = np.zeros(len(values) + int(COUNTS[0]), np.int8)
    need[: len(values)] = np.frexp(np.where(large, 0, values).astype(np.float64))[1]
    need[: len(values)][large] = 61
    exact = ~large & (values >= np.uint64(1 << 53))  # rounding may have added a bit
    if exact.any():
        need[: len(values)][exact] = [int(v).bit_length() for v in values[exact]]
    # selector for each place: the first that can hold the next values
    selector = np.full(len(values), ESCAPE, np.int8)
    most = need[: len(values)].copy()
    reach = {1: most.copy()}
    for n in range(2, int(COUNTS[0]) + 1):
        np.maximum(most, need[n - 1 : n - 1 + len(values)], out=most)
        if n in COUNTS:
            reach[n] = most.copy()
    for s in reversed(range(len(COUNTS))):
        selector[reach[int(COUNTS[s])] <= BITS[s]] = s
    at, live = begin.copy(), np.arange(len(begin))
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    turn = 0
    while len(live):
        here = at[live]
        left = end[live] - here
        pick = selector[here].astype(np.int64)
        # near the end of a segment fewer values are left than the selector holds
        over = (pick != ESCAPE) & (COUNTS[np.minimum(pick, len(COUNTS) - 1)] > left)
        while over.any():
            pick[over] += 1
            over = (pick != ESCAPE) & (COUNTS[np.minimum(pick, len(COUNTS) - 1)] > left)
        made.append((live, here, pick))
        at[live] = here + np.where(pick == ESCAPE, 1, COUNTS[np.minimum(pick, len(COUNTS) - 1)])
        live = live[at[live] < end[live]]
        turn += 1
    if not made:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64), escapes
    segment = np.concatenate([m[0] for m in made])
    order = np.argsort(segment, kind="stable")  # turns stay in order within a segment
    start = np.concatenate([m[1] for m in made])[order]
    pick = np.concatenate([m[2] for m in made])[order]
    words = pick.astype(np.uint64) << np.uint64(60)
    for s, (n, bits) in enumerate(zip(COUNTS, BITS)):
        of = np.flatnonzero(pick == s)
        if len(of):
            shifts = (np.arange(n) * bits).astype(np.uint64)
            words[of] |= np.bitwise_or.reduce(values[start[of][:, None] + np.arange(n)] << shifts, axis=1)
    of = np.flatnonzero(pick == ESCAPE)
    words[of] |= (np.cumsum(large) - 1)[start[of]].astype(np.uint64)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(segment, minlength=len(begin)))))
    return words, offsets.astype(np.uint64), escapes


def unpack_words(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """All values of data words, in order."""
    pick = (words >> np.uint64(60)).astype(np.int64)
    n = np.where(pick == ESCAPE, 1, COUNTS[np.minimum(pick, len(COUNTS) - 1)])
    first = np.cumsum(n) - n
    values = np.zeros(int(n.sum()), np.uint64)
    for s, (count, bits) in enumerate(zip(COUNTS, BITS)):
        of = np.flatnonzero(pick == s)
        if len(of):
            shifts = (np.arange(count) * bits).astype(np.uint64)
            values[first[of][:, None] + np.arange(count)] = (words[of][:, None] >> shifts) & np.uint64((1 << int(bits)) - 1)
    of = np.flatnonzero(pick == ESCAPE)
    values[first[of]] = escapes[(words[of] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return values


def block(doc_ids: list[int | None], encoded: list[bytes], shard: int, before: int) -> bytes:
    """One block of documents."""
    lengths = np.array([len(e) // 4 for e in encoded], np.int64)
    data, offsets, escapes = pack_words(as_ids(b"".join(encoded)), lengths)
    ids = np.array([d or 0 for d in doc_ids], np.int64).view(np.uint64)
    index = np.stack([ids, np.array([d is None for d in doc_ids], np.uint64), lengths.astype(np.uint64)], axis=1).ravel()
    size = HEAD + len(index) + len(offsets) + len(data) + len(escapes)
    head = np.array([MAGIC, size, len(doc_ids), lengths.sum(), len(data), len(escapes), shard, before], np.uint64)
    return np.concatenate([head, index, offsets, data, escapes]).astype("<u8").tobytes()


def read_blocks(content: bytes):
    """Blocks of a file: (shard, ids before, doc_ids, lengths, all ids)."""
    at = 0
    while at < len(content):
        head = np.frombuffer(content, "<u8", HEAD, at)
        if int(head[0]) != MAGIC:
            raise ValueError("not a file of coded ids")
        _, size, docs, _, n_data, n_escapes, shard, before = (int(x) for x in head)
        words = np.frombuffer(content, "<u8", size, at)
        index = words[HEAD : HEAD + 3 * docs].reshape(-1, 3)
        data = words[size - n_escapes - n_data : size - n_escapes]
        doc_ids = [None if null else int(i) for i, null in zip(index[:, 0].view(np.int64), index[:, 1])]
        yield shard, before, doc_ids, index[:, 2].astype(np.int64), unpack_words(data, words[size - n_escapes :])
        at += 8 * size + len(END)


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1) -> None:
    """Encode whole texts and write them in ascending doc_id order to files in ``folder``.

    Reads ``doc_id`` (null first; equal ones in the order of their text's hash) and
    ``text`` (null: empty); other columns are ignored. Files are written by Spark's
    own writer, so any store that Spark reaches will do, and a lost task is repeated.
    """
    tokenizer = path or default_path()
    ordered = docs.select("doc_id", F.col("text").alias("_text"), F.xxhash64("text").alias("_tie"))
    ordered = ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def run(batches):
        shard, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for low, high in slices([len(t) for t in texts], BLOCK_BYTES):
                encoded = encoder(tokenizer, end_id).encode(texts[low:high])
                made = block(ids[low:high], encoded, shard, before)
                before += sum(map(len, encoded)) // 4
                yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["block"])

    blocks = ordered.select("doc_id", "_text").mapInArrow(run, "block binary")
    # a line of text is a string's bytes as they are, and the line end closes the block
    lines = blocks.select(F.col("block").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("maxRecordsPerFile", FILE_BLOCKS).option("compression", "none").text(folder)


def read(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """Documents of the files in ``folder``: doc_id, shard, start in the shard, n_tokens, ids_crc32 (and ids)."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * keep_ids
    names = ["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids

    def work(batch: pa.RecordBatch):
        for content in batch.column("content"):
            for shard, before, doc_ids, lengths, ids in read_blocks(content.as_buffer().to_pybytes()):
                first = np.cumsum(lengths) - lengths
                flat = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(flat[4 * s : 4 * (s + n)]) for s, n in zip(first.tolist(), lengths.tolist())]
                columns = [doc_ids, np.full(len(lengths), shard), before + first, lengths, crc]
                if keep_ids:
                    columns.append(np.split(ids.astype(np.int64), first[1:]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").load(folder).select("content")
    schema = "doc_id long, shard long, shard_start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return over_batches(files, schema, work)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files, its place among all ids: doc_id, start, n_tokens, ids_crc32.

    The driver adds up one total per shard, of which there are as many as tasks wrote.
    """
    found = session.materialize(read(spark, folder), "coded")
    bases, total = [], 0
    for shard, n in sorted(tuple(r) for r in found.groupBy("shard").agg(F.sum("n_tokens")).collect()):
        bases.append((shard, total))
        total += n
    base = spark.createDataFrame(bases, "shard long, _base long")
    return found.join(F.broadcast(base), "shard").select("doc_id", (F.col("_base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")
