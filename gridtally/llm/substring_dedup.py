"""Removal of repeated word runs by fixed-block anchors.

Each text is cut into non-overlapping blocks of BLOCK words, and every run of BLOCK
words anywhere (the rolling windows) is probed against the blocks. A window of
``width`` words contains a whole block, wherever it begins, so two equal windows give
a hit at both of their places: only windows that contain a hit can be repeated. The
hits are then extended: all windows of ``width`` words around them are hashed to 96
bits and counted, and runs of repeated windows are the maximal repeats.

Hashes are dealt out by value. A task sends, per chunk of some million windows and
bucket of hash values, one row of packed arrays (place in the chunk, hash), and the
answer comes back the same way, so no row is made per word or text, and equal hashes
never meet as pairs: a bucket only says whether a hash has another place. The texts
of a chunk may be any; a table of them goes with one of its rows. What is found goes
to the texts packed for some neighbours at a time. Where most windows are near a hit,
the extended ones are dealt out in turns, some buckets in each, so that the disk holds
those of one turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally import session
from gridtally.llm.common import looked_up, numbered_copy, over_batches, run_hashes, shuffle_partitions, slices, spans_of

WIDTH = 35
#: Rows whose spans travel together: a group of neighbours in the stored copy.
GROUP_BITS = 6
#: Windows that travel together, about; each so many make a packed row a bucket.
CHUNK_WINDOWS = 1 << 21
#: Bytes of text whose windows one bucket holds, about.
BUCKET_BYTES = 16 << 20
#: Buckets up to which tasks get two each; beyond, only bytes ask for more.
SPARE_BUCKETS = 2048
#: Bytes that an extended window takes on its way, about.
WINDOW_BYTES = 14
#: Bytes of extended windows that travel in one turn, for each byte of text.
TURN_BYTES = 1.25
_BASE, _SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _blank(flat: np.ndarray) -> np.ndarray:
    return (flat == 0x20) | ((flat >= 0x09) & (flat <= 0x0D))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of some texts in a row: the bytes, begins, ends, and where each text's words end."""
    flat = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin, end = spans_of(~_blank(flat))
    ends = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
    return flat, begin, end, ends


def _places(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts: the text, and the place of the window's first word in it."""
    n = np.maximum(0, sizes - width + 1)
    owner = np.repeat(np.arange(len(sizes)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def _gaps(values: np.ndarray) -> np.ndarray:
    """Ascending numbers as their differences, in as few bytes as the largest needs."""
    gaps = np.diff(values, prepend=0)
    top = int(gaps.max()) if len(gaps) else 0
    return gaps.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _packed(places: np.ndarray) -> bytes:
    """Places, ascending, as bytes: the size of a gap, and the gaps."""
    gaps = _gaps(places)
    return bytes([gaps.itemsize]) + gaps.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, f"<u{data[0]}", -1, 1).astype(np.int64)) if len(data) > 1 else np.zeros(0, np.int64)


_ROW = "bucket int, _chunk long, places binary, hashes binary, segments binary"
_FOUND = "_chunk long, places binary, segments binary"
#: Windows of a text that follow each other in a chunk: their text, its word they begin at, how many they are.
_SEGMENT = np.dtype([("row", "<i8"), ("word", "<i4"), ("windows", "<i4")])


def _columns(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> list[pa.Array]:
    columns = zip(*rows) if rows else [()] * len(names)
    return [pa.array(c, k) for c, k in zip(columns, kinds)]


def _chunk(parts: list[tuple], buckets: int, turn: int, turns: int) -> Iterator[pa.RecordBatch]:
    """The windows of some parts (segments, bucketing hashes, hashes to send), a packed row per bucket of a turn.

    A window's place is its number in the chunk. The first row has the segments.
    """
    segments = np.concatenate([p[0] for p in parts])
    bucket = np.concatenate([(p[1] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32) for p in parts])
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    own = np.flatnonzero(bucket % turns == turn) if turns > 1 else np.arange(len(bucket))
    order = own[np.argsort(bucket[own], kind="stable")]
    hashes = [np.concatenate(x)[order] for x in zip(*(p[2] for p in parts))]
    bucket = bucket[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    name, rows, size = int(segments["row"][0]), [], 0
    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        sent = b"".join(h[low:high].tobytes() for h in hashes)
        rows.append((int(bucket[low]), name, _packed(order[low:high]), sent, None if low else segments.tobytes()))
        size += len(sent)
        if size >= 4 << 20 or high == len(bucket):
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            names = ("bucket", "_chunk", "places", "hashes", "segments")
            yield pa.RecordBatch.from_arrays(_columns(rows, names, kinds), names=list(names))
            rows, size = [], 0


def _dealt(df: DataFrame, hashed, buckets: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """The windows that ``hashed`` makes of Arrow batches, dealt out by bucket: those of a turn."""
    limit = CHUNK_WINDOWS

    def run(batches):
        parts, windows = [], 0
        for batch in batches:
            for part in hashed(batch):
                parts.append(part)
                windows += len(part[1])
                if windows >= limit:
                    yield from _chunk(parts, buckets, turn, turns)
                    parts, windows = [], 0
        if parts:
            yield from _chunk(parts, buckets, turn, turns)

    return df.mapInArrow(run, _ROW)


def _segments(rows: np.ndarray, words: np.ndarray, windows: np.ndarray) -> np.ndarray:
    made = np.empty(len(rows), _SEGMENT)
    made["row"], made["word"], made["windows"] = rows, words, windows
    return made


def _probes(copy: DataFrame, block: int, buckets: int) -> DataFrame:
    """Hashes of all rolling windows of ``block`` words, dealt out; the last bit says which are blocks.

    Blocks are the windows at multiples of ``block``.
    """

    def hashed(batch: pa.RecordBatch):
        rows = batch.column("_row").to_numpy(zero_copy_only=False)
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        for low, high in slices([len(t) for t in texts], 1 << 20):
            flat, begin, end, ends = _words(texts[low:high])
            starts = np.concatenate(([0], ends[:-1]))
            owner, word = _places(ends - starts, block)
            if not len(owner):
                continue
            at = starts[owner] + word
            hashes = run_hashes(run_hashes(flat, begin, end, _BASE), at, at + block, _BASE)
            sent = hashes.astype(np.uint32) & ~np.uint32(1) | (word % block == 0)
            n = np.maximum(0, ends - starts - block + 1)
            some = n > 0
            yield _segments(rows[low:high][some], np.zeros(some.sum(), np.int32), n[some]), hashes, [sent]

    return _dealt(copy.select("_row", "text"), hashed, buckets)


def _answers(dealt: DataFrame, judge) -> DataFrame:
    """``judge`` on all windows of a bucket; the windows it picks go back by chunk, packed."""

    def run(table: pa.Table) -> pa.Table:
        places = [_unpacked(p) for p in table.column("places").to_pylist()]
        sizes = [len(p) for p in places]
        picked = judge(table.column("hashes").to_pylist(), sizes)
        found, end = [], 0
        for chunk, p, segments in zip(table.column("_chunk").to_pylist(), places, table.column("segments").to_pylist()):
            end += len(p)
            mine = p[picked[end - len(p) : end]]
            if len(mine) or segments is not None:
                found.append((chunk, _packed(mine), segments))
        names = ("_chunk", "places", "segments")
        return pa.Table.from_arrays(_columns(found, names, (pa.int64(), pa.binary(), pa.binary())), names=list(names))

    return dealt.groupBy("bucket").applyInArrow(run, _FOUND)


def _hits(probes: DataFrame) -> DataFrame:
    """Windows that equal a block elsewhere."""

    def judge(data, sizes):
        sent = np.concatenate([np.frombuffer(d, np.uint32) for d in data])
        hashes, picked = sent >> np.uint32(1), np.zeros(len(sent), bool)
        blocks = np.flatnonzero(sent & np.uint32(1))
        if not len(blocks):
            return picked
        blocks = blocks[np.argsort(hashes[blocks], kind="stable")]
        value = hashes[blocks]
        first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        count, value, holder = np.diff(np.append(first, len(blocks))), value[first], blocks[first]
        # most windows equal no block, and the leading bits of the blocks' hashes tell most of them
        there = np.zeros(1 << 22, bool)
        there[value >> np.uint32(9)] = True
        maybe = np.flatnonzero(there[hashes >> np.uint32(9)])
        own = hashes[maybe]
        at = np.minimum(np.searchsorted(value, own), len(value) - 1)
        picked[maybe] = (value[at] == own) & ((count[at] > 1) | (holder[at] != maybe))
        return picked

    return _answers(probes, judge)


def _repeats(dealt: DataFrame) -> DataFrame:
    """Windows whose hash occurs at more than one place."""

    def judge(data, sizes):
        one = np.concatenate([np.frombuffer(d, np.uint64, n) for d, n in zip(data, sizes)])
        two = np.concatenate([np.frombuffer(d, np.uint32, n, 8 * n) for d, n in zip(data, sizes)])
        order = np.argsort(one)
        same = one[order][1:] == one[order][:-1]
        if (same & (two[order][1:] != two[order][:-1])).any():
            order = np.lexsort((two, one))
            same = one[order][1:] == one[order][:-1]
        same &= two[order][1:] == two[order][:-1]
        picked = np.zeros(len(one), bool)
        picked[order] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        return picked

    return _answers(dealt, judge)


def _smallest(values: np.ndarray) -> np.ndarray:
    """Numbers in as few bytes as the largest needs."""
    return values.astype(np.uint8 if (top := int(values.max())) < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _packed_spans(texts: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> bytes:
    """Spans of words in texts of a group, by the texts' places in it; such bytes can follow each other."""
    parts = [texts.astype(np.uint8), _smallest(begins), _smallest(lengths)]
    return np.array([len(texts), *(p.itemsize for p in parts[1:])], "<u4").tobytes() + b"".join(p.tobytes() for p in parts)


def _unpacked_spans(data: bytes) -> dict[int, list[tuple[int, int]]]:
    """By the place of a text in its group: begins and ends of its spans, ascending, apart from each other."""
    found, at = {}, 0
    while at < len(data):
        n, *sizes = np.frombuffer(data, "<u4", 3, at).tolist()
        at, parts = at + 12, []
        for size in (1, *sizes):
            parts.append(np.frombuffer(data, f"<u{size}", n, at).astype(np.int64))
            at += n * size
        text, begin, length = parts
        for t, b, e in zip(text.tolist(), begin.tolist(), (begin + length).tolist()):
            found.setdefault(t, []).append((b, e))
    return {t: _merged(spans) for t, spans in found.items()}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as runs: what overlaps or touches is one."""
    runs: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((begin, end))
    return runs


def _own_spans(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int]]]:
    """The spans of each row, from those of its group."""
    group, held = None, {}
    for row, data in zip(batch.column("_row").to_pylist(), batch.column("spans")):
        if row >> GROUP_BITS != group:
            group, held = row >> GROUP_BITS, _unpacked_spans(data.as_py() or b"")
        yield held.get(row & (1 << GROUP_BITS) - 1, [])


def _beside(copy: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Each row of a stored copy beside the spans of its group."""
    return looked_up(copy.withColumn("_group", F.shiftright("_row", GROUP_BITS)), spans.select("_group", "spans"), "_group", how)


def _spans(answers: DataFrame, before: int, after: int) -> DataFrame:
    """The words within ``before`` and ``after`` of picked places, as runs: _group, spans (packed), words.

    A chunk's answers are one per bucket and together no more than its windows.
    """
    gathered = answers.groupBy("_chunk").agg(F.collect_list("places").alias("places"), F.first("segments", True).alias("segments"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for packed, data in zip(batch.column("places"), batch.column("segments")):
            place = np.sort(np.concatenate([_unpacked(p) for p in packed.as_py()]))
            if not len(place):
                continue
            segments = np.frombuffer(data.as_py(), _SEGMENT)
            ends = np.cumsum(segments["windows"].astype(np.int64))
            which = np.searchsorted(ends, place, "right")
            row = segments["row"][which]
            word = place - (ends - segments["windows"])[which] + segments["word"][which]
            first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (word[1:] - before > word[:-1] + after))))
            last = np.append(first[1:], len(place)) - 1
            row, begin = row[first], np.maximum(0, word[first] - before)
            length, group, text = word[last] + after - begin, row >> GROUP_BITS, row & (1 << GROUP_BITS) - 1
            cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(group)]):
                spans = _packed_spans(text[low:high], begin[low:high], length[low:high])
                made.append((int(group[low]), spans, int(length[low:high].sum())))
        names = ("_group", "spans", "words")
        return pa.RecordBatch.from_arrays(_columns(made, names, (pa.int64(), pa.binary(), pa.int64())), names=list(names))

    # texts of a group may be in several chunks, one text is in one
    return _by_group(over_batches(gathered, "_group long, spans binary, words long", work))


def _by_group(pieces: DataFrame) -> DataFrame:
    joined = F.expr("aggregate(collect_list(spans), X'', (a, b) -> concat(a, b))")
    return pieces.groupBy("_group").agg(joined.alias("spans"), F.sum("words").alias("words"))


def _extended(near: DataFrame, width: int, buckets: int, turn: int, turns: int) -> DataFrame:
    """Hashes of the windows of ``width`` words that begin in a row's spans, dealt out."""

    def hashed(batch: pa.RecordBatch):
        spans = list(_own_spans(batch))
        some = np.flatnonzero([len(s) > 0 for s in spans])
        rows = batch.column("_row").to_numpy(zero_copy_only=False)[some]
        texts = [t or b"" for t in batch.column("text").take(pa.array(some)).cast(pa.binary()).to_pylist()]
        for low, high in slices([len(t) for t in texts], 1 << 20):
            flat, begin, end, ends = _words(texts[low:high])
            starts = np.concatenate(([0], ends[:-1]))
            pairs = [(k, b, e) for k in range(high - low) for b, e in spans[some[low + k]]]
            text, first, last = np.array(pairs, np.int64).T
            n = np.minimum(last, (ends - starts - width + 1)[text]) - first
            text, first, n = text[n > 0], first[n > 0], n[n > 0]
            if not len(n):
                continue
            at = np.repeat(starts[text] + first - np.cumsum(n) + n, n) + np.arange(n.sum())
            one, two = (run_hashes(run_hashes(flat, begin, end, base), at, at + width, base) for base in (_BASE, _SECOND))
            yield _segments(rows[low:high][text], first, n), one, [one, two.astype(np.uint32)]

    return _dealt(near.select("_row", "text", "spans"), hashed, buckets, turn, turns)


def repeated_spans(copy: DataFrame, width: int = WIDTH) -> DataFrame:
    """Of a stored copy (_row, text), the words inside repeated windows: spans by group of rows, packed."""
    spark = copy.sparkSession
    size = copy.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = max(min(2 * shuffle_partitions(spark), SPARE_BUCKETS), -(-size // BUCKET_BYTES))
    # a window of this many words holds a block of so many, wherever it begins
    block = (width + 1) // 2
    hits = session.materialize(_spans(_hits(_probes(copy, block, buckets)), width - block, 1), "hits")
    near = _beside(copy, hits, "inner")
    windows = hits.agg(F.sum("words")).first()[0] or 0
    turns = max(1, math.ceil(windows * WINDOW_BYTES / max(1, size * TURN_BYTES)))
    found = [
        session.materialize(_spans(_repeats(_extended(near, width, buckets, turn, turns)), 0, width), "repeats")
        for turn in range(turns)
    ]
    return found[0] if turns == 1 else session.materialize(_by_group(reduce(DataFrame.unionAll, found)), "repeats")


def dedup(docs: DataFrame, keep: tuple = ("doc_id",), width: int = WIDTH) -> DataFrame:
    """Texts without the words of repeated windows.

    Reads ``text`` and the columns named in ``keep``, which are returned; other columns
    are ignored. Words are what stands between white space (space and U+0009 to U+000D).
    Every word covered by a window of ``width`` words whose sequence begins anywhere else
    too is removed, from the first copy like from the others. Adds n_words, n_removed,
    text (the kept words joined by one space) and spans (runs of removed words: begin
    and end, as word numbers). A null or empty text has no words.
    """
    copy = numbered_copy(docs.select(*keep, F.col("text").alias("_text")), "documents")
    found = repeated_spans(copy.select("_row", F.col("_text").alias("text")), width)
    joined = _beside(copy, found, "left")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, kept, runs = [], [], [], []
        for text, pairs in zip(batch.column("_text").cast(pa.binary()).to_pylist(), _own_spans(batch)):
            words = (text or b"").split()  # bytes: splits at exactly these six characters
            n, gone = len(words), 0
            for begin, end in reversed(pairs):
                gone += end - begin
                del words[begin:end]
            n_words.append(n)
            n_removed.append(gone)
            kept.append(b" ".join(words))
            runs.append([{"start": b, "end": e} for b, e in pairs])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(runs, kind)]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + columns, names=[*keep, "n_words", "n_removed", "text", "spans"])

    fields = [f for f in copy.schema.fields if f.name in keep]
    more = StructType.fromDDL("n_words long, n_removed long, text string, spans array<struct<start: int, end: int>>")
    return over_batches(joined.select(*keep, "_row", "_text", "spans"), StructType(fields + more.fields), work)
