"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are lowered (A to Z) and cut into words of ``[0-9a-z]`` and characters from
U+0080 on. Windows of ``width`` consecutive words of the benchmark items (the whole
item where it is shorter) become the patterns, as word numbers; each document is scanned once and
every word inside an occurrence is a hit. Offsets lead back to the original text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally.llm.common import beside_text, over_batches, text_bytes

#: Bytes that become spaces, and A to Z that become a to z. Bytes from 0x80 on stay.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")

#: Nodes of one automaton over word numbers, at most, some 80 bytes each with their windows.
MOST_NODES = 4_000_000

NAMES = ("n_words", "n_hit", "item_ids", "spans", "contaminated")
RESULT = (
    "n_words long, n_hit long, item_ids array<string>, "
    "spans array<struct<item_id: string, start: int, end: int>>, contaminated boolean"
)
KINDS = [
    pa.int64(),
    pa.int64(),
    pa.list_(pa.string()),
    pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
    pa.bool_(),
]


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(found: list, width: int) -> list[tuple]:
    """The distinct windows of an item's words; all of them where there are fewer than ``width``."""
    if len(found) < width:
        return [tuple(found)] if found else []
    return list(dict.fromkeys(tuple(found[i : i + width]) for i in range(len(found) - width + 1)))


def _automaton(items: list[tuple[str, list[bytes]]], width: int):
    """Numbers of the words of a group, and the automaton over windows of these numbers."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    owners: dict[tuple, list[str]] = {}
    for item, found in items:
        for w in windows([numbers.setdefault(x, len(numbers) + 1) for x in found], width):
            ids = owners.setdefault(w, [])
            if item not in ids:
                ids.append(item)
    made = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for pattern, ids in owners.items():
        made.add_word(pattern, (len(pattern), ids))
    if owners:
        made.make_automaton()
    return numbers, made


_HELD: dict = {}


def _held(key, group, width: int):
    """The automaton of a broadcast group; a worker keeps one."""
    if (key, width) not in _HELD:
        _HELD.clear()
        _HELD[key, width] = _automaton(group.value, width)
    return _HELD[key, width]


def _groups(rows, width: int, group_bytes: int):
    """Parts of the benchmark for one automaton each, as (item, words) pieces.

    A part has at most ``group_bytes`` of text and MOST_NODES nodes, or one piece. An
    item too long for one piece is cut; pieces overlap, so that no window is lost.
    """
    longest = max(width, MOST_NODES // width)
    group, size, nodes = [], 0, 0
    for item, text in rows:
        found = words(bytes(text))
        for at in range(0, max(1, len(found) - width + 1), longest):
            piece = found[at : at + longest + width - 1]
            n = sum(map(len, piece)) + len(piece)
            more = max(len(piece), (len(piece) - width + 1) * width)
            if group and (size + n > group_bytes or nodes + more > MOST_NODES):
                yield group
                group, size, nodes = [], 0, 0
            group.append((item, piece))
            size, nodes = size + n, nodes + more
    if group:
        yield group


def _hits(texts: list[bytes], groups, width: int) -> list[list[tuple]]:
    """Per text, the windows in it: (last word, words, items). Each group is taken through all texts."""
    hits: list[list[tuple]] = [[] for _ in texts]
    for key, group in groups:
        numbers, automaton = _held(key, group, width)
        if len(automaton):
            for of, text in zip(hits, texts):
                of += [(end, *value) for end, value in automaton.iter(tuple(numbers.get(w, 0) for w in words(text)))]
    return hits


def _judged(text: bytes, hits: list[tuple]) -> tuple:
    n_words = len(words(text))
    if not hits:
        return n_words, 0, [], [], False
    covered, spans = np.zeros(n_words, bool), set()
    places = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    for end, n, ids in hits:
        covered[end + 1 - n : end + 1] = True
        spans.update((item, places[end + 1 - n][0], places[end][1]) for item in ids)
    # byte offsets to character offsets: bytes that begin a character, counted
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    ordered = sorted(spans, key=lambda x: (x[0] is not None, x[0] or "", *x[1:]))
    spans = [(item, int(chars[s]), int(chars[e])) for item, s, e in ordered]
    items, n_hit = list(dict.fromkeys(item for item, _, _ in spans)), int(covered.sum())
    return n_words, n_hit, items, spans, 20 * n_hit >= n_words


def scan(docs: DataFrame, benchmark: DataFrame, keep: tuple = ("doc_id",), width: int = 13, group_bytes: int = 32 << 20) -> DataFrame:
    """Per document, the words that occur in a benchmark window and where.

    Reads ``text`` and the columns named in ``keep``, which are returned; other
    columns are ignored. ``benchmark`` has ``item_id`` and ``text``; rows without text
    take no part. A null or empty text has no words and is clean. Repeated item ids
    count as one item, and so do all items without an id, whose null stands first. Benchmark texts go to the tasks in groups of at most
    ``group_bytes`` and MOST_NODES automaton nodes, each group one automaton. A worker
    holds one automaton at a time, kept from batch to batch where there is one group;
    with more of them each is built once for each batch of rows, so memory stays bounded
    by the texts of the benchmark and every window counts. ``spans`` holds one entry per item
    and window occurrence, as character offsets of the original text.
    """
    spark = docs.sparkSession
    items = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")
    )
    groups = []
    for rows in _groups(items.toLocalIterator(), width, group_bytes):
        groups.append((hashlib.sha256(repr(rows).encode()).hexdigest(), spark.sparkContext.broadcast(rows)))

    chosen, text = beside_text(docs, keep)

    def work(batch: pa.RecordBatch):
        texts = text_bytes(batch.column(text))
        n_words, n_hit, items, spans, bad = zip(*(_judged(t, h) for t, h in zip(texts, _hits(texts, groups, width))))
        spans = [[dict(zip(("item_id", "start", "end"), s)) for s in of] for of in spans]
        made = [pa.array(v, k) for v, k in zip((n_words, n_hit, items, spans, bad), KINDS)]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + made, names=[*keep, *NAMES])

    return over_batches(chosen, StructType(chosen.schema.fields[: len(keep)] + StructType.fromDDL(RESULT).fields), work)
