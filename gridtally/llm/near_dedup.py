"""Near-duplicate classes by order min-hash and banded alignment.

A text is its sequence of lowered words. Each run of ``k`` words is labelled with how
often it occurred before; an order min-hash sketch takes the ``TAKE`` smallest of these
under its own hash and keeps them in text order, so sketches agree for texts that are
close in edit distance. Texts that share a sketch are candidates, and a link holds when
the word edit distance, computed in a band around the diagonal, is at most
(1 - similarity) of the longer text. Classes are the components of the links.

Texts with equal words are one text from the start. Each text is first paired with the
first text of its largest and of its smallest bucket. Buckets that are in one component
then are done. In the others pairs of different components follow: all in a bucket of
few texts, those with the first text, another one in each band, in a larger one. Where
that leaves a large bucket in several components, its texts are compared exactly: in one
task each, or, where a bucket is very large, by the rarest words, of which any two texts
that can be linked share one. Such a task holds its texts' words, rules pairs out by
counts of words, aligns others as long as their components stay apart, and passes on
nothing but links. Only the texts of a word that very many offer meet in blocks: there a
task looks at the words that either of two texts has alone, by one bit a word, which must
be few; of what is left between two components some pairs are aligned first, and further
ones only as long as they stay apart.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally import session
from gridtally.llm.common import looked_up, mix, numbered_copy, over_batches, run_hashes, set_aside, slices, spans_of
from gridtally.llm.components import components

SHINGLE = 3
SIMILARITY = 0.8
#: Sketches of a text, and k-mers a sketch takes: texts of similarity 0.8 share one with probability 0.99 or more.
SKETCHES, TAKE = 48, 2
#: A power of two, at least ``SKETCHES``: a bucket's key holds its band below it.
BANDS = 64
#: Texts of a bucket up to which all its pairs are compared.
ALL_PAIRS = 10
#: Shorter texts are linked to none; texts up to ``SHORT`` words have too few k-mers for sketches and are compared exactly.
SHORTEST, SHORT = 5, 50
#: Slots in which words are counted, as a power of two.
SLOT_BITS = 17
#: Texts of a bucket, or that offer the same word, up to which they are compared in one task, texts of a block of the others, and rows of a task.
CROWD, BLOCK, GROUP_ROWS = 4096, 512, 100_000
#: Words of the texts of a task, and slots in which a task counts a text's words.
GROUP_WORDS, SLOTS = 4_000_000, 256
#: Pairs that a task looks at, and pairs that it aligns.
GROUP_PAIRS, ALIGNED_PAIRS = 5_000_000, 2000
#: Pairs between two classes of one task that are aligned first, and how many times more in each next turn.
FIRST_PAIRS, MORE_PAIRS = 1024, 64
#: Numbers of 64 bits in which a text's words set a bit each.
SIGNS = 4
_ALIKE = f"least(x.n_words, y.n_words) >= {SIMILARITY} * greatest(x.n_words, y.n_words)"
_BASE = 0x9E3779B97F4A7C15
_BAND = f"cast(key & {BANDS - 1} AS int)"


def word_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in a row, and where each text's words end."""
    data = [t.lower().encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    flat = np.frombuffer(b"".join(data), np.uint8)
    letter = (flat >= 0x80) | ((flat >= 0x30) & (flat <= 0x39)) | ((flat >= 0x61) & (flat <= 0x7A))
    begin, end = spans_of(letter)
    ends = np.cumsum([len(d) for d in data])
    return run_hashes(flat, begin, end, _BASE), np.searchsorted(begin, ends)


def _first_seen(keys: np.ndarray) -> np.ndarray:
    """How often each key stood before its place."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    start = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    seen = np.empty(len(keys), np.int64)
    seen[order] = np.arange(len(keys)) - start
    return seen


def sketches(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order min-hash sketches, a row for each text; a text without words has zeros."""
    starts = np.concatenate(([0], ends[:-1]))
    sizes = ends - starts
    grams = np.maximum(np.minimum(sizes, 1), sizes - SHINGLE + 1)  # a shorter text is one k-mer
    owner = np.repeat(np.arange(len(ends)), grams)
    first = np.cumsum(grams) - grams
    at = np.arange(len(owner)) - first[owner] + starts[owner]
    hashes = run_hashes(words, at, np.minimum(at + SHINGLE, ends[owner]), _BASE ^ 0x5555555555555554)
    made = np.zeros((len(ends), SKETCHES), np.uint64)
    full = np.flatnonzero(grams)
    if not len(full):
        return made
    # equal k-mers of one text differ by how often they occurred before
    labelled = mix(hashes + mix(_first_seen(mix(hashes ^ mix(owner.astype(np.uint64)))).astype(np.uint64)))
    for j in range(SKETCHES):
        order = mix(labelled ^ np.uint64((j + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1))
        picked = np.full((len(full), TAKE), np.iinfo(np.int64).max)
        for n in range(TAKE):
            least = np.minimum.reduceat(order, first[full])
            place = np.flatnonzero(order == np.repeat(least, grams[full]))
            whose, once = np.unique(owner[place], return_index=True)
            row = np.searchsorted(full, whose)
            more = grams[whose] > n
            picked[row[more], n] = place[once][more]
            order[place] = np.iinfo(np.uint64).max
        picked.sort(axis=1)
        value = np.zeros(len(full), np.uint64)
        for n in range(TAKE):
            there = picked[:, n] < len(owner)
            value = np.where(there, mix(value * np.uint64(3) + hashes[np.minimum(picked[:, n], len(owner) - 1)]), value)
        made[full, j] = value
    return made


def within(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """The edit distance of two sequences if it is at most ``limit``.

    Bit-parallel alignment in a band: bits of a Python integer are the cells of one
    column within ``limit`` of the diagonal, as differences to the cell above.
    """
    if abs(len(a) - len(b)) > limit:
        return None
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[:n] != b[:n])
    if not len(apart):
        return max(len(a), len(b)) - n
    low = int(apart[0])
    apart = np.flatnonzero(a[len(a) - n + low :][::-1] != b[len(b) - n + low :][::-1])
    high = int(apart[0]) if len(apart) else n - low
    a, b = a[low : len(a) - high].tolist(), b[low : len(b) - high].tolist()
    if len(a) < len(b):
        a, b = b, a
    shift = len(a) - len(b)
    if not b:
        return shift
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    width = 2 * limit + 1
    mask, top, watch = (1 << width) - 1, 1 << (width - 1), limit + shift
    # column 0 holds 0, 1, 2 ... below the diagonal; rows above the first do not count
    up, down, score = mask >> (limit + 1) << (limit + 1), 0, shift
    for j, x in enumerate(b):
        # the band moves one row down: the lowest row begins as one more than the row above
        up, down = up >> 1 | top, down >> 1
        match = where.get(x, 0)
        match = (match >> (j - limit) if j >= limit else match << (limit - j)) & mask
        same = ((((match & up) + up) ^ up) | match | down) & mask
        right = (down | ~(same | up)) & mask
        left = same & up
        score += not same >> watch & 1
        if score > limit:
            return None
        right = (right << 1 | 1) & mask
        up = (left << 1 | ~(same | right)) & mask
        down = right & same
    return score


def _sketched(copy: DataFrame) -> DataFrame:
    """Per row, its words' hash (two parts), their number and the sketches."""

    def work(batch: pa.RecordBatch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for low, high in slices([len(t) for t in texts], 1 << 19):
            words, ends = word_runs(texts[low:high])
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
            one, two = (run_hashes(words, starts, ends, base).view(np.int64) for base in (_BASE ^ 0x1234567812345678, _BASE ^ 0x0F0F0F0F0F0F0F0E))
            made = sketches(words, ends).view(np.int64)
            columns = [
                *(batch.column(c).slice(low, high - low) for c in ("_row", "doc_id")), pa.array(one), pa.array(two), pa.array((ends - starts).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, SKETCHES, dtype=np.int32)), pa.array(made.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "doc_id", "h1", "h2", "n_words", "sketch"])

    chosen = copy.select("_row", "doc_id", "text")
    more = StructType.fromDDL("h1 long, h2 long, n_words int, sketch array<long>")
    return over_batches(chosen, StructType(chosen.schema.fields[:2] + more.fields), work)


def _shared(active: DataFrame) -> DataFrame:
    """Rows (id, n_words, key) of buckets with more than one text, with the bucket's size n, first text x and, in m, the texts it is stored with and its place ``at`` there.

    ``active`` has a row (id, n_words, band, key) for each sketch of a text; the band becomes the
    lowest bits of the key. A bucket of up to ``ALL_PAIRS`` texts is stored as one row, a larger
    one as a row for each text. Which text is first differs by band, so that no text is the only
    one others are compared with. The rows are shuffled once, for the counts, for the join with
    them and for the texts of a bucket.
    """
    active = active.select("id", "n_words", F.expr(f"xxhash64(key) & {-BANDS} | band").alias("key")).repartition("key")
    first = F.min(F.struct(F.xxhash64("id", F.expr(_BAND)).alias("salt"), "id", "n_words"))
    sizes = active.groupBy("key").agg(F.count(F.lit(1)).alias("n"), first.alias("x")).where("n > 1")
    sizes = sizes.withColumn("x", F.struct("x.id", "x.n_words"))
    rows = active.join(sizes.hint("merge"), "key").withColumn("alone", F.when(F.col("n") > ALL_PAIRS, F.col("id")))
    made = rows.groupBy("key", "alone").agg(F.first("n").alias("n"), F.first("x").alias("x"), F.collect_list(F.struct("id", "n_words")).alias("m"))
    stored = session.materialize(made.drop("alone"), "buckets")
    return stored.select("*", F.posexplode("m").alias("at", "y")).select("key", "n", "x", "m", "at", "y.id", "y.n_words")


def _nearest(shared: DataFrame) -> DataFrame:
    """Pairs (a < b) to compare first: each text and the first one of its largest and of its smallest bucket."""
    star = shared.select("x", F.struct("id", "n_words").alias("y"), "n", F.expr(_BAND).alias("band")).where("x.id != y.id").where(_ALIKE)
    ends = star.groupBy("y").agg(*(f(F.struct("n", "band", "x")).alias(c) for f, c in ((F.max, "most"), (F.min, "least"))))
    return ends.select("y", F.explode(F.array("most.x", "least.x")).alias("x")).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _pairs(shared: DataFrame, first: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a < b) of different roots but the ``first``: all of a small bucket, those with the first text of a large one.

    A pair that shares many buckets is one row before its roots are looked up.
    """
    small = shared.where(F.col("n") <= ALL_PAIRS).select(F.struct("id", "n_words").alias("x"), F.explode(F.expr("slice(m, at + 2, size(m))")).alias("y"))
    star = shared.where(F.col("n") > ALL_PAIRS).where("x.id != id").select("x", F.struct("id", "n_words").alias("y"))
    pairs = small.union(star).where(_ALIKE).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    pairs = pairs.join(first, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        pairs = looked_up(pairs, roots.withColumnsRenamed({"id": end, "root": f"of_{end}"}), end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return pairs.where("of_a != of_b").select("a", "b")


def _links(copy: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b, similarity) between text ids, and the ``root`` of each linked id: their components are the classes.

    ``texts`` has each text once (id, n_words, sketch). A bucket is done when all its texts are
    in one component. The texts of large ones that are not, and all short texts, are compared
    exactly (``_rest``).
    """
    texts = texts.where(f"n_words >= {SHORTEST}")
    shared = _shared(texts.select("id", "n_words", F.posexplode("sketch").alias("band", "key")))
    short = texts.where(f"n_words <= {SHORT}").select("id", "n_words")
    met = session.materialize(shared.select("id").union(short.select("id")).distinct().withColumn("_row", F.col("id")), "wanted")
    words = session.materialize(_words_of(copy, met), "words")
    first = session.materialize(_nearest(shared), "pairs")
    links = session.materialize(_verified(first, words), "links")
    roots = _grown(None, links)
    pairs = session.materialize(_pairs(shared, first, roots), "pairs")
    more = session.materialize(_verified_pairs(pairs, words), "links")
    roots = _grown(roots, more)
    large = shared.where(F.col("n") > ALL_PAIRS).select("key", "id", "n_words", "n")
    found, roots = _rest(words, _undone(large, short, roots), roots, first.union(pairs))
    return links.union(more).union(found), roots


def _grown(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``id`` and ``root`` of all texts that have one, or get one by stored new links: only these links' components are made."""
    if roots is None:
        return session.materialize(components(links).withColumnRenamed("node", "id"), "roots")
    ends = links.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(roots.withColumnsRenamed({"id": end, "root": f"of_{end}"}), end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    ends = session.materialize(ends, "ends")
    merged = session.materialize(components(ends, "of_a", "of_b").select(F.col("node").alias("root"), F.col("root").alias("merged")), "merged")
    every = roots.union(ends.select("a", "of_a")).union(ends.select("b", "of_b")).distinct()
    every = every.join(merged, "root", "left").select("id", F.coalesce("merged", "root").alias("root"))
    return session.materialize(every, "roots")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` of their ``id``, the id itself where no link has it."""
    return rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of ``rows`` (id, n_words, key, n) whose bucket holds several components."""
    rooted = session.materialize(_rooted(rows, roots), "rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return rooted.join(session.materialize(apart.select("key"), "apart"), "key")


def _undone(large: DataFrame, short: DataFrame, roots: DataFrame) -> DataFrame:
    """Texts (id, n_words, root) of large buckets that hold several components, and all short ones.

    ``buckets`` are those of up to ``CROWD`` texts; texts of larger ones, and short ones, are ``rare``: they meet by their rarest words.
    """
    still = _open(large, roots)
    held = still.select("id", "n_words", F.when(F.col("n") <= CROWD, F.xxhash64("key")).alias("bucket"), (F.col("n") > CROWD).alias("rare"))
    short = short.select("id", "n_words", F.lit(None).cast("long").alias("bucket"), F.lit(True).alias("rare"))
    # a text has one bucket a band at most
    undone = held.union(short).groupBy("id", "n_words").agg(F.collect_set("bucket").alias("buckets"), F.max("rare").alias("rare"))
    return session.materialize(_rooted(undone, roots), "undone")


def _word_tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words, told apart by how often they occurred before: hash, owner, words of each text."""
    texts = [np.frombuffer(w, np.uint32) for w in batch.column("words").to_pylist()]
    sizes = np.array([len(w) for w in texts])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    word = mix(np.concatenate(texts).astype(np.uint64))
    return mix(word + mix(_first_seen(mix(word ^ mix(owner.astype(np.uint64)))).astype(np.uint64))), owner, sizes


def _edits(sizes: np.ndarray) -> np.ndarray:
    """Edits that a link allows where the longer text has so many words."""
    return (sizes * (1 - SIMILARITY) + 1e-9).astype(np.int64)


def _rarest(texts: DataFrame) -> DataFrame:
    """Of texts (id, n_words, root, buckets, rare, words): ``tokens``, their buckets and, of rare texts, the words of which linked ones share one, and ``signs``, a bit for each word.

    An edit takes at most one word away, so linked texts of at most n words have all but
    e = 0.2 n words in common, and the rarest of these is among the e + 1 rarest words of
    both. Words are ordered by how many there are in rare texts, counted in slots of their
    hashes, then by hash. Repeated words are told apart.
    """
    shift = np.uint64(64 - SLOT_BITS)

    def count(batches):
        seen = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            if batch.num_rows:
                seen += np.bincount((_word_tokens(batch)[0] >> shift).astype(np.int64), minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["slot", "n"])

    counted = texts.where("rare").select("words").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(1 << SLOT_BITS, np.int64)
    often[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(often)

    def rare(batch: pa.RecordBatch):
        for low, high in slices([len(w) for w in batch.column("words").to_pylist()], 1 << 20):
            some = batch.slice(low, high - low)
            hashes, owner, sizes = _word_tokens(some)
            order = np.lexsort((hashes, shared.value[(hashes >> shift).astype(np.int64)], owner))
            kept = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner] < np.where(np.asarray(some.column("rare")), _edits(sizes) + 1, 0)[owner]
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner[kept], minlength=len(sizes)))))
            tokens = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes[order].view(np.int64)[kept]))
            bit = mix(np.concatenate([np.frombuffer(w, np.uint32) for w in some.column("words").to_pylist()]).astype(np.uint64)) % np.uint64(64 * SIGNS)
            signs = np.zeros((len(sizes), SIGNS), np.uint64)
            np.bitwise_or.at(signs, (owner, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
            columns = [*(some.column(c) for c in ("id", "n_words", "root", "buckets")), tokens, *(pa.array(signs[:, k].view(np.int64)) for k in range(SIGNS))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "root", "buckets", "tokens", *_SIGNS])

    schema = "id long, n_words int, root long, buckets array<long>, tokens array<long>, " + ", ".join(f"{s} long" for s in _SIGNS)
    made = over_batches(texts.select("id", "n_words", "root", "buckets", "rare", "words"), schema, rare)
    return made.withColumn("tokens", F.concat("buckets", "tokens")).drop("buckets")


_SIGNS = [f"s{k}" for k in range(SIGNS)]


class _Texts:
    """Texts of one task that offer words, and which two of them may be linked."""

    def __init__(self, table: pa.Table, order: np.ndarray | None = None):
        columns = {c: np.asarray(table.column(c)).astype(np.int64) for c in ("token", "id", "n_words", "root", *_SIGNS)}
        if order is None:
            order = np.lexsort((columns["id"], columns["token"]))
        self.token, self.id, self.size, self.root = (columns[c][order] for c in ("token", "id", "n_words", "root"))
        self.signs = [columns[c][order].view(np.uint64) for c in _SIGNS]
        self.edits = _edits(self.size)

    def linkable(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs (places x, y) have different roots, and few words that only one of them has."""
        edits = np.maximum(self.edits[x], self.edits[y])
        fits = (self.root[x] != self.root[y]) & (np.abs(self.size[x] - self.size[y]) <= edits)
        at = np.flatnonzero(fits)
        for one, other in ((x[at], y[at]), (y[at], x[at])):
            alone = sum(np.bitwise_count(s[one] & ~s[other]).astype(np.int64) for s in self.signs)
            fits[at] &= alone <= edits[at]
        return fits

    def picked(self, x: np.ndarray, y: np.ndarray, pairs: int) -> pa.Table:
        """The first ``pairs`` of the pairs between any two roots: token, a, b, and whether the token's texts have more."""
        a, b = np.minimum(self.id[x], self.id[y]), np.maximum(self.id[x], self.id[y])
        order = np.lexsort((self.token[x], b, a))
        x, y, a, b = x[order], y[order], a[order], b[order]
        low, high = np.minimum(self.root[x], self.root[y]), np.maximum(self.root[x], self.root[y])
        # a pair that shares several words counts once; which pairs are first differs from root to root
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(a)]
        x, a, b, low, high = (c[new] for c in (x, a, b, low, high))
        mixed = mix(a.view(np.uint64) ^ mix(b.view(np.uint64)))
        order = np.lexsort((mixed, high, low))
        x, a, b, low, high = (c[order] for c in (x, a, b, low, high))
        first = np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])))[: len(a)]
        place = np.arange(len(a))
        rank = place - np.maximum.accumulate(np.where(first, place, 0)) if len(a) else place
        kept = rank < pairs
        # a row without a pair for each token whose texts have more
        cut = np.unique(self.token[x[~kept]])
        none = np.full(len(cut), -1, np.int64)
        columns = [np.concatenate(c) for c in ((self.token[x[kept]], cut), (a[kept], none), (b[kept], none))]
        more = np.concatenate((np.zeros(int(kept.sum()), bool), np.ones(len(cut), bool)))
        return pa.Table.from_arrays([*(pa.array(c) for c in columns), pa.array(more)], names=["token", "a", "b", "more"])


_CLOSE = "token long, a long, b long, more boolean"


class _Held:
    """Texts of one task with their words, and the links between them."""

    def __init__(self, table: pa.Table, tasks: int):
        columns = {c: np.asarray(table.column(c)).astype(np.int64) for c in ("id", "n_words", "root")}
        order = np.argsort(columns["id"], kind="stable")
        self.id, self.size, self.root = (columns[c][order] for c in ("id", "n_words", "root"))
        self.edits = _edits(self.size)
        words, tokens = (table.column(c).to_pylist() for c in ("words", "tokens"))
        self.words = [np.frombuffer(words[i], np.uint32) for i in order]
        self.offered = [frozenset(tokens[i]) for i in order]
        self.counts = np.stack([np.minimum(np.bincount(w % np.uint32(SLOTS), minlength=SLOTS), 255).astype(np.uint8) for w in self.words])
        # which text offers which word, of the words that are compared here
        flat = np.array([x for i in order for x in tokens[i]], np.int64)
        owner = np.repeat(np.arange(len(order)), [len(tokens[i]) for i in order])
        here = flat % tasks == table.column("task")[0].as_py()
        flat, owner = flat[here], owner[here]
        order = np.lexsort((owner, flat))
        self.token, self.owner = flat[order], owner[order]
        self.bags, self.held = {}, 0

    def fit(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs have different roots, and few words that only one of them has."""
        edits = np.maximum(self.edits[x], self.edits[y])
        longer = self.size[x] - self.size[y]
        fits = (self.root[x] != self.root[y]) & (np.abs(longer) <= edits)
        at = np.flatnonzero(fits)
        for low in range(0, len(at), 1 << 16):
            some = at[low : low + (1 << 16)]
            one, other = self.counts[x[some]], self.counts[y[some]]
            most = np.maximum(one, other)
            for less, n in ((other, longer[some]), (one, -longer[some])):
                # a word that only the first has is taken away or replaced, as many as the second is longer by are added
                fits[some] &= (most - less).sum(axis=1, dtype=np.int64) <= edits[some] - np.maximum(-n, 0)
        return fits

    def bag(self, i: int) -> np.ndarray:
        if i not in self.bags:
            self.held += len(self.words[i])
            if self.held > GROUP_WORDS:
                self.bags, self.held = {}, len(self.words[i])
            self.bags[i] = _bag(self.words[i])
        return self.bags[i]

    def links(self) -> list[tuple]:
        """Links (a, b, similarity) after which no two texts of one word that can be linked have different roots."""
        n, found = len(self.token), []
        start = np.flatnonzero(np.concatenate(([True], self.token[1:] != self.token[:-1])))
        left = np.repeat(np.append(start[1:], n), np.diff(np.append(start, n))) - np.arange(n)
        at, step = np.arange(n), 1
        while True:
            at = at[left[at] > step]
            if not len(at):
                return found
            some = at[self.fit(self.owner[at], self.owner[at + step])]
            for token, x, y in zip(self.token[some].tolist(), self.owner[some].tolist(), self.owner[some + step].tolist()):
                # a pair that shares several words is compared by the first of them alone, in whichever task that is
                if self.root[x] == self.root[y] or min(self.offered[x] & self.offered[y]) != token:
                    continue
                alike = _similarity(self.words[x], self.words[y], self.bag(x), self.bag(y))
                if alike is not None:
                    found.append((int(self.id[x]), int(self.id[y]), alike))
                    self.root[self.root == self.root[y]] = self.root[x]
            step += 1


def _linked_within(tasks: int) -> Callable[[pa.Table], pa.Table]:
    """Links between texts that offer the same word, of many words that each few texts offer."""

    def compare(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_of_links(_Held(table, tasks).links())])

    return compare


def _across_blocks(pairs: int) -> Callable[[pa.Table], pa.Table]:
    """Pairs of texts that offer one word, of a block of them or of two."""

    def compare(table: pa.Table) -> pa.Table:
        own = np.asarray(table.column("own"))
        order = np.argsort(own, kind="stable")
        texts, own = _Texts(table, order), own[order]
        n, found = len(own), []
        cut = int(np.searchsorted(own, own[-1])) if own[0] != own[-1] else 0
        for at in range(cut or n):
            others = np.arange(cut or at + 1, n)
            these = np.full(len(others), at)
            fits = texts.linkable(these, others)
            found.append((these[fits], others[fits]))
        x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        return texts.picked(x, y, pairs)

    return compare


def _rest(words: DataFrame, undone: DataFrame, roots: DataFrame, tested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links between ``undone`` texts of different roots that no candidate pair had yet, and the roots with them.

    Each text offers its buckets, or its rarest words, such that linked texts have one in
    common; below, either is a word. Words of which all texts have one root are done. The
    others are dealt over tasks, which get the texts that offer them, once each with its
    words, and find the links between those that offer the same one. The texts of a word
    that more than ``CROWD`` offer are dealt into blocks, and every two blocks meet in one
    task. These tasks pass on few pairs; where they left some out, roots are computed anew
    and the turn is repeated, until nothing that may be linked was left out between texts
    of different roots.
    """
    texts = session.materialize(_rarest(looked_up(words, undone, "id")), "rarest")
    offers = texts.select(F.explode("tokens").alias("token"), "id", "n_words", "root")
    sizes = offers.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"), F.min("root").alias("low"), F.max("root").alias("high"))
    sizes = session.materialize(sizes.where("low != high").drop("low", "high"), "sizes")
    crowded, shared = sizes.where(F.col("n") > CROWD), sizes.where(F.col("n") <= CROWD)
    offered, looks, sent = (n or 0 for n in shared.agg(F.sum("n"), F.sum(F.col("n") * F.col("n")), F.sum("words")).first())
    tasks = max(1, -(-offered // GROUP_ROWS), -(-looks // GROUP_PAIRS), -(-sent // GROUP_WORDS))
    few = offers.select("token", "id").join(shared, "token", "left_semi").groupBy("id").agg(F.collect_list("token").alias("tokens"))
    few = session.materialize(texts.select("id", "n_words", "root").join(few, "id"), "offers")
    dealt = looked_up(words, few, "id").withColumn("task", F.explode(F.array_distinct(F.transform("tokens", lambda t: F.pmod(t, F.lit(tasks))))))
    made = session.materialize(dealt.repartition(tasks, "task").groupBy("task").applyInArrow(_linked_within(tasks), _LINK), "links")
    roots = _grown(roots, made)
    tested, pairs = tested.select("a", "b"), FIRST_PAIRS
    while not crowded.isEmpty():
        texts = session.materialize(_rooted(texts.drop("root"), roots).select(*texts.columns), "rarest")
        large = texts.select(F.explode("tokens").alias("token"), "id", "n_words", "root", *_SIGNS).join(crowded, "token")
        large = large.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        large = session.materialize(large.withColumn("own", F.pmod(F.xxhash64("id", "token"), "blocks").cast("int")), "large")
        dealt = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        groups = dealt.groupBy("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        close = session.materialize(groups.applyInArrow(_across_blocks(pairs), _CLOSE), "close")
        fresh = close.where("not more").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
        fresh = session.materialize(fresh, "pairs")
        found = session.materialize(_verified(fresh, words), "links")
        roots, made = _grown(roots, found), made.union(found)
        cut = close.where("more").select("token").distinct()
        crowded = session.materialize(crowded.join(cut, "token", "left_semi"), "cut")
        tested, pairs = tested.union(fresh), pairs * MORE_PAIRS
    return made, roots


def _words_of(copy: DataFrame, wanted: DataFrame) -> DataFrame:
    """Words of the wanted rows as 32-bit hashes: id, words."""

    def work(batch: pa.RecordBatch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for low, high in slices([len(t) for t in texts], 1 << 19):
            words, ends = word_runs(texts[low:high])
            made = [w.tobytes() for w in np.split((words >> np.uint64(32)).astype(np.uint32), ends[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(low, high - low), pa.array(made, pa.binary())], names=["id", "words"])

    return over_batches(looked_up(copy.select("_row", "text"), wanted, "_row").select("id", "text"), "id long, words binary", work)


def _bag(words: np.ndarray) -> np.ndarray:
    """A text's words in the order of their values, told apart by how often they occurred before."""
    return np.sort(words.astype(np.uint64) << np.uint64(32) | _first_seen(words).astype(np.uint64))


def _similarity(x: np.ndarray, y: np.ndarray, bag_x: np.ndarray, bag_y: np.ndarray) -> float | None:
    """The similarity of two texts if they are linked. Words that only one has are an edit each, and are counted first."""
    longer = max(len(x), len(y))
    limit = int(longer * (1 - SIMILARITY) + 1e-9)
    at = np.minimum(np.searchsorted(bag_x, bag_y), len(bag_x) - 1)
    if longer - np.count_nonzero(bag_x[at] == bag_y) > limit:
        return None
    distance = within(x, y, limit)
    return None if distance is None else 1 - distance / longer


_LINK = "a long, b long, similarity double"


def _verified_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Links (a, b, similarity) among candidate pairs of which a text has few."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    words = looked_up(words, wanted, "id", "left_semi")
    left = words.select(F.col("id").alias("a"), F.col("words").alias("_x"))
    right = words.select(F.col("id").alias("b"), F.col("words").alias("_y"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for i, j, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "_x", "_y"))):
            x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            found.append((i, j, _similarity(x, y, _bag(x), _bag(y))))
        return _of_links(found)

    return over_batches(pairs.join(right, "b").join(left, "a"), _LINK, work)


def _of_links(found: list[tuple]) -> pa.RecordBatch:
    """Those of some compared pairs (a, b, similarity) that are linked."""
    linked = [f for f in found if f[2] is not None]
    columns = [pa.array([f[k] for f in linked], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity"])


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Links (a, b, similarity) among stored candidate pairs; a text is sent to a task once, not with each of its pairs.

    Texts are dealt into blocks, and the pairs of any two blocks are one task's.
    """
    n, texts = pairs.count(), pairs.select(F.explode(F.array("a", "b"))).distinct().count()
    # where a text has many pairs, most are told apart without an alignment, and larger blocks send it to fewer tasks
    blocks = max(1, int(np.sqrt(2 * n / (ALIGNED_PAIRS * max(1, min(8, n // max(1, texts)))))))
    own = [F.pmod(F.xxhash64(c), F.lit(blocks)) for c in ("a", "b")]
    tasks = blocks * (blocks + 1) // 2
    high = F.greatest(*own)
    dealt = pairs.withColumn("task", (F.floor(high * (high + 1) / 2) + F.least(*own)).cast("long"))
    wanted = dealt.select("task", F.col("a").alias("id")).union(dealt.select("task", "b")).distinct()
    parts = min(tasks, max(1, -(-n // ALIGNED_PAIRS)))
    texts = looked_up(words, wanted, "id").select(F.col("task").alias("of"), "id", "words").repartition(parts, "of")

    def align(some: pa.Table, theirs: pa.Table) -> pa.Table:
        held = {i: np.frombuffer(w, np.uint32) for i, w in zip(theirs.column("id").to_pylist(), theirs.column("words").to_pylist())}
        bags = {i: _bag(w) for i, w in held.items()}
        ends = zip(some.column("a").to_pylist(), some.column("b").to_pylist())
        return pa.Table.from_batches([_of_links([(i, j, _similarity(held[i], held[j], bags[i], bags[j])) for i, j in ends])])

    return dealt.repartition(parts, "task").groupBy("task").cogroup(texts.groupBy("of")).applyInArrow(align, _LINK)


class Classes:
    """What the search found: ``members`` (_row, doc_id, id, n_words, root) and ``links`` between text ids."""

    def __init__(self, copy: DataFrame, members: DataFrame, links: DataFrame):
        self.copy, self.members, self.links = copy, members, links


def _once(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Each text once, as its first row has it: id, n_words, sketch. Of sketches, those of other rows are left out where they are."""
    repeated = texts.where("n > 1").select("h1", "h2", "id")
    others = looked_up(rows.select("_row", "h1", "h2"), repeated, ["h1", "h2"]).where("_row != id").select("_row")
    once = looked_up(rows, session.materialize(others, "copies"), "_row", "left_anti")
    return once.select(F.col("_row").alias("id"), "n_words", "sketch")


def classes(docs: DataFrame) -> Classes:
    """Near-duplicate classes of all rows of ``docs`` (``doc_id``, ``text``, any other columns).

    Null and empty texts have no words, and all texts without words are equal. Texts of
    fewer than five words are near-duplicates only of equal ones. A null or repeated
    doc_id does no harm: rows are told apart by their place in a stored copy.
    """
    copy = numbered_copy(docs, "documents")
    rows = session.materialize(_sketched(copy), "sketches")
    texts = session.materialize(rows.groupBy("h1", "h2").agg(F.min("_row").alias("id"), F.count(F.lit(1)).alias("n")), "texts")
    links, roots = _links(copy, _once(rows, texts))
    links = session.materialize(links, "all-links")
    rooted = texts.select("h1", "h2", "id").join(roots, "id", "left").select("h1", "h2", "id", F.coalesce("root", "id").alias("root"))
    members = rows.select("_row", "doc_id", "h1", "h2", "n_words").join(rooted, ["h1", "h2"]).drop("h1", "h2")
    return Classes(copy, session.materialize(members, "members"), links)


def class_of(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the class's smallest doc_id), n_words, n_found_links.

    n_found_links counts the links of the row's text that were needed to find its class;
    two texts that are in one class already are not always compared.
    """
    found = classes(docs.select("doc_id", "text"))
    # stored, so that the join is between two plain shuffles and a large class can be split
    names = session.materialize(found.members.groupBy("root").agg(F.min("doc_id").alias("class_id")), "names")
    ends = found.links.select(F.col("a").alias("id")).union(found.links.select("b"))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("_links"))
    named = found.members.join(names, "root").join(degree, "id", "left")
    return named.select("doc_id", "class_id", "n_words", F.coalesce("_links", F.lit(0)).cast("long").alias("n_found_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of each class, that with the smallest doc_id (nulls last)."""
    docs, back = set_aside(docs, ("_row",))
    found = classes(docs)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = found.members.groupBy("root").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    first = session.materialize(first, "firsts")
    others = found.members.join(first, "root").where("_row != _first._row").select("_row")
    left = looked_up(found.copy, session.materialize(others, "others"), "_row", "left_anti")
    return left.drop("_row").withColumnsRenamed(back)
