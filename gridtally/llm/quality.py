"""Document quality from learned subword embeddings.

Words, word pairs and character 3- and 4-grams of a text are hashed to buckets, each bucket
has a learned vector, the mean vector of a document goes through a softmax layer.
Vectors and layer are trained together by stochastic gradient descent in numpy on a
bounded sample of labelled rows. As the layer is linear, a trained model scores a
bucket once, and a document's score is the sigmoid of a mean over its features.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally.llm.common import beside_text, over_batches, text_bytes

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
#: Labelled rows that the model is fitted on, at most, those with the lowest id hashes.
SAMPLE_ROWS = 3000
#: Bytes of text hashed at once; small enough for a processor's cache.
STEP = 1 << 18

#: Bytes between texts: n-grams begin at the first half and end before the next text.
_GAP = b"\n" * 6
_M = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F)]
_SHIFT = np.uint32(32 - BUCKET_BITS)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    base = int(_M[0])
    size = 2 * STEP + len(_GAP)
    up = np.cumprod(np.full(size, base, np.uint32), dtype=np.uint32)
    return up, np.cumprod(np.full(size, pow(base, -1, 1 << 32), np.uint32), dtype=np.uint32)


_UP, _DOWN = _powers()


def _chunks(text: bytes):
    """A long text in parts that end at a blank where there is one."""
    at = 0
    while len(text) - at > STEP:
        cut = max(text.rfind(b" ", at, at + STEP), text.rfind(b"\n", at, at + STEP)) + 1
        cut = cut if cut > at else at + STEP
        yield text[at:cut]
        at = cut
    yield text[at:]


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the features of some texts, by kind, each with the bounds of every text's share.

    Kinds: character 3-grams and 4-grams (as bytes), words, pairs of words. The texts
    together hold at most 2 * STEP bytes.
    """
    joined = _GAP.join(texts) + _GAP
    flat = np.frombuffer(joined, np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(lengths + len(_GAP)) - lengths - len(_GAP)
    bounds = np.stack([start, start + lengths + 3], axis=1)
    code = flat.astype(np.uint32)
    three = code[:-3] << np.uint32(16) | code[1:-2] << np.uint32(8) | code[2:-1]
    four = three << np.uint32(8) | code[3:]
    made = [((three * _M[0]) >> _SHIFT, bounds), ((four * _M[1]) >> _SHIFT, bounds)]
    # words: a polynomial over their bytes, from running sums
    blank = np.concatenate(([True], flat <= 0x20, [True]))
    turn = np.flatnonzero(blank[1:] != blank[:-1])
    begin, end = turn[::2], turn[1::2]
    sums = np.concatenate((np.zeros(1, np.uint32), np.cumsum((code + _M[2]) * _at(_UP, len(code)), dtype=np.uint32)))
    word = (sums[end] - sums[begin]) * _at(_DOWN, len(code))[begin] if len(begin) else np.zeros(0, np.uint32)
    word = (word ^ word >> np.uint32(15)) * _M[2]
    first, last = np.searchsorted(begin, start), np.searchsorted(begin, start + lengths)
    made.append((word >> _SHIFT, np.stack([first, last], axis=1)))
    # a word that stands twice in a row makes one pair, whichever word it is
    pair = np.where(word[1:] == word[:-1], np.uint32(0), (word[:-1] * _M[3] + word[1:]) * _M[1] >> _SHIFT)
    made.append((pair, np.stack([first, np.maximum(first, last - 1)], axis=1)))
    return made


def _at(powers: np.ndarray, size: int) -> np.ndarray:
    return powers[:size] if size <= len(powers) else np.resize(powers, size)


def _steps(texts: list[bytes]):
    """Parts of the texts in groups of at most STEP bytes: (text numbers, parts)."""
    numbers, parts, total = [], [], 0
    for i, text in enumerate(texts):
        for part in _chunks(text):
            if parts and total + len(part) + len(_GAP) > STEP:
                yield numbers, parts
                numbers, parts, total = [], [], 0
            numbers.append(i)
            parts.append(part)
            total += len(part) + len(_GAP)
    if parts:
        yield numbers, parts


def _sparse(text: bytes) -> tuple[bytes, bytes]:
    """A document's buckets and the share of its features in each."""
    total = np.zeros(BUCKETS, np.int64)
    for part in _chunks(text):
        for buckets, bounds in features([part]):
            total += np.bincount(buckets[slice(*bounds[0])], minlength=BUCKETS)
    at = total.nonzero()[0]
    return at.astype(np.uint16).tobytes(), (total[at] / max(1, total.sum())).astype(np.float32).tobytes()


def _chosen(labels: DataFrame, label: str, use: Column, rows: int) -> DataFrame:
    """``rows`` labelled ids at most: doc_id, label. A doc_id with several labels counts with the largest, one without id not at all."""
    return (
        labels.where(use & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def _labelled(docs: DataFrame, labels: DataFrame, label: str, use: Column, rows: int) -> DataFrame:
    """All documents of the chosen ids: doc_id, label, text, and the hash that orders them."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # the ids are bounded by ``rows``
    joined = texts.join(F.broadcast(_chosen(labels, label, use, rows)), "doc_id")
    return joined.select("doc_id", "label", "text", F.xxhash64("doc_id", "text").alias("place"))


def sample(docs: DataFrame, labels: DataFrame, label: str, use: Column, rows: int) -> DataFrame:
    """Labelled documents to learn from, ``rows`` at most: doc_id, label, text.

    Rows are taken in the order of a hash of their id, so the choice does not depend
    on the layout of the tables.
    """
    return _labelled(docs, labels, label, use, rows).orderBy("place", "doc_id").limit(rows).drop("place")


class Model:
    """Score of each bucket, and the bias."""

    def __init__(self, buckets: np.ndarray, bias: float):
        self.buckets, self.bias = buckets, bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for numbers, parts in _steps(texts):
            numbers = np.array(numbers)
            for buckets, bounds in features(parts):
                values = np.append(self.buckets[buckets], np.float32(0))
                sums = np.add.reduceat(values, np.minimum(bounds.ravel(), len(values) - 1))[::2]
                size = bounds[:, 1] - bounds[:, 0]
                # reduceat gives one value where a range is empty
                np.add.at(total, numbers, np.where(size > 0, sums, 0))
                np.add.at(count, numbers, size)
        logits = np.clip(self.bias + total / np.maximum(1, count), -30, 30)
        return 1 / (1 + np.exp(-logits))


def train(rows: list[tuple[int, bytes, bytes]], epochs: int = 6, rate: float = 0.5, seed: int = 1) -> Model:
    """Fit on (label, buckets, shares) of some documents.

    Both labels weigh the same in total. Without rows of both labels the score is
    the share of rows with label 1, or 0.5.
    """
    y = np.array([r[0] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    weight = (0.5 / np.array([np.mean(y == 0), np.mean(y == 1)]))[y]
    at = [np.frombuffer(r[1], np.uint16) for r in rows]
    share = [np.frombuffer(r[2], np.float32) for r in rows]
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            speed = rate * (1 - step / steps) * weight[i]
            step += 1
            own = vectors[at[i]]
            mean = share[i] @ own
            logit = mean @ layer + bias
            odds = np.exp(logit - logit.max())
            wrong = odds / odds.sum()
            wrong[y[i]] -= 1
            down = layer @ wrong
            layer -= speed * np.outer(mean, wrong)
            bias -= speed * wrong
            # shares are small, so a vector moves by its share relative to the mean share
            vectors[at[i]] = own - (speed * SCALE) * np.outer(share[i], down)
    side = (layer[:, 1] - layer[:, 0]).astype(np.float32)
    return Model(vectors @ side, float(bias[1] - bias[0]))


#: How much faster bucket vectors learn than the layer, as each has a small share.
SCALE = 40.0


def fit(docs: DataFrame, labels: DataFrame, use: Column, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``rows`` labelled documents for which ``use`` holds.

    Features are computed where the texts are; one task gets those of the sampled rows, at
    most BUCKETS shares of six bytes each, and fits the model, which alone reaches the driver.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [_sparse(t) for t in text_bytes(batch.column("text"))]
        columns = [*(batch.column(c) for c in ("doc_id", "label", "place")), *(pa.array(c, pa.binary()) for c in zip(*made))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "place", "at", "share"])

    def learn(batches):
        found = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "at", "share")))]
        found.sort(key=lambda r: (str(r[0]), zlib.crc32(r[2])))
        model = train([r[1:] for r in found])
        yield pa.RecordBatch.from_arrays([pa.array([model.buckets.astype(np.float32).tobytes()], pa.binary()), pa.array([model.bias])], names=["buckets", "bias"])

    texts = _labelled(docs, labels, label, use, rows).select("doc_id", "label", "place", "text")
    schema = StructType(texts.schema.fields[:3] + StructType.fromDDL("at binary, share binary").fields)
    chosen = over_batches(texts, schema, work).orderBy("place", "doc_id").limit(rows)
    made = chosen.select("doc_id", "label", "at", "share").coalesce(1).mapInArrow(learn, "buckets binary, bias double").first()
    return train([]) if made is None else Model(np.frombuffer(made["buckets"], np.float32), made["bias"])


def score(docs: DataFrame, model: Model, keep: tuple = ("doc_id",), threshold: float = 0.3) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` of every whole text, beside the ``keep`` columns.

    A null or empty text has no features and gets the bias alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket
    chosen, text = beside_text(docs, keep)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.score(text_bytes(batch.column(text)))
        columns = [pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32))]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + columns, names=[*keep, "score", "predicted"])

    schema = StructType(chosen.schema.fields[: len(keep)] + StructType.fromDDL("score double, predicted int").fields)
    return over_batches(chosen, schema, work)
