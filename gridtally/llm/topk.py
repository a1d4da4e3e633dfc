"""Exact top-k by inner product from an impact-ordered index, score at a time.

Components become integers floor(64 x). The rows are dealt into blocks, and a block's
index holds postings: for each component the rows in which it is not zero and its value
there, in segments by quantised impact, the size of the value. A query's scores grow
segment by segment, largest impacts first. What a row's smaller values can still add is at
most the length of that rest times the query's length in the same components, and at most
the largest value left times the sum of the query's. The k-th best lower bound, or the k-th best score that another
block found, is a proof against every row whose upper bound stays below it. A query stops
reading once scoring the rows that may be members exactly costs no more than reading on.
The best of all blocks together are the answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally import session

#: Vectors of an index block, queries that go through it together, and such query
#: blocks that one task takes through it, about.
BLOCK_ROWS, QUERY_ROWS, QUERY_BLOCKS = 8192, 256, 4
SCALE = 64


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and integer components of the vectors that take part.

    A row with a null vec_id, a null or empty vector, or a null or non-finite component
    takes no part.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    values = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    usable = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    return usable.where(F.coalesce(finite, F.lit(False))).select("vec_id", values.alias("v"))


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """Vectors of each block as one row: block, ids, dims, values."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        lists = table.column("v").combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        dims = int(sizes.max())
        matrix = np.zeros((len(ids), dims), np.int64)  # shorter vectors end in zeros
        matrix[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        made = [[table.column("block")[0].as_py()], [ids[order].tobytes()], [dims], [matrix[order].astype(_kind(matrix)).tobytes()]]
        kinds = (pa.int32(), pa.binary(), pa.int32(), pa.binary())
        return pa.Table.from_arrays([pa.array(m, k) for m, k in zip(made, kinds)], names=["block", "ids", "dims", "vals"])

    return dealt.groupBy("block").applyInArrow(pack, "block int, ids binary, dims int, vals binary")


def _kind(matrix: np.ndarray):
    """The smallest integer type for a block's values."""
    top = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))
    return np.int8 if top < 1 << 7 else np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64


def _matrix(ids: bytes, dims: int, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    size = len(values) // max(1, len(ids) * dims)
    return ids, np.frombuffer(values, f"<i{size}").reshape(len(ids), dims).astype(np.int64)


def _float(queries: np.ndarray, rows: np.ndarray):
    """A float type in which every partial sum of the products is exact, or None."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else None


#: Edges of neighbouring impact bands differ by this factor.
FINER = 2**0.25
#: What bounds are raised by, as they are computed in rounded numbers.
ROUNDED = 1 + 1e-9


class Index:
    """One block's postings in bands of falling impact, each by component.

    ``read`` counts the postings that queries took, ``total`` what reading all would have
    taken, ``scored`` the components of rows that were scored exactly instead.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.read = self.total = self.scored = 0
        size = np.abs(rows)
        row, dim = np.nonzero(rows)
        edges, top = [], int(size.max(initial=0)) + 1
        while top > 1:  # least impact of each band
            top = max(1, min(top - 1, int(np.ceil(top / FINER))))
            edges.append(top)
        band = np.searchsorted(-np.array(edges or [1]), -size[row, dim])
        order = np.lexsort((row, dim, band))
        self.row, dim, band = row[order], dim[order], band[order]
        self.value = rows[self.row, dim]
        cuts = np.flatnonzero(np.concatenate(([True], (dim[1:] != dim[:-1]) | (band[1:] != band[:-1])))) if len(dim) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(dim))
        #: per band: its lists (component, first, after the last), the largest impact after it, and the length of each row's rest
        self.bands = []
        rest = (size.astype(float) ** 2).sum(axis=1)
        for n, least in enumerate(edges):
            lists = [(int(dim[c]), int(c), int(e)) for c, e in zip(cuts, ends) if band[c] == n]
            at = slice(lists[0][1], lists[-1][2]) if lists else slice(0, 0)
            rest = rest - np.bincount(self.row[at], self.value[at].astype(float) ** 2, len(ids))
            if lists:
                self.bands.append((lists, least - 1, np.sqrt(np.maximum(rest, 0)) * ROUNDED))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores that may be among each query's best ``k``; ``known`` are scores that each query's k-th best is at least."""
        kind = _float(queries, self.rows)
        if kind is None:  # too large for exact float sums
            score = queries.astype(object) @ self.rows.T.astype(object)
            return [self._best(np.arange(len(self.ids)), score[i].astype(np.int64), q, k) for i, q in enumerate(query_ids)]
        known = np.full(len(queries), -np.inf) if known is None else known
        weight, reach, squares = queries.T.astype(kind), np.abs(queries).sum(axis=1).astype(float), queries.T.astype(float) ** 2
        active, found = np.arange(len(queries)), [None] * len(queries)
        score = np.zeros((len(self.ids), len(queries)), kind)
        own = self.ids[:, None] == query_ids[None, :]
        postings, seen = len(self.row), 0
        self.total += postings * len(queries)
        for lists, below, rest in self.bands:
            for dim, low, high in lists:
                score[self.row[low:high]] += self.value[low:high, None].astype(kind) * weight[dim, active][None, :]
            seen += lists[-1][2] - lists[0][1]
            self.read += (lists[-1][2] - lists[0][1]) * len(active)
            if 2 * seen < postings or below == 0:
                continue  # too little is known for a proof, or everything is
            unread = (np.abs(self.rows) <= below).astype(float)  # the components of each row that are left
            slack = np.minimum(rest[:, None] * np.sqrt(unread @ squares[:, active]), below * reach[active][None, :])
            proof = known[active]
            if len(self.ids) > k:
                lower = np.where(own[:, active], -np.inf, score - slack)
                proof = np.maximum(proof, np.partition(lower, len(self.ids) - k, axis=0)[len(self.ids) - k])
            possible = (score + slack >= proof[None, :]) & ~own[:, active]
            done = possible.sum(axis=0) * self.rows.shape[1] <= postings - seen
            for n in np.flatnonzero(done):
                at = np.flatnonzero(possible[:, n])
                self.scored += len(at) * self.rows.shape[1]
                found[active[n]] = self._best(at, self.rows[at] @ queries[active[n]], query_ids[active[n]], k)
            active, score = active[~done], score[:, ~done]
            if not len(active):
                return found
        for n, query in enumerate(active):
            found[query] = self._best(np.arange(len(self.ids)), score[:, n].astype(np.int64), query_ids[query], k)
        return found

    def _best(self, at: np.ndarray, score: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        other = self.ids[at] != query_id
        at, score = at[other], score[other]
        best = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[best]], score[best]


def top_k(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Each query's ``k`` highest integer inner products: query_id, rank, vec_id, score.

    Reads ``vec_id`` and ``embedding``. Queries are the rows whose vec_id is divisible by
    ``every``, candidates all rows but those with the query's own id; ties go to the
    smaller vec_id. Shorter vectors count as ending in zeros. Of rows with one vec_id
    each is a candidate, and as queries equal rows are one query.
    """
    rows = session.materialize(quantised(vectors), "vectors")
    total = rows.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    index = session.materialize(_packed(rows, blocks), "index")
    queries = _packed(asked, max(1, -(-total // (every * QUERY_ROWS))))
    queries = queries.select(F.col("block").alias("part"), F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"), F.col("vals").alias("q_vals"))
    # every block of queries meets every block of rows once
    parts = max(1, -(-total // (every * QUERY_ROWS)))
    turns = -(-parts // QUERY_BLOCKS)
    sent = queries.withColumn("turn", F.expr(f"part div {QUERY_BLOCKS}").cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    there = index.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))

    schema = "query_id long, part int, number int, vec_id long, score long"

    def best(blocks: DataFrame, asked: DataFrame) -> DataFrame:
        pairs = blocks.groupBy("block", "turn").cogroup(asked.groupBy("block", "turn"))
        found = pairs.applyInArrow(_searcher(k), schema)
        # number tells apart queries that share an id
        place = F.row_number().over(Window.partitionBy("query_id", "part", "number").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", place).where(F.col("rank") <= k)

    # one block first: what it finds is a bound that every other block starts from
    first = session.materialize(best(there.where("block = 0"), sent.where("block = 0").withColumn("known", F.lit(None).cast("array<struct<number: int, score: long>>"))), "first")
    if blocks == 1:
        return first.select("query_id", "rank", "vec_id", "score")
    bounds = first.where(F.col("rank") == k).groupBy("part").agg(F.collect_list(F.struct("number", "score")).alias("known"))
    bounds = session.materialize(bounds, "bounds")  # at most QUERY_ROWS, about, a part
    others = best(there.where("block > 0"), sent.where("block > 0").join(bounds, "part", "left"))
    place = F.row_number().over(Window.partitionBy("query_id", "part", "number").orderBy(F.desc("score"), "vec_id"))
    both = first.unionByName(others).withColumn("rank", place).where(F.col("rank") <= k)
    return both.select("query_id", "rank", "vec_id", "score")


def _searcher(k: int):
    """Search of one block of rows for the queries of some parts."""

    def search(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        made = [[] for _ in range(5)]
        for r in ours.to_pylist():
            ids, rows = _matrix(r["ids"], r["dims"], r["vals"])
            held: dict[int, Index] = {}
            for t in theirs.to_pylist():
                q_ids, q = _matrix(t["q_ids"], t["q_dims"], t["q_vals"])
                known = np.full(len(q_ids), -np.inf)
                for bound in t["known"] or []:
                    known[bound["number"]] = bound["score"]
                dims = max(q.shape[1], rows.shape[1])
                if dims not in held:
                    held = {dims: Index(ids, np.pad(rows, ((0, 0), (0, dims - rows.shape[1]))))}
                found = held[dims].search(q_ids, np.pad(q, ((0, 0), (0, dims - q.shape[1]))), k, known)
                number = np.repeat(np.arange(len(q_ids)), [len(i) for i, _ in found])
                best = [np.concatenate(x) for x in zip(*found)]
                for to, column in zip(made, (q_ids[number], np.full(len(number), t["part"]), number, *best)):
                    to.append(column)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array(np.concatenate(c) if c else [], kind) for c, kind in zip(made, kinds)]
        return pa.Table.from_arrays(columns, names=["query_id", "part", "number", "vec_id", "score"])

    return search
