"""A Merkle manifest of a table: digests of rows, of groups of rows and of the whole, with proofs.

Rows are leaves. The leaves of a group (of documents: a language) stand in order, and
every ``FANOUT`` neighbours have a parent until one node, the group's root, is left; the
roots of all groups are the leaves of one more tree. A row's proof are the siblings met
on its way up, and anybody who has the row, its proof and its places can compute the root.

A level is no table of its own. Rows are cut into chunks of ``FANOUT ** LEVELS``
neighbours; within a chunk a node of level j is held by its first row, so its siblings
are ``FANOUT ** j`` rows away: lag and lead columns with that offset, masked by the
node's slot and the length of its run. First children hash their run and go up. Lag
columns with the same offsets then hand each node's proof down to its children. All
levels of a pass share one shuffle and one sort; the tops of the chunks are the next
pass, of which there are as many as a logarithm of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridtally import session

#: Children of a node, and levels that are climbed within one chunk of rows.
FANOUT, LEVELS = 2, 8
#: Letters of a digest.
DIGITS = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _written(value: Column) -> Column:
    """A value such that neighbours cannot run into each other: its length in bytes, then itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row's values."""
    return F.sha2(F.concat(*[_written(v) for v in values]), 256)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``p``, their place in their ``grp`` in ascending ``order``, and ``n``, the group's size.

    Rows are dealt by ranges of (grp, order) and sorted there. A group's first place in a
    partition is the sum of its rows in the partitions before: a row per partition and group.
    """
    by = ["grp", *order]
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    stored = session.materialize(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "places")
    stored = stored.withColumn("part", F.shiftright("at", 33))
    counts = stored.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first"))
    group = Window.partitionBy("grp")
    earlier = F.sum("here").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("here")
    known = counts.select(F.col("part").alias("part_"), F.col("grp").alias("grp_"), (earlier - F.col("first")).alias("shift"), F.sum("here").over(group).alias("n"))
    known = session.materialize(known, "places-of-groups")
    same = (F.col("part") == F.col("part_")) & F.col("grp").eqNullSafe(F.col("grp_"))
    return stored.join(known, same).withColumn("p", F.col("at") + F.col("shift")).drop("at", "part", "part_", "grp_", "shift")


def _climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` with ``h`` of chunks' first rows replaced by the chunk's top, and ``up``, the siblings to there, lowest first."""
    p, n, h = F.col("p"), F.col("n"), F.col("h")
    chunk = Window.partitionBy("grp", "chunk").orderBy("p")
    nodes = nodes.withColumn("chunk", F.expr(f"p div {fanout**LEVELS}"))
    slots, heads = [], []
    for level in range(levels):
        stride = fanout**level
        node = F.expr(f"p div {stride}")
        count = F.expr(f"(n + {stride - 1}) div {stride}")
        slot = node % fanout
        run = F.least(F.lit(fanout).cast("long"), count - (node - slot))
        head = p % stride == 0
        beside = [
            F.when(head & (slot + d >= 0) & (slot + d < run), F.lead(h, d * stride).over(chunk) if d > 0 else F.lag(h, -d * stride).over(chunk))
            for d in range(1 - fanout, fanout)
            if d
        ]
        nodes = nodes.withColumn(f"s{level}", F.concat_ws("", *beside))
        parent = F.sha2(F.concat(h, F.col(f"s{level}")), 256)
        nodes = nodes.withColumn("h", F.when(head & (slot == 0) & (count > 1), parent).otherwise(h))
        slots.append(slot)
        heads.append(head)
    nodes = nodes.withColumn("up", F.when(p % fanout**LEVELS == 0, F.lit("")))
    for level in reversed(range(levels)):
        stride = fanout**level
        above = F.col("up")
        for d in range(1, fanout):
            above = F.when(slots[level] == d, F.lag("up", d * stride).over(chunk)).otherwise(above)
        nodes = nodes.withColumn("above", above)
        nodes = nodes.withColumn("up", F.when(heads[level], F.concat(F.col(f"s{level}"), F.col("above"))).otherwise(F.col("up")))
    return nodes.drop("above", "chunk", *[f"s{level}" for level in range(levels)])


def _forest(leaves: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """What each pass found, lowest first, and the root of each group (grp, n, h)."""
    passes: list[DataFrame] = []
    size = fanout**LEVELS
    nodes, most = leaves, leaves.agg(F.max("n")).first()[0] or 0
    while True:
        levels = next(level for level in range(LEVELS + 1) if fanout**level >= most or level == LEVELS)
        climbed = session.materialize(_climb(nodes, fanout, levels), "climbed")
        passes.append(climbed)
        tops = climbed.where(F.col("p") % size == 0)
        nodes = tops.select("grp", F.expr(f"p div {size}").alias("p"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), "h")
        most = -(-most // size)
        if most <= 1:
            return passes, nodes.drop("p", "n")


def _proved(passes: list[DataFrame], roots: DataFrame, fanout: int) -> DataFrame:
    """The lowest pass's rows with the proof up to what ``roots`` (grp, up, any other columns) say of their group."""
    above = roots.withColumn("p", F.lit(0).cast("long"))
    for nth, climbed in enumerate(reversed(passes)):
        if nth:
            above = session.materialize(above, "proofs")  # a table of known size, so that Catalyst can choose the join
        above = above.withColumnsRenamed({"grp": "grp_", "p": "p_", "up": "up_"})
        same = F.col("grp").eqNullSafe(F.col("grp_")) & (F.expr(f"p div {fanout**LEVELS}") == F.col("p_"))
        rows = climbed if nth == len(passes) - 1 else climbed.drop("n", "h")
        above = rows.join(above, same).withColumn("up", F.concat("up", "up_")).drop("grp_", "p_", "up_")
    return above


def fold(start: Column, proof: str, places: Sequence[tuple[str, str]], fanout: int = FANOUT) -> Column:
    """The root that a leaf's digest leads to by a proof, given (place, size) column names of each tree, lowest first."""
    state = F.struct(start.alias("h"), F.lit(1).alias("at"))
    for p, n in places:
        # no tree has more levels than its size has bits
        state = F.aggregate(F.sequence(F.lit(0), F.length(F.bin(n))), state, _rise(proof, F.col(p), F.col(n), fanout))
    return state["h"]


def _rise(proof: str, p: Column, n: Column, fanout: int) -> Callable[[Column, Column], Column]:
    """One level of a fold: the state holds the digest so far and where in the proof the level's siblings begin."""

    def rise(state: Column, level: Column) -> Column:
        stride = F.pow(F.lit(float(fanout)), level.cast("double")).cast("long")
        node, last = F.call_function("div", p, stride), F.call_function("div", n - 1, stride)
        slot = (node % fanout).cast("int")
        run = F.least(F.lit(fanout), (last - node + slot + 1).cast("int"))
        left = F.substring(proof, state["at"], slot * DIGITS)
        right = F.substring(proof, state["at"] + slot * DIGITS, (run - 1 - slot) * DIGITS)
        risen = F.struct(F.sha2(F.concat(left, state["h"], right), 256).alias("h"), (state["at"] + (run - 1) * DIGITS).alias("at"))
        return F.when(last > 0, risen).otherwise(state)

    return rise


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", claims: dict[str, Column] | None = None, fanout: int = FANOUT
) -> DataFrame:
    """One row per row of ``docs``: its digest, places, proof, and the roots of its group and of the table.

    ``fields`` are hashed, in this order. Groups are ordered by their UTF-8 bytes, null
    first; rows of a group by ``order``, null first, then by digest, so that repeated rows
    are neighbours and which of them is first makes no difference. ``claims`` are further
    columns computed from ``docs`` and carried along. Other columns are not read.

    Returns ``order``, ``group``, the claims, leaf, place and count (in the group),
    group_place and group_count, proof (the siblings' digests in a row, lowest level
    first, left to right), subroot and root. No rows have no root: the result is empty.
    A group of one row has that row's digest as its root, a table of one group that
    group's root. Null values are told from empty ones.
    """
    claims = claims or {}
    carried = {f"claim_{i}": column for i, column in enumerate(claims.values())}
    slim = docs.select(F.col(group).cast("string").alias("grp"), F.col(order).alias("o"), leaf([F.col(f) for f in fields]).alias("h"), *[c.alias(a) for a, c in carried.items()])
    # the last order column only keeps very many equal rows from being one range
    slim = session.materialize(slim.withColumn("u", F.monotonically_increasing_id()), "leaves")
    leaves = session.materialize(_placed(slim, ["o", "h", "u"]).drop("u").withColumn("leaf", F.col("h")), "leaves")
    passes, roots = _forest(leaves, fanout)
    named = roots.select(F.lit("").alias("grp"), F.col("grp").alias("o"), "h", F.col("h").alias("subroot"))
    groups = session.materialize(_placed(named, ["o"]), "groups")
    group_passes, top = _forest(groups, fanout)
    whole = top.select("grp", F.lit("").alias("up"), F.col("h").alias("root"))
    above = _proved(group_passes, whole, fanout).select(
        F.col("o").alias("grp"), "up", "subroot", "root", F.col("p").alias("group_place"), F.col("n").alias("group_count")
    )
    proved = _proved(passes, session.materialize(above, "roots"), fanout)
    kept = [F.col(a).alias(name) for a, name in zip(carried, claims)]
    return proved.select(
        F.col("o").alias(order), F.col("grp").alias(group), *kept, "leaf", F.col("p").alias("place"), F.col("n").alias("count"),
        "group_place", "group_count", F.col("up").alias("proof"), "subroot", "root",
    )


PLACES = (("place", "count"), ("group_place", "group_count"))
