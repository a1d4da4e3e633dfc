"""Spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary's acceptor is composed with a transducer that makes exactly one edit, and
with the acceptor again; the accepted pairs are the near words. The transducer copies,
edits once at the first place where both words differ, and copies on, so each pair has
one path. As the longer word of a pair is read first, its edits are a replaced or a
deleted letter.

The composition is split by where it begins. Cut the places of an edit in a word of M
letters into ranges: a pair whose edit lies in the range [lo, hi) agrees in the lo letters
before it and in the M - hi letters after it. Each such agreement is an initial state of
the machine that reads the letters between; initial states are dealt over tasks, and the
states of one task are one minimised acceptor, of which each pair of states is composed
once, however many words lead there. Ranges are halves of a word at first; where very many
words share an initial state, its range is halved until it is one letter, and the words
that agree in all others are no more than the alphabet has letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import session
from gridtally.llm.sharding import number_rows

#: Code points of the shortest word, and occurrences of the rarest one.
SHORTEST, RAREST = 6, 5
#: A word's form is at least so many times as common.
FORM_TIMES = 5
#: One of so many runs loses a letter.
DAMAGED = 199
#: Letters between that one initial state, and one Python group, may have.
GROUP_LETTERS = 200_000
#: The longest range of edit places; words whose keys are longer than ``KEY`` letters are keyed by a digest.
RANGE, KEY = 64, 256
#: Ends of the longer and of the shorter words in a machine, and of longer words that go on after the range; no word has them.
LONG, SHORT, OPEN = "\x01", "\x02", "\x03"
_ENDS = {LONG, SHORT, OPEN}
_SAME, _ONE_LESS = 0, 1
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST, damaged: int = DAMAGED) -> DataFrame:
    """The vocabulary: ``word`` and ``n``, its occurrences in all texts.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF with A-Z lowered,
    where one of ``damaged`` runs, chosen by the crc32 of its doc_id and itself, lost a
    code point. A null doc_id counts as an empty one there.
    """
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{shortest},}})"), 1)
    rows = docs.select("doc_id", F.explode(runs).alias("run")).withColumn("run", F.translate("run", _UPPER, _UPPER.lower()))
    crc = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    rows = rows.withColumn("h", crc).withColumn("size", F.char_length("run"))
    at = (F.col("h") % F.col("size")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("h") % damaged == 0, less).otherwise(F.col("run"))
    kept = F.when(F.col("h") % damaged == 0, F.col("size") - 1).otherwise(F.col("size")) >= shortest
    return rows.where(kept).groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= rarest)


class Acceptor:
    """A minimised acceptor of sorted distinct strings for each of several initial states, all sharing their states.

    ``arcs`` maps each state's letters to (state, how many of the state's strings come
    before), so a path is the number of its string.
    """

    def __init__(self):
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.count = [1]
        self._known: dict[tuple, int] = {(): 0}
        self._pairs: dict[int, list[tuple[int, int]]] = {0: []}
        self._common: dict[tuple[int, int, int], list[tuple[int, int]]] = {}

    def add(self, strings: list[str]) -> int:
        """The initial state that accepts ``strings``, all of which have an end."""
        return self._state(strings, 0, len(strings), 0)

    def _state(self, strings: list[str], low: int, high: int, depth: int) -> int:
        if len(strings[low]) == depth:
            return 0
        found, at = [], low
        while at < high:
            letter, end = strings[at][depth], at + 1
            while end < high and strings[end][depth] == letter:
                end += 1
            found.append((letter, self._state(strings, at, end, depth + 1)))
            at = end
        key = tuple(found)
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            arcs, before = {}, 0
            for letter, target in found:
                arcs[letter] = (target, before)
                before += self.count[target]
            self.arcs.append(arcs)
            self.count.append(before)
        return state

    def common(self, one: int, other: int, kind: int) -> list[tuple[int, int]]:
        """Numbers of the strings that two states have in common, after the edit.

        ``_SAME``: both belong to longer words; ``_ONE_LESS``: the other one to a shorter word.
        """
        key = (one, other, kind)
        made = self._common.get(key)
        if made is None:
            made = []
            theirs = self.arcs[other]
            for letter, (target, before) in self.arcs[one].items():
                if letter in (LONG, OPEN):
                    end = theirs.get(letter if kind == _SAME else SHORT)
                    if end is not None:
                        made.append((before, end[1]))
                elif letter != SHORT:
                    arc = theirs.get(letter)
                    if arc is not None:
                        made += [(i + before, j + arc[1]) for i, j in self.common(target, arc[0], kind)]
            self._common[key] = made
        return made

    def pairs(self, state: int) -> list[tuple[int, int]]:
        """Numbers of the state's strings that are one edit apart, the longer one first."""
        made = self._pairs.get(state)
        if made is not None:
            return made
        made = []
        arcs = self.arcs[state]
        letters = [(letter, *arc) for letter, arc in arcs.items() if letter not in _ENDS]
        for nth, (letter, target, before) in enumerate(letters):
            made += [(i + before, j + before) for i, j in self.pairs(target)]  # no edit yet
            for _, other, later in letters[nth + 1 :]:  # replaced here
                made += [(i + before, j + later) for i, j in self.common(target, other, _SAME)]
            # deleted here, and the shorter word goes on with another letter
            ours = self.arcs[target]
            for further, other, there in letters:
                if further != letter and further in ours:
                    mine, skipped = ours[further]
                    made += [(before + skipped + i, j + there) for i, j in self.common(mine, other, _ONE_LESS)]
            if LONG in ours and SHORT in arcs:
                made.append((before + ours[LONG][1], arcs[SHORT][1]))
        self._pairs[state] = made
        return made


def near_pairs(rows: list[tuple]) -> Iterator[tuple[int, int]]:
    """Places in ``rows`` (initial state as any tuple, then the string between), sorted, that are one edit apart."""
    machine, low = Acceptor(), 0
    for _, members in groupby(rows, key=lambda r: r[:-1]):
        strings = [r[-1] for r in members]
        if len(strings) > 1:
            for i, j in machine.pairs(machine.add(strings)):
                yield low + i, low + j
        low += len(strings)


def _begun(vocabulary: DataFrame, parts: Column) -> DataFrame:
    """Vocabulary rows (row, n, word) for each length that a pair's longer word can have, with ``parts``, one range of edit places each."""
    longer = vocabulary.withColumn("size", F.char_length("word")).withColumn("m", F.explode(F.array("size", F.col("size") + 1)))
    return longer.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (row, n, m, parts, part, key, middle): the initial state that a word has in a range, and its letters between.

    The letters go one beyond the range, so that it shows whether both words differ
    before its end; no edit is made there.
    """
    rows = rows.withColumns({"lo": F.expr("int(m * part div parts)"), "hi": F.expr("int(m * (part + 1) div parts)")}).where("lo < hi")
    after = F.expr("right(word, m - hi)")
    key = F.concat(F.substring("word", F.lit(1), F.col("lo")), F.lit("/"), after)
    long = F.when(F.col("hi") < F.col("m"), F.lit(OPEN)).otherwise(F.lit(LONG))
    end = F.when(F.col("size") == F.col("m"), long).otherwise(F.lit(SHORT))
    letters = F.least(F.col("hi") + 1, F.col("m")) - F.col("lo") - (F.col("m") - F.col("size"))
    middle = F.concat(F.substring("word", F.col("lo") + 1, letters), end)
    key = F.when(F.col("m") > KEY, F.sha2(key, 256)).otherwise(key)
    return rows.select("row", "n", "m", "parts", "part", key.alias("key"), middle.alias("middle"))


_STATE = ["m", "parts", "part", "key"]


def _near(rows: DataFrame, letters: int) -> DataFrame:
    """Per word and group: row, n_near and the nearest most common word as (form_n, form_row)."""

    def work(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in (*_STATE, "middle")]
        order = sorted(range(table.num_rows), key=list(zip(*columns)).__getitem__)
        number, n = (np.asarray(table.column(c))[order] for c in ("row", "n"))
        found = near_pairs([tuple(c[i] for c in columns) for i in order])
        flat = np.fromiter((x for pair in found for x in pair), np.int64).reshape(-1, 2)
        ours, theirs = np.concatenate((flat, flat[:, ::-1])).T
        best = np.lexsort((number[theirs], -n[theirs], number[ours]))
        ours, theirs = ours[best], theirs[best]
        word, first, near = np.unique(number[ours], return_index=True, return_counts=True)
        best = theirs[first]
        columns = [pa.array(c.astype(np.int64)) for c in (word, near, n[best], number[best])]
        return pa.Table.from_arrays(columns, names=["row", "n_near", "form_n", "form_row"])

    groups = max(1, -(-letters // GROUP_LETTERS))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64(*_STATE), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(work, "row long, n_near long, form_n long, form_row long")


def nearest(vocabulary: DataFrame) -> DataFrame:
    """For each ``row`` of ``vocabulary`` (row, word, n) with near words: n_near, and form_n and form_row of the most common one.

    Numbers of rows must stand in the words' code-point order: ties go to the smaller one.
    """
    halved = F.pow(F.lit(2.0), F.greatest(F.lit(1), F.ceil(F.log2(F.col("m") / RANGE)))).cast("long")
    rows, made = _keyed(_begun(vocabulary, halved)), None
    while True:
        rows = session.materialize(rows, "keyed")
        sizes = rows.groupBy(*_STATE).agg(F.sum(F.char_length("middle")).alias("letters"), F.count(F.lit(1)).alias("words"))
        sizes = session.materialize(sizes.where("words > 1"), "sizes")
        crowded = sizes.where(F.col("letters") > GROUP_LETTERS).select(*_STATE)
        letters = sizes.where(F.col("letters") <= GROUP_LETTERS).agg(F.sum("letters")).first()[0] or 0
        small = rows.join(sizes.where(F.col("letters") <= GROUP_LETTERS).select(*_STATE), _STATE)
        found = session.materialize(_near(small, letters), "near")
        made = found if made is None else made.union(found)
        if crowded.isEmpty():
            break
        # the words of a crowded initial state, with its range in two halves
        again = rows.join(crowded, _STATE).select("row", "m", (F.col("parts") * 2).alias("parts"), F.explode(F.array(F.col("part") * 2, F.col("part") * 2 + 1)).alias("part"))
        rows = _keyed(again.join(vocabulary.withColumn("size", F.char_length("word")), "row"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form_row"))
    return made.groupBy("row").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("row", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form_row"))


def _roots(forms: DataFrame) -> DataFrame:
    """The end of each chain of ``forms`` (row, form_row): row, root_row.

    A form is several times as common as its word, so chains are short and have no rings.
    """
    ends = forms.select("row", F.col("form_row").alias("root_row"))
    step = forms.select(F.col("row").alias("at"), "form_row")
    done = None
    while True:
        further = ends.join(step, F.col("root_row") == F.col("at"), "left")
        further = session.materialize(further.select("row", F.coalesce("form_row", "root_row").alias("root_row"), F.col("form_row").isNotNull().alias("moved")), "ends")
        still = further.where("not moved").select("row", "root_row")
        done = still if done is None else done.union(still)
        ends = further.where("moved").select("row", "root_row")
        if ends.isEmpty():
            return done


def groups(docs: DataFrame) -> DataFrame:
    """The vocabulary of ``docs`` (``doc_id``, ``text``, any other columns) with the form and root of each word.

    Returns word, n, n_near (words one edit apart), form (the most common of these, the
    smallest in code-point order of equally common ones, if it is at least ``FORM_TIMES``
    as common as the word), form_n and root (the last word that forms lead to, the word
    itself if it has none). Null and empty texts have no words; without texts, or with
    rare words only, the result is empty. Repeated rows count as often as they are there.
    """
    vocabulary = session.materialize(number_rows(session.materialize(words(docs), "words"), ["word"]), "vocabulary")
    near = session.materialize(nearest(vocabulary), "nearest")
    known = vocabulary.join(near, "row", "left")
    has = F.col("form_n") >= FORM_TIMES * F.col("n")
    known = known.select("row", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("form_n")).alias("form_n"), F.when(has, F.col("form_row")).alias("form_row"))
    known = session.materialize(known, "known")
    forms = known.where("form_row IS NOT NULL")
    roots = session.materialize(_roots(forms), "roots")
    name = lambda at, to: vocabulary.select(F.col("row").alias(at), F.col("word").alias(to))
    named = forms.join(roots, "row").join(name("form_row", "form"), "form_row").join(name("root_row", "root"), "root_row")
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    alone = known.where("form_row IS NULL").select("word", "n", "n_near", F.lit(None).cast("string").alias("form"), "form_n", F.col("word").alias("root"))
    return named.select(*columns).union(alone.select(*columns))
