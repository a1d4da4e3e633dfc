"""Toxicity from a learned lexicon, matched with spelling errors allowed.

Terms (whole words, or stems that any ending may follow) are learned from labelled
rows. Their trie is intersected with Levenshtein automata: a state is a set of (trie
node, errors so far), and the deterministic automaton over these sets reads all words
of a batch side by side. A hit counts by what its term and its errors said in the
labelled rows, by whether it stands in quotation marks, and by the words around it.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridtally.llm.common import beside_text, over_batches, slices
from gridtally.llm.quality import sample

#: Labelled rows of either label to learn from, at most.
SAMPLE_ROWS = 3000
#: How surely a key must tell the labels apart: log likelihood against chance.
SURE = 10.0
#: Stems are tried from the first length to the last.
STEM_LENGTHS = range(4, 9)
#: Words to either side of a hit that make its context, and buckets for them.
AROUND, CONTEXT_BUCKETS = 6, 4096
#: Characters to either side of a hit in which quotation marks are looked for.
QUOTE_REACH = 80
#: Most states of one automaton; a lexicon that needs more is split into several.
MOST_STATES = 50_000
#: States that a letter of a term adds, about, by the errors allowed.
_STATES = (1, 10, 75)
QUOTES = "\"“”„«»‘’"

_KNOWN = 0x250


def _letters() -> np.ndarray:
    """1 for characters below U+0250 that belong to words; the rest of Unicode does, but for punctuation."""
    return np.array([chr(c).isalnum() for c in range(_KNOWN)], bool)


_ALNUM = _letters()


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _word_mask(code: np.ndarray) -> np.ndarray:
    known = code < _KNOWN
    mask = ~known & ~((code >= 0x2000) & (code < 0x2070)) & ~((code >= 0x3000) & (code < 0x3040))
    mask[known] = _ALNUM[code[known]]
    return mask


def word_spans(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate(([False], _word_mask(code), [False]))
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return turn[::2], turn[1::2]


def errors_allowed(term: str) -> int:
    """Edits within which a term is still recognised."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The lexicon trie intersected with Levenshtein automata, made deterministic.

    ``terms`` are (text, is a stem). ``match`` gives for the state after a word's last
    character the best term and its errors as 4 * term + errors, or -1.
    """

    def __init__(self, terms: list[tuple[str, bool]], most: int | None = None):
        children: list[dict[str, int]] = [{}]
        whole: dict[int, int] = {}
        stem: dict[int, int] = {}
        budget = [0]
        for k, (term, is_stem) in enumerate(terms):
            node, allowed = 0, errors_allowed(term)
            budget[0] = max(budget[0], allowed)
            for c in term:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    budget.append(0)
                node = children[node][c]
                budget[node] = max(budget[node], allowed)
            (stem if is_stem else whole)[node] = k
        limit = [errors_allowed(t) for t, _ in terms]
        alphabet = sorted({c for t, _ in terms for c in t})
        self.classes = np.full(_KNOWN + 1, len(alphabet) + 1, np.int32)
        self.other = {c: i + 1 for i, c in enumerate(alphabet) if ord(c) >= _KNOWN}
        for i, c in enumerate(alphabet):
            if ord(c) < _KNOWN:
                self.classes[ord(c)] = i + 1

        def closed(items: dict[int, int]) -> tuple:
            queue = list(items.items())
            while queue:
                node, e = queue.pop()
                if e > items[node]:
                    continue
                for child in children[node].values():  # a character of the term is missing
                    if e + 1 <= budget[child] and items.get(child, 99) > e + 1:
                        items[child] = e + 1
                        queue.append((child, e + 1))
            return tuple(sorted(items.items()))

        def after(state: tuple, c: str | None) -> tuple:
            items: dict[int, int] = {}

            def add(node: int, e: int) -> None:
                if e <= budget[node] and items.get(node, 99) > e:
                    items[node] = e

            for node, e in state:
                if node in stem:  # any ending may follow
                    add(node, e)
                for letter, child in children[node].items():
                    add(child, e + (letter != c))
                add(node, e + 1)  # a character too many
            return closed(items)

        begin = closed({0: 0})
        numbers, rows, queue = {(): 0, begin: 1}, [[0] * (len(alphabet) + 2)], [begin]
        for state in queue:
            row = [0]
            for c in [*alphabet, None]:
                reached = after(state, c)
                if reached not in numbers:
                    numbers[reached] = len(numbers)
                    queue.append(reached)
                row.append(numbers[reached])
            rows.append(row)
            if most and len(numbers) > most:
                raise OverflowError(f"more than {most} states")
        self.next = np.array(rows, np.int32)
        self.match = np.full(len(rows), -1, np.int32)
        for state, n in numbers.items():
            ends = [(e, -len(terms[k][0]), k) for node, e in state for k in (whole.get(node), stem.get(node)) if k is not None and e <= limit[k]]
            if ends:
                e, _, k = min(ends)
                self.match[n] = 4 * k + e

    def read(self, code: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that match, and what they match."""
        kind = self.classes[np.minimum(code, _KNOWN)]
        for c, n in self.other.items():
            kind[code == ord(c)] = n
        live, state, at = np.arange(len(begin)), np.ones(len(begin), np.int32), begin.copy()
        found, what = [], []
        while len(live):
            state = self.next[state, kind[at]]
            at = at + 1
            done = at == end[live]
            hit = done & (self.match[state] >= 0)
            found.append(live[hit])
            what.append(self.match[state[hit]])
            on = ~done & (state > 0)
            live, state, at = live[on], state[on], at[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        word, what = np.concatenate(found), np.concatenate(what)
        order = np.argsort(word, kind="stable")
        return word[order], what[order]


class Automata:
    """The whole lexicon, as one automaton or as several that are read one after another.

    Every term keeps its errors, however many terms there are.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.length = np.array([len(t) for t, _ in terms], np.int64)
        self.parts: list[tuple[np.ndarray, Automaton]] = []
        cost = [len(t) * _STATES[errors_allowed(t)] for t, _ in terms]
        order = sorted(range(len(terms)), key=lambda k: terms[k])  # terms that begin alike share states
        if sum(cost) <= MOST_STATES:
            self._add(terms, order)
        else:
            for low, high in slices([cost[k] for k in order], MOST_STATES):
                self._add(terms, order[low:high])

    def _add(self, terms: list[tuple[str, bool]], chosen: list[int]) -> None:
        chosen = sorted(chosen)
        try:
            made = Automaton([terms[k] for k in chosen], MOST_STATES if len(chosen) > 1 else None)
        except OverflowError:
            order = sorted(chosen, key=lambda k: terms[k])
            self._add(terms, order[: len(order) // 2])
            self._add(terms, order[len(order) // 2 :])
        else:
            self.parts.append((np.array(chosen, np.int64), made))

    def read(self, code: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that match, and the best that they match, as 4 * term + errors."""
        found = []
        for chosen, part in self.parts:
            word, what = part.read(code, begin, end)
            found.append((word, 4 * chosen[what >> 2] + (what & 3) if len(what) else what.astype(np.int64)))
        word, what = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((what >> 2, -self.length[what >> 2], what & 3, word)) if len(word) else np.zeros(0, np.int64)
        word, what = word[order], what[order]
        first = np.diff(word, prepend=-1) != 0
        return word[first], what[first]


def _quoted(text: str, begin: int, end: int) -> bool:
    """Whether a mark opens before and one closes after, on the same line."""
    before = text[max(0, begin - QUOTE_REACH) : begin].rpartition("\n")[2]
    behind = text[end : end + QUOTE_REACH].partition("\n")[0]
    opened = sum(before.count(q) for q in QUOTES)
    return opened % 2 == 1 and any(q in behind for q in QUOTES)


def find(automaton: Automaton, texts: list[str]) -> list[tuple[int, list[tuple]]]:
    """Per text, its words and its hits: (start, end, term, errors, quoted, context buckets)."""
    made = []
    for low, high in slices([len(t) for t in texts], 1 << 20):
        some = [lowered(t) for t in texts[low:high]]
        joined = "\n".join(some) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin, end = word_spans(code)
        size = np.array([len(t) + 1 for t in some], np.int64)
        base = np.cumsum(size) - size
        first = np.searchsorted(begin, base)
        last = np.append(first[1:], len(begin))
        hits: list[list[tuple]] = [[] for _ in some]
        words, whats = automaton.read(code, begin, end)
        for w, what in zip(words.tolist(), whats.tolist()):
            k = int(np.searchsorted(base, begin[w], "right")) - 1
            near = [n for n in range(max(first[k], w - AROUND), min(last[k], w + AROUND + 1)) if n != w]
            context = [zlib.crc32(joined[begin[n] : end[n]].encode("utf-8", "replace")) % CONTEXT_BUCKETS for n in near]
            b, e = int(begin[w] - base[k]), int(end[w] - base[k])
            hits[k].append((b, e, what >> 2, what & 3, _quoted(some[k], b, e), context))
        made += [(int(last[k] - first[k]), hits[k]) for k in range(len(some))]
    return made


def tells(toxic: int, clean: int, all_toxic: int, all_clean: int) -> bool:
    """Whether a key seen in so many documents of either label stands for toxicity."""
    if not toxic or clean > 0.02 * toxic:
        return False
    base, rate = all_toxic / max(1, all_toxic + all_clean), toxic / (toxic + clean)
    sure = toxic * np.log(rate / base) + (clean * np.log((1 - rate) / (1 - base)) if clean else 0)
    return sure >= SURE


def choose_terms(toxic: dict[str, int]) -> list[tuple[str, bool]]:
    """Terms from telling keys and their counts; keys end in ``$`` (word) or ``*`` (stem).

    A stem grows while nearly all of its documents go along; what ends up as one word
    is taken as that word. Longer keys that a chosen one covers are left out.
    """
    by_parent: dict[str, list[str]] = {}
    for k in toxic:
        if k.endswith("*"):
            by_parent.setdefault(k[:-2] + "*", []).append(k)
    terms: dict[str, bool] = {}
    roots = [k for k in toxic if k.endswith("*") and (len(k) - 1 == STEM_LENGTHS[0] or k[:-2] + "*" not in toxic)]
    for k in sorted(roots, key=lambda k: (-toxic[k], k)):
        while True:
            if toxic.get(k[:-1] + "$", 0) >= 0.9 * toxic[k]:
                terms[k[:-1]] = False
                break
            longer = max(by_parent.get(k, []), key=lambda x: (toxic[x], x), default=None)
            if longer is None or toxic[longer] < 0.9 * toxic[k]:
                terms[k[:-1]] = True
                break
            k = longer
    # a word that outgrew the longest stem, and words with no telling stem
    for k in sorted((k for k in toxic if k.endswith("$")), key=lambda k: (-toxic[k], k)):
        cover = next((k[:n] for n in range(1, len(k)) if terms.get(k[:n])), None)
        if cover is None:
            terms[k[:-1]] = False
        elif len(cover) == STEM_LENGTHS[-1] and toxic[k] >= 0.9 * toxic.get(cover + "*", 1):
            terms.pop(cover)
            terms[k[:-1]] = False
    return sorted(terms.items(), key=lambda x: (-max(toxic.get(x[0] + "$", 0), toxic.get(x[0] + "*", 0)), x[0]))


class Model:
    """Automaton, weight of each (term, errors), context weights, and the final layer."""

    #: What the final layer starts from, and is held to where the rows say nothing:
    #: plain, quoted, misspelled, misspelled and quoted hits, context, share of hits, bias.
    PRIOR = np.array([3.0, 1.0, 2.0, 0.5, 1.0, 1.0, -3.0])

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms, self.automaton = terms, Automata(terms)
        self.evidence = np.ones((len(terms), 3))
        self.context = np.zeros(CONTEXT_BUCKETS)
        self.layer = self.PRIOR.copy()

    def features(self, n_words: int, hits: list) -> np.ndarray:
        sums, best = np.zeros(4), 0.0
        for k, (_, _, term, errors, quoted, context) in enumerate(hits):
            sums[2 * (errors > 0) + bool(quoted)] += self.evidence[term, min(errors, 2)]
            around = float(self.context[context].mean()) if len(context) else 0.0
            best = around if k == 0 else max(best, around)
        return np.array([*np.log1p(sums), best, 10 * sums.sum() / max(1, n_words), 1.0])

    def fit(self, rows: list[tuple[int, int, list]]) -> None:
        """Learn from (label, words, hits) of the sampled documents."""
        seen = np.zeros((2, len(self.terms), 3))
        around = np.full((2, CONTEXT_BUCKETS), 0.5)
        for label, _, hits in rows:
            for term, errors in {(h[2], min(h[3], 2)) for h in hits}:
                seen[label, term, errors] += 1
            for h in hits:
                np.add.at(around[label], h[5], 1)
        total = np.maximum(1, [sum(r[0] == y for r in rows) for y in (0, 1)])
        # smoothed by two toxic documents to half a clean one
        odds = np.log((seen[1] + 2) / (total[1] + 2)) - np.log((seen[0] + 0.5) / (total[0] + 0.5))
        self.evidence = np.clip(odds / 3, 0, 1)
        share = around / around.sum(axis=1, keepdims=True)
        self.context = np.clip(np.log(share[1] / share[0]), -2, 2) * (around.sum(axis=0) > 20)
        if not rows or len({r[0] for r in rows}) < 2:
            return
        x = np.array([self.features(n, h) for _, n, h in rows])
        y = np.array([r[0] for r in rows], float)
        weight = (0.5 / np.array([np.mean(y == 0), np.mean(y == 1)]))[y.astype(int)]
        w = self.layer
        for _ in range(30):  # Newton steps, held to the prior
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grade = x.T @ (weight * (p - y)) + (w - self.PRIOR)
            bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
            w = w - np.linalg.solve(bend, grade)
        self.layer = w

    def score(self, n_words: int, hits: list) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(n_words, hits) @ self.layer, -30, 30))))


_HIT = pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("term", pa.int32()), ("errors", pa.int32()), ("quoted", pa.bool_()), ("context", pa.list_(pa.int32()))]
)


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _keys(word: str) -> list[str]:
    if not 3 <= len(word) <= 40:
        return []
    return [word + "$"] + [word[:n] + "*" for n in STEM_LENGTHS if len(word) >= n]


def _words(text: str) -> list[str]:
    low = lowered(text)
    begin, end = word_spans(np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32))
    return [low[b:e] for b, e in zip(begin.tolist(), end.tolist())]


def _telling_keys(chosen: DataFrame) -> dict[str, int]:
    """Keys that tell the labels apart, with the number of their toxic documents.

    Copies of one document would make all of its words look telling, so toxic
    documents in which a key has the same neighbours count once.
    """
    totals = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    all_toxic, all_clean = totals.get(1, 0), totals.get(0, 0)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = (Counter(), Counter())
        for label, text in zip(batch.column("label").to_pylist(), _texts(batch.column("text"))):
            counts[label].update({k for w in set(_words(text)) for k in _keys(w)})
        keys = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(keys, pa.string())] + [pa.array([counts[y][k] for k in keys], pa.int64()) for y in (1, 0)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "toxic", "clean"])

    found = over_batches(chosen.select("label", "text"), "key string, toxic long, clean long", count)
    summed = found.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    if not all_toxic or not all_clean:
        return {}  # nothing to tell apart
    # what no key below it can reach, so that the driver gets few keys that do not tell
    chance = float(np.log((all_toxic + all_clean) / all_toxic))
    best = summed.where((F.col("toxic") * chance >= SURE - 1e-6) & (F.col("clean") <= 0.02 * F.col("toxic")))
    clean = {r["key"]: r["clean"] for r in best.collect() if tells(r["toxic"], r["clean"], all_toxic, all_clean)}
    wanted = chosen.sparkSession.sparkContext.broadcast(set(clean))

    def neighbours(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = set()
        for text in _texts(batch.column("text")):
            words, of = _words(text), {}
            for i, w in enumerate(words):
                for k in _keys(w):
                    if k in wanted.value and k not in of:
                        of[k] = zlib.crc32(" ".join([*words[max(0, i - 1) : i], "", *words[i + 1 : i + 2]]).encode("utf-8", "replace"))
            seen.update(of.items())
        keys, around = zip(*seen) if seen else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(around, pa.int64())], names=["key", "around"])

    pairs = over_batches(chosen.where("label = 1").select("text"), "key string, around long", neighbours)
    apart = pairs.groupBy("key").agg(F.countDistinct("around").alias("n")).collect()
    return {r["key"]: r["n"] for r in apart if tells(r["n"], clean[r["key"]], all_toxic, all_clean)}


def fit(docs: DataFrame, labels: DataFrame, use: Column, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Learn lexicon and weights from at most ``rows`` documents of either label for which ``use`` holds.

    The driver gets the telling keys and the hits of the sample, which bounds both.
    Without telling terms the model scores every document by its bias.
    """
    parts = [sample(docs, labels, label, use & (F.col(label) == y), rows) for y in (1, 0)]
    chosen = parts[0].unionByName(parts[1]).persist()
    model = Model(choose_terms(_telling_keys(chosen)))
    shared = docs.sparkSession.sparkContext.broadcast(model.automaton)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find(shared.value, _texts(batch.column("text")))
        hits = [[dict(zip(("start", "end", "term", "errors", "quoted", "context"), h)) for h in hits] for _, hits in found]
        columns = [batch.column("doc_id"), batch.column("label"), pa.array([n for n, _ in found], pa.int64()), pa.array(hits, pa.list_(_HIT))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "n_words", "hits"])

    more = "n_words long, hits array<struct<start: int, end: int, term: int, errors: int, quoted: boolean, context: array<int>>>"
    schema = StructType(chosen.schema.fields[:2] + StructType.fromDDL(more).fields)
    found = over_batches(chosen, schema, work).collect()
    found.sort(key=lambda r: (str(r["doc_id"]), r["n_words"], len(r["hits"])))
    model.fit([(r["label"], r["n_words"], [tuple(h) for h in r["hits"]]) for r in found])
    chosen.unpersist()
    return model


def score(docs: DataFrame, model: Model, keep: tuple = ("doc_id",), threshold: float = 0.7) -> DataFrame:
    """``score``, ``predicted`` and the hits of every whole text, beside the ``keep`` columns.

    A hit's span holds character offsets of the text. A null or empty text has no hits.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the lexicon
    chosen, text = beside_text(docs, keep)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        found = find(model.automaton, _texts(batch.column(text)))
        scores = np.array([model.score(n, hits) for n, hits in found])
        spans = [[{"start": h[0], "end": h[1], "term": model.terms[h[2]][0], "errors": h[3], "quoted": h[4]} for h in hits] for _, hits in found]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("errors", pa.int32()), ("quoted", pa.bool_())]))
        columns = [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32)), pa.array(spans, kind)]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + columns, names=[*keep, "score", "predicted", "hits"])

    more = "score double, predicted int, hits array<struct<start: int, end: int, term: string, errors: int, quoted: boolean>>"
    return over_batches(chosen, StructType(chosen.schema.fields[: len(keep)] + StructType.fromDDL(more).fields), work)
