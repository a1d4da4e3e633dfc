"""Token ids of whole texts, encoded by a public tokenizer file.

A tokenizer that drops white space between words gives a text the ids of its
blank-separated pieces in a row. For such a file each distinct piece is encoded
once per worker and remembered; texts are then put together from the pieces. For
any other file whole texts are encoded.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: Pieces a worker remembers, and the longest of them in characters.
REMEMBERED = 400_000
LONGEST = 48
#: Marks that often stand behind a word.
MARKS = ".,;:!?%&$#*|)\""

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _drops_space(spec: dict) -> bool:
    """Whether pieces between blanks are encoded apart: blanks are removed first."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    first = steps[0]
    pattern = first.get("pattern", {}).get("Regex", "")
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and "[^\\s" in pattern


def _folds_case(spec: dict) -> bool:
    """Whether normalising is NFC, white space to blanks and lower case, and no more."""
    steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    return steps == ["NFC", "Replace", "Lowercase"]


_BEYOND = re.compile("[^\u0000-\u012f\u0131-\u024f]")


def _plain(text: str) -> bool:
    """Text that lowers letter by letter and is in NFC, as nearly all below U+0250 is, without special tokens."""
    if "<|" in text:
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")  # the quickest test that most texts pass
        return True
    except UnicodeEncodeError:
        return _BEYOND.search(text) is None


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, the end id included."""

    def __init__(self, path: str, end_id: int | None):
        from tokenizers import Tokenizer, normalizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.by_piece = _drops_space(spec)
        self.plain = None
        if self.by_piece and _folds_case(spec):
            # Latin letters can be lowered before; that spares the slow normaliser.
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = normalizers.Sequence([])
        self.known: dict[str, bytes] = {"": b""}
        self.end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def _put(self, pieces: list[str], encodings) -> None:
        self.known.update(zip(pieces, (array("I", e.ids).tobytes() for e in encodings)))

    def _learn(self, pieces: list[str]) -> None:
        if self.plain is None:
            simple, other = [], pieces
        else:
            simple = [p for p in pieces if _plain(p)]
            other = [p for p in pieces if not _plain(p)]
        # letters and the marks behind them are encoded apart, so a word is met once
        split = {p: (core, p[len(core) :].lower()) for p in simple if (core := p.lower().rstrip(MARKS)).isalpha()}
        parts = {x for pair in split.values() for x in pair}
        parts.update(p.lower() for p in simple if p not in split)
        new = [p for p in parts if p not in self.known]
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            self._put(some, self.plain.encode_batch_fast(some, add_special_tokens=False))
        known = self.known
        for p in simple:
            known[p] = known[split[p][0]] + known[split[p][1]] if p in split else known[p.lower()]
        for at in range(0, len(other), 2_000):
            some = other[at : at + 2_000]
            self._put(some, self.whole.encode_batch_fast(some, add_special_tokens=False))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return [array("I", e.ids).tobytes() + self.end for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        split = [(t.lower() if self.plain and _plain(t) else t).replace("\n", " ").split(" ") for t in texts]
        needed = set().union(*split)
        known = self.known
        if len(known) + len(needed) > 2 * REMEMBERED:
            # pieces met first are mostly the frequent ones
            keep = list(known)[: REMEMBERED // 2]
            self.known = known = {p: known[p] for p in keep}
        new = needed.difference(known)
        self._learn(list(new))
        made = [b"".join(map(self.known.__getitem__, pieces)) + self.end for pieces in split]
        if len(self.known) > REMEMBERED:
            for p in new:
                if len(p) > LONGEST or len(self.known) > 2 * REMEMBERED:
                    del self.known[p]
        return made


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path, end_id)


def as_ids(encoded: bytes) -> np.ndarray:
    return np.frombuffer(encoded, "<u4")
