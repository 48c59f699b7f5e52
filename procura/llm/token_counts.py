"""Token counts by rank-synchronous array merging.

A byte-pair vocabulary of the ``tokenizers`` file format (lower case or not, byte-level letters,
an optional end-of-word suffix).  Units (texts cut at ASCII white space, which the
pre-tokenizer drops) are split into pre-tokens by the library's own normalizer and
pre-tokenizer; the merges themselves run here: all new pre-tokens of a batch lie in one
flat symbol array with a row number per symbol, every round finds each row's lowest-ranked
pair and merges all its occurrences at once, rows without a pair leave, and the
surviving symbols are counted.  Counts of units are remembered per worker (two generations
of bounded size).

Rules: null text counts as empty (0 bytes, 0 tokens); special strings inside a text count as
the library's default has it (one token each); repeated rows and ids keep their rows; extra columns
are ignored; no row is cut or dropped.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, pick, tokenizer
from .units import byte_letters

KEEP_UNITS = 400_000
KEEP_UNIT_BYTES = 64


class MergeTable:
    """Pairs of symbol ids -> rank and merged id, as arrays."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.merged = key[order], order.astype(np.int64), merged[order]
        self.none = len(pairs)
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], self.none), at

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each (non-empty) pre-token."""
        size = np.array([len(t) for t in tokens], np.int64)
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        symbol = self.inner[raw]
        ends = np.cumsum(size) - 1
        symbol[ends] = self.last[raw[ends]]
        row = np.repeat(np.arange(len(tokens)), size)
        out = size.copy()
        while len(symbol) > 1:
            same = row[:-1] == row[1:]
            rank, at = self.look(symbol[:-1], symbol[1:])
            rank = np.where(same, rank, self.none)
            first = np.flatnonzero(np.r_[True, ~same])
            lowest = np.minimum.reduceat(np.r_[rank, self.none], first)
            spread = np.repeat(lowest, np.diff(np.r_[first, len(row)]))
            live = spread < self.none
            chosen = (rank == spread[:-1]) & live[:-1]
            # Occurrences that overlap (a run of one symbol): every second one, from the left.
            where = np.flatnonzero(chosen)
            if not len(where):
                break
            run = np.r_[True, np.diff(where) != 1]
            start = where[np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))]
            where = where[(where - start) % 2 == 0]
            symbol[where] = self.merged[at[where]]
            keep = live.copy()
            keep[where + 1] = False
            np.subtract.at(out, row[where], 1)
            symbol, row = symbol[keep], row[keep]
        return out


class TokenCounter:
    """Token counts of whole texts for one vocabulary file; lives in a Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = tokenizer(path)
        self.table = MergeTable(spec["model"])
        self.letter_byte = {c: b for b, c in enumerate(byte_letters())}
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else re.compile(r"(?!)")
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def pretokens(self, unit: str) -> list[bytes]:
        if unit.isascii() and unit.isalpha():
            return [unit.lower().encode()]
        if unit[-1:] in ".,;:!?" and unit[:-1].isascii() and unit[:-1].isalpha():
            return [unit[:-1].lower().encode(), unit[-1].encode()]
        text = self.tok.normalizer.normalize_str(unit) if self.tok.normalizer else unit
        return [bytes([self.letter_byte[c] for c in w]) for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(text) if w]

    def learn(self, units: list[bytes]) -> dict[bytes, int]:
        """Counts of units that are not remembered."""
        out, tokens, owner = dict.fromkeys(units, 0), [], []
        for unit in units:
            text = unit.decode("utf-8")
            pieces = self.special.split(text) if "<" in text else [text]
            out[unit] = len(pieces) - 1
            for piece in pieces:
                if piece:
                    found = self.pretokens(piece)
                    tokens += found
                    owner += [unit] * len(found)
        if tokens:
            for unit, n in zip(owner, self.table.counts(tokens).tolist()):
                out[unit] += n
        return out

    def __call__(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """UTF-8 bytes and tokens of each text."""
        raw = [t.encode("utf-8") if t else b"" for t in texts]
        units = [x.split() for x in raw]
        new = [u for u in set().union(*units) if u not in self.known]
        batch = {u: self.older[u] for u in new if u in self.older}
        batch |= self.learn([u for u in new if u not in batch])
        if len(self.known) + len(batch) > KEEP_UNITS:
            # The units of this batch must stay within reach, so they open the new generation.
            self.older = self.known
            now = {u: self.older[u] for u in set().union(*units) if u in self.older}
            self.known = now | batch
        else:
            self.known |= batch
        look = self.known.__getitem__
        counts = [sum(map(look, u)) for u in units]
        for u in batch:
            if len(u) > KEEP_UNIT_BYTES:
                del self.known[u]
        return [len(x) for x in raw], counts


def counter(path: str) -> TokenCounter:
    """The worker's counter for a vocabulary file."""
    return held(("counter", path), lambda: TokenCounter(path))


def token_counts(docs: DataFrame, *, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                size, tokens = count(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    counted = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
