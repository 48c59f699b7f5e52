"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared lower-cased with white space runs as one space.  A test item of n
characters may occur with k = floor(n * rate) edits; it is split into k + 1 pieces, one of which
an occurrence must hold unchanged.  One Aho-Corasick pass over each whole text finds all piece
hits, each hit places a window for its item, windows that overlap are merged, and Myers'
bit-parallel distance over the window decides.

The test items are the stated query set: they are read in blocks of at most ``block_chars``
characters, so the automaton a task holds is bounded whatever the size of the benchmark;
every block sees every document.

Rules: null and blank texts match nothing, nor do null or blank items; repeated items with
different ids are all reported; repeated document rows are reported once each; extra columns
are ignored; no hit is capped.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, pick, positional

RATE = 0.08
BLOCK_CHARS = 4_000_000

Item = tuple[int | None, str]


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(n: int, rate: float = RATE) -> int:
    return int(n * rate)


def pieces(text: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of edits + 1 pieces of nearly equal length."""
    cuts = [j * len(text) // (edits + 1) for j in range(edits + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


def myers(masks: dict[str, int], size: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of the pattern to a part of ``text`` and where that part ends first.

    ``anchored``: the part starts where the text does.
    """
    top, full, carry = 1 << (size - 1), (1 << size) - 1, int(anchored)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | carry) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Finds occurrences of a block of test items in a text."""

    def __init__(self, items: list[Item], rate: float):
        import ahocorasick

        self.items = [(i, normal(t)) for i, t in items]
        self.edits = [budget(len(t), rate) for _, t in self.items]
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, text) in enumerate(self.items):
            for offset, piece in pieces(text, self.edits[k]) if text else ():
                owners[piece].append((k, offset))
        self.masks: dict[int, dict[str, int]] = {}
        self.automaton = None
        if owners:
            self.automaton = ahocorasick.Automaton()
            for piece, own in owners.items():
                self.automaton.add_word(piece, (len(piece), own))
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """item -> merged windows that its piece hits allow."""
        found: dict[int, list[list[int]]] = defaultdict(list)
        for end, (size, own) in self.automaton.iter(text) if self.automaton else ():
            for k, offset in own:
                start = end + 1 - size - offset
                found[k].append([start - self.edits[k], start + len(self.items[k][1]) + self.edits[k]])
        merged: dict[int, list[list[int]]] = {}
        for k, spans in found.items():
            out: list[list[int]] = []
            for lo, hi in sorted(spans):
                if out and lo <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], hi)
                else:
                    out.append([max(0, lo), hi])
            merged[k] = out
        return merged

    def best(self, k: int, part: str) -> tuple[int, int, int] | None:
        """Distance, begin and end of item k's best occurrence in a window."""
        pattern = self.items[k][1]
        if (at := part.find(pattern)) >= 0:
            return 0, at, at + len(pattern)
        if self.edits[k] == 0:
            return None
        masks = self.masks.get(k) or self.masks.setdefault(k, letter_masks(pattern))
        distance, end = myers(masks, len(pattern), part)
        if distance > self.edits[k]:
            return None
        back = part[max(0, end - len(pattern) - self.edits[k]) : end][::-1]
        _, length = myers(letter_masks(pattern[::-1]), len(pattern), back, anchored=True)
        return distance, end - length, end

    def __call__(self, text: str | None) -> list[tuple[int | None, int, int, int, int]]:
        """(item id, distance, begin, end, windows that match) for each item that occurs."""
        text, out = normal(text), []
        for k, spans in sorted(self.windows(text).items()):
            hits = []
            for lo, hi in spans:
                if (hit := self.best(k, text[lo:hi])) is not None:
                    hits.append((hit[0], lo + hit[1], lo + hit[2]))
            if hits:
                out.append((self.items[k][0], *min(hits), len(hits)))
        return out

    def occurs(self, text: str | None) -> bool:
        text = normal(text)
        return any(self.best(k, text[lo:hi]) for k, spans in self.windows(text).items() for lo, hi in spans)


def matcher(items: tuple[Item, ...], rate: float) -> Matcher:
    """The worker's matcher of a block."""
    return held(("matcher", rate, items), lambda: Matcher(list(items), rate))


def blocks(benchmark: DataFrame, block_chars: int, id_col: str, text_col: str) -> Iterator[tuple[Item, ...]]:
    """The test items in blocks of bounded size (an item above the bound is a block of its own)."""
    items = pick(benchmark, item_id=id_col, text=text_col).filter(F.length(F.trim("text")) > 0)
    held, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        if held and size + len(row.text) > block_chars:
            yield tuple(held)
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += len(row.text)
    if held:
        yield tuple(held)


def matches(docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, block_chars: int = BLOCK_CHARS,
            id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
            item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, distance, begin, end (of the best occurrence, in the normal text), n_windows."""
    schema = "doc_id long, item_id long, distance int, begin int, end int, n_windows int"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
    source = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))

    def scan(items: tuple[Item, ...]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = matcher(items, rate)
            for batch in batches:
                rows = [(d.as_py(), *hit) for d, t in zip(batch.column(0), batch.column(1)) for hit in find(t.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        return source.mapInArrow(run, schema)

    out = docs.sparkSession.createDataFrame([], schema)
    for n, items in enumerate(blocks(benchmark, block_chars, item_id_col, item_text_col)):
        out = scan(items) if n == 0 else out.unionAll(scan(items))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, block_chars: int = BLOCK_CHARS,
                    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no test item occurs, as they are."""
    at, schema = docs.columns.index(text_col), docs.schema

    def keep(items: tuple[Item, ...]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = matcher(items, rate)
            for batch in batches:
                kept = batch.filter(pa.array([not find.occurs(t.as_py()) for t in batch.column(at)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, schema.names)

        return run

    for items in blocks(benchmark, block_chars, item_id_col, item_text_col):
        docs = positional(docs).mapInArrow(keep(items), schema)
    return docs
