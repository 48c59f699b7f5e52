"""Best-fit packing into fixed-length sequences, improved by swap-based local search.

Documents become pieces: one longer than a sequence is cut into full-length pieces (the
first may be shorter), every other one stays whole.  Full pieces are sequences of their own.
The rest is dealt by a stored row number into groups of about ``group_items`` pieces; a
group is packed by best fit in decreasing length and then improved: underfull bins, the emptiest
first, give pieces to other underfull bins by moves, one-for-one and two-for-one exchanges, each of which
raises the squared fill, until the group's lower bound is met or no exchange of any bin helps.
Groups are independent, so a group costs at most its own rounding (about one bin).

Rules: null text is empty (the end id alone); repeated ids and rows are packed each for
itself; no piece is dropped; extra columns are ignored; an empty table packs to no rows.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, staged
from .units import encoder

GROUP_ITEMS = 50_000
#: Emptiest bins that a round of the local search goes back to after every exchange; the others follow when these are stuck.
GIVERS = 64


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens."""
    if n <= capacity:
        return [n]
    return [n % capacity] * bool(n % capacity) + [capacity] * (n // capacity)


def document_pieces(
    docs: DataFrame, *, vocabulary: str, kind: str, end_id: int, capacity: int, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, row (a unique number) for every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, kind), struct.pack("<I", end_id)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, at = encode(text.as_py()) + end, 0
                for k, n in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc_id, k, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), row))
                    at, row = at + n, row + 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    return pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
    )


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers) by best fit, longest items first."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # the rooms that some bin has, ascending
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(rooms, lengths[item])
        if at == len(rooms):
            k, room = len(bins), capacity
            bins.append([])
        else:
            room = rooms[at]
            k = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bins[k].append(item)
        room -= lengths[item]
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(k)
    return bins


class LocalSearch:
    """Empties the emptiest underfull bins into the others, exchange by exchange."""

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.size, self.capacity = np.asarray(lengths, np.int64), capacity
        self.owner = np.empty(len(lengths), np.int64)
        self.items = [list(items) for items in bins]
        for k, items in enumerate(bins):
            self.owner[items] = k
        self.fill = np.bincount(self.owner, weights=self.size, minlength=len(bins)).astype(np.int64)
        #: Changes in the number of ranges (given, given + room] along the weights: what an exchange can bring in.
        self.steps = np.zeros(2 * capacity + 2, np.int64)
        room = self.capacity - self.fill
        open_ = np.flatnonzero((room > 0) & (self.fill > 0))
        loose = np.flatnonzero(room[self.owner] > 0)
        low = np.r_[np.zeros(len(open_), np.int64), self.size[loose]]
        np.add.at(self.steps, low + 1, 1)
        np.add.at(self.steps, low + np.r_[room[open_], room[self.owner[loose]]] + 1, -1)
        self.cover: np.ndarray | None = None

    def bound(self) -> int:
        """Bins that no packing can do without (Martello and Toth's L2).

        For every k: pieces above half a bin never share one; pieces of k to half a bin fill what those of at most
        capacity - k leave, the rest of their weight needs bins of its own.
        """
        c = self.capacity
        n = np.bincount(self.size, minlength=c + 1)
        many, weight = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(n * np.arange(len(n)))]  # below a size
        k, half = np.arange(c // 2 + 1), c // 2 + 1
        large = many[c + 1] - many[half]
        left = (many[c - k + 1] - many[half]) * c - (weight[c - k + 1] - weight[half])
        rest = np.maximum(weight[half] - weight[k] - left, 0)
        return max(-(-int(weight[-1]) // c), int(large) + int((-(-rest // c)).max()))

    def count(self, k: int, sign: int) -> None:
        """Add or take out the ranges of a bin."""
        room = self.capacity - int(self.fill[k])
        if room and self.items[k]:
            for low in (0, *(int(self.size[i]) for i in self.items[k])):
                self.steps[low + 1] += sign
                self.steps[low + room + 1] -= sign
        self.cover = None

    def put(self, item: int, to: int) -> None:
        at = int(self.owner[item])
        self.count(at, -1)
        self.count(to, -1)
        self.items[at].remove(item)
        self.items[to].append(item)
        self.fill[at] -= self.size[item]
        self.owner[item] = to
        self.fill[to] += self.size[item]
        self.count(at, 1)
        self.count(to, 1)

    def hopeless(self, target: int) -> bool:
        """No piece or pair of ``target`` lies in a range of another bin, so no exchange can take weight from it."""
        if self.cover is None:
            self.cover = np.cumsum(self.steps)
        own = self.size[self.items[target]]
        first, second = np.triu_indices(len(own), 1)
        weights = np.unique(np.r_[own, own[first] + own[second]])
        room = self.capacity - int(self.fill[target])
        low = np.sort(np.r_[0, own])
        mine = np.searchsorted(low, weights, "left") - np.searchsorted(low + room, weights, "left") if room else 0
        return not (self.cover[weights] > mine).any()

    def step(self, target: int) -> bool:
        """One exchange that moves weight out of ``target`` and raises the squared fill."""
        if self.hopeless(target):
            return False
        room = self.capacity - self.fill
        room[target] = 0
        room[self.fill == 0] = 0  # emptied bins stay empty
        own = np.asarray(self.items[target])
        own = own[np.lexsort((own, -self.size[own]))]
        for item in own:  # move: the bin it fills best
            fits = np.flatnonzero((room >= self.size[item]) & (self.fill + self.size[item] > self.fill[target]))
            if len(fits):
                self.put(int(item), int(fits[np.argmin(room[fits])]))
                return True
        others = np.flatnonzero(room[self.owner] > 0)
        if not len(others):
            return False
        given, space = self.size[others], room[self.owner[others]]
        least = np.maximum(self.fill[target] - self.fill[self.owner[others]], 0)  # more raises the squared fill
        best, chosen = 0, None
        for item in own:  # one for one
            gain = self.size[item] - given
            gain = np.where((gain > least) & (gain <= space), gain, 0)
            k = int(np.argmax(gain)) if len(gain) else 0
            if gain[k] > best:
                best, chosen = int(gain[k]), ([item], int(others[k]))
        tried = set()
        for a, first in enumerate(own):  # two for one
            for second in own[a + 1 :]:
                weight = int(self.size[first] + self.size[second])
                if weight in tried:
                    continue
                tried.add(weight)
                gain = weight - given
                gain = np.where((gain > least) & (gain <= space), gain, 0)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, chosen = int(gain[k]), ([first, second], int(others[k]))
        if chosen is None:
            return False
        to = int(self.owner[chosen[1]])
        self.put(chosen[1], target)
        for item in chosen[0]:
            self.put(int(item), to)
        return True

    def bins(self) -> int:
        return int((self.fill > 0).sum())

    def run(self) -> np.ndarray:
        """Bin of each item."""
        bound = self.bound()
        while self.bins() > bound:
            underfull = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
            givers = underfull[np.argsort(self.fill[underfull], kind="stable")].tolist()
            if any(self.step(giver) for giver in givers[:GIVERS]):
                continue
            moved = False
            for giver in givers[GIVERS:]:
                while self.fill[giver] and self.step(giver):
                    moved = True
                if moved and self.bins() <= bound:
                    break
            if not moved:
                break
        return self.owner


def pack(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; lengths from 1 to ``capacity``."""
    owner = LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()
    order = np.argsort(owner, kind="stable")
    size = np.asarray(lengths, np.int64)[order]
    before = np.cumsum(size) - size
    first = np.r_[True, np.diff(owner[order]) != 0]
    offset = np.empty(len(lengths), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    return owner, offset


def pack_pieces(pieces: DataFrame, *, capacity: int, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``pieces`` (a stored table with ``row`` and ``length``) plus sequence_id and offset."""
    full = pieces.filter(F.col("length") == capacity).select(
        "*", (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_items))
    names = pieces.columns

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", kind="stable")
        owner, offset = pack(rows["length"].tolist(), capacity)
        return rows[names].assign(sequence_id=(int(group[0]) << 24 | owner) * 2, offset=offset)

    packed = (
        rest.withColumn("pack_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
        .groupBy("pack_group").applyInPandas(run, full.schema)
    )
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, *, vocabulary: str, kind: str, end_id: int, capacity: int,
                   group_items: int = GROUP_ITEMS, **columns) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``docs``."""
    pieces = document_pieces(docs, vocabulary=vocabulary, kind=kind, end_id=end_id, capacity=capacity, **columns)
    return pack_pieces(staged(pieces, "pieces"), capacity=capacity, group_items=group_items).drop("row")
