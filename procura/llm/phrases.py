"""Phrase collocations by best-first branch-and-bound growth over prefixes.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and
tabs.  Per language ``n`` counts the words, ``f(p)`` the contiguous occurrences of a phrase.  A candidate has 2 to
``most_words`` words and ``a = f >= least_count``; its score is the lowest of ``floor(1000 a n / (f(left) f(right)))``
over its cuts.  It is dropped if a candidate one or more words longer holds it and is as frequent.

Growth.  The frontier starts with the frequent words.  A phrase that starts with ``p`` is at most as frequent as any
right part of its cuts, so it scores at most ``1000 n / f(first word of p)``: the prefix counts bound all that can
grow from a prefix.  Each round opens the frontier's best bounds (the rarest quarter-power class of first words not
opened yet, and every prefix found below opened ones), counts their one-word extensions over all documents, and
settles what it can: scores, and the score ``T`` of each language's ``top``-th surviving candidate.  Prefixes with a
bound below ``T`` are never opened; growth ends when no other is left, so ties with ``T`` are all found.  Right parts
that no opened prefix has counted are counted on demand, in the same pass.

The texts are split once more into runs of 64-bit word hashes (a stage table), which all rounds read; the seed of the
hashes is changed until no two words of the corpus share one, so counts by word hashes are exact.  What a round counts
is told to the tasks by three bitmaps of phrase hashes of a fixed size (``2**BITS`` bits each), so nothing that grows with
the data is broadcast; a bit set by chance only counts a phrase that was not asked for.

Rules: null text is empty, null language is ``und``; repeated rows all count; a language without candidates gives no
rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import discard, pick, staged

#: Each bitmap has 2**BITS bits (8 MB).
BITS = 26
SLICE_CHARS = 8 << 20
#: Characters of text in a row of the encoded table, and bytes of its rows that are counted at a time.
ROW_CHARS = 1 << 20
SLICE_BYTES = 16 << 20
#: Words that a task remembers before it starts afresh.
KEEP_WORDS = 400_000
UNKNOWN_LANG = "und"

_BREAK = b"\xff"  # in no UTF-8 text
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + _BREAK * len(_ENDS))
_STEP = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1


def tokens(texts: list[str]) -> list[bytes]:
    """Words of all texts in order, with a break between pieces."""
    joined = b"\xff".join([t.encode("utf-8") for t in texts])
    return joined.translate(_FOLD).replace(_BREAK, b" \xff ").split()


def word_hash(word: bytes, seed: int) -> int:
    """64 bits, never 0 (which stands for the end of a piece)."""
    return xxhash.xxh64_intdigest(word, seed) or 1


def lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8"), 7)


def _spot(h: np.ndarray) -> np.ndarray:
    """Bit number of phrase hashes."""
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64)


class Bitmap:
    """A fixed number of bits, set for the phrases of a table."""

    def __init__(self, rows: list, size: int = 1 << (BITS - 3)):
        self.bits = np.zeros(size, np.uint8)
        for bucket, bits in rows:
            at = (bucket - 1) * 4096
            self.bits[at : at + 4096] = np.frombuffer(bits, np.uint8)[: size - at]
        self.empty = not rows

    def __getstate__(self) -> tuple[bool, bytes]:
        """Few set bits travel as few bytes."""
        return self.empty, zlib.compress(self.bits.tobytes(), 1)

    def __setstate__(self, state: tuple[bool, bytes]) -> None:
        self.empty, self.bits = state[0], np.frombuffer(zlib.decompress(state[1]), np.uint8)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if self.empty:
            return np.zeros(len(h), bool)
        at = _spot(h)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Words(dict):
    """word -> number (0: break), in order of first use."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self.counts = np.zeros(1, np.int64)
        self.hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def count(self, numbers: np.ndarray) -> None:
        found = np.bincount(numbers, minlength=len(self))
        found[: len(self.counts)] += self.counts
        self.counts = found

    def hashed(self, lang: str, seed: int, frequent: Bitmap) -> np.ndarray:
        """Hash of every word, 0 for words that are not frequent."""
        new = list(itertools.islice(self, len(self.hashes), None))
        if new:
            own = np.array([word_hash(w, seed) for w in new], np.uint64)
            own[~frequent(extended(np.uint64(lang_hash(lang)), own))] = 0
            self.hashes = np.r_[self.hashes, own]
        return self.hashes


def _by_language(batch: pa.RecordBatch, size: int) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language, slice by slice of about ``size`` characters."""
    langs = pc.fill_null(batch.column(0), UNKNOWN_LANG)
    texts = batch.column(1)
    for lang in pc.unique(langs).to_pylist():
        own, held = [], 0
        for text in texts.filter(pc.equal(langs, lang)).to_pylist():
            if text:
                own.append(text)
                held += len(text)
            if held >= size:
                yield lang, own
                own, held = [], 0
        if own:
            yield lang, own


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, f of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Words] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, words in known.items():
                names = pa.array(list(words)[1:], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), names, pa.array(words.counts[1:], pa.int64())],
                    ["lang", "word", "f"],
                )
            known.clear()

        for batch in batches:
            for lang, own in _by_language(batch, SLICE_CHARS):
                words = known.setdefault(lang, Words())
                words.count(words.numbers(tokens(own)))
                if sum(map(len, known.values())) > KEEP_WORDS:
                    yield from emit()
        yield from emit()

    counted = texts.mapInArrow(run, "lang string, word string, f long")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def injective_seed(words: DataFrame) -> int:
    """The first seed that gives the words different hashes."""
    words = words.select("word").distinct()
    seed = 0
    while True:
        hashes = words.select(_hashed(seed)("word").alias("h")).groupBy("h").count()
        if hashes.filter("count > 1").isEmpty():
            return seed
        seed += 1


def _hashed(seed: int):
    @F.pandas_udf("binary")
    def run(words):
        return words.map(lambda w: word_hash(w.encode("utf-8"), seed).to_bytes(8, "little"))

    return run


@F.pandas_udf(LongType())
def phrase_hash(langs: pd.Series, keys: pd.Series) -> pd.Series:
    """The hash of a phrase from its words' hashes, which is what ``extended`` gives word by word."""

    def one(lang: str, key: bytes) -> int:
        h = lang_hash(lang)
        for word in struct.unpack(f"<{len(key) // 8}Q", key):
            h = (h * _STEP + word) & _MASK
        return h

    return pd.Series(np.array([one(a, k) for a, k in zip(langs, keys)], np.uint64).view(np.int64))


def bitmap(phrases: DataFrame, column: str = "h") -> Bitmap:
    """The bits of a table's hashes: at most ``2**BITS / 8`` bytes, whatever the table's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column(0)).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_spot(h)) + 1)], ["spot"])

    spots = phrases.select(column).mapInArrow(run, "spot long")
    rows = spots.groupBy(F.expr("bitmap_bucket_number(spot)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(spot))").alias("bits")
    )
    return Bitmap([(r.bucket, bytes(r.bits)) for r in rows.collect()])


def encoded(texts: DataFrame, seed: int, shared: Broadcast) -> DataFrame:
    """lang, run: the texts as 64-bit word hashes, 0 where a piece ends or a rare word stands.

    Frequent words without a frequent neighbour are in no candidate and are left out, as is a rare word's name: no
    phrase has it before or after all of its occurrences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Words] = {}
        for batch in batches:
            for lang, own in _by_language(batch, ROW_CHARS):
                if sum(map(len, known.values())) > KEEP_WORDS:
                    known.clear()
                words = known.setdefault(lang, Words())
                numbers = words.numbers(tokens(own))
                hashes = np.r_[np.uint64(0), words.hashed(lang, seed, shared.value)[numbers], np.uint64(0)]
                inner = hashes[1:-1]
                there = hashes != 0
                beside = inner * (there[:-2] | there[2:])  # alone among rare words: in no phrase
                kept = beside[(beside != 0) | (np.r_[np.uint64(0), beside[:-1]] != 0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([kept.astype("<u8").tobytes()], pa.binary())], ["lang", "run"]
                )

    return texts.mapInArrow(run, "lang string, run binary")


def extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return h * np.uint64(_STEP) + word


def _groups(h: np.ndarray, at: np.ndarray, run: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the phrases that start at ``at`` and where each different one begins in it."""
    order = np.argsort(h, kind="stable")
    new = np.r_[True, h[order][1:] != h[order][:-1]]
    words = run[at[order][:, None] + np.arange(m)]
    if (words[1:] != words[:-1])[~new[1:]].any():  # two phrases of one hash
        words = run[at[:, None] + np.arange(m)]
        order = np.lexsort(words.T)
        words = words[order]
        new = np.r_[True, (words[1:] != words[:-1]).any(1)]
    return order, np.flatnonzero(new)


_COUNTED = ["lang", "phrase", "f", "h", "left_least", "left_most", "right_least", "right_most"]


def _count_slice(lang: str, run: np.ndarray, starts: Bitmap, opened: Bitmap, wanted: Bitmap,
                 most_words: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of opened prefixes' extensions and of wanted phrases in one slice."""
    run = np.r_[run, np.uint64(0)]
    at = np.flatnonzero(run)
    h = extended(np.uint64(lang_hash(lang)), run[at])
    keep = starts(h)
    at, h = at[keep], h[keep]
    for m in range(2, most_words + 1):
        prefix = opened(h)
        word = run[np.minimum(at + (m - 1), len(run) - 1)]
        keep = word != 0
        at, prefix = at[keep], prefix[keep]
        h = extended(h[keep], word[keep])
        chosen = prefix | wanted(h)
        if chosen.any():
            start, key = at[chosen], h[chosen]
            order, first = _groups(key, start, run, m)
            start = start[order]
            count = np.diff(np.r_[first, len(start)])
            before = np.where(start > 0, run[start - 1], np.uint64(0)).view(np.int64)
            after = run[start + m].view(np.int64) if m < most_words else before
            size = len(first)
            words = np.ascontiguousarray(run[start[first][:, None] + np.arange(m)]).astype("<u8")
            phrase = pa.Array.from_buffers(pa.binary(8 * m), size, [None, pa.py_buffer(words.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()).take(pa.array(np.zeros(size, np.int32))), phrase, pa.array(count, pa.int64()),
                 pa.array(key[order][first].view(np.int64)),
                 pa.array(np.minimum.reduceat(before, first)), pa.array(np.maximum.reduceat(before, first)),
                 pa.array(np.minimum.reduceat(after, first)), pa.array(np.maximum.reduceat(after, first))],
                _COUNTED,
            )


def phrase_counts(runs: DataFrame, shared: Broadcast, *, most_words: int, least_count: int) -> DataFrame:
    """lang, phrase, m, f, h, held of the frequent phrases that extend opened prefixes or are wanted.

    ``shared``: the bitmaps of first words of all that is counted, of opened prefixes and of wanted phrases.
    ``held``: all its occurrences have one same word before or after them, so a longer phrase is as frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = shared.value
        held: dict[str, list[bytes]] = {}

        def count(lang: str) -> Iterator[pa.RecordBatch]:
            joined = np.frombuffer(bytes(8).join(held.pop(lang)), "<u8")
            yield from _count_slice(lang, joined, *bitmaps, most_words)

        for batch in batches:
            for lang, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(own)
                if sum(map(len, held[lang])) >= SLICE_BYTES:
                    yield from count(lang)
            while sum(len(x) for own in held.values() for x in own) >= 2 * SLICE_BYTES:
                yield from count(next(iter(held)))
        for lang in list(held):
            yield from count(lang)

    schema = "lang string, phrase binary, f long, h long, left_least long, left_most long, right_least long, right_most long"
    counted = runs.mapInArrow(run, schema).groupBy("lang", "phrase").agg(
        F.sum("f").alias("f"), F.max("h").alias("h"), F.min("left_least").alias("left_least"),
        F.max("left_most").alias("left_most"), F.min("right_least").alias("right_least"),
        F.max("right_most").alias("right_most"),
    )
    same = lambda side: (F.col(f"{side}_least") == F.col(f"{side}_most")) & (F.col(f"{side}_least") != 0)
    m = (F.octet_length("phrase") / F.lit(8)).cast("int")
    return counted.filter(F.col("f") >= least_count).select(
        "lang", "phrase", m.alias("m"), "f", "h", ((m < most_words) & (same("left") | same("right"))).alias("held")
    )


def _ratio(a: str, n: str, l: Column, r: Column) -> Column:
    """floor(1000 a n / (l r)), exact."""
    wide = lambda c: c.cast("decimal(38,0)")
    over = wide(F.lit(1000)) * wide(F.col(a)) * wide(F.col(n))
    return F.call_function("div", over, wide(l) * wide(r))


def scores(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every candidate with its score as far as its parts are counted, and the parts that are not."""
    cuts = facts.filter("m >= 2").select(
        "lang", "phrase", "m", F.col("f").alias("a"), "n", "held", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    )
    cuts = cuts.withColumn("left", F.expr("substring(phrase, 1, 8 * k)")).withColumn(
        "right", F.expr("substring(phrase, 8 * k + 1, 8 * (m - k))")
    )
    count = lambda side, f: facts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    cuts = cuts.join(count("left", "l"), ["lang", "left"], "left").join(count("right", "r"), ["lang", "right"], "left")
    # A part is as frequent as the whole at least, so a missing one leaves an upper bound.
    known = F.col("l").isNotNull() & F.col("r").isNotNull()
    score = _ratio("a", "n", F.coalesce("l", "a"), F.coalesce("r", "a"))
    cuts = cuts.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r")).withColumn("known", known)
    missing = F.when(F.col("l").isNull(), F.col("left"))
    candidates = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.first("held").alias("held"), F.min("cut").alias("cut"),
        F.min("known").alias("known"),
    )
    parts = cuts.filter("not known").select(
        "lang", "phrase", F.explode(F.array(missing, F.when(F.col("r").isNull(), F.col("right")))).alias("part")
    ).filter("part is not null")
    return candidates, parts


def thresholds(candidates: DataFrame, top: int) -> DataFrame:
    """lang, least: the score of the ``top``-th surviving candidate of each language that has so many."""
    order = F.col("score").desc()
    rows = candidates.filter("known and not held").select("lang", "phrase", F.col("cut.score").alias("score"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = rows.withColumn("part", F.row_number().over(Window.partitionBy("lang", share).orderBy(order))).filter(F.col("part") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(order)))
    return rows.filter(F.col("rank") == top).select("lang", F.col("score").alias("least"))


def _spelled(phrases: DataFrame, singles: DataFrame) -> DataFrame:
    """``phrases`` with the words of their hashes for ``phrase``."""
    at = F.sequence(F.lit(0), (F.octet_length("phrase") / F.lit(8)).cast("int") - 1)
    words = phrases.select("lang", "phrase", F.explode(at).alias("at"))
    words = words.withColumn("one", F.expr("substring(phrase, 8 * at + 1, 8)")).join(
        singles.select("lang", F.col("phrase").alias("one"), "word"), ["lang", "one"]
    )
    spelled = words.groupBy("lang", "phrase").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelled = spelled.select("lang", "phrase", F.array_join(F.transform("words", lambda x: x["word"]), " ").alias("text"))
    return phrases.join(spelled, ["lang", "phrase"]).drop("phrase").withColumnRenamed("text", "phrase")


def collocations(docs: DataFrame, *, least_count: int = 100, most_words: int = 5, top: int = 2000, text_col: str = "text",
                 lang_col: str = "lang", growth: float = 4.0) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` best surviving candidates of each language."""
    texts = pick(docs, lang=lang_col, text=text_col)
    context = texts.sparkSession.sparkContext
    words = staged(word_counts(texts), "words")
    seed = injective_seed(words)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    singles = words.filter(F.col("f") >= least_count).join(totals, "lang").select(
        "lang", _hashed(seed)("word").alias("phrase"), F.lit(1).alias("m"), "f", F.lit(False).alias("held"), "n",
        F.col("f").alias("first"), F.lit(False).alias("opened"), "word",
    ).withColumn("h", phrase_hash("lang", "phrase")).withColumn("start", F.col("h"))
    singles = staged(singles, "phrases")
    discard(words)
    facts = singles.drop("word")
    shared = context.broadcast(bitmap(singles))  # a bitmap of a fixed size
    runs = staged(encoded(texts, seed, shared), "runs")
    shared.destroy()
    bound = F.expr("1000 * n div first")
    turn = F.floor(F.log(F.col("first") / F.lit(float(least_count))) / F.lit(math.log(growth)))
    least = F.coalesce("least", F.lit(0))
    nothing, old_facts, reach = Bitmap([]), None, -1
    while True:
        candidates, parts = scores(facts)
        candidates = staged(candidates, "candidates")
        limits = staged(thresholds(candidates, top), "limits")
        live = candidates.join(limits, "lang", "left").filter(~F.col("known") & ~F.col("held") & (F.col("cut.score") >= least))
        # Parts of candidates are frequent, so what is asked for becomes a fact in the next pass.
        asked = parts.join(live.select("lang", "phrase"), ["lang", "phrase"], "left_semi").select("lang", F.col("part").alias("phrase"))
        asked = asked.distinct().withColumn("h", phrase_hash("lang", "phrase")).withColumn(
            "start", phrase_hash("lang", F.expr("substring(phrase, 1, 8)"))
        )
        asked = staged(asked, "parts")
        marked = facts.join(limits, "lang", "left").withColumn(
            "ahead", (F.col("m") < most_words) & ~F.col("opened") & (bound >= least)
        )
        nearest = marked.filter("ahead").agg(F.min(turn)).first()[0]
        some = not asked.isEmpty()
        if nearest is None and not some:
            break
        if nearest is not None:
            reach = max(reach + 1, int(nearest))
        marked = marked.withColumn("now", F.col("ahead") & (turn <= F.lit(reach)))
        opened = bitmap(marked.filter("now")) if nearest is not None else nothing
        wanted = bitmap(asked) if some else nothing
        starts = bitmap(marked.filter("now").select("start").unionAll(asked.select("start")).distinct(), "start")
        shared = context.broadcast((starts, opened, wanted))  # bitmaps of a fixed size
        found = staged(phrase_counts(runs, shared, most_words=most_words, least_count=least_count), "found")
        shared.destroy()
        fresh = found.join(facts.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
        heads = singles.select("lang", F.col("phrase").alias("head"), "n", "first", "start")
        fresh = fresh.withColumn("head", F.expr("substring(phrase, 1, 8)")).join(heads, ["lang", "head"])
        columns = ["lang", "phrase", "m", "f", "h", "held", "n", "first", "start"]
        old = marked.select(*columns, (F.col("opened") | F.col("now")).alias("opened"))
        grown = staged(old.unionByName(fresh.select(*columns, F.lit(False).alias("opened"))), "phrases")
        discard(found, candidates, limits, asked, *([old_facts] if old_facts is not None else []))
        facts = old_facts = grown
    discard(runs)
    best = candidates.join(limits, "lang", "left").filter(F.col("known") & ~F.col("held") & (F.col("cut.score") >= least))
    best = _spelled(best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), singles)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
