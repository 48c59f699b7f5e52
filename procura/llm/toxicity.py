"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Training needs document labels only.  From a bounded sample of labelled documents
(``sample_docs`` of each class, by hash order, none above ``sample_doc_chars``) token labels are made:
in a toxic document, the tokens whose word or prefix is the most telling of it (log odds of
document frequencies, within a share of the document's best; words that few toxic documents
have count only where no word is common among them, so few toxic labels train a model too).  A two-state chain with word and
prefix emissions is then fitted to these sequences by gradient steps on the regularised
likelihood, and a logistic layer maps a document's marginals (expected toxic tokens, largest
marginal) to its score.

Scoring runs over whole texts: forward-backward as products of two-by-two matrices, blocked so
that a batch of documents of any lengths is a few hundred array operations.

Rules: the inputs of a score are the text alone; null and empty texts score as documents
without tokens; repeated rows score alike; labels that are null are left out, a document
labelled more than once counts as toxic if any label says so, and of several texts of one labelled id
one is learned from (the smallest by hash and text); a null id is held in; without labels of both classes every
score is 0; extra columns are ignored or passed through by ``score_documents``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, held, importable, positional

SAMPLE_DOCS = 2000
SAMPLE_DOC_CHARS = 100_000
FOLDS = 5
BLOCK = 64
_EDGE = " \t.,;:!?\"'()[]{}*#$%&<>«»“”„…-–—_/\\|"
_TOKEN = re.compile(r"\S+")


def word_of(token: str) -> str:
    return token.strip(_EDGE).lower()


def features(word: str) -> list[int]:
    """64-bit hashes of the word itself and of its prefixes."""
    if not word:
        return []
    return [_feature("w" + word), *(_feature("p" + word[:n]) for n in (4, 5, 6) if len(word) >= n)]


def _feature(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "replace"))


# --- forward-backward ---------------------------------------------------------------------


def chain(emission: np.ndarray, lengths: np.ndarray, start: float, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward weights before, and backward weights from, every token (2 x tokens each).

    ``emission``: log weight of state 1 over state 0; ``start``: the same before the first token;
    ``step``: two-by-two weights of transitions.  Documents lie one after another.
    """
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return np.empty((2, 0)), np.empty((2, 0))
    blocks = -(-lengths // BLOCK)
    last_row = np.cumsum(blocks) - 1
    first_row = last_row - blocks + 1
    rows = int(blocks.sum())
    # A token's cell: its document's first row, then row by row.
    begin = np.cumsum(lengths) - lengths
    cell = np.arange(int(lengths.sum())) + np.repeat(first_row * BLOCK - begin, lengths)
    weight = np.ones(rows * BLOCK)
    weight[cell] = np.exp(np.clip(emission, -30, 30))
    moves = np.zeros(rows * BLOCK, bool)
    moves[cell] = True
    moves[cell[begin + lengths - 1]] = False  # nothing follows a document's last token
    weight, moves = weight.reshape(rows, BLOCK).T.copy(), moves.reshape(rows, BLOCK).T.copy()

    def forward(a: np.ndarray, b: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
        b = b * weight[c]
        move = moves[c]
        return (np.where(move, a * step[0, 0] + b * step[1, 0], a),
                np.where(move, a * step[0, 1] + b * step[1, 1], b))

    # Each block as one matrix, both rows of it carried along.
    top, low = (np.ones(rows), np.zeros(rows)), (np.zeros(rows), np.ones(rows))
    for c in range(BLOCK):
        top, low = forward(*top, c), forward(*low, c)
        if c % 8 == 7:
            norm = np.maximum(np.maximum(top[0], top[1]), np.maximum(low[0], low[1]))
            top, low = (top[0] / norm, top[1] / norm), (low[0] / norm, low[1] / norm)
    # Vectors at block borders, block by block for all documents at once.
    ahead = np.ones((2, rows))
    ahead[1, first_row] = np.exp(start)
    back = np.ones((2, rows + 1))  # after the row; 1 after a document's last
    for k in range(1, int(blocks.max())):
        at = first_row[blocks > k] + k
        a, b = ahead[:, at - 1]
        x = a * top[0][at - 1] + b * low[0][at - 1], a * top[1][at - 1] + b * low[1][at - 1]
        ahead[:, at] = np.array(x) / np.maximum(*x)
        at = last_row[blocks > k] - k + 1
        a, b = back[:, at]
        x = top[0][at] * a + top[1][at] * b, low[0][at] * a + low[1][at] * b
        back[:, at - 1] = np.array(x) / np.maximum(*x)
    # Inside the blocks.
    seen = np.empty((2, BLOCK, rows))
    a, b = ahead
    for c in range(BLOCK):
        seen[0, c], seen[1, c] = a, b
        a, b = forward(a, b, c)
        norm = np.maximum(a, b)
        a, b = a / norm, b / norm
    behind = np.empty((2, BLOCK, rows))
    a, b = back[:, :rows]
    for c in range(BLOCK - 1, -1, -1):
        move = moves[c]
        a, b = (np.where(move, step[0, 0] * a + step[0, 1] * b, a),
                np.where(move, step[1, 0] * a + step[1, 1] * b, b) * weight[c])
        norm = np.maximum(a, b)
        a, b = a / norm, b / norm
        behind[0, c], behind[1, c] = a, b
    flat = lambda x: x.transpose(0, 2, 1).reshape(2, -1)[:, cell]
    return flat(seen), flat(behind)


def marginals(emission: np.ndarray, lengths: np.ndarray, start: float, step: np.ndarray) -> np.ndarray:
    """P(state 1) of every token."""
    ahead, behind = chain(emission, lengths, start, step)
    zero, one = ahead * behind
    return one / (zero + one)


def pair_marginals(emission: np.ndarray, ahead: np.ndarray, behind: np.ndarray, step: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Sums of P(state i, then j) over the tokens ``inner`` that have one before them (2 x 2)."""
    at = np.flatnonzero(inner)
    left = ahead[:, at - 1].copy()
    left[1] *= np.exp(np.clip(emission[at - 1], -30, 30))
    joint = left[:, None] * step[:, :, None] * behind[None][:, :, at]
    return (joint / joint.sum(axis=(0, 1))).sum(axis=2)


def sums(values: np.ndarray, lengths: np.ndarray, how: np.ufunc) -> np.ndarray:
    """``how`` over each document's values; 0 for those without tokens."""
    out = np.zeros(len(lengths))
    full = lengths > 0
    if full.any():
        out[full] = how.reduceat(values, (np.cumsum(lengths) - lengths)[full])
    return out


# --- model ----------------------------------------------------------------------------------


@dataclass
class Model:
    """Weights of features, the chain and the document layer."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0
    start: float = 0.0
    step: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    layer: np.ndarray | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def emission(self, token: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word_of(token)))

    def document_features(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.ones(len(lengths)), np.log(sums(p, lengths, np.add) + 0.01), sums(p, lengths, np.maximum)], axis=1
        )

    def scores(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if self.layer is None:
            return np.zeros(len(lengths))
        return 1 / (1 + np.exp(-np.clip(self.document_features(p, lengths) @ self.layer, -35, 35)))


class Emissions(dict):
    """token -> emission, remembered up to a bound."""

    def __init__(self, model: Model, keep: int = 300_000):
        super().__init__()
        self.model, self.keep = model, keep

    def __missing__(self, token: str) -> float:
        out = self.model.emission(token)
        if len(token) <= 64:
            if len(self) >= self.keep:
                self.clear()
            self[token] = out
        return out


class Vocabulary:
    """Word types of a sample and their features, as arrays (type t has features flat[ptr[t]:ptr[t + 1]])."""

    def __init__(self, texts: list[str]):
        types: dict[str, int] = {}
        self.docs = [np.array([types.setdefault(word_of(t), len(types)) for t in x.split()], np.int32) for x in texts]
        hashes, size = [], np.zeros(len(types) + 1, np.int64)
        for word, t in types.items():
            own = features(word)
            size[t + 1] = len(own)
            hashes += own
        self.ptr = np.cumsum(size)
        self.names, self.flat = np.unique(np.array(hashes, np.uint64), return_inverse=True)
        self.owner = np.repeat(np.arange(len(types)), size[1:])

    def features_of(self, types: np.ndarray) -> np.ndarray:
        size = self.ptr[types + 1] - self.ptr[types]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.unique(self.flat[at + np.repeat(self.ptr[types], size)])

    def by_type(self, values: np.ndarray, how: np.ufunc, empty: float) -> np.ndarray:
        """``how`` over the feature values of each type."""
        out = np.full(len(self.ptr) - 1, empty)
        full = np.diff(self.ptr) > 0
        if full.any():
            out[full] = how.reduceat(values[self.flat], self.ptr[:-1][full])
        return out


def token_labels(vocab: Vocabulary, toxic: np.ndarray, share: float = 0.8, least: float = 3.0):
    """A label for every token of each document (the telling tokens of the toxic ones), and which features to fit."""
    seen = np.zeros((2, len(vocab.names)))
    kinds = [np.unique(d) for d in vocab.docs]
    for types, y in zip(kinds, toxic):
        seen[y, vocab.features_of(types)] += 1
    n0, n1 = len(toxic) - int(toxic.sum()), int(toxic.sum())
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    rare = vocab.by_type(odds, np.maximum, -np.inf)
    odds[seen[1] < max(5, 0.01 * n1)] = -np.inf  # rarer ones tell more of copies than of toxicity
    telling = vocab.by_type(odds, np.maximum, -np.inf)
    if max((telling[types].max(initial=-np.inf) for types, y in zip(kinds, toxic) if y), default=-np.inf) < least:
        telling, least = rare, 0.0  # too few toxic documents for any word to be common among them
    labels = []
    for doc, types, y in zip(vocab.docs, kinds, toxic):
        bar = max(least, share * telling[types].max(initial=-np.inf)) if y else np.inf
        labels.append(telling[doc] >= bar)
    return labels, seen.sum(axis=0) >= min(3, n1)


def fit(texts: list[str], toxic: list[int], base_rate: float, rounds: int = 40, ridge: float = 1e-4,
        chunk_tokens: int = 250_000) -> Model:
    """The model of labelled texts; ``base_rate``: share of toxic rows among all labelled ones."""
    y = np.asarray(toxic, np.int64)
    if not len(y) or y.min() == y.max():
        return Model()
    vocab = Vocabulary(texts)
    labels, keep = token_labels(vocab, y)
    if not any(x.any() for x in labels):
        return Model()
    # Chunks of whole documents bound the memory of a gradient step.
    size = np.cumsum([len(d) for d in vocab.docs])
    cuts = np.flatnonzero(np.diff(size // chunk_tokens, prepend=-1))
    chunks = []
    for lo, hi in zip(cuts, [*cuts[1:], len(y)]):
        lengths = np.array([len(d) for d in vocab.docs[lo:hi]], np.int64)
        token, want = np.concatenate(vocab.docs[lo:hi]), np.concatenate(labels[lo:hi])
        inner = np.ones(len(token), bool)
        begin = (np.cumsum(lengths) - lengths)[lengths > 0]
        inner[begin] = False
        had, has = want[:-1][inner[1:]], want[1:][inner[1:]]
        pairs = np.array([[(~had & ~has).sum(), (~had & has).sum()], [(had & ~has).sum(), (had & has).sum()]], float)
        chunks.append((lengths, token, want, inner, begin, pairs))
    n, rate = len(vocab.names), np.concatenate(labels).mean()
    scale = 1 / max(1.0, sum(int(x.sum()) for x in labels))
    theta = np.zeros(n + 5)  # features, bias, start, steps 01, 10, 11 (00 is 0)
    theta[n] = np.log(rate / (1 - rate)) / 2
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    kept = keep[vocab.flat]

    def emissions() -> np.ndarray:
        return theta[n] + np.bincount(vocab.owner, weights=theta[vocab.flat], minlength=len(vocab.ptr) - 1)

    def steps() -> np.ndarray:
        return np.exp([[0.0, theta[n + 2]], [theta[n + 3], theta[n + 4]]])

    for k in range(1, rounds + 1):
        of_type, step = emissions(), steps()
        miss_by_type, ends = np.zeros(len(of_type)), np.zeros(5)
        for lengths, token, want, inner, begin, pairs in chunks:
            e = of_type[token]
            ahead, behind = chain(e, lengths, theta[n + 1], step)
            zero, one = ahead * behind
            miss = want - one / (zero + one)
            miss_by_type += np.bincount(token, weights=miss, minlength=len(of_type))
            moved = pairs - pair_marginals(e, ahead, behind, step, inner)
            ends += [miss.sum(), miss[begin].sum(), moved[0, 1], moved[1, 0], moved[1, 1]]
        by_feature = np.bincount(vocab.flat, weights=np.where(kept, miss_by_type[vocab.owner], 0), minlength=n)
        grad = np.concatenate([by_feature, ends]) * scale - ridge * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta = theta + 0.3 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    large = np.flatnonzero(np.abs(theta[:n]) >= 0.01)
    weights = dict(zip(vocab.names[large].tolist(), theta[large].tolist()))
    model = Model(weights, float(theta[n]), float(theta[n + 1]), steps())
    of_type = emissions()
    x = [model.document_features(marginals(of_type[token], lengths, model.start, model.step), lengths)
         for lengths, token, *_ in chunks]
    model.layer = logistic(np.concatenate(x), y, base_rate)
    return model


def logistic(x: np.ndarray, y: np.ndarray, base_rate: float, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Newton's method with a ridge; rows are weighed to the base rate."""
    share = y.mean()
    weight = np.where(y == 1, base_rate / share, (1 - base_rate) / (1 - share))
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        move = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * beta)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return beta


# --- Spark ------------------------------------------------------------------------------------


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS, sample_doc_chars: int = SAMPLE_DOC_CHARS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most ``sample_docs`` labelled documents of each class, none of fold 0."""
    importable(docs.sparkSession)
    known = labels.select(col(id_col).alias("doc_id"), col(label_col).alias("toxic")).filter(
        "doc_id is not null and toxic is not null"
    ).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter(fold(F.col("doc_id")) != 0)
    rate = known.agg(F.avg("toxic")).first()[0]
    if rate is None:
        return Model()
    order = F.xxhash64("doc_id")
    sample = [known.filter(F.col("toxic") == k).orderBy(order, "doc_id").limit(sample_docs) for k in (0, 1)]
    sample = sample[0].unionAll(sample[1])  # at most 2 x sample_docs rows
    texts = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    texts = texts.filter(F.col("text").isNotNull() & (F.length("text") <= sample_doc_chars))
    # Of several texts of one id always the same one.
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    ).orderBy(order).collect()
    return fit([r.text for r in rows], [r.toxic for r in rows], rate)


def spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Runs of tokens with a marginal of at least ``least``: character offsets and the largest marginal."""
    out: list[dict] = []
    before = -2
    for k, m in enumerate(_TOKEN.finditer(text)):
        if p[k] >= least:
            if before == k - 1:
                out[-1]["end"], out[-1]["marginal"] = m.end(), max(out[-1]["marginal"], float(p[k]))
            else:
                out.append({"begin": m.start(), "end": m.end(), "marginal": float(p[k])})
            before = k
    return out


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))


def score_documents(docs: DataFrame, model: Model, *, text_col: str = "text", names: tuple[str, ...] = ("score", "spans"),
                    batch_tokens: int = 400_000) -> DataFrame:
    """``docs`` with a score and the offending spans of each text (two columns of the given names)."""
    importable(docs.sparkSession)
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was fitted on
    schema = docs.select("*", F.lit(0.0).alias(names[0]),
                         F.expr("cast(null as array<struct<begin:int,end:int,marginal:double>>)").alias(names[1])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        look = held(("emissions", own.name), lambda: Emissions(own)).__getitem__

        def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            tokens = [t.split() for t in texts]
            lengths = np.array([len(t) for t in tokens], np.int64)
            emission = np.fromiter((look(t) for d in tokens for t in d), float, int(lengths.sum()))
            p = marginals(emission, lengths, own.start, own.step)
            ends = np.cumsum(lengths)
            most = sums(p, lengths, np.maximum)
            found = [spans(t, p[e - n : e]) if m >= 0.5 else [] for t, e, n, m in zip(texts, ends, lengths, most)]
            columns = [*batch.columns, pa.array(own.scores(p, lengths)), pa.array(found, _SPANS)]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < batch.num_rows:
                base = size[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size, base + 6 * batch_tokens, "right")))
                yield scored(batch.slice(lo, hi - lo))
                lo = hi

    return positional(docs).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", **training) -> DataFrame:
    """doc_id, held_out, score, predicted, spans for every row."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, **training)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    return score_documents(rows, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans",
    )
