"""Token ids, token counts and packing against the tokenizers library."""

import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from procura.llm import packing, token_counts, token_ids
from procura.llm.common import stage_path, tokenizer_path
from procura.llm.units import encoder

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
PARTS = ["Fa", "o.", "x,", "a", " ", "  ", "\n", "\t", "\x1c", "é", "É", "́", "İ", "Σ", "ς", "'s", "'LL", "<|endoftext|>",
         " <|startoftext|>", "中", "१", "2", "...", "\xa0", " ", "\x85", "ſ", "ﬁ", "𝔸", "\x00", "½", "aaaaaaa", "<"]


def _texts(n=3000):
    rnd = random.Random(3)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


DOCS = [(5, "The cat sat, the cat sat.\nOn  the mat!"), (1, None), (2, ""), (2, "two"), (2, "two"), (None, "no id"),
        (9, "word " * 5000), (3, "x" * 3000)]


def _docs(spark, rows=DOCS):
    # Extra columns named like inner ones must not matter.
    return spark.createDataFrame([(d, t, "n", 1) for d, t in rows], "doc_id long, text string, ids string, row int")


@pytest.mark.parametrize(("name", "kind"), [(WORD, "word"), (BYTE, "byte")])
def test_units_equal_library(name, kind):
    path = tokenizer_path(name)
    encode, library = encoder(path, kind), Tokenizer.from_file(path)
    texts = _texts()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encode(text), "<u4").tolist() == want.ids, repr(text)


@pytest.mark.parametrize("name", [WORD])
def test_counter_equals_library(name):
    path = tokenizer_path(name)
    library, count = Tokenizer.from_file(path), token_counts.TokenCounter(path)
    texts = [*_texts(), "a" * 50_000, "ab" * 4000 + " tail"]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert count(texts)[1] == want


def test_counter_memory_generations(monkeypatch):
    monkeypatch.setattr(token_counts, "KEEP_UNITS", 40)
    path = tokenizer_path(WORD)
    library, count = Tokenizer.from_file(path), token_counts.TokenCounter(path)
    texts = _texts(400)
    for lo in range(0, 400, 20):
        part = texts[lo : lo + 20]
        assert count(part)[1] == [len(library.encode(t, add_special_tokens=False).ids) for t in part]


def test_token_counts(spark):
    path = tokenizer_path(WORD)
    library = Tokenizer.from_file(path)
    out = token_counts.token_counts(_docs(spark), vocabulary=path, limit=2048).collect()
    want = []
    for d, t in DOCS:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 2048))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(_docs(spark, []), vocabulary=path, limit=1).count() == 0


@pytest.mark.parametrize("size", [1 << 10, 1 << 20])
def test_token_files_round_trip(spark, size, monkeypatch):
    path = tokenizer_path(WORD)
    library = Tokenizer.from_file(path)
    rows = [*DOCS, *[(100 + i, f"document number {i} " * (i % 40)) for i in range(300)]]
    where = stage_path(spark, "test")
    monkeypatch.setattr(token_ids, "BLOCK_BYTES", size)
    out = token_ids.token_files(spark, _docs(spark, rows), vocabulary=path, kind="word", end_id=1, vocabulary_size=49_408,
                                path=where, size=4096).collect()
    got = sorted(out, key=lambda r: r.start)
    assert len(got) == len(rows)
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    at = 0
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t or "")
    for r in got:
        assert r.start == at
        at += r.n_tokens
        have = np.frombuffer(bytes(r.ids), "<u4").tolist()
        wanted = [library.encode(t, add_special_tokens=False).ids + [1] for t in texts[r.doc_id]]
        assert have in wanted and r.n_tokens == len(have)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(have)}I", *have))
    assert token_ids.read_document(spark, where, 117) == library.encode(texts[117][0], add_special_tokens=False).ids + [1]
    assert token_ids.read_document(spark, where, 10**9) is None


def test_token_files_empty_and_wrong_dictionary(spark):
    path = tokenizer_path(WORD)
    out = token_ids.token_files(spark, _docs(spark, []), vocabulary=path, kind="word", end_id=1, vocabulary_size=10)
    assert out.count() == 0
    blob = token_ids._pack_block([], 4, token_ids.dictionary_hash(b"one"))
    with pytest.raises(ValueError, match="dictionary"):
        token_ids.Block(blob, b"two")


def _check_packing(rows, out, capacity, library):
    pieces = {}
    for r in out:
        pieces.setdefault(r.sequence_id, []).append(r)
    for own in pieces.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    total = 0
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id == d})
        if len([1 for x, _ in rows if x == d]) == 1:
            assert sum(n for _, _, n, _ in own) == len(ids)
            for k, (piece, start, n, crc) in enumerate(own):
                assert piece == k and crc == zlib.crc32(struct.pack(f"<{n}I", *ids[start : start + n]))
                assert n == capacity or k == 0
    assert sum(r.length for r in out) == total
    return len(pieces), -(-total // capacity)


@pytest.mark.parametrize("group_items", [20, 50_000])
def test_packing(spark, group_items):
    path = tokenizer_path(BYTE)
    rnd = random.Random(1)
    rows = [*DOCS, *[(100 + i, "word " * rnd.randint(1, 150)) for i in range(300)]]
    out = packing.pack_documents(_docs(spark, rows), vocabulary=path, kind="byte", end_id=0, capacity=256,
                                 group_items=group_items).collect()
    n, bound = _check_packing(rows, out, 256, Tokenizer.from_file(path))
    assert n <= bound + (1 if group_items > 1000 else 20)
    assert packing.pack_documents(_docs(spark, []), vocabulary=path, kind="byte", end_id=0, capacity=8).count() == 0


def test_pack_is_whole():
    rnd = random.Random(0)
    for _ in range(200):
        lengths = [rnd.randint(5, 60) for _ in range(rnd.randint(4, 40))]
        owner, offset = packing.pack(lengths, 100)
        fill = np.bincount(owner, weights=lengths)
        assert fill.max() <= 100 and (fill > 0).sum() <= len(packing.best_fit(lengths, 100))
        for k in set(owner.tolist()):
            own = sorted((int(offset[i]), lengths[i]) for i in np.flatnonzero(owner == k))
            assert [a for a, _ in own] == [sum(n for _, n in own[:j]) for j in range(len(own))]


def test_local_search_empties_bins():
    rnd = random.Random(1)
    exchanged = 0
    for _ in range(60):
        lengths = [rnd.randint(20, 70) for _ in range(40)]
        bins = []  # next fit: a start that leaves much to mend
        for i, n in enumerate(lengths):
            if not bins or sum(lengths[j] for j in bins[-1]) + n > 100:
                bins.append([])
            bins[-1].append(i)
        search, squares, before = packing.LocalSearch(lengths, bins, 100), [], None
        step = search.step

        def watched(giver, search=search, step=step, squares=squares):
            held = search.owner.copy()
            done = step(giver)
            if done:
                squares.append((int((search.fill**2).sum()), int((held != search.owner).sum())))
            return done

        search.step = watched
        before = int((search.fill**2).sum())
        owner = search.run()
        assert all(a < b for a, b in zip([before, *[s for s, _ in squares]], [s for s, _ in squares]))
        fill = np.bincount(owner, weights=lengths)
        assert fill.max() <= 100 and (fill > 0).sum() <= len(bins) - 1
        exchanged += sum(moved > 1 for _, moved in squares)
    assert exchanged > 20


def test_local_search_goes_past_stuck_bins():
    # More bins than GIVERS hold one long piece that fits nowhere and beats every other piece by more than the room there.
    many = packing.GIVERS + 6
    lengths, bins = [60] * many, [[i] for i in range(many)]
    for _ in range(2):
        bins.append(list(range(len(lengths), len(lengths) + 3)))
        lengths += [39, 22, 22]
    owner = packing.LocalSearch(lengths, bins, 100).run()
    fill = np.bincount(owner, weights=lengths)
    assert fill.max() <= 100 and (fill > 0).sum() == many


def test_local_search_stops_only_when_no_exchange_helps():
    rnd = random.Random(3)
    for _ in range(20):
        lengths = [rnd.choice([rnd.randint(4, 45), rnd.randint(52, 60)]) for _ in range(rnd.randint(20, 160))]
        search = packing.LocalSearch(lengths, packing.best_fit(lengths, 100), 100)
        owner = search.run()
        fill = np.bincount(owner, weights=lengths).astype(int)
        assert fill.max() <= 100 and (fill == search.fill).all()
        if (fill > 0).sum() == search.bound():
            continue
        bins = [[lengths[i] for i in np.flatnonzero(owner == k)] for k in range(len(fill))]
        for a, own in enumerate(bins):
            weights = {*own, *(x + y for i, x in enumerate(own) for y in own[i + 1 :])}
            for b, other in enumerate(bins):
                if a == b or not other:
                    continue
                for given in (0, *other):
                    gains = [w - given for w in (own if given == 0 else weights)]
                    assert not any(0 < g <= 100 - fill[b] and fill[b] + g > fill[a] for g in gains)


def test_cut():
    assert packing.cut(10, 10) == [10]
    assert packing.cut(11, 10) == [1, 10]
    assert packing.cut(30, 10) == [10, 10, 10]
