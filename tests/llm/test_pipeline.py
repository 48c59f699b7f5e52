"""The corpus pipeline stage by stage against brute force, and the registered queries' columns."""

import corpus_pipeline
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_text import _best_inside, _slow_fingerprint, _slow_lines, _union

import __spark_entry__
from procura.llm import decontaminate, toxicity
from procura.llm.common import staged, table

TOXIC = ("idiot moron scum loser", "stupid trash clown idiot")


@pytest.fixture(scope="module")
def start(spark):
    docs = table(spark, SF_SMALL, "documents")
    item = table(spark, SF_SMALL, "benchmark").orderBy("item_id").first().text
    clean = "a clean page about rivers and their many bends in spring"
    extra = [
        (100_000, None, "en", "x", None), (100_001, "", "en", "x", 0), (100_002, clean, "en", "x", len(clean)),
        (100_003, clean, "en", "y", len(clean)), (100_004, f"before it {item} after it", "en", "x", 1),
        (None, "a text without an id keeps its place", None, None, 1),
        (100_005, clean.replace("rivers", "river") + "\nand one more line of its own", "en", "x", 9),
    ]
    extra = spark.createDataFrame(extra, docs.schema)
    return staged(docs.unionAll(extra).unionAll(docs.filter("doc_id = 3")), "start")


def _rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, start):
    docs, kept = start, {}
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, SF_SMALL), name)
        if name != "packing":
            assert out.columns == start.columns and out.dtypes == start.dtypes
        kept[name] = (docs, out)
        docs = out

    docs, out = kept["toxicity"]
    model = toxicity.train(docs, table(spark, SF_SMALL, "labels"))
    bad = toxicity.score_documents(docs, model, names=("p", "s")).filter("p >= 0.5").select("doc_id").collect()
    assert sorted(map(repr, _rows(out))) == sorted(repr(r) for r in _rows(docs) if r[0] not in {b.doc_id for b in bad})
    assert {100_000, 100_001, 100_002, None} <= {d for d, _ in _rows(out)}

    docs, out = kept["line_dedup"]
    want = {}
    for d, (text, n, gone) in _slow_lines(list(dict.fromkeys(_rows(docs)))).items():
        if not gone or any(x.strip(" \t\r") for x in text.split("\n")):
            want[d] = text
    assert dict(_rows(out)) == want
    assert 100_003 not in want and want[100_005] == "and one more line of its own"
    assert out.filter("n_chars <> length(text)").count() == 0

    docs, out = kept["simhash"]
    rows = _rows(docs)
    fps = {t: _slow_fingerprint(t) for _, t in rows}
    values = sorted(set(fps.values()))
    root = _union([(a, b) for a in values for b in values if (a ^ b).bit_count() <= 3])
    first = {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        first.setdefault(root[fps[t]], d)
    assert sorted((d for d, _ in _rows(out)), key=repr) == sorted(first.values(), key=repr)

    docs, out = kept["decontaminate"]
    items = [decontaminate.normal(r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    left = {d for d, _ in _rows(out)}
    for d, t in _rows(docs):
        text = decontaminate.normal(t)
        if any(x in text for x in items):
            assert d not in left, d
        elif len(text) < 160:  # short enough for the full table
            assert (d in left) != any(_best_inside(x, text) <= decontaminate.budget(len(x)) for x in items), d
    assert 100_004 not in left

    docs, out = kept["packing"]
    assert {r.doc_id for r in out.select("doc_id").collect()} == {d for d, _ in _rows(docs)}
    over = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert over.filter("n > 2048 or n <> end").count() == 0


def test_run_and_empty_tables(spark, start):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    docs = start.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_SMALL), "empty")
        assert docs.count() == 0


@pytest.mark.parametrize(("number", "columns"), [
    (1, {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}),
    (2, {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    (3, {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    (4, {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
    (5, {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}),
    (8, {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    (10, {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
          "sequence_id": "bigint", "offset": "bigint"}),
])
def test_query_columns(spark, number, columns):
    queries = __spark_entry__.queries()
    (name,) = [q for q in queries if q.startswith(f"op{number}_")]
    out = queries[name](spark, SF_SMALL)
    assert columns.items() <= dict(out.dtypes).items()
    assert out.count() > 0


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert "op7_line_dedup" in __spark_entry__.oracle_sql()
