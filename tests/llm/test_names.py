"""Odd column names, repeated ids, few labels and page roots."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from procura.llm import ann, html_extract, language_id, line_dedup, simhash, toxicity
from procura.llm.common import col, free_name

NAMES = ["doc_id", "text", "lang", "source", "n_chars", "a.b", "tick`ed", "toxic score", "row", "tie", "line"]


def _docs(spark):
    text = ["one line that stays\nshared line of sixteen or more", "shared line of sixteen or more\nanother line here", None, ""]
    rows = [(i, t, "en", "s", len(t or ""), 1.5, "x", "y", 2, "t", "l") for i, t in enumerate(text)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` double, "
                                       "`tick``ed` string, `toxic score` string, row int, tie string, line string")


def test_helpers(spark):
    docs = _docs(spark)
    assert docs.select(col("a.b"), col("tick`ed")).columns == ["a.b", "tick`ed"]
    assert free_name(docs, "toxic score") == "toxic score_" and free_name(docs, "other") == "other"


@pytest.mark.parametrize("name", ["toxicity", "line_dedup", "simhash", "decontaminate"])
def test_stages_keep_odd_columns(spark, name, monkeypatch):
    docs = _docs(spark)
    tables = {"labels": spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int"),
              "benchmark": spark.createDataFrame([("i1", "nothing of the kind is in any of these texts")], "item_id string, text string")}
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, folder, table: tables[table])
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert out.columns == NAMES
    assert {r["a.b"] for r in out.collect()} == {1.5}


def test_operators_take_odd_columns(spark):
    docs = _docs(spark)
    assert line_dedup.dedup_lines(docs).count() == 4
    assert simhash.unique_documents(docs).columns == NAMES


def test_one_text_of_a_repeated_labelled_id(spark):
    rows = [(1, f"bad word{i}") for i in range(20)] + [(2, "fine words")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    models = [toxicity.train(spark.createDataFrame(x, "doc_id long, text string").repartition(3), labels) for x in (rows, rows[::-1])]
    assert models[0].weights.keys() == models[1].weights.keys()


@pytest.mark.parametrize("n", [2, 4])
def test_few_toxic_documents_train_a_model(n):
    clean = [f"plain words number {i} of the text" for i in range(60)]
    toxic = [f"plain grunk{i} skazz of the text" for i in range(n)]
    model = toxicity.fit(clean + toxic, [0] * 60 + [1] * n, n / (60 + n))
    assert model.weights and model.layer is not None


PAGES = {
    "<main><h1>Title</h1><p>Body one of it</p><p>Body two</p><section><article><p>teaser card</p></article></section></main>":
        ["Title", "Body one of it", "Body two"],
    "<main><h1>Title</h1><article><p>Body text.</p></article></main>": ["Title", "Body text."],
    '<div id="content"><h1>T</h1><p>Long real body of the page</p></div><article><p>Other story</p></article>': ["T", "Long real body of the page"],
    "<main><p>x</p></main><article><h1>A</h1><p>The long story of it</p></article>": ["A", "The long story of it"],
    "<div><p>small print</p></div><article><h1>A</h1><p>The long story of it</p></article>": ["A", "The long story of it"],
}


@pytest.mark.parametrize("html", PAGES)
def test_the_story_is_whole(html):
    got = html_extract.main_text(html).split("\n\n")
    assert [b for b in got if b in PAGES[html]] == PAGES[html]


def test_text_beside_an_article_stays_out():
    assert html_extract.main_text("<div><p>small print</p></div><article><p>The long story of it</p></article>") == "The long story of it"


def test_templates_against_nested_texts(spark):
    """Subtrees counted as nested tuples, page by page, instead of hashes in Spark."""
    pages = [(i, f"http://h{i % 2}.org/{'abc'[i % 3]}/p{i}",
              f"<div><ul><li>menu {i % 2}</li></ul></div><article><h1>T{i}</h1><p>story {i}</p><p>common{i % 4}</p></article><div>foot<b>er</b></div>")
             for i in range(24)]
    seen, contexts, hashes = {}, {}, {}

    def nested(node):
        parts = tuple(x for x in ((" ".join(c.split()) or None) if isinstance(c, str) else nested(c) for c in node.children) if x)
        if not parts:
            return None
        out = (node.tag, *parts)
        hashes[out] = node.hash
        return out

    for _, url, html in pages:
        root = html_extract.parse(html)
        html_extract.hash_tree(root)
        found, context = html_extract.page_subtrees(html)
        host, section = url.split("/")[2:4]
        own = {}
        for node, _ in html_extract.walk(root):
            if (shape := nested(node)) and node.tag not in ("#root", "html", "body", "head", "title", "article", "main"):
                own[shape] = node.hash
        assert set(own.values()) == found
        for part in (None, section):
            contexts.setdefault((host, part), set()).add(context)
            for shape in own:
                seen.setdefault((host, part, shape), set()).add(context)
    want = {}
    for (host, part, shape), where in seen.items():
        if len(where) >= 3 and len(where) >= 0.3 * len(contexts[host, part]):
            want.setdefault((host, part), set()).add(hashes[shape])
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    got = {(r.host, r.section): {x & (2**64 - 1) for x in r.outer} for r in html_extract.host_templates(df).collect()}
    assert {k: v for k, v in got.items() if v} == want and want
    strict = html_extract.extract(df, outer_pages=100).filter("page_id = 0").first().text
    assert "menu" not in strict and strict.startswith("T0")


def test_more_languages_than_the_bound_raise(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language_id.train(docs)


def test_few_entries_on_several_blocks(spark):
    """A graph of more nodes than a block, searched from four entry nodes."""
    import numpy as np

    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    points = ann.nodes(df, "vec_id", "embedding")
    graph = ann.build_graph(points, block=64)
    asked = points.filter("id % 50 = 0").select(F.col("id").alias("query"), "vec", F.lit(None).cast("long").alias("own"))
    found = ann.search(points, graph, asked, k=10, entries=4, beam=96).filter("query <> node").collect()
    hits = 0
    for q in range(0, 1500, 50):
        d = ((v - v[q]) ** 2).sum(1)
        d[q] = np.inf
        best = set(np.argsort(d)[:10].tolist())
        hits += len(best & {r.node for r in sorted((r for r in found if r.query == q), key=lambda r: r.d)[:10]})
    assert hits >= 0.9 * 300


def test_another_working_folder(tmp_path):
    """Python workers find the package wherever the driver runs."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from procura.session import local_session\n"
        "from procura.llm import ann\n"
        "spark = local_session(2, 2)\n"
        "df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], 'vec_id long, embedding array<double>')\n"
        "from pyspark.sql import functions as F\n"
        "print('ROWS', ann.nearest(df, F.col('id') % 10 == 0, k=2).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 6" in done.stdout, done.stderr[-2000:]
