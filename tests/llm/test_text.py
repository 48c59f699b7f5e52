"""SimHash, line dedup, decontamination, extraction and language against brute force."""

import random

import pytest
import xxhash

from procura.llm import decontaminate, html_extract, language_id, line_dedup, simhash
from procura.llm.common import staged, table_bytes
from procura.llm.components import components


# --- components and SimHash ---------------------------------------------------------------


def _union(links):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)]
    links += [(rnd.randint(5000, 5200), rnd.randint(5000, 5200)) for _ in range(120)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = _union([x for x in links if x[0] != x[1]])
    assert got.keys() == want.keys()
    assert len({(got[x], want[x]) for x in got}) == len(set(got.values())) == len(set(want.values()))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _near_texts():
    rnd = random.Random(5)
    words = [f"w{i}É" for i in range(400)]
    base = [" ".join(rnd.choices(words, k=200)) for _ in range(12)]
    rows = []
    for t in base:
        for _ in range(8):
            w = t.split()
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append(" ".join(w))
    rows += ["one two", "One  Two", "A\tb\nC d", "a b c d", "\x1c a b", *[" ".join(rnd.choices(words, k=30)) for _ in range(60)]]
    return rows


@pytest.mark.parametrize("tile", [4, 2048])
def test_simhash(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (3, tile))
    rows = [(i * 3 % 257, t) for i, t in enumerate(_near_texts())]
    rows += [(900, None), (901, ""), (902, "  "), (rows[0][0], rows[0][1]), (None, "lonely words are these")]
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, fp int")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = sorted({_slow_fingerprint(t) for _, t in rows})
    root = _union([(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 3])
    least = {}
    for d, t in rows:
        r = root[_slow_fingerprint(t)]
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    want = sorted(((d, _slow_fingerprint(t), least[root[_slow_fingerprint(t)]]) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr) == want
    assert len({r.keeper for r in got}) == len(set(root.values()))
    kept = simhash.unique_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(least.values(), key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# --- line dedup ---------------------------------------------------------------------------


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def _slow_lines(rows):
    lines = [(d, n, raw.strip(" \t\r")) for d, t in rows if t is not None for n, raw in enumerate(t.split("\n"))]
    lines = sorted((x for x in lines if x[2]), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    gone, first = set(), []
    for d, n, line in lines:
        if any(line == f or len(line) >= 16 and len(f) >= 16 and abs(len(line) - len(f)) < 2 and _edits(line, f) <= 1 for f in first):
            gone.add((d, n))
        if line not in first:
            first.append(line)
    out = {}
    for d, t in rows:
        raw = t.split("\n") if t is not None else []
        kept = [x for n, x in enumerate(raw) if (d, n) not in gone]
        out[d] = (None if t is None else "\n".join(kept), len(raw), len(raw) - len(kept))
    return out


def _lines():
    rnd = random.Random(9)
    base = ["".join(rnd.choices("abcdé ñ", k=rnd.randint(3, 60))) for _ in range(40)]
    rows = []
    for d in range(60):
        own = []
        for _ in range(rnd.randint(1, 6)):
            line, k = rnd.choice(base), rnd.randint(0, 4)
            at = rnd.randrange(len(line))
            line = [line, line[:at] + line[at + 1 :], line[:at] + "x" + line[at:], line[:at] + "y" + line[at + 1 :], line][k]
            own.append(rnd.choice(["", " ", "\t"]) + line + rnd.choice(["", "\r"]))
        rows.append((d, "\n".join(own)))
    return [*rows, (70, None), (71, ""), (72, "\n\n"), (73, "aaaaaaaaaaaaaaaaaaaa"), (74, "aaaaaaaaaaaaaaaaaaaaa"), (None, base[3])]


@pytest.mark.parametrize("small", [True, False])
def test_line_dedup(spark, small, monkeypatch):
    if not small:
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", -1)
    rows = _lines()
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, line int, at string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    want = _slow_lines(rows)
    assert got == want
    assert sum(x[2] for x in want.values()) > 60
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_bound_grows(spark):
    rnd = random.Random(21)
    base = ["".join(rnd.choices("abé ", k=rnd.randint(16, 130))).strip().ljust(16, "x") for _ in range(12)]
    lines = []
    for _ in range(110):
        line = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 6)):
            at = rnd.randrange(1, len(line) - 1)
            line[at : at + 1] = rnd.choice(["", "z", line[at] + "q"])
        lines.append("".join(line))
    lines += ["the word ntti stands in the middle of this long line", "the word that stands in the middle of this long line"]

    def bound(a, b):
        return max(1, min(5, min(len(a), len(b)) // 12))

    want, first = set(), []
    for d, line in enumerate(lines):
        near = [f for f in first if min(len(line), len(f)) >= 16 and abs(len(line) - len(f)) < 6]
        if line in first or any(_edits(line, f) <= bound(line, f) for f in near):
            want.add(d)
        first.append(line)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = line_dedup.dedup_lines(docs, chars_per_edit=12, max_edits=5)
    assert {r.doc_id for r in found.collect() if r.n_removed} == want
    one = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.n_removed}
    assert one < want and 111 in want - one
    plan = found._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_line_dedup_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a line of its own here"), (1, "a line of its own here"), (2, "a line of its own here!")],
                                 "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [(1, "a line of its own here"), (1, "a line of its own here"), (2, "")]


def test_line_dedup_is_native(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_line_dedup_sql_on_near_lines(spark):
    import duckdb

    from procura.llm.queries import LINE_DEDUP_SQL

    rows = [r for r in _lines() if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = {r[0]: (r[1], r[2]) for r in con.execute(LINE_DEDUP_SQL).fetchall()}
    assert got == {d: x[1:] for d, x in _slow_lines(rows).items()}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_dedup_sends_no_exploded_rows_to_the_driver(spark):
    """Spark takes exploded rows for one a line and stored ids for what they are unpacked: neither may be broadcast."""
    places = [(i, i, 0, f"entry {i:04d} of a long and even log", [(i % 7, i % 4)]) for i in range(400)]
    texts = "doc_id long, tie long, line_no int, line string, halves array<struct<half: long, kind: int>>"
    near = _plan(line_dedup.near_lines(staged(spark.createDataFrame(places, texts), "texts")))
    assert "SortMergeJoin" in near and "Broadcast" not in near
    firsts = line_dedup.first_lines(spark.createDataFrame(places, texts), 16)
    assert "Broadcast" not in _plan(line_dedup.candidates(staged(firsts, "firsts")))

    docs = spark.createDataFrame([(1, 0, "a line\nanother")], "doc_id long, tie long, text string")
    for rows in (line_dedup.BROADCAST_ROWS + 1, 100):
        found = staged(spark.range(rows).selectExpr("id AS doc_id", "0L AS tie", "0 AS line_no", "1L AS half", "0 AS kind"), "found")
        assert table_bytes(found) < line_dedup.BROADCAST_BYTES
        assert ("Broadcast" in _plan(line_dedup.candidate_texts(docs, found))) == (rows == 100)
    assert "Broadcast" not in _plan(line_dedup.dedup_lines(docs.select("doc_id", "text")))


def test_simhash_sends_no_row_per_document_to_the_driver(spark):
    docs = spark.createDataFrame([(i, f"text {i} of {i % 3}") for i in range(50)], "doc_id long, text string")
    assert "Broadcast" not in _plan(simhash.near_duplicates(docs))
    assert "Broadcast" not in _plan(simhash.unique_documents(docs))


# --- decontamination ----------------------------------------------------------------------


def _best_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        old, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return min(row)


def _leaks():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdeghiké", k=rnd.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(8, 30)))) for i in range(12)]
    docs = []
    for d in range(80):
        words = [word() for _ in range(rnd.randint(5, 60))]
        if d % 2:
            text = list(rnd.choice(items)[1])
            for _ in range(rnd.randint(0, int(len(text) * 0.12))):
                at = rnd.randrange(len(text))
                text[at : at + 1] = rnd.choice(["", "q", text[at] + "z"])
            words.insert(rnd.randrange(len(words)), "".join(text).upper() if d % 4 == 1 else "".join(text))
        docs.append((d, "  ".join(words)))
    return items, docs


@pytest.mark.parametrize("block", [300, 4_000_000])
def test_decontaminate(spark, block):
    items, docs = _leaks()
    extra = [(90, None), (91, ""), (3, docs[3][1]), (None, items[0][1])]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs + extra], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*items, (50, None), (51, " "), (None, items[1][1])], "item_id long, text string")
    got = decontaminate.matches(df, bench, block_chars=block).collect()
    want = []
    for d, t in docs + extra:
        for i, x in [*items, (None, items[1][1])]:
            x = decontaminate.normal(x)
            best = _best_inside(x, decontaminate.normal(t))
            if best <= int(len(x) * decontaminate.RATE):
                want.append((d, i, best))
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in got), key=repr) == sorted(want, key=repr)
    assert len(want) > 20
    text = {d: decontaminate.normal(t) for d, t in docs + extra}
    for r in got:
        if r.distance == 0:
            item = items[r.item_id if r.item_id is not None else 1][1]
            assert text[r.doc_id][r.begin : r.end] == decontaminate.normal(item)
    clean = decontaminate.clean_documents(df, bench, block_chars=block)
    assert clean.columns == df.columns
    leaked = {w[0] for w in want}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs + extra if d not in leaked)
    assert decontaminate.matches(df, bench.limit(0)).count() == 0
    assert decontaminate.matches(df.limit(0), bench).count() == 0


def test_myers():
    rnd = random.Random(8)
    for _ in range(400):
        a = "".join(rnd.choices("abc", k=rnd.randint(1, 90)))
        b = "".join(rnd.choices("abc", k=rnd.randint(0, 120)))
        masks = decontaminate.letter_masks(a)
        assert decontaminate.myers(masks, len(a), b)[0] == _best_inside(a, b)
        best = min(_edits(a, b[:j]) for j in range(len(b) + 1))
        assert decontaminate.myers(masks, len(a), b, anchored=True)[0] == best


# --- extraction ---------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- c --><div class="ad">Buy</div>
<div><p>Welcome to {host}</p></div>
<article><h1>Title {n} &amp; more</h1><p><b>First {n}<br>line&nbsp;two<p>Second   &lt;x&gt;</p><aside>side</aside>
<form><input value="q">go</form><ul><li>one<li>two</ul><div class="comments"><p>reader {n}</p></div></article>
<footer>&copy; all</footer></body></html>"""
TEXT = "Title {n} & more\n\nFirst {n} line two\n\nSecond <x>\n\none\n\ntwo"


def test_extract(spark):
    rows = [(i, f"http://a.example.org/{i}", PAGE.format(n=i, host="a")) for i in range(6)]
    rows += [(10, None, PAGE.format(n=10, host="z")), (11, "http://b.example", None), (12, "http://b.example", ""),
             (13, "http://b.example", "plain &amp; text"), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, 0, "t") for r in rows], "page_id long, url string, html string, host int, text string")
    got = html_extract.extract(pages).collect()
    want = [(i, u, {11: "", 12: "", 13: "plain & text"}.get(i, TEXT.format(n=i))) for i, u, _ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_template_removal(spark):
    # No article element: what recurs on the host goes, what is the page's own stays.
    page = "<body><div>Our shop since 1999</div><div><p>Own text {n}</p></div><div>Call us</div>"
    rows = [(i, f"http://shop.example/{i}", "<title>t%d</title>" % i + page.format(n=i)) for i in range(8)]
    # Copies of one page are one page.
    rows += [(100 + i, f"http://copy.example/{i}", "<title>same</title>" + page.format(n=1)) for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    assert got[3] == "Own text 3"
    assert got[103] == "Our shop since 1999\n\nOwn text 1\n\nCall us"


@pytest.mark.parametrize(("html", "want"), [
    ("a<p>b<p>c</div>d", "a\n\nb\n\nc d".replace("c d", "cd")), ("<p>a <b>b", "a b"), ("x < y & z &unknown; &#233;", "x < y & z &unknown; é"),
    ("<p>cut off at the <b", "cut off at the"), ("<main><p>in</p></main><p>out</p>", "in"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2\n\n3"),
    ("<p hidden>h</p><p style='display: none'>n</p>v", "v"), ("<script>x", ""), ("<p>" * 5000 + "deep", "deep"), ("<div>" * 5000 + "deep", "deep"),
])
def test_main_text(html, want):
    assert html_extract.main_text(html) == want


def test_templates_inside_articles(spark):
    # A box in the articles of half of a small host's pages goes; a passage that as many share stays, and so does a
    # copied article.  Every page has the same first heading.
    box = '<div class="x1"><p>Join {n} readers</p><p>Write to us</p></div><p><a href="/a">More by the author</a></p>'
    page = "<title>t</title><body><article><h1>Site</h1><p>Own text of page {n}, long enough to be the larger part of it, " \
           "whatever else the site puts below</p>{shared}{box}</article>"
    shared = "<p>A passage that pages share</p>"
    rows = [(i, f"http://small.example/{i}", page.format(n=i, shared=shared, box=box.format(n="many") if i % 2 else "")) for i in range(8)]
    # A box in one section of a large host.
    rows += [(100 + i, f"http://large.example/{'news' if i < 4 else f's{i}'}/{i}",
              page.format(n=i, shared="", box=box.format(n="news") if i < 4 else "")) for i in range(40)]
    # The same article under other headings is no template.
    copy = "<article><h1>Copy {n}</h1><div><p>One article, copied</p><p>with both of its paragraphs</p></div></article>"
    rows += [(200 + i, f"http://copies.example/{i}", copy.format(n=i)) for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    own = "Site\n\nOwn text of page {n}, long enough to be the larger part of it, whatever else the site puts below"
    assert all(got[i] == own.format(n=i) + "\n\nA passage that pages share" for i in range(8))
    # There the heading is on all of 40 pages.
    assert all(got[100 + i] == own.format(n=i).removeprefix("Site\n\n") for i in range(40))
    assert all(got[200 + i] == f"Copy {i}\n\nOne article, copied\n\nwith both of its paragraphs" for i in range(4))


_BODY = "<article><h1>T</h1><p>Body of the article, long enough.</p></article>"


@pytest.mark.parametrize(("html", "want"), [
    (f'<div class="layout with-sidebar">{_BODY}<div class="sidebar"><p>side</p></div></div>', "T\n\nBody of the article, long enough."),
    (f'<div id="content-side">{_BODY}</div>', "T\n\nBody of the article, long enough."),
    (f'<form>{_BODY}<div class="share-buttons">share</div></form>', "T\n\nBody of the article, long enough."),
    (f'<form><div class="page sidebar">{_BODY}</div></form><footer>f</footer>', "T\n\nBody of the article, long enough."),
    ("<form><main><p>in</p><form><p>ask</p></form></main></form>", "in"),
    ('<main><h1>T</h1><div class="toc wide"><p>the whole text</p></div></main>', "T\n\nthe whole text"),
    # What is dropped as before: comments and banners, however long.
    (f'{_BODY}<div class="comments"><article><p>{"a long comment " * 9}</p></article></div>', "T\n\nBody of the article, long enough."),
    ('<div class="post"><p>The text of the post</p></div><div class="comments"><article><p>short</p></article></div>', "The text of the post"),
    ('<div>The text without paragraphs</div><div class="cookie-banner"><p>We use cookies</p></div>', "The text without paragraphs"),
    ('<p>a</p><div id="main-menu">m</div><div class="ad">Buy</div>', "a"), ('<div class="ad">Buy now</div>x', "x"),
])
def test_wrappers_keep_the_article(html, want):
    assert html_extract.main_text("<body>" + html) == want


# --- language -----------------------------------------------------------------------------


def test_language(spark):
    rnd = random.Random(6)
    letters = {"aa": "abcdefg", "bb": "hijklmn", "cc": "opqrstu"}
    text = lambda lang, n: " ".join("".join(rnd.choices(letters[lang], k=5)) for _ in range(n))
    langs = list(letters)
    docs = [(i, text(langs[i % 3], 20), langs[i % 3], f"s{i % 3}") for i in range(90)]
    docs += [(200, None, None, "s0"), (201, "", "bb", "s1"), (202, "zzz", None, None), (1, docs[1][1], docs[1][2], docs[1][3])]
    pages = [(i, f"http://h{i % 3}.x{i % 3}/{i}", f"<html lang='{langs[i % 3]}'><p>{text(langs[i % 3], 10)}</p>") for i in range(60)]
    pages += [(100, "http://h2.x2/empty", "<html lang='cc'></html>"), (101, None, None), (102, "http://h0.x0/e", "")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, lang string, source string, host int")
    p = spark.createDataFrame([(*r, 1) for r in pages], "page_id long, url string, html string, declared int")
    got = language_id.identify(d, p).collect()
    assert len(got) == len(docs) + len(pages)
    by_doc = {r.doc_id: r for r in got if r.kind == "document"}
    by_page = {r.page_id: r for r in got if r.kind == "page"}
    assert all(by_doc[i].language == langs[i % 3] for i in range(90))
    assert all(by_page[i].language == langs[i % 3] and by_page[i].declared == langs[i % 3] for i in range(60))
    assert by_doc[200].language == "aa" and by_doc[201].language == "bb"  # told by their sources
    assert by_page[100].language == "cc" and by_page[102].language == "aa"
    assert all(0 < r.confidence <= 1 for r in got)
    none = language_id.identify(d.withColumn("lang", d.lang.substr(9, 0)).filter("lang is null"), p)
    assert none.count() == 1 + 1 + len(pages) and none.filter("language is not null").count() == 0
    assert language_id.identify(d.limit(0), p.limit(0)).count() == 0


def test_language_trains_on_every_labelled_row(spark):
    import zlib

    rare = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % language_id.FOLDS == 0)
    docs = [(i, "abc abd acd " * 5, "aa", "s") for i in range(20)] + [(rare, "xyz xzy yxz " * 5, "zz", "s")]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    assert language_id.train(d)[0] == ["aa", "zz"]
    assert language_id.train(d, held_out=True)[0] == ["aa"]
