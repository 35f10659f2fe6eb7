"""HTML extraction, URL filters, the inverted multi-index and the pipeline."""

import re
import time

import corpus_pipeline
import numpy as np
import pytest
from brute import COLUMNS, components, empty
from conftest import SMALL, TABLES, TESTDATA

from reviewlens.llm import html_extraction as html
from reviewlens.llm import language, quality, queries, secret_scan, url_filter, vector_dedup
from reviewlens.llm import simhash as near
from reviewlens.llm.common import host_of, path_of

# ---------------------------------------------------------------- HTML


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="comments-open">
<header><h1>Site</h1></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>A &amp; B</h1></header><p>First <b>bold</b>
text.<p>Second&nbsp;&#233;<br>line</p><aside>See also</aside><div class="ad-slot">Buy</div>
<form><input value="x">Mail</form><script>var a = "</p><p>no</p>";</script>
<ul><li>one<li>two</ul><section class="comments"><article class="comment"><p>Great!</p></article></section></article></main>
<div id="sideBar">side</div><footer>(c)</footer></body></html>"""


def test_article_without_its_surroundings():
    assert html.main_text(PAGE) == "A & B\nFirst bold text.\nSecond é line\none\ntwo"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        ("<p>a<p>b", "a\nb"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("</p></div>x<", "x<"),
        ("<article><p>a</p><!-- <p>b</p> --><p>c", "a\nc"),
        ("<p hidden>a</p><p style='display: none'>b</p><p>c</p>", "c"),
        ("<script>never closed", ""),
        ("<a href='x>y'>link</a> 1 < 2", "link 1 < 2"),
        ("<body><nav>menu</nav></body>", ""),
        ("<article>x</article><article>y</article>", "x\ny"),
        ("<p>" + "a " * 50_000 + "</p>", ("a " * 50_000).strip()),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
    ],
)
def test_broken_and_extreme_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("wrapper", ["content no-sidebar", "has-sidebar", "hasSidebar", "search-page", "legal", "share", "notice", "related"])
def test_what_holds_the_article_is_never_dropped(wrapper):
    page = f"<body><nav>menu</nav><div class='{wrapper}'><article><h1>T</h1><p>Body of it</p></article></div></body>"
    assert html.main_text(page) == "T\nBody of it"
    page = f"<body><nav>menu</nav><div id='{wrapper}'><p>{'Body of it. ' * 9}</p></div><div class='{wrapper}'>x</div></body>"
    assert html.main_text(page) == ("Body of it. " * 9).strip()


def test_forms_around_pages_and_words_of_paragraphs():
    page = "<body><form action='/x'><nav>menu</nav><article><p>Body <label>of it</label></p><p class='legal-note'>n</p><p id='search'>s</p></article></form></body>"
    assert html.main_text(page) == "Body of it\nn\ns"
    readers = "<section class='comments'><article><p>Great!</p></article></section>"
    assert html.main_text(f"<body><article><p>A body of some length</p></article>{readers}</body>") == "A body of some length"


@pytest.mark.parametrize(
    "page",
    ["<div>" * 60_000, "<a '" * 250_000, "<div>" * 50_000 + "</p>" * 100_000, "<p><table>" + "<div>" * 150_000, "<ul><li>" * 80_000, "<! " * 300_000, "<a '><b \">" * 60_000],
)
def test_hostile_pages_take_linear_time(page):
    began = time.time()
    html.main_text(page)
    assert time.time() - began < 20  # about a second; hours if some step looked through all open elements


def test_host_counts_equal_brute_force(spark):
    """A host of three sections with menus of their own, a footer on all pages, and copies of one page."""
    rows = []
    for i in range(60):
        section = i % 3
        menu = f"<div><div><a>section {section}</a></div><div>rubric {section}</div></div>"
        rows.append((f"http://a.example/{i}", f"<body>{menu}<div><p>Text {i} {'word ' * 20}</p></div><div>all pages</div></body>"))
    rows += [("http://a.example/copy", "<body><div><p>The same page</p></div><i>note</i></body>")] * 30
    found = {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}
    assert [found[i] for i in range(60)] == [f"Text {i} {'word ' * 20}".strip() for i in range(60)]
    assert {found[i] for i in range(60, 90)} == {"The same page note"} or {found[i] for i in range(60, 90)} == {"The same page\nnote"}
    around = {}
    for _, page in rows:
        for digest, inside, other in html.subtrees(page):
            around.setdefault((digest, inside), set()).add(other)
    of = len(around[None, False])
    expected = {d for (d, inside), others in around.items() if d is not None and not inside and len(others) >= html.LEAST_PAGES}
    row = html.templates(pages(spark, rows)).collect()[0]
    assert set(row.hashes) == {d for d in expected if len(around[d, False]) > of * html.LEAST_SHARE}
    assert set(row.part) == {d for d in expected if of * html.PART_SHARE < len(around[d, False]) <= of * html.LEAST_SHARE}
    assert row.hashes and row.part


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, hash string, host string")


def test_template_subtrees_go_and_articles_stay(spark):
    """A block that recurs on a host goes, whatever it is called; a copied article stays."""
    same = "<div><span>Our site is the best</span></div>"
    rows = [(f"http://a.example/{i}", f"<body>{same}<div>Body number {i}</div></body>") for i in range(12)]
    rows += [(f"http://b.example/{i}", f"<body>{same}<div>Other {i}</div></body>") for i in range(3)]
    rows += [(f"http://c.example/{i}", "<body><div>junk</div><article><p>copied</p></article></body>") for i in range(12)]
    found = {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}
    assert [found[i] for i in range(12)] == [f"Body number {i}" for i in range(12)]
    assert [found[i] for i in range(12, 15)] == [f"Our site is the best\nOther {i}" for i in range(3)]
    assert {found[i] for i in range(15, 27)} == {"copied"}


def test_template_inside_articles_goes_and_text_outside_stays(spark):
    """Blocks under many different articles go; copied articles stay; teaser cards are not the text of a page."""
    box = "<div><p>Read more on our site</p></div>"
    rows = [(f"http://a.example/{i}", f"<body><article><p>Own text {i}</p>{box}</article></body>") for i in range(12)]
    rows += [("http://a.example/copy", f"<body><article><p>copied</p><p>lines</p></article><i>{i}</i></body>") for i in range(8)]
    rows += [("http://b.example/", "<body><div>" + "A long body. " * 9 + "</div><article>Card</article></body>")]
    found = {r.page_id: r.text for r in html.extract(pages(spark, rows)).collect()}
    assert [found[i] for i in range(12)] == [f"Own text {i}" for i in range(12)]
    assert {found[i] for i in range(12, 20)} == {"copied\nlines"}
    assert found[20] == ("A long body. " * 9).strip() + "\nCard"


def test_extraction_of_awkward_pages(spark):
    rows = [(None, None), (None, "<p>x"), ("no scheme", ""), ("http://A.example", "<p>y</p>")] + [("http://a.example", "<p>y</p>")] * 2
    found = html.extract(pages(spark, rows)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in found) == [(0, "", 0), (1, "x", 1), (2, "", 0), (3, "y", 1), (4, "y", 1), (5, "y", 1)]
    assert html.extract(pages(spark, rows).where("false")).collect() == []


def test_op3_gives_every_article(spark):
    """The test pages are articles made of documents: each text is its heading and a whole document."""
    source = {" ".join(r.text.split()) for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()}
    table = {r.page_id: r for r in spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet").collect()}
    rows = queries.op3_html_extraction(spark, f"{TESTDATA}/sf0.01").collect()
    assert len(rows) == len(table)
    for r in rows:
        body = r.text.split("\n", 1)[1]
        assert " ".join(body.split("\n")) in source
        assert r.url == table[r.page_id].url and r.n_chars == len(r.text)


# ---------------------------------------------------------------- URLs


def test_op4_equals_sql(spark):
    import duckdb
    from compare import duck_table, spark_table

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        assert spark_table(queries.QUERIES[name](spark, SMALL)) == duck_table(connection, sql), name


@pytest.mark.parametrize(
    "url, host, path",
    [
        (None, "", ""),
        ("nothing", "", ""),
        ("http://Ex.ORG", "ex.org", ""),
        ("http://ex.org?q=/a#f", "ex.org", ""),
        ("http://ex.org/A/b?x#y", "ex.org", "/A/b"),
        ("http://ex.org#/a", "ex.org", ""),
        ("x?u=http://ex.org/é", "ex.org", "/é"),
        ("http://ÄB.org/", "Äb.org", "/"),
        ("http://a.org/x\ny", "a.org", "/x\ny"),
        ("://a/b", "a", "/b"),
    ],
)
def test_host_and_path(spark, url, host, path):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(url,)], "url string").select(host_of(F.col("url")), path_of(F.col("url"))).first()
    assert tuple(row) == (host, path)


RULES = [url_filter.parse(r) for r in queries.URL_RULES]


def verdicts(spark, rows, redirects=None):
    found = url_filter.judge(pages(spark, rows), RULES, redirects).collect()
    return {r.page_id: (r.rule, r.verdict) for r in found}


def test_longest_rule_wins_on_hosts_and_subdomains(spark):
    rows = [
        ("http://www.example.org/es/1", None),
        ("http://example.org/en/17", None),
        ("http://myexample.org/es/1", None),
        ("http://x.com/de/", None),
        ("http://x.com/fr/", None),
        ("http://x.com/en/", None),
        ("http://x.org", None),
        (None, None),
    ]
    assert verdicts(spark, rows) == {
        0: ("example.org/es/", "block"),
        1: ("example.org/en/1", "block"),
        2: ("org/", "allow"),
        3: ("com/de/", "block"),
        4: ("com/fr/", "allow"),
        5: (None, "allow"),
        6: (None, "allow"),
        7: (None, "allow"),
    }


def test_blocks_follow_links_to_aliases_but_not_over_an_allow(spark):
    rows = [
        ("http://a.net/1", '<link rel="canonical" href="http://b.net/2">'),
        ("http://b.net/2#x", "<meta http-equiv='refresh' content='0; url=https://x.com/de/9'>"),
        ("http://y.org/ok", '<link href="http://x.com/de/9" rel=canonical>'),
        ("http://a.net/other", "<p>canonical</p>"),
        ("http://a.net/dir/3", '<link rel="canonical" href="../x"><link rel="canonical" href="/1">'),
        ("http://c.net/", None),
        ("http://a.net/1", None),
        ("https://c.net/?q=1", '<link rel=canonical href="//a.net/1">'),
    ]
    found = verdicts(spark, rows)
    # Row 4 names two pages as canonical, the second of which is blocked: every link of a page counts.
    assert [found[i][1] for i in (0, 1, 4, 6, 7)] == ["block"] * 5
    assert found[2] == ("org/", "allow")
    assert [found[i][1] for i in (3, 5)] == ["allow"] * 2
    moved = spark.createDataFrame([("http://c.net", "http://x.com/de/1"), (None, "http://a.net")], "source string, target string")
    assert verdicts(spark, rows, moved)[5] == (None, "block")


def test_long_rule_lists_decide_like_short_ones(spark, monkeypatch):
    rng = np.random.default_rng(9)
    hosts = ["example.org", "x.com", "com", "www.x.com", "net"]
    rules = [url_filter.Rule(str(rng.choice(["allow", "block"])), str(rng.choice(hosts)), "/" + "ab/"[: rng.integers(0, 4)] + str(rng.integers(0, 3))) for _ in range(40)]
    rules += [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "x.com", "/"), url_filter.Rule("block", "x.com", "/")]
    urls = [f"http://{h}/{p}" for h in (*hosts, "Example.ORG", "a.b.net", "notnet", "") for p in ("", "0", "1", "ab/1", "ab/12", "a0", "2?x#y")]
    urls += [None, "none", "http://x.com", *urls[:5]]
    rows = [(u, '<link rel=canonical href="http://net/0">' if i % 9 == 0 else "") for i, u in enumerate(urls)]
    frame = pages(spark, rows)
    short = sorted(map(tuple, url_filter.judge(frame, rules).collect()), key=repr)
    monkeypatch.setattr(url_filter, "MOST_RULES", 0)
    assert sorted(map(tuple, url_filter.judge(frame, rules).collect()), key=repr) == short
    assert {r[4] for r in short} == {"allow", "block"}


def test_every_link_of_a_page_counts(spark):
    rows = [
        ("http://a.net/1", '<link rel=canonical href="http://b.net/"><link rel=canonical href="http://x.com/de/1"><meta http-equiv=refresh content="0; url=/z">'),
        ("http://b.net/", None),
        ("http://a.net/z", None),
    ]
    assert {r.page_id: r.verdict for r in url_filter.judge(pages(spark, rows), [url_filter.parse("block com/de/")]).collect()} == {0: "block", 1: "block", 2: "block"}


def test_url_filter_without_rows(spark):
    assert url_filter.judge(pages(spark, [(None, None)]).where("false"), RULES).collect() == []
    assert len(url_filter.judge(pages(spark, [("http://a/b", None)] * 3), []).collect()) == 3
    with pytest.raises(ValueError):
        url_filter.parse("maybe example.org/")


# ---------------------------------------------------------------- vectors


def near_by_brute_force(vectors, threshold=0.95):
    sound = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n = len(vectors)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and sound[i] and sound[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                linked[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold
    return linked


def check_vectors(spark, vectors, kind="array<double>"):
    rows = spark.createDataFrame([(10 * i + 10, v, "u", 1) for i, v in enumerate(vectors)], f"vec_id long, embedding {kind}, unit string, n int")
    found = {r.vec_id: r for r in vector_dedup.near_vectors(rows).collect()}
    linked = near_by_brute_force(vectors)
    ids = [10 * i + 10 for i in range(len(vectors))]
    assert [found[i].n_links for i in ids] == linked.sum(axis=1).tolist()
    assert [found[i].component_id for i in ids] == components(linked | np.eye(len(ids), dtype=bool), ids)
    assert all(found[i].kept == (found[i].component_id == i) for i in ids)


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    check_vectors(spark, [
        None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [-1.0, 0.0],
        [0.0, -0.0], [1e300, 1e299], [1e-300, 0.0], [1.0, 0.3], [1.0], [3.0], [-2.0], [1.0, 0.0, 0.0],
    ])


@pytest.mark.parametrize("block", [8, 1024])
def test_clusters_of_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    spread = [c + rng.normal(size=16) * s for c in centres for s in (0, 0.05, 0.1, 0.1, 0.2)]
    crowd = [centres[0] + rng.normal(size=16) * 0.05 for _ in range(60)]
    check_vectors(spark, [v.tolist() for v in spread + crowd])


def planted(rng, n, scale, low=0.95):
    """Vectors whose coordinates have the given spread, and a partner of each at a cosine from ``low`` to 1, differing alike."""
    x = rng.normal(size=(n, len(scale))) * scale
    x /= np.linalg.norm(x, axis=1)[:, None]
    aside = rng.normal(size=x.shape) * scale
    aside -= (aside * x).sum(axis=1)[:, None] * x
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    cosine = rng.uniform(low, 1, size=(n, 1)) if low < 1 else np.ones((n, 1))
    return x, cosine * x + np.sqrt(1 - cosine**2) * aside, aside


SPREADS = {"even": np.ones(64), "uneven": 1 / np.arange(1, 65)}


@pytest.mark.parametrize("spread", SPREADS)
def test_recall_of_op6_on_planted_pairs(spark, spread, tmp_path):
    """Against all pairs by brute force: no link below the threshold, and nearly all above it."""
    x, y, _ = planted(np.random.default_rng(7), 2500, SPREADS[spread])
    table = np.concatenate([x, y]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(table)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    unit = table.astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    assert linked.sum() >= 2 * 2500 * 0.98
    found = {r.vec_id: r for r in queries.op6_embedding_near_dedup(spark, str(tmp_path)).collect()}
    links = np.array([found[i].n_links for i in range(len(table))])
    assert (links <= linked.sum(axis=1)).all()
    assert links.sum() >= 0.99 * linked.sum()


@pytest.mark.parametrize("spread", SPREADS)
def test_recall_at_the_threshold_itself(spread):
    """Pairs exactly at the threshold are the hardest to meet; the traversal visits few cells for most of them."""
    rng = np.random.default_rng(5)
    x, _, aside = planted(rng, 5000, SPREADS[spread])
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * aside
    index = vector_dedup.fit(x, 100_000)
    home, visits = index.cells(x)
    of_other, back = index.cells(y)
    met = np.mean([h in v or g in w for g, v, h, w in zip(home, visits, of_other, back, strict=True)])
    assert met >= 0.985
    assert np.mean([len(v) for v in visits]) < 0.15 * index.size**2


def test_traversal_goes_from_near_to_far():
    x, _, _ = planted(np.random.default_rng(8), 300, np.ones(16))
    index = vector_dedup.fit(x, 20_000)
    (_, low1), (_, low2) = index.bounds(x)
    home, visits = index.cells(x)
    for i, cells in enumerate(visits):
        bound = low1[i][:, None] + low2[i][None, :]
        walked = [bound[c // index.size, c % index.size] for c in cells]
        assert walked == sorted(walked) and len(set(cells)) == len(cells)
        assert set(cells) == set(np.flatnonzero(bound.ravel() <= index.reach).tolist()) and home[i] in cells


def test_no_vectors(spark):
    assert vector_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# ---------------------------------------------------------------- pipeline


def test_pipeline_equals_its_stages_one_by_one(spark):
    """Stage by stage over collected rows, with the plain decision of each."""
    from brute import base_quality, five_words, secrets

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.train(frame.where(~language.held_out()))
    names, scores = model.predict([r.text for r in docs.values()])
    kept = [d for d, n, s in zip(docs, names, scores, strict=True) if n != "und" and s >= language.LEAST_SCORE]
    table = quality.measured([docs[d].text for d in kept])
    patterns = quality.pattern(table)
    unique, counts = np.unique(patterns, return_counts=True)
    good = quality.estimate(unique, counts).posterior(patterns) >= 0.5
    kept = [d for d, g in zip(kept, good, strict=True) if g and base_quality(docs[d].text)[0] >= 50 and 2 * base_quality(docs[d].text)[4] <= base_quality(docs[d].text)[0]]
    sets = [five_words(docs[d].text) for d in kept]
    roots = components(np.array([[5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets]), kept)
    kept = [d for d, r in zip(kept, roots, strict=True) if d == r]
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(kept)
    stage = frame
    for name, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, stage, SMALL)
        assert stage.columns == frame.columns, name
    for r in stage.collect():
        assert not secrets(r.text) and (bool(secrets(docs[r.doc_id].text)) == (r.text != docs[r.doc_id].text) or secret_scan.ADDED)


def test_pipeline_without_documents(spark):
    stage = empty(spark)
    for _, function in corpus_pipeline.STAGES:
        stage = function(spark, stage, SMALL)
    assert stage.collect() == []


def test_pipeline_keeps_columns_it_does_not_know(spark):
    from brute import awkward

    docs = awkward(spark)
    for name, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, docs, SMALL)
        assert stage.columns == docs.columns, name
        stage.collect()
    assert re.fullmatch("doc_id long, text string.*", COLUMNS) and near.RADIUS == 4
