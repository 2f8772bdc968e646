import re
from html import unescape

import pytest

from postingloom.llm.html_extract import blocks, host_of, main_text
from postingloom.llm.queries import op9_main_text

SCHEMA = "page_id bigint, url string, html string, text string"

CASES = {
    "<nav>menu</nav><article><h1>T&eacute;st &amp; x</h1><p>a <b>b</b>c&nbsp;d\n e<p>f</article><footer>g</footer>": "Tést & x a bc d e f",
    "<header>top</header><main><p>one<div class='ad-banner'>buy</div><p>two<aside>side</aside></main>": "one two",
    "<article><p>x<form><input>q</form><script>if (a < b) '</p>'</script><style>p{}</style>y</article>": "x y",
    "<article>a<section id=comments><p>c<article>d</article></section>b</article>": "a b",
    "<article>a<article class='comment'>c</article></article><article class=related>r</article>": "a",
    "<div class='page has-sidebar'><article><p>kept</article><div class=sidebar>s</div></div>": "kept",
    "<article>a<!-- <p>no</p> -->b<br/>c</article>": "ab c",
    "<article><p>open <b>bold<br><p>next</article><footer>f": "open bold next",
    "<article>1 < 2 &lt; 3 &am &amp &#233;&#x20AC;</article>": "1 < 2 < 3 &am & é€",
    "<article><div hidden>h</div><p style='display: none'>n</p>v</article>": "v",
    "<article class='post'><header class='entry-header'><div class='header'><h1>H</h1></div></header>b</article>": "H b",
    "<head><title>t</title><body><article>x</article>": "x",
    "<ARTICLE><P TITLE='a>b'>Up</P></ARTICLE>": "Up",
}


@pytest.mark.parametrize("html", CASES)
def test_article(html):
    assert " ".join(blocks(html)[0]) == CASES[html]


WRAPPED = {
    "<body class='overflow-hidden'><div class='lg:hidden' data-title='the hidden valley'><article>a</article></div>": "a",
    "<div class='content-sidebar-wrap'><main>a</main><div class='sidebar'>s</div></div>": "a",
    "<div id='page-with-sidebar'><main>a</main></div>": "a",
    "<form action='x'><nav>n</nav><div><article>a<button>b</button></article></div><footer>f</footer></form>": "a",
    "<nav><a>menu</a><main>a</main>": "a",
    "<header>top<article>a</article><footer>f": "a",
    "<main><h1>T</h1><div class='content-sidebar-wrap'><article>a</article></div></main>": "T a",
    # What is hidden, and teasers beside an article, still go.
    "<div hidden><article>h</article></div><div hidden='hidden'><main>h</main></div><article>a</article>": "a",
    "<div aria-hidden=true><main>h</main></div><div style='color:red; display:none'><main>h</main></div><main>a</main>": "a",
    "<nav>m<main>a<aside><article>teaser</article></aside><div class='comments'><article>c</article></div>b</main>": "a b",
}


@pytest.mark.parametrize("html", WRAPPED)
def test_article_inside_chrome(html):
    assert " ".join(blocks(html)[0]) == WRAPPED[html]


IN_ARTICLE = {
    "<article><h2 id='related-work'>Related work</h2><p>x</article>": "Related work x",
    "<article><h2 id=comments>Comments on it</h2><h3 id='social-security'>S</h3></article>": "Comments on it S",
    "<article><section id='search-algorithms'><p>x</section><div class='widget-theory'>y</div></article>": "x y",
    "<article>a<div class='user-feedback'>great post</div>b</article>": "a b",
    "<article>a<div class='related-posts'>r</div><ul class='share-buttons'>s</ul><div class='ad banner'>t</div>b</article>": "a b",
    "<article>a<div id='comments'>c</div><div class='comment-list'>d</div><div role=navigation>n</div>b</article>": "a b",
    "<article><div data-id='comments' data-class='ad'>kept</div></article>": "kept",
    "<article><div class='post-content'><div class='entry-body'>kept</div></div></article>": "kept",
}


@pytest.mark.parametrize("html", IN_ARTICLE)
def test_names_inside_an_article(html):
    assert " ".join(blocks(html)[0]) == IN_ARTICLE[html]


@pytest.mark.parametrize(
    "html",
    ["<div>" * 60_000 + "</x>" * 60_000, "<i>" + "<div>" * 60_000 + "</i>" * 60_000, "<head>" + "<b>" * 60_000 + "<body>" * 60_000,
     "<div>" + "<b>" * 60_000 + "<p>" * 60_000],
)
def test_time_grows_with_the_page(html):
    import time

    start = time.perf_counter()
    blocks(html + "<article>x")
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("html", ["", "<", "<p", "<!--", "<script>", "</p></p>", "&", "<a href='", "<article>", "<![CDATA[x"])
def test_broken_html(html):
    assert blocks(html)[0] == []


def test_pages_without_article(spark):
    notice = "Subscribe to our letter for more about all the news of this town today and tomorrow"
    rows = [(k, "http://a.example.com/x", f"<body><p>own words of page {k}</p><p>{notice}</p><nav>n</nav></body>", "old") for k in range(5)]
    rows += [(10, "http://b.example.com/", f"<p>{notice}</p>", "old"), (11, None, None, None), (11, "http://a.example.com", "", None)]
    found = sorted(((r.page_id, r.text, r.n_chars) for r in main_text(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    expected = [(k, f"own words of page {k}", 19) for k in range(5)] + [(10, notice, len(notice)), (11, "", 0), (11, "", 0)]
    assert found == sorted(expected, key=str)


def test_repeated_passages_of_articles_stay(spark):
    same = " ".join(f"w{k}" for k in range(60))
    rows = [(k, "http://a.example.com/", f"<article>{same} p{k}</article>", None) for k in range(6)] * 2
    assert sorted(r.text for r in main_text(spark.createDataFrame(rows, SCHEMA)).collect()) == sorted([f"{same} p{k}" for k in range(6)] * 2)
    assert main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_page(spark):
    html = "<article>" + "<p>word &amp; word</p>" * 50_000 + "</article>"
    found = main_text(spark.createDataFrame([(1, None, html, None)], SCHEMA)).first()
    assert found.text == " ".join(["word & word"] * 50_000)


def test_host(spark):
    urls = ["https://User@Www.Example.com:80/a?b", "//x.org", "no url", None]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(host_of("url")).collect()] == ["www.example.com", "x.org", "", ""]


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r.page_id: r for r in op9_main_text(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for page_id, url, html in rows:
        inner = re.search("<article>(.*)</article>", html, re.S).group(1)
        expected = " ".join(unescape(re.sub("<[^>]*>", " ", inner)).split())
        row = found[page_id]
        assert (row.url, row.text, row.n_chars) == (url, expected, len(expected))


def _page(k, body, host="a.example.com"):
    return (k, f"http://{host}/{k}", body, None)


def test_repeats_count_over_all_pages_of_a_host(spark):
    """What a page without an article shares with menus and articles of other pages goes; they themselves stay whole."""
    notice = "Subscribe to our letter for more about all the news of this town today and tomorrow"
    rows = [
        _page(1, f"<nav>{notice}</nav><article>first own</article>"),
        _page(2, f"<article>second {notice} own</article>"),
        _page(3, f"<p>third {notice} own</p>"),
        _page(4, f"<p>fourth {notice} own</p>", "b.example.com"),
        _page(5, f"<footer>{notice}</footer><p>fifth</p>", "b.example.com"),
    ]
    found = {r.page_id: (r.text, r.n_repeated) for r in main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {
        1: ("first own", 16), 2: (f"second {notice} own", 16), 3: ("third own", 16), 4: (f"fourth {notice} own", 0), 5: ("fifth", 0),
    }


def test_suffix_array_against_brute_force(spark):
    import random

    from postingloom.llm.html_extract import repeated_places

    draw, run, n_pages = random.Random(3), 4, 3
    streams = []
    for k in range(60):
        words = [draw.choice("abcd") for _ in range(draw.choice([0, 2, 3, 5, 12, 20]))]
        streams.append((k, f"h{k % 3}", " ".join(words)))
    streams += [(k + 100, host, f"x{k} p q r s t y{k}") for k, host in enumerate(["h0", "h0", "h0", "h1", "h1", None, "h2"])]
    pages_with: dict = {}
    for page, host, text in streams:
        words = text.split(" ")
        for at in range(len(words) - run + 1):
            pages_with.setdefault((host, *words[at : at + run]), set()).add(page)
    expected = {}
    for page, host, text in streams:
        words = text.split(" ")
        for at in range(len(words) - run + 1):
            if len(pages_with[host, *words[at : at + run]]) >= n_pages:
                expected.setdefault(page, set()).update(range(at, at + run))
    frame = spark.createDataFrame(streams, "page bigint, host string, words string")
    found = {r.page: r.covered for r in repeated_places(frame, run, n_pages).collect()}
    assert {page: set(places) for page, places in found.items()} == expected and 10 < len(expected) < 60
    assert all(len(places) == len(set(places)) for places in found.values())


def test_suffixes_are_sorted_over_range_partitions(spark):
    from postingloom.llm.html_extract import repeated_places

    frame = spark.createDataFrame([(1, "h", "a b")], "page bigint, host string, words string")
    assert "rangepartitioning(host" in repeated_places(frame, 2, 1)._jdf.queryExecution().executedPlan().toString()


def test_equal_windows_have_equal_marks():
    from postingloom.llm.html_extract import window_marks

    words = [f"w{k}" for k in range(30)]
    marks = window_marks(words, 10)
    assert len(marks) == 21 and len(set(marks.tolist())) < 15
    assert window_marks(["x", *words[5:15], "y", "z"], 10)[1] == marks[5]
    assert [len(window_marks(words[:n], 10)) for n in (0, 9, 10)] == [0, 0, 1]


def _shuffled_bytes(spark):
    from pathlib import Path

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f: f.stat().st_size for folder in folders for f in Path(str(folder)).rglob("shuffle_*.data")}


def test_words_are_not_shuffled(spark):
    """Marks go to their shards, in a few bytes each; the words of the pages stay where they are stored."""
    import random

    draw = random.Random(5)
    rows = [_page(k, "<p>" + " ".join(f"{draw.getrandbits(60):x}" for _ in range(1000)) + "</p>") for k in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    assert frame.count() == 300
    before = _shuffled_bytes(spark)
    assert {(r.n_chars > 15_000, r.n_repeated) for r in main_text(frame).collect()} == {(True, 0)}
    written = sum(size for f, size in _shuffled_bytes(spark).items() if f not in before)
    assert written < 0.2 * sum(len(html) for _, _, html, _ in rows)


def test_repeats_over_many_chunks(spark, monkeypatch):
    """Copies count once wherever they lie, and each page of each chunk gets what repeats."""
    import random

    from postingloom.llm import html_extract

    monkeypatch.setattr(html_extract, "PAGES", 2)
    draw, run, n_pages = random.Random(4), 4, 3
    texts = [" ".join(draw.choice("abc") for _ in range(draw.choice([0, 3, 5, 9, 15]))) for _ in range(40)]
    bodies = [(f"h{draw.randrange(2)}.org", text) for text in texts] + [("h0.org", "n o t e s")] * 7
    bodies += [draw.choice(bodies) for _ in range(30)]
    pages_with: dict = {}
    for host, text in bodies:
        words = text.split(" ")
        for at in range(len(words) - run + 1):
            pages_with.setdefault((host, *words[at : at + run]), set()).add(text)
    expected = {}
    for k, (host, text) in enumerate(bodies):
        words = text.split(" ")
        places = {p for at in range(len(words) - run + 1) if len(pages_with[host, *words[at : at + run]]) >= n_pages for p in range(at, at + run)}
        expected[k] = " ".join(word for at, word in enumerate(words) if at not in places), len(places)
    frame = spark.createDataFrame([_page(k, f"<p>{text}</p>", host) for k, (host, text) in enumerate(bodies)], SCHEMA).repartition(3)
    found = {r.page_id: (r.text, r.n_repeated) for r in main_text(frame, run=run, min_pages=n_pages).collect()}
    assert found == expected and 10 < sum(n > 0 for _, n in expected.values()) < len(bodies)


def test_a_chunk_is_bounded(spark, monkeypatch):
    from postingloom.llm import html_extract

    monkeypatch.setattr(html_extract, "CHARS", 100)
    words = [40, 40, 40, 300, 5, 5, 90]
    frame = spark.createDataFrame([(k, "h", "x" * n) for k, n in enumerate(words)], "page bigint, host string, words string").coalesce(1)
    rows = sorted(html_extract._stored_in_chunks(frame, html=False).collect(), key=lambda r: r.page)
    assert [r.chunk - rows[0].chunk for r in rows] == [0, 0, 1, 2, 3, 3, 3]
    assert [r["at"] for r in rows] == [0, 1, 0, 0, 0, 1, 2]
