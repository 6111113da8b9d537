"""Wrapper inference and the text of pages."""

import html
import re

from tempolake.llm import wrapper

PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{{}}</style>
<script>var a = "</p><article>no</article>";</script></head><body class="home">
<header>Site <b>name</b></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><!-- <p>no</p> -->
<article><h1>Title {n}</h1><p>First &amp; <b>bold</b>text.<br>next
line<p>Unclosed {n}</p><blockquote>Quote</blockquote><ul><li>one<li>two</ul>
<form><label>Mail</label><input value="x"></form><aside>More</aside><p></p><p>Last &#233;&nbsp;x</p></article>
<section class="comments"><article class="comment"><p>Reader says</p></article></section>
<div id="sidebar">Links</div><footer>&copy; Site</footer></body></html>"""
TEXT = "Title {n}\nFirst & boldtext. next line\nUnclosed {n}\nQuote\none\ntwo\nLast é x"


def texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    return wrapper.extract(frame).collect()


def test_articles_without_what_surrounds_them(spark):
    rows = [(n, f"https://a.example/{n}", PAGE.format(n=n), "clash") for n in range(6)]
    got = {r.page_id: r for r in texts(spark, rows)}
    for n in range(6):
        assert got[n].text == TEXT.format(n=n)
        assert got[n].n_chars == len(got[n].text) and got[n].url == f"https://a.example/{n}"


def test_odd_pages(spark):
    rows = [
        (1, None, None, None), (2, "http://b", "", None), (3, "not a url", "just text &lt;", None),
        (4, "http://[", "<p>a<p>b", None), (5, "http://b", "<article><p>" + "word " * 100_000, None),
        (6, "http://b", "<nav>only menu</nav>", None), (6, "http://b", "<nav>only menu</nav>", None),
        (7, "http://b", "<article>cut <b", None), (8, "http://b", "<script>never closed", None),
        (None, "http://b", "<main><p>x</p></main>", None), (9, "http://c", "</p></div>a > b", None),
    ]
    got = sorted(texts(spark, rows), key=lambda r: (r.page_id is not None, r.page_id or 0))
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[6] == by[8] == ""
    assert by[3] == "just text <" and by[4] == "a\nb" and by[9] == "a > b" and by[None] == "x"
    assert by[5] == ("word " * 100_000).strip() and by[7].startswith("cut")
    assert texts(spark, []) == []


def test_repeated_notices_outside_articles_go(spark):
    page = "<html><body><section>Same on every page</section><div>Body {n}</div><p>And {n} more</p></body></html>"
    rows = [(n, "http://d.example/x", page.format(n=n), "") for n in range(5)]
    assert {r.text for r in texts(spark, rows)} == {f"Body {n}\nAnd {n} more" for n in range(5)}


def test_notices_go_from_pages_that_differ_in_structure(spark):
    bodies = [
        "<p>a{n}</p>", "<ul><li>b{n}<li>c</ul>", "<h2>d{n}</h2><p>e</p>", "<pre>f{n}</pre>",
        "<table><tr><td>g{n}</table><p>h</p>", "<blockquote>i{n}</blockquote><h3>j</h3>",
    ]
    want = ["a{n}", "b{n}\nc", "d{n}\ne", "f{n}", "g{n}\nh", "i{n}\nj"]
    page = "<body><section>Same everywhere</section>{}<div>All rights kept</div></body>"
    rows = [(n, "http://g.example/", page.format(b.format(n=n)), "") for n, b in enumerate(bodies)]
    assert len({wrapper.Page(r[2]).key for r in rows}) == len(rows)  # no two are alike
    got = {r.page_id: r.text for r in texts(spark, rows)}
    assert got == {n: w.format(n=n) for n, w in enumerate(want)}


def test_expressions_are_mapped_onto_their_wrapper():
    shown = [
        wrapper._with_texts(e, iter(t))
        for e, t in [
            (("s", "#o", "/s", "#op"), [(7, 7), (1, 1)]),
            (("#oh2", "s", "#o", "/s", ("+", ("#op",))), [(3, 3), (7, 7), (2, 5)]),
            (("d", "#o", "/d", "s", "#o", "/s"), [(9, 9), (7, 7)]),
        ]
    ]
    whole = wrapper._loaded(wrapper._dumped(wrapper.infer(shown)))
    slots = wrapper.leaves(whole)
    found = [wrapper.places(whole, e) for e in shown]
    notice = {found[0][0], found[1][1], found[2][1]}
    assert len(notice) == 1 and slots[notice.pop()].high == 7
    body = found[0][1]
    assert body == found[1][2] and (slots[body].low, slots[body].high) == (1, 5)


def test_equal_articles_stay(spark):
    rows = [(n, "http://e.example/x", PAGE.format(n=1), "") for n in range(5)]
    assert {r.text for r in texts(spark, rows)} == {TEXT.format(n=1)}


def test_many_expressions_of_a_host_are_merged_in_small_groups(spark):
    def shape(n):  # n in binary, as tags
        tags = [("div.o", "pre.o")[n >> k & 1] for k in range(12)]
        return wrapper._dumped((*tags, wrapper.Slot("#o", n, n)))

    from pyspark.sql import functions as F

    frame = spark.createDataFrame([("h", shape(n)) for n in range(3000)], "host string, wrapper string")
    counts = frame.groupBy("host").agg(F.count("*").alias("n"))
    groups = wrapper._dealt(frame, counts).groupBy("host", "salt").count().collect()
    assert max(g["count"] for g in groups) <= 3 * wrapper._MERGED
    some = frame.limit(300).withColumnRenamed("wrapper", "marked")
    rows = wrapper.wrappers(some).collect()
    assert len(rows) == 1
    whole = wrapper._loaded(rows[0].wrapper)
    found = {tuple(wrapper.places(whole, wrapper._loaded(r.marked))) for r in some.collect()}
    assert len(found) == 1 and found != {(-1,)}


def test_what_is_not_closed_does_not_take_the_page():
    def blocks(page):
        page = wrapper.Page(page)
        slots = zip(wrapper.leaves(page.key), page.slots, strict=True)
        kept = sorted(b for slot, own in slots if slot[1] != wrapper.BOILER for b in own)
        return [page.blocks[b] for b in kept]

    head = "<html><head><meta x><title>t <b>u</title><link y><script>var a</script>"
    for start in ("<body>", "</head><body>", "", "</head>", "</meta><body class='b'>", "<div>"):
        assert blocks(f"{head}{start}<article><p>Text</p></article>") == ["Text"]
    assert blocks(head + "Text") == ["Text"] and blocks(head) == []
    assert blocks("<head><title>t<body><p>Text") == ["Text"]
    for tag in wrapper._SKIPPED:
        page = f"<body><{tag} id='x'><article><p>Text</p></article>"
        assert blocks(page) == ["Text"]
        assert blocks(f"{page}<{tag}>no</{tag}><p>more") == ["Text", "more"]
        assert blocks(f"<{tag}>a<p>b<{tag}>c</{tag}>d</{tag}><p>Text") == ["Text"]
        assert blocks(f"<{tag}/><p>Text") == ["Text"]
        assert blocks(f"<head><noscript>n</noscript><{tag}>no</{tag}><p>Text") == ["Text"]
    for tag in ("script", "style"):
        assert blocks(f"<p>Text<{tag}>never closed <p>no") == ["Text"]


def test_copies_of_a_page_without_an_article_stay(spark):
    page = "<body><nav>{n}</nav><div>Some text</div><p>And more</p><footer>{n}</footer></body>"
    rows = [(n, "http://h.example/x", page.format(n=n // 2), "") for n in range(8)]
    other = "<body><h2>Title</h2><p>One</p></body>"
    rows += [(n, "http://i.example/x", other, "") for n in range(8, 12)]
    got = {r.page_id: r.text for r in texts(spark, rows)}
    assert {got[n] for n in range(8)} == {"Some text\nAnd more"}
    assert {got[n] for n in range(8, 12)} == {"Title\nOne"}


def test_folding_and_alignment():
    page = wrapper.Page("<ul><li>a<li>b<li>c</ul><div><p>x</p></div><div><p>y</p></div>")
    assert page.key == ("ul.o", ("+", ("#oli",)), "/ul", ("+", ("div.o", "#op", "/div")))
    assert [[page.blocks[b] for b in s] for s in page.slots] == [["a", "b", "c"], ["x", "y"]]
    one = ("a", "#o", "b")
    assert wrapper.aligned(one, one) == one
    assert wrapper.aligned(one, ("a", "b")) == ("a", ("?", ("#o",)), "b")
    assert wrapper.aligned(one, ("a", ("+", ("#o",)), "b")) == ("a", ("+", ("#o",)), "b")
    merged = wrapper.infer([("a", "b"), one, ("a", ("+", ("#o",)), "b")])
    assert merged == ("a", ("*", ("#o",)), "b")


def test_query_equals_brute_force(spark):
    from tempolake.llm.queries import op10_html_extraction

    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in op10_html_extraction(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:  # these pages have one article of headings and paragraphs
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        plain = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
        assert got[page.page_id] == "\n".join(b for b in plain if b)


def test_class_words_do_not_blank_a_page(spark):
    body = "<p>Story {n} goes on and on</p><p>Until it ends {n}</p>"
    shells = [
        '<div class="layout with-sidebar">{}</div>',
        '<div class="layout with-sidebar"><article>{}</article></div>',
        '<div class="has-header-image"><article>{}</article></div>',
        '<div class="post no-comments">{}</div>', '<div class="content sidebar-right">{}</div>',
        '<div class="social-share-enabled">{}</div>', '<section class="discussion">{}</section>',
        '<form action="/">{}</form>', '<div id="sidebar"><article>{}</article></div>',
    ]
    side = '<nav>Menu</nav><div class="site-footer">Foot</div><div class="cookie-notice">Cookies</div>'
    rows, want = [], {}
    for i, shell in enumerate(shells):
        for n in range(4):
            page = f"<body>{side}{shell.format(body.format(n=n))}</body>"
            rows.append((10 * i + n, f"http://h{i}.example/{n}", page, ""))
            want[10 * i + n] = f"Story {n} goes on and on\nUntil it ends {n}"
    assert {r.page_id: r.text for r in texts(spark, rows)} == want


def test_comments_stay_out_however_they_are_marked(spark):
    page = (
        "<body><article><p>Story {n}</p></article><section class='post-comments'><article><p>Says {n}"
        "</p></article></section><div class='comment-list'><p>Reply {n}</p></div>"
        "<div class='related-articles'><article>Other {n}</article></div></body>"
    )
    rows = [(n, "http://k.example/", page.format(n=n), "") for n in range(5)]
    assert {r.page_id: r.text for r in texts(spark, rows)} == {n: f"Story {n}" for n in range(5)}


def test_the_fuller_region_is_the_main_one(spark):
    story = "<p>A long story {n} that takes more room than any teaser does</p>" * 3
    main = "<body><main><h1>Head {n}</h1>" + story + "<article>teaser {n}</article></main></body>"
    usual = "<body><main><p>Path {n}</p><article>" + story + "</article></main></body>"
    rows = [(n, "http://m.example/", main.format(n=n), "") for n in range(4)]
    rows += [(10 + n, "http://n.example/", usual.format(n=n), "") for n in range(4)]
    got = {r.page_id: r.text for r in texts(spark, rows)}
    for n in range(4):
        told = "\n".join([f"A long story {n} that takes more room than any teaser does"] * 3)
        assert got[n] == f"Head {n}\n{told}" and got[10 + n] == told


def test_the_wrapper_decides_inside_articles(spark, tmp_path, monkeypatch):
    """Without what the wrapper found constant, rows of the query change."""
    from tempolake.llm.queries import op10_html_extraction

    bodies = ["<p>a{n}</p>", "<ul><li>b{n}<li>c</ul>", "<h2>d{n}</h2><p>e</p>", "<pre>f{n}</pre>"]
    page = "<body><article><h1>H{n}</h1>{b}<div>Our terms apply</div></article></body>"
    rows = []
    for n in range(24):
        html_ = page.format(n=n, b=bodies[n % 4].format(n=n))
        rows.append((n, "http://w.example/", html_))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")

    def found():
        return {r.page_id: r.text for r in op10_html_extraction(spark, str(tmp_path)).collect()}

    got = found()
    want = ["H{n}\na{n}", "H{n}\nb{n}\nc", "H{n}\nd{n}\ne", "H{n}\nf{n}"]
    assert got == {n: want[n % 4].format(n=n) for n in range(24)}
    monkeypatch.setattr(wrapper, "_CONSTANT_PAGES", 10**9)
    assert found() == {n: f"{text}\nOur terms apply" for n, text in got.items()}


def test_an_article_that_never_changes_stays(spark):
    page = "<body><nav>{n}</nav><article><h1>One</h1><p>Text</p></article><p>Visit {n}</p></body>"
    rows = [(n, "http://o.example/", page.format(n=n), "") for n in range(30)]
    assert {r.text for r in texts(spark, rows)} == {"One\nText"}


def _worth(left, right, pairs):
    numbers = {}
    a, b = wrapper._codes(left, numbers), wrapper._codes(right, numbers)
    one = min(len(left), len(right)) + 1
    assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
    weights = [int(wrapper._weights(a, b, i, one, j)) for i, j in pairs]
    assert all(weights)
    return sum(weights)


def test_halved_alignment_is_as_good_as_a_whole_table(monkeypatch):
    import random

    draw = random.Random(6)
    for _ in range(60):
        def items(n):
            return tuple(
                draw.choice(["a", "b", ("+", ("#o",)), wrapper.Slot("#o", k := draw.randrange(3), k)])
                for _ in range(n)
            )

        left, right = items(draw.randrange(40)), items(draw.randrange(40))
        whole = _worth(left, right, wrapper._pairs(left, right))
        with monkeypatch.context() as patch:
            patch.setattr(wrapper, "_TABLE", 6)
            assert _worth(left, right, wrapper._pairs(left, right)) == whole


def test_very_long_pages_are_aligned_in_little_memory():
    import tracemalloc

    left = tuple(wrapper.Slot("#o", k, k) if k % 3 else f"t{k}" for k in range(12_000))
    right = tuple(wrapper.Slot("#o", -k, -k) if k % 3 else f"t{k + 30}" for k in range(12_000))
    tracemalloc.start()
    pairs = wrapper._pairs(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pairs) > 8_000 and peak < 200e6
