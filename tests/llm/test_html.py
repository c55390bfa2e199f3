"""Main text of pages, neighbours by URL, and the alignment of lines."""

import random
import re
import time

from pyspark.sql import functions as F

from wardflow.llm import html_difference

PAGES = "page_id bigint, url string, html string"


def page(body):
    return f"<html><head><title>t</title></head><body><nav><a>Home</a></nav>{body}<footer>foot</footer></body></html>"


def test_regions_and_references():
    lines = html_difference.lines_of(
        "<nav><ul><li>a<li>b</ul></nav><article><header><h1>T &amp;\n T</h1></header><p>One<br>two<p>x<b>y</b>z"
        "<script>if (a<b) {'</p>'}</script><section class='comments'><p>no</p></section></article><aside>s</aside>"
    )
    assert [t for t, _, _ in lines] == ["T & T", "One two", "xyz"]
    assert all(main for _, main, _ in lines)
    assert html_difference.lines_of(None) == html_difference.lines_of("") == []
    assert [t for t, _, _ in html_difference.lines_of("<p title='a>b'>A<p hidden>H</p>tail &lt;&nbsp;x")] == ["A", "tail < x"]
    assert html_difference.lines_of("<div class='cookie-notice'><p>We use</div><form><p>f</form>") == []


def texts(html):
    return [t for t, _, _ in html_difference.lines_of(html)]


def test_only_real_attributes_hide():
    for attribute in ("style='overflow: hidden'", 'data-hidden="false"', "title='search hidden'", "aria-hidden=false", "data-id=nav",
                      "class='has-sidebar'", "class='article-header'", "class='research alerted'"):
        assert texts(f"<div {attribute}><p>Kept</p></div>") == ["Kept"], attribute
    assert texts("<p>See <a href='/hidden-valley'>the valley</a> and <a href=\"/a?id=search\">this</a>.") == ["See the valley and this."]
    for attribute in ("hidden", "HIDDEN=''", "aria-hidden='true'", "class='x sidebar'", "id=comments", "role=navigation",
                      "class='cookie-notice'", "class='cookie-consent-banner'", "id='sidebar-2'", "class=footer__links"):
        assert texts(f"<p>a</p><div {attribute}><p>Gone</p></div><p>b</p>") == ["a", "b"], attribute
    assert texts("<p>a <span class=share>b<div>c</div></span> d</p>") == ["a", "d"]
    assert texts("<p>a <span class=share>b</span> d</p><div class=ad><p>open") == ["a d"]


def test_class_words_never_hide_main_elements():
    for name in ("main", "article"):
        for wrap in ("content-sidebar-wrap", "has-sidebar", "sidebar", "header", "widget"):
            assert texts(f"<div class='{wrap}'><div id=site-header><{name}><h1>T</h1><p>x</p></{name}></div></div>") == ["T", "x"], wrap
    assert texts("<article><div class='article-header'><h1>T</h1></div><div class=header><h2>S</h2></div><p>x</p></article>") == ["T", "S", "x"]
    comments = "<div class='comments'><article class='comment-body'><p>no</p></article></div>"
    assert texts(f"<main><article><p>x</p>{comments}</article>{comments}</main>") == ["x"]


def test_story_outside_an_article_stays():
    rows = lambda html: [(hash(t), m, p) for t, m, p in html_difference.lines_of(html)]
    teaser = "<div class='post'><h1>Story</h1><p>One</p><p>Two</p></div><article>Teaser</article>"
    assert texts(teaser) == ["Story", "One", "Two", "Teaser"]
    assert html_difference.main_lines(rows(teaser), None) == [True] * 4
    title = "<h1>Title</h1><div>Menu line</div><article><p>Text</p></article>"
    other = [hash("Menu line"), hash("Text")]
    # The neighbour shares a line outside, which goes, and one that is marked, which stays.
    assert html_difference.main_lines(rows(title), other) == [True, False, True]


def test_inline_content_stays_in_its_line():
    assert texts("<p>If <math><mi>x</mi><mo>&lt;</mo><mn>2</mn></math> then <svg><text>no</text></svg>so.</p>") == ["If x<2 then so."]
    assert texts("<p>One <script>a</script>two<object>three</object></p>") == ["One twothree"]
    assert texts("<p>One</p><style>p{}</style><p>two</p>") == ["One", "two"]


def test_broken_tags():
    assert texts("<p title=it's>don't") == ["don't"]
    assert texts("a <b and c") == ["a <b and c"]
    assert texts("<p class=\"x>one</p><p>two</p>") == ["one", "two"]
    assert texts("<p class='a>b'>one</p> 1 < 2 <") == ["one", "1 < 2 <"]
    assert texts("<p>x<!-- never closed <p>y") == ["x"]
    assert texts("<p>x<script>y</script <p>z</p>w") == ["xz", "w"]


def test_time_is_linear():
    """Markup that repeats what is never closed: twice the page takes about twice the time."""
    n = 40_000
    for made in ("<a " * n, '<a "' * n, "<a b='" * n, "<div>" * n + "</p>" * n, "<b>" * n + "<p></p>" * n, "<script " * n,
                 "<script></script " * n, "<!--" * n, "<![CDATA[" * n, "<" * n, "</" * n, "<p><i>" * n, "<div class=ad>" * n + "</div>" * n,
                 "<li>" * n, "<a =" * n + ">", '<a ="' * n + ">", "<math><svg>" * n):
        start = time.perf_counter()
        html_difference.lines_of(made)
        assert time.perf_counter() - start < 3, made[:20]


def plain_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_common_subsequence_is_longest(monkeypatch):
    rng = random.Random(1)
    for cells in (html_difference.MAX_LCS_CELLS, 6):
        monkeypatch.setattr(html_difference, "MAX_LCS_CELLS", cells)
        for _ in range(200):
            a = [rng.randint(0, 5) for _ in range(rng.randint(0, 14))]
            b = [rng.randint(0, 5) for _ in range(rng.randint(0, 14))]
            places = html_difference.common_places(a, b)
            assert places == sorted(set(places)) and len(places) == plain_lcs(a, b)
            rest = iter(b)
            assert all(a[p] in rest for p in places)


def test_template_of_neighbours_goes(spark):
    rows = [
        (k, f"http://h.example/p/{k}", page(f"<div><p>Welcome to our site</p><p>Text {k} one</p><p>Text {k} two</p><p>All rights</p></div>"))
        for k in range(4)
    ]
    rows.append((9, "http://other.example/p/1", page("<div><p>Welcome to our site</p><p>Alone</p></div>")))
    got = {r["page_id"]: r["text"] for r in html_difference.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {**{k: f"Text {k} one\n\nText {k} two" for k in range(4)}, 9: "Welcome to our site\n\nAlone"}


def test_copies_of_an_article_stay(spark):
    marked = page("<article><h1>Same</h1><p>Body of it</p></article>")
    plain = page("<div><p>Copied text</p><p>More of it</p></div>")
    rows = [(k, f"http://a.example/{k}", marked) for k in range(3)] + [(5 + k, f"http://b.example/{k}", plain) for k in range(3)]
    got = {r["page_id"]: r["text"] for r in html_difference.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {**dict.fromkeys(range(3), "Same\n\nBody of it"), **dict.fromkeys((5, 6, 7), "Copied text\n\nMore of it")}


def test_copies_without_prose_elements_stay(spark):
    bodies = [
        "<article>Bare text<div>Body in a div</div><span>and a span</span></article>",
        "<main><section>Same section</section></main>",
        "<div>Copied text</div><section>More of it</section>",
    ]
    rows = [(10 * k + n, f"http://{k}.example/{n}", page(body)) for k, body in enumerate(bodies) for n in range(2)]
    rows += [(100 + n, f"http://part.example/{n}", page(f"<main><div>Shared</div><p>Text {n}</p></main>")) for n in range(2)]
    got = {r["page_id"]: r["text"] for r in html_difference.extract(spark.createDataFrame(rows, PAGES)).collect()}
    want = ["Bare text\n\nBody in a div\n\nand a span", "Same section", "Copied text\n\nMore of it"]
    assert got == {**{10 * k + n: want[k] for k in range(3) for n in range(2)}, **{100 + n: f"Shared\n\nText {n}" for n in range(2)}}


def test_neighbours_cross_ranges(spark):
    rows = [(k, f"h{k // 100}", f"/p/{k:04d}") for k in range(300)] + [(300, "lonely", "/")]
    pages = spark.createDataFrame(rows, "key bigint, host string, path string").repartition(5)
    got = {r["key"]: r["other"] for r in html_difference.neighbours(pages).collect()}
    want = {k: k + 1 if k % 100 < 99 else k - 1 for k in range(300)}
    assert got == {**want, 300: None}


def test_extraction_is_brute_force(spark):
    """Made-up sites: pages know their own lines, so the expected text needs no reader of markup."""
    rng = random.Random(21)
    template = [f"Template line {k}" for k in range(30)]
    pages = []
    for host in ("a.example", "b.example", "c.example"):
        for number in range(40):
            # Template lines keep their order, so that the longest common subsequence is one only.
            shared = sorted(rng.sample(range(30), rng.randint(0, 8)))
            own = [f"Own {host} {number} {k}" for k in range(rng.randint(0, 6))]
            lines = [(template[k], rng.choice(["p", "div"])) for k in shared]
            marked = set()
            if own and rng.random() < 0.5:
                marked = set(rng.sample(own, rng.randint(1, len(own)))) | {template[k] for k in shared if rng.random() < 0.2}
            for text in own:
                lines.insert(rng.randint(0, len(lines)), (text, rng.choice(["p", "div"])))
            if number % 9 == 8:
                lines, marked = pages[-1][2], pages[-1][3]
            pages.append((host, f"/x/{number:02d}", lines, marked))
    html = []
    for _, _, lines, marked in pages:
        parts = ["<nav><p>Menu</p></nav>", "<script>var x = 1;</script>"]
        for text, name in lines:
            spread = text.replace(" ", rng.choice([" ", "\n  ", "&#32;", "\t"]))
            block = f"<{name}>{spread}</{name}>"
            parts.append(f"<article>{block}</article>" if text in marked else block)
        html.append(page("".join([*parts, "<footer>Foot</footer>"])))

    want = {}
    for k, (host, path, lines, marked) in enumerate(pages):
        near = sorted((p, n) for n, (h, p, *_) in enumerate(pages) if h == host)
        here = near.index((path, k))
        other = [t for t, _ in pages[near[here + 1 if here + 1 < len(near) else here - 1][1]][2]]
        shared = {t for t, _ in lines} & set(other)
        kept = {t for t, _ in lines if t in marked}
        if not kept:
            running = [t for t, name in lines if name == "p"] or [t for t, _ in lines]
            if 2 * len(shared & set(running)) > len(running):
                kept = set(running)
        want[k] = "\n\n".join(t for t, _ in lines if t not in shared or t in kept)
    rows = [(k, f"http://{h}{p}", html[k]) for k, (h, p, *_) in enumerate(pages)]
    frame = spark.createDataFrame(rows, PAGES)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_difference.extract(frame.repartition(6)).collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}
    dropped = sum(len(lines) for _, _, lines, _ in pages) - sum(len(t.split("\n\n")) for t in want.values() if t)
    assert dropped > 50 and any("Template" in t for t in want.values())


def test_awkward_pages(spark):
    body = page("<article><p>" + "long " * 50_000 + "</p></article>")
    rows = [(1, None, "<p>x"), (1, None, "<p>x"), (2, "http://h/", None), (3, "no scheme", ""), (None, "http://h/a", body), (4, "http://h/b", "<" * 50_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("own")).withColumn("key", F.lit(1))
    got = html_difference.extract(pages).collect()
    assert len(got) == len(rows)
    assert [r["text"] for r in got if r["page_id"] == 1] == ["x", "x"]
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in got if r["page_id"] in (2, 3))
    assert next(r["n_chars"] for r in got if r["page_id"] is None) == 5 * 50_000 - 1
    assert html_difference.extract(pages.limit(0)).count() == 0


def test_given_pages_without_their_markup(spark):
    """Regions renamed to div: the alignment alone loses next to none of the article, and drops what pages share."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url", "html").orderBy("url").collect()
    plain = [re.sub(r"<(/?)(?:article|nav|footer)\b[^>]*>", r"<\1div>", re.sub(r' class="[^"]*"', "", r["html"] or "")) for r in rows]
    main = [[t for t, m, _ in html_difference.lines_of(r["html"]) if m] for r in rows]
    read = [html_difference.lines_of(p) for p in plain]
    lines = lost = 0
    for k, (wanted, parts) in enumerate(zip(main, read, strict=True)):
        other = [t for t, _, _ in read[k + 1 if k + 1 < len(read) else k - 1]]
        kept = html_difference.main_lines(parts, other)
        left = {t for (t, _, _), keep in zip(parts, kept, strict=True) if keep}
        lines, lost = lines + len(set(wanted)), lost + len(set(wanted) - left)
    assert lines > 1_000 and lost <= 0.02 * lines
