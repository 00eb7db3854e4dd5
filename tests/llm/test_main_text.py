import random
import time

import pytest

from paperloom.llm.main_text import CONTAINERS, LEVELS, Page, extract, gained_points, main_text, select

LONG = "A sentence that is long enough to count, with commas, and with words to spare."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=1>x</a></li></ul></nav>
<!-- <p>hidden</p> --><div class="ad">Buy now, cheap, really, {LONG}</div>
<div class="notice">Notice: {LONG}</div><aside><p>{LONG}</p></aside>
<div id="wrap"><div class="post"><h1>Title &amp; more</h1><p>First&nbsp;para:
   {LONG}<br>after break<p>Second &eacute;&#233;, {LONG} <a href=2>one link</a> inside.
<ul><li>item one</li><li>item two</li></ul><blockquote>Quote, {LONG}</blockquote>
<ul><li><a href=1>Rel 1</a></li><li><a href=2>Rel 2</a></li><li><a href=3>Rel 3</a></li></ul>
<form>Name <input name=x><p>{LONG}</p></form><p>Short.</p>
<div class="comments"><p>Reader: {LONG}</p></div></div></div>
<footer>&copy; me</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n\n") == [
        "Title & more",
        f"First para: {LONG} after break",
        f"Second éé, {LONG} one link inside.",
        "item one",
        "item two",
        f"Quote, {LONG}",
        "Short.",
    ]


def test_words_in_names_of_wrappers_lose_no_article():
    body = f"<p>One, {LONG}</p><p>Two, {LONG}</p>"
    text = f"One, {LONG}\n\nTwo, {LONG}"
    side = f"<div class=sidebar><p>Side, {LONG}</p></div>"
    for name in ("content with-sidebar", "layout no-sidebar", "post comments-open", "login share toc"):
        assert main_text(f"<body><div class='{name}'>{body}</div></body>") == text
        assert main_text(f"<body><div id='{name}'><div class=x>{body}</div>{side}</div></body>") == text
        assert main_text(f"<body><div class='{name}'>{side}<article class='{name}'>{body}</article></div>") == text
        assert main_text(f"<main><article class='{name}'>{body}</article>{side}</main>") == text
    assert main_text(f"<div class=header>{body}</div>") == text
    assert main_text(f"<section id='search-algorithms'>{body}</section>") == text
    assert main_text(f"<body><div class=ad>One, {LONG}</div><div class=menu>Two, {LONG}</div></body>") == text
    assert main_text("<div class=login>Short</div>") == "Short"


def test_words_in_ids_of_headings_and_lines():
    parts = "".join(
        f"<section id='{i}'><h2 id='{i}'>{h}</h2><p class=share>{h}: {LONG} <span class=search>s</span></p></section>"
        for i, h in (("intro", "Intro"), ("search-algorithms", "Search algorithms"), ("how-to-share-data", "How to Share Data"))
    )
    got = main_text(f"<article>{parts}<div class=related-posts><h2>Related posts</h2><p>x</p></div></article>")
    assert got.split("\n\n") == [
        line for h in ("Intro", "Search algorithms", "How to Share Data") for line in (h, f"{h}: {LONG} s")
    ]


def test_parts_that_words_name_still_go():
    post = f"<p>One, {LONG}</p><p>Two, {LONG}</p>"
    talk = f"<div id=comments><article class=comment-body><p>Reader, {LONG}</p></article></div>"
    assert "Reader" not in main_text(f"<main><article class='post comments-open'>{post}</article>{talk}</main>")
    assert "Reader" not in main_text(f"<article>{post}{talk}</article>")
    lines = "<br>".join(["Short"] * 99)
    poem = "".join(f"<div>Line {n}</div>" for n in range(99))
    assert main_text(f"<div>{poem}</div><div class=ad>{LONG}</div>").count("Line") == 99
    head = f"<article><div class=header><h1>Head</h1><span>by me</span></div>{post}{lines}</article>"
    assert main_text(head).startswith("Head\n\nOne")


def test_defined_cases():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == main_text("<script>x") == ""
    assert main_text("plain & simple &amp text") == "plain & simple & text"
    assert main_text("<p>Short") == "Short"
    assert main_text("<article><header><h1>Head</h1><span>by me</span></header><p>x</p></article>") == "Head\n\nx"
    assert main_text("<p>a</p><!-- <script> old --> text <script>x()</script> end") == "a\n\ntext end"
    assert main_text("<article><p>a <b>b<p>c</b> d</article><footer>f</footer>") == "a b\n\nc d"
    parts = "".join(f"<div class=part><p>{n} {LONG}</p></div>" for n in range(2))
    assert main_text(f"<div id=x>{parts}</div>").count(LONG) == 2


def test_deep_and_long_pages():
    assert main_text("<div>" * 20000 + "x") == "x"
    assert main_text("<p>a</p>" * 20000).count("a") == 20000
    assert main_text("<div class=menu>" * 20000 + "x") == "x"


def test_operator(spark):
    rows = [(1, "u", PAGE, "r"), (1, "u", PAGE, "r"), (2, None, None, "r"), (None, "v", "", "r"), (3, "w", "x" * 10**6, "r")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, main_text string")
    got = extract(pages).select("row.page_id", "row.main_text", "main_text").collect()
    assert [tuple(r) for r in got] == [(p, "r", main_text(h)) for p, _, h, _ in rows]
    assert extract(pages.where("false")).count() == 0


def test_malformed_markup_ends_no_page():
    assert main_text("<p>ok</p><![ x ]>") == "ok"
    assert main_text("<![foo[x]]><p>ok</p>") == "ok"
    assert main_text("<![CDATA[x]]><!x><?php y ?></ z><p>ok</p>") == "ok"
    assert main_text("I <![ love") == "I"
    assert main_text("<p>a < b and c<1 </p><p>x<y") == "a < b and c<1\n\nx"
    assert main_text("<!--><p>ok</p>--><p>yes</p>") == "ok\n\n--> \n\nyes".replace("--> ", "-->")
    assert main_text("<p a='1' =x b=\"2 class=q>ok</p><p>yes</p>") == "ok\n\nyes"
    assert main_text("<p title='>'>ok</p><script>x</scripty></script><title>T</title>") == "ok\n\nT"


def test_any_text_is_a_page():
    rng = random.Random(11)
    parts = ["<", ">", "</", "<!", "<![", "<!--", "-->", "<?", "'", '"', "=", "/", "&", "&amp;", "&#x;", "&#99999999;"]
    parts += ["a", "p", "div", "<p>", "<a href=", "<div class=ad>", "</div>", "<script>", "</script>", "<form>", "<li>"]
    parts += ["<article>", "</article>", "<table><td>", "<br/>", "text, and more text ", "\x00", "\ud800", "é", "<svg/>"]
    for _ in range(6000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert isinstance(main_text(page), str)


@pytest.mark.parametrize(
    "part",
    ["<a ", '<a href="', "<div></section>", "<span><div>", "<b></i>", "<p><b>", "<![", "<!--", "<a><div><span>"]
    + ["<span><a></a>", "<ul><li>", "<li><ul>x", "&amp", "<script>", "</script>", "<td><p>x", "x <y ", "<h1 id='search'>"],
)
def test_time_grows_with_the_page(part):
    def seconds(n):
        page = part * n
        took = []
        for _ in range(3):
            start = time.process_time()
            main_text(page)
            took.append(time.process_time() - start)
        return min(took)

    few, many = seconds(3_000), seconds(24_000)
    assert many < 24 * few + 0.3  # eight times the page; with the square it would be 64 times


def test_forms_and_hidden_wrappers_keep_the_article():
    body = f"<p>One, {LONG}</p><p>Two, {LONG}</p>"
    text = f"One, {LONG}\n\nTwo, {LONG}"
    controls = "<input value=v><label>Name</label><select><option>o</option></select><button>Go</button>"
    assert main_text(f"<body><form id=aspnetForm>{controls}<div>{body}</div></form></body>") == text
    assert main_text(f"<form id=aspnetForm><article>{body}</article>{controls}</form>") == text
    assert main_text(f"<form><fieldset>{body}</fieldset></form>") == text
    assert main_text(f"<article>{body}</article><form>{controls}<p>Write us, {LONG}</p></form>") == text
    for wrapper in ("header", "aside", "div hidden", "div aria-hidden=true", "div role=dialog", "div style='display: none'"):
        assert main_text(f"<body><{wrapper}>{body}</{wrapper.split()[0]}></body>") == text


def test_lists_of_links_inside_an_article_stay():
    body = f"<p>One, {LONG}</p><p>Two, {LONG}</p>"
    links = "<ul>" + "".join(f"<li><a href={i}>Source {i}</a></li>" for i in range(4)) + "</ul>"
    assert main_text(f"<article>{body}<h2>Sources</h2>{links}</article>").count("Source ") == 4
    assert main_text(f"<div>{body}<h2>Sources</h2>{links}</div>").count("Source ") == 4
    assert main_text(f"<div>{body}<p>We read these:</p>{links}</div>").count("Source ") == 4
    assert main_text(f"<div>{links}{body}</div>").count("Source ") == 0
    assert main_text(f"<article>{body}<div class=related>{links}</div></article>").count("Source ") == 0


def test_points_like_a_plain_walk():
    """The best element, with every block handing its points up one parent after the other."""
    rng = random.Random(3)
    for _ in range(300):
        html = "".join(
            rng.choice(["<div>", "</div>", "<section>", "</section>", "<ul><li>", "</ul>", f"<p>{LONG * rng.randint(1, 4)}</p>"])
            for _ in range(rng.randint(1, 40))
        )
        page = Page(html)
        points = [0.0] * len(page.tags)
        for node, text, linked in page.blocks:
            at, level = node, 0
            while at >= 0 and level < LEVELS:
                if page.tags[at] in CONTAINERS:
                    level += 1
                    points[at] += gained_points(text, linked) / (1 if level == 1 else 2 if level == 2 else 3 * (level - 1))
                at = page.parents[at]
        got = select(page)
        if max(points) > 0:
            winner = points.index(max(points))

            def inside(node):
                while node > 0 and node != winner:
                    node = page.parents[node]
                return node == winner

            assert {t for n, t, _ in page.blocks if inside(n)} <= set(got)
