import html
import re

from wattloom.llm.html_extraction import Page, extracted, host_paths


def own(t):
    return Page(t).text([])


def test_article_without_the_rest():
    t = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>menu</a></nav>
    <div class="cookie-notice"><p>We use cookies, and more cookies, and still more.</p></div>
    <article><h1>Title &amp; more</h1><p>One  two<b>three</b>
    four.<br>five<p>Second, <i>paragraph</i><script>if (a < b) "</p>"</script> here.</p><ul><li>a<li>b</ul><div class="ad">buy, buy, buy</div>
    <form>name <input></form><aside>side</aside></article><section id="comments"><p>Nice, really nice, post. Thanks, all.</p></section><footer>&copy; x</footer></body></html>"""
    assert own(t) == "Title & more\n\nOne twothree four. five\n\nSecond, paragraph here.\n\na\n\nb"


def test_odd_markup():
    assert own("") == "" and own("<") == "<" and own("plain text") == "plain text"
    assert own("<p>a &lt; b &#233; &#x1F642; &nbsp;&am &amp x") == "a < b é 🙂 &am & x"
    assert own("<div><!-- <p>no</p> --><p>yes</p><!-- open") == "yes"
    assert own("<p title=\"a>b\">q</p><p title='x>y'>r</p>") == "q\n\nr"
    assert own("<p class=\"broken>text here</p><p>next</p>") != ""
    assert own("<script>never closed <p>x") == ""
    assert own("<p>one <svg viewBox='0'> two</p><p>three</p>") == "one two\n\nthree" and own("<p>a</p><math><p>b</p>") == "a\n\nb"
    assert own("<p>a<svg><text>no</text></svg>b</p>") == "ab"
    assert own("</div></p><p>a</b>b</p>") == "ab"
    assert own("İ<script>İ</SCRIPT >x<textarea>y</textarea>z") == "İxz" and own("<b>" * 50000 + "x" + "</i>" * 50000) == "x"
    assert own("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"


def test_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>|<br>", "", body))
        want[r.page_id] = "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
    got = extracted(pages).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_the_host_decides(spark):
    usual = "<body><div class='post p%d'><p>%s</p></div><div class='box'><p>%s</p></div></body>"
    rows = [(i, f"https://A.example.org:80/{i}", usual % (i, f"Main text, number {i}, long enough.", "short")) for i in range(20)]
    rows.append((20, "http://u@a.example.org/x", usual % (20, "Tiny.", "This box, for once, is much longer, than the post.")))
    rows += [(21, None, usual % (1, "No host, own best.", "x")), (22, "https://a.example.org", None), (23, "", ""), (None, "https://a.example.org/y", "<p>else</p>"), (3, rows[3][1], rows[3][2])]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int").repartition(3)
    assert [(r.host, r.paths[0]) for r in host_paths(pages).collect()] == [("a.example.org", ">body>div.p.post")]
    got = {(r.page_id, r.text) for r in extracted(pages).collect()}
    assert {(20, "Tiny."), (21, "No host, own best."), (22, ""), (23, ""), (None, "else"), (3, "Main text, number 3, long enough.")} <= got
    assert extracted(pages).count() == len(rows) and extracted(pages.limit(0)).count() == 0
