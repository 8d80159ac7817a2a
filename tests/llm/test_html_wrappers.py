"""Main text: templates of several kinds, broken markup, and the sample pages against a plain reading."""

import html as entities
import re

from quaymart.llm import html_wrappers as H
from quaymart.llm.common import read

SHOP = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head><body>
<header><h1>The Site</h1></header><nav><ul><li><a href=/a>Menu</a></li></ul></nav><div id="cookie-notice">We use cookies</div>
<main><article class="post"><header><h1>Title &amp; %d</h1></header><p>First  <i>par</i>a<b>graph</b> %d.<br>more<p>Second &#233;&nbsp;x
<ul><li>one<li>two</ul><form><label>Mail</label><input></form><div class="adBox">buy now</div><!-- <p>no</p> -->
<section class="comments"><article class="comment"><p>nice</p></article></section></article><aside>related</aside></main>
<footer>&copy; us</footer></body></html>"""


def test_article_template():
    root, leaves = H.parse(SHOP % (1, 2))
    paths = H.own_paths(root)
    assert H.main_text(leaves, paths) == "Title & 1\nFirst para" "graph 2. more\nSecond é x\none\ntwo"


def test_plain_divs_need_the_host():
    """Without marks the varying container is main; texts that are the same on all pages are not."""
    pages = [f"<body><div class='top'>Shop Home Help</div><div class='c1'><h2>Item {i}</h2><p>{'long text ' * 5}{i}</p><p>Read more below</p></div>"
             f"<div class='c2'>All rights</div></body>" for i in range(5)]
    wrapper = None
    for p in pages:
        wrapper = H.align(wrapper, H.seed(H.parse(p)[0]))
    paths = {tuple(p) for p in H.main_paths(wrapper)}
    text = H.extract(pages[3], paths)
    assert text.startswith("Item 3\nlong text") and "Shop Home" not in text and "All rights" not in text


def test_wrapper_is_union_free():
    a = "<ul><li>x</li><li>y</li></ul><p>one</p>"
    b = "<ul><li>z</li></ul><h2>extra</h2><p>two</p>"
    w = H.align(H.seed(H.parse(a)[0]), H.seed(H.parse(b)[0]))
    assert H.expression(w) == "<ul> (<li> (#text)+ </>)+ </> (<h2> 'extra' </>)? <p> #text </>"
    parts = [H.seed(H.parse(x)[0]) for x in (a, b, a, b)]
    left = H.align(H.align(H.align(parts[0], parts[1]), parts[2]), parts[3])
    right = H.align(H.align(parts[0], parts[1]), H.align(parts[2], parts[3]))
    assert H.main_paths(left) == H.main_paths(right)


def test_broken_markup():
    own = lambda p: H.extract(p, set())
    assert own("<article><p>a<b>b<p>c") == "ab\nc"
    assert own("<article>1 < 2 && x <p>z</article") == "1 < 2 && x\nz"
    assert own("<article><p>cut <a href=\"x") == "cut"
    assert own("plain text only") == "plain text only"
    assert own("<script>x") == "" and own("<!-- x") == "" and own("") == "" and own("<") == "<"
    assert own("<article><p hidden>no</p><p>yes</p></article>") == "yes"
    assert H.extract("<p>" * 5000 + "deep" + "<div>" * 5000 + "er", set()).replace("\n", "") == "deeper"


def test_pages(spark):
    pages = read(spark, "/root/testdata/sf0.001", "pages")
    extra = spark.createDataFrame([(9001, None, None), (9002, "no host", ""), (9003, "http://h/x", SHOP % (3, 4)), (9003, "http://h/x", SHOP % (3, 4))], "page_id bigint, url string, html string")
    from pyspark.sql import functions as F

    both = pages.unionByName(extra).withColumns({"host": F.lit(1), "rules": F.lit("x"), "text": F.lit("y")})
    got = H.main_texts(both).collect()
    assert len(got) == both.count()
    texts = {r.page_id: r.text for r in got}
    assert texts[9001] == texts[9002] == "" and texts[9003].startswith("Title & 3\nFirst")
    for r in pages.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert texts[r.page_id] == "\n".join(b for b in blocks if b)
    assert H.main_texts(both.limit(0)).count() == 0
