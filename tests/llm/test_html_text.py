import html
import math
import re
from collections import defaultdict

import pytest

from shredline.llm import html_text


def extract(spark, pages):
    pages = spark.createDataFrame([(i, u, h, "clash", 0) for i, u, h in pages], "page_id long, url string, html string, text string, n_chars int")
    return {(r.page_id, r.url): r.text for r in html_text.extract_text(spark, pages).collect()}


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt;\n here", "plain <text> here"),
        ("<article><p>a<p>b</article>", "a\nb"),
        ("<article><h1>T</h1><p><b>x<br><p>y  z</p></article><footer>f</footer>", "T\nx\ny z"),
        ("<nav>n</nav><header>h</header><main><p>m</p><aside>s</aside></main>", "m"),
        ("<body><article><header><h1>T</h1></header>t</article><div class='post-comments'>c</div></body>", "T\nt"),
        ("<article>a<script>var t='</p>';</script><style>p{}</style>b<!-- c -->d</article>", "abd"),
        ("<article><div class=\"ad\">no</div><form>f</form><p>yes &amp; &eacute;&#x41;&am</p></article>", "yes & éA&am"),
        ("<article><p>a</p><div class='cookie-notice'>n</div><div role=navigation>n</div><p hidden>h</p><p style='display: none'>h</p><p>b</p></article>", "a\nb"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>3<td>4<tr><td>5</table></article>", "1\n2\n3 4\n5"),
        ("<article><p>a</i></div>b</p></article", "ab"),
        ("<article>a &nbsp; b c</article>", "a b c"),
        ("<article>one</article><article class='comment'>no</article><article>two</article>", "one\ntwo"),
        ("<article><a href='x>y'>link</a> <em title=\"<p>\">e</em></article>", "link e"),
        ("<article>1 < 2 and <3</article>", "1 < 2 and <3"),
        ("<article><p>so <math><mi>x</mi></math> is</p></article>", "so x is"),
        ("<main><header><h1>T</h1></header><p>m</p></main><header>no</header>", "T\nm"),
        ("<div class='layout no-sidebar'><p>kept</p><div class='left sidebar'>no</div></div>", "kept"),
        ("<ARTICLE><P CLASS=x>up</P></ARTICLE>", "up"),
        ("<script>no end", ""),
        ("<!-- no end <article>x</article>", ""),
        ("<div>" * 5000 + "deep", "deep"),
        ("<article>" + "<p>long text</p>" * 20_000 + "</article>", "\n".join(["long text"] * 20_000)),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page, "h") == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article class='post category-social'><p>a</p></article>", "a"),
        ("<article class='tag-cookies'><p>a</p><div class='comments-area'>no</div></article>", "a"),
        ("<div id='content-sidebar-wrap'><article><p>a</p></article><div class='sidebar'>no</div></div>", "a"),
        ("<div class='layout-sidebar-right'><main><p>a</p></main></div>", "a"),
        ("<div class='layout-sidebar-right'><div class='text'><p>most of the text</p></div><div class='sidebar-right'>no</div></div>", "most of the text"),
        ("<form><p>most of the text</p><form class='search'>no</form></form>", "most of the text"),
        ("<form><div><article><p>a</p><form>no</form></article></div></form>", "a"),
        ("<form><article>the article</article><div class='related'><article>no</article></div></form>", "the article"),
        ("<article><p>a</p></article><div class='related'><article>a longer one</article><article>and another</article></div>", "a"),
        ("<article><p>a</p><div class='comments'><article class='comment'>longer than the article is</article></div></article>", "a"),
        ("<article><section class='social-history'><p>a</p></section><div class='cookie-box'>no</div></article>", "a"),
        ("<div class='with-sidebar layout-no-sidebar'><p>a</p></div><p>more text than in there</p>", "a\nmore text than in there"),
        ("<article><pre><code>x = 1 <span class='hljs-comment'># adds one</span></code></pre></article>", "x = 1 # adds one"),
        ("<article><h2 id='related-work'>Related work</h2><p>a</p></article>", "Related work\na"),
        ("<article><section id='social-policy'><p>a</p></section><section id='comments'><p>b</p></section></article>", "a\nb"),
        ("<article><p class='notice'>a</p><span class='share'>b</span><ul class='post-comments'><li>no</ul></article>", "a\nb"),
        ("<div class='post-header'><h1>Title</h1></div><div><p>a</p></div><div class='site-footer'>no</div>", "Title\na"),
        ("<article class='social'><p>the article with most of the text</p></article><article>x</article>", "the article with most of the text\nx"),
    ],
)
def test_names_leave_the_article(page, text):
    assert html_text.main_text(page, "h") == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><a href=\"/hidden-gems\">link</a> <a href=/hidden>too</a></article>", "link too"),
        ("<article data-title=\"Hidden treasures\" data-hidden data-id='sidebar'><p title='class=ad'>a</p></article>", "a"),
        ("<article><p data-style='display:none' data-role=\"navigation\" title='x hidden'>a</p></article>", "a"),
        ("<article><p\nID=x HIDDEN>no</p><div class = 'ad'>no</div><p title='a=b'hidden>no</p><p x=1 aria-hidden=true>no</p><p/hidden>no</p>a</article>", "a"),
        ("<article><p hidden>no</p><p ROLE=\"navigation\" >no</p><p data-x = \"hidden\" >a</p></article>", "a"),
    ],
)
def test_whole_attribute_names(page, text):
    assert html_text.main_text(page, "h") == text


def site(k):
    return f"<html><body><article><div class='box'><span>Shared words of the site</span></div><p>Own text {k}</p><p>Shared line</p></article></body></html>"


@pytest.mark.parametrize("most", [500_000, 0])  # broadcast, and joined
def test_site_style_tree(spark, monkeypatch, most):
    monkeypatch.setattr(html_text, "BROADCAST_NODES", most)
    pages = [(k, f"http://a.example/{k}", site(k)) for k in range(30)] + [(k, f"http://b.example/{k}", site(k)) for k in range(3)]
    pages += [(k, "http://copies.example/", site(0)) for k in range(40, 60)] + [(99, None, None), (99, "http://a.example/0", "")]
    got = extract(spark, pages)
    for k in range(30):  # the box is alike on all pages of the host; the shared line is where contents differ
        assert got[k, f"http://a.example/{k}"] == f"Own text {k}\nShared line"
    for k in range(3):  # too few pages to tell
        assert got[k, f"http://b.example/{k}"] == f"Shared words of the site\nOwn text {k}\nShared line"
    # copies of one page tell nothing, and all of it is kept
    assert got[40, "http://copies.example/"] == "Shared words of the site\nOwn text 0\nShared line"
    assert got[99, None] == "" and got[99, "http://a.example/0"] == ""


WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()


def plain_site(k, article):
    """A page whose boilerplate has no tell-tale names; its page number and edition differ on every page."""
    body = " ".join(f"{w}{(k * 7 + i * i) % 97}" for i, w in enumerate(WORDS))
    main = f"<h1>Title {k}</h1><div class='c2'><p>{body}.</p><p>The {WORDS[k % 20]} of {k}.</p></div>"
    main = f"<article>{main}<div class='c9'>Read our terms of use before you copy this text, page {k}</div></article>" if article else f"<div class='c1'>{main}</div>"
    return f"<body><div class='c0'><a href='/'>Home</a> <a href='/x'>All texts of the site</a></div>{main}<div class='c8'><div>Edition {k} of the daily paper, printed and bound in the old town</div></div></body>"


@pytest.mark.parametrize("article", [True, False])
@pytest.mark.parametrize("most", [500_000, 0])
def test_boilerplate_without_names(spark, monkeypatch, most, article):
    monkeypatch.setattr(html_text, "BROADCAST_NODES", most)
    pages = [(k, f"http://plain.example/{k}", plain_site(k, article)) for k in range(60)]
    got, without = extract(spark, pages), [html_text.main_text(h, "plain.example") for _, _, h in pages]
    body = lambda k: " ".join(f"{w}{(k * 7 + i * i) % 97}" for i, w in enumerate(WORDS))
    assert [got[k, u] for k, u, _ in pages] == [f"Title {k}\n{body(k)}.\nThe {WORDS[k % 20]} of {k}." for k in range(60)]
    assert sum(got[k, u] != without[k] for k, u, _ in pages) == 60  # the tree alone removes these


def entropy(counts, m):
    return -sum(c / sum(counts) * math.log(c / sum(counts), m) for c in counts)


@pytest.mark.parametrize("batch, shard", [(2048, 32 << 20), (3, 200)])
def test_style_tree_is_the_entropy_of_all_pages(spark, monkeypatch, batch, shard):
    monkeypatch.setattr(html_text, "BATCH_PAGES", batch)
    monkeypatch.setattr(html_text, "SHARD_BYTES", shard)
    hosts = {"a.example": [site(k % 25) + "<div>" * (k % 3) + f"<i>tail {k % 4}</i>" for k in range(40)], "b.example": [plain_site(k, True) for k in range(12)], "c.example": [site(1)] * 9}
    pages = spark.createDataFrame([(k, f"http://{h}/", p) for h, ps in hosts.items() for k, p in enumerate(ps)], "page_id long, url string, html string")
    got = {r.key & (1 << 64) - 1: (r.presentation, r.content, r.weight) for r in html_text.style_tree(pages).collect()}
    wanted = {}
    for host, ps in hosts.items():
        looks, words, units = (defaultdict(lambda: defaultdict(set)) for _ in range(3))
        for p in ps:
            root = html_text.parse(p, host)
            name = html_text.main_text(p, host)
            for node, _, whole, children in html_text.tree_nodes(root):
                units[node.key]["all"].add(name)
                if children:
                    looks[node.key][tuple(c.tag for c in children)].add(name)
                for w in html_text.own_text(node, whole).split():
                    words[node.key][w].add(name)
        for key, u in units.items():
            if (m := len(u["all"])) >= html_text.LEAST_PAGES:
                look = entropy([len(x) for x in looks[key].values()], m) if looks[key] else 0.0
                df = [len(x) for x in words[key].values()]
                content = 1 - sum(n * math.log(n, m) for n in df) / sum(df) if df else 1.0
                wanted[key] = (look, content, html_text.DECAY ** len(looks[key]))
    assert len(wanted) > 5 and set(got) == set(wanted)
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in wanted.items())


def article(body, k=0):
    return f"<html><body><nav>n</nav><div class='ad-box'>{k}</div><article><h1>T</h1><div class='body'>{body}</div></article></body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        ("<p>one <b>two</b></p>", "one two"),
        ("<ul><li>a</li><li>b</li></ul><blockquote>c</blockquote><table><tr><td>d</td></tr></table>", "a\nb\nc\nd"),
        ("<section><span>words</span></section>", "words"),
    ],
)
@pytest.mark.parametrize("copies", [12, 40])
def test_copies_tell_nothing(spark, body, text, copies):
    """Copies of an article, also where their pages differ around it, take nothing of its text."""
    pages = [(k, f"http://copies.example/{k}", article(body, k % 9)) for k in range(copies)] + [(1000 + k, f"http://copies.example/o{k}", article(f"<p>other {k}</p>")) for k in range(2)]
    got = extract(spark, pages)
    assert {got[k, f"http://copies.example/{k}"] for k in range(copies)} == {f"T\n{text}"}


def test_words_of_sentences_stay(spark):
    pages = [(k, f"http://a.example/{k}", article(f"<p><b>Note:</b> own {k}</p>")) for k in range(30)]
    assert extract(spark, pages)[7, "http://a.example/7"] == "T\nNote: own 7"


def test_documents(spark, sf):
    got = html_text.op3_html_extraction(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/pages.parquet").count()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in got:  # the generator's pages: one article of a heading, paragraphs and breaks
        inner = re.search("(?s)<article>(.*?)</article>", pages[r.page_id])[1]
        lines = [" ".join(html.unescape(re.sub("<(?:br|b|/b|i|/i)>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


def test_no_pages(spark):
    assert extract(spark, []) == {}
