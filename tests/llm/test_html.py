import html as std
import random
import re

from leadlens.llm import html
from leadlens.llm import queries as Q
from leadlens.llm.common import table
from tests.conftest import SF_SMALL

TOP = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>";</script></head><body>
<header class="site-header"><h1>Site name</h1><nav><ul><li><a href=x>Home</a><li><a>About us</a></ul></nav></header>
<div id="cookieConsent"><p>We use cookies, long enough to look like any other paragraph of text on this page.</p></div>"""
END = """<aside><p>Sidebar text that goes on for quite some time, as sidebars do, about other things.</p></aside>
<section id="comments"><article class="comment"><p>A reader wrote this long comment about the article above it.</p></article></section>
<form><label>Name</label><input><textarea>type</textarea></form><footer>&copy; 2020</footer>"""


def test_parts_that_are_no_article_text():
    body = "<article><header><h1>Head</h1></header><p>First   para\n&lt;b&gt; &#233;&nbsp;x.<div class='ad'>Buy</div><p><b>Open<br>bold<p>End.</article>"
    want = "Head\nFirst para <b> é x.\nOpen bold\nEnd."
    assert html.main_text(TOP + body + END) == want
    assert html.main_text(TOP + body.replace("article>", "main>") + END) == want
    assert html.main_text(TOP + "<div class='page with-sidebar'>" + body + "</div>" + END) == want


def test_region_without_article_element():
    paras = ["A paragraph that is long enough to be content, number %d." % i for i in range(5)]
    inner = "".join(f"<p>{p}</p>" for p in paras[:3]) + "<p>Short.</p><ul><li>one<li>two</ul>" + "".join(f"<p>{p}" for p in paras[3:])
    links = "<div class=x>" + "".join(f"<a href={i}>l{i}</a> " for i in range(9)) + "</div>"
    want = "\n".join([*paras[:3], "Short.", "one", "two", *paras[3:]])
    assert html.main_text(f"{TOP}{links}<div class=post>{inner}</div>{links}{END}") == want


def test_random_articles_come_back_whole():
    rng = random.Random(9)
    for _ in range(200):
        blocks = [" ".join(rng.choice(["to", "&x", "<y>", "élan", "word", "a" * 30]) for _ in range(rng.choice([1, 1, 5, 60]))) for _ in range(rng.randint(1, 12))]
        body = "".join(rng.choice(["<p>%s</p>", "<p>%s", "<div> %s </div>", "<p><b>%s<br><p>", "<h2>%s</h2>", "<blockquote><i>%s</i></blockquote>"]) % std.escape(b).replace(" ", rng.choice([" ", "\n\t", "  "])) for b in blocks)
        assert html.main_text(f"{TOP}<article>{body}</article>{END}") == "\n".join(blocks)


def test_edges(spark):
    long = "<article>" + "<p>some words</p>" * 50_000
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain"), (4, "u", "<article>"), (5, "u", "<nav>x</nav>"), (6, "u", long),
            (7, "u", "<p>a &amp b &#x41; </i></p></div><"), (7, "u", "<p>a")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id bigint, url string, html string, TEXT string")
    out = html.extract(df)
    assert out.columns == ["page_id", "url", "text"]
    got = sorted((r.page_id, r.url, r.text) for r in out.collect() if r.page_id != 6 and r.page_id is not None and r.url)
    assert got == [(2, "u", ""), (3, "u", "plain"), (4, "u", ""), (5, "u", ""), (7, "u", "a"), (7, "u", "a & b A\n<")]
    assert out.where("page_id = 1").collect()[0].text == ""
    assert out.where("page_id = 6").collect()[0].text == "\n".join(["some words"] * 50_000)
    assert html.extract(df.limit(0)).count() == 0


def test_query_matches_plain_cut(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in Q.op9_html_extraction(spark, SF_SMALL).collect()}
    for r in table(spark, SF_SMALL, "pages").collect():
        a = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = [" ".join(std.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", a)]
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id] == (want, len(want))


def paragraphs(n, size, name):
    return [f"{name} {i} " + "word " * (size // 5) + "end." for i in range(n)]


def marked(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def test_bodies_split_over_containers_come_back_whole():
    links = "<div class=x>" + "".join(f"<a href={i}>l{i}</a> " for i in range(9)) + "</div>"
    lead, body, last = paragraphs(1, 300, "lead"), paragraphs(5, 200, "body"), paragraphs(1, 250, "last")
    short = [*body[:2], "Short.", *body[2:]]
    for parts in ([lead, short], [short, last], [lead, short, last]):
        page = "".join(f"<div>{marked(x)}</div>" for x in parts)
        want = "\n".join(t for x in parts for t in x)
        assert html.main_text(f"{TOP}<div class=page>{page}</div>{END}") == want
        assert html.main_text(f"{TOP}{links}{page}{links}{END}") == want


def test_teaser_articles_beside_the_body():
    body, teasers = paragraphs(6, 300, "body"), paragraphs(3, 150, "teaser")
    beside = "".join(f"<article><h2>See</h2><p>{t}</p></article>" for t in teasers)
    assert html.main_text(f"{TOP}<div class=post>{marked(body)}</div><div>{beside}</div>{END}") == "\n".join(body)
    assert html.main_text(f"{TOP}<div>{beside}</div><div class=post>{marked(body)}</div>{END}") == "\n".join(body)
    # one article of a page whose other text outweighs it is a part; the larger one is the page's text
    got = html.main_text(f"{TOP}<article>{marked(teasers)}</article><div class=post>{marked(body)}</div>{END}").split("\n")
    assert got == [*teasers, *body]
    assert html.main_text(f"{TOP}<article>{marked(body)}</article><div>{marked(teasers)}</div>{END}") == "\n".join(body)


def test_names_with_words_of_their_own():
    """Only names made of template words are menus and the like; what else holds such a word stays."""
    body = paragraphs(4, 300, "body")
    for name in ("related-work", "discussion-of-results", "header-content", "notice-period", "share-price", "socialHistory", "with-sidebar"):
        for attr in ("class", "id"):
            want = "\n".join([*body[:2], "More about this.", *body[2:]])
            part = f'<div {attr}="{name}"><p>More about this.</p></div>'
            assert html.main_text(f"{TOP}<article>{marked(body[:2])}{part}{marked(body[2:])}</article>{END}") == want
            assert html.main_text(f'{TOP}<div {attr}="{name}">{marked(body)}</div>{END}') == "\n".join(body)
    for name in ("related-articles", "post-x social-links", "site-header", "shareButtons", "ad-box", "comment-list", "col newsletter-box"):
        part = f'<div class="{name}"><p>Not about this.</p></div>'
        assert html.main_text(f"{TOP}<article>{marked(body[:2])}{part}{marked(body[2:])}</article>{END}") == "\n".join(body)


def test_suspect_elements_with_most_of_the_text():
    """Names are no reason to drop the article itself, nor to return nothing of a page with text."""
    body = paragraphs(5, 400, "body")
    for name in ("notice", "announcement-box", "social", "promo", "header"):
        assert html.main_text(f'{TOP}<div class="{name}">{marked(body)}</div>{END}') == "\n".join(body)
        inline = f'<p>Start <span class="{name}">{"word " * 30}</span> end.</p>'
        assert html.main_text(f"{TOP}<article>{marked(body)}{inline}</article>{END}") == "\n".join([*body, "Start end."])
    # the rest of the page is enough text: the suspect part goes
    assert html.main_text(f'{TOP}<div class=post>{marked(body)}</div><div class="notice">{marked(paragraphs(3, 300, "notice"))}</div>{END}') == "\n".join(body)
    # readers outweigh the article and still go, but for a page with nothing else
    readers = f'<div class="discussion">{marked(paragraphs(30, 300, "reader"))}<nav>menu</nav><script>x</script></div>'
    assert html.main_text(f"<body><article>{marked(body)}</article>{readers}</body>") == "\n".join(body)
    assert html.main_text(f"<body>{readers}</body>") == "\n".join(paragraphs(30, 300, "reader"))
    assert html.main_text('<body><div class="cookie-notice"><p>We use cookies.</p></div></body>') == ""
