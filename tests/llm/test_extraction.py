import random

import pytest

from basketlab.llm.extraction import Extractor, extract_text, fit_weights, token_class

P = "Some words of running text that make up a paragraph of the page."
P_ = f"<p>{P}</p>"


@pytest.fixture(scope="module")
def get():
    return Extractor(fit_weights())


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p><p>x';</script></head><body>{body}</body></html>"


MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
CASES = {
    "article": (f"{MENU}<div class='ad'>Buy</div><article><h1>Title</h1><p>{P}<p><b>{P}<br></article><footer>(c)</footer>",
                f"Title\n{P}\n{P}"),
    "entities once": ("<article><p>a &amp;lt; b &eacute;&nbsp;&#169;</p></article>", "a &lt; b é ©"),
    "white space": ("<article><p>  a \n\t b<br/>c  </p>\n<p>d</p></article>", "a b c\nd"),
    "surroundings inside": (f"<article><header><h1>T</h1></header><p>{P}</p><div class='ad-box'>Buy</div><aside>x</aside>"
                            f"<form><label>n</label><input></form><p>{P}</p><section id='comments'><p>{P * 4}</p></section>"
                            "<style>p{}</style><footer>by me</footer></article>", f"T\n{P}\n{P}"),
    "no article element": (f"<header><a href=x>Site</a>{MENU}</header><div class='cookie-notice'>We use cookies on this site</div>"
                           f"<div class='content'><h2>Title words here</h2><p>{P}</p><ul><li>{P}</li></ul><p>{P}</p></div>"
                           f"<div class='sidebar'><h3>Links</h3>{MENU}</div><div class='footer'>All rights</div>",
                           f"Title words here\n{P}\n{P}\n{P}"),
    "other articles": (f"<main><article><p>{P}</p><p>{P}</p></article></main><article><p>short teaser</p></article>", f"{P}\n{P}"),
    "hidden": (f"<article><p>{P}</p><p hidden>no</p><p style='display: none'>no</p></article>", P),
    "inline markup": ("<article><p>one<b>two</b> <i>three</i><!-- x --></p></article>", "onetwo three"),
    "stray brackets": ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(get, name):
    body, text = CASES[name]
    assert get.text(page(body)) == text


TEASER = "<article><p>A short teaser of some other post.</p></article>"


@pytest.mark.parametrize("body", [f"<div>{P_ * 3}</div>{TEASER}", f"{TEASER}<div>{P_ * 3}</div>",
                                  f"<div>{P_}{TEASER}\n{' ' * 500}{P_ * 2}</div>", f"<div>{P_ * 3}</div>{TEASER * 3}"])
def test_text_outside_a_small_article_stays(get, body):
    assert get.text(page(body)).split("\n").count(P) == 3


def test_white_space_outside_the_article_does_not_count(get):
    body = f"<main><h1>Title</h1>{P_}</main>\n{' ' * 2000}<p>Teaser words.</p>\n"
    assert get.text(page(body)) == f"Title\n{P}"


def test_articles_of_one_size_all_stay(get):
    assert get.text(page(f"<article>{P_}</article>" * 3)) == "\n".join([P] * 3)


@pytest.mark.parametrize("tag", [
    "a href='/the-hidden-cost'", "p title='A hidden gem'", "p title=\"it's hidden\"", "a href='?id=search'", "p data-id='menu-3'",
    "p data-class=ad", "p data-hidden", "p data-x='a' data-y='class=ad hidden'", "p title='hidden'", "div class='has-sidebar'",
    "div class='no-comments'", "div class='hasSidebar wide'", "div class=page-with-sidebar", "div id=without-menu",
    "section id='discussion'", "section id='related-work'", "section id=search", "section id=comments-on-the-text",
    "section id=sidebar-effects", "h2 id=comments"])
def test_attributes_that_name_no_surroundings(get, tag):
    name = tag.split()[0]
    inside = f"<{tag}>{P}</{name}>"
    assert get.text(page(f"<article>{P_}<div>{inside}</div>{P_}</article>")) == "\n".join([P] * 3)
    if name != "a":  # the words of a link aren't running text
        assert get.text(page(f"<div>{P_}<div>{inside}</div>{P_}</div>")) == "\n".join([P] * 3)


@pytest.mark.parametrize("tag", ["article title='The hidden valley'", "article id='related-work'", "article class='post no-comments'",
                                 "div class='has-sidebar'", "div class='no-comments'", "div title='hidden'"])
def test_wrappers_that_name_no_surroundings(get, tag):
    assert get.text(page(f"<{tag}>{P_ * 3}</{tag.split()[0]}>")) == "\n".join([P] * 3)


@pytest.mark.parametrize("attrs", [
    "hidden", "HIDDEN=''", "hidden=hidden", "title='x' hidden", "title=x\nhidden", "aria-hidden='true'", "style='color:red;display : none'",
    "class=sidebar", "class='wide comments-no-avatar'", "id=comments", "id='post-comments'", "id='ad-slot-3'", "id=disqus_thread",
    "role=search", "data-x=\"'\" class='ad'"])
def test_attributes_that_name_surroundings(get, attrs):
    assert get.text(page(f"<article>{P_}<div {attrs}><p>no</p></div>{P_}</article>")) == f"{P}\n{P}"


@pytest.mark.parametrize("tag", ["article class='post ad-free'", "div class='entry comments-open'", "article class='entry social-science'"])
def test_names_of_the_text_beat_words_of_its_layout(get, tag):
    assert get.text(page(f"{MENU}<{tag}>{P_ * 3}</{tag.split()[0]}>")) == "\n".join([P] * 3)


@pytest.mark.parametrize("tag", ["section class='social-science'", "div class='related-work'", "p class='alert-threshold'"])
def test_topics_inside_an_article(get, tag):
    assert get.text(page(f"<article>{P_}<{tag}>{P}</{tag.split()[0]}>{P_}</article>")) == "\n".join([P] * 3)


@pytest.mark.parametrize("name", ["related-posts", "ad-leaderboard", "share-buttons", "cookie-notice", "reader-comments", "post-comments",
                                  "promo-card", "comments-list", "newsletter-box", "ad-300x250", "notice"])
def test_surroundings_inside_an_article(get, name):
    assert get.text(page(f"<article>{P_}<div class='{name}'><p>no words</p></div>{P_}</article>")) == f"{P}\n{P}"


LINKS = "<ul>" + "".join(f"<li><a href=x>Source number {i}</a></li>" for i in range(5)) + "</ul>"
LINES = "\n".join(f"Source number {i}" for i in range(5))
TOPICS = "<div>" + "<a href=x>Topic</a> | " * 8 + "</div>"
NUMBERS = "<table>" + "".join(f"<tr><td>{i}</td><td>{i * 3}</td><td>{i * 7}</td></tr>" for i in range(20)) + "</table>"
PLAIN = {  # pages without an article element
    "a table inside": (f"<div>{P_ * 3}{NUMBERS}{P_ * 3}</div>",
                       "\n".join([P] * 3 + [str(i * k) for i in range(20) for k in (1, 3, 7)] + [P] * 3)),
    "contents": (f"<div><h2>Contents</h2>{LINKS}{P_ * 3}</div>", "\n".join(["Contents", LINES] + [P] * 3)),
    "sources": (f"<div>{P_ * 3}<h2>Sources</h2>{LINKS}</div>", "\n".join([P] * 3 + ["Sources", LINES])),
}


@pytest.mark.parametrize("name", PLAIN)
def test_the_region_decides(get, name, monkeypatch):
    body, text = PLAIN[name]
    html = page(f"{TOPICS}{body}{TOPICS}<div>Imprint</div>")
    assert get.text(html) == text
    monkeypatch.setattr(get, "region", lambda items: (0, len(items) - 1))
    assert get.text(html) != text


def test_region_against_all_stretches(get):
    rng = random.Random(4)
    words = ["word", "two words", "<p>", "</p>", "<div>", "</div>", "<a href=x>", "</a>", "<h2>", "</h2>", "<nav>", "</nav>", "<td>", " "]
    for _ in range(300):
        items = list(get.parse.items("".join(rng.choices(words, k=rng.randint(0, 25)))))
        scores = [get.weights.get(token_class(k, v, out, h, a), get.other_tag if k == "tag" else 0.0) * (len(v.split()) if k == "text" else 1)
                  for k, v, out, _, h, a, _ in items]
        best = max([0.0, *(sum(scores[i:j]) for i in range(len(items)) for j in range(i + 1, len(items) + 1))])
        first, last = get.region(items)
        assert sum(scores[first:last + 1]) == pytest.approx(best)


def test_edges(get):
    assert get.text("") == ""
    assert get.text("just words") == "just words"
    assert get.text("<div></div>") == ""
    assert get.text("<article><p>cut off <b") == "cut off <b"
    assert get.text("<script>never closed") == ""
    assert get.text("<p a=\"" * 50).strip() is not None


def test_long_page_is_whole(get):
    body = "<article>" + "".join(f"<p>paragraph {i} of a long page</p>" for i in range(20000)) + "</article>"
    assert get.text(page(body)).count("\n") == 19999


def test_signs():
    w = fit_weights()
    assert w[("word", "text")] > 0 and all(x < 0 for c, x in w.items() if c[0] == "tag")


def test_rows(spark):
    rows = [(1, "u", page(f"<article><p>{P}</p></article>")), (2, None, None), (None, "v", ""), (1, "u", "x")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text) for r in extract_text(df).collect()), key=str)
    assert got == sorted([(1, "u", P), (2, None, ""), (None, "v", ""), (1, "u", "x")], key=str)
    assert extract_text(df.limit(0)).count() == 0
