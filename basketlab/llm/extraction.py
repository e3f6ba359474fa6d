"""Main text of HTML pages by the maximum-scoring subsequence.

A page becomes a sequence of tokens: words and tags.  Each token has the
weight of its class, a log ratio of how often the class occurs inside and
outside the marked content of labelled pages: words of running text score
positive, tags negative, words of menus and the like negative too.  One linear
scan finds the contiguous region with the largest sum.  If one article element
holds most of its text, the region becomes that element, otherwise it is widened
to whole blocks and to the sections that a heading opens beside it in its
container; elements inside it that aren't part of the text (menus, forms,
adverts, comments, ...) are left out.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from basketlab.llm.common import text_slices

# HTML elements by their part in a page.
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math object canvas select xmp noembed noframes".split())
LEFT_OUT = set("head nav aside footer form button menu dialog datalist fieldset audio video map".split())
ARTICLE = set("article main".split())
SPACE = "br img input hr wbr".split()
# Words in class, id and role that name what surrounds an article.
SURROUND = set("""ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promos
    promotion promoted sidebar sidebars sidenav aside comment comments commentlist respond response responses replies reply
    disqus discussion notice notices cookie cookies consent gdpr alert popup popups modal overlay toast newsletter subscribe
    subscription signup paywall related recommended recommendations share sharing social breadcrumb breadcrumbs menu menus
    navbar nav navigation navigator pager pagination toolbar widget widgets complementary contentinfo search dialog""".split())
FRAME = set("header footer masthead topbar bottombar".split())  # count outside articles only
OWN = set("article post entry content story body text main".split())  # names of the article's own parts
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = set("address article blockquote body center details div figure footer header html main section td th".split())
# Ids are also anchors of chapters.  Inside an article, and on elements that hold text, an id names a
# surrounding only if it is made of these words, a word that is no topic of a chapter being one of them.
QUALIFIERS = set("has have no non not with without".split())  # what follows describes a layout ("has-sidebar")
SURE = set("""ad ads adv advert adverts sponsored promo promos sidebar sidebars sidenav comment comments commentlist disqus
    popup popups modal overlay toast newsletter signup paywall breadcrumb breadcrumbs navbar nav navigator pager pagination
    toolbar widget widgets contentinfo""".split())
NEUTRAL = OWN | FRAME | set("""area articles bar block bottom box button buttons card cards center column container form group
    icon icons image info inner item items label left link links list message module news outer pages panel policy posts region
    right row section slot stories strip tags thread title tools top unit wrap wrapper zone""".split())
# A class that ends in one of these describes the layout ("ad-free", "comments-open").
STATES = set("allowed closed disabled enabled free less off on open".split())
ANCHORED = HEADINGS | {"article", "section", "p"}

# Labelled pages: content lies between <!--[--> and <!--]-->.  Words are placeholders; only classes are counted.
_TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen. "
_P = (f"<p>{_TEXT * 2}</p><p>{_TEXT}<a href=x>link words</a> {_TEXT}</p><p><b>one</b> <i>two</i> <em>three</em> <strong>four"
      f"</strong> <code>five</code> <span>six</span> <u>seven</u> <sup>8</sup> <sub>9</sub> <small>ten</small> {_TEXT}</p>")
_TABLE = "<table>" + "<tr><td>1</td><td>22</td><td>333</td></tr>" * 30 + "</table>"
_MENU = "<ul>" + "<li><a href=x>menu item</a></li>" * 6 + "</ul>"
LABELLED = [
    f"<body><nav>{_MENU}</nav><div class=ad>buy this now please</div><article><!--[--><h1>a title of words</h1>{_P * 2}"
    "<!--]--></article><footer>copyright by someone</footer></body>",
    f"<body><header><a href=x>site name</a>{_MENU}</header><div><div><!--[--><h2>a title here</h2>{_P}<ul><li>{_TEXT}</li>"
    f"<li>{_TEXT}</li></ul>{_P}<!--]--></div><div class=sidebar><h3>links</h3>{_MENU}<p>short words</p></div></div>"
    "<div class=footer><p>all rights</p><a href=x>terms</a> <a href=x>privacy</a></div></body>",
    f"<body><div><a href=x>home</a> | <a href=x>news</a> | <a href=x>more</a></div><div><!--[--><h1>title words</h1>{_P}"
    f"<blockquote>{_TEXT}</blockquote>{_P}<!--]--></div><div class=comments><p>reader words here</p><p>other reader</p></div>"
    f"<form><label>name</label><input><button>send</button></form><div>{_MENU}</div></body>",
    f"<body><div><span>login</span> <span>join</span></div><table><tr><td>{_MENU}</td><td><!--[--><p>{_TEXT * 3}</p>"
    f"<p>{_TEXT * 2}</p><!--]--></td><td><a href=x>a</a><br><a href=x>b</a></td></tr></table><div><a href=x>c</a></div></body>",
    f"<body><div><a href=x>home</a> <a href=x>news</a></div><div><!--[--><h1>title words</h1>{_P}{_TABLE}{_P}<!--]--></div></body>",
]


class Tokenizer:
    """Parses pages into items: ("text", raw, state) and ("tag", name, state)."""

    def __init__(self):
        import re
        self.tags = re.compile(
            r"<!--(?P<comment>.*?)(?:--!?>|\Z)"
            r"|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
            r"|<(?P<close2>/)?(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>"
            r"|<[!?/][^>]*+>?", re.S)
        self.attr = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>][^\s>]*)))?").finditer
        self.words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])").findall

    def surrounds(self, name: str, attrs: str, in_article: bool) -> bool:
        """Whether an element isn't part of the text around it."""
        if name in LEFT_OUT:
            return True
        if name == "header":
            return not in_article
        if not attrs.strip() or name in ("html", "body", "main"):
            return False
        values: dict[str, str] = {}
        for m in self.attr(attrs):  # the first of a name counts
            values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        if "hidden" in values or values.get("aria-hidden", "").strip().lower() == "true":
            return True
        if "display:none" in "".join(values.get("style", "").lower().split()):
            return True
        for key in ("class", "id", "role"):
            own = name == "article"  # or a class before this one names a part of the text
            for one in values.get(key, "").split():
                words = self.own_words(one)
                parts = set(words)
                if key == "id" and (in_article or name in ANCHORED):
                    if name not in HEADINGS and parts & SURE and parts <= SURE | NEUTRAL:
                        return True
                # "article-body" names a part of the text; "post-comments" doesn't
                elif parts & SURROUND:
                    known = len(words[-1]) < 3 or words[-1] in SURROUND or words[-1] in NEUTRAL
                    # "social-science" in an article is a topic; "ad-free" and "post ad-layout" describe the text's layout
                    if words[-1] not in STATES and (known or not (own or in_article and not parts & SURE)):
                        return True
                elif not in_article and not own and not parts & OWN and parts & FRAME:
                    return True
                own = own or bool(parts) and parts <= OWN
        return False

    def own_words(self, name: str) -> list[str]:
        """The words of a class or id, up to one that makes the rest describe a layout."""
        words = [w.lower() for w in self.words(name)]
        return words[:next((i for i, w in enumerate(words) if w in QUALIFIERS), None)]

    def items(self, html: str):
        """(kind, value, left_out, article, heading, link, home): article numbers the open article element, home the
        innermost open container, 0 outside and for the page's own body."""
        import re
        at, stack, articles, homes = 0, [], 0, 0
        out, article, heading, link, home = 0, 0, 0, 0, 0  # open elements of each kind
        while at < len(html):
            m = self.tags.search(html, at)
            end = m.start() if m else len(html)
            if end > at:
                yield "text", html[at:end], out > 0, article, heading > 0, link > 0, home
            if not m:
                return
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                if m["comment"] is not None:
                    yield "comment", m["comment"], out > 0, article, False, False, home
                continue
            attrs = m["attrs"] if m["name"] else m["attrs2"]
            if name in RAW:  # all up to the closing tag is no text
                if not (m["close"] or m["close2"] or attrs.endswith("/")):
                    closing = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                    at = closing.end() if closing else len(html)
                continue
            if m["close"] or m["close2"]:
                if any(x[0] == name for x in stack):
                    while stack:
                        gone, was = stack.pop()
                        out, article, heading, link, home = was
                        if gone == name:
                            break
                yield "tag", name, out > 0, article, heading > 0, link > 0, home
                continue
            yield "tag", name, out > 0, article, heading > 0, link > 0, home
            if name in VOID or attrs.endswith("/"):
                continue
            if name == "p" or name in HEADINGS or name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                # these end an open element of their kind (also its unclosed inline elements) within the same parent
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name or (name in BLOCKS and stack[k][0] == "p"):
                        out, article, heading, link, home = stack[k][1]
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCKS:
                        break
            stack.append((name, (out, article, heading, link, home)))
            out += self.surrounds(name, attrs, article > 0)
            if name in ARTICLE and not out and not article:
                articles += 1
                article = articles
            heading += name in HEADINGS
            link += name == "a"
            if name in CONTAINERS and name not in ("html", "body"):
                homes += 1
                home = homes


def token_class(kind: str, value: str, left_out: bool, heading: bool, link: bool) -> tuple:
    if kind == "tag":
        return ("tag", value, left_out)
    return ("word", "left out" if left_out else "link" if link else "heading" if heading else "text")


def fit_weights(pages: list[str] = LABELLED, smoothing: float = 0.5) -> dict[tuple, float]:
    """Weight of every token class: log of its rate inside over its rate outside the marked content.

    Words of running text and headings are held above 0.2 and tags below -0.05,
    whatever the counts, so that the signs are those of the method.  What is
    left out of the text anyway costs little, so that the region may span it.
    """
    parse, seen = Tokenizer(), {True: Counter(), False: Counter()}
    for page in pages:
        inside = False
        for kind, value, out, _, heading, link, _ in parse.items(page):
            if kind == "comment":
                inside = value == "[" if value in "[]" else inside
            else:
                c = token_class(kind, value, out, heading, link)
                seen[inside][c] += len(value.split()) if kind == "text" else 1
    kinds = set(seen[True]) | set(seen[False])
    total = {s: sum(seen[s].values()) + smoothing * len(kinds) for s in seen}
    raw = {c: math.log((seen[True][c] + smoothing) / total[True]) - math.log((seen[False][c] + smoothing) / total[False])
           for c in kinds}
    return {c: max(w, 0.2) if c in (("word", "text"), ("word", "heading")) else
            -0.05 if c[-1] == "left out" or c[-1] is True else min(w, -0.05) if c[0] == "tag" else w for c, w in raw.items()}


class Extractor:
    def __init__(self, weights: dict[tuple, float]):
        import re
        self.weights, self.parse = weights, Tokenizer()
        tags = [w for c, w in weights.items() if c[0] == "tag"]
        self.other_tag = sum(tags) / len(tags) if tags else -1.0
        self.spaces = re.compile(r"\s+").sub

    def region(self, items: list[tuple]) -> tuple[int, int]:
        """First and last item of the subsequence with the largest sum (empty: no word scores)."""
        best, span, here, start = 0.0, (0, -1), 0.0, 0
        get = self.weights.get
        for i, (kind, value, out, _, heading, link, _) in enumerate(items):
            if kind == "comment":
                continue
            w = get(token_class(kind, value, out, heading, link), self.other_tag if kind == "tag" else 0.0)
            if kind == "text":
                w *= len(value.split())
            if here <= 0:
                here, start = 0.0, i
            here += w
            if here > best:
                best, span = here, (start, i)
        return span

    def with_sections(self, items: list[tuple], first: int, last: int) -> tuple[int, int]:
        """The region with the sections at its ends, such as a list of links, that a heading opens in its container."""
        words = [i for i in range(first, last + 1) if items[i][0] == "text" and not items[i][2] and not items[i][1].isspace()]
        if not words:
            return first, last
        for step, at, word in ((-1, first, words[0]), (1, last, words[-1])):
            home = items[word][6]
            if not home or items[at][6] != home:
                continue
            head = step > 0 and items[word][4]  # the region ends in a heading
            end = start = at
            while 0 <= end + step < len(items) and items[end + step][6] == home:
                end += step
                if items[end][0] == "text" and items[end][4] and not items[end][2]:
                    head, start = True, end
            if head and step > 0:
                last = end
            elif head:
                first = start
        return first, last

    def text(self, html: str) -> str:
        """Main text of a page: a line per block."""
        import html as entities
        items = list(self.parse.items(html))
        first, last = self.region(items)
        if last < first:
            return ""
        inside = Counter()  # characters of each article in the region, 0: outside articles
        for kind, value, out, article, *_ in items[first:last + 1]:
            if kind == "text" and not out:
                inside[article] += sum(map(len, value.split()))
        own = max(inside, key=lambda a: (inside[a], -a), default=0)
        if own and 2 * inside[own] > inside.total():  # the article that holds most of the region, as a whole
            chosen = [i for i, x in enumerate(items) if x[3] == own]
            first, last = chosen[0], chosen[-1]
        else:  # whole blocks
            while first > 0 and not (items[first - 1][0] == "tag" and items[first - 1][1] in BLOCKS):
                first -= 1
            while last + 1 < len(items) and not (items[last + 1][0] == "tag" and items[last + 1][1] in BLOCKS):
                last += 1
            first, last = self.with_sections(items, first, last)
            own = None
        blocks, run = [], []
        for kind, value, out, article, *_ in items[first:last + 1]:
            if kind == "text":
                if not out and (own is None or article == own):
                    run.append(entities.unescape(value))
            elif kind == "tag" and value in BLOCKS:
                blocks.append("".join(run))
                run = []
            elif kind == "tag" and value in SPACE:
                run.append(" ")
        blocks.append("".join(run))
        lines = (self.spaces(" ", b).strip() for b in blocks)
        return "\n".join(x for x in lines if x)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 labelled: list[str] = LABELLED) -> DataFrame:
    """One row per page: ``page_id, url, text``.

    The weights are fitted to the ``labelled`` pages (content between the
    comments ``[`` and ``]``).  Defined cases: a null or empty html has an
    empty text; html without tags is one block; unclosed elements end with
    their parent; very long pages are read whole; of sibling articles the one that
    holds more than half of the region's text is the page's text, else all of
    them; other columns, also of clashing names, are not read; one row per
    input row, also for repeated or null ids; an empty table gives none.
    """
    weights = fit_weights(labelled)
    rows = pages.select(F.struct(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).alias("own"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches):
        import pyarrow as pa
        get = Extractor(weights)
        for own, html in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x["page_id"] for x in own], pa.int64()), pa.array([x["url"] for x in own], pa.string()),
                 pa.array([get.text(h) for h in html], pa.string())], names=["page_id", "url", "text"])

    return rows.mapInArrow(run, "page_id long, url string, text string")
