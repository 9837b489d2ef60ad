"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: maximal runs of text between block-level tags, each with the
path of its open elements. A block's features are the tags and the class / id / role words of its
ancestors, and properties of its text (length, links, punctuation, words that mark notices). The
field labels the sequence of blocks as main text or not; neighbouring blocks tend to agree.
It is trained here on labelled pages (``labelled_pages``) by maximum likelihood, and pages are
decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import ready, texts_of

TRAIN_PAGES, EPOCHS, RATE, L2 = 500, 8, 0.5, 1e-4
SEED = 7
KNOWN_PATHS = 50_000
MAX_PATH = 40

BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Content that is no text of the page, up to the end tag.
RAW_TAGS = frozenset("script style noscript template svg iframe textarea title select button object math canvas audio "
                     "video noframes xmp".split())
# A start tag of the key closes an open element of the value before it.
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
              "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
              "tfoot": ("tr", "td", "th", "thead", "tbody")}
SCOPE_TAGS = frozenset("html body table ul ol dl div section article aside main nav header footer form".split())
KEY_WORDS = frozenset(
    "cookie cookies copyright subscribe newsletter advertisement sponsored share comments comment login register menu "
    "privacy imprint impressum werbung anzeige datenschutz kommentare publicité commentaires publicidad comentarios "
    "related reply tags".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*>""",
    re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Element:
    """An open element: tag and the features of it and its ancestors as one path."""

    __slots__ = ("tag", "path", "link")

    def __init__(self, tag: str, path: tuple, link: bool):
        self.tag, self.path, self.link = tag, path, link


def _names(attributes: str) -> str:
    """Words of class, id, role and label, lower case, blank-separated."""
    if "=" not in attributes:
        return ""
    out = []
    for m in _ATTRIBUTE.finditer(attributes):
        for value in m.groups()[1:]:
            if value:
                out += [w.lower() for w in _PART.findall(value)]
    return " ".join(out[:12])


class Block:
    """A leaf block: path of (tag, names), text, and how many of its characters are in links."""

    __slots__ = ("path", "text", "link_chars")

    def __init__(self, path: tuple, text: str, link_chars: int):
        self.path, self.text, self.link_chars = path, text, link_chars


def leaf_blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with character references decoded and white space folded; none is empty."""
    blocks: list[Block] = []
    stack = [Element("", (), False)]
    text: list[str] = []
    links = 0
    block_path: tuple = ()

    def flush():
        nonlocal links, text
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                blocks.append(Block(block_path, joined, links))
            text = []
        links = 0

    pos, n = 0, len(page)
    while pos < n:
        lt = page.find("<", pos)
        if lt != pos:
            chunk = page[pos:lt if lt >= 0 else n]
            if "&" in chunk:
                chunk = entities.unescape(chunk)
            text.append(chunk)
            if stack[-1].link:
                links += len(chunk)
            if lt < 0:
                break
            pos = lt
        m = _MARKUP.match(page, pos)
        if m is None:
            text.append("<")
            pos += 1
            continue
        pos = m.end()
        closing, tag, attributes = m.group(1), m.group(2), m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCK_TAGS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK_TAGS and stack[k].tag in BLOCK_TAGS:
                    break  # an inline end tag closes nothing outside its block
            block_path = stack[-1].path
            continue
        if tag in RAW_TAGS:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, pos)
                pos = end.end() if end else n
            continue
        if tag in BLOCK_TAGS:
            flush()
            if tag != "br":
                closes = ("p", *SAME_LEVEL.get(tag, ()))
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in closes:
                        del stack[k:]
                        if tag not in SAME_LEVEL:
                            break
                    elif stack[k].tag in SCOPE_TAGS:
                        break
        if tag in VOID_TAGS or attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        top = stack[-1]
        if tag in BLOCK_TAGS or attributes:
            path = top.path + ((tag, _names(attributes)),) if len(top.path) < MAX_PATH else top.path
            if tag not in BLOCK_TAGS and not path[-1][1]:
                path = top.path
        else:
            path = top.path
        stack.append(Element(tag, path, top.link or tag == "a"))
        if not text:
            block_path = path
    flush()
    return blocks


def path_features(path: tuple) -> list[str]:
    """Features of a block's ancestors."""
    out = {"bias"}
    for tag, names in path:
        out.add(f"tag {tag}")
        for w in names.split():
            out.add(f"name {w}")
            if len(w) > 4:
                out.add(f"stem {w[:4]}")
    own = [t for t, _ in path if t in BLOCK_TAGS]
    out.add(f"own {own[-1] if own else ''}")
    out.add(f"parent {own[-2] if len(own) > 1 else ''}")
    return sorted(out)


def text_features(block: Block, k: int, n: int) -> list[str]:
    """Features of a block's text and place (block k of n)."""
    t = block.text
    words = t.split(" ", 200)
    size = min(len(words), 200)
    out = [f"words {int(math.log2(size) * 1.5)}"]
    share = block.link_chars / len(t)
    out.append(f"links {'none' if share == 0 else 'some' if share < 0.5 else 'all'}")
    out.append(f"end {t[-1] if t[-1] in '.!?:' else 'other'}")
    if t[0] in "©®™":
        out.append("mark")
    if size <= 40:
        out += {f"word {w}" for w in (x.strip(".,:;!?()").lower() for x in words) if w in KEY_WORDS}
    out.append("first" if k == 0 else "last" if k == n - 1 else "inside")
    return out


class BlockField:
    """The two-label chain: weight of each feature for the main label, start and transition weights."""

    def __init__(self, weights: dict[str, float], start: float, transitions: np.ndarray):
        self.weights, self.start, self.transitions = weights, start, transitions
        self.paths: dict[tuple, float] = {}

    def main_score(self, block: Block, k: int, n: int) -> float:
        got = self.paths.get(block.path)
        if got is None:
            if len(self.paths) >= KNOWN_PATHS:
                self.paths.clear()
            got = self.paths[block.path] = sum(self.weights.get(f, 0.0) for f in path_features(block.path))
        return got + sum(self.weights.get(f, 0.0) for f in text_features(block, k, n))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi: the likeliest labels; equal scores go to not-main."""
        if not blocks:
            return []
        (t00, t01), (t10, t11) = self.transitions.tolist()
        n = len(blocks)
        a, b = 0.0, self.start + self.main_score(blocks[0], 0, n)
        back = []
        for k in range(1, n):
            e = self.main_score(blocks[k], k, n)
            to_a, to_b = b + t10 > a + t00, b + t11 > a + t01
            back.append((to_a, to_b))
            a, b = (b + t10 if to_a else a + t00), e + (b + t11 if to_b else a + t01)
        label = b > a
        out = [label]
        for to_a, to_b in reversed(back):
            label = to_b if label else to_a
            out.append(label)
        return out[::-1]

    def extract(self, page: str) -> str:
        """Main text of a page: its main blocks in order, joined by a blank."""
        blocks = leaf_blocks(page)
        return " ".join(b.text for b, main in zip(blocks, self.decode(blocks)) if main)


def train_field(pages: list[tuple[list[Block], list[bool]]], epochs: int = EPOCHS) -> BlockField:
    """Maximum-likelihood weights by AdaGrad over the pages, gradients by forward-backward sums."""
    names: dict[str, int] = {}
    rows = []
    for blocks, labels in pages:
        feats = [[names.setdefault(f, len(names)) for f in (*path_features(b.path), *text_features(b, k, len(blocks)))]
                 for k, b in enumerate(blocks)]
        rows.append((feats, np.array(labels, np.int64)))
    w, wg = np.zeros(len(names)), np.full(len(names), 1e-6)
    t, tg = np.zeros(5), np.full(5, 1e-6)  # start, then the transitions
    order = random.Random(SEED)
    for _ in range(epochs):
        order.shuffle(rows)
        for feats, y in rows:
            n = len(feats)
            if not n:
                continue
            e = np.array([w[f].sum() for f in feats])
            trans = t[1:].reshape(2, 2)
            alpha, beta = np.empty((n, 2)), np.zeros((n, 2))
            alpha[0] = 0.0, t[0] + e[0]
            for k in range(1, n):
                x = alpha[k - 1][:, None] + trans
                alpha[k] = np.logaddexp(x[0], x[1])
                alpha[k, 1] += e[k]
            for k in range(n - 2, -1, -1):
                x = trans + beta[k + 1][None, :]
                x[:, 1] += e[k + 1]
                beta[k] = np.logaddexp(x[:, 0], x[:, 1])
            z = np.logaddexp(alpha[-1, 0], alpha[-1, 1])
            p = np.exp(alpha[:, 1] + beta[:, 1] - z)
            g = np.zeros(5)
            g[0] = y[0] - p[0]
            for k in range(1, n):
                q = alpha[k - 1][:, None] + trans + beta[k][None, :]
                q[:, 1] += e[k]
                g[1:] -= np.exp(q - z).ravel()
                g[1 + 2 * y[k - 1] + y[k]] += 1
            grad = np.zeros(len(names))
            for f, d in zip(feats, y - p):
                grad[f] += d
            at = np.flatnonzero(grad)
            gw = grad[at] - L2 * w[at]
            wg[at] += gw * gw
            w[at] += RATE * gw / np.sqrt(wg[at])
            tg += g * g
            t += RATE * g / np.sqrt(tg)
    return BlockField({f: float(w[i]) for f, i in names.items() if abs(w[i]) > 1e-4}, float(t[0]), t[1:].reshape(2, 2))


# ---- labelled pages -------------------------------------------------------------------------------

MAIN = "⌖"  # begins every main block of a labelled page; removed before features are taken

MAIN_WRAPPERS = ("article", "main", "div class=post", "div class=post-content", "div id=content", "div class=article-body",
                 "section class=entry", "div class=entry-content", "div class=story", "div id=main", "div class=text",
                 "div itemprop=articleBody class=article", "div role=main", "article class=post", "div class=page-content")
NAV = ("nav", "nav class=menu", "div class=menu", "div id=navigation", "ul class=nav", "div class=topnav", "div role=navigation",
       "div class=breadcrumb", "ul class=breadcrumbs", "div class=toolbar", "div class=pagination", "div id=menu")
ASIDE = ("aside", "div class=sidebar", "aside class=sidebar", "div id=sidebar", "div class=widget", "div class=related",
         "section class=recommended", "div class=side-bar", "div class=teaser", "div class=more-stories", "aside class=related")
ADS = ("div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "div id=ad-top", "aside class=ad",
       "div class=banner", "div class=sponsored", "section class=sponsor", "div class=promo", "div class=ad-slot",
       "div class=promotion", "div class=adsbox", "ins class=adsbygoogle")
NOTICES = ("div class=notice", "div class=cookie-notice", "div id=cookie-banner", "div class=gdpr", "div class=alert",
           "div class=popup", "div class=modal", "div role=alert", "div class=consent", "section class=notice",
           "div class=cookie", "div class=disclaimer", "div role=dialog", "div class=message")
COMMENTS = ("div class=comments", "section class=comments", "div id=comments", "div class=comment-list", "ol class=commentlist",
            "section id=reader-comments", "div class=comment", "div class=replies", "div class=discussion",
            "article class=comment", "section class=responses", "div class=user-comments")
HEADERS = ("header", "div class=header", "header class=site-header", "div id=header", "div class=masthead", "div class=top-bar")
FOOTERS = ("footer", "div class=footer", "footer class=site-footer", "div id=footer", "div class=copyright", "div class=legal")
FORMS = ("form", "form class=newsletter", "div class=subscribe", "form class=search", "div class=newsletter", "form id=login",
         "div class=signup", "form class=contact")
SHARES = ("div class=share", "div class=social", "ul class=share-buttons", "div class=social-links", "div class=tags",
          "div class=toolbox")


class PageMaker:
    """Labelled pages from random layouts; texts are random syllables, so only structure and marks can be learned."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int, stop: str = ".") -> str:
        r = self.r
        ws = ["".join(r.choice(("ba", "li", "no", "tre", "sur", "en", "qua", "mi", "sch", "ado")) for _ in range(r.randint(1, 3)))
              for _ in range(r.randint(low, high))]
        return " ".join(ws).capitalize() + (r.choice((stop, stop, stop, "", "!", "?", "###", "|")) if stop else "")

    def inside(self, spec: str, body: str) -> str:
        tag, _, attribute = spec.partition(" ")
        if attribute:
            bits = [a.partition("=") for a in attribute.split(" ")]
            attribute = "".join(f' {k}="{v}"' for k, _, v in bits)
        return f"<{tag}{attribute}>{body}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{k}">{self.words(1, 2, "")}</a>' for k in range(self.r.randint(low, high))]
        if self.r.random() < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.r.choice((" ", " | ", "")).join(items)

    def paragraph(self, main: bool) -> str:
        r, mark = self.r, MAIN if main else ""
        low, high = r.choice(((1, 3), (4, 15), (15, 60), (60, 150)))
        text = self.words(low, high)
        if main and r.random() < 0.2:
            text = text.replace(" ", f' <a href="/x">{self.words(1, 2, "")}</a> ', 1)
        if r.random() < 0.15:
            return f"<p><b>{mark}{text}<br>"
        if r.random() < 0.1:
            return f"<div>{mark}{text}</div>"
        return f"<p>{mark}{text}</p>"

    def boilerplate(self) -> str:
        r = self.r
        kind = r.randrange(9)
        texts = "".join(self.paragraph(False) for _ in range(r.randint(1, 3)))
        if kind == 0:
            return self.inside(r.choice(NAV), self.links(2, 8))
        if kind == 1:
            return self.inside(r.choice(ASIDE), f"<h3>{self.words(1, 4, '')}</h3>" + r.choice((self.links(2, 6), texts, texts + self.links(1, 4))))
        if kind in (2, 3):
            return self.inside(r.choice(ADS), r.choice((self.words(4, 25), texts, f'<a href="/ad">{self.words(3, 12)}</a>')))
        if kind == 4:
            return self.inside(r.choice(NOTICES), r.choice((self.words(4, 30), texts, "Cookie " + self.words(5, 20), f"<p>{self.words(5, 20)}</p>")))
        if kind in (5, 6):
            one = lambda: self.inside(r.choice(("div class=comment", "li", "div", "p", "article class=comment")),
                                      f"<span class=\"author\">{self.words(1, 2, '')}</span>" * r.randint(0, 1) + r.choice((self.words(3, 60), texts)))
            return self.inside(r.choice(COMMENTS), r.choice((f"<h2>{self.words(1, 2, '')}</h2>", "<h3>Comments</h3>", "")) + "".join(one() for _ in range(r.randint(1, 5))))
        if kind == 7:
            return self.inside(r.choice(FORMS), f"<label>{self.words(1, 4, '')}</label><input name=\"q\">" + r.choice(("", texts, f"<p>{self.words(4, 20)}</p>")))
        return self.inside(r.choice(SHARES), self.links(2, 5))

    def page(self) -> str:
        r = self.r
        body = []
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            if kind < 0.72:
                body.append(self.paragraph(True))
            elif kind < 0.80:
                body.append(f"<h{r.randint(2, 4)}>{MAIN}{self.words(1, 8, '')}</h{r.randint(2, 4)}>")
            elif kind < 0.85:
                tag = r.choice(("ul", "ol"))
                body.append(f"<{tag}>" + "".join(f"<li>{MAIN}{self.words(2, 20)}</li>" for _ in range(r.randint(2, 5))) + f"</{tag}>")
            elif kind < 0.88:
                body.append(f"<blockquote>{MAIN}{self.words(8, 40)}</blockquote>")
            elif kind < 0.91:
                cells = "".join(f"<td>{MAIN}{self.words(1, 4, '')}</td>" for _ in range(r.randint(2, 4)))
                body.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.93:
                body.append(f"<figure><figcaption>{MAIN}{self.words(3, 12)}</figcaption></figure>")
            else:
                body.append(self.boilerplate())
        title = f"<h1>{MAIN}{self.words(2, 10, '')}</h1>"
        inner = r.choice((title, f"<header>{title}</header>", "")) + "".join(body)
        main = self.inside(r.choice(MAIN_WRAPPERS), inner)
        if r.random() < 0.25:
            main = self.inside(r.choice(MAIN_WRAPPERS), main)
        if r.random() < 0.2:
            main = self.inside(r.choice(("div class=container", "div id=wrapper", "div class=row", "div class=page")), main)
        top = [self.inside(r.choice(HEADERS), r.choice((self.words(1, 4, ""), self.links(2, 6), f"<p>{self.words(3, 12)}</p>", f"<h1>{self.words(1, 4, '')}</h1>")))] * r.randint(0, 1)
        top += [self.boilerplate() for _ in range(r.randint(0, 3))]
        bottom = [self.boilerplate() for _ in range(r.randint(0, 3))]
        bottom += [self.inside(r.choice(FOOTERS), r.choice(("&copy; ", "", "")) + r.choice((self.words(2, 20), self.links(2, 6), f"<p>{self.words(3, 20)}</p>")))] * r.randint(0, 1)
        return "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join((*top, main, *bottom)) + "</body></html>"


def labelled_pages(n: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[list[Block], list[bool]]]:
    """Blocks and labels of ``n`` made pages."""
    maker, out = PageMaker(seed), []
    for _ in range(n):
        blocks = leaf_blocks(maker.page())
        labels = [MAIN in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MAIN, "").strip() or "x"
        out.append((blocks, labels))
    return out


@lru_cache(maxsize=1)
def default_field() -> BlockField:
    """The field trained on the default labelled pages, once per process."""
    return train_field(labelled_pages())


def extract_main(pages: DataFrame, field: BlockField, html: str = "html", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; null and textless pages have an empty text."""
    held = ready(pages.sparkSession).sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [held.value.extract(t) for t in texts_of(b, "html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html(spark, sf_dir: str) -> DataFrame:
    """Main text of ``pages``."""
    from kiln.sources.tables import table

    ready(spark)
    return extract_main(table(spark, sf_dir, "pages"), default_field())
