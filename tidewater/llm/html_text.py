"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: the text between two borders of block elements.
Each block has features of its ancestors (tags, class and id words) and of its
text.  A chain of two labels, main text or not, is trained on labelled pages by
maximum likelihood and decoded by Viterbi; blocks labelled main form the text.
Scripts, styles, templates and the page's head never form blocks; the text of formulas,
drawings, embedded objects and their fallbacks belongs to the block it stands in.
"""

from __future__ import annotations

import random
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Elements of the HTML standard.
SILENT = frozenset("script style template head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section select summary table tbody td textarea tfoot th thead tr ul""".split())
#: What a start tag closes if it is open, up to the nearest border.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Blocks(HTMLParser):
    """Leaf blocks of a page: (path, text, characters inside links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[tuple, str, int]] = []
        self.stack: list[tuple[str, tuple]] = []
        self.text: list[str] = []
        self.silent = self.links = self.linked = 0

    def updatepos(self, i, j):                     # line numbers are not needed
        return j

    def _flush(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((tuple(s for s in self.stack if s[0] in BLOCK), text, self.linked))
            self.text, self.linked = [], 0

    def _pop(self, at: int):
        for tag, _ in self.stack[at:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.stack[at:]

    def _close(self, tags, borders):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                self._pop(i)
                return
            if self.stack[i][0] in borders:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._flush()
            if self.silent and any(t == "head" for t, _ in self.stack):   # a head that was never closed
                self._pop(next(i for i, (t, _) in enumerate(self.stack) if t == "head"))
            self._close({"p"}, BLOCK - {"p"})
            if tag in CLOSES:
                self._close(*CLOSES[tag])
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        words = ()
        if attrs and tag != "a":
            words = tuple(sorted({w.lower() for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label")
                                  for w in _WORDS.findall(v)} | {k for k, v in attrs if k == "hidden" or k == "style" and v
                                                                 and re.search(r"display\s*:\s*none", v)}))
        self.stack.append((tag, words))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and tag not in ("a", "b", "i", "em", "strong", "span"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._flush()
        elif tag == "br":
            self.text.append(" ")
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return
            if self.stack[i][0] in BLOCK and tag not in BLOCK:
                return

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())


def leaf_blocks(html: str) -> list[tuple[tuple, str, int]]:
    p = Blocks()
    p.feed(html)
    p.close()
    p._flush()
    return p.blocks


def path_features(path: tuple) -> list[str]:
    out = {"tag=" + path[-1][0] if path else "tag="}
    for tag, words in path:
        out.add("in=" + tag)
        out.update("word=" + w for w in words)
    return sorted(out)


#: Words of page furniture.
FURNITURE = {
    "rights": ("©", "(c)", "all rights reserved"), "cookie": ("cookie",), "subscribe": ("subscribe", "sign up", "log in", "login", "newsletter"),
    "reply": ("reply", "comments", "posted by"), "share": ("share", "tweet", "follow us"), "ad": ("advertisement", "sponsored"),
}


def text_features(text: str, linked: int) -> list[str]:
    n = len(text)
    share = linked / n
    out = ["long=" + ("0" if n < 20 else "1" if n < 80 else "2" if n < 200 else "3" if n < 600 else "4"),
           "linked=" + ("0" if share == 0 else "1" if share < 0.4 else "2" if share < 0.9 else "3")]
    if text[-1] in ".!?…":
        out.append("ends")
    low = text.lower()
    return out + ["says=" + name for name, words in FURNITURE.items() if any(w in low for w in words)]


# --- the chain ----------------------------------------------------------------------------

class Chain:
    """Weights of the two-label chain; label 1 is main text."""

    def __init__(self, weight: dict[str, float], step: np.ndarray):
        self.weight, self.step = weight, step          # weight of label 1 over 0; step[from, to]
        self._paths: dict[tuple, float] = {}

    def emissions(self, blocks) -> list[float]:
        get, known, out = self.weight.get, self._paths, []
        for path, text, linked in blocks:
            e = known.get(path)
            if e is None:
                e = sum(get(f, 0.0) for f in path_features(path)) + get("bias", 0.0)
                if len(known) < 50_000:
                    known[path] = e
            out.append(e + sum(get(f, 0.0) for f in text_features(text, linked)))
        return out

    def decode(self, blocks) -> list[int]:
        """Viterbi."""
        (s00, s01), (s10, s11) = self.step.tolist()
        back, a, b = [], 0.0, 0.0
        for i, e in enumerate(self.emissions(blocks)):
            if i == 0:
                a, b = 0.0, e
                continue
            from0, from1 = a + s00 < b + s10, a + s01 < b + s11
            back.append((from0, from1))
            a, b = max(a + s00, b + s10), max(a + s01, b + s11) + e
        if not blocks:
            return []
        label = int(b > a)
        out = [label]
        for from0, from1 in reversed(back):
            label = int(from1 if label else from0)
            out.append(label)
        return out[::-1]

    def main_text(self, html: str) -> str:
        blocks = leaf_blocks(html)
        return "\n\n".join(b[1] for b, y in zip(blocks, self.decode(blocks)) if y)


def fit(pages: list[tuple[list, list[int]]], steps: int = 300, rate: float = 0.1, l2: float = 2e-5) -> Chain:
    """Maximum likelihood by forward-backward over padded pages; deterministic."""
    index: dict[str, int] = {"bias": 0}
    rows, flat = [], []
    longest = max(len(b) for b, _ in pages)
    label = np.zeros((len(pages), longest), dtype=np.int64)
    mask = np.zeros((len(pages), longest), dtype=bool)
    for i, (blocks, ys) in enumerate(pages):
        for t, ((path, text, linked), y) in enumerate(zip(blocks, ys)):
            for f in ["bias", *path_features(path), *text_features(text, linked)]:
                rows.append(i * longest + t)
                flat.append(index.setdefault(f, len(index)))
            label[i, t], mask[i, t] = y, True
    rows, flat = np.array(rows), np.array(flat)
    w, step = np.zeros(len(index)), np.zeros((2, 2))
    theta_m, theta_v = np.zeros(len(index) + 4), np.zeros(len(index) + 4)
    pair = mask[:, 1:]
    gold_pair = np.zeros((2, 2))
    np.add.at(gold_pair, (label[:, :-1][pair], label[:, 1:][pair]), 1)
    n = mask.sum()
    for k in range(1, steps + 1):
        e = np.zeros((len(pages), longest, 2))
        e[:, :, 1] = np.bincount(rows, weights=w[flat], minlength=label.size).reshape(label.shape)
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(fwd[:, t - 1, 0, None] + step[0], fwd[:, t - 1, 1, None] + step[1]) + e[:, t]
            fwd[:, t] = np.where(mask[:, t, None], new, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nxt = bwd[:, t + 1] + e[:, t + 1]
            new = np.logaddexp(nxt[:, 0, None] + step[:, 0], nxt[:, 1, None] + step[:, 1])
            bwd[:, t] = np.where(mask[:, t + 1, None], new, 0)
        z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        p1 = np.exp(np.minimum(0, fwd[:, :, 1] + bwd[:, :, 1] - z[:, None])) * mask
        g_w = np.bincount(flat, weights=(p1 - label * mask).ravel()[rows], minlength=len(index)) / n + l2 * w
        both = np.zeros((2, 2))
        for a in range(2):
            for b in range(2):
                both[a, b] = (np.exp(np.minimum(0, fwd[:, :-1, a] + step[a, b] + e[:, 1:, b] + bwd[:, 1:, b] - z[:, None])) * pair).sum()
        g = np.concatenate([g_w, ((both - gold_pair) / n + l2 * step).ravel()])
        theta_m += 0.1 * (g - theta_m)
        theta_v += 0.01 * (g * g - theta_v)
        move = rate * (theta_m / (1 - 0.9**k)) / (np.sqrt(theta_v / (1 - 0.99**k)) + 1e-8)
        w, step = w - move[:-4], step - move[-4:].reshape(2, 2)
    return Chain({f: float(w[i]) for f, i in index.items()}, step)


# --- labelled pages -----------------------------------------------------------------------

class _Page:
    """Writes one labelled page: every block of text is added with its label."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.out: list[str] = []
        self.labels: list[int] = []

    def words(self, lo: int, hi: int) -> str:
        syllables = "an be ci do el fu ga hi in ko la mo ne or pu ra si to un ve wo za ent ion sch eau".split()
        word = lambda: "".join(self.r.choice(syllables) for _ in range(self.r.randint(1, 4)))
        text = [word() for _ in range(self.r.randint(lo, hi))]
        form = self.r.random()
        if form < 0.08:
            text = [w.upper() + "!!" for w in text]
        elif form < 0.16:
            text = [w + self.r.choice(["###", "***", " |"]) for w in text]
        elif form < 0.2:
            text = [text[0]] * len(text)
        return " ".join(text).capitalize() + self.r.choice([".", ".", "", "!", "?"])

    def block(self, tag: str, label: int, lo: int, hi: int, attrs: str = "", link: bool = False, before: str = ""):
        text = before + self.words(lo, hi)
        body = f'<a href="/x">{text}</a>' if link else text
        if not link and self.r.random() < 0.2:
            body = f"<b>{body}" + self.r.choice(["</b>", "<br>", ""])
        end = "" if tag in ("p", "li") and self.r.random() < 0.15 else f"</{tag}>"
        self.out.append(f"<{tag}{attrs}>{body}{end}")
        self.labels.append(label)

    def open(self, tag: str, attrs: str = ""):
        self.out.append(f"<{tag}{attrs}>")

    def shut(self, tag: str):
        self.out.append(f"</{tag}>")

    def box(self, tag: str, attrs: str, fill, *args):
        self.open(tag, attrs)
        fill(*args)
        self.shut(tag)

    def named(self, *names: str) -> str:
        name = self.r.choice(names)
        return self.r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {self.r.choice(names)}"', f' class="site-{name}"'])

    def menu(self):
        self.open("ul")
        for _ in range(self.r.randint(2, 7)):
            self.block("li", 0, 1, 2, link=True)
        self.shut("ul")

    def lines(self, label: int, lo: int, hi: int, few: int = 1, many: int = 3):
        for _ in range(self.r.randint(few, many)):
            self.block("p", label, lo, hi)

    def form(self):
        self.open("form", self.r.choice(["", ' class="search"', ' class="newsletter-form"', ' id="login"']))
        for _ in range(self.r.randint(1, 3)):
            self.block(self.r.choice(["p", "div", "legend"]), 0, 1, 6)
        self.block("button", 0, 1, 2)
        self.shut("form")

    def comments(self):
        def one():
            self.block(self.r.choice(["div", "h4", "p"]), 0, 1, 4, self.named("comment-author", "author", "comment-meta"))
            self.lines(0, 3, self.r.choice([60, 60, 250]))

        self.open(*self.r.choice([("section", ' id="comments"'), ("div", ' class="comments"'), ("div", ' id="disqus_thread"'), ("ol", ' class="comment-list"'),
                                  ("section", ' class="comments-area responses"'), ("div", ' class="reader-comments discussion"')]))
        tag = self.out[-1][1:].split()[0]
        if tag != "ol":
            self.block("h3", 0, 1, 3)
        for _ in range(self.r.randint(1, 4)):
            self.box(self.r.choice(["div", "article", "li"]), self.r.choice([' class="comment"', ' class="comment-body"', ' class="reply comment"']), one)
        self.shut(tag)

    def side(self):
        tag = self.r.choice(["aside", "aside", "div", "section"])
        self.open(tag, self.named("sidebar", "widget", "related", "recommended", "side", "rail"))
        self.block("h3", 0, 1, 4)
        self.menu() if self.r.random() < 0.6 else self.lines(0, 4, 40)
        self.shut(tag)

    def advert(self):
        self.block(self.r.choice(["div", "p", "section"]), 0, 2, 30, self.named("ad", "ads", "advert", "sponsored", "promo", "advertisement", "banner"))

    def notice(self):
        tag = self.r.choice(["div", "section", "p"])
        attrs = self.named("notice", "cookie", "cookie-banner", "alert", "gdpr", "consent", "popup", "modal", "newsletter", "subscribe", "disclaimer")
        longest = self.r.choice([30, 30, 200])
        if tag == "p":
            self.block("p", 0, 3, longest, attrs)
        else:
            self.box(tag, attrs, self.lines, 0, 3, longest)

    def header(self):
        tag = self.r.choice(["header", "header", "div"])
        self.open(tag, "" if tag == "header" else self.named("header", "masthead", "topbar", "top"))
        self.block(self.r.choice(["h1", "div", "p"]), 0, 1, 5)
        if self.r.random() < 0.5:
            self.block("p", 0, 2, 12)
        self.shut(tag)

    def navigation(self):
        tag = self.r.choice(["nav", "nav", "div"])
        self.box(tag, "" if tag == "nav" else self.named("nav", "navigation", "menu", "navbar", "breadcrumb", "breadcrumbs"), self.menu)

    def footer(self):
        tag = self.r.choice(["footer", "footer", "div"])
        self.open(tag, "" if tag == "footer" else self.named("footer", "bottom", "copyright"))
        if self.r.random() < 0.4:
            self.menu()
        sign = self.r.choice(["&copy; ", "&copy; ", ""])
        for i in range(self.r.randint(1, 2)):
            self.block(self.r.choice(["p", "div", "section"]) if i else self.r.choice(["p", "div"]), 0, 3, 30, before=sign)
        self.shut(tag)

    def article(self):
        tag, attrs = self.r.choice([("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' id="content"'),
                                    ("div", ' class="article-body"'), ("div", ' class="entry-content"'), ("section", ' class="story"'), ("div", ' class="post-content"'),
                                    ("div", ' itemprop="articleBody"')])
        self.open(tag, attrs)
        if self.r.random() < 0.8:
            self.block("h1", 1, 1, 12)
        for _ in range(self.r.randint(1, 8)):
            kind = self.r.random()
            if kind < 0.66:
                self.block("p", 1, 1, 160, before=self.r.choice([""] * 24 + ["(c) "]))
            elif kind < 0.73:
                self.block(self.r.choice(["h2", "h3"]), 1, 1, 8)
            elif kind < 0.79:
                self.open("ul")
                for _ in range(self.r.randint(2, 5)):
                    self.block("li", 1, 1, 25)
                self.shut("ul")
            elif kind < 0.85:
                self.block(self.r.choice(["blockquote", "pre", "div", "figcaption"]), 1, 3, 40)
            elif kind < 0.89:
                self.open("table")
                for _ in range(2):
                    self.open("tr")
                    self.block("td", 1, 1, 5)
                    self.block("td", 1, 1, 5)
                    self.shut("tr")
                self.shut("table")
            elif kind < 0.93:
                self.advert()
            elif kind < 0.96:
                self.side()
            elif kind < 0.98:
                self.notice()
            else:
                self.form()
        if self.r.random() < 0.15:
            self.comments()
        self.shut(tag)

    def page(self) -> tuple[list, list[int]]:
        r = self.r
        for part, share in ((self.notice, 0.2), (self.header, 0.5), (self.navigation, 0.8), (self.advert, 0.5)):
            if r.random() < share:
                part()
        wrap = r.random() < 0.3
        if wrap:
            self.open("div", r.choice([' class="container"', ' id="main"', ' class="wrapper"', ' class="row"']))
        if r.random() < 0.15:
            self.side()
        self.article()
        for part, share in ((self.advert, 0.2), (self.comments, 0.4), (self.side, 0.4), (self.form, 0.25), (self.notice, 0.15)):
            if r.random() < share:
                part()
        if wrap:
            self.shut("div")
        if r.random() < 0.85:
            self.footer()
        blocks = leaf_blocks("<html><body>" + "".join(self.out) + "</body></html>")
        if len(blocks) != len(self.labels):
            raise AssertionError((len(blocks), len(self.labels), "".join(self.out)))
        return blocks, self.labels


def labelled_pages(n: int = 600, seed: int = 1) -> list[tuple[list, list[int]]]:
    return [_Page(seed * 1_000_003 + i).page() for i in range(n)]


_TRAINED: list[Chain] = []


def trained() -> Chain:
    """The chain fitted to the labelled pages (once per driver)."""
    if not _TRAINED:
        _TRAINED.append(fit(labelled_pages()))
    return _TRAINED[0]


# --- the job ------------------------------------------------------------------------------

def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every page.

    Null html counts as empty and gives an empty text; broken markup is read as
    far as it goes; repeated rows are extracted singly; an empty table gives an
    empty result; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(chain or trained())

    def run(batches):
        for whole in batches:
            for b in slices(whole, "html"):
                texts = [shared.value.main_text(h.as_py() or "") for h in b.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
