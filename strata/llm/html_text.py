"""Main text of HTML pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks.  Each block is a vector of its tag
path and its hashed words; a bidirectional LSTM in numpy reads the whole
sequence both ways and labels every block as main text or not.  The labeller
is trained on template pages written here, and on a bounded sample of the
given pages whose own markup says what their blocks are.
"""

from __future__ import annotations

import html as htmllib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 64, 32, 8, 16
DIM = PATH_DIM + WORD_DIM + SHAPE_DIM
TRAIN_PAGES = 300  # bound of the sample of given pages
TEMPLATE_PAGES = 500
EPOCHS = 10

# a quoted value with a tag in it has lost its second quote: the tag then ends at its first >
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+(?:>|\Z)|[^>]*(?:>|\Z))", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
# Fixed values of HTML: elements that do not break a line of text, without content, or whose content is no text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TAGS = frozenset("script style noscript template svg math iframe object textarea select option head title".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
FOREIGN = frozenset(("svg", "math"))
_SELF_CLOSED = re.compile(r"/\s*>?\Z")
DEEP = 64  # enclosing elements that a block remembers: those farther out weigh less than 0.0001 in its vector
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}


class Block:
    """A leaf: its text, its path of (tag, class and id words) and how much of it is link text."""

    __slots__ = ("text", "path", "linked", "tag")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked
        self.tag = path[-1][0] if path else ""


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks in page order: runs of text between block-level tags, character references decoded,
    white space made single spaces.  Comments, scripts, styles, titles and controls hold no text."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    outer: list[tuple[str, tuple]] = []  # those of them that break a line
    count: dict[str, int] = {}  # open elements by tag
    run: list[str] = []
    linked = at = hidden = links = 0

    def pop() -> str:
        nonlocal hidden, links
        t = stack.pop()[0]
        if t not in INLINE:
            outer.pop()
        count[t] -= 1
        hidden -= t in HIDDEN_TAGS
        links -= t == "a"
        return t

    def close(tags: set, stop: set) -> None:
        """End the innermost open element of ``tags``, unless one of ``stop`` is met first."""
        if not any(count.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in stop:
                return

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(htmllib.unescape("".join(run)).split())
            if text:
                out.append(Block(text, tuple(outer[-DEEP:]), linked))
            run.clear()
        linked = 0

    n = len(page)
    while at < n:
        m = _MARK.search(page, at)
        end = m.start() if m else n
        if stack and stack[-1][0] == "head" and page[at:end].strip():  # text ends an open head
            pop()
        if end > at and not hidden:
            piece = page[at:end]
            run.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if stack and stack[-1][0] == "head" and not m.group(1):
            if tag in ("html", "head"):
                continue
            if tag not in IN_HEAD:  # so does what cannot stand in it
                pop()
        if tag == "br":
            run.append(" ")
        if m.group(1):
            if tag not in INLINE:
                flush()
            if count.get(tag):
                while pop() != tag:
                    pass
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P:
                close({"p"}, {"div", "article", "section", "td", "li", "main", "body", "blockquote"})
            if tag in SAME and tag != "p":
                close(SAME[tag], {"ul", "ol", "dl", "table"})
        foreign = tag in FOREIGN or any(count.get(t) for t in FOREIGN)
        if tag in VOID or (foreign and _SELF_CLOSED.search(m.group(3) or "")):  # elsewhere a last slash means nothing
            continue
        if tag in RAW:  # everything up to the end tag is its content
            ends = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = ends.end() if ends else n
            continue
        words = [w for a in _ATTR.finditer(m.group(3) or "") for w in _NAME.findall((a[2] or a[3] or a[4] or "").lower())]
        stack.append((tag, tuple(words)))
        if tag not in INLINE:
            outer.append(stack[-1])
        count[tag] = count.get(tag, 0) + 1
        hidden += tag in HIDDEN_TAGS
        links += tag == "a"
    flush()
    return out


def _slot(token: str, dim: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode("utf-8", "replace"))
    return h % dim, 1.0 if h >> 31 else -1.0


class _WordSlots(dict):
    """Slot of a word, plus WORD_DIM if its sign is negative; remembered up to a fixed number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        i, sign = _slot(word, WORD_DIM)
        at = self[word] = i if sign > 0 else i + WORD_DIM
        return at


class Vectors:
    """Input vectors of blocks; tag and word hashes are remembered."""

    def __init__(self) -> None:
        self.slots = _WordSlots()
        self.paths: dict[tuple, np.ndarray] = {}

    def path(self, path: tuple) -> np.ndarray:
        v = self.paths.get(path)
        if v is None:
            v = np.zeros(PATH_DIM, np.float32)
            for depth, (tag, words) in enumerate(reversed(path)):
                for token in (tag, *("." + w for w in words)):
                    i, s = _slot(token, PATH_DIM)
                    v[i] += s * 0.85**depth
            if len(self.paths) > 50_000:
                self.paths.clear()
            self.paths[path] = v
        return v

    def block(self, b: Block) -> np.ndarray:
        v = np.zeros(DIM, np.float32)
        v[:PATH_DIM] = self.path(b.path)
        words = b.text.lower().split()
        count = np.bincount(list(map(self.slots.__getitem__, words)), minlength=2 * WORD_DIM)
        v[PATH_DIM:PATH_DIM + WORD_DIM] = (count[:WORD_DIM] - count[WORD_DIM:]) / len(words)
        n = len(b.text)
        v[-SHAPE_DIM:] = (
            np.log1p(len(words)) / 3, np.log1p(n) / 5, min(1.0, b.linked / n), b.text[-1] in ".!?…", len(words) < 4,
            "©" in b.text or "copyright" in b.text[:200].lower(), b.text.count(".") / 10 if n < 2000 else 1.0, 1.0)
        return v


class Labeller:
    """Bidirectional LSTM over block vectors with one logistic output per block."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {}
        for d in "fb":
            self.p["W" + d] = r.normal(0, 0.2, (DIM, 4 * HIDDEN))
            self.p["U" + d] = r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            self.p["c" + d] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]
        self.p["v"] = r.normal(0, 0.2, 2 * HIDDEN)
        self.p["a"] = np.zeros(1)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States of one direction over x[time, page, dim]; padded steps keep the state."""
        t, n, _ = x.shape
        w = self.p["W" + d]
        h, c = np.zeros((n, HIDDEN), w.dtype), np.zeros((n, HIDDEN), w.dtype)
        z = (x.reshape(t * n, DIM) @ w + self.p["c" + d]).reshape(t, n, 4 * HIDDEN)
        out, tape = np.zeros((t, n, HIDDEN), w.dtype), [None] * t
        mask = mask.astype(w.dtype)
        for s in (range(t) if d == "f" else range(t - 1, -1, -1)):
            g = z[s] + h @ self.p["U" + d]
            gate = 1 / (1 + np.exp(-np.clip(g[:, :3 * HIDDEN], -30, 30)))
            i, f, o = (gate[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN:])
            m = mask[s][:, None]
            new = f * c + i * u
            th = np.tanh(new)
            tape[s] = (h, c, i, f, o, u, th, m)
            c = m * new + (1 - m) * c
            h = m * (o * th) + (1 - m) * h
            out[s] = h
        return out, tape

    def scores(self, x: np.ndarray, mask: np.ndarray) -> tuple:
        hf, tf = self._run(x, mask, "f")
        hb, tb = self._run(x, mask, "b")
        h = np.concatenate([hf, hb], 2)
        return h @ self.p["v"] + self.p["a"][0], h, tf, tb

    def single(self) -> "Labeller":
        """The same labeller in single precision, for labelling."""
        m = Labeller()
        m.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return m

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        s, h, *tapes = self.scores(x, mask)
        e = (1 / (1 + np.exp(-s)) - y) * mask / mask.sum()
        g = {"v": np.einsum("tn,tnk->k", e, h), "a": np.array([e.sum()])}
        for d, tape, at in (("f", tapes[0], slice(0, HIDDEN)), ("b", tapes[1], slice(HIDDEN, None))):
            t, n, _ = x.shape
            dz = np.zeros((t, n, 4 * HIDDEN))
            gu = np.zeros_like(self.p["U" + d])
            dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for k in (range(t - 1, -1, -1) if d == "f" else range(t)):
                h0, c0, i, f, o, u, th, m = tape[k]
                dh = dh + e[k][:, None] * self.p["v"][at]
                a = m * dh
                b = m * dc + a * o * (1 - th * th)
                dz[k] = np.concatenate([b * u * i * (1 - i), b * c0 * f * (1 - f), a * th * o * (1 - o), b * i * (1 - u * u)], 1)
                gu += h0.T @ dz[k]
                dh = dz[k] @ self.p["U" + d].T + (1 - m) * dh
                dc = b * f + (1 - m) * dc
            g["W" + d] = np.einsum("tnd,tnk->dk", x, dz)
            g["U" + d], g["c" + d] = gu, dz.sum((0, 1))
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = 16, rate: float = 0.01) -> None:
        """Adam over batches of pages of like length."""
        r = np.random.default_rng(9)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        pages = sorted(pages, key=lambda p: len(p[1]))
        groups, step = [pages[i:i + batch] for i in range(0, len(pages), batch)], 0
        for _ in range(epochs):
            for at in r.permutation(len(groups)):
                x, mask = padded([p[0] for p in groups[at]])
                y = np.zeros(mask.shape)
                for k, (_, lab) in enumerate(groups[at]):
                    y[:len(lab), k] = lab
                step += 1
                for k, g in self.gradient(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    q[k] = 0.99 * q[k] + 0.01 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.99**step)) + 1e-8)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(p) for p in pages)
    x, mask = np.zeros((t, len(pages), DIM), np.float32), np.zeros((t, len(pages)))
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, 1
    return x, mask


# What markup says about a block: class and id words or tags of main text and of everything else.
MAIN = frozenset("article main".split())
OTHER = frozenset("nav header footer aside form button figure figcaption menu dialog".split())
OTHER_WORDS = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer masthead menu modal nav navbar navigation newsletter notice pagination popup promo related reply respond share sidebar signup social sponsor sponsored subscribe tags toolbar widget".split())


def marked(block: Block) -> int | None:
    """1 or 0 if the block's own path says main text or not, else None.  The innermost word counts."""
    main = None
    for tag, words in block.path:
        if tag in OTHER or OTHER_WORDS.intersection(words):
            if not (tag == "header" and main):
                main = 0
        elif tag in MAIN and main is None:
            main = 1
    return main


def _masked(path: tuple, r: np.random.Generator, share: float) -> tuple:
    """The path with some telling tags and class words taken away, so that context has to tell."""
    return tuple((("div" if tag in MAIN | OTHER and r.random() < share else tag),
                  tuple(w for w in words if r.random() >= share)) for tag, words in path)


def template_page(r: np.random.Generator) -> tuple[str, list[int]]:
    """A page in one of many layouts, of invented words, and the label of each of its blocks."""
    syl = ["ta", "re", "mo", "li", "na", "che", "vor", "st", "in", "un", "dor", "pe", "qua", "sel", "bri", "ö", "é", "ñ"]

    def word() -> str:
        return "".join(r.choice(syl, r.integers(1, 4)))

    def words(a: int, b: int, end: str = "") -> str:
        return (" ".join(word() for _ in range(r.integers(a, b)))).capitalize() + end

    def text(a: int, b: int) -> str:
        return " ".join(words(3, 18, ".") for _ in range(r.integers(a, b)))

    def pick(*x: str) -> str:
        return x[r.integers(len(x))]

    out, labels = [], []

    def put(s: str, label: int | None = None, n: int = 1) -> None:
        out.append(s)
        if label is not None:
            labels.extend([label] * n)

    def links(n: int, tag: str) -> None:
        for _ in range(n):
            put(f"<{tag}><a href='/{word()}'>{words(1, 4)}</a></{tag}>", 0)

    def box(kind: str) -> None:
        if kind == "nav":
            a, b = pick(("<nav><ul>", "</ul></nav>"), ("<div class='menu'><ul>", "</ul></div>"), ("<ul id='navbar'>", "</ul>"))
            put(a)
            links(r.integers(2, 9), "li")
            put(b)
        elif kind == "header":
            put(pick("<header>", "<div class='header'>", "<div id='masthead'>") + f"<div>{words(1, 4)}</div>", 0)
            put(f"<p>{words(3, 8)}</p></div></header>", 0)
        elif kind == "ad":
            put(f"<!-- {word()} --><div class='{pick('ad', 'advert', 'promo', 'banner', 'sponsored')}'>{text(1, 4)}</div>", 0)
        elif kind == "notice":
            put(f"<div class='{pick('cookie-notice', 'consent', 'notice', 'popup')}'><p>{text(1, 3)}</p>", 0)
            put(f"<button>{words(1, 3)}</button></div>", 0)
        elif kind == "side":
            put(pick("<aside>", "<div class='sidebar'>", "<div class='widget related'>") + f"<h3>{words(1, 4)}</h3><ul>", 0)
            links(r.integers(2, 7), "li")
            put("</ul>")
            if r.random() < 0.5:
                put(f"<p>{text(1, 3)}</p>", 0)
            put("</div></aside>")
        elif kind == "form":
            put(f"<form action='/{word()}'><label>{words(1, 3)}</label><input name=q><select><option>{word()}</select><button>{words(1, 2)}</button></form>", 0,
                2)
        elif kind == "comments":
            put(pick("<section class='comments'>", "<div id='comments'>", "<div class='discussion replies'>") + f"<h3>{words(1, 3)}</h3>", 0)
            for _ in range(r.integers(1, 6)):
                put(f"<div class='{pick('comment', 'reply', 'post-reply')}'><p>{words(1, 3)}</p>", 0)
                put(f"<p>{text(1, 5)}</p></div>", 0)
            put("</div></section>")
        elif kind == "footer":
            put(pick("<footer>", "<div class='footer'>", "<div id='bottom'>") + f"{pick('&copy;', 'Copyright')} {word()} &middot; {words(2, 8, '.')}</div></footer>", 0)

    put(f"<!DOCTYPE html><html><head><title>{words(3, 8)}</title><style>p{{margin:0}}</style><script>var a='</p>';</script></head><body>")
    for kind in ("header", "nav", "notice", "ad", "form", "side"):
        if r.random() < {"nav": 0.85, "ad": 0.5}.get(kind, 0.3):
            box(kind)
    a, b = pick(("<article>", "</article>"), ("<main>", "</main>"), ("<div class='content'>", "</div>"), ("<div class='post-body'>", "</div>"),
                ("<div>", "</div>"), ("<section>", "</section>"))
    put(a)
    if r.random() < 0.85:
        put(f"<h1>{words(2, 10)}</h1>", 1)
    for _ in range(r.integers(1, 14)):
        kind = r.random()
        if kind < 0.7:
            put(f"<p>{text(1, 7)}</p>", 1)
        elif kind < 0.78:
            put(f"<p><b>{words(1, 9, '.')}<br>", 1)
            put(f"<p>{text(1, 5)}</p>", 1)
        elif kind < 0.86:
            put(f"<h2>{words(1, 6)}</h2>", 1)
        elif kind < 0.92:
            k = int(r.integers(2, 5))
            put("<ul>" + "".join(f"<li>{words(3, 14)}</li>" for _ in range(k)) + "</ul>", 1, k)
        elif kind < 0.95:
            put(f"<blockquote>{text(1, 3)}</blockquote>", 1)
        elif kind < 0.975:
            put(f"<p>{words(1, 3, '.')}</p>", 1)
        else:
            box(pick("ad", "ad", "form"))
    put(b)
    for kind in ("comments", "side", "nav", "ad", "form", "footer"):
        if r.random() < {"comments": 0.4, "footer": 0.85}.get(kind, 0.3):
            box(kind)
    put("</body></html>")
    return "".join(out), labels


def train(pages: DataFrame | None, html: str = "html", seed: int = 21) -> Labeller:
    """Fit the labeller on TEMPLATE_PAGES template pages and at most TRAIN_PAGES given pages, chosen by hash.

    Only blocks that a given page's own markup settles are taught from it,
    and pages where some are main text and some are not.  In half of all
    pages the telling tags and class words are masked.
    """
    r = np.random.default_rng(seed)
    vec, data = Vectors(), []

    def add(blocks: list[Block], labels: list[int]) -> None:
        share = 0.0 if r.random() < 0.5 else 0.6
        for b in blocks:
            b.path = _masked(b.path, r, share)
        data.append((np.stack([vec.block(b) for b in blocks]), np.array(labels, float)))

    for _ in range(TEMPLATE_PAGES):
        page, labels = template_page(r)
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise AssertionError("template labels do not fit its blocks")
        add(blocks, labels)
    if pages is not None:
        some = pages.select(html).filter(F.col(html).isNotNull()).withColumn("_o", F.xxhash64(html)).orderBy("_o").limit(TRAIN_PAGES)
        for row in some.select(html).toLocalIterator():  # at most TRAIN_PAGES pages
            blocks = leaf_blocks(row[0])
            labels = [marked(b) for b in blocks]
            if {0, 1} <= set(labels) and None not in labels and len(labels) <= 400:
                add(blocks, labels)
    model = Labeller()
    model.fit(data)
    return model


def label_pages(pages: list[list[Block]], model: Labeller, vec: Vectors, steps: int = 400_000) -> list[np.ndarray]:
    """Per page, whether each block is main text.  Pages of like length run together, whole."""
    out: list[np.ndarray] = [np.zeros(0, bool) for _ in pages]
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        end = at + 1
        most = 8 + 5 * len(pages[order[at]]) // 4  # little padding
        while end < len(order) and len(pages[order[end]]) <= most and (end - at + 1) * len(pages[order[end]]) * HIDDEN <= steps:
            end += 1
        x, mask = padded([np.stack([vec.block(b) for b in pages[i]]) for i in order[at:end]])
        s = model.scores(x, mask)[0]
        for k, i in enumerate(order[at:end]):
            out[i] = s[:len(pages[i]), k] > 0
        at = end
    return out


def extract(pages: DataFrame, model: Labeller, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_main.

    ``text`` joins the blocks labelled main text by newlines, in page order;
    NULL and empty pages and pages without such a block give an empty text.
    Repeated rows give repeated rows.
    """
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vec, single = Vectors(), model.single()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                blocks = [leaf_blocks(h) for h in part.column(2).to_pylist()]
                main = label_pages(blocks, single, vec)
                text = ["\n".join(x.text for x, m in zip(bs, ms) if m) for bs, ms in zip(blocks, main)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()),
                     pa.array([len(x) for x in blocks], pa.int64()), pa.array([int(m.sum()) for m in main], pa.int64())],
                    ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"])

    return pages.select(key, url, html).mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint, n_blocks bigint, n_main bigint")
