"""Main text of web pages by a recurrent labeller of blocks.

A page is cut into leaf blocks: the texts between the starts and ends of block
elements. Each block is read as a vector: hashed names (tags, classes, ids,
roles) of all elements around it, those of the innermost two alone, hashed words,
and a few measures of its text. A bidirectional LSTM runs over the blocks of a
page in both directions, so each block is judged in the context of the whole
page, and labels it as main text or not. The main text is the blocks so labelled.

The network is trained here, in numpy, by backpropagation through time on
generated pages: regions of all kinds (menus, headers, footers, sidebars,
notices, adverts, forms, comments, articles) in many spellings, with words of
the given pages. The driver gets at most ``train_pages`` pages' words for that,
at most ``WORDS_A_PAGE`` of each; everything else reads whole pages.

Defined cases: a NULL or empty page, and one without a block of main text, give
an empty text; scripts, styles, templates, frames, comments and the head are
markup; what is left open is closed by the end of its parent or of the page, a
tag or comment that is cut off by the end of the page is dropped; NULL and
repeated ids are rows like others; a page may be of any length and depth; a
score of exactly one half is main text; an empty table gives no rows.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .textscan import word_hashes

#: Fixed names of HTML: elements whose content is no markup, others whose content is no text of the page, those that hold nothing, those that start a block.
RAW = frozenset("script style noscript iframe title noembed noframes xmp".split())
SKIPPED = frozenset("template object svg math audio video canvas".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
#: Fixed rules of HTML: an element that starts here ends an open one of these, up to an element that bounds the search.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
ATTRIBUTES = re.compile(r"(?:[^>=]++|=[ \t\n\f\r]*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
NAMES = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
DIGIT = re.compile(r"\d")

PATH_BITS, LEAF_BITS, WORD_PLACES, MEASURES = 256, 128, 64, 8
WIDTH = PATH_BITS + LEAF_BITS + WORD_PLACES + MEASURES
WORDS_A_PAGE = 400
#: Blocks whose vectors are held at once while pages are labelled.
LOT = 20_000


@dataclass(slots=True)
class Block:
    path: int  # bits of the names of all elements around
    leaf: int  # bits of those of the innermost block element and its parent
    text: str
    linked: int  # characters inside links


@dataclass(slots=True)
class _Open:
    tag: str
    own: int
    path: int
    leaf: int


def _bits(names: list[str], width: int) -> int:
    out = 0
    for name in names:
        out |= 1 << zlib.crc32(name.encode("utf-8", "surrogatepass")) % width
    return out


@lru_cache(maxsize=10_000)
def _marks(tag: str, *named: tuple[str, str, str, str]) -> tuple[int, int]:
    """Bits of an element's names (its tag, the words of its classes, id and role) for the path and for the leaf."""
    names = [tag]
    for kind, *values in named:
        for name in re.split(r"[\s_-]+", "".join(values).lower()):
            if name:
                names += [name, kind.lower() + "." + name]
    return _bits(names, PATH_BITS), _bits(names, LEAF_BITS)


class _Page:
    """Reads one page from start to end."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.open = [_Open("", 0, 0, 0)]
        self.held = {"": 1}
        self.pieces: list[str] = []
        self.linked = self.path = 0

    def text(self, piece: str) -> None:
        if "&" in piece:
            piece = html.unescape(piece)
        self.pieces.append(piece)
        if not piece.isspace():
            self.path |= self.open[-1].path
            if self.held.get("a"):
                self.linked += len(piece.strip())

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(self.path, self.open[-1].leaf, text, self.linked))
            self.pieces, self.linked, self.path = [], 0, 0

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSES:
                self.end_first(*CLOSES[tag])
            elif self.held.get("p"):
                self.end_first(("p",), ("td", "th", "caption", "button", "object"))
        elif tag == "br":
            self.pieces.append(" ")
        elif tag == "a" and self.held.get("a"):
            self.end_first(("a",), ("td", "th", "caption", "button", "object"))
        if tag not in EMPTY:
            parent = self.open[-1]
            path, own = _marks(tag, *(NAMES.findall(attributes) if "=" in attributes else ()))
            block = tag in BLOCKS
            self.open.append(_Open(tag, own if block else parent.own, parent.path | path, own | parent.own if block else parent.leaf))
            self.held[tag] = self.held.get(tag, 0) + 1

    def end_first(self, tags: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        """Close the innermost open element of ``tags`` unless one of ``bounds`` lies within."""
        if any(self.held.get(t) for t in tags):
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag in tags:
                    self.close_to(at)
                    return
                if self.open[at].tag in bounds:
                    return

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if self.held.get(tag) and tag:
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == tag:
                    self.close_to(at)
                    return

    def close_to(self, at: int) -> None:
        for closed in self.open[at:]:
            self.held[closed.tag] -= 1
        del self.open[at:]

    def read(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            found = page.find("<", at)
            if found != at:
                self.text(page[at:found if found > 0 else n])
            if found < 0:
                break
            at = found
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = n if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), at):
                end = page.find(">", at)
                at = n if end < 0 else end + 1
            else:
                at = self.tag(page, at)

    def tag(self, page: str, at: int) -> int:
        """Reads a tag, with what it holds if that is no text; gives the place behind."""
        closing = page.startswith("</", at)
        name = TAG_NAME.match(page, at + 1 + closing)
        if not name:
            self.text("<")
            return at + 1
        rest = ATTRIBUTES.match(page, name.end())
        if not rest:
            return len(page)
        tag = name.group().lower()
        if closing:
            self.end(tag)
        elif tag in RAW or tag in SKIPPED and not rest.group().endswith("/>"):
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, rest.end())
            if end:
                return end.end()
            return len(page) if tag in RAW else rest.end()
        else:
            self.start(tag, rest.group())
        return rest.end()


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks of a page in its order, with their text decoded and its white space made single."""
    reader = _Page()
    reader.read(page or "")
    reader.flush()
    return reader.blocks


def vectors_of(pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page its blocks x ``WIDTH``."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), WIDTH), dtype=np.float32)
    ends = np.cumsum([len(page) for page in pages], dtype=np.int64)
    if blocks:
        for start, width, name in ((0, PATH_BITS, "path"), (PATH_BITS, LEAF_BITS, "leaf")):
            data = b"".join(getattr(b, name).to_bytes(width // 8, "little") for b in blocks)
            out[:, start:start + width] = np.unpackbits(np.frombuffer(data, np.uint8).reshape(len(blocks), -1), axis=1, bitorder="little")
        texts = [b.text for b in blocks]
        hashes, counts = word_hashes(texts)
        owner = np.repeat(np.arange(len(blocks)), counts)
        cells = np.bincount(owner * WORD_PLACES + (hashes % np.uint64(WORD_PLACES)).astype(np.int64), minlength=len(blocks) * WORD_PLACES)
        at = PATH_BITS + LEAF_BITS
        out[:, at:at + WORD_PLACES] = cells.reshape(-1, WORD_PLACES) / np.sqrt(np.maximum(counts, 1))[:, None]
        sizes = np.array([len(t) for t in texts], dtype=np.float64)
        page_of = np.repeat(np.arange(len(pages)), [len(page) for page in pages])
        first = np.unique(page_of, return_index=True)[1]
        largest = np.zeros(len(pages))
        largest[np.unique(page_of)] = np.maximum.reduceat(sizes, first)
        lengths = np.diff(ends, prepend=0)[page_of]
        measures = (
            np.log1p(sizes) / 5, np.log1p(counts) / 3, np.array([b.linked for b in blocks]) / sizes,
            [t[-1] in ".!?…\"'»”:" for t in texts], [t[0].isupper() for t in texts], [DIGIT.search(t) is not None for t in texts],
            (np.arange(len(blocks)) - (ends[page_of] - lengths)) / lengths, sizes / largest[page_of],
        )
        for i, measure in enumerate(measures):
            out[:, at + WORD_PLACES + i] = measure
    return np.split(out, ends[:-1]) if pages else []


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiLstm:
    """Arrays are positions x features x pages; places past the end of a page hold zero states."""

    def __init__(self, width: int = WIDTH, hidden: int = 16, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.hidden, self.weights = hidden, {}
        for d in "fb":
            self.weights[f"in_{d}"] = draw.standard_normal((4 * hidden, width)) * 0.1
            self.weights[f"rec_{d}"] = draw.standard_normal((4 * hidden, hidden)) * hidden ** -0.5
            self.weights[f"bias_{d}"] = np.concatenate((np.ones(hidden), np.zeros(3 * hidden)))[:, None]
        self.weights["out"] = draw.standard_normal((1, 2 * hidden)) * (2 * hidden) ** -0.5
        self.weights["start"] = np.zeros((1, 1))
        self.weights = {k: w.astype(np.float32) for k, w in self.weights.items()}

    def states(self, into: np.ndarray, real: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction; ``into`` is what the vectors bring to the four gates."""
        h, (length, _, pages) = self.hidden, into.shape
        out = np.zeros((length, h, pages), dtype=into.dtype)
        state, cell = np.zeros((h, pages), dtype=into.dtype), np.zeros((h, pages), dtype=into.dtype)
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            gates = into[t] + self.weights[f"rec_{d}"] @ state
            forget, take, show = _sigmoid(gates[:h]), _sigmoid(gates[h:2 * h]), _sigmoid(gates[2 * h:3 * h])
            new = np.tanh(gates[3 * h:])
            before, cell = cell, (forget * cell + take * new) * real[t]
            seen = np.tanh(cell)
            if keep is not None:
                keep.append((t, state, before, forget, take, show, new, seen))
            state = show * seen * real[t]
            out[t] = state
        return out

    def brought(self, vectors: np.ndarray, d: str) -> np.ndarray:
        return vectors @ self.weights[f"in_{d}"].T + self.weights[f"bias_{d}"][:, 0]

    def logits(self, vectors: np.ndarray, real: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Positions x pages, of vectors that are positions x pages x ``WIDTH``."""
        f, b = (self.states(self.brought(vectors, d).transpose(0, 2, 1), real, d, None if keep is None else keep.setdefault(d, [])) for d in "fb")
        if keep is not None:
            keep["states"] = np.concatenate((f, b), axis=1)
        return self._read(f, b)

    def _read(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        h, w = self.hidden, self.weights["out"][0]
        return np.einsum("h,thn->tn", w[:h], f) + np.einsum("h,thn->tn", w[h:], b) + self.weights["start"][0, 0]

    def gradients(self, vectors: np.ndarray, real: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over the real positions, by backpropagation through time."""
        keep: dict = {}
        error = (_sigmoid(self.logits(vectors, real, keep)) - labels) * real / max(1, real.sum())
        h, grads = self.hidden, {}
        grads["out"] = np.einsum("tn,thn->h", error, keep["states"])[None]
        grads["start"] = error.sum().reshape(1, 1)
        flat = vectors.reshape(-1, vectors.shape[2])
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            rec = self.weights[f"rec_{d}"]
            w = self.weights["out"][0, part][:, None]
            gates = np.zeros((len(vectors), 4 * h, vectors.shape[1]), dtype=vectors.dtype)
            grads[f"rec_{d}"] = np.zeros_like(rec)
            flow, through = np.zeros((h, vectors.shape[1]), dtype=vectors.dtype), np.zeros((h, vectors.shape[1]), dtype=vectors.dtype)
            for t, state, before, forget, take, show, new, seen in reversed(keep[d]):
                flow = (flow + w * error[t]) * real[t]
                through = (through + flow * show * (1 - seen * seen)) * real[t]
                at = gates[t]
                at[:h] = through * before * forget * (1 - forget)
                at[h:2 * h] = through * new * take * (1 - take)
                at[2 * h:3 * h] = flow * seen * show * (1 - show)
                at[3 * h:] = through * take * (1 - new * new)
                grads[f"rec_{d}"] += at @ state.T
                flow, through = rec.T @ at, through * forget
            spread = gates.transpose(0, 2, 1).reshape(-1, 4 * h)
            grads[f"in_{d}"] = spread.T @ flat
            grads[f"bias_{d}"] = spread.sum(axis=0)[:, None]
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int, batch: int, rate: float, seed: int = 2) -> None:
        """Adam over shuffled batches of (vectors, labels)."""
        draw, step = np.random.default_rng(seed), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        for epoch in range(epochs):
            order = draw.permutation(len(pages))
            for at in range(0, len(order), batch):
                some, step = [pages[i] for i in order[at:at + batch]], step + 1
                vectors, real = _padded([v for v, _ in some])
                labels = np.zeros(real.shape, dtype=np.float32)
                for i, (_, y) in enumerate(some):
                    labels[:len(y), i] = y
                for k, g in self.gradients(vectors, real, labels).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
                    self.weights[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)

    def labels(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page which of its blocks are main text."""
        out: list[np.ndarray] = [np.zeros(len(p), dtype=bool) for p in pages]
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        while order:
            # Pages of like length run side by side.
            longest = len(pages[order[-1]])
            some, order = order[-max(1, LOT // longest):], order[:-max(1, LOT // longest)]
            vectors, real = _padded([pages[i] for i in some])
            found = self.logits(vectors, real) >= 0
            for i, page in enumerate(some):
                out[page] = found[:len(pages[page]), i]
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions x pages x features, and which of the places are real."""
    length = max(len(p) for p in pages)
    vectors = np.zeros((length, len(pages), pages[0].shape[1]), dtype=np.float32)
    real = np.zeros((length, len(pages)), dtype=np.float32)
    for i, page in enumerate(pages):
        vectors[:len(page), i] = page
        real[:len(page), i] = 1
    return vectors, real


#: Words that stand around main texts, by region, and how regions are named: fixed lists for the generated pages.
PHRASES = {
    "menu": "Home|About|About us|Contact|News|Blog|Products|Services|Login|Sign up|Search|Archive|Help|FAQ|Shop|Sports|Politics|Culture|Start|Kontakt|Accueil|Inicio",
    "header": "Skip to content|The Daily Post|Your trusted source|Menu|Subscribe|My account|Breaking news|Welcome back",
    "footer": "All rights reserved.|Terms of use|Privacy policy|Imprint|Contact us|© 2024 Example Ltd.|Powered by Example|Sitemap|Follow us|Back to top",
    "sidebar": "Related articles|Most read|Popular posts|Recent comments|Categories|Tags|You may also like|Latest news|Archives|Share this|Trending now",
    "notice": "We use cookies to improve your experience. Accept all|This site uses cookies.|Accept|Decline|Subscribe to read more|You have 2 free articles left.|"
              "Please enable JavaScript.|Sign up for our newsletter|Log in to continue",
    "advert": "Advertisement|Sponsored|Buy now|Limited offer|50% off today|Order now and save|Ad|Shop the sale|Learn more|Free shipping",
    "form": "Email address|Your name|Password|Submit|Send|Search|Message|Remember me|Forgot password?|Register|I agree to the terms|Subscribe",
    "comments": "Comments|3 comments|Leave a reply|Reply|Responses|Report|Log in to comment|Show more comments|Add a comment|says:|Permalink|Like",
}
ROOTS = {
    "menu": "nav|div class=menu|div class=nav|ul class=navbar|div id=nav|div class=navigation|ul class=menu|div class=breadcrumb|div role=navigation|menu|div id=menu|div class=topnav",
    "header": "header|div class=header|div id=header|div class=masthead|div class=site-header|div role=banner|header class=site-header|div class=topbar",
    "footer": "footer|div class=footer|div id=footer|footer class=site-footer|div class=bottom|div role=contentinfo|div class=copyright|section class=footer",
    "sidebar": "aside|div class=sidebar|div id=sidebar|aside class=sidebar|div class=related|div class=widget|section class=related|div role=complementary|div class=recommended",
    "notice": "div class=cookie|div id=cookie-banner|div class=notice|div class=alert|div class=banner|div class=newsletter|div class=popup|div role=alert|div class=modal|dialog|"
              "div class=consent|p class=notice|aside class=notice|section class=notice|div class=cookie-notice",
    "advert": "div class=ad|div class=ads|div class=advert|div class=advertisement|div id=ad|div class=sponsored|aside class=ad|div class=promo|section class=sponsor|ins class=ad|"
              "p class=ad|div class=banner-ad|aside class=advert",
    "form": "form|form class=search|div class=form|form id=login|fieldset|form class=signup|div class=search-form|form class=comment-form",
    "comments": "section id=comments|div class=comments|div id=comments|ol class=comment-list|div class=comment|section class=comments|ul class=comments|div class=responses|"
                "div class=discussion|div class=reader-comments|aside class=comments|section class=responses|article class=comment|div class=reply",
    "article": "article|main|div class=content|div id=content|div class=post|div class=entry-content|div class=article|div class=article-body|section class=article|div class=story|"
               "article class=post|div role=main|main id=main|div class=text|div class=post-content|div class=main|section|div|article|article|main class=content",
}
AROUND = ("", "", "", "div", "div class=wrapper", "div class=container", "div id=page", "div class=row", "div class=col", "section", "div class=inner", "main", "div class=main")


class _Generator:
    """Pages with known main text."""

    def __init__(self, words: list[str], seed: int):
        self.draw, self.words = random.Random(seed), words

    def element(self, root: str) -> tuple[str, str]:
        """Start and end tag of a root such as ``div class=menu``, sometimes with a further name."""
        tag, *rest = root.split(" ")
        if rest:
            name, value = rest[0].split("=")
            if self.draw.random() < 0.2:
                value += f" x{self.draw.randrange(10 ** 6)}" if name == "class" else ""
            rest = [f'{name}="{value}"']
        elif self.draw.random() < 0.15:
            rest = [f'class="c{self.draw.randrange(10 ** 6)}"']
        return "<" + " ".join([tag, *rest]) + ">", f"</{tag}>"

    def sentence(self, least: int = 3, most: int = 25) -> str:
        some = [self.draw.choice(self.words) for _ in range(self.draw.randint(least, most))]
        text = " ".join(some)
        return (text[:1].upper() + text[1:] + self.draw.choice([".", ".", ".", ".", "?", "!", ""])).replace("&", "&amp;").replace("<", "&lt;")

    def paragraph(self) -> str:
        kind = self.draw.random()
        if kind < 0.2:
            return self.sentence(1, 6)
        if kind < 0.26:  # junk: lists of words, and words over and over
            some = [self.sentence(1, 1) for _ in range(self.draw.choice([5, 20, 80]))]
            return self.draw.choice([" | ".join(some), " ".join(f"{x} " * self.draw.randint(2, 30) for x in some[:5]), f"{some[0]} " * 40])
        return " ".join(self.sentence() for _ in range(self.draw.choice([1, 1, 2, 3, 5, 8, 20])))

    def phrase(self, kind: str) -> str:
        return self.draw.choice(PHRASES[kind].split("|")) if self.draw.random() < 0.6 else self.sentence(1, 7)

    def region(self, kind: str) -> str:
        """A region that is no main text."""
        start, end = self.element(self.draw.choice(ROOTS[kind].split("|")))
        draw, inner = self.draw, []
        if kind in ("menu", "sidebar") or kind in ("footer", "header") and draw.random() < 0.5:
            if kind == "sidebar":
                inner.append(f"<h3>{self.phrase(kind)}</h3>")
            links = [f'<a href="/{i}">{self.phrase(kind)}</a>' for i in range(draw.randint(2, 9))]
            inner.append("".join(f"<li>{x}</li>" for x in links) if start.startswith("<ul") else
                         draw.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>", " | ".join(links)]))
        if kind in ("footer", "notice", "advert", "sidebar") and draw.random() < 0.8 or kind == "header":
            inner += [draw.choice(["{}", "<p>{}</p>", "<div>{}</div>", "<span>{}</span>"]).format(
                self.phrase(kind) if draw.random() < 0.6 else self.paragraph()) for _ in range(draw.randint(1, 3))]
        if kind == "footer" and draw.random() < 0.5:
            inner.append(f"&copy; {draw.choice(self.words)}.example.com &middot; {self.sentence(2, 9)}")
        if kind == "form":
            inner += [f"<label>{self.phrase(kind)}</label><input>" for _ in range(draw.randint(1, 4))] + [f"<button>{self.phrase(kind)}</button>"]
            if draw.random() < 0.3:
                inner.append("<select>" + "".join(f"<option>{self.phrase(kind)}" for _ in range(draw.randint(2, 5))) + "</select>")
        if kind == "comments":
            if draw.random() < 0.8:
                inner.append(f"<h3>{draw.choice(['Comments', '3 comments', 'Reader comments', 'Leave a reply', 'Responses', 'Discussion'])}</h3>")
            for _ in range(draw.randint(1, 6)):
                body = f"<p>{self.paragraph()}</p>"
                if draw.random() < 0.5:
                    body = f"<b>{draw.choice(self.words)}</b> {self.phrase(kind)}" + body
                inner.append(draw.choice(["{}", "<div class=\"comment\">{}</div>", "<li>{}</li>", "<article class=\"comment\">{}</article>", "<div>{}</div>"]).format(body))
        return start + "".join(inner or [self.phrase(kind)]) + end

    def article(self) -> list[tuple[str, int]]:
        """Pieces of markup, each with 1 if its blocks are main text."""
        draw = self.draw
        start, end = self.element(draw.choice(ROOTS["article"].split("|")))
        out = [(start, 1)]
        if draw.random() < 0.8:
            title = f"<h1>{self.sentence(2, 10)}</h1>"
            out.append((draw.choice([title, title, title, f"<header>{title}</header>"]), 1))
        bold = draw.random() < 0.4
        for i in range(draw.choice([1, 2, 3, 5, 8, 14, 25])):
            kind = draw.random()
            text = self.paragraph()
            if kind < 0.75:
                out.append((f"<p><b>{text}<br>" if bold and i % 4 == 0 else f"<p>{text}" + draw.choice(["</p>", "</p>", "</p>", ""]), 1))
            elif kind < 0.82:
                out.append((f"<h2>{self.sentence(1, 7)}</h2>", 1))
            elif kind < 0.87:
                out.append((f"<blockquote>{text}</blockquote>", 1))
            elif kind < 0.92:
                tag = draw.choice(["ul", "ol"])
                out.append((f"<{tag}>" + "".join(f"<li>{self.sentence(1, 14)}</li>" for _ in range(draw.randint(2, 5))) + f"</{tag}>", 1))
            elif kind < 0.94:
                out.append(("<table>" + "".join(f"<tr><td>{self.sentence(1, 3)}<td>{self.sentence(1, 3)}" for _ in range(draw.randint(2, 4))) + "</table>", 1))
            elif kind < 0.96:
                out.append((f"<pre>{text}</pre>", 1))
            elif kind < 0.97:
                out.append((f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>", 1))
            elif kind < 0.985:
                out.append((f"<div>{text}</div>", 1))
            else:
                out.append((self.region(draw.choice(["advert", "sidebar", "notice", "form"])), 0))
        if draw.random() < 0.1:
            out.append((self.region("comments"), 0))
        return [*out, (end, 1)]

    def page(self) -> list[tuple[str, int]]:
        draw, out = self.draw, [("<html><body>", 0)]
        for kind, chance in (("notice", 0.25), ("header", 0.4), ("menu", 0.8), ("form", 0.15), ("advert", 0.5)):
            if draw.random() < chance:
                out.append((self.region(kind), 0))
        start, end = self.element(draw.choice([a for a in AROUND if a])) if draw.random() < 0.5 else ("", "")
        out.append((start, 0))
        if start and draw.random() < 0.3:
            out.append((self.region(draw.choice(["sidebar", "menu"])), 0))
        out += self.article()
        for kind, chance in (("sidebar", 0.25), ("comments", 0.3), ("form", 0.15)):
            if draw.random() < chance:
                out.append((self.region(kind), 0))
        out.append((end, 0))
        for kind, chance in (("sidebar", 0.25), ("advert", 0.25), ("notice", 0.2), ("footer", 0.85)):
            if draw.random() < chance:
                out.append((self.region(kind), 0))
        return out


def generated_page(words: list[str], seed: int) -> tuple[str, list[Block], np.ndarray]:
    """A page, its blocks, and which of them are main text."""
    reader, page, labels = _Page(), "", []
    for piece, label in _Generator(words, seed).page():
        page += piece
        reader.read(piece)
        reader.flush()
        labels += [label] * (len(reader.blocks) - len(labels))
    return page, reader.blocks, np.array(labels, dtype=np.float32)


#: Words for pages that are generated without any given page.
PLAIN = "the of and a to in is it that for on with as was at by an be this have from or one had but not what all were when we there can said".split()


def sampled_words(pages: DataFrame, train_pages: int) -> list[str]:
    """Words of the first ``train_pages`` distinct pages by hash, at most ``WORDS_A_PAGE`` of each page, from all parts of it."""
    chosen = pages.select(F.xxhash64("html").alias("_hash")).where("html is not null").distinct().orderBy("_hash").limit(train_pages)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, page in zip(batch.column("key").to_pylist(), batch.column("html").to_pylist()):
                found = [w for b in leaf_blocks(page) for w in b.text.split() if len(w) <= 40]
                step = max(1, -(-len(found) // WORDS_A_PAGE))
                rows.append((key, " ".join(found[::step])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["key", "words"])

    keyed = pages.select("html", F.xxhash64("html").alias("key"))
    some = keyed.join(F.broadcast(chosen), F.col("key") == F.col("_hash")).select("key", "html").mapInArrow(words, "key long, words string")
    # Equal pages give equal words; one row of each comes to the driver.
    found = [w for r in sorted(map(tuple, some.groupBy("key").agg(F.min("words")).collect())) for w in r[1].split()]
    return found or PLAIN


def train_block_model(pages: DataFrame, train_pages: int = 100, generated: int = 700, hidden: int = 16, epochs: int = 10) -> BiLstm:
    """Learns from ``generated`` pages with words of ``pages``."""
    words = sampled_words(pages, train_pages)
    examples = [(vectors_of([blocks])[0], labels) for _, blocks, labels in (generated_page(words, seed) for seed in range(generated)) if len(labels)]
    network = BiLstm(hidden=hidden)
    network.fit(examples, epochs, batch=32, rate=0.02)
    return network


def main_texts(pages: DataFrame, model: BiLstm, text: str = "text") -> DataFrame:
    """The pages' other columns, and in place of ``html`` the main text; its blocks stand two line feeds apart."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            waiting: list[list[Block]] = []

            def label() -> None:
                kept = model.labels(vectors_of(waiting))
                out.extend("\n\n".join(b.text for b, keep in zip(blocks, some) if keep) for blocks, some in zip(waiting, kept))
                waiting.clear()

            held = 0
            for page in batch.column("_html").to_pylist():
                waiting.append(leaf_blocks(page))
                held += len(waiting[-1])
                if held > LOT:
                    label()
                    held = 0
            label()
            names = batch.schema.names[1:]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.string())], [*names, "_text"])

    others = [c for c in pages.columns if c not in ("html", text)]
    inner = pages.select(F.col("html").alias("_html"), *(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)))
    schema = StructType([*inner.schema.fields[1:], StructField("_text", StringType())])
    return inner.mapInArrow(extract, schema).toDF(*others, text)


def op12_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    texts = main_texts(pages, train_block_model(pages))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
