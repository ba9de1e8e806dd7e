"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its text blocks in page order. Each block has a vector of its tag path (tags, class and id
words, hashed), of its words (hashed), and a few plain measures. A bidirectional LSTM in numpy reads the whole sequence, so that
every block is classified with the document around it; blocks labelled as main text are joined.

It is trained on a bounded sample of pages whose own markup says what is main text (``article``, ``main``), with those
tags hidden or renamed in part of the sequences, with blocks of the kinds to leave out put in between, and with lists, quotations, code,
tables, captions and headings among the main text. If no page of the sample says so, pages are made around its texts.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.arrow_text import bounded_batches, pieces, texts

PATH_DIM, WORD_DIM, PLAIN = 128, 32, 8
INPUT = PATH_DIM + WORD_DIM + PLAIN
HIDDEN = 16
TRAIN_PAGES = 240
TRAIN_CHARS = 60_000
#: A training sequence is this many blocks of its page on end at most, from a place drawn at random.
TRAIN_BLOCKS = 200
STEPS = 400

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+>?|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>)", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Fixed values of the markup language: elements without an end tag, those whose content is no text, and block elements. ``head`` is
#: none of them: its end tag is optional, and what may stand in it has no text of its own.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_NO_TEXT = frozenset("script style noscript template title textarea select svg iframe object".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
#: An element that ends an open one of these when it begins.
_ENDS = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
         **{b: ("p",) for b in ("div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "form", "blockquote", "pre")}}
_WALLS = frozenset("table ul ol dl div section article body nav aside footer header form main".split())
#: Elements that run to their end tag or the end of the page, and those with plain text (no comments or scripts) up to their end tag.
_TO_THE_END = frozenset("script style".split())
_PLAIN_TEXT = frozenset("title textarea iframe".split())
_OPTIONS = frozenset("option optgroup".split())
_LEFT_OUT = frozenset("nav footer aside form button menu dialog label fieldset".split())
_OUT_WORDS = re.compile(r"\b(?:ad|ads|advert\w*|banner|cookie\w*|consent|notice|comments?|respond|sidebar|menu|nav\w*|promo\w*|share|sharing|"
                        r"social|related|subscribe|newsletter|breadcrumbs?|footer|widget|popup|modal)\b")
_PLACES = (("main", ""), ("article", "post"), ("div", "content"), ("div", "post"), ("div", "entry body"), ("section", "story"), ("div", ""), ("td", "text"))
_NOISE = (("aside", ""), ("div", "sidebar"), ("section", "comments"), ("div", "comment"), ("ul", "comment list"), ("form", "search"),
          ("header", ""), ("div", "cookie notice"), ("div", "ad"), ("div", "advert"), ("nav", ""), ("div", "menu"), ("footer", ""),
          ("div", "related"), ("div", "share social"), ("div", "newsletter subscribe"), ("div", "banner promo"))


#: Forms that text takes inside and outside of the main part; training puts both kinds of text into all of them.
_FORMS = ((("ul", ""), ("li", "")), (("ol", ""), ("li", "")), (("pre", ""),), (("blockquote", ""),), (("blockquote", ""), ("p", "")),
          (("table", ""), ("tbody", ""), ("tr", ""), ("td", "")), (("table", ""), ("tr", ""), ("th", "")), (("table", ""), ("caption", "")),
          (("figure", ""), ("figcaption", "")), (("dl", ""), ("dt", "")), (("dl", ""), ("dd", "")), (("address", ""),), (("section", ""), ("p", "")),
          (("div", ""),), (("div", ""), ("p", "")), (("details", ""), ("summary", "")), *(((f"h{n}", ""),) for n in range(1, 7)))


@dataclass
class Block:
    """A run of text between block borders. ``path`` has (tag, names) from the outermost element on."""

    text: str
    path: tuple[tuple[str, str], ...]
    linked: int = 0
    label: int = -1


@cache
def _end_tag(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I)


@cache
def _own_tags(name: str) -> re.Pattern:
    """Tags of that name; comments, scripts and styles are passed over where they can stand in the element."""
    other = "" if name in _PLAIN_TEXT else r"<!--.*?(?:-->|\Z)|<(?:script|style)(?=[\s/>]).*?(?:</(?:script|style)(?=[\s/>])|\Z)|"
    return re.compile(rf"{other}<(/?)(?P<own>{name})(?=[\s/>])((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.I | re.S)


def _ends(page: str, name: str) -> dict[int, int]:
    """Where each element of that name ends, by the end of its start tag. An end tag belongs to the last start tag still open."""
    out: dict[int, int] = {}
    opened: list[int] = []
    for tag in _own_tags(name).finditer(page):
        if not tag["own"]:
            continue
        if not tag[1]:
            if not tag[3].endswith("/"):
                opened.append(tag.end())
        elif opened:
            out[opened.pop()] = tag.end()
    return out


def blocks(page: str) -> list[Block]:
    """Text blocks of a page: references decoded, white space as one space. Broken markup is read as far as it goes: an element
    without text whose end tag is missing ends at the next border of a block (a script or style at the page's end)."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    link, linked, at, n = 0, 0, 0, len(page)
    path: tuple[tuple[str, str], ...] | None = None
    ends: dict[str, dict[int, int]] = {}
    unclosed = ""

    def close() -> None:
        nonlocal parts, linked, path
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, path if path is not None else tuple(stack), min(linked, len(text))))
        parts, linked, path = [], 0, None

    while at < n:
        sign = page.find("<", at)
        if sign < 0:
            sign = n
        if sign > at and not unclosed:
            piece = page[at:sign]
            parts.append(piece)
            if path is None and not piece.isspace():
                path = tuple(stack)
            if link:
                linked += len(piece.strip())
        if sign == n:
            break
        found = _TAG.match(page, sign)
        if not found:
            if not unclosed:
                parts.append("<")
                path = tuple(stack) if path is None else path
            at = sign + 1
            continue
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        if unclosed and (name in (unclosed, "head") or name in _BLOCK and not (unclosed == "select" and name in _OPTIONS)):
            unclosed = ""
        if unclosed and name not in _NO_TEXT:
            continue
        if found[1]:
            if name == "a":
                link = max(0, link - 1)
            if name in _BLOCK:
                close()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            continue
        if name in _NO_TEXT:
            if not found[3].endswith("/"):
                if name in _TO_THE_END:
                    end = _end_tag(name).search(page, at)
                    at = end.end() if end else n
                else:
                    if name not in ends:
                        ends[name] = _ends(page, name)
                    if at in ends[name]:
                        at = ends[name][at]
                    else:
                        unclosed = name
            continue
        if name == "a":
            link += 1
        elif name == "br":
            parts.append(" ")
        elif name in _BLOCK:
            close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _ENDS.get(name, ()):
                    del stack[k:]
                    break
                if stack[k][0] in _WALLS:
                    break
            if name not in _VOID:
                names = " ".join(a or b or c for a, b, c in _NAMES.findall(found[3])).lower() if found[3] else ""
                stack.append((name, names))
                link = 0
    close()
    return out


def taught(page: list[Block]) -> bool:
    """Label the blocks by the page's own markup; False if it does not say."""
    if not any(tag in ("article", "main") for b in page for tag, _ in b.path):
        return False
    for b in page:
        inside = max((k for k, (tag, _) in enumerate(b.path) if tag in ("article", "main")), default=-1)
        out = any(tag in _LEFT_OUT or _OUT_WORDS.search(names) for tag, names in b.path)
        b.label = int(inside >= 0 and not out)
    return True


def _bucket(text: str, dim: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % dim


class Vectors:
    """Block vectors; keeps hashes of paths and words it has met."""

    def __init__(self) -> None:
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, path: tuple[tuple[str, str], ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            v = np.zeros(PATH_DIM, np.float32)
            for depth, (tag, names) in enumerate(reversed(path)):
                for word in (tag, *re.split(r"[\s_-]+", names)):
                    if word:
                        v[_bucket(word, PATH_DIM)] += 0.8**min(depth, 8)
            self.paths[path] = np.minimum(v, 2)
        return self.paths[path]

    def page(self, page: list[Block]) -> np.ndarray:
        out = np.zeros((len(page), INPUT), np.float32)
        for k, b in enumerate(page):
            out[k, :PATH_DIM] = self.path(b.path)
            words = b.text.split()
            if len(self.words) > 200_000:
                self.words.clear()
            ids = []
            for w in words:
                if w not in self.words:
                    self.words[w] = _bucket(w.lower(), WORD_DIM)
                ids.append(self.words[w])
            out[k, PATH_DIM:PATH_DIM + WORD_DIM] = np.bincount(ids, minlength=WORD_DIM) / np.sqrt(len(words))
            size = len(b.text)
            out[k, -PLAIN:] = (np.log1p(size) / 6, np.log1p(len(words)) / 4, b.linked / size, b.text[-1] in ".!?:;\"'",
                               b.text.count("|") > 0, "©" in b.text, k / len(page), 1 / (1 + k))
        return out


@dataclass
class Lstm:
    """One direction's weights: input, recurrent, bias; gates in the order input, forget, output, candidate."""

    w: np.ndarray
    u: np.ndarray
    b: np.ndarray

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """``x``: (time, batch, input). Padding leaves the state as it is."""
        steps, batch, _ = x.shape
        h, c = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
        out, tape = np.zeros((steps, batch, HIDDEN), np.float32), []
        given = x.reshape(-1, x.shape[2]) @ self.w + self.b
        given = given.reshape(steps, batch, 4 * HIDDEN)
        for t in range(steps):
            z = given[t] + h @ self.u
            gate = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
            i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = m * (f * c + i * g) + (1 - m) * c
            s = np.tanh(c_new)
            h_new = m * (o * s) + (1 - m) * h
            if keep:
                tape.append((h, c, i, f, o, g, s, m))
            h, c = h_new, c_new
            out[t] = h
        return out, tape

    def back(self, x: np.ndarray, tape: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of w, u, b from those of the outputs."""
        dw, du, db = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.b)
        dh, dc = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
        for t in range(len(tape) - 1, -1, -1):
            h, c, i, f, o, g, s, m = tape[t]
            dh = dh + d_out[t]
            live = dh * m
            d_cell = dc + live * o * (1 - s * s)
            own = d_cell * m
            dz = np.concatenate([own * g * i * (1 - i), own * c * f * (1 - f), live * s * o * (1 - o), own * i * (1 - g * g)], axis=1)
            dw += x[t].T @ dz
            du += h.T @ dz
            db += dz.sum(axis=0)
            dh = dz @ self.u.T + dh * (1 - m)
            dc = own * f + d_cell * (1 - m)
        return [dw, du, db]


@dataclass
class Model:
    """Both directions and the output layer."""

    forward: Lstm
    backward: Lstm
    out: np.ndarray
    bias: np.ndarray

    def read(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple:
        a, tape_a = self.forward.run(x, mask, keep)
        b, tape_b = self.backward.run(x[::-1], mask[::-1], keep)
        both = np.concatenate([a, b[::-1]], axis=2)
        return 1 / (1 + np.exp(-np.clip(both @ self.out + self.bias, -30, 30))), both, tape_a, tape_b

    def label(self, pages: list[np.ndarray], most: int = 6_000) -> list[np.ndarray]:
        """Probability of main text for every block; pages of like length are read together."""
        result: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(pages[order[end]]) * (end - at + 1) <= most:
                end += 1
            group = order[at:end]
            x, mask = _padded([pages[k] for k in group])
            p = self.read(x, mask)[0]
            for column, k in enumerate(group):
                result[k] = p[:len(pages[k]), column]
            at = end
        return result


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[:len(page), k] = page
        mask[:len(page), k] = 1
    return x, mask


def _fresh(rng: np.random.Generator) -> Model:
    def one() -> Lstm:
        b = np.zeros(4 * HIDDEN, np.float32)
        b[HIDDEN:2 * HIDDEN] = 1
        return Lstm((rng.standard_normal((INPUT, 4 * HIDDEN)) / 12).astype(np.float32),
                    (rng.standard_normal((HIDDEN, 4 * HIDDEN)) / 4).astype(np.float32), b)

    return Model(one(), one(), (rng.standard_normal(2 * HIDDEN) / 5).astype(np.float32), np.zeros(1, np.float32))


def _varied(page: list[Block], others: list[str], rng: np.random.Generator) -> list[Block]:
    """A training sequence: the marking tags hidden or renamed, blocks of the kinds to leave out put in between."""
    how = rng.random()
    place = _PLACES[rng.integers(len(_PLACES))]
    out = []
    for b in page:
        path = b.path
        if how < 0.6:
            path = tuple(place if t in ("article", "main") else (t, n) for t, n in path)
        if path and path[-1][0] == "h1" and rng.random() < 0.6:
            path = (*path[:-1], (f"h{rng.integers(2, 5)}", ""))
        out.append(Block(b.text, path, b.linked, b.label))
    inner = [k for k, b in enumerate(out) if b.label == 1]
    # From the last place on, so that the places before stay where they are.
    picked = set(rng.choice(inner, min(len(inner), int(rng.integers(0, 4))), replace=False).tolist()) if inner else set()
    if inner and rng.random() < 0.4:
        picked.add(inner[0])
    for k in sorted(picked, reverse=True):
        ahead = rng.random() < (0.6 if k == inner[0] else 0.2)
        form = _FORMS[rng.integers(len(_FORMS))]
        path = out[k].path[:-1]
        for _ in range(rng.integers(1, 6)):
            text = _cut(others, rng, 2, 200)
            linked = int(rng.integers(len(text) + 1)) if rng.random() < 0.2 else 0
            out.insert(k + (not ahead), Block(text, (*path, *form), linked, 1))
    for _ in range(rng.integers(0, 4)):
        tag = _NOISE[rng.integers(len(_NOISE))]
        at = int(rng.integers(len(out) + 1))
        base = out[min(at, len(out) - 1)].path[:int(rng.integers(1, 4))]
        form = _FORMS[rng.integers(len(_FORMS))] if rng.random() < 0.5 else (("p", ""),) if rng.random() < 0.5 else ()
        for _ in range(rng.integers(1, 4)):
            text = _cut(others, rng, 10, 300)
            out.insert(at, Block(text, (*base, tag, *form), len(text) if rng.random() < 0.3 else 0, 0))
    return out


def _cut(others: list[str], rng: np.random.Generator, least: int, most: int) -> str:
    """Some text of the sample, begun anywhere."""
    text = others[rng.integers(len(others))]
    at = int(rng.integers(len(text)))
    return text[at:at + int(rng.integers(least, most))].strip() or "x"


def _made_pages(texts_of: list[str], rng: np.random.Generator, count: int = 40) -> list[list[Block]]:
    """Labelled pages of usual build around the given texts, for samples in which no page marks its main text."""
    texts_of = texts_of or [" ".join("abcdefghij"[k:k + 4] for k in range(8)) + "."]
    out = []
    for _ in range(count):
        some = [html.escape(_cut(texts_of, rng, 4, 300)) for _ in range(int(rng.integers(8, 24)))]
        page = blocks(f"<html><body><header><div>{some[0]}</div></header><nav><ul>{''.join(f'<li><a href=x>{t[:20]}</a></li>' for t in some[1:6])}</ul></nav>"
                      f"<div class=ad>{some[6]}</div><article><h1>{some[7][:60]}</h1>{''.join(f'<p>{t}</p>' for t in some[8:])}</article>"
                      f"<footer>{some[0][:50]}</footer></body></html>")
        taught(page)
        out.append(page)
    return out


def train(pages: list[str], steps: int = STEPS, seed: int = 11) -> Model:
    """Model from pages whose markup marks the main text, or from pages made around the sample's texts if there are none."""
    rng = np.random.default_rng(seed)
    model = _fresh(rng)
    read = [p for p in map(blocks, pages) if p]
    known = [p for p in read if taught(p)] or _made_pages([b.text for p in read for b in p], rng)
    others = [b.text for p in known for b in p]
    vectors = Vectors()
    weights = [model.forward.w, model.forward.u, model.forward.b, model.backward.w, model.backward.u, model.backward.b, model.out, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        chosen = [_varied(known[k], others, rng) for k in rng.integers(len(known), size=16)]
        chosen = [p[(at := int(rng.integers(max(1, len(p) - TRAIN_BLOCKS + 1)))):at + TRAIN_BLOCKS] for p in chosen]
        x, mask = _padded([vectors.page(p) for p in chosen])
        y = np.zeros_like(mask)
        for k, p in enumerate(chosen):
            y[:len(p), k] = [b.label for b in p]
        p, both, tape_a, tape_b = model.read(x, mask, keep=True)
        d = ((p - y) * mask / mask.sum()).astype(np.float32)
        d_both = d[:, :, None] * model.out
        grads = [*model.forward.back(x, tape_a, d_both[:, :, :HIDDEN]),
                 *model.backward.back(x[::-1], tape_b, d_both[::-1, :, HIDDEN:]),
                 np.einsum("tb,tbh->h", d, both), d.sum(keepdims=False).reshape(1)]
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * (1 - 0.8 * step / steps)
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(w.dtype)
    return model


def extracted(pages: list[str], model: Model, vectors: Vectors | None = None) -> list[str]:
    """Main text per page: blocks labelled as such, in page order, joined by line ends."""
    lists = [blocks(p) for p in pages]
    vectors = vectors or Vectors()
    marks = model.label([vectors.page(p) for p in lists])
    return ["\n".join(b.text for b, p in zip(page, mark, strict=True) if p >= 0.5) for page, mark in zip(lists, marks, strict=True)]


def fit(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", sample: int = TRAIN_PAGES, max_chars: int = TRAIN_CHARS) -> Model:
    """Model from at most ``sample`` pages of at most ``max_chars`` characters, chosen by a hash of their id (a bounded sample)."""
    rows = (pages.where(F.length(body_col).between(1, max_chars)).select(F.xxhash64(id_col).alias("h"), F.col(body_col).alias("body"))
            .orderBy("h", "body").limit(sample))
    return train([r["body"] for r in rows.toLocalIterator()])


def main_text(body: Column, model: Model) -> Column:
    """Main text of each page; null counts as empty and gives an empty text."""
    bounded_batches()

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vectors = Vectors()
        for batch in batches:
            out: list[str] = []
            for first, end, _, _ in pieces(batch, 2_000_000):
                out += extracted(texts(batch.slice(first, end - first)), model, vectors)
            yield pa.array(out, pa.string())

    return run(body)


def extract_pages(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``; repeated rows each give a row, an empty table none."""
    model = model or fit(pages)
    return (pages.select("page_id", "url", main_text(F.col("html"), model).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
