"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks (``html_blocks``). Every block is read as a
vector of its tag path (the tags and class words above it), of its hashed words
and of a few shares (length, links, sentence ends, place in the page). A
bidirectional LSTM in numpy runs over the whole page, so that each block is
classified in the context of all others; blocks labelled main text are joined.

No table labels blocks, so the labeller is fitted once per process on
``TRAIN_PAGES`` pages made by rule (``html_pages``, fixed seed) and broadcast,
some hundred kilobytes. Pages are labelled in batches of like length; nothing
is shuffled.

Defined results: null or empty html, and a page without main text, give the
empty string; rows are independent, so repeated rows and ids stay; a page is
read whole, whatever its length; broken or cut markup ends where the page ends;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tslake.llm.common import ALNUM, held, row_blocks, share, text_buffer, word_spans
from tslake.llm.html_blocks import Block, blocks
from tslake.llm.html_pages import MARK, labelled_pages

TRAIN_PAGES = 3000
EPOCHS = 8
SEED = 20
HIDDEN = 24
WORD_BUCKETS = 32
#: Blocks labelled at once; bounds the arrays of the recurrent layers.
BATCH_BLOCKS = 20_000

#: Tags and class words with a place of their own in the path vector; others are hashed.
KNOWN = """a address article aside b blockquote body dd details div dl dt em fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
 header i label legend li main menu nav ol p pre section span strong summary table td th tr ul
 .ad .ads .advert .advertisement .alert .article .author .banner .body .bottom .breadcrumb .breadcrumbs .byline .comment .commentlist
 .comments .consent .content .cookie .copyright .date .disqus .entry .footer .gdpr .header .list .main .masthead .menu .meta .modal .nav
 .navbar .navigation .notice .pagination .popup .post .promo .recommended .related .reply .responses .share .side .sidebar .site .slot
 .social .sponsored .story .tags .topnav .user .widget""".split()
OTHERS = 8
LEAVES = "body div p li h1 h2 h3 h4 td blockquote pre figcaption section article nav aside footer header form".split()
SHARES = 8
_KNOWN = {k: i for i, k in enumerate(KNOWN)}
_LEAF = {k: i for i, k in enumerate(LEAVES)}
PATH = len(KNOWN) + OTHERS
INPUT = PATH + len(LEAVES) + 1 + WORD_BUCKETS + SHARES
_END = tuple(".!?…:;\"'”’»)")


def _path(path: tuple[str, ...]) -> list[int]:
    places = {_KNOWN.get(p, -1) for p in path}
    return [p for p in places if p >= 0] + [len(KNOWN) + sum(map(ord, p)) % OTHERS for p in path if p not in _KNOWN]


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """A row for each block of the pages, in order."""
    flat = [b for page in pages for b in page]
    out = np.zeros((len(flat), INPUT), np.float32)
    seen: dict[tuple[str, ...], list[int]] = {}
    for i, b in enumerate(flat):
        if b.path not in seen:
            seen[b.path] = _path(b.path)
        out[i, seen[b.path]] = 1.0
        out[i, PATH + _LEAF.get(b.tag, len(LEAVES))] = 1.0
    at = PATH + len(LEAVES) + 1
    texts = [b.text.encode() for b in flat]
    offsets = np.zeros(len(flat) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    hashes, _, _, begins = word_spans(np.frombuffer(b"".join(texts), np.uint8), offsets, ALNUM)
    counts = np.diff(begins)
    owner = np.repeat(np.arange(len(flat)), counts)
    words = np.bincount(owner * WORD_BUCKETS + (hashes >> np.uint64(59)).astype(np.int64), minlength=len(flat) * WORD_BUCKETS)
    out[:, at : at + WORD_BUCKETS] = words.reshape(len(flat), WORD_BUCKETS) / np.sqrt(np.maximum(counts, 1))[:, None]
    at += WORD_BUCKETS
    sizes = np.array([len(b.text) for b in flat], np.float32)
    out[:, at] = np.log1p(sizes) / 8
    out[:, at + 1] = np.log1p(counts) / 6
    out[:, at + 2] = [b.linked / max(1, len(b.text)) for b in flat]
    out[:, at + 3] = [b.text.endswith(_END) for b in flat]
    out[:, at + 4] = [len(b.path) / 20 for b in flat]
    out[:, at + 5] = np.concatenate([np.arange(len(p)) / max(1, len(p)) for p in pages]) if flat else 0
    out[:, at + 6] = np.concatenate([(np.cumsum(s) - s / 2) / s.sum() for p in pages if p for s in [np.array([len(b.text) for b in p], np.float64)]]) if flat else 0
    out[:, at + 7] = [1.0 if "©" in b.text[:40] else 0.0 for b in flat]
    return out


# ------------------------------------------------------------------------- LSTM


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Layer:
    """One direction of the LSTM over (time, pages, inputs); masked steps pass on the state."""

    def __init__(self, weights: dict[str, np.ndarray], name: str):
        self.w, self.u, self.b = (weights[name + k] for k in "wub")

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> np.ndarray:
        steps, n, _ = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        self.tape = []
        given = x @ self.w + self.b
        for t in range(steps):
            gates = given[t] + h @ self.u
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                self.tape.append((h, c, i, f, o, g, squashed, m))
            c = np.where(m, new, c)
            h = np.where(m, o * squashed, h)
            out[t] = h
        return out

    def back(self, x: np.ndarray, d_out: np.ndarray) -> dict[str, np.ndarray]:
        steps, n, _ = x.shape
        d_given = np.zeros((steps, n, 4 * HIDDEN), np.float32)
        d_u, d_h, d_c = np.zeros_like(self.u), np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, g, squashed, m = self.tape[t]
            d_h = d_h + d_out[t]
            inside, d_new = np.where(m, d_h, 0), np.where(m, d_c, 0)
            d_new = d_new + inside * o * (1 - squashed**2)
            d_given[t] = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f), inside * squashed * o * (1 - o), d_new * i * (1 - g**2)], axis=1)
            d_u += h.T @ d_given[t]
            d_h = np.where(m, 0, d_h) + d_given[t] @ self.u.T
            d_c = np.where(m, d_new * f, d_c)
        flat = d_given.reshape(-1, 4 * HIDDEN)
        return {"w": x.reshape(-1, x.shape[2]).T @ flat, "u": d_u, "b": flat.sum(axis=0)}


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @staticmethod
    def fresh(rng: np.random.Generator) -> "Labeller":
        weights = {}
        for name in ("f", "b"):
            weights[name + "w"] = rng.normal(0, 0.1, (INPUT, 4 * HIDDEN)).astype(np.float32)
            weights[name + "u"] = rng.normal(0, 0.1, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            weights[name + "b"] = np.zeros(4 * HIDDEN, np.float32)
            weights[name + "b"][HIDDEN : 2 * HIDDEN] = 1.0
        weights["o"] = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        weights["s"] = np.zeros(INPUT, np.float32)  # straight from the input
        weights["c"] = np.zeros(1, np.float32)
        return Labeller(weights)

    @staticmethod
    def _padded(rows: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = np.diff(begins)
        mask = np.arange(counts.max())[:, None] < counts[None, :]
        x = np.zeros((*mask.shape, rows.shape[1]), np.float32)
        x.transpose(1, 0, 2)[mask.T] = rows
        return x, mask

    def _forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, list[Layer]]:
        layers = [Layer(self.weights, "f"), Layer(self.weights, "b")]
        both = np.concatenate([layers[0].run(x, mask, keep), layers[1].run(x[::-1], mask[::-1], keep)[::-1]], axis=2)
        return _sigmoid(both @ self.weights["o"] + x @ self.weights["s"] + self.weights["c"]), both, layers

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block is main text, for each page."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and len(pages[order[hi]]) * (hi + 1 - lo) <= BATCH_BLOCKS and len(pages[order[hi]]) <= 2 * len(pages[order[lo]]) + 8:
                hi += 1
            some = [pages[i] for i in order[lo:hi]]
            begins = np.cumsum([0, *map(len, some)])
            x, mask = self._padded(vectors(some), begins)
            chance = self._forward(x, mask)[0].T
            for i, c, m in zip(order[lo:hi], chance, mask.T):
                out[i] = c[m] > 0.5
            lo = hi
        return out

    def fit(self, pages: list[list[Block]], labels: list[np.ndarray], epochs: int, rng: np.random.Generator, batch: int = 50) -> None:
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.weights.items()}
        rows = [vectors([p]) for p in pages]
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        step = 0
        for epoch in range(epochs):
            for k in rng.permutation(len(groups)):
                some = groups[k]
                begins = np.cumsum([0, *(len(pages[i]) for i in some)])
                x, mask = self._padded(np.concatenate([rows[i] for i in some]), begins)
                y = np.zeros(mask.shape, np.float32)
                y.T[mask.T] = np.concatenate([labels[i] for i in some])
                chance, both, layers = self._forward(x, mask, keep=True)
                d = np.where(mask, chance - y, 0).astype(np.float32) / mask.sum()
                grads = {"o": np.tensordot(d, both, ((0, 1), (0, 1))), "s": np.tensordot(d, x, ((0, 1), (0, 1))), "c": np.array([d.sum()])}
                d_both = d[:, :, None] * self.weights["o"]
                for layer, name, xs, ds in ((layers[0], "f", x, d_both[:, :, :HIDDEN]), (layers[1], "b", x[::-1], d_both[::-1, :, HIDDEN:])):
                    grads |= {name + key: g for key, g in layer.back(xs, ds).items()}
                step += 1
                rate = 0.01 * (0.1 if epoch >= epochs - 2 else 1.0)
                for key, g in grads.items():  # Adam
                    m, v = moments[key]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.weights[key] = (self.weights[key] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def marked(pages: list[str]) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Blocks and labels of made pages; the marks are taken out."""
    found, labels = [], []
    for page in pages:
        own = blocks(page)
        labels.append(np.array([b.text.startswith(MARK) for b in own], np.float32))
        for b in own:
            b.text = b.text.replace(MARK, "")
        keep = [i for i, b in enumerate(own) if b.text.strip()]
        found.append([own[i] for i in keep])
        labels[-1] = labels[-1][keep]
    full = [i for i, p in enumerate(found) if p]
    return [found[i] for i in full], [labels[i] for i in full]


@lru_cache(maxsize=1)
def labeller() -> Labeller:
    """The labeller, fitted on the made pages."""
    rng = np.random.default_rng(SEED)
    out = Labeller.fresh(rng)
    out.fit(*marked(labelled_pages(TRAIN_PAGES, SEED)), EPOCHS, rng)
    return out


# ------------------------------------------------------------------------ Spark


def main_text(page: list[Block], label: np.ndarray) -> str:
    return "\n".join(b.text for b, main in zip(page, label) if main)


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_main of every page."""
    shared = share(pages.sparkSession, model or labeller())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_buffer(batch.column(2))
            for lo, hi in row_blocks(offsets):
                found = [blocks(h or "") for h in batch.column(2).slice(lo, hi - lo).to_pylist()]
                labels = held(shared).label(found)
                texts = [main_text(p, m) for p, m in zip(found, labels)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([len(p) for p in found], pa.int64()),
                        pa.array([int(m.sum()) for m in labels], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "n_main"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_main long")
