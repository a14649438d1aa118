"""HTML main-text extraction: a bidirectional LSTM in numpy labels every block of a page.

Each block is read as the sum of learned vectors of its hashed tag-path words
(names, classes, ids and roles of the open elements, and the same of the nearest
three), the mean of learned vectors of its hashed words, and a few ratios. Two
LSTMs run over the page's blocks in either direction, so that the label of a
block uses the whole document. It is trained on pages of known layout.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import vec
from lakeloom.llm.common import map_arrow, only
from lakeloom.llm.html_blocks import Block, blocks
from lakeloom.llm.training_pages import Grammar

PATHS, WORDS, RATIOS = 8192, 512, 6
HIDDEN, EMBED_PATH, EMBED_WORD = 20, 16, 8


@lru_cache(1 << 16)
def path_buckets(path: tuple[str, ...], depth: int) -> tuple[int, ...]:
    """Buckets of the words of a path; the last ones, nearest to the text, once more by their place."""
    out = {zlib.crc32(w.encode()) % PATHS for w in path}
    out |= {zlib.crc32(f"{k}:{w}".encode()) % PATHS for k, w in enumerate(reversed(path[-3:]))}
    return tuple(out)


def inputs(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all blocks: the rows and buckets of path words, the mean count of each word bucket, and the ratios."""
    flat = [b for page in pages for b in page]
    paths = [path_buckets(b.path, b.depth) for b in flat]
    rows = np.repeat(np.arange(len(flat)), np.fromiter(map(len, paths), np.int64, len(flat)))
    buckets = np.fromiter((x for p in paths for x in p), np.int64, len(rows))
    data = [b.text.encode() for b in flat]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    joined = vec.LOWER[np.frombuffer(b"".join(data), np.uint8)]
    starts, ends, bounds = vec.word_spans(joined, offs)
    n_words = np.diff(bounds)
    owner = np.repeat(np.arange(len(flat)), n_words)
    words = np.bincount(owner * WORDS + (vec.span_hashes(joined, starts, ends) >> np.uint64(55)).astype(np.int64), minlength=len(flat) * WORDS).reshape(-1, WORDS).astype(np.float32)
    words /= np.maximum(n_words, 1)[:, None]
    size = np.maximum(np.diff(offs), 1)
    place = np.concatenate([np.linspace(0, 1, len(p)) if len(p) else np.zeros(0) for p in pages]) if pages else np.zeros(0)
    commas = np.array([b.text.count(",") + b.text.count(".") for b in flat], np.float64)
    digits = np.add.reduceat(np.append((joined >= 48) & (joined <= 57), False).astype(np.int64), offs[:-1]) if len(flat) else np.zeros(0)
    ratios = np.stack([np.log1p(n_words) / 4, np.minimum(1, [b.linked for b in flat] / size), digits / size, np.minimum(1, commas / np.maximum(n_words, 1)), place, np.array([min(b.depth, 20) for b in flat]) / 10], axis=1).astype(np.float32) if flat else np.zeros((0, RATIOS), np.float32)
    return rows, buckets, words, ratios


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Parameters, forward and backward pass."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        # names that training never met say next to nothing
        wide = EMBED_PATH + EMBED_WORD + RATIOS
        normal = lambda *shape, by=0.3: (r.standard_normal(shape) * by).astype(np.float32)
        self.p = {"paths": normal(PATHS, EMBED_PATH, by=0.01), "words": normal(WORDS, EMBED_WORD)}
        for d in "fb":
            self.p |= {f"x{d}": normal(wide, 4 * HIDDEN, by=wide**-0.5), f"h{d}": normal(HIDDEN, 4 * HIDDEN, by=HIDDEN**-0.5), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.p |= {"out": normal(2 * HIDDEN, by=0.3), "bias": np.zeros(1, np.float32)}

    def embed(self, rows: np.ndarray, buckets: np.ndarray, words: np.ndarray, ratios: np.ndarray) -> np.ndarray:
        x = np.zeros((len(words), EMBED_PATH), np.float32)
        starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else rows
        if len(rows):
            x[rows[starts]] = np.add.reduceat(self.p["paths"][buckets], starts, axis=0)
        return np.concatenate([np.tanh(x), np.tanh(4 * (words @ self.p["words"])), ratios], axis=1)

    def run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction over padded pages (page, block, input); steps beyond a page's end change nothing."""
        n, steps, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, steps, HIDDEN), np.float32)
        fed = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = fed[:, t] + h @ self.p[f"h{d}"]
            i, f, o = (sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g, m = np.tanh(z[:, 3 * HIDDEN :]), mask[:, t, None]
            new = f * c + i * g
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, new, m))
            c = np.where(m, new, c)
            h = np.where(m, o * np.tanh(new), h)
            out[:, t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self.run(x, mask, "f"), self.run(x, mask, "b")], axis=2)
        return states @ self.p["out"] + self.p["bias"]

    def gradients(self, batch: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], place: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy. place: page and step of every block."""
        rows, buckets, words, ratios = batch
        flat = self.embed(*batch)
        x = np.zeros((*mask.shape, flat.shape[1]), np.float32)
        x[place[:, 0], place[:, 1]] = flat
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run(x, mask, d, kept[d]) for d in "fb"], axis=2)
        dz = np.where(mask, sigmoid(states @ self.p["out"] + self.p["bias"]) - y, 0) / mask.sum()
        grad = {"out": np.einsum("nt,nth->h", dz, states), "bias": dz.sum(keepdims=True).reshape(1)}
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            dout = dz[:, :, None] * self.p["out"][k * HIDDEN : (k + 1) * HIDDEN]
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            gx, gh, gc = (np.zeros_like(self.p[f"{w}{d}"]) for w in "xhc")
            for t, h0, c0, i, f, o, g, new, m in reversed(kept[d]):
                dh = dh + dout[:, t]
                tan = np.tanh(new)
                dnew = np.where(m, dc + dh * o * (1 - tan * tan), 0)
                dgates = np.concatenate([dnew * g * i * (1 - i), dnew * c0 * f * (1 - f), np.where(m, dh * tan * o * (1 - o), 0), dnew * i * (1 - g * g)], axis=1)
                gx += x[:, t].T @ dgates
                gh += h0.T @ dgates
                gc += dgates.sum(0)
                dx[:, t] += dgates @ self.p[f"x{d}"].T
                dh = np.where(m, 0, dh) + dgates @ self.p[f"h{d}"].T
                dc = np.where(m, dnew * f, dc)
            grad |= {f"x{d}": gx, f"h{d}": gh, f"c{d}": gc}
        dflat = dx[place[:, 0], place[:, 1]]
        dpath = dflat[:, :EMBED_PATH] * (1 - flat[:, :EMBED_PATH] ** 2)
        dword = dflat[:, EMBED_PATH : EMBED_PATH + EMBED_WORD] * (1 - flat[:, EMBED_PATH : EMBED_PATH + EMBED_WORD] ** 2)
        grad["paths"] = np.zeros_like(self.p["paths"])
        np.add.at(grad["paths"], buckets, dpath[rows])
        grad["words"] = 4 * (words.T @ dword)
        return grad


def padded(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    mask = np.arange(max(lengths, default=0))[None, :] < np.array(lengths)[:, None]
    return mask, np.argwhere(mask)


@cache
def train(pages: int = 4000, rounds: int = 8, seed: int = 11, together: int = 24) -> Labeller:
    """Trains on generated pages, once a process; the same seed gives the same labeller."""
    grammar, data = Grammar(seed), []
    for _ in range(pages):
        pieces = grammar.page()
        ends = np.cumsum([len(t) for t, _ in pieces])
        found = blocks("".join(t for t, _ in pieces))
        if found:
            data.append((found, [float(pieces[int(np.searchsorted(ends, b.at, "right"))][1]) for b in found]))
    model, r = Labeller(seed), np.random.default_rng(seed)
    m, v, step = {k: 0.0 for k in model.p}, {k: 0.0 for k in model.p}, 0
    data.sort(key=lambda x: len(x[0]))
    groups = [data[i : i + together] for i in range(0, len(data), together)]
    ready = []
    for g in groups:
        mask, place = padded([len(b) for b, _ in g])
        y = np.zeros(mask.shape, np.float32)
        y[place[:, 0], place[:, 1]] = [x for _, ys in g for x in ys]
        ready.append((inputs([b for b, _ in g]), place, mask, y))
    total = rounds * len(ready)
    for _ in range(rounds):
        for k in r.permutation(len(ready)):
            step += 1
            grad = model.gradients(*ready[k])
            rate = 0.02 * (1 - step / (total + 1))
            for name, g in grad.items():
                g = np.clip(g, -1, 1)
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.99 * v[name] + 0.01 * g * g
                model.p[name] -= (rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def label(model: Labeller, pages: list[list[Block]], together: int = 64) -> list[np.ndarray]:
    """For every page, which of its blocks are main text. Pages of like length run together; a page of any length is read whole."""
    out: list = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    for lo in range(0, len(order), together):
        group = order[lo : lo + together]
        mask, place = padded([len(pages[i]) for i in group])
        flat = model.embed(*inputs([pages[i] for i in group]))
        x = np.zeros((*mask.shape, flat.shape[1]), np.float32)
        x[place[:, 0], place[:, 1]] = flat
        z = model.logits(x, mask)
        for k, i in enumerate(group):
            out[i] = z[k, : len(pages[i])] > 0
    return out


def extract(sources: list[str | None], model: Labeller) -> list[str]:
    pages = [blocks(s) if s else [] for s in sources]
    return [" ".join(b.text for b, own in zip(p, keep, strict=True) if own) for p, keep in zip(pages, label(model, pages), strict=True)]


def main_text(pages: DataFrame, html: str = "html", model: Labeller | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row. Null and empty pages, and pages without main text, have an empty text; null ids and urls stay null; repeated rows stay; an empty table gives no rows."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                text = extract(part.column(2).to_pylist(), own)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    slim = only(pages, page_id="page_id", url="url", html=html)
    return map_arrow(slim.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")), run, "page_id bigint, url string, text string, n_chars bigint")
