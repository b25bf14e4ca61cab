"""Quality scores: a byte-level convolutional network, trained and run in numpy.

Filters of WIDTH bytes run over every byte of the UTF-8 text. Their outputs are max-pooled in chunks of CHUNK_BLOCKS blocks that
overlap by half and cover the whole text; a chunk's pooled outputs and its fill (below 1 for short texts, which cannot show
all that a full chunk shows) feed a hidden layer, whose units are combined over all chunks by their largest and their mean
value into one probability that the text is good.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, once_per_worker, table, text_of
from .labelled import held_out, sample

WIDTH, DIM, FILTERS, HIDDEN = 6, 8, 24, 16
#: Bytes of a block; blocks of a chunk; blocks from one chunk to the next.
BLOCK, CHUNK_BLOCKS, STEP = 64, 4, 2
#: At most so many labelled texts of each class are learnt from, those with the least hash of their id, of so many bytes at most.
SAMPLE_PER_CLASS, SAMPLE_BYTES = 2500, 20_000
#: Updates of a training and texts of one update.
UPDATES, BATCH, RATE = 600, 48, 0.006
#: Share of the good texts of an update that are cut to a random short piece: a piece of a good text is good.
CUT = 0.3
#: Positions of a text that are convolved at a time, and bytes of texts that are laid out at a time: they bound the memory.
SLICE, LAYOUT = 1 << 14, 1 << 22


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, blocks of each text): every text between WIDTH - 1 zero bytes, filled with zeros to whole blocks, so that no filter
    sees two texts."""
    gap, parts, blocks = bytes(WIDTH - 1), [], []
    for t in texts:
        n = -(-(len(t) + 2 * len(gap)) // BLOCK)
        parts += [gap, t, bytes(n * BLOCK - len(t) - len(gap))]
        blocks.append(n)
    return np.frombuffer(b"".join([*parts, gap]), np.uint8), np.array(blocks, np.int64)


def chunks(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of each chunk (C, CHUNK_BLOCKS), first chunk of each text). The last chunk of a text ends with it; a text of fewer
    blocks than a chunk names its last one again."""
    count = np.maximum(0, -(-(blocks - CHUNK_BLOCKS) // STEP)) + 1
    first = np.cumsum(np.r_[0, count[:-1]])
    owner = np.repeat(np.arange(len(blocks)), count)
    begin, size = np.cumsum(np.r_[0, blocks[:-1]])[owner], blocks[owner]
    start = np.minimum((np.arange(len(owner)) - first[owner]) * STEP, np.maximum(size - CHUNK_BLOCKS, 0))
    return begin[:, None] + np.minimum(start[:, None] + np.arange(CHUNK_BLOCKS), size[:, None] - 1), first


class ByteCnn:
    def __init__(self, seed: int = 11):
        g = np.random.default_rng(seed)
        f = lambda *s, n: (g.standard_normal(s) / np.sqrt(n)).astype(np.float32)
        zeros = lambda *s: np.zeros(s, np.float32)
        self.p = {
            "byte": f(256, DIM, n=1), "filter": f(WIDTH, DIM, FILTERS, n=WIDTH * DIM), "fb": zeros(FILTERS),
            "w1": f(FILTERS + 1, HIDDEN, n=FILTERS), "b1": zeros(HIDDEN), "w2": f(2 * HIDDEN, n=2 * HIDDEN), "b2": zeros(1),
        }
        self.p["byte"][0] = 0

    def outputs(self, raw: np.ndarray) -> np.ndarray:
        """(positions, FILTERS) of all positions, by one table of bytes a filter column."""
        n = len(raw) - WIDTH + 1
        out = np.repeat(self.p["fb"][None], n, axis=0)
        for j in range(WIDTH):
            out += (self.p["byte"] @ self.p["filter"][j])[raw[j : j + n]]
        return out

    def head(self, pooled: np.ndarray, first: np.ndarray, texts: list[bytes], keep: bool = False):
        """pooled (C, FILTERS) of all chunks -> logits of the texts."""
        p = self.p
        size = np.diff(np.r_[first, len(pooled)])[:, None]
        fill = np.repeat([min(1.0, len(t) / (BLOCK * CHUNK_BLOCKS)) for t in texts], size[:, 0])
        x = np.concatenate([np.maximum(pooled, 0), fill[:, None].astype(np.float32)], axis=1)
        h = np.tanh(x @ p["w1"] + p["b1"])
        top, mean = np.maximum.reduceat(h, first, axis=0), np.add.reduceat(h, first, axis=0) / size
        logit = np.concatenate([top, mean], axis=1) @ p["w2"] + p["b2"]
        return (logit, x, h, top, mean, size) if keep else logit

    def gradients(self, texts: list[bytes], y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """(mean log loss, its gradients)"""
        p = self.p
        raw, blocks = layout(texts)
        groups, first = chunks(blocks)
        out = self.outputs(raw).reshape(-1, BLOCK, FILTERS)
        at = out.argmax(axis=1)
        best = np.take_along_axis(out, at[:, None], axis=1)[:, 0]
        which = best[groups].argmax(axis=1)  # (C, FILTERS)
        block = np.take_along_axis(groups, which, axis=1)
        column = np.arange(FILTERS)
        pooled, pos = best[block, column], block * BLOCK + at[block, column]
        logit, x, h, top, mean, size = self.head(pooled, first, texts, keep=True)
        prob = _sigmoid(logit)
        loss = float(-np.mean(np.log(np.where(y > 0.5, prob, 1 - prob) + 1e-9)))
        d = ((prob - y) / len(y)).astype(np.float32)
        g = {"w2": np.concatenate([top, mean], axis=1).T @ d, "b2": np.array([d.sum()], np.float32)}
        owner = np.repeat(np.arange(len(texts)), size[:, 0])
        dh = (d[:, None] * p["w2"][HIDDEN:] / size)[owner]
        is_top = h == top[owner]
        ties = np.add.reduceat(is_top.astype(np.float32), first, axis=0)
        dh = dh + np.where(is_top, (d[:, None] * p["w2"][:HIDDEN] / ties)[owner], 0)
        dh *= 1 - h * h
        g["w1"], g["b1"] = x.T @ dh, dh.sum(axis=0)
        dp = (dh @ p["w1"][:FILTERS].T) * (pooled > 0)
        g["fb"] = dp.sum(axis=0)
        g["filter"], g["byte"] = np.zeros_like(p["filter"]), np.zeros_like(p["byte"])
        for j in range(WIDTH):
            seen = raw[pos + j]
            g["filter"][j] = np.einsum("cf,cfd->df", dp, p["byte"][seen])
            by_byte = np.zeros((FILTERS, 256), np.float32)
            for f in range(FILTERS):
                by_byte[f] = np.bincount(seen[:, f], dp[:, f], 256)
            g["byte"] += np.einsum("fb,df->bd", by_byte, p["filter"][j])
        g["byte"][0] = 0
        return loss, g


def train(texts: list[bytes], labels: list[int], seed: int = 11, updates: int = UPDATES) -> ByteCnn:
    """Adam on the log loss, each batch half of either class. Deterministic for equal inputs."""

    def piece(i: int) -> bytes:
        t = texts[i]
        if y[i] < 0.5 or g.random() >= CUT:
            return t
        n = int(np.exp(g.uniform(np.log(12), np.log(2 * BLOCK * CHUNK_BLOCKS))))
        words = t[(at := int(g.integers(0, max(1, len(t) - n)))) : at + n].split(b" ")
        return b" ".join(words[1:] or words)

    net, g = ByteCnn(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    of = [np.flatnonzero(y == c) for c in (0, 1)]
    m, v = ({k: np.zeros_like(w) for k, w in net.p.items()} for _ in range(2))
    for step in range(1, updates + 1):
        pick = np.concatenate([g.choice(rows, BATCH // 2) for rows in of])
        _, grad = net.gradients([piece(i) for i in pick], y[pick])
        rate = RATE * min(1, step / 30) * (0.1 if step > 0.8 * updates else 1)
        for k, w in net.p.items():
            m[k] += 0.1 * (grad[k] - m[k])
            v[k] += 0.001 * (grad[k] ** 2 - v[k])
            w -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


class Scorer:
    """Scores whole texts. Filters are looked up for two bytes at a time."""

    def __init__(self, net: ByteCnn):
        self.net = net
        one = [net.p["byte"] @ net.p["filter"][j] for j in range(WIDTH)]
        self.tables = [(one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)]
        self.tables[0] = self.tables[0] + net.p["fb"]

    def block_max(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw) - WIDTH + 1
        two = raw[:-1].astype(np.int64) << 8 | raw[1:]
        out = np.empty((n // BLOCK, FILTERS), np.float32)
        for lo in range(0, n, SLICE):
            hi = min(n, lo + SLICE)
            a = self.tables[0].take(two[lo:hi], axis=0)
            for j, t in enumerate(self.tables[1:], 1):
                a += t.take(two[lo + 2 * j : hi + 2 * j], axis=0)
            out[lo // BLOCK : hi // BLOCK] = a.reshape(-1, BLOCK, FILTERS).max(axis=1)
        return out

    def _scored(self, texts: list[bytes]) -> list[float]:
        raw, blocks = layout(texts)
        groups, first = chunks(blocks)
        best = self.block_max(raw)
        pooled = best[groups[:, 0]]
        for k in range(1, CHUNK_BLOCKS):
            np.maximum(pooled, best[groups[:, k]], out=pooled)
        return _sigmoid(self.net.head(pooled, first, texts).astype(np.float64)).tolist()

    def scores(self, texts: Iterable[bytes]) -> list[float]:
        out, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= LAYOUT:
                out += self._scored(held)
                held, size = [], 0
        return out + (self._scored(held) if held else [])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> ByteCnn | float:
    """A network from sample(); only those rows reach the driver. Where a class has no row, the other one's label is the score of
    every text (0.5 without labels)."""
    rows = sample(docs, labels, label, per_class, SAMPLE_BYTES)
    if len({y for _, y in rows}) < 2:
        return float(rows[0][1]) if rows else 0.5
    return train([t for t, _ in rows], [y for _, y in rows])


def score_column(text: Column, net: ByteCnn | float) -> Column:
    """0 to 1 for every whole text; null counts as empty."""
    if isinstance(net, float):
        return F.lit(net)
    name = f"byte-cnn-{uuid.uuid4().hex}"

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        scorer = once_per_worker(name, lambda: Scorer(net))
        return pa.array(scorer.scores(t.as_py() or b"" for t in column), pa.float64())

    return score.asNondeterministic()(text.cast("binary"))


def keep_good(docs: DataFrame, net: ByteCnn | float, threshold: float = 0.3) -> DataFrame:
    """docs, same columns, without the rows whose score is below the threshold."""
    col = fresh(docs, "score")
    return docs.withColumn(col, score_column(text_of(docs), net)).filter(F.col(col) >= threshold).drop(col)


def op11_quality(spark, sf_dir: str) -> DataFrame:
    """The contract query over every whole text of documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out().alias("held_out"), score_column(text_of(docs), net).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
