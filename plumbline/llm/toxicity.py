"""Toxicity scores: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is a learned word vector beside the mean of learned vectors of its character 3- and 4-grams. Each text is
cut in overlapping windows; a window gets one logit and the text the largest of its windows.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, fresh, once_per_worker, table, text_of
from .labelled import held_out, sample

WINDOW, STRIDE = 48, 32
BUCKETS = 1 << 15
DIM, HIDDEN, ATTEND = 12, 8, 8
PART_WORDS = 32_768
#: At most so many labelled texts of each class are learnt from, those with the least hash of their id.
SAMPLE_PER_CLASS = 3000
#: Bytes of the longest text that is learnt from; with the number of texts they bound what reaches the driver (180 MB).
SAMPLE_BYTES = 30_000
#: Updates of a training, the first of which look at random windows, and texts of one update.
UPDATES, WARM_UP, BATCH = 600, 60, 48
#: Words whose inputs a worker remembers, and words scored at a time: they bound its memory.
CACHE_WORDS, CHUNK_WORDS = 150_000, 150_000


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket per word, n-gram buckets of all words one after another, where each word's n-grams start)."""
    if len(words) > PART_WORDS:  # the byte arrays below are many times the size of what is returned
        parts = [buckets(words[i : i + PART_WORDS]) for i in range(0, len(words), PART_WORDS)]
        before = np.cumsum([0, *(len(p[1]) for p in parts[:-1])])
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] + n for p, n in zip(parts, before)])
    raw = np.frombuffer(b"^" + b"$^".join(words) + b"$", np.uint8).astype(np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    stop = np.cumsum(size)
    left = np.repeat(stop, size) - np.arange(len(raw))  # bytes up to the word's end
    with np.errstate(over="ignore"):
        a, b = np.uint32(0x01000193), np.uint32(0x9E3779B1)
        tri = (raw[:-2] * a + raw[1:-1]) * a + raw[2:]
        four = tri[:-1] * a + raw[3:] + np.uint32(77)
        pos = np.r_[np.flatnonzero(left[:-2] >= 3), np.flatnonzero(left[:-3] >= 4)]
        three = int((left[:-2] >= 3).sum())
        h = np.r_[tri[pos[:three]], four[pos[three:]]] * b
        order = np.argsort(pos, kind="stable")
        owner = np.searchsorted(stop, pos[order], side="right")
        weight = (left.astype(np.uint32) * np.uint32(0x85EBCA6B)) ^ np.uint32(0x27D4EB2F)
        whole = np.add.reduceat(raw * weight, stop - size, dtype=np.uint32)
    shift = np.uint32(17)
    return (whole * b >> shift).astype(np.int32), (h[order] >> shift).astype(np.int32), np.searchsorted(owner, np.arange(len(words)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def windows_of(n: int) -> list[int]:
    """Where the windows of a text of n words start; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class BiGru:
    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        f = lambda *s: (g.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.word, self.gram = (np.zeros((BUCKETS, DIM), np.float32) for _ in range(2))
        self.p = {"wx": f(2 * DIM, 6 * HIDDEN), "bx": np.zeros(6 * HIDDEN, np.float32), "uf": f(HIDDEN, 3 * HIDDEN), "ub": f(HIDDEN, 3 * HIDDEN),
                  "wa": f(2 * HIDDEN, ATTEND), "va": f(ATTEND), "wo": f(2 * HIDDEN), "bo": np.array([-1.0], np.float32)}

    def inputs(self, words: list[bytes]) -> np.ndarray:
        own, grams, start = buckets(words)
        count = np.diff(np.r_[start, len(grams)])
        mean = np.add.reduceat(self.gram[grams], start, axis=0) / count[:, None]
        return np.concatenate([self.word[own], mean], axis=1).astype(np.float32)

    def _run(self, x, u, mask, keep):
        """x (T, B, 3H) in time order -> outputs (T, H, B) and what the way back needs."""
        t_max, b, h3 = x.shape
        n_h = h3 // 3
        h, ut = np.zeros((n_h, b), np.float32), np.ascontiguousarray(u.T)
        out, tape = np.empty((t_max, n_h, b), np.float32), []
        for t in range(t_max):
            uh = ut @ h
            gate = uh[: 2 * n_h] + x[t, :, : 2 * n_h].T
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            z, r = gate[:n_h], gate[n_h:]
            n = r * uh[2 * n_h :]
            n += x[t, :, 2 * n_h :].T
            np.tanh(n, out=n)
            if keep:
                tape.append((h, z, r, n, uh[2 * n_h :]))
            new = h - n
            new *= z
            new += n
            h = new if mask is None else np.where(mask[t], new, h)
            out[t] = h
        return out, tape

    def forward(self, x, mask=None, keep=False):
        """x (T, B, 6H): projected inputs; mask (T, B) is true on words. -> logits (B,)"""
        n_h, p = HIDDEN, self.p
        back = None if mask is None else mask[::-1]
        hf, tape_f = self._run(x[:, :, : 3 * n_h], p["uf"], mask, keep)
        hb, tape_b = self._run(x[::-1, :, 3 * n_h :], p["ub"], back, keep)
        h = np.concatenate([hf, hb[::-1]], axis=1)
        att = np.tanh(np.matmul(p["wa"].T, h))
        e = np.tensordot(p["va"], att, (0, 1))
        if mask is not None:
            e = np.where(mask, e, np.float32(-30))
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        pooled = np.einsum("tb,thb->hb", e, h)
        logit = p["wo"] @ pooled + p["bo"]
        return (logit, (x, mask, h, att, e, pooled, tape_f, tape_b)) if keep else logit

    def _back_run(self, d_out, u, tape, mask):
        d_u, d_x, dh = np.zeros_like(u), [None] * len(tape), 0
        for t in range(len(tape) - 1, -1, -1):
            h, z, r, n, hn = tape[t]
            dh = dh + d_out[t]
            live = dh if mask is None else dh * mask[t]
            dan = live * (1 - z) * (1 - n * n)
            daz = live * (h - n) * z * (1 - z)
            dar = dan * hn * r * (1 - r)
            da = np.concatenate([daz, dar, dan * r])
            d_u += h @ da.T
            d_x[t] = np.concatenate([daz, dar, dan])
            dh = live * z + u @ da + (dh - live)
        return d_u, np.stack(d_x)

    def backward(self, d_logit, saved) -> tuple[dict, np.ndarray]:
        x, mask, h, att, e, pooled, tape_f, tape_b = saved
        p, n_h = self.p, HIDDEN
        g = {"bo": np.array([d_logit.sum()], np.float32), "wo": pooled @ d_logit}
        d_pool = p["wo"][:, None] * d_logit
        dh = e[:, None, :] * d_pool
        de = np.einsum("hb,thb->tb", d_pool, h)
        ds = e * (de - (e * de).sum(axis=0))
        g["va"] = np.einsum("tb,tab->a", ds, att)
        d_att = ds[:, None, :] * p["va"][None, :, None] * (1 - att * att)
        g["wa"] = np.einsum("thb,tab->ha", h, d_att)
        dh = dh + np.einsum("ha,tab->thb", p["wa"], d_att)
        g["uf"], dxf = self._back_run(dh[:, :n_h], p["uf"], tape_f, mask)
        g["ub"], dxb = self._back_run(dh[::-1, n_h:], p["ub"], tape_b, None if mask is None else mask[::-1])
        return g, np.concatenate([dxf, dxb[::-1]], axis=1).transpose(0, 2, 1)


def _stack(starts: list[tuple[int, int, int]], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """(first word, words, text) of each window -> word ids (T, B) and a mask where a window is short."""
    at, size = np.array([s[0] for s in starts]), np.array([s[1] for s in starts])
    t = np.arange(WINDOW)[:, None]
    mask = t < size
    if mask.all():
        return ids[at + t], None
    return np.where(mask, ids[np.minimum(at + t, len(ids) - 1)] if len(ids) else 0, 0), mask


def train(texts: list[str], labels: list[int], seed: int = 7) -> BiGru:
    """The largest window logit of a text is fitted to its label, by Adam and, for the word inputs, Adagrad."""
    net, g = BiGru(seed), np.random.default_rng(seed)
    vocab: dict[bytes, int] = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in words_of(t)], np.int64) for t in texts]
    own, grams, start = buckets(list(vocab) or [b"?"])
    count = np.diff(np.r_[start, len(grams)])
    y = np.array(labels, np.float32)
    m, v = ({k: np.zeros_like(w) for k, w in net.p.items()} for _ in range(2))
    acc_w, acc_g = (np.full((BUCKETS, 1), 1e-3, np.float32) for _ in range(2))
    steps, rate = 0, 0.01
    while steps < UPDATES:
        order = g.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            batch = [int(i) for i in order[lo : lo + BATCH]]
            flat = np.concatenate([docs[i] for i in batch])
            if not len(flat) or steps >= UPDATES:
                steps += 1  # a batch of empty texts has no gradient
                continue
            warm = steps < WARM_UP
            uniq, ids = np.unique(flat, return_inverse=True)
            begin = np.cumsum(np.r_[0, count[uniq][:-1]])
            pick = np.arange(count[uniq].sum()) + np.repeat(start[uniq] - begin, count[uniq])
            x_u = np.concatenate([net.word[own[uniq]], np.add.reduceat(net.gram[grams[pick]], begin, axis=0) / count[uniq][:, None]], axis=1)
            proj = (x_u @ net.p["wx"] + net.p["bx"]).astype(np.float32)
            wins, at = [], 0
            for k, i in enumerate(batch):
                wins += [(at + s, min(WINDOW, len(docs[i])), k) for s in windows_of(len(docs[i]))]
                at += len(docs[i])
            text_of_win = np.array([w[2] for w in wins])
            if warm:  # which windows matter is not known yet
                rank = g.random(len(wins))
            else:
                rank = np.concatenate([net.forward(proj[i], k) for i, k in (_stack(wins[s : s + 2048], ids) for s in range(0, len(wins), 2048))])
            by = np.lexsort((-rank, text_of_win))
            place = np.arange(len(by)) - np.searchsorted(text_of_win[by], text_of_win[by])
            chosen = np.sort(by[place < (3 if warm else 1)])
            idx, mask = _stack([wins[c] for c in chosen], ids)
            logit, saved = net.forward(proj[idx], mask, keep=True)
            d = (_sigmoid(logit) - y[[batch[k] for k in text_of_win[chosen]]]).astype(np.float32) / len(chosen)
            grad, dx = net.backward(d, saved)
            if mask is not None:
                dx = dx * mask[:, :, None]
            near, inv = np.unique(idx, return_inverse=True)  # only words of these windows have a gradient
            d_proj = np.zeros((len(near), dx.shape[2]), np.float32)
            np.add.at(d_proj, inv.ravel(), dx.reshape(-1, dx.shape[2]))
            x_near, words = x_u[near], uniq[near]
            grad["wx"], grad["bx"] = x_near.T @ d_proj, d_proj.sum(axis=0)
            d_in = d_proj @ net.p["wx"].T
            begin = np.cumsum(np.r_[0, count[words][:-1]])
            pick = np.arange(count[words].sum()) + np.repeat(start[words] - begin, count[words])
            rows = np.repeat(np.arange(len(words)), count[words])
            for vec, acc, rows_, bucket, part in (
                (net.word, acc_w, np.arange(len(words)), own[words], d_in[:, :DIM]),
                (net.gram, acc_g, rows, grams[pick], d_in[:, DIM:] / count[words][:, None]),
            ):
                hit, inv = np.unique(bucket, return_inverse=True)
                sums = np.zeros((len(hit), DIM), np.float32)
                np.add.at(sums, inv, part[rows_])
                acc[hit] += (sums * sums).mean(axis=1, keepdims=True) * 100
                vec[hit] -= 0.15 * sums / np.sqrt(acc[hit])
            steps += 1
            for k, w in net.p.items():
                m[k] += 0.1 * (grad[k] - m[k])
                v[k] += 0.001 * (grad[k] ** 2 - v[k])
                w -= rate * (m[k] / (1 - 0.9**steps)) / (np.sqrt(v[k] / (1 - 0.999**steps)) + 1e-6)
    return net


class _Index(dict):
    """word -> its number, in order of first sight."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Scorer:
    """Scores whole texts; remembers the projected inputs of at most CACHE_WORDS words."""

    def __init__(self, net: BiGru):
        self.net = net
        self._forget()

    def _forget(self):
        self.seen = _Index()
        self.proj = np.zeros((0, 6 * HIDDEN), np.float32)

    def _ids(self, texts: list[list[bytes]]) -> np.ndarray:
        if len(self.seen) > CACHE_WORDS:
            self._forget()
        seen, first = self.seen, len(self.seen)
        ids = np.fromiter(map(seen.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        if len(seen) > first:
            new = list(islice(seen, first, None))
            self.proj = np.concatenate([self.proj, self.net.inputs(new) @ self.net.p["wx"] + self.net.p["bx"]])
        return ids

    def _chunk(self, texts: list[list[bytes]]) -> list[float]:
        ids = self._ids(texts)
        proj = self.proj if len(self.proj) else np.zeros((1, 6 * HIDDEN), np.float32)
        full, short, at = [], [], 0
        for k, ws in enumerate(texts):
            kind = full if len(ws) >= WINDOW else short
            kind += [(at + s, min(WINDOW, len(ws)), k) for s in windows_of(len(ws))]
            at += len(ws)
        best = np.full(len(texts), -np.inf, np.float32)
        for wins in (full, short):
            for lo in range(0, len(wins), 1024):
                part = wins[lo : lo + 1024]
                idx, mask = _stack(part, ids)
                np.maximum.at(best, [w[2] for w in part], self.net.forward(proj[idx], mask))
        return _sigmoid(best.astype(np.float64)).tolist()

    def scores(self, texts) -> list[float]:
        out, held, size = [], [], 0
        for t in texts:
            ws = words_of(t)
            held.append(ws)
            size += len(ws)
            if size >= CHUNK_WORDS:
                out += self._chunk(held)
                held, size = [], 0
        return out + (self._chunk(held) if held else [])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> BiGru | float:
    """A network from labelled rows of docs that are not held out, at most per_class of each class and without texts of more than
    SAMPLE_BYTES bytes; those rows are the only ones that reach the driver. All texts are scored whole. An id with both labels is
    not learnt from. Where a class has no row, the share of label 1 (0 without labels) stands in for it."""
    rows = sample(docs, labels, "toxic", per_class, SAMPLE_BYTES)
    if len({y for _, y in rows}) < 2:
        return float(rows[0][1]) if rows else 0.0
    net = train([t.decode("utf-8", "replace") for t, _ in rows], [y for _, y in rows])
    gc.collect()
    with contextlib.suppress(AttributeError):  # what the C library keeps of the training's memory goes back, where it can
        ctypes.CDLL(None).malloc_trim(0)
    return net


def score_column(text: Column, net: BiGru | float) -> Column:
    """0 to 1 for every whole text; null counts as empty."""
    if isinstance(net, float):
        return F.lit(net)
    name = f"scorer-{uuid.uuid4().hex}"

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        scorer = once_per_worker(name, lambda: Scorer(net))
        return pa.array(scorer.scores(t.as_py() or "" for t in column), pa.float64())

    return score.asNondeterministic()(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, net: BiGru | float | None = None) -> DataFrame:
    """docs, same columns, without the rows whose score reaches the threshold. Null and empty texts are scored as empty. A network
    that fit() gave before saves the training."""
    score = fresh(docs, "score")
    scored = docs.withColumn(score, score_column(text_of(docs), fit(docs, labels) if net is None else net))
    return scored.filter(F.col(score) < threshold).drop(score)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """The contract query over every whole text of documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = docs.select("doc_id", held_out().alias("held_out"), score_column(text_of(docs), fit(docs, table(spark, sf_dir, "labels"))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
