"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of embeddings of its character 4-grams and of the
word itself (one hashed table).  A forward and a backward GRU read windows of
``WIDTH`` words; attention pools their states; a logistic output scores the
window.  All windows, ``STRIDE`` words apart, of every document are scored,
and the document's score is that of its worst window, calibrated on the
training documents.

Labels name documents, not windows, so training is multiple-instance: in
every epoch the worst windows of toxic documents are the positive examples,
and the worst and some random windows of clean ones the negative examples.
The network is trained in numpy on a bounded sample; scoring is a map over
the rows, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.llm.bytes_kernel import ALNUM, LOWER, mix, texts, word_hashes
from adfuse.llm.quality_rules import _fold
from adfuse.llm.tables import pick, table

WIDTH, STRIDE = 16, 8
HIDDEN, DIM = 6, 8
#: Rows of the embedding table for character 4-grams, and for words.
GRAMS, WORDS = 1 << 15, 1 << 15
#: Training documents of each label, at most: those with the smallest hash of their id; longer texts are not drawn.
TOXIC, CLEAN, CHARS = 1200, 2400, 20_000
#: Epochs, and more of them for small samples: at least so many steps of BATCH_FIT windows.
EPOCHS, STEPS, BATCH_FIT = 6, 240, 256
#: A document is called toxic from this score.
FLAG = 0.7
#: Words, and windows, handled at once.
BLOCK, BATCH = 200_000, 4096

_F = np.float32
_U = np.uint64


def features(low: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of every word (4-grams with the word's ends marked, then the word), and how many each has."""
    size = end - start
    n = size + 1  # a 4-gram begins at the mark before the word and at each byte; the last row is the word
    word = np.repeat(np.arange(len(start)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)  # 0: the word itself, k: the gram around byte k - 1
    gram = np.zeros(len(word), _U)
    for k in range(4):
        place = at + k - 2
        inside = (place >= 0) & (place < size[word])
        byte = np.where(inside, low[np.minimum(start[word] + np.maximum(place, 0), len(low) - 1)], 0)
        gram = gram * _U(257) + byte.astype(_U)
    rows = (mix(gram) % _U(GRAMS)).astype(np.int64)
    whole = at == 0
    rows[whole] = GRAMS + (hashes[word[whole]] % _U(WORDS)).astype(np.int64)
    return rows, n


def window_starts(words: int) -> np.ndarray:
    return np.arange(0, max(words - (WIDTH - STRIDE), 1), STRIDE)


@dataclass
class Network:
    """Parameters; ``scale`` and ``shift`` calibrate the worst window's logit."""

    table: np.ndarray
    wx: list[np.ndarray]  # forward, backward: DIM x 3 HIDDEN (update, reset, new)
    bias: list[np.ndarray]
    u: list[np.ndarray]
    attend: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape, s: (r.standard_normal(shape) * s).astype(_F)
        return cls(
            draw(GRAMS + WORDS, DIM, s=0.05),
            [draw(DIM, 3 * HIDDEN, s=0.4) for _ in range(2)],
            [np.zeros(3 * HIDDEN, _F) for _ in range(2)],
            [draw(HIDDEN, 3 * HIDDEN, s=0.3) for _ in range(2)],
            draw(2 * HIDDEN, s=0.3),
            draw(2 * HIDDEN, s=0.3),
            np.zeros(1, _F),
        )

    def dense(self) -> list[np.ndarray]:
        return [*self.wx, *self.bias, *self.u, self.attend, self.out, self.out_bias]

    def embed(self, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
        """One vector per word: the sum of its rows over the root of their number."""
        total = np.add.reduceat(self.table[rows], np.cumsum(n) - n, axis=0) if len(n) else np.zeros((0, DIM), _F)
        return total / np.sqrt(n)[:, None].astype(_F)

    def inputs(self, x: np.ndarray) -> list[np.ndarray]:
        """The input part of all gates, per direction; the last row stands for padding."""
        pad = np.zeros((1, 3 * HIDDEN), _F)
        return [np.vstack([x @ w + b, pad]) for w, b in zip(self.wx, self.bias, strict=True)]

    def forward(self, gates: list[np.ndarray], idx: np.ndarray, real: np.ndarray | None, keep: bool = False):
        """Logits of windows (rows of ``idx`` into the gates); ``real`` masks padding."""
        n, h3 = len(idx), HIDDEN
        states = np.empty((n, WIDTH, 2 * h3), _F)
        trace: list[list] = [[], []]
        for d in range(2):
            h = np.zeros((n, h3), _F)
            for t in range(WIDTH) if d == 0 else range(WIDTH - 1, -1, -1):
                p = gates[d][idx[:, t]]
                q = h @ self.u[d]
                zr = 0.5 * (1 + np.tanh(0.5 * (p[:, : 2 * h3] + q[:, : 2 * h3])))
                z, r = zr[:, :h3], zr[:, h3:]
                new = np.tanh(p[:, 2 * h3 :] + r * q[:, 2 * h3 :])
                after = new + z * (h - new)
                if real is not None:
                    after = np.where(real[:, t, None], after, h)
                if keep:
                    trace[d].append((t, h, z, r, new, q[:, 2 * h3 :]))
                h = after
                states[:, t, d * h3 : (d + 1) * h3] = h
        a = states @ self.attend
        if real is not None:
            a = np.where(real, a, -30)
        a = np.exp(a - a.max(axis=1, keepdims=True))
        a /= a.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,ntk->nk", a, states)
        logit = pooled @ self.out + self.out_bias[0]
        return (logit, states, a, pooled, trace) if keep else logit

    def backward(self, x, gates, idx, real, y, weight):
        """Gradients of the weighted logistic loss: dense parameters, and the word vectors ``x``."""
        h3 = HIDDEN
        logit, states, a, pooled, trace = self.forward(gates, idx, real, keep=True)
        d_logit = ((1 / (1 + np.exp(-logit)) - y) * weight / len(y)).astype(_F)
        d_out, d_out_bias = pooled.T @ d_logit, np.array([d_logit.sum()], _F)
        d_pool = d_logit[:, None] * self.out
        d_a = np.einsum("nk,ntk->nt", d_pool, states)
        d_a = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
        d_attend = np.einsum("nt,ntk->k", d_a, states)
        d_states = a[:, :, None] * d_pool[:, None, :] + d_a[:, :, None] * self.attend
        grads, d_x = [[], [], []], np.zeros((len(x) + 1, DIM), _F)
        for d in range(2):
            d_gate = [np.zeros_like(gates[d]), np.zeros_like(self.u[d])]
            d_h = np.zeros((len(y), h3), _F)
            for t, h, z, r, new, qn in reversed(trace[d]):
                d_h = d_h + d_states[:, t, d * h3 : (d + 1) * h3]
                live = d_h if real is None else np.where(real[:, t, None], d_h, 0)
                d_new = live * (1 - z) * (1 - new * new)
                d_z = live * (h - new) * z * (1 - z)
                d_r = d_new * qn * r * (1 - r)
                d_p = np.hstack([d_z, d_r, d_new])
                d_q = np.hstack([d_z, d_r, d_new * r])
                for k in range(3 * h3):
                    d_gate[0][:, k] += np.bincount(idx[:, t], d_p[:, k], len(d_gate[0]))
                d_gate[1] += h.T @ d_q
                d_h = (d_h - live) + live * z + d_q @ self.u[d].T
            d_gate[0][-1] = 0
            grads[0].append(x.T @ d_gate[0][:-1])
            grads[1].append(d_gate[0].sum(axis=0))
            grads[2].append(d_gate[1])
            d_x += d_gate[0] @ self.wx[d].T
        return [*grads[0], *grads[1], *grads[2], d_attend, d_out, d_out_bias], d_x[:-1]


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.n = params, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.n += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= self.rate * (m / (1 - 0.9**self.n)) / (np.sqrt(v / (1 - 0.999**self.n)) + 1e-8)


class Corpus:
    """Some documents as words, distinct words with their table rows, and windows."""

    def __init__(self, docs: list[np.ndarray]):
        words = [word_hashes(d, ALNUM) for d in docs]
        shift = np.cumsum([0, *map(len, docs)])
        hashes = np.concatenate([w[0] for w in words]) if words else np.empty(0, _U)
        start = np.concatenate([w[1] + s for w, s in zip(words, shift, strict=False)]) if words else np.empty(0, int)
        end = np.concatenate([w[2] + s for w, s in zip(words, shift, strict=False)]) if words else np.empty(0, int)
        low = LOWER[np.concatenate(docs)] if docs else np.empty(0, np.uint8)
        known, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.rows, self.n = features(low, start[first], end[first], known)
        count = np.array([len(w[0]) for w in words], np.int64)
        first_word = np.cumsum(count) - count
        starts = [window_starts(int(c)) for c in count]
        self.doc = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
        at = np.concatenate(starts) if starts else np.empty(0, np.int64)
        place = at[:, None] + np.arange(WIDTH)
        self.real = place < count[self.doc][:, None]
        padded = np.append(self.word, len(known))
        self.idx = padded[np.where(self.real, place + first_word[self.doc][:, None], len(self.word))]
        self.doc_words = np.repeat(np.arange(len(docs)), count)

    def logits(self, net: Network) -> np.ndarray:
        gates = net.inputs(net.embed(self.rows, self.n))
        out = np.empty(len(self.idx), _F)
        full = self.real.all(axis=1)
        for part, masked in ((np.flatnonzero(full), False), (np.flatnonzero(~full), True)):
            for lo in range(0, len(part), BATCH):
                k = part[lo : lo + BATCH]
                out[k] = net.forward(gates, self.idx[k], self.real[k] if masked else None)
        return out

    def worst(self, net: Network) -> np.ndarray:
        """The largest logit of each document's windows."""
        logit = self.logits(net)
        first = np.flatnonzero(np.diff(self.doc, prepend=-1))
        return np.maximum.reduceat(logit, first) if len(first) else np.empty(0, _F)


def _log_odds(corpus: Corpus, y: np.ndarray) -> np.ndarray:
    """How much more often each table row occurs in toxic documents: where the embedding starts from."""
    first = np.cumsum(corpus.n) - corpus.n
    pairs = np.unique(corpus.doc_words * np.int64(len(corpus.n)) + corpus.word)
    doc, word = pairs // len(corpus.n), pairs % len(corpus.n)
    n = corpus.n[word]
    rows = corpus.rows[np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    seen = np.unique(np.repeat(doc, n) * np.int64(GRAMS + WORDS) + rows)
    toxic = y[seen // (GRAMS + WORDS)] == 1
    rows = seen % (GRAMS + WORDS)
    a, b = (np.bincount(rows[k], minlength=GRAMS + WORDS) for k in (toxic, ~toxic))
    odds = np.log((a + 0.5) / (y.sum() + 1)) - np.log((b + 0.5) / (len(y) - y.sum() + 1))
    return np.where(a + b >= 3, np.clip(odds, -3, 3), 0)


def fit(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """Train on documents (UTF-8 bytes) and their 0/1 labels; None unless both labels occur."""
    y = np.asarray(labels, np.int64)
    if len(np.unique(y)) < 2:
        return None
    net, r = Network.fresh(seed), np.random.default_rng(seed)
    corpus = Corpus(docs)
    odds = _log_odds(corpus, y)
    net.table[:, 0] = odds
    first = np.cumsum(corpus.n) - corpus.n
    # Before the network knows anything, the words' own odds say which windows are worst.
    word_odds = np.append(np.maximum.reduceat(odds[corpus.rows], first), 0)
    hint = np.sort(word_odds[corpus.idx], axis=1)[:, -2:].sum(axis=1)
    dense, sparse = Adam(net.dense(), 0.02), Adam([net.table], 0.005)
    toxic = y[corpus.doc] == 1
    epoch = 0
    while epoch < epochs or dense.n < STEPS:
        score = hint if epoch == 0 else corpus.logits(net)
        order = np.lexsort((r.random(len(score)) if epoch == 0 else -score, -score, corpus.doc))
        rank = np.empty(len(order), np.int64)
        starts = np.flatnonzero(np.diff(corpus.doc[order], prepend=-1))
        rank[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        chosen = np.flatnonzero(np.where(toxic, rank < 2, (rank < 4) | (r.random(len(rank)) < 0.03)))
        r.shuffle(chosen)
        positive = toxic[chosen].mean()
        epoch += 1
        for lo in range(0, len(chosen), BATCH_FIT):
            k = chosen[lo : lo + BATCH_FIT]
            used, local = np.unique(corpus.idx[k], return_inverse=True)
            words = used[used < len(corpus.n)]
            n = corpus.n[words]
            rows = corpus.rows[np.repeat(first[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            x = net.embed(rows, n)
            target = toxic[k].astype(_F)
            weight = np.where(target == 1, 0.5 / positive, 0.5 / (1 - positive)).astype(_F)
            grads, d_x = net.backward(
                x, net.inputs(x), local.reshape(len(k), WIDTH), corpus.real[k], target, weight
            )
            dense.step(grads)
            d_rows = np.repeat(d_x / np.sqrt(n)[:, None], n, axis=0)
            d_table = np.stack([np.bincount(rows, d_rows[:, c], len(net.table)) for c in range(DIM)], axis=1)
            sparse.step([d_table.astype(_F)])
    _calibrate(net, corpus.worst(net), y)
    return net


def _calibrate(net: Network, logit: np.ndarray, y: np.ndarray) -> None:
    """A logistic fit of the labels on the documents' worst logits."""
    mean, spread = float(logit.mean()), float(logit.std()) + 1e-6
    z, w, b = (logit - mean) / spread, 1.0, 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(w * z + b, -30, 30)))
        w, b = w - 2.0 * float(((p - y) * z).mean() + 1e-3 * w), b - 2.0 * float((p - y).mean())
    net.scale, net.shift = w / spread, b - w * mean / spread


def _scores(net: Network, raw: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Scores of a column of texts, a block of documents at a time."""
    lo = 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + 5 * BLOCK, "right")) - 1)
        if at[hi] - at[lo] <= 10 * BLOCK:
            worst = Corpus([raw[at[k] : at[k + 1]] for k in range(lo, hi)]).worst(net)
        else:  # one long text, in stretches that share a window's width of words
            worst = np.array([max(float(c.worst(net)[0]) for c in _stretches(raw[at[lo] : at[hi]]))])
        yield 1 / (1 + np.exp(-np.clip(net.scale * worst.astype(float) + net.shift, -40, 40)))
        lo = hi


def _stretches(text: np.ndarray) -> Iterator[Corpus]:
    """Corpora whose windows are those of the whole text."""
    _, start, end = word_hashes(text, ALNUM)
    step = BLOCK // STRIDE * STRIDE
    for lo in range(0, max(len(start) - (WIDTH - STRIDE), 1), step):
        hi = min(lo + step + WIDTH - STRIDE, len(start))
        yield Corpus([text[start[lo] : end[hi - 1]] if hi > lo else text[:0]])


def sample_documents(docs: DataFrame, labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``toxic`` + ``clean`` labelled rows outside the held-out fold."""
    rows = pick(labels, ("doc_id", "bigint"), ("toxic", "int")).where(
        F.col("doc_id").isNotNull() & (_fold(3) != 1)
    )
    draw = lambda value, size: rows.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    chosen = draw(1, toxic).union(draw(0, clean))  # bounded, so it may be broadcast
    texts_of = pick(docs, ("doc_id", "bigint"), ("text", "string")).where(
        F.col("text").isNotNull() & (F.char_length("text") <= CHARS)
    )
    return texts_of.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", F.xxhash64("text")).limit(
        2 * (toxic + clean)
    )


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> Network | None:
    """Fit the network on labelled rows whose crc32(doc_id) mod 3 is not 1."""
    got = sample_documents(docs, labels, toxic, clean).toPandas()
    return fit([np.frombuffer(t.encode(), np.uint8) for t in got["text"]], got["toxic"].to_numpy(int))


def score_toxicity(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text).

    Null and empty texts are one window without words.  Without a network
    (labels of one kind only) every score is 0.  Repeated rows and null ids
    each get a score; an empty table gives no rows.
    """
    rows = pick(docs, ("doc_id", "bigint"), ("text", "string"))
    if net is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = texts(batch.column(1))
            parts = list(_scores(shared.value, raw, at))
            values = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id bigint, score double")


def op9_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train(docs, table(spark, sf_dir, "labels"))
    predicted: Column = (F.col("score") >= FLAG).cast("int")
    return score_toxicity(docs, net).select(
        "doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted")
    )
