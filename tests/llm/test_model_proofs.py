"""The classifiers' whole way from text to score, worked out a second time; what the network adds to its start."""

import math
import re
import zlib

import numpy as np
import pytest
from adfuse.llm import quality_rules as Q
from adfuse.llm import toxicity as T
from adfuse.llm.bytes_kernel import ALNUM, word_hashes
from edge import edge_rows, frame

SMALL, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


# --- quality ------------------------------------------------------------------------
def statistics(text):
    """The thirteen statistics of a text, in plain Python."""
    t = text or ""
    n, words, lines = len(t), t.split(" "), t.split("\n")
    share = lambda chars: sum(c in chars for c in t) / max(n, 1)
    return {
        "log_chars": math.log1p(n),
        "word_chars": n / len(words),
        "line_chars": math.log1p(n / len(lines)),
        "distinct_words": len(set(words)) / len(words),
        "distinct_lines": len(set(lines)) / len(lines),
        "lower": share("etaoinsrhl"),
        "upper": sum("A" <= c <= "Z" for c in t) / max(n, 1),
        "digits": share("0123456789"),
        "stops": share(".,;:!?"),
        "hashes": share("#$%&*@^~"),
        "bars": share("|<>{}[]\\/_=+"),
        "quotes": share("\"'`()-"),
        "wide": (len(t.encode()) - n) / max(n, 1),
    }


def quality_score(model, s):
    total = model.bias
    for rule, w in model.rules:
        total += w * all((s[name] > cut) if above else (s[name] <= cut) for name, above, cut in rule.terms)
    for name, low, high, w in model.linear:
        total += w * min(max(s[name], low), high)
    return 1 / (1 + math.exp(-total))


def test_quality_of_whole_texts(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = Q.train(docs, labels)
    assert len(model.rules) > 5
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [
        (10**6 + k, t) for k, (_, t) in enumerate(edge_rows())
    ]
    rows += [(2 * 10**6, "a\n\nb  c\n"), (2 * 10**6 + 1, "🙂 {x} 'y'"), (2 * 10**6 + 2, "\n" * 50)]
    df = frame(spark, rows)
    named = [c.alias(k) for k, c in Q.statistics(df["text"]).items()]
    got = {r.doc_id: r for r in df.select("doc_id", *named).collect()}
    scores = {r.doc_id: r.score for r in Q.score_quality(df, model).collect()}
    for i, text in rows:
        want = statistics(text)
        assert set(want) == set(Q.NAMES)
        for k, v in want.items():
            assert abs(got[i][k] - v) < 1e-9, (i, k)
        assert abs(scores[i] - quality_score(model, want)) < 1e-9
    kept = {r.doc_id for r in Q.keep_good(df, labels).collect()}
    again = Q.train(df, labels)
    assert kept == {i for i, t in rows if quality_score(again, statistics(t)) >= Q.ACCEPT}


# --- toxicity -----------------------------------------------------------------------
MASK = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def word_vector(net, word):
    """Sum of the embeddings of a word and of its 4-grams (with a mark at either end), over the root of their number."""
    raw = word.encode()
    marked = [0, *raw, 0, 0]
    rows = [T.GRAMS + int(word_hashes(np.frombuffer(raw, np.uint8), ALNUM)[0][0]) % T.WORDS]
    for k in range(len(raw)):
        gram = 0
        for byte in (marked + [0])[k : k + 4]:
            gram = gram * 257 + byte
        rows.append(mix(gram & MASK) % T.GRAMS)
    return net.table[rows].astype(float).sum(axis=0) / math.sqrt(len(rows))


def sigmoid(v):
    return 1 / (1 + np.exp(-v))


def window_logit(net, vectors):
    h3, states = T.HIDDEN, []
    for d in (0, 1):
        h, seen = np.zeros(h3), []
        for x in vectors if d == 0 else vectors[::-1]:
            p, q = x @ net.wx[d].astype(float) + net.bias[d], h @ net.u[d].astype(float)
            z, r = sigmoid(p[:h3] + q[:h3]), sigmoid(p[h3 : 2 * h3] + q[h3 : 2 * h3])
            h = (1 - z) * np.tanh(p[2 * h3 :] + r * q[2 * h3 :]) + z * h
            seen.append(h)
        states.append(seen if d == 0 else seen[::-1])
    if not vectors:
        return float(net.out_bias[0])
    both = [np.concatenate(s) for s in zip(*states, strict=True)]
    weight = np.exp([s @ net.attend for s in both])
    return float(sum(w * s for w, s in zip(weight, both, strict=True)) / weight.sum() @ net.out + net.out_bias[0])


def toxicity_score(net, text):
    """The worst of all windows of a whole text."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    vectors = [word_vector(net, w) for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
    starts = range(0, max(len(vectors) - (T.WIDTH - T.STRIDE), 1), T.STRIDE)
    worst = max(window_logit(net, vectors[s : s + T.WIDTH]) for s in starts)
    return 1 / (1 + math.exp(-(net.scale * worst + net.shift)))


@pytest.fixture(scope="module")
def net(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    return T.train(docs, labels)


def test_toxicity_of_whole_texts(spark, net):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in docs] + [
        (10**6 + k, t) for k, (_, t) in enumerate(edge_rows()) if len(t or "") < 3000
    ]
    got = {r.doc_id: r.score for r in T.score_toxicity(frame(spark, rows), net).collect()}
    for i, text in rows:
        assert abs(got[i] - toxicity_score(net, text)) < 2e-3, i


def test_the_network_adds_to_the_odds_it_starts_from(spark, monkeypatch):
    """Held-out accuracy: the log-odds of the worst window alone, the whole network, and one started without log-odds."""
    docs, labels = spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/labels.parquet")
    got = T.sample_documents(docs, labels, 500, 900).toPandas()
    raw, y = [np.frombuffer(t.encode(), np.uint8) for t in got["text"]], got["toxic"].to_numpy(int)
    test = docs.join(labels, "doc_id").where("length(text) < 6000").select("doc_id", "text", "toxic").toPandas()
    test = test[[zlib.crc32(str(i).encode()) % 3 == 1 for i in test["doc_id"]]]
    test_raw, test_y = [np.frombuffer(t.encode(), np.uint8) for t in test["text"]], test["toxic"].to_numpy(int)
    assert len(test_y) > 500 and 50 < test_y.sum()

    def accuracy(model):
        worst = np.concatenate([T.Corpus(test_raw[k : k + 200]).worst(model) for k in range(0, len(test_raw), 200)])
        return ((1 / (1 + np.exp(-(model.scale * worst + model.shift))) >= T.FLAG) == test_y).mean()

    whole = accuracy(T.fit(raw, y))
    corpus, held = T.Corpus(raw), T.Corpus(test_raw)
    odds = T._log_odds(corpus, y)

    def hint(c):
        word = np.append(np.maximum.reduceat(odds[c.rows], np.cumsum(c.n) - c.n), 0)
        return np.maximum.reduceat(word[c.idx].max(axis=1), np.flatnonzero(np.diff(c.doc, prepend=-1)))

    train_hint, test_hint = hint(corpus), hint(held)
    cut = max(np.unique(train_hint), key=lambda v: ((train_hint >= v) == y).mean())
    alone = ((test_hint >= cut) == test_y).mean()
    monkeypatch.setattr(T, "_log_odds", lambda c, labels: np.zeros(T.GRAMS + T.WORDS))
    without = accuracy(T.fit(raw, y))
    print(f"log-odds alone {alone:.3f}, network {whole:.3f}, network without log-odds {without:.3f}")
    assert whole > 0.95 and whole > alone + 0.01 and without > alone
