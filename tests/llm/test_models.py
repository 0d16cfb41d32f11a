import zlib

import numpy as np
import pytest
from adfuse.llm import quality_rules as Q
from adfuse.llm import toxicity as T
from edge import as_rows, edge_rows, empty, frame
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def held(doc_id, of, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % of == value


def accuracy(rows, labels, column):
    marks = {r.doc_id: r[column] for r in labels.collect()}
    return np.mean([(r.predicted == marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks])


def test_quality_holds_on_held_out_rows(spark):
    rows = Q.op7_quality(spark, SF).collect()
    assert len(rows) == 1000
    assert all(r.held_out == held(r.doc_id, 4, 2) and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, spark.read.parquet(f"{SF}/labels.parquet"), "quality") > 0.95


def test_quality_learns_only_its_fold_and_only_the_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn(
        "quality", F.when(Q._fold(4) == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert Q.train(docs, labels) == Q.train(docs.withColumn("source", F.lit("z")), flipped)


def test_compiled_rules_equal_their_python(spark):
    r = np.random.default_rng(3)
    x = r.random((600, len(Q.NAMES)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.6) | (x[:, 9] > 0.9)).astype(int)
    model = Q.fit(x, y)
    df = spark.createDataFrame(x.tolist(), list(Q.NAMES)).select(model.score().alias("s"), *Q.NAMES)
    total = np.full(len(x), model.bias)
    for rule, w in model.rules:
        total += w * rule.holds(x, Q.NAMES)
    for name, low, high, w in model.linear:
        total += w * np.clip(x[:, Q.NAMES.index(name)], low, high)
    want = {round(v[0], 12): 1 / (1 + np.exp(-t)) for v, t in zip(x, total, strict=True)}
    got = {round(r[Q.NAMES[0]], 12): r.s for r in df.collect()}
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    assert (((1 / (1 + np.exp(-total))) > 0.5) == y).mean() > 0.97
    assert 0 < len(model.rules) < len(Q.grow_rules(x, y, Q.NAMES))  # the penalty drops rules


def test_quality_edges(spark):
    docs = frame(spark, edge_rows())
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, 1), (9, None, None), (1, 0, 0), (8, 0, 0)], LABELS)
    model = Q.train(docs, labels)
    assert Q.score_quality(docs, model).where("score between 0 and 1").count() == docs.count()
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    none = spark.createDataFrame([], LABELS)
    assert as_rows(Q.keep_good(docs, none)) == as_rows(docs)  # nothing known, nothing dropped
    assert not Q.train(docs, none).fitted and Q.score_quality(docs, Q.train(docs, none)).count() == docs.count()
    assert Q.keep_good(empty(spark), labels).count() == 0
    plan = Q.score_quality(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return T.train(docs, labels)


def test_toxicity_finds_toxic_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = T.op9_toxicity(spark, SF).collect()
    assert len(rows) == 1000
    assert all(r.held_out == held(r.doc_id, 3, 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    assert accuracy(rows, labels, "toxic") > 0.9


def test_all_windows_count(trained):
    clean = ("the and of with " * 400).split()
    bad = "worthless pathetic idiot stupid moron trash clown scum".split()
    score = lambda words: next(T._scores(trained, *column([" ".join(words)])))[0]

    def column(texts_of):
        raw = [t.encode() for t in texts_of]
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])

    assert score(clean) < 0.5
    for at in (0, 7, 801, len(clean)):  # wherever it stands
        assert score(clean[:at] + bad + clean[at:]) > 0.7


def test_long_texts_in_stretches_are_the_same(trained, monkeypatch):
    r = np.random.default_rng(1)
    words = [w for w in "the and of idiot trash with this tion ereth scum".split()]
    text = " ".join(r.choice(words, 5000, p=[0.19, 0.2, 0.2, 0.001, 0.001, 0.2, 0.1, 0.05, 0.057, 0.001])).encode()
    raw, at = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = next(T._scores(trained, raw, at))
    monkeypatch.setattr(T, "BLOCK", 96)
    assert np.allclose(next(T._scores(trained, raw, at)), whole, atol=1e-5)


def test_gradients():
    """Backward pass against finite differences, with padding."""
    r = np.random.default_rng(0)
    net = T.Network.fresh(1)
    for name in ("attend", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.wx, net.bias, net.u = ([p.astype(np.float64) for p in ps] for ps in (net.wx, net.bias, net.u))
    x = r.standard_normal((9, T.DIM)) * 0.5
    idx = r.integers(0, 9, (5, T.WIDTH))
    real = np.ones(idx.shape, bool)
    real[0, 6:], real[1, 1:] = False, False
    idx[~real] = 9
    y, weight = np.array([1, 0, 1, 0, 1.0]), np.array([1, 2, 1, 1, 0.5])

    def loss():
        z = net.forward(net.inputs(x), idx, real).astype(float)
        return float((weight * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)).mean())

    grads, d_x = net.backward(x, net.inputs(x), idx, real, y, weight)
    for p, g in [*zip(net.dense(), grads, strict=True), (x, d_x)]:
        flat, slope = p.reshape(-1), np.asarray(g).reshape(-1)
        for k in r.choice(len(flat), min(4, len(flat)), replace=False):
            was, step = flat[k], 1e-2
            flat[k] = was + step
            up = loss()
            flat[k] = was - step
            down = loss()
            flat[k] = was
            assert abs((up - down) / (2 * step) - slope[k]) < 2e-3


def test_toxicity_edges(spark, trained):
    docs = frame(spark, edge_rows())
    got = T.score_toxicity(docs, trained).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert T.score_toxicity(empty(spark), trained).count() == 0
    none = T.train(docs, spark.createDataFrame([(1, 1, 0)], LABELS))
    assert none is None and {r.score for r in T.score_toxicity(docs, none).collect()} == {0.0}


def test_window_starts_cover_every_word():
    for n in range(0, 70):
        seen = {w for s in T.window_starts(n) for w in range(s, s + T.WIDTH)}
        assert seen >= set(range(n))
