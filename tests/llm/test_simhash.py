import hashlib
import math
import random
import re

import numpy as np
import pytest
from adfuse.llm import simhash as S
from edge import as_rows, edge_rows, empty, frame
from pyspark.sql import functions as F

xxhash = pytest.importorskip("xxhash")


SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(chr(c) for c in range(0x2000, 0x200B))


def terms(text):
    out = []
    for word in re.split(f"[{SPACES}]+", text.strip(SPACES)):
        out += [word] if len(word) <= 24 else [word[i : i + 4] for i in range(len(word) - 3)]
    return out


def brute(text):
    votes, total = np.zeros(128), 0
    for term in terms(text):
        h = xxhash.xxh64_intdigest(term.encode(), 42)
        h = (h, xxhash.xxh64_intdigest((1).to_bytes(4, "little"), h))
        w = min(S.HEAVY, max(1, 2 * len(term) - 5))
        total += w
        votes += [w * (h[k // 64] >> k % 64 & 1) for k in range(128)]
    return "".join(f"{sum(1 << k for k in range(64) if 2 * votes[64 * z + k] > total):016x}" for z in (0, 1))


def likeness(a, b):
    return max(0.0, math.cos(math.pi / 128 * (int(a, 16) ^ int(b, 16)).bit_count()))


def key(row):
    return (row[0] is not None, row[0] or 0)


def expected(rows):
    """Rows in id order (ties: by the hash Spark gives the text), each with its edited text."""
    texts = [t or "" for _, t in rows]
    order = sorted(
        range(len(rows)),
        key=lambda k: (key(rows[k]), np.uint64(xxhash.xxh64_intdigest(texts[k].encode(), 42)).astype(np.int64)),
    )
    prints = [brute(t) for t in texts]
    out = []
    for at, k in enumerate(order):
        nxt = order[(at + 1) % len(order)]
        q = len(texts[k]) // 4
        edited = texts[k][: len(texts[k]) - q] + texts[nxt][:q]
        new = brute(edited)
        out.append(
            (rows[k][0], len(texts[k]), hashlib.sha256(edited.encode()).hexdigest(), prints[k], new,
             round(likeness(prints[k], new), 9), round(likeness(prints[k], prints[nxt]), 9))
        )
    return sorted(out, key=str)


def got(df):
    return sorted(((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()), key=str)


def test_edge_rows(spark):
    rows = edge_rows()
    assert got(S.edit_likeness(frame(spark, rows))) == expected(rows)


def test_order_over_sparse_and_negative_ids(spark):
    r = random.Random(3)
    rows = [(r.choice([-1, 1]) * r.randrange(10**k), f"text {k} of {r.random()} " * (k % 7)) for k in range(1, 16) for _ in range(6)]
    rows += [(2**62 + k, f"far {k}") for k in (-1, 0, 1, 255, 256, 257)] + [(-(2**63), "first"), (2**63 - 1, "last")]
    rows += [(256 * k + d, f"edge {k} {d}") for k in range(40) for d in (-1, 0, 1)]
    rows = list({a: (a, b) for a, b in rows}.values())
    assert got(S.edit_likeness(frame(spark, rows))) == expected(rows)


def test_one_row_follows_itself_and_none_is_fine(spark):
    assert got(S.edit_likeness(frame(spark, [(5, "just one text here")]))) == expected([(5, "just one text here")])
    assert S.edit_likeness(empty(spark)).count() == 0


def test_texts_of_any_separator_and_script_keep_their_likeness(spark):
    r = random.Random(8)
    latin = ["".join(r.choices("abcdefghiklmnoprstu", k=r.randint(2, 9))) for _ in range(3000)]
    cjk = [chr(r.randrange(0x4E00, 0x5E00)) for _ in range(900)]
    texts, shapes = {}, ["blanks", "lines", "tabs", "wide blanks", "cjk", "one long word"]
    for k in range(40):
        words = r.choices(latin, k=300)
        for n, text in enumerate(
            [" ".join(words), "\n".join(words), "\t".join(words), "\u3000".join(words), "".join(r.choices(cjk, k=800)), "".join(words)]
        ):
            texts[1000 * n + k] = text
    rows = S.edit_likeness(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    for n, shape in enumerate(shapes):
        part = [x for x in rows if x.doc_id // 1000 == n and x.doc_id % 1000 < 39]  # the last one borrows from another shape
        near, apart = (np.mean([x[c] for x in part]) for c in ("near_edited", "near_next"))
        assert near > 0.6 and apart < near - 0.3, (shape, near, apart)
        assert all(x.fingerprint == brute(texts[x.doc_id]) for x in part[:3])


def test_long_runs_of_votes(spark):
    text = "loweischaft " * 9000
    (row,) = S.fingerprints(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t").select(
        S.as_text("fp1", "fp2").alias("f")
    ).collect()
    assert row.f == brute(text)


def test_radius_finds_all(spark):
    r = random.Random(2)
    base = [r.getrandbits(128) for _ in range(30)]
    values = [b ^ sum(1 << k for k in r.sample(range(128), d)) for b in base for d in (0, 0, 1, 2, 3, 3, 4, 5)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v >> 64), signed(v & (1 << 64) - 1)) for v in values], "fp1 bigint, fp2 bigint")
    for radius in (1, 3):
        near = S.within_radius(df, df, radius).select(S.as_text("fp1", "fp2"), "n_within")
        want = {f"{a:032x}": sum((a ^ b).bit_count() <= radius for b in values) for a in values}
        assert {a: n for a, n in as_rows(near)} == want


def test_windows_stay_small_and_no_python(spark):
    docs = frame(spark, [(k, f"t{k}") for k in range(2000)], extra=False)
    most = S.with_next(docs).groupBy("stretch").count().agg(F.max("count")).first()[0]
    assert most <= 2**S.STRETCH
    plan = S.edit_likeness(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
