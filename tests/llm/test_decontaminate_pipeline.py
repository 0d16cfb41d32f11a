import hashlib
import re

import corpus_pipeline as P
import pytest
from adfuse.llm import decontaminate as D
from adfuse.llm.license_scan import WORD
from adfuse.llm.secret_scan import secret_hits
from edge import as_rows, edge_rows, empty, frame

ITEMS = "item_id bigint, text string"
LABELS = "doc_id bigint, quality int, toxic int"


def fold(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, width=10):
    out = []
    for doc_id, text in rows:
        words, hit, found = fold(text), set(), set()
        for item, item_text in items:
            own = fold(item_text)
            n = min(width, len(own))
            grams = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
            for k in range(len(words) - n + 1) if n else ():
                if tuple(words[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    found.add(item)
        ids = sorted(str(i) for i in found if i is not None)
        out.append(
            (doc_id, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))
        )
    return sorted(out, key=str)


def cases():
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(1, item), (10, item.upper()), (2, "short item, here"), (3, None), (4, ""), (None, "no id " * 6), (5, "!!")]
    items += [(9, "x y " * 10), (2, "another text under the same id, which is long enough to have two windows")]
    words = item.split()
    rows = edge_rows() + [
        (30, "before " + item + " after"),
        (31, " ".join(words[:9]) + " nine are no window"),
        (32, "-".join(words[1:11])),
        (33, "a SHORT: item (here) and short item there"),
        (34, "x y " * 300),
        (35, "no id no id no id no id no id"),
        (36, (item + " ") * 3),
    ]
    return rows, items


@pytest.mark.parametrize("limit", [D.BROADCAST_WORDS, 3])
def test_both_ways_equal_brute_force(spark, limit):
    rows, items = cases()
    got = as_rows(D.find_contamination(frame(spark, rows), frame(spark, items, kinds=ITEMS), limit=limit))
    assert got == brute(rows, items)


def test_empty_tables(spark):
    rows, items = cases()
    bench, none = frame(spark, items, kinds=ITEMS), empty(spark, ITEMS)
    assert D.find_contamination(empty(spark), bench).count() == 0
    assert D.find_contamination(empty(spark), bench, limit=3).count() == 0
    assert D.find_contamination(frame(spark, rows), none).where("contaminated").count() == 0
    assert D.decontaminate(frame(spark, rows), none).count() == len(rows)


@pytest.mark.parametrize("limit", [D.BROADCAST_WORDS, 40])
def test_removal(spark, limit):
    rows, items = cases()
    docs, bench = frame(spark, rows), frame(spark, items, kinds=ITEMS)
    clean = {r[0] for r in brute(rows, items) if not r[5]}
    out = D.decontaminate(docs, bench, limit=limit)
    assert out.columns == docs.columns
    assert as_rows(out.select("doc_id", "text")) == sorted(((d, t) for d, t in rows if d in clean), key=str)
    spans = D.decontaminate(docs, bench, "spans", limit=limit)
    assert spans.count() == len(rows)
    left = {r.doc_id: r.text for r in spans.collect() if r.doc_id and r.doc_id >= 30}
    assert left[30] == "before after" and left[31].startswith("Alpha") and left[33].startswith("a) and short")


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_a_large_benchmark_gives_the_same(spark, remove):
    """Few but long words, and a hot item: more bytes than the limit allows, far fewer words."""
    rows, items = cases()
    items = items + [(50 + k, "語" * 400 + str(k)) for k in range(4)] + [(60, "copied item text")] * 50
    rows = rows + [(40, "a " + "語" * 400 + "2 b"), (40, "語" * 400), (41, "Copied-item text and copied item text. Copied"), (None, "copied item text")]
    docs, bench = frame(spark, rows), frame(spark, items, kinds=ITEMS)
    assert D.small_windows(bench, D.WIDTH, 40) is None
    want = as_rows(D.decontaminate(docs, bench, remove).select("doc_id", "text"))
    out = D.decontaminate(docs, bench, remove, limit=40)
    assert out.columns == docs.columns and as_rows(out.select("doc_id", "text")) == want
    few = frame(spark, [(k, "語" * 400 + str(k)) for k in range(9)], kinds=ITEMS)  # 9 words, 10,800 bytes
    got = as_rows(D.decontaminate(docs, few, remove, limit=90).select("doc_id", "text"))
    assert got == as_rows(D.decontaminate(docs, few, remove).select("doc_id", "text"))


def test_collisions_are_confirmed(spark, monkeypatch):
    """With every window in one bucket of equal hashes, only equal words hit."""
    import numpy as np

    rows, items = cases()
    monkeypatch.setattr(D, "windows", lambda h, n: np.zeros(max(len(h) - n + 1, 0), np.uint64))
    known = D.WindowSet(items, 10)
    for text in ("before " + items[0][1] + " after", "something else " * 20):
        n, places, found, _, _ = known.scan(np.frombuffer(text.encode(), np.uint8))
        ((_, want_n, hit, _, _, _),) = brute([(1, text)], items)
        assert n == want_n and sum(b - a for a, b in D.merged(places)) == hit


SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    ids = {r.doc_id for r in docs.collect()}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for name, stage in P.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, SF)
        after = docs.collect()
        assert docs.columns == names and len({r.doc_id for r in after}) == len(after)
        assert {r.doc_id for r in after} <= {r.doc_id for r in before} <= ids
        docs = spark.createDataFrame(after, docs.schema)
    assert 0 < len(after) < len(ids)
    assert not any(secret_hits(r.text)[1] for r in after)
    assert D.find_contamination(docs, bench).where("contaminated").count() == 0
    pieces = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in after}
    assert sorted(map(str, P.run(spark, SF).collect())) != []


def test_stages_take_edge_rows(spark):
    for rows in (edge_rows(), []):
        docs = frame(spark, rows) if rows else empty(spark)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert name == "pack" or out.columns == docs.columns
            out.count()
