import random
import re

import numpy as np
from adfuse.llm import near_dedup as N
from adfuse.llm.graph import components
from edge import as_rows, edge_rows, empty, frame


def word_set(text, width):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", fold)
    n = min(width, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def brute(rows, width, percent=80):
    """Union-find over all pairs of rows."""
    sets = [word_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(k)] = min(low.get(find(k), doc_id), doc_id)
    return sorted(
        ((d, len(sets[k]), low.get(find(k)), d == low.get(find(k))) for k, (d, _) in enumerate(rows)), key=str
    )


def near_group(r, n, size=80, edits=(0, 25)):
    base = [f"w{r.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randint(*edits)):
            words[r.randrange(size)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_edge_rows(spark):
    rows = edge_rows()
    assert as_rows(N.near_duplicates(frame(spark, rows), width=4)) == brute(rows, 4)
    assert N.near_duplicates(empty(spark)).count() == 0


def test_groups_of_near_copies(spark, monkeypatch):
    """Small tiles, so that the star step and the tiles of the unlinked run as well."""
    monkeypatch.setattr(N, "TILE", 16)
    r = random.Random(11)
    texts = near_group(r, 120) + near_group(r, 10) + [t for t in near_group(r, 5, edits=(0, 2)) for _ in range(6)]
    texts += [" ".join(f"u{r.randrange(10**6)}" for _ in range(40)) for _ in range(30)]
    r.shuffle(texts)
    rows = [(k * 3 + 1, t) for k, t in enumerate(texts)]
    got = as_rows(N.near_duplicates(frame(spark, rows, extra=False), width=4))
    want = brute(rows, 4)
    assert got == want
    assert len({c for _, _, c, _ in want}) < len(rows) - 40  # there is something to find


def test_borderline_similarity_is_exact(spark):
    words = [f"w{k}" for k in range(45)]
    for cut in range(30, 45):
        rows = [(1, " ".join(words)), (2, " ".join(words[:cut]))]
        common, union = cut - 3, 42
        want = 100 * common >= 80 * union
        got = list(N.linked_pairs(*[[N.shingles(np.frombuffer(t.encode(), np.uint8), 4)] for _, t in rows], 80))
        assert (len(got[0][1]) == 1) == want
    assert as_rows(N.near_duplicates(frame(spark, rows), width=4)) == brute(rows, 4)


def test_every_coordinate_fills():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 3, 50, 5000)]
    out = N.sketches(sets, 64)
    assert (out != np.iinfo(np.uint64).max).all()
    a = r.integers(0, 2**63, 4000, dtype=np.uint64)
    left, right = N.sketches([a[:3000], a[1000:]], 2048)
    assert abs((left == right).mean() - 0.5) < 0.05  # similarity 2000 / 4000


def test_deduplicate(spark):
    r = random.Random(12)
    rows = edge_rows() + [(100 + k, t) for k, t in enumerate(near_group(r, 12, edits=(0, 2)))]
    docs = frame(spark, rows)
    out = N.deduplicate(docs, width=4)
    assert out.columns == docs.columns
    kept = as_rows(out.select("doc_id", "text"))
    sets = [word_set(t, 4) for _, t in rows]
    blank = sorted(((d, t) for (d, t), s in zip(rows, sets, strict=True) if not s), key=str)
    assert [x for x in kept if not word_set(x[1], 4)] == blank  # empty texts are linked with nothing
    components_of = {r[2] for r in brute(rows, 4) if r[1]}
    full = [x for x in kept if word_set(x[1], 4)]
    assert len(full) == len(components_of)
    assert len({d for d, _ in full}) == len(full)
    assert N.deduplicate(empty(spark)).count() == 0


def test_components_of_long_chains(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(200, 100), (100, 150), (300, 300)]
    got = dict(as_rows(components(spark.createDataFrame(chain, "a bigint, b bigint"))))
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 150: 100, 200: 100}
    star = spark.range(1, 3000).selectExpr("id as a", "0L as b")
    assert {r[1] for r in as_rows(components(star))} == {0}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
