"""Collocations against plain Python; the parse owns every phrase once; exact arithmetic; edge rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from adfuse.llm import collocations as C
from edge import edge_rows, frame

KINDS = "lang string, text string"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def counted(rows, longest=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    return f, n


def expected(rows, least, top, cover=80):
    f, n = counted(rows)
    out = []
    for lang in n:
        many = {p: a for (x, p), a in f.items() if x == lang and len(p) > 1 and a >= least}
        hidden = set()
        for p, a in many.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= cover * many[p[i:j]]:
                        hidden.add(p[i:j])
        found = []
        for p, a in many.items():
            cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            if p not in hidden:
                found.append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed=1, docs=60):
    r = random.Random(seed)
    vocabulary = ["a", "b", "The", "the", "éß", "日本", "x y", "-", "q"]
    line = " ".join(r.choices(vocabulary, k=60))
    rows = []
    for _ in range(docs):
        text = r.choice(["", line + ". "]) + "".join(
            r.choice(vocabulary) + r.choice([" ", " ", " ", "\t ", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(r.randint(0, 80))
        )
        rows.append((r.choice(["en", "en", "und", None, ""]), text))
    return rows + [("en", None), (None, ""), ("de", " \t.,"), ("en", "a " * 500), ("en", "z" * 70_000 + " end")] + rows[:9]


@pytest.mark.parametrize("every", [1, 5, 10**9])
def test_against_plain_python(spark, every):
    rows = corpus()
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    got = C.collocations(df, least=4, top=25, every=every).collect()
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in names) for r in got) == expected(rows, 4, 25)


@pytest.mark.parametrize("every", [2, 32])
def test_each_phrase_of_a_text_has_one_owner(every):
    r = random.Random(every)
    texts = [" ".join(r.choices("abcdefgh", k=r.randint(0, 300))) + r.choice(["", ". a b c", "\n\n"]) for _ in range(80)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    seen, chunks = Counter(), 0
    for out in C._parse(iter([batch]), 4, every):
        for row in out.to_pylist():
            words = row["chunk"].split(" ")[:-1]
            chunks += row["times"]
            for i in range(row["own"]):
                seen.update({tuple(words[i : i + k]): row["times"] for k in range(1, 5) if i + k <= len(words)})
    assert {k[1]: v for k, v in counted([("en", t) for t in texts])[0].items()} == seen
    assert chunks > 2 * len(texts) / every


def test_equal_passages_are_equal_chunks():
    r = random.Random(4)
    passage = " ".join("".join(r.choices("abcdef", k=5)) for _ in range(2000))
    texts = [f"{k} lead {k * 7} " + passage + f" tail {k}" for k in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array(texts)], ["lang", "text"])
    rows = [row for out in C._parse(iter([batch]), 4, 32) for row in out.to_pylist()]
    assert sum(len(x["chunk"]) for x in rows) < 4 * len(passage)  # not 50 times
    assert max(x["times"] for x in rows) == 50


def test_blocks_and_copies_of_any_size_agree(monkeypatch):
    rows = corpus(3)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([x or "und" for x, _ in rows]), pa.array([t or "" for _, t in rows])], ["lang", "text"]
    )

    def parsed():
        out = Counter()
        for b in C._parse(iter([batch.slice(0, 20), batch.slice(20)]), 4, 6):
            for x in b.to_pylist():
                out[x["lang"], x["chunk"], x["own"]] += x["times"]
        return out

    want = parsed()
    for block, copy in ((1, 1), (500, 64), (10**9, 10**9)):
        monkeypatch.setattr(C, "BLOCK", block)
        monkeypatch.setattr(C, "COPY", copy)
        assert parsed() == want


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    rows = [("x", "a b", 2, big - 1), ("x", "a", 1, big), ("x", "b", 1, big), ("y", "a b", 2, 30), ("y", "a", 1, 31), ("y", "b", 1, 77)]
    got = C.ranked(spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")).collect()
    assert {(r.lang, r.score) for r in got} == {("x", 2000000 * (big - 1) // (2 * big)), ("y", 2000000 * 30 // 108)}


def test_longer_phrases_hide_shorter_ones_even_if_hidden_themselves(spark):
    f = {"a": 900, "b": 900, "c": 900, "d": 900, "a b": 125, "b c": 101, "c d": 100, "a b c": 100, "b c d": 81, "a b c d": 80}
    rows = [("x", p, len(p.split()), n) for p, n in f.items()]
    got = C.ranked(spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")).collect()
    # 100*80 >= 80*100 hides "a b c", which still hides "a b" (100*100 >= 80*125); 8100 >= 8080 hides "b c".
    assert {r.phrase for r in got} == {"a b c d"}
    f["a b"] = 126
    rows = [("x", p, len(p.split()), n) for p, n in f.items()]
    got = C.ranked(spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")).collect()
    assert {r.phrase for r in got} == {"a b c d", "a b"}


def test_ties_and_ranks_go_by_bytes(spark):
    rows = [("x", w, 1, 50) for w in "aAéz日"] + [("x", f"{w} a", 2, 40) for w in "aAéz日"]
    got = C.ranked(spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint"), top=4).collect()
    assert [r.phrase for r in sorted(got, key=lambda r: r["rank"])] == ["A a", "a a", "z a", "é a"]


def test_edge_tables(spark):
    rows = frame(spark, [("en", t) for _, t in edge_rows()], kinds=KINDS).withColumnRenamed("size", "phrase")
    got = C.collocations(rows, least=3)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = expected([("en", t) for _, t in edge_rows()], 3, 2000)
    assert sorted(map(tuple, got.collect())) == want and want
    assert C.collocations(rows.limit(0)).collect() == []


def test_marks_never_stop_a_frequent_phrase(spark, monkeypatch):
    rows = corpus(9)
    df = spark.createDataFrame(rows, KINDS)
    monkeypatch.setattr(C, "BITS", 64)  # all bits are set: nothing is pruned
    got = C.collocations(df, least=4, top=25).collect()
    assert len(got) == len(expected(rows, 4, 25))
    assert np.unpackbits(C._marked(C.frozen(C.dictionary(df), "t"), 4)).mean() > 0.5
