import zlib

import numpy as np
import pytest
from adfuse.llm import packing as P
from edge import edge_rows, empty, frame

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(P.tokenizer_path())


ODD = [
    "",
    "it's DON'T I'll x's 's 'S",
    "<|endoftext|> a<|endoftext|>b",
    "İstanbul ΣΑΣ ſt ﬁ é É ŉ ŁÓDŹ",
    "a_b __x__ 12ab ½x ² a\x1cb\x1dc x\u0085w ﻿ q",
    "日本語 テスト한국어 🙂",
    "x" * 5000 + " " + "y" * 150,
]


@pytest.mark.parametrize("text", ODD)
def test_ids_are_the_tokenizer_s(tokenizer, text):
    encoder = P.Encoder(P.tokenizer_path())
    for _ in range(2):  # from the tokenizer, and from memory
        ids = np.frombuffer(encoder.ids(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_memory_of_words_is_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(P, "CACHED_WORDS", 10)
    encoder = P.Encoder(P.tokenizer_path())
    text = " ".join(f"word{'abcdefghij'[k % 10]}{'xyz'[k % 3]}!" for k in range(200))
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.words) <= 10 and len(encoder.parts) <= 10


def check(rows, got, tokenizer):
    """Every id in one piece, sequences gapless, at most the context long."""
    ids = {}
    for k, (doc_id, text) in enumerate(rows):
        ids.setdefault(doc_id, []).append(
            np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END], "<u4").tobytes()
        )
    for doc_id, texts in ids.items():
        pieces = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: (r.doc_tokens, r.start))
        assert sum(r.length for r in pieces) == sum(map(len, texts)) // 4
        for r in pieces:
            part = [t[4 * r.start : 4 * (r.start + r.length)] for t in texts if len(t) // 4 == r.doc_tokens]
            assert r.ids in [bytes(p) for p in part] and zlib.crc32(r.ids) == r.ids_crc32
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for rows_of in sequences.values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len({r.tier for r in rows_of}) == len({r.step_id for r in rows_of}) == 1
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= P.LEAST * len(sequences)


def test_edge_rows(spark, tokenizer):
    rows = [(a, b) for a, b in edge_rows()]
    got = P.pack(frame(spark, rows).coalesce(1)).collect()
    check(rows, got, tokenizer)
    assert P.pack(empty(spark)).count() == 0


def test_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    check(rows, P.pack(docs.repartition(3, "doc_id")).collect(), tokenizer)


def test_windows_are_whole_tiers_and_docs_are_rarely_cut():
    r = np.random.default_rng(1)
    packer, sizes = P.Packer(), r.integers(1, 3000, 5000).tolist()
    for k, n in enumerate(sizes):
        packer.add(k, n)
    packer.finish()
    seen = {}
    for tier, pieces in packer.windows:
        total = sum(p.length for p in pieces)
        assert total == tier or tier == 2048 and total > 2048 - P.LEAST
        for p in pieces:
            seen.setdefault(p.doc, []).append((p.start, p.length))
    for k, n in enumerate(sizes):
        at = 0
        for start, length in sorted(seen[k]):
            assert start == at
            at += length
        assert at == n
    whole = sum(len(v) == 1 for k, v in seen.items() if sizes[k] <= 2048)
    assert whole > 0.6 * sum(n <= 2048 for n in sizes)


def test_step_groups_are_balanced():
    windows = [(2048, [P.Piece(0, 0, 2048)] if k % 3 else [P.Piece(0, 0, 64)] * 32) for k in range(160)]
    steps = P.step_groups(windows, 16 * 2048)
    cost = np.bincount(steps, [sum(p.length**2 for p in w[1]) for w in windows])
    assert len(cost) == 10 and set(np.bincount(steps)) == {16}
    assert cost.max() < 1.2 * cost.min()


def test_bad_tiers(spark):
    with pytest.raises(ValueError):
        P.pack(empty(spark), tiers=(300, 2048))
