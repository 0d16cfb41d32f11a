import hashlib
import zlib

import pytest
from adfuse.llm import chat as C
from adfuse.llm import sharding as H
from edge import as_rows, edge_rows, empty, frame
from pyspark.sql import functions as F

KINDS = "conv_id bigint, turn bigint, role string, text string"
TRICKY = ["\\", "\\l", "\\\\e\\g", "</turn>\n", "<turn assistant>x</turn>\n", "a>b<c", "\\</turn>", "", "é🙂\n"]


def conversations():
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "last word")]
    rows += [(2, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(TRICKY)]
    rows += [(3, 0, "user", None), (3, 1, None, "x"), (3, None, "assistant", "before all")]
    rows += [(4, 1, "assistant", "twice"), (4, 1, "assistant", "twice"), (4, 1, "assistant", "tie")]
    rows += [(None, 0, "assistant", "no id"), (5, 0, "user", "no answer"), (6, 0, "as>sis<tant", "odd role")]
    rows += [(7, k, "assistant" if k % 2 else "user", "w" * 3000) for k in range(40)]
    return rows


def ordered(rows, conv):
    own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
    return sorted(own, key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))


def test_read_back_is_exact(spark):
    rows = conversations()
    out = C.read_back(C.format_chat(frame(spark, rows, kinds=KINDS))).collect()
    assert len(out) == len({r[0] for r in rows})
    for r in out:
        turns = ordered(rows, r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in turns]
        assert r.loss == "".join(x for _, role, x in turns if role == "assistant")
    assert C.read_back(C.format_chat(empty(spark, KINDS))).count() == 0


def test_examples(spark):
    rows = conversations()
    examples = C.format_chat(frame(spark, rows, kinds=KINDS)).collect()
    for conv in {r[0] for r in rows}:
        turns = ordered(rows, conv)
        own = sorted((e for e in examples if e.conv_id == conv), key=lambda e: e.example)
        replies = [k for k, t in enumerate(turns) if t[1] == "assistant"]
        ends = sorted({*replies, len(turns) - 1})
        assert [e.text.count(C.CLOSE) for e in own] == [k + 1 for k in ends]  # all turns up to the reply
        for e, k in zip(own, ends, strict=True):
            loss = e.text[e.loss_start : e.loss_end]
            assert ("<" not in loss and ">" not in loss) and (len(loss) > 0) == (
                turns[k][1] == "assistant" and turns[k][2] != ""
            )


@pytest.mark.parametrize("text", TRICKY)
def test_escape_round_trip(spark, text):
    (r,) = spark.createDataFrame([(text,)], "t string").select(
        C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u")
    ).collect()
    assert r.u == text and "<" not in r.e and ">" not in r.e


def test_shards(spark):
    rows = edge_rows() + [(100 + k, "copy") for k in range(400)] + [(1000 + k, f"text {k} " * 9) for k in range(2000)]
    rows += [(5000, "same row")] * 7
    got = H.shard(frame(spark, rows), shards=8, snap=0.05).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=str
    )
    total = sum(r.size for r in got)
    largest = max(r.size for r in got)
    for s in range(8):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 8) <= 2 * 0.05 * total / 8 + largest
    # Equal texts stand in one order: a group is cut only where it is too large to move.
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"same row")}) == 1
    assert H.shard(empty(spark)).count() == 0


def test_one_huge_group_is_cut(spark):
    rows = [(k, "the same text") for k in range(1600)]
    got = H.shard(frame(spark, rows, extra=False), shards=16).groupBy("shard").count().collect()
    assert {r["count"] for r in got} == {100}


def test_order_is_by_digest_then_id(spark):
    rows = [(k % 50, f"t{k % 7}") for k in range(300)]
    got = H.shard(frame(spark, rows, extra=False), shards=4).collect()
    by = {(d, zlib.crc32(t.encode())): hashlib.md5(t.encode()).digest() for d, t in rows}
    order = [(by[r.doc_id, r.text_crc32], r.doc_id) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order) and as_rows(H.shard(frame(spark, rows, extra=False), shards=4)) == sorted(
        map(tuple, got), key=str
    )
