"""Benchmark decontamination by a broadcast set of normalised word windows.

A window is ``width`` consecutive words of a benchmark item (an item with
fewer words is one window).  The windows' hashes go to every executor; a task
hashes the word windows of its documents over raw bytes, looks them up, and
confirms every hit word by word.  Documents are neither shuffled nor joined.

The broadcast is behind a check of its size: a benchmark of more than
``limit`` words takes the other way, a shuffled join of the windows
themselves, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.llm.bytes_kernel import ALNUM, LOWER, texts, windows, word_hashes
from adfuse.llm.license_scan import WORD
from adfuse.llm.tables import fold_case, frozen, pick, table, with_texts

#: Words of a window.
WIDTH = 10
#: A benchmark of more words than this is joined, not broadcast (some 300 bytes a word while it is built).
BROADCAST_WORDS = 300_000


class WindowSet:
    """The distinct windows of the items, by width: sorted hashes, the words, and the items of each."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int):
        found: dict[int, dict[bytes, tuple[int, set]]] = {}
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            hashes, start, end = word_hashes(raw, ALNUM)
            n = min(width, len(hashes))
            if not n:
                continue
            low = LOWER[raw].tobytes()
            words = [low[s:e] for s, e in zip(start, end, strict=True)]
            for k, h in enumerate(windows(hashes, n).tolist()):
                found.setdefault(n, {}).setdefault(b" ".join(words[k : k + n]), (h, set()))[1].add(item)
        self.by_width = {}
        for n, of in found.items():
            rows = sorted((h, words, sorted(i for i in ids if i is not None)) for words, (h, ids) in of.items())
            hashes = np.array([r[0] for r in rows], np.uint64)
            # A bit per 24-bit hash prefix settles nearly every window that does not occur.
            bits = np.zeros(1 << 21, np.uint8)
            np.bitwise_or.at(bits, (hashes >> np.uint64(43)).astype(np.int64), _bit(hashes))
            self.by_width[n] = (hashes, [r[1] for r in rows], [r[2] for r in rows], bits)

    def scan(self, raw: np.ndarray) -> tuple[int, list[tuple[int, int]], set, np.ndarray, np.ndarray]:
        """Number of words, (first word, words) of each confirmed window, items, and the words' byte bounds."""
        hashes, start, end = word_hashes(raw, ALNUM)
        places, items = [], set()
        for n, (known, words, ids, bits) in self.by_width.items():
            seen = windows(hashes, n)
            maybe = np.flatnonzero(bits[(seen >> np.uint64(43)).astype(np.int64)] & _bit(seen))
            at = np.searchsorted(known, seen[maybe])
            hit = known[np.minimum(at, len(known) - 1)] == seen[maybe]
            for p, k in zip(maybe[hit].tolist(), at[hit].tolist(), strict=True):
                text = b" ".join(LOWER[raw[s:e]].tobytes() for s, e in zip(start[p : p + n], end[p : p + n], strict=True))
                while k < len(known) and known[k] == seen[p]:
                    if words[k] == text:
                        places.append((p, n))
                        items.update(ids[k])
                        break
                    k += 1
        return len(hashes), sorted(places), items, start, end


def _bit(hashes: np.ndarray) -> np.ndarray:
    return np.left_shift(np.uint8(1), ((hashes >> np.uint64(40)) & np.uint64(7)).astype(np.uint8))


def merged(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges [first, end) covered by the windows, without overlaps."""
    out: list[list[int]] = []
    for p, n in places:
        if out and p <= out[-1][1]:
            out[-1][1] = max(out[-1][1], p + n)
        else:
            out.append([p, p + n])
    return [(a, b) for a, b in out]


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _words(column) -> F.Column:
    return F.regexp_extract_all(fold_case(column), F.lit(WORD), F.lit(0))


def small_windows(benchmark: DataFrame, width: int, limit: int) -> WindowSet | None:
    """The benchmark's windows on the driver, or None if it has more than ``limit`` words."""
    items = pick(benchmark, ("item_id", "bigint"), ("text", "string"))
    size = items.agg(F.sum(F.size(_words(F.col("text")))), F.sum(F.octet_length("text"))).first()
    if (size[0] or 0) > limit or (size[1] or 0) > 100 * limit:
        return None
    return WindowSet([tuple(r) for r in items.collect()], width)


SCAN = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, limit: int = BROADCAST_WORDS
) -> DataFrame:
    """Benchmark windows in every row of ``docs`` (doc_id, text).

    Returns doc_id, n_words, n_hit (words inside any window), n_items and
    items_sha256 (of the items' ids, sorted as strings), contaminated.  Null
    and empty texts have no words, on either side; an item without id counts
    in the hits and not in the list; repeated rows each get a result; an
    empty benchmark contaminates nothing.
    """
    known = small_windows(benchmark, width, limit)
    if known is None:
        return _find_by_join(docs, benchmark, width)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = texts(batch.column(1))
            n_words, n_hit, n_items, digest = [], [], [], []
            for k in range(batch.num_rows):
                n, places, items, _, _ = shared.value.scan(raw[at[k] : at[k + 1]])
                n_words.append(n)
                n_hit.append(sum(b - a for a, b in merged(places)))
                n_items.append(len(items))
                digest.append(item_digest([str(i) for i in items]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(n_items, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array([n > 0 for n in n_hit], pa.bool_()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return pick(docs, ("doc_id", "bigint"), ("text", "string")).mapInArrow(scan, SCAN)


def _gram(n) -> Callable:
    return lambda i: F.array_join(F.slice("w", i + 1, n), " ")


def _known(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, n, gram): the windows of the items as text."""
    items = pick(benchmark, ("item_id", "bigint"), ("text", "string")).select("item_id", _words(F.col("text")).alias("w"))
    n = F.least(F.size("w"), F.lit(width))
    return items.where(F.size("w") > 0).select(
        "item_id",
        n.alias("n"),
        F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - n), _gram(n))).alias("gram"),
    )


def _entries(known: DataFrame) -> list[Column]:
    """Arrays of (n, p, gram): the windows of a document's words ``w``, for each width of ``known``."""
    widths = sorted(r[0] for r in known.select("n").distinct().collect())  # at most `width` rows
    none = F.array().cast("array<struct<n:int,p:int,gram:string>>")
    entry = lambda k: F.when(
        F.size("w") >= k,
        F.transform(
            F.sequence(F.lit(0), F.size("w") - k),
            lambda i: F.struct(F.lit(k).alias("n"), i.alias("p"), _gram(F.lit(k))(i).alias("gram")),
        ),
    ).otherwise(none)
    return [none, *map(entry, widths)]


def _find_by_join(docs: DataFrame, benchmark: DataFrame, width: int) -> DataFrame:
    """The same rows by joining windows as text; both sides are shuffled."""
    known = _known(benchmark, width).groupBy("n", "gram").agg(F.collect_set("item_id").alias("items"))
    words = pick(docs, ("doc_id", "bigint"), ("text", "string")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", _words(F.col("text")).alias("w")
    )
    first = F.array(F.struct(F.lit(0).alias("n"), F.lit(-1).alias("p"), F.lit("").alias("gram")))
    places = words.select(
        "row", "doc_id", F.size("w").cast("bigint").alias("n_words"),
        F.explode(F.concat(first, *_entries(known))).alias("e"),
    ).select("row", "doc_id", "n_words", "e.*")
    hits = places.join(known, ["n", "gram"], "left").where("items is not null or p = -1")
    covered = hits.select(
        "row", "doc_id", "n_words", "items",
        F.when(F.col("items").isNotNull(), F.sequence(F.col("p"), F.col("p") + F.col("n") - 1)).alias("at"),
    )
    by_row = ["row", "doc_id", "n_words"]
    counts = covered.select(*by_row, F.explode_outer("at").alias("at")).groupBy(*by_row).agg(
        F.count_distinct("at").alias("n_hit")
    )
    found = covered.select("row", F.explode_outer("items").alias("item")).groupBy("row").agg(
        F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("found")
    )
    return counts.join(found, "row").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("found").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WIDTH, limit: int = BROADCAST_WORDS
) -> DataFrame:
    """``docs`` without benchmark text; same columns.

    ``remove="documents"`` drops every document with a hit.  ``"spans"``
    keeps it and cuts the hit words out of ``text``, each with the separators
    before it (``n_chars``, where present, follows).  Clean rows are passed on
    unchanged.  A benchmark beyond ``limit`` words is joined, with the same
    result; then ``docs`` are written out once, with a number for each row.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    known = small_windows(benchmark, width, limit)
    if known is None:
        return _clean_by_join(docs, benchmark, remove, width)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    at_text = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = texts(batch.column(at_text))
            keep, new = [], {}
            for k in range(batch.num_rows):
                text = raw[at[k] : at[k + 1]]
                _, places, _, start, end = shared.value.scan(text)
                keep.append(not places or remove == "spans")
                if places and remove == "spans":
                    new[k] = _without(text, places, end)
            batch = with_texts(batch, new)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def _without(text: np.ndarray, places: list[tuple[int, int]], end: np.ndarray) -> str:
    """The text without the words of the windows and the separators before them."""
    left, done = [], 0
    for a, b in merged(places):
        left.append(text[done : int(end[a - 1]) if a else 0].tobytes())
        done = int(end[b - 1])
    return (b"".join(left) + text[done:].tobytes()).decode()


#: Columns that the rows carry through the join.
ROW, PLACES = "_decontaminate_row", "_decontaminate_places"


def _clean_by_join(docs: DataFrame, benchmark: DataFrame, remove: str, width: int) -> DataFrame:
    """The hit windows by a shuffled join with the distinct windows; rows go, or are cut, once."""
    numbered = frozen(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    known = _known(benchmark, width).select("n", "gram").distinct()
    words = numbered.select(ROW, _words(F.col("text").cast("string")).alias("w"))
    places = words.select(ROW, F.explode(F.concat(*_entries(known))).alias("e")).select(ROW, "e.*")
    hits = places.join(known, ["n", "gram"], "left_semi")
    columns = [f"`{c}`" for c in docs.columns]
    if remove == "documents":
        return numbered.join(hits.select(ROW).distinct(), ROW, "left_anti").select(*columns)
    ranges = hits.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("p", "n"))).alias(PLACES))
    at_text = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = texts(batch.column(at_text))
            new = {}
            for k, found in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if found:
                    text = raw[at[k] : at[k + 1]]
                    new[k] = _without(text, [(x["p"], x["n"]) for x in found], word_hashes(text, ALNUM)[2])
            yield with_texts(batch.select(range(batch.num_columns - 1)), new)

    return numbered.join(ranges, ROW, "left").select(*columns, PLACES).mapInArrow(clean, docs.schema)


def op8_decontaminate(spark, sf_dir) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
