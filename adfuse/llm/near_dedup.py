"""Near-duplicate documents by fast similarity sketches, banding and exact confirmation.

1. Every document becomes the set of its word shingles (64-bit hashes).  Equal
   sets are one class from here on, however many copies there are.
2. The sketch places all elements into bins, round after round: round i
   throws every element with a fresh hash into one of t bins and keeps the
   smallest (round, value) per bin; rounds t..2t-1 send every element to bin
   i - t.  So no coordinate of any non-empty set stays empty, usually after
   two or three rounds, and the share of equal coordinates concentrates around
   the Jaccard similarity as with t independent hashes.
3. Bands of the sketch are buckets.  Classes that share a bucket, directly or
   through others, form a candidate group.  At similarity s a pair is missed
   with probability (1 - s**ROWS)**BANDS: 2.4e-9 at 0.8, less above.
4. Inside a candidate group *all* pairs are confirmed on the full sets, so
   what banding misses between two members of a group is found too.  Groups of
   up to TILE classes are one task's work.  A larger group is first compared
   with its most connected member only (linear), and then those members that
   are not linked to it with the rest, in tiles of at most 2 * TILE classes;
   members already linked are not compared with each other.
5. Components of the confirmed links give the result.

No pair leaves a task unless it is a confirmed link, and of those only a
spanning forest of each tile.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfuse.llm.bytes_kernel import NONSPACE, mix, texts, windows, word_hashes
from adfuse.llm.graph import components
from adfuse.llm.tables import checkpointed, frozen, pick, table
from adfuse.sources.storage import remove_scratch

#: Rows of a band, and bands.
ROWS, BANDS = 5, 50
#: Links have at least this many hundredths of their union in common.
PERCENT = 80
#: Classes, and bytes of text, that one chunk of a tile holds on average.
TILE, TILE_BYTES = 512, 8 << 20

_U = np.uint64


def shingles(raw: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    words, _, _ = word_hashes(raw, NONSPACE)
    return np.unique(windows(words, min(width, len(words)))) if len(words) else np.empty(0, _U)


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` coordinates per (non-empty) set."""
    out = np.full((len(sets), size), np.iinfo(_U).max, _U)
    flat = out.reshape(-1)
    todo = np.arange(len(sets))
    for i in range(2 * size):
        elements = np.concatenate([sets[k] for k in todo])
        owner = np.repeat(todo, [len(sets[k]) for k in todo])
        h = mix(elements + _U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        if i < size:
            place = (((h >> _U(32)) * _U(size)) >> _U(32)).astype(np.int64)
        else:
            place = np.full(len(h), i - size)
        value = (_U(i) << _U(32)) | (h & _U(0xFFFFFFFF))
        np.minimum.at(flat, owner * size + place, value)
        todo = todo[(out[todo] == np.iinfo(_U).max).any(axis=1)]
        if not len(todo):
            break
    return out


def band_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch; equal bands at another place differ."""
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=_U)), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * _U(0x9FB21C651E98DF25) + parts[:, :, r])
    return key.view(np.int64)


SIGNED = "uid bigint, doc_id bigint, text_hash bigint, n_bytes bigint, n bigint, set_key binary, bands array<bigint>"


def _sign(docs: DataFrame, width: int, rows: int, bands: int) -> DataFrame:
    """Set size, set digest and band keys of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 64):
                batch = whole.slice(lo, 64)
                raw, at = texts(batch.column(3))
                sets = [shingles(raw[a:b], width) for a, b in zip(at[:-1], at[1:], strict=True)]
                full = [k for k, s in enumerate(sets) if len(s)]
                keys = band_keys(sketches([sets[k] for k in full], rows * bands), rows, bands) if full else None
                ends = np.zeros(len(sets) + 1, np.int32)
                ends[[k + 1 for k in full]] = bands
                flat = pa.array(keys.ravel() if full else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:3],
                        pa.array(np.diff(at)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), flat),
                    ],
                    [f.split()[0] for f in SIGNED.split(", ")],
                )

    return (
        pick(docs, ("doc_id", "bigint"), ("text", "string"))
        .select(F.monotonically_increasing_id().alias("uid"), "doc_id", text_hash().alias("text_hash"), "text")
        .mapInArrow(sign, SIGNED)
    )


def text_hash():
    """Names a row's text together with its doc_id, the same in every read of the table."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each left set: its number, and those of the right sets that it is linked with.

    Counts common elements through an index of the right sets.
    """
    sizes = np.array([len(s) for s in right], np.int64)
    owner = np.repeat(np.arange(len(right)), sizes)
    joined = np.concatenate(right) if right else np.empty(0, _U)
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    for k, s in enumerate(left):
        lo, hi = np.searchsorted(joined, s, "left"), np.searchsorted(joined, s, "right")
        n = hi - lo
        s_at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(owner[s_at], minlength=len(right))
        yield k, np.flatnonzero(100 * common >= percent * (len(s) + sizes - common))


def _confirm(width: int, percent: int):
    """Grouped function: links between the left and the right rows of one tile, as a spanning forest."""

    def confirm(tile: pa.Table) -> pa.Table:
        raw, at = texts(tile.column("text"))
        cls, is_left, is_right = (tile.column(c).to_pylist() for c in ("cls", "is_left", "is_right"))
        rows = list(dict(zip(cls, range(len(cls)), strict=True)).values())  # a class may come twice
        sets = {k: shingles(raw[at[k] : at[k + 1]], width) for k in rows}
        left, right = [k for k in rows if is_left[k]], [k for k in rows if is_right[k]]
        root = {k: k for k in rows}

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        links = []
        for i, found in linked_pairs([sets[k] for k in left], [sets[k] for k in right], percent):
            for j in found.tolist():
                a, b = find(left[i]), find(right[j])
                if a != b:
                    root[a] = b
                    links.append((cls[left[i]], cls[right[j]]))
        return pa.table(
            {"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())}
        )

    return confirm


def _chunk(count: str, by: str):
    return F.pmod(F.xxhash64(by), F.col(count)).cast("int")


def _links(members: DataFrame, texts_of: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links inside the candidate groups.

    ``members`` (grp, chunks, center, cls, n_bytes), ``texts_of`` (cls, text);
    a group of one chunk is compared as a whole.  Tiles are made of ids alone;
    texts join them last and are dealt out by tile, so the tiles of one group
    go to many tasks.
    """
    tile = ("grp", "t1", "t2")

    def confirm(tiles: DataFrame) -> DataFrame:
        dealt = tiles.join(texts_of, "cls").repartition(*tile)
        return checkpointed(dealt.groupBy(*tile).applyInArrow(_confirm(width, percent), "a bigint, b bigint"))

    def side(rows: DataFrame, t1, t2, left, right) -> DataFrame:
        return rows.select(
            "grp", t1.alias("t1"), t2.alias("t2"), "cls", F.lit(left).alias("is_left"), F.lit(right).alias("is_right")
        )

    rows, zero = members.withColumn("chunk", _chunk("chunks", "cls")), F.lit(0)
    large = rows.where("chunks > 1")
    every = F.explode(F.sequence(zero, F.col("chunks") - 1))
    first = confirm(
        side(rows.where("chunks = 1"), zero, zero, True, True)
        .union(side(large.where("cls = center").withColumn("k", every), F.col("k"), zero, True, False))
        .union(side(large.where("cls != center"), F.col("chunk"), zero, False, True))
    )
    if large.isEmpty():
        return first
    # Those not linked to their group's center, against each other and against the rest.
    centers = large.select("center").distinct()
    near = first.join(centers, first["a"] == centers["center"], "left_semi").select(F.col("b").alias("cls"))
    apart = large.where("cls != center").join(near, "cls", "left_anti")
    n = checkpointed(
        apart.groupBy("grp").agg(_chunks(F.count(F.lit(1)), F.sum("n_bytes")).alias("apart"))
    )
    apart = apart.join(n, "grp").withColumn("c", _chunk("apart", "cls"))
    close = large.join(near, "cls", "left_semi").join(n, "grp")
    pairs = F.transform(
        F.sequence(zero, F.col("apart") - 1),
        lambda k: F.struct(F.least(k, F.col("c")).alias("t1"), F.greatest(k, F.col("c")).alias("t2")),
    )
    among = apart.withColumn("t", F.explode(pairs)).select(
        *("grp", "t.t1", "t.t2", "cls"),
        (F.col("c") == F.col("t.t1")).alias("is_left"),
        (F.col("c") == F.col("t.t2")).alias("is_right"),
    )
    left = side(apart.withColumn("k", every), F.col("c"), -1 - F.col("k"), True, False)
    again = F.explode(F.sequence(zero, F.col("apart") - 1))
    right = side(close.withColumn("k", again), F.col("k"), -1 - F.col("chunk"), False, True)
    return first.union(confirm(among.union(left).union(right)))


def _chunks(n, size):
    return F.greatest(F.ceil(n / TILE), F.ceil(size / TILE_BYTES)).cast("int")


def _classified(
    docs: DataFrame, width: int, percent: int, rows: int, bands: int, made: list[str] | None = None
) -> DataFrame:
    """(uid, doc_id, text_hash, n, root, component_id) of every row; reads the tables in ``made``."""
    signed = frozen(_sign(docs, width, rows, bands), "signed", made)
    classes = frozen(
        signed.where("n > 0")
        .groupBy("set_key")
        .agg(
            F.min("uid").alias("cls"),
            F.min("doc_id").alias("low"),
            F.min_by(F.struct("doc_id", "text_hash", "n_bytes", "bands"), "uid").alias("first"),
        )
        .select("set_key", "cls", "low", "first.doc_id", "first.text_hash", "first.n_bytes", "first.bands"),
        "classes",
        made,
    )
    entries = classes.select("cls", F.explode("bands").alias("band"))
    # Tables that others join by a possibly hot key are written out first: then
    # both sides of the join are plain exchanges, which adaptive execution can split.
    shared = checkpointed(
        entries.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("lead")).where("size > 1")
    )
    met = checkpointed(entries.join(shared, "band").select("cls", "lead", "size"))
    groups = components(met.select("cls", "lead"))
    weights = met.groupBy("cls").agg(F.sum("size").alias("weight"))
    members = (
        groups.withColumnsRenamed({"node": "cls", "root": "grp"})
        .join(weights, "cls")
        .join(classes.drop("bands", "set_key", "low"), "cls")
    )
    sized = checkpointed(
        members.groupBy("grp").agg(
            _chunks(F.count(F.lit(1)), F.sum("n_bytes")).alias("chunks"),
            F.max(F.struct("weight", (-F.col("cls")).alias("minus")))["minus"].alias("minus"),
        )
    )
    members = checkpointed(members.join(sized, "grp").withColumn("center", -F.col("minus")))
    source = pick(docs, ("doc_id", "bigint"), ("text", "string")).select(
        F.col("doc_id").alias("_id"), text_hash().alias("_hash"), "text"
    )
    texts_of = frozen(
        members.join(
            source, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        ).select("cls", "text"),
        "candidates",
        made,
    )
    links = _links(members, texts_of, width, percent)
    found = components(links).withColumnRenamed("node", "cls")
    names = classes.select("cls", "low")
    lowest = checkpointed(found.join(names, "cls").groupBy("root").agg(F.min("low").alias("lowest")))
    linked = found.join(lowest, "root")
    classes = classes.select("set_key", "cls", "low").join(linked, "cls", "left").select(
        "set_key",
        F.coalesce("root", "cls").alias("root"),
        F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("component_id"),
    )
    full = signed.where("n > 0").join(classes, "set_key").select(
        "uid", "doc_id", "text_hash", "n", "root", "component_id"
    )
    empty = signed.where("n = 0").select(
        "uid", "doc_id", "text_hash", "n", F.lit(None).cast("bigint").alias("root"), F.col("doc_id").alias("component_id")
    )
    return full.union(empty)


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """Components of near duplicates among the rows of ``docs`` (doc_id, text).

    Returns doc_id, n_shingles, component_id (smallest doc_id of the
    component) and kept.  Texts without words have no shingles and are linked
    with nothing.  Rows that repeat an id and a text are equal members of one
    component (each is kept if its id is the component's); rows without id are
    members too, but name a component only if it has no other id (then
    component_id is null).  An empty table gives no rows.
    """
    return _classified(docs, width, percent, rows, bands).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.equal_null("doc_id", "component_id").alias("kept"),
    )


def deduplicate(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """``docs`` with one row of each component (the smallest doc_id); same columns.

    Rows without any word are all kept.
    """
    made: list[str] = []
    of = frozen(_classified(docs, width, percent, rows, bands, made), "classified")
    for path in made:  # nothing reads them any more
        remove_scratch(docs.sparkSession, path)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "text_hash")
    best = of.where("n > 0").groupBy("root").agg(F.min(order).alias("b"))
    copies = of.where("n > 0").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    keep = best.select(F.col("b.doc_id").alias("_id"), F.col("b.text_hash").alias("_hash")).distinct()
    keep = keep.join(
        copies, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    ).select("_id", "_hash", "copies")
    blank = of.where("n = 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(1).alias("copies"))
    keep = keep.union(blank.distinct())
    tagged = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),  # the caller's names cannot clash with ours
        docs["doc_id"].cast("bigint").alias("doc_id"),
        text_hash().alias("text_hash"),
    )
    kept = tagged.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    once = kept.where("copies > 1").dropDuplicates(["doc_id", "text_hash"])
    return kept.where("copies = 1").select("row.*").union(once.select("row.*"))


def op5_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)
