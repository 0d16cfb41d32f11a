"""Phrase collocations, counted over a prefix-free parse of the corpus.

1. A text is split into pieces (at stops and line ends) and those into words.
   A hash of each window of ``LONGEST - 1`` words says whether a chunk begins
   there; a chunk reaches to the end of the next window that says so.  So equal
   passages are cut into equal chunks wherever they stand, and neighbours
   overlap by one window.  A chunk owns the phrases that begin before that
   window: each occurrence has one owner.
2. The distinct chunks of a language with their frequencies are the dictionary.
   Phrases are counted inside distinct chunks only, times the chunk's frequency.
3. Only frequent phrases matter, and all parts of a frequent phrase are
   frequent.  So words and pairs are counted by 64-bit hashes first; a table of
   ``BITS`` bits (its size does not depend on the data) marks the frequent ones.
   The exact count by spelling then takes only phrases whose pairs are all
   marked.  A collision can let through a rare phrase, never stop a frequent one.
4. Cuts, scores, the rule of longer phrases and ranks are joins and windows over
   the frequent phrases.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adfuse.llm.bytes_kernel import LOWER, texts, windows, word_hashes
from adfuse.llm.tables import frozen, pick, table

#: Words of the longest phrase, occurrences of the rarest, phrases reported for each language.
LONGEST, LEAST, TOP = 4, 30, 2000
#: A phrase yields to a longer one that holds so many hundredths of its occurrences.
COVER = 80
#: One window in so many begins a chunk, on average.
EVERY = 32
#: Bits that mark frequent words and pairs.
BITS = 1 << 26
#: Bytes of text that are parsed or counted at once, and bytes of phrases that are copied at once.
BLOCK, COPY = 8 << 20, 2 << 20
#: A language's phrases are ranked in so many parts first.
PARTS = 64

_U = np.uint64


def _mask(separators: str) -> np.ndarray:
    out = np.ones(256, bool)
    out[np.frombuffer(separators.encode(), np.uint8)] = False
    return out


STOPS = ".,;:!?\n\x0b\x0c\r"
WORD, NO_STOP, NO_SPACE = _mask(STOPS + " \t"), _mask(STOPS), _mask(" ")


def _copied(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of each span as an Arrow string."""
    size = end - start
    at = np.concatenate(([0], np.cumsum(size)))
    out, k = np.empty(at[-1], np.uint8), 0
    while k < len(start):  # the numbers of the bytes take eight times their room
        stop = max(k + 1, int(np.searchsorted(at, at[k] + COPY, "right")) - 1)
        n = size[k:stop]
        out[at[k] : at[stop]] = raw[np.repeat(start[k:stop] - at[k:stop], n) + np.arange(at[k], at[stop])]
        k = stop
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(out))


def _summed(names: list[str], columns: list, weight: np.ndarray) -> list[pa.RecordBatch]:
    """Rows with equal ``names`` as one, and the sum of their weights as ``times``."""
    whole = pa.table([*columns, pa.array(weight, pa.int64())], [*names, "times"])
    grouped = whole.group_by(names).aggregate([("times", "sum")]).rename_columns([*names, "times"])
    kinds = [pa.string() if pa.types.is_large_string(t) else t for t in grouped.schema.types]
    return grouped.cast(pa.schema(zip(grouped.column_names, kinds, strict=True))).combine_chunks().to_batches()


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about BLOCK bytes of ``column``; one larger row is alone."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(np.diff(texts(batch.column(batch.schema.get_field_index(column)))[1]))
        k = 0
        while k < batch.num_rows:
            before = int(ends[k - 1]) if k else 0
            stop = max(k + 1, int(np.searchsorted(ends, before + BLOCK - size, "right")))
            held.append(batch.slice(k, stop - k))
            size += int(ends[stop - 1]) - before
            k = stop
            if size >= BLOCK or k < batch.num_rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


CHUNKS = "lang string, chunk string, own int, times bigint"


def _parse(batches: Iterator[pa.RecordBatch], longest: int, every: int) -> Iterator[pa.RecordBatch]:
    """Distinct chunks of each block of rows, how many words each owns, and how often it occurs.

    A chunk is written as its words, with one space after each.
    """
    over = longest - 1
    for block in _blocks(batches, "text"):
        lines = [t.encode() for t in block.column("text").to_pylist()]
        first = np.cumsum([0, *(len(t) + 1 for t in lines)])[:-1]
        raw = LOWER[np.frombuffer(b"\n".join([*lines, b""]), np.uint8)]  # every text ends with a stop
        words, start, end = word_hashes(raw, WORD)
        n = len(words)
        if not n:
            continue
        stops = np.concatenate(([0], np.cumsum(~NO_STOP[raw])))
        new = np.concatenate(([True], stops[start[1:]] > stops[end[:-1]]))  # first word of a piece
        piece_end = np.append(np.flatnonzero(new)[1:], n)[np.cumsum(new) - 1]
        begins = new.copy()
        hit = np.flatnonzero(windows(words, over) % _U(every) == 0)
        begins[hit[hit + over <= piece_end[hit]]] = True
        chunk = np.flatnonzero(begins)
        after = np.append(chunk[1:], n)
        last = np.minimum(after + over, piece_end[chunk])
        spaced = _copied(raw, start, end + 1)  # each word and the separator behind it
        at = np.frombuffer(spaced.buffers()[1], np.int64)
        plain = np.frombuffer(spaced.buffers()[2], np.uint8).copy()
        plain[at[1:] - 1] = ord(" ")
        row = np.searchsorted(first, start[chunk], "right") - 1
        yield from _summed(
            ["lang", "chunk", "own"],
            [
                block.column("lang").take(pa.array(row)).cast(pa.large_string()),
                _copied(plain, at[chunk], at[last]),
                pa.array((after - chunk).astype(np.int32)),
            ],
            np.ones(len(chunk), np.int64),
        )


class _Words:
    """The words of a block of dictionary rows, one array entry each."""

    def __init__(self, block: pa.RecordBatch) -> None:
        self.raw, row_at = texts(block.column("chunk"))
        self.hash, self.start, self.end = word_hashes(self.raw[: row_at[-1]], NO_SPACE)
        row = np.searchsorted(row_at, self.start, "right") - 1
        first = np.searchsorted(row, np.arange(block.num_rows))
        self.last = np.append(first[1:], len(row))[row]  # behind the last word of the chunk
        self.own = np.arange(len(row)) - first[row] < block.column("own").to_numpy()[row]
        self.times = block.column("times").to_numpy()[row]
        langs = block.column("lang").dictionary_encode()
        salt = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in langs.dictionary.to_pylist()]
        self.lang = langs.indices.to_numpy()[row]
        self.names, self.salt = langs.dictionary, np.array(salt, _U)[self.lang]

    def keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the phrases of ``n`` words by their first word, and whether the chunk holds them."""
        key = np.zeros(len(self.hash), _U)
        found = windows(self.hash, n)
        key[: len(found)] = found
        whole = np.arange(len(key)) + n <= self.last
        return (key ^ self.salt) * _U(0x9E3779B97F4A7C15) + _U(n), whole


def _hash_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted counts of words and pairs by hash, summed over each block."""
    for block in _blocks(batches, "chunk"):
        w = _Words(block)
        for n in (1, 2):
            key, whole = w.keys(n)
            mine = whole & w.own
            key, times = key[mine], w.times[mine]
            if not len(key):
                continue
            order = np.argsort(key)
            key, times = key[order], times[order]
            heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sums = np.add.reduceat(times, heads)
            yield pa.RecordBatch.from_arrays([pa.array(key[heads].view(np.int64)), pa.array(sums)], ["key", "times"])


def _marked(dictionary: DataFrame, least: int) -> np.ndarray:
    """BITS bits in which those of all words and pairs with ``least`` occurrences are set."""
    frequent = (
        dictionary.mapInArrow(_hash_counts, "key bigint, times bigint")
        .groupBy("key")
        .agg(F.sum("times").alias("times"))
        .where(F.col("times") >= least)
    )
    place = F.col("key").bitwiseAND(F.lit(BITS - 1))
    got = (
        frequent.groupBy(F.shiftright(place, 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits"))
        .toArrow()  # at most BITS / 64 rows
    )
    out = np.zeros(BITS // 64, np.int64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy()
    return out.view(np.uint8)


def _phrase_counts(batches: Iterator[pa.RecordBatch], longest: int, bits) -> Iterator[pa.RecordBatch]:
    """Weighted counts by spelling of the phrases whose words or pairs are all marked, summed over each block."""

    def marked(key: np.ndarray) -> np.ndarray:
        place = (key & _U(8 * len(bits.value) - 1)).astype(np.int64)
        return bits.value[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0

    for block in _blocks(batches, "chunk"):
        w = _Words(block)
        n_words = len(w.hash)
        if not n_words:
            continue
        key, whole = w.keys(2)
        pair = whole & marked(key)
        good = w.own & marked(w.keys(1)[0])
        for n in range(1, longest + 1):
            if n == 2:
                good = w.own & pair
            elif n > 2:  # the pair that ends with the new word
                good = good & np.append(pair[n - 2 :], np.zeros(n - 2, bool))[:n_words]
            first = np.flatnonzero(good)
            if len(first):
                yield from _summed(
                    ["lang", "phrase", "words"],
                    [
                        w.names.take(pa.array(w.lang[first])).cast(pa.large_string()),
                        _copied(w.raw, w.start[first], w.end[first + n - 1]),
                        pa.array(np.full(len(first), n, np.int32)),
                    ],
                    w.times[first],
                )


def dictionary(docs: DataFrame, longest: int = LONGEST, every: int = EVERY) -> DataFrame:
    """The chunks of all texts of (lang, text): lang, chunk, own (words it owns) and times."""
    rows = pick(docs, ("lang", "string"), ("text", "string")).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    parsed = rows.mapInArrow(functools.partial(_parse, longest=longest, every=every), CHUNKS)
    return parsed.groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times"))


def frequent_phrases(chunks: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, phrase, words and f of all phrases with ``least`` occurrences, from a (written) dictionary."""
    bits = chunks.sparkSession.sparkContext.broadcast(_marked(chunks, least))  # BITS / 8 bytes
    count = functools.partial(_phrase_counts, longest=longest, bits=bits)
    return (
        chunks.mapInArrow(count, "lang string, phrase string, words int, times bigint")
        .groupBy("lang", "phrase", "words")
        .agg(F.sum("times").alias("f"))
        .where(F.col("f") >= least)
    )


def score(a: Column, l: Column, r: Column) -> Column:
    """floor(2000000 * a / (l + r)) in whole numbers; the product may pass 64 bits."""
    wide = "decimal(38,0)"
    return F.call_function("div", a.cast(wide) * F.lit(2_000_000).cast("decimal(7,0)"), l.cast(wide) + r.cast(wide))


def _part(first: Column, size: Column) -> Column:
    """``size`` words of the phrase, from word ``first`` (1, 2, ...)."""
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def _longer(phrases: DataFrame) -> DataFrame:
    """Most occurrences of a longer phrase around each phrase: lang, phrase, longest_f."""
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _part(i, n)),
        )
    )
    return (
        phrases.where("words > 2")
        .select("lang", "f", F.explode(inner).alias("inner"))
        .groupBy("lang", "inner")
        .agg(F.max("f").alias("longest_f"))
        .select("lang", F.col("inner").alias("phrase"), "longest_f")
    )


def ranked(phrases: DataFrame, cover: int = COVER, top: int = TOP) -> DataFrame:
    """Scored and ranked collocations of (lang, phrase, words, f), which holds all parts of its phrases.

    The first ``top`` of each language: lang, rank, phrase, a, l, r and score.
    """
    many = phrases.where("words > 1").withColumnRenamed("f", "a")
    cuts = many.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        *("lang", "phrase", "a", "k"),
        _part(F.lit(1), F.col("k")).alias("left"),
        _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    cuts = cuts.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    weakest = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    wide = "decimal(38,0)"
    kept = (
        weakest.join(_longer(phrases), ["lang", "phrase"], "left")
        .where(
            F.col("longest_f").isNull()
            | (F.col("longest_f").cast(wide) * F.lit(100) < F.col("a").cast(wide) * F.lit(cover))
        )
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # A language may hold most phrases: the best of each part first, so that no task ranks them all.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = kept.withColumn("_nth", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    best = best.where(F.col("_nth") <= top).drop("_nth")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return best.withColumn("rank", rank).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, cover: int = COVER, every: int = EVERY
) -> DataFrame:
    """The collocations of every language of ``docs`` (lang, text).

    Returns lang, rank, phrase, a (its occurrences), l and r (those of the
    parts of its lowest-scoring cut), n (words of the language) and score.
    A null lang is ``und``, a null or empty text has no words; a text that is
    repeated counts each time; a language without a frequent phrase, and an
    empty table, give no rows.  Every word of every text counts, however long.
    """
    chunks = frozen(dictionary(docs, longest, every), "chunks")
    found = ranked(frozen(frequent_phrases(chunks, longest, least), "phrases"), cover, top)
    words = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    return found.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
