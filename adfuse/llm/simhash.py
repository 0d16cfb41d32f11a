"""128-bit SimHash fingerprints, in DataFrame operations only.

Every occurrence of a term votes with its weight on each bit of its hash; a bit
of the fingerprint is set if more than half of the weight voted for it.  Terms
are the words between white space, of any kind; a word of more than ``LONG``
characters, as texts without blanks are made of, is its overlapping runs of
``GRAM`` characters instead.  The votes are counted by whole-stage code: sixteen bits
apart, four counters share one bigint, so 32 plain sums count 128 bits.

Counters hold 15 bits, so terms are counted in runs of ``RUN`` and the runs
are added in wider counters; no text is too long.

Fingerprints within a Hamming radius r are found with r + 1 block tables:
of r + 1 blocks one at least is untouched, and each table is keyed by one of
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adfuse.llm.tables import checkpointed, pick, table

#: The largest weight of a term, and the terms of a run: their product stays under 2**15.
HEAVY, RUN = 15, 2048
#: Documents with ids in the same stretch of 2**STRETCH numbers are put in order by one task.
STRETCH = 8

#: The longest word that is a term, and the characters of the terms of a longer one.
LONG, GRAM = 24, 4

#: Fixed value: white space between words, besides blanks, tabs and line ends.
SPACE = "\x0b\x0c\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))

_LANES = 0x0001000100010001
_PAIRS = 0x0000FFFF0000FFFF
_SUMS = [(h, j) for h in (1, 2) for j in range(16)]


def weight(term: str) -> str:
    """Short words are common words: they count little."""
    return f"least({HEAVY}, greatest(1, 2 * char_length({term}) - 5))"


def _grams(word: Column) -> Column:
    def runs(chars: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(chars) - GRAM), lambda i: F.concat(*[F.get(chars, i + k) for k in range(GRAM)])
        )

    return _once(F.split(word, "", -1), runs)


def _once(value: Column, use) -> Column:
    """``use(value)``, where ``value`` is computed once however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def terms(text: Column) -> Column:
    """The terms of a text, in order; a text without words is one empty term."""
    rare = F.lit(False)
    for c in SPACE:  # byte searches: several times faster than a pattern of these characters
        rare = rare | F.contains(text, F.lit(c))
    blanks = F.when(rare, F.translate(text, SPACE, " " * len(SPACE))).otherwise(text)
    for common in "\n\t\r":
        blanks = F.replace(blanks, F.lit(common), F.lit(" "))
    long = lambda w: F.char_length(w) > LONG
    cut = lambda words: F.flatten(F.transform(words, lambda w: F.when(long(w), _grams(w)).otherwise(F.array(w))))
    none = F.array(F.lit(""))
    return _once(
        F.array_remove(F.split(blanks, " ", -1), ""),
        lambda words: F.when(F.exists(words, long), cut(words)).when(F.size(words) == 0, none).otherwise(words),
    )


def votes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` with the weight that voted for each bit, for the rows' ``text``.

    The keys name a row.  If the rows are already partitioned by some of the
    keys, nothing is shuffled.
    """
    each = rows.select(*keys, F.posexplode(terms(F.col(text))).alias("_pos", "_term")).select(
        *keys,
        F.expr(f"_pos div {RUN}").alias("_run"),
        F.expr("xxhash64(_term)").alias("_h1"),
        F.expr("xxhash64(_term, 1)").alias("_h2"),
        F.expr(f"cast({weight('_term')} as bigint)").alias("_w"),
    )
    runs = each.groupBy(*keys, "_run").agg(
        *[F.expr(f"sum((shiftrightunsigned(_h{h}, {j}) & {_LANES}L) * _w)").alias(f"_s{h}_{j}") for h, j in _SUMS],
        F.sum("_w").alias("_w"),
    )
    return runs.groupBy(*keys).agg(
        *[F.expr(f"sum(_s{h}_{j} & {_PAIRS}L)").alias(f"_e{h}_{j}") for h, j in _SUMS],
        *[F.expr(f"sum(shiftrightunsigned(_s{h}_{j}, 16) & {_PAIRS}L)").alias(f"_o{h}_{j}") for h, j in _SUMS],
        F.sum("_w").alias("_w"),
    )


def _word(h: int) -> Column:
    """One half of the fingerprint: bit j + 16 k from counter k of lane j."""
    bits = []
    for j in range(16):
        for k in range(4):
            lane = f"{'_o' if k % 2 else '_e'}{h}_{j}"
            count = f"(shiftrightunsigned({lane}, {32 * (k // 2)}) & {0xFFFFFFFF}L)"
            bits.append(f"if(2 * {count} > _w, shiftleft(1L, {j + 16 * k}), 0L)")
    return F.expr(" | ".join(bits))


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, fp1 and fp2: the two halves of the fingerprint of ``text`` (not null)."""
    return votes(rows, keys, text).select(*keys, _word(1).alias("fp1"), _word(2).alias("fp2"))


def as_text(fp1: str, fp2: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(fp1), 16, "0"), F.lpad(F.hex(fp2), 16, "0")))


def distance(a1: str, a2: str, b1: str, b2: str) -> Column:
    return F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))


def likeness(bits: Column) -> Column:
    """The cosine of the term vectors as their fingerprints estimate it; 1 for equal ones, never under 0."""
    return F.greatest(F.lit(0.0), F.cos(bits * F.lit(3.141592653589793 / 128)))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(fp1, fp2, n_within) of each distinct query fingerprint: rows of ``prints`` within ``radius``.

    Equal fingerprints are one entry with a count, so copies do not
    multiply.  Of the ``radius + 1`` blocks, a pair is taken from the first
    table in which it meets.
    """
    blocks = radius + 1
    if 128 % blocks or 128 // blocks > 64:
        raise ValueError("radius + 1 divides 128 into blocks of at most 64 bits")
    size = 128 // blocks
    per_half = 64 // size
    block = lambda t, k: (
        F.shiftrightunsigned(f"{t}{k // per_half + 1}", size * (k % per_half)).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1))
    )
    known = prints.groupBy("fp1", "fp2").agg(F.count(F.lit(1)).alias("n"))
    asked = queries.select("fp1", "fp2").distinct()
    entry = lambda df, t: df.select(
        *[F.col(c).alias(f"{t}{c[2:]}" if c.startswith("fp") else c) for c in df.columns],
        F.posexplode(F.array(*[block("fp", k) for k in range(blocks)])).alias("table", "block"),
    )
    pairs = entry(asked, "q").join(entry(known, "k"), ["table", "block"])
    earlier = F.lit(False)
    for k in range(blocks - 1):
        earlier = earlier | ((F.col("table") > k) & (block("q", k) == block("k", k)))
    near = pairs.where(~earlier & (distance("q1", "q2", "k1", "k2") <= radius))
    return near.groupBy(F.col("q1").alias("fp1"), F.col("q2").alias("fp2")).agg(F.sum("n").alias("n_within"))


def ring(ids: DataFrame) -> DataFrame:
    """(id, next): the next larger of distinct ids, and the smallest one after the largest.

    Ids are range-partitioned, so no task sees them all; only the first id of
    each partition is compared across partitions.
    """
    (name,) = ids.columns
    dealt = checkpointed(
        ids.select(F.col(name).alias("id")).repartitionByRange("id").withColumn("part", F.spark_partition_id())
    )
    heads = dealt.groupBy("part").agg(F.min("id").alias("head"))
    order = Window.orderBy("part")  # a row per partition
    after = heads.select(
        "part",
        F.coalesce(F.lead("head").over(order), F.min("head").over(Window.partitionBy())).alias("after"),
    )
    return dealt.join(after, "part").select(
        "id", F.coalesce(F.lead("id").over(Window.partitionBy("part").orderBy("id")), F.col("after")).alias("next")
    )


def with_next(docs: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Every row of ``docs`` with the next row's, in ascending (doc_id, text) order.

    Returns stretch, place (in it), doc_id, text, text_hash and next_id,
    next_text, next_hash; the last row is followed by the first.  Rows without
    doc_id come first; a null text counts as empty.  A window runs over the
    rows whose ids lie in one stretch of 2**``stretch`` numbers, at most as many distinct
    ids, and the first row of the following stretch is added to it.
    """
    rows = pick(docs, ("doc_id", "bigint"), ("text", "string")).select(
        F.coalesce(F.shiftright("doc_id", stretch), F.lit(-(1 << 62))).alias("stretch"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    heads = rows.groupBy("stretch").agg(F.min(F.struct("doc_id", "text_hash", "text")).alias("h"))
    after = ring(rows.select("stretch").distinct()).withColumnsRenamed({"id": "before", "next": "stretch"})
    ends = heads.join(after, "stretch").select(
        F.col("before").alias("stretch"), "h.doc_id", "h.text", "h.text_hash", F.lit(1).alias("borrowed")
    )
    order = Window.partitionBy("stretch").orderBy("borrowed", "doc_id", "text_hash")
    return (
        rows.withColumn("borrowed", F.lit(0))
        .unionByName(ends)
        .select(
            "stretch",
            F.row_number().over(order).alias("place"),
            "borrowed",
            "doc_id",
            "text",
            "text_hash",
            F.lead("doc_id").over(order).alias("next_id"),
            F.lead("text").over(order).alias("next_text"),
            F.lead("text_hash").over(order).alias("next_hash"),
        )
        .where("borrowed = 0")
        .drop("borrowed")
    )


def edit_likeness(docs: DataFrame, radius: int = 3, every: int = 50) -> DataFrame:
    """Fingerprints of every row of ``docs`` and of its edited text.

    The edited text ends with the beginning of the next document, for a
    quarter of its code points.  ``n_within`` is the number of rows, itself
    included, whose fingerprints are within ``radius``; it is asked for ids
    divisible by ``every``, and null for the rest.  Null ids come first in the order, null texts
    count as empty; repeated rows follow one another and each get a result; an
    only row is followed by itself; an empty table gives no rows.
    """
    edited = with_next(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = edited.withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    )
    keys = ["stretch", "place", "doc_id", "text_hash", "next_id", "next_hash", "n_chars", "edited_sha256"]
    both = edited.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")),
            )
        ).alias("e"),
    ).select(*keys, "e.which", "e.t")
    prints = fingerprints(both, [*keys, "which"], "t")
    own, new = F.col("which") == 0, F.col("which") == 1
    done = checkpointed(
        prints.groupBy(*keys).agg(
            F.max(F.when(own, F.col("fp1"))).alias("fp1"),
            F.max(F.when(own, F.col("fp2"))).alias("fp2"),
            F.max(F.when(new, F.col("fp1"))).alias("edited1"),
            F.max(F.when(new, F.col("fp2"))).alias("edited2"),
        )
    )
    following = done.groupBy("doc_id", "text_hash").agg(F.max("fp1").alias("next1"), F.max("fp2").alias("next2"))
    following = following.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    asked = done.where(F.col("doc_id") % every == 0)
    near = within_radius(done, asked, radius).withColumnsRenamed({"fp1": "_fp1", "fp2": "_fp2"})
    return (
        done.join(following, F.col("next_id").eqNullSafe(F.col("_id")) & (F.col("next_hash") == F.col("_hash")))
        .join(near, (F.col("doc_id") % every == 0) & (F.col("fp1") == F.col("_fp1")) & (F.col("fp2") == F.col("_fp2")), "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            as_text("fp1", "fp2").alias("fingerprint"),
            as_text("edited1", "edited2").alias("edited_fingerprint"),
            likeness(distance("fp1", "fp2", "edited1", "edited2")).alias("near_edited"),
            likeness(distance("fp1", "fp2", "next1", "next2")).alias("near_next"),
            "n_within",
        )
    )


def op4_simhash(spark, sf_dir) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents"))
