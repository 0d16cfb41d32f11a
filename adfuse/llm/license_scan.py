"""License detection by diagonal voting, in DataFrame operations only.

Every rolling word k-gram of every document is hashed and joined to the
k-grams of the license templates.  A match at document word p and template
word q lies on the diagonal p - q: copies of a template put all their votes
on one diagonal, copies with a few words inserted or removed on neighbouring
ones.  Votes are counted by (document, template, diagonal), diagonals no more
than ``BAND`` apart are merged, and each merged run is verified by the share
of the template's k-grams that it covers; of runs of the same license family
that start within ``NEAR`` words, only the best covered stand (version 2 and 3
of one notice differ in a single word), and a run inside a longer one yields to
it, whatever its license: a whole text that quotes another license's notice is
not under that license.

The template table is code, not data: phrases, notices and whole license texts,
some thirty thousand k-grams whatever the size of the corpus, so broadcasting it
is bounded.  Covered k-grams are counted as bits, ``WORD_BITS`` to a row.  Texts are never shuffled;
only matches and one row per document are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adfuse.llm.license_texts import WHOLE
from adfuse.llm.tables import fold_case, pick, table

#: Words of a k-gram; the shortest phrase has as many.
K = 3
#: Diagonals this far apart or nearer belong to one copy of a template.
BAND = 4
#: Runs of one family that start so near compete for the same passage.
NEAR = 64
#: Share of a template's k-grams that a merged run must cover.
COVER = 0.6
#: Template k-grams whose votes share one bigint.
WORD_BITS = 64

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``exact``: only whole consecutive copies count, and they are the base places."""

    label: str
    text: str
    exact: bool = False

    @property
    def family(self) -> str:
        return FAMILIES.get(self.label, self.label)

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.lower())


# Labels whose notices share most of their words.
FAMILIES = {
    "gpl-1": "gnu", "gpl-2": "gnu", "gpl-3": "gnu", "lgpl": "gnu", "agpl-3": "gnu",
    "cc-by": "cc", "cc-by-sa": "cc", "cc-by-nc": "cc",
}

# The phrases, and public license notices.
TEMPLATES = (
    Template("mit", "under the mit license", exact=True),
    Template("apache-2", "apache license version 2", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
    Template("mit", "Released under the MIT License."),
    Template("apache-2", "Licensed under the Apache License, Version 2.0"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    Template("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    Template("lgpl", "licensed under the GNU Lesser General Public License, version 3"),
    Template("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    *(
        Template(
            label,
            f"under the terms of the GNU {name}General Public License as published by the Free Software Foundation, "
            f"either version {version}, or (at your option) any later version.",
        )
        for label, name, version in (
            ("gpl-1", "", "1"), ("gpl-2", "", "2 of the License"), ("gpl-3", "", "3 of the License"),
            ("agpl-3", "Affero ", "3 of the License"), ("lgpl", "Library ", "2 of the License"),
            ("lgpl", "Lesser ", "2.1 of the License"), ("lgpl", "Lesser ", "3 of the License"),
        )
    ),
    *(
        Template(label, f"under the terms of the GNU {name}General Public License version {version} as published by the Free Software Foundation")
        for label, name, version in (
            ("gpl-2", "", "2"), ("gpl-3", "", "3"), ("agpl-3", "Affero ", "3"), ("lgpl", "Lesser ", "2.1"), ("lgpl", "Lesser ", "3"),
        )
    ),
    # Headings go on to a year of the copyright, so a mention in another license is not one.
    Template("gpl-1", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989 Copyright (C) 1989"),
    Template("gpl-2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989"),
    Template("gpl-3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007"),
    Template("lgpl", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1991"),
    Template("lgpl", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991"),
    Template("lgpl", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007"),
    Template("agpl-3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007"),
    *(Template(label, words) for label, words in WHOLE),
)


def template_grams(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES, k: int = K) -> DataFrame:
    """(tid, label, family, exact, grams, at, hash): one row per template k-gram."""
    rows = []
    for tid, t in enumerate(templates):
        words = t.words
        n = len(words) - k + 1
        if n < 1:
            raise ValueError(f"template {t.text!r} has no {k}-gram")
        rows += [(tid, t.label, t.family, t.exact, n, at, *words[at : at + k]) for at in range(n)]
    words = [f"w{i}" for i in range(k)]
    kinds = ", ".join(f"{w} string" for w in words)
    return spark.createDataFrame(rows, f"tid int, label string, family string, exact boolean, grams int, at int, {kinds}").select(
        "tid", "label", "family", "exact", "grams", "at", F.xxhash64(*words).alias("hash")
    )


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    k: int = K,
    band: int = BAND,
    cover: float = COVER,
) -> DataFrame:
    """License labels of every row of ``docs`` (doc_id, text).

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score and matches (label, first and last word, cover of each
    verified run).  ``score`` is the best cover, 1 for an exact phrase, 0
    without a match.  A null or empty text has no words; each repeated row and
    each null doc_id gets a result of its own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    words = pick(docs, ("doc_id", "bigint"), ("text", "string")).select(
        F.monotonically_increasing_id().alias("row"),  # read once: names a row inside this job only
        "doc_id",
        F.regexp_extract_all(fold_case(F.col("text")), F.lit(WORD), F.lit(0)).alias("w"),
    )
    # One entry per k-gram, and a first entry (place -1) that stands for the row itself.
    gram = lambda i: F.xxhash64(*[F.get(F.col("w"), i + j) for j in range(k)])
    grams = F.when(
        F.size("w") >= k, F.transform(F.sequence(F.lit(0), F.size("w") - k), gram)
    ).otherwise(F.array().cast("array<bigint>"))
    places = words.select(
        "row",
        F.struct("doc_id", F.size("w").cast("bigint").alias("n_words")).alias("doc"),
        F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), grams)).alias("p", "hash"),
    )
    hits = (
        places.join(F.broadcast(template_grams(spark, templates, k)), "hash", "left")
        .where(F.col("tid").isNotNull() | (F.col("p") == 0))
        .select(
            "row", "tid", "label", "family", "exact", "grams", "at",
            F.when(F.col("p") == 0, F.col("doc")).alias("doc"),
            (F.col("p") - 1 - F.col("at")).alias("diagonal"),
        )
    )
    hits = hits.withColumn("part", F.expr(f"at div {WORD_BITS}"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at") % WORD_BITS)
    votes = hits.groupBy("row", "tid", "label", "family", "exact", "grams", "diagonal", "part").agg(
        F.coalesce(F.bit_or(bit), F.lit(0)).alias("seen"),
        F.min("at").alias("low"),
        F.max("at").alias("high"),
        F.max("doc").alias("doc"),
    )
    # Neighbouring diagonals of inexact templates form a run; an exact one needs a full diagonal.
    by_template = Window.partitionBy("row", "tid").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_template)
    apart = gap > F.when(F.col("exact"), 0).otherwise(band)  # parts of one diagonal stay together
    runs = votes.withColumn("new", F.when(gap.isNull() | apart, 1).otherwise(0)).withColumn(
        "run", F.sum("new").over(by_template)  # up to and with all rows of the diagonal
    )
    run = ["row", "tid", "label", "family", "exact", "grams", "run"]
    parts = runs.groupBy(*run, "part").agg(
        F.bit_count(F.bit_or("seen")).alias("covered"),
        F.min(F.col("diagonal") + F.col("low")).alias("first"),
        F.max(F.col("diagonal") + F.col("high") + k - 1).alias("last"),
        F.max("doc").alias("doc"),
    )
    merged = parts.groupBy(*run).agg(
        (F.sum("covered") / F.col("grams")).alias("cover"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("doc").alias("doc"),
    )
    found = F.col("tid").isNotNull() & (F.col("cover") >= F.when(F.col("exact"), 1.0).otherwise(cover))
    base = F.col("exact") & found
    rivals = Window.partitionBy("row", "family", "exact").orderBy("first").rangeBetween(-NEAR, NEAR)
    merged = merged.withColumn("stands", found & (F.col("exact") | (F.col("cover") >= F.max("cover").over(rivals))))
    # A run that begins earlier and ends no earlier, or begins there and ends later, holds this one.
    end = F.when(F.col("stands") & ~F.col("exact"), F.col("last"))
    earlier = F.max(end).over(Window.partitionBy("row").orderBy("first").rangeBetween(Window.unboundedPreceding, -1))
    there = F.max(end).over(Window.partitionBy("row", "first"))
    inside = F.coalesce((earlier >= F.col("last")) | (there > F.col("last")), F.lit(False))
    merged = merged.withColumn("inside", inside).withColumn("stands", F.col("stands") & (F.col("exact") | ~F.col("inside")))
    stands = F.col("stands")
    per_row = merged.groupBy("row").agg(
        F.max("doc").alias("doc"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(stands, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(stands, F.col("cover"))), F.lit(0.0)).alias("score"),
        F.sort_array(
            F.collect_list(F.when(stands, F.struct("first", "last", "label", "cover")))
        ).alias("matches"),
    )
    return per_row.select(
        "doc.doc_id", "doc.n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"
    )


def op2_license_scan(spark, sf_dir) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("matches")
