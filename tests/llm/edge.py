"""Rows that every corpus operator has to take: nulls, empty and long texts, repeats, clashing columns."""

import random

# Names that operators use inside; as extra columns of the input they must not matter.
CLASHING = [
    "row", "root", "size", "score", "label", "shard", "slot", "prefix", "digest", "stretch", "place", "uid", "n",
    "copies", "_id", "_hash", "text_hash", "component_id", "kept", "bands", "tid", "w", "ids", "predicted", "log_chars",
]

PLAIN = "the quick brown fox jumps over the lazy dog while seven wizards quietly boil a large kettle of soup today"


def long_text(words: int = 60_000) -> str:
    r = random.Random(5)
    return " ".join("".join(r.choices("abcdefghinrst", k=r.randint(1, 9))) for _ in range(words))


def edge_rows() -> list[tuple]:
    return [
        (1, PLAIN),
        (1, PLAIN),
        (2, None),
        (3, ""),
        (None, PLAIN + " once more"),
        (None, None),
        (5, "   \n\t "),
        (6, "one"),
        (7, long_text()),
        (8, "é" * 50_000),
        (9, PLAIN),
        (10, "naïve Straße 日本語 🙂 " + PLAIN),
        (-4, PLAIN.upper()),
    ]


def frame(spark, rows, extra=True, kinds="doc_id bigint, text string"):
    """A table of the rows, with a clashing column of each kind of name if ``extra``."""
    if not extra:
        return spark.createDataFrame(rows, kinds)
    width = kinds.count(",") + 1
    names = kinds + "".join(f", `{c}` string" for c in CLASHING)
    return spark.createDataFrame([tuple(r[:width]) + ("x",) * len(CLASHING) for r in rows], names)


def empty(spark, kinds="doc_id bigint, text string"):
    return spark.createDataFrame([], kinds)


def as_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)
