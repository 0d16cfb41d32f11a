"""Quality classifier: a sparse rule ensemble compiled into column expressions.

Statistics of a text are plain Spark expressions.  On a bounded sample of
labelled rows, shallow boosted trees are grown over these statistics; every
path from a root to a node is a conjunctive rule; a logistic regression with
lasso penalty weighs the rules (and the statistics themselves, clipped) and
drops most of them.  What is left is one Spark expression again, so scoring a
corpus is a projection: no Python, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.llm.tables import pick, table

#: Labelled rows that the model is fitted on, at most: those with the smallest hash of their id.
SAMPLE = 10_000
#: A document is accepted from this score.
ACCEPT = 0.7


def _share(chars: str, of: Column) -> Column:
    """Share of the text's characters that are among ``chars``."""
    n = F.char_length(of)
    return (n - F.char_length(F.translate(of, chars, ""))) / F.greatest(n, F.lit(1))


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; all are defined for null and empty texts."""
    t = F.coalesce(text, F.lit(""))
    n = F.char_length(t)
    words = F.split(t, " ", -1)
    lines = F.split(t, "\n", -1)
    return {
        "log_chars": F.log1p(n.cast("double")),
        "word_chars": n / F.size(words),
        "line_chars": F.log1p(n / F.size(lines)),
        "distinct_words": F.size(F.array_distinct(words)) / F.size(words),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "lower": _share("etaoinsrhl", t),
        "upper": _share("ABCDEFGHIJKLMNOPQRSTUVWXYZ", t),
        "digits": _share("0123456789", t),
        "stops": _share(".,;:!?", t),
        "hashes": _share("#$%&*@^~", t),
        "bars": _share("|<>{}[]\\/_=+", t),
        "quotes": _share("\"'`()-", t),
        "wide": (F.octet_length(t) - n) / F.greatest(n, F.lit(1)),
    }


#: The statistics, in the order of the model's inputs.
NAMES = (
    "log_chars", "word_chars", "line_chars", "distinct_words", "distinct_lines", "lower", "upper", "digits",
    "stops", "hashes", "bars", "quotes", "wide",
)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, threshold); above means >."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, cut in self.terms:
            out = out & ((F.col(name) > cut) if above else (F.col(name) <= cut))
        return out

    def holds(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, cut in self.terms:
            v = x[:, names.index(name)]
            out &= (v > cut) if above else (v <= cut)
        return out


@dataclass
class RuleModel:
    """bias + weighted rules + weighted clipped statistics, through a logistic link."""

    bias: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)
    linear: list[tuple[str, float, float, float]] = field(default_factory=list)  # name, low, high, weight
    fitted: bool = True

    def score(self) -> Column:
        """The score as an expression over the statistics' columns."""
        total = F.lit(float(self.bias))
        for rule, w in self.rules:
            total = total + F.when(rule.column(), F.lit(float(w))).otherwise(F.lit(0.0))
        for name, low, high, w in self.linear:
            total = total + F.least(F.greatest(F.col(name), F.lit(float(low))), F.lit(float(high))) * F.lit(float(w))
        return 1 / (1 + F.exp(-total))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def grow_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], trees: int = 40, depth: int = 3) -> list[Rule]:
    """Paths of boosted trees, each path once."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 34)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    f, rules = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), {}
    for _ in range(trees):
        p = _sigmoid(f)
        g, h = y - p, p * (1 - p) + 1e-6
        step = np.zeros(len(y))
        todo = [(np.arange(len(y)), (), 0)]
        while todo:
            rows, path, d = todo.pop()
            best = (1e-3, None, None)
            total_g, total_h = g[rows].sum(), h[rows].sum()
            if d < depth and len(rows) >= 20:
                for j, c in enumerate(cuts):
                    left_g = np.cumsum(np.bincount(bins[rows, j], g[rows], len(c) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(bins[rows, j], h[rows], len(c) + 1))[:-1]
                    left_n = np.cumsum(np.bincount(bins[rows, j], minlength=len(c) + 1))[:-1]
                    gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1)
                    gain = np.where((left_n >= 5) & (len(rows) - left_n >= 5), gain - total_g**2 / (total_h + 1), 0)
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), j, int(gain.argmax()))
            if best[1] is None:
                step[rows] = total_g / (total_h + 1)
                continue
            _, j, k = best
            for above in (False, True):
                part = rows[(bins[rows, j] > k) == above]
                terms = (*path, (names[j], above, float(cuts[j][k])))
                rules[frozenset(terms)] = Rule(terms)
                todo.append((part, terms, d + 1))
        f = f + 0.3 * step
    return list(rules.values())


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient steps."""
    n = len(y)
    v = np.ones(z.shape[1], z.dtype)
    for _ in range(20):  # largest curvature
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v) + 1e-12
    rate = 1 / (0.25 * (np.linalg.norm(z @ v) ** 2 / n + 1) + 1e-9)
    w, b, t = np.zeros(z.shape[1], z.dtype), 0.0, 1.0
    ahead_w, ahead_b = w, b
    for _ in range(rounds):
        r = _sigmoid(z @ ahead_w + ahead_b) - y
        new_w = ahead_w - rate * (z.T @ r) / n
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * penalty, 0)
        new_b = ahead_b - rate * r.mean()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = (t - 1) / new_t
        ahead_w, ahead_b = (new_w + ahead * (new_w - w)).astype(z.dtype), new_b + ahead * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, b


def fit(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = NAMES, penalty: float = 2e-4) -> RuleModel:
    """A rule model of 0/1 labels; without both labels the constant share of label 1 (``fitted`` is false)."""
    if len(np.unique(y)) < 2:
        return RuleModel(bias=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), fitted=False)
    rules = grow_rules(x, y, names)
    holds = np.stack([r.holds(x, names) for r in rules], axis=1) if rules else np.zeros((len(x), 0))
    if rules:  # rules that hold for the same rows are one
        _, first = np.unique(holds, axis=1, return_index=True)
        rules, holds = [rules[k] for k in sorted(first)], holds[:, sorted(first)]
    low, high = np.quantile(x, [0.02, 0.98], axis=0)
    scale = np.clip(x, low, high).std(axis=0) / 0.4
    used = scale > 1e-9
    z = np.hstack([holds, np.clip(x, low, high)[:, used] / scale[used]]).astype(np.float32)
    center = z.mean(axis=0, dtype=float)
    z -= center.astype(np.float32)
    w, b = lasso_logistic(z, y.astype(np.float32), penalty)
    b -= float(center @ w)
    linear = [
        (names[j], low[j], high[j], w[len(rules) + k] / scale[j])
        for k, j in enumerate(np.flatnonzero(used))
        if w[len(rules) + k]
    ]
    return RuleModel(b, [(r, w[k]) for k, r in enumerate(rules) if abs(w[k]) > 1e-3], linear)


def _fold(of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


def sample_labels(labels: DataFrame, label: str, folds: int, held: int, size: int) -> DataFrame:
    """At most ``size`` labelled ids outside the held-out fold, the same ones in every run."""
    rows = pick(labels, ("doc_id", "bigint"), (label, "int")).where(
        F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (_fold(folds) != held)
    )
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(size)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Fit the model on labelled rows whose crc32(doc_id) mod 4 is not 2."""
    chosen = sample_labels(labels, "quality", 4, 2, sample)  # bounded, so it may be broadcast
    rows = pick(docs, ("doc_id", "bigint"), ("text", "string")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select(
        "doc_id",
        "quality",
        F.xxhash64("text").alias("_text"),
        *[c.alias(k) for k, c in statistics(F.col("text")).items()],
    )
    # Ids may repeat on either side, so the bound is set once more, on the statistics alone.
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "_text").limit(2 * sample).toArrow()
    x = np.stack([got[k].to_numpy() for k in NAMES], axis=1).astype(float) if len(got) else np.zeros((0, len(NAMES)))
    return fit(x, got["quality"].to_numpy().astype(int))


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text); null counts as empty."""
    rows = pick(docs, ("doc_id", "bigint"), ("text", "string"))
    return rows.select("doc_id", *[c.alias(k) for k, c in statistics(F.col("text")).items()]).select(
        "doc_id", model.score().alias("score")
    )


def keep_good(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``docs`` without the rows that score under ``accept``; same columns.

    Without labels of both kinds nothing is known, and everything is kept.
    """
    model = train(docs, labels)
    if not model.fitted:
        return docs
    # A filter over a projection would be pushed below it, with every statistic spelt out in
    # each rule that uses it; it cannot pass a generator, so each is computed once.
    named = F.struct(*[c.alias(k) for k, c in statistics(docs["text"].cast("string")).items()])
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),  # the caller's names cannot clash with ours
        F.inline(F.array(named)),
    )
    return rows.where(model.score() >= accept).select("row.*")


def op7_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id",
        F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
