"""URL filter: allow and block rules, and gradient-boosted trees for all other URLs.

A rule names a host and the start of a path; it fits that host and its
subdomains, and the longest fitting rule decides.  URLs that a rule decides are
labelled URLs.  Boosted trees learn from them what blocked URLs look like:
lengths, depth, digit ratios, entropies, parameter counts and the share of
blocked URLs among those with the same host suffix.

Host and path are Spark expressions.  The suffix statistics count *all*
labelled URLs in one aggregation over a fixed number of hash buckets, so their
size does not depend on the data.  The trees are fitted on a bounded sample of
labelled URLs; every URL is scored, Arrow batch by Arrow batch, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.llm.bytes_kernel import texts
from adfuse.llm.tables import UPPER, pick, table

#: Labelled URLs that the trees are fitted on, at most: those with the smallest hash.
SAMPLE = 20_000
#: Hash buckets of the suffix statistics, for each of the two suffix lengths.
BUCKETS = 1 << 16
#: A URL is blocked from this score.
BLOCK_FROM = 0.5
#: URLs scored at once.
ROWS = 2048


@dataclass(frozen=True)
class Rule:
    """``host`` (and its subdomains) with paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(name, verdict) of the longest rule that fits; null if none does.

    Of equally long rules the longer host wins, then block.  All rules become
    one expression, so this is for lists of some hundred rules.
    """
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(str(r)), len(r.host), r.verdict == "block", str(r))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(str(r)).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _suffix(host: Column, labels: int) -> Column:
    """Bucket of the last ``labels`` labels of the host."""
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -labels), F.lit(labels)), F.lit(BUCKETS)).cast("int")


#: Inputs of the trees; the last two are the suffix statistics.
NAMES = (
    "url_length", "url_digits", "url_upper", "url_percents", "url_dashes", "url_others", "url_entropy",
    "host_length", "host_digits", "host_dashes", "host_labels", "host_entropy",
    "path_length", "path_digits", "path_depth", "path_dots", "path_entropy",
    "query_length", "query_parameters", "query_fragments",
    "suffix_share", "domain_share",
)


class _Counted:
    """Byte counts of each row of a string column."""

    def __init__(self, column) -> None:
        raw, at = texts(column)
        n = len(at) - 1
        owner = np.repeat(np.arange(n), np.diff(at))
        self.length = np.diff(at).astype(float)
        self.of = np.bincount(owner * 256 + raw[at[0] : at[-1]], minlength=256 * n).reshape(n, 256)

    def count(self, chars: str) -> np.ndarray:
        return self.of[:, np.frombuffer(chars.encode(), np.uint8)].sum(axis=1).astype(float)

    def share(self, chars: str) -> np.ndarray:
        return self.count(chars) / np.maximum(self.length, 1)

    def entropy(self) -> np.ndarray:
        """Bits per byte."""
        p = self.of / np.maximum(self.length, 1)[:, None]
        return -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)


DIGITS, LOWER = "0123456789", UPPER.lower()


def lexical(url, host, path, query) -> np.ndarray:
    """The lexical features of each row of four string columns."""
    u, h, p, q = (_Counted(c) for c in (url, host, path, query))
    parameters = q.count("&;") + (q.count("?") > 0)
    return np.stack(
        [
            *(u.length, u.share(DIGITS), u.share(UPPER), u.count("%"), u.count("-_")),
            *(1 - u.share(DIGITS + UPPER + LOWER) - (u.length == 0), u.entropy()),
            *(h.length, h.share(DIGITS), h.count("-"), h.count(".") + (h.length > 0), h.entropy()),
            *(p.length, p.share(DIGITS), p.count("/"), p.count("."), p.entropy()),
            *(q.length, parameters, q.count("#")),
        ],
        axis=1,
    )


@dataclass
class Suffixes:
    """Labelled URLs by fold, suffix length, label and bucket; every label weighs one half of the whole."""

    counts: np.ndarray

    def weights(self) -> np.ndarray:
        n = self.counts[:, 0].sum(axis=(0, 2))
        return n.sum() / (2 * np.maximum(n, 1))

    def features(self, buckets: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        """Smoothed share of blocked URLs by suffix; one half for a suffix never seen.

        Rows that the trees are fitted on name their ``fold`` and see the
        other one's counts: a statistic that holds a row's own label gives it away.
        """
        all_folds, out = self.counts.sum(axis=0), []
        w = self.weights()
        for k in range(2):
            at = buckets[:, k]
            n = (all_folds[k][:, at] if fold is None else 2 * self.counts[1 - fold, k, :, at].T) * w[:, None]
            out.append((n[1] + 5) / (n[0] + n[1] + 10))
        return np.stack(out, axis=1)


@dataclass
class Trees:
    """Complete binary trees of equal depth: the input and threshold of every inner node, and the leaves' values."""

    depth: int
    rate: float = 0.2
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for inputs, cuts, leaves in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, inputs[node]] > cuts[node])
            total += self.rate * leaves[node - len(inputs)]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 32, least: int = 10
) -> Trees:
    """Newton boosting of the logistic loss over quantile bins; both labels weigh the same.

    A node without a useful split sends all rows to the left.
    """
    weight = len(y) / 2 / np.where(y > 0, max(y.sum(), 1), max(len(y) - y.sum(), 1))
    values = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins), method="nearest")) for j in range(x.shape[1])]
    cuts = [(v[1:] + v[:-1]) / 2 for v in values]
    place = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    model, total = Trees(depth), np.zeros(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        g, h = weight * (y - p), weight * p * (1 - p)
        inputs, at = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for d in range(depth):
            first, width = 2**d - 1, 2**d
            best = np.full(width, 1e-3)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                cell, shape = (node - first) * bins + place[:, j], (width, bins)
                sums = [np.bincount(cell, w, width * bins).reshape(shape).cumsum(axis=1) for w in (g, h, None)]
                (lg, lh, ln), (tg, th, tn) = sums, (s[:, -1:] for s in sums)
                gain = lg**2 / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1) - tg**2 / (th + 1)
                gain = np.where((ln >= least) & (tn - ln >= least), gain, 0)[:, : len(c)]
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                for i in np.flatnonzero(top > best):
                    best[i], inputs[first + i], at[first + i] = top[i], j, c[k[i]]
            node = 2 * node + 1 + (x[np.arange(len(y)), inputs[node]] > at[node])
        leaf, size = node - len(inputs), 2**depth
        leaves = np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + 1)
        total += model.rate * leaves[leaf]
        model.trees.append((inputs, at, leaves))
    return model


@dataclass
class UrlModel:
    suffixes: Suffixes
    trees: Trees | None  # none without labels of both kinds

    def score(self, parts: list, buckets: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(buckets))
        return self.trees.score(np.hstack([lexical(*parts), self.suffixes.features(buckets)]))


def _parts(url: Column) -> dict[str, Column]:
    """The columns that features are computed from."""
    u = F.coalesce(url, F.lit(""))
    host = host_of(u)
    return {
        "url": u,
        "host": host,
        "path": path_of(u),
        "query": F.regexp_extract(_rest(u), r"^[^?#]*", 0),
        "b1": _suffix(host, 1),
        "b2": _suffix(host, 2),
    }


def with_parts(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the parts of ``url``."""
    parts = _parts(F.col("url"))
    parts["query"] = F.substr(_rest(parts["url"]), F.char_length(parts["query"]) + 1)
    return df.select(*keep, *[c.alias(k) for k, c in parts.items()])


PARTS = ("url", "host", "path", "query")


def train(labelled: DataFrame, sample: int = SAMPLE) -> UrlModel:
    """Fit the model on ``labelled`` (key, url, blocked).

    ``blocked`` is 0 or 1; rows with any other value or none are left out.
    ``key`` only spreads the sample, so rows that share one URL do not stand
    or fall together.  Equal rows count as often as they occur.  Without
    labels of both kinds nothing is learned: every score is 0.
    """
    rows = pick(labelled, ("key", "string"), ("url", "string"), ("blocked", "int")).where(F.col("blocked").isin(0, 1))
    spread = F.xxhash64("url", "key")
    rows = with_parts(rows, "key", "blocked").withColumn("fold", F.pmod(spread, F.lit(2)).cast("int"))
    counts = np.zeros((2, 2, 2, BUCKETS))
    counted = (
        rows.select("fold", "blocked", F.posexplode(F.array("b1", "b2")).alias("k", "bucket"))
        .groupBy("fold", "k", "blocked", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()  # at most 8 * BUCKETS rows
    )
    counts[tuple(counted[c].to_numpy() for c in ("fold", "k", "blocked", "bucket"))] = counted["n"].to_numpy()
    suffixes, n = Suffixes(counts), counts[:, 0].sum()
    if not counts[:, 0].sum(axis=(0, 2)).all():
        return UrlModel(suffixes, None)
    place = F.pmod(F.shiftright(spread, 1), F.lit(1 << 30))
    if n > 2 * sample:  # about twice the sample goes on to the sort, however many rows there are
        rows = rows.where(place <= int((1 << 30) * 2 * sample / n))
    rows = rows.orderBy(place, spread, "url", "key", "blocked").limit(sample)
    got = rows.select(*PARTS, "b1", "b2", "fold", "blocked").toArrow()
    y = got["blocked"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return UrlModel(suffixes, None)
    blocks = [lexical(*[got[c].slice(lo, ROWS) for c in PARTS]) for lo in range(0, len(got), ROWS)]
    buckets = np.stack([got["b1"].to_numpy(), got["b2"].to_numpy()], axis=1)
    x = np.hstack([np.concatenate(blocks), suffixes.features(buckets, got["fold"].to_numpy())])
    return UrlModel(suffixes, grow(x, y))


def score_urls(rows: DataFrame, model: UrlModel) -> DataFrame:
    """``rows`` (of ``with_parts``) with ``score``, the likelihood of being blocked."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # 4 MB of statistics and the trees
    names = rows.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                buckets = np.stack([batch.column("b1").to_numpy(), batch.column("b2").to_numpy()], axis=1)
                found = shared.value.score([batch.column(c) for c in PARTS], buckets)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*names, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(score, f"{kinds}, score double")


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """A verdict for every row of ``pages`` (page_id, url).

    Returns page_id, host, path, rule (null if none fits), verdict (of the
    longest rule that fits, else of the trees) and score.  A null URL and one
    without ``://`` have an empty host and path, so no rule fits them; the
    trees judge them by what is there.  Repeated rows and rows without id are
    judged like any other; an empty table gives no rows.  If the rules decide
    URLs of one kind only, all others are allowed.
    """
    urls = pick(pages, ("page_id", "bigint"), ("url", "string"))
    rows = with_parts(urls, "page_id")
    ruled = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    labelled = ruled.where(F.col("_rule").isNotNull()).select(
        F.col("page_id").alias("key"), "url", (F.col("_rule.verdict") == "block").cast("int").alias("blocked")
    )
    scored = score_urls(rows, train(labelled, sample))
    found = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        found["name"].alias("rule"),
        F.coalesce(found["verdict"], own).alias("verdict"),
        "score",
    )


def op13_url_filter(spark, sf_dir) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
