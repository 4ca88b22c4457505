"""Quality rules: statistics of whole texts, judged by an isolation forest.

Each tree splits its own draw of all documents at random: a random statistic at a random value. A document
that few splits set apart from the draw is unusual; its mean path is short. The score from
which documents are turned away is calibrated on all labelled rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipwire.llm.common import joined_apart, stored

#: Trees, and documents that each of them draws from all.
TREES, DRAWN = 128, 256
#: Ranges of scores that the threshold is looked for in.
RANGES = 4096
#: Least share of good labelled documents that the threshold keeps.
KEEP_GOOD = 0.98

GAPS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"
_SYMBOL_BYTES = SYMBOLS.encode()

BASE = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
RULES = (
    "log_words word_length symbol_share dup_line_share repeat_share capital_share "
    "digit_share mark_share short_line_share distinct_share ending_share letter_share"
).split()


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of ``BASE`` and the rule statistics of ``RULES``; null has no words.

    Words are parted by ASCII white space. ``n_repeat_words`` counts words that stand in a window
    of three words found twice or more in the text, each word once.
    """
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, GAPS))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    dup_lines = len(lines) - len(set(lines))
    codes: dict[bytes, int] = {}
    w = np.fromiter((codes.setdefault(x, len(codes)) for x in words), np.int64, n)
    repeated = 0
    if n > 3:
        k = len(codes)
        if k < 2_000_000:  # three codes fit into 63 bits
            key = (w[:-2] * k + w[1:-1]) * k + w[2:]
            _, back, count = np.unique(key, return_inverse=True, return_counts=True)
            found = count[back] > 1
        else:
            seen = Counter(zip(words, words[1:], words[2:]))
            found = np.array([seen[x] > 1 for x in zip(words, words[1:], words[2:])])
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= found
        repeated = int(covered.sum())
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    symbols = int(sum(count[b] for b in _SYMBOL_BYTES))
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    letters = upper + lower + int(count[192:].sum())  # lead bytes stand for letters beyond ASCII
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    ends = sum(x.rstrip()[-1:] in b".!?:;\"'" for x in lines)
    each, size = max(n, 1), max(len(raw), 1)
    rules = [
        float(np.log1p(n)),
        chars / each,
        symbols / each,
        dup_lines / max(len(lines), 1),
        repeated / each,
        upper / max(upper + lower, 1),
        int(count[48:58].sum()) / size,
        marks / size,
        sum(len(x) < 30 for x in lines) / max(len(lines), 1),
        min(len(codes) / each ** 0.9, 2.0),
        ends / max(len(lines), 1),
        letters / size,
    ]
    return [n, chars, symbols, dup_lines, repeated], rules


@dataclass
class Forest:
    """Trees in heap order: feature (-1: leaf), cut, and path length at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    drawn: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; higher for rows that few splits set apart."""
        if not len(self.feature):
            return np.zeros(len(x))
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, path in zip(self.feature, self.cut, self.path):
            node = np.zeros(len(x), int)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / _expected(self.drawn))


def _expected(n) -> float:
    """Mean path of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(
    x: np.ndarray, trees: int = TREES, drawn: int = DRAWN, seed: int = 11, of_tree: np.ndarray | None = None
) -> Forest:
    """A forest over the rows of ``x``; each tree draws some of them, or has those that ``of_tree`` gives it."""
    r = np.random.default_rng(seed)
    drawn = min(drawn, len(x) if of_tree is None else int((of_tree == 0).sum()))
    depth = int(np.ceil(np.log2(max(drawn, 2))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees if drawn else 0, nodes), -1)
    cut, path = np.zeros(feature.shape), np.zeros(feature.shape)
    for t in range(len(feature)):
        own = r.choice(len(x), drawn, replace=False) if of_tree is None else np.flatnonzero(of_tree == t)
        todo = [(0, own, 0)]
        while todo:
            node, rows, level = todo.pop()
            part = x[rows]
            low, high = part.min(0), part.max(0)
            wide = np.flatnonzero(high > low)
            if level == depth or len(rows) < 2 or not len(wide):
                path[t, node] = level + _expected(len(rows))
                continue
            f = r.choice(wide)
            at = r.uniform(low[f], high[f])
            feature[t, node], cut[t, node] = f, at
            right = part[:, f] > at
            todo += [(2 * node + 1, rows[~right], level + 1), (2 * node + 2, rows[right], level + 1)]
    return Forest(feature, cut, path, drawn)


def threshold(scores: np.ndarray, good: np.ndarray, keep_good: float = KEEP_GOOD) -> float:
    """The score above which documents go: best balance of bad found and good lost.

    At least ``keep_good`` of the good ones stay. Without both kinds nothing goes.
    """
    if good.all() or not good.any():
        return np.inf
    best, at = 0.0, np.inf
    floor = np.quantile(scores[good], keep_good, method="higher")
    for cut in np.unique(scores[scores >= floor]):
        gain = (scores[~good] > cut).mean() - (scores[good] > cut).mean()
        if gain > best:
            best, at = gain, float(cut)
    return at


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts of ``BASE`` (long) and ``rules`` (array), one row per row of ``docs``."""
    schema = ", ".join(f"{c} bigint" for c in BASE) + ", rules array<double>"

    @F.pandas_udf(schema)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            both = [statistics(t) for t in texts]
            out = pd.DataFrame([b for b, _ in both], columns=BASE, dtype=np.int64)
            out["rules"] = [r for _, r in both]
            yield out

    return docs.select("doc_id", of("text").alias("m")).select("doc_id", "m.*")


def draws(rows: DataFrame, trees: int = TREES, drawn: int = DRAWN) -> DataFrame:
    """``tree``, ``rules``: for each tree ``drawn`` of all different rows, or all if there are fewer.

    A tree draws the rows with the least hashes of its number and all their columns, whatever other
    trees draw and however often a row is there. ``rows`` are read twice.
    """
    names = rows.columns
    hashed = rows.select(F.xxhash64(*names, *[F.col(c).isNull() for c in names]).alias("row"), "rules")
    distinct = hashed.agg(F.approx_count_distinct("row")).first()[0]
    share = min(1.0, 4.0 * drawn / max(distinct, 1))
    each = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), F.xxhash64(t, "row").alias("h"))
    )
    low = F.filter(each, lambda e: e["h"].cast("double") <= share * 2.0**64 - 2.0**63)
    thin = hashed.select("rules", F.inline(low)).dropDuplicates(["tree", "h"])
    rank = F.row_number().over(W.partitionBy("tree").orderBy("h"))
    return thin.withColumn("n", rank).where(F.col("n") <= drawn).select("tree", "rules")


def calibrated(rated: DataFrame, keep_good: float = KEEP_GOOD) -> float:
    """:func:`threshold` over all rows of ``rated``, which have ``anomaly`` (0 to 1) and ``good`` (boolean).

    Equal scores are counted together, then added up range by range; no row comes to the driver but the best.
    """
    counts = [F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b")]
    scores = stored(rated.groupBy("anomaly").agg(*counts), "rated-scores")
    scores = scores.withColumn("range", F.floor(F.col("anomaly") * RANGES))
    ranges = stored(scores.groupBy("range").agg(F.sum("g").alias("g"), F.sum("b").alias("b")), "rated-ranges")
    good, bad = ranges.agg(F.sum("g"), F.sum("b")).first()
    if not good or not bad:
        return np.inf
    up_to = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # RANGES rows at most
    zero = F.lit(0).cast("long")
    below = ranges.select("range", *[F.coalesce(F.sum(c).over(up_to), zero).alias(f"{c}_below") for c in "gb"])
    within = W.partitionBy("range").orderBy("anomaly").rowsBetween(W.unboundedPreceding, 0)
    kept = scores.join(F.broadcast(below), "range").select(
        "anomaly", *[(F.col(f"{c}_below") + F.sum(c).over(within)).alias(c) for c in "gb"]
    )
    gain = (bad - F.col("b")) / F.lit(bad) - (good - F.col("g")) / F.lit(good)
    floor = math.ceil(keep_good * (good - 1)) + 1
    allowed = kept.where(F.col("g") >= floor).select("anomaly", gain.alias("gain")).where("gain > 0")
    best = allowed.orderBy(F.desc("gain"), "anomaly").first()
    return best["anomaly"] if best else np.inf


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts of ``BASE``, ``base_failed``, ``anomaly`` (0 to 1) and ``kept``.

    ``base_failed``: under 50 words, or over half of them repeated. Each tree draws from all other
    documents, by a hash of their id and statistics; the threshold comes from
    all of them with a label (``quality`` 0 or 1; a document with several is good
    if one says so). Without good and bad labels no document is anomalous. Null texts have
    no words; equal texts are judged alike; repeated rows stay; other columns are ignored.
    """
    stats = stored(measured(docs), "rules").withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    drawn = draws(stats.where(~F.col("base_failed")).select("doc_id", "rules")).collect()
    drawn = sorted((r["tree"], r["rules"]) for r in drawn)
    x = np.array([rules for _, rules in drawn]).reshape(-1, len(RULES))
    forest = grow(x, of_tree=np.array([t for t, _ in drawn], int))

    @F.pandas_udf("double")
    def anomaly(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rules in batches:
            yield pd.Series(forest.scores(np.stack(rules.to_list()) if len(rules) else np.zeros((0, len(RULES)))))

    scored = stored(stats.withColumn("anomaly", anomaly("rules")), "anomalies")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
    passed = scored.where(~F.col("base_failed")).select("doc_id", "anomaly", F.xxhash64("rules").alias("row"))
    cut = calibrated(joined_apart(passed, known, "doc_id").distinct())
    kept = ~F.col("base_failed") & (F.col("anomaly") <= F.lit(float(cut)))
    return scored.select("doc_id", *BASE, "base_failed", "anomaly", kept.alias("kept"))
