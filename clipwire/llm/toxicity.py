"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text are densities of lexicon words, their nearness to words of the second
person, capitals, punctuation and obfuscated spellings. The lexicon is a short list of
plain insults and words that a bounded sample of labelled rows marks as toxic. Trees and
calibration are fitted in numpy on that sample, on rows apart from each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwire.llm.common import hash_sample, stored

#: Labelled rows that the lexicon, the trees and the calibration are fitted on.
SAMPLE = 8000
#: Words are learned from at least so many labelled rows, at this share of toxic ones.
LEARNED_ROWS, LEARNED_SHARE, LEARNED_MOST = 8, 0.9, 400
#: Lengths of the beginnings of words that are learned beside whole words.
STEMS = (5, 6, 7, 8)

#: Plain insults, before anything is learned.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb dumbass loser losers scum trash garbage pathetic "
    "worthless disgusting clown clowns fool imbecile jerk bastard bitch asshole shit fuck fucking "
    "cretin freak filth vermin idiota imbécil idiote connard salaud arschloch trottel".split()
)
#: Words of the second person.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te ti tus usted ustedes vosotros toi ton ta vous votre vos "
    "du dich dir dein deine ihr euch euer".split()
)
#: What stands for letters in obfuscated spellings.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

NEAR = 5
FEATURES = (
    "hits density learned_density distinct near_second_person second_person capitals shouted "
    "exclaimed punctuation obfuscated obfuscated_hits length"
).split()

_BREAKS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
_MIXED = re.compile(rb"[a-z]+[0-9@$!|*._\-]+[a-z][a-z0-9@$!|*._\-]*")
_SHOUT = re.compile(rb"(?<![A-Za-z])[A-Z]{2,}(?![A-Za-z])")
_SWAP = bytes.maketrans("".join(LOOKALIKES).encode(), "".join(LOOKALIKES.values()).encode())


class Lexicon:
    """Plain insults, learned words, and learned stems, which end in ``*``; as bytes."""

    def __init__(self, learned: frozenset[str]):
        self.plain = frozenset(w.encode() for w in INSULTS)
        self.learned = frozenset(w.encode() for w in learned if not w.endswith("*"))
        self.known = self.plain | self.learned
        self.stems = frozenset(w[:-1].encode() for w in learned if w.endswith("*"))
        self.sizes = sorted({len(w) for w in self.stems})
        self.heads = frozenset(w[:4] for w in self.stems)

    def marked(self, words: set[bytes]) -> set[bytes]:
        stemmed = (w for w in words if w[:4] in self.heads)
        return (words & self.known).union(
            w for w in stemmed if any(len(w) > k and w[:k] in self.stems for k in self.sizes)
        )


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The features of a whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    low = (text or "").lower().encode("utf-8", "surrogatepass")
    words = low.translate(_BREAKS).split()
    n = max(len(words), 1)
    present = set(words)
    marked = lexicon.marked(present)
    second = present & _SECOND
    at = [k for k, w in enumerate(words) if w in marked] if marked else []
    you = [k for k, w in enumerate(words) if w in second] if second else []
    near = 0
    if at and you:
        gap = np.searchsorted(you, at)
        spot = np.array([-(10**9), *you, 10**9])
        near = int((np.minimum(np.array(at) - spot[gap], spot[gap + 1] - np.array(at)) <= NEAR).sum())
    mixed = _MIXED.findall(low)
    hidden = 0
    for w in mixed:
        bare = w.translate(_SWAP, b"*._-")
        hidden += bare in lexicon.known
    chars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(chars[65:91].sum()), int(chars[97:123].sum())
    marks = int(chars[33:48].sum() + chars[58:65].sum() + chars[91:97].sum() + chars[123:127].sum())
    hits = len(at)
    return [
        np.log1p(hits + hidden),
        hits / n,
        sum(words[k] not in lexicon.plain for k in at) / n,
        float(len(marked)),
        near / n,
        len(you) / n,
        upper / max(upper + lower, 1),
        len(_SHOUT.findall(raw)) / n,
        (int(chars[33]) + int(chars[63])) / n,
        marks / max(len(raw), 1),
        len(mixed) / n,
        np.log1p(hidden),
        np.log1p(len(words)),
    ]


_SECOND = frozenset(w.encode() for w in SECOND_PERSON)


@dataclass
class Trees:
    """Boosted trees of fixed depth in heap order: feature and cut of each inner node."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), int)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total


def boost(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, least: float = 5.0
) -> Trees:
    """Trees for the log loss, by histograms of gradients over quantile bins."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T] if len(x) else []
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1) if len(x) else x
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    inner = 2**depth - 1
    out = Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(x) or y.min() == y.max():
        return out
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut, leaf = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(inner + 1)
        node = np.zeros(len(y), int)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = (1e-6, 0, None)
            if len(rows):
                all_g, all_h = g[rows].sum(), h[rows].sum()
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, f]
                    left_g = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                    right_g, right_h = all_g - left_g, all_h - left_h
                    gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - all_g**2 / (all_h + 1)
                    gain[(left_h < least / 10) | (right_h < least / 10)] = 0
                    at = int(gain.argmax())
                    if gain[at] > best[0]:
                        best = (gain[at], f, at)
            if best[2] is None:
                node[rows] = 2 * k + 1
            else:
                feature[k], cut[k] = best[1], cuts[best[1]][best[2]]
                node[rows] = 2 * k + 1 + (binned[rows, best[1]] > best[2])
        for k in range(inner + 1):
            rows = np.flatnonzero(node == inner + k)
            leaf[k] = -rate * g[rows].sum() / (h[rows].sum() + 1) if len(rows) else 0.0
        margin += leaf[node - inner]
        made.append((feature, cut, leaf))
    return Trees(base, *(np.stack(m) for m in zip(*made)))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising step line from margin to probability: pool adjacent violators."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum, count, first, last
    for m, t in zip(margin[order].tolist(), y[order].tolist()):
        blocks.append([t, 1, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, blocks[-1][2], last]
    at = np.array([v for b in blocks for v in (b[2], b[3])])
    # One more row of either kind keeps small blocks from 0 and 1.
    p = np.array([v for b in blocks for v in 2 * [(b[0] + 0.5) / (b[1] + 1)]])
    return at, np.maximum.accumulate(p)


@dataclass
class Model:
    learned: frozenset[str]
    trees: Trees
    at: np.ndarray
    probability: np.ndarray

    def scores(self, texts) -> np.ndarray:
        lexicon = Lexicon(self.learned)
        x = np.array([features(t, lexicon) for t in texts]).reshape(-1, len(FEATURES))
        if not len(self.at):
            return np.zeros(len(x))
        return np.interp(self.trees.margin(x), self.at, self.probability)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows that ``keep`` (of ``doc_id``) holds for.

    At most ``sample`` documents are learned from, those with the least hash of their id and label. A
    document with several labels is toxic if one says so, and one with several texts is the one of
    least hash; null ids and labels are left out. Without labelled rows all scores are 0.
    """
    known = labels.select("doc_id", "toxic").where(keep & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    ids = known.groupBy("doc_id").agg(F.max("toxic").alias("y"))
    ids = hash_sample(ids, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")
    rows = stored(rows.groupBy("doc_id", "y").agg(one), "toxic-sample")
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")
    stems = [F.transform("words", lambda w, k=k: F.when(F.length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*")))) for k in STEMS]
    terms = F.array_distinct(F.concat("words", *stems))
    said = rows.select("y", F.array_distinct(words).alias("words")).select("y", F.explode(terms).alias("word"))
    counts = said.groupBy("word")
    counts = counts.agg(F.sum("y").alias("toxic"), F.count("*").alias("n"))
    counts = counts.where((F.col("n") >= LEARNED_ROWS) & (F.col("toxic") >= LEARNED_SHARE * F.col("n")))
    counts = counts.where(F.length("word") > 1).orderBy(F.desc("toxic"), "word").limit(LEARNED_MOST)
    learned = frozenset(r["word"] for r in counts.collect())

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(learned)
        for texts in batches:
            yield pd.Series([features(t, lexicon) for t in texts])

    got = sorted(rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", "y", measured("text").alias("x")).collect())
    x = np.array([r["x"] for r in got]).reshape(-1, len(FEATURES))
    y = np.array([r["y"] for r in got], float)
    apart = np.arange(len(y)) % 3 == 0  # rows for the calibration
    trees = boost(x[~apart], y[~apart])
    at, probability = isotonic(trees.margin(x[apart]), y[apart]) if len(y) else (np.zeros(0), np.zeros(0))
    return Model(learned, trees, at, probability)


def scorer(model: Model):
    """A column function of the text: the probability that it is toxic."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts), dtype=float)

    return of


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) for every row of ``docs``, from its whole text.

    Null texts count as empty and have a score too. Equal texts have equal scores; repeated
    rows stay; other columns are ignored.
    """
    return docs.select("doc_id", scorer(model)("text").alias("score"))
