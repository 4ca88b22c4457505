"""Language identification by a small convolutional network over bytes.

Filters of several widths run over embedded bytes; each filter's largest answer within a window
goes to a softmax over the languages. Texts are cut into windows of fixed length, all of
them, and a text's scores are the mean of its windows' log probabilities, by length.

The network is trained in numpy on a bounded sample of labelled rows. For prediction the
embedding and the filters are folded into tables that are indexed by one or two bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipwire.llm.common import stored

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDED = 8
#: Labelled texts of each language that the network is trained on, and windows of each.
PER_LANGUAGE = 400
WINDOWS_EACH = 6
#: Languages that are learned at most, those with most texts.
MOST_LANGUAGES = 512
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")


def windows(text: str, window: int = WINDOW) -> np.ndarray:
    """All of a text's UTF-8 bytes as rows of ``window`` bytes; the last is filled with spaces."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    rows = np.full((-(-len(raw) // window), window), 32, np.uint8)
    rows.ravel()[: len(raw)] = raw
    return rows


@dataclass
class Network:
    """Weights; ``filters`` has an array (width, embedded, filters) for each width."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width (offset, table) pairs; tables of 65,536 rows go by two bytes."""
        out = []
        for f in self.filters:
            one = [(self.embedding @ f[k]).astype(np.float32) for k in range(len(f))]
            parts = []
            for k in range(0, len(f) - 1, 2):
                parts.append((k, (one[k][:, None] + one[k + 1][None]).reshape(65536, -1)))
            if len(f) % 2:
                parts.append((len(f) - 1, one[-1]))
            out.append(parts)
        return out

    def log_probabilities(self, rows: np.ndarray, tables) -> np.ndarray:
        """For each window, by tables; rows (windows, bytes)."""
        pairs = rows[:, :-1].astype(np.uint16) << np.uint16(8) | rows[:, 1:]
        pooled = []
        for f, parts in zip(self.filters, tables):
            steps = rows.shape[1] - len(f) + 1
            total = None
            for offset, table in parts:
                by = pairs if len(table) == 65536 else rows
                got = table.take(by[:, offset : offset + steps], axis=0)
                total = got if total is None else np.add(total, got, out=total)
            pooled.append(total.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return _log_softmax(hidden @ self.dense + self.dense_bias)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(
    texts: list[str],
    labels: list[str],
    epochs: int = 12,
    rate: float = 0.01,
    seed: int = 7,
    widths: tuple[int, ...] = WIDTHS,
) -> Network:
    """A network for the given texts; Adam on the cross entropy of single windows."""
    rows = [some_windows(text, k) for k, text in enumerate(texts)]
    return train_windows(rows, labels, epochs, rate, seed, widths)


def some_windows(text: str, seed: int) -> np.ndarray:
    """Up to ``WINDOWS_EACH`` windows of a text, without its last unless there is no other."""
    w = windows(text)
    if len(w) > 1:
        w = w[:-1]
    if len(w) > WINDOWS_EACH:
        w = w[np.random.default_rng(seed & (2**63 - 1)).choice(len(w), WINDOWS_EACH, replace=False)]
    return w


def train_windows(
    windows_of: list[np.ndarray],
    labels: list[str],
    epochs: int = 12,
    rate: float = 0.01,
    seed: int = 7,
    widths: tuple[int, ...] = WIDTHS,
) -> Network:
    """A network for the given windows of each text; Adam on the cross entropy of single windows."""
    languages = sorted(set(labels))
    r = np.random.default_rng(seed)
    rows = np.concatenate(windows_of) if windows_of else np.zeros((0, WINDOW), np.uint8)
    targets = np.array([languages.index(y) for w, y in zip(windows_of, labels) for _ in w], int)
    params = [
        r.normal(0, 0.3, (256, EMBEDDED)),
        *[r.normal(0, 1 / np.sqrt(w * EMBEDDED), (w, EMBEDDED, FILTERS)) for w in widths],
        np.zeros(FILTERS * len(widths)),
        r.normal(0, 0.2, (FILTERS * len(widths), len(languages))),
        np.zeros(len(languages)),
    ]
    params = [p.astype(np.float32) for p in params]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(rows))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            step += 1
            for p, m, v, g in zip(params, first, second, _gradients(params, rows[some], targets[some])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        rate *= 0.8
    n = len(widths)
    return Network(languages, params[0], params[1 : n + 1], *params[n + 1 :])


def _gradients(params: list[np.ndarray], rows: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
    embedding, filters, (bias, dense, dense_bias) = params[0], params[1:-3], params[-3:]
    shown = embedding[rows]
    pooled, best = [], []
    for f in filters:
        steps = rows.shape[1] - len(f) + 1
        answer = sum(shown[:, k : k + steps] @ f[k] for k in range(len(f)))
        best.append(answer.argmax(axis=1))
        pooled.append(np.take_along_axis(answer, best[-1][:, None], axis=1)[:, 0])
    raw = np.concatenate(pooled, axis=1) + bias
    hidden = np.maximum(raw, 0)
    wrong = np.exp(_log_softmax(hidden @ dense + dense_bias))
    wrong[np.arange(len(rows)), targets] -= 1
    wrong /= len(rows)
    back = (wrong @ dense.T) * (raw > 0)
    d_embedding = np.zeros_like(embedding)
    d_filters = []
    for n, f in enumerate(filters):
        g = back[:, n * FILTERS : (n + 1) * FILTERS]
        at = rows[np.arange(len(rows))[:, None, None], best[n][:, :, None] + np.arange(len(f))]
        d_filters.append(np.einsum("bf,bfke->kef", g, embedding[at], optimize=True))
        np.add.at(d_embedding, at, np.einsum("bf,kef->bfke", g, f, optimize=True))
    return [d_embedding, *d_filters, back.sum(0), hidden.T @ wrong, wrong.sum(0)]


def training_sample(
    docs: DataFrame, keep: Column, per_language: int = PER_LANGUAGE, most_languages: int = MOST_LANGUAGES
) -> DataFrame:
    """``lang``, ``h`` and ``windows`` of the texts to learn from.

    Of the ``most_languages`` languages with most usable texts, up to ``per_language`` different
    pairs of id and text each, those with the least hash ``h``. Usable are rows that ``keep`` holds for,
    with a language and a letter in the text; only they are counted. Up to ``WINDOWS_EACH`` windows of
    a text are cut in the tasks, so what comes to the driver is bounded in rows and in bytes.
    """
    usable = docs.where(keep & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("rows"))
    counts = stored(counts.orderBy(F.desc("rows"), "lang").limit(most_languages), "language-counts")
    some = usable.select("lang", "h").join(F.broadcast(counts), "lang")
    share = F.least(F.lit(1.0), F.lit(4.0 * per_language) / F.col("rows"))
    some = some.where(F.col("h").cast("double") <= share * 2.0**64 - 2.0**63).select("lang", "h").distinct()
    some = some.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("h")))
    chosen = stored(some.where(F.col("n") <= per_language).select("lang", "h"), "language-sample")

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([[w.tobytes() for w in some_windows(t, h)] for t, h in zip(texts, hashes)])

    rows = usable.join(F.broadcast(chosen), ["lang", "h"], "left_semi")
    return rows.select("lang", "h", cut("text", "h").alias("windows")).dropDuplicates(["lang", "h"])


def predict(network: Network, tables, texts, batch: int = 512) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text; windows are computed ``batch`` at a time."""
    lang, score = [UNDETERMINED] * len(texts), np.ones(len(texts))
    held, rows, count = [], [], 0

    def flush() -> None:
        whole = np.concatenate(rows)
        logs = np.concatenate(
            [network.log_probabilities(whole[k : k + batch], tables) for k in range(0, len(whole), batch)]
        )
        at = 0
        for k, n, last in held:
            weight = np.ones(n)
            weight[-1] = last / WINDOW
            z = weight @ logs[at : at + n] / weight.sum()
            at += n
            p = np.exp(z - z.max())
            lang[k], score[k] = network.languages[int(p.argmax())], p.max() / p.sum()

    for k, text in enumerate(texts):
        if not text or not network.languages or not _LETTER.search(text):
            continue
        w = windows(text)
        held.append((k, len(w), (len(text.encode("utf-8", "surrogatepass")) - 1) % WINDOW + 1))
        rows.append(w)
        count += len(w)
        if count >= 8 * batch:
            flush()
            held, rows, count = [], [], 0
    if held:
        flush()
    return lang, score


def predictor(network: Network):
    """A column function of the text: ``lang_pred`` and ``score``.

    Null texts and those without a letter are ``und`` with score 1.
    """

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = network.tables()
        for texts in batches:
            lang, score = predict(network, tables, texts)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return of


def fit(docs: DataFrame, keep: Column, per_language: int = PER_LANGUAGE) -> Network:
    """A network trained on at most ``per_language`` texts of each language."""
    sample = sorted(training_sample(docs, keep, per_language).collect())
    cut = [np.frombuffer(b"".join(r["windows"]), np.uint8).reshape(-1, WINDOW) for r in sample]
    return train_windows(cut, [r["lang"] for r in sample])


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for every row of ``docs``, from its whole text.

    ``score`` is the probability of the predicted language. A network without languages (no
    labelled row) says ``und``. Equal texts have equal results; repeated rows stay; other
    columns are ignored.
    """
    return docs.select("doc_id", predictor(network)("text").alias("found")).select("doc_id", "found.*")
