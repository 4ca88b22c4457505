"""Importance resampling beside a plain count of words and runs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clipwire.llm import resampling


def plain(docs, target, run=2, least=20, per_cent=25):
    def features(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[k : k + n]) for n in range(1, run + 1) for k in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % 10_000 for f in runs]

    made = [(d, *features(t)) for d, t in docs]
    source = Counter(b for *_, f in made for b in f)
    wanted = Counter(b for t in target for b in features(t)[1])
    s_all, t_all = float(source.total()), float(wanted.total())
    out = []
    for d, words, f in made:
        gain = [
            math.floor(1000 * math.log((wanted[b] + 1.0) * (s_all + 10_000) / ((source[b] + 1.0) * (t_all + 10_000))))
            for b in f
        ]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(f), weight, score, None, words])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: len(fit) * per_cent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def ours(df):
    rows = df.select("doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.fixture
def target(spark):
    return lambda texts: spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


def test_like_plain_counts(documents, target, words):
    texts = [" ".join(words(k % 17, 5 + 7 * (k % 11))) for k in range(120)]
    texts += ["Été ÉTÉ 12-Ab\x00c, d_e\tf`g{h", None, "", "--", "one", "A " * 500 + "z"]
    wanted = [" ".join(words(k, 40)) for k in (3, 5)] + [None, ""]
    got = ours(resampling.resample(documents(texts, {"weight": 1, "h": 2}), target(wanted)))
    assert got == plain(list(enumerate(texts)), wanted)


def test_longer_runs(documents, target, words):
    texts = [" ".join(words(k, 25)) for k in range(30)]
    got = ours(resampling.resample(documents(texts), target(texts[:3]), run=4, per_cent=100))
    assert got == plain(list(enumerate(texts)), texts[:3], run=4, per_cent=100)


def test_slices_do_not_matter(words):
    texts = pa.array([" ".join(words(k, 30)) if k % 5 else None for k in range(50)])
    gain = np.arange(resampling.BUCKETS)
    whole = resampling.Features(texts)
    parts = [resampling.Features(t) for _, t in resampling.slices(texts, 500)]
    assert len(parts) > 5
    assert (whole.counts() == sum(p.counts() for p in parts)).all()
    assert (np.stack(whole.weigh(gain)) == np.concatenate([p.weigh(gain) for p in parts], axis=1)).all()


def test_hot_and_null_ids(spark, documents, target, words):
    text = " ".join(words(1, 30))
    docs = documents([text] * 3000).withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 3))
    found = resampling.resample(docs, target([text])).collect()
    drawn = sorted(r["rank"] for r in found if r["rank"])
    assert len(found) == 3000 and drawn == list(range(1, 751))
    best = {r["doc_id"]: r["score"] for r in found}
    assert len({r["doc_id"] for r in found if r["rank"]}) == 1
    assert max(best, key=best.get) in {r["doc_id"] for r in found if r["rank"]}


def test_empty_tables(documents, target):
    assert ours(resampling.resample(documents([]), target([]))) == []
    got = ours(resampling.resample(documents(["a b"]), target([])))
    assert got == plain([(0, "a b")], [])


def test_looks_like_the_target(documents, target, words):
    texts = [" ".join(words(k % 2 * 1000 + k // 2 % 3, 60)) for k in range(400)]
    wanted = [" ".join(words(1000 + k, 60)) for k in range(3)]
    found = resampling.resample(documents(texts), target(wanted)).collect()
    drawn = [r["doc_id"] for r in found if r["rank"]]
    assert len(drawn) == 100 and sum(d % 2 for d in drawn) >= 60
