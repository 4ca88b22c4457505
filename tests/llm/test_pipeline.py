import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from clipwire.llm import simhash
from clipwire.llm.common import stored
from clipwire.llm.queries import MIX_WEIGHTS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that come out of each stage over a whole table, by name."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in pipeline.STAGES:
        columns = docs.columns
        docs = stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns or name == "packing"
        out[name] = docs.collect()
    return out


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_only_take_rows_away(stages):
    names = ["documents", *[n for n, _ in pipeline.STAGES[:-1]]]
    for before, after in zip(names, names[1:]):
        times = pipeline.EPOCHS if after == "mixing" else 1
        assert not Counter(stages[after]) - Counter(stages[before] * times)


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    insults = ("idiot", "moron", "scum", "pathetic", "worthless", "disgusting")
    kept = {r.doc_id for r in stages["toxicity"]}
    said = [r.doc_id for r in stages["documents"] if toxic.get(r.doc_id) and any(w in r.text for w in insults)]
    clean = [d for d, t in toxic.items() if t == 0]
    assert sum(d in kept for d in said) <= 0.1 * len(said)
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)


def test_clear_languages_stay(stages):
    assert len(stages["language"]) >= 0.98 * len(stages["toxicity"])


def test_one_of_near_copies_stays(stages):
    """Against all pairs: copies at 0.9 or more go, documents under 0.5 to all others stay."""
    rows = stages["language"]
    sets = {r.doc_id: shingles(r.text) for r in rows}
    by_shingle, near, far = {}, [], set(sets)
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in by_shingle.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        alike = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if alike >= 0.9:
            near.append((a, b))
        if alike >= 0.5:
            far -= {a, b}
    kept = {r.doc_id for r in stages["near duplicates"]}
    assert near and sum(a in kept and b in kept for a, b in near) <= 0.05 * len(near)
    assert far <= kept


def filled(weights, held, budget):
    """Plain water-filling: shares by weight, no more than each holds."""
    share, open_ = {}, dict(weights)
    while open_:
        each = (budget - sum(share.values())) / sum(open_.values())
        full = [k for k, w in open_.items() if held[k] <= w * each]
        if not full:
            return share | {k: w * each for k, w in open_.items()}
        for k in full:
            share[k] = held[k]
            del open_[k]
    return share


def test_mixture_has_the_target_shares(stages):
    def by(rows, level):
        out = Counter()
        for r in rows:
            domain = f"domain{int(re.search('([0-9]*)$', r.source or '')[1] or 0) % 4}"
            out[domain if level == "domain" else (domain, r.lang or "none")] += len(r.text.encode().split())
        return out

    before, after = stages["near duplicates"], stages["mixing"]
    total = sum(by(before, "domain").values())
    held = {k: pipeline.EPOCHS * n for k, n in by(before, "domain").items()}
    want = filled({k: MIX_WEIGHTS["domain"][k] for k in held}, held, total)
    got = by(after, "domain")
    longest = max(len(r.text.split()) for r in before)
    leaves = len({(r.source, r.lang) for r in before})
    for k, n in want.items():
        assert n <= got[k] <= n + leaves * longest and abs(got[k] - n) < 0.1 * total
    # Domains that hold their targets have shares by weight, languages within them too.
    assert abs(got["domain0"] / sum(got.values()) - 0.4) < 0.05
    for domain in want:
        mine = {k: pipeline.EPOCHS * n for k, n in by(before, "lang").items() if k[0] == domain}
        langs = filled({k: MIX_WEIGHTS["lang"].get(k[1], 1) for k in mine}, mine, want[domain])
        found = by(after, "lang")
        assert all(n - 1 <= found[k] < n + 0.1 * total for k, n in langs.items())
    assert max(Counter(r.doc_id for r in after).values()) <= pipeline.EPOCHS


def test_mixture_takes_rows_not_ids(spark, documents, words):
    """Null and repeated ids: each row is a document of its own, with its own leaf."""
    df = documents([" ".join(words(k, 30)) for k in range(900)])
    df = df.withColumn("source", F.concat(F.lit("src"), F.col("doc_id") % 4))
    df = df.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 50))
    rows = pipeline.mix_sources(spark, df, SF).collect()
    share = Counter(r.source for r in rows)
    assert [round(share[f"src{k}"] / len(rows), 1) for k in range(4)] == [0.4, 0.3, 0.2, 0.1]
    nulls = sum(r.doc_id is None for r in rows)
    assert abs(nulls / len(rows) - 1 / 3) < 0.06


def test_packing_has_every_token_of_the_mixture(stages):
    pieces = stages["packing"]
    times = Counter(r.doc_id for r in stages["mixing"])
    assert {r.doc_id for r in pieces} == set(times)
    got = Counter()
    for r in pieces:
        got[r.doc_id] += r.length
    assert all(got[r.doc_id] == times[r.doc_id] * r.doc_tokens for r in pieces)


def test_run_is_its_stages(spark):
    small = "/root/testdata/sf0.001"
    rows = pipeline.run(spark, small)
    assert rows.columns == "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    assert rows.count() > 0


def test_odd_documents(spark, documents, words):
    long = " ".join(words(3, 20_000))
    texts = [None, "", "12", long, long, "you are a pathetic idiot and scum", " ".join(words(4, 60))]
    df = documents(texts, {"fp": 1, "score": "x", "lang_pred": 2, "n": 3, "row": 4, "tokens": 5, "found": 6, "taken_id": 7, "first_id": 8})
    df = df.union(df.where("doc_id = 6")).union(df.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")))
    for some, left in ((df, True), (df.limit(0), False)):
        docs = some
        for name, stage in pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF), "odd")
            assert docs.columns == df.columns
            if left and name == "toxicity":
                assert {r.doc_id for r in docs.collect()} >= {0, 1, 2, 3, 4, 6, None}
        assert (docs.count() > 0) == left
        assert (pipeline.pack(spark, docs, SF).count() > 0) == left


def test_each_group_keeps_one_row_whatever_its_ids_are(spark, documents, words):
    a, b, c, d, e = [" ".join(words(50 + k, 60)) for k in range(5)]
    rows = [(5, a), (5, b), (7, b), (None, c), (None, d), (None, d + " more"), (None, e), (9, e), (9, e), (5, None)]
    df = documents([t for _, t in rows])
    ids = F.element_at(F.array(*[F.lit(i).cast("long") for i, _ in rows]), F.col("doc_id").cast("int") + 1)
    df = df.withColumn("doc_id", ids)
    got = Counter((r.doc_id, r.text) for r in pipeline.keep_one_of_near_copies(spark, df, SF).collect())
    copies = [got.pop((None, t), 0) for t in (d, d + " more")]
    assert sorted(copies) == [0, 1]
    assert got == Counter([(5, a), (5, b), (None, c), (9, e), (5, None)])


def test_copies_by_bits_are_one_group_beside_copies_by_shingles(spark, documents, words):
    """``op10`` links a line said 300 times with two other ends; a third of their shingles is shared."""
    line = " ".join(words(70, 11))
    ends = [" ".join(words(80 + k, 9)) for k in range(2)]
    texts = [f"{line} " * 300 + end for end in ends] + [" ".join(words(90, 60))]
    a, b = (shingles(t) for t in texts[:2])
    assert len(a & b) / len(a | b) < 0.8
    df = documents(texts + [texts[1] + " more", None])
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, 4, 1, 4, 0).collect()}
    assert found[0] == found[1] == 0 and found[2] == 2
    kept = pipeline.keep_one_of_near_copies(spark, df.union(df), SF).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2, 4]
