import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipwire.llm import common, langid, quality, toxicity
from clipwire.llm.queries import llm_queries

SF = "/root/testdata/sf0.01"


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="module")
def languages(spark):
    return llm_queries()["op4_byte_cnn_language"](spark, SF).collect()


@pytest.fixture(scope="module")
def toxic(spark):
    return llm_queries()["op5_boosted_toxicity"](spark, SF).collect()


def test_languages_held_out(spark, languages):
    truth = {r.doc_id: r.lang for r in table(spark, "documents").collect()}
    assert sorted(r.doc_id for r in languages) == sorted(truth)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in languages)
    apart = [r for r in languages if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in apart]) > 0.97
    assert all(0 <= r.score <= 1 for r in languages)


def test_toxicity_held_out(spark, toxic):
    truth = {r.doc_id: r.toxic for r in table(spark, "labels").collect()}
    texts = {r.doc_id: r.text.lower() for r in table(spark, "documents").collect()}
    assert sorted(r.doc_id for r in toxic) == sorted(texts)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in toxic)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in toxic)
    apart = [r for r in toxic if r.held_out and r.doc_id in truth]
    clean = [r for r in apart if truth[r.doc_id] == 0]
    said = [r for r in apart if truth[r.doc_id] == 1 and any(w in texts[r.doc_id] for w in toxicity.INSULTS)]
    assert np.mean([r.predicted for r in clean]) < 0.02
    assert np.mean([r.predicted for r in said]) > 0.9


def test_network_gradients_are_those_of_differences():
    r = np.random.default_rng(1)
    rows = r.integers(97, 103, (5, 20)).astype(np.uint8)
    targets = r.integers(0, 3, 5)
    params = [r.normal(0, 0.5, s) for s in ((256, 8), (2, 8, 16), (16,), (16, 3), (3,))]

    def loss():
        net = langid.Network(["a", "b", "c"], params[0], params[1:2], *params[2:])
        shown = net.embedding[rows]
        steps = rows.shape[1] - 1
        top = sum(shown[:, k : k + steps] @ params[1][k] for k in range(2)).max(1)
        logs = langid._log_softmax(np.maximum(top + params[2], 0) @ params[3] + params[4])
        return -logs[np.arange(5), targets].mean()

    grads = langid._gradients(params, rows, targets)
    for p, g in zip(params, grads):
        spots = np.argsort(-np.abs(g).ravel())[:3]
        for at in spots:
            old, step = p.ravel()[at], 1e-5
            p.ravel()[at] = old + step
            high = loss()
            p.ravel()[at] = old - step
            low = loss()
            p.ravel()[at] = old
            assert g.ravel()[at] == pytest.approx((high - low) / 2 / step, rel=1e-3, abs=1e-7)


def test_folded_tables_give_the_filters_answers():
    net = langid.train(["abc " * 60, "xyz " * 60] * 8, ["a", "x"] * 8, epochs=3)
    rows = np.random.default_rng(0).integers(0, 256, (7, langid.WINDOW)).astype(np.uint8)
    shown = net.embedding[rows]
    top = [
        sum(shown[:, k : k + rows.shape[1] - len(f) + 1] @ f[k] for k in range(len(f))).max(1)
        for f in net.filters
    ]
    hidden = np.maximum(np.concatenate(top, 1) + net.bias, 0)
    want = langid._log_softmax(hidden @ net.dense + net.dense_bias)
    assert np.allclose(net.log_probabilities(rows, net.tables()), want, atol=1e-4)
    lang, score = langid.predict(net, net.tables(), ["abc " * 5000, "xyz", "", None, "123 !", "\n"])
    assert lang == ["a", "x", "und", "und", "und", "und"]


def test_odd_rows_of_languages(spark, documents, words):
    texts = [None, "", "12 34", " \n", "é", "ßüö der die " * 20, "ßüö der die " * 20, " ".join(words(1, 30_000))]
    df = documents(texts * 2, {"lang_pred": 1, "score": "x", "found": 2, "held_out": 3})
    keep = F.lit(True)
    got = langid.identify(df, langid.fit(df, keep)).collect()
    assert len(got) == 16
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 1 for k in (0, 1, 2, 3))
    assert by_id[5].lang_pred == by_id[6].lang_pred and by_id[5].score == by_id[6].score
    unknown = langid.identify(df, langid.fit(df.withColumn("lang", F.lit(None).cast("string")), keep))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}
    assert langid.identify(df.limit(0), langid.fit(df.limit(0), keep)).collect() == []


def test_odd_rows_of_toxicity(spark, documents, words):
    texts = [None, "", "you idiot", "YOU!! 1d10t", "IDIOT", " ".join(words(2, 30_000)), "fine text"] * 6
    df = documents(texts, {"score": "x", "toxic": 9, "y": 1, "predicted": 2})
    rows = [(k, 1, int(k % 7 in (2, 3, 4))) for k in range(42)] + [(None, 1, 1), (3, 0, None), (3, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, labels, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score(df.union(df.where("doc_id = 2")), model).collect()}
    assert len(got) == 42 and all(0 <= s <= 1 for s in got.values())
    assert got[0] == got[1] and got[2] == got[9] and min(got[2], got[4]) > max(got[0], got[6])
    assert toxicity.score(df.limit(0), model).collect() == []
    none = toxicity.fit(df, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(df, none).collect()} == {0.0}


def test_obfuscated_insults_are_found():
    lexicon = toxicity.Lexicon(frozenset({"grob", "unfug*"}))
    names = toxicity.FEATURES
    got = dict(zip(names, toxicity.features("1d10t! st*pid i.d.i.o.t you are GROB unfugs Unfug", lexicon)))
    assert got["second_person"] > 0 and got["near_second_person"] > 0
    assert got["obfuscated_hits"] > 0 and got["shouted"] > 0
    assert got["distinct"] == 2  # grob, unfugs; "unfug" itself is no word that begins so


def test_isotonic_is_the_best_rising_line():
    r = np.random.default_rng(4)
    margin = r.normal(size=300)
    y = (r.random(300) < 1 / (1 + np.exp(-2 * margin))).astype(float)
    at, p = toxicity.isotonic(margin, y)
    assert (np.diff(at) >= 0).all() and (np.diff(p) >= 0).all()
    want = np.interp(np.sort(margin), at, p)
    assert abs(want.mean() - y.mean()) < 0.02


def plain_counts(text):
    import re

    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    spots = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return [len(words), sum(map(len, words)), symbols, dup, len(spots)]


def test_rule_counts_are_brute_force(spark):
    got = {r.doc_id: r for r in llm_queries()["op6_isolation_forest"](spark, SF).collect()}
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    good = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    assert sorted(got) == sorted(docs)
    for d, text in docs.items():
        want = plain_counts(text)
        assert [got[d][c] for c in quality.BASE] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[d].base_failed == failed and not (failed and got[d].kept)
    judged = [d for d in good if d in got and not got[d].base_failed]
    assert np.mean([got[d].kept for d in judged if good[d]]) > 0.95
    assert np.mean([got[d].kept for d in judged if not good[d]]) < 0.2


@pytest.mark.parametrize(
    "text", [None, "", "a", "a b c", "a b c a b c", "x y z", "a b c d a b c\n\n a\n a\n", "é" * 9 + "\t#", "a a a a"]
)
def test_rule_counts_of_odd_texts(text):
    assert quality.statistics(text)[0] == plain_counts(text)


def test_odd_rows_of_quality(spark, documents, words):
    texts = [None, "", " ".join(words(1, 30_000)), " ".join(words(2, 80)), "a b c " * 40] * 3
    df = documents(texts, {"rules": 1, "kept": 2, "anomaly": "x", "m": 3, "good": 4})
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 0), (None, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(df.union(df.where("doc_id = 3")), labels).collect()}
    assert [got[k].base_failed for k in range(5)] == [True, True, False, False, True]
    assert got[2].n_words == 30_000 and got[2].kept == got[7].kept
    none = quality.judge(df, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)
    assert quality.judge(df.limit(0), labels).collect() == []


def test_forest_finds_what_lies_apart():
    r = np.random.default_rng(2)
    x = r.normal(size=(2000, 4))
    scores = quality.grow(x).scores(np.vstack([np.zeros((1, 4)), np.full((1, 4), 6.0)]))
    assert scores[1] > 0.65 > 0.5 > scores[0]


def test_sample_of_languages_counts_usable_rows(spark, words):
    """Few usable rows among many are still learned from, as many as asked for."""
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "if(id % 50 = 0, concat('word ', id), '12 34') AS text", "'en' AS lang"
    )
    rows = langid.training_sample(docs, F.lit(True), 100).collect()
    assert len(rows) == 100 and len({r.h for r in rows}) == 100


def test_sample_of_languages_takes_a_hot_id_once(spark):
    docs = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 7, id) AS doc_id", "if(id % 3 = 0, repeat('hot text ', 500), concat('text ', id)) AS text",
        "if(id % 2 = 0, 'en', 'de') AS lang",
    )
    rows = langid.training_sample(docs, F.lit(True), 10).collect()
    assert sorted(Counter(r.lang for r in rows).items()) == [("de", 10), ("en", 10)]
    assert all(len(r.windows) <= langid.WINDOWS_EACH and {len(w) for w in r.windows} == {langid.WINDOW} for r in rows)
    again = langid.training_sample(docs.repartition(5), F.lit(True), 10).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert {r.lang for r in langid.training_sample(docs, F.lit(True), 10, most_languages=1).collect()} in ({"en"}, {"de"})


def test_language_of_a_text_is_the_mean_of_its_windows():
    net = langid.train(["abc def " * 60, "xyz uvw " * 60] * 8, ["a", "x"] * 8, epochs=3)
    text = "abc def " * 40 + "xyz uvw " * 21 + "abc"
    rows = langid.windows(text)
    logs = net.log_probabilities(rows, net.tables())
    weight = np.array([min(langid.WINDOW, len(text) - k * langid.WINDOW) for k in range(len(rows))]) / langid.WINDOW
    mean = (weight[:, None] * logs).sum(0) / weight.sum()
    p = np.exp(mean) / np.exp(mean).sum()
    lang, score = langid.predict(net, net.tables(), [text], batch=2)
    assert lang == [net.languages[int(p.argmax())]] and score[0] == pytest.approx(p.max(), abs=1e-6)


def test_hash_sample_is_bounded_and_the_same_in_any_order(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "id % 4 AS y")
    got = sorted(map(str, common.hash_sample(df, 50).collect()))
    assert len(got) == 50 == len(set(got))
    assert got == sorted(map(str, common.hash_sample(df.union(df).repartition(3), 50).collect()))
    assert common.hash_sample(df.where("y < 0"), 50).collect() == []
    assert len(common.hash_sample(df.select("y"), 50).collect()) == 4


def test_toxicity_learns_the_same_from_repeated_ids(spark):
    rows = [(k % 30, f"you idiot {k}" if k % 30 % 2 else f"a fine text {k}") for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(30).selectExpr("id AS doc_id", "1 AS quality", "int(id % 2) AS toxic")
    one = toxicity.fit(df, labels, F.lit(True))
    two = toxicity.fit(df.repartition(5).orderBy(F.desc("text")), labels, F.lit(True))
    assert one.learned == two.learned and np.array_equal(one.trees.leaf, two.trees.leaf)
    assert np.array_equal(one.at, two.at) and np.array_equal(one.probability, two.probability)


def test_path_lengths_and_threshold_by_plain_walks():
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 3))
    forest = quality.grow(x, trees=7, drawn=64)

    def walk(tree, row):
        node, depth = 0, 0
        while forest.feature[tree, node] >= 0:
            node = 2 * node + 1 + int(row[forest.feature[tree, node]] > forest.cut[tree, node])
            depth += 1
        assert forest.path[tree, node] >= depth
        return forest.path[tree, node]

    expected = 2 * (np.log(63) + 0.5772156649) - 2 * 63 / 64
    want = [2.0 ** (-np.mean([walk(t, row) for t in range(7)]) / expected) for row in x]
    scores = forest.scores(x)
    assert np.allclose(scores, want)
    good = r.random(300) < 0.9
    cut = quality.threshold(scores, good)
    gain = lambda c: (scores[~good] > c).mean() - (scores[good] > c).mean()
    allowed = [c for c in scores if (scores[good] <= c).mean() >= quality.KEEP_GOOD]
    assert cut == np.inf and max(map(gain, allowed)) <= 0 or gain(cut) == max(map(gain, allowed))


def test_trees_draw_from_all_rows_and_scores_are_cut_by_all_labels(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "array(cast(id AS double)) AS rules")
    drawn = quality.draws(rows.union(rows.limit(50))).collect()
    assert set(Counter(r.tree for r in drawn).values()) == {quality.DRAWN}
    assert len({r.rules[0] for r in drawn}) > 8192
    assert len({(r.tree, r.rules[0]) for r in drawn}) == len(drawn)
    assert len(quality.draws(rows.limit(9), trees=3).collect()) == 27
    r = np.random.default_rng(8)
    good = r.random(30_000) < 0.9
    scores = np.round(np.where(good, 0.4, 0.5) + 0.1 * r.random(30_000), 4)
    rated = spark.createDataFrame(pd.DataFrame({"anomaly": scores, "good": good}))
    assert quality.calibrated(rated) == quality.threshold(scores, good) < 1
    assert quality.calibrated(rated.where("good")) == quality.calibrated(rated.limit(0)) == np.inf
    few = spark.createDataFrame(pd.DataFrame({"anomaly": scores[:40], "good": good[:40]}))
    assert quality.calibrated(few) == quality.threshold(scores[:40], good[:40])


def test_boosted_trees_lower_the_loss_and_leaves_are_newton_steps():
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(float)
    loss = lambda t: np.log1p(np.exp(-(2 * y - 1) * t.margin(x))).mean()
    made = [toxicity.boost(x, y, trees=n) for n in (1, 5, 30)]
    assert loss(made[0]) > loss(made[1]) > loss(made[2])
    tree = made[0]
    node = np.zeros(len(x), int)
    for _ in range(3):
        node = 2 * node + 1 + (x[np.arange(len(x)), tree.feature[0][node]] > tree.cut[0][node])
    p = 1 / (1 + np.exp(-tree.base))
    for k in range(8):
        rows = node == 7 + k
        if rows.any():
            g, h = (p - y[rows]).sum(), rows.sum() * p * (1 - p)
            assert tree.leaf[0][k] == pytest.approx(-0.15 * g / (h + 1))
