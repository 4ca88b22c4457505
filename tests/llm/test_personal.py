"""Personal data: patterns beside plain regular expressions, the field beside enumeration."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipwire.llm import personal

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    def right(kind, said):
        digits = re.sub("[^0-9]", "", said)
        if kind == "ip":
            return all(int(p) <= 255 for p in said.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        if kind == "card":
            total = 0
            for k, d in enumerate(map(int, reversed(digits))):
                total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return True

    found = [
        (m.start(), k, m.end())
        for k, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text)
        if right(kind, m[0])
    ]
    return sorted(found)


CASES = [
    "mail a.b+c@x-1.example.com, or @x.y a@b a@b.c@d.e f@g..h @@a@b.co.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.255 9999.1.2.3.4 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111 5500005555555559",
    "+1 (499) 555-6503%%% +49 30 123 +12 +1---2 +44.20.7946.0958, ++1 555 555 5555 5555",
    "",
]


@pytest.mark.parametrize("text", CASES)
def test_patterns(text):
    assert personal.base_spans(text) == plain(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123459@.+-() ab%é\n", max_size=80))
def test_patterns_of_any_text(text):
    assert personal.base_spans(text) == plain(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a@", "+1 ", "@", "1-", ".", "0"])
def test_patterns_take_linear_time(unit):
    personal.base_spans(unit * 300_000)


def test_tokens():
    text = "ab 1c\n(d2) 3 e@ f,7\tx"
    assert [text[a:b] for a, b in personal._tokens(text)] == ["1c", "(d2)", "3", "e@", "f,7"]


def _field(seed=0):
    r = np.random.default_rng(seed)
    return personal.Field(r.normal(0, 1, (len(personal.SHAPES), 5)), r.normal(0, 1, (3, 5, 5)))


def _exact(field, g):
    own = g.shapes @ field.by_shape
    total = np.zeros((len(own), 5))
    for labels in itertools.product(range(5), repeat=len(own)):
        if any(y not in (0, l) for y, l in zip(g.given, labels)):
            continue
        energy = sum(own[k, l] for k, l in enumerate(labels) if g.given[k] == 0)
        energy += sum(field.by_link[kind, labels[a], labels[b]] for a, b, kind in g.links)
        for k, l in enumerate(labels):
            total[k, l] += np.exp(energy)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("text", ["1 2 3 x 4", "55555 a 55555 1", "x5x5x a x-5x5x 7", "a@b.cd 7 8"])
def test_messages_are_exact_on_trees(text):
    g = personal.graph([text], [plain(text)])
    got = _field().marginals(g, rounds=60)
    assert np.allclose(got, _exact(_field(), g), atol=1e-6)


def test_documents_of_a_batch_do_not_mix():
    texts = ["12345 12345 x +1 (499) 555-6503", "12345 7 12345", "a@b.cd 12345"]
    bases = list(map(plain, texts))
    together = _field(3).marginals(personal.graph(texts, bases))
    apart = [_field(3).marginals(personal.graph([t], [b])) for t, b in zip(texts, bases)]
    assert np.allclose(together, np.concatenate(apart), atol=1e-12)


def test_links_grow_with_tokens():
    g = personal.graph(["55-5555 " * 2000 + "5.55555 x " * 2000], [[]])
    assert len(g.links) < 3 * len(g.spans)


def test_learning_follows_the_gradient_of_the_pseudo_likelihood():
    g = personal.graph(["12345 9 x +1 (499) 555-6503 12345 a@b.cd 1.2.3.4"] * 3, [plain("12345 9 x +1 (499) 555-6503 12345 a@b.cd 1.2.3.4")] * 3)
    field = personal.learn(g.shapes.astype(float), g.given, g.links)

    def loss(f):
        z = g.shapes @ f.by_shape
        for a, b, kind in g.links:
            z[b] += f.by_link[kind, g.given[a]]
            z[a] += f.by_link[kind, :, g.given[b]]
        p = np.exp(z - z.max(1, keepdims=True))
        return -np.log((p / p.sum(1, keepdims=True))[np.arange(len(z)), g.given]).mean()

    start = personal.Field(np.zeros_like(field.by_shape), np.zeros_like(field.by_link))
    assert loss(field) < 0.05 < loss(start)


@pytest.fixture
def corpus(words):
    """Texts with phones, mails, addresses, cards, plain numbers, and nothing at all."""

    def make(n):
        out = []
        for k in range(n):
            w = words(k, 40)
            said = [
                f"+1 (4{k % 90 + 10}) 555-{1000 + k}",
                f"{w[0]}.{k}@mail{k % 7}.example.com",
                f"{k % 200}.{k % 7}.{k % 250}.{k % 99 + 1}",
                ("4111 1111 1111 1111", "5500005555555559")[k // 6 % 2],
                f"in {1900 + k % 120}, {k} of {k * 37}",
                "",
            ][k % 6]
            out.append(" ".join(w[:20] + [said] + w[20:]))
        return out

    return make


def test_other_mentions_are_found_and_clean_texts_left_alone(documents, corpus):
    texts = corpus(600)
    field = personal.fit(documents(texts))
    again = "call +1 (499) 555-6503 now, or (499) 555-6503 later; in 1984, 17 of 629"
    clean = ["in 1984, 17 of 629", "chapter 3.2 has 12 lines", "nothing here", "", None]
    (base, spans), *others = personal.find([again, *clean], field)
    assert base == plain(again)
    assert [again[s:e] for s, k, e in spans] == ["+1 (499) 555-6503", "(499) 555-6503"]
    assert [k for _, k, _ in spans] == [3, 3]
    assert others == [([], [])] * len(clean)


def test_base_stays_and_rows_stay(spark, documents, corpus):
    texts = corpus(60) + [None, "", *CASES, *CASES]
    docs = documents(texts, {"spans": 1, "base": 2, "h": 3})
    field = personal.fit(docs)
    from pyspark.sql import functions as F

    rows = personal.personal_data(docs, field).withColumns({n: personal.told(n) for n in ("base", "spans")}).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        text = texts[r["doc_id"]] or ""
        said = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in plain(text))
        assert r["base"] == said
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))
    by_text = {}
    for r in rows:
        assert by_text.setdefault(texts[r["doc_id"]], r["spans"]) == r["spans"]


def test_no_rows_and_nothing_to_learn(documents):
    for texts in ([], ["no marks"], ["7 8 9"]):
        docs = documents(texts)
        field = personal.fit(docs)
        rows = personal.personal_data(docs, field).collect()
        assert [(r["base"], r["spans"]) for r in rows] == [([], [])] * len(texts)


def test_sample_is_bounded_and_repeats_count_once(spark, documents):
    docs = documents(["+1 (499) 555-6503"] * 2000 + [f"{k} x" for k in range(500)] + ["7 " * 1000])
    rows = personal.sample_graphs(docs, sample=50, nodes_each=8).collect()
    assert len(rows) == 50 and max(len(r["given"]) for r in rows) <= 8
    assert len({r["h"] for r in rows}) == 50
    assert sorted(map(str, rows)) == sorted(map(str, personal.sample_graphs(docs.repartition(7), 50, 8).collect()))


def test_query_beside_plain_patterns(spark):
    from collections import Counter

    from clipwire.llm.queries import llm_queries

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = llm_queries()["op13_skip_chain_personal_data"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        said = [f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in base]
        number = Counter(k for _, k, _ in base)
        assert [r[f"n_{kind}"] for kind in personal.KINDS] == [number[k] for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(filter(None, r["spans"].split(",")))


def test_cards_that_stand_together_are_told_one_by_one(documents, corpus):
    field = personal.fit(documents(corpus(600)))
    text = "4111111111111111 x 4111111111111111 4111111111111111 y"
    ((base, spans),) = personal.find([text], field)
    assert base == plain(text) == [(0, 2, 16)]
    assert spans == [(0, 2, 16), (19, 2, 35), (36, 2, 52)]
