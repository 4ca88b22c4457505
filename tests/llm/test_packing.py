import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clipwire.llm import packing
from clipwire.llm.queries import llm_queries, tokenizer_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def checked(rows, ids, capacity=4096):
    """All pieces in their places, with the right ids; the number of sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        own = ids[r.doc_id]
        piece = np.array(own[r.start : r.start + r.length], "<u4").tobytes()
        assert r.length > 0 and r.doc_tokens == len(own) and zlib.crc32(piece) == r.ids_crc32
    for doc, own in ids.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(own)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_packs_the_librarys_ids(spark, library):
    rows = llm_queries()["op3_cost_balanced_packing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = {r.doc_id: library(r.text) for r in docs}
    sequences = checked(rows, ids)
    total = sum(map(len, ids.values()))
    parts = spark.read.parquet(f"{SF}/documents.parquet").rdd.getNumPartitions()
    assert sequences <= -(-total // 4096) + parts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=60), st.integers(8, 40))
def test_pack_fills_every_sequence_but_the_last_tokens(lengths, capacity):
    pieces, count = packing.pack(lengths, capacity)
    assert count == -(-sum(lengths) // capacity)
    used, got = [0] * count, [[] for _ in lengths]
    for doc, start, length, sequence, offset in pieces:
        assert offset == used[sequence]
        used[sequence] += length
        got[doc].append((start, length))
    assert max(used) <= capacity
    for n, parts in zip(lengths, got):
        assert [s for s, _ in sorted(parts)] == [sum(k for _, k in sorted(parts)[:i]) for i in range(len(parts))]
        assert sum(k for _, k in parts) == n


def test_costs_are_balanced():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 1500, 3000).tolist()
    pieces, count = packing.pack(lengths)
    cost = np.zeros(count)
    for _, _, n, sequence, _ in pieces:
        cost[sequence] += n + n * n / 4096
    in_order, at = np.zeros(count), 0
    for n in lengths:  # the plain way: one after the other, cut where a sequence is full
        while n:
            put = min(n, 4096 - at % 4096)
            in_order[at // 4096] += put + put * put / 4096
            at, n = at + put, n - put
    assert cost.std() < 0.5 * in_order.std()


ODD = [
    "İstanbul ΣΑΣ don't it's x_y a1b2 <|endoftext|> \x1c a\x1fb", "½ ² ａｂｃ 中文 µm ªº ß ẞ", "é ́z \xa0y ÷×",
    "Kelvin K 'll 're ... !!! (a) [b] \\ ` ~ {c}", " 　 tab\tnew\nline\x85end",
]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from(ODD)), max_size=5).map(" ".join))
def test_word_memory_gives_the_librarys_ids(text):
    words = packing.word_ids(tokenizer_path())
    want = np.array(words.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert words.of([text, None, ""]) == [want, b"", b""]


def test_a_small_memory_forgets_and_stays_right(library):
    words = packing.WordIds(tokenizer_path(), remembered=10)
    texts = [f"alpha{k} beta, Gamma{k % 7}! the {chr(97 + k % 26) * 3}" for k in range(80)] + ODD
    got = [x for k in range(0, len(texts), 9) for x in words.of(texts[k : k + 9])]
    assert got == [np.array(library(t)[:-1], "<u4").tobytes() for t in texts]


def test_odd_rows(spark, documents, words, library):
    texts = [None, "", " \n", "a b", "a b", " ".join(words(1, 30_000)), "x"]
    df = documents(texts, {"start": 1, "length": "x", "ids": 2, "sequence_id": None})
    df = df.union(df.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long"))).coalesce(1)
    rows = packing.pack_documents(df, tokenizer_path(), load=10_000).collect()
    ids = {k: library(t) for k, t in enumerate(texts)} | {None: library("x")}
    checked(rows, ids)
    assert all(list(r.ids) == ids[r.doc_id][r.start : r.start + r.length] for r in rows)
    twice = packing.pack_documents(df.where("doc_id = 3").union(df.where("doc_id = 3")), tokenizer_path())
    assert twice.count() == 2
    assert packing.pack_documents(df.limit(0), tokenizer_path()).collect() == []


def test_other_vocabularies_take_whole_texts(spark, documents):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = ["One two,  three!", None, "", "\u00c9t\u00e9 \n 42", "a" * 5000]
    words = packing.WordIds(path)
    want = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert not words.by_pieces
    assert [np.frombuffer(i, "<u4").tolist() for i in words.of(texts)] == want
    rows = packing.pack_documents(documents(texts), path, with_ids=False).collect()
    checked(rows, {k: ids + [2] for k, ids in enumerate(want)})
    assert packing.WordIds(tokenizer_path()).by_pieces


def test_costs_are_balanced_across_loads(spark, documents, words):
    """Loads of one task are balanced apart; full sequences still cost alike."""
    texts = [" ".join(words(k, 20 + 37 * (k % 9))) for k in range(400)]
    docs = documents(texts).coalesce(1)
    rows = packing.pack_documents(docs, tokenizer_path(), capacity=512, load=20_000, with_ids=False).collect()
    cost, used = defaultdict(float), defaultdict(int)
    for r in rows:
        cost[r.sequence_id] += r.length + r.length**2 / 512
        used[r.sequence_id] += r.length
    full = [c for s, c in cost.items() if used[s] >= 460]
    assert len(full) > 0.9 * len(cost)
    assert max(full) < 1.6 * np.mean(full)
