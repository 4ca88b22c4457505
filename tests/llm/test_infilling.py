"""Fill-in-the-middle beside plain slices of the list of tokens."""

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipwire.llm import infilling

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, seed=42):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), out


def test_like_slices_and_back(documents, words):
    texts = [" ".join(words(k, 3 * k)) + " \n" * (k % 3) for k in range(80)]
    texts += [None, "", "  ", "\n a", "a<P>b", "é ü  x\x1cy", "<", "P> <S", "x" * 5000, "汉字 😀 " * 3000]
    texts = [t for t in texts for _ in range(3)]
    made = infilling.fill_in_middle(documents(texts, {"form": "f", "output": 1, "n": 2}))
    rows = made.withColumn("again", infilling.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == len(texts) and {r["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert tuple(r)[1:6] == plain(r["doc_id"], texts[r["doc_id"]])
        assert r["again"] == (texts[r["doc_id"]] or "")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\r\nab<PSM>é 汉😀", max_size=60)), max_size=6), st.integers(1, 9))
def test_any_text_in_any_blocks(texts, block):
    before, infilling.BLOCK = infilling.BLOCK, block
    try:
        got = list(infilling.transform(list(range(len(texts))), pa.array(texts, pa.string()), rate=50))
    finally:
        infilling.BLOCK = before
    assert [(*g[:4], g[4].decode()) for g in got] == [plain(k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100])
def test_descent_finds_the_block(n):
    units = [(k * 7) % 4 for k in range(n)]
    chars = [k + 1 for k in range(n)]
    tree = infilling.BlockCounts(units, chars)
    for unit in range(1, sum(units) + 1):
        block = next(k for k in range(n) if sum(units[: k + 1]) >= unit)
        assert tree.find(unit) == (block, sum(units[:block]), sum(chars[:block]))


def test_rates_nulls_and_no_rows(spark, documents):
    texts = [f"a b c d {k}" for k in range(400)]
    forms = [r["form"] for r in infilling.fill_in_middle(documents(texts)).select("form").collect()]
    assert 160 < 400 - forms.count("plain") < 240 and forms.count("psm") < forms.count("spm") / 2
    assert {r["form"] for r in infilling.fill_in_middle(documents(texts), rate=0).collect()} == {"plain"}
    assert infilling.fill_in_middle(documents([])).collect() == []
    odd = documents(texts).withColumn("doc_id", F.lit(None).cast("long"))
    got = infilling.fill_in_middle(odd).collect()
    assert sorted(r["output"] for r in got) == sorted(plain(None, t)[4] for t in texts)
