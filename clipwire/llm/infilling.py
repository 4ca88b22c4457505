"""Fill-in-the-middle: texts cut in three at token bounds, with the middle moved to the end.

Tokens are words with the white space before them, and white space that ends a text. Each text
is cut into blocks of ``BLOCK`` UTF-8 bytes; how many tokens end in a block and how many code points
start in it are counted for all blocks of a slice of texts at once. A Fenwick tree over a
text's blocks holds both counts. A descent by powers of two finds the block in which the
token before a cut ends, with the tokens and code points before that block; the bound itself
is then looked for in that one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwire.llm.resampling import slices

#: The marks before the parts, and the names of the forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
PLAIN, PSM, SPM = "plain", "psm", "spm"

BLOCK = 1024
#: Hundredths of documents that are transformed, and of those in the order suffix, prefix, middle.
RATE, SPM_RATE = 50, 80
SEED = 42

_IS_GAP = np.zeros(256, bool)
_IS_GAP[[32, *range(9, 14)]] = True


def token_ends(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each byte of texts that stand one after the other: does a token end with it?

    ``bounds`` are the texts' first bytes and the end of the last one.
    """
    gap = _IS_GAP[raw]
    ends = np.zeros(len(raw), bool)
    ends[:-1] = ~gap[:-1] & gap[1:]
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    ends[last] = True
    return ends


class BlockCounts:
    """A Fenwick tree over the blocks of a text: tokens that end and code points that start in each."""

    def __init__(self, units: list[int], chars: list[int]):
        n = len(units)
        self.units, self.chars = [0, *units], [0, *chars]
        for at in range(1, n + 1):
            above = at + (at & -at)
            if above <= n:
                self.units[above] += self.units[at]
                self.chars[above] += self.chars[at]
        self.top = 1 << n.bit_length() >> 1

    def find(self, unit: int) -> tuple[int, int, int]:
        """The block in which the ``unit``-th token ends (from 1), and the tokens and code points before it."""
        at = units = chars = 0
        step = self.top
        while step:
            to = at + step
            if to < len(self.units) and units + self.units[to] < unit:
                at, units, chars = to, units + self.units[to], chars + self.chars[to]
            step >>= 1
        return at, units, chars


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """The four numbers that decide about a document, by its id alone."""
    said = f"{seed}:{'' if doc_id is None else doc_id}"
    h = hashlib.sha256(said.encode()).hexdigest()
    return tuple(int(h[k : k + 8], 16) for k in (0, 8, 16, 24))


def _cut(raw: np.ndarray, ends: np.ndarray, starts: np.ndarray, tree: BlockCounts, unit: int) -> tuple[int, int]:
    """The byte and the code point after the ``unit``-th token of a text."""
    if not unit:
        return 0, 0
    block, units, chars = tree.find(unit)
    first = block * BLOCK
    inside = ends[first : first + BLOCK]
    byte = first + int(np.flatnonzero(inside)[unit - units - 1]) + 1
    return byte, chars + int(np.count_nonzero(starts[first:byte]))


def transform(
    ids: list[int | None], texts: pa.Array, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED
) -> Iterator[tuple]:
    """(tokens, form, code points of prefix, of middle, output) of each text."""
    said = texts.fill_null("").cast(pa.binary()).to_pylist()
    bounds = np.cumsum([0, *map(len, said)])
    raw = np.frombuffer(b"".join(said), np.uint8)
    ends, starts = token_ends(raw, bounds), raw & 0xC0 != 0x80
    # First bytes of all blocks: every BLOCK bytes from the beginning of each text.
    number = -(-np.diff(bounds) // BLOCK)
    first_block = np.cumsum(number) - number
    within = np.arange(int(number.sum())) - np.repeat(first_block, number)
    at = np.repeat(bounds[:-1], number) + within * BLOCK
    units = np.add.reduceat(ends, at, dtype=np.int64).tolist() if len(at) else []
    chars = np.add.reduceat(starts, at, dtype=np.int64).tolist() if len(at) else []
    for k, (doc_id, text) in enumerate(zip(ids, said)):
        blocks = slice(int(first_block[k]), int(first_block[k] + number[k]))
        n = sum(units[blocks])
        h1, h2, h3, h4 = draws(doc_id, seed)
        marked = any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE))
        if not text or marked or h3 % 100 >= rate:
            yield n, PLAIN, None, None, text
            continue
        tree = BlockCounts(units[blocks], chars[blocks])
        mine = slice(int(bounds[k]), int(bounds[k + 1]))
        cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
        (a, a_chars), (b, b_chars) = (_cut(raw[mine], ends[mine], starts[mine], tree, c) for c in cuts)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
        if h4 % 100 < spm_rate:
            yield n, SPM, a_chars, b_chars - a_chars, s + suffix + p + prefix + m + middle
        else:
            yield n, PSM, a_chars, b_chars - a_chars, p + prefix + s + suffix + m + middle


def fill_in_middle(
    docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED
) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` for every row of ``docs``.

    ``n`` counts the text's tokens. ``form`` is ``plain`` (the text as it is), ``psm`` (prefix,
    suffix, middle) or ``spm`` (suffix, prefix, middle), each part after its mark; lengths are
    in code points and null where the form is plain. What is done depends on the seed, the id
    and the number of tokens alone, so repeated rows are alike. Null ids count as one empty
    id. Null and empty texts, and those that hold a mark, stay plain. Texts are read once and
    not shuffled; other columns are ignored; no rows give none.
    """
    names = "doc_id n form prefix_chars middle_chars output".split()
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                ids = batch.column(0).slice(start, len(texts))
                made = list(zip(*transform(ids.to_pylist(), texts, rate, spm_rate, seed)))
                columns = [pa.array(c, t) for c, t in zip(made[:-1], types[1:])]
                columns.append(pa.array(made[-1], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([ids, *columns], names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    return docs.select(*columns).mapInArrow(transformed, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    No text with a mark is transformed, so the marks are the first three found.
    """
    parts = F.split(output, MARKS)
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(F.concat(parts[2], parts[3], parts[1]))
