"""Packing of tokenized documents into sequences of even attention cost.

A piece of n tokens costs ``linear * n + quadratic * n ** 2``. Documents go, dearest first, to the
cheapest sequence with room for them. There are as many sequences as the tokens need and
no more: what fits into none is cut, its head fills the cheapest sequence that has any
room, and its tail is dealt like a shorter document. So only the last tokens of a load are padded.

Each task packs loads of ``load`` tokens as it reads them: texts are read once, nothing is
shuffled, and memory is bounded by a load. Ids of sequences hold the partition, so a task
that runs again gives the same rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clipwire.llm.resampling import slices

CAPACITY = 4096
LOAD = 2_000_000
END = (2).to_bytes(4, "little")
#: Words whose ids a worker remembers; all are forgotten when there are more.
REMEMBERED = 400_000
#: Bytes of text that are cut at once.
AT_ONCE = 2 << 20

#: A line of Latin letters and ASCII punctuation, or any other line.
_PLAIN = re.compile("^(?:([A-Za-zÀ-ÖØ-öø-ÿß]*)([!-&(-/:-@\\[-`{-~]*)|(.*))$", re.M)
#: White space beyond ASCII, as the library knows it.
_RARE_GAP = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _byte_letters() -> dict[int, int]:
    """Byte to the character that stands for it in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, other bytes for characters from 256 on.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + n for n, b in enumerate(hidden) if b != 32}


class WordIds:
    """Ids of texts, with a memory of pieces without white space.

    Texts are cut at white space and their pieces encoded as a dictionary by Arrow kernels, so that Python
    sees the distinct pieces of a slice only; ids are gathered by index. If the vocabulary drops
    white space and ends words by a mark, a text's ids are those of its pieces. Pieces of Latin
    letters followed by ASCII punctuation are then two words for the library's merges, which get all
    new words at once; all other pieces go through the whole library. For any other vocabulary
    whole texts do.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        self.last = np.zeros(self.library.get_vocab_size(), bool)  # ids that end a word
        for token, n in self.library.get_vocab().items():
            self.last[n] = token.endswith("</w>")
        self.letters = _byte_letters()
        self.remembered = remembered
        self._forget()
        self.by_pieces = self._drops_gaps()

    def _drops_gaps(self) -> bool:
        """Are the ids of a text those of its pieces, by the words of this vocabulary?"""
        probe = "One TWO  three,\n\u00c9t\u00e9's \u2003x!? 42 \u6c49"
        if not self.last.any():
            return False
        try:
            found, _ = self._gathered(pa.array([probe]))
        except ValueError:  # words that the merges do not tell apart
            return False
        finally:
            self._forget()
        return found.tobytes() == self.whole(probe)

    def _forget(self) -> None:
        self.parts: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, int] = {}
        self.start, self.size, self.flat = np.zeros(0, int), np.zeros(0, int), np.zeros(0, "<u4")

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        found = _PLAIN.findall("\n".join(new))
        heads = "\n".join(a for a, _, _ in found).lower().split("\n")
        parts = list({*heads, *(b for _, b, _ in found)} - self.parts.keys())
        if parts:
            shown = " ".join(parts).encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.merges.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.last[ids]) * 4 + 4).tolist()
            raw, at = ids.tobytes(), 0
            for part, end in zip(parts, ends, strict=True):
                self.parts[part] = raw[at:end]
                at = end
        known = self.parts
        made = [
            self.whole(other) if other else known[head] + known[marks]
            for head, (_, marks, other) in zip(heads, found, strict=True)
        ]
        size = np.fromiter(map(len, made), int, len(made)) // 4
        first = len(self.flat) + np.cumsum(size) - size
        self.pieces.update(zip(new, range(len(self.size), len(self.size) + len(new))))
        self.start, self.size = np.concatenate([self.start, first]), np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(made), "<u4")])

    def _gathered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pieces) > self.remembered:
            self._forget()
        texts = texts.cast(pa.large_string())
        if pc.any(pc.match_substring_regex(texts, _RARE_GAP)).as_py():
            texts = pc.replace_substring_regex(texts, _RARE_GAP, " ")
        lists = pc.ascii_split_whitespace(texts)
        owner, words = np.asarray(pc.list_parent_indices(lists)), pc.list_flatten(lists)
        some = pc.not_equal(words, "")
        owner, coded = owner[np.asarray(some)], words.filter(some).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        piece = np.fromiter(map(self.pieces.get, distinct, repeat(-1)), int, len(distinct))
        new = np.flatnonzero(piece < 0)
        if len(new):
            piece[new] = len(self.size) + np.arange(len(new))
            self._learn([distinct[k] for k in new.tolist()])
        piece = piece[np.asarray(coded.indices)]
        size = self.size[piece]
        ends = np.cumsum(size)
        place = np.repeat(self.start[piece] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[place], np.bincount(owner, size, len(texts)).astype(int)

    def of(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit; null has none."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        texts = texts.fill_null("")
        if not self.by_pieces:
            return [self.whole(t) for t in texts.to_pylist()]
        ids, counts = self._gathered(texts)
        raw, ends = ids.tobytes(), np.cumsum(4 * counts).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


_words: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's memory for this vocabulary."""
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]


def pack(
    lengths: list[int], capacity: int = CAPACITY, linear: float = 1.0, quadratic: float = 1 / CAPACITY
) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) and the number of sequences."""
    count = -(-sum(lengths) // capacity)
    used, cost = np.zeros(count, np.int64), np.zeros(count)
    queue = [(-min(capacity, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, capacity)]
    heapq.heapify(queue)
    pieces = []
    while queue:
        short, doc, start = heapq.heappop(queue)
        n = -short
        room = capacity - used
        fits = room >= n
        where = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
        put = min(n, int(room[where]))
        pieces.append((doc, start, put, where, int(used[where])))
        used[where] += put
        cost[where] += linear * put + quadratic * put * put
        if put < n:
            heapq.heappush(queue, (put - n, doc, start + put))
    return pieces, count


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    linear: float = 1.0,
    quadratic: float = 1 / CAPACITY,
    load: int = LOAD,
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece of each document, with its place in a sequence.

    ``doc_id``; ``start``, ``length``: the piece within the document's ids; ``ids_crc32`` of its ids;
    ``doc_tokens``; ``sequence_id``, ``offset``: where it stands; ``ids`` (array) if asked for.
    ``tokenizer`` is the path of a vocabulary file that all executors have, of any kind the library
    reads; those that drop white space are the fast ones. A document's ids
    end with id 2, so a null or empty text has one id. Rows with equal or null ids
    are documents of their own. Other columns are ignored; no rows give none.
    """
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + ", ids array<int>" * with_ids
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        next_id = TaskContext.get().partitionId() << 33
        docs_held, ids_held, tokens = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal next_id
            pieces, count = pack([len(i) // 4 for i in ids_held], capacity, linear, quadratic)
            doc, start, length, seq, offset = (np.array(c, np.int64) for c in zip(*pieces))
            cut = [ids_held[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in pieces]
            columns = [
                pa.array([docs_held[d] for d in doc], pa.int64()),
                start,
                length,
                pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                np.array([len(ids_held[d]) // 4 for d in doc], np.int64),
                seq + next_id,
                offset,
            ]
            if with_ids:
                columns.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in cut], pa.list_(pa.int32())))
            next_id += count
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for batch in batches:
            for at, texts in slices(batch.column("text"), AT_ONCE):
                docs_at = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                for doc, ids in zip(docs_at, words.of(texts)):
                    docs_held.append(doc)
                    ids_held.append(ids + END)
                    tokens += len(ids) // 4 + 1
                    if tokens >= load:
                        yield flush()
                        docs_held, ids_held, tokens = [], [], 0
        if docs_held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(packed, schema)
