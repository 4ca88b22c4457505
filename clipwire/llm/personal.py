"""Personal data: patterns for plain cases, and a skip-chain conditional random field around them.

Nodes of the field are the tokens (parted by ASCII white space) with a digit or an at sign; all
other tokens are surely none of the kinds and need no node. Neighbouring nodes are joined as in a
chain. Nodes far apart in a document are joined too: each to the next one that holds the same
token, and to the next one with the same letters and digits in another spelling. So links
grow with the tokens, however often one is repeated. Tokens in a pattern's match are
given; loopy belief propagation carries their kind along the links to the tokens that
patterns miss, for a number of rounds that does not depend on the batch.

The weights are learned by pseudo-likelihood from the patterns' own matches in a bounded sample:
features are shapes of tokens, so a kind is known by how it looks, by its neighbours and by its other
mentions. Documents of a batch are parts of one graph, without links between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwire.llm.common import least_values
from clipwire.llm.resampling import slices

#: The kinds in the order in which they are told, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_MARK = re.compile("[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_GAPS = " \t\n\x0b\x0c\r"

OTHER = 0
LABELS = 1 + len(KINDS)
#: Documents that the field is learned from, and nodes of each.
SAMPLE, NODES_EACH = 3000, 64
#: Rounds of message passing, share of the old message kept, and the probability of a sure label.
ROUNDS, DAMPING, SURE = 12, 0.3, 0.9
#: Letters and digits that a token must have for links to its other mentions.
LINKED = 5
#: Bytes of text whose graph a task holds at once.
AT_ONCE = 1 << 20

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    values = [int(d) for d in reversed(digits)]
    twice = (2 * d - 9 * (d > 4) for d in values[1::2])
    return (sum(values[::2]) + sum(twice)) % 10 == 0


def _low(part: str) -> bool:
    """Is a part of an address at most 255?"""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        head = text[done:at]
        start = done + len(head.rstrip(_LOCAL))
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            done, at = at + 1, text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """What the patterns match: for each kind the leftmost matches that do not overlap.

    Every pattern is matched in time linear in the text, whatever it holds.
    """
    found = [(start, 0, end) for start, end in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_low, m.groups())):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() >= 12 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens with a digit or an at sign."""
    out, done = [], 0
    while m := _MARK.search(text, done):
        head = text[done : m.start()]
        start = done + 1 + max(map(head.rfind, _GAPS))
        done = _TOKEN.match(text, m.start()).end()
        out.append((start, done))
    return out


#: Shapes of tokens by which a kind is known.
SHAPES = (
    "bias at_sign one_at dot_after_at letters mostly_letters mostly_digits plus open_mark close_mark "
    "other_marks slash colon dotted_quad low_quad luhn next_node previous_node".split()
    + [f"digits_{k}" for k in (0, 1, 2, 3, 4, 6, 8, 11, 15, 19, 20)]
    + [f"dots_{k}" for k in range(5)]
    + [f"hyphens_{k}" for k in range(4)]
    + [f"length_{k}" for k in (2, 4, 6, 9, 13, 19, 20)]
)
_AT = {name: k for k, name in enumerate(SHAPES)}
_DIGIT_STEPS, _LENGTH_STEPS = (0, 1, 2, 3, 4, 6, 8, 11, 15, 19), (2, 4, 6, 9, 13, 19)
_EDGES = "\"'`,;:!?*#$%&|<>[]{}~^=/\\"


@lru_cache(maxsize=1 << 16)
def shape(token: str, previous: bool, following: bool) -> tuple[int, ...]:
    """Indices of the shapes that a token has; marks at its edges are no part of it."""
    bare = token.strip(_EDGES)
    n, digits = len(bare), len(_DIGIT.findall(bare))
    letters = sum(map(str.isalpha, bare))
    dots, hyphens, ats = bare.count("."), bare.count("-"), bare.count("@")
    core = bare.rstrip(".")
    quad = _IP.fullmatch(core)
    has = ["bias", f"dots_{min(dots, 4)}", f"hyphens_{min(hyphens, 3)}"]
    has.append(f"digits_{next((k for k in _DIGIT_STEPS if digits <= k), 20)}")
    has.append(f"length_{next((k for k in _LENGTH_STEPS if n <= k), 20)}")
    facts = {
        "at_sign": ats,
        "one_at": ats == 1,
        "dot_after_at": ats and "." in core[core.rfind("@") :],
        "letters": letters,
        "mostly_letters": 2 * letters > n,
        "mostly_digits": 2 * digits > n,
        "plus": bare.startswith("+"),
        "open_mark": "(" in bare,
        "close_mark": ")" in bare,
        "other_marks": n > letters + digits + dots + hyphens + ats,
        "slash": "/" in token,
        "colon": ":" in token,
        "dotted_quad": quad,
        "low_quad": quad and all(map(_low, quad.groups())),
        "luhn": 12 <= digits <= 19 and not letters and luhn("".join(_DIGIT.findall(bare))),
        "next_node": following,
        "previous_node": previous,
    }
    return tuple(_AT[f] for f in (*has, *(f for f, yes in facts.items() if yes)))


@dataclass
class Graph:
    """Nodes and links of some documents, one after the other."""

    owner: np.ndarray  # the document of each node
    spans: list[tuple[int, int]]
    shapes: np.ndarray  # 0 or 1 for each node and shape
    given: np.ndarray  # label of each node by the patterns; OTHER where none
    links: np.ndarray  # first node, second node, kind of link (0 chain, 1 same, 2 similar)


def graph(texts: list[str], bases: list[list[Span]], most: int | None = None) -> Graph:
    """The graph of documents; ``most`` leaves out nodes of each beyond so many."""
    owner, spans, shapes, given, links = [], [], [], [], []
    for doc, (text, base) in enumerate(zip(texts, bases)):
        tokens = _tokens(text)[:most]
        by_token: dict[str, int] = {}
        by_key: dict[str, int] = {}
        at = 0
        beside = [text[a[1] : b[0]].strip(_GAPS) == "" for a, b in zip(tokens, tokens[1:])]
        for k, (start, end) in enumerate(tokens):
            node = len(spans)
            token = text[start:end]
            before, after = k > 0 and beside[k - 1], k < len(beside) and beside[k]
            while at < len(base) and base[at][2] <= start:
                at += 1
            label = min((b[1] + 1 for b in base[at : at + 8] if b[0] < end and b[2] > start), default=OTHER)
            owner.append(doc)
            spans.append((start, end))
            shapes.append(shape(token, before, after))
            given.append(label)
            if before:
                links.append((node - 1, node, 0))
            same = token.strip(_EDGES).rstrip(".").lower()
            key = "".join(filter(str.isalnum, same))
            if len(key) >= LINKED:
                if same in by_token:
                    links.append((by_token[same], node, 1))
                elif key in by_key:
                    links.append((by_key[key], node, 2))
                by_token[same] = by_key[key] = node
    x = np.zeros((len(spans), len(SHAPES)), np.float32)
    for k, has in enumerate(shapes):
        x[k, list(has)] = 1
    return Graph(np.array(owner, int), spans, x, np.array(given, int), np.array(links, int).reshape(-1, 3))


@dataclass
class Field:
    """Potentials: of labels by shape, and of pairs of labels by kind of link."""

    by_shape: np.ndarray
    by_link: np.ndarray

    def marginals(self, g: Graph, rounds: int = ROUNDS, damping: float = DAMPING) -> np.ndarray:
        """Probability of each label at each node; given labels (not ``OTHER``) are evidence.

        Sum-product messages go along all links at once, both ways, ``rounds`` times.
        """
        n = len(g.owner)
        own = (g.shapes @ self.by_shape).astype(float)
        sure = g.given != OTHER
        own[sure] = -50.0
        own[sure, g.given[sure]] = 0.0
        if not len(g.links):
            return _softmax(own)
        a, b, kind = g.links.T
        to, source = np.concatenate([b, a]), np.concatenate([a, b])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        pair = np.exp(np.concatenate([self.by_link[kind], self.by_link[kind].transpose(0, 2, 1)]))
        message = np.zeros((len(to), LABELS))
        for _ in range(rounds):
            belief = own + _summed(to, message, n)
            out = _softmax(belief[source] - message[back])
            new = np.log(np.einsum("ki,kij->kj", out, pair) + 1e-30)
            new -= new.max(axis=1, keepdims=True)
            message = damping * message + (1 - damping) * new
        return _softmax(own + _summed(to, message, n))


def _summed(to: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(to, values[:, k], n) for k in range(values.shape[1])], 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def learn(x: np.ndarray, y: np.ndarray, links: np.ndarray, steps: int = 400, rate: float = 0.05, decay: float = 1e-3) -> Field:
    """A field by pseudo-likelihood: each node's label given its shape and its neighbours' labels."""
    by_shape, by_link = np.zeros((x.shape[1], LABELS)), np.zeros((3, LABELS, LABELS))
    if not len(y):
        return Field(by_shape, by_link)
    a, b, kind = links.T
    right = np.eye(LABELS)[y]
    # How many neighbours of each label a node has, by kind of link, on either side of it.
    left_of, right_of = np.zeros((2, len(y), 3 * LABELS))
    np.add.at(left_of, (b, kind * LABELS + y[a]), 1)
    np.add.at(right_of, (a, kind * LABELS + y[b]), 1)
    flat = (3 * LABELS, LABELS)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (by_shape, by_link)]
    for step in range(1, steps + 1):
        z = x @ by_shape + left_of @ by_link.reshape(flat)
        z += right_of @ by_link.transpose(0, 2, 1).reshape(flat)
        wrong = (_softmax(z) - right) / len(y)
        pairs = (left_of.T @ wrong).reshape(by_link.shape)
        pairs = pairs + (right_of.T @ wrong).reshape(by_link.shape).transpose(0, 2, 1)
        for p, g, (m, v) in zip((by_shape, by_link), (x.T @ wrong, pairs), state):
            g = g + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(by_shape, by_link)


#: Least and most digits of the kinds that are told from the field; emails need an at sign instead.
_LEAST_DIGITS, _MOST_DIGITS = (0, 4, 12, 7), (0, 12, 19, 15)
_TRIM = {
    0: re.compile(r"[A-Za-z0-9].*[A-Za-z0-9]", re.S),
    1: re.compile(r"[0-9].*[0-9]", re.S),
    2: re.compile(r"[0-9].*[0-9]", re.S),
    3: re.compile(r"[+(0-9].*[0-9]", re.S),
}


def added_spans(
    text: str, tokens: list[tuple[int, int]], labels: list[int], sure: list[bool], base: list[Span]
) -> list[Span]:
    """Spans of the tokens that the field labels and no pattern matched.

    Tokens of a card or a phone that follow each other are one span, up to the digits that its kind
    has; it is told if one of them is sure. Marks at the edges go, and what
    has too few digits for its kind, or touches a match of a pattern, is not told.
    """
    taken = [(start, end) for start, _, end in base]
    found, k = [], 0
    while k < len(tokens):
        label, last = labels[k], k
        digits = len(_DIGIT.findall(text, *tokens[k]))
        if label == OTHER:
            k += 1
            continue
        while (
            label > 2
            and last + 1 < len(tokens)
            and labels[last + 1] == label
            and digits + (more := len(_DIGIT.findall(text, *tokens[last + 1]))) <= _MOST_DIGITS[label - 1]
            and text[tokens[last][1] : tokens[last + 1][0]].strip(_GAPS) == ""
        ):
            last += 1
            digits += more
        kind, start, end = label - 1, tokens[k][0], tokens[last][1]
        told = any(sure[k : last + 1])
        k = last + 1
        core = _TRIM[kind].search(text, start, end)
        if not told or not core:
            continue
        said = core[0]
        enough = "@" in said if kind == 0 else len(_DIGIT.findall(said)) >= _LEAST_DIGITS[kind]
        if enough and not any(s < core.end() and e > core.start() for s, e in taken):
            found.append((core.start(), kind, core.end()))
    return found


def find(texts: list[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """The patterns' spans and all spans of each text."""
    said = [t or "" for t in texts]
    some = [k for k, t in enumerate(said) if _MARK.search(t)]
    out: list[tuple[list[Span], list[Span]]] = [([], []) for _ in said]
    bases = [base_spans(said[k]) for k in some]
    g = graph([said[k] for k in some], bases)
    chance = np.round(field.marginals(g), 9)
    best = chance.argmax(axis=1)
    most = chance[np.arange(len(best)), best]
    best[(most < 0.5) | (g.given != OTHER)] = OTHER
    bounds = np.searchsorted(g.owner, np.arange(len(some) + 1))
    for n, (k, base) in enumerate(zip(some, bases)):
        mine = slice(bounds[n], bounds[n + 1])
        more = []
        if best[mine].any():
            sure = (most[mine] >= SURE).tolist()
            more = added_spans(said[k], g.spans[mine], best[mine].tolist(), sure, base)
        out[k] = base, sorted(base + more)
    return out


def sample_graphs(docs: DataFrame, sample: int = SAMPLE, nodes_each: int = NODES_EACH) -> DataFrame:
    """``h``, ``shapes``, ``given``, ``links`` of at most ``sample`` distinct texts with a node.

    They are those with the least hash of the text, and the first ``nodes_each`` nodes of each, so
    the sample is bounded whatever the texts are. Graphs are made in the tasks.
    """
    usable = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    hashed = usable.withColumn("h", F.xxhash64("text", F.lit(13)))
    chosen = least_values(hashed, "h", sample)
    rows = hashed.join(F.broadcast(chosen), "h", "left_semi").select("h", "text")
    names = ["h", "shapes", "given", "links"]
    types = [pa.int64(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                g = graph([text], [base_spans(text)], nodes_each)
                has = [np.flatnonzero(r) for r in g.shapes]
                made.append((h, has, g.given, g.links.ravel()))
            columns = zip(*made) if made else ((),) * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    schema = "h long, shapes array<array<int>>, given array<int>, links array<int>"
    return rows.mapInArrow(graphs, schema).dropDuplicates(["h"])


def fit(docs: DataFrame, sample: int = SAMPLE, nodes_each: int = NODES_EACH) -> Field:
    """A field learned from the patterns' matches in at most ``sample`` texts of ``docs``.

    Without a match to learn from, the field has no weights and tells nothing.
    """
    rows = sorted(sample_graphs(docs, sample, nodes_each).collect())
    shapes = [s for r in rows for s in r["shapes"]]
    x = np.zeros((len(shapes), len(SHAPES)))
    for k, has in enumerate(shapes):
        x[k, has] = 1
    first = np.cumsum([0, *(len(r["given"]) for r in rows)])
    links = [np.array(r["links"], int).reshape(-1, 3) + [[n, n, 0]] for r, n in zip(rows, first)]
    given = np.array([y for r in rows for y in r["given"]], int)
    return learn(x, given, np.concatenate(links) if links else np.zeros((0, 3), int))


def personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` for every row of ``docs``, from its whole text.

    Both are arrays of structs (``start``, ``kind``, ``end``) in code points, end exclusive, by start and
    then kind in the order of ``KINDS``; ``base`` has the patterns' matches, ``spans`` those and what
    the field adds. Null texts count as empty and have none. Equal texts have equal spans,
    whatever other documents there are once the field is learned; repeated rows stay; other columns are
    ignored; no rows give none. Texts are read once and not shuffled; a task holds the graph
    of a slice of texts, or of one longer text.
    """
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    names = ["doc_id", "base", "spans"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(1), AT_ONCE):
                both = find(texts.to_pylist(), field)
                columns = [
                    pa.array([[dict(zip(("start", "kind", "end"), s)) for s in some] for some in part], span)
                    for part in zip(*both)
                ]
                ids = batch.column(0).slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([ids, *columns], names)

    kind = "array<struct<start: int, kind: int, end: int>>"
    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    return docs.select(*columns).mapInArrow(found, f"doc_id long, base {kind}, spans {kind}")


def told(spans: str) -> Column:
    """A column of spans as ``kind:start:end``, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def number_of(spans: str, kind: int) -> Column:
    """How many spans of a kind a column of spans holds."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
