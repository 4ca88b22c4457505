"""Chat formatting: records of many layouts become canonical turns, then one marked text.

A record is a JSON object. Its schema fingerprint is a hash of its nested field paths, the
types left out; it selects one of the declared ``LAYOUTS``, which says where roles and texts
stand. All of it is column expressions.

The text has one block for each turn::

    <s>[INST]role[/INST]text</s>

Where a control string, with any number of backslashes after its first character, stands in
a role or text, one backslash more is put there; reading takes one away. So texts hold no
control string, whatever they say, and come back as they were.
"""

from __future__ import annotations


from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
OPEN, ROLE_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"

_INNER = r"(/?(?:s>|INST\]))"
_TO_ESCAPE = r"(<|\[)(\\*)" + _INNER
_ESCAPED = r"(<|\[)\\(\\*)" + _INNER

TURNS = "array<struct<role:string,text:string>>"

#: Records of more bytes have their texts emptied before their paths are read, as Spark's
#: parser of variants gives null beyond 128 MiB, or 20 million characters in one text.
LARGE = 8 << 20
#: Bytes of what is left then, beyond which the parser may give null for what it cannot hold.
UNREAD = 100 << 20
_STRING = r"""(?:[^"\\\x00-\x1F]|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+"""
_STRINGS = rf"""("{_STRING}"\s*+:)|"{_STRING}(")"""
_REPEATED = r"(\{[^{}]*+\})(?:\s*+,\s*+\1)++"
_READING = {"maxStringLen": str(2**31 - 1), "columnNameOfCorruptRecord": "_unread"}


@dataclass(frozen=True)
class Layout:
    """Where the turns of one kind of record stand.

    ``fields`` are (path, role) pairs in the order of the turns, for records that have a field
    for each turn. Else ``array`` names an array of objects, and ``role`` and ``text`` its
    fields. ``roles`` renames roles. ``skip_empty`` names fields that make no turn if empty.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    array: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)
    skip_empty: tuple[str, ...] = ()

    def skeleton(self) -> str:
        """The nested field paths of such a record, as :func:`paths` has them."""
        if self.array:
            inner = ", ".join(sorted((self.role, self.text)))
            return f"OBJECT<{self.array}: ARRAY<OBJECT<{inner}>>>"
        return f"OBJECT<{', '.join(sorted(p for p, _ in self.fields))}>"

    def turns(self, record: Column) -> Column:
        """The turns of such a record."""
        return self._turns(record).cast(TURNS)

    def _parsed(self, record: Column) -> Column:
        if self.array:
            kind = f"{self.array} array<struct<{self.role}:string,{self.text}:string>>"
        else:
            kind = ", ".join(f"{p} string" for p, _ in self.fields)
        return F.from_json(record, f"{kind}, _unread string", _READING)

    def _turns(self, record: Column) -> Column:
        parsed = self._parsed(record)
        if self.array:
            renamed = F.create_map(*[F.lit(x) for pair in self.roles.items() for x in pair])
            named = (lambda r: F.coalesce(F.try_element_at(renamed, r), r)) if self.roles else (lambda r: r)
            return F.transform(
                parsed[self.array],
                lambda m: F.struct(
                    named(F.coalesce(m[self.role], F.lit(""))).alias("role"),
                    F.coalesce(m[self.text], F.lit("")).alias("text"),
                ),
            )
        made = [
            (p, F.struct(F.lit(r).alias("role"), F.coalesce(parsed[p], F.lit("")).alias("text")))
            for p, r in self.fields
        ]
        turns = F.array(*[t for _, t in made])
        for k, (p, _) in enumerate(self.fields):
            if p in self.skip_empty:
                without = F.array(*[t for n, (_, t) in enumerate(made) if n != k])
                turns = F.when(made[k][1]["text"] == "", without).otherwise(turns)
        return turns


LAYOUTS = (
    Layout("prompt", fields=(("prompt", "user"), ("completion", ASSISTANT))),
    Layout("question", fields=(("question", "user"), ("answer", ASSISTANT))),
    Layout(
        "instruction",
        fields=(("instruction", "system"), ("input", "user"), ("output", ASSISTANT)),
        skip_empty=("input",),
    ),
    Layout("messages", array="messages", role="role", text="content"),
    Layout(
        "shared",
        array="conversations",
        role="from",
        text="value",
        roles={"human": "user", "gpt": ASSISTANT},
    ),
)


def _large(record: Column) -> Column:
    return F.octet_length(record) > LARGE


def _broken(record: Column) -> Column:
    """Is a record no JSON object? Read without keeping any of it, so its size does not matter."""
    return F.from_json(record, "_unread string", _READING)["_unread"].isNotNull()


def paths(record: Column) -> Column:
    """The nested field paths of a JSON record, names sorted; null if it is no JSON, of any size.

    A record of more than ``LARGE`` bytes is read with its texts emptied and runs of equal
    objects taken as one, which leaves the paths as they are. An object that still has more than
    ``UNREAD`` bytes then, so that the parser cannot hold it, is an error.
    """
    emptied = F.regexp_replace(F.regexp_replace(record, _STRINGS, "$1$2$2"), _REPEATED, "$1")
    small = F.when(~_large(record), record).otherwise(emptied)
    schema = F.schema_of_variant(F.try_parse_json(small))
    unread = F.lit(f"a record of more than {UNREAD} bytes besides its texts cannot be read")
    too_large = schema.isNull() & (F.octet_length(small) > UNREAD) & ~_broken(record)
    schema = F.when(too_large, F.raise_error(unread).cast("string")).otherwise(schema)
    leaf = r": (?:STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|BINARY|DATE|TIMESTAMP(?:_NTZ)?|DECIMAL\(\d+,\d+\))(?=[,>])"
    return F.regexp_replace(schema, leaf, "")


def fingerprint(skeleton: Column) -> Column:
    return F.lower(F.hex(F.xxhash64(skeleton)))


def canonical_turns(records: DataFrame, layouts=LAYOUTS, record: str = "record") -> DataFrame:
    """``records`` with ``schema_fingerprint``, ``layout`` and ``turns`` (role, text).

    A record with other paths than any layout's, or that is null or no JSON, keeps its row:
    ``layout`` and ``turns`` are null, whatever its size. Extra fields make other paths. Null roles
    and texts are empty. Columns of these three names are replaced.
    """
    skeleton = F.regexp_replace(paths(F.col(record)), "ARRAY<VOID>", "ARRAY<>")
    found = records.withColumn("schema_fingerprint", fingerprint(skeleton))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for each in layouts:
        same = F.col("schema_fingerprint") == fingerprint(F.lit(each.skeleton()))
        layout = F.when(same, F.lit(each.name)).otherwise(layout)
        turns = F.when(same, each.turns(F.col(record)).cast(TURNS)).otherwise(turns)
    return found.withColumns({"layout": layout, "turns": turns})


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _TO_ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def format_turns(df: DataFrame, turns: str = "turns") -> DataFrame:
    """``df`` with ``formatted`` and ``loss_spans``: (start, length) of assistant texts.

    Spans count code points from 0. Null or empty turns give an empty text without spans.
    """
    head = lambda t: F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(ROLE_END))
    blocks = F.transform(
        F.coalesce(F.col(turns), F.array().cast(TURNS)),
        lambda t: F.struct(
            head(t).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == ASSISTANT).alias("loss"),
        ),
    )
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate(
        "blocks",
        begun,
        lambda acc, b: F.struct(
            (acc["at"] + F.length(b["head"]) + F.length(b["body"]) + len(CLOSE)).alias("at"),
            F.when(
                b["loss"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(b["head"])).alias("start"),
                            F.length(b["body"]).alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    text = F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], b["body"], F.lit(CLOSE))), "")
    made = df.withColumn("blocks", blocks)
    return made.withColumns({"formatted": text, "loss_spans": spans}).drop("blocks")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")
    halves = F.transform(blocks, lambda b: F.split(F.substr(b, F.lit(len(OPEN) + 1)), r"\[/INST\]"))
    return F.transform(
        halves,
        lambda h: F.struct(unescaped(h[0]).alias("role"), unescaped(h[1]).alias("text")),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask as it was before formatting, spans joined."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["length"]))), ""
    )


def records_of(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``record`` (JSON), one row for each conversation of the given rows.

    Rows are taken by turn, then role, then text, so repeated rows count as turns of their own. Null
    texts and roles are empty; rows with a null ``conv_id`` are one conversation. A user
    and an assistant turn become a prompt record, a system, a non-empty user and an
    assistant turn an instruction record, all else messages. One conversation is one text,
    so it must fit into a row.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    one = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    roles, text = F.transform("t", lambda x: x["role"]), lambda k: F.col("t")[k]["text"]
    as_is = lambda *names: F.array(*map(F.lit, names))
    prompt = F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion")))
    instruction = F.to_json(
        F.struct(text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output"))
    )
    messages = F.to_json(
        F.struct(
            F.transform(
                "t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))
            ).alias("messages")
        )
    )
    record = (
        F.when(roles == as_is("user", ASSISTANT), prompt)
        .when((roles == as_is("system", "user", ASSISTANT)) & (text(1) != ""), instruction)
        .otherwise(messages)
    )
    return one.select("conv_id", record.alias("record"))


