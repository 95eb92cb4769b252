"""Chat formatting by schema fingerprints.

Records of different layouts lie in one struct column (as Spark's JSON reader
merges them).  A record's fingerprint is a hash of the nested field paths that
are not null in it; each declared layout lists the paths it needs and those it
may have, so its possible fingerprints are known when the query is planned,
and a record's fingerprint selects the mapping that turns it into canonical
turns (role, text).  A fingerprint that no layout has gives null turns; the
fingerprint stays visible, and no record is dropped.

The template writes each turn as

    ### role:\\n text </turn>\\n

(no spaces around the text).  Roles and texts have the template's control
characters escaped by a backslash and a letter, so neither ``### `` nor
``</turn>`` occurs in them and reading back is exact.  The loss mask lists the
spans, in code points of the formatted text, of the assistant's texts.

Defined results: null roles and texts are empty; no turns give an empty text and
no span; turns with equal numbers are ordered by role, then text; null turn
numbers come first; repeated rows are turns of their own.  A conversation is
one value, so it is held whole; nothing else is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TURNS = "array<struct<role:string,text:string>>"
#: Escapes in the order of writing; reading undoes them from the last to the first.
TEXT_ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]
ROLE_ESCAPES = [*TEXT_ESCAPES, (":", "\\c"), ("\n", "\\n")]
HEAD, MIDDLE, TAIL = "### ", ":\n", "</turn>\n"


def field_paths(kind: DataType, name: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` marks an array, which is a path of its own."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{name}.{f.name}" if name else f.name)]
    if isinstance(kind, ArrayType):
        inner = field_paths(kind.elementType, f"{name}[]") if isinstance(kind.elementType, StructType) else []
        return [f"{name}[]", *inner]
    return [name]


def _present(value: Column, path: str) -> Column:
    head, dot, rest = path.partition(".")
    own = value[head.removesuffix("[]")]
    if not dot:
        return own.isNotNull()
    if head.endswith("[]"):
        return F.coalesce(F.exists(own, lambda x: _present(x, rest)), F.lit(False))
    return F.coalesce(_present(own, rest), F.lit(False))


def fingerprint(record: Column, paths: list[str]) -> Column:
    """Hash of the sorted ``paths`` that are not null in the record."""
    return F.sha2(F.concat_ws("\n", *(F.when(_present(record, p), F.lit(p)) for p in sorted(paths))), 256)


def fingerprint_of(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Layout:
    """A declared layout: the paths a record has to have, those it may have, and its mapping to turns."""

    name: str
    needs: frozenset[str]
    may: frozenset[str] = field(default_factory=frozenset)
    turns: Callable[[Callable[[str], Column]], Column] | None = None

    def fingerprints(self) -> list[str]:
        extra = chain.from_iterable(combinations(sorted(self.may), n) for n in range(len(self.may) + 1))
        return [fingerprint_of(self.needs | set(x)) for x in extra]


def turn(role: str | Column, text: Column) -> Column:
    return F.struct(F.coalesce(F.lit(role) if isinstance(role, str) else role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _messages(array: str, role: str, text: str, roles: dict[str, str] | None = None):
    def turns(get: Callable[[str], Column]) -> Column:
        def one(m: Column) -> Column:
            name = m[role]
            if roles:
                name = F.coalesce(*(F.when(name == a, F.lit(b)) for a, b in roles.items()), name)
            return turn(name, m[text])

        return F.transform(get(array), one)

    return turns


def _given(*parts: tuple[str, str]):
    """Turns of the named scalar fields that are there, in order."""

    def turns(get: Callable[[str], Column]) -> Column:
        return F.filter(F.array(*(F.when(get(path).isNotNull(), turn(role, get(path))) for role, path in parts)), lambda t: t.isNotNull())

    return turns


def _instruction(get: Callable[[str], Column]) -> Column:
    asked = F.concat_ws("\n\n", get("instruction"), F.when(F.length(get("input")) > 0, get("input")))
    head = F.when(get("system").isNotNull(), F.array(turn("system", get("system")))).otherwise(F.array().cast(TURNS))
    return F.concat(head, F.array(turn("user", asked), turn("assistant", get("output"))))


SHAREGPT = {"human": "user", "gpt": "assistant", "bot": "assistant", "chatgpt": "assistant"}
LAYOUTS = [
    Layout("turn rows", frozenset({"rows[]"}), frozenset({"rows[].turn", "rows[].role", "rows[].text"}), _messages("rows", "role", "text")),
    Layout("messages", frozenset({"messages[]", "messages[].role"}), frozenset({"messages[].content", "id"}), _messages("messages", "role", "content")),
    Layout("speakers", frozenset({"conversations[]", "conversations[].from"}), frozenset({"conversations[].value", "id"}), _messages("conversations", "from", "value", SHAREGPT)),
    Layout("instruction", frozenset({"instruction", "output"}), frozenset({"input", "system", "id"}), _instruction),
    Layout("prompt and completion", frozenset({"prompt", "completion"}), frozenset({"system", "id"}), _given(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt and response", frozenset({"prompt", "response"}), frozenset({"system", "id"}), _given(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question and answer", frozenset({"question", "answer"}), frozenset({"context", "id"}), _given(("system", "context"), ("user", "question"), ("assistant", "answer"))),
]


def canonical_turns(records: DataFrame, record: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``records`` plus fingerprint, layout (name or null) and turns (null for an unknown layout)."""
    kind = records.schema[record].dataType
    paths = field_paths(kind)
    known = set(paths)
    value = F.col(record)

    def get(name: str) -> Column:
        return value[name] if name in known or f"{name}[]" in known else F.lit(None).cast("string")

    own = records.withColumn("fingerprint", fingerprint(value, paths))
    names, turns = [], []
    for layout in layouts:
        if not layout.needs <= known or any("." in p and p not in known for p in layout.may):
            continue  # no record of this schema can have it, or its elements lack a field
        fits = F.col("fingerprint").isin(layout.fingerprints())
        names.append(F.when(fits, F.lit(layout.name)))
        turns.append(F.when(fits, layout.turns(get)))
    nothing = F.lit(None)
    return own.withColumns({"layout": F.coalesce(*names, nothing.cast("string")), "turns": F.coalesce(*turns, nothing.cast(TURNS))})


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escape(text: Column, escapes: list[tuple[str, str]] = TEXT_ESCAPES) -> Column:
    return _replace(text, escapes)


def unescape(text: Column, escapes: list[tuple[str, str]] = TEXT_ESCAPES) -> Column:
    return _replace(text, [(b, a) for a, b in reversed(escapes)])


def format_turns(df: DataFrame, turns: str = "turns", trained_role: str = "assistant") -> DataFrame:
    """``df`` plus formatted (the text) and loss_spans (start and length in code points of the trained turns' texts)."""
    written = F.transform(
        F.coalesce(turns, F.array().cast(TURNS)),
        lambda t: F.struct(F.concat(F.lit(HEAD), escape(t["role"], ROLE_ESCAPES), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("text"), (t["role"] == trained_role).alias("trained")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        begins = acc["at"] + F.length(t["head"])
        length = F.length(t["text"])
        span = F.array(F.struct(begins.alias("start"), length.alias("length")))
        return F.struct((begins + length + len(TAIL)).alias("at"), F.when(t["trained"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    text = F.array_join(F.transform("__written", lambda t: F.concat(t["head"], t["text"], F.lit(TAIL))), "")
    out = df.withColumn("__written", written).withColumns({"formatted": text, "loss_spans": F.aggregate("__written", start, add)["spans"]})
    return out.drop("__written")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.split(formatted, TAIL)
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(piece: Column) -> Column:
        head = F.substring_index(piece, MIDDLE, 1)
        text = F.substring(piece, F.length(head) + len(MIDDLE) + 1, F.length(piece))
        return F.struct(unescape(F.substring(head, F.lit(len(HEAD) + 1), F.length(head)), ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))

    return F.transform(whole, one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, spans joined without anything between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
