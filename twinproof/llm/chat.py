"""Chat formatting for records of different layouts.

A layout is known by the fingerprint of its nested field paths. The fingerprint picks a declarative mapping
(turns as rows, a list of messages, or named slots such as instruction and output), and the mapping brings every
record to canonical turns ``(conv_id, turn, place, role, text)``. A template then marks turns, one chunk of
output per turn; the chunks of a conversation in order are its formatted text.

``<|im_start|>role⏎text<|im_end|>⏎``. A backslash is put before every backslash and between ``<`` and ``|`` inside
roles and texts, and before a line break inside roles, so control strings of a text never read as the template's.

Defined cases: NULL roles and texts are empty; turns are ordered by turn (NULL first), place in the list, role and
text; repeated rows are repeated turns; rows with a NULL conversation id form one conversation; fields that no
mapping names are left out before hashing; records whose fields fit no mapping are returned by ``unknown_records``;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = ["conv_id", "turn", "place", "role", "text"]


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns. Names are field paths; ``slots`` are (role, fields joined by a blank line)."""

    name: str
    conv: str = "conv_id"
    turn: str | None = None
    messages: str | None = None
    role: str | None = None
    text: str | None = None
    slots: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def paths(self) -> frozenset[str]:
        if self.messages:
            return frozenset({self.conv, f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}"})
        if self.slots:
            return frozenset({self.conv, *(f for _, fields in self.slots for f in fields)})
        return frozenset(x for x in (self.conv, self.turn, self.role, self.text) if x)


MAPPINGS = [
    Mapping("turn rows", turn="turn", role="role", text="text"),
    Mapping("messages", messages="messages", role="role", text="content"),
    Mapping("from and value", messages="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}),
    Mapping("instruction", slots=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction with input", slots=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("prompt", slots=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("question", slots=(("system", ("system",)), ("user", ("question",)), ("assistant", ("answer",)))),
]


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(kind: DataType, prefix: str = "") -> set[str]:
    """Paths of all leaves, lists marked by ``[]``."""
    if isinstance(kind, StructType):
        return set().union(*(schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name) for f in kind.fields))
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, prefix + "[]")
    return {prefix}


def _json_paths(value, prefix: str = "") -> set[str]:
    if isinstance(value, dict):
        return set().union(*(_json_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(_json_paths(v, prefix + "[]") for v in value))
    return {prefix}


def select_mapping(paths: set[str], mappings: list[Mapping]) -> Mapping | None:
    """By the fingerprint of the paths that mappings know; failing that, the mapping with most fields that are all there."""
    known = frozenset().union(*(m.paths for m in mappings))
    exact = {fingerprint(m.paths): m for m in mappings}
    if hit := exact.get(fingerprint(known & paths)):
        return hit
    return max((m for m in mappings if m.paths <= paths), key=lambda m: len(m.paths), default=None)


def _apply(df: DataFrame, m: Mapping) -> DataFrame:
    role = lambda r: reduce(lambda out, p: F.when(r == p[0], F.lit(p[1])).otherwise(out), m.roles.items(), r)
    none = F.lit(None).cast("long")
    if m.messages:
        rows = df.select(F.col(m.conv).alias("conv_id"), F.posexplode(m.messages).alias("place", "_m"))
        return rows.select("conv_id", none.alias("turn"), F.col("place").cast("long"), role(F.col("_m")[m.role]).alias("role"), F.col("_m")[m.text].alias("text"))
    if m.slots:
        texts = [(r, F.concat_ws("\n\n", *[F.nullif(F.col(f), F.lit("")) for f in fields])) for r, fields in m.slots]
        turns = F.array(*[F.struct(F.lit(r).alias("role"), t.alias("text")) for r, t in texts])
        turns = F.filter(turns, lambda t: (t["role"] != "system") | (t["text"] != ""))
        rows = df.select(F.col(m.conv).alias("conv_id"), F.posexplode(turns).alias("place", "_t"))
        return rows.select("conv_id", none.alias("turn"), F.col("place").cast("long"), "_t.role", "_t.text")
    return df.select(F.col(m.conv).alias("conv_id"), F.col(m.turn).cast("long").alias("turn"), F.lit(0).cast("long").alias("place"), role(F.col(m.role)).alias("role"), F.col(m.text).alias("text"))


def canonical_turns(df: DataFrame, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """Turns of a table, by the fingerprint of its schema."""
    found = select_mapping(schema_paths(df.schema), mappings)
    if found is None:
        raise ValueError(f"no mapping for the layout {fingerprint(schema_paths(df.schema))} of {sorted(schema_paths(df.schema))}")
    return _apply(df, found)


def _schema(m: Mapping) -> str:
    if m.messages:
        return f"`{m.conv}` long, `{m.messages}` array<struct<`{m.role}`: string, `{m.text}`: string>>"
    return ", ".join(f"`{p}` {'long' if p in (m.conv, m.turn) else 'string'}" for p in sorted(m.paths))


def _routed(records: DataFrame, column: str, mappings: list[Mapping]) -> DataFrame:
    def names(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda r: _name_of(r, mappings))

    return records.select(F.col(column).alias("record"), F.pandas_udf(names, StringType())(F.col(column)).alias("layout"))


def _name_of(record: str | None, mappings: list[Mapping]) -> str | None:
    try:
        paths = _json_paths(json.loads(record or ""))
    except ValueError:
        return None
    found = select_mapping(paths, mappings)
    return found.name if found else None


def record_turns(records: DataFrame, column: str, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """Turns of JSON records of mixed layouts, each by the fingerprint of its own paths."""
    routed = _routed(records, column, mappings)
    each = [_apply(routed.where(F.col("layout") == m.name).select(F.from_json("record", _schema(m)).alias("r")).select("r.*"), m) for m in mappings]
    return reduce(DataFrame.unionByName, each)


def unknown_records(records: DataFrame, column: str, mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    return _routed(records, column, mappings).where(F.col("layout").isNull()).select("record")


def _escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """One chunk per turn, with the span of the chunk that the loss is taken on (assistant texts; empty for others)."""
    role = F.replace(_escape(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    body = _escape(F.col("text"))
    chunk = F.concat(F.lit(START), role, F.lit("\n"), body, F.lit(END))
    begin = F.length(role) + len(START) + 1
    size = F.when(F.col("role") == "assistant", F.length(body)).otherwise(0)
    return turns.select("conv_id", "turn", "place", chunk.alias("chunk"), begin.alias("loss_start"), (begin + size).alias("loss_end"))


_PARTS = r"(?s)^<\|im_start\|>((?:\\.|[^\\\n])*+)\n(.*)<\|im_end\|>\n$"


def read_back(chunks: DataFrame) -> DataFrame:
    """Turns out of formatted chunks: role, text, and the text under the loss mask."""
    loss = F.substring("chunk", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return chunks.select(
        "conv_id", "turn", "place",
        _unescape(F.regexp_extract("chunk", _PARTS, 1)).alias("role"),
        _unescape(F.regexp_extract("chunk", _PARTS, 2)).alias("text"),
        _unescape(loss).alias("loss"),
        F.length("chunk").cast("long").alias("chars"),
    )


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations that come one after the other; holds one running state, whatever a conversation's length."""
    state, names = None, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def row(s):
        return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        done = []
        for conv, role, text, loss, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss", "chars"))):
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(row(state))
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[3] += len(loss)
            state[4].update(loss.encode())
            state[5] += chars
        if done:
            yield batch_of(done)
    if state is not None:
        yield batch_of([row(state)])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation. Its turns come sorted to one task, which spills the sort and streams over it."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "place", "role", "text")
    return ordered.select("conv_id", "role", "text", "loss", "chars").mapInArrow(_digest_stream, _DIGEST)
