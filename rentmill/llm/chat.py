"""Chat formatting: records of any known layout become canonical turns, and turns become one training text.

A record's layout is recognised by a fingerprint: the SHA-256 of its sorted nested field paths with their types, of all paths that any
layout declares. Each fingerprint selects a declarative mapping, a SQL expression that yields the canonical turns
``array<struct<role string, text string>>``. A record with the fields of two layouts has neither's fingerprint, so nothing of it is
lost silently: it is an error that names the paths, as is a layout nobody has declared. A layout stored as rows per turn is
gathered into a record with rows first and mapped then. Everything is built-in functions.

The template marks a turn as ``<|role|>text<|end|>``. ``&`` and ``<`` inside roles and texts are written as
entities, so no text can hold a mark or any other control string that starts with ``<``; square-bracket control
strings are broken up the same way. Formatting is undone exactly by :func:`read_back`.

Null roles and texts are read as empty; a conversation without turns is the empty text. Turns are ordered by
turn number (null first), then role and text, so repeated turn numbers have a defined order. Rows per turn whose conv_id is null
are one conversation. A conversation is one row of the result, so it is gathered in one task.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"

# The marks of the template and the entities that stand for its control characters. The escape
# character comes first when escaping and last when undoing it.
OPEN, MIDDLE, CLOSE = "<|", "|>", "<|end|>"
ENTITIES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("]", "&rsqb;"), ("|", "&vert;")]


def field_paths(kind: T.DataType, path: str = "") -> list[str]:
    """The leaf fields of a schema as paths, arrays as ``[]``, each with its type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{path}[]")
    return [f"{path}:{kind.simpleString()}"]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _single(*turns: tuple[str, str]) -> str:
    """Turns with fixed roles; a turn whose text is null or empty and whose role is not required is left out."""
    made = ", ".join(f"named_struct('role', '{role}', 'text', coalesce({text}, ''))" for role, text in turns)
    return f"array({made})"


def _renamed(array: str, role: str, text: str) -> str:
    return f"transform({array}, m -> named_struct('role', coalesce(m.{role}, ''), 'text', coalesce(m.{text}, '')))"


# Declared layouts: the field paths of a record without its id, and the expression that gives its turns.
LAYOUTS: dict[str, tuple[list[str], str]] = {
    "messages": (["messages[].role:string", "messages[].content:string"], _renamed("messages", "role", "content")),
    "from_value": (["conversations[].from:string", "conversations[].value:string"],
                   "transform(conversations, m -> named_struct('role', CASE m.from WHEN 'human' THEN 'user' "
                   "WHEN 'gpt' THEN 'assistant' ELSE coalesce(m.from, '') END, 'text', coalesce(m.value, '')))"),
    "prompt": (["prompt:string", "completion:string"], _single(("user", "prompt"), ("assistant", "completion"))),
    "instruction": (["instruction:string", "input:string", "output:string"],
                    _single(("user", "concat_ws('\\n\\n', instruction, nullif(input, ''))"), ("assistant", "output"))),
    "question": (["system:string", "question:string", "response:string"],
                 f"concat(filter({_single(('system', 'system'))}, t -> t.text != ''), "
                 f"{_single(('user', 'question'), ('assistant', 'response'))})"),
}
ROWS_PER_TURN = ["role:string", "text:string", "turn:bigint"]
GATHERED = ["rows[].turn:bigint", "rows[].role:string", "rows[].text:string"]
MAPPINGS = {fingerprint(paths): mapping for paths, mapping in LAYOUTS.values()}
MAPPINGS[fingerprint(GATHERED)] = _renamed("rows", "role", "text")
DECLARED = {p for paths, _ in LAYOUTS.values() for p in paths} | set(ROWS_PER_TURN) | set(GATHERED)


def _gathered(rows: DataFrame, key: str) -> DataFrame:
    """Rows per turn as one record per conversation, in the order of the turns."""
    turn = F.struct("turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")))
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("rows"))


def canonical_turns(records: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key`` and ``turns`` of records in any declared layout, recognised by fingerprint.

    Columns that no layout declares are ignored.
    """
    paths = [p for f in records.schema.fields if f.name != key for p in field_paths(f.dataType, f.name)]
    known = fingerprint([p for p in paths if p in DECLARED])
    if known == fingerprint(ROWS_PER_TURN):
        records, known = _gathered(records, key), fingerprint(GATHERED)
    if known not in MAPPINGS:
        raise ValueError(f"no mapping for the layout {sorted(paths)}")
    return records.select(key, F.expr(MAPPINGS[known]).cast(TURNS).alias("turns"))


def _escaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)


def _plain(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ENTITIES), text)


def format_turns(conversations: DataFrame, key: str = "conv_id", trained_role: str = "assistant") -> DataFrame:
    """``key``, ``formatted`` and ``loss_spans``: the training text and the code points that carry loss.

    A span is (start, length) of the escaped text of a turn of ``trained_role``, its marks left out.
    """
    pieces = F.transform(
        F.coalesce(F.col("turns"), F.array().cast(TURNS)),
        lambda t: F.struct(
            (t["role"] == trained_role).alias("trained"),
            F.concat(F.lit(OPEN), _escaped(t["role"]), F.lit(MIDDLE)).alias("head"),
            _escaped(t["text"]).alias("body"),
        ),
    )
    placed = F.aggregate(
        "pieces",
        F.expr("named_struct('at', 0, 'spans', CAST(array() AS array<struct<start:int,length:int>>))"),
        lambda done, p: F.struct(
            (done["at"] + F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).alias("at"),
            F.when(
                p["trained"],
                F.array_append(done["spans"], F.struct((done["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length"))),
            ).otherwise(done["spans"]).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return conversations.select(key, pieces.alias("pieces")).select(
        key, text.alias("formatted"), placed.alias("loss_spans")
    )


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key``, ``turns`` and ``loss_texts`` parsed from the formatted text alone and from the spans over it."""
    parts = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: p != "")
    turns = F.transform(
        parts,
        lambda p: F.struct(
            _plain(F.substring_index(F.substring(p, len(OPEN) + 1, 2**31 - 1), MIDDLE, 1)).alias("role"),
            _plain(F.substr(p, F.instr(p, MIDDLE) + len(MIDDLE))).alias("text"),
        ),
    )
    loss = F.transform("loss_spans", lambda s: _plain(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select(key, "formatted", turns.alias("turns"), loss.alias("loss_texts"))
