"""Chat formatting: records of any known layout become turns, turns become one training string.

A record is a JSON document. The set of its nested field paths (arrays as ``[]``), restricted to
paths that some mapping names, is hashed to a schema fingerprint, and the fingerprint selects a
declarative mapping; fields that no mapping names therefore do not matter. A mapping is a list of
steps that turn fields into turns. Records of unknown layout come out with null turns and their
fingerprint, never dropped.

The template marks turns with control strings. Backslashes and control strings inside texts are led
by a backslash, so that any text can be read back. The loss mask holds the spans, in characters of
the formatted string, of the assistants' escaped texts.

Defined results: null texts are empty; a null role is an empty role; turns come by turn number
(nulls first), then role and text, so repeated turns all stay; rows without a conversation id form
one conversation; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import per_value

TURN = schemas.struct(role=schemas.STRING, text=schemas.STRING)
SPAN = schemas.struct(start=schemas.LONG, end=schemas.LONG)
FORMATTED = schemas.struct(
    fingerprint=schemas.STRING, layout=schemas.STRING, n_turns=schemas.LONG,
    formatted=schemas.STRING, loss=schemas.array(SPAN),
)

# Fixed values of the template.
_MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
_ROLE, _TURN = ("[ROLE]", "[/ROLE]"), ("[TURN]", "[/TURN]")
CONTROLS = tuple(m for pair in (*_MARKS.values(), _ROLE, _TURN) for m in pair)
_CONTROL = "|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True)))
_ESCAPED = re.compile(rf"\\|{_CONTROL}")
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TOKEN = re.compile(rf"\\.|({_CONTROL})", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """``turns``: (role, fields joined by a blank line), or ("each", list, role field, text field)."""

    name: str
    turns: tuple
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    roles: dict = field(default_factory=dict, hash=False)


MAPPINGS = (
    Mapping("messages", (("each", "messages", "role", "content"),),
            ("messages[].role", "messages[].content")),
    Mapping("conversations", (("each", "conversations", "from", "value"),),
            ("conversations[].from", "conversations[].value"), ("system",),
            {"human": "user", "gpt": "assistant", "bot": "assistant"}),
    Mapping("instruction", (("system", "system"), ("user", "instruction", "input"),
                            ("assistant", "output")),
            ("instruction", "output"), ("input", "system")),
    Mapping("prompt_completion", (("system", "system"), ("user", "prompt"), ("assistant", "completion")),
            ("prompt", "completion"), ("system",)),
    Mapping("prompt_response", (("system", "system"), ("user", "prompt"), ("assistant", "response")),
            ("prompt", "response"), ("system",)),
    Mapping("question_answer", (("user", "context", "question"), ("assistant", "answer")),
            ("question", "answer"), ("context",)),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """Paths of all leaves; arrays add ``[]``, empty containers are leaves."""
    if isinstance(value, dict) and value:
        inner = (field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items())
        return set().union(*inner)
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def _hash(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _registry() -> tuple[set[str], dict[str, Mapping]]:
    known = {p for m in MAPPINGS for p in (*m.required, *m.optional)}
    found = {}
    for mapping in MAPPINGS:
        for n in range(len(mapping.optional) + 1):
            for extra in itertools.combinations(mapping.optional, n):
                found[_hash({*mapping.required, *extra})] = mapping
    return known, found


_KNOWN, _BY_FINGERPRINT = _registry()
_EMPTY_LISTS = {m.turns[0][1]: m for m in MAPPINGS if m.turns[0][0] == "each"}


def fingerprint(record) -> str:
    return _hash(field_paths(record) & (_KNOWN | _EMPTY_LISTS.keys()))


_BY_FINGERPRINT |= {_hash({name}): mapping for name, mapping in _EMPTY_LISTS.items()}


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def canonical(record) -> list[tuple[str, str]] | None:
    """The record's turns as (role, text); None for an unknown layout."""
    mapping = _BY_FINGERPRINT.get(fingerprint(record))
    if mapping is None:
        return None
    turns = []
    for step in mapping.turns:
        if step[0] == "each":
            if mapping.name == "conversations" and record.get("system"):
                turns.append(("system", _text(record["system"])))
            for item in record.get(step[1]) or []:
                role = _text((item or {}).get(step[2]))
                turns.append((mapping.roles.get(role, role), _text((item or {}).get(step[3]))))
        else:
            role, *fields = step
            parts = [_text(record.get(f)) for f in fields if record.get(f) is not None]
            if parts or role != "system":
                turns.append((role, "\n\n".join(p for p in parts if p)))
    return turns


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m.group(0), text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The turns as one string, and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        opening, closing = _MARKS.get(role) or _TURN
        if role not in _MARKS:
            opening = _ROLE[0] + escape(role) + _ROLE[1] + opening
        inner = escape(text)
        if role == "assistant":
            spans.append((at + len(opening), at + len(opening) + len(inner)))
        parts += (opening, inner, closing)
        at += len(opening) + len(inner) + len(closing)
    return "".join(parts), spans


def parsed(string: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    by_opening = {pair[0]: role for role, pair in _MARKS.items()}
    turns, role, start = [], None, 0
    for token in _TOKEN.finditer(string):
        mark = token.group(1)
        if mark is None:
            continue
        if mark in by_opening:
            role, start = by_opening[mark], token.end()
        elif mark in (_ROLE[0], _TURN[0]):
            start = token.end()
        elif mark == _ROLE[1]:
            role = unescape(string[start : token.start()])
        else:
            turns.append((role, unescape(string[start : token.start()])))
    return turns


def _format_record(record: str | None):
    try:
        value = json.loads(record) if record else None
    except ValueError:
        value = None
    name = fingerprint(value) if value is not None else None
    turns = canonical(value) if isinstance(value, dict) else None
    if turns is None:
        return name, None, None, None, None
    string, spans = formatted(turns)
    return name, _BY_FINGERPRINT[name].name, len(turns), string, spans


def format_records(records: Column) -> Column:
    """JSON records as formatted strings with their loss spans."""
    return per_value(_format_record, FORMATTED)(records)


def conversation_records(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, record): the rows of a conversation as one JSON record of messages.

    A conversation becomes one training string, so its rows have to meet; it is as large as that.
    """
    said = F.struct(
        F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"),
    )
    messages = F.transform(
        F.array_sort(F.collect_list(said)), lambda m: F.struct(m["role"], m["content"])
    )
    return rows.groupBy(F.col(f"`{key}`").alias(key)).agg(
        F.to_json(F.struct(messages.alias("messages"))).alias("record")
    )


def with_format(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with fingerprint, layout, n_turns, formatted and loss in place of ``record``."""
    made = records.withColumn(record, format_records(F.col(f"`{record}`")))
    kept = [F.col(f"`{c}`") for c in records.columns if c != record]
    return made.select(*kept, F.col(f"`{record}`.*"))


READ_BACK = schemas.struct(
    n_turns=schemas.LONG, turns_sha256=schemas.STRING, loss_chars=schemas.LONG,
    loss_sha256=schemas.STRING, formatted_chars=schemas.LONG,
)


def read_back(string: Column, loss: Column) -> Column:
    """Counts and digests of turns and loss text, as parsed from the formatted string."""


    def digests(made: dict):
        whole, turns = made["whole"], hashlib.sha256()
        said = parsed(whole)
        for role, text in said:
            turns.update(f"{role}\n{text}\n".encode())
        learned = "".join(unescape(whole[s["start"] : s["end"]]) for s in made["masked"])
        spoken = hashlib.sha256(learned.encode()).hexdigest()
        return len(said), turns.hexdigest(), len(learned), spoken, len(whole)

    return per_value(digests, READ_BACK)(F.struct(string.alias("whole"), loss.alias("masked")))
