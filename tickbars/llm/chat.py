r"""Chat formatting: records of any known layout become canonical turns, and turns one text with a loss mask.

A record is a JSON object. Its fingerprint is a hash of the sorted paths of its non-null fields (array elements share the
path ``[]``), and a fingerprint selects a declarative mapping: the first whose required paths the record has. A mapping
is worked out once per fingerprint. A mapping lists turns: a role, or the path of one, and the path of a text, either of
the record or of each element of an array. Unknown layouts give no turns and a null layout; nothing is dropped.

The template writes each turn as ``### role: text</turn>`` and a line end. Inside roles and texts a backslash is doubled
and a control string is broken by one: ``<\/turn>``, ``:\ `` in roles, and one before each ``#`` of three or more in a row
(``\#\#\#``), so no control string is left inside and the text can be read back exactly; a null role is ``\0``. The loss mask is the list of
spans (code points) of assistant texts.

Null texts are empty turns. Turns of equal number keep a fixed order, by role and text. A record that is no JSON object
has no layout. A conversation is one row, as long as it is; conversations are never gathered together.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.words import slices

#: Conversations that are Python objects at a time.
ROWS = 256
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
TURNS = "array<struct<role:string,text:string>>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Turn:
    """One turn of a mapping: the path of a text, and a role or (``role_path``) where it stands."""

    text: str
    role: str | None = None
    role_path: str | None = None
    #: Other text put behind, after an empty line, if it is there and not empty.
    more: str | None = None


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths it needs, and its turns; ``each`` names the array whose elements are the turns."""

    name: str
    needs: frozenset[str]
    turns: tuple[Turn, ...]
    each: str | None = None
    order: str | None = None


#: Names that other data sets give to roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}

MAPPINGS = (
    Mapping(
        "numbered turns",
        frozenset({"turns[].turn"}),
        (Turn("text", role_path="role"),),
        each="turns",
        order="turn",
    ),
    # Where all numbers are null, JSON has none.
    Mapping("numbered turns", frozenset({"turns[].text"}), (Turn("text", role_path="role"),), each="turns", order="turn"),
    Mapping("messages", frozenset({"messages[].content"}), (Turn("content", role_path="role"),), each="messages"),
    Mapping(
        "conversations", frozenset({"conversations[].value"}), (Turn("value", role_path="from"),), each="conversations"
    ),
    Mapping(
        "instruction",
        frozenset({"instruction", "output"}),
        (Turn("system", "system"), Turn("instruction", "user", more="input"), Turn("output", ASSISTANT)),
    ),
    Mapping("prompt", frozenset({"prompt", "completion"}), (Turn("prompt", "user"), Turn("completion", ASSISTANT))),
    Mapping("prompt", frozenset({"prompt", "response"}), (Turn("prompt", "user"), Turn("response", ASSISTANT))),
    Mapping("question", frozenset({"question", "answer"}), (Turn("question", "user"), Turn("answer", ASSISTANT))),
)


def paths(value, at: str = "") -> set[str]:
    """The paths of all fields that are not null."""
    if isinstance(value, dict):
        return {p for name, x in value.items() for p in paths(x, f"{at}.{name}" if at else name)}
    if isinstance(value, list):
        return {p for x in value for p in paths(x, f"{at}[]")}
    return set() if value is None else {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(found)).encode(), digest_size=8).hexdigest()


def _value(record, path: str | None):
    if path is None:
        return None
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record: dict, mapping: Mapping) -> list[tuple[str | None, str]]:
    """The (role, text) turns of a record."""
    parts = [x for x in _value(record, mapping.each) or [] if isinstance(x, dict)] if mapping.each else [record]
    turns = []
    for part in parts:
        for turn in mapping.turns:
            text, more = _value(part, turn.text), _value(part, turn.more)
            if mapping.each is None and text is None:
                continue
            role = turn.role if turn.role_path is None else _value(part, turn.role_path)
            role = None if role is None else ROLES.get(_text(role), _text(role))
            number = _value(part, mapping.order)
            turns.append((number is None, number or 0, role is not None, role or "", _text(text) + (f"\n\n{_text(more)}" if more else "")))
    if mapping.order:
        turns.sort()
    return [(role if known else None, text) for _, _, known, role, text in turns]


def escaped(text: str) -> str:
    text = text.replace("\\", "\\\\")
    text = text.replace("</turn>", "<\\/turn>")
    return re.sub("#{3,}", lambda run: "\\#" * len(run[0]), text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _role(role: str | None) -> str:
    return "\\0" if role is None else escaped(role).replace(MIDDLE, ":\\ ")


def formatted(turns: list[tuple[str | None, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns and the spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{_role(role)}{MIDDLE}", escaped(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_back(text: str) -> list[tuple[str | None, str]]:
    """The turns that a formatted text was made of."""
    turns = []
    for part in text.split(CLOSE)[:-1]:
        role, _, body = part[len(OPEN) :].partition(MIDDLE)
        turns.append((None if role == "\\0" else unescaped(role), unescaped(body)))
    return turns


def canonical_turns(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """The rows with fingerprint, layout (null if none fits) and turns of a JSON text column."""

    def mapped(batches):
        known: dict[str, Mapping | None] = {}
        for batch in (part for whole in batches for part in slices(whole, record)):
            prints, layouts, turns = [], [], []
            for text in batch.column(record).to_pylist():
                try:
                    value = json.loads(text) if text else None
                except ValueError:
                    value = None
                found = paths(value) if isinstance(value, dict) else set()
                key = fingerprint(found)
                if key not in known:
                    known[key] = next((m for m in mappings if m.needs <= found), None)
                mapping = known[key]
                prints.append(key)
                layouts.append(mapping and mapping.name)
                turns.append([{"role": r, "text": t} for r, t in canonical(value, mapping)] if mapping else [])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(prints, pa.string()),
                    pa.array(layouts, pa.string()),
                    pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                ],
                [*batch.schema.names, "fingerprint", "layout", "turns"],
            )

    added = T._parse_datatype_string(f"fingerprint string, layout string, turns {TURNS}").fields
    return records.mapInArrow(mapped, T.StructType([*records.schema.fields, *added]))


def with_format(chats: DataFrame, turns: str = "turns") -> DataFrame:
    """The rows with formatted and loss_spans in place of their turns."""
    names = [n for n in chats.columns if n != turns]

    def written_out(batches):
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            found = [formatted([(x["role"], x["text"]) for x in row or []]) for row in batch.column(turns).to_pylist()]
            spans = [[{"low": low, "high": high} for low, high in own] for _, own in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array([text for text, _ in found], pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
                ],
                [*names, "formatted", "loss_spans"],
            )

    kept = [chats.schema[n] for n in names]
    added = T._parse_datatype_string("formatted string, loss_spans array<struct<low:long,high:long>>").fields
    return chats.mapInArrow(written_out, T.StructType([*kept, *added]))


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(chats: DataFrame, carry: list[str]) -> DataFrame:
    """What can be read back from formatted texts and their loss masks."""

    names = [*carry, *(f.name for f in T._parse_datatype_string(DIGESTS).fields)]

    def read(batches):
        for batch in (part for whole in batches for part in slices(whole, "formatted")):
            rows = []
            for text, spans in zip(
                batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True
            ):
                turns = read_back(text)
                loss = "".join(unescaped(text[s["low"] : s["high"]]) for s in spans)
                whole = "".join(f"{role or ''}\n{said}\n" for role, said in turns)
                rows.append((len(turns), _sha256(whole), len(loss), _sha256(loss), len(text)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in carry), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
                names,
            )

    kept = [chats.schema[n] for n in carry]
    return chats.mapInArrow(read, T.StructType([*kept, *T._parse_datatype_string(DIGESTS).fields]))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def records_of_rows(rows: DataFrame, id: str = "conv_id") -> DataFrame:
    """One record (id, record) per conversation of rows (id, turn, role, text), in the layout of numbered turns."""
    turn = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = F.array_sort(F.collect_list(turn))
    return rows.groupBy(id).agg(F.to_json(F.struct(turns.alias("turns"))).alias("record"))
