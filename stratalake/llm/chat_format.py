"""Chat formatting by schema fingerprints.

A record is a JSON object in one of many layouts. Its schema is the set of its
nested field paths (list elements share one path); the hash of the sorted paths is
its fingerprint. The first record with a fingerprint looks up the first declared
layout whose paths it has; all later ones find it by the fingerprint alone. The
layout says where turns, roles and texts are, and every record becomes turns
(role, text). A text is a string, a number, or a list of strings and of objects with a
``text``. Records that fit no layout give a row with ``layout`` null and no turn; the
paths of strings that are in no turn stand in ``unread``, so that nothing is lost unseen.

A conversation is its turns by turn number, place in the record, role and text; it
becomes one text. Turns are sorted in their partition and formatted one by one, so that
none is ever held whole: a long text comes in pieces of whole turns, in order, each with
its begin in the text. In that text every turn is
marked, and control strings inside roles and texts are escaped so that the marks
cannot be imitated and the texts come back exactly. The loss mask lists where the
assistant's texts are. Null roles and texts are empty. Rows without a conversation
id make one conversation of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.llm.common import in_slices, read

# A piece of a conversation is ended by the turn that reaches so many characters.
PIECE_CHARS = 1_000_000
TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
# Control strings of public chat templates.
CONTROL = [TURN, TEXT, END, "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
# Other names for the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}


@dataclass(frozen=True)
class Part:
    """Turns of a record: ``each`` is the path of a list, or empty for the record itself.

    ``role`` is a path if it starts with ``$``, else the role itself. ``text`` lists
    paths whose non-empty values are joined with an empty line. With ``pairs``, lists
    among the elements are texts of the user and the assistant in turn.
    """

    role: str
    text: tuple[str, ...]
    each: str = ""
    optional: bool = False
    pairs: bool = False

    def paths(self) -> set[str]:
        start = f"{self.each}[]." if self.each else ""
        found = {start + t for t in self.text[:1]}
        return set() if self.optional else found | ({start + self.role[1:]} if self.role[0] == "$" else set())


@dataclass(frozen=True)
class Layout:
    name: str
    parts: tuple[Part, ...]

    def paths(self) -> set[str]:
        return set().union(*[p.paths() for p in self.parts])


SYSTEM = Part("system", ("system",), optional=True)
HISTORY = Part("$role", ("content",), "history", optional=True, pairs=True)
PROMPTS, COMPLETIONS, RESPONSES = (Part("$role", ("content",), each) for each in ("prompt", "completion", "response"))
PROMPT, COMPLETION, RESPONSE = Part("user", ("prompt",)), Part("assistant", ("completion",)), Part("assistant", ("response",))
LAYOUTS = [
    Layout("message parts", (SYSTEM, Part("$role", ("content[].text",), "messages"))),
    Layout("messages", (SYSTEM, Part("$role", ("content",), "messages"))),
    Layout("from and value", (SYSTEM, Part("$from", ("value",), "conversations"))),
    Layout("nested messages", (Part("$role", ("content",), "data.messages"),)),
    Layout("dialog turns", (SYSTEM, Part("$speaker", ("text",), "turns"))),
    Layout("instruction and output", (SYSTEM, HISTORY, Part("user", ("instruction", "input")), Part("assistant", ("output",)))),
    Layout("instruction and response", (SYSTEM, HISTORY, Part("user", ("instruction", "context")), RESPONSE)),
    Layout("prompt and completion messages", (SYSTEM, HISTORY, PROMPTS, COMPLETIONS)),
    Layout("prompt messages and completion", (SYSTEM, HISTORY, PROMPTS, COMPLETION)),
    Layout("prompt and response messages", (SYSTEM, HISTORY, PROMPTS, RESPONSES)),
    Layout("prompt messages and response", (SYSTEM, HISTORY, PROMPTS, RESPONSE)),
    Layout("prompt and messages of a completion", (SYSTEM, HISTORY, PROMPT, COMPLETIONS)),
    Layout("prompt and messages of a response", (SYSTEM, HISTORY, PROMPT, RESPONSES)),
    Layout("prompt and completion", (SYSTEM, HISTORY, PROMPT, COMPLETION)),
    Layout("prompt and response", (SYSTEM, HISTORY, PROMPT, RESPONSE)),
    Layout("question and answer", (SYSTEM, HISTORY, Part("user", ("question", "context")), Part("assistant", ("answer",)))),
    Layout("one turn", (Part("$role", ("text",)),)),
    Layout("one message", (Part("$role", ("content",)),)),
]


def field_paths(value: object, at: str = "") -> set[str]:
    """The paths of all fields; elements of a list share one."""
    if isinstance(value, dict):
        below = [field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()]
        return set().union({at} if at else set(), *below)
    if isinstance(value, list):
        return set().union({at}, *[field_paths(v, f"{at}[]") for v in value])
    return {at} if at else set()


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=16).hexdigest()


def layout_of(paths: set[str]) -> Layout | None:
    return next((layout for layout in LAYOUTS if layout.paths() <= paths), None)


Place = tuple[str | int, ...]


def _at(value: object, path: str, place: Place = ()) -> tuple[object, Place]:
    """The value of a path, and its place: the keys and indices that lead there."""
    for name in path.split(".") if path else []:
        value, place = value.get(name) if isinstance(value, dict) else None, (*place, name)
    return value, place


def _text(value: object, place: Place, seen: set[Place]) -> str:
    """The text of a value, or nothing; the places of strings that are in it are ``seen``."""
    if isinstance(value, str):
        seen.add(place)
        return value
    if isinstance(value, (bool, int, float)):
        return json.dumps(value)
    parts = enumerate(value) if isinstance(value, list) else []
    return "".join(_text(*(_at(v, "text", (*place, i)) if isinstance(v, dict) else (v, (*place, i))), seen) for i, v in parts)


def turns_of(record: object, layout: Layout, seen: set[Place] | None = None) -> Iterator[tuple[str, str]]:
    """Role and text of each turn; the places of the strings that they hold go to ``seen``."""
    seen = set() if seen is None else seen
    for part in layout.parts:
        items, place = _at(record, part.each)
        places = [(*place, i) for i in range(len(items))] if part.each and isinstance(items, list) else [place]
        items = items if part.each and isinstance(items, list) else [items]
        for item, at in zip(items, places):
            if part.pairs and isinstance(item, list):
                for i, value in enumerate(item):
                    yield ("user", "assistant")[i % 2], _text(value, (*at, i), seen)
            if not isinstance(item, dict):
                continue
            # The path of parts chooses a layout; a single text may stand in place of the list.
            texts = [t for p in part.text if (t := _text(*_at(item, p.split("[]")[0], at), seen)) != ""]
            if part.optional and not texts:
                continue
            role = _text(*_at(item, part.role[1:], at), seen) if part.role[0] == "$" else part.role
            yield ROLES.get(role, role), "\n\n".join(texts)


def unread(value: object, seen: set[Place], place: Place = (), path: str = "") -> set[str]:
    """The paths of strings, but empty ones, whose places are not ``seen``."""
    if isinstance(value, dict):
        return set().union(*[unread(v, seen, (*place, k), f"{path}.{k}" if path else k) for k, v in value.items()])
    if isinstance(value, list):
        return set().union(*[unread(v, seen, (*place, i), f"{path}[]") for i, v in enumerate(value)])
    return {path} if isinstance(value, str) and value and place not in seen else set()


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """The other columns of ``records`` with fingerprint, layout, place, role and text of each turn, and the unread paths.

    These six replace columns of the same names. A record that is no JSON, is nested too deeply, or
    holds half a surrogate pair, is unread as a whole, under the empty path.
    """
    made = StructType.fromDDL("fingerprint string, layout string, place int, role string, text string, unread array<string>")
    others = [c for c in records.columns if c not in (record, *made.names)]
    schema = StructType([records.schema[c] for c in others] + made.fields)

    made_schema = pa.schema(
        [
            ("fingerprint", pa.string()),
            ("layout", pa.string()),
            ("place", pa.int32()),
            ("role", pa.string()),
            ("text", pa.string()),
            ("unread", pa.list_(pa.string())),
        ]
    )

    def rows_of(parsed: object, known: dict[str, Layout | None]) -> list[tuple]:
        paths = field_paths(parsed)
        key = fingerprint(paths)
        if key not in known:
            known[key] = layout_of(paths)
        layout = known[key]
        seen: set[Place] = set()
        turns = list(turns_of(parsed, layout, seen)) if layout else []
        left = sorted(unread(parsed, seen))
        found = [(key, layout.name, n, *turn, left) for n, turn in enumerate(turns)] if turns else []
        return found or [(key, layout.name if layout else None, None, None, None, left)]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Layout | None] = {}
        for batch in batches:
            index, rows = [], []
            for i, value in enumerate(batch.column(record).to_pylist()):
                try:
                    parsed = json.loads(value) if value else {}
                    if value and "\\u" in value:
                        json.dumps(parsed, ensure_ascii=False).encode()  # half a character is no text
                    found = rows_of(parsed, known)
                except (ValueError, RecursionError):  # also where it is nested too deeply to be read
                    found = rows_of(value, known)
                index += [i] * len(found)
                rows += found
            kept = batch.select(others).take(pa.array(index, pa.int64()))
            new = [pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 6, made_schema)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*others, *made_schema.names])

    return records.mapInArrow(convert, schema)


_TO_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, sorted(CONTROL, key=len, reverse=True))]))
_FIRST = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\": "\\", "l": "<", "b": "["}


def escaped(text: str) -> str:
    """Backslashes are doubled; the first character of a control string becomes an escape."""
    return _TO_ESCAPE.sub(lambda m: _FIRST[m[0][0]] + m[0][1:], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\([\\lb])", lambda m: _BACK[m[1]], text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The text of a conversation, and its loss mask: begin and end of each assistant text."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        if role == "assistant":
            mask += [at + len(head), at + len(head) + len(body)]
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), mask


def parsed_back(conversation: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in conversation.split(END)[:-1]:
        role, text = part.removeprefix(TURN).split(TEXT, 1)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def _format_rows(batches: Iterator[pa.RecordBatch], piece_chars: int) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
    names = ["conv_id", "piece", "begin", "formatted", "loss_mask"]
    key, piece, begin, size, turns, opened = None, 0, 0, 0, [], False
    rows = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, types)], names)

    for batch in in_slices(batches):
        for conv_id, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
            other = opened and conv_id != key
            if other or size >= piece_chars:
                made, mask = formatted(turns)
                rows.append((key, piece, begin, made, mask))
                piece, begin = (0, 0) if other else (piece + 1, begin + len(made))
                size, turns = 0, []
            key, opened = conv_id, True
            if place is not None:
                turns.append((role or "", text or ""))
                size += len(turns[-1][0]) + len(turns[-1][1]) + len(TURN + TEXT + END)
        yield batch_of(rows)
        rows = []
    if opened:
        yield batch_of([(key, piece, begin, *formatted(turns))])


def conversations(turns: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``turns`` (conv_id, turn, place, role, text) as formatted texts and loss masks.

    A row per conversation, or per piece of a long one: piece counts from 0, begin is the
    piece's first character in the text of the conversation, and the loss mask counts from
    there. The pieces of a conversation follow each other in one partition.
    """
    rows = turns.select("conv_id", "turn", "place", "role", "text").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "turn", "place", "role", "text")
    schema = "conv_id long, piece long, begin long, formatted string, loss_mask array<long>"
    return rows.mapInArrow(lambda batches: _format_rows(batches, piece_chars), schema)


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Digest:
    """What is read back from the pieces of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, mask: list[int]) -> None:
        for role, body in parsed_back(text):
            self.n_turns += 1
            self.said.update(f"{role}\n{body}\n".encode())
        for a, b in zip(mask[::2], mask[1::2]):
            loss = unescaped(text[a:b])
            self.loss_chars += len(loss)
            self.loss.update(loss.encode())
        self.chars += len(text)

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)], names)

    digest = None
    for batch in in_slices(batches):
        rows = []
        for conv_id, piece, text, mask in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "piece", "formatted", "loss_mask")]):
            if piece == 0:
                rows += [digest.row()] if digest else []
                digest = _Digest(conv_id)
            digest.add(text, mask)
        yield batch_of(rows)
    if digest:
        yield batch_of([digest.row()])


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the one with id -1, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    columns = ["conv_id", "turn", "role", "text"]
    rows = read(spark, sf_dir, "conversations").select(*columns)
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    records = rows.unionByName(extra).select("conv_id", "turn", record.alias("record"))
    return conversations(canonical_turns(records)).mapInArrow(_read_rows, READ_BACK)


def _sql() -> str:
    longest = sorted(CONTROL, key=len, reverse=True)
    pattern = "|".join(re.escape(c).replace("\\<", "<").replace("\\>", ">") for c in longest)
    grown = lambda c: (
        f"length({c}) + length({c}) - length(replace({c}, '\\', '')) + len(regexp_extract_all({c}, '{pattern}'))"
    )
    marks = len(TURN) + len(TEXT) + len(END)
    return f"""
    WITH rows AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum({marks} + {grown('role')} + {grown('text')})::BIGINT AS formatted_chars
    FROM rows GROUP BY conv_id
    """


OP4_SQL = _sql()
