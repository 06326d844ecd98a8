"""Chat formatting of records of many layouts.

A record is a JSON object. Its fingerprint is a hash of the nested paths of its
fields; it selects a declarative mapping that turns prompt, instruction and
message layouts into canonical turns (role and text). A template then marks the
turns and escapes control strings inside texts, so that the formatted text can
be read back to the same turns.

The records of a conversation are brought together by one shuffle on its id and
sorted; they are then formatted, and read back, as a stream of turns, so memory
doesn't grow with the length of a conversation. The digest of a conversation
has to be taken in order, hence one task for each conversation.

Defined results: a null record, one that can't be read (no JSON, or nested too
deeply), one whose fingerprint is unknown, and one with a list item, role or text
of another kind than its layout has, give a row without turns that names the
fingerprint; a null role or text counts as empty, numbers and truth values as their
text; halves of surrogate pairs that stand alone become U+FFFD;
equal positions are ordered by record; repeated records are repeated turns; an
empty table gives an empty table; columns other than the three named are not
looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Mapping(NamedTuple):
    """Fields of a layout. each: the list that holds the messages, or "" for a record that is a message itself, with the
    fields of role and text; or turns: (role, fields whose texts are joined by an empty line). renames: whether ROLES holds
    for its roles; else they stay as they are."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    each: str | None = None
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    renames: bool = False


MAPPINGS = (
    Mapping("message row", (), ("role", "text"), each="", role="role", text="text"),
    Mapping("message row, content", ("content",), ("role",), each="", role="role", text="content"),
    Mapping("messages", ("messages", "messages[].role"), ("messages[].content",), each="messages", role="role", text="content"),
    Mapping("from and value", ("conversations", "conversations[].from"), ("conversations[].value",), each="conversations", role="from", text="value", renames=True),
    Mapping("instruction", ("instruction", "output"), ("input", "system"), turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("prompt and completion", ("prompt", "completion"), ("system",), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt and response", ("prompt", "response"), ("system",), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question and answer", ("question", "answer"), ("context",), turns=(("user", ("context", "question")), ("assistant", ("answer",)))),
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant"}


def field_paths(record: object) -> set[str]:
    """Paths of all fields that aren't null; the items of a list share one path. Marks of paths in names are escaped."""
    found, open_ = set(), [("", record)]
    while open_:
        at, value = open_.pop()
        if isinstance(value, list):
            open_ += [(f"{at}[]", v) for v in value]
        elif isinstance(value, dict):
            for k, v in value.items():
                if v is not None:
                    name = re.sub(r"([\\.\[\]])", r"\\\1", k)
                    path = f"{at}.{name}" if at else name
                    found.add(path)
                    open_.append((path, v))
    return found


def fingerprint(paths: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()


def compiled(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    """fingerprint -> mapping, with any of the optional fields absent."""
    return {
        fingerprint({*m.required, *some}): m for m in reversed(mappings) for n in range(len(m.optional) + 1) for some in combinations(m.optional, n)
    }


def _text(value: object) -> str:
    """A role or text; anything but a single value is of the wrong kind."""
    if value is None:
        return ""
    if not isinstance(value, str | int | float):
        raise TypeError("not a text")
    return str(value).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """Raises TypeError for values of the wrong kind."""
    if mapping.each is None:
        joined = ((role, [_text(record[f]) for f in fields if record.get(f) is not None]) for role, fields in mapping.turns)
        return [(role, "\n\n".join(texts)) for role, texts in joined if texts]
    messages = record[mapping.each] if mapping.each else [record]
    if not isinstance(messages, list) or not all(isinstance(m, dict) for m in messages):
        raise TypeError("not a list of messages")
    own = [(_text(m.get(mapping.role)), _text(m.get(mapping.text))) for m in messages]
    return [(ROLES.get(r, r), t) for r, t in own] if mapping.renames else own


def read(raw: str | None, known: dict[str, Mapping]) -> tuple[str, list[tuple[str, str]] | None]:
    """A record's fingerprint, and its turns; None if there is no layout for it."""
    try:
        value = json.loads(raw) if raw is not None else None
    except (ValueError, RecursionError):
        value = None
    mark = fingerprint(field_paths(value))
    if not isinstance(value, dict) or mark not in known:
        return mark, None
    try:
        return mark, turns_of(value, known[mark])
    except TypeError:
        return mark, None


OPEN, CLOSE = "<s>", "</s>\n"
#: Fixed strings of common templates and tokenizers that must not come out of a text.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|startoftext|>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
_CONTROL = re.compile("|".join(re.escape(x) for x in CONTROL))
_ESCAPED = re.compile(r"\\(n|\\|)")


def escaped(text: str) -> str:
    """A backslash is doubled; one is put after the first character of a control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def formatted(role: str, text: str) -> tuple[str, str]:
    """What comes before the text in a turn, and the text; CLOSE follows."""
    return OPEN + escaped(role).replace("\n", "\\n") + "\n", escaped(text)


def parsed(turn: str) -> tuple[str, str]:
    """role and escaped text of a formatted turn."""
    role, _, text = turn.removeprefix(OPEN).removesuffix(CLOSE).partition("\n")
    return _ESCAPED.sub(lambda m: {"n": "\n"}.get(m[1], m[1]), role), text


def segments(records: DataFrame, conv_id: str = "conv_id", position: str = "position", record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """The formatted text of each conversation, a row for each turn in order: conv_id, n (the turn's number), segment, the
    place of its loss-bearing text in the whole text of the conversation (loss_start, loss_end; null if none), and fingerprint."""
    kind = records.schema[conv_id].dataType.simpleString()
    known = compiled(mappings)

    def format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n, offset = object(), 0, 0
        for batch in batches:
            rows = []
            for conv, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if conv != current:
                    current, n, offset = conv, 0, 0
                mark, turns = read(raw, known)
                if turns is None:
                    rows.append((conv, n, None, None, None, mark))
                    continue
                for role, text in turns:
                    before, body = formatted(role, text)
                    start = offset + len(before)
                    loss = (start, start + len(body)) if role == "assistant" else (None, None)
                    rows.append((conv, n, before + body + CLOSE, *loss, mark))
                    n, offset = n + 1, start + len(body) + len(CLOSE)
            kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n", "segment", "loss_start", "loss_end", "fingerprint"])

    rows = records.select(records[conv_id].alias("conv_id"), records[position].alias("_position"), records[record].alias("_record"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "_position", "_record")
    return ordered.select("conv_id", "_record").mapInArrow(format_rows, f"conv_id {kind}, n long, segment string, loss_start long, loss_end long, fingerprint string")


def digests(formatted_turns: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its segments, which lie together and in order as segments() leaves them."""
    kind = formatted_turns.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row() -> tuple:
            conv, n, turns, chars, loss, total = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), total

        id_type = pa.int64()
        for batch in batches:
            rows, id_type = [], batch.schema.field(0).type
            for conv, segment, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if state is None or conv != state[0]:
                    rows += [row()] if state else []
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if segment is None:
                    continue
                role, body = parsed(segment)
                state[1] += 1
                state[2].update(f"{role}\n{unescaped(body)}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    own = unescaped(segment[start - state[5] : end - state[5]])
                    state[3] += len(own)
                    state[4].update(own.encode("utf-8", "surrogatepass"))
                state[5] += len(segment)
            yield result(rows, id_type)
        if state:
            yield result([row()], id_type)

    def result(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted_turns.mapInArrow(read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The conversation that the registered query adds.
ADDED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def of_rows(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as records, in turns in one of four layouts; rows without a common role in the first,
    which keeps every role as it is."""
    message = F.array(F.struct("role", F.col("text").alias("content")))
    said = F.array(F.struct(F.col("role").alias("from"), F.col("text").alias("value")))
    plain = F.to_json(F.struct("role", "text"))
    layout = F.when(F.col("role").isin("system", "user", "assistant"), F.pmod(F.col("turn"), F.lit(4)))
    record = (
        F.when((layout == 1) & F.col("text").isNotNull(), F.to_json(F.struct("role", F.col("text").alias("content"))))
        .when(layout == 2, F.to_json(F.struct(message.alias("messages"))))
        .when(layout == 3, F.to_json(F.struct(said.alias("conversations"))))
        .otherwise(plain)
    )
    return conversations.select("conv_id", F.col("turn").alias("position"), record.alias("record"))


_SQL_CONTROL = "|".join(re.sub(r"([\[\]/|<>])", r"\\\1", x) for x in CONTROL)

ORACLE_SQL = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES {", ".join(repr(x) for x in ADDED)}),
e AS (SELECT *, length(regexp_replace(replace(text, chr(92), repeat(chr(92), 2)), '({_SQL_CONTROL})', '\\1.', 'g')) AS n_escaped FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(OPEN) + 1 + len(CLOSE)} + length(role) + n_escaped)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
