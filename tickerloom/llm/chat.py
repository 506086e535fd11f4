"""Chat layouts to canonical turns by schema fingerprint, and a reversible chat template.

A record is JSON of any layout. The hashes of its nested field paths are its fingerprint;
a layout is a declarative mapping that names the paths it needs and where roles and texts
are. The fingerprint selects the mapping once per worker; records of the same shape then
take it from there. A message in which that mapping finds no text is read by the first other
mapping of messages that finds one, as the messages of a record may differ.

The template is ``### role: text</turn>`` and a line end per turn. A backslash escapes
itself and the first sign of any marker inside a text or role.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, clean_text

OPEN, CLOSE = "### ", "</turn>\n"
LEARNED_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """``each`` names the list of messages; ``turns`` lists (role, text paths) otherwise."""

    name: str
    needs: tuple[str, ...]
    each: str = ""
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict = field(default_factory=dict, hash=False)


SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

# The first layout whose paths are all present is taken.
LAYOUTS = (
    Layout("message parts", ("messages[].role", "messages[].content[].text"),
           "messages", "role", "content[].text"),
    Layout("messages", ("messages[].role", "messages[].content"), "messages", "role", "content"),
    Layout("from and value", ("conversations[].from", "conversations[].value"),
           "conversations", "from", "value", roles=SPOKEN),
    Layout("instruction", ("instruction", "output"),
           turns=(("system", ("system",)), ("user", ("instruction", "input")),
                  ("assistant", ("output",)))),
    Layout("prompt and completion", ("prompt", "completion"),
           turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt and response", ("prompt", "response"),
           turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question and answer", ("question", "answer"),
           turns=(("user", ("context", "question")), ("assistant", ("answer",)))),
    Layout("message row", ("role", "text"), each="", role="role", text="text"),
    Layout("message row with content", ("role", "content"), each="", role="role", text="content"),
)


def field_paths(value: object, above: str = "") -> set[str]:
    """Nested field paths; list elements share ``[]``."""
    if isinstance(value, dict):
        found = set()
        for key, inner in value.items():
            path = f"{above}.{key}" if above else key
            found |= {path} | field_paths(inner, path)
        return found
    if isinstance(value, list):
        return set().union(*(field_paths(inner, f"{above}[]") for inner in value))
    return set()


def fingerprint(paths: set[str]) -> str:
    return xxhash.xxh3_64_hexdigest("\n".join(sorted(xxhash.xxh3_64_hexdigest(p) for p in paths)))


def _texts(value: object, path: str) -> list[str]:
    head, _, rest = path.partition(".")
    key, many = (head[:-2], True) if head.endswith("[]") else (head, False)
    inner = value.get(key) if isinstance(value, dict) else None
    parts = inner if many and isinstance(inner, list) else [inner]
    if rest:
        return [text for part in parts
                for text in ([part] if many and isinstance(part, str) else _texts(part, rest))]
    return [part if isinstance(part, str) else json.dumps(part, ensure_ascii=False)
            for part in parts if part is not None]


def _has_content(value: object) -> bool:
    """Whether there is anything to say in a value, besides roles and kinds."""
    if isinstance(value, dict):
        return any(_has_content(inner) for key, inner in value.items() if key not in ("role", "from", "type"))
    if isinstance(value, list):
        return any(map(_has_content, value))
    return value is not None and value != ""


def _whole(layout: Layout, message: object) -> bool:
    """Whether every part of a message's text is found by the layout's path."""
    path, _, rest = layout.text.partition("[].")
    parts = message.get(path) if rest and isinstance(message, dict) else None
    return not isinstance(parts, list) or all(
        isinstance(part, str) or _texts(part, rest) or not _has_content(part) for part in parts)


def _message(layout: Layout, others: list[Layout], message: object) -> tuple[tuple[str, str] | None, bool]:
    """Role and text by the first layout that finds a text, and whether nothing is left over."""
    own = None
    for way in (layout, *others):
        role, said = "".join(_texts(message, way.role)), "".join(_texts(message, way.text))
        if own is None:
            own = layout.roles.get(role, role)
        if said:
            return (own or way.roles.get(role, role), said), _whole(way, message)
    if _has_content(message) or not isinstance(message, dict):
        return None, False
    return (own, ""), True


def _apply(layout: Layout, others: list[Layout], record: dict) -> Iterator[tuple[int | None, str | None, str | None]]:
    """Numbered turns of a record, and a row of None for each message not mapped in full."""
    if layout.turns:
        n = 0
        for role, paths in layout.turns:
            texts = [text for path in paths for text in _texts(record, path) if text]
            if texts or all(path in record for path in paths):
                yield n, role, "\n".join(texts)
                n += 1
        return
    messages = record.get(layout.each) if layout.each else [record]
    for n, message in enumerate(messages if isinstance(messages, list) else []):
        turn, whole = _message(layout, others, message)
        if turn:
            yield n, *turn
        if not whole:
            yield None, None, None


_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("turn", pa.int64()),
                    ("role", pa.string()), ("text", pa.string()),
                    ("layout", pa.string()), ("fingerprint", pa.string())])
TURN_COLUMNS = ("conv_id long, position long, turn long, role string, text string, "
                "layout string, fingerprint string")


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Turns of records (``conv_id`` long, ``position`` long, ``record`` JSON text).

    ``position`` orders the records of one conversation (message rows); ``turn`` numbers the
    turns of one record from 0. A record that is not JSON or fits no layout gives one row
    whose turn, role and layout are NULL, so nothing disappears unseen. A message with
    content that is not mapped in full gives such a row too, beside what is mapped of it; that
    row names the layout. A NULL text is empty.
    """

    def convert(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: dict[str, Layout | None] = {}
        spoken = [x for x in layouts if x.role]

        def rows() -> Iterator[tuple]:
            for batch in stream:
                for conv, position, text in zip(*batch.columns):
                    at = (conv.as_py(), position.as_py())
                    try:
                        record = json.loads(text.as_py() or "")
                    except ValueError:
                        record = None
                    paths = field_paths(record)
                    mark = fingerprint(paths)
                    if mark not in chosen:
                        chosen[mark] = next((x for x in layouts if paths.issuperset(x.needs)), None)
                    layout, n = chosen[mark], 0
                    if layout is not None:
                        for n, turn in enumerate(_apply(layout, spoken, record), 1):
                            yield (*at, *turn, layout.name, mark)
                    if not n:
                        yield (*at, None, None, None, layout and layout.name, mark)

        yield from batches(rows(), _TURNS)

    return (records.select(F.col("conv_id").cast("long"), F.col("position").cast("long"),
                           F.col("record").cast("string"))
            .mapInArrow(convert, TURN_COLUMNS))


def _escaped(text: Column, *markers: str) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for marker in markers:
        text = F.replace(text, F.lit(marker), F.lit("\\" + marker))
    return text


def format_turns(turns: DataFrame) -> DataFrame:
    """``piece``: each turn in the template; a conversation is its pieces in order.

    ``loss_start`` and ``loss_length`` give the learned span inside the piece (assistant
    texts, still escaped), NULL for other roles.
    """
    said = turns.filter(F.col("turn").isNotNull())
    role = _escaped(F.coalesce("role", F.lit("")), "###", "</turn>", ":")
    head = F.concat(F.lit(OPEN), role, F.lit(": "))
    body = _escaped(F.coalesce("text", F.lit("")), "###", "</turn>")
    learned = F.col("role") == LEARNED_ROLE
    return said.select(
        "conv_id", "position", "turn", F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.when(learned, F.length(head)).alias("loss_start"),
        F.when(learned, F.length(body)).alias("loss_length"))


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>\n))*+)</turn>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def parse_formatted(text: str) -> tuple[list[tuple[str, str]], str]:
    """Complete turns at the start of a formatted text, and what follows them."""
    turns, at = [], 0
    while found := _TURN.match(text, at):
        turns.append(tuple(_ESCAPE.sub(r"\1", part) for part in found.groups()))
        at = found.end()
    return turns, text[at:]


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                      ("formatted_chars", pa.int64())])


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what parsing its formatted text recovers, as digests.

    The pieces of a conversation are streamed in order through the parser, so a very long
    conversation needs no more memory than its longest turn. Ties in ``position`` and
    ``turn`` are ordered by piece.
    """

    def digest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            current: list | None = None
            for batch in stream:
                for conv, piece in zip(batch.column(0), batch.column(1)):
                    conv, piece = conv.as_py(), piece.as_py()
                    if current is None or current[0] != conv:
                        if current is not None:
                            yield _closed(current)
                        current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, ""]
                    current[5] += len(piece)
                    turns, current[6] = parse_formatted(current[6] + piece)
                    for role, text in turns:
                        current[1] += 1
                        current[2].update(f"{role}\n{text}\n".encode())
                        if role == LEARNED_ROLE:
                            current[3] += len(text)
                            current[4].update(text.encode())
            if current is not None:
                yield _closed(current)

        yield from batches(rows(), _DIGESTS)

    return (formatted.repartition("conv_id")
            .sortWithinPartitions("conv_id", "position", "turn", "piece")
            .select("conv_id", "piece")
            .mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, "
                                "loss_chars long, loss_sha256 string, formatted_chars long"))


def _closed(state: list) -> tuple:
    conv, n, turns, chars, loss, length, rest = state
    if rest:
        raise ValueError(f"conversation {conv} does not end with a complete turn")
    return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length


def message_rows(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as records for ``canonical_turns``."""
    record = F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                      clean_text("text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("position"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Formatted pieces of a table of message rows; NULL roles and texts are empty."""
    return format_turns(canonical_turns(message_rows(conversations)))
