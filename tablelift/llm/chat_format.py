"""Chat formatting with schema fingerprints.

Records come in different layouts: one row per turn, nested lists of messages under several names,
instruction and answer fields. The fingerprint of a record is the hash of its sorted nested
field paths (list items are ``[]``; fields that are null don't count); it selects one of the declared
mappings, each of which says where the turns are, which field holds the role and which the text. The
result is always the same: canonical turns (conv_id, turn, role, text). Records of unknown layout
are returned with a null mapping, never dropped. A record whose fingerprint is unknown is tried again
without the fields that no mapping names, then with its null fields counted; extra fields
are left out only where a text of the mapping is there, so that no text is lost with them.

A turn is written as ``### role: text</turn>`` and a line end. Inside roles and texts a backslash
goes before every backslash, ``###`` and ``</turn>`` (in roles also before colons), so that no text
can look like a mark and all texts come back. The loss mask covers the assistant's texts.

Turns are formatted row by row in the JVM. Digests of whole conversations need their turns in order:
they stream through a sort by conversation and turn, and hold one row at a time, however long
the conversation is.

Defined results: a null text or role is empty; turns are ordered by turn (null first), then role and
text, so repeated and tied rows stay and have one order; a null conv_id is one conversation; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import arrow_map

END = "</turn>"
WHOLE = re.compile(r"[+-]?[0-9]{1,19}")
TOKEN = re.compile(r"\\(\\|###|</turn>|:)|(</turn>\n)|(: )")


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are: ``turns`` is the path of a list of messages with ``role`` and
    ``text`` fields, or None for a record that is one turn; ``fixed`` instead lists (role, fields),
    whose texts are joined by an empty line. ``id`` and ``turn`` are top fields."""

    name: str
    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "text"
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    id: str = "conv_id"
    turn: str = "turn"


def fingerprint(paths) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode())


def field_paths(value, at: str = "", nulls: bool = False) -> set[str]:
    """The paths of all fields of a parsed record, those that are null only with ``nulls``."""
    if isinstance(value, dict):
        return set().union(*[field_paths(v, f"{at}.{k}" if at else k, nulls) for k, v in value.items() if nulls or v is not None])
    if isinstance(value, list):
        return set().union(*[field_paths(v, f"{at}[]", nulls) for v in value]) if value else {f"{at}[]"}
    return {at}


def _turn_rows() -> list[Mapping]:
    """One row per turn; any of its fields may be null."""
    fields, out = ("conv_id", "turn", "role", "text"), []
    for k in range(16):
        out.append(Mapping("turn rows", tuple(f for i, f in enumerate(fields) if not k >> i & 1)))
    return out


ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}
MAPPINGS = _turn_rows() + [
    Mapping("messages", ("conv_id", "messages[].content", "messages[].role"), "messages", "role", "content"),
    Mapping("conversations", ("conv_id", "conversations[].from", "conversations[].value"), "conversations", "from", "value"),
    Mapping("nested messages", ("conv_id", "data.messages[].author.role", "data.messages[].content.text"),
            "data.messages", "author.role", "content.text"),
    Mapping("prompt and completion", ("conv_id", "prompt", "completion"),
            fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt and response", ("conv_id", "prompt", "response"),
            fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("instruction", ("conv_id", "instruction", "output"),
            fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction and input", ("conv_id", "instruction", "input", "output"),
            fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("system and instruction", ("conv_id", "system", "instruction", "output"),
            fixed=(("system", ("system",)), ("user", ("instruction",)), ("assistant", ("output",)))),
]
BY_PRINT = {fingerprint(m.paths): m for m in MAPPINGS}


def _parents(path: str) -> set[str]:
    """What holds the field ``path``: ``a[].b`` is below ``a[]`` and ``a``."""
    return {path[:m.start()] for m in re.finditer(r"\.|\[\]", path)} | {path[:m.end()] for m in re.finditer(r"\[\]", path)} - {path}


class Layouts:
    """Fingerprint -> mapping, with the looser tries for records of no known fingerprint."""

    def __init__(self, table: dict[int, Mapping]):
        self.table = table
        self.named = {p for m in table.values() for p in m.paths}
        self.above = set().union(*[_parents(p) for p in self.named])

    def counts(self, path: str) -> bool:
        """Whether a path tells layouts apart: a mapping names it, or it stands where one names another shape."""
        return path in self.named or path in self.above or not self.named.isdisjoint(_parents(path))

    def of(self, record: dict) -> Mapping | None:
        paths = field_paths(record)
        for tried in (paths, field_paths(record, nulls=True)):
            mapping = self.table.get(fingerprint(tried))
            if mapping is not None:
                return mapping
            mapping = self.table.get(fingerprint(filter(self.counts, tried)))
            if mapping is not None and paths & _texts(mapping):
                return mapping
        return None


def _texts(mapping: Mapping) -> set[str]:
    if mapping.fixed:
        return {f for _, names in mapping.fixed for f in names}
    return {mapping.text if mapping.turns is None else f"{mapping.turns}[].{mapping.text}"}


def _text(value) -> str | None:
    if value is None:
        return None
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text if text.isascii() else text.encode("utf-8", "surrogatepass").decode("utf-8", "replace")


def _whole(value) -> int | None:
    """A 64-bit whole number; ValueError for any other value that is not null."""
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float, str)) or (isinstance(value, str) and not WHOLE.fullmatch(value)) \
            or (isinstance(value, float) and not value.is_integer()):
        raise ValueError(f"{value!r} is no whole number")
    number = int(value)
    if not -1 << 63 <= number < 1 << 63:
        raise ValueError(f"{number} has more than 64 bits")
    return number


def _get(value, path: str):
    for k in path.split("."):
        value = value.get(k) if isinstance(value, dict) else None
    return value


def turns_of(record: dict, mapping: Mapping) -> list[tuple]:
    """(conv_id, turn, role, text) of a record; ValueError where an id or a turn is no whole number."""
    conv = _whole(record.get(mapping.id))
    if mapping.fixed:
        return [(conv, i, role, "\n\n".join(_text(record.get(f)) or "" for f in names))
                for i, (role, names) in enumerate(mapping.fixed)]
    if mapping.turns is None:
        return [(conv, _whole(record.get(mapping.turn)), _text(record.get(mapping.role)), _text(record.get(mapping.text)))]
    return [(conv, i, ROLES.get(r := _text(_get(m, mapping.role)), r), _text(_get(m, mapping.text)))
            for i, m in enumerate(_get(record, mapping.turns))]


def canonical_record(raw: str | None, layouts: Layouts) -> list[tuple]:
    """(conv_id, turn, role, text, layout) of a JSON record, as it came and without a layout where none fits."""
    try:
        record = json.loads(raw) if raw is not None else None
        mapping = layouts.of(record) if isinstance(record, dict) else None
        if mapping is not None:
            return [(*t, mapping.name) for t in turns_of(record, mapping)]
    except (ValueError, RecursionError):
        pass  # no JSON, or an id that is no number
    return [(None, None, None, raw, None)]


def canonical_turns(records: DataFrame, column: str, mappings: dict[int, Mapping] | None = None) -> DataFrame:
    """(conv_id, turn, role, text, layout) of the JSON records in ``column``. A record that is no
    object or has no mapping is one row with a null layout and itself as text."""
    layouts = Layouts(BY_PRINT if mappings is None else mappings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [t for raw in batch.column(0).to_pylist() for t in canonical_record(raw, layouts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in
                 enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                ["conv_id", "turn", "role", "text", "layout"])

    return arrow_map(records.select(F.col(column).cast("string")), run, "conv_id long, turn long, role string, text string, layout string")


def escaped(text, marks: str = r"\\|###|</turn>"):
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"({marks})", r"\\$1")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, segment, loss_start, loss_end): every turn's text as it is written, and the
    bounds, in characters of the segment, of what the loss covers (equal: nothing)."""
    role, text = escaped(F.col("role"), r"\\|###|</turn>|:"), escaped(F.col("text"))
    head = F.concat(F.lit("### "), role, F.lit(": "))
    start = F.length(head)
    end = F.when(F.col("role") == "assistant", start + F.length(text)).otherwise(start)
    return turns.select("conv_id", "turn", F.concat(head, text, F.lit(f"{END}\n")).alias("segment"),
                        start.alias("loss_start"), end.alias("loss_end"), "role", "text")


def parse(segment: str) -> tuple[str, str]:
    """The role and the text of a written turn."""
    role, out, at = None, [], 4
    if not segment.startswith("### "):
        raise ValueError("no turn")
    for m in TOKEN.finditer(segment, 4):
        if m[3] and role is not None:
            continue  # only the first unescaped ": " is a mark
        out.append(segment[at:m.start()])
        at = m.end()
        if m[1]:
            out.append(m[1] if m[1] != ":" or role is None else "\\:")
        elif m[3]:
            role, out = "".join(out), []
        else:
            if at != len(segment) or role is None:
                raise ValueError("marks inside a turn")
            return role, "".join(out)
    raise ValueError("a turn without an end")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|###|</turn>)", r"\1", text)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, all read back from the formatted turns: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    ordered = (formatted(turns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "segment", "loss_start", "loss_end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, done = object(), None, []

        def row():
            n, turn, loss, chars, size = state
            return (at, n, turn.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            for conv, seg, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != at:
                    if state is not None:
                        done.append(row())
                    at, state = conv, [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                role, text = parse(seg)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                lost = unescape(seg[a:b])
                state[2].update(lost.encode())
                state[3] += len(lost)
                state[4] += len(seg)
            yield out(done)
            done = []
        if state is not None:
            yield out([row()])

    def out(rows):
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return arrow_map(ordered, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")
