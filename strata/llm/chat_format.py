"""Chat formatting over a prefix tree of conversations.

A turn is formatted as a marker, its role, its text with control strings
escaped, and an end marker; what a turn becomes depends on the turns before it
only. Conversations that share initial turns share nodes of a tree. Nodes are
emitted once, depth first, with

* ``start`` and ``stop``: where the node's text stands in the emitted stream,
* ``position``: the position id of its first character, which is the length of
  the conversation before it, and
* ``intervals``: the parts of the stream, all before the node, that its
  characters may attend to: its ancestors, neighbouring ones merged.

Sorting conversations by their path of node hashes is a depth-first order, so
the tree is never gathered: paths are range-partitioned (no two conversations
have the same path, a common first turn spreads over many partitions) and each
task emits what differs from the conversation before. A tree that spans several
partitions is a stream of its own in each, with the shared turns at its front.
Positions and intervals count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship, stored

# The template.
BEGIN, START, END = "<s>", "<|im_start|>", "<|im_end|>\n"
CONTROL = ["<s>", "</s>", "<|im_start|>", "<|im_end|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(map(re.escape, [*CONTROL, "\\"])))
_ESCAPED = re.compile(r"\\([\\lbn])")
_CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_PLAIN = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END), re.DOTALL)

SEGMENT = (
    "pack bigint, seq bigint, depth int, start bigint, stop bigint, position bigint, "
    "intervals array<struct<start:bigint,stop:bigint>>, text string, loss_start bigint, loss_stop bigint, leaf binary"
)
READ = "leaf binary, formatted string, turns array<struct<role:string,text:string>>, loss array<struct<start:bigint,stop:bigint>>, loss_texts array<string>"


def escape(text: str) -> str:
    """``text`` without control strings: their first character and each backslash become two characters."""
    return _CONTROL.sub(lambda m: _CODES[m.group()[0]] + m.group()[1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m.group(1)], text)


def format_turn(role: str, text: str, first: bool) -> tuple[str, int, int]:
    """A turn's formatted text, and where its (escaped) text begins and ends in it."""
    head = f"{BEGIN if first else ''}{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    body = formatted.removeprefix(BEGIN)
    turns, at = [], 0
    for m in _TURN.finditer(body):
        if m.start() != at:
            break
        turns.append((unescape(m.group(1)), unescape(m.group(2))))
        at = m.end()
    if at != len(body):
        raise ValueError("not a formatted conversation")
    return turns


def conversations(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """(conv_id, leaf, path, turns): a row for each conversation.

    ``path`` holds a 16-byte hash for each turn, of that turn and all before it;
    ``leaf`` is the last. A conversation is the unit of work, as a text is.
    """
    one = F.struct(rows[turn_column].alias("turn"), F.coalesce(rows[role_column], F.lit("")).alias("role"), F.coalesce(rows[text_column], F.lit("")).alias("text"))
    alone = F.when(rows[id_column].isNull(), F.monotonically_increasing_id())  # nothing says that such rows belong together
    whole = rows.select(rows[id_column].alias("conv_id"), alone.alias("own"), one.alias("t")).groupBy("conv_id", "own").agg(F.sort_array(F.collect_list("t")).alias("t"))
    whole = whole.select("conv_id", F.transform("t", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = []
            for turns in b.column("turns"):
                node, path = b"", []
                for t in turns.as_py():
                    role, text = t["role"].encode(), t["text"].encode()
                    node = hashlib.blake2b(node + len(role).to_bytes(8, "little") + role + text, digest_size=16).digest()
                    path.append(node)
                paths.append(b"".join(path))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(paths, pa.binary()), pa.array([p[-16:] for p in paths], pa.binary())], names=["conv_id", "turns", "path", "leaf"])

    kind = whole.schema["conv_id"].dataType.simpleString()
    return whole.mapInArrow(run, f"conv_id {kind}, turns array<struct<role:string,text:string>>, path binary, leaf binary")


def segments(convs: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """The emitted streams (``SEGMENT``) of distinct conversations; ``leaf`` where one ends.

    The loss mask covers the texts of ``loss_role``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SEGMENT.replace("array<struct<start:bigint,stop:bigint>>", "x").split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        pack = (TaskContext.get().partitionId() << 32) - 1
        # node, position after it, and the intervals of all turns up to it: what its children attend to
        stack: list[tuple[bytes, int, tuple[tuple[int, int], ...]]] = []
        at = seq = size = 0
        rows: list[tuple] = []
        for b in batches:
            for path, turns in zip(b.column("path"), b.column("turns")):
                path, turns = path.as_py(), turns.as_py()
                nodes = [path[i : i + 16] for i in range(0, len(path), 16)]
                same = 0
                while same < min(len(stack), len(nodes)) and stack[same][0] == nodes[same]:
                    same += 1
                del stack[same:]
                if not same:
                    pack, at, seq = pack + 1, 0, 0
                for d in range(same, len(nodes)):
                    role, text = turns[d]["role"], turns[d]["text"]
                    out, x, y = format_turn(role, text, d == 0)
                    _, position, seen = stack[-1] if stack else (None, 0, ())
                    intervals = [{"start": x0, "stop": x1} for x0, x1 in seen]
                    loss = role == loss_role
                    rows.append((pack, seq, d, at, at + len(out), position, intervals, out, x if loss else None, y if loss else None, nodes[d] if d == len(nodes) - 1 else None))
                    stack.append((nodes[d], position + len(out), _with(seen, at, at + len(out))))
                    at, seq, size = at + len(out), seq + 1, size + len(out)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    distinct = convs.select("path", "leaf", "turns").dropDuplicates(["leaf"])
    distinct = distinct.select("path", "turns").repartitionByRange("path").sortWithinPartitions("path")
    return distinct.mapInArrow(run, SEGMENT)


def _with(seen: tuple[tuple[int, int], ...], start: int, stop: int) -> tuple[tuple[int, int], ...]:
    """Intervals with one more behind them; one that touches the last goes on with it."""
    if seen and seen[-1][1] == start:
        return (*seen[:-1], (seen[-1][0], stop))
    return (*seen, (start, stop))


def read_back(stream: DataFrame) -> DataFrame:
    """Conversations (``READ``) of emitted streams, by the attention intervals of their last turns.

    ``loss`` are the masked spans of ``formatted``, ``loss_texts`` the texts
    under them, unescaped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["leaf", "formatted", "turns", "loss", "loss_texts"]
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        types = [pa.binary(), pa.string(), pa.list_(turn), pa.list_(span), pa.list_(pa.string())]
        pack, held = None, []  # segments that may still be attended to: start, stop, text, loss span, intervals up to it
        for b in batches:
            rows, size = [], 0
            for r in b.to_pylist():
                if r["pack"] != pack:
                    pack, held = r["pack"], []
                seen = tuple((i["start"], i["stop"]) for i in r["intervals"])
                # the stream is depth first: what is not attended to now is behind what is
                while held and (not seen or held[-1][1] > seen[-1][1]):
                    held.pop()
                if (held[-1][5] if held else ()) != seen or sum(y - x for x, y in seen) != r["position"]:
                    raise ValueError(f"intervals of segment {r['seq']} of stream {pack} do not cover its position")
                held.append((r["start"], r["stop"], r["text"], r["loss_start"], r["loss_stop"], _with(seen, r["start"], r["stop"])))
                if r["leaf"] is None:
                    continue
                formatted, loss, at = "".join(h[2] for h in held), [], 0
                for start, stop, _, x, y, _ in held:
                    if x is not None:
                        loss.append({"start": at + x, "stop": at + y})
                    at += stop - start
                turns = [{"role": x, "text": y} for x, y in parse(formatted)]
                rows.append((r["leaf"], formatted, turns, loss, [unescape(formatted[s["start"] : s["stop"]]) for s in loss]))
                size += len(formatted)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    ordered = stream.repartition("pack").sortWithinPartitions("pack", "seq")
    return ordered.mapInArrow(run, READ)


def format_conversations(rows: DataFrame, loss_role: str = "assistant", **columns: str) -> tuple[DataFrame, DataFrame]:
    """Streams (``SEGMENT``) and members (conv_id, leaf) of a table of turns; both are written.

    Turns go by ``turn`` (null first), those with one number by role and text.
    Null text and null role are empty. A row with a null id is a conversation of its own.
    Repeated rows are turns of their own. Extra columns are ignored; an empty
    table gives empty results.
    """
    ship(rows.sparkSession)
    convs = stored(conversations(rows, **columns), "conversations")
    return stored(segments(convs, loss_role), "chat-stream"), convs.select("conv_id", "leaf")
