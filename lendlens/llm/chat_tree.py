"""Chat formatting as a prefix tree: conversations that begin alike share their first turns.

A node is a turn with all turns before it; its key is a running SHA-256. Each node is emitted once.
Nodes are laid out depth-first: a node belongs to the smallest conversation through it, so a
conversation's own nodes are one segment hanging off an earlier one, and sorting segments by their
path of (attach depth, owner) gives the order. A node carries its position id (code points before
it on its path), its place in the stream, the loss mask of assistant text, and its segment carries
the ancestor intervals to which attention is allowed.

Template of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside role and text, every ``<`` +
backslashes + ``|`` gets one more backslash, and in roles backslash and line feed are escaped, so
no text can form a control string and the turn can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of, stored

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
NULL_CONVERSATION = -(2**63)
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURNS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int32()),
        ("key", pa.binary()),
        ("parent", pa.binary()),
        ("position", pa.int64()),
        ("piece", pa.string()),
        ("mask_start", pa.int32()),
        ("mask_end", pa.int32()),
    ]
)
_TURNS_DDL = (
    "conv_id long, depth int, key binary, parent binary, position long, piece string, "
    "mask_start int, mask_end int"
)
_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn and the range of its text within it."""
    role = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
    head = f"{START}{role}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse_turn(piece: str) -> tuple[str, str]:
    role, _, rest = piece[len(START) :].partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)
    return role, unescape(rest[: -len(END) - 1])


def _chain(batches):
    """Rows sorted by conversation and turn: a running hash names each prefix."""
    conversation, first = None, True
    for batch in batches:
        out = [[] for _ in _TURNS]
        for conv, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if first or conv != conversation:
                conversation, first = conv, False
                depth, position, digest, parent = 0, 0, hashlib.sha256(), None
            piece, start, end = format_turn(role or "", text or "")
            data = piece.encode()
            digest.update(len(data).to_bytes(8, "little") + data)
            key = digest.digest()
            masked = role == LOSS_ROLE
            row = (conv, depth, key, parent, position, piece, start if masked else None, end if masked else None)
            for values, value in zip(out, row):
                values.append(value)
            depth, position, parent = depth + 1, position + len(piece), key
        yield batch_of(_TURNS, out)


def _chained(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_chain, _TURNS_DDL)


def _paths(segments: DataFrame) -> DataFrame:
    """``owner, path`` by pointer doubling; a path lists (-attach depth, owner) from the root."""
    step = F.struct((-F.col("attach")).alias("back"), F.col("owner").alias("owner"))
    paths = stored(
        segments.select("owner", F.col("above").alias("top"), F.array(step).alias("path")), "paths"
    )
    while not paths.filter(F.col("top").isNotNull()).isEmpty():
        above = paths.select(
            F.col("owner").alias("top"), F.col("top").alias("next"), F.col("path").alias("before")
        )
        open_paths = paths.filter(F.col("top").isNotNull()).join(above, "top")
        paths = stored(
            paths.filter(F.col("top").isNull()).unionByName(
                open_paths.select("owner", F.col("next").alias("top"), F.concat("before", "path").alias("path"))
            ),
            "paths",
        )
    return paths.select("owner", "path")


def _running(batches):
    total, part = 0, TaskContext.get().partitionId()
    schema = pa.schema([("owner", pa.int64()), ("part", pa.int32()), ("local", pa.int64()), ("length", pa.int64())])
    for batch in batches:
        owners, lengths = (column.to_pylist() for column in batch.columns)
        local = []
        for length in lengths:
            local.append(total)
            total += length
        yield batch_of(schema, [owners, [part] * len(owners), local, lengths])


def _starts(segments: DataFrame, paths: DataFrame) -> DataFrame:
    """``owner, start``: running lengths in path order, by range partitions and their totals."""
    ordered = (
        segments.select("owner", "length")
        .join(paths, "owner")
        .repartitionByRange("path")
        .sortWithinPartitions("path")
        .select("owner", "length")
    )
    placed = stored(
        ordered.mapInArrow(_running, "owner long, part int, local long, length long"), "placed"
    )
    totals = placed.groupBy("part").agg(F.sum("length").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return placed.join(offsets, "part").select("owner", (F.col("offset") + F.col("local")).alias("start"))


def format_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The packed stream: ``nodes``, ``segments`` and ``turns``, all stored.

    ``nodes``: key, segment, depth, start, position, piece, mask_start, mask_end; sorted by start,
    the pieces are the stream. ``segments``: owner, start, length, visible (ancestor intervals of
    the stream). ``turns``: conv_id, depth, key, the way of a conversation through the nodes.

    Turns are ordered by (turn, role, text), NULLs first, and repeated rows are repeated turns.
    NULL role or text is empty. A NULL conv_id is a conversation like others. One conversation is
    streamed by one task in constant memory, since each digest depends on the one before.
    """
    chained = stored(_chained(conversations), "chained")
    owner = F.min(F.coalesce("conv_id", F.lit(NULL_CONVERSATION)))
    nodes = stored(
        chained.groupBy("key").agg(
            owner.alias("owner"),
            *[F.any_value(c).alias(c) for c in ("depth", "parent", "position", "piece", "mask_start", "mask_end")],
        ),
        "nodes",
    )
    heads = nodes.groupBy("owner").agg(
        F.min("depth").alias("attach"),
        F.min(F.struct("depth", "parent"))["parent"].alias("parent"),
        F.min("position").alias("position"),
        F.sum(F.char_length("piece")).alias("length"),
    )
    above = nodes.select(F.col("key").alias("parent"), F.col("owner").alias("above"))
    segments = stored(heads.join(above, "parent", "left"), "segments")
    paths = _paths(segments)
    placed = stored(segments.join(_starts(segments, paths), "owner"), "placed-segments")
    # An ancestor is visible up to the place where the path's next segment hangs off.
    steps = paths.select("owner", F.posexplode("path").alias("step", "at")).select(
        "owner", "step", F.col("at.owner").alias("member")
    )
    member = placed.select(F.col("owner").alias("member"), "start", "position")
    steps = steps.join(member, "member")
    following = Window.partitionBy("owner").orderBy("step")
    ends = F.col("start") + F.lead("position").over(following) - F.col("position")
    spans = steps.select("owner", "step", "start", ends.alias("end")).filter(F.col("end").isNotNull())
    visible = spans.groupBy("owner").agg(
        F.array_sort(F.collect_list(F.struct("step", "start", "end"))).alias("visible")
    )
    none = F.array().cast("array<struct<start:long,end:long>>")
    segments = stored(
        placed.join(visible, "owner", "left").select(
            "owner",
            "start",
            "length",
            "position",
            F.coalesce(
                F.transform("visible", lambda v: F.struct(v["start"].alias("start"), v["end"].alias("end"))),
                none,
            ).alias("visible"),
        ),
        "segments",
    )
    origin = segments.select("owner", F.col("start").alias("_start"), F.col("position").alias("_position"))
    stream = nodes.join(origin, "owner").select(
        "key",
        F.col("owner").alias("segment"),
        "depth",
        (F.col("_start") + F.col("position") - F.col("_position")).alias("start"),
        "position",
        "piece",
        "mask_start",
        "mask_end",
    )
    return stored(stream, "stream"), segments, chained.select("conv_id", "depth", "key")


def _read(batches):
    conversation, state = None, None

    def row():
        turns, n, loss, chars, size = state
        return (conversation, n, turns.hexdigest(), chars, loss.hexdigest(), size)

    for batch in batches:
        done = []
        for conv, piece, start, end in zip(*(column.to_pylist() for column in batch.columns)):
            if state is None or conv != conversation:
                if state is not None:
                    done.append(row())
                conversation, state = conv, [hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            role, text = parse_turn(piece)
            state[0].update(f"{role}\n{text}\n".encode())
            state[1] += 1
            if start is not None:
                target = unescape(piece[start:end])
                state[2].update(target.encode())
                state[3] += len(target)
            state[4] += len(piece)
        if done:
            yield batch_of(_READ, list(zip(*done)))
    if state is not None:
        yield batch_of(_READ, list(zip(*[row()])))


def read_back(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Digests of every conversation, from the emitted pieces and masks alone."""
    pieces = turns.join(nodes.select("key", "piece", "mask_start", "mask_end"), "key")
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    ddl = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    return ordered.select("conv_id", "piece", "mask_start", "mask_end").mapInArrow(_read, ddl)


def chat_digests(conversations: DataFrame) -> DataFrame:
    nodes, _, turns = format_conversations(conversations)
    return read_back(nodes, turns)
