"""Conversation structure repair: the cheapest edits that give a well-formed sequence of roles.

A dynamic program walks the rows of a conversation with the state of the role sequence (nothing yet,
after the system row, after a user row, after an assistant row). A state keeps its least cost, and its
edits as a node of a tree that shares prefixes. Equal costs go to the edit letters that are least in ASCII
order: nodes have binary-lifting ancestors and a rolling hash of their prefix, so the longest
common prefix is searched in logarithmic steps; equality of hashes is then verified letter by letter.
Once all states share a prefix it is settled and its nodes go, so memory follows the open part only.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import batch_of

# Faults, costs, spaces and legal pairs of role initials.
SPACES = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
USER, ASSISTANT = "user", "assistant"
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: (from, to) of a row with that initial
STEPS = {
    "s": ((START, AFTER_SYSTEM),),
    "u": ((START, AFTER_USER), (AFTER_SYSTEM, AFTER_USER), (AFTER_ASSISTANT, AFTER_USER)),
    "a": ((AFTER_USER, AFTER_ASSISTANT),),
}
COMPACT_NODES = 4096
PRIME = 2**61 - 1
BASE = 1_000_003
_AUDITS = pa.schema(
    [
        ("conv_id", pa.int64()),
        *[(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
_AUDITS_DDL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_TURNS = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_TURNS_DDL = "conv_id long, at long, edit string, role string, text string"


class Edits:
    """Strings of edit letters as nodes; node 0 is the settled prefix, which all share."""

    def __init__(self, settled: list[str]):
        self.settled = settled
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[0]]

    def __len__(self) -> int:
        return len(self.letter)

    def add(self, parent: int, letter: str) -> int:
        node, jumps = len(self.letter), [parent]
        for level in range(self.depth[parent].bit_length()):
            jumps.append(self.ancestor(jumps[-1], level))
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(letter)) % PRIME)
        self.up.append(jumps)
        return node

    def ancestor(self, node: int, level: int) -> int:
        """2**level steps up; the root is above itself."""
        jumps = self.up[node]
        return jumps[level] if level < len(jumps) else 0

    def at_depth(self, node: int, depth: int) -> int:
        rest = self.depth[node] - depth
        for level in range(rest.bit_length()):
            if rest >> level & 1:
                node = self.ancestor(node, level)
        return node

    def less(self, one: int, other: int) -> bool:
        """Whether the letters of ``one`` come first; a proper prefix comes before the longer."""
        depth = min(self.depth[one], self.depth[other])
        a, b = self.at_depth(one, depth), self.at_depth(other, depth)
        if self.hash[a] == self.hash[b]:
            if self._same(a, b):
                return self.depth[one] < self.depth[other]
            return self._less_by_letters(a, b)
        for level in range(depth.bit_length(), -1, -1):
            over_a, over_b = self.ancestor(a, level), self.ancestor(b, level)
            if self.hash[over_a] != self.hash[over_b]:
                a, b = over_a, over_b
        if not self._same(self.up[a][0], self.up[b][0]):
            return self._less_by_letters(a, b)
        return self.letter[a] < self.letter[b]

    def _same(self, a: int, b: int) -> bool:
        """Letter by letter, up to the node that both share."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def _less_by_letters(self, a: int, b: int) -> bool:
        """For hashes that collide; both are equally deep."""
        least = False
        while a != b:
            if self.letter[a] != self.letter[b]:
                least = self.letter[a] < self.letter[b]
            a, b = self.up[a][0], self.up[b][0]
        return least

    def path(self, node: int, above: int = 0) -> list[str]:
        letters = []
        while node != above:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return letters[::-1]

    def shared(self, nodes: list[int]) -> int:
        """The deepest common ancestor."""
        depth = min(self.depth[node] for node in nodes)
        nodes = [self.at_depth(node, depth) for node in nodes]
        for level in range(depth.bit_length(), -1, -1):
            over = [self.ancestor(node, level) for node in nodes]
            if len(set(over)) > 1:
                nodes = over
        return nodes[0] if len(set(nodes)) == 1 else self.up[nodes[0]][0]

    def compact(self, nodes: list[int]) -> tuple[Edits, list[int]]:
        """Only what leads to ``nodes``, below their settled common prefix."""
        root = self.shared(nodes)
        left = Edits([*self.settled, "".join(self.path(root))])
        new = {root: 0}
        for node in nodes:
            chain = []
            while node not in new:
                chain.append(node)
                node = self.up[node][0]
            for old in reversed(chain):
                new[old] = left.add(new[self.up[old][0]], self.letter[old])
        return left, [new[node] for node in nodes]

    def text(self, node: int) -> str:
        return "".join([*self.settled, *self.path(node)])


class Repair:
    """The program over one conversation; a cell is (cost, node, digest of the repaired rows, any row)."""

    def __init__(self):
        self.edits = Edits([])
        self.cells = [(0, 0, hashlib.sha256(), False), None, None, None]

    def _offer(self, cells: list, state: int, origin: tuple, letter: str, cost: int, line: bytes | None) -> None:
        """Take the edit if it is cheaper than the state's, or as cheap and first in order."""
        cost += origin[0]
        held = cells[state]
        if held and held[0] < cost:
            return
        node = self.edits.add(origin[1], letter)
        if held and held[0] == cost and not self.edits.less(node, held[1]):
            return
        cells[state] = (cost, node, origin, line)

    @staticmethod
    def _written(cell: tuple | None) -> tuple | None:
        """The cell with the digest of its rows; only edits that were taken get that far."""
        if not cell or not isinstance(cell[2], tuple):
            return cell
        cost, node, (_, _, digest, any_row), line = cell
        if line is not None:
            digest = digest.copy()
            digest.update(b"\n" + line if any_row else line)
            any_row = True
        return cost, node, digest, any_row

    def _insert(self) -> None:
        """Rows put in before the next one; two in a row at most can be the cheapest."""
        for _ in range(2):
            for role in (USER, ASSISTANT):
                for start, end in STEPS[role[0]]:
                    if self.cells[start]:
                        self._offer(self.cells, end, self.cells[start], "I", INSERT, f"{role}:".encode())
                        self.cells[end] = self._written(self.cells[end])

    def row(self, role: str, text: str, bad: bool, truncated: bool) -> None:
        """``bad`` rows must go."""
        self._insert()
        cells: list = [None] * 4
        more = TRUNCATED if truncated else 0
        for state, cell in enumerate(self.cells):
            if cell:
                self._offer(cells, state, cell, "D", DELETE, None)
        if not bad:
            for edit, cost, said in (("K", KEEP, role), ("R", REROLE, USER), ("R", REROLE, ASSISTANT)):
                for start, end in STEPS.get(said[:1], ()):
                    if self.cells[start]:
                        self._offer(cells, end, self.cells[start], edit, cost + more, f"{said}:{text}".encode())
        self.cells = [self._written(cell) for cell in cells]
        if len(self.edits) > COMPACT_NODES:
            live = [cell for cell in self.cells if cell]
            self.edits, nodes = self.edits.compact([cell[1] for cell in live])
            moved = iter(nodes)
            self.cells = [cell and (cell[0], next(moved), *cell[2:]) for cell in self.cells]

    def result(self) -> tuple[int, str, str]:
        self._insert()
        nothing, whole = self.cells[START], self.cells[AFTER_ASSISTANT]
        best = nothing
        if whole and (whole[0], self.edits.less(nothing[1], whole[1])) < (nothing[0], True):
            best = whole
        return best[0], self.edits.text(best[1]), best[2].hexdigest()


def _audit(batches):
    for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
        repair, counts = Repair(), dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        first = last = before = None
        n_turns = 0
        for _, turn, role, text, seen, dropped in rows:
            if dropped:
                continue
            if turn is not None:
                n_turns += turn != last
                first, last = turn if first is None else first, turn
            if before:
                counts["illegal"] += before[1][:1] + role[:1] not in LEGAL
            said = text.strip(SPACES)
            fault = None
            if not said:
                fault = "blank"
            elif seen or before == (turn, role, text):
                fault = "duplicate"
            elif said[-1] not in SENTENCE_ENDS:
                fault = "truncated"
            if fault:
                counts[fault] += 1
            repair.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")
            before = (turn, role, text)
        gaps = last - first + 1 - n_turns if first is not None else 0
        yield batch_of(_AUDITS, [[value] for value in (conv_id, gaps, *counts.values(), *repair.result())])


def _rows(batches):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def damage(rows: DataFrame) -> DataFrame:
    """Faults by the crc32 of ``conv_id:turn``; NULL text, role and parts of that key are one space.

    0 of 20 drops the row (it stays with ``dropped`` set, so that its conversation is known), 1 empties
    the text, 2 removes sentence ends, 3 repeats the row, 4 makes it a user's.
    """
    space = F.lit(" ")
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    parts = [F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, USER).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _streamed(rows: DataFrame) -> DataFrame:
    """The rows of a conversation in order, in one partition; equal turns by role, then text."""
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def audit(rows: DataFrame) -> DataFrame:
    """A row per ``conv_id`` of ``rows`` (those of ``damage``): faults, least cost and its edits.

    ``audit`` has an initial per edit: Keep, Rerole, Delete, Insert. NULL turns come first; rows of one
    turn go by role, then text. A NULL ``conv_id`` is an id like others; a conversation without
    rows left has zeros, an empty audit and the digest of an empty text. Texts are read whole. An empty
    table gives no row; other columns are not read.

    Whether a role and text were seen earlier is found by grouping, which splits a long
    conversation. The edits and the digest of one conversation depend on each other in order, so its
    rows stream through one task, which holds the open edits only.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "dropped", F.sha2("text", 256).alias("said"))
    key = ["conv_id", "role", "said"]
    firsts = rows.filter(~F.col("dropped")).groupBy(*key).agg(
        F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("first")
    )
    firsts = firsts.select(*[F.col(name).alias(f"first_{name}") for name in key], "untimed", "first")
    same = [rows[name].eqNullSafe(firsts[f"first_{name}"]) for name in key]
    earlier = F.col("turn").isNotNull() & (F.col("untimed") | (F.col("turn") > F.col("first")))
    marked = rows.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text", F.coalesce(earlier, F.lit(False)).alias("seen"), "dropped"
    )
    return _streamed(marked).mapInArrow(_audit, _AUDITS_DDL)


def _apply(batches):
    for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
        edits, used, at, last = "", 0, 0, ""

        def inserted():
            nonlocal used, at, last
            while used < len(edits) and edits[used] == "I":
                last = ASSISTANT if last[:1] == "u" else USER
                yield batch_of(_TURNS, [[conv_id], [at], ["I"], [last], [""]])
                used, at = used + 1, at + 1

        for _, _, role, text, letters in rows:
            if letters is not None:
                edits = letters
                continue
            yield from inserted()
            edit = edits[used]
            used += 1
            if edit != "D":
                last = role if edit == "K" else ASSISTANT if last[:1] == "u" else USER
                yield batch_of(_TURNS, [[conv_id], [at], [edit], [last], [text]])
                at += 1
        yield from inserted()


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, at, edit, role, text``: the rows of ``damage`` after the edits of ``audit``."""
    left = rows.filter(~F.col("dropped")).select(
        "conv_id", "turn", "role", "text", F.lit(None).cast("string").alias("edits")
    )
    none = F.lit(None).cast("string")
    heads = audits.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("text"), F.col("audit").alias("edits")
    )
    # A head sorts before the rows of its conversation: its turn and role are NULL.
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.asc_nulls_first("role"), "text"]
    together = left.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)
    return together.mapInArrow(_apply, _TURNS_DDL)
