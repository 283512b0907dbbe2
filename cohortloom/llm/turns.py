"""Conversation structure repair by a Viterbi search whose edits leave as soon as all survivors agree on them.

A conversation should read (system)? (user assistant)+, or be empty. The cheapest edits that make it so are found over its
turns in order: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty turn of user or assistant,
anywhere) 2; a turn that is cut off and stays adds 1; blank and repeated turns must go. Of equally cheap edits those whose
initials are least in ASCII win.

After each turn there is one survivor for each of four states (nothing yet, after system, after user, after assistant).
Survivors are the leaves of a tree of back pointers whose nodes count their references: a branch that no survivor needs is
let go, and as long as the root has one branch only, its edits are final, leave and are forgotten. A survivor that cannot win any
more (another one and the dearest way from its state to this one's cost less) is dropped, so that branches meet within a
few turns. Tied edits are compared by their complete unresolved suffixes: survivors keep the rank of their suffix among all
survivors, and no suffix begins another one of the same turn (the letters name the cost), so ranks and new letters decide.

A task reads its conversations turn by turn from Spark's sort, which may spill; it holds the unresolved turns of one
conversation, its counters, and for ``audits`` the hash and letters so far (one byte a turn, as the result has them). Turns
stay unresolved where later ones decide all of them (as in a run of turns of unknown roles, whose whole parity hangs on
its end); no method could emit those earlier. A conversation's hash is of one text in order, so one task makes it.

Nulls and edges: a null role or text counts as one space; a null conversation id is a conversation of its own; turns that
are null come first; turns of equal number are in the order of role and text; repeated rows count as repeated turns; a
role is taken by its first character, and one that is not s, u or a must be changed or go; an empty table gives an empty
result. Input columns of any other name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
NONE, SYSTEM, USER, ASSISTANT = range(4)
COMPLETE = (NONE, ASSISTANT)
NAMES = {"D": "Delete", "I": "Insert", "K": "Keep", "R": "Rerole"}
ROWS = 4096

#: What may be inserted after each state: the states reached, and the roles on the way.
INSERTED = {
    NONE: [(NONE, ()), (USER, ("user",)), (ASSISTANT, ("user", "assistant"))],
    SYSTEM: [(SYSTEM, ()), (USER, ("user",)), (ASSISTANT, ("user", "assistant"))],
    USER: [(USER, ()), (ASSISTANT, ("assistant",))],
    ASSISTANT: [(ASSISTANT, ()), (USER, ("user",))],
}
FOLLOWS = {NONE: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE = {USER: "user", ASSISTANT: "assistant"}

#: (t, s): what it costs at most to go on from t as one could from s; None: just as much, so that a tie is decided by letters.
DETOUR = {
    (NONE, SYSTEM): None,
    (NONE, USER): INSERT,
    (NONE, ASSISTANT): None,
    (SYSTEM, NONE): 2 * INSERT,
    (SYSTEM, USER): INSERT,
    (SYSTEM, ASSISTANT): 2 * INSERT,
    (USER, NONE): INSERT + DELETE,
    (USER, SYSTEM): INSERT,
    (USER, ASSISTANT): INSERT,
    (ASSISTANT, NONE): DELETE,
    (ASSISTANT, SYSTEM): None,
    (ASSISTANT, USER): INSERT,
}


def _moves(initial: str, must_go: bool, cut_off: bool) -> dict[int, list[tuple[int, int, str, tuple]]]:
    """For each state the cheapest (state after the turn, cost, letters, inserted roles), one for each state after it."""
    out = {}
    for state, inserts in INSERTED.items():
        best: dict[int, tuple] = {}
        for at, roles in inserts:
            ways = [(at, DELETE, "D")]
            if not must_go:
                if initial in FOLLOWS[at]:
                    ways.append((FOLLOWS[at][initial], KEEP + CUT_OFF * cut_off, "K"))
                ways += [(to, REROLE + CUT_OFF * cut_off, "R") for to in FOLLOWS[at].values() if to in ROLE]
            for to, cost, letter in ways:
                way = (INSERT * len(roles) + cost, "I" * len(roles) + letter, roles)
                if to not in best or way[:2] < best[to][:2]:
                    best[to] = way
        out[state] = [(to, *way) for to, way in best.items()]
    return out


MOVES = {(i, go, cut): _moves(i, go, cut) for i in "sua?" for go in (False, True) for cut in (False, True)}


class _Node:
    """One turn's edits: letters, the roles inserted before it, the state after it, the turn."""

    __slots__ = ("above", "letters", "roles", "state", "turn", "branches")

    def __init__(self, above: _Node | None, letters: str = "", roles: tuple = (), state: int = NONE, turn: tuple | None = None):
        self.above, self.letters, self.roles, self.state, self.turn = above, letters, roles, state, turn
        self.branches: list[_Node] = []  # the references to it, but for a survivor's own


class Survivors:
    """The search over one conversation; ``take`` and ``end`` yield the edits that are final: (letter, turn, role, text)."""

    def __init__(self):
        self.root = _Node(None)
        self.best: dict[int, tuple[int, int, _Node]] = {NONE: (0, 0, self.root)}  # cost, rank of the letters, leaf
        self.unresolved = 0

    def take(self, turn, role: str, text: str, must_go: bool, cut_off: bool) -> Iterator[tuple]:
        moves = MOVES[role[:1] if role[:1] in ("s", "u", "a") else "?", must_go, cut_off and not must_go]
        found: dict[int, tuple] = {}
        for state, (cost, rank, leaf) in self.best.items():
            for to, more, letters, roles in moves[state]:
                way = (cost + more, rank, letters, roles, leaf)
                if to not in found or way[:3] < found[to][:3]:
                    found[to] = way
        order = sorted(found, key=lambda s: found[s][1:3])
        ranks = {s: i for i, s in enumerate(order)}
        kept = [s for s in found if not any(t != s and self._beats(found[t][0], ranks[t], found[s][0], ranks[s], DETOUR[t, s]) for t in found)]
        before, self.best = self.best, {}
        row = (turn, role, text)
        for s in kept:
            cost, _, letters, roles, above = found[s]
            node = _Node(above, letters, roles, s, row)
            above.branches.append(node)
            self.best[s] = (cost, ranks[s], node)
            self.unresolved += 1
        for _, _, leaf in before.values():
            self._let_go(leaf)
        yield from self._agreed()

    @staticmethod
    def _beats(cost: int, rank: int, other: int, other_rank: int, detour: int | None) -> bool:
        return (cost, rank) < (other, other_rank) if detour is None else other > cost + detour

    def _let_go(self, leaf: _Node) -> None:
        """A leaf without branches goes, and with it the nodes above that only it needed."""
        while not leaf.branches and leaf.above is not None:
            leaf.above.branches.remove(leaf)
            leaf, self.unresolved = leaf.above, self.unresolved - 1

    def _agreed(self) -> Iterator[tuple]:
        leaves = {id(leaf) for _, _, leaf in self.best.values()}
        while len(self.root.branches) == 1 and id(self.root) not in leaves:
            self.root = self.root.branches[0]
            self.root.above = None
            self.unresolved -= 1
            yield from self._edits(self.root)
            self.root.turn = None

    @staticmethod
    def _edits(node: _Node) -> Iterator[tuple]:
        for role in node.roles:
            yield "I", None, role, ""
        turn, role, text = node.turn
        letter = node.letters[-1]
        yield letter, turn, ROLE[node.state] if letter == "R" else role, text

    def end(self) -> tuple[int, list[tuple]]:
        """The least cost, and the edits that were not final yet."""
        ways = []
        for state, (cost, rank, leaf) in self.best.items():
            ways += [(cost + INSERT * len(roles), rank, "I" * len(roles), roles, leaf) for to, roles in INSERTED[state] if to in COMPLETE]
        cost, _, _, roles, leaf = min(ways, key=lambda w: w[:3])
        path = []
        while leaf is not self.root:
            path.append(leaf)
            leaf = leaf.above
        return cost, [e for node in reversed(path) for e in self._edits(node)] + [("I", None, role, "") for role in roles]


def ordered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: Column | None = None) -> DataFrame:
    """conv, turn, role, text, repeated, dropped: each conversation in one partition, in order; one exchange."""
    space = F.lit(" ")
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"),
        (F.lit(False) if dropped is None else dropped).alias("dropped"),
    ).repartition("conv")
    first = F.expr("row_number() OVER (PARTITION BY conv, dropped, role, text ORDER BY turn NULLS FIRST)") > 1
    return rows.withColumn("repeated", first).sortWithinPartitions(F.col("conv"), F.col("turn").asc_nulls_first(), "role", "text", "repeated")


class _Counts:
    """What a conversation's turns have of each fault."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.initial = None

    def add(self, turn, role: str, text: str, repeated: bool) -> tuple[bool, bool]:
        """Counts the turn; whether it must go, whether it is cut off."""
        if turn is not None and turn != self.last:
            self.first, self.last, self.distinct = turn if self.first is None else self.first, turn, self.distinct + 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        body = text.rstrip(BLANKS)
        if not body:
            self.blank += 1
        elif repeated:
            self.duplicate += 1
        elif body[-1] not in ENDS:
            self.truncated += 1
            return False, True
        return not body or repeated, False

    def gaps(self) -> int:
        return 0 if self.first is None else int(self.last - self.first) + 1 - self.distinct


def _conversations(batches: Iterator[pa.RecordBatch], start: Callable, edit: Callable, close: Callable, enough: Callable) -> Iterator:
    """Walk over sorted turns; ``edit`` gets each final edit, ``close`` each conversation's end, ``enough`` gives batches."""
    held: tuple | None = None  # (conv,) of the open conversation

    def over():
        cost, rest = search.end()
        for e in rest:
            edit(*e)
        close(counts, cost)

    for b in batches:
        for conv, turn, role, text, dropped, repeated in zip(*(b.column(i).to_pylist() for i in range(6))):
            if held is None or held[0] != conv:
                if held is not None:
                    over()
                held, search, counts = (conv,), Survivors(), _Counts()
                start(conv)
            if not dropped:
                for e in search.take(turn, role, text, *counts.add(turn, role, text, repeated)):
                    edit(*e)
            yield from enough(ROWS)
    if held is not None:
        over()
    yield from enough(1)


def _sorted_columns(rows: DataFrame) -> DataFrame:
    return rows.select("conv", "turn", "role", "text", "dropped", "repeated")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every edit in order: the conversation's id, ``step`` (from 0), ``edit``, and turn, role and text after it.

    The repaired conversation is what is not deleted; an inserted turn has no number.
    """
    rows = _sorted_columns(ordered_turns(df, conv, turn, role, text))
    schema = T.StructType(
        [
            T.StructField(conv, rows.schema["conv"].dataType),
            T.StructField("step", T.LongType()),
            T.StructField("edit", T.StringType()),
            T.StructField(turn, rows.schema["turn"].dataType),
            T.StructField(role, T.StringType()),
            T.StructField(text, T.StringType()),
        ]
    )
    names = schema.names

    def run(batches):
        out: list[tuple] = []
        kinds: list[pa.DataType] = []
        now: list = [None, 0]

        def typed():
            for b in batches:
                kinds[:] = [b.schema.field(0).type, pa.int64(), pa.string(), b.schema.field(1).type, pa.string(), pa.string()]
                yield b

        def start(c):
            now[:] = [c, 0]

        def edit(letter, t, r, x):
            out.append((now[0], now[1], NAMES[letter], t, r, x))
            now[1] += 1

        def enough(least):
            if len(out) >= least:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out.clear()

        yield from _conversations(typed(), start, edit, lambda *_: None, enough)

    return map_arrow(rows, run, schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: Column | None = None) -> DataFrame:
    """One row for each conversation: faults, least cost, initials of its edits and SHA-256 of what they leave.

    Rows for which ``dropped`` holds are not part of their conversation, but one of which all rows are gone still gets its row.
    """
    rows = _sorted_columns(ordered_turns(df, conv, turn, role, text, dropped))
    schema = T.StructType(
        [T.StructField(conv, rows.schema["conv"].dataType)]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
        + [T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")]
    )
    names = schema.names

    def run(batches):
        out: list[tuple] = []
        kind: list[pa.DataType] = []
        now: dict = {}

        def typed():
            for b in batches:
                kind[:] = [b.schema.field(0).type]
                yield b

        def start(c):
            now.update(conv=c, hash=hashlib.sha256(), letters=bytearray(), between=b"")

        def edit(letter, _, r, x):
            now["letters"] += letter.encode()
            if letter != "D":
                now["hash"].update(now["between"] + f"{r}:{x}".encode("utf-8", "surrogatepass"))
                now["between"] = b"\n"

        def close(c, cost):
            out.append((now["conv"], c.gaps(), c.blank, c.duplicate, c.truncated, c.illegal, cost, now["letters"].decode(), now["hash"].hexdigest()))

        def enough(least):
            if len(out) >= least:
                types = [*kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)], names=names)
                out.clear()

        yield from _conversations(typed(), start, edit, close, enough)

    return map_arrow(rows, run, schema)


def damage(df: DataFrame) -> tuple[DataFrame, Column]:
    """Conversation rows with the query's faults put in, and which rows are lost altogether."""
    space = F.lit(" ")
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = df.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("fault"))
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") <= 1, "").when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.col("fault"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return changed, F.col("fault") == 0


def op12_turn_repair(spark, sf_dir: str) -> DataFrame:
    """One row for each conversation of the table, after its rows were damaged by their checksum."""
    rows, lost = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return audits(rows, dropped=lost)
