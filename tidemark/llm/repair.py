"""Conversation structure repair: the cheapest edits that make roles alternate, by Viterbi.

Rows are edited so that the roles read system (at most once, first), then user and
assistant in turn. The states are what the kept rows end with; the best edits into each
state hang in a tree of backpointers. A node that no survivor needs is freed by its
count of references, and once all survivors share an ancestor the edits up to it are
final and leave the tree. Equally cheap ways into a state are compared by their whole
unresolved suffixes, so the result is the ASCII-least of the cheapest.

Spark sorts the rows of all conversations by range. A conversation within one partition
is repaired where it lies. One that goes on in other partitions, or is long, is cut into
chunks: each chunk gives the costs from every state to every state, these are combined
in order (first within a partition, then over partitions, of a few numbers each), and
every chunk is then repaired on its own between the states so found.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import BLANKS, attach, salt_of, stored

#: Costs of the edits, and the price of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: What the kept rows end with.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)

#: Rows and characters of a chunk.
CHUNK, CHARS = 4096, 4 << 20

#: Faults of a row.
OK, BLANK, DUPLICATE, CUT = range(4)

#: The role that has to follow a state, and the state it leads to.
_NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}

#: Roles to insert after the last row.
_TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

#: The most that state a (row) may have to pay to go on as well as state b (column): inserted rows, or a
#: system row that b could keep and a deletes. A survivor dearer than that beside another is never on a cheapest path.
_DETOUR = [
    [0, 0, INSERT, 0],
    [max(2 * INSERT, DELETE), 0, INSERT, 2 * INSERT],
    [INSERT + DELETE, INSERT, 0, INSERT],
    [DELETE, 0, INSERT, 0],
]

Move = tuple[int, int, int, str]


def _moves(initial: str, fault: int) -> list[Move]:
    """(from, to, cost, edits) that take one row in; inserting before a deleted row, or twice, never pays."""
    out: list[Move] = []
    for state in STATES:
        out.append((state, state, DELETE, "D"))
        if fault in (BLANK, DUPLICATE):
            continue
        price = TRUNCATED if fault == CUT else 0
        for inserts in (0, 1):
            at = _NEXT[state][1] if inserts else state
            fee, lead = price + inserts * INSERT, "I" * inserts
            role, to = _NEXT[at]
            if initial == role[0]:
                out.append((state, to, fee + KEEP, lead + "K"))
            if initial == "s" and at == START:
                out.append((state, SYSTEM, fee + KEEP, lead + "K"))
            out.append((state, to, fee + REROLE, lead + "R"))
    return out


_MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in (OK, BLANK, DUPLICATE, CUT)}


class _Node:
    """The edits of one row, after those of ``parent``; ``refs`` counts children and survivors."""

    __slots__ = ("parent", "edits", "refs")

    def __init__(self, parent: _Node | None, edits: str):
        self.parent, self.edits, self.refs = parent, edits, 0


class Survivors:
    """The cheapest edits from one state into each state."""

    def __init__(self, entry: int = START):
        root = _Node(None, "")
        root.refs = 1
        self.ends: dict[int, tuple[int, _Node]] = {entry: (0, root)}
        self._depth, self._due = 0, 64

    def _before(self, a: _Node, x: str, b: _Node, y: str) -> bool:
        """Whether the unresolved edits up to ``a`` and then ``x`` are ASCII-less than those of ``b`` and ``y``.

        All survivors are equally many rows deep, so both are walked to where they part.
        """
        while a is not b:
            x, y = a.edits, b.edits
            a, b = a.parent, b.parent
        return x < y

    def step(self, moves: Iterable[Move]) -> None:
        best: dict[int, tuple[int, _Node, str]] = {}
        for state, to, fee, edits in moves:
            if state not in self.ends:
                continue
            cost, node = self.ends[state]
            cost += fee
            other = best.get(to)
            if other is None or cost < other[0] or cost == other[0] and self._before(node, edits, other[1], other[2]):
                best[to] = cost, node, edits
        kept = {to: b for to, b in best.items() if all(b[0] <= c[0] + _DETOUR[s][to] for s, c in best.items())}
        before, self.ends = self.ends, {}
        for to, (cost, parent, edits) in kept.items():
            node = _Node(parent, edits)
            node.refs = 1
            parent.refs += 1
            self.ends[to] = cost, node
        for _, node in before.values():
            _release(node)
        self._depth += 1

    def settled(self, now: bool = False) -> list[str]:
        """The edits, row by row, that all survivors have in common and that were not given before.

        Looks only when the tree is twice as deep as what the last look left, so that looking
        costs a constant for each row.
        """
        if self._depth < self._due and not now:
            return []
        level = [node for _, node in self.ends.values()]
        while any(node is not level[0] for node in level):
            level = [node.parent for node in level]
        out, node = [], level[0]
        while node.parent is not None:
            out.append(node.edits)
            node = node.parent
        shared = level[0]
        shared.parent, shared.edits = None, ""
        self._depth -= len(out)
        self._due = max(64, 2 * self._depth)
        return out[::-1]

    def order(self) -> list[int]:
        """The states in the ASCII order of their edits."""
        states: list[int] = []
        for state, (_, node) in self.ends.items():
            place = next((i for i, s in enumerate(states) if self._before(node, "", self.ends[s][1], "")), len(states))
            states.insert(place, state)
        return states

    def only(self, state: int) -> int:
        """Leaves the survivor of ``state`` alone; its cost."""
        for other, (_, node) in list(self.ends.items()):
            if other != state:
                del self.ends[other]
                _release(node)
        return self.ends[state][0]


def _release(node: _Node | None) -> None:
    """Takes one reference away, and with the last one the node's own on its parent."""
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        node.parent, node = None, node.parent


def last_state(costs: dict[int, int], order: list[int]) -> int:
    """The state to end in, with the rows that must be inserted after it; ties to the first in ``order``."""
    return min(order, key=lambda s: (costs[s] + _TAIL[s] * INSERT, order.index(s)))


class _Chunk:
    """Rows of one conversation in order, with what they add to its counts."""

    def __init__(self):
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults: list[int] = []
        self.again: list[int] = []  # further copies of the row, all to be deleted
        self.counts = [0, 0, 0, 0, 0]  # blank, duplicate, truncated, illegal, different turns
        self.turns: list[int | None] = [None, None]
        self.ends: list[str | None] = [None, None]
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: int, seen: bool) -> None:
        if not copies:
            return
        fault = DUPLICATE if seen and fault != BLANK else fault
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.again.append(copies - 1)
        self.chars += len(text)
        if fault != OK:
            self.counts[fault - 1] += 1
        self.counts[(BLANK if fault == BLANK else DUPLICATE) - 1] += copies - 1
        self.counts[3] += copies - 1  # a role beside itself
        if self.ends[0] is None:
            self.ends[0] = role[:1]
        else:
            self.counts[3] += illegal(self.ends[1], role[:1])
        self.ends[1] = role[:1]
        if turn is not None:
            if self.turns[1] is None:
                self.turns[0] = turn
            self.counts[4] += turn != self.turns[1]
            self.turns[1] = turn

    def walk(self, survivors: Survivors) -> Iterator[str]:
        """Takes all rows in; yields the edits of rows as they are settled."""
        for role, fault, again in zip(self.roles, self.faults, self.again):
            initial = role[:1] if role[:1] in ("s", "u", "a") else ""
            survivors.step(_MOVES[initial, fault])
            if again:
                survivors.step([(s, s, DELETE * again, "D" * again) for s in STATES])
            yield from survivors.settled()

    def transfer(self) -> tuple[list[int], list[int]]:
        """Costs from each state to each state (-1: never needed), and places in the order of edits."""
        costs, places = [-1] * 16, [-1] * 16
        for entry in STATES:
            survivors = Survivors(entry)
            deque(self.walk_unsettled(survivors), maxlen=0)
            for place, state in enumerate(survivors.order()):
                costs[4 * entry + state] = survivors.ends[state][0]
                places[4 * entry + state] = place
        return costs, places

    def walk_unsettled(self, survivors: Survivors) -> Iterator[None]:
        """Takes all rows in where only the survivors matter: they differ below the shared edits alone."""
        for _ in self.walk(survivors):
            yield None

    def repaired(self, entry: int = START, leave: int | None = None, ends: bool = True) -> tuple[int, str, list[str], list[str]]:
        """(cost, audit, roles, texts) from one state to another; ``ends``: nothing follows."""
        survivors = Survivors(entry)
        audit: list[str] = []
        roles: list[str] = []
        texts: list[str] = []
        state, row = entry, 0
        rest = deque()  # rows and copies whose edits are not settled yet, by index
        for i, again in enumerate(self.again):
            rest.append((i, False))
            if again:
                rest.append((i, True))

        def apply(edits: str) -> None:
            nonlocal state
            i, copies = rest.popleft()
            audit.append(edits)
            if copies or edits == "D":
                return
            if edits[0] == "I":
                role, state = _NEXT[state]
                roles.append(role)
                texts.append("")
            if edits[-1] == "K" and self.roles[i][:1] == "s":
                role, state = self.roles[i], SYSTEM
            else:
                role, state = _NEXT[state]
            roles.append(self.roles[i] if edits[-1] == "K" else role)
            texts.append(self.texts[i])

        for edits in self.walk(survivors):
            apply(edits)
        if leave is None:
            leave = last_state({s: c for s, (c, _) in survivors.ends.items()}, survivors.order())
        cost = survivors.only(leave)
        for edits in survivors.settled(now=True):
            apply(edits)
        for _ in range(_TAIL[leave] if ends else 0):
            role, state = _NEXT[state]
            audit.append("I")
            roles.append(role)
            texts.append("")
            cost += INSERT
        return cost, "".join(audit), roles, texts


def illegal(one: str, two: str) -> bool:
    """Whether two neighbours' role initials may not stand side by side."""
    return one + two not in ("su", "ua", "au")


def combined(counts: Iterable[tuple[list[int], list, list]]) -> tuple[int, list[int]]:
    """(gaps, [blank, duplicate, truncated, illegal]) of chunks (counts, turns, ends) in order."""
    total, different = [0, 0, 0, 0], 0
    low = high = last = None
    for own, turns, ends in counts:
        total = [a + b for a, b in zip(total, own[:4])]
        if ends[0] is not None:
            total[3] += last is not None and illegal(last, ends[0])
            last = ends[1]
        if turns[0] is not None:
            different += own[4] - (turns[0] == high)
            low, high = turns[0] if low is None else low, turns[1]
    return (0 if low is None else high - low + 1 - different), total


_DONE = "gaps long, blank long, duplicate long, truncated long, illegal long"
_CHUNK = ("_key string, part int, seq int, counts array<long>, turns array<long>, ends array<string>, cost long, audit string, "
          "roles array<string>, texts array<string>, faults array<int>, again array<long>, costs array<long>, places array<int>")


def _chunks(size: int, chars: int):
    """Sorted rows as chunks: repaired at once where the conversation is whole, else with their transfer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema: pa.Schema | None = None

        def emit(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            if held:
                columns = list(zip(*held))
                ids = pa.array([x.as_py() for x in columns[0]], schema.field("conv").type)
                names = ["conv", *(c.split()[0] for c in _CHUNK.split(", "))]
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(c, t) for c, t in zip(columns[1:], _TYPES))], names)

        def row(conv, key, seq, chunk: _Chunk, whole: bool) -> tuple:
            if whole:
                cost, audit, roles, texts = chunk.repaired()
                return (conv, key, None, seq, chunk.counts, chunk.turns, chunk.ends, cost, audit, roles, texts,
                        None, None, None, None)
            costs, places = chunk.transfer()
            return (conv, key, part, seq, chunk.counts, chunk.turns, chunk.ends, None, None, chunk.roles, chunk.texts,
                    chunk.faults, chunk.again, costs, places)

        held: list[tuple] = []
        weight = number = seq = 0  # of the conversations begun here
        conv = key = chunk = None
        for batch in batches:
            schema = batch.schema
            ids = batch.column("conv")
            for i, (name, *values) in enumerate(zip(*(batch.column(c).to_pylist() for c in (
                    "_key", "turn", "role", "text", "copies", "fault", "seen")))):
                if name != key:
                    if chunk is not None:
                        held.append(row(conv, key, seq, chunk, seq == 0 and number > 1))
                        weight += chunk.chars
                    conv, key, chunk, seq, number = ids[i], name, _Chunk(), 0, number + 1
                elif len(chunk.roles) >= size or chunk.chars >= chars:
                    held.append(row(conv, key, seq, chunk, False))
                    weight += chunk.chars
                    chunk, seq = _Chunk(), seq + 1
                chunk.add(*values)
                if len(held) >= size or weight >= chars:
                    yield from emit(held)
                    held, weight = [], 0
        if chunk is not None:
            held.append(row(conv, key, seq, chunk, False))
            yield from emit(held)

    return run


_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()),
          pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()),
          pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]


def _forward(entry: int, steps: list[tuple[list[int], list[int]]]) -> tuple[dict[int, int], list[int], list[dict[int, int]]]:
    """(costs, order of the states, for each step where a state came from) through transfers in order."""
    costs, order, back = {entry: 0}, [entry], []
    for fees, places in steps:
        best: dict[int, tuple[int, int, int]] = {}
        for rank, state in enumerate(order):
            for to in STATES:
                if fees[4 * state + to] >= 0:
                    way = (costs[state] + fees[4 * state + to], rank, places[4 * state + to])
                    best[to] = min(best.get(to, way), way)
        back.append({to: order[rank] for to, (_, rank, _) in best.items()})
        costs = {to: cost for to, (cost, _, _) in best.items()}
        order = sorted(best, key=lambda to: best[to][1:])
    return costs, order, back


def _composed(table: pa.Table) -> pa.Table:
    """The transfers of the chunks of one conversation in one partition as one transfer."""
    rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
    costs, places = [-1] * 16, [-1] * 16
    for entry in STATES:
        total, order, _ = _forward(entry, [(r["costs"], r["places"]) for r in rows])
        for place, state in enumerate(order):
            costs[4 * entry + state], places[4 * entry + state] = total[state], place
    return pa.table({"_key": pa.array([rows[0]["_key"]], pa.string()), "part": pa.array([rows[0]["part"]], pa.int32()),
                     "costs": pa.array([costs], pa.list_(pa.int64())), "places": pa.array([places], pa.list_(pa.int32()))})


def _between(rows: list[dict], number: str, entry: int, leave: int | None, ends: bool) -> pa.Table:
    """The states before and after each of ``rows``, which are in order."""
    costs, order, back = _forward(entry, [(r["costs"], r["places"]) for r in rows])
    state = last_state(costs, order) if leave is None else leave
    out = []
    for r, came in zip(reversed(rows), reversed(back)):
        out.append((r["_key"], r["part"], r[number], came[state], state, ends and r is rows[-1]))
        state = came[state]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)],
                    ["_key", "part", "seq", "entry", "leave", "last"])


_BETWEEN = "_key string, part int, seq int, entry int, leave int, last boolean"


def _over_parts(table: pa.Table) -> pa.Table:
    return _between(sorted(table.to_pylist(), key=lambda r: r["part"]), "part", START, None, True)


def _within_part(chunks: pa.Table, decided: pa.Table) -> pa.Table:
    at = decided.to_pylist()[0]
    return _between(sorted(chunks.to_pylist(), key=lambda r: r["seq"]), "seq", at["entry"], at["leave"], at["last"])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the states around them, repaired."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            row = one.to_pylist()[0]
            chunk = _Chunk()
            chunk.roles, chunk.texts, chunk.faults, chunk.again = (row[c] for c in ("roles", "texts", "faults", "again"))
            cost, audit, roles, texts = chunk.repaired(row["entry"], row["leave"], row["last"])
            new = {"cost": pa.array([cost], pa.int64()), "audit": pa.array([audit], pa.string()),
                   "roles": pa.array([roles], pa.list_(pa.string())), "texts": pa.array([texts], pa.list_(pa.string()))}
            names = [n for n in one.schema.names if n not in ("faults", "again", "entry", "leave", "last")]
            yield pa.RecordBatch.from_arrays([new.get(n, one.column(n)) for n in names], names)


def prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: Column) -> DataFrame:
    """Equal rows of a conversation as one, with the number of copies, its fault and whether it was seen before."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    there = copies > 0
    same = rows.select(
        F.col(conv_col).alias("conv"), F.when(there, F.col(turn_col).cast("long")).alias("turn"),
        F.when(there, space(role_col)).otherwise("").alias("role"),
        F.when(there, space(text_col)).otherwise("").alias("text"), copies.cast("long").alias("copies"),
    ).groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    own = same.withColumns({
        "_key": F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")),
        "digest": F.unhex(F.sha2("text", 256)), "salt": salt_of("turn")})
    here = F.col("copies") > 0
    first = attach(own, ["_key", "role", "digest"], "salt",
                   {"t": F.min(F.when(here, F.col("turn"))), "z": F.max(here & F.col("turn").isNull())},
                   {"first": F.min("t"), "none": F.max("z")})
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(core == "", BLANK).when(~core.rlike(r"[.!?]\z"), CUT).otherwise(OK)
    seen = F.when(F.col("none"), F.col("turn").isNotNull()).otherwise(F.coalesce(F.col("turn") > F.col("first"), F.lit(False)))
    return first.select("conv", "_key", "turn", "role", "text", "copies", fault.alias("fault"), seen.alias("seen"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", copies: Column | None = None, size: int = CHUNK, chars: int = CHARS) -> DataFrame:
    """Every conversation repaired, in chunks: one row for most, several in order of (part, seq) for long ones.

    Columns: conv, part (NULL: the only chunk), seq, cost, audit (initials of the edits Keep, Rerole, Delete,
    Insert in order), roles and texts of the repaired rows, counts (blank, duplicate, truncated, neighbours that
    may not be, different turns), turns (first, last) and ends (initials of the first and last role) of the chunk
    before its repair. The audit of a conversation is the cheapest, of equally cheap ones the ASCII-least.

    Rows are taken by turn, NULL first, then by role and text. NULL roles and texts read as one space; a NULL
    conversation is a conversation like others. ``copies`` tells how often a row stands (once); a row of 0 copies
    names its conversation only. Very long conversations and texts are whole. An empty table gives no rows.
    """
    first = prepared(rows, conv_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies)
    # The start of a text is enough to deal by: what agrees in it goes to one task, and is sorted by the whole there.
    ranged = first.withColumn("start", F.substring("text", 1, 128)).repartitionByRange("conv", "turn", "role", "start").drop("start")
    kind = first.schema["conv"].dataType.simpleString()
    chunks = stored(ranged.sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(
        _chunks(size, chars), f"conv {kind}, {_CHUNK}"), "chunks")
    open_ = chunks.filter("part IS NOT NULL")
    small = open_.select("_key", "part", "seq", "costs", "places")
    parts = small.groupBy("_key", "part").applyInArrow(
        _composed, "_key string, part int, costs array<long>, places array<int>")
    over = parts.groupBy("_key").applyInArrow(_over_parts, _BETWEEN)
    states = stored(small.groupBy("_key", "part").cogroup(over.drop("seq").groupBy("_key", "part")).applyInArrow(
        _within_part, _BETWEEN), "states")
    kept = ["conv", "_key", "part", "seq", "counts", "turns", "ends", "cost", "audit", "roles", "texts"]
    late = open_.join(states, ["_key", "part", "seq"]).select(*kept, "faults", "again", "entry", "leave", "last").mapInArrow(
        _repaired, ", ".join(f"{c} {chunks.schema[c].dataType.simpleString()}" for c in kept))
    return chunks.filter("part IS NULL").select(kept).unionByName(late)


_REPORT = f"{_DONE}, cost long, audit string, repaired_sha256 string"


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order as one row for each conversation; the digest takes the chunks' lines one after another."""
    names = ["conv", *(c.split()[0] for c in _REPORT.split(", "))]
    key = None

    def finish() -> pa.RecordBatch:
        gaps, total = combined(counts)
        values = [gaps, *total, cost, "".join(audit), digest.hexdigest()]
        return pa.RecordBatch.from_arrays([conv, *(pa.array([v]) for v in values)], names)

    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            row = one.to_pylist()[0]
            if row["_key"] != key:
                if key is not None:
                    yield finish()
                key, conv, digest = row["_key"], one.column("conv"), hashlib.sha256()
                counts, audit, cost, joint = [], [], 0, ""
            counts.append((row["counts"], row["turns"], row["ends"]))
            cost += row["cost"]
            audit.append(row["audit"])
            for role, text in zip(row["roles"], row["texts"]):
                digest.update(f"{joint}{role}:{text}".encode())
                joint = "\n"
    if key is not None:
        yield finish()


def report(chunks: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: counts, cost, audit and the SHA-256 of the repaired rows.

    A conversation of one chunk needs no shuffle. The chunks of a longer one pass one task in order, for a
    SHA-256 cannot be split; it holds one chunk and the audit at a time.
    """
    lines = F.concat_ws("\n", F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)))
    low, high = F.element_at("turns", 1), F.element_at("turns", 2)
    count = lambda i: F.element_at("counts", i)
    gaps = F.coalesce(high - low + 1 - count(5), F.lit(0).cast("long"))
    one = chunks.filter("part IS NULL").select(
        "conv", gaps.alias("gaps"), count(1).alias("blank"), count(2).alias("duplicate"), count(3).alias("truncated"),
        count(4).alias("illegal"), "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    kind = chunks.schema["conv"].dataType.simpleString()
    many = chunks.filter("part IS NOT NULL").repartition("_key").sortWithinPartitions("_key", "part", "seq").mapInArrow(
        _reported, f"conv {kind}, {_REPORT}")
    return one.unionByName(many)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with the faults that the hash of conversation and turn asks for."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(space("role")).alias("role"), text.alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return report(repair(rows, copies=F.col("copies"))).withColumnRenamed("conv", "conv_id")


_SPACE = r"[\x20\x09-\x0D]"

SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      range(1, length(k) + 1), lambda i: [ord(k[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)) % 20 AS f
  FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE f <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_replace(text, '{_SPACE}+$', '') AS core, left(role, 1) AS ini,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS prior
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN core = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
counted AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prior || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM judged GROUP BY conv_id),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 's' AS st, 0::BIGINT AS cost, '' AS audit, '' AS body FROM counted
  UNION ALL
  SELECT conv_id, i, st, e.cost, e.audit, e.body FROM (
    SELECT conv_id, i, st, min({{'cost': cost, 'audit': audit, 'body': body}}) AS e FROM (
      SELECT b.conv_id, j.i, m.dst AS st, b.cost + m.cost + CASE WHEN m.act <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
             b.audit || m.ins || m.act AS audit,
             b.body || CASE WHEN m.ins = '' THEN '' WHEN m.src IN ('s', 'S', 'a') THEN E'user:\n' ELSE E'assistant:\n' END
               || CASE m.act WHEN 'D' THEN '' WHEN 'K' THEN j.role || ':' || j.text || chr(10)
                  ELSE CASE m.dst WHEN 'u' THEN 'user:' ELSE 'assistant:' END || j.text || chr(10) END AS body
      FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i + 1
      JOIN (VALUES
        ('s', '*', '', 'D', 's', 2), ('S', '*', '', 'D', 'S', 2), ('u', '*', '', 'D', 'u', 2), ('a', '*', '', 'D', 'a', 2),
        ('s', 's', '', 'K', 'S', 0), ('s', 'u', '', 'K', 'u', 0), ('S', 'u', '', 'K', 'u', 0), ('u', 'a', '', 'K', 'a', 0), ('a', 'u', '', 'K', 'u', 0),
        ('s', '*', '', 'R', 'u', 1), ('S', '*', '', 'R', 'u', 1), ('u', '*', '', 'R', 'a', 1), ('a', '*', '', 'R', 'u', 1),
        ('s', 'a', 'I', 'K', 'a', 5), ('S', 'a', 'I', 'K', 'a', 5), ('u', 'u', 'I', 'K', 'u', 5), ('a', 'a', 'I', 'K', 'a', 5),
        ('s', '*', 'I', 'R', 'a', 6), ('S', '*', 'I', 'R', 'a', 6), ('u', '*', 'I', 'R', 'u', 6), ('a', '*', 'I', 'R', 'a', 6)
      ) m(src, ini, ins, act, dst, cost) ON m.src = b.st AND (m.ini = '*' OR m.ini = j.ini)
        AND (m.act = 'D' OR j.fault NOT IN ('blank', 'duplicate')))
    GROUP BY conv_id, i, st)),
ended AS (
  SELECT b.conv_id, min({{'cost': b.cost + t.fee, 'audit': b.audit || t.ins, 'body': b.body || t.body}}) AS e
  FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = c.n
  JOIN (VALUES ('s', 0, '', ''), ('a', 0, '', ''), ('u', 5, 'I', E'assistant:\n'), ('S', 10, 'II', E'user:\nassistant:\n')) t(st, fee, ins, body)
    ON t.st = b.st GROUP BY b.conv_id)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.e.cost, 0) AS cost,
       coalesce(e.e.audit, '') AS audit, sha256(regexp_replace(coalesce(e.e.body, ''), '\n$', '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
