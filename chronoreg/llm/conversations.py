"""Conversation structure repair: the cheapest edits that give a conversation the roles `(system? (user assistant)+)?`.

A conversation's edits are a path through a lattice. Its nodes are (rows consumed, state of the role pattern), its arcs
the edits: Keep, Rerole and Delete consume a row, Insert does not. A bidirectional Dijkstra search finds the cheapest
path: a forward and a reverse heap meet, all crossings of the least cost are finished, and of these the least audit
(the edits' initials in order) is taken. At equal costs a heap hands out nodes in the lattice's own order, so a node's
label is its least audit when it leaves the heap: two audits of equal cost between the same nodes are never a prefix
of one another, so the least parts make the least whole.

On Spark: equal rows of a turn are counted, not copied; what was said before is an aggregate by conversation, role and
a digest of the text. Rows are then range-partitioned by conversation and turn, so that a conversation with a third of
all rows lies in many tasks. A task searches conversations that lie wholly inside it. The others are cut into chunks
of `CHUNK` rows, each with the cheapest edits between any two states of the pattern; a part's chunks are combined two
by two, its conversation's parts (at most one a task) by the same search, and the chosen states go back to the chunks.

Defined results: rows come in the order of turn (nulls first), then role, then the digest of their text; a null role or
text is a space; a role without any character adds nothing to the pattern, and one with another initial must be
reroled or deleted; rows with equal values in all four columns are duplicates; a null conv_id is a conversation like
any other; a conversation all of whose rows have no `copies` has no rows; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.llm import common

#: Rows of a chunk of a conversation that lies in several tasks or is longer than this.
CHUNK = 256
#: Searched lattices that a worker remembers.
KNOWN = 100_000
# The costs of edits, the states of the pattern, what each role's initial does in it, and the white space.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ENDS = (START, ASSISTANT)
FOLLOWS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
SPOKEN = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
LEGAL = ("su", "ua", "au")
WHITE = "\t\n\x0b\x0c\r "

Row = tuple[str, str, int]  # initial; what is wrong: "" nothing, "t" truncated, "x" to be deleted; how many alike
Arc = tuple[int, int, str, int]  # from state, cost, audit, to state
Best = tuple[int, str]  # cost, audit
Node = tuple[int, int]

RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_MESSAGES = "array<struct<role: string, text: string>>"
_COUNTS = "first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, opening string, closing string"
_CHUNKED = f"conv_id long, part int, at int, whole boolean, {_COUNTS}, costs array<long>, audits array<string>, shape array<string>, messages {_MESSAGES}, sha256 string"


def arcs(row: Row) -> list[Arc]:
    """The edits of one row, or of several alike that must go."""
    initial, wrong, copies = row
    if wrong == "x":
        return [(q, DELETE * copies, "D" * copies, q) for q in STATES]
    more = TRUNCATED if wrong == "t" else 0
    kept = {q: q for q in STATES} if initial == "" else FOLLOWS.get(initial, {})
    return [
        *((q, DELETE, "D", q) for q in STATES),
        *((q, more, "K", to) for q, to in kept.items()),
        *((q, REROLE + more, "R", SPOKEN[q][0]) for q in STATES),
    ]


def cheapest(layers: list[list[Arc]], start: int, ends: tuple[int, ...], inserts: bool = True) -> Best | None:
    """The least cost, and of the paths of that cost the least audit, from `start` before the layers to one of `ends`."""
    last = len(layers)
    inner = [(q, INSERT, "I", SPOKEN[q][0]) for q in STATES] if inserts else []

    def onward(node: Node) -> Iterator[tuple[Node, int, str]]:
        at, q = node
        yield from (((at, to), cost, letters) for origin, cost, letters, to in inner if origin == q)
        if at < last:
            yield from (((at + 1, to), cost, letters) for origin, cost, letters, to in layers[at] if origin == q)

    def backward(node: Node) -> Iterator[tuple[Node, int, str]]:
        at, q = node
        yield from (((at, origin), cost, letters) for origin, cost, letters, to in inner if to == q)
        if at:
            yield from (((at - 1, origin), cost, letters) for origin, cost, letters, to in layers[at - 1] if to == q)

    ahead: dict[Node, Best] = {(0, start): (0, "")}
    behind: dict[Node, Best] = {(last, q): (0, "") for q in ends}
    # At equal costs a heap takes nodes in the order in which arcs without a cost lead to them.
    forward = [(0, 0, start)]
    reverse = [(0, -last, q) for q in sorted(ends)]
    done: tuple[set[Node], set[Node]] = (set(), set())
    least: int | None = None

    def step(heap: list, labels: dict[Node, Best], others: dict[Node, Best], settled: set[Node], sign: int) -> None:
        nonlocal least
        cost, at, q = heappop(heap)
        node = (sign * at, q)
        if node in settled:
            return
        settled.add(node)
        audit = labels[node][1]
        for to, more, letters in onward(node) if sign > 0 else backward(node):
            new = (cost + more, audit + letters if sign > 0 else letters + audit)
            old = labels.get(to)
            if old is None or new < old:
                labels[to] = new
                if old is None or new[0] < old[0]:
                    heappush(heap, (new[0], sign * to[0], to[1]))
            if to in others and (least is None or labels[to][0] + others[to][0] < least):
                least = labels[to][0] + others[to][0]

    if (0, start) in behind:
        least = 0
    while forward and reverse and (least is None or forward[0][0] + reverse[0][0] <= least):
        if forward[0][0] <= reverse[0][0]:
            step(forward, ahead, behind, done[0], 1)
        else:
            step(reverse, behind, ahead, done[1], -1)
    # What one heap has left when the other has run dry cannot lead to a further crossing: all its nodes were reached.
    crossings = ((c + behind[n][0], a + behind[n][1]) for n, (c, a) in ahead.items() if n in behind)
    return min(crossings, default=None)


def repaired(shape: list[Row], messages: list[tuple[str, str]], audit: str, state: int) -> list[tuple[str, str]]:
    """The messages (role, text) after the edits; `messages` holds those of the rows that need not go."""
    out, rows, said, letters = [], iter(shape), iter(messages), iter(audit)
    for letter in letters:
        if letter == "I":
            state, role = SPOKEN[state]
            out.append((role, ""))
            continue
        initial, wrong, copies = next(rows)
        if wrong == "x":
            for _ in range(copies - 1):
                next(letters)
            continue
        role, text = next(said)
        if letter == "R":
            state, role = SPOKEN[state]
        elif letter == "K" and initial:
            state = FOLLOWS[initial][state]
        if letter != "D":
            out.append((role, text))
    return out


def joined(messages: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in messages)


_known: dict[tuple, Best | None] = {}


def _search(shape: tuple[Row, ...], start: int, ends: tuple[int, ...]) -> Best | None:
    key = (shape, start, ends)
    if key not in _known:
        if len(_known) >= KNOWN:
            _known.clear()
        _known[key] = cheapest([arcs(r) for r in shape], start, ends)
    return _known[key]


def _table(find: Callable[[int, int], Best | None]) -> tuple[list[int], list[str]]:
    """Cost (-1: no way) and audit between any two states, row by row."""
    found = [find(q, to) for q in STATES for to in STATES]
    return [-1 if f is None else f[0] for f in found], ["" if f is None else f[1] for f in found]


def _table_arcs(costs: list[int], audits: list[str]) -> list[Arc]:
    return [(i // 4, c, a, i % 4) for i, (c, a) in enumerate(zip(costs, audits, strict=True)) if c >= 0]


def marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, text, wrong, copies): distinct rows with their fault and how often they stand there.

    `wrong` is blank, duplicate, truncated or empty; of several alike only the first is not a duplicate. Rows without
    copies remain, with a null role, so that their conversation is known.
    """
    there = F.coalesce("copies", F.lit(0)) > 0
    some = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(there, F.coalesce("text", F.lit(" "))).alias("text"),
        F.when(there, F.col("copies")).otherwise(0).cast("long").alias("copies"),
    ).withColumn("key", F.struct("conv_id", "turn", "role", F.sha2("text", 256).alias("digest")))
    # Nulls are equal inside a struct; rows of one key have one text.
    alike = some.groupBy("key").agg(F.min("text").alias("text"), F.sum("copies").alias("copies"))
    said = alike.where("key.role IS NOT NULL").select("key").groupBy("key.conv_id", "key.role", "key.digest").agg(F.min(F.struct(F.col("key.turn").isNotNull().alias("known"), F.col("key.turn").alias("turn"))).alias("first"))
    first = said.select(F.struct("conv_id", F.col("first.turn").alias("turn"), "role", "digest").alias("key"), F.lit(True).alias("new"))
    body = F.rtrim("text", F.lit(WHITE))
    fault = F.when(F.length(body) == 0, "blank").when(F.col("new").isNull(), "duplicate").when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    return alike.join(first, "key", "left").select("key.*", "text", F.when(F.col("key.role").isNotNull(), fault).alias("wrong"), "copies")


class _Chunk:
    """Consecutive rows of one conversation."""

    def __init__(self):
        self.shape: list[Row] = []
        self.messages: list[tuple[str, str]] = []
        self.turns: list[int] = []  # the first and the last one known
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.opening = self.closing = None

    def add(self, row: dict) -> None:
        role, wrong, copies, turn = row["role"], row["wrong"], row["copies"], row["turn"]
        if role is None:
            return
        initial = role[:1]
        if turn is not None and turn not in self.turns[1:]:
            self.turns = [self.turns[0] if self.turns else turn, turn]
            self.distinct += 1
        if self.closing is not None:
            self.illegal += self.closing + initial not in LEGAL
        self.illegal += (copies - 1) * (initial + initial not in LEGAL)
        self.opening, self.closing = initial if self.opening is None else self.opening, initial
        gone = copies
        if wrong == "blank":
            self.blank += copies
        elif wrong == "duplicate":
            self.duplicate += copies
        else:
            self.truncated += wrong == "truncated"
            self.duplicate += copies - 1
            self.shape.append((initial, "t" if wrong else "", 1))
            self.messages.append((role, row["text"]))
            gone -= 1
        if gone:
            self.shape.append((initial, "x", gone))

    def counts(self) -> dict:
        first, last = self.turns or (None, None)
        return {
            "first_turn": first, "last_turn": last, "turns": self.distinct, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "opening": self.opening, "closing": self.closing,
        }


def _chunked(rows: DataFrame, size: int, digests: bool) -> DataFrame:
    """A row for each conversation that lies wholly inside a task, and for each chunk of the others."""

    def whole(conv: int | None, chunk: _Chunk) -> dict:
        cost, audit = _search(tuple(chunk.shape), START, ENDS)
        after = repaired(chunk.shape, chunk.messages, audit, START)
        return {"conv_id": conv, "whole": True, **chunk.counts(), "costs": [cost], "audits": [audit], "messages": None if digests else after, "sha256": hashlib.sha256(joined(after).encode()).hexdigest()}

    def chunk_of_many(conv: int | None, part: int, at: int, chunk: _Chunk) -> dict:
        shape = tuple(chunk.shape)
        costs, audits = _table(lambda q, to: _search(shape, q, (to,)))
        return {"conv_id": conv, "part": part, "at": at, "whole": False, **chunk.counts(), "costs": costs, "audits": audits, "shape": [f"{c},{w},{i}" for i, w, c in shape], "messages": chunk.messages}

    schema = _arrow_schema(_CHUNKED)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, at, chunk, started, first = None, 0, _Chunk(), False, True
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if started and row["conv_id"] != conv:
                    # The first conversation may have begun in the task before.
                    out.append(chunk_of_many(conv, part, at, chunk) if first or at else whole(conv, chunk))
                    at, chunk, first = 0, _Chunk(), False
                elif len(chunk.shape) >= size:
                    out.append(chunk_of_many(conv, part, at, chunk))
                    at, chunk = at + 1, _Chunk()
                conv, started = row["conv_id"], True
                chunk.add(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if started:
            yield pa.RecordBatch.from_pylist([chunk_of_many(conv, part, at, chunk)], schema)

    order = ["conv_id", "turn", "role", "digest"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(kernel, _CHUNKED)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _sum_counts(rows: list[dict]) -> dict:
    """The counts of consecutive parts of a conversation as those of one."""
    turned = [r for r in rows if r["first_turn"] is not None]
    spoken = [r for r in rows if r["opening"] is not None]
    total = {c: sum(r[c] for r in rows) for c in ("turns", "blank", "duplicate", "truncated", "illegal")}
    total["turns"] -= sum(a["last_turn"] == b["first_turn"] for a, b in pairwise(turned))
    total["illegal"] += sum(a["closing"] + b["opening"] not in LEGAL for a, b in pairwise(spoken))
    total |= {"first_turn": turned[0]["first_turn"], "last_turn": turned[-1]["last_turn"]} if turned else {"first_turn": None, "last_turn": None}
    return total | ({"opening": spoken[0]["opening"], "closing": spoken[-1]["closing"]} if spoken else {"opening": None, "closing": None})


_PARTS = f"conv_id long, part int, {_COUNTS}, costs array<long>, audits array<string>, ways array<string>"


def _parts(chunks: DataFrame) -> DataFrame:
    """A row for each conversation and task: its chunks there as one, with the states that each way passes through."""
    schema = _arrow_schema(_PARTS)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at").to_pylist()
        # (cost, audit, states after each chunk) by way, combined two by two.
        tables = [{(i // 4, i % 4): (c, a, str(i % 4)) for i, (c, a) in enumerate(zip(r["costs"], r["audits"], strict=True)) if c >= 0} for r in rows]
        while len(tables) > 1:
            tables = [_combined(*tables[i : i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
        ways = [tables[0].get((q, to), (-1, "", "")) for q in STATES for to in STATES]
        columns = dict(zip(("costs", "audits", "ways"), map(list, zip(*ways, strict=True)), strict=True))
        return pa.Table.from_pylist([{"conv_id": rows[0]["conv_id"], "part": rows[0]["part"], **_sum_counts(rows), **columns}], schema)

    return chunks.drop("shape", "messages", "sha256", "whole").groupBy("conv_id", "part").applyInArrow(merge, _PARTS)


def _combined(one: dict, two: dict) -> dict:
    out: dict = {}
    for (q, middle), (cost, audit, way) in one.items():
        for to in STATES:
            if (middle, to) in two:
                more, letters, onward = two[middle, to]
                new = (cost + more, audit + letters, way + onward)
                out[q, to] = min(out.get((q, to), new), new)
    return out


_CHOSEN = f"{RESULT}, states array<struct<part: int, enter: int, way: string>>"


def _conversations(parts: DataFrame) -> DataFrame:
    """A row for each conversation of several parts: its counts, cost and audit, and the states of its parts' chunks."""
    schema = _arrow_schema(_CHOSEN)

    def choose(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        layers = [_table_arcs(r["costs"], r["audits"]) for r in rows]
        cost, audit = cheapest(layers, START, ENDS, inserts=False)
        # The way through the parts that has this audit: each part's audits between different states differ.
        states, reach = [], [{START: (0, "", ())}]
        for layer in layers:
            step: dict[int, tuple] = {}
            for q, more, letters, to in layer:
                if q in reach[-1]:
                    before, text, way = reach[-1][q]
                    new = (before + more, text + letters, (*way, (q, to)))
                    if audit.startswith(new[1]) and (to not in step or new < step[to]):
                        step[to] = new
            reach.append(step)
        way = next(reach[-1][q][2] for q in ENDS if q in reach[-1] and reach[-1][q][:2] == (cost, audit))
        states = [{"part": r["part"], "enter": q, "way": r["ways"][4 * q + to]} for r, (q, to) in zip(rows, way, strict=True)]
        return pa.Table.from_pylist([{"conv_id": rows[0]["conv_id"], **_result(_sum_counts(rows)), "cost": cost, "audit": audit, "states": states}], schema)

    return parts.groupBy("conv_id").applyInArrow(choose, _CHOSEN)


def _result(counts: dict) -> dict:
    gaps = 0 if counts["first_turn"] is None else counts["last_turn"] - counts["first_turn"] + 1 - counts["turns"]
    return {"gaps": gaps, **{c: counts[c] for c in ("blank", "duplicate", "truncated", "illegal")}}


def _edited(chunks: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, part, at, messages): the chunks' messages after the edits."""
    parts = chosen.select("conv_id", F.explode("states").alias("s")).select(F.struct("conv_id", F.col("s.part").alias("part")).alias("key"), "s.enter", "s.way")
    # The states around each chunk: the way's digits, with the state in which the part is entered before them.
    steps = F.concat(F.array(F.col("enter").cast("string")), F.filter(F.split("way", ""), lambda x: x != ""))
    spots = parts.select("key", F.posexplode(F.zip_with(F.slice(steps, F.lit(1), F.size(steps) - 1), F.slice(steps, F.lit(2), F.size(steps) - 1), lambda a, b: F.concat(a, b))).alias("at", "step"))
    spots = spots.select(F.struct("key.conv_id", "key.part", "at").alias("key"), "step")
    placed = chunks.withColumn("key", F.struct("conv_id", "part", "at")).join(spots, "key").select("conv_id", "part", "at", "step", "audits", "shape", "messages")
    ddl = f"conv_id long, part int, at int, messages {_MESSAGES}"
    schema = _arrow_schema(ddl)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                enter, leave = map(int, r["step"])
                shape = [(i, w, int(c)) for c, w, i in (x.split(",", 2) for x in r["shape"])]
                said = [(m["role"], m["text"]) for m in r["messages"]]
                after = repaired(shape, said, r["audits"][4 * enter + leave], enter)
                out.append({"conv_id": r["conv_id"], "part": r["part"], "at": r["at"], "messages": after})
            yield pa.RecordBatch.from_pylist(out, schema)

    return placed.mapInArrow(kernel, ddl)


def repair(rows: DataFrame, chunk: int = CHUNK, digests: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The repair of (conv_id, turn, role, text, copies): the audits, the messages, and conversations' digests.

    The first frame has a row for each conversation: its counts, cost and audit. The second, (conv_id, part, at,
    messages), has the repaired messages, in the order of part and at; a conversation that lies in one task is one row
    there (with `digests`, it is left out). The third, (conv_id, sha256), hashes `role:text` of a conversation's
    messages, joined by line ends; a hash takes its text in order, so one task reads a long conversation's messages,
    but holds only a batch of them.
    """
    found = common.stage(_chunked(common.stage(marked(rows)), chunk, digests))
    whole, chunks = found.where("whole"), found.where("NOT whole")
    chosen = common.stage(_conversations(_parts(chunks)))
    edited = common.stage(_edited(chunks, chosen))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    audits = whole.select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit")).union(chosen.drop("states"))
    messages = whole.where("messages IS NOT NULL").select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("at"), "messages").union(edited)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running, empty, started = None, hashlib.sha256(), True, False
        finished = lambda c, h: pa.RecordBatch.from_pydict({"conv_id": pa.array([c], pa.int64()), "sha256": [h.hexdigest()]})
        for batch in batches:
            for row in batch.to_pylist():
                if started and row["conv_id"] != conv:
                    yield finished(conv, running)
                    running, empty = hashlib.sha256(), True
                conv, started = row["conv_id"], True
                if row["messages"]:
                    running.update(("" if empty else "\n").encode() + joined([(m["role"], m["text"]) for m in row["messages"]]).encode())
                    empty = False
        if started:
            yield finished(conv, running)

    long = edited.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at").mapInArrow(hashed, "conv_id long, sha256 string")
    return audits, messages, whole.select("conv_id", "sha256").union(long)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, copies) with the faults that a hash of conv_id and turn names.

    Of twenty hashes one drops the row (no copies), one empties its text, one removes the ends of sentences, one
    repeats it and one makes it the user's. A null counts as a space, in the hash as in role and text.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's columns: the audits of the damaged conversations, with a digest of the repaired ones."""
    audits, _, digests = repair(damaged(conversations), digests=True)
    same = digests.select(F.struct("conv_id").alias("key"), F.col("sha256").alias("repaired_sha256"))
    return audits.withColumn("key", F.struct("conv_id")).join(same, "key").drop("key")
