"""Cheapest repair of damaged conversations, by dynamic programming over shared edit prefixes.

A repaired conversation is one optional system turn, then pairs of user and assistant turns.  Rows are kept (0), given
another role (3) or deleted (4, the only choice for blank and repeated ones), and empty turns are inserted (3); a row that ends in the
middle of a sentence adds 3 unless it is deleted.  Of the cheapest lists of edits the one whose initials (``D I K R``) come first
in ASCII order is taken.

For each row the search keeps the best list of edits that ends in each of four states (nothing yet, after system, after
user, after assistant).  Lists share their beginnings: each is a node that knows its last edit, its 1st, 2nd, 4th, ... ancestor and
a rolling hash of all its edits.  Two lists of equal cost are compared by the longest common prefix, found by lifting both
while the hashes differ; that the beginnings with equal hashes are equal is then verified along the nodes, up to where both share one.

Rows are sorted by conversation and turn over the whole cluster and read as a stream, so a conversation of any length is spread
over many tasks.  A conversation that lies inside a segment is solved at once.  Of one that does not, each segment is solved for
every state it can be entered in; the segments' costs and edits are then joined in order.  Only its digest, a hash of
one text, has to be fed by one task, which holds one segment of it at a time.

Defined results: a null role or text counts as one blank; rows without a turn come first; rows of one turn follow each other by
role and then by the MD5 digest of role and text; equal rows are repeats of the first of them; a null conversation id is one conversation;
one that loses all its rows has zeros, no edits and the digest of nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.lineage import cut_lineage
from ..plans.sizing import estimated_bytes

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
CHANGE_COST, DELETE_COST = 3, 4
SEGMENT_ROWS = 4096
SEGMENT_BYTES = 4 << 20
PARTITION_BYTES = 64 << 20  # of the table, as the planner expects it, per task that reads it in order
MODULUS = (1 << 61) - 1
BASE = 1_000_003

BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # where an inserted or renamed turn leads
_NAMES = {USER: "user", ASSISTANT: "assistant"}


class Prefixes:
    """Lists of edits as nodes of a forest; node 0 is the empty list."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.above: list[list[int]] = [[]]  # 1st, 2nd, 4th, ... ancestor
        self.edit, self.hash, self.depth = [""], [0], [0]

    def add(self, node: int, edit: str) -> int:
        above, step = [node], 0
        while step < len(self.above[above[step]]):
            above.append(self.above[above[step]][step])
            step += 1
        self.above.append(above)
        self.edit.append(edit)
        self.hash.append((self.hash[node] * BASE + ord(edit)) % self.modulus)
        self.depth.append(self.depth[node] + 1)
        return len(self.edit) - 1

    def text(self, node: int) -> str:
        found = []
        while node:
            found.append(self.edit[node])
            node = self.above[node][0]
        return "".join(reversed(found))

    def _lifted(self, node: int, depth: int) -> int:
        rise = self.depth[node] - depth
        while rise:
            step = rise.bit_length() - 1
            node = self.above[node][step]
            rise -= 1 << step
        return node

    def _first_difference(self, a: int, b: int) -> tuple[int, int] | None:
        """Of two nodes of one depth: their ancestors at the earliest depth with different edits, none if there is no such depth."""
        found = None
        while a != b:
            if self.edit[a] != self.edit[b]:
                found = a, b
            a, b = self.above[a][0], self.above[b][0]
        return found

    def before(self, a: int, b: int) -> bool:
        """Whether the list of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lifted(a, depth), self._lifted(b, depth)
        if self.hash[x] != self.hash[y]:
            for step in range(len(self.above[x]) - 1, -1, -1):
                if step < len(self.above[x]):
                    p, q = self.above[x][step], self.above[y][step]
                    if self.hash[p] != self.hash[q]:
                        x, y = p, q
            other = self._first_difference(self.above[x][0], self.above[y][0])
            x, y = other or (x, y)
        else:
            other = self._first_difference(x, y)
            if other is None:
                return self.depth[a] < self.depth[b]
            x, y = other
        return self.edit[x] < self.edit[y]


class Row:
    """What the search needs to know of a row."""

    __slots__ = ("initial", "must_go", "extra")

    def __init__(self, role: str, must_go: bool, truncated: bool):
        self.initial, self.must_go, self.extra = role[:1], must_go, CHANGE_COST if truncated else 0


def _offer(states: dict, prefixes: Prefixes, state: int, cost: int, node: int, edit: str) -> None:
    """Take a list of edits if it is cheaper than the one known, or as cheap and first in order."""
    known = states.get(state)
    if known is not None and known[0] < cost:
        return
    made = prefixes.add(node, edit)
    if known is None or cost < known[0] or prefixes.before(made, known[1]):
        states[state] = (cost, made)


def _insert(states: dict, prefixes: Prefixes) -> None:
    for state in (START, SYSTEM, ASSISTANT, USER):  # into user first, then on to assistant; a third is never cheaper
        if state in states:
            cost, node = states[state]
            _offer(states, prefixes, _NEXT[state], cost + CHANGE_COST, node, INSERT)


def search(rows: list[Row], entry: int | None, modulus: int = MODULUS) -> dict[int, tuple[int, str]]:
    """Cost and edits of the best way from a state, or from the beginning of a conversation, to every state after all rows."""
    prefixes = Prefixes(modulus)
    states = {START if entry is None else entry: (0, 0)}
    if entry is None:
        _insert(states, prefixes)
    for row in rows:
        after: dict = {}
        for state, (cost, node) in states.items():
            _offer(after, prefixes, state, cost + DELETE_COST, node, DELETE)
            if not row.must_go:
                kept = _AFTER.get(row.initial, {}).get(state)
                if kept is not None:
                    _offer(after, prefixes, kept, cost + row.extra, node, KEEP)
                _offer(after, prefixes, _NEXT[state], cost + CHANGE_COST + row.extra, node, REROLE)
        _insert(after, prefixes)
        states = after
    return {state: (cost, prefixes.text(node)) for state, (cost, node) in states.items()}


def joined(paths: dict, edges: dict[int, dict[int, tuple[int, str]]]) -> dict:
    """Best ways to every state after one more segment.

    ``paths`` maps states to (cost, edits that differ between states, all segments' edits as a linked list).
    """
    after: dict = {}
    for entry, (cost, tail, path) in paths.items():
        for state, (more, edits) in edges.get(entry, {}).items():
            known = after.get(state)
            if known is None or (cost + more, tail + edits) < known[:2]:
                after[state] = (cost + more, tail + edits, (path, entry, edits))
    shared = len(os.path.commonprefix([tail for _, tail, _ in after.values()]))
    return {state: (cost, tail[shared:], path) for state, (cost, tail, path) in after.items()}


BEGINNING = {START: (0, "", None), USER: (3, INSERT, (None, None, INSERT)), ASSISTANT: (6, INSERT * 2, (None, None, INSERT * 2))}


def finished(states: dict):
    """The better of the two states that a repaired conversation can end in."""
    return min((states[s] for s in (START, ASSISTANT) if s in states), key=lambda found: found[:2])


def repaired(edits: str, entry: int, roles: list[str], texts: list[str]):
    """``(lines of the repaired turns, state after them)``."""
    lines, state, at = [], entry, 0
    for edit in edits:
        if edit == INSERT:
            state = _NEXT[state]
            lines.append(_NAMES[state] + ":")
            continue
        if edit == KEEP:
            state = _AFTER[roles[at][:1]][state]
            lines.append(roles[at] + ":" + texts[at])
        elif edit == REROLE:
            state = _NEXT[state]
            lines.append(_NAMES[state] + ":" + texts[at])
        at += 1
    return lines, state


# ------------------------------------------------------------------ damage and faults

def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows after damage: ``conv, turn, role, text, copy, tie, dropped``; a dropped row stays as a mark of its conversation."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text_, role_ = F.coalesce(F.col(text), blank), F.coalesce(F.col(role), blank)
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (conversations
            .select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                    F.when(kind == 4, "user").otherwise(role_).alias("role"),
                    F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(text_, "[.!?]", "")).otherwise(text_).alias("text"),
                    (kind == 0).alias("dropped"), copies.alias("copies"), F.monotonically_increasing_id().alias("tie"))
            .select("conv", "turn", "role", "text", "dropped", "tie", F.explode("copies").alias("copy")))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with ``blank``, ``truncated`` and ``duplicate``, of which the first that holds counts."""
    end = F.rtrim("text", F.lit(BLANKS))
    rows = (rows.withColumn("digest", F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))))
            .withColumn("blank", end == "")
            .withColumn("truncated", ~F.right(end, F.lit(1)).isin(".", "!", "?"))
            .withColumn("place", F.struct("turn", "tie", "copy")))
    told = (rows.where(~F.col("dropped") & ~F.col("blank")).groupBy(F.col("conv").alias("of"), F.col("digest").alias("same"))
            .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    found = rows.join(told, F.col("conv").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")), "left")
    return found.withColumn("duplicate", F.coalesce(F.col("place") > F.col("first"), F.lit(False))).drop("of", "same", "first", "place")


# ------------------------------------------------------------------ segments

def _stats_fields() -> list:
    return [("first_role", T.StringType()), ("last_role", T.StringType()), ("first_turn", T.LongType()), ("last_turn", T.LongType()),
            ("turns", T.LongType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()),
            ("illegal", T.LongType())]


_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class Stats:
    """Counts of consecutive rows of a conversation that can be put together."""

    def __init__(self, values: dict | None = None):
        self.values = values or {"first_role": None, "last_role": None, "first_turn": None, "last_turn": None, "turns": 0, "blank": 0,
                                 "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, other: dict) -> None:
        mine = self.values
        for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
            mine[name] += other[name]
        if other["first_role"] is not None:
            if mine["last_role"] is None:
                mine["first_role"] = other["first_role"]
            elif (mine["last_role"], other["first_role"]) not in _LEGAL:
                mine["illegal"] += 1
            mine["last_role"] = other["last_role"]
        if other["first_turn"] is not None:
            if mine["last_turn"] is None:
                mine["first_turn"] = other["first_turn"]
            elif mine["last_turn"] == other["first_turn"]:
                mine["turns"] -= 1
            mine["last_turn"] = other["last_turn"]

    def result(self) -> dict:
        mine = self.values
        gaps = 0 if mine["first_turn"] is None else mine["last_turn"] - mine["first_turn"] + 1 - mine["turns"]
        return {"gaps": gaps, **{n: mine[n] for n in ("blank", "duplicate", "truncated", "illegal")}}


class Segment:
    """Consecutive rows of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.roles, self.texts, self.size, self.stats = conv, [], [], [], 0, Stats()

    def add(self, turn, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        must_go = blank or duplicate
        self.rows.append(Row(role, must_go, truncated and not must_go))
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)
        self.stats.add({"first_role": role[:1], "last_role": role[:1], "first_turn": turn, "last_turn": turn, "turns": int(turn is not None),
                        "blank": int(blank), "duplicate": int(duplicate and not blank), "truncated": int(truncated and not must_go), "illegal": 0})

    def solved(self) -> dict:
        cost, edits = finished(search(self.rows, None))
        lines, _ = repaired(edits, START, self.roles, self.texts)
        return {"cost": cost, "audit": edits, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(), **self.stats.result()}


_RESULT = [("gaps", T.LongType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()),
           ("illegal", T.LongType()), ("cost", T.LongType()), ("audit", T.StringType()), ("repaired_sha256", T.StringType())]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _segment_schema(conv_type) -> T.StructType:
    edge = _struct([("entry", T.IntegerType()), ("exit", T.IntegerType()), ("cost", T.LongType()), ("edits", T.StringType())])
    return _struct([("conv", conv_type), ("part", T.LongType()), ("solved", _struct(_RESULT)), ("stats", _struct(_stats_fields())),
                    ("edges", T.ArrayType(edge)), ("roles", T.ArrayType(T.StringType())), ("texts", T.ArrayType(T.StringType()))])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _in_batches(found, schema: pa.Schema, rows: int = 500, size_of=lambda row: 0):
    held, size = [], 0
    for row in found:
        held.append(row)
        size += size_of(row)
        if len(held) >= rows or size > SEGMENT_BYTES:
            yield from pa.Table.from_pylist(held, schema=schema).to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_pylist(held, schema=schema).to_batches()


def _streamed(batches):
    for batch in batches:
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            yield values


def _segments(conv_type, segment_rows: int):
    schema = _segment_schema(conv_type)

    def cut(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 33

        def found():
            nonlocal part
            now, whole = None, False  # whether the conversation began inside this partition
            for conv, turn, role, text, dropped, blank, duplicate, truncated in _streamed(batches):
                if now is None or conv != now.conv:
                    if now is not None:
                        yield row_of(now, whole)
                    whole, now = now is not None, Segment(conv)
                elif len(now.rows) >= segment_rows or now.size >= SEGMENT_BYTES:
                    yield row_of(now, False)
                    whole, now = False, Segment(conv)
                if not dropped:
                    now.add(turn, role, text, blank, duplicate, truncated)
            if now is not None:
                yield row_of(now, False)

        def row_of(segment: Segment, whole: bool) -> dict:
            nonlocal part
            part += 1
            row = {"conv": segment.conv, "part": part}
            if whole:
                return row | {"solved": segment.solved()}
            ways = [{"entry": entry, "exit": state, "cost": cost, "edits": edits} for entry in range(4)
                    for state, (cost, edits) in search(segment.rows, entry).items()]
            return row | {"stats": segment.stats.values, "edges": ways, "roles": segment.roles, "texts": segment.texts}

        yield from _in_batches(found(), _arrow(schema), size_of=lambda row: sum(map(len, row.get("texts", ()))))

    return cut, schema


def _chosen(conv_type):
    """Join the segments of conversations in order; says for each segment where it is entered and what is done in it."""
    schema = _struct([("part", T.LongType()), ("entry", T.IntegerType()), ("edits", T.StringType()), ("total", _struct(_RESULT[:-1]))])

    def join(batches):
        def closed(parts, paths, stats):
            cost, _, path = finished(paths)
            steps = []
            while path is not None and path[1] is not None:
                path, entry, edits = path
                steps.append((entry, edits))
            steps.reverse()
            begun = path[2] if path is not None else ""  # turns inserted before the first row
            for at, (part, (entry, edits)) in enumerate(zip(parts, steps, strict=True)):
                row = {"part": part, "entry": START if at == 0 else entry, "edits": begun + edits if at == 0 else edits}
                if at == 0:
                    row["total"] = {"cost": cost, "audit": begun + "".join(e for _, e in steps), **stats.result()}
                yield row

        def found():
            now = None
            for conv, part, values, edges in _streamed(batches):
                if now is None or now[0] != conv:
                    if now is not None:
                        yield from closed(*now[1:])
                    now = [conv, [], dict(BEGINNING), Stats()]
                ways: dict = {}
                for edge in edges:
                    ways.setdefault(edge["entry"], {})[edge["exit"]] = (edge["cost"], edge["edits"])
                now[1].append(part)
                now[2] = joined(now[2], ways)
                now[3].add(values)
            if now is not None:
                yield from closed(*now[1:])

        yield from _in_batches(found(), _arrow(schema), size_of=lambda row: len(row["edits"]))

    return join, schema


def _hashed(conv_type):
    schema = _struct([("conv", conv_type), ("solved", _struct(_RESULT))])

    def feed(batches):
        def found():
            now = None
            for conv, part, roles, texts, entry, edits, total in _streamed(batches):
                if now is None or now[0] != conv:
                    if now is not None:
                        yield {"conv": now[0], "solved": now[1] | {"repaired_sha256": now[2].hexdigest()}}
                    now = [conv, total, hashlib.sha256(), True]
                lines, _ = repaired(edits, entry, roles, texts)
                if lines:
                    now[2].update((("" if now[3] else "\n") + "\n".join(lines)).encode())
                    now[3] = False
            if now is not None:
                yield {"conv": now[0], "solved": now[1] | {"repaired_sha256": now[2].hexdigest()}}

        yield from _in_batches(found(), _arrow(schema))

    return feed, schema


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, name: str = "conv_id", tasks: int | None = None) -> DataFrame:
    """One row per conversation of ``with_faults(damaged(...))``: counts of faults, cost, edits and the digest of the repaired turns.

    ``tasks`` read the rows in order; as many as the session shuffles into unless given.
    """
    conv_type = rows.schema["conv"].dataType
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order: list[Column] = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "digest", "tie", "copy"))]
    ordered = (rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
               .select("conv", F.col("turn").cast("long"), "role", "text", "dropped", "blank", "duplicate", "truncated"))
    cut, schema = _segments(conv_type, segment_rows)
    parts = cut_lineage(ordered.mapInArrow(cut, schema), "segments")
    # What follows are conversations that cross a segment, at most two of each task but for very long ones.
    crossing = parts.where(F.col("solved").isNull())
    join, schema = _chosen(conv_type)
    chosen = (crossing.select("conv", "part", "stats", "edges").repartition("conv").sortWithinPartitions("conv", "part")
              .mapInArrow(join, schema))
    feed, schema = _hashed(conv_type)
    done = (crossing.select("conv", "part", "roles", "texts").join(chosen, "part").repartition("conv").sortWithinPartitions("conv", "part")
            .select("conv", "part", "roles", "texts", "entry", "edits", "total").mapInArrow(feed, schema))
    whole = parts.where(F.col("solved").isNotNull()).select("conv", "solved")
    return whole.unionByName(done).select(F.col("conv").alias(name), "solved.*")


def repair_damaged(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Damage all rows by the fixed rule, then repair every conversation."""
    size = estimated_bytes(conversations)  # of the table itself: joins make the planner's estimate useless
    size = 0 if size > 1 << 60 else size  # the planner knows nothing of it
    tasks = max(int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    return repair(with_faults(damaged(conversations)), segment_rows, tasks=tasks)
