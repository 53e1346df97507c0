"""Conversations with turns missing, empty, repeated or cut short, repaired at least cost.

The roles of a whole conversation are ``(s?(ua)+)?``, so an editor is in one of four states:
nothing said, after a system, a user or an assistant turn.  Divide and conquer in the manner
of Hirschberg finds the cheapest edits: cost vectors over the four states run forward to the
middle and backward to it, the best crossing splits the problem in two.  Forward vectors
also carry how the cheapest edits up to each state rank as text, so of equally cheap
crossings that with the least audit is taken, in space linear in the turns.

A conversation may hold any share of all rows.  Rows are sorted into ranges of even size;
what a range holds of a conversation becomes a node, one letter a turn.  A node is summed
up by its costs from each state to each other; nodes are steps like turns are, so ranges
are summed up and split in the same way, ``FAN`` at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from newslake.llm.common import pick, written

#: Nodes that are summed up together, as bits.
FAN_BITS = 10
#: Turns whose texts are put together before a conversation is hashed.
LINES = 256
WHITE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant turn that is put in.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Letters of turns: kinds of roles (any other one is x), and whether whole, cut short or to be deleted.
KINDS, FAULTS = "suax", 3
CODES = {chr(ord("A") + FAULTS * k + f): (kind, f) for k, kind in enumerate(KINDS) for f in range(FAULTS)}
#: Edits behind the last turn.
FINALLY = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

#: A step leads from each state to others: (state, cost, what decides between equal costs).
Step = tuple[tuple[tuple[int, int, object], ...], ...]


def _edits(code: str) -> Step:
    """The cheapest edits of a turn from state to state; those before it belong to it.

    An insertion before a deletion is never least, as the deletion could come first, and
    two insertions before a turn lead nowhere that none does not.
    """
    kind, fault = CODES[code]
    out = []
    for state in range(4):
        found = [(state, DELETE, "D")]
        if fault < 2:
            extra = CUT_SHORT if fault == 1 else 0
            for at, cost, said in ((state, extra, ""), (NEXT[state], extra + INSERT, "I")):
                if (kind, at) in KEPT:
                    found.append((KEPT[kind, at], cost, f"{said}K"))
                found.append((NEXT[at], cost + REROLE, f"{said}R"))
        best = {}
        for to, cost, said in found:
            best[to] = min(best.get(to, (cost, said)), (cost, said))
        out.append(tuple((to, *b) for to, b in best.items()))
    return tuple(out)


STEPS = {code: _edits(code) for code in CODES}


def forward(steps: Sequence[Step], start: int) -> list[tuple[int, int] | None]:
    """Cost of each state, and its rank: the order of the least texts among the cheapest edits."""
    vector: list[tuple[int, int] | None] = [None] * 4
    vector[start] = (0, 0)
    for step in steps:
        best: dict[int, tuple] = {}
        for state, known in enumerate(vector):
            if known is not None:
                for to, cost, said in step[state]:
                    option = (known[0] + cost, known[1], said)
                    if to not in best or option < best[to]:
                        best[to] = option
        order = {to: rank for rank, to in enumerate(sorted(best, key=lambda to: best[to][1:]))}
        vector = [(best[to][0], order[to]) if to in best else None for to in range(4)]
    return vector


def backward(steps: Sequence[Step], end: int) -> list[int | None]:
    """Cost from each state to the end."""
    vector: list[int | None] = [None] * 4
    vector[end] = 0
    for step in reversed(steps):
        vector = [
            min((cost + vector[to] for to, cost, _ in options if vector[to] is not None), default=None) for options in step
        ]
    return vector


def crossings(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """The states between the steps on the cheapest way with the least text, both ends included."""
    states = [start] * (len(steps) + 1)
    states[-1] = end
    waiting = [(0, len(steps))]
    while waiting:
        low, high = waiting.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        here, there = forward(steps[low:middle], states[low]), backward(steps[middle:high], states[high])
        both = [(h[0] + t, h[1], s) for s, (h, t) in enumerate(zip(here, there, strict=True)) if h is not None and t is not None]
        states[middle] = min(both)[2]
        waiting += [(low, middle), (middle, high)]
    return states


def best_end(steps: Sequence[Step], start: int = START) -> int:
    """The state from which the conversation ends at least cost."""
    ends = [(known[0] + INSERT * len(FINALLY[s]), known[1], s) for s, known in enumerate(forward(steps, start)) if known is not None]
    return min(ends)[2]


def edits(codes: str, start: int, end: int) -> list[str]:
    """The edits of every turn."""
    steps = [STEPS[c] for c in codes]
    states = crossings(steps, start, end)
    ways = zip(steps, states, states[1:], strict=False)
    return [next(said for to, _, said in step[a] if to == b) for step, a, b in ways]


@functools.lru_cache(maxsize=1 << 16)
def whole(codes: str) -> tuple[int, tuple[str, ...]]:
    """End state and edits of a conversation that is one node; short ones are remembered."""
    end = best_end([STEPS[c] for c in codes])
    return end, tuple(edits(codes, START, end))


def cost_of(codes: str, said: Sequence[str]) -> int:
    price = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}
    letters = sum(price[x] for edit in said for x in edit)
    return letters + sum(CUT_SHORT for code, edit in zip(codes, said, strict=False) if CODES[code][1] == 1 and edit != "D")


def summary(steps: Sequence[Step]) -> list[list[int]]:
    """What stands for many steps: (from, to, cost, rank)."""
    return [[a, b, *known] for a in range(4) for b, known in enumerate(forward(steps, a)) if known is not None]


def as_step(summed: list[list[int]]) -> Step:
    return tuple(tuple((b, cost, rank) for a, b, cost, rank in summed if a == state) for state in range(4))


def turns_of(codes: str, said: Sequence[str], start: int) -> tuple[list[int | None], list[str | None], list[str], int]:
    """Of every turn that the edits leave: its place among the codes, its new role and its edit."""
    places, roles, marks, state = [], [], [], start
    for place, edit in enumerate(said):
        for mark in edit:
            if mark == "D":
                continue
            if mark == "K":
                state = KEPT[CODES[codes[place]][0], state]
            else:
                state = NEXT[state]
            places.append(None if mark == "I" else place)
            roles.append(None if mark == "K" else ROLE[state])
            marks.append(mark)
    return places, roles, marks, state


def damage(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows ``conv, turn, role, text`` with faults by the CRC-32 of ``conv:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3
    repeats it, 4 makes its role user.  Null roles and texts become one space, as do null
    ids and turns in the hashed text; these stay null themselves.
    """
    rows = pick(df, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    space = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv", "turn")]
    hit = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    text = F.coalesce("text", space)
    damaged = rows.withColumn("hit", hit).filter("hit != 0").select(
        "conv",
        "turn",
        F.when(F.col("hit") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1))).alias("copy"),
    )
    return damaged.drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``place``, which follows the order of turns in every conversation.

    The order is cut into ranges of even size; equal rows are cut by where they were read.
    ``node`` is the range, and the places of a conversation in a range are consecutive.
    """
    order = ["key", "turn", "role", "text"]
    ranged = rows.withColumn("read", F.monotonically_increasing_id()).repartitionByRange(*order, "read")
    placed = ranged.sortWithinPartitions(*order).drop("read").withColumn("place", F.monotonically_increasing_id())
    return written(placed.withColumn("node", F.shiftright("place", 33)), "repair-turns")


def _code(kind: Column, fault: Column) -> Column:
    letter = sum((F.when(kind == k, i * FAULTS).otherwise(0) for i, k in enumerate(KINDS)), F.lit(ord("A")))
    return F.char(letter + fault)


def _nodes(turns: DataFrame) -> DataFrame:
    """``key, node, first, codes`` and figures: what each range holds of each conversation."""
    same = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = turns.groupBy("key", same.alias("same")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    said = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    light = turns.select(
        "key",
        "node",
        "place",
        (said == "").alias("blank"),
        F.right(said, F.lit(1)).isin(".", "!", "?").alias("ended"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("kind"),
    )
    known = light.join(firsts, "place", "left").withColumn("again", ~F.col("blank") & F.col("new").isNull())
    faults = known.withColumn("cut", ~F.col("blank") & ~F.col("again") & ~F.col("ended"))
    fault = F.when(F.col("blank") | F.col("again"), 2).when(F.col("cut"), 1).otherwise(0)
    in_order = F.array_sort(F.collect_list(F.struct("place", _code(F.col("kind"), fault).alias("code"))))
    nodes = faults.groupBy("key", "node").agg(
        F.min("place").alias("first"),
        F.array_join(F.transform(in_order, lambda x: x["code"]), "").alias("codes"),
        *[F.sum(F.col(old).cast("long")).alias(new) for old, new in (("blank", "blank"), ("again", "duplicate"), ("cut", "truncated"))],
    )
    return written(nodes, "repair-nodes")


_LINKS = "array<array<int>>"


def _map_rows(df: DataFrame, function: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Run a function over rows as dicts, which gives rows as dicts."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = [row for given in batch.slice(start, 256).to_pylist() for row in function(given)]
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, schema)


def _assigned(nodes: DataFrame, key: str) -> DataFrame:
    """``key, node, start, end``: the states on both sides of nodes ``key, node, links``.

    Nodes of one conversation are summed up in groups of neighbours; the groups are split
    in the same way, from the top, and then each group's own nodes.
    """
    together = F.array_sort(F.collect_list(F.struct("node", "links")))
    groups = written(
        nodes.groupBy("key", F.shiftright("node", FAN_BITS).alias("upper")).agg(together.alias("nodes")), "repair-groups"
    )

    def sum_up(row: dict) -> Iterator[dict]:
        yield {"key": row["key"], "node": row["upper"], "links": summary([as_step(n["links"]) for n in row["nodes"]])}

    def split(row: dict) -> Iterator[dict]:
        steps = [as_step(n["links"]) for n in row["nodes"]]
        states = crossings(steps, row["start"], best_end(steps) if row["end"] is None else row["end"])
        for node, start, end in zip(row["nodes"], states, states[1:], strict=False):
            yield {"key": row["key"], "node": node["node"], "start": start, "end": end}

    if groups.groupBy("key").count().filter("count > 1").isEmpty():
        asked = groups.withColumn("start", F.lit(START)).withColumn("end", F.lit(None).cast("int"))
    else:
        summed = _map_rows(groups, sum_up, f"key {key}, node long, links {_LINKS}")
        upper = _assigned(written(summed, "repair-upper"), key).withColumnRenamed("node", "upper")
        asked = groups.join(upper, ["key", "upper"])
    return written(_map_rows(asked, split, f"key {key}, node long, start int, end int"), "repair-states")


class Repaired(NamedTuple):
    """``report``: ``conv, blank, duplicate, truncated, illegal, gaps, cost, audit``;
    ``turns``: ``conv, node, step, edit, role, text``, in order by node and step."""

    report: DataFrame
    turns: DataFrame


def repair(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repaired:
    """Repair every conversation at least cost.

    Turns are taken by number, nulls first, and those that share one by role and text; null
    roles and texts count as one space, and rows without an id are one conversation.  A
    turn is blank, or else a duplicate (its role and text were there before), or else
    truncated (it does not end in ``.``, ``!`` or ``?``, white space aside).  Blank turns and
    duplicates are deleted; keeping costs 0, another role 3, deleting 4, inserting an empty
    turn 3, and a truncated turn that stays 3 more.  The initials of the edits are the audit;
    of the cheapest the least one is taken.  Roles go by their first character.

    Texts of any length and repeated rows are fine.  Conversations without rows are in
    neither table; an empty table gives empty ones.  Other columns are left out, whatever
    their names.  The audit of a conversation is one value, so that must fit in a row.
    """
    rows = pick(df, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    space = F.lit(" ")
    keyed = rows.select(F.struct(F.col("conv").alias("id")).alias("key"), "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = dict(keyed.dtypes)["key"]
    turns = _ordered(keyed)
    nodes = _nodes(turns)

    large = nodes.groupBy("key").count().filter("count > 1").select("key")
    several = nodes.join(large, "key", "left_semi").select("key", "node", "codes")

    def sum_up(row: dict) -> Iterator[dict]:
        yield {"key": row["key"], "node": row["node"], "links": summary([STEPS[c] for c in row["codes"]])}

    summed = written(_map_rows(several, sum_up, f"key {key}, node long, links {_LINKS}"), "repair-links")
    states = _assigned(summed, key)
    last = states.groupBy("key").agg(F.max("node").alias("last"))
    asked = nodes.join(states, ["key", "node"], "left").join(last, "key", "left")

    def solve(row: dict) -> Iterator[dict]:
        codes, start, end = row["codes"], row["start"], row["end"]
        if start is None:
            start = START
            end, said = whole(codes) if len(codes) <= 64 else whole.__wrapped__(codes)
        else:
            said = edits(codes, start, end)
        if row["last"] in (None, row["node"]) and FINALLY[end]:
            said = [*said, FINALLY[end]]
        kinds = [CODES[c][0] for c in codes]
        places, roles, marks, _ = turns_of(codes, said, start)
        yield {
            "key": row["key"],
            "node": row["node"],
            "opens": kinds[0],
            "closes": kinds[-1],
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False)),
            "cost": cost_of(codes, said),
            "audit": "".join(said),
            "places": [None if p is None else row["first"] + p for p in places],
            "roles": roles,
            "edits": marks,
            **{f: row[f] for f in ("blank", "duplicate", "truncated")},
        }

    figures = "illegal long, cost long, blank long, duplicate long, truncated long"
    lists = "places array<long>, roles array<string>, edits array<string>"
    schema = f"key {key}, node long, opens string, closes string, audit string, {figures}, {lists}"
    solved = written(_map_rows(asked, solve, schema), "repair-solved")

    before = F.lag("closes").over(W.partitionBy("key").orderBy("node"))
    joint = solved.drop("places", "roles", "edits").withColumn("joint", F.concat(before, "opens"))
    broken = F.coalesce((~F.col("joint").isin("su", "ua", "au")).cast("long"), F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("node", "audit")))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")]
    per_conv = joint.groupBy("key").agg(
        *sums, F.sum(F.col("illegal") + broken).alias("illegal"), F.array_join(F.transform(parts, lambda x: x["audit"]), "").alias("audit")
    )
    numbers = turns.select("key", F.col("turn").cast("long").alias("turn")).groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    report = per_conv.join(numbers, "key").select(
        F.col("key.id").alias("conv"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )

    left = solved.select("key", "node", F.posexplode(F.arrays_zip("places", "roles", "edits")).alias("step", "turn"))
    left = left.select("key", "node", "step", F.col("turn.places").alias("place"), F.col("turn.roles").alias("new"), F.col("turn.edits").alias("edit"))
    texts = turns.select("place", "role", "text")
    said = left.join(texts, "place", "left").select(
        F.col("key.id").alias("conv"), "node", "step", "edit",
        F.coalesce("new", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return Repaired(report, said)


def digests(turns: DataFrame) -> DataFrame:
    """``conv, sha256`` of the turns of each conversation as ``role:text``, joined by line ends.

    A hash goes over its input in order, so a conversation is hashed in one task; that
    reads ``LINES`` turns as one row and holds one such row at a time.
    """
    line = F.concat("role", F.lit(":"), "text")
    keyed = turns.select(F.struct("conv").alias("key"), "node", "step", F.shiftright("step", LINES.bit_length() - 1).alias("part"), line.alias("line"))
    lines = F.array_sort(F.collect_list(F.struct("step", "line")))
    parts = keyed.groupBy("key", "node", "part").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("lines"))
    sorted_parts = parts.repartition("key").sortWithinPartitions("key", "node", "part").select("key", "lines")
    key = dict(parts.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, kind = None, None, None

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([held], kind), pa.array([state.hexdigest()])], ["key", "sha256"])

        for batch in batches:
            kind = batch.schema.types[0]
            for i in range(batch.num_rows):
                conv, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().encode()
                if state is None or conv != held:
                    if state is not None:
                        yield result()
                    held, state = conv, hashlib.sha256(text)
                else:
                    state.update(b"\n" + text)
        if state is not None:
            yield result()

    return sorted_parts.mapInArrow(run, f"key {key}, sha256 string").select(F.col("key.conv").alias("conv"), "sha256")
