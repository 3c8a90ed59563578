"""Repair of conversations: the cheapest edits that make turns alternate, with an audit of the edits.

A repaired conversation is empty, or an optional system turn and then one or more pairs of user and assistant. A
conversation's turns are aligned to every feasible length of that string by Wagner and Fischer's table. All lengths share
the table, since the string of a length is the end of every longer one; cells that no alignment within the cost of a known
repair can pass are left out (Ukkonen's bands).

The table grows with the square of a conversation, so conversations of more than ``LIMIT`` turns take another exact way:
slices of their turns are worked through apart, by the cheapest way from each place in the grammar to each other one,
and joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.llm.ranks import ordered
from labtide.llm.staging import staged

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
LIMIT = 512
LIMIT_BYTES = 1 << 26
SLICE = 1 << 12
FAR = 1 << 60

ROLES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"
HEAD = 64
STATS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
REPAIRED = f"conv_id bigint, {STATS}, turns array<struct<role:string,text:string>>"


class Row(NamedTuple):
    """What the alignment needs of a turn: role initial, whether it must go, what it costs to leave it truncated."""

    initial: str
    bad: bool
    cut: int


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with known damage, by the CRC of ``conv_id:turn``: conv_id, turn, role, text, copy.

    Nulls of role and text, and in the text of the CRC, are one space. A dropped turn stays as a row with a null ``copy``,
    so that its conversation is not lost; of a repeated one there are copies 0 and 1.
    """
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    none = F.lit(None).cast("int")
    copies = F.when(kind == 0, F.array(none)).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def marked(turns: DataFrame) -> DataFrame:
    """Turns with what their own row tells: role initial, blank, cut (ends without a full stop) and a key of role and text."""
    bare = F.rtrim("text", F.lit(WHITE))
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return turns.select("conv_id", "turn", *known, "copy").withColumns(
        {
            "head": F.substring("text", 1, HEAD),
            "initial": F.substring("role", 1, 1),
            "blank": F.length(bare) == 0,
            "cut": ~F.substring(bare, -1, 1).isin(".", "!", "?"),
            "same": F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256),
        }
    )


def greedy_cost(rows: Sequence[Row]) -> int:
    """The cost of some repair: the better of deleting all and of taking turns as they come."""
    cost, phase = 0, 0
    for row in rows:
        if row.bad:
            cost += DELETE
        elif phase == 0 and row.initial == "s":
            cost, phase = cost + row.cut, 1
        else:
            want = "a" if phase == 2 else "u"
            cost += row.cut + (0 if row.initial == want else REROLE)
            phase = 3 if want == "a" else 2
    return min(DELETE * len(rows), cost + INSERT * (0, 2, 1, 0)[phase])


def _wanted(left: int) -> str:
    """The grammar string's character when ``left`` of its characters are still to come."""
    return "a" if left % 2 else "u"


def aligned(rows: Sequence[Row]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair; of equally cheap ones, that with the least audit.

    ``table[i][j]`` is the cost of aligning the turns from ``i`` on with the last ``j`` characters, for the diagonals that the
    known repair's cost allows. The audit is read off from the front, least edit first, which gives the least audit
    of a length; lengths are then compared by cost and audit. No turns cost nothing.
    """
    n = len(rows)
    if not n:
        return 0, ""
    bound = greedy_cost(rows)
    ahead, behind = bound // INSERT, bound // DELETE

    def cells(i: int) -> range:
        return range(max(0, n - i - behind), n - i + ahead + 1)

    table: list[dict[int, int]] = [{}] * n + [{j: INSERT * j for j in cells(n)}]
    for i in range(n - 1, -1, -1):
        below, now, row = table[i + 1], {}, rows[i]
        for j in cells(i):
            cost = below.get(j, FAR) + DELETE
            if j:
                cost = min(cost, now.get(j - 1, FAR) + INSERT)
                if not row.bad:
                    cost = min(cost, below.get(j - 1, FAR) + row.cut + (0 if row.initial == _wanted(j) else REROLE))
            now[j] = cost
        table[i] = now

    def edit(i: int, j: int) -> str:
        """The least edit on a cheapest way on from a cell."""
        here = table[i][j]
        if i < n and table[i + 1].get(j, FAR) + DELETE == here:
            return "D"
        if j and table[i].get(j - 1, FAR) + INSERT == here:
            return "I"
        return "K" if rows[i].initial == _wanted(j) else "R"

    def trace(i: int, j: int) -> str:
        out = []
        while i < n or j:
            step = edit(i, j)
            out.append(step)
            i += step != "I"
            j -= step != "D"
        return "".join(out)

    # All targets: empty, pairs, and a system turn before pairs. Turns before the system turn can only be deleted.
    costs = {("", 0): DELETE * n}
    costs |= {("", j): c for j, c in table[0].items() if j and j % 2 == 0}
    heads = [i for i, row in enumerate(rows) if row.initial == "s" and not row.bad]
    for i in heads:
        for j, c in table[i + 1].items():
            if j and j % 2 == 0:
                cost = DELETE * i + rows[i].cut + c
                costs["s", j] = min(costs.get(("s", j), FAR), cost)
    best = min(costs.values())

    audits = []
    for (head, j), cost in costs.items():
        if cost != best:
            continue
        if not head:
            audits.append("D" * n if not j else trace(0, j))
            continue
        # The last place is the least audit: it deletes longest before it keeps.
        at = max(i for i in heads if DELETE * i + rows[i].cut + table[i + 1].get(j, FAR) == best)
        audits.append("D" * at + "K" + trace(at + 1, j))
    return best, min(audits)


NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
AT_END = [0, 2 * INSERT, INSERT, 0]


def steps_back(rows: Sequence[Row], end: Sequence[int]) -> list[list[int]]:
    """Costs to go before each turn from each place in the grammar (0 start, 1 after s, 2 after u, 3 after a).

    ``end`` has the costs after the last turn.
    """
    out = [list(end)]
    for row in reversed(rows):
        after = out[-1]
        now = []
        for phase in range(4):
            cost = DELETE + after[phase]
            if not row.bad:
                want = "a" if phase == 2 else "u"
                cost = min(cost, row.cut + after[NEXT[phase]] + (0 if row.initial == want else REROLE))
                if phase == 0 and row.initial == "s":
                    cost = min(cost, row.cut + after[1])
            now.append(cost)
        two, three = now[2], now[3]
        now[2], now[3] = min(two, INSERT + three), min(three, INSERT + two)
        now[0], now[1] = min(now[0], INSERT + now[2]), min(now[1], INSERT + now[2])
        out.append(now)
    return out[::-1]


def walked(rows: Sequence[Row], costs: list[list[int]], phase: int) -> tuple[str, int]:
    """The least audit from ``phase`` on among the cheapest ones, and the place in the grammar after the last turn."""
    out, i = [], 0
    while i < len(rows):
        row, here = rows[i], costs[i][phase]
        if costs[i + 1][phase] + DELETE == here:
            out.append("D")
            i += 1
            continue
        if costs[i][NEXT[phase]] + INSERT == here:
            out.append("I")
            phase = NEXT[phase]
            continue
        if phase == 0 and row.initial == "s" and not row.bad and row.cut + costs[i + 1][1] == here:
            out.append("K")
            phase = 1
        else:
            fits = row.initial == ("a" if phase == 2 else "u")
            out.append("K" if fits else "R")
            phase = NEXT[phase]
        i += 1
    return "".join(out), phase


def rebuilt(audit: str, roles: Sequence[str], texts: Sequence, phase: int = 0) -> Iterator[tuple[str, object]]:
    """The repaired turns that an audit stands for: role, and the turn's own entry of ``texts``; None for inserted ones."""
    i = 0
    for step in audit:
        want = "a" if phase == 2 else "u"
        if step == "I":
            yield ROLES[want], None
            phase = NEXT[phase]
            continue
        if step == "K":
            phase = 1 if phase == 0 and roles[i][:1] == "s" else NEXT[phase]
            yield roles[i], texts[i]
        elif step == "R":
            yield ROLES[want], texts[i]
            phase = NEXT[phase]
        i += 1


def _faults(blank: Sequence[bool], cut: Sequence[bool], again: Sequence[bool], initials: Sequence[str]) -> tuple[list[Row], tuple[int, int, int]]:
    """Rows for the alignment, and how many are blank, repeated and truncated by their first fault."""
    rows, counts = [], [0, 0, 0]
    for b, c, a, initial in zip(blank, cut, again, initials):
        kind = 0 if b else 1 if a else 2 if c else None
        if kind is not None:
            counts[kind] += 1
        rows.append(Row(initial, kind in (0, 1), TRUNCATED if kind == 2 else 0))
    return rows, tuple(counts)


LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _illegal(initials: Sequence[str]) -> int:
    return sum(pair not in LEGAL for pair in zip(initials, initials[1:]))


def _conversation(table: pa.Table) -> pa.Table:
    """One whole conversation: its counts, its audit and its repaired turns, in a single row."""
    conv = table.column("conv_id")[0].as_py()
    held = [r for r in table.drop_columns(["conv_id"]).to_pylist() if r["copy"] is not None]
    held.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"], r["head"], r["same"]))
    seen: set[str] = set()
    again = []
    for r in held:
        again.append(r["same"] in seen)
        seen.add(r["same"])
    initials = [r["initial"] for r in held]
    rows, (blank, duplicate, truncated) = _faults([r["blank"] for r in held], [r["cut"] for r in held], again, initials)
    cost, audit = aligned(rows)
    turns = {r["turn"] for r in held} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    built = [{"role": r, "text": t or ""} for r, t in rebuilt(audit, [r["role"] for r in held], [r["text"] for r in held])]
    values = [conv, gaps, blank, duplicate, truncated, _illegal(initials), cost, audit, built]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "turns"]
    return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


class Repair(NamedTuple):
    """``short``: a row per conversation of up to ``limit`` turns, with its repaired ``turns``.

    ``long`` and ``long_turns``: the same for longer ones, the turns as rows (conv_id, place, role, text); None if there are
    no longer ones.
    """

    short: DataFrame
    long: DataFrame | None
    long_turns: DataFrame | None


def repair(turns: DataFrame, limit: int = LIMIT, limit_bytes: int = LIMIT_BYTES, slice_rows: int = SLICE) -> Repair:
    """Repairs of conversations, from turns (conv_id, turn, role, text, copy); other columns are left out.

    Turns are taken by number, nulls first, then by role, the first ``HEAD`` characters of the text, and the hash of role and
    text, so equal numbers have a defined order. ``limit`` turns or ``limit_bytes`` of text are the most that one task
    aligns as a whole; both ways give the same results. ``slice_rows`` is a power of two. Rows with a null ``copy`` only say that the conversation exists. Null role or text is one space. A null conv_id is a conversation
    of its own. A turn whose role is empty fits no place and cannot be kept. An empty table gives no rows.
    """
    rows = staged(marked(turns), "turns")
    sizes = rows.groupBy("conv_id").agg(F.count("copy").alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes"))
    over = (F.col("n") > limit) | (F.col("bytes") > limit_bytes)
    large = staged(sizes.where(over).select(F.col("conv_id").alias("large_id")), "large")
    same = F.col("conv_id").eqNullSafe(F.col("large_id"))
    if large.isEmpty():
        return Repair(rows.groupBy("conv_id").applyInArrow(_conversation, REPAIRED), None, None)
    short = rows.join(large, same, "left_anti").groupBy("conv_id").applyInArrow(_conversation, REPAIRED)
    return Repair(short, *_long(rows.join(large, same, "left_semi"), slice_rows))


def _rows_of(table: pa.Table) -> list[Row]:
    columns = [table.column(c).to_pylist() for c in ("blank", "cut", "again", "initial")]
    return _faults(*columns)[0]


def _long(rows: DataFrame, slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """Audits and turns of long conversations. No task holds more than a slice of turns, or a small row for each slice.

    Turns are ordered in ranges; ``at`` keeps their order and cuts them into slices. Each slice is reduced to the costs from
    every place in the grammar to every other one (16 numbers). These are joined from the back, which gives each
    slice the costs behind it; each slice then finds its way from every place, and the ways are joined from the front.
    """
    held = rows.where(F.col("copy").isNotNull()).withColumn("row", F.monotonically_increasing_id())
    placed = ordered(held, ["conv_id", "turn", "role", "head", "same", "row"])
    firsts = placed.groupBy("conv_id", "same").agg(F.min("at").alias("first_at"))
    first = firsts.select("first_at")
    with_cut = placed.join(first, F.col("at") == F.col("first_at"), "left").select(
        "conv_id", "turn", "role", "text", "initial", "blank", "cut", F.col("first_at").isNull().alias("again"), "at",
        F.expr(f"at div {slice_rows}").alias("slice"),
    )
    placed = staged(with_cut, "slices")
    light = placed.drop("text", "turn")

    def costs(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        found = _rows_of(table)
        between = [steps_back(found, [0 if q == end else FAR for q in range(4)])[0] for end in range(4)]
        flat = [min(between[end][begin], FAR) for begin in range(4) for end in range(4)]
        initials = table.column("initial").to_pylist()
        blank, cut, again = (table.column(c).to_pylist() for c in ("blank", "cut", "again"))
        counts = _faults(blank, cut, again, initials)[1]
        values = [table.column("conv_id")[0].as_py(), table.column("slice")[0].as_py(), flat, *counts, _illegal(initials), initials[0], initials[-1]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string()]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=SLICE_NAMES)

    slices = staged(light.groupBy("conv_id", "slice").applyInArrow(costs, SLICE_KIND), "costs")

    def behind(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice")
        after, ends = list(AT_END), []
        for flat in reversed(table.column("between").to_pylist()):
            ends.append(after)
            after = [min(flat[4 * p + q] + after[q] for q in range(4)) for p in range(4)]
        out = table.select(["conv_id", "slice"]).append_column("behind", pa.array(ends[::-1], pa.list_(pa.int64())))
        return out.append_column("cost", pa.array([after[0]] * table.num_rows, pa.int64()))

    ends = slices.groupBy("conv_id").applyInArrow(behind, "conv_id bigint, slice bigint, behind array<bigint>, cost bigint")
    ends = staged(ends, "behind")

    def ways(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("at")
        found, end = _rows_of(left), right.column("behind")[0].as_py()
        back = steps_back(found, end)
        walks = [walked(found, back, phase) if back[0][phase] < FAR else ("", phase) for phase in range(4)]
        values = [left.column("conv_id")[0].as_py(), left.column("slice")[0].as_py(), [w[0] for w in walks], [w[1] for w in walks]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["conv_id", "slice", "walks", "exits"])

    keys = ["conv_id", "slice"]
    ways_kind = "conv_id bigint, slice bigint, walks array<string>, exits array<bigint>"
    walks = staged(light.groupBy(*keys).cogroup(ends.groupBy(*keys)).applyInArrow(ways, ways_kind), "ways")

    def entries(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice")
        phase, begin = 0, []
        exits = table.column("exits").to_pylist()
        for row in exits:
            begin.append(phase)
            phase = row[phase]
        tail = [""] * (len(exits) - 1) + ["I" * (AT_END[phase] // INSERT)]
        out = table.select(keys).append_column("phase", pa.array(begin, pa.int64()))
        return out.append_column("tail", pa.array(tail, pa.string()))

    begins = walks.select(*keys, "exits").groupBy("conv_id").applyInArrow(entries, "conv_id bigint, slice bigint, phase bigint, tail string")
    on = [F.col("conv_id").eqNullSafe(F.col("own_id")), F.col("slice") == F.col("own_slice")]
    chosen = walks.join(begins.select(F.col("conv_id").alias("own_id"), F.col("slice").alias("own_slice"), "phase", "tail"), on)
    chosen = staged(chosen.select(*keys, "phase", F.concat(F.col("walks")[F.col("phase").cast("int")], "tail").alias("audit")), "audits")

    last = F.expr("lag(last_initial) over (partition by conv_id order by slice)")
    pair = F.concat(last, "first_initial")
    seams = slices.withColumn("seam", F.when(last.isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0))
    counts = seams.groupBy("conv_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.sum("seam")).cast("bigint").alias("illegal"),
    )
    days = placed.groupBy("conv_id").agg(F.min("turn").alias("low"), F.max("turn").alias("high"))
    kinds = placed.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("turn").alias("kinds"))
    gaps = _met(days, kinds).select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("kinds"), F.lit(0)).cast("bigint").alias("gaps"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slice", "audit"))), lambda s: s["audit"]), "")
    audits = chosen.groupBy("conv_id").agg(text.alias("audit"))
    cost = ends.groupBy("conv_id").agg(F.max("cost").alias("cost"))
    stats = _met(_met(_met(gaps, counts), cost), audits)
    out = stats.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("at")
        audit, phase, number = right.column("audit")[0].as_py(), right.column("phase")[0].as_py(), left.column("slice")[0].as_py()
        built = [*rebuilt(audit, left.column("role").to_pylist(), left.column("at").to_pylist(), phase)]
        conv, count = left.column("conv_id")[0].as_py(), len(built)
        columns = [[conv] * count, [number] * count, [*range(count)], [r for r, _ in built], [a for _, a in built]]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=["conv_id", "slice", "place", "role", "from_at"])

    turn_kind = "conv_id bigint, slice bigint, place bigint, role string, from_at bigint"
    edited = light.groupBy(*keys).cogroup(chosen.groupBy(*keys)).applyInArrow(build, turn_kind)
    texts = placed.select("at", "text")
    built = edited.join(texts, F.col("from_at") == F.col("at"), "left").select(
        "conv_id", "slice", "place", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    return out, built


SLICE_NAMES = ["conv_id", "slice", "between", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial"]
SLICE_KIND = (
    "conv_id bigint, slice bigint, between array<bigint>, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, first_initial string, last_initial string"
)


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two frames of one row per conversation side by side; a null id meets a null id."""
    right = right.withColumnRenamed("conv_id", "met_id")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("met_id"))).drop("met_id")


def turn_text() -> Column:
    return F.concat("role", F.lit(":"), "text")


def _streamed_digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, from rows in order; one conversation's state is held at a time."""
    now, state, none = None, None, True
    kinds = [pa.int64(), pa.string()]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], kinds[0]), pa.array([state.hexdigest()], kinds[1])], names=["conv_id", "repaired_sha256"])

    for part in parts:
        for conv, line in zip(part.column("conv_id").to_pylist(), part.column("line").to_pylist()):
            if none or conv != now:
                if not none:
                    yield row()
                now, state, none = conv, hashlib.sha256(line.encode()), False
            else:
                state.update(b"\n" + line.encode())
    if not none:
        yield row()


def digests(found: Repair) -> DataFrame:
    """Every conversation's counts and audit, and the SHA-256 of its repaired turns, ``role:text`` a line.

    A hash has to see its lines in order, so the turns of one long conversation stream through one task; nothing of them
    is kept there but the hash.
    """
    stats = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    short = found.short.select(*stats, F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"))
    if found.long is None:
        return short
    rows = found.long_turns.select("conv_id", "slice", "place", turn_text().alias("line"))
    streams = rows.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "place").select("conv_id", "line")
    hashes = streams.mapInArrow(_streamed_digests, "conv_id bigint, repaired_sha256 string")
    joined = found.long.join(hashes.withColumnRenamed("conv_id", "met_id"), F.col("conv_id").eqNullSafe(F.col("met_id")), "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return short.unionByName(joined.select(*stats, F.coalesce("repaired_sha256", empty).alias("repaired_sha256")))
