"""Repair of conversations at least cost, the least of the cheapest edit strings taken.

Every row of a conversation is kept (K), given the other role (R) or deleted (D), and turns
without text may be inserted (I), so that role initials become an optional s followed by one
or more pairs ua, or nothing. Reading rows, the roles given so far are in one of four states: nothing
yet, only s, after u, after a. A node is a row's place and a state, an arc an edit.

**Cost**: edits of one row are a matrix over states, and matrices over (min, +) multiply. So rows are
sorted once, cut into blocks of bounded size, and products inside a block give a matrix for
each conversation's segment in it. Only conversations that cross blocks meet again, as one
matrix per segment, from which the cost behind each segment follows.

**Path**: arcs that keep the cost are optimal. Nodes are ranked by the first 1, 2, 4, ... edits of the
least optimal path from them: the rank for twice the length is the rank of the pair of a node's rank
and that of the node its doubled pointer leads to. An audit's letters determine its path, so
a node's least path of any length ends in one node and pointers stay unique. Of a node's optimal arcs
that with the least letter and rank behind it is taken. The path is written out by
doubled pointers too, each doubling its length.

Roles and texts that are NULL count as one space. Rows are ordered by turn, NULLs first, then role
and text; rows that are equal in all of these stay as often as they are there. NULL is a conversation
of its own. Other columns are not read, an empty table gives no rows, and texts may have any length:
they are digested for comparison and meet their edits where they lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import materialize

#: Rows of a block: what a task holds of the figures of rows at a time.
BLOCK = 8192
SLOT_BITS = 33
#: The costs of edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: What separates words.
BLANKS = r"[^\x20\x09-\x0D]"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state an added or changed turn leads to, and the one a kept turn needs, by initial.
TURN = (USER, USER, ASSISTANT, USER)
NEVER = np.int64(1) << 40
LETTERS = np.frombuffer(b"DIKR", np.uint8)


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with a fifth of the rows damaged by the CRC-32 of ``conv_id:turn``.

    Of remainders by 20, 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4
    makes it the user's.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    spoken = turns.select(
        "conv_id",
        "turn",
        shown("role").alias("role"),
        shown("text").alias("text"),
        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("__kind"),
    )
    kind = F.col("__kind")
    return spoken.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")


def ordered(turns: DataFrame) -> DataFrame:
    """Rows sorted by conversation and turn, stored with ``slot``, their place in the order.

    A distributed sort: a conversation of any length is spread over as many ranges as it needs, also
    where its rows are all alike.
    """
    plain = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    digested = plain.withColumns(
        {
            "digest": F.unhex(F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)),
            "start": F.substring("text", 1, 64),
            "__at": F.monotonically_increasing_id(),
        }
    )
    order = ["conv_id", "turn", "role", "start", "text", "digest", "__at"]
    return materialize(
        digested.orderBy(*[F.col(c).asc_nulls_first() for c in order]).drop("start", "__at"), "turns", row_id="slot"
    )


def judged(rows: DataFrame) -> DataFrame:
    """Figures of every row: its fault (0 none, 1 blank, 2 duplicate, 3 truncated) and its initial.

    A row is a duplicate if it is not the first with its role and text. Firsts are found by counting,
    map-side before the shuffle, and rows meet them by their own slot, so copies of any number are spread.
    """
    group = ["conv_id", "digest"]
    counted = rows.groupBy(*group).agg(F.min("slot").alias("slot"))
    first = counted.select("slot", F.lit(True).alias("__first"))
    last = F.regexp_extract("text", r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    blank, cut = last == "", ~last.rlike("[.!?]")
    fault = F.when(F.col("__blank"), 1).when(F.col("__first").isNull(), 2).when(F.col("__cut"), 3).otherwise(0)
    looked = rows.select(
        "slot", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), blank.alias("__blank"), cut.alias("__cut")
    )
    return looked.join(first, "slot", "left").select("slot", "conv_id", "turn", "initial", fault.cast("int").alias("fault"))


def block_of(slot: Column, size: int) -> Column:
    """Blocks of consecutive rows: the sorting task and the place in it."""
    task = F.shiftright(slot, SLOT_BITS)
    place = slot.bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    return F.concat_ws("-", task, F.floor(place / size))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of stacks of matrices over (min, +)."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), NEVER)


def inserts() -> np.ndarray:
    """Costs of going from state to state by added turns alone."""
    step = np.full((4, 4), NEVER)
    step[range(4), range(4)] = 0
    for state, to in enumerate(TURN):
        step[state, to] = min(step[state, to], INSERT)
    return times(times(step, step), step)


def arcs(initial: np.ndarray, fault: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost and next state of D, I, K, R for every row and state, the first axes; I stays at the row."""
    n = initial.size
    cost, to = np.full((n, 4, 4), NEVER), np.zeros((n, 4, 4), np.int64)
    to[:] = np.array([[s, TURN[s], TURN[s], TURN[s]] for s in range(4)])
    cut = np.where(fault == 3, CUT, 0)[:, None]
    usable = ((fault == 0) | (fault == 3))[:, None]
    cost[:, :, 0] = DELETE
    cost[:, :, 1] = INSERT
    letter = np.where(initial == "u", USER, np.where(initial == "a", ASSISTANT, -1))[:, None]
    fits = usable & (letter == np.array(TURN)[None, :])
    cost[:, :, 2] = np.where(fits, KEEP + cut, NEVER)
    cost[:, :, 3] = np.where(usable, REROLE + cut, NEVER)
    system = usable[:, 0] & (initial == "s")
    cost[system, NOTHING, 2] = (KEEP + cut[:, 0])[system]
    to[system, NOTHING, 2] = SYSTEM
    return cost, to


def row_matrices(cost: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Costs from the state before a row to that behind it, added turns before it included."""
    n = cost.shape[0]
    step = np.full((n, 4, 4), NEVER)
    row, state = np.arange(n)[:, None], np.arange(4)[None, :]
    for edit in (0, 2, 3):
        at = (row, state, to[:, :, edit])
        step[at] = np.minimum(step[at], cost[:, :, edit])
    return times(np.broadcast_to(inserts(), (n, 4, 4)), step)


def to_segment_end(matrices: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For every row the product from it to the last row of its segment, by doubling."""
    product, span, n = matrices.copy(), 1, matrices.shape[0]
    while True:
        # A product covers ``span`` rows, or all up to the segment's end.
        open_ = np.flatnonzero(np.arange(n) + span <= last)
        if not open_.size:
            return product
        product[open_] = times(product[open_], product[open_ + span])
        span *= 2


def closing() -> np.ndarray:
    """Cost behind the last row by state: nothing or a pair's end, reached by added turns."""
    end = np.array([0, NEVER, NEVER, 0])
    return (inserts() + end[None, :]).min(axis=1)


class Block:
    """Consecutive rows: ``first`` and ``last`` give each row's segment, a conversation's rows in it."""

    def __init__(self, rows: pd.DataFrame):
        self.rows = rows = rows.sort_values("slot", kind="stable")
        conv = rows["conv_id"].to_numpy()
        empty = pd.isna(rows["conv_id"]).to_numpy()
        new = np.ones(len(rows), bool)
        new[1:] = (empty[1:] != empty[:-1]) | (~empty[1:] & (conv[1:] != conv[:-1]))
        self.heads = np.flatnonzero(new)
        self.ends = np.append(self.heads[1:], len(rows)) - 1
        self.number = np.cumsum(new) - 1
        self.cost, self.to = arcs(rows["initial"].to_numpy(), rows["fault"].to_numpy())
        self.matrices = row_matrices(self.cost, self.to)
        self.products = to_segment_end(self.matrices, self.ends[self.number])


def least_paths(block: Block, behind: np.ndarray, final: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """The least audit of each segment from each state, and the state it leads to.

    ``behind``: cost behind each segment by state; ``final``: whether its conversation ends there,
    so that turns may be added behind its last row.
    """
    n, segments = len(block.rows), len(block.heads)
    # Nodes: four states before each row, then four behind each segment.
    togo = np.empty((n + segments, 4), np.int64)
    togo[:n] = (block.products + behind[block.number][:, None, :]).min(axis=2)
    togo[n:] = behind
    node = np.arange((n + segments) * 4).reshape(-1, 4)
    after = np.arange(1, n + 1)
    after[block.ends] = n + np.arange(segments)
    cost, target = np.full((n + segments, 4, 4), NEVER), np.tile(node[:, :, None], (1, 1, 4))
    cost[:n] = block.cost
    for edit in (0, 2, 3):
        target[:n, :, edit] = node[after[:, None], block.to[:, :, edit]]
    target[:n, :, 1] = node[:n][:, np.array(TURN)]
    cost[n:][final, :, 1] = INSERT
    target[n:, :, 1] = node[n:][:, np.array(TURN)]
    value = togo.reshape(-1)
    best = (cost + value[target] == togo[:, :, None]).reshape(-1, 4) & (value < NEVER)[:, None]
    # Behind a conversation's end, nothing is left to do where it may end.
    target = target.reshape(-1, 4)
    stop = ~best.any(axis=1)

    every = np.arange(stop.size)

    def doubled(edit: np.ndarray) -> Iterator[np.ndarray]:
        """Where 1, 2, 4, ... edits lead, until all paths have ended."""
        jump = np.where(stop, every, target[every, edit])
        while True:
            yield jump
            if stop[jump].all():
                return
            jump = jump[jump]

    # Letters stand in ASCII order and lead to one node each, so the first is that of a least path.
    edit = best.argmax(axis=1)
    rank = np.where(stop, 0, edit + 1)
    for jump in doubled(edit):
        pair = rank * (rank.size + 1) + rank[jump]
        rank = np.unique(pair, return_inverse=True)[1] + 1
        rank[stop] = 0
    # Ranks by whole audits select the arc: its letter, then what follows it.
    after_arc = LETTERS[None, :].astype(np.int64) * (rank.size + 1) + rank[target]
    edit = np.where(best, after_arc, NEVER).argmin(axis=1)
    letter = np.where(stop, 0, LETTERS[edit])
    jumps = list(doubled(edit))

    starts = node[block.heads].reshape(-1)
    exits = jumps[-1][starts].reshape(-1, 4) % 4
    # Written out by doubled pointers: nodes of steps 0..2^k-1, then those 2^k further on.
    owner, step, place = np.arange(starts.size), np.zeros(starts.size, np.int64), starts
    live = ~stop[place]
    owner, step, place = owner[live], step[live], place[live]
    for k, jump in enumerate(jumps):
        ahead = jump[place]
        live = ~stop[ahead]
        owner = np.concatenate([owner, owner[live]])
        step = np.concatenate([step, step[live] + (1 << k)])
        place = np.concatenate([place, ahead[live]])
    by = np.lexsort((step, owner))
    text = letter[place[by]].astype(np.uint8).tobytes().decode("ascii")
    ends = np.cumsum(np.bincount(owner, minlength=starts.size))
    cuts = [text[a:b] for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
    return [cuts[i : i + 4] for i in range(0, len(cuts), 4)], exits


SEGMENT = "segment long, conv_id {conv}, matrix array<long>"
BEHIND = "segment long, conv_id {conv}, block string, behind array<long>, final boolean"
PATHS = "segment long, conv_id {conv}, audits array<string>, exits array<int>"
CHOSEN = "segment long, conv_id {conv}, block string, entry int, audit string"


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Conversations without rows are not there. ``audit`` has a letter for each edit, so it is
    as long as the conversation; the repaired text is hashed piece by piece and never held.
    """
    rows = ordered(turns)
    conv = rows.schema["conv_id"].dataType.simpleString()
    flags = judged(rows).withColumn("block", block_of(F.col("slot"), block))
    flags = materialize(flags, "flags")

    def segment(rows: pd.DataFrame) -> pd.DataFrame:
        b = Block(rows)
        heads = b.rows.iloc[b.heads]
        return pd.DataFrame(
            {
                "segment": heads["slot"].to_numpy(),
                "conv_id": heads["conv_id"].to_numpy(),
                "matrix": list(b.products[b.heads].reshape(-1, 16)),
            }
        )

    segments = materialize(
        flags.groupBy("block").applyInPandas(segment, SEGMENT.format(conv=conv)), "segments"
    )

    # One matrix a segment, so a conversation's are fewer than its rows by the size of a block.
    whole = Window.partitionBy("conv_id")
    crossing = segments.withColumn("__n", F.count(F.lit(1)).over(whole))
    end = F.array(*[F.lit(int(c)).cast("long") for c in closing()])
    where = block_of(F.col("segment"), block).alias("block")

    def backward(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("segment")
        after, behind = closing(), []
        for matrix in reversed(list(rows["matrix"])):
            behind.append(after)
            after = np.minimum((np.asarray(matrix).reshape(4, 4) + after[None, :]).min(axis=1), NEVER)
        out = rows[["segment", "conv_id", "block"]].copy()
        out["behind"] = behind[::-1]
        out["final"] = np.arange(len(rows)) == len(rows) - 1
        return out

    ddl = BEHIND.format(conv=conv)
    alone = crossing.filter("__n = 1").select("segment", "conv_id", where, end.alias("behind"), F.lit(True).alias("final"))
    several = crossing.filter("__n > 1").select("segment", "conv_id", "matrix", where)
    behind = alone.unionByName(several.groupBy("conv_id").applyInPandas(backward, ddl))

    def paths(_, rows: pd.DataFrame, behind: pd.DataFrame) -> pd.DataFrame:
        b = Block(rows)
        heads = b.rows.iloc[b.heads]
        at = behind.set_index("segment").loc[heads["slot"].to_numpy()]
        cost = np.stack([np.asarray(x, np.int64) for x in at["behind"]])
        audits, exits = least_paths(b, cost, at["final"].to_numpy(bool))
        return pd.DataFrame(
            {"segment": heads["slot"].to_numpy(), "conv_id": heads["conv_id"].to_numpy(), "audits": audits, "exits": list(exits.astype(np.int32))}
        )

    walked = materialize(
        flags.groupBy("block").cogroup(behind.groupBy("block")).applyInPandas(paths, PATHS.format(conv=conv)), "paths"
    )

    def forward(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("segment")
        state, entries = NOTHING, []
        for exits in rows["exits"]:
            entries.append(state)
            state = int(exits[state])
        out = rows[["segment", "conv_id", "block"]].copy()
        out["entry"] = entries
        out["audit"] = [a[e] for a, e in zip(rows["audits"], entries, strict=True)]
        return out

    crossing = walked.withColumn("__n", F.count(F.lit(1)).over(whole))
    first = crossing.filter("__n = 1").select(
        "segment", "conv_id", where, F.lit(NOTHING).alias("entry"), F.col("audits")[0].alias("audit")
    )
    rest = crossing.filter("__n > 1").select("segment", "conv_id", "audits", "exits", where)
    chosen = materialize(
        first.unionByName(rest.groupBy("conv_id").applyInPandas(forward, CHOSEN.format(conv=conv))), "chosen"
    )
    counts = _counts(flags).withColumnRenamed("conv_id", "__conv")
    made = _repaired(rows, chosen, block, conv).withColumnRenamed("conv_id", "__own")
    same = F.col("__own").eqNullSafe(F.col("__conv"))
    return counts.join(made, same).select(
        F.col("__conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def _counts(flags: DataFrame) -> DataFrame:
    """Gaps and faults of each conversation. A row's next one is taken inside its block, and
    the last row of a block meets the first of the next by their conversation."""
    inside = Window.partitionBy("block").orderBy("slot")
    near = flags.withColumns(
        {
            "__conv": F.lag("conv_id").over(inside),
            "__before": F.lag("initial").over(inside),
            "__seen": F.lag("slot").over(inside),
            "__next": F.lead("slot").over(inside),
        }
    )

    def bad(pair: Column) -> Column:
        return ~pair.isin("su", "ua", "au")

    pair = F.concat("__before", "initial")
    same = F.col("__seen").isNotNull() & F.col("conv_id").eqNullSafe(F.col("__conv"))
    per_row = near.select(
        "conv_id", "turn", "fault", (same & bad(pair)).cast("long").alias("illegal")
    )
    # Rows at the edges of blocks, two a block: a conversation's follow one another there.
    edges = near.filter("__seen IS NULL OR __next IS NULL").select("conv_id", "slot", "initial", F.col("__seen").isNull().alias("__head"))
    order = Window.partitionBy("conv_id").orderBy("slot")
    crossing = edges.withColumns({"__b": F.lag("initial").over(order), "__s": F.lag("slot").over(order)}).filter("__head")
    crossed = crossing.filter(F.col("__s").isNotNull() & bad(F.concat("__b", "initial"))).select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(-1).alias("fault"), F.lit(1).cast("long").alias("illegal")
    )
    turn = F.col("turn").cast("long")
    turns = per_row.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps")
    )
    faults = per_row.unionByName(crossed).groupBy("conv_id").agg(
        *[F.count_if(F.col("fault") == i).alias(n) for i, n in enumerate(("blank", "duplicate", "truncated"), 1)],
        F.sum("illegal").alias("illegal"),
    )
    turns = turns.withColumnRenamed("conv_id", "__c")
    return faults.join(turns, F.col("conv_id").eqNullSafe(F.col("__c"))).drop("__c")


def _repaired(rows: DataFrame, chosen: DataFrame, block: int, conv: str) -> DataFrame:
    """Edits applied to texts, segment by segment, then hashed in order per conversation."""
    texts = rows.select("slot", "conv_id", "role", "text", block_of(F.col("slot"), block).alias("block"))
    parts = "segment long, conv_id " + conv + ", audit string, lines binary, cost long"

    def apply(_, rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        starts = np.searchsorted(rows["slot"].to_numpy(), np.sort(chosen["segment"].to_numpy()))
        ends = np.append(starts[1:], len(rows))
        role, text = rows["role"].tolist(), rows["text"].tolist()
        out = []
        for (i, a, b) in zip(np.argsort(chosen["segment"].to_numpy()), starts, ends, strict=True):
            segment = chosen.iloc[i]
            lines, cost = edited(segment["audit"], segment["entry"], role[a:b], text[a:b])
            out.append((segment["segment"], segment["conv_id"], segment["audit"], lines, cost))
        return pd.DataFrame(out, columns=["segment", "conv_id", "audit", "lines", "cost"])

    made = texts.groupBy("block").cogroup(chosen.groupBy("block")).applyInPandas(apply, parts)
    # One row a segment: hashed in order by a task that holds one of them at a time.
    dealt = made.repartition(F.xxhash64("conv_id")).sortWithinPartitions(F.xxhash64("conv_id"), "conv_id", "segment")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "audit", "cost", "repaired_sha256"]
        now, seen = None, False
        state = None

        def result() -> pa.RecordBatch:
            value, audit, cost, sha = state
            return pa.RecordBatch.from_arrays(
                [value, pa.array(["".join(audit)]), pa.array([cost], pa.int64()), pa.array([sha.hexdigest()])], names=names
            )

        for batch in batches:
            ids = batch.column("conv_id")
            for i, (audit, lines, cost) in enumerate(
                zip(*[batch.column(c).to_pylist() for c in ("audit", "lines", "cost")], strict=True)
            ):
                value = ids[i].as_py()
                if not seen or value != now:
                    if seen:
                        yield result()
                    now, seen = value, True
                    state = [ids.slice(i, 1), [], 0, hashlib.sha256()]
                    empty = True
                if lines is not None:
                    state[3].update(lines if empty else b"\n" + lines)
                    empty = False
                state[1].append(audit)
                state[2] += cost
        if seen:
            yield result()

    return dealt.select("conv_id", "audit", "lines", "cost").mapInArrow(
        digest, "conv_id " + conv + ", audit string, cost long, repaired_sha256 string"
    )


NAMES = {USER: "user", ASSISTANT: "assistant"}


def edited(audit: str, entry: int, roles: list[str], texts: list[str]) -> tuple[bytes | None, int]:
    """A segment's lines after its edits, None if there are none, and what the edits cost."""
    at, state, lines, cost = 0, entry, [], 0
    for letter in audit:
        if letter == "D":
            at, cost = at + 1, cost + DELETE
            continue
        keeps_system = letter == "K" and state == NOTHING and roles[at][:1] == "s"
        state = SYSTEM if keeps_system else TURN[state]
        if letter == "I":
            lines.append(f"{NAMES[state]}:")
            cost += INSERT
            continue
        lines.append(f"{roles[at] if letter == 'K' else NAMES[state]}:{texts[at]}")
        ended = texts[at].rstrip(" \t\n\x0b\x0c\r")[-1:] in (".", "!", "?")
        cost += (KEEP if letter == "K" else REROLE) + (0 if ended else CUT)
        at += 1
    return ("\n".join(lines).encode("utf-8", "surrogatepass") if lines else None), cost


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Conversations after damage and repair, those that lost all their rows included."""
    every = turns.select(F.col("conv_id").alias("__id")).distinct()
    made = repair(damage(turns))
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.join(made, F.col("__id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("__id").alias("conv_id"),
        *zero.values(),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
