"""Conversation structure repair by Wagner-Fischer alignment to an alternating target.

A conversation's role initials should be ``(s?(ua)+)?``. Its turns are aligned to the targets of every feasible length:
keeping a turn costs 0, giving it another role (user or assistant) 2, deleting it 3, inserting an empty turn (user or
assistant) 2; blank and repeated turns have to be deleted, and a truncated one that stays adds 1. Of the cheapest
alignments the one whose audit (initials of its edits in order: D, I, K, R) is least in ASCII is taken.

* The targets that end alike are ends of one alternating string, so one table of remaining turns by remaining length
  serves every length (``align``). Only Ukkonen's band is filled: a cell that lies d deletions or i insertions off the
  diagonal costs 3 d or 2 i more, so cells beyond the incumbent cost are left out; the incumbent is a greedy repair, and
  doubled where it did not cover every pair of states. Audits of the cheapest lengths are traced back and compared.
* A conversation may be of any length: its turns are put in order by a range sort and cut into blocks of ``BLOCK`` turns
  at most. A block is aligned from each state of the grammar (nothing yet, after s, u, a) to each; insertions belong to
  the turn behind them, so no audit of a block begins another one, and blocks are joined by their costs and the order of
  their audits alone: backwards for the cost to the end, forwards for the states. A short conversation is one block, or two.
* Two turns are repeated if role and text are equal; texts are compared by SHA-256.

Cases: a null role or text is one space (as in the damage below); a null turn comes first; a null id is a conversation of
its own; equal turns are taken by role, by the first 256 characters of the text, then by a hash of it; repeated rows are
repeated turns; an empty table gives no rows; other columns are ignored; texts of any length are hashed as they stream by.
A digest reads a conversation's texts in order in one task, because SHA-256 does; ``repaired`` needs no such task.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import shuffle_partitions, tidied, with_checkpoint_dir

#: Turns of a block at most: a power of two.
BLOCK = 2048
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: A turn as a sign: role initial (o: any other), a capital if truncated; blank; repeated.
BLANK, REPEATED = "-", "="
_NO = 1 << 29
#: States: nothing yet, after s, after u, after a. Edits that end a conversation in each state, and their cost.
_END = ("", "II", "I", "")
_END_COST = (0, 2 * INSERT, INSERT, 0)
_SPACES = r"\x20\x09-\x0D"


def align(pattern: str, end: str, limit: int) -> np.ndarray:
    """Cost of aligning the turns from ``i`` on to the last ``r`` signs of the alternating string that ends in ``end``,
    for every i and r within ``limit``; what costs more may be ``_NO`` or too high. Nothing is inserted behind a turn."""
    n = len(pattern)
    width = n + limit // INSERT + 1
    cost = np.full((n + 1, width), _NO, np.int32)
    cost[n, 0] = 0
    odd = end
    even = "a" if end == "u" else "u"
    r = np.arange(width, dtype=np.int32)
    for i in range(n - 1, -1, -1):
        left = n - i
        a, b = max(0, left - limit // DELETE), min(width, left + limit // INSERT + 1)
        after = cost[i + 1]
        row = after[a:b] + DELETE
        sign = pattern[i]
        if sign not in (BLANK, REPEATED):
            stay = TRUNCATED if sign.isupper() else 0
            by = [stay + (0 if sign.lower() == c else REROLE) for c in (even, odd)]
            first = max(a, 1)
            np.minimum(row[first - a :], after[first - 1 : b - 1] + np.where(r[first:b] & 1, np.int32(by[1]), np.int32(by[0])), out=row[first - a :])
        cost[i, a:b] = np.minimum(np.minimum.accumulate(row - INSERT * r[a:b]) + INSERT * r[a:b], _NO)
    return cost


def trace(pattern: str, cost: np.ndarray, end: str, r: int, i: int = 0) -> str:
    """The least audit of the cheapest alignment of the turns from ``i`` on to the last ``r`` signs."""
    out = []
    n = len(pattern)
    while i < n or r:
        now = cost[i, r]
        if i < n and now == cost[i + 1, r] + DELETE:
            out.append("D")
            i += 1
            continue
        if r and now == cost[i, r - 1] + INSERT:
            out.append("I")
            r -= 1
            continue
        sign, target = pattern[i], end if r & 1 else ("a" if end == "u" else "u")
        out.append("K" if sign.lower() == target else "R")
        i, r = i + 1, r - 1
    return "".join(out)


def _greedy(pattern: str) -> int:
    """Cost of one repair: turns that may stay keep or get the role that is due."""
    cost, due = 0, "u"
    for sign in pattern:
        if sign in (BLANK, REPEATED):
            cost += DELETE
        else:
            cost += (TRUNCATED if sign.isupper() else 0) + (0 if sign.lower() == due else REROLE)
            due = "a" if due == "u" else "u"
    return cost + INSERT


def _solve(pattern: str) -> dict[tuple[int, int], tuple[int, str]]:
    n = len(pattern)
    out = {(q, q): (DELETE * n, "D" * n) for q in range(4)}
    usable = [i for i, sign in enumerate(pattern) if sign not in (BLANK, REPEATED)]
    system = [i for i in usable if pattern[i] in "sS"]
    stay = {i: TRUNCATED if pattern[i] == "S" else 0 for i in system}
    if system:
        cost = DELETE * (n - 1) + min(stay.values())
        out[0, 1] = cost, min("D" * i + "K" + "D" * (n - 1 - i) for i in system if DELETE * (n - 1) + stay[i] == cost)
    if not usable:
        return out
    limit = min(_greedy(pattern) + 2 * INSERT, DELETE * n + 2 * INSERT)
    while True:
        tables = {end: align(pattern, end, limit) for end in "ua"}
        found = dict(out)
        for q in range(4):
            for end, q2 in (("u", 2), ("a", 3)):
                table = tables[end]
                whole = table[0]
                first = 1 if (q == 2) == (end == "a") else 2  # the shortest target from a state to another, and every second
                lengths = np.arange(first, len(whole), 2)
                ways = [(int(whole[r]), -1, int(r)) for r in lengths[whole[lengths] == whole[lengths].min(initial=_NO)].tolist()]
                if q == 0:  # s first: what stands before it goes, and an s that comes later is less in ASCII
                    for r in range(1 if end == "u" else 2, len(whole), 2):
                        ways += [(DELETE * i + stay[i] + int(table[i + 1, r]), i, r) for i in system]
                best = min([c for c, _, _ in ways], default=_NO)
                if (q, q2) in out and out[q, q2][0] < best:
                    continue
                audits = [trace(pattern, table, end, r) if i < 0 else "D" * i + "K" + trace(pattern, table, end, r, i + 1) for c, i, r in ways if c == best < _NO]
                if (q, q2) in out and out[q, q2][0] == best:
                    audits.append(out[q, q2][1])
                if audits:
                    found[q, q2] = best, min(audits)
        if limit >= DELETE * n + 2 * INSERT or all(found.get((q, q2), (_NO, ""))[0] <= limit for q in range(4) for q2 in (2, 3)):
            return found
        limit = min(2 * limit, DELETE * n + 2 * INSERT)


_remembered = lru_cache(1 << 14)(_solve)


def solve(pattern: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Least cost and audit of a block from state to state, where there is one. Short patterns are remembered."""
    return _remembered(pattern) if len(pattern) <= 32 else _solve(pattern)


def _placed(turns: DataFrame) -> DataFrame:
    """conv, at (place in the order of all turns), turn, role, text, sign without repeats, digest of the text; written."""
    spark = turns.sparkSession
    where = f"{with_checkpoint_dir(spark).rstrip('/')}/repair-{uuid.uuid4().hex}"
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 256), F.xxhash64("text"), F.col("salt")]
    salted = turns.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))  # equal rows need not meet
    placed = salted.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).drop("salt")
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise(F.lit("o"))
    ended = F.col("text").rlike(rf"[.!?][{_SPACES}]*+\z")
    sign = F.when(~F.col("text").rlike(rf"[^{_SPACES}]"), F.lit(BLANK)).when(ended, initial).otherwise(F.upper(initial))
    placed.withColumns({"at": F.monotonically_increasing_id(), "sign": sign, "digest": F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))}).write.parquet(where)
    return spark.read.parquet(where)


def _block(at: Column, size: int) -> Column:
    return F.shiftright(at, size.bit_length() - 1)


def _patterns(placed: DataFrame, size: int) -> DataFrame:
    """conv, block, pattern: the signs of each block's turns."""
    light = placed.select("conv", "at", "role", "digest", "sign")
    seen = light.where(F.col("sign") != BLANK).groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    first = seen.where("n > 1").select(F.col("conv").alias("its_conv"), F.col("role").alias("its_role"), F.col("digest").alias("its_digest"), "first")
    same = F.col("conv").eqNullSafe(F.col("its_conv")) & (F.col("role") == F.col("its_role")) & (F.col("digest") == F.col("its_digest"))
    repeated = (F.col("sign") != BLANK) & (F.col("at") > F.col("first"))
    signs = light.join(first, same, "left").select("conv", "at", F.when(repeated, F.lit(REPEATED)).otherwise(F.col("sign")).alias("sign"))
    held = signs.groupBy("conv", _block(F.col("at"), size).alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "sign"))).alias("signs"))
    return held.select("conv", "block", F.array_join(F.transform("signs", lambda s: s.sign), "").alias("pattern"))


def _solved(patterns: DataFrame) -> DataFrame:
    """Adds ``costs`` and ``ranks`` (of the audits from a state, in ASCII) of the 16 pairs of states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, ranks = [], []
            for pattern in batch.column(2).to_pylist():
                ways = solve(pattern)
                cost, rank = [_NO] * 16, [0] * 16
                for (q, q2), (c, audit) in ways.items():
                    cost[4 * q + q2] = c
                    rank[4 * q + q2] = sum(other < audit for (p, _), (_, other) in ways.items() if p == q)
                costs.append(cost)
                ranks.append(rank)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.list_(pa.int32())), pa.array(ranks, pa.list_(pa.int32()))], ["conv", "block", "pattern", "costs", "ranks"])

    kind = dict(patterns.dtypes)["conv"]
    return patterns.mapInArrow(tidied(run), f"conv {kind}, block bigint, pattern string, costs array<int>, ranks array<int>")


def _by_conversation(rows: DataFrame, *order) -> DataFrame:
    return rows.repartition(shuffle_partitions(rows.sparkSession), "conv").sortWithinPartitions("conv", *order)


_NEW = object()


def _audits(solved: DataFrame) -> DataFrame:
    """conv, block, state before it, pattern, cost, audit of each block. Two passes over a row a block."""
    kind = dict(solved.dtypes)["conv"]

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = _NEW
        for batch in batches:
            nexts, lasts = [], []
            for c, costs, ranks in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                lasts.append(c != conv)
                if c != conv:
                    conv, ahead = c, _END_COST
                ways = [min((costs[4 * q + q2] + ahead[q2], ranks[4 * q + q2], q2) for q2 in range(4)) for q in range(4)]
                ahead = [min(w[0], _NO) for w in ways]
                nexts.append([w[2] for w in ways])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(nexts, pa.list_(pa.int32())), pa.array(lasts, pa.bool_())], ["conv", "block", "pattern", "nexts", "last"])

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = _NEW, 0
        for batch in batches:
            states, costs, audits = [], [], []
            for c, pattern, nexts, last in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if c != conv:
                    conv, state = c, 0
                cost, audit = solve(pattern)[state, nexts[state]]
                states.append(state)
                state = nexts[state]
                costs.append(cost + (_END_COST[state] if last else 0))
                audits.append(audit + (_END[state] if last else ""))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(states, pa.int32()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["conv", "block", "pattern", "state", "cost", "audit"])

    back = _by_conversation(solved, F.desc("block")).mapInArrow(tidied(backwards), f"conv {kind}, block bigint, pattern string, nexts array<int>, last boolean")
    return _by_conversation(back, "block").mapInArrow(tidied(forwards), f"conv {kind}, block bigint, pattern string, state int, cost bigint, audit string")


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The turns of blocks one after another with their edits: (row, edit, role, text), ``row`` being the turn's own row,
    or None for an insertion. Each block's row (kind 0) comes before its turns."""
    audit, at, state = "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, 3 if state == 2 else 2
            yield None, "I", "user" if state == 2 else "assistant", ""

    for row in rows:
        if row[2] == 0:
            yield from inserted()
            audit, at, state = row[8], 0, row[6]
            yield row, "", "", ""
            continue
        yield from inserted()
        edit, role = audit[at], row[4]
        at += 1
        if edit == "R":
            role = "assistant" if state == 2 else "user"
        if edit != "D":
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
        yield row, edit, role, row[5]
    yield from inserted()


def _with_turns(turns: DataFrame, size: int) -> DataFrame:
    """Rows of blocks (kind 0) and turns (kind 1): conv, block, kind, turn, role, text, state, pattern, audit, cost, at."""
    placed = _placed(turns)
    audits = _audits(_solved(_patterns(placed, size)))
    none = dict(placed.dtypes)["turn"]
    heads = audits.select("conv", "block", F.lit(0).alias("kind"), F.lit(None).cast(none).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "state", "pattern", "audit", "cost", F.lit(-1).cast("bigint").alias("at"))
    empty = [F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("pattern"), F.lit(None).cast("string").alias("audit"), F.lit(None).cast("bigint").alias("cost")]
    return heads.unionAll(placed.select("conv", _block(F.col("at"), size), F.lit(1), "turn", "role", "text", *empty, "at"))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(0, len(batch), 256):  # Python objects of a few texts at a time
            yield from zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True)


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    return df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))


def repaired(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", size: int = BLOCK) -> DataFrame:
    """Every turn and insertion in order: ``conv_col``, block, step (in the block), ``turn_col`` (null: inserted), edit
    (D, I, K, R), fault (blank, duplicate, truncated or null), ``role_col`` and ``text_col`` after the edit."""
    rows = _with_turns(_turns(df, conv_col, turn_col, role_col, text_col), size)
    types = dict(rows.dtypes)
    schema = f"conv {types['conv']}, block bigint, step int, turn {types['turn']}, edit string, fault string, role string, text string"
    ordered = rows.repartition(shuffle_partitions(df.sparkSession), "conv", "block").sortWithinPartitions("conv", "block", "kind", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch.schema.types[0], pa.int64(), pa.int32(), batch.schema.types[3], pa.string(), pa.string(), pa.string(), pa.string()]
                yield batch

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            names = ["conv", "block", "step", "turn", "edit", "fault", "role", "text"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        out: list[tuple] = []
        held, head, step, nth = 0, None, 0, 0
        for row, edit, role, text in _edited(_streamed(watched())):
            if row is not None and row[2] == 0:
                head, step, nth = row, 0, 0
                continue
            fault = None
            if row is not None:
                sign = head[7][nth]
                nth += 1
                fault = {BLANK: "blank", REPEATED: "duplicate"}.get(sign) or ("truncated" if sign.isupper() else None)
            out.append((head[0], head[1], step, None if row is None else row[3], edit, fault, role, text))
            step, held = step + 1, held + len(text) + 64
            if held >= 1 << 22:
                yield batch_of(out)
                out, held = [], 0
        if out:
            yield batch_of(out)

    found = ordered.mapInArrow(tidied(run), schema)
    return found.select(F.col("conv").alias(conv_col), "block", "step", F.col("turn").alias(turn_col), "edit", "fault", F.col("role").alias(role_col), F.col("text").alias(text_col))


def repair_report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", size: int = BLOCK) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = _with_turns(_turns(df, conv_col, turn_col, role_col, text_col), size)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind[:] = [batch.schema.types[0]]
                yield batch

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [*kind, *[pa.int64()] * 6, pa.string(), pa.string()], strict=True)], ["conv", *numbers, "audit", "repaired_sha256"])

        out: list[tuple] = []
        now = None
        for row, edit, role, text in _edited(_streamed(watched())):
            if row is not None and row[2] == 0:
                if now is None or now["conv"] != row[0]:
                    if now is not None:
                        out.append(_closed(now))
                        if len(out) >= 4096:
                            yield batch_of(out)
                            out = []
                    now = {"conv": row[0], "n": {}, "turns": 0, "low": None, "high": None, "illegal": 0, "before": None, "cost": 0, "audit": [], "sha": hashlib.sha256(), "some": False}
                for sign in set(row[7]):
                    now["n"][sign] = now["n"].get(sign, 0) + row[7].count(sign)
                now["cost"] += row[9]
                now["audit"].append(row[8])
                continue
            if row is not None:
                if row[3] is not None and row[3] != now["high"]:
                    now["low"], now["high"], now["turns"] = row[3] if now["low"] is None else now["low"], row[3], now["turns"] + 1
                pair, now["before"] = (now["before"], row[4][:1]), row[4][:1]
                now["illegal"] += pair[0] is not None and pair not in (("s", "u"), ("u", "a"), ("a", "u"))
            if edit != "D":
                now["sha"].update(f"{chr(10) if now['some'] else ''}{role}:".encode())
                now["sha"].update(text.encode("utf-8", "surrogatepass"))
                now["some"] = True
        if now is not None:
            out.append(_closed(now))
        if out:
            yield batch_of(out)

    kind = dict(rows.dtypes)["conv"]
    found = _by_conversation(rows, "block", "kind", "at").mapInArrow(tidied(run), f"conv {kind}, " + ", ".join(f"{c} bigint" for c in numbers) + ", audit string, repaired_sha256 string")
    return found.withColumnRenamed("conv", conv_col)


def _closed(now: dict) -> tuple:
    gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
    truncated = sum(n for sign, n in now["n"].items() if sign.isupper())
    return now["conv"], gaps, now["n"].get(BLANK, 0), now["n"].get(REPEATED, 0), truncated, now["illegal"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest()


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults: crc32 of ``conv_id:turn`` modulo 20 drops a turn (0), empties its
    text (1), takes its ``[.!?]`` away (2), repeats it (3) or makes it the user's (4). Nulls are one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = df.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), times)))
    return rows.drop("col")


def repair_digest(df: DataFrame, size: int = BLOCK) -> DataFrame:
    """The report on ``damaged`` rows for every conversation of ``df``; one that lost all its turns has zeros."""
    found = repair_report(damaged(df), size=size).withColumnRenamed("conv_id", "found")
    every = df.select("conv_id").distinct()
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")
    )
