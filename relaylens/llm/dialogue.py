"""Conversation structure repair by a dynamic program that streams over secondary-sorted turns.

Conversations are dealt to tasks as a whole and sorted by turn. A first stream goes over each conversation from its end
and carries the least costs from each of four states of the role grammar `(s?(ua)+)?` from one Arrow batch to the next.
Of a turn it leaves one byte: the best edit from each state. These backpointers are spilled to a table of the shared
folder in chunks, so that a giant conversation needs no memory and a lost executor no repetition. A second stream goes
forward over the texts, with each chunk sorted before its first turn, and follows the backpointers.

Turns are ordered by turn (nulls first), then role, then the text's SHA-256. Null roles and texts count as one space.
Rows without conv_id are one conversation. Rows that are in the table twice are two turns, the second a duplicate.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, table, written

#: Costs of keeping, giving another role, deleting, inserting, and of a truncated turn that stays.
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5
EDITS = "DIKR"  # in ASCII order, so that the first cheapest one is the least
FAULTS = ("", "blank", "duplicate", "truncated")
#: Turns of a conversation whose backpointers, a byte each, stay in memory before they are spilled.
CHUNK = 1 << 18

_SPACE = r"\x20\x09-\x0D"
#: States: nothing yet, after a system turn, after user, after assistant; and what an inserted or re-roled turn leads to.
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
#: Inserts that a conversation still needs at its end.
_AT_END = (0, 2, 1, 0)
_DROPPED = -1


def best_edits(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, int]:
    """One step from the end: (costs from each state before the turn, what was taken off all of them, backpointers).

    after: costs from each state after the turn, less a constant. code: 4 * fault + initial (s, u, a, other). Backpointers
    have two bits a state: the place in EDITS of the edit that begins the least of the cheapest audits.
    """
    fault, initial = divmod(code, 4)
    more = STAYS_TRUNCATED if FAULTS[fault] == "truncated" else 0
    kept = (1 if initial == 0 else 2 if initial == 1 else None, 2 if initial == 1 else None, 3 if initial == 2 else None, 2 if initial == 1 else None)
    ways = []
    for s in range(4):
        way = {"D": DELETE + after[s]}
        if FAULTS[fault] not in ("blank", "duplicate"):
            way["R"] = REROLE + more + after[_NEXT[s]]
            if kept[s] is not None:
                way["K"] = KEEP + more + after[kept[s]]
        ways.append(way)
    best = [min(way.values()) for way in ways]
    for _ in range(3):
        best = [min(b, INSERT + best[_NEXT[s]]) for s, b in enumerate(best)]
    back = 0
    for s, way in enumerate(ways):
        way["I"] = INSERT + best[_NEXT[s]]
        back |= next(k for k, e in enumerate(EDITS) if way.get(e) == best[s]) << 2 * s
    least = min(best)
    return tuple(b - least for b in best), least, back


class _Steps(dict):
    """best_edits, remembered: costs less their least take few values, so this is the table of a small automaton."""

    def __missing__(self, key: tuple[tuple[int, ...], int]) -> tuple[tuple[int, ...], int, int]:
        self[key] = out = best_edits(*key)
        return out


def coded(rows: DataFrame) -> DataFrame:
    """conv, dated, turn, role, sha, code of each row: its fault and role's initial; rows with `gone` only name their conversation."""
    known = F.col("text").rlike(f"[^{_SPACE}]")
    whole = F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")
    initial = F.coalesce(F.array_position(F.array(F.lit("s"), F.lit("u"), F.lit("a")), F.substring("role", 1, 1)), F.lit(0))
    kept = rows.select("conv", "dated", "turn", "gone", "role", F.sha2("text", 256).alias("sha"), F.when(initial == 0, 3).otherwise(initial - 1).alias("initial"), known.alias("known"), whole.alias("whole"))
    seen = Window.partitionBy("conv", "gone", "role", "sha").orderBy("dated", "turn")
    fault = F.when(F.col("gone"), _DROPPED).when(~F.col("known"), 1).when(F.row_number().over(seen) > 1, 2).when(~F.col("whole"), 3).otherwise(0)
    kept = kept.repartition("conv").withColumn("fault", fault)
    return kept.select("conv", "dated", "turn", "role", "sha", F.when(F.col("gone"), _DROPPED).otherwise(F.col("fault") * 4 + F.col("initial")).cast("int").alias("code"))


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_CHUNKS = "conv string, dated boolean, turn long, role string, sha string, place long, back binary, counts string"
_CHUNK_NAMES = [c.split()[0] for c in _CHUNKS.split(", ")]
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _backward(frames: Iterator[pd.DataFrame], chunk: int) -> Iterator[pd.DataFrame]:
    """Chunks of backpointers of each conversation, whose rows come from its end; its counts stand in the chunk that comes last."""
    steps = _Steps()
    out: list[tuple] = []
    conv, live = None, False

    def start(name) -> None:
        nonlocal conv, live, costs, cost, back, place, at, counts, initial, low, high, times, turns
        conv, live = name, True
        costs, cost, back, place, at = tuple(INSERT * n for n in _AT_END), 0, bytearray(), 0, (False, 0, "", "")
        counts, initial, low, high, times, turns = [0, 0, 0, 0], None, None, None, 0, 0

    costs, cost, back, place, at = (), 0, bytearray(), 0, (False, 0, "", "")
    counts, initial, low, high, times, turns = [0, 0, 0, 0], None, None, None, 0, 0

    def spill(last: bool) -> None:
        nonlocal back, place
        illegal = counts[0]
        gaps = min(high - low + 1 - times, 2**63 - 1) if times else 0
        # Rows arrive from the end, so back is turned round.
        out.append((conv, *at, -place, bytes(back[::-1]), ",".join(map(str, (gaps, *counts[1:], illegal, cost + costs[0]))) if last else None))
        back, place = bytearray(), place + 1

    for frame in frames:
        for name, dated, turn, role, sha, code in zip(frame["conv"], frame["dated"], frame["turn"], frame["role"], frame["sha"], frame["code"]):
            if not live or name != conv:
                if live:
                    spill(True)
                start(name)
            if code == _DROPPED:
                continue
            if len(back) >= chunk:
                spill(False)
            costs, less, byte = steps[costs, code]
            cost += less
            back.append(byte)
            turns += 1
            at = (bool(dated), int(turn), role, sha)
            fault, now = divmod(code, 4)
            counts[fault] += fault > 0
            if turns > 1 and (now, initial) not in _LEGAL:
                counts[0] += 1
            initial = now
            if dated and turn != low:
                low, high, times = int(turn), int(turn) if high is None else high, times + 1
        if out:
            yield pd.DataFrame(out, columns=_CHUNK_NAMES)
            out = []
    if live:
        spill(True)
        yield pd.DataFrame(out, columns=_CHUNK_NAMES)


def _forward(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """("begin", conv, counts), then ("edit", edit, role, text) for each edit in order, for each conversation."""
    chunks: deque[bytes] = deque()
    conv, live, state, at = None, False, 0, 0

    def inserted(edits: Iterator[None]) -> Iterator[tuple]:
        nonlocal state
        for _ in edits:
            state = _NEXT[state]
            yield "edit", "I", _ROLE[state], ""

    for frame in frames:
        for name, role, text, back, counts in zip(*(frame[c] for c in ("conv", "role", "text", "back", "counts"))):
            if not live or name != conv:
                if live:
                    yield from inserted(range(_AT_END[state]))
                conv, live, state, at = name, True, 0, 0
                chunks.clear()
                yield "begin", name, [int(c) for c in counts.split(",")]
            if back is not None:
                if len(back):
                    chunks.append(back)
                continue
            byte = chunks[0][at]
            at += 1
            if at == len(chunks[0]):
                chunks.popleft()
                at = 0
            while EDITS[edit := byte >> 2 * state & 3] == "I":
                yield from inserted(range(1))
            if EDITS[edit] == "D":
                yield "edit", "D", role, text
                continue
            if EDITS[edit] == "R":
                state = _NEXT[state]
                role = _ROLE[state]
            else:
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            yield "edit", EDITS[edit], role, text
    if live:
        yield from inserted(range(_AT_END[state]))


def edit_stream(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Turns and chunks of backpointers, dealt by conversation and sorted so that `_forward` can follow them.

    rows: conv, dated, turn, role, text, gone as `prepared` gives them.
    """
    order = [c.desc() for c in (*map(F.col, ("dated", "turn", "role", "sha")), F.expr("code div 4 = 2"))]  # the first of equal turns is none of the duplicates
    back = written(coded(rows).sortWithinPartitions("conv", *order).mapInPandas(lambda frames: _backward(frames, chunk), _CHUNKS))
    turns = rows.where("not gone").select("conv", "dated", "turn", "role", F.sha2("text", 256).alias("sha"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("place"), "text")
    both = turns.unionByName(back.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", "dated", "turn", "role", "sha", "kind", "place").select("conv", "role", "text", "back", "counts")


def prepared(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """conv (text), dated, turn, role, text, gone from conv_id, turn, role, text; further columns are left out."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    turn = F.col("turn").cast("long")
    return rows.select(F.col("conv_id").cast("string").alias("conv"), turn.isNotNull().alias("dated"), F.coalesce(turn, F.lit(0)).cast("long").alias("turn"), one("role"), one("text"), (F.lit(False) if gone is None else gone).alias("gone"))


def repaired_turns(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, slot, edit, role, text: every edit of every conversation in order, deleted turns (edit D) with their old values.

    slot counts the turns that stay from 0; a deleted turn has that of the next one.
    """

    def tell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, conv, slot = [], None, 0
        for kind, *x in _forward(frames):
            if kind == "begin":
                conv, slot = x[0], 0
                continue
            out.append((conv, slot, *x))
            slot += x[0] != "D"
            if len(out) >= 1_000:
                yield pd.DataFrame(out, columns=["conv_id", "slot", "edit", "role", "text"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "slot", "edit", "role", "text"])

    out = bounded_batches(edit_stream(prepared(rows), chunk)).mapInPandas(tell, "conv_id string, slot long, edit string, role string, text string")
    return out.withColumn("conv_id", F.col("conv_id").cast(rows.schema["conv_id"].dataType))


def repair_summaries(prepared_rows: DataFrame, conv_type, chunk: int = CHUNK) -> DataFrame:
    """A row for each conversation: its counts, cost, audit (initials of its edits) and the digest of the repaired turns."""
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]

    def tell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, audit, digest, first = [], bytearray(), hashlib.sha256(), True
        conv, counts = None, None
        for kind, *x in _forward(frames):
            if kind == "begin":
                if counts is not None:
                    out.append((conv, *counts, audit.decode(), digest.hexdigest()))
                    if len(out) >= 1_000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
                (conv, counts), audit, digest, first = x, bytearray(), hashlib.sha256(), True
                continue
            edit, role, text = x
            audit += edit.encode()
            if edit != "D":
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        if counts is not None:
            yield pd.DataFrame([*out, (conv, *counts, audit.decode(), digest.hexdigest())], columns=names)

    schema = f"conv_id string, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"
    out = bounded_batches(edit_stream(prepared_rows, chunk)).mapInPandas(tell, schema)
    return out.withColumn("conv_id", F.col("conv_id").cast(conv_type))


def damaged(rows: DataFrame) -> DataFrame:
    """prepared rows, damaged by a checksum of conversation and turn: dropped, emptied, cut, repeated or made a user's."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    own = rows.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("h"))
    hurt = own.withColumns({
        "text": F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("h") == 4, "user").otherwise(F.col("role")),
        "h": F.explode(F.when(F.col("h") == 3, F.array("h", "h")).otherwise(F.array("h"))),
    })
    return prepared(hurt, F.col("h") == 0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every damaged conversation.

    A conversation of which no row is left has zeros, an empty audit and the digest of nothing.
    """
    rows = table(spark, sf_dir, "conversations")
    return repair_summaries(damaged(rows), rows.schema["conv_id"].dataType)
