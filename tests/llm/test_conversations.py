"""Conversation repair against a brute force that minimises (cost, audit) over whole edit sequences."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import cache

from relaylens.llm import dialogue

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, fault), straight from the definition."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    roles = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserts=0):
        ways = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        if inserts < 3:
            for k, nxt in after[state].items():
                if k != "s":
                    c, a, r = best(i, nxt, inserts + 1)
                    ways.append((c + 5, "I" + a, ((roles[k], ""), *r)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, r = best(i + 1, state)
            ways.append((c + 2, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for k, nxt in after[state].items():
                    if role[:1] == k:
                        c, a, r = best(i + 1, nxt)
                        ways.append((c + more, "K" + a, ((role, text), *r)))
                    if k != "s":
                        c, a, r = best(i + 1, nxt)
                        ways.append((c + more + 1, "R" + a, ((roles[k], text), *r)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    return best(0, 0)


def brute(rows, damage=True):
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv]
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept[conv] += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = {}
    for conv, turns in kept.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in turns:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        times = {t for t, _, _ in turns if t is not None}
        cost, audit, repaired = cheapest([(r, x, f) for (_, r, x), f in zip(turns, faults)])
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in repaired).encode()).hexdigest()
        out[conv] = (max(times) - min(times) + 1 - len(times) if times else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


ODD = [
    (1, 0, "user", "Hello there."), (1, 1, "assistant", "Yes!"), (1, None, "system", "Be kind."), (1, 5, None, None), (1, 6, "user", "no end"),
    (2, 3, "assistant", "First?"), (2, 3, "assistant", "First?"), (2, 4, "tool", "Result."), (2, 9, "", "Empty role."), (2, 10, "user", " \t\n"),
    (3, None, None, None), (None, 1, "user", "No name."), (None, 2, "assistant", "Still none.\u0085"), (4, 0, "user", "cut"), (4, 0, "user", "cut"), (4, 0, "user", "cut"),
    *[(5, i, "user" if i % 3 else "assistant", f"Turn {i % 11}" + "." * (i % 4)) for i in range(60)], *[(6, i, "system", "Same.") for i in range(9)], (7, 2**62, "user", "x" * 100_000 + "."), (7, -(2**62), "assistant", "é 漢 😀!"),
    *[(100 + i, t, r, f"{r} {i} {t}.") for i in range(60) for t, r in enumerate(("user", "assistant", "user", "assistant"))],
]


def check(rows, want):
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(got) == len(rows) == len(want)
    assert {k: (got[k], want[k]) for k in want if got.get(k) != want[k]} == {}


def test_damage_and_repair_of_odd_rows_with_spilled_chunks(spark):
    rows = spark.createDataFrame(ODD, COLUMNS).selectExpr("*", "'old' as audit", "1 as sha", "1 as conv", "1 as h", "2 as code")
    for chunk in (3, dialogue.CHUNK):
        check(dialogue.repair_summaries(dialogue.damaged(rows), "long", chunk).collect(), brute(ODD))


def test_the_query_over_its_table(spark):
    where = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(dialogue.op12_conversation_repair(spark, where).collect(), brute(rows))


def test_repaired_turns_without_damage(spark):
    rows = spark.createDataFrame(ODD, COLUMNS)
    want = brute(ODD, damage=False)
    got = defaultdict(list)
    for r in dialogue.repaired_turns(rows, 4).collect():
        got[r.conv_id].append(r)
    for conv, (*_, audit, digest) in want.items():
        edits = got[conv]  # collected in order within a conversation
        assert "".join(r.edit for r in edits) == audit
        stay = [r for r in edits if r.edit != "D"]
        assert [r.slot for r in stay] == list(range(len(stay)))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in stay).encode()).hexdigest() == digest


def test_empty_table_and_text_ids(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert dialogue.repair_summaries(dialogue.damaged(none), "long").count() == 0
    named = spark.createDataFrame([("a", 1, "user", "Hi."), (None, 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    out = dialogue.repair_summaries(dialogue.prepared(named), "string").collect()
    assert {r.conv_id: (r.audit, r.cost) for r in out} == {"a": ("D", 2), None: ("D", 2)}


def test_a_dropped_conversation_has_an_empty_result(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    out = dialogue.repair_summaries(dialogue.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], COLUMNS)), "long").collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
