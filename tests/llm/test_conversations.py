import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfeat.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, conv string, at int, code string, letters int"


def shortest(rows):
    """(cost, least audit) of (initial, fault) rows by search over (place, state)."""
    states = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, audit
        other = 3 if q == 2 else 2
        heapq.heappush(heap, (cost + 2, audit + "I", i, other))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q))
            if fault in ("", "truncated"):
                late = int(fault == "truncated")
                heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, other))
                if initial in states[q]:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, states[q][initial]))


def damage(rows):
    for conv, turn, role, text in rows:
        z = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if z == 1 else re.sub(r"[.!?]", "", text) if z == 2 else text
        yield from [(conv, turn, "user" if z == 4 else role, text)] * (0 if z == 0 else 2 if z == 3 else 1)


def by_hand(rows, hurt=True):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines)}"""
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in damage(rows) if hurt else rows:
        convs[conv].append((turn, role, text))
    out = {}
    for conv, mine in convs.items():
        tie = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()[:32]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, tie(r)))
        coded, seen, n = [], set(), defaultdict(int)
        for turn, role, text in mine:
            body = text.rstrip(C.WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            coded.append((role[:1], fault))
        cost, audit = shortest(coded)
        lines, at, before = [], 0, ""
        for letter in audit:
            if letter != "I":
                turn, role, text = mine[at]
                at += 1
            if letter == "K":
                before = role[0]
                lines.append(f"{role}:{text}")
            elif letter in "RI":
                role = "assistant" if before == "u" else "user"
                before = role[0]
                lines.append(f"{role}:{text if letter == 'R' else ''}")
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, lines)
    return out


def conversations():
    """Every fault and role; nulls in every column; ties; one conversation far longer than a chunk."""
    r = random.Random(3)
    texts = ["Yes.", "No!", "Why? ", "cut off", "", " \t\n\x0b", None, "É. ", "a\nb.", "x" * 100_000 + "?", "Well then."]
    roles = ["user", "assistant", "system", "tool", None, "", "agent", "User"]
    rows = []
    for conv in [None, *range(1, 60)]:
        for turn in range(r.randrange(0, 12)):
            text = r.choice(texts[:9] if conv != 7 else texts)
            text = text if text is None or r.random() < 0.4 else f"{text}{turn}{text}"
            rows.append((conv, None if r.random() < 0.05 else turn * r.choice([1, 1, 2]) - 3, r.choice(roles[:2] * 3 + roles), text))
    rows += [(99, t // 2, r.choice(["user", "assistant", "system", "user", "x"]), r.choice(["Fine.", f"Fine {t}.", f"t{t}", ""])) for t in range(900)]
    rows += [(98, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(41)]
    return rows + rows[:5] + [(97, None, "user", "a."), (97, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "k", 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("chunk_rows", [C.CHUNK, 16, 3])
def test_report_against_brute_force(spark, chunk_rows):
    rows = conversations()
    want = {k: (*v[:-1], hashlib.sha256("\n".join(v[-1]).encode()).hexdigest()) for k, v in by_hand(rows).items()}
    report = C.repair_report(C.damaged(frame(spark, rows)), chunk_rows=chunk_rows).collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in report}
    assert len(got) == len(report) and got == {k: v for k, v in want.items() if v[-2]}
    assert all(v[:-1] == (0, 0, 0, 0, 0, 0, "") for k, v in want.items() if k not in got)


@pytest.mark.parametrize("chunk_rows", [C.CHUNK, 5])
def test_turns_against_brute_force(spark, chunk_rows):
    rows = [(c, t, role or " ", text or " ") for c, t, role, text in conversations()]
    got = defaultdict(list)
    for r in sorted(C.repaired_turns(frame(spark, rows), chunk_rows=chunk_rows).collect(), key=lambda r: (r["conv_id"] or 0, r["n"])):
        got[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert dict(got) == {k: v[-1] for k, v in by_hand(rows, False).items() if v[-1]}
    for lines in got.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_tables_against_search(block):
    """Blocks of any length give the least cost and the least letters."""
    t = C.Tables(block)
    faults = {0: "", 1: "truncated", 2: "blank", 3: "duplicate"}
    for seed in range(800):
        r = random.Random(seed)
        codes = [r.choice([0, 1, 2, 1, 2, 3, 5, 6, 7, 9, 13]) for _ in range(r.randrange(0, 15))]
        cost, audit = shortest([("suat"[c % 4], faults[c // 4]) for c in codes])
        symbols = C._symbols(codes)
        assert t.trace(symbols, t.number[t.end], 0, True)[0] == audit
        _, v, total = t.behind(symbols, t.number[t.end])
        assert t.vectors[v][0] + total == cost
    assert len(t.vectors) < 64 and t.block_to.shape == (len(t.vectors), 9 ** block)


def test_empty_table_and_other_ids(spark):
    assert C.repair_report(frame(spark, []).limit(0)).collect() == []
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes."), ("b", 0, "assistant", "Yes.")]
    table = spark.createDataFrame(rows, "id string, n int, who string, said string")
    got = {r["id"]: (r["cost"], r["audit"]) for r in C.repair_report(table, "id", "n", "who", "said").collect()}
    assert got == {"a": (0, "KK"), "b": (2, "IK")}


def test_dropped_conversations_and_oracle(spark, tmp_path):
    rows = conversations()
    path = str(tmp_path)
    frame(spark, rows).coalesce(1).write.parquet(f"{path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{path}/conversations.parquet/*.parquet'")
    got = C.op12_block_repair(spark, path)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({C.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert {r[0] for r in want} == {r[0] for r in rows}
