import hashlib
import itertools
import random
import re
import zlib

import pytest

from nameledger.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, fault string, nth int, has_turn int"
COSTS = {"D": 2, "I": 5, "K": 0, "R": 1}


def is_blank(text):
    return not text.strip(" \t\n\x0b\x0c\r")


def cheapest(turns):
    """All edits there are, by brute force over letters with at most two inserted turns anywhere."""
    best = {}
    n = len(turns)

    def go(i, roles, audit, cost, inserted, made):
        if i == n and re.fullmatch("(s?(ua)+)?", roles):
            best[audit] = (cost, made)
        if inserted < 2:
            for role in ("user", "assistant"):
                if re.match("(s?(ua)*u?)?$", roles + role[0]):
                    go(i, roles + role[0], audit + "I", cost + 5, inserted + 1, [*made, (role, "")])
        if i == n:
            return
        role, text, fault = turns[i]
        go(i + 1, roles, audit + "D", cost + 2, inserted, made)
        if fault in ("blank", "duplicate"):
            return
        more = 5 if fault == "truncated" else 0
        if re.match("(s?(ua)*u?)?$", roles + role[:1]) and role:
            go(i + 1, roles + role[0], audit + "K", cost + more, inserted, [*made, (role, text)])
        for new in ("user", "assistant"):
            if re.match("(s?(ua)*u?)?$", roles + new[0]):
                go(i + 1, roles + new[0], audit + "R", cost + 1 + more, inserted, [*made, (new, text)])

    go(0, "", "", 0, 0, [])
    audit = min(best, key=lambda a: (best[a][0], a))
    return best[audit][0], audit, best[audit][1]


def plain(data, damage):
    talks = {}
    for conv, turn, role, text, *_ in data:
        role, text = (" " if role is None else role), (" " if text is None else text)
        talks.setdefault(conv, [])
        lot = 5
        if damage:
            lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        role = "user" if lot == 4 else role
        talks[conv] += [(turn, role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    out = []
    for conv, rows in talks.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        numbers = [r[0] for r in rows if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, turns = set(), []
        for _, role, text in rows:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if is_blank(text) else "duplicate" if (role, text) in seen else "" if last in (".", "!", "?") else "truncated"
            seen.add((role, text))
            turns.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, made = cheapest(turns)
        text = "\n".join(f"{r}:{t}" for r, t in made)
        counts = [sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(), made))
    return sorted(out, key=repr)


def some_turns():
    draw = random.Random(3)
    roles = ["user", "assistant", "user", "assistant", "system", "User", "", None, "tool", "u"]
    texts = ["Yes.", "No!", "What? ", "cut", "", " \t", None, "é\x0b", "A.\n", "Line\nnext.", "…"]
    data = []
    for conv in range(260):
        n = draw.randint(1, 7)
        for turn in range(n):
            role = draw.choice(roles) if draw.random() < 0.5 else ("user", "assistant")[turn % 2]
            text = draw.choice(texts) if draw.random() < 0.6 else f"Text {draw.random()}."
            data.append((conv, draw.choice([turn, turn, turn, draw.randrange(12), None]), role, text))
    data += [(None, i, ("user", "assistant")[i % 2], f"t{i // 4}.") for i in range(8)]
    data += [(-5, -(2**62), "user", "x."), (-5, 2**62, "assistant", "y.")] + [(0, 3, "user", "again.")] * 2
    draw.shuffle(data)
    return [(*d, "f", 1, 2) for d in data]


@pytest.mark.parametrize("damage", [False, True])
def test_against_all_edits(rows, damage):
    data = some_turns()
    df = rows(data, SCHEMA)
    df = repair.damaged(df) if damage else df
    want = plain(data, damage)
    got = sorted(map(tuple, repair.repair_report(df).collect()), key=repr)
    assert got == [w[:-1] for w in want]
    made = {}
    for conv, position, edit, role, text in repair.repaired_turns(df).collect():
        made.setdefault(conv, []).append((position, edit, role, text))
    for conv, *_, audit, _, turns in want:
        found = sorted(made.pop(conv, []))
        assert [f[0] for f in found] == list(range(len(turns))) and [f[2:] for f in found] == turns
        assert "".join(f[1] for f in found) == audit.replace("D", "")
    assert not made


def test_inserts_where_they_are_cheap(rows, monkeypatch):
    monkeypatch.setattr(repair, "INSERT", 1)
    monkeypatch.setattr(repair, "STEPS", repair._Steps())
    step = repair._step((10, 10, 0, 10), 3 * 1)  # a user turn, and from then on only a place after a user is good
    assert step[0][repair.START] == 0
    assert repair._step((0, 0, 0, 0), None)[0] == (0, 2, 1, 0)


def test_giant_conversation_leaves_memory_and_batches(spark, monkeypatch):
    n = 60_000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "999")
    try:
        who = "CASE WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role"
        df = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", who, "concat('Turn ', id, repeat(' more', 20), '.') AS text")
        last = spark.range(1).selectExpr("1L AS conv_id", f"{n}L AS turn", "'assistant' AS role", "repeat('long ', 1000000) AS text")
        got = repair.repair_report(df.unionByName(last)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    text = "\n".join(f"{('user', 'assistant')[i % 2]}:Turn {i}{' more' * 20}." for i in range(n))
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 1, 1, 2, "K" * n + "D", hashlib.sha256(text.encode()).hexdigest())]


def test_reading_back_turns_larger_than_a_piece(monkeypatch):
    monkeypatch.setattr(repair, "IN_MEMORY", 64)
    draw = random.Random(8)
    put = [(draw.randrange(256), b"r" * draw.randrange(40), b"t" * draw.randrange(400)) for _ in range(300)]
    turns = repair._Turns()
    for byte, role, text in put:
        turns.add(byte, role, text)
    assert list(turns.forward()) == put[::-1]


def test_nothing_left(rows):
    assert repair.repair_report(rows([], SCHEMA)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.repair_report(repair.damaged(rows([(gone, 0, "user", "x.", "", 1, 1)], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
