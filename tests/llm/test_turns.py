"""Conversation repair against a plain search over all edits."""
# ruff: noqa: F811
import hashlib
import random
import re
import zlib
from functools import cmp_to_key

import pytest
from llm_fixtures import SF001, lspark  # noqa: F401
from pyspark.sql import functions as F

from hostelry.llm import turns

GRAMMAR = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Least (cost, audit) by going through the grammar's states turn by turn."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        found = WORD.findall(text)
        faults.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else None)
        seen.add((role, text))
    following = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                for to in following[state]:
                    way = (cost + 3, audit + "I", [*lines, ("user:" if to == "u" else "assistant:")])
                    if to != "s" and (to not in states or way[:2] < states[to][:2]):
                        states[to] = way
        return states
    states = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}

        def reach(to, way):
            if to not in new or way[:2] < new[to][:2]:
                new[to] = way
        for state, (cost, audit, lines) in states.items():
            reach(state, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                for to in following[state]:
                    cut = 3 * (fault == "truncated")
                    if role[:1] == to:
                        reach(to, (cost + cut, audit + "K", [*lines, f"{role}:{text}"]))
                    elif to != "s":
                        reach(to, (cost + cut + 3, audit + "R", [*lines, ("user:" if to == "u" else "assistant:") + text]))
        states = inserted(new)
    cost, audit, lines = min((states[s] for s in ("", "a") if s in states), key=cmp_to_key(lambda a, b: (a[:2] > b[:2]) - (a[:2] < b[:2])))
    named = {t for t, _, _ in rows if t is not None}
    gaps = max(named) - min(named) + 1 - len(named) if named else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain(data):
    return {conv: plain_repair(plain_damage([r for r in data if r[0] == conv])) for conv in {r[0] for r in data}}


def check(df, data):
    got = turns.repair_conversations(df).collect()
    assert {r.conv_id: tuple(r[1:]) for r in got} == plain(data) and len(got) == len({r[0] for r in data})


def conversation(rng, conv, n):
    roles = ["user", "assistant"] * n
    rows = [(conv, t, rng.choice(["system", "tool", "", None, "assistant", "user"]) if rng.random() < 0.2 else roles[t],
             rng.choice(["Yes.", "No", "Well? ", "", " \t", None, f"t{rng.randrange(9)}!", "é日。"])) for t in range(n) if rng.random() < 0.9]
    return [(conv, 0, "system", "Be brief.")] * (rng.random() < 0.3) + rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_random_conversations(lspark):
    rng = random.Random(11)
    data = [r for c in range(150) for r in conversation(rng, c, rng.randint(0, 9))] + conversation(rng, 1000, 45) + conversation(rng, 1001, 70)
    extra = lspark.createDataFrame([(*r, 1, "k") for r in data], SCHEMA + ", kind int, digest string").repartition(3)
    check(extra, data)


def test_one_long_conversation(lspark):
    """A conversation that spreads over all tasks, with turns that come again far away."""
    rng = random.Random(12)
    data = conversation(rng, 5, 900) + [(5, t, "user", "Again!") for t in (3, 400, 880)] + conversation(rng, 4, 6) + conversation(rng, 6, 6)
    check(lspark.createDataFrame(data, SCHEMA).repartition(4), data)


def test_odd_rows(lspark):
    data = [(None, None, None, None), (None, 3, "user", "A."), (1, None, "user", "A."), (1, None, "user", "B."), (1, 2, "user", "A."), (2, 7, "", ""),
            (3, 1, "user", "x" * 300_000 + "."), (3, 2, "assistant", " " * 200_000 + "ok"), (4, -5, "assistant", "Hi."), (4, 9, "assistant", "Hi.")]
    data += [(8, 1, "user", "Same.")] * 50 + [(8, 2, "assistant", "Same?")]  # repeated rows
    gone = next(c for c in range(100, 1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    data.append((gone, 0, "user", "Gone."))
    check(lspark.createDataFrame(data, SCHEMA), data)
    empty = turns.repair_conversations(lspark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["conv_id", *turns.RESULT]


def test_driver_table(lspark):
    df = lspark.read.parquet(f"{SF001}/conversations.parquet")
    check(df, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("chunk", [1, 2, 5, 32])
def test_chunks_and_tasks_give_the_whole(monkeypatch, chunk):
    rng = random.Random(chunk)
    for _ in range(60):
        rows = plain_damage(conversation(rng, rng.randrange(10 ** 6), rng.randint(1, 14)))
        rows.sort(key=lambda r: (r[0], r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        monkeypatch.setattr(turns, "CHUNK", chunk)
        cuts = sorted(rng.choices(range(len(rows) + 1), k=2))
        whole, seen = turns.Turns(True), set()
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            own = turns.Turns(False)
            for turn, role, text in rows[a:b]:
                own.add(turn, role, text.encode(), 1, (role, text) in seen and bool(WORD.search(text)))
                seen.add((role, text))
            whole.follow(own.state())
        found = whole.result(whole.parts.all())
        want = plain_repair(rows)
        assert tuple(found) == want[:-1]
        repair = turns.Repair(found[-1])
        for _, role, text in rows:
            repair.turn(role, text.encode(), 1)
        assert repair.hex() == want[-1]


def test_audits_fit_the_grammar():
    rng = random.Random(13)
    for _ in range(300):
        codes = "".join(rng.choices("suaxSUAXd", k=rng.randint(0, 9)))
        for leave in (turns.NOTHING, turns.ASSISTANT):
            found = turns.best(codes, turns.NOTHING, leave)
            target = "s" * ((len(found[1]) - found[1].count("D")) % 2)
            target += "ua" * ((len(found[1]) - found[1].count("D")) // 2)
            assert GRAMMAR.fullmatch(target) and sum(e != "I" for e in found[1]) == len(codes)
            assert turns.align(codes, target, found[0]) == found and turns.align(codes, target, found[0] - 1) is None
            assert turns.align(codes, target, 10 ** 6) == found  # bands leave out nothing that counts


def test_damage_counts(lspark):
    df = lspark.createDataFrame([(c, t, "user", "a.b!c?") for c in range(40) for t in range(20)], SCHEMA)
    rows = turns.damaged(df).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("text") == "", F.col("n"))).alias("e")).first()
    kinds = [zlib.crc32(f"{c}:{t}".encode()) % 20 for c in range(40) for t in range(20)]
    assert rows.n == 800 - kinds.count(0) + kinds.count(3) and rows.e == kinds.count(1)
