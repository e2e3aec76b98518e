import hashlib
import random
import re
import zlib
from itertools import product
from pathlib import Path

import pytest

from millrace.llm import repair
from millrace.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

SCHEMA = "conv_id long, turn long, role string, text string, edit string, at long, fault string, here string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, "y", "z") for r in rows], SCHEMA)


def least(faulty):
    """Cost, audit and repaired rows by trying all edits, two inserts in a row at most."""
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    best = None
    for chosen in product(*[product(inserts, "KuaD") for _ in faulty], inserts):
        cost, audit, out = 0, "", []

        def insert(which):
            nonlocal cost, audit
            for w in which:
                cost, audit = cost + 3, audit + "I"
                out.append(({"u": "user", "a": "assistant"}[w], ""))

        for (role, text, fault), (before, edit) in zip(faulty, chosen[:-1]):
            insert(before)
            if edit == "D":
                cost, audit = cost + 4, audit + "D"
                continue
            if fault in ("blank", "duplicate"):
                break
            cost += 3 * (fault == "truncated")
            if edit != "K":
                cost, role = cost + 3, {"u": "user", "a": "assistant"}[edit]
            audit += "K" if edit == "K" else "R"
            out.append((role, text))
        else:
            insert(chosen[-1])
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or " " for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out), key=lambda b: b[:2])
    return best


def cheapest(faulty):
    """The same for longer conversations: all prefixes by their state, with their letters."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit, out) in list(table.items()):
                for w in "ua":
                    if (state, w) in moves:
                        new = (cost + 3, audit + "I", out + [(names[w], "")])
                        table[moves[state, w]] = min(table.get(moves[state, w], new), new, key=lambda b: b[:2])
        return table

    table = inserted({"": (0, "", [])})
    for role, text, fault in faulty:
        after = {}
        for state, (cost, audit, out) in table.items():
            ways = [(state, (cost + 4, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if (state, role[:1]) in moves:
                    ways.append((moves[state, role[:1]], (cost + extra, audit + "K", out + [(role, text)])))
                ways += [(moves[state, w], (cost + extra + 3, audit + "R", out + [(names[w], text)])) for w in "ua" if (state, w) in moves]
            for new, way in ways:
                after[new] = min(after.get(new, way), way, key=lambda b: b[:2])
        table = inserted(after)
    return min((table[s] for s in ("", "a") if s in table), key=lambda b: b[:2])


SPACES = " \t\n\x0b\x0c\r"


def fault_list(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def summary(rows, solve):
    """``rows`` are ``turn, role, text``."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faulty = fault_list([r[1:] for r in rows])
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[:1] + b[:1] for (a, _, _), (b, _, _) in zip(faulty, faulty[1:])]
    count = [sum(f == kind for _, _, f in faulty) for kind in ("blank", "duplicate", "truncated")]
    cost, audit, out = solve(faulty)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *count, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def wanted(rows, solve, broken=True):
    after = list(damage(rows)) if broken else rows
    return {conv: summary([r[1:] for r in after if r[0] == conv], solve) for conv in {r[0] for r in rows}}


def conversations(seed, count, length):
    chosen = random.Random(seed)
    texts = ["Yes.", "No!", "What?", "cut", "", " \n", "Well. ", "long text " * 30 + "."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", " "]
    return [(c, t, chosen.choice(roles), chosen.choice(texts)) for c in range(count) for t in range(chosen.randrange(length + 1))]


def test_by_trying_all_edits(spark):
    rows = [r for r in conversations(1, 120, 3)]
    got = {r[0]: tuple(r[1:]) for r in repair.digests(repair.edits(frame(spark, rows))).collect()}
    assert got == {str(k): v for k, v in wanted(rows, least, broken=False).items()}


def test_the_two_brute_forces_agree():
    chosen = random.Random(3)
    for _ in range(150):
        faulty = fault_list([(chosen.choice(["user", "assistant", "system", "tool"]), chosen.choice(["a.", "b", "", "c?"])) for _ in range(chosen.randrange(4))])
        assert least(faulty) == cheapest(faulty)


@pytest.mark.parametrize("seed", [1, 2])
def test_damaged_conversations(spark, seed):
    rows = conversations(seed, 300, 12)
    got = {r[0]: tuple(r[1:]) for r in repair.repair_digests(frame(spark, rows)).collect()}
    assert got == wanted(rows, cheapest)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "no conversation."), (None, None, "user", None), (1, None, None, None), (1, None, "user", "Yes."), (2, 1, "user", None), (3, 5, "", "a."), (3, 5, "", "a."), (3, 5, "user", "a."), (3, 9, "assistant", "b.")]
    rows += [(4, 2**60 + 2 * i, "user", "x." * (1 + i)) for i in range(5)] + [(4, None, "user", "y.")] + [(5, i, "user", "\U0001f600 é!") for i in range(3)]
    got = {r[0]: tuple(r[1:]) for r in repair.repair_digests(frame(spark, rows)).collect()}
    assert got == wanted(rows, cheapest)
    assert repair.repair_digests(frame(spark, rows).limit(0)).collect() == []


def test_all_rows_dropped(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = repair.repair_digests(frame(spark, [(gone, 0, "user", "Hello.")])).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_a_giant_conversation_goes_through_its_scratch_file(spark):
    rows = conversations(7, 1, 5000)
    rows = [(0, i, r[2], r[3] + str(i % 700)) for i, r in enumerate(conversations(7, 900, 9))] + [(1, 0, "user", "Hi.")]
    found = repair.edits(frame(spark, rows), waiting=5000)
    got = {r[0]: tuple(r[1:]) for r in repair.digests(found).collect()}
    assert got == {str(k): v for k, v in wanted(rows, cheapest, broken=False).items()}


def test_real_outputs(spark):
    rows = [(0, 0, "system", "Be kind."), (0, 1, "assistant", "Hello."), (0, 2, "user", "And"), (0, 2, "user", "And"), (0, 3, "assistant", "Yes.")]
    got = [(r.edit, r.role, r.text, r.fault, r.cost, r.illegal) for r in repair.edits(frame(spark, rows)).orderBy("at").collect()]
    assert got == [
        ("K", "system", "Be kind.", None, 0, False),
        ("I", "user", "", None, 3, False),
        ("K", "assistant", "Hello.", None, 0, True),
        ("K", "user", "And", "truncated", 3, False),
        ("D", "user", "And", "duplicate", 4, True),
        ("K", "assistant", "Yes.", None, 0, False),
    ]


def test_one_exchange(spark):
    plan = repair.repair_digests(frame(spark, [(0, 0, "user", "a.")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
def test_the_query_on_the_smallest_tables(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op13_repair"](spark, SF_DIR).collect()}
    assert got == wanted(rows, cheapest)
