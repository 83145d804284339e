"""Conversation repair against an enumeration of edit scripts, and on nulls, ties, repeats, empty tables and long rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from callsheet.llm import turn_repair
from callsheet.llm.queries import op13_turn_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost int, fault string, _nth int"
SHAPE = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        marks = WORD.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """Cost, audit and repaired turns: all edit scripts with up to two inserts in a gap."""
    gaps = [[tuple(p) for n in range(3) for p in itertools.product(("user", "assistant"), repeat=n)]] * (len(rows) + 1)
    options = []
    for (role, text), fault in zip(rows, faults_of(rows), strict=True):
        mine = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            mine += [(more, "K", (role, text)), (1 + more, "R", ("user", text)), (1 + more, "R", ("assistant", text))]
        options.append(mine)
    best = None
    for own in itertools.product(*options):
        base = sum(c for c, _, _ in own)
        if best and base > best[0]:
            continue
        for ins in itertools.product(*gaps):
            cost = base + 5 * sum(map(len, ins))
            if best and cost > best[0]:
                continue
            audit, turns = "", []
            for i in range(len(rows) + 1):
                audit += "I" * len(ins[i])
                turns += [(r, "") for r in ins[i]]
                if i < len(rows):
                    audit += own[i][1]
                    turns += [own[i][2]] if own[i][2] else []
            if SHAPE.fullmatch("".join(r[:1] or "-" for r, _ in turns)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, turns
    return best


def walked(rows):
    said = []
    c = turn_repair.Conversation(1, lambda _, place, edit, role, text: said.append((role, text)))
    kinds = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for i, ((role, text), fault) in enumerate(zip(rows, faults_of(rows), strict=True)):
        c.push(i, role, text, kinds[fault])
    return c.result(), said


def test_the_cheapest_repair_is_found():
    rng = random.Random(5)
    for n in [0, 1, 2, 3] * 60 + [4] * 25:
        rows = [(rng.choice(("system", "user", "assistant", "user", "assistant", "tool", "", " ")),
                 rng.choice(("a.", "b!", "c?", "cut", "", " \n", "d. "))) for _ in range(n)]
        got, said = walked(rows)
        cost, audit, turns = brute(rows)
        assert (got["cost"], got["audit"], said) == (cost, audit, turns), rows
        assert got["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def plain(rows):
    """Cost and audit by a table of (cost, audit) pairs, without integers, settling or dropped nodes."""
    value = {0: (0, "")}
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(v):
        for _ in range(2):
            for s, (cost, audit) in list(v.items()):
                for to in step[s].values():
                    if to != 1:
                        v[to] = min(v.get(to, (9e9, "")), (cost + 5, audit + "I"))
        return v

    for (role, _), fault in zip(rows, faults_of(rows), strict=True):
        out = {}
        for s, (cost, audit) in inserted(dict(value)).items():
            edges = [(s, cost + 2, "D")]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                edges += [(to, cost + more, "K") for c, to in step[s].items() if c == role[:1]]
                edges += [(to, cost + more + 1, "R") for to in step[s].values() if to != 1]
            for to, c, letter in edges:
                out[to] = min(out.get(to, (9e9, "")), (c, audit + letter))
        value = out
    return min(v for s, v in inserted(dict(value)).items() if s in (0, 3))


def test_long_conversations_settle_and_agree_with_pairs_of_cost_and_text():
    rng = random.Random(8)
    for n in (31, 32, 33, 64, 200, 700):
        for roles in (("user", "assistant"), ("user",), ("system", "user", "assistant", "tool"), ("assistant",)):
            rows = [(rng.choice(roles), f"t{i}{rng.choice(('.', '.', '?', '', ' '))}" * rng.choice((1, 1, 1, 0))) for i in range(n)]
            got, _ = walked(rows)
            assert (got["cost"], got["audit"]) == plain(rows)


def test_open_part_stays_short():
    c = turn_repair.Conversation(1)
    for i in range(20_000):
        c.push(i, ("user", "assistant")[i % 2], f"t{i}.", 0)
        assert len(c.repair.open) < 3 * turn_repair.SETTLE
    assert c.result()["cost"] == 0


def damaged(rows):
    """The contract's damage on (conv_id, turn, role, text) rows."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        deal = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if deal == 1 else re.sub("[.!?]", "", text) if deal == 2 else text
        row = (conv, turn, "user" if deal == 4 else role, text)
        out += [] if deal == 0 else [row, row] if deal == 3 else [row]
    return out


def expected(rows):
    out, kept = {}, damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in kept if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        pairs = [r[1:] for r in mine]
        turns = [t for t, _, _ in mine if t is not None]
        found, initials = faults_of(pairs), [r[:1] for r, _ in pairs]
        cost, audit = plain(pairs)
        repaired = walked(pairs)[1]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def conversations(rng):
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randrange(1, 9)):
            turn = rng.choice((turn, turn, turn, turn * 3, None, 2))
            rows.append((conv, turn, rng.choice(("system", "user", "assistant", "user", "assistant", None, "tool", "")),
                         rng.choice(("Yes.", "no", None, "", "Ünï ok!", "a b. c?", " ", "x" * 30_000 + ".", f"t{rng.random()}."))))
    rows += rows[:20]
    rows += [(500, t, ("user", "assistant")[t % 2], f"say {t}.") for t in range(900)]  # one conversation with many rows
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = conversations(random.Random(2))
    path = str(tmp_path)
    spark.createDataFrame([(*r, 9, "x", 5) for r in rows], SCHEMA).repartition(7).write.parquet(f"{path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in op13_turn_repair(spark, path).collect()}
    assert got == expected(rows)


def test_turns_are_those_of_the_hash(spark):
    rows = conversations(random.Random(4))
    table = spark.createDataFrame([(*r, 9, "x", 5) for r in rows], SCHEMA)
    faulty = turn_repair.damaged(table)
    hashes = {r.conv_id: r.repaired_sha256 for r in turn_repair.summaries(faulty).collect()}
    said = {}
    for r in sorted(turn_repair.repaired_turns(faulty).collect(), key=lambda r: r.place):
        said.setdefault(r.conv_id, []).append(r)
    for conv, sha in hashes.items():
        turns = said.get(conv, [])
        assert [t.place for t in turns] == list(range(len(turns)))
        assert SHAPE.fullmatch("".join(t.role[:1] for t in turns))
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == sha


@pytest.mark.parametrize("make", [turn_repair.summaries, turn_repair.repaired_turns])
def test_empty_table(spark, make):
    assert make(turn_repair.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_a_conversation_whose_rows_are_all_dropped_stays(spark):
    conv = next(c for c in range(10 ** 6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = turn_repair.summaries(turn_repair.damaged(spark.createDataFrame([(conv, 0, "user", "a.", 1, "", 1)], SCHEMA))).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_extreme_turn_numbers(spark):
    rows = [(1, -2 ** 63, "user", "a.", 1, "", 1), (1, 2 ** 63 - 1, "assistant", "b.", 1, "", 1)]
    (row,) = turn_repair.summaries(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (row.gaps, row.cost, row.audit) == (2 ** 63 - 1, 0, "KK")
