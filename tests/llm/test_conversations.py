import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from appendlake.llm import conversations
from appendlake.llm.conversations import by_states, by_targets, checked, damaged, planned, repair, repaired

EMPTY = hashlib.sha256(b"").hexdigest()


def brute(turns):
    """Least (cost, audit) over the grammar's states, all edits tried at every turn."""

    def with_insertions(best):
        changed = True
        while changed:
            changed = False
            for state, (cost, audit) in list(best.items()):
                to, made = (3 if state == 2 else 2), (cost + 2, audit + "I")
                if made < best.get(to, (1 << 40, "")):
                    best[to], changed = made, True
        return best

    best = with_insertions({0: (0, "")})
    for turn in turns:
        new = {}
        for state, (cost, audit) in best.items():
            options = [(state, 3, "D")]
            if turn != "x":
                late, role = int(turn.isupper()), turn.lower()
                keeps = role == ("a" if state == 2 else "u")
                options.append((3 if state == 2 else 2, late + (0 if keeps else 2), "K" if keeps else "R"))
                if state == 0 and role == "s":
                    options.append((1, late, "K"))
            for to, more, letter in options:
                new[to] = min(new.get(to, (1 << 40, "")), (cost + more, audit + letter))
        best = with_insertions(new)
    return min(best[s] for s in (0, 3) if s in best)


@settings(max_examples=500, deadline=None)
@given(st.text("suaoSUAOx", max_size=14))
def test_cheapest_and_least_repair(turns):
    assert by_targets(turns) == by_states(turns) == brute(turns)


def test_long_conversations(monkeypatch):
    rng = random.Random(3)
    turns = "".join(rng.choice("uauauauasoSUAx") for _ in range(600))
    expected = brute(turns)
    assert repair(turns) == by_targets(turns) == expected
    monkeypatch.setattr(conversations, "CELLS", 100)
    assert repair(turns) == expected


def plain(rows):
    """The contract's results from the damaged rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    turns, seen, counts = "", set(), [0, 0, 0]
    for _, role, text in rows:
        content = re.sub(r"[\x20\x09-\x0D]", "", text)
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not content:
            letter, counts[0] = "x", counts[0] + 1
        elif (role, text) in seen:
            letter, counts[1] = "x", counts[1] + 1
        elif content[-1] not in ".!?":
            letter, counts[2] = letter.upper(), counts[2] + 1
        seen.add((role, text))
        turns += letter
    initials = [r[1][:1] for r in rows]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    numbers = {r[0] for r in rows if r[0] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    cost, audit = brute(turns)
    out, at, state = [], 0, 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        state = 1 if letter == "K" and state == 0 and rows[at][1][:1] == "s" else 3 if state == 2 else 2
        made = {1: "", 2: "user", 3: "assistant"}[state]
        if letter == "I":
            out.append((made, ""))
        else:
            out.append((rows[at][1] if letter == "K" else made, rows[at][2]))
            at += 1
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest), out


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(5)
    rows = []
    for conv in [*range(200), None]:
        for turn in range(rng.choice([0, 1, 1, 2, 4, 7, 12])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice(["Yes.", "No!", "Is it?\n", "cut off", "", " \t", None, "a\nb. \r\n", "wide ", "long " * 3000 + "end."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3]) if rng.random() < 0.95 else None, role, text))
    # Rows of one turn that differ have no order of their own: one row a turn here.
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


@pytest.fixture(scope="module")
def table(spark, talks):
    rows = [(*r, "1", "2") for r in talks]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, `a.b` string")


def test_all_conversations(table, talks):
    found = {r.conv_id: tuple(r)[1:] for r in checked(table, damaged(table)).collect()}
    rows = plain_damage(talks)
    assert found.keys() == {r[0] for r in talks}
    for conv, values in found.items():
        assert values == plain(rows[conv])[0], conv
    assert any(not rows[c] for c in found) and any("I" in v[6] for v in found.values())


def test_repaired_turns(table, talks):
    own = damaged(table)
    found = defaultdict(list)
    for r in repaired(own, planned(own)).collect():
        found[r.conv_id].append((r.place, r.role, r.text))
    for conv, rows in plain_damage(talks).items():
        assert sorted(found[conv]) == [(i, *turn) for i, turn in enumerate(plain(rows)[1])]


def test_no_rows_and_dropped_conversations(spark, table):
    assert checked(table.limit(0), damaged(table.limit(0))).count() == 0
    rows = checked(table, damaged(table.limit(0))).collect()
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "", EMPTY)}
    # Repeated rows are duplicates; the rows of a turn stay together.
    twice = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Ho.")], "conv_id long, turn long, role string, text string")
    row = planned(twice).first()
    assert (row.duplicate, row.audit, row.cost, row.illegal) == (1, "DKK", 3, 1) or row.audit == "KDK"
