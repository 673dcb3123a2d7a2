"""Repair of the structure of conversations by alignment with the alternating grammar ``(s?(ua)+)?``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.llm.inputs import memory_returned, named
from appendlake.session import persist_table

DELETE, INSERT, REROLE, LATE = 3, 2, 2, 1
FAR = 1 << 29
CELLS = 2_000_000  # of one conversation's tables; longer ones go through ``by_states``
KEPT = 200_000  # remembered short conversations
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
BLANK = r"[\x20\x09-\x0D]"

# A turn as one letter: x must go (blank or repeated), else s, u, a by role or o for other
# roles; capital if the text is cut off.


def by_targets(turns: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair: edit distance to the grammar's string of each feasible length.

    The strings ``(ua)^k`` are each other's ends, so one table over (turns left, letters
    left) serves all of them, and a second one those that begin with ``s``. Its diagonals
    are cut where the lengths alone would cost more than the incumbent, a repair made in
    one pass. Each string that reaches the least cost is backtraced to its least audit,
    and the least of these is the result.
    """
    n, most = len(turns), incumbent(turns)
    low, width = most // DELETE + 1, most // DELETE + 1 + most // INSERT + 1
    # Column d of row i stands for d - low + (n - i) letters left.
    plain, with_s = np.full((n + 1, width + 1), FAR, np.int32), np.full((n + 1, width + 1), FAR, np.int32)
    d = np.arange(width)
    plain[n, :width] = np.where(d >= low, INSERT * (d - low), FAR)
    for i in range(n - 1, -1, -1):
        turn, letters = turns[i], d - low + (n - i)
        after = plain[i + 1, 1:] + DELETE
        pending = with_s[i + 1, 1:] + DELETE
        if turn != "x":
            late = LATE if turn.isupper() else 0
            change = np.where(letters % 2 == 0, REROLE * (turn.lower() != "u"), REROLE * (turn.lower() != "a"))
            after = np.where(letters >= 1, np.minimum(after, plain[i + 1, :-1] + change + late), after)
            if turn.lower() == "s":
                pending = np.minimum(pending, plain[i + 1, 1:] + late)
        after = np.where(letters >= 0, after, FAR)
        # Insertions: the least over fewer letters, plus what the further ones cost.
        plain[i, :width] = np.minimum(np.minimum.accumulate(after - INSERT * d) + INSERT * d, FAR)
        with_s[i, :width] = np.where(letters >= 1, np.minimum(pending, FAR), FAR)
    ends = [(int(table[0, x]), bool(s), x) for s, table in enumerate((plain, with_s)) for x in range(width) if (x - low + n) % 2 == 0 and x - low + n >= 2 * s]
    cost = min(ends)[0]
    return cost, min(_backtraced(turns, plain, with_s, low, s, x) for c, s, x in ends if c == cost)


def _backtraced(turns: str, plain: np.ndarray, with_s: np.ndarray, low: int, pending: bool, d: int) -> str:
    """The least audit of one target: at each step the first letter of D, I, K, R that stays on a cheapest way."""
    n, i, audit = len(turns), 0, []
    while True:
        table = with_s if pending else plain
        letters, here = d - low + (n - i), table[i, d]
        if i == n and letters == 0 and not pending:
            return "".join(audit)
        turn = turns[i] if i < n else ""
        late = LATE if turn.isupper() else 0
        if turn and table[i + 1, d + 1] + DELETE == here:
            audit.append("D")
            i, d = i + 1, d + 1
        elif not pending and letters and d and plain[i, d - 1] + INSERT == here:
            audit.append("I")
            d -= 1
        elif pending:
            audit.append("K")
            i, d, pending = i + 1, d + 1, False
        else:
            kept = turn.lower() == "ua"[letters % 2] and plain[i + 1, d] + late == here
            audit.append("K" if kept else "R")
            i += 1


def incumbent(turns: str) -> int:
    """Cost of a repair made in one pass: keep what fits, insert what is missing before it, else change its role."""
    cost = state = 0
    for turn in turns:
        if turn == "x":
            cost += DELETE
            continue
        role, due = turn.lower(), "a" if state == 2 else "u"
        cost += LATE if turn.isupper() else 0
        if role == "s" and state == 0:
            state = 1
            continue
        if role in "ua":
            cost += INSERT if role != due else 0
            due = role
        else:
            cost += REROLE
        state = 2 if due == "u" else 3
    return min(cost + {0: 0, 1: 2 * INSERT, 2: INSERT, 3: 0}[state], DELETE * len(turns))


def by_states(turns: str) -> tuple[int, str]:
    """The same result in time linear in the turns, from the last one to the first over the grammar's four states.

    For conversations whose tables would not fit: it keeps four bytes a turn. State 0 has
    nothing yet, 1 has ``s``, 2 waits for ``a``, 3 may end.
    """
    choice = bytearray(4 * (len(turns) + 1))
    after = [0, FAR, FAR, 0]
    for i in range(len(turns), -1, -1):
        turn = turns[i] if i < len(turns) else ""
        role, late = turn.lower(), LATE if turn.isupper() else 0
        moves: list[list[tuple[int, str]]] = []
        for state in range(4):
            if not turn:
                moves.append([(after[state], "")])
                continue
            own = [(after[state] + DELETE, "D")]
            if role != "x":
                to = 3 if state == 2 else 2
                own.append((after[to] + late, "K") if role == ("a" if state == 2 else "u") else (after[to] + late + REROLE, "R"))
                if state == 0 and role == "s":
                    own.append((after[1] + late, "K"))
            moves.append(own)
        least = [min(m)[0] for m in moves]
        two, three = min(least[2], least[3] + INSERT), min(least[3], least[2] + INSERT)
        now = [min(least[0], two + INSERT), min(least[1], two + INSERT), two, three]
        for state in range(4):
            inserted = (now[3] if state == 2 else now[2]) + INSERT
            best = min(m for m in [*moves[state], (inserted, "I")] if m[0] == now[state])
            choice[4 * i + state] = ord(best[1] or ".")
        after = now
    audit, i, state = [], 0, 0
    while (letter := chr(choice[4 * i + state])) != ".":
        audit.append(letter)
        if letter == "K" and state == 0 and turns[i] in "sS":
            state = 1
        elif letter != "D":
            state = 3 if state == 2 else 2
        i += letter != "I"
    return after[0], "".join(audit)


def repair(turns: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, of equal ones the audit that is least in ASCII."""
    most = incumbent(turns)
    if (len(turns) + 1) * (most + 3) <= CELLS:
        return by_targets(turns)
    return by_states(turns)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(``conv_id``, ``turn``, ``role``, ``text``) of rows with faults planted by a checksum of their key.

    Of twenty values of crc32 of ``conv_id:turn``, 0 drops the row, 1 empties its text, 2
    takes ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes its role ``user``. A
    null is one space.
    """
    conv, turn = named(conv_col).cast("string"), named(turn_col).cast("string")
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv, blank), F.lit(":"), F.coalesce(turn, blank)).cast("binary")) % 20
    text = F.coalesce(named(text_col), blank)
    own = rows.select(
        named(conv_col).alias("conv_id"),
        named(turn_col).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(named(role_col), blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return own.drop("copy")


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The four columns, with nulls of role and text as one space, and what orders rows of one turn."""
    role, text = (F.coalesce(named(c), F.lit(" ")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return rows.select(named(conv_col).alias("conv_id"), named(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), digest.alias("digest"))


def _in_order(df: DataFrame, *order: str) -> DataFrame:
    """All rows of a conversation in one partition, one conversation after another, in order; Spark sorts on disk."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


class _Conversation:
    """What is kept of a conversation while its rows pass: a letter and a digest a row."""

    def __init__(self, conv_id: object):
        self.conv_id = conv_id
        self.letters: list[str] = []
        self.seen: set[bytes] = set()
        self.first = self.last = None
        self.numbers = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.role = ""

    def add(self, turn: int | None, role: str, blank: bool, late: bool, digest: bytes) -> None:
        if turn is not None and (self.last is None or turn != self.last):
            self.numbers += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.letters and self.role + role not in LEGAL:
            self.illegal += 1
        self.role = role
        letter = role if role and role in "sua" else "o"
        if blank:
            self.blank += 1
            letter = "x"
        elif digest in self.seen:
            self.duplicate += 1
            letter = "x"
        elif late:
            self.truncated += 1
            letter = letter.upper()
        self.seen.add(digest)
        self.letters.append(letter)

    def row(self, known: dict[str, tuple[int, str]]) -> tuple:
        turns = "".join(self.letters)
        if turns not in known:
            if len(known) > KEPT:
                known.clear()
            found = repair(turns)
            if len(turns) <= 64:
                known[turns] = found
        else:
            found = known[turns]
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.numbers
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *found)


PLAN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def planned(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``) of each conversation.

    Rows go by ``turn``, nulls first; rows of one turn that differ go by a digest of role
    and text. Faults: blank text; role and text seen earlier in the conversation; a last
    character that ends no sentence; the first of them counts. ``illegal`` counts
    neighbours whose role initials are not su, ua or au. ``audit`` has a letter per edit
    (Keep, Rerole, Delete, Insert) of the cheapest repair to ``(s?(ua)+)?``, of equal ones
    the least. A null role or text is one space; the rows of a null ``conv_id`` are one
    conversation. An empty table has no conversations; further columns are not looked at.

    Texts do not travel: a row is its role's initial, two flags and 16 bytes of digest. A
    conversation passes through one task and costs it about a hundred bytes a turn.
    """
    turns = _turns(rows, conv_col, turn_col, role_col, text_col)
    spoken = F.col("text").rlike(f"[^{BLANK[1:]}")
    ended = F.col("text").rlike(f"[.!?]{BLANK}*\\z")
    facts = turns.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), (~spoken).alias("blank"), (~ended).alias("late"), "digest")
    kind = facts.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *[T.StructField(c, T.LongType()) for c in PLAN], T.StructField("audit", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            known: dict[str, tuple[int, str]] = {}
            current, done = None, []
            for batch in batches:
                for conv_id, *facts in zip(*[c.to_pylist() for c in batch.columns]):
                    if current is None or conv_id != current.conv_id:
                        if current:
                            done.append(current.row(known))
                        current = _Conversation(conv_id)
                    current.add(*facts)
                if done:
                    yield _batch(done, schema)
                    done = []
            if current:
                yield _batch([current.row(known)], schema)

    return _in_order(facts, "turn", "digest").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def _with_audits(rows: DataFrame, plan: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Each conversation's audit, then its rows in the order in which they were planned."""
    turns = _turns(rows, conv_col, turn_col, role_col, text_col).withColumn("part", F.lit(1))
    none = [F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role")]
    heads = plan.select("conv_id", *none, F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("part"))
    both = heads.unionByName(turns.select(*heads.columns))
    return _in_order(both, "part", "turn", "digest").select("conv_id", "part", "role", "text")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Per batch: (conv_id, role, text) of the repaired turns, in order; a role of None begins a conversation."""
    audit, at, state, out = "", 0, 0, []

    def inserted() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = 3 if state == 2 else 2
            out.append((conv, ROLES["a" if state == 3 else "u"], ""))
            at += 1

    conv = None
    for batch in batches:
        for head, part, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if part == 0:
                conv, audit, at, state = head, text, 0, 0
                out.append((conv, None, None))
                inserted()
                continue
            letter = audit[at]
            at += 1
            if letter != "D":
                first = letter == "K" and state == 0 and role[:1] == "s"
                state = 1 if first else 3 if state == 2 else 2
                out.append((conv, role if letter == "K" else ROLES["a" if state == 3 else "u"], text))
            inserted()
        yield out
        out = []


def repaired(rows: DataFrame, plan: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(``conv_id``, ``place``, ``role``, ``text``): the turns of ``rows`` after the edits of ``plan``, numbered from 0."""
    kind = plan.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            place = 0
            for turns in _edited(batches):
                done = []
                for conv, role, text in turns:
                    if role is None:
                        place = 0
                    else:
                        done.append((conv, place, role, text))
                        place += 1
                if done:
                    yield _batch(done, schema)

    return _with_audits(rows, plan, conv_col, turn_col, role_col, text_col).mapInArrow(run, schema)


def digests(rows: DataFrame, plan: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(``conv_id``, ``repaired_sha256``): SHA-256 of the repaired ``role:text`` lines, fed turn by turn."""
    kind = plan.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            current, digest, between = None, None, b""
            for turns in _edited(batches):
                done = []
                for conv, role, text in turns:
                    if role is None:
                        if digest:
                            done.append((current, digest.hexdigest()))
                        current, digest, between = conv, hashlib.sha256(), b""
                    else:
                        digest.update(between + f"{role}:{text}".encode())
                        between = b"\n"
                if done:
                    yield _batch(done, schema)
            if digest:
                yield _batch([(current, digest.hexdigest())], schema)

    return _with_audits(rows, plan, conv_col, turn_col, role_col, text_col).mapInArrow(run, schema)


def checked(original: DataFrame, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The plan and the digest for every conversation of ``original``; without a turn in ``rows`` zeros and the digest of nothing."""
    names = (conv_col, turn_col, role_col, text_col)
    plan = persist_table(planned(rows, *names), "conversation-plan")
    ids = original.select(named(conv_col).alias("_conv")).distinct()
    texts = digests(rows, plan, *names).select(F.col("conv_id").alias("_of"), "repaired_sha256")
    both = plan.join(texts, F.col("conv_id").eqNullSafe(F.col("_of")))
    out = ids.join(both, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")

    def or_else(name: str, value: Column) -> Column:
        return F.coalesce(F.col(name), value).alias(name)

    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        F.col("_conv").alias("conv_id"), *[or_else(c, F.lit(0).cast("long")) for c in PLAN], or_else("audit", F.lit("")), or_else("repaired_sha256", nothing)
    )
