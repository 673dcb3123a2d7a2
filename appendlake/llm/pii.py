"""Personal data in texts: voters on candidate spans, weighed by expectation-maximisation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import named
from appendlake.session import persist_table

KINDS = ("email", "ip", "card", "phone")
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
# Base patterns. A match starts at the start of a run of its first class or
# where the last match ended, so no start inside a run has to be tried.
EMAIL = "(?=[A-Za-z0-9._%+-])(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?=[0-9])(?:\\G|(?<![0-9]))[0-9]++(?:\\.[0-9]++){3}"
# Single separators between digits are \x01 by then, so a match is a whole run of both.
# Shorter runs can't have 13 digits, the fewest that voters are asked about.
CARD = "(?=[0-9])(?<![0-9\\x01])[0-9][0-9\\x01]{12,}+"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
# Looser forms, which are personal data only if the voters say so.
LOOSE_EMAIL = "(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}\\s?[\\[(]\\s?at\\s?[\\])]\\s?[a-z0-9-]{2,64}(?:\\s?[\\[(]\\s?dot\\s?[\\])]\\s?[a-z0-9-]{2,64}){1,4}"
LOOSE_PHONE = "(?<![0-9+.)-])(?<!\\+[0-9]{1,3}[ ().-]{1,2})(?:\\([0-9]{3}\\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
# Gazetteers, as patterns on the match, and cue words, on what stands before it.
KNOWN = {
    "email": "(?i)(?:\\.|dot\\W{0,3})(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|ch|at|nl)$",
    "ip": "^(?:10\\.|127\\.|192\\.168\\.|172\\.(?:1[6-9]|2[0-9]|3[01])\\.|169\\.254\\.|(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])\\.)",
    "card": "^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": "^(?:\\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\\([2-9][0-9]{2}\\)|[2-9][0-9]{2}[ .-])",
}
CUES = {
    "email": "(?i)(?:e-?mail|mail|contact|write|correo|courriel|kontakt)\\W{0,12}$",
    "ip": "(?i)(?:\\bip|address|host|server|login|from)\\W{0,12}$",
    "card": "(?i)(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\\W{0,12}$",
    "phone": "(?i)(?:phone|tel|call|mobile|fax|cell|dial|t[eé]l[eé]fono?)\\W{0,12}$",
}
VOTERS = ("form", "check", "known", "cue")
BEFORE = 40
RUN = 256


@dataclass(frozen=True)
class Judgement:
    """The patterns of votes that the final classifier takes for personal data, and how
    often each voter is right about it, for people to read."""

    accepted: tuple[str, ...]
    reliability: dict[tuple[str, str], float]


def _matches(text: Column, pattern: str, possible: Column) -> Column:
    """Array of (``start``, ``end``, ``found``, ``before``) of a pattern's matches, in code points.

    ``possible`` is a cheap test that every text with a match passes.
    """
    found = F.when(possible, F.regexp_extract_all(text, F.lit(pattern), 0))
    kind = "array<struct<start:int,end:int,found:string,before:string>>"
    empty, none = F.array().cast(kind), F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.char_length(x["found"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["found"].alias("found"), F.substring(x["gap"], -BEFORE, BEFORE).alias("before"))
        more = F.when(x["found"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span)))
        return F.struct(F.coalesce(end, begin).alias("at"), more.alias("out"))

    def move(acc: Column, part: Column) -> Column:
        moved = F.transform(part["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["found"].alias("found"), s["before"].alias("before")))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    # An array grows by copying, so spans are placed in runs of RUN matches, and then the runs.
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"))
    runs = F.transform(_slices(parts), lambda run: F.aggregate(run, none, add))
    nested = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.when(F.size(found) > 0, F.flatten(F.aggregate(runs, nested, move)["out"])).otherwise(empty)


def _slices(values: Column) -> Column:
    """An array as an array of arrays of up to ``RUN`` values."""
    bare = F.struct(values.alias("v"))  # named once, so that it is computed once
    return F.flatten(
        F.transform(F.array(bare), lambda b: F.transform(F.sequence(F.lit(0), F.floor((F.size(b["v"]) - 1) / RUN).cast("int")), lambda i: F.slice(b["v"], i * RUN + 1, F.lit(RUN))))
    )


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def candidates(text: Column) -> Column:
    """Array of (``kind``, ``start``, ``end``, ``base``, ``votes``) of all candidate spans of a text.

    ``base`` spans are those of the fixed patterns that pass their check. ``votes`` has a
    letter per voter: y, n, or - for no opinion.
    """

    def vote(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, "y").when(no if no is not None else F.lit(False), "n").otherwise("-")

    def spans(kind: str, pattern: str, source: Column, strict: bool, possible: Column) -> Column:
        def one(m: Column) -> Column:
            n = F.char_length(_digits(m["found"]))
            if kind == "ip":
                valid = m["found"].rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
            elif kind == "card":
                valid = n.between(16, 19) & F.when(n.between(16, 19), _luhn(_digits(m["found"]))).otherwise(False)
            elif kind == "phone":
                valid = n.between(8, 15)
            else:
                valid = F.lit(True)
            known = m["found"].rlike(KNOWN[kind])
            votes = [vote(F.lit(strict)), vote(valid, ~valid), vote(known, ~known), vote(m["before"].rlike(CUES[kind]))]
            base = valid if strict else F.lit(False)
            return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), base.alias("base"), F.concat(F.lit(kind + ":"), *votes).alias("votes"))

        return F.transform(_matches(source, pattern, possible), one)

    joined = F.regexp_replace(F.translate(text, "\x01", "\x02"), "(?<=[0-9])[ -](?=[0-9])", "\x01")
    return F.concat(
        spans("email", EMAIL, text, True, text.contains("@")),
        spans("ip", IP, text, True, text.rlike("[0-9]\\.[0-9]")),
        spans("card", CARD, joined, True, text.rlike("[0-9][ -]?[0-9]")),
        spans("phone", PHONE, text, True, text.contains("+")),
        spans("email", LOOSE_EMAIL, text, False, text.rlike("(?i)[\\[(]\\s?at\\s?[\\])]")),
        spans("phone", LOOSE_PHONE, text, False, text.rlike("[0-9]{3}[ .-][0-9]{4}")),
    )


def _apart(spans: Column) -> Column:
    """The base spans, and the others that overlap none of them; failed matches stay for the voters."""

    def free(s: Column) -> Column:
        return s["base"] | ~F.exists(spans, lambda b: b["base"] & (b["start"] < s["end"]) & (s["start"] < b["end"]))

    return F.filter(spans, free)


def judge(spans: DataFrame, accept: float = 0.9, steps: int = 30) -> Judgement:
    """Learns from ``votes`` and ``base`` of all candidates, grouped to their few patterns.

    Expectation-maximisation estimates, per kind, how often each voter says yes for
    personal data and for other text (Dawid and Skene, 1979); base spans are known to be
    personal data. A logistic classifier on the votes is then fitted to the resulting
    probabilities, and decides. The driver sees at most four kinds times 3^4 patterns.
    """
    rows = spans.groupBy("votes", "base").agg(F.count(F.lit(1)).alias("n")).collect()
    accepted, reliability = [], {}
    for kind in KINDS:
        mine = sorted((r["votes"].split(":")[1], r["base"], r["n"]) for r in rows if r["votes"].startswith(kind + ":"))
        if not mine:
            continue
        says = np.array([[{"y": 1.0, "n": 0.0, "-": np.nan}[v] for v in votes] for votes, _, _ in mine])
        base = np.array([b for _, b, _ in mine])
        n = np.array([float(c) for _, _, c in mine])
        spoke = ~np.isnan(says)
        yes = np.where(spoke, says, 0.0)
        p = np.where(base, 1.0, np.where(spoke.any(axis=1), yes.sum(axis=1) / np.maximum(1, spoke.sum(axis=1)), 0.5))
        for _ in range(steps):
            prior = (n @ p + 1) / (n.sum() + 2)
            rates = []
            for w in (p * n, (1 - p) * n):
                rates.append((w @ yes + 1) / (w @ spoke + 2))
            logs = [np.where(spoke, np.where(yes > 0, np.log(r), np.log(1 - r)), 0.0).sum(axis=1) for r in rates]
            odds = np.log(prior) - np.log(1 - prior) + logs[0] - logs[1]
            p = np.where(base, 1.0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        reliability.update({(kind, v): float(rates[0][i]) for i, v in enumerate(VOTERS)})
        q = _classified(np.where(spoke, yes * 2 - 1, 0.0), p, n)
        accepted += [f"{kind}:{votes}" for (votes, b, _), x in zip(mine, q) if not b and x >= accept]
    return Judgement(tuple(sorted(accepted)), reliability)


def _classified(x: np.ndarray, p: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Probabilities by a ridge logistic regression on the votes, fitted to soft labels."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x.T * (n * np.maximum(q * (1 - q), 1e-6))) @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (n * (p - q)) - ridge * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Judgement]:
    """(``doc_id``, ``spans``: array of kind, start, end, base) of every row, and what was learned.

    Whole texts are read once; what is written has spans only. A null text is empty.
    Null and repeated doc_ids stay as they are.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), candidates(text).alias("spans"))
    rows = persist_table(rows.select("doc_id", _apart(F.col("spans")).alias("spans")), "spans")
    learned = judge(rows.select(F.inline("spans")))
    return rows.select("doc_id", chosen(F.col("spans"), learned).alias("spans")), learned


def chosen(spans: Column, learned: Judgement) -> Column:
    """Base spans and accepted ones, by kind and start."""
    kept = F.filter(spans, lambda s: s["base"] | s["votes"].isin(list(learned.accepted)) if learned.accepted else s["base"])
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).cast("int")
    keyed = F.transform(kept, lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))


def shown(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of personal data in the text replaced by <KIND>.

    Overlapping spans become one, named after the first. Null texts stay null.
    """
    text = named(text_col)
    own = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), text.alias("text"))
    rows = own.select("row", "text", F.when(F.col("text").isNotNull(), candidates(F.col("text"))).alias("spans"))
    learned = judge(rows.select(_apart(F.col("spans")).alias("spans")).select(F.inline("spans")))
    order = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    rows = rows.select("row", "text", F.array_sort(F.transform(chosen(_apart(F.col("spans")), learned), order)).alias("spans"))
    text = F.col("text")

    def replace(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        more = F.concat(acc["out"], kept, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        out = F.when(s["start"] >= acc["at"], more).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate("spans", start, replace, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    clean = F.when(F.size("spans") > 0, done).otherwise(text).alias(text_col)
    return rows.select(*[clean if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
