"""Toxicity scores by a linear classifier on character n-grams, scaled by naive Bayes ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import memory_returned, named
from appendlake.session import persist_table

LENGTHS = (3, 4, 5, 6)
BIN_BITS = 20
CHARS_AT_ONCE = 1 << 18
MIN_DOCS = 3
MIN_ERRORS = 3.0


@dataclass
class Model:
    """The weight of each bin of n-gram hashes, most of them 0; and what a text without them gets."""

    weights: np.ndarray
    bias: float


def grams(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams of a lower-cased text, a stretch and a length at a time."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    longest = max(LENGTHS)
    with np.errstate(over="ignore"):
        for at in range(0, max(1, len(points)), CHARS_AT_ONCE):
            part = points[at : at + CHARS_AT_ONCE + longest - 1].astype(np.uint64)
            h = part * np.uint64(0x9E3779B97F4A7C15)
            for n in range(2, longest + 1):
                if len(part) < n:
                    break
                h = h[:-1] * np.uint64(0xD1B54A32D192ED03) + part[n - 1 :]
                if n in LENGTHS:
                    z = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                    yield z ^ (z >> np.uint64(29))


def _bins(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BIN_BITS)).astype(np.int64)


class Finder:
    """Which of the wanted bins, a mark per bin, the n-grams of a text fall into."""

    def __init__(self, wanted: np.ndarray):
        self.wanted = wanted
        self.seen = np.zeros(len(wanted), bool)

    def of(self, text: str) -> np.ndarray:
        found = [np.zeros(0, np.int64)]
        for h in grams(text):
            bins = _bins(h)
            bins = bins[self.wanted[bins]]
            bins = bins[~self.seen[bins]]  # a bin may still stand here twice, never in two parts
            self.seen[bins] = True
            found.append(bins)
        every = np.concatenate(found)
        self.seen[every] = False
        return np.unique(every)


def labelled(docs: DataFrame, labels: DataFrame, use: Column, broadcast_rows: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(``doc_id``, ``text``, ``label``) of the labelled rows for which ``use`` (on ``doc_id``) holds.

    A doc_id with several labels takes the highest. Labels of up to ``broadcast_rows``
    rows go to the texts; more are joined by a shuffle.
    """
    marks = labels.filter(named(label_col).isNotNull()).groupBy(named(id_col).cast("long").alias("id")).agg(F.max(named(label_col)).cast("int").alias("label"))
    marks = persist_table(marks.filter(F.col("id").isNotNull()), "labels")
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text")).filter(use)
    few = marks.count() <= broadcast_rows
    return rows.join(F.broadcast(marks) if few else marks, rows["doc_id"] == marks["id"]).select("doc_id", "text", "label")


def trained(
    rows: DataFrame, min_docs: int = MIN_DOCS, min_errors: float = MIN_ERRORS,
    fit_rows: int = 20_000, fit_entries: int = 4_000_000, ridge: float = 1.0,
) -> Model:
    """Fits the classifier to rows of ``labelled``.

    N-grams are hashed to 2^``BIN_BITS`` bins, the model's fixed width, and all rows are
    counted: documents per bin and class. Every bin in ``min_docs`` documents or more
    whose shares in the two classes lie ``min_errors`` standard errors apart is a feature, 1 or 0 per
    text, scaled by its log-count ratio; there is no other limit to their number. The
    logistic fit takes the rows whose hashed doc_ids are smallest: ``fit_rows`` of them,
    or fewer if these have more than ``fit_entries`` features in all (the first row
    always). A feature that no row of the fit has gets the mean weight of those that some row has, times
    its ratio. Rows of one class give a model that knows no n-gram.
    """
    totals = dict.fromkeys((0, 1), 0) | {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals[0] or not totals[1]:
        share = totals[1] / max(1, totals[0] + totals[1])
        return Model(np.zeros(1 << BIN_BITS), np.inf if share else -np.inf)
    neg, pos = F.lit(float(totals[0])), F.lit(float(totals[1]))
    bins = rows.select("text", "label").mapInArrow(_count_bins, "bin int, pos int, neg int")
    bins = bins.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    apart = _difference(F.col("pos"), F.col("neg"), pos, neg) >= min_errors
    chosen = bins.filter((F.col("pos") + F.col("neg") >= min_docs) & apart).toPandas().sort_values("bin")
    ratio = np.log((chosen["pos"].to_numpy(float) + 1) / (totals[1] + 2)) - np.log((chosen["neg"].to_numpy(float) + 1) / (totals[0] + 2))
    # The cut is found on ids alone, so no task gathers texts.
    h = F.xxhash64(F.lit(4), "doc_id")
    cut = rows.select(h.alias("h")).orderBy("h").limit(fit_rows).agg(F.max("h")).first()[0]
    sample = rows.filter(h <= cut).select("text", "label", h.alias("h"))
    sample = persist_table(sample.mapInArrow(_finder(chosen["bin"].to_numpy()), "h long, label int, found array<int>"), "fit")
    sizes = sample.select("h", F.size("found").alias("n")).toPandas().sort_values("h")
    fits = sizes["h"][sizes["n"].cumsum() <= fit_entries]
    last = int(fits.max()) if len(fits) else int(sizes["h"].min())
    taken = sample.filter(F.col("h") <= last).orderBy("h").select("label", "found").toArrow()
    found = taken.column("found").combine_chunks()
    starts = np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy())]).astype(np.int64)
    fit, bias = _logistic(found.flatten().to_numpy(), starts, ratio, taken.column("label").to_numpy().astype(float), ridge)
    weights = np.zeros(1 << BIN_BITS)
    weights[chosen["bin"].to_numpy()] = fit * ratio
    return Model(weights, bias)


def _difference(pos: Column, neg: Column, all_pos: Column, all_neg: Column) -> Column:
    """How far the shares of documents in the two classes are apart, in standard errors."""
    p = (pos + neg + 1.0) / (all_pos + all_neg + 2.0)
    return F.abs(pos / all_pos - neg / all_neg) / F.sqrt(p * (1 - p) * (1 / all_pos + 1 / all_neg))


def _count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with memory_returned():
        counts, finder = np.zeros((2, 1 << BIN_BITS), np.int32), Finder(np.ones(1 << BIN_BITS, bool))
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[1 if label else 0, finder.of(text.as_py())] += 1
        bins = np.flatnonzero(counts.any(axis=0)).astype(np.int32)
        for at in range(0, len(bins), 50_000):
            some = bins[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[1, some]), pa.array(counts[0, some])], ["bin", "pos", "neg"])


def _finder(bins: np.ndarray):
    """Finds the numbers, among sorted ``bins``, of those a text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            wanted = np.zeros(1 << BIN_BITS, bool)
            wanted[bins] = True
            finder = Finder(wanted)
            for batch in batches:
                found = [np.searchsorted(bins, finder.of(t.as_py())).astype(np.int32) for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["h", "label", "found"])

    return run


class _Rows:
    """A sparse matrix: row i has, in the columns ``found[starts[i]:starts[i+1]]``, these columns' ``scale``."""

    def __init__(self, found: np.ndarray, starts: np.ndarray, scale: np.ndarray):
        self.scale, self.n = scale, len(starts) - 1
        # Portions of rows, so that no temporary array is as long as ``found``.
        ends = np.unique(np.append(np.searchsorted(starts, np.arange(0, starts[-1], 1 << 20)), [0, self.n]))
        self.parts = []
        for first, last in zip(ends[:-1], ends[1:]):
            row = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(starts[first : last + 1]))
            self.parts.append((first, last, row, found[starts[first] : starts[last]]))

    def times(self, w: np.ndarray) -> np.ndarray:
        w, out = w * self.scale, np.zeros(self.n)
        for first, last, row, column in self.parts:
            out[first:last] = np.bincount(row, w[column], last - first)
        return out

    def transposed_times(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.scale))
        for first, last, row, column in self.parts:
            out += np.bincount(column, g[first:last][row], len(out))
        return out * self.scale


def _logistic(found: np.ndarray, starts: np.ndarray, ratio: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps, each solved by conjugate gradients.

    A step is solved only as far as the slope that is left deserves. The bias is hardly
    shrunk. Columns without an entry get the mean of the other weights.
    """
    x = _Rows(found, starts, ratio)
    w, shrink, first = np.zeros(len(ratio) + 1), np.full(len(ratio) + 1, ridge), None
    shrink[-1] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x.times(w[:-1]) + w[-1], -30, 30)))
        r = np.maximum(p * (1 - p), 1e-6)
        slope = np.append(x.transposed_times(y - p), (y - p).sum()) - shrink * w
        norm = slope @ slope
        first = first or norm
        if norm <= 1e-10 * first:
            break
        enough = norm * min(0.1, np.sqrt(norm / first)) ** 2
        step, rest, along = np.zeros_like(w), slope.copy(), slope
        for _ in range(60):
            if norm <= enough:
                break
            v = r * (x.times(along[:-1]) + along[-1])
            curved = np.append(x.transposed_times(v), v.sum()) + shrink * along
            length = norm / (along @ curved)
            step += length * along
            rest -= length * curved
            norm, before = rest @ rest, norm
            along = rest + norm / before * along
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    known = np.bincount(found, minlength=len(ratio)) > 0
    if known.any():
        w[:-1][~known] = w[:-1][known].mean()
    return w[:-1], float(w[-1])


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` from 0 to 1 of every row; a null text counts as empty.

    Columns of ``docs`` called score are replaced.
    """

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with memory_returned():
            finder = Finder(model.weights != 0)
            for part in texts:
                sums = np.array([model.bias + model.weights[finder.of(t or "")].sum() for t in part], float)
                yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -700, 700))))

    kept = [named(c) for c in docs.columns if c.lower() != "score"]
    return docs.select(*kept, score(named(text_col)).alias("score"))
