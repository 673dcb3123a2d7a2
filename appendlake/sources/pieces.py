"""Cut byte ranges of CSV files at record ends, so that one file parses in many tasks.

A newline ends a record unless it stands inside a quoted field. A quote opens a field
only as its first byte; inside, quotes come in pairs, and a single one closes the field;
elsewhere a quote is text. So a run of quotes acts on what is around it, "outside" or
"inside", in one of three ways: an odd run at the start of a field swaps the two, an odd
run elsewhere leads outside, an even run changes nothing. Such maps compose: every chunk
reports its map and its record ends for both cases, a window over the chunks of a range
tells each chunk its case, and each then owns the records that begin after its first
record end. That holds for any bytes, so every file can be cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appendlake.config import MIB
from appendlake.session import task_count
from appendlake.sources.files import read_blocks

QUOTE, NEWLINE, RETURN, COMMA = 34, 10, 13, 44

OUTSIDE, INSIDE = 0, 1

CHUNK_SUMMARY = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("range_start", T.LongType()),
        T.StructField("range_end", T.LongType()),
        T.StructField("chunk_start", T.LongType()),
        T.StructField("first_outside", T.LongType()),
        T.StructField("last_outside", T.LongType()),
        T.StructField("first_inside", T.LongType()),
        T.StructField("last_inside", T.LongType()),
        T.StructField("outside_to", T.LongType()),
        T.StructField("inside_to", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


class Scan:
    """Follows both cases through consecutive blocks. A run of quotes that reaches the end
    of a block is held back for the next one, so that it is seen whole."""

    def __init__(self, before: int) -> None:
        self.before = before
        self.state = [OUTSIDE, INSIDE]
        self.held = b""

    def feed(self, block: bytes, last: bool, more_quotes: int = 0) -> tuple[bytes, list[np.ndarray]]:
        """The bytes now settled, and the positions in them of the newlines that end records,
        for each case. ``more_quotes`` continue the run at the end of the last block."""
        text = self.held + block
        kept = len(text) if last else len(text.rstrip(b'"'))
        text, self.held = text[:kept], text[kept:]
        if not text:
            return text, [np.zeros(0, np.int64)] * 2
        data, quotes, newlines = _marks(text)
        runs = np.flatnonzero(np.diff(quotes, prepend=-2) != 1)
        sizes = np.diff(np.append(runs, quotes.size))
        starts = quotes[runs]
        if starts.size and quotes[-1] == data.size - 1:
            sizes[-1] += more_quotes
        left = np.where(starts > 0, data[starts - 1], self.before)
        if starts.size and starts[0] == 0 and self.before == QUOTE:  # the rest of an earlier run
            starts, sizes, left = starts[1:], sizes[1:], left[1:]
        odd, opens = (sizes & 1) == 1, (left == COMMA) | (left == NEWLINE)
        swaps = np.concatenate(([0], np.cumsum(odd & opens)))
        resets = np.concatenate(([-1], np.maximum.accumulate(np.where(odd & ~opens, np.arange(1, starts.size + 1), -1))))
        at = np.searchsorted(starts, newlines)
        ends = []
        for case in (OUTSIDE, INSIDE):
            known = resets >= 0
            after = np.where(known, swaps - swaps[np.maximum(resets, 0)], swaps + self.state[case]) & 1
            ends.append(newlines[after[at] == OUTSIDE])
            self.state[case] = int(after[-1])
        self.before = int(data[-1])
        return text, ends


def summarize_chunk(
    path: str, start: int, end: int, range_start: int, range_end: int, block_bytes: int
) -> tuple:
    """First and last record end and the case behind the chunk, for both cases before it."""
    before = next(read_blocks(path, start - 1, start, 1))[0] if start > range_start else NEWLINE
    first, last = [None, None], [None, None]
    scan, position = Scan(before), start
    remaining = end - start
    for block in read_blocks(path, start, end, block_bytes):
        remaining -= len(block)
        more = _quotes_from(path, end, range_end) if not remaining and block.endswith(b'"') else 0
        text, ends = scan.feed(block, not remaining, more)
        for case in (OUTSIDE, INSIDE):
            if ends[case].size:
                last[case] = position + int(ends[case][-1]) + 1
                if first[case] is None:
                    first[case] = position + int(ends[case][0]) + 1
        position += len(text)
    return first[0], last[0], first[1], last[1], *scan.state


def _quotes_from(path: str, start: int, end: int) -> int:
    """How many quotes stand from a position on."""
    found = 0
    for block in read_blocks(path, start, end, 4096):
        rest = block.lstrip(b'"')
        found += len(block) - len(rest)
        if rest:
            break
    return found


def _marks(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a block, and the positions of its quotes and newlines.

    Such bytes are rare, so eight at a time are looked at first.
    """
    data = np.frombuffer(block, np.uint8)
    marked = (data == QUOTE) | (data == NEWLINE)
    whole = marked.size // 8 * 8
    words = np.flatnonzero(marked[:whole].view(np.uint64))
    row, column = np.nonzero(marked[:whole].reshape(-1, 8)[words])
    at = np.concatenate((words[row] * 8 + column, whole + np.flatnonzero(marked[whole:])))
    is_quote = data[at] == QUOTE
    return data, at[is_quote], at[~is_quote]


def complete_end(path: str, start: int, end: int, block_bytes: int) -> int | None:
    """Where the last complete record of a range ends, for a range that is one chunk."""
    return summarize_chunk(path, start, end, start, end, block_bytes)[1]


def chunk_count(chunk_bytes: int) -> Column:
    """Number of chunks ``cut`` scans for a range, so that a caller can count along."""
    return F.ceil((F.col("range_end") - F.col("range_start")) / chunk_bytes).cast("bigint")


def _chunks(ranges: DataFrame, chunk_bytes: int, carry: Sequence[str]) -> DataFrame:
    starts = F.sequence("range_start", F.col("range_end") - 1, F.lit(chunk_bytes).cast("bigint"))
    return (
        ranges.where("range_end > range_start")
        .select(*carry, "source_path", "range_start", "range_end", F.explode(starts).alias("chunk_start"))
        .withColumn("chunk_end", F.least(F.col("chunk_start") + chunk_bytes, F.col("range_end")))
    )


def cut(
    ranges: DataFrame,
    chunk_bytes: int,
    block_bytes: int = 16 * MIB,
    keep_tail: bool = True,
    keep_errors: bool = False,
    carry: Sequence[str] = (),
    chunks_known: int | None = None,
) -> DataFrame:
    """Ranges ``(source_path, range_start, range_end)`` → pieces that begin and end at record ends.

    Adds ``piece_start``, ``piece_end`` and ``error``. Every range
    must begin at a record end. The bytes after the last record end are part of
    the last piece with ``keep_tail`` and of no piece without. A range that
    cannot be read fails the job, or with ``keep_errors`` stays one piece with
    its ``error`` set. ``carry`` names further columns of a range to keep.
    ``chunks_known`` is the sum of ``chunk_count``, if the caller has it.
    """
    chunks = _chunks(ranges, chunk_bytes, carry)
    tasks = task_count(chunks.count() if chunks_known is None else chunks_known)
    carry = list(carry)
    out = T.StructType([ranges.schema[c] for c in carry] + CHUNK_SUMMARY.fields)
    kept = [*carry, "source_path", "range_start", "range_end", "chunk_start"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for c in batch.to_dict("records"):
                bounds = [c[n] for n in ("chunk_start", "chunk_end", "range_start", "range_end")]
                try:
                    summary = (*summarize_chunk(c["source_path"], *bounds, block_bytes), None)
                except Exception as problem:
                    if not keep_errors:
                        raise
                    summary = (None, None, None, None, OUTSIDE, INSIDE, repr(problem))
                rows.append((*[c[n] for n in kept], *summary))
            yield pd.DataFrame(rows, columns=out.names, dtype=object)

    # Round-robin with a fixed number: the rows are tiny, the work behind each is not.
    summary = chunks.repartition(tasks).mapInPandas(scan, out)

    by_range = Window.partitionBy("source_path", "range_start")
    ordered = by_range.orderBy("chunk_start")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    resets = F.col("outside_to") == F.col("inside_to")
    swaps = F.coalesce(F.sum((~resets & (F.col("outside_to") == INSIDE)).cast("bigint")).over(earlier), F.lit(0))
    # The last chunk that leads both cases to one says where from to count the swaps.
    known = F.when(resets, F.struct("swaps", F.col("outside_to").alias("to")))
    since = F.last(known, ignorenulls=True).over(earlier)
    outside = F.col("case") == OUTSIDE
    placed = (
        summary.withColumn("swaps", swaps)
        .withColumn("known", since)
        .withColumn("case", F.coalesce(F.col("known.to") + F.col("swaps") - F.col("known.swaps"), F.col("swaps")) % 2)
        .withColumn("first_end", F.when(outside, F.col("first_outside")).otherwise(F.col("first_inside")))
        .withColumn("last_end", F.when(outside, F.col("last_outside")).otherwise(F.col("last_inside")))
        .withColumn("error", F.max("error").over(by_range))
        .withColumn("last_end", F.max("last_end").over(by_range))
    )
    is_first = F.col("chunk_start") == F.col("range_start")
    starts = placed.withColumn(
        "piece_start",
        F.when(is_first, F.col("range_start")).when(
            F.col("error").isNull(), F.col("first_end")
        ),
    ).where("piece_start is not null")
    stop = F.lit(keep_tail) | F.col("error").isNotNull()
    stop = F.when(stop, F.col("range_end")).otherwise(F.col("last_end"))
    return (
        starts.withColumn("piece_end", F.coalesce(F.lead("piece_start").over(ordered), stop))
        .where("piece_end > piece_start")
        .select(
            *carry, "source_path", "range_start", "range_end", "piece_start", "piece_end", "error"
        )
    )


def piece_records(path: str, start: int, end: int, batch_bytes: int = 8 * MIB) -> Iterator[pa.Array]:
    """The records of one piece as string arrays, without a Python object per record.

    Each block becomes one array, and its unfinished last record is carried into
    the next. The blocks are small, since each array is one message to the JVM.
    The line end of a record is removed, and an empty line is no record.
    """
    scan, carried, carried_bytes, remaining = Scan(NEWLINE), [], 0, end - start
    for block in read_blocks(path, start, end, batch_bytes):
        remaining -= len(block)
        at_end = remaining == 0
        text, (ends, _) = scan.feed(block, at_end)
        used = int(ends[-1]) + 1 if ends.size else 0
        if not ends.size and not at_end:
            carried.append(text)
            carried_bytes += len(text)
            continue
        whole = b"".join([*carried, text if at_end else text[:used]])
        yield _without_line_ends(whole, ends + carried_bytes)
        carried = [text[used:]]
        carried_bytes = len(text) - used


def _without_line_ends(text: bytes, newlines: np.ndarray) -> pa.Array:
    """Records of ``text``, of which each ends at a given newline or at the end of the text."""
    data = np.frombuffer(text, np.uint8)
    if data.size > np.iinfo(np.int32).max:
        raise ValueError(f"a record of {data.size} bytes is longer than a string can be")
    returns = newlines[newlines > 0] - 1
    returns = returns[data[returns] == RETURN]
    removed = np.concatenate((newlines, returns))
    ends = newlines + 1
    if not ends.size or ends[-1] < data.size:
        ends = np.append(ends, data.size)
    kept = np.ones(data.size, bool)
    kept[removed] = False
    shifts = np.searchsorted(np.sort(removed), ends)
    offsets = np.concatenate(([0], ends - shifts)).astype(np.int32)
    records = pa.StringArray.from_buffers(
        ends.size, pa.py_buffer(offsets), pa.py_buffer(data[kept])
    )
    filled = np.diff(offsets) > 0
    return records if filled.all() else records.filter(pa.array(filled))
