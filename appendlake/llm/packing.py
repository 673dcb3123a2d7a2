"""Tokens of documents, packed into sequences of a fixed length."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import memory_returned, named
from appendlake.session import persist_table

CHUNKS_AT_ONCE = 50
GROUP_TOKENS = 8_000_000
GROUP_PIECES = 100_000

# Two blanks side by side: there the plain cut would not hold. And the mark itself.
_BLANK = "\\t-\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_ODD_SPACES = f"[{_BLANK}][{_BLANK}]|\\x00"
_CUT = re.compile(r"(?<=\S) (?=\S)")


class ChunkTokens:
    """Token ids of texts by a byte-level BPE file, each distinct chunk encoded once.

    A text is cut before single spaces between two non-blank characters. No token of
    such a vocabulary reaches over such a place, so the ids of the chunks, one after
    another, are the ids of the text; special strings inside a text stay the library's.
    The same holds on both sides of a single line end.
    """

    def __init__(self, path: str, kept: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        # A character of an entry is a byte; added strings are plain text.
        self.n_bytes = np.zeros(max(known.values(), default=0) + 1, np.int64)
        self.n_bytes[list(known.values())] = [len(entry) for entry in known]
        for i, added in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[i] = len(added.content.encode())
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = array("I")
        self.starts = array("q", [0])

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, the end of each text's ids)."""
        odd = pc.match_substring_regex(texts, _ODD_SPACES).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring(pc.replace_substring(texts, "\n", "\0\n\0"), " ", "\0 ")
        lists = pc.split_pattern(marked, "\0")
        chunks, counts = lists.flatten(), np.diff(np.asarray(lists.offsets))
        if odd.any():
            chunks, counts = self._with_odd(texts, odd, chunks, counts)
        chunks = chunks.dictionary_encode()
        which = self._numbers(chunks.dictionary.to_pylist())[chunks.indices.to_numpy()]
        ids, starts = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.starts, np.int64)
        size = starts[which + 1] - starts[which]
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(starts[which] - total[:-1], size)
        at += np.arange(total[-1])
        return ids[at], total[np.cumsum(counts)]

    def _with_odd(self, texts: pa.Array, odd: np.ndarray, chunks: pa.Array, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The chunks with those of oddly spaced texts cut with care."""
        ends = np.cumsum(counts)
        out, new = [], counts.copy()
        at = 0
        for i in np.flatnonzero(odd).tolist():
            start = ends[i] - counts[i]
            out.append(chunks.slice(at, start - at))
            parts = _CUT.split(texts[i].as_py())
            parts = parts[:1] + [" " + x for x in parts[1:]]
            out.append(pa.array(parts, chunks.type))
            new[i] = len(parts)
            at = ends[i]
        out.append(chunks.slice(at))
        return pa.concat_arrays(out), new

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        """Numbers of distinct chunks; ``starts`` says where the ids of a number are."""
        if len(self.number) > self.kept:
            self._forget()
        new = [c for c in chunks if c not in self.number]
        spaced = [c[0:1] == " " and not c[1:2].isspace() and not c[-1].isspace() for c in new]
        self._add([c for c, is_spaced in zip(new, spaced) if is_spaced], CHUNKS_AT_ONCE)
        self._add([c for c, is_spaced in zip(new, spaced) if not is_spaced], 1)
        return np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))

    def _add(self, new: list[str], together: int) -> None:
        """Encodes ``together`` chunks as one text. The places between them are such where texts may
        be cut, so the bytes that the tokens stand for tell the chunks' ids apart."""
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            texts = ["".join(some[i : i + together]) for i in range(0, len(some), together)]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), np.uint32)
            if together == 1:
                ends = np.cumsum([len(f) for f in found])
            else:
                bytes_to, places = np.cumsum(self.n_bytes[ids]), np.cumsum([len(c.encode()) for c in some])
                ends = np.searchsorted(bytes_to, places) + 1
                if len(ids) != ends[-1] or (bytes_to[ends - 1] != places).any():
                    self._add(some, 1)
                    continue
            self.number.update(zip(some, range(len(self.starts) - 1, len(self.starts) - 1 + len(some))))
            self.starts.frombytes((len(self.ids) + ends).astype(np.int64).tobytes())
            self.ids.frombytes(ids.tobytes())


def _by_bytes(batch: pa.RecordBatch, at_once: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about so many bytes of text (column 1); a longer text is alone."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        limit = (ends[at - 1] if at else 0) + at_once
        end = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text", kept_chunks: int = 1_000_000, text_at_once: int = 8_000_000) -> DataFrame:
    """(``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``[, ``ids``]) of every row.

    A document is its ids and then ``end_id``; a null text is empty, so it is one piece
    of ``end_id`` alone. A task keeps the ids of up to ``kept_chunks`` distinct chunks and
    works on ``text_at_once`` bytes of text; less of both takes less memory and more time.
    What is longer than ``capacity`` is cut into pieces of that
    length, of which the first takes the rest. Repeated rows and null doc_ids are pieces
    like others.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            tokens = ChunkTokens(path, kept_chunks)
            for batch in batches:
                for part in _by_bytes(batch, text_at_once):
                    ids, ends = tokens.of(part.column(1).cast(pa.string()))
                    rows: list[tuple] = []
                    start = 0
                    for doc, end in zip(part.column(0).to_pylist(), ends.tolist()):
                        own = np.append(ids[start:end], np.uint32(end_id)).astype("<u4")
                        start = end
                        cut = len(own) % capacity or capacity
                        bounds = [0, *range(cut, len(own) + 1, capacity)]
                        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                            rows.append((doc, i, a, b - a, zlib.crc32(own[a:b].tobytes()), own[a:b]))
                    columns = list(zip(*rows)) if rows else [()] * 6
                    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                    if with_ids:
                        flat = np.concatenate(columns[5]) if rows else np.zeros(0, np.uint32)
                        offsets = np.concatenate([[0], np.cumsum([len(c) for c in columns[5]])])
                        arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    return docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first.

    A length goes into the open bin that leaves the sum over residual gaps of the squared
    number of open bins with that gap smallest; full bins do not count. A new bin is
    opened only if no open one has room, which keeps their number near the least.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in order.tolist():
        s = int(lengths[i])
        with_room = count[s:capacity]
        if with_room.any():
            change = count[: capacity - s] - with_room + 1.0
            change[0] = 0.5 - with_room[0]
            change[with_room == 0] = np.inf
            gap = s + int(change.argmin())
            which = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, which = capacity, made
            made += 1
        bins[i], offsets[i] = which, capacity - gap
        if gap > s:
            count[gap - s] += 1
            open_bins[gap - s].append(which)
    return bins, offsets


def packed(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: places without gaps, from 0.

    Pieces are dealt at random over groups of about ``GROUP_TOKENS`` tokens, each of
    which one task packs by ``sum_of_squares``. A group of thousands of sequences is
    filled to within about one sequence of the least number, so more groups (more data)
    cost one sequence in thousands. Only lengths travel to the groups; the places are
    joined back by a key that the written pieces fix.
    """
    cut = persist_table(cut.withColumn("key", F.monotonically_increasing_id()), "pieces")
    tokens, n = cut.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-tokens // GROUP_TOKENS), -(-n // GROUP_PIECES))
    dealt = cut.select("key", F.col("length").cast("int").alias("length"), F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        bins, offsets = sum_of_squares(group["length"].to_numpy(), capacity)
        return pd.DataFrame({"key": group["key"], "sequence_id": group["part"] + parts * bins, "offset": offsets})

    placed = dealt.groupBy("part").applyInPandas(pack, "key long, sequence_id long, offset long")
    return cut.join(placed, "key").drop("key")
