"""Alignment of two tokenizers over the same bytes: groups of tokens, links, and how common links are."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import memory_returned, named
from appendlake.llm.packing import _by_bytes
from appendlake.llm.word_bpe import byte_chars
from appendlake.session import persist_table

PLAIN, BYTE = 1, 6  # kinds of pieces in a piece model
SPACE = "▁"
CUT = re.compile(r"(?<=\S) (?=\S)")
# Texts in which a space may stand beside other white space, or at an end.
ODD = "[\\t-\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]{2}|^ | $"
ENTRY_BYTES = 400  # what a remembered chunk costs beside its content
LOW = 20  # bits of a B id in the key of a pair


def common_ends(a: np.ndarray, b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``a``, places in ``b``) of every number that both ascending lists hold.

    The shorter list drives. Each of its numbers is looked for in the longer one from a
    place known to lie before it (``start_b`` for each number of ``a``, ``start_a`` for each of
    ``b``), in steps that double until the number is passed, and then by halving the last
    step. All numbers search at the same time.
    """
    swap = len(a) > len(b)
    short, long, low = (b, a, start_a.copy()) if swap else (a, b, start_b.copy())
    if not len(short):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    high, step, left = low.copy(), 1, np.arange(len(short))
    padded = np.append(long, np.iinfo(np.int64).max)
    while len(left):
        left = left[padded[high[left]] < short[left]]
        low[left] = high[left] + 1
        high[left] = np.minimum(high[left] + step, len(long))
        step *= 2
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) // 2
        less = padded[middle] < short[left]
        low[left[less]] = middle[less] + 1
        high[left[~less]] = middle[~less]
        left = left[low[left] < high[left]]
    hit = padded[low] == short
    places = np.flatnonzero(hit)
    return (low[hit], places) if swap else (places, low[hit])


def groups(ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> pa.Array:
    """``a1,a2|b1`` of the tokens between neighbouring common ends: as many of a side as its places differ."""

    def joined(ids: np.ndarray, at: np.ndarray) -> pa.Array:
        shown = pa.array(ids).cast(pa.string())
        offsets = np.concatenate([[0], at + 1]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), shown), ",")

    return pc.binary_join_element_wise(joined(ids_a, at_a), joined(ids_b, at_b), "|")


class Aligner:
    """Aligns a byte-level BPE file (A) with a piece model (B).

    A encodes a space and the text, B the text, before which it puts the space itself. No
    token of either reaches over a single space between two characters that are not
    blank, so a text is cut there and each distinct chunk is aligned once. Chunks with
    other white space at their borders are not cut. A chunk whose tokens of one side do
    not spell its bytes leaves its whole text without tokens.
    """

    def __init__(self, path_a: str, path_b: str, kept_bytes: int = 96_000_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        inner = [p.piece for p in model.pieces if p.type == PLAIN and SPACE in p.piece[1:] and p.piece.strip(SPACE)]
        if spec.name != "identity" or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or inner:
            raise ValueError(f"{path_b}: pieces that reach over spaces, or a text that is changed")
        if len(model.pieces) >= 1 << LOW:
            raise ValueError(f"{path_b}: more than 2 to the {LOW} pieces")
        chars = byte_chars()
        vocab = self.a.get_vocab(with_added_tokens=False)
        # The bytes of each id; none for ids that stand for no text.
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for spelling, i in vocab.items():
            self.bytes_a[i] = bytes(chars[c] for c in spelling) if set(spelling) <= set(chars) else b""
        self.bytes_b = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else p.piece.replace(SPACE, " ").encode() if p.type == PLAIN else b""
            for p in model.pieces
        ]
        self.length_a, self.length_b = (np.array(list(map(len, side)), np.int64) for side in (self.bytes_a, self.bytes_b))
        self.kept_bytes = kept_bytes
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.shown: list[str] = []
        # Tokens of A, tokens of B and groups of each chunk; whether its bytes are spelled.
        self.sizes = array("q")
        self.spelled = array("b")
        self.links, self.link_starts = array("q"), array("q", [0])
        self.used = 0

    def encoded(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both sides, and whether both spell a space and the chunk; no ids where they do not."""
        side_a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)]
        side_b = self.b.encode(chunks, num_threads=1)
        good = np.ones(len(chunks), bool)
        whole = [(" " + c).encode() for c in chunks]
        for side, spelling in ((side_a, self.bytes_a), (side_b, self.bytes_b)):
            spell = spelling.__getitem__
            if b"".join([spell(i) for ids in side for i in ids]) != b"".join(whole):
                good &= [b"".join(map(spell, ids)) == w for ids, w in zip(side, whole)]
        # The parts of equal joined bytes could still differ from chunk to chunk.
        size = np.fromiter(map(len, whole), np.int64, len(whole))
        for side, lengths in ((side_a, self.length_a), (side_b, self.length_b)):
            ids, ends = _flat(side)
            total = np.concatenate([[0], np.cumsum(lengths[ids])])
            good &= np.diff(total[ends], prepend=0) == size
        for i in np.flatnonzero(~good).tolist():
            side_a[i], side_b[i] = [], []
        return side_a, side_b, good

    def _learn(self, chunks: list[str]) -> None:
        """Remember sizes, groups and links of new chunks, which are aligned on one axis of bytes."""
        side_a, side_b, good = self.encoded(chunks)
        (ids_a, ends_a), (ids_b, ends_b) = _flat(side_a), _flat(side_b)
        bytes_a, bytes_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        at_a, at_b = common_ends(bytes_a, bytes_b, np.repeat(ends_a - n_a, n_b), np.repeat(ends_b - n_b, n_a))
        shown = groups(ids_a, ids_b, at_a, at_b)
        # A chunk ends with a common end, so its groups are those up to its last token.
        last = np.searchsorted(at_a, ends_a - 1, side="right")
        per_chunk = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last]).astype(np.int32)), shown)
        first = len(self.shown)
        self.number.update(zip(chunks, range(first, first + len(chunks))))
        new = pc.binary_join(per_chunk, ";").to_pylist()
        self.shown += new
        self.sizes.frombytes(np.stack([n_a, n_b, np.diff(last, prepend=0)], axis=1).astype(np.int64).tobytes())
        self.spelled.frombytes(good.astype(np.int8).tobytes())
        self.links.frombytes((ids_a[at_a] << LOW | ids_b[at_b]).astype(np.int64).tobytes())
        self.link_starts.frombytes((last + self.link_starts[-1]).astype(np.int64).tobytes())
        self.used += 4 * sum(map(len, chunks)) + sum(map(len, new)) + 8 * len(at_a) + ENTRY_BYTES * len(chunks)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(rows of tokens of A, of B and groups; shown groups; links as pair keys; the end of each text's links)."""
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        chunks, counts = lists.flatten(), np.diff(np.asarray(lists.offsets))
        if odd.any():
            starts = np.cumsum(counts) - counts
            out, at = [], 0
            for i in np.flatnonzero(odd).tolist():
                out += [chunks.slice(at, starts[i] - at), pa.array(CUT.split(texts[i].as_py()), chunks.type)]
                at, counts[i] = starts[i] + counts[i], len(out[-1])
            chunks = pa.concat_arrays([*out, chunks.slice(at)])
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if self.used > self.kept_bytes:
            self._forget()
        new = [c for c in distinct if c not in self.number]
        for at in range(0, len(new), 5_000):
            self._learn(new[at : at + 5_000])
        numbers = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        own_sizes = np.frombuffer(self.sizes, np.int64).reshape(-1, 3)
        own_starts, own_links = np.frombuffer(self.link_starts, np.int64), np.frombuffer(self.links, np.int64)
        own_counts = own_sizes[:, 2]
        which = numbers[coded.indices.to_numpy()]
        ends = np.cumsum(counts)
        bad = np.concatenate([[0], np.cumsum(np.frombuffer(self.spelled, np.int8)[which] == 0)])
        good = (bad[ends] == bad[ends - counts]) & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        sizes = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(own_sizes[which], axis=0)])
        sizes = np.where(good[:, None], sizes[ends] - sizes[ends - counts], 0)
        shown = self.shown
        texts_shown = [";".join([shown[i] for i in which[e - c : e].tolist()]) if ok else "" for e, c, ok in zip(ends.tolist(), counts.tolist(), good.tolist())]
        which = which[np.repeat(good, counts)]
        # The links of all chunks, one after another.
        n = own_counts[which]
        total = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(own_starts[which] - total[:-1], n) + np.arange(total[-1])
        return sizes, texts_shown, own_links[at], np.cumsum(sizes[:, 2])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, and the end of each list."""
    ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(ends[-1]) if len(ends) else 0), ends


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per pair of files and worker process, with what it remembers."""
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", text_at_once: int = 4_000_000) -> DataFrame:
    """(``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``links``) of every row, whole texts.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3``: ids of both sides between common ends.
    ``links`` are the distinct pairs of tokens that end together, with the number of
    times (``uses``). A text that is null or empty, or whose bytes one side does not spell
    (for B: a text that holds its mark for a space), has no tokens: zeros, an empty text
    and no links. Null and repeated doc_ids stay as they are, further columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            own = aligner(path_a, path_b)
            for batch in batches:
                for part in _by_bytes(batch, text_at_once):
                    yield _aligned_batch(own, part)

    links = "links array<struct<a int, b int, uses int>>"
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, {links}")


def _aligned_batch(own: Aligner, part: pa.RecordBatch) -> pa.RecordBatch:
    sizes, shown, links, ends = own.of(part.column(1).cast(pa.string()))
    # Equal links of a text become one with a count.
    pairs, which = np.unique(links, return_inverse=True)
    text = np.repeat(np.arange(part.num_rows), np.diff(ends, prepend=0))
    keys, uses = np.unique(text * max(1, len(pairs)) + which, return_counts=True)
    text, pair = np.divmod(keys, max(1, len(pairs)))
    pair = pairs[pair] if len(pairs) else pair
    fields = [pa.array(x.astype(np.int32)) for x in (pair >> LOW, pair & ((1 << LOW) - 1), uses)]
    offsets = np.searchsorted(text, np.arange(part.num_rows + 1))
    structs = pa.StructArray.from_arrays(fields, ["a", "b", "uses"])
    numbers = [pa.array(sizes[:, i]) for i in (0, 1, 2, 2)]
    return pa.RecordBatch.from_arrays(
        [part.column(0), *numbers, pa.array(shown, pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
    )


def counted(rows: DataFrame, broadcast_pairs: int = 200_000) -> DataFrame:
    """``rows`` of ``aligned`` with ``n_best`` and ``count_sum`` instead of ``links``.

    A pair's count is the number of links that hold it in all rows. ``n_best`` are a row's
    links whose count is the highest of their B id, ties included; ``count_sum`` is the
    sum of the counts of a row's links. Rows without links have zeros.

    The links are counted per row before they travel. The most common pairs, at most
    ``broadcast_pairs`` of them, are broadcast, so that no pair that many rows hold is
    shuffled; the others are joined by their key.
    """
    rows = persist_table(rows.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    each = rows.select("_row", F.inline("links"))
    counts = persist_table(each.groupBy("a", "b").agg(F.sum("uses").alias("n")), "pair-counts")
    # A row per B id, so as many as the vocabulary has.
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    # A bin per half power of two: a few rows, whatever the data.
    level = F.floor(F.log2("n") * 2).cast("int")
    bins = counts.groupBy(level.alias("level")).count().collect()
    bound, total = 1 << 20, 0
    for row in sorted(bins, key=lambda r: -r["level"]):
        total += row["count"]
        if total > broadcast_pairs:
            break
        bound = row["level"]
    judged = counts.join(F.broadcast(best), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("is_best"))
    common, rare = judged.where(level >= bound), judged.where(level < bound)
    sums = (F.sum(F.col("uses") * F.col("is_best").cast("long")).alias("n_best"), F.sum(F.col("uses") * F.col("n")).alias("count_sum"))
    near = each.join(F.broadcast(common), ["a", "b"]).groupBy("_row").agg(*sums)
    far = each.join(F.broadcast(common.select("a", "b")), ["a", "b"], "left_anti").join(rare, ["a", "b"]).groupBy("_row").agg(*sums)
    per_row = near.unionByName(far).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = rows.drop("links").join(per_row, "_row", "left").drop("_row")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")})
