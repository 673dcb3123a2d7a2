"""Token counts by a deterministic transducer, compiled from a BPE vocabulary."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import memory_returned, named

SPACE = "▁"
NORMAL = 1
KEPT_STATES = 400_000
KEPT_CHUNKS = 1_000_000


class Transducer:
    """States and transitions of the tokenizer, made when a text first needs them.

    The encoding of a prefix of a word is fixed by its last token: exactly one token that
    ends there can follow the last token of what stands before it, which only the two
    tokens decide. So a state holds the longest end of the prefix with which a piece
    begins and, for each place in it, the last token there and how many tokens the number
    up to there lies behind. A transition on a character leads to the next state and
    carries the change of the number. Characters without a piece become one token per
    byte and end a word.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        inner = [p.piece for p in model.pieces if p.type == NORMAL and SPACE in p.piece[1:] and p.piece.strip(SPACE)]
        if spec.name != "identity" or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or inner or not model.trainer_spec.byte_fallback:
            raise ValueError(f"{path}: not a plain BPE vocabulary with byte fallback")
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.chars = {c for c in self.rank if len(c) == 1}
        self.starts = {p[:n] for p in self.rank for n in range(1, len(p))}
        self.fits: dict[tuple[str, str], bool] = {}
        self.runs = {0: 0}
        self._reset()

    def _reset(self) -> None:
        start = ("", (("", 0),))
        self.number = {start: 0}
        self.states = [start]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def merged(self, text: str) -> list[str]:
        """Pieces by merging, the best pair first; the rule that the transducer compiles."""
        parts: list[str] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if 0 <= i and right[i] < len(parts):
                both = parts[i] + parts[right[i]]
                if both in self.rank:
                    heapq.heappush(heap, (self.rank[both], i, both))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] and right[i] < len(parts) and parts[i] + parts[right[i]] == both:
                gone = right[i]
                parts[i], parts[gone] = both, ""
                right[i] = right[gone]
                if right[i] < len(parts):
                    left[right[i]] = i
                offer(left[i])
                offer(i)
        return [p for p in parts if p]

    def _follows(self, before: str, token: str) -> bool:
        pair = (before, token)
        if pair not in self.fits:
            if len(self.fits) > KEPT_CHUNKS:
                self.fits.clear()
            self.fits[pair] = self.merged(before + token) == ([before, token] if before else [token])
        return self.fits[pair]

    def _move(self, state: int, char: str) -> tuple[int, int]:
        text, past = self.states[state]
        text += char
        for n in range(len(text), 0, -1):
            before, fewer = past[n - 1]
            token = text[-n:]
            if token in self.rank and self._follows(before, token):
                break
        change = fewer + 1
        while text and text not in self.starts:
            text = text[1:]
        key = (text, ((token, 0), *[(t, r - change) for t, r in past[: len(text)]]))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        out = self.moves[state][char] = (self.number[key], change)
        return out

    def count(self, word: str) -> int:
        """Tokens of ``word``, which stands between two places that no token reaches over."""
        if len(self.states) > KEPT_STATES:
            self._reset()
        state = total = 0
        moves = self.moves
        for char in word:
            move = moves[state].get(char)
            if move is None:
                if char not in self.chars:
                    total += len(char.encode())
                    state = 0
                    continue
                move = self._move(state, char)
            state = move[0]
            total += move[1]
        return total

    def _lone_space(self, word: str) -> bool:
        """Whether the space before ``word`` stays a token of its own."""
        head = SPACE + next(re.finditer(".*", "".join(c if c in self.chars else "\n" for c in word)))[0]
        state, last = 0, []
        for char in head:
            state = (self.moves[state].get(char) or self._move(state, char))[0]
            last.append(self.states[state][1][0][0])
        at = len(head)
        while at > 1:
            at -= len(last[at - 1])
        return at == 1

    def _spaces(self, n: int) -> int:
        if n not in self.runs:
            self.runs[n] = len(self.merged(SPACE * n))
        return self.runs[n]

    def count_spaced(self, text: str) -> int:
        """Tokens of a whole text with any runs of spaces; merges of spaces come last."""
        total = 0
        for run, word in re.findall(f"([ {SPACE}]+)([^ {SPACE}]*)", " " + text if text else ""):
            n = len(run)
            if not word:
                total += self._spaces(n)
            elif n == 1:
                total += self.count(SPACE + word)
            else:
                lone = self._lone_space(word)
                total += self.count(SPACE + word) - lone + self._spaces(n - 1 + lone)
        return total


class Counter:
    """Counts per text, each distinct chunk of a task run through the transducer once.

    A chunk is what stands between single spaces. The space before it sends every state
    to one state, so a chunk's state map is a constant and maps compose by adding their
    counts: the prefix scan over the chunks of many texts is a cumulative sum.
    """

    def __init__(self, path: str):
        self.transducer = Transducer(path)
        self.known: dict[str, int] = {}

    def of(self, texts: pa.Array) -> np.ndarray:
        odd = pc.match_substring_regex(texts, f"  |^ | $|{SPACE}").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        chunks = lists.flatten().dictionary_encode()
        if len(self.known) > KEPT_CHUNKS:
            self.known.clear()
        per = np.array([self._chunk(c) for c in chunks.dictionary.to_pylist()], np.int64)
        scan = np.concatenate([[0], np.cumsum(per[chunks.indices.to_numpy()] if len(per) else per)])
        ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        counts = scan[ends[1:]] - scan[ends[:-1]]
        for i in np.flatnonzero(odd).tolist():
            counts[i] = self.transducer.count_spaced(texts[i].as_py())
        return np.where(pc.equal(texts, "").to_numpy(zero_copy_only=False), 0, counts)

    def _chunk(self, chunk: str) -> int:
        found = self.known.get(chunk)
        if found is None:
            found = self.known[chunk] = self.transducer.count(SPACE + chunk)
        return found


def counted(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``) of every row, whole texts.

    A null text is empty and has no tokens. Null and repeated doc_ids stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            counter = Counter(path)
            for batch in batches:
                for at in range(0, batch.num_rows, 2000):
                    part = batch.slice(at, 2000)
                    texts = part.column(1).cast(pa.string())
                    counts = counter.of(texts)
                    n_bytes = pc.binary_length(texts).cast(pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column(0), n_bytes, pa.array(counts), pa.array(counts > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
