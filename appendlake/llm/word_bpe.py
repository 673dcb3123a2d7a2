"""BPE encoding by speculation: longest matches, tested pair by pair, merged only where the test fails."""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlake.llm.inputs import memory_returned, named
from appendlake.llm.packing import _by_bytes

LAST = 256  # a symbol is a byte of a word, plus this if it is the word's last and the file marks ends
STOP = 512  # stands between words
NONE = 1 << 60  # rank of a pair that no merge joins
SHORT = 48  # symbols of a word that is merged by looking for the least rank each time
PLAIN_FORM = ["NFC", "Replace", "Lowercase"]
ENTRY_BYTES = 200  # what a remembered chunk costs beside its content


def byte_chars() -> dict[str, int]:
    """The character that stands for each byte in byte-level files: itself if it is printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merges of a BPE vocabulary as arrays over token ids.

    ``rank`` is the place of the merge that makes a token (-1: a symbol), ``left`` and
    ``right`` are its two parts. Every merge must come after those of its parts, so that
    merging a word uses ranks in ascending order.
    """

    def __init__(self, vocab: dict[str, int], merges: Sequence[Sequence[str]], suffix: str):
        size = max(vocab.values()) + 1
        self.size = size
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.symbol = np.full(STOP, -1, np.int64)
        parts: dict[int, tuple[int, ...]] = {}
        for char, byte in byte_chars().items():
            for at, name in [(byte, char)] + [(byte + LAST, char + suffix)] * bool(suffix):
                if name not in vocab:
                    raise ValueError(f"no token for byte {byte}")
                self.symbol[at] = vocab[name]
                parts[vocab[name]] = (at,)
        self.rank_of: dict[int, int] = {}
        self.token_of: list[int] = []
        for rank, (a, b) in enumerate(merges):
            x, y, new = vocab[a], vocab[b], vocab[a + b]
            if new in parts or x not in parts or y not in parts:
                raise ValueError(f"merge {rank} is not the one merge of its token, after those of its parts")
            parts[new] = parts[x] + parts[y]
            self.rank[new], self.left[new], self.right[new] = rank, x, y
            self.rank_of[x * size + y] = rank
            self.token_of.append(new)
        pairs = sorted(self.rank_of.items())
        self.pair_key = np.array([k for k, _ in pairs], np.int64)
        self.pair_rank = np.array([r for _, r in pairs], np.int64)
        self._grow_trie(parts)

    def _grow_trie(self, parts: dict[int, tuple[int, ...]]) -> None:
        """A trie of the tokens that merging gives for their own text; no other one can be in a result."""
        whole = np.array([t for t in parts if self.rank[t] >= 0], np.int64)
        own = whole[self._merged_apart(self.left[whole], self.right[whole])]
        own = set(own.tolist()) | {t for t in parts if self.rank[t] < 0}
        # A token with a part that is not its own text's result is none either; parts come first.
        for t in sorted(own, key=lambda t: self.rank[t]):
            if self.rank[t] >= 0 and not (int(self.left[t]) in own and int(self.right[t]) in own):
                own.discard(t)
        edges: dict[int, int] = {}
        token = [-1]
        for t in own:
            node = 0
            for s in parts[t]:
                key = node * (STOP + 1) + s
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                node = edges[key]
            token[node] = t
        keys = np.array(list(edges), np.int64)
        order = np.argsort(keys)
        self.edge, self.child = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.token = np.array(token, np.int64)

    def _ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a number above all ranks if there is none."""
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves token ``a`` before token ``b`` as the two tokens."""
        none = np.full(len(a), NONE)
        return self._apart(a.copy(), b.copy(), none, none.copy())

    def _merged_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge joins ends of ``a`` and ``b`` before both are whole."""
        top = np.full(len(a), NONE)
        x, y, until_x, until_y = a.copy(), b.copy(), top.copy(), top.copy()
        self._undo(x, y, until_x, until_y, np.arange(len(a)))
        out = np.ones(len(a), bool)
        go = (x != a) | (y != b)
        out[go] = self._apart(x[go], y[go], until_x[go], until_y[go])
        return out

    def _undo(self, x: np.ndarray, y: np.ndarray, until_x: np.ndarray, until_y: np.ndarray, rows: np.ndarray) -> None:
        """Take back the later of the merges that made ``x`` and ``y``; of equal ones the right one, which comes later."""
        rx, ry = self.rank[x[rows]], self.rank[y[rows]]
        one = rows[rx > ry]
        until_x[one] = self.rank[x[one]]
        x[one] = self.right[x[one]]
        two = rows[(rx <= ry) & (ry >= 0)]
        until_y[two] = self.rank[y[two]]
        y[two] = self.left[y[two]]

    def _apart(self, x: np.ndarray, y: np.ndarray, until_x: np.ndarray, until_y: np.ndarray) -> np.ndarray:
        """All pairs walk back through their merges together, until a merge across shows up or only symbols are left.

        ``x`` stands at the border until the merge ``until_x``, ``y`` until ``until_y``. A
        merge of the two happens if its turn comes before both; among equal ranks the
        leftmost goes first.
        """
        out = np.ones(len(x), bool)
        rows = np.arange(len(x))
        while len(rows):
            across = self._ranks(x[rows], y[rows])
            joined = (across < until_x[rows]) & (across <= until_y[rows]) & (across < NONE)
            out[rows[joined]] = False
            rows = rows[~joined]
            rows = rows[(self.rank[x[rows]] >= 0) | (self.rank[y[rows]] >= 0)]
            self._undo(x, y, until_x, until_y, rows)
        return out

    def longest(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token, number of symbols) of the longest token that begins at each place; ``STOP`` has none."""
        found, length = np.full(len(symbols), -1, np.int64), np.ones(len(symbols), np.int64)
        rows = np.flatnonzero(symbols != STOP)
        node, depth = np.zeros(len(rows), np.int64), 0
        padded = np.append(symbols, STOP)
        while len(rows):
            key = node * (STOP + 1) + padded[np.minimum(rows + depth, len(symbols))]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            hit = self.edge[at] == key
            rows, node = rows[hit], self.child[at[hit]]
            depth += 1
            token = self.token[node]
            ends = token >= 0
            found[rows[ends]] = token[ends]
            length[rows[ends]] = depth
        return found, length

    def proposed(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, their places) of the words that begin at ``starts``, longest match first, all words together.

        Every place jumps behind its longest token. The places on the chains of the
        starts are found by doubling the jumps.
        """
        token, length = self.longest(symbols)
        stop = symbols == STOP
        jump = np.arange(len(symbols)) + np.where(stop, 0, length)
        on = np.zeros(len(symbols), bool)
        on[starts] = True
        known = 0
        while (count := int(on.sum())) != known:
            known = count
            on[jump[np.flatnonzero(on)]] = True
            jump = jump[jump]
        places = np.flatnonzero(on & ~stop)
        return token[places], places

    def merged(self, tokens: list[int]) -> list[int]:
        """Exact merging of one word's symbol tokens: the lowest rank first, of equal ones the leftmost."""
        if len(tokens) > SHORT:
            return self._merged_long(tokens)
        tokens, size, rank_of = list(tokens), self.size, self.rank_of
        ranks = [rank_of.get(a * size + b, NONE) for a, b in zip(tokens, tokens[1:])]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            tokens[i : i + 2] = [self.token_of[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of.get(tokens[i - 1] * size + tokens[i], NONE)
            if i < len(ranks):
                ranks[i] = rank_of.get(tokens[i] * size + tokens[i + 1], NONE)
        return tokens

    def _merged_long(self, tokens: list[int]) -> list[int]:
        """The same with a heap."""
        tokens, size, rank_of = list(tokens), self.size, self.rank_of
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        heap = [(rank_of.get(a * size + b, NONE), i, a, b) for i, (a, b) in enumerate(zip(tokens, tokens[1:]))]
        heap = [h for h in heap if h[0] != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= len(tokens) or tokens[j] != b:
                continue
            tokens[i], tokens[j] = self.token_of[rank], -1
            after[i] = after[j]
            if after[i] < len(tokens):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(tokens):
                    a, b = tokens[k], tokens[after[k]]
                    rank = rank_of.get(a * size + b, NONE)
                    if rank != NONE:
                        heapq.heappush(heap, (rank, k, a, b))
        return [t for t in tokens if t >= 0]


class WordCoder:
    """Encodes and decodes by a BPE file of the tokenizers library.

    The library's own normalizer and word splitter make the words; special strings of the
    file stay tokens of their own. Distinct words are encoded together: ``proposed`` tokens
    stand if each pair of neighbours in a word is ``compatible``, which no other sequence
    of tokens can be (were a merge to reach over some border, the first such merge would
    also happen between the two tokens alone). Words that fail are merged exactly.
    """

    def __init__(self, path: str, kept_bytes: int = 128_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, decoder = spec["model"], spec["decoder"]
        if model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"] or model["byte_fallback"] or model["ignore_merges"]:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        if spec["post_processor"] or (decoder and decoder["type"] != "ByteLevel"):
            raise ValueError(f"{path}: has another way to put tokens together")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special strings that depend on what stands around them")
        self.special = special
        self.cut_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        # Where blanks are dropped, a text can be cut at them and each chunk encoded once.
        self.drops_blanks = not self.split(self.normalize(" \n")) and len(self.split(self.normalize("a b"))) == 2
        self.plain_words = self._plain_words(spec)
        suffix = model["end_of_word_suffix"] or ""
        self.marks_ends = bool(suffix)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, suffix)
        chars = byte_chars()
        self.byte_of = np.full(max(map(ord, chars)) + 1, -1, np.int64)
        for char, byte in chars.items():
            self.byte_of[ord(char)] = byte
        self.byte_of[ord("\n")] = STOP
        names = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in special.items()}
        # Without a decoder the library joins the tokens as they are spelled, with blanks.
        self.between = b"" if decoder else b" "
        self.shown = {i: bytes(chars[c] for c in s) if decoder and set(s) <= set(chars) else s.encode() for i, s in names.items()}
        self.kept_bytes = kept_bytes
        self._forget()
        self.words = self.failed = 0

    def _plain_words(self, spec: dict) -> re.Pattern | None:
        """A pattern of the words of printable ASCII in lower case, for files that only compose, lower-case
        and split by one pattern; there such characters stay what they are. A line end is a match too."""
        form, split = (spec[k] and (spec[k].get(n) or [spec[k]]) for k, n in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))
        if not form or not split or [f["type"] for f in form] != PLAIN_FORM or form[1]["pattern"] != {"Regex": r"\s+"}:
            return None
        if [p["type"] for p in split] != ["Split", "ByteLevel"] or split[1]["use_regex"] or split[1]["add_prefix_space"]:
            return None
        if split[0]["behavior"] != "Removed" or not split[0]["invert"] or "Regex" not in split[0]["pattern"] or not self.drops_blanks:
            return None
        pattern = split[0]["pattern"]["Regex"].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        return None if r"\p" in pattern else re.compile(pattern + r"|\n", re.ASCII)

    def _forget(self) -> None:
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.used = 0

    def _words(self, chunk: str, number: dict[str, int]) -> list[int]:
        """Numbers of the words of a chunk by the library; a special token is its id below zero."""
        own: list[int] = []
        for i, part in enumerate(self.cut_special.split(chunk) if self.cut_special else [chunk]):
            if i % 2:
                own.append(-1 - self.special[part])
            elif part:
                own.extend(number.setdefault(w, len(number)) for w, _ in self.split(self.normalize(part)) if w)
        return own

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word, which is spelled in the characters of bytes."""
        text = "\n".join(words) + "\n"
        symbols = self.byte_of[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        ends = np.flatnonzero(symbols == STOP)
        starts = np.concatenate([[0], ends[:-1] + 1])
        if self.marks_ends:
            symbols[ends[ends > starts] - 1] += LAST
        tokens, places = self.merges.proposed(symbols, starts)
        word = np.searchsorted(ends, places)
        same = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(tokens[same] * self.merges.size + tokens[same + 1], return_inverse=True)
        fits = self.merges.compatible(pairs // self.merges.size, pairs % self.merges.size)
        bad = np.unique(word[same[~fits[which]]])
        bounds = np.searchsorted(word, np.arange(len(words) + 1))
        tokens, bounds = tokens.tolist(), bounds.tolist()
        out = [tokens[a:b] for a, b in zip(bounds, bounds[1:])]
        each = np.where(symbols == STOP, -1, self.merges.symbol[np.minimum(symbols, STOP - 1)]).tolist()
        for i, a, b in zip(bad.tolist(), starts[bad].tolist(), ends[bad].tolist()):
            out[i] = self.merges.merged(each[a:b])
        self.words += len(words)
        self.failed += len(bad)
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Remember ids and shown bytes of chunks."""
        number: dict[str, int] = {}
        plain, odd = [], []
        for c in chunks:
            is_plain = self.plain_words and c.isascii() and c.isprintable() and not any(s in c for s in self.special)
            (plain if is_plain else odd).append(c)
        content: list[list[int]] = [[]] if plain else []
        for word in self.plain_words.findall("\n".join(plain).lower()) if plain else []:
            if word == "\n":
                content.append([])
            else:
                content[-1].append(number.setdefault(word, len(number)))
        content += [self._words(c, number) for c in odd]
        chunks = plain + odd
        words = self.encode_words(list(number)) if number else []
        for chunk, own in zip(chunks, content):
            ids = [t for n in own for t in (words[n] if n >= 0 else (-1 - n,))]
            entry = np.array(ids, "<u4").tobytes(), self.between.join(map(self.shown.__getitem__, ids))
            self.known[chunk] = entry
            self.used += 4 * len(chunk) + len(entry[0]) + len(entry[1]) + ENTRY_BYTES

    def of(self, texts: pa.Array) -> tuple[list[bytes], list[bytes]]:
        """(ids as little-endian 32-bit numbers, decoded text in UTF-8) of each text."""
        if self.drops_blanks:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            chunks, ends = lists.flatten(), np.asarray(lists.offsets)
        else:
            chunks, ends = texts, np.arange(len(texts) + 1)
        coded = chunks.dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if self.used > self.kept_bytes:
            self._forget()
        new = [c for c in distinct if c not in self.known]
        for at in range(0, len(new), 20_000):
            self._learn(new[at : at + 20_000])
        entries = [self.known[c] for c in distinct]
        ids, shown = [e[0] for e in entries], [e[1] for e in entries]
        empty = np.array([not e[0] for e in entries], bool)
        all_ids, all_shown = [], []
        for a, b in zip((ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist()):
            own = which[a:b]
            own = own[~empty[own]].tolist()
            all_ids.append(b"".join([ids[i] for i in own]))
            all_shown.append(self.between.join([shown[i] for i in own]).decode("utf-8", "replace").encode())
        return all_ids, all_shown

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids, special tokens included, as the library shows it."""
        return self.between.join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    """One coder per file and worker process, with what it remembers."""
    return WordCoder(path)


def coded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", text_at_once: int = 4_000_000) -> DataFrame:
    """(``doc_id``, ``n_tokens``, ``ids``, ``decoded``) of every row, whole texts.

    ``ids`` are little-endian unsigned 32-bit numbers, the same as the library's for the
    file without added special tokens; ``decoded`` is what it decodes them to. A null text
    is empty and has no ids. Null and repeated doc_ids stay as they are, further columns
    are not looked at. A task works on ``text_at_once`` bytes of text; a longer text is
    encoded alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            own = coder(path)
            for batch in batches:
                for part in _by_bytes(batch, text_at_once):
                    ids, shown = own.of(part.column(1).cast(pa.string()))
                    n_tokens = pa.array([len(i) // 4 for i in ids], pa.int64())
                    decoded = pa.array(shown, pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([part.column(0), n_tokens, pa.array(ids, pa.binary()), decoded], ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def decoded(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``doc_id``, ``decoded``) of rows with ``ids`` as ``coded`` gives them; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with memory_returned():
            own = coder(path)
            for batch in batches:
                for part in _by_bytes(batch, 4_000_000):
                    texts = [own.decode(np.frombuffer(i, "<u4").tolist()) for i in part.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    ids = F.coalesce(named(ids_col), F.lit(b""))
    return rows.select(named(id_col).cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(run, "doc_id long, decoded string")
