"""Byte-pair encoding and decoding by speculation and verification.

A word is first cut greedily into the longest tokens that fit. Two neighbouring
tokens are *compatible* if merging in rank order would never have joined symbols
across their border; a proposal in which every neighbouring pair is compatible
and every token is reachable is the encoding. All pairs of a batch are tested at
once with array operations, and only words with an incompatible pair are merged
exactly. Encoded words are remembered per worker, up to a bound.

Vocabularies are files of the ``tokenizers`` library, named by a path. Its
normaliser and pre-tokeniser are asked only for texts with characters beyond
U+024F; the rest is split by the same patterns here.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import text_slices

NEVER = np.int64(1) << 40
MAX_WORDS = 300_000
SHORT = 40
UNCOMMON = re.compile("[^\x00-\u024f]")
# The split patterns of the two kinds of vocabulary, with the letters, digits and blanks up to U+024F.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
BLANKS = "\t-\r \x85\xa0"
WORD_PIECES = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{BLANKS}{LETTERS}{DIGITS}]+"
BYTE_PIECES = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+|"
    f"[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tables of one vocabulary, and the words encoded so far."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or model["unk_token"] or model["byte_fallback"] or model["ignore_merges"]:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        self.lowers = spec["normalizer"] is not None
        self.spaced = spec["decoder"] is None
        self.pieces = re.compile(WORD_PIECES if self.suffix else BYTE_PIECES)
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

        vocab: dict[str, int] = model["vocab"]
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [""] * self.size
        for token, i in chain(vocab.items(), self.special.items()):
            self.strings[i] = token
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.suffix] for c in letters]
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.zeros(self.size, np.int64)
        self.right = np.zeros(self.size, np.int64)
        self.merges: dict[int, int] = {}  # pair to rank; the merges' tokens are in ``made``
        self.made: list[int] = []
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            self.merges[x * self.size + y] = r
            self.made.append(made)
            self.rank[made], self.left[made], self.right[made] = r, x, y
        keys = np.array(list(self.merges), np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array(list(self.merges.values()), np.int64)[order]

        self.whole: dict[bytes, int] = {}
        self.part: dict[bytes, int] = {}
        for token, i in vocab.items():
            ends = bool(self.suffix) and token.endswith(self.suffix)
            into = self.whole if ends or not self.suffix else self.part
            into[bytes(self.byte_of[c] for c in (token[:-len(self.suffix)] if ends else token))] = i
        if not self.suffix:
            self.part = self.whole
        self.longest_whole = max(map(len, self.whole))
        self.reach: dict[bytes, int] = {}  # the longest token that begins with these two bytes
        for token in self.part:
            self.reach[token[:2]] = max(len(token), self.reach.get(token[:2], 1))
        made = np.flatnonzero(self.rank >= 0)
        self.reachable = np.ones(self.size, bool)
        self.reachable[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        self.words: dict[str, bytes] = {}

    def compatible(self, a: np.ndarray, b: np.ndarray, joined_at: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` stay apart until ``joined_at`` (for ever, if not given).

        Walks back in time from the finished tokens: the symbol at the border that
        was made later is taken apart, and each pair that once met at the border
        must not have a merge that would have come before.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(a), bool)
        until_a = np.full(len(a), NEVER) if joined_at is None else joined_at.astype(np.int64)
        until_b = until_a.copy() if joined_at is None else until_a - 1  # the merge that joins them is no fault
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)
            bad = (rank < until_a[live]) & (rank <= until_b[live])
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            undo_a = go & (rx > ry)
            undo_b = go & ~undo_a
            i, j = live[undo_a], live[undo_b]
            until_a[i], a[i] = rx[undo_a], self.right[x[undo_a]]
            until_b[j], b[j] = ry[undo_b], self.left[y[undo_b]]
            live = live[go]
        return good

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest-match tokens."""
        out, at, n = [], 0, len(word)
        whole, part, reach = self.whole.get, self.part.get, self.reach.get
        while at < n:
            if n - at <= self.longest_whole and (i := whole(word[at:])) is not None:
                out.append(i)
                break
            for end in range(min(n - 1, at + reach(word[at:at + 2], 1)), at, -1):
                if (i := part(word[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
        return out

    def merged(self, word: bytes) -> list[int]:
        """Exact merging in rank order, leftmost first."""
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        if len(ids) > SHORT:
            return self.merged_by_heap(ids)
        size, rank, made, never = self.size, self.merges.get, self.made, 1 << 40
        ranks = [rank(x * size + y, never) for x, y in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != never:
            i = ranks.index(least)
            ids[i] = token = made[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] * size + token, never)
            if i < len(ranks):
                ranks[i] = rank(token * size + ids[i + 1], never)
        return ids

    def merged_by_heap(self, ids: list[int]) -> list[int]:
        """The same for long words, with a heap of pairs."""
        n, size, rank = len(ids), self.size, self.merges.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank(ids[i] * size + ids[j]) != r:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := rank(ids[k] * size + ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
        return [i for i in ids if i >= 0]

    def learn(self, words: list[str]) -> None:
        """Encode distinct words: propose, verify all neighbouring pairs at once, merge the failing words exactly."""
        raw = [w.encode("utf-8") for w in words]
        proposals = [self.propose(w) for w in raw]
        lengths = np.array([len(p) for p in proposals])
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        fails = np.zeros(len(words), bool)
        fails[owner[~self.reachable[flat]]] = True
        borders = np.flatnonzero(owner[1:] == owner[:-1])
        keys, back = np.unique(flat[borders] * self.size + flat[borders + 1], return_inverse=True)
        fails[owner[borders[~self.compatible(keys // self.size, keys % self.size)[back]]]] = True
        packed = flat.astype("<u4").tobytes()
        ends = (np.cumsum(lengths) * 4).tolist()
        for k, word in enumerate(words):
            if fails[k]:
                self.words[word] = np.array(self.merged(raw[k]), "<u4").tobytes()
            else:
                self.words[word] = packed[ends[k] - 4 * len(proposals[k]):ends[k]]

    def split(self, text: str) -> list[str]:
        """The pieces of a text without special strings."""
        if UNCOMMON.search(text) is None:
            return self.pieces.findall(text.lower() if self.lowers else text)
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(self.byte_of[c] for c in piece).decode("utf-8") for piece, _ in found]

    def encode(self, texts: list[str], specials: bool = True) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        parts: list[list[str | int]] = []
        for text in texts:
            if specials and self.cut is not None and "<|" in text and self.cut.search(text):
                own: list[str | int] = []
                for piece in self.cut.split(text):
                    own += [self.special[piece]] if piece in self.special else self.split(piece)
                parts.append(own)
            else:
                parts.append(self.split(text))
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        for i in self.special.values():
            self.words[i] = np.array([i], "<u4").tobytes()
        new = list(set(chain.from_iterable(parts)).difference(self.words))
        if new:
            self.learn(new)
        known = self.words.__getitem__
        return [b"".join(map(known, p)) for p in parts]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included. Without a decoder, tokens are joined by spaces."""
        tokens = map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())
        if self.spaced:
            return " ".join(tokens)
        byte_of = self.byte_of
        return bytes(byte_of[c] for c in "".join(tokens)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", *, decoded: bool = False) -> DataFrame:
    """Encode whole texts: ``(key, n_tokens, ids)``, with ``decoded`` the text the ids decode to.

    ``ids`` are little-endian unsigned 32-bit integers. Null texts count as empty
    and have no ids; repeated rows give repeated results; other columns are left
    out, whatever their names; an empty table gives an empty one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for keys, texts in text_slices(batches):
            ids = own.encode(texts)
            columns = [keys, pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            names = [key, "n_tokens", "ids"]
            if decoded:
                columns.append(pa.array([own.decode(i) for i in ids], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids binary" + ", decoded string" * decoded
    return df.select(key, text).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Decode ids as ``encode`` gives them: ``(key, decoded)``. Null ids count as none and give an empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            texts = [own.decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "decoded"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, ids).mapInArrow(run, f"`{key}` {kind}, decoded string")
