"""Packing of token streams into fixed windows by Karmarkar-Karp multiway differencing.

Every task encodes its own rows and packs them itself, so no text and no ids are shuffled. Whole
windows are cut off a document's front; what remains is cut into pieces of at most
``PIECE_TOKENS``, the last of them with a small piece cut off that serves to even windows out.
Pieces are gathered in groups that fill ``GROUP_WINDOWS`` windows but for ``SLACK`` tokens each,
and each group is divided over its windows: the two partial partitions with the largest imbalances
are merged again and again, the fullest windows of one with the emptiest of the other. Should a
window come out over its capacity, the group is divided again over one window more.
"""

from __future__ import annotations

import functools
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from allocspark.llm.bpe import byte_symbols
from allocspark.llm.common import text_or_empty

WINDOW = 1024
PIECE_TOKENS = 256
GROUP_WINDOWS = 64
SLACK = 3
#: A remainder's last piece gives this share of its tokens as a small piece.
SMALL_SHARE = 16
#: Ends every document.
SEPARATOR = 0
#: Fixed value: the splitter of byte-level vocabularies, and what it comes to between single blanks.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_SINGLE = SPLIT.replace(r"|\s+(?!\S)|\s+", r"|\s")
BLANKS = regex.compile(r"\s\s")


class ByteEncoder:
    """Encoder of a byte-level vocabulary whose ids follow the order of its merges."""

    def __init__(self, path: str):
        library = json.loads(Tokenizer.from_file(path).to_str())
        vocab, symbols = library["model"]["vocab"], byte_symbols()
        ranks = {bytes(symbols[c] for c in token): number for token, number in vocab.items()}
        for place, pair in enumerate(library["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if vocab[left + right] != 256 + place:
                raise ValueError("this vocabulary's ids don't follow its merges")
        self.special = {token["content"]: token["id"] for token in library["added_tokens"]}
        self.specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.engine = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.single = tiktoken.Encoding("single", pat_str=SPLIT_SINGLE, mergeable_ranks=ranks, special_tokens={})

    def _ordinary(self, text: str) -> np.ndarray:
        return (self.engine if BLANKS.search(text) else self.single).encode_to_numpy(text)

    def encode(self, text: str) -> np.ndarray:
        if "<|" not in text:
            return self._ordinary(text)
        parts, start = [], 0
        for match in self.specials.finditer(text):
            parts += [self._ordinary(text[start:match.start()]), np.array([self.special[match[0]]], np.uint32)]
            start = match.end()
        return np.concatenate([*parts, self._ordinary(text[start:])])


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def difference(sizes: list[int], windows: int) -> tuple[list[int], list[list[int]]]:
    """(sums, members) of ``windows`` groups of near-equal sums, by multiway differencing.

    A partial partition keeps its non-empty windows only, as sums above its emptiest window."""
    heap = [(-size, place, [size], [[place]]) for place, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, other_sums, other_members = heapq.heappop(heap)
        if len(sums) + len(other_sums) <= windows:
            if len(sums) < len(other_sums):
                sums, members, other_sums, other_members = other_sums, other_members, sums, members
            sums += other_sums
            members += other_members
        else:
            a = np.zeros(windows, np.int64)
            b = np.zeros(windows, np.int64)
            a[: len(sums)], b[: len(other_sums)] = sums, other_sums
            members += [[] for _ in range(windows - len(members))]
            other_members += [[] for _ in range(windows - len(other_members))]
            down, up = np.argsort(-a, kind="stable"), np.argsort(b, kind="stable")
            total = a[down] + b[up]
            members = [_both(members[i], other_members[j]) for i, j in zip(down.tolist(), up.tolist())]
            sums = total.tolist()
        if len(sums) == windows:
            least = min(sums)
            sums = [s - least for s in sums]
        made += 1
        heapq.heappush(heap, (-max(sums), made, sums, members))
    members = heap[0][3] if heap else []
    members += [[] for _ in range(windows - len(members))]
    return [sum(sizes[i] for i in group) for group in members], members


def _both(a: list[int], b: list[int]) -> list[int]:
    if len(a) < len(b):
        a, b = b, a
    a += b
    return a


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places of ``sizes`` in as few near-equal windows as differencing gives within ``capacity``."""
    if not sizes:
        return []
    windows = -(-sum(sizes) // capacity)
    while True:
        sums, members = difference(sizes, windows)
        if max(sums) <= capacity:
            return [group for group in members if group]
        windows += 1


def remainder_lengths(tokens: int) -> list[int]:
    lengths = [PIECE_TOKENS] * (tokens // PIECE_TOKENS)
    last = tokens % PIECE_TOKENS
    small = last // SMALL_SHARE
    return lengths + [n for n in (last - small, small) if n]


class _Packer:
    """Pieces of one task; ``done`` has their columns once their sequence is known."""

    def __init__(self, task: int, window: int, with_ids: bool):
        self.window, self.with_ids = window, with_ids
        self.target = max(1, GROUP_WINDOWS * (window - min(SLACK, window // 8)))
        self.sequence = task << 40
        self.pending: list[tuple] = []
        self.size = 0
        self.done: list[list] = [[] for _ in range(8)]

    def add(self, doc_id, tokens: np.ndarray) -> None:
        whole = len(tokens) // self.window * self.window
        for start in range(0, whole, self.window):
            self._place((doc_id, tokens, start, self.window), 0)
            self.sequence += 1
        start = whole
        for length in remainder_lengths(len(tokens) - whole):
            while length:
                taken = min(length, self.target - self.size)
                self.pending.append((doc_id, tokens, start, taken))
                self.size += taken
                start, length = start + taken, length - taken
                if self.size == self.target:
                    self.settle()

    def settle(self) -> None:
        """Packs the gathered group."""
        for group in balanced([piece[3] for piece in self.pending], self.window):
            offset = 0
            for place in group:
                self._place(self.pending[place], offset)
                offset += self.pending[place][3]
            self.sequence += bool(group)
        self.pending, self.size = [], 0

    def _place(self, piece: tuple, offset: int) -> None:
        doc_id, tokens, start, length = piece
        raw = tokens[start:start + length].tobytes()
        row = (doc_id, start, length, zlib.crc32(raw), len(tokens), self.sequence, offset, raw if self.with_ids else None)
        for column, value in zip(self.done, row):
            column.append(value)


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if
    wanted, ids (binary, little-endian unsigned 32-bit integers).

    Every document is its ids and the separator 0, so a null or empty text has one token. Each
    token lies in exactly one piece and each sequence has at most ``window`` tokens without gaps.
    Rows are independent: repeated ids and null ids are documents of their own. Other input columns
    are left out. A sequence never spans two input partitions; its id starts with the partition's
    number, so a task that runs again gives the same rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    out = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    rows = df.select(F.col(f"`{id_col}`"), text_or_empty(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, end = encoder(path), np.array([SEPARATOR], np.uint32)
        packer = _Packer(TaskContext.get().partitionId(), window, with_ids)
        id_type = None

        def taken() -> pa.RecordBatch:
            columns, packer.done = packer.done, [[] for _ in range(8)]
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.binary()))
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            return pa.RecordBatch.from_arrays(arrays, names=names[: len(arrays)])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(doc_id, np.concatenate([codec.encode(text), end]).astype("<u4", copy=False))
                if len(packer.done[0]) >= 10_000:
                    yield taken()
        packer.settle()
        if packer.done[0]:
            yield taken()

    return rows.mapInArrow(run, out + (", ids binary" if with_ids else ""))
