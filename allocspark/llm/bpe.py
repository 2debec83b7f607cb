"""Byte-pair encoding and decoding of whole texts with a public vocabulary.

Texts go through one merge engine that is built from the merges of the tokenizer file. A text of
more than ``LEAF_CHARS`` code points without a place to cut is encoded as a tree: it is halved
until the leaves are short, the leaves are encoded in parallel by Spark, and every join is mended
by encoding a window around it, which grows until its first tokens agree with the left side and
its last tokens with the right side. Two encodings that share a token at the same place can be
spliced there, since a sequence of tokens is the encoding of its text exactly when every two
neighbours are the encoding of theirs.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from allocspark.llm.common import free_name, replace_columns, schema_with, text_or_empty

#: Code points of a leaf; longer texts are cut at white space, or halved where there is none.
LEAF_CHARS = 16_384
#: Code points on each side of a join in the first window.
FIRST_WINDOW = 64
END = "</w>"
#: How the file's splitter cuts a text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Code points whose normal form is plain lower case in every Unicode version: Latin without controls.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7E\xA1-įĲ-ɏ]*+")
#: Stretches that white space parts: it lies in no token and takes part in no merge.
RUNS = regex.compile(r"[^ \t\n\r]+")
SPECIALS = regex.compile(r"<\|startoftext\|>|<\|endoftext\|>")
RESULTS = ["n_tokens", "ids", "decoded"]


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordEncoder:
    """Encoder of a vocabulary with word ends, lower case and byte-level symbols.

    The merge engine gets each word with a blank behind it. Merges of a byte with that blank come
    first, which gives the word's last symbol, then those of the file in their order. Text outside
    ``PLAIN`` is normalised and split by the tokenizer itself.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        model = json.loads(self.library.to_str())["model"]
        symbols = byte_symbols()

        def raw(token: str) -> bytes:
            ends = token.endswith(END)
            return bytes(symbols[c] for c in (token[: -len(END)] if ends else token)) + b" " * ends

        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b]) + b" ": 256 + b for b in range(256)}
        for place, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranks[raw(left) + raw(right)] = 512 + place
        if len(ranks) != 512 + len(model["merges"]):
            raise ValueError("this vocabulary makes a token in two ways; its merges can't be ranked by token")
        self.ids = np.zeros(len(ranks), np.uint32)
        for token, number in model["vocab"].items():
            self.ids[ranks[raw(token)]] = number
        self.tokens = np.empty(1 + max(self.library.get_vocab().values()), object)
        for token, number in self.library.get_vocab().items():
            self.tokens[number] = token
        # Bytes of a token without the mark of a word's end, and whether it has one.
        self.n_bytes = np.array([len(t) - len(END) * t.endswith(END) if t else 0 for t in self.tokens], np.int64)
        self.ends = np.array([bool(t) and t.endswith(END) for t in self.tokens])
        self.engine = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def words(self, text: str) -> list[str]:
        """The words of a text, each in byte-level merges of its own."""
        return self.split(text.lower() if PLAIN.fullmatch(text) else self.library.normalizer.normalize_str(text))

    def split(self, normal: str) -> list[str]:
        """The words of a normalised text."""
        if PLAIN.fullmatch(normal):
            return PIECES.findall(normal)
        symbols = _symbol_bytes()
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(symbols[c] for c in word).decode("utf-8") for word, _ in found]

    def word_ids(self, words: list[str]) -> np.ndarray:
        return self.ids[self.engine.encode_to_numpy(" ".join(words) + " ")] if words else np.zeros(0, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as the library gives them; the special tokens' strings give their ids."""
        if "<|" not in text:
            return self.word_ids(self.words(text))
        parts, start = [], 0
        for match in SPECIALS.finditer(text):
            parts += [self.word_ids(self.words(text[start:match.start()])),
                      np.array([self.library.token_to_id(match[0])], np.uint32)]
            start = match.end()
        return np.concatenate([*parts, self.word_ids(self.words(text[start:]))])

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.tokens[ids].tolist())

    def ends_at(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.n_bytes[ids])


@functools.lru_cache(maxsize=1)
def _symbol_bytes() -> dict[str, int]:
    return byte_symbols()


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cut(text: str, leaf: int = LEAF_CHARS) -> list[tuple[str, bool]]:
    """(piece, joined) of a normalised text: pieces of at most ``leaf`` code points. ``joined`` pieces
    go on in the middle of an unsplit run, so that their join has to be mended."""
    pieces, extends = [], False
    for match in RUNS.finditer(text):
        if len(match[0]) > leaf:
            size = -(-len(match[0]) // -(-len(match[0]) // leaf))
            pieces += [(match[0][i:i + size], i > 0) for i in range(0, len(match[0]), size)]
            extends = False
        elif extends and len(pieces[-1][0]) + len(match[0]) < leaf:
            pieces[-1] = (f"{pieces[-1][0]} {match[0]}", False)
        else:
            pieces.append((match[0], False))
            extends = True
    return pieces or [("", False)]


def join(codec: WordEncoder, left: np.ndarray, right: np.ndarray, left_text: bytes, right_text: bytes,
         window: int = FIRST_WINDOW) -> np.ndarray:
    """Ids of ``left_text + right_text``, unsplit lower-case bytes, from the ids of both sides."""
    left_ends, right_ends = codec.ends_at(left), codec.ends_at(right)
    whole = left_text + right_text
    while True:
        begin, end = max(0, len(left_text) - window), min(len(right_text), window)
        while begin and whole[begin] & 0xC0 == 0x80:
            begin -= 1
        while end < len(right_text) and right_text[end] & 0xC0 == 0x80:
            end += 1
        middle = codec.word_ids(codec.split(whole[begin:len(left_text) + end].decode("utf-8")))
        ends = begin + codec.ends_at(middle)
        starts = ends - codec.n_bytes[middle]
        place, stop = None, None
        if begin == 0:
            place = (0, 0)
        else:
            at = {int(e - n): i for i, (e, n) in enumerate(zip(left_ends, codec.n_bytes[left])) if e - n >= begin}
            for i, token in enumerate(middle):
                if (j := at.get(int(starts[i]))) is not None and left[j] == token and ends[i] < len(left_text):
                    place = (j, i)
                    break
        if end == len(right_text):
            stop = (len(right), len(middle))
        elif place:
            shifted = len(left_text) + right_ends
            at = {int(e): i for i, e in enumerate(shifted) if e <= len(left_text) + end}
            for i in range(len(middle) - 1, place[1], -1):
                if (j := at.get(int(ends[i]))) is not None and right[j] == middle[i] and starts[i] > len(left_text):
                    if ends[i] < len(left_text) + end:  # the window's own end is no word's end
                        stop = (j + 1, i + 1)
                        break
        if place and stop:
            return np.concatenate([left[: place[0]], middle[place[1]: stop[1]], right[stop[0]:]])
        window *= 2


def concatenate(codec: WordEncoder, parts: list[tuple[np.ndarray, bytes, bool]], window: int = FIRST_WINDOW) -> np.ndarray:
    """Ids of a text from its leaves. Those of an unsplit run are joined pairwise, as a tree, so that
    ids are copied log2(leaves) times; others just follow one another."""
    runs: list[list[tuple[np.ndarray, bytes]]] = []
    for ids, text, joined in parts:
        if joined:
            runs[-1].append((ids, text))
        else:
            runs.append([(ids, text)])
    for place, run in enumerate(runs):
        while len(run) > 1:
            pairs = zip(run[::2], [*run[1::2], None])
            run = [(join(codec, a[0], b[0], a[1], b[1], window), a[1] + b[1]) if b else a for a, b in pairs]
        runs[place] = run
    return np.concatenate([run[0][0] for run in runs])


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  leaf: int = LEAF_CHARS) -> DataFrame:
    """Every row of ``df`` without the text, with n_tokens, ids (binary, little-endian unsigned
    32-bit integers) and decoded (string).

    A null or empty text has no tokens and an empty decoded text. Rows are independent: repeated
    ids and texts give a row each. Input columns named like a result column are replaced.
    """
    kept = replace_columns(df, [*RESULTS, text_col])
    columns = [F.col(f"`{c}`") for c in kept.columns]
    rows = df.select(*columns, text_or_empty(text_col).alias("text"))
    schema = schema_with(kept, n_tokens="long", ids="binary", decoded="string")

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            ids = [codec.encode(text) for text in batch.column(batch.num_columns - 1).to_pylist()]
            yield _result(codec, batch.columns[:-1], batch.schema.names[:-1], ids)

    whole = rows.where(F.length("text") <= leaf).mapInArrow(short, schema)
    return whole.unionByName(_encode_long(rows.where(F.length("text") > leaf), path, schema, leaf))


def _result(codec: WordEncoder, columns, names, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(map(len, ids), pa.int64()), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
         pa.array([codec.decode(i) for i in ids], pa.string())], names=[*names, "n_tokens", "ids", "decoded"])


def _encode_long(rows: DataFrame, path: str, schema, leaf: int) -> DataFrame:
    """Leaves of long texts are dealt out and encoded; a text's leaves meet again to be joined."""
    names = rows.columns[:-1]
    key = free_name(rows, "_row")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            for place, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                row = pa.RecordBatch.from_arrays(batch.columns[:-1], names=names).slice(place, 1)
                pieces = list(_normal_pieces(codec, text, leaf))
                yield pa.RecordBatch.from_arrays(
                    [*[column.take(pa.array([0] * len(pieces), pa.int32())) for column in row.columns],
                     pa.array([i for i, _ in enumerate(pieces)], pa.int64()), pa.array([p[0] for p in pieces], pa.string()),
                     pa.array([p[1] for p in pieces], pa.bool_()), pa.array([p[2] for p in pieces], pa.int64())],
                    names=[*names, "_place", "_piece", "_joined", "_special"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            ids = [np.array([special], np.uint32) if special >= 0 else codec.word_ids(codec.split(piece))
                   for piece, special in zip(batch.column("_piece").to_pylist(), batch.column("_special").to_pylist())]
            yield batch.append_column("_ids", pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()))

    def joined(table: pa.Table) -> pa.Table:
        codec = encoder(path)
        table = table.sort_by("_place")
        parts = [(np.frombuffer(i, "<u4"), p.encode("utf-8"), j) for i, p, j in zip(
            table.column("_ids").to_pylist(), table.column("_piece").to_pylist(), table.column("_joined").to_pylist())]
        ids = concatenate(codec, parts)
        first = table.slice(0, 1).combine_chunks()
        columns = [first.column(name).combine_chunks() for name in names]
        return pa.Table.from_batches([_result(codec, columns, names, [ids])])

    numbered = rows.withColumn(key, F.monotonically_increasing_id()).select(key, *[F.col(f"`{c}`") for c in rows.columns])
    inner = numbered.drop("text").schema
    names = [key, *names]
    piece_schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in inner)
    piece_schema += "`_place` long, `_piece` string, `_joined` boolean, `_special` long"
    dealt = numbered.mapInArrow(leaves, piece_schema).repartition(F.col(key), F.col("_place"))
    coded = dealt.mapInArrow(encoded, piece_schema + ", `_ids` binary")
    out = f"`{key}` long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return coded.groupBy(key).applyInArrow(joined, out).drop(key)


def _normal_pieces(codec: WordEncoder, text: str, leaf: int) -> Iterator[tuple[str, bool, int]]:
    """(normalised piece, joined, special id or -1) of a text; special tokens are pieces of their own."""
    start = 0
    for match in [*SPECIALS.finditer(text), None]:
        part = text[start: match.start() if match else len(text)]
        # The whole part is normalised at once: a cut can't part a letter from its accents.
        normal = part.lower() if PLAIN.fullmatch(part) else codec.library.normalizer.normalize_str(part)
        for piece, joined in cut(normal, leaf):
            yield piece, joined, -1
        if match:
            yield "", False, codec.library.token_to_id(match[0])
            start = match.end()


def with_digests(encoded: DataFrame) -> DataFrame:
    """ids and decoded replaced by ids_sha256 and decoded_sha256 (lowercase hex)."""
    kept = replace_columns(encoded, ["ids", "decoded", "ids_sha256", "decoded_sha256"])
    return encoded.select(*[F.col(f"`{c}`") for c in kept.columns], F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def reference(path: str, text: str | None) -> tuple[str, str, int]:
    """(ids_sha256, decoded_sha256, n_tokens) of a text straight from the library, for tests."""
    codec = encoder(path)
    ids = codec.library.encode(text or "", add_special_tokens=False).ids
    decoded = codec.library.decode(ids, skip_special_tokens=False)
    return (hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode("utf-8")).hexdigest(), len(ids))
