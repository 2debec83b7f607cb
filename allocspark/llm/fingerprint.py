"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch keeps the ``SIZE`` smallest distinct 64-bit hashes of a text's shingles and whether that
is all of them. Sketches of parts merge to the sketch of the whole, and two sketches estimate
resemblance, containment and the number of distinct shingles. Written as text, a sketch is the
base64 of its hashes, behind ``=`` if it has all of the text's hashes and ``<`` if only the smallest.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from allocspark.llm.common import text_or_empty
from allocspark.llm.minhash import shingles

SIZE = 128
WORDS = 5
#: Bytes of text in a range of documents, as a rule; with more than MOST_RANGES of these, ranges get larger.
RANGE_BYTES, MOST_RANGES = 4_000_000, 20_000
#: Rows sampled for each range to find where it begins.
SAMPLED = 10


class Sketch:
    """The smallest hashes, sorted; ``whole`` if no others exist."""

    __slots__ = ("hashes", "whole", "size")

    def __init__(self, hashes: np.ndarray, whole: bool, size: int = SIZE):
        self.hashes, self.whole, self.size = hashes, whole, size

    @classmethod
    def of(cls, text: str | None, words: int = WORDS, size: int = SIZE) -> Sketch:
        found = shingles(text, words)
        return cls(found[:size], len(found) <= size, size)

    def merge(self, other: Sketch) -> Sketch:
        """The sketch of both shingle sets together."""
        size = min(self.size, other.size)
        union = np.union1d(self.hashes, other.hashes)
        return Sketch(union[:size], self.whole and other.whole and len(union) <= size, size)

    def distinct(self) -> float:
        """Number of distinct shingles: exact if all hashes are there, else from the largest kept."""
        if self.whole:
            return float(len(self.hashes))
        return (len(self.hashes) - 1) / (float(self.hashes[-1]) / 2.0**64)

    def _common(self, other: Sketch) -> tuple[int, int]:
        """(of the smallest hashes of the union, how many both have; how many there are)."""
        union = self.merge(other)
        if union.whole:
            return len(np.intersect1d(self.hashes, other.hashes, assume_unique=True)), len(union.hashes)
        kept = union.hashes
        both = np.isin(kept, self.hashes, assume_unique=True) & np.isin(kept, other.hashes, assume_unique=True)
        return int(both.sum()), len(kept)

    def resemblance(self, other: Sketch) -> float:
        """Estimated intersection over union; two empty sets are alike, an empty and another are not."""
        common, total = self._common(other)
        return common / total if total else 1.0

    def containment(self, other: Sketch) -> float:
        """Estimated share of this text's shingles that the other has."""
        common, total = self._common(other)
        if not len(self.hashes):
            return 1.0
        return min(1.0, common / total * self.merge(other).distinct() / self.distinct())

    def __str__(self) -> str:
        return "<="[self.whole] + base64.b64encode(self.hashes.astype("<u8").tobytes()).decode("ascii")

    @classmethod
    def parse(cls, written: str, size: int = SIZE) -> Sketch:
        return cls(np.frombuffer(base64.b64decode(written[1:]), "<u8"), written[0] == "=", size)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                 size: int = SIZE) -> DataFrame:
    """(id, n_distinct, fingerprint) of every row; a null or empty text has the fingerprint ``=``.

    Rows are independent, equal texts have equal fingerprints. Other input columns are left out.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Sketch.of(text, words, size) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.distinct() for s in found], pa.float64()), pa.array(map(str, found), pa.string())],
                names=[id_col, "n_distinct", "fingerprint"])

    rows = df.select(F.col(f"`{id_col}`"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_distinct double, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def edit_probe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
               size: int = SIZE) -> DataFrame:
    """Every document beside its edited text and the next document, by ascending id.

    Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The last document is followed by the first. Ids are whole numbers of up to 64 bits. Null texts are
    empty; null ids come first, rows of one id go by a hash of their text. An empty table gives an empty
    result.

    The texts are shuffled once, to ranges of (id, hash of the text) of about ``RANGE_BYTES``, so many
    documents under one id or without one are split too; only equal rows always share a range. Of a
    range's first row a copy goes to the range before, where the last row needs its follower.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    ranges = min(MOST_RANGES, max(1, -(-int(total) // RANGE_BYTES)))
    borders = _borders(rows, ranges)
    last = max(0, len(borders) - 1)
    nulls = np.array([tie for i, tie in borders if i is None], np.int64)
    ids, ties = (np.array([b[k] for b in borders if b[0] is not None], np.int64) for k in (0, 1))

    def place(column: pa.Array, tie: np.ndarray) -> np.ndarray:
        """Range of each row: the last border at or before it, the first range also before any border."""
        unknown = column.is_null().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        spot = np.searchsorted(ids, values, "right") - 1
        low = np.searchsorted(ids, values, "left")
        for i in np.flatnonzero((spot >= low) & ~unknown):  # rows with the id of a border
            spot[i] = low[i] + np.searchsorted(ties[low[i]:spot[i] + 1], tie[i], "right") - 1
        spot = np.where(unknown, np.searchsorted(nulls, tie, "right") - 1, spot + len(nulls))
        return np.maximum(spot, 0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by range; one of those that begin a range once more, behind the range before."""
        for batch in batches:
            tie = batch.column(2).to_numpy()
            spot = place(batch.column(0), tie)
            yield pa.RecordBatch.from_arrays([pa.array(spot, pa.int64()), pa.array(np.zeros(len(spot), bool)), *batch.columns], names=names)
            keys = zip(batch.column(0).to_pylist(), tie.tolist())
            begins = {int(at): i for i, (key, at) in enumerate(zip(keys, spot)) if borders[at] == key}
            if begins:
                some = batch.take(pa.array(begins.values(), pa.int32()))
                before = pa.array([at - 1 if at else last for at in begins], pa.int64())
                yield pa.RecordBatch.from_arrays([before, pa.array(np.ones(len(begins), bool)), *some.columns], names=names)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for spot, behind, doc_id, text, _ in zip(*(column.to_pylist() for column in batch.columns)):
                if held is not None and held[0] != spot:
                    raise ValueError("a range ended without the document that follows")
                if held is None and behind:
                    continue
                sketch = Sketch.of(text, words, size)
                if held is not None:
                    fresh = edited(held[2], text)
                    own, new = held[3], Sketch.of(fresh, words, size)
                    for column, value in zip(out, (
                            held[1], len(held[2]), hashlib.sha256(fresh.encode("utf-8")).hexdigest(), str(own), str(new),
                            own.resemblance(new), own.resemblance(sketch))):
                        column.append(value)
                held = None if behind else (spot, doc_id, text, sketch)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=results)

    names = ["range", "behind", "id", "text", "tie"]
    results = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    dealt = rows.mapInArrow(deal, "range long, behind boolean, id long, text string, tie long")
    ordered = dealt.repartitionById(len(borders) or 1, F.col("range").cast("int")).sortWithinPartitions("range", "behind", F.asc_nulls_first("id"), "tie", "text")
    return ordered.mapInArrow(probe, f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")


def _borders(rows: DataFrame, ranges: int) -> list[tuple[int | None, int]]:
    """Where ranges of about equal bytes begin, the first with the first row. Sampled rows, the ones with
    the smallest hashes, tell it; so many rows come to the driver at most, without their texts."""
    key = F.struct(F.col("id").isNotNull().alias("known"), "id", "tie")
    first = rows.agg(F.min(key).alias("k")).first()["k"]
    if first is None:
        return []
    sample = rows.select("id", "tie", F.octet_length("text").alias("bytes")).orderBy(F.xxhash64("id", "tie")).limit(SAMPLED * ranges).collect()
    found, seen = {(first["id"], first["tie"])}, 0
    total = sum(r["bytes"] + 64 for r in sample)
    for r in sorted(sample, key=lambda r: (r["id"] is not None, r["id"] or 0, r["tie"])):
        if seen * ranges // total != (seen + r["bytes"] + 64) * ranges // total:
            found.add((r["id"], r["tie"]))
        seen += r["bytes"] + 64
    return sorted(found, key=lambda b: (b[0] is not None, b[0] or 0, b[1]))
