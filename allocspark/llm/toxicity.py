"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts and full-width forms to
Latin, invisible characters away, digits and signs that stand for letters inside a word back to
letters. Lexicon entries are words and word beginnings, so inflected forms match too; their weights
are log odds learned from labelled rows. An exception phrase (an entry and the word after or before
it) takes the weight of the entry inside it away. Every different word counts once, so a word that copies of
a line repeat is no more than one find. A text's score is a logistic function of its weight and of its
weight normalised by its length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from allocspark.llm.common import cut_lineage, replace_columns, schema_with, text_or_empty

#: At most so many labelled rows are learned from; of more, those with the smallest hash of their id.
TRAIN_ROWS = 20_000
#: At most so many entries and phrases are learned; the most telling ones are kept.
MAX_ENTRIES = 2_000
STEMS = (4, 5, 6, 7, 8)
#: A candidate is in at least so many toxic rows, and so many times likelier there; its likelihood
#: ratio against chance (G) is at least so much, which a word met by chance hardly reaches.
LEAST_ROWS, LEAST_ODDS, LEAST_G = 3, 8.0, 25.0
#: Letters that look like Latin ones, and signs that stand for letters.
LOOK_ALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
FOLDED = str.maketrans({**LOOK_ALIKES, **{c: None for c in INVISIBLE}})
_SIGNS = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|(?<![\w@$])[01345@$]+(?=[^\W\d_])")
_PLAIN = re.compile(r"[\x00-\x7fÀ-ɏ]*")
_HAS_SIGN = re.compile(r"[0134578@$!|]")
WORD = re.compile(r"[^\W\d_]+")
RESULTS = ["score", "predicted"]


def fold(text: str) -> str:
    if not _PLAIN.fullmatch(text):
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        text = text.translate(FOLDED)
    if _HAS_SIGN.search(text):
        text = _SIGNS.sub(lambda m: "".join(STANDS_FOR[c] for c in m[0]), text)
    return text


def held_out(id_col: str = "doc_id"):
    """Rows that nothing is learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0


@dataclass
class Lexicon:
    """weights by entry (``=word`` or a word beginning), exception phrases, and the logistic line."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    line: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    def __post_init__(self):
        patterns: dict[str, list] = {}
        for entry, weight in self.weights.items():
            key = entry.removeprefix("=")
            patterns.setdefault(key, [len(key), None, None])[1 if entry[0] == "=" else 2] = weight
        self.automaton = ahocorasick.Automaton() if patterns else None
        for key, (length, whole, stem) in patterns.items():
            self.automaton.add_word(key, (length, whole, stem))
        if patterns:
            self.automaton.make_automaton()

    def matches(self, folded: str) -> dict[int, tuple[int, float]]:
        """Word start -> (end of the longest match, its weight); one match a word counts."""
        found: dict[int, tuple[int, float]] = {}
        if self.automaton is None:
            return found
        size = len(folded)
        for last, (length, whole, stem) in self.automaton.iter(folded):
            start, end = last - length + 1, last + 1
            if start and folded[start - 1].isalpha():
                continue
            ends = end == size or not folded[end].isalpha()
            weight = whole if ends and whole is not None else stem
            if weight is not None and (start not in found or end > found[start][0]):
                found[start] = (end, weight)
        return found

    def weight(self, folded: str) -> float:
        """Sum over the different words that match outside an exception phrase."""
        found: dict[str, float] = {}
        for start, (_, weight) in self.matches(folded).items():
            if not self.exceptions or not (self.phrases(folded, start) & self.exceptions):
                found[WORD.match(folded, start)[0]] = weight
        return sum(found.values())

    @staticmethod
    def phrases(folded: str, start: int) -> set[str]:
        """The word at ``start`` with the word after and the word before it."""
        here = WORD.match(folded, start)
        after = WORD.search(folded, here.end(), here.end() + 64)
        before = WORD.findall(folded, max(0, start - 64), start)
        return ({f"{here[0]} {after[0]}"} if after else set()) | ({f"{before[-1]} {here[0]}"} if before else set())

    def features(self, text: str | None) -> tuple[float, float]:
        """(log weight, log weight per thousand characters), both 0 without a match."""
        folded = fold(text or "")
        weight = self.weight(folded)
        return math.log1p(weight), math.log1p(1000 * weight / (100 + len(folded)))

    def score(self, text: str | None) -> float:
        a, b, c = self.line
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def candidates(folded: str) -> set[str]:
    words = set(WORD.findall(folded))
    return {f"={w}" for w in words if len(w) > 2} | {w[:k] for w in words for k in STEMS if len(w) > k}


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon from at most ``train_rows`` labelled rows that aren't held out.

    Every candidate's rows are counted by Spark. Those that tell toxic rows are taken greedily, each
    for the toxic rows that no better one covers, so that words which only happen to stand in copies
    of a toxic text are left. Rows without a label, an id or a document aren't used; without
    toxic and clean rows the lexicon is empty and every score is low.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(train_rows)
    # Bounded by train_rows rows of 12 bytes.
    rows = cut_lineage(documents.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
                       .join(F.broadcast(chosen), "id"))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Lexicon()

    counted = rows.mapInArrow(_count_candidates, "entry string, toxic long, clean long")
    odds = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    base, share = toxic / (toxic + clean), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    gain = 2 * (F.col("toxic") * F.log(share / base)
                + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))).otherwise(0))
    least = max(LEAST_ROWS, toxic // 400)
    best = (counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where((F.col("toxic") >= least) & (odds >= LEAST_ODDS) & (gain >= LEAST_G))
            .orderBy(F.desc(gain), "entry").limit(MAX_ENTRIES).collect())
    weights = {r["entry"]: math.log((r["toxic"] + 0.5) / (toxic + 1) * (clean + 1) / (r["clean"] + 0.5)) for r in best}

    covered = rows.where("label = 1").mapInArrow(_covers(set(weights)), "entries array<string>").collect()
    lexicon = Lexicon(_greedy(weights, [set(r["entries"]) for r in covered], least))
    lexicon = Lexicon(lexicon.weights, _exceptions(rows, lexicon))
    points = rows.mapInArrow(_points(lexicon), "label int, x double, y double").collect()
    return Lexicon(lexicon.weights, lexicon.exceptions, _logistic(points))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1_024) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: counts of a slice are sent on, not held."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _count_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        counts = {0: Counter(), 1: Counter()}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            counts[1 if label else 0].update(candidates(fold(text)))
        # An entry without a toxic row can only pass if others find one, and then counts as clean.
        entries = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(entries, pa.string()), pa.array([counts[1][e] for e in entries], pa.int64()),
             pa.array([counts[0][e] for e in entries], pa.int64())], names=["entry", "toxic", "clean"])


def _covers(entries: set[str]):
    def run(batches):
        for batch in batches:
            found = [sorted(candidates(fold(text)) & entries) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["entries"])
    return run


def _greedy(weights: dict[str, float], rows: list[set[str]], least: int) -> dict[str, float]:
    """Entries by the toxic rows that they newly cover; ties go to longer ones, then by name."""
    chosen: dict[str, float] = {}
    left = Counter(e for row in rows for e in row)
    open_rows = list(rows)
    while left:
        entry, n = max(left.items(), key=lambda x: (x[1] * weights[x[0]], len(x[0]), x[0]))
        if n < least:
            left.pop(entry)
            continue
        chosen[entry] = weights[entry]
        gone = [row for row in open_rows if entry in row]
        open_rows = [row for row in open_rows if entry not in row]
        for row in gone:
            left.subtract(row)
        left = Counter({e: k for e, k in left.items() if k >= least})
    # Entries as telling as the chosen ones that stand in many rows, only beside others.
    plenty = max(least, len(rows) // 50)
    totals = Counter(e for row in rows for e in row)
    chosen |= {e: weights[e] for e, n in totals.items() if n >= plenty and e[0] == "=" and e not in chosen}
    return chosen


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> set[str]:
    """Phrases around an entry that stand in clean rows and never in toxic ones."""
    def run(batches):
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                folded = fold(text)
                counts[1 if label else 0].update({p for s in lexicon.matches(folded) for p in lexicon.phrases(folded, s)})
            phrases = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrases, pa.string()), pa.array([counts[1][p] for p in phrases], pa.int64()),
                 pa.array([counts[0][p] for p in phrases], pa.int64())], names=["entry", "toxic", "clean"])

    counted = rows.mapInArrow(run, "entry string, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = counted.where((F.col("toxic") == 0) & (F.col("clean") >= LEAST_ROWS)).orderBy(F.desc("clean"), "entry").limit(MAX_ENTRIES)
    return {r["entry"] for r in found.collect()}


def _points(lexicon: Lexicon):
    def run(batches):
        for batch in batches:
            xy = [lexicon.features(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.int32()), pa.array([x for x, _ in xy], pa.float64()),
                 pa.array([y for _, y in xy], pa.float64())], names=["label", "x", "y"])
    return run


def _logistic(points, ridge: float = 0.01) -> tuple[float, float, float]:
    """Newton steps of a ridge logistic regression on the two features."""
    x = np.array([[1.0, p["x"], p["y"]] for p in points])
    y = np.array([1.0 if p["label"] else 0.0 for p in points])
    line = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), x.T @ (y - p) - ridge * line)
        line += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in line)


def toxicity(df: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with score (0 to 1) and predicted (1 from 0.5 on).

    A null or empty text has no match, hence the lowest score. Rows are independent, so repeated
    rows and ties get equal scores. Input columns named like a result column are replaced.
    """
    kept = replace_columns(df, RESULTS)
    text_at = [c.lower() for c in kept.columns].index(text_col.lower())
    parts = lexicon.weights, lexicon.exceptions, lexicon.line

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(*parts)
        for batch in batches:
            scores = [own.score(text) for text in batch.column(text_at).cast(pa.string()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                names=[*batch.schema.names, *RESULTS])

    return kept.mapInArrow(run, schema_with(kept, score="double", predicted="int"))
