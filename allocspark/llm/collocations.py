"""Phrase collocations by SON partitioning.

All rows are dealt to shards by a hash of the row. Each shard is mined completely, at a support lowered
to the shard's share of all words: a phrase that occurs ``support`` times overall reaches its share in at
least one shard. The union of the locally frequent phrases is a superset of the answer, and one more pass
counts its members globally and exactly.

A shard is larger than a task. Tasks turn chunks of text into word numbers and send partial counts of
64-bit hashes, and Spark adds them up by shard; inside a shard longer phrases are tried only where their
parts are locally frequent. Hashes that meet by chance only add candidates: the last pass counts phrases
by their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from allocspark.llm.common import cut_lineage

SUPPORT, LONGEST, TOP, COVER, POINTS = 30, 4, 2_000, 80, 2_000_000
#: A power of two; with 4 shards a phrase has to occur about eight times in one of them.
SHARDS = 4
#: Text worked on at once; a longer piece without punctuation is worked on whole.
CHUNK_BYTES = 4 << 20
#: Bits of a filter of candidates: 16 for each, at most 32 MB. A fuller one lets more phrases be counted
#: for nothing; the result doesn't depend on it.
BITS_EACH, MOST_BITS = 16, 1 << 28
SALTS = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 belongs to a word, 1 parts words, 2 parts pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _B
    return values ^ (values >> np.uint64(29))


@dataclass
class Chunk:
    """Words of a stretch of text: row of the batch, number of the piece, code into ``words``, hash with language."""

    rows: np.ndarray
    pieces: np.ndarray
    codes: np.ndarray
    words: pa.Array
    hashes: np.ndarray

    def starts(self, size: int) -> np.ndarray:
        """Places where ``size`` words follow each other in one piece."""
        if size > len(self.pieces):
            return np.zeros(0, np.int64)
        last = len(self.pieces) - size + 1
        return np.flatnonzero(self.pieces[:last] == self.pieces[size - 1:])

    def phrase_hashes(self, places: np.ndarray, size: int) -> np.ndarray:
        result = self.hashes[places]
        for step in range(1, size):
            result = _mixed(result * _A + self.hashes[places + step])
        return result


def chunks(texts: pa.Array, languages: list[str], chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut at row borders and, inside long rows, at punctuation, so no phrase is cut."""
    _, bounds, buffer = texts.buffers()
    bounds = np.frombuffer(bounds, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = _LOWER[np.frombuffer(buffer, np.uint8)[bounds[0]:bounds[-1]]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    bounds -= bounds[0]
    seeds = np.array([xxhash.xxh3_64_intdigest(lang) for lang in languages], np.uint64)
    at = 0
    while at < len(data):
        end = _cut(data, bounds, at + chunk_bytes)
        chunk = _chunk(data[at:end], at, bounds, seeds)
        if chunk is not None:
            yield chunk
        at = end


def _cut(data: np.ndarray, bounds: np.ndarray, wanted: int) -> int:
    """The first border of a row or a piece at ``wanted`` or later."""
    if wanted >= len(data):
        return len(data)
    limit = int(bounds[np.searchsorted(bounds, wanted)])
    while wanted < limit:
        found = np.flatnonzero(_KIND[data[wanted:min(limit, wanted + 65_536)]] == 2)
        if len(found):
            return wanted + int(found[0])
        wanted += 65_536
    return limit


def _chunk(data: np.ndarray, at: int, bounds: np.ndarray, seeds: np.ndarray) -> Chunk | None:
    kind = _KIND[data]
    inside = kind == 0
    border = np.zeros(len(data) + 1, bool)
    border[bounds[np.searchsorted(bounds, at):np.searchsorted(bounds, at + len(data), "right")] - at] = True
    fresh = border[:-1].copy()
    fresh[0] = True
    fresh[1:] |= ~inside[:-1]
    starts = np.flatnonzero(inside & fresh)
    if not len(starts):
        return None
    closed = border[1:].copy()
    closed[-1] = True
    closed[:-1] |= ~inside[1:]
    ends = np.flatnonzero(inside & closed) + 1
    pieces = np.cumsum((kind == 2) | border[:-1], dtype=np.int32)[starts]
    rows = np.searchsorted(bounds, starts + at, "right") - 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    coded = words.dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return Chunk(rows, pieces, codes, coded.dictionary, _mixed(own[codes] * _A + seeds[rows]))


def _slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes >> np.uint64(4) & mask, hashes >> np.uint64(33) & mask


def _held(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter may hold the hashes; false for none that it holds."""
    result = np.ones(len(hashes), bool)
    for slots in _slots(hashes, 64 * len(filter_)):
        result &= (filter_[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)
    return result


def _filter(candidates: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes in ``candidates``, as words of 64 bits."""
    wanted = BITS_EACH * candidates.count()
    bits = min(MOST_BITS, max(1 << 16, 1 << int(wanted).bit_length()))
    slots = [F.shiftrightunsigned("h", by).bitwiseAND(F.lit(bits - 1)) for by in (4, 33)]
    found = candidates.select(F.explode(F.array(*slots)).alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    result = np.zeros(bits // 64, np.uint64)
    result[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return result


def _partial_counts(rows: DataFrame, sizes: tuple[int, ...], part: int, held) -> DataFrame:
    """(key, n): counts of phrases of ``sizes`` words of which all parts of ``part`` words are held by the
    broadcast filter ``held`` (none: all phrases). A key is a hash with the shard in its lowest bits."""
    low = np.uint64(SHARDS - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = np.asarray(batch.column(2)).astype(np.uint64)
            for chunk in chunks(batch.column(0), batch.column(1).to_pylist()):
                if held is not None:
                    fine = np.zeros(len(chunk.rows), bool)
                    places = chunk.starts(part)
                    fine[places] = _held(held.value, chunk.phrase_hashes(places, part) & ~low)
                keys = []
                for size in sizes:
                    places = chunk.starts(size)
                    if held is not None:
                        for step in range(size - part + 1):
                            places = places[fine[places + step]]
                    keys.append(chunk.phrase_hashes(places, size) & ~low | shards[chunk.rows[places]])
                found, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    return rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _locally_frequent(counts: DataFrame, supports: list[int]) -> DataFrame:
    """(h): distinct hashes that reach their shard's support."""
    shard = F.col("key").bitwiseAND(F.lit(SHARDS - 1))
    least = F.element_at(F.array(*map(F.lit, supports)), (shard + 1).cast("int"))
    return cut_lineage(counts.where(F.col("n") >= least).select((F.col("key") - shard).alias("h")).distinct())


def _exact_counts(rows: DataFrame, filters: list[np.ndarray | None]) -> DataFrame:
    """(lang, size, phrase, n) of the phrases that the filters of their size hold; size 0: all words."""
    low = np.uint64(SHARDS - 1)
    shared = rows.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            names, lang_of = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
            for chunk in chunks(batch.column(0), batch.column(1).to_pylist()):
                langs, many = lang_of[chunk.rows], len(chunk.words)
                which, n = np.unique(langs, return_counts=True)
                yield _counted(names.take(pa.array(which)), 0, pa.nulls(len(which), pa.string()), n)
                for size, held in enumerate(shared.value, 1):
                    if held is None:
                        continue
                    places = chunk.starts(size)
                    places = places[_held(held, chunk.phrase_hashes(places, size) & ~low)]
                    keys = langs[places] * many + chunk.codes[places]
                    for step in range(1, size):
                        if step > 1:  # small numbers again
                            keys = np.unique(keys, return_inverse=True)[1]
                        keys = keys * many + chunk.codes[places + step]
                    _, first, n = np.unique(keys, return_index=True, return_counts=True)
                    first = places[first]
                    words = [chunk.words.take(pa.array(chunk.codes[first + step])) for step in range(size)]
                    phrases = pc.binary_join_element_wise(*words, b" ") if size > 1 else words[0]
                    yield _counted(names.take(pa.array(langs[first])), size, phrases.view(pa.string()), n)

    return rows.mapInArrow(run, "lang string, size int, phrase string, n long").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def _counted(langs: pa.Array, size: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs, pa.array(np.full(len(n), size), pa.int32()), phrases, pa.array(n, pa.int64())], names=["lang", "size", "phrase", "n"])


def phrase_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT) -> DataFrame:
    """(lang, size, phrase, n): every phrase of one to four words that occurs ``support`` times in a language,
    with its exact count, and a row of size 0 (phrase null) with the number of all words a language."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(text.alias("text"), lang.alias("lang"), F.pmod(F.xxhash64(text, lang), F.lit(SHARDS)).alias("shard"))
    context = df.sparkSession.sparkContext
    filters: list[np.ndarray | None] = [None] * LONGEST

    words = cut_lineage(_partial_counts(rows, (1,), 0, None))
    shares = dict(words.groupBy(F.col("key").bitwiseAND(F.lit(SHARDS - 1))).agg(F.sum("n")).collect())
    total = sum(shares.values())
    # Rounded up: the shares of the support add up to it, so in some shard a count reaches the share.
    supports = [max(1, -(-support * shares.get(i, 0) // total)) if total else 1 for i in range(SHARDS)]
    found = _locally_frequent(words, supports)
    # Words, then pairs of frequent words, then triples and quadruples of frequent pairs.
    for sizes, part in (((2,), 1), ((3, 4), 2)):
        if found.isEmpty():
            break
        filters[part - 1] = _filter(found)
        found = _locally_frequent(_partial_counts(rows, sizes, part, context.broadcast(filters[part - 1])), supports)
    else:
        if not found.isEmpty():
            filters[2] = filters[3] = _filter(found)
    return cut_lineage(_exact_counts(rows, filters).where((F.col("size") == 0) | (F.col("n") >= support)))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    A-Z is lower-cased; texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words
    ``[^\\x20\\x09]+``. a is a phrase's count inside pieces, overlaps included, n its language's words. Of
    the cuts of a phrase that with the lowest score floor(2000000 a / (l + r)) counts, then that with
    the fewest words first. A phrase goes if a longer one of at least 80 % of its count holds it. Order: score and a
    descending, phrase in byte order. A null text is empty, a null language ``und``; rows without words
    add nothing, repeated rows count each; without phrases the result is empty. Other columns are ignored.
    """
    counts = phrase_counts(df, text_col, lang_col, support)
    wide = "decimal(38,0)"
    phrases = counts.where("size > 1").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " ", -1))

    # A frequent word may begin or end a large share of all phrases, so its count is dealt to some salts.
    salted = counts.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"), F.explode(
        F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    cuts = phrases.select("lang", "phrase", "a", "words", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.expr("slice(words, 1, k)")).alias("first"),
        F.concat_ws(" ", F.expr("slice(words, k + 1, size - k)")).alias("rest"),
        F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))
    cuts = cuts.join(salted.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first", "salt"]).join(
        salted.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest", "salt"])
    points = F.expr(f"(cast({POINTS} as {wide}) * a) div (cast(l as {wide}) + r)")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(points.alias("score"), "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    inner = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> concat_ws(' ', slice(words, i, m)))))")
    covering = phrases.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("f")).groupBy(
        "lang", "phrase").agg(F.max("f").alias("f"))
    left = scored.join(covering, ["lang", "phrase"], "left").where(
        F.col("f").isNull() | F.expr(f"100 * cast(f as {wide}) < {COVER} * cast(a as {wide})"))

    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(4 * SALTS))
    best = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", "n")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
worded as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
    select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
    from worded, (values (1), (2), (3), (4)) s(size) where len(w) >= size),
f as materialized (select lang, phrase, size, count(*) as a from grams group by all having count(*) >= 30),
n as (select lang, sum(len(w)) as n from worded group by lang),
candidates as (select *, string_split(phrase, ' ') as w from f where size > 1),
cuts as (
    select c.lang, c.phrase, c.a, k, l.a as l, r.a as r, cast(2000000 * c.a::hugeint // (l.a::hugeint + r.a) as bigint) as score
    from (select *, unnest(range(1, size)) as k from candidates) c
    join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:k], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
parts as (
    select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, a as longer
    from candidates, (values (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) t(i, m) where m < size and i + m - 1 <= size),
covered as (
    select distinct lang, phrase from scored join parts using (lang, phrase) where 100 * longer::hugeint >= 80 * a::hugeint)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
       cast(n as bigint) as n, score
from scored anti join covered using (lang, phrase) join n using (lang)
qualify rank <= 2000
"""
