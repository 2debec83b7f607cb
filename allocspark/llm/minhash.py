"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum and its maximum, so
100 permutations give 200 unbiased values at half the hash evaluations. Bands of five values are
the candidate search: 20 bands of minima and 20 of maxima find a pair of similarity 0.8 but for
1.3e-7, and a pair of 0.2 in one of 80 cases.

Documents of equal shingle sets form a class, and only the class's smallest id takes part. Buckets
are never expanded into all their pairs: first every member is tried against the bucket's smallest
id, confirmed links are joined to components, and a bucket whose members share a component is done.
What is left of small buckets is tried pair by pair across components; of larger ones, what stands
outside the main component is tried against the rest, but only pairs whose intersection can be
large enough, as the shingles that a document shares with no other bound it. Links are confirmed on
the full shingle sets; what is left out before are only pairs whose sizes, or the parities of their
shingles in cells, prove that they have too little in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from allocspark.llm.common import cut_lineage, text_or_empty
from allocspark.llm.components import connected_components

PERMUTATIONS, BAND_VALUES = 100, 5
#: Buckets up to the first size are tried pair by pair at once, up to the second across components.
TINY, SMALL = 6, 48

#: Cells, 64 a long, that a set's hashes are dealt to: every hash that only one of two sets has changes
#: the parity of one cell, so sets differ in at least as many hashes as cells. No link can be lost.
PARITY_LONGS = 100

_RANDOM = np.random.default_rng(20_240_229)
_SEEDS = _RANDOM.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_FACTORS = _RANDOM.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_PLACES = _RANDOM.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BANDS = np.concatenate([_RANDOM.permutation(PERMUTATIONS).reshape(-1, BAND_VALUES) + offset for offset in (0, PERMUTATIONS)])
_BAND_NUMBERS = _RANDOM.integers(0, 2**64, len(_BANDS), dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9FB21C651E98DF25)
    return values ^ (values >> np.uint64(29))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words`` words, A-Z lower-cased.

    Words are what stands between ``[\\x20\\x09-\\x0D]``; fewer words are one shingle, none are none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, found)), np.uint64)
    size = min(words, len(hashes))
    total = np.full(len(hashes) - size + 1, size, np.uint64) * _PLACES[-1]
    for place in range(size):
        total += hashes[place: len(hashes) - size + 1 + place] * _PLACES[place]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray, seeds: np.ndarray = _SEEDS, factors: np.ndarray = _FACTORS) -> np.ndarray:
    """Minimum and maximum of the hashes under every permutation."""
    least = np.full(len(seeds), 2**64 - 1, np.uint64)
    most = np.zeros(len(seeds), np.uint64)
    for start in range(0, len(hashes), 1024):
        block = (hashes[start:start + 1024, None] ^ seeds) * factors
        np.minimum(least, block.min(axis=0), out=least)
        np.maximum(most, block.max(axis=0), out=most)
    return np.concatenate([least, most])


def bands(values: np.ndarray) -> np.ndarray:
    return _mixed((values[_BANDS] * _PLACES[:BAND_VALUES]).sum(axis=1, dtype=np.uint64) + _BAND_NUMBERS).view(np.int64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of the hashes falls into each of 64 * ``PARITY_LONGS`` cells, as bits."""
    cells = (hashes % np.uint64(64 * PARITY_LONGS)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=64 * PARITY_LONGS) & 1).astype(np.uint8)).view(np.int64)


def _near_enough(a: str, b: str, n_a: str, n_b: str, percent: int, longs: int = PARITY_LONGS):
    """False only for pairs that can't be so similar: sets of the sizes n_a and n_b are if they differ
    in at most (n_a + n_b) * (100 - percent) / (100 + percent) hashes, and they do in one a bit at least."""
    bits = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, longs)),
               F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))
    return bits * (100 + percent) <= (F.col(n_a) + F.col(n_b)) * (100 - percent)


def signatures(df: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, digest of the shingle set, band keys); both null without shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, words)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                keys.append(bands(signature(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "digest", "bands"])

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, digest binary, bands array<long>")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(node, size of the set, its parities, all hashes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text, words) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, found), pa.int32()), pa.array([parities(f) for f in found], pa.list_(pa.int64())),
                 pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))], names=["node", "own_n", "odd", "hashes"])

    return rows.mapInArrow(run, "node long, own_n int, odd array<long>, hashes array<long>")


def _buckets(classes: DataFrame) -> DataFrame:
    """Rows (key, node, n) of keys that several nodes share, with the bucket's size and smallest node."""
    rows = classes.select("node", F.col("n").cast("int").alias("n"), F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("node"), F.min_by("n", "node").alias("n"))
    return rows.join(shared.where("size > 1").select("key", "size", F.struct("node", "n").alias("first")), "key")


def _alike_sizes(a: str, b: str, percent: int):
    """What similarity needs at least: the smaller set is that share of the larger."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _pairs_in(members: DataFrame, condition, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of a bucket under a condition on the columns of both, ``_a`` and ``_b``."""
    columns = [c for c in ("node", "n", "component") if c in members.columns]
    left, right = (members.select("key", *[F.col(c).alias(f"{c}{side}") for c in columns]) for side in ("_a", "_b"))
    return (left.join(right, "key").where((F.col("node_a") < F.col("node_b")) & _alike_sizes("n_a", "n_b", percent) & condition)
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())


def _to_first(members: DataFrame, percent: int) -> DataFrame:
    return (members.where((F.col("first.node") != F.col("node")) & _alike_sizes("first.n", "n", percent))
            .select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct())


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full sets; sizes and parities
    that rule this out spare the comparison."""
    # Cells folded in two, which is as exact a bound: the parity of both together.
    half = PARITY_LONGS // 2
    folded = F.zip_with(F.slice("odd", 1, half), F.slice("odd", half + 1, half), lambda x, y: x.bitwiseXOR(y))
    odds = sets.select("node", "own_n", folded.alias("odd"))
    pairs = (pairs.join(odds.select(F.col("node").alias("b"), F.col("odd").alias("odd_b"), F.col("own_n").alias("own_n_b")), "b")
             .join(odds.select(F.col("node").alias("a"), F.col("odd").alias("odd_a"), F.col("own_n").alias("own_n_a")), "a")
             .where(_near_enough("odd_a", "odd_b", "own_n_a", "own_n_b", percent, half)).select("a", "b"))
    return _compared(pairs, sets, percent)


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    return (pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
            .where(common * 100 >= union * percent).select("a", "b"))


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``df``: the id, n_shingles, component_id (smallest id reachable over links of at
    least ``percent`` similarity) and kept (whether the id is its component's).

    A null, empty or blank text has no shingles and no links. Rows that share an id are one
    document; a null id has no component and is kept. Ids are whole numbers of up to 64 bits. Other
    input columns are left out.
    """
    signed = cut_lineage(signatures(df, words, id_col, text_col))
    classes = (signed.where("digest is not null and id is not null").groupBy("digest")
               .agg(F.min("id").alias("node"), F.min("n_shingles").alias("n"), F.any_value("bands").alias("bands")))
    classes = cut_lineage(classes)
    named = _components(df, classes, words, percent, id_col, text_col).select("digest", "component")
    # Rows sharing an id may be of several classes: the id links them.
    component = F.coalesce("component", F.col("id"))
    return signed.select("id", "n_shingles", "digest").join(named, "digest", "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _components(df: DataFrame, classes: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(digest, node, component) of every class: first by the links to the buckets' smallest nodes,
    then by those found between the components that these leave."""
    members = cut_lineage(_buckets(classes))
    candidates = members.select(F.col("node").alias("id")).distinct()
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    sets = cut_lineage(_sets(texts.join(candidates, "id", "left_semi"), words))
    tiny, small = F.col("size") <= TINY, F.col("size") <= SMALL
    tried = _to_first(members.where(~tiny), percent).unionByName(_pairs_in(members.where(tiny), F.lit(True), percent))
    links = cut_lineage(_confirmed(tried.distinct(), sets, percent))

    named = _named(classes.select("digest", "node"), "node", connected_components(links))
    members = _unsettled(members.where(~tiny), named.select("node", "component"))
    if members.isEmpty():
        return named
    across = _pairs_in(members.where(small), F.col("component_a") != F.col("component_b"), percent)
    links = _confirmed(across, sets, percent)
    members = members.where(~small)
    # A pair shares no shingle that one of them alone has, which bounds its intersection.
    nodes = members.select("node").distinct()
    alone = (sets.join(nodes, "node", "left_semi").select("node", F.explode("hashes").alias("hash"))
             .groupBy("hash").agg(F.count("*").alias("rows"), F.min("node").alias("node")).where("rows = 1")
             .groupBy("node").agg(F.count("*").alias("alone")))
    bounded = (members.join(alone, "node", "left").withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0)))
               .where(F.col("most") * 100 >= F.col("n") * percent))
    most = F.least("most_a", "most_b")
    reachable = most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    # A pair is taken once, in that of its common buckets with the smallest key.
    first = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    largest = (bounded.groupBy("key", "component").agg(F.count("*").alias("rows"))
               .groupBy("key").agg(F.max(F.struct("rows", "component")).alias("largest")))
    split = cut_lineage(bounded.join(largest.select("key", F.col("largest.component").alias("main")), "key")
                        .select("key", "node", "n", "component", "main", "most"))
    close = _by_node(split, "main", kept=("n", "component", "most")).withColumn("keys", F.col("places.key"))
    close = _spread(close.join(sets.select("node", "own_n", "odd").distinct(), "node"), "main")
    tried = _pairs_across(close, reachable & _near_enough("odd_a", "odd_b", "own_n_a", "own_n_b", percent) & first, percent)
    links = cut_lineage(links.unionByName(_compared(tried, sets, percent)))
    for end in ("a", "b"):
        links = links.join(named.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in")), end)
    links = cut_lineage(links.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")).distinct())
    return _named(named.withColumnRenamed("component", "first_found"), "first_found", connected_components(links)).drop("first_found")


def _named(nodes: DataFrame, name: str, labels: DataFrame) -> DataFrame:
    """``nodes`` with the component that ``labels`` give to the node under ``name``; else its own."""
    labels = labels.select(F.col("node").alias("labelled"), F.col("component").alias("found"))
    return cut_lineage(nodes.join(labels, F.col(name) == F.col("labelled"), "left").select(
        *nodes.columns, F.coalesce("found", name).alias("component")))


def _pairs_across(members: DataFrame, condition, percent: int) -> DataFrame:
    """Pairs of a bucket in different components: those outside its main component against all."""
    outside = members.where("component != main")
    left, right = (some.select("key", *[F.col(c).alias(f"{c}{side}") for c in members.columns if c != "key"])
                   for some, side in ((outside, "_a"), (members, "_b")))
    once = (F.col("component_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b"))
    apart = F.col("component_a") != F.col("component_b")
    return (left.join(right, "key")
            .where(apart & once & _alike_sizes("n_a", "n_b", percent) & condition)
            .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct())


def _by_node(members: DataFrame, of_bucket: str, kept: tuple[str, ...] = ("n",)) -> DataFrame:
    """One row per node, its buckets (at most one per band) as ``places``: joins by node then take a
    row per node and not one per bucket."""
    return members.groupBy("node").agg(
        *[F.min(c).alias(c) for c in kept], F.collect_list(F.struct("key", of_bucket)).alias("places"))


def _spread(nodes: DataFrame, of_bucket: str) -> DataFrame:
    """The row per node and bucket again."""
    rest = [c for c in nodes.columns if c != "places"]
    return nodes.select(*rest, F.explode("places").alias("place")).select("place.key", *rest, f"place.{of_bucket}")


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with their component, of buckets that span several components."""
    named = _spread(_by_node(members, "size").join(labels, "node"), "size")
    spans = (named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("key"))
    return cut_lineage(named.join(spans, "key", "left_semi"))
