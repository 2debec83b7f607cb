"""Centroid clustering of vectors by a tournament of bisectors.

Components become integers, and every step is exact. For each pair of centroids a < b the plane
halfway between them has the integer normal 2 (b - a) and the threshold |b|^2 - |a|^2: b is strictly
nearer to x where normal * x - threshold is positive. With k centroids k-1 such signs find the
nearest one: the winner so far meets the next number, zero leaves it standing, so ties go to the
smaller number. Only the final distance is computed as such.

Every round is one pass over the vectors: tasks send at most k sums each, which Spark adds up.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from allocspark.llm.common import cut_lineage, schema_with

DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Integers up to this are added and multiplied as 64-bit numbers, which can't overflow then; vectors
#: with larger ones are worked on with Python's integers.
SMALL = 1 << 26
#: Sums travel in digits of this base.
BASE_BITS = 48
RESULTS = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def whole(x: float, scale: int = SCALE) -> int:
    """floor(scale * x), exact for a scale that is a power of two."""
    return math.floor(x * scale) if abs(x) < 2.0**60 else int(x) * scale


def usable(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors with ``dims`` components, none null or non-finite; these, a row each)."""
    lengths = np.array(vectors.value_lengths().fill_null(-1))
    places = np.flatnonzero(lengths == dims)
    flat = vectors.take(pa.array(places)).flatten()
    values = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(len(places), dims)
    fine = np.isfinite(values).all(axis=1)
    return places[fine], values[fine]


class Tournament:
    """Bisectors of all pairs of integer centroids."""

    def __init__(self, centroids: list[list[int]], scale: int = SCALE) -> None:
        self.centroids, self.scale = centroids, scale
        self.squares = [sum(v * v for v in c) for c in centroids]
        self.small = bool(centroids) and all(abs(v) < SMALL for c in centroids for v in c)
        if self.small:
            self.table = np.array(centroids, np.int64)
            self.normals = 2 * (self.table[None, :, :] - self.table[:, None, :])
            squares = np.array(self.squares, np.int64)
            self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray, list[list[int]]]:
        """Per row of ``values``: (nearest centroid, squared distance). Then the rows' integers: those
        of small rows (others are zero there), and a list that has an entry for each other row."""
        n = len(values)
        scaled = np.floor(np.where(np.abs(values) < SMALL, values, 0.0) * self.scale)
        small = (np.abs(values) < SMALL / self.scale).all(axis=1) & self.small
        rows = np.where(small[:, None], scaled, 0).astype(np.int64)
        winner = np.zeros(n, np.int64)
        if self.small:
            for other in range(1, len(self.centroids)):
                sign = np.einsum("nd,nd->n", rows, self.normals[winner, other]) - self.thresholds[winner, other]
                winner[sign > 0] = other
            apart = rows - self.table[winner]
            distances = np.einsum("nd,nd->n", apart, apart).tolist()
        else:
            distances = [0] * n
        large = []
        for place in np.flatnonzero(~small):
            row = [whole(float(v), self.scale) for v in values[place]]
            best = 0
            for other in range(1, len(self.centroids)):
                a, b = self.centroids[best], self.centroids[other]
                if sum(2 * (q - p) * x for p, q, x in zip(a, b, row)) > self.squares[other] - self.squares[best]:
                    best = other
            winner[place] = best
            distances[place] = sum((x - c) ** 2 for x, c in zip(row, self.centroids[best]))
            large.append((int(place), row))
        return winner, distances, rows, large


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS, dims: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per usable vector of ``df``: the id, cluster, distance (squared, of the integers floor(scale * x)),
    cluster_inertia, inertia and centroid_sha256. ``scale`` is a power of two.

    Vectors without exactly ``dims`` components, or with a null or non-finite one, have no row. The
    first centroids are the ``k`` vectors (fewer, if there are fewer) with the smallest sha256 of
    ``seed:id``; null ids come last, equal ids go by their vectors. Every round assigns all vectors to
    the nearest centroid (ties: the smaller number) and replaces each centroid that has any by their floored
    mean; then they are assigned once more. Repeated rows count as often as they
    occur; an empty table gives an empty result. Arithmetic is exact for any finite component;
    distances and inertias beyond 64 bits are null. Other input columns are left out.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    centroids = _seeds(rows, k, dims, scale, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _means(rows, centroids, dims, scale)
    assigned = cut_lineage(_assigned(rows, centroids, dims, scale))
    # At most k rows of counts and sums.
    known = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.max(F.isnull("distance")).alias("lost")).collect()
    inertia = {r["cluster"]: None if r["lost"] else int(r["s"]) for r in known}
    total = None if None in inertia.values() else sum(inertia.values())
    table = df.sparkSession.createDataFrame(
        [(c, _long(s), _long(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(F.col("id").alias(id_col), *RESULTS)


def _long(value: int | None) -> int | None:
    return value if value is not None and value < 1 << 63 else None


def _seeds(rows: DataFrame, k: int, dims: int, scale: int, seed: int) -> list[list[int]]:
    """Sorted in every task and merged: at most ``k`` vectors come to the driver."""
    def fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, _ = usable(batch.column(1), dims)
            yield batch.take(pa.array(places))

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = rows.mapInArrow(fine, rows.schema).withColumn("h", digest).orderBy(F.asc_nulls_last("h"), "v").limit(k)
    return [[whole(x, scale) for x in r["v"]] for r in chosen.collect()]


def _means(rows: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contest = Tournament(centroids, scale)
        counts, totals = [0] * len(centroids), [[0] * dims for _ in centroids]
        for batch in batches:
            winner, _, small, large = contest.nearest(usable(batch.column(1), dims)[1])
            for c in np.unique(winner).tolist():
                mine = winner == c
                counts[c] += int(mine.sum())
                totals[c] = [t + s for t, s in zip(totals[c], small[mine].sum(axis=0).tolist())]
            for place, row in large:
                totals[winner[place]] = [t + x for t, x in zip(totals[winner[place]], row)]
        out = [(c, i, 0 if i else n, digits) for c, n in enumerate(counts) if n for i, digits in enumerate(_digits(totals[c]))]
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(
            zip(*out) if out else [[]] * 4, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=["c", "i", "n", "s"])

    wide = "decimal(38,0)"
    found = rows.mapInArrow(sums, "c int, i int, n long, s array<long>").groupBy("c", "i").agg(
        F.sum(F.col("n").cast(wide)).alias("n"), *[F.sum(F.col("s")[d].cast(wide)).alias(f"s{d}") for d in range(dims)]).collect()
    counts, totals = [0] * len(centroids), [[0] * dims for _ in centroids]
    for r in found:
        counts[r["c"]] += int(r["n"])
        totals[r["c"]] = [t + (int(r[f"s{d}"]) << BASE_BITS * r["i"]) for d, t in enumerate(totals[r["c"]])]
    return [[t // n for t in total] if n else old for total, n, old in zip(totals, counts, centroids)]


def _digits(numbers: list[int]) -> list[list[int]]:
    """Numbers as lists of digits, the lowest first; a number's digits all have its sign."""
    places = max(1, -(-max(abs(v) for v in numbers).bit_length() // BASE_BITS))
    low = (1 << BASE_BITS) - 1
    return [[(abs(v) >> BASE_BITS * i & low) * (1 if v >= 0 else -1) for v in numbers] for i in range(places)]


def _assigned(rows: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> DataFrame:
    ids = rows.select("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contest = Tournament(centroids, scale)
        for batch in batches:
            places, values = usable(batch.column(1), dims)
            winner, distances, _, _ = contest.nearest(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places)), pa.array(winner, pa.int32()), pa.array(map(_long, distances), pa.int64())],
                names=["id", "cluster", "distance"])

    return rows.mapInArrow(run, schema_with(ids, cluster="int", distance="long"))


def _oracle() -> str:
    apart = "list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))"
    steps = ["""v as materialized (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::double) as hugeint)) as q
    from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)""",
             """c0 as materialized (
    select row_number() over (order by sha256('2:' || vec_id) nulls last, q) - 1 as c, q from v order by c limit 40)"""]
    for turn in range(ROUNDS + 1):
        steps.append(f"""a{turn} as materialized (
    select r, arg_min(c, (d, c)) as c, min(d) as d
    from (select v.r, c.c, {apart} as d from v, c{turn} c) group by r)""")
        if turn < ROUNDS:
            steps.append(f"""m{turn} as materialized (
    select a.c, list_transform(range(1, 65), lambda i: (list_sum(list_transform(qs, lambda q: q[i])), len(qs))) as m
    from (select a.c, list(v.q) as qs from v join a{turn} a using (r) group by a.c) a)""")
            steps.append(f"""c{turn + 1} as materialized (
    select c.c, coalesce(list_transform(m.m, lambda p: p[1] // p[2] - case when p[1] % p[2] < 0 then 1 else 0 end), c.q) as q
    from c{turn} c left join m{turn} m using (c))""")
    last = ROUNDS
    return "with " + ",\n".join(steps) + f"""
select vec_id, cast(a.c as int) as cluster, cast(a.d as bigint) as distance, cast(sum(a.d) over (partition by a.c) as bigint) as cluster_inertia,
    cast(sum(a.d) over () as bigint) as inertia, sha256(array_to_string(c.q, ',')) as centroid_sha256
from v join a{last} a using (r) join c{last} c on c.c = a.c"""


ORACLE_SQL = _oracle()
