"""Running values along an ordered key (sums, positions, neighbours) that survive hot keys.

A plain window puts all rows of one key into one task. All rows are therefore cut into chunks by
borders in the order (key, order), as many as the session's shuffles have partitions. A chunk is
windowed in one task; only the keys of the borders lie in several chunks, so a table of at most
two rows a chunk carries all values across the borders. Small and hot keys take the same way; where
the rows of each key are counted already, ``run_by_key`` sends only hot keys that way.

The rows are stored as columns once and shuffle once, by chunk. Borders are drawn from a sample of the
stored rows and are fixed before that, so a row's chunk is a function of the row, also when a stage is
run again. What the borders carry comes from partial sums over the stored rows of their keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from allocspark.session import cut_lineage, stored

#: Sampled rows for each chunk; twenty keep a chunk below twice its share of the rows, as a rule.
SAMPLED = 20


@dataclass(frozen=True)
class Running:
    """What to compute along the order. Each mapping is output column -> source column."""

    key: list[str]
    order: list[str]  # must end in a unique column so that positions are defined
    sums: dict[str, str] = field(default_factory=dict)  # total of the rows up to this one
    previous: dict[str, str] = field(default_factory=dict)
    following: dict[str, str] = field(default_factory=dict)
    first: dict[str, str] = field(default_factory=dict)
    position: str | None = None  # 1-based row number
    size: str | None = None  # rows of the key
    one_key: bool = False  # all rows have the same key


def chunk_borders(df: DataFrame, by: list[str], chunks: int) -> DataFrame:
    """One stored row with ``borders``: ``chunks - 1`` sampled rows' values of ``by``, ascending.

    The sample is the ``SAMPLED * chunks`` rows with the smallest hash, so it is the same in every run
    over the same rows.
    """
    place = F.struct(*[F.col(name) for name in by])
    sample = df.select(place.alias("at"), F.xxhash64(*by).alias("h")).orderBy("h").limit(SAMPLED * chunks)
    places = F.sequence(F.lit(1), F.lit(chunks - 1)) if chunks > 1 else F.array().cast("array<int>")
    return cut_lineage(sample.agg(F.array_sort(F.collect_list("at")).alias("at")).select(
        F.transform(places, lambda i: F.get("at", F.floor(i * F.size("at") / chunks).cast("int"))).alias("borders")))


def with_chunk(df: DataFrame, by: list[str], borders: DataFrame, chunks: int) -> DataFrame:
    """``df`` with ``_chunk``: the number of borders at or before the row, in the order ``by``; rows
    with equal ``by`` share a chunk."""
    place = F.struct(*[F.col(name) for name in by])
    # Binary search, one comparison a step and no function called per element.
    placed = df.withColumn("_place", place).withColumn("_borders", borders.scalar()).withColumn("_chunk", F.lit(0))
    step = 1 << (chunks - 1).bit_length() - 1 if chunks > 1 else 0
    while step:
        further = F.get("_borders", F.col("_chunk") + (step - 1)) <= F.col("_place")
        placed = placed.withColumn("_chunk", F.col("_chunk") + F.when(further, step).otherwise(0))
        step //= 2
    return placed.drop("_place", "_borders")


def run_ordered(df: DataFrame, spec: Running, settled: bool = False) -> DataFrame:
    """``df`` with the columns of ``spec`` added; null keys form a key of their own.

    ``df`` is read three times, so it is stored first, unless it is ``settled``: made from stored rows
    without a shuffle.
    """
    chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*spec.key, *spec.order]
    rows = df if settled else stored(df)
    borders = chunk_borders(rows, by, chunks)
    part = Window.partitionBy("_chunk", *spec.key)
    in_part = part.orderBy(*spec.order)
    so_far = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local: dict[str, Column] = {"_at": F.row_number().over(in_part)} if spec.previous or spec.position else {}
    local |= {"_rows": F.count(F.lit(1)).over(part)} if spec.size else {}
    local |= {"_more": F.lead(F.lit(True)).over(in_part)} if spec.following else {}
    local |= {f"_run_{out}": F.sum(src).over(so_far) for out, src in spec.sums.items()}
    local |= {f"_lag_{out}": F.lag(src).over(in_part) for out, src in spec.previous.items()}
    local |= {f"_lead_{out}": F.lead(src).over(in_part) for out, src in spec.following.items()}
    heads = {out: src for out, src in (spec.following | spec.first).items()}
    local |= {f"_head_{out}": F.first(src).over(so_far) for out, src in heads.items()}
    laid = with_chunk(rows, by, borders, chunks).repartitionById(chunks, F.col("_chunk").cast("int")).withColumns(local)

    # A key that lies in several chunks is the key of a border, so only such keys' rows are summed, where they lie.
    cut = borders.select(F.explode("borders").alias("at")).select(*[F.col("at")[name].alias(f"_e_{name}") for name in spec.key]).distinct()
    at_border = rows if spec.one_key else rows.join(F.broadcast(cut), [F.col(name).eqNullSafe(F.col(f"_e_{name}")) for name in spec.key], "left_semi")
    along = F.struct(*[F.col(name) for name in spec.order])
    totals = {"_rows": F.count(F.lit(1))}
    totals |= {f"_sum_{out}": F.sum(src) for out, src in spec.sums.items()}
    totals |= {f"_last_{out}": F.max_by(src, along) for out, src in spec.previous.items()}
    totals |= {f"_head_{out}": F.min_by(src, along) for out, src in heads.items()}
    # At most two rows a chunk.
    parts = with_chunk(at_border, by, borders, chunks).groupBy("_chunk", *spec.key).agg(
        *[value.alias(name) for name, value in totals.items()])
    key_parts = Window.partitionBy(*spec.key)
    by_chunk = key_parts.orderBy("_chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carry = {"_rows_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
             "_rows_all": F.sum("_rows").over(key_parts)}
    carry |= {f"_before_{out}": F.sum(f"_sum_{out}").over(before) for out in spec.sums}
    carry |= {f"_prev_{out}": F.lag(f"_last_{out}").over(by_chunk) for out in spec.previous}
    carry |= {f"_next_{out}": F.lead(f"_head_{out}").over(by_chunk) for out in spec.following}
    carry |= {f"_first_{out}": F.first(f"_head_{out}").over(
        by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for out in spec.first}
    carried = parts.select(
        *[F.col(name).alias(f"_c_{name}") for name in ["_chunk", *spec.key]],
        F.lit(True).alias("_border"), *[column.alias(name) for name, column in carry.items()])
    match = [F.col(name).eqNullSafe(F.col(f"_c_{name}")) for name in spec.key]
    match.append(F.col("_chunk") == F.col("_c__chunk"))
    # At most two rows a chunk.
    joined = laid.join(F.broadcast(carried), match, "left")

    border = F.col("_border").isNotNull()
    added: dict[str, Column] = {}
    for out, src in spec.sums.items():
        run, prior = F.col(f"_run_{out}"), F.col(f"_before_{out}")
        kind = df.select(F.sum(src).alias(out)).schema[out].dataType
        added[out] = F.when(prior.isNull(), run).when(run.isNull(), prior).otherwise(run + prior).cast(kind)
    for out in spec.previous:
        added[out] = F.when(F.col("_at") == 1, F.col(f"_prev_{out}")).otherwise(F.col(f"_lag_{out}"))
    for out in spec.following:
        added[out] = F.when(F.col("_more").isNull(), F.col(f"_next_{out}")).otherwise(F.col(f"_lead_{out}"))
    for out in spec.first:
        added[out] = F.when(border, F.col(f"_first_{out}")).otherwise(F.col(f"_head_{out}"))
    if spec.position:
        added[spec.position] = (F.coalesce("_rows_before", F.lit(0)) + F.col("_at")).cast("int")
    if spec.size:
        added[spec.size] = F.coalesce("_rows_all", "_rows")
    return joined.select(*df.columns, *[column.alias(name) for name, column in added.items()])


def run_by_key(df: DataFrame, spec: Running, sizes: DataFrame) -> DataFrame:
    """``run_ordered`` by plain windows, which need no shuffle where a join by the key went before.

    ``sizes`` has ``n``, the rows of each key; keys with more than a chunk's share of the rows, fewer than
    there are chunks, go through the chunks. ``df`` is computed once, and once more with hot keys.
    """
    chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = sizes.agg((F.sum("n") / chunks).alias("share"))
    hot = cut_lineage(sizes.where(F.col("n") > share.scalar()).select(*[F.col(name).alias(f"_h_{name}") for name in spec.key]))
    is_hot = [F.col(name).eqNullSafe(F.col(f"_h_{name}")) for name in spec.key]
    any_hot = not hot.isEmpty()
    rest = df.join(F.broadcast(hot), is_hot, "left_anti") if any_hot else df

    whole = Window.partitionBy(*spec.key)
    along = whole.orderBy(*spec.order)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added: dict[str, Column] = {out: F.sum(src).over(so_far) for out, src in spec.sums.items()}
    added |= {out: F.lag(src).over(along) for out, src in spec.previous.items()}
    added |= {out: F.lead(src).over(along) for out, src in spec.following.items()}
    added |= {out: F.first(src).over(so_far) for out, src in spec.first.items()}
    added |= {spec.position: F.row_number().over(along)} if spec.position else {}
    added |= {spec.size: F.count(F.lit(1)).over(whole)} if spec.size else {}
    plain = rest.withColumns(added)
    return plain.unionByName(run_ordered(df.join(F.broadcast(hot), is_hot, "left_semi"), spec)) if any_hot else plain


def with_positions(df: DataFrame, order: list[str], out: str = "report_position", settled: bool = False) -> DataFrame:
    """``df`` with the 1-based place of every row in a report sorted by ``order``, ascending SQL
    expressions that together are unique; nulls come first. No task sees more than a chunk of the report.
    ``settled`` as in ``run_ordered``."""
    by = {f"_by_{i}": F.expr(expression) for i, expression in enumerate(order)}
    placed = run_ordered(df.withColumns(by | {"_one": F.lit(1)}), Running(key=["_one"], order=list(by), position=out, one_key=True), settled)
    return placed.select(*df.columns, out)
