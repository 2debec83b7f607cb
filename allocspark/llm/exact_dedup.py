"""Exact deduplication: a Bloom filter in two passes keeps unique rows out of the shuffle.

Pass 1 counts the filter slots of every normalised text (two slots a text) and keeps, as bitmaps,
the slots that were hit more than once. Pass 2 tests every row against these bitmaps: a text with
a slot hit only once is certainly unique and passes straight through; the others, true repeats and
a few false alarms, shuffle by their SHA-256 and are grouped exactly.

The filter has ``filter_bits`` bits at any input size, so its broadcast is at most
``filter_bits / 8`` bytes (32 MB as set). A fuller filter only sends more unique rows through the
shuffle; the result never depends on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from allocspark.llm.common import cut_lineage, free_name, replace_columns, text_or_empty

#: Deleted before texts are compared: ``[\x20\x09-\x0D]``.
WHITE_SPACE = " \t\n\x0b\x0c\r"
FILTER_BITS = 1 << 28
#: Bits in one bitmap of ``bitmap_construct_agg``.
BITMAP_BITS = 32_768
DECISIONS = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text_col: str) -> Column:
    result = text_or_empty(text_col)
    for blank in WHITE_SPACE:
        result = F.replace(result, F.lit(blank), F.lit(""))
    return result


def _slots(value: Column, filter_bits: int) -> tuple[Column, Column]:
    """Two slots of a 64-bit hash."""
    return value.bitwiseAND(F.lit(filter_bits - 1)), F.shiftrightunsigned(value, 32).bitwiseAND(F.lit(filter_bits - 1))


def repeated_slots(df: DataFrame, text_col: str, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Pass 1: (segment, bits) bitmaps of the slots that more than one text hit."""
    hashes = df.select(F.xxhash64(normalised(text_col)).alias("value"))
    slots = hashes.select(F.explode(F.array(*_slots(F.col("value"), filter_bits))).alias("slot"))
    repeated = slots.groupBy("slot").count().where("count > 1")
    return repeated.groupBy(F.shiftright("slot", 15).alias("segment")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(BITMAP_BITS - 1))).alias("bits"))


def _bit(bits: Column, slot: Column) -> Column:
    place = slot.bitwiseAND(F.lit(BITMAP_BITS - 1))
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                filter_bits: int = FILTER_BITS, one_row: bool = False) -> DataFrame:
    """Every row of ``df`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when they are after deleting white space; null counts as empty. Of equal texts
    the row with the most code points stays, then the smallest id; null ids come last. Rows that
    repeat an id and a text count in group_size and share one decision, unless ``one_row`` asks for one
    row only (the one with the smallest hash of the whole row; of equal rows any). Input columns named
    like a result column are replaced; an empty table gives an empty result.
    """
    if filter_bits & (filter_bits - 1) or not BITMAP_BITS <= filter_bits <= 1 << 32:
        raise ValueError("filter_bits has to be a power of two from 32768 to 2**32")
    rows = replace_columns(df, DECISIONS)
    flag = free_name(rows, "_repeat")
    normal = free_name(rows, "_normal")
    tested = _with_flag(rows, text_col, filter_bits, normal, flag)
    digest = F.sha2(F.col(normal), 256)

    columns = [F.col(f"`{c}`") for c in rows.columns]
    passed = tested.where(~F.col(flag)).select(
        *columns, F.col(f"`{id_col}`").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), digest.alias("text_sha256"))

    suspects = tested.where(F.col(flag)).select(*columns, digest.alias("text_sha256"))
    if one_row:
        suspects = cut_lineage(suspects)  # read several times
    parts = [(-F.length(text_or_empty(text_col))).alias("size"), F.col(f"`{id_col}`").isNull().alias("unknown"), F.col(f"`{id_col}`").alias("id")]
    if one_row:
        parts.append(F.xxhash64(*columns).alias("row"))
    order = F.struct(*parts)
    key, copies = free_name(suspects, "_digest"), free_name(suspects, "_copies")
    # Only the order key travels to the groups, not the text.
    ordered = suspects.select("text_sha256", order.alias("order"))
    if one_row:
        ordered = ordered.groupBy("text_sha256", "order").agg(F.count("*").alias("n"))
        groups = ordered.groupBy("text_sha256").agg(
            F.min("order").alias("best"), F.sum("n").alias("group_size"), F.min_by("n", "order").alias(copies))
    else:
        groups = ordered.groupBy("text_sha256").agg(
            F.min("order").alias("best"), F.count("*").alias("group_size"), F.lit(1).cast("long").alias(copies))
    # Joined by the digest's bytes, so that the groups are dealt out anew: then both sides are plain
    # shuffles, and Spark can split a partition that a very large group of copies fills.
    groups = groups.select(F.unhex("text_sha256").alias(key), "best", "group_size", copies)
    kept = F.col("best.id").eqNullSafe(F.col(f"`{id_col}`"))
    if one_row:
        kept = kept & (F.col("best.size") == parts[0]) & (F.col("best.row") == parts[3])
    settled = suspects.withColumn(key, F.unhex("text_sha256")).join(groups, key, "left").select(
        *columns, F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", copies)
    if one_row:
        # Only rows that the best one repeats in every column are told apart by a place.
        place = free_name(settled, "_place")
        same = F.col("kept") & (F.col(copies) > 1)
        numbered = settled.where(same).withColumn(place, F.row_number().over(Window.partitionBy("text_sha256").orderBy(copies)))
        settled = settled.where(~same).unionByName(numbered.withColumn("kept", F.col(place) == 1).drop(place))
    return passed.unionByName(settled.drop(copies))


def _with_flag(rows: DataFrame, text_col: str, filter_bits: int, normal: str, flag: str) -> DataFrame:
    """Pass 2: ``flag`` is false where a slot of the text, kept as ``normal``, was hit once only."""
    names = [free_name(rows, n) for n in ("_slot_a", "_slot_b", "_bits_a", "_bits_b")]
    bitmaps = repeated_slots(rows, text_col, filter_bits)
    value = free_name(rows, "_value")
    # Steps of their own, so that each text is normalised once.
    tested = rows.withColumn(normal, normalised(text_col)).withColumn(value, F.xxhash64(normal))
    tested = tested.withColumns(dict(zip(names[:2], _slots(F.col(value), filter_bits)))).drop(value)
    for slot, bits in zip(names[:2], names[2:]):
        segment = free_name(tested, "_segment")
        # At most filter_bits / 32768 rows of 4 KB each, whatever the input size.
        side = F.broadcast(bitmaps.select(F.col("segment").alias(segment), F.col("bits").alias(bits)))
        tested = tested.join(side, F.shiftright(F.col(slot), 15) == F.col(segment), "left").drop(segment)
    both = _bit(F.col(names[2]), F.col(names[0])) & _bit(F.col(names[3]), F.col(names[1]))
    return tested.withColumn(flag, both).drop(*names)


ORACLE_SQL = r"""
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       first_value(doc_id) over w = doc_id as kept,
       text_sha256
from (select doc_id, length(coalesce(text, '')) as size,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
      from documents)
window w as (partition by text_sha256 order by size desc, doc_id)
"""
