"""Mixing sources to target weights by Sainte-Laguë apportionment.

The size of a document is its number of words. Sources stand in code point order, those without a
name last, and weigh 1, 2, 3, repeating. Targets share all words by weight; a target stops
at three times its source's size, and the excess is shared again by weight until none is above.

1. *Sources.* One row per source with its size. Numbers come from a range-partitioned sort with
   counts per partition, so no task sees all sources; each round of capping is one sum.
2. *Blocks to sources.* Blocks hold ``BLOCK`` words each. The m-th block of a source has the quotient
   target / (2m - 1), and blocks go to the highest quotients, as long as one is worth half
   a block. That is the house of which a block stands for ``BLOCK`` words, so the seats of a source are
   those with a quotient of ``BLOCK`` / 2 or more, a number each source knows alone.
3. *Blocks to shards.* A source is dealt by a seeded hash into shards of about ``SHARD`` words (at most
   ``MOST_SHARDS``, then larger ones). The source's blocks go to its shards by highest quotients
   again, a shard's votes being the blocks it holds, equal quotients by shard number.
4. *Selection.* The documents of a shard are laid end to end in seeded hash order and cut into
   blocks. With q blocks to take of k, block i is taken floor(((i + 1)q + u) / k) - floor((iq + u) / k) times,
   u being a seeded start in [0, k): each block is taken floor(q/k) or ceil(q/k) times, evenly
   spread over the shuffled shard. A document takes the words it has in taken blocks, which has a closed
   form in the words before it, so no block is ever written out.

A source's blocks are at most three times what its shards hold, so no document is taken more than
three times. Everything is whole numbers and MD5, so reruns, other partitionings and other engines
agree. Joins to the source table are salted: a source with a third of all rows is dealt to ``SALTS``
tasks at least.

Edge cases: null and empty texts have size 0 and take nothing; a long text may hold many blocks; a source
without words has target 0; a null source is a source of its own, last; null ids count as one more id;
repeated rows are rows of their own, and equal ones differ in nothing but what they take; an empty
table gives no rows. Only the named columns are read, so others, whatever their names, do not matter.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.batches import stored

BLOCK = 16
SHARD, MOST_SHARDS = 1 << 18, 1 << 14
SALTS = 32
WEIGHTS, MOST_TIMES, SEED = 3, 3, 42
_WORD = r"[^\x20\x09-\x0D]+"


def numbered(df: DataFrame, order: list[Column], name: str, number: str = "number") -> DataFrame:
    """Add each row's 0-based place in the order, over all partitions, and store the table.

    Rows are range-partitioned and counted per partition; the running counts are one row per
    partition. Rows that are equal in the order get places in any order.
    """
    placed = stored(
        df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), f"{name}-ranges"
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__part").agg(F.count("*").alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(before), F.lit(0))
    ).drop("__n")
    inner = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    counted = placed.withColumn("__place", inner).join(F.broadcast(starts), "__part")
    whole = (F.col("__before") + F.col("__place") - 1).cast("long")
    return stored(counted.withColumn(number, whole).drop("__part", "__place", "__before"), name)


def targets(sources: DataFrame) -> DataFrame:
    """Add ``target`` to a table of ``size`` and ``weight``."""
    weight, size = F.col("weight"), F.col("size")
    level = None  # words per unit of weight of the sources that are not capped
    while True:
        capped = F.lit(False) if level is None else F.lit(level) * weight > MOST_TIMES * size
        total, fixed, shared = sources.agg(
            F.sum("size"), F.sum(F.when(capped, MOST_TIMES * size).otherwise(0)),
            F.sum(F.when(capped, 0).otherwise(weight)),
        ).first()
        if not total or not shared:
            return sources.withColumn("target", F.lit(0.0))
        raised = (total - fixed) / shared
        if raised == level:
            break
        level = raised
    share = F.lit(total - fixed).cast("double") * weight / F.lit(shared).cast("double")
    return sources.withColumn(
        "target", F.when(capped, (MOST_TIMES * size).cast("double")).otherwise(share)
    )


def seats(votes: Column, worth: float) -> Column:
    """Blocks with a quotient votes / (2m - 1) of half a block's worth or more."""
    return F.floor(votes / F.lit(float(worth)) + 0.5).cast("long")


def highest_quotients(votes: list[int], house: int) -> list[int]:
    """Sainte-Laguë seats of a house of the given size; equal quotients go to the lowest number."""
    total = sum(votes)
    if not total:
        return [0] * len(votes)
    # Rounding loses at most half a seat each, so these seats are certain; the rest, at most
    # one and a half per shard, go one by one to the highest quotient.
    given = [max(0, v * (2 * house - len(votes)) // (2 * total)) for v in votes]
    queue = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, given))]
    heapq.heapify(queue)
    for _ in range(house - sum(given)):
        _, i = queue[0]
        given[i] += 1
        heapq.heapreplace(queue, (-votes[i] / (2 * given[i] + 1), i))
    return given


def _shard_seats(rows: pd.DataFrame) -> pd.DataFrame:
    """The seats of the shards of one source, a bounded number of rows."""
    rows = rows.sort_values("shard", ignore_index=True)
    rows["take"] = highest_quotients(rows["blocks"].tolist(), int(rows["house"].iloc[0]))
    return rows[["number", "shard", "blocks", "take"]]


def _digest(*parts: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), *parts))


def _pick(digest: Column, buckets: str) -> Column:
    """A number in [0, buckets) from a digest."""
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.col(buckets))


def taken_before(words: str) -> Column:
    """Words taken of the first ``words`` of a shard, of which ``take`` of ``blocks`` are taken."""
    i = f"div({words}, {BLOCK})"
    upto, after = f"div({i} * take + start, blocks)", f"div(({i} + 1) * take + start, blocks)"
    return F.expr(f"{BLOCK} * {upto} + ({words} - {BLOCK} * {i}) * ({after} - {upto})")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: key, size, source_size, target, taken."""
    size = F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")
    sized = stored(
        docs.select(
            F.col(key).alias("id"), F.col(source).cast("string").alias("source"), size.alias("size")
        ),
        "sizes",
    )
    total = sized.groupBy("source").agg(F.sum("size").alias("size"))
    places = numbered(total, [F.col("source").asc_nulls_last()], "sources")
    shards = F.least(F.lit(MOST_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("size") / SHARD)))
    sources = targets(places.withColumn("weight", F.col("number") % WEIGHTS + 1)).select(
        F.col("source").alias("name"), "number", F.col("size").alias("source_size"), "target",
        seats(F.col("target"), BLOCK).alias("house"), shards.cast("long").alias("shards"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salted"),
    )
    same = F.col("source").eqNullSafe(F.col("name")) & (F.col("salt") == F.col("salted"))
    placed = stored(
        sized.withColumn("digest", _digest("id"))
        .withColumn("salt", F.pmod(F.xxhash64("digest", "size"), F.lit(SALTS)).cast("int"))
        .join(stored(sources, "targets"), same)
        .withColumn("shard", _pick(F.col("digest"), "shards"))
        .drop("source", "name", "salt", "salted", "shards"),
        "placed",
    )
    blocks = F.ceil(F.sum("size") / BLOCK).cast("long")
    held = placed.groupBy("number", "shard", "house").agg(blocks.alias("blocks"))
    given = held.groupBy("number").applyInPandas(
        _shard_seats, "number long, shard long, blocks long, take long"
    )
    # A shard without words has no block; one keeps the arithmetic whole.
    drawn = stored(given.withColumn("blocks", F.greatest("blocks", F.lit(1))), "quotas").withColumn(
        "start", _pick(_digest("number", "shard"), "blocks")
    )
    in_order = Window.partitionBy("number", "shard").orderBy("digest", "id", "size")
    before = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    laid = placed.withColumn("__from", F.coalesce(before, F.lit(0))).withColumn(
        "__to", F.col("__from") + F.col("size")
    )
    return laid.join(drawn, ["number", "shard"]).select(
        F.col("id").alias(key), "size", "source_size", "target",
        (taken_before("__to") - taken_before("__from")).alias("taken"),
    )


def oracle() -> str:
    digest = "('0x' || substr(md5({}), 1, 8))::BIGINT"
    taken = (
        "{b} * ((({x} // {b}) * take + start) // blocks) + ({x} - {b} * ({x} // {b})) "
        "* (((({x} // {b}) + 1) * take + start) // blocks - (({x} // {b}) * take + start) // blocks)"
    )
    upto, before = (taken.format(b=BLOCK, x=x) for x in ("upto", "(upto - size)"))
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5(concat_ws('|', '{SEED}', doc_id)) AS digest,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, size, number, number % {WEIGHTS} + 1 AS weight,
    greatest(1, least({MOST_SHARDS}, ceil(size / {SHARD}::DOUBLE)::BIGINT)) AS shards
  FROM (SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
        FROM sized GROUP BY source)
), levels AS (
  SELECT 0 AS round, 0::DOUBLE AS level
  UNION ALL
  SELECT round + 1, (SELECT (sum(size) - sum(CASE WHEN level * weight > {MOST_TIMES} * size THEN {MOST_TIMES} * size ELSE 0 END))::DOUBLE
      / sum(CASE WHEN level * weight > {MOST_TIMES} * size THEN 0 ELSE weight END)::DOUBLE FROM sources)
  FROM levels WHERE round < 50
), capped AS (
  SELECT s.*, level * weight > {MOST_TIMES} * size AS capped
  FROM sources s, (SELECT max(level) AS level FROM levels)
), shared AS (
  SELECT (sum(size) - sum(CASE WHEN capped THEN {MOST_TIMES} * size ELSE 0 END))::DOUBLE AS rest,
    sum(CASE WHEN capped THEN 0 ELSE weight END)::DOUBLE AS weights FROM capped
), targets AS (
  SELECT source, size AS source_size, number, shards,
    CASE WHEN capped THEN ({MOST_TIMES} * size)::DOUBLE ELSE rest * weight / weights END AS target
  FROM capped, shared
), houses AS (
  SELECT *, len(list_filter(range(1, (target / {BLOCK})::BIGINT + 3), lambda m: target / (2 * m - 1) >= {BLOCK} / 2)) AS house
  FROM targets
), placed AS (
  SELECT d.*, h.number, h.source_size, h.target, h.house, ('0x' || substr(digest, 1, 8))::BIGINT % shards AS shard
  FROM sized d JOIN houses h ON d.source IS NOT DISTINCT FROM h.source
), shards AS (
  SELECT number, shard, house, ceil(sum(size) / {BLOCK}::DOUBLE)::BIGINT AS blocks
  FROM placed GROUP BY number, shard, house
), quotients AS (
  SELECT number, shard, house, blocks / (2 * m - 1) AS quotient, m
  FROM (SELECT *, unnest(range(1, {MOST_TIMES} * blocks + 1)) AS m FROM shards)
), quotas AS (
  SELECT number, shard, count(*) AS take FROM (
    SELECT number, shard, house, row_number() OVER (PARTITION BY number ORDER BY quotient DESC, shard, m) AS place FROM quotients
  ) WHERE place <= house GROUP BY number, shard
), drawn AS (
  SELECT number, shard, blocks, take, {digest.format(f"concat_ws('|', '{SEED}', number, shard)")} % blocks AS start
  FROM (SELECT s.number, s.shard, greatest(blocks, 1) AS blocks, coalesce(take, 0) AS take
        FROM shards s LEFT JOIN quotas q ON s.number = q.number AND s.shard = q.shard)
), laid AS (
  SELECT *, sum(size) OVER (PARTITION BY number, shard ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM placed
)
SELECT doc_id, size, source_size, target, (({upto}) - ({before}))::BIGINT AS taken
FROM laid JOIN drawn USING (number, shard)
"""
