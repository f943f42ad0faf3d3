"""Embedding near-dedup by a pivot-permutation index.

Reference points (pivots) come from a bounded sample of the vectors, thinned so that no two
are close: pivots inside one dense cloud would be ordered by chance for all its members. Their number
grows with the root of the vectors, up to ``MOST_PIVOTS``. Every vector is described by its ``nearest``
pivots in order of cosine, and stands, within its label, in the inverted list of every two of them. So vectors
meet in a list only if they share two pivots, and as the number of lists grows with the square of the pivots, lists of
unrelated vectors do not grow with the table (beyond ``MOST_PIVOTS`` squared vectors they do, slowly).

Lists hold ids and are counted first; vectors are fetched only for lists of two or more. Candidates
are verified by cosine in double precision, so no link below the threshold is reported. A pair that
meets in several lists is counted in the list of its first two shared pivots only.

Lists are worked on as matrices and never written as pairs. A list above ``BLOCK`` vectors is
cut by hash into blocks, one task per pair of blocks; small lists share a task. A task
gives one row per vector: its links there and the least vector it is joined with. Equal
vectors of a label are one entry with a count.

Ties: of the nearest pivots, equal cosines put the smaller number first; a cosine at the threshold links.

Edge cases: vectors that are null, empty, zero, or hold a null or non-finite component, rows
with a null label or a null id link with nothing and are kept; rows that share an id but not a
vector each have the links of their own; vectors of different length never link;
an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from skyledger.llm.batches import sample_rows, stored
from skyledger.llm.components import components, least_reached

THRESHOLD = 0.98
NEAREST = 6
LEAST_PIVOTS, MOST_PIVOTS, PER_ROOT = 64, 4096, 8  # pivots per root of the vectors
SAMPLE, APART = 4, 0.6  # vectors looked at per pivot, and the largest cosine of two pivots
BLOCK, PER_TASK = 512, 4000


def unit_rows(values: list) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so no square overflows."""
    rows = np.array(values, dtype=np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def usable(vector: str):
    """Whether a vector can have a cosine."""
    v = F.col(vector)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda e: e != 0), F.lit(False))


def pivot_count(vectors: int) -> int:
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, int(PER_ROOT * vectors**0.5)))


def choose_pivots(entries: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """Reference points per vector length, from ``SAMPLE`` distinct vectors by hash for each wanted."""
    rows = sample_rows(entries.select("dim", "vector").distinct(), SAMPLE * pivots, by="dim").toArrow()
    made: dict[int, list] = {}
    for dim, vector in zip(rows.column("dim").to_pylist(), rows.column("vector").to_pylist()):
        made.setdefault(dim, []).append(vector)
    return {dim: _apart(unit_rows(sorted(v)), pivots) for dim, v in made.items()}


def _apart(rows: np.ndarray, most: int) -> np.ndarray:
    """Rows in order, each only if it is not close to one already taken."""
    taken, n = np.empty((min(most, len(rows)), rows.shape[1])), 0
    for row in rows:
        if n == len(taken):
            break
        if not n or (taken[:n] @ row).max() < APART:
            taken[n], n = row, n + 1
    return taken[:n]


def describe(entries: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST) -> DataFrame:
    """Add ``order``, the numbers of the nearest pivots, nearest first."""
    shared = entries.sparkSession.sparkContext.broadcast(pivots)
    schema = T.StructType([*entries.schema.fields, T.StructField("order", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector")).to_pylist()
            dims = np.array([len(v) for v in vectors])
            orders: list = [None] * len(vectors)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                cosine = unit_rows([vectors[i] for i in at]) @ shared.value[int(dim)].T
                n = min(nearest, cosine.shape[1])
                best = np.sort(np.argpartition(-cosine, n - 1, axis=1)[:, :n], axis=1)
                inner = np.argsort(-np.take_along_axis(cosine, best, axis=1), axis=1, kind="stable")
                for i, row in zip(at, np.take_along_axis(best, inner, axis=1)):
                    orders[i] = row.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(orders, pa.list_(pa.int32()))], names=schema.names
            )

    return entries.mapInArrow(run, schema)


def _verify(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, dim, _, q), group in rows.groupby(["label", "dim", "p", "q"], sort=False):
            ids, weight = group["node"].to_numpy(), group["copies"].to_numpy()
            vectors = unit_rows(group["vector"].to_list())
            known, orders = np.unique(np.stack(group["order"].to_list()), return_inverse=True)
            orders = orders.reshape(len(ids), -1)
            marks = np.zeros((len(ids), len(known)), np.float32)
            np.put_along_axis(marks, orders, 1, axis=1)
            block = group["block"].to_numpy()
            if (block == block[0]).all():
                first = second = np.arange(len(ids))
            else:
                first, second = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
            # The pair's first two shared pivots are p and q: no shared one before q but p.
            upto = int(np.searchsorted(known, q, side="right"))
            here = marks[first, :upto] @ marks[second, :upto].T <= 2
            found = here & (vectors[first] @ vectors[second].T >= threshold)
            if first is second:
                found &= np.triu(np.ones(found.shape, bool), 1)
            links = np.zeros((len(ids), len(ids)), bool)
            links[np.ix_(first, second)] = found
            links |= links.T
            out.append(pd.DataFrame({
                "node": ids, "links": links @ weight, "least": least_reached(ids, links),
            }))
        return pd.concat(out)[lambda d: d["links"] > 0]

    return run


def _twos(order: str):
    """(p, q) of every two pivots of a description, p before q; of a single one, itself twice."""
    o = F.array_sort(order)
    last = F.size(order) - 1
    two = F.flatten(F.transform(
        F.sequence(F.lit(0), last - 1),
        lambda i: F.transform(
            F.sequence(i + 1, last),
            lambda j: F.struct(F.get(o, i).alias("p"), F.get(o, j).alias("q")),
        ),
    ))
    one = F.array(F.struct(F.get(o, F.lit(0)).alias("p"), F.get(o, F.lit(0)).alias("q")))
    return F.when(last > 0, two).otherwise(one)


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    threshold: float = THRESHOLD, pivots: int | None = None, nearest: int = NEAREST,
) -> DataFrame:
    """One row per vector: key, links, component (least key reachable), kept."""
    rows = df.select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label")
    ).withColumn("ok", usable("vector") & F.col("label").isNotNull() & F.col("id").isNotNull())
    entries = stored(
        rows.filter("ok").groupBy("label", "vector").agg(
            F.min("id").alias("first"), F.count("*").alias("copies")
        ).withColumns({"dim": F.size("vector"), "node": F.monotonically_increasing_id()}),
        "entries",
    )
    found_pivots = choose_pivots(entries, pivots or pivot_count(entries.count()))
    described = stored(describe(entries, found_pivots, nearest), "described")
    where = ["label", "dim", "p", "q"]
    listed = described.select("node", "label", "dim", F.inline(_twos("order")))
    sizes = stored(
        listed.groupBy(*where).agg(F.count("*").alias("size")).filter("size > 1"), "list-sizes"
    )
    # Only ids up to here; vectors are fetched for lists that hold a pair.
    meeting = stored(listed.join(sizes, where), "lists")
    tasks = meeting.count() // PER_TASK + 1
    fetched = meeting.join(described.select("node", "copies", "vector", "order"), "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    spread = (
        fetched.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({
            "low": F.least("block", "other"), "high": F.greatest("block", "other"),
            "cut": F.col("blocks") > 1,
            "task": F.when(F.col("blocks") > 1, F.xxhash64(*where)).otherwise(
                F.pmod(F.xxhash64(*where), F.lit(tasks))
            ),
        })
        .select(*where, "node", "copies", "vector", "order", "block", "cut", "task", "low", "high")
    )
    found = stored(
        spread.groupBy("cut", "task", "low", "high").applyInPandas(
            _verify(threshold), "node long, links long, least long"
        ),
        "vector-links",
    )
    joined = stored(
        components(
            found.filter("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")),
            "vectors",
        ).join(entries.select("node", "first"), "node"),
        "joined-vectors",
    )
    least = stored(
        joined.groupBy("component").agg(F.min("first").alias("component_id")), "least-vectors"
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    entry = stored(
        entries.join(links, "node", "left")
        .join(joined.select("node", "component").join(least, "component"), "node", "left")
        .select(
            "label", "vector", F.lit(True).alias("ok"), "copies", "links",
            F.coalesce("component_id", "first").alias("component_id"),
        ),
        "entry-results",
    )
    made = rows.join(entry, ["label", "vector", "ok"], "left")
    count = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    out = made.select(
        F.col("id").alias(key), count.cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def oracle(threshold: float = THRESHOLD) -> str:
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {threshold}
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT l.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN degree d ON d.vec_id = l.vec_id
"""
