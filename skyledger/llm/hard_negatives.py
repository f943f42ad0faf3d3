"""Hard negatives by angular triangle filtering.

Each row's angles to a few reference directions (taken from a bounded sample) and its norm are
stored. By the triangle inequality on the sphere, the angle between an anchor and a row lies between
the largest difference and the least sum of their angles to a reference. That gives an
interval for the cosine and, times both norms, for the score. Rows are ordered by label, nearest
reference and angle to it, and cut into blocks of ``ROWS``, and those into windows of ``WINDOW``
rows with the extremes of their angles and norms. Only what overlaps is scored:

1. *Floors.* Anchors are scored against the block they stand in, which holds their own label;
   the 5th best score there is a floor for their positives.
2. *Positives.* Pairs of an anchor block and a row block of the same label are kept if their bound
   reaches a floor. Only then are rows sent, and inside, windows are filtered per anchor the same way.
3. *Negatives.* The same with other labels and the score range each positive allows. A task raises
   the lower end as soon as it holds enough rows.

Bounds are widened by more than their rounding error. Scores are inner products of whole
numbers, exact: in doubles where the norms prove that no sum can pass 2**53, else in 64-bit integers. A
pair of blocks gives each anchor and positive at most as many rows as can be in the result. Anchors are
read in blocks of ``ANCHORS``; neither they nor the rows pass through the driver.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component take no part;
equal rows count once, rows that share an id but not the vector are rows of their own; zero and empty vectors
take part with scores of 0; vectors of different length never meet; components beyond 2**25 after
scaling count as 2**25, so no score overflows; ties go to the smaller id; a positive whose range
holds no row, such as one with a negative score, has no rows; an empty table gives no rows. Only the
named columns are read, so others, whatever their names, do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skyledger.llm.batches import sample_rows, stored
from skyledger.llm.mixing import numbered

POSITIVES, NEGATIVES, EVERY = 5, 3, 50
REFERENCES, SAMPLE = 16, 2048
ROWS, ANCHORS, WINDOW = 4096, 4096, 64
MOST = 1 << 25
PENDING = 200_000  # scored rows that a task holds before it keeps only the best
_SLACK = 1e-7  # radians; an arc cosine near its ends is no closer than 1e-8


def whole_numbers(df: DataFrame, key: str, vector: str, label: str, scale: int = 256) -> DataFrame:
    """(id, label, dim, v): rows that take part, with components as whole numbers."""
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    floor = lambda e: F.greatest(
        F.lit(-MOST), F.least(F.lit(MOST), F.floor(e.cast("double") * scale))
    ).cast("int")
    rows = df.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).alias("x"),
    ).filter("id is not null and label is not null and x is not null").filter(~bad)
    return rows.select(
        "id", "label", F.size("x").alias("dim"), F.transform("x", floor).alias("v")
    ).distinct()


def _matrix(column: pa.ChunkedArray | pa.Array, width: int, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros((0, width), kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _units(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm == 0, 1, norm)


def references(rows: DataFrame, most: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Per vector length, directions of sampled vectors, each the farthest from those before it."""
    found = sample_rows(rows.select("dim", "v").distinct(), sample, by="dim").toArrow()
    made: dict[int, list] = {}
    for dim, v in sorted(zip(found.column("dim").to_pylist(), found.column("v").to_pylist())):
        made.setdefault(dim, []).append(v)
    out = {}
    for dim, vectors in made.items():
        units = _units(np.array(vectors, np.float64).reshape(len(vectors), dim))
        taken, nearest = [0], units @ units[0]
        while len(taken) < min(most, len(units)):
            taken.append(int(np.argmin(nearest)))
            nearest = np.maximum(nearest, units @ units[taken[-1]])
        out[dim] = units[np.resize(taken, most)]
    return out


def describe(rows: DataFrame, directions) -> DataFrame:
    """Add the norm, the angles to all references, the nearest one and the angle to it."""

    def run(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            flat = batch.column(3)
            norm, angle = np.zeros(len(dims)), np.zeros((len(dims), REFERENCES))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                v = _matrix(flat.take(pa.array(at)), int(dim))
                norm[at] = np.sqrt((v * v).sum(axis=1))
                cosine = _units(v) @ directions.value[int(dim)].T
                angle[at] = np.arccos(np.clip(cosine, -1, 1))
            near = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(norm),
                    pa.ListArray.from_arrays(
                        np.arange(0, angle.size + 1, REFERENCES, dtype=np.int32), angle.ravel()
                    ),
                    pa.array(near.astype(np.int32)), pa.array(angle[np.arange(len(dims)), near]),
                ],
                names=[*batch.schema.names, "norm", "angles", "near", "beta"],
            )

    return rows.mapInArrow(
        run, "id long, label long, dim int, v array<int>, norm double, angles array<double>, near int, beta double"
    )


def score_bounds(a, b):
    """Least and largest scores between two groups, each (norm lo, norm hi, angles lo, angles hi).

    The norms broadcast against each other; the angles do with one more axis, the references.
    """
    least = most = None
    for r in range(a[2].shape[-1]):
        alo, ahi, blo, bhi = a[2][..., r], a[3][..., r], b[2][..., r], b[3][..., r]
        apart = np.maximum(alo - bhi, blo - ahi)
        wide = np.where(
            ahi + bhi <= np.pi, ahi + bhi, np.where(alo + blo >= np.pi, 2 * np.pi - alo - blo, np.pi)
        )
        least = apart if least is None else np.maximum(least, apart)
        most = wide if most is None else np.minimum(most, wide)
    high = np.cos(np.clip(least - _SLACK, 0, np.pi))
    low = np.cos(np.clip(most + _SLACK, 0, np.pi))
    small, large = a[0] * b[0], a[1] * b[1]
    slack = 1 + 1e-9 * large
    return (
        np.where(low < 0, large, small) * low - slack,
        np.where(high > 0, large, small) * high + slack,
    )


class Top:
    """The best rows of each slot: score descending, then id; ends of the scores that count."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = low.copy(), high, most
        self.held = [np.zeros(0, np.int64)] * 3
        self.pending: list[list[np.ndarray]] = []
        self.size = 0
        self.ids = None

    def add(self, slot, score, row) -> None:
        self.pending.append([slot, score, row])
        self.size += len(slot)
        if self.size > PENDING:
            self.trim()

    def trim(self) -> None:
        slot, score, row = (np.concatenate(c) for c in zip(self.held, *self.pending))
        order = np.lexsort((row, self.ids[row], -score, slot))
        slot, score, row = slot[order], score[order], row[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        full = place == self.most - 1
        self.low[slot[full]] = np.maximum(self.low[slot[full]], score[full])
        best = place < self.most
        self.held, self.pending, self.size = [slot[best], score[best], row[best]], [], 0


def _whole(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _score_pair(most: int, slots: int, same: bool):
    """Best rows of the slots of every anchor of one group, among the rows of one block."""

    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        role = table.column("anchor").to_numpy()
        left, right = table.filter(pa.array(role)), table.filter(pa.array(~role))
        right = right.sort_by("number")
        v, q = (_matrix(t.column("v"), dim) for t in (right, left))
        exact = max(float(left.column("norm").to_numpy().max(initial=0)), 1.0) * max(
            float(right.column("norm").to_numpy().max(initial=0)), 1.0
        ) < 2**53
        if not exact:
            v, q = v.astype(np.int64), q.astype(np.int64)
        number, mine = _whole(right.column("number")), _whole(left.column("number"))
        anchor_label, label = _whole(left.column("label")), int(right.column("label")[0].as_py())
        fits = (anchor_label == label) if same else (anchor_label != label)
        low = _matrix(left.column("low"), slots, np.int64)
        high = _matrix(left.column("high"), slots, np.int64)
        best = Top(low.ravel(), high.ravel(), most)
        best.ids = _whole(right.column("id"))
        low = best.low.reshape(low.shape)  # raised in place by the best rows
        starts = np.arange(0, len(number), WINDOW)
        angles = _matrix(right.column("angles"), REFERENCES)
        norm, ours = right.column("norm").to_numpy(), left.column("norm").to_numpy()
        theirs = _matrix(left.column("angles"), REFERENCES)[:, None, :]
        lower, upper = score_bounds(
            (ours[:, None], ours[:, None], theirs, theirs),
            (
                np.minimum.reduceat(norm, starts)[None, :], np.maximum.reduceat(norm, starts)[None, :],
                np.minimum.reduceat(angles, starts)[None, :], np.maximum.reduceat(angles, starts)[None, :],
            ),
        )
        for w in np.argsort(-upper.max(axis=0, initial=-np.inf), kind="stable"):
            overlaps = (upper[:, w, None] >= low) & (lower[:, w, None] <= high) & (low <= high)
            some = np.flatnonzero(overlaps.any(axis=1) & fits)
            if not len(some):
                continue
            at = slice(starts[w], starts[w] + WINDOW)
            score = (q[some] @ v[at].T).astype(np.int64)
            other = mine[some][:, None] != number[at][None, :]
            for s in range(slots):
                good = other & (score >= low[some, s, None]) & (score <= high[some, s, None])
                a, r = np.nonzero(good)
                best.add(some[a] * slots + s, score[a, r], r + starts[w])
        best.trim()
        slot, score, row = best.held
        return pa.table({
            "anchor": mine[slot // slots], "slot": (slot % slots).astype(np.int32),
            "score": score, "number": number[row], "id": best.ids[row],
        })

    return run


def _ends(prefix: str = ""):
    """Extremes of norms and angles of a group of rows."""
    angle = [F.get("angles", F.lit(i)) for i in range(REFERENCES)]
    return [
        F.min("norm").alias(f"{prefix}nlo"), F.max("norm").alias(f"{prefix}nhi"),
        F.array(*[F.min(a) for a in angle]).alias(f"{prefix}alo"),
        F.array(*[F.max(a) for a in angle]).alias(f"{prefix}ahi"),
    ]


def _pairs(anchors: DataFrame, rows: DataFrame, groups: int, same: bool) -> DataFrame:
    """(dim, group, block) of the groups of anchors and blocks of rows whose scores may overlap.

    A row per group of anchors and label, with the range of scores it still wants, meets a row per block.
    """
    asked = anchors.filter(F.exists(F.arrays_zip("low", "high"), lambda e: e["low"] <= e["high"]))
    kinds = asked.groupBy("dim", "group", "label").agg(
        *_ends("q"), F.min(F.array_min("low")).alias("low"), F.max(F.array_max("high")).alias("high")
    ).withColumnRenamed("label", "qlabel")
    # Blocks take all group numbers: n rows become n / ROWS * groups small rows, never pairs of rows.
    blocks = rows.groupBy("dim", "label", "block").agg(*_ends()).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    equal = F.col("label") == F.col("qlabel")
    met = stored(kinds, "anchor-ends").join(stored(blocks, "block-ends"), ["dim", "group"]).filter(
        equal if same else ~equal
    )
    columns = ["dim", "group", "block", "qnlo", "qnhi", "qalo", "qahi", "nlo", "nhi", "alo", "ahi", "low", "high"]

    def run(batches):
        for batch in batches:
            def ends(first):
                lo, hi = (batch.column(i).to_numpy() for i in (first, first + 1))
                return lo, hi, *(_matrix(batch.column(i), REFERENCES) for i in (first + 2, first + 3))

            lower, upper = score_bounds(ends(3), ends(7))
            kept = (upper >= batch.column(11).to_numpy()) & (lower <= batch.column(12).to_numpy())
            yield batch.select(["dim", "group", "block"]).filter(pa.array(kept))

    return stored(
        met.select(columns).mapInArrow(run, "dim int, group long, block struct<run:long,label:long>").distinct(), "pairs"
    )


def _scored(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, most: int, slots: int, same: bool) -> DataFrame:
    """(anchor, slot, score, number, id): the best rows of every pair of a group and a block."""
    columns = ["anchor", "dim", "group", "block", "number", "id", "label", "v", "norm", "angles", "low", "high"]
    none = F.lit(None).cast("array<long>")
    right = rows.join(pairs, ["dim", "block"]).withColumns(
        {"anchor": F.lit(False), "low": none, "high": none}
    )
    left = anchors.drop("block").join(pairs, ["dim", "group"]).withColumn("anchor", F.lit(True))
    both = left.select(columns).union(right.select(columns))
    return both.groupBy("dim", "group", "block").applyInArrow(
        _score_pair(most, slots, same), "anchor long, slot int, score long, number long, id long"
    )


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id", "number")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


_FAR = 1 << 62


def _whole_range():
    return {"low": F.array(F.lit(-_FAR)), "high": F.array(F.lit(_FAR))}


def mine(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    anchors_every: int = EVERY, moved_every: int | None = 7, labels: int = 10,
) -> DataFrame:
    """Hard negatives of each anchor and positive.

    Anchors are rows whose key ``anchors_every`` divides. Where ``moved_every`` divides the key, the label is first moved
    on by one modulo ``labels``. Gives (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    """
    spark = df.sparkSession
    rows = whole_numbers(df, key, vector, label)
    if moved_every:
        moved = F.when(F.col("id") % moved_every == 0, (F.col("label") + 1) % labels)
        rows = rows.withColumn("label", F.coalesce(moved, F.col("label")))
    rows = stored(rows, "whole")
    directions = spark.sparkContext.broadcast(references(rows))
    order = [F.col(c) for c in ("dim", "label", "near", "beta", "id")] + [F.xxhash64("v")]
    placed = numbered(describe(rows, directions), order, "angles").drop("near", "beta").withColumn(
        "block", F.struct(F.expr(f"div(number, {ROWS})").alias("run"), "label")
    )
    is_anchor = F.col("id") % anchors_every == 0
    asked = placed.filter(is_anchor)
    # 1. floors from the block an anchor stands in
    home = asked.withColumn("group", F.col("block")).withColumns(_whole_range())
    own = home.select("dim", "group", "block").distinct()
    floors = _first(_scored(home, placed, own, POSITIVES, 1, True), POSITIVES).filter(
        F.col("rank") == POSITIVES
    ).select(F.col("anchor").alias("number"), F.col("score").alias("floor"))
    grouped = numbered(
        asked.withColumnRenamed("number", "row"), [F.col("row")], "anchors"
    ).withColumn("group", F.expr(f"div(number, {ANCHORS})")).drop("number").withColumnRenamed("row", "number")
    groups = grouped.count() // ANCHORS + 1
    # 2. positives
    floored = stored(
        grouped.join(floors, "number", "left").withColumns({
            "low": F.array(F.coalesce("floor", F.lit(-_FAR))), "high": F.array(F.lit(_FAR))
        }).drop("floor"),
        "floors",
    )
    positives = stored(
        _first(_scored(floored, placed, _pairs(floored, placed, groups, True), POSITIVES, 1, True), POSITIVES)
        .select(
            F.col("anchor").alias("number"), (F.col("rank") - 1).alias("slot"), F.col("score").alias("positive_score"),
            F.col("id").alias("positive_id"),
        ),
        "positives",
    )
    # 3. negatives, in the range 50 p <= 100 n <= 95 p of each positive; absent positives want nothing
    score = lambda e: e["positive_score"]
    wanted = positives.groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("p")
    ).select(
        "number",
        *[
            F.transform(F.sequence(F.lit(0), F.lit(POSITIVES - 1)), lambda i: F.coalesce(end(F.get("p", i)), F.lit(none))).alias(name)
            for name, none, end in (
                ("low", 1, lambda e: F.ceil(score(e).cast("decimal(20,0)") / 2).cast("long")),
                ("high", 0, lambda e: F.floor(score(e).cast("decimal(20,0)") * 95 / 100).cast("long")),
            )
        ],
    )
    ranged = stored(grouped.join(wanted, "number"), "ranges")
    found = _first(
        _scored(ranged, placed, _pairs(ranged, placed, groups, False), NEGATIVES, POSITIVES, False), NEGATIVES
    ).select(
        F.col("anchor").alias("number"), "slot", "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    ids = grouped.select("number", F.col("id").alias("anchor_id"))
    return stored(found, "negatives").join(positives, ["number", "slot"]).join(ids, "number").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def oracle() -> str:
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
), positives AS (
  SELECT a, b AS p, score AS ps FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES}
)
SELECT s.a AS anchor_id, p AS positive_id, s.b AS negative_id, ps AS positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY s.a, p ORDER BY score DESC, s.b)::INTEGER AS rank
FROM positives q JOIN scores s ON s.a = q.a AND NOT s.same AND 50 * ps <= 100 * score AND 100 * score <= 95 * ps
QUALIFY rank <= {NEGATIVES}
"""
