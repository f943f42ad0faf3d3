"""Ranked lexical search by length-ordered buckets of impact vectors.

A document is a vector over the terms of the searched items: the coordinate of a term is its
impact, the term's weight times the saturated count in the document. An item is the 0/1 vector of its terms, and
the score is the inner product. Four steps:

1. *Count.* One pass over the texts keeps, per document, its length in terms and the counts of the
   item terms in it. Document frequencies and lengths are summed up from that table.
2. *Order.* Vectors are range-partitioned by length (their Euclidean norm), longest first, and
   written; runs of up to ``BUCKET`` rows of a partition are the buckets. Equal lengths are dealt
   by a hash of the row, so copies of one text do not end up in one task.
3. *Floors.* The longest vectors are scored first; an item's 50th best score there is a floor
   below which no document can be in the result.
4. *Search.* In a bucket, an item is left out if the longest vector times the item's length is
   below its floor (Cauchy-Schwarz), or if the largest coordinates in the bucket add up to
   less. For the others the partial product over the item's ``FOCUS`` largest coordinates,
   plus Cauchy-Schwarz for the rest of both vectors, bounds each row. Rows that stay are scored again
   in 64-bit integers. A task raises its own floors as it goes and gives at most ``top`` rows per item.

Bounds are floating, rounded up by one part in a billion; scores never are. Items are worked on in blocks of
at most ``BLOCK_TERMS`` terms (one longer item is a block of its own), so what is broadcast
has a bound whatever the number of items; each block is one pass over the documents.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z is
lower-cased. Words are found by hash and then compared byte by byte.

Edge cases: null and empty texts have no term, are no document in the counts, and are never
found; a document of any length is read whole; repeated rows are documents of their own; rows of items
that share an id (also null) are one item with the terms of all; equal scores are ranked by ascending
document id, a null id last; an item without a term, or whose terms stand in no document, has no rows; an
empty table of either kind gives no rows. Only the named columns are read, so others, whatever
their names, do not matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from skyledger.llm.batches import Texts, slices, stored
from skyledger.llm.textgrams import Words

TOP = 50
BUCKET, BUCKET_ENTRIES = 1024, 400_000  # rows and coordinates of a bucket
FOCUS = 8
FLOOR_ROWS = 8192  # about so many of the longest vectors set the floors
BLOCK_TERMS = 200_000
SAFE = 1 + 1e-9

_code = np.arange(256)
_KEPT = (
    (_code >= 0x80) | ((_code >= 0x30) & (_code <= 0x39))
    | ((_code >= 0x41) & (_code <= 0x5A)) | ((_code >= 0x61) & (_code <= 0x7A))
)
_LOWER = np.where((_code >= 0x41) & (_code <= 0x5A), _code + 32, _code).astype(np.uint8)
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_HITS = "doc long, n long, terms array<int>, counts array<long>"


def item_terms(text: str | None) -> set[bytes]:
    """The distinct terms of one item."""
    return set(_TERM.findall((text or "").encode().translate(bytes(_LOWER))))


def _words(texts: Texts) -> Words:
    texts.buf = _LOWER[texts.buf]
    return Words(texts, ~_KEPT)


class Vocabulary:
    """Numbers of known terms in texts: found by hash, then compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        words = _words(Texts(pa.array([t.decode() for t in terms], pa.large_string())))
        order = np.argsort(words.hashes, kind="stable")
        self.buf, self.hashes, self.number = words.texts.buf, words.hashes[order], order
        self.starts = words.starts[order]
        self.sizes = (words.ends - words.starts)[order]
        # Terms that share a hash stand side by side; nearly always 1.
        self.twins = int(np.unique(self.hashes, return_counts=True)[1].max(initial=0))

    def find(self, words: Words) -> np.ndarray:
        """Term number of each word, -1 for unknown words."""
        made = np.full(len(words.hashes), -1, np.int64)
        at = np.searchsorted(self.hashes, words.hashes)
        for step in range(self.twins):
            place = np.minimum(at + step, len(self.hashes) - 1)
            sizes = words.ends - words.starts
            maybe = np.flatnonzero(
                (self.hashes[place] == words.hashes) & (self.sizes[place] == sizes) & (made < 0)
            )
            if not len(maybe):
                continue
            sizes, place = sizes[maybe], place[maybe]
            first = np.cumsum(sizes) - sizes
            step_in = np.arange(sizes.sum()) - np.repeat(first, sizes)
            same = (
                words.texts.buf[np.repeat(words.starts[maybe], sizes) + step_in]
                == self.buf[np.repeat(self.starts[place], sizes) + step_in]
            )
            equal = np.logical_and.reduceat(same, first)
            made[maybe[equal]] = self.number[place[equal]]
        return made


class Block:
    """Some items: their ids, their terms as pairs sorted by term, and the terms."""

    def __init__(self, items: list[tuple[object, set[bytes]]]):
        self.ids = [i for i, _ in items]
        self.terms = sorted(set().union(*(t for _, t in items)))
        number = {t: i for i, t in enumerate(self.terms)}
        pairs = sorted((number[t], i) for i, (_, terms) in enumerate(items) for t in terms)
        self.pair_term = np.array([t for t, _ in pairs], np.int64)
        self.pair_item = np.array([i for _, i in pairs], np.int64)
        self.sizes = np.bincount(self.pair_item, minlength=len(items))


def blocks_of(items: Iterator[tuple[object, set[bytes]]], most: int = BLOCK_TERMS) -> Iterator[Block]:
    """Consecutive items, up to ``most`` terms together; an item with more is alone."""
    held, size = [], 0
    for key, terms in items:
        if held and size + len(terms) > most:
            yield Block(held)
            held, size = [], 0
        held.append((key, terms))
        size += len(terms)
    if held:
        yield Block(held)


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def count_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """Per row: terms in all, and the count of each known term (a broadcast vocabulary)."""

    def run(batches):
        known = vocabulary.value
        for batch in batches:
            for first, count in slices(batch.column(1)):
                words = _words(Texts(batch.column(1).slice(first, count)))
                term = known.find(words)
                hit = np.flatnonzero(term >= 0)
                cell, counts = np.unique(
                    words.doc[hit] * len(known.hashes) + term[hit], return_counts=True
                )
                doc, term = np.divmod(cell, max(len(known.hashes), 1))
                offsets = np.searchsorted(doc, np.arange(count + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, count), pa.array(words.counts, pa.int64()),
                        _lists(offsets, term, pa.int32()), _lists(offsets, counts, pa.int64()),
                    ],
                    names=["doc", "n", "terms", "counts"],
                )

    return docs.mapInArrow(run, _HITS)


class Weights:
    """Term weights and the length norm of documents, from counts over all of them."""

    def __init__(self, docs: int, total: int, df: dict[int, int], terms: int):
        self.docs, self.total = docs, total
        # A term in no document never meets one, so its weight does not matter.
        self.weight = np.array(
            [math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(terms)],
            np.int64,
        )

    def impacts(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        """Impact of each coordinate of rows with ``sizes`` coordinates and n terms."""
        m = 50 + (50 * n * self.docs) // self.total
        return self.weight[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * np.repeat(m, sizes)))


def _coordinates(batch: pa.RecordBatch, terms: str = "terms", counts: str = "counts"):
    column = batch.column(batch.schema.get_field_index(terms))
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64)
    column = batch.column(batch.schema.get_field_index(counts))
    start = column.offsets.to_numpy()
    return offsets - offsets[0], flat, column.values.to_numpy()[start[0] : start[-1]]


def _norms(offsets: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """Euclidean length of each row of coordinates."""
    total = np.zeros(len(offsets) - 1)
    np.add.at(total, np.repeat(np.arange(len(total)), np.diff(offsets)), impacts.astype(float) ** 2)
    return np.sqrt(total)


def order_by_length(hits: DataFrame, weights) -> DataFrame:
    """The vectors with a length above 0, longest first over all partitions."""

    def run(batches):
        for batch in batches:
            offsets, terms, counts = _coordinates(batch)
            impact = weights.value.impacts(
                batch.column(1).to_numpy(), np.diff(offsets), terms, counts
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(_norms(offsets, impact))],
                names=[*batch.schema.names, "norm"],
            )

    measured = hits.filter(F.size("terms") > 0).mapInArrow(run, f"{_HITS}, norm double")
    order = [F.col("norm").desc(), F.xxhash64("doc", "n", "terms", "counts")]
    return measured.filter("norm > 0").repartitionByRange(*order).sortWithinPartitions(*order)


class Best:
    """The best rows a task has seen of each item, and the floors below which none counts."""

    def __init__(self, floors: np.ndarray, top: int):
        self.floors, self.top = floors.copy(), top
        self.score = [np.zeros(0, np.int64)] * len(floors)
        self.doc = [np.zeros(0, np.int64)] * len(floors)
        self.lost = [np.zeros(0, bool)] * len(floors)  # rows without an id

    def add(self, item: int, score: np.ndarray, doc: np.ndarray, lost: np.ndarray) -> None:
        score = np.concatenate([self.score[item], score])
        doc = np.concatenate([self.doc[item], doc])
        lost = np.concatenate([self.lost[item], lost])
        order = np.lexsort((doc, lost, -score))[: self.top]
        self.score[item], self.doc[item], self.lost[item] = score[order], doc[order], lost[order]
        if len(order) == self.top:
            self.floors[item] = max(self.floors[item], score[order[-1]])


def _expand(ptr: np.ndarray, terms: np.ndarray):
    """For entries of the given terms: (entry, place in the pairs) of every pair of the term."""
    reps = ptr[terms + 1] - ptr[terms]
    entry = np.repeat(np.arange(len(terms)), reps)
    first = np.cumsum(reps) - reps
    return entry, np.arange(len(entry)) - np.repeat(first - ptr[terms], reps)


def search_bucket(block: Block, best: Best, doc, lost, offsets, terms, impact, norms) -> int:
    """Score the rows of one bucket that may reach an item's floor; the number scored."""
    sizes = np.sqrt(block.sizes)
    scored = 0
    active = np.flatnonzero(sizes * norms.max() * SAFE >= best.floors)
    if not len(active):
        return 0
    peak = np.zeros(len(block.terms), np.int64)
    np.maximum.at(peak, terms, impact)
    whole = np.zeros(len(sizes), np.int64)
    np.add.at(whole, block.pair_item, peak[block.pair_term])
    active = active[whole[active] >= best.floors[active]]
    row = np.repeat(np.arange(len(norms)), np.diff(offsets))
    for first in range(0, len(active), 256):
        some = active[first : first + 256]
        local = np.full(len(sizes), -1)
        local[some] = np.arange(len(some))
        mine = np.flatnonzero((local[block.pair_item] >= 0) & (peak[block.pair_term] > 0))
        term, item = block.pair_term[mine], local[block.pair_item[mine]]
        # The largest coordinates of each item in this bucket are its focus.
        by = np.lexsort((-peak[term], item))
        place = np.arange(len(by)) - np.searchsorted(item[by], item[by])
        focused = np.zeros(len(mine), bool)
        focused[by[place < FOCUS]] = True
        outside = np.bincount(item[~focused], peak[term[~focused]].astype(float), len(some))
        inside = np.bincount(item[focused], minlength=len(some))

        def product(chosen, rows_kept=None):
            t, i = term[chosen], item[chosen]
            ptr = np.searchsorted(t, np.arange(len(block.terms) + 1))
            use = np.arange(len(terms)) if rows_kept is None else np.flatnonzero(rows_kept[row])
            entry, at = _expand(ptr, terms[use])
            return use[entry], row[use[entry]] * len(some) + i[at]

        shape = (len(norms), len(some))
        entry, cell = product(focused)
        value = impact[entry].astype(float)
        part = np.bincount(cell, value, shape[0] * shape[1]).reshape(shape)
        square = np.bincount(cell, value * value, shape[0] * shape[1]).reshape(shape)
        left = np.maximum(norms[:, None] ** 2 * SAFE - square, 0)
        rest = np.sqrt(left * np.maximum(block.sizes[some] - inside, 0)[None, :])
        alive = (part + np.minimum(rest, outside[None, :])) * SAFE >= best.floors[some][None, :]
        if not alive.any():
            continue
        entry, cell = product(np.ones(len(mine), bool), alive.any(axis=1))
        keep = alive.ravel()[cell]
        score = np.zeros(shape[0] * shape[1], np.int64)
        np.add.at(score, cell[keep], impact[entry[keep]])
        scored += int(alive.sum())
        score = score.reshape(shape)
        good = alive & (score >= best.floors[some][None, :])
        for i in np.flatnonzero(good.any(axis=0)):
            at = np.flatnonzero(good[:, i])
            best.add(some[i], score[at, i], doc[at], lost[at])
    return scored


def _buckets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, up to the limits of a bucket."""
    ends = np.cumsum(np.diff(batch.column(2).offsets.to_numpy()))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = int(np.searchsorted(ends, before + BUCKET_ENTRIES, side="right"))
        last = min(max(last, first + 1), first + BUCKET)
        yield batch.slice(first, last - first)
        first = last


def _search(ordered: DataFrame, block, weights, floors: np.ndarray, top: int) -> DataFrame:
    """(item, doc, score): the best rows of each task that reach the floors."""

    def run(batches):
        items, known = block.value, weights.value
        best = Best(floors, top)
        for batch in batches:
            for part in _buckets(batch):
                offsets, terms, counts = _coordinates(part)
                impact = known.impacts(part.column(1).to_numpy(), np.diff(offsets), terms, counts)
                doc = part.column(0)
                search_bucket(
                    items, best, doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False),
                    offsets, terms, impact, _norms(offsets, impact),
                )
        for i in range(len(items.ids)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(best.doc[i]), i, np.int32)),
                    pa.array(best.doc[i], mask=best.lost[i]), pa.array(best.score[i]),
                ],
                names=["item", "doc", "score"],
            )

    return ordered.mapInArrow(run, "item int, doc long, score long")


def _first(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _block_results(hits: DataFrame, block: Block, shared, top: int) -> DataFrame | None:
    """(item, doc, score, rank) for one block of items."""
    spark = hits.sparkSession
    n, total = hits.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n:
        return None
    df = hits.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    made = Weights(n, total, {r["t"]: r["count"] for r in df}, len(block.terms))
    weights = spark.sparkContext.broadcast(made)
    ordered = stored(order_by_length(hits, weights), "lengths")
    rows, = ordered.agg(F.count("*")).first()
    share = max(0.0, 1 - FLOOR_ROWS / max(rows, 1))
    cut = ordered.agg(F.percentile_approx("norm", share, 10_000)).first()[0]
    none = np.ones(len(block.ids), np.int64)  # only scores above 0 count
    if cut is None:
        return None
    longest = _search(ordered.filter(F.col("norm") >= cut), shared, weights, none, top)
    floors = none.copy()
    for r in _first(longest, top).filter(F.col("rank") == top).collect():
        floors[r["item"]] = max(r["score"], 1)
    return stored(_first(_search(ordered, shared, weights, floors, top), top), "ranked")


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """The ``top`` best documents of each item: (item, rank, key, score)."""
    spark = docs.sparkSession
    kind = items.schema[item].dataType
    source = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    grouped = items.groupBy(F.col(item).alias("item")).agg(F.collect_set(item_text).alias("texts"))
    asked = (
        (r["item"], terms) for r in grouped.orderBy("item").toLocalIterator()
        if (terms := set().union(*map(item_terms, r["texts"])))
    )
    out = []
    for block in blocks_of(asked):
        vocabulary = spark.sparkContext.broadcast(Vocabulary(block.terms))
        hits = stored(count_terms(source, vocabulary), "hits")
        found = _block_results(hits, block, spark.sparkContext.broadcast(block), top)
        if found is not None:
            ids = spark.createDataFrame(
                list(enumerate(block.ids)),
                T.StructType([T.StructField("item", T.IntegerType()), T.StructField("__id", kind)]),
            )
            out.append(
                found.join(F.broadcast(ids), "item").select(
                    F.col("__id").alias(item), "rank", F.col("doc").alias(key), "score"
                )
            )
    if not out:
        return spark.createDataFrame([], T.StructType([
            T.StructField(item, kind), T.StructField("rank", T.IntegerType()),
            T.StructField(key, T.LongType()), T.StructField("score", T.LongType()),
        ]))
    return reduce(DataFrame.unionAll, out)


def oracle(top: int = TOP) -> str:
    terms = (
        "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH asked AS (SELECT DISTINCT item_id, unnest({terms}) AS t FROM benchmark),
numbered AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS w FROM documents),
lengths AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM numbered WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths),
counts AS (
  SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM numbered)
  WHERE t IN (SELECT t FROM asked) GROUP BY r, t
), weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM counts, totals GROUP BY t, docs
), impacts AS (
  SELECT c.r, c.t, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))) AS impact
  FROM counts c JOIN weights USING (t) JOIN lengths USING (r), totals
), scores AS (
  SELECT item_id, r, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (t) GROUP BY item_id, r
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scores JOIN lengths USING (r) WHERE score > 0
) WHERE rank <= {top}
"""
