"""N-gram Jaccard join with Bayesian pruning of candidates.

A document is the set of its word shingles (``n`` words; a shorter text is one shingle of
all its words). Documents with equal sets form a class and are handled once. Each class
has a MinHash signature; two classes are candidates if they agree on all values of one
band. A candidate pair's values are compared a few at a time: with m of k equal, the
similarity has a Beta(m+1, k-m+1) posterior, and the pair is dropped once the probability
of reaching the threshold is below ``tolerance``. What is left is verified exactly on the
shingle sets.

Bands of a few classes are expanded into pairs. Larger ones are never: their classes are
tied to the least one only to bring them together. Ties and surviving pairs give
groups, each class's set is sent once to the task of its group, and there all pairs of the
group are pruned and verified as matrices. Groups above ``BLOCK`` classes are cut by hash
into blocks, one task per pair of blocks. A task gives one row per class: how many
documents it links to and the least class it is joined with. So no pair of a large
group is ever written, and none is lost.

With 24 bands of 4 values, a pair at exactly 0.8 is no candidate with probability
3e-6, a pair above it with less; the tolerance adds 1e-6 per look.

Edge cases: null and empty texts have no shingles and link with nothing; copies link with
each other, and repeated rows do; rows with a null id link with nothing and are kept; rows that
share an id but not a text each have the links of their own text. Where one document of a group
is to stay, rows with a null id count as documents with the largest ids, and of rows that share
the least id, or repeat, one stays. An empty table gives no rows. Only the key and the text are
read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import math
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.batches import Texts, annotate, fields, stored
from skyledger.llm.components import components, least_reached
from skyledger.llm.textgrams import Words, mix

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4
LOOK, TOLERANCE = 16, 1e-6
FEW, BLOCK, PER_TASK = 8, 512, 1500
HASHES = BANDS * ROWS

_rng = np.random.default_rng(11)
_TIMES = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_PLUS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(texts: Texts, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, sorted distinct 64-bit shingle hashes) of each text."""
    words = Words(texts)
    at, hashes = words.windows(n)
    doc = words.doc[at]
    for size in range(1, n):  # texts too short for one full shingle
        short = np.flatnonzero(words.counts == size)
        if len(short):
            where, codes = words.windows(size)
            mine = np.isin(words.doc[where], short)
            hashes = np.concatenate([hashes, codes[mine] + np.uint64(size)])
            doc = np.concatenate([doc, words.doc[where][mine]])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[new], hashes[new]
    return np.searchsorted(doc, np.arange(len(texts) + 1)), hashes


def signatures(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sets x HASHES: the least value of each hash function; zeros for an empty set."""
    full = np.flatnonzero(np.diff(offsets))
    made = np.zeros((len(offsets) - 1, HASHES), np.uint32)
    if len(full):
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        starts = offsets[full]
        for i in range(HASHES):
            made[full, i] = np.minimum.reduceat(x * _TIMES[i] + _PLUS[i], starts)
    return made


_MARKS = {"n": "int", "set1": "long", "set2": "long", "signature": "array<int>"}


def _total(offsets: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sum of the values of each set, modulo 2**64."""
    return np.diff(
        np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])[offsets]
    ).view(np.int64)


def _marks(n: int):
    def run(texts: Texts):
        offsets, hashes = shingle_sets(texts, n)
        made = signatures(offsets, hashes)
        flat = pa.ListArray.from_arrays(
            np.arange(0, made.size + 1, HASHES, dtype=np.int32), made.ravel().view(np.int32)
        )
        return [
            np.diff(offsets), _total(offsets, mix(hashes)),
            _total(offsets, mix(hashes ^ np.uint64(0xA5A5A5A5))), flat,
        ]

    return run


def _sets(n: int):
    """The shingles of each text, and what tells its class from others, as in the marks."""

    def run(texts: Texts):
        offsets, hashes = shingle_sets(texts, n)
        return [
            pa.ListArray.from_arrays(offsets.astype(np.int32), hashes.view(np.int64)),
            _total(offsets, mix(hashes)),
        ]

    return run


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple:
    """(values compared, least equal values that keep a pair) for each look.

    The posterior chance that the similarity is at least t is the chance of at most m
    successes in k+1 draws of probability t.
    """
    looks = []
    for k in range(LOOK, HASHES + 1, LOOK):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        looks.append((k, m))
    return tuple(looks)


def surviving(left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs of rows of two signature matrices may reach the threshold."""
    equal = np.zeros((len(left), len(right)), np.int16)
    alive, done = np.ones(equal.shape, bool), 0
    for k, least in least_matches(threshold):
        for i in range(done, k):
            equal += left[:, i, None] == right[None, :, i]
        alive &= equal >= least
        done = k
        if not alive.any():
            break
    return alive


def paired_survivors(left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """The same for row i of one matrix and row i of the other."""
    alive = np.arange(len(left))
    equal, done = np.zeros(len(left), np.int16), 0
    for k, least in least_matches(threshold):
        equal[alive] += (left[alive, done:k] == right[alive, done:k]).sum(axis=1, dtype=np.int16)
        alive = alive[equal[alive] >= least]
        done = k
    kept = np.zeros(len(left), bool)
    kept[alive] = True
    return kept


def linked(left: list, right: list, alive: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Exact test of the pairs that are alive: which sets have the similarity."""
    a, b = np.nonzero(alive)
    enough = lambda common, i, j: common >= threshold * (len(left[i]) + len(right[j]) - common) - 1e-9
    found = np.zeros(alive.shape, bool)
    if len(a) <= 4 * (len(left) + len(right)):
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = left[i], right[j]
            if min(len(x), len(y)) >= threshold * max(len(x), len(y)) - 1e-9:
                found[i, j] = enough(len(np.intersect1d(x, y, assume_unique=True)), i, j)
        return found
    # Many pairs: count common shingles of all of them by products of incidence matrices,
    # over the shingles that stand on both sides, a range of them at a time.
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    common = np.zeros(alive.shape, np.float32)

    def incidence(rows, part):
        made = np.zeros((len(rows), len(part)), np.float32)
        for i, x in enumerate(rows):
            at = np.searchsorted(part, x)
            at[at == len(part)] = 0
            made[i, at[part[at] == x]] = 1
        return made

    for first in range(0, len(shared), 4096):
        part = shared[first : first + 4096]
        common += incidence(left, part) @ incidence(right, part).T
    sizes = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :]
    return alive & (common >= threshold * (sizes - common) - 1e-9)


def _verify(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in rows.groupby("component", sort=False):
            ids, weight = group["node"].to_numpy(), group["copies"].to_numpy()
            sets = [np.sort(np.asarray(s).view(np.uint64)) for s in group["shingles"]]
            marks = np.stack([np.asarray(s) for s in group["signature"]])
            block = group["block"].to_numpy()
            if (block == block[0]).all():
                first = second = np.arange(len(ids))
            else:
                first, second = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
            alive = surviving(marks[first], marks[second], threshold)
            if first is second:
                alive &= np.triu(np.ones(alive.shape, bool), 1)
            found = linked([sets[i] for i in first], [sets[i] for i in second], alive, threshold)
            links = np.zeros((len(ids), len(ids)), bool)
            links[np.ix_(first, second)] = found
            links |= links.T
            out.append(pd.DataFrame({
                "node": ids, "links": links @ weight, "least": least_reached(ids, links),
            }))
        return pd.concat(out)[lambda d: d["links"] > 0]

    return run


class Found(NamedTuple):
    """Rows with the key of their class, the classes, and what was found of each class."""

    marks: DataFrame  # id, text_hash, set1, set2, n
    classes: DataFrame  # set1, set2, n, node, first (least id), copies
    links: DataFrame  # node, links
    least: DataFrame  # node, component, component_id (its least id)


def _found(source: DataFrame, n: int, threshold: float) -> Found:
    """All links between the texts of (id, text) rows. A class is known by a number of its own."""
    hashed = source.withColumn("text_hash", F.xxhash64("text"))
    marks = stored(
        annotate(hashed, "text", fields(**_MARKS), lambda: _marks(n)).drop("text"), "marks"
    )
    classes = stored(
        marks.filter((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("set1", "set2", "n").agg(
            F.min("id").alias("first"), F.count("*").alias("copies"),
            F.first("signature").alias("signature"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    groups = _groups(classes, threshold)
    found = _links(source, classes, groups, n, threshold)
    joined = stored(
        components(
            found.filter("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")),
            "joined",
        ).join(classes.select("node", "first"), "node"),
        "joined-first",
    )
    least = stored(joined.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    return Found(
        marks.drop("signature"), classes.drop("signature"),
        found.groupBy("node").agg(F.sum("links").alias("links")),
        joined.join(least, "component").select("node", "component", "component_id"),
    )


def _placed(found: Found) -> DataFrame:
    """(id, text_hash, n, copies, links, component_id, group) of every row; links of other texts only.

    ``group`` tells groups apart, also where the least id of two is the same.
    """
    nodes = stored(
        found.classes.join(found.links, "node", "left").join(found.least, "node", "left").select(
            "set1", "set2", "n", "copies", F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("component_id", "first").alias("component_id"),
            F.coalesce("component", "node").alias("group"),
        ),
        "class-results",
    )
    return found.marks.join(nodes, ["set1", "set2", "n"], "left")


def join_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: key, component (least key reachable by links), links, kept."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = _placed(_found(source, n, threshold))
    known = F.col("id").isNotNull()
    count = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    made = rows.select(
        F.col("id").alias(key),
        F.when(known, F.coalesce("component_id", "id")).alias("component_id"),
        F.when(known, count).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )
    return made.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _groups(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, component): classes that must be compared with each other share a component."""
    band = lambda i: F.xxhash64(i, F.slice("signature", i * ROWS + 1, ROWS))
    bands = classes.select(
        "node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)).alias("band")
    )
    held = bands.groupBy("band").agg(
        F.count("*").alias("held"), F.min("node").alias("low"), F.max("node").alias("high")
    ).filter("held > 1")
    held = stored(held, "bands")
    more = stored(bands.join(held.filter("held > 2"), "band"), "members")
    small, large = more.filter(F.col("held") <= FEW), more.filter(F.col("held") > FEW)
    two = held.filter("held = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    some = (
        small.select("band", F.col("node").alias("a")).join(small.select("band", F.col("node").alias("b")), "band")
        .filter("a < b").select("a", "b")
    )
    pairs = two.union(some).filter("a != b").distinct()
    a = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    b = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    alike = pairs.join(a, "a").join(b, "b").filter(
        F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9
    ).select("a", "b", "sa", "sb")

    def prune(batches):
        for batch in batches:
            left, right = (
                batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, HASHES)
                for i in (2, 3)
            )
            kept = pa.array(paired_survivors(left, right, threshold))
            yield batch.select(["a", "b"]).filter(kept)

    kept = alike.mapInArrow(prune, "a long, b long")
    ties = large.filter("node != low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    return components(kept.union(ties), "groups")


def _links(source: DataFrame, classes: DataFrame, groups: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, links, least) of every class with a link, a row per task that saw it."""
    # Stored first: the join then stands on two shuffles of its own and a large group can be split.
    sizes = stored(groups.groupBy("component").agg(F.count("*").alias("size")), "group-sizes")
    placed = stored(groups.join(sizes, "component"), "placed")
    tasks = placed.count() // PER_TASK + 1
    cut = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), cut).cast("int")
    members = placed.join(classes.select("node", "first", "set1"), "node").select(
        F.col("first").alias("id"), "node", F.col("set1").alias("wanted"), "component",
        cut.alias("blocks"), block.alias("block"),
    )
    # An id may stand on several texts: the one of the class is told by its shingles.
    ready = annotate(
        source.join(members, "id"), "text", fields(shingles="array<long>", set1="long"), lambda: _sets(n)
    ).filter("set1 = wanted").drop("text", "id", "wanted", "set1").dropDuplicates(["node"]).join(
        classes.select("node", "copies", "signature"), "node"
    )
    # One task per pair of blocks; many small groups share a task.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = ready.withColumn("other", other).withColumns({
        "low": F.least("block", "other"), "high": F.greatest("block", "other"),
        "task": F.when(F.col("blocks") > 1, F.col("component")).otherwise(
            F.pmod(F.xxhash64("component"), F.lit(tasks))
        ),
        "cut": F.col("blocks") > 1,
    }).drop("other", "blocks")
    return stored(
        spread.groupBy("cut", "task", "low", "high").applyInPandas(
            _verify(threshold), "node long, links long, least long"
        ),
        "links",
    )


def one_of_each_group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One document of each group of near copies, the one with the least id; others pass through.

    Decisions are made per id and text, so rows that share an id are told apart, and repeated rows come down to
    one. A row without an id takes part under a number made from its content, above any usual id.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.coalesce(
        F.col(key).cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64(*docs.columns), F.lit(1 << 61))
    ).alias("id"))
    rows = stored(
        _placed(_found(whole.select("id", "text"), n, threshold)).filter("n > 0")
        .groupBy("id", "text_hash", "group").agg(F.count("*").alias("times")),
        "decisions",
    )
    # Of texts that share the least id of a group, the one with the least hash stays.
    first = stored(
        rows.groupBy("group").agg(F.min(F.struct("id", "text_hash")).alias("first")), "first"
    )
    stays = F.struct("id", "text_hash") == F.col("first")
    marked = stored(
        rows.join(first, "group").select(
            F.col("id").alias("marked_id"), F.col("text_hash").alias("marked_hash"), stays.alias("stays"), "times"
        ).filter("not stays or times > 1"),
        "marked",
    )
    same = (F.col("id") == F.col("marked_id")) & (F.xxhash64("text") == F.col("marked_hash"))
    untouched = whole.join(marked, same, "left_anti")
    repeated = whole.join(marked.filter("stays"), same).dropDuplicates(["id", "marked_hash"])
    return untouched.select("row.*").union(repeated.select("row.*"))


def oracle(n: int = WORDS) -> str:
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= {n}
      THEN list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 5 * c >= 4 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
degree AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT l.doc_id, l.component_id, coalesce(d.n, 0) AS n_links, l.doc_id = l.component_id AS kept
FROM least l LEFT JOIN degree d ON d.doc_id = l.doc_id
"""
