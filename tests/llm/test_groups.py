"""Operators that compare rows with each other, beside brute force."""

import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyledger.llm import components as cc, jaccard, line_runs, packing, pivots
from skyledger.llm.catalog import QUERIES
from skyledger.llm.tables import table
from tests.conftest import SMALL


def reached(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def test_components(spark):
    random.seed(7)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    edges += [(random.randrange(200, 400), random.randrange(200, 400)) for _ in range(120)]
    random.shuffle(edges)
    df = spark.createDataFrame([*edges, (500, 500), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in cc.components(df).collect()}
    want = reached({n for e in edges for n in e}, edges)
    assert got == {n: want[n] for e in edges if e[0] != e[1] for n in e}
    assert cc.components(df.limit(0)).count() == 0


# N-gram Jaccard join


def plain_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_join(texts):
    sets = [plain_shingles(t) for t in texts]
    edges = [
        (i, j) for i, j in itertools.combinations(range(len(texts)), 2)
        if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    ]
    label = reached(range(len(texts)), edges)
    return {i: (label[i], sum(i in e for e in edges)) for i in range(len(texts))}


def near_copies(seed, groups=6, copies=14):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    texts = [None, "", " \n", "a b", "a b", "a  b", "one two three four five", "x" * 50_000, "r " * 9000, "r " * 9000]
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(copies):
            made = list(base)
            for _ in range(rng.randint(0, 4)):
                made[rng.randrange(len(made))] = word()
            texts.append(" ".join(made))
        texts += [" ".join(base)] * 2
    return texts


def test_join_equals_brute_force(docs_of):
    texts = near_copies(1)
    got = jaccard.join_groups(docs_of(texts)).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_links"]) for r in got} == plain_join(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_join_in_blocks_and_by_ties(docs_of, monkeypatch):
    """Small limits send every group through ties, blocks and matrix verification."""
    monkeypatch.setattr(jaccard, "FEW", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    texts = near_copies(2, groups=3, copies=25)
    got = jaccard.join_groups(docs_of(texts)).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_links"]) for r in got} == plain_join(texts)


def test_many_pairs_are_verified_as_matrices():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.choice(60, 50).astype(np.uint64)) for _ in range(40)]
    got = jaccard.linked(sets, sets, np.ones((40, 40), bool))
    want = [[5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b)) for b in sets] for a in sets]
    assert (got == np.array(want)).all()


def test_bayesian_looks_keep_similar_pairs():
    looks = jaccard.least_matches()
    assert [k for k, _ in looks] == list(range(16, 97, 16))
    rng = np.random.default_rng(4)
    left = rng.integers(0, 1 << 32, (4000, jaccard.HASHES), dtype=np.uint32)
    for share, least, most in ((0.85, 0.999, 1), (0.2, 0, 0.001)):
        right = np.where(rng.random(left.shape) < share, left, left + np.uint32(1))
        kept = jaccard.paired_survivors(left, right).mean()
        assert least <= kept <= most
        assert (jaccard.surviving(left[:50], right[:50]).diagonal() == jaccard.paired_survivors(left[:50], right[:50])).all()


def test_join_odd_ids_and_empty(spark, docs_of):
    same = "one two three four five six"
    rows = [(None, same), (None, same), (1, same), (1, same), (2, same), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "node": F.lit(1), "signature": F.lit(2)})
    got = sorted((str(r["doc_id"]), r["n_links"], r["kept"]) for r in jaccard.join_groups(docs).collect())
    assert got == [("1", 2, True), ("1", 2, True), ("2", 2, False), ("3", 0, True), ("None", 0, True), ("None", 0, True)]
    assert jaccard.join_groups(docs.limit(0)).count() == 0
    left = jaccard.one_of_each_group(docs_of(near_copies(5, groups=1)))
    assert left.columns == docs_of([]).columns


# Line runs


def plain_deleted(texts, least):
    """Every run of enough characters, by comparing all of them."""
    lines = {
        d: [(i, t) for i, t in enumerate((x or "").split("\n")) if t.strip(" \t\r\x0b\x0c")]
        for d, x in enumerate(texts) if x is not None
    }
    first, runs = {}, []
    for d in sorted(lines):
        own = lines[d]
        for a in range(len(own)):
            chars = 0
            for b in range(a, len(own)):
                chars += len(own[b][1])
                if chars >= least:
                    run = tuple(t for _, t in own[a : b + 1])
                    if first.setdefault(run, (d, a)) != (d, a):
                        runs += [(d, own[i][0]) for i in range(a, b + 1)]
    return set(runs)


def line_texts(seed):
    rng = random.Random(seed)
    pool = [f"{c} {'x' * rng.randint(0, 25)}" for c in "abcdefgh"] + ["", " ", "long line " * 5]
    return [None, "", "\n", " "] + ["\n".join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(60)] + ["\n".join(pool * 3)] * 2


@pytest.mark.parametrize("seed", [1, 2])
def test_line_runs_equal_brute_force(docs_of, seed):
    texts = line_texts(seed)
    got = line_runs.mark_lines(docs_of(texts), least_chars=30).collect()
    found = {(r["doc_id"], n) for r in got for n in r["__deleted"] or []}
    assert len(got) == len(texts) and found == plain_deleted(texts, 30)


def test_cleaned_documents(spark, docs_of):
    keep, again = "a line that stands once " * 3, "a passage that stands in many documents " * 2
    texts = [f"{again}\n{keep}1", f"{keep}2\n\n{again}", again, None, "", "short\nshort"]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_runs.without_later_copies(docs_of(texts)).collect()}
    assert got[0][0] == texts[0] and got[1] == (f"{keep}2\n", len(keep) + 2)
    assert 2 not in got and got[3] == (None, None) and got[4] == ("", 0) and got[5][0] == "short\nshort"
    assert line_runs.without_later_copies(docs_of([])).count() == 0


def test_equal_rows_are_one_document(spark):
    row = (1, "the very same line in the same row\nand one more line of some length")
    docs = spark.createDataFrame([row, row, (None, row[1]), (2, row[1])], "doc_id long, text string").withColumn("__number", F.lit(1))
    got = sorted((str(r["doc_id"]), r["text"]) for r in line_runs.without_later_copies(docs).collect())
    assert got == [("None", row[1])]


@pytest.mark.parametrize("parts", [1, 5])
def test_suffix_array_and_intervals_equal_brute_force(spark, docs_of, parts):
    """Order, common prefixes and intervals beside sorted lists of line ids."""
    texts, depth = line_texts(3), 7
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        active = line_runs.repeated_lines(line_runs.line_table(docs_of(texts)))
        level = line_runs.suffix_ranks(active, depth)
        array = line_runs.suffix_array(level, depth)
        starts = {r["rank"]: r["starts"] for r in line_runs.interval_starts(array, depth).collect()}
        suffixes, entries = level.collect(), sorted(array.collect(), key=lambda r: r["rank"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    line = {(r["__doc"], r["place"]): r["line"] for r in suffixes}

    def whole(doc, place):
        return tuple(itertools.takewhile(lambda x: x is not None, (line.get((doc, place + i)) for i in range(8))))

    assert {r["rank"] for r in suffixes} == set(starts) == {r["rank"] for r in entries}
    prefix = {r["rank"]: whole(r["__doc"], r["place"]) for r in suffixes}
    assert all(prefix[r["rank"]] == whole(r["__doc"], r["place"]) for r in suffixes)
    order = [prefix[r["rank"]] for r in entries]
    assert order == sorted(set(order)) and len(order) > 50
    assert len({r["part"] for r in entries}) == parts
    for last, r in zip([()] + order, entries):
        own = prefix[r["rank"]][:depth]
        assert tuple(r["ids"]) == own
        assert r["lcp"] == sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(own, last)))
        for m in range(1, len(own) + 1):
            assert starts[r["rank"]][m - 1] == min(k for k, p in prefix.items() if p[:m] == own[:m])


def test_line_runs_columns_of_any_name(spark):
    line = "one line that is long enough to be a run"
    names = ["__deleted", "__doc", "__text", "left", "row", "rank", "place", "a.b"]
    docs = spark.createDataFrame([(1, line), (2, line + "\nnew")], "doc_id long, text string")
    docs = docs.withColumns({n: F.lit(n) for n in names})
    got = line_runs.without_later_copies(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, line, *names), (2, "new", *names)]
    marked = line_runs.mark_lines(docs)
    assert sorted(marked.columns) == sorted(docs.columns)
    assert sorted((r["doc_id"], r["__deleted"]) for r in marked.collect() if r["__deleted"]) == [(2, [0])]


# Embeddings


def plain_vectors(ids, vectors, labels, least):
    edges = []
    for (i, a, x), (j, b, y) in itertools.combinations(zip(ids, vectors, labels), 2):
        if x is not None and x == y and a is not None and b is not None and len(a) == len(b):
            a, b = np.array(a, float), np.array(b, float)
            size = np.linalg.norm(a) * np.linalg.norm(b)
            if size > 0 and np.isfinite(size) and a @ b / size >= least:
                edges.append((i, j))
    label = reached(ids, edges)
    return {i: (sum(i in e for e in edges), label[i]) for i in ids}


def clouds(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    rows = [(centres[i % 20] + rng.normal(size=dim) * 0.16).tolist() for i in range(n)]
    rows[5], rows[6], rows[7] = rows[4], [0.0] * dim, [float("nan")] * dim
    rows[8], rows[9], rows[10] = [float("inf")] + [1.0] * (dim - 1), [], rows[4][:8]
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    vectors = clouds(1) + [None]
    labels = [(i // 200) if i % 50 else None for i in range(len(vectors))]
    df = spark.createDataFrame(
        list(zip(range(len(vectors)), vectors, labels)), "vec_id long, embedding array<double>, label int"
    )
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pivots.near_duplicates(df).collect()}
    ok = [v if v and np.isfinite(v).all() else None for v in vectors]
    want = plain_vectors(range(len(vectors)), ok, labels, 0.98)
    true = sum(n for n, _ in want.values())
    assert true > 100 and len(got) == len(vectors)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.9 * true


def test_vectors_odd_rows(spark):
    v = [1.0, 2.0]
    rows = [(None, v, 1), (1, v, 1), (1, v, 1), (2, v, 1), (3, v, None), (4, [2.0, 4.0], 1), (5, [None, 1.0], 1), (6, [1e200, 2e200], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"node": F.lit("x"), "dim": F.lit(1)})
    got = sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in pivots.near_duplicates(df).collect())
    assert got == [("1", 4, True), ("1", 4, True), ("2", 4, False), ("3", 0, True), ("4", 4, False), ("5", 0, True), ("6", 4, False), ("None", 0, True)]
    assert pivots.near_duplicates(df.limit(0)).count() == 0


# Packing


def least_padding(values, counts, buckets):
    best = float("inf")
    for k in range(min(buckets, len(values))):
        for inner in itertools.combinations(range(len(values) - 1), k):
            ends, total, at = [*inner, len(values) - 1], 0, 0
            for e in ends:
                total += sum((values[e] - values[i]) * counts[i] for i in range(at, e + 1))
                at = e + 1
            best = min(best, total)
    return best


def padding(values, counts, bounds):
    return sum((min(b for b in bounds if b >= v) - v) * c for v, c in zip(values, counts))


def test_bounds_are_optimal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        values = np.unique(rng.integers(0, 60, rng.integers(1, 9)))
        counts = rng.integers(1, 20, len(values))
        buckets = int(rng.integers(1, 6))
        bounds = packing.optimal_bounds(values, counts, buckets)
        assert len(bounds) <= buckets
        assert padding(values, counts, bounds) == least_padding(values, counts, buckets)
    assert packing.optimal_bounds(np.array([], int), np.array([], int), 3) == []


def test_batches_hold_their_budget(spark):
    rng = random.Random(6)
    rows = [(i, rng.randint(0, 900)) for i in range(3000)] + [(7, 5), (7, 5), (9999, 40_000), (None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, n_words long").withColumns({"bucket": F.lit("x"), "place": F.lit(1)})
    got = packing.pack(df, budget=4096, buckets=5).toPandas()
    assert len(got) == len(rows) and (got["n_words"] <= got["bucket_length"]).all()
    for (_, _), batch in got.groupby(["bucket", "batch"]):
        assert len(batch) == 1 or len(batch) * batch["bucket_length"].iloc[0] <= 4096
        assert sorted(batch["place"]) == list(range(len(batch)))
    for _, bucket in got.groupby("bucket"):
        sizes = bucket.groupby("batch").size()
        assert list(sizes.index) == list(range(len(sizes))) and (sizes[:-1] == sizes.max()).all()
    again = packing.pack(df.repartition(7), budget=4096, buckets=5).toPandas()
    key = ["doc_id", "n_words", "bucket", "batch", "place"]
    pd.testing.assert_frame_equal(got[key].sort_values(key).reset_index(drop=True), again[key].sort_values(key).reset_index(drop=True))


def test_packing_odd_texts(docs_of):
    docs = docs_of([None, "", "a", " a  b\nc d "])
    got = {r["doc_id"]: r["n_words"] for r in packing.word_lengths(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 3}
    assert packing.pack(packing.word_lengths(docs_of([]))).count() == 0
    assert packing.pack(packing.word_lengths(docs)).count() == 4


def test_histogram_is_bounded(spark):
    df = spark.range(5000).select(F.col("id").alias("n"))
    values, counts, step = packing.length_histogram(df, "n", step=1, most_bins=100)
    assert len(values) <= 100 and counts.sum() == 5000 and step == 64


def test_one_long_text_leaves_the_other_bounds_exact(spark):
    rng = random.Random(8)
    lengths = [rng.randint(0, 40) for _ in range(400)] + [10_000_000]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_words long")
    got = packing.pack(df, buckets=4).toPandas()
    values, counts = np.unique(lengths, return_counts=True)
    assert (got["bucket_length"] - got["n_words"]).sum() == least_padding(values, counts, 4)


def test_packing_counts_tokens(spark, docs_of):
    long = "漢字日本語" * 3000
    got = {r["doc_id"]: r["n_tokens"] for r in packing.token_lengths(docs_of([None, "", "a b", long])).collect()}
    assert got[0] == got[1] == 0 and got[2] == 2 and got[3] > 1000
    packed = QUERIES["op5_packing"](spark, SMALL).toPandas()
    tokens = QUERIES["op10_bpe"](spark, SMALL).toPandas()
    assert sorted(zip(packed["doc_id"], packed["n_tokens"])) == sorted(zip(tokens["doc_id"], tokens["n_tokens"]))
    for _, batch in packed.groupby(["bucket", "batch"]):
        assert len(batch) == 1 or batch["n_tokens"].sum() <= packing.BUDGET


def test_packing_query_is_whole(spark):
    got = QUERIES["op5_packing"](spark, SMALL)
    assert got.count() == table(spark, SMALL, "documents").count()


def test_ids_on_several_texts_lose_no_link(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    near = lambda k: words(k) + f" tail{k}"
    rows = [(1, words(0)), (1, words(1)), (2, near(0)), (3, near(1)), (4, words(2)), (4, words(2)), (None, words(3))]
    rows += [(None, words(3)), (None, near(1)), (9, ""), (9, "")]
    kind = "doc_id long, text string, id string, node string, text_hash string, row string"
    seen = set()
    for parts in (1, 5):
        df = spark.createDataFrame([(i, t, "x", "y", "z", "r") for i, t in rows], kind).repartition(parts)
        got = sorted(map(tuple, jaccard.join_groups(df).collect()), key=repr)
        assert got == sorted([
            (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 4, 1, True), (4, 4, 1, True),
            (9, 9, 0, True), (9, 9, 0, True), *[(None, None, 0, True)] * 3,
        ], key=repr)
        left = jaccard.one_of_each_group(df)
        assert left.columns == df.columns
        # Two groups with id 1, one repeated row of 4 and of no id, and both empty texts stay.
        stay = sorted((r["doc_id"] or 0, r["text"]) for r in left.collect())
        assert [s[0] for s in stay] == [0, 1, 1, 4, 9, 9] and stay[0][1] == words(3)
        seen.add(tuple(stay))
    assert len(seen) == 1


def test_one_id_on_two_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    near = lambda v: [x + 0.01 for x in v]
    rows = [(1, a, 0), (1, b, 0), (2, near(a), 0), (3, near(b), 0), (3, near(b), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, pivots.near_duplicates(df).collect()))
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False)]


def test_index_finds_pairs_and_thins_the_work(spark):
    """Recall at the threshold itself, and members of lists per vector at ten times the vectors."""
    rng = np.random.default_rng(6)
    looked = {}
    for n in (300, 3000):
        base = rng.normal(size=(n, 64))
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        turn = rng.normal(size=(n, 64))
        turn -= (turn * base).sum(axis=1, keepdims=True) * base
        turn /= np.linalg.norm(turn, axis=1, keepdims=True)
        cosine = rng.uniform(0.981, 0.995, size=(n, 1))
        both = np.r_[base, base * cosine + turn * np.sqrt(1 - cosine**2)]
        rows = [(i, v.tolist(), 0) for i, v in enumerate(both)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = pivots.near_duplicates(df).filter("n_links > 0").count()
        assert got >= 0.95 * 2 * n
        entries = df.select("vec_id", F.col("embedding").alias("vector"), F.lit(64).alias("dim"), "label")
        made = pivots.describe(entries, pivots.choose_pivots(entries, pivots.pivot_count(2 * n)))
        lists = made.select(F.inline(pivots._twos("order"))).groupBy("p", "q").count()
        looked[n] = lists.agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0] / (2 * n)
    assert looked[3000] < 2 * looked[300]
