"""Ranked search, mixing and hard negatives, beside brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import hard_negatives, mixing, ranked_search
from skyledger.llm.catalog import QUERIES
from skyledger.llm.tables import table
from tests.conftest import SMALL

SEPARATORS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(SEPARATORS, small)


def plain_search(docs, items, top):
    """docs: (id, text); items: {id: text}."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items.items():
        scored = []
        for doc, counts in counted:
            m = 100 - 50 + (50 * sum(counts.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
                for t in set(plain_terms(text)) if t in counts
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def searched(docs, items, **options):
    return sorted(map(tuple, ranked_search.search(docs, items, **options).collect()), key=repr)


WORDS = [f"w{i}" for i in range(60)] + ["Été", "naïve", "中文", "ﬁ", "x1"]


def some_texts(n, seed=5):
    rng = random.Random(seed)
    return [
        rng.choice([" ", ", ", "\n"]).join(
            rng.choice(WORDS[: rng.choice([5, 20, len(WORDS)])]) for _ in range(rng.randrange(0, 40))
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("bucket, floor_rows, focus", [(1024, 8192, 8), (7, 10, 1), (32, 30, 3)])
def test_search_is_brute_force(spark, docs_of, monkeypatch, bucket, floor_rows, focus):
    monkeypatch.setattr(ranked_search, "BUCKET", bucket)
    monkeypatch.setattr(ranked_search, "FLOOR_ROWS", floor_rows)
    monkeypatch.setattr(ranked_search, "FOCUS", focus)
    texts = some_texts(180) + ["w1 w2 w3 Été"] * 25 + [None, "", " ;;- ", "W1!w1", "w4 " * 30000]
    items = {1: "W1 w2, été ÉTÉ", 2: "w50 w51 w52 naïve 中文 w1 w2 w3 w4 w5 w6 w7", 3: "unknown", 9: "w4"}
    asked = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = searched(docs_of(texts), asked, top=6)
    assert got == plain_search(list(enumerate(texts)), items, 6)


def test_search_in_blocks_of_items(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 4)
    texts = some_texts(80)
    items = {i: " ".join(WORDS[i : i + 3]) for i in range(9)}
    asked = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert searched(docs_of(texts), asked, top=4) == plain_search(list(enumerate(texts)), items, 4)


def test_terms_sharing_a_hash_are_told_apart():
    import pyarrow as pa

    from skyledger.llm.batches import Texts

    known = ranked_search.Vocabulary([b"aa", b"bb", b"cc"])
    known.hashes[:] = known.hashes[0]
    known.twins = 3
    words = ranked_search._words(Texts(pa.array(["bb aa dd"])))
    words.hashes[:] = known.hashes[0]
    assert known.find(words).tolist() == [1, 0, -1]


def test_search_edges(spark, docs_of):
    items = "item_id long, text string, doc_id string, norm int, rank int"
    rows = [(None, "w1", "x", 0, 0), (None, "w2", "x", 0, 0), (4, None, "x", 0, 0), (5, "w1", "x", 0, 0), (5, "w1", "x", 0, 0)]
    asked = spark.createDataFrame(rows, items)
    docs = docs_of(["w1", "w2 w3", "w1", "w3"]).withColumns(
        {c: F.lit("x") for c in ("item_id", "score", "n", "terms", "__id")}
    )
    want = plain_search([(0, "w1"), (1, "w2 w3"), (2, "w1"), (3, "w3")], {None: "w1 w2", 5: "w1"}, 50)
    assert searched(docs, asked) == want
    twice = docs.union(docs.withColumn("doc_id", F.lit(None).cast("long")))
    plain = [(i, t) for i, t in enumerate(["w1", "w2 w3", "w1", "w3"])]
    assert searched(twice, asked) == plain_search(plain + [(None, t) for _, t in plain], {None: "w1 w2", 5: "w1"}, 50)
    empty = ranked_search.search(docs.limit(0), asked)
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0
    assert ranked_search.search(docs, asked.limit(0)).count() == 0
    assert searched(docs_of([None, "", "-"]), asked) == []


# Mixing


def plain_targets(sizes):
    """sizes in source order."""
    total, capped = sum(sizes), set()
    weight = [i % 3 + 1 for i in range(len(sizes))]
    while True:
        rest = total - sum(3 * sizes[i] for i in capped)
        shared = sum(w for i, w in enumerate(weight) if i not in capped)
        aim = [3 * s if i in capped else rest * weight[i] / shared for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if aim[i] > 3 * s}
        if not over:
            return aim
        capped |= over


def plain_seats(votes, house):
    """One seat after the other."""
    given = [0] * len(votes)
    for _ in range(house):
        given[max(range(len(votes)), key=lambda i: (votes[i] / (2 * given[i] + 1), -i))] += 1
    return given


def plain_mix(rows):
    """rows: (id, source, text); every block is laid out word by word."""
    number = lambda *p: int(hashlib.md5("|".join(p).encode()).hexdigest()[:8], 16)
    digest = lambda i: hashlib.md5("|".join(["42"] + ([str(i)] if i is not None else [])).encode()).hexdigest()
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in rows]
    names = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, s or ""))
    sizes = [sum(z for _, s, z in sized if s == n) for n in names]
    aim, out = plain_targets(sizes), []
    for at, name in enumerate(names):
        mine = [(digest(i), i if i is not None else -1, z, i) for i, s, z in sized if s == name]
        n_shards = min(mixing.MOST_SHARDS, max(1, -(-sizes[at] // mixing.SHARD)))
        shards = defaultdict(list)
        for row in sorted(mine):
            shards[int(row[0][:8], 16) % n_shards].append(row)
        keys = sorted(shards)
        blocks = [-(-sum(r[2] for r in shards[k]) // mixing.BLOCK) for k in keys]
        given = plain_seats(blocks, math.floor(aim[at] / mixing.BLOCK + 0.5)) if sum(blocks) else [0] * len(keys)
        for key, k, q in zip(keys, blocks, given):
            k = max(k, 1)
            start = number("42", str(at), str(key)) % k
            times = [((i + 1) * q + start) // k - (i * q + start) // k for i in range(k)]
            words = 0
            for _, _, z, i in shards[key]:
                taken = sum(times[w // mixing.BLOCK] for w in range(words, words + z))
                words += z
                out.append((i, z, sizes[at], float(aim[at]), taken))
    return sorted(out, key=repr)


def mixed(df):
    return sorted(map(tuple, mixing.mix(df).collect()), key=repr)


def sourced(spark, n=150, seed=3, partitions=5):
    rng = random.Random(seed)
    names = ["a", "b", "B", "é", "中", "zz", None, ""]
    rows = []
    for i in range(n):
        name = "a" if rng.random() < 0.4 else rng.choice(names)
        text = rng.choice([None, "", "one"]) if rng.random() < 0.1 else "w " * rng.randrange(1, 90)
        rows.append((i if i % 11 else None, text, name))
    rows += [rows[5]] * 3 + [(900, "w " * 5000, "zz")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)


@pytest.mark.parametrize("shard", [1 << 18, 400])
def test_mix_is_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(mixing, "SHARD", shard)
    rows, df = sourced(spark)
    want = plain_mix([(i, s, t) for i, t, s in rows])
    assert mixed(df) == want
    clash = df.withColumns({c: F.lit("x") for c in ("id", "size", "target", "number", "shard", "__part")})
    assert mixed(clash.repartition(2)) == want


def test_mix_comes_near_its_targets(spark):
    out = mixing.mix(table(spark, SMALL, "documents").select("doc_id", "text", "source"))
    assert out.filter("taken > 3 * size").count() == 0
    docs = table(spark, SMALL, "documents").select("doc_id", "source")
    for r in out.join(docs, "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")
    ).collect():
        # Half a block by rounding the seats, and a short last block taken up to three times.
        assert abs(r["taken"] - r["target"]) <= 3.5 * mixing.BLOCK


def test_mix_edges(spark):
    kind = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], kind)).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, "", None)], kind)
    assert mixed(none) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    one = spark.createDataFrame([(1, "w " * 100, None)], kind)
    assert mixed(one) == plain_mix([(1, None, "w " * 100)])


def test_seats_are_highest_quotients():
    rng = random.Random(9)
    for _ in range(200):
        votes = [rng.choice([0, 1, 1, 7, rng.randrange(1, 500)]) for _ in range(rng.randrange(1, 12))]
        house = rng.randrange(0, 3 * sum(votes) + 1)
        got = mixing.highest_quotients(votes, house)
        assert got == (plain_seats(votes, house) if sum(votes) else [0] * len(votes))
        assert all(g <= 3 * v for g, v in zip(got, votes))


def test_seats_of_sources_are_those_of_their_house(spark):
    votes = [float(v) for v in (1000, 1000, 250.5, 8, 3, 0, 77)]
    rows = spark.createDataFrame([(v,) for v in votes], "v double")
    got = [r[0] for r in rows.select(mixing.seats(F.col("v"), 16)).collect()]
    assert got == plain_seats(votes, sum(got))


def test_numbers_over_all_partitions(spark):
    rows = spark.createDataFrame([(random.Random(i).randrange(1000),) for i in range(500)], "x int").repartition(7)
    got = mixing.numbered(rows, [F.col("x")], "numbers-test").orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(500))
    assert [r["x"] for r in got] == sorted(r["x"] for r in rows.collect())


# Hard negatives


def plain_negatives(rows):
    """rows: (id, vector, label)."""
    usable = []
    for i, v, l in rows:
        if i is None or l is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, tuple(math.floor(256 * x) for x in v), (l + 1) % 10 if i % 7 == 0 else l)
        if row not in usable:
            usable.append(row)
    out = []
    for a in usable:
        if a[0] % 50:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2]) for b in usable
            if b is not a and len(b[1]) == len(a[1])
        )
        for ps, pid, _ in [s for s in scored if s[2] == a[2]][:5]:
            good = [s for s in scored if s[2] != a[2] and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(a[0], pid, r, i, -ps, -s) for r, (s, i, _) in enumerate(good[:3], 1)]
    return sorted(out)


def vectors(n, seed, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(scale=rng.choice([0.05, 0.5, 2.0]), size=width)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(0, 4))))
    same = rows[10][1]
    return rows + [(n + j, same, j % 3) for j in range(40)]


KIND = "vec_id long, embedding array<float>, label int"


def negatives(df):
    return sorted(map(tuple, hard_negatives.mine(df).collect()))


@pytest.mark.parametrize("rows, anchors, window", [(4096, 4096, 64), (40, 3, 4)])
def test_negatives_are_brute_force(spark, monkeypatch, rows, anchors, window):
    monkeypatch.setattr(hard_negatives, "ROWS", rows)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "WINDOW", window)
    monkeypatch.setattr(hard_negatives, "PENDING", 50)
    data = vectors(360, 4)
    want = plain_negatives(data)
    assert len(want) > 50
    assert negatives(spark.createDataFrame(data, KIND).repartition(3)) == want


def test_negatives_edges(spark):
    data = vectors(120, 8)
    data[0] = (0, [0.0] * 6, 1)  # an anchor without a direction
    data += [
        (200, None, 1), (201, [None] + [1.0] * 5, 2), (202, [float("nan")] + [1.0] * 5, 2), (None, [1.0] * 6, 1),
        (203, [1.0] * 6, None), (204, [], 1), (250, [], 1), (205, [], 2), (300, [1.0, 2.0], 3),
        (302, [1.0, 2.0], 3), (303, [0.9, 1.5], 2), (304, [float("inf")] * 6, 1),
    ]
    data += data[40:60]
    df = spark.createDataFrame(data, KIND)
    want = plain_negatives(data)
    assert {r[0] for r in want} >= {50, 100, 250, 300}
    clash = df.withColumns({c: F.lit("x") for c in ("id", "dim", "v", "number", "block", "angles", "norm")})
    assert negatives(clash) == want
    assert hard_negatives.mine(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(50, [1e30] * 6, 1), (51, [1e30] * 6, 1), (52, [1.0] * 6, 2)], KIND)
    assert negatives(huge) == []


def test_bounds_hold_every_score():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 8)) * rng.uniform(1, 300, size=(300, 1))
    v[::7] = v[0] * 1.5
    refs = hard_negatives._units(rng.normal(size=(5, 8)))
    angles = np.arccos(np.clip(hard_negatives._units(v) @ refs.T, -1, 1))
    norm = np.linalg.norm(v, axis=1)
    one = (norm[:, None], norm[:, None], angles[:, None, :], angles[:, None, :])
    other = (norm[None, :], norm[None, :], angles[None, :, :], angles[None, :, :])
    low, high = hard_negatives.score_bounds(one, other)
    assert (low <= v @ v.T).all() and (v @ v.T <= high).all()


@pytest.mark.parametrize("name", ["op11_search", "op12_mix", "op13_negatives"])
def test_whole_tables(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
