"""The pipeline's stages on a small corpus with planted cases."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm.catalog import ORACLES, QUERIES
from skyledger.llm.tables import table
from tests.conftest import SMALL


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("aeinorst", k=rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    clean = [prose(120) for _ in range(40)]
    passage = prose(60)
    texts = clean + [f"{prose(40)}\n{passage}" for _ in range(4)]
    near = clean[0].split()
    near[3] = "changed"
    texts += [" ".join(near), clean[1], "Привет как дела " * 20, None, 'say token = "9b0b3c6a43eb78aa99cbd7049c572391" ' + prose(50)]
    return texts, clean, passage


def test_stages(spark, docs_of, tmp_path):
    texts, clean, passage = corpus()
    # The foreign text has no language, or it would be learned as one.
    docs = docs_of(texts).withColumn("lang", F.when(F.col("doc_id") != 46, F.col("lang")))
    columns, kept = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert all(rows[d]["text"] == t for d, t in enumerate(clean))
        kept.append(rows)
    language, lines, near, secret, packed = kept
    assert 46 not in language and 47 not in language and set(range(46)) <= set(language)
    assert sum(passage in r["text"] for r in lines.values()) == 1 and 45 not in lines
    assert 44 in lines and 44 not in near
    assert set(near) == set(secret) == set(packed)
    assert "9b0b3c" not in secret[48]["text"] and "[SECRET]" in secret[48]["text"]


def test_run_is_whole(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert 0 < got.count() <= table(spark, SMALL, "documents").count()
    assert {"doc_id", "bucket", "batch", "place"} <= set(got.columns)


def test_stages_over_an_empty_table(spark, docs_of, tmp_path):
    docs = docs_of(["a"]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
