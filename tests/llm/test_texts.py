"""Operators that score or encode one text at a time, beside plain Python."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from skyledger.llm import bpe_tree, langid, quality_embed, quality_rules, secrets
from skyledger.llm.batches import Texts, held_out, slices
from skyledger.llm.catalog import QUERIES
from skyledger.llm.features import sparse_rows
from skyledger.llm.tables import table
from tests.conftest import SMALL

ODD = [None, "", " ", "\n\n", "a", "Ünï çödé 😀 text", "x" * 70_000, "a b " * 20_000, "\x00\x01"]


def test_slices_cover_every_row():
    values = pa.array(["a" * n for n in (0, 5, 2000, 1, 1, 900, 900)] + [None])
    found = list(slices(values, most_bytes=1000, most_rows=3))
    assert [i for first, n in found for i in range(first, first + n)] == list(range(8))
    assert all(n <= 3 for _, n in found)


# Byte-level BPE


@pytest.fixture(scope="module")
def tokens():
    return bpe_tree.encoding(public_tokenizers.path(bpe_tree.VOCABULARY))


def test_tree_equals_whole_encoding(tokens):
    random.seed(3)
    parts = ["a", "the", " ", "  ", "\n", "'", "'s", "'re", "9", "é", "漢字", "!", "\t", "　", "😀", "\r\n", "'ll"]
    for _ in range(3000):
        text = "".join(random.choices(parts, k=random.randint(0, 60)))
        assert bpe_tree.encode(text, tokens, leaf=random.choice([1, 2, 5, 8])) == tokens.encode_ordinary(text)


@pytest.mark.parametrize("text", [
    "ab" * 9000, "漢字日本語" * 3000, " " * 9000 + "x", "!" * 5000 + "7" * 5000, "<|endoftext|>" * 500,
    "".join(random.Random(4).choices(["tion", "the", "ing", "er"], k=6000)),
    "=" * 9001 + "word", "a" + "\n" * 7001 + " b", "-" * 7000 + "'s", "=-" * 6000, " \n" * 6000 + "x", "　" * 5000 + "x",
    "😀" * 5000, "".join(random.Random(6).choices("+-*/%", k=20_000)), "x" * 5001 + "0" * 5003 + " " * 5001,
])
def test_long_runs(tokens, text):
    ids = bpe_tree.encode(text, tokens, leaf=256)
    assert ids == tokens.encode_ordinary(text)
    assert bpe_tree.decode(ids, tokens, leaf=100) == text.encode()


@pytest.mark.parametrize("char", [" ", "=", "\n", "a", "7"])
def test_runs_of_one_character_take_linear_time(tokens, char):
    text = char * 300_000
    begun = time.monotonic()
    want = tokens.encode_ordinary(text)
    whole = time.monotonic() - begun
    begun = time.monotonic()
    assert bpe_tree.encode(text, tokens) == want
    assert time.monotonic() - begun < 10 * whole + 0.5


def test_runs_joined_anywhere(tokens):
    rng = random.Random(9)
    for _ in range(150):
        char = rng.choice([" ", "=", "\n", "a", "é", "-", "　"])
        text = rng.choice(["", "x", " ", "'", "!", "9"]) + char * rng.randint(2200, 3000) + rng.choice(["", "x", " ", "'s", "-", "7", "\n"])
        seam = rng.randint(1, len(text) - 1)
        left, right = tokens.encode_ordinary(text[:seam]), tokens.encode_ordinary(text[seam:])
        assert bpe_tree.join(text, 0, seam, len(text), left, right, tokens) == tokens.encode_ordinary(text)


def test_join_is_associative(tokens):
    text = "don't stop 123abc  \n it's" * 9
    whole = tokens.encode_ordinary(text)
    for i in range(1, len(text) - 1, 7):
        left, right = tokens.encode_ordinary(text[:i]), tokens.encode_ordinary(text[i:])
        assert bpe_tree.join(text, 0, i, len(text), left, right, tokens) == whole


def test_ids_and_bytes_round_trip(docs_of):
    encoded = bpe_tree.encode_column(docs_of(ODD).select("doc_id", "text"))
    rows = bpe_tree.decode_column(encoded).collect()
    assert all(bytes(r["decoded"]) == (ODD[r["doc_id"]] or "").encode() for r in rows)


def test_bpe_query_is_the_librarys_encoding(spark):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SMALL, "documents").collect()}
    for r in QUERIES["op10_bpe"](spark, SMALL).collect():
        ids = plain.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# Quality


def test_quality_on_held_out_rows(spark):
    scored = QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = table(spark, "/root/testdata/sf0.01", "labels").toPandas()
    both = scored[scored["held_out"]].merge(labels, on="doc_id")
    assert len(scored) == 1000 and scored["score"].between(0, 1).all()
    assert (both["predicted"] == both["quality"]).mean() > 0.95
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(scored["doc_id"], scored["held_out"]))


def test_embedding_model_learns_and_handles_odd_texts(docs_of):
    rows = sparse_rows(Texts(pa.array(["good words here"] * 30 + ["### $$$ %%%"] * 30)))
    model = quality_embed.train_rows(rows, [1] * 30 + [0] * 30, epochs=20)
    p = model.probabilities(Texts(pa.array(["good words here", "### $$$ %%%", None])))[:, 1]
    assert p[0] > 0.8 and p[1] < 0.2
    got = quality_embed.score(docs_of(ODD), model, positive=1).toPandas()
    assert len(got) == len(ODD) and got["score"].between(0, 1).all()


def test_quality_without_training_rows(spark, docs_of):
    empty = spark.createDataFrame([], "text string, label int")
    assert quality_embed.fit(empty).classes == ()
    got = quality_embed.score(docs_of(ODD), quality_embed.fit(empty), positive=1).toPandas()
    assert (got["score"] == 0.5).all()
    assert quality_embed.score(docs_of([]), quality_embed.fit(empty), positive=1).count() == 0
    judged = quality_rules.judge(docs_of(ODD), quality_rules.fit(empty)).toPandas()
    assert (judged["kept"] == ~judged["base_failed"]).all()


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = collections.defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(covered))


def test_rule_counts_equal_plain_python(spark):
    random.seed(1)
    texts = [*ODD, *["".join(random.choices(["a ", "b ", "c\n", "#", "é ", "a b c d e f g h ", "\t"], k=60)) for _ in range(300)]]
    texts += [r["text"] for r in table(spark, SMALL, "documents").collect()]
    for i in range(0, len(texts), 50):
        made = quality_rules.counts(Texts(pa.array(texts[i : i + 50])))
        for j, text in enumerate(texts[i : i + 50]):
            assert tuple(int(c[j]) for c in made) == plain_counts(text)


def test_rule_query(spark):
    got = QUERIES["op4_quality_rules"](spark, SMALL).toPandas()
    failed = (got["n_words"] < 20) | (100 * got["n_repeat_words"] > 30 * got["n_words"])
    assert (got["base_failed"] == failed).all() and not got[got["base_failed"]]["kept"].any()
    labels = table(spark, SMALL, "labels").toPandas()
    both = got[~got["base_failed"]].merge(labels, on="doc_id")
    assert (both["kept"] == (both["quality"] == 1)).mean() > 0.9


def test_calibration_is_monotone_and_smooth():
    rng = np.random.default_rng(0)
    raw = rng.normal(size=2000)
    labels = (rng.random(2000) < 1 / (1 + np.exp(-(2 * raw + 1)))).astype(float)
    slope, shift = quality_rules.calibrate(raw, labels)
    assert abs(slope - 2) < 0.4 and abs(shift - 1) < 0.3


# Language


def test_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op3_language"](spark, folder).toPandas()
    true = table(spark, folder, "documents").select("doc_id", "lang").toPandas()
    both = got[got["held_out"]].merge(true, on="doc_id")
    assert (both["lang_pred"] == both["lang"]).mean() > 0.95
    assert got["score"].between(0, 1).all() and not got["rejected"].any()


def test_language_rejects_what_it_does_not_know(spark, docs_of):
    model = langid.fit(table(spark, SMALL, "documents"))
    foreign = "Привет, как дела? Сегодня хорошая погода, и мы идём гулять в большой парк у реки."
    got = langid.identify(docs_of([*ODD, foreign, "1234 !!", "The is."]), model).toPandas().set_index("doc_id")
    assert got["lang_pred"][[0, 1, 2, 3]].eq("und").all() and got["rejected"][[0, 1, 2, 3]].all()
    assert got["rejected"][len(ODD)] and got["lang_pred"][len(ODD) + 1] == "und"
    assert not got["rejected"][len(ODD) + 2]


@pytest.mark.parametrize("left", ["de", "en", "es", "fr"])
def test_language_left_out_of_training_is_rejected(spark, left):
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("length(text) > 200").toPandas()
    known = docs[docs["lang"] != left]
    model = langid.train(known["text"][::2].tolist(), known["lang"][::2].tolist())
    rejected = lambda texts: model.predict(Texts(pa.array(texts, pa.large_string())))[2].mean()
    assert rejected(docs["text"][docs["lang"] == left].tolist()) > 0.95
    assert rejected(known["text"][1::2].tolist()) < 0.01
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    assert rejected([letters(n) for n in (500, 5000, 50_000)]) == 1
    assert rejected([" ".join(letters(rng.randint(2, 9)) for _ in range(n)) for n in (80, 800, 8000)]) == 1


def test_every_language_is_learned(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([f"text number {i} of its own" for i in range(300)])
    docs = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id")))
    assert len(langid.fit(docs).languages) == 300
    assert langid.fit(docs, languages=2).languages == ("l0", "l1")


def test_language_without_training_rows(docs_of):
    docs = docs_of(["words", None], lang=None)
    assert langid.fit(docs) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


def test_clashing_columns_are_replaced(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of(["some text"]).withColumns({"score": F.lit("x"), "ids": F.lit(1), "spans": F.lit(2), "n_words": F.lit("y")})
    assert langid.identify(docs, None).schema["score"].dataType.simpleString() == "double"
    assert secrets.scan(docs).first()["spans"] == ""
    assert bpe_tree.encode_column(docs).first()["ids"]


# Secrets

PLAIN = {
    "assign": r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+",
}


def plain_spans(text):
    found = [("assign", m.start(), m.end()) for m in re.finditer(PLAIN["assign"], text, re.I | re.A) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer(PLAIN["access"], text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer(PLAIN["hex"], text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_base_secrets_equal_plain_patterns(docs_of):
    random.seed(2)
    parts = ["token", "Password", "API_KEY", "=", ": ", '"', "'", "abc123xyz", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0f", " ", "\n", "é", "secret", "ſecret", "K"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(1500)] + ODD
    for r in secrets.scan(docs_of(texts)).collect():
        want = [f"{k}:{a}:{b}" for k, a, b in plain_spans(texts[r["doc_id"]] or "")]
        assert r["base_spans"] == ",".join(want)
        assert set(want) <= set(r["spans"].split(",")) or not want


@pytest.mark.parametrize("text,found", [
    ("key Zk8vQ2pL9xT4mW7rB1nC6yD3", True),
    ("use xK3/9fQzL+7wVbNq2RtY8uJd now", True),
    ("d41d8cd98f00b204e9800998ecf8427e is the md5", False),
    ("id 123e4567-e89b-12d3-a456-426614174000", False),
    ("getUserNameFromDatabaseConnection", False),
    ("2024-01-02-2024-01-03-2024", False),
    ("internationalization_of_everything", False),
    ("see /a-long-path/with-words/2024/index", False),
    ("key ab12cd34ef56gh78ij90", True),
    ("a" * 5000 + "Z", False),
    ("aB" * 3000 + "-" * 3000 + "7" * 9, False),
])
def test_random_strings(docs_of, text, found):
    assert ("random:" in secrets.scan(docs_of([text])).first()["spans"]) == found


def test_overlap_with_base_spans_equals_all_pairs():
    """The merged lists against a look at every base span."""
    class Costly:  # every run counts as inefficient
        def encode_ordinary(self, text):
            return text

    rng = random.Random(4)
    parts = ["token=", "AKIA" + "Q7" * 10, "deadbeef" * 4, "Zk3" * 8, "plain words", " ", "/", "secret: Zk3x9Q", "\n"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        base = sorted(secrets.base_spans(text), key=lambda s: (s[1], s[0], s[2]))
        got = secrets.random_spans(text, base, [Costly()] * 2, 2.4)
        every = secrets.random_spans(text, [], [Costly()] * 2, 2.4)
        assert got == [r for r in every if not any(r[1] < e and s < r[2] for _, s, e in base)]


def test_random_letters_of_one_case(docs_of):
    rng = random.Random(12)
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = ["".join(rng.choices(letters, k=n)) for letters in (lower, upper) for n in (20, 24, 32) for _ in range(200)]
    keys += ["-".join("".join(rng.choices(lower, k=8)) for _ in range(4)) for _ in range(200)]
    found = ["random:" in r["spans"] for r in secrets.scan(docs_of([f"key {k} end" for k in keys])).collect()]
    assert sum(found) >= 0.98 * len(keys)
    words = [
        "getUserNameFromDatabaseConnection", "internationalization_of_everything", "MAXIMUM_CONNECTION_TIMEOUT",
        "Geschwindigkeitsbegrenzung", "KRAFTFAHRZEUGVERSICHERUNG", "RESPONSABILIDADES_PROFESIONALES",
        "anticonstitutionnellement", "some-long-slug-of-words-like-this", "org/apache/spark/2024/01/02/catalyst",
        "1234567890123456", "----------------------",
    ]
    assert all(not r["spans"] for r in secrets.scan(docs_of(words)).collect())


def test_redaction(docs_of):
    got = secrets.redact(docs_of(['a token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" é', "clean", None, ""])).collect()
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got}
    assert texts == {0: ('a [SECRET]" é', 13), 1: ("clean", 5), 2: (None, None), 3: ("", 0)}


def test_held_out_of_a_null_key(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(None,), (5,)], "k long").select(held_out(F.col("k")).alias("h")).collect()
    assert [r["h"] for r in got] == [zlib.crc32(b"") % 4 == 2, zlib.crc32(b"5") % 4 == 2]


def test_bounded_samples_do_not_depend_on_partitions(spark):
    from pyspark.sql import functions as F

    from skyledger.llm.batches import sample_rows

    # One value holds two thirds of the rows.
    df = spark.range(9000).select("id", F.when(F.col("id") < 6000, "a").otherwise(F.concat(F.lit("b"), F.col("id") % 3)).alias("k"))
    for by, want in ((None, {None: 50}), ("k", {"a": 50, "b0": 50, "b1": 50, "b2": 50})):
        found = [sorted(tuple(r) for r in sample_rows(rows, 50, by).collect()) for rows in (df.coalesce(1), df.repartition(9))]
        assert found[0] == found[1] and df.columns == ["id", "k"]
        if by:
            assert {k: sum(r[1] == k for r in found[0]) for k in want} == want
        else:
            assert len(found[0]) == 50
