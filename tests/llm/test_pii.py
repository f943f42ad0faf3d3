"""Personal data: strict spans beside the plain patterns, and what the labelers add."""

import math
import random
import re
import time

from pyspark.sql import functions as F

from skyledger.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [
        f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])
    ]


PARTS = [
    "a@b.c", "@", "+", "1", "12", "255", "256", ".", "-", " ", "(", ")", "x", "_", "%", "4111 1111 1111 1111",
    "+1 (938) 555-1226", "mail7.example.com", "é", "😀", "0", "\n", "call 030 555-1226 now", "name [at] mail [dot] com",
]


def texts():
    random.seed(5)
    made = ["".join(random.choices(PARTS, k=random.randint(0, 14))) for _ in range(1500)]
    return made + [None, "", "a" * 60_000, "1 " * 20_000, "1." * 20_000, "a.b@c.d_e@f.gh", "a@" + "b." * 20_000]


def test_strict_spans_equal_plain_patterns(docs_of):
    given = texts()
    for r in pii.find(docs_of(given)).collect():
        want = plain_spans(given[r["doc_id"]])
        assert r["base_spans"] == ",".join(want)
        assert set(want) <= set(r["spans"].split(",")) or not want
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]


def test_added_spans(docs_of):
    rng = random.Random(8)
    given = [f"write to u{i}@mail.example.com or call +1 (938) 555-{1000 + i} today" for i in range(60)]
    given += [f"call (938) 555-{1000 + i} now" for i in range(20)]
    given += [f"mail u{i} [at] mail [dot] com please" for i in range(20)]
    given += ["order 555 1234 5678x", "plain words only", "version 1.2.3.400"]
    rng.shuffle(given)
    for r in pii.find(docs_of(given)).collect():
        text, extra = given[r["doc_id"]], set(r["spans"].split(",")) - set(r["base_spans"].split(","))
        if "call (" in text:
            assert any(e.startswith("phone") for e in extra), text
        if "[at]" in text:
            assert any(e.startswith("email") for e in extra), text
        if text.startswith(("order", "plain", "version")):
            assert not extra, text


def digits_of(rng, n, passing):
    while True:
        number = rng.choice("45") + "".join(rng.choices("0123456789", k=n - 1))
        if luhn(number) == passing:
            return number


def in_fours(number, sign):
    return sign.join(number[i : i + 4] for i in range(0, 16, 4))


def planted(rng, i):
    """(text, kind or None, value): a true span of the kind, or a decoy."""
    good, bad = digits_of(rng, 16, True), digits_of(rng, 16, False)
    groups = ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(8))
    near = f"{rng.randrange(201, 999)}) 555-{rng.randrange(1000, 9999)}"
    return rng.choice([
        (f"write to u{i}@mail.example.com today", "email", f"u{i}@mail.example.com"),
        (f"mail to u{i} [at] mail [dot] com please", "email", f"u{i} [at] mail [dot] com"),
        (f"the server {groups} went down", "ip", groups),
        (f"login from 10.0.{i % 256}.7 seen", "ip", f"10.0.{i % 256}.7"),
        (f"paid by card {good} then", "card", good),
        (f"paid by card {in_fours(good, '.')} then", "card", in_fours(good, ".")),
        (f"number {in_fours(good, '/')} was given", "card", in_fours(good, "/")),
        (f"call ({near} now", "phone", f"({near}"),
        (f"call +1 ({near} now", "phone", f"+1 ({near}"),
        (f"les {bad} en", None, ""), (f"paid by card {bad} then", None, ""),
        (f"visa card {in_fours(bad, ' ')} then", None, ""), (f"card {in_fours(bad, '.')} then", None, ""),
        (f"version 1.2.3.{rng.randrange(256, 999)} is out", None, ""), ("order 555 1234 5678x came", None, ""),
        (f"address 999.{i}.1.2 is none", None, ""),
    ])


def test_precision_and_recall_of_planted_spans(docs_of):
    rng = random.Random(12)
    given = [planted(rng, i) for i in range(900)]
    right, found, wanted = ({k: 0 for k in pii.KINDS} for _ in range(3))
    for r in pii.find(docs_of([g[0] for g in given])).collect():
        text, kind, value = given[r["doc_id"]]
        true = {f"{kind}:{text.index(value)}:{text.index(value) + len(value)}"} if kind else set()
        spans = set(filter(None, r["spans"].split(",")))
        for s in spans:
            found[s.split(":")[0]] += 1
        if kind:
            wanted[kind] += 1
            right[kind] += len(true & spans)
    for kind in pii.KINDS:
        assert right[kind] >= 0.9 * found[kind], (kind, right, found)
        assert right[kind] >= 0.9 * wanted[kind], (kind, right, wanted)


def plain_em(patterns, rounds):
    """Expectation-maximisation over (kind, votes, n), spelled out."""
    labelers, kinds = range(len(pii.LABELERS)), range(len(pii.KINDS))
    chance = [1 / (1 + math.exp(-sum(votes))) for _, votes, _ in patterns]
    for _ in range(rounds):
        prior, ratio = {}, {}
        for k in kinds:
            mine = [(votes, n, p) for (kind, votes, n), p in zip(patterns, chance) if kind == k]
            true = sum(n * p for _, n, p in mine)
            prior[k] = math.log((true + 1) / (sum(n for _, n, _ in mine) - true + 1))
            for j in labelers:
                share = {}
                for y in (0, 1):
                    seen = {v: (2.0 if v == 2 * y - 1 else 1.0) for v in (-1, 0, 1)}
                    for votes, n, p in mine:
                        seen[votes[j]] += n * (p if y else 1 - p)
                    share[y] = {v: c / sum(seen.values()) for v, c in seen.items()}
                for v in (-1, 0, 1):
                    ratio[k, j, v] = math.log(share[1][v] / share[0][v])
        for k in (pii.KINDS.index("ip"), pii.KINDS.index("card")):  # their checks are known
            ratio[k, 0, -1], ratio[k, 0, 0], ratio[k, 0, 1] = math.log(0.002 / 0.9), 0.0, math.log(0.998 / 0.1)
        chance = [
            1 / (1 + math.exp(-prior[k] - sum(ratio[k, j, votes[j]] for j in labelers))) for k, votes, _ in patterns
        ]
    return chance


def test_reliabilities_equal_plain_python(spark):
    rng = random.Random(2)
    votes = {(rng.randrange(3), tuple(rng.choice((-1, 0, 1)) for _ in pii.LABELERS)) for _ in range(80)}
    patterns = [(k, list(v), float(rng.randint(1, 50))) for k, v in sorted(votes)]
    frame = spark.createDataFrame(patterns, "kind int, votes array<int>, n double")
    rows = frame.withColumn("p", pii.reliabilities(frame, rounds=6)).collect()
    for want, r in zip(plain_em(patterns, 6), rows):
        assert math.isclose(want, r["p"], rel_tol=1e-6, abs_tol=1e-9)


def test_contexts_come_from_the_text(docs_of):
    given = [t for t in texts() if t and len(t) < 400][:400]
    patterns = [*pii.STRICT.values(), *pii.LOOSE.values()]
    docs = docs_of(given)
    for pattern in patterns:
        found = pii._located(F.col("text"), pattern, F.lit(True), lambda hit: F.lit(True))
        for r in docs.select("text", found.alias("hits")).collect():
            for h in r["hits"]:
                end = h["start"] + len(h["hit"])
                assert r["text"][h["start"] : end] == h["hit"] and r["text"][end : end + 1] == h["after"]
                assert r["text"][max(0, h["start"] - pii.NEAR) : h["start"]] == h["before"]


def test_a_text_of_many_addresses_takes_linear_time(docs_of):
    text = "".join(f"u{i}@b.example (938) 555-1{i % 1000:03d} " for i in range(30_000))
    begun = time.monotonic()
    row = pii.find(docs_of([text])).first()
    assert row["n_email"] == 30_000 and time.monotonic() - begun < 60


def test_added_spans_keep_apart_from_base(spark):
    """The two passes against every pair of spans."""
    rng = random.Random(3)
    span = lambda miss: (a := rng.randrange(60), miss, a + rng.randint(1, 9), rng.randrange(4))
    rows = [([span(0) for _ in range(rng.randrange(6))], [span(1) for _ in range(rng.randrange(6))]) for _ in range(200)]
    rows.append(([span(0) for _ in range(700)], [(100, 1, 103, 0)] * 600))
    kind = f"array<{pii._PLACED}>"
    frame = spark.createDataFrame(rows, f"base {kind}, added {kind}")
    for r in frame.select("*", pii._apart(F.col("base"), F.col("added")).alias("kept")).collect():
        want = [s for s in r["added"] if not any(b["start"] < s["end"] and s["start"] < b["end"] for b in r["base"])]
        assert sorted(r["kept"]) == sorted(want)


def test_only_expressions_run(docs_of):
    """No Python in the plan of the candidates or of the result."""
    docs = docs_of(["a@b.org", "x"])
    for df in (pii.candidates(docs), pii.find(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|InArrow", plan)


def test_empty_and_clashing(docs_of):
    docs = docs_of(["a@b.org"]).withColumns({"spans": F.lit(1), "n_email": F.lit("x"), "votes": F.lit(2)})
    row = pii.find(docs).first()
    assert row["n_email"] == 1 and row["spans"] == "email:0:7" and row["votes"] == 2
    assert pii.find(docs_of([])).count() == 0
    assert pii.find(docs_of(["no data", None])).select("spans").distinct().collect()[0][0] == ""
