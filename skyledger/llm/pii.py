"""Personal data by weak supervision, in DataFrame expressions only.

Loose patterns propose candidate spans of four kinds. Five labelers vote for (1), against
(-1) or not at all (0) on each: the strict pattern with its checks, the shape, a gazetteer,
words standing before the span that name the kind, and words or joined characters that
speak against it. The check digit of a card number and the range of address parts are
labelers of known reliability. Expectation-maximisation over the counts of vote patterns
estimates, per kind, how often each other labeler gives each vote on true and on false
candidates, without any labelled data. The posteriors then train the final span classifier,
a logistic regression over the votes of each kind and the length; what it accepts is added to
the strict spans, which always stay.

Counts of vote patterns are all that the model needs from the corpus: at most kinds x votes x
lengths rows. Texts are read once, span lists stay in their row, and nothing is joined.

A span is ``kind:start:end`` in code points, end exclusive, by kind (email, ip, card, phone)
and then start. Null and empty texts have no spans; an empty table or one without candidates
gives the strict spans only; repeated rows are searched each by itself; a column of the input
named like a result column is replaced. A text of very many spans is searched in blocks of
them: a hundred thousand cost seconds.
"""

from __future__ import annotations

import functools
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.batches import stored
from skyledger.session import persisted

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "shape", "gazetteer", "context", "against")
ROUNDS, ACCEPT, NEAR, BLOCK = 12, 0.5, 32, 64
# Known rather than estimated: how often a true and a false card number fail the check digit,
# and a true and a false address have a part that is out of range.
FAILS_CHECK = {("card", "strict"): (0.002, 0.9), ("ip", "strict"): (0.002, 0.9)}

# Possessive repeats and look-behinds give the leftmost non-overlapping matches of the plain
# patterns in linear time: where a match fails at the start of a run, it fails inside it too.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further forms, searched besides the strict ones.
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?{_LABEL}++"
    rf"(?:\x20?(?:\.|[\[(]\x20?(?i:dot)\x20?[\])])\x20?{_LABEL}++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z./_-])[0-9]{4}(?:([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|([./_])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z]|[./_-][0-9])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])",
}
# A text without this holds no match of the pattern.
_NEEDS = {
    ("email", "strict"): "@", ("phone", "strict"): "+", ("ip", "loose"): ":",
}

# Gazetteers and context words.
TOP_LEVEL = "com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|us|ca|au|ch|at|be|br|jp|cn|in|ru"
COUNTRY_CODES = "1|7|20|27|30|31|32|33|34|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
CARD_PREFIXES = "3[0-9]|4|5[0-9]|6[0-9]|2[2-7]|9[0-9]"
CONTEXT = {
    "email": "e-?mail|mail|contact|kontakt|contacto|correo|courriel|write|schreib",
    "ip": r"\bip\b|address|adresse|host|server|login|from",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta|iban|account|konto",
    "phone": r"phone|tel\b|tel\.|call|mobile|cell|fax|telefon|téléphone|teléfono|anruf|appel",
}
AGAINST = r"version|release|order|invoice|isbn|article|serial|section|chapter|build|model"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, join, zero: int) -> Column:
    """For each place of an array of numbers, ``join`` over the values before it.

    Blocks are joined first, so that a place looks at a block and the joined blocks only.
    A state holding lists would be copied whole at each of its steps.
    """
    start = F.lit(zero)

    def over(v):
        last = F.greatest(F.ceil(F.size(v) / BLOCK).cast("int") - 1, F.lit(0))
        blocks = F.transform(
            F.sequence(F.lit(0), last),
            lambda b: F.aggregate(F.slice(v, b * BLOCK + 1, F.lit(BLOCK)), start, join),
        )

        def places(before):
            block = lambda i: F.floor(i / BLOCK).cast("int")
            return F.transform(v, lambda _, i: F.aggregate(
                F.slice(v, block(i) * BLOCK + 1, i % BLOCK), F.get(before, block(i)), join
            ))

        upto = _bound(blocks, lambda t: F.transform(
            t, lambda _, b: F.aggregate(F.slice(t, F.lit(1), b), start, join)
        ))
        return _bound(upto, places)

    return _bound(values, over)


def _located(text: Column, pattern: str, needs: Column, accept) -> Column:
    """Matches in order: start, match, the characters before it and the one after it.

    ``accept`` drops failing ones without a retry. Places and contexts come from the gaps
    between the matches, so that no match is looked up from the start of the text.
    """
    found = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )

    def beside(p):
        gap, after = lambda i: F.get(p["gaps"], i), lambda i: F.get(p["hits"], i + 1)
        return F.transform(p["hits"], lambda hit, i: F.struct(
            F.length(gap(i)).alias("gap"), hit.alias("hit"), F.right(gap(i), F.lit(NEAR)).alias("near"),
            F.left(F.when(gap(i + 1) != "", gap(i + 1)).otherwise(F.coalesce(after(i), F.lit(""))), F.lit(1)).alias("after"),
        ))

    def spans(items):
        def before(item, i):
            # A match has two characters at least, so that many of them fill the context.
            few = F.least(i, F.lit(NEAR // 2))
            earlier = F.transform(F.slice(items, i - few + 1, few), lambda e: F.concat(e["near"], e["hit"]))
            return F.right(F.concat(F.array_join(earlier, ""), item["near"]), F.lit(NEAR))

        def described(starts):
            return F.filter(F.transform(items, lambda item, i: F.when(accept(item["hit"]), F.struct(
                (F.get(starts, i) + item["gap"]).alias("start"), item["hit"].alias("hit"),
                before(item, i).alias("before"), item["after"].alias("after"),
            ))), lambda span: span.isNotNull())

        sizes = F.transform(items, lambda e: e["gap"] + F.length(e["hit"]))
        return _bound(_running(sizes, lambda a, n: a + n, 0), described)

    none = F.array().cast("array<struct<start:int,hit:string,before:string,after:string>>")
    return F.when(needs, _bound(_bound(found, beside), spans)).otherwise(none)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    number = _digits(hit)
    n = F.length(number)

    def step(total, i):
        digit = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def _strict(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(hit)).between(13, 19), _luhn(hit)).otherwise(False)
    return F.length(_digits(hit)).between(9, 15)


def _candidate(kind: str, form: str, hit: Column) -> Column:
    """What is worth a vote: strict matches, and near misses of their length."""
    if form == "loose" or kind == "email":
        return F.lit(True)
    if kind == "card":
        return F.length(_digits(hit)).between(13, 19)
    return _strict(kind, hit) if kind == "phone" else F.lit(True)


def _votes(kind: str, form: str, hit: Column, before: Column, after: Column) -> list[Column]:
    yes_no = lambda c: F.when(c, 1).otherwise(-1)
    yes = lambda c: F.when(c, 1).otherwise(0)
    digits = _digits(hit)
    shape = {
        "email": hit.rlike(r"(?i)(?:\.|dot\x20?[\])])\x20?[A-Za-z]{2,10}$"),
        "ip": hit.rlike(r"^(?:(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}|[0-9A-Fa-f:]+)$"),
        "card": hit.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}([\x20./_-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([\x20./_-])[0-9]{6}\2[0-9]{5})$"),
        "phone": F.length(digits).between(10, 13),
    }[kind]
    known = {
        "email": hit.rlike(rf"(?i)[.\x20\])](?:{TOP_LEVEL})$"),
        "ip": ~hit.rlike(r"^(?:0|2[3-5][0-9]|[3-9][0-9][0-9])"),
        "card": digits.rlike(rf"^(?:{CARD_PREFIXES})"),
        "phone": hit.rlike(rf"^(?:\+(?:{COUNTRY_CODES})|\()"),
    }[kind]
    # The check digit speaks for every way of writing a card number; eight groups are in range.
    strict = yes_no(_strict(kind, hit)) if form == "strict" or kind == "card" else F.lit(1 if kind == "ip" else -1)
    against = before.rlike(rf"(?i)(?:{AGAINST})[\W_]{{0,4}}$") | before.rlike("[0-9A-Za-z_]$") | after.rlike("^[0-9A-Za-z_]")
    return [
        strict, yes_no(shape), yes_no(known), yes(before.rlike(rf"(?i)(?:{CONTEXT[kind]})")),
        F.when(against, -1).otherwise(0),
    ]


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans``: per candidate the kind, place, votes, length class and whether it is strict."""
    whole = F.coalesce(F.col(text), F.lit(""))
    digit = F.coalesce(F.col(text).rlike("[0-9]"), F.lit(False))
    found = []
    for form, patterns in (("strict", STRICT), ("loose", LOOSE)):
        for kind, pattern in patterns.items():
            needs = F.contains(whole, F.lit(_NEEDS[kind, form])) if (kind, form) in _NEEDS else digit
            if (kind, form) == ("email", "loose"):
                needs = whole.rlike(r"(?i)[\[(]\x20?at\x20?[\])]")
            hits = _located(whole, pattern, needs, functools.partial(_candidate, kind, form))
            found.append(F.transform(hits, functools.partial(_described, kind, form)))
    return docs.withColumn("spans", F.concat(*found))


def _described(kind: str, form: str, span: Column) -> Column:
    start, hit = span["start"], span["hit"]
    end = start + F.length(hit)
    votes = _votes(kind, form, hit, span["before"], span["after"])
    strict = _strict(kind, hit) if form == "strict" else F.lit(False)
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), end.alias("end"),
        F.array(*votes).alias("votes"),
        F.least(F.lit(9), F.floor((end - start) / 4)).cast("int").alias("size"), strict.alias("strict"),
    )


def _log_ratios(shares: dict) -> list[float]:
    """Log of P(vote | true) / P(vote | false), by kind, labeler and vote."""
    return [
        math.log(shares[kind, j, vote, 1] / shares[kind, j, vote, 0])
        for kind in range(len(KINDS)) for j in range(len(LABELERS)) for vote in (-1, 0, 1)
    ]


def _posterior(prior: list[float], ratios: list[float]) -> Column:
    """Chance that a candidate is true, from its kind and votes."""
    table = F.array(*[F.lit(float(r)) for r in ratios])
    z = F.array(*[F.lit(float(p)) for p in prior])[F.col("kind")]
    for j in range(len(LABELERS)):
        z = z + table[(F.col("kind") * len(LABELERS) + j) * 3 + F.col("votes")[j] + 1]
    return 1 / (1 + F.exp(-z))


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> Column:
    """Expectation-maximisation over counted vote patterns; the posterior it ends with.

    Starts from the balance of the votes. Each share is smoothed towards a labeler that
    is right rather than wrong, which also keeps the two classes from changing names; the
    shares of the checks in ``FAILS_CHECK`` are known and stay fixed. Only sums per kind, labeler and vote
    come to the driver.
    """
    chance = 1 / (1 + F.exp(-F.aggregate("votes", F.lit(0), lambda a, v: a + v).cast("double")))
    sums = [
        F.sum(F.when(F.col("votes")[j] == vote, F.col("n") * (F.col("p") if y else 1 - F.col("p"))).otherwise(0.0)).alias(f"s{j}_{vote + 1}_{y}")
        for j in range(len(LABELERS)) for vote in (-1, 0, 1) for y in (0, 1)
    ]
    for _ in range(rounds):
        rows = {
            r["kind"]: r for r in patterns.withColumn("p", chance).groupBy("kind").agg(
                F.sum(F.col("n") * F.col("p")).alias("true"), F.sum("n").alias("all"), *sums
            ).collect()
        }
        prior, shares = [], {}
        for kind in range(len(KINDS)):
            row = rows.get(kind)
            true, every = (row["true"], row["all"]) if row else (0.0, 0.0)
            prior.append(math.log((true + 1) / (every - true + 1)))
            for j in range(len(LABELERS)):
                for y in (0, 1):
                    seen = [(row[f"s{j}_{v}_{y}"] if row else 0.0) for v in (0, 1, 2)]
                    smooth = [seen[v] + (2.0 if v == 2 * y else 1.0) for v in (0, 1, 2)]
                    for v in (0, 1, 2):
                        shares[kind, j, v - 1, y] = smooth[v] / sum(smooth)
        for (kind, labeler), (of_true, of_false) in FAILS_CHECK.items():
            at = KINDS.index(kind), LABELERS.index(labeler)
            for y, fails in ((1, of_true), (0, of_false)):
                shares[*at, -1, y], shares[*at, 0, y], shares[*at, 1, y] = fails, 1.0, 1 - fails
        chance = _posterior(prior, _log_ratios(shares))
    return chance


def _features(span) -> list[Column]:
    """Votes for and against of each labeler, kind by kind; the kind; the length class."""
    votes = [
        ((span("kind") == k) & (span("votes")[j] == v)).cast("double")
        for k in range(len(KINDS)) for j in range(len(LABELERS)) for v in (-1, 1)
    ]
    kinds = [(span("kind") == k).cast("double") for k in range(len(KINDS))]
    return [*votes, *kinds, span("size").cast("double")]


def train(found: DataFrame):
    """Final classifier from counted candidates: a function from a span to its score, or None."""
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.size")
    with persisted(spans.groupBy("kind", "votes", "size").agg(F.count("*").cast("double").alias("n"))) as patterns:
        if patterns.isEmpty():
            return None
        marked = patterns.withColumn("p", reliabilities(patterns))
        both = marked.select("*", F.explode(F.array(F.lit(1.0), F.lit(0.0))).alias("label")).withColumn(
            "weight", F.col("n") * F.when(F.col("label") == 1.0, F.col("p")).otherwise(1 - F.col("p"))
        )
        columns = [c.alias(f"f{i}") for i, c in enumerate(_features(F.col))]
        rows = both.select("label", "weight", *columns)
        names = rows.columns[2:]
        vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows).filter("weight > 0")
        model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=60).fit(vectors)
    weights, bias = [float(w) for w in model.coefficients], float(model.intercept)

    def score(span: Column) -> Column:
        z = F.lit(bias)
        for weight, part in zip(weights, _features(lambda name: span[name])):
            z = z + part * weight
        return 1 / (1 + F.exp(-z))

    return score


def _spelled(spans: Column) -> Column:
    """Spans as text, by kind and then start."""
    names = F.array(*[F.lit(k) for k in KINDS])
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])))
    return F.array_join(
        F.transform(in_order, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


_PLACED = "struct<start:int,miss:int,end:int,kind:int>"


def _apart(base: Column, added: Column) -> Column:
    """The added spans that overlap no base span, by the bounds of the base spans on either side."""
    far = 2**31 - 1

    def apart(spans):
        is_base = lambda s: s["miss"] == 0
        ends = F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(0))
        starts = F.transform(F.reverse(spans), lambda s: F.when(is_base(s), s["start"]).otherwise(far))
        both = F.struct(
            _running(ends, lambda a, e: F.greatest(a, e), 0).alias("reach"),
            _running(starts, lambda a, e: F.least(a, e), far).alias("next"),
        )
        return _bound(both, lambda b: F.filter(spans, lambda s, i: (
            (s["miss"] == 1) & (F.get(b["reach"], i) <= s["start"])
            & (F.get(b["next"], F.size(spans) - 1 - i) >= s["end"])
        )))

    return _bound(F.array_sort(F.concat(base, added)), apart)


def find(docs: DataFrame, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Add counts of strict spans per kind, the strict spans and all spans, as text.

    The text column is not part of the result. Candidates, small beside the texts,
    are written once and read twice: for the model and for the verdicts.
    """
    kept = [c for c in docs.columns if c not in (text, "base_spans", "spans", *(f"n_{k}" for k in KINDS))]
    found = stored(candidates(docs, text).select(*kept, "spans"), "candidates")
    score = train(found)
    flat = lambda spans, miss: F.transform(spans, lambda s: F.struct(
        s["start"], F.lit(miss).alias("miss"), s["end"], s["kind"]
    ))
    base = flat(F.filter("spans", lambda s: s["strict"]), 0)
    more = F.array().cast(f"array<{_PLACED}>")
    if score is not None:
        # A near miss beside a word against it, or inside a longer word, is never added.
        clear = lambda s: s["votes"][LABELERS.index("against")] >= 0
        added = flat(F.filter("spans", lambda s: ~s["strict"] & clear(s) & (score(s) >= accept)), 1)
        more = F.when(F.size("added") > 0, _apart(F.col("base"), F.col("added"))).otherwise(more)
        found = found.withColumn("added", added)
    of_kind = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    counts = {f"n_{kind}": of_kind(i) for i, kind in enumerate(KINDS)}
    return (
        found.withColumn("base", base).withColumn("more", more).withColumns(counts)
        .select(
            *kept, *counts, _spelled(F.col("base")).alias("base_spans"),
            _spelled(F.concat("base", "more")).alias("spans"),
        )
    )
