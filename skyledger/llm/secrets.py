"""Secret scan: patterns for known forms, token efficiency for the rest.

Three fixed patterns give the base spans. Besides, every long run of key characters is
encoded with a public byte-pair vocabulary: text and names take few tokens, random
strings take about one token per two characters, so few characters per token expose
them. Known harmless forms are left out first: digests of the usual lengths, UUIDs, plain
numbers and dates. Runs that look like names, paths or words (one case, or parts joined by
signs or capitals) are judged by the best of two vocabularies, in either case of letters and
without the numbers between their signs, as capitals and other languages cost more tokens
than they should; their limit is lower, as random letters of one case stay well below it.

Spans are ``kind:start:end`` in code points, the end exclusive, by start and then by kind
in the order assign, access, hex, random. A random span never overlaps a base span. Null
and empty texts have no spans; repeated rows are scanned each by itself; input columns
named like a result column are replaced. A text costs time in proportion to its length, also
with many thousand spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.batches import Texts, annotate, fields
from skyledger.llm.bpe_tree import encoding

VOCABULARY = "byte_bpe_50k.tiktoken"
VOCABULARIES = (VOCABULARY, "byte_bpe_multi_50k.tiktoken")  # for runs like names and words
MOST_CHARS_PER_TOKEN, MOST_OF_WORDS = 2.4, 2.2
LEAST_CHARS = 16
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % LEAST_CHARS)
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_DIGEST_CHARS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_NUMBERS = re.compile(r"[0-9+/_=-]+")
_NUMBER_PART = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,8}+(?![0-9A-Za-z])")
# One case only, and words and numbers joined by signs or capitals. Possessive: a long
# run is read once.
_PLAIN = re.compile(
    r"[a-z+/_=-]+|[A-Z+/_=-]+|[+/_=-]*+(?:(?:[A-Z]?[a-z]++(?:[0-9]{1,4}+(?![0-9A-Za-z]))?+"
    r"|[A-Z]{2,}+(?![0-9a-z])|[0-9]{1,8}+(?![0-9A-Za-z]))[+/_=-]*+)++"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns; matches failing their length are dropped."""
    found = [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [(2, m.start(), m.end()) for m in _HEX.finditer(text)]


def harmless(run: str) -> bool:
    """A known digest, identifier or number."""
    return bool(
        _UUID.fullmatch(run)
        or (len(run) in _DIGEST_CHARS and _DIGEST.fullmatch(run))
        or _NUMBERS.fullmatch(run)
    )


def inefficient(run: str, tokens: list, most: float) -> bool:
    """Whether a run takes more tokens than text or names would."""
    per_token = lambda s, t: len(s) / len(t.encode_ordinary(s))
    if not _PLAIN.fullmatch(run):
        return per_token(run, tokens[0]) <= most
    words = _NUMBER_PART.sub("", run)
    if len(words.strip("=-_/+")) < LEAST_CHARS:
        return False
    most = min(most, MOST_OF_WORDS)
    return all(per_token(s, t) <= most for t in tokens for s in {words, words.lower()})


def random_spans(text: str, taken: list, tokens, most: float) -> list[tuple[int, int, int]]:
    """Runs that are inefficient to encode and overlap no base span; ``taken`` comes by start."""
    found = []
    starts, reach = [start for _, start, _ in taken], list(accumulate((end for *_, end in taken), max))
    for m in _RUN.finditer(text):
        run, a, b = m[0].strip("=-_/+"), m.start(), m.end()
        if len(run) < LEAST_CHARS or harmless(run):
            continue
        before = bisect_left(starts, b)  # spans that start before the run ends
        if before and reach[before - 1] > a:
            continue
        if inefficient(run, tokens, most):
            found.append((3, a, b))
    return found


RESULT = fields(n_assign="long", n_access="long", n_hex="long", base_spans="string", spans="string")


def scan(
    docs: DataFrame, text: str = "text", vocabulary: str | None = None,
    most: float = MOST_CHARS_PER_TOKEN,
) -> DataFrame:
    """Add the number of base spans of each kind, the base spans and all spans."""
    paths = [vocabulary or public_tokenizers.path(VOCABULARY)]
    paths += [public_tokenizers.path(name) for name in VOCABULARIES[1:]]
    spell = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
    in_order = lambda spans: sorted(spans, key=lambda s: (s[1], s[0], s[2]))

    def make():
        tokens = [encoding(path) for path in paths]

        def run(texts: Texts):
            rows = []
            for value in texts.strings():
                base = in_order(base_spans(value))
                more = random_spans(value, base, tokens, most)
                kinds = [s[0] for s in base]
                rows.append((
                    kinds.count(0), kinds.count(1), kinds.count(2), spell(base),
                    spell(in_order(base + more)),
                ))
            return list(zip(*rows)) or [[]] * 5

        return run

    return annotate(docs, text, RESULT, make)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """Replace every span in the text, overlapping spans as one; other texts stay as they are.

    A redacted text is shorter or longer than before; an ``n_chars`` column follows it.
    """
    found = scan(docs, text, **options)
    at = F.transform(
        F.split(F.col("spans"), ","),
        lambda s: F.struct(
            F.split(s, ":")[1].cast("int").alias("a"), F.split(s, ":")[2].cast("int").alias("b")
        ),
    )
    # Spans come by start: keep the text between them, cutting each only once.
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("end"))
    folded = F.aggregate(
        at, start,
        lambda acc, s: F.struct(
            F.when(
                s["a"] >= acc["end"],
                F.concat(acc["done"], F.col(text).substr(acc["end"] + 1, s["a"] - acc["end"]), F.lit(mark)),
            ).otherwise(acc["done"]).alias("done"),
            F.greatest(acc["end"], s["b"]).alias("end"),
        ),
        lambda acc: F.concat(acc["done"], F.col(text).substr(acc["end"] + 1, F.length(text))),
    )
    changed = F.col("spans") != ""
    made = found.withColumn(text, F.when(changed, folded).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        made = made.withColumn(
            "n_chars", F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))
        )
    return made.select(docs.columns)
