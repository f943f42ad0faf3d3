"""Byte-level BPE by reduction over a monoid of encoded pieces.

The value of a piece of text is the id list of that piece alone. A text is halved until
its pieces are short, the pieces are encoded, and neighbours are joined up the tree. A
join re-encodes only a window around the seam. It grows the window until its edges are
places where the tokens outside provably cannot change:

* between characters that no match of the split pattern ever holds together (white space
  after anything else; a change between letters, digits and other signs, apart from the
  start of a letter run, which a contraction may reach into), or
* inside one long match, between two tokens that, encoded together, come out as the same
  two tokens. A token list whose neighbours all have that property is the encoding.

Joining is associative, so the tree's shape does not matter. Decoding concatenates the
bytes of the ids up the same kind of tree. Null texts are empty, and an empty text has
no ids. Very long texts, also without any blank, cost one window per join; runs of one
character are joined without encoding them again. Where tokens settle nowhere, the window
grows to the piece, so the work is at most that of encoding once per level of the tree. Repeated
rows are encoded each by itself; input columns named like a result column are replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.batches import Texts, annotate, fields

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF_CHARS = 2048
FIRST_WINDOW, LONGEST_WINDOW = 32, 1024

# A place whose two sides are never in one match.
_STABLE = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}])(?=\p{N})"
)


@functools.lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The ranks of a file of base64 tokens, loaded once per process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def encode(text: str, tokens: tiktoken.Encoding, leaf: int = LEAF_CHARS) -> list[int]:
    """Ids of one text: halve, encode, join."""
    return _reduce(text, 0, len(text), tokens, leaf)


def _reduce(text: str, a: int, b: int, tokens, leaf: int) -> list[int]:
    if b - a <= leaf:
        return tokens.encode_ordinary(text[a:b])
    middle = (a + b) // 2
    left = _reduce(text, a, middle, tokens, leaf)
    right = _reduce(text, middle, b, tokens, leaf)
    return join(text, a, middle, b, left, right, tokens)


def join(text: str, a: int, seam: int, b: int, left: list, right: list, tokens) -> list[int]:
    """Ids of text[a:b] from those of text[a:seam] and text[seam:b]."""
    if not left or not right:
        return left + right
    width = FIRST_WINDOW
    while True:
        start, end = _last_stable(text, a, seam, width), _next_stable(text, seam, b, width)
        if start is not None and end is not None:
            break
        if width == FIRST_WINDOW:  # no seam between words is near: perhaps one long run
            inside = _join_inside(text, a, seam, b, left, right, tokens)
            if inside is not None:
                return inside
        width *= 4
    old_left = len(tokens.encode_ordinary(text[start:seam]))
    old_right = len(tokens.encode_ordinary(text[seam:end]))
    middle = tokens.encode_ordinary(text[start:end])
    return left[: len(left) - old_left] + middle + right[old_right:]


def _last_stable(text: str, a: int, seam: int, width: int) -> int | None:
    """Last stable place before the seam in the window; the piece's start once reached."""
    low = max(a, seam - width)
    last = None
    for m in _STABLE.finditer(text, max(a, low - 1) + 1 if low > a else a + 1, seam):
        # Both neighbours must lie in this piece, and the seam itself is not yet settled.
        if a < m.start() < seam:
            last = m.start()
    return last if last is not None else (a if low == a else None)


def _next_stable(text: str, seam: int, b: int, width: int) -> int | None:
    """First stable place after the seam in the window; the piece's end once reached."""
    high = min(b, seam + width)
    for m in _STABLE.finditer(text, seam + 1, high):
        if seam < m.start() < b:
            return m.start()
    return b if high == b else None


# Characters that one match holds together, however many follow each other.
_RUN = regex.compile(r"\p{L}+|\p{N}+|\s+|[^\s\p{L}\p{N}]+")


def _join_inside(text: str, a: int, seam: int, b: int, left: list, right: list, tokens):
    """Join within one long match by windows of tokens; None if the seam is not inside one."""
    low, high = max(a, seam - LONGEST_WINDOW), min(b, seam + LONGEST_WINDOW)
    near = text[low:high]
    if not _RUN.fullmatch(near):
        return None
    if near.count(near[0]) == len(near):
        turned = _join_equal(text, seam, b, seam - low, left, right, tokens)
        if turned is not None:
            return turned
    pair, raw, settled = _merging(tokens)
    # A token of n bytes covers n characters at most. White space before a word gives up
    # its last character to the next match.
    before, after = seam - low, high - seam - (high < b)
    size = 1
    while size < min(len(left), len(right)):
        parts = [raw(t) for t in left[-size - 1 :]], [raw(t) for t in right[: size + 1]]
        if sum(map(len, parts[0])) > before or sum(map(len, parts[1])) > after:
            return None
        window = pair(b"".join(parts[0][1:] + parts[1][:-1]))
        if settled(left[-size - 1], window[0]) and settled(window[-1], right[size]):
            if all(settled(x, y) for x, y in zip(window, window[1:])):
                return left[:-size] + window + right[size:]
        size *= 2
    return None


def _merging(tokens):
    """Merges of one match without the split pattern, bytes of a token, whether two tokens stay."""
    pair, raw = tokens._encode_single_piece, tokens.decode_single_token_bytes
    return pair, raw, lambda x, y: pair(raw(x) + raw(y)) == [x, y]


def _join_equal(text: str, seam: int, b: int, reach: int, left: list, right: list, tokens):
    """Join inside a run of one character.

    Such a run is the same longest token over and over and a rest, and the rest of the left
    run would shift every token of the right one. As all characters are equal, it may as
    well stand behind the right run's equal tokens: only the two rests are encoded anew.
    """
    pair, raw, settled = _merging(tokens)
    long = right[0]
    unit = text[seam].encode()
    if raw(long) != unit * (len(raw(long)) // len(unit)) or not settled(long, long):
        return None
    rest = 0
    while rest < len(left) and left[-rest - 1] != long:
        rest += 1
        reach -= len(raw(left[-rest]))
        if reach < 0:
            return None
    if rest < len(left) and not settled(left[-rest - 1], long):
        return None
    stop = _RUN.match(text, seam, b).end()
    if stop < b and text[seam].isspace():
        stop -= 1
    bytes_left = len(text[seam:stop].encode())
    same = next((i for i, t in enumerate(right) if t != long), len(right))
    same = min(same, bytes_left // len(raw(long)))
    bytes_left -= same * len(raw(long))
    moved, size, used = [raw(t) for t in left[len(left) - rest :]], 0, 0
    while True:
        ended = used == bytes_left  # the match ends here
        window = pair(b"".join(moved)) if moved else []
        whole = [long, *window] if ended else [long, *window, right[same + size]]
        if all(settled(x, y) for x, y in zip(whole, whole[1:])):
            return left[: len(left) - rest] + right[:same] + window + right[same + size :]
        if ended or size > LONGEST_WINDOW:
            return None
        moved.append(raw(right[same + size]))
        used += len(moved[-1])
        size += 1


def decode(ids: list[int], tokens: tiktoken.Encoding, leaf: int = 4096) -> bytes:
    """Bytes of the ids, concatenated up a tree."""
    if len(ids) <= leaf:
        return tokens.decode_bytes(ids)
    middle = len(ids) // 2
    return decode(ids[:middle], tokens, leaf) + decode(ids[middle:], tokens, leaf)


def encode_column(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Add the ids of each text as an array."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def make():
        tokens = encoding(path)
        return lambda texts: [[encode(t, tokens) for t in texts.strings()]]

    return annotate(docs, text, fields(ids="array<int>"), make)


def digest_column(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Add the number of ids, the digest of the ids, and that of the bytes decoded from them.

    One pass, so that the ids, several times the size of the text as digests need them,
    never leave the task.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def make():
        tokens = encoding(path)

        def run(texts: Texts):
            rows = []
            for text_ in texts.strings():
                ids = encode(text_, tokens)
                rows.append((
                    len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(decode(ids, tokens)).hexdigest(),
                ))
            return list(zip(*rows))

        return run

    result = fields(n_tokens="long", ids_sha256="string", decoded_sha256="string")
    return annotate(docs, text, result, make)


def decode_column(df: DataFrame, ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """Add the bytes that an array of ids stands for; a null array gives null.

    Goes by Arrow like the others; ``ids`` arrays come as lists.
    """
    from pyspark.sql import types as T
    import pyarrow as pa

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    kept = df.drop("decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        tokens = encoding(path)
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            made = [None if v is None else decode(v, tokens) for v in values]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.binary())], names=schema.names
            )

    return kept.mapInArrow(run, schema)
