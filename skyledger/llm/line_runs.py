"""Line dedup: repeated runs of lines by a suffix array over line ids.

Lines become ids and a document a sequence of ids. Suffixes are ordered by prefix
doubling: the rank of the first 2k lines of a suffix is the place of the pair (rank of the
first k lines, rank of the k lines after them) among all such pairs, found by a
distributed sort. Only lines that occur more than once take part; any other line, like the
end of a document, ends every common prefix. The order reaches as deep as the longest run
looked up below needs, which is no more than ``least_chars`` lines.

Suffixes equal to that depth are one entry of the suffix array. Each entry gets the length
of its longest common prefix (LCP) with the entry before it; an interval of depth m is a
stretch of entries between LCPs below m, so its suffixes are those that begin with the same
m lines. The earliest suffix of an interval is the copy that stays.

A line is deleted if a run of consecutive lines of at least ``least_chars`` characters
covers it and the same run starts at an earlier place (documents in order of their id,
then line order). Any such run is the union of its shortest sufficient runs that start at
each of its lines and of those that end at each of its lines, so these two kinds of runs,
each looked up in the interval of its depth, find exactly the lines of all maximal
repeated runs.

Lines are what stands between line feeds, compared byte by byte through a 128-bit hash.
Lines of white space only are skipped: they neither break a run nor are deleted. Null and
empty texts have no lines and stay as they are; an empty table stays empty. A very long
text is one sequence: its lines are one group of the window over its document, sorted with
spilling. Rows equal in id and text are one document: they lose the same lines. Null ids
come first in the order. Other columns, whatever their names, pass through, but that
``mark_lines`` replaces a column named ``__deleted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.batches import stored

LEAST_CHARS = 30
_KEY = ("__doc", "__text")


def _keys(key: str, text: str) -> list[Column]:
    return [F.col(key).alias("__doc"), F.xxhash64(F.col(text)).alias("__text")]


def line_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with a word: document, place among these lines, line number, id, length."""
    blank = " \t\r\x0b\x0c"
    lines = F.transform(
        F.split(F.col(text), "\n"),
        lambda line, number: F.struct(number.alias("number"), line.alias("line")),
    )
    kept = F.filter(lines, lambda e: F.trim(e["line"], F.lit(blank)) != "")
    placed = docs.select(*_keys(key, text), F.posexplode(kept).alias("place", "e"))
    return placed.select(
        *_KEY, "place", F.col("e.number").alias("number"),
        F.length("e.line").alias("chars"),
        F.xxhash64("e.line").alias("id1"),
        F.xxhash64(F.lit("second"), F.col("e.line")).alias("id2"),
    )


def _ranked(distinct: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Order-preserving numbers of distinct rows: sorted over range partitions, written once."""
    ordered = distinct.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return stored(ordered.withColumn("rank", F.monotonically_increasing_id()), name)


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The lines whose id occurs more than once, with the rank of the id."""
    ids = lines.groupBy("id1", "id2").count().filter("count > 1").select("id1", "id2")
    ranks = _ranked(ids, ["id1", "id2"], "line-ids")
    kept = lines.join(ranks, ["id1", "id2"]).select(*_KEY, "place", "number", "chars", "rank")
    return kept.dropDuplicates([*_KEY, "place"])


def _sufficient(active: DataFrame, least_chars: int) -> DataFrame:
    """Starts and line counts of the shortest sufficient runs that start or end at each line.

    A line with a word has a character at least, so no such run is longer than
    ``least_chars`` lines.
    """
    one = active.filter(F.col("chars") >= least_chars).select(*_KEY, F.col("place").alias("start"), F.lit(1).alias("lines"))
    doc = Window.partitionBy(*_KEY).orderBy("place")
    reach = least_chars - 1
    near = F.struct("place", "chars")
    around = active.withColumns({
        "after": F.collect_list(near).over(doc.rowsBetween(0, reach)),
        "before": F.reverse(F.collect_list(near).over(doc.rowsBetween(-reach, 0))),
    }).filter(F.col("chars") < least_chars)

    def shortest(column: str, sign: int) -> Column:
        start = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("chars"), F.lit(True).alias("open"))
        def step(acc, e):
            joined = acc["open"] & (e["place"] == F.col("place") + acc["lines"] * sign)
            return F.struct(
                (acc["lines"] + joined.cast("int")).alias("lines"),
                (acc["chars"] + F.when(joined, e["chars"]).otherwise(0)).alias("chars"),
                (joined & (acc["chars"] + e["chars"] < least_chars)).alias("open"),
            )
        return F.aggregate(
            F.col(column), start, step,
            lambda acc: F.when(acc["chars"] >= least_chars, acc["lines"]),
        )

    more = around.select(
        *_KEY, "place", shortest("after", 1).alias("ahead"), shortest("before", -1).alias("back")
    )
    ahead = more.filter("ahead is not null").select(*_KEY, F.col("place").alias("start"), F.col("ahead").alias("lines"))
    back = more.filter("back is not null").select(*_KEY, (F.col("place") - F.col("back") + 1).alias("start"), F.col("back").alias("lines"))
    return one.union(ahead).union(back).distinct()


def suffix_ranks(active: DataFrame, depth: int) -> DataFrame:
    """The rank of each suffix among all by its first ``depth`` lines or more; equal ones share it.

    ``line`` is the rank of its first line. -1 stands for what lies beyond the end of a run.
    """
    doc = Window.partitionBy(*_KEY).orderBy("place")
    level = active.select(*_KEY, "place", F.col("rank").alias("line"), "rank")
    known = 1
    while known < depth:
        follows = F.lead("place", known).over(doc) == F.col("place") + known
        pairs = level.select(
            *_KEY, "place", "line", F.col("rank").alias("head"),
            F.when(follows, F.lead("rank", known).over(doc)).otherwise(F.lit(-1)).alias("next"),
        )
        names = _ranked(pairs.select("head", "next").distinct(), ["head", "next"], "ranks")
        level = stored(
            pairs.join(names, ["head", "next"]).select(*_KEY, "place", "line", "rank"), "level"
        )
        known *= 2
    return level


def suffix_array(level: DataFrame, depth: int) -> DataFrame:
    """One row per rank with its lines (``depth`` at most) and the LCP with the rank before it.

    Rows lie in order over range partitions (``part``); the last entry of each partition, one
    row per partition, is sent to the next.
    """
    doc = Window.partitionBy(*_KEY).orderBy("place").rowsBetween(0, depth - 1)
    ahead = F.collect_list(F.struct("place", "line")).over(doc)
    unbroken = F.filter("ahead", lambda e, i: e["place"] == F.col("place") + i)
    entries = level.withColumn("ahead", ahead).select(
        "rank", F.transform(unbroken, lambda e: e["line"]).alias("ids")
    ).groupBy("rank").agg(F.first("ids").alias("ids"))
    entries = stored(
        entries.repartitionByRange("rank").sortWithinPartitions("rank")
        .withColumn("part", F.spark_partition_id()), "entries",
    )
    ends = entries.groupBy("part").agg(F.max_by("ids", "rank").alias("end"))
    ends = ends.select("part", F.lag("end").over(Window.orderBy("part")).alias("end"))
    none = F.array().cast("array<bigint>")
    before = F.lag("ids").over(Window.partitionBy("part").orderBy("rank"))
    compared = entries.withColumn("before", before).join(F.broadcast(ends), "part").withColumn(
        "same",
        F.zip_with("ids", F.coalesce("before", "end", none), lambda a, b: a.eqNullSafe(b)),
    )
    differs = F.array_position("same", F.lit(False))
    lcp = F.when(differs > 0, differs - 1).otherwise(F.size("same")).cast("int")
    return stored(compared.select("part", "rank", "ids", lcp.alias("lcp")), "suffix-array")


def interval_starts(array: DataFrame, depth: int) -> DataFrame:
    """For each rank the first rank of its interval of depth 1, 2 .. ``depth``.

    An interval of depth m starts where the LCP falls below m. Starts in earlier partitions
    come from one row per partition.
    """
    names = [f"m{m}" for m in range(1, depth + 1)]
    starts = {n: F.when(F.col("lcp") < m, F.col("rank")) for m, n in enumerate(names, 1)}
    ends = array.groupBy("part").agg(*[F.max(c).alias(n) for n, c in starts.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "part", F.array(*[F.max(n).over(earlier) for n in names]).alias("carried")
    )
    upto = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    own = array.select(
        "part", "rank", F.array(*[F.max(c).over(upto) for c in starts.values()]).alias("own")
    )
    return own.join(F.broadcast(carried), "part").select(
        "rank", F.zip_with("own", "carried", lambda a, b: F.coalesce(a, b)).alias("starts")
    )


def later_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS
) -> DataFrame:
    """(document, text hash, line numbers) of the lines to delete."""
    active = stored(repeated_lines(line_table(docs, key, text)), "lines")
    runs = stored(_sufficient(active, least_chars), "runs")
    depth = runs.agg(F.max("lines")).first()[0] or 1
    level = suffix_ranks(active, depth)
    starts = interval_starts(suffix_array(level, depth), depth)
    suffixes = level.select(*_KEY, F.col("place").alias("start"), "rank")
    found = stored(_null_safe(runs, suffixes, ["start"]), "found")
    where = F.struct(F.col("__doc"), F.col("__text"), F.col("start"))
    # Runs of one rank are counted first, so that a hot interval is a few rows from here on.
    counted = found.groupBy("rank", "lines").agg(
        F.min(where).alias("first"), F.count("*").alias("copies")
    )
    looked = stored(
        counted.join(starts, "rank").select(
            "rank", "lines", "first", "copies",
            F.element_at("starts", F.col("lines")).alias("interval"),
        ),
        "looked",
    )
    # Stored, both, so that each join below stands on two shuffles and a hot interval or rank
    # can be split.
    repeated = stored(
        looked.groupBy("lines", "interval").agg(
            F.min("first").alias("first"), F.sum("copies").alias("copies")
        ).filter("copies > 1").drop("copies"),
        "repeated",
    )
    earliest = stored(
        looked.select("rank", "lines", "interval").join(repeated, ["lines", "interval"])
        .select("rank", "lines", "first"),
        "earliest",
    )
    later = found.join(earliest, ["rank", "lines"]).filter(~where.eqNullSafe(F.col("first")))
    places = later.select(
        *_KEY, F.explode(F.sequence("start", F.col("start") + F.col("lines") - 1)).alias("place")
    ).distinct()
    return _null_safe(active, places, ["place"]).groupBy(*_KEY).agg(
        F.collect_set("number").alias("__deleted")
    )


def _null_safe(left: DataFrame, right: DataFrame, more: list[str]) -> DataFrame:
    """Inner join on the document (null ids equal) and further columns."""
    names = [*_KEY, *more]
    renamed = right.withColumnsRenamed({n: f"{n}__r" for n in names})
    on = [F.col(n).eqNullSafe(F.col(f"{n}__r")) for n in names]
    return left.join(renamed, on).drop(*[f"{n}__r" for n in names])


def _marked(docs: DataFrame, key: str, text: str, least_chars: int) -> DataFrame:
    """Every row as a struct ``row``, with ``__deleted``: no name of its columns can clash."""
    gone = later_copies(docs, key, text, least_chars).withColumnsRenamed(
        {n: f"{n}__r" for n in _KEY}
    )
    keyed = docs.select(F.struct("*").alias("row"), *_keys(key, text))
    on = [F.col(n).eqNullSafe(F.col(f"{n}__r")) for n in _KEY]
    return keyed.join(gone, on, "left").select("row", "__deleted")


def mark_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS
) -> DataFrame:
    """Add ``__deleted``, the numbers of the lines to delete (null: none)."""
    names = [n for n in docs.columns if n.lower() != "__deleted"]
    return _marked(docs, key, text, least_chars).select(
        *[F.col("row").getField(n).alias(n) for n in names], "__deleted"
    )


def remaining(text: str | Column = "text") -> Column:
    """The text without its deleted lines."""
    whole = F.col(text) if isinstance(text, str) else text
    lines = F.filter(
        F.split(whole, "\n"),
        lambda _, number: ~F.array_contains(F.col("__deleted"), number),
    )
    return F.when(F.col("__deleted").isNull(), whole).otherwise(F.array_join(lines, "\n"))


def without_later_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS
) -> DataFrame:
    """Documents without the later copies of repeated runs; an ``n_chars`` column follows.

    A document that had lines deleted and has no word left goes altogether.
    """
    old = {n: F.col("row").getField(n) for n in docs.columns}
    made = _marked(docs, key, text, least_chars).withColumn("left", remaining(old[text]))
    cut = F.col("__deleted").isNotNull()
    emptied = cut & (F.trim(F.col("left"), F.lit(" \t\r\n\x0b\x0c")) == "")
    new = {**old, text: F.col("left")}
    if "n_chars" in new:
        new["n_chars"] = F.when(cut, F.length("left").cast("long")).otherwise(old["n_chars"])
    return made.filter(~emptied).select(*[c.alias(n) for n, c in new.items()])


# The same lines found another way: every sufficient run as text, no ranks.
def oracle(least_chars: int = LEAST_CHARS) -> str:
    return f"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS number
  FROM documents
), lines AS (
  SELECT doc_id, line, number, length(line) AS chars,
    row_number() OVER (PARTITION BY doc_id ORDER BY number) AS place,
    sum(length(line)) OVER (PARTITION BY doc_id ORDER BY number) AS upto
  FROM split WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), ahead AS (
  SELECT a.doc_id, a.place AS start, min(b.place) AS stop
  FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND b.place >= a.place
    AND b.upto - a.upto + a.chars >= {least_chars} AND b.upto - b.chars - a.upto + a.chars < {least_chars}
  GROUP BY ALL
), back AS (
  SELECT b.doc_id, max(a.place) AS start, b.place AS stop
  FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND b.place >= a.place
    AND b.upto - a.upto + a.chars >= {least_chars} AND b.upto - a.upto < {least_chars}
  GROUP BY ALL
), runs AS (SELECT * FROM ahead UNION SELECT * FROM back),
written AS (
  SELECT r.doc_id, r.start, r.stop, string_agg(l.line, chr(10) ORDER BY l.place) AS run
  FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.place BETWEEN r.start AND r.stop
  GROUP BY ALL
), later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, start) AS copy
    FROM written) WHERE copy > 1
), gone AS (
  SELECT DISTINCT l.doc_id, l.number FROM later x JOIN lines l
    ON l.doc_id = x.doc_id AND l.place BETWEEN x.start AND x.stop
), counted AS (
  SELECT s.doc_id, count(*) AS n_lines, count(g.number) AS n_deleted,
    string_agg(CASE WHEN g.number IS NULL THEN s.line END, chr(10) ORDER BY s.number) AS left_text
  FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.number = s.number GROUP BY s.doc_id
)
SELECT doc_id, n_lines, n_deleted, sha256(coalesce(left_text, '')) AS left_sha256 FROM counted
"""
