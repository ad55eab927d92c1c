"""Line dedup by content-defined chunks of lines.

A text's lines are hashed; a rolling hash over the last two line hashes ends a
chunk where it is divisible by ``divisor``, so boundaries depend on the lines
around them and move with them when text is put in or taken out elsewhere.  (With
``whole``, a chunk starts at each local minimum of the line hashes, two lines or
more from either end of the text, so no chunk of a text of several lines is one
line long, and a match goes on over equal lines next to its first place.)  A
chunk of ``min_lines`` lines or more that is found again anywhere in the corpus
is removed everywhere but at its first place (smallest document id, then place in
the document), after its bytes have been compared with the first one's.

The texts move once: chunk hashes are counted on narrow rows (pre-aggregated, so
a chunk in a third of all documents is no hot task), the marks go back to the
documents by a join, and only repeated chunks' bytes are exchanged to compare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rekindle.llm.common import identity, spare_names, spread_join, written
from rekindle.llm.fingerprints import bind

DIVISOR = 2
MIN_LINES = 2
_MULTIPLIER = 31


def line_hash(line: Column) -> Column:
    """28 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("bigint")


def chunk_ends(lines: Column, divisor: int) -> Column:
    """Numbers of lines after which a chunk ends; the last line always ends one."""
    def ends(h: Column) -> Column:
        before = lambda i: F.coalesce(F.get(h, i - 2), F.lit(0))
        roll = lambda i: before(i) * _MULTIPLIER + F.get(h, i - 1)
        return F.filter(F.sequence(F.lit(1), F.size(h)), lambda i: (i == F.size(h)) | (F.pmod(roll(i), F.lit(divisor)) == 0))
    return bind(F.transform(lines, line_hash), ends)


def minima_ends(lines: Column) -> Column:
    """Numbers of lines before a local minimum of the line hashes; all chunks of a text of two lines or more have two."""
    def ends(h: Column) -> Column:
        low = lambda i: (F.get(h, i - 1) > F.get(h, i)) & (F.get(h, i) <= F.get(h, i + 1))
        return F.filter(F.sequence(F.lit(1), F.size(h)),
                        lambda i: (i == F.size(h)) | ((i >= 2) & (i <= F.size(h) - 2) & low(i)))
    return bind(F.transform(lines, line_hash), ends)


def chunks(text: Column, divisor: int = DIVISOR, whole: bool = False) -> Column:
    """array<struct<n_lines, body>> of a text; bodies joined by newlines give the text back."""
    def cut(lines: Column) -> Column:
        def each(ends: Column) -> Column:
            start = lambda j: F.when(j == 0, 0).otherwise(F.get(ends, j - 1))
            return F.transform(ends, lambda e, j: F.named_struct(
                F.lit("n_lines"), e - start(j),
                F.lit("body"), F.array_join(F.slice(lines, start(j) + 1, e - start(j)), "\n")))
        return bind(minima_ends(lines) if whole else chunk_ends(lines, divisor), each)
    return bind(F.split(F.coalesce(text, F.lit("")), "\n", -1), cut)


def body_hash(body: Column) -> Column:
    return F.xxhash64(body)


def _equal_start(a: Column, b: Column) -> Column:
    """How many elements two arrays (NULL: none) have in common at their start."""
    none = F.array().cast("array<string>")
    a, b = F.coalesce(a, none), F.coalesce(b, none)
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(at == 0, F.size(a)).otherwise(at - 1).cast("int")


def _without(text: Column, gone: Column, edges: Column) -> Column:
    """struct<text, n>: the lines outside the chunks ``gone`` and the equal lines around them, and how many went."""
    def cut(lines: Column) -> Column:
        def keep(ends: Column) -> Column:
            edge = lambda j, side: F.coalesce(F.get(F.filter(edges, lambda e: e["k"] == j), F.lit(0))[side], F.lit(0))
            out = F.flatten(F.transform(gone, lambda j: F.sequence(
                F.when(j == 0, 0).otherwise(F.get(ends, j - 1)) + 1 - edge(j, "before"), F.get(ends, j) + edge(j, "after"))))
            return bind(F.array_except(F.sequence(F.lit(1), F.size(lines)), out), lambda left: F.named_struct(
                F.lit("text"), F.array_join(F.transform(left, lambda i: F.get(lines, i - 1)), "\n"),
                F.lit("n"), F.size(lines) - F.size(left)))
        return bind(minima_ends(lines), keep)
    return bind(F.split(text, "\n", -1), cut)


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR,
          min_lines: int = MIN_LINES, whole: bool = False,
          marks: tuple[str, str] = ("_chunks_removed", "_lines_removed")) -> DataFrame:
    """All rows and columns of ``docs`` with repeated chunks taken out of the text.

    Two columns, ``marks``, are added (and replaced if present): the numbers of
    chunks and of lines removed.  A text without a removed chunk is returned byte for byte.

    ``whole``: chunks by local minima, and each match is extended over the lines
    next to it that equal the lines next to its first place (further than the
    neighbouring chunk it need not reach: a whole equal chunk is a match of its
    own).  Every removed line stands at an earlier place, so one copy stays; a
    later exact copy of a text of several lines goes whole.

    Defined cases: NULL and empty texts stay as they are; a chunk of blank lines
    only is never removed; NULL ids come first in the order of places; rows with
    the same id and text count as one document (each is treated alike); an empty
    table gives an empty result.
    """
    cols = [c for c in docs.columns if c not in marks]
    row, spans, differ, gone, cut, edge = spare_names(docs, "_row", "_spans", "_differ", "_gone", "_cut", "_edge")
    text = F.col(text_col)
    base = docs.select(*[F.col(c) for c in cols], identity(F.col(id_col), text).alias(row))
    narrow = base.select(F.col(row).alias("row"), F.col(id_col).alias("id"),
                         F.posexplode(chunks(text, divisor, whole)).alias("k", "c"))
    narrow = written(narrow.filter((F.col("c.n_lines") >= min_lines) & F.col("c.body").rlike(r"[^\x20\x09-\x0D]"))
                     .select("row", "id", "k", body_hash(F.col("c.body")).alias("h")), "line-chunks")
    found = (narrow.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("id", "row", "k")).alias("first"))
             .filter("n > 1").select("h", "first", "n"))
    repeats = (spread_join(narrow, found.withColumn("found", F.col("n")), ["h"], "n", "inner")
               .select(F.col("row").alias(row), F.struct("k", "h", F.col("found").alias("n"), (
                   (F.col("row") == F.col("first.row")) & (F.col("k") == F.col("first.k"))).alias("first")).alias("s"))
               .groupBy(row).agg(F.collect_set("s").alias(spans)))  # a document's own chunks
    marked = written(base.join(repeats, row, "left"), "line-marked")

    bytes_ = (marked.filter(F.col(spans).isNotNull())
              .select(F.col(row).alias("row"), chunks(text, divisor, whole).alias("c"), F.explode(spans).alias("s"))
              .select("row", "s.k", "s.h", "s.n", "s.first", F.get("c", F.col("s.k"))["body"].alias("body"), *[
                  F.get("c", F.col("s.k") + step)["body"].alias(side)
                  for step, side in ((-1, "before"), (1, "after")) if whole]))
    first = bytes_.filter("first").dropDuplicates(["h"]).select("h", "n", *[
        F.col(x).alias(f"first_{x}") for x in ("body", "before", "after") if x in bytes_.columns])
    # the chunks met by broadcast are at most 500 times the mean chunk, since each is in a 500th of the rows or more
    other = spread_join(bytes_.filter("not first").drop("n"), first, ["h"], "n", "inner")
    if whole:
        lines = lambda x: F.split(F.col(x), "\n", -1)
        near = (other.filter(F.col("body") == F.col("first_body"))
                .select("row", "k", _equal_start(F.reverse(lines("before")), F.reverse(lines("first_before"))).alias("before"),
                        _equal_start(lines("after"), lines("first_after")).alias("after"))
                .filter((F.col("before") > 0) | (F.col("after") > 0)))
        near = written(near.groupBy(F.col("row").alias(row)).agg(
            F.collect_set(F.struct("k", "before", "after")).alias(edge)), "line-edges")
    other = other.filter(F.col("body") != F.col("first_body"))
    # chunks that only share a hash: hardly ever a row, so this side's measured size decides on its broadcast
    other = written(other.groupBy(F.col("row").alias(row)).agg(F.collect_set("k").alias(differ)), "line-differ")
    none = F.array().cast("array<int>")
    removed = F.array_except(F.transform(F.filter(spans, lambda s: ~s["first"]), lambda s: s["k"]),
                             F.coalesce(F.col(differ), none))
    out = marked.join(other, row, "left").withColumn(gone, F.coalesce(removed, none))
    if whole:
        out = out.join(near, row, "left")
        edges = F.coalesce(F.col(edge), F.array().cast("array<struct<k:int,before:int,after:int>>"))
    rest = _without(text, F.col(gone), edges) if whole else bind(chunks(text, divisor, whole), lambda c: F.named_struct(
        F.lit("text"),
        F.array_join(F.transform(F.filter(c, lambda x, j: ~F.array_contains(gone, j)), lambda x: x["body"]), "\n"),
        F.lit("n"), F.aggregate(F.filter(c, lambda x, j: F.array_contains(gone, j)), F.lit(0),
                                lambda acc, x: acc + x["n_lines"])))
    out = out.withColumn(cut, F.when(F.size(gone) > 0, rest))
    return out.select(*[F.coalesce(F.col(f"{cut}.text"), text).alias(c) if c == text_col else F.col(c) for c in cols],
                      F.size(gone).alias(marks[0]), F.coalesce(f"{cut}.n", F.lit(0)).alias(marks[1]))


def drop_repeated_chunks(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated chunks removed; a document all of whose words stand elsewhere goes.

    Columns are those of ``docs``; ``n_chars``, if present, is counted anew for changed texts.
    """
    marks = spare_names(docs, "_chunks_removed", "_lines_removed")
    out = dedup(docs, text_col=text_col, marks=tuple(marks), **options)
    left = F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    out = out.filter((F.col(marks[0]) == 0) | left)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(marks[0]) > 0, F.length(text_col).cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op2_query(docs: DataFrame) -> DataFrame:
    """doc_id, removed chunks and lines, length and MD5 of what is left."""
    out = dedup(docs.select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", F.col("_chunks_removed").cast("long").alias("chunks_removed"),
                      F.col("_lines_removed").cast("long").alias("lines_removed"),
                      F.length(text).cast("long").alias("n_chars_left"), F.md5(text.cast("binary")).alias("md5_left"))


ORACLE = f"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS x FROM l),
r AS (SELECT *, coalesce(lag(x) OVER o, 0) * {_MULTIPLIER} + x AS roll, max(i) OVER (PARTITION BY doc_id, text) AS n
      FROM h WINDOW o AS (PARTITION BY doc_id, text ORDER BY i)),
e AS (SELECT *, coalesce(sum(CASE WHEN roll % {DIVISOR} = 0 THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM r),
c AS (SELECT doc_id, text, k, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS body FROM e GROUP BY ALL),
f AS (SELECT *, n_lines >= {MIN_LINES} AND regexp_matches(body, '[^\\x20\\x09-\\x0D]')
          AND row_number() OVER (PARTITION BY body, n_lines >= {MIN_LINES} ORDER BY doc_id, k) > 1 AS gone FROM c),
g AS (SELECT doc_id, text, count(*) FILTER (WHERE gone) AS chunks_removed,
             CAST(coalesce(sum(n_lines) FILTER (WHERE gone), 0) AS BIGINT) AS lines_removed,
             coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS rest FROM f GROUP BY doc_id, text)
SELECT doc_id, chunks_removed, lines_removed, CAST(length(rest) AS BIGINT) AS n_chars_left, md5(rest) AS md5_left
FROM documents JOIN g USING (doc_id)
"""
