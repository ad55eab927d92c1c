"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document is measured in one vectorised pass over its whole text.  For every
(language, source) the measures of the documents that pass the fixed base rules
go into quantile sketches: counts of logarithmic buckets with relative error
``ACCURACY`` (two sketches merge by adding their counts; a sketch has at most
some 900 buckets however many documents it saw).  The same sketches merged by
language, and over all, serve groups with fewer than ``min_group`` documents.
Fences ``q25 - reach * (q75 - q25) - slack`` and ``q75 + reach * (q75 - q25) +
slack`` come from the sketch, and documents are filtered by a join with the
table of fences (one row per language and source).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from rekindle.llm import words as W
from rekindle.llm.common import null_safe, small_batches, spare_names, written

ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
FLOOR = 1e-3
WINDOW = 8
MIN_GROUP = 50
REACH = 3.0
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter")


@dataclass(frozen=True)
class Rule:
    """A measure with the slack of its fences; a None slack leaves that side open."""
    name: str
    over: str
    under: str
    slack_low: float | None
    slack_high: float | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 1.5, 1.5),
    Rule("symbols", "n_symbols", "n_words", None, 0.2),
    Rule("dup_lines", "n_dup_lines", "n_lines", None, 0.6),
    Rule("stutter", "n_stutter", "n_words", None, 0.25),
)


@arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
@W.trimmed
def measures(texts: pa.Array) -> pa.Array:
    found = {c: np.zeros(len(texts), np.int64) for c in COUNTS}
    for p in W.parts(texts):
        n = len(p.offs) - 1
        here = slice(p.first, p.first + n)
        doc, h = p.doc_of_word(), p.hashes()
        found["n_words"][here] = np.diff(p.woffs)
        found["word_chars"][here] = W.per_text(((p.buf & 0xC0) != 0x80) & ~W.SPACE[p.buf], p.offs)
        found["n_symbols"][here] = W.per_text(_SYMBOL[p.buf], p.offs)
        own = W.mix64(np.arange(1, n + 1, dtype=np.uint64))
        at, g = W.windows(h, doc, WINDOW)
        at = at[W.repeated(g ^ own[doc[at]])]
        cover = np.zeros(len(h) + 1, np.int64)
        cover[at] += 1  # starts are distinct, and so are ends
        cover[at + WINDOW] -= 1
        found["n_repeat_words"][here] = W.per_text(np.cumsum(cover[:-1]) > 0, p.woffs)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        found["n_stutter"][here] = W.per_text(same, p.woffs)
        ls, le, ld = p.lines()
        full = np.searchsorted(p.starts, le) > np.searchsorted(p.starts, ls)
        ls, le, ld = ls[full], le[full], ld[full]
        found["n_lines"][here] = np.bincount(ld, minlength=n)
        key = W.span_hashes(p.buf, ls, le) ^ own[ld]
        order = np.argsort(key)
        again = order[1:][key[order][1:] == key[order][:-1]]
        found["n_dup_lines"][here] = np.bincount(ld[again], minlength=n)
    return pa.StructArray.from_arrays([pa.array(found[c]) for c in COUNTS], list(COUNTS))


def base_failed(m: str) -> Column:
    n = F.col(f"{m}.n_words")
    return (n < 20) | (100 * F.col(f"{m}.n_repeat_words") > 30 * n)


def rate(rule: Rule, m: str) -> Column:
    return F.col(f"{m}.{rule.over}") / F.greatest(F.col(f"{m}.{rule.under}"), F.lit(1))


def bucket_of(value: Column) -> Column:
    return F.when(value < FLOOR, 0).otherwise(
        F.greatest(F.ceil(F.log(value / FLOOR) / F.log(F.lit(GAMMA))), F.lit(1))).cast("int")


def value_of(bucket: Column) -> Column:
    return F.when(bucket == 0, 0.0).otherwise(F.lit(2 * FLOOR / (1 + GAMMA)) * F.pow(F.lit(GAMMA), bucket))


def sketch(measured: DataFrame, m: str, lang_col: str, source_col: str, rules=RULES) -> DataFrame:
    """(lang, source, rule, bucket, n): the quantile sketches, pre-aggregated map-side."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), bucket_of(rate(r, m)).alias("bucket"))
                               for k, r in enumerate(rules)]))
    return (measured.filter(~base_failed(m))
            .select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), each.alias("x"))
            .groupBy("lang", "source", "x.rule", "x.bucket").agg(F.count("*").alias("n")))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, rule, n_docs, q25, q75) of merged sketches; a window sees one sketch's buckets."""
    w = Window.partitionBy(*by, "rule")
    s = (sketches.withColumn("n_docs", F.sum("n").over(w))
         .withColumn("upto", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))))
    at = lambda q: value_of(F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("n_docs") - 1)),
                                         F.col("bucket"))))
    return s.groupBy(*by, "rule").agg(F.first("n_docs").alias("n_docs"), at(0.25).alias("q25"), at(0.75).alias("q75"))


def fences(sketches: DataFrame, rules=RULES, min_group: int = MIN_GROUP, reach: float = REACH) -> DataFrame:
    """(lang, source, low, high): arrays over the rules; one row per language and source of the sketches."""
    fine, by_lang = quartiles(sketches, ["lang", "source"]), quartiles(merged(sketches, ["lang"]), ["lang"])
    overall = quartiles(merged(sketches, []), [])
    x = null_safe(fine, by_lang.select("lang", "rule", *[F.col(c).alias(f"l_{c}") for c in ("n_docs", "q25", "q75")]),
                  ["lang", "rule"])
    x = x.join(overall.select("rule", F.col("q25").alias("a_q25"), F.col("q75").alias("a_q75")), "rule")
    pick = lambda q: (F.when(F.col("n_docs") >= min_group, F.col(q))
                      .when(F.col("l_n_docs") >= min_group, F.col(f"l_{q}")).otherwise(F.col(f"a_{q}")))
    lows = F.element_at(F.array(*[F.lit(r.slack_low).cast("double") for r in rules]), F.col("rule") + 1)
    highs = F.element_at(F.array(*[F.lit(r.slack_high).cast("double") for r in rules]), F.col("rule") + 1)
    spread = reach * (pick("q75") - pick("q25"))
    x = x.select("lang", "source", "rule", (pick("q25") - spread - lows).alias("low"),
                 (pick("q75") + spread + highs).alias("high"))
    per_rule = lambda side: F.map_from_entries(F.collect_list(F.struct("rule", side)))  # noqa: E731  one entry a rule
    return x.groupBy("lang", "source").agg(per_rule("low").alias("low"), per_rule("high").alias("high"))


def judge(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          rules=RULES, min_group: int = MIN_GROUP, keep_columns: list[str] | None = None,
          out_col: str = "_quality") -> DataFrame:
    """The columns ``keep_columns`` (all by default) of every row, with ``out_col``: counts, base_failed, kept.

    Defined cases: NULL or empty text has no words, so it fails the base rules;
    NULL languages and NULL sources are groups of their own; a group without a
    document that passes the base rules has none to judge; rows repeated in full
    are judged alike; an empty table gives an empty result.  A column named
    ``out_col`` in the input is replaced.

    The text is measured once for the sketches, and once more for the verdicts
    where columns other than ids are kept (nothing but narrow measures is stored).
    """
    keep = [c for c in (keep_columns or docs.columns) if c != out_col]
    narrow = text_col not in keep
    small_batches(docs.sparkSession)
    src = docs.select(*dict.fromkeys([*keep, lang_col, source_col, text_col]))
    measured = src.withColumn(out_col, measures(F.col(text_col)))
    if narrow:
        measured = written(measured.select(*dict.fromkeys([*keep, lang_col, source_col]), out_col), "quality")
    bounds = written(fences(written(sketch(measured, out_col, lang_col, source_col, rules), "sketches"),
                            rules, min_group), "fences")
    b_lang, b_source, low, high = spare_names(measured, "_b_lang", "_b_source", "_b_low", "_b_high")
    b = bounds.toDF(b_lang, b_source, low, high)
    x = measured.join(b, measured[lang_col].eqNullSafe(F.col(b_lang))
                      & measured[source_col].eqNullSafe(F.col(b_source)), "left")
    verdict = ~base_failed(out_col)
    for k, r in enumerate(rules):
        if r.slack_low is not None:
            verdict = verdict & (rate(r, out_col) >= F.col(low)[k])
        if r.slack_high is not None:
            verdict = verdict & (rate(r, out_col) <= F.col(high)[k])
    out = x.withColumn(out_col, F.struct(f"{out_col}.*", base_failed(out_col).alias("base_failed"),
                                            F.coalesce(verdict, F.lit(False)).alias("kept")))
    return out.select(*keep, out_col)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns unchanged."""
    [mark] = spare_names(docs, "_quality")
    return judge(docs, out_col=mark, **options).filter(F.col(f"{mark}.kept")).select(*docs.columns)


def op4_query(docs: DataFrame) -> DataFrame:
    return judge(docs, keep_columns=["doc_id"]).select(
        "doc_id", *[f"_quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                              "base_failed", "kept")])


def _oracle() -> str:
    word = r"[^\x20\x09-\x0D]+"
    rates = " UNION ALL ".join(
        f"SELECT id, lang, source, {k} AS rule, CAST({r.over} AS DOUBLE) / greatest({r.under}, 1) AS v FROM b WHERE NOT base_failed"
        for k, r in enumerate(RULES))
    low = " ".join(f"WHEN {k} THEN {'NULL' if r.slack_low is None else r.slack_low}" for k, r in enumerate(RULES))
    high = " ".join(f"WHEN {k} THEN {'NULL' if r.slack_high is None else r.slack_high}" for k, r in enumerate(RULES))

    def quart(name, by):
        sel = "".join(f"{c}, " for c in by)
        return f"""{name} AS (
  SELECT {sel}rule, count(*) AS n_docs,
         list_sort(list(bucket))[1 + CAST(floor(0.25 * (count(*) - 1)) AS BIGINT)] AS i25,
         list_sort(list(bucket))[1 + CAST(floor(0.75 * (count(*) - 1)) AS BIGINT)] AS i75
  FROM k GROUP BY {sel}rule)"""

    def val(i):
        return f"CASE WHEN {i} = 0 THEN 0.0 ELSE {2 * FLOOR / (1 + GAMMA)!r}::DOUBLE * pow({GAMMA!r}::DOUBLE, {i}) END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
t AS (SELECT id, regexp_extract_all(text, '{word}') AS ws FROM d),
w AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t),
g AS (SELECT id, i, lag(w) OVER o AS prev, w,
        CASE WHEN lead(w, {WINDOW - 1}) OVER o IS NOT NULL
             THEN hash([{', '.join(f'lead(w, {j}) OVER o' for j in range(WINDOW))}]) END AS h
      FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
r AS (SELECT *, CASE WHEN h IS NOT NULL AND count(*) OVER (PARTITION BY id, h) > 1 THEN 1 ELSE 0 END AS rep FROM g),
c AS (SELECT *, max(rep) OVER (PARTITION BY id ORDER BY i ROWS {WINDOW - 1} PRECEDING) AS covered FROM r),
wc AS (SELECT id, count(*) AS n_words, sum(length(w)) AS word_chars, sum(covered) AS n_repeat_words,
              count(*) FILTER (WHERE w = prev) AS n_stutter FROM c GROUP BY id),
l AS (SELECT id, unnest(string_split(text, chr(10))) AS line FROM d),
lc AS (SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM l WHERE regexp_matches(line, '{word}') GROUP BY id),
b AS (SELECT d.id, doc_id, lang, source, coalesce(n_words, 0) AS n_words,
             CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_stutter, 0) AS n_stutter,
             coalesce(n_words, 0) < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * coalesce(n_words, 0) AS base_failed
      FROM d LEFT JOIN wc ON d.id = wc.id LEFT JOIN lc ON d.id = lc.id),
v AS ({rates}),
k AS (SELECT *, CASE WHEN v < {FLOOR} THEN 0
                     ELSE greatest(CAST(ceil(ln(v / {FLOOR}) / ln({GAMMA!r}::DOUBLE)) AS INTEGER), 1) END AS bucket FROM v),
{quart('q2', ['lang', 'source'])},
{quart('q1', ['lang'])},
{quart('q0', [])},
p AS (SELECT q2.lang, q2.source, q2.rule,
        CASE WHEN q2.n_docs >= {MIN_GROUP} THEN q2.i25 WHEN q1.n_docs >= {MIN_GROUP} THEN q1.i25 ELSE q0.i25 END AS i25,
        CASE WHEN q2.n_docs >= {MIN_GROUP} THEN q2.i75 WHEN q1.n_docs >= {MIN_GROUP} THEN q1.i75 ELSE q0.i75 END AS i75
      FROM q2 JOIN q1 ON q2.lang IS NOT DISTINCT FROM q1.lang AND q2.rule = q1.rule JOIN q0 ON q0.rule = q2.rule),
f AS (SELECT lang, source, rule,
        {val('i25')} - {REACH} * ({val('i75')} - {val('i25')}) - CASE rule {low} END AS low,
        {val('i75')} + {REACH} * ({val('i75')} - {val('i25')}) + CASE rule {high} END AS high FROM p),
bad AS (SELECT DISTINCT v.id FROM v JOIN f ON v.rule = f.rule AND v.lang IS NOT DISTINCT FROM f.lang
          AND v.source IS NOT DISTINCT FROM f.source WHERE v.v < f.low OR v.v > f.high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.id IS NULL AS kept
FROM b LEFT JOIN bad ON b.id = bad.id
"""


ORACLE = _oracle()
