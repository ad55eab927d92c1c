"""Quality classifier by Bradley-Terry pairwise ranking.

Every labelled document that may be learned from is dealt into a block of about
``BLOCK`` documents, and all pairs of a block (a document labelled good is preferred
to one labelled bad) are preference pairs.  The rarer label's documents are dealt into
several blocks where one each would leave blocks with fewer than ``RARE`` of them, so
the cost is linear at any share.  The model is a linear score, fitted by logistic loss
on the feature differences of the pairs: Newton steps, each one aggregate of loss,
gradient and Hessian over the blocks.  The threshold is the quantile of all labelled
documents' scores above which the labels' share of good documents lies, and scores are
shifted so that this quantile becomes ``CUT``.

Features are measured over the whole text in one vectorised pass in Arrow UDFs:
shares of byte kinds and marks, word lengths, and repetition.  Language, source
and id are no features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from rekindle.llm import words as W
from rekindle.llm.common import small_batches, written
from rekindle.operators.metrics import score_prefix

#: Documents of a block, documents of the rarer label in it on average (at least), most steps and weight decay of the fit.
BLOCK = 512
RARE = 16
STEPS = 50
DECAY = 1e-3
CUT = 0.7

_MARKS = [ord(c) for c in "#*$%&|<>!?.,;:-_/\\'\"()[]{}=+@~^`"]
_KINDS = np.zeros((256, 5), bool)
_KINDS[65:91, 0] = True      # upper case
_KINDS[97:123, 1] = True     # lower case
_KINDS[48:58, 2] = True      # digits
_KINDS[128:, 3] = True       # beyond ASCII
_KINDS[:32, 4] = True        # controls and newlines
N_FEATURES = len(_MARKS) + _KINDS.shape[1] + 9


def _features(part: W.Part) -> np.ndarray:
    n = len(part.offs) - 1
    size = np.maximum(np.diff(part.offs), 1)
    doc, h = part.doc_of_word(), part.hashes()
    n_words = np.diff(part.woffs)
    words = np.maximum(n_words, 1)
    own = W.mix64(np.arange(1, n + 1, dtype=np.uint64))
    cols = []
    byte_of = np.repeat(np.arange(n), np.diff(part.offs))
    hist = np.bincount(byte_of * 256 + part.buf, minlength=n * 256).reshape(n, 256)
    cols += [np.sqrt(hist[:, m] / size) for m in _MARKS]
    cols += [np.sqrt(hist[:, _KINDS[:, k]].sum(1) / size) for k in range(_KINDS.shape[1])]
    # repetition: equal neighbours, words and 8-word windows found again in the text, lines found again
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    cols.append(np.sqrt(W.per_text(same, part.woffs) / words))
    key = np.sort(h ^ own[doc]) if len(h) else h
    order = np.argsort(h ^ own[doc], kind="stable")
    again = np.zeros(len(h), bool)
    again[order[1:]] = key[1:] == key[:-1]
    # over blocks of words a long text repeats more words; the rate is set against sqrt(words)
    cols.append(W.per_text(again, part.woffs) / words)
    cols.append(W.per_text(~again, part.woffs) / np.sqrt(words))
    at, g = W.windows(h, doc, 8)
    hit = np.zeros(len(h), bool)
    hit[at[W.repeated(g ^ own[doc[at]])]] = True
    cols.append(np.sqrt(W.per_text(hit, part.woffs) / words))
    ls, le, ld = part.lines()
    lk = W.span_hashes(part.buf, ls, le) ^ own[ld]
    cols.append(np.sqrt(np.bincount(ld[W.repeated(lk) & (le > ls)], minlength=n) / np.maximum(np.bincount(ld, minlength=n), 1)))
    length = np.diff(np.append(0, np.cumsum(part.ends - part.starts))[part.woffs]) / words
    cols += [np.log(length + 0.1), np.log1p(n_words), np.sqrt(1 / words), (n_words == 0).astype(float)]
    return np.stack(cols, 1)


def features(texts: pa.Array) -> np.ndarray:
    out = np.zeros((len(texts), N_FEATURES))
    for p in W.parts(texts):
        out[p.first:p.first + len(p.offs) - 1] = _features(p)
    return out


@arrow_udf(T.ArrayType(T.DoubleType()))
@W.trimmed
def feature_rows(texts: pa.Array) -> pa.Array:
    x = features(texts)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES), pa.array(x.ravel()))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    shift: float

    def linear(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.linear(x) - self.shift, -60, 60)))


def pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, loss, gradient and Hessian (flat) of all pairs of standardised rows at the weights ``w``."""
    ahead = (good @ w)[:, None] - (bad @ w)[None, :]
    p = 1 / (1 + np.exp(np.clip(ahead, -60, 60)))
    v = p * (1 - p)
    grad = p.sum(0) @ bad - p.sum(1) @ good
    cross = good.T @ (v @ bad)
    hess = (good * v.sum(1)[:, None]).T @ good + (bad * v.sum(0)[:, None]).T @ bad - cross - cross.T
    return np.concatenate([[p.size, np.logaddexp(0, -ahead).sum()], grad, hess.ravel()])


def newton(sums, d: int) -> np.ndarray:
    """Weights of least mean loss plus decay; ``sums(w)`` are the pairs' sums at ``w``.  A step that does not help is halved."""
    def at(w):
        x = sums(w)
        return (x[1] / x[0] + DECAY * w @ w, x[2:2 + d] / x[0] + 2 * DECAY * w,
                x[2 + d:].reshape(d, d) / x[0] + 2 * DECAY * np.eye(d))
    w = np.zeros(d)
    loss, grad, hess = at(w)
    for _ in range(STEPS):
        step = np.linalg.solve(hess, grad)
        new = at(w - step)
        while new[0] > loss + 1e-12 and np.abs(step).max() > 1e-9:
            step = step / 2
            new = at(w - step)
        w, (loss, grad, hess) = w - step, new
        if np.abs(step).max() < 1e-9:
            break
    return np.round(w, 9)  # sums are rounded by how the rows lie


def fit(x: np.ndarray, good: np.ndarray, share_good: float) -> Model:
    """Bradley-Terry weights from all pairs of the rows ``x``; ``share_good``: share of good labels in all of the labels."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    w = newton(lambda w: pair_sums(z[good], z[~good], w), z.shape[1])
    s = z @ w
    # quantile of the scores at the share of bad labels, each class weighted to its share
    order = np.argsort(s)
    weight = np.where(good, share_good / good.sum(), (1 - share_good) / (~good).sum())[order]
    s = s[order]
    k = min(int(np.searchsorted(np.cumsum(weight), 1 - share_good)), len(s) - 1)
    at = (s[k] + s[min(k + 1, len(s) - 1)]) / 2
    return Model(mean, scale, w, float(at - np.log(CUT / (1 - CUT))))


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def measured(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _hash (of the text) and _x (its features) of every row, computed once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return written(docs.select(F.col(id_col).alias("_id"), F.sha2(text.cast("binary"), 256).alias("_hash"),
                               feature_rows(text).alias("_x")), "ranking-features")


def _matrix(rows: pa.Array) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _summed(df: DataFrame, run) -> np.ndarray:
    """The sums over all partitions of the vectors that ``run`` makes of each partition's batches."""
    def part(batches):
        total = None
        for batch in batches:
            for v in run(batch):
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(total)), pa.int32()), "v": total})
    rows = df.mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()  # a row a sum
    out = np.zeros(len(rows))
    for r in rows:
        out[r["k"]] = r["v"]
    return out


def _moments(batch: pa.RecordBatch):
    x = _matrix(batch.column(0))
    yield np.concatenate([x.sum(0), (x * x).sum(0)])


def train(rows: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality",
          seed: int = 7) -> Model | None:
    """A model from every labelled document of ``rows`` (see :func:`measured`) that is not held out; None without both kinds.

    An id with several texts is learned from by the text with the least SHA-256, one
    with both labels as label 0.  The driver sees sums of (features + 1)^2 numbers a step.
    """
    lab = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_good"))
           .filter(F.col("_good").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id"))))
    n = {r["_good"]: r["n"] for r in lab.groupBy("_good").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(n) < 2:
        return None
    share = n[1] / (n[0] + n[1])
    known = written(rows.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.min_by("_x", "_hash").alias("_x"))
                    .join(lab.groupBy("_id").agg(F.min("_good").alias("_good")), "_id"), "ranking-labelled")
    found = {r["_good"]: r["n"] for r in known.groupBy("_good").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(found) < 2:
        return None
    total = found[0] + found[1]
    sums = _summed(known.select("_x"), _moments) / total
    mean = np.round(sums[:N_FEATURES], 12)
    scale = np.round(np.sqrt(np.maximum(sums[N_FEATURES:] - mean * mean, 0)), 9) + 1e-6
    z = lambda x: np.clip((x - mean) / scale, -8, 8)

    blocks = max(1, total // BLOCK)
    rare = min(found, key=found.get)
    copies = -(-RARE * blocks // found[rare]) if blocks > 1 else 1
    dealt = known.withColumn("_copy", F.explode(F.when(F.col("_good") == rare, F.sequence(F.lit(1), F.lit(copies)))
                                                .otherwise(F.array(F.lit(1)))))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "_id", "_copy"), F.lit(blocks)))
    side = lambda k: F.collect_list(F.when(F.col("_good") == k, F.struct("_id", "_x")))
    dealt = dealt.groupBy("block").agg(*[F.transform(F.array_sort(side(k)), lambda r: r["_x"]).alias(c)
                                         for k, c in ((1, "good"), (0, "bad"))])
    dealt = written(dealt.select("good", "bad"), "ranking-blocks")

    def pairs_at(w):
        def run(batch):
            for good, bad in zip(batch.column(0), batch.column(1), strict=True):
                if len(good) and len(bad):
                    yield pair_sums(z(_matrix(good.values)), z(_matrix(bad.values)), w)
        return _summed(dealt, run)
    model = Model(mean, scale, newton(pairs_at, N_FEATURES), 0.0)
    # quantile of the scores at the share of bad labels, each class weighted to its share
    scored = known.select(F.round(linear(model)("_x"), 12).alias("score"), F.col("_good").alias("label"))
    p = score_prefix(scored, by="")
    good = F.col("below_pos") + F.col("pos")
    upto = good * (share / found[1]) + (F.col("below_cnt") + F.col("cnt") - good) * ((1 - share) / found[0])
    s = [r["score"] for r in p.filter(upto >= 1 - share - 1e-12).orderBy("score").limit(2).collect()]
    at = sum(s) / len(s)
    return Model(mean, scale, model.weight, float(at - np.log(CUT / (1 - CUT))))


def linear(model: Model):
    """Arrow UDF: features -> the model's linear score, not shifted."""
    @arrow_udf(T.DoubleType())
    def run(rows: pa.Array) -> pa.Array:
        return pa.array(model.linear(_matrix(rows)))
    return run


def score(model: Model | None):
    """Arrow UDF: features -> score in [0, 1]; 0.5 without a model."""
    @arrow_udf(T.DoubleType())
    def run(rows: pa.Array) -> pa.Array:
        return pa.array(np.full(len(rows), 0.5) if model is None else model.score(_matrix(rows)))
    return run


def rank(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= CUT) for every row of ``docs``.

    Defined cases: NULL and empty texts are scored like a text without words;
    NULL ids are never held out and never learned from; labels other than 0 and
    1 are left out; without labels of both kinds every score is 0.5; rows
    repeated in full get one score; an empty table gives an empty result; other
    columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = measured(docs, id_col=id_col, text_col=text_col)
    model = train(rows, labels, id_col=id_col, **options)
    x = rows.select(F.col("_id").alias("doc_id"), held_out(F.col("_id")).alias("held_out"), score(model)(F.col("_x")).alias("score"))
    return x.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def op7_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return rank(docs, labels)
