"""Language identification by a bidirectional gated recurrent network over bytes.

Two small gated recurrent layers read a text's bytes forwards and backwards; every
byte position gets a distribution over the languages from both states, and a
document's distribution is the mean over all its positions.  The network is
trained in numpy by backpropagation through time on a bounded sample of documents.

Texts are read in windows of ``STEPS`` bytes (states start at zero in each), all
windows of a batch side by side, so that a step is a few vector operations.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from rekindle.llm import words as W
from rekindle.llm.common import small_batches, unit_hash

HIDDEN = 8
STEPS = 64
LANES = 4096
#: Training: documents per language, windows per document, batch, updates, learning rate.
SAMPLE_PER_LANGUAGE = 600
WINDOWS = 4
BATCH = 192
UPDATES = 260
RATE = 0.02


def _gates(a: np.ndarray, h: np.ndarray, u: np.ndarray, hidden: int) -> tuple[np.ndarray, ...]:
    """One step of a gated unit: a (3H, N) input terms, h (H, N) state, u (3H, H)."""
    uh = u @ h
    zr = np.tanh(0.5 * (a[:2 * hidden] + uh[:2 * hidden])) * 0.5 + 0.5
    z, r = zr[:hidden], zr[hidden:]
    c = np.tanh(a[2 * hidden:] + r * uh[2 * hidden:])
    return z, r, c, uh[2 * hidden:], h + z * (c - h)


@dataclass
class Network:
    langs: list[str]
    p: dict[str, np.ndarray] = field(repr=False)

    @staticmethod
    def fresh(langs: list[str], hidden: int, rng: np.random.Generator) -> Network:
        p = {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.3, (3 * hidden, 256))
            p[f"u{d}"] = rng.normal(0, 0.5 / np.sqrt(hidden), (3 * hidden, hidden))
        p["o"] = rng.normal(0, 0.3, (len(langs), 2 * hidden))
        p["b"] = np.zeros((len(langs), 1))
        return Network(langs, {k: v.astype(np.float32) for k, v in p.items()})

    @property
    def hidden(self) -> int:
        return self.p["uf"].shape[1]

    def states(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """(T, H, N) states of direction d over bytes x (T, N); ``keep`` gets each step's parts."""
        steps, n = x.shape
        h = np.zeros((self.hidden, n), np.float32)
        out = np.empty((steps, self.hidden, n), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            parts = _gates(np.take(self.p[f"x{d}"], x[t], axis=1), h, self.p[f"u{d}"], self.hidden)
            if keep is not None:
                keep.append((t, h, *parts[:4]))
            h = out[t] = parts[4]
        return out

    def positions(self, x: np.ndarray) -> np.ndarray:
        """(T, L, N): distribution over the languages at every byte position."""
        hf, hb = self.states(x, "f"), self.states(x, "b")
        o = self.p["o"]
        e = np.matmul(o[:, :self.hidden], hf) + np.matmul(o[:, self.hidden:], hb) + self.p["b"]
        np.exp(e - e.max(1, keepdims=True), out=e)
        e /= e.sum(1, keepdims=True)
        return e

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross-entropy over all positions; y: language of each window."""
        keep = {"f": [], "b": []}
        h = np.concatenate([self.states(x, d, keep[d]) for d in "fb"], 1)
        e = np.matmul(self.p["o"], h) + self.p["b"]
        e = np.exp(e - e.max(1, keepdims=True))
        e /= e.sum(1, keepdims=True)
        e[:, y, np.arange(x.shape[1])] -= 1
        e *= (mask / mask.sum())[:, None, :]
        g = {"o": np.einsum("tln,thn->lh", e, h), "b": e.sum((0, 2))[:, None]}
        dh_all = np.matmul(self.p["o"].T, e)
        hid = self.hidden
        for k, d in enumerate("fb"):
            dx, du = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"u{d}"])
            u, dh = self.p[f"u{d}"], np.zeros((hid, x.shape[1]), np.float32)
            for t, before, z, r, c, uc in reversed(keep[d]):
                dh = dh + dh_all[t, k * hid:(k + 1) * hid]
                dc = dh * z * (1 - c * c)
                dz = dh * (c - before) * z * (1 - z)
                dr = dc * uc * r * (1 - r)
                da = np.concatenate([dz, dr, dc])
                db = np.concatenate([dz, dr, dc * r])
                np.add.at(dx.T, x[t], da.T)
                du += db @ before.T
                dh = dh * (1 - z) + u.T @ db
            g[f"x{d}"], g[f"u{d}"] = dx, du
        return g


def _windows(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes (T, N), valid (T, N), text of each window) of whole texts, zero-padded."""
    count = -(-np.diff(offs) // STEPS)
    doc = np.repeat(np.arange(len(offs) - 1), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    at = offs[doc] + k * STEPS
    idx = at[None, :] + np.arange(STEPS)[:, None]
    valid = idx < offs[doc + 1][None, :]
    return np.where(valid, buf[np.minimum(idx, max(len(buf) - 1, 0))], 0) if len(buf) else idx, valid, doc


def pooled(net: Network, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text: mean distribution over its positions (n, L), and positions labelled with each language (n, L)."""
    n, n_lang = len(texts), len(net.langs)
    prob, labelled = np.zeros((n, n_lang)), np.zeros((n, n_lang), np.int64)
    for part in W.parts(texts):
        x, valid, doc = _windows(part.buf, part.offs)
        doc = doc + part.first
        for a in range(0, len(doc), LANES):
            lane = slice(a, a + LANES)
            p, ok = net.positions(x[:, lane]), valid[:, lane]
            first = p.argmax(1)
            for k in range(n_lang):
                prob[:, k] += np.bincount(doc[lane], (p[:, k] * ok).sum(0), n)
                labelled[:, k] += np.bincount(doc[lane], ((first == k) & ok).sum(0), n).astype(np.int64)
    total = prob.sum(1, keepdims=True)
    return prob / np.where(total > 0, total, 1), labelled


def label_spans(net: Network, text: str) -> list[tuple[int, int, str]]:
    """Runs of byte positions with one language: (start, end, language)."""
    buf = np.frombuffer(text.encode(), np.uint8)
    x, valid, _ = _windows(buf, np.array([0, len(buf)]))
    if not len(buf):
        return []
    best = net.positions(x).argmax(1).T[valid.T]
    cut = np.append(0, np.flatnonzero(best[1:] != best[:-1]) + 1)
    return [(int(a), int(b), net.langs[best[a]]) for a, b in zip(cut, np.append(cut[1:], len(best)), strict=True)]


def fit(texts: list[str], langs: list[str], hidden: int = HIDDEN, updates: int = UPDATES, seed: int = 10) -> Network:
    """Train on (text, language) rows; windows are drawn at random places of the texts."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    net = Network.fresh(names, hidden, rng)
    xs, ys, ms = [], [], []
    for text, lang in zip(texts, langs, strict=True):
        b = np.frombuffer(text.encode(), np.uint8)
        for _ in range(WINDOWS if len(b) > STEPS else 1):
            a = int(rng.integers(0, max(1, len(b) - STEPS + 1)))
            w = b[a:a + STEPS]
            xs.append(np.pad(w, (0, STEPS - len(w))))
            ms.append(np.arange(STEPS) < len(w))
            ys.append(names.index(lang))
    x, y, m = np.stack(xs, 1), np.array(ys), np.stack(ms, 1)
    by = [np.flatnonzero(y == k) for k in range(len(names))]
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, updates + 1):
        pick = np.concatenate([rng.choice(k, max(1, BATCH // len(by))) for k in by])
        g = net.gradients(x[:, pick], y[pick], m[:, pick].astype(np.float32))
        rate = RATE * (1 - 0.9 * step / updates)
        for k, v in g.items():
            mean[k] = 0.9 * mean[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v * v
            net.p[k] = (net.p[k] - rate * (mean[k] / (1 - 0.9 ** step))
                        / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 10) -> Network | None:
    """A network from about ``per_language`` documents of each language, of which each gives ``WINDOWS`` windows.

    Rows are taken by seeded hash at the rate that gives ``per_language``; of a
    text the sample holds ``WINDOWS`` stretches of 4 * STEPS characters at random
    places, so what reaches the driver is bounded by the number of languages.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    d = d.filter(F.col("lang").isNotNull() & (F.length("text") > 0) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    n = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not n:
        return None
    rate = F.coalesce(*[F.when(F.col("lang") == k, F.lit(per_language / v)) for k, v in n.items()])
    size = 4 * STEPS
    place = lambda j: (unit_hash(F.col("id"), seed=seed + 1 + j)
                       * F.greatest(F.length("text") - size + 1, F.lit(1))).cast("int") + 1
    stretches = F.when(F.length("text") <= size, F.array("text")).otherwise(
        F.array(*[F.substring(F.col("text"), place(j), F.lit(size)) for j in range(WINDOWS)]))
    rows = (d.filter(unit_hash(F.col("id"), seed=seed) < rate)
            .select("id", "lang", F.explode(stretches).alias("text")).toPandas()
            .sort_values(["id", "lang", "text"]))
    if not len(rows):
        return None
    return fit(list(rows["text"]), list(rows["lang"]), seed=seed)


_KIND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                      T.StructField("positions", T.ArrayType(T.LongType()))])


def predict(net: Network | None):
    """Arrow UDF: text -> (language, pooled probability, positions labelled with each language)."""
    @arrow_udf(_KIND)
    @W.trimmed
    def run(texts: pa.Array) -> pa.Array:
        if net is None:
            names, best, labelled = ["und"] * len(texts), np.zeros(len(texts)), np.zeros((len(texts), 0), np.int64)
        else:
            prob, labelled = pooled(net, texts)
            names = [net.langs[k] for k in prob.argmax(1)]
            best = prob.max(1)
        width = labelled.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(labelled) + 1, dtype=np.int32) * width),
                                         pa.array(labelled.ravel(), pa.int64()))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(best, pa.float64()), lists],
                                          ["lang_pred", "score", "positions"])
    return run


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, positions for every row of ``docs``.

    score: mean probability of the predicted language over all byte positions;
    positions: bytes labelled with each learned language, in code-point order.

    Defined cases: a text that is NULL or has no letter is ``und`` with score 0;
    without a training row all are ``und``; ties go to the first language; NULL
    ids are never held out and never learned from; rows repeated in full get one
    answer; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    net = train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    text = F.col(text_col)
    read = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    x = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), read.alias("read"),
                    predict(net)(text).alias("p"))
    return x.select("doc_id", "held_out", F.when(F.col("read"), F.col("p.lang_pred")).otherwise("und").alias("lang_pred"),
                    F.when(F.col("read"), F.col("p.score")).otherwise(0.0).alias("score"), "p.positions")


def op10_query(docs: DataFrame) -> DataFrame:
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
