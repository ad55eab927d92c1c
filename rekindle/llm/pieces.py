"""SentencePiece encoding by Gumbel top-k without replacement, and decoding.

The lattice of a text has an edge for every vocabulary piece that matches at a
place (and byte edges where a character is no piece); a path is a segmentation,
with probability in proportion to the product of its pieces' weights.  ``k``
distinct segmentations are drawn without replacement by perturbed A* search:
the root holds a Gumbel value for the set of all paths; a set is popped by its
value, its best path is read off the lattice (backward sums are the exact
heuristic), and what remains of the set is split into disjoint sets whose values
are truncated Gumbels below the popped one.  The k largest values are exactly a
sample of size k without replacement, in order.

No piece crosses the start of a word, so the lattice is a chain of words and a
set is "the first j words as on the popped path, word j + 1 otherwise, the rest
free": all sets that a popped path leaves behind are made at once, by vectors
over the words of a batch, and only the word at which a path leaves its parent
is walked by itself.

Every text is read whole.  All random numbers are hashes of seed and row key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from rekindle.llm import words as W
from rekindle.llm.common import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
#: Bytes of text whose words share a lattice.
PART = 1 << 20
#: Bytes after which a run without a blank is cut, so that a lattice stays small.
LONG = 4096
_NONE = -np.inf
_64 = 2**64 - 1


@dataclass
class Vocabulary:
    """Pieces as bytes (the word mark is a blank), a trie as a table of children by byte (57 MB here), and weights."""
    data: np.ndarray
    offs: np.ndarray
    child: np.ndarray
    piece: np.ndarray
    logw: np.ndarray
    byte_id: np.ndarray
    is_byte: np.ndarray

    @staticmethod
    def read(path: str, sharpness: float) -> Vocabulary:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        byte_id, texts = np.zeros(256, np.int64), []
        logw = np.zeros(n)
        trie: dict[tuple[int, int], int] = {}
        piece = [-1]
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[3:5], 16)
                byte_id[b] = i
                texts.append(bytes([b]))
                logw[i] = -sharpness * np.log(2.0 * n)
                continue
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                texts.append(b"")
                continue
            text = sp.id_to_piece(i).encode().replace(MARK, b" ")
            texts.append(text)
            # merges are scored by minus their rank; ranks are Zipf-distributed in frequency
            logw[i] = -sharpness * np.log(100.0 + min(max(-sp.get_score(i), 0.0), float(n)))
            node = 0
            for b in text:
                node = trie.setdefault((node, b), len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = i
        child = np.full((len(piece), 256), -1, np.int32)
        at = np.array(list(trie), np.int64).reshape(-1, 2)
        child[at[:, 0], at[:, 1]] = list(trie.values())
        is_byte = np.zeros(n, bool)
        is_byte[byte_id] = True
        return Vocabulary(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), child,
                          np.array(piece), logw, byte_id, is_byte)


_VOCABULARY: dict[tuple[str, float], Vocabulary] = {}


def vocabulary(path: str, sharpness: float) -> Vocabulary:
    if (path, sharpness) not in _VOCABULARY:
        _VOCABULARY[path, sharpness] = Vocabulary.read(path, sharpness)
    return _VOCABULARY[path, sharpness]


def uniform(key: np.ndarray, *salts) -> np.ndarray:
    """Uniform in (0, 1) from hashes of keys and salts."""
    x = key
    for s in salts:
        x = W.mix64(x + np.asarray(s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


@dataclass
class Lattice:
    """Edges of all distinct words of a part, CSR by start position; ``up`` cumulates probabilities at a position."""
    first: np.ndarray   # start position of each word
    last: np.ndarray    # end position of each word
    eoff: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    logp: np.ndarray
    up: np.ndarray

    @staticmethod
    def build(buf: np.ndarray, offs: np.ndarray, v: Vocabulary) -> Lattice:
        n = len(buf)
        size = np.diff(offs)
        # a stop byte behind every word (no UTF-8 byte, so the trie has no edge for it) ends all walks in it
        closed = np.full(n + len(size), 255, np.uint8)
        at = np.arange(n)
        closed[at + np.repeat(np.arange(len(size)), size)] = buf
        shift = np.repeat(np.arange(len(size)), size)
        lead = (buf & 0xC0) != 0x80
        width = np.where(buf < 0x80, 1, np.where(buf >= 0xF0, 4, np.where(buf >= 0xE0, 3, 2)))
        child = v.child.ravel()
        pos = np.flatnonzero(lead)  # pieces are whole characters
        place = pos + shift[pos]
        node = child.take(closed.take(place))
        starts, ends, ids = [], [], []
        known = np.zeros(n, bool)
        depth = 0
        while True:
            on = np.flatnonzero(node >= 0)
            if not len(on):
                break
            pos, place, node = pos.take(on), place.take(on), node.take(on).astype(np.int64)
            depth += 1
            pid = v.piece.take(node)
            hit = np.flatnonzero(pid >= 0)
            s = pos.take(hit)
            starts.append(s)
            ends.append(s + depth)
            ids.append(pid.take(hit))
            if depth <= 4:
                known[s[width.take(s) == depth]] = True
            place = place + 1
            node = child.take(node * 256 + closed.take(place))
        word_end = np.repeat(offs[1:], size)
        # characters that are no piece go byte by byte
        char = np.maximum.accumulate(np.where(lead, at, 0))
        loose = np.flatnonzero(~known[char])
        found = [*zip(starts, ends, ids, strict=True), (loose, loose + 1, v.byte_id[buf[loose]])]
        eoff = np.append(0, np.cumsum(sum(np.bincount(f[0], minlength=n) for f in found)))
        fill = eoff[:-1].copy()
        starts, ends, ids = (np.empty(int(eoff[-1]), np.int64) for _ in range(3))
        for s, e, i in found:  # a depth has a start once at most
            to = fill[s]
            starts[to], ends[to], ids[to] = s, e, i
            fill[s] += 1
        del found
        is_end = ends == word_end[starts]  # a word's end is also the start of the next word, so it is looked up as 0
        left = word_end[starts] - starts
        longest = int(left.max()) if len(left) else 0
        left = left.astype(np.uint16) if longest < 1 << 16 else left
        by_left = np.argsort(left, kind="stable")
        cut = np.searchsorted(left[by_left], np.arange(1, longest + 2))
        del left, word_end
        beta = np.full(n + 1, _NONE)
        raw = v.logw[ids]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if a == b:
                continue
            e = by_left[a:b]
            s = starts[e]
            value = raw[e] + np.where(is_end[e], 0.0, beta[ends[e]])
            new = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            top = np.maximum.reduceat(value, new)
            run = np.diff(np.append(new, len(s)))
            beta[s[new]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, run)), new))
            raw[e] = value
        del by_left, is_end
        logp = raw
        logp -= beta[starts]
        up = np.exp(logp)
        np.cumsum(up, out=up)
        up -= np.append(0.0, up)[eoff[:-1]][starts]
        return Lattice(offs[:-1], offs[1:], eoff, ends, ids, logp, up)

    def draw(self, word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One path for each of ``word`` (numbers of distinct words): (pieces, CSR offsets, log probability)."""
        n = len(word)
        pos, stop = self.first[word].copy(), self.last[word]
        logp, step = np.zeros(n), 0
        live = np.arange(n)
        got_e, got_w = [], []
        while len(live):
            p = pos[live]
            u = uniform(key[live], step)
            e = self.eoff[p]
            most = self.eoff[p + 1] - 1
            while True:  # a position has few edges
                on = (self.up[e] < u) & (e < most)
                if not on.any():
                    break
                e = e + on
            got_e.append(e)
            got_w.append(live)
            logp[live] += self.logp[e]
            to = self.end[e]
            pos[live] = to
            live = live[to < stop[live]]
            step += 1
        if not got_e:
            return np.zeros(0, np.int64), np.zeros(1, np.int64), logp
        e, w = np.concatenate(got_e), np.concatenate(got_w)
        count = np.bincount(w, minlength=n)
        offs = np.append(0, np.cumsum(count))
        out = np.empty(len(e), np.int64)
        done = np.zeros(n, np.int64)
        for ge, gw in zip(got_e, got_w, strict=True):
            out[offs[gw] + done[gw]] = ge
            done[gw] += 1
        return out, offs, logp

    def draw_other(self, word: int, not_these: list[list[int]], rnd: Callable[[], float]) -> tuple[list[int], float]:
        """A path (edges) of one word that is none of the excluded ones, by the restricted distribution."""
        pos, stop, path, logp = int(self.first[word]), int(self.last[word]), [], 0.0
        inside = [list(x) for x in not_these]  # excluded paths that go through here, from here on
        while pos < stop:
            e0, e1 = int(self.eoff[pos]), int(self.eoff[pos + 1])
            edges, mass = range(e0, e1), np.exp(self.logp[e0:e1]).tolist()
            for rest in inside:
                if rest:  # exp(0) where the excluded path ends
                    after = float(np.exp(self.logp[rest[1:]].sum())) if len(rest) > 1 else 1.0
                    mass[rest[0] - e0] -= float(np.exp(self.logp[rest[0]])) * after
            mass = [max(m, 0.0) for m in mass]
            u, k, total = rnd() * sum(mass), 0, 0.0
            for k, m in enumerate(mass):
                total += m
                if u < total and m > 0:
                    break
            else:
                k = int(np.argmax(mass))
            e = edges[k]
            inside = [rest[1:] for rest in inside if rest and rest[0] == e]
            path.append(e)
            logp += float(self.logp[e])
            pos = int(self.end[e])
        return path, logp


def split_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of words (runs of blanks with what follows them; newlines alone; at most about LONG
    bytes, longer runs are cut between characters) and CSR offsets by text."""
    n = len(buf)
    blank, newline = buf == 32, buf == 10
    start = np.zeros(n, bool)
    start[offs[:-1][np.diff(offs) > 0]] = True
    start[1:] |= blank[1:] & ~blank[:-1]
    start |= newline
    start[1:] |= newline[:-1]
    s = np.flatnonzero(start)
    for k in np.flatnonzero(np.diff(np.append(s, n)) > LONG):  # rare: no blank for LONG bytes
        end = s[k + 1] if k + 1 < len(s) else n
        cut = np.arange(s[k] + LONG, end, LONG)
        for _ in range(3):  # back to a character's first byte
            cut -= (buf[cut] & 0xC0) == 0x80
        start[cut] = True
    s = np.flatnonzero(start)
    return s, np.searchsorted(s, offs)


def _truncated(loc: np.ndarray, below: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel(loc) values given that they are under ``below``; -inf where loc is -inf."""
    ok = np.isfinite(loc)
    out = np.full(len(loc), _NONE)
    out[ok] = loc[ok] - np.log(np.exp(np.minimum(loc[ok] - below[ok], 700.0)) - np.log(u[ok]))
    return out


def _rest(logp: np.ndarray) -> np.ndarray:
    """log(1 - exp(logp)), -inf for certain words."""
    with np.errstate(divide="ignore"):
        gap = -np.expm1(np.minimum(logp, 0.0))
        return np.where(gap > 1e-13, np.log(gap), _NONE)


def sample_part(buf: np.ndarray, offs: np.ndarray, keys: np.ndarray, k: int, v: Vocabulary
                ) -> list[list[tuple[np.ndarray, float, float]]]:
    """For every text: up to k (piece ids, log probability, log inclusion score), in the order of their values.

    The inclusion score is the probability 1 - exp(-exp(logp - kappa)) that the
    path's value exceeds kappa, the largest value left; given as its logarithm.
    """
    n = len(offs) - 1
    start, toff = split_words(buf, offs)
    stop = np.append(start[1:], len(buf))
    h = W.span_hashes(buf, start, stop) if len(start) else np.zeros(0, np.uint64)
    _, sample, word = np.unique(h, return_index=True, return_inverse=True)
    size = (stop - start)[sample]
    woff = np.append(0, np.cumsum(size))
    take = np.repeat(start[sample] - woff[:-1], size) + np.arange(int(woff[-1]))
    lat = Lattice.build(buf[take], woff, v)
    text = np.repeat(np.arange(n), np.diff(toff))
    place = np.arange(len(start)) - toff[text]
    token_key = W.mix64(keys[text] + place.astype(np.uint64))

    edges, eoffs, logp = lat.draw(word, token_key)
    pool = [edges]
    begin, count = eoffs[:-1].copy(), np.diff(eoffs)
    value = -np.log(-np.log(uniform(keys, 1)))  # the root's Gumbel: all paths together have probability 1

    def left_behind(logp, from_place, value_of_text, salt):
        """Values of the sets that leave the path at each word from ``from_place`` on."""
        total = np.append(0.0, np.cumsum(logp))
        before = total[:-1] - total[toff[:-1]][text]
        loc = np.where(place >= from_place[text], before + _rest(logp), _NONE)
        return _truncated(loc, value_of_text[text], uniform(token_key, salt, 2))

    paths = [(begin, count, logp)]
    sets = [left_behind(logp, np.zeros(n, np.int64), value, 0)]
    excluded: list[dict[int, list[list[int]]]] = [{}]
    found = [[] for _ in range(n)]

    def per_text(g):
        """Largest value of each text and where it is."""
        best, where = np.full(n, _NONE), np.zeros(n, np.int64)
        full = np.flatnonzero(np.diff(toff) > 0)
        if len(full):
            best[full] = np.maximum.reduceat(g, toff[:-1][full])
            hit = np.flatnonzero(g == best[text])
            where[text[hit][::-1]] = hit[::-1]
        return best, where

    total = np.add.reduceat(np.append(logp, 0.0), np.minimum(toff[:-1], len(logp))) * (np.diff(toff) > 0)
    whole = [(np.arange(n) if k > 0 else np.arange(0), 0, total)]
    for r in range(1, k + 1):
        best, where, owner = np.full(n, _NONE), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for q, g in enumerate(sets):
            b, w = per_text(g)
            up = b > best
            best, where, owner = np.where(up, b, best), np.where(up, w, where), np.where(up, q, owner)
        if r == k:
            break
        texts = np.flatnonzero(np.isfinite(best))
        if not len(texts):
            break
        # the parent's words before the place, another path of the word there, fresh paths after it
        of = owner[text]
        begin, count, logp = (np.choose(of, [p[j] for p in paths]) for j in range(3))
        at_place = np.full(n, 1 << 60)
        at_place[texts] = where[texts] - toff[texts]
        fresh = np.flatnonzero(place > at_place[text])
        e, eo, lp = lat.draw(word[fresh], W.mix64(token_key[fresh] + np.uint64(r * 7919)))
        base = sum(map(len, pool))
        pool.append(e)
        begin[fresh], count[fresh], logp[fresh] = base + eo[:-1], np.diff(eo), lp
        base += len(e)
        flat = np.concatenate(pool) if len(pool) > 1 else pool[0]
        pool = [flat]
        more, new_excluded, rest_here = [], {}, np.full(n, _NONE)
        for d in texts:
            t = int(where[d])
            q = int(owner[d])
            b0, c0 = int(paths[q][0][t]), int(paths[q][1][t])
            gone = [*excluded[q].get(t, []), flat[b0:b0 + c0].tolist()]
            seed = [int(token_key[t]) ^ (r << 32)]

            def rnd(seed=seed):
                seed[0] = (seed[0] + 0x9E3779B97F4A7C15) & _64
                x = ((seed[0] ^ (seed[0] >> 30)) * 0xBF58476D1CE4E5B9) & _64
                x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _64
                return (x ^ (x >> 31)) / float(1 << 64)
            path, lp1 = lat.draw_other(int(word[t]), gone, rnd)
            begin[t], count[t], logp[t] = base, len(path), lp1
            base += len(path)
            more += path
            new_excluded[t] = gone
            out_mass = 1.0 - sum(float(np.exp(lat.logp[x].sum())) for x in [*gone, path])
            rest_here[d] = np.log(out_mass) if out_mass > 1e-13 else _NONE
            sets[q][t] = _NONE
        pool.append(np.array(more, np.int64))
        g = left_behind(logp, at_place + 1, best, r)
        total = np.append(0.0, np.cumsum(logp))
        before = total[where] - total[toff[:-1]]
        ends = _truncated((before + rest_here)[texts], best[texts], uniform(token_key[where[texts]], r, 3))
        g[where[texts]] = ends
        paths.append((begin, count, logp))
        sets.append(g)
        excluded.append(new_excluded)
        total = np.add.reduceat(np.append(logp, 0.0), np.minimum(toff[:-1], len(logp)))
        whole.append((texts, r, total))
    flat = lat.piece[np.concatenate(pool)] if len(lat.piece) else np.zeros(0, np.int64)
    for texts, r, total in whole:
        begin, count, _ = paths[r]
        run = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        ids = flat[np.repeat(begin, count) + run]
        poff = np.append(0, np.cumsum(count))[toff]
        gap = total - best  # log probability minus kappa
        near = np.exp(np.clip(gap, -30.0, 700.0))
        log_inc = np.where(gap > -30, np.log(-np.expm1(-near)), gap)
        log_inc = np.where(np.isfinite(best), log_inc, 0.0)
        for d in texts:
            found[d].append((ids[poff[d]:poff[d + 1]], float(total[d]), float(log_inc[d])))
    return found


def marked(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a blank put before each that is not empty."""
    size = np.diff(offs)
    new = np.append(0, np.cumsum(size + (size > 0)))
    out = np.full(int(new[-1]), 32, np.uint8)
    doc = np.repeat(np.arange(len(size)), size)
    out[np.arange(len(buf)) + np.cumsum(size > 0)[doc]] = buf
    return out, new


_SAMPLES = T.ArrayType(T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())),
                                     T.StructField("log_prob", T.DoubleType()),
                                     T.StructField("log_inclusion", T.DoubleType())]))


def sampler(k: int, seed: int, model: str, sharpness: float):
    """Arrow UDF: (text, 64-bit row key) -> array of sampled segmentations."""
    @arrow_udf(_SAMPLES)
    @W.trimmed
    def run(texts: pa.Array, row_keys: pa.Array) -> pa.Array:
        v = vocabulary(model, sharpness)
        keys = W.mix64(row_keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                       + np.uint64(seed))
        n_of, ids, sizes, lp, li = [], [], [], [], []
        for p in W.parts(texts, PART):
            buf, offs = marked(p.buf, p.offs)
            for one in sample_part(buf, offs, keys[p.first:p.first + len(offs) - 1], k, v):
                n_of.append(len(one))
                for a, b, c in one:
                    ids.append(a)
                    sizes.append(len(a))
                    lp.append(b)
                    li.append(c)
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        id_lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat))
        rows = pa.StructArray.from_arrays([id_lists, pa.array(lp, pa.float64()), pa.array(li, pa.float64())],
                                          ["ids", "log_prob", "log_inclusion"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_of)).astype(np.int32)), rows)
    return run


def decode_ids(ids: np.ndarray, offs: np.ndarray, v: Vocabulary) -> pa.Array:
    """Texts of id sequences (CSR); the blank put before a text is taken off again."""
    size = v.offs[ids + 1] - v.offs[ids]
    to = np.append(0, np.cumsum(size))
    at = np.repeat(v.offs[ids] - to[:-1], size) + np.arange(int(to[-1]))
    out = v.data[at]
    ends = to[offs]
    starts = ends[:-1] + (np.diff(offs) > 0)  # every sequence starts with the blank
    keep = np.ones(len(out), bool)
    keep[ends[:-1][np.diff(offs) > 0]] = False
    data = out[keep]
    new = np.append(0, np.cumsum(ends[1:] - starts))
    return pa.Array.from_buffers(pa.large_string(), len(offs) - 1,
                                 [None, pa.py_buffer(new.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]
                                 ).cast(pa.string())


def decoder(model: str = MODEL):
    """Arrow UDF: array of piece ids -> text."""
    @arrow_udf(T.StringType())
    @W.trimmed
    def run(lists: pa.Array) -> pa.Array:
        v = vocabulary(model, 1.0)
        gone = lists.is_null()
        lists = lists.fill_null([]) if lists.null_count else lists
        offs = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy(zero_copy_only=False)
        out, a = [], 0
        while a < len(lists):  # some sequences at a time: the byte positions take eight times the text
            b = max(a + 1, int(np.searchsorted(offs, offs[a] + PART // 8, "right")) - 1)
            out.append(decode_ids(ids[offs[a]:offs[b]].astype(np.int64), offs[a:b + 1] - offs[a], v))
            a = b
        text = pa.concat_arrays(out) if out else pa.array([], pa.string())
        return pc.if_else(gone, pa.scalar(None, pa.string()), text)
    return run


def encode(docs: DataFrame, *, k: int = 2, id_col: str = "doc_id", text_col: str = "text", seed: int = 8,
           model: str = MODEL, sharpness: float = 1.0, key: Column | None = None) -> DataFrame:
    """(doc_id, sample, ids, log_prob, log_inclusion): up to k distinct segmentations of every text, one row each.

    Defined cases: a NULL or empty text has one segmentation, of no pieces, with
    probability 1; a text with fewer than k segmentations gives all it has; the
    row key is a hash of id and text, so rows repeated in full get the same
    samples; a blank mark character inside a text goes by bytes, so decoding is
    exact; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession, 2 * PART)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       (F.xxhash64(F.col(id_col)) if key is None else key).alias("key"))
    some = base.select("doc_id", F.posexplode(sampler(k, seed, model, sharpness)("text", "key")).alias("sample", "s"))
    return some.select("doc_id", (F.col("sample") + 1).alias("sample"), "s.*")


def op8_query(docs: DataFrame) -> DataFrame:
    """Digests of the samples; ``md5_decoded`` is the MD5 of the text that decoding gives back."""
    x = encode(docs.select("doc_id", "text"))
    return x.select("doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"),
                    F.xxhash64("ids").alias("ids_hash"), "log_prob", "log_inclusion",
                    F.md5(decoder()("ids").cast("binary")).alias("md5_decoded"))
