"""Toxicity: a bidirectional GRU with attention pooling over word and character inputs.

A text is cut into overlapping windows of ``WINDOW`` words, ``STRIDE`` apart,
the last one at the end of the text, so that every word lies in a window.  A
word enters as the sum of a hashed word embedding and the scaled sum of the
hashed embeddings of its character pieces; the two directions run over the
window, attention pools the states, and a logistic unit gives the window's
logit.  A document's logit is its highest window (multiple-instance learning:
labels mark documents, not windows).

Training is numpy on the driver: at most ``FIT_TOXIC`` toxic and ``FIT_CLEAN``
clean labelled documents, chosen by a hash of the id, texts of at most
``FIT_CHARS`` characters (longer ones are only left out of the fit).  Each
epoch scores all windows of the sample, takes each document's highest window
and follows the gradient through it (Adam).  The logit is shifted from the
sample's share of toxic documents to that of all labelled rows.  Scoring runs in
Arrow batches on whole texts; nothing but the text enters a score.

Null and empty texts get the score of the prior.  Without labels of both
classes every score is the prior (0.5 without labels).  Repeated rows get equal
scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import drawn, text_of
from sparkclust.llm.textarrays import BASE, M64, mix, prefix_hashes, slices, span_hashes, words

WINDOW = 32
STRIDE = 16
WORDS = 1 << 15
PIECES = 1 << 14
#: Lengths of the character pieces, in bytes.
GRAMS = (3, 5)
WIDTH = 12
HIDDEN = 8
THRESHOLD = 0.3
FIT_TOXIC = 800
FIT_CLEAN = 1_200
FIT_CHARS = 20_000
EPOCHS = 6
BATCH_WINDOWS = 4096
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, index of the distinct word, word cells, piece cells, owners of the pieces) with ASCII letters lowered.

    Words are read without ASCII punctuation at either end where that leaves something.
    """
    data = LOWER[data]
    row, start, end = words(data, offsets)
    if row.size == 0:
        e = np.empty(0, np.int64)
        return row, e, e, e, e
    punct = np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum()])
    for _ in range(3):
        start = np.where((end - start > 1) & punct[data[start]], start + 1, start)
        end = np.where((end - start > 1) & punct[data[end - 1]], end - 1, end)
    prefix = prefix_hashes(data)
    h = mix(span_hashes(prefix, start, end) + (end - start).astype(np.uint64))
    distinct, first, index = np.unique(h, return_index=True, return_inverse=True)
    s, e = start[first], end[first]
    per = [np.maximum(e - s - size + 1, 1) for size in GRAMS]
    total = np.sum(per, axis=0)
    first = np.cumsum(total) - total
    owner = np.repeat(np.arange(distinct.size), total)
    grams = np.empty(owner.size, np.int64)
    for size, n in zip(GRAMS, per, strict=True):
        of = np.repeat(np.arange(distinct.size), n)
        k = np.arange(of.size) - np.repeat(np.cumsum(n) - n, n)
        at = k + s[of]
        # a piece at the beginning of a word is another piece
        salt = np.where(k == 0, np.uint64((size + (1 << 20)) * BASE & M64), np.uint64(size * BASE & M64))
        cell = mix(span_hashes(prefix, at, np.minimum(at + size, e[of])) + salt) & np.uint64(PIECES - 1)
        grams[first[of] + k] = cell
        first = first + n
    return row, index, (distinct & np.uint64(WORDS - 1)).astype(np.int64), grams, owner


def window_starts(row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, words) of every window; word positions run over all rows."""
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    n = np.where(count == 0, 0, np.maximum(-(-(count - WINDOW) // STRIDE), 0) + 1)
    owner = np.repeat(np.arange(n_rows), n)
    k = np.arange(owner.size) - np.repeat(np.cumsum(n) - n, n)
    size = np.minimum(count[owner], WINDOW)
    begin = first[owner] + np.minimum(k * STRIDE, count[owner] - size)
    return owner, begin, size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.negative(x)
    np.exp(np.minimum(x, 60, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """By exp, which numpy has vectorised for single precision."""
    x = _sigmoid(x * 2)
    x *= 2
    x -= 1
    return x


@dataclass
class Model:
    """Parameters; ``shift`` moves the logit to the share of toxic documents, ``prior`` scores empty texts."""

    p: dict[str, np.ndarray]
    shift: float = 0.0
    prior: float = 0.5
    fitted: bool = False

    def embed(self, word: np.ndarray, gram: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Embeddings of the distinct words."""
        out = self.p["word"][word]
        if word.size:
            first = np.searchsorted(owner, np.arange(word.size))
            n = np.diff(np.append(first, owner.size))
            out = out + np.add.reduceat(self.p["gram"][gram], first, axis=0) / np.sqrt(n)[:, None].astype(np.float32)
        return out

    def gates(self, x: np.ndarray) -> list[np.ndarray]:
        """What the words add to the gates of either direction, once per distinct word."""
        return [x @ self.p[f"wx{side}"] + self.p[f"b{side}"] for side in (0, 1)]

    def forward(self, x: np.ndarray, gates: list[np.ndarray], index: np.ndarray, begin: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of windows over the word vectors ``x[index]``; with ``keep`` also what backward needs."""
        p, h = self.p, HIDDEN
        at = begin[:, None] + np.arange(WINDOW)[None, :]
        live = np.arange(WINDOW)[None, :] < size[:, None]
        ids = index[np.minimum(at, index.size - 1)]
        m, full = begin.size, bool(live.all())
        states = np.zeros((WINDOW, m, 2 * h), np.float32)
        memo = []
        for side, order in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
            wh, wn = p[f"wh{side}"][:, : 2 * h], p[f"wh{side}"][:, 2 * h :]
            s = np.zeros((m, h), np.float32)
            steps = []
            for t in order:
                g = gates[side][ids[:, t]]
                zr = _sigmoid(g[:, : 2 * h] + s @ wh)
                z, r = zr[:, :h], zr[:, h:]
                n = _tanh(g[:, 2 * h :] + (r * s) @ wn)
                new = s + z * (n - s)
                if not full:
                    new = np.where(live[:, t : t + 1], new, s)
                if keep:
                    steps.append((t, s, z, r, n))
                s = new
                states[t, :, side * h : side * h + h] = s
            memo.append(steps)
        u = _tanh(states @ p["wa"])  # WINDOW x m x h
        e = u @ p["va"]
        e = np.where(live.T, e, -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tm,tmh->mh", a, states)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (x, ids, live, states, memo, u, a, pooled)) if keep else logit

    def backward(self, kept, d: np.ndarray, word: np.ndarray, gram: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of sum(d * logit)."""
        p, h = self.p, HIDDEN
        x, ids, live, states, memo, u, a, pooled = kept
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["wo"], g["bo"][0] = pooled.T @ d, d.sum()
        dpool = d[:, None] * p["wo"]
        dstates = a[:, :, None] * dpool[None]
        da = np.einsum("tmh,mh->tm", states, dpool)
        de = a * (da - (a * da).sum(axis=0))
        g["va"] = np.einsum("tm,tmh->h", de, u)
        du = de[:, :, None] * p["va"] * (1 - u * u)
        g["wa"] = np.einsum("tmi,tmj->ij", states, du)
        dstates += du @ p["wa"].T
        dx = np.zeros_like(x)
        for side in (0, 1):
            wx, w = p[f"wx{side}"], p[f"wh{side}"]
            ds = np.zeros((d.size, h), np.float32)
            for t, s, z, r, n in reversed(memo[side]):
                on = live[:, t : t + 1]
                dt = ds + dstates[t, :, side * h : side * h + h]
                dn, dz = dt * z * (1 - n * n) * on, dt * (n - s) * z * (1 - z) * on
                drs = dn @ w[:, 2 * h :].T
                dr = drs * s * r * (1 - r)
                dg = np.concatenate((dz, dr, dn), axis=1)
                g[f"b{side}"] += dg.sum(axis=0)
                g[f"wh{side}"][:, : 2 * h] += s.T @ dg[:, : 2 * h]
                g[f"wh{side}"][:, 2 * h :] += (r * s).T @ dn
                xt = x[ids[:, t]]
                g[f"wx{side}"] += xt.T @ dg
                np.add.at(dx, ids[:, t], dg @ wx.T)
                ds = dt * np.where(on, 1 - z, 1) + drs * r + dg[:, : 2 * h] @ w[:, : 2 * h].T
        np.add.at(g["word"], word, dx)
        n = np.bincount(owner, minlength=word.size).astype(np.float32)
        np.add.at(g["gram"], gram, (dx / np.sqrt(np.maximum(n, 1))[:, None])[owner])
        return g

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Document scores of one slice."""
        n = offsets.size - 1
        out = np.full(n, -np.inf)
        row, index, word, gram, owner = tokens(data, offsets)
        if not self.fitted or row.size == 0:
            return np.full(n, self.prior)
        x = self.embed(word, gram, owner)
        gates = self.gates(x)
        doc, begin, size = window_starts(row, n)
        for i in range(0, doc.size, BATCH_WINDOWS):
            part = slice(i, i + BATCH_WINDOWS)
            np.maximum.at(out, doc[part], self.forward(x, gates, index, begin[part], size[part]))
        return np.where(np.isfinite(out), _sigmoid(out + self.shift), self.prior)


def fit(texts: list[str], labels: list[int], share: float, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Train on labelled texts; ``share`` is the toxic share among all labelled rows."""
    rng = np.random.default_rng(seed)
    h, w = HIDDEN, WIDTH

    def draw(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": draw(WORDS, w, scale=0.1), "gram": draw(PIECES, w, scale=0.1), "wa": draw(2 * h, h, scale=0.3),
         "va": draw(h, scale=0.3), "wo": draw(2 * h, scale=0.5), "bo": np.zeros(1, np.float32)}
    for side in (0, 1):
        p |= {f"wx{side}": draw(w, 3 * h, scale=0.4), f"wh{side}": draw(h, 3 * h, scale=0.3), f"b{side}": np.zeros(3 * h, np.float32)}
    y = np.array(labels, np.float32)
    model = Model(p, prior=share)
    if not (0 < y.sum() < y.size):
        return model
    body = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"".join(body), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in body]))).astype(np.int64)
    row, index, word, gram, owner = tokens(data, offsets)
    if row.size == 0:
        return model
    doc, begin, size = window_starts(row, y.size)

    def odds_of(cell: np.ndarray, doc_of: np.ndarray, n: int) -> np.ndarray:
        """Log odds of toxic documents among those that hold a cell; 0 for cells of few documents."""
        pairs = np.sort(doc_of * n + cell)
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
        toxic = np.bincount(pairs % n, y[pairs // n], n) + 0.5
        clean = np.bincount(pairs % n, 1 - y[pairs // n], n) + 0.5
        return np.clip(np.log(toxic / clean) - np.log(y.sum() / (y.size - y.sum())), -3, 3) * (toxic + clean > 4)

    # one embedding column of the words and one of the pieces start as these log odds
    p["word"][:, 0] = odds_of(word[index], row, WORDS)
    seen = np.unique(row * word.size + index)
    held = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=word.size))))
    doc_of, of = seen // word.size, seen % word.size
    n_of = held[of + 1] - held[of]
    at = np.arange(n_of.sum()) - np.repeat(np.cumsum(n_of) - n_of - held[of], n_of)
    p["gram"][:, 1] = odds_of(gram[at], np.repeat(doc_of, n_of), PIECES)
    x0 = model.embed(word, gram, owner)
    odds = (x0[:, 0] + x0[:, 1])[index]
    # epoch 0 takes the window with the highest log odds
    top = np.array([odds[b : b + s].max() for b, s in zip(begin, size, strict=True)])
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    model.fitted = True
    for epoch in range(epochs):
        if epoch:
            x = model.embed(word, gram, owner)
            gates = model.gates(x)
            parts = [slice(i, i + BATCH_WINDOWS) for i in range(0, doc.size, BATCH_WINDOWS)]
            top = np.concatenate([model.forward(x, gates, index, begin[q], size[q]) for q in parts])
        order = np.lexsort((-top, doc))
        best = order[np.searchsorted(doc[order], np.unique(doc))]
        for part in np.array_split(rng.permutation(best), max(1, best.size // 128)):
            # only the distinct words of these windows
            at = np.unique(np.concatenate([index[b : b + s] for b, s in zip(begin[part], size[part], strict=True)]))
            local = np.full(word.size, 0)
            local[at] = np.arange(at.size)
            mine = np.isin(owner, at)
            lw, lg, lo = word[at], gram[mine], local[owner[mine]]
            x = model.embed(lw, lg, lo)
            logit, kept = model.forward(x, model.gates(x), local[index], begin[part], size[part], keep=True)
            d = ((_sigmoid(logit) - y[doc[part]]) / part.size).astype(np.float32)
            g = model.backward(kept, d, lw, lg, lo)
            step += 1
            for k in p:
                m1[k] += 0.1 * (g[k] - m1[k])
                m2[k] += 0.01 * (g[k] ** 2 - m2[k])
                p[k] -= (0.02 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    base = float(y.mean())
    model.shift = float(np.log(share / (1 - share)) - np.log(base / (1 - base))) if 0 < share < 1 else 0.0
    return model


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2 (null id: not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, fit_toxic: int = FIT_TOXIC, fit_clean: int = FIT_CLEAN) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    n = {int(r.y > 0): r["count"] for r in marks.groupBy("y").count().collect()}
    toxic, total = n.get(1, 0), sum(n.values())
    if not total:
        return fit([], [], 0.5)
    share = {1: min(1.0, fit_toxic / max(toxic, 1)), 0: min(1.0, fit_clean / max(total - toxic, 1))}
    part = F.when(F.col("y") > 0, share[1]).otherwise(share[0])
    chosen = F.broadcast(marks.where(drawn(F.xxhash64("doc_id", F.lit("toxicity")), part)))  # bounded by the fit sizes
    rows = docs.select("doc_id", text_of().alias("t")).join(chosen, "doc_id").where(F.length("t") <= FIT_CHARS)
    sample = sorted((r.doc_id, r.t, int(r.y > 0)) for r in rows.select("doc_id", "t", "y").collect())
    return fit([t for _, t, _ in sample], [y for _, _, y in sample], toxic / total)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in slices(batch, "_text", 4 << 20):
                n = offsets.size - 1
                s = shared.value.scores(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), batch.column("held_out").slice(first, n), pa.array(s)],
                    names=["doc_id", "held_out", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_of().alias("_text"))
    out = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
