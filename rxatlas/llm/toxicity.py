"""Toxicity by a subsequence string kernel with Nystroem landmarks and a support vector machine.

A text is a bag of segments: its words, and runs of one-letter words taken
together (spaced-out insults). The kernel of two segments counts the common
subsequences of three and four letters, of any script. An occurrence is weighted
by DECAY for every letter it skips, of which there may be a bounded number, and
by INSERTED for every character between its letters that is no letter, of which
there may be any number: inserted and gapped characters cost weight, not the
match. Kernel values to LANDMARKS segments give Nystroem
features, on which a squared-hinge SVM is trained by multiple-instance rounds:
labels are the sentences' (a document's label stands for its sentences); in
each round every toxic text contributes its highest-scoring segments, clean
texts contribute theirs as the hard negatives. As the kernel has a finite
feature map, the decision function folds into one table of weights over
subsequences, so scoring a segment is a sum of look-ups.

A document's score is a logistic function of how many of its segments exceed
fixed quantiles of the decision values, and of the largest one. Training takes a
bounded sample of labelled rows, each with its whole text: of each class the
SAMPLE_DOCS rows of smallest id hash, as far as they fit into SAMPLE_CHARS
characters together (a text of more than that is no training row). Scoring takes
all texts, whole.

Defined cases: null and empty texts have no segment and get the score of an
empty bag; rows are independent; without labelled rows of both classes the
score is the share of toxic labels, 0 if there are none; several labels of a
document count as their maximum.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm import text as tx
from rxatlas.llm.common import bounded_sample, columns, fold

U = np.uint64
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 24_000_000
LANDMARKS, ROUNDS, WITNESSES, HARD = 160, 4, 4, 4000
#: Weight of a skipped letter, and of an inserted character.
DECAY, INSERTED = 0.6, 0.85
#: Letters of a subsequence, and the letters that it may reach over.
SPANS = {3: 6, 4: 6}
TABLE_BITS = 19
#: The symbol of a segment's two ends; a letter's symbol is its own lower-cased code point, 0 is no letter.
EDGE = 0x110000
#: Characters that stand for letters.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
OFFSETS = [(0, *d) for p, span in SPANS.items() for d in combinations(range(1, span), p - 1)]
QUANTILES = (0.9, 0.99, 0.997, 0.999, 0.9997, 0.9999)


def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: its symbol, and whether it is white space."""
    chars = [chr(c) for c in range(0x110000)]
    space = np.array([ch.isspace() for ch in chars])
    space[0x1C:0x20] = False
    sym = np.zeros(0x110000, np.int32)
    for c in np.flatnonzero(np.array([ch.isalpha() for ch in chars])).tolist():
        sym[c] = ord(chars[c].lower()[0])
    for a, b in STANDS_FOR.items():
        sym[ord(a)] = ord(b)
    return sym, space


SYMBOL, SPACE = _symbols()
#: Inserted characters beyond this cost no more: their weight is next to nothing.
MOST_INSERTED = 255
INSERTED_POWER = INSERTED ** np.arange(MOST_INSERTED + 1)


def symbol_hash(sym: np.ndarray, place: int) -> np.ndarray:
    """A random-looking 64-bit value of each symbol at a place of a subsequence."""
    return tx.mix(sym.astype(U) + U((place + 1) << 32))


class Segments:
    """Segments of an Arrow text column: symbols, spans, hashes, and where each text's begin."""

    def __init__(self, texts: pa.Array):
        buf, at = tx.flat(texts)
        lead = (buf & 0xC0) != 0x80
        code = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        start = np.concatenate(([0], np.cumsum(lead)))[at]
        n = len(code)
        word = ~SPACE[code]
        edge = np.zeros(n + 1, bool)
        edge[start] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last[:-1] &= ~word[1:] | edge[1:n]
        b, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        doc = np.searchsorted(start, b, "right") - 1
        if len(b):
            single = e - b == 1
            joined = np.zeros(len(b), bool)
            joined[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
            head = np.flatnonzero(~joined)
            e = e[np.append(head[1:], len(b)) - 1]
            b, doc = b[head], doc[head]
        self.symbol, self.begin, self.end = SYMBOL[code], b, e
        self.ptr = np.searchsorted(doc, np.arange(len(start)), "left")
        p, inverse = tx.powers(n + 1)
        run = np.zeros(n + 1, U)
        np.cumsum(symbol_hash(self.symbol, 0) * p[:n], out=run[1:])
        self.key = tx.mix((run[e] - run[b]) * inverse[b] + (e - b).astype(U))

    def subsequences(self, which: np.ndarray):
        """(segment, table index, weight) of every subsequence of the segments at ``which``."""
        b, e = self.begin[which], self.end[which]
        size = e - b + 2
        ptr = np.concatenate(([0], np.cumsum(size)))
        own = np.repeat(np.arange(len(which)), size)
        inner = np.arange(ptr[-1]) - ptr[own]
        sym = np.where((inner == 0) | (inner == size[own] - 1), EDGE, self.symbol[np.clip(b[own] + inner - 1, 0, max(len(self.symbol) - 1, 0))])
        letter = np.flatnonzero(sym)
        # letters alone from here on; the characters between two of them by running number
        others = letter - np.arange(len(letter))
        sym, own = sym[letter], own[letter]
        m = len(own)
        hashes = [symbol_hash(sym, k) for k in range(max(SPANS))]
        for d in OFFSETS:
            last = np.full(m, -1)
            last[:max(0, m - d[-1])] = own[d[-1]:]
            at = np.flatnonzero(last == own)
            h = np.full(len(at), U(len(d)), U)
            for k, x in enumerate(d):
                h = h * U(0x9E3779B97F4A7C15) + hashes[k][at + x]
            h = (h ^ (h >> U(31))) * U(0xD6E8FEB86659FD93)
            inserted = np.minimum(others[at + d[-1]] - others[at], MOST_INSERTED)
            yield own[at], (h >> U(64 - TABLE_BITS)).astype(np.int64), DECAY ** (d[-1] + 1 - len(d)) * INSERTED_POWER[inserted]


def values(seg: Segments, which: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """Decision values: kernel sums by the folded table, scaled by each segment's own norm."""
    total, norm = np.zeros(len(which)), np.full(len(which), 1e-9)
    for own, at, weight in seg.subsequences(which):
        total += np.bincount(own, table[at] * weight, len(which))
        norm += np.bincount(own, weight * weight, len(which))
    return total / np.sqrt(norm) + bias


def kernel(a: str, b: str) -> float:
    """The kernel of two segments, each scaled by its own norm (1 for equal ones)."""
    seg = Segments(pa.array([a, b]))
    which = np.array([int(seg.ptr[0]), int(seg.ptr[1])])
    feature = np.zeros((2, 1 << TABLE_BITS))
    for own, at, weight in seg.subsequences(which):
        np.add.at(feature, (own, at), weight)
    norm = np.sqrt((feature * feature).sum(1))
    return float(feature[0] @ feature[1] / (norm[0] * norm[1])) if norm.all() else 0.0


class Model:
    def __init__(self, table=None, bias=0.0, cuts=None, coef=None, prior=0.0):
        self.table, self.bias, self.cuts, self.coef, self.prior = table, bias, cuts, coef, prior

    def features(self, seg: Segments, score: np.ndarray) -> np.ndarray:
        n = np.diff(seg.ptr)
        out = np.zeros((len(n), 2 * len(self.cuts) + 3))
        full = np.flatnonzero(n)
        out[:, 0] = 1
        out[:, 1] = -3
        if len(full):
            at = seg.ptr[full]
            out[full, 1] = np.clip(np.maximum.reduceat(score, at), -3, 3)
            out[full, 2] = np.log1p(n[full]) / 5
            for k, c in enumerate(self.cuts):
                over = np.add.reduceat((score > c).astype(np.int64), at)
                out[full, 3 + 2 * k] = np.minimum(over, 5) / 5
                out[full, 4 + 2 * k] = np.sqrt(over / n[full])
        return out

    def score(self, texts: pa.Array, memo: tx.Memo) -> np.ndarray:
        n = len(texts)
        out = np.full(n, self.prior)
        if self.table is None:
            return out
        for s in range(0, n, 100):
            seg = Segments(texts.slice(s, 100))
            f = memo.get(seg.key, lambda k, g=seg: values(g, k, self.table, self.bias)) if len(seg.key) else np.zeros(0)
            z = self.features(seg, f) @ self.coef
            out[s:s + 100] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Squared-hinge SVM by Newton steps; the last column is the bias."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        act = y * (x @ w) < 1
        xa = x[act] * c[act, None]
        new = np.linalg.solve(xa.T @ x[act] + ridge * len(x) * np.eye(x.shape[1]), xa.T @ y[act])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, c: np.ndarray, ridge: float) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (c * (p - y)) + ridge * w
        h = (x * (c * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w - np.linalg.solve(h, g)
    return w


def _vocabulary(texts: pa.Array) -> tuple[Segments, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct segments, and of every segment of the texts its text and
    its number among them; built in slices to keep memory small."""
    keys, docs, symbols, sizes, known, size = [], [], [], [], np.zeros(0, U), []
    for s in range(0, len(texts), 100):
        g = Segments(texts.slice(s, 100))
        n = np.diff(g.ptr)
        keys.append(g.key)
        docs.append(np.repeat(np.arange(s, s + len(n)), n))
        size.append(n)
        unique, first = np.unique(g.key, return_index=True)
        new = ~np.isin(unique, known, assume_unique=True)
        k = first[new]
        length = g.end[k] - g.begin[k]
        at = np.concatenate(([0], np.cumsum(length)))
        symbols.append(g.symbol[np.repeat(g.begin[k] - at[:-1], length) + np.arange(at[-1])])
        sizes.append((unique[new], length))
        known = np.union1d(known, unique)
    seg = Segments(pa.array([], pa.string()))
    seg.key, length = (np.concatenate(x) for x in zip(*sizes)) if sizes else (np.zeros(0, U), np.zeros(0, np.int64))
    seg.symbol = np.concatenate(symbols) if symbols else seg.symbol
    seg.end = np.cumsum(length)
    seg.begin = seg.end - length
    order = np.argsort(seg.key)
    word = order[np.searchsorted(seg.key[order], np.concatenate(keys))] if keys else np.zeros(0, np.int64)
    return seg, np.concatenate(docs) if docs else word, word, np.concatenate(([0], np.cumsum(np.concatenate(size)))) if size else np.zeros(1, np.int64)


def train(texts: pa.Array, toxic: np.ndarray, weight: np.ndarray) -> Model:
    """``texts`` with labels 0/1; ``weight``: rows of the population each stands for."""
    prior = float((weight * toxic).sum() / max(weight.sum(), 1))
    if len(np.unique(toxic)) < 2:
        return Model(prior=prior)
    seg, doc, word, ptr = _vocabulary(texts)
    every = word
    pair = np.unique(doc * len(seg.key) + word)
    first = np.arange(len(seg.key))
    doc, word = pair // len(first), pair % len(first)
    n = len(first)
    t = toxic == 1
    # one half of the documents trains the SVM, the other the document's score
    half = np.random.RandomState(1).rand(len(texts)) < 0.6
    fit = half[doc]
    a = np.bincount(word[fit & t[doc]], minlength=n)
    b = np.bincount(word[fit & ~t[doc]], minlength=n)
    odds = np.log((a + 0.3) / ((t & half).sum() + 1)) - np.log((b + 0.3) / ((~t & half).sum() + 1))
    f = np.where(a >= 2, odds, -9.0)
    rng = np.random.RandomState(2)
    table, bias = np.zeros(1 << TABLE_BITS), 0.0
    clean_words = np.flatnonzero(b > 0)
    for step in range(ROUNDS):
        d, w = doc[fit & t[doc]], word[fit & t[doc]]
        order = np.lexsort((w, -f[w], d))
        d, w = d[order], w[order]
        rank = np.arange(len(d)) - np.searchsorted(d, d)
        chosen = (rank < WITNESSES) & ((rank == 0) | (odds[w] > 1.5))
        pos, many = np.unique(w[chosen], return_counts=True)
        good = odds[pos] > 0.5
        pos, many = pos[good], many[good]
        if not len(pos) or not len(clean_words):
            return Model(prior=prior)
        hard = clean_words[np.lexsort((clean_words, -f[clean_words]))][:HARD]
        neg = np.unique(np.concatenate((hard, rng.choice(clean_words, min(HARD, len(clean_words)), replace=False))))
        best = pos[np.lexsort((pos, -many))]
        marks = np.concatenate((best[:LANDMARKS * 5 // 8], rng.choice(neg, min(len(neg), LANDMARKS * 3 // 8), replace=False)))
        rows = np.concatenate((marks, pos, neg))
        code, x, norm = [], [], np.full(len(rows), 1e-9)
        for own, at, weight_ in seg.subsequences(first[rows]):
            code.append(own * (1 << TABLE_BITS) + at)
            x.append(weight_)
            norm += np.bincount(own, weight_ * weight_, len(rows))
        code, back = np.unique(np.concatenate(code), return_inverse=True)
        x = np.bincount(back, np.concatenate(x))
        own, at = code >> TABLE_BITS, code & ((1 << TABLE_BITS) - 1)
        x /= np.sqrt(norm)[own]
        m = len(marks)
        used, column = np.unique(at[own < m], return_inverse=True)
        dense = np.zeros((len(used), m))
        dense[column, own[own < m]] = x[own < m]
        k = np.searchsorted(used, at)
        k[k == len(used)] = 0
        hit = used[k] == at
        kernel = np.stack([np.bincount(own[hit], x[hit] * dense[k[hit], j], len(rows)) for j in range(m)], 1)
        val, vec = np.linalg.eigh(kernel[:m] + 1e-6 * np.eye(m))
        root = vec / np.sqrt(np.maximum(val, 1e-6))
        feat = np.column_stack((kernel[m:] @ root, np.ones(len(pos) + len(neg))))
        y = np.concatenate((np.ones(len(pos)), -np.ones(len(neg))))
        c = np.concatenate((np.minimum(many, 20.0), np.minimum(b[neg], 20.0)))
        c[:len(pos)] *= c[len(pos):].sum() / c[:len(pos)].sum() / 2
        w = _svm(feat, y, c)
        table[:] = 0
        table[used] = dense @ (root @ w[:-1])
        bias = float(w[-1])
        f = np.concatenate([values(seg, first[s:s + 20000], table, bias) for s in range(0, n, 20000)])
        if step < ROUNDS - 1:
            f = f + 0.25 * np.clip(odds, -2, 4) * (a >= 2)
    model = Model(table.astype(np.float32), bias, np.quantile(f[word], QUANTILES), None, prior)
    seg.ptr = ptr
    x = model.features(seg, f[every])
    model.coef = _logistic(x[~half], toxic[~half].astype(float), weight[~half] / weight[~half].mean(), 0.05)
    return model


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from labelled rows; ``docs``: doc_id, text; ``labels``: doc_id, toxic."""
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = docs.groupBy("doc_id").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("size"))
    known = known.join(size, "doc_id")
    total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    few = []
    for k in (0, 1):
        room = SAMPLE_CHARS
        for r in bounded_sample(known.where(F.col("toxic") == k), "doc_id", SAMPLE_DOCS).collect():
            if r["size"] <= room:
                few.append((r.doc_id, r.toxic))
                room -= r["size"]
    few = docs.sparkSession.createDataFrame(few, "doc_id long, toxic int")  # at most 2 * SAMPLE_DOCS rows
    sample = docs.join(F.broadcast(few), "doc_id").select("doc_id", "text", "toxic").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    toxic = sample.column("toxic").to_numpy()
    texts = sample.column("text").combine_chunks().fill_null("")
    share = {k: total[k] / max(1, int((toxic == k).sum())) for k in total}
    return train(texts, toxic, np.array([share.get(int(k), 1.0) for k in toxic]))


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """(doc_id, ``keep``..., toxic_score) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the input
    schema = docs.select("doc_id", *keep).schema.add("toxic_score", "double")

    def run(batches):
        memo = tx.Memo()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", *keep)], pa.array(sent.value.score(b.column("text"), memo))],
                                             names=["doc_id", *keep, "toxic_score"])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned from labels of rows whose fold is not 0."""
    d = columns(docs, doc_id="long", text="string").withColumn("held_out", fold("doc_id", 5) == 0)
    own = columns(labels, doc_id="long", toxic="int").where(fold("doc_id", 5) != 0)
    found = score(d, learn(d.where("not held_out").select("doc_id", "text"), own), "held_out")
    return found.select("doc_id", "held_out", F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
