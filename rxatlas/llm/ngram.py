"""Interpolated modified Kneser-Ney bigram model, counted in Spark, stored as
sorted hash arrays that workers map into memory.

Counting: each task counts its own n-grams, then ships packed arrays (hashes
and counts) to shards by hash; a shard merges them, sorts them and writes its
arrays to the shared folder. A context's successors lie in one shard, except
for the few contexts that are too frequent (more than a quarter of a shard):
theirs are spread over SPREAD shards by successor, and their sums are added up
on the driver (at most 4 per shard). Nothing is pruned or capped: the model
grows with the corpus.

Scoring: each batch looks up its distinct n-grams, in order, in the mapped
arrays; pages are shared between workers and only those touched are read.

The shared folder must be a path that workers can open (a mounted file system).
Files are written under a temporary name and renamed, so a repeated task leaves
the same file.

Probabilities: p(w|c) = (max(n(cw) - D, 0) + g(c) p(w)) / n(c), p(w) = (max(m(w) - D', 0)
+ g' / (V + 1)) / M, with m(w) the number of contexts of w, M their sum, D by
counts of counts (one, two, three or more), and g what the discounts free. A
context never seen leaves p(w). Each text starts in a context of its own and
ends with the end token.

Defined cases: null text is empty, its only token the end; texts of rows in
training count as often as the rows occur; without training rows every token
has probability 1 / (V + 1) = 1. Null ids fold as the empty text; an empty table
gives an empty table; further columns are left behind.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm import text as tx
from rxatlas.llm.common import columns, fold
from rxatlas.session import ensure_checkpoint_dir

U = np.uint64
END, START = U(0x0123456789ABCDEF), U(0xFEDCBA9876543211)
CHARS_PER_SHARD = 16_000_000
MOST_SHARDS = 1 << 15
TASK_TOKENS = 2_000_000
SPREAD = 16
LOOKUP_TOKENS = 1_000_000
BLOB = "shard int, a binary, b binary, n binary"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and end of each text as hashes, the token before each, and where texts begin."""
    h, ptr = tx.words(texts)
    n = len(ptr) - 1
    out_ptr = ptr + np.arange(n + 1)
    w = np.empty(out_ptr[-1], U)
    ends = out_ptr[1:] - 1
    inner = np.ones(len(w), bool)
    inner[ends] = False
    w[inner], w[ends] = h, END
    c = np.empty_like(w)
    c[1:] = w[:-1]
    c[out_ptr[:-1]] = START
    return w, c, out_ptr


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[at], (np.add.reduceat(counts[order].astype(np.int64), at) if len(k) else np.zeros(0, np.int64))


class Layout:
    """Where n-grams live: the shard is a range of the top 16 bits of the key."""

    def __init__(self, folder: str, shards: int, hot: np.ndarray):
        self.folder, self.shards, self.hot = folder, shards, np.sort(hot)

    def shard(self, key: np.ndarray) -> np.ndarray:
        return ((key >> U(48)) * U(self.shards) >> U(16)).astype(np.int32)

    def is_hot(self, c: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(c), bool)
        k = np.searchsorted(self.hot, c)
        k[k == len(self.hot)] = 0
        return self.hot[k] == c

    def pair(self, c: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Key of a bigram: bucket of its context, then bits of its hash."""
        top = np.where(self.is_hot(c), tx.mix(c + (w & U(SPREAD - 1))), c) >> U(48)
        return (top << U(48)) | (tx.combine(c, w) >> U(16))

    def path(self, kind: str, shard: int) -> str:
        return f"{self.folder}/{kind}-{shard}.npy"

    def write(self, kind: str, shard: int, array: np.ndarray) -> None:
        path = self.path(kind, shard)
        temp = f"{path}.{uuid.uuid4().hex}.npy"
        np.save(temp, array)
        os.replace(temp, path)

    def read(self, kind: str, shard: int) -> np.ndarray:
        return np.load(self.path(kind, shard), mmap_mode="r")


def _blobs(layout: Layout, key: np.ndarray, a: np.ndarray, b: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    """One row per shard; ``key`` is sorted."""
    shard = layout.shard(key)
    at = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(key)) if len(key) else np.zeros(1, np.int64)
    cut = list(zip(at[:-1], at[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(shard[s]) for s, _ in cut], pa.int32()), pa.array([a[s:e].tobytes() for s, e in cut], pa.binary()),
         pa.array([b"" if b is None else b[s:e].tobytes() for s, e in cut], pa.binary()),
         pa.array([n[s:e].astype(np.uint32).tobytes() for s, e in cut], pa.binary())], names=["shard", "a", "b", "n"])


def _by_shard(batches):
    """(shard, hashes a, hashes b, counts) of each shard, from rows sorted by shard."""
    shard, held = None, []

    def joined():
        cat = lambda k, t: np.frombuffer(b"".join(x[k] for x in held), t)
        return shard, cat(0, U), cat(1, U), cat(2, np.uint32)

    for batch in batches:
        for s, *x in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if s != shard and held:
                yield joined()
                held = []
            shard = s
            held.append(x)
    if held:
        yield joined()


def _map_counts(batches, layout: Layout, pairs: bool):
    def flush(c, w):
        if pairs:
            key = layout.pair(c, w)
            # by shard, then context: equal contexts lie side by side and compress
            order = np.lexsort((key, c, layout.shard(key)))
            c, w, key = c[order], w[order], key[order]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            return _blobs(layout, key[at], c[at], w[at], np.diff(np.append(at, len(key))))
        key, n = np.unique(w, return_counts=True)
        return _blobs(layout, key, key, None, n)

    held, size = [], 0
    for b in batches:
        for s in range(0, b.num_rows, 200):
            w, c, _ = tokens(b.column("text").slice(s, 200))
            held.append((c, w))
            size += len(w)
            if size >= TASK_TOKENS:
                yield flush(*map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        yield flush(*map(np.concatenate, zip(*held)))


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """For counts 0, 1, 2 and 3 or more, from the numbers of n-grams seen one to four times."""
    n1, n2, n3, n4 = (float(x) for x in counts_of_counts)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.75, 3 - 4 * y * n4 / n3 if n3 else 0.9]
    return np.array([0.0] + [min(max(x, 0.05), k + 0.95) for k, x in enumerate(raw)])


class Model:
    """What workers need to score: the layout and global sums."""

    def __init__(self, layout: Layout, total: int, types: int, d2, d1, free1, n_pairs, hot_sums):
        self.layout, self.total, self.types = layout, total, types
        self.d2, self.d1, self.free1, self.n_pairs, self.hot_sums = d2, d1, free1, n_pairs, hot_sums

    def _find(self, kind: str, key: np.ndarray, fields: dict) -> tuple:
        """Values of sorted distinct ``key``, zero where absent."""
        out = [np.zeros(len(key), t) for t in fields.values()]
        shard = self.layout.shard(key)
        edge = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(key)) if len(key) else np.zeros(1, int)
        for s, e in zip(edge[:-1], edge[1:]):
            k = int(shard[s])
            if not os.path.exists(self.layout.path(f"{kind}-key", k)):
                continue
            have = self.layout.read(f"{kind}-key", k)
            if not len(have):
                continue
            at = np.minimum(np.searchsorted(have, key[s:e]), len(have) - 1)
            hit = np.flatnonzero(have[at] == key[s:e])
            for o, f in zip(out, fields):
                o[s + hit] = self.layout.read(f"{kind}-{f}", k)[at[hit]]
        return tuple(out)

    def log10(self, w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p(w|c) of each token, and the token's count in training."""
        words, word = np.unique(w, return_inverse=True)
        contexts, context = np.unique(c, return_inverse=True)
        pairs, first, pair = np.unique(self.layout.pair(c, w), return_index=True, return_inverse=True)
        count, cont = self._find("word", words, {"count": np.int64, "contexts": np.int64})
        n, one, two, three = (x.astype(float) for x in self._find("context", contexts, {"total": np.int64, "one": np.int64, "two": np.int64, "three": np.int64}))
        for k, sums in self.hot_sums.items():
            at = np.searchsorted(contexts, U(k))
            if at < len(contexts) and contexts[at] == U(k):
                n[at], one[at], two[at], three[at] = sums
        seen, = self._find("pair", pairs, {"count": np.int64})
        uniform = 1.0 / (self.types + 1)
        p1 = (np.maximum(cont - self.d1[np.minimum(cont, 3)], 0) + self.free1 * uniform) / self.n_pairs if self.n_pairs else np.full(len(words), uniform)
        free = self.d2[1] * one + self.d2[2] * two + self.d2[3] * three
        low = p1[word[first]]
        at = context[first]
        p = np.where(n[at] > 0, (np.maximum(seen - self.d2[np.minimum(seen, 3)], 0) + free[at] * low) / np.maximum(n[at], 1), low)
        return np.log10(p)[pair], count[word]


def shared_folder(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    where = urlparse(base)
    if where.scheme not in ("", "file"):
        raise ValueError(f"the model is mapped into memory: spark.checkpoint.dir must be a mounted folder, not {base}")
    path = f"{where.path.rstrip('/')}/rxatlas-{name}-{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


def fit(docs: DataFrame) -> Model:
    """Counts ``docs`` (text) and writes the model to the shared folder."""
    spark = docs.sparkSession
    docs = docs.select("text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = int(min(max(1, -(-chars // CHARS_PER_SHARD)), MOST_SHARDS))
    folder = shared_folder(spark, "ngrams")
    plain = Layout(folder, shards, np.zeros(0, U))

    def words(batches):
        for k, key, _, n in _by_shard(batches):
            key, n = summed(key, n)
            plain.write("word-key", k, key)
            plain.write("word-count", k, n)
            top = np.argsort(-n, kind="stable")[:4]
            yield pa.RecordBatch.from_arrays([pa.array([int(n.sum())]), pa.array([len(n)]), pa.array([key[top].view(np.int64).tolist()], pa.list_(pa.int64())),
                                              pa.array([n[top].tolist()], pa.list_(pa.int64()))], names=["total", "types", "top", "top_n"])

    got = (docs.mapInArrow(lambda b: _map_counts(b, plain, False), BLOB).repartition(shards, "shard").sortWithinPartitions("shard")
           .mapInArrow(words, "total long, types long, top array<long>, top_n array<long>").collect())  # one row per shard
    total, types = sum(r.total for r in got), sum(r.types for r in got)
    texts = docs.count()
    hot = [np.int64(k).astype(U) for r in got for k, n in zip(r.top, r.top_n) if 4 * shards * n > total and shards > 1]
    if shards > 1 and 4 * shards * texts > total:
        hot.append(START)
    layout = Layout(folder, shards, np.array(hot, U))

    def pairs(batches):
        for k, c, w, n in _by_shard(batches):
            key = layout.pair(c, w)
            order = np.argsort(key, kind="stable")
            key, c, w, n = key[order], c[order], w[order], n[order].astype(np.int64)
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n = np.add.reduceat(n, at)
            key, c, w = key[at], c[at], w[at]
            layout.write("pair-key", k, key)
            layout.write("pair-count", k, n.astype(np.uint16 if n.max() < 65536 else np.uint32 if n.max() < 2**32 else np.int64))
            order = np.argsort(c, kind="stable")
            cs, ns = c[order], n[order]
            at = np.flatnonzero(np.append(True, cs[1:] != cs[:-1]))
            sums = [np.add.reduceat(x, at) for x in (ns, (ns == 1).astype(np.int64), (ns == 2).astype(np.int64), (ns >= 3).astype(np.int64))]
            spread = layout.is_hot(cs[at])
            layout.write("context-key", k, cs[at][~spread])
            for f, x in zip(("total", "one", "two", "three"), sums):
                layout.write(f"context-{f}", k, x[~spread].astype(np.uint32 if x.max() < 2**32 else np.int64))
            layout.write("hot", k, np.stack([cs[at][spread].view(np.int64), *[x[spread] for x in sums]]))
            layout.write("seen", k, np.array([(n == x).sum() for x in (1, 2, 3, 4)] + [len(n)]))
            words_, many = np.unique(w, return_counts=True)
            yield _blobs(layout, words_, words_, None, many)

    def contexts(batches):
        for k, key, _, n in _by_shard(batches):
            key, n = summed(key, n)
            have = layout.read("word-key", k)
            out = np.zeros(len(have), np.int64)
            out[np.searchsorted(have, key)] = n
            layout.write("word-contexts", k, out)
            yield pa.RecordBatch.from_arrays([pa.array([int((out == x).sum())]) for x in (1, 2, 3, 4)] + [pa.array([int((out >= 3).sum())]), pa.array([k], pa.int32())],
                                             names=["n1", "n2", "n3", "n4", "more", "shard"])

    cont = (docs.mapInArrow(lambda b: _map_counts(b, layout, True), BLOB).repartition(shards, "shard").sortWithinPartitions("shard")
            .mapInArrow(pairs, BLOB).repartition(shards, "shard").sortWithinPartitions("shard")
            .mapInArrow(contexts, "n1 long, n2 long, n3 long, n4 long, more long, shard int").collect())  # one row per shard
    seen, hot_sums = np.zeros(5, np.int64), {}
    for k in range(shards):
        if os.path.exists(layout.path("seen", k)):
            seen += layout.read("seen", k)
            for c, *sums in layout.read("hot", k).T.tolist():
                old = hot_sums.get(c % 2**64, [0] * 4)
                hot_sums[c % 2**64] = [a + b for a, b in zip(old, sums)]
    n_cont = [sum(r[i] for r in cont) for i in range(5)]
    d1 = discounts(np.array(n_cont[:4]))
    free1 = d1[1] * n_cont[0] + d1[2] * n_cont[1] + d1[3] * n_cont[4]
    return Model(layout, total, types, discounts(seen[:4]), d1, free1, int(seen[4]), hot_sums)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity) for every row of ``docs`` (doc_id, text, held_out)."""
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def run(batches):
        for b in batches:
            _, ptr = tx.words(b.column("text"))
            ptr = ptr + np.arange(len(ptr))
            for s, e in tx.pieces(ptr, LOOKUP_TOKENS):
                part = b.slice(s, e - s)
                w, c, at = tokens(part.column("text"))
                log_p, count = model.log10(w, c)
                base = np.log10((count + 1) / (model.total + model.types + 1))
                size = np.diff(at)
                total = np.add.reduceat(log_p, at[:-1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(size), pa.array(np.add.reduceat((count > 0).astype(np.int64), at[:-1])),
                     pa.array(np.full(len(size), model.total)), pa.array(np.add.reduceat(base, at[:-1])), pa.array(total), pa.array(10 ** (-total / size))],
                    names=[x.split()[0] for x in schema.split(", ")])

    return docs.mapInArrow(run, schema)


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Every row scored by the model of the rows whose fold is not 2."""
    d = columns(docs, doc_id="long", text="string").withColumn("held_out", fold("doc_id", 7) == 2)
    return score(d, fit(d.where("not held_out")))
