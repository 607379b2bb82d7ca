"""MinHash near-duplicate groups with b-bit signatures.

Every text becomes its set of distinct word shingles (64-bit hashes). From
``PERMUTATIONS`` minima per set, bands of ``ROWS`` minima give candidate
buckets; of each minimum only the low ``BITS`` bits are kept, packed into
64-bit words, and the similarity of a candidate pair is estimated by counting
the lanes that differ, corrected for lanes that agree by chance. Pairs whose
estimate leaves the threshold possible are confirmed on the full sets.

Hot groups: equal sets fold into one class first (partial aggregation). In a
bucket every class is compared with the bucket's smallest id only, so a group
of m near copies costs m comparisons. After the components of those links are
known, only buckets that still hold classes of different components are
compared further, in blocks inside a task: first on the estimates, which marks
the members that may still link, then those members on their full sets. Only
links that join two components leave a task, never the pairs. No bucket is
capped.

Defined cases: null or blank text has the empty set and links with nothing;
rows that share a doc_id count as one document (and are all returned); a null
doc_id links with nothing by itself and gets a component only through an equal
text; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxatlas.llm import text as tx
from rxatlas.llm.common import columns, stored
from rxatlas.llm.graph import components

U = np.uint64
BANDS, ROWS, BITS = 32, 5, 4
PERMUTATIONS = BANDS * ROWS
LANES = 64 // BITS
WORDS64 = PERMUTATIONS // LANES
LOW_LANE = int("1" * LANES, 2 ** BITS)
#: Standard errors that a pair's estimate may lie below the threshold.
MARGIN = 4.0
BLOCK = 1024
LEADER_BLOCK = 512

_r = np.random.RandomState(5)
MULTIPLIERS = (_r.randint(1, 2**62, PERMUTATIONS, dtype=np.int64).astype(U) << U(1)) | U(1)
OFFSETS = _r.randint(0, 2**62, PERMUTATIONS, dtype=np.int64).astype(U)
SIGNATURE_SCHEMA = ("doc_id long, n_shingles long, f1 long, f2 long, "
                    "bands array<long>, " + ", ".join(f"s{i} long" for i in range(WORDS64)))


def sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each set begins."""
    h, ptr = tx.shingles(*tx.words(texts), width)
    size = np.zeros(len(ptr) - 1, np.int64)
    out = np.empty_like(h)
    w = 0
    for i in range(len(size)):
        s, e = ptr[i], ptr[i + 1]
        if s == e:
            continue
        a = np.sort(h[s:e])
        if e - s > 1:
            keep = np.empty(len(a), bool)
            keep[0] = True
            np.not_equal(a[1:], a[:-1], out=keep[1:])
            a = a[keep]
        out[w:w + len(a)] = a
        size[i] = len(a)
        w += len(a)
    return out[:w], np.concatenate(([0], np.cumsum(size)))


def minima(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """uint32[texts, PERMUTATIONS]; a row of an empty set is all ones."""
    n = len(ptr) - 1
    out = np.full((PERMUTATIONS, n), 2**32 - 1, np.uint32)
    for s, e in tx.pieces(ptr, 1 << 16):
        full = np.flatnonzero(np.diff(ptr[s:e + 1])) + s
        if not len(full):
            continue
        x, at = h[ptr[s]:ptr[e]], ptr[full] - ptr[s]
        y = np.empty_like(x)
        for j in range(PERMUTATIONS):
            np.multiply(x, MULTIPLIERS[j], out=y)
            y += OFFSETS[j]
            out[j, full] = np.minimum.reduceat(y, at) >> U(32)
    return out.T.copy()


def pack(m: np.ndarray) -> np.ndarray:
    """uint64[texts, WORDS64]: the low BITS bits of each minimum."""
    low = (m & np.uint32(2**BITS - 1)).astype(U).reshape(len(m), WORDS64, LANES)
    return np.bitwise_or.reduce(low << (np.arange(LANES, dtype=U) * U(BITS)), axis=2)


def band_keys(m: np.ndarray) -> np.ndarray:
    """uint64[texts, BANDS]; the band's number is part of the key."""
    m = m.reshape(len(m), BANDS, ROWS).astype(U)
    key = np.broadcast_to(tx.mix(np.arange(1, BANDS + 1, dtype=U)), m.shape[:2])
    for k in range(ROWS):
        key = tx.combine(key, m[:, :, k])
    return key


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: size of its set, 128-bit hash of the set, band keys, packed signature."""
    def run(batches):
        for b in batches:
            h, ptr = sets(b.column("text"), width)
            n = len(ptr) - 1
            size = np.diff(ptr)
            m = minima(h, ptr)
            full = np.flatnonzero(size)
            f = np.zeros((2, n), U)
            if len(full):
                for k, x in enumerate((tx.mix(h), tx.mix(h ^ U(0xA5A5A5A5A5A5A5A5)))):
                    f[k, full] = np.add.reduceat(x, ptr[full])
            s, keys = pack(m), band_keys(m)
            keep = np.repeat(size > 0, BANDS)
            bands = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(np.where(size > 0, BANDS, 0)))).astype(np.int32)),
                pa.array(keys.reshape(-1)[keep].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size), pa.array(f[0].view(np.int64)), pa.array(f[1].view(np.int64)), bands,
                 *[pa.array(np.ascontiguousarray(s[:, i]).view(np.int64)) for i in range(WORDS64)]],
                names=["doc_id", "n_shingles", "f1", "f2", "bands", *[f"s{i}" for i in range(WORDS64)]])

    return docs.mapInArrow(run, SIGNATURE_SCHEMA)


def estimate_from_differing(differing):
    """Similarity from the number of lanes that differ: lanes of unequal
    minima agree by chance once in 2**BITS."""
    chance = 0.5 ** BITS
    return (1 - differing / PERMUTATIONS - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    chance = 0.5 ** BITS
    agree = similarity + (1 - similarity) * chance
    return similarity - MARGIN * (agree * (1 - agree) / PERMUTATIONS) ** 0.5 / (1 - chance)


def _differing(left: str, right: str) -> Column:
    total = F.lit(0)
    for i in range(WORDS64):
        x = F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))
        for k in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        total = total + F.bit_count(x.bitwiseAND(F.lit(LOW_LANE)))
    return total


def _streamed(batches, keys: int):
    """Rows of one key after the other, from sorted Arrow batches: tables whose
    first ``keys`` columns are equal. Holds one key's rows and one batch."""
    rest = None
    for b in batches:
        if rest is not None:
            b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0] if b.num_rows else rest
        if not b.num_rows:
            continue
        k = [b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(b.num_rows, bool)
        for c in k:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(new)))
        for s, e in zip(cuts[:-1], cuts[1:]):
            yield b.slice(s, e - s)
        rest = b.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) with 100 * intersection >= percent * union on
    the full shingle sets. ``texts``: doc_id, text. The text of ``a`` goes to
    each block of its partners, that of ``b`` to its pair; a task holds one
    set of ``a`` and one batch."""
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_BLOCK).cast("long").alias("n"))
    dealt = pairs.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("n")).alias("block"))
    t = texts.select(F.col("doc_id").alias("id"), "text")
    rows = (dealt.select("a", "block", F.lit(1).alias("role"), F.col("b").alias("id"))
            .union(dealt.select("a", "block", F.lit(0).alias("role"), F.col("a").alias("id")).distinct())
            .join(t, "id").select("a", "block", "role", "id", "text")
            .repartition("a", "block").sortWithinPartitions("a", "block", "role"))

    def run(batches):
        at, own = None, []
        for b in batches:
            a, block, role, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            h, ptr = sets(b.column("text"), width)
            left, right = [], []
            for i in range(b.num_rows):
                x = h[ptr[i]:ptr[i + 1]]
                if at != (a[i], block[i]):
                    at, own = (a[i], block[i]), []
                if role[i] == 0:
                    own.append(x.copy())
                    continue
                for y in own:
                    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or not len(x):
                        continue
                    k = np.searchsorted(y, x)
                    k[k == len(y)] = 0
                    both = int((y[k] == x).sum())
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        left.append(a[i])
                        right.append(ids[i])
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _blocks(rows: DataFrame, size: int, *more: str) -> DataFrame:
    """Rows (key, rep, ...) of each key dealt out as pairs (i <= j) of blocks
    of about ``size`` rows, sorted for streaming."""
    n = rows.groupBy("key").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
    m = rows.join(n, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    return (m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                    "rep", "component", "n_shingles", *[f"s{i}" for i in range(WORDS64)], *more)
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))


class _Block:
    """One pair of blocks: which rows may still link, by size, component and estimate."""

    def __init__(self, g: pa.RecordBatch, percent: int):
        i, j = g.column(1)[0].as_py(), g.column(2)[0].as_py()
        own, self.rep, comp, self.n = (g.column(c).to_numpy(zero_copy_only=False) for c in range(3, 7))
        self.s = np.stack([g.column(7 + c).to_numpy(zero_copy_only=False) for c in range(WORDS64)], 1).view(U)
        _, self.comp = np.unique(comp, return_inverse=True)
        self.left, self.right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        self.same, self.percent, self.least = i == j, percent, least_estimate(percent / 100)

    def candidates(self, k: int) -> np.ndarray:
        to = self.right[self.right > k] if self.same else self.right
        n, p = self.n, self.percent
        to = to[(self.comp[to] != self.comp[k]) & (100 * np.minimum(n[to], n[k]) >= p * np.maximum(n[to], n[k]))]
        x = self.s[to] ^ self.s[k]
        x |= x >> U(1)
        x |= x >> U(2)
        d = np.bitwise_count(x & U(LOW_LANE)).sum(1, dtype=np.int64)
        return to[estimate_from_differing(d) >= self.least]


def _open_members(members: DataFrame, percent: int) -> DataFrame:
    """(key, rep) of those members of a bucket that may link to a member of
    another component, going by the estimate. No pair leaves a task."""
    def run(batches):
        for g in _streamed(batches, 3):
            block = _Block(g, percent)
            marked = np.zeros(g.num_rows, bool)
            for k in block.left:
                to = block.candidates(k)
                if len(to):
                    marked[k] = marked[to] = True
            if marked.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.column(0).to_numpy()[marked]), pa.array(block.rep[marked])], names=["key", "rep"])

    return _blocks(members, BLOCK).mapInArrow(run, "key long, rep long").distinct()


def _joining_links(members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b), confirmed on the full sets, that join different components
    of a bucket: enough of them to keep what is connected connected, at most
    one for each component and block. ``members`` also has text."""
    def run(batches):
        for g in _streamed(batches, 3):
            block = _Block(g, percent)
            h, ptr = sets(g.column("text"), width)
            values, h = np.unique(h, return_inverse=True)
            size, flag = np.diff(ptr), np.zeros(len(values), np.int32)
            a, b = [], []
            for k in block.left:
                to = block.candidates(k)
                if not len(to):
                    continue
                flag[h[ptr[k]:ptr[k + 1]]] = 1
                both = np.array([flag[h[ptr[x]:ptr[x + 1]]].sum() for x in to]) if len(to) < 64 else np.add.reduceat(
                    np.append(flag[h], 0), np.minimum(ptr[:-1], len(h)))[to]
                flag[h[ptr[k]:ptr[k + 1]]] = 0
                for x in to[(size[to] > 0) & (100 * both >= percent * (size[to] + size[k] - both))]:
                    if block.comp[x] != block.comp[k]:
                        a.append(min(block.rep[x], block.rep[k]))
                        b.append(max(block.rep[x], block.rep[k]))
                        block.comp[block.comp == block.comp[x]] = block.comp[k]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _blocks(members, LEADER_BLOCK, "text").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id,
    text): component_id is the smallest doc_id reachable over links between
    documents whose shingle sets have 100 * intersection >= percent * union."""
    docs = columns(docs, doc_id="long", text="string")
    sig = stored(signatures(docs, width), "minhash-signatures")
    words64 = [f"s{i}" for i in range(WORDS64)]
    classes = stored(sig.where("n_shingles > 0").groupBy("f1", "f2", "n_shingles")
                     .agg(F.min("doc_id").alias("rep")).where("rep is not null"), "minhash-classes")
    reps = stored(sig.join(classes, ["f1", "f2", "n_shingles"]).where("doc_id = rep")
                  .select("rep", "n_shingles", "bands", *words64), "minhash-reps")
    exploded = reps.select(F.explode("bands").alias("key"), "rep")
    first = exploded.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("top")).where("lead < top")
    buckets = stored(exploded.join(first, "key").where("rep > lead").select("key", "rep", "lead"), "minhash-buckets")

    least = least_estimate(percent / 100)
    s = reps.select("rep", "n_shingles", *words64)
    stars = (buckets.select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
             .join(s.alias("x"), F.col("a") == F.col("x.rep")).join(s.alias("y"), F.col("b") == F.col("y.rep"))
             .where(100 * F.least("x.n_shingles", "y.n_shingles") >= percent * F.greatest("x.n_shingles", "y.n_shingles"))
             .where(estimate_from_differing(_differing("x", "y")) >= least).select("a", "b").distinct())
    stars = stored(stars, "minhash-stars")
    ids = buckets.select(F.col("rep").alias("doc_id")).union(buckets.select(F.col("lead").alias("doc_id"))).distinct()
    texts = stored(docs.join(ids, "doc_id", "left_semi"), "minhash-texts")
    links = stored(confirmed(stars, texts, width, percent), "minhash-links")
    found = stored(components(links, "minhash-first"), "minhash-first")

    placed = buckets.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    members = placed.join(mixed.select("key"), "key", "left_semi").join(s, "rep").select(
        "key", "rep", "component", "n_shingles", *words64)
    members = stored(members, "minhash-members")
    still = _open_members(members, percent)
    open_rows = members.join(still, ["key", "rep"]).join(texts.withColumnRenamed("doc_id", "rep"), "rep").select(
        "key", "rep", "component", "n_shingles", *words64, "text")
    more = stored(_joining_links(open_rows, width, percent), "minhash-joining")
    groups = components(links.union(more), "minhash-all")

    of_class = classes.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select(
        "f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("component"))
    return sig.select("doc_id", "n_shingles", "f1", "f2").join(of_class, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
