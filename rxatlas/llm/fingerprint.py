"""Homomorphic multiset fingerprints of texts.

A text is the multiset of its paragraphs (lines that are not blank). Each
paragraph is hashed to a wide vector and the vectors are summed, lane by lane,
modulo a power of two: paragraphs may come in any order, and adding or removing
one is an addition or a subtraction on the fingerprint alone.

The vector has two parts. EXACT lanes modulo 2**64 are a 512-bit digest of the
paragraph: equal multisets have equal sums, others practically never. NEAR
lanes modulo 2**32 are sums of random signs over the paragraph's word pairs:
their inner products estimate how much two texts share, also where a paragraph
was changed in part. With 128 of them the estimate's standard error is about
0.09 for texts of equal length that share little, and less the more they share.

Defined cases: null text is empty; the empty multiset is all zeros and like
itself only; texts that differ in the order of paragraphs or in blank lines are
equal; rows that share a doc_id follow each other in the order of their text;
a null doc_id counts as smaller than any other, so rows without an id follow each
other by text in one range, which a table with very many of them makes long. An
empty table gives an empty table; further columns are left behind.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm import text as tx
from rxatlas.llm.common import columns

U = np.uint64
EXACT, NEAR = 8, 128
LEAST_ID = -(1 << 63)
#: Ranges of ids per shuffle partition.
RANGES = 4


class Fingerprints:
    """Exact lanes uint64[n, EXACT] and near lanes uint32[n, NEAR] of n texts."""

    def __init__(self, exact: np.ndarray, near: np.ndarray):
        self.exact, self.near = exact, near

    @classmethod
    def of(cls, texts: list[str]) -> Fingerprints:
        n = len(texts)
        exact, near = np.zeros((n, EXACT), U), np.zeros((n, NEAR), np.uint32)
        split = [[p for p in t.split("\n") if p and not p.isspace()] for t in texts]
        ptr = np.concatenate(([0], np.cumsum([len(x) for x in split])))
        parts = [p for x in split for p in x]
        full = np.flatnonzero(np.diff(ptr))
        if not len(full):
            return cls(exact, near)
        digest = b"".join([hashlib.blake2b(p.encode()).digest() for p in parts])
        exact[full] = np.add.reduceat(np.frombuffer(digest, "<u8").reshape(-1, EXACT), ptr[full], axis=0)
        h, at = tx.shingles(*tx.words(pa.array(parts, pa.large_string())), 2)
        at = at[ptr]
        for s, e in tx.pieces(at, 1 << 15):
            own = np.flatnonzero(np.diff(at[s:e + 1])) + s
            if not len(own):
                continue
            x = h[at[s]:at[e]]
            bits = np.unpackbits(np.stack([tx.mix(x + U(k * 0x51ED27)) for k in range(1, NEAR // 64 + 1)], 1).view(np.uint8), axis=1)
            ones = np.add.reduceat(bits, at[own] - at[s], axis=0, dtype=np.int32)
            near[own] = (2 * ones - np.diff(at)[own, None]).astype(np.int64).astype(np.uint32)
        return cls(exact, near)

    def __add__(self, other: Fingerprints) -> Fingerprints:
        """Insertion of the other's paragraphs."""
        return Fingerprints(self.exact + other.exact, self.near + other.near)

    def __sub__(self, other: Fingerprints) -> Fingerprints:
        """Removal of the other's paragraphs."""
        return Fingerprints(self.exact - other.exact, self.near - other.near)

    def take(self, rows) -> Fingerprints:
        return Fingerprints(self.exact[rows], self.near[rows])

    def likeness(self, other: Fingerprints) -> np.ndarray:
        """Estimated 2 * shared / (one's + other's) of the word pairs; 1 for equal multisets."""
        a, b = self.near.astype(np.int32).astype(float), other.near.astype(np.int32).astype(float)
        total = (a * a).sum(1) + (b * b).sum(1)
        shared = np.clip(2 * (a * b).sum(1) / np.maximum(total, 1), 0, 1)
        return np.where((self.exact == other.exact).all(1), 1.0, shared)

    def hex(self) -> list[str]:
        """Text form: the lanes in order, little-endian."""
        wide = np.concatenate((np.ascontiguousarray(self.exact).astype("<u8").view(np.uint8), np.ascontiguousarray(self.near).astype("<u4").view(np.uint8)), axis=1)
        return [x.tobytes().hex() for x in wide]


def edited(text: str, following: str) -> str:
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def with_next(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows (bucket, role, k, doc_id, text), dealt out by ranges of ids and
    sorted: after the rows of a range (role 0) comes a copy of the row that
    follows it (role 1), after the last range the very first. One shuffle of
    the texts; no task holds more than its ranges."""
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("k"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # percentiles are ids of rows, so each is the first of its range; as many as ranges
    got = keyed.agg(F.min("k").alias("low"), F.percentile_approx("k", [i / n for i in range(1, n)], 100 * n).alias("cuts")).first()
    starts = np.array(sorted({got.low, *got.cuts}) if got.low is not None else [0], np.int64)

    def run(batches):
        for b in batches:
            k = b.column("k").to_numpy()
            bucket = np.searchsorted(starts, k, "right") - 1
            head = np.flatnonzero(starts[bucket] == k)
            rows = np.concatenate((np.arange(len(k)), head))
            where = np.concatenate((bucket, (bucket[head] - 1) % len(starts)))
            role = np.concatenate((np.zeros(len(k), np.int32), np.ones(len(head), np.int32)))
            t = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(role), *[t.column(c) for c in ("k", "doc_id", "text")]],
                                             names=["bucket", "role", "k", "doc_id", "text"])

    dealt = keyed.mapInArrow(run, "bucket int, role int, k long, doc_id long, text string")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "role", "k", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) for every row of ``docs`` (doc_id, text)."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def table(bucket, role, ids, texts):
        f = Fingerprints.of(texts)
        i = np.flatnonzero((role[:-1] == 0) & (bucket[1:] == bucket[:-1]))
        changed = [edited(texts[k], texts[k + 1]) for k in i]
        g = Fingerprints.of(changed)
        own = f.take(i)
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[k] for k in i], pa.int64()), pa.array([len(texts[k]) for k in i], pa.int64()),
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
             pa.array(own.hex(), pa.string()), pa.array(g.hex(), pa.string()), pa.array(own.likeness(g)), pa.array(own.likeness(f.take(i + 1)))],
            names=[x.split()[0] for x in schema.split(", ")])

    def run(batches):
        last = None
        for b in batches:
            for s in range(0, b.num_rows, 200):
                c = b.slice(s, 200)
                bucket, role = c.column("bucket").to_numpy(), c.column("role").to_numpy()
                ids, texts = c.column("doc_id").to_pylist(), c.column("text").to_pylist()
                if last is not None:
                    bucket, role = np.append(last[0], bucket), np.append(last[1], role)
                    ids, texts = [last[2], *ids], [last[3], *texts]
                last = bucket[-1], role[-1], ids[-1], texts[-1]
                yield table(bucket, role, ids, texts)

    return with_next(columns(docs, doc_id="long", text="string")).mapInArrow(run, schema)
