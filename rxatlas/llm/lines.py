"""Lines that many documents repeat, dropped from all but one of them.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
lower-cased. Keys of at least ``least_chars`` code points found in at least
``least_docs`` documents lose all their lines except in the document with the
largest doc_id that holds them.

Two Bloom filters decide which lines need to be compared at all. Every task
reduces its keys to filter positions; the positions are dealt to the blocks of
the filter, where a position met for the first time is set in the once-seen
filter and one met again (by another task, or marked as repeated inside one) in
the twice-seen filter. A key whose positions are not all in the twice-seen
filter occurs in one document only. The others, some of them by chance, are
counted inside the tasks and then shuffled as whole text, which confirms them
exactly: no hash decides what is dropped. A very common line is one row per
task by then.

The twice-seen filter goes to the workers while its compressed blocks stay
within ``filter_bytes`` (about 2.5 bits a distinct line: the default holds some
200 million); beyond that no filter is sent and every key counts as a suspect.
The confirmed keys go to the workers within ``table_bytes``; beyond that the
documents meet them in joins, first on the key, then on doc_id. Either way the
rows are the same.

Defined cases: null text is one empty line. Every row counts as a document; all
rows of the largest doc_id keep the line. Rows without a doc_id count and lose
lines as others do, but are never the keeper; a line that only they hold stays.
An empty table gives an empty table. Further columns are left behind. A text is
held whole by one worker.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm.common import columns, stored

BLANK = " \t\n\v\f\r"
#: Filter bits for each line; a block of the filter has 2**BLOCK_BITS.
BITS_PER_LINE, BLOCK_BITS, MOST_BITS = 10, 18, 32
FILTER_BYTES, TABLE_BYTES = 64 << 20, 32 << 20
#: A task hands on what it holds beyond so many keys, or bytes of them.
HELD_KEYS, HELD_BYTES = 1_000_000, 64 << 20
U = np.uint64


def keys_of(text: str, least_chars: int) -> tuple[list[str], list[bytes | None]]:
    """The lines of a text, and the key of each that is long enough."""
    lines = text.split("\n")
    return lines, [k.encode().lower() if len(k := line.strip(BLANK)) >= least_chars else None for line in lines]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([hashlib.blake2b(k, digest_size=8).digest() for k in keys]), "<u8")


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """The two filter positions of each hash, one row a hash."""
    mask = U((1 << bits) - 1)
    return np.stack((h & mask, (h >> U(32)) & mask), 1)


def filter_bits(lines: int) -> int:
    """Logarithm of the filter's size: a power of two of at least BITS_PER_LINE a line."""
    return min(MOST_BITS, max(BLOCK_BITS, (BITS_PER_LINE * lines - 1).bit_length()))


def twice_seen(docs: DataFrame, bits: int, least_chars: int) -> DataFrame:
    """(block, filter): the twice-seen filter's blocks, packed and compressed."""
    def mark(batches):
        held, n = [], 0

        def rows():
            h, count = np.unique(np.concatenate(held), return_counts=True)
            once, twice = np.unique(_positions(h, bits)), np.unique(_positions(h[count > 1], bits))
            block = np.unique(once >> U(BLOCK_BITS))
            edge = block << U(BLOCK_BITS)
            cut = [np.append(np.searchsorted(x, edge), len(x)) for x in (once, twice)]
            part = [(x & U((1 << BLOCK_BITS) - 1)).astype("<u4") for x in (once, twice)]
            # twice is a part of once, so its blocks are among these
            return pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32))] + [
                pa.array([x[s:e].tobytes() for s, e in zip(c[:-1], c[1:])], pa.binary()) for x, c in zip(part, cut)],
                names=["block", "once", "twice"])

        for b in batches:
            for t in b.column("text").to_pylist():
                own = {k for k in keys_of(t, least_chars)[1] if k} if t else ()
                if own:
                    held.append(_hashes(list(own)))
                    n += len(own)
                if n >= HELD_KEYS:
                    yield rows()
                    held, n = [], 0
        if held:
            yield rows()

    def fold(key, group):
        once, twice = np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
        for o, t in zip(group.column("once").to_pylist(), group.column("twice").to_pylist()):
            o = np.frombuffer(o, "<u4")
            twice[o[once[o]]] = True
            once[o] = True
            twice[np.frombuffer(t, "<u4")] = True
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                         "filter": pa.array([zlib.compress(np.packbits(twice).tobytes(), 1)], pa.binary())})

    marks = docs.mapInArrow(mark, "block int, once binary, twice binary")
    return marks.groupBy("block").applyInArrow(fold, "block int, filter binary")


class Twice:
    """The twice-seen filter; a worker unpacks the blocks it is sent once."""

    def __init__(self, bits: int, blocks: list[tuple[int, bytes]]):
        self.bits, self.blocks, self.bytes = bits, blocks, None

    def _unpack(self) -> None:
        self.bytes = np.zeros(1 << (self.bits - 3), np.uint8)
        size = 1 << (BLOCK_BITS - 3)
        for k, data in self.blocks:
            self.bytes[k * size:(k + 1) * size] = np.frombuffer(zlib.decompress(data), np.uint8)
        self.blocks = []

    def holds(self, h: np.ndarray) -> np.ndarray:
        if self.bytes is None:
            self._unpack()
        p = _positions(h, self.bits)
        return ((self.bytes[p >> U(3)] >> (U(7) - (p & U(7))).astype(np.uint8)) & 1).all(1)


def suspects(docs: DataFrame, sent, least_chars: int) -> DataFrame:
    """(key, n, top): keys that the filter (all, where ``sent`` is None) holds,
    with a task's number of documents and the largest doc_id of them."""
    def run(batches):
        twice = sent.value if sent else None
        held: dict[bytes, list] = {}
        size = 0

        def rows():
            n, top = zip(*held.values())
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(n, pa.int64()), pa.array(top, pa.int64())],
                                              names=["key", "n", "top"])

        for b in batches:
            ids, own, of = b.column("doc_id").to_pylist(), [], []
            for i, t in zip(ids, b.column("text").to_pylist()):
                if t:
                    found = {k for k in keys_of(t, least_chars)[1] if k}
                    own.extend(found)
                    of.extend([i] * len(found))
            keep = twice.holds(_hashes(own)).tolist() if twice and own else [True] * len(own)
            for k, i, ok in zip(own, of, keep):
                if ok:
                    e = held.get(k)
                    if e is None:
                        held[k] = [1, i]
                        size += len(k) + 200
                    else:
                        e[0] += 1
                        if i is not None and (e[1] is None or i > e[1]):
                            e[1] = i
                    if size > HELD_BYTES:
                        yield rows()
                        held, size = {}, 0
        if held:
            yield rows()

    return docs.mapInArrow(run, "key binary, n long, top long")


SCHEMA = "doc_id long, n_lines long, n_dropped long, text string"


def _cut(ids, texts, least_chars: int, loses) -> pa.RecordBatch:
    """Lines for which ``loses(row, doc_id, key)`` holds go."""
    n_lines, n_dropped, kept = [], [], []
    for row, (i, t) in enumerate(zip(ids, texts)):
        lines, keys = keys_of(t or "", least_chars)
        gone = [k is not None and loses(row, i, k) for k in keys]
        n_lines.append(len(lines))
        n_dropped.append(sum(gone))
        kept.append("\n".join([x for x, g in zip(lines, gone) if not g]) if n_dropped[-1] else t or "")
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                                       pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])


def _by_table(docs: DataFrame, sent, least_chars: int) -> DataFrame:
    def run(batches):
        top = sent.value
        for b in batches:
            yield _cut(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), least_chars,
                       lambda _, i, k: top.get(k, i) != i)
    return docs.mapInArrow(run, SCHEMA)


def _by_join(docs: DataFrame, frequent: DataFrame, least_chars: int) -> DataFrame:
    def held(batches):
        for b in batches:
            ids, own = [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                found = {k for k in keys_of(t, least_chars)[1] if k} if t else ()
                own.extend(found)
                ids.extend([i] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array(ids, pa.int64())], names=["key", "id"])

    def run(batches):
        for b in batches:
            gone = [set(x or ()) for x in b.column("gone").to_pylist()]
            yield _cut(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), least_chars, lambda row, _, k: k in gone[row])

    lost = docs.mapInArrow(held, "key binary, id long").join(frequent, "key").where("not id <=> top")
    lost = lost.groupBy("id").agg(F.collect_set("key").alias("gone"))
    return docs.join(lost, docs.doc_id.eqNullSafe(lost.id), "left").select("doc_id", "text", "gone").mapInArrow(run, SCHEMA)


def drop_repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, filter_bytes: int = FILTER_BYTES,
                        table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) per row of ``docs`` (doc_id, text):
    lines before dropping, lines dropped, and what is left."""
    spark = docs.sparkSession
    docs = columns(docs, doc_id="long", text="string")
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    bits = filter_bits(lines)
    blocks = stored(twice_seen(docs, bits, least_chars), "lines-filter")
    size = blocks.agg(F.sum(F.length("filter"))).first()[0] or 0
    sent = spark.sparkContext.broadcast(Twice(bits, [(k, bytes(x)) for k, x in blocks.collect()])) if size <= filter_bytes else None
    found = suspects(docs, sent, least_chars).groupBy("key").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    frequent = stored(found.where((F.col("n") >= least_docs) & F.col("top").isNotNull()).select("key", "top"), "lines-frequent")
    size = frequent.agg(F.sum(F.length("key") + 100)).first()[0] or 0
    if size <= table_bytes:
        return _by_table(docs, spark.sparkContext.broadcast({bytes(k): t for k, t in frequent.collect()}), least_chars)
    return _by_join(docs, frequent, least_chars)
