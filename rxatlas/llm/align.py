"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are grouped by their full text; a text that many documents hold is
tokenized and aligned once and counts as often as it occurs. A, a byte-level
BPE, encodes space+text; B, a BPE over pieces, encodes the text and adds the
space itself. Both cut the same bytes, so the ends of all tokens of a task's
texts lie on one line, and the alignment is array steps on it: ends of both are
the cuts between groups, and every stretch between neighbouring ends of either
one is the overlap of exactly one A and one B token, a link.

What is stored of a text is its distinct id pairs with their counts, sorted and
packed. Pair counts are summed inside tasks, then shuffled by pair. The counts
go to the workers while they stay within ``table_bytes``; beyond that the texts'
pairs meet them in a join on the pair. Measures reach the documents in a join on
the text's SHA-256; one text held by a third of all documents is one row on that
join's other side, and the adaptive plan splits the documents' side.

Defined cases: texts that are null, empty, or whose tokens don't join to
space+text have no tokens: zeros and '' for the groups. Special tokens' strings
are plain text. Rows are independent: null and repeated ids are kept, and each
row counts. Empty tables give empty tables; further columns are left behind. A
text is tokenized whole, so a worker's memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm.bpe import byte_symbols
from rxatlas.llm.common import columns, stored

#: Fixed value: how the byte-level BPE splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts aligned together, in characters; pairs that a task holds before it sums them; bytes of pair counts sent to workers.
CHUNK_CHARS, HELD_PAIRS, TABLE_BYTES = 2_000_000, 4_000_000, 32 << 20
#: Bytes of a pair, its count and its mark.
ROW_BYTES = 17
#: A run of white space beyond this goes to the slower library, as the faster one's split pattern backtracks over it.
LONG_RUN = 10_000
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Tokenizers:
    """A from the file ``a_path`` (byte-level BPE), B from ``b_path`` (pieces)."""

    def __init__(self, a_path: str, b_path: str):
        import regex
        import sentencepiece
        import tiktoken
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        self.a_path, self.library = a_path, None
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.a_bytes[list(ranks.values())] = [len(t) for t in ranks]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.pieces = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = np.array([len(p) for p in self.pieces], np.int64)
        self.n_b = len(self.pieces)
        self.long_run = regex.compile(r"\s{%d}" % LONG_RUN)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> np.ndarray:
        if len(text) <= LONG_RUN or not self.long_run.search(text):
            return self.a.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.a_path)
            self.library.encode_special_tokens = True
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by A and by B; none where the tokens don't join to space+text."""
        ids_a, ids_b = [], []
        for t, own in zip(texts, self.b.encode(texts, num_threads=1)):
            raw = (" " + t).encode()
            a = self.encode_a(" " + t)
            same = b"".join([self.pieces[i] for i in own]) == raw and int(self.a_bytes[a].sum()) == len(raw)
            ids_a.append(a if same else a[:0])
            ids_b.append(np.array(own if same else [], np.int64))
        return ids_a, ids_b


_loaded: dict[tuple[str, str], Tokenizers] = {}


def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


def _written(ids: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each with its separator behind it, as bytes; the end of each."""
    width = len(str(int(ids.max(initial=0))))
    out = np.empty((len(ids), width + 1), np.uint8)
    rest = ids.astype(np.int64)
    for k in range(width - 1, -1, -1):
        out[:, k] = 48 + rest % 10
        rest = rest // 10
    out[:, width] = sep
    size = np.searchsorted(10 ** np.arange(1, width), ids, "right") + 1
    return out[np.arange(width + 1) >= width - size[:, None]], np.cumsum(size + 1)


class Alignment:
    """The alignment of several texts: ids_a, ids_b of each."""

    def __init__(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray], a_bytes: np.ndarray, b_bytes: np.ndarray):
        n = len(ids_a)
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64) for ids in (ids_a, ids_b))
        end_a, end_b = np.cumsum(a_bytes[a]), np.cumsum(b_bytes[b])
        last_a = np.concatenate(([0], end_a))[np.cumsum(self.n_a)]  # where each text ends
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        ends = np.union1d(end_a, end_b)
        self.a, self.b = a[np.searchsorted(end_a, ends)], b[np.searchsorted(end_b, ends)]
        self.links = np.concatenate(([0], np.searchsorted(ends, last_a, "right")))
        self.n_groups = np.diff(np.concatenate(([0], np.searchsorted(common, last_a, "right"))))
        self.n_links = np.diff(self.links)
        # groups as text: the A ids of a group, then its B ids
        upto_a, upto_b = np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right")
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        at_a = np.arange(len(a)) + np.concatenate(([0], upto_b))[group_a]
        at_b = np.arange(len(b)) + upto_a[group_b]
        ids, sep = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        sep[at_a[upto_a - 1]], sep[at_b[upto_b - 1]] = ord("|"), ord(";")
        text, end = _written(ids, sep)
        cut = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))]
        raw = text.tobytes()
        self.groups = [raw[s:e - 1].decode() if e > s else "" for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]
        assert len(self.groups) == n


def pack_pairs(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs as differences, and counts; bytes of equal weight together, compressed."""
    wide = np.concatenate((np.diff(pairs, prepend=0), counts)).astype("<u8")
    return zlib.compress(wide.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    wide = np.ascontiguousarray(raw.T).view("<u8").ravel().astype(np.int64)
    return np.cumsum(wide[:len(wide) // 2]), wide[len(wide) // 2:]


def _chunks(texts: list[str]):
    s, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield s, k
            s, size = k, 0
        size += len(t)
    if s < len(texts):
        yield s, len(texts)


ALIGNED = "key string, n long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary"


def align_texts(texts: DataFrame, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """One row per row of ``texts`` (key, text, n): the alignment, its groups as
    'a1,a2|b1;a3|b2,b3' (decimal ids in order; with ``digest`` the SHA-256 of
    that, '' without tokens), its id pairs packed."""
    def run(batches):
        both = _tokenizers(a_path, b_path)
        for batch in batches:
            all_texts = batch.column("text").to_pylist()
            for s, e in _chunks(all_texts):
                x = Alignment(*both.encode(all_texts[s:e]), both.a_bytes, both.b_bytes)
                pair = x.a * both.n_b + x.b
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in x.groups] if digest else x.groups
                pairs = [pack_pairs(*np.unique(pair[i:j], return_counts=True)) for i, j in zip(x.links[:-1], x.links[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(s, e - s), batch.column("n").slice(s, e - s), *map(pa.array, (x.n_a, x.n_b, x.n_groups, x.n_links)),
                     pa.array(groups, pa.string()), pa.array(pairs, pa.binary())], names=[c.split()[0] for c in ALIGNED.split(", ")])

    return texts.select("key", "text", "n").mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): links of each id pair over all texts, repeated ones as often as they occur."""
    def run(batches):
        keys, counts, held = [], [], 0

        def merged():
            k, back = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(k), np.int64)
            np.add.at(total, back, np.concatenate(counts))
            return k, total

        for b in batches:
            for n, data in zip(b.column("n").to_pylist(), b.column("pairs").to_pylist()):
                k, c = unpack_pairs(data)
                keys.append(k)
                counts.append(c * n)
                held += len(k)
                if held > HELD_PAIRS:
                    k, c = merged()
                    if len(k) > HELD_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["pair", "n"])
                        k, c = k[:0], c[:0]
                    keys, counts, held = [k], [c], len(k)
        if held:
            k, c = merged()
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["pair", "n"])

    return aligned.select("n", "pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _measured_by_table(aligned: DataFrame, table) -> DataFrame:
    def run(batches):
        pair, count, best = table.value
        for b in batches:
            n_best, total = [], []
            for data in b.column("pairs").to_pylist():
                k, c = unpack_pairs(data)
                at = np.searchsorted(pair, k)
                n_best.append(int(c[best[at]].sum()))
                total.append(int((c * count[at]).sum()))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())],
                                             names=["key", "n_best", "count_sum"])
    return aligned.select("key", "pairs").mapInArrow(run, "key string, n_best long, count_sum long")


def _measured_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for key, data in zip(b.column("key").to_pylist(), b.column("pairs").to_pylist()):
                k, c = unpack_pairs(data)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(k), pa.string()), pa.array(k), pa.array(c)], names=["key", "pair", "links"])
    pairs = aligned.select("key", "pairs").mapInArrow(run, "key string, pair long, links long").join(counts, "pair")
    return pairs.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                                    F.sum(F.col("links") * F.col("n")).alias("count_sum"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, digest: bool = False, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row
    of ``docs`` (doc_id, text). n_best: links whose pair is the commonest of its
    B id over all rows, ties included; count_sum: the sum of the links' counts.
    groups are several times a text's size: with ``digest`` only their SHA-256
    leaves the task that aligns the text."""
    import sentencepiece
    spark = docs.sparkSession
    docs = columns(docs, doc_id="long", text="string")
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    filled = F.length("text") > 0
    texts = docs.where(filled).groupBy("text").agg(F.count("*").alias("n")).withColumn("key", F.sha2("text", 256))
    aligned = stored(align_texts(texts, a_path, b_path, digest), "align-texts")
    counts = pair_counts(aligned).withColumn("b", F.col("pair") % n_b)
    counts = stored(counts, "align-counts")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))  # a row for each id of B at most
    counts = counts.join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    if counts.count() * ROW_BYTES <= table_bytes:
        t = counts.orderBy("pair").toArrow()
        table = spark.sparkContext.broadcast(tuple(t.column(c).to_numpy() for c in ("pair", "n", "best")))
        measured = _measured_by_table(aligned, table)
    else:
        measured = _measured_by_join(aligned, counts)
    found = aligned.drop("n", "pairs").join(measured, "key", "left")
    found = docs.where(filled).select("doc_id", F.sha2("text", 256).alias("key")).join(found, "key", "left")
    none = docs.where(~F.coalesce(filled, F.lit(False)))
    out = found.select("doc_id", *COUNTS, "groups").unionByName(none.select("doc_id", F.lit("").alias("groups")), allowMissingColumns=True)
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], "groups")
