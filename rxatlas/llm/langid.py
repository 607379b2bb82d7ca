"""Language identification with bit-sliced Bloom filters over character n-grams.

One table of bit masks serves all languages: bit l of an entry, in as many
64-bit words as the languages need, belongs to the filter of language l. The masks at an n-gram's HASHES positions, combined by
AND, are the set of all languages that may contain it. A document's decision
needs one popcount per language, corrected for the filter's false positives.

Learning takes a bounded sample of labelled documents per language
(``SAMPLE_DOCS``, by hash of the id), each with its whole text; an n-gram enters a language's filter when
at least ``MIN_DOCS`` of the sampled documents hold it and its share there is
at least ``MIN_SHARE`` of its share in the language where it is most common.
A language with fewer than ``MIN_DOCS`` documents keeps all its n-grams and
takes none from others. A filter has room for ``CAPACITY`` n-grams; of a language
with more, those that most sampled documents hold enter. Letters are those of the Unicode category.
Everything that is scored is scored over whole texts.

Defined cases: null text or text without a letter is ``und`` with score 0; a
text whose n-grams no language holds gets the first language by name and score
0; ties go to the first name; rows are independent, repeated rows are kept;
no labelled rows at all make every document ``und``; null ids fold as the empty
text; an empty table gives an empty table; further columns are left behind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rxatlas.llm import text as tx
from rxatlas.llm.common import columns, fold, stored

U = np.uint64
SAMPLE_DOCS = 1000
#: N-grams of one language's filter, and n-grams that a task holds while counting.
CAPACITY, HELD = 300_000, 1_000_000
MIN_DOCS, MIN_SHARE = 2, 0.2
SIZES = (2, 3, 4)
TABLE_BITS = 20
HASHES = 3

_r = np.random.RandomState(66)
LETTER_VALUE = _r.randint(1, 2**63 - 1, 0x3000, dtype=np.int64).astype(U) | U(1)


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: the lower-cased code point of a letter, and whether it is one."""
    low, letter = np.arange(0x110000, dtype=np.int32), np.array([chr(c).isalpha() for c in range(0x110000)])
    for c in np.flatnonzero(letter).tolist():
        x = chr(c).lower()
        if len(x) == 1 and (c < 0x3000) == (ord(x) < 0x3000):
            low[c] = ord(x)
    return low, letter


_LOW, _LETTER = _letters()


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the letter n-grams of each text, where each text's begin, and
    whether a text has a letter. A run of letters is bounded by one blank on
    either side; other characters only separate."""
    n = len(texts)
    buf, at = tx.flat(texts)
    lead = (buf & 0xC0) != 0x80
    if not len(buf):
        return np.zeros(0, U), np.zeros(n + 1, np.int64), np.zeros(n, bool)
    code = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begin = np.concatenate(([0], np.cumsum(lead)))[at]
    letter, low = _LETTER[code], _LOW[code]
    value = np.where(code < 0x3000, LETTER_VALUE[np.minimum(low, 0x2FFF)], tx.mix(low.astype(U)))
    # one blank (value 1) in front of every run of letters, one after each text's last
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    edge = np.zeros(len(code) + 1, bool)
    edge[begin] = True
    first |= letter & edge[:len(code)]
    owner_ptr = np.concatenate(([0], np.cumsum(letter.astype(np.int64) + first)))[begin]
    has = np.diff(owner_ptr) > 0
    where = np.flatnonzero(letter)
    shift = np.cumsum(first[where])
    out_ptr = owner_ptr + np.concatenate(([0], np.cumsum(has)))
    doc = np.searchsorted(begin, where, "right") - 1
    stream = np.ones(out_ptr[-1], U)
    stream[np.arange(len(where)) + shift + (np.cumsum(has)[doc] - 1)] = value[where]
    m = len(stream)
    end = np.repeat(out_ptr[1:], np.diff(out_ptr))
    pos = np.arange(m)
    hashes, docs = [], []
    owner = np.repeat(np.arange(n), np.diff(out_ptr))
    run = stream.copy()
    blank = stream == 1
    inside = ~blank
    for k in range(1, max(SIZES)):
        nxt = np.ones(m, U)
        nxt[:m - k] = stream[k:]
        run = tx.combine(run, nxt)
        # a gram may begin or end with a blank, but not have one inside
        if k >= 2:
            mid = np.zeros(m, bool)
            mid[:m - k + 1] = inside[k - 1:]
            ok_mid = mid if k == 2 else ok_mid & mid
        else:
            ok_mid = np.ones(m, bool)
        if k + 1 in SIZES:
            ok = ok_mid & (pos + k < end)
            hashes.append(run[ok])
            docs.append(owner[ok])
    h, d = np.concatenate(hashes), np.concatenate(docs)
    order = np.argsort(d, kind="stable")
    return h[order], np.concatenate(([0], np.cumsum(np.bincount(d, minlength=n)))), has


def positions(h: np.ndarray) -> list[np.ndarray]:
    x = tx.mix(h)
    step = (x >> U(32)) | U(1)
    return [((x + U(k) * step) & U((1 << TABLE_BITS) - 1)) for k in range(HASHES)]


class Filters:
    """The table of masks, the languages by bit, and each filter's false-positive rate."""

    def __init__(self, languages: list[str], grams_of: list[np.ndarray]):
        self.languages = languages
        self.table = np.zeros((max(1, -(-len(languages) // 64)), 1 << TABLE_BITS), U)
        for k, h in enumerate(grams_of):
            for p in positions(h):
                self.table[k // 64, p] |= U(1 << k % 64)
        fill = [float((self.table[k // 64] >> U(k % 64) & U(1)).mean()) for k in range(len(languages))]
        self.false = np.array(fill) ** HASHES

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n, langs = len(texts), len(self.languages)
        count, total, has = np.zeros((langs, n)), np.zeros(n), np.zeros(n, bool)
        for s in range(0, n, 64):
            h, ptr, own = grams(texts.slice(s, 64))
            has[s:s + 64], total[s:s + 64] = own, np.diff(ptr)
            if not langs or not len(h):
                continue
            p = positions(h)
            full = np.flatnonzero(np.diff(ptr))
            for w, table in enumerate(self.table):
                mask = table[p[0]]
                for q in p[1:]:
                    mask &= table[q]
                for k in range(64 * w, min(langs, 64 * w + 64)):
                    count[k, s + full] = np.add.reduceat((mask >> U(k % 64) & U(1)).astype(np.int64), ptr[full])
        if not langs:
            return ["und"] * n, np.zeros(n)
        share = (count / np.maximum(total, 1) - self.false[:, None]) / (1 - self.false[:, None])
        best = np.argmax(np.round(share, 12), axis=0)
        score = np.clip(share[best, np.arange(n)], 0, 1)
        return ["und" if not has[i] else self.languages[best[i]] for i in range(n)], np.where(has, score, 0.0)


def learn(docs: DataFrame) -> Filters:
    """Filters from the labelled rows of ``docs`` (doc_id, text, lang), a
    bounded sample per language; n-grams are counted in Spark, a document at
    most once each."""
    rows = docs.where("text is not null and lang is not null")
    names = sorted(r.lang for r in rows.select("lang").distinct().collect())  # one row a language
    if not names:
        return Filters([], [])
    order = W.partitionBy("lang").orderBy("h", "doc_id")
    # per split the smallest hashes first, so that no task gathers a whole language
    near = rows.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(6)).alias("h"))
    part = near.withColumn("p", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(64)))
    few = (part.withColumn("r", F.row_number().over(W.partitionBy("lang", "p").orderBy("h", "doc_id")))
           .where(F.col("r") <= SAMPLE_DOCS).withColumn("r", F.row_number().over(order)).where(F.col("r") <= SAMPLE_DOCS))
    few = F.broadcast(few.select("doc_id").distinct())  # at most SAMPLE_DOCS ids a language
    sample = rows.join(few, "doc_id", "left_semi").select("doc_id", "lang", "text")
    index = {x: k for k, x in enumerate(names)}

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # language, n-gram, documents
        n = 0

        def merged():
            of, g, count = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((g, of))
            of, g, count = of[order], g[order], count[order]
            first = np.ones(len(g), bool)
            first[1:] = (g[1:] != g[:-1]) | (of[1:] != of[:-1])
            at = np.flatnonzero(first)
            return of[at], g[at], np.add.reduceat(count, at)

        def rows(x):
            return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1].view(np.int64)), pa.array(x[2])], names=["lang", "gram", "docs"])

        for b in batches:
            langs = b.column("lang").to_pylist()
            for s in range(0, b.num_rows, 16):
                h, ptr, _ = grams(b.column("text").slice(s, 16))
                for k, x in enumerate(langs[s:s + 16]):
                    own = np.unique(h[ptr[k]:ptr[k + 1]])  # a document counts once
                    held.append((np.full(len(own), index[x], np.int32), own, np.ones(len(own), np.int64)))
                    n += len(own)
                if n > HELD:
                    x = merged()
                    if len(x[0]) > HELD // 2:
                        yield rows(x)
                        held, n = [], 0
                    else:
                        held, n = [x], len(x[0])
        if n:
            yield rows(merged())

    size = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    counted = sample.mapInArrow(run, "lang int, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    sizes = F.broadcast(docs.sparkSession.createDataFrame([(k, size.get(x, 1)) for k, x in enumerate(names)], "lang int, size long"))
    least = min(MIN_DOCS, max(1, max(size.values(), default=0) // 4))
    counted = counted.join(sizes, "lang").where(F.col("docs") >= F.least(F.lit(least), "size"))
    share = counted.withColumn("share", F.col("docs") / F.col("size"))
    best = share.groupBy("gram").agg(F.max(F.when(F.col("size") >= least, F.col("share"))).alias("best"))
    kept = share.join(best, "gram").where(F.col("share") >= MIN_SHARE * F.coalesce("best", F.lit(0.0)))
    kept = stored(kept.select("lang", "gram", "docs"), "languages")
    least_docs = dict.fromkeys(range(len(names)), 1)
    fill = dict.fromkeys(range(len(names)), 0)
    for r in kept.groupBy("lang", "docs").count().orderBy("lang", F.desc("docs")).collect():  # at most SAMPLE_DOCS rows a language
        fill[r.lang] += r["count"]
        if fill[r.lang] > CAPACITY:
            least_docs[r.lang] = max(least_docs[r.lang], r.docs + 1)
    room = F.broadcast(docs.sparkSession.createDataFrame(list(least_docs.items()), "lang int, least long"))
    got = kept.join(room, "lang").where("docs >= least").select("lang", "gram").toArrow()  # at most CAPACITY a language
    lang, gram = got.column("lang").to_numpy(), got.column("gram").to_numpy().view(U)
    return Filters(names, [gram[lang == k] for k in range(len(names))])


def identify(docs: DataFrame, filters: Filters, *keep: str) -> DataFrame:
    """(doc_id, ``keep``..., lang_pred, score) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)  # 8 MB for each 64 languages, whatever the input
    schema = docs.select("doc_id", *keep).schema.add("lang_pred", "string").add("lang_score", "double")

    def run(batches):
        f = sent.value
        for b in batches:
            names, score = f.predict(b.column("text"))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", *keep)], pa.array(names, pa.string()), pa.array(score)],
                                             names=["doc_id", *keep, "lang_pred", "lang_score"])

    return docs.mapInArrow(run, schema)


def language_of(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from rows whose fold is not 0."""
    d = columns(docs, doc_id="long", text="string", lang="string")
    d = d.withColumn("held_out", fold("doc_id", 5) == 0)
    filters = learn(d.where("not held_out"))
    return identify(d.select("doc_id", "held_out", "text"), filters, "held_out").withColumnRenamed("lang_score", "score")
