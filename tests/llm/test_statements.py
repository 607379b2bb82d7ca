"""Brute force for language filters, packing and fingerprint likeness; extra columns and empty tables."""
import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rxatlas.llm import common, langid, packing, text as tx
from rxatlas.llm.fingerprint import Fingerprints
from rxatlas.llm.hosts import judge
from rxatlas.llm.ngram import language_model_scores
from rxatlas.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark):
    common.prepare(spark)
    return spark


def own_grams(text):
    """Letter n-grams of two to four, words bounded by a blank; blanks inside only at the ends."""
    out, words, word = [], [], ""
    for c in (text or "") + " ":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            words.append(word)
            word = ""
    stream = " " + " ".join(words) + " " if words else ""
    for n in langid.SIZES:
        for k in range(len(stream) - n + 1):
            g = stream[k:k + n]
            if " " not in g[1:-1]:
                out.append(g)
    return out


def test_languages_equal_sets_in_place_of_filters(prepared):
    docs = [(r.doc_id, r.text, r.lang) for r in common.table(prepared, SMALL, "documents").collect()]
    train = [(t, x) for i, t, x in docs if zlib.crc32(str(i).encode()) % 5 and t is not None and x is not None]
    size = collections.Counter(x for _, x in train)
    count = collections.defaultdict(collections.Counter)
    for t, x in train:
        count[x].update(set(own_grams(t)))
    least = min(langid.MIN_DOCS, max(1, max(size.values()) // 4))
    best = collections.Counter()
    for x in count:
        for g, n in count[x].items():
            if n >= min(least, size[x]) and size[x] >= least:
                best[g] = max(best[g], n / size[x])
    sets = {x: {g for g, n in count[x].items() if n >= min(least, size[x]) and n / size[x] >= langid.MIN_SHARE * best[g]} for x in sorted(count)}
    got = {r.doc_id: r for r in langid.language_of(common.table(prepared, SMALL, "documents")).collect()}
    sure = 0
    for i, t, _ in docs:
        g = own_grams(t)
        share = {x: sum(y in s for y in g) / max(len(g), 1) for x, s in sets.items()}
        if not g:
            assert got[i].lang_pred == "und"
            continue
        top = sorted(share.values())
        assert abs(got[i].score - max(share.values())) < 0.02
        if len(top) < 2 or top[-1] - top[-2] > 0.02:
            sure += 1
            assert share[got[i].lang_pred] == top[-1]
    assert sure > 0.9 * len(docs)


def test_learning_reads_whole_texts(prepared):
    rows = [(i, "12 " * 8000 + ("abab baba " if i % 2 else "cdcd dcdc ") * 30, "ab" if i % 2 else "cd") for i in range(20)]
    filters = langid.learn(prepared.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert filters.predict(pa.array(["baba abab", "dcdc"]))[0] == ["ab", "cd"]


def test_a_filter_holds_its_capacity(prepared, monkeypatch):
    monkeypatch.setattr(langid, "CAPACITY", 12)
    rows = [(i, "abcd " + (f"x{chr(97 + i)}y" if i < 8 else ""), "l") for i in range(10)]
    filters = langid.learn(prepared.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert filters.predict(pa.array(["abcd"]))[1][0] > 0.9 > 0.5 > filters.predict(pa.array(["xay"]))[1][0]


def plain_greedy(lengths, size):
    """Descending cost to the cheapest sequence with room for the whole, else to the cheapest with any."""
    room = list(packing.capacities(sum(lengths), size))
    used, price, out = [0] * len(room), [0.0] * len(room), []
    todo = sorted((-min(size, n - s), k, s) for k, n in enumerate(lengths) for s in range(0, n, size))
    while todo:
        n, k, s = todo.pop(0)
        n = -n
        fits = [j for j in range(len(room)) if room[j] >= n] or [j for j in range(len(room)) if room[j]]
        j = min(fits, key=lambda j: (price[j], j))
        part = min(n, room[j])
        out.append((k, s, part, j, used[j]))
        room[j] -= part
        used[j] += part
        price[j] += packing.LINEAR * part + packing.QUADRATIC * part * part
        if part < n:
            todo = sorted([*todo, (part - n, k, s + part)])
    assert not any(room)
    return out


def test_packing_equals_the_plain_greedy():
    rng = np.random.RandomState(2)
    for _ in range(60):
        lengths = np.where(rng.rand(rng.randint(1, 60)) < 0.1, rng.randint(1, 400), rng.randint(1, 40))
        assert packing.assign(lengths.astype(np.int64), 64) == plain_greedy(lengths.tolist(), 64)


def test_packed_ids_are_the_library_s(prepared):
    lib = Tokenizer.from_file(vocabulary())
    docs = {r.doc_id: r.text or "" for r in common.table(prepared, SMALL, "documents").limit(60).collect()}
    ids = {i: np.array([*lib.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in docs.items()}
    rows = packing.pack(prepared.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(1), vocabulary()).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])


def test_likeness_is_the_true_share(prepared):
    """Against 2 <x, y> / (<x, x> + <y, y>) of the paragraphs' word-pair counts."""
    texts = [r.text or "" for r in common.table(prepared, SMALL, "documents").limit(80).collect()]
    half = [t[:len(t) * 3 // 4] for t in texts]

    def pairs(t):
        out = collections.Counter()
        for p in t.split("\n"):
            h, ptr = tx.shingles(*tx.words(pa.array([p])), 2)
            out.update(h.tolist())
        return out

    got = Fingerprints.of(texts).likeness(Fingerprints.of(half))
    want = []
    for a, b in zip(map(pairs, texts), map(pairs, half)):
        total = sum(v * v for v in a.values()) + sum(v * v for v in b.values())
        want.append(2 * sum(v * b[k] for k, v in a.items()) / total if total else 1.0)
    error = got - np.array(want)
    assert abs(error.mean()) < 0.03 and np.sqrt((error ** 2).mean()) < 0.1


def test_extra_columns_and_empty_tables(prepared):
    pages = prepared.createDataFrame([(1, "http://a.com/x", "h", 3, "block")], "page_id long, url string, host string, n int, verdict string")
    labels = prepared.createDataFrame([(1, 0, 0, "x"), (1, 0, 0, "x"), (None, 1, 1, "x")], "doc_id long, quality int, toxic int, host string")
    assert [r.verdict for r in judge(pages, labels).collect()] == ["allow"] and judge(pages.limit(0), labels).count() == 0
    docs = prepared.createDataFrame([(1, "a b", 1.0, "x"), (None, None, 2.0, "y")], "doc_id long, text string, score double, held_out string")
    rows = language_model_scores(docs).collect()
    assert len(rows) == 2 and all(math.isfinite(r.score) for r in rows) and language_model_scores(docs.limit(0)).count() == 0
    assert langid.language_of(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred = 'und'").count() == 2
