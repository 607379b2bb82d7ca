"""Training-data operators: brute force on small tables, and the defined edge cases."""
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rxatlas.llm import bpe, common, graph, minhash, neighbours, ngram, packing
from rxatlas.llm import text as tx
from rxatlas.llm.fingerprint import Fingerprints, edited, fingerprints
from rxatlas.llm.hosts import judge
from rxatlas.llm.langid import language_of, learn
from rxatlas.llm.licences import scan
from rxatlas.llm.queries import QUERIES, vocabulary
from rxatlas.llm.toxicity import toxicity

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, `key` string, held_out string"
BASE = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, BASE, "en"), (2, BASE.upper(), "en"), (3, BASE + " one more", "en"), (3, BASE + " one more", "en"),
    (4, None, None), (5, "", "en"), (6, " \n\t ", "fr"), (7, "a b", "en"), (8, "A B", None), (9, "é" * 50000, "fr"),
    (10, "x y z " * 20000, "en"), (None, "no id here at all", "en"), (11, "123 456 !!!", "en"),
    (12, "Licensed under the Apache License, Version 2.0.", "en"), (13, "<|endoftext|> ΑΣ 中文 it's", "en"),
]


@pytest.fixture(scope="module")
def prepared(spark):
    common.prepare(spark)
    return spark


@pytest.fixture(scope="module")
def edge(prepared):
    return prepared.createDataFrame([(i, t, l, None, None, 0.5, 7, "k", "x") for i, t, l in ROWS], DOCS)


@pytest.fixture(scope="module")
def empty(prepared):
    return prepared.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(prepared):
    return prepared.createDataFrame([(1, 1, 0), (2, None, 1), (7, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def small_docs(spark):
    return {r.doc_id: r.text or "" for r in common.table(spark, SMALL, "documents").select("doc_id", "text").collect()}


def test_word_hashes_follow_the_rule():
    texts = [None, "", " ", "A b\x0bC", "x" * 3000, "w\u0085x \x1cé", "The THE the"]
    h, ptr = tx.words(pa.array(texts))
    seen = {}
    for t, s, e in zip(texts, ptr[:-1], ptr[1:]):
        assert len(words(t)) == e - s
        for w, x in zip(words(t), h[s:e]):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_components(prepared):
    e = prepared.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    got = {r.id: r.component for r in graph.components(e).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100}
    assert graph.components(e.limit(0)).count() == 0


def test_minhash_edge_cases(edge, empty):
    rows = minhash.near_duplicates(edge, 4, 80).collect()
    got = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == len(ROWS) and sum(r.doc_id == 3 for r in rows) == 2
    assert got[1] == got[2] == got[3] == 1 and got[7] == got[8] == 7
    assert [got[i] for i in (4, 5, 6)] == [4, 5, 6] and {r.doc_id: r.n_shingles for r in rows}[4] == 0
    assert minhash.near_duplicates(empty).count() == 0


def test_bbit_estimate_is_close():
    a = [f"w{i}" for i in range(1000)]
    t = pa.array([" ".join(a), " ".join(a[:900])])
    h, ptr = minhash.sets(t, 1)
    m = minhash.minima(h, ptr)
    s = minhash.pack(m)
    x = s[0] ^ s[1]
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    d = int(np.bitwise_count(x & np.uint64(minhash.LOW_LANE)).sum())
    assert abs(minhash.estimate_from_differing(d) - 0.9) < 0.1


def test_encoding_equals_the_library(edge, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary())
    rows = bpe.encode_digests(edge, vocabulary()).collect()
    want = collections.Counter()
    for i, t, _ in ROWS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, rows)) == want
    assert bpe.encode_digests(empty, vocabulary()).count() == 0


def test_encoder_on_hard_strings():
    import random
    from tokenizers import Tokenizer
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcsrtvemld' '''  \n\t12ÀéÉßñ.,!-\u0085ǅİȺ\x1c<|") for _ in range(rng.randrange(60))) for _ in range(3000)]
    lib, own = Tokenizer.from_file(vocabulary()), bpe.Encoder(vocabulary())
    ids, ptr = own.encode(pa.array(texts))
    for t, e, s, x in zip(texts, lib.encode_batch(texts, add_special_tokens=False), ptr[:-1], ptr[1:]):
        assert ids[s:x].tolist() == e.ids, t


def test_packing_places_every_id_once(edge, empty):
    rows = packing.pack(edge, vocabulary()).collect()
    own = bpe.Encoder(vocabulary())
    ids, ptr = own.encode(pa.array([t for _, t, _ in ROWS]))
    of = {i: np.append(ids[s:e], 2).astype("<u4") for (i, _, _), s, e in zip(ROWS, ptr[:-1], ptr[1:])}
    by_seq = collections.defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(of[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(of[r.doc_id])
        by_seq[r.sequence_id].append((r.offset, r.length))
    for x in by_seq.values():
        x.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(x, x[1:])) and x[0][0] == 0
        n = sum(b for _, b in x)
        assert n <= 4096 and n & (n - 1) == 0
    assert sum(r.length for r in rows) == sum(len(of[i]) for i, _, _ in ROWS)
    assert packing.pack(empty, vocabulary()).count() == 0


def test_kneser_ney_equals_brute_force(prepared, monkeypatch):
    monkeypatch.setattr(ngram, "CHARS_PER_SHARD", 40_000)  # several shards, with hot contexts
    docs = {i: words(t) + [0] for i, t in small_docs(prepared).items()}
    train = [i for i in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for i in train for w in docs[i])
    b = collections.Counter(p for i in train for p in zip([1] + docs[i], docs[i]))
    m = collections.Counter(w for _, w in b)
    n_of = lambda x: [sum(v == k for v in x.values()) for k in (1, 2, 3, 4)]
    d2, d1 = ngram.discounts(n_of(b)), ngram.discounts(n_of(m))
    total, free = collections.Counter(), collections.Counter()
    for (x, _), n in b.items():
        total[x] += n
        free[x] += d2[min(n, 3)]
    free1 = sum(d1[min(n, 3)] for n in m.values())

    def p(x, w):
        low = (max(m[w] - d1[min(m[w], 3)], 0) + free1 / (len(c) + 1)) / len(b)
        return (max(b[x, w] - d2[min(b[x, w], 3)], 0) + free[x] * low) / total[x] if total[x] else low

    for r in ngram.language_model_scores(common.table(prepared, SMALL, "documents")).collect():
        ws = docs[r.doc_id]
        assert math.isclose(r.score, sum(math.log10(p(x, w)) for x, w in zip([1] + ws, ws)), rel_tol=1e-9)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (sum(c.values()) + len(c) + 1)) for w in ws), rel_tol=1e-9)
        assert r.n_tokens == len(ws) and r.n_known == sum(c[w] > 0 for w in ws) and r.train_tokens == sum(c.values())


def test_kneser_ney_edge_cases(edge, empty):
    rows = ngram.language_model_scores(edge).collect()
    assert len(rows) == len(ROWS) and all(r.score <= 0 and r.n_tokens >= 1 for r in rows)
    assert ngram.language_model_scores(empty).count() == 0


def test_fingerprints_equal_the_rule(prepared, edge, empty):
    docs = small_docs(prepared)
    ids = sorted(docs)
    rows = {r.doc_id: r for r in fingerprints(common.table(prepared, SMALL, "documents")).collect()}
    for k, i in enumerate(ids):
        e = edited(docs[i], docs[ids[(k + 1) % len(ids)]])
        assert rows[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and rows[i].n_chars == len(docs[i])
    assert np.mean([r.near_edited for r in rows.values()]) > 0.5 > 0.2 > np.mean([r.near_next for r in rows.values()])
    assert len(fingerprints(edge).collect()) == len(ROWS) and fingerprints(empty).count() == 0


def test_fingerprints_are_homomorphic():
    f = Fingerprints.of(["a b c\nd e\nf", "f\na b c\n\nd e", "d e", "a b c\nf"])
    assert f.hex()[0] == f.hex()[1] != f.hex()[3]
    assert (f.take([3]) + f.take([2])).hex() == f.take([0]).hex() and (f.take([0]) - f.take([2])).hex() == f.take([3]).hex()


def test_fingerprints_of_very_frequent_pairs():
    f = Fingerprints.of(["x " * 80_000, "x " * 60_000, "x " * 40_000, "x " * 30_000 + "y " * 10])
    share = lambda a, b: 2 * a * b / (a * a + b * b)
    assert f.take([0]).likeness(f.take([1]))[0] == pytest.approx(share(80_000, 60_000), abs=0.01)
    assert f.take([2]).likeness(f.take([3]))[0] == pytest.approx(share(40_000, 30_000), abs=0.01)
    assert (f.take([0]) - f.take([1])).near.astype(np.int32).max() == 20_000


def test_language_and_toxicity(prepared, edge, empty, labels):
    docs = common.table(prepared, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in language_of(docs).collect() if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    got = {r.doc_id: r.lang_pred for r in language_of(edge).collect()}
    assert [got[i] for i in (4, 5, 6, 11)] == ["und"] * 4 and language_of(empty).count() == 0
    known = common.table(prepared, "/root/testdata/sf0.01", "labels")
    toxic = {r.doc_id: r.toxic for r in known.collect()}
    rows = [r for r in toxicity(docs, known).collect() if r.held_out and r.doc_id in toxic]
    assert np.mean([toxic[r.doc_id] == r.predicted for r in rows]) > 0.85
    rows = toxicity(edge, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows) and toxicity(empty, labels.limit(0)).count() == 0


def test_more_languages_than_a_mask_word(prepared):
    rng = np.random.RandomState(3)
    text = lambda k: " ".join("".join(chr(0x4E00 + 8 * k + x) for x in rng.randint(0, 8, 5)) for _ in range(200))
    rows = [(100 * k + i, text(k), f"l{k:02}") for k in range(70) for i in range(12 if k == 0 else 1 if k == 69 else 2)]
    filters = learn(prepared.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert filters.predict(pa.array([text(k) for k in range(70)]))[0] == [f"l{k:02}" for k in range(70)]
    assert filters.predict(pa.array(["\U0001F600\U0001F680 \uFF01\uFF1F \u3002"]))[0] == ["und"]


def test_licences(edge, empty):
    rows = {r.doc_id: r for r in scan(edge).collect()}
    assert rows[12].licences == "apache" and rows[1].licences == "" and rows[4].n_paragraphs == 0
    assert scan(empty).count() == 0


WRAPPED = {
    "mit": "/*\n * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the \"Software\"), to deal\n */",
    "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:",
    "agpl": "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU Affero General Public License as published by\n// the Free Software Foundation",
    "gpl": "   This program is free software: you can redistribute it and/or modify\n   it under the terms of the GNU General Public License as published by\n   the Free Software Foundation",
    "apache": " * Licensed under the Apache\n * License, Version 2.0",
}


def test_wrapped_licences(prepared):
    texts = [*WRAPPED.values(), "MIT License", "Redistribution of wealth and use in source\nand binary stars, with or\nwithout modification"]
    rows = {r.doc_id: r.licences for r in scan(prepared.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i] for i in range(len(texts))] == [*WRAPPED, "mit", ""]


def test_host_rules(prepared, labels):
    pages = prepared.createDataFrame(
        [(1, "http://WWW.Example.com/en/x?q#f", "h"), (2, "https://m.example.com/en/", None), (3, "http://a.net/es/1", None), (4, "http://a.com", None),
         (5, None, None), (6, "no url", None), (7, "x://h.net/fr", None), (7, "x://h.net/fr", None)], "page_id long, url string, host string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge(pages, labels.limit(0)).orderBy("page_id").collect()]
    assert got == [(1, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "m.example.com", "/en/", "example.com/en/", "block"),
                   (3, "a.net", "/es/1", "net/es/", "block"), (4, "a.com", "", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
                   (7, "h.net", "/fr", None, "allow"), (7, "h.net", "/fr", None, "allow")]
    verdicts = {r.page_id: r.verdict for r in judge(pages, labels).collect()}
    assert verdicts[7] == "block" and verdicts[1] == "allow"  # both pages of the host of 7 are labelled bad
    assert judge(pages.limit(0), labels).count() == 0


def test_vectors(prepared):
    rng = np.random.RandomState(0)
    x = rng.randn(150, 16)
    x[100:] = x[:50] + 0.15 * rng.randn(50, 16)
    x[10] = 3 * x[11]
    rows = [(i, v.tolist(), 0, 5) for i, v in enumerate(x)]
    rows += [(200, None, 0, 5), (201, [0.0] * 16, 0, 5), (202, [None] + [1.0] * 15, 0, 5), (203, [float("nan")] * 16, 0, 5), (204, [1.0], 0, 5)]
    df = prepared.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int")
    got, recall = neighbours.linked_vectors(df)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    want = {r.vec_id: r.n_links for r in got.collect()}
    assert recall >= 0.99 and len(want) == 155 and [want[i] for i in range(200, 205)] == [0] * 5
    assert [want[i] for i in range(150)] == (link.sum(1) - 1).tolist()
    assert neighbours.linked_vectors(df.limit(0))[0].count() == 0


def two_groups(rng, size, dim=32):
    """Unit vectors of two tight groups: cosine about 0.99 inside, 0.91 across."""
    c = np.linalg.qr(rng.randn(dim, 2))[0].T
    centres = np.array([c[0], 0.92 * c[0] + np.sqrt(1 - 0.92 ** 2) * c[1]])
    x = np.repeat(centres, size, 0) + 0.09 / np.sqrt(dim) * rng.randn(2 * size, dim)
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_saturated_lists_lose_no_links(prepared, monkeypatch):
    monkeypatch.setattr(neighbours, "AUDIT", 0)  # the audit must not be what finds them
    monkeypatch.setattr(neighbours, "AUDIT_GROWTH", 0, raising=False)
    rng = np.random.RandomState(5)
    x = np.concatenate((two_groups(rng, 40), rng.randn(60, 32)))
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = x @ x.T >= 0.9
    assert link[:40, 40:80].mean() > 0.8 and link[:40, :40].all()
    df = prepared.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in neighbours.linked_vectors(df)[0].collect()}
    assert [got[i].n_links for i in range(140)] == (link.sum(1) - 1).tolist()
    assert {got[i].component_id for i in range(80)} == {0}


def test_the_audit_grows():
    assert neighbours.audit_size(100) == neighbours.AUDIT < neighbours.audit_size(10 ** 7)


def test_hot_codes_are_spread_over_tasks(prepared):
    rng = np.random.RandomState(1)
    x = np.ones(16) + 0.01 * rng.randn(4000, 16)
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, i, v.tobytes()) for i, v in enumerate(x)]
    prepared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = neighbours.start(prepared.createDataFrame(rows, "rep long, component long, unit binary"), 4000, 1, 1)
        got = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        prepared.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) >= 6 and max(got) < 0.4 * sum(got)


def test_pipeline(prepared, edge, empty):
    assert corpus_pipeline.run(prepared, SMALL).count() > 0
    docs = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(prepared, docs, SMALL)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        assert stage(prepared, empty, SMALL).count() == 0
    kept = [r.doc_id for r in docs.collect()]
    assert len(kept) == len(set(kept)) and 2 not in kept and 4 not in kept
    assert set(QUERIES) == {q for q in QUERIES if re.fullmatch(r"op\d+_\w+", q)} and len(QUERIES) == 13
