"""Tokenizer alignment: brute force with the libraries, both ways to the counts, defined cases."""
import collections
import hashlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rxatlas.llm import align, common
from rxatlas.llm.queries import QUERIES, vocabulary

SMALL = "/root/testdata/sf0.001"
A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ROWS = [(1, "one text, held by many"), (2, "one text, held by many"), (2, "one text, held by many"), (3, None), (4, ""), (5, " "), (6, "中文 and Ünïcødé 🤦🏼‍♂️ é"),
        (7, "<|endoftext|> </s> <unk> <0x41>"), (8, "two  blanks\n\n\tand lines▁ "), (None, "no id"), (9, "a\x00b"), (10, "x" * 30000), (11, " " * 30000 + "y"),
        (12, "it's 12345 we're here\u0085 z"), (13, "﻿bom"), (14, "ﬁ ligature ½ ①")]


@pytest.fixture(scope="module")
def prepared(spark):
    common.prepare(spark)
    return spark


def brute(rows):
    a_lib = Tokenizer.from_file(A)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: b for b, c in enumerate(align.byte_symbols())}
    links, shapes, counts = [], [], collections.Counter()
    for _, t in rows:
        own, groups = [], []
        if t:
            raw = (" " + t).encode()
            a = [(i, bytes(byte_of[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + t, add_special_tokens=False).ids]
            b = []
            for i in b_lib.encode(t):
                p = b_lib.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                spans = [[(i, int(e) - len(x), int(e)) for (i, x), e in zip(z, np.cumsum([len(x) for _, x in z]))] for z in (a, b)]
                own, j = [], 0
                for i, s, e in spans[0]:
                    while spans[1][j][2] <= s:
                        j += 1
                    k = j
                    while k < len(spans[1]) and spans[1][k][1] < e:
                        own.append((i, spans[1][k][0]))
                        k += 1
                cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
                groups = [[[i for i, s, e in z if lo <= s and e <= hi] for z in spans] for lo, hi in zip([0, *cuts], cuts)] if len(raw) < 5000 else cuts
                shapes.append((len(a), len(b), len(cuts), groups))
        if not own:
            shapes.append((0, 0, 0, []))
        links.append(own)
        counts.update(own)
    top = collections.Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for (i, _), own, (n_a, n_b, n_groups, groups) in zip(rows, links, shapes):
        text = None if groups and isinstance(groups[0], int) else ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        out.append(((i, n_a, n_b, n_groups, len(own), sum(counts[x] == top[x[1]] for x in own), sum(counts[x] for x in own)), text))
    return out


def compare(got, want, digest=False):
    left = collections.Counter(tuple(r)[:-1] for r in got)
    assert left == collections.Counter(x for x, _ in want)
    texts = collections.Counter((r.doc_id, r.n_a, r[-1]) for r in got)
    for x, t in want:
        if t is not None:
            assert texts[x[0], x[1], (hashlib.sha256(t.encode()).hexdigest() if t else "") if digest else t] > 0


@pytest.mark.parametrize("table_bytes", [align.TABLE_BYTES, 0])
def test_equals_brute_force(prepared, table_bytes):
    docs = prepared.createDataFrame([(i, t, 3, "k", 1.0, 2) for i, t in ROWS], "doc_id long, text string, n long, `key` string, pairs double, n_a int").repartition(4)
    got = align.align_tokenizers(docs, A, B, table_bytes=table_bytes).collect()
    want = brute(ROWS)
    compare(got, want)
    assert sum(x[1] > 0 for x, _ in want) >= 10


def test_query_equals_brute_force(prepared):
    docs = [(r.doc_id, r.text) for r in common.table(prepared, SMALL, "documents").collect()]
    compare(QUERIES["op11_exact_text_alignment"](prepared, SMALL).collect(), brute(docs), digest=True)


def test_sums_in_parts(prepared, monkeypatch):
    monkeypatch.setattr(align, "HELD_PAIRS", 50)
    docs = common.table(prepared, SMALL, "documents").limit(40)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    compare(align.align_tokenizers(prepared.createDataFrame(rows, "doc_id long, text string"), A, B).collect(), brute(rows))


def test_empty_table(prepared):
    assert align.align_tokenizers(prepared.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_pairs_pack():
    k, c = np.unique(np.random.RandomState(0).randint(0, 2**40, 1000), return_counts=True)
    assert all(np.array_equal(x, y) for x, y in zip(align.unpack_pairs(align.pack_pairs(k, c)), (k, c)))
    assert len(align.unpack_pairs(align.pack_pairs(k[:0], c[:0]))[0]) == 0


def test_both_libraries_split_alike():
    """The faster library's ids are those of the vocabulary file's own library, for every code point in several places."""
    own, lib = align.Tokenizers(A, B), Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for s in range(0, len(points), 20_000):
        text = "".join(f" x{chr(c)}{chr(c)}y 1{chr(c)} {chr(c)}" for c in points[s:s + 20_000])
        assert np.array_equal(own.encode_a(text), lib.encode(text, add_special_tokens=False).ids), s
