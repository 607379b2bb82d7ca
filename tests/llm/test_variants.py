"""Spelling variants: brute force, small dictionaries, defined cases."""
import collections
import random
import re
import zlib

import pytest

from rxatlas.llm import common, variants
from rxatlas.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark):
    common.prepare(spark)
    return spark


def brute_words(rows):
    low = lambda w: "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
    out = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = low(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def brute_variants(words, ratio=10):
    """Near words through every word with one code point left out."""
    holes = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1:]].add(w)
    near = collections.defaultdict(set)
    for x in holes.values():
        for a in x:
            near[a] |= x - {a}
    for w in words:
        for i in range(len(w)):
            v = w[:i] + w[i + 1:]
            if v in words:
                near[w].add(v)
                near[v].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_equals_brute_force(prepared):
    docs = [(r.doc_id, r.text) for r in common.table(prepared, SMALL, "documents").collect()]
    want = brute_variants(brute_words(docs))
    assert got(QUERIES["op12_vgram_variants"](prepared, SMALL)) == want
    assert sum(x[3] > 0 for x in want.values()) > 20


@pytest.mark.parametrize("least_list,dictionary", [(1, 1 << 15), (4, 1 << 15), (1, 40), (10**6, 1)])
def test_any_dictionary_loses_no_pair(prepared, monkeypatch, least_list, dictionary):
    monkeypatch.setattr(variants, "LEAST_LIST", least_list)
    rng = random.Random(least_list + dictionary)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(7, 10))): rng.choice([2, 3, 30, 31, 400]) for _ in range(500)}
    for w in list(words):  # variants at every place, begin and end among them
        k = rng.randrange(len(w) + 1)
        words[w[:k] + rng.choice("abéz") + w[k:]] = rng.choice([2, 25, 2500])
    df = prepared.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    heavy = variants.heavy_grams(df, least_list, dictionary)
    assert not (least_list == 1 and dictionary > 40) or len(heavy) > 50
    monkeypatch.setattr(variants, "heavy_grams", lambda *_: heavy)
    assert got(variants.group_variants(df)) == brute_variants(words)


def test_an_edit_affects_no_more_grams_than_the_bound():
    rng = random.Random(1)
    heavy = {"".join(rng.choice("ab") for _ in range(q)) for q in range(2, 6) for _ in range(12)}
    for _ in range(2000):
        w = "^" + "".join(rng.choice("abc") for _ in range(9)) + "$"
        i = rng.randrange(1, len(w))
        v = w[:i] + rng.choice("abc") + w[i + rng.randrange(2 if i < len(w) - 1 else 1):]
        a, b = ([x[p:e] for p, e in variants.decompose(x, 5, heavy)] for x in (w, v))
        left = collections.Counter(a) - collections.Counter(b)
        assert sum(left.values()) <= variants.affected(variants.decompose(w, 5, heavy), len(w))


def test_the_dictionary_is_bounded(prepared):
    words = {"".join(random.Random(k).choices("etaoin", k=8)) for k in range(3000)}
    df = prepared.createDataFrame([(w, 2) for w in words], "word string, n long")
    for bound in (100, 1000):
        heavy = variants.heavy_grams(df, 1, bound)
        assert 0 < max(collections.Counter(map(len, heavy)).values()) <= bound


def test_defined_cases(prepared):
    rows = [(1, None, 1), (2, "", 1), (3, "!!!", 1), (None, "variant variant", 1), (4, "Variant VARIANT variants Évariant évariant", 1), (4, "variant " * 40, 1), (5, "x" * 40000, 1)]
    docs = prepared.createDataFrame(rows, "doc_id long, text string, n int")
    words = variants.count_words(docs)
    assert {r.word: r.n for r in words.collect()} == {"variant": 44, "variants": 1, "Évariant": 1, "évariant": 1, "x" * 40000: 1}
    found = got(variants.group_variants(words))
    assert found["variants"] == ("variant", "variant", 1, 1, 44) and found["Évariant"] == ("variant", "variant", 1, 2, 44)
    assert found["variant"] == (None, "variant", 44, 3, None) and found["x" * 40000][3] == 0
    assert variants.group_variants(variants.count_words(docs.limit(0))).count() == 0
    assert variants.near("abcdefg", "abcdefg") is False and variants.near("abcdefg", "bcdefgh") is False


def test_long_words(prepared):
    base = ["ab" * 60, "a" * 3000, "abc" * 40]
    words = {w: 2 for w in base} | {w[:70] + w[71:]: 40 for w in base} | {w[:50] + "z" + w[51:]: 3 for w in base} | {w[:90] + "y" + w[90:]: 500 for w in base}
    df = prepared.createDataFrame(list(words.items()), "word string, n long")
    assert got(variants.group_variants(df)) == brute_variants(words)
    heavy = variants.heavy_grams(df, 1, 1 << 15)
    assert sum(map(len, variants.index_keys("a" * 3000, 3000, heavy | {"a" * k for k in range(2, 7)}))) < 200_000


def test_roots_of_chains(prepared):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("z", "w3")]
    found = {r.word: r.root for r in variants.roots(prepared.createDataFrame(forms, "word string, form string")).collect()}
    assert found == {**{f"w{i}": "w11" for i in range(11)}, "z": "w11"}
