"""Line dedup: brute force, both ways of each broadcast, defined cases."""
import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from rxatlas.llm import common, lines
from rxatlas.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LONG = "this line is long enough to be compared with others"
BLANK = " \t\n\v\f\r"
ROWS = [(1, f"{LONG}\nown one"), (2, f"  {LONG.upper()}\t\nx\n{LONG}"), (3, LONG), (3, f"again {LONG}\n{LONG}"), (4, f"a\r\n{LONG}\r"),
        (None, f"{LONG}\nno id"), (5, None), (6, ""), (7, "\n\n"), (8, "é" * 39 + "É\n" + "é" * 40), (9, "é" * 40), (10, "short\n" * 30000), (11, "É" * 40)]


def brute(rows, least_chars=40, least_docs=5):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(BLANK))
    held = collections.defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= least_chars:
                held[k].append(i)
    top = {k: max(i for i in x if i is not None) for k, x in held.items() if len(x) >= least_docs and any(i is not None for i in x)}
    out = collections.Counter()
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if top.get(key(x), i) == i]
        out[i, len(own), len(own) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.fixture(scope="module")
def prepared(spark):
    common.prepare(spark)
    return spark


@pytest.mark.parametrize("sizes", [{}, {"filter_bytes": 0}, {"table_bytes": 0}])
def test_equals_brute_force(prepared, sizes):
    rows = ROWS + [(20 + i, f"{LONG} two\nline {i}\n" + "held without an id, " * 4) for i in range(5)]
    rows += [(None, "only rows without an id hold this line of text" * 2)] * 6
    docs = prepared.createDataFrame([(i, t, 1, "k", "t") for i, t in rows], "doc_id long, text string, n_lines long, `key` string, top string").repartition(5)
    got = collections.Counter(map(tuple, lines.drop_repeated_lines(docs, **sizes).collect()))
    assert got == brute(rows)


@pytest.mark.parametrize("sizes", [{}, {"table_bytes": 0}])
def test_small_blocks_and_tables(prepared, sizes, monkeypatch):
    monkeypatch.setattr(lines, "HELD_KEYS", 500)  # many marks of one block, and partial counts
    monkeypatch.setattr(lines, "HELD_BYTES", 20_000)
    docs = common.table(prepared, SMALL, "documents")
    got = collections.Counter(map(tuple, lines.drop_repeated_lines(docs, 10, 2, **sizes).collect()))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], 10, 2)


def test_the_filter_keeps_single_lines_out(prepared):
    rows = [(i, f"{LONG} {i}\n{LONG} shared by {i // 2}") for i in range(2000)]
    docs = prepared.createDataFrame(rows, "doc_id long, text string").repartition(6)
    bits = lines.filter_bits(4000)
    sent = prepared.sparkContext.broadcast(lines.Twice(bits, [(k, bytes(x)) for k, x in lines.twice_seen(docs, bits, 40).collect()]))
    held = {bytes(r.key).decode() for r in lines.suspects(docs, sent, 40).collect()}
    assert {f"{LONG} shared by {i}" for i in range(1000)} <= held and len(held) < 1000 + 40


def test_empty_table_and_query(prepared):
    assert lines.drop_repeated_lines(prepared.createDataFrame([], "doc_id long, text string")).count() == 0
    got = {r.doc_id: r for r in QUERIES["op13_bloom_lines"](prepared, SMALL).collect()}
    docs = [(r.doc_id, r.text) for r in common.table(prepared, SMALL, "documents").collect()]
    assert len(got) == len(docs)
    for i, n, gone, text in brute(docs):
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (n, gone, hashlib.sha256(text.encode()).hexdigest())
