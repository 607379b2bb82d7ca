"""The toxicity kernel by brute force, scripts, insertions, and whole texts in training."""
import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from rxatlas.llm import common, toxicity as tox


@pytest.fixture(scope="module")
def prepared(spark):
    common.prepare(spark)
    return spark


def weights(segment):
    """Every subsequence of three or four letters (the two ends are letters too), with its weight."""
    marked = [None, *segment, None]
    symbols = ["end" if c is None else int(tox.SYMBOL[ord(c)]) for c in marked]
    letters = [i for i, x in enumerate(symbols) if x != 0]
    out = collections.Counter()
    for p, span in tox.SPANS.items():
        for chosen in itertools.combinations(range(len(letters)), p):
            if chosen[-1] - chosen[0] >= span:
                continue
            skipped = chosen[-1] - chosen[0] + 1 - p
            inserted = letters[chosen[-1]] - letters[chosen[0]] - (chosen[-1] - chosen[0])
            out[tuple(symbols[letters[k]] for k in chosen)] += tox.DECAY ** skipped * tox.INSERTED ** inserted
    return out


def brute_kernel(a, b):
    x, y = weights(a), weights(b)
    norm = lambda z: sum(v * v for v in z.values()) ** 0.5
    return sum(v * y[k] for k, v in x.items()) / (norm(x) * norm(y))


def test_kernel_equals_the_sum_over_subsequences():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcde..*中文й1") for _ in range(rng.randrange(2, 12))) for _ in range(60)] + ["idiot", "i.d.i.o.t", "1d10t", "中文", "日本語"]
    words = [w for w in words if any(tox.SYMBOL[ord(c)] for c in w)]
    for a, b in zip(words, words[1:] + words[:1]):
        assert tox.kernel(a, b) == pytest.approx(brute_kernel(a, b), abs=1e-6)
    assert all(tox.kernel(w, w) == pytest.approx(1) for w in words)


def test_inserted_characters_cost_weight_not_the_match():
    one, two, three = (tox.kernel("idiot", x) for x in ("i.d.i.o.t", "i..d..i..o..t", "i...d...i...o...t"))
    assert one > 0.8 and two > 0.5 * one and three > 0.5 * one
    assert tox.kernel("idiot", "idi*ot") > 0.9 and tox.kernel("idiot", "1d10t") == pytest.approx(1)
    assert tox.kernel("idiot", "walking") < 0.05


def test_every_script_has_its_own_letters():
    seg = tox.Segments(pa.array(["中文 日本 한국 ひら カタ"]))
    assert len(set(seg.key.tolist())) == 5
    assert tox.kernel("中文", "日本") < tox.kernel("中文", "中文字") and tox.kernel("дурак", "д.у.р.а.к") > 0.8 > 0.1 > tox.kernel("дурак", "книга")


def _corpus(rng, insults, at):
    """Labelled texts of invented words; toxic ones hold an insult behind ``at`` characters."""
    word = lambda: "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    known = [word() for _ in range(400)]
    rows = []
    for i in range(160):
        words = [rng.choice(known) for _ in range(at // 4)]
        toxic = i % 2
        if toxic:
            words[-rng.randrange(3, 40)] = rng.choice(insults)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_training_reads_whole_texts(prepared):
    rng = random.Random(11)
    rows = _corpus(rng, ["xyzzqk", "wqkjxx", "qqzzwx"], 24_000)
    assert all("q" not in t[:20_000] and len(t) > 20_000 for _, t, _ in rows)
    docs = prepared.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = prepared.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    got = [r for r in tox.toxicity(docs, labels).collect() if r.held_out]
    assert len(got) > 10 and np.mean([r.predicted == r.doc_id % 2 for r in got]) >= 0.9


def test_the_sample_is_bounded_by_rows_and_characters(prepared, monkeypatch):
    monkeypatch.setattr(tox, "SAMPLE_CHARS", 500)
    seen = []
    monkeypatch.setattr(tox, "train", lambda texts, toxic, weight: seen.append((texts.to_pylist(), toxic.tolist(), weight.tolist())) or tox.Model(prior=0.1))
    docs = prepared.createDataFrame([(i, "a" * 90) for i in range(20)] + [(50, "b" * 501), (51, "c" * 400), (52, None), (51, "d" * 50)], "doc_id long, text string")
    labels = prepared.createDataFrame([(i, 0) for i in range(20)] + [(50, 1), (51, 1), (52, 1), (51, 0), (99, 1)], "doc_id long, toxic int")
    tox.learn(docs, labels)
    texts, toxic, weight = seen[0]
    assert sum(len(t) for t, x in zip(texts, toxic) if not x) == 450 and {"c" * 400, "d" * 50, ""} == {t for t, x in zip(texts, toxic) if x}
    assert weight[toxic.index(0)] == 4.0


def test_defined_cases(prepared):
    docs = prepared.createDataFrame([(1, "x", 1), (1, "y", 2), (None, None, 3), (2, "", 4)], "doc_id long, text string, toxic int")
    none = prepared.createDataFrame([], "doc_id long, toxic int, score double")
    rows = tox.toxicity(docs, none).collect()
    assert len(rows) == 4 and all(r.score == 0 and r.predicted == 0 for r in rows)
    one = prepared.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in tox.toxicity(docs, one).collect()) and tox.toxicity(docs.limit(0), one).count() == 0
