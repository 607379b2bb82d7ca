"""The licence classifier: wordings, negations, identifiers, and the confirmation by brute force."""
import re

import numpy as np
import pyarrow as pa
import pytest

from rxatlas.llm import common, licences as lic, text as tx


@pytest.fixture(scope="module")
def model(spark):
    common.prepare(spark)
    return lic.learn(common.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text"))


def families(model, text):
    return ",".join(sorted(model.scan([text])[0][1]))


@pytest.mark.parametrize("text,want", [
    ("licensed under the terms of the MIT license", "mit"), ("SPDX-License-Identifier: GPL-2.0-only", "gpl"), ("// SPDX-License-Identifier: MIT", "mit"),
    ("distributed under the GPLv3", "gpl"), ("CC BY-SA 4.0", "cc-by-sa"), ("Boost Software License - Version 1.0", "boost"), ("Eclipse Public License - v 2.0", "eclipse"),
    ("ISC License", "isc"), ("All rights reserved.", "all-rights-reserved"), ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "lgpl"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under CC BY 4.0.", "cc-by"),
    ("NOT licensed under the Apache License, Version 2.0", ""), ("This code was never released under the MIT License", ""), ("This is not under the BSD license", ""),
    ("he studied at MIT and got a license", ""), ("Redistribution of wealth and use in source\nand binary stars, with or\nwithout modification", "")])
def test_wordings(model, text, want):
    assert families(model, text) == want


def test_a_licence_inside_long_text(model):
    filler = "the river went along the old stones and nobody knew the way to the house " * 40
    assert families(model, filler + "\nReleased under the MIT License.\n" + filler) == "mit"
    assert families(model, filler + "\n\n" + "/* Licensed under the Apache\n * License, Version 2.0 */\n\n" + filler) == "apache"
    assert families(model, filler) == ""
    for k in range(8):  # wherever a window begins, it sees the negation
        assert families(model, "word " * (40 + k) + "not licensed under the MIT License. " + filler) == ""


def brute_confirmed(family, words):
    """The words' pairs (and words) against the family's templates, as sets of strings."""
    low = lambda t: re.sub(r"[^\w]+|_+", " ", t).lower().split()
    pairs = lambda w: {(a, b) for a, b in zip(w, w[1:])} if len(w) > 1 else set(w)
    own = pairs(words) | set(words)
    for t in lic.template_texts()[family]:
        p = pairs(low(t))
        if len(own & p) >= (len(p) if len(p) < lic.SHORT else lic.CONFIRM * len(p)):
            return True
    return False


def test_confirmation_equals_brute_force(model):
    rng = np.random.RandomState(3)
    texts = [t for f in lic.FAMILIES for t in lic.template_texts()[f]]
    words = [w for t in texts for w in lic.plain(t).lower().split()]
    seen = set()
    for k in range(800):
        w = lic.plain(texts[rng.randint(len(texts))]).lower().split()
        if k % 3:
            w = [x if rng.rand() > 0.1 else words[rng.randint(len(words))] for x in w]
        if k % 5 == 0:
            w = w + lic.plain(texts[rng.randint(len(texts))]).lower().split()
        h, _ = tx.words(pa.array([" ".join(w)]))
        own = lic.marks_of(h) | set(h.tolist())
        for f in lic.FAMILIES:
            assert model.confirmed(f, own) == brute_confirmed(f, w), (f, w)
            seen.add(model.confirmed(f, own))
    assert seen == {True, False}


def test_templates_make_no_prediction(model):
    """A unit that the classifier calls unknown has no licence, whatever templates it holds."""
    text = "not licensed under the MIT License"
    h, at, _, _ = lic.units([text])
    assert model.confirmed("mit", lic.marks_of(h)) and model.probabilities(h, at)[0, -1] > 0.5 and families(model, text) == ""


def test_windows_cover_every_word():
    rng = np.random.RandomState(1)
    for n in (1, 19, 20, 21, 47, 48, 49, 72, 100, 500):
        text = " ".join(f"w{rng.randint(999)}" for _ in range(n))
        h, at, ptr, paragraphs = lic.units([text, "", "a\n\nb"])
        own = at[ptr[0]:ptr[1]]
        assert ptr[1] == ptr[2] and paragraphs == [1, 0, 2] and (own[:, 1] - own[:, 0] <= 48).all()
        for s in range(n - 7):  # eight words in a row are compared with templates together
            assert ((own[:, 2] <= s) & (own[:, 1] >= s + 8)).any()
            assert s < lic.BEFORE or ((own[:, 0] <= s - lic.BEFORE) & (own[:, 2] <= s) & (own[:, 1] >= s + 8)).any()


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (1, "", 1.0), (None, "MIT License", 2.0), (2, " \n\t", 1.0)], "doc_id long, text string, score double")
    rows = {(r.doc_id, r.licences): r for r in lic.scan(docs).collect()}
    assert rows[None, "mit"].licence == "mit" and rows[None, "mit"].score > 0.5
    assert sum(r.n_paragraphs for r in rows.values()) == 1 and rows[1, ""].licence is None and rows[1, ""].score == 0
    assert lic.scan(docs.limit(0)).count() == 0
