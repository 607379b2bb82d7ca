"""The encoder on texts of all scripts against the library."""
import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from rxatlas.llm import bpe
from rxatlas.llm.queries import vocabulary


def same(texts, own, lib):
    ids, ptr = own.encode(pa.array(texts))
    for t, e, s, x in zip(texts, lib.encode_batch(texts, add_special_tokens=False), ptr[:-1], ptr[1:]):
        assert ids[s:x].tolist() == e.ids, t[:200]


def test_every_code_point():
    own, lib = bpe.Encoder(vocabulary()), Tokenizer.from_file(vocabulary())
    odd = own._tables()[2]
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for group in ([c for c in points if not odd[c]], [c for c in points[::7] if odd[c]]):  # the array steps in full; the library agrees with itself
        same(["".join(f"a{chr(c)} {chr(c)}{chr(c)}b " for c in group[s:s + 1000]) for s in range(0, len(group), 1000)], own, lib)


def test_texts_of_all_scripts():
    rng = random.Random(5)
    own, lib = bpe.Encoder(vocabulary()), Tokenizer.from_file(vocabulary())
    chars = "abcsrtvemld'’“”—…🤦🏼‍♂️ΑΣςЁё中文字한국ひらがなカナñÅéßİıȺ  \n\t12٣½①ﬁ́​<|"
    same(["".join(rng.choice(chars) for _ in range(rng.randrange(80))) for _ in range(2000)], own, lib)
    same(["it’s “fine” — isn't it’ll " * 2000, "中" * 2000, "ΑΣ’" * 1000 + "<|endoftext|>", "é" * 1000], own, lib)


def test_curly_quotes_take_the_array_steps(monkeypatch):
    own = bpe.Encoder(vocabulary())
    monkeypatch.setattr(own, "_encode_slow", lambda _: 1 / 0)
    assert len(own.encode(pa.array(["it’s “fine” — 中文 ΑΣ 🤦", "plain"]))[0]) > 10
    assert np.array_equal(own.encode(pa.array(["ÀB’S"]))[0], own.encode(pa.array(["àb’s"]))[0])
