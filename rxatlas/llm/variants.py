"""Spelling variants: words that differ by one code point, and the form each belongs to.

Two words are near if one inserted, deleted or replaced code point makes one of
the other. Near words are found over an index of grams of variable length:

* Gram dictionary. A trie of grams over the words with a mark at both ends,
  level by level: a gram is extended while more than ``T`` words' places hold it
  (it is heavy then), up to QMAX. ``T`` is at least LEAST_LIST and at least a
  DICTIONARY-th of all places, so each level has at most DICTIONARY heavy grams
  and the dictionary that workers get is bounded whatever the vocabulary.
* Decomposition. At each place a word has the shortest gram that is not heavy.
  A gram depends on its own letters alone, so one edit affects only the grams
  over it; the most grams any place lies under is the word's bound of affected
  grams. Words of length c and c+1 are compared in class c, whose grams have at
  most (c+2)//2 letters: then one edit always leaves a gram on one side of it.
* List merging. Near words share all grams that the edit leaves. In any order of
  grams the first shared one comes, in either word, after affected ones only, so
  it is among the word's first (bound + 1) grams, and only these are indexed.
  Grams that are not heavy come first in the order. What an edit leaves before
  (behind) it is equal from the word's begin (to its end), so the list of a gram
  is split by all that stands before it (behind it).
* Lists of grams that are not heavy have at most ``T`` members by construction;
  their pairs are verified letter by letter inside tasks and only near pairs are
  given out. A word whose first grams reach a heavy one is also listed under
  itself with each letter left out: such a list holds near words only and is
  bounded by the alphabet. So no list grows with the vocabulary beyond ``T``,
  and no pair is lost.

Defined cases: null and empty texts have no words. Every row counts, repeated
ones as often as they occur; a null doc_id is the empty text in the rule of
typos. Empty tables give empty tables; further columns are left behind. A text
is held whole by one worker.
"""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm.common import columns, stored

BEGIN, END = "^", "$"
QMIN, QMAX = 2, 6
#: Longest list of a gram that isn't heavy while the vocabulary is small; heavy grams of one length at most.
LEAST_LIST, DICTIONARY = 64, 1 << 15
#: Words that a task holds before it hands them on, rows of an index that it hands on together, words of an index task.
HELD, BATCH, TASK_WORDS = 800_000, 200_000, 30_000
LONG_WORD, HASH_BASE, HASH_PRIME = 64, 0x9E3779B97F4A7C15 % (2**61 - 1), 2**61 - 1
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(docs: DataFrame, least_chars: int = 7, typos: int | None = None) -> DataFrame:
    """(word, n): maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of at least
    ``least_chars`` code points over whole texts, A-Z lower-cased, with their
    number. With ``typos``, a run whose crc32 with its doc_id that number divides
    loses one code point, as the query's contract has it."""
    run_of = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_chars)

    def run(batches):
        held: dict[str, int] = collections.defaultdict(int)
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if not t:
                    continue
                own: dict[str, int] = collections.defaultdict(int)
                for w, n in collections.Counter(run_of.findall(t)).items():
                    own[w.translate(LOW)] += n
                begin = zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode()))
                for w, n in own.items():
                    if typos and (h := zlib.crc32(w.encode(), begin)) % typos == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1:]
                        if len(w) < least_chars:
                            continue
                    held[w] += n
                if len(held) > HELD:
                    yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})

    found = columns(docs, doc_id="long", text="string").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def heavy_grams(words: DataFrame, least_list: int = LEAST_LIST, dictionary: int = DICTIONARY) -> set[str]:
    """The grams that are extended: more than ``T`` places of the words hold
    them. At most ``dictionary`` of each length come to the driver."""
    places = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0
    most = max(least_list, -(-places // dictionary))
    heavy: set[str] = set()
    for q in range(QMIN, QMAX + 1):
        sent = words.sparkSession.sparkContext.broadcast(heavy)

        def grams(batches, q=q, sent=sent):
            inner = sent.value
            held: dict[str, int] = collections.defaultdict(int)
            for b in batches:
                for w in b.column("word").to_pylist():
                    w = BEGIN + w + END
                    for k in range(len(w) - q + 1):
                        g = w[k:k + q]
                        if q == QMIN or g[:-1] in inner:
                            held[g] += 1
                if len(held) > HELD:
                    yield pa.RecordBatch.from_pydict({"gram": list(held), "n": list(held.values())})
                    held.clear()
            if held:
                yield pa.RecordBatch.from_pydict({"gram": list(held), "n": list(held.values())})

        level = words.select("word").mapInArrow(grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        found = {r.gram for r in level.where(F.col("n") > most).collect()}
        if not found:
            break
        heavy |= found
    return heavy


def decompose(word: str, longest: int, heavy: set[str]) -> list[tuple[int, int]]:
    """Begin and end of the gram at each place of the marked word."""
    n, out = len(word), []
    for p in range(n - QMIN + 1):
        e = p + QMIN
        while e < n and e - p < longest and word[p:e] in heavy:
            e += 1
        out.append((p, e))
    return out


def affected(grams: list[tuple[int, int]], n: int) -> int:
    """The most grams that one edit of a marked word of n letters can affect."""
    over = [0] * n
    for p, e in grams:
        for i in range(p, e):
            over[i] += 1
    return max(over[1:n])


def hole_keys(word: str, shorter: int) -> list[str]:
    """The lists of a word under itself with a letter left out; a word of length
    c+1 stands where a shorter one would be it. Of long words the key holds a
    hash, so that a word's keys grow with its length and not with its square."""
    n, own = len(word), len(word) == shorter
    if shorter <= LONG_WORD:
        if not own:
            return [f"{shorter}-{word[:i]}{word[i + 1:]}" for i in range(n)]
        return [f"{shorter}-{word}", *[f"{shorter}*{word[:i]}*{word[i + 1:]}" for i in range(n)]]
    upto, power = [0], [1]
    for ch in word:
        upto.append((upto[-1] * HASH_BASE + ord(ch)) % HASH_PRIME)
        power.append(power[-1] * HASH_BASE % HASH_PRIME)
    holes = [((upto[i] - upto[i + 1]) * power[n - i - 1] + upto[n]) % HASH_PRIME for i in range(n)]
    if not own:
        return [f"{shorter}-{h}" for h in holes]
    return [f"{shorter}-{upto[n]}", *[f"{shorter}*{i}*{h}" for i, h in enumerate(holes)]]


def index_keys(word: str, shorter: int, heavy: set[str]) -> set[str]:
    """The lists of class ``shorter`` that the word stands in."""
    w = BEGIN + word + END
    grams = decompose(w, min(QMAX, (shorter + 2) // 2), heavy)
    bound = affected(grams, len(w))
    order = sorted((w[p:e] in heavy, e - p, w[p:e], p, e) for p, e in grams)  # a short gram that isn't heavy is a rare one
    keys, before, last = set(), 0, None
    for k, (is_heavy, _, g, p, e) in enumerate(order):
        if g != last:
            before, last = k, g  # so many grams come before this one
        if before > bound:
            break
        if is_heavy:
            keys.update(hole_keys(word, shorter))
            break
        keys.add(f"{shorter}<{w[:e]}")
        keys.add(f"{shorter}>{w[p:]}")
    return keys


def near(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes b of a."""
    if len(a) == len(b):
        return sum(map(str.__ne__, a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    if len(a) + 1 != len(b):
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1:]


def near_pairs(words: DataFrame, heavy: set[str], least_chars: int) -> DataFrame:
    """(a, b), a < b: all near words of ``words`` (word), each pair once."""
    sent = words.sparkSession.sparkContext.broadcast(heavy)

    def index(batches):
        dictionary = sent.value
        classes, keys, own = [], [], []

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(classes, pa.int32()), pa.array(keys, pa.string()), pa.array(own, pa.string())],
                                              names=["class", "key", "word"])

        for b in batches:
            for w in b.column("word").to_pylist():
                for c in (len(w), len(w) - 1):
                    if c >= least_chars:
                        found = index_keys(w, c, dictionary)
                        keys.extend(found)
                        classes.extend([c] * len(found))
                        own.extend([w] * len(found))
            if len(keys) > BATCH:
                yield rows()
                classes, keys, own = [], [], []
        if keys:
            yield rows()

    def pairs(shorter: int, members: list[str], found: set):
        own = [w for w in members if len(w) == shorter]
        longer = [w for w in members if len(w) != shorter]  # these meet each other in class c+1
        for i, a in enumerate(own):
            for x in own[i + 1:]:
                if near(a, x):
                    found.add((a, x) if a < x else (x, a))
            for x in longer:
                if near(a, x):
                    found.add((a, x) if a < x else (x, a))

    def verify(batches):
        rest = None  # the rows of a batch's last list, which may go on
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            key, shorter = batch.column("key").to_numpy(), batch.column("class").to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]) | (shorter[1:] != shorter[:-1])) + 1
            last = int(cut[-1]) if len(cut) else 0
            rest = batch.slice(last)
            yield from listed(batch.slice(0, last), np.concatenate(([0], cut))[:len(cut) + 1], shorter)
        if rest is not None:
            yield from listed(rest, np.array([0, rest.num_rows]), rest.column("class").to_numpy())

    def listed(batch, edge, shorter):
        size = np.diff(edge)
        many = np.flatnonzero(size > 1)  # a list of one has no pair
        if len(many):
            at = np.repeat(edge[many] - np.concatenate(([0], np.cumsum(size[many])[:-1])), size[many]) + np.arange(size[many].sum())
            words_, ptr, found = batch.column("word").take(pa.array(at)).to_pylist(), 0, set()
            for k, n in zip(edge[many].tolist(), size[many].tolist()):
                pairs(int(shorter[k]), words_[ptr:ptr + n], found)
                ptr += n
            if found:
                a, x = zip(*found)
                yield pa.RecordBatch.from_pydict({"a": list(a), "b": list(x)})

    n = words.count()
    rows = words.select("word").repartition(max(1, -(-n // TASK_WORDS)), "word").mapInArrow(index, "class int, key string, word string")
    # lists are told apart by a hash: where two meet, their pairs are verified all the same
    lists = rows.select("class", F.xxhash64("key").alias("key"), "word").repartition("key").sortWithinPartitions("key", "class")
    return lists.mapInArrow(verify, "a string, b string").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of each chain of forms.
    A form has at least ``ratio`` times the number of its word, so chains are
    short; each step doubles the way gone."""
    step = forms.select("word", F.col("form").alias("root"))
    while True:
        far = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(step.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        if not step.where("moved").limit(1).count():
            return step.select("word", "root")
        step = step.drop("moved")


def group_variants(words: DataFrame, least_chars: int = 7, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per row of ``words`` (word, n; words
    distinct and of at least ``least_chars`` code points). form: the near word of
    largest n (ties: the smallest in code-point order) if it has at least
    ``ratio`` (over 1) times the word's n; root: where following forms ends."""
    words = stored(words.select("word", "n"), "variants-words")
    pairs = near_pairs(words, heavy_grams(words), least_chars)
    pairs = stored(pairs, "variants-pairs")
    both = pairs.union(pairs.select("b", "a"))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("other_n"))
    best = both.join(other, "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("k"), F.col("b").alias("form"))).alias("top"))
    best = best.select(F.col("a").alias("word"), "n_near", "top.form", (-F.col("top.k")).alias("form_n"))
    known = words.join(best, "word", "left")
    fits = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    known = stored(known.select("word", F.when(fits, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(fits, F.col("form_n")).alias("form_n")), "variants-forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
