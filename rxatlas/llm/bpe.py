"""BPE encoding by forced boundaries, and decoding.

No token of the vocabulary holds certain pairs of neighbouring bytes. No merge
can reach across such a pair, so a word may be cut there for certain; the
fragments are encoded one by one and the ids concatenated. The same fragment
comes back often: each batch encodes its distinct new fragments together, merge
by merge, as array steps, and looks the others up.

Text takes the tokenizer's route: special tokens first, then NFC, runs of white
space, lower case, the split pattern, and bytes. Texts of Latin letters below
U+0240 do this as array steps over bytes, texts of any other characters whose
normal form is the character itself as array steps over code points. Only for
texts that hold a special token's string, combining marks, or characters that
change their length with their case, the tokenizer's own normalizer and
pre-tokenizer deliver the words, which are then cut and merged in the same way.
Null text is empty. Texts of any length are taken in slices that end at white
space (the last kind by the library as a whole).

Defined cases of the queries' functions: rows are independent, null and repeated
ids are kept, empty tables give empty tables, further columns are left behind.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from rxatlas.llm import text as tx

U = np.uint64
#: Fragments remembered by a worker; beyond it the memory starts anew.
REMEMBERED = 2_000_000
TABLE_BITS = 22
TABLE_SHIFT, TABLE_MASK = U(64 - TABLE_BITS), U((1 << TABLE_BITS) - 1)
LATIN_END = 0x240
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: What the vocabulary's split pattern lists after an apostrophe.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable
    Latin-1, else the next unused code point from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b not in rest else chr(256 + rest.index(b)) for b in range(256)]


class Encoder:
    """Encodes and decodes Arrow text columns with the vocabulary file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        vocab, suffix = model["model"]["vocab"], model["model"]["end_of_word_suffix"]
        symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.token = [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.final = np.array([vocab[c + suffix] for c in symbols], np.int64)
        self.never = np.ones((256, 256), bool)
        for t in vocab:
            b = [self.byte_of[c] for c in t.removesuffix(suffix)]
            for pair in zip(b, b[1:]):
                self.never[pair] = False
        keys, ranks, made = [], [], []
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]):
            keys.append(vocab[a] << 32 | vocab[b])
            ranks.append(rank)
            made.append(vocab[a + b])
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair = np.array(keys, np.int64)[order]
        self.rank = np.array(ranks, np.int64)[order]
        self.made = np.zeros(len(keys), np.int64)
        self.made[:] = made
        self.to_byte = {ord(c): chr(b) for c, b in self.byte_of.items()}
        self.wide = None
        self._latin()
        self._forget()

    def _latin(self) -> None:
        self.kind = np.full(LATIN_END, OTHER, np.uint8)
        self.low = np.arange(LATIN_END)
        self.odd = np.zeros(LATIN_END, bool)
        for c in range(LATIN_END):
            ch = chr(c)
            for pattern, k in ((r"\s", SPACE), (r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
                if regex.fullmatch(pattern, ch):
                    self.kind[c] = k
            low = unicodedata.normalize("NFC", ch).lower()
            if len(low) != 1 or len(low.encode()) != len(ch.encode()):
                self.odd[c] = True
            else:
                self.low[c] = ord(low)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids begin (n+1 values)."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        buf, at = tx.flat(texts)
        slow = self._not_plain(texts, buf, at)
        counts = np.zeros(len(at), np.int64)
        ids = []
        for s, e in self._ranges(buf, at, slow):
            if s < 0:
                own = self._encode_any(buf[at[e]:at[e + 1]])
                counts[e + 1] += len(own)
                ids.append(own)
                continue
            k0, k1 = int(np.searchsorted(at, s, "right")) - 1, int(np.searchsorted(at, e, "left"))
            inner = np.clip(at[k0:k1 + 1], s, e) - s
            own, upto = self._encode_plain(buf[s:e], inner)
            counts[k0 + 1:k1 + 1] += np.diff(upto)
            ids.append(own)
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), np.cumsum(counts)

    def _not_plain(self, texts: pa.Array, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        slow = np.zeros(len(at) - 1, bool)
        lead = np.flatnonzero((buf >= 0xC2) & (buf <= 0xC8))
        code = ((buf[lead].astype(np.int64) & 0x1F) << 6) | (buf[np.minimum(lead + 1, len(buf) - 1)] & 0x3F)
        hit = np.concatenate((np.flatnonzero(buf > 0xC8), lead[self.odd[code]])) if len(buf) else lead
        slow[np.searchsorted(at, hit, "right") - 1] = True
        for s in self.special:
            slow |= pc.fill_null(pc.match_substring(texts, s), False).to_numpy(zero_copy_only=False)
        return slow

    @staticmethod
    def _ranges(buf, at, slow):
        """Byte ranges over plain texts, and (-1, k) for each text k that isn't."""
        odd = np.flatnonzero(slow)
        begin = 0
        for k in [*odd, len(slow)]:
            s, e = at[begin], at[k] if k < len(slow) else len(buf)
            if e > s:
                for a, b in tx._slices(buf[s:e], at[begin:k + 1] - s):
                    yield int(a + s), int(b + s)
            if k < len(slow):
                yield -1, int(k)
            begin = k + 1

    def _encode_plain(self, raw: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(raw)
        b = raw.copy()
        wide = np.flatnonzero(raw >= 0xC2)
        code = ((raw[wide].astype(np.int64) & 0x1F) << 6) | (raw[wide + 1] & 0x3F)
        narrow = raw < 0x80
        kind = np.empty(n, np.uint8)
        b[narrow] = self.low[:128].astype(np.uint8)[raw[narrow]]
        kind[narrow] = self.kind[:128][raw[narrow]]
        b[wide] = 0xC0 | (self.low[code] >> 6)
        b[wide + 1] = 0x80 | (self.low[code] & 0x3F)
        kind[wide] = kind[wide + 1] = self.kind[code]
        first = np.ones(n, bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        first[wide + 1] = False
        first[inner[inner < n]] = True
        return self._words(b, kind, first, inner)

    def _words(self, b: np.ndarray, kind: np.ndarray, first: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-cased bytes whose words begin at ``first``."""
        n = len(b)
        quote = np.flatnonzero((b == 0x27) & first)
        if len(quote):
            end = inner[np.searchsorted(inner, quote, "right").clip(max=len(inner) - 1)]
            for c in CONTRACTIONS:
                ok = quote[quote + len(c) < end]
                for k, x in enumerate(c):
                    ok = ok[b[ok + 1 + k] == x]
                first[ok + 1] = False
                after = ok + 1 + len(c)
                first[after[after < n]] = True
        cut = first.copy()
        cut[1:] |= self.never[b[:-1], b[1:]]
        word = kind != SPACE
        begin = np.flatnonzero(cut & word)
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(inner), np.int64)
        stop = np.ones(n, bool)
        stop[:-1] = cut[1:] | ~word[1:]
        end = np.flatnonzero(stop & word) + 1
        whole = np.ones(n + 1, bool)
        whole[:n] = first | ~word
        return self._lookup(b, begin, end, whole[end], inner)

    def _lookup(self, b, begin, end, final, inner):
        p, inverse = tx.powers(len(b) + 1)
        run = np.empty(len(b) + 1, U)
        run[0] = 0
        np.cumsum((b.astype(U) * U(0x9FB21C651E98DF25) + U(0x632BE59BD9B4E019)) * p[:len(b)], out=run[1:])
        key = tx.mix((run[end] - run[begin]) * inverse[begin] + final.astype(U))
        slot = self._slots(key)
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            if len(self.known) > REMEMBERED:
                self._forget()
                slot[:] = -1
                miss = np.arange(len(key))
            unique, where, back = np.unique(key[miss], return_index=True, return_inverse=True)
            k = miss[where]
            ids, size = self._merge(b, begin[k], end[k], final[k])
            new = np.arange(len(self.known), len(self.known) + len(unique), dtype=np.int32)
            at = len(self.pool) + np.concatenate(([0], np.cumsum(size)[:-1]))
            self.pool = np.concatenate((self.pool, ids.astype(np.int32)))
            self.known = np.concatenate((self.known, unique))
            self.at = np.concatenate((self.at, at))
            self.size = np.concatenate((self.size, size.astype(np.int32)))
            slot[miss] = new[back]
            one, two = unique >> TABLE_SHIFT, unique & TABLE_MASK
            free = self.table[0, one] < 0
            self.table[0, one[free]] = new[free]
            self.table[1, two[~free]] = new[~free]
        at, size = self.at[slot], self.size[slot].astype(np.int64)
        ids = self.pool[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        upto = np.concatenate(([0], np.cumsum(size)))
        return ids, upto[np.searchsorted(begin, inner, "left")]

    def _slots(self, key: np.ndarray) -> np.ndarray:
        """Where each fragment is remembered, else -1: two places in a table by its hash."""
        slot = self.table[0, key >> TABLE_SHIFT]
        if not len(self.known):
            return slot
        slot[self.known[slot] != key] = -1
        rest = np.flatnonzero(slot < 0)
        second = self.table[1, key[rest] & TABLE_MASK]
        slot[rest] = np.where(self.known[second] == key[rest], second, -1)
        return slot

    def _forget(self) -> None:
        self.table = np.full((2, 1 << TABLE_BITS), -1, np.int32)
        self.known, self.at = np.zeros(0, U), np.zeros(0, np.int64)
        self.size, self.pool = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _merge(self, b, begin, end, final) -> tuple[np.ndarray, np.ndarray]:
        """Merges all fragments together: in every step each fragment applies
        its lowest-ranked pair, everywhere from the left."""
        size = end - begin
        owner = np.repeat(np.arange(len(size)), size)
        ptr = np.concatenate(([0], np.cumsum(size)))
        b = b[np.repeat(begin - ptr[:-1], size) + np.arange(ptr[-1])]
        ids = self.inner[b]
        last = ptr[1:] - 1
        ids[last[final]] = self.final[b[last[final]]]
        done_ids, done_owner = [], []
        none = len(self.rank)
        while len(ids) > 1:
            key = (ids[:-1] << 32) | ids[1:]
            k = np.searchsorted(self.pair, key)
            k[k == len(self.pair)] = 0
            rank = np.where((self.pair[k] == key) & (owner[1:] == owner[:-1]), self.rank[k], none)
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(ids)))
            over = np.repeat(least == none, lengths)
            if over.any():
                done_ids.append(ids[over])
                done_owner.append(owner[over])
                keep = ~over
                ids, owner, rank = ids[keep], owner[keep], rank[keep]
                lengths, least = lengths[least < none], least[least < none]
                if not len(ids):
                    break
            hit = rank == np.repeat(least, lengths)
            chained = np.flatnonzero(hit[1:] & hit[:-1]) + 1  # overlapping pairs of equal ids: every other one, from the left
            if len(chained):
                groups = np.split(chained, np.flatnonzero(np.diff(chained) > 1) + 1)
                for g in groups:
                    hit[g[::2]] = False
            at = np.flatnonzero(hit)
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        if len(ids):
            done_ids.append(ids)
            done_owner.append(owner)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(size))

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every code point: its lower case, its kind, and whether the array
        steps can't take it: it is unassigned, or may change with its neighbours
        (normal form) or in length (lower case)."""
        every = [chr(c) for c in range(0x110000)]
        low, odd = np.arange(0x110000, dtype=np.int32), np.zeros(0x110000, bool)
        text = "".join(ch for c, ch in enumerate(every) if not 0xD800 <= c < 0xE000)
        kind = np.full(0x110000, OTHER, np.uint8)
        for pattern, k in ((r"\s", SPACE), (r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
            kind[[ord(ch) for ch in regex.findall(pattern, text)]] = k
        odd[0xD800:0xE000] = odd[0x1161:0x1176] = odd[0x11A8:0x11C3] = True  # vowels and finals that compose with what stands before
        for c, ch in enumerate(every):
            parts = unicodedata.decomposition(ch)
            if parts and parts[0] != "<":
                odd[[int(x, 16) for x in parts.split()[1:]]] = True  # compose with what stands before
        for c in np.flatnonzero(~odd).tolist():
            ch = every[c]
            if unicodedata.category(ch) == "Cn" or unicodedata.combining(ch) or not unicodedata.is_normalized("NFC", ch):
                odd[c] = True
            elif (x := ch.lower()) != ch:
                if len(x) != 1 or len(x.encode()) != len(ch.encode()):
                    odd[c] = True
                else:
                    low[c] = ord(x)
        return low, kind, odd

    def _encode_any(self, raw: np.ndarray) -> np.ndarray:
        """A text that isn't plain Latin."""
        text = raw.tobytes().decode()
        if self.wide is None:
            self.wide = self._tables()
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if self.wide[2][code].any() or any(s in text for s in self.special):
            return self._encode_slow(text)
        out = [self._encode_wide(raw[s:e]) for s, e in tx._slices(raw, np.array([0, len(raw)]))]
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def _encode_wide(self, raw: np.ndarray) -> np.ndarray:
        low, kinds, _ = self.wide
        code = low[np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)]
        b = np.frombuffer(code.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        n = len(b)
        start = np.flatnonzero((raw & 0xC0) != 0x80)
        kind = kinds[code]
        first = np.zeros(n, bool)
        head = np.ones(len(code), bool)
        head[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        first[start[head]] = True
        return self._words(b, np.repeat(kind, np.diff(np.append(start, n))), first, np.array([0, n]))[0]

    def _encode_slow(self, text: str) -> np.ndarray:
        pattern = "(" + "|".join(map(regex.escape, self.special)) + ")"
        out = []
        for k, part in enumerate(regex.split(pattern, text)):
            if k % 2:
                out.append(np.array([self.special[part]]))
                continue
            words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))] if part else []
            if not words:
                continue
            b = np.frombuffer("".join(words).translate(self.to_byte).encode("latin-1"), np.uint8)  # a symbol a byte
            whole = np.zeros(len(b) + 1, bool)
            whole[np.concatenate(([0], np.cumsum([len(w) for w in words])))] = True
            cut = whole.copy()
            cut[1:-1] |= self.never[b[:-1], b[1:]]
            edge = np.flatnonzero(cut)
            out.append(self._lookup(b, edge[:-1], edge[1:], whole[edge[1:]], np.array([0, len(b)]))[0])
        return np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of ``ids``: the vocabulary file names no decoder,
        so tokens stand as they are, a blank between them."""
        token = self.token
        return b" ".join([token[i] for i in ids.tolist()])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a worker process for ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_digests(docs, path: str):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``
    (doc_id, text). Rows are independent: null and repeated ids are kept."""
    import hashlib

    def run(batches):
        e = encoder(path)
        for b in batches:
            ids, ptr = e.encode(b.column("text"))
            one, two = [], []
            for s, t in zip(ptr[:-1], ptr[1:]):
                own = ids[s:t]
                one.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                two.append(hashlib.sha256(e.decode(own)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(ptr)), pa.array(one, pa.string()),
                                              pa.array(two, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    from rxatlas.llm.common import columns
    return columns(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
