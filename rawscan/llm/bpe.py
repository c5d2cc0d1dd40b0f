"""BPE encoding and decoding: a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawscan.shipping import ship

#: Longest word in bytes that is merged together with others of its length class; longer ones have a tree of their own.
TOGETHER = 128
#: Distinct words whose ids a worker remembers, and characters that it takes at a time.
REMEMBERED, CHARS = 400_000, 2_000_000
_NONE = np.iinfo(np.int32).max
# How byte-level vocabularies split text into words, with Unicode's properties, and the same for texts in
# Latin-1 alone, for which the standard library's engine is faster.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary read from a tokenizer.json; small and of fixed size, so it can be broadcast."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError("only byte-level BPE without normalizer and prefix space is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with options are not supported")
        letters = byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * top
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.base = top
        keys = np.array([vocab[a] * top + vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, _NONE where no merge is known."""
        key = left * np.int64(self.base) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


def merge_together(vocab: Vocabulary, words: list[bytes], width: int) -> list[list[int]]:
    """Ids of words of 2 to width bytes, all at once; width is a power of two.

    Each word has a row: symbols, links to the neighbours, and a segment tree whose leaf i holds rank * width + i for
    the pair that starts at place i. The root so is the leftmost merge of the lowest rank. A merge sets three leaves
    and their log2(width) ancestors; rows drop out when their root is empty.
    """
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    text = np.frombuffer(b"".join(words), np.uint8)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(text)) - np.repeat(starts, lengths)
    cell = np.repeat(np.arange(n), lengths) * width + place
    ids = np.full(n * width + 1, -1, np.int32)  # the last cell takes what has no neighbour
    ids[cell] = vocab.byte_ids[text]
    void = n * width
    nxt, prv = np.full(void + 1, void, np.int64), np.full(void + 1, void, np.int64)
    inner = place < np.repeat(lengths, lengths) - 1
    nxt[cell[inner]] = cell[inner] + 1
    prv[cell[inner] + 1] = cell[inner]
    tree = np.full((n, 2 * width), _NONE, np.int32)
    first = cell[inner]
    found = vocab.rank(ids[first], ids[first + 1])
    has = found < _NONE
    tree[first[has] // width, width + first[has] % width] = found[has] * width + first[has] % width
    for level in range(width.bit_length() - 2, -1, -1):
        a = 1 << level
        np.minimum(tree[:, 2 * a : 4 * a : 2], tree[:, 2 * a + 1 : 4 * a : 2], out=tree[:, a : 2 * a])
    tree = tree.reshape(-1)
    rows = np.arange(n)
    while True:
        root = tree[rows * 2 * width + 1]
        alive = root < _NONE
        rows, root = rows[alive], root[alive]
        if not len(rows):
            break
        shift = width.bit_length() - 1
        at = rows * width + (root & (width - 1))
        new = vocab.merged[root >> shift]
        right = nxt[at]
        after, before = nxt[right], prv[at]
        ids[at], ids[right], nxt[at] = new, -1, after
        prv[after] = at
        own = rows * 2 * width
        some = after < void
        rank = np.full(len(rows), _NONE, np.int32)
        rank[some] = vocab.rank(new[some], ids[after[some]])
        back = before < void
        rank_b = np.full(len(rows), _NONE, np.int32)
        rank_b[back] = vocab.rank(ids[before[back]], new[back])
        leaf = at & (width - 1)
        leaf_r, leaf_b = right & (width - 1), np.where(back, before & (width - 1), leaf)
        tree[own + width + leaf_r] = _NONE
        tree[own + width + leaf_b] = np.where(rank_b < _NONE, (rank_b << shift) + leaf_b, _NONE)
        tree[own + width + leaf] = np.where(rank < _NONE, (rank << shift) + leaf, _NONE)
        nodes, pairs = [leaf + width, leaf_r + width, leaf_b + width], tree.view(np.int64)
        for _ in range(shift):
            for i in range(3):
                nodes[i] >>= 1
                both = pairs[(own >> 1) + nodes[i]]  # two children side by side
                tree[own + nodes[i]] = np.minimum(both >> 32, both & 0x7FFFFFFF)
    ids = ids[:-1].reshape(n, width)
    flat, kept = ids[ids >= 0].tolist(), np.cumsum((ids >= 0).sum(1)).tolist()
    return [flat[a:b] for a, b in zip([0, *kept[:-1]], kept, strict=True)]


def merge_alone(vocab: Vocabulary, word: bytes) -> list[int]:
    """Ids of one word of any length: the same tree in plain lists, n log n in all."""
    ids = vocab.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    n = len(ids)
    width = 1 << max(1, (n - 1).bit_length())
    empty = int(_NONE)
    ranks = dict(zip(vocab.keys.tolist(), vocab.ranks.tolist(), strict=True)) if n > 4096 else None

    def rank(a, b):
        if ranks is not None:
            return ranks.get(a * vocab.base + b, empty)
        at = int(np.searchsorted(vocab.keys, a * vocab.base + b))
        return int(vocab.ranks[at]) if at < len(vocab.keys) and vocab.keys[at] == a * vocab.base + b else empty

    tree = [empty] * (2 * width)
    for i in range(n - 1):
        r = rank(ids[i], ids[i + 1])
        tree[width + i] = r * width + i if r < empty else empty
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i, r):
        node = width + i
        tree[node] = r * width + i if r < empty else empty
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low

    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] < empty:
        r, i = divmod(tree[1], width)
        ids[i] = int(vocab.merged[r])
        right = nxt[i]
        ids[right] = -1
        nxt[i] = nxt[right]
        put(right, empty)
        if nxt[i] < n:
            prv[nxt[i]] = i
            put(i, rank(ids[i], ids[nxt[i]]))
        else:
            put(i, empty)
        if prv[i] >= 0:
            put(prv[i], rank(ids[prv[i]], ids[i]))
    return [x for x in ids if x >= 0]


class Codec:
    """Encodes and decodes texts as the vocabulary's library does; remembers words up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.words, self.latin_words = regex.compile(WORDS).findall, re.compile(LATIN_WORDS).findall
        self.added = regex.compile("|".join(map(regex.escape, sorted(vocab.added, key=len, reverse=True)))) if vocab.added else None
        self.known: dict[str, tuple[int, ...]] = {}
        self.numbers = list(range(vocab.base))

    def _learn(self, words: set[str]) -> None:
        number, classes = self.numbers.__getitem__, {}
        for word in words:
            raw = word.encode()
            if len(raw) == 1:
                self.known[word] = (int(self.vocab.byte_ids[raw[0]]),)
            elif len(raw) > TOGETHER:
                self.known[word] = tuple(map(number, merge_alone(self.vocab, raw)))
            else:
                classes.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((word, raw))
        for width, members in classes.items():
            step = max(1, 400_000 // width)
            for i in range(0, len(members), step):
                part = members[i : i + step]
                for (word, _), ids in zip(part, merge_together(self.vocab, [raw for _, raw in part], width), strict=True):
                    self.known[word] = tuple(map(number, ids))

    def _split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words(text)
        return self.latin_words(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = []
        for text in texts:
            if self.added is not None and self.added.search(text):
                parts, at = [], 0
                for m in self.added.finditer(text):
                    parts += [*self._split(text[at : m.start()]), (self.vocab.added[m[0]],)]
                    at = m.end()
                split.append(parts + self._split(text[at:]))
            else:
                split.append(self._split(text))
        missing = {w for words in split for w in set(words) if w not in self.known}
        specials = {w: w for w in missing if isinstance(w, tuple)}
        self._learn(missing - specials.keys())
        self.known |= specials
        return [list(chain.from_iterable(map(self.known.__getitem__, words))) for words in split]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def encoded(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ids (array of int), decoded.

    ids are those of the library that the vocabulary file is for, without special tokens added, but with the strings of
    added tokens recognised; decoded is what the ids stand for. The driver reads the file and broadcasts it. Null text
    counts as empty and gives no ids and an empty text. Words of any length are merged whole, in n log n. Repeated rows
    give repeated results, empty input none; further columns are ignored.
    """
    return _mapped(docs, vocab_path, (id_col,), text_col, "ids array<int>, decoded string", lambda ids, text: (ids, text))


def digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """As encoded(), with n_tokens, ids_sha256 and decoded_sha256 in place of the ids and the text, which stay in Python.

    Columns of keep are passed on.
    """
    return _mapped(docs, vocab_path, (id_col, *keep), text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", None)


def _mapped(docs, vocab_path, passed, text_col, columns, keep) -> DataFrame:
    ship(docs.sparkSession)
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocab_path))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed)
    names = [*passed, *[c.strip().split(" ")[0] for c in columns.split(",")]]
    types = [pa.list_(pa.int32()), pa.string()] if keep else [pa.int64(), pa.string(), pa.string()]

    def run(batches):
        codec = Codec(vocab.value)
        names_of = [str(i) for i in range(codec.vocab.base)]
        sha = lambda raw: hashlib.sha256(raw).hexdigest()

        def rows(texts):
            for ids in codec.encode(texts):
                text = codec.decode(ids)
                if keep:
                    yield keep(ids, text)
                else:
                    yield len(ids), sha(",".join(map(names_of.__getitem__, ids)).encode()), sha(text.encode())

        for batch in batches:
            texts, at, sizes = batch.column(0), 0, batch.column(1).to_pylist()
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + sizes[end] <= CHARS):
                    chars += sizes[end]
                    end += 1
                done = list(zip(*rows(texts.slice(at, end - at).to_pylist()), strict=True))
                arrays = [*[c.slice(at, end - at) for c in batch.columns[2:]], *[pa.array(v, t) for v, t in zip(done, types, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names)
                at = end

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(text.alias("_text"), F.length(text).alias("_n"), *passed).mapInArrow(run, f"{schema}, {columns}")
