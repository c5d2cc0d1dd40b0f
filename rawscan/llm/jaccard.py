"""Exact n-gram Jaccard self-join and its components."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawscan.llm.common import dropped, hot_keys, replicated, salted, stored_at
from rawscan.llm.components import components
from rawscan.shipping import ship

#: Words whose hashes a worker remembers; tokens of a chunk: those that it holds before it hands them on.
REMEMBERED, HELD = 250_000, 400_000
#: Tokens of a bucket, about, and buckets at least.
BUCKET_TOKENS, MIN_BUCKETS = 500_000, 32
#: Tables of up to so many rows (of some 20 bytes) are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 150_000
#: Members of a leader's group at most that are compared with as many others at a time, and bytes of theirs, about.
BLOCK, BLOCK_BYTES = 512, 32 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str, width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles: width words each, or all words where there are fewer."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z alone, and white space 0x20, 0x09-0x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out *= _MUL
        out += h[i : i + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _spare(n, percent):
    """How many of its n tokens a set may hold that a linked one hasn't."""
    return n - -(-n * percent // 100)


def _lowest(n, percent):
    """How many of its lowest tokens a set hands on."""
    return min(n, 2 * _spare(n, percent) + 4)


def _needed(n, percent):
    """How many of those any linked set hands on too: at least what the smallest set it can be linked with has left of its
    own when all that it may spare are gone, as that number never falls with the size."""
    least = -(-n * percent // 100)
    return _lowest(least, percent) - _spare(least, percent)


def _batch(columns, types, names):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _blobs(key: np.ndarray, *arrays: np.ndarray):
    """Rows (key, bytes of each array) for each distinct key."""
    order = np.argsort(key, kind="stable")
    keys, starts = np.unique(key[order], return_index=True)
    ends = [*starts[1:].tolist(), len(key)][: len(starts)]
    sorted_arrays = [a[order] for a in arrays]
    return keys, [[a[s:e].tobytes() for s, e in zip(starts, ends, strict=True)] for a in sorted_arrays]


_BLOB = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_BLOB_NAMES = ["bucket", "a", "b", "c"]
_BLOB_SCHEMA = "bucket bigint, a binary, b binary, c binary"
#: Kinds of rows of _signed: documents, tokens by bucket of tokens, counts of tokens by bucket of sets.
_DOCUMENT, _TOKENS, _COUNTS = 0, 1, 2


def _joined(batches):
    """The blobs of a partition by bucket: lists of the three byte strings."""
    held = defaultdict(lambda: ([], [], []))
    for batch in batches:
        for bucket, *blobs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            for x, y in zip(held[bucket], blobs, strict=True):
                x.append(y)
    return held


def _signed(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """Rows of three kinds: id, n, s1, s2 for each document, and bucket, a, b, c with what tells viable sets.

    Of linked sets each holds at most `spare` tokens that the other hasn't. So the lowest 2 * spare + 4 by hash of either
    begin with the same common tokens, spare + 4 or more of the smaller set's. A set with fewer tokens among its lowest
    that other sets hand on too is linked with nothing. A task takes its distinct sets in chunks. A token that two sets of
    a chunk hold is counted for them at once, and one mark goes to the token's bucket; a token of a single set goes there
    with the set. So a bucket gets a token once a chunk, however many documents have it.
    """

    def run(batches):
        hashes, met = _Hashes(), set()
        tails, sets, needs, total = [], [], [], 0

        def blobs(kind, key, *arrays):
            keys, columns = _blobs(key.astype(np.int64), *arrays)
            n = len(keys)
            return _batch([[kind] * n, *[[None] * n] * 4, keys, *columns], [pa.int64()] * 5 + _BLOB, ["kind", "id", "n", "s1", "s2", *_BLOB_NAMES])

        def out():
            tok, place = np.concatenate(tails), np.repeat(np.arange(len(tails)), list(map(len, tails)))
            s, need = np.array(sets, np.uint64), np.array(needs, np.uint32)
            order = np.argsort(tok, kind="stable")
            tok, place = tok[order], place[order]
            first = np.concatenate(([True], tok[1:] != tok[:-1]))
            many = ~first
            many[:-1] |= ~first[1:]
            n = np.bincount(place[many], minlength=len(s)).astype(np.uint32)
            some = n > 0
            yield blobs(_COUNTS, s[some] % np.uint64(buckets), s[some], n[some], need[some])
            tok, place, need = tok[first], place[first], np.where(many, np.uint32(0), need[place])[first]
            yield blobs(_TOKENS, (tok >> np.uint64(32)) % np.uint64(buckets), tok.astype(np.uint32), s[place], need)

        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for i, text in zip(ids, batch.column(1), strict=True):
                tok = shingles(text.as_py() or "", width, hashes)
                n, sig = len(tok), xxhash.xxh3_128_intdigest(tok.tobytes())
                s1, s2 = sig >> 64, sig & (1 << 64) - 1
                rows.append((_DOCUMENT, i, n, s1 - (1 << 64) if s1 >> 63 else s1, s2 - (1 << 64) if s2 >> 63 else s2))
                if n and (s1, s2) not in met:
                    met.add((s1, s2))
                    tails.append(tok[: _lowest(n, percent)])
                    sets.append(s1)
                    needs.append(_needed(n, percent))
                    total += len(tails[-1])
                if total >= HELD:
                    yield from out()
                    tails, sets, needs, total = [], [], [], 0
            k = len(rows)
            yield _batch([*zip(*rows, strict=True), *[[None] * k] * 4] if rows else [[]] * 9, [pa.int64()] * 5 + _BLOB, ["kind", "id", "n", "s1", "s2", *_BLOB_NAMES])
        if total:
            yield from out()

    return docs.mapInArrow(run, f"kind bigint, id bigint, n bigint, s1 bigint, s2 bigint, {_BLOB_SCHEMA}")


def _viable(tokens: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """s1 of the sets that hold enough tokens of other sets to be linked with one. A set that copies bring into several
    chunks may be counted more than once, which can only add to the sets."""

    def shared(batches):
        for a, b, c in _joined(batches).values():
            tail = np.frombuffer(b"".join(a), np.uint32)
            s, need = np.frombuffer(b"".join(b), np.uint64), np.frombuffer(b"".join(c), np.uint32)
            order = np.lexsort((s, tail))
            t, o, need = tail[order], s[order], need[order]
            first = np.concatenate(([True], t[1:] != t[:-1]))
            start = np.flatnonzero(first)
            end = np.concatenate((start[1:], [len(t)])) - 1
            many = np.repeat((o[start] != o[end]) | (np.minimum.reduceat(need, start) == 0), end - start + 1)
            own = first | np.concatenate(([True], o[1:] != o[:-1]))  # copies from other chunks count once
            kept = many & own & (need > 0)
            sets, place, n = np.unique(o[kept], return_index=True, return_counts=True)
            if len(sets):
                keys, blobs = _blobs((sets % np.uint64(buckets)).astype(np.int64), sets, n.astype(np.uint32), need[kept][place])
                yield _batch([keys, *blobs], _BLOB, _BLOB_NAMES)

    def summed(batches):
        for a, b, c in _joined(batches).values():
            sets, n, need = (np.frombuffer(b"".join(x), t) for x, t in ((a, np.uint64), (b, np.uint32), (c, np.uint32)))
            distinct, first, place = np.unique(sets, return_index=True, return_inverse=True)
            yield _batch([distinct[np.bincount(place, n) >= need[first]].view(np.int64)], [pa.int64()], ["s1"])

    found = tokens.repartition(buckets, "bucket").mapInArrow(shared, _BLOB_SCHEMA).unionByName(counts)
    return found.repartition(buckets, "bucket").mapInArrow(summed, "s1 bigint").distinct()


def _sets(docs: DataFrame, few: DataFrame, width: int, repeated: bool) -> DataFrame:
    """id (of the set), n, tok (bytes of the sorted tokens), chunk of the sets of few (id, doc, s1, s2). The sets of a
    chunk have some HELD tokens together."""

    def run(batches):
        hashes, chunk, held = _Hashes(), TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            rows = []
            for i, s1, s2, text in zip(*[batch.column(c).to_pylist() for c in range(3)], batch.column(3), strict=True):
                tok = shingles(text.as_py() or "", width, hashes)
                if xxhash.xxh3_128_intdigest(tok.tobytes()) == (s1 % (1 << 64)) << 64 | s2 % (1 << 64):  # else another row of the document
                    rows.append((i, len(tok), tok.tobytes(), chunk))
                    held += len(tok)
                    if held >= HELD:
                        chunk, held = chunk + 1, 0
            if rows:
                yield _batch(list(zip(*rows, strict=True)), [pa.int64(), pa.int64(), pa.binary(), pa.int64()], ["id", "n", "tok", "chunk"])

    few = F.broadcast(few) if few.count() <= BROADCAST_ROWS else few
    found = docs.withColumnRenamed("id", "doc").join(few, "doc").select("id", "s1", "s2", "text")
    found = found.mapInArrow(run, "id bigint, n bigint, tok binary, chunk bigint")
    return found.dropDuplicates(["id"]) if repeated else found


def _postings(sets: DataFrame, percent: int, tokens: int) -> DataFrame:
    """token, id, n, common, pos for each token of a set's prefix (at place pos) that another set has too.

    Tokens are in the order of the number of sets that hold them, then of their hash: the rarest first. Linked sets
    share one of their first spare + 1 tokens. Each chunk sends its tokens with their counts to buckets of tokens, and
    gets back what the counts of all chunks come to. So a token crosses once a chunk, however many sets hold it.
    """
    buckets = max(MIN_BUCKETS, -(-tokens // BUCKET_TOKENS))
    chunks = max(MIN_BUCKETS, -(-2 * tokens // HELD))
    key_of = lambda tok: ((tok >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | tok & np.uint64(0xFFFFFFFF)

    def dealt(batches):
        held, total = defaultdict(list), 0

        def out():
            for chunk, toks in held.items():
                key, n = np.unique(key_of(np.concatenate(toks)), return_counts=True)
                keys, (a, b) = _blobs((key >> np.uint64(32)).astype(np.int64), key.astype(np.uint32), n.astype(np.uint32))
                yield _batch([keys, a, b, [np.int64(chunk).tobytes()] * len(keys)], _BLOB, _BLOB_NAMES)
            held.clear()

        for batch in batches:
            for raw, chunk in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                held[chunk].append(np.frombuffer(raw, np.uint64))
                total += len(raw) // 8
                if total >= HELD:
                    yield from out()
                    total = 0
        yield from out()

    def counted(batches):
        held = defaultdict(lambda: ([], [], []))
        for batch in batches:
            for bucket, *blobs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for x, y in zip(held[bucket], blobs, strict=True):
                    x.append(y)
        for bucket, (a, b, c) in held.items():
            tail, n = np.frombuffer(b"".join(a), np.uint32), np.frombuffer(b"".join(b), np.uint32)
            _, place = np.unique(tail, return_inverse=True)
            n = np.bincount(place, n).astype(np.uint32)[place]
            ends = np.cumsum([len(x) // 4 for x in a]).tolist()
            rows = []
            for start, end, chunk in zip([0, *ends], ends, c, strict=False):
                many = n[start:end] > 1
                if many.any():
                    rows.append((int(np.frombuffer(chunk, np.int64)[0]), tail[start:end][many].tobytes(), n[start:end][many].tobytes(), np.int64(bucket).tobytes()))
            if rows:
                yield _batch(list(zip(*rows, strict=True)), _BLOB, _BLOB_NAMES)

    def packed(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            yield _batch([batch.column(3), batch.column(2).to_pylist(), [i.tobytes() for i in ids], [b""] * len(ids)], _BLOB, _BLOB_NAMES)

    def prefixes(batches):
        own, counts = defaultdict(list), defaultdict(lambda: ([], []))
        for batch in batches:
            for chunk, a, b, c in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if not c:
                    own[chunk].append((int(np.frombuffer(b, np.int64)[0]), a))
                else:
                    counts[chunk][0].append(np.frombuffer(a, np.uint32).astype(np.uint64) | np.frombuffer(c, np.uint64) << np.uint64(32))
                    counts[chunk][1].append(np.frombuffer(b, np.uint32))
        for chunk, sets_ in own.items():
            if chunk not in counts:
                continue
            key, n = (np.concatenate(x) for x in counts.pop(chunk))
            order = np.argsort(key)
            key, n = key[order], n[order]
            out = ([], [], [], [], [])
            for i, raw in sets_:
                tok = np.frombuffer(raw, np.uint64)
                at = np.minimum(np.searchsorted(key, key_of(tok)), len(key) - 1)
                df = np.where(key[at] == key_of(tok), n[at], 1)
                first = np.lexsort((tok, df))[: _spare(len(tok), percent) + 1]
                pos = np.flatnonzero(df[first] > 1)
                first, common = first[pos], int((df > 1).sum())
                for x, y in zip(out, (tok[first], np.full(len(first), i), np.full(len(first), len(tok)), np.full(len(first), common), pos), strict=True):
                    x.append(y)
            tok, *rest = map(np.concatenate, out)
            yield _batch([tok.view(np.int64), *rest], [pa.int64()] * 5, ["token", "id", "n", "common", "pos"])

    counts = sets.mapInArrow(dealt, _BLOB_SCHEMA).repartition(buckets, "bucket").mapInArrow(counted, _BLOB_SCHEMA)
    both = counts.unionByName(sets.mapInArrow(packed, _BLOB_SCHEMA))
    return both.repartition(chunks, "bucket").mapInArrow(prefixes, "token bigint, id bigint, n bigint, common bigint, pos bigint")


def _stars(postings: DataFrame, percent: int) -> DataFrame:
    """lead, id: each set of a block of a token's list with the block's leader, the set with the largest share of common tokens.

    A list is cut into blocks by size, each as wide as linked sets can differ: a set is at home in the block of its own
    size and visits the one below. Where the token is the first that two sets share, what follows its place in a set
    bounds the sizes that the set can be linked with; visitors beyond the reach of all that are at home in a block skip
    it, and so do blocks without two members. Sets of one family meet the same leader in all their lists, and those
    pairs are made once.
    """
    band = F.floor(F.log("n") / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("n")
    entries = postings.select(
        "id",
        "n",
        F.struct((-F.col("common") / F.col("n")).alias("share"), F.col("id")).alias("best"),
        F.expr(f"(n - pos) * {100 + percent} div {percent} - n").alias("reach"),
        "token",
        F.posexplode(F.array(band, band - 1)).alias("visits", "band"),
    ).withColumn("block", F.xxhash64("token", "band"))
    homes = F.when(F.col("visits") == 0, F.col("reach"))
    leads = entries.groupBy("token", "band", "block").agg(F.min("best").alias("best"), F.max(homes).alias("reached"), F.count(F.lit(1)).alias("members"))
    leads = leads.where("members > 1 AND reached IS NOT NULL").select("token", "band", "block", F.col("best.id").alias("lead"), "reached")
    hot = hot_keys(entries.select("block"), "block")
    pairs = salted(entries.select("block", "token", "band", "id", "n", "visits"), hot, "block", F.xxhash64("id")).join(
        replicated(leads, hot, "block"), ["block", "token", "band", "_salt"]
    )
    return pairs.where("id <> lead AND (visits = 0 OR n <= reached)").select("lead", "id").distinct()


def _compared(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """lead, id, n, size (of the lead), inter, linked, lost (bits of the lead's tokens that the set lacks), won (its others)."""
    few = F.broadcast(stars) if stars.count() <= BROADCAST_ROWS else stars
    members = sets.join(few, "id").select("lead", "id", "n", "tok")
    hot = hot_keys(stars.select("lead"), "lead")
    leads = sets.select(F.col("id").alias("lead"), F.col("n").alias("size"), F.col("tok").alias("of"))
    leads = leads.join(stars.select("lead").distinct(), "lead", "left_semi")
    paired = salted(members, hot, "lead", F.xxhash64("id")).join(replicated(leads, hot, "lead"), ["lead", "_salt"])

    def run(batches):
        for batch in batches:
            rows = []
            for lead, i, tok, of in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                x, y = np.frombuffer(tok, np.uint64), np.frombuffer(of, np.uint64)
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                hit = y[place] == x
                lost = np.ones(len(y), bool)
                lost[place[hit]] = False
                inter = int(hit.sum())
                linked = 100 * inter >= percent * (len(x) + len(y) - inter)
                rows.append((lead, i, len(x), len(y), inter, linked, np.packbits(lost).tobytes(), x[~hit].tobytes()))
            if rows:
                yield _batch(list(zip(*rows, strict=True)), [*[pa.int64()] * 5, pa.bool_(), pa.binary(), pa.binary()], ["lead", "id", "n", "size", "inter", "linked", "lost", "won"])

    return paired.select("lead", "id", "tok", "of").mapInArrow(
        run, "lead bigint, id bigint, n bigint, size bigint, inter bigint, linked boolean, lost binary, won binary"
    )


def _rest(compared: DataFrame, percent: int) -> DataFrame:
    """a, b: links among the members of a leader's group that the links to the leader don't already imply.

    The answers follow from those of the leader: |x & y| = size - |lost(x) | lost(y)| + |won(x) & won(y)|. Only pairs with
    an unlinked member count. So blocks of the unlinked members meet blocks of all: a group with few of them crosses a
    few times, whatever its size, and each cell is bounded in rows and bytes. Of the links of a cell a spanning forest
    goes on.
    """
    unlinked = F.when(~F.col("linked"), 1).otherwise(0)
    weight = F.floor(F.col("size") / 8) + 8 * (F.col("n") - F.col("inter")) + 64
    groups = compared.groupBy("lead").agg(F.count(F.lit(1)).alias("m"), F.sum(unlinked).alias("u"), F.max(weight).alias("w"))
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / F.col("w"))))
    groups = groups.where("m > 1 AND u > 0").select("lead", F.ceil(F.col("m") / rows).cast("int").alias("every"), F.ceil(F.col("u") / rows).cast("int").alias("odd"))
    hot = hot_keys(compared.select("lead"), "lead")
    members = salted(compared, hot, "lead", F.xxhash64("id")).join(replicated(groups, hot, "lead"), ["lead", "_salt"])
    block = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    columns = ["id", "n", "size", "linked", "lost", "won"]
    asked = members.where("NOT linked").select("lead", block("odd").alias("i"), numbers("every").alias("j"), F.lit(True).alias("asks"), *columns)
    dealt = members.select("lead", numbers("odd").alias("i"), block("every").alias("j"), F.lit(False).alias("asks"), *columns).unionByName(asked)

    def run(cell):
        asks = np.array(cell.column("asks").to_pylist())
        x, y = cell.filter(pa.array(asks)), cell.filter(pa.array(~asks))
        found: list[tuple[int, int]] = []
        if len(x) and len(y):
            size = x.column("size")[0].as_py()
            ids, n = ([np.array(t.column(c).to_pylist(), np.int64) for t in (x, y)] for c in ("id", "n"))
            lost = [np.frombuffer(b"".join(t.column("lost").to_pylist()), np.uint8).reshape(len(t), -1) for t in (x, y)]
            won = [[np.frombuffer(w, np.uint64) for w in t.column("won").to_pylist()] for t in (x, y)]
            both, gone = np.zeros((len(x), len(y)), np.int64), [np.zeros(len(t), np.int64) for t in (x, y)]
            for at in range(0, lost[0].shape[1], 1024):  # slices of the leader's tokens
                bits = [np.unpackbits(part[:, at : at + 1024], axis=1).astype(np.float32) for part in lost]
                both += (bits[0] @ bits[1].T).astype(np.int64)
                for k in (0, 1):
                    gone[k] += bits[k].sum(1).astype(np.int64)
            both += size - gone[0][:, None] - gone[1][None, :]
            holder, token = np.repeat(np.arange(len(y)), list(map(len, won[1]))), np.concatenate(won[1])
            order = np.argsort(token, kind="stable")
            holder, token = holder[order], token[order]
            for k, w in enumerate(won[0]):
                low, high = np.searchsorted(token, w), np.searchsorted(token, w, side="right")
                hits = [holder[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True) if a < b]
                if hits:
                    both[k] += np.bincount(np.concatenate(hits), minlength=len(y))
            ok = 100 * both >= percent * (n[0][:, None] + n[1][None, :] - both)
            ok &= np.array(y.column("linked").to_pylist())[None, :] | (ids[0][:, None] < ids[1][None, :])  # a pair of unlinked ones once
            parent: dict[int, int] = {}

            def root(v):
                while parent.setdefault(v, v) != v:
                    parent[v] = v = parent[parent[v]]
                return v

            for k, m in zip(*(p.tolist() for p in np.nonzero(ok)), strict=True):
                a, b = int(ids[0][k]), int(ids[1][m])
                if root(a) != root(b):
                    parent[root(a)] = root(b)
                    found.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt.groupBy("lead", "i", "j").applyInArrow(run, "a bigint, b bigint")


def _named(links: DataFrame, few: DataFrame) -> DataFrame:
    """The links of sets as links of the documents that stand for them."""
    for side in ("a", "b"):
        hot = hot_keys(links.select(side), side)
        own = few.select(F.col("id").alias(side), F.col("doc").alias(f"{side}_doc"))
        links = salted(links, hot, side, F.rand(1)).join(replicated(own, hot, side), [side, "_salt"]).drop(side, "_salt").withColumnRenamed(f"{side}_doc", side)
    return links


def jaccard_components(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (the smallest id reachable by links, itself included).

    Words are runs of other bytes than 0x20 and 0x09-0x0D, with A-Z in lower case; a set holds the distinct shingles of
    `width` words, or all words as one where there are fewer. Sets link when 100 * |x & y| >= percent * |x | y|.

    Equal sets are one to begin with. A set that has too few tokens in common with any others is settled at once. The
    others are joined by prefix lists over the rarest tokens, in blocks of like sizes: each set is compared in full with the
    leader of each of its blocks, and what is left within a leader's group follows incrementally from the two sets' differences to the
    leader. Links then go to components. Tokens are 64-bit hashes of whole shingles.

    Null and empty texts, and texts of white space, have n_shingles 0 and are linked with nothing; so are rows with null
    id, whose component_id is null. Repeated rows are one document; where an id stands on rows with different texts, the
    document has the links of all of them, and each row its own n_shingles. Texts of any length are read as a whole.
    Empty input gives no rows; further columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chars = base.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-chars // (10 * BUCKET_TOKENS)))  # words have six bytes or so; two in five go on
    signed, signed_path = stored_at(_signed(base, width, percent, buckets), "signed")
    blobs = lambda kind: signed.where(F.col("kind") == kind).select(*_BLOB_NAMES)
    rows, rows_path = stored_at(signed.where(F.col("kind") == _DOCUMENT).select("id", "n", "s1", "s2"), "rows")
    viable = _viable(blobs(_TOKENS), blobs(_COUNTS), buckets)
    filled = rows.where("id IS NOT NULL AND n > 0")
    reps = filled.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"))
    again, again_path = stored_at(filled.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("id"), "again")
    repeated = not again.isEmpty()  # then sets have numbers of their own, else the id of the document that stands for them
    number = F.monotonically_increasing_id() if repeated else F.col("rep")
    few, few_path = stored_at(reps.join(viable, "s1", "left_semi").select(number.alias("id"), F.col("rep").alias("doc"), "s1", "s2", "n"), "viable")
    dropped(spark, signed_path)
    tokens = few.agg(F.sum("n")).first()[0] or 0
    sets, sets_path = stored_at(_sets(base, few.drop("n"), width, repeated), "sets")
    postings, postings_path = stored_at(_postings(sets, percent, tokens), "postings")
    stars, stars_path = stored_at(_stars(postings, percent), "stars")
    dropped(spark, postings_path)
    compared, compared_path = stored_at(_compared(stars, sets, percent), "compared")
    links = compared.where("linked").select(F.col("lead").alias("a"), F.col("id").alias("b")).unionByName(_rest(compared, percent))
    if repeated:
        own = filled.join(again, "id", "left_semi").join(reps, ["s1", "s2", "n"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
        links = _named(links, few).unionByName(own)
    found = components(links)
    dropped(spark, again_path, few_path, sets_path, stars_path, compared_path)
    named = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "s1", "s2", "n", F.coalesce("component", "rep").alias("component_id")
    )
    hot = hot_keys(rows.select("s1"), "s1")
    joined = salted(rows, hot, "s1", F.xxhash64("id")).join(replicated(named, hot, "s1"), ["s1", "s2", "n", "_salt"], "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))).alias("component_id"),
    )


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(list_transform(s, lambda x: hash(x))) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.c = l.a
)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets LEFT JOIN (SELECT doc_id, min(c) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""
