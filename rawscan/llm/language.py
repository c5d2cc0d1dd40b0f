"""Language identification: averaged hashed subword embeddings with a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rawscan.llm.common import settle, small_batches, unused
from rawscan.shipping import ship

UND = "und"
#: Up to so many languages (a name and a number each) are broadcast while rows are chosen.
BROADCAST_LANGUAGES = 100_000
#: Every byte but ASCII letters and those above them separates words.
_WORD_BYTES = bytes(b if chr(b).islower() or b >= 0x80 else 0x20 for b in range(256))
_ZERO = bytes(4)


@dataclass(frozen=True)
class Settings:
    """What is learned from what. sample_rows bounds the labelled rows that a model is fitted on: as many of each language,
    one at least. Their whole texts are read; window_bytes are the lengths of a part of each that is learned from too, so
    that short texts are known as well. noise_rejections and clean_rejections are the shares of texts in no language that
    should be, and of right answers that may be rejected."""

    sample_rows: int = 1200
    window_bytes: tuple[int, ...] = (24, 60, 150, 400)
    buckets_log2: int = 16
    dim: int = 16
    sizes: tuple[int, ...] = (2, 3, 4)
    epochs: int = 8
    batch: int = 64
    rate: float = 4.0
    calibration_share: float = 0.2
    noise_rejections: float = 0.95
    clean_rejections: float = 0.001
    seed: int = 17


@dataclass
class Model:
    """languages, the vector of each bucket, what its components add to the languages' logits, their bias, the
    temperature and the rejection threshold. Its size grows with the languages by dim numbers each."""

    languages: list[str]
    table: np.ndarray
    linear: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    settings: Settings = field(default_factory=Settings)

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return self._softmax(_means(self.table, texts, self.settings))

    def _softmax(self, means: np.ndarray) -> np.ndarray:
        logits = (means @ self.linear + self.bias) / self.temperature
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def _plain(text: str) -> bytes:
    """Lower-case words with a space on either side."""
    words = text.lower().encode("utf-8", "replace").translate(_WORD_BYTES).split()
    return b" " + b" ".join(words) + b" " if words else b""


def _buckets(raw: np.ndarray, size: int, log2: int) -> np.ndarray:
    """The bucket of the subword of `size` bytes that begins at each place."""
    n = len(raw) - size + 1
    h = np.full(n, 0x9E3779B1 * size & 0xFFFFFFFF, np.uint32)
    for i in range(size):
        h ^= raw[i : i + n]
        h *= np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - log2)


def _means(table: np.ndarray, texts: list[str], settings: Settings) -> np.ndarray:
    """For each text the mean of the table's rows over all its subwords; whole texts, in pieces of bounded size, which
    overlap by what the longest subword needs, so that each subword counts once wherever the text is cut."""
    width, most, more = table.shape[1], 250_000, max(settings.sizes) - 1
    padded = np.vstack([table, np.zeros((1, width), table.dtype)])
    sums, counts = np.zeros((len(texts), width)), np.zeros(len(texts))
    pieces, total = [], 0

    def flush():
        nonlocal pieces, total
        if not pieces:
            return
        raw = np.frombuffer(_ZERO.join(p for _, p in pieces) + _ZERO, np.uint8)
        lengths = np.array([len(p) for _, p in pieces])
        starts = np.concatenate(([0], np.cumsum(lengths + len(_ZERO))[:-1]))
        docs = np.array([d for d, _ in pieces])
        for size in settings.sizes:
            own = np.clip(lengths - size + 1, 0, most)  # subwords that begin in the piece and not in the next one
            at = _buckets(raw, size, settings.buckets_log2).astype(np.int64)
            for start, n, end in zip(starts.tolist(), own.tolist(), (starts + lengths).tolist(), strict=True):
                at[start + n : end + len(_ZERO)] = len(table)
            np.add.at(sums, docs, np.add.reduceat(padded[at], starts, axis=0))
            np.add.at(counts, docs, own)
        pieces, total = [], 0

    for i, text in enumerate(texts):
        raw = _plain(text)
        for j in range(0, len(raw), most):
            pieces.append((i, raw[j : j + most + more]))
            total += len(pieces[-1][1])
            if total >= most:
                flush()
    flush()
    return sums / np.maximum(counts, 1)[:, None]


Bag = tuple[np.ndarray, np.ndarray]


def _bag(raw: bytes, settings: Settings) -> Bag:
    """The distinct buckets of a text's subwords, and how often each occurs."""
    found = np.frombuffer(raw, np.uint8)
    parts = [_buckets(found, s, settings.buckets_log2) for s in settings.sizes if len(found) >= s]
    ids, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0), np.zeros(0))
    return ids.astype(np.uint32), n.astype(np.uint32)


def _mean_of(table: np.ndarray, bags: list[Bag]) -> np.ndarray:
    return np.stack([(table[ids] * n[:, None]).sum(0) / max(1, int(n.sum())) for ids, n in bags])


def train(rows: list[tuple[Bag, str]], held: list[tuple[Bag, str]], windows: list[tuple[Bag, str]], noise: list[Bag], settings: Settings) -> Model:
    """Fits a model to (bag, language) rows by stochastic gradient descent, then temperature and threshold to texts held
    back, windows of theirs, and noise."""
    rows = [r for r in rows if len(r[0][0])]
    languages = sorted({lang for _, lang in [*rows, *held]})
    place = {lang: k for k, lang in enumerate(languages)}
    rng = np.random.default_rng(settings.seed)
    y = np.array([place[lang] for _, lang in rows], dtype=np.int64)
    share = [(n / n.sum()).astype(np.float32) for (_, n), _ in rows]
    weight = (len(rows) / np.maximum(1, np.bincount(y, minlength=len(languages))) / len(languages)).astype(np.float32)
    emb = np.zeros((1 << settings.buckets_log2, settings.dim), np.float32)  # what is never learned speaks for no language
    lin, bias = rng.normal(0, 0.3, (settings.dim, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
    steps, step = max(1, settings.epochs * -(-len(rows) // settings.batch)), 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), settings.batch):
            part = order[i : i + settings.batch]
            rate = settings.rate * (1 - step / steps)
            step += 1
            sizes = [len(share[j]) for j in part]
            ids, parts = np.concatenate([rows[j][0][0] for j in part]).astype(np.int64), np.concatenate([share[j] for j in part])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            hidden = np.add.reduceat(emb[ids] * parts[:, None], starts, axis=0)
            logits = hidden @ lin + bias
            e = np.exp(logits - logits.max(1, keepdims=True))
            grad = e / e.sum(1, keepdims=True)
            grad[np.arange(len(part)), y[part]] -= 1
            grad *= weight[y[part]][:, None] / len(part)
            back = grad @ lin.T
            lin -= rate * (hidden.T @ grad)
            bias -= rate * grad.sum(0)
            np.subtract.at(emb, ids, (rate * len(part)) * parts[:, None] * np.repeat(back, sizes, axis=0))
    narrow = len(languages) <= settings.dim
    model = Model(languages, emb @ lin if narrow else emb, np.eye(len(languages)) if narrow else lin.astype(float), bias.astype(float), 1.0, 0.0, settings)
    held, windows = ([r for r in x if len(r[0][0])] for x in (held, windows))
    if held:
        bags = [b for b, _ in [*held, *windows]]
        _calibrate(model, bags, np.array([place[lang] for _, lang in [*held, *windows]]), len(held), [b for b in noise if len(b[0])])
    return model


def _calibrate(model: Model, bags: list[Bag], y: np.ndarray, whole: int, noise: list[Bag]) -> None:
    """The temperature of least log loss. For the first `whole` bags, which are whole texts, the threshold below which noise_rejections of the noise lie, or, where that would
    take more right answers than clean_rejections, the one that takes just these."""
    means = _mean_of(model.table, bags)
    logits = means @ model.linear + model.bias
    best = np.inf
    for t in np.geomspace(0.05, 20, 60):
        z = logits / t
        z -= z.max(1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]))
        if loss < best - 1e-9:
            best, model.temperature = loss, float(t)
    p, y = model._softmax(means[:whole]), y[:whole]
    right = np.sort(p.max(1)[p.argmax(1) == y])
    bounds = [right[int(len(right) * model.settings.clean_rejections)]] if len(right) else []
    if noise:
        bounds.append(np.quantile(model._softmax(_mean_of(model.table, noise)).max(1), model.settings.noise_rejections))
    model.threshold = float(min(bounds)) if bounds else 0.0


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text modulo 3; fold 1 is never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def _examples(settings: Settings):
    """Turns rows (text, lang, lot, number in the language) into rows of kind, lang and a bag: whole texts and windows to learn from, and whole
    texts and windows held back, with noise of their shape: the same words with each letter drawn at random."""

    def run(batches):
        for batch in batches:
            out = []
            for text, lang, lot, k in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                raw, rng = _plain(text), np.random.default_rng(lot % (1 << 63))
                size = int(rng.choice(settings.window_bytes))
                start = int(rng.integers(0, max(1, len(raw) - size + 1)))
                window = raw[start : start + size]
                if k > 1 and rng.random() < settings.calibration_share:
                    drawn = np.frombuffer(raw, np.uint8).copy()
                    letters = drawn != 0x20
                    drawn[letters] = rng.integers(0x61, 0x7B, int(letters.sum()))
                    found = [("held", raw), ("window", window), ("noise", drawn.tobytes())]
                else:
                    found = [("learned", raw), ("learned", window)]
                out += [(kind, lang, *(x.tobytes() for x in _bag(part, settings))) for kind, part in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["kind", "lang", "ids", "n"])

    return run


def fit(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of all values of lang, from a bounded sample of the labelled rows outside fold 1; None where there are none.

    Each language gives as many rows, chosen by a hash of id and text: sample_rows together, or one a language where
    there are more languages. Their whole texts are read where they lie; what reaches the driver is a bag of subwords of
    bounded size for each.
    """
    ship(docs.sparkSession)
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col) != 1))
    usable = usable.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"), F.xxhash64(F.lit(settings.seed), id_col, text_col).alias("lot"))
    counts = usable.groupBy("l").agg(F.count(F.lit(1)).alias("of"))
    languages = counts.count()
    if not languages:
        return None
    each, scale = max(1, settings.sample_rows // languages), 1 << 30
    most = F.least(F.lit(1.0), (4 * each + 20) / F.col("of"))  # nearly sure to hold enough, and never many more
    counts = F.broadcast(counts) if languages <= BROADCAST_LANGUAGES else counts
    some = usable.join(counts, "l").where(F.pmod(F.xxhash64("lot"), F.lit(scale)) < most * scale).select("t", "l", "lot")
    order = Window.partitionBy("l").orderBy("lot", "t")
    chosen = some.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each).select("t", "l", "lot", "k")
    with small_batches(docs.sparkSession):
        found = chosen.mapInArrow(_examples(settings), "kind string, lang string, ids binary, n binary").toArrow()
    bags = sorted(zip(*[c.to_pylist() for c in found.columns], strict=True))
    del found
    settle(docs.sparkSession)
    of = lambda kind: [((np.frombuffer(i, np.uint32), np.frombuffer(n, np.uint32)), lang) for k, lang, i, n in bags if k == kind]
    return train(of("learned"), of("held"), of("window"), [bag for bag, _ in of("noise")], settings)


def predict(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    names: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
) -> DataFrame:
    """One row per row of docs: id, the columns of keep, and lang_pred, score and rejected under the given names.

    lang_pred is a learned language, or `und` (score 0, rejected) where the text is null or has no letter, or where
    nothing could be learned. score is the calibrated probability of lang_pred; rejected tells that it lies below the
    model's threshold. Whole texts of any length are read, in pieces of bounded size. Repeated rows give repeated
    results, empty input none; other columns than those of keep are ignored. The model is broadcast; its size depends
    on the settings and the number of languages.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passed = [id_col, *keep]
    taken = docs.select(F.col(text_col).alias(unused(docs, "_text")[0]), *passed)
    kinds = T.StructType([docs.schema[c] for c in passed]).add(names[0], T.StringType()).add(names[1], T.DoubleType()).add(names[2], T.BooleanType())

    def run(batches):
        own = shared.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            lettered = [i for i, t in enumerate(texts) if t and own is not None and any(map(str.isalpha, t))]
            langs, scores, rejected = [UND] * len(texts), [0.0] * len(texts), [True] * len(texts)
            if lettered:
                p = own.probabilities([texts[i] for i in lettered])
                for i, k, s in zip(lettered, p.argmax(1).tolist(), p.max(1).tolist(), strict=True):
                    langs[i], scores[i], rejected[i] = own.languages[k], min(1.0, s), s < own.threshold
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*passed, *names],
            )

    return taken.mapInArrow(run, kinds)
