"""Toxicity scores (operator 2).

A word is the bag of its character n-grams (with word ends) plus the word
itself, each hashed to a row of one embedding matrix. A window of ``WINDOW``
words is the average of its words' bags; a linear softmax on that average gives
the window's log-odds. Embeddings and softmax are trained jointly in numpy.
Misspelt or unseen words share n-gram rows with the words they resemble.

A label speaks of a whole document, of which a few words may be toxic, so the
document's log-odds are the softmax-weighted average of those of its windows:
close to the plain average while the model knows nothing, close to the worst
window once it does. The same pooling scores a document, over its whole text.

Training reads a bounded sample of labelled rows: at most ``ROWS`` rows, half
of either class as far as there are that many, in the order of a hash of the
id, and at most ``CHARS`` characters of them together. A label tells less about a
word the longer its text is: texts of over ``SHORT`` characters come after all
others, the shortest first, and only as far as a class has fewer than ``LEAST`` rows
without them; a class of long texts alone is learned like any other. Chosen texts
are read whole as long as they fit; beyond that the longest are thinned, down to one
common length, to stretches of ``STRETCH`` words at equal distances over the whole
text. The trained model is ``BUCKETS`` numbers once the
softmax is folded into the embeddings.

Defined results: a null or empty text has the score of an empty window; a
repeated row is scored as often as it occurs; a null ``doc_id`` is never held
out and never learned from; a document with several labels counts as toxic if
one of them says so; labels that are neither 0 nor 1 are ignored; without both
classes to learn from every score is 0.0. Only the text is an input of a score.
"""

from __future__ import annotations

import string
import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, materialized, table

ROWS = 2400
CHARS = 16_000_000
SHORT = 20_000
LEAST = 200
STRETCH = 16
BUCKETS = 1 << 18
DIM = 8
GRAMS = (3, 4, 5, 6)
WINDOW = 2
SHARP = 2.0
EPOCHS = 20
RATES = (3.0, 0.1, 0.1)
DECAY = 0.01
#: Words of the vocabulary whose bags are summed at once.
CHUNK = 8192
THRESHOLD = 0.7
#: Words whose value a worker remembers at once.
REMEMBERED = 400_000
#: Texts whose unseen words are looked up at once.
TEXTS = 64
_EDGE = string.punctuation + "«»„“”‘’…¿¡–—"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def bags_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of words, and the place in ``words`` each belongs to: the
    hashes of a word's n-grams and of the word itself, all words at once."""
    cores = [w.strip(_EDGE) or w for w in words]
    codes = np.frombuffer("".join([f"<{c}>" for c in cores]).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = codes.astype(np.uint64)
    lengths = np.fromiter(map(len, cores), np.int64, len(cores)) + 2
    owner = np.repeat(np.arange(len(cores), dtype=np.int32), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # signs to the word's end
    whole = [zlib.crc32(c.encode("utf-8", "surrogatepass")) for c in cores]
    rows, owners = [_spread(np.array(whole, np.uint64))], [np.arange(len(cores), dtype=np.int32)]
    h = codes
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * _STEP + codes[n - 1 :]
        if n in GRAMS:
            inside = left[: len(h)] >= n
            rows.append(_spread(h[inside] + np.uint64(n)))
            owners.append(owner[: len(h)][inside])
    return np.concatenate(rows), np.concatenate(owners)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _STEP
    return ((h >> np.uint64(24)) % np.uint64(BUCKETS)).astype(np.int32)


def _sum_by(index: np.ndarray, values: np.ndarray, size: int, rows=slice(None)) -> np.ndarray:
    """Sums of ``values[rows]`` by ``index``, a column at a time."""
    out = np.empty((size, values.shape[1]), np.float32)
    for k in range(values.shape[1]):
        out[:, k] = np.bincount(index, values[rows, k], size)
    return out


def _softmax_within(z: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(z, first)
    e = np.exp(z - top[doc])
    return e / np.add.reduceat(e, first)[doc]


@dataclass
class Model:
    """Per embedding row its share of the log-odds, and the intercept."""

    value: np.ndarray | None = None
    intercept: float = 0.0
    _seen: dict = field(default_factory=dict, repr=False, compare=False)

    def _learn(self, words: list[str]) -> None:
        """Remember the values of words not met yet."""
        for at in range(0, len(words), CHUNK):
            some = words[at : at + CHUNK]
            rows, owner = bags_of(some)
            n = np.bincount(owner, minlength=len(some))
            self._seen.update(zip(some, (np.bincount(owner, self.value[rows], len(some)) / n).tolist()))

    def scores(self, texts) -> list[float]:
        """Scores of many texts, some texts' unseen words at a time."""
        out: list[float] = []
        for at in range(0, len(texts), TEXTS):
            split = [words_of(t) for t in texts[at : at + TEXTS]]
            if self.value is not None:
                new = set().union(*split).difference(self._seen)
                if len(self._seen) + len(new) > REMEMBERED:
                    self._seen.clear()
                    new = set().union(*split)
                self._learn(list(new))
            out += [self._score(words) for words in split]
        return out

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]

    def _score(self, words: list[str]) -> float:
        if self.value is None:
            return 0.0
        if not words:
            z = np.array([self.intercept])
        else:
            v = np.fromiter(map(self._seen.__getitem__, words), np.float64, len(words))
            at = np.arange(0, len(v), WINDOW)
            z = np.add.reduceat(v, at) / np.diff(np.append(at, len(v))) + self.intercept
        e = np.exp(SHARP * (z - z.max()))
        pooled = float((e * z).sum() / e.sum())
        return 1.0 / (1.0 + float(np.exp(-np.clip(pooled, -60, 60))))


def train(texts: list[str], toxic: list[int], *, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Fit embeddings and softmax together, by full-batch steps with momentum along
    gradients that are scaled per embedding row and to a largest entry of one."""
    y = np.asarray(toxic, np.float64)
    if not len(y) or y.min() == y.max():
        return Model()
    vocabulary: dict[str, int] = {}
    word, window, doc = array("i"), array("i"), array("i")
    n_windows = 0
    for d, text in enumerate(texts):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)] or [
            vocabulary.setdefault("", len(vocabulary))
        ]
        word.extend(ids)
        window.extend(n_windows + i // WINDOW for i in range(len(ids)))
        count = -(-len(ids) // WINDOW)
        doc.extend(d for _ in range(count))
        n_windows += count
    word, window, doc = (np.frombuffer(a, np.int32) for a in (word, window, doc))
    first = np.concatenate(([0], 1 + np.nonzero(np.diff(doc))[0]))
    per_window = np.bincount(window, minlength=n_windows).astype(np.float32)[:, None]
    n_words = len(vocabulary)
    count = np.bincount(word, minlength=n_words)
    known = list(vocabulary)
    parts = []
    for at in range(0, len(known), CHUNK):
        got, owner = bags_of(known[at : at + CHUNK])
        order = np.argsort(owner, kind="stable")
        parts.append((got[order], np.bincount(owner)))
    rows = np.concatenate([p[0] for p in parts])
    lengths = np.concatenate([p[1] for p in parts])
    ends = np.cumsum(lengths)
    del parts, known, vocabulary
    # the embedding rows that occur, and their places among these; without a sort,
    # whose copies would be the largest arrays of all
    occurs = np.zeros(BUCKETS, bool)
    occurs[rows] = True
    used = np.flatnonzero(occurs)
    rows = (np.cumsum(occurs, dtype=np.int32) - 1)[rows]
    # the bags, some words at a time, so that memory does not follow the sample
    part_of = [
        (slice(a, b), slice(ends[a] - lengths[a], ends[b - 1]), ends[a:b] - lengths[a:b] - (ends[a] - lengths[a]))
        for a, b in ((a, min(a + CHUNK, len(ends))) for a in range(0, len(ends), CHUNK))
    ]

    def bags(e: np.ndarray) -> np.ndarray:
        return np.concatenate([np.add.reduceat(e[rows[r]], s) / lengths[ws, None] for ws, r, s in part_of])

    def bags_back(d: np.ndarray) -> np.ndarray:
        out = np.zeros((len(used), d.shape[1]), np.float32)
        for ws, r, _ in part_of:
            out += _sum_by(rows[r], np.repeat(d[ws] / lengths[ws, None], lengths[ws], axis=0), len(used))
        return out

    rng = np.random.default_rng(seed)
    parameters = [
        (rng.uniform(-1, 1, (len(used), DIM)) / DIM).astype(np.float32),
        rng.uniform(-1, 1, (DIM, 2)) / DIM,
        np.zeros(2),
    ]
    seen = sum(np.bincount(rows[r], np.repeat(count[ws], lengths[ws]), len(used)) for ws, r, _ in part_of)
    scale = [1 / np.sqrt(seen)[:, None], 1.0, 1.0]
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    velocity = [np.zeros_like(p) for p in parameters]
    for _ in range(epochs):
        e, w, b = parameters
        hidden = _sum_by(window, bags(e), n_windows, word) / per_window
        logits = hidden @ w + b
        z = logits[:, 1] - logits[:, 0]
        share = _softmax_within(SHARP * z, doc, first)
        pooled = np.add.reduceat(share * z, first)
        p = 1 / (1 + np.exp(-np.clip(pooled, -60, 60)))
        dz = share * ((p - y) * weight)[doc]
        dlogits = np.stack([-dz, dz], axis=1)
        dwords = _sum_by(word, (dlogits @ w.T) / per_window, n_words, window)
        gradients = [bags_back(dwords), hidden.T @ dlogits, dlogits.sum(0)]
        # One step length for all rows, each against the noise that its number of
        # occurrences leads one to expect: rows that many toxic documents agree
        # on move far; a single document's rows hardly, so none is learned by heart.
        for k, g in enumerate(gradients):
            g = g * scale[k]
            velocity[k] = 0.8 * velocity[k] + g / (np.abs(g).max() + 1e-12)
            parameters[k] = ((1 - DECAY) * parameters[k] - RATES[k] * velocity[k]).astype(parameters[k].dtype)
    e, w, b = parameters
    value = np.zeros(BUCKETS, np.float32)
    value[used] = e @ (w[:, 1] - w[:, 0])
    return Model(value, float(b[1] - b[0]))


def held_out(doc_id: str = "doc_id"):
    """Whether a row's label may not be learned (crc32 of the id mod 3 is 1)."""
    return F.coalesce(F.crc32(col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def common_length(lengths: list[int], chars: int) -> int:
    """The largest length that texts may keep so that all keep ``chars`` at most."""
    left, kept = chars, sorted(lengths)
    for i, n in enumerate(kept):
        if n * (len(kept) - i) > left:
            return left // (len(kept) - i)
        left -= n
    return max(kept, default=0)


def spread_out(text, chars: int):
    """``text`` if it has at most ``chars`` characters, else stretches of words at
    equal distances over the whole text, about ``chars`` characters together."""
    words = F.filter(F.split(text, r"\s+", -1), lambda w: w != "")

    def picked(w):
        n = F.size(w)
        share = F.lit(float(chars)) / F.length(text)
        count = F.greatest(F.floor(n * share / STRETCH), F.lit(1)).cast("int")
        # the first stretch begins the text, the last one ends it
        apart = F.greatest(n - STRETCH, F.lit(0)) / F.greatest(count - 1, F.lit(1))
        starts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.floor(i * apart).cast("int"))
        parts = F.transform(starts, lambda at: F.array_join(F.slice(w, at + 1, F.lit(STRETCH)), " "))
        return F.substring(F.array_join(parts, " "), 1, chars)  # words may be of any length

    some = F.element_at(F.transform(F.filter(F.array(words), lambda w: F.size(w) > 0), picked), 1)
    return F.when(F.length(text) <= chars, text).otherwise(F.coalesce(some, F.lit("")))


def _each(found: DataFrame, *order, most: dict[int, int]) -> DataFrame:
    """The first rows of each class in an order, ``most`` of them."""
    parts = [found.where(F.col("toxic") == k).orderBy(*order).limit(max(n, 0)) for k, n in most.items()]
    return parts[0].union(parts[1])


def training_rows(
    docs: DataFrame, labels: DataFrame, *, doc_id="doc_id", text="text", label="toxic", rows=ROWS, chars=CHARS
) -> DataFrame:
    """``text, toxic`` of the bounded sample (see the module's notes)."""
    told = (
        labels.select(col(doc_id).alias("doc_id"), col(label).alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).where(F.col("text").isNotNull())
    # by id first, so that only the chosen rows' texts move
    found = known.select("doc_id", F.length("text").alias("length")).join(told, "doc_id")
    found = found.groupBy("doc_id", "toxic").agg(F.min("length").alias("length"))
    order = F.xxhash64("doc_id")
    chosen = materialized(_each(found.where(F.col("length") <= SHORT), order, "doc_id", most={0: rows // 2, 1: rows // 2}), "toxicity-ids")
    short = dict.fromkeys((0, 1), 0) | {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    more = {k: min(LEAST, rows // 2) - n for k, n in short.items()}
    if max(more.values()) > 0:
        chosen = chosen.union(_each(found.where(F.col("length") > SHORT), "length", order, "doc_id", most=more))
    chosen = F.broadcast(chosen.select("doc_id", "toxic"))  # at most ``rows`` ids
    read = materialized(
        known.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")),
        "toxicity-sample",
    )
    longest = common_length([r[0] for r in read.select(F.length("text")).collect()], chars)  # at most ``rows`` numbers
    return read.withColumn("text", spread_out(F.col("text"), longest))


def fit(docs: DataFrame, labels: DataFrame, **how) -> Model:
    sample = sorted(training_rows(docs, labels, **how).collect())
    return train([r["text"] for r in sample], [r["toxic"] for r in sample])


def score(docs: DataFrame, model: Model, *, text: str = "text"):
    """A column expression: the toxicity score of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.tolist()), dtype="float64")

    return of(col(text))


def toxicity(docs: DataFrame, labels: DataFrame, *, doc_id="doc_id", text="text", threshold=THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    model = fit(docs, labels, doc_id=doc_id, text=text)
    return docs.select(
        col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), score(docs, model, text=text).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, doc_id="doc_id", text="text", threshold=THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    model = fit(docs, labels, doc_id=doc_id, text=text)
    return docs.where(score(docs, model, text=text) < threshold)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Query: toxicity of every document, learned from ``labels``."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
