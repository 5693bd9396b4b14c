"""Language identification by sparse multinomial logistic regression (operator 13).

1. Features: a text is lower-cased, everything but letters and marks becomes one separator, and its character n-grams
   of the orders `ORDERS` (a separator only at either end) are hashed into `BUCKETS`. A feature's value is its share of
   the text's n-grams, in percent, times its inverse document frequency. Nothing else of a row is looked at.
2. Statistics: document frequencies, and the number of texts per language, are counted over all training rows, in
   tasks that each emit at most `BUCKETS` sums.
3. Fit: a bounded sample of training rows, at most `PER_LANG` of a language and `SAMPLE` in all, chosen and ordered by
   hash, so it does not depend on the file layout. One task runs follow-the-regularised-leader steps with elastic-net
   penalties (`L1` makes the weights sparse, `L2` keeps them small) over `EPOCHS` passes; every `CALIBRATE`-th sampled
   row is kept out of the steps. Those rows, weighted to the languages' shares of all training rows, fit the
   temperature that the logits are divided by.
4. Prediction: whole texts, in chunks of `CHUNK` characters of whole documents; the weights, at most BUCKETS rows of
   one number per learned language, are broadcast.

Training rows have a doc_id whose crc32 (as text) mod 4 is not 2, a lang and a text with a letter; the remainder 2 is
held out. doc_id decides only on which side a row is (and its order in the sample).

Edge cases: null texts and texts without a letter are `und` with score 0; so is everything if no training row exists;
one learned language scores 1; a null doc_id is neither held out nor learned from; repeated rows are predicted one by
one; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import release, ship, stage, uniform

ORDERS = (1, 2, 3)
BITS = 17
BUCKETS = 1 << BITS
PER_LANG, SAMPLE, CALIBRATE = 600, 6000, 4
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.3, 1.0, 0.5, 0.01
CHUNK = 1 << 19
UNKNOWN = "und"
SEED = 13


# ---- features ------------------------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def _codes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower-case code if it belongs to a word, else 0; and whether it is a letter."""
    code, letter = np.zeros(0x110000, dtype=np.uint64), np.zeros(0x110000, dtype=bool)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            low = chr(c).lower()
            code[c] = ord(low) if len(low) == 1 else c
            letter[c] = kind == "L"
    return code, letter


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For all n-grams of the texts, text by text: the text's number and the bucket. Texts without a letter have none."""
    code, letter = _codes()
    raw = [np.frombuffer(t.encode("utf-32-le", "replace"), dtype=np.uint32) for t in texts]
    sound = np.array([bool(letter[r].any()) for r in raw], dtype=bool)
    parts, owners = [np.zeros(1, dtype=np.uint64)], [np.zeros(1, dtype=np.int64)]
    for i, r in enumerate(raw):
        if sound[i]:
            parts += [code[r], np.zeros(1, dtype=np.uint64)]
            owners.append(np.full(len(r) + 1, i, dtype=np.int64))
    c, owner = np.concatenate(parts), np.concatenate(owners)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)                   # one separator between words
    c, owner = c[keep], owner[keep]
    n = len(c)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner = np.where(c == 0, np.append(owner[1:], owner[-1]), owner)     # a separator belongs to the word after it
    hashed = np.zeros((n, len(ORDERS)), dtype=np.int64)
    valid = np.zeros((n, len(ORDERS)), dtype=bool)
    for j, order in enumerate(ORDERS):
        m = n - order + 1
        if m <= 0:
            continue
        key = np.full(m, order, dtype=np.uint64)
        inner = np.ones(m, dtype=bool)
        for k in range(order):
            at = c[k:k + m]
            key = (key ^ at) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            if order == 1 or 0 < k < order - 1:               # a separator only at either end
                inner &= at != 0
        hashed[:m, j] = (key * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)
        valid[:m, j] = inner
    flat = valid.ravel()
    return np.repeat(owner, len(ORDERS))[flat], hashed.ravel()[flat]


def _chunks(texts: list[str | None], most: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about `most` characters, with the number of their first."""
    at, size, run = 0, 0, []
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= most:
            yield at, run
            at, size, run = i + 1, 0, []
    if run:
        yield at, run


def _by_text(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Number and buckets of every text with a letter."""
    for at, run in _chunks(texts, CHUNK):
        owner, bucket = grams(run)
        found, starts = np.unique(owner, return_index=True)
        for i, part in zip(found, np.split(bucket, starts[1:])):
            yield at + int(i), part


# ---- statistics ----------------------------------------------------------------------------------------------

def _training(docs: DataFrame) -> DataFrame:
    side = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return docs.where((side != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")


def statistics(spark: SparkSession, training: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Texts with a letter per language, and per bucket, of all training rows."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts: dict[str, int] = {}
        held = np.zeros(BUCKETS, dtype=np.int64)
        mark = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            langs = batch["lang"].tolist()
            for i, bucket in _by_text(batch["text"].tolist()):
                texts[langs[i]] = texts.get(langs[i], 0) + 1
                places = np.arange(len(bucket))
                mark[bucket] = places
                held[bucket[mark[bucket] == places]] += 1            # each bucket once per text
        some = np.flatnonzero(held)
        yield pd.DataFrame({"lang": pd.Series([*texts, *[None] * len(some)], dtype=object), "bucket": [-1] * len(texts) + some.tolist(),
                            "n": list(texts.values()) + held[some].tolist()})

    parts = training.select("lang", "text").mapInPandas(count, "lang string, bucket int, n long")
    sums = stage(spark, parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "langid-counts")
    texts = {r["lang"]: r["n"] for r in sums.where("bucket < 0").orderBy(F.col("n").desc(), "lang").limit(SAMPLE).collect()}
    held = np.zeros(BUCKETS, dtype=np.int64)
    for r in sums.where("bucket >= 0").select("bucket", "n").toLocalIterator():
        held[r["bucket"]] = r["n"]
    release(spark, sums)
    return texts, held


def sample(spark: SparkSession, training: DataFrame, texts: dict[str, int]) -> DataFrame:
    """At most PER_LANG rows of a language and SAMPLE in all, in a fixed order: lang, text, rank, chance."""
    chance = uniform(F.lit(SEED), F.col("doc_id"), F.col("text"))
    sizes = spark.createDataFrame(list(texts.items()), "lang string, n_lang long")
    rows = training.join(F.broadcast(sizes), "lang").withColumn("chance", chance)
    rows = rows.where(F.col("chance") * F.col("n_lang") < 2 * PER_LANG)          # about twice as many as needed, by hash
    by_hash = Window.partitionBy("lang").orderBy("chance", F.xxhash64("text"))
    ranked = rows.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= PER_LANG)
    return ranked.orderBy("rank", "chance", "lang").limit(SAMPLE).select("lang", "text", "rank", "chance")


# ---- model ---------------------------------------------------------------------------------------------------

def idf(held: np.ndarray, n: int) -> np.ndarray:
    return np.log((1 + n) / (1 + np.minimum(held, n))) + 1


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (BUCKETS + 1 rows, the last one the unpenalised intercept) of rows (class, buckets, values)."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs, free = z[at], np.zeros(len(z[at]))
        last = np.arange(BUCKETS + 1)[at] == BUCKETS
        l1, l2 = np.where(last, 0.0, L1)[:, None], np.where(last, 0.0, L2)[:, None]
        w = -(zs - np.sign(zs) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + l2)
        return np.where(np.abs(zs) > l1, w, free[:, None])

    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            label, bucket, value = rows[i]
            at, x = np.append(bucket, BUCKETS), np.append(value, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p[None]
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    return weights(slice(None))


def temperature(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of the logits that minimises the weighted log loss (golden section over its logarithm)."""
    if not len(labels) or logits.shape[1] < 2:
        return 1.0

    def loss(u: float) -> float:
        s = logits / np.exp(u)
        s = s - s.max(axis=1, keepdims=True)
        return float((weight * (np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels])).sum())

    low, high, step = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    while high - low > 1e-4:
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _values(bucket: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some, count = np.unique(bucket, return_counts=True)
    return some, 100.0 * count / len(bucket) * weight[some]


def fit(spark: SparkSession, docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Learned languages in order, and for every bucket and language what one n-gram there adds to the logits of a
    text (per percent of its n-grams); the last row is the intercept. All divided by the temperature."""
    ship(spark)
    training = _training(docs)
    texts, held = statistics(spark, training)
    langs = sorted(texts)
    if not langs:
        return [], np.zeros((BUCKETS + 1, 0))
    weight = idf(held, sum(texts.values()))
    shared = spark.sparkContext.broadcast((langs, texts, weight))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, texts, weight = shared.value
        number = {lang: i for i, lang in enumerate(langs)}
        rows = []
        for batch in batches:
            labels = batch["lang"].tolist()
            ranks, chances = batch["rank"].tolist(), batch["chance"].tolist()
            for i, bucket in _by_text(batch["text"].tolist()):
                rows.append(((ranks[i], chances[i], labels[i]), number[labels[i]], *_values(bucket, weight)))
        rows.sort(key=lambda r: r[0])
        aside = [r[1:] for i, r in enumerate(rows) if r[0][0] % CALIBRATE == 0]
        used = [r[1:] for r in rows if r[0][0] % CALIBRATE]
        w = ftrl(used, len(langs))
        # the sample levels the languages: the intercepts get their shares back
        drawn = np.maximum(np.bincount([r[0] for r in used], minlength=len(langs)), 0.5)
        w[BUCKETS] += np.log([texts[lang] for lang in langs]) - np.log(drawn)
        if aside:
            label = np.array([r[0] for r in aside])
            logits = np.array([r[2] @ w[r[1]] + w[BUCKETS] for r in aside])
            many = np.bincount(label, minlength=len(langs))
            w /= temperature(logits, label, np.array([texts[langs[c]] / many[c] for c in label]))
        w[:BUCKETS] *= 100 * weight[:, None]
        some = np.flatnonzero(w.any(axis=1))
        yield pd.DataFrame({"bucket": some.astype(np.int32), "w": pd.Series([w[i].tolist() for i in some], dtype=object)})

    rows = sample(spark, training, texts).repartition(1).mapInPandas(learn, "bucket int, w array<double>")
    out = np.zeros((BUCKETS + 1, len(langs)))
    for r in rows.toLocalIterator():
        out[r["bucket"]] = r["w"]
    return langs, out


def logits(texts: list[str | None], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a text has a letter, and its logits."""
    out = np.zeros((len(texts), weights.shape[1]))
    sound = np.zeros(len(texts), dtype=bool)
    for at, run in _chunks(texts, max(1, CHUNK * 8 // (8 + weights.shape[1]))):
        owner, bucket = grams(run)
        if len(owner):
            found, starts, count = np.unique(owner, return_index=True, return_counts=True)
            sums = np.add.reduceat(weights[bucket], starts, axis=0, dtype=np.float64)
            out[at + found] = sums / count[:, None] + weights[BUCKETS]
            sound[at + found] = True
    return sound, out


def predict(spark: SparkSession, docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (doc_id, text)."""
    ship(spark)
    shared = spark.sparkContext.broadcast((model[0], model[1].astype(np.float32)))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, weights = shared.value
        for batch in batches:
            best, score = [UNKNOWN] * len(batch), np.zeros(len(batch))
            if langs and len(batch):
                sound, z = logits(batch["text"].tolist(), weights)
                p = _softmax(z)
                top = p.argmax(axis=1)
                best = [langs[i] if ok else UNKNOWN for i, ok in zip(top, sound)]
                score = np.where(sound, p[np.arange(len(batch)), top], 0.0)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": pd.Series(best, dtype=object), "score": score})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInPandas(label, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learn from the training rows of docs (doc_id, text, lang) and predict all its rows."""
    return predict(spark, docs, fit(spark, docs.select("doc_id", "text", "lang")))
