"""Language-model scores of whole texts (operator 8).

Model: a log-bilinear trigram over `SYMBOLS` symbols, trained in numpy with noise-contrastive
estimation. The commonest `SINGLES` training words are symbols of their own, one of them always the
end of a text; every other word belongs to one of the remaining symbols by its last two bytes, and is
predicted inside it by its smoothed share of the symbol's training tokens (an unseen word counts as one
more word of its symbol). A context vector is the sum of two position matrices' rows for the two
symbols before (ends before the first word); its product with the symbol vectors plus biases, through a
softmax over all symbols, is the symbol's probability. All contexts are scored in batched matrix
products, so every log-probability is normalised.

Distribution: texts are packed into chunks (some `CHUNK` tokens: words as codes into the chunk's own
vocabulary), written once. Word counts are sums over chunk vocabularies. Scoring joins each chunk's vocabulary
with the corpus counts. No step holds a whole corpus vocabulary.

Training: tasks count which symbol follows which two in the training texts; Spark adds the counts up. They are exact
and at most SYMBOLS ** 3 whatever the corpus, so one task trains the model on them, and the scores are the same however
the table is split. A step takes a batch of contexts with all that follows them; each of their tokens stands against
`NOISE` noise words drawn from the unigram distribution.

Edge cases: a null or empty text is a single end; a null doc_id hashes as an empty string; repeated rows are
scored each; without training texts the counts are zero and the model is uniform; an empty table gives an
empty result; other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, ship, stage

FOLDS, HELD = 5, 1
SYMBOLS, SINGLES, DIM = 256, 192, 24
CHUNK = 2_000_000
BATCH, NOISE, RATE, PASSES = 1024, 64, 0.1, 20
SEED, _SLICE = 11, 1 << 18
END = b"\n"                       # no word holds white space
END_HASH = int(np.uint64(xxhash.xxh64_intdigest(END)).astype(np.int64))


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(int(doc_id)).encode()) % FOLDS == HELD


def _group(word: bytes) -> int:
    """Symbol of a word that has none of its own."""
    return SINGLES + zlib.crc32(word[-2:]) % (SYMBOLS - SINGLES)


_CHUNK = ("chunk long, doc_ids array<long>, held array<boolean>, sizes array<int>, codes binary, "
          "words array<long>, groups array<int>, counts array<long>")


def _shrink(codes: np.ndarray) -> bytes:
    """Codes as compressed byte planes: the high bytes are mostly zero."""
    return zlib.compress(np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _codes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Chunk:
    """Texts as codes into a vocabulary of their own."""

    def __init__(self, number: int):
        self.number, self.vocab = number, {}
        self.ids, self.held, self.sizes, self.codes, self.n = [], [], [], [], 0

    def add(self, doc_id, words: list[bytes]) -> None:
        vocab = self.vocab
        self.ids.append(doc_id)
        self.held.append(held_out(doc_id))
        self.sizes.append(len(words))
        self.codes.append(np.array([vocab.setdefault(w, len(vocab)) for w in words], np.int32))
        self.n += len(words)

    def row(self) -> pd.DataFrame:
        codes, kinds = np.concatenate(self.codes), len(self.vocab)
        train = np.repeat(~np.array(self.held, bool), self.sizes)
        return pd.DataFrame({
            "chunk": [self.number], "doc_ids": [self.ids], "held": [self.held], "sizes": [self.sizes],
            "codes": [_shrink(codes)],
            "words": [np.fromiter(map(xxhash.xxh64_intdigest, self.vocab), np.uint64, kinds).astype(np.int64)],
            "groups": [np.fromiter(map(_group, self.vocab), np.int32, kinds)],
            "counts": [np.bincount(codes[train], minlength=kinds).astype(np.int64)]})


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    chunk = _Chunk(TaskContext.get().partitionId() << 32)
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"].astype(object), pdf["text"]):
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()
            chunk.add(None if pd.isna(doc_id) else int(doc_id), [*words, END])
            if chunk.n >= CHUNK:
                yield chunk.row()
                chunk = _Chunk(chunk.number + 1)
    if chunk.n:
        yield chunk.row()


def _symbols(words: np.ndarray, groups: np.ndarray, singles: dict[int, int]) -> np.ndarray:
    out = groups.astype(np.uint8)
    for i in np.flatnonzero(np.isin(words, np.fromiter(singles, np.int64, len(singles)))):
        out[i] = singles[int(words[i])]
    return out


def _contexts(symbols: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols one and two places before each token; ends stand before a text's first token."""
    one, two = np.roll(symbols, 1), np.roll(symbols, 2)
    first = np.cumsum(sizes) - sizes
    one[first] = end
    two[first] = end
    second = first[sizes > 1] + 1
    two[second] = end
    return one, two


def start_model(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {k: (0.1 * rng.standard_normal((SYMBOLS, DIM))).astype(np.float64) for k in ("near", "far", "out")}


def cells_of(one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
    """(symbol before, the one before that, what follows) in one number."""
    return (one.astype(np.int32) * SYMBOLS + two) * SYMBOLS + target


def train(model: dict, bias: np.ndarray, noise: np.ndarray, cell: np.ndarray, count: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Noise-contrastive steps over the counts of cells (distinct, ascending).

    A batch is some contexts with the counts of what follows them. Against each of its tokens stand `NOISE` words
    drawn from the noise distribution (their numbers by symbol are Poisson draws). The score of a symbol stands for
    its log-probability: the bias starts at the unigram's. Gradients are scaled by Adagrad sums."""
    context, first = np.unique(cell // SYMBOLS, return_index=True)
    last = np.append(first[1:], len(cell))
    rng = np.random.default_rng(seed)
    near, far, out, b = (x.astype(np.float32) for x in (model["near"], model["far"], model["out"], bias))
    sums = {k: np.full((SYMBOLS, 1), 1e-8, np.float32) for k in ("near", "far", "out", "b")}
    shift, draws = np.log(NOISE * noise).astype(np.float32), (NOISE * noise).astype(np.float32)
    hot = np.eye(SYMBOLS, dtype=np.float32)

    def step(x, key, grad):
        sums[key] += (grad ** 2).mean(axis=1, keepdims=True)
        x -= RATE * grad / np.sqrt(sums[key])

    for _ in range(PASSES):
        order = rng.permutation(len(context))
        for i in range(0, len(order), BATCH):
            pick = np.sort(order[i:i + BATCH])
            sizes = last[pick] - first[pick]
            row = np.repeat(np.arange(len(pick)), sizes)
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[pick][row]
            seen = np.zeros((len(pick), SYMBOLS), np.float32)
            seen[row, cell[at] % SYMBOLS] = count[at]
            n = seen.sum(axis=1, keepdims=True)
            h1, h2 = hot[context[pick] // SYMBOLS], hot[context[pick] % SYMBOLS]
            q = h1 @ near + h2 @ far
            true = 1 / (1 + np.exp(np.clip(shift - b - q @ out.T, -30, 30)))
            g = ((seen + rng.poisson(n * draws).astype(np.float32)) * true - seen) / n.sum()
            g_q = g @ out
            step(out, "out", g.T @ q)
            step(near, "near", h1.T @ g_q)
            step(far, "far", h2.T @ g_q)
            step(b[:, None], "b", g.sum(axis=0)[:, None])
    return {"near": near, "far": far, "out": out, "b": b}


def log_table(model: dict[str, np.ndarray], b: np.ndarray) -> np.ndarray:
    """Normalised log10-probabilities, one row per context (near symbol * SYMBOLS + far symbol)."""
    table = np.empty((SYMBOLS * SYMBOLS, SYMBOLS), np.float32)
    shift = model["far"] @ model["out"].T
    for s in range(SYMBOLS):
        logits = (model["near"][s] @ model["out"].T + b) + shift
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        table[s * SYMBOLS:(s + 1) * SYMBOLS] = logits / np.log(10)
    return table


def _counter(singles: dict[int, int]):
    """Counts of the cells of the training texts, added up over a task's chunks."""
    end = singles[END_HASH]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, counts = np.empty(0, np.int32), np.empty(0, np.int64)
        for pdf in batches:
            for held, sizes, codes, words, groups in zip(*(pdf[c] for c in ("held", "sizes", "codes", "words", "groups"))):
                sizes = np.asarray(sizes, np.int64)
                symbols = _symbols(np.asarray(words), np.asarray(groups), singles)[_codes(codes)]
                one, two = _contexts(symbols, sizes, end)
                mine = np.repeat(~np.asarray(held, bool), sizes)
                more, n = np.unique(cells_of(one[mine], two[mine], symbols[mine]), return_counts=True)
                both, at = np.unique(np.concatenate([cells, more]), return_inverse=True)
                summed = np.zeros(len(both), np.int64)
                summed[at[:len(cells)]] += counts
                summed[at[len(cells):]] += n
                cells, counts = both.astype(np.int32), summed
        for i in range(0, len(cells), _SLICE):
            yield pd.DataFrame({"cell": cells[i:i + _SLICE], "n": counts[i:i + _SLICE]})
    return run


def _trainer(model: dict, bias: np.ndarray, noise: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(np.asarray(c, np.int64) * SYMBOLS + np.asarray(t), np.asarray(n)) for pdf in batches
                 for c, t, n in zip(pdf["context"], pdf["targets"], pdf["counts"])]
        if parts:
            cell, count = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(cell, kind="stable")
            got = train(model, bias, noise, cell[order], count[order].astype(np.float32), SEED)
            yield pd.DataFrame({"name": list(got), "vector": pd.Series([got[k].ravel().astype(np.float64) for k in got], dtype=object)})
    return run


def _scorer(singles: dict[int, int], model: dict, b: np.ndarray, tokens: dict[int, int], types: dict[int, int], total: int, kinds: int):
    """tokens, types: training tokens and distinct training words of each symbol that groups words."""
    end = singles[END_HASH]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, log_total = log_table(model, b), np.log10(total + 0.5 * (kinds + 1))
        inside = np.zeros(SYMBOLS)
        for s in range(SINGLES, SYMBOLS):
            inside[s] = np.log10(tokens.get(s, 0) + 0.5 * (types.get(s, 0) + 1))
        for pdf in batches:
            for ids, held, sizes, codes, words, groups, at, counts in zip(*(pdf[c] for c in (
                    "doc_ids", "held", "sizes", "codes", "words", "groups", "at", "corpus"))):
                sizes, codes, words = np.asarray(sizes, np.int64), _codes(codes), np.asarray(words)
                c = np.zeros(len(words))
                if at is not None:
                    c[np.asarray(at, np.int64)] = np.asarray(counts)
                of = _symbols(words, np.asarray(groups), singles)
                grouped = of >= SINGLES
                share = np.where(grouped, np.log10(c + 0.5) - inside[of], 0.0)
                symbols = of[codes]
                one, two = _contexts(symbols, sizes, end)
                score = table[one.astype(np.int32) * SYMBOLS + two, symbols] + share[codes]
                base = (np.log10(c + 0.5) - log_total)[codes]
                first = np.cumsum(sizes) - sizes
                yield pd.DataFrame({
                    "doc_id": pd.array(list(ids), "Int64"), "held_out": np.asarray(held, bool), "n_tokens": sizes,
                    "n_known": np.add.reduceat((c > 0)[codes].astype(np.int64), first), "train_tokens": np.full(len(sizes), total),
                    "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(score, first)})
    return run


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per document."""
    ship(spark)
    chunks = stage(spark, docs.select("doc_id", "text").mapInPandas(_pack, _CHUNK), "lm-chunks")
    words = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "groups", "counts")).alias("at", "w")).select(
        "chunk", "at", F.col("w.words").alias("word"), F.col("w.groups").alias("group"), F.col("w.counts").alias("n"))
    corpus = stage(spark, words.where("n > 0").groupBy("word").agg(
        F.min("group").alias("group"), F.sum("n").alias("c")), "lm-counts")
    release(spark)

    # Fixed-size facts for the driver: the commonest words, sums over all words and by symbol.
    total, kinds = corpus.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = corpus.where(F.col("word") != END_HASH).orderBy(F.desc("c"), "word").limit(SINGLES - 1).collect()
    end_count = sum(r["c"] for r in corpus.where(F.col("word") == END_HASH).collect())
    singles = {END_HASH: 0} | {r["word"]: i + 1 for i, r in enumerate(top)}
    rest = corpus.where(~F.col("word").isin(list(singles))).groupBy("group").agg(
        F.sum("c").alias("tokens"), F.count("*").alias("types")).collect()
    tokens, types = {r["group"]: r["tokens"] for r in rest}, {r["group"]: r["types"] for r in rest}
    mass = np.full(SYMBOLS, 0.5)
    mass[0] += end_count
    for i, r in enumerate(top):
        mass[i + 1] += r["c"]
    for s, n in tokens.items():
        mass[s] += n
    noise = mass / mass.sum()
    bias, model = np.log(noise), start_model()

    cells = chunks.select("held", "sizes", "codes", "words", "groups").mapInPandas(_counter(singles), "cell int, n long")
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n"))
    # at most SYMBOLS ** 2 rows with SYMBOLS counts each
    contexts = cells.groupBy(F.floor(F.col("cell") / SYMBOLS).alias("context")).agg(
        F.collect_list((F.col("cell") % SYMBOLS).cast("int")).alias("targets"), F.collect_list("n").alias("counts"))
    contexts = stage(spark, contexts, "lm-contexts")
    parts = contexts.repartition(1).mapInPandas(_trainer(model, bias, noise), "name string, vector array<double>").collect()
    got = {r["name"]: np.array(r["vector"]) for r in parts}
    if got:
        model = {k: got[k].reshape(SYMBOLS, DIM) for k in ("near", "far", "out")}
        bias = got["b"]
    release(spark, contexts)

    known = words.select("chunk", "at", "word").join(corpus.select("word", "c"), "word").groupBy("chunk").agg(
        F.collect_list(F.struct("at", "c")).alias("k")).select(
        F.col("chunk").alias("of"), F.transform("k", lambda x: x["at"]).alias("at"), F.transform("k", lambda x: x["c"]).alias("corpus"))
    known = stage(spark, known, "lm-known")
    release(spark)
    ready = chunks.drop("counts").join(known, F.col("chunk") == F.col("of"), "left").drop("of")
    return ready.mapInPandas(
        _scorer(singles, model, bias, tokens, types, int(total), int(kinds)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
