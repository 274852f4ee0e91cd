"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

Frequent words are classes of their own, all others share classes by their last
two bytes; the end of a text is a class too. The model predicts the next class
from the two before it: ``score(w | h) = sum_i (c_i * r[h_i]) . q[w] + b[w]``. A
word of a shared class then has its smoothed share of the class, and one share
is left for words never seen. So every text gets normalised probabilities over
all words.

Counting, training and scoring run over all documents. Every task trains on its
own part from a common start and Spark averages the parameters by tokens, so
what is gathered grows with the corpus and no task sees more than its part.
Because the score is a sum of a term per context word, all normalisers come from
one matrix product of exponentials, and a token is scored by three look-ups.

Sizes: CLASSES and FREQUENT bound all that is sent to tasks. Words beyond the
FREQUENT most frequent ones get their counts by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import slices, texts
from opslake.sources.scratch import saved, shared_dir

CLASSES = 1024
SHARED = 63  # classes that words share, the last ones
DIM = 24
NOISE = 64
BATCH = 1024
FREQUENT = 100_000
WARM_DOCS, WARM_TOKENS = 2_000, 4_000_000  # documents and tokens expected in the common start
_FLUSH = 200_000
_SLICE = 3 << 20  # bytes of text that a task has cut into words at once

END = b""  # no word is empty


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over (doc_id, text) rows, the end of every text included."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

        seen: Counter = Counter()
        for batch in slices(batches, size=_SLICE):
            for text in batch.column(1).to_pylist():
                seen.update(words_of(text))
                seen[END] += 1
                if len(seen) > _FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    return docs.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Classes:
    """Class of every word: 0 the end, then the listed words, then the shared classes."""

    listed: list[bytes]

    def __post_init__(self):
        self.number = {END: 0} | {w: i for i, w in enumerate(self.listed, 1)}
        self.first_shared = len(self.listed) + 1
        self.size = self.first_shared + SHARED

    def of(self, word: bytes) -> int:
        k = self.number.get(word)
        return self.first_shared + crc32(word[-2:]) % SHARED if k is None else k

    def sequence(self, words: list[bytes]) -> list[int]:
        """Classes of a text's words and its end."""
        get, first = self.number.get, self.first_shared
        return [first + crc32(w[-2:]) % SHARED if (k := get(w)) is None else k for w in words] + [0]


def contexts(sequences: list[list[int]] | list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, class before, class two before) of all positions; ``start`` stands before a text."""
    now = np.concatenate([np.asarray(s, np.int64) for s in sequences])
    one, two = np.full(len(now), start), np.full(len(now), start)
    one[1:], two[2:] = now[:-1], now[:-2]
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in sequences])[:-1]])
    one[firsts] = two[firsts] = start
    second = firsts[np.array([len(s) for s in sequences]) > 1] + 1
    two[second] = start
    return now, one, two


@dataclass
class Params:
    """One row of DIM + 1 numbers per context class, target class (its bias last) and context place."""

    rows: np.ndarray
    size: int

    @classmethod
    def start(cls, log_unigram: np.ndarray, seed: int = 42) -> Params:
        size, rng = len(log_unigram), np.random.default_rng(seed)
        rows = np.zeros((2 * size + 3, DIM + 1), np.float32)
        rows[: size + 1, :DIM] = rng.normal(0, 0.1, (size + 1, DIM))
        rows[size + 1 : 2 * size + 1, :DIM] = rng.normal(0, 0.1, (size, DIM))
        rows[size + 1 : 2 * size + 1, DIM] = log_unigram
        rows[2 * size + 1 :, :DIM] = [[1.0], [0.5]]
        return cls(rows, size)

    @property
    def context(self) -> np.ndarray:
        return self.rows[: self.size + 1, :DIM]

    @property
    def target(self) -> np.ndarray:
        return self.rows[self.size + 1 : 2 * self.size + 1, :DIM]

    @property
    def bias(self) -> np.ndarray:
        return self.rows[self.size + 1 : 2 * self.size + 1, DIM]

    @property
    def places(self) -> np.ndarray:
        return self.rows[2 * self.size + 1 :, :DIM]


def _sum_rows(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct index, rows summed over it)."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    firsts = np.flatnonzero(np.diff(index, prepend=-1))
    return index[firsts], np.add.reduceat(rows[order], firsts, axis=0)


class Trainer:
    """Noise-contrastive estimation by Adagrad; a batch shares its noise classes."""

    def __init__(self, params: Params, unigram: np.ndarray, rate: float = 0.1, seed: int = 42):
        self.p, self.rate, self.rng = params, rate, np.random.default_rng(seed)
        self.past = np.full(params.rows.shape, 1e-2, np.float32)
        self.cumulative = np.cumsum(unigram)
        self.log_noise = np.log(NOISE * unigram).astype(np.float32)
        self.tokens = 0

    def _step(self, block: slice, index: np.ndarray, gradient: np.ndarray) -> None:
        rows, past = self.p.rows[block], self.past[block]
        index, gradient = _sum_rows(index, gradient)
        past[index] += gradient * gradient
        rows[index] += self.rate * gradient / np.sqrt(past[index])

    def learn(self, now: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        p, n = self.p, self.p.size
        order = self.rng.permutation(len(now))
        for at in range(0, len(now), BATCH):
            pick = order[at : at + BATCH]
            w, h1, h2 = now[pick], one[pick], two[pick]
            noise = np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1])
            r1, r2, (c1, c2) = p.context[h1], p.context[h2], p.places
            hat = r1 * c1 + r2 * c2
            q, qn = p.target[w], p.target[noise]
            true = np.einsum("ij,ij->i", hat, q) + p.bias[w] - self.log_noise[w]
            fake = hat @ qn.T + (p.bias[noise] - self.log_noise[noise])
            gt = 1 / (1 + np.exp(np.minimum(true, 30)))
            gf = -1 / (1 + np.exp(-np.clip(fake, -30, 30)))
            dhat = (gt[:, None] * q + gf @ qn) / len(pick)
            gt, gf = gt / len(pick), gf / len(pick)
            target = np.concatenate([np.column_stack([gt[:, None] * hat, gt]), np.column_stack([gf.T @ hat, gf.sum(axis=0)])]).astype(np.float32)
            self._step(slice(n + 1, 2 * n + 1), np.concatenate([w, noise]), target)
            context = np.zeros((2 * len(pick), DIM + 1), np.float32)
            context[: len(pick), :DIM], context[len(pick) :, :DIM] = dhat * c1, dhat * c2
            self._step(slice(0, n + 1), np.concatenate([h1, h2]), context)
            place = np.zeros((2, DIM + 1), np.float32)
            place[0, :DIM], place[1, :DIM] = (dhat * r1).sum(axis=0), (dhat * r2).sum(axis=0)
            self._step(slice(2 * n + 1, 2 * n + 3), np.arange(2), place)
        self.tokens += len(now)


def train(docs: DataFrame, classes: Classes, unigram: np.ndarray, params: Params) -> Params:
    """One pass of every task over its documents, parameters averaged by tokens."""
    shipped = docs.sparkSession.sparkContext.broadcast((classes, unigram, params))
    columns = [f"x{j}" for j in range(DIM + 1)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, unigram, params = shipped.value
        own = Trainer(Params(params.rows.copy(), params.size), unigram)
        for batch in slices(batches, size=_SLICE):
            sequences = [classes.sequence(words_of(t)) for t in batch.column(1).to_pylist()]
            own.learn(*contexts(sequences, classes.size))
        if own.tokens:
            rows = own.p.rows.astype(np.float64) * own.tokens
            yield pa.record_batch(
                [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), float(own.tokens))), *map(pa.array, rows.T.copy())],
                names=["row", "tokens", *columns],
            )

    schema = "row long, tokens double, " + ", ".join(f"{c} double" for c in columns)
    sums = docs.mapInArrow(run, schema).groupBy("row").agg(*[(F.sum(c) / F.sum("tokens")).alias(c) for c in columns])
    found = sums.collect()  # as many rows as parameters have
    if not found:
        return params
    rows = np.empty_like(params.rows)
    for r in found:
        rows[r["row"]] = r[1:]
    return Params(rows, params.size)


class Scorer:
    """Log10 probabilities of classes, from tables over all contexts."""

    def __init__(self, params: Params):
        q, b = params.target.astype(np.float64), params.bias.astype(np.float64)
        one = params.context.astype(np.float64) * params.places[0] @ q.T + b
        two = params.context.astype(np.float64) * params.places[1] @ q.T
        top1, top2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        z = np.exp(one - top1) @ np.exp(two - top2).T
        log_z = np.log(z) + top1 + top2.T
        self.one, self.two, self.log_z = (x.astype(np.float32) / np.float32(math.log(10)) for x in (one, two, log_z))

    def tokens(self, now: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (self.one[one, now] + self.two[two, now] - self.log_z[one, two]).astype(np.float64)


@dataclass
class Model:
    """All that scoring needs, the counts of infrequent words apart."""

    classes: Classes
    scorer: Scorer
    frequent: dict[bytes, int]  # word -> place in the arrays
    log_count: np.ndarray  # log10(c + 0.5)
    class_of: np.ndarray
    log_share: np.ndarray  # log10 of what (c + 0.5) is divided by, by class; NaN where the class is one word
    log_total: float
    total: int

    def score(self, texts: list[bytes]) -> Iterator[tuple[int, int, float, float, Counter]]:
        """(tokens, known, base, score, infrequent words) of each text.

        Infrequent words still lack ``log10(c + 0.5)`` per occurrence in base and score.
        """
        words = [words_of(t) for t in texts]
        if not words:
            return
        get, numbered = self.frequent.get, []
        for w in words:
            ids = np.fromiter((get(x, -1) for x in w), np.int64, len(w))
            numbered.append((ids, np.flatnonzero(ids < 0)))
        sequences, rare = [], []
        for w, (ids, missing) in zip(words, numbered, strict=True):
            s = np.zeros(len(w) + 1, np.int64)
            s[:-1] = self.class_of[ids]
            unknown = [w[i] for i in missing.tolist()]
            s[missing] = [self.classes.of(x) for x in unknown]
            sequences.append(s)
            rare.append(Counter(unknown))
        by_class = self.scorer.tokens(*contexts(sequences, self.classes.size))
        at, end = 0, self.frequent.get(END)
        for s, (ids, missing), lost in zip(sequences, numbered, rare, strict=True):
            counts = self.log_count[ids]
            counts[missing] = 0.0
            last = self.log_count[end] if end is not None else math.log10(0.5)
            shares = self.log_share[s[:-1]]
            inside = ~np.isnan(shares)
            base = counts.sum() + last - len(s) * self.log_total
            score = by_class[at : at + len(s)].sum() + (counts[inside] - shares[inside]).sum()
            yield len(s), len(ids) - len(missing) + (end is not None), float(base), float(score), lost
            at += len(s)


def warm_start(train_docs: DataFrame, n_docs: int, n_tokens: int) -> DataFrame:
    """The documents of the common start, for one task in a fixed order.

    They are chosen where the documents are read; only the chosen rows move.
    """
    share = min(1.0, WARM_DOCS / max(1, n_docs), WARM_TOKENS / max(1, n_tokens))
    chosen = F.xxhash64("doc_id", "text")
    return train_docs.where(F.pmod(chosen, F.lit(1 << 30)) < (1 << 30) * share).repartition(1).sortWithinPartitions(chosen, "doc_id")


def most_frequent(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` words of largest count, by count and word. Only words that may be among them are sorted.

    A histogram of the counts by powers of two, some tens of rows, says from which count on there are ``n`` words.
    """
    step = F.floor(F.log2("c")).cast("long")
    least, above = 0, 0
    for r in sorted(counts.where("c > 0").groupBy(step.alias("step")).count().collect(), reverse=True):
        above += r["count"]
        if above >= n:
            least = 1 << r["step"]
            break
    return counts.where(F.col("c") >= least).orderBy(F.desc("c"), "word").limit(n)


def fit(train_docs: DataFrame, counts: DataFrame) -> Model:
    """Fit on (doc_id, text) rows and their written word counts."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    first = most_frequent(counts.where(F.col("word") != F.lit(END)), FREQUENT).toArrow()
    texts_learnt = counts.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    top = list(zip(first.column("word").to_pylist(), first.column("c").to_pylist(), strict=True))
    if texts_learnt:  # the end is known whatever its rank
        top.append((END, texts_learnt))
    classes = Classes([w for w, _ in top if w != END][: CLASSES - SHARED - 1])
    listed = counts.sparkSession.createDataFrame([(w,) for w in [END, *classes.listed]], "word binary")
    shared = counts.join(F.broadcast(listed), "word", "left_anti")
    suffix = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(SHARED).cast("long"))
    sizes = np.zeros((classes.size, 2))
    for k, c, v in shared.groupBy(suffix).agg(F.sum("c"), F.count(F.lit(1))).collect():
        sizes[classes.first_shared + k] = c, v
    frequent = {w: i for i, (w, _) in enumerate(top)}
    c = np.array([n for _, n in top] or [0], np.float64)
    for w, n in top:
        if w == END or classes.number.get(w):
            sizes[classes.of(w)] = n, 1
    unigram = sizes[:, 0] + 0.5
    unigram /= unigram.sum()
    log_share = np.log10(sizes[:, 0] + 0.5 * (sizes[:, 1] + 1))
    log_share[: classes.first_shared] = np.nan
    params = Params.start(np.log(unigram).astype(np.float32))
    params = train(warm_start(train_docs, int(sizes[0, 0]), total), classes, unigram, params)
    params = train(train_docs, classes, unigram, params)
    return Model(
        classes, Scorer(params), frequent, np.log10(c + 0.5), np.array([classes.of(w) for w, _ in top] or [0]), log_share,
        math.log10(total + 0.5 * (distinct + 1)), total,
    )


def score_documents(
    docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``held_out`` is a boolean Column of ``docs``; rows where it is true are not
    learnt from, rows where it is NULL are. A NULL or empty text is its end
    alone. base_score is the smoothed unigram score, score the model's, both
    log10. Repeated rows count and are scored each; an empty table gives no row,
    and without any row to learn from all classes are equally likely. Other
    columns do not matter.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    rows = texts(docs, id_col, text_col, F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learn = rows.where(~F.col("held_out")).select("doc_id", "text")
    counts = saved(count_words(learn), f"{folder}/counts")
    model = fit(learn, counts)
    shipped = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        for batch in slices(batches, size=_SLICE):
            found = list(shipped.value.score(batch.column(1).to_pylist()))
            columns = [list(c) for c in zip(*found, strict=True)]
            rare = [[{"word": w, "n": n} for w, n in lost.items()] for lost in columns[4]]
            yield pa.record_batch(
                [batch.column(3), batch.column(0), batch.column(2), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64()), pa.array(rare, kind)],
                names=["uid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"],
            )

    scored = saved(
        rows.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(
            run,
            "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
            "rare array<struct<word: binary, n: long>>",
        ),
        f"{folder}/scored",
    )
    # Class words are all frequent, so an infrequent word lacks log10(c + 0.5) in both scores.
    lost = scored.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.n")
    found = lost.join(counts, "word", "left").select(
        "uid", F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"), (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("part")
    )
    rest = found.groupBy("uid").agg(F.sum("known").alias("known"), F.sum("part").alias("part"))
    part = F.coalesce("part", F.lit(0.0))
    return scored.drop("rare").join(rest, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base_score") + part).alias("base_score"),
        (F.col("score") + part).alias("score"),
    )
