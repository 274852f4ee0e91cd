"""Language identification by a linear-chain CRF over words.

Every word has a language. Its features are its affixes, the character pairs
and triples in it (as UTF-8 bytes, hashed) and the lexicons that hold it;
transitions are learnt. Training sequences splice stretches of documents of
several languages, so that the chain learns to switch. Forward-backward gives
each word's marginals; a document's language is the one with the largest sum
over its words, weighted by length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import slices, texts
from opslake.llm.crf import Adam, Chains, forward_backward

# Bounds of the training sample: documents expected per language, words of one of them, languages.
TRAIN_DOCS = 200
TRAIN_WORDS = 20_000
LANGUAGES = 500
TRAIN_BYTES = 64 << 20  # of text on the driver, in expectation
LEXICON = 200  # words per language
BUCKETS = 1 << 14
WORD_BYTES = 60
REMEMBERED = 400_000  # words of which a Python worker knows the scores
UNKNOWN = "und"

_KEEP = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)).translate(_KEEP)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased) and non-ASCII characters; runs above WORD_BYTES are cut between characters."""
    words = text.translate(_LETTERS).split()
    if max(map(len, words), default=0) <= WORD_BYTES:
        return words
    return [part for w in words for part in _parts(w)]


def _parts(word: bytes) -> Iterator[bytes]:
    """Consecutive parts of at most WORD_BYTES."""
    at = 0
    while len(word) - at > WORD_BYTES:
        stop = at + WORD_BYTES
        back = next((k for k in range(4) if word[stop - k] & 0xC0 != 0x80), 0)  # 0 where it is not UTF-8
        yield word[at : stop - back]
        at = stop - back
    yield word[at:]


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def word_features(word: bytes, lexicon: dict[bytes, list[int]]) -> list[int]:
    """Buckets of a word: constant, length, affixes, pairs and triples, lexicons (the last LANGUAGES buckets)."""
    w = b"^" + word + b"$"
    n = len(w)
    grams = [w[i : i + 2] for i in range(n - 1)] + [w[i : i + 3] for i in range(n - 2)]
    grams += [b"p" + w[:4], b"p" + w[:5], b"s" + w[-4:], b"s" + w[-5:]]
    return [0, 1 + min(n, 20), *(22 + crc32(g) % (BUCKETS - 22) for g in grams), *(BUCKETS + k for k in lexicon.get(word, ()))]


def feature_rows(words: list[bytes], lexicon: dict[bytes, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets end to end, value of each, first bucket of each word); a word's values sum to about 1 per kind."""
    lists = [word_features(w, lexicon) for w in words]
    counts = np.array([len(x) for x in lists])
    flat = np.array([b for x in lists for b in x], np.int64)
    values = np.repeat(4 / np.sqrt(counts), counts)
    return flat, values, np.concatenate([[0], np.cumsum(counts)[:-1]])


class _Numbers(dict):
    """Numbers words in the order of first look-up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


@dataclass
class Model:
    langs: list[str]
    lexicon: dict[bytes, list[int]]
    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def __post_init__(self):
        self.forget()

    def forget(self) -> None:
        self.numbers, self.known = _Numbers(), np.zeros((0, len(self.langs)), np.float32)

    def __getstate__(self):
        return (self.langs, self.lexicon, self.weights, self.trans, self.start)

    def __setstate__(self, state):
        self.langs, self.lexicon, self.weights, self.trans, self.start = state
        self.forget()

    def _scores(self, ids: np.ndarray) -> np.ndarray:
        """Label scores of words by number; new ones are computed first."""
        n = len(self.known)
        if len(self.numbers) > n:
            new = list(self.numbers)[n:]
            parts = [self.known]
            for i in range(0, len(new), 20_000):
                flat, values, firsts = feature_rows(new[i : i + 20_000], self.lexicon)
                parts.append(np.add.reduceat(self.weights[flat] * values[:, None].astype(np.float32), firsts, axis=0))
            self.known = np.concatenate(parts)
        return self.known[ids]

    def label(self, docs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(marginals by word, bytes by word) of each text, in order."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        words = [words_of(t) for t in docs]
        counts = np.array([len(w) for w in words], np.int64)
        ids = np.fromiter((i for w in words for i in map(self.numbers.__getitem__, w)), np.int64, int(counts.sum()))
        sizes = np.fromiter((n for w in words for n in map(len, w)), np.float32, len(ids))
        marginals, _, _ = forward_backward(Chains(counts), self._scores(ids), self.trans, self.start)
        ends = np.cumsum(counts)
        for a, b in zip(ends - counts, ends, strict=True):
            yield marginals[a:b], sizes[a:b]

    def predict(self, docs: list[bytes]) -> list[tuple[str, float]]:
        """(language, its weighted share) of each text; no letter: ``und`` and 0."""
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(docs)
        out = []
        for text, (marginals, sizes) in zip(docs, self.label(docs), strict=True):
            if not len(sizes) or not (any(65 <= b <= 122 for b in text.translate(_LETTERS).split(None, 1)[0]) or has_letter(text)):
                out.append((UNKNOWN, 0.0))
                continue
            share = (sizes @ marginals) / sizes.sum()
            k = int(np.argmax(share))
            out.append((self.langs[k], float(min(1.0, share[k]))))
        return out


def train(sample: list[tuple[bytes, str]], rounds: int = 30, stretch: int = 40, seed: int = 42) -> Model:
    """Fit on (text, language) rows.

    Documents are cut into stretches of about ``stretch`` words, shuffled and
    joined in sequences of 1 to 6 stretches. Without rows the model knows no
    language.
    """
    langs = sorted({lang for _, lang in sample})
    rng, code = np.random.default_rng(seed), {lang: i for i, lang in enumerate(langs)}
    docs = [(words_of(t), code[lang]) for t, lang in sample]
    seen = [Counter() for _ in langs]
    for w, k in docs:
        seen[k].update(w)
    totals = [max(1, sum(c.values())) for c in seen]
    lexicon: dict[bytes, list[int]] = {}
    for k, c in enumerate(seen):
        # Most frequent words that are at least half this language's.
        rates = {w: n / totals[k] / sum(o[w] / t for o, t in zip(seen, totals, strict=True)) for w, n in c.most_common(4 * LEXICON)}
        for w in [w for w in rates if rates[w] >= 0.5][:LEXICON]:
            lexicon.setdefault(w, []).append(k)
    weights = np.zeros((BUCKETS + len(langs), len(langs)))
    trans, start = np.zeros((len(langs), len(langs))), np.zeros(len(langs))
    if len(langs) > 1:
        numbers, pieces = _Numbers(), []
        for w, k in docs:
            ids = [numbers[x] for x in w]
            cuts = [0]
            while cuts[-1] < len(ids):
                cuts.append(cuts[-1] + int(rng.integers(1, 2 * stretch)))
            pieces += [(ids[a:b], k) for a, b in zip(cuts, cuts[1:], strict=False)]
        order, sequences, at = rng.permutation(len(pieces)), [], 0
        while at < len(order):
            take = int(rng.integers(1, 7))
            sequences.append([pieces[i] for i in order[at : at + take]])
            at += take
        words = np.array([i for s in sequences for ids, _ in s for i in ids])
        y = np.array([k for s in sequences for ids, k in s for _ in ids])
        counts = np.array([sum(len(ids) for ids, _ in s) for s in sequences])
        _fit(list(numbers), lexicon, words, y, Chains(counts), weights, trans, start, rounds)
    return Model(langs, lexicon, weights.astype(np.float32), trans.astype(np.float32), start.astype(np.float32))


def _fit(
    vocabulary: list[bytes], lexicon: dict, words: np.ndarray, y: np.ndarray, chains: Chains,
    weights: np.ndarray, trans: np.ndarray, start: np.ndarray, rounds: int,
) -> None:
    """Gradient ascent on the likelihood, in place."""
    flat, values, firsts = feature_rows(vocabulary, lexicon)
    counts = np.diff(np.append(firsts, len(flat)))
    size, n_langs = len(vocabulary), trans.shape[0]
    inside = np.ones(len(y), bool)
    inside[chains.starts] = False
    pairs = np.zeros_like(trans)
    np.add.at(pairs, (y[np.flatnonzero(inside) - 1], y[inside]), 1)
    target = np.stack([np.bincount(words[y == k], minlength=size) for k in range(n_langs)], axis=1).astype(np.float64)
    first_y = np.bincount(y[chains.starts], minlength=n_langs)
    adam = Adam([weights, trans, start], 0.1)
    for _ in range(rounds):
        table = np.add.reduceat(weights[flat] * values[:, None], firsts, axis=0)
        marginals, _, expected = forward_backward(chains, table[words], trans, start, pairs=True)
        by_word = target - np.stack([np.bincount(words, marginals[:, k], minlength=size) for k in range(n_langs)], axis=1)
        spread = np.repeat(by_word, counts, axis=0) * values[:, None]
        slope = np.stack([np.bincount(flat, spread[:, k], minlength=len(weights)) for k in range(n_langs)], axis=1)
        adam.ascend([
            slope / len(words) - 1e-6 * weights,
            (pairs - expected) / max(1, inside.sum()) - 1e-4 * trans,
            (first_y - marginals[chains.starts].sum(axis=0)) / len(chains.starts),
        ])


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = TRAIN_DOCS
) -> Model:
    """Fit on a sample of the rows with a language: about ``docs_per_lang`` of each, by the hash of the text.

    Documents of more than TRAIN_WORDS words, or of as many times WORD_BYTES, are
    not used for training. The sample holds about TRAIN_BYTES at most, shared
    evenly by the languages; of more than LANGUAGES languages the most frequent
    are learnt, those that are equally frequent by name.
    """
    short = (F.size(F.split(F.col(text_col), " ")) <= TRAIN_WORDS) & (F.octet_length(text_col) <= TRAIN_WORDS * WORD_BYTES)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    held = F.sum(F.when(short, F.octet_length(text_col)).otherwise(0)).alias("bytes")
    sizes = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"), held).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return train([])
    share = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / float(1 << 30)
    part = TRAIN_BYTES / len(sizes)
    shares = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, docs_per_lang / r["n"], part / max(1, r["bytes"])))])
    least = rows.where((share < F.element_at(shares, F.col(lang_col))) & short)
    found = least.select(F.col(text_col).cast("binary").alias("text"), F.col(lang_col).alias("lang")).limit(4 * docs_per_lang * len(sizes)).collect()
    return train(sorted((bytes(r["text"]), r["lang"]) for r in found))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``; only the text counts.

    A NULL text, an empty one and one without a letter are ``und`` with score 0.
    score is the language's share of the words' marginals, weighted by length.
    Repeated rows get equal results, an empty table gives no row, other columns
    do not matter.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages and the lexicons

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in slices(batches):
            found = own.predict(batch.column(1).to_pylist())
            yield pa.record_batch(
                [batch.column(0), pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def label_words(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, words array<struct<word, lang, score>>): the language of every word of every row; none if no language is known."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("score", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in slices(batches):
            raw, out = batch.column(1).to_pylist(), []
            if not own.langs:
                yield pa.record_batch([batch.column(0), pa.array([[]] * len(raw), kind)], names=["doc_id", "words"])
                continue
            for text, (marginals, _) in zip(raw, own.label(raw), strict=True):
                best = marginals.argmax(axis=1)
                out.append([
                    {"word": w.decode("utf-8", "replace"), "lang": own.langs[k], "score": float(m[k])}
                    for w, k, m in zip(words_of(text), best, marginals, strict=False)
                ])
            yield pa.record_batch([batch.column(0), pa.array(out, kind)], names=["doc_id", "words"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, words array<struct<word: string, lang: string, score: double>>")
