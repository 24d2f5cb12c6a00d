"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A text is cut into sentences (at . ! ? and line ends; a sentence of more than ``LONGEST`` words
into pieces of as many). A word is the set of its beginnings, its endings (character n-grams) and
itself; a learned weight per n-gram gives each word a value, a sentence has the sum over
its distinct words, and its probability is the logistic function of that sum and a bias. The
sentences of a document are combined by noisy-or: the document is toxic unless every sentence is
harmless. The weights are trained from document labels alone, through the noisy-or; afterwards
``offending`` locates the sentences that make a document toxic.

Learning: at most ``SAMPLE`` labelled rows per class, chosen by a hash of the id (never held-out
ones), with their whole texts; an id with contradicting labels is not used, and of rows that
repeat an id the text of the smallest hash is taken. N-grams of fewer than ``LEAST`` sampled
documents are left out. What the driver gathers is thus bounded in rows (a
few MB) and the model is some hundred n-grams. Scoring reads every word of every document inside the tasks, in one
pass and without a shuffle.

Defined cases: a null text scores like the empty text, which has no sentence and the score 0;
repeated rows get equal scores; a null id counts as the text '' in the hold-out rule; without
labelled rows of both classes the model is empty (scores are near 0 then); other columns pass
through ``score`` (columns called ``score`` / ``predicted`` are replaced); an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import byte_values, map_batches, map_rows, slices

BEGINNINGS = (2, 3, 4, 5, 6, 7)  # letters
ENDINGS = (3, 4, 5)
LONGEST = 64
SAMPLE = {1: 800, 0: 2000}
LEAST = 3
SELECT, SELECT_STEPS = 1.0, 60
LASSO, STEPS = 0.2, 150
START = -6.0  # bias of a sentence before learning
BIAS_SCALE = 0.1
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
WORD_CACHE = 500_000

SENTENCE_END = re.compile(r"[.!?\n]+")
WORD = re.compile(r"\w+")


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words in lower case) of every sentence with a word."""
    at = 0
    ends = [*((m.start(), m.end()) for m in SENTENCE_END.finditer(text)), (len(text), len(text))]
    for stop, following in ends:
        words = WORD.findall(text[at:stop].lower())
        if 0 < len(words) <= LONGEST:
            yield at, stop, words
        elif words:
            places = [m.start() for m in WORD.finditer(text, at, stop)]
            cuts = [*places[::LONGEST], stop]
            for start, end in zip(cuts, cuts[1:]):
                yield start, end, WORD.findall(text[start:end].lower())
        at = following


def grams(word: str) -> list[str]:
    """The word, its beginnings and its endings, each once."""
    n = len(word)
    return [f"^{word}$", *[f"^{word[:k]}" for k in BEGINNINGS if k <= n], *[f"{word[-k:]}$" for k in ENDINGS if k <= n]]


class Values(dict):
    """Word -> summed weight of its n-grams, filled on first sight."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= WORD_CACHE:
            self.clear()
        get = self.weights.get
        got = self[word] = sum([w for w in map(get, grams(word)) if w is not None], 0.0)
        return got


class Model:
    """Weights of n-grams and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.values = weights, bias, Values(weights)

    def logit(self, words: list[str]) -> float:
        # added in order of size, so that equal sentences have equal sums in every task
        return self.bias + sum(sorted(filter(None, map(self.values.__getitem__, set(words)))))

    def score(self, text: str) -> float:
        logits = []
        for part in SENTENCE_END.split(text.lower()):
            words = WORD.findall(part)
            logits += [self.logit(words[k : k + LONGEST]) for k in range(0, len(words), LONGEST)]
        return float(-np.expm1(-np.logaddexp(0, logits).sum())) if logits else 0.0


class Bags:
    """Sampled documents as index arrays: documents > sentences > distinct words > n-grams."""

    def __init__(self, texts: list[str]):
        vocabulary: dict[str, int] = {}
        words, sentence_sizes, self.document_sizes = [], [], []
        for text in texts:
            count = 0
            for _, _, found in sentences(text):
                distinct = sorted(set(found))
                words.extend(vocabulary.setdefault(w, len(vocabulary)) for w in distinct)
                sentence_sizes.append(len(distinct))
                count += 1
            self.document_sizes.append(count)
        self.words = np.array(words, np.int64)
        self.sentence_of_word = np.repeat(np.arange(len(sentence_sizes)), sentence_sizes)
        self.document_of_sentence = np.repeat(np.arange(len(texts)), self.document_sizes)
        self.n_sentences = len(sentence_sizes)
        in_documents = np.unique(np.stack([self.document_of_sentence[self.sentence_of_word], self.words]), axis=1)
        known: dict[str, int] = {}
        pairs = [(known.setdefault(g, len(known)), i) for w, i in vocabulary.items() for g in grams(w)]
        gram, word = np.array(pairs, np.int64).reshape(-1, 2).T
        # n-grams of at least LEAST documents (one document counts once for each of its words)
        per_word = np.bincount(in_documents[1], minlength=len(vocabulary))
        frequent = np.bincount(gram, weights=per_word[word], minlength=len(known)) >= LEAST
        renumber = np.cumsum(frequent) - 1
        keep = frequent[gram]
        self.grams = [g for g, i in known.items() if frequent[i]]
        self.gram_of, self.word_of = renumber[gram[keep]], word[keep]
        self.n_words = len(vocabulary)

    def restrict(self, chosen: np.ndarray) -> None:
        """Go on with the chosen n-grams only."""
        keep = chosen[self.gram_of]
        self.gram_of, self.word_of = (np.cumsum(chosen) - 1)[self.gram_of[keep]], self.word_of[keep]
        self.grams = [g for g, k in zip(self.grams, chosen) if k]

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        values = np.bincount(self.word_of, weights=weights[self.gram_of], minlength=self.n_words)
        return bias + np.bincount(self.sentence_of_word, weights=values[self.words], minlength=self.n_sentences)

    def gradient(self, weights: np.ndarray, bias: float, labels: np.ndarray) -> tuple[float, np.ndarray, float]:
        """(mean loss, gradient of the weights, of the bias) of the noisy-or's log likelihood."""
        z = self.logits(weights, bias)
        n = len(labels)
        harmless = np.bincount(self.document_of_sentence, weights=np.logaddexp(0, z), minlength=n)  # -log(1 - P)
        harmless = np.maximum(harmless, 1e-12)
        loss = np.where(labels == 1, -np.log(-np.expm1(-harmless)), harmless).mean()
        slope = np.where(labels == 1, -1 / np.expm1(np.minimum(harmless, 500)), 1.0) / n
        slope = slope[self.document_of_sentence] / (1 + np.exp(-np.clip(z, -500, 500)))
        by_word = np.bincount(self.words, weights=slope[self.sentence_of_word], minlength=self.n_words)
        return loss, np.bincount(self.gram_of, weights=by_word[self.word_of], minlength=len(weights)), float(slope.sum())


def fitted(bags: Bags, labels: np.ndarray, charge: float, steps: int, x: np.ndarray) -> np.ndarray:
    """Weights and, last, the bias (from START on) by accelerated proximal gradient: absolute
    weights are charged, the step is halved until it is safe, and the momentum is dropped when it
    points uphill."""
    y, t, rate = x.copy(), 1.0, 64.0

    def at(v: np.ndarray) -> tuple[float, np.ndarray]:
        loss, g, g_bias = bags.gradient(v[:-1], START + BIAS_SCALE * v[-1], labels)
        return loss, np.append(g, BIAS_SCALE * g_bias)

    for _ in range(steps):
        loss, g = at(y)
        while True:
            new = y - rate * g
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * charge, 0)
            move = new - y
            if rate < 1e-6 or at(new)[0] <= loss + g @ move + move @ move / (2 * rate) + 1e-12:
                break
            rate /= 2
        following = (1 + (1 + 4 * t * t) ** 0.5) / 2
        if (y - new) @ (new - x) > 0:
            following = 1.0
        y = new + (t - 1) / following * (new - x) if following > 1 else new
        x, t = new, following
        rate *= 1.1
    return x


def train(texts: list[str], labels: np.ndarray) -> Model:
    """First an n-gram has to explain more than ``SELECT`` documents that the others leave open to
    get a weight at all; then the selected ones are fitted anew at the lower charge ``LASSO``."""
    if len(set(labels.tolist())) < 2:
        return Model({}, START)
    bags = Bags(texts)
    x = fitted(bags, labels, SELECT / len(labels), SELECT_STEPS, np.zeros(len(bags.grams) + 1))
    bags.restrict(x[:-1] != 0)
    x = fitted(bags, labels, LASSO / len(labels), STEPS, np.append(x[:-1][x[:-1] != 0], x[-1]))
    return Model({g: float(w) for g, w in zip(bags.grams, x) if w}, float(START + BIAS_SCALE * x[-1]))


# ---------------------------------------------------------------- Spark


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def training_texts(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Whole texts and labels of the bounded sample."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    one = usable.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    picks = []
    for label in (0, 1):
        chosen = one.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE[label])
        picks += [(r["doc_id"], label) for r in chosen.select("doc_id").collect()]
    wanted = dict(picks)
    if not wanted:
        return [], np.empty(0, np.int64)
    # so many ids at most, so the texts are filtered in the scan
    found = docs.select("doc_id", "text").where(F.col("doc_id").isin(list(wanted)) & F.col("text").isNotNull())
    found = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], np.array([wanted[r["doc_id"]] for r in rows], np.int64)


def shared(docs: DataFrame, model: Model):
    return docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``."""
    held = shared(docs, model)

    def make():
        mine = Model(*held.value)

        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            return {"score": pa.array([mine.score((b or b"").decode()) for b in byte_values(batch.column(text))], pa.float64())}

        return step

    scored = map_rows(docs, make, [T.StructField("score", T.DoubleType())], by=text)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def offending(docs: DataFrame, model: Model, least: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start, end, score, sentence): the sentences, by code points, of a probability of at
    least ``least``."""
    held = shared(docs, model)
    names = ["doc_id", "start", "end", "score", "sentence"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model(*held.value)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for i, b in zip(part.column("doc_id").to_pylist(), byte_values(part.column("text")), strict=True):
                    whole = (b or b"").decode()
                    for start, end, words in sentences(whole):
                        p = float(1 / (1 + np.exp(-mine.logit(words))))
                        if p >= least:
                            rows.append((i, start, end, p, whole[start:end]))
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(given, run, "doc_id long, start long, end long, score double, sentence string")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(*training_texts(docs, labels))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", "predicted")


ship_by_value(__name__)
