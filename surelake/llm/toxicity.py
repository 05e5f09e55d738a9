"""Toxicity by averaged subword embeddings and a linear softmax, trained together in numpy.

A word's vector is the mean of the vectors of its hashed character n-grams, a window's vector the mean of
its words, and a linear softmax over the two classes scores the window. A document is as toxic as its
worst window, of all that begin at any word; in training the windows of a document are pooled smoothly, so that a few words
are found in a long text with only the document's label known. Misspelt words share most n-grams with known ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surelake.llm.common import WordTable, offsets_of, small_batches
from surelake.llm.quality import labelled_ids, labelled_texts, with_scores

BUCKETS = 1 << 16
WINDOW = 3
#: Marks part words; a word has at least one letter.
WORD = re.compile(r"[^\s.,;:!?()\[\]{}\"|]*[^\W\d_][^\s.,;:!?()\[\]{}\"|]*")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def gram_ids(words: list[str], low: int = 3, high: int = 6, chunk: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(number of n-grams, bucket of each) per word marked with < and >, a chunk of the words at a time."""
    parts = [_gram_ids(words[at : at + chunk], low, high) for at in range(0, len(words), chunk)] or [(np.zeros(0, np.int64), np.zeros(0, np.uint16))]
    return np.concatenate([n for n, _ in parts]), np.concatenate([g for _, g in parts])


def _gram_ids(words: list[str], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    marked = "".join([f"<{w}>" for w in words])
    data = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(length), length)
    owner = np.repeat(np.arange(len(words)), length)
    rolled, found, word_of = np.zeros(len(data), np.uint64), [], []
    for n in range(1, high + 1):
        if len(data) < n:
            break
        rolled = rolled[: len(data) - n + 1] * np.uint64(0x100000001B3) + data[n - 1 :] + np.uint64(n)
        if n >= low:
            inside = np.arange(len(rolled)) + n <= ends[: len(rolled)]
            found.append(((rolled[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16))
            word_of.append(owner[: len(rolled)][inside])
    word_of = np.concatenate(word_of)
    order = np.argsort(word_of, kind="stable")
    return np.bincount(word_of, minlength=len(words)), np.concatenate(found)[order]


def window_sums(values: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of every ``WINDOW`` neighbouring values of each text, windows per text); a shorter text is one window, one without words has none."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    per = np.where(length > 0, np.maximum(length - WINDOW + 1, 1), 0)
    start = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + np.repeat(np.cumsum(length) - length, per)
    return sums[start + np.repeat(np.minimum(length, WINDOW), per)] - sums[start], per


class Batch:
    """Some documents as numbers: the words they hold, and the learned n-grams of these words."""

    def __init__(self, words: list[np.ndarray], y: np.ndarray, weight: np.ndarray, grams: np.ndarray, firsts: np.ndarray, size: np.ndarray):
        self.y, self.weight = y, weight
        self.length = np.array([len(w) for w in words])
        known, self.words = np.unique(np.concatenate(words), return_inverse=True)
        many = np.diff(firsts)[known]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(firsts[known], many)
        self.gram, self.word_of, self.size = grams[at], np.repeat(np.arange(len(known), dtype=np.int32), many), size[known]

    def loss(self, e: np.ndarray, out: np.ndarray, bias: np.ndarray, mean: bool) -> tuple[float, list[np.ndarray]]:
        """(weighted loss, gradients). Windows and words are means and the softmax is linear, so each n-gram counts with one number:
        its part in the difference of the two classes. ``mean`` pools windows by their mean instead of their sum."""
        side = (out[1] - out[0]).astype(np.float64)
        worth = side @ e
        word = np.bincount(self.word_of, worth[self.gram], len(self.size)) / self.size
        z, per = window_sums(word[self.words], self.length)
        z = z / WINDOW + float(bias[1] - bias[0])
        first = np.cumsum(per) - per
        top = np.maximum.reduceat(z, first)
        soft = np.exp(z - np.repeat(top, per))
        total = np.add.reduceat(soft, first)
        pooled = np.clip(top + np.log(total / per if mean else total), -30, 30)
        loss = float((self.weight * (np.logaddexp(0, pooled) - self.y * pooled)).sum())
        dz = np.repeat((1 / (1 + np.exp(-pooled)) - self.y) * self.weight / total, per) * soft
        # a word takes part in the windows that begin at most WINDOW - 1 before it
        steps = np.zeros(len(self.words) + 1)
        start = np.arange(len(dz)) - np.repeat(first, per) + np.repeat(np.cumsum(self.length) - self.length, per)
        steps[:-1] += np.bincount(start, dz, len(self.words))
        steps -= np.bincount(start + np.repeat(np.minimum(self.length, WINDOW), per), dz, len(self.words) + 1)
        dword = np.bincount(self.words, np.cumsum(steps[:-1]) / WINDOW, len(self.size)) / self.size
        dgram = np.bincount(self.gram, dword[self.word_of], e.shape[1])
        dside = e @ dgram
        return loss, [np.outer(side, dgram).astype(np.float32), np.stack([-dside, dside]).astype(np.float32), np.array([-dz.sum(), dz.sum()], np.float32)]


class Model:
    def __init__(self, dims: int = 6, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.grams = (rng.standard_normal((dims, BUCKETS)) / dims).astype(np.float32)
        self.out = (rng.standard_normal((2, dims)) / dims).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.shift = 0.0

    def fit(self, texts: list[str], labels: np.ndarray, rounds: int = 24, rate: float = 0.05, batch_docs: int = 400, least_docs: int = 3) -> None:
        """Adam over all given documents, ``batch_docs`` at a time, both classes in each batch by their share. The loss is that of each document's
        smoothly pooled windows; n-grams whose words occur in fewer than ``least_docs`` documents are not learned."""
        index: dict[str, int] = {}
        docs = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int32) for t in texts]
        usable = np.array([n for n, d in enumerate(docs) if len(d)], np.int64)
        if len(set(labels[usable])) < 2:
            share = float(np.mean(labels)) if len(labels) else 0.0
            self.grams[:], self.out[:], self.shift = 0, 0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
            return
        size, grams = gram_ids(list(index))
        firsts = offsets_of(size)
        word_of = np.repeat(np.arange(len(size), dtype=np.int32), size)
        del index
        # in how many documents the words of an n-gram occur
        seen = np.bincount(np.concatenate([np.unique(docs[n]) for n in usable]), minlength=len(size))
        known = np.bincount(grams, seen[word_of], BUCKETS)[grams] >= min(least_docs, max(1, len(usable) // 20))
        firsts = np.concatenate([[0], np.cumsum(known)])[firsts]
        bucket, grams = np.unique(grams[known], return_inverse=True)
        rng = np.random.default_rng(7)
        toxic, clean = (rng.permutation(usable[labels[usable] == k]) for k in (1, 0))
        n = max(1, min(len(usable) // batch_docs, len(toxic), len(clean)))
        batches = []
        for k in range(n):
            own = np.concatenate([toxic[k::n], clean[k::n]])
            y = labels[own].astype(np.float64)
            batches.append(Batch([docs[d] for d in own], y, np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)), grams, firsts, size))
        del docs, word_of, known
        params = [self.grams[:, bucket], self.out, self.bias]
        moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        step, warm = 0, max(2, rounds // 8)
        for turn in range(rounds):
            for batch in batches:
                step += 1
                _, grads = batch.loss(*params, turn < warm)
                grads[0] += 2e-6 * params[0]
                grads[1] += 1e-4 * params[1]
                for p_, g, (m, v) in zip(params, grads, moment):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p_ -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.grams[:] = 0  # what was not learned says nothing
        self.grams[:, bucket], self.out, self.bias = params

    def calibrate(self, z: np.ndarray, labels: np.ndarray) -> None:
        """Shift of the logit at which 0.5 parts other labelled documents best, a wrongly rejected share weighing as much as eight missed ones."""
        if len(set(labels.tolist())) < 2 or not self.out.any():
            return
        order = np.argsort(z)
        z, y = z[order], labels[order]
        missed = np.append(0, np.cumsum(y == 1)) / max((y == 1).sum(), 1)
        wrong = ((y == 0).sum() - np.append(0, np.cumsum(y == 0))) / max((y == 0).sum(), 1)
        cost = missed + 8 * wrong
        best = np.flatnonzero(cost <= cost.min() + 1e-12)
        edges = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
        self.shift = -float(np.mean([edges[best], edges[best + 1]]))

    def _word_vectors(self, words: list[str]):
        """Logit of each word: windows average words, so the linear layer may be applied to words first."""
        size, grams = gram_ids(words)
        side = (self.out[1] - self.out[0]) @ self.grams
        return np.ones(len(words), np.int64), np.bincount(np.repeat(np.arange(len(words)), size), side[grams], len(words)) / size

    def word_table(self) -> WordTable:
        return WordTable(self._word_vectors, np.float32, limit=200_000, most_chars=8_000_000)

    def logits(self, texts: list[str | None], known: WordTable) -> np.ndarray:
        split = [words_of(t) for t in texts]
        length = np.fromiter(map(len, split), np.int64, len(split))
        picked = known.slots([w for s in split for w in s])
        value = known.flat[picked].astype(np.float64)
        z, per = window_sums(value, length)
        out = np.full(len(texts), -20.0)
        if len(z):
            some = per > 0
            out[some] = np.maximum.reduceat(z, (np.cumsum(per) - per)[some]) / WINDOW + float(self.bias[1] - self.bias[0])
        return out

    def score(self, texts: list[str | None], known: WordTable | None = None) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts, known or self.word_table()) + self.shift, -40, 40)))

    def scorer(self):
        """A scoring function with a memory of words of its own."""
        known = self.word_table()
        return lambda texts: self.score(texts, known)


def train(docs: DataFrame, labels: DataFrame, clean: int = 2600, toxic: int = 800, most_chars: int = 20_000, judge_clean: int = 4000, judge_toxic: int = 1000) -> Model:
    """The model of at most ``clean`` and ``toxic`` labelled documents, all of them fitted, whole texts of at most ``most_chars`` characters: that
    bounds what the driver holds. The threshold is set on at most ``judge_clean`` and ``judge_toxic`` others, a fifth of the labelled ones, of any length;
    tasks score them and the driver gets their logits only. Scores of documents have no such bounds."""
    spark = docs.sparkSession
    known = labels.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(5)))
    short = docs.where(F.char_length("text") <= most_chars)
    picked = labelled_texts(short, labelled_ids(known.where("part > 0").drop("part"), "toxic", (clean, toxic), short))
    rows = picked.toPandas().sort_values(["doc_id", "label", "text"])
    model = Model()
    model.fit(list(rows.text), rows.label.to_numpy())
    del rows
    sent = spark.sparkContext.broadcast(model)
    others = labelled_texts(docs, labelled_ids(known.where("part = 0").drop("part"), "toxic", (judge_clean, judge_toxic), docs)).select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.word_table()
        for batch in small_batches(batches, "text", 3 << 20):
            z = sent.value.logits(batch.column("text").to_pylist(), table)
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.float64()), batch.column("label").cast(pa.int32())], ["z", "label"])

    judged = others.mapInArrow(run, "z double, label int").toPandas()
    model.calibrate(judged.z.to_numpy(), judged.label.to_numpy())
    return model


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with held_out, score (0 to 1) and predicted.

    A text without words (null, empty, white space, marks) scores as not toxic. Equal texts get equal scores; texts of any length are scored whole.
    Without labels of both classes the score is the same for all texts with words. An empty table gives
    no rows. Columns of these three names in ``docs`` are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text"), labels))
    return with_scores(docs, lambda: model.value.scorer(), threshold, doc_id, text)
