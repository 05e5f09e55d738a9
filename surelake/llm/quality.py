"""Quality scores by votes of the nearest labelled documents in a latent-semantic space.

A text becomes counts of its byte pairs (letters, case, punctuation and script alike), damped and
weighted by rarity. A truncated singular value decomposition of labelled texts gives a small space;
the labelled vectors are broadcast, and every document takes its exact cosine with all of them in
blocks. The nearest vote with their labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from surelake.llm.common import held_out, small_batches

PAIRS = 4096
WIDTH = PAIRS + 2
PAIR = ((np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int64)


def repeats(items: list[str]) -> float:
    """Share of the items that equal the one before them."""
    return sum(map(eq, items, items[1:])) / (len(items) - 1) if len(items) > 1 else 0.0


def pair_counts(texts: list[str | None]) -> np.ndarray:
    """Share of each hashed byte pair in each text and of words and lines that repeat the last one, by
    square root; zero for texts of under two bytes."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for n, text in enumerate(texts):
        data = np.frombuffer((text or "").encode(), np.uint8)
        if len(data) > 1:
            pair = data[:-1].astype(np.uint16) << 8
            pair |= data[1:]
            out[n, :PAIRS] = np.bincount(PAIR[pair], minlength=PAIRS) / (len(data) - 1)
            out[n, PAIRS:] = repeats(text.split()), repeats(text.split("\n"))
    return np.sqrt(out, out=out)


class Votes:
    """Latent space and labelled vectors. Without labelled rows every score is one half."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float, dims: int = 64, neighbours: int = 24):
        self.prior, self.neighbours = prior, neighbours
        self.labels = labels.astype(np.float32)
        if not len(labels):
            return
        seen = (counts > 0).sum(axis=0)
        self.weight = np.log((1 + len(counts)) / (1 + seen)).astype(np.float32) + 1
        x = counts  # in place: the matrix is the largest thing the driver holds
        x *= self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        # randomised range finder with two power steps
        basis = np.random.default_rng(1).standard_normal((WIDTH, dims + 16)).astype(np.float32)
        for _ in range(3):
            basis, _ = np.linalg.qr(x.T @ (x @ basis))
        _, _, rows = np.linalg.svd(x @ basis, full_matrices=False)
        self.space = (basis @ rows.T[:, :dims]).astype(np.float32)
        self.vectors = self._unit(x @ self.space)

    def _placed(self, counts: np.ndarray) -> np.ndarray:
        return self._unit((counts * self.weight) @ self.space)

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray, block: int = 512) -> np.ndarray:
        out = np.full(len(counts), self.prior, np.float64)
        if not len(self.labels):
            return out
        k = min(self.neighbours, len(self.labels))
        for at in range(0, len(counts), block):
            v = self._placed(counts[at : at + block])
            cosine = v @ self.vectors.T
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            by = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 8
            total = by.sum(axis=1)
            vote = (by * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-30)
            out[at : at + block] = np.where(total > 0, np.clip(vote, 0, 1), self.prior)
        return out


def labelled_ids(labels: DataFrame, column: str, per_class: tuple[int, int], docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, label): up to so many rows of class 0 and of class 1 outside the held-out fold, by the hash of their id; only ids of ``docs``."""
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(column).alias("label"))
    if docs is not None:
        known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class[c]) for c in (0, 1)]
    return picked[0].unionByName(picked[1])


def labelled_texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """(doc_id, label, text) of picked ids, one text each: that of smallest hash where an id has several."""
    both = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # as many rows as were picked
    return both.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("s")).select("doc_id", "label", "s.text")


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> Votes:
    """The model of at most ``per_class`` labelled documents of each class, that is what the driver holds at most."""
    picked = labelled_texts(docs, labelled_ids(labels, "quality", (per_class, per_class), docs))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            counts = pair_counts(batch.column("text").to_pylist()).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label").cast(pa.int32()), pa.array([c.tobytes() for c in counts], pa.binary())], ["doc_id", "label", "counts"])

    rows = picked.mapInArrow(run, f"doc_id {kind}, label int, counts binary").toPandas().sort_values(["doc_id", "label", "counts"])
    known_labels = rows.label.to_numpy()
    counts = np.zeros((len(rows), WIDTH), np.float32)
    for n, raw in enumerate(rows.pop("counts")):
        counts[n] = np.frombuffer(raw, np.float16)
    del rows
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out()).agg(F.avg("quality")).first()[0]
    return Votes(counts, known_labels, 0.5 if known is None else float(known))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with held_out, score (0 to 1) and predicted.

    A null or empty text, or one byte, has no vector and gets the share of good labels as its score. Equal
    texts get equal scores. Without labels every score is one half. An empty table gives no rows. Columns
    of these three names in ``docs`` are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text"), labels))
    return with_scores(docs, lambda: lambda texts: model.value.score(pair_counts(texts)), threshold, doc_id, text)


def with_scores(docs: DataFrame, scorer, threshold: float, doc_id: str, text: str) -> DataFrame:
    """Rows with held_out, score and predicted. Each task calls ``scorer`` once for a function of texts, which it
    gives small batches; what that function remembers goes with the task."""
    given = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer()
        for batch in small_batches(batches, text, 3 << 20):
            got = pa.array(np.asarray(scores(batch.column(text).to_pylist()), np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, got], [*batch.schema.names, "score"])

    scored = given.mapInArrow(run, StructType([*given.schema.fields, StructField("score", DoubleType())]))
    return scored.select(*[F.col(f"`{c}`") for c in given.columns], held_out(doc_id).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
