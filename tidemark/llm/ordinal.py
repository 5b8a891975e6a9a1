"""Quality classifier: ordinal cumulative-link regression on hashed text.

Grades are ordered. One weight per hashed word gives a score s, and ordered
thresholds t_1 < t_2 < ... cut it: P(grade <= j) = sigmoid(t_j - s). All grades
share the weights. The result per document is the expected grade and the
probability of the highest grade, by which it is kept or not.

The model is fitted on a bounded sample of labelled documents (``PER_GRADE`` of
each grade, chosen by a hash), on the driver; every document is scored, whole, in
its own row. A null text has no words. Null grades are not used; a grade without
labelled documents leaves the model as its starting point, with all scores zero.
Repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 18
PER_GRADE = 2000  # bound of the labelled sample, per grade
MIN_DOCS = 4  # a bucket must occur in so many sampled documents to get a weight
L2 = 1e-3
STEPS = 300
KEEP_FROM = 0.45  # least probability of the top grade: between clean and toxic held-out documents
STEMS = (5, 7)  # beginnings of words that are features too, for inflected and compound words

SYMBOL = re.compile(r"[#*$%&|<>!]")


def features(text: str | None) -> set[int]:
    """Hashed distinct words, lower-cased without outer punctuation, and a few coarse traits."""
    text = text or ""
    words = text.lower().split()
    bare = {w.strip(".,;:!?\"'()") for w in set(words)}
    stems = {f"\1{w[:n]}" for n in STEMS for w in bare if len(w) > n}
    found = {zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS for w in bare | stems}
    n = max(1, len(words))
    traits = (
        ("words", n.bit_length()),
        ("symbols", min(9, 20 * len(SYMBOL.findall(text)) // n)),
        ("distinct", 10 * len(set(words)) // n),
        ("length", min(20, len(text) // n)),
        ("capitals", 10 * sum(map(str.isupper, text)) // max(1, len(text))),
    )
    return found | {zlib.crc32(f"\0{name}\0{value}".encode()) % BUCKETS for name, value in traits}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..., one column each."""
        return 1 - sigmoid(self.thresholds[None, :] - scores[:, None])


def fit(documents: list[np.ndarray], grades: np.ndarray, n_grades: int, totals: np.ndarray | None = None) -> Model:
    """Maximum likelihood with a ridge, by Adam over all documents at once.

    ``totals`` counts all rated documents by grade; a sampled one stands for its
    share of them.
    """
    weights = np.zeros(BUCKETS)
    gaps = np.zeros(n_grades - 1)
    thresholds = lambda g: np.concatenate([[g[0]], g[0] + np.cumsum(np.exp(g[1:]))])
    gaps[0] = -(n_grades - 2) / 2
    if len(set(grades.tolist())) < n_grades:
        return Model(weights, thresholds(gaps))
    flat = np.concatenate(documents).astype(np.int32)
    doc = np.repeat(np.arange(len(documents), dtype=np.int32), [len(d) for d in documents])
    often = np.bincount(flat, minlength=BUCKETS) >= MIN_DOCS
    doc, flat = doc[often[flat]], flat[often[flat]]
    scale = 1 / np.sqrt(max(1, len(doc)) / len(documents))
    used = np.flatnonzero(often)
    where = np.zeros(BUCKETS, np.int32)
    where[used] = np.arange(len(used))
    place = where[flat]
    w, n = np.zeros(len(used)), len(documents)
    m = [np.zeros(len(used)), np.zeros(n_grades - 1)]
    v = [np.zeros(len(used)), np.zeros(n_grades - 1)]
    lower = np.arange(n_grades - 1)
    sampled = np.bincount(grades, minlength=n_grades)
    share = ((sampled if totals is None else totals) / sampled)[grades]
    share /= share.sum()
    for step in range(1, STEPS + 1):
        s = np.bincount(doc, w[place], minlength=n)
        t = thresholds(gaps)
        below = np.concatenate([np.zeros((n, 1)), sigmoid(t[None, :] - s[:, None]), np.ones((n, 1))], axis=1)
        slope = below * (1 - below)
        rows = np.arange(n)
        p = np.maximum(below[rows, grades + 1] - below[rows, grades], 1e-12)
        ds = (slope[rows, grades + 1] - slope[rows, grades]) / p * share  # of the loss, by score
        dt = np.array([((grades == j + 1) * slope[rows, j + 1] - (grades == j) * slope[rows, j + 1])@ (share / p) for j in lower])
        dg = np.concatenate([[dt.sum()], np.exp(gaps[1:]) * np.cumsum(dt[::-1])[::-1][1:]])
        dw = np.bincount(place, ds[doc], minlength=len(used)) + L2 * w
        for i, (value, grad, rate) in enumerate(((w, dw, 0.3 * scale), (gaps, dg, 0.05))):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.99 * v[i] + 0.01 * grad * grad
            value -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-9)
    weights[used] = w
    return Model(weights, thresholds(gaps))


def train(docs: DataFrame, grades: DataFrame, n_grades: int, id_col: str = "doc_id", text_col: str = "text", per_grade: int = PER_GRADE) -> Model:
    """A model from ``grades`` (id, grade from 0 to n_grades - 1) and the documents they rate."""
    # One count per grade.
    counts = dict(grades.where(F.col("grade").between(0, n_grades - 1)).groupBy("grade").count().collect())
    totals = np.array([counts.get(g, 0) for g in range(n_grades)], float)
    order = Window.partitionBy("grade").orderBy(F.xxhash64("id"), "id")
    rated = grades.where(F.col("grade").between(0, n_grades - 1) & F.col("id").isNotNull()).groupBy("id").agg(F.min("grade").alias("grade"))
    chosen = rated.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_grade).select("id", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.array([sorted(features(t)) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["grade", "features"])

    # At most n_grades * per_grade rows are sent to the tasks.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Of several texts under one id, the one with the smallest hash, so that the model does not depend on the partitioning.
    rated = texts.join(F.broadcast(chosen), "id").groupBy("id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = rated.orderBy("grade", "id").select("grade", "text")
    rows = sample.mapInArrow(run, "grade int, features array<int>").toArrow().combine_chunks()
    lists = rows.column("features").combine_chunks()
    ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
    return fit(np.split(lists.flatten().to_numpy(), ends[:-1]) if len(lists) else [], rows.column("grade").to_numpy().astype(np.int64), n_grades, totals)


def score(docs: DataFrame, model: Model, keep_from: float = KEEP_FROM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, expected_grade, p_top (probability of the highest grade) and kept (p_top >= keep_from)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = model.weights
        for batch in batches:
            scores = np.array([weights[list(features(t))].sum() for t in batch.column(1).to_pylist()])
            tails = model.tails(scores)
            top = tails[:, -1]
            arrays = [batch.column(0), *map(pa.array, (scores, tails.sum(axis=1), top, top >= keep_from))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "score", "expected_grade", "p_top", "kept"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, score double, expected_grade double, p_top double, kept boolean")
    return out.withColumnRenamed("id", id_col)


def grades_of(labels: DataFrame) -> DataFrame:
    """Ratings of the label table as grades: 0 toxic, 1 poor, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select(F.col("doc_id").alias("id"), grade.alias("grade"))
