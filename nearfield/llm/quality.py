"""Quality by compression: text is good if a dictionary of good text shortens it more than one of bad text.

Two zstandard dictionaries are built from labelled text. A text is cut into blocks, each block is
compressed with either dictionary, and the difference of the total sizes divided by the text's bytes is
the evidence; a logistic curve over it and over the share of bytes that stays (which is small where text
repeats itself) gives the score. The curve is fitted on labelled texts that no dictionary has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import fold, fresh, texts_of, without
from nearfield.scratch import stored

#: A text counts as good from this score on.
ACCEPT = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and the curve; ``good`` is empty if there was nothing to learn from."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    level: int = 3
    block: int = 256


class _Compressors:
    def __init__(self, model: QualityModel):
        import zstandard

        def one(raw: bytes):
            dictionary = zstandard.ZstdCompressionDict(raw)
            dictionary.precompute_compress(level=model.level)
            return zstandard.ZstdCompressor(
                level=model.level, dict_data=dictionary, write_content_size=False, write_dict_id=False
            )

        self.good, self.bad, self.block = one(model.good).compress, one(model.bad).compress, model.block

    def evidence(self, raw: bytes) -> tuple[float, float]:
        """(Bad size - good size) / bytes, and the smaller size / bytes; zeros for the empty text."""
        if not raw:
            return 0.0, 0.0
        good = bad = 0
        for at in range(0, len(raw), self.block):
            part = raw[at : at + self.block]
            good += len(self.good(part))
            bad += len(self.bad(part))
        return (bad - good) / len(raw), min(good, bad) / len(raw)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, max_bytes: int) -> list[tuple[int, str]]:
    """At most ``per_class`` whole texts of each label, of at most ``max_bytes`` a label in all.

    They are those of the smallest hashes of doc_id; a text that alone exceeds ``max_bytes`` is passed over,
    so that it doesn't leave its label without any. Documents with null or contradicting labels don't
    count; of several texts of one doc_id the smallest does.
    """
    clear = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_quality"), F.max("quality").alias("_most"))
        .where("_quality = _most")
        .select("doc_id", "_quality", F.xxhash64("doc_id").alias("_order"))
    )
    some = [clear.where(F.col("_quality") == q).orderBy("_order", "doc_id").limit(per_class) for q in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # at most 2 * per_class rows
    texts = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(chosen, "doc_id")
        .groupBy("doc_id", "_quality", "_order")
        .agg(F.min("text").alias("text"))
        .where(F.octet_length("text") <= max_bytes)
    )
    so_far = Window.partitionBy("_quality").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    bounded = texts.withColumn("_bytes", F.sum(F.octet_length("text")).over(so_far)).where(F.col("_bytes") <= max_bytes)
    return [(r["_quality"], r["text"]) for r in bounded.orderBy("_order", "doc_id").collect()]


def _dictionary(texts: list[bytes], size: int) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:  # too few or too short to train: the texts themselves
        return b"\n".join(texts)[-size:]


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Logistic regression on two columns by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 3000,
    max_bytes: int = 24 << 20,
    dictionary_bytes: int = 64 << 10,
) -> QualityModel:
    """Fits on a bounded sample of labelled documents (see ``labelled_sample``).

    Two thirds of the sample make the dictionaries, one third the curve. Without texts of both labels the
    model scores everything 0.5.
    """
    sample = labelled_sample(docs, labels, per_class, max_bytes)
    by_class = {q: [t.encode() for label, t in sample if label == q and t] for q in (0, 1)}
    if min(map(len, by_class.values())) < 3:
        return QualityModel(b"", b"", (0.0, 0.0, 0.0))
    own = {q: [t for k, t in enumerate(ts) if k % 3] for q, ts in by_class.items()}
    model = QualityModel(_dictionary(own[1], dictionary_bytes), _dictionary(own[0], dictionary_bytes), (0.0, 0.0, 0.0))
    evidence = _Compressors(model).evidence
    rest = [(evidence(t), q) for q, ts in by_class.items() for t in ts[::3]]
    weights = _curve(np.array([e for e, _ in rest]), np.array([q for _, q in rest], float))
    return QualityModel(model.good, model.bad, weights)


def score(docs: DataFrame, model: QualityModel, text: str = "text", name: str = "score") -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``name``: the quality of each whole text (null: empty), 0 to 1.

    Each row is scored by itself; the empty text gets the score of no evidence.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size
    at = docs.columns.index(text)
    kept = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        evidence = _Compressors(model).evidence if model.good else lambda raw: (0.0, 0.0)
        bias, by_difference, by_share = model.weights
        for batch in batches:
            raw = texts_of(batch.column(at)).cast(pa.large_binary())
            found = np.array([evidence(t.as_py()) for t in raw]).reshape(-1, 2)
            logit = bias + by_difference * found[:, 0] + by_share * found[:, 1]
            scores = pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            columns = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.RecordBatch.from_arrays([*columns, scores], [*(f.name for f in kept), name])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(name, T.DoubleType())]))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32(doc_id) modulo 5 is not 0."""
    return labels.where(fold("doc_id", 5) != 0)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; repeated rows are scored alike."""
    model = fit(docs, training_labels(labels))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``ACCEPT``."""
    model, name = fit(docs, training_labels(labels)), fresh(docs, "text_hash")
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    scored = score(docs.select("doc_id", "text", text_hash.alias("text_hash")), model)
    # texts don't come back from Python: only the few rejected rows are joined with their documents
    rejected = stored(scored.where(F.col("score") < ACCEPT).select("doc_id", "text_hash"), "rejected")
    return without(docs.withColumn(name, text_hash), rejected, {"doc_id": "doc_id", name: "text_hash"}).drop(name)
