"""Language ID: sparse multinomial logistic regression on TF-IDF character
n-grams, trained by follow-the-regularised-leader (per-coordinate, L1 and L2
penalties), then temperature calibration.

Document frequencies are counted over all training documents. The regression
itself is fitted on a sample of at most about ``SAMPLE`` training documents
(a documented parameter), taken by a hash of the identifier and balanced over
the labels; a fifth of the sample calibrates the temperature. Prediction reads
whole texts, and only the text.

Defined results: a null text, or one without a letter, is ``und`` with score
0. With no labelled training document everything is ``und``. A tie goes to the
first label in code-point order. Rows with a null label, text or identifier
are not learned from. Each input row gives one output row, so repeated rows
give equal rows; empty tables give empty tables; extra columns stay in ``row``
and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.llm.arrow import slices

DIMENSIONS = 1 << 13     # hashed n-gram features
ORDERS = (1, 2, 3)       # characters of an n-gram
BLOCK = 1 << 20          # code points hashed at a time
SAMPLE = 3000            # bound of the sample that the regression is fitted on
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
SEED = "language-id"
UNKNOWN = "und"


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray           # DIMENSIONS
    weights: np.ndarray       # DIMENSIONS x labels
    bias: np.ndarray
    temperature: float = 1.0


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character n-grams of the whole lower-cased text."""
    counts = np.zeros(DIMENSIONS, np.int64)
    text, extra = text.lower(), max(ORDERS) - 1
    for lo in range(0, len(text), BLOCK):
        # Blocks overlap by the longest n-gram less one; an n-gram belongs to the block it starts in.
        part = text[lo: lo + BLOCK + extra]
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        own = min(BLOCK, len(text) - lo)
        for n in ORDERS:
            m = min(own, len(c) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h + c[k: k + m]) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((h >> np.uint64(40)).astype(np.int64) % DIMENSIONS, minlength=DIMENSIONS)
    return counts


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, L2-normalised log-tf x idf values)."""
    counts = ngram_counts(text)
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt((x * x).sum())
    return at, x / norm if norm else x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def is_training(id_col: str, modulus: int = 4, held_out: int = 2) -> Column:
    """crc32 of the identifier as text is not ``held_out`` modulo ``modulus``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus != held_out


def _frequencies(batches):
    """mapInArrow: document frequency of each feature in this task."""
    df, n = np.zeros(DIMENSIONS, np.int64), 0
    for b in slices(batches):
        for t in b.column("text").to_pylist():
            df += ngram_counts(t) > 0
            n += 1
    if n:
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())],
                                         names=["feature", "n"])


def _vectors(idf: np.ndarray):
    def run(batches):
        for b in slices(batches):
            x = [tf_idf(t, idf) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("h"), b.column("label"), pa.array([at.astype("<i4").tobytes() for at, _ in x], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in x], pa.binary())], names=["h", "label", "at", "x"])
    return run


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_labels: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal on (label number, features, values)."""
    z, g2 = np.zeros((DIMENSIONS + 1, n_labels)), np.zeros((DIMENSIONS + 1, n_labels))

    def weights(at):
        zi, ni = z[at], g2[at]
        shrunk = np.where(np.abs(zi) <= L1, 0.0, zi - np.sign(zi) * L1)
        return -shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    for _ in range(epochs):
        for y, at, x in rows:
            at, x = np.append(at, DIMENSIONS), np.append(x, 1.0)   # the last coordinate is the bias
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1.0
            g = np.outer(x, p)
            sigma = (np.sqrt(g2[at] + g * g) - np.sqrt(g2[at])) / ALPHA
            z[at] += g - sigma * w
            g2[at] += g * g
    w = weights(np.arange(DIMENSIONS + 1))
    return w[:-1], w[-1]


def calibrate(logits: list[np.ndarray], labels: list[int]) -> float:
    """Temperature of least log loss, by golden-section search on its logarithm."""
    if not logits:
        return 1.0

    def loss(log_t):
        t = np.exp(log_t)
        return -sum(np.log(max(softmax(z / t)[y], 1e-12)) for z, y in zip(logits, labels)) + 0.01 * log_t * log_t

    lo, hi, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        sample: int = SAMPLE) -> Model:
    """Learn from the training rows of ``docs`` (see ``is_training``)."""
    train = (docs.where(is_training(id_col) & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.xxhash64(F.lit(SEED), F.col(id_col).cast("string")).alias("h"),
                     F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text")))
    sizes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "label").limit(sample).collect()}
    labels = sorted(sizes)
    if not labels:
        return Model([], np.zeros(DIMENSIONS), np.zeros((DIMENSIONS, 0)), np.zeros(0))
    df = {r["feature"]: r["n"] for r in train.select("text").mapInArrow(_frequencies, "feature int, n long")
          .groupBy("feature").agg(F.sum("n").alias("n")).collect()}     # at most DIMENSIONS + 1 rows
    seen = np.zeros(DIMENSIONS)
    for k, v in df.items():
        if k >= 0:
            seen[k] = v
    idf = np.log((1.0 + df[-1]) / (1.0 + seen)) + 1.0
    each = max(1, sample // len(labels))
    rate = F.create_map(*[x for k in labels for x in (F.lit(k), F.lit(min(1.0, each / sizes[k])))])
    unit = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    rows = (train.where(unit < F.coalesce(rate[F.col("label")], F.lit(0.0)))
            .mapInArrow(_vectors(idf), "h long, label string, at binary, x binary")
            .limit(2 * sample).collect())
    rows = sorted(rows, key=lambda r: (r["h"], r["label"], bytes(r["at"]), bytes(r["x"])))
    data = [(labels.index(r["label"]), np.frombuffer(bytes(r["at"]), "<i4"), np.frombuffer(bytes(r["x"]), "<f4").astype(float)) for r in rows]
    held, used = data[::5], [d for i, d in enumerate(data) if i % 5]
    w, b = ftrl(used or data, len(labels))
    return Model(labels, idf, w, b, calibrate([x @ w[at] + b for _, at, x in held], [y for y, _, _ in held]))


def _predictor(model: Model):
    def run(batches):
        import regex

        letter = regex.compile(r"\p{L}")

        def label(text):
            if text is None or not model.labels or not letter.search(text):
                return UNKNOWN, 0.0
            at, x = tf_idf(text, model.idf)
            p = softmax((x @ model.weights[at] + model.bias) / model.temperature)
            k = int(p.argmax())
            return model.labels[k], float(p[k])

        for b in slices(batches):
            out = [label(t) for t in b.column("text").to_pylist()]
            keep = [i for i, f in enumerate(b.schema.names) if f != "text"]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in keep] + [pa.array([x for x, _ in out], pa.string()), pa.array([p for _, p in out], pa.float64())],
                names=[b.schema.names[i] for i in keep] + ["lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            carry_row: bool = False) -> DataFrame:
    """(``id_col``, held_out, lang_pred, score), with ``carry_row`` also
    ``row`` (the input row as a struct)."""
    extra = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry_row else []
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(~is_training(id_col), F.lit(False)).alias("held_out"),
                      *extra, F.col(text_col).cast("string").alias("text"))
    out = T.StructType([f for f in src.schema.fields if f.name != "text"]
                       + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return src.mapInArrow(_predictor(model), out).withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, least: float = 0.5, **columns) -> DataFrame:
    """``docs`` without the rows whose language is unknown or uncertain."""
    scored = predict(docs, fit(docs, **columns), carry_row=True)
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
