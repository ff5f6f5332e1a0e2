"""Toxicity by cumulative-link ordinal regression (operator 5).

P(grade > k) = sigmoid(w . x - t_k) with one weight vector for all grades and
ordered thresholds t_0 < t_1 < ...; the expected severity is the sum of these
probabilities. x is sparse: hashed words and word beginnings of the whole text,
as 1 + log2 of their count.

The labels say toxic or not. Grade 0 is not toxic; toxic rows are graded 1 to 3
by the third of all toxic rows in which their number of telling words falls, so
that the ordered model has more than two grades to learn. All of it is learned
from at most FIT_ROWS labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.llm import textkit
from weftline.llm.common import fresh, id_bucket, materialize, read_table, release

#: Labelled rows in fitting, features kept, and bytes of the word beginnings used as features.
FIT_ROWS, FEATURES, BEGINNINGS = 20_000, 512, (4, 5, 6)
GRADES = 4
#: A feature must be in so many rows, and tell toxic rows apart with such a likelihood ratio statistic.
LEAST, TELLING = 5, 20.0
#: Documents whose probability of a grade above 0 is at least this are toxic.
REJECT = 0.5


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:, None] - self.thresholds, -50, 50)))


def feature_hashes(block: textkit.Block) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, rows) of all words and word beginnings of a block."""
    data = textkit.lower(block.data, latin=True)
    starts, ends, rows = textkit.words(data, block.offsets, textkit.NOT_LETTER)
    parts, owners = [textkit.span_hashes(data, starts, ends)], [rows]
    for n in BEGINNINGS:
        long = ends - starts > n
        parts.append(textkit.span_hashes(data, starts[long], starts[long] + n) ^ np.uint64(n))
        owners.append(rows[long])
    return np.concatenate(parts), np.concatenate(owners)


def _values(block: textkit.Block, features: np.ndarray) -> np.ndarray:
    """A row per text: 1 + log2(count) of each feature that it has."""
    hashes, rows = feature_hashes(block)
    at = np.searchsorted(features, hashes)
    at[at == len(features)] = 0
    hit = features[at] == hashes if len(features) else np.zeros(len(hashes), bool)
    counts = np.bincount(rows[hit] * len(features) + at[hit], minlength=block.n * len(features)).reshape(block.n, len(features))
    return np.where(counts > 0, 1 + np.log2(np.maximum(counts, 1)), 0.0)


def sample_of(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """(text, toxic) of at most `fit_rows` labelled rows that aren't held out, those with the smallest hash of the id; one for equal texts."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(id_bucket(4) != 2).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id", "toxic")), "doc_id")
    return materialize(rows.where("text IS NOT NULL").groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")), "toxic-fit")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on a bounded sample; without both labels in it, or without a feature that tells them apart, the model finds nothing toxic."""
    sample = sample_of(docs, labels, fit_rows)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for block in textkit.blocks(batch.column(0)):
                hashes, rows = feature_hashes(block)
                order = np.lexsort((hashes, rows))
                hashes, rows = hashes[order], rows[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
                hashes, y = hashes[new], toxic[block.first + rows[new]]
                u, at = np.unique(hashes, return_inverse=True)
                yield pa.RecordBatch.from_pydict({"f": u.view(np.int64), "n": np.bincount(at, minlength=len(u)), "toxic": np.bincount(at, weights=y, minlength=len(u)).astype(np.int64)})

    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, n_toxic = totals.n or 0, totals.toxic or 0
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), np.arange(1, GRADES) * 50.0)
    if not n_toxic or n_toxic == n:
        return nothing
    counts = sample.select("text", "toxic").mapInArrow(seen, "f long, n long, toxic long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    share, toxic, clean = n_toxic / n, F.col("toxic"), F.col("n") - F.col("toxic")
    gain = lambda seen, of, expected: F.when(seen > 0, seen * F.log(seen / (of * expected))).otherwise(0.0)
    without = (n - F.col("n"), n_toxic - toxic, n - n_toxic - clean)
    g = 2 * (gain(toxic, F.col("n"), share) + gain(clean, F.col("n"), 1 - share) + gain(without[1], without[0], share) + gain(without[2], without[0], 1 - share))
    odds = F.log((toxic + 0.5) / (n_toxic - toxic + 0.5)) - F.log((clean + 0.5) / (n - n_toxic - clean + 0.5))
    scored = counts.where(F.col("n") >= LEAST).withColumn("odds", odds).withColumn("g", g)
    chosen = scored.where(F.col("g") >= TELLING).orderBy(F.col("g").desc(), "f").limit(FEATURES).collect()
    if not chosen:
        return nothing
    features = np.sort(np.array([r.f for r in chosen], np.int64).view(np.uint64))
    telling = np.isin(features, np.array([r.f for r in chosen if r.odds > 3], np.int64).view(np.uint64))

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in textkit.blocks(batch.column(0)):
                x = _values(block, features).astype(np.float32)
                yield pa.RecordBatch.from_pydict({"x": [r.tobytes() for r in x], "toxic": batch.column(1).slice(block.first, block.n).cast(pa.int32())})

    rows = sample.select("text", "toxic").mapInArrow(dense, "x binary, toxic int").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(len(rows), len(features))
    toxic = rows["toxic"].to_numpy()
    strength = x[:, telling].sum(1)
    cuts = np.quantile(strength[toxic == 1], [1 / 3, 2 / 3])
    model = fit_ordinal(features, x, np.where(toxic == 1, 1 + np.searchsorted(cuts, strength, "right"), 0))
    del rows, x
    release()  # the driver goes on
    return model


def fit_ordinal(features: np.ndarray, x: np.ndarray, grade: np.ndarray, steps: int = 800, rate: float = 0.1, decay: float = 1e-5) -> Model:
    """Adam on the mean negative log-likelihood; thresholds are a first one and positive gaps, so they stay ordered."""
    n, d = x.shape
    k = np.arange(GRADES - 1)
    rows, cols = np.nonzero(x)
    held = x[rows, cols].astype(np.float64)
    theta = np.concatenate((np.zeros(d), [2.0], np.zeros(GRADES - 2)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, t = theta[:d], np.cumsum(np.concatenate((theta[d : d + 1], np.exp(theta[d + 1 :]))))
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, held * w[cols], n)[:, None] - t, -50, 50)))
        edges = np.concatenate((np.ones((n, 1)), p, np.zeros((n, 1))), axis=1)
        own = np.maximum(edges[np.arange(n), grade] - edges[np.arange(n), grade + 1], 1e-12)
        slope = p * (1 - p)
        # d(-log own)/d(score): the upper edge of the grade counts plus, the lower minus
        by_edge = np.where(k + 1 == grade[:, None], -slope, 0) + np.where(k == grade[:, None], slope, 0)
        by_edge /= own[:, None] * n
        g_t = -by_edge.sum(0)
        gaps = np.exp(theta[d + 1 :])
        g = np.concatenate((np.bincount(cols, held * by_edge.sum(1)[rows], d) + decay * w, [g_t.sum()], gaps * np.cumsum(g_t[::-1])[::-1][1:]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(features, theta[:d], np.cumsum(np.concatenate((theta[d : d + 1], np.exp(theta[d + 1 :])))))


def score(docs: DataFrame, model: Model, names: Sequence[str] = ("expected_severity", "p_toxic", "grade")) -> DataFrame:
    """`docs` with expected_severity (0 to 3), p_toxic and grade (the likeliest) added, or under other names.

    Null and empty texts have no features; their severity is the model's prior.
    Other columns are passed on; a column of `docs` with one of the three names
    is replaced.
    """
    docs = docs.drop(*names)
    out_schema = StructType(docs.schema.fields[:]).add(names[0], "double").add(names[1], "double").add(names[2], "integer")
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in textkit.blocks(batch.column(where)):
                p = model.above(_values(block, model.features))
                edges = np.concatenate((np.ones((block.n, 1)), p, np.zeros((block.n, 1))), axis=1)
                grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).astype(np.int32)
                rows = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(grade)], names=[*rows.schema.names, *names])

    return docs.mapInArrow(run, out_schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of `docs` whose probability of any toxicity is under `reject`, with all their columns.

    Rows without text have the model's prior; where no feature tells toxic rows apart,
    all rows stay. Repeated rows are decided each; an empty table stays empty.
    """
    names = fresh(docs.columns, "expected_severity", "p_toxic", "grade")
    return score(docs, fit(docs, labels, fit_rows), names).where(F.col(names[1]) < reject).drop(*names)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out rows (as in op6_quality) teach nothing. The labels are binary: p_toxic and toxic rest on them, while
    grades above 0 and what they add to expected_severity are cut from the text's own telling words."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    held = (id_bucket(4) == 2).alias("held_out")
    return out.select("doc_id", held, "expected_severity", "p_toxic", "grade", (F.col("p_toxic") >= REJECT).alias("toxic"))
