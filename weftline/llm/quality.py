"""Quality by histogram gradient-boosted trees over document statistics (operator 6).

Statistics of whole texts (lengths, cases, symbols, repetition of words and
lines, entropy) are cut into bins at quantiles; trees of a fixed depth are grown
level by level on histograms of gradients and flattened into arrays, so a batch
walks all trees with numpy index arithmetic. Fitted on at most FIT_ROWS labelled
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import textkit
from weftline.llm.common import id_bucket, read_table

FIT_ROWS, BINS, TREES, DEPTH, RATE, RIDGE = 30_000, 48, 80, 4, 0.15, 2.0
PREDICT = 0.7

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "longest_word", "upper", "digits", "punctuation", "exclaim", "pipe", "symbols", "not_ascii",
    "distinct_words", "top_word", "distinct_bigrams", "log_lines", "distinct_lines", "line_length", "short_lines", "entropy", "first_upper", "sentence_ends", "top_byte",
)
_CLASS = np.zeros((256, 6), bool)
for _c in range(256):
    _CLASS[_c] = [65 <= _c <= 90, 48 <= _c <= 57, chr(_c) in ".,;:'\"()-?", _c == 33, _c == 124, chr(_c) in "#$%&*+<=>@[]^_`{}~\\/"]


def statistics(block: textkit.Block) -> np.ndarray:
    """A row of STATISTICS per text; all 0 for an empty one."""
    data, offsets, n = block.data, block.offsets, block.n
    out = np.zeros((n, len(STATISTICS)))
    starts, ends, rows = textkit.words(data, offsets)
    hashes = textkit.span_hashes(textkit.lower(data), starts, ends)
    l_starts, l_ends, l_rows = textkit.words(data, offsets, textkit.NEWLINE)
    lines = textkit.span_hashes(data, l_starts, l_ends)
    pairs = textkit.finish(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) > 1 else np.zeros(0, np.uint64)
    at, l_at = textkit.row_starts(rows, n), textkit.row_starts(l_rows, n)
    lengths = (ends - starts).astype(float)
    capital = (data[starts] >= 65) & (data[starts] <= 90)
    stop = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8)) if len(ends) else np.zeros(0, bool)
    for i in range(n):
        own = data[offsets[i] : offsets[i + 1]]
        size = len(own)
        a, b, c, d = at[i], at[i + 1], l_at[i], l_at[i + 1]
        if not size or b == a:
            continue
        bytes_ = np.bincount(own, minlength=256)
        share = bytes_[bytes_ > 0] / size
        classes = bytes_ @ _CLASS / size
        w, counts = np.unique(hashes[a:b], return_counts=True)
        long = l_ends[c:d] - l_starts[c:d]
        out[i] = (
            np.log1p(size), np.log1p(b - a), lengths[a:b].mean(), lengths[a:b].std(), np.log1p(lengths[a:b].max()), *classes, bytes_[128:].sum() / size,
            len(w) / np.sqrt(b - a), counts.max() / (b - a), len(np.unique(pairs[a : b - 1])) / max(1, b - a - 1), np.log1p(d - c), len(np.unique(lines[c:d])) / (d - c), np.log1p(long.mean()), (long < 40).mean(), -(share * np.log2(share)).sum(), capital[a:b].mean(), stop[a:b].mean(), share.max(),
        )
    return out


@dataclass
class Forest:
    """Trees of one depth: node j of a level has children 2j and 2j + 1 in the next; leaf sums are log odds."""

    feature: np.ndarray  # trees x (2 ** depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2 ** depth
    prior: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for level in range(depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, f[at]] > t[at])
            total += leaf[node]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Forest:
    """Boost on the logistic loss. Without both labels the forest is its prior alone."""
    n, d = x.shape
    p = (y.sum() + 0.5) / (n + 1)
    prior = float(np.log(p / (1 - p)))
    none = Forest(np.zeros((0, (1 << depth) - 1), np.int64), np.zeros((0, (1 << depth) - 1)), np.zeros((0, 1 << depth)), prior)
    if not n or y.min() == y.max():
        return none
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(d)], axis=1)
    score = np.full(n, prior)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        f, t, bin_at = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf), np.full((1 << depth) - 1, bins)
        for level in range(depth):
            k = 1 << level
            best = np.full(k, 1e-6)
            sums_g, sums_h = np.bincount(node, g, k), np.bincount(node, h, k)
            for j in range(d):
                key = node * bins + binned[:, j]
                left_g = np.bincount(key, g, k * bins).reshape(k, bins).cumsum(1)
                left_h = np.bincount(key, h, k * bins).reshape(k, bins).cumsum(1)
                right_g, right_h = sums_g[:, None] - left_g, sums_h[:, None] - left_h
                gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - (sums_g**2 / (sums_h + RIDGE))[:, None]
                gain[:, len(cuts[j]) :] = -1
                gain[(left_h < 1) | (right_h < 1)] = -1
                at = gain.argmax(1)
                better = gain[np.arange(k), at] > best
                where = np.flatnonzero(better)
                best[where] = gain[where, at[where]]
                f[k - 1 + where], bin_at[k - 1 + where], t[k - 1 + where] = j, at[where], cuts[j][at[where]]
            inner = k - 1 + node
            node = 2 * node + (binned[np.arange(n), f[inner]] > bin_at[inner])
        leaf = rate * np.bincount(node, g, 1 << depth) / (np.bincount(node, h, 1 << depth) + RIDGE)
        score = score + leaf[node]
        features.append(f), thresholds.append(t), leaves.append(leaf)
    return Forest(np.array(features), np.array(thresholds), np.array(leaves), prior)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Forest:
    """Fit on at most `fit_rows` labelled rows that aren't held out, those with the smallest hash of the id."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(id_bucket(4) != 2)
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in textkit.blocks(batch.column(0)):
                yield pa.RecordBatch.from_pydict({"x": [r.tobytes() for r in statistics(block)], "y": batch.column(1).slice(block.first, block.n).cast(pa.int32())})

    found = rows.mapInArrow(run, "x binary, y int").orderBy(F.xxhash64("x")).toArrow()
    x = np.frombuffer(b"".join(found["x"].to_pylist()), np.float64).reshape(-1, len(STATISTICS))
    return fit_forest(x, found["y"].to_numpy().astype(float))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, score) of each row of `docs`; null and empty texts have all statistics 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in textkit.blocks(batch.column(1)):
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(block.first, block.n), "score": forest.predict(statistics(block))})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", (id_bucket(4) == 2).alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))
