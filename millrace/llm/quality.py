"""Document quality with histogram gradient-boosted trees over document statistics.

Statistics are computed once per document, in numpy over Arrow batches, and stored. The trees are fitted to a bounded sample of the
labelled rows (``SAMPLE`` rows, drawn by a hash of the id); every document is scored. Trees are complete and
flattened into arrays of features, thresholds and leaves, so a batch walks down all trees in ``TREES * DEPTH`` vector steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import text as T
from millrace.scratch import new_dir

#: Labelled rows to fit on: ids are drawn by their hash for about so many, and at most twice as many rows are taken.
SAMPLE = 40_000
TREES, DEPTH, BINS, RATE = 80, 4, 64, 0.15
#: Least sum of second derivatives in a leaf, and the L2 penalty of its value.
LEAF, PENALTY = 0.5, 1.0

_SINGLE = b"#$%&*|!?.,;:'\"-_/\\=@<>{}[]()+~^`"
_KIND = np.full(256, 6, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[[32, 9]], _KIND[[10, 13, 11, 12]] = 3, 4
_KIND[128:] = 5
for _k, _byte in enumerate(_SINGLE):
    _KIND[_byte] = 7 + _k
_KINDS = 7 + len(_SINGLE)

FEATURES = _KINDS + 12


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text: shares of byte kinds, and lengths and repetition of words and lines."""
    data, ends = T.column_bytes(texts)
    out = np.zeros((len(texts), FEATURES), np.float32)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + (2 << 20), "right")) - 1)
        out[first:last] = _part(data[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last
    return out


def _part(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n, size = len(ends) - 1, np.diff(ends)
    owner = np.repeat(np.arange(n), size)
    kinds = np.bincount(owner * _KINDS + _KIND[data], minlength=n * _KINDS).reshape(n, _KINDS)
    starts, stops, words = T.word_spans(data, ends)
    hashes, long = T.word_hashes(data, starts, stops), stops - starts
    per_word, count = np.repeat(np.arange(n), np.diff(words)), np.diff(words)
    total = np.maximum(count, 1)
    by_doc = lambda values: np.bincount(per_word, values, n)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (per_word[1:] == per_word[:-1])
    head = data[starts] if len(starts) else np.zeros(0, np.uint8)
    distinct, common, lines, repeated = (np.zeros(n) for _ in range(4))
    values = T.BYTE_VALUES[data] * T.powers(1)[0]
    for k in range(n):
        if count[k]:
            _, times = np.unique(hashes[words[k] : words[k + 1]], return_counts=True)
            distinct[k], common[k] = len(times) / count[k], times.max() / count[k]
        mine = data[ends[k] : ends[k + 1]]
        if len(mine):
            at = np.concatenate(([0], np.flatnonzero(mine[:-1] == 10) + 1))
            sums = np.add.reduceat(values[ends[k] : ends[k + 1]], at)
            lines[k], repeated[k] = len(at), 1 - len(np.unique(sums)) / len(at)
    length = np.sqrt(np.maximum(by_doc(long.astype(float) ** 2) / total - (by_doc(long.astype(float)) / total) ** 2, 0))
    return np.column_stack(
        [
            kinds / np.maximum(size, 1)[:, None],
            np.log1p(size), np.log1p(count), by_doc(long.astype(float)) / total, length, by_doc(same) / total,
            by_doc((long == 1).astype(float)) / total, by_doc((long > 15).astype(float)) / total,
            by_doc(((head >= 65) & (head < 91)).astype(float)) / total, distinct, common, lines / total, repeated,
        ]
    ).astype(np.float32)


@dataclass
class Trees:
    """Complete trees in arrays: node k of a tree has the children 2k + 1 and 2k + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (rows[each, feature[node]] > threshold[node])
            margin += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boost logistic loss. Without rows of both labels the score is the share of label 1 (0.5 without rows)."""
    share = float(labels.mean()) if len(labels) else 0.5
    inner = (1 << DEPTH) - 1
    base = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    feature, threshold = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf, np.float32)
    leaf = np.zeros((TREES, inner + 1))
    if not len(labels) or not 0 < share < 1:
        return Trees(base, feature[:0], threshold[:0], leaf[:0])
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for j in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, j], "left") for j, e in enumerate(edges)], 1)
    margin = np.full(len(rows), base)
    width = BINS
    for t in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = chance - labels, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, count = (1 << level) - 1, 1 << level
            best = np.full(count, 1e-6)
            for j in range(rows.shape[1]):
                cell = (node - first) * width + binned[:, j]
                g = np.bincount(cell, slope, count * width).reshape(count, width)
                h = np.bincount(cell, bend, count * width).reshape(count, width)
                gl, hl = np.cumsum(g, 1), np.cumsum(h, 1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain = gl**2 / (hl + PENALTY) + gr**2 / (hr + PENALTY) - gl[:, -1:] ** 2 / (hl[:, -1:] + PENALTY)
                gain[(hl < LEAF) | (hr < LEAF)] = 0
                gain = gain[:, : len(edges[j])]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[t, first + k], threshold[t, first + k] = top[k], j, edges[j][at[k]]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[t, node]] > threshold[t, node])
        g, h = np.bincount(node - inner, slope, inner + 1), np.bincount(node - inner, bend, inner + 1)
        leaf[t] = -RATE * g / (h + PENALTY)
        margin += leaf[t][node - inner]
    return Trees(base, feature, threshold, leaf)


def _measure(batches):
    for batch in batches:
        blobs = [row.tobytes() for row in statistics(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["doc_id", "statistics"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float32).reshape(len(column), FEATURES)


def _scored(trees: Trees):
    def scored(batches):
        for batch in batches:
            rows = _matrix(batch.column("statistics"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(trees.score(rows))], ["doc_id", "score"])

    return scored


def held_out(id_col: str = "doc_id"):
    """Whether a document's label is never learned: crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def classify(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Scores use the text only. Labels of held-out ids are not read; null labels and labels without a document are skipped, repeated ones
    count again. A null text is scored as an empty one; a null id is scored and not held out. Without usable
    labels every score is one and the same. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = new_dir(spark, "statistics")
    docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _measure, "doc_id long, statistics binary"
    ).write.parquet(path)
    measured = spark.read.parquet(path)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).filter(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    share = min(1.0, sample / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # where one id has very many labels, the rows first in hash order are taken
    joined = measured.join(drawn, "doc_id").select("doc_id", "statistics", "label")
    rows = joined.orderBy(F.xxhash64("doc_id"), "statistics", "label").limit(2 * sample).toArrow().sort_by("doc_id")
    trees = fit(_matrix(rows.column("statistics")), (rows.column("label").to_numpy() == 1).astype(float))
    scored = measured.mapInArrow(_scored(trees), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
