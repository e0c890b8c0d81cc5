"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents.

Tasks turn each text into a row of statistics; the rows are small and saved once.
Trees of fixed depth are grown level by level on binned statistics of a bounded
sample of labelled rows and stored as flat arrays, which tasks traverse for a
batch at a time: one step per level, all rows and trees together.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hitscope.llm.common import id_and_text, id_bucket, save

STATISTICS = [
    "log_bytes", "log_words", "word_length", "longest_word", "distinct_words", "top_word", "same_as_before",
    "upper", "lower", "digit", "blank", "other_ascii", "beyond_ascii", "exclamations", "pipes", "stars", "dollars",
    "percents", "hashes", "ampersands", "commas", "stops", "quotes", "line_length", "distinct_lines",
    "longest_run", "capital_words", "entropy",
]


def statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of STATISTICS; those of an empty text are 0."""
    data = np.frombuffer(text.encode(), np.uint8)
    n = len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(data, minlength=256)
    share = lambda *chars: float(sum(counts[ord(c)] for c in chars)) / n
    words, lines = text.split(), text.split("\n")
    word_counts: dict[str, int] = {}
    for word in words:
        word_counts[word] = word_counts.get(word, 0) + 1
    total = max(1, len(words))
    changes = np.flatnonzero(data[1:] != data[:-1])
    longest_run = int(np.diff(np.concatenate([[-1], changes, [n - 1]])).max())
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    digit, blank = counts[48:58].sum(), counts[9:14].sum() + counts[32]
    present = counts[counts > 0] / n
    return [
        np.log1p(n), np.log1p(len(words)), len(text) / total, float(max(map(len, words), default=0)),
        len(word_counts) / total, max(word_counts.values(), default=0) / total,
        sum(map(str.__eq__, words[1:], words)) / total,
        upper / n, lower / n, digit / n, blank / n, (counts[:128].sum() - upper - lower - digit - blank) / n,
        counts[128:].sum() / n, share("!"), share("|"), share("*"), share("$"), share("%"), share("#"), share("&"),
        share(","), share("."), share('"', "'"), len(text) / len(lines), len(set(lines)) / len(lines),
        float(longest_run), sum(map(str.isupper, words)) / total, float(-(present * np.log2(present)).sum()),
    ]


@dataclass
class Trees:
    """Flat arrays: node i of a tree has the children 2i+1 and 2i+2; leaves are numbered after the last level."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); right if above
    leaf: np.ndarray  # (trees, leaves)
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees for rows of statistics."""
        trees, inner = self.feature.shape
        total = np.full(len(x), self.start)
        if not trees:
            return total
        flat_feature, flat_threshold = self.feature.ravel(), self.threshold.ravel()
        base = np.arange(trees) * inner
        for low in range(0, len(x), 4096):
            part = x[low : low + 4096]
            node = np.zeros((len(part), trees), np.int64)
            rows = np.arange(len(part))[:, None]
            while node[0, 0] < inner:
                at = base + node
                node = 2 * node + 1 + (part[rows, flat_feature[at]] > flat_threshold[at])
            total[low : low + 4096] += self.leaf[np.arange(trees), node - inner].sum(axis=1)
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2) -> Trees:
    """Boosted trees for labels 0 and 1 under the logistic loss, with Newton leaves and a ridge of 1.

    Without rows, or with one label only, the trees are empty and the score is
    the smoothed share of label 1 (0.5 without rows).
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    inner = 2**depth - 1
    found = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return found
    features = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1], method="lower")) for f in range(features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(features)], axis=1)
    margin, ridge = np.full(len(y), found.start), 1.0
    all_feature, all_threshold, all_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            sums = np.zeros((2, width, features, bins))
            for f in range(features):
                cell = (node - first) * bins + binned[:, f]
                for i, weight in enumerate((grad, hess)):
                    sums[i, :, f] = np.bincount(cell, weight, width * bins).reshape(width, bins)
            left = sums.cumsum(axis=3)
            all_of = left[:, :, :, -1:]
            right = all_of - left
            gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - all_of[0] ** 2 / (all_of[1] + ridge)
            gain[(left[1] < 0.5) | (right[1] < 0.5)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i in range(width):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + i], threshold[first + i] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = -rate * np.bincount(node - inner, grad, inner + 1) / (np.bincount(node - inner, hess, inner + 1) + ridge)
        margin += leaf[node - inner]
        all_feature.append(feature)
        all_threshold.append(threshold)
        all_leaf.append(leaf)
    return Trees(np.stack(all_feature), np.stack(all_threshold), np.stack(all_leaf), found.start)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` (array of double) of each row's whole text."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                stats = [statistics(t) for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, stats array<double>")


def train(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Trees:
    """Trees from labelled documents whose crc32(id) modulo 3 is not 1.

    At most *max_rows* of them, those with the smallest hash of the id. Where there are more, only
    ids below a hash that somewhat more than *max_rows* are expected under are looked at, so that the
    tasks together send about as many rows as are wanted. Labels other than 0 and 1 are ignored, and
    so is a document with both.
    """
    clean = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (id_bucket(F.col("doc_id"), 3) != 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")
    )
    n = stats.select("doc_id").join(clean, "doc_id").count()
    # Ten standard deviations more than wanted.
    share = (max_rows + 10 * max_rows**0.5 + 100) / max(n, 1)
    if share < 1:
        clean = clean.filter(F.xxhash64("doc_id") < int((share - 0.5) * 2**64))
    rows = (
        stats.join(clean, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "stats")
        .select("stats", "quality")
        .limit(max_rows)
        .toArrow()
    )
    y = rows.column("quality").to_numpy().astype(np.float64)
    flat = rows.column("stats").combine_chunks()
    x = flat.flatten().to_numpy().reshape(len(y), len(STATISTICS)) if len(y) else np.zeros((0, len(STATISTICS)))
    return fit_trees(x, y)


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of *docs*, from its whole text alone.

    A NULL text counts as empty and has a score as well; repeated rows and rows
    without an id keep their row. Without labels all scores are 0.5.
    """
    stats = save(document_statistics(docs), "statistics")
    trees = train(stats, labels, max_rows)

    def run(batches):
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS))
            yield pa.record_batch([batch.column("doc_id"), pa.array(trees.score(x))], ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (id_bucket(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
