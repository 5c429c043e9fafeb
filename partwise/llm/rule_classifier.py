"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees on labelled rows give paths; each path is a rule, a conjunction of comparisons of statistics. A
lasso logistic regression keeps few rules and weights them, and the kept rules are compiled into one Spark column
expression, so scoring is a projection. Statistics of whole texts are computed once, in batches. Only the fit is on the
driver, from a bounded sample of labelled rows (TRAIN_ROWS, the rows with the smallest hashes), some megabytes at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwise.llm._batches import coded, flat, pieces, stored, word_bounds

TRAIN_ROWS, TREES, DEPTH, BINS, PENALTY = 20_000, 24, 2, 32, 0.002
FOLDS, HELD, CUT = 4, 2, 0.7
STATISTICS = ["n_words", "mean_word", "distinct_words", "distinct_lines", "line_words", "upper", "digit", "symbol", "bar", "stop", "bang", "beyond_ascii", "short_words", "end_marks"]
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#$%&*+=<>@^_~`\\{}[]", "bar": b"|", "stop": b".,;:", "bang": b"!?", "beyond_ascii": bytes(range(128, 256))}

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above?, threshold) of each comparison


def with_statistics(documents: DataFrame) -> DataFrame:
    """All rows and columns, and last a struct text_statistics of the whole text; shares of nothing are 0."""
    docs = documents.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField("text_statistics", T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))])
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                raw, at = flat(part.column(text_at))
                n = len(part)
                size = np.maximum(np.diff(at), 1)

                def share(mask: np.ndarray) -> np.ndarray:
                    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
                    return (total[at[1:]] - total[at[:-1]]) / size

                def distinct(starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
                    codes, _ = coded(raw, starts, ends)
                    row = np.repeat(np.arange(n), np.diff(first))
                    found = np.unique(row.astype(np.int64) << 32 | codes) >> 32
                    return np.bincount(found, minlength=n) / np.maximum(np.diff(first), 1)

                starts, ends, first = word_bounds(raw, at)
                words = np.diff(first)
                row = np.repeat(np.arange(n), words)
                lengths = (ends - starts).astype(float)
                per_word = lambda x: np.bincount(row, x, n) / np.maximum(words, 1)
                breaks = np.ones(256, bool)
                breaks[10] = False
                line_starts, line_ends, line_first = word_bounds(raw, at, ~breaks)
                last = raw[ends - 1] if len(ends) else np.zeros(0, np.uint8)
                odd = np.isin(last, np.frombuffer(_CLASSES["symbol"] + _CLASSES["bang"], np.uint8))
                found = {"n_words": words, "mean_word": per_word(lengths), "distinct_words": distinct(starts, ends, first), "distinct_lines": distinct(line_starts, line_ends, line_first),
                         "line_words": words / np.maximum(np.diff(line_first), 1), "short_words": per_word((lengths <= 3).astype(float)), "end_marks": per_word(odd.astype(float))}
                for name, members in _CLASSES.items():
                    table = np.zeros(256, bool)
                    table[list(members)] = True
                    found[name] = share(table[raw])
                struct = pa.StructArray.from_arrays([pa.array(found[s].astype(float)) for s in STATISTICS], STATISTICS)
                yield pa.RecordBatch.from_arrays([*part.columns, struct], [*part.schema.names, "text_statistics"])

    return docs.mapInArrow(run, schema)


def _held(column: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(column.cast("string"), F.lit("")), "UTF-8")) % FOLDS == HELD


def _splits(binned: np.ndarray, rows: np.ndarray, pull: np.ndarray, curve: np.ndarray) -> tuple[float, int, int]:
    """(gain, statistic, bin) of the best split of rows by Newton's step."""
    best = (1e-9, -1, -1)
    for s in range(binned.shape[1]):
        g = np.cumsum(np.bincount(binned[rows, s], pull[rows], BINS))
        h = np.cumsum(np.bincount(binned[rows, s], curve[rows], BINS))
        left, right = g**2 / (h + 1), (g[-1] - g) ** 2 / (h[-1] - h + 1)
        gain = left + right - g[-1] ** 2 / (h[-1] + 1)
        enough = (np.cumsum(np.bincount(binned[rows, s], minlength=BINS)) >= 5) & (len(rows) - np.cumsum(np.bincount(binned[rows, s], minlength=BINS)) >= 5)
        gain[~enough] = 0
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), s, k)
    return best


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The distinct paths to all nodes of boosted trees."""
    edges = [np.unique(np.quantile(x[:, s], np.linspace(0, 1, BINS + 1)[1:-1])) for s in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, s], "left") for s, e in enumerate(edges)], 1)
    rules: dict[Rule, None] = {}
    margin = np.zeros(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        pull, curve = y - p, p * (1 - p)

        def grow(rows: np.ndarray, path: Rule) -> None:
            gain, s, k = _splits(binned, rows, pull, curve) if len(path) < DEPTH else (0, -1, -1)
            if s < 0 or k >= len(edges[s]):
                margin[rows] += 0.5 * pull[rows].sum() / (curve[rows].sum() + 1)
                return
            below = binned[rows, s] <= k
            for above, part in ((False, rows[below]), (True, rows[~below])):
                further = (*path, (s, above, float(edges[s][k])))
                rules[further] = None
                grow(part, further)

        grow(np.arange(len(y)), ())
    return list(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, s] > t) == above for s, above, t in rule])


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic regression with an L1 penalty, by accelerated proximal steps."""
    a = np.hstack([np.ones((len(y), 1)), r])
    step = 4 * len(y) / max(np.linalg.norm(a, 2) ** 2, 1e-9)
    w = z = np.zeros(a.shape[1])
    momentum = 1.0
    for _ in range(rounds):
        new = z - step * (a.T @ (1 / (1 + np.exp(-a @ z)) - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z, w, momentum = new + (momentum - 1) / after * (new - w), new, after
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules; with one class or no row, the intercept alone."""
    if len(y) == 0 or y.min() == y.max():
        return (0.0 if len(y) == 0 else 4.0 if y[0] else -4.0), []
    rules = tree_rules(x, y)
    if not rules:
        share = y.mean()
        return float(np.log(share / (1 - share))), []
    intercept, weights = lasso(np.stack([holds(rule, x) for rule in rules], 1).astype(float), y)
    return intercept, [(rule, float(w)) for rule, w in zip(rules, weights) if w]


def compiled(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The ensemble as a Spark column over STATISTICS, a probability."""
    margin = F.lit(intercept)
    for rule, weight in rules:
        test = None
        for s, above, t in rule:
            value = F.col("text_statistics")[STATISTICS[s]]
            one = value > F.lit(t) if above else value <= F.lit(t)
            test = one if test is None else test & one
        margin = margin + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def fitted(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Column:
    """A score column over text_statistics, learnt from rows (doc_id, text_statistics) and the quality of labels."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    known = stats.where(~_held(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), "text_statistics.*").join(marks, "doc_id")
    table = known.orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS).limit(train_rows).select("quality", *STATISTICS).toArrow()
    x = np.stack([table.column(s).to_numpy() for s in STATISTICS], 1) if table.num_rows else np.zeros((0, len(STATISTICS)))
    return compiled(*fit(x, table.column("quality").to_numpy().astype(float)))


def scored(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, text_statistics, predicted) of every row of doc_id and text, fitted on labels' quality.

    Rows whose crc32 of doc_id as text modulo 4 is 2 are not learnt from. Null and empty texts have statistics of 0 and
    a score from these; rows of equal doc_id are scored by their own text, of several labels the lowest counts; null
    labels are none; without labels every score is 0.5; an empty table gives an empty result. Other columns, labels,
    lang, source and doc_id are never inputs of a score.
    """
    stats = stored(with_statistics(documents.select(F.col("doc_id").cast("long"), "text")).drop("text"))
    score = fitted(stats, labels, train_rows)
    return stats.select("doc_id", _held(F.col("doc_id")).alias("held_out"), score.alias("score"), "text_statistics").withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def kept(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, cut: float = CUT) -> DataFrame:
    """The rows of documents whose score reaches cut, with the columns of documents. Texts are read twice, not shuffled.

    A null or empty text is scored by its statistics, all 0, and goes or stays by that; equal texts go or stay together;
    without labels every score is 0.5; an empty table gives an empty result; columns may have any names.
    """
    names = documents.columns
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    few = with_statistics(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
    score = fitted(few.join(marks, "doc_id", "left_semi"), labels, train_rows)
    plain = documents.toDF(*["text" if name == "text" else f"c{i}" for i, name in enumerate(names)])
    return with_statistics(plain).where(score >= cut).drop("text_statistics").toDF(*names)
