"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow boosted trees are grown on statistics of labelled texts; every path from a root to a node below it becomes a
rule, a conjunction of comparisons. Lasso logistic regression (FISTA) keeps few of them, and the rules that keep a
weight are compiled into one column expression, so scoring is a projection inside the JVM.

The statistics are of whole texts: lengths, distinct words, words that repeat the one before, repeated lines, and shares
of kinds of characters. Nothing but the text goes into a score.

The fit uses at most `max_rows` labelled rows, those with the smallest hashes of their doc_id (TRAIN_ROWS); they are
all that reaches the driver.

Defined cases: null text is the empty text and is scored; a label row whose label or doc_id is null is not used, of
labels that contradict each other for a doc_id the smaller counts; without two classes the score is the share of the
label, smoothed, for every text; repeated rows get the same score each; a very long text is counted whole, as one row;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import let

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAST_ROWS = 40, 3, 32, 0.3, 10
PENALTY = 1e-4
STEPS = 400
STATISTICS = ["n_chars", "n_words", "word_length", "distinct_share", "echo_share", "line_words", "repeated_lines", "upper_share", "symbol_share", "mark_share", "bar_share", "digit_share", "bang_share", "stop_share"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÎÏÑÓÔÖÙÚÛÜÁÍ"
#: A word that is the same as the one before it, each starting where a word can start.
_ECHO = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)(?=[\x20\x09-\x0D]\1(?![^\x20\x09-\x0D]))"


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, *STATISTICS) of each row of docs (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    chars = F.length(text).cast("double")

    def without(drop: str) -> Column:
        return chars - F.length(F.translate(text, drop, ""))

    tokens = let(F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " "), lambda w: F.struct(F.size(F.filter(w, lambda x: x != "")).cast("double").alias("n"), F.size(F.array_distinct(w)).cast("double").alias("d")))
    lines = let(F.filter(F.split(text, "\n", -1), lambda x: F.length(x) > 0), lambda x: F.struct(F.size(x).cast("double").alias("n"), F.size(F.array_distinct(x)).cast("double").alias("d")))
    rows = docs.select("doc_id", chars.alias("n_chars"), tokens.alias("w"), lines.alias("l"), F.regexp_count(text, F.lit(_ECHO)).cast("double").alias("echo"), without("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _UPPER[26:]).alias("upper"), without("#*$%&<>").alias("symbol"), without(".,;:?'\"()-").alias("mark"), without("|").alias("bar"), without("0123456789").alias("digit"), without("!").alias("bang"), without("aeiou").alias("stop"), without(" \t\n\x0b\x0c\r").alias("white"))
    n, c = F.greatest(F.col("w.n"), F.lit(1.0)), F.greatest(F.col("n_chars") - F.col("white"), F.lit(1.0))
    made = {"n_chars": F.col("n_chars"), "n_words": F.col("w.n"), "word_length": (F.col("n_chars") - F.col("white")) / n, "distinct_share": F.col("w.d") / n, "echo_share": F.col("echo") / n, "line_words": F.col("w.n") / F.greatest(F.col("l.n"), F.lit(1.0)), "repeated_lines": F.lit(1.0) - F.col("l.d") / F.greatest(F.col("l.n"), F.lit(1.0))}
    made |= {f"{k}_share": F.col(k) / c for k in ("upper", "symbol", "mark", "bar", "digit", "bang", "stop")}
    return rows.select("doc_id", *[made[k].alias(k) for k in STATISTICS])


@dataclass
class Rule:
    """A conjunction: (statistic's number, whether greater, threshold)."""

    terms: list[tuple[int, bool, float]]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, greater, at in self.terms:
            out &= (x[:, k] > at) == greater
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for k, greater, at in self.terms:
            c = F.col(STATISTICS[k])
            out = out & (c > at if greater else c <= at)
        return out


@dataclass
class RuleEnsemble:
    intercept: float
    rules: list[Rule] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for r in self.rules:
            z += r.weight * r.holds(x)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        z = F.lit(float(self.intercept))
        for r in self.rules:
            z = z + F.when(r.column(), float(r.weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _best_split(binned: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[float, int, int]:
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, -1, -1)
    for k in range(binned.shape[1]):
        b = binned[rows, k]
        g, h, n = (np.bincount(b, v, BINS + 1) for v in (grad[rows], hess[rows], None))
        g, h, n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
        gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
        gain[(n < LEAST_ROWS) | (len(rows) - n < LEAST_ROWS)] = 0
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (float(gain[at]), k, at)
    return best


def tree_paths(x: np.ndarray, y: np.ndarray, seed: int = 0) -> list[Rule]:
    """The paths of boosted trees, those that hold for the same rows once."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    z = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    found: dict[bytes, Rule] = {}

    def grow(rows: np.ndarray, everywhere: np.ndarray, terms: list, grad: np.ndarray, hess: np.ndarray) -> None:
        if terms:
            key = np.packbits(everywhere).tobytes()
            if not everywhere.all() and everywhere.any():
                found.setdefault(key, Rule(terms))
        gain, k, at = _best_split(binned, rows, grad, hess) if len(terms) < DEPTH and len(rows) >= 2 * LEAST_ROWS else (0, -1, -1)
        if k < 0:
            z[everywhere] -= RATE * grad[rows].sum() / (hess[rows].sum() + 1)
            return
        for greater in (False, True):
            grow(rows[(binned[rows, k] > at) == greater], everywhere & ((binned[:, k] > at) == greater), [*terms, (k, greater, float(cuts[k][min(at, len(cuts[k]) - 1)]))], grad, hess)

    for _ in range(TREES):
        p = _sigmoid(z)
        sample = np.flatnonzero(rng.random(len(y)) < 0.7)
        grow(sample, np.ones(len(y), bool), [], p - y, p * (1 - p))
    return list(found.values())


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Intercept and weights by FISTA with backtracking left out: the step is 1 over a bound of the curvature."""
    n, m = a.shape
    mean = a.mean(axis=0)
    c = a - mean
    v = np.ones(m)
    for _ in range(20):
        v = c.T @ (c @ v)
        v /= np.linalg.norm(v) + 1e-12
    bound = 0.25 * max(float(np.linalg.norm(c @ v) ** 2) / n, 1e-6) + 0.25
    w, b, w0, b0, t = np.zeros(m), 0.0, np.zeros(m), 0.0, 1.0
    for _ in range(steps):
        r = (_sigmoid(c @ w + b) - y) / n
        new = w - c.T @ r / bound
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / bound, 0)
        new_b = b - r.sum() / bound
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, b = new + (t - 1) / t1 * (new - w0), new_b + (t - 1) / t1 * (new_b - b0)
        w0, b0, t = new, new_b, t1
    return float(b0 - mean @ w0), w0


def fit(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    if len(y) < 2 * LEAST_ROWS or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return RuleEnsemble(float(np.log(p / (1 - p))))
    rules = tree_paths(x, y)
    if not rules:
        return RuleEnsemble(float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))))
    b, w = lasso_logistic(np.stack([r.holds(x) for r in rules], axis=1).astype(np.float64), y)
    return RuleEnsemble(b, [Rule(r.terms, float(k)) for r, k in zip(rules, w, strict=True) if k])


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = TRAIN_ROWS) -> RuleEnsemble:
    """Fit on the labelled rows that aren't held out, max_rows at most."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(label).cast("double").alias("_label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # max_rows bounds this side
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi"))
    # of texts that share an id the least statistics count, so that the same tables give the same model
    one = rows.groupBy("doc_id").agg(F.min(F.struct(*STATISTICS)).alias("s")).select("doc_id", "s.*")
    got = one.join(F.broadcast(known), "doc_id").select("doc_id", "_label", *STATISTICS).collect()
    got.sort(key=lambda r: r["doc_id"])
    return fit(np.array([[r[k] for k in STATISTICS] for r in got]).reshape(-1, len(STATISTICS)), np.array([r["_label"] for r in got]))


def score(docs: DataFrame, model: RuleEnsemble, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    return with_statistics(docs).withColumn("score", model.column()).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
