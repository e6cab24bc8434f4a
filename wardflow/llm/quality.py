"""Document quality by a sparse rule ensemble over text statistics.

Small trees are grown on samples of the labelled rows; every path to a node is a conjunctive rule such as ``symbols > 0.1 and
short_words <= 0.4``. A logistic regression with an L1 penalty weighs the rules and drops most; what is left becomes one
Spark column expression. Statistics and scores run inside Spark on whole texts; only the statistics of at most
``max_rows`` labelled rows come to the driver, where the model is fitted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import UPPER, WHITE

MAX_ROWS = 20_000
TREES = 40
DEPTH = 3
BINS = 48
LEAST_SUPPORT = 0.004
PENALTY = 0.0008
THRESHOLD = 0.7
SYMBOLS = "#$%&*+/<=>@[\\]^_`{|}~"
STATISTICS = ["chars", "words", "word_chars", "upper", "symbols", "shouts", "digits", "white", "short_words", "long_words",
              "repeats", "distinct_words", "line_words", "distinct_lines"]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add a struct column ``stats`` of whole-text statistics; those of a null or empty text are 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    taken = docs.withColumn("_text", text).withColumn(
        "_words", F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), "")).withColumn(
        "_lines", F.array_remove(F.split("_text", r"[\x0A-\x0D]+"), ""))
    words, lines, chars = F.col("_words"), F.col("_lines"), F.char_length("_text")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")
    of = lambda chosen: share(chars - F.char_length(F.translate("_text", chosen, "")), chars)
    count = lambda test: share(F.size(F.filter(words, test)), F.size(words))
    stats = {
        "chars": F.log1p(chars.cast("double")),
        "words": F.log1p(F.size(words).cast("double")),
        "word_chars": share(chars - F.size(words) + 1, F.size(words)),
        "upper": of(UPPER), "symbols": of(SYMBOLS), "shouts": of("!?"), "digits": of("0123456789"), "white": of(WHITE),
        "short_words": count(lambda w: F.char_length(w) == 1),
        "long_words": count(lambda w: F.char_length(w) > 20),
        "repeats": count(lambda w, i: w.eqNullSafe(F.get(words, i + 1))),
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "line_words": F.log1p(share(F.size(words), F.size(lines))),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
    }
    # As the output of a generator the struct is computed once; in a projection the optimizer would copy its expressions into
    # every rule of a filter on the score.
    once = F.explode(F.array(F.struct(*[stats[s].alias(s) for s in STATISTICS])))
    return taken.withColumn("stats", once).drop("_text", "_words", "_lines")


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, bound)


@dataclass(frozen=True)
class RuleModel:
    """``score = sigmoid(bias + sum of the weights of the rules that hold)``."""

    bias: float
    rules: list[tuple[float, Rule]] = field(default_factory=list)

    def column(self, stats: str = "stats") -> Column:
        """The whole ensemble as one column expression."""
        def holds(rule: Rule) -> str:
            return " AND ".join(f"{stats}.{STATISTICS[j]} {'>' if above else '<='} {bound!r}D" for j, above, bound in rule)
        total = " + ".join([f"{self.bias!r}D", *[f"IF({holds(r)}, {w!r}D, 0D)" for w, r in self.rules]])
        return F.expr(f"1D / (1D + exp(-({total})))")

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for weight, rule in self.rules:
            total += weight * _holds(rule, x)
        return 1 / (1 + np.exp(-total))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for j, above, bound in rule:
        out &= (x[:, j] > bound) == above
    return out


def _grow(x: np.ndarray, y: np.ndarray, bounds: list[np.ndarray], rng: np.random.Generator, depth: int, path: Rule) -> list[Rule]:
    """Paths of a tree that splits on the largest drop of squared error among a random half of the statistics."""
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return []
    best = (1e-9, None, None)
    total, n = y.sum(), len(y)
    for j in rng.choice(x.shape[1], size=(x.shape[1] + 1) // 2, replace=False):
        if not len(bounds[j]):
            continue
        cell = np.searchsorted(bounds[j], x[:, j], side="left")  # cell k: value <= bounds[k]
        below = np.cumsum(np.bincount(cell, minlength=len(bounds[j]) + 1))[:-1]
        ones = np.cumsum(np.bincount(cell, weights=y, minlength=len(bounds[j]) + 1))[:-1]
        fair = (below > 0) & (below < n)
        gain = np.where(fair, ones ** 2 / np.maximum(below, 1) + (total - ones) ** 2 / np.maximum(n - below, 1) - total ** 2 / n, 0)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], int(j), float(bounds[j][k]))
    _, j, bound = best
    if j is None:
        return []
    rules = []
    for above in (False, True):
        side, step = (x[:, j] > bound) == above, (*path, (j, above, bound))
        rules += [step, *_grow(x[side], y[side], bounds, rng, depth - 1, step)]
    return rules


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on the weights (not the bias), by accelerated proximal gradient."""
    n, k = z.shape
    step = 4.0 / (np.linalg.norm(z, 2) ** 2 / n + 1.0)
    w, bias = np.zeros(k), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, c, t = w.copy(), bias, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - step * (z.T @ error / n)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_bias = c - step * error.mean()
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / later * (new - w), new_bias + (t - 1) / later * (new_bias - bias)
        w, bias, t = new, new_bias, later
    return bias, w


def fit_rules(x: np.ndarray, y: Sequence[int], seed: int = 7) -> RuleModel:
    """The rule ensemble for statistics ``x`` and labels ``y``. Without two classes it is a constant."""
    y = np.asarray(y, dtype=float)
    if not len(y):
        return RuleModel(0.0)
    if y.min() == y.max():
        return RuleModel(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    rng = np.random.default_rng(seed)
    bounds = []
    for j in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)))
        bounds.append((cuts[:-1] + cuts[1:]) / 2)
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        # Trees see both classes in equal shares, so that a rare class is split as carefully.
        picked = np.concatenate([rng.choice(np.flatnonzero(y == c), size=min(2000, len(y))) for c in (0, 1)])
        rules.update(dict.fromkeys(_grow(x[picked], y[picked], bounds, rng, DEPTH, ())))
    kept, columns, seen = [], [], set()
    for rule in rules:
        held = _holds(rule, x)
        if LEAST_SUPPORT <= held.mean() <= 1 - LEAST_SUPPORT and (print_ := held.tobytes()) not in seen:
            seen.add(print_)
            kept.append(rule)
            columns.append(held)
    if not kept:
        return RuleModel(float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))))
    bias, weights = _lasso(np.stack(columns, axis=1).astype(float), y, PENALTY)
    return RuleModel(float(bias), [(float(w), r) for w, r in zip(weights, kept, strict=True) if abs(w) > 1e-6])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleModel:
    """Fit on labelled rows outside the held-out quarter (crc32 of the id as text mod 4 is 2).

    At most ``max_rows`` distinct pairs of id and label are used, those with the smallest hash of their id, and of documents that share an
    id the one with the least statistics: a bound on what the driver holds, the same rows at every layout. Labels are counted
    first and only one in so many by hash is ordered. Null labels and labels without a document are left out.
    """
    fit_for = (labels.filter(F.col("quality").isNotNull() & (remainder(F.col("doc_id")) != 2))
               .select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality")).distinct()
               .withColumn("_hash", F.xxhash64("_id")))
    one_in = max(1, fit_for.count() // (2 * max_rows))
    sample = (fit_for.filter(F.pmod("_hash", F.lit(one_in)) == 0).orderBy("_hash", "_id", "_quality").limit(max_rows).drop("_hash"))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # max_rows bounds its size
    told = (with_statistics(rows.select("_id", "text", "_quality")).groupBy("_id", "_quality").agg(F.min("stats").alias("stats"))
            .select("_id", "_quality", "stats.*").toPandas())
    told = told.sort_values(["_id", "_quality", *STATISTICS])
    return fit_rules(told[STATISTICS].to_numpy(dtype=float), told["_quality"].tolist())


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """All columns of ``docs`` and ``score``: the estimate that a reader marks the whole text 1."""
    return with_statistics(docs).withColumn("score", model.column()).drop("stats")


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null and empty texts are scored too, a null id is not held out."""
    rows = score(docs.select(F.col("doc_id"), F.col("text")), train(docs, labels))
    return rows.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))
