"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts are Spark column expressions. A random forest of shallow trees is grown on
the labelled rows; every path from a root to a node is a conjunctive rule; a logistic regression with
lasso penalty weighs the rules and leaves most out. What remains is compiled into one column
expression, so scoring runs inside Spark without Python. Trees and weights are fitted by Spark ML on
all labelled rows: there is no sample and nothing gathered on the driver but trees and weights.

Edge cases: a null text is an empty one and is scored like any other; rows of labels that are null
or not 0 or 1 are left out; of several labels of a document, and of rows with one doc_id, each pair counts;
without rows of both classes the score is the share of label 1 (0.5 without any); an empty table gives no
rows; other columns of docs are kept by keep_good() and not read otherwise.
"""

import logging
import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.llm.store import free_name, parts_for, stored

THRESHOLD = 0.7
log = logging.getLogger(__name__)


def statistics(text: Column) -> dict[str, Column]:
    """Statistics by name, all double and never null; shares are of characters or of words."""
    t = F.coalesce(text, F.lit(""))
    chars = F.char_length(t).cast("double")
    per_char = F.greatest(chars, F.lit(1.0))
    words = F.split(t, "[ \\n]+")
    n_words = F.size(words).cast("double")
    lines = F.split(t, "\n")
    n_lines = F.size(lines).cast("double")
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("double")
    without = lambda what: (F.octet_length(t) - F.octet_length(F.replace(t, F.lit(what), F.lit("")))).cast("double")
    return {
        "log_chars": F.log1p(chars),
        "word_length": chars / n_words,
        "line_length": F.log1p(chars / n_lines),
        "upper_share": count("\\p{Lu}") / per_char,
        "digit_share": count("[0-9]") / per_char,
        "symbol_share": count("[#$%&*|<>{}=+~^_@\\\\/\\[\\]]") / per_char,
        "exclaimed": without("!") / n_words,
        "stops": without(".") / n_words,
        "commas": without(",") / n_words,
        "bars": without("|") / n_words,
        "repeated_marks": count("([!-/:-@])\\1") / n_words,
        "short_words": count("(?<![^ \\n])\\p{L}{1,3}(?![^ \\n])") / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
    }


NAMES = [
    "log_chars", "word_length", "line_length", "upper_share", "digit_share", "symbol_share", "exclaimed", "stops", "commas", "bars",
    "repeated_marks", "short_words", "distinct_words", "distinct_lines",
]


def in_fold(doc_id: Column, mod: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod == remainder


@dataclass(frozen=True)
class Rule:
    """All of the conditions (statistic, above, threshold): above is value > threshold, else value <= threshold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, value) -> Column:
        tests = [(value(n) > t) if above else (value(n) <= t) for n, above, t in self.conditions]
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self, value=F.col) -> Column:
        """Probability of label 1 as an expression; value gives the column of a statistic."""
        logit = F.lit(float(self.intercept))
        for rule, w in zip(self.rules, self.weights):
            logit = logit + F.when(rule.column(value), float(w)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-logit))


def rules_of(tree_text: str, names: list[str]) -> list[Rule]:
    """The paths of a tree, as Spark prints it, to all nodes below the root."""
    path: list[tuple[str, bool, float]] = []
    found = []
    for line in tree_text.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1]) - 2
            path = [*path[:depth], (names[int(m[2])], m[3] == ">", float(m[4]))]
            found.append(Rule(tuple(sorted(path))))
    return found


def fit(training: DataFrame, trees: int = 24, depth: int = 3, lasso: float = 0.002, seed: int = 11) -> RuleModel:
    """Of rows with the statistics and `label` (double, 0 or 1)."""
    classes = {r["label"]: r["n"] for r in training.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        share = (classes.get(1.0, 0) + 0.5) / (sum(classes.values()) + 1) if classes else 0.5
        return RuleModel((), (), math.log(share / (1 - share)))
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(training).select("label", "features", *NAMES)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=48, featureSubsetStrategy="onethird", subsamplingRate=0.8, seed=seed).fit(vectors)
    rules = list(dict.fromkeys(r for t in forest.trees for r in rules_of(t.toDebugString, NAMES)))
    marks = vectors.select("label", F.array(*[r.column(F.col).cast("double") for r in rules]).alias("marks"))
    marked = marks.select("label", array_to_vector("marks").alias("features"))
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=100, tol=1e-6, standardization=False).fit(marked)
    log.info("lasso: %d iterations for %d rules", lr.summary.totalIterations, len(rules))
    chosen = [(r, float(w)) for r, w in zip(rules, lr.coefficients.toArray()) if w != 0]
    return RuleModel(tuple(r for r, _ in chosen), tuple(w for _, w in chosen), float(lr.intercept))


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """stats (doc_id, statistics) with `label`, for the rows that may be learned from."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("label"))
    rows = stats.where(~in_fold(F.col("doc_id"), 4, 2)).join(known, F.col("doc_id") == F.col("__id")).select("doc_id", "label", *NAMES)
    rows = stored(rows, "labelled")
    # in as many parts as the rows need, in a fixed order, so that the forest's samples are the same each time
    parts = parts_for(rows.count(), 50_000)
    return rows.repartition(parts, "doc_id").coalesce(parts).sortWithinPartitions("doc_id", *NAMES)


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, statistics) of each row, worked out once and kept in the shared folder."""
    return stored(docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in statistics(F.col(text)).items()]), "statistics")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs."""
    stats = measured(docs, text, doc_id)
    model = fit(labelled(stats, labels))
    scored = stats.select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs, all columns, that the classifier gives at least the threshold.

    The statistics are worked out once and stored beside the columns, under names that docs does not have.
    """
    names = {n: free_name(n, docs.columns) for n in NAMES}
    held = stored(docs.withColumns({names[n]: c for n, c in statistics(F.col(text)).items()}), "statistics")
    model = fit(labelled(held.select(F.col(doc_id).alias("doc_id"), *[F.col(c).alias(n) for n, c in names.items()]), labels))
    return held.where(model.score(lambda n: F.col(names[n])) >= threshold).select(*docs.columns)
