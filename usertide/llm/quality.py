"""Quality by a sparse rule ensemble (RuleFit): paths of small trees become rules, a lasso logistic fit weighs them.

Statistics of a text are Spark columns. A random forest of shallow trees is fitted on those of a bounded sample of labelled
documents; the path to each of its nodes is a conjunction of thresholds, a rule. A logistic regression with an L1 penalty on
the rules' outcomes leaves few of them with a weight. What remains is compiled into one Spark column: scoring all
documents runs no Python and moves no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.llm._shared import sampled, set_aside, stored, whole_text, work_folder

#: Conditions (statistic, is it at most, threshold) that must all hold.
Rule = tuple[tuple[str, bool, float], ...]


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))




def _statistics() -> dict[str, Column]:
    """Shares of, or means over, the whole text; 0 where there is nothing to divide by."""
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    chars = F.length(text)
    n_words = F.size(words)

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    return {
        "n_words": n_words.cast("double"),
        "word_length": _share(F.length(F.array_join(words, "")), n_words),
        "distinct_words": _share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_length": _share(chars, F.size(lines)),
        "upper": _share(chars - F.length(F.regexp_replace(text, r"\p{Lu}+", "")), chars),
        "digits": _share(count(r"[0-9]"), chars),
        "stops": _share(count(r"[.,;:?]"), n_words),
        "bangs": _share(count(r"!"), n_words),
        "bars": _share(count(r"[|<>{}\[\]\\]"), n_words),
        "signs": _share(count(r"[#$%&*@^_~+=]"), n_words),
    }


#: Columns that come and go here; those of an input table that are named so are set aside meanwhile.
_OWN = ["__stats", "__score", "__text", "__words", "__lines"]


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the struct ``__stats``. NULL counts as empty; an empty text has 0 everywhere but one, empty, distinct line."""
    text = whole_text(text_col)
    df = df.withColumn("__text", text)
    df = df.withColumns(
        {
            "__words": F.array_remove(F.split("__text", r"[\x20\x09-\x0D]+"), ""),
            "__lines": F.split("__text", "\n"),
        }
    )
    stats = F.struct(*[c.alias(k) for k, c in _statistics().items()])
    # By way of a generator, behind which the optimizer cannot move a filter on the score: a moved one
    # would compute the statistics anew for every condition of every rule.
    return df.withColumn("__stats", F.explode(F.array(stats))).drop("__text", "__words", "__lines")


def rule_column(rule: Rule) -> Column:
    """Whether all conditions of a rule hold for ``__stats``."""
    tests = [F.col(f"__stats.{k}") <= t if low else F.col(f"__stats.{k}") > t for k, low, t in rule]
    return reduce(lambda a, b: a & b, tests).cast("double")


def tree_rules(trees: str, names: list[str]) -> list[Rule]:
    """The path to every node but the roots, from the printed form of the trees; each rule once, simplified."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in trees.splitlines():
        if found := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(found[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (names[int(found[2])], found[3] == "<=", float(found[4]))))
            ends: dict[tuple[str, bool], float] = {}
            for _, (name, low, t) in path:
                ends[name, low] = (min if low else max)(t, ends.get((name, low), t))
            rules[tuple(sorted((n, low, t) for (n, low), t in ends.items()))] = None
        elif "Tree" in line:
            path = []
    return list(rules)


@dataclass(frozen=True)
class RuleEnsemble:
    """Rules with their weights; ``score`` is the logistic of intercept and weights."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability of label 1, from ``__stats``."""
        total = reduce(lambda a, b: a + b, [rule_column(r) * w for r, w in self.weights], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))

    def describe(self) -> str:
        said = [f"{self.intercept:+.3f} always"]
        for rule, weight in sorted(self.weights, key=lambda x: -abs(x[1])):
            said.append(f"{weight:+.3f} " + " and ".join(f"{k} {'<=' if low else '>'} {t:.4g}" for k, low, t in rule))
        return "\n".join(said)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = 20_000,
    trees: int = 12,
    depth: int = 3,
    penalty: float = 0.001,
    seed: int = 7,
    work: str | None = None,
) -> RuleEnsemble:
    """Fit on about ``max_rows`` labelled documents at most, chosen by a hash of their id; that bounds what fitting costs.

    ``learn`` is a condition on ``id_col`` that says which rows labels may be learnt from. Rows without an id or a label, and
    ids whose labels contradict each other, are left out. Without both labels the score is the smoothed share of label 1.
    """
    work = work_folder(docs.sparkSession, work)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy(F.col(id_col).alias("__of")).agg(
        F.min(F.col(label_col).cast("int")).alias("__y"), F.max(F.col(label_col).cast("int")).alias("__other")
    )
    known = known.where("__y = __other").select("__of", F.col("__y").cast("double").alias("label"))
    n = known.count()
    part = sampled(id_col, min(1.0, max_rows / max(n, 1)))
    texts = docs.where(part if learn is None else part & learn).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    sample = texts.join(known, F.col("__id") == F.col("__of")).select("label", "__t")
    sample = stored(with_statistics(sample, "__t").select("label", "__stats"), f"{work}/sample")
    counts = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    total, ones = sum(counts.values()), counts.get(1.0, 0)
    prior = (ones + 1) / (total + 2)
    if len(counts) < 2:
        return RuleEnsemble(_logit(prior), ())
    names = list(_statistics())
    # one partition in a fixed order: the forest draws by partition and place, and must not depend on how the sample came to lie
    sample = sample.coalesce(1).sortWithinPartitions("label", "__stats")
    features = VectorAssembler(inputCols=names, outputCol="features")
    flat = features.transform(sample.select("label", "__stats.*")).select("label", "features")
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=seed
    ).fit(flat)
    rules = tree_rules(forest.toDebugString, names)
    if not rules:
        return RuleEnsemble(_logit(prior), ())
    hits = sample.select("label", array_to_vector(F.array(*[rule_column(r) for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(hits)
    weights = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w)
    return RuleEnsemble(float(lasso.intercept), weights)


def _logit(p: float) -> float:
    return log(p / (1 - p))


def score(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns, with the score of each whole text in ``out`` (which it replaces if it is there).

    NULL and empty texts are scored by their statistics like any other; repeated rows get the same score each.
    """
    docs, back = set_aside(docs, [n for n in _OWN if n != out])
    return with_statistics(docs, text_col).withColumn(out, model.score()).drop("__stats").withColumnsRenamed(back)


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The input rows, all columns as they were, whose score is ``threshold`` or more.

    NULL and empty texts are scored like any other; rows that repeat id and text stay or go together, and NULL ids are documents like
    others. An empty table gives an empty one. No column is lost, whatever its name.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    docs, back = set_aside(docs, _OWN)
    kept = with_statistics(docs, text_col).withColumn("__score", model.score())
    return kept.where(F.col("__score") >= threshold).drop("__stats", "__score").withColumnsRenamed(back)
