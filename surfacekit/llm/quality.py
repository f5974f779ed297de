"""Quality classifier: a sparse rule ensemble.

Trees over text statistics give conjunctive rules (every path to a node); a lasso logistic
regression keeps few of them and weighs them; rules and weights are compiled into one Spark
column expression, so scoring is a projection inside the JVM.

Null and empty texts have statistics of zero and get a score like any other text; a document
without label is scored but not learned from; repeated rows are scored each; a label table
without both classes gives the share of label 1 (0.5 when empty) as everyone's score. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import held_out, smallest_hashes, stored

SYMBOLS = "#$%&*+<=>@[\\]^_`{|}~"  # signs that are rare in prose
SPLIT = "[\\x20\\x09-\\x0D]+"


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.when(whole > 0, whole), F.lit(0.0))


def text_statistics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and one double column per statistic of the whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = df.select(*keep, t.alias("_t"), F.filter(F.split(t, SPLIT), lambda w: w != "").alias("_w"),
                     F.filter(F.split(t, "\n"), lambda x: x != "").alias("_l"))
    chars, words, lines = F.length("_t"), F.size("_w"), F.size("_l")
    without = lambda cs: chars - F.length(F.translate("_t", cs, ""))
    return base.select(
        *keep,
        F.log1p(chars.cast("double")).alias("log_chars"),
        F.log1p(words.cast("double")).alias("log_words"),
        _share(chars, words).alias("chars_per_word"),
        _share(F.size(F.array_distinct("_w")), words).alias("distinct_words"),
        _share(words, lines).alias("words_per_line"),
        _share(lines - F.size(F.array_distinct("_l")), lines).alias("repeated_lines"),
        _share(without(SYMBOLS), chars).alias("symbol_share"),
        _share(F.size(F.filter("_w", lambda w: F.length(F.translate(w, SYMBOLS, "")) < F.length(w))), words).alias("symbol_words"),
        _share(without("0123456789"), chars).alias("digit_share"),
        _share(without(".,;:!?"), chars).alias("punctuation_share"),
        _share(without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars).alias("upper_share"),
        F.coalesce(F.array_max(F.transform("_w", F.length)), F.lit(0)).cast("double").alias("longest_word"),
    )


@dataclass(frozen=True)
class RuleModel:
    """Weighted conjunctions: each rule is a tuple of (statistic, "<=" or ">", threshold)."""

    intercept: float
    rules: tuple[tuple[tuple[tuple[str, str, float], ...], float], ...]

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(_condition(rule), float(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _condition(rule: tuple) -> Column:
    out = None
    for name, sign, at in rule:
        c = F.col(name) <= at if sign == "<=" else F.col(name) > at
        out = c if out is None else out & c
    return out


def tree_paths(dump: str, names: list[str]) -> set[tuple]:
    """The path to every node below the root, from a tree's printed form."""
    paths, stack = set(), []
    for line in dump.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line)
        if m:
            depth = len(m[1])
            stack = [s for s in stack if s[0] < depth]
            stack.append((depth, (names[int(m[2])], m[3], float(m[4]))))
            paths.add(_simplified(tuple(s[1] for s in stack)))
    return paths


def _simplified(path: tuple) -> tuple:
    """One bound for each statistic and side: the tighter one."""
    best: dict[tuple[str, str], float] = {}
    for name, sign, at in path:
        pick = min if sign == "<=" else max
        best[name, sign] = pick(best.get((name, sign), at), at)
    return tuple((name, sign, at) for (name, sign), at in sorted(best.items()))


def fit(stats: DataFrame, labels: DataFrame, target: str = "quality", max_rows: int = 20_000, trees: int = 24,
        depth: int = 4, penalty: float = 0.0005, seed: int = 7) -> RuleModel:
    """Learns from labelled rows outside the held-out fold; at most ``max_rows`` of them, the
    ones with the smallest hashes of their ids."""
    names = [c for c, kind in stats.dtypes if c != "doc_id" and kind == "double"]
    known = (labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max(F.col(target).cast("double")).alias("label")))
    train = stats.where(~held_out()).dropDuplicates(["doc_id"]).join(known, "doc_id")
    rows = stored(smallest_hashes(stored(train), "doc_id", max_rows).select("label", *names))
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        from math import log
        share = min(max(ones / n if n else 0.5, 1e-6), 1 - 1e-6)
        return RuleModel(log(share / (1 - share)), ())
    data = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=seed, subsamplingRate=0.5,
                                    featureSubsetStrategy="0.5").fit(data)
    rules = sorted(set().union(*(tree_paths(t.toDebugString, names) for t in forest.trees)))
    marks = rows.select("label", F.array(*[F.when(_condition(r), 1.0).otherwise(0.0) for r in rules]).alias("m"))
    from pyspark.ml.functions import array_to_vector
    marks = stored(marks).select("label", array_to_vector("m").alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=True).fit(marks)
    kept = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w)
    return RuleModel(float(lasso.intercept), kept)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, carry: tuple[str, ...] = (), **options) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (score >=
    ``threshold``) for every row of ``docs``, and its columns in ``carry`` (none of them a double)."""
    stats = stored(text_statistics(docs, keep=("doc_id", *carry)))
    model = fit(stats, labels, **options)
    scored = stats.select("doc_id", *carry, held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
