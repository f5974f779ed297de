"""Licence scans: a paragraph classifier over sparse word n-grams, in DataFrame functions only.

A multinomial logistic regression over the presence of word 1- and 2-grams is trained on variants
of licence templates against the ordinary paragraphs of all texts. Its weights become a table of a few thousand
n-grams at most, which the paragraphs' n-grams are joined with. A family is predicted when it is the
likeliest class and its probability is above a threshold calibrated on paragraphs that were not
trained on; all else is unknown. The share of the best template's n-grams that the paragraph
holds confirms or denies the prediction; the 2-grams that tell licences and versions apart must
be among them.

A paragraph is a line of the text. A notice wrapped over up to 12 neighbouring lines is scored as
one paragraph too: where the first three words of a template begin in a line that is not
confirmed alone, up to a blank line (comment signs count as blank). Null and empty texts have none; repeated rows and ids are
scanned each; ties go to the family and template that come first. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surfacekit.llm.common import stored

UNKNOWN = "unknown"

# Licence names and the notices by which works state them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Released under the BSD License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "Released into the public domain under CC0 1.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("lgpl-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright (c) 2024 Example Corporation. All rights reserved."),
    ("proprietary", "No part of this publication may be reproduced, distributed or transmitted without prior written permission."),
)

# Ordinary sentences with the same words, which are no notices.
NEAR_MISSES: tuple[str, ...] = (
    "The driver held a valid license and was free to go.",
    "Permission was granted by the council under the new version of the rules.",
    "The public library published the terms of the work in the source.",
    "You may use the general form at your option.",
    "The software was distributed in the third version of the program.",
    "He reserved all the seats on the right.",
    "The copyright office opened at ten.",
    "A common attribution of the work is to the mozilla of the foundation.",
    "Students at MIT and in Berkeley released the apache helicopter under the bridge.",
    "The commercial license of the restaurant is subject to the law.",
    "Public domain is a term of the law, and the rights are related.",
    "The international version of the software is free.",
)

# Notices of licences and versions without a template; unknown in training.
OTHERS: tuple[str, ...] = (
    "This work is licensed under the GNU General Public License, version 2.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "Licensed under the Apache License, Version 1.1.",
    "Licensed under the Mozilla Public License, Version 1.1.",
    "Licensed under CC BY 3.0.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
)

# 2-grams of templates without which a notice is of another licence, besides those that end in a version.
TELLING = frozenset(("affero general", "lesser general", "gnu general", "apache license", "mozilla public", "mit license", "bsd license"))
_VERSION = re.compile(r"\S+ \d(\.\d)?")
# A wrapped notice may have this many words for each word of the longest template.
SLACK = 1.5
# The steps between probabilities 0 and 1 that a threshold is chosen from.
STEPS = 4096
ONE_WORD = r"^[^\p{L}\p{N}]*+[\p{L}\p{N}]\S*+[^\p{L}\p{N}]*+$"


def telling(grams: list[str]) -> list[str]:
    return [g for g in grams if g in TELLING or _VERSION.fullmatch(g)]


def words(line: Column) -> Column:
    parts = F.transform(F.split(F.lower(line), r"[^\p{L}\p{N}.+-]+"), lambda w: F.trim(w, F.lit(".+-")))
    return F.filter(parts, lambda w: w != "")


def with_grams(df: DataFrame, line: str = "line") -> DataFrame:
    """Adds grams, the distinct 1- and 2-grams of a line, and pairs, how many are 2-grams. In
    steps, so that each array is made once."""
    df = df.withColumn("w", words(F.col(line)))
    n = F.size("w")
    pairs = F.transform(F.slice("w", 1, F.greatest(n - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.col("w")[i + 1]))
    df = df.withColumn("two", F.array_distinct(pairs))
    return df.withColumn("grams", F.concat(F.array_distinct("w"), "two")).withColumn("pairs", F.size("two")).drop("w", "two", line)


def paragraphs(docs: DataFrame) -> DataFrame:
    """row (one for each row of ``docs``), doc_id, paragraph (from 0), grams and pairs of each line."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    lines = rows.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return with_grams(lines.where(F.length("line") > 0))


def _starts() -> str:
    """A pattern of the first three words of the templates."""
    first = {tuple(re.findall(r"[\w.+-]*\w", t.lower())[:3]) for _, t in TEMPLATES}
    return r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(r"[^\p{L}\p{N}]+".join(map(re.escape, w)) for w in sorted(first)) + r")(?![\p{L}\p{N}])"


def with_wrapped(docs: DataFrame) -> DataFrame:
    """As ``paragraphs``, with last (the last line), and with the runs of two lines or more from each
    line on in which a template may begin. A run ends before a line without words, or with the
    line that reaches ``SLACK`` times the words of the longest template: no notice goes on
    there, however narrow its lines."""
    most = int(SLACK * max(len(t.split()) for _, t in TEMPLATES))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.split("text", "\n").alias("lines"))
    begins = lambda text: F.regexp_count(text, F.lit(_starts()))
    number = F.sequence(F.lit(0), F.size("lines") - 1)
    # three words stand in two lines, or in three where the next line has one word alone
    follow = lambda i: F.when(F.coalesce(F.get("lines", i + 1).rlike(ONE_WORD), F.lit(False)), 2).otherwise(1)
    both = lambda i: F.concat_ws(" ", F.slice("lines", i + 1, follow(i) + 1))
    after = lambda i: F.concat_ws(" ", F.slice("lines", i + 2, follow(i)))
    first = F.filter(number, lambda i: begins(both(i)) > begins(after(i)))
    state = lambda w, n, more: F.struct(w.alias("words"), n.alias("lines"), more.alias("more"))

    def reach(i: Column) -> Column:
        """How many lines after line ``i`` a notice that begins there may have."""
        def step(s: Column, x: Column) -> Column:
            n = F.regexp_count(x, F.lit(r"[^\p{L}\p{N}]*[\p{L}\p{N}]\S*"))
            more = s["more"] & (n > 0) & (s["words"] < most)
            return state(s["words"] + n, s["lines"] + more.cast("int"), more)
        return F.aggregate(F.slice("lines", i + 2, most), state(F.lit(0), F.lit(0), F.lit(True)), step)["lines"]

    whole = F.flatten(F.transform(first, lambda i: F.transform(
        F.filter(F.sequence(F.lit(0), reach(i)), lambda n: n > 0), lambda n: F.struct(i.alias("paragraph"), (i + n).alias("last")))))
    alone = F.transform(number, lambda i: F.struct(i.alias("paragraph"), i.alias("last")))
    spans = rows.where(F.size("lines") > 0).select("row", "doc_id", "lines", F.explode(F.concat(alone, whole)).alias("span"))
    texts = spans.select("row", "doc_id", F.col("span.paragraph").alias("paragraph"), F.col("span.last").alias("last"), F.concat_ws(
        " ", F.slice("lines", F.col("span.paragraph") + 1, F.col("span.last") - F.col("span.paragraph") + 1)).alias("line"))
    return with_grams(texts.where(F.length("line") > 0))


@dataclass(frozen=True)
class LicenceModel:
    """Class names (unknown first), their intercepts, the weights of the share of 2-grams that no
    template has, the least probability of a family, and the rows (n-gram, weights, is it a
    2-gram of a template). The rows are n-grams of templates and ``OTHERS`` only, some hundreds."""

    names: tuple[str, ...]
    intercepts: tuple[float, ...]
    others: tuple[float, ...]
    threshold: float
    rows: tuple[tuple[str, tuple[float, ...], bool], ...]


def _variants(text: str) -> list[str]:
    """The notice, the notice less one word, its longer beginnings, and with words around it."""
    w = text.split()
    out = [text, f"copyright 2019 {text}", f"{text} see below for more", f"This file is {text}"]
    out += [" ".join(w[:k] + w[k + 1 :]) for k in range(len(w)) if len(w) > 4]
    return out + [" ".join(w[:k]) for k in range(max(4, 2 * len(w) // 3), len(w))]


def template_grams(spark: SparkSession) -> list[tuple[str, list[str]]]:
    """(family, n-grams) of each template, in order."""
    rows = [(k, f, t) for k, (f, t) in enumerate(TEMPLATES)]
    df = with_grams(spark.createDataFrame(rows, "k int, family string, line string"))
    return [(r["family"], r["grams"]) for r in df.orderBy("k").collect()]


def _literals(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def vocabulary(spark: SparkSession) -> list[str]:
    """The n-grams of the templates and of ``OTHERS``, some hundreds: no other one has a weight."""
    others = with_grams(spark.createDataFrame([(t,) for t in OTHERS], "line string"))
    return sorted({g for _, gs in template_grams(spark) for g in gs} | {g for r in others.collect() for g in r["grams"]})


def held_grams(paras: DataFrame) -> DataFrame:
    """``paras`` with the n-grams of the vocabulary alone, and with what learning needs of the others:
    a hash of all n-grams (equal texts have one), the half it puts the paragraph in, and
    whether it is ordinary, which it is with words and less than half of each template."""
    spark = paras.sparkSession
    known = vocabulary(spark)
    kept = paras.withColumns({"line_hash": F.xxhash64("grams"), "half": F.pmod(F.hash("grams"), F.lit(2)), "ordinary": F.size("grams") > 0})
    kept = kept.withColumn("grams", F.filter("grams", lambda g: g.isin(known)))
    n, half_of_one = F.size("grams"), F.lit(False)
    for _, grams in template_grams(spark):
        half_of_one |= (n >= len(grams) / 2) & (F.size(F.array_intersect("grams", _literals(grams))) >= len(grams) / 2)
    return kept.withColumn("ordinary", F.col("ordinary") & ~half_of_one)


def fit(docs: DataFrame, **options) -> LicenceModel:
    """The model that ``learn`` makes of all lines of ``docs``."""
    return learn(stored(held_grams(paragraphs(docs))), **options)[0]


def learn(paras: DataFrame, false_rate: float = 0.001, outweigh: float = 8.0) -> tuple[LicenceModel, DataFrame]:
    """The model, and the predictions of all ``paras`` (stored, with ``held_grams``) by it.

    All different ordinary lines stand for unknown paragraphs: one half is trained on, the other
    sets the threshold. A line weighs as much as a variant of a notice, up to ``outweigh`` lines for
    each variant; more lines share that weight evenly, so that no number of them drowns the notices.
    The threshold is the least step of 1 / ``STEPS`` from 0.5 on that at most ``false_rate`` of the other half reach."""
    spark: SparkSession = paras.sparkSession
    names = (UNKNOWN, *sorted({f for f, _ in TEMPLATES}))
    pairs = sorted({g for _, gs in template_grams(spark) for g in gs if " " in g})
    known = [(names.index(f), v) for f, t in TEMPLATES for v in _variants(t)] + [(0, t) for t in NEAR_MISSES for _ in range(4)]
    known += [(0, v) for t in OTHERS for v in _variants(t)[:4]]
    notices = with_grams(spark.createDataFrame(known, "label int, line string"))
    alone = F.col("last") == F.col("paragraph") if "last" in paras.columns else F.lit(True)
    lines = stored(paras.where(alone & F.col("ordinary")).select("line_hash", "half", "pairs", "grams").distinct())
    trained, tested = lines.agg(F.count_if(F.col("half") == 0), F.count_if(F.col("half") == 1)).first()
    weight = min(1.0, outweigh * len(known) / max(1, trained))
    texts = lines.where("half = 0").select(F.lit(0).alias("label"), "grams", "pairs", F.lit(weight).alias("weight"))
    other = F.when(F.col("pairs") > 0, 1 - F.size(F.filter("grams", lambda g: g.isin(pairs))) / F.col("pairs")).otherwise(1.0)
    train = notices.withColumn("weight", F.lit(1.0)).unionByName(texts).withColumn("other", other)
    words_known = vocabulary(spark)
    present = CountVectorizerModel.from_vocabulary(words_known, inputCol="grams", outputCol="present", binary=True)
    data = VectorAssembler(inputCols=["present", "other"], outputCol="features").transform(present.transform(train))
    regression = LogisticRegression(family="multinomial", elasticNetParam=0.5, regParam=0.0005, maxIter=60, weightCol="weight")
    model = regression.fit(data.select("label", "features", "weight"))
    weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    kept = set(pairs)
    rows = tuple((g, tuple(map(float, weights[:, k])), g in kept) for k, g in enumerate(words_known) if g in kept or weights[:, k].any())
    made = LicenceModel(names, tuple(map(float, bias)), tuple(map(float, weights[:, -1])), 0.5, rows)
    found = stored(predict(paras, made))
    wrong = found.where(alone & F.col("ordinary") & (F.col("half") == 1)).select("line_hash", "probability").dropDuplicates(["line_hash"])
    steps = wrong.groupBy(F.floor(F.col("probability") * STEPS).alias("step")).count().collect()
    left, threshold = int(tested * false_rate), made.threshold
    for step, n in sorted(map(tuple, steps), reverse=True):
        left -= n
        if left < 0:
            threshold = (step + 1) / STEPS
            break
    return replace(made, threshold=threshold), found.where(F.col("probability") >= threshold)


def predict(paras: DataFrame, model: LicenceModel) -> DataFrame:
    """row, doc_id, paragraph, family, probability and the template n-grams held (grams), where a
    family is predicted. Only the model's n-grams survive the first join; a paragraph without any
    is unknown."""
    size = len(model.names)
    table = paras.sparkSession.createDataFrame([(g, list(w), p) for g, w, p in model.rows], "gram string, weights array<double>, pair boolean")
    # the outer form lets no filter on the array slip below the steps that make it
    key = [c for c in ("row", "doc_id", "paragraph", "last", "line_hash", "half", "ordinary") if c in paras.columns]
    hits = paras.select(*key, "pairs", F.explode_outer("grams").alias("gram")).join(F.broadcast(table), "gram")
    sums = hits.groupBy(*key, "pairs").agg(
        F.sum(F.col("pair").cast("int")).alias("known"), F.collect_list("gram").alias("grams"),
        *[F.sum(F.col("weights")[k]).alias(f"w{k}") for k in range(size)])
    other = F.when(F.col("pairs") > 0, 1 - F.col("known") / F.col("pairs")).otherwise(1.0)
    logit = F.array(*[F.col(f"w{k}") + model.intercepts[k] + other * model.others[k] for k in range(size)])
    scored = sums.select(*key, "grams", logit.alias("logit")).withColumn("top", F.array_max("logit"))
    best = F.array_position("logit", F.col("top")).cast("int")
    total = F.aggregate("logit", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    out = scored.select(*key, "grams", F.element_at(_literals(list(model.names)), best).alias("family"),
                        (1 / total).alias("probability"))
    return out.where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))


def scan(docs: DataFrame, confirm: float = 0.6, **options) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity (the largest share of the 2-grams of a
    template of that family that the paragraph holds) and confirmed (similarity >= ``confirm``),
    for every paragraph with a predicted family. A confirmed run of lines stands for its lines,
    under the first one's number, where none of them is confirmed alone."""
    _, found = learn(stored(held_grams(with_wrapped(docs))), **options)
    share, told = F.lit(0.0), F.lit(False)
    for family, grams in template_grams(docs.sparkSession):
        pairs = [g for g in grams if " " in g]
        held = F.size(F.array_intersect("grams", _literals(pairs))) / len(pairs)
        needed = telling(pairs)
        here = F.col("family") == family
        share = F.greatest(share, F.when(here, held).otherwise(0.0))
        if needed:
            here &= F.size(F.array_intersect("grams", _literals(needed))) == len(needed)
        told |= here & (held >= confirm)
    found = found.select("row", "doc_id", "paragraph", "last", "family", "probability", share.alias("similarity"), told.alias("confirmed"))
    alone = F.col("last") == F.col("paragraph")
    # of the confirmed runs from one line on, the one with most of a template, then the shortest
    longest = Window.partitionBy("row", "paragraph", alone).orderBy(F.desc("similarity"), "last")
    spans = found.where(alone | F.col("confirmed")).withColumn("n", F.row_number().over(longest)).where("n = 1")
    each = spans.withColumn("line", F.explode(F.sequence("paragraph", "last")))
    # a run stays where it is the best on all its lines; lines confirmed alone come before any run
    order = Window.partitionBy("row", "line").orderBy(
        F.desc(F.col("confirmed") & alone), F.desc("confirmed"), F.desc("similarity"), F.col("last") - F.col("paragraph"), "paragraph")
    best = F.max("n").over(Window.partitionBy("row", "paragraph", "last")) == 1
    each = each.withColumn("n", F.row_number().over(order)).withColumn("best", best & ~alone)
    each = each.withColumn("covered", F.max("best").over(Window.partitionBy("row", "line")))
    kept = each.where((F.col("line") == F.col("paragraph")) & (F.col("best") | alone & (F.col("confirmed") | ~F.col("covered"))))
    return kept.select("doc_id", "paragraph", "family", "probability", "similarity", "confirmed")
