"""Licence scan: a trained paragraph classifier with template confirmation.

A sparse logistic regression over the words and word pairs of notice templates, trained on
variants of them against all lines of the corpus, scores every line of every document that
is not blank. The score a family must reach is calibrated on a fifth of the lines, held out from training.
A line is reported if it holds a cue word, or if it reaches that score with evidence: a
word or pair of a template of its family that at most two families and at most
``FALSE_SHARE`` of the corpus lines have. Reported lines that
follow each other without the end of a sentence are one paragraph, scored again as a
whole. A paragraph is confirmed if it has the score and evidence and shares enough of its words and word pairs with a
template of its family; every other reported paragraph is ``unknown``.

The negatives are all lines of all documents, with and without cues, but without those that
a template confirms. The regression reads of a line only the words and pairs that its
positives have, so lines that hold the same of them are one weighted example: the fit, the
counts behind the evidence and the calibration are those of all lines.
Expressions and the regression run on the JVM.

Defined results: a null or empty text has no paragraphs and an empty list. Repeated rows
are scanned alike; a null id is kept, and rows that share an id have their own paragraphs. No documents give no rows. Ties between families go
to the first by name. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import bound, join_small, stage, text_of

CUE = "(?i)licen[cs]|copyright|copyleft|warrant|permission is|redistribut|public domain|all rights reserved|creative commons"
FILLED = r"[^\x20\x09-\x0D]"
SENTENCE_END = r"[.!?:;][\x20\x09-\x0D]*\z"
VARIANTS = 12
FALSE_SHARE = 0.001
OVERLAP = 0.6
BINS = 1000

# Customary notices, by family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "bsd": (
        "This software is released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Distributed under the GPLv3.",
        "Licensed under the GNU GPL, version 3 or later.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "Licensed under the GNU LGPL, version 2.1."),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited.",),
    "public-domain": ("This work is dedicated to the public domain under CC0 1.0 Universal.",),
}
FAMILIES = tuple(sorted(TEMPLATES))


def gram_words(line: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(line), "[^\\p{L}\\p{N}]+", " "), " "), "")


def grams(words: Column) -> Column:
    """Words and pairs of neighbours."""
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, F.filter(pairs, lambda p: p.isNotNull()))


def text_key(text: Column) -> Column:
    """What stands for a text beside its id when rows are joined again."""
    return F.md5(text)


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, i, text) for family in FAMILIES for i, text in enumerate(TEMPLATES[family])]
    return spark.createDataFrame(rows, "family string, i int, line string")


def among(values: list[str]):
    return lambda gram: gram.isin(values)


def overlaps(spark: SparkSession, held: Column, size: Column) -> dict[str, Column]:
    """Per family the share of a line's ``size`` grams, of which it has ``held``, that the best of its templates has."""
    # The templates are a fixed short list: their grams are literals.
    known = templates(spark).select("family", grams(gram_words(F.col("line"))).alias("grams")).collect()
    out = {}
    for family in FAMILIES:
        shares = [
            F.size(F.filter(held, among(set_))) / F.least(F.greatest(size, F.lit(1)), F.lit(len(set_)))
            for set_ in (sorted(set(r["grams"])) for r in known if r["family"] == family)
        ]
        out[family] = F.greatest(*shares) if len(shares) > 1 else shares[0]
    return out


def variants(spark: SparkSession) -> DataFrame:
    """The positives: ``label`` 1.. for the families, ``line`` and its ``grams``."""
    families = F.array(*map(F.lit, FAMILIES))
    # Variant 0 is the whole notice; the others leave out about an eighth of the words.
    dropped = F.filter(
        F.split("line", " "), lambda w: (F.col("v") == 0) | (F.pmod(F.xxhash64(w, F.col("v"), F.lit(3)), F.lit(8)) != 0)
    )
    return templates(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1)))).select(
        F.array_position(families, F.col("family")).cast("double").alias("label"), F.array_join(dropped, " ").alias("line")
    ).withColumn("grams", grams(gram_words(F.col("line"))))


def vocabulary(spark: SparkSession) -> list[str]:
    """Words and pairs of the positives, a fixed short list."""
    return [r["gram"] for r in variants(spark).select(F.explode("grams").alias("gram")).distinct().orderBy("gram").collect()]


def held_out(line: Column) -> Column:
    return F.pmod(F.xxhash64(line, F.lit(9)), F.lit(5)) == 0


def examples(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Training lines, ``n`` alike ones in a row: ``label`` 0 for corpus lines, 1.. for the families, null for lines that may be notices."""
    spark = docs.sparkSession
    positive = variants(spark).select("label", held_out(F.col("line")).alias("held"), "grams", F.lit(1).cast("bigint").alias("n"))
    first = sorted({g.split(" ")[0] for g in vocabulary if " " in g})
    own = F.col("own")
    pairs = F.zip_with(
        own, F.slice(own, F.lit(2), F.greatest(F.size(own), F.lit(1))), lambda a, b: F.when(a.isin(first), F.concat(a, F.lit(" "), b))
    )
    lines = docs.select(F.explode(F.split(text_of(docs), "\n")).alias("line")).filter(F.col("line").rlike(FILLED)).select(
        held_out(F.col("line")).alias("held"), gram_words(F.col("line")).alias("own")
    ).withColumn("grams", F.array_sort(F.array_distinct(F.concat(F.filter("own", among(vocabulary)), F.filter(pairs, among(vocabulary))))))
    # Lines that a template confirms may be notices, all others count as none. A line has at
    # least as many grams as different words, so most need no count of their pairs.
    best = lambda size: F.coalesce(F.greatest(*overlaps(spark, F.col("grams"), size).values()), F.lit(0.0))
    confirmed = F.when(best(F.size(F.array_distinct("own"))) < OVERLAP, False).otherwise(
        best(F.size(F.array_distinct(grams(own)))) >= OVERLAP
    )
    # A label, not a filter, which Spark would push below the columns and compute them again for.
    negative = lines.withColumn("label", F.when(confirmed, F.lit(None)).otherwise(F.lit(0.0)))
    return positive.unionByName(negative.groupBy("label", "held", "grams").agg(F.count(F.lit(1)).alias("n")))


def evidence(known: DataFrame) -> tuple[dict[str, list[str]], list[str]]:
    """Per family the words and pairs of its templates that few families and few corpus lines have.

    Also a list of words of which every such word or pair has one.
    """
    of_templates = templates(known.sparkSession).select("family", F.explode(grams(gram_words(F.col("line")))).alias("gram")).distinct()
    lines = known.filter("label = 0")
    seen = lines.select("n", F.explode("grams").alias("gram")).join(
        F.broadcast(of_templates.select("gram").distinct()), "gram", "left_semi"
    ).groupBy("gram").agg(F.sum("n").alias("count")).collect()  # at most one row a gram of the templates
    most = FALSE_SHARE * (lines.agg(F.sum("n")).first()[0] or 0)
    common = {r["gram"] for r in seen if r["count"] > most}
    families: dict[str, list[str]] = {}
    for r in of_templates.collect():
        families.setdefault(r["gram"], []).append(r["family"])
    evident = {
        family: sorted(g for g, of in families.items() if family in of and len(of) <= 2 and g not in common)
        for family in FAMILIES
    }
    counts = {r["gram"]: r["count"] for r in seen}
    rarest = lambda gram: min(gram.split(" "), key=lambda w: (counts.get(w, 0), w))
    return evident, sorted({rarest(g) for words in evident.values() for g in words})


def trained(docs: DataFrame) -> tuple[PipelineModel, float, dict[str, list[str]], list[str]]:
    """The fitted classifier, the calibrated score, the evidence and words that every evidence has one of."""
    words = vocabulary(docs.sparkSession)
    known = stage(examples(docs, words), "licence-examples")
    fitted = known.filter("not held and label is not null")
    sizes = {r["label"]: r["n"] for r in fitted.groupBy("label").agg(F.sum("n").alias("n")).collect()}  # one row a class
    total = sum(sizes.values())
    weight = F.lit(1.0)
    for label, count in sizes.items():
        weight = F.when(F.col("label") == label, total / len(sizes) / count).otherwise(weight)
    model = Pipeline(stages=[
        CountVectorizerModel.from_vocabulary(words, inputCol="grams", outputCol="features").setBinary(True),
        LogisticRegression(weightCol="weight", family="multinomial", regParam=1e-4, maxIter=30, standardization=False),
    ]).fit(fitted.withColumn("weight", weight * F.col("n")))
    scores = stage(best_family(model, known.filter("held and label = 0")).select("score", "n"), "licence-scores")
    return model, quantile(scores, FALSE_SHARE), *evidence(known)


def quantile(scores: DataFrame, share: float) -> float:
    """The least ``score`` from 0.5 on that at most ``share`` of the rows, each counted ``n`` times, exceed."""
    left = share * (scores.agg(F.sum("n")).first()[0] or 0)
    low, high = 0.5, 1.0
    while True:
        # Exact: the bin that holds the score is divided again until it holds one value.
        bin_ = F.least(F.floor((F.col("score") - low) / (high - low) * BINS), F.lit(BINS - 1))
        bins = scores.filter((F.col("score") >= low) & (F.col("score") <= high)).groupBy(bin_.alias("bin")).agg(
            F.sum("n").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")
        ).orderBy(F.desc("bin")).collect()  # at most BINS rows
        for r in bins:
            if r["n"] > left:
                break
            left -= r["n"]
        else:
            return 0.5
        if r["low"] == r["high"]:
            return r["low"]
        low, high = r["low"], r["high"]


def best_family(model: PipelineModel, lines: DataFrame) -> DataFrame:
    """Add the likeliest family and its score to lines with ``grams``."""
    scores = F.slice(vector_to_array("probability"), 2, len(FAMILIES))
    return (
        model.transform(lines).withColumn("_scores", scores).withColumn("score", F.array_max("_scores"))
        .withColumn("family", F.get(F.array(*map(F.lit, FAMILIES)), F.array_position("_scores", F.col("score")).cast("int") - 1))
        .drop("_scores", "features", "rawPrediction", "probability", "prediction")
    )


def found_licenses(docs: DataFrame) -> DataFrame:
    """One row per reported paragraph of a distinct id and text: both keys, number of its first line, text, family, score, overlap."""
    model, threshold, known, anchors = trained(docs)
    shown = F.lit(False)
    for family, words in known.items():
        if words:
            shown = F.when(F.col("family") == family, F.arrays_overlap("grams", F.array(*map(F.lit, words)))).otherwise(shown)
    sure = (F.col("score") >= threshold) & shown
    every = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("_text")).select(
        "doc_id", text_key(F.col("_text")).alias("text_key"), F.posexplode_outer(F.split("_text", "\n")).alias("line_no", "line")
    ).filter(F.col("line").rlike(FILLED))
    # Exact: only a line with a cue or an evidence can be reported. A pair is looked for by
    # the one of its words that fewer lines have, and only then as a pair.
    has_cue = F.col("line").rlike(CUE)
    shown_words = sorted({w for words in known.values() for w in words})
    some_evidence = bound(gram_words(F.col("line")), lambda own: F.exists(own, among(anchors)) & F.exists(grams(own), among(shown_words)))
    hinted = stage(every.filter(has_cue | some_evidence), "licence-hinted")
    # A line that stands in many texts is scored once.
    distinct = hinted.select("line").distinct().withColumn("grams", grams(gram_words(F.col("line")))).filter(F.size("grams") > 0)
    wanted = stage(best_family(model, distinct).filter(has_cue | sure).select("line"), "licence-wanted")
    reported = stage(join_small(hinted, wanted, ["line"], wanted.count(), 512, how="left_semi").distinct(), "licence-lines")
    # A reported line goes on in the next one unless a sentence ends with it.
    in_text = Window.partitionBy("doc_id", "text_key").orderBy("line_no")
    goes_on = (F.lag("line_no").over(in_text) == F.col("line_no") - 1) & ~F.lag("line").over(in_text).rlike(SENTENCE_END)
    runs = reported.withColumn("first", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("line_no"))).withColumn(
        "first", F.last("first", True).over(in_text)
    )
    paragraphs = runs.groupBy("doc_id", "text_key", "first").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("lines")
    ).select("doc_id", "text_key", F.col("first").alias("line_no"), F.array_join(F.col("lines.line"), " ").alias("line")).withColumn(
        "grams", grams(gram_words(F.col("line")))
    )
    named = best_family(model, paragraphs)
    overlap = F.lit(0.0)
    own_grams = F.array_distinct("grams")
    for family, share in overlaps(docs.sparkSession, own_grams, F.size(own_grams)).items():
        overlap = F.when(F.col("family") == family, share).otherwise(overlap)
    return named.withColumn("overlap", overlap).withColumn(
        "family", F.when(sure & (F.col("overlap") >= OVERLAP), F.col("family")).otherwise("unknown")
    ).select("doc_id", "text_key", "line_no", "line", "family", "score", "overlap")


def scanned(docs: DataFrame) -> DataFrame:
    """Every document with its licence paragraphs, in one row, without a shuffle of texts.

    What is found is joined to the rows by id and text, so rows that share an id or have
    none get the paragraphs of their own text. A list is bounded by the lines of one text.
    """
    found = stage(found_licenses(docs), "licence-found")
    by_text = found.groupBy("doc_id", "text_key").agg(
        F.sum(F.when(F.col("family") != "unknown", 1).otherwise(0)).alias("n_licenses"),
        F.sum(F.when(F.col("family") == "unknown", 1).otherwise(0)).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "family"))), lambda e: F.concat_ws(":", e["line_no"], e["family"])), ",").alias("spans"),
    ).withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    rows = docs.select(docs["doc_id"].alias("doc_id"), text_key(text_of(docs)).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key"))
    return rows.join(by_text, same, "left").select(
        "doc_id", F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"), F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"),
        F.coalesce("families", F.lit("")).alias("families"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
