"""Licence scans: a trained paragraph classifier whose predictions a template comparison confirms.

Paragraphs become sparse indicators of the word uni- and bigrams known from licence notices; a
multinomial logistic regression names the licence family or none, and a family counts only above a
threshold calibrated on held-out paragraphs without licences, for a rate of false positives. All lines of the table take part. Every line is scored as a paragraph;
as notices are often wrapped, lines with a word of notices are scored once more, joined with those around them up to a
blank one. DataFrame and SQL functions only.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.decontam import tokens
from cairn.llm.support import bounded, materialize

UNKNOWN = "unknown"
# Notices in common wordings, some of them the publishers' own.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Licensed under the MIT License. See the LICENSE file in the project root for full license information."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 3."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("bsd", "Licensed under the BSD 3-Clause License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "Released into the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without prior written permission of the copyright holder."),
    ("proprietary", "All rights reserved."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Distributed under the MIT License."),
    ("apache", "Licensed under the Apache License 2.0."),
    ("apache", "Released under the Apache 2.0 license."),
    ("gpl", "Licensed under the GNU General Public License."),
    ("gpl", "Licensed under the GPL version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd", "Distributed under the BSD License."),
    ("mpl", "Licensed under the Mozilla Public License 2.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    *((family, f"SPDX-License-Identifier: {name}") for family, name in (("mit", "MIT"), ("apache", "Apache-2.0"), ("gpl", "GPL-3.0-or-later"), ("gpl", "GPL-2.0-only"), ("lgpl", "LGPL-3.0-or-later"), ("agpl", "AGPL-3.0-or-later"), ("bsd", "BSD-3-Clause"), ("mpl", "MPL-2.0"), ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"), ("cc0", "CC0-1.0"))),
    (UNKNOWN, "The driver must carry a valid license and permission from the owner at all times."),
    (UNKNOWN, "She was released under the terms of the agreement with the public office."),
    (UNKNOWN, "This version of the program is useful for general work and free for any person to use."),
    (UNKNOWN, "A copy of the document was distributed to the public along with the software."),
    (UNKNOWN, "The fishing licence is granted free of charge by the national park."),
)
FAMILIES = (UNKNOWN, *sorted({f for f, _ in TEMPLATES} - {UNKNOWN}))
#: What all lines of the corpus that stand for no licence weigh together in training; worn notices weigh one each.
PLAIN_WEIGHT = 3000
#: First words of a line that may stand beside a worn notice.
HEAD = 20
#: Steps between 0 and 1 in which the threshold is found.
STEPS = 100_000
#: Worn copies of every notice in training: each lacks about one word in eight, some stand among other words.
COPIES = 24
#: Share of a template's bigrams that a paragraph must hold.
CONTAINED = 0.8
#: Share of the held-out paragraphs without a licence that may pass the threshold.
FALSE_POSITIVES = 0.005
#: Paragraphs with such a word or pair may be notices that no template words; they don't stand for no licence.
CUE_WORDS = r"^(un|sub|re)?licen[cs](e|es|ed|ee|or|ing)$|^copyright(ed|s)?$|^copyleft$|^warrant(y|ies)$|^redistribut"
CUE_PAIRS = ("rights reserved", "public domain")
#: A line with a cue has one of these in lower case.
CUE_PIECES = ("licen", "copyright", "copyleft", "warrant", "redistribut", "reserved", "domain")
#: Lines before a line with such a word that may belong to its notice; twice as many may follow it.
AROUND = 8
WRAPPED = r"(?i)licen[cs]e|copyright|warrant|redistribut|permission|permitted|software|creative commons|public domain|rights reserved|apache\.org"


def literal_rows(spark: SparkSession, rows, names: tuple[str, ...]) -> DataFrame:
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def license_words(body: Column) -> Column:
    """Tokens, the British spelling read as the American one."""
    return tokens(F.replace(F.lower(body), F.lit("licence"), F.lit("license")))


def bigrams(words: Column) -> Column:
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))
    return F.transform(F.filter(pairs, lambda p: p["b"].isNotNull()), lambda p: F.concat_ws(" ", p["a"], p["b"]))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, body): the lines of every text that hold a letter or digit, and so a word."""
    lines = docs.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("paragraph", "body"))
    return lines.where(F.col("body").rlike(r"[\p{L}\p{N}]"))


def templates(spark: SparkSession) -> DataFrame:
    rows = literal_rows(spark, [(k, f, t) for k, (f, t) in enumerate(TEMPLATES)], ("template", "family", "body"))
    words = rows.select("template", "family", license_words(F.col("body")).alias("words"))
    return materialize(words.withColumn("bigrams", F.array_distinct(bigrams(F.col("words")))))


def vectorize(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    paired = NGram(n=2, inputCol="words", outputCol="pairs").transform(rows)
    grams = paired.withColumn("grams", F.concat("words", "pairs")).drop("pairs")
    return CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True).transform(grams).drop("grams")


def vocabulary_of(known: DataFrame) -> list[str]:
    """The uni- and bigrams of the notices, a few hundred."""
    real = known.where(F.col("family") != UNKNOWN)
    return sorted(r[0] for r in real.select(F.explode(F.concat("words", "bigrams"))).distinct().collect())


def featured(found: DataFrame, known: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, paragraph, line, head, features, plain) of the paragraphs, written once for training and scoring.

    line is the hash of the body, head its first words. plain is false for lines that may be notices: with a cue, or with
    CONTAINED of a template's bigrams.
    """
    rows = found.select("doc_id", "paragraph", F.xxhash64("body").alias("line"), F.lower("body").alias("low"), license_words(F.coalesce("body", F.lit(""))).alias("words"))
    rows = NGram(n=2, inputCol="words", outputCol="pairs").transform(rows)
    # the exact rules look at few lines only: at those with a piece of a cue, and those with one of so many bigrams of a template that not all may be missing
    piece = F.lit(False)
    for part in CUE_PIECES:
        piece = piece | F.contains("low", F.lit(part))
    cued = F.exists("words", lambda w: w.rlike(CUE_WORDS)) | F.arrays_overlap("pairs", F.array(*map(F.lit, CUE_PAIRS)))
    notices = [r[0] for r in known.where(F.col("family") != UNKNOWN).select("bigrams").collect()]
    held = [math.ceil(CONTAINED * len(pairs) - 1e-9) for pairs in notices]
    index = sorted({p for pairs, n in zip(notices, held, strict=True) for p in sorted(pairs, key=lambda p: (-len(p), p))[: len(pairs) - n + 1]})
    templates_ = F.array(*(F.struct(F.array(*map(F.lit, pairs)).alias("pairs"), F.lit(n).alias("n")) for pairs, n in zip(notices, held, strict=True)))
    holds = F.exists(templates_, lambda c: F.size(F.array_intersect(c["pairs"], F.col("pairs"))) >= c["n"])
    near = F.arrays_overlap("pairs", F.array(*map(F.lit, index)))
    notice = F.when(piece, cued).otherwise(False) | F.when(near, holds).otherwise(False)
    grams = rows.select("doc_id", "paragraph", "line", F.slice("words", 1, HEAD).alias("head"), (~notice).alias("plain"), F.concat("words", "pairs").alias("grams"))
    return materialize(CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True).transform(grams).drop("grams"))


def train(found: DataFrame, known: DataFrame, lines: DataFrame | None = None) -> tuple[list[str], LogisticRegressionModel, float]:
    """Vocabulary, model and threshold: the family probability that a share FALSE_POSITIVES at most of the held-out paragraphs without a licence reach.

    Every distinct line that may stand for no licence takes part, one in four of them held out. Those fitted weigh PLAIN_WEIGHT together,
    so the balance with the worn notices doesn't depend on the size of the table. ``lines`` are ``featured`` paragraphs.
    """
    vocabulary = vocabulary_of(known)
    lines = featured(found, known, vocabulary) if lines is None else lines
    real = lines.where("plain").groupBy("line").agg(F.first("features").alias("features"))
    plain = materialize(real.withColumn("held_out", F.pmod(F.xxhash64(F.lit("held"), "line"), F.lit(4)) == 0))
    at = F.pmod(F.xxhash64(F.lit("at"), "line"), F.lit(997)).cast("int")
    noise = materialize(lines.where("plain").groupBy(at.alias("at")).agg(F.min("head").alias("noise")))
    copies = known.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    worn = F.filter("words", lambda w, k: (F.col("copy") % 2 == 0) | (F.pmod(F.xxhash64(w, k, F.col("copy")), F.lit(8)) > 0))
    copies = copies.withColumn("worn", worn).withColumn("at", F.pmod(F.xxhash64("template", "copy"), F.lit(997)).cast("int"))
    beside = F.slice(F.coalesce("noise", F.array().cast("array<string>")), 1, F.lit(4) * (F.col("copy") % 6))
    notices = copies.join(F.broadcast(noise), "at", "left").select(F.concat("worn", beside).alias("words"), "family", "copy")
    label = (F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1).cast("double")
    rows = vectorize(notices.withColumn("label", label).withColumn("held_out", F.pmod(F.xxhash64("words", "copy"), F.lit(4)) == 0), vocabulary)
    rows = materialize(rows.select("features", "label", F.lit(1.0).alias("weight"), "held_out"))
    fitted, held = (n or 0 for n in plain.agg(F.count_if(~F.col("held_out")), F.count_if("held_out")).first())
    weight = min(1.0, PLAIN_WEIGHT / max(1, fitted))
    plain = plain.select("features", F.lit(0.0).alias("label"), F.lit(weight).alias("weight"), "held_out")
    # copies of the notices are few and lie in one partition, so what they add up to doesn't depend on the cluster
    data = rows.coalesce(1).unionByName(plain).where(~F.col("held_out")).select("features", "label", "weight")
    model = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, weightCol="weight").fit(data)
    apart = rows.where(F.col("held_out") & (F.col("label") == 0)).unionByName(plain.where("held_out"))
    p = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES)))
    steps = model.transform(apart).select(F.floor(p * STEPS).alias("step")).groupBy("step").count()
    tail = {r["step"]: r["count"] for r in steps.where(F.col("step") >= STEPS // 2).collect()}
    allowed = FALSE_POSITIVES * (held + rows.where(F.col("held_out") & (F.col("label") == 0)).count())
    passing, threshold = 0, 1.0
    for step in range(STEPS, STEPS // 2 - 1, -1):
        passing += tail.get(step, 0)
        if passing > allowed:
            break
        threshold = step / STEPS
    return vocabulary, model, threshold


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, family, probability, template, overlap, confirmed) for paragraphs predicted to name a licence.

    paragraph counts a document's lines from 0. overlap is the largest share of a family template's word
    bigrams that the paragraph holds, template the first with that share, and a prediction is confirmed from CONTAINED on.
    Whole texts are scored, whatever their length. A notice that only lines together confirm has one row, at its first line
    with a word of notices.

    Null and empty texts have no paragraphs. Rows without a doc_id are scanned line by line and keep their null id. Repeated
    rows are scanned each, but give one row for lines joined up. An empty table gives no rows. Other columns are ignored.
    """
    known = templates(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = paragraphs(docs)
    vocabulary = vocabulary_of(known)
    scored_once = featured(found, known, vocabulary)
    _, model, threshold = train(found, known, scored_once)
    model = model.setPredictionCol("").setRawPredictionCol("")

    def judged(rows: DataFrame) -> DataFrame:
        """The rows(doc_id, paragraph, features) that are predicted to name a licence, compared with its templates."""
        scored = model.transform(rows.select("doc_id", "paragraph", "features")).withColumn("p", vector_to_array("probability"))
        best = scored.select("doc_id", "paragraph", "features", "p", F.array_max(F.slice("p", 2, len(FAMILIES))).alias("probability"))
        named = best.where((F.col("probability") >= threshold) & (F.col("probability") == F.array_max("p")))
        family = F.get(F.array(*map(F.lit, FAMILIES)), (F.array_position("p", F.col("probability")) - 1).cast("int"))
        # the features of a line name all bigrams of templates that it holds
        grams = F.transform(vector_to_array("features"), lambda x, i: F.when(x > 0, F.get(F.array(*map(F.lit, vocabulary)), i)))
        return compared(named.select("doc_id", "paragraph", "probability", F.filter(grams, lambda g: F.contains(g, F.lit(" "))).alias("pairs"), family.alias("family")), known)

    def worded(rows: DataFrame) -> DataFrame:
        return vectorize(rows.select("doc_id", "paragraph", license_words(F.coalesce("body", F.lit(""))).alias("words")), vocabulary)

    sure = F.col("overlap") >= CONTAINED
    lines = materialize(judged(scored_once))
    joined = materialize(judged(worded(wrapped(docs, lines.where(sure)))).where(sure).groupBy("doc_id", "paragraph").agg(F.max_by(F.struct("family", "probability", "overlap", "template"), "overlap").alias("r")).select("doc_id", "paragraph", "r.*"))
    rest = lines.join(joined.select("doc_id", "paragraph"), ["doc_id", "paragraph"], "left_anti")
    return rest.unionByName(joined, allowMissingColumns=True).select("doc_id", F.col("paragraph").cast("long").alias("paragraph"), "family", "probability", F.col("template").cast("long").alias("template"), "overlap", sure.alias("confirmed"))


def compared(named: DataFrame, known: DataFrame) -> DataFrame:
    """``named(…, family, pairs)`` with overlap, the largest share of a template's bigrams that ``pairs`` has, and template, the first with it."""
    choices = known.where(F.col("family") != UNKNOWN).groupBy("family").agg(F.array_sort(F.collect_list(F.struct("template", "bigrams"))).alias("choices"))
    shares = F.transform("choices", lambda c: F.struct((F.size(F.array_intersect(c["bigrams"], F.col("pairs"))) / F.size(c["bigrams"])).alias("overlap"), (-c["template"]).alias("least")))
    most = named.join(F.broadcast(choices), "family").withColumn("m", F.array_max(shares))
    return most.select(*named.columns, F.col("m.overlap").alias("overlap"), (-F.col("m.least")).alias("template")).drop("pairs")


def wrapped(docs: DataFrame, strong: DataFrame) -> DataFrame:
    """(doc_id, paragraph, body): lines with a word of notices, joined with those around them.

    A line stands for those after it until a blank one (one without a letter or digit), or until AROUND lines further on. The body
    has up to AROUND lines before it and twice as many behind, none beyond a blank one, and none of ``strong(doc_id, paragraph)``, which
    are notices by themselves. Rows without a doc_id aren't joined up.
    """
    texts = docs.where(F.col("doc_id").isNotNull() & F.contains("text", F.lit("\n")) & F.col("text").rlike(WRAPPED))
    lists = strong.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set(F.col("paragraph").cast("int")).alias("strong"))
    known = texts.join(bounded(materialize(lists)), "doc_id", "left").withColumn("strong", F.coalesce("strong", F.array().cast("array<int>")))
    # an outer explode of one array: the text is split once, however many lines of it are looked at
    split = known.select("doc_id", "strong", F.explode_outer(F.array(F.split("text", "\n"))).alias("lines"))
    blank = lambda i: ~F.get("lines", i).rlike(r"[\p{L}\p{N}]")
    cues = F.filter(F.transform("lines", lambda line, i: F.when(line.rlike(WRAPPED) & ~F.array_contains("strong", i), i)), lambda i: i.isNotNull())
    split = split.withColumn("cues", cues).where(F.size("cues") > 0)

    def first(state: Column, k: Column) -> Column:
        last = F.try_element_at(state, F.lit(-1))
        between = F.exists(F.sequence(last, k), blank)
        return F.when(F.size(state) == 0, F.array(k)).when((k - last > AROUND) | between, F.concat(state, F.array(k))).otherwise(state)

    heads = F.aggregate("cues", F.array().cast("array<int>"), first)

    def body(k: Column) -> Column:
        near = F.sequence(F.greatest(k - AROUND, F.lit(0)), F.least(k + 2 * AROUND, F.size("lines") - 1))
        gaps = F.filter(near, blank)
        start, stop = F.array_max(F.filter(gaps, lambda i: i < k)), F.array_min(F.filter(gaps, lambda i: i > k))
        mine = F.filter(near, lambda i: (i > F.coalesce(start, F.lit(-1))) & (i < F.coalesce(stop, F.size("lines"))) & ~F.array_contains("strong", i))
        return F.when(F.size(mine) > 1, F.array_join(F.transform(mine, lambda i: F.get("lines", i)), " "))

    parts = split.select("doc_id", F.explode_outer(F.transform(heads, lambda k: F.struct(k.alias("paragraph"), body(k).alias("body")))).alias("p"))
    return parts.select("doc_id", "p.*").where("body IS NOT NULL")
