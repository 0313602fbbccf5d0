"""Licence scans: a trained paragraph classifier in DataFrame functions only.

A paragraph is a line of text or a run of consecutive lines that hold words, as
in wrapped notices; lines without a letter or digit (blank lines, bare comment
marks) end a run. Its features are the distinct one- and two-word
sequences of its lowered words. A multinomial logistic regression over them
tells licence families from each other and from the class ``unknown``; it is
trained on variants of notice templates (words left out, cut at either end), on
ordinary sentences that speak of licences, and as ``unknown`` on a bounded sample
of the corpus's own paragraphs: at most ``sample_paragraphs`` of at most
``sample_docs`` distinct texts, drawn by hash from their whole length; a longer
paragraph counts as several of ``piece_words`` words. A temperature fitted on held-out
examples calibrates the probabilities. A family is reported when its calibrated
probability reaches ``least_probability``; it is confirmed when the paragraph
holds at least ``least_overlap`` of the word pairs of one of its templates.

A paragraph may hold several notices, as when two follow each other without a
blank line. Where templates of more than one family agree with it, the notices
are taken off one by one: the likeliest family that a template confirms is
noted, the template's words and pairs are subtracted as often as they occur
together, and the rest is classified again, until no template agrees. So a family
whose wording is only part of another's is not reported beside it. Families of
which 80 % or more of a template are there aren't weighed against each other.

Every paragraph is scored. Only grams of the licence examples have weights, so a
paragraph is reduced to these; one is left out of the join with the weights only
if an upper bound of its score shows that ``unknown`` wins. Paragraphs with the
same weighted grams are scored once and share the result. A run is reported at
its first line, unless one of its lines already tells as much: the same family,
and confirmed if the run is. Known limits: a wrapped notice within a run of
ordinary prose is judged with that prose, and the variants of one template lie on
both sides of the split that the temperature is fitted by.

Defined cases: NULL and empty texts have no paragraphs; rows with NULL or
repeated ids are scanned like others, repeated rows give their results as often;
a paragraph may have any length; of families with equal scores the first of the
alphabet wins; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, exp, log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Workspace, unit_hash

UNKNOWN = "unknown"

#: Notices by family: fixed wordings as licences prescribe them or projects use them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "License: Apache 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "Licensed under the GPLv3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "Distributed under the GPL, version 2."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1 or later."),
    ("LGPL", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License."),
    ("AGPL", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-ND", "Licensed under CC BY-ND 4.0."),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2 or later."),
    ("EUPL-1.2", "This work is licensed under the European Union Public Licence, version 1.2."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Use, modification and distribution are subject to the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib", "Released under the zlib License."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without the prior written permission of the owner."),
    ("Proprietary", "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited."),
)

#: Sentences with the same words that grant nothing.
ORDINARY: tuple[str, ...] = (
    "The driver showed a driving license at the border.", "He was licensed to practise medicine in that state.",
    "A fishing license costs ten dollars for a season.", "The restaurant lost its liquor license last year.",
    "She asked for permission to leave the room.", "The warranty of the washing machine ends in May.",
    "The public library opens at nine on Monday.", "We compared copyright law in three countries.",
    "The general asked the public to stay calm.", "A creative mind needs free time.", "The new version of the song was released today.",
    "The institute at MIT published a study on rivers.", "Apache helicopters flew over the valley.",
    "The commons are open to all walkers.", "The software was slow and the source of the error unknown.",
    "Conditions on the road were bad and redistribution of food was late.", "The foundation paid for a free copy of the book.",
    "Modification of the house needs a permit.", "The domain of the function is the positive numbers.",
    "The rights of the tenants are reserved in the contract.", "Distribution of the file took two hours.",
)


def paragraph_words(paragraph: Column) -> Column:
    """Lowered words: runs of letters, digits, ``.`` and ``+`` inside them."""
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]+(?:[.+][\p{L}\p{N}]+)*"), F.lit(0))


def word_pairs(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
                       lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(2))))


def _grams(words: Column) -> Column:
    return F.array_distinct(F.concat(words, F.when(F.size(words) > 1, word_pairs(words)).otherwise(F.array().cast("array<string>"))))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that a generator gives, so that no filter on it is pushed below and evaluates it again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _variants(templates: DataFrame) -> DataFrame:
    """Templates whole, without one of their words, and cut at either end; the whole ones stand four times."""
    words = templates.withColumn("words", paragraph_words(F.col("text")))
    n = F.size("words")
    places = F.sequence(F.lit(0), n - 1)
    without = F.transform(places, lambda i: F.filter("words", lambda w, j: j != i))
    half = F.ceil(n * 0.6).cast("int")
    ends = F.array(F.slice("words", F.lit(1), half), F.slice("words", n - half + 1, half))
    whole = F.array_repeat(F.col("words"), 4)
    return words.select("family", F.explode(F.concat(whole, without, ends)).alias("words")).where(F.size("words") > 1)


def _own_paragraphs(docs: DataFrame, bound: int, paragraphs: int, piece_words: int) -> DataFrame:
    """At most ``paragraphs`` lines of ``bound`` distinct texts, both the first by hash; long lines in pieces.

    Equal texts count once, however many rows hold them; only hashes are broadcast.
    """
    keyed = docs.where("text is not null").select(unit_hash(F.col("text"), F.lit("licence")).alias("_h"), "text")
    chosen = keyed.select(F.col("_h").alias("_chosen")).distinct().orderBy("_chosen").limit(bound)
    texts = keyed.join(F.broadcast(chosen), F.col("_h") == F.col("_chosen")).groupBy("_h").agg(F.first("text").alias("text"))
    words = texts.select("_h", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select(
        "_h", "line_no", paragraph_words(F.col("line")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(piece_words))
    pieces = words.select("_h", "line_no", F.posexplode(F.transform(starts, lambda i: F.slice("all", i, F.lit(piece_words)))).alias("piece", "words"))
    drawn = pieces.orderBy(unit_hash("_h", "line_no", "piece"), "_h", "line_no", "piece").limit(paragraphs)
    return drawn.select(F.lit(UNKNOWN).alias("family"), "words")


class LicenceModel:
    """Weights by gram, intercepts and temperature of a trained classifier."""

    def __init__(self, spark: SparkSession, families: list[str], weights: dict[str, list[float]], intercepts: list[float], temperature: float):
        self.families, self.intercepts, self.temperature = families, intercepts, temperature
        self.weights = spark.createDataFrame(sorted(weights.items()), "gram string, w array<double>")
        self._singles, self._pairs = ([g for g in sorted(weights) if (" " in g) == two] for two in (False, True))
        self._words = sorted({w for g in weights for w in g.split(" ")})
        # What a gram adds at most to any family's lead over unknown, rounded up to quarters.
        self._base = max(i - intercepts[0] for i in intercepts[1:])
        self._leads: dict[float, list[str]] = {}
        for gram in sorted(weights):
            most = max(w - weights[gram][0] for w in weights[gram][1:])
            self._leads.setdefault(ceil(most * 4) / 4, []).append(gram)

    def known_in(self, words: Column) -> Column:
        """The distinct grams of an array of words that have weights, sorted; score and overlap depend on nothing else."""
        return F.sort_array(F.array_distinct(self.occurrences_in(words)))

    def occurrences_in(self, words: Column) -> Column:
        """Every occurrence of a weighted gram; pairs are only built of two words that stand in weighted grams."""
        singles = F.filter(words, lambda w: w.isin(self._singles))
        starts = F.when(F.size(words) > 1, F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
            lambda i: F.get(words, i - 1).isin(self._words) & F.get(words, i).isin(self._words))).otherwise(F.array().cast("array<int>"))
        pairs = F.transform(starts, lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
        return F.concat(singles, F.filter(pairs, lambda g: g.isin(self._pairs)))

    def known(self, paragraphs: DataFrame) -> DataFrame:
        """With ``known``: the weighted grams of ``paragraph``."""
        words = _once(paragraphs, "words", paragraph_words(F.col("paragraph")))
        return _once(words, "known", self.known_in(F.col("words"))).drop("words")

    def possible(self, known: Column) -> Column:
        """Whether a family can lead; where it is false, ``unknown`` has the highest score."""
        def lead(gram: Column) -> Column:
            out = F.lit(0.0)
            for most, grams in self._leads.items():
                out = F.when(gram.isin(grams), F.lit(most)).otherwise(out)
            return out

        return F.aggregate(known, F.lit(self._base + 1e-6), lambda acc, g: acc + lead(g)) >= 0

    def logits(self, rows: DataFrame, key: str = "known") -> DataFrame:
        """``key, logits``, one calibrated logit a family, for rows with distinct ``key``: the weighted grams of a paragraph."""
        n = len(self.families)
        grams = rows.select(key, F.explode_outer(key).alias("gram"))
        known = grams.join(F.broadcast(self.weights), "gram", "left")
        sums = known.groupBy(key).agg(*[F.coalesce(F.sum(F.col("w")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(n)])
        logits = F.array(*[(F.col(f"s{i}") + F.lit(self.intercepts[i])) / F.lit(self.temperature) for i in range(n)])
        return sums.select(key, logits.alias("logits"))

    def scored(self, rows: DataFrame, key: str = "known") -> DataFrame:
        """``key, family, probability`` of the likeliest family."""
        top = F.array_max("logits")
        total = F.aggregate("logits", F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        names = F.array(*[F.lit(f) for f in self.families])
        best = F.element_at(names, F.array_position("logits", top).cast("int"))
        return self.logits(rows, key).select(key, best.alias("family"), (F.lit(1.0) / total).alias("probability"))


def train_licence_model(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, ordinary: Sequence[str] = ORDINARY,
                        sample_docs: int = 100, sample_paragraphs: int = 2_000, piece_words: int = 60,
                        held_out: float = 0.25, regularization: float = 0.002) -> LicenceModel:
    """Trains on the templates, the ordinary sentences and at most ``sample_paragraphs`` paragraphs of ``sample_docs`` distinct texts."""
    spark = docs.sparkSession
    work = Workspace(spark, "licences")
    given = spark.createDataFrame([*templates], "family string, text string")
    plain = spark.createDataFrame([(UNKNOWN, t) for t in ordinary], "family string, text string")
    positives = _variants(given)
    pairs = given.select(F.explode(word_pairs(paragraph_words(F.col("text")))).alias("pair")).distinct().orderBy("pair").collect()
    # Paragraphs of the corpus that share three word pairs with the templates may be notices: not taken as unknown.
    negatives = _own_paragraphs(docs, sample_docs, sample_paragraphs, piece_words).where(
        F.size(F.array_intersect(word_pairs(F.col("words")), F.array(*[F.lit(r["pair"]) for r in pairs]))) < 3)
    examples = positives.union(_variants(plain)).union(negatives)
    examples = examples.withColumn("grams", _grams(F.col("words"))).withColumn("fold", unit_hash(F.concat_ws(" ", "words"), F.col("family")))
    examples = work.table("examples", examples.coalesce(2))
    rows = examples.select("family", "words", "grams", "fold").collect()
    families = [UNKNOWN, *sorted({f for f, _ in templates})]
    vocabulary = sorted({g for r in rows if r["family"] != UNKNOWN for g in r["grams"]})
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    index = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    fit_rows = vectorizer.transform(examples.withColumn("label", index))
    fit = LogisticRegression(family="multinomial", regParam=regularization, maxIter=60, standardization=False)

    def weights_of(model):
        matrix = model.coefficientMatrix.toArray()
        return {g: [float(matrix[c][i]) for c in range(len(families))] for i, g in enumerate(vocabulary)}, [float(x) for x in model.interceptVector]

    # The temperature comes from a model that has not seen the held-out fold; the model in use is fitted on all examples.
    trial, start = weights_of(fit.fit(fit_rows.where(F.col("fold") >= held_out)))
    temperature = _temperature([r for r in rows if r["fold"] < held_out], trial, start, families)
    final, start = weights_of(fit.fit(fit_rows))
    return LicenceModel(spark, families, final, start, temperature)


def _temperature(rows: list, weights: dict[str, list[float]], intercepts: list[float], families: list[str]) -> float:
    """The temperature with the least mean log loss on held-out examples."""
    logits = []
    for r in rows:
        sums = list(intercepts)
        for g in r["grams"]:
            for i, w in enumerate(weights.get(g, ())):
                sums[i] += w
        logits.append((families.index(r["family"]), sums))

    def loss(t: float) -> float:
        out = 0.0
        for label, sums in logits:
            top = max(sums)
            out -= (sums[label] - top) / t - log(sum(exp((s - top) / t) for s in sums))
        return out

    return min((0.4, 0.6, 0.8, 1.0, 1.25, 1.6, 2.0, 3.0), key=loss) if logits else 1.0


def paragraphs_of(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """``doc_id, text_key, paragraph_no, paragraph_lines, run_start, paragraph, known``: what may be a notice of all lines and runs of lines.

    Lines are cut into words once; a run has the grams of its lines and those that cross their ends.
    """
    lines = _once(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), "lines", F.split("text", "\n")).drop("text")
    lines = _once(lines, "words", F.transform("lines", paragraph_words))
    known = F.transform("words", lambda w: F.struct(
        model.known_in(w).alias("known"), F.get(w, F.lit(0)).alias("head"), F.element_at(F.when(F.size(w) > 0, w), -1).alias("tail")))
    lines = _once(lines, "marks", known).drop("words")

    def worded(i: Column) -> Column:
        return (i >= 0) & F.get("marks", F.greatest(i, F.lit(0)))["head"].isNotNull()

    def edges(step: int) -> Column:
        """Places of lines with words beside which, ``step`` further, no such line stands."""
        return F.filter(F.sequence(F.lit(0), F.size("marks") - 1), lambda i: worded(i) & ~worded(i + step))

    lines = _once(_once(lines, "starts", edges(-1)), "ends", edges(1))
    # A run carries its own lines only, so a text of many runs isn't copied once for each of them.
    spans = F.zip_with("starts", "ends", lambda a, b: F.struct(
        a.alias("first"), (b - a + 1).alias("n"), F.slice("lines", a + 1, b - a + 1).alias("lines"), F.slice("marks", a + 1, b - a + 1).alias("marks")))
    runs = lines.select("doc_id", "text_key", F.explode(spans).alias("span")).select("doc_id", "text_key", "span.*")
    runs = _once(runs, "marks_", F.col("marks")).drop("marks")
    crossing = F.zip_with(F.slice("marks_", F.lit(1), F.col("n") - 1), F.slice("marks_", F.lit(2), F.col("n") - 1),
                          lambda a, b: F.concat_ws(" ", a["tail"], b["head"]))
    whole = F.sort_array(F.array_distinct(F.concat(F.flatten(F.col("marks_.known")), F.filter(crossing, lambda g: g.isin(model._pairs)))))
    single = F.transform("marks_", lambda m, i: F.struct(
        (F.col("first") + i).alias("paragraph_no"), F.lit(1).alias("paragraph_lines"), F.get("lines", i).alias("paragraph"), m["known"].alias("known")))
    joined = F.array(F.struct(F.col("first").alias("paragraph_no"), F.col("n").alias("paragraph_lines"),
                              F.array_join("lines", "\n").alias("paragraph"), whole.alias("known")))
    items = F.when(F.col("n") > 1, F.concat(single, joined)).otherwise(single)
    return runs.select("doc_id", "text_key", F.col("first").alias("run_start"), F.explode(items).alias("item")).select(
        "doc_id", "text_key", "run_start", "item.*").where(model.possible(F.col("known")))


def _held_templates(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> Column:
    """The templates as a constant: ``family, pairs, grams``."""
    words = spark.createDataFrame([*templates], "family string, text string").select("family", paragraph_words(F.col("text")).alias("words"))
    rows = words.select("family", F.array_distinct(word_pairs(F.col("words"))).alias("pairs"), _grams(F.col("words")).alias("grams")).collect()
    return F.array(*[F.struct(F.lit(r["family"]).alias("family"), F.array(*map(F.lit, r["pairs"])).alias("pairs"),
                              F.array(*map(F.lit, r["grams"])).alias("grams")) for r in rows])


def _agreeing(held: Column, known: Column, least_overlap: float) -> Column:
    """The templates of which ``known`` holds enough pairs: ``family, overlap, pairs, grams``."""
    compared = F.transform(held, lambda t: F.struct(
        t["family"].alias("family"), (F.size(F.array_intersect(t["pairs"], known)) / F.size(t["pairs"])).alias("overlap"),
        F.array_intersect(t["pairs"], known).alias("pairs"), t["grams"].alias("grams")))
    return F.filter(compared, lambda t: t["overlap"] >= least_overlap)


def _notices(model: LicenceModel, paragraphs: DataFrame, held: Column, least_probability: float, least_overlap: float, work: Workspace) -> DataFrame:
    """``key, family, probability, overlap, confirmed``: every family confirmed in a paragraph, taken off one by one.

    A round subtracts the pairs of one template as often as all of them occur,
    which uses up at least one pair, so the rounds end. A paragraph travels as the
    counts of its weighted grams, whatever its length.
    """
    names = F.array(*[F.lit(f) for f in model.families])
    words = _once(paragraphs, "words", paragraph_words(F.col("paragraph")))
    grams = words.select("key", F.explode(model.occurrences_in(F.col("words"))).alias("gram"))
    counts = grams.groupBy("key", "gram").agg(F.count("*").alias("n"))
    left = work.table("mixed-0", counts.groupBy("key").agg(F.collect_list(F.struct("gram", "n")).alias("grams")))
    seen, turn = [], 0
    while not left.isEmpty():
        rows = left.withColumn("known", F.sort_array(F.transform("grams", lambda g: g["gram"])))
        scored = rows.join(model.logits(rows.select("known").distinct()), "known")
        agreeing = _once(scored, "agreeing", _agreeing(held, F.col("known"), least_overlap)).where(F.size("agreeing") > 0)

        def logit(family: Column) -> Column:
            return F.element_at(F.col("logits"), F.array_position(names, family).cast("int"))

        best = F.array_max(F.transform("agreeing", lambda t: F.struct(
            logit(t["family"]).alias("logit"), t["overlap"].alias("overlap"), t["family"].alias("family"), t["pairs"].alias("pairs"), t["grams"].alias("off"))))
        chosen = _once(agreeing, "best", best)
        beside = F.transform(F.filter("agreeing", lambda t: t["overlap"] >= 0.8), lambda t: t["family"])
        total = F.aggregate(
            F.zip_with("logits", names, lambda x, f: F.when((f == F.col("best.family")) | ~F.array_contains(beside, f), x)),
            F.lit(0.0), lambda acc, x: acc + F.coalesce(F.exp(x - F.col("best.logit")), F.lit(0.0)))
        times = F.array_min(F.transform(F.filter("grams", lambda g: F.array_contains(F.col("best.pairs"), g["gram"])), lambda g: g["n"]))
        counted = _once(chosen, "times", times)
        rest = F.filter(F.transform("grams", lambda g: F.struct(
            g["gram"].alias("gram"), (g["n"] - F.when(F.array_contains(F.col("best.off"), g["gram"]), F.col("times")).otherwise(0)).alias("n"))), lambda g: g["n"] > 0)
        turn += 1
        step = work.table(f"mixed-{turn}", counted.select(
            "key", "best.family", (F.lit(1.0) / total).alias("probability"), "best.overlap", rest.alias("grams")))
        seen.append(step.where(F.col("probability") >= least_probability))
        left = step.where(F.size("grams") > 0).select("key", "grams")
    out = seen[0] if seen else left.select("key", F.lit("").alias("family"), F.lit(0.0).alias("probability"), F.lit(0.0).alias("overlap"))
    for step in seen[1:]:
        out = out.unionByName(step)
    best = out.groupBy("key", "family").agg(F.max(F.struct("overlap", "probability")).alias("best"))
    return best.select("key", "family", "best.probability", "best.overlap", F.lit(True).alias("confirmed"))


def scan_licences(docs: DataFrame, model: LicenceModel, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  least_probability: float = 0.5, least_overlap: float = 0.5) -> DataFrame:
    """``doc_id, paragraph_no, family, probability, overlap, confirmed, paragraph``: one row per licence paragraph."""
    work = Workspace(docs.sparkSession, "licences")
    lines = work.table("paragraphs", paragraphs_of(docs, model))
    scored = work.table("scored", model.scored(lines.select("known").distinct()).where(F.col("family") != UNKNOWN))
    named = scored.where(F.col("probability") >= least_probability)
    pairs = docs.sparkSession.createDataFrame([*templates], "family string, text string").select(
        F.col("family").alias("_family"), word_pairs(paragraph_words(F.col("text"))).alias("pairs"))
    pairs = pairs.groupBy("_family").agg(F.collect_list("pairs").alias("templates"))
    # All pairs of the templates have weights, so a paragraph's known grams hold those it shares with them.
    compared = named.join(F.broadcast(pairs), F.col("family") == F.col("_family"))
    overlap = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("known"))) / F.size(F.array_distinct(t))))
    confirmed = compared.select("known", "family", "probability", overlap.alias("overlap"), (overlap >= least_overlap).alias("confirmed"))
    found = lines.join(confirmed, "known")
    held = _held_templates(docs.sparkSession, templates)
    several = scored.where(F.size(F.array_distinct(F.transform(_agreeing(held, F.col("known"), least_overlap), lambda t: t["family"]))) > 1)
    mixed = lines.join(several.select("known"), "known").withColumn("key", F.sha2("paragraph", 256))
    further = _notices(model, mixed.select("key", "paragraph").dropDuplicates(["key"]), held, least_probability, least_overlap, work)
    told = confirmed.where("confirmed").select("known", "family")
    found = found.unionByName(mixed.join(further, "key").join(told, ["known", "family"], "left_anti").select(*found.columns))
    # The lines of a run travel with its text's key, so rows of the same id stay apart.
    rank = F.when(F.col("confirmed"), 2).otherwise(1)
    by_line = found.where("paragraph_lines = 1").groupBy("text_key", F.col("run_start").alias("paragraph_no"), "family").agg(F.max(rank).alias("told"))
    runs = found.where("paragraph_lines > 1").join(by_line, ["text_key", "paragraph_no", "family"], "left").where(
        F.col("told").isNull() | (F.col("told") < rank))
    columns = ["doc_id", "paragraph_no", "family", "probability", "overlap", "confirmed", "paragraph"]
    return found.where("paragraph_lines = 1").select(*columns).unionByName(runs.select(*columns))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_licences(docs, train_licence_model(docs))
    return found.select("doc_id", "paragraph_no", "family", F.round("probability", 6).alias("probability"), "overlap", "confirmed")
