"""Licence scans with a trained paragraph classifier, DataFrame and SQL functions only.

Texts are cut at blank lines and into sentences, line breaks folded, and also into the lines of these. Those that can
be a notice are turned into word and word-pair features and classified by a multinomial logistic regression with L1,
trained on labelled notices: the customary wordings below, their halves, and the families' names in common forms of
words, against ``unknown``. The threshold that a family's probability must reach is calibrated on held-back unknown
notices. A prediction counts only if the paragraph also resembles a template of the predicted family: the share of the
template's word pairs that it holds, or, for fragments, of its own pairs that the template holds.

What can be a notice follows from the trained weights. A family can only reach half of the probability if its
features' lead over ``unknown`` makes up for the lead of ``unknown``'s intercept. The weakest features that together
cannot do so for any family are set aside; a text without any of the others cannot hold a notice. These others are one
pattern, tried on whole texts, then on sentences and lines. It leaves out nothing that would be found.

Defined results: null and empty texts have no notice; a notice that occurs twice counts twice, in repeated rows too;
notices of rows that share an id are listed under that id, by sentence and row; a text that two families' templates fit
equally goes to the more probable family, of equal ones to the first by name. Very long texts and paragraphs are
compared whole. Other columns are not read. An empty table gives no row.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import ready

REGULARISATION, L1_SHARE, ITERATIONS = 0.0003, 0.5, 80
LEAST_PROBABILITY = 0.5
SIMILAR = 0.6
UNKNOWN = "unknown"

# Notices by family: customary wordings, as published with the licences (fixed values).
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT license.", "The MIT License (MIT)",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only",
        "Released under the GPLv3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    "BSD": (
        "Released under the BSD License.", "Licensed under the 3-clause BSD license.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    "ISC": (
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted"),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal.", "Dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.", "SPDX-License-Identifier: CC-BY-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "Proprietary": (
        "All rights reserved.", "Copyright by the company, all rights reserved.",
        "No part of this publication may be reproduced without prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited."),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program."),
}
# Names by family: SPDX names, short and long names (fixed values).
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT",),
    "Apache-2.0": ("Apache-2.0", "Apache 2.0", "Apache License 2.0", "Apache License, Version 2.0", "Apache License"),
    "GPL": ("GPL", "GNU GPL", "GNU General Public License"),
    "GPL-2.0": ("GPL-2.0", "GPLv2", "GPL v2", "GNU GPL version 2", "GNU GPL v2", "GNU General Public License version 2"),
    "GPL-3.0": ("GPL-3.0", "GPLv3", "GPL v3", "GNU GPL version 3", "GNU GPL v3", "GNU General Public License version 3"),
    "LGPL": ("LGPL", "LGPL-2.1", "LGPL-3.0", "LGPLv3", "GNU LGPL", "GNU Lesser General Public License"),
    "AGPL-3.0": ("AGPL", "AGPL-3.0", "AGPLv3", "GNU AGPL", "GNU Affero General Public License"),
    "BSD": ("BSD", "BSD-2-Clause", "BSD-3-Clause", "3-clause BSD", "2-clause BSD"),
    "MPL-2.0": ("MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License"),
    "ISC": ("ISC",),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0", "CC0-1.0", "CC0 1.0", "CC0 1.0 Universal"),
    "CC-BY": ("CC BY 4.0", "CC-BY-4.0", "CC BY", "Creative Commons Attribution 4.0"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "CC BY-SA", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC", "Creative Commons Attribution-NonCommercial 4.0"),
    "CC-BY-ND": ("CC BY-ND 4.0", "CC-BY-ND-4.0", "CC BY-ND", "Creative Commons Attribution-NoDerivatives 4.0"),
}
# Forms of words around a name (fixed values); a bare name counts if it has a digit or a hyphen.
FORMS = ("License: {}", "Licence: {}", "Licensed under {}.", "Licensed under the {}.", "Licensed under the {} license.",
         "Distributed under {}.", "Distributed under the {} license.", "Released under the {}.",
         "Released under the {} licence.", "Available under the {} license.", "Code is available under the {} licence.",
         "under the terms of the {}", "The {} License")
# Lead-ins with which a notice is also met in training (fixed values).
LEADS = ("", "Note: ", "This project is ", "The code of this page is ", "# ", "(c) the authors. ", "Text and images: ")
# What mentions licensing but names no licence (fixed values).
NO_LICENCE = (
    "You need a driving licence to rent a car.", "The restaurant lost its licence last year.",
    "Please read the license terms before you continue.", "A fishing license is required in this area.",
    "Copyright law differs between countries.", "The permission of the owner is needed to enter the garden.",
    "They asked for permission and left.", "The warranty covers two years of use.", "Her licence plate was stolen.",
    "The magazine is licensed to print in three countries.", "The public domain is a matter of debate.",
    "He wrote a book about the history of copyright.", "Licensed premises close at midnight.",
    "The dealer refused the warranty claim.", "See the license file for details.", "What license should I choose for my code?",
    "Redistribution of wealth was the topic of the talk.", "Software licensing is hard to understand.",
    "The licence fee will rise next year.", "License and registration, please.", "Without permission nobody may leave.",
    "The commons are creative spaces for the public.", "The version of the file was 2.0.",
    "General rules apply to the public.", "This work is done under the bridge.", "Released in spring, the album sold well.",
    "A pilot license takes years.", "Our license server is down.", "The bar has no alcohol licence.",
    "Permission slips must be signed by parents.", "The film is free of charge for any person under ten.",
    "An extended warranty is not worth it.", "She gave permission to copy the letter.", "copyright", "license", "(c)",
    "permission denied", "the licensed tour guide speaks four languages", "rights and duties are reserved for members",
    "redistribution lists are sent weekly", "", "under the bridge", "the terms of the contract", "She studied at MIT.",
    "The helicopter is an Apache.", "Version 2.0 is available under the menu.", "The public library is free.",
    "General public transport is available.", "The foundation published a report.", "It is distributed under protest.",
    "Released under the cover of night.", "The Foo License, Version 9.", "Licensed under the Foo License.",
    "License: see below", "License: unknown", "Licensed under the Bar Public License, version 1.",
    "The software is available under the counter.", "The licensing board met on Monday to discuss permission for the market.")


# Words of any prose (fixed values), mixed with the templates' words into notices that say nothing.
PLAIN_WORDS = ("the of and to in is it that this for or with as by on not any all you your may can be have has no under "
               "without was he she they are from at his her an a which one were there when who will more if out so what up "
               "into than its about only some could time these two other new then do first 1 2 3 4 5 10").split()
MIXED, MIXED_WORDS, MIXED_SEED = 1200, 9, 7


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits (version numbers keep their dots)."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.+(?![\p{N}])"), lambda w: w != "")


def word_pairs(words: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word stands for itself."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def grams(df: DataFrame, text: str) -> DataFrame:
    """Add the word pairs and all grams (words and pairs) of a text column."""
    df = df.withColumn("_words", tokens(F.col(text))).withColumn("_pairs", word_pairs(F.col("_words")))
    return df.withColumn("_grams", F.concat("_words", "_pairs")).drop("_words")


def _classes() -> list[str]:
    return [UNKNOWN, *sorted(TEMPLATES)]


def all_templates() -> dict[str, list[str]]:
    """Customary wordings and, by rule, every name in every form of words."""
    out = {f: list(ts) for f, ts in TEMPLATES.items()}
    for family, names in NAMES.items():
        for name in names:
            forms = [form.format(name) for form in FORMS]
            out[family] += [name, *forms] if re.search(r"\d|-", name) else forms
    return out


def halves(text: str) -> list[str]:
    """A long notice's first and second half."""
    words = text.split()
    return [" ".join(words[:len(words) // 2]), " ".join(words[len(words) // 2:])] if len(words) >= 16 else []


def mixed_words() -> list[str]:
    """Random words of templates and prose in a row, family names left out: what holds a template's words but not
    its word pairs is no notice."""
    names = {w for ns in NAMES.values() for n in ns for w in re.findall(r"[a-z0-9.]+", n.lower())}
    words = sorted({w for ts in TEMPLATES.values() for t in ts for w in re.findall(r"[a-z]+", t.lower())} - names)
    draw = random.Random(MIXED_SEED)
    pool = [w for k in range(max(len(words), len(PLAIN_WORDS))) for w in (words[k % len(words)], PLAIN_WORDS[k % len(PLAIN_WORDS)])]
    return [" ".join(draw.choices(kind, k=MIXED_WORDS)) for kind in (pool, PLAIN_WORDS) for _ in range(MIXED)]


def training_notices() -> list[tuple[str, int, bool]]:
    """(text, class, held): customary wordings with all lead-ins, halves and names in forms with one; every fourth row
    is held for calibration."""
    names, rows = _classes(), []
    for family, texts in all_templates().items():
        custom = set(TEMPLATES[family])
        for k, t in enumerate(texts):
            leads = LEADS if t in custom else ("", LEADS[k % len(LEADS)])
            rows += [(lead + x, names.index(family)) for x in (t, *halves(t)) for lead in leads]
    rows += [(lead + t, 0) for t in NO_LICENCE for lead in LEADS] + [(t, 0) for t in mixed_words()]
    return [(t, y, k % 4 == 3) for k, (t, y) in enumerate(rows)]


@dataclass
class LicenceModel:
    """Vocabulary and weights, the pattern that every text with a notice matches, and the templates' word pairs."""
    vocabulary: CountVectorizerModel
    regression: LogisticRegressionModel
    pattern: str
    templates: dict[str, list[list[str]]]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.regression.transform(self.vocabulary.transform(df))


def strong_grams(vocabulary: list[str], regression: LogisticRegressionModel) -> list[str]:
    """The grams without which no family can be as probable as ``unknown``."""
    weights, intercepts = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    lead = (weights[1:] - weights[0]).clip(min=0)
    short = intercepts[0] - intercepts[1:]
    if (short <= 0).any():
        raise ValueError("a family is as probable as unknown without any feature")
    plain = [all(w in PLAIN_WORDS for w in g.split()) for g in vocabulary]
    # Words of any prose are set aside first, so that the pattern is rare in texts; then the weakest grams.
    left, out = short.copy(), []
    for i in sorted(range(len(vocabulary)), key=lambda i: (not plain[i], plain[i] and " " in vocabulary[i], lead[:, i].max())):
        if (lead[:, i] < left).all():
            left -= lead[:, i]
        else:
            out.append(vocabulary[i])
    return out


def gram_pattern(found: list[str]) -> str:
    """A pattern of lower-case grams at word starts, branching at the first letters; words of a pair may stand apart
    by anything that separates words."""
    gap = r"(?:[^\p{L}\p{N}.]+|\.+(?![\p{N}]))+"
    tree: dict = {}
    for gram in found:
        node = tree
        for c in gram:
            node = node.setdefault(c, {})
        node[""] = {}

    def branch(node: dict) -> str:
        # What follows a gram in another word matters only if the gram's word goes on: a pair needs its first word.
        parts = [(gap if c == " " else re.escape(c)) + branch(rest) for c, rest in sorted(node.items())
                 if c and not (c == " " and "" in node)]
        if "" in node:
            parts.append(r"(?![\p{L}\p{N}])")
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return r"(?<![\p{L}\p{N}])" + branch(tree)


def train_classifier(spark: SparkSession) -> tuple[LicenceModel, float]:
    """The fitted model, and the calibrated probability that a family must reach."""
    ready(spark)
    # The notices are a fixed list, so are their words.
    rows = spark.createDataFrame([(t, float(y), h) for t, y, h in training_notices()], "text string, label double, held boolean")
    rows = grams(rows.coalesce(1), "text")
    words = sorted({g for r in rows.select("_grams").collect() for g in r[0]})
    vocabulary = CountVectorizerModel.from_vocabulary(words, inputCol="_grams", outputCol="_features")
    vocabulary.setBinary(True)
    rows = vocabulary.transform(rows).cache()
    regression = LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial", regParam=REGULARISATION,
                                    elasticNetParam=L1_SHARE, maxIter=ITERATIONS, standardization=False).fit(rows.where("not held"))
    worst = regression.transform(rows.where("held and label = 0")).select(
        F.array_max(F.slice(vector_to_array("probability"), 2, len(TEMPLATES))).alias("p")).agg(
        F.percentile_approx("p", 0.98, 10000)).first()[0]
    rows.unpersist()
    listed = [(f, t) for f, ts in all_templates().items() for t in ts]
    templates: dict[str, list[list[str]]] = {}
    for r in grams(spark.createDataFrame(listed, "family string, text string"), "text").select("family", "_pairs").distinct().collect():
        templates.setdefault(r["family"], []).append(sorted(r["_pairs"]))
    model = LicenceModel(vocabulary, regression, gram_pattern(strong_grams(words, regression)),
                         {f: sorted(ts) for f, ts in templates.items()})
    return model, max(LEAST_PROBABILITY, worst or 0.0)


def sentences(text: Column) -> Column:
    """Sentences of the parts between blank lines, line breaks in them kept; ``v.`` and semicolons end none."""
    blocks = F.split(F.regexp_replace(text, r"\r\n?", "\n"), r"\n[^\S\n]*(?:\n[^\S\n]*)+")
    return F.flatten(F.transform(blocks, lambda b: F.split(b, r"(?<=[.!?])(?<!\b[vV]\.)\s+")))


def paragraphs(sentence: Column) -> Column:
    """(line, paragraph): the sentence with its line breaks folded, and its lines and clauses if it has several."""
    pieces = F.split(sentence, r"\n|(?<=;|\b[vV]\.)\s+")
    whole = F.array(F.struct(F.lit(False).alias("line"), F.trim(F.regexp_replace(sentence, r"\s*\n\s*", " ")).alias("paragraph")))
    return F.when(F.size(pieces) > 1, F.concat(whole, F.transform(
        pieces, lambda x: F.struct(F.lit(True).alias("line"), F.trim(x).alias("paragraph"))))).otherwise(whole)


def find_licences(docs: DataFrame, model: LicenceModel, threshold: float, id_col: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity) of every confirmed notice, one row per occurrence.

    A sentence of several lines or clauses counts by those of a family, or else as a whole. Null and empty
    texts have none. Very long paragraphs are compared whole.
    """
    ready(docs.sparkSession)
    possible = lambda c: F.lower(F.col(c)).rlike(model.pattern)
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"),
                        F.col(text).alias("_text"))
            .where(possible("_text"))
            .select("doc_id", "_row", F.posexplode(sentences(F.col("_text"))).alias("unit", "_sentence"))
            .where(possible("_sentence"))
            .select("doc_id", "_row", "unit", F.inline(paragraphs(F.col("_sentence"))))
            .where(possible("paragraph")))
    rows = model.transform(grams(rows, "paragraph"))
    families = F.array(*[F.lit(f) for f in _classes()])
    p = vector_to_array("probability")
    rows = (rows.withColumn("_p", p).withColumn("probability_", F.array_max("_p"))
            .withColumn("family", F.element_at(families, F.array_position("_p", F.array_max("_p")).cast("int")))
            .where((F.col("family") != UNKNOWN) & (F.col("probability_") >= threshold)))
    known = F.create_map(*[x for f, ts in sorted(model.templates.items())
                           for x in (F.lit(f), F.array(*[F.array(*map(F.lit, t)) for t in ts]))])
    similar = F.array_max(F.transform(known[F.col("family")], lambda t: F.size(F.array_intersect("_pairs", t)) / F.least(
        F.size(t), F.greatest(F.size("_pairs"), F.lit(3)))))
    found = rows.withColumn("similarity", similar).where(F.col("similarity") >= SIMILAR)
    # The confirmed parts of one sentence of one text.
    found = (found.groupBy("doc_id", "_row", "unit", "family")
             .agg(F.collect_list(F.struct("line", "paragraph", "probability_", "similarity")).alias("_all"))
             .withColumn("_lines", F.filter("_all", lambda x: x["line"]))
             .select("doc_id", "family", F.explode(F.when(F.size("_lines") > 0, F.col("_lines")).otherwise(F.col("_all"))).alias("_one")))
    return found.select("doc_id", "_one.paragraph", "family", F.col("_one.probability_").alias("probability"), "_one.similarity")


def op10_license(spark, sf_dir: str) -> DataFrame:
    """Licence families of every document, with the number of notices and the surest of them."""
    from kiln.sources.tables import table

    ready(spark)
    docs = table(spark, sf_dir, "documents")
    found = find_licences(docs, *train_classifier(spark)).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("family")).alias("licenses"), F.count("*").alias("n_notices"),
        F.max("probability").alias("probability"))
    return (docs.select(F.col("doc_id").cast("long").alias("id")).join(found, F.col("id").eqNullSafe(F.col("doc_id")), "left")
            .select(F.col("id").alias("doc_id"), F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
                    F.coalesce("n_notices", F.lit(0)).alias("n_notices"), "probability"))
