"""Licence scan: a trained paragraph classifier, confirmed by templates; DataFrame and ML functions only.

Paragraphs (lines) become counts of word 1- to 3-grams, and a multinomial logistic regression names the licence family,
``unknown`` for a licence of no family here, or ``none``. Words are folded first: "licence" is read as "license", and a
version is apart from its name ("GPLv2" is "gpl 2").

The labelled sample is made by rule from the fixed values below (phrasings x names, and single sentences), of a size
that does not depend on the corpus. Held out, for calibration and for the figures, are whole phrasings, whole names
(``HELD_NAMES``, among them licences of no family) and whole sentences: no row of theirs is in training. On them the
threshold is calibrated: the smallest probability from which on at least ``PRECISION`` of the answers that name a family
are right. An answer below it is unknown. An answer stands if the paragraph also holds at least ``containment`` of the
word n-grams of a template of that family; otherwise it is unknown too. Further families with a chance of ``SECOND`` and
a template of their own in the paragraph stand beside it ("MIT or Apache-2.0").

A paragraph in which no word of the vocabulary stands but function words has nothing to classify and is ``none``; which
words those are is read off the training rows, and ``LicenceModel.coverage`` is the share of held-out statements that
get past this, which the tests hold to 0.99.

Every paragraph of every text is judged. Defined cases: a null, empty or blank text has no paragraph, no licence and
the verdict "none"; repeated rows are scanned one by one; null ids pass through; further columns are ignored; an empty
table gives an empty result. A very long text is many paragraphs, and a very long paragraph is one row of counts over
the fixed vocabulary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import unused

NONE, UNKNOWN, RESERVED = "none", "unknown", "proprietary"
FOLDS, PRECISION, SECOND, PLAIN = 5, 0.98, 0.05, 4.0

#: Phrasings by which texts declare a licence; every fifth is held out whole.
PHRASINGS = (
    "Released under the {} as stated in the file COPYING.",
    "Licensed under the {}.",
    "Licensed under {}.",
    "Released under the {}.",
    "This project is licensed under the {}.",
    "It is distributed as {} software.",
    "This work is licensed under a {}.",
    "Distributed under the terms of the {}.",
    "Code is {} licensed.",
    "{}",
    "The contents of this directory fall under {}.",
    "The text is available under the {}.",
    "The source code is available under the {}, see the website for details.",
    "You may use this file only in compliance with the {}.",
    "License: {}",
    "All files here are covered by the {} unless noted otherwise.",
    "SPDX-License-Identifier: {}",
    "(c) 2020 The authors. Published under the {}.",
    "This tool is offered under the {}.",
    "{} only",
    "You can choose the {} for your own use of it.",
    "Le code est sous {}.",
    "Der Quelltext steht unter der {}.",
    "El texto se publica bajo la {}.",
    "This package may be used under {} conditions.",
    "We publish our data under the {}.",
    "{}, see LICENSE for the full text.",
    "The library comes with the {}.",
    "Use of this module is governed by the {}.",
    "licence = {}",
)
#: Names of licences by family.
NAMES: dict[str, tuple[str, ...]] = {
    "apache": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0", "Apache license", "ASL 2.0"),
    "bsd": ("BSD 3-Clause License", "BSD license", "2-Clause BSD License", "BSD-3-Clause", "BSD", "Modified BSD License", "simplified BSD license"),
    "cc-by": ("CC BY 4.0", "CC BY-SA 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution-ShareAlike License", "licence CC BY 3.0", "Creative Commons BY license", "CC-BY-SA"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial-ShareAlike License", "CC-BY-NC", "licence CC BY-NC-SA 2.0"),
    "gpl": (
        "GNU General Public License, version 3", "GNU GPL v2 or any later version", "GNU Lesser General Public License", "GPL-3.0-or-later", "GPL-2.0-only", "GPLv3", "GPL", "LGPL-2.1", "LGPLv3", "LGPL", "AGPL-3.0", "GNU AGPL",
        "GNU General Public Licence", "GPL license",
    ),
    "mit": ("MIT License", "MIT licence", "MIT", "MIT/X11 license", "MIT software license"),
    "mpl": ("Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0", "MPL", "Mozilla license", "MPLv1.1"),
    UNKNOWN: (
        "zlib License", "Artistic License 2.0", "Eclipse Public License 2.0", "PostgreSQL License", "SIL Open Font License 1.1", "Open Database License", "Academic Free License v3.0", "CDDL 1.1 license", "AFL 3.0 license", "OFL 1.1 license",
        "Beerware license", "LaTeX Project Public License", "NCSA Open Source License", "Python Software Foundation License Version 2", "Intel Open Source License", "Sleepycat Software License, version 1.0", "Zope Public License 2.1",
        "Ruby license", "Vim license", "Perl licence",
    ),
}
#: Names that only held-out rows have.
HELD_NAMES: dict[str, tuple[str, ...]] = {
    "apache": ("Apache Software License 2",),
    "bsd": ("New BSD License",),
    "cc-by": ("Creative Commons Attribution-ShareAlike 2.5 Generic",),
    "cc-by-nc": ("Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported",),
    "gpl": ("GNU Affero General Public License v3", "LGPL version 2"),
    "mit": ("MIT (Expat) License",),
    "mpl": ("Mozilla Public Licence 1.1",),
    UNKNOWN: ("ISC License", "EUPL license 1.2", "Unlicense license", "WTFPL license", "Microsoft Public License", "CeCILL License", "Boost Software License - Version 1.0"),
}
#: Beginnings and ends of notices that reserve all rights.
NOTICES = ("", "Copyright 2020 by the company. ", "(c) 2020 The authors. ", "Copyright (c) 2021 Example Inc. ", "This document is the property of its owner. ")
RIGHTS = (
    "All rights reserved.",
    "All rights reserved worldwide.",
    "All rights reserved, do not redistribute.",
    "All rights are reserved by the publisher.",
    "No part of this publication may be reproduced without written permission of the publisher.",
    "No part of this book may be transmitted in any form without prior permission.",
    "This material is confidential and proprietary.",
    "Unauthorized copying of this file is strictly prohibited.",
    "It may not be copied or redistributed without permission.",
)
#: What no part of which may be done without whose leave; the first of each is held out.
PARTS = ("manual", "publication", "book", "document", "work", "report")
DEEDS = ("translated", "reproduced", "copied", "transmitted in any form", "distributed", "stored in a retrieval system")
LEAVES = ("the consent of the owner", "prior permission", "written permission of the publisher", "permission in writing")
#: Licences that people have, and what is said of them; every fifth is held out whole.
PERSONAL = (
    "business license", "driving license", "driver's license", "boating license", "hunting license", "liquor license", "pilot license", "marriage license", "gun license", "taxi licence",
    "teaching license", "television licence", "dog license", "medical license", "nursing license", "broker's license", "gaming license", "radio license", "export licence", "trading license",
)
OCCASIONS = (
    "She applied for a {} at the town hall.", "{} extended", "The {} expired last month.", "His {} was suspended by the board.", "His {} came under the rules of the county.", "The court took away her {} for two years.",
    "A {} costs forty dollars.", "He showed his {} to the officer.", "The office that issues a {} is closed.", "They lost the {} in March.", "You need a {} to do that here.", "The new rules on the {} apply to all.",
    "{} holder", "{} number and date", "lost {}", "{} revoked", "the {} of his brother", "{} office",
)
#: Words of a family in sentences that declare nothing.
OTHERWISE = (
    "She lectures on physics at MIT.", "An MIT student won the prize.", "The MIT campus lies on the river.", "MIT researchers found a new star.", "Her brother went to MIT last year.", "He taught at MIT under a famous professor.",
    "The Apache chief met the settlers.", "An Apache web server answers the request.", "Mozilla opened an office in Berlin.", "Creative work is common in the arts.", "The GNU project began in 1983.", "The copyright lapsed after seventy years.",
)
#: Function words, which never mark a statement.
FUNCTION_WORDS = (
    "a above all along an and any are as at be by can do for from has have if in is it its may must no not of on one only or see shall should "
    "that the this to was were will with without you your"
).split(" ")
#: Sentences that are statements as they stand, and sentences that only sound like one.
SENTENCES: dict[str, tuple[str, ...]] = {
    "apache": (
        "You may not use this file except in compliance with the License. You may obtain a copy of the Apache License from the Apache Software Foundation.",
        "Dual licensed under MIT and Apache-2.0, at your option Apache.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, you can obtain one from the Mozilla Foundation.",
    ),
    UNKNOWN: (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted.",
        "This software is provided as is, without any express or implied warranty; in no event will the authors be held liable for any damages.",
        "You may redistribute this software under the license that came with it.",
        "See the license file for the terms under which this program is distributed.",
        "This software is licensed under the same terms as the language itself.",
        "The software may be copied and modified for any purpose under the license below.",
    ),
    NONE: (
        "Her hunting license is valid in the county.",
        "His pilot license was revoked by the court.",
        "A marriage license is issued by the clerk of the town.",
        "The license plate of the car was stolen.",
        "He lost his license for driving under the influence.",
        "They were issued a license to sell beer in the park.",
        "The television licence pays for the public broadcaster.",
        "The nurse renewed the license that the state had issued.",
        "A gun license requires a test and a permit of the police.",
        "The taxi licence was granted under the rules of the city.",
        "Poetic license lets the author change the facts.",
        "The doctor's license expired under the terms of the board.",
        "The weather was fine and the children played in the garden of the house.",
        "She works as a researcher at MIT and writes about the public.",
        "He studied at MIT before he went to the west.",
        "The MIT press printed a book about the history of the city.",
        "The Apache helicopter landed behind the hill at noon.",
        "The Apache people lived in the south of the country.",
        "He collected his driving license at the office on Monday.",
        "The restaurant lost its liquor license last year.",
        "A boating license costs five dollars a day.",
        "The licensed driver waited under the bridge.",
        "The public library is open to any person free of charge on Sunday.",
        "A general was promoted under the terms of the peace treaty.",
        "The terms of the contract were published in the paper.",
        "The film was released in March and is available in many countries.",
        "The prisoner was released under the eyes of the public.",
        "The bank was granted permission to use the building.",
        "Permission to land was granted by the tower.",
        "Version 2.0 of the program runs twice as fast as the first version.",
        "Version 3 of the file is available from the website.",
        "Attribution of the painting to the master is still disputed.",
        "The commons of the village were used for grazing.",
        "The house of commons met in the evening.",
        "Commercial use of the land is taxed by the state.",
        "The commercial was distributed to all stations.",
        "The file is too large to send, so use the source instead.",
        "The source of the river lies in the hills.",
        "The gnu is a large animal that lives in the south of the continent.",
        "The creative work of the artist was subject to criticism.",
        "Conditions were met in the following year and the rights returned to the owner.",
        "The rights of the people are written in the law.",
        "Seats are reserved for the guests of the hotel.",
        "The table was reserved for all of us.",
        "The binary star can be seen without a telescope.",
        "He may not leave the city without the written order of the judge.",
        "This is the story of a work that was never finished.",
        "A copy of the letter is kept in the museum.",
        "The copyright of the song was sold to a company.",
        "Software is written by people who know the code.",
        "The project is under way and the details are on the website.",
        "Il est permis de marcher dans le jardin de la maison.",
        "El trabajo de la casa no es libre para los que viven en la ciudad.",
        "Die Arbeit ist unter den Baeumen des Gartens getan.",
        "it was and the of to is in on for by with as at an that",
        "and of the in is to",
        "this work is under the",
        "code is the file",
    ),
}
#: What a paragraph has to hold to confirm a family, in folded words.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": ("apache license", "apache 2", "apache software license", "asl 2 0"),
    "bsd": ("bsd license", "clause bsd", "bsd 3 clause", "bsd 2 clause", "bsd licensed", "bsd software", "under bsd", "license bsd", "identifier bsd", "new bsd", "modified bsd", "simplified bsd", "bsd conditions", "redistribution and use in source and binary forms", "redistributions of source code must retain"),
    "cc-by": ("cc by", "creative commons attribution", "creative commons by"),
    "cc-by-nc": ("cc by nc", "creative commons attribution noncommercial", "attribution noncommercial"),
    "gpl": ("gpl", "agpl", "lgpl", "gnu general public license", "gnu lesser general public license", "gnu affero general public license"),
    "mit": ("mit license", "mit licensed", "mit software", "mit conditions", "license mit", "identifier mit", "under mit", "licensed under mit", "under the mit", "unter der mit", "bajo la mit", "sous mit", "mit expat", "mit x 11", "mit or", "or mit", "permission is hereby granted free of charge", "this permission notice shall be included"),
    "mpl": ("mozilla public license", "mozilla license", "mpl"),
    "proprietary": ("all rights reserved", "all rights are reserved", "no part of this", "confidential and proprietary", "proprietary and confidential", "unauthorized copying", "is proprietary to", "may not be copied"),
}


def words(text: Column) -> Column:
    """Folded words of a paragraph: lower case, one spelling of licence, versions apart."""
    plain = F.replace(F.lower(text), F.lit("licenc"), F.lit("licens"))
    apart = F.regexp_replace(plain, "(?<=[a-z])v?(?=[0-9])", " ")
    return F.filter(F.split(apart, r"[^\p{L}\p{Nd}+]+"), lambda w: w != "")


def _grams(w: Column, n: int) -> Column:
    last = F.size(w) - (n - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))


def features(w: Column) -> Column:
    return F.concat(w, _grams(w, 2), _grams(w, 3))


class LicenceModel:
    """The fitted classifier, its vocabulary and content words, the calibrated threshold, and how it did on the held-out
    rows: ``recall`` by what is new in a row (phrasing, name, sentence), the share of statements that got their right
    family (or unknown); ``precision``, that of right ones among the named; ``coverage``, that of statements with a
    content word at all."""

    def __init__(self, vectors: CountVectorizerModel, model: LogisticRegressionModel, families: list[str], content: list[str], threshold: float):
        self.vectors, self.model, self.families, self.content, self.threshold = vectors, model, families, content, threshold
        self.recall: dict[str, float] = {}
        self.precision = self.coverage = 0.0

    def worth_judging(self, text: Column) -> Column:
        """Whether the paragraph has a content word of the vocabulary."""
        return F.arrays_overlap(words(text), F.array(*[F.lit(w) for w in self.content]))

    def predict(self, rows: DataFrame) -> DataFrame:
        """rows(..., __words) plus __family and __probability of the likeliest class, and __chances of all."""
        scored = self.model.transform(self.vectors.transform(rows.withColumn("__grams", features(F.col("__words")))))
        scored = scored.withColumn("__chances", vector_to_array("__chances"))
        names = F.array(*[F.lit(f) for f in self.families])
        return scored.withColumn("__family", F.get(names, F.col("__class").cast("int"))).withColumn("__probability", F.array_max("__chances")).drop("__grams", "__counts", "__raw", "__class")


def labelled_rows(spark: SparkSession) -> DataFrame:
    """family, text, new: the labelled sample; ``new`` says what of a held-out row no training row has, else it is null."""
    made = []
    for family in NAMES:
        # a bare name, or a short one in a phrasing that says nothing of a licence, is no statement where nothing is known about it
        for i, phrasing in enumerate(PHRASINGS):
            held = "phrasing" if i % FOLDS == 0 else None
            made += [(family, phrasing.format(name), held) for name in NAMES[family]]
            made += [(family, phrasing.format(name), "name") for name in HELD_NAMES[family] if held is None]
    for family, all_ in SENTENCES.items():
        made += [(family, s, "sentence" if i % FOLDS == FOLDS - 1 else None) for i, s in enumerate(all_)]
    made += [(RESERVED, f"No part of this {x} may be {y} without {z}.", "sentence" if (x == PARTS[0]) or (y == DEEDS[0]) or (z == LEAVES[0]) else None) for x in PARTS for y in DEEDS for z in LEAVES]
    made += [(NONE, o.format(kind), "sentence" if not i % FOLDS or not j % FOLDS else None) for i, kind in enumerate(PERSONAL) for j, o in enumerate(OCCASIONS)]
    made += [(NONE, text, "sentence" if not i % FOLDS else None) for i, text in enumerate(OTHERWISE)]
    made += [(RESERVED, notice + right, "sentence" if i % FOLDS == FOLDS - 1 else None) for notice in NOTICES for i, right in enumerate(RIGHTS)]
    return spark.createDataFrame(made, "family string, text string, new string").coalesce(1)


def fit(spark: SparkSession) -> LicenceModel:
    families = sorted({*NAMES, *SENTENCES, RESERVED})
    place = F.create_map(*[x for i, f in enumerate(families) for x in (F.lit(f), F.lit(float(i)))])
    ready = lambda df: df.withColumn("__words", words(F.col("text"))).withColumn("label", place[F.col("family")]).withColumn("__grams", features(F.col("__words")))
    rows = ready(labelled_rows(spark)).cache()
    train = rows.where("new is null")
    # content words: those of statements, but for the function words and those that are not told from other sentences' ones
    used = train.select("family", F.explode(F.array_distinct("__words")).alias("w")).groupBy("w").agg(F.count_if(F.col("family") != NONE).alias("yes"), F.count_if(F.col("family") == NONE).alias("no"))
    real = used.where((F.col("yes") > 0) & (F.col("yes") >= 2 * F.col("no")) & F.col("w").rlike("[a-z]{2}") & ~F.col("w").isin(FUNCTION_WORDS))
    content = sorted(r.w for r in real.collect())
    # a content word alone makes no statement
    named = {w for names in (*NAMES.values(), *HELD_NAMES.values()) for n in names for w in n.lower().replace("-", " ").split()} | {"gpl", "lgpl", "agpl", "mpl"}
    lone = spark.createDataFrame([(NONE, text, None) for w in content if w not in named for text in (f"there was {w} in the house", f"the {w} of the old town")], "family string, text string, new string").coalesce(1)
    rows = rows.unionByName(ready(lone))
    train = rows.where("new is null")
    # every family has the same weight, plain sentences that of PLAIN families
    sizes = train.groupBy("family").agg((F.when(F.col("family") == NONE, PLAIN).otherwise(1.0) / F.count(F.lit(1))).alias("weight"))
    has_one = F.arrays_overlap(F.split("g", " "), F.array(*[F.lit(w) for w in content]))
    # the vocabulary: n-grams of the training rows with a content word, so its size is bounded as they are; names of unknown
    # licences are not in it, so that what is learned about them is how a statement reads whose name says nothing
    told = train.where(F.col("family") != UNKNOWN).select(F.explode("__grams").alias("g")).distinct()
    # and the words that stand beside licences of other kinds
    beside = train.where((F.col("family") == NONE) & F.array_contains("__words", "license")).select(F.explode("__words").alias("g")).distinct()
    vocabulary = [r[0] for r in told.where(has_one).union(beside).distinct().orderBy("g").collect()]
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="__grams", outputCol="__counts")
    vectors.setBinary(True)
    counted = vectors.transform(rows.join(sizes, "family"))
    learner = LogisticRegression(weightCol="weight", featuresCol="__counts", labelCol="label", predictionCol="__class", probabilityCol="__chances", rawPredictionCol="__raw", maxIter=100, regParam=0.0001, family="multinomial")
    model = learner.fit(counted.where("new is null"))
    judge = LicenceModel(vectors, model, families, content, 0.0)
    held = model.transform(counted.where("new is not null")).select("family", "new", "label", "__class", F.array_max(vector_to_array("__chances")).alias("p"), judge.worth_judging(F.col("text")).alias("seen"))
    held = held.withColumn("__class", F.when(F.col("seen"), F.col("__class")).otherwise(F.lit(float(families.index(NONE))))).cache()
    named = ~F.col("__class").isin(float(families.index(NONE)), float(families.index(UNKNOWN)))
    # from the surest answer down: the share of right ones so far; the lowest p that still has PRECISION
    order = Window.orderBy(F.desc("p")).rangeBetween(Window.unboundedPreceding, 0)
    answers = held.where(named).withColumn("right", (F.col("__class") == F.col("label")).cast("double"))
    answers = answers.withColumn("precision", F.avg("right").over(order))
    threshold = answers.where(F.col("precision") >= PRECISION).agg(F.min("p")).first()[0]
    judge.threshold = 1.0 if threshold is None else threshold
    final = F.when(named & (F.col("p") < judge.threshold), F.lit(float(families.index(UNKNOWN)))).otherwise(F.col("__class"))
    judged = held.select("new", "family", "seen", (F.col("label") == final).cast("double").alias("right"), (named & (F.col("p") >= judge.threshold)).alias("named"))
    statements = judged.where(F.col("family") != NONE)
    judge.recall = {r["new"]: r["recall"] for r in statements.groupBy("new").agg(F.avg("right").alias("recall")).collect()}
    judge.coverage = statements.agg(F.avg(F.col("seen").cast("double"))).first()[0]
    judge.precision = judged.where("named").agg(F.avg("right")).first()[0]
    rows.unpersist()
    held.unpersist()
    return judge


def template_share(w: Column, family: str) -> Column:
    """The largest share of a template's word n-grams (its length, three at most) that the paragraph holds."""
    shares = []
    for template in TEMPLATES.get(family, ()):
        parts = template.split(" ")
        n = min(3, len(parts))
        grams = list(dict.fromkeys(" ".join(parts[i : i + n]) for i in range(len(parts) - n + 1)))
        shares.append(F.size(F.array_intersect(_grams(w, n), F.array(*[F.lit(g) for g in grams]))) / F.lit(float(len(grams))))
    return reduce(F.greatest, shares) if len(shares) > 1 else shares[0] if shares else F.lit(0.0)


def scan_licences(docs: DataFrame, containment: float = 0.75, model: LicenceModel | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_paragraphs, n_confirmed, n_unknown, families, verdict."""
    model = model or fit(docs.sparkSession)
    number = unused("__row", docs)
    lines = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: F.trim(x) != "")
    # numbers of one scan, which only tell rows apart until their paragraphs meet again
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias(number), lines.alias("__lines"))
    # a text without a paragraph that is worth judging keeps a row that has none
    some = F.filter("__lines", lambda x: model.worth_judging(x))
    rows = rows.select("doc_id", number, F.size("__lines").cast("long").alias("n_paragraphs"), F.explode_outer(some).alias("__line"))
    real = F.col("__line").isNotNull()
    predicted = model.predict(rows.withColumn("__words", F.when(real, words(F.col("__line"))).otherwise(F.array().cast("array<string>"))))
    chance = {f: F.get("__chances", F.lit(i)) for i, f in enumerate(model.families)}
    sure = [F.when((F.col("__family") == f) & (F.col("__probability") >= model.threshold) | (F.col("__family") != NONE) & (chance[f] >= SECOND), F.when(template_share(F.col("__words"), f) >= containment, f)) for f in TEMPLATES]
    judged = predicted.withColumn("__sure", F.array_compact(F.array(*sure)))
    # cc-by's template lies inside that of cc-by-nc
    judged = judged.withColumn("__sure", F.when(F.array_contains("__sure", "cc-by-nc"), F.array_remove("__sure", "cc-by")).otherwise(F.col("__sure")))
    keys = ["doc_id", number, "n_paragraphs"]
    named = judged.select(*keys, (real & (F.col("__family") != NONE)).alias("__named"), F.when(real, F.col("__sure")).otherwise(F.array().cast("array<string>")).alias("__sure"))
    whole = named.groupBy(number, "doc_id", "n_paragraphs").agg(
        F.count_if(F.size("__sure") > 0).alias("n_confirmed"), F.count_if(F.col("__named") & (F.size("__sure") == 0)).alias("n_unknown"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__sure")))).alias("families"),
    )
    verdict = F.when(F.size("families") == 1, F.get("families", F.lit(0))).when(F.size("families") > 1, "several").when(F.col("n_unknown") > 0, UNKNOWN).otherwise(NONE)
    return whole.select("doc_id", "n_paragraphs", "n_confirmed", "n_unknown", "families", verdict.alias("verdict"))
