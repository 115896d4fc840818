"""Licence notices in paragraphs. DataFrame functions and Spark's own classifier only.

A paragraph is a line, or, where a notice is wrapped, a line and those after it up to a blank line, as far as the longest
notice can reach from the line's last words. A multinomial logistic regression over hashed word n-grams tells which licence family a paragraph
names, or that it names none ("unknown"). It is learned from the notices below, whole and in parts, against a bounded
sample of the corpus's own paragraphs and sentences that only mention licences. Its chances are calibrated by a
temperature: the one that suits best a classifier learned without a notice of every family, on just those notices. A paragraph that is likelier than not of a family is compared
with that family's notices: the share of a notice's word pairs that the paragraph holds must reach ``CONFIRM``.

What can be confirmed decides what is classified, and nothing is lost by that. A paragraph that is confirmed holds at least ``CONFIRM`` of
the n word pairs of some notice, so it lacks at most n - ceil(CONFIRM * n) of them, and of any set with one pair more than
that it holds one. ``gate_pairs`` takes such a set of each notice, of its more unusual pairs; a paragraph with none of them
need not be looked at, whatever the classifier would say. So the corpus is scanned once with a pattern of these pairs.
"""

import math
import re
from collections import defaultdict
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimledger.llm.common import stored

# Words of licences. Only the corpus's lines without any are taken as examples of text that names none.
LICENCE_WORDS = (
    r"(?i)licen[sc]|copyright|copyleft|warrant|redistribut|public\W+domain|creative\W+commons|\bspdx\b|all\W+rights\W+reserved"
    r"|hereby\W+granted|free\W+of\W+charge|associated\W+documentation|source\W+and\W+binary|source\W+code\W+form|free\W+software"
    r"|no\W+part\W+of\W+this|gpl|\bgnu\b|\bmpl\b|\bbsd\b|mozilla\W+public|\bcc0|\bcc\W+by\b|apache\W+2|(?-i:\bMIT\b)"
)
# Words that most texts hold: a pair with fewer of them is more unusual.
USUAL = frozenset("# a all and any are as be by can in is it law may no not of or part this the to under version with without work you".split())
BITS = 12
CONFIRM = 0.5
MAX_BACKGROUND = 400
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 3.0)
UNKNOWN = "unknown"

# Short forms of the notices by which each family is named in files and on pages.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GNU General Public License version 2 or later",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GPLv3 or later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "LGPLv3 or later",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD license",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC0": (
        "This work is dedicated to the public domain under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2020 Example Company. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without written permission",
    ),
}


def notice_words(notice: str) -> list[str]:
    """What ``words`` gives for a notice."""
    return ["#" if w[0].isdigit() else w for w in re.findall(r"[^\W\d_]+|[0-9]+(?:\.[0-9]+)*", notice.lower())]


# Words of the longest notice.
LONGEST = max(len(notice_words(notice)) for own in NOTICES.values() for notice in own)
# Sentences that mention licences and name none.
MENTIONS = (
    "The driver showed a valid license to the officer.",
    "A license is required to fish in this lake.",
    "Please read the license carefully before you decide.",
    "He was licensed to practice medicine in the state.",
    "The software license costs more every year.",
    "Copyright law protects authors and artists.",
    "The warranty does not cover damage by water.",
    "The court issued a warrant for his arrest.",
    "Wealth was redistributed among the people.",
    "The license plate of the car was missing.",
    "Licensed premises must close at midnight.",
    "The version of the license was not stated.",
    "Under the terms of the contract the company pays for public transport.",
    "The general public was admitted to the library free of charge.",
)


def gate_pairs(tokens: list[str]) -> list[tuple[str, str]]:
    """Word pairs of a notice of which every paragraph that it can confirm holds one."""
    own = sorted(set(zip(tokens, tokens[1:], strict=False)), key=lambda p: (len(USUAL.intersection(p)), -len(p[0] + p[1]), p))
    return own[: len(own) - max(1, math.ceil(CONFIRM * len(own))) + 1]


def _gate() -> str:
    """A pattern that every text in lower case matches that has one of the notices' ``gate_pairs``."""
    then = defaultdict(set)
    for own in NOTICES.values():
        for notice in own:
            for first, second in gate_pairs(notice_words(notice)):
                # Numbers stand apart from letters without anything between.
                then[first].add(("[^\\p{L}0-9#]*" if "#" in (first, second) else "[^\\p{L}0-9#]+") + second.replace("#", "[0-9#]"))
    at = defaultdict(list)
    for first, rest in sorted(then.items()):
        at[first[0]].append(first[1:] + f"(?:{'|'.join(sorted(rest))})")
    starts = [(c.replace("#", "[0-9#]") if c == "#" else rf"{c}(?<![\p{{L}}#]{c})") + f"(?:{'|'.join(ends)})" for c, ends in sorted(at.items())]
    return "|".join(starts)


GATE = _gate()


def may_name(text: Column) -> Column:
    """Whether a text can be confirmed as any notice. Never false where it can."""
    return F.lower(text).rlike(GATE)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Words in lower case, version numbers as ``#``: a notice is the same in every version."""
    plain = F.regexp_replace(F.lower(text), r"[0-9]+(?:\.[0-9]+)*", " # ")
    return F.filter(F.split(F.regexp_replace(plain, r"[^\p{L}#]+", " "), " "), lambda w: w != "")


def _pairs(tokens: Column) -> Column:
    return F.when(
        F.size(tokens) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - 1),
            lambda i: F.concat_ws(" ", F.element_at(tokens, i), F.element_at(tokens, i + 1)),
        ),
    ).otherwise(F.array().cast("array<string>"))


def grams(tokens: Column) -> Column:
    """Words, word pairs and word triples."""
    triples = F.when(
        F.size(tokens) > 2,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - 2),
            lambda i: F.concat_ws(" ", F.element_at(tokens, i), F.element_at(tokens, i + 1), F.element_at(tokens, i + 2)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, _pairs(tokens), triples)


def paragraphs(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, paragraph, last, start, words, head, content) of the lines that can be notices, alone and with the lines after them.

    A line alone has no ``head`` and is its own ``last``. Else ``words`` are the line's last words, ``head`` of them, and the
    first words after it, up to a blank line and at most ``LONGEST`` of each: a notice that begins in the line and ends
    in a later one is among them whole. ``row`` numbers the documents' rows. Starts are code points.
    """
    given = documents.where(may_name(F.col(text))).select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("_text"))
    lines = given.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.split("_text", "\n").alias("_lines"))
    starts = F.aggregate(
        "_lines",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda s, line: F.struct((s["at"] + F.length(line) + 1).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
        lambda s: s["out"],
    )
    told = lines.select(
        "row",
        "doc_id",
        F.transform(
            F.arrays_zip(F.col("_lines").alias("content"), starts.alias("start"), F.transform("_lines", words).alias("words")),
            lambda line, i: F.struct(i.alias("at"), line["start"].alias("start"), line["content"].alias("content"), line["words"].alias("words")),
        ).alias("_told"),
    )

    def made(line: Column, last: Column, tokens: Column, head: Column, content: Column) -> Column:
        return F.struct(
            line["at"].alias("paragraph"), last.alias("last"), line["start"].alias("start"), tokens.alias("words"), head.alias("head"), content.alias("content")
        )

    alone = F.transform(
        F.filter("_told", lambda line: may_name(line["content"])),
        lambda line: made(line, line["at"], line["words"], F.lit(None).cast("int"), line["content"]),
    )

    def after(line: Column) -> Column:
        """The words after a line, the last line they are taken from, and whether more can follow."""
        return F.aggregate(
            F.slice("_told", line["at"] + 2, LONGEST),
            F.struct(F.array().cast("array<string>").alias("words"), line["at"].alias("last"), (F.size(line["words"]) > 0).alias("more")),
            lambda s, then: F.when(
                s["more"] & (F.size(then["words"]) > 0),
                F.struct(
                    F.concat(s["words"], then["words"]).alias("words"),
                    then["at"].alias("last"),
                    (F.size(s["words"]) + F.size(then["words"]) < LONGEST).alias("more"),
                ),
            ).otherwise(F.struct(s["words"].alias("words"), s["last"].alias("last"), F.lit(False).alias("more"))),
        )

    def wrapped(line: Column, then: Column) -> Column:
        head = F.least(F.size(line["words"]), F.lit(LONGEST))
        tokens = F.concat(F.slice(line["words"], F.size(line["words"]) - head + 1, head), F.slice(then["words"], 1, LONGEST))
        inside = F.slice("_told", line["at"] + 1, then["last"] - line["at"] + 1)
        return made(line, then["last"], tokens, head, F.concat_ws("\n", F.transform(inside, lambda x: x["content"])))

    several = F.filter(
        F.transform("_told", lambda line: _once(after(line), lambda then: wrapped(line, then))),
        lambda p: (p["last"] > p["paragraph"]) & may_name(p["content"]),
    )
    return told.select("row", "doc_id", F.explode(F.concat(alone, several)).alias("p")).select("row", "doc_id", "p.*")


def _examples(spark: SparkSession, documents: DataFrame, text: str) -> DataFrame:
    """(family, words, held_out): notices whole, by half and inside other text, and background.

    Held out, in every form, are one notice of each family and every third example of background.
    """
    notices = [(family, notice, i % 3 == 1) for family, own in NOTICES.items() for i, notice in enumerate(own)]
    mentions = [(UNKNOWN, mention, i % 3 == 1) for i, mention in enumerate(MENTIONS)]
    plain = spark.createDataFrame([*notices, *mentions], "family string, text string, held_out boolean")
    lines = (
        documents.where(F.col(text).isNotNull())
        .select(F.xxhash64(text).alias("order"), F.get(F.split(text, "\n"), F.lit(0)).alias("text"))
        .where(~F.col("text").rlike(LICENCE_WORDS) & (F.length("text") > 0))
    )
    # A fixed choice of the corpus's own paragraphs, bounded: those whose texts hash lowest.
    background = lines.orderBy("order", "text").limit(MAX_BACKGROUND).select(
        F.lit(UNKNOWN).alias("family"), F.substring("text", 1, 400).alias("text"), (F.pmod("order", F.lit(3)) == 1).alias("held_out")
    )
    tokens = plain.union(background).select("family", "held_out", words(F.col("text")).alias("words"))
    half = F.ceil(F.size("words") / 2).cast("int")
    filler = F.array(*[F.lit(w) for w in ("see", "also", "the", "notes", "below")])
    # A long notice names its family also by its beginning or end alone; unknown text stays unknown however it is cut.
    cut = (F.size("words") > 12) | (F.col("family") == UNKNOWN)
    variants = F.array(
        F.col("words"),
        F.concat(filler, F.col("words")),
        F.concat(F.col("words"), filler),
        F.when(cut, F.slice("words", F.lit(1), half)),
        F.when(cut, F.slice("words", half - F.floor(half / 3).cast("int") + 1, F.size("words"))),
        F.concat(F.col("words"), F.col("words")),
    )
    return tokens.select("family", "held_out", F.explode(variants).alias("words")).where(F.size("words") > 0)


class LicenceModel:
    """A fitted classifier, the families by class number, the notices' word pairs, and the temperature of its chances."""

    def __init__(
        self,
        classifier: LogisticRegressionModel,
        families: list[str],
        templates: list[tuple[str, list[str]]],
        temperature: float,
    ):
        self.classifier = classifier
        self.families = families
        self.templates = templates
        self.temperature = temperature

    def chances(self, rows: DataFrame, temperatures: tuple[float, ...] = ()) -> DataFrame:
        """``rows`` (with ``words``) with the calibrated chance of each family as an array; one array per temperature given."""
        raw = self.classifier.transform(_hashed(rows)).withColumn("_raw", vector_to_array("_raw"))

        def softmax(heat: float) -> Column:
            def powers(most: Column) -> Column:
                return F.transform("_raw", lambda r: F.exp((r - most) / heat))

            def shares(given: Column) -> Column:
                total = F.aggregate(given, F.lit(0.0), lambda s, x: s + x)
                return _once(total, lambda t: F.transform(given, lambda x: x / t))

            return _once(_once(F.array_max("_raw"), powers), shares)

        chances = F.array(*map(softmax, temperatures)) if temperatures else softmax(self.temperature)
        return raw.withColumn("chances", chances).drop("_raw", "_features", "_grams", "_likelihood", "_class")


def _hashed(rows: DataFrame) -> DataFrame:
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=1 << BITS, binary=True)
    return hashing.transform(rows.withColumn("_grams", _once(F.col("words"), grams)))


def train(documents: DataFrame, text: str = "text") -> LicenceModel:
    """Learn from the notices and at most ``MAX_BACKGROUND`` paragraphs of the corpus."""
    spark = documents.sparkSession
    families = [UNKNOWN, *NOTICES]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    examples = _examples(spark, documents, text).withColumn("label", number)
    # Some thousand short rows, written once and not made again for each pass of the optimizer.
    rows = stored(examples)
    regression = LogisticRegression(
        featuresCol="_features", labelCol="label", rawPredictionCol="_raw", probabilityCol="_likelihood", predictionCol="_class",
        family="multinomial", regParam=0.001, maxIter=60, standardization=False,
    )
    notices = spark.createDataFrame([(f, n) for f, own in NOTICES.items() for n in own], "family string, text string")
    pairs = notices.select("family", F.array_distinct(_pairs(words(F.col("text")))).alias("pairs")).collect()
    templates = [(r.family, r.pairs) for r in pairs]

    def learned(examples: DataFrame, temperature: float = 1.0) -> LicenceModel:
        return LicenceModel(regression.fit(_hashed(examples).coalesce(1)), families, templates, temperature)

    held = learned(rows.where("not held_out")).chances(rows.where("held_out"), TEMPERATURES).select("label", "chances")
    # Log loss of every temperature in one pass.
    place = (F.col("label") + 1).cast("int")
    losses = held.select(
        [
            F.avg(-F.log(F.greatest(F.element_at(F.element_at("chances", i + 1), place), F.lit(1e-12)))).alias(f"loss_{i}")
            for i in range(len(TEMPERATURES))
        ]
    ).first()
    return learned(rows, min(zip(losses, TEMPERATURES, strict=True), key=lambda x: (x[0] is None, x[0], x[1]))[1])


def similarity(tokens: Column, family: Column, templates: list[tuple[str, list[str]]]) -> Column:
    """The greatest share of the word pairs of one of the family's notices that the words hold."""

    def best(pairs: Column) -> Column:
        return F.greatest(
            *[F.when(family == name, F.size(F.array_intersect(F.array(*map(F.lit, own)), pairs)) / len(own)) for name, own in templates]
        )

    return F.coalesce(_once(_once(tokens, _pairs), best), F.lit(0.0))


def find_licences(documents: DataFrame, model: LicenceModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per paragraph that names a licence: doc_id, paragraph (from 0), start, family, probability, similarity, content.

    A notice within a line is told with that line. One that is wrapped is told once, with the line it begins in and the content
    up to where the longest notice could end, unless a line among them names the family by itself. NULL and empty texts
    have no paragraphs. Repeated rows give their rows again; a NULL id stays NULL. Only what is confirmed is shuffled.
    """
    # Only paragraphs that can be confirmed: written, so that each is classified once.
    scored = stored(model.chances(paragraphs(documents, id, text)))
    best = F.array_max(F.transform("chances", lambda c, i: F.struct(c.alias("probability"), (-i).alias("place"))))
    family = F.element_at(F.array(*map(F.lit, model.families)), (1 - F.col("best.place")).cast("int"))
    rows = scored.withColumn("best", best).withColumn("family", family).withColumn("probability", F.col("best.probability"))
    rows = rows.where((F.col("family") != UNKNOWN) & (F.col("probability") >= 0.5))

    def similar(tokens: Column) -> Column:
        return similarity(tokens, F.col("family"), model.templates)

    rows = stored(rows.withColumn("similarity", similar(F.col("words"))).where(F.col("similarity") >= CONFIRM).drop("best", "chances"))
    # What is wrapped needs words of the line and words after it.
    parts = F.greatest(similar(F.slice("words", F.lit(1), F.col("head"))), similar(F.slice("words", F.col("head") + 1, F.lit(LONGEST))))
    rows = rows.where(F.col("head").isNull() | (F.col("similarity") > parts))
    here = Window.partitionBy("row", "family").orderBy("paragraph")
    line = F.min(F.when(F.col("head").isNull(), F.col("paragraph"))).over(here.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("_line", line).where(F.col("head").isNull() | F.col("_line").isNull() | (F.col("_line") > F.col("last")))
    # Of those that begin in lines next to each other, the one that holds most.
    kind = Window.partitionBy("row", "family", F.col("head").isNull()).orderBy("paragraph")
    place = F.struct("paragraph", "similarity")
    rows = rows.withColumn("_before", F.lag(place).over(kind)).withColumn("_after", F.lead(place).over(kind))

    def less(other: str, step: int) -> Column:
        return F.coalesce((F.col(f"{other}.paragraph") == F.col("paragraph") + step) & (F.col(f"{other}.similarity") > F.col("similarity")), F.lit(False))

    rows = rows.where(F.col("head").isNull() | ~(less("_before", -1) | less("_after", 1)))
    return rows.select("doc_id", "paragraph", "start", "family", "probability", "similarity", "content")
