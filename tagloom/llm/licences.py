"""Licence notices by a trained paragraph classifier.

Paragraphs (lines with a word) are turned into the word one- and two-grams of
the templates below that they hold; a multinomial logistic regression, sparse by
its penalty, tells the licence family or "unknown". It is fitted on three
quarters of all paragraphs of the table, each as an example of "unknown" and
once more with a template, whole or cut, set beside it. A family counts only
above a probability that the other quarter reaches once in a thousand, and
comparing the words with the family's templates confirms it. Notices that run
over line ends are rated as well: the words before and behind a line end that a
template could span, where these hold enough of a template.
The texts are read once: what they hold of the templates is written to the
shared folder, and the fit, on paragraphs that are alike counted together, and
the rating both read that.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import identified
from tagloom.session import local_frame, materialised

# Short notices and opening sentences of public licences, by family.
TEMPLATES = {
    "agpl": ["This work is licensed under the GNU Affero General Public License, version 3.",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "bsd": ["Released under the BSD 3-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by": ["Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "lgpl": ["This work is licensed under the GNU Lesser General Public License, version 3.",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License, version 2.0."],
    "proprietary": ["All rights reserved.",
                    "All rights reserved. No part of this publication may be reproduced without permission.",
                    "This document is confidential and proprietary and may not be copied or distributed"],
}
FAMILIES = ["unknown", *sorted(TEMPLATES)]

PARTS = 4  # one part of the paragraphs is held out
BINS = 10_000  # steps of the threshold
UNKNOWN_SHARE = 0.999  # share of held-out unknown paragraphs that must stay below the threshold
OPENING = 4  # first words of a template; a paragraph with them is no example of the unknown class
CONFIRMED = 0.6  # least share of a template's two-grams in the paragraph


def words(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits, and characters beyond ASCII."""
    return F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _plain_words(text: str) -> list[str]:
    """The same of a template."""
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w]


def two_grams(tokens: Column) -> Column:
    pairs = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(tokens) > 1, F.slice(pairs, 1, F.greatest(F.size(tokens) - 1, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, paragraph, words, grams)``: every line with a word, by its number in the text."""
    lines = identified(docs, id_col, text_col).select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    split = lines.select("doc_id", "paragraph", words(F.col("line")).alias("words")).where(F.size("words") > 0)
    return split.withColumn("grams", F.concat("words", two_grams(F.col("words"))))


SPAN = max(len(_plain_words(t)) for texts in TEMPLATES.values() for t in texts)  # words a template has at most


def _plain_grams(tokens: list[str]) -> list[str]:
    """The distinct two-grams of a template's words."""
    return sorted({f"{a} {b}" for a, b in zip(tokens, tokens[1:])})


TEMPLATE_WORDS = sorted({w for texts in TEMPLATES.values() for t in texts for w in _plain_words(t)})
TEMPLATE_GRAMS = sorted({g for texts in TEMPLATES.values() for t in texts for g in _plain_grams(_plain_words(t))})
VOCABULARY = TEMPLATE_WORDS + TEMPLATE_GRAMS  # what the classifier looks at


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, paragraph, before, head, tail, words, hash)``: the lines with a word, and the line ends a notice may run over.

    A word of no template is null. ``hash`` is that of the whole line; a line end has none.
    A line has null in ``before``, ``head`` and ``tail``. For a line end with words on both sides, by the number of its line,
    ``head`` holds the last words of the line, ``tail`` the next ones up to the next line without a word, ``before`` the last
    ones of the line before it; each as many as a template has at most, so ``words``, the first two, hold all that spans the end.

    A notice over a line end is more like a template than the tail alone, so the head, with the first word behind it, holds a
    two-gram of a template; and it is as like as a confirmed one. Line ends without these are no rows. Lines and line ends
    leave one pass over the split text, which is never carried beside its parts.
    """
    known = lambda line: F.transform(words(line), lambda w: F.when(w.isin(TEMPLATE_WORDS), w))
    tokens = identified(docs, id_col, text_col).select("doc_id", F.transform(F.split("text", "\n"), known).alias("lines"),
                                                       F.transform(F.split("text", "\n"), lambda line: F.xxhash64(line)).alias("hashes"))
    grams, none = F.array(*map(F.lit, TEMPLATE_GRAMS)), F.lit(None).cast("array<string>")

    def last(line: Column) -> Column:
        return F.slice(line, F.greatest(F.size(line) - SPAN + 1, F.lit(1)), SPAN)

    def line_end(i: Column) -> Column:
        here, following = F.element_at("lines", i), F.slice("lines", i + 1, SPAN)
        stop = F.array_position(F.transform(following, F.size), 0)
        block = F.when(stop > 0, F.slice(following, 1, F.greatest(stop - 1, F.lit(0)).cast("int"))).otherwise(following)
        before = F.when(i > 1, last(F.element_at("lines", F.greatest(i - 1, F.lit(1))))).otherwise(F.slice(here, 1, 0))
        return F.struct((i - 1).alias("paragraph"), before.alias("before"), last(here).alias("head"),
                        F.slice(F.flatten(block), 1, SPAN).alias("tail"), none.alias("words"), F.lit(None).cast("long").alias("hash"))

    def line(i: Column) -> Column:
        return F.struct((i - 1).alias("paragraph"), none.alias("before"), none.alias("head"), none.alias("tail"),
                        F.element_at("lines", i).alias("words"), F.element_at("hashes", i).alias("hash"))

    def may_span(i: Column) -> Column:
        here, following = F.get("lines", i - 1), F.get("lines", i)
        both = (i < F.size("lines")) & (F.size(here) > 0) & (F.size(following) > 0)
        return both & F.arrays_overlap(two_grams(F.concat(last(here), F.slice(following, 1, 1))), grams)

    numbers = F.sequence(F.lit(1), F.size("lines"))
    parts = F.concat(F.transform(F.filter(numbers, lambda i: F.size(F.get("lines", i - 1)) > 0), line),
                     F.transform(F.filter(numbers, may_span), line_end))
    # The outer form keeps Spark from building the parts once more just to skip texts without any.
    rows = tokens.select("doc_id", F.explode_outer(F.when(F.col("lines").isNotNull(), parts)).alias("part")).where("part is not null")
    rows = rows.select("doc_id", "part.*").withColumn("words", F.coalesce("words", F.concat("head", "tail"), F.array().cast("array<string>")))
    return rows.where(F.col("head").isNull() | (template_share(None, F.col("words")) >= CONFIRMED))


def shares(family: Column | None, own: Column) -> Column:
    """The largest share of a template's two-grams among the given ones; of one family's templates, or of any."""
    found = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            parts = _plain_grams(_plain_words(text))
            share = F.size(F.array_intersect(own, F.array(*map(F.lit, parts)))) / F.lit(float(len(parts)))
            found.append(share if family is None else F.when(family == name, share).otherwise(0.0))
    return F.greatest(*found)


def template_share(family: Column | None, tokens: Column) -> Column:
    """The same among the two-grams of words."""
    return shares(family, two_grams(tokens))


def has_opening(own: Column) -> Column:
    """Whether the two-grams hold all those of a template's first words."""
    openings = sorted({tuple(_plain_grams(_plain_words(t)[:OPENING])) for texts in TEMPLATES.values() for t in texts})
    return reduce(lambda a, b: a | b, [F.size(F.array_intersect(own, F.array(*map(F.lit, o)))) == len(o) for o in openings])


def searched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``blocks`` with ``grams``, what each row holds of the vocabulary, for its words; written, as several steps read it."""
    own = F.concat("words", two_grams(F.col("words")))
    grams = F.array_sort(F.array_distinct(F.filter(own, lambda g: g.isin(VOCABULARY))))
    return materialised(blocks(docs, id_col, text_col).select("doc_id", "paragraph", "before", "head", "tail", grams.alias("grams"), "hash"), "paragraphs")


@dataclass
class LicenceModel:
    classifier: LogisticRegressionModel
    threshold: float


def _features(rows: DataFrame) -> DataFrame:
    """Which entries of the vocabulary are among ``grams``."""
    vectors = CountVectorizerModel.from_vocabulary(VOCABULARY, inputCol="grams", outputCol="features").setBinary(True)
    return vectors.transform(rows)


def _variants() -> list[tuple[int, float, list[str]]]:
    """Number, label and grams of the templates, whole and without some of their first or last words."""
    made = []
    for family, texts in sorted(TEMPLATES.items()):
        for template in texts:
            tokens = template.split()
            cut = [tokens, *(tokens[k:] for k in (1, 2)), *(tokens[:-k] for k in (1, 2))]
            for part in map(_plain_words, (" ".join(c) for c in cut if len(c) >= max(3, len(tokens) - 2))):
                made.append((len(made), float(FAMILIES.index(family)), sorted({*part, *_plain_grams(part)} & {*VOCABULARY})))
    return made


def _counted(rows: DataFrame) -> DataFrame:
    """``(part, variant, grams, n)``: how many paragraphs that are no notice hold these grams, by the variant dealt to them.

    Part 0 is held out and has no variant. Equal lines are in one part, and the variants are dealt to them by their places.
    """
    part = F.pmod("hash", F.lit(PARTS)).cast("int")
    variant = F.when(part > 0, F.pmod(F.xxhash64("doc_id", "paragraph"), F.lit(len(_variants())))).cast("int")
    alike = rows.where("head is null").groupBy(part.alias("part"), variant.alias("variant"), "grams").agg(F.count("*").alias("n"))
    other = (shares(None, F.col("grams")) < CONFIRMED / 2) & ~has_opening(F.col("grams"))
    # Written, so that the comparison is made once for what is alike and not for every paragraph.
    return materialised(materialised(alike, "alike").where(other), "no-notices")


def _examples(counted: DataFrame) -> DataFrame:
    """``(label, grams, weight)``: every paragraph that is not held out, as it is and beside its variant, and the variants alone."""
    variants = local_frame(counted.sparkSession, _variants(), "variant int, label double, own array<string>")
    taught = counted.where("part > 0")
    plain = taught.groupBy("grams").agg(F.sum("n").cast("double").alias("weight")).select(F.lit(0.0).alias("label"), "grams", "weight")
    beside = taught.join(F.broadcast(variants), "variant").select("label", F.array_union("grams", "own").alias("grams"), F.col("n").cast("double").alias("weight"))
    alone = variants.select("label", F.col("own").alias("grams"), F.lit(1.0).alias("weight"))
    return materialised(plain.unionByName(beside).unionByName(alone), "examples")


def fit(docs: DataFrame) -> LicenceModel:
    """Fit the classifier on all paragraphs but those held out, and set the threshold by these."""
    return _fit(searched(docs))


def _fit(rows: DataFrame) -> LicenceModel:
    counted = _counted(rows)
    classifier = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, standardization=False, weightCol="weight")
    model = classifier.fit(_features(_examples(counted)).select("label", "features", "weight"))
    held_out = model.transform(_features(counted.where("part = 0"))).select("n", (1 - vector_to_array("probability")[0]).alias("p"))
    bins = held_out.groupBy(F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.sum("n").alias("n")).orderBy("bin").collect()
    total, below, top = sum(r["n"] for r in bins), 0, 0.0
    for r in bins:
        if below < UNKNOWN_SHARE * total:
            top = (r["bin"] + 1) / BINS
        below += r["n"]
    return LicenceModel(model, max(0.5, top))


def find(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph that holds a licence notice: family, probability, likeness to its templates, and whether that confirms it.

    A confirmed notice over several lines has a row of its own, with the number of its first line.

    Null and empty texts have no paragraphs, repeated rows give repeated rows, a null id is kept; an empty table gives no
    rows; further columns are ignored.
    """
    return _find(searched(docs, id_col, text_col), model)


def search(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``find`` with the model fitted on the same texts, which are read once for both."""
    rows = searched(docs, id_col, text_col)
    return _find(rows, _fit(rows))


def _find(rows: DataFrame, model: LicenceModel) -> DataFrame:
    rated = model.classifier.transform(_features(rows)).select(
        "doc_id", "paragraph", "before", "head", "tail", "grams", vector_to_array("probability").alias("p"))
    named = F.element_at(F.array(*map(F.lit, FAMILIES)), F.array_position("p", F.col("probability")).cast("int"))
    rated = rated.withColumn("probability", F.array_max(F.slice("p", 2, len(FAMILIES) - 1)))
    # Written, so that the comparison below is not merged into the filter over all paragraphs.
    rated = materialised(rated.where(F.col("probability") >= model.threshold), "notices")
    family, likeness = F.col("family"), F.col("likeness")
    rated = rated.withColumn("family", named).withColumn("likeness", shares(family, F.col("grams")))
    # A notice runs over a line end if neither side is as like by itself, and begins in its line if the line before adds nothing.
    over = (likeness >= CONFIRMED) & (likeness > F.greatest(*[template_share(family, F.col(c)) for c in ("head", "tail")]))
    over = over & (likeness >= template_share(family, F.concat("before", "head", "tail")))
    return rated.where(F.col("head").isNull() | over).select(
        "doc_id", F.col("paragraph").cast("long").alias("paragraph"), "family", "probability", "likeness",
        (likeness >= CONFIRMED).alias("confirmed"))
