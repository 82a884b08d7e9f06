"""Licence scans by a trained paragraph classifier, in DataFrame operations.

Every paragraph (line with text) of every document, and every run of wrapped
lines up to a blank one that may hold a notice, becomes hashed word 1- and
2-grams. A sparse multinomial logistic regression (Spark ML) gives the
probability of each licence family and of "unknown". It is trained on the
templates, on copies of them that lack one word or stand among other words
(if they still tell the family), and, for unknown, on all distinct paragraphs
that it is asked about and that are unlike all templates. A paragraph is a licence when the probability of any
family reaches the threshold, which is calibrated on the third of the unknown
paragraphs that is held out; its family is the likeliest whose tell (name, version, NC and the
like, ``TELLS``) it holds. The template comparison confirms it: ``CONTAINED``
of the words of some template of that family are in the paragraph. The opening
sentence that all BSD licences share is the family "BSD". A notice wrapped over
lines counts once; ``n_paragraphs`` counts lines.

No Python runs on the executors. A paragraph that holds no anchor (a pattern
that every tell contains) cannot be confirmed, so the classifier is not asked
about it and does not learn from it; this leaves out no result. Texts are read
once for blocks with an anchor, which are written.

Edge cases: NULL or empty text has no paragraphs and no licence; repeated rows
each get their result; an empty table gives no rows. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

def _named(names: list[str], *notices: str) -> list[str]:
    """The usual sentences that name a licence, and its own notices."""
    return [t for n in names for t in (f"Licensed under the {n}.", f"Released under the {n}.",
                                       f"This work is licensed under the {n}.",
                                       f"SPDX-License-Identifier: {n}")] + list(notices)


def _gnu(name: str, short: str, version: str) -> list[str]:
    return _named([f"GNU {name}, version {version}", f"GNU {name} v{version}", f"{short}-{version}", f"{short} version {version}"],
                  f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
                  f"as published by the Free Software Foundation, either version {version} of the License.",
                  f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as "
                  f"published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.")


def _gnu_tell(name: str, short: str, version: str) -> str:
    # the first version after the name tells; "-only", "-or-later" and "+" keep the family
    v = rf"(?:version |v\.? ?)?{version}(?:-only|-or-later|\+)?(?= )"
    return rf" gnu {name}(?: (?!version |v?[0-9])\S+){{0,14}} {v}| (?:gnu )?{short}[ -]?{v}"


def _cc(parts: str, words: str, version: str, scope: str) -> list[str]:
    return [f"Licensed under CC {parts} {version}.", f"Released under the CC {parts} {version} license.",
            f"This work is licensed under CC {parts} {version}.", f"SPDX-License-Identifier: CC-{parts}-{version}",
            f"This work is licensed under a Creative Commons {words} {version} {scope} License.",
            f"Licensed under the Creative Commons {words} {version} {scope} License."]


def _cc_tell(parts: str, words: str, version: str) -> str:
    v, gap = version.replace(".", r"\."), "(?: (?:license|licence|public|international|unported|version)){0,3}"
    return rf" cc[ -]{parts}{gap}[ -]v?{v}(?= )| creative commons {words}{gap} v?{v}(?= )"


_CC = {"BY": ("Attribution", "by", "attribution"),
       "BY-SA": ("Attribution-ShareAlike", "by[ -]sa", "attribution[ -]share[ -]?alike"),
       "BY-NC": ("Attribution-NonCommercial", "by[ -]nc", "attribution[ -]non[ -]?commercial"),
       "BY-ND": ("Attribution-NoDerivatives", "by[ -]nd", "attribution[ -]no[ -]?deriv(?:ative)?s"),
       "BY-NC-SA": ("Attribution-NonCommercial-ShareAlike", "by[ -]nc[ -]sa", "attribution[ -]non[ -]?commercial[ -]share[ -]?alike"),
       "BY-NC-ND": ("Attribution-NonCommercial-NoDerivatives", "by[ -]nc[ -]nd",
                    "attribution[ -]non[ -]?commercial[ -]no[ -]?deriv(?:ative)?s")}

#: The names and the wording of the public licence notices.
TEMPLATES = {
    "AGPL-3.0": _gnu("Affero General Public License", "AGPL", "3") + _named(["AGPL-3.0"]),
    "Apache-2.0": _named(
        ["Apache License, Version 2.0", "Apache-2.0", "Apache 2.0 license"],
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License."),
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"],
    "BSD-2-Clause": _named(["BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License"]),
    "BSD-3-Clause": _named(
        ["BSD 3-Clause License", "BSD-3-Clause", "New BSD License"],
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "BSL-1.0": _named(
        ["Boost Software License, Version 1.0", "BSL-1.0"],
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license."),
    "CC0-1.0": _named(
        ["CC0 1.0 Universal", "CC0-1.0"], "Licensed under CC0 1.0.",
        "To the extent possible under law, the author has dedicated all copyright to the public domain under the "
        "Creative Commons CC0 1.0 Universal Public Domain Dedication."),
    "EPL-2.0": _named(
        ["Eclipse Public License, version 2.0", "Eclipse Public License v2.0", "EPL-2.0"],
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    "GPL-2.0": _gnu("General Public License", "GPL", "2") + _named(["GPL-2.0"]),
    "GPL-3.0": _gnu("General Public License", "GPL", "3") + _named(["GPL-3.0"]),
    "ISC": _named(
        ["ISC License"], "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1": _gnu("Lesser General Public License", "LGPL", "2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "LGPL", "3") + _named(["LGPL-3.0"]),
    "MIT": _named(
        ["MIT License"], "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    "MPL-2.0": _named(
        ["Mozilla Public License, version 2.0", "Mozilla Public License v2.0", "MPL-2.0"],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Unlicense": _named(
        ["Unlicense"], "This is free and unencumbered software released into the public domain."),
    "Zlib": _named(
        ["zlib License"], "SPDX-License-Identifier: Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software."),
}
#: What a paragraph (lower-case words with one blank around each) must hold to be of the family: name, version, NC and the like.
TELLS = {
    "AGPL-3.0": _gnu_tell("affero general public licen[sc]e", "agpl", r"3(?:\.0)?"),
    "Apache-2.0": r" apache(?: software)?(?: licen[sc]e)?[ -](?:version |v\.? ?)?2(?:\.0)?(?= )",
    "BSD": r" redistribution and use in source and binary forms ",
    "BSD-2-Clause": r" bsd[ -](?:2|two)[ -]clause | (?:2|two)[ -]clause bsd | simplified bsd ",
    "BSD-3-Clause": r" bsd[ -](?:3|three)[ -]clause | (?:3|three)[ -]clause bsd | (?:new|modified|revised) bsd | neither the names? of ",
    "BSL-1.0": r" boost software licen[sc]e(?: version)? v?1(?:\.0)?(?= )| bsl-1\.0 | any person or organization obtaining a copy of the software ",
    "CC0-1.0": r" cc0(?: licen[sc]e| version)?[ -]1\.0(?: |-)",
    "EPL-2.0": r" eclipse public licen[sc]e(?: -)?[ -](?:version |v\.? ?)?2(?:\.0)?(?= )| epl[ -](?:version |v\.? ?)?2(?:\.0)?(?= )",
    "GPL-2.0": _gnu_tell("general public licen[sc]e", "gpl", r"2(?:\.0)?"),
    "GPL-3.0": _gnu_tell("general public licen[sc]e", "gpl", r"3(?:\.0)?"),
    "ISC": r" isc licen[sc]e | spdx-license-identifier isc | distribute this software for any purpose with or without fee is hereby "
           r"granted provided that the above copyright notice ",
    "LGPL-2.1": _gnu_tell("lesser general public licen[sc]e", "lgpl", r"2\.1"),
    "LGPL-3.0": _gnu_tell("lesser general public licen[sc]e", "lgpl", r"3(?:\.0)?"),
    "MIT": r" mit licen[sc]e | spdx-license-identifier mit | free of charge to any person obtaining a copy of this software ",
    "MPL-2.0": r" mozilla public licen[sc]e[ -](?:version |v\.? ?)?2(?:\.0)?(?= )| mpl[ -](?:version |v\.? ?)?2(?:\.0)?(?= )",
    "Unlicense": r" unlicense | free and unencumbered software released into the public domain ",
    "Zlib": r" zlib licen[sc]e | spdx-license-identifier zlib | authors? be held liable for any damages arising from the use of this software ",
}
for _version, _scope, _parts in (("4.0", "International", list(_CC)), ("3.0", "Unported", ["BY", "BY-SA"])):
    for _p in _parts:
        TEMPLATES[f"CC-{_p}-{_version}"] = _cc(_p, _CC[_p][0], _version, _scope)
        TELLS[f"CC-{_p}-{_version}"] = _cc_tell(_CC[_p][1], _CC[_p][2], _version)
FAMILIES = sorted(TEMPLATES)
UNKNOWN = len(FAMILIES)
#: Rows of a task of the fit, whose every step is a pass over all of them.
FIT_ROWS = 8_000
CONTAINED = 0.8
#: Cells of word n-grams that no template holds; every n-gram of the templates has its own.
OTHER_CELLS = 512
#: A notice that is wrapped over lines has at most this many words, twice those of the longest template.
NOTICE_WORDS = 2 * max(len(t.split()) for ts in TEMPLATES.values() for t in ts)
#: Every text that holds a tell matches this, so wrapped lines are only joined where it does.
_ANCHOR = (r"(?i)apache|redistribution|\bbsd|neither\W+the|boost|\bbsl|\bcc\W*(?:by|0)|creative\W+commons|eclipse|\bepl|gnu|gpl|"
           r"\bisc\W+licen|\bmit\W+licen|license-identifier|this\W+software\W+for\W+any|obtaining\W+a\W+copy|mozilla|\bmpl|"
           r"unlicense|unencumbered|zlib|held\W+liable")
#: A line without letters and digits ends a paragraph of wrapped lines.
_BLANK = r"\n[^\p{L}\p{N}]*\n"


def _tokens(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^\p{L}\p{N}.+-]+"), lambda w: F.length(w) > 0)


def _bare(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.rtrim(w, F.lit(".-")))


def anchored(docs: DataFrame) -> DataFrame:
    """``_k, block, body`` of the blocks (lines up to a blank one) that hold an
    anchor; ``_k`` is a hash of id and text."""
    # an anchor of a block is one of its text: most texts have none and are not cut
    blocks = docs.where(F.col("text").rlike(_ANCHOR)).select(
        F.xxhash64("doc_id", "text").alias("_k"), F.posexplode(F.split("text", _BLANK)).alias("block", "body"))
    return blocks.where(F.col("body").rlike(_ANCHOR))


def paragraphs(blocks: DataFrame) -> DataFrame:
    """``_k, block, first, last, line`` of every line of ``anchored`` blocks that holds an anchor."""
    lines = blocks.select("_k", "block", F.posexplode(F.split("body", "\n")).alias("first", "line"))
    return lines.where(F.col("line").rlike(_ANCHOR)).select("_k", "block", "first", F.col("first").alias("last"), "line")


def wrapped(blocks: DataFrame) -> DataFrame:
    """Runs of two lines or more of ``anchored`` blocks that may hold a notice."""
    b = blocks.where(F.col("body").contains("\n")).withColumn("lines", F.split("body", "\n"))
    n = b.select("_k", "block", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - 2)).alias("first"))
    n = n.withColumn("some", F.slice("lines", F.col("first") + 1, NOTICE_WORDS))
    # words of the run up to each line: a run ends before it is longer than a notice
    upto = F.aggregate("some", F.array(F.lit(0)), lambda acc, x: F.when(
        F.element_at(acc, -1) > NOTICE_WORDS, acc).otherwise(
        F.concat(acc, F.array(F.element_at(acc, -1) + F.size(F.split(F.trim(x), r"\s+"))))))
    most = F.size(F.filter(upto, lambda x: x <= NOTICE_WORDS)) - 1
    n = n.withColumn("most", most).where("most >= 2")
    n = n.select("_k", "block", "first", "some", F.explode(F.sequence(F.lit(2), F.col("most"))).alias("n"))
    n = n.select("_k", "block", "first", (F.col("first") + F.col("n") - 1).alias("last"),
                 F.array_join(F.slice("some", F.lit(1), F.col("n")), " ").alias("line"))
    return n.where(F.col("line").rlike(_ANCHOR))


def _vocabulary() -> list[str]:
    """Word 1- and 2-grams of the templates, some thousands whatever the input."""
    grams = set()
    for f in FAMILIES:
        for t in TEMPLATES[f]:
            w = _ordered(t)
            grams.update(w)
            grams.update(f"{x} {y}" for x, y in zip(w, w[1:]))
    return sorted(grams)


def _grams(lines: DataFrame) -> DataFrame:
    """``w`` and ``features``: the n-grams of the templates, and all n-grams in
    a few hashed cells, so a coefficient row is a few thousand numbers."""
    t = lines.withColumn("w", _bare(_tokens(F.col("line"))))
    t = NGram(n=2, inputCol="w", outputCol="w2").transform(t)
    t = t.withColumn("w2", F.concat("w", "w2"))
    known = CountVectorizerModel.from_vocabulary(_vocabulary(), inputCol="w2", outputCol="known").setBinary(True)
    t = HashingTF(numFeatures=OTHER_CELLS, inputCol="w2", outputCol="any", binary=True).transform(known.transform(t))
    return VectorAssembler(inputCols=["known", "any"], outputCol="features").transform(t).drop("w2", "known", "any")


def _spelled(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(F.filter(words, lambda w: F.length(w) > 0), " "), F.lit(" "))


def _ordered(text: str) -> list[str]:
    """The words that ``_bare(_tokens())`` gives, for the templates."""
    return [w for w in (w.rstrip(".-") for w in re.split(r"[^\w.+-]+", text.lower())) if w]


def _python_words(text: str) -> list[str]:
    return list(dict.fromkeys(_ordered(text)))


def _containment(words: Column, family: Column | None = None) -> Column:
    """Largest share of the distinct words of a template (of the family) that a paragraph holds."""
    templates = [(f, _python_words(t)) for f in FAMILIES for t in TEMPLATES[f]]
    known = F.array_intersect(words, F.split(F.lit(" ".join(sorted({w for _, t in templates for w in t}))), " "))
    # the family is the first word of each template's row
    rows = F.array(*[F.split(F.lit(" ".join([f, *t])), " ") for f, t in templates])
    if family is not None:
        rows = F.filter(rows, lambda t: F.element_at(t, 1) == family)
    # a lambda's argument is computed once, what its body names once per template
    return F.element_at(F.transform(F.array(known), lambda k: F.array_max(F.transform(
        rows, lambda t: F.size(F.array_intersect(k, F.slice(t, 2, F.size(t)))) / (F.size(t) - 1)))), 1)


def _tells(spelled: Column) -> Column:
    """Whether the paragraph holds the tell of each family."""
    return F.array(*[spelled.rlike(TELLS[f]) for f in FAMILIES])


def unknown_lines(blocks: DataFrame) -> DataFrame:
    """``line, held`` of every distinct line with an anchor that is unlike all
    templates; ``held`` is a third of them, by hash."""
    lines = paragraphs(blocks).select("line").distinct()
    return (lines.where(_containment(_bare(_tokens(F.col("line")))) < 0.6)
            .withColumn("held", F.pmod(F.xxhash64("line"), F.lit(3)) == 0))


def fit(spark: SparkSession, blocks: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """The classifier and the least probability of a licence that counts."""
    other = stored(spark, unknown_lines(blocks), "unknown")
    copies = set()
    for k, f in enumerate(FAMILIES):
        for t in TEMPLATES[f]:
            w = t.split(" ")
            lacking = [" ".join(w[:j] + w[j + 1:]) for j in range(len(w))]
            among = [t, f"Note: {t}", f"Copyright the authors. {t} All other rights reserved."]
            # a copy that lacks what tells its family is not an example of it
            copies |= {(float(k), x) for x in lacking + among
                       if re.search(TELLS[f], f" {' '.join(y for y in _ordered(x))} ")}
    known = spark.createDataFrame(sorted(copies), "label double, line string")
    plain = spark.createDataFrame([("the of and to in",), ("1",), ("version 3",), ("released under the sun",)], "line string")
    unknown = other.where("not held").select("line").unionByName(plain).select(F.lit(float(UNKNOWN)).alias("label"), "line")
    tasks = 4 + other.count() // FIT_ROWS
    rows = _grams(known.unionByName(unknown)).select("label", "features").repartition(tasks).cache()
    model = LogisticRegression(family="multinomial", maxIter=60, regParam=5e-4, elasticNetParam=0.5).fit(rows)
    rows.unpersist()
    # a licence must be likelier than it is for any held-out unknown paragraph
    seen = (model.transform(_grams(other.where("held"))).select(vector_to_array("probability").alias("p"))
            .select((1 - F.element_at("p", UNKNOWN + 1)).alias("p")).agg(F.max("p")).first()[0])
    return model, min(0.9, max(0.5, (seen or 0.0) + 0.01))


def classify(spark: SparkSession, blocks: DataFrame, model: LogisticRegressionModel, threshold: float) -> DataFrame:
    """``_k, block, first, last, family, probability`` of every run of lines that is a licence."""
    # a line without an anchor holds no tell, so it could not be confirmed: it is not scored
    scored = model.transform(_grams(paragraphs(blocks).unionByName(wrapped(blocks))))
    p = vector_to_array("probability")
    likely = (scored.select("_k", "block", "first", "last", "w", p.alias("p"))
              .withColumn("probability", 1 - F.element_at("p", UNKNOWN + 1)).where(F.col("probability") >= threshold))
    # written, as filters on what follows would run the classifier once for each mention of it
    likely = stored(spark, likely, "licenses").withColumn("tells", _tells(_spelled(F.col("w"))))
    # the likeliest of the families that the paragraph names
    told = F.zip_with(F.slice("p", 1, UNKNOWN), "tells", lambda x, t: F.when(t, x).otherwise(F.lit(-1.0)))
    likely = (likely.withColumn("told", told).where(F.exists("tells", lambda t: t))
              .withColumn("family", F.element_at(F.lit(FAMILIES), F.array_position("told", F.array_max("told")).cast("int"))))
    # written as well: the comparison names the family once for each template
    likely = stored(spark, likely.select("_k", "block", "first", "last", "w", "family", "probability"), "families")
    return likely.where(_containment(F.col("w"), F.col("family")) >= CONTAINED).select("_k", "block", "first", "last", "family", "probability")


def notices(found: DataFrame) -> DataFrame:
    """Per document, the notices and their families. A run of lines that holds
    a shorter one of its family is not counted, and runs that share a line are one."""
    runs = found.select("_k", "block", "family", "first", "last").distinct().repartition("_k")
    same = Window.partitionBy("_k", "block", "family")
    inner = F.min("last").over(same.orderBy(F.desc("first"), "last").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("inner", inner).where("inner is null or inner > last")
    before = F.max("last").over(same.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("before", before).withColumn("new", (F.col("before").isNull() | (F.col("first") > F.col("before"))).cast("long"))
    return runs.groupBy("_k").agg(F.sum("new").alias("n_license"),
                                  F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"))


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_paragraphs, n_license, families`` of every document."""
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    blocks = stored(spark, anchored(src), "anchored")
    model, threshold = fit(spark, blocks)
    found = notices(classify(spark, blocks, model, threshold))
    n = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]")))
    rows = src.select("doc_id", F.xxhash64("doc_id", "text").alias("k"),
                      F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_paragraphs"))
    return rows.join(found, F.col("k") == F.col("_k"), "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_license", F.lit(0)).cast("long").alias("n_license"),
        F.coalesce("families", F.lit("")).alias("families"))
