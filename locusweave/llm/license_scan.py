"""Licence scan by a trained paragraph classifier (DataFrame and Spark ML operations only).

Paragraphs are lines, and runs of 2 to WRAP lines without a blank one, so that a wrapped statement is seen whole; a run
begins and ends with a line that has a word of a template which is not a common one. Each has its distinct words and pairs of adjacent words, numbers standing for one another. A multinomial logistic regression
with an elastic net, fitted on a part of the labelled table below, gives the probabilities of no licence, of each
licence family and of another licence. A paragraph is a statement if any of the others is likelier than none. The rest
of the table, with other licences that the fit has not seen, calibrates a threshold on the family's probability.

A predicted family at or above the threshold is confirmed by comparison with its templates: enough of one template's
words and pairs must stand in the paragraph, the family's own words must, the words of its near relatives must not, and
a version, if the paragraph states one, must be one that the family has. The version and the parts (BSD clauses, CC
conditions) then name the licence. What is not confirmed counts as unknown.

Which lines are scored follows from the weights alone: a line without any of the `gate` grams cannot be a statement,
since all other grams together weigh less than the distance of the intercepts. Runs of lines count only if they are
confirmed, by a template of at least LONG words and pairs; those scored hold one of the grams that any such run must
have (`hits`). Of confirmed paragraphs that overlap the one that names a version stays, then the one of fewer
lines, the likelier, the first; a run stands at its first line, for the unknown lines in it.

Defined cases: null and blank texts have no paragraphs; each row has a number of its own, written once with its
paragraphs, so repeated ids keep their own results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.llm.common import WHITE, broadcast_if_small, saved

NONE, UNKNOWN = "none", "unknown"
#: The labelled table (fixed values): names of licences by family; each is put into each phrase.
PHRASES = (
    "{}", "Released under the {}.", "Licensed under the {}", "Licensed under {}.", "This project is distributed under the terms of the {}.", "This work is licensed under the {}.", "Released under {}.",
    "License: {}", "This code is made available under the {}", "See the {} for details.", "Copyright the authors, {}", "The text of this book is licensed under a {}.",
)
NAMES = {
    "MIT": ["MIT License", "MIT license", "MIT"],
    "Apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache Software License, version 1.1"],
    "GPL": ["GNU General Public License, version 3", "GNU General Public License v2", "GNU GPL 3.0", "GPL version 2", "GPL-3.0-or-later"],
    "LGPL": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License", "LGPL 2.1", "GNU LGPL version 3"],
    "AGPL": ["GNU Affero General Public License, version 3", "AGPL 3.0", "GNU AGPL version 3"],
    "BSD": ["BSD 3-Clause License", "BSD 2-Clause License", "new BSD license", "BSD-style license", "BSD License"],
    "MPL": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL version 1.1"],
    "CC-BY": [
        "CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-SA 3.0",
        "Creative Commons Attribution-ShareAlike 4.0", "CC BY-NC-SA 4.0", "CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International",
    ],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0", "CC0 public domain dedication"],
    "ISC": ["ISC License", "ISC license"],
}
#: Longer statements of the families.
GRANTS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed to the Foundation under one or more contributor license agreements; it licenses this file to you under the Apache License, Version 2.0",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one"],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "This work is dedicated to the public domain under CC0 1.0 Universal",
        "To the extent possible under law, the person has waived all copyright and related rights to this work. Dedicated to the public domain",
    ],
    "ISC": [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
}
#: Licences of no family; the fit sees those of the first line only.
OTHERS_SEEN = 9
OTHERS = [
    "Eclipse Public License", "Artistic License", "SIL Open Font License", "Boost Software License", "zlib license", "European Union Public Licence", "Python License", "end user license agreement", "PostgreSQL License",
    "Common Development and Distribution License", "Open Data Commons Open Database License", "Microsoft Public License", "Academic Free License", "proprietary license", "WTFPL license", "Ruby license",
]
#: Sentences that are no licence statements; all words of the last four lines also stand alone.
PLAIN = [
    "He lost his driving papers on the way to work in the morning and had to go home again.", "I got my driving license yesterday.", "The driving license was released to her under the table, and she went home.",
    "A fishing license is needed at the lake, and the license fee is paid at the door.", "The pub was licensed to sell beer in the old days.", "Poets take license with the facts.", "He is a licensed pilot and works in the town.",
    "The license plate of the car was not seen by anybody.", "The office that gives out licenses is open until noon.", "The inspector asked for the license of each driver who came over the bridge.", "Her licence to teach was given back to her in the spring.",
    "The program will be shown at the general meeting of the public in the second week, and copies of it may be found at the door.", "Students use the library in the evening, with a source of light and a table for each of them.",
    "The terms of the work were not met, and the following week a new form had to be made and sent.", "Version after version was written, and the author kept only the last one, without its notes.",
    "The people of the town use free software and code at the school, and the foundation has published a file about it.", "International law has related rights and conditions; the possible extent is subject to new documentation.",
    "A person obtaining a charge in binary is hereby in compliance, except where restriction and modification are provided.", "Under the table she can see the end of the road, and each user of the forms may copy the files at the deal that was permitted.",
    "An agreement on the font was released and distributed to associated members, and the apache flew under the bridge.", "The style of the project is open and lesser in clause, and creative attribution is governed and granted by permission.",
    "The film was released under the name of its author in 2004.", "This book is distributed in all public schools of the city.", "The project was made available to the public in 2019, see the report for details.", "The text of this book is about a general who lived in the town.",
    "Copyright was the subject of the talk.", "See the map for details.", "See page 4 for details.", "Made available by the office.", "The mozilla was seen near the lake by two people.", "The boost was not large enough.", "She studied at the MIT in Boston for two years.",
    "The prisoners were released under a new law, version 2 of the old one.", "Common sense is not so common in the public services of the union.", "The artistic director spoke for an hour.", "Er kam mit dem Hund und mit der Katze.", "Mit der Zeit wird es besser.", "Sie sprach mit ihm und mit den anderen.", "Mit 12 von 20 Stimmen wurde er gewählt, mit einer Stimme mehr als 2016.",
    "In 2004, 3 of the 5 houses were sold for 120.", "The match ended 3 to 2 after 90 minutes.", "Call 555 0199 or come to room 12.", "He was 64 and had 2.5 acres of land.", "Chapter 7", "4.5 of 10", "1999", "By 1998 the price was up by 0.4 percent.", "Pages 3 and 4 were lost.",
    "See the details on the next page.", "He sent a copy of the letter to any friend who asked for it.", "The following week the conditions were poor, and the details of the deal were not public.", "The source of the river is under the hill, by the old union hall.",
    "This software was slow, and the software of the bank was no better.", "She deals in old documentation files and books, free of charge.", "Public opinion was against the following plan.", "Under the new style of play the team won.", "The authors of the report met with the public.",
    "The snake was a python of two metres.", "The creative writing class met in the commons.", "She was granted leave to go to the source.", "An open letter to the union was sent by the european office.", "The ruby in the ring was old.", "The domain of the king ended at the river.",
    "the of and to in is that it was for on with as be by this are from or at an not all any you your we our they a he she his her",
    "der die und den das von zu ist nicht mit sich auf dem ein eine als auch es an werden aus er hat dass sie nach wird bei im für des",
    "le la de et les des un une que est pour dans qui sur pas par au avec elle du il ne se ce son plus en cc by",
    "el la de que y los las del se por con para una no como su al lo es en un ser son dos más",
]
FAMILIES = list(NAMES)
COMMON = frozenset(w for s in PLAIN[-4:] for w in s.split())
CLASSES = [NONE, UNKNOWN, *FAMILIES]
#: Place of the first family in CLASSES.
FIRST = 2
#: Own words of a family, one of which must stand in a paragraph, and words of its near relatives, which must not.
OWN = {
    "MIT": r"\bmit\b|hereby granted\W+free of charge", "Apache": r"\bapache\b", "GPL": r"\bgpl\b|\bgnu\W+general\W+public\b", "LGPL": r"\blgpl\b|\blesser\W+general\b", "AGPL": r"\bagpl\b|\baffero\b",
    "BSD": r"\bbsd\b|\bredistributions?\b", "MPL": r"\bmpl\b|\bmozilla\W+public\b", "CC-BY": r"\bcc[\W_]+by\b|\bcreative\W+commons\W+attribution\b", "CC0": r"\bcc0\b|\bcommons\W+zero\b|waived\W+all\W+copyright|\bpublic\W+domain\b", "ISC": r"\bisc\b|with\W+or\W+without\W+fee\W+is\W+hereby",
}
NOT_OWN = {"GPL": r"\ba?lgpl\b|\bagpl\b|\blesser\b|\baffero\b|\blibrary\W+general\b", "LGPL": r"\baffero\b", "MIT": r"\bisc\b", "CC-BY": r"\bcc0\b"}
#: Where a family's version stands, and the versions that it has.
VERSION = r"(?:{own})(?:[\W_]*(?:software|license|licence|public|general|international|attribution|by|nc|sa|nd|noncommercial|sharealike|noderivatives|noderivs|commons|universal|zero|v|ver|version))*[\W_]*(\d+(?:\.\d+)?)(?![\d-]*-?clause)"
ELSEWHERE = r"\bversion\s+(\d+(?:\.\d+)?)\s+of\s+the\s+licen[sc]e"
VERSIONS = {
    "Apache": ["1.0", "1.1", "2.0"], "GPL": ["1.0", "2.0", "3.0"], "LGPL": ["2.0", "2.1", "3.0"], "AGPL": ["1.0", "3.0"], "MPL": ["1.0", "1.1", "2.0"],
    "CC-BY": ["1.0", "2.0", "2.5", "3.0", "4.0"], "CC0": ["1.0"],
}
#: Conditions of a CC-BY licence and how they are written.
CONDITIONS = {"NC": r"\bnc\b|\bnon-?commercial\b", "ND": r"\bnd\b|\bno-?deriv", "SA": r"\bsa\b|\bshare-?alike\b"}
#: How the two kinds of BSD licence are told.
THREE_CLAUSES = r"\b3\W?clause|\b(?:new|modified|revised)\W+bsd|\bneither\W+the\W+names?\b"
TWO_CLAUSES = r"\b2\W?clause|\b(?:simplified|free)\W?bsd"
#: Least share of a template's words and pairs that must stand in a paragraph.
CONFIRM = 0.6
#: Least number of a template's words and pairs for a run of lines to be compared with it.
LONG = 9
#: Most lines over which a wrapped statement is looked for.
WRAP = 8
REGULARISATION, L1_SHARE = 0.002, 0.3


def _lower(text: Column) -> Column:
    """Lower case, with a version cut off the name before it."""
    return F.regexp_replace(F.lower(text), r"(gpl|mpl|apache)[-_]?v?(?=[0-9])", "$1 ")


def _grams(text: Column) -> Column:
    """Distinct lower-case words and pairs of adjacent words; every number counts as 0."""
    plain = F.regexp_replace(_lower(text), r"(?<![a-z0-9])v?[0-9]+(?:\.[0-9]+)*(?![a-z0-9])", "0")
    words = F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0))
    pairs = lambda w: F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.concat_ws(" ", a, b))
    return F.transform(F.array(words), lambda w: F.array_union(w, pairs(w)))[0]


def labelled() -> list[tuple[int, str, bool, str]]:
    """The labelled table: id, class, is it kept back for the calibration, statement."""
    rows = []
    for family in FAMILIES:
        stated = [s for n in NAMES[family] for p in PHRASES if " " in (s := p.format(n))]
        rows += [(family, k % 3 == 2, s) for k, s in enumerate(stated)]
        rows += [(family, False, s) for s in GRANTS.get(family, [])]
    rows += [(UNKNOWN, k >= OTHERS_SEEN, p.format(n)) for k, n in enumerate(OTHERS) for p in PHRASES]
    rows += [(NONE, False, s) for s in PLAIN]
    rows += [(NONE, False, w) for w in sorted({w for s in PLAIN[-4:] for w in s.split()})]
    return [(k, *r) for k, r in enumerate(rows)]


def _table(spark: SparkSession, rows: list, kinds: str) -> DataFrame:
    """A small fixed table, from a literal."""
    names = [k.split()[0] for k in kinds.split(", ")]
    told = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.explode(F.from_json(F.lit(told), "array<struct<" + ",".join(k.replace(" ", ":") for k in kinds.split(", ")) + ">>")).alias("x")).select("x.*")


def gate(weights: list[tuple], intercepts: list[float]) -> list[str]:
    """Grams of which every paragraph that is likelier something than none has one.

    weights: rows of a gram and its weight in each class, none first. All other grams together move no class past the
    distance from its intercept to that of none: common words first, then those of least gain, are taken up while that
    holds.
    """
    room = [intercepts[0] - b for b in intercepts[1:]]
    gains = [(g[0] not in COMMON, max(w - g[1] for w in g[2:]), g[0], [max(0.0, w - g[1]) for w in g[2:]]) for g in weights]
    out = []
    for _, most, gram, gain in sorted(gains, key=lambda x: x[:3]):
        if all(g <= r for g, r in zip(gain, room)):
            room = [r - g for g, r in zip(gain, room)]
        elif most > 0:
            out.append(gram)
    return sorted(out)


def hits(grams: list[str]) -> list[str]:
    """So many of a template's grams that whoever has CONFIRM of all has one of these; those with common words only come last, then short ones."""
    needed = next(c for c in range(len(grams) + 1) if c / len(grams) >= CONFIRM)
    return sorted(grams, key=lambda g: (set(g.split()) <= COMMON, -len(g), g))[: len(grams) - needed + 1]


class Model:
    """Weights by gram, intercepts, the threshold of unknown licences, gate grams and templates; plain values."""

    def __init__(self, spark: SparkSession):
        table = _table(spark, labelled(), "id int, class string, back boolean, statement string").withColumn("grams", _grams(F.col("statement")))
        table = saved(table.coalesce(1), "licence-table")
        number = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("class")) - 1
        known = table.where(~F.col("back")).withColumn("label", number.cast("double"))
        counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0).fit(known)
        fitted = LogisticRegression(family="multinomial", regParam=REGULARISATION, elasticNetParam=L1_SHARE, maxIter=40, tol=1e-4, standardization=False).fit(counter.transform(known))
        matrix = fitted.coefficientMatrix.toArray()
        self.weights = [(g, *[float(w) for w in matrix[:, k]]) for k, g in enumerate(counter.vocabulary) if abs(matrix[:, k]).max() > 1e-9]
        self.intercepts = [float(x) for x in fitted.interceptVector]
        scored = fitted.transform(counter.transform(table.where(F.col("back")))).select("class", vector_to_array("probability").alias("p"))
        scored = scored.select("class", F.array_max(F.slice("p", FIRST + 1, len(FAMILIES))).alias("top")).collect()
        self.least = threshold([r["top"] for r in scored if r["class"] != UNKNOWN], [r["top"] for r in scored if r["class"] == UNKNOWN])
        self.gate = gate(self.weights, self.intercepts)
        rows = table.where(F.col("class").isin(FAMILIES)).select("id", "class", "grams").collect()
        self.templates = [(r["id"], r["class"], len(r["grams"]), g) for r in rows for g in r["grams"]]
        self.hits = sorted({g for r in rows if len(r["grams"]) >= LONG for g in hits(r["grams"])})
        self.words = sorted({g for r in rows if len(r["grams"]) >= LONG for g in r["grams"] if " " not in g} - COMMON)


def threshold(known: list[float], others: list[float]) -> float:
    """The cut with fewest errors between the probabilities of known and of other statements; in the middle of its gap."""
    marks = sorted([(p, 1) for p in known] + [(p, 0) for p in others])
    wrong, best = len(others), (len(others), 0.0)
    for k, (p, mark) in enumerate(marks):
        wrong += 1 if mark else -1
        above = marks[k + 1][0] if k + 1 < len(marks) else 1.0
        best = min(best, (wrong, (p + above) / 2))
    return best[1]


_fitted: dict[str, Model] = {}


def model_of(spark: SparkSession) -> Model:
    """The model, fitted once for each application."""
    key = spark.sparkContext.applicationId
    if key not in _fitted:
        _fitted.clear()
        _fitted[key] = Model(spark)
    return _fitted[key]


def _any_of(lists: list[list[str]]) -> str:
    """A pattern that finds one of the lists of patterns, branched where they part."""
    after: dict[str, list[list[str]]] = {}
    for first, *rest in (x for x in lists if x):
        after.setdefault(first, []).append(rest)
    branches = [a + _any_of(rest) for a, rest in after.items()] + [""] * any(not x for x in lists)
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def gate_pattern(grams: list[str]) -> str:
    """A pattern for lower-case texts that finds all that hold one of the grams (and some others)."""
    def atoms(gram: str) -> list[str]:
        words, out = gram.split(), []
        for k, word in enumerate(words):
            cut = word.endswith(("gpl", "mpl", "apache"))  # a version may follow at once
            out += ["v?[0-9][0-9.]*"] if word == "0" else [re.escape(c) for c in word]
            if k + 1 < len(words):
                out.append("[^a-z0-9]*" if cut and words[k + 1][0].isdigit() else "[^a-z0-9]+")
            elif word != "0":
                out.append("(?:[-_]?v?[0-9]|(?![a-z0-9]))" if cut else "(?![a-z0-9])")
        return out

    number = [atoms(g) for g in grams if g[0].isdigit()]
    word = [atoms(g) for g in grams if not g[0].isdigit()]
    return "|".join(([_any_of(number)] if number else []) + ([r"(?<![a-z0-9])" + _any_of(word)] if word else [])) or "(?!)"


def _hit(text: Column, grams: list[str]) -> Column:
    return F.lower(text).rlike(gate_pattern(grams))


def _units(docs: DataFrame, model: Model) -> DataFrame:
    """row, doc_id, units of every row of docs; units: line, n, paragraph of the lines and runs of n lines to be scored."""
    line, run = (lambda c: _hit(c, model.gate)), (lambda c: _hit(c, model.hits))
    blank = lambda x: F.btrim(x, F.lit(WHITE)) == ""
    unit = lambda i, n, text: F.struct(i.cast("int").alias("line"), n.cast("int").alias("n"), text.alias("paragraph"))
    none = F.array().cast("array<struct<line:int,n:int,paragraph:string>>")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", line(F.col("text")).alias("lined"), run(F.col("text")).alias("wrapped"))
    rows = rows.select("row", "doc_id", "lined", "wrapped", F.when(F.col("lined") | F.col("wrapped"), F.split("text", "\n")).alias("all"))
    singles = F.filter(F.transform("all", lambda x, i: unit(i, F.lit(1), x)), lambda u: line(u["paragraph"]))
    # 2: a line that can begin or end a run, 1: one that can stand inside, 0: a blank one.
    kinds = F.when(F.col("wrapped"), F.transform("all", lambda x: F.when(blank(x), 0).when(_hit(x, model.words), 2).otherwise(1)))
    rows = rows.withColumn("kinds", kinds)
    starts = F.filter(F.transform("kinds", lambda k, i: F.when(k == 2, i)), lambda i: i.isNotNull())
    lasts = lambda i: F.filter(F.sequence(i + 1, F.least(i + WRAP, F.size("all")) - 1), lambda j: F.get("kinds", j) == 2)
    whole = lambda i, j: ~F.array_contains(F.slice("kinds", i + 1, j - i + 1), 0)
    runs = F.flatten(F.transform(F.filter(starts, lambda i: i + 1 < F.size("all")), lambda i: F.transform(F.filter(lasts(i), lambda j: whole(i, j)), lambda j: unit(i, j - i + 1, F.array_join(F.slice("all", i + 1, j - i + 1), "\n")))))
    runs = F.filter(runs, lambda u: run(u["paragraph"]))
    return rows.select("row", "doc_id", F.concat(F.when(F.col("lined"), singles).otherwise(none), F.when(F.col("wrapped"), runs).otherwise(none)).alias("units"))


def _settled(found: DataFrame) -> DataFrame:
    """Which units stay: of confirmed ones that overlap, the first in the order told above; unknown lines outside them."""
    mark = F.struct((~F.col("versioned")).alias("bare"), "n", (-F.col("probability")).alias("less"), "line")
    sure = found.where("confirmed").groupBy("row").agg(F.array_sort(F.collect_list(mark)).alias("marks"))
    none = F.filter("marks", lambda m: F.lit(False))
    meet = lambda x, m: (x["line"] < m["line"] + m["n"]) & (m["line"] < x["line"] + x["n"])
    kept = F.aggregate("marks", none, lambda kept, m: F.when(F.exists(kept, lambda x: meet(x, m)), kept).otherwise(F.array_append(kept, m)))
    out = found.join(sure.select("row", kept.alias("kept")), "row", "left")
    kept = F.coalesce("kept", F.array().cast(out.schema["kept"].dataType))
    inside = F.exists(kept, lambda m: (m["line"] <= F.col("line")) & (F.col("line") < m["line"] + m["n"]))
    same = F.exists(kept, lambda m: (m["line"] == F.col("line")) & (m["n"] == F.col("n")))
    return out.where(F.when(F.col("confirmed"), same).otherwise(~inside)).drop("kept", "versioned")


def _named(found: DataFrame) -> DataFrame:
    """With `own`: do the family's own words stand in the paragraph, without its relatives'; `licence`: its name, null if it has no such version."""
    rows = [(f, OWN[f], NOT_OWN.get(f, "(?!)"), VERSION.format(own=OWN[f]) if f in VERSIONS else "()", VERSIONS.get(f, [])) for f in FAMILIES]
    rules = _table(found.sparkSession, rows, "guess string, own_words string, other_words string, version_at string, versions array<string>")
    found = found.join(F.broadcast(rules), "guess").withColumn("plain", _lower(F.regexp_replace("paragraph", r"[\s/*#;-]+", " ")))
    found = found.withColumn("own", F.regexp_like("plain", F.col("own_words")) & ~F.regexp_like("plain", F.col("other_words")))
    told = [F.nullif(F.call_function("regexp_extract", F.col("plain"), p, F.lit(1)), F.lit("")) for p in (F.col("version_at"), F.lit(ELSEWHERE))]
    found = found.withColumn("version", F.when(F.size("versions") > 0, F.coalesce(*told)))
    found = found.withColumn("version", F.when(F.col("version").rlike(r"^\d+$"), F.concat("version", F.lit(".0"))).otherwise(F.col("version")))
    has = lambda pattern: F.col("plain").rlike(pattern)
    conditions = F.concat_ws("-", F.lit("CC-BY"), *[F.when(has(p), F.lit(c)) for c, p in CONDITIONS.items()])
    clauses = F.when(has(THREE_CLAUSES), F.lit("BSD-3-Clause")).when(has(TWO_CLAUSES), F.lit("BSD-2-Clause")).otherwise(F.lit("BSD"))
    name = F.when(F.col("guess") == "CC-BY", conditions).when(F.col("guess") == "BSD", clauses).otherwise(F.col("guess"))
    fits = F.col("version").isNull() | F.array_contains("versions", F.col("version"))
    return found.withColumn("licence", F.when(fits, F.concat_ws("-", name, "version"))).withColumn("versioned", F.col("version").isNotNull() | (F.size("versions") == 0))


def statements(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs(doc_id, text) -> row, doc_id, line, n, paragraph, family, probability, confirmed; a row per licence statement."""
    model = model or model_of(docs.sparkSession)
    return _statements(saved(_units(docs, model), "licence-units"), model)


def _statements(rows: DataFrame, model: Model) -> DataFrame:
    spark = rows.sparkSession
    weights = saved(_table(spark, model.weights, "gram string, " + ", ".join(f"w{k} double" for k in range(len(CLASSES)))), "licence-weights")
    templates = saved(_table(spark, model.templates, "id int, guess string, length int, gram string"), "licence-templates")
    units = rows.select("row", "doc_id", F.explode("units").alias("u")).select("row", "doc_id", "u.*")
    grams = units.select("row", "line", "n", F.explode(_grams(F.col("paragraph"))).alias("gram"))
    logits = [f"z{k}" for k in range(len(CLASSES))]
    sums = grams.join(F.broadcast(weights), "gram").groupBy("row", "line", "n").agg(*[(F.sum(f"w{k}") + b).alias(z) for k, (z, b) in enumerate(zip(logits, model.intercepts))])
    sums = sums.where(F.greatest(*logits[1:]) > F.col(logits[0])).withColumn("best", F.greatest(*logits[FIRST:]))
    guess = F.coalesce(*[F.when(F.col(z) == F.col("best"), F.lit(f)) for z, f in zip(logits[FIRST:], FAMILIES)])
    probability = F.lit(1.0) / sum((F.exp(F.col(z) - F.col("best")) for z in logits), F.lit(0.0))
    sums = saved(sums.select("row", "line", "n", guess.alias("guess"), probability.alias("probability")), "licence-likely")
    scored = saved(units.join(broadcast_if_small(sums), ["row", "line", "n"]), "licence-scored")
    again = scored.select("row", "line", "n", "guess", F.explode(_grams(F.col("paragraph"))).alias("gram"))
    held = again.join(F.broadcast(templates), ["guess", "gram"]).where(f"n = 1 or length >= {LONG}")
    held = held.groupBy("row", "line", "n", "id").agg((F.count(F.lit(1)) / F.first("length")).alias("share")).groupBy("row", "line", "n").agg(F.max("share").alias("share"))
    found = _named(scored.join(held, ["row", "line", "n"], "left"))
    sure = (F.col("probability") >= model.least) & (F.coalesce("share", F.lit(0.0)) >= CONFIRM) & F.col("own") & F.col("licence").isNotNull()
    found = found.withColumn("confirmed", sure).withColumn("family", F.when(sure, F.col("licence")).otherwise(UNKNOWN))
    # A run of lines counts only if it is confirmed.
    found = found.where("confirmed or n = 1").select("row", "doc_id", "line", "n", "paragraph", "family", "probability", "confirmed", "versioned")
    return _settled(saved(found, "licence-found"))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_statements, n_unknown, families, lines; a row per document.

    families: the distinct confirmed licences, sorted, joined by commas; lines: line:licence of each statement, joined
    likewise.
    """
    model = model or model_of(docs.sparkSession)
    rows = saved(_units(docs, model), "licence-units")
    per = _statements(rows, model).groupBy("row").agg(
        F.count(F.lit(1)).alias("n_statements"),
        F.count_if(F.col("family") == UNKNOWN).alias("n_unknown"),
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        F.array_sort(F.collect_list(F.struct("line", "family"))).alias("lines"),
    )
    lines = F.transform("lines", lambda x: F.concat_ws(":", x["line"].cast("string"), x["family"]))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("row", "doc_id").join(per, "row", "left").select(
        "doc_id", zero("n_statements"), zero("n_unknown"),
        F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"), F.coalesce(F.array_join(lines, ","), F.lit("")).alias("lines"),
    )
