"""Licence scans by the Dice coefficient over word bigrams.

A text's lines, the text as a whole, and every run of its words of a template's size are normalised to lower-case
words and compared with licence templates: twice the number of shared bigrams over the sum of both numbers. Lines and
whole texts count distinct bigrams, so a template can only reach the threshold if its size is within a ratio of
theirs. Runs go over line breaks and lie anywhere in a text, which finds wrapped paragraphs, notices amid prose and
whole licences inside longer texts. A run's distinct shared bigrams are counted for all places at once, as a sum over
the places where each begins and ceases to count; bigrams that the template lacks count as often as they come.

A match holds at least a share of its template's bigrams. Texts that have none of those of which any match must have
one fall away in the scan; the others meet templates by a join with the few bigrams of all templates.
"""

from __future__ import annotations

import json
import math
from importlib import resources

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesift.llm.common import text_of

THRESHOLD = 0.8
#: For sizes worked out in floating point.
SLACK = 1e-9

# Names of licences as notices give them, by identifier.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-3.0": ["CC BY 3.0", "Creative Commons Attribution 3.0 License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-3.0": ["CC BY-NC 3.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-SA-3.0": ["CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 License"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License version 2.0", "GPL version 2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License version 3.0", "GPL version 3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["Do What The Fuck You Want To Public License"],
    "Zlib": ["zlib License"],
}
# Sentences in which notices name a licence.
NOTICES = [
    "Licensed under {}.", "Released under {}.", "Distributed under {}.", "Licensed under the {}.", "Released under the {}.",
    "Distributed under the {}.", "This work is licensed under the {}.", "This work is licensed under a {}.",
    "This software is licensed under the {}.", "This project is licensed under the {}.", "This file is licensed under the {}.",
]
# Paragraphs of licence texts.
TEXTS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


# Further paragraphs, which stand for a licence that shares most words with one of the above.
HEADERS = {
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
}
IDENTIFIER = "SPDX-License-Identifier: {}"
#: Names that stand alone. Amid prose they are mentions, so they are compared with lines and whole texts only.
TITLES = ["{}", "The {}", "License: {}"]


def templates() -> list[tuple[str, str]]:
    """All (licence, text) pairs: every name in every notice, and the paragraphs."""
    notices = [(licence, notice.format(name)) for licence, names in NAMES.items() for name in names for notice in NOTICES]
    return notices + [(licence, text) for licence, texts in TEXTS.items() for text in texts]


def whole_texts() -> list[tuple[str, str]]:
    """Whole licences, from the files of ``licence_texts``."""
    files = sorted((f for f in resources.files(__package__).joinpath("licence_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files]


def all_templates() -> list[tuple[str, str, bool, bool]]:
    """``(licence, text, runs, whole)``: with ``runs`` it is compared with runs of words too."""
    headers = [(licence, text) for licence, texts in HEADERS.items() for text in texts]
    headers += [(licence, IDENTIFIER.format(licence)) for licence in NAMES]
    titles = [(licence, title.format(name)) for licence, names in NAMES.items() for name in names for title in TITLES]
    parts = [(*t, True, False) for t in templates() + headers] + [(*t, False, False) for t in titles]
    return parts + [(*t, True, True) for t in whole_texts()]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    """Pairs of neighbouring words in order; none for fewer than two words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def template_bigrams(docs: DataFrame, given: list[tuple[str, str, bool, bool]]) -> DataFrame:
    """``(bigram, b, template, licence, runs, whole, length, m)``: as large as the templates, whatever the data.

    ``length`` counts all bigrams of the template and ``m`` the distinct ones, which ``b`` numbers.
    """
    rows = [{"template": k, "licence": licence, "text": text, "runs": runs, "whole": whole} for k, (licence, text, runs, whole) in enumerate(given)]
    values = F.from_json(F.lit(json.dumps(rows)), "array<struct<template int, licence string, text string, runs boolean, whole boolean>>")
    frame = docs.sparkSession.range(1).select(F.explode(values).alias("t")).select("t.*").withColumn("pairs", _pairs(_words(F.col("text"))))
    frame = frame.select("template", "licence", "runs", "whole", F.size("pairs").alias("length"), F.array_distinct("pairs").alias("bigrams"))
    return frame.select("template", "licence", "runs", "whole", "length", F.size("bigrams").alias("m"), F.posexplode("bigrams").alias("b", "bigram"))


def needed_bigrams(known: list[tuple[int, str]], ratio: float) -> list[str]:
    """Bigrams of which every match has one, from ``(template, bigram)`` pairs.

    A match shares at least the ``ratio``-th part of its template's bigrams, so it cannot do without one of so many
    that fewer are left. The longest are taken, as they are rare.
    """
    of: dict[int, list[str]] = {}
    for template, bigram in known:
        of.setdefault(template, []).append(bigram)
    out: set[str] = set()
    for bigrams in of.values():
        least = math.ceil(len(bigrams) / ratio - SLACK)
        out.update(sorted(bigrams, key=lambda b: (-len(b), b))[: len(bigrams) - least + 1])
    return sorted(out)


def _changes(hits: Column, length: Column, total: Column) -> Column:
    """Where runs of ``length`` bigrams begin or cease to hold a hit: ``(at, c, k)``, changes of the number of
    distinct shared bigrams and of all hits by the run's first position. ``hits`` are sorted by bigram and position.
    """
    before = F.concat(F.array(F.struct(F.lit(-1).alias("b"), F.lit(-1).alias("pos"))), hits)
    with_last = F.zip_with(hits, F.slice(before, F.lit(1), F.size(hits)), lambda h, g: F.struct(h["pos"].alias("pos"), F.when(h["b"] == g["b"], g["pos"]).otherwise(F.lit(-1)).alias("last")))

    def change(at: Column, c: int, k: int) -> Column:
        return F.struct(at.cast("int").alias("at"), F.lit(c).alias("c"), F.lit(k).alias("k"))

    def of(h: Column) -> Column:
        first = F.greatest(h["pos"] - length + 1, F.lit(0))
        return F.array(change(F.greatest(first, h["last"] + 1), 1, 0), change(first, 0, 1), change(h["pos"] + 1, -1, -1))

    return F.filter(F.flatten(F.transform(with_last, of)), lambda e: e["at"] <= total - length)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Matching lines: ``(id_col, line, licence, dice, whole)``, the best licence of each line.

    ``line`` counts from 0; -1 stands for the text as a whole, if it has several lines, and for all runs of its words.
    Whole licences come before notices and paragraphs, then the larger coefficient counts, and ties go to the licence
    that comes first by name. Null, empty and wordless texts match nothing. Every row is taken by itself: repeated
    rows match as often as they come.
    """
    known = template_bigrams(docs, all_templates() if pairs is None else [(*p, True, False) for p in pairs])
    ratio = (2 - threshold) / threshold
    sizes = known.select("template", "bigram", "m").collect()
    least, most = min((r.m for r in sizes), default=1), max((r.m for r in sizes), default=0)
    needed = ", ".join(f"'{b}'" for b in needed_bigrams([(r.template, r.bigram) for r in sizes], ratio))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("pairs", _pairs(_words(F.col("text"))))
    texts = texts.filter(f"exists(pairs, b -> b IN ({needed}))" if needed else "false")
    # The whole text is one more unit beside the lines. Only a unit's own bigrams go with its row, however many lines there are.
    texts = texts.withColumn("lines", F.split("text", "\n")).withColumn("single", F.size("lines") == 1)
    of_lines = F.transform("lines", lambda line, i: F.struct(i.alias("line"), _pairs(_words(line)).alias("pairs")))
    units = F.concat(F.array(F.struct(F.lit(-1).alias("line"), F.col("pairs"))), of_lines)
    split = texts.select("row", "id", "single", F.explode(units).alias("u")).select("row", "id", "single", "u.line", "u.pairs")
    sized = split.withColumn("n", F.size(F.array_distinct("pairs"))).withColumn("total", F.size("pairs"))
    fits = F.col("n").between(math.ceil(least / ratio - SLACK), math.floor(most * ratio + SLACK))
    sized = sized.filter((F.col("line") < 0) | fits)
    met = sized.select("row", "id", "line", "single", "n", "total", F.posexplode("pairs").alias("pos", "bigram")).join(F.broadcast(known), "bigram")
    alike = (F.col("n") * ratio + SLACK >= F.col("m")) & (F.col("m") * ratio + SLACK >= F.col("n")) & ~((F.col("line") < 0) & F.col("single"))
    in_runs = F.col("runs") & (F.col("line") < 0) & (F.col("total") >= F.col("length"))
    group = ["row", "id", "line", "single", "n", "total", "template", "licence", "runs", "whole", "length", "m"]
    hits = met.filter(alike | in_runs).groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("b", "pos"))).alias("hits"))
    hits = hits.withColumn("shared", F.size(F.array_distinct(F.transform("hits", lambda h: h["b"])))).filter(F.col("shared") * ratio + SLACK >= F.col("m"))
    # Of a line or whole text.
    of_unit = F.when(alike & (2 * F.col("shared") >= threshold * (F.col("n") + F.col("m"))), 2 * F.col("shared") / (F.col("n") + F.col("m")))
    changes = F.when(in_runs, _changes(F.col("hits"), F.col("length"), F.col("total")))
    rows = hits.select(*group, of_unit.alias("of_unit"), F.explode_outer(changes).alias("e")).select(*group, "of_unit", "e.*")
    # Of runs: sums by the first position; positions are taken with all their changes.
    upto = Window.partitionBy(*group).orderBy("at")
    rows = rows.withColumn("shared", F.sum("c").over(upto)).withColumn("hits", F.sum("k").over(upto))
    size = F.col("shared") + F.col("length") - F.col("hits") + F.col("m")
    of_run = F.when(2 * F.col("shared") >= threshold * size, 2 * F.col("shared") / size)
    dice = rows.withColumn("dice", F.round(F.greatest("of_unit", of_run), 6)).filter("dice IS NOT NULL")
    best = dice.groupBy("row", "id", "line").agg(F.min(F.struct((~F.col("whole")).alias("part"), (-F.col("dice")).alias("d"), "licence")).alias("b"))
    return best.select(F.col("id").alias(id_col), "line", F.col("b.licence").alias("licence"), (-F.col("b.d")).alias("dice"), (~F.col("b.part")).alias("whole"))


def document_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``(id_col, licence, dice, n_lines)``, its best licence and the number of its lines
    that match any by themselves.

    Without a match the licence and dice are null and ``n_lines`` is 0. Rows that share an id, or have none, share
    what is found in any of them.
    """
    found = scan(docs, id_col, text_col, threshold)
    best = found.groupBy(id_col).agg(
        F.min(F.struct((~F.col("whole")).alias("part"), (-F.col("dice")).alias("d"), "licence")).alias("b"), F.count_if(F.col("line") >= 0).alias("n_lines")
    )
    best = best.select(F.col(id_col).alias("_id"), F.col("b.licence").alias("licence"), (-F.col("b.d")).alias("dice"), "n_lines")
    rows = docs.select(id_col)
    return rows.join(best, rows[id_col].eqNullSafe(best["_id"]), "left").select(id_col, "licence", "dice", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"))
