"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory above.

Every line of a file (its headers among them), and the file as a whole, is compared with short templates
by the cosine of sparse TF-IDF vectors. Only files and lines that share a term with some template
are taken apart; all others have cosine 0. A file without a licence of its own inherits that
of the licence file in the nearest directory at or above its own, found by joining the
directories' ancestor paths. DataFrame functions only; texts are never shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Customary notices of common licences, by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or any later version"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "Released under CC0 1.0 Universal, dedicated to the public domain"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)

#: Function words that carry no weight.
STOP_WORDS = frozenset("a an and any are as at be by can for found from in into is it its met not of on or that the this to "
                       "under with you".split())

THRESHOLD = 0.75

#: between the words of lower-cased text; words are letters, digits, + and -, and dots inside
SEPARATOR = r"\.*[^a-z0-9.+-]+\.*|\.+$"
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|unlicense|notice)"


class TemplateIndex:
    """Terms of the templates: idf, and for each template its weight divided by the template's norm."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, stop: frozenset[str] = STOP_WORDS):
        self.names = [name for name, _ in templates]
        bags = [Counter(t for t in re.split(SEPARATOR, text.lower()) if t and t not in stop) for _, text in templates]
        n, df = len(bags), Counter(t for bag in bags for t in bag)
        self.idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in sorted(df.items())}
        #: idf of a term in no template
        self.other = math.log(1 + n) + 1
        norms = [math.sqrt(sum((c * self.idf[t]) ** 2 for t, c in bag.items())) for bag in bags]
        self.weight = {t: [bag.get(t, 0) * self.idf[t] / norm for bag, norm in zip(bags, norms)] for t in self.idf}


def _terms(text: Column) -> Column:
    return F.split(F.lower(text), SEPARATOR, -1)


def scores(files: DataFrame, index: TemplateIndex, threshold: float, stop: frozenset[str] = STOP_WORDS) -> DataFrame:
    """(path, unit, license, score): best template of each unit with a score of ``threshold`` or more.

    Unit 0 is the whole file, unit i its i-th line. Files that share a path count as one file.

    A unit with a words of the templates and b different others has a cosine of at most sqrt(a² / (a² + b)): the
    former weigh no more than a times the largest idf together, the latter at least that idf each.
    Units that cannot reach the threshold are left out before their terms are counted.
    """
    vocabulary = F.array(*[F.lit(t) for t in index.idf])
    rows = files.select("path", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.where(F.arrays_overlap(_terms(F.col("text")), vocabulary))
    units = rows.select("path", F.posexplode(F.concat(F.array("text"), F.split("text", "\n", -1))).alias("unit", "line"))
    terms = units.select("path", "unit", _terms(F.col("line")).alias("terms"))
    other = F.array(*[F.lit(t) for t in ["", *index.idf, *sorted(stop)]])
    inside = F.size(F.filter("terms", lambda t: t.isin(*index.idf)))
    terms = terms.withColumn("a", inside).where(F.col("a") > 0)
    terms = terms.where(F.size(F.array_except("terms", other)) <= F.col("a") * F.col("a") * (1 / threshold ** 2 - 1) + 1e-9)
    counted = (terms.select("path", "unit", F.explode_outer("terms").alias("term"))
               .where((F.col("term") != "") & ~F.col("term").isin(*sorted(stop)))
               .groupBy("path", "unit", "term").agg(F.count("*").alias("tf")))
    # one row for each term of the templates, a fixed list
    spark = files.sparkSession
    known = spark.createDataFrame([(t, index.idf[t], index.weight[t]) for t in index.idf], "term string, idf double, w array<double>")
    weighed = counted.join(F.broadcast(known), "term", "left")
    x = F.col("tf") * F.coalesce("idf", F.lit(index.other))
    dots = [F.sum(F.coalesce(x * F.get("w", F.lit(k)), F.lit(0.0))).alias(f"d{k}") for k in range(len(index.names))]
    sums = weighed.groupBy("path", "unit").agg(F.sqrt(F.sum(x * x)).alias("norm"), *dots)
    # the earlier template wins among equals
    best = F.array_max(F.array(*[F.struct(F.round(F.col(f"d{k}") / F.col("norm"), 9).alias("score"), F.lit(-k).alias("k"))
                                 for k in range(len(index.names))]))
    name = F.element_at(F.array(*[F.lit(n) for n in index.names]), 1 - F.col("best.k"))
    return sums.select("path", "unit", best.alias("best")).select("path", "unit", name.alias("license"), F.col("best.score").alias("score")).where(F.col("score") >= threshold)


def directory(path: Column) -> Column:
    """Directory of a path, '' at the top."""
    return F.regexp_extract(path, r"^(?:(.*)/)?[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """A directory and all above it, up to ''."""
    parts = F.split(folder, "/", -1)
    below = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), below))


def scan(files: DataFrame, index: TemplateIndex | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(path, license, basis, score, found_in), one row for each distinct path.

    basis ``file``: the whole text is a notice; ``header``: its best line is (the first of equals);
    ``inherited``: from the licence file (a file with an own licence that is named like one) of the
    nearest directory at or above the file's, the best scored and then first named one of that
    directory; null: none. A null path is the path ''; null and empty texts have no licence of their
    own; repeated rows are one file; other columns are ignored; an empty table gives no rows.
    """
    index = index or TemplateIndex()
    files = files.select(F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "text")
    found = scores(files, index, threshold)
    own = found.groupBy("path").agg(
        F.max(F.struct((F.col("unit") == 0).alias("whole"), "score", (-F.col("unit")).alias("unit"), "license")).alias("m"))
    own = cut_lineage(own.select("path", F.col("m.license").alias("license"), F.when(F.col("m.whole"), "file").otherwise("header").alias("basis"),
                                 F.col("m.score").alias("score")))
    named = own.where(F.regexp_like(F.element_at(F.split("path", "/", -1), -1), F.lit(LICENSE_FILE)))
    of_folder = named.groupBy(directory(F.col("path")).alias("above")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("f"))
    paths = files.select("path").distinct().withColumn("folder", directory(F.col("path")))
    steps = paths.select("folder").distinct().select("folder", F.explode(ancestors(F.col("folder"))).alias("above"))
    nearest = steps.join(of_folder, "above").groupBy("folder").agg(F.max(F.struct(F.length("above").alias("depth"), "f")).alias("n"))
    inherited = nearest.select("folder", F.col("n.f.license").alias("up_license"), (-F.col("n.f.s")).alias("up_score"),
                               F.col("n.f.path").alias("up_path"))
    joined = paths.join(own, "path", "left").join(inherited, "folder", "left")
    mine = F.col("license").isNotNull()
    return joined.select(
        "path", F.coalesce("license", "up_license").alias("license"),
        F.when(mine, F.col("basis")).when(F.col("up_license").isNotNull(), "inherited").alias("basis"),
        F.when(mine, F.col("score")).otherwise(F.col("up_score")).alias("score"),
        F.when(mine, F.col("path")).otherwise(F.col("up_path")).alias("found_in"))
