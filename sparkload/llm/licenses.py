"""Licence scan: cosine of headers and of whole licence texts to templates, then inheritance from directories.

A text is cut into lines at newlines and behind ``. ! ? ;`` before a space. Up to ``BLOCK_LINES`` neighbouring lines, at least one
of them with a marked word, are a block, compared with the notices in ``TEMPLATES``. A text with a marked word is compared as a
whole with the licences in ``BODIES`` too.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored, text_of
from .licence_texts import BODIES

LEAST_SIMILARITY = 0.6  # of a block to a notice
LEAST_WHOLE = 0.8  # of a text to a licence
FILE_SHARE = 0.25  # a document is a licence file if its best block has this share of its words, by its name, or as a whole
BLOCK_LINES = 3  # neighbouring lines that are compared together: a notice may be wrapped

# How licences are named or granted in file headers and licence files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal public domain dedication"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
# A line without any of these words states no licence.
MARKERS = (
    "licen[cs]e", "licen[cs]ed", "licensing", "spdx", "copyright", "permission", "unencumbered", "cc0", "copyleft",
    "redistribution", "redistributions", "warranty", "warranties",
)

# How files that hold a licence are named.
_FILE_NAME = r"(?i)(^|/)((mit|apache|bsd|l?gpl|mpl)[-_.]?)?(un)?(licen[cs]es?|copying)([-_.][^/]*)?$"
_MARKED = r"(?i)(^|[^a-z0-9])(" + "|".join(MARKERS) + r")($|[^a-z0-9])"
_SPLIT = r"[^a-z0-9]+"
_BREAK = r"([.!?;])[ \t\r\n]+"


def terms_of(text: str) -> list[str]:
    return [t for t in re.split(_SPLIT, text.lower()) if t]


def vocabulary(templates=(*TEMPLATES, *BODIES)) -> list[str]:
    return sorted({t for _, text in templates for t in terms_of(text)})


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda t: t != "")


def term_weights(docs: DataFrame, terms: list[str], text_col: str = "text") -> tuple[dict[str, float], float]:
    """Inverse document frequency of every template term over all documents, and that of a term in none.

    A document sends the template terms it has, at most as many as there are; sums are made in every task first.
    The driver gets a number for each template term.
    """
    has = F.array_intersect(F.split(F.lower(text_of(text_col)), _SPLIT), F.split(F.lit(" ".join(terms)), " "))
    # one row per term, and one under the empty name for the document itself
    counted = docs.select(F.explode(F.concat(F.array(F.lit("")), has)).alias("term")).groupBy("term").count()
    counts = {r.term: r["count"] for r in counted.collect()}
    n = counts.get("", 0)
    return {t: math.log((1 + n) / (1 + counts.get(t, 0))) for t in terms}, math.log(1 + n)


def template_rows(weights: dict[str, float], notices=TEMPLATES, bodies=BODIES) -> list[tuple[bool, int, str, float, str, float]]:
    """``whole, k, licence, length, term, weight`` of every template's terms; ``k`` is its place in both lists."""
    out = []
    for k, (licence, text) in enumerate((*notices, *bodies)):
        terms = terms_of(text)
        vector = {t: terms.count(t) * weights[t] for t in dict.fromkeys(terms)}
        length = math.sqrt(sum(w * w for w in vector.values()))
        out += [(k >= len(notices), k, licence, length, t, w) for t, w in vector.items()]
    return out


def units_of(text: Column) -> Column:
    """``array<struct<whole, text>>``: the different blocks of a text that hold a marked line, and the text itself."""

    def bound(value: Column, use) -> Column:
        """``use(value)`` with the value computed once, as the element of an array."""
        return F.transform(F.array(value), use)[0]

    def blocks(lines: Column) -> Column:
        """A line with those behind it, side by side: no array is cut for each line."""

        def longer(n: int):  # a default of the inner function would be taken for one more variable
            return lambda t, x: F.struct(*[t[f"l{k}"].alias(f"l{k}") for k in range(n)], x.alias(f"l{n}"))

        beside = F.transform(lines, lambda x: F.struct(x.alias("l0")))
        for n in range(1, BLOCK_LINES):
            after = F.slice(lines, n + 1, F.greatest(F.size(lines) - n, F.lit(0)))
            beside = F.zip_with(beside, after, longer(n))

        def of(t: Column) -> Column:
            held = [t[f"l{n}"] for n in range(BLOCK_LINES)]
            marks = [F.coalesce(x["m"], F.lit(False)) for x in held]
            return F.array(
                *[
                    F.when(held[n].isNotNull() & reduce(Column.__or__, marks[: n + 1]), F.concat_ws(" ", *[x["x"] for x in held[: n + 1]]))
                    for n in range(BLOCK_LINES)
                ]
            )

        return F.flatten(F.transform(beside, of))

    lines = F.split(F.regexp_replace(text, _BREAK, "$1\n"), "\n")
    marked = F.transform(lines, lambda y: F.struct(y.alias("x"), y.rlike(_MARKED).alias("m")))
    found = F.array_distinct(F.filter(bound(marked, blocks), lambda x: x.isNotNull()))
    unit = lambda whole: lambda x: F.struct(F.lit(whole).alias("whole"), x.alias("text"))
    return F.concat(F.transform(found, unit(False)), F.array(unit(True)(text)))


def own_licences(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", notices=TEMPLATES, bodies=BODIES) -> DataFrame:
    """``id, directory, licence, similarity, is_file`` for every row; the licence is null where nothing is similar enough.

    Vectors are sparse, over the words of the templates, weighted by count and inverse document frequency; every other word of a
    unit counts as a term of its own, of the greatest weight, that no template has. Only texts with a marked word, and of
    these only their words, go beyond the first pass. The most similar template decides, the first in the list among equals.
    A document with a licence is a licence file if it is named like one, if the whole text is the licence, or if the
    block has ``FILE_SHARE`` of its words.
    """
    spark = docs.sparkSession
    weights, unknown = term_weights(docs, vocabulary((*notices, *bodies)), text_col)
    idf = spark.createDataFrame(list(weights.items()), "term string, idf double")  # of the templates' words, whatever the table
    known = spark.createDataFrame(template_rows(weights, notices, bodies), "t_whole boolean, k int, licence string, t_length double, t string, t_w double")
    text, full = text_of(text_col), F.coalesce(path.cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            col(id_col).cast("long").alias("id"),
            F.regexp_replace(full, "/?[^/]*$", "").alias("directory"),
            full.rlike(_FILE_NAME).alias("named"),
            F.when(text.rlike(_MARKED), text).alias("text"),
        ),
        "marked",
    )
    marked = rows.filter("text is not null")
    units = marked.select("row", F.posexplode(units_of(F.col("text"))).alias("at", "u"))
    units = units.select("row", "at", "u.whole", _terms(F.col("u.text")).alias("terms"))  # no text goes along with each of its words
    counted = units.select("row", "at", "whole", F.explode("terms").alias("term")).groupBy("row", "at", "whole", "term")
    counted = counted.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(idf), "term", "left")
    weight = F.col("n") * F.col("idf")
    square = F.sum(F.coalesce(weight * weight, F.col("n") * F.lit(unknown * unknown)))
    lengths = counted.groupBy("row", "at").agg(F.sqrt(square).alias("length"), F.sum("n").alias("words"))
    met = counted.join(F.broadcast(known), (F.col("term") == F.col("t")) & (F.col("whole") == F.col("t_whole")))
    dots = met.groupBy("row", "at", "whole", "k", "licence", "t_length").agg(F.sum(weight * F.col("t_w")).alias("dot"))
    length = F.col("length") * F.col("t_length")
    similarity = F.when(length > 0, F.round(F.col("dot") / length, 6)).otherwise(F.lit(0.0))
    similar = dots.join(lengths, ["row", "at"]).withColumn("similarity", similarity)
    similar = similar.filter(F.col("similarity") >= F.when(F.col("whole"), LEAST_WHOLE).otherwise(LEAST_SIMILARITY))
    rank = F.struct("similarity", (-F.col("k")).alias("k"), "words", "licence", "whole")
    best = similar.groupBy("row").agg(F.max(rank).alias("b"))
    sizes = marked.select(F.col("row").alias("of"), F.size(_terms(F.col("text"))).alias("n_words"))
    best = best.join(sizes, F.col("row") == F.col("of")).drop("of").withColumnRenamed("row", "of")
    found = rows.drop("text").join(best, F.col("row") == F.col("of"), "left")
    is_file = F.col("named") | F.col("b.whole") | (F.col("b.words") / F.col("n_words") >= FILE_SHARE)
    return found.select(
        "id",
        "directory",
        F.col("b.licence").alias("licence"),
        F.col("b.similarity").alias("similarity"),
        F.coalesce(F.col("b").isNotNull() & is_file, F.lit(False)).alias("is_file"),
    )


def scan_licences(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", notices=TEMPLATES, bodies=BODIES) -> DataFrame:
    """``doc_id, licence, similarity, origin, directory`` for every row.

    A document has the licence of its own text (``own``), or that of the nearest directory above it that holds a licence
    file (``inherited``, with the directory), or none. Of a directory's licence files the most similar counts, then
    the one of smallest id. ``path`` is the document's path with ``/`` between directories.

    Texts are read twice, without a shuffle: for term weights over all documents, and for those with a marked word. Of these,
    counts of words per block are shuffled. Inheritance is worked out for
    different directories only; a directory with a third of all documents is one row there, and meets its documents in a
    join whose kind follows from the stored table's size and whose skewed partitions adaptive execution splits.

    Null or empty texts have no licence of their own; a null path lies in the root directory ``""``; repeated rows and rows
    without an id are scanned like any other.
    """
    own = stored(own_licences(docs, path, id_col, text_col, notices, bodies), "licences")
    rank = F.struct("similarity", (-F.coalesce("id", F.lit(2**63 - 1))).alias("id"), "licence")
    files = own.filter("is_file").groupBy("directory").agg(F.max(rank).alias("f"))
    files = files.select(F.col("directory").alias("above"), F.col("f.licence").alias("found"))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    directories = own.select("directory").distinct().select("directory", F.explode(above).alias("a")).select("directory", "a.depth", "a.above")
    nearest = directories.join(files, "above").groupBy("directory").agg(F.max(F.struct("depth", "above", "found")).alias("n"))
    nearest = stored(nearest.select("directory", "n.above", "n.found"), "directories")
    inherits = F.col("licence").isNull() & F.col("found").isNotNull()
    origin = F.when(F.col("licence").isNotNull(), "own").when(inherits, "inherited").otherwise("none")
    return own.join(nearest, "directory", "left").select(
        F.col("id").alias("doc_id"),
        F.coalesce("licence", "found").alias("licence"),
        "similarity",
        origin.alias("origin"),
        F.when(inherits, F.col("above")).alias("directory"),
    )
