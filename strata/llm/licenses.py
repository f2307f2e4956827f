"""License scan: Dice coefficient of word bigrams against notice templates.

Texts are cut into segments (sentences, lines of several sentences, and
windows); a few anchor words, one of which any match must hold, drop most of
them early; each is normalised to lower-case ASCII words and letters beyond
ASCII.  The segment's and the template's bigram sets are compared by Dice: a
template can only reach the threshold if its size lies within fixed bounds of
the segment's, which prunes templates first.  Shared bigrams are counted
through a bigram -> template table, a broadcast of the bounded template list.
Built from DataFrame functions only.

*Windows* do not depend on line breaks: the whole text is one sequence of
words, and a window starts and ends at bigrams that a template holds.  From
every such start (of a template of over ``STARTS`` bigrams: from every
``size // STARTS``-th) the end with the best Dice is taken.  A bigram outside
the template counts each time it stands in the window.  Windows are compared
with notices, file headers and whole license texts; whole texts only in
documents that hold a string of ``SIFT``.

*Overlaps.*  A window within a line or sentence that reaches the threshold adds
nothing.  Otherwise, of overlapping segments the one that shares most bigrams
with its template counts (ties: higher Dice).

Defined results: null, empty and one-word texts match nothing; repeated rows
repeat their result; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Words too common to sift documents by.
COMMON = {"a", "any", "be", "by", "can", "file", "for", "found", "general", "has", "in", "is", "not", "of", "or", "person", "public", "source", "subject", "that", "the", "this", "to", "under", "use", "version", "with", "work", "you"}

#: Common license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work has been dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_GNU_HEADER = (
    "This {0} is free software{3} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation{4} either version {2} of the License, or "
    "(at your option) any later version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE. See the GNU {1} for more details. You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>."
)


def _whole_texts() -> tuple[tuple[str, str], ...]:
    """File headers, and the license texts beside this module."""
    headers = [
        ("GPL-2.0", _GNU_HEADER.format("program", "General Public License", "2", ";", ";")),
        ("GPL-3.0", _GNU_HEADER.format("program", "General Public License", "3", ":", ",")),
        ("AGPL-3.0", _GNU_HEADER.format("program", "Affero General Public License", "3", ":", ",")),
        ("LGPL-2.1", _GNU_HEADER.format("library", "Lesser General Public License", "2.1", ";", ";")),
        ("LGPL-3.0", _GNU_HEADER.format("library", "Lesser General Public License", "3", ":", ",")),
        (
            "Apache-2.0",
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
            "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
            '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        ),
    ]
    return (*headers, *((p.stem, p.read_text()) for p in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))))


#: Templates of windows besides ``TEMPLATES``.
WHOLE_TEXTS = _whole_texts()
#: Strings of which a document must hold one to be compared with ``WHOLE_TEXTS``.
SIFT = ("licens", "permission", "redistribut")
#: Windows start at every matched bigram of templates up to this size.
STARTS = 128


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9\x{80}-\x{10ffff}]+", " "))


def bigrams(words: Column) -> Column:
    """Distinct adjacent pairs of an array of words (empty below two words)."""
    pairs = F.transform(
        F.arrays_zip(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))).alias("a"), F.slice(words, 2, F.size(words)).alias("b")),
        lambda p: F.concat_ws(" ", p["a"], p["b"]),
    )
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def template_bigrams(spark, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``bigram, template, license, size, low, high``: low..high are the segment sizes that can reach the threshold."""
    rows = spark.createDataFrame([(n, name, text) for n, (name, text) in enumerate(templates)], "template int, license string, notice string")
    rows = rows.withColumn("pairs", bigrams(F.split(normalised(F.col("notice")), " "))).withColumn("size", F.size("pairs"))
    share = threshold / (2 - threshold)
    return rows.select(
        F.explode("pairs").alias("bigram"),
        "template",
        "license",
        "size",
        F.ceil(F.col("size") * share - 1e-9).cast("int").alias("low"),
        F.floor(F.col("size") / share + 1e-9).cast("int").alias("high"),
    )


def anchor_words(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Strings of which every segment that can reach the threshold holds at least one.

    Such a segment shares at least ``share * m`` of a template's ``m``
    bigrams.  Words are taken until the bigrams that touch one of them are
    more than a segment may miss: a segment without any of them falls short.
    """
    share, chosen = threshold / (2 - threshold), set()
    for _, text in templates:
        words = _plain(text).split()
        pairs = set(zip(words, words[1:], strict=False))
        may_miss = len(pairs) - math.ceil(share * len(pairs) - 1e-9)
        mine: set[str] = set()
        for word in sorted(set(words), key=lambda w: ("licens" not in w, w in COMMON, -len(w), w)):
            if sum(1 for p in pairs if mine & set(p)) > may_miss:
                break
            mine.add(word)
        chosen |= {"licens" if "licens" in w else w for w in mine}
    return sorted(w for w in chosen if not any(o != w and o in w for o in chosen))


def _contains_any(text: Column, strings) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(w)) for w in strings])


def _line_hits(rows: DataFrame, templates, threshold: float) -> DataFrame:
    """``doc_id, row, hit``: lines and sentences that reach the threshold, with their place in the document's words."""
    known = template_bigrams(rows.sparkSession, templates, threshold)
    share = threshold / (2 - threshold)
    # bounds over all templates, from the bounded list itself
    sizes = [len(set(zip(w, w[1:], strict=False))) for w in (_plain(t).split() for _, t in templates)]
    low, high = int(min(sizes) * share), int(max(sizes) / share) + 1
    anchors = anchor_words(templates, threshold)

    lines = rows.filter(_contains_any(F.col("text"), anchors)).select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("line", "body"))
    sentences = F.split("body", r"(?<=[.!?])[\x20\x09-\x0D]+")
    parts = F.when(F.size(sentences) > 1, F.concat(F.array("body"), sentences)).otherwise(sentences)
    segments = lines.select("doc_id", "row", "line", (F.size(sentences) > 1).alias("several"), F.posexplode(parts).alias("part", "segment"))
    plain = normalised(F.col("segment"))
    segments = segments.withColumn("length", F.when(plain == "", 0).otherwise(F.size(F.split(plain, " "))))
    ahead = Window.partitionBy("row").orderBy("line", "part").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.when(F.col("several") & (F.col("part") == 0), 0).otherwise(F.col("length"))  # a line's words are also its sentences'
    placed = segments.withColumn("start", F.coalesce(F.sum(weight).over(ahead), F.lit(0)).cast("int")).filter(_contains_any(F.col("segment"), anchors))
    words = placed.withColumn("words", F.split(normalised(F.col("segment")), " ")).filter(F.size("words") > low)
    key = ["doc_id", "row", "line", "part", "start", "length"]
    pairs = words.select(*key, bigrams(F.col("words")).alias("pairs"))
    sized = pairs.withColumn("n", F.size("pairs")).filter(F.col("n").between(max(low, 1), high))
    hits = sized.select(*key, "n", F.explode("pairs").alias("bigram")).join(F.broadcast(known), "bigram")
    hits = hits.filter(F.col("n").between(F.col("low"), F.col("high")))
    shared = hits.groupBy(*key, "n", "template", "license", "size").agg(F.count("*").alias("shared"))
    scored = shared.withColumn("dice", 2 * F.col("shared") / (F.col("n") + F.col("size"))).filter(F.col("dice") >= threshold)
    best = scored.groupBy(*key).agg(F.min(F.struct((-F.col("dice")).alias("d"), "license", (-F.col("shared")).alias("s"))).alias("best"))
    return best.select("doc_id", "row", _hit(F.col("best.s"), F.col("best.d"), 0, F.col("best.license"), F.col("start"), F.col("start") + F.col("length")).alias("hit"))


def _hit(s, d, kind: int, license_, start, end) -> Column:
    """A segment, in the order in which segments count: less shared bigrams, less Dice, line or window."""
    return F.struct(
        s.cast("long").alias("s"), d.cast("double").alias("d"), F.lit(kind).alias("kind"), license_.alias("license"), start.cast("int").alias("start"), end.cast("int").alias("end")
    )


def _window_hits(rows: DataFrame, templates, whole, threshold: float) -> DataFrame:
    """``doc_id, row, hit``: windows of a document's words that reach the threshold, the best one from every start."""
    spark, every, share = rows.sparkSession, (*templates, *whole), threshold / (2 - threshold)
    spans = [(n, math.ceil((len(_plain(text).split()) - 1) / share)) for n, (_, text) in enumerate(every)]
    known = template_bigrams(spark, every, threshold).join(F.broadcast(spark.createDataFrame(spans, "template int, span int")), "template")
    sift = [*anchor_words(templates, threshold), *(SIFT if whole else ())]
    texts = rows.filter(_contains_any(F.col("text"), sift)).select("doc_id", "row", F.split(normalised(F.col("text")), " ").alias("words")).filter(F.size("words") > 1)
    adjacent = F.arrays_zip(F.slice("words", 1, F.size("words") - 1).alias("a"), F.slice("words", 2, F.size("words")).alias("b"))
    pairs = texts.select("doc_id", "row", F.posexplode(adjacent).alias("pos", "p")).select("doc_id", "row", "pos", F.concat_ws(" ", "p.a", "p.b").alias("bigram"))
    matched = pairs.join(F.broadcast(known), "bigram")
    key = ["doc_id", "row", "template", "license", "size", "low", "span"]
    # a template of which the whole document holds too little cannot be reached by any window
    enough = matched.groupBy(*key, "bigram").agg(F.collect_list("pos").alias("at"))
    enough = enough.groupBy(*key).agg(F.collect_list(F.sort_array("at")).alias("at")).filter(F.size("at") >= F.col("low"))
    # every match with the place where the same bigram stood before
    with_previous = F.flatten(F.transform("at", lambda p: F.transform(p, lambda x, k: F.struct(x.alias("pos"), F.when(k > 0, F.element_at(p, F.greatest(k, F.lit(1)))).otherwise(-1).alias("before")))))
    enough = enough.select(*key, F.sort_array(with_previous).alias("m"))
    enough = enough.withColumn("m", F.transform("m", lambda x, k: F.struct(x["pos"].alias("pos"), x["before"].alias("before"), k.alias("k"))))
    step = F.greatest(F.lit(1), F.floor(F.col("size") / STARTS)).cast("int")
    starts = enough.withColumn("first", F.explode(F.filter("m", lambda x: x["k"] % step == 0)))
    first, k = F.col("first.pos"), F.col("first.k")
    distinct = F.filter(F.slice("m", k + 1, F.col("span")), lambda x: (x["pos"] < first + F.col("span")) & (x["before"] < first))
    starts = starts.select(*key, "first", distinct.alias("inside")).filter(F.size("inside") >= F.col("low"))

    def end_at(x: Column, j: Column) -> Column:
        again = x["k"] - k - j  # matches inside that stood there before
        n = x["pos"] - first + 1 - again
        return F.struct((2 * (j + 1) / (n + F.col("size"))).alias("dice"), (j + 1).alias("shared"), (x["pos"] + 2).alias("end"))

    best = starts.select(*key, "first", F.array_max(F.transform("inside", end_at)).alias("best")).filter(F.col("best.dice") >= threshold)
    return best.select("doc_id", "row", _hit(-F.col("best.shared"), -F.col("best.dice"), 1, F.col("license"), first, F.col("best.end")).alias("hit"))


def _counted(hits: Column) -> Column:
    """Of a document's segments those that count."""

    def overlap(x: Column, y: Column) -> Column:
        return (x["start"] < y["end"]) & (y["start"] < x["end"])

    lines = F.filter(hits, lambda x: x["kind"] == 0)
    known = F.filter(hits, lambda w: (w["kind"] == 0) | ~F.exists(lines, lambda x: (x["start"] <= w["start"]) & (w["end"] <= x["end"])))
    # lines and their sentences count side by side
    return F.aggregate(
        F.sort_array(known),
        F.filter(hits, lambda x: F.lit(False)),
        lambda kept, x: F.when(F.exists(kept, lambda y: overlap(x, y) & ((x["kind"] == 1) | (y["kind"] == 1))), kept).otherwise(F.concat(kept, F.array(x))),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD, whole=WHOLE_TEXTS) -> DataFrame:
    """One row per document row and license: best Dice and number of segments.

    A segment counts for its most similar template (ties: first license name).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(text_col).alias("text")).withColumn("row", F.monotonically_increasing_id())
    hits = _line_hits(rows, templates, threshold).unionByName(_window_hits(rows, templates, whole, threshold))
    counted = hits.groupBy("doc_id", "row").agg(F.collect_list("hit").alias("hits")).select("doc_id", "row", F.explode(_counted(F.col("hits"))).alias("best"))
    return (
        counted.groupBy("doc_id", "row", F.col("best.license").alias("license"))
        .agg(F.round(-F.min("best.d"), 6).alias("dice"), F.count("*").alias("n_segments"))
        .drop("row")
    )


def _plain(text: str) -> str:
    return re.sub("[^a-z0-9\x80-\U0010ffff]+", " ", text.lower())
