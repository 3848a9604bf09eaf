"""License scans: sparse TF-IDF cosine of parts of whole texts to templates, inherited down directories.

Every part is a vector over its distinct words, weighted by their rarity over all non-blank lines (a header
rarely repeats a word, so a term counts once). All words of all lines are counted, so the length of a part's
vector is that of its real words, and scores depend on shares of lines, not on the size of the corpus.

Parts are single lines, whole texts of which a template can be half, and runs of as many words as a template has from each of its words on, so headers
are found however their lines are wrapped, and notices within longer lines. A word counts once in each part: in those
that begin after the place it last stood at. So it adds its weight where these parts begin and takes it away where they end, and running
sums give the scores of all runs of a text in one pass. Weights are whole numbers, so sums don't depend on their order. Templates of fewer than ``TITLE_WORDS`` words are titles,
which only whole lines match. An SPDX tag holds if its line has the tag and the name, so all names of an expression do.

A part as similar as asked lacks less than 1 - ``threshold`` squared of a template's squared length. So of the
template's rarest words it has at least a known weight; texts without that are out, with no loss, before any part
is looked at. Weights of words that no template has are sought only for texts with a part that holds enough of a template.

A file's own licenses are those of its matching lines. A file is a licence file if it has a usual name, or if
it has at least ``LICENCE_SIZE`` characters and more than half of its lines match; its directory then has its licenses. A file without a licence of its own
inherits those of the nearest ancestor directory that has some, by joins of directories and their ancestors.
All of it is DataFrame functions.

Defined cases: NULL or blank texts have no lines and no licence of their own. Repeated rows are one file for
each path. A NULL path has no directory and inherits nothing. Equal scores go to the smallest license
name. An empty template table matches nothing. Other columns are not read. Templates are taken in blocks of
``BLOCK_TEMPLATES`` rows or ``BLOCK_WORDS`` words, as they become literals; each block is one more pass over the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BLOCK_TEMPLATES = 200
BLOCK_WORDS = 20_000
FREQUENT = 50_000  # words whose counts are broadcast; those of others are joined by a shuffle
_UNIT = 1 << 30  # of squared weights

# Usual one-line notices of public licenses.
NOTICES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
)
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by"
    " the Free Software Foundation, either version {2} of the License, or (at your option) any later version. This {0} is distributed in"
    " the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
    " PARTICULAR PURPOSE. See the GNU {1} for more details."
)
# standard headers, however their lines are wrapped
HEADERS = (
    ("AGPL-3.0", _GNU.format("program", "Affero General Public License", "3")),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or"
        " agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and"
        " limitations under the License.",
    ),
    ("GPL-2.0", _GNU.format("program", "General Public License", "2")),
    ("GPL-3.0", _GNU.format("program", "General Public License", "3")),
    ("LGPL-2.1", _GNU.format("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("library", "Lesser General Public License", "3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
        " with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)
TITLES = (
    ("AGPL-3.0", "GNU Affero General Public License"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("GPL-1.0-or-later", "GNU General Public License"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("ISC", "ISC License"),
    ("LGPL-2.0-or-later", "GNU Lesser General Public License"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
TAG = "spdx-license-identifier"
TITLE_WORDS = 5  # shorter templates are titles, which only a whole line can be
LICENCE_SIZE = 200
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([-._][^/]*)?$"

_WORD_GAP = r"[^0-9a-z+.-]+"


def _words(text: Column) -> Column:
    """Words in their order, without the dots that end them."""
    return F.array_remove(F.transform(F.split(F.lower(text), _WORD_GAP), lambda w: F.rtrim(w, F.lit("."))), "")


def _terms(text: Column) -> Column:
    return F.array_distinct(_words(text))


def notices(spark: SparkSession) -> DataFrame:
    """Notices, titles, standard headers, SPDX tags and whole texts of public licenses."""
    texts = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    names = sorted({name for name, _ in (*NOTICES, *HEADERS, *TITLES, *texts)})
    tags = [(name, f"{TAG}: {name}{end}") for name in names for end in (("", "-only", "-or-later", "+") if "GPL" in name else ("",))]
    return spark.createDataFrame([*NOTICES, *TITLES, *HEADERS, *tags, *texts], "license string, text string")


def scan(
    files: DataFrame,
    templates: DataFrame,
    *,
    scratch: str,
    path: str = "path",
    text: str = "text",
    threshold: float = 0.8,
) -> DataFrame:
    """For each path: ``own`` (array of license, score and line number, best first), ``licence_file``, ``inherited``
    (array of names), ``inherited_from`` (a directory) and ``licenses`` (names that hold, sorted)."""
    spark = files.sparkSession
    known = templates.where("license is not null").select("license", _words(F.coalesce("text", F.lit(""))).alias("words"))
    known = known.select("license", F.array_distinct("words").alias("terms"), F.size("words").alias("n")).where("size(terms) > 0")
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda s: s.rlike(r"\S"))
    # in how many lines each word is; the empty one is in all
    terms = files.select(F.explode(lines).alias("content")).select(F.explode(F.array_append(_terms(F.col("content")), F.lit(""))).alias("term"))
    terms.groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{scratch}/counts")
    counts = spark.read.parquet(f"{scratch}/counts")
    total = (counts.where("term = ''").first() or {"df": 0})["df"]
    named = files.select(F.col(path).cast("string").alias("path"), whole.alias("text"), lines.alias("lines"))
    parts = None
    for i, block in enumerate(_blocks(known.distinct().orderBy("license", "terms", "n").toLocalIterator())):
        found = _scored(named, block, counts, total, f"{scratch}/{i}", threshold)
        parts = found if parts is None else parts.unionAll(found)
    matched = _best(spark.createDataFrame([], _SCORED) if parts is None else parts)
    matched.write.parquet(f"{scratch}/matched")
    matched = spark.read.parquet(f"{scratch}/matched")
    totals = files.select(F.col(path).cast("string").alias("path"), F.size(lines).alias("lines"), F.length(whole).alias("size")).groupBy("path").agg(
        F.max("lines").alias("lines"), F.max("size").alias("size")
    )
    best = matched.groupBy("path", "license").agg(
        F.max(F.struct("score", (-F.col("line")).alias("line"))).alias("top"), F.count_distinct("line").alias("n")
    )
    own = best.groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("top.score")).alias("k"), "license", (-F.col("top.line")).alias("line")))).alias("o"),
        F.sum("n").alias("hits"),
    )
    owned = totals.join(own.where("path is not null"), "path", "left").select(
        "path",
        F.transform("o", lambda x: F.struct(x["license"].alias("license"), (-x["k"]).alias("score"), x["line"].alias("line"))).alias("own"),
        F.coalesce((F.col("o").isNotNull()) & (F.col("path").rlike(LICENCE_FILE) | ((2 * F.col("hits") > F.col("lines")) & (F.col("size") >= LICENCE_SIZE))), F.lit(False)).alias("licence_file"),
        _parent(F.col("path")).alias("dir"),
    )
    owned.write.parquet(f"{scratch}/owned")
    owned = spark.read.parquet(f"{scratch}/owned")
    granted = owned.where("licence_file and dir is not null").select("dir", F.explode("own.license").alias("license"))
    granted = granted.distinct().groupBy("dir").agg(F.sort_array(F.collect_list("license")).alias("inherited"))
    # the nearest ancestor of each directory, the directory itself included
    steps = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    folders = owned.where("dir is not null").select("dir").distinct().select("dir", F.posexplode(up).alias("depth", "ancestor"))
    near = folders.join(granted.withColumnRenamed("dir", "ancestor"), "ancestor")
    near = near.groupBy("dir").agg(F.max(F.struct("depth", "ancestor", "inherited")).alias("near")).select("dir", "near.ancestor", "near.inherited")
    out = owned.join(near, "dir", "left")
    none = F.array().cast("array<string>")
    alone = F.col("own").isNull()
    return out.select(
        "path",
        F.coalesce("own", F.array().cast("array<struct<license:string,score:double,line:int>>")).alias("own"),
        "licence_file",
        F.when(alone, F.coalesce("inherited", none)).otherwise(none).alias("inherited"),
        F.when(alone, F.col("ancestor")).alias("inherited_from"),
        F.when(alone, F.coalesce("inherited", none)).otherwise(F.sort_array("own.license")).alias("licenses"),
    )


def _parent(path: Column) -> Column:
    """The directory of a path; that of a bare name is the empty one."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def _blocks(rows: Iterator) -> Iterator[list]:
    block, words = [], 0
    for r in rows:
        if block and (len(block) == BLOCK_TEMPLATES or words + len(r["terms"]) > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append(r)
        words += len(r["terms"])
    if block:
        yield block


def _weights(words: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """``words`` with the squared weight ``w`` of their ``term``. Each word of a text is counted."""
    rare = F.log((1 + F.lit(total)) / (1 + F.col("df"))) + 1
    squares = counts.select("term", F.round(rare * rare * _UNIT).cast("bigint").alias("w"), "df")
    frequent = squares.orderBy(F.desc("df"), "term").limit(FREQUENT).select("term", F.col("w").alias("often"))
    some = words.join(F.broadcast(frequent), "term", "left")
    # frequent words have keys of their own, which no word equals
    key = F.when(F.col("often").isNull(), F.col("term")).otherwise(F.concat_ws(" ", F.lit(""), "row", "at"))
    some = some.withColumn("key", key).join(squares.select(F.col("term").alias("key"), F.col("w").alias("seldom")), "key", "left")
    return some.withColumn("w", F.coalesce("often", "seldom")).drop("key", "often", "seldom")


def _running(words: DataFrame, starts: DataFrame) -> DataFrame:
    """(row, template, start, line, sum): for each of ``starts`` (row, template, start, line) the weights of the distinct
    words of the run of ``m`` words from there. ``words`` has row, template, m, at, before (where the same word last
    was, or -1) and w: one counts in the runs that begin after ``before`` and up to ``at``."""
    c, no = F.col, F.lit(None).cast("int")
    event = lambda at, w, line: F.struct(at.cast("int").alias("start"), w.alias("w"), line.alias("line"))
    change = F.array(event(F.greatest(c("before"), c("at") - c("m")) + 1, c("w"), no), event(c("at") + 1, -c("w"), no))
    events = words.select("row", "template", F.inline(change))
    asked = starts.select("row", "template", "start", F.lit(0).cast("bigint").alias("w"), "line")
    so_far = Window.partitionBy("row", "template").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    return events.unionByName(asked).withColumn("sum", F.sum("w").over(so_far)).where("line is not null").drop("w")


_SCORED = "path string, digest string, license string, score double, tag boolean, whole boolean, held double, from int, to int, middle int"


def _scored(files: DataFrame, block: list, counts: DataFrame, total: int, scratch: str, threshold: float) -> DataFrame:
    """The parts that reach the threshold with a template of the block, with their first, last and middle lines."""
    spark = files.sparkSession
    c = F.col

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    holders: dict[str, list[int]] = {}
    for i, r in enumerate(block):
        for t in r["terms"]:
            holders.setdefault(t, []).append(i)
    df = {r["term"]: r["df"] for r in counts.where(c("term").isin(sorted(holders))).collect()}
    square = {t: round((math.log((1 + total) / (1 + df.get(t, 0))) + 1) ** 2 * _UNIT) for t in holders}
    least = threshold * threshold * (1 - 1e-9)  # by a margin for rounding
    # a match holds most of a template, so of its rarest words at least what it may not lack
    rarest, bounds = [], []
    for i, r in enumerate(block):
        size, part = sum(square[t] for t in r["terms"]), 0
        sought = (1 - least) * size + least * size / 2
        for t in sorted(r["terms"], key=lambda t: (-square[t], t)):
            if part >= sought:
                break
            rarest.append((i, t, square[t]))
            part += square[t]
        tag = r["terms"][0] == TAG
        bounds.append((i, r["license"], r["n"], size, tag, tag or r["n"] < TITLE_WORDS, (part - (1 - least) * size) * (1 - 1e-9)))
    templates = F.broadcast(spark.createDataFrame(bounds, "template int, license string, m int, size long, tag boolean, short boolean, need double"))
    held = F.broadcast(spark.createDataFrame(rarest, "template int, term string, w long"))
    terms = F.broadcast(spark.createDataFrame([(t, i, square[t]) for t, i in holders.items()], "term string, holders array<int>, w long"))

    anchors = sorted({t for _, t, _ in rarest})
    some = files.withColumn("terms", F.array_distinct(F.filter(_words(c("text")), lambda t: t.isin(anchors)))).where(F.size("terms") > 0)
    digest = F.sha2(F.concat_ws("\n", "path", "text"), 256)
    some = kept(some.select(F.monotonically_increasing_id().alias("row"), "path", digest.alias("digest"), "lines", "terms"), "some")
    pairs = some.select("row", F.explode("terms").alias("term")).join(held, "term").groupBy("row", "template").agg(F.sum("w").alias("w"))
    pairs = pairs.join(templates, "template").where(c("w") >= c("need")).groupBy("row").agg(F.collect_list("template").alias("templates"))

    # the words of these texts, where each was before, and the templates that have it
    placed = F.flatten(F.transform("lines", lambda s, i: F.transform(_words(s), lambda w: F.struct(i.alias("line"), w.alias("term")))))
    words = some.join(pairs, "row").select("row", "templates", F.posexplode(placed).alias("at", "o")).select("row", "templates", "at", "o.line", "o.term")
    last = F.lag(F.struct("at", "line")).over(Window.partitionBy("row", "term").orderBy("at"))
    words = words.withColumn("last", last).join(terms, "term", "left").select(
        "row", "at", "line", "term", "w", F.coalesce("last.at", F.lit(-1)).alias("before"), (F.coalesce("last.line", F.lit(-1)) < c("line")).alias("fresh"),
        F.array_intersect("templates", F.coalesce("holders", F.array().cast("array<int>"))).alias("hits"),
    )
    words = kept(words, "words")

    # parts that hold enough of a template
    shared = words.select("row", F.explode("hits").alias("template"), "at", "line", "w", "before", "fresh").join(templates, "template")
    enough = lambda parts: parts.join(templates, "template").where(c("dot") >= F.lit(least) * c("size"))
    lines = shared.where("fresh").groupBy("row", "template", "line").agg(F.sum("w").alias("dot")).withColumn("start", F.lit(None).cast("int"))
    whole = shared.where("before < 0 and not short").groupBy("row", "template").agg(F.sum("w").alias("dot"))
    whole = whole.withColumns({"start": F.lit(0), "line": F.lit(None).cast("int")})
    long = shared.where("not short")
    runs = _running(long, long.withColumn("start", c("at"))).withColumnRenamed("sum", "dot")
    parts = [enough(p).withColumn("kind", F.lit(k)) for k, p in (("line", lines), ("whole", whole), ("run", runs))]
    parts = kept(parts[0].unionByName(parts[1]).unionByName(parts[2]).select("row", "template", "license", "m", "size", "tag", "kind", "start", "line", "dot"), "parts")

    # the lengths of these parts
    words = kept(_weights(words.drop("w", "hits").join(parts.where("not tag").select("row").distinct(), "row", "left_semi"), counts, total), "weights")
    lines = parts.where("kind = 'line'").join(words.where("fresh").groupBy("row", "line").agg(F.sum("w").alias("sum")), ["row", "line"], "left")
    of_text = words.groupBy("row").agg(F.sum(F.when(c("before") < 0, c("w"))).alias("sum"), F.count("*").cast("int").alias("n"))
    whole = parts.where("kind = 'whole'").join(of_text, "row").where("n <= 2 * m").drop("m").withColumnRenamed("n", "m")
    runs = parts.where("kind = 'run'")
    spans = runs.groupBy("row", "template", "m").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    near = words.join(spans, "row").where((c("at") >= c("low")) & (c("at") < c("high") + c("m")))
    lengths = _running(near, runs).drop("line")
    runs = runs.join(lengths, ["row", "template", "start"]).join(of_text.select("row", "n"), "row")
    runs = runs.withColumn("m", F.least(c("m"), c("n") - c("start"))).drop("n")
    # what else stands in the line of a tag doesn't matter
    cosine = c("dot") / F.sqrt(c("sum").cast("double") * c("size"))
    score = F.round(F.when(c("tag"), F.when(c("dot") >= c("size") * (1 - 1e-9), 1.0).otherwise(0.0)).otherwise(cosine), 6)
    scored = lines.unionByName(whole).unionByName(runs).withColumn("score", score).where(c("score") >= threshold)
    scored = kept(scored.withColumn("held", F.round(c("dot") * c("score") * c("score") / _UNIT, 6)), "reached")
    # lines of the first, middle and last words of parts of several lines
    several = scored.where("kind != 'line'")
    places = F.array(c("start"), c("start") + F.floor((c("m") - 1) / 2).cast("int"), c("start") + c("m") - 1)
    places = several.select("row", "template", "kind", "start", F.posexplode(places).alias("which", "at"))
    at = places.join(words.select("row", "at", c("line").alias("l")), ["row", "at"]).groupBy("row", "template", "kind", "start")
    at = at.agg(F.min("l").alias("from"), F.max("l").alias("to"), F.max(F.when(c("which") == 1, c("l"))).alias("middle"))
    several = several.join(at, ["row", "template", "kind", "start"])
    alone = scored.where("kind = 'line'").withColumns({x: c("line") for x in ("from", "to", "middle")})
    out = alone.unionByName(several).withColumn("whole", c("kind") == "whole").join(some.select("row", "path", "digest"), "row")
    return kept(out.select(*(x.split()[0] for x in _SCORED.split(", "))), "scored")


def _best(scored: DataFrame) -> DataFrame:
    """(path, line, license, score): for each line the best of the templates that reach the threshold in a part with
    this line, and all SPDX tags. A line's best is what holds most of a template, but a whole text yields to its parts."""
    file = ["path", "digest"]
    scored = scored.where("path is not null")  # a NULL path has no own licences
    lines = scored.withColumn("line", F.explode(F.sequence("from", "to")))
    order = F.struct("whole", (-F.col("held")).alias("held"), (-F.col("score")).alias("score"), "license")
    best = lines.where("not tag").groupBy(*file, "line").agg(F.min(order).alias("o"))
    best = best.select(*file, "line", "o.license", (-F.col("o.score")).alias("score"))
    # a part that only reaches over the edge of a better one is none: its license must be the best in its middle
    middles = lines.where("not tag and line = middle").select(*file, "line", "license").distinct()
    sure = best.join(middles, [*file, "line", "license"], "left_semi").select(*file, "license").distinct()
    best = best.join(sure, [*file, "license"], "left_semi").select("path", "line", "license", "score")
    tags = lines.where("tag").select("path", "line", "license", "score")
    return best.union(tags).distinct()
