"""Licence notices in texts: fixed phrases, and an exact join of text blocks with notice templates.

A template is the set of words of a licence's notice. A text block meets it if it holds at least
``SHARE`` of the template's words. Blocks are runs of words: for templates of up to c words (c is 16, 32,
64 or 128) runs of c + c/2 words that begin every c/2 words, so that every run of c words lies whole in one.

The join is exact. Words are ordered by the number of texts that have them, rare ones first. A block
that shares ``o`` of a template's ``m`` words holds one of the template's ``m - o + 1`` first
ones (prefix), has ``o`` template words in all (length), and at the first shared word both have enough words
left (position). So blocks are only made around words of a prefix, which in most texts don't occur;
their first words are joined with the prefixes, and what is left is counted in full.

Where one licence's notice would itself meet another's template (the Lesser GPL's and the GPL's), a block
gets the label of the one that it holds more of. DataFrame functions only.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import written
from quillframe.llm.decontaminate import SEPARATORS, _once, words_of

#: Share of a template's words that a block must hold, in tenths.
SHARE = 8
CLASSES = (16, 32, 64, 128)
#: Phrases of consecutive words, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Labels, and the notices that the licences ask for.
NOTICES = (
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("boost", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"),
    ("cc-by-nc", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/"),
    ("cc0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
)


class Template:
    """A notice: its label, number, class of block lengths, distinct words and how many of them a block must hold."""

    def __init__(self, number: int, label: str, notice: str):
        words = [w for w in re.split(SEPARATORS, notice.lower()) if w]
        self.number, self.label, self.words = number, label, sorted(set(words))
        self.length = next(c for c in CLASSES if c >= len(words))
        self.need = -(-SHARE * len(self.words) // 10)


@lru_cache(maxsize=1)
def templates() -> list[Template]:
    """All templates, in the order of ``NOTICES``."""
    return [Template(k, *x) for k, x in enumerate(NOTICES)]


def related(own: list[Template]) -> set[tuple[int, int]]:
    """Pairs of templates of different labels of which one's notice meets the other."""
    both = {(x.number, y.number) for x in own for y in own if x.label != y.label and len({*x.words} & {*y.words}) >= y.need}
    return both | {(y, x) for x, y in both}


def word_order(docs: DataFrame, own: list[Template]) -> list[str]:
    """The templates' words by the number of rows of ``docs`` (words) that have them, rare ones first."""
    vocabulary = sorted({w for t in own for w in t.words})
    found = docs.select(F.explode(F.array_distinct(F.filter("words", lambda w: w.isin(*vocabulary)))).alias("w")).groupBy("w").count()
    rows = dict(found.collect())  # a row for each template word at most
    return sorted(vocabulary, key=lambda w: (rows.get(w, 0), w))


def _blocks(length: int, own: list[Template], order: list[str], places):
    """Column: (length, block, words) of the blocks of one class that hold a word of a prefix; words are those of
    its templates, in order."""
    step, wide = length // 2, length // 2 * 3
    own = [t for t in own if t.length == length]
    if not own:
        return F.array().cast(_BLOCKS)
    vocabulary = [w for w in order if any(w in t.words for t in own)]
    first = sorted({w for t in own for w in _prefix(t, order)})
    at = F.filter(places, lambda x: x["word"].isin(*first))
    numbers = F.array_distinct(
        F.flatten(F.transform(at, lambda x: F.sequence(F.greatest(F.floor(x["place"] / step).cast("int") - 2, F.lit(0)), F.floor(x["place"] / step).cast("int"))))
    )
    held = lambda k: F.array_intersect(F.lit(vocabulary), F.slice("words", k * step + 1, wide))
    made = F.transform(numbers, lambda k: F.struct(F.lit(length).alias("length"), k.alias("block"), held(k).alias("words")))
    return F.filter(made, lambda b: F.size(b["words"]) >= min(t.need for t in own))


_BLOCKS = "array<struct<length:int,block:int,words:array<string>>>"


def _prefix(template: Template, order: list[str]) -> list[str]:
    own = {*template.words}
    return [w for w in order if w in own][: len(own) - template.need + 1]


def scanned(docs: DataFrame, own: list[Template], id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """A written table (row, id, n_words, starts: of all phrases, base: their labels, blocks) of all rows; the order of words."""
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    base = _once(base, "words", words_of(F.col("t"))).drop("t")
    order = word_order(base, own)
    phrases = [(p.split(), label) for p, label in PHRASES]
    sought = sorted({p[0] for p, _ in phrases} | {w for t in own for w in _prefix(t, order)})
    place = lambda w, k: F.when(w.isin(*sought), F.struct(w.alias("word"), k.alias("place")))
    base = _once(base, "places", F.array_compact(F.transform("words", place)))

    def stands(phrase: list[str]):
        def here(x):
            found = x["word"] == phrase[0]
            for k, w in enumerate(phrase[1:], 1):
                found = found & F.coalesce(F.get("words", x["place"] + k) == w, F.lit(False))
            return found

        return F.transform(F.filter("places", here), lambda x: x["place"].cast("long"))

    starts = F.array(*(F.struct(F.lit(label).alias("label"), stands(p).alias("at")) for p, label in phrases))
    blocks = F.concat(*(_blocks(c, own, order, F.col("places")) for c in CLASSES))
    base = base.select("row", "id", F.size("words").cast("long").alias("n_words"), starts.alias("found"), blocks.alias("blocks"))
    return written(
        base.select(
            "row", "id", "n_words", F.flatten(F.transform("found", lambda x: x["at"])).alias("starts"),
            F.transform(F.filter("found", lambda x: F.size(x["at"]) > 0), lambda x: x["label"]).alias("base"), "blocks",
        )
    ), order


def met(blocks: DataFrame, own: list[Template], order: list[str]) -> DataFrame:
    """(row, length, block, template, overlap) of all blocks (row, length, block, words) and templates that they meet."""
    spark = blocks.sparkSession
    prefixes = [
        (t.length, word, t.number, place, len(t.words), t.need, t.words) for t in own for place, word in enumerate(_prefix(t, order))
    ]  # bounded by the list of notices
    sides = F.broadcast(spark.createDataFrame(prefixes, "length int, word string, template int, place int, size int, need int, own array<string>"))
    least = F.lit(min(t.need for t in own))
    first = blocks.select("*", F.posexplode(F.slice("words", 1, F.greatest(F.size("words") - least + 1, F.lit(0)))).alias("at", "word"))
    enough = F.least(F.size("words") - F.col("at"), F.col("size") - F.col("place")) >= F.col("need")
    pairs = first.join(sides, ["length", "word"]).where((F.size("words") >= F.col("need")) & enough)
    overlap = F.size(F.array_intersect("words", "own"))
    return pairs.select("row", "length", "block", "template", overlap.alias("overlap"), "need").where("overlap >= need").drop("need").distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: ``id_col``, n_words, starts (array of the places of all phrases), base (their
    labels), found (labels of the templates met by a block), score.

    score is 1 where a phrase stands, otherwise the largest share of a template's words that a block
    holds, if that meets the template, otherwise 0. Null, empty and wordless texts have no words and no
    labels; repeated rows stay repeated rows; an empty table gives an empty one.
    """
    own = templates()
    rows, order = scanned(docs, own, id_col, text_col)
    hits = met(rows.select("row", F.inline("blocks")), own, order)
    sizes, labels = F.lit([len(t.words) for t in own]), F.lit([t.label for t in own])
    hits = hits.groupBy("row", "length", "block").agg(
        F.collect_list(F.struct("template", (F.col("overlap") / F.get(sizes, F.col("template"))).alias("share"), "overlap")).alias("own")  # templates at most
    )
    rivals = F.lit([f"{x} {y}" for x, y in sorted(related(own))] or [""])

    def gives_way(x):
        key = lambda y: F.concat_ws(" ", x["template"].cast("string"), y["template"].cast("string"))
        return F.exists("own", lambda y: F.array_contains(rivals, key(y)) & (F.struct(y["share"], y["overlap"]) > F.struct(x["share"], x["overlap"])))

    kept = hits.select("row", F.inline(F.filter("own", lambda x: ~gives_way(x))))
    per_row = kept.groupBy("row").agg(F.collect_set(F.get(labels, F.col("template"))).alias("found"), F.max("share").alias("share"))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.join(per_row, "row", "left").select(
        F.col("id").alias(id_col), "n_words", "starts", "base", F.coalesce("found", F.array().cast("array<string>")).alias("found"), score.alias("score")
    )
