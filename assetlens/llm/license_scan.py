"""License scans: exact set-similarity join of text blocks with license templates.

A block is a window over the words of the whole text (on request over each line's words), which overlaps the next by half.
Templates come in classes by their number of words, and a class has windows twice as long as its longest template, so a
notice always lies whole in a window however it is wrapped, and a short one is not looked for among the words of a page.
A template matches a block when the share of its distinct tokens that the block holds reaches the threshold. The join is the
prefix-filter kind:
tokens are put in one global order, rarest in the corpus first; a template of ``n`` tokens that must share at
least ``o`` can only match a block that holds one of its first ``n - o + 1``; a block with fewer than ``o``
template tokens is too short; and a match at position ``i`` of the block and ``j`` of the template leaves at most
``1 + min(rest of block, rest of template)`` common tokens. What passes all three is counted exactly.

Only windows that hold a prefix token are cut, and only template tokens can be shared, so blocks are reduced to them first.
The template index is bounded by the template list, not by the data, and is broadcast. Texts and blocks are never shuffled:
one small row per document and match is, to gather the matches of a document.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import let, lower_ascii

# What separates words once A-Z are lower-cased, and the phrases every scan reports.
SEPARATORS_RE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of common license notices, by label. Notices of a line, then paragraphs of the license texts.
TEMPLATES = {
    "agpl": "under the gnu affero general public license version 3",
    "apache-2.0": "licensed under the apache license version 2.0",
    "apache-notice": "you may not use this file except in compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-sa": "creative commons attribution sharealike 4.0 international license",
    "cc0": "dedicated to the public domain cc0 1.0 universal",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "lgpl": "under the gnu lesser general public license version 2.1",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "subject to the terms of the mozilla public license v. 2.0",
    "apache-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES "
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "gpl-preamble": (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most "
        "software and other practical works are designed to take away your freedom to share and change the works. By contrast, the "
        "GNU General Public License is intended to guarantee your freedom to share and change all versions of a program--to make "
        "sure it remains free software for all its users."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "lgpl-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
        "version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."),
    "mpl-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means."),
    "warranty": (
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
}


def half_window(template: str) -> int:
    """Half the words of a template's windows: the power of two that holds the template, at least 8."""
    words = len([w for w in re.split(SEPARATORS_RE, template.lower()) if w])
    return max(8, 1 << max(words - 1, 0).bit_length())


def words_of(text: Column) -> Column:
    """Words of a text (null: none): runs of a-z after lower-casing A-Z, digits and non-ASCII characters."""
    return F.filter(F.split(normalised(text), " "), lambda w: w != "")


def normalised(text: Column) -> Column:
    """The words of a text with single spaces between them; separators at the ends leave one space there."""
    return F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS_RE, " ")


def tokens_of(template: str) -> list[str]:
    return sorted({w for w in re.split(SEPARATORS_RE, template.lower()) if w})


def phrase_places(words: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """Array of (at, label) of every place where a phrase's words stand consecutively, in text order."""
    nothing = F.array().cast("array<struct<at:bigint,label:string>>")

    def places(parts: list[str], label: str) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.coalesce(
            _all([F.get(words, i + k) == p for k, p in enumerate(parts)]), F.lit(False)))
        # the last word of a phrase is looked up first: most texts have none, and need no second look
        return F.when(F.array_contains(words, parts[-1]), F.transform(at, lambda i: F.struct(
            i.cast("long").alias("at"), F.lit(label).alias("label")))).otherwise(nothing)

    return F.array_sort(F.concat(*[places(phrase.split(" "), label) for phrase, label in phrases.items()]))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def windows_of(words: Column, half: int, prefix: list[str]) -> Column:
    """The windows that hold a word of ``prefix``, as (at, words): ``2 * half`` words from word ``at * half`` on. The last
    window is the first one that reaches the end."""
    def around(n: Column) -> Column:
        last = F.greatest(F.ceil(n / half).cast("int") - 2, F.lit(0))
        hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(prefix), F.floor(i / half).cast("int"))), lambda k: k.isNotNull())
        ks = F.array_distinct(F.flatten(F.transform(hits, lambda k: F.array(
            F.greatest(F.least(k - 1, last), F.lit(0)), F.least(k, last)))))
        return F.transform(ks, lambda k: F.struct(k.alias("at"), F.slice(words, k * half + 1, F.lit(2 * half)).alias("words")))

    return let(F.size(words), around)


def token_order(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template tokens, rarest first in the whole corpus (``words``: one array column); ties by token.

    At most ``len(vocabulary)`` counts reach the driver.
    """
    counts = dict(words.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("token"))
                  .groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect())
    return sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))


@dataclass(frozen=True)
class TemplateIndex:
    """The templates in one token order, with what each must share, the prefix it can be met by, and its windows."""

    order: list[str]
    rows: list[tuple]  # label, tokens, need, half a window's words

    @classmethod
    def build(cls, templates: dict[str, str], order: list[str], threshold: float, block_words: int | None = None) -> TemplateIndex:
        rank = {t: i for i, t in enumerate(order)}
        rows = []
        for label, text in sorted(templates.items()):
            tokens = sorted(tokens_of(text), key=rank.__getitem__)
            half = block_words // 2 if block_words else half_window(text)
            rows.append((label, tokens, max(1, math.ceil(threshold * len(tokens) - 1e-9)), half))
        return cls(order, rows)

    def postings(self, spark: SparkSession) -> DataFrame:
        """One row per template and prefix token: ``token, half, j, label, template, need``."""
        rows = [(t, half, j, label, tokens, need) for label, tokens, need, half in self.rows
                for j, t in enumerate(tokens[:len(tokens) - need + 1])]
        return spark.createDataFrame(rows, "token string, half int, j int, label string, template array<string>, need int")

    def classes(self) -> dict[int, TemplateIndex]:
        """The templates of each window size, in the same order of tokens."""
        return {h: TemplateIndex(self.order, [r for r in self.rows if r[3] == h]) for h in sorted({r[3] for r in self.rows})}

    def tokens(self) -> list[str]:
        mine = {t for r in self.rows for t in r[1]}
        return [t for t in self.order if t in mine]

    def prefix_tokens(self) -> list[str]:
        return sorted({t for _, tokens, need, _ in self.rows for t in tokens[:len(tokens) - need + 1]})


def template_matches(blocks: DataFrame, index: TemplateIndex) -> DataFrame:
    """``blocks`` (with ``block``, a struct of ``at``, ``half`` and ``tokens``: distinct template tokens in the index's order)
    left-joined with the templates they hold; adds ``match`` (label, block, containment), null where a row's
    token meets no template. Exact, and a pair is met once: by its first common token."""
    spark = blocks.sparkSession
    met = (blocks.select("*", F.col("block.half").alias("half"), F.posexplode_outer("block.tokens").alias("i", "token"))
           .join(F.broadcast(index.postings(spark)), ["token", "half"], "left"))
    size, i, j, need = F.size("block.tokens"), F.col("i"), F.col("j"), F.col("need")
    common = F.array_intersect("block.tokens", "template")
    holds = ((size >= need)
             & (F.least(size - i, F.size("template") - j) >= need)
             & (F.get(common, F.lit(0)) == F.col("token"))
             & (F.size(common) >= need))
    match = F.struct("label", F.col("block.at").alias("block"), (F.size(common) / F.size("template")).alias("containment"))
    return met.withColumn("match", F.when(holds, match)).drop("i", "token", "half", "template", "need", "j", "label", "block")


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                 threshold: float = 0.9, block_words: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text", across_lines: bool = True) -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``places`` (phrase places, in order), ``matches`` (label, block,
    containment; one per template met, from its best and then first block) and ``score``, the best containment
    (1 for a phrase, 0 for nothing found). ``block`` is the window's number among those of its size, counted over the lines
    one after another if not ``across_lines``.

    A null or empty text has no words, no places and score 0. Repeated rows each get their row; other columns of
    the input are not read. Windows overlap by half, and a notice of up to half a window always lies whole in one. Their size
    follows from the template; ``block_words`` sets one for all. An empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    vocabulary = sorted({t for x in templates.values() for t in tokens_of(x)})
    index = TemplateIndex.build(templates, token_order(docs.select(words_of(text).alias("words")), vocabulary), threshold, block_words)

    def reduced(windows: Column, mine: TemplateIndex, half: int) -> Column:
        """Windows with enough template tokens, as (at, half, tokens)."""
        ordered, least = F.array(*[F.lit(t) for t in mine.tokens()]), min(r[2] for r in mine.rows)
        short = F.transform(windows, lambda b: F.struct(
            b["at"], F.lit(half).alias("half"), F.array_intersect(ordered, b["words"]).alias("tokens")))
        return F.filter(short, lambda b: F.size(b["tokens"]) >= least)

    def by_line(lines: Column, half: int, prefix: list[str]) -> Column:
        """The windows of each line, numbered on from line to line."""
        counts = F.transform(lines, lambda x: F.greatest(F.ceil(F.size(x) / half).cast("int") - 1, F.lit(1)))
        before = F.transform(lines, lambda x, i: F.aggregate(F.slice(counts, F.lit(1), i), F.lit(0), lambda s, k: s + k))
        return F.flatten(F.zip_with(lines, before, lambda x, n: F.transform(
            windows_of(x, half, prefix), lambda w: F.struct((w["at"] + n).alias("at"), w["words"].alias("words")))))

    def blocks(lines: Column, words: Column) -> Column:
        out = []
        for half, mine in index.classes().items():
            prefix = mine.prefix_tokens()
            out.append(reduced(windows_of(words, half, prefix) if across_lines else by_line(lines, half, prefix), mine, half))
        return F.concat(*out)

    def from_lines(lines: Column) -> Column:
        return let(F.flatten(lines), lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            phrase_places(words, phrases).alias("places"),
            blocks(lines, words).alias("blocks")))

    scanned = docs.select(
        # numbers the rows of one scan; it is used in this one pass only
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        let(F.transform(F.split(text, "\n"), words_of), from_lines).alias("s"))
    flat = scanned.select("row", "id", "s.n_words", "s.places", F.explode_outer("s.blocks").alias("block"))
    found = (template_matches(flat, index).groupBy("row", "id", "n_words", "places")
             .agg(F.array_sort(F.collect_set("match")).alias("all")))
    # array_sort puts a label's matches together; keep each label's best, the first block on ties
    labels = F.array_distinct(F.transform("all", lambda m: m["label"]))
    best = F.transform(labels, lambda name: F.get(F.array_sort(F.transform(
        F.filter("all", lambda m: m["label"] == name),
        lambda m: F.struct((-m["containment"]).alias("c"), m["block"].alias("block"), m["label"].alias("label")))), F.lit(0)))
    score = F.greatest(F.coalesce(F.array_max(F.transform("all", lambda m: m["containment"])), F.lit(0.0)),
                       F.when(F.size("places") > 0, 1.0).otherwise(0.0))
    return found.select("id", "n_words", "places", F.transform(best, lambda m: F.struct(
        m["label"], m["block"], (-m["c"]).alias("containment"))).alias("matches"), score.alias("score"))
