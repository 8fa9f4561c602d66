"""License scans: passages compared to licence templates by Dice over word bigrams.

A text is normalised (lower case, letters and digits only) and cut into passages: its lines,
its paragraphs and itself. A passage's Dice coefficient with a template is twice the shared
distinct bigrams over the sum of both. It can only reach the threshold t if the passage's
bigrams number between ``t / (2 - t)`` and ``(2 - t) / t`` times the template's, so templates
outside those bounds are not compared. It also has to share a least number of the template's
bigrams; a few words (anchors) are chosen so that bigrams without any of them are too few for
that, and texts without an anchor are not cut up at all. Everything happens inside a row: no
shuffle, no UDF.

A licence of several lines or paragraphs inside a longer text is none of these passages. So all
runs of consecutive lines, across paragraphs, are passages as well where no line, paragraph or
whole text reaches the threshold; of runs that overlap, the one with the highest coefficient
counts. Only templates of which the text shares enough bigrams are looked for. The runs are
found in one pass over the lines: a run stops growing once it has too many bigrams, or once all
that its first line shares has come again, as the run from the next line on is then no worse.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.once import computed_once
from tidegate.llm.shared import col

THRESHOLD = 0.75

# too frequent in prose to be an anchor while another word is left
COMMON = frozenset("the of and to in or a is this that any for with be by as are on an it not from".split())

# fixed values: wording of common licences and licence notices
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: 1. Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
        IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
        ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY
        OF SUCH DAMAGE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3 of
        the License, or (at your option) any later version. This program is distributed in the hope that
        it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY
        or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to
        copy, modify, publish, use, compile, sell, or distribute this software, either in source code
        form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "MIT notice": "Released under the MIT License.",
    "MIT notice 2": "Licensed under the MIT License.",
    "BSD notice": "Licensed under the BSD 3-Clause License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0 notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC0 notice": "To the extent possible under law, the author has waived all copyright to this work.",
}


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Fewest and most bigrams a passage may have to reach the threshold with n of a template."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def anchors(templates: dict[str, str], threshold: float = THRESHOLD) -> list[str]:
    """Words of which any passage that reaches the threshold with some template holds one.

    A template's bigrams without an anchor number less than a hit has to share. Chosen
    greedily: the word that helps most templates on, longer words before shorter ones.
    """
    grams = {name: template_bigrams(wording) for name, wording in templates.items()}
    need = {}  # bigrams that have to hold an anchor
    for name, own in grams.items():
        least = math.ceil(threshold * (size_bounds(len(own), threshold)[0] + len(own)) / 2 - 1e-9)
        need[name] = len(own) - max(least, 1) + 1
    chosen: list[str] = []
    while any(n > 0 for n in need.values()):
        gain: dict[str, float] = {}
        for name, own in grams.items():
            for word in {w for g in own for w in g.split()} if need[name] > 0 else ():
                held = sum(word in g.split() for g in own)
                gain[word] = gain.get(word, 0) + min(held, need[name]) / need[name]
        word = max(gain, key=lambda w: (w not in COMMON, gain[w] * min(len(w), 8) ** 2, w))
        chosen.append(word)
        for name, own in grams.items():
            grams[name] = [g for g in own if word not in g.split()]
            need[name] -= len(own) - len(grams[name])
    return chosen


def normalised(text: Column) -> Column:
    """Lower case; whatever is neither letter, digit nor line end becomes a space."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


def let(value: Column, use) -> Column:
    """An expression of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bigrams(words: Column) -> Column:
    """The distinct bigrams of some words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(
        F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)
    ))


def word_lines(plain: Column) -> Column:
    """Lines with words: paragraph, words, own bigrams, and the one that links the line before."""
    cut = F.transform(F.split(plain, "\n *\n"), lambda p, i: F.transform(
        F.filter(
            F.transform(F.split(p, "\n"), lambda x: F.filter(F.split(x, " "), lambda w: w != "")),
            lambda w: F.size(w) > 0,
        ),
        lambda w: F.struct(i.alias("par"), w.alias("words")),
    ))
    none = F.array().cast("array<string>")
    return let(F.flatten(cut), lambda lines: F.transform(lines, lambda x, i: F.struct(
        x["par"].alias("par"), x["words"].alias("words"), bigrams(x["words"]).alias("own"),
        F.when(i > 0, F.array(F.concat(
            F.element_at(F.get(lines, i - 1)["words"], -1), F.lit(" "), F.get(x["words"], F.lit(0))
        ))).otherwise(none).alias("link"),
    )))


def best_runs(lines: Column, t: Column, threshold: float) -> Column:
    """(dice, start, end) of runs of lines that reach the threshold with a template, the best one
    from each start that may be the best of those that overlap it."""

    def step(state: Column, x: Column) -> Column:
        k = state["k"]

        def grown(v: Column) -> Column:
            def one(r: Column) -> Column:
                fresh = r["start"] == k - 1
                owed = F.when(fresh, F.array_union(r["owe"], v["link"])).otherwise(r["owe"])
                new = F.struct(
                    F.array_union(r["grams"], v["more"]).alias("grams"),
                    F.array_union(r["hits"], v["both"]).alias("hits"),
                    F.array_except(owed, F.when(fresh, v["own"]).otherwise(v["both"])).alias("owe"),
                )

                def judged(w: Column) -> Column:
                    dice = 2.0 * F.size(w["hits"]) / (F.size(w["grams"]) + t["n"])
                    return F.struct(
                        r["start"].alias("start"), w["grams"].alias("grams"), w["hits"].alias("hits"),
                        w["owe"].alias("owe"), F.greatest(dice, r["dice"]).alias("dice"),
                        F.when(dice > r["dice"], k).otherwise(r["end"]).alias("end"),
                    )

                return let(new, judged)

            born = F.struct(
                k.alias("start"), x["own"].alias("grams"), v["own"].alias("hits"), v["own"].alias("owe"),
                (2.0 * F.size(v["own"]) / (F.size(x["own"]) + t["n"])).alias("dice"), k.alias("end"),
            )
            return F.concat(F.transform(state["active"], one), F.array(born))

        own = F.array_intersect(x["own"], t["grams"])
        link = F.array_intersect(x["link"], t["grams"])
        shared = F.struct(
            own.alias("own"), link.alias("link"), F.array_union(link, own).alias("both"),
            F.array_union(x["link"], x["own"]).alias("more"),
        )

        def sorted_out(runs: Column) -> Column:
            def alive(r):
                return (F.size(r["grams"]) <= t["high"]) & ((r["start"] == k) | (F.size(r["owe"]) > 0))

            over = F.filter(runs, lambda r: ~alive(r) & (r["dice"] >= threshold))
            return F.struct(
                F.filter(runs, alive).alias("active"),
                F.concat(state["done"], F.transform(over, place)).alias("done"), (k + 1).alias("k"),
            )

        return let(let(shared, grown), sorted_out)

    def place(r: Column) -> Column:
        return F.struct(r["dice"].alias("dice"), r["start"].alias("start"), r["end"].alias("end"))

    run = ("array<struct<start:int,grams:array<string>,hits:array<string>,owe:array<string>,"
           "dice:double,end:int>>")
    begin = F.struct(
        F.array().cast(run).alias("active"),
        F.array().cast("array<struct<dice:double,start:int,end:int>>").alias("done"), F.lit(0).alias("k"),
    )
    return F.aggregate(lines, begin, step, lambda state: F.concat(state["done"], F.transform(
        F.filter(state["active"], lambda r: r["dice"] >= threshold), place
    )))


def run_hits(plain: Column, known: Column, threshold: float) -> Column:
    """Array of (dice, license) of runs of lines where no single passage reaches the threshold."""

    def reaches(grams: Column, t: Column) -> Column:
        return 2.0 * F.size(F.array_intersect(grams, t["grams"])) >= threshold * (F.size(grams) + t["n"])

    def of_template(lines: Column, t: Column) -> Column:
        def missed(r: Column) -> Column:
            inside = F.slice(lines, r["start"] + 1, r["end"] - r["start"] + 1)
            paragraphs = F.sequence(F.get(lines, r["start"])["par"], F.get(lines, r["end"])["par"])
            whole = F.transform(paragraphs, lambda p: bigrams(F.flatten(F.transform(
                F.filter(lines, lambda x: x["par"] == p), lambda x: x["words"]
            ))))
            return ~F.exists(inside, lambda x: reaches(x["own"], t)) & ~F.exists(whole, lambda g: reaches(g, t))

        ranked = F.array_sort(F.transform(best_runs(lines, t, threshold), lambda r: F.struct(
            (-r["dice"]).alias("least"), (r["end"] - r["start"]).alias("size"),
            r["start"].alias("start"), r["end"].alias("end"),
        )))
        none = F.array().cast("array<struct<least:double,size:int,start:int,end:int>>")
        apart = F.aggregate(ranked, none, lambda kept, r: F.when(
            F.exists(kept, lambda q: (q["start"] <= r["end"]) & (r["start"] <= q["end"])), kept
        ).otherwise(F.concat(kept, F.array(r))))
        return F.transform(F.filter(apart, missed), lambda r: F.struct(
            (-r["least"]).alias("dice"), t["name"].alias("license"),
            F.concat_ws(" ", F.flatten(F.transform(
                F.slice(lines, r["start"] + 1, r["size"] + 1), lambda x: x["words"]
            ))).alias("passage"),
        ))

    words = F.filter(F.split(F.translate(plain, "\n", " "), " "), lambda w: w != "")
    near = let(bigrams(words), lambda g: F.filter(
        known, lambda t: (F.size(F.array_intersect(g, t["grams"])) >= t["need"]) & ~reaches(g, t)
    ))

    def searched(near: Column) -> Column:
        found = let(word_lines(plain), lambda lines: F.flatten(F.transform(near, lambda t: of_template(lines, t))))
        return F.transform(F.array_distinct(found), lambda h: F.struct(h["dice"].alias("dice"), h["license"].alias("license")))

    none = F.array().cast("array<struct<dice:double,license:string>>")
    return let(near, lambda n: F.when(F.size(n) > 0, searched(n)).otherwise(none))


def passages(plain: Column) -> Column:
    """The words of each line, of each paragraph and of the whole text, each passage once."""
    units = F.concat(F.split(plain, "\n"), F.split(plain, "\n *\n"), F.array(plain))
    return F.transform(
        F.array_distinct(units),
        lambda u: F.filter(F.split(F.translate(u, "\n", " "), " "), lambda w: w != ""),
    )


def license_hits(plain: Column, templates: dict[str, str] = TEMPLATES,
                 threshold: float = THRESHOLD) -> Column:
    """Array of (dice, license) of all passages and templates that reach the threshold, for a
    normalised text."""
    rows = []
    for name, wording in templates.items():
        grams = template_bigrams(wording)
        low, high = size_bounds(len(grams), threshold)
        rows.append((name, len(grams), low, high, grams))
    known = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(n).alias("n"), F.lit(low).alias("low"),
                 F.lit(high).alias("high"), F.lit(max(math.ceil(threshold * (low + n) / 2 - 1e-9), 1)).alias("need"),
                 F.array(*map(F.lit, grams)).alias("grams"))
        for name, n, low, high, grams in rows
    ])
    least, most = min(r[2] for r in rows), max(r[3] for r in rows)
    # repeated bigrams make a passage longer than its distinct ones, so only the lower bound is
    # known from the words; the upper one is tested on the bigrams
    long_enough = F.filter(passages(plain), lambda w: F.size(w) > least)
    grams = F.transform(long_enough, lambda w: F.array_distinct(F.zip_with(
        F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)
    )))
    grams = F.filter(grams, lambda g: F.size(g).between(least, most))

    def compared(g: Column) -> Column:
        near = F.filter(known, lambda t: F.size(g).between(t["low"], t["high"]))
        return F.transform(near, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + t["n"])).alias("dice"),
            t["name"].alias("license"),
        ))

    hits = F.filter(F.flatten(F.transform(grams, compared)), lambda h: h["dice"] >= threshold)
    words = F.split(F.translate(plain, "\n", " "), " ")
    hits = F.concat(hits, run_hits(plain, known, threshold))
    possible = F.arrays_overlap(words, F.array(*map(F.lit, anchors(templates, threshold))))
    return F.coalesce(F.when(possible, hits), F.array().cast("array<struct<dice:double,license:string>>"))


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``license`` (best, or null), ``dice``, ``n_hits``, ``licenses`` (all, joined).

    The best hit has the highest coefficient; of equal ones the first name in code-point order
    wins. ``n_hits`` counts passages and templates that reach the threshold, equal passages of
    a text once, and runs of lines where no line, paragraph or whole text does. A null or empty text has none. One row per row; other columns are ignored.
    """
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    plain = computed_once(rows, plain=normalised(F.col("text")))
    hits = computed_once(plain.select("doc_id", "plain"), hits=license_hits(F.col("plain"), templates, threshold))
    best = F.array_min(F.transform("hits", lambda h: F.struct((-h["dice"]).alias("d"), h["license"].alias("l"))))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["license"])))
    return hits.select(
        "doc_id", best["l"].alias("license"), (-best["d"]).alias("dice"),
        F.size("hits").cast("long").alias("n_hits"), F.concat_ws(",", names).alias("licenses"),
    )
