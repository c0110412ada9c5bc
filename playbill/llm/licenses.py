"""Licence scan: a trained paragraph classifier, and template comparison to confirm it.

Everything is DataFrame functions and the JVM's ml transformers; no Python runs on executors.
"""

from __future__ import annotations

import re
from functools import cache, reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.storage import discard, materialize

UNKNOWN = "unknown"
#: Words of a window of a line or a paragraph, and how many the next one repeats.
WINDOW, OVERLAP = 64, 32
#: Most words of a template; longer paragraphs of a licence are several templates.
PIECE = 40
#: Weight that all unknown windows together have in the fit at most, whatever their number; an example of a licence has 1.
UNKNOWN_WEIGHT = 4000
#: Distinct feature sets of a task of the fit.
FIT_ROWS = 20_000
#: Share of held-out unknown windows that the threshold calls unknown at least.
CALIBRATION = 0.999
#: Share of the known classes' probability from which a family is looked at.
SHARE = 0.1
#: Share of a template's words and word pairs that a confirmed window has.
CONFIRM = 0.6

# The texts of short licences and the notices of longer ones, by paragraph.
LICENCES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "This project is released under the Apache 2.0 license.",
        "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
        "\"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
        "\"Legal Entity\" shall mean the union of the acting entity and all other entities that control, are controlled by, or are under common control with that entity.",
        "\"Source\" form shall mean the preferred form for making modifications, including but not limited to software source code, documentation source, and configuration files.",
        "\"Work\" shall mean the work of authorship, whether in Source or Object form, made available under the License, as indicated by a copyright notice that is included in or attached to the work.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program, to make sure it remains free software for all its users.",
        "The GNU General Public License does not permit incorporating your program into proprietary programs.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation.",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
        "See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "\"Covered Software\" means Source Code Form to which the initial Contributor has attached the notice in Exhibit A, the Executable Form of such Source Code Form, and Modifications of such Source Code Form, in each case including portions thereof.",
        "This Source Code Form is \"Incompatible With Secondary Licenses\", as defined by the Mozilla Public License, v. 2.0.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Licensed under the Eclipse Public License, version 2.0.",
        "The accompanying program is provided under the terms of this Eclipse Public License (\"Agreement\"). Any use, reproduction or distribution of the program constitutes recipient's acceptance of this agreement.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "You must give appropriate credit, provide a link to the license, and indicate if changes were made.",
    ],
    "CC0": [
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law.",
    ],
    "Unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS.",
    ],
    "Zlib": [
        "Released under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software.",
    ],
    "Artistic-2.0": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
        "Licensed under the Artistic License 2.0.",
    ],
    "WTFPL": [
        "Do What The Fuck You Want To Public License.",
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    ],
    "proprietary": [
        "Confidential and proprietary information of the company.",
        "This document contains confidential and proprietary information and may not be disclosed or reproduced without prior written consent.",
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "Copyright (c) 2024. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "Copyright. All rights reserved. Unauthorized copying of this file, via any medium is strictly prohibited. Proprietary and confidential.",
    ],
}
# Short names of the families, as SPDX and people write them.
SHORT_NAMES = {
    "Apache-2.0": ["Apache-2.0", "Apache 2.0"], "MIT": ["MIT"], "GPL": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL", "GPLv2", "GPLv3"],
    "LGPL": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL", "LGPLv2.1", "LGPLv3"],
    "AGPL": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL", "AGPLv3"], "BSD": ["BSD-2-Clause", "BSD-3-Clause", "BSD"], "MPL-2.0": ["MPL-2.0", "MPL 2.0"], "EPL-2.0": ["EPL-2.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0", "CC-BY-NC-SA-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0"], "CC-BY": ["CC-BY-4.0"], "CC0": ["CC0-1.0"], "Unlicense": ["Unlicense"], "ISC": ["ISC"], "Zlib": ["Zlib"],
    "BSL-1.0": ["BSL-1.0"], "Artistic-2.0": ["Artistic-2.0"], "WTFPL": ["WTFPL"],
}
# How short names stand, and for each the part that must be there as it is.
SHORT_FORMS = {"SPDX-License-Identifier: {}": "SPDX-License-Identifier {}", "License: {}": "License {}", "Licensed under {}": "under {}", "Licensed under the {} license": "the {} license"}
# What tells a family's texts from those of families with nearly the same words.
MARKS = frozenset([
    "gnu general", "lesser general", "affero general", "apache license", "apache 2.0", "mit license", "bsd-style", "2-clause", "3-clause", "mozilla public", "eclipse public", "boost software", "or organization",
    "artistic license", "fuck you", "cc by", "cc by-nc", "cc by-nc-sa", "cc by-sa", "attribution 4.0", "attribution-noncommercial", "attribution-noncommercial-sharealike", "attribution-sharealike", "cc0",
    "the unlicense", "isc license", "zlib license", "rights reserved", "proprietary information",
])
#: "not licensed under ..." up to the end of its sentence (300 characters at most); taken out before texts are cut.
DENIED = r"(?i)\b(?:not|never|isn't|nor)\s+(?:\w+\s+)?(?:licensed|released|distributed|published|available|covered)\s+(?:under|by)\b(?:[^.;]|\.(?=\w)){0,300}+"
#: A window's words that state some licence, known or not.
STATED = r"spdx-license-identifier \S+|\b(?:licensed|released|distributed) under (?:the terms of )?the (?:\S+ ){1,6}licen[cs]e\b"
FAMILIES = [UNKNOWN, *LICENCES]
#: Frequent words that tell little.
COMMON = frozenset("a all an and any are as at be but by can end for from has have her his if in is it its may no not of on one or other our out part see such terms that the their there they this to use was way we what which will with without work you your under should either above even file found more must name names new only used who within made make time were into being upon give large along http https".split())


def words(text: Column) -> Column:
    """Lower-cased words; dots and hyphens inside them stay (2.0, by-nc)."""
    bare = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.-]+|[.-]+(?![\p{L}\p{N}])", " ")
    return F.split(F.trim(bare), " +")


def grams(ws: Column) -> Column:
    """Words and pairs of neighbouring words."""
    pairs = F.zip_with(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(ws, pairs)


def _plain(text: str) -> list[str]:
    """words() of a short text on the driver."""
    kept = re.sub(r"[^\w.-]+|_+", " ", text.lower())
    return re.sub(r"[.-]+(?!\w)", " ", kept).split()


def _grams(ws: list[str]) -> list[str]:
    """grams() of a template on the driver, each once."""
    return list(dict.fromkeys([*ws, *map(" ".join, zip(ws, ws[1:]))]))


def marked_templates(unnamed: bool = False) -> list[tuple[str, list[str], list[str]]]:
    """(family, words, marks): the licences' paragraphs, long ones in pieces of about equal size, and their short forms.

    A window confirms a template only with all its marks. Of a paragraph that names its licence
    pieces without the name are left out, unless asked for: they confirm nothing, as other licences
    have them too, but teach the classifier.
    """
    made = []
    for family, paragraphs in LICENCES.items():
        for ws in map(_plain, paragraphs):
            n = -(-len(ws) // PIECE)
            pieces = [ws[i * len(ws) // n : (i + 1) * len(ws) // n] for i in range(n)]
            marks = [[g for g in _grams(piece) if g in MARKS] for piece in pieces]
            made += [(family, piece, own) for piece, own in zip(pieces, marks) if own or unnamed or not any(marks)]
        for name in SHORT_NAMES.get(family, []):
            for form, fixed in SHORT_FORMS.items():
                part = _plain(fixed.format(name))
                made.append((family, _plain(form.format(name)), list(map(" ".join, zip(part, part[1:])))))
    return made


def templates() -> list[tuple[str, list[str]]]:
    """(family, words) of all templates."""
    return [(family, ws) for family, ws, _ in marked_templates()]


def anchors() -> list[str]:
    """Words of which every confirmed window has one.

    Without them a window has less than CONFIRM of any template's words and pairs. Chosen greedily,
    frequent words last.
    """
    open_ = []
    for _, ws in templates():
        grams_ = [(w,) for w in dict.fromkeys(ws)] + list(dict.fromkeys(zip(ws, ws[1:])))
        open_.append((grams_, len(grams_)))
    chosen: list[str] = []
    while open_:
        weight: dict[str, float] = {}
        for left, _ in open_:
            for g in left:
                for w in dict.fromkeys(g):
                    weight[w] = weight.get(w, 0.0) + (0.001 if w in COMMON else 1.0)
        best = max(weight, key=lambda w: (weight[w], w))
        chosen.append(best)
        rest = [([g for g in left if best not in g], n) for left, n in open_]
        open_ = [(left, n) for left, n in rest if len(left) / n >= CONFIRM]
    return chosen


def _windows(ws: Column) -> Column:
    step = WINDOW - OVERLAP
    at = F.sequence(F.lit(0), F.greatest(F.floor((F.size(ws) - OVERLAP - 1) / step), F.lit(0)))
    return F.transform(at, lambda i: F.slice(ws, (i * step + 1).cast("int"), WINDOW))


def windows(docs: DataFrame, found: list[str] | None = None) -> DataFrame:
    """id, paragraph and ws: windows of WINDOW words of every line, and of paragraphs of several lines across their ends.

    Paragraphs end at blank lines; sentences that deny a licence are taken out first. With `found` only windows that have one of these words are
    returned; documents without any are dropped before they are taken apart.
    """
    any_of = (lambda ws: F.arrays_overlap(ws, F.array(*map(F.lit, found)))) if found else (lambda ws: F.lit(True))
    base = docs.where("text is not null").where(any_of(words(F.col("text")))).select("id", F.regexp_replace("text", DENIED, " ").alias("text"))
    paragraphs = base.select("id", F.posexplode(F.split("text", r"\n[\x20\t\r]*\n")).alias("paragraph", "text"))
    lines = F.split("text", "\n")
    whole = F.when(F.size(lines) > 1, F.concat(lines, F.array("text"))).otherwise(lines)
    pieces = paragraphs.select("id", "paragraph", F.explode(whole).alias("piece")).where("piece rlike '[a-zA-Z]'")
    cut = pieces.select("id", "paragraph", words(F.col("piece")).alias("ws")).where(any_of(F.col("ws"))).select("id", "paragraph", F.explode(_windows(F.col("ws"))).alias("ws"))
    return cut.where(any_of(F.col("ws")))


@cache
def vocabulary() -> tuple[str, ...]:
    """All words and word pairs of the templates: what confirms a window, and the classifier's features."""
    return tuple(dict.fromkeys(g for _, ws, _ in marked_templates(unnamed=True) for g in _grams(ws)))


def _vectors(df: DataFrame) -> DataFrame:
    """df (ws) with features: which words and pairs of the vocabulary a window has."""
    known = CountVectorizerModel.from_vocabulary(list(vocabulary()), inputCol="grams", outputCol="features").setBinary(True)
    return known.transform(df.withColumn("grams", grams(F.col("ws")))).drop("grams")


def _keys(ws: list[str]) -> list[str]:
    """The rarest words and pairs of a template, so many that every window with CONFIRM of them all has one."""
    rare = sorted(_grams(ws), key=lambda g: (all(w in COMMON for w in g.split()), " " not in g))
    return rare[: int(len(rare) * (1 - CONFIRM) + 1e-9) + 1]


def likeness(pieces: DataFrame, *by: str, unnamed: bool = False) -> DataFrame:
    """pieces (ws) with template family `known`, named and likeness, for each template that a window confirms.

    Templates with marks are looked up by one of them, and named is true; those without by their rarest
    words and pairs. Of the column `by`, if given, the family must be an element.
    unnamed: marks of the licences' paragraphs aren't asked for (what resembles a licence, whichever).
    """
    made = marked_templates(unnamed)
    if unnamed:
        made = [(family, ws, [] if MARKS.intersection(marks) else marks) for family, ws, marks in made]
    rows = [(family, ws, marks, marks[:1] or _keys(ws)) for family, ws, marks in made]
    known = pieces.sparkSession.createDataFrame(rows, "known string, tw array<string>, marks array<string>, keys array<string>")
    known = known.select("known", "marks", "keys", F.array_distinct(grams(F.col("tw"))).alias("tg"), F.explode("keys").alias("key"))
    own = pieces.withColumn("own", F.array_distinct(grams(F.col("ws")))).select("*", F.explode("own").alias("key"))
    near = own.join(F.broadcast(known), "key")  # a fixed list of templates
    if by:
        near = near.where(F.array_contains(by[0], F.col("known")))
    # of several keys that a window has, the first counts
    near = near.where(F.get(F.array_intersect("keys", "own"), F.lit(0)) == F.col("key")).where(F.size(F.array_except("marks", "own")) == 0)
    near = near.withColumn("likeness", F.size(F.array_intersect("own", "tg")) / F.size("tg")).where(F.col("likeness") >= CONFIRM)
    return near.withColumn("named", F.size("marks") > 0).drop("own", "tg", "marks", "keys", "key")


class LicenseModel:
    """The trained classifier and the probability of any licence from which a window is more than unknown."""

    def __init__(self, model: LogisticRegressionModel, threshold: float) -> None:
        self.model, self.threshold = model, threshold

    def predict(self, pieces: DataFrame) -> DataFrame:
        """pieces with probability (of any licence) and families: those with SHARE of it at least, none under the threshold."""
        scored = self.model.transform(_vectors(pieces)).withColumn("_p", vector_to_array("probability"))
        known = 1 - F.col("_p")[0]
        names = F.array(*map(F.lit, FAMILIES))
        likely = F.filter(F.transform(F.sequence(F.lit(1), F.lit(len(LICENCES))), lambda i: F.when(F.get("_p", i) >= SHARE * known, F.get(names, i))), lambda f: f.isNotNull())
        return scored.select(*pieces.columns, known.alias("probability"), F.when(known >= self.threshold, likely).otherwise(F.array().cast("array<string>")).alias("families"))


def examples(spark: SparkSession) -> DataFrame:
    """label and features of the fixed examples: templates alone and between frequent words; the words of the templates singly and the frequent words alone are unknown."""
    frequent = sorted(COMMON)
    around = [(way, frequent[way * 13 :] + frequent[: way * 13]) for way in range(8)]
    rows = [(float(FAMILIES.index(f)), ws) for f, ws, _ in marked_templates(unnamed=True)]
    notices = spark.createDataFrame(rows, "label double, tw array<string>")
    around = spark.createDataFrame(around, "way int, ow array<string>")
    part = lambda a, n: F.slice("ow", a, n)
    shapes = F.when(F.col("way") < 2, F.col("tw")).when(F.col("way") == 2, F.concat(part(1, 12), "tw")).when(F.col("way") == 3, F.concat(part(1, 30), "tw")).when(F.col("way") == 4, F.concat("tw", part(1, 24))).when(F.col("way") == 5, F.concat("tw", part(1, 40))).otherwise(F.concat(part(1, 16), "tw", part(17, 16)))
    mixed = notices.crossJoin(F.broadcast(around)).select("label", shapes.alias("ws"))
    single = notices.select(F.explode("tw").alias("w")).distinct().select(F.lit(0.0), F.array("w"))
    alone = around.select(F.lit(0.0), F.explode(F.array(part(1, 12), part(1, 24), part(1, 40))))
    return _vectors(mixed.union(single).union(alone)).select("label", "features")


def unknown_windows(pieces: DataFrame) -> DataFrame:
    """features, n and half of all windows of paragraphs that state no licence and resemble none of the templates.

    pieces: id, paragraph and ws. Lines of a wrapped notice that resemble nothing by themselves are
    left out with their paragraph. Windows with the same features are one row a half and n the number of
    documents that have them, so the fit sees all. Half is 0 or 1, by the document's id.
    """
    stated = pieces.where(F.array_join("ws", " ").rlike(STATED)).select("id", "paragraph")
    stated = materialize(likeness(pieces, unnamed=True).select("id", "paragraph").union(stated).distinct(), "license-stated")
    match = F.col("w.id").eqNullSafe(F.col("s.id")) & (F.col("w.paragraph") == F.col("s.paragraph"))
    each = _vectors(pieces).select("id", "paragraph", "features").alias("w").join(stated.alias("s"), match, "left_anti").select("id", "features").distinct()
    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).alias("half")
    return materialize(each.groupBy("features", half).agg(F.count("*").alias("n")), "license-unknown")


def _upper(scores: DataFrame) -> float:
    """The CALIBRATION quantile of probability, weighed by n, 0.5 at least.

    Exact, by counts in 1,024 bins of the range that is left, so that rows neither meet nor are sorted.
    """
    total = scores.agg(F.sum("n")).first()[0] or 0
    rank, low, high = int(total * (1 - CALIBRATION)) + 1, 0.5, 1.0
    while True:
        at = F.least(F.floor((F.col("probability") - low) / ((high - low) / 1024)), F.lit(1023))
        bins = scores.where(F.col("probability").between(low, high)).groupBy(at.alias("at")).agg(F.sum("n").alias("n"), F.min("probability").alias("low"), F.max("probability").alias("high"))
        for b in bins.orderBy(F.desc("at")).collect():
            if b.n >= rank:
                break
            rank -= b.n
        else:
            return 0.5
        if b.low == b.high:
            return b.low
        low, high = b.low, b.high


def fit(pieces: DataFrame) -> LicenseModel:
    """Fit on the templates, alone and between frequent words, against all unknown windows.

    pieces: id, paragraph and ws of the windows with one of the anchors(), the only ones that are ever
    scored. Those of paragraphs that resemble no template, licence words or not, are the unknown class. However many they are, they
    weigh UNKNOWN_WEIGHT together at most. The threshold is the CALIBRATION quantile of their
    probability of any licence, 0.5 at least: each half of the documents is scored by a model fitted on the other
    half, the model that is returned is fitted on all.
    """
    unknown = unknown_windows(pieces)
    fixed = materialize(examples(pieces.sparkSession).coalesce(1), "license-examples")  # a fixed list
    halves = {r.half: r for r in unknown.groupBy("half").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}

    def fitted(*chosen: int) -> LogisticRegressionModel:
        have = [halves[k] for k in chosen if k in halves]
        total, rows = sum(r.n for r in have), sum(r["rows"] for r in have)
        weighed = unknown.where(F.col("half").isin(*chosen)).select(F.lit(0.0).alias("label"), "features", (F.col("n") * min(1.0, UNKNOWN_WEIGHT / max(total, 1))).alias("weight"))
        table = fixed.withColumn("weight", F.lit(1.0)).union(weighed.coalesce(rows // FIT_ROWS + 1))
        return LogisticRegression(maxIter=60, regParam=0.002, family="multinomial", weightCol="weight").fit(table)

    known = (1 - vector_to_array("probability")[0]).alias("probability")
    held = [fitted(1 - k).transform(unknown.where(F.col("half") == k)).select(known, "n") for k in sorted(halves)]
    threshold = _upper(materialize(reduce(DataFrame.union, held), "license-held")) if held else 0.5
    return LicenseModel(fitted(0, 1), threshold)


def train(docs: DataFrame) -> LicenseModel:
    """fit() to all windows of docs: id, text."""
    return fit(materialize(windows(docs, anchors()), "license-windows"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, family, n_paragraphs, probability and likeness: the licences that each document states.

    Whole texts are classified in windows, line by line and, so that wrapped notices are seen
    whole, across the lines of a paragraph. A family counts if the classifier gives it SHARE of a
    window's probability of any licence, which is over the calibrated threshold, and if the window
    also has CONFIRM of the words and word pairs of one of its templates, and all of its marks.
    Of a window's families without marks only the likest counts (ties: the first by name).
    probability and likeness are the best of the document's confirmed windows. Paragraphs that say
    they are under a licence, but confirm none, count for the family "unknown"; its likeness is
    null. Sentences that deny a licence state none. Windows that can't be confirmed, as they have
    none of the anchors(), are dropped before they are scored: this changes no result.

    Null and empty texts, and texts without letters, state nothing and have no row. Ids are
    numbers; rows that share an id (or have none) are one document. No rows in, no rows out.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = materialize(windows(base, anchors()), "license-windows")
    scored = fit(pieces).predict(pieces).withColumn("stated", F.array_join("ws", " ").rlike(STATED))
    found = materialize(scored.where((F.size("families") > 0) | F.col("stated")), "license-found")
    discard(pieces)
    each = likeness(found.where("size(families) > 0"), "families").groupBy("id", "paragraph", "ws", "probability", "known").agg(F.max("likeness").alias("likeness"), F.max("named").alias("named"))
    unnamed = each.where("not named").groupBy("id", "paragraph", "ws").agg(F.min_by(F.struct("known", "probability", "likeness"), F.struct(-F.col("likeness"), "known")).alias("best"))
    columns = ["id", "paragraph", "known", "probability", "likeness"]
    near = materialize(each.where("named").select(*columns).union(unnamed.select("id", "paragraph", "best.*")), "license-near")
    match = F.col("s.id").eqNullSafe(F.col("n.id")) & (F.col("s.paragraph") == F.col("n.paragraph"))
    other = found.where("stated").alias("s").join(near.select("id", "paragraph").distinct().alias("n"), match, "left_anti")
    other = other.select("id", "paragraph", F.lit(UNKNOWN).alias("known"), "probability", F.lit(None).cast("double").alias("likeness"))
    return near.union(other).groupBy(F.col("id").alias("doc_id"), F.col("known").alias("family")).agg(F.countDistinct("paragraph").alias("n_paragraphs"), F.max("probability").alias("probability"), F.max("likeness").alias("likeness"))


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    """The licence families that every document states."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
