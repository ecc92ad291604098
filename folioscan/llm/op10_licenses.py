"""Operator 10: licence scans, in DataFrame functions only.

Two kinds of templates: notices (a header, a title, a sentence that licenses), and whole licence texts. Texts and templates are sparse TF-IDF vectors.
Every window of tokens as long as a notice is held against it by cosine, whatever stands before or after it, on the same line or not; every file
as a whole is held against the whole texts. A whole text that a file is says more than a notice in it; of several notices the best counts,
then the longest, then the first by name. A file that is a licence text itself also licenses its directory, and a file without
a licence of its own takes that of the nearest ancestor directory, by joins on exploded paths.

No keywords gate the comparison. A vector reaches a cosine only if the tokens that it shares with a template have that cosine's
square of the template's squared weights; so it has one of the template's heaviest tokens, those that leave less than this to the others. Places without any of
these are passed over without loss, and so are surroundings whose shared tokens weigh too little. Equal surroundings are compared once. The templates
are a constant of this module, so what is broadcast has a fixed size, and idf is that of the templates, so that a score depends on its text alone.

Defined results: null and empty texts have no licence of their own; of the licence files of one
directory the first path wins; rows that repeat a path each get the path's licence, the best of their texts; a null path inherits nothing;
an empty table gives an empty table; columns that are not asked for are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import stage, table

NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "Apache License Version 2.0, January 2004", "Apache License, Version 2.0", "Apache License 2.0"),
    "MIT": ("Released under the MIT License", "The MIT License (MIT)", "MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "ISC": ("Licensed under the ISC License", "ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "GPL-2.0": ("GNU General Public License version 2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "Licensed under the GNU General Public License, version 2", "Licensed under the GPL v2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3", "GNU General Public License version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "Licensed under the GPL v3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    "LGPL-2.1": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "GNU Lesser General Public License version 2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    "LGPL-3.0": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "Licensed under the GNU Lesser General Public License, version 3", "GNU Lesser General Public License version 3"),
    "AGPL-3.0": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "Licensed under the GNU Affero General Public License, version 3", "GNU Affero General Public License version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    "MPL-2.0": ("Licensed under the Mozilla Public License, version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"),
    "EPL-2.0": ("Licensed under the Eclipse Public License, version 2.0", "Eclipse Public License v 2.0"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License", "BSD 2-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License", "BSD 3-Clause License", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    "CC-BY-3.0": ("Licensed under CC BY 3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License"),
    "CC-BY-SA-3.0": ("Licensed under CC BY-SA 3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    "Unlicense": ("This is free and unencumbered software released into the public domain", "Released under the Unlicense"),
    "BSL-1.0": ("Boost Software License - Version 1.0", "Distributed under the Boost Software License, Version 1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    "Zlib": ("The zlib License", "Licensed under the zlib License"),
    "CC0-1.0": ("CC0 1.0 Universal public domain dedication", "To the extent possible under law, the author has waived all copyright to this work under CC0 1.0"),
}
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.
IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior
written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Whole licence texts. Longer licences are known by their titles and notices.
TEXTS = {
    "MIT": f"""MIT License. Copyright (c). Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. {_WARRANTY}""",
    "ISC": f"""ISC License. Copyright (c). Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}""",
    "0BSD": f"Zero-Clause BSD. Copyright (c). Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {_ISC_WARRANTY}",
    "BSD-2-Clause": f"BSD 2-Clause License. Copyright (c). All rights reserved. {_BSD} {_BSD_WARRANTY}",
    "BSD-3-Clause": f"BSD 3-Clause License. Copyright (c). All rights reserved. {_BSD} {_BSD_3} {_BSD_WARRANTY}",
    "Zlib": """zlib License. Copyright (c). This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the
use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,
an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as
being the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": f"""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software
dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. {_WARRANTY} For more
information, please refer to unlicense.org""",
}
NOTICES = {name: (*NOTICES.get(name, ()), f"SPDX-License-Identifier: {name}") for name in [*NOTICES, *(n for n in TEXTS if n not in NOTICES)]}
#: Least cosine with a template.
COSINE = 0.7
#: Share of a file's words in licence windows from which it is a licence text.
LICENSE_FILE = 0.5
TOKEN = "[0-9a-z]+"
#: Words that say nothing about a licence: no tokens.
STOP = "a an and any are as at be but by for from has in is it its of on or that the this to under with".split()


def tokens_of(text: str) -> list[str]:
    return [t for t in re.findall(TOKEN, text.lower()) if t not in STOP]


def _tokens() -> Column:
    return F.filter(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)), lambda t: ~t.isin(STOP))


class Templates:
    """Vectors of the templates: kind, licence, variant, counts of tokens, and idf over all of them."""

    def __init__(self, notices: dict[str, tuple[str, ...]] = NOTICES, texts: dict[str, str] = TEXTS):
        own = [("notice", name, k, text) for name, some in notices.items() for k, text in enumerate(some)] + [("text", name, 0, text) for name, text in texts.items()]
        self.counts = {(kind, name, k): Counter(tokens_of(text)) for kind, name, k, text in own}
        self.lengths = {of: c.total() for of, c in self.counts.items()}
        df = Counter(t for c in self.counts.values() for t in c)
        self.idf = {t: round(1 + math.log((1 + len(own)) / (1 + n)), 9) for t, n in df.items()}
        self.unknown = round(1 + math.log(1 + len(own)), 9)
        self.weights = {of: self._unit(c) for of, c in self.counts.items()}

    def _unit(self, c: Counter) -> dict[str, float]:
        norm = math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in c.items()))
        return {t: round(n * self.idf[t] / norm, 9) for t, n in sorted(c.items())}

    def needed(self, kind: str, cosine: float) -> list[str]:
        """Tokens of which a vector that reaches the cosine with some template of the kind has one: of each template the rarest, until the others weigh less than the square."""
        out: set[str] = set()
        for of, w in self.weights.items():
            if of[0] == kind:
                left = 1.0
                # Long words first: they are rare in other texts. Any order is without loss.
                for t in sorted(w, key=lambda t: (-min(len(t), 8) * self.idf[t], t)):
                    if left < cosine * cosine - 1e-6:
                        break
                    out.add(t)
                    left -= w[t] ** 2
        return sorted(out)


def _values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A table of literals: no Python data source."""
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else f"cast({v} AS double)" if isinstance(v, float) else str(v)
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(quoted, r)) + ')' for r in rows)} AS t({names})")


def _map(of: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for item in sorted(of.items()) for x in item])


def _cosines(rows: DataFrame, key: list[str], templates: Templates) -> DataFrame:
    """rows (key, license, length, x: tokens, weights) with the cosine of x and the template: (key, license, length, score)."""
    idf = _map(templates.idf)
    vector = F.transform("x", lambda t: F.struct(t.alias("t"), F.coalesce(F.try_element_at(idf, t), F.lit(templates.unknown)).alias("i"), F.coalesce(F.try_element_at("weights", t), F.lit(0.0)).alias("w")))
    own = rows.select(*key, "license", "length", vector.alias("v"))
    dot = F.aggregate("v", F.lit(0.0), lambda total, y: total + y.i * y.w)
    # The square of a token's count is its count, once for each place.
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, y: total + y.i * y.i * F.size(F.filter("v", lambda z: z.t == y.t))))
    return own.select(*key, "license", "length", F.round(dot / norm, 6).alias("score"))


def notices_in(spark: SparkSession, files: DataFrame, templates: Templates, cosine: float) -> DataFrame:
    """(path, license, score, license_words) of the files with a window that is a notice."""
    own = {of: w for of, w in templates.weights.items() if of[0] == "notice"}
    reach = max(templates.lengths[of] for of in own) - 1
    known = _values(spark, [(name, k, t, w) for (_, name, k), ws in own.items() for t, w in ws.items()], "license, variant, token, weight")
    table_ = _values(spark, [(name, k, templates.lengths["notice", name, k]) for _, name, k in own], "license, variant, length")
    shapes = table_.join(known.groupBy("license", "variant").agg(F.map_from_entries(F.collect_list(F.struct("token", "weight"))).alias("weights")), ["license", "variant"])
    # What stands around each needed word: `at` is the word's place in the text, `lead` that in its surroundings.
    anchors = templates.needed("notice", cosine)
    texts = files.select("path", _tokens().alias("t"))
    texts = texts.withColumn("at", F.array_compact(F.transform("t", lambda x, i: F.when(x.isin(anchors), i)))).filter(F.size("at") > 0)
    around = F.transform("at", lambda i: F.struct(i.alias("at"), F.least(i, F.lit(reach)).alias("lead"), F.array_join(F.slice("t", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1), " ").alias("own")))
    places = stage(spark, texts.select("path", F.explode(around).alias("a")).select("path", "a.*"), "licence_places")
    distinct = places.select("own", "lead").distinct()
    shared = distinct.select("own", "lead", F.explode(F.array_distinct(F.split("own", " "))).alias("token")).join(F.broadcast(known), "token")
    near = shared.groupBy("own", "lead", "license", "variant").agg(F.sum(F.col("weight") * F.col("weight")).alias("part")).filter(F.col("part") >= cosine * cosine - 1e-6)
    pairs = near.join(F.broadcast(shapes), ["license", "variant"]).withColumn("t", F.split("own", " "))
    first = F.greatest(F.col("lead") - F.col("length") + 1, F.lit(0))
    last = F.greatest(first, F.least(F.col("lead"), F.size("t") - F.col("length")))
    windows = pairs.select("own", "lead", "license", "length", "weights", F.explode(F.transform(F.sequence(first, last), lambda s: F.struct(s.alias("start"), F.slice("t", s + 1, F.col("length")).alias("x")))).alias("w")).select("own", "lead", "license", "length", "weights", "w.*").withColumn("words", F.size("x"))
    scored = _cosines(windows, ["own", "lead", "start", "words"], templates).filter(F.col("score") >= cosine)
    best = scored.groupBy("own", "lead").agg(F.min(F.struct((-F.col("score")).alias("s"), (-F.col("length")).alias("l"), "license", "start", "words")).alias("b"))
    found = places.join(best, ["own", "lead"]).select("path", "b.license", "b.s", "b.l", (F.col("at") - F.col("lead") + F.col("b.start")).alias("from"), "b.words")
    covered = found.select("path", "license", "s", "l", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("words") - 1)).alias("place"))
    by_place = covered.groupBy("path", "place").agg(F.min(F.struct("s", "l", "license")).alias("b"))
    return by_place.groupBy("path").agg(F.min("b").alias("b"), F.count("*").alias("license_words")).select("path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), "license_words")


def whole_texts(spark: SparkSession, files: DataFrame, templates: Templates, cosine: float) -> DataFrame:
    """(path, license, score, license_words) of the files that as a whole are a licence text."""
    own = {of: w for of, w in templates.weights.items() if of[0] == "text"}
    known = _values(spark, [(name, templates.lengths["text", name, 0], t, w) for (_, name, _), ws in own.items() for t, w in ws.items()], "license, length, token, weight")
    shapes = known.groupBy("license", "length").agg(F.map_from_entries(F.collect_list(F.struct("token", "weight"))).alias("weights"))
    needed = templates.needed("text", cosine)
    texts = files.select("path", _tokens().alias("x")).filter(F.exists("x", lambda t: t.isin(needed))).select("path", "x", F.array_distinct("x").alias("d"))
    shared = texts.select("path", "x", F.explode("d").alias("token")).join(F.broadcast(known), "token").groupBy("path", "x", "license").agg(F.sum(F.col("weight") * F.col("weight")).alias("part"))
    rows = shared.filter(F.col("part") >= cosine * cosine - 1e-6).join(F.broadcast(shapes), "license")
    counted = rows.select("path", "license", "length", "weights", F.size("x").alias("n"), F.explode("x").alias("t")).groupBy("path", "license", "length", "n", "t").agg(F.count("*").alias("k"), F.first("weights").alias("weights"))
    idf, w = F.coalesce(F.try_element_at(_map(templates.idf), F.col("t")), F.lit(templates.unknown)), F.coalesce(F.try_element_at("weights", F.col("t")), F.lit(0.0))
    score = F.round(F.sum(F.col("k") * F.col("i") * F.col("w")) / F.sqrt(F.sum(F.col("k") * F.col("k") * F.col("i") * F.col("i"))), 6)
    scored = counted.select("path", "license", "length", "n", "k", idf.alias("i"), w.alias("w")).groupBy("path", "license", "length", "n").agg(score.alias("score")).filter(F.col("score") >= cosine)
    best = scored.groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("s"), (-F.col("length")).alias("l"), "license", "n")).alias("b"))
    return best.select("path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), F.col("b.n").cast("long").alias("license_words"))


def own_licenses(spark: SparkSession, files: DataFrame, cosine: float = COSINE, templates: Templates | None = None) -> DataFrame:
    """(path, license, score, license_words) of the files with a licence of their own. files: path, text."""
    templates = templates or Templates()
    files = files.select("path", "text").filter("path is not null")
    found = whole_texts(spark, files, templates, cosine).withColumn("kind", F.lit(0)).unionByName(notices_in(spark, files, templates, cosine).withColumn("kind", F.lit(1)))
    return found.groupBy("path").agg(F.min_by(F.struct("license", "score", "license_words"), F.struct("kind", (-F.col("score")).alias("s"), "license")).alias("b")).select("path", "b.*")


def scan(spark: SparkSession, files: DataFrame, cosine: float = COSINE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(path, columns to keep, license, found, inherited_from, score) of files (path, text, and whether the name says it's a licence file)."""
    own = stage(spark, own_licenses(spark, files, cosine), "licences")
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    sized = files.select("path", F.coalesce("named", F.lit(False)).alias("named"), words.alias("n_words"), F.struct(F.lit(0).alias("_"), *keep).alias("row"))
    sized = sized.withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]*$", 1)).join(own, "path", "left")
    held = sized.filter(F.col("license").isNotNull() & (F.col("named") | (F.col("license_words") >= LICENSE_FILE * F.greatest("n_words", F.lit(1)))))
    by_dir = stage(spark, held.groupBy("dir").agg(F.min(F.struct("path", "license", "score")).alias("b")).select(F.col("dir").alias("at"), F.col("b.license").alias("up_license"), F.col("b.score").alias("up_score"), F.col("b.path").alias("up_path")), "licence_dirs")
    # Directories, not files, look for their nearest licensed ancestor.
    dirs = sized.select("dir").distinct()
    parts = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("at")))).alias("u")).select("dir", "u.depth", "u.at")
    nearest = ups.join(by_dir, "at").groupBy("dir").agg(F.max(F.struct("depth", "up_license", "up_score", "up_path")).alias("n")).select("dir", "n.*")
    out = sized.join(nearest, "dir", "left")
    return out.select(
        "path",
        *[F.col(f"row.{c}").alias(c) for c in keep],
        F.coalesce("license", "up_license").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("up_license").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(F.col("license").isNull(), F.col("up_path")).alias("inherited_from"),
        F.coalesce("score", "up_score").alias("score"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of its source: source / language / hundred / doc_id; a document that mostly is a licence text licenses its directory."""
    doc_id = F.col("doc_id").cast("long")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.floor(doc_id / 100).cast("string"), doc_id.cast("string"))
    titled = F.coalesce(F.split("text", "\n")[0].rlike("(?i)licen[cs]e|copyright|copying"), F.lit(False))
    files = table(spark, sf_dir, "documents").select(doc_id.alias("doc_id"), path.alias("path"), F.col("text").cast("string").alias("text"), titled.alias("named"))
    return scan(spark, files, keep=("doc_id",)).select("doc_id", "path", "license", "found", "inherited_from", "score")
