"""License scan: MinHash bands over overlapping text windows, verified by exact containment.

Templates are partitioned by size (distinct word shingles, classes by powers of two).
For the class with upper size u a document is seen through windows of 2u shingles that
start every u, so that whatever run a template may fill lies within one window.  Each
window and each template has ``BANDS`` MinHash values, one a band; a window that has a
band value in common with a template is verified: the template's shingles that it
holds, counted exactly.

Shingles that no template has are left out of the windows beforehand.  That changes no
containment and only raises the chance to collide.  A window that holds 0.8 of a
template of its class has a similarity of at least
0.8 (u/2) / (2u + 0.2 (u/2)) = 0.19 to it, so 64 bands miss it with a probability of at
most (1 - 0.19)^64, 1.4 in a million; with no other template in the window, where the
similarity is 0.8 or more, with 1e-45.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwise.llm.common import broadcast_checked, keyed_documents, land, plain_words, shingles

BANDS = 64

# Public license notices, the texts that are looked for.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so"),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "no-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "mit-notice-licensed": "Licensed under the MIT License.",
    "mit-notice-project": "This project is licensed under the MIT License.",
    "mit-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "isc-notice": "Licensed under the ISC License.",
    "bsd-conditions-1-2": (
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "bsd-condition-3": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "bsd-notice": "Licensed under the BSD License.",
    "bsd-2-clause-notice": "Licensed under the BSD 2-Clause License.",
    "bsd-3-clause-notice": "Licensed under the BSD 3-Clause License.",
    "apache-2.0-notice-spdx-name": "Licensed under the Apache License 2.0.",
    "apache-2.0-warranty": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License."),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "gpl-2.0-notice": "Licensed under the GNU General Public License, version 2.",
    "gpl-3.0-notice-licensed": "Licensed under the GNU General Public License v3.0.",
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."),
    "lgpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "lgpl-notice": "Licensed under the GNU Lesser General Public License.",
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "agpl-notice": "Licensed under the GNU Affero General Public License.",
    "mpl-2.0-notice": "Licensed under the Mozilla Public License 2.0.",
    "epl-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    "epl-1.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
    "cc0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work."),
    "cc0-1.0-short": "Licensed under CC0 1.0 Universal.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-short": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-nc-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-sa-3.0-short": "Licensed under CC BY-SA 3.0.",
}


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(TEMPLATES.items()), "license string, text string")


def _with_shingles(df: DataFrame, text: str, size: int) -> DataFrame:
    """``sh``: (h, g) of each shingle, two independent hashes that together identify it."""
    return (df.withColumn("words", plain_words(F.col(text)))
            .withColumn("words", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("sh", shingles("words", size, lambda run: F.struct(
                F.xxhash64(run).alias("h"), F.xxhash64(F.lit(7), run).alias("g")))).drop("words", text))


def _minima(of: str) -> list[Column]:
    return [F.min(F.xxhash64(F.col(of), F.lit(b))).alias(f"m{b}") for b in range(BANDS)]


def _bands() -> Column:
    return F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"m{b}").alias("value")) for b in range(BANDS)]))


def scan_licenses(docs: DataFrame, license_texts: DataFrame | None = None, threshold: float = 0.8, size: int = 5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, n_shingles, n_shared, first_word) of every template that a document holds.

    A template is held if one window has at least ``threshold`` of its shingles; the
    window with the most of them counts, the first of equals, and ``first_word`` is the
    number (from 0) of the word where its first matching shingle starts.
    ``license_texts`` has license and text, of a license any number of texts, of which the
    one counts that is held by most shingles; texts without words are left out, and a text of fewer than ``size`` words is found only where it is the whole document.
    Null, empty or wordless documents hold nothing.  Rows that repeat an id are told
    apart by their text, and a pair comes out once; null ids come out as null; other
    columns are left out.
    """
    texts = templates(docs.sparkSession) if license_texts is None else license_texts.select(
        license_texts["license"].cast("string").alias("license"), license_texts["text"].cast("string").alias("text"))
    known = _with_shingles(texts.where("license IS NOT NULL").distinct().withColumn("text_hash", F.xxhash64("text")), "text", size)
    known = known.withColumn("sh", F.array_distinct("sh"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("sh")))).cast("int")
    known = land(known.select("license", "text_hash", F.size("sh").alias("n_shingles"), upper.alias("span"),
                              F.explode_outer("sh").alias("sh")).select("*", "sh.h", "sh.g").drop("sh")
                 .where("h IS NOT NULL"), "license-shingles")
    spans = [r[0] for r in known.select("span").distinct().orderBy("span").collect()]  # at most one per power of two
    small = broadcast_checked(known)

    rows = _with_shingles(keyed_documents(docs, id_col, text_col), "text", size)
    # the outer form: the plain one adds a filter on the array's size, which would be pushed below the
    # projections and there work out all shingles once per shingle; the join leaves empty arrays out
    places = rows.select("doc_id", "th", F.posexplode_outer("sh").alias("pos", "sh")).select(
        "doc_id", "th", "pos", "sh.h", "sh.g")
    hits = land(places.join(broadcast_checked(known.select("h", "g").distinct()), ["h", "g"], "left_semi"), "license-hits")

    # every hit stands in two windows of each class
    both = F.explode(F.flatten(F.array(*[
        F.array(F.struct(F.lit(u).alias("span"), F.floor(F.col("pos") / u).cast("long").alias("win")),
                F.struct(F.lit(u).alias("span"), (F.floor(F.col("pos") / u) - 1).cast("long").alias("win")))
        for u in spans]))) if spans else F.explode(F.array().cast("array<struct<span:int,win:long>>"))
    windows = (hits.select("doc_id", "th", "pos", "h", "g", both.alias("w"))
               .select("doc_id", "th", "pos", "h", "g", "w.span", "w.win").where("win >= 0"))
    window = ["doc_id", "th", "span", "win"]
    of_windows = windows.groupBy(*window).agg(*_minima("h")).select(*window, _bands().alias("b")).select(*window, "b.*")
    of_known = known.groupBy("license", "text_hash", "span").agg(*_minima("h")).select(
        "license", "text_hash", "span", _bands().alias("b")).select("license", "text_hash", "span", "b.*")
    met = of_windows.join(broadcast_checked(of_known), ["span", "band", "value"]).select(*window, "license", "text_hash").distinct()

    # both sides grow with the documents and are always dealt out: Spark takes the windows to be as small as the
    # file of the hits that they are made of, and would collect them all on the driver for a broadcast
    met = met.withColumnsRenamed({"doc_id": "d", "th": "t", "span": "s", "win": "w"})
    same = (F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
            & (F.col("span") == F.col("s")) & (F.col("win") == F.col("w")))
    pairs = windows.hint("merge").join(met, same).drop("d", "t", "s", "w")
    shared = (pairs.join(small, ["license", "text_hash", "span", "h", "g"])
              .groupBy(*window, "license", "text_hash", "n_shingles")
              .agg(F.count_distinct("h", "g").alias("n_shared"), F.min("pos").alias("first_word"))
              .where(F.col("n_shared") >= F.ceil(F.round(F.col("n_shingles") * threshold, 9))))
    best = F.max(F.struct(F.col("n_shared").alias("n_shared"), (-F.col("first_word")).cast("long").alias("back"),
                          F.col("n_shingles").cast("long").alias("n_shingles"))).alias("best")
    return shared.groupBy("doc_id", "license").agg(best).select(
        "doc_id", "license", "best.n_shingles", "best.n_shared", (-F.col("best.back")).alias("first_word"))
