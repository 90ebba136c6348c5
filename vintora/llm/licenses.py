"""License scan by diagonal voting, with built-in functions only.

Every rolling word k-gram of a document is joined by hash to the places where license templates hold it. A hit
votes for the diagonal (document position minus template position). Diagonals a few words apart that follow
one another in the text are merged, since small edits shift them. A merged run's span is verified by the template
places it really holds, each counted once however often it was hit: they must cover enough of the template, within a
plausible length. A run on one diagonal that covers a whole template is an exact place.

Odd input: a null or wordless text gives a row without hits; repeated rows are scanned one by one; extra
columns aren't looked at. The templates are constants, so their table has a fixed size and is broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintora.llm.words import starts, words_of

K = 3
#: Share of a template's k-grams that a run must cover.
COVER = 0.6
#: Diagonals up to so many words apart, and hits up to so many words apart, belong to one run.
SHIFT, GAP = 4, 12

#: Base phrases and their labels; a phrase must stand whole.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Well-known license wording; parts count too.
TEMPLATES = {
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "released under the MIT License", "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"],
    "apache-2": ["Licensed under the Apache License, Version 2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at", "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis. See the License for the specific language governing permissions and limitations under the License"],
    "gpl-3": ["licensed under the GNU General Public License, version 3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "You should have received a copy of the GNU General Public License along with this program. If not, see www gnu org licenses"],
    "gpl-2": ["licensed under the GNU General Public License, version 2", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation"],
    "lgpl": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "mpl-2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla org MPL 2.0"],
    "cc-by": ["licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"],
    "cc-by-nc": ["licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"],
    "isc": ["Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted", "provided that the above copyright notice and this permission notice appear in all copies. The software is provided as is and the author disclaims all warranties with regard to this software"],
    "unlicense": ["This is free and unencumbered software released into the public domain", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non commercial, and by any means"],
    "agpl-3": ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "zlib": ["This software is provided as is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software"],
    "boost": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "Distributed under the Boost Software License, Version 1.0"],
    "epl-2": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
}


def template_positions(spark: SparkSession, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row for each k-gram of each phrase or template."""
    split = lambda s: re.findall(r"[0-9a-z\x80-\U0010ffff]+", s.lower())
    texts = [(split(p), label, True) for p, label in phrases.items()] + [(split(t), label, False) for label, ts in templates.items() for t in ts]
    rows = [(n, label, base, len(w), k, *w[k : k + K]) for n, (w, label, base) in enumerate(texts) for k in range(len(w) - K + 1)]
    grams = [f"g{j}" for j in range(K)]
    df = spark.createDataFrame(rows, f"template int, label string, base boolean, size int, place int, {', '.join(f'{g} string' for g in grams)}")
    return df.withColumn("gram_hash", F.xxhash64(*grams))


def scan(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row of docs."""
    split = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", words_of(F.col("text")).alias("words"))
    split = split.withColumn("n_words", F.size("words"))
    at = split.select("row_id", "doc_id", "n_words", "words", F.explode_outer(starts(F.col("n_words"), K)).alias("at"))
    word = lambda j: F.get("words", F.col("at") + j)
    at = at.withColumn("doc_hash", F.xxhash64(*(word(j) for j in range(K))))
    same = F.col("doc_hash") == F.col("gram_hash")
    for j in range(K):
        same &= word(j) == F.col(f"g{j}")
    hits = at.join(F.broadcast(positions), same, "left").select("row_id", "doc_id", "n_words", "at", "template", "label", "base", "size", "place", (F.col("at") - F.col("place")).alias("diagonal"))

    votes = hits.groupBy("row_id", "doc_id", "n_words", "template", "label", "base", "size", "diagonal").agg(F.count("template").alias("votes"), F.collect_list("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last"))  # a diagonal holds a place once
    # neighbouring diagonals of one template, in text order, are one run; base phrases stay apart
    order = Window.partitionBy("row_id", "doc_id", "template").orderBy("first", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > SHIFT) | (F.col("first") - F.lag("last").over(order) > GAP)
    runs = votes.withColumn("new_run", F.when(F.coalesce(apart, F.lit(True)) | F.col("base"), 1).otherwise(0)).withColumn("run", F.sum("new_run").over(order))
    found = runs.groupBy("row_id", "doc_id", "n_words", "template", "label", "base", "size", "run").agg(F.sum("votes").alias("votes"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"), F.min("diagonal").alias("diagonal"), F.min("first").alias("first"), (F.max("last") - F.min("first") + K).alias("span"))

    # of wordings that begin at one place, such as two versions of a license, the best covered is meant
    rivals = Window.partitionBy("row_id", "doc_id", "base", "first").orderBy(F.desc("covered"))
    found = found.withColumn("rival", F.rank().over(rivals))

    cover = F.least(F.lit(1.0), F.col("covered") / (F.col("size") - (K - 1)))
    exact = F.col("base") & (F.col("votes") == F.col("size") - (K - 1))
    near = ~F.col("base") & (F.col("rival") == 1) & (cover >= COVER) & (F.col("span") <= 1.5 * F.col("size") + 2)
    one = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    return found.groupBy("row_id", "doc_id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("diagonal"))).cast("long").alias("last_word"),
        one(exact).alias("base_labels"),
        one(exact | near).alias("labels"),
        F.coalesce(F.max(F.when(exact, 1.0).when(near, cover)), F.lit(0.0)).alias("score"),
    ).drop("row_id")
