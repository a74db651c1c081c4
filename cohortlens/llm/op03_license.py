"""License scan by diagonal voting over rolling word k-grams (DataFrame functions only).

All word pairs of every text are hashed and joined to the positions of the same
pairs in a fixed set of templates; a second, independent hash in the join verifies
each hit.  A hit of text position p and template position t votes for the diagonal
p - t.  Votes are counted by diagonal (each is a template position of its own), and
neighbouring diagonals are merged: those that one place can have, whose words may be
interrupted by some others and may lack a quarter of the template.  Most merged diagonals
have too few votes and end there; only the hits of the others are verified.

To verify, a place is a hit and the hits after it within the length of the
template and its slack.  It has as many votes as template positions can be put in order, each
once and at a later word, and counts if they cover enough of the template: so its words
are in the text, in the template's order.  For the base phrases all pairs must stand in a row.

The template table is fixed (a few thousand rows whatever the data), so it is broadcast
and texts are not shuffled; what is shuffled is diagonals, counted per task before.

Null and empty texts have no word; repeated rows are separate results; very long
texts are one array of words in a task; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.base import fold_ascii, table
from cohortlens.llm.registry import query

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed values of the contract: phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Paragraphs of public licences, and sentences of notices that point to them.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
               "You may obtain a copy of the License at"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
               "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
               "limitations under the License"),
    ("apache", "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
            "Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "GNU Lesser General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
             "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("agpl", "GNU Affero General Public License"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
             "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution"),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
              "software without specific prior written permission"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
            "You can obtain one at"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike"),
    ("cc-by-nd", "licensed under a Creative Commons Attribution-NoDerivatives"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising "
             "from the use of this software"),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
              "covered by this license"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
                  "for any purpose, commercial or non-commercial, and by any means"),
)
K = 2
SLACK = 3
COVERAGE = 0.75


def words(text: Column) -> Column:
    return F.array_remove(F.split(fold_ascii(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def _template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATOR, text.lower()) if w]


def template_grams(spark: SparkSession, templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> DataFrame:
    """template, label, base, need (votes), t (position), h, h2 of every pair of template words."""
    rows = []
    for number, (text, label, base) in enumerate([(p, lab, True) for p, lab in phrases] + [(t, lab, False) for lab, t in templates]):
        ws = _template_words(text)
        rows += [f"({number}, '{label}', {str(base).lower()}, {len(ws) - K + 1}, {t}, '{ws[t]}', '{ws[t + 1]}')" for t in range(len(ws) - K + 1)]
    grams = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS x(template, label, base, need, t, a, b)")
    return grams.select("template", "label", "base", "need", "t", F.xxhash64("a", "b").alias("h"), F.hash("a", "b").alias("h2"))


def scan(docs: DataFrame, templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    split = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    # A first element without a pair carries the number of words and keeps every row.
    pairs = F.zip_with("w", F.slice("w", 2, F.size("w")), lambda a, b: F.when(
        b.isNotNull(), F.struct(F.xxhash64(a, b).alias("h"), F.hash(a, b).alias("h2"))))
    count = F.array(F.struct(F.size("w").cast("long").alias("h"), F.lit(0).alias("h2")))
    rolling = split.select("doc_id", "row", F.posexplode(F.concat(count, pairs)).alias("p", "g")).select(
        "doc_id", "row", (F.col("p") - 1).alias("p"), F.col("g.h").alias("h"), F.col("g.h2").alias("h2"))
    hits = rolling.join(F.broadcast(template_grams(docs.sparkSession, templates, phrases).withColumnsRenamed({"h": "_h", "h2": "_h2"})),
                        (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2")) & (F.col("p") >= 0), "left")
    hits = hits.where("template is not null or p = -1").withColumn("n", F.when(F.col("p") == -1, F.col("h")))
    # A pair of words stands at so many positions of one template at most.
    repeats = max(Counter(zip(w, w[1:])).most_common(1)[0][1] for w in map(_template_words, [p for p, _ in phrases] + [t for _, t in templates]))
    of_template = ["row", "doc_id", "template", "label", "base", "need"]
    slack = F.when(F.col("base"), 0).otherwise(F.greatest(F.lit(SLACK), F.floor(F.col("need") / 10)))
    enough = F.when(F.col("base"), F.col("need")).otherwise(COVERAGE * F.col("need"))

    # Votes by diagonal; one position of the template has one place on it.
    diagonals = hits.groupBy(*of_template, (F.col("p") - F.col("t")).alias("d")).agg(
        F.max("n").alias("n"), F.count("template").alias("votes"), F.collect_list("p").alias("ps"))
    # Neighbours: a place lacks a quarter of the template at most and has its slack in other words.
    reach = F.when(F.col("base"), 0).otherwise(slack + F.ceil((1 - COVERAGE) * F.col("need")))
    in_order = Window.partitionBy("row", "template").orderBy("d")
    apart = F.coalesce(F.col("d") - F.lag("d").over(in_order) > reach, F.lit(True))
    numbered = diagonals.withColumn("apart", apart.cast("int")).withColumn("group", F.sum("apart").over(in_order))
    place = F.transform("ps", lambda p: F.struct(p.alias("p"), (F.col("d") - p).alias("u")))
    merged = numbered.groupBy(*of_template, "group").agg(
        F.max("n").alias("n"), F.sum("votes").alias("total"), F.max("votes").alias("most"), F.sort_array(F.flatten(F.collect_list(place))).alias("at"))
    # Too few votes on all of them: no place can be there, and the best diagonal is the score.
    found = merged.withColumn("at", F.when(F.col("total") >= enough, F.col("at")).otherwise(F.slice("at", 1, 0)))
    extent = F.col("need") - 1 + slack

    def votes(x: Column, i: Column) -> Column:
        """Most template positions in order, from hit ``x`` on and within the extent, each at a later word."""
        after = F.filter(F.slice("at", i + 2, repeats * (extent + 1)), lambda y: (y["p"] > x["p"]) & (y["p"] <= x["p"] + extent) & (y["u"] < x["u"]))
        longer = lambda best, y: F.transform(best, lambda v, t: F.when(
            t == -y["u"], F.greatest(v, F.array_max(F.slice(best, 1, t)) + 1)).otherwise(v))
        return F.aggregate(after, F.array_repeat(F.lit(0), F.col("need")), longer, F.array_max) + 1

    spans = found.withColumn("spans", F.transform("at", lambda x, i: F.struct(
        x["p"].alias("p"), (x["p"] + x["u"]).alias("start"), votes(x, i).alias("votes"))))
    spans = spans.withColumn("good", F.filter("spans", lambda x: x["votes"] >= enough)).withColumn(
        "cover", F.greatest(F.array_max(F.transform("spans", lambda x: x["votes"] / F.col("need"))), F.least(F.lit(1.0), F.col("most") / F.col("need"))))
    # Later hits of one place have about the same start.
    separate = F.filter("good", lambda x, i: (i == 0) | (F.abs(x["start"] - F.element_at("good", F.greatest(i, F.lit(1)))["start"]) > slack))
    base = F.coalesce(F.col("base"), F.lit(False)) & (F.size("good") > 0)
    valid = F.size("good") > 0
    joined = lambda flag: F.array_join(F.array_sort(F.collect_set(F.when(flag, F.col("label")))), ",")
    starts = F.transform("good", lambda x: x["start"])
    listed = F.transform(separate, lambda x: F.struct(x["start"].alias("start"), F.col("label").alias("label"), F.col("need").alias("need")))
    return spans.groupBy("row", "doc_id").agg(
        F.max("n").alias("n_words"), F.sum(F.when(base, F.size("good")).otherwise(0)).alias("n_base"),
        F.min(F.when(base, F.array_min(starts))).cast("long").alias("first_word"), F.max(F.when(base, F.array_max(starts))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(valid).alias("labels"),
        F.coalesce(F.max(F.when(base, F.lit(1.0)).when(~F.coalesce(F.col("base"), F.lit(True)), F.col("cover"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.flatten(F.collect_list(F.when(valid, listed)))).alias("spans"),
    ).drop("row")


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")
