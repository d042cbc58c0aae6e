"""License notices in texts, with DataFrame functions only.

Texts are cut into overlapping windows of word shingles, sized after each template so that a copy
of it always lies wholly in one of them. MinHash bands of one row retrieve templates: a window
that holds the template has a Jaccard similarity of at least 0.47 with it, and misses all BANDS
bands with a probability below 0.53 ** BANDS (4 in 100,000). What the bands retrieve is verified by
the exact containment of the template's shingles.

A band of a window can only agree with a template's if the window holds the shingle that is the
template's minimum in that band. Shingles that are no template's minimum in any band are
therefore passed over before windows are built; this drops no candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.common import lower_ascii, text_of, without

SHINGLE = 5
BANDS = 16
CONTAINMENT = 0.8
#: Minima of all templates are constants of the plan.
MOST_MINIMA = 50_000
MARKS = ".,;:!?\"'()[]*#&%$"

# Wordings of public licences: one-line notices, then their usual variants, headers of
# files, and opening passages of full texts. After the slash: which wording of the licence it is;
# gpl/ without a version stands for the GNU licences together.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "reserved": "All rights reserved.",
    "apache-2.0/name": "Apache License 2.0",
    "apache-2.0/short": "Licensed under the Apache License 2.0",
    "apache-2.0/header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-2.0/warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0/text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "mit/licensed": "Licensed under the MIT License",
    "mit/project": "This project is licensed under the MIT License",
    "mit/terms": "under the terms of the MIT License",
    "mit/name": "The MIT License",
    "mit/rights": "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mit/notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc/licensed": "Licensed under the ISC License",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED",
    "bsd/licensed": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "bsd/conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-3-clause": "may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-3-clause/licensed": "Licensed under the BSD 3-Clause License",
    "bsd-2-clause/licensed": "Licensed under the BSD 2-Clause License",
    "gpl/header": "as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0/header": "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl/warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl/copy": "You should have received a copy of the GNU General Public License along with this program.",
    "gpl-3.0/licensed": "Licensed under the GNU General Public License v3.0",
    "gpl-2.0/licensed": "Licensed under the GNU General Public License v2.0",
    "gpl-3.0/text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "gpl-2.0/text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    "lgpl": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl/licensed": "Licensed under the GNU Lesser General Public License",
    "lgpl-3.0/text": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl-2.1/text": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "agpl-3.0": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "agpl-3.0/licensed": "Licensed under the GNU Affero General Public License",
    "agpl-3.0/text": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "mpl-2.0/copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mpl-2.0/licensed": "Licensed under the Mozilla Public License 2.0",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense/text": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "wtfpl": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "public-domain": "This work has been released into the public domain",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc0-1.0/name": "CC0 1.0 Universal",
    "cc-by-4.0/short": "Licensed under CC BY 4.0.",
    "cc-by-4.0/text": "Creative Commons Attribution 4.0 International Public License",
    "cc-by-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-sa-4.0/short": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-3.0": "available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    "cc-by-nd-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-4.0/long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nc-sa-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4.0/short": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0/short": "Licensed under CC BY-NC-ND 4.0.",
    "gfdl": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "artistic-2.0": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble This license establishes the terms under which a given free software Package may be copied",
    "eupl-1.2": "Licensed under the EUPL, Version 1.2",
}


def words(text: Column) -> Column:
    """Words in lower case without marks at hand; an empty array for no words."""
    plain = F.regexp_replace(F.translate(lower_ascii(text), MARKS, ""), r"[\x20\x09-\x0D]+", " ")
    return F.filter(F.split(F.trim(plain), " "), lambda w: w != "")


def shingle_hashes(words_column: str, k: int) -> Column:
    """Hash of the k words at each place; none where fewer are left."""
    own = F.col(words_column)
    places = F.when(F.size(own) >= k, F.sequence(F.lit(1), F.size(own) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(own, i + (j - 1)) for j in range(k)]))


def shingle_texts(words_column: Column, k: Column) -> Column:
    last = F.size(words_column) - k + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.array_join(F.slice(words_column, i, k), " "))


def minimum(hashes: Column, band: int) -> Column:
    return F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, F.lit(band))))


def minima(hashes: Column) -> Column:
    """The least value of the shingles under each band's hash."""
    return F.array(*[minimum(hashes, band) for band in range(BANDS)])


def leading(hashes: Column, band: int) -> Column:
    """The shingle that has the least value."""
    return F.array_min(F.transform(hashes, lambda x: F.struct(F.xxhash64(x, F.lit(band)).alias("v"), x.alias("x"))))["x"]


def arranged(templates: DataFrame) -> DataFrame:
    """template_id with its shingle size k, shingles, size, step and the minimum of each band.
    A template of fewer than five words is one shingle; one without words takes no part."""
    own = templates.select(F.col("template_id"), words(text_of()).alias("t_words")).filter(F.size("t_words") > 0)
    own = own.withColumn("k", F.least(F.lit(SHINGLE), F.size("t_words")))
    hashes = None
    for k in range(1, SHINGLE + 1):
        hashes = F.when(F.col("k") == k, shingle_hashes("t_words", k)) if hashes is None else hashes.when(F.col("k") == k, shingle_hashes("t_words", k))
    own = own.withColumn("t_hashes", F.array_distinct(hashes)).withColumn("t_shingles", F.array_distinct(shingle_texts(F.col("t_words"), F.col("k"))))
    own = own.withColumn("size", F.size("t_words") - F.col("k") + 1).withColumn("step", F.greatest(F.lit(1), F.floor(F.col("size") / 2)).cast("int"))
    return own.withColumn("t_minima", minima(F.col("t_hashes"))).withColumn("leads", F.array_distinct(F.array(*[leading(F.col("t_hashes"), band) for band in range(BANDS)]))).drop("t_words", "t_hashes")


def scan(docs: DataFrame, templates: DataFrame, doc_id: str = "doc_id", text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """A row per document and template found: doc_id, template_id, containment (of the best
    window), at_word (where the first such window starts, from 0), windows (that hold it).

    ``templates`` (template_id, text) are a bounded list: with more than MOST_MINIMA minima it is an
    error. Words are compared in lower case without punctuation. Null and empty texts hold nothing;
    rows that repeat an id are one document; ids may be null. Other columns are not read; an empty
    table on either side gives no rows."""
    spark = docs.sparkSession
    ready = arranged(without(templates, "k", "size", "step"))
    listed = ready.select("template_id", "k", "size", "step", "t_shingles", "t_minima", "leads").limit(MOST_MINIMA + 1).collect()
    leads: dict[int, set[int]] = {}
    for row in listed:
        leads.setdefault(row["k"], set()).update(row["leads"])
    if sum(map(len, leads.values())) > MOST_MINIMA:
        raise ValueError("too many templates for one scan")
    result = "template_id string, k int, size int, step int, t_shingles array<string>, t_minima array<long>, lead long"
    known = spark.createDataFrame(
        [(str(r["template_id"]), r["k"], r["size"], r["step"], r["t_shingles"], r["t_minima"], x) for r in listed for x in r["leads"]], result
    )
    base = docs.select(F.col(doc_id).alias("doc_id"), words(text_of(text)).alias("words"))
    found = None
    for k, minimal in sorted(leads.items()):
        hashed = base.withColumn("hashes", shingle_hashes("words", k))
        places = F.filter(F.transform("hashes", lambda x, i: F.when(x.isin(list(minimal)), i)), lambda i: i.isNotNull())
        # outer: an inferred filter below would work out words and hashes again for each place
        hit = hashed.withColumn("places", places).select("*", F.explode_outer("places").alias("place")).filter("place is not null")
        hit = hit.withColumn("lead", F.get("hashes", F.col("place")))
        met = hit.join(F.broadcast(known.filter(F.col("k") == k)), "lead")  # bounded by MOST_MINIMA
        span = F.col("size") + F.col("step") - 1
        first = F.greatest(F.lit(0), F.ceil((F.col("place") - span + 1) / F.col("step"))).cast("int")
        met = met.withColumn("window", F.explode(F.sequence(first, F.floor(F.col("place") / F.col("step")).cast("int"))))
        start = F.col("window") * F.col("step")
        own = F.slice("hashes", start + 1, span)
        agree = F.exists(F.zip_with(minima(own), F.col("t_minima"), lambda a, b: a == b), lambda x: x)
        own_words = F.slice("words", start + 1, span + F.lit(k - 1))
        shared = F.size(F.array_intersect(shingle_texts(own_words, F.lit(k)), F.col("t_shingles")))
        met = met.filter(agree).select("doc_id", "template_id", start.alias("start"), (shared / F.size("t_shingles")).alias("held"))
        met = met.filter(F.col("held") >= containment)
        found = met if found is None else found.unionByName(met)
    if found is None:
        return spark.createDataFrame([], docs.select(F.col(doc_id).alias("doc_id")).schema.add("template_id", "string").add("containment", "double").add("at_word", "long").add("windows", "long"))
    best = found.groupBy("doc_id", "template_id", "start").agg(F.max("held").alias("held"))
    return best.groupBy("doc_id", "template_id").agg(
        F.max("held").alias("containment"), F.min("start").cast("long").alias("at_word"), F.count("*").alias("windows")
    )


def standard(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(TEMPLATES.items()), "template_id string, text string")
