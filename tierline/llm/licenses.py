"""License texts in documents by diagonal voting, in DataFrame functions only.

Every run of k words of a document is hashed and joined to the same runs of the license templates. A hit at word `at` of the
document and word `from` of the template votes for the diagonal at - from; where a template stands in a document, its hits
share one diagonal, or neighbouring ones where words were put in or left out. Diagonals that lie within `slack` of one another
are merged to one span, which is confirmed by how much of its template its hits cover. A hit's words are compared before
it votes, so that equal hashes alone say nothing.

Texts are read once and never shuffled: one scan sends a row of facts for each document and one row for each hit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import durable, plain_names
from tierline.llm.exact_dedup import fold_case

#: Digits, letters a to z, and everything beyond ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that name a license, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Public license texts, notices and the lines that point to them, with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License."""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means."""),
)


def license_words(text: Column) -> Column:
    return F.regexp_extract_all(fold_case(F.coalesce(text, F.lit(""))), F.lit(LICENSE_WORD), F.lit(0))


def rolling(words: str, k: int) -> Column:
    """A hash of every run of k words of the array column words."""
    after = lambda i: [F.get(F.col(words), i + n) for n in range(k)]
    return F.when(F.size(words) >= k, F.transform(F.slice(words, F.lit(1), F.size(words) - (k - 1)), lambda _, i: F.xxhash64(*after(i)))).otherwise(F.array().cast("array<bigint>"))


def template_runs(spark, templates: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """(gram, template, label, from, spoken, of): a row for each run of k words of each template, which has `of` of them."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    rows = rows.select("template", "label", license_words(F.col("text")).alias("words")).withColumn("grams", rolling("words", k))
    runs = rows.select("template", "label", "words", F.size("grams").alias("of"), F.posexplode("grams").alias("from", "gram"))
    return runs.select("gram", "template", "label", "from", F.slice("words", F.col("from") + 1, k).alias("spoken"), "of")


def phrase_places(words: str, phrases: Sequence[tuple[str, str]]) -> Column:
    """An array of (at, label) of all places where a phrase's words stand consecutively. No phrase is the begin of another."""
    said = [(p.split(" "), label) for p, label in phrases]

    def place(word: Column, i: Column) -> Column:
        out = F.lit(None).cast("struct<at: int, label: string>")
        for parts, label in said:
            here = word == parts[0]
            for n, part in enumerate(parts[1:], 1):
                here = here & (F.get(F.col(words), i + n) == part)
            out = F.when(here, F.struct(i.cast("int").alias("at"), F.lit(label).alias("label"))).otherwise(out)
        return out

    some = F.lit(False)
    for last in sorted({parts[-1] for parts, _ in said}):  # most documents are done with this
        some = some | F.array_contains(words, last)
    found = F.filter(F.transform(words, place), lambda x: x.isNotNull())
    return F.when(some, found).otherwise(F.array().cast("array<struct<at: int, label: string>>"))


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, k: int = 4, slack: int = 5, least: float = 0.6) -> DataFrame:
    """One row for each row of docs: key, n_words, places (at, label), spans (label, start, end, share), score.

    places are those of the phrases, in their order in the text. spans are confirmed templates by their start: words from start
    to before end hold share of the template's runs of k words, `least` or more; score is the best share of any span, confirmed
    or not, 0 without hits. Templates of fewer than k words find nothing. A null text is empty; texts are read whole. Null
    keys, equal keys and equal rows are rows like others; an empty table gives an empty result; other columns of docs are not
    read, whatever their names. The templates' runs are broadcast: they are a parameter, and do not grow with docs.
    """
    rows, of = plain_names(docs, [key, text])
    runs = F.broadcast(template_runs(docs.sparkSession, templates, k))
    told = rows.select(F.col(of[key]).alias("key"), F.monotonically_increasing_id().alias("row"), license_words(F.col(of[text])).alias("words"))
    told = told.select("key", "row", "words", phrase_places("words", phrases).alias("places"), F.concat(F.array(F.lit(None).cast("bigint")), rolling("words", k)).alias("grams"))
    met = told.select("key", "row", "words", "places", F.posexplode("grams").alias("nth", "gram")).join(runs, "gram", "left")
    facts = F.col("nth") == 0  # the row of facts goes first
    hit = F.col("spoken") == F.slice("words", F.col("nth"), k)
    sent = met.where(facts | hit).select(
        "row", F.when(~facts, F.col("nth") - 1).alias("at"), "template", "label", "from", "of",
        F.when(facts, F.col("key")).alias("key"), F.when(facts, F.size("words")).alias("n_words"), F.when(facts, F.col("places")).alias("places"),
    )
    sent = durable(sent)
    by_diagonal = Window.partitionBy("row", "template").orderBy("diagonal")
    votes = sent.where("at IS NOT NULL").withColumn("diagonal", F.col("at") - F.col("from"))
    votes = votes.withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > slack).cast("int"))
    votes = votes.withColumn("span", F.sum(F.coalesce("new", F.lit(0))).over(by_diagonal))
    covered = votes.groupBy("row", "template", "span", "from").agg(F.first("label").alias("label"), F.first("of").alias("of"), F.min("at").alias("low"), F.max("at").alias("high"))
    spans = covered.groupBy("row", "template", "span").agg(F.first("label").alias("label"), F.min("low").alias("start"), (F.max("high") + k).alias("end"), (F.count("*") / F.first("of")).alias("share"))
    confirmed = F.when(F.col("share") >= least, F.struct("start", "end", "label", "share"))
    by_row = spans.groupBy("row").agg(F.max("share").alias("score"), F.sort_array(F.collect_list(confirmed)).alias("spans"))
    out = sent.where("at IS NULL").select("row", "key", "n_words", "places").join(by_row, "row", "left")
    empty = F.array().cast("array<struct<start: int, end: int, label: string, share: double>>")
    return out.select(F.col("key").alias(key), F.col("n_words").cast("long").alias("n_words"), "places", F.coalesce("spans", empty).alias("spans"), F.coalesce("score", F.lit(0.0)).alias("score"))


def label_columns() -> Mapping[str, Column]:
    """What a report tells of the result of scan_licenses: counts and first and last place of phrases, and the labels."""
    at = F.transform("places", lambda p: p["at"])
    labels = F.transform("places", lambda p: p["label"])
    told = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return {
        "n_base": F.size("places").cast("long"), "first_word": F.array_min(at).cast("long"), "last_word": F.array_max(at).cast("long"),
        "base_labels": told(labels), "labels": told(F.concat(labels, F.transform("spans", lambda s: s["label"]))),
    }
