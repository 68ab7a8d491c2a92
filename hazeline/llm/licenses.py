"""License scans by diagonal voting, in DataFrame operations only.

All rolling word k-grams of a document are hashed and joined to the k-grams of a
small set of notice templates. A match at document word i and template word j votes
for the diagonal i - j; diagonals at most ``GAP`` apart (a word put in or left out)
are merged, and a merged span counts when its verified k-grams cover enough of the
template. Verification compares the words themselves, not their hashes.

Beside the templates' labels there are base phrases, found wherever their words stand
one after another. Null texts count as empty. Rows without doc_id, repeated rows and
ties give one output row each: documents are told apart by id and text, and equal
documents have equal results. Extra columns are not read. A text of any length is read in
full, in time linear in its words; a table without rows gives one without rows.

Lowering uses Unicode rules, which turn no other character into a letter of a base
phrase, and neither join nor split words.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

K, GAP, COVER = 3, 2, 0.7
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
#: (label, notice): sentences that stand for a license, and the whole body of the short ones.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY),
    ("bsd-2-clause", _BSD + " " + _BSD_END),
    ("bsd-3-clause", _BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_END),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
MOST_TEMPLATE_WORDS = 20_000  #: templates of more words are joined by a shuffle, not broadcast


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def grams(w: Column, k: int) -> Column:
    """at, hash and words of the k-gram at every word."""
    at = F.sequence(F.lit(0), F.size(w) - k)
    each = F.transform(at, lambda i: F.struct(i.alias("at"), F.xxhash64(*[F.get(w, i + j) for j in range(k)]).alias("hash"), F.array(*[F.get(w, i + j) for j in range(k)]).alias("gram")))
    return F.when(F.size(w) >= k, each).otherwise(F.array().cast("array<struct<at:int,hash:bigint,gram:array<string>>>"))


def template_grams(spark, templates=None, k: int = K) -> DataFrame:
    """template, label, n_grams, at, gram and hash of every k-gram of the templates; to be broadcast where they are few."""
    templates = TEMPLATES if templates is None else templates
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, body string")
    rows = rows.withColumn("w", words(F.col("body"))).withColumn("n_grams", F.size("w") - k + 1)
    rows = rows.select("template", "label", "n_grams", F.explode(grams(F.col("w"), k)).alias("g")).select("template", "label", "n_grams", "g.*")
    return F.broadcast(rows) if sum(len(t.split()) for _, t in templates) <= MOST_TEMPLATE_WORDS else rows


def identity(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), words(F.col("text")).alias("w"), F.lower(F.coalesce("text", F.lit(""))).alias("_low"))


def votes(docs: DataFrame, templates=None, k: int = K) -> DataFrame:
    """doc_id, _text, template, label, n_grams, diagonal, at, pos: all verified matches.

    Only a k-gram's own words go along with it, so a text of n words makes n small rows.
    """
    known = template_grams(docs.sparkSession, templates, k)
    each = identity(docs).select("doc_id", "_text", F.explode(grams(F.col("w"), k)).alias("g")).select("doc_id", "_text", F.col("g.at").alias("pos"), F.col("g.hash").alias("hash"), F.col("g.gram").alias("own"))
    return each.join(known, "hash").where("own = gram").select("doc_id", "_text", "template", "label", "n_grams", (F.col("pos") - F.col("at")).alias("diagonal"), "at", "pos")


def spans(docs: DataFrame, templates=None, k: int = K, gap: int = GAP, cover: float = COVER) -> DataFrame:
    """doc_id, _text, template, label, first_word, last_word, coverage of each verified span."""
    by_diagonal = votes(docs, templates, k).groupBy("doc_id", "_text", "template", "label", "n_grams", "diagonal").agg(F.collect_set("at").alias("ats"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    side = Window.partitionBy("doc_id", "_text", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(side) > gap, F.lit(True)).cast("int")
    merged = by_diagonal.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(side))
    found = merged.groupBy("doc_id", "_text", "template", "label", "n_grams", "island").agg(F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("hit"), F.min("low").alias("first_word"), (F.max("high") + k - 1).alias("last_word"))
    return found.withColumn("coverage", F.col("hit") / F.col("n_grams")).where(F.col("coverage") >= cover).select("doc_id", "_text", "template", "label", "first_word", "last_word", "coverage")


def _stands(w: Column, parts: list[str]):
    """Whether ``parts`` stand at a position of ``w``."""

    def at(i: Column) -> Column:
        ok = F.get(w, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            ok = ok & (F.get(w, i + j) == part)
        return ok

    return at


def base(docs: DataFrame, phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, _text, n_words and, of the base phrases, n_base, first_word, last_word, found (labels)."""
    rows = identity(docs)
    w, columns, names = F.col("w"), {}, []
    for n, (phrase, label) in enumerate((phrases or PHRASES).items()):
        parts = phrase.split()
        rare = max(parts, key=len)

        where = F.when(F.contains("_low", F.lit(rare)) & (F.size(w) >= len(parts)), F.filter(F.sequence(F.lit(0), F.size(w) - 1), _stands(w, parts))).otherwise(F.array().cast("array<int>"))
        columns[f"_at{n}"] = where
        names.append((f"_at{n}", label))
    rows = rows.withColumns(columns)
    places = F.concat(*[F.col(c) for c, _ in names])
    labels = F.filter(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label in names]), lambda x: x.isNotNull())
    return rows.select("doc_id", "_text", F.size("w").cast("long").alias("n_words"), F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"), F.array_sort(F.array_distinct(labels)).alias("found"))


def scan(docs: DataFrame, templates=None) -> DataFrame:
    """One row a document: the base columns, labels of both kinds, and a score."""
    own = spans(docs, templates).groupBy("doc_id", "_text").agg(F.collect_set("label").alias("more"), F.max("coverage").alias("best"))
    left, right = base(docs).alias("b"), own.alias("s")
    # a third of all rows may be one text: its id still tells rows apart
    both = left.join(right, F.col("b.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("b._text") == F.col("s._text")), "left")
    every = F.array_sort(F.array_distinct(F.concat("found", F.coalesce("more", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return both.select("b.doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("found", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"))


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def sql(templates=None, phrases: dict[str, str] | None = None, k: int = K, gap: int = GAP, cover: float = COVER) -> str:
    """The scan in DuckDB's SQL: k-grams as texts, so nothing is hashed."""
    split = [(i, label, [w for w in re.split(NOT_WORD, body.lower()) if w]) for i, (label, body) in enumerate(templates or TEMPLATES)]
    grams_ = ", ".join(f"({i}, '{label}', {len(w) - k + 1}, {j}, '{' '.join(w[j : j + k])}')" for i, label, w in split for j in range(len(w) - k + 1))
    places, labels = [], []
    for phrase, label in (phrases or PHRASES).items():
        stands = " AND ".join(f"w[i + {j + 1}] = '{part}'" for j, part in enumerate(phrase.split()))
        places.append(f"list_filter(range(len(w)), lambda i: {stands})")
        labels.append(f"CASE WHEN len({places[-1]}) > 0 THEN ['{label}'] ELSE [] END")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{NOT_WORD}'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT rid, doc_id, len(w) AS n_words, {' || '.join(places)} AS places, {' || '.join(labels)} AS found FROM d),
t(template, label, n_grams, j, gram) AS (VALUES {grams_}),
g AS (SELECT rid, i, array_to_string(w[i + 1 : i + {k}], ' ') AS gram FROM (SELECT rid, w, unnest(range(len(w) - {k - 1})) AS i FROM d WHERE len(w) >= {k})),
v AS (SELECT DISTINCT rid, template, label, n_grams, i - j AS diagonal, j FROM g JOIN t USING (gram)),
s AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) AS step FROM (SELECT rid, template, label, n_grams, diagonal, list(j) AS js FROM v GROUP BY ALL)),
m AS (SELECT *, sum(CASE WHEN step IS NULL OR step > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY rid, template ORDER BY diagonal) AS island FROM s),
c AS (SELECT rid, label, len(list_distinct(flatten(list(js)))) / n_grams::DOUBLE AS coverage FROM m GROUP BY rid, template, label, n_grams, island),
x AS (SELECT rid, list(DISTINCT label) AS more, max(coverage) AS best FROM c WHERE coverage >= {cover} GROUP BY rid)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word, array_to_string(list_sort(list_distinct(found)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(found || coalesce(more, []))), ',') AS labels, CASE WHEN len(places) > 0 THEN 1.0e0 ELSE coalesce(best, 0) END AS score
FROM b LEFT JOIN x USING (rid)
"""
