"""Licence scan: canonical digests of texts and of their lines, joined with those of known licences.

Case, punctuation, spaces, copyright lines and equivalent spellings are normalised away, on both
sides alike; what is left is compared by digest. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.llm.common import LOWER, UPPER, ready

# Spellings that count as the same, after lowering
SPELLINGS = [
    ("©", "(c)"),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("acknowledgement", "acknowledgment"),
    ("authoris", "authoriz"),
    ("organis", "organiz"),
    ("modernis", "moderniz"),
    ("favour", "favor"),
    ("https://", "http://"),
]

# Notices and licence texts as their publishers word them
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
]

# Words that follow "copyright" in a sentence, not in a copyright line
SENTENCE = (
    "notice notices holder holders owner owners ownership license licenses statement statements law laws interest interests "
    "permission permissions disclaimer disclaimers treaty treaties claim claims protection management infringement act status "
    "information rights right term terms and or on in to of as for is are that which with under from shall may will can"
).split()


def _other_word(words: set[str], first: bool = True) -> str:
    """Pattern of a word that is none of ``words``; without look-ahead, which not every engine has."""
    heads = sorted({w[0] for w in words if w})
    others = "".join(c for c in "abcdefghijklmnopqrstuvwxyz0123456789" if c not in heads)
    parts = [h + _other_word({w[1:] for w in words if w[:1] == h}, False) for h in heads] + [f"[{others}][a-z0-9]*"]
    return "(?:" + "|".join(parts + [""] * (not first and "" not in words)) + ")"


# A copyright line: a year, (c), a placeholder or a name after "copyright"; a year, a placeholder or a few words after "(c)"
_COPYRIGHT = (
    r"(?m)^[^a-z0-9\n]*(?:copyright[^a-z0-9\n]*(?:[0-9]|\(c\)|[<\[{])[^\n]*|copyright[ \t:]+(?:[\x{80}-\x{10FFFF}][^\n]*|"
    + _other_word(set(SENTENCE)) + r"(?:[^a-z0-9\n][^\n]*)?)"
    r"|\(c\)[^a-z0-9\n]*(?:copyright|[0-9]|[<\[{])[^\n]*|\(c\)(?:[ \t]+[^ \t\n]+){1,4}[ \t]*)$"
)
_GAPS = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"


def canonical_lines(text: Column) -> Column:
    """The normalised lines that are not empty, in order; NULL counts as empty."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    for spelling, same in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(same))
    out = F.regexp_replace(F.regexp_replace(out, _COPYRIGHT, ""), _GAPS, " ")
    return F.filter(F.transform(F.split(out, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def known_licences(spark: SparkSession) -> DataFrame:
    """(licence, text) of the built-in list."""
    rows = [F.struct(F.lit(name).alias("licence"), F.lit(text).alias("text")) for name, text in KNOWN]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan_licences(docs: DataFrame, licences: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: its id, ``licence``, ``notices``, ``n_notices``.

    ``licence`` is the known licence that the whole text is equal to, after normalisation, or
    NULL; ``notices`` lists the licences whose whole text is one line of it, in order and
    joined by commas; ``n_notices`` counts those lines. ``licences``: columns licence and text;
    of licences with equal texts the first by name counts; those with NULL or no words are left
    out. NULL and empty texts match nothing. Rows with equal id and text have equal results.
    """
    ready(docs.sparkSession)
    known = (
        licences.withColumn("_lines", canonical_lines(F.col("text")))
        .filter("licence is not null and size(_lines) > 0")
        .groupBy(digest(F.array_join("_lines", " ")).alias("_digest"))
        .agg(F.min("licence").alias("_licence"))
    )
    rows = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_tie"), canonical_lines(F.col(text)).alias("_lines"))
    parts = F.concat(F.array(digest(F.array_join("_lines", " "))), F.transform("_lines", digest))  # the whole text, its lines
    units = rows.filter(F.size("_lines") > 0).select("_id", "_tie", F.posexplode(parts).alias("_at", "_digest"))
    matches = units.join(known, "_digest").select("_id", "_tie", "_at", "_licence").distinct()  # copies of a row count once
    line = F.col("_at") > 0
    per_text = matches.groupBy("_id", "_tie").agg(
        F.max(F.when(~line, F.col("_licence"))).alias("licence"),
        F.array_join(F.sort_array(F.collect_set(F.when(line, F.col("_licence")))), ",").alias("notices"),
        F.count(F.when(line, 1)).alias("n_notices"))
    base = docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_hash"))
    out = base.join(per_text, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie")), "left")
    return out.select(F.col("_doc").alias(doc_id), "licence", F.coalesce("notices", F.lit("")).alias("notices"),
                      F.coalesce("n_notices", F.lit(0)).alias("n_notices"))
