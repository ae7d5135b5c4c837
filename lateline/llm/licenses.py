"""Licence scan by canonical digests.

A text is brought into one canonical form (case, punctuation, copyright lines, equivalent spellings,
white space), and its SHA-256 is joined with the digests of known licence texts. The whole document is
looked up, and so is each of its lines, since a notice mostly is one line of a document.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.llm import license_texts
from lateline.sources.staging import stage

#: Licences by their SPDX names, and texts or notices that stand for them.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

#: Titles that copies of a licence begin with; without one the text itself begins.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "BSD 2-Clause \"Simplified\" License", "BSD License", "The BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "BSD 3-Clause \"New\" or \"Revised\" License", "BSD License", "The BSD License", "New BSD License"],
}


def _complete() -> list[tuple[str, str]]:
    """Complete texts: with and without titles, numbers, and parts that a copy fills in or leaves out."""
    third = license_texts.BSD[license_texts.BSD.index("3. Neither") : license_texts.BSD.index("THIS SOFTWARE")]
    short = [("MIT", KNOWN[3][1]), ("ISC", license_texts.ISC)]
    for name, numbered in (("BSD-3-Clause", license_texts.BSD), ("BSD-2-Clause", license_texts.BSD.replace(third, ""))):
        for text in (numbered, re.sub(r"(?m)^[123]\. ", "* ", numbered)):
            short += [(name, text), (name, text.replace("HOLDER OR", "HOLDERS OR"))]
    rows = [(name, f"{title}\n{rights}\n{text}") for name, text in short for title in ("", *TITLES[name]) for rights in ("", "All rights reserved.")]
    apache = license_texts.APACHE_2
    # A copy fills in the holder, and that line is dropped as one of a copyright.
    rows += [("Apache-2.0", apache), ("Apache-2.0", apache.replace("Copyright [yyyy] [name of copyright owner]", ""))]
    rows += [("GPL-2.0", license_texts.GPL_2), ("GPL-3.0", license_texts.GPL_3), ("MPL-2.0", license_texts.MPL_2), ("CC0-1.0", license_texts.CC0)]
    # Spellings of two words are told within a line: as published, and with a line for each paragraph.
    for name, text in rows[-6:]:
        paragraphs = re.split(r"\n\s*\n", text)
        rows.append((name, "\n\n".join(p if re.search(r"(?i)copyright \(c\)", p) else " ".join(p.split()) for p in paragraphs)))
    # The directions after the terms are often left out.
    ends = [(name, text, text.find(END)) for name, text in rows[-12:]]
    return rows + [(name, text[:at] + end) for name, text, at in ends if at > 0 for end in ("", END)]


END = "END OF TERMS AND CONDITIONS"
KNOWN += _complete()

#: Spellings that count as one, as words of the canonical form.
SPELLINGS = [("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("v", "version"), ("copyright owner", "copyright holder")]

#: Lines that name a holder and years; they differ between copies of one licence.
COPYRIGHT_LINE = r"(?m)^[^A-Za-z0-9\n]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*$"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, words parted by one blank, lines kept, one spelling of each."""
    text = F.lower(F.coalesce(text, F.lit("")))
    text = F.regexp_replace(text, COPYRIGHT_LINE, "")
    text = F.regexp_replace(text, r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F ‐-‟]+", " ")
    for word, standard in SPELLINGS:
        text = F.regexp_replace(text, rf"\b{word}\b", standard)
    return text


def _trimmed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


def digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """license_id and digest of each known text."""
    rows = spark.createDataFrame(known, "license_id string, text string")
    digest = F.sha2(_trimmed(canonical(F.col("text"))), 256)
    return rows.select(digest.alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, text_digest, license_id, notices.

    license_id is the licence whose text the whole document is, else null; notices are the licences
    that a line of it states, sorted and joined by commas, null if there are none. Null counts as
    empty text. Every row is looked up by itself, also without a doc_id or with one that others have. Other
    columns are not read. An empty table gives an empty result.
    ``known`` has digest and license_id, from ``digests``; Spark decides how to join it.

    Texts are brought into their canonical form once: what is staged is a number of the row, its digest, and those
    of its different lines.
    """
    texts = docs.select("doc_id", canonical(F.col("text").cast("string")).alias("text"))
    lines = F.array_distinct(F.transform(F.split("text", "\n"), lambda line: F.sha2(F.trim(line), 256)))
    found = texts.select("doc_id", F.sha2(_trimmed(F.col("text")), 256).alias("text_digest"), lines.alias("lines"))
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "license-digests")
    stated = found.select("row", F.explode("lines").alias("digest")).join(known, "digest")
    notices = stated.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    whole = found.drop("lines").join(known.withColumnRenamed("digest", "text_digest"), "text_digest", "left")
    return whole.join(notices, "row", "left").select("doc_id", "text_digest", "license_id", "notices")
