"""License scan by canonical digest: DataFrame functions only.

A text is brought to a canonical form (lower case, copyright lines removed, equivalent spellings, punctuation and white
space as single spaces) and its whole form is looked up by digest among the known licenses.  A license or notice inside
a longer text is not reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings that mean the same, as whole words after lower-casing.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright holder", "copyright owner"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"),
    ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("licencing", "licensing"),
    ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilfull", "wilful"), ("per cent", "percent"),
    ("copyright owners", "copyright holders"), ("noncommercial", "non commercial"),
]


class Licenses(dict):
    """Texts by SPDX id (or name of a notice).  `items` gives each license once per form in which it is published."""

    def items(self) -> list[tuple[str, str]]:
        return [(name, form) for name, text in super().items() for form in dict.fromkeys(forms(name, text))]


def forms(name: str, text: str) -> Iterator[str]:
    """The text with and without a title, list numbers, appendix and filled-in owner, and with either kind of link."""
    bodies = [text]
    if name.startswith("BSD-"):
        bodies.append(re.sub(r"(?m)^ *[0-9]\. ", "* ", text))
    if name == "ISC":
        bodies.append(text.replace("and/or distribute", "and distribute"))
    if END in text:
        head = text[:text.index(END)]
        bodies += [head, head + END]
    bodies += [b.replace(OWNER, "Copyright 2000 owner") for b in bodies if OWNER in b]
    bodies += [b.replace("http:", "https:") for b in bodies] + [b.replace("https:", "http:") for b in bodies]
    for body in bodies:
        yield body
        yield from (f"{title}\n\n{body}" for title in TITLES.get(name, ()))


# Titles above license texts that are also published without one, the end of a license that an appendix
# follows, and a line that the appendix leaves to be filled in.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License", "The ISC License"],
          "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
          "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
          "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'],
          "Zlib": ["zlib License", "The zlib License"], "Unlicense": ["The Unlicense"]}
END = "END OF TERMS AND CONDITIONS"
OWNER = "Copyright [yyyy] [name of copyright owner]"
# Short licenses and license notices, as published; longer ones are files named by SPDX id.
KNOWN = Licenses({
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
} | {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))})
# A line that names a year or mark of copyright; a wrapped sentence that begins with the word is no such line.
COPYRIGHT_LINE = (r"(?m)^[^\p{L}\p{N}\n©]*(copyright[ \t]+(\(c\)|©|[0-9]{4})|©|\(c\)[ \t]+[0-9]{4}"
                  r"|all rights reserved[^\p{L}\p{N}\n]*$)[^\n]*$")
NOT_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form of a text; empty for NULL."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " ")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, NOT_WORD, " ")), F.lit(" "))
    for spelling, usual in SPELLINGS:
        # a shared space would hide a repeated word from one pass
        for _ in range(2):
            out = F.replace(out, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license, text): every form of the licenses of this module."""
    return spark.createDataFrame(KNOWN.items(), "license string, text string")


def scan(df: DataFrame, licenses: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, digest, license) of every row: the license whose whole canonical text is the row's, else NULL.

    `licenses` is (license, text); licenses with one canonical text give the first name.  A text without words has a
    digest and no license.  Equal texts are looked up once each, map-side; rows are not moved if the list is small
    enough for Spark to send it, and Spark splits a frequent digest otherwise.  Other columns are not read.
    """
    known = (licenses.where(canonical(F.col("text")) != "").groupBy(digest(F.col("text")).alias("digest"))
             .agg(F.min("license").alias("license")))
    rows = df.select(F.col(key).alias(key), digest(F.col(text)).alias("digest"))
    return rows.join(known, "digest", "left").select(key, "digest", "license")
