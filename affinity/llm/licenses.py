"""Licence scan by canonical digests.

Texts are normalised (case, punctuation, white space, copyright lines, equivalent
spellings) and their digests are joined with those of known licence texts. Whole texts are
looked up, and each line by itself, since notices often stand as one line of a document.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licence matching treats as the same word.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("noncommercial", "non commercial"), ("copyright owner", "copyright holder"),
    ("analogue", "analog"), ("favour", "favor"), ("judgement", "judgment"),
    ("labour", "labor"), ("organisation", "organization"), ("programme", "program"),
    ("per cent", "percent"), ("wilful", "willful"), ("fulfil", "fulfill"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

# Licence texts and notices (name, class, text).
KNOWN = (
    ("MIT", "permissive", "MIT License\n\n" + _MIT),
    ("MIT", "permissive", _MIT),
    ("ISC", "permissive", "ISC License\n\n" + _ISC),
    ("ISC", "permissive", _ISC),
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", "Licensed under the MIT License."),
    ("MIT", "permissive", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "permissive", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "permissive", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "copyleft", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "copyleft", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-4.0", "attribution", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "share-alike", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "non-commercial", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "public-domain", "Released under CC0 1.0."),
)

# Whole licence texts: (name, class, file under license_texts, headings it also stands under,
# the line after which a copy may end).
_END = "END OF TERMS AND CONDITIONS"
TEXTS = (
    ("Apache-2.0", "permissive", "Apache-2.0.txt", (), _END),
    ("BSD-2-Clause", "permissive", "BSD-2-Clause.txt", ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"), None),
    ("BSD-3-Clause", "permissive", "BSD-3-Clause.txt", ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"), None),
    ("BSD-3-Clause", "permissive", "BSD-3-Clause-Regents.txt", ("BSD 3-Clause License",), None),
    ("BSL-1.0", "permissive", "BSL-1.0.txt", (), None),
    ("GPL-2.0", "copyleft", "GPL-2.txt", (), _END),
    ("GPL-3.0", "copyleft", "GPL-3.txt", (), _END),
    ("LGPL-2.1", "copyleft", "LGPL-2.1.txt", (), _END),
    ("LGPL-3.0", "copyleft", "LGPL-3.txt", (), None),
    ("MPL-2.0", "copyleft", "MPL-2.0.txt", (), None),
    ("CC0-1.0", "public-domain", "CC0-1.0.txt", (), None),
    ("Unlicense", "public-domain", "Unlicense.txt", ("The Unlicense", "UNLICENSE"), None),
)
_HEADINGS = {"MIT": ("The MIT License (MIT)", "The MIT License", "MIT License (MIT)"), "ISC": ("The ISC License", "ISC License (ISC)")}

# The oracle SQL takes out these lines only; all of them are also in COPYRIGHT below, up to a notice.
COPYRIGHT_LINE = r"(?im)^[^\p{L}\p{N}\n]*(copyright\b|\(c\)|©)[^\n]*[0-9]{4}[^\n]*$"

# Lines of a copyright (with its sign, a year or a holder; not the sentences of a licence that
# start a line with "copyright holder", "copyright license" and the like), up to a licence
# notice on the same line.
COPYRIGHT = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:(?i:copyright)\s*(?:\((?i:c)\)|©)|©|(?i:copyright\b|\(c\))(?=[^\n]*[0-9]{4})"
    r"|(?:Copyright|COPYRIGHT)[ \t]+(?!(?i:holders?|owners?|notices?|licen[sc]es?|laws?|treat(?:y|ies)|and|or|interests?"
    r"|disclaimer|statements?|protection|infringement|is|in|as|to|for|status|rights?|year)\b)(?=[^\n]))"
    r"[^\n]*?(?=$|[.;,]\s+(?i:licensed|released|distributed|published|this|permission|redistribution|spdx)\b)"
)
RESERVED = r"(?im)^[^\p{L}\p{N}\n]*all rights? reserved[^\p{L}\p{N}\n]*$"


def canonical(text: Column) -> Column:
    """Lower case; copyright lines and lines of reserved rights out; runs of anything but letters and digits as one
    space; equivalent spellings as one. Null stays null."""
    c = F.regexp_replace(F.regexp_replace(text, COPYRIGHT, ""), RESERVED, "")
    c = F.concat(F.lit(" "), F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(F.regexp_replace(c, " +", " "))


def known_texts() -> list[tuple[str, str, str]]:
    """KNOWN and the whole licence texts, under each heading and with each usual end."""
    out = list(KNOWN)
    for name, kind, body in (("MIT", "permissive", _MIT), ("ISC", "permissive", _ISC)):
        out += [(name, kind, f"{heading}\n\n{body}") for heading in _HEADINGS[name]]
    for name, kind, file, headings, end in TEXTS:
        whole = (Path(__file__).parent / "license_texts" / file).read_text("utf-8")
        ends = [whole]
        if end:
            at = whole.index(end)
            ends += [whole[:at], whole[: at + len(end)]]
        if name.startswith("BSD"):  # conditions without numbers
            ends.append(re.sub(r"(?m)^[0-9]\. ", "* ", whole))
        out += [(name, kind, f"{heading}\n\n{text}") for text in ends for heading in ("", *headings)]
    return out


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """license, license_class, digest of the known texts; equal digests are one entry."""
    known = known_texts() if known is None else known
    rows = spark.createDataFrame(list(known), "license string, license_class string, text string")
    return (
        rows.withColumn("digest", F.sha2(canonical(F.col("text")), 256))
        .groupBy("digest")
        .agg(F.min("license").alias("license"), F.min("license_class").alias("license_class"))
    )


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, unit (`text` or `line`), license, license_class, n: per document the licences
    that its whole text, or that many of its lines, are.

    A document of one line counts as text only. Null and empty texts, blank lines and texts
    that are punctuation or copyright lines alone match nothing; rows that repeat a doc_id
    add up; rows without one are reported under null; further columns are ignored. `known`
    is broadcast when it is small, else the join is Spark's to plan.
    """
    lines = F.split("text", "\n", -1)
    units = docs.select("doc_id", F.col("text").cast("string").alias("text")).select(
        "doc_id",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit("text").alias("unit"), F.col("text").alias("part"))),
                F.when(
                    F.size(lines) > 1,
                    F.transform(lines, lambda x: F.struct(F.lit("line").alias("unit"), x.alias("part"))),
                ).otherwise(F.array()),
            )
        ).alias("u"),
    )
    # Exploded from an array of one: the conditions on it then use the value, where Spark
    # would otherwise put the whole normalisation into each of them again.
    canon = F.explode(F.array(canonical(F.col("u.part")))).alias("canon")
    digested = units.select("doc_id", "u.unit", canon).where("canon <> ''")
    return (
        digested.select("doc_id", "unit", F.sha2("canon", 256).alias("digest"))
        .join(known, "digest")
        .groupBy("doc_id", "unit", "license", "license_class")
        .agg(F.count("*").alias("n"))
    )
