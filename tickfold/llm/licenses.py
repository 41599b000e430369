"""Licence scans by canonical digests (operator 3).

A text is reduced to a canonical form (case, punctuation, copyright lines,
equivalent spellings), and the digest of the whole form is hash-joined with
those of known licences.  The same is done for each line, which finds one-line
notices.  All DataFrame functions.

Whole texts are those in ``license_texts`` (from Debian's common-licenses) and
the short ones here; notices are made from the licences' names and versions.
"""

from __future__ import annotations

import json
import os
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickfold.llm.common import stored, text_or_empty

# Known licence texts and notices (published by their authors).
MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """ISC License

Copyright (c) <year> <copyright holders>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZERO_BSD = ISC.replace("ISC License", "Zero-Clause BSD").replace(
    ", provided that the above copyright notice and this permission notice appear in all copies", "")
BSD2 = """BSD 2-Clause License

Copyright (c) <year>, <copyright holders>
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD3 = BSD2.replace("BSD 2-Clause", "BSD 3-Clause").replace("""with the distribution.
""", """with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
""")
KNOWN = (
    ("MIT", MIT),
    ("ISC", ISC),
    ("0BSD", ZERO_BSD),
    ("BSD-2-Clause", BSD2),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
)
#: Files of ``license_texts`` and their licences.
FILES = {"Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0",
         "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "GFDL-1.2": "GFDL-1.2",
         "GFDL-1.3": "GFDL-1.3", "CC0-1.0": "CC0-1.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause"}
#: (identifier, name in prose, versions); "" is a licence without versions.
FAMILIES = (
    ("MIT", "MIT", [""]), ("ISC", "ISC", [""]), ("0BSD", "Zero-Clause BSD", [""]), ("BSD-2-Clause", "BSD 2-Clause", [""]),
    ("BSD-3-Clause", "BSD 3-Clause", [""]), ("Apache", "Apache", ["1.1", "2.0"]),
    ("GPL", "GNU General Public", ["1.0", "2.0", "3.0"]), ("LGPL", "GNU Lesser General Public", ["2.1", "3.0"]),
    ("LGPL", "GNU Library General Public", ["2.0"]), ("AGPL", "GNU Affero General Public", ["3.0"]),
    ("GFDL", "GNU Free Documentation", ["1.1", "1.2", "1.3"]), ("MPL", "Mozilla Public", ["1.0", "1.1", "2.0"]),
    ("EPL", "Eclipse Public", ["1.0", "2.0"]))
CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
      ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
LEADS = tuple(f"{s}{v} under " for s, v in product(
    ("", *(f"This {x} is " for x in ("work", "software", "program", "project", "file", "document"))),
    ("licensed", "released", "distributed", "available")))
#: Licences that are also given "or any later version", and how.
LATER = ("GPL", "LGPL", "AGPL")
LATER_WAYS = (" or later", " or any later version", " or (at your option) any later version")
#: Titles that stand above a text, or don't.
TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
          "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"), "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License"),
          "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"),
          "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License")}


def notices() -> list[tuple[str, str]]:
    """(licence, notice) for each licence, version and usual wording."""
    out = []
    for key, name, versions in FAMILIES:
        for v in versions:
            spdx = f"{key}-{v}" if v else key
            ways = {f"the {name} License", spdx, f"the {spdx} License"}
            for n in {v, v.removesuffix(".0")} if v else ():
                ways |= {f"the {name} License, version {n}", f"version {n} of the {name} License", f"the {name} License {n}"}
                ways |= {f"{key} version {n}", f"the {key} version {n}", f"{key} {n}", f"the {key} {n}"}
            if v:  # a name without its version is not one licence
                ways.discard(f"the {name} License")
            out += [(spdx, lead + way) for lead in LEADS for way in ways] + [(spdx, f"SPDX-License-Identifier: {spdx}")]
            if key in LATER:
                later = f"{spdx}-or-later"
                ways = {way + end for way in ways if "ersion" in way or way.startswith(key) for end in LATER_WAYS}
                ways |= {f"the {name} License, version {n}, or later" for n in {v, v.removesuffix(".0")}} | {f"{key}, version {v.removesuffix('.0')} or later"}
                out += [(later, lead + way) for lead in LEADS for way in ways]
                out += [(later, way) for way in ways if way.startswith(key)]
                out += [(n, f"SPDX-License-Identifier: {n}") for n in (later, f"{spdx}-only")]
                out += [(later, f"SPDX-License-Identifier: {spdx}+")]
    for (key, name), v in product(CC, ("1.0", "2.0", "2.5", "3.0", "4.0")):
        spdx, kind = f"CC-{key}-{v}", "International" if v == "4.0" else "Unported" if v == "3.0" else "Generic"
        ways = (f"CC {key} {v}", f"a Creative Commons {name} {v} License", f"the Creative Commons {name} {v} License",
                f"a Creative Commons {name} {v} {kind} License", f"the Creative Commons {name} {v} {kind} License")
        out += [(spdx, lead + way) for lead in LEADS for way in ways] + [(spdx, f"SPDX-License-Identifier: {spdx}")]
    return out


def texts() -> list[tuple[str, str]]:
    """(licence, whole text): under each of its titles and none, with the appendix on
    how to apply it and without."""
    out = [("BSD-3-Clause", BSD3)]
    for name, text in (("MIT", MIT), ("ISC", ISC), ("0BSD", ZERO_BSD), ("BSD-2-Clause", BSD2), ("BSD-3-Clause", BSD3)):
        body = text.split("\n", 1)[1]
        out += [(name, f"{title}\n{body}") for title in ("", *TITLES[name])]
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
    for file, name in FILES.items():
        with open(os.path.join(folder, file), encoding="utf-8") as f:
            text = f.read()
        out.append((name, text))
        terms, end, rest = text.partition("END OF TERMS AND CONDITIONS")
        if rest:
            out += [(name, terms), (name, terms + end)]
    return out


#: Canonical words for spellings that licences use alike.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("centre", "center"), ("favour", "favor"),
    ("honour", "honor"), ("judgement", "judgment"), ("organisation", "organization"),
    ("programme", "program"), ("whilst", "while"), ("noncommercial", "non commercial"),
    ("https", "http"), ("v", "version"), ("c", "copyright"),
)


def canonical_lines(text: Column) -> Column:
    """Lower case; without copyright lines; punctuation as one blank; one spelling;
    line breaks as they were."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    out = F.translate(text, upper, lower)
    out = F.regexp_replace(
        out, r"(?md)^[^a-z0-9\n©]*(copyright|\(c\)|©|all rights reserved)([^a-z0-9\n][^\n]*)?$", " ")
    out = F.regexp_replace(F.replace(out, F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}\n]+", " ")
    for old, new in SPELLINGS:
        out = F.regexp_replace(out, rf"\b{old}\b", new)
    return out


def lines_of(text: Column) -> Column:
    """The lines of :func:`canonical_lines` that hold anything, as an array."""
    return F.filter(F.transform(F.split(canonical_lines(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digest(lines: Column) -> Column:
    """Of the whole text: its lines as one."""
    return F.sha2(F.array_join(lines, " "), 256)


def known_licenses(spark: SparkSession, known=None) -> DataFrame:
    """(license, digest) of the given (name, text) pairs; equal digests count once."""
    rows = [*KNOWN, *texts(), *notices()] if known is None else list(known)
    # as JSON: a local table without Python
    rows = json.dumps([{"license": n, "text": t} for n, t in rows])
    frame = spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<license: string, text: string>>")))
    return frame.groupBy(digest(lines_of(F.col("text"))).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_digest (canonical), license (of the whole
    text, or null), notices (licences of single lines, sorted, joined by commas, or null).

    Null counts as empty.  Texts and lines without a letter or digit match
    nothing.  Rows that repeat a doc_id share their notices, null ids among them; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    built_in = known is None
    known = stored(known_licenses(spark) if built_in else known, "known-licenses")
    if built_in:  # a few thousand rows, whatever the documents
        known = F.broadcast(known)
    # Each text is read and made canonical once: its own digest and those of its lines
    # are looked up together, and of the lines only those that are known are kept.
    lines = docs.select("doc_id", lines_of(text_or_empty()).alias("lines"))
    each = lambda whole, value: F.struct(F.lit(whole).alias("whole"), value.alias("digest"))
    digests = lines.select("doc_id", F.inline(F.concat(
        F.array(each(True, digest(F.col("lines")))), F.transform("lines", lambda x: each(False, F.sha2(x, 256))))))
    found = stored(digests.join(known, "digest", "left").filter("whole OR license IS NOT NULL"), "license-digests")
    whole = found.filter("whole").select("doc_id", F.col("digest").alias("text_digest"), "license")
    notices = found.filter("NOT whole").groupBy(F.col("doc_id").alias("id")).agg(
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("notices"))
    return whole.join(notices, F.col("doc_id").eqNullSafe(F.col("id")), "left").select(
        "doc_id", "text_digest", "license", "notices")
