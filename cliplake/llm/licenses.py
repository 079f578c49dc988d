"""Licence scans by digests of canonical texts, in DataFrame operations only.

A text is made canonical (lower case, copyright statements dropped, equivalent spellings made one,
everything but letters and digits a single blank) and hashed whole; without a title and "all rights
reserved" in front it is joined by its digest with the known licences.  Single lines are looked up the same way among known one-line notices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence texts and notices.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-notice": "All rights reserved.",
}
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.
"""
# Further public licence texts.
MORE = {
    "BSD-2-Clause": _BSD.format(""),
    "BSD-3-Clause": _BSD.format(_THIRD),
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software. Permission is granted to
anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.
3. This notice may not be removed or altered from any source distribution.""",
}
# Spellings counted as equal, after punctuation has gone.
SPELLINGS = {
    "licence": "license",
    "non infringement": "noninfringement",
    "sub license": "sublicense",
    "per cent": "percent",
    "organisation": "organization",
    "acknowledgement": "acknowledgment",
    "favour": "favor",
}
_YEAR = r"[\[<{(]?(?:(?:19|20)\d\d|year|yyyy)"
#: A line that states who holds the rights: the word and (c), © or a year, or the sign and a year.
COPYRIGHT_STATEMENT = (
    r"(?m)^[^\p{L}\n]*(?:(?:portions |parts )?copyright[ \t:,]*(?:\(c\)|©|&copy;|"
    + _YEAR
    + r")|(?:\(c\)|©)[ \t]*"
    + _YEAR
    + r")[^\n]*$"
)
_TITLE = (
    r"(?:(?:the )?(?:mit|expat|isc|zlib|bsd zero clause|(?:bsd )?[023] clause(?: bsd)?|"
    r"(?:new |modified |revised |simplified )?bsd) license(?: (?:mit|expat|isc|zlib|0bsd|bsd [23] clause))? )"
)
#: What stands before the body of a licence, in canonical text.
HEAD = rf"^{_TITLE}?(?:all rights reserved )?{_TITLE}?"
#: Only for the SQL that the query is compared with: every line that begins with the word.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\n]*(copyright|\(c\)|©)[^\n]*$"


def canonical_lines(text: Column) -> Column:
    """Canonical text that still has its line breaks; null stays null."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_STATEMENT, "")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    for spelling, standard in SPELLINGS.items():
        out = F.replace(out, F.lit(spelling), F.lit(standard))
    return out


def canonical(lines: Column) -> Column:
    """The lines of ``canonical_lines`` as one text with single blanks."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def body(text: Column) -> Column:
    """Canonical text without title and "all rights reserved" in front of a body."""
    return F.regexp_replace(text, HEAD, "")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def known_licenses(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """(license_id, digest) of the known texts, a table as small as the dictionary."""
    rows = spark.createDataFrame(list((known or KNOWN | MORE).items()), "license_id string, body string")
    return rows.select("license_id", digest(body(canonical(canonical_lines(F.col("body"))))).alias("digest"))


def scanned(
    docs: DataFrame, id: str = "doc_id", text: str = "text", known: dict[str, str] | None = None
) -> DataFrame:
    """(id, digest, license_id, notices) for every row.

    digest is that of the whole canonical text (null for a null text; the empty text has one);
    license_id names the known licence with the digest of the body (``body``), else null.  notices lists the known texts
    that a single line of the document equals, each once, in code point order; null for a null text.
    Very long texts are hashed whole, repeated rows are scanned each.
    """
    spark = docs.sparkSession
    table = known_licenses(spark, known)
    ids = F.broadcast(table.groupBy("digest").agg(F.min("license_id").alias("license_id")))
    # The dictionary is a constant of this file or of the caller, so its digests fit into the plan.
    lookup = {r["digest"]: r["license_id"] for r in ids.collect()}
    names = F.create_map(*[F.lit(x) for pair in lookup.items() for x in pair])
    digests = F.array(*[F.lit(x) for x in lookup])
    lines = docs.select(
        F.col(f"`{id}`").alias("id"), canonical_lines(F.col(f"`{text}`")).alias("lines")
    )
    of_lines = F.transform(F.split("lines", "\n"), lambda line: digest(canonical(line)))
    hits = F.array_intersect(digests, of_lines)
    return (
        lines.select(
            "id",
            digest(canonical(F.col("lines"))).alias("digest"),
            digest(body(canonical(F.col("lines")))).alias("of_body"),
            F.array_sort(F.transform(hits, lambda d: names[d])).alias("notices"),
        )
        .join(ids.withColumnRenamed("digest", "of_body"), "of_body", "left")
        .select(F.col("id").alias(id), "digest", "license_id", "notices")
    )
