"""Licence texts found by the digest of their canonical form, in DataFrame operations only.

Canonical: copyright lines go; case goes; each run of characters that are no letters or
digits becomes one blank; equivalent spellings become one. Texts that differ in nothing else
have one digest, so finding known licences is an equi-join of digests.

A text is looked up entire, and so is each of its lines and paragraphs (parted by lines that
hold nothing else than the above), for notices inside longer texts. Null and empty texts, and texts that hold nothing
but copyright lines and punctuation, hold no licence. Rows that share a key (null is one, too)
share their notices; very long texts cost in proportion to their length; extra columns stay; an empty
table gives an empty result. Known texts without an id or canonical text find nothing, and
two ids for one canonical text are both reported.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.llm.shared import small

#: A line that states a copyright; not one that goes on about "copyright notices".
COPYRIGHT = r"(?m)^[ \t]*(?:(?:[Cc]opyright|COPYRIGHT)[ \t]*(?:\([Cc]\)|©|[0-9<\[])|\([Cc]\)[ \t]|©)[^\n]*$"
#: What every such line holds, to pass over texts without any.
COPYRIGHT_SIGNS = ("opyright", "OPYRIGHT", "(c)", "(C)", "©")
#: Equivalent spellings, applied in this order to lower-case text without punctuation.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
)

_PERMIT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted"
)
_NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_OPEN = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.\n"
)
_BSD_CLOSE = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
#: Public licence texts and usual one-line notices, by SPDX id.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", f"MIT License\n{_MIT}"),
    ("ISC", f"{_PERMIT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_NO_WARRANTY}"),
    ("0BSD", f"{_PERMIT}.\n{_NO_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_OPEN}{_BSD_CLOSE}"),
    ("BSD-3-Clause", f"{_BSD_OPEN}{_BSD_NAMES}{_BSD_CLOSE}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
)


def known(spark: SparkSession, texts: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    return small(spark, list(texts), "license_id text")


def folded(text: Column) -> Column:
    """Letters and digits in lower case, blanks for all else, line breaks kept."""
    signs = reduce(or_, [F.contains(text, F.lit(sign)) for sign in COPYRIGHT_SIGNS])
    out = F.when(signs, F.regexp_replace(text, COPYRIGHT, " ")).otherwise(text)
    return F.regexp_replace(F.lower(out), r"[^\p{L}\p{N}\n]+", " ")


def canonical(folded_text: Column) -> Column:
    """The canonical form of folded text, or of a part of it."""
    out = F.trim(F.regexp_replace(folded_text, r"[ \n]+", " "))
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return out


def digest(folded_text: Column) -> Column:
    """Null where nothing is left of the text."""
    form = canonical(folded_text)
    return F.sha2(F.when(form != "", form), 256)


def scan(
    docs: DataFrame,
    licences: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    licence_id: str = "license_id",
    licence_text: str = "text",
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``canonical_sha256`` of the entire text, ``license_ids``, the known
    licences that the entire text is, and ``notice_ids``, those that a paragraph or line of
    it is (both sorted arrays). ``prefix`` goes before the three names where they would clash
    with columns of ``docs``."""
    whole, found, noticed = (prefix + n for n in ("canonical_sha256", "license_ids", "notice_ids"))
    if {whole, found, noticed} & set(docs.columns):
        raise ValueError(f"docs already has {whole}, {found} or {noticed}; name a prefix")
    names = licences.select(F.col(licence_id).alias("id"), digest(folded(F.col(licence_text))).alias("__digest"))
    names = names.where("id IS NOT NULL AND __digest IS NOT NULL")
    # One row for a known digest.
    names = names.groupBy("__digest").agg(F.array_sort(F.collect_set("id")).alias("__ids"))
    none = F.array().cast("array<string>")

    parts = F.array_distinct(F.concat(F.split("__folded", r"\n *\n[ \n]*"), F.split("__folded", r"\n")))
    digests = F.array_distinct(F.transform(parts, digest))
    notices = (
        docs.select(F.col(key).alias("__key"), folded(F.col(text)).alias("__folded"))
        .select("__key", F.explode(digests).alias("__digest"))
        .where("__digest IS NOT NULL")
        .join(names, "__digest")
        .select("__key", F.explode("__ids").alias("id"))
        .groupBy("__key")
        .agg(F.array_sort(F.collect_set("id")).alias("__notices"))
    )
    entire = docs.withColumn(whole, digest(folded(F.col(text))))
    return (
        entire.join(names, entire[whole] == names["__digest"], "left")
        .withColumn(found, F.coalesce("__ids", none))
        .drop("__digest", "__ids")
        .join(notices, docs[key].eqNullSafe(F.col("__key")), "left")
        .withColumn(noticed, F.coalesce("__notices", none))
        .drop("__key", "__notices")
    )
