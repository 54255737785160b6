"""Licence scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form (lower case, copyright notices and "all
rights reserved" dropped, equivalent spellings made one, everything but letters
and digits one space), hashed with SHA-256, and hash-joined to the digests of
known licences, which get the same treatment. A notice is "copyright" with (c), a year,
a placeholder or a capital name after it, or (c) with a year, or ©; it is dropped
to its line's end, if that is near, or in a flattened text to where a licence is
known to begin, if only names, years and addresses stand between. The lookup compares entire texts:
a document, or each of a document's lines as a text of its own (notices such as
"Released under the MIT License." stand on a line).

The known texts are a table given by the caller. It is broadcast if its digests
were counted to be at most ``BROADCAST_ROWS``; else Spark picks the join (and
splits a digest that many documents share). The default table is ``KNOWN`` and
``whole_texts()``: the common licences, each with and without its title, with
and without what follows its terms, and the notices that they give for files.

Defined cases: null and empty texts, and texts with nothing but copyright
notices, have an empty form, which matches no licence; repeated documents are
looked up each; several known names of one digest are reported as the smallest;
an empty table of known texts leaves every document unmatched; columns named
like the outputs are replaced.
"""

from __future__ import annotations

from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.session import read_table

# Spellings that licence matching treats as equal.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"), ("sublicence", "sublicense"),
    ("authorisation", "authorization"), ("merchantibility", "merchantability"), ("noninfringement", "non  infringement"),
    ("organisation", "organization"), ("favour", "favor"), ("whilst", "while"), ("owner", "holder"), ("owners", "holders"), ("http", "https"), ("v2", "version  2"), ("v3", "version  3"),
)

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Known licence texts and the notices that stand for them, with their public identifiers.
KNOWN = (
    ("MIT", f"MIT License\n\nCopyright (c) <year> <holders>\n\n{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_MIT_DISCLAIMER}"),
    ("MIT", f"{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_MIT_DISCLAIMER}"),
    ("MIT-0", f"MIT No Attribution\n\n{_MIT_GRANT}.\n\n{_MIT_DISCLAIMER}"),
    ("ISC", f"ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_DISCLAIMER}"),
    ("0BSD", f"BSD Zero Clause License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_DISCLAIMER}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_TERMS}\n{_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_TERMS}{_BSD_THIRD}\n{_BSD_DISCLAIMER}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
)

# Titles of the short licences in ``KNOWN``.
_TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "MIT-0": ("MIT No Attribution", "MIT No Attribution License"), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"), "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"),
}
# Whole texts in license_texts: where the text without a title begins, where its terms end, and the notice for files.
_FILES = {
    "Apache-2.0": ("TERMS AND CONDITIONS FOR USE", "END OF TERMS AND CONDITIONS", ("Apache-2.0", "Licensed under the Apache License", "limitations under the License.")),
    "GPL-2.0": ("Everyone is permitted", "END OF TERMS AND CONDITIONS", ("GPL-2.0-or-later", "This program is free software", "Boston, MA 02110-1301 USA.")),
    "GPL-3.0": ("Everyone is permitted", "END OF TERMS AND CONDITIONS", ("GPL-3.0-or-later", "This program is free software", "gnu.org/licenses/>.")),
    "LGPL-2.1": ("Everyone is permitted", "END OF TERMS AND CONDITIONS", ("LGPL-2.1-or-later", "This library is free software", "02110-1301  USA")),
    "LGPL-3.0": ("Everyone is permitted", None, None),
    "MPL-2.0": ("1. Definitions", "Exhibit A - Source Code Form", ("MPL-2.0", "This Source Code Form is subject", "mozilla.org/MPL/2.0/.")),
    "EPL-1.0": ("THE ACCOMPANYING PROGRAM IS", None, None),
    "CC0-1.0": ("Statement of Purpose", None, None),
    "Unlicense": ("This is free and unencumbered", "For more information, please refer", None),
}


def whole_texts() -> list[tuple[str, str]]:
    """(license, text) of the common licences in the forms in which they are found."""
    out = []
    for name, titles in _TITLES.items():
        body = next(t for n, t in KNOWN if n == name).split("\n\n", 1)[1]
        for b in {body, body.replace("\n1. ", "\n").replace("\n2. ", "\n").replace("\n3. ", "\n")}:  # clauses also come with bullets
            out += [(name, b), *((name, f"{t}\n\n{b}") for t in titles)]
    for name, (begin, end, notice) in _FILES.items():
        text = (resources.files("roadframe.llm") / "license_texts" / f"{name}.txt").read_text("utf-8")
        starts, ends = {0, text.index(begin)}, {len(text)}
        if end:
            at = text.rindex(end)
            ends |= {at, at + len(end)} if end.startswith("END OF") else {at}
        out += [(name, text[a:z]) for a in starts for z in ends]
        if notice:
            at = text.rindex(notice[1])
            out.append((notice[0], text[at : text.index(notice[2], at) + len(notice[2])]))
    return out


# The SQL check's rule: the same on texts whose lines begin with "copyright" in notices alone.
_COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n(]*(?:copyright|\(c\)|©)[^\n]*$"
_RESERVED = r"all\s+rights\s+reserved"


# "copyright" before these words is part of a licence's own text, not a notice.
_OWN = r"(?!(?i:notices?|holders?|owners?|licen[cs]es?|licen[cs]ed|laws?|acts?|and|or|in|interests?|protection|statements?|disclaimers?|treaty|of|to|on|for|is|the|this|that|as|by\s+\p{Ll})\b)"
_MARK = r"(?:\(c\)|\(C\)|©|\d{4}|[<\[{])"
_BEGIN = rf"(?:(?i:copyright)[^\S\n]*:?[^\S\n]*(?:{_MARK}|(?<=[\s:]){_OWN}(?:by\s+)?\p{{Lu}})|\([cC]\)[^\S\n]*(?:\d{{4}}|(?i:copyright))|©)"
_LICENSE_BEGINS = r"(?i:permission\s+is\s+hereby\s+granted|permission\s+to\s+use|redistribution\s+and\s+use|all\s+rights\s+reserved|licensed\s+under|released\s+under|everyone\s+is\s+permitted|this\s+(?:program|library|software|source\s+code\s+form)\s+is)"
_FLAT = rf"{_BEGIN}(?:[^\s]*(?:[^\S\n]|\n(?!\s*\n))+(?:(?!{_LICENSE_BEGINS})(?:(?=[^\p{{Ll}}\s])|(?=[^\s]*[@/])|(?=(?:and|by|of|the|for|contributors|authors?|others|present|name|copyright|owners?|holders?)\b))){{1}}){{0,30}}[^\s]*\s+(?={_LICENSE_BEGINS})"
_NOTICE = rf"(?m)^[^\p{{L}}\p{{N}}\n(]*{_BEGIN}[^\n]{{0,200}}$"
_NAMED = r"(?i)copyright|©|\(c\)"


def canonical(text: Column) -> Column:
    """Words of the canonical form, joined by two spaces and with one around (two: neighbours never share one)."""
    t = F.coalesce(text, F.lit(""))
    t = F.when(t.rlike(_NAMED), F.regexp_replace(F.regexp_replace(t, _FLAT, " "), _NOTICE, " ")).otherwise(t)
    t = F.regexp_replace(F.lower(t), _RESERVED, " ")
    t = F.concat(F.lit(" "), F.regexp_replace(t, r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    t = reduce(lambda c, pair: F.replace(c, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")), EQUIVALENT, t)
    return F.trim(t)


#: SHA-256 of the empty form.
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: Known digests up to which they are a constant of the plan, looked up inside the row.
INLINE_ROWS = 1000
#: Known digests (about 100 bytes each) up to which the lookup table is broadcast.
BROADCAST_ROWS = 50_000


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form, never null (so that no filter computes it a second time)."""
    return F.coalesce(F.sha2(canonical(text), 256), F.lit(EMPTY))


def known_table(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    return spark.createDataFrame([*KNOWN, *whole_texts()] if known is None else list(known), "license string, text string")


def digests(known: DataFrame) -> DataFrame:
    """(__llm_known, __llm_name): one row for each digest."""
    table = known.select(F.col("license").cast("string").alias("__llm_name"), digest(F.col("text")).alias("__llm_known")).where(F.col("__llm_known") != EMPTY)
    return table.groupBy("__llm_known").agg(F.min("__llm_name").alias("__llm_name"))


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """Append text_digest (null: empty form), license (of the whole text, or null) and line_licenses (sorted names of lines that are known texts).

    Up to ``INLINE_ROWS`` known digests are a constant of the plan, and a row is judged by itself in one pass.
    More are joined: then the rows are numbered and written first, so that both joins see the same rows under
    the same numbers, whatever ``docs`` is.
    """
    table = digests(known)
    size = table.count()
    return _scan_inline(docs, table, text) if size <= INLINE_ROWS else _scan_joined(docs, table if size > BROADCAST_ROWS else F.broadcast(table), text)


def _scan_inline(docs: DataFrame, table: DataFrame, text: str) -> DataFrame:
    base = common.without(docs, ["text_digest", "license", "line_licenses"])
    names = {r["__llm_known"]: r["__llm_name"] for r in table.collect()}
    pairs = [F.lit(x) for pair in names.items() for x in pair]

    def name(d: Column) -> Column:
        return F.try_element_at(F.create_map(*pairs), d) if pairs else F.lit(None).cast("string")

    lines = F.coalesce(F.split(F.col(f"`{text}`"), "\n"), F.array().cast("array<string>"))
    found = F.array_sort(F.array_distinct(F.array_compact(F.transform(lines, lambda x: name(digest(x))))))
    own = base.withColumn("__llm_digest", digest(F.col(f"`{text}`")))
    return own.select(*[F.col(f"`{c}`") for c in base.columns], F.nullif("__llm_digest", F.lit(EMPTY)).alias("text_digest"), name(F.col("__llm_digest")).alias("license"), found.alias("line_licenses"))


def _scan_joined(docs: DataFrame, table: DataFrame, text: str) -> DataFrame:
    base = common.without(docs, ["text_digest", "license", "line_licenses"])
    rows = common.stage(base.withColumn("__llm_row", F.monotonically_increasing_id()), "numbered-documents")
    whole = rows.withColumn("__llm_digest", digest(F.col(f"`{text}`"))).join(table, F.col("__llm_digest") == F.col("__llm_known"), "left").withColumnRenamed("__llm_name", "__llm_license")
    lines = rows.select(F.col("__llm_row").alias("__llm_of"), F.explode(F.split(F.col(f"`{text}`"), "\n")).alias("__llm_line"))
    found = lines.select("__llm_of", digest(F.col("__llm_line")).alias("__llm_digest")).join(table, F.col("__llm_digest") == F.col("__llm_known"))
    found = found.groupBy("__llm_of").agg(F.sort_array(F.collect_set("__llm_name")).alias("__llm_names"))
    out = whole.join(found, F.col("__llm_row") == F.col("__llm_of"), "left")
    empty = F.array().cast("array<string>")
    return out.select(*[F.col(f"`{c}`") for c in base.columns], F.nullif("__llm_digest", F.lit(EMPTY)).alias("text_digest"), F.col("__llm_license").alias("license"), F.coalesce("__llm_names", empty).alias("line_licenses"))


def _canonical_sql(column: str) -> str:
    t = f"regexp_replace(regexp_replace(lower(coalesce({column}, '')), '{_COPYRIGHT}', ' ', 'g'), '{_RESERVED}', ' ', 'g')"
    t = f"concat(' ', regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g'), ' ')"
    for a, b in EQUIVALENT:
        t = f"replace({t}, ' {a} ', ' {b} ')"
    return f"trim({t})"


def _digest_sql(column: str) -> str:
    return f"(SELECT CASE WHEN length(c) > 0 THEN sha256(c) END FROM (SELECT {_canonical_sql(column)} AS c))"


def oracle() -> str:
    quoted = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    return f"""
WITH known AS (SELECT d, min(name) AS name FROM (SELECT name, {_digest_sql('body')} AS d FROM (VALUES {quoted}) AS t(name, body)) GROUP BY d),
docs AS (SELECT doc_id, {_digest_sql('text')} AS d FROM documents),
lines AS (SELECT DISTINCT l.doc_id, k.name FROM (SELECT doc_id, {_digest_sql('line')} AS d FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) AS l JOIN known AS k ON k.d = l.d),
grouped AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS names FROM lines GROUP BY doc_id)
SELECT docs.doc_id, docs.d AS text_digest, known.name AS license, coalesce(grouped.names, '') AS line_licenses
FROM docs LEFT JOIN known ON known.d = docs.d LEFT JOIN grouped ON grouped.doc_id = docs.doc_id
"""


@register("op10_license_scan", oracle())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in all documents: whole texts, and lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, known_table(spark)).select("doc_id", "text_digest", "license", F.concat_ws(",", "line_licenses").alias("line_licenses"))
