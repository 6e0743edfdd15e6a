"""Licence texts and notices by canonical digest lookup.

A text is normalised (case, copyright lines, equivalent spellings, punctuation, gaps); its MD5
digest is joined with the digests of known licences.  Whole texts are looked up, and also each of
their lines, because a notice such as "Released under the MIT License." is a text of its
own that stands as one line in a document.  Everything is column functions: only
digests are exchanged, and only those of lines that are found are grouped.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import materialize

# Spellings that licence matching takes as equal, applied to lower-cased text.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("organisation", "organization"),
    ("recognised", "recognized"), ("authorised", "authorized"), ("modelling", "modeling"),
    ("favour", "favor"), ("honour", "honor"), ("whilst", "while"), ("per cent", "percent"),
    ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("copyright owner", "copyright holder"),
    ("https://", "http://"),
)

# Licence id, text.  Short licences in full, and the usual notices.
_SHORT = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
)

# Lines of letters that are the title of a text in license_texts/.
_TITLE_LINES = {"Apache-2.0": 3, "Artistic-1.0-Perl": 1, "MPL-2.0": 1, "BSD-2-Clause": 0, "BSD-3-Clause": 0, "Unlicense": 0}
# Titles that short licences are given.
_TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License"), "Unlicense": ("The Unlicense",),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License"),
}
_APPENDIX = re.compile(r"^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$", re.M)


def _shipped() -> list[tuple[str, str]]:
    """The texts of license_texts/; what stands before a second name is the licence id."""
    found = sorted((f.name, f) for f in files("tillroll.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt"))
    return [(re.sub(r"(\.[a-z]+)?\.txt$", "", name), f.read_text("utf-8")) for name, f in found]


def _forms(license_id: str, text: str) -> list[str]:
    """A full text as files hold it: with and without its title, "All rights reserved." and its appendix."""
    if license_id in _TITLES:
        heads = ["", *(f"{x}\n" for x in _TITLES[license_id])]
        bodies = dict.fromkeys((text, re.sub(r"^[0-9]\. ", "* ", text, flags=re.M)))    # numbers or marks for the conditions
        return [head + held + x for x in bodies for head in heads for held in ("", "All rights reserved.\n")]
    lines = text.splitlines(keepends=True)
    worded = [k for k, line in enumerate(lines) if re.search(r"\w", line)]
    out = [text, "".join(lines[worded[_TITLE_LINES.get(license_id, 2)]:])]
    for x in list(out):
        if end := _APPENDIX.search(x):
            out += [x[: end.start()], x[: end.end()]]
    return out


# Licence id, text; also the forms in which full texts are found.
KNOWN = (*_SHORT, *dict.fromkeys(
    (i, form) for i, text in [*((i, x) for i, x in _SHORT if "\n" in x), *_shipped()] for form in _forms(i, text)
    if (i, form) not in _SHORT))


# A line that holds a copyright notice and nothing before it but comment marks.
COPYRIGHT_LINE = r"^[ \t#*/]*(copyright[ \t]+(\(c\)|[0-9])|\(c\)[ \t]+(copyright|[0-9]))"


def canonical_line(line: Column) -> Column:
    """A line without what licence matching ignores; empty for a copyright line or marks alone."""
    out = F.replace(F.lower(line), F.lit("©"), F.lit("(c)"))
    plain = out
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(usual))
    # what is left are words of letters and digits; characters beyond ASCII stay as they are
    plain = F.trim(F.regexp_replace(plain, r"[\x00-/:-@\[-`{-\x7f]+", " "))
    return F.when(out.rlike(COPYRIGHT_LINE), "").otherwise(plain)


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that have words; a null text has none."""
    lines = F.transform(F.split(F.coalesce(text.cast("string"), F.lit("")), "\n"), canonical_line)
    return F.filter(lines, lambda x: x != "")


def whole_digest(lines: Column) -> Column:
    """MD5 of a whole text in canonical form, whatever its line breaks; null without words."""
    return F.when(F.size(lines) > 0, F.md5(F.array_join(lines, " ").cast("binary")))


def known_digests(licences: DataFrame) -> DataFrame:
    """license_id per digest of a table of license_id and text; the least id of equal texts."""
    found = licences.select("license_id", whole_digest(canonical_lines(F.col("text"))).alias("digest"))
    return found.filter("digest is not null and license_id is not null").groupBy("digest").agg(
        F.min("license_id").alias("license_id"))


def builtin(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def with_licenses(docs: DataFrame, licences: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` of each row of ``docs`` with digest, license_id, notices.

    ``license_id`` is the known licence whose text the whole text is, else null.  ``notices`` lists,
    in alphabetical order, the distinct known licences whose text is one line of the text (a whole
    text of one line is such a line); it is empty for none.  Null and empty texts have no digest.
    Repeated rows, also of a null key, get equal results.  Other columns are ignored.
    """
    known = known_digests(licences)
    lines = docs.select(F.col(key).alias("key"), canonical_lines(F.col("text")).alias("lines"))
    digests = lines.select("key", whole_digest(F.col("lines")).alias("digest"),
                           F.transform("lines", lambda x: F.md5(x.cast("binary"))).alias("lines"))
    # rows meet their notices by what the notices depend on, so copies and repeated keys need no row number
    digests = materialize(digests.withColumn("content", F.md5(F.array_join("lines", "").cast("binary"))), "digests")
    line = digests.select("content", F.explode("lines").alias("digest"))
    notices = line.join(known, "digest").groupBy("content").agg(F.sort_array(F.collect_set("license_id")).alias("notices"))
    found = digests.select("key", "digest", "content").join(known, "digest", "left").join(notices, "content", "left")
    none = F.array().cast("array<string>")
    return found.select(F.col("key").alias(key), "digest", "license_id", F.coalesce("notices", none).alias("notices"))
