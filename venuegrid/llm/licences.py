"""Licence scans by canonical digest lookup.

A text is brought to a canonical form: lower case, title and copyright lines at its head and copyright lines elsewhere
removed, numbers and bullets of list items too, equivalent spellings unified, everything but letters and digits turned
into single spaces, and the name in a non-endorsement clause made a common one. The SHA-256 of the whole form is
hash-joined with the digests of the known licence texts; every line's form is likewise looked up among known notices.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts of common licences and one-line notices.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}
#: Canonical digests of whole texts too long to hold here.
DIGESTS = {
    "Apache-2.0": "b8b4b7a1a3fc45a40c173b28ca0fcfde44b6289443f009fcb8d3cd6162c57d6e",
    "Artistic-1.0-Perl": "b06eda62b7e0c69e6f8a5960610095b69349654af941a79eca834edcd5e64e49",
    "CC0-1.0": "51c4bf27767d074bdefc84db7420b4c55e27827dac6d8de3ef0d37b2042fb6fa",
    "GFDL-1.2": "66c938a4f3d2114cc3d60f4233a4f26e8c730064aa767788d4745dedea334da1",
    "GFDL-1.3": "3c375c0e780727eaa9ddb17a7fa022a4b0b7ed527f12a3da106f47b622a3b3f1",
    "GPL-1.0": "d12bf436716562844f9a1fa4b2d7f3d40b9a3958451bc802147a9b1f72b26449",
    "GPL-2.0": "5fbaf82c679588b288227e6fa2348731ce4db7888a791bdf8a007da45db6d110",
    "GPL-3.0": "1d853c80efe5ceb4de7b2f36ad97f5659946947afc9c6c75fa3fa50e20368ef2",
    "LGPL-2.0": "4a1b1cb15d45262f049457ae26945909d0e5af93e2e3fb5de82c9f72ac6bebe2",
    "LGPL-2.1": "f2755dc4b609b314faab32d30ca6d0466b60adc931cece2ea4f0b61f483bfc98",
    "LGPL-3.0": "cb8c0f424bdd5c42a0b18285893829d988e9fb9a00d0cd604a59ebe8da7eeb45",
    "MPL-1.1": "515864bf52691dd64fb39dffbada72bd2c710ec817092ccb757dd3d9b02c6255",
    "MPL-2.0": "d2954ecddd82787482d526252c2595f628a7e2ccd8c32b969382705b61c7ed8d",
}
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License");'],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License, version 3."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Released under the GNU General Public License, version 2."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0."],
}
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "acknowledgement": "acknowledgment", "authorise": "authorize", "authorised": "authorized",
    "favour": "favor", "organisation": "organization", "modelling": "modeling", "programme": "program", "noncommercial": "non commercial", "copyright owner": "copyright holder", "copyright owners": "copyright holders", "per cent": "percent",
}
_COPYRIGHT = r"(?m)^[ \t*#/;-]*(?:copyright\b|\(c\)|©)[^\n]*(?:\d{4}|\(c\)|©)[^\n]*$|^[ \t*#/;-]*all rights reserved\.?[ \t]*$"
#: Names by which short licences are titled.
_TITLES = r"(?:the )?(?:(?:mit|expat|isc|0bsd|zlib(?:/libpng)?|(?:new |modified |revised |simplified )?bsd|[0-3]-clause bsd|zero-clause bsd)\b[^\n]*licen[cs]e\b[^\n]*|licen[cs]e:? (?:mit|isc|0bsd|zlib|bsd)\b[^\n]*|bsd [0-3]-clause)"
_HEAD_LINE = rf"[ \t\r*#/;=_-]*(?:copyright\b[^\n]*|\(c\)[^\n]*|©[^\n]*|all rights reserved\b[^\n]*|spdx-license-identifier:[^\n]*|{_TITLES}[ \t\r*#/;=_()-]*)?"
#: What a licence file may begin with: title, copyright and empty lines.
_HEAD = rf"\A(?:{_HEAD_LINE}\n){{0,40}}(?:{_HEAD_LINE}\z)?"
_ITEMS = r"(?m)^[ \t]*(?:\(?\d{1,2}[.)]|\(?[a-z][.)]|[*•-])[ \t]+"
#: In canonical form, whose name a clause protects.
_NAMED, _ANYBODY = r"neither the names? of .{1,80}? nor the names of (?:its|the|other|any|their) contributors", "neither the name of the copyright holder nor the names of its contributors"


def _tidy(text: Column) -> Column:
    """Canonical form of lower-cased text without its copyright lines."""
    spaced = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    return F.element_at(F.transform(F.array(spaced), _spelled), 1)


def _spelled(text: Column) -> Column:
    changed = text
    for said, meant in SPELLINGS.items():
        changed = F.regexp_replace(changed, rf"\b{said}\b", meant)
    return F.when(text.rlike(r"\b(" + "|".join(SPELLINGS) + r")\b"), changed).otherwise(text)


def _whole(lower: Column) -> Column:
    """Canonical form of a lower-cased whole text."""
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace(lower, _HEAD, ""), _COPYRIGHT, " "), _ITEMS, " ")
    return F.regexp_replace(_tidy(body), _NAMED, _ANYBODY)


def canonical(text: Column) -> Column:
    """A whole text in canonical form."""
    return _whole(F.lower(text))


def known(spark, texts: dict[str, str] = TEXTS) -> DataFrame:
    """Digests of known texts and DIGESTS: ``digest``, ``license``; the smallest name where two forms agree."""
    rows = spark.createDataFrame(list(texts.items()), "license string, text string")
    whole = rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license")
    return whole.unionByName(spark.createDataFrame(list(DIGESTS.items()), "license string, digest string")).groupBy("digest").agg(F.min("license").alias("license"))


def _hints(forms: list[str]) -> str:
    """A pattern that every line with one of these canonical forms matches: a word of licences, or one of the form's own.

    Words that another spelling can stand for are no hint; a form without any other word lets all lines through.
    """
    usual, respelled = r"licen[cs]e|\bcc\b|cc0", {w for meant in SPELLINGS.values() for w in meant.split()}
    found = {max([w for w in f.split() if w not in respelled], key=len, default="") for f in forms if not re.search(usual, f)}
    return "" if "" in found else "|".join([usual, *sorted(found)])


def scan(docs: DataFrame, texts: dict[str, str] = TEXTS, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    """One row per row of docs (doc_id, text): digest, license (null unless the whole text is a known one), notices.

    ``notices`` lists, sorted and without repeats, the licences named by lines that are a known notice. Null texts
    count as empty and match nothing; repeated rows each get their row; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lower = F.lower(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lower.alias("__lower"))
    spark = docs.sparkSession
    pairs = spark.createDataFrame([(n, t) for n, ts in notices.items() for t in ts], "name string, text string")
    said = {r[0]: r[1] for r in pairs.select(_tidy(F.lower("text")), "name").collect()}
    # other lines are not brought to canonical form
    hints = _hints(list(said))
    lines = F.filter(F.split("__lower", "\n"), lambda x: x.rlike(hints))
    forms = F.transform(lines, _tidy)
    named = F.create_map(*(F.lit(x) for pair in said.items() for x in pair)) if said else F.create_map()
    found = F.array_sort(F.array_distinct(F.filter(F.transform(forms, lambda f: named[f]), lambda x: x.isNotNull())))
    none = F.array().cast("array<string>")
    whole = F.sha2(_whole(F.col("__lower")), 256)
    marked = rows.select("doc_id", whole.alias("digest"), (F.when(F.size(lines) > 0, found).otherwise(none) if said else none).alias("notices"))
    return marked.join(F.broadcast(known(spark, texts)), "digest", "left").select("doc_id", "digest", "license", "notices")
