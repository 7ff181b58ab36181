"""Licence scans by canonical digest lookup.

DataFrame functions only.  A text is canonical after: A-Z lower-cased, lines
that begin with a copyright mark dropped, equivalent spellings replaced, every
run of other characters than a-z and 0-9 a single space, ends stripped.  The SHA-256 digest of the
whole canonical text is joined to the digests of the known licences; the
digests of single lines are looked up among the known notices.  Both lists are
fixed values of this module, so the joined side has a fixed size and is
broadcast, and no document text is shuffled.

Defined cases: null and empty text have the canonical text "" and match
nothing; a document that is only copyright lines likewise; known texts with equal digests
are reported under the id first in order; repeated rows are scanned alike; null ids are kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, ascii_lower, small_table

# fixed values: equivalent spellings, replaced in this order in lower-case text
SPELLINGS = (("licence", "license"), ("licencing", "licensing"), ("acknowledgment", "acknowledgement"),
             ("analogue", "analog"), ("authoris", "authoriz"), ("behaviour", "behavior"), ("catalogue", "catalog"),
             ("centre", "center"), ("customis", "customiz"), ("favour", "favor"), ("fulfil ", "fulfill "),
             ("initialis", "initializ"), ("merchantibility", "merchantability"), ("modernis", "moderniz"),
             ("noncommercial", "non commercial"), ("organis", "organiz"), ("per cent", "percent"),
             ("recognis", "recogniz"), ("sub-license", "sublicense"), ("utilis", "utiliz"), ("whilst", "while"),
             ("wilful", "willful"), ("https://", "http://"), ("&", " and "))
EMPTY = hashlib.sha256(b"").hexdigest()
COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©)"

# fixed values: one-line notices and what they name
NOTICES = {
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
                   'Licensed under the Apache License, Version 2.0 (the "License");'),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "MIT License", "The MIT License (MIT)"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."),
    "ISC": ("ISC License", "Licensed under the ISC License."),
    "all-rights-reserved": ("All rights reserved.",),
}

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

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

# whole texts; with and without their usual title
KNOWN = {
    "Apache-2.0-header": (_APACHE_HEADER,),
    "BSD-2-Clause": (_BSD_HEAD + _BSD_TAIL, "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    "BSD-3-Clause": (_BSD_HEAD + _BSD_THIRD + _BSD_TAIL, "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    "ISC": (_ISC, "ISC License\n\n" + _ISC),
    "MIT": (_MIT, "MIT License\n\n" + _MIT, "The MIT License (MIT)\n\n" + _MIT),
    "Zlib": (_ZLIB, "zlib License\n\n" + _ZLIB),
} | {k + "-notice": v for k, v in NOTICES.items()}

# fixed values: SHA-256 of the canonical form of long licences, as published
DIGESTS = {
    "Apache-2.0": "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100",
    "Artistic-1.0-Perl": "93aa47d57763801ed6e6a6591d4d4049a2c46794df90838023ceade56b569da0",
    "BSD-3-Clause": "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    "GFDL-1.2": "39cfe95edb66e8432e7d3338c5205011102308cb4b70cb292bfb0e16e7f4cbd4",
    "GFDL-1.3": "2695b21c0bcec410bd65daf2b349947158c376139b4294c34ae8f521b1353312",
    "GPL-1.0": "9caf042595280548f0149ac88169a7f2e04f35b2a642cf00b991f00d48bfa4ce",
    "GPL-2.0": "c230c00f329737cb7ce3d97a266318b4c9d4c1fd321335e592b2ce1112179b88",
    "GPL-3.0": "9eadaf9b7a40514a7ee1a9ae3af9be601993831c8cd600e49f6b418045800fe7",
    "LGPL-2.0": "b4114daa3dfa52e27e78b2c4e17acd58bf4381e812762f4ded0bcb8eabd1092c",
    "LGPL-2.1": "294fb9ec58649c7eb0cf90fc2900ac1b28b82fb6da9d40d7599d6b7d399d4d2e",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6",
    "MPL-2.0": "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9",
}


def respelled(text: Column) -> Column:
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def canonical_words(text: Column) -> Column:
    """Lower-cased text without copyright marks to canonical form."""
    return F.btrim(F.regexp_replace(respelled(text), "[^a-z0-9]+", " "))


def canonical_lines(text: Column) -> Column:
    """``canonical_words`` of every line of lower-cased text but for blanks at the ends; no spelling holds a line end."""
    return F.split(F.regexp_replace(respelled(text), "[^a-z0-9\n]+", " "), "\n")


def canonical(text: Column) -> Column:
    lines = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n"), lambda x: ~x.rlike(COPYRIGHT_LINE))
    return canonical_words(F.array_join(lines, "\n"))


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def known_texts(docs: DataFrame, known: dict[str, tuple[str, ...]], digests: dict[str, str] | None = None) -> DataFrame:
    """(k_digest, license): one row per digest, of the known texts and of the known digests."""
    rows = [(k, t) for k in sorted(known) for t in known[k]]
    df = small_table(docs.sparkSession, license=(pa.string(), [k for k, _ in rows]), text=(pa.string(), [t for _, t in rows]))
    df = df.select(digest(canonical(F.col("text"))).alias("k_digest"), "license")
    if digests:
        df = df.unionByName(small_table(docs.sparkSession, k_digest=(pa.string(), list(digests.values())),
                                        license=(pa.string(), list(digests))))
    return df.groupBy("k_digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known: dict[str, tuple[str, ...]] = KNOWN, notices: dict[str, tuple[str, ...]] = NOTICES,
                 digests: dict[str, str] = DIGESTS) -> DataFrame:
    """Per document: doc_id, canonical_sha256, license (of the entire text, or null), notices (names, sorted, once each)."""
    # the dictionaries are parameters of fixed size: a few rows
    names = {r["k_digest"]: r["license"] for r in known_texts(docs, notices).collect() if r["k_digest"] != EMPTY}
    pairs = [F.lit(x) for d in sorted(names) for x in (d, names[d])]
    lookup = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    lines = canonical_lines(ascii_lower(F.coalesce("text", F.lit(""))))
    found = F.transform(lines, lambda x: lookup[digest(F.btrim(x))])
    rows = docs.select("doc_id", digest(canonical(F.col("text"))).alias("canonical_sha256"),
                       F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))).alias("notices"))
    got = rows.join(F.broadcast(known_texts(docs, known, digests)), F.col("canonical_sha256") == F.col("k_digest"), "left")
    empty = F.col("canonical_sha256") == F.sha2(F.lit("").cast("binary"), 256)
    return got.select("doc_id", "canonical_sha256", F.when(~empty, F.col("license")).alias("license"),
                      F.array_join("notices", ",").alias("notices"))


def _sql_words(c: str) -> str:
    for old, new in SPELLINGS:
        c = f"replace({c}, '{old}', '{new}')"
    return f"trim(regexp_replace({c}, '[^a-z0-9]+', ' ', 'g'))"


def _sql_canonical(c: str) -> str:
    lower = f"translate(coalesce({c}, ''), '{UPPER}', '{LOWER}')"
    kept = f"list_filter(string_split({lower}, chr(10)), lambda x: NOT regexp_matches(x, '{COPYRIGHT_LINE}'))"
    return _sql_words(f"array_to_string({kept}, chr(10))")


def _sql_values(texts: dict[str, tuple[str, ...]]) -> str:
    return ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k in sorted(texts) for t in texts[k])


ORACLE = f"""
WITH known AS (SELECT d, min(k) AS license FROM (SELECT sha256({_sql_canonical("t")}) AS d, k FROM (VALUES {_sql_values(KNOWN)}) v(k, t)
         UNION ALL SELECT d, k FROM (VALUES {", ".join(f"('{k}', '{d}')" for k, d in DIGESTS.items())}) w(k, d)) GROUP BY 1),
notice AS (SELECT sha256({_sql_canonical("t")}) AS d, min(k) AS license FROM (VALUES {_sql_values(NOTICES)}) v(k, t) GROUP BY 1),
lines AS (SELECT doc_id, translate(unnest(string_split(coalesce(text, ''), chr(10))), '{UPPER}', '{LOWER}') AS line FROM documents),
hits AS (SELECT doc_id, string_agg(DISTINCT n.license, ',' ORDER BY n.license) AS notices
         FROM lines JOIN notice n ON sha256({_sql_words("line")}) = n.d GROUP BY 1),
docs AS (SELECT doc_id, sha256({_sql_canonical("text")}) AS canonical_sha256 FROM documents)
SELECT doc_id, canonical_sha256, CASE WHEN canonical_sha256 <> sha256('') THEN license END AS license, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known ON canonical_sha256 = d LEFT JOIN hits USING (doc_id)
"""
