"""License scan by canonical digests: whole texts, joined by hash to the digests of known licences.

Before it is hashed a text is lower-cased, loses its copyright lines, has each run of anything but letters and digits turned
into one space, and equivalent spellings unified. Lines and paragraphs that name a licence are looked up in the same way, for notices
and headers. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Equivalent spellings, and texts of public licences and notices. -----------------------------
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "https": "http", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "licence": "license", "licenced": "licensed", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program",
    "realise": "realize", "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "owner": "holder", "owners": "holders",
}
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_MIT_BODY = f"{_MIT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_AS_IS}"
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
_APACHE_HEAD = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License."""
_LATER = """This {start} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
KNOWN = (
    ("MIT", _MIT_BODY),
    ("MIT", f"MIT License\n\n{_MIT_BODY}"),
    ("MIT", f"The MIT License (MIT)\n\n{_MIT_BODY}"),
    ("MIT-0", f"{_MIT}.\n\n{_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n{_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD}\n{_BSD_NAME}\n\n{_BSD_TAIL}"),
    ("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_TAIL}"),
    ("ISC", f"ISC License\n\n{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_TAIL}"),
    ("0BSD", f"{_ISC}.\n\n{_ISC_TAIL}"),
    ("Zlib", f"{_ZLIB}"),
    ("Zlib", f"zlib License\n\n{_ZLIB}"),
    ("BSL-1.0", f"Boost Software License - Version 1.0 - August 17th, 2003\n\n{_BOOST}"),
    ("Unlicense", _UNLICENSE),
)
#: Notices of one line or paragraph.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE_HEAD),
    ("Apache-2.0", f"{_APACHE_HEAD} You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    *((f"{name}-{version}.0-or-later", _LATER.format(kind=kind, version=version, start=start)) for name, kind, versions in (("GPL", "General", (2, 3)), ("LGPL", "Lesser General", (3,)), ("AGPL", "Affero General", (3,))) for version in versions for start in ("program", "library")),
    *((f"CC-{v.upper().replace(' ', '-')}-4.0", f"{how} under CC {v.upper()} 4.0.") for v in ("by", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd") for how in ("Licensed", "This work is licensed")),
)
#: Names that a line ``SPDX-License-Identifier: name`` may give.
SPDX = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 EUPL-1.2 "
    "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-2.0 "
    "OFL-1.1 PSF-2.0 Unlicense WTFPL Zlib"
).split()
#: Digests (``digest_files``) of long licences, from the texts that Debian installs in /usr/share/common-licenses.
DIGESTS = (
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "de4b88a2c819a4661af54f735069ed878216da8b4992b919b84afa18cfc0e54c"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "9085ee283b8c84517846c5acafee37391c28bb825b7ecec4aaa90768f2f283b0"),
    ("LGPL-2.0", "289c8b47fa0ec7e5f22cd33d32feaa06f015b0f2fdb9ad916979b1011ca8c015"),
    ("LGPL-2.1", "5ddd6039d3b090c51328879800301dd19b1ad99e14d00f3c6f221ab45a32db57"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
)
#: Words after which a line that begins with "copyright" is part of a licence and no copyright line.
BODY_WORDS = "act and applies as claim for has holder holders in infringement interest interests is it law laws licence license licensee material materials notice notices of on or owner owners ownership permission permissions protection rights statement statements status the this to treaty you".split()
# -----------------------------------------------------------------------------------------------------------

#: A copyright line begins with "copyright" or a sign, and doesn't go on as a sentence of a licence does; or it is "all rights reserved" alone.
COPYRIGHT_LINE = (
    r"\n[^a-z0-9©\n]*(?:(?:portions )?(?:(?:copyright|©)(?![a-z])(?![^a-z0-9\n]*(?:" + "|".join(BODY_WORDS) + r")(?:[^a-z0-9]|$))|\(c\)[ \t]*(?:[0-9]{4}|copyright|©|by ))[^\n]*"
    r"|all rights reserved[^a-z0-9\n]*(?=\n|$))"
)
#: What a line or paragraph must hold to be looked up; all notices above hold it.
NAMES_LICENSE = "licen[cs]e"


def canonical(text: Column) -> Column:
    """The canonical form of a text: its words, lower-cased, copyright lines left out, spellings unified."""
    plain = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), COPYRIGHT_LINE, "")
    words = F.split(F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " ")), " ")
    same = F.create_map(*[F.lit(x) for pair in EQUIVALENT.items() for x in pair])
    # few words are in the list: a hash set tells them, and only they are searched in the map
    return F.array_join(F.transform(words, lambda w: F.when(w.isin(*EQUIVALENT), same[w]).otherwise(w)), " ")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def notices() -> list[tuple[str, str]]:
    return [*NOTICES, *((name, f"SPDX-License-Identifier: {name}") for name in SPDX)]


def known_digests(spark: SparkSession, known=None, digests=DIGESTS) -> DataFrame:
    """(known_digest, license_id), one row a digest: of the texts ``known`` (default: ``KNOWN`` and the notices) and of ``digests``."""
    texts = [*KNOWN, *notices()] if known is None else known
    rows = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("t")) for i, t in texts])
    listed = spark.range(1).select(F.inline(rows)).select(digest(F.col("t")).alias("known_digest"), "license_id")
    if digests:
        listed = listed.union(spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(d).alias("known_digest"), F.lit(i).alias("license_id")) for i, d in digests]))))
    return listed.groupBy("known_digest").agg(F.min("license_id").alias("license_id"))


def digest_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, known_digest) of the text files in a folder: what ``DIGESTS`` was made from, and how to add to it."""
    files = spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value")
    return files.select("name", digest(F.col("value")).alias("known_digest"))


def license_scan(docs: DataFrame, known=None, digests=DIGESTS) -> DataFrame:
    """(doc_id, text_digest, license_id, notices, has_license) for each row of ``docs`` (doc_id, text).

    license_id: the known licence that the entire text is, else null. notices: names of known licences or notices that
    whole lines or paragraphs are, sorted, joined by commas ('' if none). A null or empty text, and one of
    punctuation alone, has the digest of an empty form and no licence. Repeated rows give equal results. Very long texts are read whole; an
    empty table gives none.
    """
    # a fixed list of licences: its digests fit in a broadcast
    table_ = F.broadcast(known_digests(docs.sparkSession, known, digests))
    text = F.coalesce("text", F.lit(""))
    parts = lambda at: F.filter(F.split(text, at), lambda x: F.lower(x).rlike(NAMES_LICENSE))
    units = F.array_distinct(F.transform(F.array_distinct(F.concat(parts("\n"), parts(r"\n[ \t\r]*\n"))), digest))
    named = docs.where(F.lower(text).rlike(NAMES_LICENSE)).select("doc_id", F.xxhash64("text").alias("h"), F.explode(units).alias("unit"))
    found = named.join(table_, F.col("unit") == F.col("known_digest"))
    listed = found.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("hash")).agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    whole = docs.select("doc_id", F.xxhash64("text").alias("h"), digest(text).alias("text_digest")).join(table_, F.col("text_digest") == F.col("known_digest"), "left")
    both = whole.join(listed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash")), "left")
    return both.select("doc_id", "text_digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices"), (F.col("license_id").isNotNull() | F.col("notices").isNotNull()).alias("has_license"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same scan as SQL text: from the same fixed values, with copyright lines told line by line."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    same = "MAP {" + ", ".join(f"{quote(a)}: {quote(b)}" for a, b in EQUIVALENT.items()) + "}"
    begin = "^[^a-z0-9©]*(portions )?"
    body = f"[^a-z0-9]*({'|'.join(BODY_WORDS)})([^a-z0-9]|$)"
    is_line = (
        f"(regexp_matches(x, '{begin}(copyright|©)') AND NOT regexp_matches(x, '{begin}(copyright|©)([a-z]|{body})')"
        f" OR regexp_matches(x, '{begin}\\(c\\)[ \t]*([0-9]{{4}}|copyright|©|by )') OR regexp_matches(x, '^[^a-z0-9©]*all rights reserved[^a-z0-9]*$'))"
    )

    def digest_of(t: str) -> str:
        plain = f"array_to_string(list_filter(string_split(lower({t}), chr(10)), lambda x: NOT {is_line}), chr(10))"
        words = f"string_split(trim(regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
        return f"sha256(array_to_string(list_transform({words}, lambda w: coalesce({same}[w], w)), ' '))"

    known = " UNION ALL ".join(f"SELECT {quote(i)} AS license_id, {quote(t)} AS t" for i, t in [*KNOWN, *notices()])
    given = " UNION ALL ".join(f"SELECT {quote(i)} AS license_id, {quote(d)} AS d" for i, d in DIGESTS)
    return f"""
WITH known AS (SELECT d, min(license_id) AS license_id FROM (SELECT license_id, {digest_of("t")} AS d FROM ({known}) UNION ALL {given}) GROUP BY d),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
units AS (SELECT r, unnest(string_split(t, chr(10))) AS u FROM docs UNION ALL SELECT r, unnest(string_split_regex(t, '\n[ \t\r]*\n')) AS u FROM docs),
named AS (SELECT r, license_id FROM (SELECT r, {digest_of("u")} AS d FROM units WHERE regexp_matches(lower(u), '{NAMES_LICENSE}')) JOIN known USING (d)),
notices AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices FROM named GROUP BY r),
marked AS (SELECT r, doc_id, {digest_of("t")} AS text_digest FROM docs)
SELECT doc_id, text_digest, license_id, coalesce(notices, '') AS notices, license_id IS NOT NULL OR notices IS NOT NULL AS has_license
FROM marked LEFT JOIN known ON text_digest = d LEFT JOIN notices USING (r)"""


ORACLE_SQL = _sql()
