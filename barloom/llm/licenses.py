"""License scan by canonical digest: texts are normalised and hash-joined with the digests of known licenses.

Known texts go through the very rules that documents do. Only column expressions are used; the same rules are stated
as SQL in `oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licenses and license notices, by name. Several texts may have one name.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org/>",
    ),
    (
        "MIT-0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
]
_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
]
# Conditions with numbers, and with other marks or none.
for _name, _parts in (("BSD-2-Clause", _BSD[1:3]), ("BSD-3-Clause", _BSD[1:4])):
    for _numbered in (True, False):
        KNOWN.append((_name, " ".join([_BSD[0], *(f"{k}. {p}" if _numbered else p for k, p in enumerate(_parts, 1)), _BSD[4]])))

# Fixed values: (name, digest, length) of the canonical forms of whole published texts that are too long to list here.
WHOLE = [
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b", 9887),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe", 8871),
    ("Apache-2.0", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64", 8843),
    ("Artistic-1.0", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2", 5833),
    ("CC0-1.0", "0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3", 6698),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60", 19583),
    ("GFDL-1.3", "fe520d4b1cc7b3e5f7a773d52e7a571e8d59172e5de950932069a798d2e29906", 22033),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", 11765),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", 17117),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34", 14483),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a", 33406),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", 30968),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", 24130),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", 25217),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4", 23365),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", 7104),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6", 22447),
    ("MPL-2.0", "9672a697b80e59f5b1b0201e64d65dee8762b193cdd934dc5bcf2b57350a2ead", 14353),
]

# Lines, in their plain form, that are left out of a whole text wherever they stand: titles and general claims.
LEFT_OUT = [
    "mit license", "the mit license", "the mit license mit", "mit license mit", "mit no attribution", "isc license", "the isc license", "isc license isc",
    "zlib license", "the zlib license", "zlib libpng license", "the zlib libpng license", "bsd license", "the bsd license", "bsd 2 clause license", "bsd 3 clause license", "the 2 clause bsd license",
    "the 3 clause bsd license", "the bsd 2 clause license", "the bsd 3 clause license", "bsd 2 clause simplified license", "bsd 3 clause new or revised license", "simplified bsd license", "new bsd license",
    "bsd zero clause license", "zero clause bsd license", "the unlicense", "unlicense", "boost software license version 1 0", "boost software license version 1 0 august 17th 2003", "all rights reserved",
]

# Spellings taken as one, as whole words of normalised text.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("nc", "noncommercial"), ("sa", "sharealike"), ("share alike", "sharealike"), ("v", "version"), ("acknowledgement", "acknowledgment"),
    ("neighbouring", "neighboring"), ("merchantibility", "merchantability"), ("organisation", "organization"), ("whilst", "while"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("https", "http"), ("favour", "favor"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines that only claim copyright; they are left out of a text.
CLAIM = r"^[^a-z0-9]*(copyright|©|\(c\))[^a-z0-9].*([0-9]{4}|reserved|[\[<{]y+[\]>}]|[\[<{]year[\]>}]).*$|^[^a-z0-9]*copyright *(\(c\)|©).*$"
#: Letters of which every known license has some, and that no rule here makes, breaks or changes: a text without any of
#: them is no known license. A list of other licenses that lack them is searched without this shortcut.
STEMS = ("licen", "rights", "software")
#: Spellings change the length of a normalised text by less than this factor.
STRETCH = 7


def plain(line: Column) -> Column:
    """A line in lower case without punctuation; a copyright line becomes empty."""
    low = F.translate(line, UPPER, LOWER)
    return F.when(low.rlike(CLAIM), F.lit("")).otherwise(F.trim(F.regexp_replace(low, "[^a-z0-9]+", " ")))


def canonical(text: Column) -> Column:
    """Plain text with one spelling for equivalent ones."""
    for other, one in SPELLINGS:
        text = F.regexp_replace(text, rf"\b{other}\b", one)
    return text


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), plain)


def _whole(lines: Column) -> Column:
    """The plain text of all lines without titles and claims; of a text that is nothing else, all of it."""
    kept = F.array_join(F.filter(lines, lambda x: (x != "") & ~x.isin(LEFT_OUT)), " ")
    return F.when(kept != "", kept).otherwise(F.array_join(F.filter(lines, lambda x: x != ""), " "))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: list[tuple[str, str]] | None = None, whole: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """Documents -> (doc_id, line, license, digest), a row for each whole text or whole line that is a known license.

    line: number from 0; -1: the document as a whole, without copyright lines and titles. known: (name, text), whole:
    (name, digest, canonical length); by default KNOWN and WHOLE, and no WHOLE where `known` is given. Null, empty and
    punctuation-only texts have no rows, very long ones are read whole; repeated rows have theirs each. A document of one line
    has a row for it and one for the whole. Other columns are not read. No rows: no rows.
    """
    spark = docs.sparkSession
    whole = (WHOLE if known is None else []) if whole is None else whole
    known = KNOWN if known is None else known
    if all(any(s in text.lower() for s in STEMS) for _, text in known):
        has_stem = lambda x: F.contains(x, F.lit(STEMS[0])) | F.contains(x, F.lit(STEMS[1])) | F.contains(x, F.lit(STEMS[2]))
    else:
        has_stem = lambda x: x.isNotNull()
    docs = docs.where(has_stem(F.lower(F.col(text_col))))
    texts = spark.createDataFrame(known, "license string, text string").select("license", canonical(_whole(_lines(F.col("text")))).alias("unit"))
    table = texts.select("license", F.sha2("unit", 256).alias("digest"), F.length("unit").alias("n"))
    table = table.union(spark.createDataFrame(whole, "license string, digest string, n int")).distinct()
    ends = table.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    least, most = (ends["least"] or 0) // STRETCH, (ends["most"] or 0) * STRETCH
    units = docs.select(F.col(id_col).alias("doc_id"), _lines(F.col(text_col)).alias("lines"))
    units = units.select("doc_id", F.posexplode(F.concat(F.array(_whole(F.col("lines"))), "lines")).alias("at", "unit"))
    units = units.where(F.length("unit").between(max(1, least), most) & has_stem(F.col("unit")))
    units = units.select("doc_id", (F.col("at") - 1).cast("int").alias("line"), F.sha2(canonical(F.col("unit")), 256).alias("digest"))
    return units.join(F.broadcast(table.drop("n")), "digest").select("doc_id", "line", "license", "digest")


def oracle(table: str = "documents") -> str:
    """The scan of a table as DuckDB SQL, without the shortcuts."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def sql_plain(x: str) -> str:
        low = f"translate({x}, '{UPPER}', '{LOWER}')"
        return f"CASE WHEN regexp_matches({low}, {quote(CLAIM)}) THEN '' ELSE trim(regexp_replace({low}, '[^a-z0-9]+', ' ', 'g')) END"

    def sql_canonical(x: str) -> str:
        for other, one in SPELLINGS:
            x = f"regexp_replace({x}, '\\b{other}\\b', '{one}', 'g')"
        return x

    lines = lambda x: f"list_transform(string_split({x}, chr(10)), lambda x: {sql_plain('x')})"
    joined = lambda x, more: f"list_aggregate(list_filter({x}, lambda x: x <> ''{more}), 'string_agg', ' ')"
    out = ", ".join(map(quote, LEFT_OUT))
    whole = f"coalesce(nullif({joined('lines', f' AND x NOT IN ({out})')}, ''), {joined('lines', '')})"
    known = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in KNOWN)
    digests = ", ".join(f"({quote(name)}, '{digest}')" for name, digest, _ in WHOLE)
    return f"""
WITH texts AS (SELECT license, {lines('text')} AS lines FROM (VALUES {known}) AS k(license, text)),
known AS (SELECT license, sha256({sql_canonical(whole)}) AS digest FROM texts UNION SELECT license, digest FROM (VALUES {digests}) AS k(license, digest)),
split AS (SELECT doc_id, {lines('text')} AS lines FROM {table} WHERE text IS NOT NULL),
units AS (SELECT doc_id, unnest(list_concat([{whole}], lines)) AS unit, unnest(range(-1, len(lines))) AS line FROM split)
SELECT doc_id, CAST(line AS INTEGER) AS line, license, digest
FROM (SELECT doc_id, line, sha256({sql_canonical('unit')}) AS digest FROM units WHERE unit <> '') JOIN known USING (digest)
"""
