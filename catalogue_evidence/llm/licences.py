"""Licence scans: canonical texts joined to the digests of known licence texts. DataFrame functions only."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST = 2_000  # known texts read from a folder
# Public licence texts and usual notices, by SPDX identifier.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
KNOWN = [
    ("MIT", "licence", "MIT License\n" + MIT),
    ("MIT", "licence", MIT),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "This project is licensed under the MIT License."),
    ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("ISC", "licence", "ISC License\n" + ISC),
    ("ISC", "licence", ISC),
    ("BSD-2-Clause", "licence", BSD_2 + BSD_END),
    ("BSD-2-Clause", "licence", "BSD 2-Clause License\n" + BSD_2 + BSD_END),
    ("BSD-3-Clause", "licence", BSD_3 + BSD_END),
    ("BSD-3-Clause", "licence", "BSD 3-Clause License\n" + BSD_3 + BSD_END),
    ("0BSD", "licence", ZERO_BSD),
    ("Zlib", "licence", ZLIB),
    ("Zlib", "licence", "zlib License\n" + ZLIB),
    ("ISC", "notice", "Licensed under the ISC License."),
    ("ISC", "notice", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "notice", APACHE),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "notice", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "notice", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "notice", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "notice", "This work is licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "notice", "Released under CC0 1.0."),
]
#: Whole public licences beside this file, each named by its identifier.
KNOWN += [(f.name.removesuffix(".txt"), "licence", f.read_text(encoding="utf-8")) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]
#: Spellings that count as the same, the left words written as the right ones; applied in this order to whole words.
EQUIVALENT = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("https", "http"),
    ("v2 0", "version 2 0"),
    ("v3 0", "version 3 0"),
]
#: A copyright statement at the start of a line, up to where terms begin in the same line; or else the whole line.
STATEMENT = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*?(all rights reserved\.?|permission |redistribution |licen[cs]ed |released under |this software |the software )"
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*$"
RESERVED = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved\.?"


def canonical_lines(text: Column) -> Column:
    """A text's lines in canonical form, empty ones left out: lower case, no copyright statements, one blank for each run
    of what is neither letter nor digit, and one spelling of those in EQUIVALENT."""
    t = F.regexp_replace(F.lower(text), STATEMENT, "$1")
    t = F.regexp_replace(F.regexp_replace(t, RESERVED, ""), COPYRIGHT, "")
    t = F.regexp_replace(F.concat(F.lit(" "), F.replace(t, F.lit("\n"), F.lit(" \n ")), F.lit(" ")), r"[^\p{L}\p{N}\n]+", "  ")
    for was, now in EQUIVALENT:  # two blanks between words, so that one word's replacement leaves the next one's blank
        t = F.replace(t, F.lit(f" {was.replace(' ', '  ')} "), F.lit(f" {now.replace(' ', '  ')} "))
    return F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(F.replace(x, F.lit("  "), F.lit(" ")))), lambda x: x != "")


def canonical_text(text: Column) -> Column:
    return F.array_join(canonical_lines(text), " ")


def known_digests(spark: SparkSession, known: list[tuple[str, str, str]] = KNOWN) -> DataFrame:
    """(license_id, kind, digest) of the known texts; as many rows as the list has different ones. What is listed as a
    licence and as a notice is a licence."""
    rows = spark.createDataFrame(known, "license_id string, kind string, known string")
    canon = canonical_text(F.col("known"))
    return rows.groupBy("license_id", F.sha2(canon, 256).alias("digest")).agg(F.min("kind").alias("kind"))


def read_known(spark: SparkSession, folder: str) -> list[tuple[str, str, str]]:
    """More known texts, for scan(): each file of a folder is a whole licence, named by its identifier. They are read to
    the driver: texts of licences number a few hundred, and more than MOST are refused."""
    files = spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value")
    rows = files.limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError("too many known texts for a broadcast")
    return sorted((r["name"].removesuffix(".txt"), "licence", r["value"]) for r in rows)


def scan(docs: DataFrame, known: list[tuple[str, str, str]] = KNOWN) -> DataFrame:
    """(doc_id, license_id, kind, scope, n): known licence texts that documents are or hold as lines of their own.

    The entire canonical text of each document is looked up by its digest (scope text), and so is each of its lines
    (scope line), since notices stand as lines in other texts; n counts the lines. A document of one line has both.
    Null and empty texts have no licence. Rows that share a doc_id add up; a null doc_id counts as one document.
    Only doc_id and text are read. No rows give no rows. The known texts are a short list, so their digests are
    broadcast; read_known() adds those of a folder.
    """
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text").cast("string")).alias("lines"))
    unit = F.concat(
        F.transform("lines", lambda x: F.struct(F.lit("line").alias("scope"), x.alias("unit"))),
        F.array(F.struct(F.lit("text").alias("scope"), F.array_join("lines", " ").alias("unit"))),
    )
    units = lines.select("doc_id", F.inline(unit)).filter("unit <> ''").select("doc_id", "scope", F.sha2("unit", 256).alias("found"))
    digests = F.broadcast(known_digests(docs.sparkSession, known))
    met = units.join(digests, units["found"] == digests["digest"])
    return met.groupBy("doc_id", "license_id", "kind", "scope").agg(F.count(F.lit(1)).alias("n"))
