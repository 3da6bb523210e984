"""Operator 1: licence scan by digests of canonical texts.

A text is made canonical line by line: lower case; "(c)" and the sign read as the word; everything but letters and digits
separates words; equivalent spellings become one; lines that only name a copyright holder or an SPDX identifier, or reserve rights, go. The digest of the whole
text, and the digest of each line, are joined by equality to the digests of known licences and of known one-line notices, which
are made canonical by the same expressions. Licences are known in their usual wordings, with and without title and appendix
(``TITLES``, ``license_texts``). Only entire texts and entire lines match, never parts.

All of it is column expressions: one scan, lines exploded, a join with the known digests, and sums per document.

Defined cases: null and empty texts, and texts without words, have no digest and match nothing; repeated rows are scanned
each; a line that repeats counts each time; an empty table of texts or of licences gives no matches. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as the same, as (written, read).
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("sublicence", "sublicense"), ("http", "https"),
)

#: A canonical line names a holder if a year, "by" or nothing follows "copyright", or if it is short and does not go on as a
#: sentence of a licence does (fixed values: the words that follow "copyright" there, where a line may be wrapped).
RUNNING = (
    "also and are as claim disclaimer doctrines for holder holders if in interest interests is law laws license licenses like line notice notices of on or owner owners "
    "ownership patent permission protection rights statement statements those to treaty under you"
).split()
DATED = "^(portions )?copyright( copyright)*( [0-9]{4}.*| by .*|)$"
SHORT_LINE = "^(portions )?copyright( copyright)*( [^ ]+){1,8}$"
IN_TEXT = f"^(portions )?copyright( copyright)* ({'|'.join(RUNNING)}|the software)( |$)"

#: Long licences in full, one file each.
TEXTS = Path(__file__).parent / "license_texts"

#: Short licences in full, and usual one-line notices, as (name, unit, text).
SHORT = (
    ("MIT", "text", """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", "text", """ISC License
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", "text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", "text", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", "line", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "line", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "line", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "line", "Released under the MIT License."),
    ("MIT", "line", "Licensed under the MIT License."),
    ("CC-BY-4.0", "line", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "line", "Licensed under CC BY-SA 4.0."),
)

#: Titles that a licence text may have or lack.
TITLES = {
    "MIT": ("", "MIT", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT License (Expat)", "Expat License"),
    "ISC": ("", "ISC", "ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("", "0BSD", "BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "Zero-Clause BSD (0BSD)", "BSD Zero Clause License (0BSD)"),
    "Zlib": ("", "zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "The zlib/libpng License (Zlib)"),
    "BSD-2-Clause": ("", "BSD-2-Clause", "BSD License", "The BSD License", "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "FreeBSD License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("", "BSD-3-Clause", "BSD License", "The BSD License", "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", 'BSD 3-Clause "New" or "Revised" License'),
    "BSL-1.0": ("", "Boost Software License", "Boost Software License 1.0", "Boost Software License - Version 1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    "Unlicense": ("", "Unlicense", "The Unlicense"),
    "Apache-2.0": ("", "Apache License", "Apache License 2.0", "Apache License Version 2.0", "Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    "MPL-2.0": ("", "Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0"),
    "CC0-1.0": ("", "CC0 1.0 Universal", "Creative Commons Legal Code", "Creative Commons Legal Code CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"),
    "GPL-2.0": ("", "GNU General Public License", "GNU General Public License Version 2, June 1991"),
    "GPL-3.0": ("", "GNU General Public License", "GNU General Public License Version 3, 29 June 2007"),
    "LGPL-2.0": ("", "GNU Library General Public License", "GNU Library General Public License Version 2, June 1991"),
    "LGPL-2.1": ("", "GNU Lesser General Public License", "GNU Lesser General Public License Version 2.1, February 1999"),
    "LGPL-3.0": ("", "GNU Lesser General Public License", "GNU Lesser General Public License Version 3, 29 June 2007"),
}

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
{}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
{}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Who disclaims in the two places of a BSD text, and what its third clause may say.
_BSD_WHO = (
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDER OR CONTRIBUTORS"), ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDERS OR CONTRIBUTORS"),
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT OWNER OR CONTRIBUTORS"), ("REGENTS AND CONTRIBUTORS", "REGENTS OR CONTRIBUTORS"), ("AUTHOR AND CONTRIBUTORS", "AUTHOR OR CONTRIBUTORS"),
)
_BSD_THIRD = tuple(
    f"{who} may be used to endorse or promote products derived from this software without specific prior written permission.\n"
    for who in ("Neither the name of the copyright holder nor the names of its contributors", "Neither the name of the University nor the names of its contributors", "Neither the name of the author nor the names of its contributors", "The names of its contributors")
)

#: Places of the Free Software Foundation in its licences.
_FSF = (
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301, USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA", "675 Mass Ave, Cambridge, MA 02139, USA", "",
)


def _bodies(name: str) -> Iterator[str]:
    """The wordings of a licence without its title; each with and without what is often left off its end."""
    if name in ("MIT", "ISC", "0BSD", "Zlib"):
        text = next(t for n, unit, t in SHORT if n == name and unit == "text")
        body = text.split("\n", 1)[1] if name in ("MIT", "ISC") else text
        yield body
        if name == "MIT":
            yield body.replace("this permission notice shall", "this permission notice (including the next paragraph) shall")
        if name in ("ISC", "0BSD"):
            yield body.replace("modify, and/or distribute", "modify, and distribute")
    elif name in ("BSD-2-Clause", "BSD-3-Clause"):
        for marks, who, third in product((("1. ", "2. ", "3. "), ("", "", "")), _BSD_WHO, _BSD_THIRD if name == "BSD-3-Clause" else [""]):
            yield _BSD.format(*marks[:2], third and marks[2] + third, *who)
    else:
        text = (TEXTS / f"{name}.txt").read_text()
        if "GPL" in name:
            text = text[text.index("Everyone is permitted") :]
            ends = [text] + [text[: m.start()] for m in re.finditer(r"END OF TERMS AND CONDITIONS|How to Apply These Terms", text)]
            heads = [""] if name in ("GPL-3.0", "LGPL-3.0") else _FSF
            for place, end in product(heads, ends):
                yield f"{place}\n" + re.sub(r"51 Franklin Street, Fifth Floor, Boston,\s+MA\s+02110-1301\s+USA", place or _FSF[0], end)
        elif name == "Apache-2.0":
            text = text[text.index("TERMS AND CONDITIONS FOR USE") :]
            yield text
            yield text.replace("Copyright [yyyy] [name of copyright owner]", "")  # filled in, the line names a holder and goes
            yield from (text[: text.index(end)] for end in ("END OF TERMS", "APPENDIX:"))
        elif name == "MPL-2.0":
            text = text[text.index("1. Definitions") :]
            yield from [text] + [text[: text.rindex(end)] for end in ("Exhibit A -", "Exhibit B -")]
        elif name == "CC0-1.0":
            yield from (text[text.index(begin) :] for begin in ("CREATIVE COMMONS CORPORATION IS NOT", "Statement of Purpose"))
        elif name == "Unlicense":
            yield from (text, text[: text.index("For more information")])
        else:
            yield text[text.index("Permission is hereby granted") :]


#: All known licences and notices, as (name, unit, text): every wording under every title.
KNOWN = SHORT + tuple((name, "text", f"{title}\n{body}") for name, titles in TITLES.items() for body in _bodies(name) for title in titles)


def with_lines(df: DataFrame) -> DataFrame:
    """``df`` with ``lines``: what is left of ``text``, canonical, in order. Words stand between two spaces each, so that neighbours are replaced alike.

    The steps are columns of their own, as each is used more than once. Spellings are only replaced in texts that have one of them.
    """
    t = F.lower(F.coalesce("text", F.lit("")))
    t = F.replace(F.replace(t, F.lit("(c)"), F.lit(" copyright ")), F.lit("©"), F.lit(" copyright "))
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", "  ")
    t = F.concat(F.lit(" "), F.replace(t, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    read = F.col("flat")
    for written, instead in EQUIVALENT:
        read = F.replace(read, F.lit(f" {written} "), F.lit(f" {instead} "))
    some = F.col("flat").rlike(f" (?:{'|'.join(written for written, _ in EQUIVALENT)}) ")
    lines = F.transform(F.split("spelled", "\n"), lambda x: F.replace(F.trim(x), F.lit("  "), F.lit(" ")))
    named = lambda x: F.startswith(x, F.lit("copyright")) | F.startswith(x, F.lit("portions copyright"))
    holder = lambda x: F.startswith(x, F.lit("spdx ")) | (named(x) & (x.rlike(DATED) | (x.rlike(SHORT_LINE) & ~x.rlike(IN_TEXT))))
    df = df.withColumn("flat", t).withColumn("spelled", F.when(some, read).otherwise(F.col("flat")))
    return df.withColumn("lines", F.filter(lines, lambda x: (x != "") & (x != "all rights reserved") & ~holder(x)))


def digests(lines: Column) -> Column:
    """``unit, digest`` of the whole text and of each line."""
    whole = F.array(F.struct(F.lit("text").alias("unit"), F.md5(F.array_join(lines, " ")).alias("digest")))
    each = F.transform(lines, lambda x: F.struct(F.lit("line").alias("unit"), F.md5(x).alias("digest")))
    return F.when(F.size(lines) > 0, F.concat(whole, each))


def known(spark: SparkSession) -> DataFrame:
    """``name, unit, text`` of the licences and notices that come with this module; any table of this form will do."""
    return spark.createDataFrame(list(KNOWN), "name string, unit string, text string")


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """``doc_id, text_digest, license, n_notices, notices``: the licence whose text the document is, and the names of the notices among its lines."""
    table = with_lines(licenses.select("name", "unit", "text")).select("name", "unit", F.explode(digests(F.col("lines"))).alias("d")).where("d.unit = unit")
    table = table.groupBy("unit", F.col("d.digest").alias("digest")).agg(F.min("name").alias("name"))
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    units = with_lines(rows).select("row", "doc_id", F.explode_outer(digests(F.col("lines"))).alias("d"))
    found = units.select("row", "doc_id", F.col("d.unit").alias("unit"), F.col("d.digest").alias("digest")).join(table, ["unit", "digest"], "left")
    whole, line = F.col("unit") == "text", (F.col("unit") == "line") & F.col("name").isNotNull()
    sums = found.groupBy("row", "doc_id").agg(
        F.max(F.when(whole, F.col("digest"))).alias("text_digest"), F.max(F.when(whole, F.col("name"))).alias("license"),
        F.sum(line.cast("long")).alias("n_notices"), F.array_join(F.sort_array(F.collect_set(F.when(line, F.col("name")))), ",").alias("notices"),
    )
    return sums.select("doc_id", "text_digest", "license", F.coalesce("n_notices", F.lit(0)).alias("n_notices"), "notices")
