"""Licence scan: whole texts in a canonical form, hashed and joined to the digests of known licences.

The canonical form is lower case, without copyright lines, with runs of anything but letters and digits as one blank, and
with one of several equivalent spellings. It is made line by line, so the same pass serves two kinds of unit: a text
as a whole, and each of its lines, where licence notices stand. A unit matches if the whole of it does.

A unit is hashed without its blanks, but for those between digits, and with phrases of equal meaning made the same. So "sub-license" and
"sublicense", "per cent" and "percent", and a word that a hyphen splits at the end of a line are equal, and phrases may cross lines. Only a
word that is both spelt otherwise and split by a hyphen is not recognised.

A copyright line names a year, a holder or another mark. A licence's own words that happen to start a line with "copyright" or
"(c)", as in a text wrapped there, stay; so does a "(c)" with neither a year nor another mark, which could be a list item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.llm._shared import stored, whole_text, work_folder

#: Words that go on after "copyright" where a licence's text is wrapped there, not where somebody is named.
_BODY = (
    "notices?|holders?|owners?|ownership|laws?|licen[cs]es?|statements?|permissions?|protection|treaty|treaties|interests?|rights?|"
    "disclaimers?|doctrines?|status|terms?|infringements?|information|management|legends?|works?|and|or|on|in|to|for|is|are|as|of|at|"
    "that|which|if|unless|when|where|with|without|not|nor|under|also|like|does|resulting|the (?:software|library|program|work)|the[^\\p{L}\\p{N}]*$"
)
_MARK = r"[^\p{L}\p{N}]*(?:\d{4}\b|copyright\b|©|\(c\))"
#: Copyright lines: a mark with a year or another mark, a name after "copyright" or the sign, or the reservation of rights alone.
COPYRIGHT = (
    rf"(?i)^[^\p{{L}}\p{{N}}]*(?:©|copyright\b{_MARK}|\(c\){_MARK}"
    r"|\(c\).*\b(?:19|20)\d\d[^\p{L}\p{N}]*(?:all rights reserved[^\p{L}\p{N}]*)?$"
    rf"|copyright\b(?![^\p{{L}}\p{{N}}]*$|\s*[-,;.)\"”'’/]|[^\p{{L}}\p{{N}}]+(?:{_BODY})\b)"
    r"|all rights reserved[^\p{L}\p{N}]*$)"
)
OTHER = r"[^\p{L}\p{N}]+"

#: Spellings that count as the same word.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "catalogue": "catalog",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "http": "https",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

#: Phrases and parts of words that count as the same, without blanks.
PHRASES = {"copyrightholder": "copyrightowner", "licence": "license"}

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN "
    "NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)

#: Licences by SPDX identifier, whole texts first and then the notices that refer to them.
KNOWN: list[tuple[str, str]] = [
    (
        "MIT",
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS,
    ),
    (
        "ISC",
        "ISC License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_AS_IS,
    ),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_AS_IS),
    ("BSD-2-Clause", _BSD_CONDITIONS + _BSD_AS_IS),
    (
        "BSD-3-Clause",
        _BSD_CONDITIONS + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. " + _BSD_AS_IS,
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. "
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use "
        "this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
]


#: Folder of whole licence texts, named by SPDX identifier.
FILES = Path(__file__).parent / "known_licences"

#: Titles that a text may have or lack, and by which notices name the licence.
TITLES = {
    "MIT": ["MIT License", "MIT License (MIT)", "MIT/Expat License", "Expat License", "MIT"],
    "ISC": ["ISC License", "ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License", "Zero-Clause BSD", "0BSD", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License", "2-Clause BSD License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        'BSD 3-Clause "New" or "Revised" License',
        "New BSD License",
        "Modified BSD License",
        "Revised BSD License",
        "3-Clause BSD License",
    ],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "GPL-1.0-only": ["GNU General Public License, version 1", "GNU GPL v1"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3"],
    "LGPL-2.0-only": ["GNU Library General Public License, version 2"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPLv3"],
    "GFDL-1.2-only": ["GNU Free Documentation License, version 1.2"],
    "GFDL-1.3-only": ["GNU Free Documentation License, version 1.3"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
} | {
    f"CC-{kind}-{v}": [f"CC {kind} {v}", f"Creative Commons {name} {v} License", f"Creative Commons {name} {v} International License"][: 3 if v == "4.0" else 2]
    for kind, name in {
        "BY": "Attribution",
        "BY-SA": "Attribution-ShareAlike",
        "BY-ND": "Attribution-NoDerivatives",
        "BY-NC": "Attribution-NonCommercial",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
        "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    }.items()
    for v in ("2.0", "2.5", "3.0", "4.0")
}
_NOTICES = [
    f"{x} under"
    for x in ("Licensed", "Released", "Distributed", "Available", "Published")
    + tuple(f"This {x} is {y}" for x in ("work", "project", "software", "file", "program", "document") for y in ("licensed", "released", "distributed"))
]

#: Words of a body that others write in another way.
_VARIANTS = [
    (r"\b[123]\. ", "* "),
    ("modify, and/or distribute", "modify, and distribute"),
    ("the copyright holder nor", "the University nor"),
    ("the copyright holder nor", "the <organization> nor"),
]
#: Where the body begins below title and preface, and where the appendix on how to apply a licence begins.
_BODY_STARTS = r"(?m)^ *(?:TERMS AND CONDITIONS FOR USE|Preamble$|0\. PREAMBLE|1\. Definitions|Statement of Purpose|This version of the GNU Lesser)"
_APPENDICES = r"(?m)^ *(?:APPENDIX: How to|How to Apply These Terms|Appendix: How to Apply|ADDENDUM: How to|Exhibit A|EXHIBIT A)"
_END = r"(?m)^ *END OF TERMS AND CONDITIONS *$"
_ADDRESS = r"51 Franklin St(?:reet)?, Fifth Floor, Boston,? MA +02110-1301 +USA|<https://fsf.org/>"
_ADDRESSES = [
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA",
    "675 Mass Ave, Cambridge, MA 02139, USA",
    "<https://fsf.org/>",
    "",
]


def _bodies() -> Iterator[tuple[str, str]]:
    """Short licences without a title, in all wordings."""
    for name, text in KNOWN:
        if "\n" in text or len(text) > 200:
            bodies = [text.split("\n")[-1]]
            for old, new in _VARIANTS:
                bodies += [re.sub(old, lambda _, new=new: new, b) for b in bodies if re.search(old, b)]
            yield from ((name, b) for b in bodies)


def _file_texts(name: str, text: str) -> Iterator[tuple[str, str]]:
    """A long licence with and without its title and appendix, and with each postal address."""
    start = re.search(_BODY_STARTS, text)
    texts = [text, text[start.start() :]] if start else [text]
    if name == "CC0-1.0":
        texts.append("CC0 1.0 Universal\n" + texts[1])
    for t in list(texts):
        cuts = [m.start() for m in re.finditer(_APPENDICES, t)] + [m.start() for m in re.finditer(_END, t)] + [m.end() for m in re.finditer(_END, t)]
        texts += [t[:cut] for cut in cuts]
    for t in texts:
        yield name, t
        if re.search(_ADDRESS, re.sub("(?m)^ *Copyright.*", "", t)):
            yield from ((name, re.sub(_ADDRESS, a, t)) for a in _ADDRESSES)


def known_texts() -> list[tuple[str, str, bool]]:
    """All known ``(licence, text, whole_only)``; those of ``whole_only`` do not count as notices."""
    found = [(*k, False) for k in KNOWN]
    bodies = list(_bodies())
    for path in sorted(FILES.glob("*.txt")):
        text = path.read_text("utf-8")
        found += [(*k, True) for k in _file_texts(path.stem, text)]
        bodies += [(path.stem, text)] if path.stem == "Unlicense" else []
    for name, body in bodies:
        titles = [x for t in TITLES[name] for x in (t, f"The {t}")]
        titles += ["BSD License", "The BSD License"] if name.startswith("BSD") else []
        found += [(name, f"{title}\n{body}", True) for title in ["", *titles]]
    for name, titles in TITLES.items():
        found.append((name, f"SPDX-License-Identifier: {name}", False))
        found += [(name, f"{lead} {the}{t}", False) for lead in _NOTICES for the in ("", "the ", "a ") for t in titles]
    return found


def canonical_line(line: Column) -> Column:
    """The canonical form of one line; empty for copyright lines and lines without letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(line), OTHER, " "))
    other = r"\b(?:" + "|".join(SPELLINGS) + r")\b"
    same = reduce(lambda x, w: F.regexp_replace(x, rf"\b{w[0]}\b", w[1]), SPELLINGS.items(), plain)
    return F.when(line.rlike(COPYRIGHT), "").when(plain.rlike(other), same).otherwise(plain)


def canonical_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), canonical_line), lambda x: x != "")


def digest(canonical: Column) -> Column:
    """The digest of canonical lines, joined by blanks."""
    joined = F.translate(F.regexp_replace(canonical, r"(\p{N}) (?=\p{N})", "$1."), " ", "")
    same = reduce(lambda x, w: F.replace(x, F.lit(w[0]), F.lit(w[1])), PHRASES.items(), joined)
    return F.unhex(F.sha2(same, 256))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``licence, digest, whole_only`` of known licence texts; of equal texts the first name counts.

    ``known`` replaces the texts of ``known_texts()``; each of its texts may also be a line.
    """
    rows = [(i, *k) for i, k in enumerate(known_texts() if known is None else [(*k, False) for k in known])]
    texts = spark.createDataFrame(rows, "i int, licence string, text string, whole_only boolean")
    texts = texts.select("i", "licence", "whole_only", F.array_join(canonical_lines(F.col("text")), " ").alias("c")).where("c != ''")
    same = texts.groupBy(digest(F.col("c")).alias("digest"))
    return same.agg(F.min_by("licence", "i").alias("licence"), F.min("whole_only").alias("whole_only"))


def scan(
    docs: DataFrame,
    known: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_broadcast_rows: int = 200_000,
    work: str | None = None,
) -> DataFrame:
    """Per input row ``id, text_hash, licence, notices, n_notices``.

    ``licence`` is the licence that the whole text is, or NULL; ``notices`` are the sorted licences that whole lines of it are,
    ``n_notices`` the number of such lines. ``known`` has columns ``licence, digest`` and, if some texts
    are not to count as lines, ``whole_only``; it is broadcast if it has
    ``max_broadcast_rows`` or fewer, and joined by a shuffle on the digest beyond that.

    NULL and empty texts, and those of copyright lines alone, have none. Repeated rows get the same result each; rows with the
    same id and other texts are told apart by ``text_hash``. An empty table gives an empty result. Other columns are ignored.
    """
    work = work_folder(docs.sparkSession, work)
    known = stored(known_digests(docs.sparkSession) if known is None else known, f"{work}/known")
    known = known if "whole_only" in known.columns else known.withColumn("whole_only", F.lit(False))
    known = F.broadcast(known) if known.count() <= max_broadcast_rows else known
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("t"))
    lines = rows.select("id", F.xxhash64("t").alias("text_hash"), canonical_lines(F.col("t")).alias("lines"))
    whole = F.struct(F.lit(True).alias("whole"), digest(F.array_join("lines", " ")).alias("digest"))
    units = F.concat(F.array(whole), F.transform("lines", lambda x: F.struct(F.lit(False).alias("whole"), digest(x).alias("digest"))))
    units = lines.select("id", "text_hash", F.posexplode(units).alias("k", "u")).select("id", "text_hash", "k", "u.whole", "u.digest")
    hits = units.join(known, "digest").where(F.col("whole") | ~F.col("whole_only")).select("id", "text_hash", "k", "whole", "licence")
    found = hits.groupBy("id", "text_hash").agg(
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
        F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("licence")))).alias("notices"),
        F.countDistinct(F.when(~F.col("whole"), F.col("k"))).alias("n_notices"),
    )
    found = stored(found, f"{work}/found").select(
        F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "licence", "notices", "n_notices"
    )
    keys = rows.select("id", F.xxhash64("t").alias("text_hash"))
    out = keys.join(found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    return out.select(
        "id",
        "text_hash",
        "licence",
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"),
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
    )
