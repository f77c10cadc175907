"""Licence scan by canonical digests.

A text is made canonical: A-Z folded, copyright lines left out, equivalent spellings made one, all marks and blanks
between words made one blank. The digest of the whole canonical text, and of each line of the document taken as a
text of its own (licence notices), is looked up among the digests of known licences by a hash join.

The known texts (``license`` and ``body``, or ``digest`` of a canonical form) are a parameter; the default is the small fixed
table below, so the broadcast is bounded. A document's
units stay inside one task until only the matching ones are left; one row per document and task is shuffled.

Defined cases: null counts as empty; an empty text has no licence; a line that is empty or a copyright line matches
nothing; of a licence known under more than one name the smallest counts; repeated rows (same id and text) are one document;
only the id and text columns are used.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpanel.llm.common import ascii_lower

COPYRIGHT = r"^[ \t\r]*(copyright|\(c\)|©|all rights reserved)"
#: A line that starts so is prose of a licence, wrapped before the word "copyright", or the item (c) of one of its lists.
PROSE = (
    r"^[ \t\r]*(copyrighted |copyright[ \t]+(holder|owner|notice|law|interest|license|licence|and |or |in |on )"
    r"|\(c\)[ \t]+(you must |the licen[sc]e|under |representations))"
)
#: Spellings that count as one (fixed values): pattern and replacement, after folding.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("https:", "http:"),
    ("merchantibility", "merchantability"), ("organisation", "organization"),
]
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Licence notices of one line (fixed values).
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC0-1.0": ["Released under CC0 1.0."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License."],
}

#: Titles that may stand above a whole text; it is known without any as well (fixed values).
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "MIT-0": ["MIT No Attribution", "MIT No Attribution License", "MIT-0"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero Clause BSD License", "0BSD"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}

#: Numbers of conditions that a text may have or not, as it may have marks in their place (fixed values).
NUMBERED = re.compile(r"^ *[1-4]\. ", re.MULTILINE)

#: Whole licence texts without their titles (fixed values).
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>""",
}

#: Digests of the canonical forms of long texts (fixed values): as published and, where more follows the terms, up to the line that
#: ends them and up to the line before; of MPL-2.0 without its exhibits.
LONG_TEXTS = {
    "Apache-2.0": [
        "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",
        "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a",
        "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0",
    ],
    "CC0-1.0": [
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    ],
    "GFDL-1.2": [
        "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60",
    ],
    "GFDL-1.3": [
        "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826",
    ],
    "GPL-1.0": [
        "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
        "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70",
        "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",
    ],
    "GPL-2.0": [
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
    ],
    "GPL-3.0": [
        "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
        "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191",
        "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636",
    ],
    "LGPL-2.0": [
        "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
        "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",
        "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",
    ],
    "LGPL-2.1": [
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
    ],
    "LGPL-3.0": [
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ],
    "MPL-1.1": [
        "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b",
    ],
    "MPL-2.0": [
        "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",
        "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de",
    ],
}


def known_bodies() -> list[tuple[str, str]]:
    """Name and text of all notices, and of all whole texts with each of their titles or none, and with or without numbers."""
    rows = [(name, body) for name, bodies in NOTICES.items() for body in bodies]
    for name, text in TEXTS.items():
        for body in dict.fromkeys([text, NUMBERED.sub("", text)]):
            rows += [(name, body)] + [(name, f"{title}\n\n{body}") for title in TITLES[name]]
    return rows


def known_digests() -> list[tuple[str, str]]:
    """Name and canonical digest of the long texts."""
    return [(name, digest) for name, digests in LONG_TEXTS.items() for digest in digests]


def known_licenses(spark: SparkSession) -> DataFrame:
    """The default table: ``license`` and either ``body``, of notices and whole texts, or ``digest``, of long texts."""
    rows = [(name, body, None) for name, body in known_bodies()] + [(name, None, digest) for name, digest in known_digests()]
    return spark.createDataFrame(rows, "license string, body string, digest string")


def is_copyright(line: Column) -> Column:
    return line.rlike(COPYRIGHT) & ~line.rlike(PROSE)


def canonical(lines: Column) -> Column:
    """The canonical form of a text given as its folded lines."""
    kept = F.filter(lines, lambda x: ~is_copyright(x))
    return canonical_words(F.array_join(kept, "\n"))


def canonical_words(text: Column) -> Column:
    for found, instead in SPELLINGS:
        text = F.replace(text, F.lit(found), F.lit(instead))
    return F.trim(F.regexp_replace(text, MARKS, " "))


def folded_lines(text: Column) -> Column:
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n")


def license_scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``license`` of the whole text (or null), ``n_notices`` and ``notices`` (sorted names),
    and ``canonical_sha256``, the digest of the whole canonical text."""
    known = known_licenses(docs.sparkSession) if known is None else known
    digest = F.sha2(canonical(folded_lines(F.col("body"))), 256)
    if "digest" in known.columns:
        digest = F.coalesce("digest", digest)
    table = (
        known.select("license", digest.alias("known_digest"))
        .groupBy("known_digest").agg(F.min("license").alias("found"))
    )
    units = (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        .select("id", F.xxhash64("text").alias("code"), folded_lines(F.col("text")).alias("lines"))
        .select("id", "code", F.concat(F.array(canonical(F.col("lines"))), "lines").alias("units"))
        .select("id", "code", F.posexplode("units").alias("place", "unit"))
        .withColumn("whole", F.col("place") == 0)
        .withColumn("unit", F.when(F.col("whole"), F.col("unit")).when(~is_copyright(F.col("unit")), canonical_words(F.col("unit"))))
        .withColumn("digest", F.when(F.col("whole") | (F.col("unit") != ""), F.sha2("unit", 256)))
    )
    found = units.join(F.broadcast(table), F.col("digest") == F.col("known_digest"), "left").where("whole or found is not null")
    line = F.when(~F.col("whole"), F.col("found"))
    return (
        found.groupBy("id", "code")
        .agg(
            F.max(F.when(F.col("whole"), F.col("found"))).alias("license"),
            F.collect_set(F.when(~F.col("whole"), F.col("place"))).alias("places"),
            F.array_sort(F.collect_set(line)).alias("names"),
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("canonical_sha256"),
        )
        .select(
            F.col("id").alias(id_col), "license", F.size("places").cast("long").alias("n_notices"),
            F.array_join("names", ",").alias("notices"), "canonical_sha256",
        )
    )
