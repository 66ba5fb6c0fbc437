"""Licence scans (operator 1): known sentences become identifiers, and identifier sequences are matched against rules.

A text is cut into sentences: at full stops, exclamation or question marks before a blank, at blank lines (also those of
comments), at colons and semicolons that end a line, and before numbered points.  Other line ends do not cut, so that
wrapped text is read as it was meant.  A sentence is normalised to lower-case ASCII words and figures with single spaces.  If it is no known
sentence as a whole, each of its lines is looked up by itself.  The identifiers found, in order, are the text's sequence.  A rule
matches where its identifiers follow one another in the sequence; the longest rules match first and consume what they
match.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of published licences and of the notices by which a file refers to one.
SENTENCES = {
    "apache2-short": "licensed under the apache license version 2 0",
    "apache2-grant": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache2-notice": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-url": "http www apache org licenses license 2 0",
    "apache2-https": "https www apache org licenses license 2 0",
    "apache2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-keep-next": "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-no-event": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit0-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "gpl3-short": "this work is licensed under the gnu general public license version 3",
    "gpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "gpl-received-url": "you should have received a copy of the gnu general public license along with this program if not see https www gnu org licenses",
    "gpl-received-http": "you should have received a copy of the gnu general public license along with this program if not see http www gnu org licenses",
    "gpl-received-mail": "you should have received a copy of the gnu general public license along with this program if not write to the free software foundation inc 51 franklin street fifth floor boston ma 02110 1301 usa",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "lgpl-received": "you should have received a copy of the gnu lesser general public license along with this library",
    "lgpl-received-url": "you should have received a copy of the gnu lesser general public license along with this library if not see https www gnu org licenses",
    "lgpl-received-mail": "you should have received a copy of the gnu lesser general public license along with this library if not write to the free software foundation inc 51 franklin street fifth floor boston ma 02110 1301 usa",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-see": "see the gnu affero general public license for more details",
    "agpl-received": "you should have received a copy of the gnu affero general public license along with this program",
    "agpl-received-url": "you should have received a copy of the gnu affero general public license along with this program if not see https www gnu org licenses",
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2-subject-v": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl2-copy-https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-no-event": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "bsd-forms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-no-event": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "unlicense-law": "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain",
    "cc0-waiver": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "cc0-no-warranty": "this software is distributed without any warranty",
    "cc0-short": "this work is marked with cc0 1 0",
    "ccby4-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccby4-the": "this work is licensed under the creative commons attribution 4 0 international license",
    "ccby4-short": "licensed under cc by 4 0",
    "ccbysa4-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "ccbysa4-short": "licensed under cc by sa 4 0",
    "ccbync4-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "ccbync4-short": "licensed under cc by nc 4 0",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-no-event": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
}
# Rules; where two match the same place the one with more sentences does.
RULES = (
    ("Apache-2.0", ("apache2-grant", "apache2-copy", "apache2-url", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-grant", "apache2-copy", "apache2-https", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-short", "apache2-notice")),
    ("Apache-2.0", ("apache2-grant",)),
    ("Apache-2.0", ("apache2-short",)),
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is", "mit-no-event")),
    ("MIT", ("mit-grant", "mit-keep-next", "mit-as-is", "mit-no-event")),
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-keep")),
    ("MIT", ("mit-short",)),
    ("MIT-0", ("mit0-grant", "mit-as-is", "mit-no-event")),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is", "bsd-no-event")),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-no-event")),
    ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary")),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope", "agpl-see")),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free", "lgpl-hope", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("LGPL-2.1-or-later", ("lgpl21-free", "lgpl-hope", "lgpl-see")),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("GPL-3.0-or-later", ("gpl3-free", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl3-free",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-2.0-only", ("gpl2-only", "gpl-hope", "gpl-see")),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("MPL-2.0", ("mpl2-subject", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-subject", "mpl2-copy-https")),
    ("MPL-2.0", ("mpl2-subject-v", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-subject-v", "mpl2-copy-https")),
    ("MPL-2.0", ("mpl2-subject",)),
    ("ISC", ("isc-grant", "isc-as-is", "isc-no-event")),
    ("ISC", ("isc-grant-and", "isc-as-is", "isc-no-event")),
    ("0BSD", ("0bsd-grant", "isc-as-is", "isc-no-event")),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("Unlicense", ("unlicense-free",)),
    ("CC0-1.0", ("cc0-waiver", "cc0-no-warranty")),
    ("CC0-1.0", ("cc0-waiver",)),
    ("CC0-1.0", ("cc0-short",)),
    ("CC-BY-4.0", ("ccby4-long",)),
    ("CC-BY-4.0", ("ccby4-the",)),
    ("CC-BY-4.0", ("ccby4-short",)),
    ("CC-BY-SA-4.0", ("ccbysa4-long",)),
    ("CC-BY-SA-4.0", ("ccbysa4-short",)),
    ("CC-BY-NC-4.0", ("ccbync4-long",)),
    ("CC-BY-NC-4.0", ("ccbync4-short",)),
    ("Zlib", ("zlib-as-is", "zlib-no-event", "zlib-grant")),
)
# Titles of licences in notices of use, and the notices.
TITLES = {
    "MIT": ("mit license", "the mit license", "mit"),
    "Apache-2.0": ("apache license 2 0", "apache license version 2 0", "apache 2 0 license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "ISC": ("isc license",),
    "MPL-2.0": ("mozilla public license 2 0", "mozilla public license version 2 0"),
    "GPL-3.0-only": ("gnu general public license version 3", "gnu general public license v3 0", "gnu gpl v3"),
    "Unlicense": ("unlicense",),
}
NOTICES = ("licensed under the {}", "released under the {}", "distributed under the {}", "this project is licensed under the {}", "this software is licensed under the {}", "this library is licensed under the {}", "this project is released under the {}", "this work is licensed under the {}")
#: The third BSD condition as it names a party: what begins so, and what follows where the party's name holds a stop.
PARTY, PARTY_ID = "neither the name of ", "bsd-names-party"


def _by_rule() -> tuple[dict[str, str], list]:
    """Sentences that follow from a rule: notices of use with every title, and SPDX identifiers of all licences."""
    sentences, rules, known = {}, [], set(SENTENCES.values())
    for name, titles in TITLES.items():
        for text in dict.fromkeys(n.format(t) for t in titles for n in NOTICES):
            if text not in known:
                sentences[f"use-{name}-{len(sentences)}"] = text
                rules.append((name, (f"use-{name}-{len(sentences) - 1}",)))
    for name in dict.fromkeys(n for n, _ in RULES):
        sentences[f"spdx-{name}"] = "spdx license identifier " + " ".join(re.split("[^a-z0-9]+", name.lower()))
        rules.append((name, (f"spdx-{name}",)))
    return sentences, rules


SENTENCES["bsd-names-tail"] = "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
SENTENCES["apache2-head"] = "apache license version 2 0 january 2004 http www apache org licenses"
_more = _by_rule()
SENTENCES |= _more[0]
RULES = (
    *RULES,
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", PARTY_ID, "bsd-names-tail")),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", PARTY_ID)),
    ("Apache-2.0", ("apache2-head",)),
    *_more[1],
)
#: Every known sentence holds one of these, and normalisation only puts blanks between words: a text without any has none.
MARKS = ("licen", "neither", "released", "distribut", "software", "copy", "warrant", "cc0")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sentence ends, which become one control character: marks before a blank, blank lines, line-end colons, numbered points.
ENDS = r"[.!?]+([ \t\r\n]|\z)|\n[^A-Za-z0-9\n]*\n|:[ \t\r]*\n|\n[^A-Za-z0-9\n]*[0-9a-z][.)][ \t]"
CUT, NOISE, JOIN = "\x01", r"[^a-z0-9\n\x01]+", r"[ \n]+"


def _ordered(rules) -> list[tuple[str, str]]:
    """Name and sequence of each rule, longest first."""
    return [(name, "".join(f"<{k}>" for k in ids)) for name, ids in sorted(rules, key=lambda r: -len(r[1]))]


def identifiers(text: Column) -> Column:
    """Array of the identifiers of the known sentences of a text, in order."""
    known = F.create_map(*[F.lit(x) for k, v in SENTENCES.items() for x in (v, k)])
    plain = F.regexp_replace(F.translate(F.regexp_replace(text, ENDS, CUT), UPPER, LOWER), NOISE, " ")
    look = lambda s: F.coalesce(F.try_element_at(known, F.trim(s)), F.when(F.startswith(F.ltrim(s), F.lit(PARTY)), PARTY_ID))
    whole = lambda s: F.array(look(F.regexp_replace(s, JOIN, " ")))
    lines = lambda s: F.transform(F.split(s, "\n", -1), look)
    of_sentence = lambda s: F.flatten(F.transform(whole(s), lambda k: F.when(k.isNotNull(), F.array(k)).otherwise(lines(s))))
    found = F.flatten(F.transform(F.split(plain, CUT, -1), lambda s: F.when(F.contains(s, F.lit("\n")), of_sentence(s)).otherwise(F.array(look(s)))))
    marked = reduce(Column.__or__, [F.contains(F.lower(text), F.lit(m)) for m in MARKS])
    return F.when(marked, F.filter(found, lambda k: k.isNotNull())).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sentence_ids, licences, licence, n_sentences) for each row.

    sentence_ids: the sequence, joined by one space.  licences: names of all rules that match, in rule order without
    repeats, joined by commas.  licence: the first of them, null if none.  Of rules with as many sentences the first in the
    list matches first.  A null or empty text has an empty sequence.  Repeated rows each give a row; further columns are left
    out; an empty table gives no row.
    """
    rows = docs.select(F.col(key), identifiers(F.coalesce(F.col(text), F.lit(""))).alias("ids"))
    # Each rule marks what it matches with its number, so that no shorter one finds it again.
    line = F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">"))
    for k, (_, ids) in enumerate(_ordered(rules)):
        line = F.replace(line, F.lit(ids), F.lit(f"[{k}]"))
    rows = rows.withColumn("line", F.when(F.size("ids") > 0, line))
    names = list(dict.fromkeys(name for name, _ in rules))
    hit = lambda name: reduce(Column.__or__, [F.contains("line", F.lit(f"[{k}]")) for k, (n, _) in enumerate(_ordered(rules)) if n == name])
    rows = rows.withColumn("names", F.when(F.col("line").isNotNull(), F.array_compact(F.array(*[F.when(hit(n), F.lit(n)) for n in names]))).otherwise(F.array().cast("array<string>")))
    return rows.select(key, F.array_join("ids", " ").alias("sentence_ids"), F.array_join("names", ",").alias("licences"), F.try_element_at("names", F.lit(1)).alias("licence"), F.size("ids").alias("n_sentences"))


def oracle() -> str:
    """The scan as SQL over documents."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    table = "MAP {" + ", ".join(f"{quote(v)}: {quote(k)}" for k, v in SENTENCES.items()) + "}"
    known = lambda s: f"coalesce(({table})[{s}], CASE WHEN starts_with({s}, {quote(PARTY)}) THEN {quote(PARTY_ID)} END)"
    line = "'<' || array_to_string(ids, '><') || '>'"
    for k, (_, ids) in enumerate(_ordered(RULES)):
        line = f"replace({line}, {quote(ids)}, '[{k}]')"
    hits = ", ".join(
        f"CASE WHEN {' OR '.join(f'contains(line, {quote(f"[{k}]")})' for k, (n, _) in enumerate(_ordered(RULES)) if n == name)} THEN {quote(name)} END"
        for name in dict.fromkeys(n for n, _ in RULES)
    )
    return f"""
        WITH cut AS (
            SELECT doc_id, unnest(list_transform(string_split(regexp_replace(translate(regexp_replace(coalesce(text, ''), '{ENDS}', chr(1), 'g'), '{UPPER}', '{LOWER}'), '{NOISE}', ' ', 'g'), chr(1)), lambda s, i: {{'s': s, 'i': i}})) AS part
            FROM documents
        ), whole AS (
            SELECT doc_id, part.i AS place, part.s AS s, {known("trim(regexp_replace(part.s, '" + JOIN + "', ' ', 'g'))")} AS id FROM cut
        ), lines AS (
            SELECT doc_id, place, unnest(list_transform(string_split(s, chr(10)), lambda s, i: {{'s': s, 'i': i}})) AS part FROM whole WHERE id IS NULL
        ), found AS (
            SELECT doc_id, place, 0 AS line, id FROM whole WHERE id IS NOT NULL
            UNION ALL SELECT * FROM (SELECT doc_id, place, part.i, {known("trim(part.s)")} AS id FROM lines) WHERE id IS NOT NULL
        ), sequences AS (SELECT doc_id, list(id ORDER BY place, line) AS ids FROM found GROUP BY doc_id
        ), lined AS (SELECT *, {line} AS line FROM sequences
        ), named AS (SELECT *, list_filter([{hits}], lambda n: n IS NOT NULL) AS names FROM lined)
        SELECT d.doc_id, coalesce(array_to_string(ids, ' '), '') AS sentence_ids, coalesce(array_to_string(names, ','), '') AS licences, names[1] AS licence, CAST(coalesce(len(ids), 0) AS INTEGER) AS n_sentences
        FROM documents d LEFT JOIN named ON named.doc_id = d.doc_id
    """
