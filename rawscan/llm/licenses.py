"""License scans by sentence-rule recognition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of licences, normalised as sentences are (lower case, runs of other characters than a-z 0-9 are one
# space), and their identifiers. Names of other versions are not among them, so that they are not taken for these.
NAMES = {
    "mit": "MIT", "mit license": "MIT", "expat license": "MIT", "x11 license": "X11", "isc": "ISC", "isc license": "ISC",
    "apache 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0", "apache license version 2 0": "Apache-2.0", "apache software license 2 0": "Apache-2.0", "apache 2 0 license": "Apache-2.0",
    "apache license v2 0": "Apache-2.0", "apache license version 1 1": "Apache-1.1",
    "bsd 2 clause": "BSD-2-Clause", "bsd 2 clause license": "BSD-2-Clause", "2 clause bsd license": "BSD-2-Clause", "simplified bsd license": "BSD-2-Clause", "bsd 2 clause simplified license": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause", "bsd 3 clause license": "BSD-3-Clause", "3 clause bsd license": "BSD-3-Clause", "new bsd license": "BSD-3-Clause", "modified bsd license": "BSD-3-Clause", "bsd 3 clause new or revised license": "BSD-3-Clause",
    "0bsd": "0BSD", "bsd zero clause license": "0BSD",
    "gpl 2 0 only": "GPL-2.0-only", "gpl 2 0": "GPL-2.0-only", "gplv2": "GPL-2.0-only", "gnu gplv2": "GPL-2.0-only", "gnu general public license version 2": "GPL-2.0-only", "gnu general public license v2 0": "GPL-2.0-only",
    "gpl 2 0 or later": "GPL-2.0-or-later", "gplv2 or later": "GPL-2.0-or-later", "gnu general public license version 2 or later": "GPL-2.0-or-later",
    "gpl 3 0 only": "GPL-3.0-only", "gpl 3 0": "GPL-3.0-only", "gplv3": "GPL-3.0-only", "gnu gplv3": "GPL-3.0-only", "gnu general public license version 3": "GPL-3.0-only", "gnu general public license v3 0": "GPL-3.0-only",
    "gpl 3 0 or later": "GPL-3.0-or-later", "gplv3 or later": "GPL-3.0-or-later", "gnu general public license version 3 or later": "GPL-3.0-or-later",
    "lgpl 2 1 only": "LGPL-2.1-only", "lgpl 2 1": "LGPL-2.1-only", "lgplv2 1": "LGPL-2.1-only", "gnu lesser general public license version 2 1": "LGPL-2.1-only",
    "lgpl 2 1 or later": "LGPL-2.1-or-later", "lgpl 3 0 only": "LGPL-3.0-only", "lgpl 3 0": "LGPL-3.0-only", "lgplv3": "LGPL-3.0-only", "gnu lesser general public license version 3": "LGPL-3.0-only", "lgpl 3 0 or later": "LGPL-3.0-or-later",
    "agpl 3 0 only": "AGPL-3.0-only", "agpl 3 0": "AGPL-3.0-only", "agplv3": "AGPL-3.0-only", "gnu affero general public license version 3": "AGPL-3.0-only", "agpl 3 0 or later": "AGPL-3.0-or-later",
    "mpl 2 0": "MPL-2.0", "mozilla public license version 2 0": "MPL-2.0", "mozilla public license v 2 0": "MPL-2.0", "mozilla public license 2 0": "MPL-2.0", "mpl 1 1": "MPL-1.1", "mozilla public license version 1 1": "MPL-1.1",
    "epl 2 0": "EPL-2.0", "eclipse public license 2 0": "EPL-2.0", "eclipse public license v 2 0": "EPL-2.0", "eclipse public license version 2 0": "EPL-2.0", "epl 1 0": "EPL-1.0", "eclipse public license v1 0": "EPL-1.0", "eclipse public license v 1 0": "EPL-1.0",
    "cddl 1 0": "CDDL-1.0", "common development and distribution license 1 0": "CDDL-1.0", "cpl 1 0": "CPL-1.0", "common public license 1 0": "CPL-1.0",
    "unlicense": "Unlicense", "wtfpl": "WTFPL", "zlib": "Zlib", "zlib license": "Zlib", "bsl 1 0": "BSL-1.0", "boost software license version 1 0": "BSL-1.0", "boost software license 1 0": "BSL-1.0",
    "artistic 2 0": "Artistic-2.0", "artistic license 2 0": "Artistic-2.0", "ofl 1 1": "OFL-1.1", "sil open font license version 1 1": "OFL-1.1", "postgresql": "PostgreSQL", "postgresql license": "PostgreSQL",
    "eupl 1 2": "EUPL-1.2", "european union public licence version 1 2": "EUPL-1.2", "ms pl": "MS-PL", "microsoft public license": "MS-PL", "python 2 0": "Python-2.0", "psf 2 0": "PSF-2.0",
    "cc0 1 0": "CC0-1.0", "cc0 1 0 universal": "CC0-1.0", "cc by 4 0": "CC-BY-4.0", "creative commons attribution 4 0 international license": "CC-BY-4.0", "creative commons attribution 4 0 international": "CC-BY-4.0",
    "cc by sa 4 0": "CC-BY-SA-4.0", "creative commons attribution sharealike 4 0 international license": "CC-BY-SA-4.0", "cc by nc 4 0": "CC-BY-NC-4.0", "creative commons attribution noncommercial 4 0 international license": "CC-BY-NC-4.0",
    "cc by nc sa 4 0": "CC-BY-NC-SA-4.0", "cc by nd 4 0": "CC-BY-ND-4.0", "cc by 3 0": "CC-BY-3.0", "creative commons attribution 3 0 unported license": "CC-BY-3.0", "cc by sa 3 0": "CC-BY-SA-3.0",
}
# Known sentences of licences and their notices, normalised; HOLDER stands for any name.
HOLDER = "holder"
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so": "mit-grant-0",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "except as contained in this notice the name of holder shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from holder": "x11-name",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-warranty",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc-liability",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache2-use",
    "you may not use this file except in compliance with the license": "apache2-use",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache2-language",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2 of the license": "gpl2-only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2-only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3 of the license": "gpl3-only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version": "lgpl2-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "lgpl-warranty",
    "see the gnu general public license for more details": "gpl-details",
    "see the gnu affero general public license for more details": "agpl-details",
    "see the gnu lesser general public license for more details": "lgpl-details",
    "see the gnu library general public license for more details": "lgpl2-details",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by holder": "bsd-advertising",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-warranty",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "bsd-liability",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-subject",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-subject",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2-copy",
    "the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license": "mpl11-use",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at holder": "epl2-available",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at holder": "epl1-available",
    "this is free and unencumbered software released into the public domain": "unlicense-public",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-free",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl-grant",
    "distributed under the boost software license version 1 0": "bsl-short",
    "see accompanying file license 1 0 txt or copy at http www boost org license 1 0 txt": "bsl-copy",
    "this program is free software it comes without any warranty to the extent permitted by applicable law": "wtfpl-free",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed": "wtfpl-grant",
    "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies": "postgresql-grant",
    "this font software is licensed under the sil open font license version 1 1": "ofl-short",
    "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law": "cc0-deed",
    "to the extent possible under law holder has waived all copyright and related or neighboring rights to this work": "cc0-waived",
    "use modification and distribution are subject to the boost software license version 1 0": "bsl-short",
    "the contents of this file are subject to the terms of the common development and distribution license the license": "cddl-subject",
    "you may not use this file except in compliance with the license you can obtain a copy of the license at holder": "apache2-use",
    "all rights reserved": "all-rights",
}
# Ordered rules. The first rules take the longest sequences; what a rule has matched, later ones don't see.
RULES = [
    ("X11", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability", "x11-name"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT-0", ["mit-grant-0", "mit-warranty", "mit-liability"]),
    ("ISC", ["isc-grant", "isc-warranty", "isc-liability"]),
    ("0BSD", ["0bsd-grant", "isc-warranty", "isc-liability"]),
    ("Apache-2.0", ["apache2-use", "apache2-warranty", "apache2-language"]),
    ("AGPL-3.0-or-later", ["agpl3-later", "gpl-warranty", "agpl-details"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-warranty", "gpl-details"]),
    ("GPL-3.0-only", ["gpl3-only", "gpl-warranty", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-warranty", "gpl-details"]),
    ("GPL-2.0-only", ["gpl2-only", "gpl-warranty", "gpl-details"]),
    ("LGPL-2.1-or-later", ["lgpl21-later", "lgpl-warranty", "lgpl-details"]),
    ("LGPL-3.0-or-later", ["lgpl3-later", "lgpl-warranty", "lgpl-details"]),
    ("LGPL-2.0-or-later", ["lgpl2-later", "lgpl-warranty", "lgpl2-details"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-warranty", "bsd-liability"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MPL-2.0", ["mpl2-subject", "mpl2-copy"]),
    ("Zlib", ["zlib-warranty", "zlib-liability", "zlib-grant"]),
    ("Unlicense", ["unlicense-public", "unlicense-free"]),
    ("BSL-1.0", ["bsl-short", "bsl-copy"]),
    ("MIT", ["mit-grant"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache2-use"]),
    ("AGPL-3.0-or-later", ["agpl3-later"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-3.0-only", ["gpl3-only"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("GPL-2.0-only", ["gpl2-only"]),
    ("LGPL-2.1-or-later", ["lgpl21-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("LGPL-2.0-or-later", ["lgpl2-later"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("MPL-1.1", ["mpl11-use"]),
    ("EPL-2.0", ["epl2-available"]),
    ("EPL-1.0", ["epl1-available"]),
    ("CDDL-1.0", ["cddl-subject"]),
    ("Unlicense", ["unlicense-public"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("BSL-1.0", ["bsl-short"]),
    ("WTFPL", ["wtfpl-free"]),
    ("WTFPL", ["wtfpl-grant"]),
    ("PostgreSQL", ["postgresql-grant"]),
    ("OFL-1.1", ["ofl-short"]),
    ("CC0-1.0", ["cc0-deed"]),
    ("CC0-1.0", ["cc0-waived"]),
    *[(name, [f"named-{name}"]) for name in dict.fromkeys(NAMES.values())],
    ("All-Rights-Reserved", ["all-rights"]),
]
#: Whatever names a licence has one of VERBS in its sentence, and every known sentence has one of KEYWORDS. For callers that look
#: for texts worth a scan; the scan itself reads every text.
VERBS = "licen|released|distributed|available|published|provided"
KEYWORDS = f"{VERBS}|copyright|permission|software|reserved|redistribut|warrant|general|mpl|advertising|copies|anyone"
# Where a sentence that isn't known names a licence, what stands before and after the name.
SHORT = "(?:licensed|released|distributed|available|published|provided) (?:(?:to you )?under|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"
AFTER = "(?: (?:see|which|for|or|and|as|in|you|the|at|https?|with|but|available|unless|copyright|c|by|full|please|details) .*)?"
SPDX = "spdx license identifier "
# Where sentences have a holder's name, and what stands there in SENTENCES.
HOLDERS = [
    ("^neither the name of .* nor the names of (?:its|the|their|any) contributors may", "neither the name of holder nor the names of its contributors may"),
    ("^except as contained in this notice the names? of .* shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from .*$",
     "except as contained in this notice the name of holder shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from holder"),
    ("this product includes software developed by .*$", "this product includes software developed by holder"),
    ("^to the extent possible under law .* (?:has|have) waived all", "to the extent possible under law holder has waived all"),
    ("(is available at|a copy of the license at) .*$", "\\1 holder"),
    ("^(?:copyright|c|the|this list) .* (permission is hereby granted free of charge to any person obtaining)", "\\1"),
    ("^(?:[0-9]+|[a-z]|i+) (redistributions? |neither the name |all advertising )", "\\1"),
]
SPACE, ENDS, BLANK, MARK = "[ \\t\\r\\n]+", "([.!?])[ \\t\\r\\n]+", "\\n[ \\t\\r#*/;-]*\\n", "\u0001"


def _plain(x: Column) -> Column:
    found = F.trim(F.regexp_replace(F.lower(F.translate(x, "\u0130", "i")), "[^a-z0-9]+", " "))  # else \u0130 becomes i and a mark
    for pattern, to in HOLDERS:
        found = F.regexp_replace(found, pattern, to.replace("\\1", "$1"))
    return found


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, licenses, n_sentences, sentences, unmatched.

    A text is split into sentences twice: at ends of sentences and blank lines (wrapped licence texts), and at every
    line too (lines without full stop); the split that recognises more sentences counts, at a tie the first.
    Sentences are normalised, with holders' names taken out, and looked up in SENTENCES; one that isn't known may name a
    licence of NAMES after words such as "licensed under the", wherever in it, or as an SPDX identifier. The sequence of
    identifiers is matched against RULES in their order: a rule matches adjacent identifiers and consumes them.
    licenses holds the names of the rules that matched, in rule order, without repeats; NONE where no sentence is known,
    UNKNOWN where none of the rules matches. sentences is the sequence of identifiers, n_sentences its length, unmatched
    how many no rule took.

    Null and empty texts have no sentence; every text is split and read as a whole, of any length. Repeated rows give repeated results;
    empty input no rows; further columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    listed = "|".join(sorted(NAMES, key=lambda n: (-len(n), n)))

    def named(x):
        short = F.regexp_extract(x, f"(?:^| ){SHORT}({listed}){AFTER}$", 1)
        spdx = F.regexp_extract(x, f"(?:^| ){SPDX}({listed})$", 1)
        return F.concat(F.lit("named-"), F.try_element_at(names, F.when(spdx != "", spdx).otherwise(short)))

    def ids(parts):
        plain = F.filter(F.transform(parts, _plain), lambda x: x != "")
        told = F.transform(plain, lambda x: F.coalesce(F.try_element_at(known, x), F.when(x.rlike(VERBS), named(x))))
        return F.filter(told, lambda x: x.isNotNull())

    split = F.when(F.col("_text") == "", F.array().cast("array<string>"))
    whole = split.otherwise(F.split(F.regexp_replace(F.regexp_replace("_text", BLANK, MARK), ENDS, f"$1{MARK}"), MARK))
    by_line = split.otherwise(F.split(F.regexp_replace("_text", ENDS, "$1\n"), "\n"))
    found = keyed.select("_id", ids(whole).alias("_a"), ids(by_line).alias("_b")).select(
        "_id", F.when(F.size("_b") > F.size("_a"), F.col("_b")).otherwise(F.col("_a")).alias("_ids")
    )
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("".join(f"<{i}>" for i in seq)).alias("seq")) for n, seq in RULES])
    start = F.struct(
        F.array_join(F.transform("_ids", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "").alias("left"),
        F.array().cast("array<string>").alias("names"),
    )
    matched = F.aggregate(
        rules,
        start,
        lambda st, r: F.struct(
            F.replace(st["left"], r["seq"], F.lit("|")).alias("left"),
            F.when(F.contains(st["left"], r["seq"]), F.array_append(st["names"], r["name"])).otherwise(st["names"]).alias("names"),
        ),
    )
    done = found.select("_id", "_ids", F.when(F.size("_ids") > 0, matched).alias("_m"))
    return done.select(
        F.col("_id").alias(id_col),
        F.when(F.size("_ids") == 0, "NONE")
        .when(F.size("_m.names") == 0, "UNKNOWN")
        .otherwise(F.array_join(F.array_distinct("_m.names"), ";"))
        .alias("licenses"),
        F.size("_ids").cast("bigint").alias("n_sentences"),
        F.array_join("_ids", ",").alias("sentences"),
        F.coalesce(F.length(F.regexp_replace("_m.left", "[^<]", "")), F.lit(0)).cast("bigint").alias("unmatched"),
    )


def _oracle() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table = lambda d: "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in d.items()) + "}"
    listed = "|".join(sorted(NAMES, key=lambda n: (-len(n), n)))
    plain = "trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'), ' ')"
    for pattern, to in HOLDERS:
        plain = f"regexp_replace({plain}, {quoted(pattern)}, {quoted(to)}, 'g')"
    short, spdx = (f"regexp_extract(x, {quoted(p)}, 1)" for p in (f"(?:^| ){SHORT}({listed}){AFTER}$", f"(?:^| ){SPDX}({listed})$"))
    steps = "".join(
        f", s{n + 1} AS (SELECT doc_id, ids, replace(rest, {quoted(p)}, '|') AS rest, CASE WHEN contains(rest, {quoted(p)}) AND NOT list_contains(names, {quoted(name)}) THEN list_append(names, {quoted(name)}) ELSE names END AS names FROM s{n})"
        for n, (name, p) in enumerate((name, "".join(f"<{i}>" for i in seq)) for name, seq in RULES)
    )
    return f"""
WITH known AS MATERIALIZED (SELECT unnest(map_entries({table(SENTENCES)}), recursive := true)),
names AS MATERIALIZED (SELECT unnest(map_entries({table(NAMES)}), recursive := true)),
parts AS (
  SELECT doc_id, 1 AS way, string_split(regexp_replace(regexp_replace(text, '\n[ \t\r#*/;-]*\n', chr(1), 'g'), '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1)) AS p FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 2, string_split(regexp_replace(text, '([.!?])[ \t\r\n]+', '\1' || chr(10), 'g'), chr(10)) FROM documents WHERE text IS NOT NULL
), sentences AS (
  SELECT doc_id, way, pos, {plain} AS x FROM (SELECT doc_id, way, unnest(p) AS x, unnest(range(len(p))) AS pos FROM parts)
), told AS (
  SELECT doc_id, way, pos, coalesce(k.value, 'named-' || n.value) AS id
  FROM sentences s LEFT JOIN known k ON s.x = k.key
  LEFT JOIN names n ON k.key IS NULL AND n.key = (CASE WHEN {spdx} <> '' THEN {spdx} ELSE {short} END)
  WHERE k.key IS NOT NULL OR n.key IS NOT NULL
), ways AS (
  SELECT doc_id, way, list(id ORDER BY pos) AS ids FROM told GROUP BY doc_id, way
), s0 AS (
  SELECT doc_id, ids, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '') AS rest, []::VARCHAR[] AS names
  FROM (SELECT doc_id, CASE WHEN coalesce(len(b.ids), 0) > coalesce(len(a.ids), 0) THEN b.ids ELSE coalesce(a.ids, []) END AS ids
        FROM documents LEFT JOIN (SELECT * FROM ways WHERE way = 1) a USING (doc_id) LEFT JOIN (SELECT * FROM ways WHERE way = 2) b USING (doc_id))
){steps}
SELECT doc_id, CASE WHEN len(ids) = 0 THEN 'NONE' WHEN len(names) = 0 THEN 'UNKNOWN' ELSE array_to_string(names, ';') END AS licenses,
       len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentences,
       length(regexp_replace(rest, '[^<]', '', 'g')) AS unmatched
FROM s{len(RULES)}
"""


ORACLE = _oracle()
