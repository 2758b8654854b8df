"""Licence recognition by sentence rules, in column expressions alone.

A text is cut into sentences; each is brought to a plain form (lower case, words parted by one space) and looked up
among known licence sentences. What a text has left is a sequence of sentence identifiers, against which licence
rules are matched in order: a rule that matches uses up its identifiers, so the fuller licences come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names under which licences are referred to, in plain form
LICENCE_NAMES = {
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"),
    "MIT": ("mit license", "mit licence", "mit"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "bsd 3 clause"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "bsd 2 clause"),
    "ISC": ("isc license", "isc"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"),
    "GPL-2.0": ("gnu general public license version 2", "gnu gpl version 2", "gpl version 2", "gpl v2", "gplv2"),
    "GPL-3.0": ("gnu general public license version 3", "gnu gpl version 3", "gpl version 3", "gpl v3", "gplv3"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "lgpl version 2 1", "lgpl v2 1"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "lgpl version 3", "lgpl v3", "lgplv3"),
    "AGPL-3.0": ("gnu affero general public license version 3", "agpl version 3", "agpl v3", "agplv3"),
    **{
        f"{name}-{version}-{kind}": (f"{name.lower()} {version.replace('.', ' ')} {kind.replace('-', ' ')}",)
        for name, versions in {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}.items()
        for version in versions
        for kind in ("only", "or-later")
    },
    "Zlib": ("zlib license", "zlib"),
    "BSL-1.0": ("boost software license version 1 0", "bsl 1 0"),
    "Unlicense": ("unlicense",),
    "CC0-1.0": ("cc0 1 0", "cc0", "creative commons zero 1 0"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"),
    "CC-BY-NC-ND-4.0": ("cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international license"),
}

# Sentences of licence texts and notices, in plain form
LICENCE_SENTENCES = {
    "mit_grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the software",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "mit_notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    "as_is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "no_liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
        "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ),
    "isc_grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "bsd_grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    "bsd_source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ),
    "bsd_binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd_names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "apache_header": ("licensed under the apache license version 2 0 the license",),
    "apache_use": (
        "you may not use this file except in compliance with the license",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    ),
    "apache_as_is": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "gpl3_grant": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "gpl2_grant": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 2 of the license or at your option any later version",
    ),
    "gpl_warranty": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose",
    ),
    "mpl_terms": (
        "this source code form is subject to the terms of the mozilla public license",  # "v. 2.0" ends it; only 2.0 says so
        "this source code form is subject to the terms of the mozilla public license version 2 0",
    ),
    "zlib_grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it "
        "and redistribute it freely subject to the following restrictions",
    ),
    "unlicense_grant": ("this is free and unencumbered software released into the public domain",),
    "lgpl21_grant": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    ),
    "lgpl3_grant": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "agpl3_grant": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "all_rights_reserved": ("all rights reserved",),
}

# Licence rules in order: (licence, identifiers in order). Others may stand between them, GAP at most.
GAP = 3
RULES = (
    ("MIT", ("mit_grant", "as_is")),
    ("MIT", ("mit_grant",)),
    ("ISC", ("isc_grant",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache_header", "apache_use", "apache_as_is")),
    ("Apache-2.0", ("apache_use", "apache_as_is")),
    ("Apache-2.0", ("apache_header",)),
    ("GPL-3.0-or-later", ("gpl3_grant", "gpl_warranty")),
    ("GPL-3.0-or-later", ("gpl3_grant",)),
    ("GPL-2.0-or-later", ("gpl2_grant", "gpl_warranty")),
    ("GPL-2.0-or-later", ("gpl2_grant",)),
    ("MPL-2.0", ("mpl_terms",)),
    ("Zlib", ("zlib_grant",)),
    ("Unlicense", ("unlicense_grant",)),
    ("LGPL-2.1-or-later", ("lgpl21_grant",)),
    ("LGPL-3.0-or-later", ("lgpl3_grant",)),
    ("AGPL-3.0-or-later", ("agpl3_grant",)),
    *((licence, (f"ref:{licence}",)) for licence in LICENCE_NAMES),
)
# holds where the identifiers of a text are of these two kinds alone, so no sentence of another licence is among them
PROPRIETARY = r"^ (?:(?:copyright|all_rights_reserved) )*copyright (?:copyright )*all_rights_reserved (?:(?:copyright|all_rights_reserved) )*$"

# Every known sentence holds one of these or begins as REFERENCE does. Patterns read alike in both engines.
TRIGGERS = ("licens", "licenc", "permission", "permitted", "redistribut", "copyright", "warrant", "liab", "rights reserved", "free software", "released under", "mozilla", "unencumbered")
REFERENCE = (
    r"^(?:(?:this|the) (?:work|software|program|project|file|code|document|text|content|library|material) (?:is|are) )?"
    r"(?:dual )?(?:licensed|licenced|released|distributed|available|made available|published|provided|shared) under (?:the )?(?:terms of (?:the )?)?"
)
# A text without any of these words, which no line break parts, has no such sentence in either reading.
WORDS = ("licens", "licenc", "permission", "permitted", "redistribut", "copyright", "warrant", "liab", "rights", "software", "under", "mozilla", "unencumbered")
IDENTIFIER = r"^spdx license identifier "
NUMBER = r"^(?:[0-9]{1,2}|[a-z]) "  # of a list's entry
MARKS = r"\n[ \t]*(?:#+|//+|/?\*+|;+|--+)[ \t]*"  # that begin the lines of a comment
ENTRY = r"[:;,][ \t]*(?:and |or )?[ \t]*\(?[0-9a-z][0-9]?[.)][ \t]+"  # a list's entry in running text
COPYRIGHT = r"^(?:copyright (?:c )?[0-9]{4}|c copyright [0-9]{4}|copyright c ).*$"


def sentence_table() -> dict[str, str]:
    """Plain sentence to identifier: texts and notices, and `licensed under` before every name."""
    table = {s: key for key, sentences in LICENCE_SENTENCES.items() for s in sentences}
    for licence, names in LICENCE_NAMES.items():
        for name in names:
            table[f"licensed under {name}"] = f"ref:{licence}"
    return table


def rule_pattern(identifiers: tuple[str, ...]) -> str:
    """A rule over identifiers that are parted by single blanks, with one before and one after all."""
    between = rf"(?: [^ ]+){{0,{GAP}}} "
    return " " + between.join(i.replace(".", r"\.") for i in identifiers) + " "


def _sentences(lowered: Column) -> Column:
    """Plain sentences of a lower-case text: lines as they are, then what is new in paragraphs with their lines joined.

    A notice may stand on a line of its own or be wrapped over several; each reading finds its kind.
    """
    lowered = F.regexp_replace(F.concat(F.lit("\n"), F.regexp_replace(lowered, r"\r", "")), MARKS, "\n")
    joined = lowered
    joined = F.regexp_replace(joined, r"\n[ \t]*\n", "\u0001")
    joined = F.regexp_replace(joined, r"\n", " ")

    def plain(text: Column) -> Column:
        text = F.regexp_replace(F.regexp_replace(text, ENTRY, "\n"), r"([.!?])[ \t]+", "$1\n")
        text = F.regexp_replace(text, "\u0001", "\n")
        text = F.regexp_replace(text, r"[^a-z0-9\n]+", " ")
        return F.transform(F.split(text, "\n"), lambda s: F.trim(s))

    by_line = plain(lowered)
    return F.concat(by_line, F.array_except(plain(joined), by_line))


def _identifier(sentence: Column, table: Column) -> Column:
    core = F.regexp_replace(F.regexp_replace(sentence, REFERENCE, "licensed under "), IDENTIFIER, "licensed under ")
    numbered = F.regexp_replace(sentence, NUMBER, "")
    known = F.coalesce(F.try_element_at(table, sentence), F.try_element_at(table, core), F.try_element_at(table, numbered))
    return F.coalesce(known, F.when(sentence.rlike(COPYRIGHT), F.lit("copyright")))


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, sentence_ids (found identifiers in order, by blanks), licences (sorted, by commas).

    Both are empty where nothing is recognised, as for null and empty texts. Whole texts are read. Repeated rows stay
    rows of their own; a null doc_id is kept; an empty table gives no rows; other columns are not looked at.
    """
    table = F.create_map(*[F.lit(x) for pair in sentence_table().items() for x in pair])
    lowered = F.lower(F.col("__text"))
    rules = F.array(*[F.struct(F.lit(rule_pattern(ids)).alias("pattern"), F.lit(name).alias("licence")) for name, ids in RULES])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))

    hinted = F.lit(False)
    for word in WORDS:
        hinted = hinted | F.replace(lowered, F.lit("\r"), F.lit("")).contains(word)
    hopeful = F.filter(_sentences(lowered), lambda s: s.rlike("|".join((*TRIGGERS, REFERENCE))))
    found = F.filter(F.transform(hopeful, lambda s: _identifier(s, table)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", F.when(hinted, F.array_join(found, " ")).otherwise(F.lit("")).alias("sentence_ids"))

    begin = F.struct(F.concat(F.lit(" "), F.col("sentence_ids"), F.lit(" ")).alias("left"), F.array().cast("array<string>").alias("licences"))
    end = F.aggregate(
        rules,
        begin,
        lambda acc, rule: F.struct(
            F.regexp_replace(acc["left"], rule["pattern"], " ").alias("left"),
            F.when(F.regexp_like(acc["left"], rule["pattern"]), F.array_append(acc["licences"], rule["licence"])).otherwise(acc["licences"]).alias("licences"),
        ),
        lambda acc: F.array_join(F.array_sort(F.array_distinct(acc["licences"])), ","),
    )
    alone = F.regexp_like(F.concat(F.lit(" "), F.col("sentence_ids"), F.lit(" ")), F.lit(PROPRIETARY))
    end = F.when(alone, F.lit("Proprietary")).otherwise(end)
    return rows.select("doc_id", "sentence_ids", F.when(F.col("sentence_ids") != "", end).otherwise(F.lit("")).alias("licences"))
