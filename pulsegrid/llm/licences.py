"""Licence scan: known sentences become identifiers, ordered rules match runs of identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences, normalised (lower case, runs of other characters than a-z 0-9 as one space).
SENTENCES = {
    "apache2-licensed": "licensed under the apache license version 2 0",
    "apache2-the-license": "licensed under the apache license version 2 0 the license",
    "apache2-not-use": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl2-work": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "lgpl3-work": "this work is licensed under the gnu lesser general public license version 3",
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc0": "this work is dedicated to the public domain under cc0 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache2": "spdx license identifier apache 2 0",
    "spdx-gpl3": "spdx license identifier gpl 3 0 only",
}
# The same identifiers as published, where the wording goes on in the same sentence.
PUBLISHED = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
}
# Fixed values: (rule, licence, identifiers in order), most specific first; a rule takes what it matches from later ones.
RULES = [
    ("apache2-notice", "Apache-2.0", ["apache2-the-license", "apache2-not-use", "apache2-copy", "apache2-as-is"]),
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("gpl3-notice", "GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-copy"]),
    ("gpl3-short", "GPL-3.0-or-later", ["gpl-free"]),
    ("apache2-short", "Apache-2.0", ["apache2-the-license"]),
    ("apache2-line", "Apache-2.0", ["apache2-licensed"]),
    ("mit-line", "MIT", ["mit-released"]),
    ("mit-line-2", "MIT", ["mit-licensed"]),
    ("gpl3-line", "GPL-3.0-only", ["gpl3-work"]),
    ("gpl2-line", "GPL-2.0-only", ["gpl2-work"]),
    ("lgpl3-line", "LGPL-3.0-only", ["lgpl3-work"]),
    ("mpl2-line", "MPL-2.0", ["mpl2-subject"]),
    ("isc-line", "ISC", ["isc-grant"]),
    ("cc-by-4-line", "CC-BY-4.0", ["cc-by-4"]),
    ("cc-by-sa-4-line", "CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("cc-by-nc-4-line", "CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("cc0-line", "CC0-1.0", ["cc0"]),
    ("unlicense-line", "Unlicense", ["unlicense"]),
    ("spdx-mit-tag", "MIT", ["spdx-mit"]),
    ("spdx-apache2-tag", "Apache-2.0", ["spdx-apache2"]),
    ("spdx-gpl3-tag", "GPL-3.0-only", ["spdx-gpl3"]),
]
# Every known sentence contains one of these.
HINTS = "(?i)licen[sc]|cc by|permission|redistribut|copyright|warrant|cc0|unencumbered"


def fragments_of(text: Column) -> Column:
    """`text` as one normalised fragment to a line, with a line feed at both ends.

    Lines are cut after `.`, `!`, `?`, `;` or `:` and white space; a line that goes on in lower case belongs to the one
    before, except after an SPDX tag, which ends with its line. Fragments are in lower case, with runs of other
    characters than a-z and 0-9 as one space, trimmed; empty ones are left out.
    """
    tagged = F.regexp_replace(text, r"(?i)(spdx-license-identifier:[^\n]*\n)", "$1\n")
    unwrapped = F.regexp_replace(tagged, r"\n[ \t*#/]*([a-z])", " $1")
    cut = F.regexp_replace(unwrapped, r"([.!?;:])[ \t\r]+", "$1\n")
    plain = F.regexp_replace(F.lower(cut), r"[^a-z0-9\n]+", " ")
    return F.concat(F.lit("\n"), F.regexp_replace(F.regexp_replace(plain, r" *\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", ""), F.lit("\n"))


def _in_fragments(sentence: str) -> str:
    """Pattern of whole fragments that together are `sentence`, wherever marks or line ends cut it."""
    return r"\n" + "[ \\n]".join(sentence.split()) + r"(?=\n)"


def scan_licences(
    docs: DataFrame, *, text: str = "text", sentences: dict[str, str] | None = None, rules: list | None = None, hints: str = HINTS
) -> DataFrame:
    """`docs` with licence columns: sentence_ids, licences, licence_rules (arrays) and unmatched (identifiers left over).

    A known sentence is found where whole fragments of the text, one or several in a row, make it up: marks inside it
    and wrapped lines cut it, but it never begins or ends inside a fragment. The longest known sentence takes its
    fragments first. The known ones in text order form the
    sequence on which the rules are matched; unknown sentences between them are passed over. Rules run from
    the most specific on and take what they match; a match leaves a gap that no later rule bridges. Licences
    are listed once each, by name; rules likewise. All of it happens inside a row: no shuffle. Only texts
    with a hint are cut into sentences. Null and empty texts give empty arrays; columns of `docs` with the
    names added here are replaced.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    code = {k: chr(0xE000 + i) for i, k in enumerate(sentences)}  # one private character per identifier
    wordings = [(s, k) for k, s in sentences.items()] + [(s, k) for k, s in PUBLISHED.items() if sentences.get(k) == SENTENCES[k]]
    wordings.sort(key=lambda w: (-len(w[0]), w[0]))
    hinted = F.coalesce(F.col(text).rlike(hints), F.lit(False))
    df = docs.drop("sentence_ids", "licences", "licence_rules", "unmatched").withColumn("__ids", F.when(hinted, fragments_of(F.col(text))).otherwise(""))
    found = F.col("__ids")
    for sentence, k in wordings:
        found = F.regexp_replace(found, _in_fragments(sentence), "\n" + code[k])
    some = F.col("__ids").rlike("|".join(_in_fragments(sentence) for sentence, _ in wordings))
    df = df.withColumn("__ids", F.when(some, F.regexp_replace(found, "[a-z0-9 \n]+", "")).otherwise(""))
    left, hits = F.col("__ids"), {}
    for name, _, ids in rules:
        run = "".join(code[i] for i in ids)
        hits[name] = left.contains(run)
        left = F.replace(left, F.lit(run), F.lit("|"))
    back = F.create_map(*(F.lit(x) for k, c in code.items() for x in (c, k)))
    names = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: (x != "") & (x != "|")), lambda x: F.element_at(back, x))
    nothing = F.array().cast("array<string>")
    matched = lambda i: F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(hits[r[0]], r[i]) for r in rules)))))
    some = F.col("__ids") != ""
    return df.withColumns(
        {
            "sentence_ids": F.when(some, names(F.col("__ids"))).otherwise(nothing),
            "licences": F.when(some, matched(1)).otherwise(nothing),
            "licence_rules": F.when(some, matched(0)).otherwise(nothing),
            "unmatched": F.when(some, names(left)).otherwise(nothing),
        }
    ).drop("__ids")
