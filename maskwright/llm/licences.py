"""Licence recognition from sentences, with DataFrame functions only.

A text is cut into sentences, each is normalised and looked up among known licence sentences, and the sequence of
identifiers found is matched against ordered rules: a rule that occurs names a licence and takes its sentences out of
the sequence before the next rule is tried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Normalised sentences of public licence texts and of the notices that refer to them.
SENTENCES: dict[str, str] = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "this software is released under the mit license": "MITref",
    "spdx license identifier mit": "MITref",
    "the mit license mit": "MITtitle",
    "mit license": "MITtitle",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
    "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
    "dealings in the software": "MITliability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "spdx license identifier isc": "ISCref",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "released under the apache license version 2 0": "Apache2ref",
    "spdx license identifier apache 2 0": "Apache2ref",
    "apache license version 2 0": "Apache2title",
    "you may not use this file except in compliance with the license": "Apache2comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "Apache2where",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "this program is licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 3": "GPL3ref",
    "spdx license identifier gpl 3 0 only": "GPL3ref",
    "spdx license identifier gpl 3 0 or later": "GPL3plusref",
    "this work is licensed under the gnu general public license version 2": "GPL2ref",
    "licensed under the gnu general public license version 2": "GPL2ref",
    "spdx license identifier gpl 2 0 only": "GPL2ref",
    "spdx license identifier gpl 2 0 or later": "GPL2plusref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version": "GPL3plusgrant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 2 of the license or at your option any later "
    "version": "GPL2plusgrant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose": "GPLwarranty",
    "see the gnu general public license for more details": "GPLsee",
    "licensed under the gnu lesser general public license version 3": "LGPL3ref",
    "spdx license identifier lgpl 3 0 only": "LGPL3ref",
    "spdx license identifier lgpl 3 0 or later": "LGPL3plusref",
    "licensed under the gnu lesser general public license version 2 1": "LGPL21ref",
    "spdx license identifier lgpl 2 1 only": "LGPL21ref",
    "spdx license identifier lgpl 2 1 or later": "LGPL21plusref",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
    "public license as published by the free software foundation either version 2 1 of the license or at your option any "
    "later version": "LGPL21plusgrant",
    "licensed under the eupl": "EUPLref",
    "spdx license identifier eupl 1 2": "EUPLref",
    "licensed under the gnu affero general public license version 3": "AGPL3ref",
    "spdx license identifier agpl 3 0 only": "AGPL3ref",
    "licensed under the mozilla public license version 2 0": "MPL2ref",
    "spdx license identifier mpl 2 0": "MPL2ref",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "BSDgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "BSDname",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
    "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed": "BSDwarranty",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary "
    "or consequential damages including but not limited to procurement of substitute goods or services": "BSDliability",
    "licensed under the bsd 3 clause license": "BSD3ref",
    "spdx license identifier bsd 3 clause": "BSD3ref",
    "licensed under the bsd 2 clause license": "BSD2ref",
    "spdx license identifier bsd 2 clause": "BSD2ref",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "spdx license identifier cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "spdx license identifier cc by 4 0": "CCBY4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "spdx license identifier cc by sa 4 0": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4ref",
    "licensed under cc0 1 0": "CC0ref",
    "spdx license identifier cc0 1 0": "CC0ref",
}

# A licence and the sentences that state it, in the order in which rules are tried.
RULES: list[tuple[str, list[str]]] = [
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDname", "BSDwarranty", "BSDliability"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDname", "BSDwarranty"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDname"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDwarranty", "BSDliability"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDwarranty"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary"]),
    ("GPL-3.0-or-later", ["GPL3plusgrant", "GPLwarranty", "GPLsee"]),
    ("GPL-2.0-or-later", ["GPL2plusgrant", "GPLwarranty", "GPLsee"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply", "Apache2where"]),
    ("MIT", ["MITtitle", "MITgrant", "MITnotice", "MITwarranty", "MITliability"]),
    ("MIT", ["MITgrant", "MITnotice", "MITwarranty", "MITliability"]),
    ("MIT", ["MITgrant", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITtitle", "MITgrant", "MITnotice"]),
    ("MIT", ["MITgrant", "MITnotice"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply"]),
    ("MIT", ["MITgrant"]),
    ("ISC", ["ISCgrant"]),
    ("GPL-3.0-or-later", ["GPL3plusgrant"]),
    ("GPL-2.0-or-later", ["GPL2plusgrant"]),
    ("LGPL-2.1-or-later", ["LGPL21plusgrant"]),
    ("MPL-2.0", ["MPL2grant"]),
    ("MIT", ["MITref"]),
    ("ISC", ["ISCref"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("GPL-3.0-or-later", ["GPL3plusref"]),
    ("GPL-3.0-only", ["GPL3ref"]),
    ("GPL-2.0-or-later", ["GPL2plusref"]),
    ("GPL-2.0-only", ["GPL2ref"]),
    ("LGPL-3.0-or-later", ["LGPL3plusref"]),
    ("LGPL-3.0-only", ["LGPL3ref"]),
    ("LGPL-2.1-or-later", ["LGPL21plusref"]),
    ("LGPL-2.1-only", ["LGPL21ref"]),
    ("EUPL-1.2", ["EUPLref"]),
    ("AGPL-3.0-only", ["AGPL3ref"]),
    ("MPL-2.0", ["MPL2ref"]),
    ("BSD-3-Clause", ["BSD3ref"]),
    ("BSD-2-Clause", ["BSD2ref"]),
    ("CC-BY-NC-4.0", ["CCBYNC4ref"]),
    ("CC-BY-SA-4.0", ["CCBYSA4ref"]),
    ("CC-BY-4.0", ["CCBY4ref"]),
    ("CC0-1.0", ["CC0ref"]),
    ("MIT", ["MITtitle"]),
    ("Apache-2.0", ["Apache2title"]),
]

# What stands before and behind an owner's name in a template, and the owner that known sentences name.
OWNERS: list[tuple[str, str, str]] = [
    ("neither the name of ", "the copyright holder", " nor the names of its contributors may be used"),
    ("this software is provided by ", "the copyright holders and contributors", " as is and any express or implied"),
]
OWNER_CHARS = 160
EXPRESSION = "spdx license identifier "

# Every known sentence, and every sentence that seems to speak of licences, holds one of these.
CRITICAL = ["licen", "permi", "warrant", "copyright", "distribut"]

SENTENCE_END = r"[.!?;]+[ \t\r\n]+|\n[ \t\r]*\n"
# an owner's abbreviation ends no sentence where the template goes on
ABBREVIATED = r"\.([^a-z0-9]{1,8}(?:nor the names of its|as is[^a-z0-9]{1,8}and any express))"
_COMMENT = r"(?m)^[ \t]*[;!]+[ \t]+"  # comment marks that would end a sentence
# what stands before a line's words: a word that marks comments, a list number or letter in brackets
_LINE_MARK = r"(?m)^[^a-z0-9\n]*(?:(?:rem|dnl)[ \t]+)?(?:[(]?(?:[0-9]{1,2}|[a-z])[)][ \t]+)?"
_LIST_BEGIN = r":[ \t]*[(]?[0-9]{1,2}(?:[.)](?=\s)|$)"  # behind a sentence
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def normalised(sentence: Column) -> Column:
    """Letters a-z and digits, with one space between runs of them; any owner of a template is the one of known sentences."""
    out = F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))
    for before, owner, behind in OWNERS:
        out = F.regexp_replace(out, f"{before}.{{1,{OWNER_CHARS}}}?{behind}", before + owner + behind)
    return out


def guarded(rules: list[tuple[str, list[str]]]) -> list[bool]:
    """Which rules are the beginning of an earlier one for another licence: the next sentence then decides."""
    return [any(name != other and longer[:len(ids)] == ids for other, longer in rules[:k]) for k, (name, ids) in enumerate(rules)]


def _parts(sentence: Column, known: Column) -> Column:
    """An SPDX expression as one identifier sentence for each licence that it names; any other sentence as it is."""
    several = F.contains(sentence, F.lit(" or ")) | F.contains(sentence, F.lit(" and "))
    named = F.replace(F.substring(sentence, len(EXPRESSION) + 1, 1 << 20), F.lit(" or later"), F.lit(" orlater"))
    parts = F.transform(F.split(named, " (?:or|and) "), lambda p: F.concat(
        F.lit(EXPRESSION), F.replace(p, F.lit("orlater"), F.lit("or later"))))
    expression = ~F.map_contains_key(known, sentence) & F.startswith(sentence, F.lit(EXPRESSION)) & several
    return F.when(expression, parts).otherwise(F.array(sentence))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, sentence_ids, licences, unmatched, unknown.

    ``sentence_ids`` are the identifiers of known sentences in the order of the text, ``licences`` the rules that they
    meet in the order of the rules, each licence once, ``unmatched`` the number of identifiers that no rule took and
    ``unknown`` that of sentences that speak of licences but are not known. A rule needs its identifiers next to each
    other, with no other identifier and no unknown licence sentence between; other sentences between do not count. A
    rule that is the beginning of another licence's rule names nothing where an unknown licence sentence follows. The
    owner's name in a template may be any. An SPDX expression names each of its licences; one with an exception is unknown.
    A sentence may run over several lines, each with a comment mark before it. If it is not known as a whole, it is taken
    line by line: from each line the longest known run of neighbouring lines, or else the line. Lines without letters and
    digits part runs; numbers of lists belong to none. Null and
    empty texts, and texts that name no licence, have empty lists and zeros. Ids may be null or repeat. Other columns are
    not read.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    if outside := [s for s in sentences if not any(c in s for c in CRITICAL)]:
        raise ValueError(f"known sentences need one of {CRITICAL}: {outside[:3]}")
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    critical = "|".join(CRITICAL)
    text = lowered(F.col(text_col).cast("string"))

    # a known sentence from the beginning of a line to the end of one, the longest first, or else a line
    def run_of(sentence: str) -> str:
        for before, owner, behind in OWNERS:
            if before + owner + behind in sentence:
                head, tail = sentence.split(before + owner + behind)
                return run_of(head + before) + f"[a-z0-9 \\n]{{1,{OWNER_CHARS}}}?" + run_of(behind + tail)
        return sentence.replace(" ", "[ \\n]")

    runs = "|".join(run_of(s) for s in sorted(sentences, key=lambda s: (-len(s), s)))
    run = f"(?m)^(?:{runs})$|^.+$"

    def units(sentence: Column) -> Column:
        whole = F.map_contains_key(known, normalised(sentence))
        bare = F.regexp_replace(F.regexp_replace(sentence, _LINE_MARK, ""), _LIST_BEGIN, ":\n")
        lines = F.regexp_replace(F.regexp_replace(bare, "[^a-z0-9\n]+", " "), " ?\n ?", "\n")
        return F.when(whole, F.array(sentence)).otherwise(F.regexp_extract_all(F.trim(lines), F.lit(run), F.lit(0)))

    # whatever holds none of the words is neither known nor unknown, so most texts are never cut
    cut = F.flatten(F.transform(
        F.filter(F.split(F.regexp_replace(F.regexp_replace(text, _COMMENT, ""), ABBREVIATED, " $1"), SENTENCE_END), lambda s: s.rlike(critical)), units))
    spoken = F.flatten(F.transform(F.transform(F.filter(cut, lambda s: s.rlike(critical)), normalised), lambda s: _parts(s, known)))
    found = F.transform(spoken, lambda s: F.coalesce(F.try_element_at(known, s), F.lit("?")))
    none = F.array().cast("array<string>")
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f"<{'><'.join(ids)}>").alias("ids"), F.lit(open_).alias("open"))
                      for (name, ids), open_ in zip(rules, guarded(rules))])
    # the sequence as text, "<a><b>", so that a rule is a substring
    matched = F.aggregate(
        steps, F.struct(F.col("sequence").alias("left"), none.alias("names")),
        lambda state, rule: F.when(F.contains(state["left"], rule["ids"]) & ~(
            rule["open"] & F.contains(state["left"], F.concat(rule["ids"], F.lit("<?>")))), F.struct(
            F.replace(state["left"], rule["ids"], F.lit("|")).alias("left"),
            F.array_union(state["names"], F.array(rule["name"])).alias("names"))).otherwise(state))
    rows = docs.select(F.col(id_col).alias("id_"), F.coalesce(
        F.when(text.rlike(critical), found), none).alias("found"))
    rows = rows.withColumn("sequence", F.concat_ws("", F.transform("found", lambda s: F.concat(F.lit("<"), s, F.lit(">")))))
    hit = F.size("found") > 0
    rows = rows.withColumn("matched", F.when(hit, matched))
    left = F.regexp_replace(F.replace(F.col("matched.left"), F.lit("<?>"), F.lit("")), "[^<]", "")
    return rows.select(
        F.col("id_").alias(id_col), F.filter("found", lambda s: s != "?").alias("sentence_ids"),
        F.coalesce("matched.names", none).alias("licences"),
        F.coalesce(F.length(left), F.lit(0)).alias("unmatched"),
        F.size(F.filter("found", lambda s: s == "?")).alias("unknown"))
