"""Licence scans by sentence rules.

A text is cut into sentences, the sentences are normalised (lower case; only letters, digits, and
dots or hyphens inside words; single blanks), and known ones are mapped to identifiers by a hash
join with the small table of sentence rules. A version number in a rule is written ``{v}`` and
becomes part of the identifier. A document's identifiers in text order are then matched against the
ordered licence rules: the first rule that occurs takes its identifiers out of the sequence, then
the next rule is tried on the rest. Identifiers that no rule takes are reported as ``unmatched``.

A sentence ends at a full stop, colon, semicolon, or question or exclamation mark before a blank,
and at an empty line. A rule whose wording is cut by that is a sequence of sentences; the table is
made from the wordings by the same expressions. Of a sentence on several lines every run of lines is
looked up; a known run hides those inside it. SPDX tags name licences by their own identifiers.

The table holds notices, and full texts of the GNU, Apache and Mozilla licences by their titles; a
licence in other words is not found.

Defined results: a null or empty text, and one without known sentences, has no licence and gives no
row. A sentence that repeats counts each time, a licence is listed once. Repeated rows of a document
(equal doc_id and text) are read each and listed each. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import text_or_empty

# Sentences of public licences and licence notices, as normalised.
SENTENCES = (
    ("released-mit", "released under the mit license"),
    ("licensed-mit", "licensed under the mit license"),
    ("mit-title", "mit license"),
    ("mit-title", "the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("apache-{v}", "licensed under the apache license version {v}"),
    ("apache-the-{v}", "licensed under the apache license version {v} the license"),
    ("apache-compliance", "you may not use this file except in compliance with the license"),
    ("apache-copy", "you may obtain a copy of the license at"),
    ("gpl-{v}", "this work is licensed under the gnu general public license version {v}"),
    ("gpl-{v}", "licensed under the gnu general public license version {v}"),
    ("gpl-{v}", "licensed under the gnu gpl version {v}"),
    ("gpl-free-{v}+", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version {v} of the license or at your option any later version"),
    ("lgpl-{v}", "licensed under the gnu lesser general public license version {v}"),
    ("agpl-{v}", "licensed under the gnu affero general public license version {v}"),
    ("gpl-warranty", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("mpl-{v}", "this source code form is subject to the terms of the mozilla public license v {v}"),
    ("mpl-{v}", "licensed under the mozilla public license version {v}"),
    ("cc-by-{v}", "licensed under cc by {v}"),
    ("cc-by-sa-{v}", "licensed under cc by-sa {v}"),
    ("cc-by-nd-{v}", "licensed under cc by-nd {v}"),
    ("cc-by-nc-{v}", "licensed under cc by-nc {v}"),
    ("cc-by-nc-sa-{v}", "licensed under cc by-nc-sa {v}"),
    ("cc-by-nc-nd-{v}", "licensed under cc by-nc-nd {v}"),
    ("cc0-{v}", "released under cc0 {v}"),
    ("public-domain", "this work is released into the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("bsd-terms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("licensed-bsd", "licensed under the bsd license"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("all-rights-reserved", "all rights reserved"),
    ("gpl-free-{v}+", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."),
    ("gpl-free-{v}+", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version."),
    ("gpl-only-{v}", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version {v} as published by the Free Software Foundation."),
    ("gpl-only-{v}", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version {v} of the License."),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("lgpl-free-{v}+", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."),
    ("lgpl-free-{v}+", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version."),
    ("lgpl-free-{v}+", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."),
    ("lgpl-warranty", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("agpl-free-{v}+", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."),
    ("bsd-name", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("gpl-title-{v}", "GNU GENERAL PUBLIC LICENSE Version {v}, 29 June 2007"),
    ("lgpl-title-{v}", "GNU LESSER GENERAL PUBLIC LICENSE Version {v}, 29 June 2007"),
    ("lgpl-title-{v}", "GNU LESSER GENERAL PUBLIC LICENSE Version {v}, February 1999"),
    ("gpl-title-{v}", "GNU GENERAL PUBLIC LICENSE Version {v}, June 1991"),
    ("agpl-title-{v}", "GNU AFFERO GENERAL PUBLIC LICENSE Version {v}, 19 November 2007"),
    ("apache-title-{v}", "Apache License Version {v}, January 2004 http://www.apache.org/licenses/"),
    ("mpl-title-{v}", "Mozilla Public License Version {v}"),
)
# Licence rules in the order in which they are tried; ``{v}`` stands for a version.
# A full text holds its own notice as an example.
RULES = (
    ("GPL-{v}", ("gpl-title-{v}", "gpl-free-{v}+", "gpl-warranty")),
    ("LGPL-{v}", ("lgpl-title-{v}", "lgpl-free-{v}+", "lgpl-warranty")),
    ("AGPL-{v}", ("agpl-title-{v}", "agpl-free-{v}+", "gpl-warranty")),
    ("Apache-{v}", ("apache-title-{v}", "apache-the-{v}", "apache-compliance", "apache-copy")),
    ("MPL-{v}", ("mpl-title-{v}", "mpl-{v}")),
    ("GPL-{v}", ("gpl-title-{v}",)),
    ("LGPL-{v}", ("lgpl-title-{v}",)),
    ("AGPL-{v}", ("agpl-title-{v}",)),
    ("Apache-{v}", ("apache-title-{v}",)),
    ("MPL-{v}", ("mpl-title-{v}",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD", ("bsd-terms", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD", ("bsd-terms", "bsd-source", "bsd-binary")),
    ("Apache-{v}", ("apache-the-{v}", "apache-compliance", "apache-copy")),
    ("Apache-{v}", ("apache-{v}", "apache-compliance", "apache-copy")),
    ("GPL-{v}-or-later", ("gpl-free-{v}+", "gpl-warranty")),
    ("GPL-{v}-or-later", ("gpl-free-{v}+",)),
    ("LGPL-{v}-or-later", ("lgpl-free-{v}+", "lgpl-warranty")),
    ("LGPL-{v}-or-later", ("lgpl-free-{v}+", "gpl-warranty")),
    ("LGPL-{v}-or-later", ("lgpl-free-{v}+",)),
    ("AGPL-{v}-or-later", ("agpl-free-{v}+", "gpl-warranty")),
    ("AGPL-{v}-or-later", ("agpl-free-{v}+",)),
    ("GPL-{v}", ("gpl-only-{v}", "gpl-warranty")),
    ("GPL-{v}", ("gpl-only-{v}",)),
    ("Apache-{v}", ("apache-the-{v}",)),
    ("Apache-{v}", ("apache-{v}",)),
    ("GPL-{v}", ("gpl-{v}",)),
    ("LGPL-{v}", ("lgpl-{v}",)),
    ("AGPL-{v}", ("agpl-{v}",)),
    ("MPL-{v}", ("mpl-{v}",)),
    ("CC-BY-NC-SA-{v}", ("cc-by-nc-sa-{v}",)),
    ("CC-BY-NC-ND-{v}", ("cc-by-nc-nd-{v}",)),
    ("CC-BY-NC-{v}", ("cc-by-nc-{v}",)),
    ("CC-BY-SA-{v}", ("cc-by-sa-{v}",)),
    ("CC-BY-ND-{v}", ("cc-by-nd-{v}",)),
    ("CC-BY-{v}", ("cc-by-{v}",)),
    ("CC0-{v}", ("cc0-{v}",)),
    ("ISC", ("isc-grant",)),
    ("BSD", ("licensed-bsd",)),
    ("MIT", ("released-mit",)),
    ("MIT", ("licensed-mit",)),
    ("Unlicense", ("unlicense",)),
    ("Public-Domain", ("public-domain",)),
)
VERSION = r"[0-9]+(?:\.[0-9]+)*"


# Identifiers that a tag may name; others are reported as unmatched.
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 "
    "BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 "
    "CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 ECL-2.0 EPL-1.0 EPL-2.0 "
    "EUPL-1.1 EUPL-1.2 GFDL-1.3-only GFDL-1.3-or-later GPL-2.0 GPL-2.0+ GPL-2.0-only GPL-2.0-or-later GPL-3.0 "
    "GPL-3.0+ GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1+ LGPL-2.1-only "
    "LGPL-2.1-or-later LGPL-3.0 LGPL-3.0+ LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL "
    "MulanPSL-2.0 NCSA OFL-1.1 OpenSSL PostgreSQL PSF-2.0 Python-2.0 Unicode-3.0 Unlicense UPL-1.0 Vim WTFPL X11 "
    "Zlib"
).split()
TAG = "spdx-license-identifier:"
SPDX_ID = r"[a-z0-9](?:[.\-]?[a-z0-9])*\+?"


def normalised(text: Column) -> Column:
    """Lower-case words, line breaks kept; dots and hyphens stay only inside a word."""
    bare = F.regexp_replace(F.lower(text), r"[^a-z0-9.\-\n]+", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?<![a-z0-9])[.\-]+|[.\-]+(?=[ \n]|$)", " "), " +", " ")


def sentences(text: Column) -> Column:
    return F.split(text, rf"(?<=[.;:!?])(?<! v\.)(?<!(?i:{TAG}))\s+|\r?\n[ \t]*\r?\n")


def words_of_lines(sentence: Column) -> Column:
    """The normalised lines that have words."""
    return F.filter(F.transform(F.split(normalised(sentence), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def form_of(piece: Column) -> Column:
    return F.regexp_replace(piece, rf"(?<= ){VERSION}(?= |$)", "{v}")


def sentence_rules(spark: SparkSession) -> tuple[dict[str, str], dict[str, list[tuple[str, ...]]]]:
    """Form of a sentence -> its identifier, and identifier of SENTENCES -> the sequences of them that
    its wordings are cut into, by the expressions that cut the documents."""
    wordings = spark.createDataFrame(
        [(n, s.replace("{v}", "1.0")) for n, (_, s) in enumerate(SENTENCES)], "n int, text string"
    )
    cuts = wordings.select(
        "n", F.transform(sentences(F.col("text")), lambda x: form_of(F.array_join(words_of_lines(x), " "))).alias("forms")
    )
    known: dict[str, str] = {}
    sequences: dict[str, list[tuple[str, ...]]] = {}
    for n, forms in sorted(cuts.collect()):
        name = SENTENCES[n][0]
        forms = [form for form in forms if form]
        for k, form in enumerate(forms):
            own = name if "{v}" in form else name.replace("-{v}", "")
            own = own if len(forms) == 1 else f"{own}/{k + 1}of{len(forms)}"
            known.setdefault(form, own)
        sequence = tuple(known[form] for form in forms)
        if sequence not in sequences.setdefault(name, []):
            sequences[name].append(sequence)
    return known, sequences


def found_sentences(docs: DataFrame, known: dict[str, str]) -> DataFrame:
    """row, doc_id, place, start, end, name for every known run of lines of a sentence, and every
    identifier of a tag."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).select("row", "doc_id", F.posexplode(sentences(F.col("text"))).alias("place", "sentence"))
    # a known run starts with a line that starts like a rule; it has no more lines than words
    starts = {" ".join(form.split()[:k]) for form in known for k in (1, 2)}
    numbered = sorted({form.split()[0] for form in known if form.split()[1:2] == ["{v}"]})
    longest = max(len(form.split()) for form in known)
    lines = rows.select("row", "doc_id", "place", "sentence", words_of_lines(F.col("sentence")).alias("lines"))

    def heading(line: Column) -> Column:
        return F.substring_index(line, " ", 2).isin(starts) | F.substring_index(line, " ", 1).isin(numbered)

    heads = F.filter(
        F.transform("lines", lambda x, i: F.when(heading(x), i).otherwise(F.lit(-1))), lambda i: i >= 0
    )
    runs = lines.select(
        "row", "doc_id", "place", "lines", F.explode(heads).alias("start")
    ).select("row", "doc_id", "place", "start", F.slice("lines", F.col("start") + 1, longest).alias("lines")).select(
        "row", "doc_id", "place", "start",
        F.posexplode(F.transform(
            "lines", lambda _, i: F.array_join(F.slice("lines", F.lit(1), i + 1), " ")
        )).alias("more", "piece"),
    )
    runs = runs.select(
        "row", "doc_id", "place", "start", (F.col("start") + F.col("more")).alias("end"),
        form_of(F.col("piece")).alias("form"),
        F.regexp_extract("piece", rf"(?<= )({VERSION})(?= |$)", 1).alias("version"),
    )
    rules = docs.sparkSession.createDataFrame(list(known.items()), "form string, rule string")
    marked = runs.join(F.broadcast(rules), "form").select(
        "row", "doc_id", "place", "start", "end", F.regexp_replace("rule", r"\{v\}", F.col("version")).alias("name")
    )
    return marked.unionByName(found_tags(rows))


def found_tags(rows: DataFrame) -> DataFrame:
    """The identifiers of SPDX tags as ``spdx=`` names if known, else ``spdx-``; operators and
    exceptions are left out."""
    bracketed = rf"(?:\([ \t]*)*{SPDX_ID}(?:[ \t]*\))*"
    value = rf"(?i){TAG}[ \t]*({bracketed}(?:[ \t]+(?:and|or|with)[ \t]+{bracketed})*)"
    values = F.regexp_extract_all("sentence", F.lit(value), F.lit(1))
    found = rows.where(F.lower("sentence").contains(TAG)).select(
        "row", "doc_id", "place", F.explode(values).alias("value")
    )
    named = F.regexp_replace("value", rf"(?i)[ \t]with[ \t]+{SPDX_ID}", " ")
    ids = F.regexp_extract_all(named, F.lit(rf"(?i){SPDX_ID}"), F.lit(0))
    found = found.select("row", "doc_id", "place", F.posexplode(ids).alias("start", "id")).where(
        ~F.lower("id").isin("and", "or")
    )
    known = rows.sparkSession.createDataFrame([(x.lower(), x) for x in SPDX], "low string, full string")
    return found.join(F.broadcast(known), F.lower("id") == F.col("low"), "left").select(
        "row", "doc_id", "place", "start", F.col("start").alias("end"),
        F.coalesce(F.concat(F.lit("spdx="), "full"), F.concat(F.lit("spdx-"), F.lower("id"))).alias("name"),
    )


def _namer(name: str):
    return lambda version: F.replace(F.lit(name), F.lit("{v}"), version)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, licenses (array), unmatched (array) for every document with a known sentence."""
    known, sequences = sentence_rules(docs.sparkSession)
    found = found_sentences(docs, known)
    named = F.concat(F.lit("<"), "name", F.lit(">"))
    ordered = found.groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "start", "end", named.alias("name")))).alias("marks")
    )
    # a known run hides those inside it
    shown = F.filter(
        "marks",
        lambda m: ~F.exists(
            "marks",
            lambda o: (o["place"] == m["place"]) & (o["start"] <= m["start"]) & (o["end"] >= m["end"])
            & (o["end"] - o["start"] > m["end"] - m["start"]) & ~m["name"].startswith("<spdx"),
        ),
    )
    rest = ordered.select(
        "row", "doc_id", F.array_join(F.transform(shown, lambda m: m["name"]), "").alias("rest"),
        F.array().cast("array<string>").alias("licenses"),
    )
    steps = [
        (name, [mark for part in parts for mark in part])
        for name, rule in RULES
        for parts in sorted(product(*(sequences[x] for x in rule)), key=lambda parts: -sum(map(len, parts)))
    ]
    for license_name, rule in steps:
        pattern = "".join(f"<{mark}>" for mark in rule)
        fixed = pattern.replace(".", r"\.").replace("+", r"\+")
        first, *others = fixed.split("{v}")
        regex = first + "".join((f"({VERSION})" if k == 0 else r"\1") + part for k, part in enumerate(others))
        versions = F.regexp_extract_all("rest", F.lit(regex), F.lit(1 if others else 0))
        names = F.transform(versions, _namer(license_name))
        rest = rest.select(
            "row", "doc_id", F.regexp_replace("rest", regex, "<>").alias("rest"),
            F.concat("licenses", names).alias("licenses"),
        )
    tagged = F.regexp_extract_all("rest", F.lit("<spdx=([^<>]+)>"), F.lit(1))
    rest = rest.select(
        "row", "doc_id", F.regexp_replace("rest", "<spdx=[^<>]+>", "<>").alias("rest"),
        F.concat("licenses", tagged).alias("licenses"),
    )
    left = F.filter(F.split("rest", r"[<>]+"), lambda x: x != "")
    return rest.select("doc_id", F.array_distinct("licenses").alias("licenses"), left.alias("unmatched"))


def op4(docs: DataFrame) -> DataFrame:
    return scan(docs).select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.array_join("unmatched", ",").alias("unmatched"),
    )
