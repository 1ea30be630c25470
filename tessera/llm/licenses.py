"""License scans by sentence rules.

A text is normalised and cut into sentences; a sentence known from a licence
text or notice is mapped to its identifier; ordered licence rules are then
matched against the sequence of identifiers.  Rules are tried in order and a
sentence that one rule has used is not used by a later one, so a specific
licence ("GPL, version 3, or later") is not reported again as its general form.

Sentences are compared as a whole, so patterns stay simple and anchored; a
pattern's first word picks the few patterns that can match at all.  Everything
is DataFrame functions on the row; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_names

#: "This file is", "The source code is": what a notice may begin with.
SUBJECT = r"((this|the) (\w+ ){1,3}(is|are) )?"
OPTION = r"or (\(?at your option\)? )?any later version"
#: Kinds of GNU licences and their versions.
GNU = (("gpl", "general", ("2", "3")), ("lgpl", "(lesser|library) general", ("2.1", "2", "3")), ("agpl", "affero general", ("3",)))


def _gnu_sentences() -> list[tuple[str, str]]:
    """The notices of the FSF, with the version in the sentence or after it."""
    out = []
    for kind, words, versions in GNU:
        licence = rf"gnu {words} public licen[sc]e"
        said = r"you can redistribute it and/or modify it under the terms of "
        by = r",? as published by the free software foundation"
        for v in versions:
            n = v.replace(".", r"\.")
            number = n if "." in v else rf"{n}(\.0)?"
            out += [(f"fsf-{kind}{v}-later", rf"{said}the {licence}{by},? either version {number} of the license,? {OPTION}"),
                    (f"fsf-{kind}{v}", rf"{said}(the {licence},? version {number}{by}|version {number} of the {licence}{by}|the {licence}{by},? version {number}( of the license)?)")]
            if kind != "gpl":
                out.append((f"{kind}{v}-notice", rf"{SUBJECT}licensed under the {licence},? version {number}"))
        out.append((f"fsf-{kind}", said + "the " + licence + by))
        if kind != "gpl":
            out.append((f"{kind}-notice", rf"{SUBJECT}licensed under the {licence}"))
    return out + [(f"either{v}-later", rf"either version {n} of the license, {OPTION}") for v, n in (("2.1", r"2\.1"), ("2", "2"), ("3", "3"))]


#: SPDX identifiers; the sentence before them is "spdx-license-identifier".
SPDX = ("MIT OR Apache-2.0", "Apache-2.0 OR MIT", "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "Unlicense", "CC0-1.0",
        "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
        *[f"{k.upper()}-{v if '.' in v else v + '.0'}{end}" for k, _, vs in GNU for v in vs for end in ("", "-only", "-or-later")])
#: Sentence identifiers and the normalised sentences (regular
#: expressions over lower-case words separated by single spaces).
SENTENCES: tuple[tuple[str, str], ...] = (
    ("apache2-notice", SUBJECT + r"licensed under the apache licen[sc]e,? version 2(\.0)?( \(the \"?license)?"),
    ("apache2-obtain", r"you may obtain a copy of the license at( https?://www\.apache\.org/licenses/license-2\.0)?"),
    ("compliance", r"you may not use this file except in compliance with the license"),
    ("mit-notice", SUBJECT + r"(released|licensed|distributed) under the (terms of the )?mit licen[sc]e"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy.*"),
    ("mit-keep", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("as-is", r"(the|this) software is provided \"?as is\"?,? without warranty of any kind.*"),
    ("gpl3-notice", SUBJECT + r"licensed under the gnu general public licen[sc]e,? version 3"),
    ("gpl2-notice", SUBJECT + r"licensed under the gnu general public licen[sc]e,? version 2"),
    ("gpl-notice", SUBJECT + r"licensed under the gnu general public licen[sc]e"),
    *_gnu_sentences(),
    ("or-later", r"(either version [23] of the license, )?or (\(?at your option\)? )?any later version"),
    ("bsd-notice", SUBJECT + r"(released|licensed|distributed) under the (new |modified )?bsd licen[sc]e"),
    ("cc-by-nc-4", SUBJECT + r"licensed under cc by-nc 4(\.0)?"),
    ("cc-by-sa-4", SUBJECT + r"licensed under cc by-sa 4(\.0)?"),
    ("cc-by-4", SUBJECT + r"licensed under cc by 4(\.0)?"),
    ("cc0", SUBJECT + r"(released|licensed) under cc0( 1\.0)?"),
    ("rights", r"all rights reserved"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
                   r"in the documentation and/or other materials provided with the distribution"),
    ("bsd-names", r"neither the names? of (\S+ ){1,12}nor the names of (its|their) contributors may be used to endorse or promote products "
                  r"derived from this software without specific prior written permission"),
    ("bsd-as-is", r"this software is provided by (\S+ ){1,12}[\"'`]*as is[\"'`]* and any express or implied warranties.*"),
    ("isc-grant", r"permission to use, copy, modify,? (and|and/or) distribute this software for any purpose with or without fee is hereby granted, "
                  r"provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl2-notice", r"this source code form is subject to the terms of the mozilla public licen[sc]e,? v(ersion 2\.0)?"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("spdx", r"spdx-license-identifier"),
    *[(f"spdx-{x.lower().replace(' ', '-')}", x.lower().replace(".", r"\.") + r"( \*/| -->)?") for x in SPDX],
)


def _gnu_rules(kind: str, versions: tuple[str, ...]) -> list[tuple[str, tuple[str, ...]]]:
    out = []
    for v in versions:
        name = f"{kind.upper()}-{v if '.' in v else v + '.0'}"
        later = [(f"fsf-{kind}{v}-later",), (f"fsf-{kind}", f"either{v}-later"), (f"fsf-{kind}{v}", "or-later"),
                 (f"{kind}{v}-notice", f"either{v}-later"), (f"{kind}{v}-notice", "or-later")]
        out += [(f"{name}-or-later", x) for x in later] + [(name, (f"fsf-{kind}{v}",)), (name, (f"{kind}{v}-notice",))]
    return out + [(kind.upper(), (f"fsf-{kind}",)), (kind.upper(), (f"{kind}-notice",))]


#: Licence rules in the order in which they are tried; a rule is
#: a sequence of sentence identifiers that follow one another.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache2-notice", "compliance", "apache2-obtain")),
    ("Apache-2.0", ("apache2-notice",)),
    ("MIT", ("mit-grant", "mit-keep", "as-is")),
    ("MIT", ("mit-notice",)),
    *[(x, ("spdx", f"spdx-{x.lower().replace(' ', '-')}")) for x in SPDX],
    *[r for kind, _, versions in GNU for r in _gnu_rules(kind, versions)],
    *[(name, before + ("bsd-grant", "bsd-source", "bsd-binary") + names) for name, names in (("BSD-3-Clause", ("bsd-names",)), ("BSD-2-Clause", ()))
      for before in (("rights",), ())],
    ("BSD", ("bsd-notice",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC0-1.0", ("cc0",)),
    ("Proprietary", ("rights",)),
)
#: Where sentences end, besides blank lines: marks that are followed by white
#: space.  A single line end is where a line wraps or a heading ends.
BREAK = r"[.;:!?]+(?=\s|$)"


def lines(text: str | Column) -> Column:
    """A whole text in lower case, without comment marks and quotes at the ends
    of its lines; sentences are apart by an empty line.  "" for NULL."""
    c = F.col(text) if isinstance(text, str) else text
    cut = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), BREAK, "\n\n"), r"\r\n?", "\n")
    return F.regexp_replace(F.regexp_replace(cut, r"[ \t\x0B\f]+", " "), r"(?md)^[ #*/\-\"'(]+|[ *\"')]+$", "")


def sentence_id(sentence: Column) -> Column:
    """Identifier of a known sentence, NULL for any other."""
    out = None
    for name, pattern in SENTENCES:
        known = sentence.rlike(f"^(?:{pattern})$")
        out = F.when(known, F.lit(name)) if out is None else out.when(known, F.lit(name))
    return out


def _any_sentence() -> str:
    """Any sentence on whole lines, wrapped or not."""
    return "(?md)^(?:" + "|".join(f"(?:{p})" for _, p in SENTENCES).replace(" ", r"[ \n]") + ")$"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus sentence_ids (array, in text order) and licences (array).

    ``licences`` has each licence once, in the order of the rules.  No known
    sentence (also NULL and empty texts): empty arrays.  Columns of these names
    are replaced; all others pass through.
    """
    found = F.regexp_extract_all(lines(text), F.lit(_any_sentence()), F.lit(0))
    known = F.filter(F.transform(found, lambda s: sentence_id(F.replace(s, F.lit("\n"), F.lit(" ")))), lambda x: x.isNotNull())
    keep = [c for c in docs.columns if c.lower() not in ("sentence_ids", "licences")]
    found = docs.select(*[F.col(f"`{c}`") for c in keep], known.alias("sentence_ids"))
    rest, *names = free_names(found, "_left", *[f"_r{i}" for i in range(len(RULES))])
    # identifiers between bars; a rule's match leaves a single bar behind
    left = F.concat(F.lit("|"), F.array_join("sentence_ids", "||"), F.lit("|"))
    found = found.withColumn(rest, left)
    for column, (name, ids) in zip(names, RULES):
        sequence = "".join(f"|{x}|" for x in ids)
        found = found.withColumn(column, F.when(F.contains(rest, F.lit(sequence)), F.lit(name)))
        found = found.withColumn(rest, F.replace(F.col(rest), F.lit(sequence), F.lit("#")))
    return (found.withColumn("licences", F.array_distinct(F.array_compact(F.array(*names))))
            .drop(rest, *names))


def document_licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentence_ids, sentence_ids and licences (joined by commas)."""
    out = scan(docs.select("doc_id", "text")).drop("text")
    return out.select("doc_id", F.size("sentence_ids").cast("long").alias("n_known"),
                      F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))
