"""Operator 2: license scan by canonical digest.

A text is brought to a canonical form: lower case, copyright lines dropped,
equivalent spellings unified, punctuation and white space collapsed. Its SHA-256
digest is looked up among the digests of known license texts, brought to the same form
by the same functions. Whole documents, their single lines and their paragraphs (lines
between blank ones, joined) are looked up: a license that fills the document, and a
notice that stands in it, wrapped or not. Only units as long as some known form are
hashed, and only texts with one of a few words of which every known form holds one are
brought to the form at all.

Only DataFrame functions run here. The known texts are a parameter of fixed size (the
default list below), so their digests are broadcast; documents are not shuffled but
for the few rows with a match.

Cases: a null text, or one without words, matches nothing; repeated rows are scanned
row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import numbered

#: Known texts (fixed values): the usual notices; ``entire_texts`` adds whole licenses.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
for _code, _name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
                     ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    KNOWN += [(f"CC-{_code}-4.0", t) for t in (f"Licensed under CC {_code} 4.0.", f"This work is licensed under a Creative Commons {_name} 4.0 International License.")]

TEXTS = Path(__file__).parent / "license_texts"
#: Lines that stand before the short licenses, or not.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License", "The ISC License"],
          "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"], "BSD-2-Clause": ["BSD License", "BSD 2-Clause License"], "BSD-3-Clause": ["BSD License", "BSD 3-Clause License"]}


def entire_texts() -> list[tuple[str, str]]:
    """Whole licenses with their usual titles, and the conditions of the BSD licenses,
    which often are one paragraph."""
    out = []
    for path in sorted(TEXTS.glob("*.txt")):
        name, text = path.stem, path.read_text()
        bodies = [text]
        if name == "Apache-2.0":
            bodies.append(text[:text.index("APPENDIX:")])
        if name == "Unlicense":
            bodies += [text.replace("http://unlicense.org", "https://unlicense.org"), text[:text.index("For more information")]]
        if name.startswith("BSD"):
            count = iter("123")
            numbered_items = "".join(f" {next(count)}." + x[2:] if x.startswith(" * ") else x for x in text.splitlines(True))
            bodies = [b.replace("copyright holder nor", owner) for b in (text, numbered_items) for owner in ("copyright holder nor", "University nor", "author nor")]
            bodies += [b.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR") for b in bodies]
            out += [("BSD", b[:b.index("THIS SOFTWARE")]) for b in bodies]
            name = "BSD"
        titles = ["", *TITLES.get(path.stem, [])]
        rights = ["", "All rights reserved."] if path.stem in TITLES else [""]
        out += [(name, f"{t}\n{r}\n{b}") for b in bodies for t in titles for r in rights]
    return out

#: Equivalent spellings (fixed values): text that must occur, pattern, canonical form.
SPELLINGS = [("licence", "licence", "license"), ("https", "https", "http"), ("organisation", "organisation", "organization"),
             ("merchantib", "merchantibility", "merchantability"), ("v", "v(?<![a-z0-9]v)(?:er)?(?=[ \n]?[0-9])", "version")]

#: A copyright line, not a line of running text that was wrapped before the word.
OWNED = (r"(?m)^[ \t]*(copyright(?![ \t]+(?:notices?|holders?|owners?|licen[sc]es?|statements?|laws?|interests?|and|or|in|to|for|treaty)\b)"
         r"|\(c\)(?![ \t]+(?:you|under|to|in|for|if|any|a)\b)|©)[^\n]*$")


def canonical_lines(text: Column) -> Column:
    """Canonical form with its line breaks; a spelling is only searched for in texts
    that hold its fixed part."""
    text = F.lower(text)
    owned = text.contains("copyright") | text.contains("(c)") | text.contains("©")
    text = F.when(owned, F.regexp_replace(text, OWNED, " ")).otherwise(text)
    text = F.regexp_replace(text, r"[^a-z0-9\n\x{80}-\x{10FFFF}]+", " ")
    for part, form, word in SPELLINGS:
        text = F.when(text.contains(part), F.regexp_replace(text, form, word)).otherwise(text) if part != "v" else F.regexp_replace(text, form, word)
    return text


def lines_of(form: Column) -> Column:
    """Canonical lines; those that are not empty, joined by spaces, are the whole form."""
    return F.transform(F.split(form, "\n", -1), lambda x: F.trim(x))


def whole_of(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def paragraphs_of(lines: Column) -> Column:
    """Runs of two and more lines without an empty one, joined by spaces."""
    runs = F.transform(F.split(F.array_join(lines, "\n"), "\n\n+"), lambda x: F.btrim(x, F.lit("\n")))
    return F.transform(F.filter(runs, lambda x: x.contains("\n")), lambda x: F.translate(x, "\n", " "))


#: What a word of a canonical form may have been spelled from: all spellings of "license"
#: hold "licen"; words with another unified spelling are no signs.
_UNIFIED = [word for _, _, word in SPELLINGS if word != "license"]


def signs_of(forms: list[str]) -> list[str] | None:
    """A few strings of which a lower-cased text holds one if its form holds a known one:
    words stand in a canonical form as they stood in the text, but for unified
    spellings. Long words that many forms share come first; None if some form has no
    such word."""
    signs: list[str] = []
    left = [{"licen" if "license" in w else w for w in f.split(" ") if not any(u in w.replace("license", "") for u in _UNIFIED)} for f in forms]
    while left:
        seen = Counter(w for words in left for w in words if w)
        if not all(any(words) for words in left):
            return None
        best = max(seen, key=lambda w: (w == "licen", len(w) >= 8, seen[w], len(w), w))
        signs.append(best)
        left = [words for words in left if best not in words]
    return signs


def holds_sign(text: Column, signs: list[str] | None) -> Column:
    if signs is None:
        return F.lit(True)
    # an array of one, so that the lower case is made once for all signs
    return F.exists(F.array(F.lower(text)), lambda low: reduce(lambda a, b: a | b, [low.contains(w) for w in signs], F.lit(False)))


def known_digests(spark, known=None) -> tuple[DataFrame, list[int], list[str] | None]:
    """(license, digest: one row per distinct canonical text (first license wins);
    lengths of the texts; their signs)."""
    known = KNOWN + entire_texts() if known is None else known
    rows = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate(known)], "k int, license string, text string")
    rows = rows.withColumn("form", whole_of(lines_of(canonical_lines(F.col("text"))))).filter("form <> ''")
    found = rows.groupBy("form", F.sha2("form", 256).alias("digest"), F.length("form").alias("n")).agg(F.min_by("license", "k").alias("license")).collect()
    digests = spark.createDataFrame([(r["digest"], r["license"]) for r in found], "digest string, license string")
    return digests, sorted({r["n"] for r in found}), signs_of([r["form"] for r in found])


def license_scan(docs: DataFrame, known=None, id_col: str = "doc_id") -> DataFrame:
    """doc_id, license (of the whole text, null if none), line_licenses (distinct
    licenses of single lines and paragraphs, in order), n_license_lines (those lines
    and paragraphs), of every row."""
    digests, lengths, signs = known_digests(docs.sparkSession, known)
    rows = numbered(docs).select("rid", F.col(id_col), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The generator computes the canonical lines once, for the whole and for each part.
    forms = rows.filter(holds_sign(F.col("text"), signs)).select("rid", F.explode(F.array(lines_of(canonical_lines(F.col("text"))))).alias("lines"))
    fits = lambda x: F.length(x).isin(lengths)
    unit = lambda whole: lambda x: F.struct(F.lit(whole).alias("whole"), x.alias("unit"))
    parts = F.concat(F.col("lines"), paragraphs_of(F.col("lines")))
    units = forms.select("rid", F.explode(F.concat(F.transform(F.filter(F.array(whole_of(F.col("lines"))), fits), unit(True)),
                                                   F.transform(F.filter(parts, fits), unit(False)))).alias("u"))
    found = (units.select("rid", "u.whole", F.sha2("u.unit", 256).alias("digest")).join(F.broadcast(digests), "digest").groupBy("rid")
             .agg(F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
                  F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("line_licenses"),
                  F.sum((~F.col("whole")).cast("long")).alias("n_license_lines")))
    return rows.select("rid", id_col).join(found, "rid", "left").select(
        id_col, "license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"))
