"""License scans: Dice coefficient over word bigrams between text units and templates."""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least Dice coefficient of a match.
LEAST_DICE = 0.8

# Notices and short texts of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
}


def _plain(text: str) -> list[str]:
    """Words as the columns below make them: lower-case runs of ASCII letters and digits."""
    kept = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text.lower())
    return kept.split()


def _templates(templates: dict[str, str]) -> list[dict]:
    out = []
    for name, text in sorted(templates.items()):
        words = _plain(text)
        grams = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
        out.append({"name": name, "n": len(grams), "grams": grams})
    return [t for t in out if t["n"]]


def _prefixes(known: list[dict], least: float) -> list[str]:
    """Bigrams of which every matching text holds one.

    A unit that reaches ``least`` shares at least ``n * least / (2 - least)`` of a
    template's n bigrams, so it cannot lack all of any ``n`` minus that many, plus one.
    Of each template those are taken that most templates have, then the longest.
    """
    held = Counter(g for t in known for g in t["grams"])
    chosen = set()
    for t in known:
        size = t["n"] - math.ceil(t["n"] * least / (2 - least) - 1e-9) + 1
        chosen.update(sorted(t["grams"], key=lambda g: (-len(g), -held[g], g))[: max(1, min(size, t["n"]))])
    return sorted(chosen)


def _normalised(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9\n]+", " ")


def _units(kept: Column) -> Column:
    """Normalised lines and, where they differ, blank-line paragraphs, each as an array of words."""
    lines = F.split(kept, "\n")
    blocks = F.transform(F.split(kept, r"\n[ ]*\n"), lambda b: F.replace(b, F.lit("\n"), F.lit(" ")))
    plain = F.transform(F.concat(lines, blocks), lambda u: F.trim(F.regexp_replace(u, " +", " ")))
    return F.array_distinct(plain)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_DICE) -> DataFrame:
    """One row per row of ``docs``: doc_id, license, dice, n_matches, licenses.

    A unit (line or paragraph) is compared only with templates whose number of
    bigrams lies within ``least / (2 - least)`` of its own: beyond, the coefficient
    cannot reach ``least``.  Texts without any of the bigrams that a match cannot lack
    are passed over before that.  ``license`` is the best match, ties to the first name;
    ``n_matches`` counts distinct matching units, ``licenses`` lists all names.
    Null, empty and non-matching texts have null license and dice, and 0 matches.
    No shuffle: rows are judged on their own, so repeated rows and ids do not matter.
    """
    known = _templates(TEMPLATES if templates is None else templates)
    listed = F.from_json(F.lit(json.dumps(known)), "array<struct<name:string,n:int,grams:array<string>>>")
    ratio = least / (2 - least) * (1 - 1e-12)  # a size just at the bound stays in, however it is rounded
    low, high = min((t["n"] for t in known), default=1) * ratio, max((t["n"] for t in known), default=0) / ratio

    def grams(unit: Column) -> Column:
        words = F.split(unit, " ")
        n = F.size(words)
        return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b)))

    def words_fit(unit: Column) -> Column:
        """A unit has at most as many distinct bigrams as spaces."""
        return F.length(unit) - F.length(F.replace(unit, F.lit(" "), F.lit(""))) >= F.lit(low)

    def matches(unit_grams: Column) -> Column:
        n = F.size(unit_grams)
        fitting = F.filter(listed, lambda t: (F.least(t["n"], n) >= F.greatest(t["n"], n) * F.lit(ratio)))
        scored = F.transform(fitting, lambda t: F.struct((F.lit(-2.0) * F.size(F.array_intersect(t["grams"], unit_grams)) / (t["n"] + n)).alias("loss"), t["name"].alias("name")))
        return F.filter(scored, lambda m: m["loss"] <= F.lit(-least))

    sized = F.filter(F.transform(F.filter(_units(F.col("kept")), words_fit), grams), lambda g: (F.size(g) >= F.lit(low)) & (F.size(g) <= F.lit(high)))
    units = F.filter(F.transform(sized, matches), lambda m: F.size(m) > 0)
    # words of a bigram may stand on two lines of a paragraph
    likely = F.col("kept").rlike(r"\b(?:" + "|".join(g.replace(" ", "[ \n]+") for g in _prefixes(known, least)) + r")\b") if known else F.lit(False)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _normalised(F.col("text")).alias("kept"))
    found = rows.select("doc_id", F.when(likely, units).alias("units"))
    # without a likely bigram there are no units: null, hence no match
    flat = found.select("doc_id", F.coalesce(F.size("units"), F.lit(0)).cast("long").alias("n_matches"), F.flatten("units").alias("all"))
    return flat.select(
        "doc_id", F.array_min("all")["name"].alias("license"), (-F.array_min("all")["loss"]).alias("dice"), "n_matches",
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("all", lambda m: m["name"])))).alias("licenses"),
    )


def oracle() -> str:
    """The registered query in DuckDB's SQL: units and bigrams unnested, joined with the templates."""
    rows = ", ".join(f"('{t['name']}', {t['n']}, '{g}')" for t in _templates(TEMPLATES) for g in t["grams"])
    return rf"""
        WITH templates(name, n, gram) AS (VALUES {rows}),
        kept AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\n]+', ' ', 'g') AS k FROM documents),
        raw AS (SELECT row_id, unnest(string_split(k, chr(10))) AS u FROM kept
                UNION ALL SELECT row_id, replace(unnest(regexp_split_to_array(k, '\n[ ]*\n')), chr(10), ' ') FROM kept),
        units AS (SELECT row_number() OVER () AS unit_id, * FROM (SELECT DISTINCT row_id, trim(regexp_replace(u, ' +', ' ', 'g')) AS u FROM raw)),
        words AS (SELECT unit_id, row_id, string_split(u, ' ') AS w FROM units),
        grams AS (SELECT DISTINCT unit_id, row_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM words WHERE len(w) > 1),
        sizes AS (SELECT unit_id, row_id, count(*) AS m FROM grams GROUP BY ALL),
        hits AS (SELECT unit_id, name, n, count(*) AS shared FROM grams JOIN templates USING (gram) GROUP BY ALL),
        dice AS (SELECT row_id, unit_id, name, 2.0::DOUBLE * shared / (n + m) AS dice FROM hits JOIN sizes USING (unit_id)),
        best AS (SELECT row_id, min_by(name, (-dice, name)) AS license, max(dice) AS dice, count(DISTINCT unit_id) AS n_matches,
                        string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
                 FROM dice WHERE dice >= {LEAST_DICE} GROUP BY row_id)
        SELECT doc_id, license, dice, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses FROM kept LEFT JOIN best USING (row_id)"""
