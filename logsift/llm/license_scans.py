"""License scans by sentence rules.

A text is cut into pieces at line ends, commas and sentence marks; runs of normalised pieces within a paragraph are looked up
among known licence sentences, the longest first, so that wrapped lines and marks inside a sentence (``;``, ``v. 2.0``)
don't hide one. The identifiers, in order, are matched against ordered licence rules: a rule is a sequence of identifiers
that must stand one after another (other sentences may stand between, other known ones may not). Of rules that match at a
place the longest wins, and its sentences are used up.

Defined results. Null or empty text: no licence. Texts are read whole. Rows with equal or null keys are scanned one by
one. Empty table: no rows. Clashing columns are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Every known sentence holds one of these; a text without any is not cut.
ANCHORS = ("licen", "warrant", "redistribut", "permission", "copyright", "domain", "unencumbered", "released")
#: Identifier: normalised sentences. {v} runs over VERSIONS of the identifier, {p} over PHRASES.
SENTENCES = {
    "mit.name": ["{p} mit license", "licensed under mit", "{p} mit license see license", "{p} mit license see the license file"],
    "mit.title": ["mit license", "the mit license", "the mit license mit"],
    "mit.grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit.condition": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as_is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "isc.name": ["{p} isc license"],
    "isc.title": ["isc license"],
    "isc.grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "isc.as_is": ["the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"],
    "apache.name": ["{p} apache license version {v}", "licensed under the apache license version {v} the license", "{p} apache license {v}"],
    "apache.title": ["apache license version {v} january 2004"],
    "apache.comply": ["you may not use this file except in compliance with the license"],
    "apache.basis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "gpl.name": ["{p} gnu general public license version {v}", "{p} gnu general public license v{v}", "licensed under the gnu gpl version {v}"],
    "gpl.free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version {v} of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version {v} as published by the free software foundation"],
    "gpl.hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "lgpl.name": ["{p} gnu lesser general public license version {v}"],
    "lgpl.free": ["this {k} is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version {v} of the license or at your option any later version"],
    "agpl.name": ["{p} gnu affero general public license version {v}"],
    "agpl.free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version {v} of the license or at your option any later version"],
    "mpl.name": ["{p} mozilla public license version {v}", "this source code form is subject to the terms of the mozilla public license v {v}"],
    "epl.name": ["{p} eclipse public license version {v}", "this program and the accompanying materials are made available under the terms of the eclipse public license v{v}", "this program and the accompanying materials are made available under the terms of the eclipse public license {v}"],
    "bsd.grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd.source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd.binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd.third": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd.name": ["{p} bsd license", "{p} bsd {v} clause license", "licensed under bsd {v} clause"],
    "bsd.title": ["bsd {v} clause license", "the bsd {v} clause license"],
    "unlicense.name": ["this is free and unencumbered software released into the public domain", "{p} unlicense"],
    "cc0.name": ["this work is dedicated to the public domain", "licensed under cc0 {v}", "released into the public domain", "{p} cc0 {v} universal public domain dedication"],
    **{f"cc-{k}.name": [f"licensed under cc {w} {{v}}", f"this work is licensed under cc {w} {{v}}", f"released under cc {w} {{v}}"] for k, w in (("by", "by"), ("by-sa", "by sa"), ("by-nc", "by nc"), ("by-nd", "by nd"), ("by-nc-sa", "by nc sa"), ("by-nc-nd", "by nc nd"))},
}
PHRASES = ["released under the", "licensed under the", "distributed under the", "available under the", "this work is licensed under the", "this software is released under the", "this software is licensed under the", "this project is licensed under the"]
VERSIONS = {"apache": ["1 0", "1 1", "2 0", "2"], "gpl": ["1", "2", "3", "2 0", "3 0"], "lgpl": ["2", "2 1", "3", "3 0"], "agpl": ["3", "3 0"], "mpl": ["1 0", "1 1", "2 0"], "epl": ["1 0", "2 0"], "bsd": ["2", "3"], "cc0": ["1 0"]}
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
#: Tags of the form SPDX-License-Identifier: NAME, by identifier.
TAGS = {
    "mit": ["MIT"], "isc": ["ISC"], "unlicense": ["Unlicense"], "apache": ["Apache-2.0"], "mpl": ["MPL-2.0"], "epl": ["EPL-1.0", "EPL-2.0"], "cc0": ["CC0-1.0"], "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    **{k: [f"{k.upper()}-{v}{end}" for v in vs for end in ("", "-only", "-or-later")] for k, vs in (("gpl", ("2.0", "3.0")), ("lgpl", ("2.1", "3.0")), ("agpl", ("3.0",)))},
}
NAMES = {"mit": "MIT", "isc": "ISC", "apache": "Apache", "gpl": "GPL", "lgpl": "LGPL", "agpl": "AGPL", "mpl": "MPL", "epl": "EPL", "bsd": "BSD", "unlicense": "Unlicense", "cc0": "CC0"}
#: Sequences of identifiers that make up a licence's notice or whole text, with or without its title before them.
BODIES = [
    ("BSD", ("bsd.grant", "bsd.source", "bsd.binary")), ("BSD-3", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.third")), ("BSD", ("bsd.grant", "bsd.source")),
    ("MIT", ("mit.grant", "mit.condition", "as_is")), ("MIT", ("mit.grant", "mit.condition")), ("MIT", ("mit.grant",)),
    ("ISC", ("isc.grant", "isc.as_is")), ("ISC", ("isc.grant",)),
    ("Apache", ("apache.name", "apache.comply", "apache.basis")), ("Apache", ("apache.name", "apache.comply")),
    ("GPL", ("gpl.free", "gpl.hope")), ("GPL", ("gpl.free",)), ("LGPL", ("lgpl.free", "gpl.hope")), ("LGPL", ("lgpl.free",)), ("AGPL", ("agpl.free", "gpl.hope")), ("AGPL", ("agpl.free",)),
]
#: Licence: sequences of identifiers; of those that fit a place the one of the most sentences counts.
RULES = sorted(
    [
        *BODIES, *[(name, (f"{name.partition('-')[0].lower()}.title", *seq)) for name, seq in BODIES],
        *[(x, (f"{k}.{part}",)) for k, x in NAMES.items() for part in ("name", "title", "tag")],
        *[(f"CC-{k}", (f"cc-{k.lower()}.name",)) for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")],
    ],
    key=lambda r: -len(r[1]),
)

_CUT = re.compile(r"(?<=[.!?;:,])[\"')\]]*\s+|[\r\n]+")
_LINE_END = re.compile(r"\r\n|\r|\n")
_OTHER = re.compile(r"[\W_]+")


def normalised(sentence: str) -> str:
    """Lower-cased words and numbers with single spaces between."""
    return _OTHER.sub(" ", sentence.lower()).strip()


def known() -> dict[str, tuple[str, str]]:
    """Normalised sentence: (identifier, version, empty if it names none)."""
    out = {}
    for key, texts in SENTENCES.items():
        name = key.partition(".")[0]
        versions = CC_VERSIONS if name.startswith("cc-") else VERSIONS.get(name, [])
        for t in texts:
            for u in [t.replace("{p}", p) for p in PHRASES] if "{p}" in t else [t.replace("{k}", k) for k in ("library", "program")] if "{k}" in t else [t]:
                for v in versions if "{v}" in u else [""]:
                    out[u.replace("{v}", v)] = (key, v.replace(" ", "."))
    for key, tags in TAGS.items():
        for t in tags:
            found = re.search(r"[0-9.]+", t.partition("-")[2])
            out[normalised(f"SPDX-License-Identifier: {t}")] = (f"{key}.tag", found[0] if found else "")
    return out


_KNOWN = known()
#: First words of the known sentences, by which a run of pieces may go on.
_STARTS = {s[:i] for s in _KNOWN for i, c in enumerate(s) if c == " "}


def paragraphs(text: str) -> list[list[str]]:
    """Normalised pieces by paragraph, which ends at a blank line or one of marks only."""
    out, at = [[]], 0
    for m in [*_CUT.finditer(text), None]:
        # a licence sentence may also stand after a bullet or a comment mark, which normalising drops
        if piece := normalised(text[at : m.start() if m else len(text)]):
            out[-1].append(piece)
        elif out[-1]:
            out.append([])
        if m:
            at = m.end()
            if len(_LINE_END.findall(m[0])) > 1 and out[-1]:
                out.append([])
    return out


def identifiers(text: str | None) -> list[tuple[str, str]]:
    """(identifier, version) of the known sentences of a text, in order."""
    low = (text or "").lower()
    if not any(a in low for a in ANCHORS):
        return []
    found = []
    for part in paragraphs(text):
        i = 0
        while i < len(part):
            run, hit, end = part[i], _KNOWN.get(part[i]), i + 1
            for j in range(i + 1, len(part)):
                if run not in _STARTS:
                    break
                run = f"{run} {part[j]}"
                if run in _KNOWN:
                    hit, end = _KNOWN[run], j + 1
            if hit:
                found.append(hit)
            i = end
    return found


def recognised(ids: list[tuple[str, str]]) -> list[str]:
    """Licences in order of their places."""
    out, i = [], 0
    while i < len(ids):
        for name, seq in RULES:
            part = ids[i : i + len(seq)]
            if tuple(k for k, _ in part) == seq:
                version = next((v for _, v in part if v), "")
                out.append(f"{name}-{version}" if version else name)
                i += len(seq)
                break
        else:
            i += 1
    return out


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs (without the text) with licenses (array of names in order), sentence_ids (array) and n_licenses."""
    small_batches(docs)
    kind = "struct<licenses: array<string>, sentence_ids: array<string>>"

    @F.pandas_udf(kind)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for x in batches:
            ids = [identifiers(t) for t in x]
            yield pd.DataFrame({"licenses": [recognised(i) for i in ids], "sentence_ids": [[k for k, _ in i] for i in ids]})

    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "licenses", "sentence_ids", "n_licenses", "_s")]
    out = docs.select(*rest, scanned(F.coalesce(F.col(text), F.lit(""))).alias("_s"))
    return out.select(*rest, "_s.licenses", "_s.sentence_ids", F.size("_s.licenses").cast("long").alias("n_licenses"))
