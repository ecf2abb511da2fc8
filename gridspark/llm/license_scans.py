"""Operator 9: license scans by sentence rules.

A text is cut into sentences twice: at line ends and sentence ends, and at sentence ends and blank lines alone (for
notices that are wrapped over lines); both also cut before and behind urls.  The known wordings are what these cuts leave
of the notices.  A sentence is normalised to its lower-cased words and numbers, and mapped to the identifier of a
known licence sentence.  The identifiers of a text, in the order of their places, are matched against the licences'
ordered rules: a rule fits where its identifiers follow each other with no other known identifier between them; at a
place the longest rule wins, then the first in the list, and matching goes on behind it.  A part of a notice is a rule as
well if it holds an identifier that no other licence's notices have.  Tags (SPDX) carry the licence in themselves, each
licence of an expression on its own (an exception stays with its licence).  The whole text is scanned; a text without any
of the cue words needs no cutting, since every known sentence holds one.

Defined results: a null or empty text has no licences (empty array, empty string); repeated rows are scanned row by row;
an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches

#: Known licence sentences, normalised: identifier -> wordings (fixed values).
SENTENCES = {
    "apache2.short": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license"),
    "apache2.may-not": ("you may not use this file except in compliance with the license",),
    "apache2.copy-at": ("you may obtain a copy of the license at",),
    "apache2.url": ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0"),
    "apache2.as-is": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "apache2.see": ("see the license for the specific language governing permissions and limitations under the license",),
    "mit.short": ("released under the mit license", "licensed under the mit license"),
    "mit.title": ("the mit license", "mit license"),
    "mit.grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "mit.notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "mit.as-is": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "gpl3.short": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "licensed under the gnu gpl version 3", "licensed under the gpl v3", "licensed under the gplv3"),
    "gpl2.short": ("licensed under the gnu general public license version 2", "this work is licensed under the gnu general public license version 2", "licensed under the gnu gpl version 2", "licensed under the gpl v2", "licensed under the gplv2"),
    "lgpl3.short": ("licensed under the gnu lesser general public license version 3", "this work is licensed under the gnu lesser general public license version 3"),
    "lgpl21.short": ("licensed under the gnu lesser general public license version 2 1", "this work is licensed under the gnu lesser general public license version 2 1"),
    "agpl3.short": ("licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"),
    "mpl2.short": ("licensed under the mozilla public license version 2 0", "licensed under the mozilla public license 2 0"),
    "apache2.name": ("apache license version 2 0", "apache license 2 0", "licensed under the apache license 2 0", "licensed under apache 2 0", "released under the apache license 2 0", "apache license version 2 0 january 2004"),
    "apache2.terms": ("terms and conditions for use reproduction and distribution license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document", "license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document"),
    "apache2.copyright-grant": ("subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",),
    "gpl.redistribute-3": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    "gpl.redistribute-2": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",),
    "gpl.either-2": ("either version 2 of the license or at your option any later version", "either version 2 of the license or at your option any later version of the license"),
    "gpl.redistribute-2-later": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "gpl.redistribute-2-only": ("you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation", "you can redistribute it and or modify it under the terms of the gnu general public license version 2 only as published by the free software foundation"),
    "lgpl.redistribute-21": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",),
    "lgpl.either-21": ("either version 2 1 of the license or at your option any later version",),
    "lgpl.redistribute": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",),
    "lgpl.redistribute-3": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "agpl.redistribute-3": ("you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "gpl.warranty": ("this program is distributed in the hope that it will be useful but without any warranty", "this library is distributed in the hope that it will be useful but without any warranty"),
    "gpl.implied": ("without even the implied warranty of merchantability or fitness for a particular purpose",),
    "gpl.details": ("see the gnu general public license for more details",),
    "lgpl.details": ("see the gnu lesser general public license for more details",),
    "agpl.details": ("see the gnu affero general public license for more details",),
    "gpl.verbatim": ("everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",),
    "gpl3.title": ("gnu general public license version 3 29 june 2007", "gnu general public license version 3"),
    "gpl2.title": ("gnu general public license version 2 june 1991", "gnu general public license version 2"),
    "lgpl3.title": ("gnu lesser general public license version 3 29 june 2007", "gnu lesser general public license version 3"),
    "lgpl21.title": ("gnu lesser general public license version 2 1 february 1999", "gnu lesser general public license version 2 1"),
    "agpl3.title": ("gnu affero general public license version 3 19 november 2007", "gnu affero general public license version 3"),
    "mpl2.subject": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "mpl2.copy": ("if a copy of the mpl was not distributed with this file you can obtain one at",),
    "mpl2.title": ("mozilla public license version 2 0",),
    "isc.title": ("isc license", "the isc license", "licensed under the isc license", "released under the isc license"),
    "isc.grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    "isc.as-is": ("the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",),
    "0bsd.grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "ccbync4.short": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "ccbysa4.short": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "ccby4.short": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    "cc0.short": ("licensed under cc0 1 0", "this work is licensed under cc0 1 0", "creative commons legal code cc0 1 0 universal"),
    "cc0.waiver": ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work"),
    "bsd.short-2": ("licensed under the bsd 2 clause license", "released under the bsd 2 clause license", "bsd 2 clause license"),
    "bsd.short-3": ("licensed under the bsd 3 clause license", "released under the bsd 3 clause license", "bsd 3 clause license"),
    "bsd.redistribution": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "bsd.source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd.binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd.endorse": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    "bsd.as-is": ("this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
    "zlib.as-is": ("this software is provided as is without any express or implied warranty",),
    "zlib.grant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",),
    "unlicense.free": ("this is free and unencumbered software released into the public domain",),
    "boost.short": ("distributed under the boost software license version 1 0",),
    "epl2.short": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at", "licensed under the eclipse public license version 2 0"),
}
#: Ordered rules: licence and the identifiers in order (fixed values).
RULES = (
    ("Apache-2.0", ("apache2.short", "apache2.may-not", "apache2.copy-at", "apache2.url", "apache2.as-is", "apache2.see")),
    ("Apache-2.0", ("apache2.short",)),
    ("Apache-2.0", ("apache2.name", "apache2.url", "apache2.terms", "apache2.copyright-grant")),
    ("MIT", ("mit.title", "mit.grant", "mit.notice", "mit.as-is")),
    ("MIT", ("mit.short",)),
    ("GPL-3.0-or-later", ("gpl.redistribute-3", "gpl.warranty", "gpl.implied", "gpl.details")),
    ("GPL-2.0-or-later", ("gpl.redistribute-2-later", "gpl.warranty", "gpl.implied", "gpl.details")),
    ("GPL-2.0-or-later", ("gpl.redistribute-2", "gpl.either-2", "gpl.warranty", "gpl.implied", "gpl.details")),
    ("GPL-2.0-only", ("gpl.redistribute-2-only", "gpl.warranty", "gpl.implied", "gpl.details")),
    ("LGPL-2.1-or-later", ("lgpl.redistribute-21", "gpl.warranty", "gpl.implied", "lgpl.details")),
    ("LGPL-2.1-or-later", ("lgpl.redistribute", "lgpl.either-21", "gpl.warranty", "gpl.implied", "lgpl.details")),
    ("LGPL-3.0-or-later", ("lgpl.redistribute-3", "gpl.warranty", "gpl.implied", "lgpl.details")),
    ("AGPL-3.0-or-later", ("agpl.redistribute-3", "gpl.warranty", "gpl.implied", "agpl.details")),
    ("GPL-3.0-only", ("gpl3.short",)),
    ("GPL-2.0-only", ("gpl2.short",)),
    ("LGPL-3.0-only", ("lgpl3.short",)),
    ("LGPL-2.1-only", ("lgpl21.short",)),
    ("AGPL-3.0-only", ("agpl3.short",)),
    ("GPL-3.0-only", ("gpl3.title", "gpl.verbatim")),
    ("GPL-2.0-only", ("gpl2.title", "gpl.verbatim")),
    ("LGPL-3.0-only", ("lgpl3.title", "gpl.verbatim")),
    ("LGPL-2.1-only", ("lgpl21.title", "gpl.verbatim")),
    ("AGPL-3.0-only", ("agpl3.title", "gpl.verbatim")),
    ("MPL-2.0", ("mpl2.subject", "mpl2.copy")),
    ("MPL-2.0", ("mpl2.short",)),
    ("MPL-2.0", ("mpl2.title",)),
    ("ISC", ("isc.title", "isc.grant", "isc.as-is")),
    ("0BSD", ("0bsd.grant", "isc.as-is")),
    ("CC-BY-NC-4.0", ("ccbync4.short",)),
    ("CC-BY-SA-4.0", ("ccbysa4.short",)),
    ("CC-BY-4.0", ("ccby4.short",)),
    ("CC0-1.0", ("cc0.short",)),
    ("CC0-1.0", ("cc0.waiver",)),
    ("BSD-2-Clause", ("bsd.short-2",)),
    ("BSD-3-Clause", ("bsd.short-3",)),
    ("BSD-3-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary", "bsd.endorse", "bsd.as-is")),
    ("BSD-2-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary", "bsd.as-is")),
    ("LicenseRef-BSD", ("bsd.redistribution",)),
    ("LicenseRef-BSD", ("bsd.redistribution", "bsd.source")),
    ("Zlib", ("zlib.as-is", "zlib.grant")),
    ("Unlicense", ("unlicense.free",)),
    ("BSL-1.0", ("boost.short",)),
    ("EPL-2.0", ("epl2.short",)),
)
SCHEMA = "doc_id long, licenses array<string>, sentence_ids array<string>, starts array<int>"
_CUE = re.compile(r"licen[sc]|permission|warrant|redistribut|spdx|public domain|waive|cc0|\bmpl\b", re.I)
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+|\n(?:[^\w\n]*\n)+")
_LINE = re.compile(r"(?<=[.!?;:])\s+|\s*\n\s*")
_URL = re.compile(r"https?://[^\s<>()\"]+", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_FIRST = re.compile(r"[a-z0-9]", re.I)
_TAG = r"[a-z0-9.+:-]*[a-z0-9+]"
_SPDX = re.compile(rf"spdx-license-identifier:\s*(\(*{_TAG}(?:[ \t)]+(?-i:AND|OR|WITH)[ \t(]+{_TAG})*)", re.I)
_LICENSE = re.compile(rf"{_TAG}(?:[ \t]+(?-i:WITH)[ \t]+{_TAG})?", re.I)
_OPERATOR = {"AND", "OR"}
_IDS = {w: i for i, ways in SENTENCES.items() for w in ways}


def parts_of(rules: tuple[tuple[str, tuple[str, ...]], ...]) -> dict[tuple[str, ...], str]:
    """The rules, and their parts that hold an identifier of one licence alone; what two rules give goes to the first."""
    holders: dict[str, set[str]] = {}
    for name, rule in rules:
        for i in rule:
            holders.setdefault(i, set()).add(name)
    out = {}
    for name, rule in rules:
        out.setdefault(rule, name)
    for name, rule in rules:
        for a in range(len(rule)):
            for b in range(a + 1, len(rule) + 1):
                if any(holders[i] == {name} for i in rule[a:b]):
                    out.setdefault(rule[a:b], name)
    return out


_RULES = parts_of(RULES)
_LONGEST = max(map(len, _RULES))


def normalised(sentence: str) -> str:
    return " ".join(_WORD.findall(sentence.lower()))


def pieces(text: str, at: re.Pattern) -> list[tuple[int, str]]:
    cuts = [m.span() for m in at.finditer(text)]
    if "://" in text:
        cuts = sorted([*cuts, *((p, p) for m in _URL.finditer(text) for p in m.span())])
    out, start = [], 0
    for a, b in cuts:
        if a >= start:
            out.append((start, text[start:a]))
            start = b
    return [*out, (start, text[start:])]


def sentence_ids(text: str) -> list[tuple[int, str]]:
    """(place, identifier) of the known sentences, in order."""
    found = {}
    for at in (_LINE, _SENTENCE):
        for start, sentence in pieces(text, at):
            if _CUE.search(sentence) and (i := _IDS.get(normalised(sentence))):
                # both cuts find a sentence at the place of its first word
                found.setdefault((start + _FIRST.search(sentence).start(), i))
    for m in _SPDX.finditer(text):
        for x in _LICENSE.finditer(m[1]):
            if x[0] not in _OPERATOR:
                found.setdefault((m.start() if x.start() == 0 else m.start(1) + x.start(), f"spdx:{' '.join(x[0].split())}"))
    return sorted(found)


def licenses(ids: list[str]) -> list[str]:
    """Licences of a sequence of identifiers, each once, in the order of their first match."""
    out, at = {}, 0
    while at < len(ids):
        if ids[at].startswith("spdx:"):
            out.setdefault(ids[at][5:])
            at += 1
            continue
        size = next((n for n in range(_LONGEST, 0, -1) if tuple(ids[at : at + n]) in _RULES and at + n <= len(ids)), 0)
        if size:
            out.setdefault(_RULES[tuple(ids[at : at + size])])
        at += max(size, 1)
    return list(out)


def license_scans(docs: DataFrame) -> DataFrame:
    """One row for each of docs(doc_id, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sentence_ids(t) if t and _CUE.search(t) else [] for t in batch.column("text").to_pylist()]
        ids = [[i for _, i in f] for f in found]
        columns = [pa.array(x, pa.list_(pa.string())) for x in (map(licenses, ids), ids)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array([[s for s, _ in f] for f in found], pa.list_(pa.int32()))], names=["doc_id", "licenses", "sentence_ids", "starts"])

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, SCHEMA)


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, licenses and sentence_ids (joined by commas) and the number of known sentences."""
    out = license_scans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.size("sentence_ids").alias("n_sentences"))
