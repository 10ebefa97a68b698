"""Licence scans by sentence rules.

A text is cut into lines and clauses, normalised (lower case, white space and marks reduced). Wrapped
ones are rows of one sentence, to its mark or the end of the paragraph, over however many lines. In a
row, known licence sentences are looked for from each line or clause on; one ends where a line or
clause ends, the shortest is taken, and words before its own beginning are of the same line. What
follows up to the mark belongs to it. The sequence of identifiers of the text
is then matched against ordered licence rules: from each place, the first rule whose identifiers
follow one another there (unknown sentences may lie between, up to `GAP`) takes its sentences, and
the scan goes on behind them. Rules that ask for more come before those that ask for less, so that
a whole licence text is reported once, as itself. Known sentences that no rule takes are reported
as unmatched.

A free part of a known sentence (a name, an address) has at most SLOT characters, so that looking for a sentence takes bounded
time wherever it begins, and a text time in proportion to its length. Sentences that come again are looked up by the digest of
their normalised words; only new ones are searched.

Defined results: a null or empty text has no sentences and no licences; repeated rows stay; other
columns are not read. Whole texts are read; a word search sorts out texts that can hold no known
sentence.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

#: Unknown sentences that may lie between two of one rule.
GAP = 3
#: Characters of a free part of a known sentence.
SLOT = 400
#: Sentences that a worker remembers; beyond that it begins anew.
MEMO = 100_000

#: Identifier of each known sentence: a pattern over the whole normalised sentence. Fixed values.
SENTENCES = [
    ("apache2-under", r"(?:.* )?licensed under the apache license,? version 2(?:\.0)?(?: \(the license\))?"),
    ("apache2-comply", r"you may not use this file except in compliance with the license"),
    ("apache2-copy", r"you may obtain a copy of the license at.*"),
    ("asis-unless", r"unless required by applicable law or agreed to in writing,? software distributed under the license is distributed on an as is basis,? without warranties or conditions of any kind,? either express or implied"),
    ("see-license", r"see the license for the specific language governing permissions and limitations under the license"),
    ("gpl3-under", r"(?:.* )?licensed under the (?:gnu general public license|gnu gpl|gpl),? (?:version 3|v3)(?:\.0)?(?: (?:only|or later))?"),
    ("gpl2-under", r"(?:.* )?licensed under the (?:gnu general public license|gnu gpl|gpl),? (?:version 2|v2)(?:\.0)?(?: (?:only|or later))?"),
    ("gpl3-redistribute", r"this program is free software:? you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation,? either version 3 of the license,? or \(at your option\) any later version"),
    ("gpl2-redistribute", r"this program is free software;? you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation;? either version 2 of the license,? or \(at your option\) any later version"),
    ("gpl-hope", r"this program is distributed in the hope that it will be useful,? but without any warranty;? without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-details", r"see the gnu general public license for more details"),
    ("mit-under", r"(?:.* )?(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit license"),
    ("mit-title", r"(?:the )?mit license(?: \(mit\))?"),
    ("mit-grant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files \(the software\),? to deal in the software without restriction,? .*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-asis", r"the software is provided as is,? without warranty of any kind,? .*"),
    ("bsd-redistribution", r"redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met.*"),
    ("bsd-source", r"(?:\d\. ?)?redistributions of source code must retain the above copyright notice,? .*"),
    ("bsd-binary", r"(?:\d\. ?)?redistributions in binary form must reproduce the above copyright notice,? .*"),
    ("bsd-endorse", r"(?:\d\. ?)?neither the name of .* nor the names of .* may be used to endorse or promote products .*"),
    ("bsd-asis", r"this software is provided by the copyright holders? and contributors as is .*"),
    ("bsd3-under", r"(?:.* )?(?:released|licensed|distributed) under the (?:bsd[ -]3-clause|3-clause bsd|new bsd) license"),
    ("bsd2-under", r"(?:.* )?(?:released|licensed|distributed) under the (?:bsd[ -]2-clause|2-clause bsd|simplified bsd) license"),
    ("cc-by-nc-4", r"(?:.* )?licensed under (?:a |the )?(?:cc by-nc|creative commons attribution-noncommercial)(?: license)?(?: version)? 4\.0(?: .*license)?"),
    ("cc-by-sa-4", r"(?:.* )?licensed under (?:a |the )?(?:cc by-sa|creative commons attribution-sharealike)(?: license)?(?: version)? 4\.0(?: .*license)?"),
    ("cc-by-4", r"(?:.* )?licensed under (?:a |the )?(?:cc by|creative commons attribution)(?: license)?(?: version)? 4\.0(?: .*license)?"),
    ("cc0", r"(?:.* )?(?:dedicated to the public domain|licensed under) .*cc0.*"),
    ("mpl2-under", r"(?:.* )?subject to the terms of the mozilla public license,? v(?:ersion)?\.? ?2\.0"),
    ("lgpl21-redistribute", r"this library is free software;? you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation;? either version 2\.1 of the license,? or \(at your option\) any later version"),
    ("lgpl3-redistribute", r"this (?:library|program) is free software[:;]? you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation[,;]? either version 3 of the license,? or \(at your option\) any later version"),
    ("lgpl-hope", r"this library is distributed in the hope that it will be useful,? but without any warranty;? without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl-details", r"see the gnu lesser general public license for more details"),
    ("agpl3-redistribute", r"this program is free software[:;]? you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation,? either version 3 of the license,? or \(at your option\) any later version"),
    ("agpl-details", r"see the gnu affero general public license for more details"),
    ("isc-grant", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted,? provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-asis", r"the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("bsl-grant", r"permission is hereby granted,? free of charge,? to any person or organization obtaining a copy of the software and accompanying documentation covered by this license .*"),
    ("bsl-under", r"(?:.* )?(?:released|licensed|distributed) under the boost software license,? version 1\.0"),
    ("zlib-asis", r"this software is provided as-is,? without any express or implied warranty"),
    ("zlib-liable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose,? including commercial applications,? and to alter it and redistribute it freely,? subject to the following restrictions"),
    ("epl2-under", r"(?:.* )?available under the terms of the eclipse public license,? (?:version |v ?)?2\.0(?: .*)?"),
    ("epl1-under", r"(?:.* )?available under the terms of the eclipse public license,? (?:version |v ?)?1\.0(?: .*)?"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("all-rights", r"(?:.* )?all rights reserved"),
    ("copyright", r"copyright (?:\(c\) ?|© ?)?\d{4}.*"),
]

#: Licences by the short names that one-line tags use. Fixed values.
TAGS = [
    "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0",
    "ISC", "BSL-1.0", "Zlib", "EPL-1.0", "EPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
]
SENTENCES += [(f"spdx-{tag.lower()}", rf"spdx-license-identifier:? {re.escape(tag.lower())}") for tag in TAGS]

#: Licence of each ordered sequence of sentences. Fixed values; the first that fits is taken.
RULES = [
    ("Apache-2.0", ["apache2-under", "apache2-comply", "apache2-copy", "asis-unless", "see-license"]),
    ("MIT", ["mit-title", "copyright", "mit-grant", "mit-notice", "mit-asis"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "mit-asis"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-asis"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-asis"]),
    ("GPL-3.0-or-later", ["gpl3-redistribute", "gpl-hope", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl2-redistribute", "gpl-hope", "gpl-details"]),
    ("GPL-3.0-or-later", ["gpl3-redistribute"]),
    ("GPL-2.0-or-later", ["gpl2-redistribute"]),
    ("Apache-2.0", ["apache2-under"]),
    ("GPL-3.0", ["gpl3-under"]),
    ("GPL-2.0", ["gpl2-under"]),
    ("MIT", ["mit-under"]),
    ("BSD-3-Clause", ["bsd3-under"]),
    ("BSD-2-Clause", ["bsd2-under"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC0-1.0", ["cc0"]),
    ("MPL-2.0", ["mpl2-under"]),
    ("LGPL-2.1-or-later", ["lgpl21-redistribute", "lgpl-hope", "lgpl-details"]),
    ("LGPL-2.1-or-later", ["lgpl21-redistribute"]),
    ("LGPL-3.0-or-later", ["lgpl3-redistribute"]),
    ("AGPL-3.0-or-later", ["agpl3-redistribute", "gpl-hope", "agpl-details"]),
    ("AGPL-3.0-or-later", ["agpl3-redistribute"]),
    ("ISC", ["isc-grant", "isc-asis"]),
    ("ISC", ["isc-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("BSL-1.0", ["bsl-under"]),
    ("Zlib", ["zlib-asis", "zlib-liable", "zlib-grant"]),
    ("EPL-2.0", ["epl2-under"]),
    ("EPL-1.0", ["epl1-under"]),
    ("Unlicense", ["unlicense"]),
    ("Proprietary", ["copyright", "all-rights"]),
    *[(tag, [f"spdx-{tag.lower()}"]) for tag in TAGS],
]

#: Every known sentence has one of these words.
_HINT = r"(?i)licen[sc]e|copyright|©|rights\W+reserved|redistribut|warrant|free\W+software|permission|public\W+domain|held\W+liable|promote\W+products"
_MARK = re.compile(r"(?<=[.!?;:])\s+(?=[^\W\d_]|\d+\. )")
_NUMBER = re.compile(r"\W*\d+[.)](?!\d)")
_FREE = "(?:.* )?"
#: Where a pattern with free words before it may begin.
_CUE = re.compile(r"(?:(?<=\s)|(?<![^\n]))(?:released|licensed|distributed|available|dedicated|subject|all)\b")


def _over_lines(pattern: str) -> re.Pattern:
    """The pattern over lines in a row: its spaces may be line ends, its free parts are bounded, it ends with a line."""
    s = pattern.removeprefix(_FREE).replace("[ -]", "[ \n-]").replace(".*", f".{{0,{SLOT}}}?").replace("license)?", "license)??").replace(f"(?: .{{0,{SLOT}}}?)?", f"(?: .{{0,{SLOT}}}?)??")
    s = re.sub(r" (?!\n-\])", r"[ \\n]", s.replace("[ \n-]", "\0")).replace("\0", r"[ \n-]")
    return re.compile(rf"(?:{s})(?=\n|\Z)", re.DOTALL)


_KNOWN = [(k, _over_lines(p), p.startswith(_FREE)) for k, p in SENTENCES]
_AT_CUES = [(k, p) for k, p, free in _KNOWN if free]
#: Sentences that begin with a word of their own, by that word, and the others.
_WORD = re.compile(r"[a-z-]+")
_BY_WORD: dict[str, list] = {}
for (_name, _text), (_, _pattern, _free) in zip(SENTENCES, _KNOWN, strict=True):
    if not _free:
        _first = _WORD.match(_text)
        _BY_WORD.setdefault(_first[0] if _first and _text[_first.end() :].startswith((" ", ":? ")) else "", []).append((_name, _pattern))


_ORDER = {name: k for k, (name, _) in enumerate(SENTENCES)}


def normalise(sentence: str) -> str:
    s = re.sub(r"[\"'`“”‘’*#/]{1,}(?=\W|$)|(?<!\S)[\"'`“”‘’*#/]+", "", sentence.lower())
    return re.sub(r"\s+", " ", s).strip(" .!?;:")


def sentences(text: str) -> list[list[str]]:
    """Sentences by marks and paragraphs, each as the lines and clauses that it is wrapped in."""
    out, row = [], []

    def close():
        if row:
            out.append(row.copy())
            row.clear()

    lines = text.splitlines()
    for i, line in enumerate(lines):
        if not normalise(line):
            close()
            continue
        clauses = _MARK.split(line.strip())
        for k, c in enumerate(clauses):
            if x := normalise(c):
                row.append(x)
            bare = c.rstrip(" \t\"'`”’*#/)")
            if bare.endswith((".", "!", "?")) and not _NUMBER.fullmatch(c):
                after = lines[i + 1].lstrip() if k + 1 == len(clauses) and i + 1 < len(lines) else ""
                if not after[:1].isdigit() or _NUMBER.match(after):
                    close()
    close()
    return out


class Scanner:
    def __init__(self):
        self.known: dict[bytes, list] = {}

    def identify(self, row: str, at: int) -> tuple[int, str] | None:
        """(end, identifier) of the shortest known sentence that begins in the line there."""
        end = row.find("\n", at)
        cues = [m.start() for m in _CUE.finditer(row, at, len(row) if end < 0 else end)]
        word = _WORD.match(row, at)
        tried = [(at, *x) for x in (*_BY_WORD.get(word[0] if word else "", ()), *_BY_WORD.get("", ()))]
        tried += [(start, *x) for start in cues for x in _AT_CUES]
        best = None
        for start, name, pattern in tried:
            if name == "cc0" and row.find("cc0", start, start + 2 * SLOT) < 0:
                continue
            m = pattern.match(row, start)
            if m and (best is None or (m.end(), _ORDER[name]) < (best[0], _ORDER[best[1]])):
                best = m.end(), name
        return best

    def found(self, row: str) -> list[tuple[bool, str]]:
        """(whether words precede it, identifier) of the known sentences of a row, in order."""
        from hashlib import blake2b

        digest = blake2b(row.encode(), digest_size=16).digest()
        if digest in self.known:
            return self.known[digest]
        out, at = [], 0
        while at < len(row):
            hit = self.identify(row, at)
            if hit:
                out.append((at > 0, hit[1]))
                at = hit[0] + 1
            else:
                at = row.find("\n", at) + 1 or len(row)
        if len(self.known) > MEMO:
            self.known.clear()
        self.known[digest] = out
        return out

    def sequence(self, text: str) -> list[tuple[int, str]]:
        """(number of the sentence, identifier) of the known sentences; one that begins within a row
        begins a sentence."""
        out, number = [], -1
        hint = re.compile(_HINT)
        for lines in sentences(text):
            row = "\n".join(lines)
            number += 1
            if hint.search(row):
                for inner, name in self.found(row):
                    number += inner
                    out.append((number, name))
        return out

    def match(self, known: list[tuple[int, str]]) -> tuple[list[str], list[str]]:
        """(licences in the order of the text, identifiers that no rule took)."""
        found, rest, i = [], [], 0
        while i < len(known):
            for licence, wanted in RULES:
                taken = known[i : i + len(wanted)]
                close = all(b[0] - a[0] <= GAP + 1 for a, b in zip(taken, taken[1:], strict=False))
                if [k for _, k in taken] == wanted and close:
                    found.append(licence)
                    i += len(wanted)
                    break
            else:
                rest.append(known[i][1])
                i += 1
        return found, rest


SCANNED = "doc_id long, licenses array<string>, n_licenses long, sentences array<string>, unmatched array<string>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, licenses (distinct, sorted), n_licenses (matches in the text), sentences (identifiers in
    order), unmatched (those that no rule took) of every document."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        scanner = Scanner()
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            maybe = pc.match_substring_regex(text, _HINT).to_pylist()
            rows = []
            for t, m in zip(text, maybe, strict=True):
                known = scanner.sequence(t.as_py()) if m else []
                found, rest = scanner.match(known)
                rows.append((sorted(set(found)), len(found), [k for _, k in known], rest))
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), *[pa.array([r[k] for r in rows], t) for k, t in enumerate((lists, pa.int64(), lists, lists))]], names=[x.split()[0] for x in SCANNED.split(", ")]
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCANNED)
