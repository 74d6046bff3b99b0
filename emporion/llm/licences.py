"""Licence scan by sentence rules.

A text is cut into paragraphs (a line without words, comment marks aside, ends
one) and these into sentences, each is normalised (lower case, letters, digits
and single spaces only; copyright lines, names and years dropped where a pattern
allows them) and matched against the catalogue of known licence sentences.  In a
paragraph a sentence may go on over line ends and semicolons, with or without
indentation and comment marks, or begin and end there.  The
sequence of sentence identifiers in a document is then matched against the
ordered licence rules: rules are tried from the first to the last, a rule
matches where its identifiers stand in this order with no other identifier
between them, and what it matched is used up.  Identifiers left over make the
document's status ``partial``; a sentence that speaks of licensing but is not
in the catalogue is counted in ``n_unknown``.  A tag gives its whole expression
as one licence (``MIT OR Apache-2.0``).

Whole texts are read; most hold no licence word and are dismissed by one pass
of plain string tests in Spark, before any Python.

Defined results: a null or empty text has no licence (status ``none``); every
row gives one row, repeated rows each their own; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentence identifiers and the patterns of their normalised sentences.
SENTENCES: list[tuple[str, str]] = [
    ("SpdxTag", r"spdx license identifier (?P<spdx>[a-z0-9 ]+)"),
    ("ApacheLic", r"(?:this \w+ is )?licensed under the apache license version 2 0(?: the license)?"),
    ("ApacheUse", r"you may not use this file except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at(?: https? .*)?"),
    ("ApacheAsIs", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("ApacheSee", r"see the license for the specific language governing permissions and limitations under the license"),
    ("MitRelease", r"(?:this \w+ is )?(?:released|licensed|distributed) under (?:the terms of )?the mit license"),
    ("MitGrant", r"permission is hereby granted free of charge to any person obtaining a copy of this software.*"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("MitAsIs", r"the software is provided as is without warranty of any kind express or implied.*"),
    ("MitLiable", r"in no event shall the (?:authors or )?copyright (?:holders|owner).* be liable for any .*"),
    ("GplLic2", r"this (?:\w+ )?is licensed under the gnu general public license version 2"),
    ("GplLic3", r"this (?:\w+ )?is licensed under the gnu general public license version 3"),
    ("GplFree2", r"this (?:\w+ ){1,3}is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("GplFree3", r"this (?:\w+ ){1,3}is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("GplOnly2", r"this (?:\w+ ){1,3}is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("LgplFree21", r"this (?:\w+ ){1,3}is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("LgplFree3", r"this (?:\w+ ){1,3}is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("AgplFree3", r"this (?:\w+ ){1,3}is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("GplNoWarranty", r"this (?:\w+ ){1,3}is distributed in the hope that it will be useful but without any warranty.*"),
    ("GplSee", r"see the gnu (?:lesser |affero )?general public license for more details"),
    ("GplCopy", r"you should have received a copy of the gnu (?:lesser |affero )?general public license along with this \w+.*"),
    ("BsdRedist", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.*"),
    ("BsdSource", r"(?:1 )?redistributions of source code must retain the above copyright notice.*"),
    ("BsdBinary", r"(?:2 )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("BsdEndorse", r"(?:3 )?neither the name of .* nor the names of its contributors may be used to endorse or promote products.*"),
    ("BsdAsIs", r"this software is provided by the copyright holders and contributors as is.*"),
    ("MplLic", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0"),
    ("MplCopy", r"if a copy of the mpl was not distributed with this file you can obtain one at.*"),
    ("IscGrant", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("ZeroGrant", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("IscAsIs", r"the software is provided as is and (?:\w+ ){1,6}disclaims? all warranties with regard to this software.*"),
    ("IscLiable", r"in no event shall (?:\w+ ){1,6}be liable for any special direct indirect or consequential damages.*"),
    ("UnlicenseFree", r"this is free and unencumbered software released into the public domain"),
    ("AuthorLiable", r"in no event shall the authors? be liable for any claim damages or other liability.*"),
    ("ZlibAsIs", r"this software is provided as is without any express or implied warranty"),
    ("ZlibLiable", r"in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("ZlibGrant", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions.*"),
    ("BslHead", r"boost software license version 1 0(?: august 17th 2003)?"),
    ("BslGrant", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license.*"),
    ("BslNotice", r"the copyright notices in the software and this entire statement including the above license grant.*"),
    ("BslLic", r"(?:this \w+ is )?(?:distributed|licensed) under the boost software license version 1 0"),
    ("BslSee", r"see accompanying file license 1 0 txt or copy at.*"),
    ("EplLic", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:version |v ?)?(?P<epl>[12] 0)(?: which (?:is available|accompanies) .*)?"),
    ("CcLic", r"(?:this \w+ is )?licensed under (?:the )?(?:cc|creative commons) (?P<cc>by(?: nc)?(?: sa| nd)?) (?P<ccv>[1-4] 0)(?: license)?"),
    ("CcZero", r"(?:this \w+ is )?(?:licensed|released|dedicated) (?:under|to) (?:cc0|cc 0|the public domain).*"),
]
# Licence rules in the order in which they are tried.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["ApacheLic", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheLic", "ApacheUse", "ApacheCopy"]),
    ("GPL-2.0-or-later", ["GplFree2", "GplNoWarranty", "GplSee", "GplCopy"]),
    ("GPL-2.0-or-later", ["GplFree2", "GplNoWarranty", "GplSee"]),
    ("GPL-3.0-or-later", ["GplFree3", "GplNoWarranty", "GplSee", "GplCopy"]),
    ("GPL-3.0-or-later", ["GplFree3", "GplNoWarranty", "GplSee"]),
    ("GPL-2.0-only", ["GplOnly2", "GplNoWarranty", "GplSee", "GplCopy"]),
    ("GPL-2.0-only", ["GplOnly2", "GplNoWarranty", "GplSee"]),
    ("LGPL-2.1-or-later", ["LgplFree21", "GplNoWarranty", "GplSee", "GplCopy"]),
    ("LGPL-2.1-or-later", ["LgplFree21", "GplNoWarranty", "GplSee"]),
    ("LGPL-3.0-or-later", ["LgplFree3", "GplNoWarranty", "GplSee", "GplCopy"]),
    ("LGPL-3.0-or-later", ["LgplFree3", "GplNoWarranty", "GplSee"]),
    ("AGPL-3.0-or-later", ["AgplFree3", "GplNoWarranty", "GplSee", "GplCopy"]),
    ("AGPL-3.0-or-later", ["AgplFree3", "GplNoWarranty", "GplSee"]),
    ("BSD-3-Clause", ["BsdRedist", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs", "MitLiable"]),
    ("BSD-3-Clause", ["BsdRedist", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs"]),
    ("BSD-2-Clause", ["BsdRedist", "BsdSource", "BsdBinary", "BsdAsIs", "MitLiable"]),
    ("BSD-2-Clause", ["BsdRedist", "BsdSource", "BsdBinary", "BsdAsIs"]),
    ("BSL-1.0", ["BslHead", "BslGrant", "BslNotice", "MitAsIs", "MitLiable"]),
    ("BSL-1.0", ["BslGrant", "BslNotice", "MitAsIs", "MitLiable"]),
    ("BSL-1.0", ["BslLic", "BslSee"]),
    ("BSL-1.0", ["BslLic"]),
    ("Unlicense", ["UnlicenseFree", "MitAsIs", "AuthorLiable"]),
    ("Unlicense", ["UnlicenseFree", "MitAsIs"]),
    ("Unlicense", ["UnlicenseFree"]),
    ("ISC", ["IscGrant", "IscAsIs", "IscLiable"]),
    ("ISC", ["IscGrant", "IscAsIs"]),
    ("ISC", ["IscGrant"]),
    ("0BSD", ["ZeroGrant", "IscAsIs", "IscLiable"]),
    ("0BSD", ["ZeroGrant", "IscAsIs"]),
    ("Zlib", ["ZlibAsIs", "ZlibLiable", "ZlibGrant"]),
    ("EPL-{epl}", ["EplLic"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs", "MitLiable"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs", "AuthorLiable"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs"]),
    ("MIT", ["MitRelease"]),
    ("Apache-2.0", ["ApacheLic"]),
    ("GPL-2.0-or-later", ["GplFree2"]),
    ("GPL-3.0-or-later", ["GplFree3"]),
    ("GPL-2.0-only", ["GplOnly2"]),
    ("LGPL-2.1-or-later", ["LgplFree21"]),
    ("LGPL-3.0-or-later", ["LgplFree3"]),
    ("AGPL-3.0-or-later", ["AgplFree3"]),
    ("GPL-2.0-only", ["GplLic2"]),
    ("GPL-3.0-only", ["GplLic3"]),
    ("MPL-2.0", ["MplLic", "MplCopy"]),
    ("MPL-2.0", ["MplLic"]),
    ("CC0-1.0", ["CcZero"]),
    ("{cc}", ["CcLic"]),
    ("{spdx}", ["SpdxTag"]),
]
# Words that every catalogue sentence holds one of, and that mark
# an unknown sentence as one about licensing.
MARKS = ["licen", "permission", "redistribut", "warrant", "public domain", "copyright", "cc0", "liable", "provided by", "of the mpl"]
# Identifiers that a tag may write in other capitals.
SPDX_IDS = ["0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause",
            "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0",
            "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0",
            "GPL-3.0", "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
            "LGPL-2.1", "LGPL-3.0", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "OFL-1.1", "OpenSSL", "PostgreSQL", "Python-2.0", "Unlicense",
            "WTFPL", "X11", "Zlib", "Autoconf-exception-3.0", "Classpath-exception-2.0", "GCC-exception-3.1", "LLVM-exception",
            "Linux-syscall-note", "OpenSSL-exception"]

_SMALL = set("abcdefghijklmnopqrstuvwxyz")
_PATTERNS = [(name, re.compile(p)) for name, p in SENTENCES]
_BY_NAME = dict(_PATTERNS)
# pieces end at a line end or at . ! ? ; before white space; the stop of a
# version number is inside a word and ends none, nor does that of 'v. 2'
_PIECE = re.compile(r"(?:[^.!?;]|[.!?;](?!\s|$)|(?<=\b[vV])\.(?=\s+\d))+")
# what a line begins with before its words: indentation and comment marks
_PREFIX = re.compile(r"[^\w(<\"']*(?:(?:dnl|rem|REM)\s+)?")
_ADDRESS = re.compile(r"https?://\S+")
_UNKNOWN = re.compile(r"\blicen[sc]e[ds]?\b|\bwarranty\b|\bredistribut|\bpermission (?:is (?:hereby )?granted|to (?:use|copy|modify|distribute)\b)")
_TAG = re.compile(r"spdx[^a-z0-9]+license[^a-z0-9]+identifier[\s:]*", re.I)
_TAG_WORD = re.compile(r"\s*([A-Za-z0-9][A-Za-z0-9.:-]*\+?|[()])")
_IDS = {name.lower(): name for name in SPDX_IDS}


def normalise(sentence: str) -> str:
    return " ".join(re.sub(r"[^a-z0-9]+", " ", sentence.lower()).split())


def tag_expression(sentence: str) -> str | None:
    """The licence expression of an SPDX tag in its usual form, or None: the longest
    one from the tag on by ``any = all (OR all)*``, ``all = one (AND one)*``,
    ``one = ( any ) | id [WITH id]``.  Identifiers that are not known stay as written.
    Operators in small letters count only before a known identifier or a bracket."""
    tag = _TAG.search(sentence)
    words, at = [], tag.end() if tag else len(sentence)
    while m := _TAG_WORD.match(sentence, at):
        words.append(m[1].rstrip(".:-") if m[1] not in "()" else m[1])
        at = m.end()
    words.append("")

    def operator(i: int, name: str) -> bool:
        after = words[i + 1] if words[i] else ""
        return words[i] == name or (words[i] == name.lower() and (after == "(" or after.lower().rstrip("+") in _IDS))

    def identifier(i: int) -> str | None:
        word = words[i]
        if not word or word in "()" or word.upper() in ("AND", "OR", "WITH"):
            return None
        plus = "+" if word.endswith("+") else ""
        return _IDS.get(word.removesuffix("+").lower(), word.removesuffix("+")) + plus

    # terms outside the open brackets, kept aside so that depth costs no recursion
    open_, i, best = [], 0, None
    done: list[str] = []
    while True:
        while words[i] == "(":
            open_.append(done)
            done, i = [], i + 1
        name = identifier(i)
        if name is None:
            return best
        i += 1
        if operator(i, "WITH") and (exception := identifier(i + 1)):
            name, i = f"{name} WITH {exception}", i + 2
        done = [*done, name]
        if not open_:
            best = " ".join(done)
        while open_ and words[i] == ")":
            done, i = [*open_.pop(), f"({' '.join(done)})"], i + 1
            if not open_:
                best = " ".join(done)
        for joint in ("AND", "OR"):
            if operator(i, joint):
                done, i = [*done, joint], i + 1
                break
        else:
            return best


def sentences(text: str) -> Iterator[list[tuple[int, int, bool]]]:
    """The sentences of each paragraph as pieces (start, end, whether a
    catalogue sentence may begin here)."""
    pieces, at, last = [], 0, ""
    for line in text.split("\n"):
        first = _PREFIX.match(line).end()
        if not any(c.isalnum() for c in line[first:]):
            if pieces:
                yield pieces
            pieces, at, last = [], at + len(line) + 1, ""
            continue
        # a small letter after one: the sentence goes on
        begins = not (last and last in "abcdefghijklmnopqrstuvwxyz," and line[first:first + 1] in _SMALL)
        for m in _PIECE.finditer(line, first):
            pieces.append((at + m.start(), at + m.end(), begins))
            begins = True
            if line[m.end():m.end() + 1] in (".", "!", "?"):
                yield pieces
                pieces = []
        last, at = line.rstrip()[-1:], at + len(line) + 1
    if pieces:
        yield pieces


def _ids_of(text: str, pieces: list[tuple[int, int, bool]]) -> Iterator[tuple[str, dict, int, int]]:
    """Known sentences, and '?' for what else speaks of licensing."""
    parts, begin, end, size = [], [], [], 0
    for a, z, _ in pieces:
        words = normalise(text[a:z])
        if parts and size and words:
            size += 1
            parts.append(" ")
        begin.append(size)
        size += len(words)
        end.append(size)
        parts.append(words)
    plain = "".join(parts)

    def known(i: int) -> tuple[int, str, dict] | None:
        """The longest known sentence from piece i on: (last piece, name, fields)."""
        best = None
        for name, pattern in _PATTERNS:
            # a tag ends with its line
            hit = pattern.match(plain, begin[i], end[i] if name == "SpdxTag" else len(plain))
            if not hit:
                continue
            j = bisect_right(end, hit.end()) - 1
            while j >= i and (best is None or j > best[0]):
                if whole := pattern.fullmatch(plain, begin[i], end[j]):
                    best = j, name, whole.groupdict()
                j -= 1
        return best

    i, rest = 0, []
    while i <= len(pieces):
        hit = known(i) if i < len(pieces) and pieces[i][2] and end[i] > begin[i] else None
        if hit or i == len(pieces):
            if rest:
                a, z = pieces[rest[0]][0], pieces[rest[-1]][1]
                if _UNKNOWN.search(normalise(_ADDRESS.sub(" ", text[a:z]))):
                    yield "?", {}, a, z
            rest = []
        if hit:
            j, name, fields = hit
            # one that can go on ends where the next known one begins
            for k in range(i + 1, j + 1):
                if pieces[k][2] and end[k] > begin[k] and known(k) and (whole := _BY_NAME[name].fullmatch(plain, begin[i], end[k - 1])):
                    j, fields = k - 1, whole.groupdict()
                    break
            a, z = pieces[i][0], pieces[j][1]
            if name == "SpdxTag":
                fields = {"spdx": tag_expression(text[a:z])}
            # a tag without an expression says nothing that is known
            yield name if "spdx" not in fields or fields["spdx"] else "?", fields, a, z
            i = j + 1
        else:
            rest.append(i)
            i += 1


def sentence_ids(text: str) -> list[tuple[str, dict, int, int]]:
    """(identifier, captured fields, start, end) of the known sentences, in
    order; sentences on licensing that are not known have the identifier '?'."""
    out = []
    for pieces in sentences(text):
        low = text[pieces[0][0]:pieces[-1][1]].lower()
        if any(mark in low for mark in MARKS):
            out.extend(_ids_of(text, pieces))
    return out


def match_rules(found: list[tuple[str, dict, int, int]]) -> tuple[list[str], int]:
    """(licences in text order, identifiers that no rule used)."""
    names = [x[0] for x in found]
    used: list[str | None] = [None] * len(names)
    hits = []
    for licence, sequence in RULES:
        n, i = len(sequence), 0
        while i + n <= len(names):
            if names[i:i + n] == sequence and not any(used[i:i + n]):
                fields = found[i][1]
                name = licence.format(cc=f"CC-{(fields.get('cc') or '').upper().replace(' ', '-')}-{(fields.get('ccv') or '').replace(' ', '.')}",
                                      spdx=fields.get("spdx"), epl=(fields.get("epl") or "").replace(" ", "."))
                used[i:i + n] = [name] * n
                hits.append((i, name))
                i += n
            else:
                i += 1
    return [name for _, name in sorted(hits)], sum(u is None and n != "?" for u, n in zip(used, names))


_SCHEMA = "doc_id long, status string, licences string, sentences string, n_sentences long, n_unknown long, spans string"


def speaks_of_licence(text: Column) -> Column:
    low = F.lower(text)
    test = F.lit(False)
    for mark in MARKS:
        test = test | F.contains(low, F.lit(mark))
    return F.coalesce(test, F.lit(False))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: status (``known``, ``partial``, ``unknown`` or
    ``none``), licences in text order, the identifier sequence, counts and the
    sentences' spans (code points, end exclusive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = sentence_ids(text) if text else []
                known = [x for x in found if x[0] != "?"]
                licences, left = match_rules(found)
                status = "none" if not found else "unknown" if not known else "partial" if left or len(known) < len(found) else "known"
                rows.append((doc_id, status, ",".join(licences), ",".join(x[0] for x in found), len(known), len(found) - len(known),
                             ",".join(f"{x[0]}:{x[2]}:{x[3]}" for x in found)))
            kinds = [pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.string()]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                             names=[x.split()[0] for x in _SCHEMA.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a text without any mark reaches Python as null
    return (rows.select("doc_id", F.when(speaks_of_licence(F.col("text")), F.col("text")).alias("text"))
            .mapInArrow(run, _SCHEMA))
