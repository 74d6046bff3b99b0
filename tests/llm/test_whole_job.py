"""Cases that the operators once left out."""

import random
import string

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emporion.llm import decontaminate, licences, secrets, toxicity
from emporion.llm.common import ship
from llm_cases import frame, prose


# ---------------------------------------------------------------- decontamination

def test_leaks_in_many_documents(spark):
    """Copies of one item with every fourth word changed, and half of another item, in 9 and in 1000 documents."""
    ship(spark)
    rng = random.Random(21)
    items = [prose(rng, 40, 3000) for _ in range(4)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    changed = [" ".join("other" if i % 4 == 3 else w for i, w in enumerate(t.split())) for t in items]
    half = " ".join(items[2].split()[:18])
    texts, truth = [], set()
    for item, copy, times in ((0, changed[0], 9), (1, changed[1], 1000), (2, half, 9)):
        for _ in range(times):
            truth.add((len(texts), item))
            texts.append(f"{prose(rng, 30, 3000)} {copy} {prose(rng, 30, 3000)}")
    texts += [prose(rng, 100, 3000) for _ in range(200)]
    docs = frame(spark, texts)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, benchmark).collect()} == truth
    left = docs.where(~decontaminate.leaks(docs, benchmark, F.col("text"))).select("doc_id").collect()
    assert {r["doc_id"] for r in left} == set(range(1018, len(texts)))


def test_passage_of_a_long_item(spark):
    """70 of 200 words as they stand, 24 words, and 60 with every seventh changed; 10 words are none."""
    ship(spark)
    rng = random.Random(22)
    items = [prose(rng, 200, 3000).split() for _ in range(4)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    passages = [items[0][60:130], items[1][100:124], [w if i % 7 else "other" for i, w in enumerate(items[2][20:80])], items[3][50:60]]
    docs = frame(spark, [f"{prose(rng, 50, 3000)} {' '.join(p)} {prose(rng, 50, 3000)}" for p in passages] + [prose(rng, 300, 3000) for _ in range(100)])
    found = decontaminate.find(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 0), (1, 1), (2, 2)}
    assert docs.where(decontaminate.leaks(docs, benchmark, F.col("text"))).count() == 3


# ---------------------------------------------------------------- licences

MIT = '''Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.'''
GPL3 = '''    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.'''
GPL2 = GPL3.replace("software:", "software;").replace("version 3", "version 2")
APACHE = '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.'''
BSD = '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION).'''


def commented(text, first, mark, last):
    return "\n".join([*first, *(f"{mark}{x}".rstrip() for x in text.split("\n")), *last])


@pytest.mark.parametrize("text,name,least", [(MIT, "MIT", 4), (GPL3, "GPL-3.0-or-later", 4), (GPL2, "GPL-2.0-or-later", 4), (APACHE, "Apache-2.0", 5),
                                             (BSD, "BSD-3-Clause", 6)])
@pytest.mark.parametrize("first,mark,last", [([], "", []), ([], "# ", []), ([], "// ", []), (["/*"], " * ", [" */"]), ([], "      ", []),
                                             (["<!--"], "  ", ["-->"]), ([], "dnl ", [])])
def test_canonical_licences(text, name, least, first, mark, last):
    text = "\n".join(["x = 1", "", commented(text, first, mark, last), "", "y = 2"])
    found = licences.sentence_ids(text)
    names, left = licences.match_rules(found)
    assert names == [name] and left == 0 and len(found) == least and "?" not in [x[0] for x in found]
    assert all(a < z for _, _, a, z in found) and all(x[3] <= y[2] for x, y in zip(found, found[1:]))


def test_licence_lines_without_stops():
    ids = [x[0] for x in licences.sentence_ids("Some words\nReleased under the MIT License\nmore words\n# SPDX-License-Identifier: MIT\ncode\n"
                                               "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                                               "that the following conditions are met\n* Redistributions of source code must retain the above copyright notice")]
    assert ids == ["MitRelease", "SpdxTag", "BsdRedist", "BsdSource"]
    assert len(licences.sentence_ids("a word\n" * 30_000 + "Licensed under CC BY 4.0\n" + "Further words\n" * 30_000)) == 1


# ---------------------------------------------------------------- secrets

def test_keys_in_usual_places(spark):
    """KEY=value, queries, options, paths: the key is masked."""
    rng = random.Random(23)
    places = ["DB_KEY={}", "https://h.io/a?sig={}", "--credential={}", "https://h.io/my-app/{}", "see some/long/path/of-words/{}/tail", "my_app-name_{}",
              "a=b={}", "export X_KEY={}== now", "plain {} key", "/{}", "{}"]
    letters = string.ascii_letters + string.digits
    texts, keys = [], []
    for i in range(440):
        keys.append("".join(rng.choice(letters) for _ in range(rng.choice([32, 40]))))
        texts.append(f"{prose(rng, 5)} {places[i % len(places)].format(keys[-1])}")
    docs = frame(spark, texts)
    got = {r["doc_id"]: r["text"] for r in secrets.without_secrets(docs).collect()}
    for k in range(len(places)):
        some = range(k, len(texts), len(places))
        assert sum(keys[i] not in got[i] for i in some) >= 0.85 * len(some), places[k]
    assert all(prose_part in got[i] for i, prose_part in enumerate(t.split(" ")[0] for t in texts))


def test_parts_of_runs(spark):
    """Places of runs and parts; equals signs only as padding."""
    a, b = "aB3dE6gH9jK2mN5pQ8sT", "zY7xW4vU1tS8rQ5pO2nM6"
    text = f"é x={a}== {a}/{b} {a}={b} w/{a}-{b}=, short-ones/and_more"
    got = frame(spark, [text]).select(F.explode(secrets.candidates(F.col("text"))).alias("c")).select("c.*").collect()
    found = sorted(text[r["start"]:r["end"]] for r in got)
    assert found == sorted([f"{a}==", a, b, f"{a}/{b}", a, b, f"{a}-{b}=", f"w/{a}", a, f"{b}="])


def strata(spark, rows):
    kind = "candidates array<struct<start: int, end: int, encoding: string, band: int, p: double>>"
    return secrets.thresholds(spark.createDataFrame([([(0, 32, *r)],) for r in rows], kind))


@pytest.mark.parametrize("identifiers", [0, 10, 19, 20, 100, 1000])
def test_one_key_among_identifiers(spark, identifiers):
    """A key of any size of stratum is found, whichever half its p lies in; identifiers are not."""
    for p in (0.12, 0.45, 0.8):
        least = strata(spark, [("base62", 32, 0.001 + 0.008 * i / 1000) for i in range(identifiers)] + [("base62", 32, p)])
        assert 0.01 <= least["base62", 32] / secrets.BINS <= p


def test_neighbours_share_keys(spark):
    """Three keys of low p beside a band full of keys; identifiers alone in a wide band stay."""
    keys = [("base62", 40, i / 400) for i in range(400)]
    few = [("base62", 32, p) for p in (0.1, 0.2, 0.3)] + [("base62", 32, 0.002)] * 500
    assert strata(spark, keys + few)["base62", 32] <= 10
    wide = [("base64url", 32, i / 2000) for i in range(1000)]
    assert strata(spark, wide)["base64url", 32] >= 45


# ---------------------------------------------------------------- toxicity

def test_all_sure_terms(spark):
    """900 toxic words, each in a few examples: every one of them is known and found."""
    ship(spark)
    rng = random.Random(24)
    bad = [f"z{a}{b}" for a in string.ascii_lowercase + string.digits for b in string.ascii_lowercase][:900]
    texts, labels = [], []
    for i in range(4000):
        toxic = i % 10 == 0
        texts.append(" ".join([prose(rng, 15, 100), *(bad[(i // 10 * 30 + j) % 900] for j in range(30 if toxic else 0))]))
        labels.append((i, int(toxic)))
    model = toxicity.fit(frame(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(model.terms.keys) >= 900
    scores, why = model.scores(pa.array(bad), evidence=True)
    assert all(why) and (scores >= 0.5).all()
    assert model.scores(pa.array(["w1x1 w2x2"]))[0][0] < 0.5


# ---------------------------------------------------------------- licence tags and further notices

@pytest.mark.parametrize("tag,expression", [
    ("MIT OR Apache-2.0", "MIT OR Apache-2.0"), ("(mit or apache-2.0)", "(MIT OR Apache-2.0)"), ("LGPL-2.1-or-later", "LGPL-2.1-or-later"),
    ("GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0-only WITH Classpath-exception-2.0"), ("GPL-2.0+ */", "GPL-2.0+"),
    ("MIT AND (BSD-3-Clause OR (ISC AND Zlib)) -->", "MIT AND (BSD-3-Clause OR (ISC AND Zlib))"), ("LicenseRef-Own-1", "LicenseRef-Own-1"),
    ("MIT and nothing else", "MIT"), ("MIT OR", "MIT"), ("(MIT", None), ("OR MIT", None), ("(" * 3000 + "MIT" + ")" * 3000, "(" * 3000 + "MIT" + ")" * 3000)])
def test_licence_tags(tag, expression):
    found = licences.sentence_ids(f"code\n// SPDX-License-Identifier: {tag}\nMore code")
    names, left = licences.match_rules(found)
    assert names == ([expression] if expression else []) and left == 0
    assert [x[0] for x in found] == (["SpdxTag"] if expression else ["?"])


AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,\nEXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF\nMERCHANTABILITY.'
ISC_END = '''THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS.'''


def gnu(kind, what, version):
    return f'''This {what} is free software; you can redistribute it and/or
modify it under the terms of the GNU {kind} General Public
License as published by the Free Software Foundation; either
version {version} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
{kind} General Public License for more details.

You should have received a copy of the GNU {kind} General Public
License along with this {what}; if not, see <https://www.gnu.org/licenses/>.'''


@pytest.mark.parametrize("first,mark,last", [([], "", []), ([], "# ", []), (["/*"], " * ", [" */"])])
@pytest.mark.parametrize("name,text", [
    ("LGPL-2.1-or-later", gnu("Lesser", "library", "2.1")), ("LGPL-3.0-or-later", gnu("Lesser", "library", "3")),
    ("AGPL-3.0-or-later", gnu("Affero", "program", "3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
            "copyright notice and this permission notice appear in all copies.\n\n" + ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for\nany purpose with or without fee is hereby granted.\n\n" + ISC_END),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\n"
                  "distribute this software, for any purpose.\n\n" + AS_IS + "\nIN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR\nOTHER LIABILITY, ARISING FROM THE SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\n"
             "arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\n"
             "freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt or copy at\nhttps://www.boost.org/LICENSE_1_0.txt)"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttp://www.eclipse.org/legal/epl-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/."),
])
def test_further_notices(name, text, first, mark, last):
    found = licences.sentence_ids("\n".join(["x = 1", "", commented(text, first, mark, last), "", "y = 2"]))
    names, left = licences.match_rules(found)
    assert names == [name] and left == 0 and "?" not in [x[0] for x in found], found


def test_unknown_permission_notice():
    own = licences.sentence_ids("Permission to copy this work is given to friends of the author only.")
    assert [x[0] for x in own] == ["?"]
    assert not licences.sentence_ids("She asked for permission to leave and it was granted.")
