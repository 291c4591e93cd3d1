"""License scan, sharding and mixing against brute force on small tables."""

import binascii

import pytest
from pyspark.sql import functions as F

from tessera.llm import license_scan, mixing, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, slot string, rate string"
TEXTS = [
    None, "", " \n\t ", "plain words only.",
    "Released under the MIT License.",
    "Some text. Licensed under the Apache License, Version 2.0. More; Released  under the\tMIT License!\nLicensed under CC BY-NC 4.0.",
    "Released under the MIT License.\nReleased under the MIT License.\nReleased under the MIT License.",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    "See the GNU General Public License for more details.",
    "word " * 30000 + ". Licensed under CC BY 4.0.",
    "SPDX-License-Identifier: MIT\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n1",
]


def docs(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "src0", len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def test_license_rules(spark):
    out = {r.doc_id: r for r in license_scan.scan(docs(spark, TEXTS)).collect()}
    assert len(out) == len(TEXTS)
    assert [out[i].n_sentences for i in range(len(TEXTS))] == [0, 0, 0, 0, 1, 3, 3, 2, 1, 2]
    assert out[4].licenses == "MIT"
    assert out[5].sentences == "apache-short;mit-short;cc-by-nc-4"
    assert out[5].licenses == "Apache-2.0;MIT;CC-BY-NC-4.0"
    assert out[6].licenses == "MIT;MIT;MIT"
    assert (out[7].licenses, out[7].n_unmatched) == ("", 2)
    assert out[8].licenses == "CC-BY-4.0"
    assert (out[9].licenses, out[9].sentences) == ("MIT", "spdx-mit;bsd-intro")
    assert all(any(m in said for m in license_scan.MARKERS) for said in license_scan.SENTENCES.values())


def test_license_longer_rule_first(spark):
    mit = [s for k, s in license_scan.SENTENCES.items() if k in ("mit-grant", "mit-as-is", "mit-liability")]
    texts = [". ".join(mit) + ".", ". ".join(reversed(mit)) + ".", ". ".join([license_scan.SENTENCES["mit-short"], *mit, license_scan.SENTENCES["mit-short"]])]
    out = {r.doc_id: r for r in license_scan.scan(docs(spark, texts)).collect()}
    assert (out[0].licenses, out[0].n_unmatched) == ("MIT", 0)
    assert (out[1].licenses, out[1].n_unmatched) == ("", 3)
    assert out[2].licenses == "MIT;MIT;MIT"


PUBLISHED = {
    "Apache-2.0": """Copyright 2020 Some Body
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MIT": """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under\nCC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under\nCC BY-SA 4.0",
    "GPL-3.0-only": "This work is licensed under the GNU General\nPublic License, version 3.",
}
PUBLISHED["GPL-2.0-or-later"] = (PUBLISHED["GPL-3.0-or-later"].replace("software:", "software;").replace("version 3", "version 2")
                                 .replace("program.  If not, see", "program; if not, write to"))
PUBLISHED["BSD-2-Clause"] = PUBLISHED["BSD-3-Clause"].split("3. ")[0]


@pytest.mark.parametrize("leader", ["", " * ", "// ", "# ", "-- ", ";; "])
def test_wrapped_published_notices(spark, leader):
    names = list(PUBLISHED)
    texts = ["\r\n".join(leader + x for x in PUBLISHED[n].split("\n")) for n in names]
    texts += ["\n".join(leader + x for x in ("A title", "SPDX-License-Identifier: MIT", "Released under the MIT License", "more"))]
    out = {r.doc_id: r for r in license_scan.scan(docs(spark, texts)).collect()}
    assert [(out[i].licenses, out[i].n_unmatched) for i in range(len(texts))] == [*((n, 0) for n in names), ("MIT;MIT", 0)]


def test_empty_tables(spark):
    none = docs(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert license_scan.scan(none).count() == 0
    assert sharding.shard(none).count() == 0
    assert mixing.mix(none, labels).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_sharding(spark, parts):
    texts = [None, "", "é" * 5, *["copy"] * 40, *["w" * (i % 97) for i in range(300)]]
    ids = [None, None, 2, *[7] * 40, *range(1000, 1300)]
    out = sharding.shard(docs(spark, texts, ids).repartition(parts), shards=8, slots=64).collect()
    assert len(out) == len(texts)
    crc = sorted(binascii.crc32((t or "").encode()) for t in texts)
    assert sorted(r.text_crc32 for r in out) == crc
    assert sorted(r["size"] for r in out) == sorted(len((t or "").encode()) + 1 for t in texts)
    load, places, slots = {}, {}, {}
    for r in out:
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        places.setdefault(r.shard, []).append(r.slot)
        slots.setdefault(r.virtual_slot, set()).add(r.shard)
        assert r.next_shard in (r.shard, 8)
    assert all(len(s) == 1 for s in slots.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    biggest = max(sum(r["size"] for r in out if r.virtual_slot == s) for s in slots)
    assert max(load.values()) - min(load.values()) <= biggest


def test_slot_map_is_greedy(spark):
    rows = spark.createDataFrame([(i, s, 0, 1, i) for i, s in enumerate([90, 70, 60, 50, 40, 30, 20, 10, 5])],
                                 "doc_id long, size long, text_crc32 long, copy long, virtual_slot int")
    got = {r.virtual_slot: r.shard for r in sharding.slot_map(rows, 3).collect()}
    load, want = [0, 0, 0], {}
    for i, s in enumerate([90, 70, 60, 50, 40, 30, 20, 10, 5]):
        k = load.index(min(load))
        load[k] += s
        want[i] = k
    assert got == want
    nxt = sharding.add_shard(sharding.slot_map(rows, 3))
    moved = [r for r in nxt.collect() if r.shard == 3]
    assert all(r.version == 1 for r in moved) and all(r.shard in (want[r.virtual_slot], 3) for r in nxt.collect())


def mixing_tables(spark):
    good = [f"alpha beta gamma n{i} delta" for i in range(60)]
    bad = [f"alpha beta n{i} ugly vile delta" for i in range(20)]
    low = [f"alpha!! beta!! gamma!! n{i}!!" for i in range(20)]
    texts = [*good, *bad, *low, None, ""]
    labels = [(i, 1, 0) for i in range(60)] + [(60 + i, 1, 1) for i in range(20)] + [(80 + i, 0, 0) for i in range(20)]
    return docs(spark, texts), spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def test_mixing_meets_targets(spark):
    d, labels = mixing_tables(spark)
    out = mixing.mix(d, labels).collect()
    assert len(out) == d.count()
    by = {r.doc_id: r for r in out}
    assert all(abs(r.p_high + r.p_low + r.p_toxic - 1) < 1e-9 and r.rate >= 0 for r in out)
    assert all(by[i].p_toxic > 0.9 and by[i].copies == 0 for i in range(60, 80))
    assert all(by[i].p_low > 0.9 for i in range(80, 100))
    total = {k: sum(r.n_tokens * r["p_" + k] * r.rate for r in out) for k in mixing.DOMAINS}
    size = sum(total.values())
    assert abs(total["high"] / size - 0.8) < 0.02 and total["toxic"] / size < 0.02
    assert by[100].n_tokens == by[101].n_tokens == 0


def test_rates_match_dense_projected_gradient(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.3, 0.3], 80)
    t = rng.integers(1, 500, 80)
    member = spark.createDataFrame([(i, int(t[i]), *map(float, p[i])) for i in range(80)], "doc_id long, n_tokens long, p_high double, p_low double, p_toxic double")
    targets = {"high": 0.5, "low": 0.3, "toxic": 0.2}
    rate, totals, goal = mixing.fit_rates(member, targets)
    r = np.array([x.rate for x in member.withColumn("rate", rate).orderBy("doc_id").collect()])
    assert (r >= 0).all()
    assert np.allclose((t[:, None] * p * r[:, None]).sum(0), list(totals.values()))
    assert np.allclose(list(totals.values()), list(goal.values()), rtol=0.02)


def test_apply_mix_keeps_columns(spark):
    d, labels = mixing_tables(spark)
    mixed = mixing.mix(d, labels)
    out = mixing.apply_mix(d, mixed)
    assert out.columns == d.columns
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]


def test_mixing_without_labels(spark):
    d, _ = mixing_tables(spark)
    out = mixing.mix(d, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(out) == d.count()
