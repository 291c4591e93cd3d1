"""License scans by sentence rules.

Texts are split into normalised sentences; known licence sentences map to identifiers; the
ordered identifiers of a document are matched against ordered licence rules.  A rule that
matches consumes its identifiers, so a longer rule goes before the rules it contains;
identifiers that no rule takes count as unmatched.

Normalised: lower case, every run of characters other than a-z, 0-9, ``.`` and ``-`` is one
space, no ``.`` or space at either end.  Sentences end at ``. ! ? ;`` before white space (not inside
``v. 2.0``), at ``:`` before a line break, at a blank line and after a copyright line; single line breaks and
comment leaders are white space.  A sentence that is not known as a whole is read line by line, so one-line
notices need no punctuation around them.
The SQL reads one-line sentences only: the same result on texts without wrapped notices.

Defined cases: null and empty texts have no sentences; every row of the input gives one row
(equal rows too); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table

# Sentences of published licence texts and notices, normalised.
SENTENCES = {
    "apache-short": "licensed under the apache license version 2.0",
    "apache-notice": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-limits": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-grant": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "gpl3-short": "this work is licensed under the gnu general public license version 3",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-see": "see the gnu general public license for more details",
    "gpl3-or-later": "either version 3 of the license or at your option any later version",
    "gpl2-or-later": "either version 2 of the license or at your option any later version",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "bsd-intro": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2-form": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "cc-by-nc-4": "licensed under cc by-nc 4.0",
    "cc-by-4": "licensed under cc by 4.0",
    "cc-by-sa-4": "licensed under cc by-sa 4.0",
    "spdx-mit": "spdx-license-identifier mit",
    "spdx-apache": "spdx-license-identifier apache-2.0",
    "spdx-gpl3": "spdx-license-identifier gpl-3.0-or-later",
}
# Other published spellings, normalised, of the same sentences.
_GPL = "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
PUBLISHED = {
    "licensed under the apache license version 2.0 the license": "apache-short",
    **{start + _GPL + SENTENCES[name]: name for name in ("gpl2-or-later", "gpl3-or-later") for start in ("", "this program is free software ")},
    **{"this work is " + SENTENCES[name]: name for name in ("cc-by-4", "cc-by-nc-4", "cc-by-sa-4")},
    **{f"this work is licensed under {a} creative commons {said} 4.0 international license": name for a in ("a", "the") for said, name in
       (("attribution", "cc-by-4"), ("attribution-noncommercial", "cc-by-nc-4"), ("attribution-sharealike", "cc-by-sa-4"))},
}
# Licence rules in the order of matching.
RULES = [
    ("Apache-2.0", ["apache-short", "apache-notice", "apache-copy", "apache-as-is", "apache-limits"]),
    ("MIT", ["mit-grant", "mit-as-is", "mit-liability"]),
    ("GPL-3.0-or-later", ["gpl3-or-later", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("GPL-2.0-or-later", ["gpl2-or-later", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("BSD-3-Clause", ["bsd-intro", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-intro", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-short"]),
    ("MIT", ["mit-short"]),
    ("GPL-3.0-only", ["gpl3-short"]),
    ("MPL-2.0", ["mpl2-form"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("GPL-3.0-or-later", ["spdx-gpl3"]),
]
#: Every known sentence holds one of these, so a text without any of them has no known sentence.
MARKERS = ("licens", "permission", "copyright", "warrant", "compliance", "redistribution")

LEADER = r"(?m)^[ \t]*(?:<!--|/\*+|\*+/?|//+|#+|--+>?|-(?=[ \t])|;+|%+|(?:dnl|rem)(?=[ \t]|$))[ \t]*"
COPYRIGHT = r"(?m)^([ \t]*copyright[ \t]+(?:\(c\)|©|[\[<]|[0-9]).*)$"


def sentence_ids(docs: DataFrame, text_col: str = "text") -> F.Column:
    """Identifiers of the known sentences of a text, in order."""
    low = F.lower(F.col(text_col))
    marked = None
    for m in MARKERS:
        marked = low.contains(m) if marked is None else marked | low.contains(m)
    bare = F.regexp_replace(F.regexp_replace(low, "\r\n?", "\n"), LEADER, "")
    whole = F.regexp_replace(F.regexp_replace(bare, r"\bv\.[ \t\n\x0B\f]+([0-9])", "v.\t$1"), COPYRIGHT, "$1\n\n")
    ended = F.regexp_replace(F.regexp_replace(whole, r":[ \t]*\n", ":\n\n"), r"([!?;]|(?<!\bv)\.|(?<=\bv)\.(?!\t[0-9]))[ \t\n\x0B\f]+", "$1\n\n")
    said_as = {said: name for name, said in SENTENCES.items()} | PUBLISHED
    known = F.create_map(*[F.lit(x) for pair in said_as.items() for x in pair])
    has_marker = lambda x: F.greatest(*[x.contains(m) for m in MARKERS])
    named = lambda x: F.try_element_at(known, F.regexp_replace(F.regexp_replace(x, "[^a-z0-9.-]+", " "), "^[. ]+|[. ]+$", ""))
    by_line = lambda x: F.transform(F.filter(F.split(x, "\n"), has_marker), named)
    sentences = F.filter(F.split(ended, r"\n[ \t\x0B\f]*\n[ \t\n\x0B\f]*"), has_marker)
    found = F.flatten(F.transform(sentences, lambda x: F.when(named(x).isNotNull(), F.array(named(x))).otherwise(by_line(x))))
    ids = F.filter(found, lambda x: x.isNotNull())
    return F.when(marked, ids).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_sentences (known ones), sentences, licenses (rule order, each as often as matched), n_unmatched."""
    found = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(docs, text_col).alias("ids"))
    left = F.concat(F.lit(";"), F.array_join(F.transform("ids", lambda x: F.concat(x, F.lit(";"))), ""))
    found = found.withColumn("left", left)
    rows = found.where(F.size("ids") > 0)
    rest = found.where(F.coalesce(F.size("ids"), F.lit(0)) <= 0)
    names = []
    for k, (_, ids) in enumerate(RULES):
        sequence = ";" + ";".join(ids) + ";"
        # a matched sequence leaves one ";", so neighbours keep their borders; equal neighbours share a border and are doubled first
        rows = rows.withColumn("open", F.replace("left", F.lit(";"), F.lit(";;")))
        rows = rows.withColumn("next", F.replace("open", F.lit(sequence.replace(";", ";;")[1:-1]), F.lit("")))
        rows = rows.withColumn(f"n{k}", ((F.length("open") - F.length("next")) / len(sequence.replace(";", ";;")[1:-1])).cast("int"))
        rows = rows.withColumn("left", F.regexp_replace("next", ";+", ";")).drop("open", "next")
        names.append(F.array_repeat(F.lit(RULES[k][0]), F.col(f"n{k}")))
    done = rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ";").alias("sentences"),
                       F.array_join(F.flatten(F.array(*names)), ";").alias("licenses"),
                       F.size(F.filter(F.split("left", ";"), lambda x: x != "")).cast("long").alias("n_unmatched"))
    none = rest.select("doc_id", F.lit(0).cast("long").alias("n_sentences"), F.lit("").alias("sentences"), F.lit("").alias("licenses"),
                       F.lit(0).cast("long").alias("n_unmatched"))
    return done.unionByName(none)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def license_sql() -> str:
    """The same scan in DuckDB SQL."""
    known = ", ".join(f"('{said}', '{name}')" for name, said in SENTENCES.items())
    marked = " OR ".join(f"contains(x, '{m}')" for m in MARKERS)
    step, names, left = [], [], "l0"
    for k, (name, ids) in enumerate(RULES):
        seq = (";" + ";".join(ids) + ";").replace(";", ";;")[1:-1]
        step.append(f"s{k} AS (SELECT *, regexp_replace(replace(replace({left}, ';', ';;'), '{seq}', ''), ';+', ';', 'g') AS l{k + 1}, "
                    f"CAST((length(replace({left}, ';', ';;')) - length(replace(replace({left}, ';', ';;'), '{seq}', ''))) / {len(seq)} AS INT) AS n{k} "
                    f"FROM {'seqs' if not k else f's{k - 1}'})")
        names.append(f"repeat('{name};', n{k})")
        left = f"l{k + 1}"
    return f"""
WITH known(said, name) AS (VALUES {known}),
docs AS (SELECT doc_id, row_number() OVER () AS r, text FROM documents),
cut AS (SELECT doc_id, r, string_split_regex(regexp_replace(lower(text), '([.!?;])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(10), 'g'), '[\\n\\r]+') AS xs FROM docs),
parts AS (SELECT r, unnest(xs) AS x, unnest(range(len(xs))) AS pos FROM cut),
ids AS (SELECT r, string_agg(name, ';' ORDER BY pos) AS sentences, count(*) AS n FROM parts
        JOIN known ON said = regexp_replace(regexp_replace(x, '[^a-z0-9.-]+', ' ', 'g'), '^[. ]+|[. ]+$', '', 'g')
        WHERE {marked} GROUP BY r),
seqs AS (SELECT doc_id, coalesce(sentences, '') AS sentences, coalesce(n, 0) AS n_sentences, ';' || coalesce(sentences || ';', '') AS l0
         FROM docs LEFT JOIN ids USING (r)),
{', '.join(step)}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, sentences, rtrim({' || '.join(names)}, ';') AS licenses,
       CAST(len(list_filter(string_split({left}, ';'), lambda x: x <> '')) AS BIGINT) AS n_unmatched
FROM s{len(RULES) - 1}"""
