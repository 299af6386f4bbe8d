"""Licence scans in DataFrame functions only: sparse TF-IDF cosine of headers and licence files to licence texts, and inheritance from the nearest directory.

1. Units of a file are its whole text (a licence file), its paragraphs of several lines (headers, wherever lines wrap), and its single lines (a sentence that grants a licence). Templates
   are whole licence texts, whole standard headers and such sentences.
2. Terms are the distinct lower-cased words (letters and digits) of the templates; their document frequencies are counted over all lines of all
   files, and idf = ln((1 + lines) / (1 + lines with the term)) + 1. A term that no template has weighs ln(1 + lines) + 1 in a unit's norm.
3. Only what can reach the threshold is compared: a cosine with a template is at most the root of the share of the template's squared norm that the unit's terms cover. Files whose
   terms cover less than THRESHOLD squared of every template are left out at once, then units. This is exact.
4. A unit's cosine with a template is summed over their common terms, whose numbers are the lengths of runs in its sorted terms; a file's own licence is its best unit's best template (ties: the smaller name)
   at THRESHOLD or more.
5. Files without a licence of their own inherit from the nearest directory above them that has a licence file, by an equi-join on the ancestors
   of a file's directory. A licence file is one whose whole text is a licence's, or whose licence lines are at least half of its lines that aren't blank; where a directory has
   several, the smallest path decides.

Templates are few: their terms and weights are part of the plan. A unit's sparse vector, norm and cosines are worked out within its row, in time n log n of its terms, so that only
licences found are shuffled. Null texts have no units, null paths no directory; each row is a file, also where rows share a path, and repeated rows stay. An empty table gives an empty result. Other
columns stay only if they are named.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

THRESHOLD = 0.6
_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
    "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
#: Licences, and their texts, standard headers and the sentences that grant them (fixed values).
TEMPLATES = [
    ("MIT", "MIT License. Copyright (c). Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY "
     "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
     "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "ISC License. Copyright (c). Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
     "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
     "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", f"BSD 2-Clause License. Copyright (c). All rights reserved. {_BSD2} {_WARRANTY}"),
    ("BSD-3-Clause", f"BSD 3-Clause License. Copyright (c). All rights reserved. {_BSD2} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
     f"this software without specific prior written permission. {_WARRANTY}"),
    ("Apache-2.0", "Copyright. Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
     "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
     "GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
]
_WORD, _GAP = r"[^\p{L}\p{N}]+", r"\n[ \t\r\n]*\n"


def _terms(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), _WORD), lambda x: x != "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x)) > 0)


def _table(values: dict[str, float]) -> Column:
    """A map of terms, folded into a literal."""
    return F.expr("map(" + ", ".join(f"'{term}', {x!r}D" for term, x in values.items()) + ")")


def _once(value: Column, then) -> Column:
    """then(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _counted(terms: Column) -> Column:
    """(term, tf) of the distinct terms, from where runs of equal terms start in the sorted ones."""

    def runs(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return _once(first, lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("tf"))))

    return F.when(F.size(terms) > 0, _once(F.array_sort(terms), runs))


def _scores(terms: Column, idfs: Column, unknown: float, weights: dict[tuple[int, str], dict[str, float]]) -> Column:
    """(licence, score) of every template: the cosine of a unit's terms with it."""
    if not weights:
        return F.array().cast("array<struct<licence:string,score:double>>")

    def cosines(vector: Column) -> Column:
        norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + F.pow(x["tf"] * F.coalesce(x["idf"], F.lit(unknown)), F.lit(2.0))))
        known = F.filter(vector, lambda x: x["idf"].isNotNull())

        def dot(own: dict[str, float], of: Column) -> Column:
            return F.aggregate(of, F.lit(0.0), lambda total, x: total + x["tf"] * x["idf"] * F.coalesce(F.try_element_at(_table(own), x["term"]), F.lit(0.0)))

        return _once(F.struct(norm.alias("norm"), known.alias("known")), lambda v: F.array(*[F.struct(F.lit(licence).alias("licence"), F.round(dot(own, v["known"]) / v["norm"], 9).alias("score")) for (_, licence), own in weights.items()]))

    return _once(F.transform(_counted(terms), lambda x: F.struct(x["term"].alias("term"), x["tf"].alias("tf"), F.try_element_at(idfs, x["term"]).alias("idf"))), cosines)


def _covered(terms: Column, table: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + F.coalesce(F.try_element_at(table, x), F.lit(0.0)))


def _reaches(known: Column, shares: dict[int, dict[str, float]], threshold: float) -> Column:
    """Whether the terms cover enough of some template's squared norm; shares: of each template, by term. The terms are worked out once."""
    tables = [_table(own) for own in shares.values()]

    def any_of(terms: Column) -> Column:
        test = F.lit(False)
        for table in tables:
            test = test | (_covered(terms, table) >= threshold**2 - 1e-9)
        return test

    return F.exists(F.array(known), any_of)


def own_licences(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """id, path, licence, score and is_licence_file of the files with a licence of their own. files: id, path and text; templates: licence and text."""
    spark = files.sparkSession
    numbered = [(i, x["licence"], x["text"]) for i, x in enumerate(sorted(templates.select("licence", "text").collect()))]
    rows = spark.createDataFrame(numbered, "template int, licence string, text string").select("template", "licence", F.explode(_terms(F.col("text"))).alias("term")).groupBy("template", "licence", "term").agg(F.count("*").alias("tf"))
    listed = F.split(F.lit(" ".join(sorted({x["term"] for x in rows.select("term").distinct().collect()}))), " ")

    lines = files.select(F.explode(_lines(F.col("text"))).alias("line"))
    known = lines.select(F.explode(F.array_union(F.array_intersect(_terms(F.col("line")), listed), F.array(F.lit("")))).alias("term"))
    counts = {x["term"]: x["df"] for x in known.groupBy("term").agg(F.count("*").alias("df")).collect()}  # "" stands for any line
    n = counts.pop("", 0)
    vectors = [(x["template"], x["licence"], x["term"], math.log((1 + n) / (1 + counts.get(x["term"], 0))) + 1, x["tf"]) for x in rows.collect()]  # as many as the templates have words
    norms: dict[int, float] = {}
    for t, _, _, idf, tf in vectors:
        norms[t] = norms.get(t, 0.0) + (tf * idf) ** 2
    shares: dict[int, dict[str, float]] = {t: {} for t in norms}
    for t, _, term, idf, tf in vectors:
        shares[t][term] = (tf * idf) ** 2 / norms[t]
    idfs = _table({term: idf for _, _, term, idf, _ in vectors})
    weights: dict[tuple[int, str], dict[str, float]] = {}
    for t, licence, term, idf, tf in vectors:
        weights.setdefault((t, licence), {})[term] = tf * idf / norms[t] ** 0.5
    unknown = math.log(1 + n) + 1

    some = files.where(_reaches(F.array_intersect(_terms(F.col("text")), listed), shares, threshold))
    text, several = F.col("text"), F.col("text").contains("\n")
    kinds = [("line", _lines(text)), ("block", F.filter(F.split(text, _GAP), lambda x: x.contains("\n"))), ("file", F.when(several, F.array(text)).otherwise(F.array().cast("array<string>")))]
    units = F.concat(*[_unit(c, kind) for kind, c in kinds])
    units = some.select("id", "path", F.size(_lines(text)).alias("n_lines"), F.posexplode(units).alias("unit", "u")).select("id", "path", "n_lines", "unit", "u.kind", _terms(F.col("u.x")).alias("terms"))
    units = units.where(_reaches(F.array_intersect("terms", listed), shares, threshold))
    every = units.select("id", "path", "n_lines", "unit", "kind", _scores(F.col("terms"), idfs, unknown, weights).alias("scores"))
    cosine = every.select("id", "path", "n_lines", "unit", "kind", F.explode(F.filter("scores", lambda x: x["score"] >= threshold)).alias("s")).select("id", "path", "n_lines", "unit", "kind", "s.*")
    hits = F.count_distinct(F.when(F.col("kind") == "line", F.col("unit")))
    best = cosine.groupBy("id").agg(F.first("path").alias("path"), F.min_by("licence", F.struct(-F.col("score"), F.col("licence"))).alias("licence"), F.max("score").alias("score"), hits.alias("hits"), F.max("n_lines").alias("n_lines"), F.bool_or(F.col("kind") == "file").alias("whole"))
    return best.select("id", "path", "licence", "score", (F.col("whole") | (2 * F.col("hits") >= F.col("n_lines"))).alias("is_licence_file"))


def _unit(texts: Column, kind: str) -> Column:
    return F.transform(texts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("x")))


def _parent(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def licensed(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, path, licence, score, found ('own', 'inherited' or null) and licensed_by (the path that it comes from) of every row."""
    ident = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), F.col("path"), F.col("text"))), 16, "0") for seed in (1, 2)])
    rows = files.select(*keep, "path", "text", ident.alias("id"))
    own = written(own_licences(rows.select("id", "path", "text"), templates, threshold), "licences")  # read twice
    homes = own.where("is_licence_file AND path IS NOT NULL").select(_parent(F.col("path")).alias("dir"), F.struct("path", "licence", "score").alias("of"))
    homes = homes.groupBy("dir").agg(F.min("of").alias("of"))
    parts = F.split(_parent(F.col("path")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("dir")))
    ancestors = files.where("path IS NOT NULL").select("path").distinct().select("path", F.explode(above).alias("a")).select("path", "a.depth", "a.dir")
    heirs = ancestors.join(homes, "dir").groupBy("path").agg(F.max_by("of", "depth").alias("of"))
    own = own.select("id", F.col("licence").alias("_licence"), F.col("score").alias("_score"))
    out = rows.drop("text").join(own, "id", "left").join(heirs, "path", "left")
    mine = F.col("_licence").isNotNull()
    return out.select(
        *keep, "path", F.coalesce("_licence", "of.licence").alias("licence"), F.when(mine, F.col("_score")).otherwise(F.col("of.score")).alias("score"),
        F.when(mine, "own").when(F.col("of").isNotNull(), "inherited").alias("found"), F.when(mine, F.col("path")).otherwise(F.col("of.path")).alias("licensed_by"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Documents as files: source/lang/hundred/doc_id.txt; a null source or language is an empty name, without a doc_id there is no path."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    templates = spark.createDataFrame(TEMPLATES, "licence string, text string")
    out = licensed(docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text"), templates, keep=("doc_id",))
    return out.select("doc_id", "path", "licence", F.round("score", 6).alias("score"), "found", "licensed_by")


#: The same over all units of all files.
_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS template, licence, text FROM (VALUES @values) v(licence, text)),
tw AS (SELECT template, licence, term, count(*) AS tf FROM (SELECT template, licence, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS term FROM t) WHERE term <> '' GROUP BY ALL),
f AS (SELECT row_number() OVER () AS rid, doc_id, text, CASE WHEN doc_id IS NOT NULL THEN concat_ws('/', coalesce(source, ''), coalesce(lang, ''), (doc_id // 100)::VARCHAR, doc_id::VARCHAR || '.txt') END AS path FROM documents),
g AS (SELECT rid, text, list_filter(string_split(text, chr(10)), lambda x: length(trim(x)) > 0) AS ls FROM f),
u0 AS (SELECT rid, 'line' AS kind, unnest(ls) AS x FROM g UNION ALL SELECT rid, 'block', unnest(list_filter(string_split_regex(text, '\n[ \t\r\n]*\n'), lambda x: contains(x, chr(10)))) FROM g UNION ALL SELECT rid, 'file', text FROM g WHERE contains(text, chr(10))),
u AS (SELECT *, row_number() OVER () AS uid FROM u0),
uw AS (SELECT rid, uid, kind, term, count(*) AS tf FROM (SELECT rid, uid, kind, unnest(string_split_regex(lower(x), '[^\p{L}\p{N}]+')) AS term FROM u) WHERE term <> '' GROUP BY ALL),
n AS (SELECT count(*) AS n FROM u WHERE kind = 'line'), df AS (SELECT term, count(*) AS df FROM uw WHERE kind = 'line' GROUP BY term),
idf AS (SELECT term, ln((1 + n)::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM tw) LEFT JOIN df USING (term), n),
tv AS (SELECT template, licence, term, tf * idf AS w FROM tw JOIN idf USING (term)), tn AS (SELECT template, sqrt(sum(w * w)) AS norm FROM tv GROUP BY template),
uv AS (SELECT rid, uid, kind, term, tf * coalesce(idf, ln((1 + n)::DOUBLE) + 1) AS w FROM uw LEFT JOIN idf USING (term), n),
un AS (SELECT uid, sqrt(sum(w * w)) AS norm FROM uv GROUP BY uid),
c AS (SELECT rid, uid, kind, licence, round(dot / tn.norm / un.norm, 9) AS score FROM (SELECT rid, uid, kind, template, licence, sum(uv.w * tv.w) AS dot FROM uv JOIN tv USING (term) GROUP BY ALL) JOIN un USING (uid) JOIN tn USING (template)),
own AS (SELECT rid, first(licence ORDER BY score DESC, licence) AS licence, max(score) AS score, bool_or(kind = 'file') AS whole, count(DISTINCT CASE WHEN kind = 'line' THEN uid END) AS hits FROM c WHERE score >= 0.6 GROUP BY rid),
home AS (SELECT regexp_replace(path, '/[^/]*$', '') AS dir, first({'path': path, 'licence': licence, 'score': score} ORDER BY path, licence, score) AS o FROM own JOIN f USING (rid) JOIN g USING (rid) WHERE path IS NOT NULL AND (whole OR 2 * hits >= len(ls)) GROUP BY dir),
up AS (SELECT f.rid, o, length(dir) AS depth FROM f JOIN home ON starts_with(f.path, dir || '/') WHERE f.rid NOT IN (SELECT rid FROM own)),
inh AS (SELECT rid, first(o ORDER BY depth DESC) AS o FROM up GROUP BY rid)
SELECT f.doc_id, f.path, coalesce(own.licence, inh.o.licence) AS licence, round(coalesce(own.score, inh.o.score), 6) AS score, CASE WHEN own.rid IS NOT NULL THEN 'own' WHEN inh.rid IS NOT NULL THEN 'inherited' END AS found, CASE WHEN own.rid IS NOT NULL THEN f.path ELSE inh.o.path END AS licensed_by
FROM f LEFT JOIN own USING (rid) LEFT JOIN inh USING (rid)
"""
SQL = _SQL.replace("@values", ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in TEMPLATES))
