"""Licence scans: parts of a text against licence templates by the Dice coefficient
over distinct word bigrams.

Parts are the paragraphs of a text (cut at lines without letters and digits) and, where
a paragraph has several lines, each of its lines. A part is lower-cased and reduced to
letters and digits. Dice of at least t between sizes a and b needs
a >= b * t / (2 - t) and the reverse, so a part meets only the templates whose
range holds its number of bigrams: a lookup by that number in a small table. The same
bounds say how many bigrams of a part may be in no template; as every word that no
template has ends a bigram of its own (but for the first word), parts with more of such
words are put aside before their bigrams are made.

Everything is built-in functions in one pass; nothing is shuffled. The lookup table
has one row per size that any template admits, and is broadcast.

Null and empty texts have no parts; parts of one word have no bigrams and match
nothing. Between templates of equal score the first by name wins. Repeated rows are
scanned each. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices and texts of common licences.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT notice": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
#: Least Dice coefficient of a match, in hundredths.
LEAST = 80


def template_bigrams(text: str) -> set[tuple[str, str]]:
    words = re.findall(r"[^\W_]+", text.lower())
    return set(zip(words, words[1:], strict=False))


def sizes(n: int, least: int = LEAST) -> range:
    """Numbers of bigrams that can reach ``least`` hundredths with a template of n."""
    # 2 min(a, n) / (a + n) >= least / 100
    return range(-(-n * least // (200 - least)), n * (200 - least) // least + 1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _clean(text: Column) -> Column:
    """Letters and digits in lower case, single spaces, line feeds kept."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}\\n]+", " ")


def _words(clean: Column) -> Column:
    return F.split(F.btrim(clean, F.lit(" \n")), "[ \n]+")


def _bigrams(words: Column) -> Column:
    """Distinct bigrams as 64-bit hashes; null for less than two words."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) >= 2, F.array_distinct(pairs))


def candidates(docs: DataFrame, templates: dict[str, str], least: int) -> DataFrame:
    """n (bigrams of a part) -> templates that a part of this size can match."""
    spark = docs.sparkSession
    texts = spark.createDataFrame(sorted(templates.items()), "template string, text string").select(
        "template", _let(_words(_clean(F.col("text"))), _bigrams).alias("bigrams"))
    rows = [(name, n) for name, text in templates.items() for n in sizes(len(template_bigrams(text)), least)]
    admitted = spark.createDataFrame(rows, "template string, n int")
    return admitted.join(F.broadcast(texts), "template").groupBy("n").agg(
        F.array_sort(F.collect_list(F.struct("template", "bigrams"))).alias("templates"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: int = LEAST) -> DataFrame:
    """doc_id, part (place among the parts), n_bigrams, template, dice of every part that matches."""
    templates = templates or TEMPLATES
    known = F.array(*[F.lit(w) for w in sorted({w for t in templates.values() for w in re.findall(r"[^\W_]+", t.lower())})])

    def worth(words: Column) -> Column:
        # strange words - 1 <= strange bigrams <= bigrams * (2 - 2t) / (2 - t)
        strange = F.size(F.array_except(words, known)) - 1
        return strange * (200 - least) <= (F.size(words) - 1) * (200 - 2 * least)
    parts = F.flatten(F.transform(F.split(_clean(F.col("text")), "\\n(?: ?\\n)+"), lambda p: _let(
        F.filter(F.split(p, "\\n"), lambda x: F.btrim(x) != ""),
        lambda ls: F.when(F.size(ls) > 1, F.concat(F.array(p), ls)).otherwise(F.array(p)))))
    read = docs.select("doc_id", F.posexplode(parts).alias("part", "text"))
    sized = read.select("doc_id", "part", _let(_words(F.col("text")), lambda w: F.when(worth(w), _bigrams(w))).alias("bigrams"))
    sized = sized.where("bigrams is not null").withColumn("n_bigrams", F.size("bigrams"))
    table = candidates(docs, templates, least)
    met = sized.join(F.broadcast(table), F.col("n_bigrams") == F.col("n"))
    scored = met.withColumn("found", F.filter(F.transform("templates", lambda t: F.struct(
        (2 * F.size(F.array_intersect("bigrams", t["bigrams"]))).alias("twice"),
        (F.col("n_bigrams") + F.size(t["bigrams"])).alias("both"), t["template"].alias("template"))),
        lambda s: 100 * s["twice"] >= least * s["both"]))
    best = F.aggregate("found", F.get("found", F.lit(0)), lambda a, s: F.when(s["twice"] * a["both"] > a["twice"] * s["both"], s).otherwise(a))
    return scored.where(F.size("found") > 0).select("doc_id", "part", "n_bigrams", best.alias("b")).select(
        "doc_id", "part", "n_bigrams", "b.template", (F.col("b.twice") / F.col("b.both")).alias("dice"))


def _sql_templates() -> str:
    return ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES.items())


ORACLE = f"""
with tw as (select name, regexp_extract_all(lower(txt), '[\\p{{L}}\\p{{N}}]+') as w from (values {_sql_templates()}) v(name, txt)),
tb as (select name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as tbi from tw),
cl as (select doc_id, regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') as c from documents),
par as (select doc_id, regexp_split_to_array(c, '\\n(?: ?\\n)+') as ps from cl),
parts as (select doc_id, flatten(list_transform(ps, lambda p: list_concat([p], case when len(list_filter(string_split(p, chr(10)),
              lambda x: trim(x) <> '')) > 1 then list_filter(string_split(p, chr(10)), lambda x: trim(x) <> '') else [] end))) as us from par),
units as (select doc_id, unnest(range(0, len(us))) as part, unnest(us) as u from parts),
uw as (select doc_id, part, regexp_extract_all(u, '[\\p{{L}}\\p{{N}}]+') as w from units),
ub as (select doc_id, part, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as ubi from uw where len(w) > 1),
hit as (select doc_id, part, len(ubi) as n_bigrams, name as template, 2 * len(list_intersect(ubi, tbi)) as twice, len(ubi) + len(tbi) as total
        from ub join tb on 100 * 2 * least(len(ubi), len(tbi)) >= {LEAST} * (len(ubi) + len(tbi)))
select doc_id, part::int as part, n_bigrams::int as n_bigrams, template, twice::double / total as dice
from (select *, row_number() over (partition by doc_id, part order by twice::double / total desc, template) as rn
      from hit where 100 * twice >= {LEAST} * total) where rn = 1
"""
