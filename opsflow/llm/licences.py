"""Licence scans by sentence rules, in DataFrame functions only.

Comment marks and list marks at line starts are taken off, wrapped lines are
joined (a line break stays a possible end of a sentence), blank lines and
sentence ends cut.  Sentences are normalised (lower case, spelling variants, no
punctuation, single blanks, numbers apart) and looked up among the known licence
sentences, which gives an identifier and a version.  Runs of identifiers are
then matched against the licence rules in order; a rule uses up what it matched,
so a full licence text is not reported again by a shorter rule, and an unknown
sentence between two known ones parts a run.

Only texts with a word of ``hint(sentences)`` are cut; every known sentence
holds one of these words, so no match is lost.

Defined results: a null or empty text, or one without licence sentences, has
empty lists; sentences that hold the word license but are not known are
counted; repeated rows are reported row by row; null ids stay null; very long
texts are read whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import need

# fixed values: identifiers and published licence sentences (0 stands for any number)
SENTENCES = (
    ("gpl_ref", "This work is licensed under the GNU General Public License, version 0."),
    ("gpl_ref", "Licensed under the GNU General Public License, version 0."),
    ("free_software", "This program is free software:"),
    ("free_software", "This library is free software:"),
    ("free_software", "This file is free software:"),
    ("free_software", "This software is free software:"),
    ("gpl_free", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License as published by the Free Software Foundation;"),
    ("gpl_terms", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
     " the Free Software Foundation,"),
    ("gpl_only", "you can redistribute it and/or modify it under the terms of the GNU General Public License version 0 as"
     " published by the Free Software Foundation."),
    ("gpl_only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License version 0 as published by the Free Software Foundation."),
    ("lgpl_free", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
     " General Public License as published by the Free Software Foundation;"),
    ("lgpl_terms", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
     " published by the Free Software Foundation,"),
    ("agpl_terms", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
     " published by the Free Software Foundation,"),
    ("or_later", "either version 0 of the License, or (at your option) any later version."),
    ("gpl_hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
     " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl_hope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
     " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl_see", "See the GNU General Public License for more details."),
    ("lgpl_see", "See the GNU Lesser General Public License for more details."),
    ("agpl_see", "See the GNU Affero General Public License for more details."),
    ("mit_ref", "Released under the MIT License."),
    ("mit_ref", "Licensed under the MIT License."),
    ("mit_ref", "This project is licensed under the MIT License."),
    ("mit_title", "MIT License"),
    ("mit_title", "The MIT License (MIT)"),
    ("mit_grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
     " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
     " persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit_notice", "The above copyright notice and this permission notice shall be included in all copies or substantial"
     " portions of the Software."),
    ("as_is", "The software is provided \"as is\", without warranty of any kind, express or implied."),
    ("as_is", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited"
     " to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("mit_liability", "In no event shall the authors or copyright holders be liable for any claim, damages or other liability,"
     " whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use"
     " or other dealings in the software."),
    ("apache_ref", "Licensed under the Apache License, Version 0."),
    ("apache_ref", "This work is licensed under the Apache License, Version 0."),
    ("apache_grant", "Licensed under the Apache License, Version 0 (the \"License\"); you may not use this file except in"
     " compliance with the License."),
    ("apache_comply", "You may not use this file except in compliance with the License."),
    ("apache_copy", "You may obtain a copy of the License at"),
    ("apache_url", "http://www.apache.org/licenses/LICENSE-0"),
    ("apache_url", "https://www.apache.org/licenses/LICENSE-0"),
    ("apache_unless", "Unless required by applicable law or agreed to in writing, software distributed under the License is"
     " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache_see", "See the License for the specific language governing permissions and limitations under the License."),
    ("cc_by_nc_ref", "Licensed under CC BY-NC 0."),
    ("cc_by_ref", "Licensed under CC BY 0."),
    ("cc_by_sa_ref", "Licensed under CC BY-SA 0."),
    ("bsd_grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
     " the following conditions are met:"),
    ("bsd_source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
     " following disclaimer."),
    ("bsd_binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
     " following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd_names", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
     " products derived from this software without specific prior written permission."),
    ("bsd_as_is", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied"
     " warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose"
     " are disclaimed."),
    ("bsd_liability", "In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental,"
     " special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services;"
     " loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in"
     " contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this"
     " software, even if advised of the possibility of such damage."),
    ("isc_grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
     " granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc_as_is", "The software is provided \"as is\" and the author disclaims all warranties with regard to this software"
     " including all implied warranties of merchantability and fitness."),
    ("isc_liability", "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any"
     " damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other"
     " tortious action, arising out of or in connection with the use or performance of this software."),
    ("mpl_ref", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 0."),
    ("mpl_copy", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/0/."),
    ("mpl_copy", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/0/."),
    ("boost_ref", "Distributed under the Boost Software License, Version 0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
# fixed values: licence rules in order; each is a run of sentence identifiers
RULES = (
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is", "bsd_liability")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is", "bsd_liability")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("GPL-or-later", ("free_software", "gpl_terms", "or_later", "gpl_hope", "gpl_see")),
    ("GPL-or-later", ("free_software", "gpl_terms", "or_later")),
    ("GPL-or-later", ("gpl_free", "or_later", "gpl_hope", "gpl_see")),
    ("GPL-or-later", ("gpl_free", "or_later")),
    ("LGPL-or-later", ("free_software", "lgpl_terms", "or_later", "gpl_hope", "lgpl_see")),
    ("LGPL-or-later", ("free_software", "lgpl_terms", "or_later")),
    ("LGPL-or-later", ("lgpl_free", "or_later", "gpl_hope", "lgpl_see")),
    ("LGPL-or-later", ("lgpl_free", "or_later")),
    ("AGPL-or-later", ("free_software", "agpl_terms", "or_later", "gpl_hope", "agpl_see")),
    ("AGPL-or-later", ("free_software", "agpl_terms", "or_later")),
    ("GPL", ("free_software", "gpl_only")),
    ("MIT", ("mit_grant", "mit_notice", "as_is", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice", "as_is")),
    ("MIT", ("mit_notice", "as_is")),
    ("ISC", ("isc_grant", "isc_as_is", "isc_liability")),
    ("ISC", ("isc_grant",)),
    ("Apache", ("apache_grant", "apache_copy", "apache_url", "apache_unless", "apache_see")),
    ("Apache", ("apache_grant", "apache_copy", "apache_url")),
    ("Apache", ("apache_grant",)),
    ("Apache", ("apache_ref", "apache_comply")),
    ("Apache", ("apache_ref",)),
    ("MPL", ("mpl_ref", "mpl_copy")),
    ("MPL", ("mpl_ref",)),
    ("GPL", ("gpl_only",)),
    ("GPL", ("gpl_ref",)),
    ("MIT", ("mit_ref",)),
    ("MIT", ("mit_title",)),
    ("CC-BY-NC", ("cc_by_nc_ref",)),
    ("CC-BY-SA", ("cc_by_sa_ref",)),
    ("CC-BY", ("cc_by_ref",)),
    ("BSL", ("boost_ref",)),
    ("Unlicense", ("unlicense",)),
)
# fixed values: comment and list marks at line starts
MARKS = (r"/\*+", r"\*+/", r"//+", r"\*+", r"#+", r"--+", r";+", r"<!--", r"%+", r"(?:dnl|rem)(?=\s)", r"[(]?[0-9]{1,2}[.)](?=[ \t]+\S)",
         r"[(]?[a-z][.)](?=[ \t]+\S)", r"[•·o-](?=[ \t]+\S)")
NUMBER = r"[0-9]+(?:\.[0-9]+)*"
#: Signs of the normalised text: an end of a sentence, a line break.
END, BREAK = "\u0001", "\u0002"
UNKNOWN, OTHER = "?", "-"
SEQUENCE = "array<struct<id:string,version:string>>"


def hint(sentences: tuple = SENTENCES) -> str:
    """Pattern of a few words, at least one of which stands in every known sentence; long words first, as prose has fewer
    of those."""
    left, words = [set(known_form(s).split()) for _, s in sentences], []
    while left:
        count = Counter(w for s in left for w in s if not w[0].isdigit())
        words.append(min(count, key=lambda w: (len(w) < 7, -count[w], -len(w), w)))
        left = [s for s in left if words[-1] not in s]
    return "(?iu)" + "|".join(w.replace("licens", "licen[cs]") for w in words)


def known_form(sentence: str) -> str:
    """What ``normalise`` makes of one whole sentence."""
    words = re.sub(r"[^\w.]+|_+", " ", sentence.lower().replace("licenc", "licens"))
    return " ".join(re.sub(r"\.(?![0-9])|(?<![0-9])\.", "", words).split())


def normalise(text: Column) -> Column:
    """Lower case, one spelling, words and numbers only, single blanks; ``END`` after a sentence, ``BREAK`` for a line break."""
    def put(column: Column, pattern: str, by: str) -> Column:
        return F.regexp_replace(column, F.lit(pattern), F.lit(by))

    out = put(F.concat(F.lit("\n"), text, F.lit("\n\n")), r"\r\n?|[\f\u000B\u0085\u2028\u2029\u0001\u0002]", "\n")
    out = put(out, r"(?i)(?<=\n)(?:[ \t]*+(?:" + "|".join(MARKS) + "))++", " ")
    out = put(out, r"(?:\*/|-->)[ \t]*+(?=\n)", "")
    out = put(out, r"(?i)(?<![\s(]v)[.!?:](?=\s)|[,;](?=\s+either\s+version\s)|\n[ \t]*+\n\s*+", END)
    out = F.replace(put(out, r"\n", BREAK), F.lit("\u0130"), F.lit("i"))
    out = put(F.replace(F.lower(out), F.lit("licenc"), F.lit("licens")), r"[^\p{L}\p{M}\p{N}.\u0001\u0002]+", " ")
    out = put(put(out, r"\.(?![0-9])|(?<![0-9])\.", ""), " {2,}", " ")
    out = put(out, r"(?<![ \u0001\u0002])[ \u0002]*+\u0001[ \u0001\u0002]*+", END)
    return put(F.concat(F.lit(END), out), r"(?<![ \u0002])[ ]*+\u0002[ \u0002]*+", BREAK)


def sentence_ids(text: Column, sentences: tuple = SENTENCES) -> Column:
    """Array of structs (``id``, ``version``), in order: known sentences get their identifier, others that hold the word
    license ``?``, the rest ``-``.  Words of a known sentence may be parted by line breaks; it begins and ends at a cut or
    a line break."""
    forms = {known_form(s): name for name, s in sentences}
    known = F.create_map(*[F.lit(x) for pair in forms.items() for x in pair])
    longest = sorted(forms, key=lambda f: (-len(f), f))
    words = "|".join(f"[ {BREAK}]".join(NUMBER if w == "0" else re.escape(w) for w in f.split()) for f in longest)
    marked = F.regexp_replace(normalise(text), F.lit(f"(?<=[{END}{BREAK}])(?:{words})(?=[{END}{BREAK}])"), F.lit(f"{END}=$0{END}"))
    pieces = F.transform(F.split(marked, END, -1), lambda x: F.trim(F.replace(x, F.lit(BREAK), F.lit(" "))))

    def look(s: Column) -> Column:
        hit = s.startswith("=")
        body = F.when(hit, F.substr(s, F.lit(2))).otherwise(s)
        key = F.regexp_replace(body, rf"(?<![^ ]){NUMBER}(?![^ ])", "0")
        version = F.regexp_extract(body, rf"(?:version|license|mpl|v|by|sa|nc) ({NUMBER})(?![^ ])", 1)
        other = F.when(s.contains("license"), UNKNOWN).when(s.rlike(r"\p{L}"), OTHER)
        return F.struct(F.when(hit, F.try_element_at(known, key)).otherwise(other).alias("id"),
                        F.when(hit, version).otherwise("").alias("version"))

    ids = F.filter(F.transform(pieces, look), lambda x: x["id"].isNotNull())
    return F.when(text.rlike(hint(sentences)), ids).otherwise(F.array().cast(SEQUENCE))


def told(ids: Column) -> Column:
    """Known sentences and unknown ones about a license."""
    return F.filter(ids, lambda x: x["id"] != OTHER)


def apply_rules(ids: Column, rules: tuple = RULES) -> Column:
    """Licence names in the order of the rules, with the version where a sentence has one."""
    sequence = F.concat(F.lit(","), F.array_join(F.transform(ids, lambda x: F.concat(x["id"], F.lit(":"), x["version"])), ","), F.lit(","))
    table = F.array(*[F.struct(F.lit(name).alias("name"),
                               F.lit("(?<=,)" + ",".join(f"{i}:([0-9.]*)" for i in run) + "(?=,)").alias("pattern"),
                               F.lit(len(run)).alias("size")) for name, run in rules])
    empty = F.array().cast("array<string>")

    def step(s: Column, r: Column) -> Column:
        runs = F.regexp_extract_all(s["left"], r["pattern"], F.lit(0))
        names = F.transform(runs, lambda m: F.concat_ws("-", r["name"], F.nullif(F.regexp_extract(m, "([0-9][0-9.]*)", 1), F.lit(""))))
        return F.struct(F.regexp_replace(s["left"], r["pattern"], "").alias("left"), F.concat(s["names"], names).alias("names"))

    start = F.struct(sequence.alias("left"), empty.alias("names"))
    return F.when(F.exists(ids, lambda x: ~x["id"].isin(UNKNOWN, OTHER)), F.aggregate(table, start, step, lambda s: s["names"])).otherwise(empty)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: tuple = SENTENCES,
         rules: tuple = RULES) -> DataFrame:
    """Per row: ``id``, ``sentences`` (identifier and version, in order), ``licences`` (distinct, sorted) and
    ``n_unknown`` (sentences about a license that are not known)."""
    need(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", sentence_ids(F.col("text"), sentences).alias("sentences"))
    return rows.select("id", told(F.col("sentences")).alias("sentences"), F.array_sort(F.array_distinct(apply_rules(F.col("sentences"), rules))).alias("licences"),
                       F.size(F.filter("sentences", lambda x: x["id"] == UNKNOWN)).alias("n_unknown"))
