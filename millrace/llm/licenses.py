"""License phrases in texts: ordered signature rules behind a keyword filter. Built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.staging import stored

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases of the base labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

# License families as (label, keyword that every match and the spaces around it contain, names as patterns over words, versions).
FAMILIES = (
    ("agpl", " agpl ", ("agpl",), ("1 0", "3 0", "3")),
    ("agpl", "affero", ("(?:gnu )?affero general public licen[cs]e",), ("1 0", "3 0", "3")),
    ("lgpl", " lgpl ", ("lgpl",), ("2 0", "2 1", "2", "3 0", "3")),
    ("lgpl", "lesser", ("(?:gnu )?lesser general public licen[cs]e",), ("2 1", "3 0", "3")),
    ("lgpl", "library", ("(?:gnu )?library general public licen[cs]e",), ("2 0", "2")),
    ("gpl", " gpl ", ("(?:gnu )?gpl",), ("1 0", "1", "2 0", "2", "3 0", "3")),
    ("gpl", "general public", ("gnu general public licen[cs]e",), ("1 0", "1", "2 0", "2", "3 0", "3")),
    ("fdl", "documentation", ("gnu free documentation licen[cs]e",), ("1 1", "1 2", "1 3")),
    ("apache", "apache", ("apache(?: software)? licen[cs]e",), ("1 0", "1 1", "2 0", "2")),
    ("mpl", "mozilla", ("mozilla public licen[cs]e",), ("1 0", "1 1", "2 0", "2")),
    ("mpl", " mpl ", ("mpl",), ("1 1", "2 0", "2")),
    ("epl", "eclipse", ("eclipse public licen[cs]e",), ("1 0", "2 0")),
    ("epl", " epl ", ("epl",), ("1 0", "2 0")),
    ("cddl", " cddl ", ("cddl",), ("1 0", "1 1")),
    ("cddl", "common development", ("common development and distribution licen[cs]e",), ("1 0", "1 1")),
    ("cpl", "common public", ("common public licen[cs]e",), ("1 0",)),
    ("eupl", "european union", ("european union public licen[cs]e",), ("1 0", "1 1", "1 2")),
    ("eupl", " eupl ", ("eupl",), ("1 0", "1 1", "1 2")),
    ("osl", "open software", ("open software licen[cs]e",), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", ("academic free licen[cs]e",), ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", "artistic", ("(?:perl )?artistic licen[cs]e",), ("1 0", "2 0")),
    ("psf", "python", ("python software foundation licen[cs]e",), ("2",)),
    ("lppl", "latex", ("latex project public licen[cs]e",), ("1 0", "1 2", "1 3", "1 3c")),
    ("ms-pl", "microsoft public", ("microsoft public licen[cs]e",), ()),
    ("ms-rl", "microsoft reciprocal", ("microsoft reciprocal licen[cs]e",), ()),
    ("zpl", "zope", ("zope public licen[cs]e",), ("1 1", "2 0", "2 1")),
    ("qpl", "q public", ("q public licen[cs]e",), ("1 0",)),
    ("ofl", "open font", ("(?:sil )?open font licen[cs]e",), ("1 0", "1 1")),
    ("odbl", "open database", ("open database licen[cs]e",), ("1 0",)),
    ("mit", " mit licen", ("mit licen[cs]e",), ()),
    ("mit", " mit x11", ("mit x11 licen[cs]e",), ()),
    ("mit", " mit style", ("mit style licen[cs]e",), ()),
    ("x11", " x11 licen", ("x11 licen[cs]e",), ()),
    ("isc", " isc licen", ("isc licen[cs]e",), ()),
    ("zlib", " zlib ", ("zlib(?: libpng)? licen[cs]e",), ()),
    ("bsl", "boost", ("boost software licen[cs]e",), ("1 0",)),
    ("unlicense", "unlicense", ("(?:the )?unlicense",), ()),
    ("wtfpl", " wtfpl ", ("wtfpl",), ("2",)),
    ("postgresql", "postgresql", ("postgresql licen[cs]e",), ()),
    ("bsd-0", " 0bsd ", ("0bsd",), ()),
    ("bsd-2", " bsd ", ("bsd 2 clause", "2 clause bsd", "two clause bsd", "simplified bsd"), ()),
    ("bsd-3", " bsd ", ("bsd 3 clause", "3 clause bsd", "three clause bsd", "(?:new|modified|revised) bsd"), ()),
    ("bsd-4", " bsd ", ("bsd 4 clause", "4 clause bsd", "four clause bsd", "original bsd"), ()),
    ("bsd", " bsd ", ("bsd(?: style)? licen[cs]e",), ()),
    ("cc0", " cc0 ", ("cc0",), ("1 0",)),
    ("cc-by-nc-nd", "by nc nd", ("cc by nc nd",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "by nc sa", ("cc by nc sa",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "by nc", ("cc by nc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "by nd", ("cc by nd",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "by sa", ("cc by sa",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "cc by", ("cc by",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "commons", ("creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "commons", ("creative commons attribution non ?commercial share ?alike",), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "commons", ("creative commons attribution non ?commercial",), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "commons", ("creative commons attribution no ?deriv(?:ative)?s?(?: works)?",), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "commons", ("creative commons attribution share ?alike",), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "commons", ("creative commons attribution",), ("2 0", "2 5", "3 0", "4 0")),
    ("public-domain", "public domain", ("(?:released |placed )?(?:in|into|to) the public domain",), ()),
    ("all-rights-reserved", "rights reserved", ("all rights reserved",), ()),
)
# Sentences of license texts and of file headers as (label, keyword, pattern over words).
TEXTS = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "permission notice shall be included", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "to deal in the software", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("mit", "found in the license file", "use of this source code is governed by an mit style license that can be found in the license file"),
    ("bsl-1", "permission is hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("ofl", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("unicode", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of (?:the unicode )?data files and any associated documentation"),
    ("postgresql", "permission to use copy modify", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("isc", "permission to use copy modify", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", "permission to use copy modify", "permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose is hereby granted without fee"),
    ("ntp", "permission to use copy modify", "permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("isc", "the software is provided as is", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code", "redistributions of source code must retain the (?:above )?copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3", "to endorse or promote products", "neither the names? of(?: [^ ]+){1,8} nor the names of (?:its|their|any) contributors may be used to endorse or promote products"),
    ("bsd-3", "to endorse or promote products", "the names? of the (?:author|copyright holder)s? may not be used to endorse or promote products derived from this software"),
    ("bsd-4", "all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "found in the license file", "use of this source code is governed by a bsd style license that can be found in the license file"),
    ("bsd", "this software is provided by", "this software is provided by the (?:regents|authors?|copyright holders?)(?: and contributors)? as is and any express or implied warranties"),
    ("apache-2", "except in compliance with the license", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "www apache org licenses", "(?:https? )?www apache org licenses license 2 0"),
    ("apache-2", "software distributed under the license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", "contributor license agreements", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-1-1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("gpl", "this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this program is distributed in the hope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "gnu general public license", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl-2", "of the license", "published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3", "of the license", "published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2", "licenses for most software", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", "free copyleft license", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl", "this library is free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", "this library is distributed in the hope", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "general public license", "you should have received a copy of the gnu (?:lesser|library) general public license along with this library"),
    ("agpl", "affero general public license", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", "affero general public license", "you should have received a copy of the gnu affero general public license along with this program"),
    ("agpl-3", "cooperation with the community", "specifically designed to ensure cooperation with the community in the case of network server software"),
    ("gpl-classpath", "as a special exception", "as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("fdl", "permission is granted to copy", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", "this source code form is subject", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1-1", "the contents of this file are subject", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl", "a copy of the mpl was not", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("npl", "the contents of this file are subject", "the contents of this file are subject to the netscape public license"),
    ("cddl", "the contents of this file are subject", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpal", "the contents of this file are subject", "the contents of this file are subject to the common public attribution license"),
    ("spl", "the contents of this file are subject", "the contents of this file are subject to the sun public license"),
    ("epl", "this program and the accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "accompanying program is provided", "the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("cpl", "accompanying program is provided", "the accompanying program is provided under the terms of this common public license agreement"),
    ("ipl", "accompanying program is provided", "the accompanying program is provided under the terms of this ibm public license agreement"),
    ("eupl", "european union public licence", "you may not use this work except in compliance with the licen[cs]e(?: [^ ]+){0,12} european union public licence"),
    ("zlib", "this software is provided as is", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "permission is granted to anyone", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it"),
    ("zlib", "must not be misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "everyone is permitted to copy", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("gpl", "everyone is permitted to copy", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("cc0", "to the extent possible under law", "to the extent possible under law (?:the )?(?:author|person)s? (?:has|have|who associated cc0)(?: [^ ]+){0,8} waived all copyright"),
    ("cc0", "publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org licenses by", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons org licenses by sa", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nd", "creativecommons org licenses by nd", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", "creativecommons org licenses by nc", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc-by", "this work is licensed under a", "this work is licensed under a creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-sa", "this work is licensed under a", "this work is licensed under a creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("cc-by-nc", "this work is licensed under a", "this work is licensed under a creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e"),
    ("artistic", "the intent of this document is", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2", "this license establishes the terms", "this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("perl", "under the same terms as perl", "(?:you can redistribute it and or modify it )?under the same terms as perl(?: itself)?"),
    ("ruby", "under the same terms as ruby", "(?:you can redistribute it and or modify it )?under the same terms as ruby(?: itself)?"),
    ("php-3", "subject to version 3", "this source file is subject to version 3 01? of the php license"),
    ("zend", "subject to version 2", "this source file is subject to version 2 00 of the zend license"),
    ("psf", "psf is making python", "psf is making python available to licensee on an as is basis"),
    ("psf", "python software foundation", "this license agreement is between the python software foundation psf and the individual or organization"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ijg", "independent jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("curl", "permission to use copy modify", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("x11", "x consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("json", "shall be used for good not evil", "the software shall be used for good not evil"),
    ("beerware", "buy me a beer", "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("lppl", "latex project public license", "this work may be distributed and or modified under the conditions of the latex project public license"),
    ("ms-pl", "if you use the software", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("sspl", "server side public license", "server side public license"),
    ("busl", "business source license", "business source license"),
    ("elastic-2", "elastic license", "elastic license (?:version )?(?:2 0|2|v2)"),
    ("commons-clause", "by the licensor under the license", "the software is provided to you by the licensor under the license as defined below subject to the following condition"),
    ("commons-clause", "commons clause", "commons clause license condition"),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict|free trial|internal use) licen[cs]e"),
    ("odc-by", "open data commons", "open data commons attribution licen[cs]e"),
    ("pddl", "open data commons", "open data commons public domain dedication and licen[cs]e"),
    ("rail", "responsible ai licen", "(?:open )?responsible ai licen[cs]es?"),
    ("proprietary", "proprietary and confidential", "(?:this (?:file|software|document) is )?proprietary and confidential"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "permission of the copyright owner", "(?:reproduced|distributed)(?: [^ ]+){0,12} without the prior written permission of the copyright owner"),
    ("public-domain", "dedicated to the public domain", "(?:has been |is hereby )?dedicated to the public domain"),
    ("us-government", "work of the united states", "this (?:software|work) is a work of the united states government"),
)
TEXT_PRIORITY = 2
#: fixed values: (words before a name, words after its version, added to the label, priority: smaller wins)
FORMS = (
    ("spdx license identifier ", "", "", 1),
    ("(?:licensed|released|distributed|published|available) under (?:the )?(?:terms of (?:the )?)?", " or (?:any )?later(?: version)?", "-or-later", 2),
    ("", " or (?:any )?later(?: version)?", "-or-later", 3),
    ("(?:licensed|released|distributed|published|available) under (?:the )?(?:terms of (?:the )?)?", "", "", 4),
    ("", "", "", 6),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str
    base: bool = False


def _version_label(version: str) -> str:
    parts = version.split()
    return "-".join(parts[:-1] if parts[-1] == "0" and len(parts) > 1 else parts)


def rules() -> list[Rule]:
    """All rules in order: the base phrases, the sentences of ``TEXTS``, then the names of ``FAMILIES``.

    Phrases, sentences and names are written by hand, some 170 patterns. From the names come those with a version and in the
    forms in which a license is cited, which are generated.
    """
    bounded = lambda p: f"(?i)(?<![^ ])(?:{p})(?![^ ])"
    out = [Rule(label, 0, f" {phrase} ", bounded(phrase), True) for label, phrase in BASE]
    out += [Rule(label, TEXT_PRIORITY, keyword, bounded(pattern)) for label, keyword, pattern in TEXTS]
    for (label, keyword, names, versions), (before, after, suffix, priority) in product(FAMILIES, FORMS):
        for name in names:
            for version in versions:
                full = f"{before}{name}(?: international)? (?:version |v )?{'v?'}{version}{after}"
                out.append(Rule(f"{label}-{_version_label(version)}{suffix}", priority, keyword, bounded(full)))
            if not suffix:  # without a version, after those with one
                out.append(Rule(label, priority + 1, keyword, bounded(before + name)))
    return out


def _rule_table(spark: SparkSession, ordered: list[Rule]) -> DataFrame:
    rows = [(i, r.label, r.priority, r.keyword, r.pattern, r.base) for i, r in enumerate(ordered)]
    return spark.createDataFrame(rows, "rule int, label string, priority int, keyword string, pattern string, base boolean")


def detections(normal: DataFrame, ordered: list[Rule]) -> DataFrame:
    """(row, rule, label, priority, base, start, stop) of every match in ``normal`` (row, norm, keywords).

    start and stop are word numbers. Rules reach a text only if their keyword stands in it. A match's place is the
    number of spaces in what precedes it, summed over the pieces between matches.
    """
    spaces = lambda c: F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))
    table = F.broadcast(_rule_table(normal.sparkSession, ordered))  # fixed size
    tried = normal.select("row", "norm", F.explode("keywords").alias("keyword")).join(table, "keyword").where(F.regexp_like("norm", F.col("pattern")))
    places = tried.select("row", "rule", "label", "priority", "base", F.posexplode(F.arrays_zip(
        F.split("norm", F.col("pattern"), -1).alias("piece"), F.regexp_extract_all("norm", F.col("pattern"), F.lit(0)).alias("match"))).alias("i", "x"))
    places = places.where(F.col("x.match").isNotNull()).withColumns({"before": spaces(F.col("x.piece")), "inside": spaces(F.col("x.match"))}).drop("x")
    order = Window.partitionBy("row", "rule").orderBy("i")
    start = F.sum("before").over(order) + F.coalesce(F.sum("inside").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return places.select("row", "rule", "label", "priority", "base", start.alias("start"), (start + F.col("inside") + 1).alias("stop"))


def resolved(found: DataFrame) -> DataFrame:
    """Detections that stand: those inside another go (of equal ones all but the first by priority and rule), then of two
    neighbours that still overlap the one of less priority, or the later one."""
    order = Window.partitionBy("row").orderBy("start", F.col("stop").desc(), "priority", "rule")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = found.withColumn("_reach", reach).where("_reach IS NULL OR _reach < stop").drop("_reach")
    before = F.lag(F.struct("stop", "priority")).over(order)
    after = F.lead(F.struct("start", "priority")).over(order)
    rows = rows.withColumns({"_before": before, "_after": after})
    lost = ((F.col("_before.stop") > F.col("start")) & (F.col("_before.priority") <= F.col("priority"))) | (
        (F.col("_after.start") < F.col("stop")) & (F.col("_after.priority") < F.col("priority")))
    return rows.where(~F.coalesce(lost, F.lit(False))).drop("_before", "_after")


def license_scan(docs: DataFrame, ordered: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of ``docs``.

    Words are runs of ASCII letters, digits and non-ASCII characters. n_base counts all places of the base phrases,
    also those inside other detections, and their labels always stay; labels adds those of the rules that stand
    after suppression. score is the share of the words that these detections cover. Null and empty
    texts have no words, empty labels and score 0; repeated rows and null ids give rows of their own; other
    columns are ignored. Texts without a keyword are not searched; of the others only matches are shuffled, so a very
    long text or a phrase that every text shares makes no large group but its own matches.
    """
    ordered = rules() if ordered is None else ordered
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("row"), F.trim(F.regexp_replace(text, SEPARATORS, " ")).alias("norm"))
    words = sorted({r.keyword for r in ordered})
    rows = rows.withColumns({
        "n_words": F.when(F.col("norm") == "", F.lit(0)).otherwise(
            F.char_length("norm") - F.char_length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) + 1).cast("long"),
        "_small": F.concat(F.lit(" "), F.lower("norm"), F.lit(" "))})
    rows = rows.withColumn("keywords", F.array_compact(F.array(*[F.when(F.contains(F.col("_small"), F.lit(w)), F.lit(w)) for w in words])))
    rows = stored(rows.select("doc_id", "row", "n_words", "keywords", F.when(F.size("keywords") > 0, F.col("norm")).alias("norm")), "license-rows")
    found = stored(detections(rows.where("norm IS NOT NULL").select("row", "norm", "keywords"), ordered), "license-detections")
    base = found.where("base").groupBy("row").agg(
        F.count("*").alias("n_base"), F.min("start").cast("long").alias("first_word"), F.max("start").cast("long").alias("last_word"),
        F.collect_set("label").alias("base_set"))
    kept = resolved(found)
    # starts and stops both rise, so a detection covers what lies before the next one's start
    upto = F.least("stop", F.coalesce(F.lead("start").over(Window.partitionBy("row").orderBy("start")), F.col("stop")))
    method = kept.withColumn("covered", upto - F.col("start")).groupBy("row").agg(F.sum("covered").alias("covered"), F.collect_set("label").alias("set"))
    none = F.array().cast("array<string>")
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    out = rows.select("doc_id", "row", "n_words").join(base, "row", "left").join(method, "row", "left")
    base_set, method_set = F.coalesce("base_set", none), F.coalesce("set", none)
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        joined(base_set).alias("base_labels"), joined(F.array_union(base_set, method_set)).alias("labels"),
        F.coalesce(F.col("covered") / F.col("n_words"), F.lit(0.0)).alias("score"))
