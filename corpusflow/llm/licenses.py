"""License scan by ordered signature rules.

A text becomes its lower-cased words with one blank between them. Rules are regular expressions over
that string, each behind a keyword that must occur before the expression runs. Detections
are word intervals with a priority; one is suppressed if an interval of higher priority contains
it, or a larger one of its own priority. The three base phrases are rules that are never suppressed.

Everything happens within the row: no shuffle, whatever the number of detections.

Defined results: null, empty and word-less texts have no words and no detections (empty labels, null
first and last word, score 0); repeated rows get equal results; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fixed, prepare, word_string

# The contract's base phrases and labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
BASE_PRIORITY = 5

# Families: label, the name as it stands in running text, keyword, SPDX identifiers (as words).
FAMILIES = (
    ("mit", "mit", "mit", "mit"),
    ("mit-0", "mit no attribution", "no attribution", "mit 0"),
    ("x11", "x11", "x11", "x11"),
    ("apache-2.0", "apache(?: software)?(?: license)?(?: version| v)? 2(?: 0)?", "apache", "apache 2 0"),
    ("apache-1.1", "apache(?: software)?(?: license)?(?: version| v)? 1 1", "apache", "apache 1 1"),
    ("bsd-2-clause", "(?:simplified bsd|2 clause bsd|bsd 2 clause)", "bsd", "bsd 2 clause"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|3 clause bsd|bsd 3 clause)", "bsd", "bsd 3 clause"),
    ("bsd", "bsd(?: style)?", "bsd", "bsd"),
    ("0bsd", "(?:zero clause bsd|bsd zero clause|0 clause bsd|bsd 0 clause)", "clause", "0bsd"),
    ("gpl-2.0", "(?:gnu )?general public license(?: version| v)? ?2(?: 0)?", "general public", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "(?:gnu )?general public license(?: version| v)? ?3(?: 0)?", "general public", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "(?:gnu )?(?:lesser|library) general public license(?: version| v)? ?2(?: [01])?", "general public", "lgpl 2 [01](?: only| or later)?"),
    ("lgpl-3.0", "(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?", "lesser general", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", "(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?", "affero general", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "(?:gnu )?free documentation", "free documentation", "gfdl 1 [1-3](?: only| or later)?"),
    ("mpl-1.1", "mozilla public license(?: version| v)? 1 1", "mozilla public", "mpl 1 1"),
    ("mpl-2.0", "mozilla public license(?: version| v)? 2(?: 0)?", "mozilla public", "mpl 2 0"),
    ("epl-1.0", "eclipse public license(?: version| v)? 1(?: 0)?", "eclipse public", "epl 1 0"),
    ("epl-2.0", "eclipse public license(?: version| v)? 2(?: 0)?", "eclipse public", "epl 2 0"),
    ("cddl-1.0", "common development and distribution", "common development", "cddl 1 [01]"),
    ("cpl-1.0", "common public", "common public", "cpl 1 0"),
    ("artistic-2.0", "artistic(?: license)?(?: version| v)? ?(?:2 0)?", "artistic", "artistic [12] 0"),
    ("boost-1.0", "boost software", "boost software", "bsl 1 0"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib(?: libpng)?", "zlib", "zlib"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public", "you want to public", "wtfpl"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("python-2.0", "python software foundation", "python software", "(?:python|psf) 2 0"),
    ("php-3.01", "php", "php", "php 3 01"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("osl-3.0", "open software", "open software", "osl 3 0"),
    ("afl-3.0", "academic free", "academic free", "afl 3 0"),
    ("eupl-1.2", "european union public", "european union", "eupl 1 [12]"),
    ("ms-pl", "microsoft public", "microsoft public", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", "ms rl"),
    ("ofl-1.1", "(?:sil )?open font", "open font", "ofl 1 1"),
    ("odbl-1.0", "open (?:data commons open )?database", "database", "odbl 1 0"),
    ("cc0-1.0", "creative commons zero(?: 1 0)?(?: universal)?", "creative commons", "cc0 1 0"),
    ("cc-by", "creative commons attribution(?: [1-4] [05])?", "creative commons", "cc by [1-4] [05]"),
    ("cc-by-sa", "creative commons attribution share ?alike(?: [1-4] [05])?", "creative commons", "cc by sa [1-4] [05]"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?", "creative commons", "cc by nd [1-4] [05]"),
    ("cc-by-nc", "creative commons attribution non ?commercial(?: [1-4] [05])?", "creative commons", "cc by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?", "creative commons", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?", "creative commons", "cc by nc nd [1-4] [05]"),
)

# Forms a family's name takes: expression, priority, confidence, keyword of its own.
FORMS = (
    ("(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{name}(?: public)?(?: licen[sc]e)?", 3, 0.95, " under "),
    ("{name}(?: public)? licen[sc]e(?: version [0-9]+(?: [0-9]+)?)?", 2, 0.8, "licen"),
    ("licen[sc]e {name}", 2, 0.7, "licen"),
    ("(?:see|copy of|conditions of|terms of) (?:the )?{name} licen[sc]e", 3, 0.9, "licen"),
)
SPDX_FORMS = (
    ("spdx license identifier {spdx}", 4, 1.0, "spdx"),
    ("(?:opensource org licenses|spdx org licenses|creativecommons org licenses) {spdx}", 4, 1.0, " org licenses"),
)

# Names by abbreviation, with a version or a clause that tells a license from the bare word: label, expression, keyword.
# They stand alone ("GPLv3", "Apache-2.0") or behind "under".
IDENTIFIERS = (
    ("gpl-1.0", "(?:gnu )?gpl ?(?:version|v)? ?1(?: 0)?(?: only| or later| or newer)?", "gpl"),
    ("gpl-2.0", "(?:gnu )?gpl ?(?:version|v)? ?2(?: 0)?(?: only| or later| or newer)?", "gpl"),
    ("gpl-3.0", "(?:gnu )?gpl ?(?:version|v)? ?3(?: 0)?(?: only| or later| or newer)?", "gpl"),
    ("lgpl-2.0", "(?:gnu )?lgpl ?(?:version|v)? ?2(?: 0)?(?: only| or later| or newer)?", "lgpl"),
    ("lgpl-2.1", "(?:gnu )?lgpl ?(?:version|v)? ?2 1(?: only| or later| or newer)?", "lgpl"),
    ("lgpl-3.0", "(?:gnu )?lgpl ?(?:version|v)? ?3(?: 0)?(?: only| or later| or newer)?", "lgpl"),
    ("agpl-1.0", "(?:gnu )?agpl ?(?:version|v)? ?1(?: 0)?(?: only| or later)?", "agpl"),
    ("agpl-3.0", "(?:gnu )?agpl ?(?:version|v)? ?3(?: 0)?(?: only| or later| or newer)?", "agpl"),
    ("gpl-2.0-with-classpath-exception", "gpl ?(?:version|v)? ?2(?: 0)? with (?:the )?classpath exception", "classpath exception"),
    ("gfdl", "(?:gnu )?(?:gfdl|fdl) ?(?:version|v)? ?1 [1-3](?: only| or later)?", "fdl"),
    ("mpl-1.0", "mpl ?(?:version|v)? ?1 0", "mpl"),
    ("mpl-1.1", "mpl ?(?:version|v)? ?1 1", "mpl"),
    ("mpl-2.0", "mpl ?(?:version|v)? ?2(?: 0)?", "mpl"),
    ("epl-1.0", "epl ?(?:version|v)? ?1 ?0", "epl"),
    ("epl-2.0", "epl ?(?:version|v)? ?2 ?0", "epl"),
    ("eupl-1.1", "eupl ?(?:version|v)? ?1 1", "eupl"),
    ("eupl-1.2", "eupl ?(?:version|v)? ?1 2(?: or later)?", "eupl"),
    ("cddl-1.0", "cddl ?(?:version|v)? ?1 0", "cddl"),
    ("cddl-1.1", "cddl ?(?:version|v)? ?1 1", "cddl"),
    ("cpl-1.0", "cpl ?(?:version|v)? ?1 0", "cpl"),
    ("osl-3.0", "osl ?(?:version|v)? ?3 0", "osl"),
    ("afl-3.0", "afl ?(?:version|v)? ?3 0", "afl"),
    ("ofl-1.1", "(?:sil )?ofl ?(?:version|v)? ?1 1", "ofl"),
    ("odbl-1.0", "odbl ?(?:version|v)? ?(?:1 0)?", "odbl"),
    ("pddl-1.0", "pddl ?(?:version|v)? ?(?:1 0)?", "pddl"),
    ("sspl-1.0", "sspl ?(?:version|v)? ?(?:1(?: 0)?)?", "sspl"),
    ("busl-1.1", "busl ?(?:version|v)? ?1 1", "busl"),
    ("busl-1.1", "bsl ?(?:version|v)? ?1 1", "bsl"),
    ("boost-1.0", "bsl ?(?:version|v)? ?1 0", "bsl"),
    ("apache-1.0", "apache ?(?:version|v)? ?1 0", "apache"),
    ("apache-1.1", "apache ?(?:version|v)? ?1 1", "apache"),
    ("apache-2.0", "apache ?(?:version|v)? ?2 0", "apache"),
    ("apache-2.0", "apache ?v2(?: 0)?", "apache"),
    ("apache-2.0", "asl ?(?:version|v)? ?2 0", "asl"),
    ("artistic-1.0", "artistic ?(?:version|v)? ?1 0", "artistic"),
    ("artistic-2.0", "artistic ?(?:version|v)? ?2 0", "artistic"),
    ("0bsd", "0bsd", "0bsd"),
    ("bsd-1-clause", "(?:bsd 1 clause|1 clause bsd|one clause bsd)", "clause"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|two clause bsd|bsd two clause)", "clause"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|three clause bsd|bsd three clause)", "clause"),
    ("bsd-3-clause-clear", "bsd 3 clause clear", "clause clear"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd license)", "bsd"),
    ("cc0-1.0", "cc0(?: ?v?1 0)?(?: universal)?", "cc0"),
    ("cc0-1.0", "cc zero(?: 1 0)?", "cc zero"),
    ("cc-by", "cc by(?: v?[1-4] [05])?", "cc by"),
    ("cc-by-sa", "cc by sa(?: v?[1-4] [05])?", "cc by sa"),
    ("cc-by-nd", "cc by nd(?: v?[1-4] [05])?", "cc by nd"),
    ("cc-by-nc", "cc by nc(?: v?[1-4] [05])?", "cc by nc"),
    ("cc-by-nc-sa", "cc by nc sa(?: v?[1-4] [05])?", "cc by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd(?: v?[1-4] [05])?", "cc by nc nd"),
    ("ms-pl", "ms pl", "ms pl"),
    ("ms-rl", "ms rl", "ms rl"),
    ("mit-0", "mit 0", "mit 0"),
    ("wtfpl", "wtfpl ?(?:version|v)? ?(?:[12](?: 0)?)?", "wtfpl"),
    ("unlicense", "the unlicense", "unlicense"),
    ("python-2.0", "psf(?: license)? ?(?:version|v)? ?2(?: 0)?", "psf"),
    ("upl-1.0", "upl ?(?:version|v)? ?1 0", "upl"),
    ("ncsa", "(?:uiuc|university of illinois) ncsa(?: open source)?", "ncsa"),
    ("cecill-2.1", "cecill ?(?:version|v)? ?2 1", "cecill"),
)
IDENTIFIER_FORMS = (
    ("{name}", 2, 0.8, ""),
    ("(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)?", 3, 0.95, " under "),
)

# Notices without a family's name: label, expression, keyword, priority, confidence.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby", 4, 1.0),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use", 4, 1.0),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use", 4, 1.0),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse", "neither the name", 4, 1.0),
    ("gpl", "this program is free software you can redistribute it", "free software", 4, 1.0),
    ("gpl", "either version [0-9] of the license or at your option any later version", "at your option", 3, 0.9),
    ("apache-2.0", "you may not use this file except in compliance with the license", "in compliance with", 4, 1.0),
    ("apache-2.0", "apache org licenses license 2 0", "apache org", 4, 1.0),
    ("gpl", "gnu org licenses", "gnu org", 3, 0.9),
    ("zlib", "this software is provided as is without any express or implied warranty", "as is without", 3, 0.8),
    ("unlicense", "free and unencumbered software released into the public domain", "unencumbered", 4, 1.0),
    ("public-domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", "public domain", 3, 0.9),
    ("public-domain", "public domain", "public domain", 1, 0.4),
    ("proprietary", "all rights reserved", "all rights", 1, 0.5),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary", 2, 0.8),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright", 1, 0.4),
    ("gpl", "gnu gpl", "gnu gpl", 2, 0.7),
    ("cc", "creative commons", "creative commons", 1, 0.5),
    ("gpl", "gnu general public license", "gnu general", 2, 0.8),
    ("lgpl", "gnu lesser general public license", "gnu lesser", 2, 0.8),
    ("agpl", "gnu affero general public license", "gnu affero", 2, 0.8),
    ("mit", "the above copyright notice and this permission notice shall be included in", "this permission notice", 4, 1.0),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "as is without warranty", 3, 0.8),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is", "permission is hereby", 4, 1.0),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source", 4, 1.0),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "redistributions in binary", 4, 1.0),
    ("bsd", "this software is provided by the copyright holders and contributors as is", "holders and contributors", 4, 0.9),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising materials", 4, 1.0),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor license agreements", "contributor license", 4, 1.0),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", "applicable law or agreed", 4, 0.9),
    ("apache-2.0", "see the license for the specific language governing permissions and limitations", "specific language governing", 4, 0.9),
    ("apache-2.0", "grant of patent license subject to the terms and conditions of this license each contributor hereby grants", "grant of patent license", 4, 0.9),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", "free software foundation", 4, 1.0),
    ("gpl", "you should have received a copy of the gnu general public license", "should have received", 4, 1.0),
    ("gpl-2.0", "either version 2 of the license or at your option any later version", "at your option", 4, 1.0),
    ("gpl-3.0", "either version 3 of the license or at your option any later version", "at your option", 4, 1.0),
    ("gpl", "distributed in the hope that it will be useful but without any warranty", "in the hope that", 3, 0.8),
    ("gpl", "(?:under|of|to|by) the (?:gnu )?gpl", "gpl", 2, 0.7),
    ("lgpl", "(?:under|of|to|by) the (?:gnu )?lgpl", "lgpl", 2, 0.7),
    ("agpl", "(?:under|of|to|by) the (?:gnu )?agpl", "agpl", 2, 0.7),
    ("lgpl", "this library is free software you can redistribute it", "free software", 4, 1.0),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", "should have received", 4, 1.0),
    ("agpl", "you should have received a copy of the gnu affero general public license", "should have received", 4, 1.0),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "source code form", 4, 1.0),
    ("mpl-2.0", "mozilla org mpl 2 0", "mozilla org", 4, 1.0),
    ("mpl-1.1", "mozilla org mpl mpl 1 1", "mozilla org", 4, 1.0),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", "contents of this file", 4, 1.0),
    ("epl-1.0", "eclipse org (?:org documents|legal) epl v10", "eclipse org", 4, 1.0),
    ("epl-2.0", "eclipse org (?:org documents|legal) epl (?:v20|2 0)", "eclipse org", 4, 1.0),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license", "contents of this file", 4, 1.0),
    ("boost-1.0", "boost org license 1 0", "boost org", 4, 1.0),
    ("boost-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy", "permission is hereby", 4, 1.0),
    ("cc0-1.0", "creativecommons org publicdomain zero 1 0", "creativecommons org", 4, 1.0),
    ("cc-by", "creativecommons org licenses by [1-4] [05]", "creativecommons org", 4, 1.0),
    ("cc-by-sa", "creativecommons org licenses by sa [1-4] [05]", "creativecommons org", 4, 1.0),
    ("cc-by-nd", "creativecommons org licenses by nd [1-4] [05]", "creativecommons org", 4, 1.0),
    ("cc-by-nc", "creativecommons org licenses by nc [1-4] [05]", "creativecommons org", 4, 1.0),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1-4] [05]", "creativecommons org", 4, 1.0),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1-4] [05]", "creativecommons org", 4, 1.0),
    ("cc0-1.0", "waived all copyright and related or neighboring rights", "waived all copyright", 4, 1.0),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free", 4, 1.0),
    ("unlicense", "unlicense org", "unlicense", 4, 1.0),
    ("zlib", "the origin of this software must not be misrepresented", "must not be misrepresented", 4, 1.0),
    ("zlib", "altered source versions must be plainly marked as such", "altered source versions", 4, 1.0),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee", "permission to use", 4, 0.9),
    ("json", "the software shall be used for good not evil", "good not evil", 4, 1.0),
    ("beerware", "you think this stuff is worth it you can buy me a beer", "buy me a beer", 4, 1.0),
    ("artistic-1.0", "under the same terms as perl itself", "terms as perl", 3, 0.9),
    ("openssl", "this product includes software developed by the openssl project", "openssl project", 4, 1.0),
    ("ofl-1.1", "scripts sil org ofl", "scripts sil org", 4, 1.0),
    ("sspl-1.0", "server side public license", "server side public", 3, 0.9),
    ("elastic-2.0", "elastic license(?: version| v)? ?2(?: 0)?", "elastic license", 3, 0.9),
    ("busl-1.1", "business source license(?: 1 1)?", "business source", 3, 0.9),
    ("commons-clause", "commons clause", "commons clause", 3, 0.8),
    ("proprietary", "unauthorized copying of this (?:file|software) (?:via any medium )?is strictly prohibited", "unauthorized copying", 3, 0.9),
    ("proprietary", "no part of this (?:publication|book|work|document) may be reproduced", "no part of this", 3, 0.8),
    ("license", "licensed under", "licensed under", 1, 0.3),
    ("license", "this work is licensed", "work is licensed", 1, 0.3),
)


def rules() -> list[tuple[str, str, str, str, int, float]]:
    """(label, expression, keyword, second keyword, priority, confidence), in order."""
    made = [(label, phrase, phrase, "", BASE_PRIORITY, 0.9) for phrase, label in BASE]
    for label, name, keyword, spdx in FAMILIES:
        made += [(label, form.format(name=name), keyword, own, priority, sure) for form, priority, sure, own in FORMS]
        made += [(label, form.format(spdx=spdx), own, "", priority, sure) for form, priority, sure, own in SPDX_FORMS]
        if "license" in name:  # the name says it all
            made.append((label, name, keyword, "license", 2, 0.8))
    for label, name, keyword in IDENTIFIERS:
        made += [(label, form.format(name=name), keyword, own, priority, sure) for form, priority, sure, own in IDENTIFIER_FORMS]
    made += [(label, form, keyword, "", priority, sure) for label, form, keyword, priority, sure in NOTICES]
    return made


#: A text that has none of these at a word's start has no detection: every rule holds one.
GATE_WORDS = (
    "licen", "spdx", "permission", "redistribut", "neither the name", "free software", "at your option", "compliance with", "as is without", "unencumbered",
    "public domain", "all rights", "proprietary", "copyright", "gnu", "apache", "creative", "under", "gpl", "lgpl", "agpl", "gfdl", "fdl", "mpl", "epl", "eupl", "cddl", "cpl", "osl",
    "afl", "ofl", "odbl", "pddl", "sspl", "busl", "bsl", "asl", "artistic", "0bsd", "clause", "cc0", "cc by", "cc zero", "ms pl", "ms rl", "mit 0", "wtfpl", "unlicense", "psf", "upl", "ncsa",
    "cecill", "advertising materials", "applicable law or agreed", "specific language governing", "in the hope that", "mozilla", "eclipse org", "boost org", "anyone is free", "must not be misrep",
    "altered source", "good not evil", "buy me a beer", "terms as perl", "openssl project", "scripts sil", "commons clause", "unauthorized copying", "no part of this",
)
GATE = "(?:^| )(?:" + "|".join(GATE_WORDS) + ")"


def _spans(text: Column, form: Column) -> Column:
    """Word intervals (start, end) of an expression's matches within the word string."""
    blanks = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    # a lookaround in Java's syntax keeps matches on word limits
    whole = F.concat(F.lit("(?<![^ ])(?:"), form, F.lit(")(?![^ ])"))
    both = F.array(F.struct(F.regexp_extract_all(text, whole, F.lit(0)).alias("m"), F.split(text, whole, -1).alias("p")))

    def walk(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<s:int,e:int>>)").alias("out"))

        def step(acc: Column, k: Column) -> Column:
            at = acc["at"] + blanks(F.element_at(x["p"], k + 1))
            n = blanks(F.element_at(x["m"], k + 1))
            return F.struct((at + n).alias("at"), F.concat(acc["out"], F.array(F.struct(at.alias("s"), (at + n + 1).alias("e")))).alias("out"))

        places = F.when(F.size(x["m"]) > 0, F.sequence(F.lit(0), F.size(x["m"]) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
        return F.aggregate(places, start, step, lambda acc: acc["out"])

    return F.flatten(F.transform(both, walk))


DETECTION = "array<struct<s:int,last:int,priority:int,e:int,label:string,sure:double>>"


def _rule_list() -> Column:
    """Rules by keyword, so that a keyword is looked up once for all its rules."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"  # noqa: E731  (expressions hold no backslash)
    groups: dict[str, list[str]] = {}
    for label, form, keyword, also, priority, sure in rules():
        groups.setdefault(keyword, []).append(f"named_struct('label',{quote(label)},'form',{quote(form)},'also',{quote(also)},'priority',{priority},'sure',{sure}D)")
    return F.expr("array(" + ",".join(f"named_struct('keyword',{quote(k)},'rules',array({','.join(v)}))" for k, v in groups.items()) + ")")


def detections(text: Column) -> Column:
    """All detections of a word string, in order of start, larger and higher-ranked ones first."""
    found = lambda r: F.transform(
        _spans(text, r["form"]),
        lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("last"), (-r["priority"]).alias("priority"), x["e"].alias("e"), r["label"].alias("label"), r["sure"].alias("sure")),
    )
    group = lambda g: F.flatten(F.transform(F.filter(g["rules"], lambda r: F.contains(text, r["also"])), found))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(_rule_list(), lambda g: F.contains(text, g["keyword"])), group))))


def surviving(found: Column) -> Column:
    """Detections that no interval of higher priority, and no larger one of their own, contains."""
    none = F.struct(F.lit(-1).alias("e"), F.lit(0).alias("back"))
    start = F.struct(*[none.alias(f"p{p}") for p in range(1, BASE_PRIORITY + 1)], F.expr(f"cast(array() as {DETECTION})").alias("out"))

    def step(acc: Column, d: Column) -> Column:
        own = F.struct(d["e"].alias("e"), (-d["s"]).alias("back"))
        hidden = F.lit(False)
        for p in range(1, BASE_PRIORITY + 1):
            above = (-d["priority"] < p) & (acc[f"p{p}"]["e"] >= d["e"])
            same = (-d["priority"] == p) & ((acc[f"p{p}"]["e"] > d["e"]) | ((acc[f"p{p}"]["e"] == d["e"]) & (-acc[f"p{p}"]["back"] < d["s"])))
            hidden = hidden | above | same
        hidden = hidden & (-d["priority"] != BASE_PRIORITY)
        kept = F.when(hidden, acc["out"]).otherwise(F.concat(acc["out"], F.array(d)))
        return F.struct(*[F.when(-d["priority"] == p, F.greatest(acc[f"p{p}"], own)).otherwise(acc[f"p{p}"]).alias(f"p{p}") for p in range(1, BASE_PRIORITY + 1)], kept.alias("out"))

    return F.aggregate(found, start, step, lambda acc: acc["out"])


def license_scan(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ..)`` to doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score and the surviving detections (start, end, label, priority, confidence)."""
    prepare(docs.sparkSession)
    rows = fixed(docs.select("doc_id", "text"), words=word_string(F.col("text"))).select("doc_id", "words")
    none = F.expr(f"cast(array() as {DETECTION})")
    rows = fixed(rows, found=F.when(F.col("words").rlike(GATE), detections(F.col("words"))).otherwise(none))
    rows = rows.select("doc_id", F.when(F.col("words") == "", 0).otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"), "found")
    rows = fixed(rows, kept=F.when(F.size("found") > 0, surviving(F.col("found"))).otherwise(F.col("found")))
    base = F.filter("kept", lambda d: -d["priority"] == BASE_PRIORITY)
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda d: d["label"]))), ",")
    starts = F.transform(base, lambda d: d["s"])
    out = F.transform("kept", lambda d: F.struct(d["s"].alias("start"), d["e"].alias("end"), d["label"].alias("label"), (-d["priority"]).alias("priority"), d["sure"].alias("confidence")))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        names(base).alias("base_labels"), names(F.col("kept")).alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: d["sure"])), F.lit(0.0)).alias("score"), out.alias("detections"),
    )
