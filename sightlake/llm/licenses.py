"""License statements, by ordered signature rules.

Hundreds of patterns over a text's words are too many to try on every text. Texts without any
keyword are passed over, and a rule is tried only on texts that hold its own keyword. Detections
are intervals of words; one that lies within a detection of the same or a better priority is
suppressed, so a short mention inside a full statement says nothing of its own.

All of it is built-in expressions on the row itself: no explode, join or shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightlake.llm.frames import fresh, quoted, with_columns, without

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Rule(NamedTuple):
    """A pattern over words, each with one blank before it; lower priorities are better."""

    label: str
    priority: int
    pattern: str
    keyword: str
    confidence: float


#: Label, how the license is named in words, and one word that is always there:
#: a spelling without it is a rule of its own.
_NAMES = (
    ("gpl-1.0", "gnu general public license(?: version| v)? 1(?: 0)?", "general"),
    ("gpl-2.0", "gnu general public license(?: version| v)? 2(?: 0)?", "general"),
    ("gpl-3.0", "gnu general public license(?: version| v)? 3(?: 0)?", "general"),
    ("gpl", "gnu (?:gpl|general public license)", "gnu"),
    ("lgpl-2.1", "gnu (?:lesser|library) general public license(?: version| v)? 2(?: 1)?", "general"),
    ("lgpl-3.0", "gnu lesser general public license(?: version| v)? 3(?: 0)?", "lesser"),
    ("lgpl", "gnu (?:lgpl|lesser general public license)", "gnu"),
    ("agpl-3.0", "gnu affero general public license(?: version| v)? 3(?: 0)?", "affero"),
    ("agpl", "(?:gnu )?affero general public license", "affero"),
    ("gfdl", "gnu free documentation license(?: version 1 [123])?", "documentation"),
    ("apache-1.1", "apache (?:software )?license(?: version| v)? 1 [01]", "apache"),
    ("apache-2.0", "apache (?:software )?license(?: version| v)? 2(?: 0)?", "apache"),
    ("apache", "apache (?:software )?license", "apache"),
    ("mit", "(?:mit|expat|x11) license", "license"),
    ("bsd-0", "(?:zero clause bsd|0 clause bsd|0bsd) license", "bsd"),
    ("bsd-2", "(?:2 clause|two clause|simplified) bsd license", "bsd"),
    ("bsd-3", "(?:3 clause|three clause|new|modified|revised) bsd license", "bsd"),
    ("bsd-4", "(?:4 clause|four clause|original) bsd license", "bsd"),
    ("bsd", "bsd(?: style)? license", "bsd"),
    ("isc", "isc license", "isc"),
    ("zlib", "zlib(?: libpng)? license", "zlib"),
    ("boost-1.0", "boost software license(?: version| v)?(?: 1 0)?", "boost"),
    ("mpl-1.1", "mozilla public license(?: version| v)? 1 1", "mozilla"),
    ("mpl-2.0", "mozilla public license(?: version| v)? 2(?: 0)?", "mozilla"),
    ("mpl", "mozilla public license", "mozilla"),
    ("epl-1.0", "eclipse public license(?: version| v)? 1(?: 0)?", "eclipse"),
    ("epl-2.0", "eclipse public license(?: version| v)? 2(?: 0)?", "eclipse"),
    ("epl", "eclipse public license", "eclipse"),
    ("cddl", "common development and distribution license(?: version| v)?(?: 1 [01])?", "development"),
    ("eupl", "european union public licen[cs]e(?: version| v)?(?: 1 [0-2])?", "european"),
    ("artistic", "(?:perl )?artistic license(?: version| v)?(?: [12](?: 0)?)?", "artistic"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license", "want"),
    ("ofl-1.1", "sil open font license(?: version| v)?(?: 1 [01])?", "font"),
    ("odbl", "open database license(?: version| v)?(?: 1 0)?", "database"),
    ("psf-2.0", "python software foundation license(?: version| v)?(?: 2)?", "python"),
    ("cc0", "(?:cc0|cc zero)(?: 1 0)?", "cc"),
    ("cc0", "creative commons zero(?: 1 0)?", "commons"),
    ("cc-by-nc-nd", "cc by nc nd(?: [1-4] [05])?", "nd"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: works)?(?: [1-4] [05])?", "deriv"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1-4] [05])?", "sa"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?", "alike"),
    ("cc-by-nc", "cc by nc(?: [1-4] [05])?", "nc"),
    ("cc-by-nc", "creative commons attribution non ?commercial(?: [1-4] [05])?", "commercial"),
    ("cc-by-nd", "cc by nd(?: [1-4] [05])?", "nd"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:s|atives)(?: works)?(?: [1-4] [05])?", "deriv"),
    ("cc-by-sa", "cc by sa(?: [1-4] [05])?", "sa"),
    ("cc-by-sa", "creative commons attribution share ?alike(?: [1-4] [05])?", "alike"),
    ("cc-by", "cc by(?: [1-4] [05])?", "by"),
    ("cc-by", "creative commons attribution(?: [1-4] [05])?", "commons"),
    ("proprietary", "(?:proprietary|commercial) license", "license"),
)
#: What people write for short, by label.
_SHORT = (
    ("gpl-1.0", "(?:gnu )?(?:gplv1|gpl (?:v1|version 1|1 0))(?: licen[cs]e)?", "gpl"),
    ("gpl-2.0", "(?:gnu )?(?:gplv2|gpl (?:v2|version 2|2))(?: 0)?(?: only| or later)?(?: licen[cs]e)?", "gpl"),
    ("gpl-3.0", "(?:gnu )?(?:gplv3|gpl (?:v3|version 3|3))(?: 0)?(?: only| or later)?(?: licen[cs]e)?", "gpl"),
    ("lgpl-2.1", "(?:gnu )?(?:lgplv2|lgpl (?:v2|version 2|2))(?: 1)?(?: only| or later)?(?: licen[cs]e)?", "lgpl"),
    ("lgpl-3.0", "(?:gnu )?(?:lgplv3|lgpl (?:v3|version 3|3))(?: 0)?(?: only| or later)?(?: licen[cs]e)?", "lgpl"),
    ("agpl-3.0", "(?:gnu )?(?:agplv3|agpl (?:v3|version 3|3))(?: 0)?(?: only| or later)?(?: licen[cs]e)?", "agpl"),
    ("gpl", "gpl licen[cs]e", "gpl"), ("gpl", "general public licen[cs]e", "general"),
    ("lgpl", "lgpl licen[cs]e", "lgpl"), ("agpl", "agpl licen[cs]e", "agpl"),
    ("apache-2.0", "apache (?:v2|version 2|2)(?: 0)?(?: licen[cs]e)?", "apache"),
    ("apache-2.0", "apachev2", "apachev2"), ("apache-2.0", "apache licen[cs]e (?:v2|v 2|version 2)(?: 0)?", "apache"),
    ("apache", "apache licen[cs]e", "apache"),
    ("mit", "(?:mit|expat|x11) licen[cs]e", "licen"), ("mit", "mit licensed", "licensed"),
    ("bsd-2", "bsd 2 clause(?: licen[cs]e)?", "bsd"), ("bsd-2", "simplified bsd", "bsd"),
    ("bsd-3", "bsd 3 clause(?: licen[cs]e)?", "bsd"), ("bsd-3", "(?:new|modified|revised) bsd", "bsd"),
    ("bsd-4", "bsd 4 clause(?: licen[cs]e)?", "bsd"), ("bsd", "bsd licen[cs]e", "bsd"), ("bsd", "bsd licensed", "bsd"),
    ("isc", "isc licen[cs]e", "isc"), ("zlib", "zlib licen[cs]e", "zlib"),
    ("mpl-1.1", "(?:mpl|mplv1) (?:v1 |version 1 |1 )?1", "mpl"),
    ("mpl-2.0", "mpl (?:v2|version 2|2)(?: 0)?", "mpl"), ("mpl-2.0", "mplv2(?: 0)?", "mplv2"),
    ("cddl", "cddl (?:v1|version 1|1)(?: [01])?", "cddl"), ("eupl", "eupl (?:v1|version 1|1)(?: [0-2])?", "eupl"),
    ("gfdl", "(?:gnu )?(?:gfdl|fdl) (?:v1|version 1|1)(?: [123])?", "fdl"),
    ("boost-1.0", "boost (?:software )?licen[cs]e", "boost"), ("ofl-1.1", "open font licen[cs]e", "font"),
    ("sspl-1.0", "server side public licen[cs]e(?: version 1| v1)?", "server"),
    ("busl-1.1", "business source licen[cs]e(?: 1 1)?", "business"),
    ("elastic-2.0", "elastic licen[cs]e(?: 2 0| v2)?", "elastic"),
    ("ms-pl", "microsoft public licen[cs]e", "microsoft"), ("ms-rl", "microsoft reciprocal licen[cs]e", "microsoft"),
    ("mulan-2.0", "mulan (?:psl|permissive software licen[cs]e)(?: v2)?", "mulan"),
    ("openssl", "openssl licen[cs]e", "openssl"), ("php", "php licen[cs]e(?: 3 01)?", "php"),
    ("ruby", "ruby licen[cs]e", "ruby"), ("beerware", "beerware licen[cs]e", "beerware"),
    ("afl-3.0", "academic free licen[cs]e(?: 3 0| v 3 0)?", "academic"),
    ("osl-3.0", "open software licen[cs]e(?: 3 0| v 3 0)?", "open"),
    ("cpal-1.0", "common public attribution licen[cs]e", "attribution"),
    ("cecill", "cecill (?:b |c )?licen[cs]e", "cecill"), ("vim", "vim licen[cs]e", "vim"),
    ("ncsa", "(?:university of illinois )?ncsa open source licen[cs]e", "ncsa"),
    ("cc-by-nc-nd", "attribution non ?commercial no ?deriv(?:s|atives)(?: works)?(?: [1-4] [05])?", "deriv"),
    ("cc-by-nc-sa", "attribution non ?commercial share ?alike(?: [1-4] [05])?", "alike"),
    ("cc-by-nc", "attribution non ?commercial(?: [1-4] [05])?", "commercial"),
    ("cc-by-nd", "attribution no ?deriv(?:s|atives)(?: works)?(?: [1-4] [05])?", "deriv"),
    ("cc-by-sa", "attribution share ?alike(?: [1-4] [05])?", "alike"),
    ("cc-by", "attribution [1-4] [05] international", "attribution"),
)
#: Sentences of the licenses' own texts and of the notices they ask for, by label.
_SENTENCES = (
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache"),
    ("apache-2.0", "you may obtain a copy of the license at https? www apache org licenses license 2 0", "apache"),
    ("apache-1.1", "this product includes software developed by the apache software foundation", "apache"),
    ("gpl-2.0", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "foundation"),
    ("gpl-3.0", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "foundation"),
    ("gpl-2.0", "gnu general public license version 2 june 1991", "june"),
    ("gpl-3.0", "gnu general public license version 3 29 june 2007", "june"),
    ("lgpl-2.1", "gnu lesser general public license version 2 1 february 1999", "february"),
    ("lgpl-3.0", "gnu lesser general public license version 3 29 june 2007", "lesser"),
    ("agpl-3.0", "gnu affero general public license version 3 19 november 2007", "affero"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "redistribute"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license", "affero"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("gpl", "you should have received a copy of the gnu general public license along with this", "received"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "documentation"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "portions"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense", "sublicense"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "merchantability"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", "redistributions"),
    ("bsd-3", "nor the names of its contributors may be used to endorse or promote products derived from this software", "endorse"),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display the following acknowledgement", "advertising"),
    ("bsd", "this software is provided by the (?:copyright holders|authors|regents) and contributors as is and any express or implied warranties", "contributors"),
    ("isc", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software", "disclaims"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose", "documentation"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", "damages"),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented"),
    ("boost-1.0", "free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "organization"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", "mozilla"),
    ("epl-1.0", "accompanying materials are made available under the terms of the eclipse public license v1 0", "eclipse"),
    ("epl-2.0", "accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "development"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document", "verbatim"),
    ("cc0", "waived all copyright and related or neighboring rights", "waived"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", "font"),
    ("openssl", "this product includes software developed by the openssl project", "openssl"),
    ("psf-2.0", "psf is making python available to licensee on an as is basis", "psf"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", "intent"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", "beer"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", "unauthorized"),
    ("proprietary", "proprietary and confidential", "confidential"),
    ("proprietary", "may not be reproduced in any form without (?:prior )?written permission", "reproduced"),
    ("non-commercial", "for non ?commercial use only", "commercial"),
)
#: Label, and the words of its SPDX ids.
_SPDX = (
    ("gpl-1.0", "gpl 1 0"), ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"),
    ("lgpl-2.1", "lgpl 2 [01]"), ("lgpl-3.0", "lgpl 3 0"), ("agpl-3.0", "agpl 3 0"),
    ("agpl", "agpl 1 0"), ("gfdl", "gfdl 1 [123]"), ("apache-1.1", "apache 1 [01]"),
    ("apache-2.0", "apache 2 0"), ("mit", "(?:mit|x11)"), ("bsd-0", "0bsd"),
    ("bsd-2", "bsd 2 clause"), ("bsd-3", "bsd 3 clause"), ("bsd-4", "bsd 4 clause"),
    ("isc", "isc"), ("zlib", "zlib"), ("boost-1.0", "bsl 1 0"), ("mpl-1.1", "mpl 1 1"),
    ("mpl-2.0", "mpl 2 0"), ("mpl", "mpl 1 0"), ("epl-1.0", "epl 1 0"), ("epl-2.0", "epl 2 0"),
    ("cddl", "cddl 1 [01]"), ("eupl", "eupl 1 [0-2]"), ("artistic", "artistic [12] 0"),
    ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("ofl-1.1", "ofl 1 [01]"), ("odbl", "odbl 1 0"),
    ("psf-2.0", "(?:psf|python) 2 0"), ("cc0", "cc0 1 0"), ("cc-by-nc-nd", "cc by nc nd [1-4] [05]"),
    ("cc-by-nc-sa", "cc by nc sa [1-4] [05]"), ("cc-by-nc", "cc by nc [1-4] [05]"),
    ("cc-by-nd", "cc by nd [1-4] [05]"), ("cc-by-sa", "cc by sa [1-4] [05]"),
    ("cc-by", "cc by [1-4] [05]"),
)
#: Priority, the words around a name, and how far they are believed.
_FORMS = (
    (0, "spdx license identifier {}(?: or later| only)?", 1.0),
    (1, "(?:licensed|released|distributed|published|available) under(?: the| an?)?(?: terms of the)? {}(?: or any later version)?", 0.95),
    (1, "(?:subject to|governed by|covered by)(?: the)?(?: terms of the)? {}", 0.9),
    (2, "(?:see|read|accept)(?: the)?(?: full)? {}(?: for details)?", 0.6),
    (3, "{}", 0.5),
)
#: Statements that name no license.
_STATEMENTS = (
    Rule("all-rights-reserved", 2, "all rights reserved", "reserved", 0.7),
    Rule("copyright-notice", 2, "copyright(?: c)? (?:19|20)[0-9][0-9]", "copyright", 0.6),
    Rule("public-domain", 2, "(?:dedicated|released|placed) (?:in)?to the public domain", "domain", 0.8),
    Rule("public-domain", 3, "public domain", "domain", 0.4),
    Rule("no-warranty", 2, "without warranty of any kind(?: express or implied)?", "warranty", 0.5),
    Rule("mit", 0, "permission is hereby granted free of charge to any person obtaining a copy", "hereby", 1.0),
    Rule("bsd", 0, "redistribution and use in source and binary forms with or without modification", "redistribution", 1.0),
)

#: Names in all forms, in order: earlier rules win ties.
RULES = tuple(
    Rule(label, priority, form.format(f"(?:{name})"), keyword, confidence)
    for priority, form, confidence in _FORMS for label, name, keyword in _NAMES) + tuple(
    Rule(label, 0, f"spdx license identifier {name}(?: or later| only)?", "spdx", 1.0)
    for label, name in _SPDX) + tuple(
    Rule(label, 1, sentence, keyword, 1.0) for label, sentence, keyword in _SENTENCES) + tuple(
    Rule(label, 3, name, keyword, 0.5) for label, name, keyword in _SHORT) + _STATEMENTS
#: A text with none of these holds no base phrase and nothing for a rule to find.
KEYWORDS = ("licen", "spdx", "rights reserved", "copyright", "public domain", "warrant", "hereby",
            "redistribut", "commons", "cc0", "zero", "gnu", "bsd", "gpl", "fdl", "apache", "mpl", "cddl",
            "eupl", "alike", "deriv", "commercial", "attribution", "contributors",
            "this software", "mulan", "openssl", "stuff", "package",
            "unauthorized", "confidential", "reproduced")


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _intervals(words: Column, pattern: Column, make) -> Column:
    """An array of make(start, stop) for each place of a pattern, in words from zero.

    The text has one blank before each word and one at its end; the pattern takes the blanks
    before its words, so counting blanks counts words.
    """
    gaps = F.split(words, pattern, -1)
    found = F.regexp_extract_all(words, pattern, F.lit(0))

    def step(held, pair):
        start = held["at"] + _blanks(pair["gap"])
        stop = start + _blanks(pair["match"])
        return F.when(pair["match"].isNull(), held).otherwise(F.struct(
            stop.alias("at"),
            F.concat(held["out"], F.array(make(start, stop))).alias("out")))

    empty = F.filter(F.array(make(F.lit(0), F.lit(0))), lambda x: F.lit(False))
    return F.aggregate(
        F.arrays_zip(gaps.alias("gap"), found.alias("match")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda held: held["out"])


def _pattern(words_pattern: str) -> str:
    return f" {words_pattern}(?= )"


def _base(words: Column) -> Column:
    return F.concat(*[
        F.when(F.contains(words, F.lit(f" {phrase} ")), _intervals(
            words, F.lit(_pattern(phrase)),
            lambda a, b, name=label: F.struct(
                a.alias("start"), b.alias("stop"), F.lit(name).alias("label"))))
        .otherwise(F.array().cast("array<struct<start:int,stop:int,label:string>>"))
        for phrase, label in BASE_PHRASES.items()])


_DETECTION = "array<struct<start:int,before:int,priority:int,rank:int,label:string,confidence:double>>"


def _detections(words: Column, rules: Sequence[Rule]) -> Column:
    listed = F.array(*[F.struct(
        F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
        F.lit(i).alias("rank"), F.lit(_pattern(r.pattern)).alias("pattern"),
        F.lit(r.keyword).alias("keyword"), F.lit(float(r.confidence)).alias("confidence"))
        for i, r in enumerate(rules)])
    tried = F.filter(listed, lambda r: F.contains(words, r["keyword"]))
    each = F.transform(tried, lambda r: _intervals(
        words, r["pattern"], lambda a, b: F.struct(
            a.alias("start"), (-b).alias("before"), r["priority"].alias("priority"),
            r["rank"].alias("rank"), r["label"].alias("label"),
            r["confidence"].alias("confidence"))))
    # By start, then the longest, the best priority and the earliest rule.
    return F.array_sort(F.flatten(each).cast(_DETECTION))


def _unsuppressed(found: Column, priorities: Sequence[int]) -> Column:
    """Detections in none of those before them that have the same or a better priority.

    Sorted by start, an earlier one holds a later one if it goes on as far; so the farthest
    stop for each priority is all that needs to be known.
    """
    levels = sorted(set(priorities))

    def step(held, d):
        inside = F.lit(False)
        for level in levels:
            inside = inside | ((d["priority"] >= level) & (held[f"stop{level}"] >= -d["before"]))
        reach = [F.when(d["priority"] == level, F.greatest(held[f"stop{level}"], -d["before"]))
                 .otherwise(held[f"stop{level}"]).alias(f"stop{level}") for level in levels]
        return F.when(inside, held).otherwise(F.struct(
            *reach, F.concat(held["kept"], F.array(d)).alias("kept")))

    start = F.struct(*[F.lit(-1).alias(f"stop{level}") for level in levels],
                     F.array().cast(_DETECTION).alias("kept"))
    return F.aggregate(found, start, step, lambda held: held["kept"])


def scan(df: DataFrame, column: str = "text", rules: Sequence[Rule] = RULES,
         keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """df with n_words, ``base`` and ``detections``.

    ``base`` has every place of a base phrase as (start, stop, label), ``detections`` what the
    rules found and nothing suppressed as (start, stop, label, confidence), places in words
    from zero. Words are case-blind runs of letters, digits and non-ASCII characters; what stands
    between words does not matter. A null or empty text has no words and empty arrays, whole texts
    are read, rows stay where they are, repeated rows get equal results.
    """
    text = F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))
    words, lowered = fresh(df, "words"), fresh(df, "lowered")
    small = df.withColumn(lowered, F.lower(text))
    gate = F.col(lowered).rlike(rf"cc{_GAP}by")
    for keyword in dict.fromkeys(k.split(" ")[-1] for k in keywords):
        gate = gate | F.contains(F.col(lowered), F.lit(keyword))
    marked = small.select(
        *[F.col(quoted(c)) for c in df.columns],
        F.when(gate, F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, _GAP, " ")), F.lit(" ")))
        .alias(words),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias(fresh(df, "counted")))
    held = F.col(words)
    base_type = "array<struct<start:int,stop:int,label:string>>"
    kept = F.transform(
        _unsuppressed(_detections(held, rules), [r.priority for r in rules]), lambda d: F.struct(
            d["start"].alias("start"), (-d["before"]).alias("stop"), d["label"].alias("label"),
            d["confidence"].alias("confidence")))
    kept_type = "array<struct<start:int,stop:int,label:string,confidence:double>>"
    return with_columns(marked, {
        "n_words": F.col(fresh(df, "counted")),
        "base": F.when(held.isNull(), F.array().cast(base_type)).otherwise(_base(held)),
        "detections": F.when(held.isNull(), F.array().cast(kept_type)).otherwise(kept),
    }).select(*without(df, ["n_words", "base", "detections"]), "n_words", "base", "detections")


def labels(found: Column) -> Column:
    """Distinct labels of an array of detections, sorted, as one array."""
    return F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"])))
