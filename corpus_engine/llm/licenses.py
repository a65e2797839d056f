"""License scan by ordered signature rules, in DataFrame functions alone.

A text is reduced to its words with single spaces. A rule is a pattern over words with a label, a
level and a keyword; only rules whose keyword occurs are tried. Hits are word intervals. A hit is
dropped if it lies inside another hit of a higher level, or of its own level and not shorter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpus_engine.session import settled

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases that always count.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Names by which texts refer to a license: label, keyword of the prefilter, pattern over words.
NAMES = r"""
mit                 mit         (?:mit|expat|x11) licen[sc]e
mit-0               mit 0       mit 0 licen[sc]e
mit-0               no attribution      mit no attribution(?: licen[sc]e)?
apache-1.1          apache      apache (?:software )?licen[sc]e (?:v|v ?|version )?1 1
apache-2            apache      apache (?:software )?licen[sc]e (?:v|version )?2(?: 0)?
apache-2            apache      apache 2(?: 0)?(?: licen[sc]e)?
gpl-1               general     gnu general public licen[sc]e (?:v|version )?1(?: 0)?
gpl-2               general     gnu general public licen[sc]e (?:v|version )?2(?: 0)?
gpl-3               general     gnu general public licen[sc]e (?:v|version )?3(?: 0)?
gpl-2               gpl         (?:gnu )?gpl ?(?:v ?|version )?2(?: 0)?(?: only| or later)?
gpl-3               gpl         (?:gnu )?gpl ?(?:v ?|version )?3(?: 0)?(?: only| or later)?
gpl-2               gplv        gplv2
gpl-3               gplv        gplv3
lgpl-2              lesser      gnu (?:library|lesser) general public licen[sc]e (?:v|version )?2(?: 0)?
lgpl-2.1            lesser      gnu lesser general public licen[sc]e (?:v|version )?2 1
lgpl-3              lesser      gnu lesser general public licen[sc]e (?:v|version )?3(?: 0)?
lgpl-2.1            lgpl        (?:gnu )?lgpl ?(?:v ?|version )?2 1(?: only| or later)?
lgpl-3              lgpl        (?:gnu )?lgpl ?(?:v ?|version )?3(?: 0)?(?: only| or later)?
agpl-3              affero      gnu affero general public licen[sc]e (?:v|version )?3(?: 0)?
agpl-3              agpl        (?:gnu )?agpl ?(?:v ?|version )?3(?: 0)?(?: only| or later)?
gfdl-1.2            documentation   gnu free documentation licen[sc]e (?:v|version )?1 2
gfdl-1.3            documentation   gnu free documentation licen[sc]e (?:v|version )?1 3
bsd-2               bsd         (?:2 clause|two clause|simplified|freebsd) bsd(?: licen[sc]e)?
bsd-2               bsd         bsd 2 clause(?: licen[sc]e)?
bsd-3               bsd         (?:3 clause|three clause|modified|revised|new) bsd(?: licen[sc]e)?
bsd-3               bsd         bsd 3 clause(?: licen[sc]e)?
bsd-4               bsd         (?:4 clause|four clause|original) bsd(?: licen[sc]e)?
bsd-0               bsd         (?:zero clause bsd|bsd zero clause|0bsd)(?: licen[sc]e)?
isc                 isc         isc licen[sc]e
mpl-1.1             mozilla     mozilla public licen[sc]e (?:v|version )?1 1
mpl-2               mozilla     mozilla public licen[sc]e (?:v|version )?2(?: 0)?
mpl-2               mpl         mpl (?:v ?|version )?2(?: 0)?
epl-1               eclipse     eclipse public licen[sc]e (?:v ?|version )?1(?: 0)?
epl-2               eclipse     eclipse public licen[sc]e (?:v ?|version )?2(?: 0)?
cddl-1              cddl        cddl (?:v ?|version )?1(?: [01])?
cddl-1              common development      common development and distribution licen[sc]e(?: (?:v ?|version )?1(?: [01])?)?
cpl-1               common public   common public licen[sc]e(?: (?:v ?|version )?1(?: 0)?)?
eupl-1.1            european    european union public licen[sc]e (?:v ?|version )?1 1
eupl-1.2            european    european union public licen[sc]e (?:v ?|version )?1 2
artistic-1          artistic    artistic licen[sc]e (?:v ?|version )?1(?: 0)?
artistic-2          artistic    artistic licen[sc]e (?:v ?|version )?2(?: 0)?
boost-1             boost       boost software licen[sc]e(?: (?:v ?|version )?1(?: 0)?)?
zlib                zlib        zlib(?: libpng)? licen[sc]e
unlicense           unlicense   (?:the )?unlicense
wtfpl               wtfpl       wtfpl(?: (?:v ?|version )?2)?
wtfpl               want to public  do what the fuck you want to public licen[sc]e
psf-2               python      python software foundation licen[sc]e(?: (?:v ?|version )?2)?
python-2            python      python licen[sc]e(?: (?:v ?|version )?2(?: 0)?)?
ofl-1.1             open font   (?:sil )?open font licen[sc]e(?: (?:v ?|version )?1 1)?
ncsa                ncsa        (?:university of illinois )?ncsa(?: open source)? licen[sc]e
postgresql          postgresql  postgresql licen[sc]e
ms-pl               microsoft   microsoft public licen[sc]e
ms-rl               microsoft   microsoft reciprocal licen[sc]e
osl-3               open software   open software licen[sc]e (?:v ?|version )?3(?: 0)?
afl-3               academic free   academic free licen[sc]e (?:v ?|version )?3(?: 0)?
bsl-1.1             business source     business source licen[sc]e(?: (?:v ?|version )?1 1)?
sspl-1              server side     server side public licen[sc]e(?: (?:v ?|version )?1)?
elastic-2           elastic     elastic licen[sc]e(?: (?:v ?|version )?2(?: 0)?)?
odbl-1              open database   open (?:data commons )?(?:open )?database licen[sc]e(?: (?:v ?|version )?1(?: 0)?)?
odc-by-1            open data commons   open data commons attribution licen[sc]e(?: (?:v ?|version )?1(?: 0)?)?
pddl-1              public domain dedication    public domain dedication and licen[sc]e
cc0                 cc0         cc0(?: 1 0)?(?: universal)?
cc0                 creative commons    creative commons (?:zero|cc0)(?: (?:v ?|version )?1 0)?(?: universal)?
cc-by               creative commons    creative commons attribution(?: (?:(?:v ?|version )?[1-4] [05]))?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-sa            creative commons    creative commons attribution share ?alike(?: (?:(?:v ?|version )?[1-4] [05]))?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nd            creative commons    creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: (?:(?:v ?|version )?[1-4] [05]))?
cc-by-nc            creative commons    creative commons attribution non ?commercial(?: (?:(?:v ?|version )?[1-4] [05]))?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by-nc-sa         creative commons    creative commons attribution non ?commercial share ?alike(?: (?:(?:v ?|version )?[1-4] [05]))?
cc-by-nc-nd         creative commons    creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: (?:(?:v ?|version )?[1-4] [05]))?
cc-by               cc by       cc by(?: [1-4] [05])?
cc-by-sa            cc by sa    cc by sa(?: [1-4] [05])?
cc-by-nd            cc by nd    cc by nd(?: [1-4] [05])?
cc-by-nc            cc by nc    cc by nc(?: [1-4] [05])?
cc-by-nc-sa         cc by nc sa     cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd         cc by nc nd     cc by nc nd(?: [1-4] [05])?
gfdl                documentation   gnu free documentation licen[sc]e
gpl                 general     gnu general public licen[sc]e
lgpl                lesser      gnu lesser general public licen[sc]e
agpl                affero      gnu affero general public licen[sc]e
apache              apache      apache (?:software )?licen[sc]e
bsd                 bsd         bsd(?: style)? licen[sc]e
mpl                 mozilla     mozilla public licen[sc]e
epl                 eclipse     eclipse public licen[sc]e
artistic            artistic    artistic licen[sc]e
"""

# Sentences of the licenses themselves and notices without a name: label, keyword, pattern.
NOTICES = r"""
mit                 free of charge      permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit                 sublicense          use copy modify merge publish distribute sublicense and or sell copies of the software
mit                 noninfringement     warranties of merchantability fitness for a particular purpose and noninfringement
isc                 with or without fee is hereby     permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd                 redistribution      redistribution and use in source and binary forms with or without modification are permitted
bsd-3               endorse             neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products
bsd-4               advertising         all advertising materials mentioning features or use of this software must display
apache-2            compliance          you may not use this file except in compliance with the license
apache-2            conditions of any kind      distributed on an as is basis without warranties or conditions of any kind
gpl                 free software       this program is free software you can redistribute it and or modify it
gpl-2               free software       either version 2 of the license or at your option any later version
gpl-3               free software       either version 3 of the license or at your option any later version
lgpl                free software       this library is free software you can redistribute it and or modify it
gpl                 without any warranty    distributed in the hope that it will be useful but without any warranty
mpl-2               source code form    this source code form is subject to the terms of the mozilla public license
boost-1             object code     permission is hereby granted free of charge to any person or organization obtaining a copy of the software
zlib                altered source  altered source versions must be plainly marked as such
unlicense           unencumbered    free and unencumbered software released into the public domain
wtfpl               verbatim        everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed
public-domain       public domain   (?:this work|this software|this file|this document) is (?:hereby )?(?:placed |released )?in(?:to)? the public domain
public-domain       public domain   dedicated to the public domain
cc0                 waive           to the extent possible under law .{1,80}? has waived all copyright
all-rights-reserved     reserved    all rights reserved
all-rights-reserved     reproduced  no part of this (?:publication|book|work|document) may be reproduced
proprietary         confidential    (?:proprietary and confidential|confidential and proprietary)
proprietary         unauthorized    unauthorized (?:copying|reproduction|distribution) of this (?:file|software|document|work)
proprietary         terms of use    use of this (?:software|site|work) is subject to (?:the |our )?terms of use
copyright           copyright       copyright (?:c )?(?:19|20)[0-9]{2}
non-commercial      commercial      (?:for )?non ?commercial (?:use|purposes) only
"""

#: How a name is used: keyword within the rule's, level, pattern around the name. Higher levels win.
USES = (
    (3, r"(?:licen[sc]ed|released|distributed|published|available|made available|provided) under (?:the )?(?:terms of (?:the )?)?{}"),
    (3, r"(?:subject to|governed by|covered by|according to|in accordance with) (?:the )?(?:terms of (?:the )?)?{}"),
    (3, r"spdx licen[sc]e identifier {}"),
    (2, r"(?:under|see) (?:the )?(?:terms of (?:the )?)?{}"),
    (1, r"{}"),
)
LEVELS = (1, 2, 3, 4)
WORTH = {1: 0.5, 2: 0.8, 3: 0.95, 4: 1.0}


def rules() -> list[tuple[str, int, str, str, bool]]:
    """``label, level, keyword, pattern, base`` in order: phrases, notices, and the uses of names."""
    out = [(label, 4, phrase, re.escape(phrase).replace(r"\ ", " "), True) for phrase, label in BASE.items()]
    for level, block in ((4, NOTICES), (None, NAMES)):
        for line in block.strip().splitlines():
            label, keyword, pattern = re.split(r"\s{2,}", line.strip(), maxsplit=2) if "  " in line else ("",) * 3
            if level:
                out.append((label, level, keyword, pattern, False))
            else:
                out += [(label, use, keyword, text.format(f"(?:{pattern})"), False) for use, text in USES]
    return [(label, level, key, f"(?<= ){pattern}(?= )", base) for label, level, key, pattern, base in out]


def _needs_licence(pattern: str) -> bool:
    """Whether every match of a pattern has a word that starts with "licen"."""
    while (shorter := re.sub(r"\(\?:[^()]*\)\?|\(\?:[^()|]*\|[^()]*\)", "", pattern)) != pattern:
        pattern = shorter
    return "licen" in pattern


def _roots() -> list[str]:
    """A text without any of these words has no hit: one word of every rule."""
    words = {
        "licen" if _needs_licence(pattern) else max(keyword.split(), key=len) for _, _, keyword, pattern, _ in rules()
    }
    kept: list[str] = []
    for word in sorted(words, key=lambda w: (len(w), w)):
        if not any(k in word for k in kept):
            kept.append(word)
    return kept


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _hits(words: Column, rule: Column) -> Column:
    """Intervals of words (first, last) where a rule's pattern matches."""
    found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    between = F.split(words, rule["pattern"], -1)
    pairs = F.arrays_zip(found.alias("hit"), F.slice(between, 1, F.size(found)).alias("gap"))
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<first: int, last: int>>").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + _spaces(pair["gap"])
        last = first + _spaces(pair["hit"])
        new = F.array(F.struct(first.alias("first"), last.alias("last")))
        return F.struct(last.alias("at"), F.concat(state["out"], new).alias("out"))

    return F.aggregate(pairs, start, step, lambda state: state["out"])


def _rule_array(spark: SparkSession) -> Column:
    """The rules as one constant array: a fixed list, however large the table is."""
    fields = ("label", "level", "keyword", "pattern", "base")
    made = [F.struct(*(F.lit(v).alias(n) for n, v in zip(fields, rule, strict=True))) for rule in rules()]
    return F.array(*made)


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_words, hits`` of every row; hits: ``label, level, base, first, last``.

    Words are runs of ASCII digits and letters and of all other characters beyond ASCII; A to Z count
    as lower case. Null texts count as empty. No row is shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    small = F.lower("text")
    gate = F.lit(False)
    for root in _roots():
        gate = gate | F.contains(F.col("small"), F.lit(root))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace("text", GAPS, " ")), F.lit(" "))
    rule_list = _rule_array(docs.sparkSession)

    def each(rule: Column) -> Column:
        spot = F.transform(
            _hits(F.col("words"), rule),
            lambda h: F.struct(
                rule["label"].alias("label"), rule["level"].alias("level"), rule["base"].alias("base"),
                h["first"].alias("first"), h["last"].alias("last"),
            ),
        )
        return spot

    tried = F.filter(rule_list, lambda r: F.contains(F.col("words"), r["keyword"]))
    hits = F.flatten(F.transform(tried, each))
    return (
        docs.select(F.col("doc_id").cast("long"), text.alias("text"))
        .select("doc_id", "text", small.alias("small"))
        .select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
            F.when(gate, F.translate(spaced, upper, upper.lower())).alias("words"),
        )
        .select("doc_id", "text_hash", "n_words", F.when(F.col("words").isNotNull(), hits).alias("hits"))
    )


def kept_hits(found: DataFrame) -> DataFrame:
    """``doc_id, text_hash, label, level, base, first, last`` of the hits that no other hit suppresses.

    Hits in order of start, longer ones first: one lies inside an earlier one exactly if some
    earlier end is not before its own, which a running maximum per level tells.
    """
    hits = found.where(F.size("hits") > 0).select("doc_id", "text_hash", F.inline("hits")).distinct()
    order = (
        Window.partitionBy("doc_id", "text_hash")
        .orderBy("first", F.desc("last"), F.desc("level"), F.desc("base"), "label")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.lit(False)
    for level in LEVELS:
        over = F.max(F.when(F.col("level") >= level, F.col("last"))).over(order)
        inside = inside | ((F.col("level") == level) & F.coalesce(over >= F.col("last"), F.lit(False)))
    return hits.withColumn("inside", inside).where(~F.col("inside")).drop("inside")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    The score is the worth of the best kept level, 0 without a hit. Base phrases always keep their
    labels. Equal rows have equal results and stay apart; an empty table gives no rows.
    """
    found = settled(detect(docs), "license-hits")
    named = kept_hits(found).groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max("level").alias("level")
    )
    named = named.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    base = F.filter("hits", lambda h: h["base"])
    starts = F.transform(base, lambda h: h["first"].cast("long"))
    base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda h: h["label"])))
    none = F.array().cast("array<string>")
    worth = F.lit(0.0)
    for level, value in WORTH.items():
        worth = F.when(F.col("level") == level, value).otherwise(worth)
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    return (
        found.join(named, same, "left")
        .withColumn("base", F.coalesce(base_labels, none))
        .select(
            "doc_id",
            "n_words",
            F.coalesce(F.size(base), F.lit(0)).cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            F.array_join("base", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
            worth.alias("score"),
        )
    )
