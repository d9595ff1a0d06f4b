"""License scan: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment of intervals.

All texts are matched as words: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one blank, so a rule is a plain regex over words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases whose places are always counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label, the words of its SPDX tag, and its title as a regex over words.
TITLES = [
    ("apache-1.0", "apache 1 0", r"apache (software )?license (version |v )?1 0"),
    ("apache-1.1", "apache 1 1", r"apache (software )?license (version |v )?1 1"),
    ("apache-2.0", "apache 2 0", r"apache (software )?license (version |v )?2( 0)?"),
    ("mit", "mit", r"(mit|expat|x11) license"),
    ("mit-0", "mit 0", r"mit no attribution( license)?"),
    ("isc", "isc", r"isc license"),
    ("0bsd", "0bsd", r"(zero clause|0 clause) bsd( license)?"),
    ("bsd-1-clause", "bsd 1 clause", r"(1|one) clause bsd( license)?"),
    ("bsd-2-clause", "bsd 2 clause", r"((2|two) clause|simplified|freebsd) bsd( license)?"),
    ("bsd-3-clause", "bsd 3 clause", r"((3|three) clause|new|revised|modified) bsd( license)?"),
    ("bsd-4-clause", "bsd 4 clause", r"((4|four) clause|original) bsd( license)?"),
    ("gpl-1.0", "gpl 1 0", r"(gnu )?general public license (as published by the free software foundation )?(version |v )1( 0)?"),
    ("gpl-2.0", "gpl 2 0", r"(gnu )?general public license (as published by the free software foundation )?(version |v )2( 0)?"),
    ("gpl-3.0", "gpl 3 0", r"(gnu )?general public license (as published by the free software foundation )?(version |v )3( 0)?"),
    ("lgpl-2.0", "lgpl 2 0", r"(gnu )?library general public license (version |v )?2( 0)?"),
    ("lgpl-2.1", "lgpl 2 1", r"(gnu )?lesser general public license (version |v )?2 1"),
    ("lgpl-3.0", "lgpl 3 0", r"(gnu )?lesser general public license (version |v )?3( 0)?"),
    ("agpl-1.0", "agpl 1 0", r"affero general public license (version |v )?1( 0)?"),
    ("agpl-3.0", "agpl 3 0", r"(gnu )?affero general public license (version |v )?3( 0)?"),
    ("gfdl-1.1", "gfdl 1 1", r"(gnu )?free documentation license (version |v )?1 1"),
    ("gfdl-1.2", "gfdl 1 2", r"(gnu )?free documentation license (version |v )?1 2"),
    ("gfdl-1.3", "gfdl 1 3", r"(gnu )?free documentation license (version |v )?1 3"),
    ("mpl-1.0", "mpl 1 0", r"mozilla public license (version |v )?1 0"),
    ("mpl-1.1", "mpl 1 1", r"mozilla public license (version |v )?1 1"),
    ("mpl-2.0", "mpl 2 0", r"mozilla public license (version |v )?2( 0)?"),
    ("epl-1.0", "epl 1 0", r"eclipse public license (version |v )?1( 0)?"),
    ("epl-2.0", "epl 2 0", r"eclipse public license (version |v )?2( 0)?"),
    ("cpl-1.0", "cpl 1 0", r"common public license (version |v )?1( 0)?"),
    ("ipl-1.0", "ipl 1 0", r"ibm public license (version |v )?1( 0)?"),
    ("cddl-1.0", "cddl 1 0", r"common development and distribution license (version |v )?1 0"),
    ("cddl-1.1", "cddl 1 1", r"common development and distribution license (version |v )?1 1"),
    ("eupl-1.1", "eupl 1 1", r"european union public licen[cs]e (version |v )?1 1"),
    ("eupl-1.2", "eupl 1 2", r"european union public licen[cs]e (version |v )?1 2"),
    ("artistic-1.0", "artistic 1 0", r"artistic license (version |v )?1( 0)?"),
    ("artistic-2.0", "artistic 2 0", r"artistic license (version |v )?2( 0)?"),
    ("afl-3.0", "afl 3 0", r"academic free license (version |v )?3( 0)?"),
    ("osl-3.0", "osl 3 0", r"open software license (version |v )?3( 0)?"),
    ("bsl-1.0", "bsl 1 0", r"boost software license (version |v )?1( 0)?"),
    ("busl-1.1", "busl 1 1", r"business source license (version |v )?1 1"),
    ("sspl-1.0", "sspl 1 0", r"server side public license (version |v )?1?"),
    ("elastic-2.0", "elastic 2 0", r"elastic license (version |v )?2( 0)?"),
    ("ms-pl", "ms pl", r"microsoft public license"),
    ("ms-rl", "ms rl", r"microsoft reciprocal license"),
    ("zlib", "zlib", r"zlib( libpng)? license"),
    ("libpng", "libpng", r"libpng license"),
    ("openssl", "openssl", r"openssl license"),
    ("php-3.01", "php 3 01", r"php license (version |v )?3 01"),
    ("python-2.0", "python 2 0", r"(python software foundation|psf) license( (version |v )?2)?"),
    ("ruby", "ruby", r"ruby license"),
    ("unlicense", "unlicense", r"(the )?unlicense"),
    ("wtfpl", "wtfpl", r"do what the fuck you want to public license"),
    ("cc0-1.0", "cc0 1 0", r"cc0( license)?( (version |v )?1 0)?( universal)?"),
    ("cc0-1.0", "cc zero 1 0", r"creative commons zero( license)?( (version |v )?1 0)?( universal)?"),
    ("ofl-1.1", "ofl 1 1", r"(sil )?open font license( (version |v )?1 1)?"),
    ("odbl-1.0", "odbl 1 0", r"open (data commons open )?database license( (version |v )?1 0)?"),
    ("odc-by-1.0", "odc by 1 0", r"open data commons attribution license( (version |v )?1 0)?"),
    ("pddl-1.0", "pddl 1 0", r"(open data commons )?public domain dedication and license"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("ncsa", "ncsa", r"(university of illinois )?ncsa open source license"),
    ("cecill-2.1", "cecill 2 1", r"cecill( free software)? license( agreement)?( (version |v )?2 1)?"),
    ("upl-1.0", "upl 1 0", r"universal permissive license( (version |v )?1 0)?"),
    ("vim", "vim", r"vim license"),
    ("curl", "curl", r"curl license"),
    ("blueoak-1.0.0", "blueoak 1 0 0", r"blue oak model license( 1 0 0)?"),
    ("mulanpsl-2.0", "mulanpsl 2 0", r"mulan permissive software license (version |v )?2( 0)?"),
    ("openrail-m", "openrail m", r"(creativeml )?open ?rail m( license)?"),
]
CC_PARTS = [("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(ative)?s?"),
            ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
            ("by-nc-nd", "attribution non ?commercial no ?deriv(ative)?s?")]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# Label, keyword and regex over words of addresses, body sentences and loose names.
URLS = [
    ("apache-2.0", "apache org licenses", r"apache org licenses license 2 0"),
    ("gpl-2.0", "gnu org licenses", r"gnu org licenses (old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu org licenses", r"gnu org licenses gpl 3 0"),
    ("lgpl-2.1", "gnu org licenses", r"gnu org licenses (old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu org licenses", r"gnu org licenses lgpl 3 0"),
    ("agpl-3.0", "gnu org licenses", r"gnu org licenses agpl 3 0"),
    ("gfdl-1.3", "gnu org licenses", r"gnu org licenses fdl 1 3"),
    ("gpl", "gnu org licenses", r"gnu org (copyleft|licenses) gpl( html| txt)?"),
    ("mit", "opensource org licenses", r"opensource org licenses? mit( license)?"),
    ("bsd-2-clause", "opensource org licenses", r"opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource org licenses", r"opensource org licenses? bsd 3 clause"),
    ("isc", "opensource org licenses", r"opensource org licenses? isc"),
    ("mpl-2.0", "mozilla org", r"mozilla org (en us )?mpl 2 0"),
    ("epl-2.0", "eclipse org legal", r"eclipse org legal epl (2 0|v20)"),
    ("unlicense", "unlicense org", r"unlicense org"),
    ("wtfpl", "wtfpl net", r"wtfpl net"),
    ("cc0-1.0", "creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons org", r"creativecommons org publicdomain mark 1 0"),
    ("ofl-1.1", "scripts sil org", r"scripts sil org ofl"),
    ("odbl-1.0", "opendatacommons org", r"opendatacommons org licenses odbl"),
]
BODIES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "copyright notice and this permission notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-2-clause", "redistributions of source code", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-2-clause", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse or promote products", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "all advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "under the apache license", r"you may not use this (file|work) except in compliance with the license"),
    ("apache-2.0", "compliance with the license", r"you may not use this (file|work) except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "free software you can redistribute", r"(this program|it) is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "free software you can redistribute", r"is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license"),
    ("agpl", "free software you can redistribute", r"is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-2.0-or-later", "either version 2", r"general public license as published by the free software foundation either version 2( of the license)? or at your option any later version"),
    ("gpl-3.0-or-later", "either version 3", r"general public license as published by the free software foundation either version 3( of the license)? or at your option any later version"),
    ("gpl", "received a copy of the gnu general public license", r"you should have received a copy of the gnu general public license"),
    ("lgpl", "received a copy of the gnu lesser", r"you should have received a copy of the gnu lesser general public license"),
    ("agpl", "received a copy of the gnu affero", r"you should have received a copy of the gnu affero general public license"),
    ("mpl-2.0", "source code form is subject to", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such and must not be misrepresented"),
    ("zlib", "origin of this software must not", r"the origin of this software must not be misrepresented"),
    ("unlicense", "released into the public domain", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(released|dedicated|placed|is) (in|into|to|under) the public domain"),
    ("public-domain", "public domain", r"public domain dedication"),
    ("public-domain", "no rights reserved", r"no rights reserved"),
    ("some-rights", "some rights reserved", r"some rights reserved"),
    ("reserved", "rights reserved", r"all rights (are )?reserved"),
    ("copyright", "copyright", r"copyright (c )?(19|20)[0-9][0-9]"),
    ("copyright", "copyright", r"copyright (holders?|owners?) (of|and)"),
    ("copyright", "copyright", r"unauthori[sz]ed (copying|reproduction|use)( [^ ]+){0,8} copyright"),
    ("proprietary", "without prior written permission", r"(copied|reproduced|distributed|used)( [^ ]+){0,8} without (the )?prior written permission"),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential"),
    ("no-warranty", "without warranty of any kind", r"(provided|is provided) as is without warranty of any kind"),
    ("no-warranty", "without any warranty", r"without any warranty( without even the implied warranty)?"),
    ("non-commercial", "non commercial", r"for (personal and |strictly )?non commercial (use|purposes)( only)?"),
    ("non-commercial", "commercial use is prohibited", r"commercial use is (strictly )?prohibited"),
    ("research-only", "research purposes only", r"for (academic|scientific)?( and )?research purposes only"),
    ("eula", "end user license agreement", r"end user license agreement"),
    ("terms-of-use", "subject to the terms", r"subject to the terms (of use|of service|and conditions)"),
    ("contributor-agreement", "contributor license agreement", r"contributor license agreement"),
    ("dual", "dual licensed", r"dual licensed under"),
    ("ai-no-training", "training of", r"(may not|must not) be used (for|in) (the )?training of (machine learning|artificial intelligence|language) models"),
]
LOOSE = [
    ("apache", "apache license", r"apache license"), ("bsd", "bsd license", r"bsd( style)? license"), ("mit", "mit license", r"mit( style)? license"),
    ("gpl", "general public license", r"(gnu )?general public license"), ("lgpl", "lesser general public license", r"(gnu )?lesser general public license"),
    ("agpl", "affero general public license", r"(gnu )?affero general public license"), ("gpl", "gnu gpl", r"gnu gpl( v?[123])?"),
    ("lgpl", "gnu lgpl", r"gnu lgpl( v?[23])?"), ("agpl", "gnu agpl", r"gnu agpl( v?3)?"), ("mpl", "mozilla public license", r"mozilla public license"),
    ("epl", "eclipse public license", r"eclipse public license"), ("artistic", "artistic license", r"artistic license"),
    ("gfdl", "free documentation license", r"(gnu )?free documentation license"), ("creative-commons", "creative commons", r"creative commons( license)?"),
    ("gpl-2.0", "gplv2", r"gplv2"), ("gpl-3.0", "gplv3", r"gplv3"), ("lgpl-3.0", "lgplv3", r"lgplv3"), ("agpl-3.0", "agplv3", r"agplv3"),
    ("see-license", "license file", r"see (the )?(accompanying |included |attached )?license (file|txt|md)"),
    ("open-source", "open source license", r"open source license"), ("unspecified", "licensed under", r"(is |are )?licensed under"),
]

# Keyword and pattern of rules whose keyword not every match holds, and the words one of which every match holds.
NEEDLES = {
    ("gnu org licenses", r"gnu org (copyleft|licenses) gpl( html| txt)?"): ("gnu org licenses", "gnu org copyleft"),
    ("opensource org licenses", r"opensource org licenses? mit( license)?"): ("opensource org license",),
    ("opensource org licenses", r"opensource org licenses? bsd 2 clause"): ("opensource org license",),
    ("opensource org licenses", r"opensource org licenses? bsd 3 clause"): ("opensource org license",),
    ("opensource org licenses", r"opensource org licenses? isc"): ("opensource org license",),
    ("under the apache license", r"you may not use this (file|work) except in compliance with the license"): ("compliance with the license",),
    ("rights reserved", r"all rights (are )?reserved"): ("rights reserved", "rights are reserved"),
    ("without prior written permission", r"(copied|reproduced|distributed|used)( [^ ]+){0,8} without (the )?prior written permission"): ("prior written permission",),
    ("commercial use is prohibited", r"commercial use is (strictly )?prohibited"): ("commercial use is",),
    ("bsd license", r"bsd( style)? license"): ("bsd license", "bsd style license"),
    ("mit license", r"mit( style)? license"): ("mit license", "mit style license"),
    ("license file", r"see (the )?(accompanying |included |attached )?license (file|txt|md)"): ("license file", "license txt", "license md"),
}

# substrings one of which every keyword holds; a text without any of them meets no rule
GATES = ("licen", "copyright", "reserved", "cc by", "cc0", "gpl", "creative", "public domain", "permission", "redistribut", "warranty", "unless required",
         "advertising", "endorse", "source", "origin of", "either version", "gnu", "commercial", "confidential", "research purposes", "subject to", "mozilla org", "eclipse org",
         "opendatacommons", "sil org", "training of", "rail m", "wtfpl", "zero clause", "0 clause", "clause bsd", "bsd", "no attribution",
         "subject to the terms", "do what the")

# tiers: a detection is dropped inside another of the same or a lower tier
SPDX, URL, GRANT, TITLE, BODY, NAME = range(1, 7)
CONFIDENCE = {SPDX: 1.0, URL: 0.95, GRANT: 0.95, TITLE: 0.9, BODY: 0.8, NAME: 0.6}
BASE_CONFIDENCE = 0.5
GRANTS = r"(is |are )?(dual |also )?(licensed|released|distributed|available|published|redistributed|offered|covered|made available) (under|by) (the )?(terms of |terms and conditions of |conditions of )?(the |a |an )?"


@dataclass(frozen=True)
class Rule:
    label: str
    tier: int
    keyword: str     # words that most matches hold; ``needles`` says what all of them hold
    pattern: str     # regex over words; whole words only

    @property
    def needles(self) -> tuple[str, ...]:
        """A text without any of them cannot match."""
        return NEEDLES.get((self.keyword, self.pattern), (self.keyword,))


def _keyword(pattern: str) -> str:
    """The longest run of literal words that every match of the title holds."""
    plain = re.sub(r"\([^()]*\)\??|\[[^\]]*\]\??|.\?", "|", re.sub(r"\([^()]*(\([^()]*\)[^()]*)+\)\??", "|", pattern))
    return max((w.strip() for w in plain.split("|")), key=len)


def rules() -> list[Rule]:
    """All rules in their order: tags, addresses, grants, titles, sentences, loose names."""
    titles = [(label, spdx, title, _keyword(title)) for label, spdx, title in TITLES]
    for part, words in CC_PARTS:
        for version in CC_VERSIONS:
            short, number = "cc " + part.replace("-", " "), version.replace(".", " ")
            titles.append((f"cc-{part}-{version}", f"{short} {number}", f"{short} {number}", "cc by"))
            titles.append((f"cc-{part}-{version}", None, f"creative commons {words} {number}", "creative commons"))
    out = []
    for suffix, words in (("", ""), ("-only", " only"), ("-or-later", " or later")):
        out += [Rule(label + suffix, SPDX, "license identifier", f"spdx license identifier {spdx}{words}") for label, spdx, *_ in titles
                if spdx and (not suffix or "gpl" in label)]
    out += [Rule(label, URL, keyword, pattern) for label, keyword, pattern in URLS]
    out += [Rule(label, GRANT, keyword, GRANTS + title) for label, _, title, keyword in titles]
    out += [Rule(label, TITLE, keyword, title) for label, _, title, keyword in titles]
    out += [Rule(label, BODY, keyword, pattern) for label, keyword, pattern in BODIES]
    out += [Rule(label, NAME, keyword, pattern) for label, keyword, pattern in LOOSE]
    return out


def words_of(text: Column) -> Column:
    """Words joined by a blank, a blank at both ends; one blank alone for no words. Two letters whose lower case would be ASCII are set aside."""
    safe = F.replace(F.replace(text, F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é"))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(safe), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))


def _blanks(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(words: Column, found: list[Rule]) -> Column:
    """Array of (start, -end, tier, rule, label) of all matches, sorted. Positions come from the lengths of what lies between the matches."""
    table = F.array(*(F.struct(F.lit(i).alias("rule"), F.lit(r.tier).alias("tier"), F.lit(r.label).alias("label"), F.array(*map(F.lit, r.needles)).alias("needles"),
                               F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern")) for i, r in enumerate(found)))
    hit = F.filter(table, lambda r: F.exists(r["needles"], lambda n: F.contains(words, n)) & F.rlike(words, r["pattern"]))

    def places(r: Column) -> Column:
        sizes = F.transform(F.regexp_extract_all(words, r["pattern"], F.lit(0)), F.length)
        gaps = F.transform(F.split(words, r["pattern"], -1), F.length)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,back:int,tier:int,rule:int,label:string>>").alias("all"))

        def step(acc: Column, pair: Column) -> Column:
            begin = acc["at"] + pair["gap"]
            one = F.struct(begin.alias("start"), (-(begin + pair["size"])).alias("back"), r["tier"].alias("tier"), r["rule"].alias("rule"), r["label"].alias("label"))
            return F.struct((begin + pair["size"]).alias("at"), F.concat(acc["all"], F.array(one)).alias("all"))

        pairs = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda g, s: F.struct(g.alias("gap"), s.alias("size")))
        return F.aggregate(pairs, start, step, lambda acc: acc["all"])

    return F.array_sort(F.flatten(F.transform(hit, places)))


def _kept(detections: Column) -> Column:
    """(labels, score) after suppression. In order of start, longest first, an interval lies inside an earlier one if it ends no later;
    one running maximum of ends per tier therefore decides each detection without comparing pairs."""
    tiers = sorted(CONFIDENCE)
    start = F.struct(*(F.lit(-1).alias(f"end{t}") for t in tiers), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["back"]
        covered = F.lit(False)
        for t in tiers:
            covered = covered | ((d["tier"] >= t) & (acc[f"end{t}"] >= end))
        sure = F.lit(0.0)
        for t in tiers:
            sure = F.when(d["tier"] == t, F.lit(CONFIDENCE[t])).otherwise(sure)
        return F.struct(
            *(F.when(d["tier"] == t, F.greatest(acc[f"end{t}"], end)).otherwise(acc[f"end{t}"]).alias(f"end{t}") for t in tiers),
            F.when(covered, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(d["label"]))).alias("labels"),
            F.when(covered, acc["score"]).otherwise(F.greatest(acc["score"], sure)).alias("score"))

    return F.aggregate(detections, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["score"].alias("score")))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of each row's whole text.

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are their smallest and largest start (words from 0, NULL without
    any). ``detections`` are all rule matches before suppression, as (start, -end, tier, rule, label) in characters of the word text.
    ``labels`` are the base labels and those of the kept detections, sorted; ``score`` is the surest kept detection, 0.5 for base phrases alone, else
    0. NULL and empty texts have no words and no labels. Repeated rows get equal results. Everything is an expression over one row: no shuffle, no Python.
    """
    found = rules()
    w = F.col("_words")
    rows = docs.select(F.col(id_col), words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("_words"))
    phrases = [f" {p} " for p in BASE]
    has = {p: F.contains(w, F.lit(p)) for p in phrases}
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.contains(w, F.lit(g))
    rows = rows.select(id_col, "_words", F.when(w == "  ", F.lit(0)).otherwise(_blanks(w) - 1).cast("bigint").alias("n_words"),
                       *(has[p].alias(f"_has{i}") for i, p in enumerate(phrases)), gate.alias("_gate"))
    any_base = F.col("_has0") | F.col("_has1") | F.col("_has2")
    n_base = sum((F.when(F.col(f"_has{i}"), F.regexp_count(w, F.lit(f"{p[:-1]}(?= )"))).otherwise(F.lit(0)) for i, p in enumerate(phrases)), F.lit(0))
    first = F.least(*(F.when(F.col(f"_has{i}"), F.instr(w, p)) for i, p in enumerate(phrases)))
    last = F.greatest(*(F.when(F.col(f"_has{i}"), F.length(w) - F.instr(F.reverse(w), p[::-1]) - len(p) + 2) for i, p in enumerate(phrases)))
    base = F.filter(F.array(*(F.when(F.col(f"_has{i}"), F.lit(label)) for i, label in enumerate(BASE.values()))), lambda x: x.isNotNull())
    word_at = lambda place: (_blanks(F.substring(w, F.lit(1), place)) - 1).cast("bigint")
    rows = rows.select(id_col, "n_words", n_base.cast("bigint").alias("n_base"),
                       F.when(any_base, word_at(first)).alias("first_word"), F.when(any_base, word_at(last)).alias("last_word"),
                       base.alias("_base"), F.when(F.col("_gate"), _detections(w, found)).alias("detections"))
    rows = rows.withColumn("_kept", F.when(F.col("detections").isNotNull(), _kept(F.col("detections"))))
    labels = F.array_union(F.col("_base"), F.coalesce(F.col("_kept.labels"), F.array().cast("array<string>")))
    return rows.select(id_col, "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
                       F.array_join(F.array_sort(labels), ",").alias("labels"),
                       F.greatest(F.coalesce(F.col("_kept.score"), F.lit(0.0)), F.when(F.size("_base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))).alias("score"),
                       "detections")
