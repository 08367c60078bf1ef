"""License scans: ordered signature rules behind a keyword prefilter.

A rule is (label, priority, keywords, pattern); every match of the pattern holds one of the keywords as a word. The words
of a text that are keywords are found by one set intersection; only the rules of those keywords run their patterns, over the text in lower case (A-Z) with runs of other bytes as one
blank. Detections that overlap are resolved in order: higher priority first, then the longer span, then the earlier
start and the rule order; a detection that lies inside an accepted one is suppressed (interval containment).

The base phrases are fixed by the contract and are rules of the highest priority: they are never suppressed.

Defined cases: null and empty texts have no words, no detections and score 0; repeated detections of one label count
once in `labels`; texts are scanned whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm.common import carried, map_batches, table, utf8, words

BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))

# Families: label, keywords (parted by blanks), names. Each name gives a grant rule ("licensed under NAME"), a bare name rule and, for an
# SPDX id, a tag rule; the version forms are written out. Texts are matched after normalisation: a-z, 0-9 and blanks.
_V = r"(?: (?:version|v|ver))?"
_NAMED: tuple[tuple[str, str, str], ...] = (
    ("mit", "mit", r"(?:the )?mit(?: x11)? license"),
    ("mit", "expat", r"expat license"),
    ("mit-0", "mit", r"mit no attribution(?: license)?"),
    ("apache-1.0", "apache", rf"apache (?:software )?license{_V} 1 0"),
    ("apache-1.1", "apache", rf"apache (?:software )?license{_V} 1 1"),
    ("apache-2.0", "apache", rf"apache (?:software )?license{_V} ?2(?: 0)?"),
    ("apache", "apache", r"apache (?:software )?license"),
    ("bsd-2-clause", "bsd freebsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: license)?"),
    ("bsd-0", "bsd 0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)(?: license)?"),
    ("bsd", "bsd", r"bsd(?: style)? license"),
    ("isc", "isc", r"isc license"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("libpng", "libpng", r"libpng license"),
    ("boost-1.0", "boost", rf"boost software license(?:{_V} 1 0)?"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public license{_V} 3(?: 0)?"),
    ("agpl-3.0", "agpl agplv agpl3 agplv3", r"(?:gnu )?agpl ?(?:v ?)?3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public license"),
    ("lgpl-2.0", "library", rf"(?:gnu )?library general public license{_V} 2(?: 0)?"),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public license{_V} 2 1"),
    ("lgpl-3.0", "lesser", rf"(?:gnu )?lesser general public license{_V} 3(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license"),
    ("lgpl", "library", r"(?:gnu )?library general public license"),
    ("lgpl-2.1", "lgpl lgplv lgpl2 lgplv2", r"(?:gnu )?lgpl ?(?:v ?)?2 1"),
    ("lgpl-3.0", "lgpl lgplv lgpl3 lgplv3", r"(?:gnu )?lgpl ?(?:v ?)?3(?: 0)?"),
    ("gpl-1.0", "gnu", rf"gnu general public license{_V} 1(?: 0)?"),
    ("gpl-2.0", "gnu", rf"gnu general public license{_V} 2(?: 0)?"),
    ("gpl-3.0", "gnu", rf"gnu general public license{_V} 3(?: 0)?"),
    ("gpl-2.0", "gpl gplv gpl2 gplv2", r"(?:gnu )?gpl ?(?:v ?)?2(?: 0)?"),
    ("gpl-3.0", "gpl gplv gpl3 gplv3", r"(?:gnu )?gpl ?(?:v ?)?3(?: 0)?"),
    ("gfdl-1.1", "documentation", rf"(?:gnu )?free documentation license{_V} 1 1"),
    ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation license{_V} 1 2"),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation license{_V} 1 3"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license"),
    ("mpl-1.0", "mozilla", rf"mozilla public license{_V} 1 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public license{_V} 1 1"),
    ("mpl-2.0", "mozilla", rf"mozilla public license{_V} 2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("epl-1.0", "eclipse", rf"eclipse public license{_V} 1(?: 0)?"),
    ("epl-2.0", "eclipse", rf"eclipse public license{_V} 2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public license"),
    ("edl-1.0", "eclipse", rf"eclipse distribution license(?:{_V} 1 0)?"),
    ("cddl-1.0", "distribution", rf"common development and distribution license(?:{_V} 1 0)?"),
    ("cddl-1.1", "distribution", rf"common development and distribution license{_V} 1 1"),
    ("cpl-1.0", "common", rf"common public license(?:{_V} 1 0)?"),
    ("cpal-1.0", "attribution", rf"common public attribution license(?:{_V} 1 0)?"),
    ("eupl-1.1", "european", rf"european union public licen[cs]e{_V} 1 1"),
    ("eupl-1.2", "european", rf"european union public licen[cs]e(?:{_V} 1 2)?"),
    ("cecill-2.1", "cecill", rf"cecill(?: free software)?(?: license)?(?:{_V} 2 1)?"),
    ("artistic-1.0", "artistic", rf"artistic license{_V} 1(?: 0)?"),
    ("artistic-2.0", "artistic", rf"artistic license{_V} 2(?: 0)?"),
    ("artistic", "artistic", r"artistic license"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("ofl-1.1", "sil", rf"sil open font license(?:{_V} 1 1)?"),
    ("ofl-1.0", "sil", rf"sil open font license{_V} 1 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense(?: license)?"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("python-2.0", "python psf", rf"(?:python|psf|python software foundation) license(?:{_V} 2)?"),
    ("php-3.01", "php", rf"php license(?:{_V} 3 01)?"),
    ("ruby", "ruby", r"ruby license"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("openssl", "openssl", r"openssl license"),
    ("ssleay", "ssleay", r"(?:original )?ssleay license"),
    ("curl", "curl", r"curl license"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? license"),
    ("afl-3.0", "academic", rf"academic free license(?:{_V} 3(?: 0)?)?"),
    ("osl-3.0", "open", rf"open software license(?:{_V} 3(?: 0)?)?"),
    ("upl-1.0", "universal", rf"universal permissive license(?:{_V} 1 0)?"),
    ("vim", "vim", r"vim license"),
    ("qpl-1.0", "q", rf"q public license(?:{_V} 1 0)?"),
    ("sleepycat", "sleepycat", r"sleepycat license"),
    ("watcom-1.0", "watcom", rf"(?:sybase )?open watcom public license(?:{_V} 1 0)?"),
    ("apsl-2.0", "apple", rf"apple public source license(?:{_V} 2 0)?"),
    ("ipl-1.0", "ibm", rf"ibm public license(?:{_V} 1 0)?"),
    ("lppl-1.3c", "latex", rf"latex project public license(?:{_V} 1 3c?)?"),
    ("odbl-1.0", "database", rf"open(?: data commons open)? database license(?:{_V} 1 0)?"),
    ("odc-by-1.0", "commons", r"open data commons attribution license"),
    ("pddl-1.0", "dedication", r"(?:open data commons )?public domain dedication and license"),
    ("dbcl-1.0", "database", r"database contents license"),
    ("sspl-1.0", "server", rf"server side public license(?:{_V} 1)?"),
    ("busl-1.1", "business", rf"business source license(?:{_V} 1 1)?"),
    ("elastic-2.0", "elastic", rf"elastic license(?:{_V} 2(?: 0)?)?"),
    ("commons-clause", "clause", r"commons clause(?: license condition)?"),
    ("hippocratic", "hippocratic", r"hippocratic license"),
    ("openrail", "openrail rail", r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: license)?"),
    ("llama-community", "llama", r"llama [23]? ?community license(?: agreement)?"),
    ("cc-by", "creative", r"creative commons attribution(?: license)?"),
    ("cc-by-1.0", "creative", r"creative commons attribution 1 0"),
    ("cc-by-2.0", "creative", r"creative commons attribution 2 0"),
    ("cc-by-2.5", "creative", r"creative commons attribution 2 5"),
    ("cc-by-3.0", "creative", r"creative commons attribution 3 0"),
    ("cc-by-4.0", "creative", r"creative commons attribution 4 0"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative",
     r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?"),
    ("cc0-1.0", "creative", r"creative commons (?:zero|cc0|public domain dedication)(?: 1 0)?(?: universal)?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-4.0", "cc", r"cc by 4 0"),
    ("cc-by-3.0", "cc", r"cc by 3 0"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
)
#: Links to license texts, after normalisation.
_LINKS: tuple[tuple[str, str, str], ...] = (
    ("apache-2.0", "apache", r"apache org licenses license 2 0"),
    ("mit", "opensource", r"opensource org licenses mit"),
    ("bsd-2-clause", "opensource", r"opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "opensource", r"opensource org licenses bsd 3 clause"),
    ("isc", "opensource", r"opensource org licenses isc"),
    ("gpl-2.0", "gnu", r"gnu org licenses(?: old licenses)? gpl 2 0"),
    ("gpl-3.0", "gnu", r"gnu org licenses gpl(?: 3 0)?"),
    ("lgpl-2.1", "gnu", r"gnu org licenses(?: old licenses)? lgpl 2 1"),
    ("lgpl-3.0", "gnu", r"gnu org licenses lgpl(?: 3 0)?"),
    ("agpl-3.0", "gnu", r"gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", "gnu", r"gnu org licenses fdl(?: 1 [123])?"),
    ("mpl-2.0", "mozilla", r"mozilla org(?: en us)? mpl 2 0"),
    ("epl-2.0", "eclipse", r"eclipse org legal epl (?:2 0|v20)"),
    ("epl-1.0", "eclipse", r"eclipse org legal epl v10"),
    ("unlicense", "unlicense", r"unlicense org"),
    ("boost-1.0", "boost", r"boost org license 1 0"),
    ("ofl-1.1", "sil", r"scripts sil org ofl"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
)
#: Sentences of license texts and notices.
_TEXTS: tuple[tuple[str, str, str], ...] = (
    ("mit", "charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "sublicense", r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("isc", "fee",
     r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute",
     r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute",
     r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "later", r"either version [123](?: 0)? of the license or at your option any later version"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "basis", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("zlib", "arising", r"in no event will the authors be held liable for any damages arising from the use of this"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("boost-1.0", "organization",
     r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("mpl-2.0", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license"),
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "domain", r"this (?:work|file|document|text) is in the public domain"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|reproduction|distribution) of this (?:file|work|document)"),
    ("proprietary", "confidential", r"confidential and proprietary"),
    ("reserved", "reserved", r"some rights reserved"),
    ("no-derivatives", "derivative", r"no derivative works (?:are )?(?:allowed|permitted)"),
    ("noncommercial", "commercial noncommercial", r"(?:for )?non ?commercial use only"),
    ("noncommercial", "commercial", r"not (?:be used )?for commercial (?:use|purposes)"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?"),
    ("warranty-disclaimer", "warranty", r"without warranty of any kind"),
    ("warranty-disclaimer", "warranties", r"without (?:any )?warranties of any kind"),
    ("warranty-disclaimer", "merchantability", r"implied warrant(?:y|ies) of merchantability"),
    ("terms", "permission", r"(?:reproduced|reprinted|used) (?:with|by) permission"),
)
#: Ids of the "SPDX-License-Identifier:" tag.
_TAGS = (
    "0bsd aal afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 "
    "artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear "
    "bsd-4-clause bsl-1.0 bzip2-1.0.6 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 "
    "cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpal-1.0 cpl-1.0 "
    "curl ecl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl gfdl-1.1 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 "
    "gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg imlib2 ipl-1.0 isc jpl json "
    "lgpl-2.0 lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng libtiff "
    "lppl-1.3c mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 mpl-2.0-no-copyleft-exception ms-pl ms-rl mulanpsl-2.0 ncsa ntp "
    "odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 openssl osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby "
    "sgi-b-2.0 sissl sleepycat sspl-1.0 tcl unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 xnet zend-2.0 zlib zpl-2.1"
).split()


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: bytes
    pattern: re.Pattern[bytes]
    weight: float


def _rule(label: str, priority: int, keyword: str, pattern: str, weight: float) -> Rule:
    return Rule(label, priority, keyword.encode(), re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])"), weight)


def default_rules() -> list[Rule]:
    """Base phrases, tags, grants, links, sentences of license texts, bare names: from the surest to the weakest."""
    rules = [Rule(label, 100, phrase.split()[0], re.compile(rb"(?<![^ ])" + phrase + rb"(?![^ ])"), 0.5)
             for phrase, label in BASE]
    rules += [_rule(i, 90, "spdx", "spdx license identifier " + re.sub("[-.]", " ", i), 1.0) for i in _TAGS]
    rules += [_rule(label, 80, k, rf"(?:licen[cs]ed|released|distributed|available|published|provided|made available)"
                                 rf" under (?:the )?(?:terms of (?:the )?)?{p}", 0.95) for label, k, p in _NAMED]
    rules += [_rule(label, 70, k, p, 0.9) for label, k, p in _LINKS]
    rules += [_rule(label, 60, k, p, 0.7) for label, k, p in _TEXTS]
    rules += [_rule(label, 50, k, p, 0.6) for label, k, p in _NAMED]
    return rules


class Scanner:
    """Rules indexed by keyword."""

    def __init__(self, rules: list[Rule]):
        self.by_keyword: dict[bytes, list[tuple[int, Rule]]] = {}
        for n, r in enumerate(rules):
            for k in r.keyword.split():
                self.by_keyword.setdefault(k, []).append((n, r))
        self.keywords = frozenset(self.by_keyword)

    def scan(self, ws: list[bytes]) -> list[tuple[int, int, int, Rule]]:
        """Detections (first word, number of words, rule number, rule) that remain, by position."""
        keys = self.keywords.intersection(ws)
        if not keys:
            return []
        line = b" ".join(ws)
        found = []
        for n, r in {n: r for k in keys for n, r in self.by_keyword[k]}.items():  # each once, whatever its keywords
            found += [(*m.span(), n, r) for m in r.pattern.finditer(line)]
        if not found:
            return []
        found.sort(key=lambda d: (-d[3].priority, d[0] - d[1], d[0], d[2]))
        kept = suppress(found)
        kept.sort(key=lambda d: (d[0], d[2]))
        out, at, n = [], 0, 0
        for start, end, number, r in kept:  # byte offsets to word numbers, in one pass
            n += line.count(b" ", at, start)
            at = start
            out.append((n, line.count(b" ", start, end) + 1, number, r))
        return out


def suppress(found: list[tuple[int, int, int, Rule]]) -> list[tuple[int, int, int, Rule]]:
    """In the given order, drops what lies inside a detection that was accepted before; base phrases always stay.

    Accepted spans that could contain another one form a staircase (starts and ends both rise), so one binary search
    decides: the last accepted span that starts at or before this one has the largest end of all such.
    """
    from bisect import bisect_left, bisect_right

    starts: list[int] = []
    ends: list[int] = []
    kept = []
    for d in found:
        start, end = d[0], d[1]
        i = bisect_right(starts, start)
        if i and ends[i - 1] >= end:
            if d[3].priority == 100:
                kept.append(d)
            continue
        kept.append(d)
        lo = bisect_left(starts, start)
        hi = bisect_right(ends, end)
        starts[lo:max(lo, hi)], ends[lo:max(lo, hi)] = [start], [end]
    return kept


def score(found: list[tuple[int, int, int, Rule]]) -> float:
    """Noisy-or over the distinct labels: each counts with its surest rule."""
    best: dict[str, float] = {}
    for *_, r in found:
        best[r.label] = max(best.get(r.label, 0.0), r.weight)
    miss = 1.0
    for label in sorted(best):
        miss *= 1.0 - best[label]
    return round(1.0 - miss, 12)


def detect(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, and the detections in order: label, priority, rule number, first word, number of words."""
    rules = default_rules() if rules is None else rules
    schema = carried(docs, ["doc_id"], "n_words long, score double, found array<struct<label: string, priority: int, "
                                       "rule: int, first_word: long, n_words: long>>")
    kind = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("rule", pa.int32()),
                               ("first_word", pa.int64()), ("n_words", pa.int64())]))
    scanner: list[Scanner] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scanner:
            scanner.append(Scanner(rules))
        n_words, scores, rows = [], [], []
        for text in batch.column("text").to_pylist():
            ws = words(text)
            found = scanner[0].scan(ws)
            n_words.append(len(ws))
            scores.append(score(found))
            rows.append([{"label": r.label, "priority": r.priority, "rule": n, "first_word": a, "n_words": w}
                         for a, w, n, r in found])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(scores, pa.float64()),
             pa.array(rows, kind)], names=["doc_id", "n_words", "score", "found"])

    return map_batches(docs.select("doc_id", utf8().alias("text")), work, schema)


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of the detections; base places are those of rules 0 to 2."""
    found = detect(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda d: d["rule"] < len(BASE))
    label = lambda a: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(a, lambda d: d["label"]))))
    firsts = F.transform(base, lambda d: d["first_word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"), label(base).alias("base_labels"), label(F.col("found")).alias("labels"),
        "score", F.size("found").cast("long").alias("n_found"))
