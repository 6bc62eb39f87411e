"""License detection by ordered signature rules.

A rule is a pattern with a label, a priority and a keyword that every match holds once runs of white space are one
space. One pass of a keyword automaton over the lower-cased text in that form finds which keywords occur, and only the
rules of those run, on the text as it is. Of overlapping detections, one that lies inside another
of higher priority, or of the same priority and greater length, is suppressed.
The rules are written for families of licenses: each family gives its names, and each name stands in the forms in which
licenses are stated (tags, sentences, abbreviations, addresses). Abbreviations that also name a product or anything else
count only beside a word of licensing. License texts and notices are known by their own sentences. A clause that denies a
license ("not licensed under ...") has the highest priority and no label, so that it suppresses what lies inside it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from billweave.llm.common import map_batches

#: Fixed phrases whose places count, with their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DIGESTS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)

#: Families: label, name as a pattern, versions, abbreviation; the keyword is the last column.
FAMILIES = [
    ("gpl", r"gnu\s+general\s+public\s+licen[sc]e", "1 2 3", "gpl", "general public"),
    ("lgpl", r"gnu\s+(?:lesser|library)\s+general\s+public\s+licen[sc]e", "2 2.1 3", "lgpl", "general public"),
    ("agpl", r"gnu\s+affero\s+general\s+public\s+licen[sc]e", "1 3", "agpl", "affero"),
    ("gfdl", r"gnu\s+free\s+documentation\s+licen[sc]e", "1.1 1.2 1.3", "gfdl", "free documentation"),
    ("apache", r"apache\s+(?:software\s+)?licen[sc]e", "1 1.1 2", "apache", "apache"),
    ("mpl", r"mozilla\s+public\s+licen[sc]e", "1 1.1 2", "mpl", "mozilla"),
    ("epl", r"eclipse\s+public\s+licen[sc]e", "1 2", "epl", "eclipse"),
    ("cddl", r"common\s+development\s+and\s+distribution\s+licen[sc]e", "1 1.1", "cddl", "common development"),
    ("cpl", r"common\s+public\s+licen[sc]e", "1", "cpl", "common public"),
    ("eupl", r"european\s+union\s+public\s+licen[sc]e", "1 1.1 1.2", "eupl", "european union"),
    ("osl", r"open\s+software\s+licen[sc]e", "1 2 2.1 3", "osl", "open software"),
    ("afl", r"academic\s+free\s+licen[sc]e", "1.2 2 2.1 3", "afl", "academic free"),
    ("artistic", r"artistic\s+licen[sc]e", "1 2", "artistic", "artistic"),
    ("bsl", r"boost\s+software\s+licen[sc]e", "1", "bsl", "boost"),
    ("ofl", r"(?:sil\s+)?open\s+font\s+licen[sc]e", "1 1.1", "ofl", "open font"),
    ("zpl", r"zope\s+public\s+licen[sc]e", "1.1 2 2.1", "zpl", "zope"),
    ("psf", r"python\s+software\s+foundation\s+licen[sc]e", "2", "psf", "python software"),
    ("php", r"php\s+licen[sc]e", "3 3.01", "php", "php licen"),
    ("lppl", r"latex\s+project\s+public\s+licen[sc]e", "1 1.2 1.3", "lppl", "latex project"),
    ("cecill", r"cecill\s+(?:free\s+software\s+)?licen[sc]e", "1 1.1 2 2.1", "cecill", "cecill"),
    ("odbl", r"open\s+database\s+licen[sc]e", "1", "odbl", "open database"),
    ("upl", r"universal\s+permissive\s+licen[sc]e", "1", "upl", "universal permissive"),
    ("ncsa", r"university\s+of\s+illinois[/\s]+ncsa\s+open\s+source\s+licen[sc]e", "", "ncsa", "ncsa"),
    ("mit", r"(?:mit|expat|x11)\s+licen[sc]e", "", "mit", "licen"),
    ("isc", r"isc\s+licen[sc]e", "", "isc", "isc licen"),
    ("zlib", r"zlib(?:/libpng)?\s+licen[sc]e", "", "zlib", "zlib"),
    ("bsd", r"bsd\s+licen[sc]e", "", "bsd", "bsd"),
    ("wtfpl", r"do\s+what\s+the\s+fuck\s+you\s+want\s+to\s+public\s+licen[sc]e", "2", "wtfpl", "do what the"),
    ("postgresql", r"postgresql\s+licen[sc]e", "", "postgresql", "postgresql"),
    ("openssl", r"openssl\s+licen[sc]e", "", "openssl", "openssl"),
    ("sspl", r"server\s+side\s+public\s+licen[sc]e", "1", "sspl", "server side"),
    ("busl", r"business\s+source\s+licen[sc]e", "1 1.1", "busl", "business source"),
    ("vim", r"vim\s+licen[sc]e", "", "vim", "vim licen"),
]
#: Abbreviations that stand for nothing but a license; all others need a word of licensing beside them.
UNMISTAKABLE = ("gpl", "lgpl", "agpl", "gfdl", "cddl", "eupl", "sspl", "wtfpl", "odbl", "cecill", "lppl")
#: Sentences of license texts and notices: label, pattern (a space stands for any white space), keyword.
SENTENCES = [
    ("mit", r"permission is hereby granted,? free of charge,? to any person", "hereby granted"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "permission notice"),
    ("isc", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software", "permission to use"),
    ("isc", r"the above copyright notice and this permission notice appear in all copies", "permission notice"),
    ("bsd", r"redistributions? and use in source and binary forms", "redistribution"),
    ("bsd", r"redistributions? of source code must retain the (?:above )?copyright notice", "redistribution"),
    ("bsd", r"redistributions? in binary form must reproduce the (?:above )?copyright notice", "redistribution"),
    ("bsd-2-clause", r"(?:simplified|2-clause|two-clause) bsd|bsd[ -]2[ -]clause", "bsd"),
    ("bsd-3-clause", r"(?:modified|new|revised|3-clause|three-clause) bsd|bsd[ -]3[ -]clause", "bsd"),
    ("bsd-3-clause", r"neither the names? of (?s:.{1,120}?) nor the names? of its contributors", "contributors"),
    ("bsd-4-clause", r"(?:original|4-clause|four-clause) bsd|bsd[ -]4[ -]clause", "bsd"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising materials"),
    ("apache-2", r"you may not use this (?:file|software|work) except in compliance with the licen[sc]e", "except in compliance"),
    ("apache-2", r"software distributed under the licen[sc]e is distributed on an .?as is.? basis", "distributed under the licen"),
    ("apache-2", r"grants? to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright", "royalty-free"),
    ("apache", r"this product includes software developed by the apache (?:software foundation|group)", "apache"),
    ("gpl", r"you can redistribute it and/or modify it under the terms of the gnu general public", "redistribute it"),
    ("lgpl", r"you can redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public", "redistribute it"),
    ("agpl", r"you can redistribute it and/or modify it under the terms of the gnu affero general public", "redistribute it"),
    ("gpl", r"the gnu general public licen[sc]e is a free, copyleft licen[sc]e", "copyleft"),
    ("agpl", r"your modified version must prominently offer all users interacting with it remotely", "prominently offer"),
    ("or-later", r"(?:either )?version [0-9](?:\.[0-9])? of the licen[sc]e,? or,? \(?at your option\)?,? any later version", "any later version"),
    ("gpl-linking-exception", r"as a special exception,? (?s:.{1,200}?) permission to link", "special exception"),
    ("classpath-exception", r"classpath[ -]exception", "classpath"),
    ("llvm-exception", r"with llvm[ -]exceptions?|llvm exceptions to the apache", "llvm"),
    ("gcc-exception", r"gcc runtime library exception", "runtime library"),
    ("gfdl", r"copy, distribute and/or modify this document under the terms of the gnu free documentation", "free documentation"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public", "source code form"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[sc]e version 1\.1", "mozilla"),
    ("epl", r"the accompanying materials are made available under the terms of the eclipse public", "accompanying materials"),
    ("cddl", r"subject to the terms of the common development and distribution", "common development"),
    ("ofl", r"this font software is licensed under the sil open font", "font software"),
    ("ofl", r"may not be sold by itself.{0,40}font software|font software.{0,60}may be sold by itself", "sold by itself"),
    ("bsl", r"to use, reproduce, display, distribute, execute, and transmit the software", "and transmit"),
    ("zlib", r"this software is provided .as-is.,? without any express or implied", "as-is"),
    ("zlib", r"altered source versions must be plainly marked as such", "plainly marked"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", r"you just do what the fuck you want to", "do what the"),
    ("beerware", r"the beer-?ware licen[sc]e|you can buy me a beer in return", "beer"),
    ("json", r"the software shall be used for good, not evil", "not evil"),
    ("openssl", r"this product includes software developed by the openssl project", "openssl"),
    ("php", r"this product includes php software", "php"),
    ("psf", r"psf hereby grants licensee a nonexclusive, royalty-free", "psf"),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", "the intent of this"),
    ("cc", r"creative commons corporation is not a law firm", "creative commons"),
    ("cc0", r"(?:cc0|creative commons zero)(?: 1\.0)?(?: universal)?", "c"),
    ("cc0", r"waives? all (?:of )?(?:his or her|its|their|my) copyright and related", "related"),
    ("busl-1.1", r"the licensor hereby grants you the right to copy, modify, create derivative works, redistribute", "the licensor"),
    ("commons-clause", r"commons clause licen[sc]e condition", "commons clause"),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain"),
    ("all-rights-reserved", r"all rights reserved", "all rights"),
    ("all-rights-reserved", r"(?:tous droits réservés|alle rechte vorbehalten|todos los derechos reservados)", "r"),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("proprietary", r"no part of this (?:work|publication|document|software) may be reproduced", "may be reproduced"),
]
#: Addresses of licenses: label, pattern, keyword.
ADDRESSES = [
    ("apache-2", r"apache\.org/licenses/license-2\.0", "apache.org"),
    ("apache-1.1", r"apache\.org/licenses/license-1\.1", "apache.org"),
    ("gpl-2", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0", "gnu.org"),
    ("gpl-3", r"gnu\.org/licenses/gpl-3\.0", "gnu.org"),
    ("gpl", r"gnu\.org/(?:licenses|copyleft)/gpl\.\w+", "gnu.org"),
    ("lgpl-2.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", "gnu.org"),
    ("lgpl-3", r"gnu\.org/licenses/lgpl-3\.0", "gnu.org"),
    ("lgpl", r"gnu\.org/(?:licenses|copyleft)/(?:lgpl|lesser)\.\w+", "gnu.org"),
    ("agpl-3", r"gnu\.org/licenses/agpl(?:-3\.0)?", "gnu.org"),
    ("gfdl", r"gnu\.org/(?:licenses|copyleft)/fdl", "gnu.org"),
    ("mpl-2", r"mozilla\.org/(?:en-us/)?mpl/2\.0", "mozilla.org"),
    ("mpl-1.1", r"mozilla\.org/mpl/(?:mpl-)?1\.1", "mozilla.org"),
    ("mpl", r"mozilla\.org/mpl/?(?![\w/])", "mozilla.org"),
    ("epl-2", r"eclipse\.org/legal/epl-2\.0|eclipse\.org/legal/epl-v20", "eclipse.org"),
    ("epl-1", r"eclipse\.org/legal/epl-v10", "eclipse.org"),
    ("mit", r"opensource\.org/licenses?/mit\b", "opensource.org"),
    ("isc", r"opensource\.org/licenses?/isc\b", "opensource.org"),
    ("zlib", r"opensource\.org/licenses?/zlib\b", "opensource.org"),
    ("bsd-2-clause", r"opensource\.org/licenses?/bsd-2-clause", "opensource.org"),
    ("bsd-3-clause", r"opensource\.org/licenses?/bsd-3-clause", "opensource.org"),
    ("bsl-1", r"boost\.org/license_1_0", "boost.org"),
    ("ofl", r"scripts\.sil\.org/ofl", "sil.org"),
    ("unlicense", r"unlicense\.org", "unlicense.org"),
    ("wtfpl", r"wtfpl\.net", "wtfpl.net"),
    ("cc0", r"creativecommons\.org/(?:publicdomain/zero/1\.0|licenses/cc0)", "creativecommons"),
    ("public-domain", r"creativecommons\.org/(?:publicdomain/mark|licenses/publicdomain)", "creativecommons"),
    ("odbl", r"opendatacommons\.org/licenses/odbl", "opendatacommons"),
    ("json", r"json\.org/license", "json.org"),
    ("php", r"php\.net/license", "php.net"),
    ("artistic", r"perlfoundation\.org/artistic[_-]license|dev\.perl\.org/licenses/artistic", "artistic"),
]
#: Verbs of a grant or a denial.
GRANTED = ("licensed", "released", "distributed", "available", "covered")
#: Creative Commons elements by their letters.
CREATIVE = {"by": "attribution", "nc": "non-?commercial", "sa": "share-?\\s?alike", "nd": "no-?\\s?derivatives?"}
CREATIVE_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
TERMS = r"(?:the\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+)?(?:the\s+)?"
GRANT = rf"\b(?:licensed|released|distributed|available)\s+under\s+{TERMS}"
#: What stands before an abbreviation that is meant as a license, and what may follow its name.
BEFORE = rf"(?:\b(?:licen[sc]ed?|terms|distributed|released|available)\s*(?:[:=]\s*|\(\s*|(?:is|under|of)\s+)?{TERMS})"
AFTER = r"(?=\s*(?:[.,;:)\"'\n]|licen[sc]e|terms|or\b|and\b|$))"
#: To the end of the sentence, or to a "but".
REST = r"(?s:(?:(?!\bbut\b|[.;](?:\s|$)).){1,120})"
DENIAL, TAG, SENTENCE, VERSIONED, ADDRESS, SHORT, NAMED = 110, 100, 95, 90, 85, 70, 50


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: re.Pattern


def spaced(pattern: str) -> str:
    """White space of any kind for the spaces of a sentence, also in a class."""
    return pattern.replace("[ -]", r"[\s-]").replace(" ", r"\s+")


def rules() -> list[Rule]:
    """All rules, in order; some hundreds, from the families and the forms."""
    made: list[tuple[str, int, str, str]] = []
    for label, name, versions, short, keyword in FAMILIES:
        made.append((label, NAMED, keyword, rf"\b{name}"))
        made.append((label, TAG, "spdx", rf"spdx-license-identifier:\s*{short}\b(?![-.]?\d)"))
        if keyword != "licen":
            made.append((label, SENTENCE - 1, keyword, rf"{GRANT}{name}"))
        made.append((label, SHORT + 4, short, rf"{GRANT}{short}{AFTER}"))
        made.append((label, SHORT + 4, short, rf"\blicen[sc]e\s*[:=]\s*[\"']?{short}{AFTER}"))
        for version in versions.split():
            number = rf"{re.escape(version)}" + (r"(?:\.0)?" if "." not in version else "") + r"(?![\d]|\.\d)"
            full = f"{label}-{version}"
            made.append((full, VERSIONED + 6, keyword, rf"(?:{GRANT})?\b{name},?\s*(?:\(\w+\)\s*)?,?\s*(?:version|ver\.?|v\.?)?\s*{number}"))
            made.append((full, TAG, "spdx", rf"spdx-license-identifier:\s*{short}-{number}(?:-only|-or-later|\+)?"))
            if short in UNMISTAKABLE:
                made.append((full, SHORT + 5, short, rf"\b{short}[\s-]?v?{number}"))
            else:
                made.append((full, SHORT + 5, short, rf"{BEFORE}{short}[\s-]?v?{number}"))
                made.append((full, SHORT + 5, short, rf"\b{short}[\s-]?v?{number}\s+licen[sc]ed?\b"))
            made.append((full, ADDRESS, "opensource.org", rf"opensource\.org/licenses?/{short}-{number}"))
    for kind in CREATIVE_KINDS:
        letters = kind.split("-")
        joined, words = r"[\s-]".join(letters), r"[\s,-]+".join(CREATIVE[x] for x in letters)
        end = r"(?![\s-](?:nc|sa|nd)\b)"
        made.append((f"cc-{kind}", SHORT, "cc", rf"\bcc[\s-]{joined}\b{end}"))
        made.append((f"cc-{kind}", NAMED, "creative commons", rf"\bcreative\s+commons\s+{words}\b"))
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            number = re.escape(version)
            made.append((f"cc-{kind}-{version}", VERSIONED, "cc", rf"\bcc[\s-]{joined}[\s-]v?{number}"))
            made.append((f"cc-{kind}-{version}", VERSIONED, "creative commons", rf"\bcreative\s+commons\s+{words}\s+{number}"))
            made.append((f"cc-{kind}-{version}", ADDRESS, "creativecommons", rf"creativecommons\.org/licenses/{kind}/{number}"))
    made += [(label, SENTENCE, keyword, spaced(pattern)) for label, pattern, keyword in SENTENCES]
    made += [(label, ADDRESS + 1, keyword, pattern) for label, pattern, keyword in ADDRESSES]
    for verb in GRANTED:
        made.append(("", DENIAL, f"{verb} under", rf"\b(?:not|never|no\s+longer|isn't|aren't)\s+(?:\w+\s+)?{verb}\s+under\s+{REST}"))
    ordered = sorted(made, key=lambda r: (-r[1], r[0], r[3]))
    return [Rule(label, priority, keyword, re.compile(pattern)) for label, priority, keyword, pattern in ordered]


class Scanner:
    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        by_keyword: dict[str, list[Rule]] = {}
        for rule in rules():
            by_keyword.setdefault(rule.keyword if len(rule.keyword) > 1 else "", []).append(rule)
        self.always = [r for r in by_keyword.pop("", [])]
        self.by_keyword = by_keyword
        for keyword in by_keyword:
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()

    def detections(self, lowered: str) -> list[tuple[int, int, Rule]]:
        """What is left of all detections (start, end, rule) after suppression, by start."""
        keywords = {k for _, k in self.automaton.iter(" ".join(lowered.split()))}
        found = []
        for rule in [r for k in sorted(keywords) for r in self.by_keyword[k]] + self.always:
            found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(lowered)]
        return suppressed(found)

    def base(self, words: list[str]) -> list[tuple[int, str]]:
        """Word numbers at which a base phrase starts, with its label."""
        found = []
        for phrase, label in BASE.items():
            wanted = phrase.split()
            rare = max(range(len(wanted)), key=lambda k: len(wanted[k]) if wanted[k] != "license" else 0)
            at = -1
            while True:
                try:
                    at = words.index(wanted[rare], at + 1)
                except ValueError:
                    break
                start = at - rare
                if start >= 0 and words[start : start + len(wanted)] == wanted:
                    found.append((start, label))
        return sorted(found)


def suppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Drop detections that lie inside one of higher priority, or of the same priority that is longer or comes first, and denials.

    Taken by priority, then length; those kept stay sorted by start with the furthest end so far, so one look tells.
    """
    kept: list[tuple[int, int, Rule]] = []
    furthest: list[tuple[int, int]] = []  # rising starts, rising ends
    from bisect import bisect_right

    for start, end, rule in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label)):
        k = bisect_right(furthest, (start, float("inf")))
        if k and furthest[k - 1][1] >= end:
            continue
        kept.append((start, end, rule))
        while k < len(furthest) and furthest[k][1] <= end:
            furthest.pop(k)
        furthest.insert(k, (start, end))
    return sorted((d for d in kept if d[2].label), key=lambda d: (d[0], -d[1], d[2].label))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs(doc_id, text)``. Null and empty texts have no words, no labels and score 0.

    ``score`` is 1 where a base phrase stands, else the greatest priority of a detection in hundredths.
    """

    def make() -> Callable[[dict], Iterable[dict]]:
        scanner = Scanner()

        def step(batch: dict) -> Iterable[dict]:
            out: dict[str, list] = {f.split()[0]: [] for f in DIGESTS.split(", ")}
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                lowered = (text or "").encode().lower().decode()  # A-Z only
                words = WORD.findall(lowered)
                base = scanner.base(words)
                found = scanner.detections(lowered)
                base_labels = {label for _, label in base}
                row = (
                    doc_id, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                    ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {r.label for _, _, r in found})),
                    1.0 if base else max((r.priority / 100 for _, _, r in found), default=0.0),
                )
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            yield out

        return step

    return map_batches(docs.select("doc_id", "text"), make, DIGESTS)
