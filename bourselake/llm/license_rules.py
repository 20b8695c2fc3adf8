"""Signature rules for licence notices, on words in lower case joined by spaces."""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    """One signature; a lower priority number wins where detections overlap."""

    name: str
    label: str
    keyword: str
    priority: int
    score: float
    pattern: re.Pattern


# The phrases that count as base detections, with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Licence names: label, a word any notice must have, SPDX words, spoken name, version.
# A version follows the name, in words: "version 2 0" or "v2 0" or "2 0". A label with a
# version needs it in the text; one without takes any of its versions, or none.
FAMILIES = (
    ("agpl", "affero", "agpl", r"(?:gnu )?affero general public licen[cs]e", ""),
    ("agpl-3.0", "affero", "agpl 3 0", r"(?:gnu )?affero general public licen[cs]e", "3(?: 0)?"),
    ("lgpl-2.1", "lesser", "lgpl 2 1", r"(?:gnu )?lesser general public licen[cs]e", "2 1"),
    ("lgpl-3.0", "lesser", "lgpl 3 0", r"(?:gnu )?lesser general public licen[cs]e", "3(?: 0)?"),
    ("lgpl", "lesser", "lgpl", r"(?:gnu )?lesser general public licen[cs]e", ""),
    ("lgpl", "library", "lgpl", r"(?:gnu )?library general public licen[cs]e", ""),
    ("lgpl-2.0", "library", "lgpl 2 0", r"(?:gnu )?library general public licen[cs]e", "2(?: 0)?"),
    ("gpl-1.0", "general", "gpl 1 0", r"(?:gnu )?general public licen[cs]e", "1(?: 0)?"),
    ("gpl-2.0", "general", "gpl 2 0", r"(?:gnu )?general public licen[cs]e", "2(?: 0)?"),
    ("gpl-3.0", "general", "gpl 3 0", r"(?:gnu )?general public licen[cs]e", "3(?: 0)?"),
    ("gpl", "general", "gpl", r"(?:gnu )?general public licen[cs]e", ""),
    ("gfdl-1.3", "documentation", "gfdl 1 3", r"gnu free documentation licen[cs]e", "1 3"),
    ("gfdl", "documentation", "gfdl", r"gnu free documentation licen[cs]e", ""),
    ("apache-1.1", "apache", "apache 1 1", r"apache(?: software)? licen[cs]e", "1 1"),
    ("apache-2.0", "apache", "apache 2 0", r"apache(?: software)? licen[cs]e", "2(?: 0)?"),
    ("apache", "apache", "apache", r"apache(?: software)? licen[cs]e", ""),
    ("mit", "mit", "mit", r"mit(?: x11| expat)? licen[cs]e", ""),
    ("mit-0", "attribution", "mit 0", r"mit no attribution licen[cs]e", ""),
    ("bsd-2-clause", "bsd", "bsd 2 clause", r"(?:2 clause|simplified) bsd licen[cs]e", ""),
    ("bsd-3-clause", "bsd", "bsd 3 clause", r"(?:3 clause|new|modified) bsd licen[cs]e", ""),
    ("bsd-4-clause", "bsd", "bsd 4 clause", r"(?:4 clause|original) bsd licen[cs]e", ""),
    ("bsd", "bsd", "bsd", r"bsd(?: style)? licen[cs]e", ""),
    ("isc", "isc", "isc", r"isc licen[cs]e", ""),
    ("zlib", "zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", ""),
    ("boost", "boost", "bsl", r"boost software licen[cs]e", ""),
    ("boost-1.0", "boost", "bsl 1 0", r"boost software licen[cs]e", "1(?: 0)?"),
    ("mpl-1.1", "mozilla", "mpl 1 1", r"mozilla public licen[cs]e", "1 1"),
    ("mpl-2.0", "mozilla", "mpl 2 0", r"mozilla public licen[cs]e", "2(?: 0)?"),
    ("mpl", "mozilla", "mpl", r"mozilla public licen[cs]e", ""),
    ("epl", "eclipse", "epl", r"eclipse public licen[cs]e", ""),
    ("epl-1.0", "eclipse", "epl 1 0", r"eclipse public licen[cs]e", "1(?: 0)?"),
    ("epl-2.0", "eclipse", "epl 2 0", r"eclipse public licen[cs]e", "2(?: 0)?"),
    ("cddl", "development", "cddl", r"common development and distribution licen[cs]e", ""),
    ("cddl-1.0", "development", "cddl 1 0", r"common development and distribution licen[cs]e", "1(?: 0)?"),
    ("artistic", "artistic", "artistic", r"(?:perl )?artistic licen[cs]e", ""),
    ("artistic-1.0", "artistic", "artistic 1 0", r"(?:perl )?artistic licen[cs]e", "1(?: 0)?"),
    ("artistic-2.0", "artistic", "artistic 2 0", r"(?:perl )?artistic licen[cs]e", "2(?: 0)?"),
    ("eupl", "union", "eupl", r"european union public licen[cs]e", ""),
    ("eupl-1.1", "union", "eupl 1 1", r"european union public licen[cs]e", "1 1"),
    ("eupl-1.2", "union", "eupl 1 2", r"european union public licen[cs]e", "1 2"),
    ("python", "python", "psf", r"python software foundation licen[cs]e", ""),
    ("python-2.0", "python", "python 2 0", r"python software foundation licen[cs]e", "2(?: 0)?"),
    ("postgresql", "postgresql", "postgresql", r"postgresql licen[cs]e", ""),
    ("unlicense", "unlicense", "unlicense", r"unlicense", ""),
    ("wtfpl", "fuck", "wtfpl", r"do what the fuck you want to public licen[cs]e", ""),
    ("ofl", "font", "ofl", r"sil open font licen[cs]e", ""),
    ("ofl-1.1", "font", "ofl 1 1", r"sil open font licen[cs]e", "1 1"),
    ("odbl", "database", "odbl", r"open database licen[cs]e", ""),
    ("odbl-1.0", "database", "odbl 1 0", r"open database licen[cs]e", "1(?: 0)?"),
    ("cc0", "cc0", "cc0", r"cc0(?: universal)?", ""),
    ("cc0-1.0", "cc0", "cc0 1 0", r"cc0(?: universal)?", "1(?: 0)?"),
    ("cc-by", "cc", "cc by", r"cc by(?: licen[cs]e)?", "[1-4] [05]"),
    ("cc-by-sa", "cc", "cc by sa", r"cc by sa(?: licen[cs]e)?", "[1-4] [05]"),
    ("cc-by-nd", "cc", "cc by nd", r"cc by nd(?: licen[cs]e)?", "[1-4] [05]"),
    ("cc-by-nc", "cc", "cc by nc", r"cc by nc(?: licen[cs]e)?", "[1-4] [05]"),
    ("cc-by-nc-sa", "cc", "cc by nc sa", r"cc by nc sa(?: licen[cs]e)?", "[1-4] [05]"),
    ("cc-by-nc-nd", "cc", "cc by nc nd", r"cc by nc nd(?: licen[cs]e)?", "[1-4] [05]"),
    ("cc-by", "commons", "cc by", r"creative commons attribution(?: licen[cs]e)?", "[1-4] [05]"),
    (
        "cc-by-sa", "commons", "cc by sa",
        r"creative commons attribution share ?alike(?: licen[cs]e)?", "[1-4] [05]",
    ),
    (
        "cc-by-nc", "commons", "cc by nc",
        r"creative commons attribution non ?commercial(?: licen[cs]e)?", "[1-4] [05]",
    ),
)

# Statements around a name: rule name, priority, score, words before and after it.
STATEMENTS = (
    ("licensed", 10, 1.0, r"(?:is |are )?licen[cs]ed (?:to you )?under (?:the )?(?:terms of )?(?:the )?", ""),
    ("released", 11, 0.95, r"(?:released|published|available) under (?:the )?(?:terms of )?(?:the )?", ""),
    ("distributed", 12, 0.95, r"(?:re)?distribut\w+ (?:it )?under (?:the )?(?:terms of )?(?:the )?", ""),
    ("governed", 13, 0.9, r"(?:subject to|governed by) (?:the )?(?:terms of )?(?:the )?", ""),
    ("see", 14, 0.8, r"(?:see|copy of) (?:the )?", r"(?: for (?:more )?details)?"),
    ("name", 30, 0.6, "", ""),
)

# Short names: label, keyword, words. Glued versions are words of their own.
SHORT = (
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl (?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl (?:version |v ?)?3(?: 0)?"),
    ("gpl-2.0", "gplv2", r"(?:gnu )?gplv2"),
    ("gpl-3.0", "gplv3", r"(?:gnu )?gplv3"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl (?:version |v ?)?2 1"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl (?:version |v ?)?3(?: 0)?"),
    ("lgpl-3.0", "lgplv3", r"(?:gnu )?lgplv3"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl (?:version |v ?)?3(?: 0)?"),
    ("agpl-3.0", "agplv3", r"(?:gnu )?agplv3"),
    ("mpl", "mpl", r"mpl"),
    ("mpl-1.1", "mpl", r"mpl (?:version |v ?)?1 1"),
    ("mpl-2.0", "mpl", r"mpl (?:version |v ?)?2(?: 0)?"),
    ("epl", "epl", r"epl"),
    ("epl-1.0", "epl", r"epl (?:version |v ?)?1(?: 0)?"),
    ("epl-2.0", "epl", r"epl (?:version |v ?)?2(?: 0)?"),
    ("apache-2.0", "asl", r"asl (?:version |v ?)?2(?: 0)?"),
    ("eupl-1.2", "eupl", r"eupl (?:version |v ?)?1 2"),
)

# Passages of notices and licence texts, as they read in words: label, keyword, words.
PASSAGES = (
    # MIT and its relatives
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "merge", r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", r"including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "authors", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("isc", "purpose", r"permission to use copy modify and or distribute this software for any purpose"),
    ("isc", "disclaims", r"the author disclaims all warranties with regard to this software"),
    ("hpnd", "supporting", r"both that copyright notice and this permission notice appear in supporting documentation"),
    ("hpnd", "publicity", r"not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission"),
    ("ntp", "fee", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and|with or) without fee"),
    ("postgresql", "agreement", r"without fee and without a written agreement is hereby granted"),
    ("curl", "dealings", r"shall not be used in advertising or otherwise to promote the sale use or other dealings in this software"),
    # BSD
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd", "reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", r"neither the name of .{1,80}? may be used to endorse or promote products"),
    ("bsd-4-clause", "acknowledgement", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", "procurement", r"procurement of substitute goods or services loss of use data or profits or business interruption"),
    # GNU
    ("gpl", "redistribute", r"free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2.0", "published", r"general public license as published by the free software foundation (?:either )?version 2(?: 0)?"),
    ("gpl-3.0", "published", r"general public license as published by the free software foundation (?:either )?version 3(?: 0)?"),
    ("lgpl", "lesser", r"modify it under the terms of the gnu lesser general public license"),
    ("lgpl-2.1", "lesser", r"lesser general public license as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-3.0", "lesser", r"lesser general public license as published by the free software foundation (?:either )?version 3(?: 0)?"),
    ("lgpl-2.0", "library", r"library general public license as published by the free software foundation (?:either )?version 2(?: 0)?"),
    ("agpl", "affero", r"modify it under the terms of the gnu affero general public license"),
    ("agpl-3.0", "affero", r"affero general public license as published by the free software foundation (?:either )?version 3(?: 0)?"),
    ("gpl", "gnu", r"you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "lesser", r"you should have received a copy of the gnu lesser general public license along with this"),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public license along with this program"),
    ("gpl", "gnu", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("lgpl", "lesser", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license"),
    ("gpl", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl-2.0", "freedom", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "copyleft", r"free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community"),
    ("lgpl-3.0", "incorporates", r"incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions"),
    ("gfdl", "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gpl-classpath-exception", "exception", r"as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("gpl-linking-exception", "exception", r"gpl (?:2 0 |v2 )?with (?:the )?classpath exception"),
    # Apache
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "licenses", r"apache org licenses license 2 0"),
    ("apache-2.0", "express", r"distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2.0", "limitations", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "contributor", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "worldwide", r"perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce"),
    ("apache-1.1", "apache", r"this product includes software developed by the apache (?:software foundation|group)"),
    # Mozilla, Eclipse and others with file-level copyleft
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "incompatible", r"this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", "mpl", r"mpl 1 1 gpl 2 0 lgpl 2 1"),
    ("epl-1.0", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public license v(?:ersion)? ?1 0"),
    ("epl-2.0", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v ?)?2 0"),
    ("cddl", "development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl-1.0", "common", r"common public license (?:version |v ?)?1 0"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("eupl", "eupl", r"licensed under the eupl"),
    ("osl-3.0", "open", r"open software licen[cs]e (?:version |v ?)?3 0"),
    ("afl-3.0", "academic", r"academic free licen[cs]e (?:version |v ?)?3 0"),
    ("npl", "netscape", r"netscape public licen[cs]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[cs]e"),
    ("qpl", "q", r"q public licen[cs]e"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("ssleay", "eric", r"this product includes cryptographic software written by eric young"),
    ("ruby", "ruby", r"under the same terms as ruby"),
    ("perl", "perl", r"under the same terms as perl itself"),
    ("php", "php", r"this product includes php software"),
    ("vim", "vim", r"vim licen[cs]e"),
    ("tcl", "tcl", r"tcl tk licen[cs]e"),
    ("imagemagick", "imagemagick", r"imagemagick licen[cs]e"),
    ("libpng", "misrepresented", r"the origin of this source code must not be misrepresented"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "warranty", r"this software is provided as is without any express or implied warranty"),
    ("ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", "freetype", r"portions of this software are copyright .{1,40}? the freetype project"),
    ("unicode", "unicode", r"unicode inc licen[cs]e agreement data files and software"),
    ("w3c", "w3c", r"w3c software (?:and document )?notice and licen[cs]e"),
    ("boost-1.0", "hereby", r"permission is hereby granted free of charge to any person or organization"),
    ("beerware", "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    # Dedications, content and data
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "detriment", r"we make this dedication for the benefit of the public at large and to the detriment of our heirs"),
    ("cc0-1.0", "waived", r"has waived all copyright and related or neighboring rights"),
    ("cc0", "creative", r"creative commons (?:cc0|zero)"),
    ("cc0-1.0", "creative", r"creative commons (?:cc0|zero) 1 0(?: universal)?"),
    ("public-domain", "domain", r"(?:dedicated to|placed in|released into) the public domain"),
    ("public-domain", "domain", r"(?:this (?:file|work|code|software) )?is (?:hereby )?(?:in|of) the public domain"),
    ("cc-by", "attribution", r"this work is licensed under a creative commons attribution (?:[1-4] [05] )?(?:international|unported|generic)"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("odc-by", "attribution", r"open data commons attribution licen[cs]e"),
    ("pddl", "dedication", r"public domain dedication and licen[cs]e"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license"),
    ("ogl-3.0", "government", r"open government licen[cs]e v(?:ersion)? ?3 0"),
    ("cdla-permissive", "community", r"community data licen[cs]e agreement permissive"),
    ("cdla-sharing", "community", r"community data licen[cs]e agreement sharing"),
    # Several at once
    ("dual-mit-apache", "dual", r"dual licensed under (?:the )?(?:apache(?: license)?(?: version)?(?: 2 0)? and mit|mit and apache(?: license)?(?: 2 0)?)"),
    ("dual-mit-apache", "either", r"licensed under either of (?:the )?apache license version 2 0"),
    ("dual", "option", r"licensed under (?:either|any) of .{1,160}? at your option"),
    # Source-available and closed
    ("sspl-1.0", "server", r"server side public licen[cs]e"),
    ("busl-1.1", "business", r"business source licen[cs]e(?: 1 1)?"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e(?: 2 0)?"),
    ("commons-clause", "commons", r"commons clause licen[cs]e condition"),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|strict) licen[cs]e"),
    ("non-commercial", "commercial", r"(?:for|free for) non ?commercial (?:use|purposes) only"),
    ("research-only", "research", r"for (?:academic |non commercial )?research (?:use|purposes) only"),
    ("evaluation", "evaluation", r"for evaluation purposes only"),
    ("proprietary", "reserved", r"all rights (?:are )?reserved"),
    ("proprietary", "confidential", r"(?:proprietary and )?confidential (?:information )?(?:of|do not distribute)"),
    ("proprietary", "strictly", r"unauthorized (?:copying|reproduction|distribution) .{1,80}? is strictly prohibited"),
    ("proprietary", "contains", r"contains (?:proprietary|confidential) (?:and trade secret )?information"),
    ("proprietary", "eula", r"end user licen[cs]e agreement eula"),
    ("proprietary", "reproduced", r"no part of this (?:publication|work|document|book) may be reproduced"),
    ("proprietary", "permission", r"may not be (?:copied|reproduced|redistributed)(?: or distributed)? without (?:the )?(?:prior )?(?:written |express )?permission"),
)


def _compile(words: str) -> re.Pattern:
    return re.compile(f"(?<= )(?:{words})(?= )")


def build() -> list[Rule]:
    """All rules in order of priority: every statement and SPDX tag of every family."""
    rules = []
    for label, keyword, spdx, name, version in FAMILIES:
        named = label.rpartition("-")[2].replace(".", "").isdigit() and version
        tail = f"(?: (?:version |v ?)?{version})" if version else ""
        tail += "?" if version and not named else ""
        tail += "(?: or (?:any )?later(?: version)?)?"
        tag = rf"spdx licen[cs]e identifier {spdx}(?: only| or later)?"
        rules.append(Rule(f"{label}:spdx", label, "spdx", 0, 1.0, _compile(tag)))
        for statement, priority, score, before, after in STATEMENTS:
            # A name with a version says more than the bare name.
            rules.append(
                Rule(
                    f"{label}:{statement}",
                    label,
                    keyword,
                    priority - (1 if named else 0),
                    score,
                    _compile(before + name + tail + after),
                )
            )
    for label, keyword, words in SHORT:
        versioned = label[-1].isdigit()
        rules.append(Rule(f"{label}:short:{keyword}", label, keyword, 31 - versioned, 0.6, _compile(words)))
        for statement, priority, score, before, after in STATEMENTS[:-1]:
            spoken = before + words + "(?: or (?:any )?later(?: version)?)?(?: licen[cs]e)?" + after
            rules.append(
                Rule(f"{label}:{statement}:{keyword}", label, keyword, priority - versioned, score, _compile(spoken))
            )
    for label, keyword, words in PASSAGES:
        rules.append(Rule(f"{label}:passage", label, keyword, 5, 0.9, _compile(words)))
    return sorted(rules, key=lambda r: (r.priority, r.name, r.pattern.pattern))
