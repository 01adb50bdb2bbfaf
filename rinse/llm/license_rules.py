"""License scans by ordered signature rules.

A rule is a regular expression over a text's words joined by single spaces, with a label, a priority and a keyword:
the rule runs only where its keyword stands. A detection is dropped where one of a higher priority, or a longer one of
the same priority, contains its interval of words, so that "gnu lesser general public license version 2 1" is not
reported as other licenses that its words hold.

Words are stretches of letters, digits and characters over 127, with A-Z as a-z. Null and empty texts have no words
and no detections; score is then 0. Long texts are scanned whole. Repeated rows are scanned each by itself.

The score of the query is the largest priority among the detections that are kept, in hundredths, and 0 without one.

`BASE` names phrases of which every place is counted, whatever the rules say.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Phrase and label.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int  # 0 to 100, also how sure a detection is
    keyword: str
    pattern: str


def _family(label: str, keyword: str, *patterns: tuple[int, str]) -> list[Rule]:
    return [Rule(label, priority, keyword, pattern) for priority, pattern in patterns]


_GRANT = "(?:licensed|released|distributed|available|provided|published|covered)"


def _hand_written() -> list[Rule]:
    """Rules by the wording of notices, from full texts (high) to mentions (low)."""
    rules = []
    rules += _family("mit", "mit",
        (60, "(?:the )?mit licen[sc]e"), (70, f"{_GRANT} under (?:the )?(?:terms of )?(?:the )?mit(?: x11)?(?: licen[sc]e)?"),
        (75, "spdx license identifier mit"), (55, "mit style licen[sc]e"), (55, "mit x11"), (65, "license mit"))
    rules += _family("mit", "expat", (50, "expat licen[sc]e"))
    rules += _family("mit", "permission",
        (95, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: \\S+){0,80}? the software is provided as is"),
        (85, "permission is hereby granted free of charge to any person obtaining a copy"))
    rules += _family("isc", "permission",
        (90, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"))
    rules += _family("isc", "isc", (60, "isc licen[sc]e"), (75, "spdx license identifier isc"))
    rules += _family("bsd", "redistribution",
        (90, "redistribution and use in source and binary forms with or without modification are permitted"))
    rules += _family("bsd", "bsd",
        (60, "bsd licen[sc]e"), (65, f"{_GRANT} under (?:the )?(?:terms of )?(?:a |the )?bsd(?: style)?(?: licen[sc]e)?"), (55, "bsd style licen[sc]e"))
    rules += _family("bsd-0-clause", "0bsd", (75, "0bsd"))
    rules += _family("bsd-0-clause", "bsd", (75, "zero clause bsd"), (75, "bsd (?:0|zero) clause"))
    rules += _family("bsd-2-clause", "bsd", (78, "bsd (?:2|two) clause(?: licen[sc]e)?"), (78, "(?:2|two) clause bsd(?: licen[sc]e)?"), (75, "simplified bsd licen[sc]e"), (75, "freebsd licen[sc]e"))
    rules += _family("bsd-3-clause", "bsd", (78, "bsd (?:3|three) clause(?: licen[sc]e)?"), (78, "(?:3|three) clause bsd(?: licen[sc]e)?"), (75, "(?:new|modified|revised) bsd licen[sc]e"))
    rules += _family("bsd-4-clause", "bsd", (78, "bsd (?:4|four) clause(?: licen[sc]e)?"), (78, "(?:4|four) clause bsd(?: licen[sc]e)?"), (75, "(?:original|old) bsd licen[sc]e"))
    rules += _family("bsd-3-clause", "endorse", (88, "neither the name of(?: \\S+){1,12}? may be used to endorse or promote products"))
    rules += _family("bsd-4-clause", "advertising", (88, "all advertising materials mentioning features or use of this software must display"))
    rules += _family("apache", "apache",
        (60, "apache licen[sc]e"), (65, f"{_GRANT} under (?:the )?(?:terms of )?(?:the )?apache(?: software)?(?: licen[sc]e)?"), (58, "apache software licen[sc]e"))
    rules += _family("apache-2.0", "asl", (55, "asl 2 0"))
    rules += _family("apache-2.0", "apache",
        (80, "apache licen[sc]e v(?:ersion )?2(?: 0)?"), (80, "apache licen[sc]e 2(?: 0)?"), (80, "apache 2(?: 0)?(?: licen[sc]e)?"),
        (92, "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
        (90, "http www apache org licenses license 2 0"), (85, "spdx license identifier apache 2 0"))
    rules += _family("gpl", "gpl", (60, "gnu gpl"), (65, f"{_GRANT} under (?:the )?(?:terms of )?(?:the )?(?:gnu )?gpl"), (55, "gpl compatible"), (55, "gpl licen[sc]ed"), (55, "under gpl"))
    rules += _family("gpl", "general",
        (62, "gnu general public licen[sc]e"), (60, "general public licen[sc]e"),
        (88, "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"))
    rules += _family("gpl", "gnu", (55, "gnu public licen[sc]e"))
    rules += _family("lgpl", "lesser", (72, "(?:gnu )?lesser (?:gnu )?general public licen[sc]e"), (90, "under the terms of the gnu lesser general public license as published by the free software foundation"))
    rules += _family("lgpl", "library", (72, "(?:gnu )?library (?:gnu )?general public licen[sc]e"))
    rules += _family("lgpl", "lgpl", (60, "lgpl"), (65, f"{_GRANT} under (?:the )?(?:gnu )?lgpl"))
    rules += _family("agpl", "affero", (74, "(?:gnu )?affero (?:gnu )?general public licen[sc]e"), (55, "affero licen[sc]e"))
    rules += _family("agpl", "agpl", (60, "agpl"), (65, f"{_GRANT} under (?:the )?(?:gnu )?agpl"))
    rules += _family("gfdl", "documentation", (74, "(?:gnu )?free documentation licen[sc]e"), (88, "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"))
    rules += _family("gfdl", "gfdl", (60, "gfdl"))
    rules += _family("mpl", "mozilla", (62, "mozilla public licen[sc]e"), (90, "this source code form is subject to the terms of the mozilla public license"))
    rules += _family("mpl", "mpl", (55, "mpl licen[sc]ed?"), (60, f"{_GRANT} under (?:the )?mpl"))
    rules += _family("epl", "eclipse", (62, "eclipse public licen[sc]e"), (85, "this program and the accompanying materials are made available under the terms of the eclipse public license"))
    rules += _family("edl", "eclipse", (62, "eclipse distribution licen[sc]e"))
    rules += _family("cddl", "common", (66, "common development and distribution licen[sc]e"))
    rules += _family("cddl", "cddl", (55, "cddl"))
    rules += _family("cpl", "common", (64, "common public licen[sc]e"))
    rules += _family("eupl", "european", (66, "european union public licen[sc]e"))
    rules += _family("eupl", "eupl", (55, "eupl"))
    rules += _family("artistic", "artistic", (62, "artistic licen[sc]e"), (70, "perl artistic licen[sc]e"))
    rules += _family("artistic", "perl", (72, "same terms as perl itself"))
    rules += _family("zlib", "zlib", (62, "zlib licen[sc]e"), (62, "zlib libpng licen[sc]e"), (60, "spdx license identifier zlib"))
    rules += _family("zlib", "altered", (86, "altered source versions must be plainly marked as such and must not be misrepresented"))
    rules += _family("boost", "boost", (66, "boost software licen[sc]e"), (60, "boost licen[sc]e"))
    rules += _family("boost", "spdx", (70, "spdx license identifier bsl 1 0"))
    rules += _family("unlicense", "unlicense", (66, "the unlicense"), (60, "unlicense(?: org)?"))
    rules += _family("unlicense", "unencumbered", (90, "this is free and unencumbered software released into the public domain"))
    rules += _family("wtfpl", "wtfpl", (60, "wtfpl"))
    rules += _family("wtfpl", "fuck", (80, "do what the fuck you want to public licen[sc]e"))
    rules += _family("public-domain", "domain", (50, "public domain"), (60, "(?:released|placed|dedicated) (?:in|into|to) the public domain"))
    rules += _family("psf", "python", (66, "python software foundation licen[sc]e(?: version 2)?"))
    rules += _family("psf", "psf", (55, "psf licen[sc]e"))
    rules += _family("php", "php", (62, "php licen[sc]e(?: version 3 01)?"))
    rules += _family("ruby", "ruby", (60, "ruby licen[sc]e"), (66, "same terms as ruby itself"))
    rules += _family("openssl", "openssl", (64, "openssl licen[sc]e"))
    rules += _family("ofl", "font", (70, "sil open font licen[sc]e(?: version 1 1)?"), (62, "open font licen[sc]e"))
    rules += _family("odbl", "database", (68, "open database licen[sc]e"), (68, "open data commons open database licen[sc]e"))
    rules += _family("odc-by", "commons", (68, "open data commons attribution licen[sc]e"))
    rules += _family("pddl", "domain", (72, "public domain dedication and licen[sc]e"))
    rules += _family("ms-pl", "microsoft", (66, "microsoft public licen[sc]e"))
    rules += _family("ms-rl", "microsoft", (66, "microsoft reciprocal licen[sc]e"))
    rules += _family("bsl", "business", (66, "business source licen[sc]e"))
    rules += _family("sspl", "server", (66, "server side public licen[sc]e"))
    rules += _family("elastic", "elastic", (64, "elastic licen[sc]e(?: 2 0)?"))
    rules += _family("upl", "universal", (66, "universal permissive licen[sc]e"))
    rules += _family("ncsa", "ncsa", (64, "(?:university of illinois )?ncsa open source licen[sc]e"))
    rules += _family("postgresql", "postgresql", (64, "postgresql licen[sc]e"))
    rules += _family("creative-commons", "creative", (50, "creative commons"), (55, "creative commons licen[sc]e"))
    rules += _family("proprietary", "rights", (30, "all rights reserved"))
    rules += _family("proprietary", "proprietary", (40, "proprietary and confidential"), (40, "proprietary licen[sc]e"), (35, "proprietary software"))
    rules += _family("proprietary", "copying", (40, "unauthori[sz]ed copying of this file via any medium is strictly prohibited"))
    rules += _family("commercial", "commercial", (35, "commercial licen[sc]e"))
    rules += _family("eula", "end", (45, "end user licen[sc]e agreement"))
    rules += _clauses() + _exceptions() + _others()
    return rules


def _clauses() -> list[Rule]:
    """Sentences from the bodies of licenses, which stand without the name of the license."""
    rules = []
    rules += _family("mit", "copyright",
        (70, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"))
    rules += _family("mit", "noninfringement", (60, "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable"))
    rules += _family("isc", "author", (60, "the software is provided as is and the author disclaims all warranties with regard to this software"))
    rules += _family("bsd", "redistributions",
        (75, "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
        (75, "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"))
    rules += _family("bsd", "holders", (62, "this software is provided by the copyright holders and contributors as is and any express or implied warranties"))
    rules += _family("bsd", "regents", (66, "this software is provided by the regents and contributors as is"))
    rules += _family("apache-2.0", "apache", (84, "you may obtain a copy of the license at(?: http| https)? www apache org licenses license 2 0"))
    rules += _family("apache", "applicable", (58, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"))
    rules += _family("apache-2.0", "contributor", (72, "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"))
    rules += _family("gpl", "hope", (70, "this program is distributed in the hope that it will be useful but without any warranty"))
    rules += _family("gpl", "copyleft", (66, "the gnu general public license is a free copyleft license for software"))
    rules += _family("gpl", "program", (72, "you should have received a copy of the gnu general public license along with this program"))
    rules += _family("gpl", "option", (64, "either version [23] of the license or at your option any later version"))
    rules += _family("lgpl", "lesser", (76, "you should have received a copy of the gnu lesser general public license along with this (?:library|program)"))
    rules += _family("lgpl", "library", (74, "this library is free software you can redistribute it and or modify it"))
    rules += _family("agpl", "affero", (78, "you should have received a copy of the gnu affero general public license along with this program"))
    rules += _family("agpl", "remotely", (70, "users interacting with it remotely through a computer network"))
    rules += _family("mpl-2.0", "mozilla", (88, "if a copy of the mpl was not distributed with this file you can obtain one at(?: http| https)? mozilla org mpl 2 0"))
    rules += _family("mpl-1.1", "mozilla", (84, "the contents of this file are subject to the mozilla public license version 1 1"))
    rules += _family("epl-1.0", "eclipse", (86, "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"))
    rules += _family("epl-2.0", "eclipse", (86, "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"))
    rules += _family("cddl", "common", (80, "the contents of this file are subject to the terms of the common development and distribution license"))
    rules += _family("zlib", "misrepresented", (84, "the origin of this software must not be misrepresented you must not claim that you wrote the original software"))
    rules += _family("zlib", "warranty", (70, "this software is provided as is without any express or implied warranty in no event will the authors be held liable"))
    rules += _family("boost", "boost", (84, "distributed under the boost software license version 1 0"))
    rules += _family("unlicense", "compile", (86, "anyone is free to copy modify publish use compile sell or distribute this software"))
    rules += _family("unlicense", "unlicense", (84, "for more information please refer to(?: http| https)? unlicense org"))
    rules += _family("ofl", "reserved", (72, "reserved font name(?: \\S+){1,6}? this font software is licensed under the sil open font license"))
    rules += _family("cc0", "deed", (84, "the person who associated a work with this deed has dedicated the work to the public domain"))
    rules += _family("cc0", "creative", (72, "creative commons zero(?: v1 0)?(?: universal)?"))
    rules += _family("beerware", "beer", (80, "you can buy me a beer in return"))
    rules += _family("beerware", "beerware", (66, "beerware licen[sc]e"))
    rules += _family("hpnd", "documentation", (72, "permission to use copy modify and distribute this software and its documentation for any purpose(?: and without fee)? is hereby granted"))
    rules += _family("proprietary", "confidential", (42, "this document contains confidential information"), (42, "strictly private and confidential"))
    rules += _family("proprietary", "permission", (42, "may not be reproduced(?: or distributed)? without(?: the)?(?: prior)?(?: express)?(?: written)? permission"), (40, "no part of this publication may be reproduced(?: \\S+){0,20}? permission"))
    rules += _family("proprietary", "personal", (38, "for personal use only"), (42, "for personal and non commercial use only"))
    rules += _family("proprietary", "trade", (44, "trade secrets? of(?: \\S+){1,4}? and may not be disclosed"))
    return rules


def _exceptions() -> list[Rule]:
    """Exceptions that go with a license."""
    rules = []
    rules += _family("gpl-with-classpath-exception", "classpath", (78, "classpath exception(?: 2 0)?"), (86, "gpl(?: 2 0| v2| version 2)? with (?:the )?classpath exception"))
    rules += _family("gpl-with-gcc-exception", "gcc", (78, "gcc runtime library exception(?: version 3 1)?"), (80, "gpl with (?:the )?gcc(?: runtime library)? exception"))
    rules += _family("gpl-with-font-exception", "font", (76, "gpl(?: 2 0| v2| version 2)? with (?:the )?font exception"))
    rules += _family("gpl-with-bison-exception", "bison", (76, "gpl(?: 2 0| v2| version 2)? with (?:the )?bison exception"))
    rules += _family("gpl-with-autoconf-exception", "autoconf", (76, "gpl(?: 2 0| 3 0| v2| v3)? with (?:the )?autoconf exception"))
    rules += _family("gpl-with-linking-exception", "linking", (74, "gpl with (?:a |the )?linking exception"), (78, "linking this library statically or dynamically with other modules"))
    rules += _family("apache-with-llvm-exception", "llvm", (84, "apache(?: licen[sc]e)?(?: v| version)? ?2 0 with llvm exceptions?"))
    rules += _family("gpl-with-foss-exception", "foss", (72, "foss licen[sc]e exception"), (70, "universal foss exception"))
    rules += _family("lgpl-with-static-linking-exception", "lgpl", (74, "lgpl with (?:a |the )?static linking exception"))
    rules += _family("gpl-with-syscall-note", "syscall", (78, "linux syscall note"), (80, "gpl 2 0 with linux syscall note"))
    return rules


def _others() -> list[Rule]:
    """Less frequent licenses by their names."""
    rules = []
    rules += _family("afl", "academic", (66, "academic free licen[sc]e(?: v| version)?(?: [123] [012])?"))
    rules += _family("osl", "open", (66, "open software licen[sc]e(?: v| version)?(?: [123] [012])?"))
    rules += _family("qpl", "public", (64, "q public licen[sc]e(?: version 1 0)?"))
    rules += _family("ipl", "ibm", (66, "ibm public licen[sc]e(?: version 1 0)?"))
    rules += _family("lppl", "latex", (68, "latex project public licen[sc]e(?: version 1 3c?)?"))
    rules += _family("lppl", "lppl", (58, "lppl(?: 1 3c?)?"))
    rules += _family("npl", "netscape", (66, "netscape public licen[sc]e(?: version 1 [01])?"))
    rules += _family("spl", "sun", (66, "sun public licen[sc]e(?: version 1 0)?"))
    rules += _family("sissl", "sun", (68, "sun industry standards source licen[sc]e"))
    rules += _family("apsl", "apple", (66, "apple public source licen[sc]e(?: version [12] [012])?"))
    rules += _family("rpl", "reciprocal", (64, "reciprocal public licen[sc]e(?: 1 [15])?"))
    rules += _family("ecl", "educational", (66, "educational community licen[sc]e(?: version [12] 0)?"))
    rules += _family("efl", "eiffel", (64, "eiffel forum licen[sc]e(?: version [12])?"))
    rules += _family("fair", "fair", (50, "fair licen[sc]e"))
    rules += _family("sleepycat", "sleepycat", (64, "sleepycat licen[sc]e"))
    rules += _family("w3c", "w3c", (66, "w3c software(?: notice)? and(?: document)? licen[sc]e"), (60, "w3c licen[sc]e"))
    rules += _family("x11", "x11", (58, "x11 licen[sc]e"))
    rules += _family("json", "evil", (82, "the software shall be used for good not evil"))
    rules += _family("json", "json", (58, "the json licen[sc]e"))
    rules += _family("vim", "vim", (58, "vim licen[sc]e"))
    rules += _family("curl", "curl", (58, "curl licen[sc]e"))
    rules += _family("libpng", "libpng", (58, "libpng licen[sc]e"))
    rules += _family("libpng", "png", (62, "png reference library licen[sc]e version 2"))
    rules += _family("openldap", "openldap", (66, "openldap public licen[sc]e(?: version 2 8)?"))
    rules += _family("nosa", "nasa", (68, "nasa open source agreement(?: version 1 3)?"))
    rules += _family("intel", "intel", (60, "intel open source licen[sc]e"))
    rules += _family("oclc", "oclc", (62, "oclc research public licen[sc]e"))
    rules += _family("frameworx", "frameworx", (60, "frameworx licen[sc]e"))
    rules += _family("motosoto", "motosoto", (60, "motosoto open source licen[sc]e"))
    rules += _family("nethack", "nethack", (60, "nethack general public licen[sc]e"))
    rules += _family("nokia", "nokia", (62, "nokia open source licen[sc]e"))
    rules += _family("realnetworks", "realnetworks", (64, "realnetworks public source licen[sc]e"))
    rules += _family("sugarcrm", "sugarcrm", (62, "sugarcrm public licen[sc]e"))
    rules += _family("watcom", "watcom", (64, "sybase open watcom public licen[sc]e"))
    rules += _family("xfree86", "xfree86", (62, "xfree86 licen[sc]e(?: 1 [01])?"))
    rules += _family("zend", "zend", (60, "zend licen[sc]e(?: v?2 0)?"))
    rules += _family("zpl", "zope", (64, "zope public licen[sc]e(?: version 2 [01])?"))
    rules += _family("cecill", "cecill", (62, "cecill(?: [abc])?(?: licen[sc]e)?(?: version [12](?: [01])?)?"), (70, "cecill free software licen[sc]e agreement"))
    rules += _family("mulan", "mulan", (66, "mulan (?:permissive software|psl) licen[sc]e(?: version 2)?"), (60, "mulan psl(?: v2)?"))
    rules += _family("blueoak", "blue", (66, "blue oak model licen[sc]e(?: 1 0 0)?"))
    rules += _family("bittorrent", "bittorrent", (64, "bittorrent open source licen[sc]e"))
    rules += _family("polyform", "polyform", (70, "polyform (?:noncommercial|small business|shield|strict|perimeter|internal use) licen[sc]e(?: 1 0 0)?"))
    rules += _family("commons-clause", "commons", (68, "commons clause(?: licen[sc]e)?(?: condition)?(?: v1 0)?"))
    rules += _family("hippocratic", "hippocratic", (64, "hippocratic licen[sc]e"))
    rules += _family("openrail", "openrail", (66, "openrail(?: m| s)?(?: licen[sc]e)?"))
    rules += _family("openrail", "creativeml", (72, "creativeml open rail(?: m)? licen[sc]e"))
    rules += _family("cdla-permissive", "community", (72, "community data licen[sc]e agreement permissive(?: version [12] 0)?"))
    rules += _family("cdla-sharing", "community", (72, "community data licen[sc]e agreement sharing(?: version 1 0)?"))
    rules += _family("ogl", "government", (66, "open government licen[sc]e(?: v[123] 0| version [123] 0)?"))
    rules += _family("etalab", "etalab", (64, "etalab open licen[sc]e"), (64, "licence ouverte etalab"))
    rules += _family("opl", "publication", (64, "open publication licen[sc]e(?: v?1 0)?"))
    rules += _family("fdl", "art", (60, "free art licen[sc]e(?: 1 3)?"))
    rules += _family("arphic", "arphic", (62, "arphic public licen[sc]e"))
    rules += _family("ubuntu-font", "ubuntu", (66, "ubuntu font licen[sc]e(?: version 1 0)?"))
    rules += _family("bitstream-vera", "bitstream", (66, "bitstream vera(?: fonts?)? (?:licen[sc]e|copyright)"))
    rules += _family("llama", "llama", (66, "llama [23](?: [12])? community licen[sc]e(?: agreement)?"))
    rules += _family("gemma", "gemma", (60, "gemma terms of use"))
    return rules


def _by_version() -> list[Rule]:
    """Versions of licenses, by the ways in which notices name them."""
    rules = []
    short = {"gpl": "(?:gnu )?general public licen[sc]e", "lgpl": "(?:gnu )?(?:lesser|library) general public licen[sc]e",
             "agpl": "(?:gnu )?affero general public licen[sc]e", "gfdl": "(?:gnu )?free documentation licen[sc]e",
             "mpl": "mozilla public licen[sc]e", "epl": "eclipse public licen[sc]e", "cddl": "common development and distribution licen[sc]e",
             "eupl": "european union public licen[sc]e", "artistic": "artistic licen[sc]e", "boost": "boost software licen[sc]e"}
    keyword = {"gpl": "general", "lgpl": "general", "agpl": "affero", "gfdl": "documentation", "mpl": "mozilla", "epl": "eclipse",
               "cddl": "common", "eupl": "european", "artistic": "artistic", "boost": "boost"}
    versions = {"gpl": "1 2 3", "lgpl": "2 2.1 3", "agpl": "1 3", "gfdl": "1.1 1.2 1.3", "mpl": "1.0 1.1 2.0", "epl": "1.0 2.0",
                "cddl": "1.0 1.1", "eupl": "1.0 1.1 1.2", "artistic": "1.0 2.0", "boost": "1.0"}
    for label, name in short.items():
        for version in versions[label].split():
            number = version.replace(".", " ") + ("" if "." in version else "(?: 0)?")
            full = f"{label}-{version}"
            rules.append(Rule(full, 82, keyword[label], f"{name}(?: as published by the free software foundation)? (?:either )?v(?:ersion )?{number}"))
            rules.append(Rule(full, 82, keyword[label], f"version {number} of the {name}"))
            rules.append(Rule(full, 70, label, f"(?:gnu )?{label}(?: licen[sc]e)? ?v?(?:ersion )?{number}"))
            rules.append(Rule(full, 84, label, f"spdx license identifier {label} {number}(?: only)?"))
            later = f"(?: as published by the free software foundation)? (?:either )?v?(?:ersion )?{number} or (?:at your option )?(?:any )?(?:newer|later)(?: version)?"
            rules.append(Rule(f"{full}+", 86, keyword[label], f"{name}{later}"))
            rules.append(Rule(f"{full}+", 86, label, f"{label}{later}"))
    kinds = {"by": "attribution", "by-sa": "attribution sharealike", "by-nd": "attribution noderivatives", "by-nc": "attribution noncommercial",
             "by-nc-sa": "attribution noncommercial sharealike", "by-nc-nd": "attribution noncommercial noderivatives"}
    for kind, name in kinds.items():
        mark = kind.replace("-", " ")
        spelled = name.replace("sharealike", "share ?alike").replace("noderivatives", "no ?deriv(?:ative)?s").replace("noncommercial", "non ?commercial")
        weight = 60 + 3 * mark.count(" ")
        rules.append(Rule(f"cc-{kind}", weight, "cc", f"cc {mark}"))
        rules.append(Rule(f"cc-{kind}", weight, "creative", f"creative commons {spelled}(?: licen[sc]e)?"))
        rules.append(Rule(f"cc-{kind}", weight + 10, "creativecommons", f"creativecommons org licenses {mark}"))
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            number = version.replace(".", " ")
            rules.append(Rule(f"cc-{kind}-{version}", weight + 16, "cc", f"cc {mark} {number}"))
            rules.append(Rule(f"cc-{kind}-{version}", weight + 16, "creative", f"creative commons {spelled} {number}(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?"))
            rules.append(Rule(f"cc-{kind}-{version}", weight + 18, "creativecommons", f"creativecommons org licenses {mark} {number}"))
    rules += [Rule("cc0", 70, "cc0", "cc0(?: 1 0)?(?: universal)?"), Rule("cc0", 74, "creativecommons", "creativecommons org publicdomain zero 1 0")]
    return rules


@cache
def rules() -> tuple[tuple[Rule, bytes, re.Pattern], ...]:
    """All rules in order, compiled for texts that begin and end with a space."""
    every = sorted([*_hand_written(), *_by_version()], key=lambda r: (-r.priority, r.label, r.pattern))
    return tuple((r, f" {r.keyword}".encode(), re.compile(f"(?<= )(?:{r.pattern})(?= )".encode())) for r in every)


_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def normalised(text: str | None) -> tuple[bytes, int]:
    """The words, each between spaces, and their number."""
    words = (text or "").encode().translate(_TO_WORDS).split()
    return b" " + b" ".join(words) + b" ", len(words)


def contained(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Drops the (start, end, priority, rule) that lie in an interval of a higher priority, or in a longer or earlier equal."""
    kept: list[tuple[int, int, int, int]] = []
    starts: list[int] = []  # of kept intervals that lie in no other kept one, and their ends; both rise
    ends: list[int] = []
    for start, end, priority, rule in sorted(found, key=lambda x: (-x[2], x[0] - x[1], x[0], x[3])):
        at = bisect_right(starts, start) - 1
        if at >= 0 and ends[at] >= end:
            continue
        kept.append((start, end, priority, rule))
        low = at + 1
        high = low
        while high < len(starts) and ends[high] <= end:
            high += 1
        starts[low:high], ends[low:high] = [start], [end]
    return sorted(kept)


def scan(text: str | None) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, int, int]]]:
    """(number of words, base places as (word, label), detections as (first word, end word, priority, rule))."""
    words, n = normalised(text)
    place = _places(words)
    base = [(place(at + 1), label) for phrase, label in BASE for at in _all(words, f" {phrase} ".encode())]
    has: dict[bytes, bool] = {}
    found = []
    for k, (rule, keyword, pattern) in enumerate(rules()):
        if keyword not in has:
            has[keyword] = keyword in words
        if has[keyword]:
            found += [(place(m.start()), place(m.end()) + 1, rule.priority, k) for m in pattern.finditer(words)]
    return n, base, contained(found)


def _all(words: bytes, phrase: bytes) -> Iterator[int]:
    at = words.find(phrase)
    while at >= 0:
        yield at
        at = words.find(phrase, at + 1)


def _places(words: bytes):
    """The number of the word that holds, or ends before, a byte; counts on from the last answer."""
    last, seen = 0, 0

    def place(at: int) -> int:
        nonlocal last, seen
        seen = seen + words.count(b" ", last, at) if at >= last else words.count(b" ", 0, at)
        last = at
        return seen - 1

    return place


_FOUND = "n_words bigint, base array<struct<word: bigint, label: string>>, detections array<struct<start: bigint, end: bigint, priority: int, label: string, rule: string>>"


def license_scan(docs: DataFrame, *, into: str = "licenses", text_column: str = "text") -> DataFrame:
    """The rows with a struct column `into`: n_words, base (word, label), detections (start, end, priority, label, rule)."""
    docs = docs.drop(into) if into in docs.columns else docs
    kind = T.StructType.fromDDL(_FOUND)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, kind)])
    arrow = pa.struct(
        [
            ("n_words", pa.int64()),
            ("base", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
            ("detections", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32()), ("label", pa.string()), ("rule", pa.string())]))),
        ]
    )

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rules()
        for batch in batches:
            made = []
            for text in batch.column(batch.schema.get_field_index(text_column)):
                n, base, found = scan(text.as_py())
                made.append(
                    {
                        "n_words": n,
                        "base": [{"word": w, "label": label} for w, label in base],
                        "detections": [
                            {"start": s, "end": e, "priority": p, "label": table[k][0].label, "rule": table[k][0].pattern} for s, e, p, k in found
                        ],
                    }
                )
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, arrow)], names=[*batch.schema.names, into])

    return docs.mapInArrow(detect, schema)
