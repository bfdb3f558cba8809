"""Signature rules of licenses: patterns over lower-case words joined by one blank.

A license has a label, a word that every mention of its name holds, its name, its short tag and its page. Each gives a rule of
its own in every form that licenses are stated in, so the rules are some hundreds. Texts and headers of licenses that
say something else than the name stand beside them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

#: Forms of a detection, the most telling first. A form's place is its priority.
LEVELS = ("text", "tag", "notice", "page", "metadata", "mention")
WEIGHTS = (1.0, 0.95, 0.9, 0.8, 0.7, 0.5)


@dataclass(frozen=True)
class Rule:
    """keywords are words that every match holds; pinned rules find overlapping places and are never suppressed."""

    label: str
    level: int
    pattern: str
    keywords: tuple[str, ...]
    pinned: bool = False

    def compiled(self) -> re.Pattern[bytes]:
        inner = f"(?=({self.pattern})(?![^ ]))" if self.pinned else f"({self.pattern})(?![^ ])"
        return re.compile(f"(?<![^ ]){inner}".encode())


V = r"(?: version| v)?"  # before a number
L = r"licen[cs]e"
LATER = r"(?: (?:and|or)(?: any| at your option any)? (?:later|newer)(?: versions?)?| plus)"

#: label, word of every name, name, tag, page
LICENSES = (
    ("mit", "mit", rf"(?:the )?mit {L}", "mit", "opensource org licenses mit"),
    ("mit-0", "mit", rf"mit (?:no attribution|0)(?: {L})?", "mit 0", "opensource org licenses mit 0"),
    ("expat", "expat", rf"expat {L}", "expat", "directory fsf org wiki license expat"),
    ("x11", "x11", rf"x11 {L}", "x11", "spdx org licenses x11"),
    ("isc", "isc", rf"isc {L}", "isc", "opensource org licenses isc"),
    ("apache-1", "apache", rf"apache(?: software)? {L}{V} 1(?: [01])?", r"apache 1 [01]", r"apache org licenses license 1 [01]"),
    ("apache-2", "apache", rf"apache(?: software)? {L}{V} 2(?: 0)?", r"apache 2(?: 0)?", r"apache org licenses license 2 0"),
    ("apache", "apache", rf"apache(?: software)? {L}", "apache", r"apache org licenses"),
    ("bsd-4-clause", "bsd", rf"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: {L})?", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("bsd-3-clause", "bsd", rf"(?:bsd 3 clause|3 clause bsd|three clause bsd|(?:new|modified|revised) bsd)(?: {L})?", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "bsd", rf"(?:bsd 2 clause|2 clause bsd|two clause bsd|(?:simplified|freebsd) bsd)(?: {L})?", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-0", "0bsd", rf"0bsd(?: {L})?", "0bsd", "opensource org licenses 0bsd"),
    ("bsd-0", "zero", rf"zero clause bsd(?: {L})?", "bsd zero clause", "landley net toybox license"),
    ("bsd", "bsd", rf"bsd(?: style)? {L}", "bsd", r"opensource org licenses bsd license"),
    ("gpl-1", "1", rf"(?:gnu )?(?:general public {L}|gpl){V} 1(?: 0)?", "gpl 1 0(?: only)?", r"gnu org licenses(?: old licenses)? gpl 1 0"),
    ("gpl-1-or-later", "1", rf"(?:gnu )?(?:general public {L}|gpl){V} 1(?: 0)?{LATER}", "gpl 1 0 or later", "spdx org licenses gpl 1 0 or later"),
    ("gpl-2", "2", rf"(?:gnu )?(?:general public {L}|gpl){V} 2(?: 0)?", "gpl 2 0(?: only)?", r"gnu org licenses(?: old licenses)? gpl 2 0"),
    ("gpl-2-or-later", "2", rf"(?:gnu )?(?:general public {L}|gpl){V} 2(?: 0)?{LATER}", "gpl 2 0 or later", "spdx org licenses gpl 2 0 or later"),
    ("gpl-3", "3", rf"(?:gnu )?(?:general public {L}|gpl){V} 3(?: 0)?", "gpl 3 0(?: only)?", r"gnu org licenses gpl 3 0"),
    ("gpl-3-or-later", "3", rf"(?:gnu )?(?:general public {L}|gpl){V} 3(?: 0)?{LATER}", "gpl 3 0 or later", "spdx org licenses gpl 3 0 or later"),
    ("gpl-2", "gplv2", "(?:gnu )?gplv2", "gplv2", "choosealicense com licenses gplv2"),
    ("gpl-3", "gplv3", "(?:gnu )?gplv3", "gplv3", "choosealicense com licenses gplv3"),
    ("gpl", "public", rf"gnu (?:general )?public {L}", "gpl", r"gnu org licenses gpl"),
    ("gpl", "gpl", rf"(?:gnu )?gpl(?: {L})?", "gnu gpl", r"gnu org copyleft gpl"),
    ("lgpl-2", "2", rf"(?:gnu )?(?:library general public {L}|lgpl){V} 2(?: 0)?", "lgpl 2 0(?: only)?", r"gnu org licenses(?: old licenses)? lgpl 2 0"),
    ("lgpl-2.1", "1", rf"(?:gnu )?(?:lesser general public {L}|lgpl){V} 2 1", "lgpl 2 1(?: only)?", r"gnu org licenses(?: old licenses)? lgpl 2 1"),
    ("lgpl-2.1-or-later", "1", rf"(?:gnu )?(?:lesser general public {L}|lgpl){V} 2 1{LATER}", "lgpl 2 1 or later", "spdx org licenses lgpl 2 1 or later"),
    ("lgpl-3", "3", rf"(?:gnu )?(?:lesser general public {L}|lgpl){V} 3(?: 0)?", "lgpl 3 0(?: only)?", r"gnu org licenses lgpl 3 0"),
    ("lgpl-3-or-later", "3", rf"(?:gnu )?(?:lesser general public {L}|lgpl){V} 3(?: 0)?{LATER}", "lgpl 3 0 or later", "spdx org licenses lgpl 3 0 or later"),
    ("lgpl", "lesser", rf"gnu lesser (?:general )?public {L}", "gnu lesser gpl", r"gnu org licenses lesser"),
    ("lgpl", "lgpl", rf"(?:gnu )?lgpl(?: {L})?", "lgpl", r"gnu org licenses lgpl"),
    ("agpl-3", "3", rf"(?:gnu )?(?:affero general public {L}|agpl){V} 3(?: 0)?", "agpl 3 0(?: only)?", r"gnu org licenses agpl 3 0"),
    ("agpl-3-or-later", "3", rf"(?:gnu )?(?:affero general public {L}|agpl){V} 3(?: 0)?{LATER}", "agpl 3 0 or later", "spdx org licenses agpl 3 0 or later"),
    ("agpl", "affero", rf"(?:gnu )?affero general public {L}", "gnu affero gpl", r"gnu org licenses affero"),
    ("agpl", "agpl", rf"(?:gnu )?agpl(?: {L})?", "agpl", r"gnu org licenses agpl"),
    ("gfdl", "documentation", rf"(?:gnu )?free documentation {L}(?:{V} 1 [123])?", r"gfdl 1 [123](?: only| or later)?", r"gnu org licenses fdl"),
    ("mpl-1.1", "mozilla", rf"mozilla public {L}{V} 1 1", "mpl 1 1", "mozilla org mpl mpl 1 1"),
    ("mpl-2", "mozilla", rf"mozilla public {L}{V} 2(?: 0)?", "mpl 2 0", r"mozilla org (?:en us )?mpl 2 0"),
    ("mpl", "mozilla", rf"mozilla public {L}", "mozilla public", "mozilla org mpl"),
    ("epl-1", "eclipse", rf"eclipse public {L}{V} 1(?: 0)?", "epl 1 0", r"eclipse org legal epl v10"),
    ("epl-2", "eclipse", rf"eclipse public {L}{V} 2(?: 0)?", "epl 2 0", r"eclipse org legal epl 2 0"),
    ("edl", "eclipse", rf"eclipse distribution {L}(?:{V} 1 0)?", "edl 1 0", r"eclipse org org documents edl v10"),
    ("cddl-1", "cddl", rf"(?:common development and distribution {L} )?cddl{V} 1(?: 0)?", "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("cddl", "development", rf"common development and distribution {L}", "cddl", "opensource org licenses cddl"),
    ("cpl-1", "common", rf"common public {L}{V} 1(?: 0)?", "cpl 1 0", "opensource org licenses cpl 1 0"),
    ("ipl-1", "ibm", rf"ibm public {L}(?:{V} 1 0)?", "ipl 1 0", "opensource org licenses ibmpl"),
    ("eupl", "union", rf"european union public {L}(?:{V} 1 [012])?", r"eupl 1 [012]", r"joinup ec europa eu (?:software page|collection) eupl"),
    ("cecill", "cecill", rf"cecill(?: [bc])?(?: free software)? {L}(?: agreement)?", r"cecill(?: [bc12]){1,2}", r"cecill info licences"),
    ("ms-pl", "microsoft", rf"microsoft public {L}", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {L}", "ms rl", "opensource org licenses ms rl"),
    ("artistic-1", "artistic", rf"artistic {L}{V} 1(?: 0)?", r"artistic 1 0(?: perl| cl8)?", "opensource org licenses artistic 1 0"),
    ("artistic-2", "artistic", rf"artistic {L}{V} 2(?: 0)?", "artistic 2 0", "opensource org licenses artistic 2 0"),
    ("artistic", "artistic", rf"artistic {L}", "artistic", "perlfoundation org artistic"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {L}", "zlib", "opensource org licenses zlib"),
    ("libpng", "libpng", rf"libpng {L}(?:{V} 2)?", r"libpng(?: 2 0)?", "libpng org pub png src libpng license"),
    ("boost", "boost", rf"boost software {L}(?:{V} 1 0)?", "bsl 1 0", r"boost org license 1 0"),
    ("python", "python", rf"python(?: software foundation)? {L}(?:{V} 2(?: 0)?)?", r"(?:psf|python) 2 0", "docs python org license"),
    ("php-3", "php", rf"php {L}{V} 3(?: 0[01]?)?", "php 3 0[01]?", "php net license 3"),
    ("ruby", "ruby", rf"ruby {L}", "ruby", "ruby lang org en about license"),
    ("postgresql", "postgresql", rf"postgresql {L}", "postgresql", "postgresql org about licence"),
    ("openssl", "openssl", rf"openssl(?: ssleay)? {L}", "openssl", "openssl org source license"),
    ("curl", "curl", rf"curl {L}", "curl", "curl se docs copyright"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", rf"wtfpl(?:{V} 2)?", "wtfpl", "wtfpl net"),
    ("beerware", "beer", rf"beer ware {L}", "beerware", "spdx org licenses beerware"),
    ("afl-3", "academic", rf"academic free {L}(?:{V} 3(?: 0)?)?", "afl 3 0", "opensource org licenses afl 3 0"),
    ("osl-3", "open", rf"open software {L}(?:{V} 3(?: 0)?)?", "osl 3 0", "opensource org licenses osl 3 0"),
    ("upl", "universal", rf"universal permissive {L}(?:{V} 1 0)?", "upl 1 0", "oss oracle com licenses upl"),
    ("ncsa", "illinois", rf"university of illinois(?: ncsa)?(?: open source)? {L}", "ncsa", "opensource org licenses ncsa"),
    ("w3c", "w3c", rf"w3c(?: software)?(?: notice and)? {L}", "w3c", "w3 org consortium legal copyright software"),
    ("ofl", "font", rf"(?:sil )?open font {L}(?:{V} 1 [01])?", r"ofl 1 [01]", "scripts sil org ofl"),
    ("odbl", "database", rf"open database {L}(?:{V} 1 0)?", "odbl 1 0", r"opendatacommons org licenses odbl"),
    ("odc-by", "attribution", rf"open data commons attribution {L}(?:{V} 1 0)?", "odc by 1 0", r"opendatacommons org licenses by"),
    ("pddl", "domain", rf"(?:open data commons )?public domain dedication and {L}", "pddl 1 0", r"opendatacommons org licenses pddl"),
    ("cc0", "cc0", rf"cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero"),
    ("cc-by", "by", r"cc by(?: [1234] [05])?", r"cc by [1234] [05]", r"creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", "sa", r"cc by sa(?: [1234] [05])?", r"cc by sa [1234] [05]", r"creativecommons org licenses by sa"),
    ("cc-by-nd", "nd", r"cc by nd(?: [1234] [05])?", r"cc by nd [1234] [05]", r"creativecommons org licenses by nd"),
    ("cc-by-nc", "nc", r"cc by nc(?: [123] [05])?", r"cc by nc [123] [05]", r"creativecommons org licenses by nc"),
    ("cc-by-nc-4", "nc", r"cc by nc 4 0", "cc by nc 4 0", r"creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa", "sa", r"cc by nc sa(?: [1234] [05])?", r"cc by nc sa [1234] [05]", r"creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "nd", r"cc by nc nd(?: [1234] [05])?", r"cc by nc nd [1234] [05]", r"creativecommons org licenses by nc nd"),
    ("cc-by", "attribution", rf"creative commons attribution(?: [1234] [05])?(?: international| unported)?(?: {L})?", "creative commons attribution", "creativecommons org by"),
    ("cc-by-sa", "attribution", rf"creative commons attribution (?:share alike|sharealike)(?: [1234] [05])?(?: international| unported)?(?: {L})?", "creative commons attribution sharealike", "creativecommons org by sa"),
    ("cc-by-nc", "attribution", rf"creative commons attribution (?:non commercial|noncommercial)(?: [1234] [05])?(?: international| unported)?(?: {L})?", "creative commons attribution noncommercial", "creativecommons org by nc"),
    ("cc-by-nd", "attribution", rf"creative commons attribution (?:no derivatives|noderivatives|noderivs)(?: [1234] [05])?(?: international| unported)?(?: {L})?", "creative commons attribution noderivatives", "creativecommons org by nd"),
    ("sspl", "side", rf"server side public {L}(?:{V} 1)?", "sspl 1 0", "mongodb com licensing server side public license"),
    ("elastic-2", "elastic", rf"elastic {L}(?:{V} 2(?: 0)?)?", "elastic 2 0", "elastic co licensing elastic license"),
    ("busl-1.1", "business", rf"business source {L}(?:{V} 1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("commons-clause", "commons", rf"commons clause(?: {L} condition)?", "commons clause", "commonsclause com"),
    ("openrail", "openrail", rf"(?:creativeml )?openrail(?: [ms]){{0,2}}(?: {L})?", r"openrail(?: m)?", "huggingface co spaces compvis stable diffusion license"),
    ("vim", "vim", rf"vim {L}", "vim", "vimdoc sourceforge net htmldoc uganda"),
    ("tcl", "tcl", rf"tcl(?: tk)? {L}", "tcl", "tcl tk software tcltk license terms"),
    ("sleepycat", "sleepycat", rf"sleepycat {L}", "sleepycat", "opensource org licenses sleepycat"),
    ("qpl", "public", rf"q public {L}(?:{V} 1 0)?", "qpl 1 0", "opensource org licenses qpl"),
    ("lppl", "latex", rf"latex project public {L}(?:{V} 1 [0-3]c?)?", r"lppl 1 [0-3]c?", "latex project org lppl"),
    ("blueoak", "blue", rf"blue oak model {L}(?: 1 0 0)?", "blueoak 1 0 0", "blueoakcouncil org license"),
)

#: label, pattern of what licenses and file headers say
TEXTS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", r"permission is hereby granted free of charge to any person obtaining a copy of this software without the notice requirement"),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("bsd-0", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", r"neither the names? of (?:the |its )?(?:\S+ ){1,8}may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", r"software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("gpl-2-or-later", r"(?:this program|it) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3-or-later", r"(?:this program|it) is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-2.1-or-later", r"redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3-or-later", r"redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3-or-later", r"redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license"),
    ("epl-1", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2", r"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cddl-1", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", r"do what the fuck you want to public license"),
    ("beerware", r"as long as you retain this notice you can do whatever you want with this stuff(?: \S+){0,30} you can buy me a beer"),
    ("cc0", r"(?:has|have) waived all copyright and related or neighboring rights"),
    ("ofl", r"the fonts and derivatives however cannot be released under any other type of license"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("public-domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", r"(?:is|are) in the public domain"),
)
#: the same for claims that are weak signs by themselves
CLAIMS = (
    ("proprietary", r"all rights reserved"),
    ("proprietary", r"confidential and proprietary"),
    ("proprietary", r"unauthorized (?:copying|use|distribution|reproduction)(?: \S+){0,12} is (?:strictly )?prohibited"),
    ("copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)?[0-9]{2})*"),
)

NOTICE = r"(?:(?:dual |multi )?licen[cs]ed|released|distributed|available|published|provided|redistributed|shared|offered|covered|governed)" \
         r"(?: \S+){0,3} (?:under|by)(?: the| an?)?(?: terms(?: and conditions)? of)?(?: the| an?)?(?: gnu)?"


def literal_words(pattern: str) -> tuple[str, ...]:
    """Words that every match of a pattern holds: those outside its groups, without classes, escapes or quantifiers.

    Groups here begin or end at a blank or stand for whole words, and alternatives stand in groups only.
    """
    out, depth = [], 0
    for at, c in enumerate(pattern):
        if c == "(":
            if not depth and not pattern.startswith("(?: ", at):
                out.append("*" if at and pattern[at - 1] != " " else " ")
            depth += 1
        elif c == ")":
            depth -= 1
            out.append("" if depth else " ")
        elif not depth:
            out.append(c)
    # what is left of a group is its quantifier
    words = re.sub(r"\{[^}]*\}|\[[^]]*\]", "*", "".join(out)).split(" ")
    return tuple(dict.fromkeys(w for w in words if re.fullmatch(r"[a-z0-9]+", w)))


def signatures(phrases: dict[str, str]) -> list[Rule]:
    """All rules, those for the given phrases (phrase to label) first. A rule's place settles ties."""
    level = {name: i for i, name in enumerate(LEVELS)}

    def rule(label: str, form: str, pattern: str, *words: str, pinned: bool = False) -> Rule:
        return Rule(label, level[form], pattern, tuple(dict.fromkeys((*words, *literal_words(pattern)))), pinned)

    rules = [Rule(label, level["notice"], " ".join(map(re.escape, p.split())), tuple(p.split()), True) for p, label in phrases.items()]
    rules += [rule(label, "text", pattern) for label, pattern in TEXTS]
    rules += [rule(label, "mention", pattern) for label, pattern in CLAIMS]
    for label, word, name, tag, page in LICENSES:
        rules += [
            rule(label, "tag", f"spdx license identifier(?: \\S+ (?:and|or|with))? {tag}"),
            rule(label, "notice", f"{NOTICE} (?:{name})", word),
            rule(label, "page", f"(?:https? )?(?:www )?{page}"),
            rule(label, "metadata", f"{L} {tag}"),
            rule(label, "mention", name, word),
        ]
    return rules


@cache
def compiled(phrases: tuple[tuple[str, str], ...]) -> tuple[list[Rule], list[re.Pattern[bytes]], dict[bytes, list[int]], list[frozenset[bytes]]]:
    """The rules, their patterns, the rules that each keyword opens, and the words a rule needs.

    A rule is listed under the keyword that the fewest rules have.
    """
    rules = signatures(dict(phrases))
    common: dict[str, int] = {}
    for r in rules:
        for w in set(r.keywords):
            common[w] = common.get(w, 0) + 1
    opened: dict[bytes, list[int]] = {}
    for i, r in enumerate(rules):
        opened.setdefault(min(r.keywords, key=lambda w: (common[w], w)).encode(), []).append(i)
    return rules, [r.compiled() for r in rules], opened, [frozenset(w.encode() for w in r.keywords) for r in rules]
