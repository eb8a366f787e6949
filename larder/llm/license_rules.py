"""Ordered licence signatures, written over texts reduced to words with single spaces.

A rule is (label, tier, keywords, pattern).  Lower tiers win over higher ones; inside a
tier, the earlier rule wins.  A text is only tried against a rule if it holds one of the
rule's keywords.
"""

from __future__ import annotations

# Base phrases: fixed values of the operator's contract.
BASE = [
    ("gpl", ["gnu"], "gnu general public license"),
    ("apache", ["apache"], "apache license"),
    ("cc-by", ["cc"], "cc by"),
    ("mit", ["license"], "mit license"),
]

V = "(?: version| v)?"
L = "licen[sc]e"
LS = ["license", "licence"]

# label, keywords, title pattern (words in lower case), SPDX identifier as words ("" for none)
TITLES = [
    ("gpl-1.0", ["gnu"], f"gnu general public {L}{V} (?:1|v1)(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", ["gnu"], f"gnu general public {L}{V} (?:2|v2)(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", ["gnu"], f"gnu general public {L}{V} (?:3|v3)(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl", ["gnu"], f"gnu general public {L}", ""),
    ("gpl", ["gpl"], "gnu gpl|gpl(?: v?[123](?: 0)?)?", ""),
    ("lgpl-2.0", ["gnu"], f"gnu library general public {L}{V} (?:2|v2)(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", ["gnu"], f"gnu lesser general public {L}{V} (?:2|v2) 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", ["gnu"], f"gnu lesser general public {L}{V} (?:3|v3)(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl", ["gnu"], f"gnu (?:lesser|library) general public {L}", ""),
    ("lgpl", ["lgpl"], "(?:gnu )?lgpl(?: v?[23](?: [01])?)?", ""),
    ("agpl-3.0", ["gnu"], f"gnu affero general public {L}{V} (?:3|v3)(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl", ["gnu", "affero"], f"(?:gnu )?affero general public {L}", ""),
    ("agpl", ["agpl"], "(?:gnu )?agpl(?: v?3(?: 0)?)?", ""),
    ("gfdl", ["gnu"], f"gnu free documentation {L}(?:{V} 1 [123])?", "gfdl 1 [123](?: only| or later)?"),
    ("gfdl", ["gfdl"], "gfdl(?: 1 [123])?", ""),
    ("apache-1.0", ["apache"], f"apache (?:software )?{L}{V} 1 0", "apache 1 0"),
    ("apache-1.1", ["apache"], f"apache (?:software )?{L}{V} 1 1", "apache 1 1"),
    ("apache-2.0", ["apache"], f"apache (?:software )?{L}{V} 2(?: 0)?", "apache 2 0"),
    ("apache-2.0", ["apache"], "apache 2(?: 0)?", ""),
    ("apache", ["apache"], f"apache (?:software )?{L}", ""),
    ("mit", [*LS], f"mit (?:x11 )?{L}", "mit"),
    ("mit-0", [*LS], f"mit no attribution {L}", "mit 0"),
    ("x11", ["x11"], f"x11 {L}", "x11"),
    ("mit", ["expat"], f"expat {L}", ""),
    ("bsd-4-clause", ["bsd"], f"(?:original|4 clause|four clause) bsd {L}|bsd 4 clause(?: {L})?", "bsd 4 clause"),
    ("bsd-3-clause", ["bsd"], f"(?:new|modified|revised|3 clause|three clause) bsd {L}|bsd 3 clause(?: {L})?", "bsd 3 clause"),
    ("bsd-2-clause", ["bsd"], f"(?:simplified|2 clause|two clause) bsd {L}|bsd 2 clause(?: {L})?", "bsd 2 clause"),
    ("bsd-1-clause", ["bsd"], f"bsd 1 clause(?: {L})?", "bsd 1 clause"),
    ("0bsd", ["0bsd", "bsd"], f"(?:zero clause|free public) bsd {L}|bsd zero clause(?: {L})?|0bsd", "0bsd"),
    ("bsd", ["bsd"], f"bsd(?: style)? {L}", ""),
    ("isc", ["isc"], f"isc {L}", "isc"),
    ("zlib", ["zlib"], f"zlib(?: libpng)? {L}", "zlib"),
    ("libpng", ["libpng"], f"libpng {L}", "libpng"),
    ("mpl-1.0", ["mozilla"], f"mozilla public {L}{V} 1 0", "mpl 1 0"),
    ("mpl-1.1", ["mozilla"], f"mozilla public {L}{V} 1 1", "mpl 1 1"),
    ("mpl-2.0", ["mozilla"], f"mozilla public {L}{V} 2(?: 0)?", "mpl 2 0"),
    ("mpl", ["mozilla"], f"mozilla public {L}", ""),
    ("mpl", ["mpl"], "mpl(?: v?[12](?: [01])?)?", ""),
    ("epl-1.0", ["eclipse"], f"eclipse public {L}{V} 1(?: 0)?", "epl 1 0"),
    ("epl-2.0", ["eclipse"], f"eclipse public {L}{V} 2(?: 0)?", "epl 2 0"),
    ("epl", ["eclipse"], f"eclipse (?:public|distribution) {L}", ""),
    ("eupl-1.1", ["eupl", "european"], f"(?:european union public {L}|eupl){V} 1 1", "eupl 1 1"),
    ("eupl-1.2", ["eupl", "european"], f"(?:european union public {L}|eupl){V} 1 2", "eupl 1 2"),
    ("eupl", ["eupl", "european"], f"european union public {L}|eupl", ""),
    ("cddl-1.0", ["cddl", "distribution"], f"(?:common development and distribution {L}|cddl){V} 1 0", "cddl 1 0"),
    ("cddl-1.1", ["cddl", "distribution"], f"(?:common development and distribution {L}|cddl){V} 1 1", "cddl 1 1"),
    ("cddl", ["cddl", "distribution"], f"common development and distribution {L}|cddl", ""),
    ("cpl-1.0", ["common"], f"common public {L}(?:{V} 1 0)?", "cpl 1 0"),
    ("ipl-1.0", ["ibm"], f"ibm public {L}(?:{V} 1 0)?", "ipl 1 0"),
    ("ms-pl", ["microsoft"], f"microsoft public {L}", "ms pl"),
    ("ms-rl", ["microsoft"], f"microsoft reciprocal {L}", "ms rl"),
    ("artistic-1.0", ["artistic"], f"artistic {L}{V} 1(?: 0)?", "artistic 1 0(?: perl| cl8)?"),
    ("artistic-2.0", ["artistic"], f"artistic {L}{V} 2(?: 0)?", "artistic 2 0"),
    ("artistic", ["artistic"], f"(?:perl )?artistic {L}", ""),
    ("boost-1.0", ["boost"], f"boost software {L}(?:{V} 1(?: 0)?)?", "bsl 1 0"),
    ("python-2.0", ["python", "psf"], f"(?:python software foundation|psf|python) {L}(?:{V} 2(?: 0)?)?", "(?:python|psf) 2 0"),
    ("ruby", ["ruby"], f"ruby {L}", "ruby"),
    ("php-3.01", ["php"], f"php {L}(?:{V} 3 0[01]?)?", "php 3 0[01]?"),
    ("perl", ["perl"], "same terms as perl(?: itself)?", ""),
    ("openssl", ["openssl"], f"openssl {L}", "openssl"),
    ("postgresql", ["postgresql"], f"postgresql {L}", "postgresql"),
    ("curl", ["curl"], f"curl {L}", "curl"),
    ("ncsa", ["ncsa", "illinois"], f"(?:university of illinois )?ncsa(?: open source)? {L}|university of illinois open source {L}", "ncsa"),
    ("w3c", ["w3c"], f"w3c (?:software|document)(?: notice and)? {L}", "w3c(?: 19980720| 20150513)?"),
    ("unlicense", ["unlicense"], "(?:the )?unlicense", "unlicense"),
    ("wtfpl", ["wtfpl", "fuck"], f"wtfpl|do what the fuck you want to public {L}", "wtfpl"),
    ("afl-3.0", ["academic"], f"academic free {L}(?:{V} 3(?: 0)?)?", "afl 3 0"),
    ("osl-3.0", ["open"], f"open software {L}(?:{V} 3(?: 0)?)?", "osl 3 0"),
    ("ofl-1.1", ["sil", "ofl"], f"sil open font {L}(?:{V} 1 1)?|ofl(?: 1 1)?", "ofl 1 1"),
    ("odbl-1.0", ["odbl", "database"], f"open (?:data commons open )?database {L}|odbl(?: 1 0)?", "odbl 1 0"),
    ("odc-by-1.0", ["commons"], f"open data commons attribution {L}", "odc by 1 0"),
    ("pddl-1.0", ["pddl", "commons"], f"open data commons public domain dedication(?: and {L})?|pddl", "pddl 1 0"),
    ("etalab-2.0", ["etalab", "ouverte"], "licence ouverte(?: etalab)?|etalab(?: 2 0)?", "etalab 2 0"),
    ("ogl-uk-3.0", ["government"], f"open government {L}(?:{V} 3(?: 0)?)?", "ogl uk 3 0"),
    ("cecill-2.1", ["cecill"], "cecill(?: (?:free software )?licen[sc]e)?(?: (?:version|v) ?2 1)?", "cecill 2 [01]"),
    ("cc0-1.0", ["cc0", "creative"], "cc0(?: 1 0)?(?: universal)?|creative commons (?:zero|cc0)(?: 1 0)?", "cc0 1 0"),
    ("cc-by-nc-nd", ["cc"], "cc by nc nd(?: [1-4] [05])?", "cc by nc nd [1-4] [05]"),
    ("cc-by-nc-sa", ["cc"], "cc by nc sa(?: [1-4] [05])?", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc", ["cc"], "cc by nc(?: [1-4] [05])?", "cc by nc [1-4] [05]"),
    ("cc-by-nd", ["cc"], "cc by nd(?: [1-4] [05])?", "cc by nd [1-4] [05]"),
    ("cc-by-sa", ["cc"], "cc by sa(?: [1-4] [05])?", "cc by sa [1-4] [05]"),
    ("cc-by", ["cc"], "cc by(?: [1-4] [05])?", "cc by [1-4] [05]"),
    ("cc-by-nc-nd", ["creative"], "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?", ""),
    ("cc-by-nc-sa", ["creative"], "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?", ""),
    ("cc-by-nc", ["creative"], "creative commons attribution non ?commercial(?: [1-4] [05])?", ""),
    ("cc-by-nd", ["creative"], "creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?", ""),
    ("cc-by-sa", ["creative"], "creative commons attribution share ?alike(?: [1-4] [05])?", ""),
    ("cc-by", ["creative"], "creative commons attribution(?: [1-4] [05])?", ""),
    ("creative-commons", ["creative"], f"creative commons(?: {L})?", ""),
    ("sspl-1.0", ["sspl", "server"], f"server side public {L}(?:{V} 1(?: 0)?)?|sspl(?: v?1)?", "sspl 1 0"),
    ("elastic-2.0", ["elastic"], f"elastic {L}(?:{V} 2(?: 0)?)?", "elastic 2 0"),
    ("busl-1.1", ["business"], f"business source {L}(?:{V} 1 1)?", "busl 1 1"),
    ("polyform", ["polyform"], f"polyform (?:noncommercial|small business|shield|strict|internal use) {L}(?: 1 0 0)?", ""),
    ("openrail", ["openrail", "rail"], "(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[sc]e)?", ""),
    ("llama-community", ["llama"], f"llama (?:[234](?: [1-3])? )?community {L}(?: agreement)?", ""),
]

# label, keywords, pattern: sentences of the licence bodies and notices that name no title
BODIES = [
    ("mit", ["permission"], "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("isc", ["permission"], "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", ["redistribution"], "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", ["endorse"], "neither the name of (?:the )?(?:[^ ]+ ){1,8}may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", ["advertising"], "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2.0", ["apache"], "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", ["redistribute"], "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", ["redistribute"], "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("mpl-2.0", ["mozilla"], "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", ["unencumbered"], "this is free and unencumbered software released into the public domain"),
    ("zlib", ["warranty"], "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost-1.0", ["boost"], "distributed under the boost software license"),
    ("public-domain", ["domain"], "(?:released into|dedicated to|placed in|in) the public domain|public domain (?:dedication|mark|work)"),
    ("proprietary", ["reserved"], "all rights reserved"),
    ("proprietary", ["proprietary"], "proprietary and confidential|proprietary licen[sc]e"),
    ("non-commercial", ["commercial", "noncommercial"], "(?:for )?non ?commercial use only|not for commercial use"),
    ("copyleft", ["copyleft"], "copyleft"),
    ("copyright", ["copyright"], "copyright (?:c )?(?:19|20)[0-9]{2}"),
]

# keyword, words of a licence address, label
ADDRESSES = [
    ("gnu", "gnu org licenses gpl(?: [0-9] 0)?", "gpl"),
    ("gnu", "gnu org licenses lgpl(?: [0-9] [01])?", "lgpl"),
    ("gnu", "gnu org licenses agpl(?: 3 0)?", "agpl"),
    ("gnu", "gnu org licenses fdl(?: 1 3)?", "gfdl"),
    ("apache", "apache org licenses license 2 0", "apache-2.0"),
    ("apache", "apache org licenses", "apache"),
    ("opensource", "opensource org licenses mit", "mit"),
    ("opensource", "opensource org licenses bsd [234] clause", "bsd"),
    ("opensource", "opensource org licenses isc", "isc"),
    ("opensource", "opensource org licenses apache 2 0", "apache-2.0"),
    ("opensource", "opensource org licenses mpl 2 0", "mpl-2.0"),
    ("mozilla", "mozilla org mpl(?: 2 0)?", "mpl"),
    ("eclipse", "eclipse org legal epl(?: 2 0| v10| v20)?", "epl"),
    ("unlicense", "unlicense org", "unlicense"),
    ("creativecommons", "creativecommons org licenses by nc nd(?: [1-4] [05])?", "cc-by-nc-nd"),
    ("creativecommons", "creativecommons org licenses by nc sa(?: [1-4] [05])?", "cc-by-nc-sa"),
    ("creativecommons", "creativecommons org licenses by nc(?: [1-4] [05])?", "cc-by-nc"),
    ("creativecommons", "creativecommons org licenses by nd(?: [1-4] [05])?", "cc-by-nd"),
    ("creativecommons", "creativecommons org licenses by sa(?: [1-4] [05])?", "cc-by-sa"),
    ("creativecommons", "creativecommons org licenses by(?: [1-4] [05])?", "cc-by"),
    ("creativecommons", "creativecommons org publicdomain zero(?: 1 0)?", "cc0-1.0"),
    ("boost", "boost org license 1 0", "boost-1.0"),
]

GENERIC = [
    ("unknown-license", ["licensed", "licenced"], "(?:is |are )?licen[sc]ed under(?: the)?(?: terms of)?(?: the)?"),
    ("unknown-license", [*LS], f"(?:open source|free software|end user|software) {L}(?: agreement)?"),
]

GRANT = (
    "(?:licen[sc]ed|released|distributed|provided|available|published|redistribute it|used) "
    "(?:to you )?under (?:an? )?(?:the )?(?:terms of (?:an? )?(?:the )?)?"
)

#: Confidence of each tier: identifier tag, grant or body or address, title, generic wording.
CONFIDENCE = [1.0, 0.95, 0.8, 0.4]


def rules() -> list[tuple[str, int, list[str], str]]:
    """All rules in order: tags, then bodies, addresses and grants, then titles, then generic wording."""
    out = [(label, 0, ["spdx"], f"spdx licen[sc]e identifier {tag}") for label, _, _, tag in TITLES if tag]
    out += [(label, 1, keys, body) for label, keys, body in BODIES if label not in ("copyright", "copyleft")]
    out += [(label, 1, [key], words) for key, words, label in ADDRESSES]
    out += [(label, 1, keys, f"{GRANT}(?:{title})") for label, keys, title, _ in TITLES]
    out += [(label, 2, keys, f"(?:{title})") for label, keys, title, _ in TITLES]
    out += [(label, 3, keys, body) for label, keys, body in BODIES if label in ("copyright", "copyleft")]
    out += [(label, 3, keys, words) for label, keys, words in GENERIC]
    return out
