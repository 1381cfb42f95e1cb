"""Ordered signature rules for licences.

Patterns are matched against lower-case words with one blank between them
(hyphens, dots and other marks are blanks), so a rule needs no spelling
variants. A rule is only tried on texts that hold its keyword, which is a part of
everything that its pattern matches (with a blank before and behind the match).

Ranks: 1 tags and wording that names one licence without doubt, 2 a full name
or a grant, 3 a short or general name.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    rank: int
    keyword: str
    pattern: str


#: Phrases that count as base places, with their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_VERSION = "(?: version| v| ver)?"
# label; identifier as words; keyword of the name; name as a pattern
_LICENCES = [
    ("gpl-1.0", "gpl 1 0", "general public", f"gnu general public licen[sc]e{_VERSION} 1(?: 0)?"),
    ("gpl-2.0", "gpl 2 0", "general public", f"gnu general public licen[sc]e{_VERSION} 2(?: 0)?"),
    ("gpl-3.0", "gpl 3 0", "general public", f"gnu general public licen[sc]e{_VERSION} 3(?: 0)?"),
    ("lgpl-2.0", "lgpl 2 0", "library general", f"gnu library general public licen[sc]e(?:{_VERSION} 2(?: 0)?)?"),
    ("lgpl-2.1", "lgpl 2 1", "lesser general", f"gnu lesser general public licen[sc]e{_VERSION} 2 1"),
    ("lgpl-3.0", "lgpl 3 0", "lesser general", f"gnu lesser general public licen[sc]e{_VERSION} 3(?: 0)?"),
    ("agpl-3.0", "agpl 3 0", "affero", f"gnu affero general public licen[sc]e(?:{_VERSION} 3(?: 0)?)?"),
    ("gfdl-1.3", "gfdl 1 3", "free documentation", f"gnu free documentation licen[sc]e(?:{_VERSION} 1 [123])?"),
    ("apache-1.1", "apache 1 1", "apache", f"apache (?:software )?licen[sc]e{_VERSION} 1 1"),
    ("apache-2.0", "apache 2 0", "apache", f"apache (?:software )?licen[sc]e{_VERSION} 2(?: 0)?"),
    ("mit", "mit", " mit licen", "(?:the )?mit licen[sc]e"),
    ("mit-0", "mit 0", " mit no attribution", "mit no attribution(?: licen[sc]e)?"),
    ("bsd-2-clause", "bsd 2 clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd 3 clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd 4 clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: licen[sc]e)?"),
    ("0bsd", "0bsd", "bsd", "(?:zero clause bsd|bsd zero clause|0bsd)(?: licen[sc]e)?"),
    ("isc", "isc", " isc licen", "isc licen[sc]e"),
    ("mpl-1.1", "mpl 1 1", "mozilla", f"mozilla public licen[sc]e{_VERSION} 1 1"),
    ("mpl-2.0", "mpl 2 0", "mozilla", f"mozilla public licen[sc]e{_VERSION} 2(?: 0)?"),
    ("epl-1.0", "epl 1 0", "eclipse", f"eclipse public licen[sc]e{_VERSION} 1(?: 0)?"),
    ("epl-2.0", "epl 2 0", "eclipse", f"eclipse public licen[sc]e{_VERSION} 2(?: 0)?"),
    ("eupl-1.2", "eupl 1 2", "european union public", f"european union public licen[sc]e(?:{_VERSION} 1 [12])?"),
    ("cddl-1.0", "cddl 1 0", "common development", f"common development and distribution licen[sc]e(?:{_VERSION} 1(?: [01])?)?"),
    ("cpl-1.0", "cpl 1 0", "common public", f"common public licen[sc]e(?:{_VERSION} 1(?: 0)?)?"),
    ("artistic-1.0", "artistic 1 0", "artistic", f"artistic licen[sc]e{_VERSION} 1(?: 0)?"),
    ("artistic-2.0", "artistic 2 0", "artistic", f"artistic licen[sc]e{_VERSION} 2(?: 0)?"),
    ("bsl-1.0", "bsl 1 0", "boost software", f"boost software licen[sc]e(?:{_VERSION} 1(?: 0)?)?"),
    ("zlib", "zlib", "licen", "(?:zlib|zlib libpng|libpng) licen[sc]e"),
    ("unlicense", "unlicense", "unlicense", "the unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl(?: licen[sc]e)?"),
    ("cc0-1.0", "cc0 1 0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-3.0", "cc by 3 0", "cc by", "(?:creative commons )?cc by 3 0"),
    ("cc-by-4.0", "cc by 4 0", "cc by", "(?:creative commons )?cc by 4 0"),
    ("cc-by-sa-3.0", "cc by sa 3 0", "cc by", "(?:creative commons )?cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "cc by", "(?:creative commons )?cc by sa 4 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "cc by", "(?:creative commons )?cc by nc(?: [34] 0)?"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "cc by", "(?:creative commons )?cc by nd(?: [34] 0)?"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", "cc by", "(?:creative commons )?cc by nc sa(?: [34] 0)?"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", "cc by", "(?:creative commons )?cc by nc nd(?: [34] 0)?"),
    ("psf-2.0", "psf 2 0", "licen", "(?:psf|python software foundation) licen[sc]e(?: agreement)?(?: version 2)?"),
    ("postgresql", "postgresql", "postgresql", "postgresql licen[sc]e"),
    ("ofl-1.1", "ofl 1 1", "open font", f"(?:sil )?open font licen[sc]e(?:{_VERSION} 1 1)?"),
    ("ms-pl", "ms pl", "microsoft public", "microsoft public licen[sc]e"),
    ("ms-rl", "ms rl", "microsoft reciprocal", "microsoft reciprocal licen[sc]e"),
    ("ncsa", "ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
    ("odbl-1.0", "odbl 1 0", "open database", f"open (?:data commons open )?database licen[sc]e(?:{_VERSION} 1(?: 0)?)?"),
    ("odc-by-1.0", "odc by 1 0", "open data commons", "open data commons attribution licen[sc]e"),
    ("pddl-1.0", "pddl 1 0", "public domain dedication", "public domain dedication and licen[sc]e"),
    ("openssl", "openssl", "openssl", "openssl licen[sc]e"),
    ("php-3.01", "php 3 01", " php licen", f"php licen[sc]e(?:{_VERSION} 3 01)?"),
    ("ruby", "ruby", " ruby licen", "ruby licen[sc]e"),
    ("sspl-1.0", "sspl 1 0", "server side public", "server side public licen[sc]e"),
    ("busl-1.1", "busl 1 1", "business source", f"business source licen[sc]e(?:{_VERSION} 1 1)?"),
    ("upl-1.0", "upl 1 0", "universal permissive", "universal permissive licen[sc]e"),
    ("vim", "vim", " vim licen", "vim licen[sc]e"),
    ("x11", "x11", " x11 licen", "x11 licen[sc]e"),
    ("afl-3.0", "afl 3 0", "academic free", "academic free licen[sc]e"),
    ("osl-3.0", "osl 3 0", "open software", "open software licen[sc]e"),
    ("openrail", "openrail", "rail ", "(?:open rail|openrail|bigscience rail)(?: [sm])?(?: licen[sc]e)?"),
]

_GRANT = (
    "(?:licen[sc]ed|released|distributed|published|available|provided|redistribute it and or modify it)"
    " under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
)

# Wording of licence texts and notices, written out.
_WORDING = [
    ("gpl", 1, "free software", "this program is free software you can redistribute it"),
    ("gpl", 1, "everyone is permitted", "everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document"),
    ("gpl", 2, "general public", "general public licen[sc]e as published by the free software foundation"),
    ("gpl-2.0", 1, "either version 2", "either version 2 of the licen[sc]e or at your option any later version"),
    ("gpl-3.0", 1, "later version", "either version 3 of the licen[sc]e or at your option any later version"),
    ("gpl-2.0", 1, "version 2 of the licen", "version 2 of the licen[sc]e as published by the free software foundation"),
    ("gpl", 2, "gnu org", "(?:https? )?(?:www )?gnu org licen[sc]es(?: gpl(?: [123] 0)?(?: html| txt)?)?"),
    ("lgpl", 2, "gnu org", "(?:https? )?(?:www )?gnu org licen[sc]es lgpl(?: [23] [01])?(?: html| txt)?"),
    ("agpl", 2, "gnu org", "(?:https? )?(?:www )?gnu org licen[sc]es agpl(?: 3 0)?(?: html| txt)?"),
    ("gpl", 3, "gnu", "gnu general public licen[sc]e"),
    ("gpl", 3, "gnu", "gnu gpl"),
    ("gpl", 3, "gpl", "gpl(?:v[123]| v ?[123])"),
    ("gpl", 3, "gpl", "gpl compatible"),
    ("lgpl", 3, "lgpl", "(?:gnu )?lgpl(?:v[23]| v ?[23])?"),
    ("lgpl", 3, "lesser", "gnu lesser general public licen[sc]e"),
    ("agpl", 3, "agpl", "(?:gnu )?agpl(?:v3| v ?3)?"),
    ("gpl-classpath", 2, "classpath exception", "(?:gnu )?classpath exception"),
    ("gpl", 2, "runtime library", "gcc runtime library exception"),
    ("apache", 3, "apache", "apache licen[sc]e"),
    ("apache", 3, "apache", "apache software licen[sc]e"),
    ("apache-2.0", 2, " asl 2 0", "asl 2 0"),
    ("apache-2.0", 1, "apache", "(?:https? )?(?:www )?apache org licen[sc]es licen[sc]e 2 0"),
    ("apache-2.0", 1, "compliance", "you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", 2, "without warranties or", "without warranties or conditions of any kind either express or implied"),
    ("apache-2.0", 2, "hereby grants to you", "each contributor hereby grants to you a perpetual worldwide non exclusive"),
    ("mit", 1, "free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 2, "permission notice", "the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", 2, "opensource", "(?:https? )?(?:www )?opensource org licen[sc]es mit(?: licen[sc]e)?"),
    ("mit", 3, " mit style", "mit style licen[sc]e"),
    ("mit", 3, "expat licen", "expat licen[sc]e"),
    ("bsd", 1, "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 2, "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", 2, "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 1, "endorse or promote", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", 1, "all advertising materials", "all advertising materials mentioning features or use of this software"),
    ("bsd", 2, "software is provided by the", "this software is provided by the (?:copyright holders and contributors|author|regents and contributors) as is"),
    ("bsd", 3, "bsd", "bsd licen[sc]e"),
    ("bsd", 3, "bsd", "bsd style(?: licen[sc]e)?"),
    ("isc", 1, "with or without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", 1, "mozilla", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl-2.0", 1, "mozilla", "(?:https? )?(?:www )?mozilla org mpl 2 0"),
    ("mpl", 3, "mozilla", "mozilla public licen[sc]e"),
    ("epl", 3, "eclipse", "eclipse public licen[sc]e"),
    ("epl", 1, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("artistic", 3, "artistic", "artistic licen[sc]e"),
    ("perl", 2, "same terms as perl", "under the same terms as perl(?: itself)?"),
    ("python", 3, "python licen", "python licen[sc]e"),
    ("bsl-1.0", 1, "boost org", "(?:https? )?(?:www )?boost org licen[sc]e 1 0 txt"),
    ("zlib", 1, "altered source", "altered source versions must be plainly marked as such"),
    ("zlib", 2, "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", 1, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", 2, "unlicense", "(?:https? )?unlicense org"),
    ("wtfpl", 1, "do what the", "do what the fuck you want to public licen[sc]e"),
    ("public-domain", 2, "public domain", "(?:placed|released|dedicated|is) (?:in|into|to) the public domain"),
    ("public-domain", 3, "public domain", "public domain"),
    ("cc-by", 3, "cc by", "cc by"),
    ("cc-by-sa", 3, "cc by", "cc by sa"),
    ("cc-by-nc", 3, "cc by", "cc by nc"),
    ("cc-by-nd", 3, "cc by", "cc by nd"),
    ("cc-by-nc-sa", 3, "cc by", "cc by nc sa"),
    ("cc-by", 1, "creativecommons", "(?:https? )?(?:www )?creativecommons org licen[sc]es by(?: [1234] [05])?"),
    ("cc-by-sa", 1, "creativecommons", "(?:https? )?(?:www )?creativecommons org licen[sc]es by sa(?: [1234] [05])?"),
    ("cc-by-nc", 1, "creativecommons", "(?:https? )?(?:www )?creativecommons org licen[sc]es by nc(?: [1234] [05])?"),
    ("cc-by-nd", 1, "creativecommons", "(?:https? )?(?:www )?creativecommons org licen[sc]es by nd(?: [1234] [05])?"),
    ("cc-by-nc-sa", 1, "creativecommons", "(?:https? )?(?:www )?creativecommons org licen[sc]es by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", 1, "creativecommons", "(?:https? )?(?:www )?creativecommons org licen[sc]es by nc nd(?: [1234] [05])?"),
    ("cc0-1.0", 1, "creativecommons", "(?:https? )?(?:www )?creativecommons org publicdomain zero 1 0"),
    ("cc-by", 2, "creative commons", "creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?(?: licen[sc]e)?"),
    ("cc-by-sa", 2, "creative commons", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported)?(?: licen[sc]e)?"),
    ("cc-by-nc", 2, "creative commons", "creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported)?(?: licen[sc]e)?"),
    ("cc-by-nd", 2, "creative commons", "creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?(?: licen[sc]e)?"),
    ("cc-by-nc-sa", 2, "creative commons", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: licen[sc]e)?"),
    ("cc", 3, "creative commons", "creative commons(?: licen[sc]e)?"),
    ("proprietary", 2, "all rights reserved", "all rights reserved"),
    ("proprietary", 2, "proprietary", "(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", 2, "commercial licen", "commercial licen[sc]e"),
    ("proprietary", 2, "end user", "end user licen[sc]e agreement"),
    ("copyright", 3, "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}"),
    ("copyleft", 3, "copyleft", "copyleft"),
    ("no-warranty", 3, "warranty", "without (?:any )?warranty(?: of any kind)?"),
    ("no-warranty", 3, "provided as is", "provided as is"),
    ("dual", 2, "dual licen", "dual licen[sc]ed"),
    ("see-licence", 3, "licen", "see (?:the )?(?:accompanying )?licen[sc]e(?: file| txt| md)?"),
    ("sublicence", 3, "sublicens", "sublicens(?:e|able|ing)"),
    ("research-only", 2, "research ", "for (?:non commercial )?research (?:purposes|use) only"),
    ("non-commercial", 2, "commercial ", "(?:for )?non ?commercial (?:use|purposes)(?: only)?"),
    ("trademark", 3, "registered trademark", "registered trademarks?"),
]


def rules() -> list[Rule]:
    """All rules, the ones to prefer first."""
    tags = [Rule(label, 1, "spdx", f"spdx licen[sc]e identifier {name}(?: only| or later)?") for label, name, _, _ in _LICENCES]
    grants = [Rule(label, 1, keyword, _GRANT + name) for label, _, keyword, name in _LICENCES]
    wording = [Rule(*row) for row in _WORDING]
    names = [Rule(label, 2, keyword, name) for label, _, keyword, name in _LICENCES]
    found = tags + grants + [r for r in wording if r.rank == 1] + names + [r for r in wording if r.rank > 1]
    return sorted(found, key=lambda rule: rule.rank)  # stable: within a rank in the order above


#: A text without any of these matches no rule.
ROOTS = tuple(dict.fromkeys(rule.keyword for rule in rules()))
