"""Signatures of licences: hand-written expressions over a text's words.

A name's expression is put into the phrases by which texts refer to a licence, for each of its
versions, and sentences of the licences themselves come on top, some 500 rules in all. One blank in an
expression stands between two words; ``rules`` turns it into the form that license_scan matches."""

from __future__ import annotations

from dataclasses import dataclass

#: A text without any of these has no licence: every rule needs one of them.
ANCHORS = ("licen", "spdx", "gpl", " cc ", "creative  commons", "public  domain", "redistribut", "permission", "warrant")

#: The more explicit, the higher: a mention, a name with its version, a licence's own
#: sentences, a grant, a tag. With the confidence of each.
MENTION, NAMED, BODY, GRANT, TAG = range(5)
CONFIDENCE = (0.5, 0.7, 0.8, 0.9, 1.0)

# label, what all its matches contain, name, identifier in tags, versions
NAMES = [
    ("apache", "apache", "apache(?: software)? licen[sc]e", "apache", "1.0 1.1 2.0"),
    ("mit", "mit", "mit licen[sc]e", "mit", ""),
    ("mit", "x11", "x11 licen[sc]e", "x11", ""),
    ("mit", "expat", "expat licen[sc]e", "expat", ""),
    ("mit-0", "mit", "mit no attribution licen[sc]e", "mit 0", ""),
    ("gpl", "general  public", "(?:gnu )?general public licen[sc]e", "gpl", "1.0 2.0 3.0"),
    ("gpl", "gpl", "(?:gnu )?gpl", "", "2.0 3.0"),
    ("lgpl", "general  public", "(?:gnu )?(?:lesser|library) general public licen[sc]e", "lgpl", "2.0 2.1 3.0"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "", "2.1 3.0"),
    ("agpl", "general  public", "(?:gnu )?affero general public licen[sc]e", "agpl", "1.0 3.0"),
    ("agpl", "agpl", "(?:gnu )?agpl", "", "3.0"),
    ("gpl-2.0", "gplv2", "gplv2", "", ""),
    ("gpl-3.0", "gplv3", "gplv3", "", ""),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[sc]e", "gfdl", "1.1 1.2 1.3"),
    ("bsd", "bsd", "(?:modified |new |original )?bsd(?: style)? licen[sc]e", "bsd", ""),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd) licen[sc]e", "bsd 2 clause", ""),
    ("bsd-3-clause", "bsd", "(?:revised bsd|bsd 3 clause|3 clause bsd) licen[sc]e", "bsd 3 clause", ""),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd) licen[sc]e", "bsd 4 clause", ""),
    ("0bsd", "bsd", "(?:zero clause bsd|0bsd) licen[sc]e", "0bsd", ""),
    ("isc", "isc", "isc licen[sc]e", "isc", ""),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", "zlib", ""),
    ("mpl", "mozilla", "mozilla public licen[sc]e", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", "eclipse public licen[sc]e", "epl", "1.0 2.0"),
    ("edl", "eclipse", "eclipse distribution licen[sc]e", "edl", "1.0"),
    ("cddl", "common", "common development and distribution licen[sc]e", "cddl", "1.0 1.1"),
    ("cpl", "common", "common public licen[sc]e", "cpl", "1.0"),
    ("ipl", "ibm", "ibm public licen[sc]e", "ipl", "1.0"),
    ("eupl", "european", "european union public licen[sc]e", "eupl", "1.0 1.1 1.2"),
    ("osl", "open", "open software licen[sc]e", "osl", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", "academic free licen[sc]e", "afl", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", "(?:perl )?artistic licen[sc]e", "artistic", "1.0 2.0"),
    ("bsl", "boost", "boost software licen[sc]e", "bsl", "1.0"),
    ("busl", "business", "business source licen[sc]e", "busl", "1.1"),
    ("sspl", "server", "server side public licen[sc]e", "sspl", "1.0"),
    ("elastic", "elastic", "elastic licen[sc]e", "elastic", "2.0"),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e", "ms pl", ""),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e", "ms rl", ""),
    ("openssl", "openssl", "openssl licen[sc]e", "openssl", ""),
    ("php", "php", "php licen[sc]e", "php", "3.0 3.01"),
    ("psf", "python", "python(?: software foundation)? licen[sc]e", "psf", "2.0"),
    ("ruby", "ruby", "ruby licen[sc]e", "ruby", ""),
    ("w3c", "w3c", "w3c(?: software)?(?: notice and)? licen[sc]e", "w3c", ""),
    ("vim", "vim", "vim licen[sc]e", "vim", ""),
    ("unlicense", "unlicen", "(?:the )?unlicen[sc]e", "unlicense", ""),
    ("wtfpl", "what", "do what the [^ ]+ you want to public licen[sc]e", "wtfpl", "2.0"),
    ("beerware", "beer", "beer ?ware licen[sc]e", "beerware", ""),
    ("ofl", "open", "(?:sil )?open font licen[sc]e", "ofl", "1.0 1.1"),
    ("odbl", "open", "open database licen[sc]e", "odbl", "1.0"),
    ("odc-by", "open", "open data commons attribution licen[sc]e", "odc by", "1.0"),
    ("pddl", "public  domain", "public domain dedication and licen[sc]e", "pddl", "1.0"),
    ("ogl", "government", "open government licen[sc]e", "ogl", "1.0 2.0 3.0"),
    ("qpl", "public", "q public licen[sc]e", "qpl", "1.0"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e", "ncsa", ""),
    ("ecl", "educational", "educational community licen[sc]e", "ecl", "1.0 2.0"),
    ("cecill", "cecill", "cecill(?: free software)? licen[sc]e", "cecill", "1.0 2.0 2.1"),
    ("mulan", "mulan", "mulan(?: permissive software| psl) licen[sc]e", "mulanpsl", "1.0 2.0"),
    ("rail", "rail", "(?:open|responsible ai|creativeml open) rail(?: m)? licen[sc]e", "openrail", ""),
    ("cc0", "cc0", "cc0 licen[sc]e", "cc0", "1.0"),
]

# label, form of the name; every one has the versions below
COMMONS = [
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
]
COMMONS_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

# label, what all its matches contain, sentence of the licence or of its usual notice
SENTENCES = [
    ("mit", "permission  is  hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "permission  notice", "the above copyright notice and this permission notice shall be included"),
    ("mit", "warrant", "the software is provided as is without warranty of any kind express or implied"),
    ("isc", "permission  to", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("zlib", "warrant", "this software is provided as is without any express or implied warranty"),
    ("bsd", "redistribution  and  use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions  of", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions  in", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "permission", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", "warrant", "distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2.0", "licen", "licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements"),
    ("gpl", "redistribute  it", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("gpl", "verbatim", "everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed"),
    ("lgpl", "redistribute  it", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    ("agpl", "licen", "published by the free software foundation either version 3 of the licen[sc]e or (?:at your option )?any later version of the agpl"),
    ("gpl", "licen", "either version [0-9] of the licen[sc]e or at your option any later version"),
    ("gpl", "warrant", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gfdl", "permission", "permission is granted to copy distribute and or modify this document"),
    ("mpl-2.0", "licen", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("epl", "licen", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("cddl", "licen", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("bsl-1.0", "licen", "distributed under the boost software licen[sc]e version 1 0 see accompanying file"),
    ("psf", "licen", "python software foundation licen[sc]e version 2"),
    ("ofl", "licen", "this font software is licensed under the sil open font licen[sc]e"),
    ("unlicense", "public  domain", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "public  domain", "(?:released|dedicated|placed|put) (?:in|into|to) the public domain"),
    ("public-domain", "public  domain", "(?:is|are|work of the) (?:in the )?public domain"),
    ("cc0", "public  domain", "cc0 1 0 universal public domain dedication"),
    ("proprietary", "redistribut", "no part of this (?:publication|work|document) may be reproduced (?:or )?redistributed"),
    ("proprietary", "permission", "without (?:the )?(?:express |prior )*(?:written )?permission of the (?:publisher|author|owner|copyright holder)"),
    ("proprietary", "licen", "(?:proprietary|commercial|end user) licen[sc]e agreement"),
    ("proprietary", "licen", "all rights reserved unlicensed (?:use|copying)"),
    ("unknown", "licen", "see (?:the )?licen[sc]e(?: file| txt| md)? for (?:more )?(?:details|information|terms)"),
    ("unknown", "licen", "(?:this work|this file|this text|this document|this project|this software) is licensed under"),
]

_GRANT = "(?:licensed|released|distributed|available|published|provided|shared|covered) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
_LATER = "(?: only| or later| or any later version| or newer)?"
_TAG = "spdx license identifier (?:[^ ]+ (?:or|and) )?"

# Fixed phrases whose places are counted for themselves, with their labels.
BASE_PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))


@dataclass(frozen=True)
class Rule:
    """``needs``: literals that every match contains. ``expression`` is over words with a blank
    on each side, so two between neighbours."""

    label: str
    needs: tuple[str, str]
    expression: str
    priority: int
    base: bool = False

    @property
    def confidence(self) -> float:
        return CONFIDENCE[self.priority]


def _spelled(version: str) -> str:
    """2.0 in words: "2", "2 0", "v2", "version 2 0"."""
    whole, _, rest = version.partition(".")
    rest = "(?: 0)?" if rest == "0" else f" {rest}"
    return f"(?:version |v |v)?{whole}{rest}"


def _rule(label: str, needs: tuple[str, str], phrase: str, priority: int, base: bool = False) -> Rule:
    """`` ?`` in a phrase is a blank that may be missing."""
    parts = phrase.split(" ?")
    return Rule(label, needs, " " + "(?:  )?".join(p.replace(" ", "  ") for p in parts) + " ", priority, base)


def _anchor(need: str, phrase: str) -> str:
    """What gates the rule besides ``need``: one of the anchors."""
    return next((a for a in ANCHORS if a in need), "licen" if "licen" in phrase else need)


def rules() -> list[Rule]:
    """All rules in order: of two equally explicit ones that match the same words the earlier counts."""
    made = [_rule(label, ("licen", phrase.replace(" ", "  ")), phrase, MENTION, base=True) for label, phrase in BASE_PHRASES]
    for label, need, name, tag, versions in NAMES:
        needs = (_anchor(need, name), need)
        for full, version in [(f"{label}-{v}", f" {_spelled(v)}{_LATER}") for v in versions.split()] + [(label, "")]:
            if tag:
                made.append(_rule(full, ("spdx", tag.split()[0]), f"{_TAG}{tag}{version}", TAG))
            made.append(_rule(full, needs, f"{_GRANT}{name}{version}", GRANT))
            made.append(_rule(full, needs, f"{name}{version}", NAMED if version else MENTION))
    for label, short, long in COMMONS:
        brief, full_name = (" cc ", " by "), ("creative  commons", "attribution")
        for full, version in [(f"{label}-{v}", f" {_spelled(v)}") for v in COMMONS_VERSIONS.split()] + [(label, "")]:
            made.append(_rule(full, ("spdx", " cc "), f"{_TAG}cc {short}{version}", TAG))
            made.append(_rule(full, brief, f"{_GRANT}cc {short}{version}", GRANT))
            made.append(_rule(full, brief, f"cc {short}{version}", NAMED if version else MENTION))
            made.append(_rule(full, full_name, f"creative commons {long}{version}", NAMED if version else MENTION))
    for label, need, sentence in SENTENCES:
        made.append(_rule(label, (_anchor(need, sentence), need), sentence, BODY))
    return made
