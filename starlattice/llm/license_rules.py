"""Signatures of licenses: expressions over the words of a text, one space between words, first rule strongest.

`license` also stands for `licence`; `{2.0}` for a version, with or without the word
`version`, a `v` or a last zero. Keywords stand after an `@` where no word is in every match.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


# Words in a match that must be looked for: the longest ones.
KEYWORDS = 2


@dataclass(frozen=True)
class Rule:
    """A label, the expression that shows it, how sure it is (0 to 1), its keywords, and whether it is a base phrase.

    Of each group of keywords one must be in the text, as a word or part of one.
    """

    label: str
    pattern: str
    weight: float
    keywords: tuple[tuple[str, ...], ...]
    base: bool = False

    def compiled(self) -> re.Pattern:
        """Finds the rule's words between spaces; a text has a space at both ends."""
        return re.compile(f"(?<= )(?:{self.pattern})(?= )")


def _keywords(pattern: str) -> tuple[tuple[str, ...], ...]:
    """The longest words that stand in the pattern outside of all brackets."""
    plain = pattern
    while (shorter := re.sub(r"\([^()]*\)[?*+]?", "|", plain)) != plain:
        plain = shorter
    found = set(re.findall(r"(?:(?<=\s)|^)([a-z0-9]{2,})(?=\s|$)", plain))
    longest = sorted(found, key=lambda w: (-len(w), w))[:KEYWORDS]
    return tuple(tuple(sorted({w, w.replace("license", "licence")})) for w in longest)


# The base phrases and their labels.
BASE = (
    Rule("gpl", "gnu general public license", 0.6, _keywords("gnu general public license"), True),
    Rule("apache", "apache license", 0.6, _keywords("apache license"), True),
    Rule("cc-by", "cc by", 0.4, _keywords("cc by"), True),
    Rule("mit", "mit license", 0.6, _keywords("mit license"), True),
)

# Identifiers as short tags write them. A family with its versions and endings in brackets.
IDENTIFIERS = """
0bsd  afl-[1.1 1.2 2.0 2.1 3.0]  agpl-[1.0 3.0][-only -or-later]  apache-[1.0 1.1 2.0]  apsl-[1.0 1.1 1.2 2.0]
artistic-[1.0 2.0]  blueoak-1.0.0  bsd-[1 2 3 4]-clause  bsd-3-clause-clear  bsl-1.0  busl-1.1
cc-by-[1.0 2.0 2.5 3.0 4.0]  cc-by-sa-[1.0 2.0 2.5 3.0 4.0]  cc-by-nc-[1.0 2.0 2.5 3.0 4.0]  cc-by-nd-[1.0 2.0 2.5 3.0 4.0]
cc-by-nc-sa-[1.0 2.0 2.5 3.0 4.0]  cc-by-nc-nd-[1.0 2.0 2.5 3.0 4.0]  cc0-1.0  cddl-[1.0 1.1]  cecill-[1.0 1.1 2.0 2.1 b c]
cpal-1.0  cpl-1.0  curl  ecl-[1.0 2.0]  efl-[1.0 2.0]  elastic-2.0  epl-[1.0 2.0]  eupl-[1.0 1.1 1.2]  ftl
gfdl-[1.1 1.2 1.3][-only -or-later]  gpl-[1.0 2.0 3.0][-only -or-later]  icu  ijg  ipl-1.0  isc  json
lgpl-[2.0 2.1 3.0][-only -or-later]  libpng-2.0  lppl-[1.0 1.1 1.2 1.3c]  mit  mit-0  mpl-[1.0 1.1 2.0]  ms-pl  ms-rl
mulanpsl-[1.0 2.0]  ncsa  odbl-1.0  odc-by-1.0  ofl-[1.0 1.1]  openssl  osl-[1.0 2.0 2.1 3.0]  pddl-1.0  php-[3.0 3.01]
postgresql  psf-2.0  python-2.0  qpl-1.0  ruby  sissl  sleepycat  sspl-1.0  tcl  unlicense  upl-1.0  vim  w3c  wtfpl  x11
zlib  zpl-[1.1 2.0 2.1]
"""

NAMES = """
agpl-3.0: gnu affero general public license {3.0}
agpl-1.0: affero general public license {1.0}
lgpl-3.0: gnu (lesser|library) general public license {3.0}
lgpl-2.1: gnu (lesser|library) general public license {2.1}
lgpl-2.0: gnu (lesser|library) general public license {2.0}
lgpl-3.0: (gnu )?lgpl ?{3.0} @ lgpl
lgpl-2.1: (gnu )?lgpl ?{2.1} @ lgpl
gpl-3.0: gnu general public license {3.0}
gpl-2.0: gnu general public license {2.0}
gpl-1.0: gnu general public license {1.0}
gpl-3.0: gnu gpl {3.0}
gpl-2.0: gnu gpl {2.0}
gpl-3.0: gpl ?v ?3( 0)?
gpl-2.0: gpl ?v ?2( 0)?
gpl-3.0: gplv3( 0)? @ gplv
gpl-2.0: gplv2( 0)? @ gplv
lgpl-3.0: lgplv3( 0)? @ gplv
lgpl-2.1: lgplv2 1 @ gplv
agpl-3.0: agplv3( 0)? @ gplv
gfdl-1.3: gnu free documentation license {1.3}
gfdl-1.2: gnu free documentation license {1.2}
gfdl-1.1: gnu free documentation license {1.1}
gpl-2.0-with-classpath-exception: gnu general public license {2.0} with the classpath exception
gpl-3.0-with-gcc-exception: gnu general public license {3.0} with gcc runtime library exception
apache-2.0: apache (software )?license {2.0}
apache-1.1: apache (software )?license {1.1}
apache-1.0: apache (software )?license {1.0}
apache-2.0: asl {2.0}
mpl-2.0: mozilla public license {2.0}
mpl-1.1: mozilla public license {1.1}
mpl-1.0: mozilla public license {1.0}
mpl-2.0: mpl {2.0}
mpl-1.1: mpl {1.1}
epl-2.0: eclipse public license {2.0}
epl-1.0: eclipse public license {1.0}
cddl-1.1: common development and distribution license {1.1}
cddl-1.0: common development and distribution license {1.0}
cpl-1.0: common public license {1.0}
cpal-1.0: common public attribution license {1.0}
eupl-1.2: european union public license {1.2}
eupl-1.1: european union public license {1.1}
afl-3.0: academic free license {3.0}
afl-2.1: academic free license {2.1}
osl-3.0: open software license {3.0}
osl-2.1: open software license {2.1}
artistic-2.0: artistic license {2.0}
artistic-1.0: artistic license {1.0}
bsl-1.0: boost software license {1.0}
busl-1.1: business source license {1.1}
ecl-2.0: educational community license {2.0}
elastic-2.0: elastic license {2.0}
sspl-1.0: server side public license {1.0}
php-3.01: php license {3.01}
zpl-2.1: zope public license {2.1}
lppl-1.3c: (latex|latex project) public license {1.3c}
ofl-1.1: (sil )?open font license {1.1}
odbl-1.0: open (data commons open )?database license {1.0}
odc-by-1.0: open data commons attribution license {1.0}
pddl-1.0: (open data commons )?public domain dedication and license {1.0}
upl-1.0: universal permissive license {1.0}
mulanpsl-2.0: mulan permissive software license {2.0}
apsl-2.0: apple public source license {2.0}
cecill-2.1: cecill free software license agreement {2.1}
blueoak-1.0.0: blue oak model license {1.0.0}
bsd-4-clause: (original|old|four clause|4 clause) bsd license
bsd-3-clause: (new|modified|revised|three clause|3 clause) bsd license
bsd-2-clause: (simplified|freebsd|two clause|2 clause) bsd license
bsd-2-clause: bsd 2 clause( simplified)?( license)?
bsd-3-clause: bsd 3 clause( new| revised)*( license)?
bsd-4-clause: bsd 4 clause( license)?
0bsd: (zero clause bsd|bsd zero clause|bsd 0 clause) license
cc-by-nc-nd-4.0: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) (noderivatives|noderivs|no derivatives|nd) {4.0} @ cc|creative
cc-by-nc-sa-4.0: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) (sharealike|share alike|sa) {4.0} @ cc|creative
cc-by-nc-4.0: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) {4.0} @ cc|creative
cc-by-sa-4.0: (creative commons|cc) (attribution|by) (sharealike|share alike|sa) {4.0} @ cc|creative
cc-by-nd-4.0: (creative commons|cc) (attribution|by) (noderivatives|noderivs|no derivatives|nd) {4.0} @ cc|creative
cc-by-4.0: (creative commons|cc) (attribution|by) {4.0} @ cc|creative
cc-by-nc-nd-3.0: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) (noderivatives|noderivs|no derivatives|nd) {3.0} @ cc|creative
cc-by-nc-sa-3.0: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) (sharealike|share alike|sa) {3.0} @ cc|creative
cc-by-nc-3.0: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) {3.0} @ cc|creative
cc-by-sa-3.0: (creative commons|cc) (attribution|by) (sharealike|share alike|sa) {3.0} @ cc|creative
cc-by-nd-3.0: (creative commons|cc) (attribution|by) (noderivatives|noderivs|no derivatives|nd) {3.0} @ cc|creative
cc-by-3.0: (creative commons|cc) (attribution|by) {3.0} @ cc|creative
cc-by-sa-2.5: (creative commons|cc) (attribution|by) (sharealike|share alike|sa) {2.5} @ cc|creative
cc-by-2.5: (creative commons|cc) (attribution|by) {2.5} @ cc|creative
cc-by-sa-2.0: (creative commons|cc) (attribution|by) (sharealike|share alike|sa) {2.0} @ cc|creative
cc-by-2.0: (creative commons|cc) (attribution|by) {2.0} @ cc|creative
cc0-1.0: (creative commons )?cc0( universal)? {1.0}( universal)? @ cc0
cc0-1.0: creative commons zero( license)?
mit-0: mit no attribution( license)?
mit: (the )?expat license
x11: (mit )?x11 license
isc: (internet systems consortium|isc) license
zlib: zlib (libpng )?license
libpng-2.0: png reference library license( version 2)?
unlicense: the unlicense
wtfpl: do what the fuck you want to public license
beerware: beer ?ware license
json: json license
postgresql: postgresql license
psf-2.0: (python software foundation|psf) license( {2.0})? @ licence|license
ncsa: (university of illinois )?ncsa open source license
ms-pl: microsoft public license
ms-rl: microsoft reciprocal license
ms-pl: (microsoft permissive license|ms pl) @ microsoft|ms
qpl-1.0: q public license( {1.0})?
sleepycat: sleepycat (software )?license
openssl: openssl license
curl: curl license
ftl: freetype (project )?license
ijg: independent jpeg group license
icu: icu license
unicode: unicode license agreement( data files and software)?
vim: vim license
ruby: ruby license
tcl: tcl tk license
w3c: w3c software (notice and )?license
ipl-1.0: ibm public license( {1.0})?
sissl: sun industry standards source license
nokia: nokia open source license
rpl-1.5: reciprocal public license( {1.5})?
nasa-1.3: nasa open source agreement( {1.3})?
naist-2003: nara institute of science and technology license
eudatagrid: eu datagrid software license
openldap: openldap public license
wxwindows: wxwindows library license
commons-clause: commons clause (license )?condition( {1.0})?
polyform-noncommercial: polyform noncommercial license( {1.0.0})?
polyform-small-business: polyform small business license( {1.0.0})?
bigscience-rail: bigscience (open )?rail license
openrail-m: open ?rail m( license)?
llama-community: llama( [0-9]+)*( community)? license agreement
data-cdla-permissive: community data license agreement permissive( {2.0}| {1.0})?
data-cdla-sharing: community data license agreement sharing( {1.0})?
ogl-uk-3.0: open government license( for public sector information)? {3.0}
etalab-2.0: (etalab )?licence ouverte( open licence)? {2.0} @ ouverte
public-domain-mark: public domain mark( {1.0})?
"""

NOTICES = """
mit: permission is hereby granted free of charge to any person obtaining a copy
mit: the above copyright notice and this permission notice shall be included in all copies or substantial portions
bsd: redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause: neither the name of( \\S+){1,12} nor the names of its contributors may be used to endorse
bsd-4-clause: all advertising materials mentioning features or use of this software must display
isc: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib: altered source versions must be plainly marked as such
zlib: this software is provided as is without any express or implied warranty in no event will the authors be held liable
apache-2.0: licensed under the apache license version 2 0
apache-2.0: you may not use this file except in compliance with the license
gpl-3.0-or-later: either version 3 of the license or at your option any later version
gpl-2.0-or-later: either version 2 of the license or at your option any later version
lgpl-2.1-or-later: either version 2 1 of the license or at your option any later version
gpl: under the terms of the gnu general public license as published by the free software foundation
lgpl: under the terms of the gnu (lesser|library) general public license as published by the free software foundation
agpl: under the terms of the gnu affero general public license as published by the free software foundation
gpl: you should have received a copy of the gnu general public license
lgpl: you should have received a copy of the gnu (lesser|library) general public license
gfdl: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0: this source code form is subject to the terms of the mozilla public license
mpl-1.1: the contents of this file are subject to the mozilla public license
cddl: the contents of this file are subject to the terms of the common development and distribution license
epl: this program and the accompanying materials are made available under the terms of the eclipse public license
bsl-1.0: distributed under the boost software license
unlicense: this is free and unencumbered software released into the public domain
wtfpl: you just do what the fuck you want to
beerware: you can buy me a beer in return
cc0-1.0: to the extent possible under law( \\S+){1,12} (has|have) waived all copyright
public-domain: (released|placed|dedicated) (in|into|to) the public domain
public-domain: this work is (in|part of) the public domain
ofl-1.1: this font software is licensed under the sil open font license
artistic: under the same terms as perl itself
php: this product includes php software
openssl: this product includes software developed by the openssl project
json: the software shall be used for good not evil
w3c: this work is being provided by the copyright holders under the following license
postgresql: permission to use copy modify and distribute this software and its documentation for any purpose without fee
all-rights-reserved: all rights reserved
proprietary: (proprietary and confidential|confidential and proprietary) @ proprietary
proprietary: unauthori[sz]ed copying of this file( via any medium)? is strictly prohibited
non-commercial: for (personal and )?non ?commercial use only @ commercial
"""

LINKS = """
gpl-3.0: gnu org licenses (old licenses )?gpl 3 0
gpl-2.0: gnu org licenses (old licenses )?gpl 2 0
lgpl-3.0: gnu org licenses (old licenses )?lgpl 3 0
lgpl-2.1: gnu org licenses (old licenses )?lgpl 2 1
agpl-3.0: gnu org licenses agpl 3 0
gfdl: gnu org licenses fdl
gpl: gnu org licenses gpl
gpl: gnu org copyleft gpl
apache-2.0: apache org licenses license 2 0
mit: opensource org licenses? mit( license php)?
bsd-3-clause: opensource org licenses? bsd 3 clause
bsd-2-clause: opensource org licenses? bsd 2 clause
isc: opensource org licenses? isc
mpl-2.0: mozilla org (en us )?mpl 2 0
mpl-1.1: mozilla org (en us )?mpl 1 1
epl-2.0: eclipse org legal epl 2 0
epl-1.0: eclipse org legal epl v10
bsl-1.0: boost org license 1 0
unlicense: unlicense org
wtfpl: wtfpl net
cc-by-4.0: creativecommons org licenses by 4 0
cc-by-sa-4.0: creativecommons org licenses by sa 4 0
cc-by-nc-4.0: creativecommons org licenses by nc 4 0
cc-by-nd-4.0: creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0: creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0: creativecommons org licenses by nc nd 4 0
cc-by-3.0: creativecommons org licenses by 3 0
cc-by-sa-3.0: creativecommons org licenses by sa 3 0
cc-by-nc-3.0: creativecommons org licenses by nc 3 0
cc-by-nc-sa-3.0: creativecommons org licenses by nc sa 3 0
cc0-1.0: creativecommons org publicdomain zero 1 0
public-domain-mark: creativecommons org publicdomain mark 1 0
ofl-1.1: scripts sil org ofl
odbl-1.0: opendatacommons org licenses odbl
odc-by-1.0: opendatacommons org licenses by
pddl-1.0: opendatacommons org licenses pddl
artistic-2.0: perlfoundation org artistic license 2 0
zlib: zlib net zlib license
busl-1.1: mariadb com bsl11
elastic-2.0: elastic co licensing elastic license
"""

GENERAL = """
gpl-or-later: (gnu )?gpl (version |v ?)?[23]( 0)? or (any )?later
agpl: (gnu )?affero general public license
lgpl: (gnu )?(lesser|library) general public license
gpl: (gnu )?general public license
agpl: (gnu )?agpl @ agpl
lgpl: (gnu )?lgpl @ lgpl
gpl: gnu gpl
gfdl: (gnu )?free documentation license
apache: apache (software )?licen[cs]ed?
mpl: mozilla public license
epl: eclipse public license
cddl: common development and distribution license
cpl: common public license
eupl: european union public license
afl: academic free license
osl: open software license
artistic: (the )?artistic license
bsl: boost software license
busl: business source license
ecl: educational community license
elastic: elastic license
sspl: server side public license
zpl: zope public license
lppl: latex project public license
ofl: (sil )?open font license
odbl: open database license
pddl: public domain dedication and license
upl: universal permissive license
mulanpsl: mulan permissive software license
apsl: apple public source license
cecill: cecill( [abc])? (free software )?license @ cecill
bsd: (the )?bsd (style )?license @ bsd
bsd: bsd licensed
mit: (the )?mit style license
mit: mit licensed
ogl-uk: open government license
etalab: (etalab )?licence ouverte
cc-by-nc-nd: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) (noderivatives|noderivs|no derivatives|nd) @ cc|creative
cc-by-nc-sa: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) (sharealike|share alike|sa) @ cc|creative
cc-by-nc: (creative commons|cc) (attribution|by) (noncommercial|non commercial|nc) @ cc|creative
cc-by-sa: (creative commons|cc) (attribution|by) (sharealike|share alike|sa) @ cc|creative
cc-by-nd: (creative commons|cc) (attribution|by) (noderivatives|noderivs|no derivatives|nd) @ cc|creative
cc-by: creative commons attribution( license)?
cc0: cc0
creative-commons: creative commons( license)?
public-domain: public domain
copyleft: copyleft license
proprietary: proprietary license
dual-license: dual licensed
"""


def _version(found: re.Match) -> str:
    first, *rest = found[1].split(".")
    zeros = "".join(f"(?: {r})?" if not any(int(re.sub(r"\D", "", x) or 0) for x in rest[i:]) else f" {r}" for i, r in enumerate(rest))
    return f"(?:version |v ?)?{first}{zeros}"


def _rules(lines: str, weight: float) -> list[Rule]:
    found = []
    for line in lines.strip().splitlines():
        label, pattern = line.split(": ", 1)
        pattern, _, given = pattern.partition(" @ ")
        pattern = re.sub(r"\{(\d[\d.a-z]*)\}", _version, pattern)
        keywords = (tuple(given.split("|")),) if given else _keywords(pattern)
        found.append(Rule(label, pattern.replace("license", "licen[cs]e"), weight, keywords))
    return found


def _identifiers() -> list[str]:
    found = []
    for entry in re.split(r"\s{2,}|\n", IDENTIFIERS.strip()):
        forms = [""]
        for fixed, choices in re.findall(r"([^\[\]]+)|\[([^\]]*)\]", entry):
            if fixed:
                forms = [f + fixed for f in forms]
            else:
                endings = choices.split(" ")
                plain = [""] if endings[0].startswith("-") else []
                forms = [f + e for f in forms for e in (*endings, *plain)]
        found += forms
    return found


def _tags() -> list[Rule]:
    """A tag of each identifier; the longest first, so that one is not read as the beginning of another."""
    found = []
    for label in sorted(_identifiers(), key=lambda x: (-len(x), x)):
        words = " ".join(re.findall("[a-z0-9]+", label))
        found.append(Rule(label, f"spdx licen[cs]e identifier {words}", 1.0, (("spdx",), ("identifier",))))
    return found


RULES = (
    *_tags(),
    *_rules(NOTICES, 0.9),
    *_rules(NAMES, 0.95),
    *_rules(LINKS, 0.9),
    *_rules(GENERAL, 0.7),
    *BASE,
)
