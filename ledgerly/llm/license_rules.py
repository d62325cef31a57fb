"""Signature rules of the license scan.

One rule per line: label, level, pattern. A pattern is a regular expression
over the lower-case words of a text, joined by single spaces; ``<`` stands
before the rule's keyword, the word that must be there before the expression is
tried. Levels: 1 a notice or tag that grants a license, 2 a license named with
its version, 3 a family or short name, 4 wording that hints at terms.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: Fixed values of the contract: the base phrases.
BASE = """
cc-by 0 <cc by
gpl 0 general <public license
reserved 0 all rights <reserved
"""

RULES = """
apache-2.0 1 licensed under (the )?<apache license version 2 0
apache-2.0 1 spdx license identifier <apache 2 0
apache-2.0 1 http(s)? www <apache org licenses license 2 0( txt| html)?
apache-2.0 1 (released|distributed|available|made available|provided) under (the )?(terms of )?(the )?<apache( software)? license( version)? 2( 0)?
apache-2.0 2 <apache( software)?( foundation)? license(s)?( version| v)? v?2( 0)?
apache-2.0 2 <apache 2( 0)?( license)?
apache-2.0 2 <asl( version| v)? v?2 0
apache-2.0 2 <asl2( 0)?
apache-1.1 2 <apache( software)? license( version| v)? v?1 1
apache-1.0 2 <apache( software)? license( version| v)? v?1 0
apache 3 <apache( software)?( foundation)? license
apache 3 (licensed|released) under <apache
mit 1 (released|licensed|distributed|available) under (the )?(terms of )?(the )?<mit license
mit 1 spdx license identifier <mit
mit 1 permission is hereby granted free of charge to any person <obtaining a copy of this software
mit 1 opensource org licenses <mit( license)?( php| html)?
mit-0 1 spdx license identifier <mit 0
mit-0 2 <mit no attribution
mit 2 the <mit license
mit 3 <mit license(d)?
mit 3 (license|licence|licensed) <mit
mit 3 <expat license
x11 1 spdx license identifier <x11
x11 3 <x11 license
x11 3 mit <x11
bsd-2-clause 1 spdx license identifier <bsd 2 clause
bsd-3-clause 1 spdx license identifier <bsd 3 clause
bsd-4-clause 1 spdx license identifier <bsd 4 clause
bsd-2-clause 2 <bsd 2 clause( license)?
bsd-3-clause 2 <bsd 3 clause( license)?
bsd-4-clause 2 <bsd 4 clause( license)?
bsd-2-clause 2 (2|two) clause <bsd( license)?
bsd-3-clause 2 (3|three) clause <bsd( license)?
bsd-4-clause 2 (4|four) clause <bsd( license)?
bsd-2-clause 2 <simplified bsd( license)?
bsd-2-clause 2 <freebsd license
bsd-3-clause 2 (new|revised|modified) <bsd( license)?
bsd 1 <redistribution and use in source and binary forms with or without modification are permitted
bsd 1 (released|licensed|distributed) under (the )?(a )?<bsd( style)? license
bsd-3-clause 1 neither the name of (the )?[a-z0-9]+( [a-z0-9]+)?( [a-z0-9]+)? nor the names of its <contributors may be used to endorse
bsd 3 <bsd( style)? licen(s|c)e(d|s)?
0bsd 1 spdx license identifier <0bsd
0bsd 2 (zero clause|free public) <bsd( license)?
0bsd 2 <0bsd( license)?
gpl-3.0 1 <gnu general public license as published by the free software foundation either version 3( of the license)?
gpl-2.0 1 <gnu general public license as published by the free software foundation either version 2( of the license)?
gpl-3.0 1 licensed under (the )?(terms of )?(the )?<gnu general public license( version)? v?3
gpl-2.0 1 licensed under (the )?(terms of )?(the )?<gnu general public license( version)? v?2
gpl-3.0 1 spdx license identifier <gpl 3 0( only| or later)?
gpl-2.0 1 spdx license identifier <gpl 2 0( only| or later)?
gpl-1.0 1 spdx license identifier <gpl 1 0( only| or later)?
gpl-3.0 2 <gnu general public license( gpl)?( version| v)? v?3( 0)?( or later| only)?
gpl-2.0 2 <gnu general public license( gpl)?( version| v)? v?2( 0)?( or later| only)?
gpl-1.0 2 <gnu general public license( gpl)?( version| v)? v?1( 0)?( or later| only)?
gpl-3.0 2 version 3 of the <gnu general public license
gpl-2.0 2 version 2 of the <gnu general public license
gpl-3.0 2 (gnu )?<gpl( version| v)? v?3( 0)?( or later| only)?
gpl-2.0 2 (gnu )?<gpl( version| v)? v?2( 0)?( or later| only)?
gpl-3.0 2 <gplv3( or later| only)?
gpl-2.0 2 <gplv2( or later| only)?
gpl-3.0 2 <gpl3
gpl-2.0 2 <gpl2
gpl 3 (the )?<gnu general public licen(s|c)e
gpl 3 (the )?(gnu )?<gpl( license(d)?)?
gpl 3 http(s)? www <gnu org licenses gpl( html| txt)?
gpl 3 <gnu public license
gpl-classpath 2 <gpl( version| v)?( 2( 0)?)? with (the )?classpath exception
lgpl-3.0 1 spdx license identifier <lgpl 3 0( only| or later)?
lgpl-2.1 1 spdx license identifier <lgpl 2 1( only| or later)?
lgpl-2.0 1 spdx license identifier <lgpl 2 0( only| or later)?
lgpl-3.0 2 (gnu )?<lesser general public license( lgpl)?( version| v)? v?3( 0)?
lgpl-2.1 2 (gnu )?<lesser general public license( lgpl)?( version| v)? v?2 1
lgpl-2.0 2 (gnu )?<library general public license( lgpl)?( version| v)? v?2( 0)?
lgpl-3.0 2 (gnu )?<lgpl( version| v)? v?3( 0)?
lgpl-2.1 2 (gnu )?<lgpl( version| v)? v?2 1
lgpl-3.0 2 <lgplv3
lgpl-2.1 2 <lgplv2( 1)?
lgpl 1 under the terms of the gnu <lesser general public license
lgpl 3 (gnu )?<lesser general public licen(s|c)e
lgpl 3 (gnu )?<lgpl( license(d)?)?
agpl-3.0 1 spdx license identifier <agpl 3 0( only| or later)?
agpl-1.0 1 spdx license identifier <agpl 1 0( only| or later)?
agpl-3.0 2 (gnu )?<affero general public license( agpl)?( version| v)? v?3( 0)?
agpl-3.0 2 (gnu )?<agpl( version| v)? v?3( 0)?
agpl-3.0 2 <agplv3
agpl 3 (gnu )?<affero general public licen(s|c)e
agpl 3 (gnu )?<agpl( license(d)?)?
gfdl-1.3 2 (gnu )?free <documentation license( gfdl)?( version| v)? v?1 3
gfdl-1.2 2 (gnu )?free <documentation license( gfdl)?( version| v)? v?1 2
gfdl-1.1 2 (gnu )?free <documentation license( gfdl)?( version| v)? v?1 1
gfdl 3 (gnu )?free <documentation licen(s|c)e
gfdl 3 (gnu )?<gfdl
mpl-2.0 1 subject to the terms of the <mozilla public license( version| v)? v?2 0
mpl-2.0 1 spdx license identifier <mpl 2 0
mpl-1.1 1 spdx license identifier <mpl 1 1
mpl-2.0 2 <mozilla public license( mpl)?( version| v)? v?2( 0)?
mpl-1.1 2 <mozilla public license( mpl)?( version| v)? v?1 1
mpl-1.0 2 <mozilla public license( mpl)?( version| v)? v?1 0
mpl-2.0 2 <mpl( version| v)? v?2( 0)?
mpl-1.1 2 <mpl( version| v)? v?1 1
mpl 3 <mozilla public licen(s|c)e
epl-2.0 1 spdx license identifier <epl 2 0
epl-1.0 1 spdx license identifier <epl 1 0
epl-2.0 2 <eclipse public license( epl)?( version| v)? v?2( 0)?
epl-1.0 2 <eclipse public license( epl)?( version| v)? v?1( 0)?
epl-2.0 2 <epl( version| v)? v?2( 0)?
epl-1.0 2 <epl( version| v)? v?1( 0)?
epl 3 <eclipse public licen(s|c)e
edl-1.0 2 <eclipse distribution license( version| v)?( 1 0)?
cddl-1.0 2 common <development and distribution license( cddl)?( version| v)? v?1 0
cddl-1.1 2 common <development and distribution license( cddl)?( version| v)? v?1 1
cddl-1.0 2 <cddl( version| v)? v?1 0
cddl-1.1 2 <cddl( version| v)? v?1 1
cddl 3 common <development and distribution license
cddl 3 <cddl( license)?
cpl-1.0 2 <common public license( version| v)? v?1 0
cpl 3 <common public license
cpal-1.0 2 <common public attribution license( version| v)?( 1 0)?
ipl-1.0 3 <ibm public license
apsl-2.0 2 <apple public source license( version| v)? v?2 0
apsl 3 <apple public source license
cc0-1.0 1 spdx license identifier <cc0 1 0
cc0-1.0 2 <cc0( 1 0)?( universal)?
cc0-1.0 2 <creative commons (zero|cc0)( 1 0)?
cc0-1.0 1 creativecommons org <publicdomain zero 1 0
cc-by-4.0 1 licensed under (a |the )?<creative commons attribution 4 0( international)?( license)?
cc-by-sa-4.0 1 licensed under (a |the )?<creative commons attribution sharealike 4 0( international)?( license)?
cc-by-nc-4.0 1 licensed under (a |the )?<creative commons attribution noncommercial 4 0( international)?( license)?
cc-by-4.0 2 <cc by 4 0
cc-by-3.0 2 <cc by 3 0
cc-by-2.5 2 <cc by 2 5
cc-by-2.0 2 <cc by 2 0
cc-by-sa-4.0 2 <cc by sa 4 0
cc-by-sa-3.0 2 <cc by sa 3 0
cc-by-sa-2.5 2 <cc by sa 2 5
cc-by-sa-2.0 2 <cc by sa 2 0
cc-by-nd-4.0 2 <cc by nd 4 0
cc-by-nd-3.0 2 <cc by nd 3 0
cc-by-nc-4.0 2 <cc by nc 4 0
cc-by-nc-3.0 2 <cc by nc 3 0
cc-by-nc-sa-4.0 2 <cc by nc sa 4 0
cc-by-nc-sa-3.0 2 <cc by nc sa 3 0
cc-by-nc-nd-4.0 2 <cc by nc nd 4 0
cc-by-nc-nd-3.0 2 <cc by nc nd 3 0
cc-by-sa 3 <cc by sa
cc-by-nd 3 <cc by nd
cc-by-nc 3 <cc by nc
cc-by-nc-sa 3 <cc by nc sa
cc-by-nc-nd 3 <cc by nc nd
cc-by-4.0 2 creative commons <attribution 4 0( international)?
cc-by-3.0 2 creative commons <attribution 3 0( unported)?
cc-by-sa-4.0 2 creative commons <attribution share ?alike 4 0( international)?
cc-by-sa-3.0 2 creative commons <attribution share ?alike 3 0( unported)?
cc-by-nd 3 creative commons <attribution no ?deriv(ative)?s
cc-by-nc 3 creative commons <attribution non ?commercial
cc-by-nc-sa 3 creative commons <attribution non ?commercial share ?alike
cc-by-nc-nd 3 creative commons <attribution non ?commercial no ?deriv(ative)?s
cc-by 3 creative commons <attribution( license)?
cc-by-4.0 2 <creativecommons org licenses by 4 0
cc-by-sa-4.0 2 <creativecommons org licenses by sa 4 0
cc-by-nc-4.0 2 <creativecommons org licenses by nc 4 0
cc 3 <creative commons( license(s|d)?)?
cc 3 <creativecommons org licenses
artistic-2.0 1 spdx license identifier <artistic 2 0
artistic-2.0 2 <artistic license( version| v)? v?2( 0)?
artistic-1.0 2 <artistic license( version| v)? v?1( 0)?
artistic 3 <artistic licen(s|c)e
perl 3 same terms as <perl( itself)?
isc 1 <permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 1 spdx license identifier <isc
isc 3 <isc license(d)?
zlib 1 spdx license identifier <zlib
zlib 2 <zlib (libpng )?license
zlib 1 altered source versions must be <plainly marked as such
libpng 3 <libpng license
unlicense 1 this is free and unencumbered software released into the public <domain
unlicense 1 spdx license identifier <unlicense
unlicense 3 (the )?<unlicense
wtfpl 1 do what the fuck you want to <public license
wtfpl 3 <wtfpl( license)?
beerware 3 <beerware( license)?
beerware 3 <beer ware license
bsl-1.0 1 spdx license identifier <bsl 1 0
bsl-1.0 2 <boost software license( version| v)?( 1 0)?
python-2.0 2 <python software foundation license( version)?( 2)?
python-2.0 2 <psf license( agreement)?
eupl-1.2 2 <european union public licen(s|c)e( eupl)?( version| v)? v?1 2
eupl-1.1 2 <european union public licen(s|c)e( eupl)?( version| v)? v?1 1
eupl-1.2 2 <eupl( version| v)? v?1 2
eupl-1.1 2 <eupl( version| v)? v?1 1
eupl 3 <european union public licen(s|c)e
eupl 3 <eupl
ofl-1.1 2 <sil open font license( version| v)?( 1 1)?
ofl-1.1 2 <ofl( version| v)? v?1 1
ofl 3 open <font license
odbl-1.0 2 <open database license( odbl)?( version| v)?( 1 0)?
odbl-1.0 3 <odbl
odc-by-1.0 2 open <data commons attribution license
pddl-1.0 2 public <domain dedication and license
ms-pl 2 <microsoft public license( ms pl)?
ms-rl 2 <microsoft reciprocal license( ms rl)?
ms-pl 3 <ms pl
ms-rl 3 <ms rl
openssl 3 <openssl license
ssleay 3 <ssleay license
php-3.01 2 <php license( version| v)? v?3 01
php 3 <php license
postgresql 3 <postgresql license(d)?
ncsa 2 university of illinois <ncsa open source license
ncsa 3 <ncsa( open source)? license
afl-3.0 2 <academic free license( version| v)? v?3( 0)?
afl 3 <academic free license
osl-3.0 2 open <software license( version| v)? v?3 0
osl 3 open <software license
ecl-2.0 2 <educational community license( version| v)?( 2 0)?
cecill-2.1 2 <cecill( version| v)? v?2 1
cecill-b 2 <cecill b
cecill-c 2 <cecill c
cecill 3 <cecill( license)?
mulan-psl-2.0 2 <mulan (permissive software license|psl)( version| v)?( 2)?
mulan-psl-2.0 2 <mulanpsl( 2 0)?
sspl-1.0 2 server <side public license( sspl)?( version| v)?( 1( 0)?)?
sspl-1.0 3 <sspl
busl-1.1 2 <business source license( busl| bsl)?( version| v)?( 1 1)?
busl-1.1 2 <busl 1 1
elastic-2.0 2 <elastic license( version| v)? v?2( 0)?
elastic 3 <elastic license
commons-clause 2 commons <clause( license)?( condition)?( v1 0)?
w3c 3 <w3c (software|document)( notice and)? license
ruby 3 <ruby license
vim 3 <vim license
sleepycat 3 <sleepycat license
qpl-1.0 3 q <public license( version| v)? v?1 0
nasa-1.3 3 <nasa open source agreement
upl-1.0 2 <universal permissive license( upl)?( version| v)?( 1 0)?
blueoak-1.0.0 2 <blue oak model license( 1 0 0)?
hippocratic-2.1 2 <hippocratic license( version| v)?( 2 1)?
openrail 2 <openrail( m)?( license)?
openrail 2 responsible <ai license(s)?
bigscience-rail 2 <bigscience( bloom)? rail( license)?( 1 0)?
json 3 the software shall be used for good not <evil
sgi-b-2.0 2 <sgi free software license b( version| v)?( 2 0)?
rpl-1.5 2 <reciprocal public license( version| v)?( 1 5)?
parity 3 <parity public license
polyform-nc 2 <polyform noncommercial( license)?
polyform-sb 2 <polyform small business( license)?
osgi 3 <osgi specification license
jsr 3 <jcp specification license
cc-pd 2 creative commons <public domain( mark| dedication)?
public-domain 2 (released|placed|dedicated) (in|into|to) the <public domain
public-domain 3 (in|into) the <public domain
public-domain 4 <public domain
reserved 2 <copyright( c)? [0-9]{4}( [0-9]{4})?( by)? [a-z0-9]+( [a-z0-9]+)?( [a-z0-9]+)? all rights reserved
reserved 3 all rights <reserved
reserved 3 todos los derechos <reservados
reserved 3 alle rechte <vorbehalten
reserved 3 tous droits <réservés
some-rights 3 some rights <reserved
no-rights 3 no rights <reserved
copyright 4 <copyright( c)? [0-9]{4}( [0-9]{4})?
copyright 4 <copyright( by)?
copyright 4 <copyrighted( material)?
proprietary 2 <proprietary and confidential
proprietary 2 <confidential and proprietary
proprietary 3 <proprietary (license|software|information)
proprietary 3 unauthorized (copying|reproduction|distribution)( of this file)?( via any medium)? is (strictly )?<prohibited
proprietary 3 may not be (reproduced|copied|redistributed|published|broadcast|rewritten)( or [a-z]+)? without( the)?( prior)?( express)?( written)? <permission
eula 3 end user <license agreement
eula 3 <eula
evaluation 4 for <evaluation (purposes|use) only
non-commercial 3 (for )?non <commercial (use|purposes)( only)?
non-commercial 3 (for )?<noncommercial (use|purposes)( only)?
non-commercial 3 not for <commercial use
research-only 3 for <research (use|purposes) only
personal-use 3 for <personal use only
educational-use 3 for <educational (use|purposes) only
warranty 4 without <warranty of any kind( express or implied)?
warranty 4 without <warranties or conditions of any kind
warranty 4 <merchantability( and)?( or)? fitness for a particular purpose
patent 4 <patent pending
patent 4 <patents pending
trademark 4 (is a )?registered <trademark( of)?
trademark 4 (are )?registered <trademarks( of)?
licensed 4 <licensed (under|by|to)
licensed 4 <license (agreement|terms|text|file)
licensed 4 see (the )?<license( file)?( for)?
licensed 4 open <source license
"""


class Rule(NamedTuple):
    rule: int
    label: str
    level: int
    keyword: str
    pattern: str


def parse(text: str, first: int = 0) -> list[Rule]:
    """Rules of a text in the form above, numbered in its order.

    Every rule must have exactly one keyword, bounded repeats only (a rule
    matches at most the window around its keyword) and no way to match a
    part of a word.
    """
    out = []
    for line in filter(None, map(str.strip, text.splitlines())):
        label, level, pattern = line.split(" ", 2)
        keyword = re.findall(r"(?:^| |\)\?)<([^ ()?|\[]+)(?=$| |\( )", pattern)
        if len(keyword) != 1 or pattern.count("<") != 1 or re.search(r"[*\\.^$]|\{\d+,|(?<!\])\+", pattern):
            raise ValueError(f"not a rule: {line}")
        out.append(Rule(first + len(out), label, int(level), keyword[0], pattern))
    return out
