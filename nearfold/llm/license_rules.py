"""Signatures of licenses and notices, in order of priority.

A line is `label | keyword | pattern`. A pattern is a regular expression over the words of a text (see
`licenses`), with one space between words; the keyword is a word that every match holds. Within a tier
lines stand in order of priority. Tier 1 is what a license says or grants, tier 2 a license with its
version, tier 3 a license by name, tier 4 what only hints at terms of use.

Patterns use what Java's and RE2's expressions have in common and give no capture a meaning.
"""

from __future__ import annotations

from itertools import product

_TEXTS = """
mit | obtaining | permission is hereby granted free of charge to any person obtaining a copy( of this software)?
mit | sublicense | rights to use copy modify merge publish distribute sublicense( and or sell copies)?
mit | permission | the above copyright notice and this permission notice( including the next paragraph)? shall be included
mit-modern-variant | royalty | permission is hereby granted without written agreement and without license or royalty fees
x11 | holder | except as contained in this notice the names? of( the)?( [^ ]+){1,5} shall not be used in advertising( [^ ]+){0,12} holder
hpnd | advertising | permission to use copy modify( and)? distribute( and sell)? this software( [^ ]+){1,30} advertising
isc | purpose | permission to use copy modify and or distribute this software for any purpose with or without fee
isc | fee | permission to use copy modify and distribute this software for any purpose with or without fee
0bsd | redistribution | redistribution and use in any form with or without changes are permitted
bsd | binary | redistribution and use in source and binary forms with or without modification( are permitted)?
bsd | retain | redistributions of source code must retain the( above)? copyright notice
bsd | reproduce | redistributions in binary form must reproduce the( above)? copyright notice
bsd-3-clause | endorse | neither the names? of( [^ ]+){1,15} nor the names of( [^ ]+){1,6} may be used to endorse or promote products
bsd-4-clause | acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-2-clause-views | conclusions | the views and conclusions contained in the software and documentation are those of the authors
bsd-source-code | nuclear | this software is not designed( or)? licensed or intended for use in the design( [^ ]+){1,8} nuclear
apache-2.0 | compliance | licensed under the apache license version 2 0 the license you may not use this( [^ ]+){1,3} except in compliance
apache-2.0 | governing | see the license for the specific language governing permissions and limitations
apache-2.0 | grants | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable( copyright| patent)? license
apache-1.1 | apache | products derived from this software may not be called apache nor may apache appear in their name
gpl | redistribute | this( [^ ]+){1,3} is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
lgpl | lesser | this( [^ ]+){1,3} is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e
lgpl | library | this( [^ ]+){1,3} is free software you can redistribute it and or modify it under the terms of the gnu library general public licen[cs]e
agpl | affero | this( [^ ]+){1,3} is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e
gpl | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu( affero| lesser| library)? general public licen[cs]e
gpl | gnu | you should have received a copy of the gnu( affero| lesser| library)? general public licen[cs]e
gpl | copyleft | the gnu( affero| lesser)? general public licen[cs]e is a free copyleft licen[cs]e
gpl-exception | linking | as a special exception( [^ ]+){1,20} permission to link( [^ ]+){0,12} linking
gpl-classpath-exception | independent | linking this library statically or dynamically with other modules( [^ ]+){0,30} independent modules
gpl-font-exception | font | if you create a document which uses this font and embed this font
gfdl | invariant | with no invariant sections( with)? no front cover texts and( with)? no back cover texts
gfdl | document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-2.0 | mpl | if a copy of the mpl was not distributed with this file
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e
cddl | development | the contents of this file are subject to the terms of the common development and distribution licen[cs]e
cpl | common | the accompanying program is provided under the terms of this common public licen[cs]e
ms-pl | microsoft | this license governs use of the accompanying software( [^ ]+){0,40} microsoft public licen[cs]e
zlib | misrepresented | the origin of this software must not be misrepresented
zlib | altered | altered source versions must be plainly marked as such
zlib | held | in no event will the authors? be held liable for any damages arising from the use of this software
bsl-1.0 | boost | distributed under the boost software licen[cs]e version 1 0
bsl-1.0 | machine | unless such copies or derivative works are solely in the form of machine executable object code
unlicense | unencumbered | this is free and unencumbered software released into the public domain
unlicense | anyone | anyone is free to copy modify publish use compile sell or distribute this software
wtfpl | wtfpl | do what the( [^ ]+){1,2} you want to public licen[cs]e wtfpl
wtfpl | want | you just do what the( [^ ]+){1,2} you want to
beerware | beer | you can buy me a beer in return
cc0 | waived | has waived all copyright and related or neighbou?ring rights
cc0 | relinquish | overtly fully permanently irrevocably and unconditionally waives abandons and surrenders( [^ ]+){0,60} relinquish
cc | creative | this work is licen[cs]ed under( a| the) creative commons
cc | creative | except where otherwise noted( the)? content( [^ ]+){0,8} is licen[cs]ed under( a| the)? creative commons
cc | creative | available under( a| the) creative commons( [^ ]+){1,8} licen[cs]e
cc | creative | the text of( the| this) [^ ]+( [^ ]+)? is available under( the)? creative commons
ofl | reserved | this font software is licensed under the sil open font licen[cs]e( [^ ]+){0,30} reserved
ofl | sil | this font software is licen[cs]ed under the sil open font licen[cs]e
psf | python | psf is making python available to licensee on an as is basis
artistic | package | the intent of this document is to state the conditions under which a package may be copied
openssl | openssl | this product includes software developed by the openssl project for use in the openssl toolkit
ijg | jpeg | this software is based in part on the work of the independent jpeg group
libpng | png | the png reference library is supplied as is
unicode | unicode | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
w3c | w3c | by obtaining using and or copying this work you( the licensee)? agree( [^ ]+){0,20} w3c
json | evil | the software shall be used for good not evil
curl | curl | permission to use copy modify and distribute this software( [^ ]+){1,20} curl
ncsa | ncsa | university of illinois ncsa open source licen[cs]e
eupl | eupl | licensed under the eupl
cecill | cecill | this software is governed by the cecill( [abc])? licen[cs]e
gov-work | government | works? of the( united states| u s)? government( [^ ]+){0,12} public domain
crown | crown | contains public sector information licensed under the open government licen[cs]e( [^ ]+){0,30} crown copyright
ogl | sector | contains public sector information licensed under the open government licen[cs]e
odbl | odbl | made available under the open database licen[cs]e( [^ ]+){0,12} odbl
odbl | database | this( [^ ]+){1,6} database is made available under the open database licen[cs]e
pddl | dedication | made available under the public domain dedication and licen[cs]e
gutenberg | gutenberg | this ebook is for the use of anyone anywhere( [^ ]+){0,40} project gutenberg
gutenberg | gutenberg | you may copy it give it away or re use it under the terms of the project gutenberg licen[cs]e
stackexchange | contributions | user contributions licen[cs]ed under( [^ ]+){1,6}
wikimedia | unported | text is available under the( [^ ]+){1,8} unported licen[cs]e
warranty-disclaimer | warranty | the software is provided as is without warranty of any kind( express or implied)?
warranty-disclaimer | warranties | the software is provided as is without warranties of any kind( express or implied)?
warranty-disclaimer | warranties | any express or implied warranties including but not limited to
warranty-disclaimer | consequential | be liable for any direct indirect incidental special exemplary or consequential damages
warranty-disclaimer | liable | in no event shall the( authors or)? copyright holders( or contributors)? be liable
proprietary | confidential | this( software| document| material| file) is( the)? confidential and proprietary
proprietary | proprietary | contains( trade secrets and)? proprietary( and confidential)? information of
proprietary | prohibited | unauthori[sz]ed( copying| reproduction| use| distribution)( of this( [^ ]+){1,4})? is strictly prohibited
no-reproduction | reproduced | no part of this( [^ ]+){1,3} may be reproduced
no-reproduction | reproduction | reproduction( in whole or in part)? without( written| prior| express)?( written)? permission is prohibited
no-reproduction | republished | may not be( published broadcast rewritten or)? republished
no-redistribution | redistributed | may not be( copied| modified| sold| or){0,6} redistributed
with-permission | permission | (reprinted|reproduced|used|republished) (with|by)( kind| the)? permission( of)?
non-commercial-use | commercial | for( personal| private| educational)?( and| or)? non commercial use only
non-commercial-use | noncommercial | for( personal)?( and| or)? noncommercial( use| purposes) only
research-only | research | for( academic| scientific| non commercial)?( and| or)? research( use| purposes) only
"""

_VERSIONS = """
apache-2.0 | apache | apache( software)?( license| licence)?( version| v)? 2( 0)?
apache-2.0 | apache2 | apache2
apache-2.0 | asl2 | asl2( 0)?
apache-1.1 | apache | apache( software)?( license| licence)?( version| v)? 1 1
apache-1.0 | apache | apache( software)?( license| licence)?( version| v)? 1 0
apache-2.0 | www | www apache org licen[cs]es licen[cs]e 2 0
agpl-3.0-or-later | agpl | agpl 3 0 or later
agpl-3.0 | agpl | agpl( version)?( v)? 3( 0)?( only)?
agpl-3.0 | agplv3 | agplv3
agpl-3.0 | affero | affero general public licen[cs]e( version| v)? 3
lgpl-3.0-or-later | lgpl | lgpl 3 0 or later
lgpl-3.0 | lgpl | lgpl( version)?( v)? 3( 0)?( only)?
lgpl-3.0 | lgplv3 | lgplv3
lgpl-2.1-or-later | lgpl | lgpl 2 1 or later
lgpl-2.1 | lgpl | lgpl( version)?( v)? 2 1( only)?
lgpl-2.1 | lgplv2 | lgplv2( 1)?
lgpl-2.1 | lesser | lesser general public licen[cs]e( version| v)? 2 1
lgpl-3.0 | lesser | lesser general public licen[cs]e( version| v)? 3
lgpl-2.0 | library | library general public licen[cs]e( version| v)? 2
gpl-3.0-or-later | gpl | gpl 3 0 or later
gpl-3.0 | gpl | gpl( version)?( v)? 3( 0)?( only)?
gpl-3.0 | gplv3 | gplv3
gpl-3.0 | gpl3 | gpl3
gpl-2.0-or-later | gpl | gpl 2 0 or later
gpl-2.0 | gpl | gpl( version)?( v)? 2( 0)?( only)?
gpl-2.0 | gplv2 | gplv2
gpl-2.0 | gpl2 | gpl2
gpl-1.0 | gpl | gpl( version)?( v)? 1( 0)?( only)?
gpl-3.0-or-later | general | general public licen[cs]e( as published by the free software foundation)?( either)?( version| v) 3( of the licen[cs]e)? or at your option any later version
gpl-2.0-or-later | general | general public licen[cs]e( as published by the free software foundation)?( either)?( version| v) 2( of the licen[cs]e)? or at your option any later version
gpl-3.0 | general | general public licen[cs]e( as published by the free software foundation)?( either)?( version| v) 3
gpl-2.0 | general | general public licen[cs]e( as published by the free software foundation)?( either)?( version| v) 2
gfdl-1.3 | gfdl | gfdl( version)? 1 3
gfdl-1.2 | gfdl | gfdl( version)? 1 2
gfdl-1.3 | documentation | free documentation licen[cs]e version 1 3
gfdl-1.2 | documentation | free documentation licen[cs]e version 1 2
gfdl-1.1 | documentation | free documentation licen[cs]e version 1 1
mpl-2.0 | mpl | mpl( version)?( v)? 2( 0)?
mpl-1.1 | mpl | mpl( version)?( v)? 1 1
mpl-1.0 | mpl | mpl( version)?( v)? 1 0
mpl-2.0 | mozilla | mozilla public licen[cs]e( version| v)? 2( 0)?
mpl-1.1 | mozilla | mozilla public licen[cs]e( version| v)? 1 1
epl-2.0 | epl | epl( v)? 2( 0)?
epl-1.0 | epl | epl( v)? 1( 0)?
epl-2.0 | eclipse | eclipse public licen[cs]e( version| v)? 2( 0)?
epl-1.0 | eclipse | eclipse public licen[cs]e( version| v)? 1( 0)?
cddl-1.1 | cddl | cddl( version)?( v)? 1 1
cddl-1.0 | cddl | cddl( version)?( v)? 1 0
cpl-1.0 | common | common public licen[cs]e( version| v)? 1 0
bsd-2-clause | bsd | bsd 2 clause
bsd-3-clause | bsd | bsd 3 clause
bsd-4-clause | bsd | bsd 4 clause
bsd-2-clause | simplified | simplified bsd( licen[cs]e)?
bsd-3-clause | new | new bsd licen[cs]e
bsd-3-clause | revised | revised bsd( licen[cs]e)?
bsd-4-clause | original | original bsd licen[cs]e
0bsd | 0bsd | 0bsd
bsl-1.0 | bsl | bsl 1 0
bsl-1.0 | boost | boost software licen[cs]e( version)? 1 0
busl-1.1 | business | business source licen[cs]e( version)? 1 1
artistic-2.0 | artistic | artistic( licen[cs]e)?( version)? 2 0
artistic-1.0 | artistic | artistic( licen[cs]e)?( version)? 1 0
ofl-1.1 | ofl | ofl( version)?( v)? 1 1
ofl-1.1 | font | open font licen[cs]e( version)? 1 1
eupl-1.2 | eupl | eupl( version)?( v)? 1 2
eupl-1.1 | eupl | eupl( version)?( v)? 1 1
osl-3.0 | osl | osl 3 0
afl-3.0 | afl | afl 3 0
python-2.0 | python | python software foundation licen[cs]e( version)? 2
php-3.01 | php | php licen[cs]e( version)? 3 01
zpl-2.1 | zpl | zpl( version)? 2 1
ecl-2.0 | community | educational community licen[cs]e( version)? 2 0
upl-1.0 | upl | upl 1 0
mulanpsl-2.0 | mulanpsl | mulanpsl 2 0
cc0-1.0 | cc0 | cc0( 1 0)?( universal)?
cc0-1.0 | zero | creative commons zero( v?1 0)?
cc-pdm-1.0 | mark | public domain mark( 1 0)?
odc-by-1.0 | odc | odc by( 1 0)?
odbl-1.0 | odbl | odbl( v)? 1 0
pddl-1.0 | pddl | pddl( v)? 1 0
ogl-3.0 | government | open government licen[cs]e( v| version)? 3( 0)?
ogl-2.0 | government | open government licen[cs]e( v| version)? 2( 0)?
etalab-2.0 | etalab | (licence ouverte |open licence )?etalab 2 0
openrail | openrail | (creativeml |bigscience |bigcode )?openrail( m)?
llama-community | llama | llama( 2| 3| 3 1| 3 2| 3 3)? community licen[cs]e
"""

_NAMES = """
mit | mit | mit licen[cs]e
mit | mit | (licen[cs]ed|released|distributed|available) under( the)?( terms of the)? mit
mit | expat | expat licen[cs]e
x11 | x11 | x11 licen[cs]e
isc | isc | isc licen[cs]e
bsd | bsd | bsd( style)? licen[cs]e
bsd | berkeley | berkeley software distribution licen[cs]e
apache | apache | apache( software)? licen[cs]e
apache | asl | asl licen[cs]e
agpl | agpl | agpl
agpl | affero | affero general public licen[cs]e
lgpl | lgpl | lgpl
lgpl | lesser | lesser general public licen[cs]e
lgpl | library | gnu library general public licen[cs]e
gpl | gpl | gpl
gpl | gnu | gnu general public licen[cs]e
gpl | general | general public licen[cs]e
gpl | gpled | gpled
gfdl | gfdl | gfdl
gfdl | documentation | (gnu )?free documentation licen[cs]e
mpl | mozilla | mozilla public licen[cs]e
epl | eclipse | eclipse public licen[cs]e
cddl | cddl | cddl
cddl | development | common development and distribution licen[cs]e
ms-pl | microsoft | microsoft public licen[cs]e
ms-rl | reciprocal | microsoft reciprocal licen[cs]e
zlib | zlib | zlib( libpng)? licen[cs]e
libpng | libpng | libpng licen[cs]e
boost | boost | boost( software)? licen[cs]e
busl | business | business source licen[cs]e
sspl | sspl | sspl( 1 0)?
sspl | server | server side public licen[cs]e
elastic | elastic | elastic licen[cs]e( 2 0| v2)?
commons-clause | clause | commons clause
unlicense | unlicense | (the )?unlicense
wtfpl | wtfpl | wtfpl
beerware | beerware | beerware
artistic | artistic | artistic licen[cs]e
perl | perl | same terms as perl( itself)?
psf | psf | psf licen[cs]e
psf | python | python software foundation licen[cs]e
php | php | php licen[cs]e
ruby | ruby | ruby licen[cs]e
openssl | openssl | openssl licen[cs]e
ofl | font | (sil )?open font licen[cs]e
ncsa | ncsa | ncsa( open source)? licen[cs]e
eupl | eupl | eupl
eupl | european | european union public licen[cs]e
cecill | cecill | cecill
osl | open | open software licen[cs]e
afl | academic | academic free licen[cs]e
qpl | qpl | qpl
qpl | q | q public licen[cs]e
ipl | ibm | ibm public licen[cs]e
apsl | apple | apple public source licen[cs]e
nasa | nasa | nasa open source agreement
intel | intel | intel open source licen[cs]e
vim | vim | vim licen[cs]e
curl | curl | curl licen[cs]e
w3c | w3c | w3c( software)?( notice and)? licen[cs]e
unicode | unicode | unicode( terms of use| licen[cs]e)
freetype | freetype | freetype( project)? licen[cs]e
cc | commons | creative commons( [^ ]+){0,4} licen[cs]e
cc | creativecommons | creativecommons org licen[cs]es
cc-by-sa | sharealike | creative commons attribution( non( )?commercial)? sharealike
cc-by-sa | share | creative commons attribution( non commercial)? share alike
cc-by-nc | noncommercial | creative commons attribution noncommercial
cc-by-nc | commercial | creative commons attribution non commercial
cc-by-nd | noderivatives | creative commons attribution( noncommercial)? noderivatives
cc-by-nd | noderivs | creative commons attribution( noncommercial)? noderivs
cc-by | attribution | creative commons attribution
cc0 | dedication | (cc0 )?public domain dedication
odbl | odbl | odbl
odbl | database | open database licen[cs]e
odc-by | attribution | open data commons attribution licen[cs]e
cdla | cdla | cdla( permissive| sharing)?( 1 0| 2 0)?
ogl | government | open government licen[cs]e
dbcl | dbcl | dbcl
public-domain | domain | (released |dedicated |placed )?(to |into |in )?(the )?public domain
gutenberg | gutenberg | project gutenberg( licen[cs]e| tm)?
copyleft | copyleft | copyleft
copyleft | copylefted | copylefted
spdx | spdx | spdx licen[cs]e identifier( [^ ]+){0,4}
"""

_HINTS = """
copyright | copyright | copyright( c| ©)?( by)? (19|20)[0-9][0-9]( (19|20)[0-9][0-9]){0,20}
copyright | © | © (19|20)[0-9][0-9]
copyright | copr | copr (19|20)[0-9][0-9]
copyright | copyright | copyright( holders?| owners?| notices?)
copyright | copyrighted | copyrighted( by| material| work)?
copyright | copyright | all contents? copyright
copyright-de | urheberrecht | urheberrecht
copyright-de | urheberrechtlich | urheberrechtlich( geschützt)?
copyright-fr | droits | tous droits réservés
copyright-es | derechos | (todos los )?derechos reservados
copyright-de | rechte | alle rechte vorbehalten
rights-reserved | reserved | (some|no|certain|all) rights reserved
licensed | licensed | licensed (under|to|by|from|for)
licensed | licenced | licenced (under|to|by|from|for)
licensed | license | (under|see|read|accept) (the|this|a|our) license
licensed | licence | (under|see|read|accept) (the|this|a|our) licence
licensed | sublicensed | sublicensed (under|to)
licensed-de | lizenz | (unter )?(der |einer )?lizenz
licensed-de | lizenziert | lizenziert unter
licensed-fr | licence | (sous|une) licence
licensed-es | licencia | (bajo|una) (la |una )?licencia
eula | eula | eula
eula | agreement | end user licen[cs]e agreement
eula | agreement | licen[cs]e agreement
terms | terms | terms (of (use|service)|and conditions)
trademark | trademark | (registered )?trademark( of)?
trademark | trademarks | (registered )?trademarks( of)?
patent | patent | patent( pending| licen[cs]e| grant)
fair-use | fair | fair (use|dealing)
royalty-free | royalty | royalty free
open-source | source | open source( software| licen[cs]e| initiative)?
free-software | foundation | free software foundation
freeware | freeware | freeware
shareware | shareware | shareware
proprietary | proprietary | proprietary( software| licen[cs]e)
dmca | dmca | dmca
takedown | takedown | takedown (notice|request)
attribution-required | attribution | attribution( is)? required
redistribution | redistribute | (may|can|free to) (freely )?redistribute
"""

#: Kinds and versions of one family of licenses; every combination has a signature of its own.
_CC_KINDS = ("by nc sa", "by nc nd", "by sa", "by nc", "by nd", "by")
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
_CC_NAMES = {
    "by": "attribution",
    "by sa": "attribution share( )?alike",
    "by nc": "attribution non( )?commercial",
    "by nd": "attribution no( )?deriv(ative)?s",
    "by nc sa": "attribution non( )?commercial share( )?alike",
    "by nc nd": "attribution non( )?commercial no( )?deriv(ative)?s",
}


def _lines(text: str, tier: int) -> list[tuple[int, str, str, str]]:
    return [(tier, *(x.strip() for x in line.split(" | ", 2))) for line in text.strip().splitlines()]


def _commons() -> list[tuple[int, str, str, str]]:
    rules = []
    for kind, version in product(_CC_KINDS, _CC_VERSIONS):
        label = f"cc-{kind.replace(' ', '-')}-{version.replace(' ', '.')}"
        rules.append((2, label, "cc", f"cc {kind}( v)? {version}"))
        rules.append((2, label, "commons", f"creative commons {_CC_NAMES[kind]} {version}"))
        rules.append((2, label, "creativecommons", f"creativecommons org licen[cs]es {kind} {version}"))
    rules += [(3, f"cc-{kind.replace(' ', '-')}", "cc", f"cc {kind}") for kind in _CC_KINDS]
    return rules


def signatures() -> list[tuple[int, str, str, str]]:
    """`tier, label, keyword, pattern` of every rule, the first of a tier first."""
    rules = [*_lines(_TEXTS, 1), *_lines(_VERSIONS, 2), *_lines(_NAMES, 3), *_lines(_HINTS, 4), *_commons()]
    return sorted(rules, key=lambda r: r[0])
