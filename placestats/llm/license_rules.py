"""Signature rules for licences, written by hand, in order.

One rule a line: label | level | confidence | keywords | pattern. Patterns are matched
against the words of a text in lower case, joined by single spaces (all that is no digit,
ASCII letter or other character beyond ASCII separates words), and begin and end at word
borders. A rule is tried only on texts that hold one of its keywords (parted by commas).
Level 1 is the most specific; a detection gives way to one of its own or a lower level
that covers it. Rules marked `base` are never given up.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

BASE = """
gpl    | 4 | 0.8 | gnu general public license | gnu general public license
apache | 4 | 0.8 | apache license             | apache license
cc-by  | 4 | 0.8 | cc by                      | cc by
mit    | 4 | 0.8 | mit license                | mit license
"""

RULES = r"""
gpl-1.0-only | 1 | 0.95 | general public licen | gnu general public licen[sc]e(?: gpl)? (?:version 1|v1)(?: 0)? only
gpl-1.0-or-later | 1 | 0.95 | general public licen | general public licen[sc]e(?: as published by the free software foundation)? (?:either )?(?:version 1|v1)(?: 0)? or (?:at your option )?any later version
gpl-2.0-only | 1 | 0.95 | general public licen | gnu general public licen[sc]e(?: gpl)? (?:version 2|v2)(?: 0)? only
gpl-2.0-only | 1 | 0.95 | free software foundation | gnu general public licen[sc]e version 2 as published by the free software foundation
gpl-2.0-or-later | 1 | 0.95 | general public licen | general public licen[sc]e(?: as published by the free software foundation)? (?:either )?(?:version 2|v2)(?: 0)?(?: of the licen[sc]e)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0-only | 1 | 0.95 | general public licen | gnu general public licen[sc]e(?: gpl)? (?:version 3|v3)(?: 0)? only
gpl-3.0-or-later | 1 | 0.95 | general public licen | general public licen[sc]e(?: as published by the free software foundation)? (?:either )?(?:version 3|v3)(?: 0)?(?: of the licen[sc]e)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-2.0-or-later | 1 | 0.95 | library general public | library general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 2(?: 0)?(?: of the licen[sc]e)? or (?:at your option )?any later version
lgpl-2.1-only | 1 | 0.95 | lesser general public | lesser general public licen[sc]e(?: lgpl)? (?:version 2 1|v2 1) only
lgpl-2.1-or-later | 1 | 0.95 | lesser general public | lesser general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 2 1(?: of the licen[sc]e)? or (?:at your option )?any later version
lgpl-3.0-only | 1 | 0.95 | lesser general public | lesser general public licen[sc]e(?: lgpl)? (?:version 3|v3)(?: 0)? only
lgpl-3.0-or-later | 1 | 0.95 | lesser general public | lesser general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 3(?: 0)?(?: of the licen[sc]e)? or (?:at your option )?any later version
agpl-3.0-only | 1 | 0.95 | affero general public | affero general public licen[sc]e(?: agpl)? (?:version 3|v3)(?: 0)? only
agpl-3.0-or-later | 1 | 0.95 | affero general public | affero general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 3(?: 0)?(?: of the licen[sc]e)? or (?:at your option )?any later version
gfdl-1.1-or-later | 1 | 0.95 | free documentation licen | free documentation licen[sc]e version 1 1 or any later version
gfdl-1.2-or-later | 1 | 0.95 | free documentation licen | free documentation licen[sc]e version 1 2 or any later version
gfdl-1.3-or-later | 1 | 0.95 | free documentation licen | free documentation licen[sc]e version 1 3 or any later version
apache-2.0 | 1 | 0.98 | apache org licenses | you may not use this file except in compliance with the licen[sc]e you may obtain a copy of the licen[sc]e at https? www apache org licenses license 2 0
mit | 1 | 0.98 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit-0 | 1 | 0.95 | mit no attribution | mit no attribution(?: licen[sc]e)?
isc | 1 | 0.97 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
0bsd | 1 | 0.97 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
bsd-2-clause | 1 | 0.9 | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | 1 | 0.95 | endorse or promote products | neither the names? of \S+(?: \S+){0,12} may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | 1 | 0.95 | all advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
zlib | 1 | 0.95 | origin of this software | the origin of this software must not be misrepresented you must not claim that you wrote the original software
unlicense | 1 | 0.97 | free and unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 1 | 0.97 | you just do what | you just do what the fuck you want to
beerware | 1 | 0.95 | buy me a beer | you can buy me a beer in return
boost-1.0 | 1 | 0.95 | boost software licen | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e
mpl-2.0 | 1 | 0.97 | mozilla public licen | this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
mpl-1.1 | 1 | 0.95 | mozilla public licen | subject to the mozilla public licen[sc]e version 1 1
epl-2.0 | 1 | 0.95 | eclipse public licen | made available under the terms of the eclipse public licen[sc]e (?:v )?2 0
epl-1.0 | 1 | 0.95 | eclipse public licen | made available under the terms of the eclipse public licen[sc]e v1 0
cc0-1.0 | 1 | 0.97 | cc0 | to the extent possible under law \S+(?: \S+){0,8} has waived all copyright and related or neighboring rights
cc-by-4.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by 4 0
cc-by-3.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by 3 0
cc-by-2.5 | 1 | 0.95 | creativecommons org | creativecommons org licenses by 2 5
cc-by-2.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by 2 0
cc-by-sa-4.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by sa 3 0
cc-by-sa-2.5 | 1 | 0.95 | creativecommons org | creativecommons org licenses by sa 2 5
cc-by-nc-4.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nc 4 0
cc-by-nc-3.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nc 3 0
cc-by-nd-4.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nd 4 0
cc-by-nd-3.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nd 3 0
cc-by-nc-sa-4.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 | 1 | 0.95 | creativecommons org | creativecommons org licenses by nc nd 3 0
cc0-1.0 | 1 | 0.95 | creativecommons org | creativecommons org publicdomain zero 1 0
cc-pdm-1.0 | 1 | 0.95 | creativecommons org | creativecommons org publicdomain mark 1 0
gpl-2.0-only | 2 | 0.97 | spdx | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 2 | 0.97 | spdx | spdx license identifier gpl 2 0 or later
gpl-3.0-only | 2 | 0.97 | spdx | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 2 | 0.97 | spdx | spdx license identifier gpl 3 0 or later
lgpl-2.1-only | 2 | 0.97 | spdx | spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later | 2 | 0.97 | spdx | spdx license identifier lgpl 2 1 or later
lgpl-3.0-only | 2 | 0.97 | spdx | spdx license identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later | 2 | 0.97 | spdx | spdx license identifier lgpl 3 0 or later
agpl-3.0-only | 2 | 0.97 | spdx | spdx license identifier agpl 3 0(?: only)?
agpl-3.0-or-later | 2 | 0.97 | spdx | spdx license identifier agpl 3 0 or later
apache-2.0 | 2 | 0.97 | spdx | spdx license identifier apache 2 0
apache-1.1 | 2 | 0.97 | spdx | spdx license identifier apache 1 1
mit | 2 | 0.97 | spdx | spdx license identifier mit
mit-0 | 2 | 0.97 | spdx | spdx license identifier mit 0
isc | 2 | 0.97 | spdx | spdx license identifier isc
0bsd | 2 | 0.97 | spdx | spdx license identifier 0bsd
bsd-2-clause | 2 | 0.97 | spdx | spdx license identifier bsd 2 clause
bsd-3-clause | 2 | 0.97 | spdx | spdx license identifier bsd 3 clause
bsd-4-clause | 2 | 0.97 | spdx | spdx license identifier bsd 4 clause
zlib | 2 | 0.97 | spdx | spdx license identifier zlib
boost-1.0 | 2 | 0.97 | spdx | spdx license identifier bsl 1 0
busl-1.1 | 2 | 0.97 | spdx | spdx license identifier busl 1 1
mpl-1.1 | 2 | 0.97 | spdx | spdx license identifier mpl 1 1
mpl-2.0 | 2 | 0.97 | spdx | spdx license identifier mpl 2 0
epl-1.0 | 2 | 0.97 | spdx | spdx license identifier epl 1 0
epl-2.0 | 2 | 0.97 | spdx | spdx license identifier epl 2 0
eupl-1.2 | 2 | 0.97 | spdx | spdx license identifier eupl 1 2
cddl-1.0 | 2 | 0.97 | spdx | spdx license identifier cddl 1 0
cc0-1.0 | 2 | 0.97 | spdx | spdx license identifier cc0 1 0
cc-by-4.0 | 2 | 0.97 | spdx | spdx license identifier cc by 4 0
cc-by-sa-4.0 | 2 | 0.97 | spdx | spdx license identifier cc by sa 4 0
unlicense | 2 | 0.97 | spdx | spdx license identifier unlicense
wtfpl | 2 | 0.97 | spdx | spdx license identifier wtfpl
artistic-2.0 | 2 | 0.97 | spdx | spdx license identifier artistic 2 0
ofl-1.1 | 2 | 0.97 | spdx | spdx license identifier ofl 1 1
ncsa | 2 | 0.97 | spdx | spdx license identifier ncsa
postgresql | 2 | 0.97 | spdx | spdx license identifier postgresql
python-2.0 | 2 | 0.97 | spdx | spdx license identifier (?:python|psf) 2 0
sspl-1.0 | 2 | 0.97 | spdx | spdx license identifier sspl 1 0
gpl-1.0 | 3 | 0.9 | general public licen | gnu general public licen[sc]e(?: gpl)? (?:version 1|v ?1)(?: 0)?
gpl-2.0 | 3 | 0.9 | general public licen | gnu general public licen[sc]e(?: gpl)? (?:version 2|v ?2)(?: 0)?
gpl-3.0 | 3 | 0.9 | general public licen | gnu general public licen[sc]e(?: gpl)? (?:version 3|v ?3)(?: 0)?
gpl-2.0 | 3 | 0.85 | gpl | (?:gnu )?gpl (?:version |v )?2(?: 0)?
gpl-2.0 | 3 | 0.85 | gplv2 | (?:gnu )?gplv2(?: 0)?
gpl-2.0-or-later | 3 | 0.85 | gpl | gpl 2 0 or later
gpl-3.0 | 3 | 0.85 | gpl | (?:gnu )?gpl (?:version |v )?3(?: 0)?
gpl-3.0 | 3 | 0.85 | gplv3 | (?:gnu )?gplv3(?: 0)?
gpl-3.0-or-later | 3 | 0.85 | gpl | gpl 3 0 or later
lgpl-2.0 | 3 | 0.9 | library general public | gnu library general public licen[sc]e(?: version 2(?: 0)?)?
lgpl-2.1 | 3 | 0.9 | lesser general public | (?:gnu )?lesser general public licen[sc]e(?: lgpl)? (?:version |v ?)2 1
lgpl-3.0 | 3 | 0.9 | lesser general public | (?:gnu )?lesser general public licen[sc]e(?: lgpl)? (?:version |v ?)3(?: 0)?
lgpl-2.1 | 3 | 0.85 | lgpl | (?:gnu )?lgpl(?: version| v)? 2 1
lgpl-2.1 | 3 | 0.85 | lgplv2 | lgplv2 1
lgpl-3.0 | 3 | 0.85 | lgpl | (?:gnu )?lgpl(?: version| v)? 3(?: 0)?
lgpl-3.0 | 3 | 0.85 | lgplv3 | lgplv3(?: 0)?
agpl-3.0 | 3 | 0.9 | affero general public | (?:gnu )?affero general public licen[sc]e(?: agpl)? (?:version |v ?)3(?: 0)?
agpl-3.0 | 3 | 0.85 | agpl | (?:gnu )?agpl(?: version| v)? 3(?: 0)?
agpl-3.0 | 3 | 0.85 | agplv3 | agplv3(?: 0)?
gfdl-1.1 | 3 | 0.9 | free documentation licen | (?:gnu )?free documentation licen[sc]e(?: gfdl)? version 1 1
gfdl-1.2 | 3 | 0.9 | free documentation licen | (?:gnu )?free documentation licen[sc]e(?: gfdl)? version 1 2
gfdl-1.3 | 3 | 0.9 | free documentation licen | (?:gnu )?free documentation licen[sc]e(?: gfdl)? version 1 3
apache-1.0 | 3 | 0.9 | apache | apache (?:software )?licen[sc]e (?:version |v )?1 0
apache-1.1 | 3 | 0.9 | apache | apache (?:software )?licen[sc]e (?:version |v )?1 1
apache-2.0 | 3 | 0.9 | apache | apache (?:software )?licen[sc]e (?:version |v )?2(?: 0)?
apache-2.0 | 3 | 0.9 | apache | apache v?2(?: 0)? licen[sc]ed?
apache-2.0 | 3 | 0.85 | asl | asl 2 0
bsd-2-clause | 3 | 0.9 | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?
bsd-3-clause | 3 | 0.9 | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?
bsd-4-clause | 3 | 0.9 | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?
bsd-3-clause-clear | 3 | 0.9 | clear bsd | clear bsd licen[sc]e
bsd-1-clause | 3 | 0.9 | bsd | (?:bsd 1 clause|1 clause bsd)(?: licen[sc]e)?
mpl-1.0 | 3 | 0.9 | mozilla public | mozilla public licen[sc]e(?: mpl)? (?:version |v )?1 0
mpl-1.1 | 3 | 0.9 | mozilla public | mozilla public licen[sc]e(?: mpl)? (?:version |v )?1 1
mpl-2.0 | 3 | 0.9 | mozilla public | mozilla public licen[sc]e(?: mpl)? (?:version |v )?2(?: 0)?
mpl-2.0 | 3 | 0.85 | mpl | mpl (?:version |v )?2 0
epl-1.0 | 3 | 0.9 | eclipse public | eclipse public licen[sc]e (?:version |v )?1 0
epl-2.0 | 3 | 0.9 | eclipse public | eclipse public licen[sc]e (?:version |v )?2 0
edl-1.0 | 3 | 0.9 | eclipse distribution | eclipse distribution licen[sc]e(?: (?:version |v )?1 0)?
cddl-1.0 | 3 | 0.9 | common development and distribution | common development and distribution licen[sc]e(?: cddl)? (?:version |v )?1 0
cddl-1.1 | 3 | 0.9 | common development and distribution | common development and distribution licen[sc]e(?: cddl)? (?:version |v )?1 1
cpl-1.0 | 3 | 0.9 | common public licen | common public licen[sc]e(?: (?:version |v )?1 0)?
cpal-1.0 | 3 | 0.9 | common public attribution | common public attribution licen[sc]e(?: (?:version |v )?1 0)?
eupl-1.1 | 3 | 0.9 | european union public | european union public licen[sc]e(?: eupl)? (?:version |v ?)1 1
eupl-1.2 | 3 | 0.9 | european union public | european union public licen[sc]e(?: eupl)? (?:version |v ?)1 2
osl-3.0 | 3 | 0.9 | open software licen | open software licen[sc]e (?:version |v )?3 0
afl-3.0 | 3 | 0.9 | academic free licen | academic free licen[sc]e (?:version |v )?3 0
artistic-1.0 | 3 | 0.9 | artistic licen | artistic licen[sc]e (?:version |v )?1 0
artistic-2.0 | 3 | 0.9 | artistic licen | artistic licen[sc]e (?:version |v )?2 0
boost-1.0 | 3 | 0.9 | boost software licen | boost software licen[sc]e (?:version |v )?1 0
ofl-1.1 | 3 | 0.9 | open font licen | (?:sil )?open font licen[sc]e (?:version |v )?1 1
lppl-1.3 | 3 | 0.9 | latex project public | latex project public licen[sc]e (?:version |v )?1 3c?
ms-pl | 3 | 0.9 | microsoft public licen | microsoft public licen[sc]e
ms-rl | 3 | 0.9 | microsoft reciprocal | microsoft reciprocal licen[sc]e
odbl-1.0 | 3 | 0.9 | open database licen | (?:odc )?open database licen[sc]e(?: odbl)?(?: v?1 0)?
odc-by-1.0 | 3 | 0.9 | data commons attribution | open data commons attribution licen[sc]e(?: v?1 0)?
pddl-1.0 | 3 | 0.9 | public domain dedication | open data commons public domain dedication(?: and| licen[sc]e)+(?: v?1 0)?
cdla-permissive-2.0 | 3 | 0.9 | community data licen | community data licen[sc]e agreement permissive(?: version)? 2 0
cdla-permissive-1.0 | 3 | 0.9 | community data licen | community data licen[sc]e agreement permissive(?: version)? 1 0
cdla-sharing-1.0 | 3 | 0.9 | community data licen | community data licen[sc]e agreement sharing(?: version 1 0)?
sspl-1.0 | 3 | 0.9 | server side public | server side public licen[sc]e(?: sspl)?(?: (?:version |v )?1(?: 0)?)?
busl-1.1 | 3 | 0.9 | business source licen | business source licen[sc]e(?: (?:version )?1 1)?
elastic-2.0 | 3 | 0.9 | elastic licen | elastic licen[sc]e(?: (?:version )?2 0)?
polyform-noncommercial-1.0 | 3 | 0.9 | polyform | polyform noncommercial licen[sc]e(?: 1 0 0)?
polyform-small-business-1.0 | 3 | 0.9 | polyform | polyform small business licen[sc]e(?: 1 0 0)?
upl-1.0 | 3 | 0.9 | universal permissive | universal permissive licen[sc]e(?: (?:version |v )?1 0)?
ncsa | 3 | 0.9 | ncsa | (?:university of illinois )?ncsa (?:open source )?licen[sc]e
ecl-2.0 | 3 | 0.9 | educational community | educational community licen[sc]e(?: (?:version |v )?2 0)?
python-2.0 | 3 | 0.9 | python software foundation | python software foundation licen[sc]e(?: (?:version |v )?2)?
openssl | 3 | 0.85 | openssl | openssl licen[sc]e
php-3.01 | 3 | 0.9 | php licen | php licen[sc]e(?: (?:version |v )?3 01)?
zpl-2.1 | 3 | 0.9 | zope public | zope public licen[sc]e(?: (?:version |v )?2 1)?
ipl-1.0 | 3 | 0.9 | ibm public | ibm public licen[sc]e(?: (?:version |v )?1 0)?
apsl-2.0 | 3 | 0.9 | apple public source | apple public source licen[sc]e(?: (?:version |v )?2 0)?
qpl-1.0 | 3 | 0.9 | q public licen | q public licen[sc]e(?: (?:version |v )?1 0)?
cecill-2.1 | 3 | 0.9 | cecill | (?:licence )?cecill (?:version |v )?2 1
cecill-b | 3 | 0.9 | cecill b | (?:licence )?cecill b
cecill-c | 3 | 0.9 | cecill c | (?:licence )?cecill c
mulan-psl-2.0 | 3 | 0.9 | mulan | mulan (?:psl|permissive software licen[sc]e)(?: v2)?
openrail-m | 3 | 0.9 | openrail | (?:creativeml |bigscience )?openrail(?:\+\+)? m(?: licen[sc]e)?
ogl-uk-3.0 | 3 | 0.9 | open government licen | open government licen[sc]e (?:version |v)?3 0
etalab-2.0 | 3 | 0.9 | licence ouverte | licence ouverte(?: etalab)?(?: version)? 2 0
dl-de-by-2.0 | 3 | 0.9 | datenlizenz deutschland | datenlizenz deutschland(?: version 2 0)? namensnennung(?: version)?(?: 2 0)?
dl-de-zero-2.0 | 3 | 0.9 | datenlizenz deutschland | datenlizenz deutschland zero(?: version)?(?: 2 0)?
cc-by-1.0 | 3 | 0.9 | cc by | cc by 1 0
cc-by-2.0 | 3 | 0.9 | cc by | cc by 2 0
cc-by-2.5 | 3 | 0.9 | cc by | cc by 2 5
cc-by-3.0 | 3 | 0.9 | cc by | cc by 3 0
cc-by-4.0 | 3 | 0.9 | cc by | cc by 4 0
cc-by-sa-2.0 | 3 | 0.9 | cc by sa | cc by sa 2 0
cc-by-sa-2.5 | 3 | 0.9 | cc by sa | cc by sa 2 5
cc-by-sa-3.0 | 3 | 0.9 | cc by sa | cc by sa 3 0
cc-by-sa-4.0 | 3 | 0.9 | cc by sa | cc by sa 4 0
cc-by-nc-2.0 | 3 | 0.9 | cc by nc | cc by nc 2 0
cc-by-nc-3.0 | 3 | 0.9 | cc by nc | cc by nc 3 0
cc-by-nc-4.0 | 3 | 0.9 | cc by nc | cc by nc 4 0
cc-by-nd-3.0 | 3 | 0.9 | cc by nd | cc by nd 3 0
cc-by-nd-4.0 | 3 | 0.9 | cc by nd | cc by nd 4 0
cc-by-nc-sa-3.0 | 3 | 0.9 | cc by nc sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 3 | 0.9 | cc by nc sa | cc by nc sa 4 0
cc-by-nc-nd-3.0 | 3 | 0.9 | cc by nc nd | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 3 | 0.9 | cc by nc nd | cc by nc nd 4 0
cc0-1.0 | 3 | 0.9 | cc0 | cc0(?: 1 0)?(?: universal)?
cc-by-4.0 | 3 | 0.9 | creative commons | creative commons attribution 4 0(?: international)?(?: licen[sc]e)?
cc-by-3.0 | 3 | 0.9 | creative commons | creative commons attribution 3 0(?: unported)?(?: licen[sc]e)?
cc-by-sa-4.0 | 3 | 0.9 | creative commons | creative commons attribution share ?alike 4 0(?: international)?(?: licen[sc]e)?
cc-by-sa-3.0 | 3 | 0.9 | creative commons | creative commons attribution share ?alike 3 0(?: unported)?(?: licen[sc]e)?
cc-by-nc-4.0 | 3 | 0.9 | creative commons | creative commons attribution non ?commercial 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc-3.0 | 3 | 0.9 | creative commons | creative commons attribution non ?commercial 3 0(?: unported)?(?: licen[sc]e)?
cc-by-nd-4.0 | 3 | 0.9 | creative commons | creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc-sa-4.0 | 3 | 0.9 | creative commons | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc-nd-4.0 | 3 | 0.9 | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[sc]e)?
cc0-1.0 | 3 | 0.9 | creative commons | creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?(?: public domain dedication)?
gpl-with-classpath-exception | 3 | 0.9 | classpath exception | (?:gpl|licen[sc]e)(?: \S+){0,4} with (?:the )?classpath exception
gpl-with-linking-exception | 3 | 0.85 | linking exception | (?:gpl|licen[sc]e)(?: \S+){0,4} with (?:a |the )?linking exception
lgpl | 4 | 0.8 | lesser general public | (?:gnu )?lesser general public licen[sc]e
lgpl | 4 | 0.7 | lgpl | lgpl
agpl | 4 | 0.8 | affero general public | (?:gnu )?affero general public licen[sc]e
agpl | 4 | 0.7 | agpl | agpl
gpl | 4 | 0.8 | general public licence | gnu general public licence
gpl | 4 | 0.75 | general public licen | general public licen[sc]e
gpl | 4 | 0.7 | gpl | gpl(?:ed)?
gpl | 4 | 0.75 | licence publique g | licence publique générale(?: gnu)?
gpl | 4 | 0.75 | licencia p | licencia pública general(?: de gnu)?
gfdl | 4 | 0.8 | free documentation licen | (?:gnu )?free documentation licen[sc]e
gfdl | 4 | 0.7 | gfdl | gfdl
apache | 4 | 0.75 | apache | apache (?:software )?licence
apache | 4 | 0.75 | apache software licen | apache software license
apache | 4 | 0.7 | apache lizenz | apache lizenz
mit | 4 | 0.75 | mit | mit licence
mit | 4 | 0.7 | mit lizenz | mit lizenz
mit | 4 | 0.75 | x11 licen | (?:mit )?x11 licen[sc]e
mit | 4 | 0.75 | expat licen | expat licen[sc]e
mit | 4 | 0.75 | licence mit | licence mit
mit | 4 | 0.75 | licencia mit | licencia mit
bsd | 4 | 0.8 | bsd | bsd(?: style)? licen[sc]ed?
isc | 4 | 0.8 | isc licen | isc licen[sc]e
zlib | 4 | 0.8 | zlib | zlib(?: libpng)? licen[sc]e
mpl | 4 | 0.8 | mozilla public | mozilla public licen[sc]e
epl | 4 | 0.8 | eclipse public | eclipse public licen[sc]e
cddl | 4 | 0.8 | common development and distribution | common development and distribution licen[sc]e
eupl | 4 | 0.8 | european union public | european union public licen[sc]e
artistic | 4 | 0.75 | artistic licen | artistic licen[sc]e
boost | 4 | 0.75 | boost software licen | boost software licen[sc]e
ofl | 4 | 0.75 | open font licen | (?:sil )?open font licen[sc]e
unlicense | 4 | 0.75 | unlicense | (?:the )?unlicense
wtfpl | 4 | 0.8 | wtfpl | wtfpl
ogl-uk | 4 | 0.75 | open government licen | open government licen[sc]e
etalab | 4 | 0.75 | licence ouverte | licence ouverte
cc-by-sa | 4 | 0.8 | cc by sa | cc by sa
cc-by-nc | 4 | 0.8 | cc by nc | cc by nc
cc-by-nd | 4 | 0.8 | cc by nd | cc by nd
cc-by-nc-sa | 4 | 0.8 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 4 | 0.8 | cc by nc nd | cc by nc nd
cc-by | 4 | 0.75 | creative commons | creative commons attribution(?: licen[sc]e)?
cc-by-sa | 4 | 0.8 | creative commons | creative commons attribution share ?alike(?: licen[sc]e)?
cc-by-nc | 4 | 0.8 | creative commons | creative commons attribution non ?commercial(?: licen[sc]e)?
creative-commons | 5 | 0.6 | creative commons | (?:under|the|a) creative commons(?: licen[sc]es?)?
public-domain | 5 | 0.6 | public domain | (?:released|placed|dedicated|is) (?:into |in |to )?the public domain
public-domain | 5 | 0.5 | domaine public | domaine public
public-domain | 5 | 0.5 | gemeinfrei | gemeinfrei
public-domain | 5 | 0.5 | dominio p | dominio público
proprietary | 5 | 0.6 | proprietary and confidential | proprietary and confidential
proprietary | 5 | 0.5 | all rights reserved | all rights reserved
proprietary | 5 | 0.5 | tous droits | tous droits réservés
proprietary | 5 | 0.5 | alle rechte vorbehalten | alle rechte vorbehalten
proprietary | 5 | 0.5 | todos los derechos | todos los derechos reservados
non-commercial | 5 | 0.5 | commercial use | (?:for )?non ?commercial use only
research-only | 5 | 0.5 | research purposes only | (?:for )?research purposes only
end-user-licence | 5 | 0.5 | end user licen | end user licen[sc]e agreement
open-source | 5 | 0.4 | open source licen | open source licen[sc]es?
"""


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    level: int
    confidence: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    base: bool


def _rules() -> list[Rule]:
    out = []
    for text, base in ((BASE, True), (RULES, False)):
        for line in text.strip().splitlines():
            label, level, confidence, keywords, pattern = (x.strip() for x in line.split(" | ", 4))
            words = tuple(k.strip().encode() for k in keywords.split(","))
            out.append(Rule(len(out), label, int(level), float(confidence), words, re.compile(b" (?:" + pattern.encode() + b")(?= )"), base))
    return out


ALL = _rules()
