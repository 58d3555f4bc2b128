"""Signatures of licences, over words: lower case, one blank between two words, all punctuation gone.

A line is `kind keyword: regular expression`; the keyword is a word that every
match holds. The order of the lines settles ties. Identifier tags are built from
a list of identifiers.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# priority (smaller goes first) and confidence of each kind
KINDS = {"base": (0, 1.0), "tag": (1, 1.0), "notice": (2, 0.95), "url": (3, 0.9), "title": (4, 0.8), "name": (5, 0.5)}

# The phrases that are always reported.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

SIGNATURES = r"""
[mit]
notice mit: (?:released|licensed|licenced|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?mit licen[sc]e
notice granted: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
notice mit: subject to the terms of the mit licen[sc]e
notice mit: dual licensed under (?:the )?mit
notice mit: see (?:the )?license(?: file)? for (?:the )?mit licen[sc]e
url mit: opensource org licenses? mit(?: license)?(?: php| html)?
url mit: choosealicense com licenses mit
url mit: mit license org
title mit: the mit licen[sc]e
title expat: expat licen[sc]e
name mit: mit licen[sc]ed?
name mit: licen[sc]e mit
[mit-0]
notice attribution: mit no attribution(?: licen[sc]e)?
name mit: mit 0(?: licen[sc]e)
[x11]
notice x11: (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?x11 licen[sc]e
notice consortium: except as contained in this notice the name of the x consortium shall not be used
title x11: (?:the )?x11 licen[sc]e
[apache-2]
notice apache: (?:licensed|licenced|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?apache licen[sc]e(?: version)? v?2(?: 0)?
notice compliance: you may not use this file except in compliance with the license you may obtain a copy of the license at(?: https?)? www apache org licenses license 2 0
notice apache: subject to the terms of the apache licen[sc]e(?: version)? 2(?: 0)?
notice apache: dual licensed under (?:the )?apache(?: licen[sc]e)?(?: version)? 2
url apache: apache org licenses license 2 0(?: txt| html)?
url apache: opensource org licenses? apache 2 0(?: php)?
title apache: apache licen[sc]e version 2(?: 0)?
title apache: apache licen[sc]e v?2(?: 0)?
title apache: apache software licen[sc]e(?: version)? 2(?: 0)?
name apache: apache 2 0(?: licen[sc]ed?)?
name asl: asl v?2(?: 0)?
[apache-1.1]
notice apache: this product includes software developed by the apache software foundation
title apache: apache(?: software)? licen[sc]e(?: version)? 1 1
[apache-1]
notice apache: this product includes software developed by the apache group for use in the apache http server project
title apache: apache(?: software)? licen[sc]e(?: version)? 1 0
[gpl-1]
notice general: under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 1
title general: gnu general public licen[sc]e(?: gpl)?(?: version| v)? 1(?: 0)?
title gplv1: gplv1
name gpl: gpl 1(?: 0)?(?: only| or later)?
[gpl-2]
notice general: under the terms of the gnu general public licen[sc]e(?: version 2)? as published by the free software foundation (?:either )?version 2
notice general: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[sc]e(?: gpl)?(?: version| v) 2(?: 0)?
notice gpl: (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?gpl(?: version| v)? 2(?: 0)?
url gpl: gnu org licenses (?:old licenses )?gpl 2 0(?: txt| html| en html)?
url gpl: opensource org licenses? gpl 2 0(?: php)?
title general: (?:gnu )?general public licen[sc]e(?: gpl)?(?: version| v) 2(?: 0)?
title gplv2: (?:gnu )?gplv2
name gpl: (?:gnu )?gpl(?: version| v)? 2(?: 0)?(?: only| or later)?
[gpl-3]
notice general: under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 3
notice general: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[sc]e(?: gpl)?(?: version| v) 3(?: 0)?
notice gpl: (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?gpl(?: version| v)? 3(?: 0)?
url gpl: gnu org licenses gpl 3 0(?: txt| html| en html)?
url gpl: opensource org licenses? gpl 3 0(?: php)?
title general: (?:gnu )?general public licen[sc]e(?: gpl)?(?: version| v) 3(?: 0)?
title gplv3: (?:gnu )?gplv3
name gpl: (?:gnu )?gpl(?: version| v)? 3(?: 0)?(?: only| or later)?
[gpl]
notice gnu: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[sc]e
notice gnu: you should have received a copy of the gnu general public licen[sc]e along with this program
notice gnu: see the gnu general public licen[sc]e for more details
notice gpl: (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?gpl
url gpl: gnu org (?:copyleft|licenses) gpl(?: txt| html| en html)?
title gnu: gnu general public licen[sc]e
name gnu: gnu gpl
[lgpl-2]
notice library: under the terms of the gnu library general public licen[sc]e as published by the free software foundation
url lgpl: gnu org licenses (?:old licenses )?lgpl 2 0(?: txt| html| en html)?
title library: gnu library general public licen[sc]e(?: version| v)?(?: 2(?: 0)?)?
[lgpl-2.1]
notice lesser: under the terms of the gnu lesser general public licen[sc]e(?: version 2 1)? as published by the free software foundation (?:either )?version 2 1
notice lesser: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu lesser general public licen[sc]e(?: lgpl)?(?: version| v) 2 1
url lgpl: gnu org licenses (?:old licenses )?lgpl 2 1(?: txt| html| en html)?
url lgpl: opensource org licenses? lgpl 2 1(?: php)?
title lesser: (?:gnu )?lesser general public licen[sc]e(?: lgpl)?(?: version| v) 2 1
title lgplv2: lgplv2 1
name lgpl: (?:gnu )?lgpl(?: version| v)? 2 1(?: only| or later)?
[lgpl-3]
notice lesser: under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation either version 3
notice lesser: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu lesser general public licen[sc]e(?: lgpl)?(?: version| v) 3(?: 0)?
url lgpl: gnu org licenses lgpl 3 0(?: txt| html| en html)?
title lesser: (?:gnu )?lesser general public licen[sc]e(?: lgpl)?(?: version| v) 3(?: 0)?
title lgplv3: lgplv3
name lgpl: (?:gnu )?lgpl(?: version| v)? 3(?: 0)?(?: only| or later)?
[lgpl]
notice lesser: you should have received a copy of the gnu lesser general public licen[sc]e along with this (?:program|library)
notice lesser: see the gnu lesser general public licen[sc]e for more details
url lgpl: gnu org (?:copyleft|licenses) lgpl(?: txt| html| en html)?
title lesser: gnu lesser general public licen[sc]e
name lgpl: gnu lgpl
[agpl-3]
notice affero: under the terms of the gnu affero general public licen[sc]e(?: version 3)? as published by the free software foundation (?:either )?version 3
notice affero: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?gnu affero general public licen[sc]e(?: agpl)?(?: version| v)? 3(?: 0)?
url agpl: gnu org licenses agpl(?: 3 0)?(?: txt| html| en html)?
url agpl: opensource org licenses? agpl 3 0(?: php)?
title affero: (?:gnu )?affero general public licen[sc]e(?: agpl)?(?: version| v) 3(?: 0)?
title agplv3: (?:gnu )?agplv3
name agpl: (?:gnu )?agpl(?: version| v)? 3(?: 0)?(?: only| or later)?
[agpl]
notice affero: you should have received a copy of the gnu affero general public licen[sc]e along with this program
title affero: gnu affero general public licen[sc]e
name agpl: gnu agpl
[gfdl]
notice documentation: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e
url fdl: gnu org (?:copyleft|licenses) fdl(?: 1 [0-9])?(?: txt| html| en html)?
title documentation: gnu free documentation licen[sc]e(?: version 1 [0-9])?
name gfdl: (?:gnu )?gfdl(?: 1 [0-9])?
name fdl: gnu fdl(?: 1 [0-9])?
[bsd-2]
notice clause: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?bsd 2 clause(?: licen[sc]e)?
notice freebsd: the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies either expressed or implied of the freebsd project
url bsd: opensource org licenses? bsd 2 clause(?: php)?
title simplified: simplified bsd licen[sc]e
title freebsd: freebsd licen[sc]e
title clause: (?:bsd )?(?:2|two) clause bsd(?: licen[sc]e)?
title clause: bsd (?:2|two) clause(?: licen[sc]e)?
[bsd-3]
notice clause: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?bsd 3 clause(?: licen[sc]e)?
notice endorse: neither the name of [^ ]+(?: [^ ]+){0,12} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
url bsd: opensource org licenses? bsd 3 clause(?: php)?
title revised: revised bsd licen[sc]e
title modified: modified bsd licen[sc]e
title new: new bsd licen[sc]e
title clause: (?:bsd )?(?:3|three) clause bsd(?: licen[sc]e)?
title clause: bsd (?:3|three) clause(?: licen[sc]e)?
[bsd-4]
notice advertising: all advertising materials mentioning features or use of this software must display the following acknowledge?ment
title original: original bsd licen[sc]e
title clause: (?:4|four) clause bsd(?: licen[sc]e)?|bsd (?:4|four) clause(?: licen[sc]e)?
[bsd]
notice redistribution: redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
notice bsd: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the |a )?bsd(?: style)? licen[sc]e
notice bsd: use of this source code is governed by a bsd(?: style)? licen[sc]e that can be found in the licen[sc]e file
url bsd: opensource org licenses? bsd license(?: php)?
title bsd: (?:the )?bsd(?: style)? licen[sc]e
[0bsd]
notice zero: (?:licensed|released|distributed) under (?:the )?zero clause bsd(?: licen[sc]e)?
title zero: (?:bsd )?zero clause bsd(?: licen[sc]e)?
name 0bsd: 0bsd(?: licen[sc]e)?
[isc]
notice isc: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?isc licen[sc]e
notice permission: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
url isc: opensource org licenses? isc(?: license)?(?: txt)?
title isc: (?:the )?isc licen[sc]e
[zlib]
notice altered: altered source versions must be plainly marked as such and must not be misrepresented as being the original software
notice zlib: (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?zlib(?: libpng)? licen[sc]e
url zlib: opensource org licenses? zlib(?: license)?(?: php)?
title zlib: (?:the )?zlib(?: libpng)? licen[sc]e
[libpng]
title libpng: (?:the )?libpng licen[sc]e(?: version 2)?
[boost-1]
notice boost: (?:distributed|licensed|released) under the boost software licen[sc]e(?: version 1 0)?
url boost: boost org license 1 0(?: txt)?
title boost: boost software licen[sc]e(?: version)?(?: 1 0)?
name bsl: bsl 1 0
[mpl-1.1]
notice mozilla: the contents of this file are subject to the mozilla public licen[sc]e version 1 1
url mpl: mozilla org mpl(?: mpl)? 1 1(?: txt| html)?
title mozilla: mozilla public licen[sc]e(?: mpl)?(?: version| v)? 1 1
name mpl: mpl(?: version| v)? 1 1
[mpl-2]
notice mozilla: this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
notice mozilla: (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?mozilla public licen[sc]e(?: mpl)?(?: version| v)? 2(?: 0)?
notice mpl: if a copy of the mpl was not distributed with this file you can obtain one at
url mpl: mozilla org mpl 2 0
url mpl: opensource org licenses? mpl 2 0(?: php)?
title mozilla: mozilla public licen[sc]e(?: mpl)?(?: version| v)? 2(?: 0)?
name mpl: mpl(?: version| v)? 2(?: 0)?
[mpl]
title mozilla: mozilla public licen[sc]e
[epl-1]
notice eclipse: this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v1 0
url epl: eclipse org legal epl v10(?: html)?
title eclipse: eclipse public licen[sc]e(?: version| v)? v?1(?: 0)?
name epl: epl(?: version| v)? 1(?: 0)?
[epl-2]
notice eclipse: this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e(?: v)? 2 0
url epl: eclipse org legal epl (?:2 0|v20)(?: html)?
title eclipse: eclipse public licen[sc]e(?: version| v)? v?2(?: 0)?
name epl: epl(?: version| v)? 2(?: 0)?
[edl-1]
title eclipse: eclipse distribution licen[sc]e(?: version| v)?(?: 1 0)?
[cddl-1]
notice cddl: the contents of this file are subject to the terms of the common development and distribution licen[sc]e(?: the licen[sc]e)? cddl
url cddl: opensource org licenses? cddl 1(?: 0)?(?: php)?
title development: common development and distribution licen[sc]e(?: cddl)?(?: version| v)?(?: 1 [01])?
name cddl: cddl(?: version| v)? 1(?: [01])?
[cpl-1]
title common: common public licen[sc]e(?: version| v)?(?: 1 0)?
[ipl-1]
title ibm: ibm public licen[sc]e(?: version| v)?(?: 1 0)?
[artistic-1]
title artistic: artistic licen[sc]e(?: version)? 1(?: 0)?
[artistic-2]
notice artistic: (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?artistic licen[sc]e(?: version)? 2(?: 0)?
url artistic: opensource org licenses? artistic license 2 0(?: php)?
title artistic: artistic licen[sc]e(?: version)? 2(?: 0)?
[artistic]
notice perl: (?:it )?under the same terms as perl itself
title artistic: (?:perl )?artistic licen[sc]e
[unlicense]
notice unencumbered: this is free and unencumbered software released into the public domain
url unlicense: unlicense org
title unlicense: the unlicense
[wtfpl]
notice fuck: you just do what the fuck you want to
title wtfpl: do what the fuck you want to public licen[sc]e wtfpl
name wtfpl: wtfpl
[public-domain]
notice dedicated: dedicated to the public domain
notice domain: (?:released|placed|put) (?:in|into) the public domain
notice domain: this (?:file|work|software|code) is in the public domain
[cc0]
notice waived: to the extent possible under law [^ ]+(?: [^ ]+){0,12} has waived all copyright and related or neighboring rights to this work
notice cc0: (?:licensed|released|available) under (?:the )?cc0(?: 1 0)?(?: universal)?
url zero: creativecommons org publicdomain zero 1 0
title cc0: cc0 1 0 universal
title zero: creative commons zero(?: 1 0)?(?: universal)?
title cc0: creative commons cc0(?: 1 0)?(?: universal)?
name cc0: cc0 licen[sc]e
name cc0: cc0 1 0
[cc-by]
notice attribution: licensed under (?:a |the )?creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e
url creativecommons: creativecommons org licenses by [1-4] [05]
title attribution: creative commons attribution [1-4] [05](?: international| unported| generic)?
title attribution: creative commons attribution licen[sc]e
name cc: cc by [1-4] [05]
[cc-by-sa]
notice sharealike: licensed under (?:a |the )?creative commons attribution sharealike(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e
title sharealike: creative commons attribution sharealike(?: [1-4] [05])?(?: international| unported| generic)?
url sa: creativecommons org licenses by sa [1-4] [05]
title alike: creative commons attribution share alike(?: [1-4] [05])?(?: international| unported| generic)?
name sa: cc by sa(?: [1-4] [05])?
[cc-by-nd]
url nd: creativecommons org licenses by nd [1-4] [05]
title noderivatives: creative commons attribution noderivatives(?: [1-4] [05])?(?: international| unported)?
title noderivs: creative commons attribution noderivs(?: [1-4] [05])?(?: international| unported)?
name nd: cc by nd(?: [1-4] [05])?
[cc-by-nc]
notice noncommercial: licensed under (?:a |the )?creative commons attribution noncommercial(?: [1-4] [05])?(?: international| unported| generic)? licen[sc]e
url nc: creativecommons org licenses by nc [1-4] [05]
title noncommercial: creative commons attribution noncommercial(?: [1-4] [05])?(?: international| unported| generic)?
title commercial: creative commons attribution non commercial(?: [1-4] [05])?(?: international| unported| generic)?
name nc: cc by nc(?: [1-4] [05])?
[cc-by-nc-sa]
url sa: creativecommons org licenses by nc sa [1-4] [05]
title sharealike: creative commons attribution non ?commercial sharealike(?: [1-4] [05])?(?: international| unported| generic)?
title alike: creative commons attribution non ?commercial share alike(?: [1-4] [05])?(?: international| unported| generic)?
name sa: cc by nc sa(?: [1-4] [05])?
[cc-by-nc-nd]
url nd: creativecommons org licenses by nc nd [1-4] [05]
title noderivatives: creative commons attribution non ?commercial noderivatives(?: [1-4] [05])?(?: international| unported| generic)?
title noderivs: creative commons attribution non ?commercial noderivs(?: [1-4] [05])?(?: international| unported| generic)?
name nd: cc by nc nd(?: [1-4] [05])?
[odbl]
notice odbl: made available under the open database licen[sc]e(?: odbl)|under the odbl
url odbl: opendatacommons org licenses odbl(?: 1 0)?
title database: open database licen[sc]e(?: odbl)?(?: v1 0)?
[odc-by]
url opendatacommons: opendatacommons org licenses by(?: 1 0)?
title commons: open data commons attribution licen[sc]e(?: odc by)?
name odc: odc by(?: 1 0)?
[pddl]
url pddl: opendatacommons org licenses pddl(?: 1 0)?
title domain: (?:open data commons )?public domain dedication and licen[sc]e(?: pddl)?
[ofl-1.1]
notice sil: this font software is licensed under the sil open font licen[sc]e(?: version)?(?: 1 1)?
url ofl: scripts sil org ofl
title font: sil open font licen[sc]e(?: ofl)?(?: version)?(?: 1 1)?
name ofl: ofl 1 1
[psf-2]
notice psf: psf hereby grants licensee a nonexclusive royalty free world wide licen[sc]e
title python: python software foundation licen[sc]e(?: version)?(?: 2)?
name psf: psf licen[sc]e
[python-2]
title python: python licen[sc]e(?: version)? 2 0
[ruby]
notice ruby: (?:under|on) the same terms as ruby(?: itself)?
title ruby: ruby(?: s)? licen[sc]e
[php-3]
notice php: this source file is subject to version 3(?: 0| 01)? of the php licen[sc]e
url php: php net license 3(?: 0| 01)(?: txt)?
title php: php licen[sc]e(?: version)? 3(?: 0| 01)?
[postgresql]
title postgresql: (?:the )?postgresql licen[sc]e
[openssl]
notice openssl: this product includes software developed by the openssl project for use in the openssl toolkit
title openssl: openssl licen[sc]e
[eupl-1.1]
title union: european union public licen[sc]e(?: eupl)?(?: version| v)? v?1 1
name eupl: eupl(?: version)? v?1 1
[eupl-1.2]
notice eupl: licensed under the eupl(?: version)? 1 2
title union: european union public licen[sc]e(?: eupl)?(?: version| v)? v?1 2
name eupl: eupl(?: version)? v?1 2
[ms-pl]
title microsoft: microsoft public licen[sc]e(?: ms pl)?
name ms: ms pl
[ms-rl]
title microsoft: microsoft reciprocal licen[sc]e(?: ms rl)?
name ms: ms rl
[afl-3]
title academic: academic free licen[sc]e(?: afl)?(?: version| v)?(?: 3 0)?
[osl-3]
title software: open software licen[sc]e(?: osl)?(?: version| v)?(?: 3 0)?
[qpl-1]
title q: q public licen[sc]e(?: version)?(?: 1 0)?
[ncsa]
title illinois: university of illinois ncsa open source licen[sc]e
name ncsa: ncsa(?: open source)? licen[sc]e
[upl-1]
title universal: universal permissive licen[sc]e(?: upl)?(?: version| v)?(?: 1 0)?
[cecill-2]
title cecill: cecill(?: free software licen[sc]e)?(?: agreement)?(?: version| v)? 2(?: [01])?
[cecill]
notice cecill: this software is governed by the cecill(?: [bc])? licen[sc]e under french law
[sspl-1]
title server: server side public licen[sc]e(?: sspl)?(?: version| v)?(?: 1)?
[busl-1.1]
title business: business source licen[sc]e(?: busl?)?(?: version)?(?: 1 1)?
[elastic-2]
title elastic: elastic licen[sc]e(?: version)?(?: v2| 2 0)?
[commons-clause]
notice commons: commons clause licen[sc]e condition(?: v1 0)?
[beerware]
notice whatever: as long as you retain this notice you can do whatever you want with this stuff
title beerware: (?:the )?beerware licen[sc]e(?: revision 42)?
[json]
notice evil: the software shall be used for good not evil
title json: (?:the )?json licen[sc]e
[curl]
title curl: curl licen[sc]e
[vim]
title vim: vim licen[sc]e
[tcl]
title tcl: tcl tk licen[sc]e
[w3c]
title w3c: w3c software(?: and document)?(?: notice and)? licen[sc]e
[unicode]
title unicode: unicode(?: inc)? licen[sc]e(?: agreement| v3)?
[blueoak-1]
title blue: blue oak model licen[sc]e(?: version)?(?: 1 0 0)?
[mulan-2]
title mulan: mulan (?:permissive software licen[sc]e|psl)(?: version| v2)?(?: 2)?
[openrail]
title openrail: (?:creativeml |bigscience |bigcode )?openrail(?: [ms])?(?: licen[sc]e)?(?: v1)?
title responsible: responsible ai licen[sc]e(?: rail)?
title bigscience: bigscience rail licen[sc]e
[llama-community]
title llama: llama [2-4](?: [0-9])? community licen[sc]e(?: agreement)?
[all-rights-reserved]
notice reserved: copyright (?:[^ ]+ ){1,10}all rights reserved
[proprietary]
notice proprietary: this (?:software|code|document) is (?:the )?(?:confidential and )?proprietary(?: and confidential)?(?: information)?
notice prohibited: unauthori[sz]ed copying of this file via any medium is strictly prohibited
"""

# identifiers of the tag `SPDX-License-Identifier:` and the labels they stand for
IDENTIFIERS = """
mit=MIT mit-0=MIT-0 x11=X11 apache-2=Apache-2.0 apache-1.1=Apache-1.1 apache-1=Apache-1.0 gpl-1=GPL-1.0 gpl-2=GPL-2.0 gpl-3=GPL-3.0
lgpl-2=LGPL-2.0 lgpl-2.1=LGPL-2.1 lgpl-3=LGPL-3.0 agpl-3=AGPL-3.0 gfdl=GFDL-1.1 gfdl=GFDL-1.2 gfdl=GFDL-1.3 bsd-2=BSD-2-Clause
bsd-3=BSD-3-Clause bsd-4=BSD-4-Clause 0bsd=0BSD isc=ISC zlib=Zlib libpng=Libpng boost-1=BSL-1.0 mpl-1.1=MPL-1.1 mpl-2=MPL-2.0
epl-1=EPL-1.0 epl-2=EPL-2.0 cddl-1=CDDL-1.0 cddl-1=CDDL-1.1 cpl-1=CPL-1.0 ipl-1=IPL-1.0 artistic-1=Artistic-1.0 artistic-2=Artistic-2.0
unlicense=Unlicense wtfpl=WTFPL cc0=CC0-1.0 cc-by=CC-BY-3.0 cc-by=CC-BY-4.0 cc-by-sa=CC-BY-SA-3.0 cc-by-sa=CC-BY-SA-4.0
cc-by-nd=CC-BY-ND-4.0 cc-by-nc=CC-BY-NC-4.0 cc-by-nc-sa=CC-BY-NC-SA-4.0 cc-by-nc-nd=CC-BY-NC-ND-4.0 odbl=ODbL-1.0 odc-by=ODC-By-1.0
pddl=PDDL-1.0 ofl-1.1=OFL-1.1 psf-2=PSF-2.0 python-2=Python-2.0 ruby=Ruby php-3=PHP-3.0 php-3=PHP-3.01 postgresql=PostgreSQL
openssl=OpenSSL eupl-1.1=EUPL-1.1 eupl-1.2=EUPL-1.2 ms-pl=MS-PL ms-rl=MS-RL afl-3=AFL-3.0 osl-3=OSL-3.0 qpl-1=QPL-1.0 ncsa=NCSA
upl-1=UPL-1.0 cecill-2=CECILL-2.0 cecill-2=CECILL-2.1 sspl-1=SSPL-1.0 busl-1.1=BUSL-1.1 elastic-2=Elastic-2.0 beerware=Beerware
json=JSON curl=curl vim=Vim tcl=TCL w3c=W3C blueoak-1=BlueOak-1.0.0 mulan-2=MulanPSL-2.0
"""


class Rule(NamedTuple):
    label: str
    kind: str
    keyword: str
    pattern: str


def _written() -> list[Rule]:
    label, rules = "", []
    for line in SIGNATURES.strip().splitlines():
        if line.startswith("["):
            label = line.strip("[]")
            continue
        head, pattern = line.split(": ", 1)
        kind, keyword = head.split(" ")
        rules.append(Rule(label, kind, keyword, pattern))
    return rules


def _tags() -> list[Rule]:
    rules = []
    for label, name in (x.split("=") for x in IDENTIFIERS.split()):
        words = " ".join(re.findall("[a-z0-9]+", name.lower()))
        rules.append(Rule(label, "tag", "spdx", f"spdx licen[sc]e identifier {words}(?: only| or later)?"))
    return rules


def all_rules() -> list[Rule]:
    """Base phrases first, then tags, then the written signatures."""
    base = [Rule(label, "base", phrase.split(" ")[-1 if label != "apache-2" else 0], phrase) for label, phrase in BASE]
    return base + _tags() + _written()
