"""Signature rules of licences: hand-written patterns over lower-cased words joined by one blank.

A section [keyword] or [keyword|keyword] holds the rules that are tried only in texts with one of
its keywords; every match of its rules must contain one. A section may be opened again, so that the
order of the rules does not depend on their keywords. A rule is `class label pattern`. Classes,
from the most to the least telling: text (wording of the licence itself), notice (grant or header),
tag (identifier), name, mention. Patterns match whole words.
"""

from __future__ import annotations

RULES = r"""
[mit|expat]
notice mit (?:released|licensed|distributed|available|provided|published|covered|under) (?:\w+ ){0,3}(?:the )?(?:mit|expat|mit expat) licen[sc]e
[mit]
notice mit under the (?:terms|conditions|provisions) of the mit licen[sc]e
name mit (?:the )?mit (?:open source |software |x11 |style )?licen[sc]e
tag mit (?:spdx )?licen[sc]e identifier mit
tag mit licen[sc]e mit
tag mit-0 licen[sc]e identifier mit 0
name mit-0 mit (?:no attribution|0)(?: licen[sc]e)?
mention mit mit licensed
name mit-modern modern mit(?: variant| style)? licen[sc]e
name mit-advertising mit (?:with|plus) advertising clause
name mit-feh mit feh licen[sc]e
[permission is hereby granted]
text mit permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
text isc-like permission is hereby granted (?:without|free of) (?:written agreement|fee|charge) (?:and without licen[sc]e or royalty fees )?to use copy modify
text boost-1 permission is hereby granted free of charge to any person or organization obtaining a copy of the software
text openfont permission is hereby granted free of charge to any person obtaining a copy of the font software
[software is provided as is]
text warranty-disclaimer the software is provided as is without warranty of any kind(?: express or implied)?
text isc the software is provided as is and the author disclaims all warranties
[as is and any express]
text bsd-disclaimer this software is provided (?:by the (?:copyright holders|author|authors|regents)(?: and contributors)? )?as is and any express(?:ed)? or implied warranties
[software is provided as is]
text zlib this software is provided as is without any express or implied warranty
[apache]
notice apache-2 (?:released|licensed|distributed|available|provided|published|covered|under) (?:\w+ ){0,3}(?:the )?apache (?:software )?licen[sc]e(?: version| v)? ?2(?: 0)?
name apache-2 apache (?:software |public )?licen[sc]e (?:version |v ?)?2(?: 0)?
tag apache-2 licen[sc]e identifier apache 2 0
tag apache-2 apache 2(?: 0)?(?: licen[sc]e)?
tag apache-2 asl ?2(?: 0)? apache
[except in compliance with the licen]
text apache-2 you may not use this file except in compliance with the licen[sc]e
[apache]
text apache-2 apache org licenses licen[sc]e 2 0
tag apache-2-llvm apache 2 0 with llvm exception
name apache-1 apache (?:software )?licen[sc]e (?:version |v ?)?1(?: [01])
tag apache-1 licen[sc]e identifier apache 1 [01]
mention apache apache licen[sc]e
mention apache apache licensed
text apache-1 this product includes software developed by the apache (?:software foundation|group)
[gpl]
tag gpl-3-plus licen[sc]e identifier gpl 3 0 (?:or later|plus)
tag gpl-3 licen[sc]e identifier gpl 3 0(?: only)?
tag gpl-2-plus licen[sc]e identifier gpl 2 0 (?:or later|plus)
tag gpl-2 licen[sc]e identifier gpl 2 0(?: only)?
tag gpl-1 licen[sc]e identifier gpl 1 0(?: only| or later)?
tag gpl-3 (?:gnu )?gpl ?(?:version |v ?)?3(?: 0)?
tag gpl-2 (?:gnu )?gpl ?(?:version |v ?)?2(?: 0)?
tag gpl-3-plus (?:gnu )?gpl ?(?:version |v ?)?3(?: 0)? or (?:any )?later
tag gpl-2-plus (?:gnu )?gpl ?(?:version |v ?)?2(?: 0)? or (?:any )?later
tag gpl-2-classpath gpl ?v?2 (?:with|w) (?:the )?classpath exception
mention gpl (?:under|of) the (?:gnu )?gpl
mention gpl (?:gnu )?gpl (?:licen[sc]e|licensed)
[lgpl]
tag lgpl-3 (?:gnu )?lgpl ?(?:version |v ?)?3(?: 0)?(?: only)?
tag lgpl-3-plus (?:gnu )?lgpl ?(?:version |v ?)?3(?: 0)? or (?:any )?later
tag lgpl-2-1 (?:gnu )?lgpl ?(?:version |v ?)?2 1(?: only)?
tag lgpl-2-1-plus (?:gnu )?lgpl ?(?:version |v ?)?2 1 or (?:any )?later
tag lgpl-2 (?:gnu )?lgpl ?(?:version |v ?)?2(?: 0)?
mention lgpl (?:under|of) the (?:gnu )?lgpl
[agpl]
tag agpl-3 (?:gnu )?agpl ?(?:version |v ?)?3(?: 0)?(?: only)?
tag agpl-3-plus (?:gnu )?agpl ?(?:version |v ?)?3(?: 0)? or (?:any )?later
mention agpl (?:under|of) the (?:gnu )?agpl
[general public licen]
notice gpl-3-plus gnu general public licen[sc]e as published by the free software foundation either version 3
notice gpl-2-plus gnu general public licen[sc]e as published by the free software foundation either version 2
notice gpl-2 gnu general public licen[sc]e as published by the free software foundation version 2
notice gpl-3 gnu general public licen[sc]e as published by the free software foundation version 3
name gpl-3 gnu general public licen[sc]e (?:version |v ?)3
name gpl-2 gnu general public licen[sc]e (?:version |v ?)2
name gpl-1 gnu general public licen[sc]e (?:version |v ?)1
name gpl gnu general public licen[sc]e
text gpl-3 the gnu general public licen[sc]e is a free copyleft licen[sc]e for software and other kinds of works
text gpl-2 the gnu general public licen[sc]e is intended to guarantee your freedom to share and change free software
notice lgpl-3-plus gnu lesser general public licen[sc]e as published by the free software foundation either version 3
notice lgpl-2-1-plus gnu lesser general public licen[sc]e as published by the free software foundation either version 2 1
notice lgpl-2-plus gnu library general public licen[sc]e as published by the free software foundation either version 2
name lgpl-3 gnu lesser general public licen[sc]e (?:version |v ?)3
name lgpl-2-1 gnu lesser general public licen[sc]e (?:version |v ?)2 1
name lgpl-2 gnu library general public licen[sc]e(?: (?:version |v ?)2)?
name lgpl gnu lesser general public licen[sc]e
notice agpl-3-plus gnu affero general public licen[sc]e as published by the free software foundation either version 3
name agpl-3 gnu affero general public licen[sc]e (?:version |v ?)3
name agpl gnu affero general public licen[sc]e
name affero-1 affero general public licen[sc]e (?:version |v ?)1
[free documentation]
name gfdl-1-3 gnu free documentation licen[sc]e (?:version |v ?)1 3
name gfdl-1-2 gnu free documentation licen[sc]e (?:version |v ?)1 2
name gfdl-1-1 gnu free documentation licen[sc]e (?:version |v ?)1 1
name gfdl gnu free documentation licen[sc]e
notice gfdl permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e
[gfdl]
tag gfdl (?:gnu )?gfdl(?: 1 [123])?
[bsd]
name bsd-3 (?:new|revised|modified) bsd licen[sc]e
[clause]
name bsd-3 (?:bsd )?(?:3|three) clause (?:bsd )?licen[sc]e
[bsd]
tag bsd-3 bsd 3 clause
tag bsd-3 licen[sc]e identifier bsd 3 clause
[simplified|freebsd]
name bsd-2 (?:simplified|freebsd) (?:bsd )?licen[sc]e
[bsd]
name bsd-2 (?:2|two) clause bsd licen[sc]e
tag bsd-2 bsd 2 clause
tag bsd-2-patent bsd 2 clause patent
name bsd-4 (?:original|old) bsd licen[sc]e
tag bsd-4 bsd 4 clause
tag bsd-0 (?:0bsd|bsd 0 clause|zero clause bsd)(?: licen[sc]e)?
tag bsd-1 bsd 1 clause
notice bsd (?:licensed|released|distributed|available) under (?:the |a )?bsd(?: style| like)? licen[sc]e
mention bsd bsd(?: style| like| type)? licen[sc]e
mention bsd bsd licensed
[redistribution]
text bsd redistribution and use in source and binary forms with or without modification are permitted
text bsd-clause-1 redistributions of source code must retain the above copyright notice
text bsd-clause-2 redistributions in binary form must reproduce the above copyright notice
[endorse or promote]
text bsd-3 neither the names? of (?:\S+ ){1,12}may be used to endorse or promote products derived from this software
[advertising materials]
text bsd-4 all advertising materials mentioning features or use of this software must display
[isc]
name isc isc licen[sc]e
tag isc licen[sc]e identifier isc
notice isc under (?:the terms of )?the isc licen[sc]e
[consortium licen]
name isc internet (?:systems|software) consortium licen[sc]e
[permission to use copy modify]
text isc permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
text hpnd permission to use copy modify and distribute this software and its documentation for any purpose
[mozilla]
name mpl-2 mozilla public licen[sc]e (?:version |v ?)?2(?: 0)?
name mpl-1-1 mozilla public licen[sc]e (?:version |v ?)?1 1
name mpl-1 mozilla public licen[sc]e (?:version |v ?)?1(?: 0)?
text mpl-2 this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
mention mpl mozilla public licen[sc]e
[mpl]
tag mpl-2 mpl ?(?:version |v ?)?2(?: 0)?
tag mpl-1-1 mpl ?(?:version |v ?)?1 1
tag mpl-2-no-copyleft mpl 2 0 no copyleft exception
mention mpl (?:under|of) the mpl
[eclipse]
name epl-2 eclipse public licen[sc]e (?:version |v ?)?2(?: 0)?
name epl-1 eclipse public licen[sc]e (?:version |v ?)?1(?: 0)?
name edl-1 eclipse distribution licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
mention epl eclipse public licen[sc]e
[epl]
tag epl-2 epl ?(?:version |v ?)?2(?: 0)?
tag epl-1 epl ?(?:version |v ?)?1(?: 0)?
[cddl]
tag cddl-1 cddl(?: (?:version |v ?)?1 0)?
tag cddl-1-1 cddl (?:version |v ?)?1 1
[common development]
name cddl-1 common development and distribution licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
[common public]
name cpl-1 common public licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
[european union public]
name eupl-1-2 european union public licen[sc]e (?:version |v ?)?1 2
name eupl-1-1 european union public licen[sc]e (?:version |v ?)?1 1
name eupl european union public licen[sc]e
[eupl]
tag eupl-1-2 eupl ?(?:version |v ?)?1 2
tag eupl-1-1 eupl ?(?:version |v ?)?1 1
[creative commons]
name cc-by creative commons attribution(?: [1234](?: [05])?)?(?: international| unported| generic)?(?: public)? licen[sc]e
name cc-by-sa creative commons attribution share ?alike
name cc-by-nc creative commons attribution non ?commercial
name cc-by-nd creative commons attribution no ?deriv(?:ative)?s?
name cc-by-nc-sa creative commons attribution non ?commercial share ?alike
name cc-by-nc-nd creative commons attribution non ?commercial no ?deriv(?:ative)?s?
name cc0 creative commons (?:zero|cc0|public domain dedication)
mention cc (?:under|with) a creative commons licen[sc]e
mention cc creative commons(?: licen[sc]e| licensed)
[creativecommons]
tag cc-by creativecommons org licenses by [1234] [05]
tag cc-by-sa creativecommons org licenses by sa [1234] [05]
tag cc-by-nc creativecommons org licenses by nc [1234] [05]
tag cc-by-nd creativecommons org licenses by nd [1234] [05]
tag cc-by-nc-sa creativecommons org licenses by nc sa [1234] [05]
tag cc-by-nc-nd creativecommons org licenses by nc nd [1234] [05]
tag cc0 creativecommons org publicdomain zero 1 0
tag cc-pdm creativecommons org publicdomain mark 1 0
[cc by]
tag cc-by cc by(?: [1234](?: [05])?)?
tag cc-by-sa cc by sa(?: [1234](?: [05])?)?
tag cc-by-nc cc by nc(?: [1234](?: [05])?)?
tag cc-by-nd cc by nd(?: [1234](?: [05])?)?
tag cc-by-nc-sa cc by nc sa(?: [1234](?: [05])?)?
tag cc-by-nc-nd cc by nc nd(?: [1234](?: [05])?)?
[cc0]
tag cc0 cc0(?: 1 0)?(?: universal)?
[public domain]
notice public-domain (?:released|placed|dedicated|is|are) (?:in|into|to) the public domain
text unlicense this is free and unencumbered software released into the public domain
text cc0 waives? all (?:\w+ )?(?:copyright and related )?rights (?:\w+ ){0,6}public domain
mention public-domain public domain
[unlicense]
name unlicense (?:the )?unlicense
tag unlicense unlicense org
[wtfpl]
tag wtfpl wtfpl(?: (?:version |v ?)?2)?
[what the fuck]
name wtfpl do what the fuck you want to public licen[sc]e
[boost]
name boost-1 boost software licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
[identifier bsl]
tag boost-1 licen[sc]e identifier bsl 1 0
[business source]
name busl-1-1 business source licen[sc]e(?: (?:version |v ?)?1 1)?
[busl]
tag busl-1-1 busl 1 1
[server side public]
name sspl-1 server side public licen[sc]e(?: (?:version |v ?)?1)?
[sspl]
tag sspl-1 sspl ?(?:v ?1|1 0)?
[elastic]
name elastic-2 elastic licen[sc]e (?:version |v ?)?2(?: 0)?
mention elastic elastic licen[sc]e
[polyform]
name polyform-nc polyform noncommercial licen[sc]e(?: 1 0 0)?
name polyform-small polyform small business licen[sc]e(?: 1 0 0)?
[commons clause]
name commons-clause commons clause(?: licen[sc]e)? condition
mention commons-clause (?:with|and) (?:the )?commons clause
[zlib]
name zlib (?:the )?zlib(?: libpng)? licen[sc]e
tag zlib licen[sc]e identifier zlib
[libpng]
name libpng (?:the )?libpng licen[sc]e(?: (?:version |v ?)?2)?
[artistic]
name artistic-2 artistic licen[sc]e (?:version |v ?)?2(?: 0)?
name artistic-1 artistic licen[sc]e (?:version |v ?)?1(?: 0)?
mention artistic artistic licen[sc]e
notice perl same terms as perl itself artistic
[perl itself]
notice perl (?:under|on) the same terms as perl itself
[python software foundation]
name psf-2 python software foundation licen[sc]e(?: (?:version |v ?)?2)?
[psf]
tag psf-2 psf (?:licen[sc]e )?(?:version |v ?)?2(?: 0)?
[php licen]
name php-3 php licen[sc]e(?: (?:version |v ?)?3(?: 01?)?)?
[ruby licen]
name ruby ruby licen[sc]e
notice ruby same (?:terms|licen[sc]e) as ruby licen[sc]e
[postgresql licen]
name postgresql postgresql licen[sc]e
[openssl licen]
name openssl openssl licen[sc]e
[vim licen]
name vim vim licen[sc]e
[w3c]
name w3c w3c software (?:notice and )?(?:and document )?licen[sc]e
notice w3c (?:w3c )?software and document notice w3c
[unicode]
name unicode unicode (?:licen[sc]e(?: v ?3)?|terms of use|data files and software)
[open font]
name ofl-1-1 (?:sil )?open font licen[sc]e(?: (?:version |v ?)?1 1)?
[ofl]
tag ofl-1-1 (?:sil )?ofl ?(?:version |v ?)?1 1
[open database]
name odbl-1 open database licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
[odbl]
tag odbl-1 odbl(?: 1 0)?
[open data commons]
name odc-by open data commons attribution licen[sc]e
name pddl open data commons public domain dedication
[open government]
name ogl-3 open government licen[sc]e (?:version |v ?)?3(?: 0)?
name ogl open government licen[sc]e
[open software licen]
name osl-3 open software licen[sc]e(?: (?:version |v ?)?3(?: 0)?)?
[academic free]
name afl-3 academic free licen[sc]e(?: (?:version |v ?)?3(?: 0)?)?
[microsoft public]
name ms-pl microsoft public licen[sc]e
[microsoft reciprocal]
name ms-rl microsoft reciprocal licen[sc]e
[universal permissive]
name upl-1 universal permissive licen[sc]e(?: (?:version |v ?)?1(?: 0)?)?
[university of illinois]
name ncsa university of illinois (?:ncsa )?open source licen[sc]e
[blue oak]
name blueoak-1 blue oak model licen[sc]e(?: 1 0 0)?
[beerware]
name beerware (?:the )?beerware licen[sc]e
[mulan]
name mulan-2 mulan (?:psl|permissive software licen[sc]e)(?: (?:version |v ?)?2)?
[cecill]
name cecill-b cecill b(?: licen[sc]e)?
name cecill-c cecill c(?: licen[sc]e)?
name cecill cecill(?: (?:version |v ?)?2(?: [01])?)?(?: licen[sc]e)?
[q public licen|quasar]
name qpl q(?:uasar)? public licen[sc]e
[sleepycat]
name sleepycat sleepycat licen[sc]e
[json licen]
name json json licen[sc]e
[good not evil]
text json the software shall be used for good not evil
[openrail|open rail]
name openrail-m (?:creativeml |bigscience )?(?:open ?rail)(?: \+\+)?(?: m)?(?: licen[sc]e)?
[llama]
name llama-community llama(?: [23](?: [123])?)? community licen[sc]e(?: agreement)?
[proprietary]
notice proprietary (?:confidential and proprietary|proprietary and confidential)
notice proprietary proprietary licen[sc]e
[all rights reserved]
notice all-rights-reserved all rights reserved
[is strictly prohibited]
notice proprietary unauthori[sz]ed (?:copying|use|distribution|reproduction)(?: or \w+)?(?: of (?:\w+ ){1,3})? ?is strictly prohibited
[licensed under]
mention unknown licensed under (?:the )?(?:terms|conditions) of
mention unknown (?:is )?licensed under
[see licen|see the licen]
mention unknown see (?:the )?licen[sc]e(?: file| txt| md)?(?: for (?:details|more))?
[licen]
mention unknown licen[sc]e (?:agreement|terms|file)
mention unknown (?:open source|free software|dual|end user) licen[sc]ed?
mention unknown licen[sc]e identifier \w+
mention unknown subject to (?:the )?(?:following )?licen[sc]e
[copyright]
mention copyright copyright (?:c )?(?:19|20)\d\d
mention copyright copyright notice
[copyleft]
mention copyleft copyleft(?: licen[sc]e)?
[todos los derechos]
notice all-rights-reserved todos los derechos reservados
[alle rechte]
notice all-rights-reserved alle rechte vorbehalten
[tous droits]
notice all-rights-reserved tous droits réservés
[mit lizenz]
notice mit unter (?:der )?mit lizenz
[unter der]
notice gpl unter der (?:gnu )?(?:gpl|general public licen[sc]e)
[sous licence]
notice mit sous licence mit
notice gpl sous licence (?:gnu )?gpl
notice apache-2 sous licence apache(?: 2(?: 0)?)?
[licencia]
notice mit (?:bajo )?(?:la )?licencia mit
notice gpl (?:bajo )?(?:la )?licencia (?:publica general de gnu|gnu gpl|gpl)
notice apache-2 (?:bajo )?(?:la )?licencia apache(?: 2(?: 0)?)?
"""
