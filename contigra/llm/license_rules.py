"""Rules for license text: ``label | level | keywords | pattern``, one a line.

Patterns are written for words: lower case, without punctuation, one space apart, so ``https://spdx.org/licenses/MIT.html``
reads ``https spdx org licenses mit html`` and ``v2.0`` reads ``v2 0``.  A pattern matches whole words only, and is tried where all
its keywords are among the words of a text.  Level 4: an identifier, an address or a name with its version; 3: a name;
2: a sentence of the license; 1: a general remark, which names no license.
"""

TEXT = r"""
mit | 4 | mit license identifier | spdx license identifier mit
mit | 4 | mit opensource | opensource org licenses? mit(?: license)?(?: php| html)?
mit | 4 | mit spdx | spdx org licenses mit(?: html)?
mit | 3 | mit license | (?:the )?mit license
mit | 3 | mit licensed | (?:dual )?mit licensed
mit | 3 | mit | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?mit
mit | 3 | expat license | expat license
mit | 2 | permission hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 2 | merge sublicense | use copy modify merge publish distribute sublicense and or sell copies
mit-0 | 4 | mit 0 identifier | spdx license identifier mit 0
mit-0 | 3 | mit attribution | mit no attribution(?: license)?
x11 | 4 | x11 identifier | spdx license identifier x11
x11 | 3 | x11 license | x11 license
x11 | 2 | consortium shall | the name of the x consortium shall not be used
apache-2.0 | 4 | apache identifier | spdx license identifier apache 2 0
apache-2.0 | 4 | apache license | apache(?: software)? license(?: version| v)?(?: |(?<=v))2(?: 0)?
apache-2.0 | 4 | apache licenses | apache org licenses license 2 0(?: txt| html)?
apache-2.0 | 4 | asl | asl 2 0
apache-2.0 | 3 | apache | apache 2 0(?: license| licensed)?
apache-2.0 | 2 | contributor perpetual irrevocable | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
apache-2.0 | 2 | compliance file license | you may not use this file except in compliance with the license
apache-1.1 | 4 | apache license | apache(?: software)? license(?: version| v)?(?: |(?<=v))1 1
apache-1.1 | 4 | apache identifier | spdx license identifier apache 1 1
apache-1.0 | 4 | apache license | apache(?: software)? license(?: version| v)?(?: |(?<=v))1 0
apache-1.0 | 2 | apache group | this product includes software developed by the apache group
apache | 3 | apache license | (?:the )?apache(?: software)? license
gpl-1.0 | 4 | gpl identifier | spdx license identifier gpl 1 0(?: only| or later)?
gpl-2.0 | 4 | gpl identifier | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0 | 4 | gpl identifier | spdx license identifier gpl 3 0(?: only| or later)?
gpl-1.0 | 4 | gnu general public license | gnu general public license(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version| v) ?1(?: 0)?
gpl-2.0 | 4 | gnu general public license | gnu general public license(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version| v) ?2(?: 0)?
gpl-3.0 | 4 | gnu general public license | gnu general public license(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version| v) ?3(?: 0)?
gpl-2.0 | 4 | gplv2 | gplv2(?: 0)?
gpl-3.0 | 4 | gplv3 | gplv3(?: 0)?
gpl-2.0 | 4 | gpl | (?:gnu )?gpl(?: version| v)?(?: |(?<=v))2(?: 0)?
gpl-3.0 | 4 | gpl | (?:gnu )?gpl(?: version| v)?(?: |(?<=v))3(?: 0)?
gpl-3.0 | 4 | gnu org licenses gpl | gnu org licenses gpl(?: 3 0)?(?: en)?(?: html| txt)?
gpl-2.0 | 4 | gnu org old licenses | gnu org licenses old licenses gpl 2 0(?: en)?(?: html| txt)?
gpl | 3 | gnu general public license | (?:the )?gnu general public license
gpl | 3 | gpl licensed | gpl licensed
gpl | 2 | free redistribute modify | this program is free software you can redistribute it and or modify it under the terms
gpl | 2 | hope useful warranty | distributed in the hope that it will be useful but without any warranty
lgpl-2.0 | 4 | lgpl identifier | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 | 4 | lgpl identifier | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 4 | lgpl identifier | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.0 | 4 | gnu library license | gnu library general public license(?: version| v)?(?: |(?<=v))2(?: 0)?
lgpl-2.1 | 4 | gnu lesser license | gnu lesser general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)?(?: |(?<=v))2 1
lgpl-3.0 | 4 | gnu lesser license | gnu lesser general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)?(?: |(?<=v))3(?: 0)?
lgpl-2.1 | 4 | lgplv2 | lgplv2(?: 1)?
lgpl-3.0 | 4 | lgplv3 | lgplv3(?: 0)?
lgpl-2.1 | 4 | lgpl | lgpl(?: version| v)?(?: |(?<=v))2 1
lgpl-3.0 | 4 | lgpl | lgpl(?: version| v)?(?: |(?<=v))3(?: 0)?
lgpl | 4 | gnu org licenses lgpl | gnu org licenses lgpl(?: 2 1| 3 0)?(?: en)?(?: html| txt)?
lgpl | 3 | gnu lesser license | (?:the )?gnu lesser general public license
lgpl | 3 | gnu library license | (?:the )?gnu library general public license
agpl-3.0 | 4 | agpl identifier | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 4 | gnu affero license | gnu affero general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)?(?: |(?<=v))3(?: 0)?
agpl-3.0 | 4 | agplv3 | agplv3
agpl-3.0 | 4 | agpl | agpl(?: version| v)?(?: |(?<=v))3(?: 0)?
agpl-3.0 | 4 | gnu org licenses agpl | gnu org licenses agpl(?: 3 0)?(?: en)?(?: html| txt)?
agpl | 3 | affero license | (?:the )?(?:gnu )?affero general public license
gfdl-1.3 | 4 | gfdl identifier | spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.2 | 4 | gfdl identifier | spdx license identifier gfdl 1 2(?: only| or later)?
gfdl-1.3 | 4 | gnu free documentation license | gnu free documentation license version 1 3
gfdl-1.2 | 4 | gnu free documentation license | gnu free documentation license version 1 2
gfdl | 4 | gnu org fdl | gnu org (?:copyleft|licenses) fdl(?: 1 \d)?(?: html| txt)?
gfdl | 3 | gnu free documentation license | (?:the )?gnu free documentation license
gfdl | 2 | invariant sections cover | with no invariant sections no front cover texts and no back cover texts
bsd-2-clause | 4 | bsd identifier clause | spdx license identifier bsd 2 clause
bsd-3-clause | 4 | bsd identifier clause | spdx license identifier bsd 3 clause
bsd-4-clause | 4 | bsd identifier clause | spdx license identifier bsd 4 clause
0bsd | 4 | 0bsd | (?:spdx license identifier )?0bsd
bsd-2-clause | 4 | bsd opensource | opensource org licenses? bsd 2 clause
bsd-3-clause | 4 | bsd opensource | opensource org licenses? bsd 3 clause
bsd-2-clause | 4 | bsd clause | (?:bsd 2 clause|2 clause bsd|two clause bsd)(?: license)?
bsd-3-clause | 4 | bsd clause | (?:bsd 3 clause|3 clause bsd|three clause bsd)(?: license)?
bsd-4-clause | 4 | bsd clause | (?:bsd 4 clause|4 clause bsd|four clause bsd)(?: license)?
bsd-2-clause | 3 | bsd simplified | simplified bsd license
bsd-2-clause | 3 | freebsd license | freebsd license
bsd-3-clause | 3 | bsd revised | revised bsd license
bsd-3-clause | 3 | bsd new license | new bsd license
bsd-3-clause | 3 | bsd modified | modified bsd license
bsd-4-clause | 3 | bsd original license | original bsd license
bsd | 3 | bsd license | (?:the )?bsd(?: style)? license
bsd | 3 | bsd licensed | bsd licensed
bsd | 2 | redistribution binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 2 | endorse promote derived | neither the name of .{1,120}? may be used to endorse or promote products derived from this software
bsd-4-clause | 2 | advertising materials acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
isc | 4 | isc identifier | spdx license identifier isc
isc | 4 | isc opensource | opensource org licenses? isc(?: license)?
isc | 3 | isc license | (?:the )?isc license
isc | 2 | permission fee purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
mpl-1.0 | 4 | mpl identifier | spdx license identifier mpl 1 0
mpl-1.1 | 4 | mpl identifier | spdx license identifier mpl 1 1
mpl-2.0 | 4 | mpl identifier | spdx license identifier mpl 2 0
mpl-1.1 | 4 | mozilla public license | mozilla public license(?: mpl)?(?: version| v)?(?: |(?<=v))1 1
mpl-2.0 | 4 | mozilla public license | mozilla public license(?: mpl)?(?: version| v)?(?: |(?<=v))2 0
mpl-2.0 | 4 | mozilla mpl | mozilla org(?: en us)? mpl 2 0
mpl-1.1 | 4 | mozilla mpl | mozilla org mpl mpl 1 1(?: html| txt)?
mpl-2.0 | 4 | mpl | mpl (?:v2|2) 0
mpl | 3 | mozilla public license | (?:the )?mozilla public license
mpl | 2 | source form subject mozilla | this source code form is subject to the terms of the mozilla public license
epl-1.0 | 4 | epl identifier | spdx license identifier epl 1 0
epl-2.0 | 4 | epl identifier | spdx license identifier epl 2 0
epl-1.0 | 4 | eclipse public license | eclipse public license(?: version| v)?(?: |(?<=v))1 0
epl-2.0 | 4 | eclipse public license | eclipse public license(?: version| v)?(?: |(?<=v))2 0
epl-1.0 | 4 | eclipse epl v10 | eclipse org legal epl v10(?: html)?
epl-2.0 | 4 | eclipse epl | eclipse org legal epl (?:2 0|v20)(?: html)?
epl | 3 | eclipse public license | (?:the )?eclipse public license
edl-1.0 | 3 | eclipse distribution license | eclipse distribution license(?: v| version)?(?: 1 0)?
cddl-1.0 | 4 | cddl identifier | spdx license identifier cddl 1 0
cddl-1.1 | 4 | cddl identifier | spdx license identifier cddl 1 1
cddl-1.0 | 4 | common development distribution license | common development and distribution license(?: cddl)?(?: version| v)?(?: |(?<=v))1 0
cddl-1.1 | 4 | common development distribution license | common development and distribution license(?: cddl)?(?: version| v)?(?: |(?<=v))1 1
cddl | 3 | common development distribution license | common development and distribution license
cpl-1.0 | 4 | common public license | common public license(?: version| v)?(?: |(?<=v))1 0
cpl | 3 | common public license | common public license
ipl-1.0 | 3 | ibm public license | ibm public license(?: version| v)?(?: 1 0)?
eupl-1.1 | 4 | eupl | eupl(?: version| v)?(?: |(?<=v))1 1
eupl-1.2 | 4 | eupl | eupl(?: version| v)?(?: |(?<=v))1 2
eupl-1.1 | 4 | european union public | european union public licen[cs]e(?: eupl)?(?: version| v)?(?: |(?<=v))1 1
eupl-1.2 | 4 | european union public | european union public licen[cs]e(?: eupl)?(?: version| v)?(?: |(?<=v))1 2
eupl | 3 | european union public | european union public licen[cs]e
artistic-1.0 | 4 | artistic license | artistic license(?: version| v)?(?: |(?<=v))1 0
artistic-2.0 | 4 | artistic license | artistic license(?: version| v)?(?: |(?<=v))2 0
artistic-2.0 | 4 | artistic identifier | spdx license identifier artistic 2 0
artistic | 3 | artistic license | (?:the )?artistic license
bsl-1.0 | 4 | bsl identifier | spdx license identifier bsl 1 0
bsl-1.0 | 4 | boost software license | boost software license(?: version| v)?(?: |(?<=v))1 0
bsl-1.0 | 4 | boost license | boost org license 1 0 txt
bsl-1.0 | 3 | boost software license | boost software license
busl-1.1 | 4 | busl | (?:spdx license identifier )?busl 1 1
busl-1.1 | 4 | business source license | business source license(?: version| v)?(?: |(?<=v))1 1
busl | 3 | business source license | business source license
sspl-1.0 | 4 | sspl | (?:spdx license identifier )?sspl 1 0
sspl-1.0 | 3 | server side public license | server side public license
elastic-2.0 | 4 | elastic license | elastic license(?: version| v)?(?: |(?<=v))2(?: 0)?
elastic | 3 | elastic license | (?:the )?elastic license
commons-clause | 3 | commons clause | commons clause(?: license)?(?: condition)?
polyform | 3 | polyform | polyform (?:noncommercial|small business|strict|shield|perimeter|free trial|internal use)(?: license)?(?: 1 0 0)?
zlib | 4 | zlib identifier | spdx license identifier zlib
zlib | 3 | zlib license | (?:the )?zlib(?: libpng)? license
zlib | 2 | misrepresented origin software | the origin of this software must not be misrepresented
libpng | 4 | libpng identifier | spdx license identifier libpng(?: 2 0)?
libpng | 3 | libpng license | libpng license(?: version 2)?
libpng | 3 | png reference library license | png reference library license(?: version 2)?
unlicense | 4 | unlicense identifier | spdx license identifier unlicense
unlicense | 4 | unlicense org | unlicense org(?: uncopyright)?
unlicense | 3 | unlicense | the unlicense
unlicense | 2 | free unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 4 | wtfpl | (?:spdx license identifier )?wtfpl
wtfpl | 3 | want public license | do what the f\w* you want to public license
cc0-1.0 | 4 | cc0 identifier | spdx license identifier cc0 1 0
cc0-1.0 | 4 | creativecommons publicdomain zero | creativecommons org publicdomain zero 1 0
cc0-1.0 | 4 | cc0 | cc0 1 0(?: universal)?
cc0-1.0 | 3 | cc0 | (?:creative commons )?cc0(?: license| waiver| public domain dedication)?
cc0-1.0 | 3 | creative commons zero | creative commons zero
pddl-1.0 | 3 | domain dedication public | public domain dedication and licen[cs]e
cc-by-1.0 | 4 | cc by 1 | cc by 1 0
cc-by-2.0 | 4 | cc by 2 | cc by 2 0
cc-by-2.5 | 4 | cc by 2 5 | cc by 2 5
cc-by-3.0 | 4 | cc by 3 | cc by 3 0
cc-by-4.0 | 4 | cc by 4 | cc by 4 0
cc-by-sa-2.0 | 4 | cc by sa 2 | cc by sa 2 0
cc-by-sa-2.5 | 4 | cc by sa 2 5 | cc by sa 2 5
cc-by-sa-3.0 | 4 | cc by sa 3 | cc by sa 3 0
cc-by-sa-4.0 | 4 | cc by sa 4 | cc by sa 4 0
cc-by-nc-2.0 | 4 | cc by nc 2 | cc by nc 2 0
cc-by-nc-3.0 | 4 | cc by nc 3 | cc by nc 3 0
cc-by-nc-4.0 | 4 | cc by nc 4 | cc by nc 4 0
cc-by-nd-3.0 | 4 | cc by nd 3 | cc by nd 3 0
cc-by-nd-4.0 | 4 | cc by nd 4 | cc by nd 4 0
cc-by-nc-sa-3.0 | 4 | cc by nc sa 3 | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 4 | cc by nc sa 4 | cc by nc sa 4 0
cc-by-nc-nd-3.0 | 4 | cc by nc nd 3 | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 4 | cc by nc nd 4 | cc by nc nd 4 0
cc-by-sa | 3 | cc by sa | cc by sa
cc-by-nc | 3 | cc by nc | cc by nc
cc-by-nd | 3 | cc by nd | cc by nd
cc-by-nc-sa | 3 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 3 | cc by nc nd | cc by nc nd
cc-by | 2 | cc by | cc by
cc-by-3.0 | 4 | creativecommons licenses by | creativecommons org licenses by 3 0
cc-by-4.0 | 4 | creativecommons licenses by | creativecommons org licenses by 4 0
cc-by-sa-3.0 | 4 | creativecommons licenses by sa | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | 4 | creativecommons licenses by sa | creativecommons org licenses by sa 4 0
cc-by-nc-4.0 | 4 | creativecommons licenses by nc | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | 4 | creativecommons licenses by nd | creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0 | 4 | creativecommons licenses by nc sa | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | 4 | creativecommons licenses by nc nd | creativecommons org licenses by nc nd 4 0
cc-by | 3 | creative commons attribution | creative commons attribution(?: license)?(?: [1234] \d)?(?: international| unported| generic)?
cc-by-sa | 3 | creative commons attribution sharealike | creative commons attribution sharealike(?: license)?(?: [1234] \d)?(?: international| unported| generic)?
cc-by-sa | 3 | creative commons share alike | creative commons attribution share alike(?: license)?(?: [1234] \d)?
cc-by-nc | 3 | creative commons attribution | creative commons attribution non ?commercial(?: license)?(?: [1234] \d)?
cc-by-nc | 3 | creative commons non commercial | creative commons attribution non commercial(?: license)?(?: [1234] \d)?
cc-by-nd | 3 | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s(?: license)?(?: [1234] \d)?
cc-by-nc-sa | 3 | creative commons noncommercial sharealike | creative commons attribution noncommercial sharealike(?: license)?(?: [1234] \d)?
cc-by-nc-nd | 3 | creative commons noncommercial noderivatives | creative commons attribution noncommercial noderivatives(?: license)?(?: [1234] \d)?
creative-commons | 1 | creative commons | (?:a )?creative commons licen[cs]e
odbl-1.0 | 4 | odbl | odbl(?: 1 0| v1 0)?
odbl-1.0 | 3 | open database | open (?:data commons open )?database licen[cs]e
odc-by-1.0 | 3 | open data commons attribution | open data commons attribution licen[cs]e
ofl-1.1 | 4 | ofl identifier | spdx license identifier ofl 1 1
ofl-1.1 | 4 | sil open font license | sil open font license(?: version| v)?(?: |(?<=v))1 1
ofl-1.1 | 4 | sil ofl | scripts sil org ofl
ofl | 3 | open font license | (?:sil )?open font license
ubuntu-font-1.0 | 3 | ubuntu font | ubuntu font licen[cs]e(?: version)?(?: 1 0)?
openssl | 4 | openssl identifier | spdx license identifier openssl
openssl | 3 | openssl license | openssl license
openssl | 2 | openssl toolkit project | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | 3 | ssleay license | (?:original )?ssleay license
curl | 4 | curl identifier | spdx license identifier curl
curl | 3 | curl license | curl license
php-3.01 | 4 | php license | php license(?: version| v)?(?: |(?<=v))3 01
php-3.0 | 4 | php license | php license(?: version| v)?(?: |(?<=v))3 0
php | 3 | php license | (?:the )?php license
python-2.0 | 4 | python identifier | spdx license identifier python 2 0
psf-2.0 | 4 | psf | (?:spdx license identifier )?psf 2 0
psf-2.0 | 3 | python software foundation license | python software foundation license(?: agreement)?(?: version 2)?
ruby | 3 | ruby license | (?:the )?ruby license
perl | 3 | perl terms same | under the same terms as perl(?: itself)?
postgresql | 4 | postgresql identifier | spdx license identifier postgresql
postgresql | 3 | postgresql | (?:the )?postgresql licen[cs]e
tcl | 3 | tcl license | tcl(?: tk)? license
vim | 3 | vim license | vim license
zpl-2.1 | 4 | zope public license | zope public license(?: zpl)?(?: version| v)?(?: |(?<=v))2 1
zpl | 3 | zope public license | zope public license
w3c | 3 | w3c software license | w3c software(?: notice)?(?: and)?(?: document)? license
w3c | 3 | w3c document license | w3c document license
ncsa | 4 | ncsa identifier | spdx license identifier ncsa
ncsa | 3 | ncsa license | (?:university of illinois )?ncsa(?: open source)? license
unicode | 3 | unicode license | unicode(?: inc)? license(?: agreement)?(?: v3)?
icu | 3 | icu license | icu license(?: icu 1 8 1 and later)?
afl-3.0 | 4 | academic free license | academic free license(?: version| v)?(?: |(?<=v))3 0
afl | 3 | academic free license | academic free license
osl-3.0 | 4 | open software license | open software license(?: version| v)?(?: |(?<=v))3 0
osl | 3 | open software license | open software license
ms-pl | 4 | ms pl identifier | spdx license identifier ms pl
ms-pl | 3 | microsoft public license | microsoft public license(?: ms pl)?
ms-rl | 3 | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
apsl-2.0 | 3 | apple public source license | apple public source license(?: version)?(?: 2 0)?
qpl-1.0 | 3 | q public license | q public license(?: version)?(?: 1 0)?
sleepycat | 3 | sleepycat license | sleepycat license
json | 3 | json license | json license
json | 2 | software used good evil | the software shall be used for good not evil
beerware | 3 | beer ware license | the beer ware license(?: revision 42)?
blueoak-1.0.0 | 3 | blue oak license | blue oak model license(?: version)?(?: 1 0 0)?
upl-1.0 | 4 | upl identifier | spdx license identifier upl 1 0
upl-1.0 | 3 | universal permissive license | universal permissive license(?: version| v)?(?: 1 0)?
mulan-psl-2.0 | 4 | mulan psl | mulan psl (?:v2|2)(?: 0)?
mulan-psl | 3 | mulan permissive license | mulan permissive software license
cecill-2.1 | 4 | cecill | cecill(?: version| v)?(?: |(?<=v))2 1
cecill | 3 | cecill | (?:licence )?cecill(?: b| c)?
lppl-1.3c | 4 | lppl | lppl(?: version| v)?(?: |(?<=v))1 3c?
lppl | 3 | latex project public license | latex project public license
hpnd | 3 | historical permission notice | historical permission notice and disclaimer
ntp | 3 | ntp license | ntp license
llama-2 | 3 | llama community license | llama 2 community license(?: agreement)?
llama-3 | 3 | llama community license | (?:meta )?llama 3(?: \d)? community license(?: agreement)?
gemma | 3 | gemma terms use | gemma terms of use
openrail | 3 | openrail | (?:creativeml |bigscience )?openrail(?: m| s)?(?: license)?
openrail | 3 | open rail | (?:creativeml |bigscience )?open rail(?: m| s)?(?: license)?
bigscience-rail | 3 | bigscience rail license | bigscience rail license
ogl-uk-3.0 | 4 | open government licence | open government licence v?3 0
ogl-uk | 3 | open government licence | open government licence
etalab-2.0 | 3 | licence ouverte | licence ouverte(?: open licence)?(?: version)?(?: 2 0)?
dl-de-by-2.0 | 3 | datenlizenz deutschland namensnennung | datenlizenz deutschland namensnennung(?: version)?(?: 2 0)?
public-domain | 2 | public domain released | released (?:in|in to|into|to) the public domain
public-domain | 2 | public domain dedicated | dedicated to the public domain
public-domain | 2 | public domain work | this work is in the public domain
proprietary | 2 | rights reserved | all rights reserved
proprietary | 2 | proprietary confidential | proprietary and confidential
proprietary | 2 | unauthorized copying prohibited | unauthorized copying (?:of this file )?.{0,40}?is strictly prohibited
spdx-other | 1 | spdx identifier | spdx license identifier [a-z0-9]+
licensed | 1 | licensed | licensed under(?: the)?(?: terms of)?(?: the)? [a-z0-9]+
licensed | 1 | released under | released under (?:the|an?) [a-z0-9]+(?: [a-z0-9]+)? licen[cs]e
licensed | 1 | distributed under | distributed under the (?:terms of the )?[a-z0-9]+(?: [a-z0-9]+)? licen[cs]e
licensed | 1 | license see | see (?:the )?(?:accompanying )?(?:file )?license(?: txt| md)?(?: file)?(?: for details)?
licensed | 1 | under terms | under the terms of the [a-z0-9]+(?: [a-z0-9]+)? licen[cs]e
"""
