"""Signature rules for licences: hand-written patterns over the words of a text.

A text is seen as its lower-case words with single spaces between them, so patterns need no punctuation:
"GPL-3.0-or-later" is "gpl 3 0 or later". Each line reads

    priority  keyword  pattern

Priority 1 is an identifier or legal text, 2 a grant ("licensed under ..."), 3 a name alone. The keyword is a
word that every match contains; rules whose keyword a text lacks are not tried on it. A space in a pattern
stands for the border of two words; ``\\S+`` is any word.
"""

from __future__ import annotations

from typing import NamedTuple

WEIGHTS = {1: 1.0, 2: 0.9, 3: 0.6}


class Rule(NamedTuple):
    number: int
    label: str
    priority: int
    keyword: str
    pattern: str
    base: bool = False


# A text with none of these in it is not scanned. Every rule needs one of them, or the word cc or cc0.
GATE = (
    "licen", "apache", "beerware", "bsd", "cddl", "cecill", "clause", "commercial", "commons", "confidential",
    "copying", "copyright", "datenlizenz", "domain", "etalab", "eupl", "gfdl", "gnu", "gpl", "hereby", "implied",
    "odbl", "openrail", "openssl", "permission", "prohibited", "proprietary", "purposes", "reserved", "sspl",
    "unencumbered", "wtfpl",
)

# Phrases whose places are counted: (label, keyword, words).
BASE = (("mit", "mit", "under the mit license"), ("apache-2", "apache", "apache license version 2"), ("cc-by-nc", "cc", "cc by nc"))

GRANT = r"(?:licen[sc]ed|released|distributed|available|published|provided|covered|offered) (?:to you )?(?:under|by) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"

RULES_TEXT = r"""
[mit]
1 hereby       permission is hereby granted free of charge to any person obtaining a copy of this software
1 substantial  the above copyright notice and this permission notice shall be included in all copies or substantial portions
1 identifier   spdx license identifier mit
2 mit          GRANT mit licen[sc]e
2 mit          licen[sc]ed under (?:the )?mit
2 mit          licen[sc]e (?:is )?mit
3 mit          (?:the )?mit (?:x11 |x )?licen[sc]e
3 expat        expat licen[sc]e
3 mit          mit style licen[sc]e
[mit-0]
1 identifier   spdx license identifier mit 0
3 attribution  mit no attribution licen[sc]e
3 mit          mit 0 licen[sc]e
[x11]
1 identifier   spdx license identifier x11
3 x11          x11 licen[sc]e
3 consortium   x consortium licen[sc]e
[apache-2]
1 identifier   spdx license identifier apache 2 0
1 apache       you may not use this file except in compliance with the license(?: \S+){0,8} apache
1 obtain       you may obtain a copy of the license at http www apache org licenses license 2 0
2 apache       GRANT apache (?:software )?licen[sc]e (?:version )?v?2(?: 0)?
2 asf          GRANT asf licen[sc]e 2(?: 0)?
3 apache       apache (?:software )?licen[sc]e (?:version )?2(?: 0)?
3 apache       apache 2 0(?: licen[sc]e)?
3 apache       apache v2(?: licen[sc]e)?
3 asl          asl 2 0 licen[sc]e
[apache-1.1]
1 identifier   spdx license identifier apache 1 1
3 apache       apache (?:software )?licen[sc]e (?:version )?1 1
[apache-1.0]
1 identifier   spdx license identifier apache 1 0
3 apache       apache (?:software )?licen[sc]e (?:version )?1 0
[apache]
3 apache       apache (?:software )?licen[sc]e
[gpl-3]
1 identifier   spdx license identifier gpl 3 0(?: only| or later)?
1 gnu          gnu general public license version 3 29 june 2007
1 redistribute you can redistribute it and or modify it under the terms of the gnu general public license(?: \S+){0,14} version 3
2 gnu          GRANT gnu (?:gpl|general public licen[sc]e) (?:version |v)?3(?: 0)?
2 gpl          GRANT (?:gnu )?gpl (?:version |v)?3(?: 0)?
2 gplv3        GRANT (?:gnu )?gplv3
3 gnu          gnu general public licen[sc]e (?:version |v)?3(?: 0)?
3 gpl          gpl (?:version |v)?3(?: 0)?
3 gplv3        gplv3
[gpl-2]
1 identifier   spdx license identifier gpl 2 0(?: only| or later)?
1 gnu          gnu general public license version 2 june 1991
1 redistribute you can redistribute it and or modify it under the terms of the gnu general public license(?: \S+){0,14} version 2
2 gnu          GRANT gnu (?:gpl|general public licen[sc]e) (?:version |v)?2(?: 0)?
2 gpl          GRANT (?:gnu )?gpl (?:version |v)?2(?: 0)?
2 gplv2        GRANT (?:gnu )?gplv2
3 gnu          gnu general public licen[sc]e (?:version |v)?2(?: 0)?
3 gpl          gpl (?:version |v)?2(?: 0)?
3 gplv2        gplv2
[gpl-1]
1 identifier   spdx license identifier gpl 1 0(?: only| or later)?
3 gnu          gnu general public licen[sc]e version 1
3 gplv1        gplv1
[gpl]
2 gnu          GRANT gnu (?:gpl|general public licen[sc]e)
2 gpl          GRANT gpl
3 gnu          gnu general public licen[sc]e
3 gnu          gnu gpl
3 gpl          gpl compatible
3 gpl          gpl licen[sc]ed?
[lgpl-3]
1 identifier   spdx license identifier lgpl 3 0(?: only| or later)?
1 lesser       gnu lesser general public license version 3 29 june 2007
2 lesser       GRANT gnu lesser general public licen[sc]e (?:version |v)?3(?: 0)?
3 lesser       gnu lesser general public licen[sc]e (?:version |v)?3(?: 0)?
3 lgpl         lgpl (?:version |v)?3(?: 0)?
3 lgplv3       lgplv3
[lgpl-2.1]
1 identifier   spdx license identifier lgpl 2 1(?: only| or later)?
1 lesser       gnu lesser general public license version 2 1 february 1999
2 lesser       GRANT gnu lesser general public licen[sc]e (?:version |v)?2 1
3 lesser       gnu lesser general public licen[sc]e (?:version |v)?2 1
3 lgpl         lgpl (?:version |v)?2 1
[lgpl-2]
1 identifier   spdx license identifier lgpl 2 0(?: only| or later)?
1 library      gnu library general public license version 2 june 1991
3 library      gnu library general public licen[sc]e
3 lgpl         lgpl (?:version |v)?2(?: 0)?
3 lgplv2       lgplv2
[lgpl]
2 lesser       GRANT gnu lesser general public licen[sc]e
3 lesser       (?:gnu )?lesser general public licen[sc]e
3 lgpl         (?:gnu )?lgpl
[agpl-3]
1 identifier   spdx license identifier agpl 3 0(?: only| or later)?
1 affero       gnu affero general public license version 3 19 november 2007
2 affero       GRANT gnu affero general public licen[sc]e(?: (?:version |v)?3(?: 0)?)?
3 affero       (?:gnu )?affero general public licen[sc]e(?: (?:version |v)?3(?: 0)?)?
3 agpl         agpl(?: (?:version |v)?3(?: 0)?)?
3 agplv3       agplv3
[gfdl]
1 identifier   spdx license identifier gfdl 1 [123](?: only| or later)?
2 documentation GRANT gnu free documentation licen[sc]e
3 documentation gnu free documentation licen[sc]e
3 gfdl         gfdl
[bsd-2]
1 identifier   spdx license identifier bsd 2 clause
1 retain       redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
2 bsd          GRANT (?:simplified|freebsd|2 clause|two clause) bsd(?: licen[sc]e)?
3 bsd          bsd 2 clause
3 bsd          (?:2|two) clause bsd
3 bsd          simplified bsd licen[sc]e
3 freebsd      freebsd licen[sc]e
[bsd-3]
1 identifier   spdx license identifier bsd 3 clause
1 endorse      neither the name of (?:\S+ ){1,8}nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
2 bsd          GRANT (?:new|modified|revised|3 clause|three clause) bsd(?: licen[sc]e)?
3 bsd          bsd 3 clause
3 bsd          (?:3|three) clause bsd
3 bsd          (?:new|modified|revised) bsd licen[sc]e
[bsd-4]
1 identifier   spdx license identifier bsd 4 clause
1 advertising  all advertising materials mentioning features or use of this software(?: \S+){0,30} copyright
3 bsd          bsd 4 clause
3 bsd          (?:original|old) bsd licen[sc]e
[0bsd]
1 identifier   spdx license identifier 0bsd
3 0bsd         0bsd
3 bsd          (?:zero|0) clause bsd
[bsd]
2 bsd          GRANT bsd(?: style)?(?: licen[sc]e)?
3 bsd          bsd (?:style )?licen[sc]e
[isc]
1 identifier   spdx license identifier isc
1 purpose      permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
2 isc          GRANT isc licen[sc]e
3 isc          isc licen[sc]e
[mpl-2]
1 identifier   spdx license identifier mpl 2 0
1 mozilla      this source code form is subject to the terms of the mozilla public license v 2 0
2 mozilla      GRANT mozilla public licen[sc]e (?:version |v )?2(?: 0)?
3 mozilla      mozilla public licen[sc]e (?:version |v )?2(?: 0)?
3 mpl          mpl (?:version |v)?2(?: 0)? licen[sc]e
[mpl-1.1]
1 identifier   spdx license identifier mpl 1 1
3 mozilla      mozilla public licen[sc]e (?:version |v )?1 1
3 mpl          mpl (?:version |v)?1 1 licen[sc]e
[mpl]
2 mozilla      GRANT mozilla public licen[sc]e
3 mozilla      mozilla public licen[sc]e
[epl-2]
1 identifier   spdx license identifier epl 2 0
2 eclipse      GRANT eclipse public licen[sc]e (?:version |v )?2(?: 0)?
3 eclipse      eclipse public licen[sc]e (?:version |v )?2(?: 0)?
3 epl          epl 2(?: 0)? licen[sc]e
[epl-1]
1 identifier   spdx license identifier epl 1 0
3 eclipse      eclipse public licen[sc]e (?:version |v )?1(?: 0)?
3 epl          epl 1(?: 0)? licen[sc]e
[epl]
3 eclipse      eclipse public licen[sc]e
[edl]
3 eclipse      eclipse distribution licen[sc]e
[cddl-1]
1 identifier   spdx license identifier cddl 1 [01]
2 cddl         GRANT cddl
3 distribution common development and distribution licen[sc]e
3 cddl         cddl(?: 1 [01])?
[cpl-1]
1 identifier   spdx license identifier cpl 1 0
3 common       common public licen[sc]e(?: (?:version |v)?1(?: 0)?)?
[eupl]
1 identifier   spdx license identifier eupl 1 [012]
3 union        european union public licen[sc]e
3 eupl         eupl(?: v?1 [012])?
[osl-3]
1 identifier   spdx license identifier osl 3 0
2 open         GRANT open software licen[sc]e
3 open         open software licen[sc]e
[afl-3]
1 identifier   spdx license identifier afl 3 0
3 academic     academic free licen[sc]e
[artistic]
1 identifier   spdx license identifier artistic (?:1|2) 0
2 artistic     GRANT artistic licen[sc]e
3 artistic     (?:perl )?artistic licen[sc]e(?: 2(?: 0)?)?
3 perl         licen[sc]ed under the same terms as perl itself
[zlib]
1 identifier   spdx license identifier zlib
1 implied      this software is provided as is without any express or implied warranty in no event will the authors be held liable
2 zlib         GRANT zlib (?:libpng )?licen[sc]e
3 zlib         zlib (?:libpng )?licen[sc]e
[libpng]
1 identifier   spdx license identifier libpng(?: 2 0)?
3 libpng       libpng licen[sc]e
[boost]
1 identifier   spdx license identifier bsl 1 0
2 boost        GRANT boost software licen[sc]e
3 boost        boost software licen[sc]e(?: (?:version )?1(?: 0)?)?
3 boost        boost licen[sc]e
[unlicense]
1 unencumbered this is free and unencumbered software released into the public domain
1 identifier   spdx license identifier unlicense
3 unlicense    (?:the )?unlicense
[wtfpl]
1 identifier   spdx license identifier wtfpl
3 wtfpl        wtfpl
3 fuck         do what the fuck you want to public licen[sc]e
[beerware]
1 identifier   spdx license identifier beerware
3 beerware     beerware(?: licen[sc]e)?
3 beer         beer ware licen[sc]e
[python-2]
1 identifier   spdx license identifier (?:python|psf) 2 0
3 python       python software foundation licen[sc]e
3 psf          psf licen[sc]e
[php]
1 identifier   spdx license identifier php 3 0(?:1)?
2 php          GRANT php licen[sc]e
3 php          php licen[sc]e
[ruby]
1 identifier   spdx license identifier ruby
3 ruby         ruby licen[sc]e
[openssl]
1 identifier   spdx license identifier openssl
1 openssl      this product includes software developed by the openssl project
3 openssl      openssl licen[sc]e
[ncsa]
1 identifier   spdx license identifier ncsa
3 ncsa         (?:university of illinois )?ncsa open source licen[sc]e
[ms-pl]
1 identifier   spdx license identifier ms pl
3 microsoft    microsoft public licen[sc]e
3 pl           ms pl licen[sc]e
[ms-rl]
1 identifier   spdx license identifier ms rl
3 microsoft    microsoft reciprocal licen[sc]e
[postgresql]
1 identifier   spdx license identifier postgresql
3 postgresql   postgresql licen[sc]e
[upl]
1 identifier   spdx license identifier upl 1 0
3 universal    universal permissive licen[sc]e
[unicode]
1 identifier   spdx license identifier unicode (?:dfs 2016|3 0|tou)
3 unicode      unicode licen[sc]e agreement
[w3c]
1 identifier   spdx license identifier w3c
3 w3c          w3c (?:software )?(?:notice and )?licen[sc]e
[qpl]
1 identifier   spdx license identifier qpl 1 0
3 q            q public licen[sc]e
[blueoak]
1 identifier   spdx license identifier blueoak 1 0 0
3 oak          blue oak model licen[sc]e
[mulan]
1 identifier   spdx license identifier mulanpsl 2 0
3 mulan        mulan (?:psl|permissive software) licen[sc]e
[hpnd]
1 identifier   spdx license identifier hpnd
1 granted      permission to use copy modify and distribute this software and its documentation for any purpose(?: and without fee)? is hereby granted
[ofl]
1 identifier   spdx license identifier ofl 1 [01]
2 font         GRANT sil open font licen[sc]e
3 font         (?:sil )?open font licen[sc]e
[odbl]
1 identifier   spdx license identifier odbl 1 0
2 database     GRANT open (?:data commons )?(?:open )?database licen[sc]e
3 database     open database licen[sc]e
3 odbl         odbl
[odc-by]
1 identifier   spdx license identifier odc by 1 0
3 commons      open data commons attribution licen[sc]e
[pddl]
1 identifier   spdx license identifier pddl 1 0
3 commons      open data commons public domain dedication(?: and licen[sc]e)?
[sspl]
1 identifier   spdx license identifier sspl 1 0
3 server       server side public licen[sc]e
3 sspl         sspl
[busl]
1 identifier   spdx license identifier busl 1 1
3 business     business source licen[sc]e
[elastic]
1 identifier   spdx license identifier elastic 2 0
3 elastic      elastic licen[sc]e(?: 2(?: 0)?)?
[polyform]
1 identifier   spdx license identifier polyform \S+ 1 0 0
3 polyform     polyform (?:noncommercial|strict|shield|perimeter|internal use|small business|free trial) licen[sc]e
[commons-clause]
3 clause       commons clause licen[sc]e condition
3 clause       commons clause
[rail]
3 rail         (?:creativeml )?open rail m licen[sc]e
3 rail         bigscience (?:bloom )?rail(?: 1 0)? licen[sc]e
3 openrail     (?:creativeml |bigscience )?openrail(?: m)?
[llama]
3 llama        llama (?:2 |3 |3 1 )?community licen[sc]e(?: agreement)?
[cc0-1]
1 identifier   spdx license identifier cc0 1 0
1 waived       has waived all copyright and related or neighboring rights
2 cc0          GRANT cc0
2 dedicated    dedicated to the public domain
3 cc0          cc0(?: 1 0)?(?: universal)?
3 zero         creative commons zero
3 creativecommons creativecommons org publicdomain zero 1 0
[cc-by]
1 identifier   spdx license identifier cc by [1234] [05]
1 creativecommons creativecommons org licenses by [1234] [05]
2 cc           GRANT cc by(?: [1234] [05])?
2 commons      GRANT creative commons attribution (?:[1234] [05] )?(?:international |unported |generic )?licen[sc]e
3 cc           cc by(?: [1234] [05])?
3 commons      creative commons attribution (?:[1234] [05] )?(?:international |unported |generic )?licen[sc]e
[cc-by-sa]
1 identifier   spdx license identifier cc by sa [1234] [05]
1 creativecommons creativecommons org licenses by sa [1234] [05]
2 cc           GRANT cc by sa(?: [1234] [05])?
2 commons      GRANT creative commons attribution share(?: )?alike
3 cc           cc by sa(?: [1234] [05])?
3 commons      creative commons attribution share(?: )?alike(?: [1234] [05])?
[cc-by-nd]
1 identifier   spdx license identifier cc by nd [1234] [05]
1 creativecommons creativecommons org licenses by nd [1234] [05]
2 cc           GRANT cc by nd(?: [1234] [05])?
3 cc           cc by nd(?: [1234] [05])?
3 commons      creative commons attribution no(?: )?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
[cc-by-nc]
1 identifier   spdx license identifier cc by nc [1234] [05]
1 creativecommons creativecommons org licenses by nc [1234] [05]
2 cc           GRANT cc by nc(?: [1234] [05])?
2 commons      GRANT creative commons attribution non(?: )?commercial
3 cc           cc by nc(?: [1234] [05])?
3 commons      creative commons attribution non(?: )?commercial(?: [1234] [05])?
[cc-by-nc-sa]
1 identifier   spdx license identifier cc by nc sa [1234] [05]
1 creativecommons creativecommons org licenses by nc sa [1234] [05]
2 cc           GRANT cc by nc sa(?: [1234] [05])?
3 cc           cc by nc sa(?: [1234] [05])?
3 commons      creative commons attribution non(?: )?commercial share(?: )?alike(?: [1234] [05])?
[cc-by-nc-nd]
1 identifier   spdx license identifier cc by nc nd [1234] [05]
1 creativecommons creativecommons org licenses by nc nd [1234] [05]
2 cc           GRANT cc by nc nd(?: [1234] [05])?
3 cc           cc by nc nd(?: [1234] [05])?
3 commons      creative commons attribution non(?: )?commercial no(?: )?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
[cc]
2 commons      GRANT (?:a )?creative commons(?: licen[sc]e)?
3 commons      creative commons licen[sc]e
3 commons      some rights reserved creative commons
[public-domain]
2 domain       (?:released|placed) (?:in|into|to) the public domain
2 domain       this (?:work|file|software|code|text) is in the public domain
3 domain       public domain mark(?: 1 0)?
3 domain       public domain dedication
[ogl-uk]
2 government   GRANT open government licen[sc]e
3 government   open government licen[sc]e(?: v(?:ersion )?[123](?: 0)?)?
3 sector       contains public sector information licen[sc]ed
3 crown        crown copyright
[etalab]
3 etalab       (?:licence ouverte )?etalab(?: 2 0)?
3 ouverte      licence ouverte(?: (?:version )?[12] 0)?
[dl-de]
3 datenlizenz  datenlizenz deutschland(?: (?:namensnennung|zero))?(?: (?:version )?2 0)?
[free-art]
3 art          free art licen[sc]e
3 libre        licence art libre
[cecill]
1 identifier   spdx license identifier cecill (?:1 [01]|2 [01]|b|c)
2 cecill       (?:GRANT )cecill(?: [bc])?
3 cecill       (?:licence |license )?cecill(?: [bc]| 2 [01])?
[proprietary]
1 confidential this (?:document|software|file) contains confidential(?: and| or)? proprietary information
1 strictly     unauthorized (?:copying|reproduction|use|distribution)(?: \S+){0,12} strictly prohibited
2 reserved     all rights reserved
2 permission   (?:may not|must not|cannot) be (?:reproduced|copied|published|redistributed)(?: \S+){0,10} without (?:\S+ ){0,3}permission
3 proprietary  proprietary (?:and confidential|licen[sc]e)
3 eula         end user licen[sc]e agreement eula
[non-commercial]
2 commercial   for (?:personal and )?non commercial (?:use|purposes) only
2 noncommercial for (?:personal and )?noncommercial (?:use|purposes) only
2 commercial   not for commercial (?:use|purposes)
3 noncommercial noncommercial use only
[research-only]
2 research     for research purposes only
3 academic     for academic purposes only
[unknown-license]
2 licensed     this (?:work|software|file|program|project|content|text) is licensed under
2 subject      subject to the terms (?:and conditions )?of the (?:\S+ ){0,4}licen[sc]e
3 license      see (?:the )?(?:file )?license(?: \S+)? for (?:more )?(?:details|information)
3 copying      see (?:the )?(?:file )?copying for (?:more )?(?:details|information)
"""


def read_rules(text: str = RULES_TEXT) -> tuple[Rule, ...]:
    """Base phrases first, then the rules in the order of the text."""
    rules = [Rule(i, label, 3, keyword, phrase, True) for i, (label, keyword, phrase) in enumerate(BASE)]
    label = ""
    for line in filter(None, map(str.strip, text.splitlines())):
        if line.startswith("["):
            label = line.strip("[]")
        else:
            priority, keyword, pattern = line.split(None, 2)
            # A grant written before a name brings its own trailing space.
            pattern = pattern.replace("(?:GRANT )", GRANT).replace("GRANT ", GRANT)
            rules.append(Rule(len(rules), label, int(priority), keyword, pattern))
    return tuple(rules)


RULES = read_rules()
