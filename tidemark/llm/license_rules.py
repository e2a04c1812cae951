"""License names and the rules built from them, signatures of license texts and headers, and SPDX ids."""

from __future__ import annotations

# Label, and the word sequences that name the license.
FAMILIES = (
    ("gpl", ("gnu general public license", "gnu gpl", "gplv2", "gplv3")),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgplv3")),
    ("agpl", ("gnu affero general public license", "gnu agpl", "agplv3")),
    ("gfdl", ("gnu free documentation license",)),
    ("apache", ("apache license", "apache software license", "asl 2 0")),
    ("mit", ("mit license", "expat license")),
    ("bsd", ("bsd license", "bsd 2 clause license", "bsd 3 clause license", "modified bsd license")),
    ("isc", ("isc license",)),
    ("mpl", ("mozilla public license",)),
    ("epl", ("eclipse public license",)),
    ("cddl", ("common development and distribution license",)),
    ("cpl", ("common public license",)),
    ("artistic", ("artistic license",)),
    ("boost", ("boost software license",)),
    ("zlib", ("zlib license", "zlib libpng license")),
    ("unlicense", ("the unlicense",)),
    ("wtfpl", ("do what the fuck you want to public license",)),
    ("ofl", ("sil open font license",)),
    ("eupl", ("european union public licence",)),
    ("ms-pl", ("microsoft public license",)),
    ("odbl", ("open database license",)),
    ("psf", ("python software foundation license",)),
    ("php", ("php license",)),
    ("ruby", ("ruby license",)),
    ("openssl", ("openssl license",)),
    ("cc-by", ("cc by", "creative commons attribution", "creative commons attribution license")),
    ("cc-by-sa", ("cc by sa", "creative commons attribution sharealike")),
    ("cc-by-nc", ("cc by nc", "creative commons attribution noncommercial")),
    ("cc-by-nd", ("cc by nd", "creative commons attribution noderivatives")),
    ("cc-by-nc-sa", ("cc by nc sa", "creative commons attribution noncommercial sharealike")),
    ("cc-by-nc-nd", ("cc by nc nd",)),
    ("cc0", ("cc0", "creative commons zero")),
    ("public-domain", ("dedicated to the public domain", "released into the public domain")),
    ("proprietary", ("all rights reserved", "proprietary and confidential")),
)
# Forms around a name ({0}), their weight, and their priority (higher wins).
FORMS = (
    (r"spdx license identifier {0}(?: only| or later)?", 0.95, 6),
    (r"(?:licensed|released|distributed|available|published|redistributed) under (?:the )?(?:terms of (?:the )?)?{0}"
     r"(?: (?:version|v) ?[0-9]+(?: [0-9]+)?)?", 0.9, 5),
    (r"(?:is|are) (?:covered|governed) by (?:the )?{0}(?: (?:version|v) ?[0-9]+(?: [0-9]+)?)?", 0.9, 5),
    (r"{0} (?:version|v) ?[0-9]+(?: [0-9]+)?(?: or (?:any )?later)?", 0.8, 4),
    (r"(?:subject to|see|under) (?:the )?{0}", 0.7, 3),
    (r"{0}", 0.5, 2),
)
# The phrases that always count, with their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Up to so many words of a name or a notice inside a signature.
_SOME = r"(?:[^ ]+ ){0,16}?"
_TERMS = r"under (?:the )?terms of (?:the )?"
# Signatures without a name around which FORMS could be built: label, keyword, pattern (the keyword
# alone if None), weight, priority (TEXT: whole clauses and headers; URL: places of the text; SHORT: abbreviations).
TEXT, URL, SHORT = 7, 4, 3
SIGNATURES = (
    # MIT and its variants
    ("mit", "obtaining a copy of this software and associated documentation files",
     r"permission is hereby granted(?: free of charge)? to any person obtaining a copy of this software and associated documentation files", 0.9, TEXT),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", None, 0.8, TEXT),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense", None, 0.8, TEXT),
    ("mit-0", "obtaining a copy of this software and associated documentation files",
     r"obtaining a copy of this software and associated documentation files the software to deal in the software without restriction (?:[^ ]+ ){10,40}?to permit persons to whom the software is furnished to do so (?=the software is provided as is)", 0.8, TEXT),
    ("x11", "except as contained in this notice the name",
     rf"except as contained in this notice the names? of {_SOME}shall not be used in advertising or otherwise to promote the sale", 0.8, TEXT),
    ("json", "the software shall be used for good not evil", None, 0.9, TEXT),
    ("mit", "opensource org licenses mit", r"opensource org licenses mit(?: license(?: php| html)?)?", 0.8, URL),
    # BSD
    ("bsd", "redistribution and use in source and binary forms",
     r"redistribution and use in source and binary forms with or without modification (?:are|is) permitted", 0.85, TEXT),
    ("bsd", "redistribution and use in source and binary forms", None, 0.7, TEXT - 1),
    ("bsd", "redistributions of source code must retain the above copyright notice", None, 0.8, TEXT),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", None, 0.8, TEXT),
    ("bsd", "may be used to endorse or promote products derived from this software",
     rf"neither the names? of {_SOME}(?:nor the names? of {_SOME})?may be used to endorse or promote products derived from this software", 0.85, TEXT),
    ("bsd", "all advertising materials mentioning features or use of this software must display the following acknowledg",
     r"all advertising materials mentioning features or use of this software must display the following acknowledge?ments?", 0.85, TEXT),
    ("bsd", "use of this source code is governed by a bsd style license", None, 0.85, TEXT),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?= the software is provided)", 0.9, TEXT),
    ("bsd", "opensource org licenses bsd", r"opensource org licenses bsd(?: license(?: php)?| [234] clause)?", 0.8, URL),
    ("bsd", "clause bsd", r"(?:[234]|two|three|four) clause bsd(?: licen[cs]e)?", 0.6, SHORT),
    ("bsd", "bsd style license", None, 0.5, SHORT),
    # ISC, zlib, Boost, HPND
    ("isc", "for any purpose with or without fee is hereby granted provided that the above copyright notice",
     r"permission to use copy modify (?:and or|and) distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", 0.9, TEXT),
    ("isc", "opensource org licenses isc", None, 0.8, URL),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose",
     r"permission to use copy modify and distribute this software and its documentation for any purpose(?: and)?(?: with or)? without fee is hereby granted", 0.85, TEXT),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", None, 0.9, TEXT),
    ("zlib", "you must not claim that you wrote the original software",
     r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", 0.9, TEXT),
    ("zlib", "altered source versions must be plainly marked as such", None, 0.85, TEXT),
    ("zlib", "zlib net zlib license", r"zlib net zlib license(?: html)?", 0.8, URL),
    ("boost", "obtaining a copy of the software and accompanying documentation covered by this license",
     r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 0.95, TEXT),
    ("boost", "unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor", None, 0.9, TEXT),
    ("boost", "boost org license 1 0", r"(?:www )?boost org license 1 0(?: txt)?", 0.8, URL),
    # GNU
    ("gpl", "is free software you can redistribute it and or modify it",
     rf"is free software you can redistribute it and or modify it {_TERMS}gnu general public license(?: as published by the free software foundation)?", 0.95, TEXT),
    ("lgpl", "is free software you can redistribute it and or modify it",
     rf"is free software you can redistribute it and or modify it {_TERMS}gnu (?:lesser|library) general public license(?: as published by the free software foundation)?", 0.95, TEXT),
    ("agpl", "is free software you can redistribute it and or modify it",
     rf"is free software you can redistribute it and or modify it {_TERMS}gnu affero general public license(?: as published by the free software foundation)?", 0.95, TEXT),
    ("gpl", "this program is free software you can redistribute",
     r"this program is free software you can redistribute(?: it)?+(?: and or modify it)?+(?! under (?:the )?terms of (?:the )?gnu (?:lesser|library|affero))", 0.7, TEXT - 1),
    ("lgpl", "this library is free software you can redistribute",
     r"this library is free software you can redistribute(?: it)?+(?: and or modify it)?+(?! under (?:the )?terms of (?:the )?gnu (?:general|affero))", 0.7, TEXT - 1),
    ("gpl", "by contrast the gnu general public license is intended to guarantee your freedom", None, 0.9, TEXT),
    ("gpl", "the gnu general public license is a free copyleft license for software and other kinds of works", None, 0.95, TEXT),
    ("gpl", "you must cause the modified files to carry prominent notices stating that you changed the files", None, 0.8, TEXT),
    ("gpl", "the gnu general public license does not permit incorporating your program into proprietary programs", None, 0.9, TEXT),
    ("lgpl", "by contrast the gnu general public licenses are intended to guarantee your freedom", None, 0.85, TEXT),
    ("lgpl", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3", None, 0.95, TEXT),
    ("lgpl", "the lesser general public license applies to some specially designated software", None, 0.9, TEXT),
    ("lgpl", "a program that contains no derivative of any portion of the library but is designed to work with the library", None, 0.85, TEXT),
    ("agpl", "the gnu affero general public license is a free copyleft license for software and other kinds of works", None, 0.95, TEXT),
    ("agpl", "specifically designed to ensure cooperation with the community in the case of network server software", None, 0.9, TEXT),
    ("agpl", "your modified version must prominently offer all users interacting with it remotely through a computer network", None, 0.9, TEXT),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", None, 0.95, TEXT),
    ("gfdl", "the purpose of this license is to make a manual textbook or other functional and useful document free in the sense of freedom", None, 0.9, TEXT),
    ("gpl", "gnu org licenses", r"gnu org licenses (?:old licenses )?gpl(?: [0-9]+(?: [0-9]+)?)?(?: (?:html|txt))?", 0.8, URL),
    ("lgpl", "gnu org licenses", r"gnu org licenses (?:old licenses )?lgpl(?: [0-9]+(?: [0-9]+)?)?(?: (?:html|txt))?", 0.8, URL),
    ("agpl", "gnu org licenses", r"gnu org licenses agpl(?: [0-9]+(?: [0-9]+)?)?(?: (?:html|txt))?", 0.8, URL),
    ("gfdl", "gnu org licenses", r"gnu org licenses (?:old licenses )?fdl(?: [0-9]+(?: [0-9]+)?)?(?: (?:html|txt))?", 0.8, URL),
    ("gpl", "gpl", r"(?<!gnu )gpl (?:version |v )?[123](?: [0-9])?(?: or (?:any )?later| only)?", 0.6, SHORT),
    ("gpl", "gpl", r"gplv[123](?: or later| only)?", 0.6, SHORT),
    ("lgpl", "lgpl", r"lgpl ?(?:version |v )?[23](?: [0-9])?(?: or (?:any )?later| only)?", 0.6, SHORT),
    ("lgpl", "lgplv2", r"lgplv2(?: 1)?(?: or later| only)?", 0.6, SHORT),
    ("agpl", "agpl", r"agpl ?(?:version |v )?[13](?: [0-9])?(?: or (?:any )?later| only)?", 0.6, SHORT),
    # Apache
    ("apache", "you may not use this file except in compliance with the license",
     r"you may not use this file except in compliance with the license you may obtain a copy of the license at (?:https? )?(?:www )?apache org licenses license 2 0", 0.95, TEXT),
    ("apache", "you may not use this file except in compliance",
     r"you may not use this file except in compliance(?: with the license)?+(?! you can obtain)(?! you (?:may|can) obtain a copy of the license at (?:https? )?(?:www )?(?:mozilla|opensource|osedu|eclipse|usr|opensolaris|netscape|sun))", 0.6, TEXT - 1),
    ("apache", "apache license version 2 0 january 2004", None, 0.95, TEXT),
    ("apache", "you must cause any modified files to carry prominent notices stating that you changed the files", None, 0.85, TEXT),
    ("apache", "licensed to the apache software foundation asf under one or more contributor license agreements", None, 0.95, TEXT),
    ("apache", "this product includes software developed by the apache", None, 0.6, SHORT),
    ("apache", "apache org licenses", r"apache org licenses license (?:1 [01]|2 0)(?: (?:txt|html))?", 0.85, URL),
    ("apache", "opensource org licenses apache", r"opensource org licenses apache 2 0", 0.85, URL),
    ("apache", "apache 2", r"apache 2(?: 0)?(?: licen[cs]ed?)?", 0.5, SHORT),
    ("ecl", "educational community license", r"educational community license(?: version)?(?: 2 0)?", 0.8, TEXT),
    # Mozilla, Eclipse, CDDL, CPL and other weak copyleft
    ("mpl", "this source code form is subject to the terms of the mozilla public license", None, 0.95, TEXT),
    ("mpl", "the contents of this file are subject to the mozilla public license", None, 0.95, TEXT),
    ("mpl", "this source code form is incompatible with secondary licenses", None, 0.8, TEXT),
    ("mpl", "mozilla org mpl", r"mozilla org mpl(?: [12] [01])?", 0.85, URL),
    ("mpl", "mpl", r"mpl (?:v |version )?[12] [01]", 0.6, SHORT),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", None, 0.95, TEXT),
    ("epl", "the accompanying program is provided under the terms of this eclipse public license", None, 0.95, TEXT),
    ("epl", "eclipse org legal epl", r"eclipse org legal epl (?:v10|v20|2 0)(?: html)?", 0.85, URL),
    ("edl", "eclipse distribution license", None, 0.8, TEXT),
    ("cpl", "the accompanying program is provided under the terms of this common public license", None, 0.95, TEXT),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", None, 0.95, TEXT),
    ("cddl", "cddl", r"cddl (?:v |version )?1 [01]", 0.6, SHORT),
    ("cddl", "when distributing covered code include this cddl header in each file", r"when distributing covered code include this cddl header(?: in each file)?", 0.9, TEXT),
    ("artistic", "the copyright holder maintains some semblance of artistic control", None, 0.9, TEXT),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied", None, 0.9, TEXT),
    ("artistic", "same terms as perl", r"(?:under|on) the same terms as (?:the )?perl(?: 5)?(?: programming language)?(?: system)?(?: itself)?", 0.7, TEXT),
    ("artistic", "same terms as perl itself", None, 0.6, SHORT),
    ("eupl", "licensed under the eupl", r"licensed under the eupl(?: version)?(?: 1 [012])?", 0.9, TEXT),
    ("eupl", "eupl", r"eupl (?:v |version )?1 [012]", 0.6, SHORT),
    ("cecill", "cecill", r"(?:governed by the )?cecill(?: [abc12])?(?: [01])? license", 0.8, TEXT),
    ("osl", "open software license", r"open software license(?: version| v)?(?: [123] [01])?", 0.8, TEXT),
    ("afl", "academic free license", r"academic free license(?: version| v)?(?: [123] [01])?", 0.8, TEXT),
    ("ncsa", "university of illinois ncsa open source license", None, 0.9, TEXT),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license", None, 0.7, TEXT),
    ("ms-pl", "ms pl", r"(?:licensed under|the) ms pl", 0.6, SHORT),
    ("ms-rl", "microsoft reciprocal license", None, 0.9, TEXT),
    ("cpal", "common public attribution license", None, 0.9, TEXT),
    ("sspl", "server side public license", r"server side public license(?: version| v)?(?: 1)?", 0.9, TEXT),
    ("bsl", "business source license", r"business source license(?: 1 1)?", 0.8, TEXT),
    ("elastic", "elastic license", r"elastic license(?: version)?(?: 2 0)?", 0.8, TEXT),
    ("commons-clause", "commons clause license condition", r"commons clause license condition(?: v1 0)?", 0.9, TEXT),
    ("upl", "universal permissive license", None, 0.9, TEXT),
    ("postgresql", "postgresql license", None, 0.8, TEXT),
    ("w3c", "w3c software notice and license", r"w3c software(?: and document)? notice and license", 0.9, TEXT),
    ("curl", "curl license", None, 0.6, SHORT),
    ("blueoak", "blue oak model license", r"blue oak model license(?: 1 0 0)?", 0.9, TEXT),
    ("qpl", "q public license", None, 0.8, TEXT),
    ("ipl", "ibm public license", None, 0.9, TEXT),
    ("apsl", "apple public source license", None, 0.9, TEXT),
    ("mulan", "mulan permissive software license", None, 0.9, TEXT),
    # Runtimes and libraries
    ("openssl", "this product includes software developed by the openssl project", None, 0.85, TEXT),
    ("openssl", "this product includes cryptographic software written by eric young", None, 0.8, TEXT),
    ("php", "this source file is subject to version", r"this source file is subject to version [23] [0-9]+ of the php license", 0.95, TEXT),
    ("php", "php net license", r"php net license(?: [23] [0-9]+(?: txt)?)?", 0.85, URL),
    ("psf", "this license agreement is between the python software foundation psf and the individual or organization", None, 0.95, TEXT),
    ("ruby", "you can redistribute it and or modify it under either the terms of the",
     r"you can redistribute it and or modify it under either the terms of the (?:2 clause bsdl|gpl)", 0.85, TEXT),
    ("ruby", "ruby is copyrighted free software by yukihiro matsumoto", None, 0.9, TEXT),
    ("ofl", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects", None, 0.95, TEXT),
    ("ofl", "this font software is licensed under the sil open font license", None, 0.95, TEXT),
    ("ofl", "scripts sil org ofl", None, 0.85, URL),
    ("odbl", "opendatacommons org licenses odbl", None, 0.85, URL),
    ("odbl", "odbl", r"odbl (?:v |version )?1 0", 0.6, SHORT),
    ("pddl", "public domain dedication and license", r"(?:open data commons )?public domain dedication and licen[cs]e", 0.9, TEXT),
    ("odc-by", "open data commons attribution license", None, 0.9, TEXT),
    # Public domain and Creative Commons
    ("unlicense", "this is free and unencumbered software released into the public domain", None, 0.95, TEXT),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", None, 0.9, TEXT),
    ("unlicense", "unlicense org", None, 0.7, URL),
    ("wtfpl", "you just do what the fuck you want to", r"you just do what the fuck you want to", 0.9, TEXT),
    ("wtfpl", "wtfpl", None, 0.7, SHORT),
    ("beerware", "buy me a beer in return", rf"as long as you retain this notice you can do whatever you want with this stuff {_SOME}(?:[^ ]+ ){{0,10}}?buy me a beer in return", 0.9, TEXT),
    ("beerware", "beer ware license", None, 0.8, TEXT),
    ("cc0", "creativecommons org publicdomain zero", r"creativecommons org publicdomain zero 1 0(?: legalcode)?", 0.9, URL),
    ("cc0", "to the extent possible under law", rf"to the extent possible under law {_SOME}waived all copyright and related or neighboring rights", 0.9, TEXT),
    ("cc0", "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights", None, 0.9, TEXT),
    ("public-domain", "creativecommons org publicdomain mark", r"creativecommons org publicdomain mark 1 0", 0.8, URL),
    ("public-domain", "in the public domain", r"(?:is|are|placed|put|hereby) in the public domain", 0.6, SHORT),
    *(
        (f"cc-{code}", f"creativecommons org licenses {code.replace('-', ' ')}",
         rf"creativecommons org licenses {code.replace('-', ' ')} [1-4] [05](?: [a-z]{{2}})?(?: (?:legalcode|deed))?", 0.9, URL)
        for code in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
    ),
    *(
        (f"cc-{code}", name, rf"(?:creative commons )?{name}(?: [1-4] [05])?(?: international| unported| generic)?(?: public)? licen[cs]e", 0.85, TEXT - 1)
        for code, name in (
            ("by", "creative commons attribution"), ("by-sa", "attribution sharealike"), ("by-sa", "attribution share alike"),
            ("by-nc", "attribution noncommercial"), ("by-nc", "attribution non commercial"),
            ("by-nd", "attribution noderivatives"), ("by-nd", "attribution noderivs"), ("by-nd", "attribution no derivatives"),
            ("by-nc-sa", "attribution noncommercial sharealike"), ("by-nc-sa", "attribution non commercial share alike"),
            ("by-nc-nd", "attribution noncommercial noderivatives"), ("by-nc-nd", "attribution noncommercial noderivs"),
            ("by-nc-nd", "attribution non commercial no derivatives"),
        )
    ),
    # Closed
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", None, 0.95, TEXT),
    ("proprietary", "this software is the confidential and proprietary information of", None, 0.95, TEXT),
    ("proprietary", "end user license agreement", None, 0.6, SHORT),
    ("proprietary", "for internal use only", None, 0.5, SHORT),
)

# SPDX ids of each label, as words.
_GNU = ("", " only", " or later")
SPDX = {
    "gpl": [f"gpl {v} 0{e}" for v in (1, 2, 3) for e in _GNU],
    "lgpl": [f"lgpl {v}{e}" for v in ("2 0", "2 1", "3 0") for e in _GNU],
    "agpl": [f"agpl {v} 0{e}" for v in (1, 3) for e in _GNU],
    "gfdl": [f"gfdl 1 {v}{k}{e}" for v in (1, 2, 3) for k in ("", " invariants", " no invariants") for e in _GNU],
    "apache": ["apache 1 0", "apache 1 1", "apache 2 0"], "ecl": ["ecl 1 0", "ecl 2 0"],
    "mit": ["mit", "mit advertising", "mit cmu", "mit feh", "mit modern variant", "mitnfa"], "mit-0": ["mit 0"], "x11": ["x11"], "json": ["json"],
    "bsd": ["bsd 1 clause", "bsd 2 clause", "bsd 2 clause patent", "bsd 2 clause views", "bsd 3 clause", "bsd 3 clause clear",
            "bsd 3 clause lbnl", "bsd 3 clause attribution", "bsd 4 clause", "bsd 4 clause uc", "bsd source code", "bsd protection"],
    "0bsd": ["0bsd"], "isc": ["isc"], "hpnd": ["hpnd"], "zlib": ["zlib", "zlib acknowledgement", "libpng", "libpng 2 0"], "boost": ["bsl 1 0"],
    "mpl": ["mpl 1 0", "mpl 1 1", "mpl 2 0", "mpl 2 0 no copyleft exception"], "epl": ["epl 1 0", "epl 2 0"], "cpl": ["cpl 1 0"],
    "cddl": ["cddl 1 0", "cddl 1 1"], "artistic": ["artistic 1 0", "artistic 1 0 perl", "artistic 1 0 cl8", "artistic 2 0", "clartistic"],
    "eupl": ["eupl 1 0", "eupl 1 1", "eupl 1 2"], "osl": [f"osl {v}" for v in ("1 0", "1 1", "2 0", "2 1", "3 0")],
    "afl": [f"afl {v}" for v in ("1 1", "1 2", "2 0", "2 1", "3 0")], "ncsa": ["ncsa"], "ms-pl": ["ms pl"], "ms-rl": ["ms rl"],
    "cecill": ["cecill 1 0", "cecill 1 1", "cecill 2 0", "cecill 2 1", "cecill b", "cecill c"], "cpal": ["cpal 1 0"], "sspl": ["sspl 1 0"],
    "bsl": ["busl 1 1"], "elastic": ["elastic 2 0"], "upl": ["upl 1 0"], "postgresql": ["postgresql"],
    "w3c": ["w3c", "w3c 19980720", "w3c 20150513"], "curl": ["curl"], "blueoak": ["blueoak 1 0 0"], "qpl": ["qpl 1 0"], "ipl": ["ipl 1 0"],
    "apsl": ["apsl 1 0", "apsl 1 1", "apsl 1 2", "apsl 2 0"], "mulan": ["mulanpsl 1 0", "mulanpsl 2 0"], "openssl": ["openssl"],
    "php": ["php 3 0", "php 3 01"], "psf": ["psf 2 0", "python 2 0", "python 2 0 1"], "ruby": ["ruby"],
    "ofl": ["ofl 1 0", "ofl 1 1", "ofl 1 0 rfn", "ofl 1 1 rfn", "ofl 1 0 no rfn", "ofl 1 1 no rfn"],
    "odbl": ["odbl 1 0"], "pddl": ["pddl 1 0"], "odc-by": ["odc by 1 0"], "unlicense": ["unlicense"], "wtfpl": ["wtfpl"],
    "beerware": ["beerware"], "cc0": ["cc0 1 0"], "public-domain": ["cc pddc"],
    **{f"cc-{c}": [f"cc {c.replace('-', ' ')} {v}" for v in ("1 0", "2 0", "2 5", "3 0", "4 0")]
       for c in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")},
}
SPDX_WEIGHT, SPDX_PRIORITY = 0.95, 80


def spdx_ids() -> dict[str, str]:
    """SPDX id as words -> label."""
    return {i: label for label, ids in SPDX.items() for i in ids}


def spdx_pattern() -> tuple[str, str]:
    """The pattern of an SPDX tag with its expression as group, and that of one id in it."""
    one = "(?:" + "|".join(sorted(spdx_ids(), key=len, reverse=True)) + ")(?= )"
    link = r" (?:with (?:[^ ]+ ){0,5}?exception (?:[0-9]+ ){0,3})?(?:or|and) "
    return rf"spdx license identifier ({one}(?:{link}{one})*)", rf"(?<![^ ]){one}"


def rules() -> list[tuple[str, str, str, float, int]]:
    """(label, keyword, pattern, weight, priority): every form around every name, and the signatures."""
    return [
        (label, keyword, pattern or keyword, weight, priority * 10) for label, keyword, pattern, weight, priority in SIGNATURES
    ] + [
        (label, name, form.format(name), weight, priority * 10 + name.count(" "))
        for label, names in FAMILIES
        for name in names
        for form, weight, priority in FORMS
    ]
