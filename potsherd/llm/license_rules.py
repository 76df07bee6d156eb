"""Signatures of licenses: sentences of their texts, headers, notices, identifiers and names.

Each is a regular expression over words (small letters and digits, one space between), of 40 words at most, behind a keyword
that each of its matches holds. Higher priorities win: 90 identifiers, 80 notices that name a license with its version or
exception, 70 sentences of a license's own text, 60 names, 50 notices without a license, 40 copyright lines, 10 mentions.
"""

from __future__ import annotations

#: label -> (priority, keyword, pattern), in order; of equal priority and length the earlier one stands.
SIGNATURES: dict[str, tuple[tuple[int, str, str], ...]] = {
    "mit": (
        (90, "spdx", "spdx license identifier mit(?: 0)?"),
        (80, "licensed", "licensed under (?:the )?(?:terms of (?:the )?)?mit(?: licen[cs]e)?"),
        (80, "released", "released under (?:the )?(?:terms of (?:the )?)?mit licen[cs]e"),
        (80, "distributed", "distributed under (?:the )?(?:terms of (?:the )?)?mit licen[cs]e"),
        (80, "available", "available under (?:the )?(?:terms of (?:the )?)?mit licen[cs]e"),
        (70, "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        (70, "sublicense", "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
        (70, "copyright", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
        (70, "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
        (70, "tort", "whether in an action of contract tort or otherwise arising from out of or in connection with the software"),
        (60, "license", "(?:mit|expat) license"),
        (60, "licence", "(?:mit|expat) licence"),
        (60, "x11", "(?:mit x11|x11 mit|x11 licen[cs]e)"),
    ),
    "apache": (
        (90, "spdx", "spdx license identifier apache (?:1 0|1 1|2 0)"),
        (80, "licensed", "licensed under the apache licen[cs]e(?: version)? (?:1 0|1 1|2 0)"),
        (80, "released", "released under (?:the )?(?:terms of (?:the )?)?apache(?: licen[cs]e)?(?: version)? 2 0"),
        (80, "apache", "apache licen[cs]e(?: version| v)? ?(?:1 0|1 1|2 0)"),
        (70, "apache", "www apache org licenses license 2 0"),
        (70, "compliance", "you may not use this file except in compliance with the license"),
        (70, "applicable", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
        (70, "contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
        (70, "derivative", "you may reproduce and distribute copies of the work or derivative works thereof in any medium with or without modifications"),
        (70, "asf", "licensed to the apache software foundation asf under one or more contributor license agreements"),
        (70, "apache", "this product includes software developed by the apache (?:software foundation|group)"),
        (60, "apache", "apache license"),
        (60, "apache", "apache licence"),
    ),
    "gpl": (
        (90, "spdx", "spdx license identifier gpl (?:1 0|2 0|3 0)(?: only| or later)?"),
        (80, "gpl", "(?:gnu )?gpl(?: version| v)? ?(?:1|2|3)(?: 0)?(?: or later| only)?"),
        (80, "gplv2", "(?:gnu )?gplv2(?: or later)?"),
        (80, "gplv3", "(?:gnu )?gplv3(?: or later)?"),
        (80, "general", "gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) ?(?:1|2|3)"),
        (80, "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
        (80, "released", "released under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl"),
        (70, "purpose", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
        (70, "general", "you should have received a copy of the gnu general public license along with"),
        (70, "freedom", "the gnu general public license is intended to guarantee your freedom to share and change"),
        (70, "permissions", "basic permissions all rights granted under this license are granted for the term of copyright"),
        (70, "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
        (70, "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
        (60, "general", "gnu general public licen[cs]e"),
        (60, "public", "general public license"),
        (60, "gpl", "gnu gpl"),
        (60, "gpl", "gpl licen[cs]ed?"),
    ),
    "gpl-exception": (
        (90, "classpath", "gpl 2 0 with classpath exception(?: 2 0)?"),
        (80, "classpath", "classpath exception"),
        (80, "exception", "as a special exception the copyright holders (?:of this (?:library|program) )?give you permission to link this (?:library|program)"),
        (80, "openssl", "as a special exception (?:[^ ]+ ){0,10}permission to link (?:[^ ]+ ){0,8}with the openssl library"),
        (80, "gcc", "gcc runtime library exception"),
        (80, "bison", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
        (80, "autoconf", "as a special exception (?:[^ ]+ ){0,15}configuration script generated by autoconf"),
        (80, "font", "gpl font exception"),
    ),
    "lgpl": (
        (90, "spdx", "spdx license identifier lgpl (?:2 0|2 1|3 0)(?: only| or later)?"),
        (80, "lgpl", "(?:gnu )?lgpl(?: version| v)? ?(?:2|2 0|2 1|3|3 0)(?: or later| only)?"),
        (80, "lgplv2", "lgplv2(?: 1)?"),
        (80, "lgplv3", "lgplv3"),
        (80, "lesser", "gnu lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) ?(?:2 1|3)(?: 0)?"),
        (80, "library", "gnu library general public licen[cs]e"),
        (80, "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
        (70, "lesser", "you should have received a copy of the gnu lesser general public license along with"),
        (70, "library", "a work that uses the library"),
        (70, "combined", "a combined work is a work produced by combining or linking an application with the library"),
        (60, "lesser", "gnu lesser general public licen[cs]e"),
        (60, "lesser", "lesser gpl"),
        (60, "lgpl", "lgpl licen[cs]ed?"),
    ),
    "agpl": (
        (90, "spdx", "spdx license identifier agpl (?:1 0|3 0)(?: only| or later)?"),
        (80, "agpl", "(?:gnu )?agpl(?: version| v)? ?3(?: 0)?(?: or later| only)?"),
        (80, "agplv3", "agplv3"),
        (80, "affero", "gnu affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) ?3"),
        (70, "affero", "you should have received a copy of the gnu affero general public license along with"),
        (70, "remotely", "your modified version must prominently offer all users interacting with it remotely through a computer network"),
        (60, "affero", "(?:gnu )?affero general public licen[cs]e"),
        (60, "agpl", "agpl licen[cs]ed?"),
    ),
    "fdl": (
        (90, "spdx", "spdx license identifier gfdl 1 (?:1|2|3)(?: only| or later)?"),
        (80, "documentation", "gnu free documentation licen[cs]e (?:version|v) ?1 (?:1|2|3)"),
        (70, "invariant", "with no invariant sections no front cover texts and no back cover texts"),
        (60, "documentation", "gnu free documentation licen[cs]e"),
        (60, "gfdl", "gfdl"),
    ),
    "bsd": (
        (90, "spdx", "spdx license identifier bsd (?:2|3|4) clause"),
        (90, "spdx", "spdx license identifier 0bsd"),
        (80, "bsd", "bsd (?:2|3|4) clause(?: licen[cs]e)?"),
        (80, "clause", "(?:2|two|3|three|4|four) clause bsd(?: licen[cs]e)?"),
        (80, "simplified", "simplified bsd licen[cs]e"),
        (80, "modified", "(?:modified|new|revised) bsd licen[cs]e"),
        (80, "licensed", "licensed under (?:the )?(?:terms of (?:the )?)?bsd(?: style)?(?: licen[cs]e)?"),
        (70, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
        (70, "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
        (70, "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
        (70, "endorse", "neither the name of (?:[^ ]+ ){1,10}nor the names of its contributors may be used to endorse or promote products derived from this software"),
        (70, "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment"),
        (70, "procurement", "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption"),
        (70, "exemplary", "be liable for any direct indirect incidental special exemplary or consequential damages"),
        (60, "bsd", "bsd licen[cs]e"),
        (60, "berkeley", "berkeley software distribution licen[cs]e"),
    ),
    "isc": (
        (90, "spdx", "spdx license identifier isc"),
        (80, "isc", "(?:licensed|released|distributed) under (?:the )?isc licen[cs]e"),
        (70, "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        (70, "disclaims", "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
        (60, "isc", "isc licen[cs]e"),
    ),
    "mpl": (
        (90, "spdx", "spdx license identifier mpl (?:1 0|1 1|2 0)"),
        (80, "mozilla", "mozilla public licen[cs]e(?: version| v)? ?(?:1 0|1 1|2 0)"),
        (80, "mpl", "mpl(?: version| v)? ?(?:1 0|1 1|2 0)"),
        (70, "mozilla", "this source code form is subject to the terms of the mozilla public license"),
        (70, "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
        (70, "secondary", "this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
        (60, "mozilla", "mozilla public licen[cs]e"),
    ),
    "epl": (
        (90, "spdx", "spdx license identifier epl (?:1 0|2 0)"),
        (80, "eclipse", "eclipse public licen[cs]e(?: version| v)? ?(?:1 0|2 0)"),
        (70, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
        (60, "eclipse", "eclipse public licen[cs]e"),
        (60, "eclipse", "eclipse distribution licen[cs]e"),
    ),
    "cpl": (
        (80, "common", "common public licen[cs]e(?: version| v)? ?(?:0 5|1 0)"),
        (70, "constitutes", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
        (60, "common", "common public licen[cs]e"),
        (60, "ibm", "ibm public licen[cs]e"),
    ),
    "cddl": (
        (90, "spdx", "spdx license identifier cddl 1 (?:0|1)"),
        (80, "cddl", "cddl(?: version| v)? ?1 (?:0|1)"),
        (70, "development", "the contents of this file are subject to the terms of the common development and distribution license"),
        (60, "development", "common development and distribution licen[cs]e"),
    ),
    "zlib": (
        (90, "spdx", "spdx license identifier zlib"),
        (70, "warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
        (70, "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
        (70, "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
        (60, "zlib", "zlib(?: libpng)? licen[cs]e"),
    ),
    "boost": (
        (90, "spdx", "spdx license identifier bsl 1 0"),
        (80, "boost", "boost software licen[cs]e(?: version| v)? ?1 0"),
        (70, "boost", "distributed under the boost software license"),
        (70, "machine", "solely in the form of machine executable object code generated by a source language processor"),
        (60, "boost", "boost software licen[cs]e"),
    ),
    "artistic": (
        (90, "spdx", "spdx license identifier artistic (?:1 0|2 0)"),
        (80, "artistic", "artistic licen[cs]e(?: version| v)? ?(?:1 0|2 0)"),
        (70, "perl", "you can redistribute it and or modify it under the same terms as perl itself"),
        (60, "artistic", "artistic licen[cs]e"),
    ),
    "unlicense": (
        (90, "spdx", "spdx license identifier unlicense"),
        (70, "unencumbered", "this is free and unencumbered software released into the public domain"),
        (70, "heirs", "we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
        (60, "unlicense", "the unlicense"),
    ),
    "wtfpl": (
        (90, "spdx", "spdx license identifier wtfpl"),
        (80, "wtfpl", "wtfpl(?: version| v)? ?2"),
        (60, "wtfpl", "wtfpl"),
    ),
    "eupl": (
        (90, "spdx", "spdx license identifier eupl 1 (?:0|1|2)"),
        (80, "eupl", "eupl(?: version| v)? ?1 (?:0|1|2)"),
        (70, "eupl", "licensed under the eupl"),
        (60, "european", "european union public licen[cs]e"),
    ),
    "ofl": (
        (90, "spdx", "spdx license identifier ofl 1 (?:0|1)"),
        (80, "sil", "sil open font licen[cs]e(?: version| v)? ?1 (?:0|1)"),
        (70, "font", "this font software is licensed under the sil open font license"),
        (70, "reserved", "with reserved font name"),
        (60, "sil", "sil open font licen[cs]e"),
        (60, "font", "open font licen[cs]e"),
    ),
    "psf": (
        (90, "spdx", "spdx license identifier (?:psf|python) 2 0"),
        (70, "python", "python software foundation license agreement for python"),
        (70, "psf", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
        (60, "python", "python software foundation licen[cs]e"),
    ),
    "ms-pl": (
        (90, "spdx", "spdx license identifier ms (?:pl|rl)"),
        (60, "microsoft", "microsoft public licen[cs]e"),
        (60, "microsoft", "microsoft reciprocal licen[cs]e"),
        (70, "trademarks", "this license does not grant you rights to use any contributors name logo or trademarks"),
    ),
    "bsl": (
        (90, "spdx", "spdx license identifier busl 1 1"),
        (80, "business", "business source licen[cs]e(?: version| v)? ?1 1"),
        (70, "production", "you may make production use of the licensed work provided"),
        (60, "business", "business source licen[cs]e"),
    ),
    "sspl": (
        (90, "spdx", "spdx license identifier sspl 1 0"),
        (80, "sspl", "sspl(?: version| v)? ?1"),
        (60, "server", "server side public licen[cs]e"),
    ),
    "elastic": (
        (90, "spdx", "spdx license identifier elastic 2 0"),
        (60, "elastic", "elastic licen[cs]e(?: 2 0)?"),
    ),
    "openssl": (
        (90, "spdx", "spdx license identifier openssl"),
        (70, "openssl", "this product includes software developed by the openssl project"),
        (70, "cryptographic", "this product includes cryptographic software written by eric young"),
        (60, "openssl", "openssl licen[cs]e"),
    ),
    "php": (
        (90, "spdx", "spdx license identifier php 3 0(?: 1)?"),
        (70, "php", "this product includes php software freely available from"),
        (60, "php", "php licen[cs]e(?: version)?"),
    ),
    "ruby": (
        (90, "spdx", "spdx license identifier ruby"),
        (70, "ruby", "you can redistribute it and or modify it under (?:either )?the (?:same )?terms (?:of|as) ruby"),
        (60, "ruby", "ruby licen[cs]e"),
    ),
    "w3c": (
        (90, "spdx", "spdx license identifier w3c(?: 20150513)?"),
        (60, "w3c", "w3c software(?: and document)?(?: notice and)? licen[cs]e"),
    ),
    "curl": ((90, "spdx", "spdx license identifier curl"), (60, "curl", "curl licen[cs]e")),
    "ncsa": ((90, "spdx", "spdx license identifier ncsa"), (60, "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[cs]e")),
    "unicode": ((90, "spdx", "spdx license identifier unicode dfs 201(?:5|6)"), (70, "unicode", "unicode data files and software"), (60, "unicode", "unicode licen[cs]e agreement")),
    "postgresql": ((90, "spdx", "spdx license identifier postgresql"), (60, "postgresql", "postgresql licen[cs]e")),
    "beerware": ((90, "spdx", "spdx license identifier beerware"), (70, "beer", "if we meet some day and you think this stuff is worth it you can buy me a beer"), (60, "beerware", "beerware licen[cs]e")),
    "vim": ((90, "spdx", "spdx license identifier vim"), (60, "vim", "vim licen[cs]e")),
    "odbl": ((90, "spdx", "spdx license identifier odbl 1 0"), (80, "database", "open database licen[cs]e(?: version| v)? ?1 0"), (60, "database", "open (?:data commons )?(?:open )?database licen[cs]e")),
    "ogl": ((80, "government", "open government licen[cs]e(?: version| v)? ?(?:1 0|2 0|3 0)"), (60, "government", "open government licen[cs]e"), (70, "sector", "contains public sector information licensed under the open government licen[cs]e")),
    "cc0": (
        (90, "spdx", "spdx license identifier cc0 1 0"),
        (80, "cc0", "cc0 1 0(?: universal)?"),
        (70, "waived", "has waived all copyright and related or neighboring rights"),
        (70, "creativecommons", "creativecommons org publicdomain zero 1 0"),
        (60, "cc0", "cc0"),
    ),
    "cc-by": (
        (90, "spdx", "spdx license identifier cc by (?:1 0|2 0|2 5|3 0|4 0)"),
        (80, "attribution", "creative commons attribution (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported)?"),
        (80, "cc", "cc by (?:1 0|2 0|2 5|3 0|4 0)"),
        (70, "creativecommons", "creativecommons org licenses by (?:1 0|2 0|2 5|3 0|4 0)"),
        (60, "attribution", "creative commons attribution(?: licen[cs]e)?"),
        (60, "cc", "cc by"),
    ),
    "cc-by-sa": (
        (90, "spdx", "spdx license identifier cc by sa (?:1 0|2 0|2 5|3 0|4 0)"),
        (80, "sharealike", "creative commons attribution sharealike (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported)?"),
        (80, "cc", "cc by sa (?:1 0|2 0|2 5|3 0|4 0)"),
        (70, "creativecommons", "creativecommons org licenses by sa (?:1 0|2 0|2 5|3 0|4 0)"),
        (65, "alike", "creative commons attribution share alike"),
        (65, "sharealike", "creative commons attribution sharealike"),
        (65, "cc", "cc by sa"),
    ),
    "cc-by-nc": (
        (90, "spdx", "spdx license identifier cc by nc (?:1 0|2 0|2 5|3 0|4 0)"),
        (80, "noncommercial", "creative commons attribution noncommercial (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported)?"),
        (80, "cc", "cc by nc (?:1 0|2 0|2 5|3 0|4 0)"),
        (70, "creativecommons", "creativecommons org licenses by nc (?:1 0|2 0|2 5|3 0|4 0)"),
        (65, "noncommercial", "creative commons attribution noncommercial"),
        (65, "cc", "cc by nc"),
    ),
    "cc-by-nd": (
        (90, "spdx", "spdx license identifier cc by nd (?:1 0|2 0|2 5|3 0|4 0)"),
        (80, "noderivatives", "creative commons attribution noderivatives (?:3 0|4 0)(?: international| unported)?"),
        (80, "cc", "cc by nd (?:1 0|2 0|2 5|3 0|4 0)"),
        (70, "creativecommons", "creativecommons org licenses by nd (?:1 0|2 0|2 5|3 0|4 0)"),
        (65, "cc", "cc by nd"),
    ),
    "cc-by-nc-sa": (
        (90, "spdx", "spdx license identifier cc by nc sa (?:1 0|2 0|2 5|3 0|4 0)"),
        (80, "noncommercial", "creative commons attribution noncommercial sharealike (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported)?"),
        (80, "cc", "cc by nc sa (?:1 0|2 0|2 5|3 0|4 0)"),
        (70, "creativecommons", "creativecommons org licenses by nc sa (?:1 0|2 0|2 5|3 0|4 0)"),
        (68, "cc", "cc by nc sa"),
    ),
    "cc-by-nc-nd": (
        (90, "spdx", "spdx license identifier cc by nc nd (?:1 0|2 0|2 5|3 0|4 0)"),
        (80, "noncommercial", "creative commons attribution noncommercial noderiv(?:ative)?s (?:1 0|2 0|2 5|3 0|4 0)(?: international| unported)?"),
        (80, "cc", "cc by nc nd (?:1 0|2 0|2 5|3 0|4 0)"),
        (70, "creativecommons", "creativecommons org licenses by nc nd (?:1 0|2 0|2 5|3 0|4 0)"),
        (68, "cc", "cc by nc nd"),
    ),
    "public-domain": (
        (70, "domain", "(?:released|placed|dedicated|put) (?:in|into|to) the public domain"),
        (70, "domain", "(?:this|the) (?:work|file|code|software|text) is in the public domain"),
        (70, "domain", "dedicated to the public domain by the authors?"),
        (70, "government", "work of the united states government and (?:is )?(?:therefore )?(?:not subject to copyright|in the public domain)"),
        (60, "domain", "public domain dedication"),
    ),
    "proprietary": (
        (80, "proprietary", "(?:licensed|released|distributed|provided) under (?:a |the )?proprietary licen[cs]e"),
        (70, "confidential", "confidential and proprietary information of"),
        (70, "unauthorized", "unauthorized (?:copying|reproduction|use|distribution) of this (?:file|software|document|material) (?:[^ ]+ ){0,8}is strictly prohibited"),
        (70, "reproduced", "no part of this (?:publication|work|document|book) may be reproduced stored in a retrieval system or transmitted"),
        (70, "reverse", "you may not reverse engineer decompile or disassemble"),
        (70, "transferable", "non exclusive non transferable (?:limited )?licen[cs]e to use"),
        (70, "evaluation", "for evaluation purposes only"),
        (70, "secrets", "contains trade secrets"),
        (60, "proprietary", "proprietary licen[cs]e"),
        (60, "eula", "end user licen[cs]e agreement eula"),
        (60, "agreement", "end user licen[cs]e agreement"),
    ),
    "non-commercial": (
        (70, "commercial", "for non commercial (?:use|purposes) only"),
        (70, "noncommercial", "for noncommercial (?:use|purposes) only"),
        (70, "academic", "for academic(?: and research)? (?:use|purposes) only"),
        (70, "research", "for research (?:use|purposes) only"),
        (70, "educational", "for educational (?:use|purposes) only"),
        (70, "commercial", "commercial use (?:is )?(?:not permitted|not allowed|prohibited)"),
    ),
    "ai-license": (
        (80, "rail", "open rail(?: m)? licen[cs]e"),
        (80, "openrail", "openrail(?: m)? licen[cs]e"),
        (80, "llama", "llama (?:2|3|3 1|3 2)? ?community licen[cs]e(?: agreement)?"),
        (70, "responsible", "responsible ai licen[cs]e"),
    ),
    "all-rights-reserved": (
        (50, "reserved", "all rights reserved"),
        (50, "reserved", "some rights reserved"),
        (50, "vorbehalten", "alle rechte vorbehalten"),
        (50, "voorbehouden", "alle rechten voorbehouden"),
        (50, "droits", "tous droits r[ée]serv[ée]s"),
        (50, "derechos", "todos los derechos reservados"),
    ),
    "copyright": (
        (40, "copyright", "copyright(?: c| ©)? (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?"),
        (40, "copyright", "(?:19|20)[0-9][0-9] copyright"),
        (40, "copyrighted", "is copyrighted by"),
        (40, "copyright", "copyright notice"),
    ),
    "license-mention": (
        (10, "license", "(?:this|the|a|following|software|open source|free|your|our|its) license"),
        (10, "licence", "(?:this|the|a|following|software|open source|free|your|our|its) licence"),
        (10, "licensed", "licensed (?:under|by|to|from)"),
        (10, "licensing", "(?:dual|multi) licensing"),
        (10, "sublicense", "(?:may|to|not) sublicense"),
        (10, "licensor", "the licensor"),
        (10, "licensee", "the licensee"),
    ),
}
