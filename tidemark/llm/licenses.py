"""License scans by ordered signature rules.

Rules are regular expressions over the words of a text, written by hand: names of licenses, each in
several frames, headers of files, and sentences of full texts. Each has a priority, and a keyword that
a text must hold before the expression is tried. Detections overlap: one whose interval of
words lies inside the interval of a detection of a better rule is suppressed, and so is one inside
a longer detection of the same priority. The phrases of ``BASE`` are reported in any case.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and labels that are always reported.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label -> names, as expressions over words in lower case that are joined by single spaces.
NAMES = {
    "agpl": ["gnu affero general public licen[sc]e", "affero gpl", "agpl(?: v? ?[13](?: 0)?)?"],
    "apache": ["apache licen[sc]e", "apache 2(?: 0)?", "apache software licen[sc]e"],
    "apache-1.1": ["apache licen[sc]e version 1 1", "apache 1 1"],
    "apache-2.0": ["apache licen[sc]e (?:version |v ?)?2 0", "apache 2 0"],
    "artistic": ["artistic licen[sc]e(?: 2 0)?"],
    "bsd": ["bsd licen[sc]e", "berkeley software distribution"],
    "bsd-2-clause": ["bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd licen[sc]e"],
    "bsd-3-clause": ["bsd 3 clause", "3 clause bsd", "modified bsd", "new bsd"],
    "bsl": ["boost software licen[sc]e", "bsl 1 0"],
    "busl": ["business source licen[sc]e", "busl 1 1"],
    "cc-by": ["cc by", "creative commons attribution"],
    "cc-by-nc": ["cc by nc", "creative commons attribution noncommercial"],
    "cc-by-nc-nd": ["cc by nc nd", "creative commons attribution noncommercial noderivatives"],
    "cc-by-nc-sa": ["cc by nc sa", "creative commons attribution noncommercial sharealike"],
    "cc-by-nd": ["cc by nd", "creative commons attribution noderivatives"],
    "cc-by-sa": ["cc by sa", "creative commons attribution sharealike"],
    "cc0": ["cc0(?: 1 0)?", "creative commons zero"],
    "cddl": ["common development and distribution licen[sc]e", "cddl 1 [01]"],
    "cecill": ["cecill (?:b |c )?licen[sc]e", "cecill 2 1"],
    "epl": ["eclipse public licen[sc]e", "epl [12] 0"],
    "eupl": ["european union public licen[sc]e", "eupl 1 [12]"],
    "gfdl": ["gnu free documentation licen[sc]e", "gfdl 1 [123]"],
    "gpl": ["gnu general public licen[sc]e", "gnu gpl", "gpl"],
    "gpl-2.0": ["gnu general public licen[sc]e (?:version |v ?)2", "gpl ?v? ?2(?: 0)?"],
    "gpl-3.0": ["gnu general public licen[sc]e (?:version |v ?)3", "gpl ?v? ?3(?: 0)?"],
    "isc": ["isc licen[sc]e"],
    "lgpl": ["gnu lesser general public licen[sc]e", "gnu library general public licen[sc]e", "gnu lgpl", "lgpl"],
    "lgpl-2.1": ["gnu lesser general public licen[sc]e (?:version |v ?)2 1", "lgpl ?v? ?2 1"],
    "lgpl-3.0": ["gnu lesser general public licen[sc]e (?:version |v ?)3", "lgpl ?v? ?3(?: 0)?"],
    "mit": ["mit licen[sc]e", "expat licen[sc]e", "x11 licen[sc]e"],
    "mpl": ["mozilla public licen[sc]e", "mpl"],
    "mpl-2.0": ["mozilla public licen[sc]e (?:version |v ?)?2 0", "mpl 2 0"],
    "ms-pl": ["microsoft public licen[sc]e", "ms pl"],
    "odbl": ["open database licen[sc]e", "odbl 1 0"],
    "ofl": ["sil open font licen[sc]e", "ofl 1 1"],
    "openssl": ["openssl licen[sc]e"],
    "php": ["php licen[sc]e"],
    "psf": ["python software foundation licen[sc]e", "psf licen[sc]e"],
    "sspl": ["server side public licen[sc]e", "sspl 1 0"],
    "unlicense": ["the unlicense", "unlicense org"],
    "upl": ["universal permissive licen[sc]e"],
    "wtfpl": ["wtfpl", "do what the fuck you want to public licen[sc]e"],
    "zlib": ["zlib licen[sc]e", "zlib libpng licen[sc]e"],
    "zpl": ["zope public licen[sc]e"],
}
# Priority (smaller is better), confidence, and the words around a name.
FORMS = [
    (1, 1.0, "spdx license identifier {}(?: only| or later)?"),
    (2, 0.95, "(?:is |are )?(?:licensed|released|distributed|available|published) under (?:the terms of )?(?:the |an? )?{}(?: licen[sc]e)?"),
    (2, 0.95, "(?:subject to|under|see) the (?:terms of the )?{}(?: licen[sc]e)?"),
    (3, 0.8, "licen[sc]e {}"),
    (4, 0.6, "{}"),
]
# Label, priority, confidence and whole expressions that name no license of the list.
NOTICES = [
    ("all-rights-reserved", 2, 0.9, "(?:c |copyright )?all rights reserved"),
    ("copyright", 5, 0.4, "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("mit", 1, 1.0, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 1, 1.0, "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 1, 1.0, "redistribution and use in source and binary forms with or without modification"),
    ("zlib", 1, 1.0, "this software is provided as is without any express or implied warranty in no event"),
    ("public-domain", 2, 0.9, "(?:dedicated to|placed in|released into|in) the public domain"),
    ("proprietary", 2, 0.9, "proprietary and confidential"),
    ("proprietary", 2, 0.9, "confidential and proprietary"),
    ("proprietary", 2, 0.9, "unauthorized copying of this file"),
]
# Names of further licenses.
MORE_NAMES = {
    "0bsd": ["0bsd", "zero clause bsd", "bsd zero clause licen[sc]e"],
    "afl": ["academic free licen[sc]e", "afl [123] [01]"],
    "apsl": ["apple public source licen[sc]e", "apsl [12] 0"],
    "beerware": ["the beer ?ware licen[sc]e"],
    "blueoak": ["blue oak model licen[sc]e", "blueoak 1 0 0"],
    "bsd-4-clause": ["bsd 4 clause", "4 clause bsd", "original bsd licen[sc]e"],
    "bzip2": ["bzip2 licen[sc]e"],
    "cern-ohl": ["cern open hardware licen[sc]e", "cern ohl [spw] 2 0"],
    "commons-clause": ["commons clause"],
    "cpal": ["common public attribution licen[sc]e", "cpal 1 0"],
    "cpl": ["common public licen[sc]e", "cpl 1 0"],
    "curl": ["curl licen[sc]e"],
    "ecl": ["educational community licen[sc]e", "ecl 2 0"],
    "elastic": ["elastic licen[sc]e(?: 2 0)?"],
    "eudatagrid": ["eu datagrid software licen[sc]e"],
    "ftl": ["freetype (?:project )?licen[sc]e"],
    "hpnd": ["historical permission notice and disclaimer", "hpnd"],
    "ibm-pl": ["ibm public licen[sc]e", "ipl 1 0"],
    "icu": ["icu licen[sc]e"],
    "ijg": ["independent jpeg group licen[sc]e"],
    "imagemagick": ["imagemagick licen[sc]e"],
    "info-zip": ["info zip licen[sc]e"],
    "json": ["json licen[sc]e"],
    "libpng": ["libpng licen[sc]e", "png reference library version 2"],
    "libtiff": ["libtiff licen[sc]e"],
    "lppl": ["latex project public licen[sc]e", "lppl 1 3c?"],
    "mit-0": ["mit no attribution", "mit 0"],
    "ms-rl": ["microsoft reciprocal licen[sc]e", "ms rl"],
    "mulan": ["mulan permissive software licen[sc]e", "mulanpsl [12] 0"],
    "ncsa": ["university of illinois ncsa open source licen[sc]e", "ncsa licen[sc]e"],
    "npl": ["netscape public licen[sc]e", "npl 1 [01]"],
    "odc-by": ["open data commons attribution licen[sc]e", "odc by 1 0"],
    "oldap": ["openldap public licen[sc]e", "oldap 2 8"],
    "osl": ["open software licen[sc]e(?: v ?3 0)?", "osl 3 0"],
    "pddl": ["public domain dedication and licen[sc]e", "pddl 1 0"],
    "polyform": ["polyform (?:noncommercial|strict|shield|small business|free trial) licen[sc]e"],
    "postgresql": ["postgresql licen[sc]e"],
    "prosperity": ["prosperity public licen[sc]e"],
    "qpl": ["q public licen[sc]e", "qpl 1 0"],
    "rpl": ["reciprocal public licen[sc]e", "rpl 1 5"],
    "rpsl": ["realnetworks public source licen[sc]e"],
    "ruby": ["ruby licen[sc]e"],
    "sgi-b": ["sgi free software licen[sc]e b"],
    "sissl": ["sun industry standards source licen[sc]e", "sissl"],
    "sleepycat": ["sleepycat licen[sc]e"],
    "tcl": ["tcl tk licen[sc]e", "tcl licen[sc]e"],
    "unicode": ["unicode licen[sc]e(?: v ?3)?", "unicode dfs 2016"],
    "vim": ["vim licen[sc]e"],
    "w3c": ["w3c software (?:notice and )?licen[sc]e"],
    "watcom": ["sybase open watcom public licen[sc]e"],
    "x11": ["x consortium licen[sc]e"],
}
# Standard headers: what a file says that is under a license. Label, whole expression.
HEADERS = [
    ("gpl-1.0-or-later", "gnu general public license as published by the free software foundation either version 1"),
    ("gpl-2.0-or-later", "gnu general public license as published by the free software foundation either version 2"),
    ("gpl-3.0-or-later", "gnu general public license as published by the free software foundation either version 3"),
    ("gpl-2.0-only", "gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3.0-only", "gnu general public license version 3 as published by the free software foundation"),
    ("gpl-2.0-only", "gnu general public license as published by the free software foundation version 2"),
    ("lgpl-2.0-or-later", "gnu library general public license as published by the free software foundation either version 2"),
    ("lgpl-2.1-or-later", "gnu lesser general public license as published by the free software foundation either version 2 1"),
    ("lgpl-3.0-or-later", "gnu lesser general public license as published by the free software foundation either version 3"),
    ("lgpl-2.1-only", "gnu lesser general public license version 2 1 as published by the free software foundation"),
    ("lgpl-3.0-only", "gnu lesser general public license version 3 as published by the free software foundation"),
    ("agpl-3.0-or-later", "gnu affero general public license as published by the free software foundation either version 3"),
    ("agpl-3.0-only", "gnu affero general public license version 3 as published by the free software foundation"),
    ("agpl-3.0", "gnu affero general public licen[sc]e (?:version |v ?)3"),
    ("agpl-3.0", "gnu agpl ?v? ?3"),
    ("gpl-2.0", "gnu gpl (?:version |v ?)2"),
    ("gpl-3.0", "gnu gpl (?:version |v ?)3"),
    ("lgpl-2.1", "gnu lgpl (?:version |v ?)2 1"),
    ("lgpl-3.0", "gnu lgpl (?:version |v ?)3"),
    ("lgpl-2.0", "gnu library general public licen[sc]e (?:version |v ?)2(?: 0)?"),
    ("gfdl-1.2", "gnu free documentation licen[sc]e version 1 2"),
    ("gfdl-1.3", "gnu free documentation licen[sc]e version 1 3"),
    ("gpl-classpath", "as a special exception the copyright holders of this library give you permission to link"),
    ("gpl-gcc-exception", "under section 7 of gpl version 3 you are granted additional permissions described in the gcc runtime library exception"),
    ("gpl-autoconf-exception", "if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("gpl-bison-exception", "you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-or-later", "or at your option any later version"),
    ("gpl", "you should have received a copy of the gnu general public licen[sc]e"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e"),
    ("agpl", "you should have received a copy of the gnu affero general public licen[sc]e"),
    ("gpl", "may be distributed under the terms of the gnu general public licen[sc]e"),
    ("apache-2.0", "licensed under the apache licen[sc]e version 2 0 the licen[sc]e"),
    ("apache-2.0", "you may not use this file except in compliance with the licen[sc]e you may obtain a copy of the licen[sc]e at http s? ?www apache org licenses licen[sc]e 2 0"),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements"),
    ("apache-2.0", "www apache org licenses licen[sc]e 2 0"),
    ("apache-1.1", "this product includes software developed by the apache software foundation"),
    ("apache-1.0", "this product includes software developed by the apache group for use in the apache http server project"),
    ("mit", "opensource org licenses mit"),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "opensource org licenses bsd 3 clause"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("mpl-1.0", "the contents of this file are subject to the mozilla public licen[sc]e version 1 0"),
    ("mpl-2.0", "mozilla org mpl 2 0"),
    ("npl", "the contents of this file are subject to the netscape public licen[sc]e"),
    ("epl-1.0", "made available under the terms of the eclipse public licen[sc]e v ?1 0"),
    ("epl-2.0", "made available under the terms of the eclipse public licen[sc]e (?:v ?)?2 0"),
    ("cpl", "made available under the terms of the common public licen[sc]e"),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("eupl-1.2", "licensed under the eupl (?:version )?1 2"),
    ("eupl-1.1", "licensed under the eupl version 1 1"),
    ("osl", "licensed under the open software licen[sc]e version [123] [01]"),
    ("afl", "licensed under the academic free licen[sc]e version [123] [01]"),
    ("bsl", "distributed under the boost software licen[sc]e version 1 0"),
    ("bsl", "www boost org licen[sc]e 1 0 txt"),
    ("ms-pl", "subject to the microsoft public licen[sc]e"),
    ("ecl", "licensed under the educational community licen[sc]e version 2 0"),
    ("upl", "licensed under the universal permissive licen[sc]e v 1 0"),
    ("mulan", "licensed under mulan psl v[12]"),
    ("elastic", "licensed under the elastic licen[sc]e"),
    ("sspl", "under the terms of the server side public licen[sc]e version 1"),
    ("busl", "use of this software is governed by the business source licen[sc]e"),
    ("lppl", "distributed and or modified under the conditions of the latex project public licen[sc]e"),
    ("lppl", "this work has the lppl maintenance status"),
    ("artistic", "under the same terms as perl itself"),
    ("ruby", "under the same terms as ruby"),
    ("python", "licensed to psf under a contributor agreement"),
    ("php", "this source file is subject to version [23] 0?1? ?of the php licen[sc]e"),
    ("zpl", "subject to the provisions of the zope public licen[sc]e"),
    ("qpl", "may be distributed under the terms of the q public licen[sc]e"),
    ("w3c", "distributed under the w3c r? ?software licen[sc]e"),
    ("ofl", "this font software is licensed under the sil open font licen[sc]e version 1 1"),
    ("cc0", "creativecommons org publicdomain zero 1 0"),
    ("cc0", "waived all copyright and related (?:or|and) neighboring rights"),
    ("public-domain", "creativecommons org publicdomain mark 1 0"),
    ("cc-by-1.0", "creativecommons org licenses by 1 0"),
    ("cc-by-2.0", "creativecommons org licenses by 2 0"),
    ("cc-by-2.5", "creativecommons org licenses by 2 5"),
    ("cc-by-3.0", "creativecommons org licenses by 3 0"),
    ("cc-by-4.0", "creativecommons org licenses by 4 0"),
    ("cc-by-sa-2.0", "creativecommons org licenses by sa 2 0"),
    ("cc-by-sa-2.5", "creativecommons org licenses by sa 2 5"),
    ("cc-by-sa-3.0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-sa-4.0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-3.0", "creativecommons org licenses by nc 3 0"),
    ("cc-by-nc-4.0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-3.0", "creativecommons org licenses by nd 3 0"),
    ("cc-by-nd-4.0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-3.0", "creativecommons org licenses by nc sa 3 0"),
    ("cc-by-nc-sa-4.0", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-3.0", "creativecommons org licenses by nc nd 3 0"),
    ("cc-by-nc-nd-4.0", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0 international"),
    ("cc-by-sa-4.0", "creative commons attribution share ?alike 4 0 international"),
    ("cc-by-nc-4.0", "creative commons attribution non ?commercial 4 0 international"),
    ("cc-by-nd-4.0", "creative commons attribution no ?derivatives 4 0 international"),
    ("cc-by-nc-sa-4.0", "creative commons attribution non ?commercial share ?alike 4 0 international"),
    ("cc-by-nc-nd-4.0", "creative commons attribution non ?commercial no ?derivatives 4 0 international"),
    ("cc-by-3.0", "creative commons attribution 3 0 unported"),
    ("cc-by-sa-3.0", "creative commons attribution share ?alike 3 0 unported"),
    ("gpl", "www gnu org licenses gpl"),
    ("lgpl", "www gnu org licenses lgpl"),
    ("agpl", "www gnu org licenses agpl"),
    ("gfdl", "www gnu org licenses fdl"),
    ("odbl", "opendatacommons org licenses odbl"),
    ("pddl", "opendatacommons org licenses pddl"),
    ("odc-by", "opendatacommons org licenses by 1 0"),
    ("unlicense", "for more information please refer to http s? ?unlicense org"),
]
# Openings and telling sentences of the full texts. Label, whole expression.
TEXTS = [
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("x11", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("json", "the software shall be used for good not evil"),
    ("bsd-2-clause", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3-clause", "neither the name of (?:the )?[a-z0-9 ]{1,60}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledg"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose (?:and without|without) fee is hereby granted provided that"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ncsa", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "the contributing authors and group 42 inc disclaim all warranties expressed or implied"),
    ("apache-2.0", "apache licen[sc]e version 2 0 january 2004"),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[sc]e to reproduce"),
    ("apache-2.0", "end of terms and conditions appendix how to apply the apache licen[sc]e to your work"),
    ("gpl-1.0", "gnu general public licen[sc]e version 1 february 1989"),
    ("gpl-2.0", "gnu general public licen[sc]e version 2 june 1991"),
    ("gpl-3.0", "gnu general public licen[sc]e version 3 29 june 2007"),
    ("lgpl-2.0", "gnu library general public licen[sc]e version 2 june 1991"),
    ("lgpl-2.1", "gnu lesser general public licen[sc]e version 2 1 february 1999"),
    ("lgpl-3.0", "gnu lesser general public licen[sc]e version 3 29 june 2007"),
    ("agpl-3.0", "gnu affero general public licen[sc]e version 3 19 november 2007"),
    ("gfdl-1.1", "gnu free documentation licen[sc]e version 1 1 march 2000"),
    ("gfdl-1.2", "gnu free documentation licen[sc]e version 1 2 november 2002"),
    ("gfdl-1.3", "gnu free documentation licen[sc]e version 1 3 3 november 2008"),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "the gnu general public licen[sc]e is a free copyleft licen[sc]e for software and other kinds of works"),
    ("agpl-3.0", "the gnu affero general public licen[sc]e is a free copyleft licen[sc]e for software and other kinds of works"),
    ("gpl-2.0", "this licen[sc]e applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms"),
    ("lgpl-2.1", "this is the first released version of the lesser gpl it also counts as the successor of the gnu library public licen[sc]e"),
    ("mpl-1.1", "mozilla public licen[sc]e version 1 1 1 definitions"),
    ("mpl-2.0", "mozilla public licen[sc]e version 2 0 1 definitions"),
    ("mpl-2.0", "exhibit a source code form licen[sc]e notice"),
    ("epl-1.0", "the accompanying program is provided under the terms of this eclipse public licen[sc]e agreement"),
    ("epl-2.0", "eclipse public licen[sc]e v ?2 0 the accompanying program is provided"),
    ("cpl", "the accompanying program is provided under the terms of this common public licen[sc]e"),
    ("ibm-pl", "the accompanying program is provided under the terms of this ibm public licen[sc]e"),
    ("cddl-1.0", "common development and distribution licen[sc]e cddl version 1 0"),
    ("cddl-1.1", "common development and distribution licen[sc]e cddl version 1 1"),
    ("eupl-1.2", "european union public licen[sc]e v 1 2"),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", "the artistic licen[sc]e 2 0 copyright c 2000 2006 the perl foundation"),
    ("bsl", "boost software licen[sc]e version 1 0 august 17th 2003"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e"),
    ("ms-pl", "this licen[sc]e governs use of the accompanying software if you use the software you accept this licen[sc]e"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document and changing it is allowed as long as the name is changed"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("cc0", "creative commons legal code cc0 1 0 universal"),
    ("cc-by", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution"),
    ("ofl", "sil open font licen[sc]e version 1 1 26 february 2007"),
    ("ofl", "the goals of the open font licen[sc]e ofl are to stimulate worldwide development of collaborative font projects"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "this product includes cryptographic software written by eric young"),
    ("php", "this product includes php software freely available from"),
    ("psf", "psf is making python available to licensee on an as is basis"),
    ("python", "python software foundation licen[sc]e version 2"),
    ("cnri-python", "cnri is making python 1 6 available to licensee on an as is basis"),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction"),
    ("tcl", "this software is copyrighted by the regents of the university of california sun microsystems inc"),
    ("unicode", "unicode inc licen[sc]e agreement data files and software"),
    ("w3c", "by obtaining using and or copying this work you the licensee agree that you have read understood and will comply"),
    ("vim", "there are no restrictions on distributing unmodified copies of vim"),
    ("sleepycat", "redistributions in any form must be accompanied by information on how to obtain complete source code for the db software"),
    ("ijg", "this software is based in part on the work of the independent jpeg group"),
    ("ftl", "portions of this software are copyright c? ?[0-9a-z ]{1,20}? the freetype project"),
    ("icu", "icu licen[sc]e icu 1 8 1 and later"),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is without warranty of any kind"),
    ("bzip2", "this program bzip2 the associated library libbzip2 and all documentation are copyright"),
    ("info-zip", "this software is provided as is without warranty of any kind express or implied in no event shall info zip"),
    ("libtiff", "the names of sam leffler and silicon graphics may not be used in any advertising"),
    ("sgi-b", "the above copyright notice including the dates of first publication and either this permission notice or a reference to"),
    ("imagemagick", "this licen[sc]e applies to imagemagick and any portion of it"),
    ("blueoak", "this licen[sc]e gives everyone as much permission to work with this software as possible while protecting contributors from liability"),
    ("upl", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("ecl", "educational community licen[sc]e version 2 0 ecl 2 0 april 2007"),
    ("osl", "this open software licen[sc]e the licen[sc]e applies to any original work of authorship"),
    ("afl", "this academic free licen[sc]e the licen[sc]e applies to any original work of authorship"),
    ("elastic", "you may not provide the software to third parties as a hosted or managed service"),
    ("sspl", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("commons-clause", "the grant of rights under the licen[sc]e will not include and the licen[sc]e does not grant to you the right to sell the software"),
    ("polyform", "use by any charitable organization educational institution public research organization"),
    ("odbl", "open database licen[sc]e odbl v1 0"),
    ("pddl", "the open data commons public domain dedication and licen[sc]e"),
    ("mulan", "mulan permissive software licen[sc]e version [12]"),
    ("lppl", "the latex project public licen[sc]e lppl version 1 3c?"),
    ("apsl", "apple public source licen[sc]e ver 2 0"),
    ("qpl", "the q public licen[sc]e version 1 0"),
    ("cern-ohl", "cern open hardware licen[sc]e version 2"),
    ("oldap", "the openldap public licen[sc]e version 2 8"),
    ("public-domain", "this (?:file|work|software|code) (?:is|has been) (?:hereby )?(?:placed )?in the public domain"),
    ("public-domain", "the author disclaims copyright to this source code"),
    ("public-domain", "no copyright is claimed"),
    ("public-domain", "works of the united states government are not subject to copyright"),
    ("proprietary", "this software is the confidential and proprietary information of"),
    ("proprietary", "no part of this (?:publication|document|software|work) may be reproduced"),
    ("proprietary", "without the (?:express|prior) written (?:permission|consent) of"),
    ("proprietary", "reproduction in whole or in part without permission is prohibited"),
    ("proprietary", "internal use only"),
    ("proprietary", "trade secret"),
    ("eula", "end user licen[sc]e agreement"),
    ("eula", "by installing or using the software you agree to be bound"),
    ("eula", "do not install or use the software if you do not agree"),
    ("non-commercial", "for non ?commercial (?:use|purposes) only"),
    ("non-commercial", "may not be used for commercial purposes"),
    ("research-only", "for (?:academic|research) (?:use|purposes) only"),
    ("research-only", "for non commercial research purposes"),
    ("copyright", "copyright c? ?(?:19|20)[0-9][0-9] [a-z0-9 ]{1,60}? all rights reserved"),
]
_SEPARATORS = bytes(b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))
_TO_SPACE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_OPTIONAL = re.compile(r"\(\?:[^()]*\)\??|\[[^\]]*\](?:\{[^}]*\})?\??|.\?")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    pattern: re.Pattern[bytes]
    keyword: bytes


def keyword(name: str) -> bytes:
    """The longest run of plain text that every match of ``name`` holds."""
    return max(_OPTIONAL.sub("\n", name).split("\n"), key=len).encode()


# Priority and confidence of a whole text's sentence and of a header; both are better than a name.
TEXT, HEADER = (0, 1.0), (1, 0.98)


def signatures() -> list[tuple[str, int, float, str]]:
    """All expressions written by hand that stand for themselves: label, priority, confidence, expression."""
    found = [(label, *TEXT, text) for label, text in TEXTS]
    found += [(label, *HEADER, header) for label, header in HEADERS]
    return found + NOTICES


@functools.lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """In order: by priority, then as listed."""
    found = []
    for label, names in (NAMES | MORE_NAMES).items():
        for name in names:
            for priority, confidence, form in FORMS:
                pattern = re.compile(f"(?<= ){form.format(f'(?:{name})')}(?= )".encode())
                found.append(Rule(label, priority, confidence, pattern, keyword(name)))
    for label, priority, confidence, whole in signatures():
        found.append(Rule(label, priority, confidence, re.compile(f"(?<= ){whole}(?= )".encode()), keyword(whole)))
    return tuple(sorted(found, key=lambda r: r.priority))


@functools.lru_cache(maxsize=1)
def by_keyword() -> dict[bytes, tuple[Rule, ...]]:
    words: dict[bytes, list[Rule]] = {}
    for rule in rules():
        words.setdefault(rule.keyword, []).append(rule)
    return {word: tuple(gated) for word, gated in words.items()}


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters outside ASCII, with A-Z in lower case."""
    return text.lower().translate(_TO_SPACE).split()


def places(joined: bytes, phrase: bytes) -> list[int]:
    """First words of all places of ``phrase``; ``joined`` has a space on both sides of each word."""
    found, at, seen, word = [], joined.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        word += joined.count(b" ", seen, at)
        seen = at
        found.append(word)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return found


def detections(joined: bytes) -> list[tuple[int, int, Rule]]:
    """(first byte, end, rule) of what is left after suppression, in order of place."""
    found = []
    for word, gated in by_keyword().items():
        if word in joined:
            for rule in gated:
                found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(joined)]
    kept: list[tuple[int, int, Rule]] = []
    for kind in sorted({d[2].priority for d in found}):
        kept = _without_contained(kept, [d for d in found if d[2].priority == kind])
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].label))


def _without_contained(better: list, new: list) -> list:
    """``better`` and the intervals of ``new`` that lie in none of them and in none of ``new``.

    Of equal new intervals, the first in the order of labels stays.
    """
    marked = [(d, 0) for d in better] + [(d, 1) for d in new]
    marked.sort(key=lambda m: (m[0][0], -m[0][1], m[1], m[0][2].label))
    reach, kept = -1, []
    for d, fresh in marked:
        if not fresh or d[1] > reach:
            kept.append(d)
        reach = max(reach, d[1])
    return kept


def scan(text: bytes) -> tuple:
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    base = {p: f for p in BASE if (f := places(joined, p.encode()))}
    starts = [i for f in base.values() for i in f]
    labels = {BASE[p] for p in base}
    spans = detections(joined)
    spotted = [
        (joined.count(b" ", 0, a) - 1, joined.count(b" ", 0, b), rule.label, rule.priority) for a, b, rule in spans
    ]
    score = max([rule.confidence for _, _, rule in spans] + [0.6] * bool(base), default=0.0)
    every = labels | {rule.label for _, _, rule in spans}
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(every)),
        score,
        [{"first": a, "end": b, "label": label, "priority": p} for a, b, label, p in spotted],
    )


_SPANS = pa.list_(pa.struct({"first": pa.int64(), "end": pa.int64(), "label": pa.string(), "priority": pa.int64()}))
_FIELDS = {
    "n_words": ("bigint", pa.int64()),
    "n_base": ("bigint", pa.int64()),
    "first_word": ("bigint", pa.int64()),
    "last_word": ("bigint", pa.int64()),
    "base_labels": ("string", pa.string()),
    "labels": ("string", pa.string()),
    "score": ("double", pa.float64()),
    "spans": ("array<struct<first:bigint,end:bigint,label:string,priority:bigint>>", _SPANS),
}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scan(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
        columns = zip(*rows) if rows else [[] for _ in _FIELDS]
        arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS.values(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *_FIELDS])


def license_scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What each whole text says about licenses.

    ``n_words``; ``n_base`` places of the ``BASE`` phrases with their smallest and largest first
    word (null without one) and ``base_labels``; ``labels`` also of the rules, both distinct,
    sorted and joined by commas; ``score``, the confidence of the best detection, 0 without one;
    ``spans`` of words of the rules' detections after suppression. A null text is an empty one. One
    row per row, repeated and null identifiers included; an empty table gives no rows; other columns
    are ignored.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = ", ".join([f"id {kind}", *(f"{n} {t}" for n, (t, _) in _FIELDS.items())])
    return rows.mapInArrow(_scan, schema).withColumnRenamed("id", id)
