"""SQL for the licence scan, with sentences and rules written out anew, so that it checks those of the operator too."""

from __future__ import annotations

# Licence sentences in lower case, words of a-z and 0-9; a star is one to eight words.
PHRASES = [
    ("AP", "licensed under the apache license version 2 0"),
    ("AP", "licensed under the apache license version 2 0 the license"),
    ("AP", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("AP", "this file is licensed under the apache license version 2 0"),
    ("AP", "spdx license identifier apache 2 0"),
    ("AT", "apache license version 2 0 january 2004"),
    ("AU", "you may not use this file except in compliance with the license"),
    ("AU", "you may obtain a copy of the license at"),
    ("AD", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("MI", "released under the mit license"),
    ("MI", "licensed under the mit license"),
    ("MI", "this project is licensed under the mit license"),
    ("MI", "the mit license mit"),
    ("MI", "the mit license"),
    ("MI", "mit license"),
    ("MI", "spdx license identifier mit"),
    ("PG", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("PC", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("PW", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("GP", "this work is licensed under the gnu general public license version 3"),
    ("GP", "spdx license identifier gpl 3 0 only"),
    ("GP", "spdx license identifier gpl 3 0 or later"),
    ("GP", "licensed under the gnu general public license version 3"),
    ("GP", "gnu general public license version 3 29 june 2007"),
    ("GF", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("GW", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("G2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("G2", "gnu general public license version 2 june 1991"),
    ("G2", "spdx license identifier gpl 2 0 only"),
    ("G2", "spdx license identifier gpl 2 0 or later"),
    ("L2", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("L2", "gnu lesser general public license version 2 1 february 1999"),
    ("L2", "spdx license identifier lgpl 2 1 only"),
    ("L2", "spdx license identifier lgpl 2 1 or later"),
    ("L3", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("L3", "gnu lesser general public license version 3 29 june 2007"),
    ("L3", "spdx license identifier lgpl 3 0 only"),
    ("L3", "spdx license identifier lgpl 3 0 or later"),
    ("LW", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("A3", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("A3", "gnu affero general public license version 3 19 november 2007"),
    ("A3", "spdx license identifier agpl 3 0 only"),
    ("A3", "spdx license identifier agpl 3 0 or later"),
    ("MF", "this source code form is subject to the terms of the mozilla public license v"),
    ("MF", "mozilla public license version 2 0"),
    ("MF", "spdx license identifier mpl 2 0"),
    ("MO", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("MO", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("BN", "licensed under cc by nc 4 0"),
    ("BN", "this work is licensed under cc by nc 4 0"),
    ("BN", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("BN", "spdx license identifier cc by nc 4 0"),
    ("BY", "licensed under cc by 4 0"),
    ("BY", "this work is licensed under cc by 4 0"),
    ("BY", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("BY", "spdx license identifier cc by 4 0"),
    ("BS", "licensed under cc by sa 4 0"),
    ("BS", "this work is licensed under cc by sa 4 0"),
    ("BS", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("BS", "spdx license identifier cc by sa 4 0"),
    ("C0", "cc0 1 0 universal"),
    ("C0", "spdx license identifier cc0 1 0"),
    ("RS", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("RC", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("RB", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("RN", "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("RD", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("B2", "spdx license identifier bsd 2 clause"),
    ("B3", "spdx license identifier bsd 3 clause"),
    ("IP", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("IP", "spdx license identifier isc"),
    ("ZA", "this software is provided as is without any express or implied warranty"),
    ("ZP", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("ZP", "spdx license identifier zlib"),
    ("UN", "this is free and unencumbered software released into the public domain"),
    ("UN", "spdx license identifier unlicense"),
    ("EP", "eclipse public license v 2 0"),
    ("EP", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("EP", "spdx license identifier epl 2 0"),
    ("BO", "distributed under the boost software license version 1 0"),
    ("BO", "boost software license version 1 0 august 17th 2003"),
    ("BO", "spdx license identifier bsl 1 0"),
]
# Rules in order.
ORDER = [
    ("Apache-2.0", "AP( AU)*( AD)?|AU AU( AD)?|AT"),
    ("MIT", "MI( PG)?( PC)?( PW)?|PG( PC)?( PW)?"),
    ("AGPL-3.0", "A3( GW)?"),
    ("LGPL-2.1", "L2( LW)?"),
    ("LGPL-3.0", "L3( GW)?"),
    ("GPL-3.0", "GP( GF)?( GW)?|GF( GW)?"),
    ("GPL-2.0", "G2( GW)?"),
    ("MPL-2.0", "MF( MO)?|MO"),
    ("CC-BY-NC-4.0", "BN"),
    ("CC-BY-SA-4.0", "BS"),
    ("CC-BY-4.0", "BY"),
    ("CC0-1.0", "C0"),
    ("BSD-3-Clause", "RS RC RB RN( RD)?|B3"),
    ("BSD-2-Clause", "RS RC RB( RD)?|B2"),
    ("BSD-unknown", "RS( RC)?"),
    ("ISC", "IP"),
    ("Zlib", "(ZA )?ZP"),
    ("Unlicense", "UN"),
    ("EPL-2.0", "EP"),
    ("BSL-1.0", "BO"),
]


def scan_sql(docs: str = "documents") -> str:
    """doc_id, n_sentences, sentence_ids, licenses. Breaks are doubled, so that each sentence has one at either end for itself:
    ;; for a line end, || for the end of a sentence or a blank line."""
    star = "(?:[a-z0-9]+(?: |;;)){1,8}"
    longest = sorted(PHRASES, key=lambda p: (-len(p[1].replace("*", star)), p[1]))
    body = "|".join(p.replace(" * ", " *").replace(" ", "(?: |;;)").replace("*", star) for _, p in longest)
    text = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ|;', 'abcdefghijklmnopqrstuvwxyz,,')"
    for pattern, by in (("[.!?][\\x20\\x09\\x0A\\x0D]+", "|"), ("\\n", ";"), ("[^a-z0-9|;]+", " "), (" ?[|;](?: ?[|;])+ ?", "|"), (" ?([|;]) ?", "\\1\\1")):
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    pairs = ", ".join(f"'{p}': '{i}'" for i, p in PHRASES if "*" not in p)
    wild = " ".join(f"WHEN regexp_full_match(s, '{p.replace(' * ', ' (?:[a-z0-9]+ ){1,8}')}') THEN '{i}'" for i, p in PHRASES if "*" in p)
    rest, names = "sentence_ids", []
    for name, rule in ORDER:
        whole = rf"\b(?:{rule})\b"
        names.append(f"CASE WHEN regexp_matches({rest}, '{whole}') THEN '{name}' END")
        rest = f"regexp_replace({rest}, '{whole}', '|', 'g')"
    return f"""WITH k AS (SELECT MAP {{{pairs}}} AS m),
t AS (SELECT doc_id, regexp_extract_all('||' || trim({text}, ' ') || '||', '[|;](?:(?:[0-9]{{1,2}}|[a-z])(?: |;;))?({body})[|;]', 1) AS found FROM {docs}),
f AS (SELECT doc_id, list_transform(list_transform(found, lambda s: replace(s, ';;', ' ')), lambda s: CASE WHEN m[s] IS NOT NULL THEN m[s] {wild} END) AS ids FROM t, k),
j AS (SELECT doc_id, len(ids)::BIGINT AS n_sentences, coalesce(array_to_string(ids, ' '), '') AS sentence_ids FROM f)
SELECT doc_id, n_sentences, sentence_ids, concat_ws(',', {', '.join(names)}) AS licenses FROM j"""
