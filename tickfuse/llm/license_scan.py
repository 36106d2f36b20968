"""Licence scans by sentence rules: normalised sentences become identifiers, identifier sequences match ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD  # noqa: F401  the word class of the contracts, for callers

# Licence sentences as published, with an identifier each (two letters or a letter and a digit, so that sequences
# read as text). A star stands for one to eight words.
SENTENCES = {
    "AP": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\")", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "This file is licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "AT": ["Apache License Version 2.0, January 2004"],
    "AU": ["you may not use this file except in compliance with the License.", "You may obtain a copy of the License at"],
    "AD": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "MI": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "The MIT License (MIT)", "The MIT License", "MIT License", "SPDX-License-Identifier: MIT"],
    "PG": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "PC": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "PW": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "GP": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GNU General Public License, version 3.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GF": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GW": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "G2": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "L2": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "L3": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "LW": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "A3": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "MF": ["This Source Code Form is subject to the terms of the Mozilla Public License, v.", "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "MO": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "BN": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "BY": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "BS": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "C0": ["CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"],
    "RS": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "RC": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "RB": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "RN": ["Neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "RD": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."],
    "B2": ["SPDX-License-Identifier: BSD-2-Clause"],
    "B3": ["SPDX-License-Identifier: BSD-3-Clause"],
    "IP": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "SPDX-License-Identifier: ISC"],
    "ZA": ["This software is provided 'as-is', without any express or implied warranty."],
    "ZP": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", "SPDX-License-Identifier: Zlib"],
    "UN": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "EP": ["Eclipse Public License - v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "SPDX-License-Identifier: EPL-2.0"],
    "BO": ["Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0 - August 17th, 2003", "SPDX-License-Identifier: BSL-1.0"],
}
# Ordered rules over the sequence of identifiers; an earlier rule's match is not seen by later ones.
RULES = [
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
#: Every sentence has one of these; texts without any are not split.
PROBE = "licen|permission|redistribut|copyright|warrant|unencumbered|cc0|mpl"


def plain(sentence: str) -> str:
    """The Python twin of marked(), for one sentence: ASCII lower case, other characters than a-z and 0-9 as single spaces."""
    import re

    ascii_lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in sentence)
    return re.sub("[^a-z0-9]+", " ", ascii_lower).strip(" ")


def known() -> dict[str, str]:
    """Normalised sentences with their identifiers; of those with a star, their patterns."""
    return {" ".join(map(plain, s.split("*"))) if "*" not in s else STAR.join(map(plain, s.split("*"))): k for k, own in SENTENCES.items() for s in own}


#: One to eight words, with the spaces around them.
STAR = " (?:[a-z0-9]+ ){1,8}"


def marked(text: Column) -> Column:
    """A whole text in ASCII lower case, other characters than a-z and 0-9 as single spaces, with its breaks kept: ; for a line end that a sentence may go over, | for the end of
    a sentence (white space after . ! ?) or a blank line, also one that has no letter or digit."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ|;", "abcdefghijklmnopqrstuvwxyz,,"
    out = F.regexp_replace(F.translate(text, upper, lower), r"[.!?][\x20\x09-\x0A\x0D]+", "|")
    out = F.regexp_replace(F.regexp_replace(out, "\n", ";"), "[^a-z0-9|;]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, " ?[|;](?: ?[|;])+ ?", "|"), " ?([|;]) ?", "$1"))


def sentences(text: Column) -> Column:
    """The known sentences of a text in order, normalised. Each begins and ends at a break, perhaps after the mark of a list,
    and may be wrapped over lines; where one begins, the longest counts."""
    longest = sorted(known(), key=lambda s: (-len(s), s))
    whole = "(?<![^|;])(?:(?:[0-9]{1,2}|[a-z])[ ;])?(" + "|".join(s.replace(" ", "[ ;]") for s in longest) + ")(?![^|;])"
    return F.transform(F.regexp_extract_all(marked(text), F.lit(whole), F.lit(1)), lambda s: F.translate(s, ";", " "))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, n_sentences (known ones), sentence_ids (in order, space between), licenses (rule
    names in rule order, comma between, empty if none).

    A sentence begins and ends at a line end or after . ! ? and white space, and may follow comment marks and the mark of a
    list; it may be wrapped over lines, but not over a blank one. A null or empty text has no sentence; texts are read whole,
    and a text must fit into a task. Rules run in order over the identifier sequence; what a rule has matched is replaced by a
    bar, so that no later rule joins the pieces around it, and of two rules that could take an identifier the earlier does.
    Repeated rows give repeated results; other columns are not looked at; an empty table gives an empty result. Only built-in
    functions: the sentence table is a literal of this module, so its size is fixed.
    """
    fixed = {s: k for s, k in known().items() if STAR not in s}
    ids = F.create_map(*[F.lit(x) for pair in fixed.items() for x in pair])

    def name(s: Column) -> Column:
        return F.coalesce(ids[s], *[F.when(s.rlike(f"^{p}$"), F.lit(k)) for p, k in known().items() if STAR in p])

    probe = F.lower(F.coalesce(F.col(text), F.lit(""))).rlike(PROBE)
    found = F.transform(sentences(F.col(text)), name)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.when(probe, found).otherwise(F.array().cast("array<string>")).alias("ids"))
    rows = rows.withColumn("sentence_ids", F.array_join("ids", " "))
    rest, names = F.col("sentence_ids"), []
    for rule, pattern in RULES:
        whole = rf"\b(?:{pattern})\b"
        names.append(F.when(rest.rlike(whole), F.lit(rule)))
        rest = F.regexp_replace(rest, whole, "|")
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_sentences"), "sentence_ids", F.concat_ws(",", *names).alias("licenses"))
