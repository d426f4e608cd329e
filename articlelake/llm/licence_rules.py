"""Licence scan by sentences: known sentences get identifiers, rules are ordered sequences of them.

All of it is built-in expressions on one row; nothing is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised as by ``normalised``.
SENTENCES = {
    "released under the mit license": "MIT-NAME",
    "licensed under the mit license": "MIT-NAME",
    "mit license": "MIT-NAME",
    "the mit license": "MIT-NAME",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT-GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT-NOTICE",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT-WARRANTY",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC-GRANT",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD-GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD-SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD-BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD-NAMES",
    "licensed under the apache license version 2.0": "APACHE2-NAME",
    "licensed under the apache license version 2.0 the license": "APACHE2-NAME",
    "apache license version 2.0": "APACHE2-NAME",
    "you may not use this file except in compliance with the license": "APACHE2-COMPLY",
    "you may obtain a copy of the license at": "APACHE2-COPY",
    "this work is licensed under the gnu general public license version 3": "GPL3-NAME",
    "licensed under the gnu general public license version 3": "GPL3-NAME",
    "licensed under the gnu general public license version 2": "GPL2-NAME",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3-LATER",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2-LATER",
    "you should have received a copy of the gnu general public license along with this program": "GPL-COPY",
    "licensed under the gnu lesser general public license version 3": "LGPL3-NAME",
    "licensed under the gnu affero general public license version 3": "AGPL3-NAME",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2-NAME",
    "licensed under cc by 4.0": "CC-BY4",
    "licensed under cc by sa 4.0": "CC-BY-SA4",
    "licensed under cc by nc 4.0": "CC-BY-NC4",
    "licensed under cc by nd 4.0": "CC-BY-ND4",
    "this work is licensed under a creative commons attribution 4.0 international license": "CC-BY4",
    "this is free and unencumbered software released into the public domain": "UNLICENSE",
}
# A sentence that starts so has the identifier, whatever follows.
OPENINGS = {"copyright c ": "COPYRIGHT", "copyright 1": "COPYRIGHT", "copyright 2": "COPYRIGHT"}
# Licence, and the identifiers that must come in this order; of one family the first rule that matches counts.
RULES = (
    ("mit", "MIT", ("MIT-GRANT", "MIT-NOTICE", "MIT-WARRANTY")),
    ("mit", "MIT", ("MIT-GRANT", "MIT-NOTICE")),
    ("mit", "MIT", ("MIT-NAME",)),
    ("isc", "ISC", ("ISC-GRANT",)),
    ("bsd", "BSD-3-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-NAMES")),
    ("bsd", "BSD-2-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY")),
    ("bsd", "BSD-1-Clause", ("BSD-GRANT", "BSD-SOURCE")),
    ("apache", "Apache-2.0", ("APACHE2-NAME", "APACHE2-COMPLY", "APACHE2-COPY")),
    ("apache", "Apache-2.0", ("APACHE2-NAME",)),
    ("apache", "Apache-2.0", ("APACHE2-COMPLY", "APACHE2-COPY")),
    ("gpl", "GPL-3.0-or-later", ("GPL3-LATER",)),
    ("gpl", "GPL-2.0-or-later", ("GPL2-LATER",)),
    ("gpl", "GPL-3.0-only", ("GPL3-NAME",)),
    ("gpl", "GPL-2.0-only", ("GPL2-NAME",)),
    ("gpl", "GPL-1.0-or-later", ("GPL-COPY",)),
    ("lgpl", "LGPL-3.0-only", ("LGPL3-NAME",)),
    ("agpl", "AGPL-3.0-only", ("AGPL3-NAME",)),
    ("mpl", "MPL-2.0", ("MPL2-NAME",)),
    ("cc", "CC-BY-4.0", ("CC-BY4",)),
    ("ccsa", "CC-BY-SA-4.0", ("CC-BY-SA4",)),
    ("ccnc", "CC-BY-NC-4.0", ("CC-BY-NC4",)),
    ("ccnd", "CC-BY-ND-4.0", ("CC-BY-ND4",)),
    ("unlicense", "Unlicense", ("UNLICENSE",)),
)
# Every known sentence holds one of these; a text without any is not cut into sentences.
TRIGGERS = ("licen", "permi", "redistribut", "copyright", "public domain", "warrant")


def normalised(sentence: Column) -> Column:
    """Lower case; only letters, digits and points inside numbers; no comment or list marks in front."""
    plain = F.regexp_replace(F.lower(sentence), r"(?<![0-9])\.|\.(?![0-9])|[^a-z0-9.]+", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(plain, " +", " ")), r"^[0-9]{1,2} (?=[a-z])", "")


def _identifier(sentence: Column) -> Column:
    known = F.create_map(*[F.lit(part) for item in SENTENCES.items() for part in item])
    found = known[sentence]
    for opening, name in OPENINGS.items():
        found = F.coalesce(found, F.when(sentence.startswith(opening), name))
    return found


def sentence_ids(text: str = "text") -> Column:
    """Identifiers of the known sentences of the whole text, in order.

    Sentences end at . ! ? ; : before white space, and at empty lines.  One that
    runs over several lines is looked up as a whole and line by line, however long it is.
    """
    lower = F.lower(F.col(text))
    triggered = F.lit(False)
    for word in TRIGGERS:
        triggered |= lower.contains(word)
    sentences = F.split(F.col(text), r"(?<=[.!?;:])\s+|\n\s*\n")
    forms = F.flatten(F.transform(sentences, lambda s: F.when(
        s.contains("\n"), F.concat(F.array(s), F.split(s, "\n"))).otherwise(F.array(s))))
    ids = F.transform(forms, lambda s: _identifier(normalised(s)))
    empty = F.array().cast("array<string>")
    return F.when(triggered, F.filter(ids, lambda name: name.isNotNull())).otherwise(empty)


def licences(ids: Column) -> Column:
    """Names of the licences whose rule the identifiers match in order, with others between allowed."""
    row = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    families: dict[str, Column | None] = {}
    for family, name, sequence in RULES:
        pattern = " " + r" (?:\S+ )*?".join(sequence) + " "
        before = families.get(family)
        hit = F.when(row.rlike(pattern), F.lit(name))
        families[family] = hit if before is None else F.coalesce(before, hit)
    return F.array_sort(F.array_compact(F.array(*families.values())))


def scan(docs: DataFrame) -> DataFrame:
    """Add ``sentence_ids`` and ``licences`` (both lists, empty for null and empty texts) to each row.

    Other columns, repeated rows and rows without id stay as they are.
    """
    return docs.withColumn("sentence_ids", sentence_ids()).withColumn("licences", licences(F.col("sentence_ids")))
