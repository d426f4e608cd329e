import re

from articlelake.llm import licence_rules as lr
from tests.llm.fixtures import documents


def scan(spark, *texts):
    rows = lr.scan(documents(spark, enumerate(texts), "licences", "other")).orderBy("doc_id").collect()
    assert all(r.other == 7 for r in rows)
    return [r.licences for r in rows]


BSD = """Copyright (c) 2020 Somebody.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to
   endorse or promote products derived from this software without specific prior written permission.
"""


def test_rules(spark):
    assert scan(
        spark, "x.\nReleased under the MIT License.\ny", "Licensed under CC BY-NC 4.0.", BSD, BSD + NAMES, NAMES + BSD,
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\n"
        "You may obtain a copy of the License at http://x",
        "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.",
        "### junk&&&\nReleased under the MIT License.", "we talk about licences and permission", "", None,
        "a licen\n" + "word " * 200_000 + ".\nReleased under the MIT License.",
    ) == [["MIT"], ["CC-BY-NC-4.0"], ["BSD-2-Clause"], ["BSD-3-Clause"], ["BSD-2-Clause"], ["Apache-2.0"],
          ["CC-BY-NC-4.0", "GPL-3.0-only"], ["MIT"], [], [], [], ["MIT"]]


def test_empty_table(spark):
    assert lr.scan(documents(spark, [])).count() == 0


def test_every_sentence_is_normalised_and_triggers(spark):
    rows = spark.createDataFrame([(s,) for s in lr.SENTENCES], "s string")
    assert all(r[0] == r[1] for r in rows.select("s", lr.normalised(rows.s)).collect())
    assert all(any(word in s for word in lr.TRIGGERS) for s in [*lr.SENTENCES, *lr.OPENINGS])
    assert {name for _, _, ids in lr.RULES for name in ids} <= set(lr.SENTENCES.values())


def test_whole_table_against_plain_search(spark):
    """In this table licence lines stand alone, so searching for the lines must find the same."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    rows = lr.scan(docs).collect()
    for row in rows:
        assert row.licences == sorted({name for line, name in lines.items() if re.search(r"(^|\n|[.!?;:]\s)" + re.escape(line), row.text)})
    assert any(row.licences for row in rows)


def test_sentences_of_any_length(spark):
    """A copyright line counts whatever follows, and marks and blanks around a known sentence do not."""
    texts = ["Copyright (c) 2020 " + "holder " * 2000, "Released under" + " " * 5000 + "the MIT License",
             "*" * 10_000 + " Licensed under CC BY 4.0 " + "=" * 10_000, "licence " + "word " * 2000]
    rows = lr.scan(documents(spark, enumerate(texts))).orderBy("doc_id").collect()
    assert [r.sentence_ids for r in rows] == [["COPYRIGHT"], ["MIT-NAME"], ["CC-BY4"], []]
    assert [r.licences for r in rows] == [[], ["MIT"], ["CC-BY-4.0"], []]
