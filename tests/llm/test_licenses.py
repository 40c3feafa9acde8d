import pytest
from helpers import docs_frame, same_rows

from tslake.llm import licenses

TEXTS = [
    None,
    "",
    "...",
    "Released under the MIT License. All rights reserved.",
    "CC BY, cc-by and Cc/By again",
    "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public license without its version",
    "the license of mit is not named, all rights are reserved, reserved all rights",
    "MITé License and ÀLL rights reserved",
    "word " * 30000 + "released under the mit license " + "tail " * 10000,
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "permission is hereby granted free of charge to some person obtaining a copy of this software",
    "cc by cc by cc by 4 0",
    "released under CC0 1.0",
    "# SPDX-License-Identifier: GPL-2.0-or-later\nimport os",
    "Boost Software License - Version 1.0\nsee MPL-2.0, SPDX License Identifier mit",
    "This program is free software; you can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "Apache License 2.0 " * 3 + "in compliance with the License, CC0 1, CC0 1.0",
] + ["plain words here"] * 20


def test_against_sql(spark):
    df, arrow = docs_frame(spark, TEXTS)
    same_rows(licenses.report(df), licenses.SQL, documents=arrow)


def test_labels(spark):
    df, _ = docs_frame(spark, TEXTS)
    got = {r.doc_id: r for r in licenses.report(df).collect()}
    assert got[3].labels == "mit,reserved" and got[3].base_labels == "reserved"
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (3, 0, 5)
    assert got[5].labels == "apache-2.0,cc-by,cc-by-nc-4.0"
    assert got[6].labels == "gpl,gpl-3.0" and got[7].labels == "gpl"
    assert got[8].labels == "" and got[8].score == 0.0
    assert got[11].labels == "mit" and got[12].labels == ""
    assert got[0].n_words == 0 and got[0].first_word is None
    assert got[14].labels == "cc0-1.0" and 0 < got[14].score < 1
    assert got[15].labels == "gpl-2.0" and got[16].labels == "bsl-1.0,mit"
    assert got[17].labels == "gpl,gpl-2.0" and got[18].labels == "apache-2.0,cc0-1.0"


def test_a_phrase_decides_whatever_words_are_rare(spark):
    """In a corpus where a notice's own words are frequent, each mandatory phrase still labels its text."""
    texts = [" ".join(p.split()[0] for p in t.phrases) + " " + t.text for t in licenses.TEMPLATES]
    texts += [" and ".join(t.phrases) for t in licenses.TEMPLATES if len(t.phrases) == 1]
    texts += ["licensed license version 2 0 public gnu general under the of and software"] * 40
    df, arrow = docs_frame(spark, texts)
    got = {r.doc_id: r for r in licenses.report(df).collect()}
    for i, t in enumerate([*licenses.TEMPLATES, *(t for t in licenses.TEMPLATES if len(t.phrases) == 1)]):
        assert t.label in got[i].labels.split(","), (t, got[i])
    same_rows(licenses.report(df), licenses.SQL, documents=arrow)


def test_keeps_columns_and_empty(spark):
    df, _ = docs_frame(spark, TEXTS[:3])
    assert licenses.scan(df).columns == [*df.columns, "_license"]
    assert licenses.report(df.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_table(spark, sf):
    import pyarrow.parquet as pq

    same_rows(licenses.report(spark.read.parquet(f"{sf}/documents.parquet")), licenses.SQL, documents=pq.read_table(f"{sf}/documents.parquet"))
