import pytest

from aerolith.llm import licences, registry

# The notices that the test tables contain.
PLANTED = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache",
}


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return licences.fit(licences.ordinary_sample(registry.table(spark, sf_dir, "documents")))


def test_every_template_is_told_from_the_others(model):
    for family, templates in licences.TEMPLATES.items():
        for template in templates:
            assert model.judge(template)[0] == family


def test_variants_unknown_notices_and_ordinary_sentences(model):
    assert model.judge("Note: this project is released under the MIT License, see below")[0] == "mit"
    assert model.judge("Licensed under the Foo License.")[0] == licences.UNKNOWN
    for sentence in (*licences.ORDINARY, "The weather is fine", "He has a license to fish", ""):
        assert model.judge(sentence) is None


def test_query_equals_planted_lines(spark, sf_dir):
    texts = {r.doc_id: r.text for r in registry.table(spark, sf_dir, "documents").collect()}
    rows = registry.op9_licence_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        lines = texts[row.doc_id].split("\n")
        found = [PLANTED[x] for x in lines if x in PLANTED]
        assert (row.n_notices, row.families) == (len(found), ",".join(sorted(set(found))))
        assert row.n_paragraphs == sum(bool(x.strip()) for x in lines)
        assert (row.best_probability is None) == (not found)


def test_spans_nulls_and_empty_tables(spark, model):
    line = "Released under the MIT License."
    docs = spark.createDataFrame([(1, f"a\n{line}\nb", 1), (None, None, 2), (2, "", 3), (3, "x" * 200_000, 4)], "doc_id long, text string, notices int")
    rows = licences.paragraphs(docs, model).orderBy("doc.notices").collect()
    notice = rows[0].notices[0]
    assert rows[0].doc.text[notice.start : notice.end] == line and notice.place == 1
    assert [len(r.notices) for r in rows] == [1, 0, 0, 0] and [r.n_paragraphs for r in rows] == [3, 0, 0, 1]
    assert licences.report(docs.limit(0)).count() == 0


def test_notices_that_many_documents_carry(spark, sf_dir):
    gpl = "Released under the GPL, version 2 or later."
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"
    docs = registry.table(spark, sf_dir, "documents").select("doc_id", "text").limit(90).collect()
    rows = [(r.doc_id, f"{r.text}\n\n{gpl}\n\n{mit}" if i % 3 == 0 else r.text) for i, r in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.families.split(",") for r in licences.report(df).collect()}
    for i, (key, _) in enumerate(rows):
        if i % 3 == 0:
            assert {"gpl", "mit"} <= set(got[key])


WRAPPED = {
    "mit": """
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "gpl": """
This is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3, or any later one.""",
    "bsd": """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "dnl "])
@pytest.mark.parametrize("family", WRAPPED)
def test_wrapped_notices(model, family, mark):
    lines = [mark + line for line in WRAPPED[family].strip().split("\n")]
    text = "\n".join(["The weather is fine", "", *lines, "", "He has a dog"])
    count, found = model.notices(text)
    assert count == len(lines) + 2
    assert [n["family"] for n in found] == [family]
    part = text[found[0]["start"] : found[0]["end"]]
    assert found[0]["place"] == 2 and "\n".join(lines[:2]) in part and part in "\n".join(lines)


def test_notices_on_lines_of_their_own_stay_apart(model):
    lines = [*PLANTED, *PLANTED, "Released under the MIT License."]
    _, found = model.notices("\n".join(lines))
    assert [(n["place"], n["family"]) for n in found] == [(i, PLANTED[x]) for i, x in enumerate(lines)]
