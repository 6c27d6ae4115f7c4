"""License scans against a plain-Python version of the same rules."""

import re

import pytest
from pyspark.sql import functions as F

from civicledger.llm import license_scan as L

COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def starts(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase]


def brute(texts, templates=L.TEMPLATES, phrases=L.PHRASES):
    """The stated rules, one document and template after the other."""
    docs = [plain_words(t) for t in texts]
    vocabulary = {w for _, t, _ in templates for w in plain_words(t)} | {w for p in phrases for w in p.split()}
    count = {w: sum(w in d for d in map(set, docs)) for w in vocabulary}
    out = []
    for d in docs:
        base = {label: starts(d, p.split()) for p, label in phrases.items()}
        every = [i for at in base.values() for i in at]
        found = []
        for label, wording, needed in templates:
            sequence, inside = plain_words(wording), set(d)
            if not {w for p in needed for w in plain_words(p)} <= inside:
                continue
            rare = sorted(set(sequence) & inside, key=lambda w: (count[w], w))[:L.RAREST]
            asked = sum(w in rare for w in sequence)
            votes = {}
            for i, w in enumerate(d):
                for p, x in enumerate(sequence):
                    if x == w and w in rare:
                        votes[i - p] = votes.get(i - p, 0) + 1
            for at, n in sorted(votes.items()):
                window = d[max(0, at - L.SLACK):max(0, at + len(sequence) + L.SLACK)]
                if 2 * n >= asked and all(starts(window, plain_words(p)) for p in needed):
                    found.append((label, at, n / asked))
        own = {label for label, at in base.items() if at}
        out.append((len(d), len(every), min(every, default=None), max(every, default=None), ",".join(sorted(own)),
                    ",".join(sorted(own | {f[0] for f in found})),
                    1.0 if every else max((f[2] for f in found), default=0.0), found))
    return out


def result(df):
    rows = df.select("n", *COLUMNS, F.transform("matches", lambda m: F.struct(m["label"], m["at"], m["share"])).alias("m")).collect()
    return {r["n"]: (*[r[c] for c in COLUMNS], [tuple(m) for m in r["m"]]) for r in rows}


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "n long, text string")


NOTICE = L.TEMPLATES[1][1]
CASES = [
    None, "", "  \n.,-", "All rights reserved.", "ALL RIGHTS RESERVED all rights reserved", "all rights, (reserved)",
    "all rights were reserved", "Licensed under CC BY-NC 4.0.", "cc by", "cc_by cc.by", "CCBY",
    "This work is licensed under the GNU General Public License, version 3.", "general public licence", "Released under the MIT License.",
    "license mit", NOTICE, "Copyright 2020 Somebody\n" + NOTICE + "\nTHE END", NOTICE.replace("free of charge", "free of any charge"),
    NOTICE.replace("modify, merge", "modify, adapt and also merge"), NOTICE + " other words between them " * 20 + NOTICE,
    "Straße ſoftware K licKense Public İ 漢字 all rights reserved 漢字 cc by",
    "the the the of of a copy of this software public license", " ".join(t for _, t, _ in L.TEMPLATES),
    "word " * 40000 + "All rights reserved " + "license " * 3000 + "mit license " * 500,
    "\x00all\x7frights`reserved{", "all rights reserved", "all rights reserved",
]


def test_cases_against_brute_force(spark):
    got = result(L.scan(frame(spark, CASES)))
    for k, want in enumerate(brute(CASES)):
        assert got[k] == want, (k, (CASES[k] or "")[:80])


def test_given_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = result(L.scan(docs.withColumnRenamed("doc_id", "n")))
    assert got == dict(zip([d for d, _ in rows], brute([t for _, t in rows]), strict=True))
    assert any(g[5] for g in got.values())


def test_edited_and_repeated_notices_are_found(spark):
    got = result(L.scan(frame(spark, CASES)))
    assert [g for g in (15, 16, 18) if "mit" not in got[g][5].split(",")] == []
    assert len(got[19][-1]) == 2                                        # both copies of the notice
    assert "mit" not in got[17][5] and "mit" not in got[14][5]          # a key phrase is missing


def test_columns_repeats_and_empty_tables(spark, docs):
    named = docs.select("*", F.lit(1).alias("labels"), F.lit(2).alias("_scan"), F.lit(3).alias("Score"))
    found = L.scan(named)
    assert [c for c in found.columns if c in ("_scan", "lang", "doc_id")] == ["doc_id", "lang", "_scan"]
    assert found.count() == docs.count() and dict(found.dtypes)["labels"] == "string"
    assert L.scan(docs.where("false")).count() == 0
    assert all(r["score"] == 0 and r["n_words"] == 0 for r in found.where("text is null or text = ''").collect())


def test_the_plan_has_no_python(spark, docs):
    plan = L.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_returns_every_document(spark):
    from civicledger.llm.queries import op11_license_scan
    found = op11_license_scan(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", *COLUMNS]
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert pytest.approx(0) == found.where("score < 0 or score > 1 or score is null").count()
