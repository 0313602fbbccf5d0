"""Trained operators: gradients, held-out accuracy, calibration, licence notices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trendlake.llm.language import BiGru, LanguageModel, _sample, cut_windows, held_out, op10_language, train_language_model, with_language
from trendlake.llm.licences import TEMPLATES, _own_paragraphs, _variants, scan_licences, train_licence_model
from trendlake.llm.quality import STATISTICS, isotonic, op3_quality, statistics_of, train_quality_model, with_quality

from .helpers import awkward, documents

SF = "/root/testdata/sf0.01"


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    network = BiGru(3, 4)
    for k in network.weights:
        network.weights[k] = network.weights[k].astype(np.float64)
    windows, labels = draw.integers(0, 256, (7, 5)), draw.integers(0, 3, 5)
    real = draw.random((7, 5)) < 0.8

    def loss():
        p = network.probabilities(windows)
        return -(np.log(p[:, labels, np.arange(5)]) * real).sum() / real.sum()

    grads = network.gradients(windows, labels, real)
    for k, w in network.weights.items():
        for _ in range(6):
            at = tuple(draw.integers(0, n) for n in w.shape)
            if k.startswith("in"):
                at = (at[0], windows[draw.integers(0, 7), draw.integers(0, 5)])
            keep, step = w[at], 1e-2
            w[at] = keep + step
            up = loss()
            w[at] = keep - step
            down = loss()
            w[at] = keep
            assert grads[k][at] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_windows_hold_every_byte():
    texts = [b"", b"abc", bytes(range(1, 200)), b"x" * 16]
    windows, real, owner = cut_windows(texts, 16)
    for i, text in enumerate(texts):
        own = windows[:, owner == i].T
        assert b"".join(bytes(w[:n]) for w, n in zip(own, real[owner == i])) == text


def test_language_accuracy_on_held_out_rows(spark):
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op10_language(spark, SF).join(langs, "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_awkward_rows(spark):
    docs = documents(spark, awkward())
    model = train_language_model(docs, ~held_out(4, 2), epochs=2)
    out = with_language(docs, model, "lang_pred", "found").collect()
    assert len(out) == len(awkward()) and model.languages == ["de", "en", "fr"]
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["found"] == 0.0)
    assert with_language(documents(spark, []), model).count() == 0
    none = train_language_model(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r["lang_pred"] for r in with_language(docs, none).collect()} == {"und"}


def test_equal_rows_leave_every_language(spark):
    """Thousands of equal rows of one language beside few of another: each is learned, and the sample stays within its bound."""
    few = [(i, f"ordinary words of a text number {i}", "en", "a") for i in range(400)]
    for many in ([(None, "zzz qqq xxx", "xx", "a")] * 5000, [(i, "zzz qqq xxx", "xx", "a") for i in range(3000)]):
        docs = documents(spark, few + many)
        sample = _sample(docs, F.lit(True), 50, 3, 20)
        assert {lang for lang, _ in sample} == {"en", "xx"} and len(sample) <= 2 * 50 * 3
        model = train_language_model(docs, F.lit(True), epochs=1)
        assert model.languages == ["en", "xx"]


def test_language_ignores_rows_that_are_held_out(spark):
    docs = documents(spark, awkward())
    changed = docs.withColumn("lang", F.when(held_out(4, 2), "xx").otherwise(F.col("lang")))
    one, other = (train_language_model(d, ~held_out(4, 2), epochs=1) for d in (docs, changed))
    assert one.languages == other.languages
    assert all((one.network.weights[k] == other.network.weights[k]).all() for k in one.network.weights)


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op3_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) for r in rows)


def test_quality_awkward_rows(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 140)] + [(100, None, 0), (None, 1, 0), (101, 0, 1)], "doc_id long, quality int, toxic int")
    model = train_quality_model(docs, labels, F.lit(True), features=32)
    out = with_quality(docs, model, "rated").collect()
    assert len(out) == len(awkward()) and all(0 <= r["rated"] <= 1 for r in out)
    assert train_quality_model(docs, labels.limit(0), F.lit(True)) is None
    assert {r["rated"] for r in with_quality(docs, None, "rated").collect()} == {0.5}
    assert with_quality(documents(spark, []), model).count() == 0


def test_statistics_and_isotonic():
    rows = dict(zip(STATISTICS, statistics_of(["Aa aa 12 !!\nB"])[0]))
    assert rows["log_words"] == pytest.approx(np.log1p(5)) and rows["upper"] == pytest.approx(2 / 5)
    assert rows["digits"] == pytest.approx(2 / 13) and rows["distinct_words"] == pytest.approx(4 / 5)
    assert (statistics_of([None, ""])[0] == statistics_of([None, ""])[1]).all()
    draw = np.random.default_rng(3)
    x, y = draw.random(60), draw.integers(0, 2, 60)
    steps, levels = isotonic(x, y)
    assert (np.diff(levels) > 0).all() and (np.diff(steps) > 0).all()
    order, best = np.argsort(x), None
    # The least squares non-decreasing fit by the max-min formula.
    s = y[order].astype(float)
    best = [max(min(s[a:b + 1].mean() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    assert sorted({round(v, 9) for v in best}) == sorted({round(v, 9) for v in levels})


def test_licences(spark):
    notices = [(1, "Some words.\nLicensed under the Apache License, Version 2.0.\nMore words.", "en", "a"),
               (2, "Released under the MIT License.", "en", "a"), (2, "Released under the MIT License.", "en", "a"),
               (3, "The driver lost his license in May and asked for permission to walk.", "en", "a"),
               (4, "This work is licensed under the GNU General Public License, version 3.", None, None),
               (5, "this program is licensed under the gnu affero general public license, version 3", "en", "a"),
               (None, "Licensed under CC BY-NC 4.0.", "en", "a"), (6, "Licensed to drive.", "en", "a")]
    docs = documents(spark, awkward() + notices)
    model = train_licence_model(docs)
    found = scan_licences(docs, model)
    got = sorted(((r["doc_id"], r["paragraph_no"], r["family"]) for r in found.where("confirmed").collect()), key=repr)
    assert got == sorted([(1, 1, "Apache-2.0"), (2, 0, "MIT"), (2, 0, "MIT"), (4, 0, "GPL-3.0"), (5, 0, "AGPL"), (None, 0, "CC-BY-NC")], key=repr)
    assert scan_licences(documents(spark, []), model).count() == 0
    plan = scan_licences(docs, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def licence_model(spark):
    return train_licence_model(documents(spark, awkward()))


def test_every_licence_example_is_scored(spark, licence_model):
    rows = [(i, text, "en", "a") for i, (_, text) in enumerate(TEMPLATES)]
    found = {r["doc_id"]: r["family"] for r in scan_licences(documents(spark, rows), licence_model).where("confirmed").collect()}
    assert [found.get(i) for i in range(len(rows))] == [family for family, _ in TEMPLATES]
    examples = _variants(spark.createDataFrame([*TEMPLATES], "family string, text string")).select(F.concat_ws(" ", "words").alias("paragraph"))
    known = licence_model.known(examples)
    named = licence_model.scored(known.select("known").distinct()).where("family <> 'unknown'").join(known, "known")
    assert named.count() > 0 and named.where(~licence_model.possible(F.col("known"))).count() == 0
    short = ["All rights reserved.", "Released into the public domain.", "GPLv3", "Apache 2.0", "Distributed under the GPL, version 2."]
    scored = licence_model.scored(licence_model.known(spark.createDataFrame([(t,) for t in short], "paragraph string")).select("known").distinct())
    assert scored.count() == len(short)


def test_wrapped_notices(spark, licence_model):
    gpl = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
           "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.")
    lgpl = ("This library is free software; you can redistribute it\nunder the terms of the GNU Lesser\nGeneral Public License.")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:")
    marked = "\n".join(" * " + line for line in gpl.split("\n"))
    rows = [(1, gpl, "en", "a"), (2, "One title\n\n" + lgpl + "\n \nThe end of it.", "en", "a"), (2, "Another text.", "en", "a"), (None, bsd, "en", "a"),
            (3, f"/*\n * My program\n *\n{marked}\n */", "en", "a"), (4, "Some words.\nReleased under the MIT License.\nMore words.", "en", "a"),
            (5, gpl.replace("\n", "\r\n"), "en", "a"), (6, gpl.replace("\n", " "), "en", "a"), (7, "", "en", "a"), (8, "\n\n", "en", "a"), (9, None, "en", "a")]
    found = scan_licences(documents(spark, rows), licence_model).where("confirmed").collect()
    assert sorted(((r["doc_id"], r["paragraph_no"], r["family"]) for r in found), key=repr) == sorted(
        [(1, 0, "GPL-3.0"), (2, 2, "LGPL"), (None, 0, "BSD"), (3, 3, "GPL-3.0"), (4, 1, "MIT"), (5, 0, "GPL-3.0"), (6, 0, "GPL-3.0")], key=repr)


def test_several_notices_in_one_run(spark, licence_model):
    gpl = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
           "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.")
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    lgpl = "This library is free software; you can redistribute it\nunder the terms of the GNU Lesser\nGeneral Public License."
    share = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    texts = [f"{gpl}\n{bsd}", f"{bsd}\n{gpl}", f"{gpl}\n{lgpl}", share, f"{share}\n{share}", gpl, f"{gpl}\n{gpl}",
             "Released under the MIT License. Released into the public domain.", f"{gpl}\n{bsd}\nReleased under the ISC License."]
    want = [{"GPL-3.0", "BSD"}, {"GPL-3.0", "BSD"}, {"GPL-3.0", "LGPL"}, {"CC-BY-SA"}, {"CC-BY-SA"}, {"GPL-3.0"}, {"GPL-3.0"},
            {"MIT", "Unlicense"}, {"GPL-3.0", "BSD", "ISC"}]
    found = scan_licences(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), licence_model).where("confirmed").collect()
    assert [{r["family"] for r in found if r["doc_id"] == i} for i in range(len(texts))] == want
    twice = scan_licences(documents(spark, [(None, texts[0], "en", "a")] * 2), licence_model).where("confirmed")
    assert sorted(r["family"] for r in twice.collect()) == ["BSD", "BSD", "GPL-3.0", "GPL-3.0"]


def test_held_out_notices(spark, licence_model):
    """Wordings that no template has; the sentences grant nothing."""
    notices = [("MIT", "This package is distributed under the MIT License."), ("Apache-2.0", "Code licensed under Apache License, Version 2.0."),
               ("EUPL-1.2", "This file is licensed under the EUPL, Version 1.2."), ("EPL-2.0", "Made available under the terms of the Eclipse Public License 2.0."),
               ("BSL-1.0", "Released under the Boost Software License, Version 1.0."), ("Zlib", "Distributed under the zlib License."),
               ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
               ("GPL-3.0", "The tool is licensed under the GNU General Public License, version 3.")]
    plain = ["The licence of the pub was renewed.", "The public was free to use the software room.", "He reserved a table for version two of the play."]
    rows = [(i, t, "en", "a") for i, t in enumerate([t for _, t in notices] + plain)]
    found = {r["doc_id"]: r["family"] for r in scan_licences(documents(spark, rows), licence_model).where("confirmed").collect()}
    right = sum(found.get(i) == family for i, (family, _) in enumerate(notices))
    assert right >= len(notices) - 1 and all(i < len(notices) for i in found)


def test_licence_scores_are_those_of_a_plain_sum(spark, licence_model):
    texts = [t for _, t in TEMPLATES] + ["nothing of it", "the the the", ""]
    known = licence_model.known(spark.createDataFrame([(t,) for t in texts], "paragraph string")).select("known").distinct()
    weights = {r["gram"]: np.array(r["w"]) for r in licence_model.weights.collect()}
    for r in licence_model.scored(known).collect():
        logits = (sum((weights[g] for g in r["known"]), np.array(licence_model.intercepts))) / licence_model.temperature
        p = np.exp(logits - logits.max())
        assert r["family"] == licence_model.families[int(logits.argmax())]
        assert r["probability"] == pytest.approx((p / p.sum()).max(), rel=1e-9)


def test_unknown_paragraphs_stay_within_their_bound(spark):
    same = "\n".join(f"line {i} of a text that many rows hold" for i in range(200))
    long = " ".join(f"w{i}" for i in range(5_000))
    docs = documents(spark, [(7, same, "en", "a")] * 300 + [(None, long, "en", "a")] * 50 + [(1, None, "en", "a"), (2, "", "en", "a")])
    drawn = _own_paragraphs(docs, 100, 10_000, 60).collect()
    assert len(drawn) == 200 + 84 and max(len(r["words"]) for r in drawn) == 60
    assert "w4999" in {w for r in drawn for w in r["words"]}
    assert len(_own_paragraphs(docs, 100, 50, 60).collect()) == 50


def test_pipeline_stages_keep_columns_and_clean_rows(spark):
    taken = ["_found_lang", "_found_score", "_label", "_id", "_hash", "_text", "_mix_hash", "_mix_position", "_MIX_ROW", "__score"]
    docs = documents(spark, awkward()).withColumns({name: F.lit(name) for name in taken})
    labels = f"{SF}"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, labels)
        assert out.columns == docs.columns, name
        assert {tuple(r) for r in out.select(*taken).distinct().collect()} == {tuple(taken)}, name
        assert stage(spark, docs.limit(0), labels).count() == 0, name
    packed = corpus_pipeline.pack_sequences(spark, docs, labels)
    assert packed.count() > 0


def test_pipeline_run(spark):
    documents_ = spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = corpus_pipeline.run(spark, SF)
    held = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= 1024 for r in held)
    assert 0 < rows.select("doc_id").distinct().count() < documents_
