"""Held-out accuracy of the trained classifiers, and their edge cases."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import LOWER, fold
from callpulse.llm import langid, license_scan, quality, toxicity
from callpulse.llm.learning import BoostedTrees, Isotonic, Platt
from callpulse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"
ODD = [(1, None, "x"), (2, "", "y"), (None, "some text", "z"), (4, "1234 .,!", "u"), (5, "ж " * 200_000, "v"), (5, "ж", "v")]


def odd_documents(spark, name):
    return spark.createDataFrame(ODD, f"doc_id long, text string, {name} string")


def accuracy(spark, query, column):
    scored = {r.doc_id: r for r in QUERIES[query](spark, FOLDER).collect()}
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(scored) == documents.count()
    assert all(0 <= r.score <= 1 and r.held_out == (fold(r.doc_id, 3) == 1) for r in scored.values())
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [r for r in labels if scored[r.doc_id].held_out]
    ones = [scored[r.doc_id].predicted for r in held if r[column] == 1]
    zeros = [scored[r.doc_id].predicted for r in held if r[column] == 0]
    return np.mean(ones), np.mean(zeros)


def test_quality_of_held_out_documents(spark):
    kept, wrong = accuracy(spark, "op1_quality_classifier", "quality")
    assert kept > 0.98 and wrong < 0.05


def test_toxicity_of_held_out_documents(spark):
    found, wrong = accuracy(spark, "op6_toxicity", "toxic")
    assert found > 0.8 and wrong < 0.01


def test_language_of_held_out_documents(spark):
    found = QUERIES["op9_language_id"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert np.mean(held) > 0.97


def test_toxicity_of_odd_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    twice = labels.union(labels).union(labels.selectExpr("doc_id", "cast(null as int)"))
    model = toxicity.fit(documents, twice)
    scored = toxicity.score(odd_documents(spark, "toxicity"), model)
    assert scored.columns == ["doc_id", "text", "toxicity"]
    values = [r.toxicity for r in scored.collect()]
    assert len(values) == len(ODD) and all(0 <= v <= 1 for v in values)
    assert values[0] == values[1]


def test_quality_of_odd_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(documents, labels.where("label = 1"))  # no known negatives
    assert 0.3 < model.prior <= 0.95
    model = quality.fit(documents, labels)
    values = [r.quality for r in quality.score(odd_documents(spark, "quality"), model).collect()]
    assert len(values) == len(ODD) and all(0 <= v <= 1 for v in values)
    assert values[0] == values[1]


@pytest.mark.parametrize("operator, name", [(toxicity, "toxicity"), (quality, "quality")])
def test_nothing_to_learn_from(spark, operator, name):
    documents = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, label int")
    model = operator.fit(documents, labels)
    assert operator.score(documents, model).count() == 0
    assert all(0 <= r[name] <= 1 for r in operator.score(odd_documents(spark, "n"), model).collect())


def test_language_of_odd_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(documents)
    found = langid.identify(odd_documents(spark, "lang_pred"), model).collect()
    assert [r.lang_pred for r in found[:2]] == ["und", "und"] and found[3].lang_pred == "und"
    assert {r.lang_pred for r in found[4:]} <= set(model.languages)
    none = langid.fit(documents.where("false"))
    assert {r.lang_pred for r in langid.identify(odd_documents(spark, "n"), none).collect()} == {"und"}


def test_the_collapsed_model_is_the_kernel_expansion():
    r = np.random.default_rng(0)
    texts = [bytes(r.integers(97, 105, 30, dtype=np.uint8)) for _ in range(6)]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    flags = langid.presence(np.frombuffer(b"".join(texts), np.uint8), offsets).astype(float)
    sizes = flags.sum(1)
    kernel = flags @ flags.T / np.sqrt(np.outer(sizes, sizes))
    alpha = r.normal(size=(6, 2))
    matrix = (flags.T @ (alpha / np.sqrt(sizes)[:, None])).astype(np.float32)
    found = langid.LanguageModel(["a", "b"], matrix).decide(flags > 0)
    assert np.allclose(found, kernel @ alpha, atol=1e-4)


@pytest.fixture(scope="module")
def licenses(spark):
    return license_scan.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_licenses_of_templates_and_of_clean_text(spark, licenses):
    rows, truth = [], {}
    for family, texts in license_scan.TEMPLATES.items():
        for text in texts:
            for frame in ("{}", "é some words\n{}\nmore words here", "Ab cd. {} " + "Ef gh ij. " * 60):
                truth[len(rows)] = (family, text)
                rows.append((len(rows), frame.format(text), "x"))
    clean = [(1000 + k, t, "y") for k, t in enumerate(license_scan.OTHERS + [None, "", "\n\n", "word " * 50_000])]
    df = spark.createDataFrame(rows + clean, "doc_id long, text string, licenses string")
    right = 0
    for row in license_scan.scan(df, licenses).collect():
        if row.doc_id >= 1000:
            assert row.licenses == []
            continue
        family, text = truth[row.doc_id]
        right += [found.family for found in row.licenses] == [family]
        for found in row.licenses:
            assert text in row.text[found.start : found.end]
    assert right >= 0.97 * len(rows)


def test_corpus_licenses_are_all_found(spark, licenses):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = license_scan.scan(documents, licenses)
    stated = F.size("licenses") > 0
    wrong = found.where(stated != F.col("text").rlike("(Licensed under|Released under|is licensed under)"))
    assert wrong.count() <= 2 and found.where(stated).count() > 50
    spans = found.selectExpr("text", "inline(licenses)").selectExpr("substring(text, start + 1, end - start) AS s")
    assert spans.where("s rlike '\\n'").isEmpty()


def test_common_speech_is_no_short_licence(spark, licenses):
    said = ["The new record was released under the label and sold well.", "Released under the Unlicense."]
    df = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    found = {r.doc_id: [x.family for x in r.licenses] for r in license_scan.scan(df, licenses).collect()}
    assert found == {0: [], 1: ["unlicense"]}


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."
APACHE = "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."


def test_several_licences_of_one_line(spark, licenses):
    prose = "The town held a fair on the green and many came to see it. " * 30
    said = [
        f"{MIT} {prose}{APACHE}",
        f"{MIT}\n{APACHE}",
        "Released under the MIT License and Licensed under CC BY 4.0.",
        f"{prose}{MIT} {prose}",
        prose,
    ]
    df = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.scan(df, licenses).collect()}
    families = {i: [x.family for x in r.licenses] for i, r in found.items()}
    assert families == {0: ["mit", "apache"], 1: ["mit", "apache"], 2: ["mit", "cc-by"], 3: ["mit"], 4: []}
    for i, texts in ((0, (MIT, APACHE)), (3, (MIT,))):
        for run, text in zip(found[i].licenses, texts):
            assert text in said[i][run.start : run.end] and run.end - run.start < len(text) + 400


def test_runs_are_those_of_a_plain_scan(licenses):
    """Every window by itself, in plain Python over lists of words."""
    lines = [t for texts in license_scan.TEMPLATES.values() for t in texts] + license_scan.OTHERS
    r = np.random.default_rng(2)
    texts = [" ".join(r.choice(lines, r.integers(1, 7))) for _ in range(60)]
    words = license_scan._paragraphs_of(texts)
    windows = license_scan._windows(words, licenses.regression)
    places = []
    for k, text in enumerate(texts):
        size = int(words.first[k + 1] - words.first[k])
        starts = sorted({*range(0, max(size - license_scan.WINDOW, 0), license_scan.STEP), max(size - license_scan.WINDOW, 0)})
        places += [(k, s, min(s + license_scan.WINDOW, size)) for s in starts]
    assert places == [(k, s - words.first[k], e - words.first[k]) for k, s, e in zip(windows.owner, windows.start, windows.end)]
    score = licenses.calibrate(windows.odds.ravel()).reshape(windows.odds.shape)
    confirmed = set()
    for n, (k, s, e) in enumerate(places):
        own = words.hash[words.first[k] + s : words.first[k] + e]
        pairs = {int(p) for a in range(len(own) - 1) for p in license_scan._pairs(own[a : a + 2])}
        for f, family in enumerate(licenses.families[1:]):
            for template in licenses.templates.pairs[family]:
                common = len(pairs & {int(p) for p in template})
                needed = 0.6 if len(template) >= 4 else 1
                whole = common >= needed * len(template) or common >= 4 and common >= 0.85 * len(pairs)
                if whole and score[n, f] >= license_scan.LIKELY:
                    confirmed.add((k, family))
    runs = license_scan._runs(words, windows, licenses)
    found = {(x.owner, licenses.families[x.family]) for x in runs}
    assert found <= confirmed
    # What is left out rests on the words of a likelier run in the same line.
    assert {k for k, _ in confirmed} == {k for k, _ in found} and len(found) > 60


def test_licenses_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan(df, license_scan.fit(df)).count() == 0


def test_trees_isotonic_and_platt():
    r = np.random.default_rng(3)
    x = r.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = BoostedTrees().fit(x[:1000], y[:1000])
    score = trees.decide(x)
    assert ((score > 0) == y)[1000:].mean() > 0.95
    fit = Isotonic().fit(score[:1000], y[:1000])
    values = fit(np.sort(score))
    assert (np.diff(values) >= 0).all() and 0 <= values.min() <= values.max() <= 1
    p = Platt().fit(score[:1000], y[:1000])(np.sort(score))
    assert (np.diff(p) >= 0).all() and p[0] < 0.1 and p[-1] > 0.9


def test_isotonic_rises_between_its_levels():
    fit = Isotonic().fit(np.array([0.0, 1.0, 2.0, 3.0, 10.0, 11.0]), np.array([0, 1, 0, 1, 1, 1.0]))
    assert fit(np.array([-5.0, 0.0, 1.0, 2.0, 2.5, 3.0, 99.0])).tolist() == [0, 0, 0.5, 0.5, 0.75, 1, 1]


def plain_features(text, weights):
    """Features of one text, in plain Python; ``weights`` is the lexicon of whole words."""
    word = re.compile(r"(?:[A-Za-z0-9']|[^\x00-\x7f])+")
    size = max(len(text.encode()), 1)
    found = [w.translate(LOWER) for w in word.findall(text)]
    hits = [weights.get(w, 0.0) for w in found]
    listed = [w in toxicity.LISTED for w in found]
    person = [k for k, w in enumerate(found) if w in toxicity.SECOND_PERSON]
    near = [max((1 / (1 + abs(k - p)) for p in person), default=0) for k, h in enumerate(hits) if h or listed[k]]
    read = text.translate(str.maketrans(toxicity.LOOKALIKES))
    read = [w.translate(LOWER) for w in re.findall(r"(?:[A-Za-z0-9'@$]|[^\x00-\x7f])+", read)]
    hidden = sum(w in weights or w in toxicity.LISTED for w in read)
    n = max(len(found), 1)
    return {
        "hits": sum(h > 0 for h in hits), "hit_density": sum(h > 0 for h in hits) / n,
        "best_weight": max(hits, default=0), "weight_density": sum(hits) / n,
        "hidden_hits": max(hidden - sum(h > 0 or x for h, x in zip(hits, listed)), 0),
        "listed_hits": sum(listed), "listed_density": sum(listed) / n,
        "near_person": max(near, default=0), "near_share": sum(near) / n,
        "person_density": len(person) / n,
        "capitals": len(re.findall("[A-Z]", text)) / size,
        "marks": len(re.findall("[!?]", text)) / size,
        "digits": len(re.findall("[0-9]", text)) / size,
        "punctuation": len([c for c in text if "!" <= c <= "~" and not c.isalnum()]) / size,
        "stretched": sum(bool(re.search(r"([a-z]|[^\x00-\x7f])\1\1", w)) for w in found) / n if text.isascii() else None,
        "words": np.log1p(len(found)),
    }


def test_toxicity_features_are_those_of_plain_python():
    weights = {"zorb": 2.5, "grint": 1.5, "d'accord": 3.0}
    keys = toxicity._hashes_of(list(weights))
    by_key = {int(toxicity._hashes_of([w])[0]): v for w, v in weights.items()}
    lexicon = toxicity.Lexicon(keys, np.array([by_key[int(k)] for k in keys]))
    r = np.random.default_rng(4)
    some = ["you", "Zorb", "z0rb", "GRINT", "gr1nt!", "idiot", "1d10t", "id1ot", "sooooo", "été", "d'accord", "a", "42", "?!", "Your", "x"]
    texts = ["", " ", "you zorb", "ZORB you", *(" ".join(r.choice(some, r.integers(0, 30))) for _ in range(80))]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    found = toxicity.text_features(np.frombuffer(b"".join(raw), np.uint8), offsets, lexicon)
    for text, row in zip(texts, found):
        given = dict(zip(toxicity.FEATURES, row))
        for name, value in plain_features(text, weights).items():
            assert value is None or abs(given[name] - value) < 1e-9, (name, text)
