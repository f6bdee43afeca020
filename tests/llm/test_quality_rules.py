import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from callpulse.llm import quality_rules as qr
from callpulse.llm import queries
from brute import SHINGLE_WORD, fold


def brute(text):
    text = text or ""
    words = SHINGLE_WORD.findall(text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeated = set()
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            repeated.update(range(k, k + 8))
    lines = [line for line in text.split("\n") if SHINGLE_WORD.search(line)]
    letters = [c for c in text if ord(c) >= 192 or c.isascii() and c.isalpha()]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_distinct_words": len(set(words)),
        "n_capitals": len(re.findall("[A-Z]", text)),
        "n_letters": len(letters),
        "n_digits": len(re.findall("[0-9]", text)),
        "n_marks": len(re.findall("[!?]", text)),
        "longest_word": max(map(len, words), default=0),
    }


def texts():
    r = random.Random(5)
    some = ["a", "B", "cé", "#", "x!?", "1<2", "日本語", "\x0b", "\n", "\n\n", "\t", "A", "a"]
    out = [None, "", " \n\t", "one", "a\na\na", "a \na\n a", "a\r\na\n", "A\na", "é" * 50, "x " * 9]
    out += ["".join(r.choice(some) + r.choice(["", " ", "\n"]) for _ in range(r.randrange(60))) for _ in range(60)]
    out += ["one two three four five six seven eight " * 3, "w " * 30_000, ("line of words here\n" * 20_000), "z" * 200_000]
    return out


def test_counts_are_those_of_plain_python(spark):
    rows = [(i, t, "n", 5) for i, t in enumerate(texts())] + [(0, "again", "n", 5)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, counts int")
    found = qr.with_counts(df).collect()
    assert len(found) == len(rows) and found[0].n_words == "n"
    for row in found:
        assert row.counts.asDict() == brute(row.text), row.text and row.text[:80]


def planted(rows, seed=1):
    """Bad rows have many symbols, or capitals in long words; some labels are wrong."""
    r = np.random.default_rng(seed)
    x = r.random((rows, len(qr.RATES)))
    name = list(qr.RATES).index
    y = (x[:, name("symbol_share")] > 0.9) | (x[:, name("capital_share")] > 0.8) & (x[:, name("mean_word")] > 0.7)
    return x, y ^ (r.random(rows) < 0.005), r.random(rows) < 0.33


def test_planted_rules_are_found():
    x, y, pruning = planted(6_000)
    rules = qr.Covering().fit(x, y, pruning)
    held, truth, _ = planted(4_000, 2)
    said = rules.first_rule(held) >= 0
    assert (said & truth).sum() >= 0.93 * truth.sum() and (said & ~truth).sum() <= 0.05 * said.sum()
    assert {c.rate for r in rules.rules for c in r.conditions} == {"symbol_share", "capital_share", "mean_word"}
    assert all(rule.precision >= 0.9 for rule in rules.rules)


def test_chance_makes_no_rule():
    r = np.random.default_rng(0)
    x = r.random((3_000, len(qr.RATES)))
    assert not qr.Covering().fit(x, r.random(3_000) < 0.1, r.random(3_000) < 0.33).rules


def test_the_expression_says_what_the_list_says(spark):
    rules = qr.Covering().fit(*planted(3_000))
    few = qr.DecisionList([qr.Rule((qr.Condition("words", False, 3.0),)), *rules.rules])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    rows = qr.judged(df, few).select("rejected_by", F.array(*qr.rates().values()).alias("x")).collect()
    place = few.first_rule(np.array([r.x for r in rows]))
    assert [r.rejected_by for r in rows] == [str(few.rules[p]) if p >= 0 else None for p in place]
    assert "BatchEvalPython" not in qr.judged(df, few)._jdf.queryExecution().toString()


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, 0), (1, 1), (None, 0)], [(7, 0)]):
        rules = qr.fit(df, spark.createDataFrame(labels, "doc_id long, label int"))
        assert rules.rules == [] and [r.rejected_by for r in qr.judged(df, rules).collect()] == [None, None]
    assert qr.judged(df.limit(0), qr.DecisionList()).collect() == []


def test_query_on_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op13_quality_rules"](spark, folder).collect()
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(given)
    for r in rows:
        expected = brute(given[r.doc_id])
        assert all(r[name] == expected[name] for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and (not r.kept or not failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    tested = [r for r in rows if fold(r.doc_id, 3) == 1 and r.doc_id in labels and not r.base_failed]
    bad = [r.kept for r in tested if labels[r.doc_id] == 0]
    good = [r.kept for r in tested if labels[r.doc_id] == 1]
    assert sum(bad) <= 0.4 * len(bad) and sum(good) >= 0.98 * len(good)


@pytest.mark.parametrize("limit", [50])
def test_the_sample_is_bounded(spark, limit):
    df = spark.createDataFrame([(i, "a" if i % 3 else "#") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(500)], "doc_id long, label int")
    assert isinstance(qr.fit(df, labels, limit), qr.DecisionList)
