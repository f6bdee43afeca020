import random
import re
from collections import Counter

import pytest

from callpulse.llm import queries, spelling
from callpulse.llm.acceptor import Acceptor, one_edit_pairs
from brute import LOWER
from zlib import crc32


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words, ratio=10):
    """Rows of ``variants`` from word -> n."""
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(
        (w, form[w] or "", root(w), n, len(near[w]), words.get(form[w], -1)) for w, n in words.items()
    )


def found(spark, words, **options):
    df = spark.createDataFrame([(n, w, 7) for w, n in words.items()], "n long, word string, size int")
    rows = spelling.variants(df, **options).collect()
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in rows)


@pytest.mark.parametrize("seed", range(60))
def test_composition_accepts_pairs_of_one_edit_once(seed):
    r = random.Random(seed)
    letters = "abcd"[: 2 + seed % 3]
    words = sorted({"".join(r.choice(letters) for _ in range(r.randrange(6))) for _ in range(40)})
    acceptor = Acceptor(words)
    assert all(map(acceptor.accepts, words)) and not acceptor.accepts("a" * 9)
    pairs = one_edit_pairs(acceptor)
    assert len(pairs) == len(set(pairs)) and all(len(a) <= len(b) for a, b in pairs)
    assert {frozenset(p) for p in pairs} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_acceptor_is_minimal():
    words = sorted(a + b for a in ("b", "ca", "dd") for b in ("ing", "ed", "s"))
    # One state for each different set of endings.
    endings = {frozenset(w[k:] for w in words if w[:k] == v[:k]) for v in words for k in range(len(v) + 1)}
    assert len(Acceptor(words).arcs) == len(endings)


@pytest.mark.parametrize("letters", [1 << 17, 12])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, letters):
    """With partitions split down to single letters, and whole."""
    monkeypatch.setattr(spelling, "PARTITION_LETTERS", letters)
    r = random.Random(3)
    words = {}
    for _ in range(60):
        word = "".join(r.choice("abé") for _ in range(r.randrange(1, 9)))
        words[word] = r.choice([1, 2, 30, 400, 5_000])
    words |= {"ß" * 30: 2, "ß" * 31: 40, "ß" * 15 + "a" + "ß" * 15: 1, "aaaaaaaaab": 3, "aaaaaaaaa": 30}
    assert found(spark, words) == brute(words)
    assert found(spark, words, ratio=2) == brute(words, 2)


def test_chains_are_followed_and_ties_go_to_the_first(spark):
    words = {"abcdefg": 1, "abcdefh": 10, "abcdehh": 100, "abcdhhh": 1_000, "zzzzzzz": 1, "zzzzzza": 10, "zzzzzzb": 10}
    rows = {r[0]: r for r in found(spark, words)}
    assert rows["abcdefg"][1:3] == ("abcdefh", "abcdhhh")
    assert rows["zzzzzzz"][1] == "zzzzzza"


def test_very_long_words(spark):
    base = "ab" * 150_000
    words = {base: 100, base[:70_000] + "c" + base[70_000:]: 2, base[:-1]: 3, base[:200_000] + "x" + base[200_001:]: 1}
    rows = {r[0]: r for r in found(spark, words)}
    assert [rows[w][4] for w in words] == [3, 1, 1, 1]
    assert all(rows[w][2] == base for w in words)


def test_no_words(spark):
    assert found(spark, {}) == []
    assert found(spark, {"a": 1}) == [("a", "", "a", 1, 0, -1)]


def test_the_query_counts_every_run_of_every_text(spark, tmp_path):
    texts = [
        (1, "Straßenbahn STRASSEN straßenbahn, x" + "Ä" * 8), (2, None), (None, "wordings wordings"),
        (3, ""), (4, "wording-s; WORDINGS wordings7wordings"), (4, "wording-s; WORDINGS wordings7wordings"),
        *((k, f"Variants of variants {'repeated ' * (k % 5)}") for k in range(10, 140)),
        (999, "l" * 100_000 + " " + "l" * 100_000),
    ]
    spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, word int").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    words = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            words[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    rows = queries.QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect()
    assert sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or -1) for r in rows) == brute(words)
    assert any(r.form for r in rows)
