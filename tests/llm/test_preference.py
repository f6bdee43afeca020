import pytest
from pyspark.sql import functions as F

from callpulse.llm import preference

PAIR = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"


def render(turns):
    return "".join(f"<|{r or 'user'}|>\n{t or ''}<|end|>\n" for r, t in turns)


def expected(chosen, rejected):
    n = 0
    fill = [[(r or "user", t or "") for r, t in side or []] for side in (chosen, rejected)]
    while n < min(map(len, fill)) and fill[0][n] == fill[1][n]:
        n += 1
    return n, render(fill[0][:n]), render(fill[0][n:]), render(fill[1][n:])


U, A = "user", "assistant"
PAIRS = [
    ([(U, "hi"), (A, "good")], [(U, "hi"), (A, "bad")]),
    ([(U, "hi"), (A, "good"), (U, "é日"), (A, "x")], [(U, "hi"), (A, "good")]),
    ([(U, "a")], [(U, "a")]),
    ([], [(A, "only")]),
    (None, None),
    ([(None, None), (A, "")], [("user", ""), (A, "b")]),
    ([(U, "a"), (A, "b")], [(A, "a"), (A, "b")]),
    ([(U, "long " * 100_000), (A, "y")], [(U, "long " * 100_000), (A, "z")]),
    ([(U, f"t{k}") if k % 2 else (A, f"t{k}") for k in range(300)], [(U, f"t{k}") if k % 2 else (A, f"t{k}") for k in range(299)]),
]


def test_prompt_and_completions(spark):
    df = spark.createDataFrame([(k, *p, "clash") for k, p in enumerate(PAIRS)], PAIR)
    rows = preference.formatted(df).collect()
    assert len(rows) == len(PAIRS)
    for row in rows:
        chosen, rejected = PAIRS[row.pair_id]
        assert (row.prefix_turns, row.prompt, row.chosen, row.rejected) == expected(chosen, rejected)
        for text, spans, side in ((row.chosen, row.chosen_spans, chosen), (row.rejected, row.rejected_spans, rejected)):
            learned = [t or "" for r, t in (side or [])[row.prefix_turns :] if r == A]
            assert [text[s.start : s.end] for s in spans] == [f"{t}<|end|>" for t in learned]


def test_no_python_and_one_shuffle(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    pairs = preference.against_repetition(preference.conversations_of(turns))
    plan = preference.formatted(pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


def test_conversations_and_pairs_of_odd_turns(spark):
    rows = [
        (1, 0, U, "q"), (1, 1, A, "one"), (1, 2, U, "r"), (1, 3, A, "two"), (1, 4, U, "bye"),
        (2, 0, U, "q"), (3, 0, U, "q"), (3, 1, A, "same"), (3, 1, A, "same"),
        (None, 0, U, "lost"), (4, None, None, None), (4, 1, A, None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pairs = {
        r.conv_id: ([tuple(t) for t in r.chosen], [tuple(t) for t in r.rejected])
        for r in preference.against_repetition(preference.conversations_of(df)).collect()
    }
    assert pairs == {
        1: ([(U, "q"), (A, "one"), (U, "r"), (A, "two")], [(U, "q"), (A, "one"), (U, "r"), (A, "one")]),
        3: ([(U, "q"), (A, "same"), (A, "same")], [(U, "q"), (A, "same"), (A, "same")]),
        4: ([(U, ""), (A, "")], [(U, ""), (A, "")]),
    }


@pytest.mark.parametrize("step", [lambda df: df, preference.against_repetition])
def test_empty_table(spark, step):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert step(preference.conversations_of(df)).count() == 0
    assert preference.formatted(spark.createDataFrame([], PAIR)).count() == 0


def test_spans_of_nothing(spark):
    none = F.array().cast(preference.TURNS)
    assert spark.range(1).select(preference.learned_spans(none), preference.rendered(none)).first()[:] == ([], "")
