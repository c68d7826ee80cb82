"""Keywords, summary and error capture per row (EX4-EX6)."""

import io
from contextlib import redirect_stdout

from pagemill.operators import extract as ex

ROWS = [("u", "Cats purr. Dogs bark! Cats sleep, cats eat."), ("u", "Rain falls."), ("v", None), ("w", " . ! "),
        ("x", "The of and."), ("u", "Rain falls.")]


def articles(spark):
    return spark.createDataFrame(ROWS, "link string, text string")


def picky(sentences, words):
    if ["rain", "falls"] in words:
        raise ValueError("wet")
    return ex.top_terms(sentences, words)


def test_rows_with_one_link_keep_their_own_values(spark):
    got = sorted(((r["link"], r["text"] or "", r["keywords"], r["summary"], r["nlp_error"])
                  for r in ex.with_nlp(articles(spark)).collect()), key=lambda r: r[:2])
    assert got == [
        ("u", "Cats purr. Dogs bark! Cats sleep, cats eat.",
         ["cats", "bark", "dogs", "eat", "purr", "sleep"],
         "Cats purr.\nDogs bark!\nCats sleep, cats eat.", None),
        ("u", "Rain falls.", ["falls", "rain"], "Rain falls.", None),
        ("u", "Rain falls.", ["falls", "rain"], "Rain falls.", None),
        ("v", "", [], "", None),
        ("w", " . ! ", [], ".\n!", None),         # marks alone are sentences without words
        ("x", "The of and.", [], "The of and.", None)]


def test_summary_takes_the_best_sentences_in_text_order():
    words = [["a1"], ["b1", "b1"], ["c1"], ["b1"], ["d1"], ["e1"], ["f1"]]
    k, text = ex.top_terms([f"s{i}" for i in range(7)], words)
    assert text.split("\n") == ["s0", "s1", "s2", "s3", "s4"] and k[0] == "b1"
    k, text = ex.top_terms([f"s{i}" for i in range(7)], words[::-1])
    assert text.split("\n") == ["s0", "s1", "s2", "s3", "s5"]


def test_a_failing_row_is_recorded_and_the_others_stay(spark):
    got = [(r["text"], r["keywords"], r["summary"], r["nlp_error"])
           for r in ex.with_nlp(articles(spark), picky).collect()]
    bad = [r for r in got if r[3]]
    assert bad == [("Rain falls.", [], "", "ValueError: wet")] * 2
    assert sum(r[1] != [] for r in got) == 1


def test_nothing_is_shuffled(spark):
    df = articles(spark)
    for out in (ex.with_nlp(df), ex.keywords(df, "link"), ex.summary(df, "link")):
        plan = io.StringIO()
        with redirect_stdout(plan):
            out.explain("formatted")
        assert "Exchange" not in plan.getvalue()
