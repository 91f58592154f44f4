"""Texts travel once into the tasks that need whole rows."""

import re

from clinlake.llm import langid, substring


def _columns_sent(df, function):
    plan = df._jdf.queryExecution().analyzed().toString()
    return re.search(rf"MapInArrow {function}\(([^)]*)\)", plan)[1]


def test_a_row_with_its_text_is_sent_without_a_second_copy(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [("en", f"{passage} first", 1), ("en", None, 2), ("en", f"{passage}  then\nmore", 3), (None, "12 34", 4)]
    docs = spark.createDataFrame(rows, "lang string, text string, doc_id long")
    cut = substring.remove_repeats(docs)
    got = {r["row"]["doc_id"]: (r["row"]["text"], r["kept"], r["n_words"], r["n_removed"], r["rest"]) for r in cut.collect()}
    assert got == {1: (rows[0][1], f"{passage} first", 26, 0, None), 2: (None, "", 0, 0, None),
                   3: (rows[2][1], "then more", 27, 25, "then\nmore"), 4: ("12 34", "12 34", 2, 0, None)}
    model = langid.train([b"the cat sat", b"le chat noir"] * 10, ["en", "fr"] * 10)
    named = langid.identify(docs, model)
    assert {r["row"]["doc_id"]: (r["lang_pred"] == "und", r["score"] > 0) for r in named.collect()} == {
        1: (False, True), 2: (True, False), 3: (False, True), 4: (True, False)}
    assert "text" not in _columns_sent(cut, "cut") and "text" not in _columns_sent(named, "predict")


def test_a_text_column_of_another_type_is_read_as_text(spark):
    docs = spark.createDataFrame([(1, 77), (2, None)], "doc_id long, text int")
    assert sorted((r["row"]["doc_id"], r["kept"]) for r in substring.remove_repeats(docs).collect()) == [(1, "77"), (2, "")]
