"""Language identification on clear samples and on defined edge cases."""

import random

import pytest

from claimwright.llm import language

WORDS = {
    "en": "the and with that this which from have would their about there".split(),
    "de": "und der die nicht mit eine auch sich werden über können für".split(),
    "fr": "les des une dans pour avec est pas être où été français".split(),
    "es": "los una para con que está más también cómo español año pero".split(),
    "xx": "qwa zzu kkrr vvo xxqi wwja qqzz krv zuvv".split(),
}


def rows_of(count, seed=1):
    rng = random.Random(seed)
    langs = sorted(WORDS)
    return [
        (i, " ".join(rng.choice(WORDS[langs[i % 5]]) for _ in range(rng.randint(5, 60))), langs[i % 5])
        for i in range(count)
    ]


@pytest.fixture(scope="module")
def model(spark):
    rows = rows_of(200) + [(900, None, "en"), (901, "123 !!", "en"), (None, "the the", "zz"), (902, "und", None)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_families_and_planes(model):
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "other": ["xx"]}
    assert set(model.planes) == {("germanic",), ("romance",), ("other",), ("de", "en"), ("es", "fr")}
    assert language.family_of("pt-BR") == "romance" and language.family_of("tlh") == "other"


def test_predictions(spark, model):
    rows = rows_of(100, seed=2)
    docs = spark.createDataFrame([(*r, "s", 1.0) for r in rows], "doc_id long, text string, lang_pred string, lang string, score double")
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang and 0 < got[i].score <= 1 for i, _, lang in rows)


def test_edge_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "12 -- 34 ² ½"), (4, "ß"), (None, "the and with that"), (5, "und " * 200_000), (5, "und")]
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by_id[1].score == 0
    assert by_id[4].lang_pred != "und" and by_id[None].lang_pred == "en" and len(got) == 7
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert language.identify(empty, model).count() == 0


def test_one_or_no_language(spark):
    docs = spark.createDataFrame([(1, "abc", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    one = language.identify(docs, language.fit(docs)).collect()
    assert [r.lang_pred for r in one] == ["en", "und"]
    none = language.identify(docs, language.fit(docs.limit(0))).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)] * 2
