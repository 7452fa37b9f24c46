import numpy as np
import pytest

from quillstone.llm import reading

BANK = {
    1: "we saw the form it is big they like the cash no one was sad now you wait".split(), 2: "company shares sold market page list owner paid each people news rest".split(), 3: "quarterly revenue growth insiders purchase analysts reported holdings exercise trading".split(),
    4: "pursuant vesting disclaims beneficial ownership withholding fiduciary pecuniary thereof aggregate".split(), 5: "heteroscedasticity epistemologically counterfactual endogenous nonparametric asymptotic covariance degenerates".split(),
}


def text(rng, level, n=60):
    """Mostly words of the level, some of the levels below."""
    return " ".join(str(rng.choice(BANK[level if rng.random() < 0.7 else int(rng.integers(1, level + 1))])) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(0)
    rows = [(i, text(rng, 1 + i % 5), "en" if i % 3 else None, "own") for i in range(400)]
    extra = [
        (900, None, None, None), (901, "", "en", None), (902, "   ", "en", None), (903, "ticker,date,close\n" + "AB,2024-01-01,1.5\n" * 60, "en", None), (904, "Der Vorstand verkaufte gestern sehr viele Aktien ohne weitere Angaben " * 6, None, None),
        (905, text(rng, 5), "fr", None), (906, text(rng, 5, 20), "en", None), (907, "<p>" + text(rng, 5).replace(" ", "&nbsp;\n", 5).replace("asymptotic", "asymp​totíc") + "</p>", "EN-us", None), (908, text(rng, 4, 40_000), None, None), (909, text(rng, 5).upper(), "en", None),
    ]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, level string")
    labels = spark.createDataFrame([(i, 1 + i % 5) for i in range(0, 400, 4)] + [(0, 1), (777_777, 3), (None, 2), (12, None)], "doc_id long, reading_level int")
    return docs, labels


def test_held_out_levels_and_prose(corpus):
    docs, labels = corpus
    model = reading.fit(docs, labels)
    got = {r.doc_id: r for r in reading.levels(docs, model).collect()}
    held_out = [i for i in range(400) if i % 4]
    assert np.mean([got[i].level == 1 + i % 5 for i in held_out]) > 0.95
    assert all(got[i].english_prose for i in held_out)
    assert [i for i in range(900, 910) if got[i].english_prose] == [907, 908, 909]
    assert got[907].level == 5 and got[908].level == 4 and got[909].level == 5
    assert all(got[i].score is None and got[i].level is None and got[i].n_words == 0 for i in (900, 901, 902))
    again = {r.doc_id: r.score for r in reading.levels(docs.repartition(7), reading.fit(docs.repartition(3), labels)).collect()}
    assert all(abs((again[i] or 0) - (got[i].score or 0)) < 1e-6 for i in got)


def test_calibration_is_not_fitted_on_the_texts_that_graded_the_words(spark):
    """Labels without any relation to the words: grades learnt from a text itself would seem to explain them, grades of other folds must not."""
    rng = np.random.default_rng(5)
    pool = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ab", "eb", "ib", "ob", "ub", "ad", "ed", "id", "od", "ud")]
    rows = [(i, " ".join(str(w) for w in rng.choice(pool, 25)), None) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(rng.integers(1, 6))) for i in range(150)], "doc_id long, reading_level int")
    scores = np.array([r.score for r in reading.levels(docs, reading.fit(docs, labels)).collect()])
    assert scores.std() < 0.5 and 2 < scores.mean() < 4


def test_sample_is_bounded_and_nothing_to_learn_is_fine(corpus, spark):
    docs, labels = corpus
    assert len(reading.fit(docs, labels, max_labelled=1, min_texts=1).grades) < 40
    none = reading.fit(docs, labels.limit(0))
    assert none.grades == {} and reading.levels(docs, none).filter("level is not null").count() == 0
    assert reading.levels(docs.limit(0), none).count() == 0 and reading.fit(docs.limit(0), labels).grades == {}


def test_grades_of_plain_distributions():
    g = reading.grade(np.array([[1.0, 0, 0, 0, 0], [0, 0, 0, 0, 1.0], [1, 1, 1, 1, 1], [1, 1, 0, 0, 0]]))
    assert g.tolist() == pytest.approx([1.0, 5.0, 3.0, 1.5])


def test_words():
    assert reading.words("<b>Théy don’t</b> sell&amp;buy 3 AB­C!")[0] == ["they", "don't", "sell", "buy", "abc"]
    assert reading.words("<a " + "title='pecuniary thereof' " * 400 + ">see</a><!-- not\n this --> if 2 < 3 they > we")[0] == ["see", "if", "they", "we"]
    assert reading.words(None) == ([], 0.0) and reading.words(" \n")[0] == []
