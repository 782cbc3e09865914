import pytest

from maskwright.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return language.fit(docs.where(~language.held_out()))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where(language.held_out())
    rows = language.predict(docs, model).collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert sum(r.rejected for r in rows) / len(rows) < 0.01
    assert all(0 <= r.score <= 1 for r in rows) and model.centroids.shape[0] == 16


def test_odd_texts(spark, model):
    rows = [(None, "x"), ("", "x"), ("123 !? \n", "x"), ("ωραίος καιρός σήμερα και αύριο θα βρέξει πολύ στην πόλη", "x"),
            ("漢字だけの長い文章をここに書いてみる。" * 5, "x"), ("the and of in " * 100_000, "x")]
    df = spark.createDataFrame(rows, "text string, lang_pred string")
    found = language.predict(df, model).collect()
    assert [r.lang_pred for r in found[:3]] == ["und"] * 3 and [r.score for r in found[:3]] == [0.0] * 3
    assert [r.rejected for r in found] == [True] * 5 + [False], [(r.score, model.least) for r in found]
    assert found[5].lang_pred == "en" and found[0].asDict().keys() == {"text", "lang_pred", "score", "rejected"}
    assert language.predict(df.limit(0), model).count() == 0


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    empty = language.fit(df)
    assert [(r.lang_pred, r.score, r.rejected) for r in language.predict(df, empty).collect()] == [("und", 0.0, True)]
    one = language.fit(spark.createDataFrame([(1, "abc abd", "q"), (1, "abc abd", "q"), (2, None, "z"), (3, "12", "z")],
                                             "doc_id bigint, text string, lang string"))
    assert one.languages == ["q"]


def test_prediction_does_not_depend_on_neighbours(model):
    texts = ["le la de", None, "the of and", "", "der die das und"]
    alone = [model.judge([t])[0][0] for t in texts]
    assert model.judge(texts)[0] == alone and model.judge([])[0] == []


def test_languages_of_many_copies_or_nulls_give_all_their_texts(spark):
    """The rate goes by distinct texts with a letter: with three of them each language has a centroid for every text."""
    texts = spark.createDataFrame([("der hund und die katze",), ("le chat et le chien",), ("the cat and a dog",)], "text string")
    copied = texts.crossJoin(spark.range(1_000)).selectExpr("'copied' lang", "text")
    nulls = spark.range(5_000).selectExpr("'null' lang", "if(id % 3 = 0, null, concat(id, '!')) text").unionByName(
        texts.selectExpr("'null' lang", "text"))
    model = language.fit(copied.unionByName(nulls).unionByName(texts.selectExpr("'once' lang", "text")), sample=100)
    assert model.languages == [k for k in ("copied", "null", "once") for _ in range(3)]
