import pytest
from pyspark.sql import functions as F

from raremine.functions import text as TX
from raremine.functions.stem import stem
from raremine.operators import text as TO


@pytest.mark.parametrize("word,expected", [
    ("running", "run"), ("generously", "generous"), ("consignment", "consign"), ("happiness", "happi"),
    ("relational", "relat"), ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("agreed", "agre"),
    ("hopping", "hop"), ("filing", "file"), ("sky", "sky"), ("dying", "die"), ("generalization", "general"),
    ("oscillators", "oscil"), ("knightly", "knight"), ("a", "a")])
def test_porter2(word, expected):
    assert stem(word) == expected


SNOWBALL_SAMPLE = ("consist consist consisted consist consistency consist consistently consist consolation consol "
                   "consolatory consolatori consoled consol consolidate consolid consolingly consol consonant conson "
                   "conspicuous conspicu conspiracy conspiraci conspirators conspir constable constabl constancy "
                   "constanc knackeries knackeri knavish knavish kneaded knead kneeling kneel knelt knelt knightly "
                   "knight knitting knit knives knive knocker knocker").split()


def test_porter2_snowball_sample():
    pairs = list(zip(SNOWBALL_SAMPLE[::2], SNOWBALL_SAMPLE[1::2]))
    assert [stem(w) for w, _ in pairs] == [e for _, e in pairs]


def test_body_functions(spark):
    df = spark.createDataFrame([(1, "hdr\nX-FileName: f.nsf\nHello, world!  It's  me."),
                                (2, "no marker here"), (3, "a X-FileName: b X-FileName: c")], "id int, v string")
    out = {r.id: r for r in df.select("id", TX.after_marker(F.col("v")).alias("b")).collect()}
    assert out[1].b == " f.nsf\nHello, world!  It's  me." and out[2].b is None and out[3].b == " b "
    words = df.select(TX.split_ws(TX.strip_punct(TX.after_marker(F.col("v")))).alias("w")).first().w
    assert words == ["fnsf", "Hello", "world", "Its", "me"]


def test_stem_join_keeps_order_and_empty(spark):
    df = spark.createDataFrame([(1, "Running dogs"), (2, "")], "doc_id int, body string")
    out = {r.doc_id: r.stemmed for r in TO.stem_join(df).collect()}
    assert out == {1: "run dog", 2: ""}


def test_tfidf_rows_are_unit_and_fit_on_train(spark):
    docs = spark.createDataFrame([(1, "apple banana apple", True), (2, "banana cherry", True),
                                  (3, "cherry date", True), (4, "apple zebra", False)],
                                 "doc_id int, text string, is_train boolean")
    post = TO.tfidf(docs, max_df=0.9).toPandas()
    norms = post.assign(w2=post.w ** 2).groupby("doc_id").w2.sum()
    assert all(abs(v - 1) < 1e-12 for v in norms)
    assert "zebra" not in set(post.term)          # unseen in training


def test_text_model_on_later_documents(spark):
    """Fitted once, saved, loaded: held-out documents get the weights of the
    one-pass result; documents of other vocabularies and empty ones get none."""
    from pyspark.sql import functions as F

    from raremine.operators import text as TO
    from raremine.session import scratch_path

    texts = ["red apple pie", "red wine red", "green apple tree", "blue sky apple", "red red red pie", "tall green tree tree", "apple", ""]
    rows = [(i, t, float(i % 2), i < 6) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label double, is_train boolean")
    whole = {(r.doc_id, r.term): r.w for r in TO.tfidf(docs).filter("doc_id >= 6").collect()}
    path = scratch_path(spark, "text-model")
    TO.TextModel.fit(docs.filter("is_train"), path, percent=40.0)
    model = TO.TextModel.load(spark, path)
    got = {(r.doc_id, r.term): r.w for r in model.transform(docs.filter("not is_train")).collect()}
    assert got == whole and set(got) == {(6, "apple")}
    kept = {r.term for r in model.terms.filter("selected").collect()}
    assert 0 < len(kept) < model.terms.count()
    train = model.transform(docs.filter("is_train"))
    assert {r.term for r in model.transform(docs.filter("is_train"), selected=True).collect()} == kept
    norms = train.groupBy("doc_id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms)
    strange = spark.createDataFrame([(1, "nothing known"), (2, None)], "doc_id long, text string")
    assert model.transform(strange).count() == 0
