import pytest
import os
import tempfile

from raremine.sources import files as FS
from raremine.sources.bundle import load_bundle, save_bundle


def test_email_files_whole_text(spark):
    d = tempfile.mkdtemp(prefix="raremine-mail-")
    with open(os.path.join(d, "m1.txt"), "w") as f:
        f.write("From: a\nX-FileName: x\nline one\nline two\n")
    df = FS.read_email_files(spark, d).collect()
    assert len(df) == 1 and df[0].value.count("\n") == 4


def test_email_index_names(spark):
    d = tempfile.mkdtemp(prefix="raremine-index-")
    with open(os.path.join(d, "from_a.b@x.com.txt"), "w") as f:
        f.write("mail_box/maildir/doe-j/sent/1.\nmail_box/maildir/doe-j/sent/2.\n")
    with open(os.path.join(d, "to_c@y.com"), "w") as f:
        f.write("mail_box/maildir/c/inbox/x/7.\n")
    rows = sorted((r.direction, r.address, r.n_parts) for r in FS.read_email_index(spark, d).collect())
    assert rows == [("from", "a.b@x.com", 5), ("from", "a.b@x.com", 5), ("to", "c@y.com", 6)]


def test_poi_names(spark):
    lines = spark.createDataFrame([("http://example/list",), ("",), ("(y) Roe, Ann",), ("(n) Doe, J",)], "value string")
    rows = [(r.flag, r.last, r.first) for r in FS.parse_poi_names(lines).orderBy("last").collect()]
    assert rows == [("n", "Doe", "J"), ("y", "Roe", "Ann")]


def test_poi_addresses_fused_pair_split(spark):
    df = FS.poi_address_frame(spark, ["a@example.org", "'b@example.org'", "c@example.orgd@mail.net"])
    assert sorted(r.address for r in df.collect()) == ["a@example.org", "b@example.org", "c@example.org", "d@mail.net"]


def test_records_roundtrip(spark):
    df = spark.createDataFrame([("p", 1.5, None)], "id string, x double, y double")
    recs = FS.frame_to_records(df)
    back = FS.records_to_frame(recs, ["x", "y", "z"], types={"x": "double"}).first()
    assert back.x == 1.5 and back.y == "NaN" and back.z is None


def test_bundle_roundtrip(spark):
    from raremine.operators import learners as L
    df = spark.createDataFrame([(f"r{i}", float(i % 2), float(i), float(i % 3)) for i in range(20)],
                               "id string, label double, a double, b double")
    model = L.make_estimator("gaussian_nb").fit(L.assemble(df, ["a", "b"]))
    path = save_bundle(spark, model, df, ["label", "a", "b"], name="test_gnb")
    clf, data, feats = load_bundle(spark, path)
    assert feats == ["label", "a", "b"] and data.count() == 20
    assert clf.transform(L.assemble(data, feats[1:])).count() == 20


def test_addresses_stay_whole_unless_fused(spark):
    raw = ["x@foo.company.com", "y@mail.com.au", "'z@a.org.uk'", "a@b.comc@d.net", "p@q.com; r@s.edu", " "]
    df = spark.createDataFrame([(a,) for a in raw], "address string")
    want = ["a@b.com", "c@d.net", "p@q.com", "r@s.edu", "x@foo.company.com", "y@mail.com.au", "z@a.org.uk"]
    assert sorted(r.address for r in FS.normalize_addresses(df).collect()) == want
    assert sorted(r.address for r in FS.poi_address_frame(spark, raw[:-1]).collect()) == want


def test_checkpoint_folder_must_be_given_on_a_cluster(spark, monkeypatch):
    from raremine import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    fake = type("S", (), {"sparkContext": Context(), "conf": {}})()
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake)
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
