from __future__ import annotations

import json
import os

import pytest
from conftest import rows

from tillroll.sources import files, sinks


def test_config_and_sample_maps(spark, tmp_path):
    config = {"rfm": {"key": ["r", "f"], "format": ["values", "object"]}, "x": {"key": [], "format": []}}
    (tmp_path / "c.json").write_text(json.dumps(config, indent=2))
    catalogue = files.read_catalogue(spark, str(tmp_path / "c.json"))
    assert rows(catalogue) == [("rfm", "f", "object"), ("rfm", "r", "values")]
    assert files.catalogue_groups(catalogue) == {"rfm": [("r", "values"), ("f", "object")]}
    (tmp_path / "s.json").write_text(json.dumps({"茶": ["綠茶", "紅茶"], "空": []}, ensure_ascii=False))
    samples = files.read_sample_map(spark, str(tmp_path / "s.json"))
    assert {r["category"]: r["samples"] for r in samples.collect()} == {"茶": ["綠茶", "紅茶"], "空": []}


def test_text_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,name,n\n08,茶,1\n09,\"a,b\",2\n")
    got = files.read_csv(spark, str(tmp_path / "a.csv"), "code string, name string, n int", ["code", "n"])
    assert rows(got) == [("08", 1), ("09", 2)]  # codes keep their zeros
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "a.csv"), "code string", ["other"])
    (tmp_path / "i.csv").write_text(",name\n0,a\n1,b\n")
    assert rows(files.read_indexed_csv(spark, str(tmp_path / "i.csv"), "name string")) == [("a",), ("b",)]
    (tmp_path / "l.txt").write_text("咖啡 大杯\nx,y\n")
    assert rows(files.read_lines(spark, str(tmp_path / "l.txt"))) == [("x,y",), ("咖啡 大杯",)]
    (tmp_path / "w.txt").write_text("咖啡   1\n\n  茶\n")
    assert rows(files.read_first_words(spark, str(tmp_path / "w.txt"))) == [("咖啡",), ("茶",)]
    (tmp_path / "p.csv").write_text("a|b\n1|2\n")
    assert rows(files.read_csv(spark, str(tmp_path / "p.csv"), "a int, b int", sep="|")) == [(1, 2)]


def test_glob_takes_category_from_the_path(spark, tmp_path):
    for c in ("茶", "coffee"):
        (tmp_path / c).mkdir()
        (tmp_path / c / f"{c}_Cluster_12.csv").write_text("name,num\nx,1\n")
    got = files.read_glob(spark, f"{tmp_path}/*/*_Cluster_*.csv", "name string, num int", "/([^/]+)/[^/]+$")
    assert rows(got, "category") == [("x", 1, "coffee"), ("x", 1, "茶")]


def test_numbers(spark):
    df = files.numbers(spark)
    assert (df.count(), df.agg({"n": "max"}).first()[0]) == (10_000, 10_000)


def test_run_paths():
    assert sinks.run_path("/x/", True, "t") == "/x/"
    assert sinks.run_path("/x/", False, "20240101_000000") == "/x/run_ts=20240101_000000"


def test_group_folders_and_keyword_map(spark, tmp_path):
    df = spark.createDataFrame([("a", 0), ("b", 1)], "mid string, label int")
    sinks.write_groups(df, df, str(tmp_path / "g"))
    assert (tmp_path / "g" / "detail" / "label=0").is_dir()
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "g" / "detail"))) == [("a", 0), ("b", 1)]
    words = spark.createDataFrame([("c", "x", 1), ("c", "y", 5), ("c", "z", 3)], "category string, name string, num long")
    sinks.write_keyword_map(words, str(tmp_path / "k"), n=2)
    got = spark.read.json(str(tmp_path / "k")).first()
    assert (got["name"], got["num"]) == (["y", "z"], [5, 3])


def test_durable_dir_needs_a_shared_folder_on_a_cluster():
    from tillroll import session

    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" and self.master else default

    for master in ("yarn", None):  # an unknown master may be a cluster
        fake = type("Fake", (), {"conf": Conf(master)})()
        with pytest.raises(ValueError):
            session.durable_dir(fake)
        assert not session.is_local(fake)


def test_release_deletes_what_a_run_wrote(spark):
    from tillroll import session

    session.release(spark)
    kept = session.materialize(spark.range(5))
    folder = kept.inputFiles()[0].rpartition("/")[0].removeprefix("file:").replace("//", "")
    assert os.path.isdir(folder) and kept.count() == 5
    assert session.release(spark) == 1 and not os.path.exists(folder) and session.release(spark) == 0


def test_small_is_bounded_in_rows_and_bytes(spark):
    from tillroll import session

    def local(df):
        return "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()

    texts = spark.range(50).selectExpr("id", "repeat('x', 1000) AS t")
    assert local(session.small(texts)) and session.small(texts).count() == 50
    for bounded in (session.small(texts, max_rows=49), session.small(texts, max_bytes=40_000)):
        assert not local(bounded) and bounded.count() == 50
    assert local(session.small(spark.range(50))) and not local(session.small(spark.range(50), max_rows=49))


def test_texts_survive_csv(spark, tmp_path):
    texts = ["", None, "  x  ", 'a "q", b', '"', "one\r\ntwo\rthree\n", "\\", "\\ n", "é|,", "\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for sep in (",", "|"):
        sinks.write_csv(df, str(tmp_path / "t"), sep=sep)
        back = files.read_csv(spark, str(tmp_path / "t"), "i int, t string", sep=sep, own=True)
        assert {r["i"]: r["t"] for r in back.collect()} == dict(enumerate(texts))


def test_large_sample_maps_are_many_bounded_lines(spark, tmp_path):
    data = [("a", f"name {i}") for i in range(950)] + [("b", "x\ny"), ("b", "x\ny"), ("a/b", "é"), (None, "lost")]
    df = spark.createDataFrame(data, "category string, sample string")
    sinks.write_sample_map(df, str(tmp_path / "m"), chunk=100)
    back = files.read_sample_map(spark, str(tmp_path / "m"), lines=True).collect()
    assert len(back) > 9 and max(len(r["samples"]) for r in back) < 200
    assert sorted((r["category"], x) for r in back for x in r["samples"]) == sorted(set(data[:-1]))
