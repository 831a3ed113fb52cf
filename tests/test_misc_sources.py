"""Profile scan, id-or-handle parse, unresolvable allow-list, page titles."""

import tempfile

import pytest

from helpers import SF001, rows
from vetline.functions import text as tx
from vetline.plans import reports
from vetline.sources import allowlist, fixtures as fx
from vetline.sources.profile import load_profile


def _file(text):
    f = tempfile.NamedTemporaryFile("w", suffix=".md", delete=False, encoding="utf-8")
    f.write(text)
    f.close()
    return f.name


def test_load_profile(spark):
    assert load_profile(spark, _file("\n  # Profile\nline two\n\n")) == "# Profile\nline two"
    with pytest.raises(RuntimeError):
        load_profile(spark, _file(" \n\t "))


def test_parse_channel(spark):
    df = spark.createDataFrame([(" -100123 ",), ("42",), ("@chan",), ("-abc",), ("me",)], "raw string")
    got = [r["p"] for r in rows(df.select(tx.parse_channel("raw").alias("p")))]
    assert [(g["chat_id"], g["username"], g["valid"]) for g in got] == [
        (-100123, None, True), (42, None, True), (None, "@chan", True), (None, None, False), (None, "me", True)]


def test_resolve_requires_one(spark):
    srcs = allowlist.normalize_entries(spark.createDataFrame([(0, '"@nobody"')], "pos long, entry string"))
    with pytest.raises(RuntimeError):
        allowlist.resolve(srcs, fx.fx_directory(spark, SF001), require_any=True)


def test_list_page_title(spark):
    ch = fx.fx_channels(spark, SF001)
    assert rows(reports.list_page_title(ch, "posted"))[0]["title"] == "Posted matches"
    assert rows(reports.list_page_title(ch, "bogus", 1))[0]["title"] == "CUSTOMER#000000001 (@u1) · All messages"
    assert rows(reports.list_page_title(ch, "vacancies", 999999))[0]["title"] == "Vacancies"


def test_list_page_titles_equal_single_title(spark):
    from vetline.plans import reports
    ch = spark.createDataFrame([(5, "u5", "Five", None), (6, None, "", None)],
                               "chat_id long, username string, title string, last_msg_ts long")
    allt = {(r["chat_id"], r["filter_type"]): r["title"] for r in rows(reports.list_page_titles(ch))}
    assert len(allt) == 2 * len(reports.FILTER_TYPES)
    for (cid, ft), title in allt.items():
        assert title == rows(reports.list_page_title(ch, ft, cid))[0]["title"]
    assert allt[(6, "posted")] == "? · Posted matches"


def test_checkpoint_root_refuses_machine_local_folder_on_a_cluster():
    from vetline import session

    class Conf:
        def __init__(self, d):
            self.d = d

        def get(self, key, default=None):
            return self.d.get(key, default)

    class Ctx:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Spark:
        def __init__(self, master, conf):
            self.sparkContext, self.conf = Ctx(master), Conf(conf)

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Spark("spark://cluster:7077", {}))
    shared = Spark("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert session.checkpoint_root(shared) == "hdfs://nn/ckpt"
    assert session.checkpoint_root(Spark("local[2]", {})).startswith("/")
