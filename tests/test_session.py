import pytest

from dimfold.session import ensure_checkpoint_dir, shared_dir
from dimfold.plans.inspect import exchanges
from dimfold.sources.tables import read_table

from conftest import SF_SMALL, SF_TINY


def test_shared_dir_lives_under_the_session_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    configured = spark.sparkContext.getCheckpointDir()
    assert configured and base == configured           # the session's setting is used, not replaced
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


def test_tables_are_read_without_a_shuffle_at_any_size(spark):
    for sf in (SF_TINY, SF_SMALL, "/root/testdata/sf0.1"):
        li = read_table(spark, sf, "lineitem", ["l_orderkey"])
        assert li.columns == ["l_orderkey"] and exchanges(li) == 0


def test_no_shared_folder_on_a_cluster_is_an_error(monkeypatch):
    from types import SimpleNamespace

    from dimfold import session

    sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))
