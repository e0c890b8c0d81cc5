from types import SimpleNamespace

from hitscope.plans import shared_path


def _session(folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
    )


def test_paths_lie_in_the_folder_the_cluster_names():
    session = _session("hdfs:///shared/")
    first, second = shared_path(session, "log"), shared_path(session, "log")
    assert first.startswith("hdfs:///shared/hitscope/log-")
    assert first != second


def test_the_warehouse_stands_in(tmp_path):
    conf = SimpleNamespace(get=lambda key, default: "hdfs:///warehouse" if key == "spark.sql.warehouse.dir" else default)
    assert shared_path(SimpleNamespace(conf=conf), "log").startswith("hdfs:///warehouse/hitscope/log-")


def test_the_setting_is_read_from_a_real_session(spark):
    assert shared_path(spark, "log").startswith(spark.conf.get("spark.checkpoint.dir"))
