"""Settings the environment gives are kept; only a plain local run gets defaults."""

from edgefilter.session import session_conf


def test_preset_master_and_partitions_stay():
    conf = session_conf({"spark.master": "yarn", "spark.sql.shuffle.partitions": "4000",
                         "spark.sql.adaptive.enabled": "true"})
    assert not {"spark.master", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"} & set(conf)
    assert "spark.sql.shuffle.partitions" not in session_conf({"spark.master": "yarn"})


def test_plain_local_run_gets_local_defaults():
    conf = session_conf({})
    assert conf["spark.master"] == "local[8]" and conf["spark.sql.shuffle.partitions"] == "8"
    assert session_conf({}, "local[2]", 16, {"a": "b"}) | {"a": "b"} == session_conf({}, "local[2]", 16, {"a": "b"})
