import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) >= {"tp", "fp", "tn", "fn", "precision", "recall"}


def test_every_oracle_key_is_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_no_query_caps_its_input():
    import inspect
    from edgefilter.plans import q_bloom, q_knn, q_model, q_profile, q_sources, q_stream
    for mod in (q_bloom, q_knn, q_model, q_profile, q_sources, q_stream):
        src = inspect.getsource(mod)
        assert ".sample(" not in src or mod is q_sources   # only the sampling operator samples


def test_coverage_map_names_every_query():
    import os
    import re
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "COVERAGE.md")) as f:
        text = f.read()
    named = set(re.findall(r"`([a-z0-9_]+)`", text))
    missing = [q for q in E.queries() if q not in named and not any(
        q.startswith(p.rstrip("*")) for p in re.findall(r"`([a-z_]+\*)`", text))]
    assert missing == []
