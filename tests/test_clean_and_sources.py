import datetime as dt

from pyspark.sql import functions as F

from edgefilter.operators.clean import change_event_skips, clean_edits, normalize_change_events
from edgefilter.schemas import EDIT_SCHEMA, RAW_CHANGE_SCHEMA
from edgefilter.sources import files as FS
from edgefilter.streaming.parse import parse_edit_json


def test_clean_fills_and_types(spark):
    rows = [(1, "t", None, None, -7, "enwiki", "2024-10-25 23:59:59", None, None)]
    c = clean_edits(spark.createDataFrame(rows, EDIT_SCHEMA)).first()
    assert (c.bot, c.length, c.minor, c.comment, c.comment_length, c.label) == (False, 7, False, "", 0, 0.0)
    assert c.labelled is False
    assert c.timestamp == dt.datetime(2024, 10, 25, 23, 59, 59) and c.date == dt.date(2024, 10, 25)
    assert c.hour == 23


def test_normalize_change_events(spark):
    raw = [
        (1, "edit", "en.wikipedia.org", "A, b", "u,1", False, "enwiki", True, "c,d", 1729814400, (10, 4)),
        (2, "edit", "fr.wikipedia.org", "x", "u2", False, "frwiki", False, "", 1729814400, (1, 1)),
        (3, "log", "de.wikipedia.org", "x", "u3", False, "dewiki", False, "", 1729814400, (1, 1)),
        (4, "edit", "de.wikipedia.org", "x", "u4", True, "dewiki", False, "z", 1729900799, (5, 7)),
        (5, "edit", "de.wikipedia.org", "x", "u5", True, "dewiki", False, "z", 1729900799, (5, None)),
        (6, "edit", "de.wikipedia.org", "x", None, True, "dewiki", False, "z", 1729900799, (5, 7)),
    ]
    df = spark.createDataFrame(raw, RAW_CHANGE_SCHEMA)
    # 5 and 6 lack a required field: skipped, and counted
    assert tuple(change_event_skips(df).first()) == (2, 2)
    out = {r.id: r for r in normalize_change_events(df).collect()}
    assert sorted(out) == [1, 4]
    assert (out[1].title, out[1].user, out[1].comment, out[1].length) == ("A b", "u1", "cd", 6)
    assert out[1].timestamp == "2024-10-25 00:00:00"
    assert out[4].timestamp == "2024-10-25 23:59:59" and out[4].length == -2
    assert [r.id for r in normalize_change_events(df, since="2024-10-25 12:00:00").collect()] == [4]


def test_parse_objects_arrays_garbage(spark):
    lines = [
        '{"id": 1, "user": "a", "bot": true}',
        '[{"id": 2, "user": "b"}, {"id": 3, "user": "c", "length": 5}]',
        "not json at all",
        None,
        '{"id": "x", "user": "d"}',
        "{}",
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [(r.id, r.user) for r in parse_edit_json(df).collect()]
    assert (None, "d") in got                    # wrong type: only that field is NULL
    assert (None, None) in got                   # missing fields: all NULL
    assert sorted(g for g in got if g[0] is not None) == [(1, "a"), (2, "b"), (3, "c")]
    assert len(got) == 5


def test_csv_roundtrip_quotes_newlines_empty(spark, tmp_path):
    rows = [(1, 'say "hi"', "u", True, 1, "w", "2024-01-01 00:00:00", False, "line1\nline2, x"),
            (2, "", None, None, None, "w", None, None, None)]
    df = spark.createDataFrame(rows, EDIT_SCHEMA)
    p = str(tmp_path / "csv")
    FS.write_edits_csv(df, p)
    back = {r.id: r for r in FS.read_edits_csv(spark, p).collect()}
    assert back[1].title == 'say "hi"' and back[1].comment == "line1\nline2, x"
    # the CSV hop turns an empty string into NULL; clean_edits repairs it
    assert back[2].title is None and back[2].user is None


def test_csv_tenth_column_is_ignored(spark, tmp_path):
    p = tmp_path / "ten"
    p.mkdir()
    (p / "part.csv").write_text('7,t,u,false,3,w,2024-01-01 00:00:00,true,c,12345\n')
    r = FS.read_edits_csv(spark, str(p)).first()
    assert (r.id, r.comment, r.minor) == (7, "c", True)


def test_pageview_flatten_edge_cases(spark, tmp_path):
    p = tmp_path / "pv"
    p.mkdir()
    (p / "a.json").write_text(
        '{"items": [{"articles": [{"article": "Main_Page"}, {"article": ""}]}, {"articles": []}]}\n'
        '{"items": [{"articles": [{"article": "main_page"}, {"article": "Other_One"}]}]}\n')
    flat = FS.read_pageviews(spark, str(p))
    assert flat.count() == 4
    names = sorted(r.name for r in FS.normalize_article_names(flat).collect())
    assert names == ["main page", "other one"]


def test_edits_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, "u", None, 2, "w", "t", True, "a\nb")], EDIT_SCHEMA)
    v = FS.edits_to_json(df).first().value
    assert '"title":null' in v and '"comment":"a\\nb"' in v
    back = parse_edit_json(spark.createDataFrame([(v,)], "value string")).first()
    assert back.comment == "a\nb" and back.title is None


def test_user_sample_is_per_user_and_about_20_percent(spark):
    from edgefilter.plans.q_sources import user_sample
    users = spark.range(0, 20000).select(F.concat(F.lit("user"), F.col("id").cast("string")).alias("user"))
    frac = user_sample(users).count() / 20000
    assert 0.18 < frac < 0.22
    ev = spark.range(0, 3000).select((F.col("id") % 300).cast("string").alias("user"), "id")
    s = user_sample(ev).groupBy("user").count()
    assert s.filter(F.col("count") != 10).count() == 0   # all or none of a user's rows
    nulls = spark.createDataFrame([(None,)], "user string")
    assert user_sample(nulls).count() == 0


def test_exploratory_stage_keeps_minor_nullable(spark):
    rows = [(1, "t", "u", True, 1, "w", "2024-01-01 00:00:00", None, "c")]
    df = spark.createDataFrame(rows, EDIT_SCHEMA)
    assert clean_edits(df, fill_minor=False).first().minor is None
    assert clean_edits(df).first().minor is False


def test_bad_timestamps_become_null_not_errors(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = [(1, "t", "u", True, 1, "w", "garbage", True, "c"),
            (2, "t", "u", True, 1, "w", "2024-13-45 99:00:00", True, "c"),
            (3, "t", "u", True, 1, "w", "2024-02-29 23:59:59", True, "c")]
    got = {r.id: (r.timestamp, r.date, r.hour)
           for r in clean_edits(spark.createDataFrame(rows, EDIT_SCHEMA)).collect()}
    assert got[1] == (None, None, None) and got[2] == (None, None, None)
    assert got[3] == (dt.datetime(2024, 2, 29, 23, 59, 59), dt.date(2024, 2, 29), 23)
