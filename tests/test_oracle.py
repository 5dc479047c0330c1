"""Every registered query against its DuckDB oracle on the smallest test tables."""
import pytest

import __spark_entry__ as E
from voltaic.plans import oracle as O
from voltaic.plans.catalog import ORACLE, QUERIES
from oracle_check import canon, con_for
from conftest import SF_SMALL


# model keys need a non-empty training split: sf0.001 has one complete row
MODEL = {"scored_keys", "model_roundtrip", "validation_counts", "stream_scored_windows", "imputed_medians"}
#: Forest numbers have no SQL form; each stands beside the same number made from the forest's nodes.
TWICE = {"train_rf", "feature_importance", "score_rows", "validation_sweep", "evaluate_best_on_test", "train_rf_imputed",
         "stream_scores"}
SF_MODEL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return con_for(SF_SMALL)


def test_every_query_has_an_oracle_or_a_second_way():
    assert set(QUERIES) - set(ORACLE) == TWICE | {"forest_nodes"}


@pytest.mark.parametrize("name", sorted(TWICE))
def test_forest_numbers_made_twice(spark, name):
    rows = QUERIES[name](spark, SF_MODEL).collect()
    assert rows and all(r["same"] is True for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    folder = SF_MODEL if name in MODEL else SF_SMALL
    got = QUERIES[name](spark, folder).toPandas()
    want = (con_for(SF_MODEL) if name in MODEL else con).sql(ORACLE[name]).df()
    assert len(got) == len(want) and (name not in MODEL or len(got))
    gc, gr = canon(got, 6)
    wc, wr = canon(want, 6)
    assert gc == wc
    assert gr == wr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["vehicle_id", "time"]
    assert df.count() == 22


@pytest.mark.parametrize("name", ["split_rank", "split_time_3way", "repair_time", "stream_windows", "window_pivot",
                                  "load_folder", "stream_expiry", "stream_state", "lookahead_horizon", "split_purged",
                                  "window_incremental", "clustered_slice"])
def test_zone_independent(spark, con, name):
    """The same answers under a session zone with daylight saving time."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = QUERIES[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = con.sql(ORACLE[name]).df()
    assert canon(got, 6) == canon(want, 6)


def test_queries_take_the_whole_path(spark, con, monkeypatch):
    """Sources by folder and the K2 output, part files of three kinds, NULL keys and values among the copies."""
    from voltaic.sources import files as fs
    from voltaic.sources import raw as rw

    scanned, written, loaded = [], [], []
    scan, write, load = rw.sources_from_files, fs.write_dataset, fs.load_folder
    monkeypatch.setattr(rw, "sources_from_files", lambda s, f: scanned.append(sorted(f)) or scan(s, f))
    monkeypatch.setattr(fs, "write_dataset", lambda df, path, **kw: written.append((df.columns, kw)) or write(df, path, **kw))
    monkeypatch.setattr(fs, "load_folder", lambda s, path: loaded.append(path) or load(s, path))
    for name in ("normalize_sources", "row_accounting"):
        rows = QUERIES[name](spark, SF_SMALL)
        assert rows.inputFiles() and all("/normalized-" in f and "/source=SRC_" in f for f in rows.inputFiles())
    assert scanned == [["SRC_A", "SRC_N", "SRC_R"]] * 2
    assert [kw.get("partition_by") for _, kw in written] == [["source"]] * 4 and "corrected" in written[1][0]

    QUERIES["load_folder"](spark, SF_SMALL)
    parts = {tuple(spark.read.parquet(f).dtypes) for f in spark.read.parquet(loaded[0]).inputFiles()}
    assert {dict(p)["time"] for p in parts} == {"string", "timestamp_ntz"} and len({len(p) for p in parts}) == 2

    (keys, copies, null_keys, nulls) = con.sql(f"""SELECT count(*), sum(n), count_if(vehicle_id IS NULL), count_if(v < n) FROM (
      SELECT vehicle_id, count(*) AS n, count(value) AS v FROM ({O.LI_PRICED}) GROUP BY vehicle_id, time, value_id)""").fetchall()[0]
    assert copies > keys and 0 < null_keys < keys and nulls > 0


def test_folder_with_times_of_two_types(spark, tmp_path):
    from voltaic.sources.files import load_folder

    whole = spark.sql("SELECT 'a' AS id, TIMESTAMP_NTZ '2024-01-01 00:00:00.000001' AS time, 1 AS x")
    text = spark.sql("SELECT * FROM VALUES ('b', '2024-01-02 03:00:00', 2.5D), ('c', 'none', NULL) t(id, time, y)")
    whole.write.parquet(str(tmp_path / "f"))
    text.write.mode("append").parquet(str(tmp_path / "f"))
    got = {r.id: (str(r.time), r.x, r.y) for r in load_folder(spark, str(tmp_path / "f")).collect()}
    assert got == {"a": ("2024-01-01 00:00:00.000001", 1, None), "b": ("2024-01-02 03:00:00", None, 2.5),
                   "c": ("None", None, None)}
    spark.sql("SELECT 'd' AS id, TIMESTAMP_NTZ '2024-01-03 00:00:00' AS time, 'one' AS x").write.mode("append").parquet(
        str(tmp_path / "f"))
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        load_folder(spark, str(tmp_path / "f"))
