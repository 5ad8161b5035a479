"""Sources and sinks: checked reads, sink modes, CSV header, cutoff split,
fixtures and the ALS id guard."""


import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.session import scratch_path
from spark_recs.sources import fixtures as fx
from spark_recs.sources import schemas

from conftest import SF_SMALL


def test_checked_read_rejects_missing_column(spark):
    path = scratch_path(spark, "bad")
    spark.createDataFrame([(1, "a")], "user_id long, other string").write.parquet(path)
    with pytest.raises(schemas.SchemaMismatch):
        schemas.read_parquet(spark, path, schemas.USERS)


def test_checked_read_casts_or_refuses_types(spark):
    path = scratch_path(spark, "ints")
    spark.createDataFrame([(1, [0.5, 1.5])], "id long, features array<double>").write.parquet(path)
    df = schemas.read_parquet(spark, path, schemas.FACTORS)
    assert df.schema == schemas.FACTORS
    with pytest.raises(schemas.SchemaMismatch):
        schemas.read_parquet(spark, path, schemas.FACTORS, strict_types=True)


def test_default_sink_refuses_overwrite(spark):
    path = scratch_path(spark, "once")
    df = spark.createDataFrame([(1,)], "x long")
    schemas.write_parquet(df, path)
    with pytest.raises(Exception):
        schemas.write_parquet(df, path)
    schemas.write_parquet(df, path, mode="overwrite")


def test_csv_with_header_roundtrip(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(0.5, 3)], "beta double, n long")
    schemas.write_csv(df.coalesce(1), path)
    first = spark.read.text(path).first()[0]
    assert first == "beta,n"
    back = schemas.read_csv(spark, path, T.StructType([T.StructField("beta", T.DoubleType()),
                                                       T.StructField("n", T.LongType())]))
    assert back.collect()[0] == (0.5, 3)


def test_cutoff_split_partitions_rows(spark):
    from spark_recs.operators.split import cutoff_split
    i = fx.all_interactions(spark, SF_SMALL)
    before, after = cutoff_split(i, "timestamp", fx.TEST_CUTOFF)
    assert before.count() + after.count() == i.count()
    assert after.agg(F.min("timestamp")).first()[0] >= fx.TEST_CUTOFF
    assert before.count() == fx.interactions(spark, SF_SMALL).count()


def test_fixture_tracks_follow_mapping(spark):
    t = {r.recording_msid: r for r in fx.tracks(spark, SF_SMALL).collect()}
    assert "ms-97" in t and len(t) == fx.table(spark, SF_SMALL, "part").count()  # every part has a track row
    assert t["ms-13"].track_name is None                    # null name
    assert t["ms-12"].recording_mbid == "mb-12" and t["ms-13"].recording_mbid == "mb-12"  # shared mbid
    assert t["ms-18"].recording_mbid is None                # 18 % 10 >= 7


def test_event_items_parse_json(spark):
    ev = fx.event_interactions(spark, SF_SMALL)
    assert ev.filter(F.col("item_id").isNull()).count() == 0
    assert ev.agg(F.min("item_id"), F.max("item_id")).first() == (0, 99)


def test_als_rejects_ids_beyond_int(spark):
    from spark_recs.operators import als
    big = spark.createDataFrame([(2**31, 1, 1)], "user_id long, track_id long, interactions_count long")
    with pytest.raises(ValueError):
        als.check_int_ids(big)


def test_checkpoint_root_is_shared_setting(spark):
    from spark_recs.session import checkpoint_root
    root = checkpoint_root(spark)
    assert root and spark.sparkContext.getCheckpointDir() == root
