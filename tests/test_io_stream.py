import os

import pytest
from pyspark.sql import functions as F

from loadlab.operators import models as MO
from loadlab.operators.contracts import assert_same_rows
from loadlab.sources import files, tables
from loadlab.streaming.score_stream import read_load_stream, score_stream


def test_missing_csv_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "absent.csv"), files.SUBMISSION_SCHEMA, "submission")


def test_malformed_csv_fails_fast(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("load_id,predicted_rate\na,1.5\nb,not-a-number\n")
    df = files.read_csv(spark, str(p), files.SUBMISSION_SCHEMA, "submission")
    with pytest.raises(Exception):
        df.collect()


def test_csv_round_trip_keeps_order(spark, tmp_path):
    df = spark.createDataFrame([(f"id{i:03d}", float(i), i) for i in range(50)], "load_id string, predicted_rate double, position long")
    path = files.write_csv(df, str(tmp_path / "sub"), order_by=["position"])
    back = files.read_csv(spark, path, files.SUBMISSION_SCHEMA.add("position", "long"), "submission")
    assert [r["position"] for r in back.collect()] == list(range(50))


def test_metadata_missing_file_gives_empty(spark, tmp_path):
    assert files.read_metrics_rows(spark, str(tmp_path / "nothing")).count() == 0


def test_search_is_seeded():
    space = {"alpha": [0.1, 1.0, 10.0], "beta": [1, 2]}
    assert MO.sample_candidates(space, 3, 42) == MO.sample_candidates(space, 3, 42)
    assert len({str(c) for c in MO.sample_candidates(space, 6, 1)}) == 6


def test_stream_scores_equal_batch(spark, sf001, tmp_path):
    spec = MO.ModelSpec("ridge log", "ridge", "log", params={"alpha": 1.0})
    model = MO.fit(spec, tables.train(spark, sf001))
    src, sink, ckpt = (str(tmp_path / d) for d in ("src", "sink", "ckpt"))
    rows = tables.loads(spark, sf001).filter("date >= date '2001-01-01'").select(*[f.name for f in files.LOADS_SCHEMA.fields])
    rows.repartition(3).write.parquet(src)
    q = score_stream(model, read_load_stream(spark, src, max_files_per_trigger=1), sink, ckpt)
    q.awaitTermination()
    streamed = spark.read.parquet(sink).select("load_id", F.round("predicted", 9).alias("p"))
    batch = model.predict(rows).select("load_id", F.round("predicted", 9).alias("p"))
    assert streamed.count() == rows.count()
    assert_same_rows(streamed, batch)


def test_processed_indicators_are_binary(spark, sf001):
    from loadlab.operators.encode import FeatureEncoder
    enc = FeatureEncoder().fit(tables.train(spark, sf001))
    out = enc.transform(tables.scoring(spark, sf001))
    flags = [c for c in enc.feature_names() if c.endswith(("_is_missing", "_is_unknown"))]
    bad = out.select([F.count_if(~F.col(c).isin(0.0, 1.0)).alias(c) for c in flags]).first()
    assert all(bad[c] == 0 for c in flags)
    assert out.agg(F.max("delivery_is_unknown")).first()[0] == 1.0  # *_NEW cities are unseen
