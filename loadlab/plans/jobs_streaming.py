"""Registered streaming job: score the scoring window as a file stream (rows-only check)."""

from __future__ import annotations

import os

from loadlab.operators import models as MO
from loadlab.plans.common import rounded
from loadlab.plans.registry import register
from loadlab.sources import files, tables
from loadlab.streaming.score_stream import read_load_stream, score_stream


@register("stream_score_scoring_window")
def stream_score_scoring_window(spark, sf):
    """Fit ridge (log target) on train, land the scoring rows as parquet files, score them
    with an ``availableNow`` stream and read the sink back."""
    spec = MO.ModelSpec("Ridge (alpha=1.0, log target)", "ridge", "log", params={"alpha": 1.0})
    model = MO.fit(spec, tables.train(spark, sf))
    base = files.scratch_path(spark, "stream")
    src, sink, ckpt = (os.path.join(base, p) for p in ("source", "sink", "checkpoint"))
    scoring = tables.loads(spark, sf).filter("date >= date '2001-01-01'")
    scoring.select(*[f.name for f in files.LOADS_SCHEMA.fields]).repartition(4).write.parquet(src)
    q = score_stream(model, read_load_stream(spark, src, max_files_per_trigger=2), sink, ckpt)
    q.awaitTermination()
    return rounded(spark.read.parquet(sink))
