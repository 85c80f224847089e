import json
import os
import time
import uuid

from pyspark.sql import functions as F

from silverline.streaming.dedup import DedupFigures, dedup_stream

SCHEMA = "k bigint, t string"


def _file(path, i, rows, mtime):
    os.makedirs(path, exist_ok=True)
    f = os.path.join(path, f"f{i}.json")
    with open(f, "w") as h:
        for r in rows:
            h.write(json.dumps(r) + "\n")
    os.utime(f, (mtime, mtime))


def _run(spark, tmp_root, keys, mode="exact"):
    inp = f"{tmp_root}/in"
    base = time.time() - 1000
    _file(inp, 1, [{"k": 1, "t": "2024-01-01 10:00:00"}, {"k": 2, "t": "2024-01-01 10:05:00"}], base)
    _file(inp, 2, [{"k": 1, "t": "2024-01-01 10:00:00"}, {"k": 3, "t": "2024-01-01 10:30:00"}], base + 10)
    _file(inp, 3, [{"k": 5, "t": "2024-01-01 10:31:00"}], base + 20)
    _file(inp, 4, [{"k": 4, "t": "2024-01-01 09:00:00"}], base + 30)
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(inp)
              .withColumn("t", F.col("t").cast("timestamp")))
    table = f"stream_dedup_{mode}_{len(keys)}_{uuid.uuid4().hex[:8]}"
    q = dedup_stream(stream, keys, table, f"{tmp_root}/cp", "t", "10 minutes", mode=mode)
    q.awaitTermination()
    return q, spark.table(table)


def _dropped(q):
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in q.recentProgress for op in p.get("stateOperators", []))


def test_watermark_dedup_with_time_key(spark, tmp_root):
    q, out = _run(spark, tmp_root, ["k", "t"])
    assert sorted(r.k for r in out.collect()) == [1, 2, 3, 5]
    assert _dropped(q) == 1  # the 09:00 row is behind the 10:21 watermark


def test_within_watermark_mode(spark, tmp_root):
    q, out = _run(spark, tmp_root, ["k"], mode="within_watermark")
    assert sorted(r.k for r in out.collect()) == [1, 2, 3, 5]
    assert _dropped(q) == 1


def _state_rows(q):
    return q.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_state_eviction_rules(spark, tmp_root):
    # watermark ends at 10:31 - 10 min = 10:21
    q, _ = _run(spark, f"{tmp_root}/a", ["k", "t"])
    assert _state_rows(q) == 2  # (3, 10:30) and (5, 10:31) remain; older keys evicted
    q, _ = _run(spark, f"{tmp_root}/b", ["k"])
    assert _state_rows(q) == 4  # event time is not a key: nothing is ever evicted
    q, _ = _run(spark, f"{tmp_root}/c", ["k"], mode="within_watermark")
    assert _state_rows(q) == 2  # keys 3 and 5 expire after 10:21


def test_late_and_repeated_rows_are_counted(spark, tmp_root):
    """The figures equal a model that keeps the watermark of each batch by hand."""
    inp, base, delay = f"{tmp_root}/in", time.time() - 1000, 600
    batches = [[(k % 4, 60 * ((7 * k * (i + 3)) % (20 + 30 * i))) for k in range(12)] for i in range(6)]
    at = lambda s: time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(1_704_103_200 + s))
    for i, rows in enumerate(batches):
        _file(inp, i, [{"k": k, "t": at(s)} for k, s in rows], base + 10 * i)
    late = repeated = 0
    late_mark = mark = newest = -10**9
    state = set()
    for rows in batches:
        # rows are late by the watermark of the batch before; state is dropped by the present one
        fresh = [r for r in rows if r[1] > late_mark]
        late += len(rows) - len(fresh)
        repeated += len(fresh) - len(set(fresh) - state)
        state = {r for r in state | set(fresh) if r[1] > mark}
        newest = max([newest, *(s for _, s in rows)])
        late_mark, mark = mark, newest - delay
    figures = DedupFigures()
    spark.streams.addListener(figures)
    try:
        stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(inp).withColumn("t", F.col("t").cast("timestamp")))
        q = dedup_stream(stream, ["k", "t"], f"figures_{uuid.uuid4().hex[:8]}", f"{tmp_root}/cp", "t", f"{delay} seconds")
        q.awaitTermination()
        for _ in range(50):
            got = figures.by_query.get(str(q.id), {})
            if got.get("read") == sum(map(len, batches)) and got["late"] == late:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(figures)
    assert got["read"] == 72 and late > 0 and got["late"] == late and got["repeated"] == repeated
