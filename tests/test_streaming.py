import os
import tempfile

from framewright.streaming.fitted import apply_fitted, fit_fill, fit_scaler, fit_tukey_flags


def test_fitted_steps_apply_to_a_stream(spark):
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "value")
    scaler = fit_scaler(batch, "standard", ["value"])
    fill = fit_fill(batch, "median", ["value"])
    flags = fit_tukey_flags(batch, ["value"])
    expected = {r.event_id: (r.value, r.outlier_tukey_value)
                for r in apply_fitted(batch, fill, flags, scaler).collect()}

    src = tempfile.mkdtemp(prefix="fw-stream-src-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="fw-stream-ckpt-", dir="/tmp")
    batch.repartition(3).write.mode("overwrite").parquet(os.path.join(src, "data"))
    stream = spark.readStream.schema(batch.schema).parquet(os.path.join(src, "data"))
    q = (apply_fitted(stream, fill, flags, scaler).writeStream.format("memory").queryName("fw_stream_out")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.event_id: (r.value, r.outlier_tukey_value) for r in spark.table("fw_stream_out").collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k][0] - expected[k][0]) < 1e-12 and got[k][1] == expected[k][1] for k in got)
