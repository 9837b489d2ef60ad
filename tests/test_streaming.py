from pyspark.sql import functions as F

from kiln.operators import missing as N
from kiln.operators.models import mllib
from kiln.operators.recode import cut
from kiln.streaming.scoring import score_stream, stream_files

SF = "/root/testdata/sf0.001"


def test_fitted_steps_score_a_file_stream(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    train = orders.withColumn("done", (F.col("o_orderstatus") == "F").cast("int"))
    fill = N.fit_median(train, ["o_totalprice"])
    model = mllib.logistic(train, ["o_totalprice"], "done")
    steps = [fill.apply, lambda d: cut(d, "o_totalprice", [0, 2e5, 5e5], ["low", "high"], out="band"),
             model.transform]
    stream = stream_files(spark, SF, orders.schema, glob="orders.parquet")
    q = score_stream(stream, steps, ["o_orderkey", "band", "prediction"], str(tmp_path / "out"),
                     str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == orders.count()
    batch = model.transform(fill.apply(orders)).select("o_orderkey", "prediction")
    assert out.join(batch, "o_orderkey").filter(out.prediction != batch.prediction).count() == 0
