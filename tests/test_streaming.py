from pyspark.sql import functions as F

from leadlens.operators import modeling_data, trees
from leadlens.plans.q_prep import SHORT_TYPES
from leadlens.sources.issues import issues
from leadlens.streaming import score_stream
from leadlens.streaming.score_stream import feature_names
from tests.conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark, tmpdir_path):
    df = issues(spark, SF_SMALL)
    model, enc = modeling_data.design(df, 10, SHORT_TYPES)
    feats = feature_names(model)
    tree = trees.fit_tree(enc, feats, "log_duration", max_depth=3)
    from leadlens.operators import linear
    from leadlens.operators import moments as M

    lin = linear.OLSModel.from_fit(linear.ols(M.moments(enc, feats, "log_duration")))
    src = tmpdir_path + "/in"
    open_rows = df.where(F.col("resolutiondate").isNull())
    open_rows.repartition(3).write.parquet(src)
    q = score_stream(spark, src, tmpdir_path + "/out", tmpdir_path + "/ckpt", model, {"tree": tree, "linear": lin},
                     available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(tmpdir_path + "/out")
    assert out.count() == open_rows.count()
    from leadlens.operators import encode, score

    batch = score.score_side_by_side(encode.encode(model, open_rows), feats, {"tree": tree, "linear": lin})
    j = out.join(batch.select("key", F.col("pred_tree").alias("b"), F.col("pred_linear").alias("bl")), "key")
    assert j.count() == open_rows.count()
    assert j.where((F.col("pred_tree") != F.col("b")) | (F.abs(F.col("pred_linear") - F.col("bl")) > 1e-9)).count() == 0
