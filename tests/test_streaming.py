"""The stateless scoring operators run unchanged on a streaming DataFrame."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.operators import cluster
from lodestar.plans import relations as R
from lodestar.session import scratch_path


def test_assign_nearest_on_a_file_stream(spark):
    pts = R.points(spark, SF_SMALL)
    res = cluster.lloyd_kmeans(pts, "features", 3, id_col="vec_id", fixed_iterations=2)
    src = f"{SF_SMALL}/embeddings.parquet"
    schema = spark.read.parquet(src).schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "embeddings.parquet")
              .parquet(SF_SMALL)
              .select("vec_id", F.col("embedding").cast("array<double>").alias("features")))
    scored = cluster.assign_nearest(stream, "features", res.centres, 64, "cluster_id")
    name = "assign_stream_" + scratch_path(spark, "q").rsplit("-", 1)[-1]
    q = (scored.select("vec_id", "cluster_id").writeStream.format("memory").queryName(name)
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["vec_id"]: r["cluster_id"] for r in spark.sql(f"SELECT * FROM {name}").collect()}
    batch = {r["vec_id"]: r["cluster_id"] for r in
             cluster.assign_nearest(pts, "features", res.centres, 64, "cluster_id").collect()}
    assert got == batch
