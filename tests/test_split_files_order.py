"""Order inside split files, found without gathering a file in a task."""

import pytest

from lodestar.operators import splits


@pytest.mark.parametrize("batch", ["1", "3", "10000"])
def test_rows_out_of_order_in_files(spark, tmp_path, batch):
    nan = float("nan")
    rows = [(1, "a", 1.0, True), (1, None, 2.0, True), (1, "b", nan, True), (1, "b", 3.0, True), (1, "b", None, True),
            (None, "c", 1.0, True), (None, "c", 1.0, False), (2, "", nan, None), (2, "", nan, None), (2, "é", 0.0, None), (2, "z", 0.0, None)]
    keys = ["k", "s", "x", "b"]
    for folder, some in (("p=1", rows), ("p=2", rows[::-1]), ("p=3", rows[:1]), ("p=4", rows[:0])):
        spark.createDataFrame(some, "k int, s string, x double, b boolean").coalesce(1).write.parquet(f"{tmp_path}/{folder}")
    order = lambda r: tuple((v is not None, isinstance(v, float) and v != v, 0 if v is None or v != v else v.encode() if isinstance(v, str) else v)
                            for v in r)
    falls = lambda some: sum(order(a) > order(b) for a, b in zip(some, some[1:], strict=False))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = splits.files_out_of_order(spark.read.parquet(str(tmp_path)), keys)
        assert tuple(df.first()) == (2 * len(rows) + 1, falls(rows) + falls(rows[::-1]))
        empty = splits.files_out_of_order(spark.read.parquet(f"{tmp_path}/p=4"), keys)
        assert tuple(empty.first()) == (0, 0)
        # rows reach the window only as ends of batches
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.find("MapInArrow") > plan.find("Window") > 0 and plan.find("Exchange hashpartitioning", plan.find("MapInArrow")) < 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
