from pathlib import Path

import pyarrow as pa
import pytest

pytest.importorskip("stockweek.llm.columns")

from stockweek.llm.columns import map_texts  # noqa: E402


def test_a_task_gives_back_what_its_batches_have_freed(spark):
    def make():
        kept = []

        def work(texts):
            pages = int(Path("/proc/self/statm").read_text().split()[1])
            many = [bytes(700) for _ in range(200_000)]
            kept.append(many.pop())  # the last one holds the end of the heap in place
            return [pa.array([pages * 4096 >> 20] * len(texts), pa.int64())]

        return work

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        texts = spark.range(4).selectExpr("id", "'x' AS text").coalesce(1)
        found = map_texts(texts, "text", ("id",), "mb bigint", make).orderBy("id").collect()
    finally:
        spark.conf.set(setting, before)
    mb = [row["mb"] for row in found]
    assert len(mb) == 4 and max(mb[1:]) - mb[0] < 70, mb
