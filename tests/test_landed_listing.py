"""Many landed documents: their listing is not a task a file."""

import os

from liqspark.session import prepare
from liqspark.sources.snapshot import snapshot_explode, snapshot_stream
from liqspark.streaming.runner import run_available_now


def test_landed_files_are_listed_by_a_bounded_number_of_tasks(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for k in range(300):
        with open(f"{tmp_dir}/in/{k}.json", "w") as f:
            f.write('{"count": 1, "items": [{"id": "%d"}]}' % k)
    q = run_available_now(snapshot_explode(snapshot_stream(prepare(spark), f"{tmp_dir}/in")), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    seen = spark.sparkContext.statusTracker()
    stages = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup(str(q.runId)) for s in seen.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) <= 96  # 300 before
    assert spark.read.parquet(f"{tmp_dir}/out").select("id").distinct().count() == 300
