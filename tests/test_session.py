import os

import pytest

from zoneflow.session import local_scratch


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_single_machine_sessions_get_a_scratch_folder(master):
    assert os.path.isdir(local_scratch(master))


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://h", "local-cluster[3,2,1024]"])
def test_clusters_must_name_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        local_scratch(master)


def test_tasks_of_bounded_rows_keep_every_row(spark):
    from zoneflow.session import in_tasks_of

    df = spark.range(1000).repartition(2)
    dealt = in_tasks_of(df, 100)
    assert dealt.rdd.getNumPartitions() == 10
    assert dealt.agg({"id": "sum"}).first()[0] == 999 * 500 and dealt.count() == 1000
    assert in_tasks_of(df, 600) is df
    assert in_tasks_of(df.limit(0), 100).count() == 0
