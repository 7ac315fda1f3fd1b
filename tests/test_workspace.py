import os
import time

from linkseek.workspace import TIDY, Workspace, delete_all, shared_folder


def test_tables_go_when_told(spark):
    work = Workspace(spark)
    saved = work.save(spark.range(5), "rows")
    assert saved.count() == 5 and work.path.startswith(shared_folder(spark))
    files = saved.inputFiles()
    work.delete()
    delete_all()
    assert files and Workspace(spark).save(spark.range(3), "rows").count() == 3


def test_shuffle_files_go_with_a_tidy_save(spark, work):
    tops = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {x for top in tops for _, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}
    rows = spark.range(1000).repartition(3, "id")
    before = shuffled()
    plain = work.save(rows, "plain")
    assert shuffled() - before
    between = shuffled()
    saved = work.save(rows, "tidy", tidy=True)
    until = time.time() + 20
    while shuffled() - between and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - between
    assert saved.count() == plain.count() == 1000 and spark.conf.get(TIDY) == "false"
