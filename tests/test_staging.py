import time
from concurrent.futures import ThreadPoolExecutor

from voltide import session


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def counts(spark, n=1000):
    return spark.range(n).selectExpr("id % 10 AS k").groupBy("k").count()


def test_shuffle_files_of_a_staged_table_go_with_its_write(spark):
    before, setting = shuffle_files(spark), spark.conf.get(session.FILE_CLEANUP)
    staged = [session.stage(counts(spark, n), "counted") for n in (100, 200, 300)]
    deadline = time.time() + 20
    while shuffle_files(spark) > before and time.time() < deadline:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(session.FILE_CLEANUP) == setting
    assert [sum(row["count"] for row in df.collect()) for df in staged] == [100, 200, 300]


def test_the_setting_returns_after_writes_in_several_threads(spark):
    setting = spark.conf.get(session.FILE_CLEANUP)
    with ThreadPoolExecutor(4) as pool:
        sizes = list(pool.map(lambda n: session.stage(counts(spark, n), "counted").count(), range(10, 18)))
    assert sizes == [10] * 8 and spark.conf.get(session.FILE_CLEANUP) == setting
