"""Silver tables that several queries of one session read, written once per session and source folder."""

from __future__ import annotations

from ledgerlake.session import new_folder, write_whole

_STAGES: dict = {}
ROWS_A_TASK = 50_000  # orders, each of which grows into payloads of some kilobytes


def spread(orders):
    """Narrow order rows over all cores before each grows into payloads; more orders are more tasks, not larger ones."""
    spark = orders.sparkSession
    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return orders.repartition(max(cores, -(-orders.count() // ROWS_A_TASK)), "o_orderkey")


class Stage:
    """Keeps track of the files behind its tables."""

    def __init__(self, spark, sf):
        self.spark, self.sf = spark, sf
        self.paths: list[str] = []

    def settle(self, df, label: str):
        path = new_folder(self.spark, label)
        write_whole(df, path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def alive(self) -> bool:
        """Whether all files are still there; the shared folder may be cleaned between queries."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
            if not done.getFileSystem(conf).exists(done):
                return False
        return True


def stage(kind, spark, sf, *args):
    """The session's stage of this kind and source folder, rebuilt where its files are gone."""
    key = (kind.__name__, spark.sparkContext.applicationId, sf, *args)
    found = _STAGES.get(key)
    if found is None or not found.alive():
        found = kind(spark, sf, *args)
        _STAGES[key] = found
    return found
