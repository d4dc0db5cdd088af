"""What was released leaves nothing behind on the driver and the disks."""
import time

from pyspark.sql import functions as F

from fareforge.llm.common import materialize, only_result_stays
from fareforge.llm.components import components
from fareforge import session


def test_shuffles_of_released_layers_go(spark):
    known = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()

    def build():
        layer = spark.range(1000)
        for k in range(12):
            layer = materialize(layer.groupBy((F.col("id") + k).alias("id")).count().select("id"), "layer")
        return layer

    before = known.size()
    assert only_result_stays(spark, build, "result").count() == 1000
    until = time.time() + 20
    while known.size() > before + 3 and time.time() < until:
        time.sleep(0.2)
    assert known.size() <= before + 3


def test_components_keep_one_layer(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20], "u long, v long")
    before = set(session._WRITTEN)
    found = components(links)
    assert len(set(session._WRITTEN) - before) == 1
    assert {r.node: r.component for r in found.collect()} == {i: 0 if i <= 20 else 21 for i in range(41)}
