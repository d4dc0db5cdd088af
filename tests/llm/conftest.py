import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from fareforge.llm.common import ready
    yield ready(s)


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, short, very long and repeated texts, a repeated id, and columns that other steps use."""
    prose = " ".join(f"word{i} of the text" for i in range(40))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, None), (4, "one", "en", "b"), (5, prose, "en", "b"),
            (6, prose, "de", "c"), (7, prose + " end", "en", None), (7, prose + " end", "en", None), (8, "x y z " * 40_000, "de", "a"),
            (None, prose, "en", "a"), (-9, "é\U0001f600 $$$ 12", "fr", "c"), (10, "w" * 100_000, "en", "c")]
    extra = [r + (len(r[1] or ""), "clash", 5, True) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, "
                                        "label string, size int, held_out boolean").repartition(3)
