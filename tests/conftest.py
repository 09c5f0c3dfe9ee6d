import os

import pytest
from pyspark.sql import SparkSession

# Workers find the stand-ins for models too.
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.abspath(__file__)), *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s
