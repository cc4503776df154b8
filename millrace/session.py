"""Session settings the operators rely on."""

import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# UTC keeps epoch arithmetic and ISO output stable; duplicate JSON keys resolve to the last one.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Send the package's small Python readers along with the tasks, so workers need not have it installed.
    cloudpickle.register_pickle_by_value(sys.modules["millrace"])
    return spark
