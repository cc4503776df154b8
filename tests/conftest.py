import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace import PipelineConfig, configure  # noqa: E402
from millrace.model import RAW  # noqa: E402
from millrace.plans import feed  # noqa: E402
from millrace.sources.registry import Rules, builtin_documents  # noqa: E402

SF = "/root/testdata/sf0.001"
CHROME = feed.USER_AGENTS[0]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def config():
    return PipelineConfig()


EXTRA = {
    "iglu:com.snowplowanalytics.snowplow/social_interaction/jsonschema/1-0-0": {
        "$schema": "x",
        "type": "object",
        "properties": {"network": {"type": "string"}, "action": {"type": "string"}},
        "additionalProperties": False,
    },
    "iglu:org.example/broken/jsonschema/1-0-0": {"$schema": "x", "type": "nothing"},
    "iglu:org.example/user/jsonschema/1-0-0": {
        "$schema": "x",
        "type": "object",
        "properties": {"user_id": {"type": "string"}, "domain_sessionidx": {"type": "integer"}},
    },
}


@pytest.fixture(scope="session")
def rules(config):
    return Rules.compile(builtin_documents(config.schema_vendor) | feed.FEED_DOCUMENTS | EXTRA)


@pytest.fixture(scope="session")
def make_raw(spark):
    def make(*requests):
        rows = []
        for r in requests:
            body = r.get("body")
            rows.append(
                (
                    "CollectorPayload",
                    r.get("ip", "172.17.0.5"),
                    r.get("ms", 1702884076562),
                    "UTF-8",
                    "test-collector",
                    r.get("ua", CHROME),
                    None,
                    "/i",
                    r.get("qs"),
                    body.encode() if isinstance(body, str) else body,
                    r.get("headers", ["Host: a"]),
                    r.get("content_type"),
                    r.get("host", "h.example.org"),
                    r.get("nuid", "n1"),
                )
            )
        return spark.createDataFrame(rows, RAW)

    return make
