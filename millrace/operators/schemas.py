"""Look-up of the schemas that payloads name, and checks of data against them.

A payload names few schemas, and many payloads name the same ones. So the distinct sets of names are joined with the
registry table, and each payload gets the schemas of its set as the map column ``reg``. The registry may have any number
of rows; the sets' schemas are broadcast only where their documents are few bytes in all.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import PipelineConfig
from millrace.functions import text
from millrace.functions.schema_checker import violation
from millrace.functions.sqltext import let, lits
from millrace.operators.lookup import lookup_join
from millrace.sources.registry import Rules, describe

REG = "MAP<STRING, STRUCT<document: STRING, fields: ARRAY<STRING>, is_object: BOOLEAN, invalid: STRING>>"
NO_REG = f"CAST(map() AS {REG})"
REG_BYTES = "aggregate(map_values(reg), 0L, (n, e) -> n + coalesce(octet_length(e.document), 0))"


def named_uris(rules: Rules) -> str:
    """The URIs that a payload with ``params`` and ``outer_schema`` may need and that are not compiled, in order."""
    body = let("try_validate_utf8(CAST(body AS STRING))", "bs", text.strict_json("bs"))
    items = "coalesce(try_cast(variant_get(bj, '$.data') AS ARRAY<MAP<STRING, STRING>>), array())"
    wrapped = f"coalesce({text.base64_json('m[\'ue_px\']')}, {text.strict_json('m[\'ue_pr\']')})"
    sent = f"coalesce({text.base64_json('m[\'cx\']')}, {text.strict_json('m[\'co\']')})"
    contexts = f"transform(try_cast(variant_get({sent}, '$.data') AS ARRAY<VARIANT>), c -> try_variant_get(c, '$.schema', 'string'))"
    of_map = f"concat(array(m['schema'], try_variant_get({wrapped}, '$.data.schema', 'string')), coalesce({contexts}, array()))"
    named = let(body, "bj", f"concat(array(outer_schema, try_variant_get(bj, '$.schema', 'string')), flatten(transform(concat(array(params), {items}), m -> {of_map})))")
    compiled = f"u IN ({lits(rules.known)})" if rules.known else "false"
    return f"array_sort(array_distinct(filter({named}, u -> u IS NOT NULL AND startswith(u, 'iglu:') AND NOT {compiled})))"


def with_registry(df: DataFrame, rules: Rules, config: PipelineConfig) -> DataFrame:
    """Add ``reg``: what the registry has of the schemas that a payload names."""
    df = df.withColumn("_named", F.expr(named_uris(rules)))
    sets = df.select("_named").where("size(_named) > 0").distinct()
    wanted = sets.select("_named", F.explode("_named").alias("uri"))
    held = rules.lookup_table(df.sparkSession).join(wanted.select("uri").distinct(), "uri", "left_semi")
    found = wanted.join(describe(held), "uri").groupBy("_named")
    entry = F.struct("uri", F.struct("document", "fields", "is_object", "invalid"))
    maps = found.agg(F.map_from_entries(F.collect_list(entry)).cast(REG).alias("reg"))  # as many as a payload names
    return lookup_join(df, maps, ["_named"], config, REG_BYTES).withColumn("reg", F.expr(f"coalesce(reg, {NO_REG})")).drop("_named")


OPEN_DOCUMENT = "STRUCT<document: STRING, data: STRING>"


def open_document(uri: str, value: str) -> str:
    """The document and the data where ``uri`` is a schema of the registry, else NULL."""
    return (
        f"IF({value} IS NOT NULL AND coalesce(map_contains_key(reg, {uri}) AND reg[{uri}].invalid IS NULL, false),"
        f" CAST(named_struct('document', reg[{uri}].document, 'data', to_json({value})) AS {OPEN_DOCUMENT}), NULL)"
    )


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _violations(rows: pa.Array) -> pa.Array:
    """The first broken rule of each document's data, NULL where there is none."""
    return pa.array([[[d and violation(d["document"], d["data"]) for d in item or []] for item in row or []] for row in rows.to_pylist()], pa.list_(pa.list_(pa.string())))


#: Marked as not deterministic so that it stays a column of its own: the optimizer would else move it into lambdas that
#: use it, where Python cannot run.
violations = _violations.asNondeterministic()
