import pytest
from conftest import formatted, rows
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import variant
from millrace.plans import audit

TEXTS = [
    '{"a":{"b":[{"c":1},{"c":"x"}]},"Sources":[],"more":{"deep":[1,[2,3]]}}',
    "{bad",
    None,
    '{"a":"text"}',
    '{"a":1,"a":2}',
    "[1,2]",
    "null",
    "7",
    "",
]


@pytest.fixture
def landed(spark, folder):
    where = folder()
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, doc string")
    variant.kept_whole(df, ["doc"]).coalesce(1).write.parquet(where)
    return spark.read.parquet(where).orderBy("i")


@pytest.mark.parametrize(
    "path, kind, found",
    [
        ("$.a.b[0].c", "bigint", [1, None, None, None, None, None, None, None, None]),
        ("$.a.b[1].c", "bigint", [None] * 9),
        ("$.a.b[9].c", "string", [None] * 9),
        ("$.Sources[0].ReportId", "string", [None] * 9),
        ("$.more.deep[1][0]", "int", [2, None, None, None, None, None, None, None, None]),
        ("$.a", "string", ['{"b":[{"c":1},{"c":"x"}]}', None, None, "text", None, None, None, None, None]),
        ("$[1]", "int", [None, None, None, None, None, 2, None, None, None]),
        ("$", "int", [None] * 7 + [7, None]),
    ],
)
def test_paths(landed, path, kind, found):
    assert [r.x for r in landed.select(variant.at(F.col("doc"), path, kind).alias("x")).collect()] == found


def test_nothing_is_lost(landed):
    got = [r.malformed for r in landed.collect()]
    bad = {1, 4, 8}
    assert got == [{"doc": TEXTS[i]} if i in bad else None for i in range(len(TEXTS))]


def test_all_paths(spark, landed):
    got = rows(variant.paths(landed, "doc"))
    assert ("$.more.deep[*]", "BIGINT", 1) in got and ("$.more.deep[*][*]", "BIGINT", 2) in got
    assert ("$", "OBJECT", 2) in got and ("$", "ARRAY", 1) in got and ("$.a", "STRING", 1) in got and ("$.a", "OBJECT", 1) in got
    assert variant.paths(landed.limit(0), "doc").collect() == []


def usage(spark, *contexts):
    fields = {f.name: None for f in schemas.USAGE_LOG.fields}
    made = [{**fields, "CpuTimeMs": 1, "DurationMs": 1, "Identity": c[0], "ApplicationContext": c[1]} for c in contexts]
    return spark.createDataFrame([tuple(m[f.name] for f in schemas.USAGE_LOG.fields) for m in made], schemas.USAGE_LOG)


CONTEXTS = [
    ('{"effectiveClaims":{"roles":["a","b"]}}', '{"DatasetId":"d","Sources":[{"ReportId":3,"HostProperties":{"UserSession":"s"}}]}'),
    ('{"effectiveClaims":{"roles":[]}}', '{"Sources":[]}'),
    ("{bad", "{bad"),
    (None, None),
    ('{"effectiveClaims":7}', '{"Sources":{"ReportId":1},"DatasetId":null}'),
    ('{"effectiveClaims":{"roles":["a",null]}}', '[1]'),
]


def test_the_same_keys_as_from_text(spark, folder):
    log, where = usage(spark, *CONTEXTS), folder()
    audit.dynamic_log(log).write.parquet(where)
    landed = spark.read.schema(schemas.USAGE_LOG_DYNAMIC).parquet(where)
    assert rows(audit.usage_rollup(landed)) == rows(audit.usage_rollup(log))


def test_one_parse_to_land_and_none_to_read(spark, folder):
    log, where = usage(spark, *CONTEXTS), folder()
    landing = formatted(audit.dynamic_log(log))
    assert landing.count("try_parse_json") + landing.count("parse_json(") <= 2 * len(schemas.USAGE_DYNAMIC)
    audit.dynamic_log(log).write.parquet(where)
    landed = spark.read.schema(schemas.USAGE_LOG_DYNAMIC).parquet(where)
    plan = formatted(audit.usage_rollup(landed))
    assert "parse_json" not in plan and "from_json" not in plan
    read = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "malformed" not in read and "ApplicationContext:struct<" in read
