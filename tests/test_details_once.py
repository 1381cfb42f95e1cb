from voxsift import vocabulary as words
from voxsift.operators import details


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bug_details_look_for_each_pattern_once(spark):
    items = spark.range(3).selectExpr("repeat('when I dock', id) AS text")
    plan = _plan(details.bug_details(items))
    assert [plan.count(p) for p in (words.DEVICE_PATTERN, words.TRIGGER_PATTERN, words.STEPS_BLOCK_PATTERN)] == [1, 1, 1]


def test_bug_details_without_text_or_match(spark):
    items = spark.createDataFrame([(None,), ("",), ("It stops when I dock, on an iPhone SE",), ("iOS 17.2",)], "text string")
    found = [tuple(r) for r in details.bug_details(items).select("platform", "os_version", "steps_to_reproduce").collect()]
    none = ("Unknown", "Unknown", "Not specified")
    assert found == [none, none, ("iPhone SE", "Unknown", "dock"), ("iOS 17.2", "17.2", "Not specified")]
