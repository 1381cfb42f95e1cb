from voxsift.operators import routing
from voxsift.operators.intake import unify
from voxsift.operators.scoring import rule_scorer
from voxsift.plans import generate as gen
from voxsift.streaming.intake_stream import triage_stream


def test_files_are_taken_up_once(spark, tmp_path):
    reviews, emails, _ = gen.generate(spark, 60, 30, seed=2)
    items = unify(reviews, emails)
    inbox, sink, progress = (str(tmp_path / n) for n in ("inbox", "sink", "progress"))

    def process(df):
        return routing.with_route(rule_scorer(df)).select("source_id", "category", "route")

    def run():
        arriving = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        triage_stream(arriving, process, sink, progress).awaitTermination()
        return sorted(spark.read.parquet(sink).select("source_id", "category", "route").collect())

    items.filter("source_type = 'review'").coalesce(2).write.mode("append").parquet(inbox)
    assert len(run()) == 60
    items.filter("source_type = 'email'").coalesce(1).write.mode("append").parquet(inbox)
    assert run() == run() == sorted(process(items).collect())
