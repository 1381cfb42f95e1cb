import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from voxsift.operators.intake import unify
from voxsift.plans import generate as gen
from voxsift.sources import text_files
from voxsift.sources.profile import file_sizes, profile_all

REVIEWS = '''review_id,app_name,review_text,rating,platform,app_version,date,user_name
A2,Tasklane,"Crashes, always. He said ""no""",1,Google Play,4.0.2,2024-02-03,ann
A1,Tasklane,  fine  ,5,App Store,4.1.0,2024-02-04 08:09:10,bob
A3,Tasklane,,,App Store,4.1.0,someday,é😀
'''
EMAILS = '''email_id,subject,body,sender_email,timestamp,priority
B1,Crash report,"Hello,

it crashes.

Bye
",x@mail.example,2024-02-05 01:02:03,High
B2,Wish,"",y@mail.example,2024-02-06,
'''


@pytest.fixture
def files(tmp_path):
    (tmp_path / "reviews.csv").write_text(REVIEWS, encoding="utf-8")
    (tmp_path / "emails.csv").write_text(EMAILS, encoding="utf-8")
    return tmp_path


def test_items_from_both_files(spark, files):
    items = unify(
        text_files.read_reviews(spark, str(files / "reviews.csv")),
        text_files.read_emails(spark, str(files / "emails.csv")),
    )
    rows = {r.source_id: r for r in items.collect()}
    assert sorted(rows) == ["A1", "A2", "A3", "B1", "B2"]
    assert rows["A2"].text == 'Crashes, always. He said "no"'
    assert rows["A1"].text == "fine"
    assert rows["A3"].text == "" and rows["A3"].metadata.rating is None
    assert rows["A3"].metadata.date is None and rows["A3"].metadata.user_name == "é😀"
    assert rows["B1"].text == "Crash report\n\nHello,\n\nit crashes.\n\nBye"
    assert rows["B1"].metadata.subject == "Crash report"
    assert rows["B2"].text == "Wish\n\n" and rows["B2"].metadata.priority == ""
    assert rows["A1"].metadata.rating == 5 and rows["A1"].metadata.sender_email is None


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        text_files.read_reviews(spark, str(tmp_path / "nothing.csv"))


def test_profile_counts_logical_rows(spark, files):
    emails = text_files.read_emails(spark, str(files / "emails.csv"))
    row = profile_all({"emails": emails}).first()
    assert (row.row_count, row.column_count) == (2, 6)
    assert row.null_values == 1  # a priority that is not there; the quoted empty body is a text
    assert file_sizes(emails).first().bytes == len(EMAILS.encode())


def test_written_files_read_back(spark, tmp_path):
    reviews, emails, labels = gen.generate(spark, 40, 20, seed=3)
    text_files.write_text(emails, str(tmp_path / "e"), gen.EMAIL_COLUMNS)
    back = text_files.read_emails(spark, str(tmp_path / "e"))
    want = emails.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    assert sorted(back.collect()) == sorted(want.collect())
    stored = text_files.to_parquet(back, str(tmp_path / "p"))
    assert sorted(stored.collect()) == sorted(want.collect())


def test_columns_go_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("user_name,extra,review_text,review_id\nann,1,hello,A1\n", encoding="utf-8")
    row = text_files.read_reviews(spark, str(tmp_path / "r.csv")).first()
    assert (row.review_id, row.review_text, row.user_name, row.rating) == ("A1", "hello", "ann", None)


def test_texts_come_back_as_they_were(spark, tmp_path):
    texts = [" s ", "", None, "a\nb", 'say "no"', "\t", "x,y", "null"]
    rows = [(str(i), "s", t, "m", None, "p") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "email_id string, subject string, body string, sender_email string, timestamp string, priority string")
    text_files.write_text(df, str(tmp_path / "e"), gen.EMAIL_COLUMNS)
    assert {r.email_id: r.body for r in text_files.read_emails(spark, str(tmp_path / "e")).collect()} == {str(i): t for i, t in enumerate(texts)}
