"""Intake: two sources become one table of feedback items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.selection import first_rows, key_literal
from ..functions.text import strip


def _metadata(**known: Column) -> Column:
    """One struct for both sources; what a source lacks is null."""
    fields = []
    for field in schemas.METADATA:
        value = known.get(field.name, F.lit(None))
        fields.append(value.cast(field.dataType).alias(field.name))
    return F.struct(*fields)


def review_items(reviews: DataFrame) -> DataFrame:
    """Reviews as items. ``rating`` and ``date`` may be text; bad values become null."""
    return reviews.select(
        F.col("review_id").cast("string").alias("source_id"),
        F.lit("review").alias("source_type"),
        strip(F.col("review_text")).alias("text"),
        _metadata(
            platform=F.col("platform"),
            rating=F.col("rating").try_cast("int"),
            user_name=F.col("user_name"),
            date=F.col("date").try_cast("timestamp"),
            app_version=F.col("app_version").cast("string"),
        ).alias("metadata"),
    )


def email_items(emails: DataFrame) -> DataFrame:
    """E-mails as items: subject, an empty line, then the body."""
    subject = strip(F.col("subject"))
    return emails.select(
        F.col("email_id").cast("string").alias("source_id"),
        F.lit("email").alias("source_type"),
        F.concat(subject, F.lit("\n\n"), strip(F.col("body"))).alias("text"),
        _metadata(
            subject=subject,
            sender_email=F.col("sender_email"),
            timestamp=F.col("timestamp").try_cast("timestamp"),
            priority=F.coalesce(F.col("priority"), F.lit("")),
        ).alias("metadata"),
    )


def unify(reviews: DataFrame, emails: DataFrame) -> DataFrame:
    """All items of both sources; every row is kept."""
    return review_items(reviews).unionByName(email_items(emails))


def first_items(items: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` items by source type, id and content; 0 or None keeps all.

    One rule for every limit, so a smaller one keeps a prefix of a larger one. The
    key of the last item is selected without putting the items in order, and the
    items are filtered by it where they are. Content counts by its digest, which
    is taken of the items that share the last key only; items that tie in that as
    well are exact copies of each other.
    """
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    if not limit:
        return items
    order = ["source_type", "source_id"]
    before, last, needed = first_rows(items, order, limit)
    if last is None:
        return items
    same = F.struct(*order) == key_literal(last, order)
    if not needed:
        return items.filter(before | same)
    text = F.to_json(F.struct("text", "metadata")) if "metadata" in items.columns else F.col("text")
    content = F.coalesce(F.md5(text.cast("binary")), F.lit(""))
    tied = items.filter(same).withColumn("__content", content)
    smaller, digest, copies = first_rows(tied, ["__content"], needed)
    found = digest["__content"]
    if not copies:
        return items.filter(before | (same & (content <= F.lit(found))))
    cut = tied.filter(F.col("__content") == found).drop("__content").limit(copies)
    return items.filter(before | (same & (content < F.lit(found)))).unionByName(cut)
