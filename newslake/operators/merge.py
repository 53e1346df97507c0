"""Merging new rows into stored tables.

Several new rows of one link are first folded to one with partial aggregates,
so a link that fills a third of the batch costs no more than any other.  The
stored table is then only looked up: if the folded batch is below the broadcast
threshold, Spark broadcasts it and the stored table is not shuffled; a larger batch
shuffles both sides by link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newslake.operators.ordering import first_per_key, number_rows
from newslake.schemas import CONTENT_STATUSES

# Columns where a later non-empty value replaces the stored one.
OVERWRITTEN = ["title", "publish_date", "source", "category"]
# Columns where a value only fills an empty one.
TEXTS = ["content", "full_content"]
STORED = ["link", *OVERWRITTEN, "content", "full_content", "full_content_status"]


def _given(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def valid_status(column: str = "full_content_status") -> Column:
    """The status if it is a known one, else NULL."""
    return F.when(F.col(column).isin(CONTENT_STATUSES), F.col(column))


def coerced_status(status: str = "full_content_status", full: str = "full_content") -> Column:
    """Known status as it is; unknown gives NULL; none given means success if there is full text."""
    return F.when(_given(status), valid_status(status)).when(_given(full), F.lit("success"))


def fold_incoming(incoming: DataFrame) -> DataFrame:
    """One row per link from rows with an arrival number ``seq``.

    ``first_*`` come from the first row, ``last_*`` and ``fill_*`` from the last
    and the first row that has a value.  Texts are carried once: ``any_*`` is the first
    one that is given, or that of the first row.
    """
    seq = F.col("seq")
    status = valid_status()
    rows = incoming.withColumn("_status", status)
    full = _given("full_content")
    aggregates = [F.min("seq").alias("seq")]
    for name in OVERWRITTEN:
        aggregates.append(F.min_by(name, seq).alias(f"first_{name}"))
        aggregates.append(F.max_by(name, F.when(_given(name), seq)).alias(f"last_{name}"))
    for name in TEXTS:
        given_first = F.when(seq.isNotNull(), F.struct(~_given(name), seq))
        aggregates.append(F.min_by(name, given_first).alias(f"any_{name}"))
    aggregates += [
        F.min_by("_status", F.when(full, seq)).alias("fill_status"),
        F.min(F.when(full, seq)).alias("fill_seq"),
        F.max_by("_status", F.when(F.col("_status").isNotNull(), seq)).alias("last_status"),
        F.max(F.when(F.col("_status").isNotNull(), seq)).alias("last_status_seq"),
    ]
    return rows.groupBy("link").agg(*aggregates)


def _status_after(fills: Column, otherwise: Column) -> Column:
    """The status once the rows were applied one by one.

    Filling the text sets it; a row after that may set it again.
    """
    later = F.col("last_status_seq") > F.col("fill_seq")
    on_fill = F.when(later, F.col("last_status")).otherwise(F.coalesce("fill_status", F.lit("success")))
    return F.when(fills, on_fill).otherwise(F.coalesce("last_status", otherwise))


def _new_rows(folded: DataFrame) -> DataFrame:
    fills = F.col("fill_seq").isNotNull()
    return folded.select(
        "link",
        *[F.coalesce(f"last_{c}", f"first_{c}").alias(c) for c in OVERWRITTEN],
        F.col("any_content").alias("content"),
        F.col("any_full_content").alias("full_content"),
        _status_after(fills, F.lit(None).cast("string")).alias("full_content_status"),
        "seq",
    )


def _updated_rows(stored: DataFrame, folded: DataFrame) -> DataFrame:
    e = {c: F.col(f"e.{c}") for c in STORED}
    empty = F.coalesce(e["full_content"], F.lit("")) == ""
    fills = empty & F.col("fill_seq").isNotNull()
    takes = (F.coalesce(e["content"], F.lit("")) == "") & _given("any_content")
    content = F.when(takes, F.col("any_content")).otherwise(e["content"])
    values = {c: F.coalesce(F.col(f"last_{c}"), e[c]) for c in OVERWRITTEN}
    values["content"] = content
    values["full_content"] = F.when(fills, F.col("any_full_content")).otherwise(e["full_content"])
    values["full_content_status"] = F.when(
        F.col("n.link").isNotNull(), _status_after(fills, e["full_content_status"])
    ).otherwise(e["full_content_status"])
    joined = stored.alias("e").join(folded.alias("n"), F.col("e.link") == F.col("n.link"), "left")
    kept = [c for c in stored.columns if c not in values]
    changed = F.lit(False)
    for name, value in values.items():
        changed = changed | ~value.eqNullSafe(e[name])
    return joined.select(
        *[F.col(f"e.{c}").alias(c) for c in kept], *[v.alias(c) for c, v in values.items()], changed.alias("updated")
    )


def merge_articles(stored: DataFrame, incoming: DataFrame, highest: int | None = None) -> DataFrame:
    """The store after ``incoming (seq, link, title, ...)`` was saved row by row.

    ``seq`` orders the rows; it is a number, or a struct of a batch and a number in it.

    Adds the flags ``inserted`` and ``updated``.  New links get the ids that follow
    the highest stored one, in arrival order; where ``stored`` is a part of the store,
    ``highest`` says which one that is.
    """
    folded = fold_incoming(incoming)
    known = stored.select("link").join(folded.select("link"), "link", "left_semi")
    fresh = _new_rows(folded.join(known, "link", "left_anti"))
    numbered = assign_ids(fresh, stored, highest=highest)
    inserted = numbered.select("id", *STORED, F.lit(True).alias("inserted"), F.lit(False).alias("updated"))
    old = _updated_rows(stored, folded).select("id", *STORED, F.lit(False).alias("inserted"), "updated")
    return old.unionByName(inserted)


def assign_ids(new_rows: DataFrame, stored: DataFrame, order: str = "seq", highest: int | None = None) -> DataFrame:
    """Give new rows the ids after the highest stored id, in order."""
    above = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar() if highest is None else F.lit(highest)
    if isinstance(new_rows.schema[order].dataType, StructType):  # the batch, then the number in it
        batch, seq = (F.col(f"{order}.{f.name}") for f in new_rows.schema[order].dataType.fields)
        buckets = [batch, F.shiftright(seq, 20)]
    else:
        buckets = [F.shiftright(F.col(order).cast("long"), 20)]
    numbered = number_rows(new_rows, buckets, [order], "_n")
    return numbered.withColumn("id", above + F.col("_n")).drop("_n")


def mark_inserted(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows with the flag that saving each would have returned.

    Only the first row of a link that was not stored yet is an insert.
    """
    first = incoming.groupBy("link").agg(F.min("seq").alias("seq")).withColumn("_first", F.lit(True))
    known = stored.select("link", F.lit(True).alias("_known")).distinct()
    fresh = first.join(known, "link", "left_anti").select("seq", "_first")
    return incoming.join(fresh, "seq", "left").withColumn("inserted", F.col("_first").isNotNull()).drop("_first")


def new_links(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    return incoming.join(stored.select("link"), "link", "left_anti")


def known_links(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    return incoming.join(stored.select("link"), "link", "left_semi")


def merge_features(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """One feature row per article; the one processed last wins."""
    rows = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return first_per_key(rows, ["article_id"], [F.desc("processed_at"), F.desc("_new")]).drop("_new")


def drop_orphans(features: DataFrame, articles: DataFrame) -> DataFrame:
    """Feature rows whose article still exists."""
    live = articles.select(F.col("id").alias("article_id"))
    return features.join(live, "article_id", "left_semi")


def articles_with_features(articles: DataFrame, features: DataFrame) -> DataFrame:
    return articles.join(features, articles["id"] == features["article_id"], "left")


def migrate_articles(target: DataFrame, legacy: DataFrame) -> DataFrame:
    """The target after a migration: new links are inserted, known ones only filled up."""
    rows = legacy.withColumn("_status", coerced_status())
    seq = F.col("id")
    full = _given("full_content")
    folded = rows.groupBy("link").agg(
        F.min("id").alias("id"),
        *[F.min_by(c, seq).alias(c) for c in OVERWRITTEN],
        F.min_by("content", F.when(_given("content"), seq)).alias("fill_content"),
        F.min_by("content", seq).alias("first_content"),
        F.min_by("full_content", F.when(full, seq)).alias("fill_full"),
        F.min_by("full_content", seq).alias("first_full"),
        F.min_by("_status", F.when(full, seq)).alias("fill_status"),
        F.min_by("_status", seq).alias("first_status"),
    )
    known = target.select("link").join(folded.select("link"), "link", "left_semi")
    fresh = folded.join(known, "link", "left_anti").select(
        "id",
        "link",
        *OVERWRITTEN,
        F.coalesce("fill_content", "first_content").alias("content"),
        F.coalesce("fill_full", "first_full").alias("full_content"),
        F.when(F.col("fill_full").isNotNull(), F.col("fill_status")).otherwise(F.col("first_status")).alias(
            "full_content_status"
        ),
        F.lit(True).alias("inserted"),
    )
    fill = folded.select(
        F.col("link").alias("_link"), F.col("fill_content"), F.col("fill_full"), F.col("fill_status")
    )
    joined = target.join(fill, target["link"] == fill["_link"], "left")
    empty_full = F.coalesce("full_content", F.lit("")) == ""
    fills = empty_full & F.col("fill_full").isNotNull()
    empty_content = F.coalesce("content", F.lit("")) == ""
    old = joined.select(
        "id",
        "link",
        *OVERWRITTEN,
        F.when(empty_content, F.coalesce("fill_content", "content")).otherwise(F.col("content")).alias("content"),
        F.when(fills, F.col("fill_full")).otherwise(F.col("full_content")).alias("full_content"),
        F.when(fills, F.col("fill_status")).otherwise(F.col("full_content_status")).alias("full_content_status"),
        F.lit(False).alias("inserted"),
    )
    return old.unionByName(fresh)


def migrate_features(target: DataFrame, legacy: DataFrame) -> DataFrame:
    """Feature rows that the target lacks are added; others stay as they are."""
    missing = legacy.join(target.select("article_id"), "article_id", "left_anti")
    return target.unionByName(missing.select(target.columns))
