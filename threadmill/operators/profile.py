"""Format check: what an export holds beyond what is read, and whether that is an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions import patterns as P
from threadmill.functions import text as X

MAX_BAD_SHARE = 0.10


def _words(parts: Column) -> Column:
    text = F.array_join(F.transform(parts, X.part_text_column), " ")
    return F.coalesce(F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")), F.lit(0))


def messages(conversations: DataFrame) -> DataFrame:
    """(role, content_type, handled, messages, words): every kind of message of an export and what becomes of it."""
    m = F.explode(F.map_values("mapping")).alias("node")
    rows = conversations.where("mapping is not null").select(m).where("node.message is not null").select("node.message.*")
    role = F.coalesce(F.nullif(F.lower(F.col("author")["role"]), F.lit("")), F.lit("(none)"))
    kind = F.when(F.col("content").isNull(), "(no content)").otherwise(F.coalesce(F.nullif(F.col("content")["content_type"], F.lit("")), F.lit("(none)")))
    words = F.when(F.col("content")["parts"].isNotNull(), _words(F.col("content")["parts"])).otherwise(0)
    by = rows.select(role.alias("role"), kind.alias("content_type"), words.alias("w")).groupBy("role", "content_type").agg(F.count("*").alias("messages"), F.sum("w").cast("long").alias("words"), F.count_if(F.col("w") > 0).alias("with_text"))
    handled = (
        F.when(~F.col("role").isin(*P.KNOWN_ROLES), "unknown role").when(~F.col("role").isin("user", "assistant"), "dropped role").when(F.col("content_type") == "(no content)", "no content")
        .when(F.col("content_type").isin(*P.TEXT_TYPES), "kept").when(F.col("content_type").isin(*P.EXPECTED_DROPS), "dropped type").otherwise("unknown type")
    )
    return by.withColumn("handled", handled)


def verdict(conversations: DataFrame) -> DataFrame:
    """One row: counts, and the first error that holds ('' if none)."""
    one = conversations.select(
        F.count("*").alias("conversations"), F.count_if(F.col("mapping").isNull()).alias("no_mapping"), F.count_if(F.coalesce(F.col("create_time"), F.lit(0.0)) == 0).alias("no_create_time"),
        F.count_if(F.col("mapping").isNotNull() & (F.col("current_node").isNull() | ~F.coalesce(F.map_contains_key("mapping", F.coalesce("current_node", F.lit(""))), F.lit(False)))).alias("no_current_node"),
    )
    kinds = messages(conversations)
    text = kinds.agg(F.coalesce(F.sum(F.when((F.col("role") == "user") & (F.col("handled") == "kept"), F.col("with_text"))), F.lit(0)).alias("user_with_text"), F.coalesce(F.sum(F.when(F.col("handled").isin("unknown type", "unknown role"), F.col("messages"))), F.lit(0)).alias("unknown"))
    both = one.join(F.broadcast(text), F.lit(True))  # one row on either side
    error = F.when(F.col("conversations") == 0, "no conversations").when(F.col("no_mapping") > F.greatest(F.lit(1.0), F.col("conversations") * MAX_BAD_SHARE), "mapping is missing").when(F.col("user_with_text") == 0, "no user text").otherwise("")
    return both.withColumn("error", error)
