"""First occurrence by key, in ways that survive a key with a third of all rows.

Nothing here gathers the rows of one key in one task:

* ``survivors`` is a single aggregation. Each map task keeps one row per key, so
  a hot key sends one row per task through the shuffle.
* ``classify`` has to tell every row which record it repeats, and that is a join
  back by key. The most repeated keys are met by a broadcast of bounded size and
  their rows are spread over all tasks; the rest meet by an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.columns import GROUP, POSITION, position
from firstseen.config import DedupConfig
from firstseen.operators.prepare import RECORD, records

SURVIVOR, DUPLICATE, PUBLISHED = "survivor", "duplicate", "published"

# What a survivor keeps besides its position.
PAYLOAD = ("table_name", "file_name", "effective_table", "raw_line")


def baseline_index(prepared: DataFrame) -> DataFrame:
    """First location of every published key."""
    prior = records(prepared).filter(F.col("role_rank") == 0)
    first = prior.groupBy(*GROUP).agg(F.min(F.struct("sequence", "file_path", "line_no")).alias("first"))
    return first.select(
        *GROUP,
        F.col("first.sequence").alias("first_sequence"),
        F.col("first.file_path").alias("first_path"),
        F.col("first.line_no").alias("first_line_no"),
    )


def survivors(
    prepared: DataFrame, payload: Sequence[str] = PAYLOAD, place: Sequence[str] = POSITION
) -> DataFrame:
    """Today's records that are the first of their key, published ones included.

    One shuffle. The smallest (role, sequence, path, line) of a key wins and
    carries its payload along; positions are unique, so the payload never
    decides. Published rows only compete, their payload stays behind. ``place``
    names the columns of the position where lines have no numbers yet.
    """
    carried = [F.when(F.col("role_rank") == 1, F.col(c)).alias(c) for c in payload]
    first = F.min(F.struct(*place, *carried)).alias("first")
    return (
        records(prepared)
        .groupBy(*GROUP)
        .agg(first)
        .filter(F.col("first.role_rank") == 1)
        .select(*GROUP, "first.*")
        .drop("role_rank")
    )


def attach_by_key(rows: DataFrame, facts: DataFrame, config: DedupConfig) -> DataFrame:
    """Left join ``rows`` with ``facts``, one row per key, as struct column ``fact``.

    ``facts`` has GROUP, ``copies`` (how many of ``rows`` have that key) and
    ``fact``. Keys with at least ``hot_min_copies`` rows, at most ``hot_keys`` of
    them, are broadcast; at a few hundred bytes each the limit is the proven
    bound of that broadcast. Their rows, and rows without a key, then carry a
    unique join key that matches nothing, as no key has its length, and that
    spreads them evenly. Which keys are taken as hot changes the route only,
    never the result.
    """
    hot = (
        facts.filter(F.col("copies") >= config.hot_min_copies)
        .orderBy(F.desc("copies"))
        .limit(config.hot_keys)
        .select(*[F.col(c).alias(f"_hot_{c}") for c in GROUP], F.col("fact").alias("_hot_fact"))
    )
    routed = rows.join(
        F.broadcast(hot),
        [F.col(c) == F.col(f"_hot_{c}") for c in GROUP],
        "left",
    )
    met = F.col("_hot_fact").isNotNull() | F.col("dedup_key").isNull()
    unique = F.concat(
        F.coalesce("dedup_key", F.lit(b"")),
        F.xxhash64("file_path", "line_no").cast("string").cast("binary"),
    )
    routed = routed.withColumn("_join_key", F.when(met, unique).otherwise(F.col("dedup_key")))
    cold = facts.select(*[F.col(c).alias(f"_cold_{c}") for c in GROUP], F.col("fact").alias("_cold_fact"))
    joined = routed.join(
        cold,
        (F.col("_join_key") == F.col("_cold_dedup_key"))
        & (F.col("scope_table") == F.col("_cold_scope_table"))
        & (F.col("file_date") == F.col("_cold_file_date")),
        "left",
    )
    return joined.select(*rows.columns, F.coalesce("_hot_fact", "_cold_fact").alias("fact"))


def classify(prepared: DataFrame, config: DedupConfig) -> DataFrame:
    """Every line with its ``status`` and the location of the record it repeats.

    Status is blank, reject, published (baseline record), survivor or duplicate.
    Only keys with several copies take part in the join back. ``dup_kind`` says
    where the first one is: baseline, same_file or cross_file.
    """
    facts = (
        records(prepared)
        .groupBy(*GROUP)
        .agg(F.min(position()).alias("fact"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )
    first = F.coalesce(F.col("fact"), position())
    record = F.col("line_kind") == RECORD
    status = (
        F.when(~record, F.col("line_kind"))
        .when(F.col("role_rank") == 0, PUBLISHED)
        .when(F.col("first") == position(), SURVIVOR)
        .otherwise(DUPLICATE)
    )
    duplicate = F.col("status") == DUPLICATE
    kind = F.when(
        duplicate,
        F.when(F.col("first.role_rank") == 0, "baseline")
        .when(F.col("first.file_path") == F.col("file_path"), "same_file")
        .otherwise("cross_file"),
    )
    return (
        attach_by_key(prepared, facts, config)
        .withColumn("first", first)
        .withColumn("status", status)
        .withColumn("dup_kind", kind)
        .withColumn("first_path", F.when(duplicate, F.col("first.file_path")))
        .withColumn("first_line_no", F.when(duplicate, F.col("first.line_no")))
        .drop("fact", "first")
    )


def duplicates(classified: DataFrame) -> DataFrame:
    """The dropped records, each with the record it repeats."""
    return classified.filter(F.col("status") == DUPLICATE).select(
        "table_name",
        "file_date",
        "file_path",
        "line_no",
        "dedup_key",
        "first_path",
        "first_line_no",
        "dup_kind",
    )


def locate_published(prepared: DataFrame, config: DedupConfig) -> DataFrame:
    """Today's records with the published location of their key, NULL if new.

    ``copies`` counts today's rows of the key, as those are the rows that meet
    the fact. Published and today's keys are grouped in one shuffle.
    """
    today = F.col("role_rank") == 1
    location = F.struct("sequence", "file_path", "line_no")
    facts = (
        records(prepared)
        .groupBy(*GROUP)
        .agg(F.min(F.when(~today, location)).alias("fact"), F.count_if(today).alias("copies"))
        .filter(F.col("fact").isNotNull() & (F.col("copies") > 0))
    )
    return attach_by_key(records(prepared).filter(today), facts, config)


def baseline_anti_join(prepared: DataFrame, config: DedupConfig) -> DataFrame:
    """Today's records whose key is not published yet; copies among them stay."""
    return locate_published(prepared, config).filter(F.col("fact").isNull()).drop("fact")


def key_membership(prepared: DataFrame, config: DedupConfig) -> DataFrame:
    """Today's records with ``is_known`` and the published location, if any."""
    found = locate_published(prepared, config)
    return (
        found.withColumn("is_known", F.col("fact").isNotNull())
        .withColumn("first_path", F.col("fact.file_path"))
        .withColumn("first_line_no", F.col("fact.line_no"))
        .drop("fact")
    )
