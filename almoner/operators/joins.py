"""Parent-child joins, merges of column chunks and sources, and their consistency reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoner.functions.predicates import op_not_blank
from almoner.session import materialize

# tasks that the gifts of one campaign are spread over
SALTS = 16


def children(fact: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows of the given parents."""
    return fact.join(parents.select(key).distinct(), key, "left_semi")


def memberships_for(accounts: DataFrame, memberships: DataFrame, key: str = "account_id") -> DataFrame:
    """Memberships of all accounts in one join instead of one request per account."""
    return children(memberships, accounts, key)


def donor_accounts(accounts: DataFrame, donations: DataFrame, key: str = "account_id") -> DataFrame:
    """Accounts with at least one donation."""
    return accounts.join(donations.select(key).distinct(), key, "left_semi")


def with_profile(metrics: DataFrame, accounts: DataFrame, key: str = "account_id") -> DataFrame:
    return metrics.join(accounts, key, "left")


def _matched_pairs(gifts: DataFrame, campaigns: DataFrame, gift_id: str, gift_name: str) -> DataFrame:
    """Distinct (id, name) pairs of the gifts with the campaign_id of every campaign they name, each once."""
    pairs = gifts.select(F.col(gift_id).alias("__id"), F.col(gift_name).alias("__name")).distinct()
    known = campaigns.select("campaign_id", "campaign_name")
    by_id = pairs.join(known, F.col("__id") == F.col("campaign_id"))
    by_name = pairs.join(known, F.col("__name") == F.col("campaign_name"))
    return by_id.union(by_name).select("__id", "__name", "campaign_id").distinct()


def _meet_pairs(gifts: DataFrame, matched: DataFrame, gift_id: str, gift_name: str) -> DataFrame:
    """Gifts with the columns of their pairs in one join, salted since one campaign may hold most gifts.

    Where the matched pairs are small, adaptive execution broadcasts them.
    """
    same = F.col(gift_id).eqNullSafe(F.col("__id")) & F.col(gift_name).eqNullSafe(F.col("__name"))
    copies = matched.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = gifts.withColumn("__salt", F.pmod(F.xxhash64(*gifts.columns), F.lit(SALTS)).cast("int"))
    return salted.join(copies, same & (F.col("__salt") == F.col("__copy"))).drop("__id", "__name", "__copy", "__salt")


def match_campaigns(gifts: DataFrame, campaigns: DataFrame, gift_id: str, gift_name: str) -> DataFrame:
    """Gift rows with the campaign_id of every campaign they name by id or by name, each pair once."""
    matched = materialize(_matched_pairs(gifts, campaigns, gift_id, gift_name))
    return _meet_pairs(gifts, matched, gift_id, gift_name)


def campaign_join(campaigns: DataFrame, donations: DataFrame) -> DataFrame:
    """Donations per campaign by id or by name, each pair once; empty campaigns keep one null row."""
    id_name, name_name = "donation_campaign_id", "donation_campaign_name"
    # campaigns join the few pairs, so that the donations are joined once
    known = materialize(_matched_pairs(donations, campaigns, id_name, name_name).join(campaigns, "campaign_id"))
    matched = _meet_pairs(donations, known, id_name, name_name)
    pairs = donations.select(F.col(id_name).alias("campaign_id"), F.col(name_name).alias("campaign_name")).distinct()
    pairs = materialize(pairs)
    empty = campaigns.join(pairs, "campaign_id", "left_anti").join(pairs, "campaign_name", "left_anti")
    return matched.unionByName(empty, allowMissingColumns=True)


def _last_per_key(chunk: DataFrame, pk: str, seq: str | None) -> DataFrame:
    columns = [c for c in chunk.columns if c not in (pk, seq)]
    kept = chunk.where(F.col(pk).isNotNull())
    row = F.struct(*columns) if columns else F.struct(F.lit(1).alias("__none"))
    # equal numbers, or none at all, leave the choice to the values
    order = F.struct(F.col(seq).alias("__seq"), row.alias("__row")) if seq else row
    return kept.groupBy(pk).agg(F.max_by(row, order).alias("__row"))


def merge_column_chunks(chunks: Sequence[DataFrame], pk: str, seq: str | None = None) -> DataFrame:
    """One row per key of the first chunk with the columns of all of them.

    Later chunks win on a shared column even with a null; columns of an absent chunk row stay null.
    A key repeated in a chunk is settled by the largest `seq`, and by the largest row where `seq` is equal or not
    given: a table has no last row, but the choice is the same for any partitioning.
    """
    first, *rest = chunks
    out = _last_per_key(first, pk, seq).select(pk, "__row.*").drop("__none")
    for chunk in rest:
        later = _last_per_key(chunk, pk, seq).withColumnRenamed("__row", "__later")
        joined = out.join(later, pk, "left")
        for name in [c for c in chunk.columns if c not in (pk, seq)]:
            new = F.col("__later")[name]
            old = F.col(name) if name in out.columns else F.lit(None)
            joined = joined.withColumn(
                name, F.when(F.col("__later").isNotNull(), new).otherwise(old)
            )
        out = joined.drop("__later")
    return out


def chunk_consistency(chunks: Sequence[DataFrame], pk: str) -> DataFrame:
    """Per chunk: distinct keys, keys the first chunk lacks (phantom) and keys it lacks (missing)."""
    tagged = [
        c.select(F.col(pk).alias("k"), F.lit(i).alias("chunk")).where(F.col("k").isNotNull())
        for i, c in enumerate(chunks)
    ]
    stacked = reduce(DataFrame.unionByName, tagged)
    flags = [F.max(F.col("chunk") == i).alias(f"in_{i}") for i in range(len(chunks))]
    per_key = stacked.groupBy("k").agg(*flags)
    counts = []
    for i in range(len(chunks)):
        here, base = F.col(f"in_{i}"), F.col("in_0")
        counts.append(
            F.struct(
                F.lit(i).alias("chunk"),
                F.count_if(here).alias("chunk_size"),
                F.count_if(here & ~base).alias("phantom"),
                F.count_if(base & ~here).alias("missing"),
            )
        )
    return per_key.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def merge_sources(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per id over all sources; each column takes its first non-empty value by source order."""
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [s.withColumn("__source", F.lit(i)) for i, s in enumerate(sources)],
    )
    columns = [c for c in stacked.columns if c not in (key, "__source")]

    def first_value(name: str) -> Column:
        # the value itself settles a source that holds the same id twice
        usable = F.when(op_not_blank(F.col(name)), F.struct("__source", name))
        return F.min(usable)[name].alias(name)

    return stacked.groupBy(key).agg(*[first_value(c) for c in columns])


def append_missing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of `a`, then rows of `b` whose key `a` does not hold."""
    return a.unionByName(b.join(a.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def flag_donors(accounts: DataFrame, donations: DataFrame, key: str = "account_id") -> DataFrame:
    """Accounts with is_donor; ids are compared as text."""
    ids = (
        donations.select(F.col(key).cast("string").alias("__id"))
        .where(F.col("__id").isNotNull())
        .distinct()
    )
    return (
        accounts.join(ids, accounts[key].cast("string") == ids["__id"], "left")
        .withColumn("is_donor", F.col("__id").isNotNull())
        .drop("__id")
    )


def registrations_per_event(events: DataFrame, registrations: DataFrame, key: str = "event_id") -> DataFrame:
    """Registration count of every event, zero included."""
    counts = registrations.groupBy(key).agg(F.count(F.lit(1)).alias("registrations"))
    return events.join(counts, key, "left").withColumn(
        "registrations", F.coalesce("registrations", F.lit(0))
    )


def donor_years(donations: DataFrame, key: str = "account_id", date: str = "date") -> DataFrame:
    """Set of giving years per donor, combined before the shuffle (years are few per donor)."""
    return (
        donations.where(F.col(key).isNotNull() & F.col(date).isNotNull())
        .groupBy(key)
        .agg(F.collect_set(F.year(date)).alias("years"))
    )


def pairs_of_years(per_donor: DataFrame, key: str = "account_id") -> DataFrame:
    """Donors of each observed year who also gave in the next one, from their sets of years."""
    observed = per_donor.select(F.explode("years").alias("y")).agg(
        F.array_sort(F.collect_set("y")).alias("all")
    )
    held = per_donor.withColumn("all", observed.scalar())
    pairs = F.transform(
        F.col("all"),
        lambda y, i: F.struct(y.alias("year"), F.get(F.col("all"), i + 1).alias("next_year")),
    )
    both = F.array_contains("years", F.col("year")) & F.array_contains("years", F.col("next_year"))
    return held.select(key, "years", F.inline(pairs)).where(both).select(key, "year", "next_year")


def year_pairs(donations: DataFrame, key: str = "account_id", date: str = "date") -> DataFrame:
    """Donors of each observed year who also gave in the next observed year."""
    return pairs_of_years(materialize(donor_years(donations, key, date)), key)
