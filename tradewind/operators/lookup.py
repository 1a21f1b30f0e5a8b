"""Dimension lookups, name-to-code matching and latest-year values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.staging import materialise


def with_country_id(
    facts: DataFrame,
    countries: DataFrame,
    code: str,
    into: str = "country_id",
    keep_unmatched: bool = False,
) -> DataFrame:
    """Replace a country code by its id.

    Codes outside the dimension (continents, groups) are dropped unless kept with
    a NULL id. Several roles on one fact are several calls.
    """
    lookup = countries.select(F.col("iso3").alias("__code"), F.col("country_id").alias(into))
    how = "left" if keep_unmatched else "inner"
    return facts.join(lookup, F.col(code) == F.col("__code"), how).drop("__code", code)


def normal_name(c: str | Column) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(column))


def names_to_codes(df: DataFrame, aliases: DataFrame, names: dict[str, str]) -> DataFrame:
    """Add an ISO3 column per name column from an alias table ``(alias, iso3)``.

    Matching ignores case and outer blanks; a name that is unknown or
    stands for several codes gives NULL, and ``unmatched_names`` counts it.
    """
    lookup = materialise(
        aliases.groupBy(normal_name("alias").alias("__alias")).agg(
            F.when(F.min("iso3") == F.max("iso3"), F.min("iso3")).alias("__iso3")
        )
    )
    for name, into in names.items():
        one = lookup.select("__alias", F.col("__iso3").alias(into))
        df = df.join(one, normal_name(name) == F.col("__alias"), "left").drop("__alias")
    return df


def _deletions(c: Column, edits: int) -> Column:
    """A text and all texts that up to ``edits`` deleted letters leave of it."""
    found = F.array(c)
    for _ in range(edits):
        shorter = F.transform(
            found,
            lambda t: F.transform(
                F.sequence(F.lit(0), F.greatest(F.length(t) - 1, F.lit(0))),
                lambda i: F.concat(F.left(t, i), F.substring(t, i + 2, F.length(t))),
            ),
        )
        found = F.array_distinct(F.concat(found, F.flatten(shorter)))
    return found


def near_names(
    names: DataFrame, aliases: DataFrame, name: str, into: str = "iso3", edits: int = 1
) -> DataFrame:
    """(name, code, distance) for the distinct names, by the aliases ``(alias, iso3)`` nearest to them.

    Names within ``edits`` inserted, deleted or replaced letters share a text that so many deletions
    leave of both; these texts are the join keys, and the candidates are then measured. So there is no
    product of names and aliases: a name has about as many keys as letters, squared for two edits. Case and
    outer blanks do not count. A name whose nearest aliases stand for several codes gets NULL and the
    distance; a name without an alias so near gets NULL for both.
    """
    if edits not in (1, 2):
        raise ValueError("edits must be 1 or 2")
    asked = names.select(F.col(name).alias("__asked")).where(F.col("__asked").isNotNull()).distinct()
    left = asked.select("__asked", normal_name("__asked").alias("__name"))
    known = aliases.select(normal_name("alias").alias("__alias"), F.col("iso3").alias("__iso3")).dropna().distinct()
    keyed = known.select("*", F.explode(_deletions(F.col("__alias"), edits)).alias("__key"))
    candidates = (
        left.select("__name", F.explode(_deletions(F.col("__name"), edits)).alias("__key")).distinct()
        .join(keyed, "__key")
        .select("__name", "__alias", "__iso3")
        .distinct()
        .withColumn("__distance", F.levenshtein("__name", "__alias", edits))
        .where(F.col("__distance") >= 0)
    )
    # Per distance the one code, or none; the least distance decides.
    per_distance = candidates.groupBy("__name", "__distance").agg(
        F.when(F.min("__iso3") == F.max("__iso3"), F.min("__iso3")).alias("__iso3")
    )
    nearest = per_distance.groupBy("__name").agg(
        F.min("__distance").alias("distance"), F.min_by("__iso3", "__distance").alias(into)
    )
    return left.join(nearest, "__name", "left").select(F.col("__asked").alias(name), into, "distance")


def unmatched_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Count rows per name that received no code."""
    missing = [
        F.when(F.col(code).isNull(), F.struct(F.lit(name).alias("role"), F.col(name).alias("name")))
        for name, code in names.items()
    ]
    return (
        df.select(F.explode(F.array_compact(F.array(*missing))).alias("m"))
        .groupBy("m.role", "m.name")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def usable_year(market: DataFrame) -> Column:
    """Latest year in which any country has both an import size and a gap."""
    return (
        market.where(F.col("import_tonnes").isNotNull() & F.col("import_gap").isNotNull())
        .agg(F.max("year").alias("usable_year"))
        .scalar()
    )


def latest_values(market: DataFrame, partners: DataFrame, values: dict[str, str]) -> DataFrame:
    """Per partner, values of the usable year, or of the year before it where the
    partner is flagged as reporting late. Partners without a row get NULLs."""
    year = usable_year(market)
    rows = partners.select("country_id", "faostat_fallback").join(
        market.where(F.col("year") >= year - 1).select("country_id", "year", *values),
        "country_id",
        "left",
    )
    wanted = F.col("year") == year - F.when(F.col("faostat_fallback") == 1, 1).otherwise(0)
    return rows.groupBy("country_id").agg(
        *[F.max(F.when(wanted, F.col(c))).alias(name) for c, name in values.items()]
    )


def gap_of_year(market: DataFrame, year: int, by: list[str]) -> DataFrame:
    """Consumption less production of one year per group; a missing side counts
    as nothing, both missing is NULL."""
    sums = (
        market.where(F.col("year") == year)
        .groupBy(*by)
        .agg(F.sum("consumption_tones").alias("__c"), F.sum("production_tonnes").alias("__p"))
    )
    known = F.coalesce(F.col("__c"), F.col("__p")).isNotNull()
    gap = F.coalesce(F.col("__c"), F.lit(0.0)) - F.coalesce(F.col("__p"), F.lit(0.0))
    return sums.select(*by, F.when(known, gap).alias("gap"))


def largest_gap_of_year(market: DataFrame, year: int) -> DataFrame:
    """One row: the largest per-country gap of a year."""
    return gap_of_year(market, year, ["country_id"]).agg(F.max("gap").alias("max_gap"))
