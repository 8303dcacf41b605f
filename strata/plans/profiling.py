"""Profiling reports of the raw and curated layers.

Each report is a dict of named check DataFrames (no printing, no driver
loops; a few small jobs measure join sides while it is built); write them, show them, or pass one to
:func:`strata.operators.quality.gate`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col, trim_headers
from strata.functions.dates import parse_timestamp
from strata.functions.mapping import map_exact, map_prefix
from strata.operators import quality as Q
from strata.plans import defaults as D
from strata.operators.relational import anti_join
from strata.plans.curated import clean_countries, invalid_users
from strata.sinks.writers import stage_table
from strata.plans.refined import users_without_sign


def unmatched_after_mapping(users: DataFrame, countries: DataFrame, prefix_rules: Sequence[tuple[str, str]] = D.COUNTRY_PREFIX_RULES) -> DataFrame:
    """Distinct raw ``country`` of users whose mapped name is not among the
    curated ``countries`` (Q1 after mapping, J2); a null country is listed."""
    pairs = users.select("country", map_prefix("country", prefix_rules).alias("country_name")).distinct()
    return anti_join(pairs, countries, "country_name", "country").select("country").distinct()


def profile_raw(
    users: DataFrame,
    countries: DataFrame,
    facts: DataFrame,
    prefix_rules: Sequence[tuple[str, str]] = D.COUNTRY_PREFIX_RULES,
    continent_map: Mapping[str, str] = D.CONTINENT_ES_TO_EN,
    added_countries: Sequence[Sequence[str]] = D.ADDED_COUNTRIES,
    stage_path: str | None = None,
    group_name: str = D.AUDITED_GROUP,
    song_name: str = D.AUDITED_SONG,
    horoscopes: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Checks over the raw tables, before and after each cleaning step.

    ``horoscopes`` adds the preview of that table.

    With ``stage_path`` the parsed facts are written once as Parquet there
    and every fact check reads that copy, pruned to its columns: raw text
    cannot be column-pruned, so otherwise each check parses the whole file.
    """
    raw_countries = trim_headers(countries).withColumnRenamed("name", "country")
    curated_countries = clean_countries(countries, continent_map, added_countries)
    parsed = facts.select("*", parse_timestamp("fact_date").alias("fact_timestamp"))
    if stage_path:
        parsed = stage_table(parsed, f"{stage_path.rstrip('/')}/facts_parsed")
    checks = {
        # Q1: user countries unknown to the country table, before / after mapping.
        "unmatched_countries_before": Q.unmatched_values(users, "country", raw_countries, "country"),
        "unmatched_countries_after": unmatched_after_mapping(users, curated_countries, prefix_rules),
        # Q10: countries present on several rows, before / after de-duplication.
        "duplicate_countries_before": Q.duplicate_keys(raw_countries, "country"),
        "duplicate_countries_after": Q.duplicate_keys(curated_countries, "country"),
        # Q3: continents missing before and after the fill.
        "countries_without_continent": Q.null_rows(
            raw_countries.withColumn("continent", map_exact("continente", continent_map)), col("continente").isNull()
        ),
        "countries_without_continent_after": Q.null_rows(curated_countries, col("continente").isNull() | col("continent").isNull()),
        # Q2: user id uniqueness.
        "user_key_uniqueness": Q.key_uniqueness(users, "#id"),
        # Missing registration, missing country.
        "users_profile": Q.null_profile(
            users,
            ["registered", "country"],
            {"country_missing_registered_present": col("country").isNull() & col("registered").isNotNull()},
        ),
        "users_without_registration": Q.null_rows(users, col("registered").isNull()),
        "users_without_country": Q.missing_country_with_date(users),
        # Q4: fact time text that does not parse.
        "unparsed_timestamps": Q.unparsed_values(parsed, "fact_date", "fact_timestamp"),
        # Q7: facts per user.
        "facts_per_user": Q.group_counts(parsed, "user_id", "total_facts"),
        # Q3: facts without time text, song or group name, and the whole null profile.
        "facts_profile": Q.null_profile(
            parsed,
            ["user_id", "fact_date", "group_id", "group_name", "song_id", "song_name", "fact_timestamp"],
            {"unparsed_timestamps": col("fact_date").isNotNull() & col("fact_timestamp").isNull()},
        ),
        "facts_without_date": Q.null_rows(parsed, col("fact_date").isNull()),
        "facts_without_song": Q.null_rows(parsed, col("song_name").isNull()),
        "facts_without_group": Q.null_rows(parsed, col("group_name").isNull()),
        # Q5: a group name carried by several ids; the ids of one group and of one song.
        "group_name_ids": Q.fd_violations(parsed, "group_name", "group_id", "n_group_ids"),
        "audited_group_ids": parsed.where(col("group_name") == group_name).select("group_id", "group_name").distinct(),
        "audited_song_ids": parsed.where(col("song_name") == song_name).select("song_id", "song_name", "group_name").distinct(),
        # Q8: facts before and after removing invalid users.
        "filter_impact": Q.filter_impact(parsed, invalid_users(users), "user_id", "#id"),
        # Q11: previews of the tables.
        "users_preview": Q.preview(users, 20, "#id"),
        "countries_preview": Q.preview(curated_countries, 20, ["country", "pais"]),
        "facts_preview": Q.preview(parsed, 20, ["user_id", "fact_date", "group_id", "song_id"]),
    }
    if horoscopes is not None:
        checks["horoscopes_preview"] = Q.preview(horoscopes, 20, _calendar_order())
    return checks


def _calendar_order() -> list[Column]:
    """By day of the year; days that are no numbers last."""
    return [F.expr("try_cast(Month AS INT)").asc_nulls_last(), F.expr("try_cast(Day AS INT)").asc_nulls_last(), col("Date")]


def profile_curated(
    users: DataFrame, countries: DataFrame, horoscopes: DataFrame, facts: DataFrame, stage_path: str | None = None
) -> dict[str, DataFrame]:
    """Checks over the curated tables.

    ``stage_path``: as for :func:`profile_raw`, when ``facts`` is not a
    published table but still the plan that computes it.
    """
    if stage_path:
        facts = stage_table(facts, f"{stage_path.rstrip('/')}/facts_curated")
    return {
        # Q9: users whose registration day has no calendar row.
        "users_without_sign": users_without_sign(users, horoscopes),
        # Q1 after mapping: user country names unknown to the country table.
        "users_without_continent": Q.unmatched_values(users, "country_name", countries, "country"),
        # Q5: group names vs (name, id) pairs.
        "group_counts": Q.distinct_counts(facts, GROUP_COUNTS),
        "group_name_ids": Q.fd_violations(facts, "group_name", "group_id", "n_group_ids"),
        # Q6: (group, song) names carried by several id pairs.
        "duplicate_naming": Q.duplicate_naming(facts),
        # Q3: facts without a group id / without a user.
        "facts_profile": Q.null_profile(facts, ["group_id", "user_id"]),
        "facts_without_group_id": Q.null_rows(facts, col("group_id").isNull()),
        "facts_without_user": Q.null_rows(facts, col("user_id").isNull()),
        # Q11: deterministic previews of the tables.
        "users_preview": Q.preview(users, 20, "#id"),
        "countries_preview": Q.preview(countries, 20, ["country", "pais"]),
        "horoscopes_preview": Q.preview(horoscopes, 20, _calendar_order()),
        "facts_preview": Q.preview(facts, 20, ["user_id", "fact_date"]),
    }


GROUP_COUNTS = {
    "group_names": ["group_name"],
    "group_name_id_pairs": ["group_name", "group_id"],
    "name_id_quadruples": ["group_name", "song_name", "group_id", "song_id"],
}
# Listings whose length a one-row profile of the same table reports already.
COUNTED_IN_PROFILE = {
    "users_without_registration": ("users_profile", "registered_nulls"),
    "users_without_country": ("users_profile", "country_missing_registered_present"),
    "unparsed_timestamps": ("facts_profile", "unparsed_timestamps"),
    "facts_without_date": ("facts_profile", "fact_date_nulls"),
    "facts_without_song": ("facts_profile", "song_name_nulls"),
    "facts_without_group": ("facts_profile", "group_name_nulls"),
    "facts_without_group_id": ("facts_profile", "group_id_nulls"),
    "facts_without_user": ("facts_profile", "user_id_nulls"),
}
ONE_ROW = ("user_key_uniqueness", "users_profile", "facts_profile", "filter_impact", "group_counts")


def profile_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Rows ``(check, metric, value)`` of a report.

    A one-row check gives each of its numbers; a listing gives its ``rows``
    (taken from the profile of its table where that has the number, so the
    table is not read again); ``facts_per_user`` gives users, facts and the
    largest user. Only these few rows reach the driver when it is shown.
    """
    if not checks:
        raise ValueError("profile_summary needs at least one check")
    parts = []
    for name, df in checks.items():
        if name in COUNTED_IN_PROFILE and COUNTED_IN_PROFILE[name][0] in checks:
            continue  # a line of the profile's own, below
        if name in ONE_ROW:
            metrics = {c: col(c) for c in df.columns}
            metrics |= {f"{n}.rows": col(c) for n, (profile, c) in COUNTED_IN_PROFILE.items() if profile == name and n in checks}
        elif name == "facts_per_user":
            df = df.agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.sum("total_facts"), F.lit(0)).alias("facts"), F.coalesce(F.max("total_facts"), F.lit(0)).alias("most"))
            metrics = {c: col(c) for c in df.columns}
        else:
            df = df.agg(F.count(F.lit(1)).alias("rows"))
            metrics = {"rows": col("rows")}
        line = [
            F.struct(
                F.lit(m.split(".")[0] if m.endswith(".rows") else name).alias("check"),
                F.lit("rows" if m.endswith(".rows") else m).alias("metric"),
                c.cast("bigint").alias("value"),
            )
            for m, c in metrics.items()
        ]
        parts.append(df.select(F.explode(F.array(*line)).alias("line")).select("line.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)
