"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads the whole generated tables (through the views of
:mod:`strata.sources.driver_tables`) and runs the library's operators on
them. ``ORACLE_SQL[name]`` is the same result written in SQL over the
DuckDB mirrors of those views; column names and types agree.

Timestamps are returned as ``timestamp_ntz`` (wall clock in UTC) so the
result does not depend on the reader's time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col, trim_headers
from strata.functions.dates import day_of, parse_date, parse_timestamp, to_int
from strata.functions.mapping import fill_null, map_exact, map_prefix
from strata.operators import quality as Q
from strata.operators.distinct import count_bitmaps, distinct_bitmaps, publish_bitmaps, read_bitmaps
from strata.operators.observed import Probes
from strata.operators.relational import Lookup, anti_join, exclude_keys, lookup_joins, rows_missing_lookup
from strata.operators.rules import map_prefix_rules
from strata.plans.curated import (
    clean_countries,
    clean_facts,
    clean_users,
    facts_with_year_month,
    invalid_users,
    run_curated,
)
from strata.plans.layers import read_layer
from strata.plans import defaults as D
from strata.plans.profiling import profile_curated, profile_raw, profile_summary
from strata.plans.profiling import unmatched_after_mapping as unmatched_mapped
from strata.plans.refined import (
    add_continent,
    add_horoscope,
    enrich_users,
    run_refined,
    users_without_sign,
    with_register_parts,
)
from strata.session import ensure_settings, scratch_path
from strata.sinks.bucketed import read_bucketed, write_bucketed
from strata.sinks.writers import ensure_database, key_bucket_filter, save_catalog_table, table_name, update_catalog_table, with_key_bucket, write_table
from strata.sources import driver_tables as V
from strata.sources.rejected import quarantine, read_facts_checked, split_rejected
from strata.sources.readers import read_countries, read_facts, read_partitioned_strings, read_users
from strata.streaming import read_streamed_facts, start_curated_facts

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}
# Queries that write tables or files before returning their result.
PUBLISHING = (
    "distinct_bitmaps_published",
    "partitioned_round_trip",
    "delimited_round_trip",
    "delimited_users_round_trip",
    "csv_header_round_trip",
    "catalog_round_trip",
    "refined_users_published",
    "refined_facts_published",
    "facts_curated_stream",
    "run_log_rows",
    "profile_raw_summary",
    "bucketed_round_trip",
    "key_bucket_lookup",
    "catalog_partitioned_round_trip",
    "refined_countries_published",
    "refined_horoscopes_published",
    "profile_curated_summary",
    "refined_facts_bucketed",
    "refined_facts_switched",
    "bucketed_facts_per_user",
    "bucketed_exclusion",
    "published_counts",
    "catalog_evolved_facts",
    "rejected_lines",
)


def register(name: str, sql: str | None):
    """Register a driver query under ``name`` with its DuckDB oracle SQL
    (written against the views of ``driver_tables.SQL_VIEWS``)."""

    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_settings(spark)
            return as_ntz(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = V.with_views(sql)
        return run

    return wrap


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamp columns as ``timestamp_ntz`` (session time zone is UTC)."""
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else col(f.name)
            for f in df.schema.fields
        ]
    )


# Shared building blocks -----------------------------------------------------


def _users_curated(spark, sf_dir) -> DataFrame:
    return clean_users(V.raw_users(spark, sf_dir), V.DRIVER_PREFIX_RULES)


def _countries_curated(spark, sf_dir) -> DataFrame:
    return clean_countries(V.raw_countries(spark, sf_dir), V.DRIVER_CONTINENT_MAP)


def _facts_parsed(spark, sf_dir) -> DataFrame:
    return V.raw_facts(spark, sf_dir).select("*", parse_timestamp("fact_date").alias("fact_timestamp"))


def _facts_curated(spark, sf_dir) -> DataFrame:
    return clean_facts(V.raw_facts(spark, sf_dir), V.raw_users(spark, sf_dir))


def _countries_by_name(spark, sf_dir) -> DataFrame:
    return read_countries_frame(V.raw_countries(spark, sf_dir))


def read_countries_frame(raw: DataFrame) -> DataFrame:
    """Raw countries with clean headers and ``name`` as ``country``."""
    return trim_headers(raw).withColumnRenamed("name", "country")


# Parsing and mapping (X1-X9) -------------------------------------------------


@register(
    "parse_registered_date",
    """
SELECT o_orderkey, strftime(o_orderdate, '%b %-d, %Y') AS registered,
       CAST(try_strptime(strftime(o_orderdate, '%b %-d, %Y'), '%b %-d, %Y') AS DATE) AS register_date
FROM orders""",
)
def parse_registered_date(spark, sf_dir):
    """Month-name date text -> DATE, over every order date."""
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", V.REGISTERED_TEXT).alias("registered"))
    return o.withColumn("register_date", parse_date("registered"))


@register(
    "parse_bad_date_to_null",
    """
SELECT o_orderkey, o_orderpriority,
       CASE o_orderpriority WHEN '5-LOW' THEN 'Sept' || substr(strftime(o_orderdate, '%b %-d, %Y'), 4)
            WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%b %-d %Y')
            WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%b %-d, %Y x')
            WHEN '2-HIGH' THEN upper(strftime(o_orderdate, '%b %-d, %Y'))
            ELSE strftime(o_orderdate, '%b %-d, %Y') END AS registered,
       CASE WHEN o_orderpriority IN ('5-LOW', '2-HIGH') THEN NULL ELSE CAST(o_orderdate AS DATE) END AS register_date
FROM orders""",
)
def parse_bad_date_to_null(spark, sf_dir):
    """Month names of another length or case become null, a missing comma
    or a further part does not matter; the job does not fail."""
    o = V.table(spark, sf_dir, "orders")
    text, priority = F.date_format("o_orderdate", V.REGISTERED_TEXT), F.col("o_orderpriority")
    o = o.select(
        "o_orderkey",
        "o_orderpriority",
        F.when(priority == "5-LOW", F.concat(F.lit("Sept"), text.substr(F.lit(4), F.length(text))))
        .when(priority == "4-NOT SPECIFIED", F.replace(text, F.lit(","), F.lit("")))
        .when(priority == "3-MEDIUM", F.concat(text, F.lit(" x")))
        .when(priority == "2-HIGH", F.upper(text))
        .otherwise(text)
        .alias("registered"),
    )
    return o.withColumn("register_date", parse_date("registered"))


@register(
    "parse_fact_timestamp",
    "SELECT event_id, fact_date, fact_timestamp FROM facts_parsed",
)
def parse_fact_timestamp(spark, sf_dir):
    """ISO text with ``Z`` -> TIMESTAMP; unparsable text -> null."""
    return _facts_parsed(spark, sf_dir).select("event_id", "fact_date", "fact_timestamp")


@register(
    "fact_date_parts",
    """
SELECT event_id, CAST(year(fact_timestamp) AS INTEGER) AS year, CAST(month(fact_timestamp) AS INTEGER) AS month,
       CAST(day(fact_timestamp) AS INTEGER) AS day
FROM facts_parsed""",
)
def fact_date_parts(spark, sf_dir):
    """Year, month and day of the fact time."""
    df = facts_with_year_month(_facts_parsed(spark, sf_dir))
    return df.select("event_id", "year", "month", day_of("fact_timestamp").alias("day"))


@register(
    "map_country_prefix",
    f"""
SELECT "#id", country, {V._prefix_sql('country', V.DRIVER_PREFIX_RULES)} AS country_name FROM users_raw""",
)
def map_country_prefix(spark, sf_dir):
    """Ordered literal-prefix rules, first match wins, else the value."""
    u = V.raw_users(spark, sf_dir)
    return u.select(col("#id"), "country", map_prefix("country", V.DRIVER_PREFIX_RULES).alias("country_name"))


@register(
    "map_prefix_rule_table",
    """
SELECT p_partkey, p_type, coalesce(value, p_type) AS mapped FROM part LEFT JOIN (
  SELECT p.p_partkey AS k, arg_min(r.value, r.n) AS value
  FROM part p JOIN (SELECT DISTINCT p_type AS prefix, 'whole ' || p_type AS value, 2 AS n FROM part
    UNION ALL SELECT DISTINCT left(p_type, 8), 'begins ' || left(p_type, 8), CASE WHEN left(p_type, 1) < 'M' THEN 1 ELSE 3 END FROM part) r
  ON starts_with(p.p_type, r.prefix) GROUP BY p.p_partkey) ON k = p_partkey""",
)
def map_prefix_rule_table(spark, sf_dir):
    """X2, F5 with the rules as a table: whole part types and their beginnings, the first by number."""
    part = V.table(spark, sf_dir, "part")
    whole = part.select(F.col("p_type").alias("prefix"), F.concat(F.lit("whole "), "p_type").alias("value"), F.lit(2).alias("n"))
    begin = F.substring("p_type", 1, 8)
    short = part.select(begin.alias("prefix"), F.concat(F.lit("begins "), begin).alias("value"), F.when(F.substring("p_type", 1, 1) < "M", 1).otherwise(3).alias("n"))
    return map_prefix_rules(part.select("p_partkey", "p_type"), "p_type", whole.union(short).distinct(), "mapped")


@register(
    "map_continent_exact",
    f"""
SELECT c.c_custkey, coalesce(k.continente, 'Sin continente') AS continente,
       coalesce({V._continent_sql('k.continente', V.DRIVER_CONTINENT_MAP)}, 'Without continent') AS continent
FROM customer c
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT DISTINCT " name" AS country, continente FROM countries_raw) k ON k.country = n.n_name""",
)
def map_continent_exact(spark, sf_dir):
    """Exact continent mapping with null defaults, per customer."""
    countries = read_countries_frame(V.raw_countries(spark, sf_dir)).select("country", "continente").distinct()
    nation = V.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    cust = V.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = lookup_joins(cust, [Lookup(nation, "c_nationkey", "n_nationkey"), Lookup(countries, "country")])
    return df.select(
        "c_custkey",
        fill_null("continente", "Sin continente").alias("continente"),
        fill_null(map_exact("continente", V.DRIVER_CONTINENT_MAP), "Without continent").alias("continent"),
    )


# Joins (J1-J6) ---------------------------------------------------------------


@register(
    "exclude_invalid_users",
    "SELECT event_id, user_id FROM facts_curated",
)
def exclude_invalid_users(spark, sf_dir):
    """Drop facts without a user or of an invalid user."""
    return _facts_curated(spark, sf_dir).select("event_id", "user_id")


@register(
    "anti_keeps_null_keys",
    """
SELECT f.event_id, f.user_id FROM facts_raw f
WHERE NOT EXISTS (SELECT 1 FROM users_raw u WHERE u.registered IS NULL AND u."#id" = f.user_id)""",
)
def anti_keeps_null_keys(spark, sf_dir):
    """A plain left-anti join keeps facts whose user is null."""
    facts = V.raw_facts(spark, sf_dir)
    bad = invalid_users(V.raw_users(spark, sf_dir))
    return anti_join(facts, bad, "user_id", "#id").select("event_id", "user_id")


@register(
    "unmatched_dimension_values",
    """
SELECT DISTINCT u.country FROM users_raw u
WHERE NOT EXISTS (SELECT 1 FROM countries_raw k WHERE k." name" = u.country)""",
)
def unmatched_dimension_values(spark, sf_dir):
    """User countries unknown to the country table (null listed)."""
    return Q.unmatched_values(V.raw_users(spark, sf_dir), "country", _countries_by_name(spark, sf_dir), "country")


@register(
    "unmatched_after_mapping",
    f"""
SELECT DISTINCT u.country FROM (
  SELECT country, {V._prefix_sql('country', V.DRIVER_PREFIX_RULES)} AS country_name FROM users_raw) u
WHERE NOT EXISTS (SELECT 1 FROM countries_curated k WHERE k.country = u.country_name)""",
)
def unmatched_after_mapping(spark, sf_dir):
    """The raw countries whose mapped name is not among the curated
    countries (the added rows included)."""
    return unmatched_mapped(V.raw_users(spark, sf_dir), _countries_curated(spark, sf_dir), V.DRIVER_PREFIX_RULES)


@register(
    "users_unmatched_lookup",
    """
SELECT user_id, register_month, register_day, CAST(NULL AS VARCHAR) AS horoscope FROM users_refined WHERE register_month = 2""",
)
def users_unmatched_lookup(spark, sf_dir):
    """F8: left join of a calendar without February, then the rows whose
    looked-up column is null."""
    u = with_register_parts(_users_curated(spark, sf_dir).withColumnRenamed("#id", "user_id"))
    u = add_horoscope(u, V.raw_horoscopes(spark).where(F.col("Month") != "2"))
    return rows_missing_lookup(u, "horoscope").select("user_id", "register_month", "register_day", "horoscope")


@register(
    "enrich_users_calendar",
    """
SELECT user_id, register_date, register_month, register_day, horoscope FROM users_refined""",
)
def enrich_users_calendar(spark, sf_dir):
    """Left lookup on (day, month), both sides as INT."""
    u = with_register_parts(_users_curated(spark, sf_dir).withColumnRenamed("#id", "user_id"))
    u = add_horoscope(u, V.raw_horoscopes(spark))
    return u.select("user_id", "register_date", "register_month", "register_day", "horoscope")


@register(
    "enrich_users_country",
    "SELECT user_id, country_name, continent FROM users_refined",
)
def enrich_users_country(spark, sf_dir):
    """Left lookup of the continent; the right key is dropped."""
    u = _users_curated(spark, sf_dir).withColumnRenamed("#id", "user_id")
    u = add_continent(u, _countries_curated(spark, sf_dir))
    return u.select("user_id", "country_name", "continent")


@register("enriched_users", "SELECT * FROM users_refined")
def enriched_users(spark, sf_dir):
    """C6 (flagship): curated users enriched with sign and continent."""
    return enrich_users(_users_curated(spark, sf_dir), V.raw_horoscopes(spark), _countries_curated(spark, sf_dir))


@register(
    "users_without_sign",
    """
SELECT u."#id" AS user_id, u.register_date,
       CAST(month(u.register_date) AS INTEGER) AS register_month, CAST(day(u.register_date) AS INTEGER) AS register_day
FROM users_curated u
WHERE NOT EXISTS (
  SELECT 1 FROM calendar h
  WHERE TRY_CAST(h."Month" AS INTEGER) <> 2
    AND TRY_CAST(h."Day" AS INTEGER) = day(u.register_date)
    AND TRY_CAST(h."Month" AS INTEGER) = month(u.register_date))""",
)
def users_without_sign_q(spark, sf_dir):
    """Users with no calendar row (February left out of the calendar)."""
    cal = V.raw_horoscopes(spark).where(to_int("Month") != 2)
    out = users_without_sign(_users_curated(spark, sf_dir), cal)
    return out.select("user_id", "register_date", "register_month", "register_day")


# Composite jobs (C1-C5) --------------------------------------------------------


@register("countries_curated", "SELECT * FROM countries_curated")
def countries_curated(spark, sf_dir):
    """Cleaned countries with an added row."""
    return _countries_curated(spark, sf_dir)


@register("users_curated", "SELECT * FROM users_curated")
def users_curated(spark, sf_dir):
    """Mapped country name, valid users only, parsed registration date."""
    return _users_curated(spark, sf_dir)


@register("facts_curated", "SELECT * FROM facts_curated")
def facts_curated(spark, sf_dir):
    """C4: parsed fact time, facts of invalid or missing users removed."""
    return _facts_curated(spark, sf_dir)


@register(
    "facts_year_month",
    """
SELECT event_id, user_id, CAST(year(fact_timestamp) AS INTEGER) AS year, CAST(month(fact_timestamp) AS INTEGER) AS month
FROM facts_curated""",
)
def facts_year_month(spark, sf_dir):
    """Curated facts with year and month columns."""
    return facts_with_year_month(_facts_curated(spark, sf_dir)).select("event_id", "user_id", "year", "month")


# Aggregations and data-quality checks (A1-A7, Q1-Q11) -------------------------------


@register(
    "facts_per_user",
    "SELECT user_id, count(user_id) AS total_facts FROM facts_raw GROUP BY user_id",
)
def facts_per_user(spark, sf_dir):
    """A4, Q7: facts per user; the null user group reports 0."""
    return Q.group_counts(V.raw_facts(spark, sf_dir), "user_id", "total_facts")


@register(
    "user_key_uniqueness",
    """
SELECT CAST(sum(n) AS BIGINT) AS total_ids, count(*) AS distinct_ids, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_ids
FROM (SELECT "#id", count(*) AS n FROM users_raw GROUP BY "#id")""",
)
def user_key_uniqueness(spark, sf_dir):
    """A1, A2, Q2: total vs distinct user ids."""
    return Q.key_uniqueness(V.raw_users(spark, sf_dir), "#id")


@register(
    "fact_key_uniqueness",
    """
SELECT CAST(sum(n) AS BIGINT) AS total_ids, count(*) AS distinct_ids, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_ids
FROM (SELECT user_id, count(*) AS n FROM facts_raw GROUP BY user_id)""",
)
def fact_key_uniqueness(spark, sf_dir):
    """A2, Q2 on a repeated key with nulls: a null id counts as one value."""
    return Q.key_uniqueness(V.raw_facts(spark, sf_dir), "user_id")


_PROFILE_COLUMNS = ["user_id", "fact_date", "group_id", "group_name", "song_id", "song_name", "fact_timestamp"]


@register(
    "null_profile",
    "SELECT count(*) AS rows, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in _PROFILE_COLUMNS)
    + " FROM facts_parsed",
)
def null_profile(spark, sf_dir):
    """Row count and per-column null counts in one pass."""
    return Q.null_profile(_facts_parsed(spark, sf_dir), _PROFILE_COLUMNS)


@register(
    "users_missing_values",
    """
SELECT count(*) AS rows, count(*) FILTER (WHERE registered IS NULL) AS registered_nulls,
       count(*) FILTER (WHERE country IS NULL) AS country_nulls,
       count(*) FILTER (WHERE country IS NULL AND registered IS NOT NULL) AS country_missing_registered_present
FROM users_raw""",
)
def users_missing_values(spark, sf_dir):
    """Users without registration / country, one pass."""
    u = V.raw_users(spark, sf_dir)
    return Q.null_profile(
        u,
        ["registered", "country"],
        {"country_missing_registered_present": col("country").isNull() & col("registered").isNotNull()},
    )


@register(
    "users_without_country",
    """SELECT "#id", c_name, country, registered FROM users_raw WHERE country IS NULL AND registered IS NOT NULL""",
)
def users_without_country(spark, sf_dir):
    """Users with a registration text but no country."""
    return Q.missing_country_with_date(V.raw_users(spark, sf_dir))


@register(
    "unparsed_timestamps",
    "SELECT event_id, user_id, fact_date FROM facts_parsed WHERE fact_date IS NOT NULL AND fact_timestamp IS NULL",
)
def unparsed_timestamps(spark, sf_dir):
    """Time text present, parse null."""
    return Q.unparsed_values(_facts_parsed(spark, sf_dir), "fact_date", "fact_timestamp").select("event_id", "user_id", "fact_date")


@register(
    "facts_missing_names",
    """
SELECT event_id, group_name, song_name FROM facts_raw WHERE song_name IS NULL OR group_name IS NULL""",
)
def facts_missing_names(spark, sf_dir):
    """F2, Q3: facts without a song or group name."""
    f = V.raw_facts(spark, sf_dir)
    return Q.null_rows(f, col("song_name").isNull() | col("group_name").isNull()).select("event_id", "group_name", "song_name")


@register(
    "distinct_pairs_count",
    """
SELECT (SELECT count(*) FROM (SELECT DISTINCT p_name FROM part)) AS names,
       (SELECT count(*) FROM (SELECT DISTINCT p_name, p_brand FROM part)) AS name_brand_pairs,
       (SELECT count(*) FROM (SELECT DISTINCT p_name, p_brand, p_type, p_size FROM part)) AS name_brand_type_size""",
)
def distinct_pairs_count(spark, sf_dir):
    """Distinct rows of 1, 2 and 4 columns in one scan."""
    part = V.table(spark, sf_dir, "part")
    return Q.distinct_counts(
        part,
        {
            "names": ["p_name"],
            "name_brand_pairs": ["p_name", "p_brand"],
            "name_brand_type_size": ["p_name", "p_brand", "p_type", "p_size"],
        },
    )


@register(
    "fact_distinct_counts",
    """
SELECT (SELECT count(*) FROM (SELECT DISTINCT group_name FROM facts_raw)) AS group_names,
       (SELECT count(*) FROM (SELECT DISTINCT group_name, group_id FROM facts_raw)) AS group_name_id_pairs,
       (SELECT count(*) FROM (SELECT DISTINCT song_name FROM facts_raw)) AS song_names,
       (SELECT count(*) FROM (SELECT DISTINCT group_name, song_name, group_id, song_id FROM facts_raw)) AS name_id_quadruples""",
)
def fact_distinct_counts(spark, sf_dir):
    """A2, A3: distinct counts where a null counts as a value."""
    return Q.distinct_counts(
        V.raw_facts(spark, sf_dir),
        {
            "group_names": ["group_name"],
            "group_name_id_pairs": ["group_name", "group_id"],
            "song_names": ["song_name"],
            "name_id_quadruples": ["group_name", "song_name", "group_id", "song_id"],
        },
    )


@register(
    "fd_violations",
    "SELECT p_name, count(DISTINCT p_brand) AS n_brands FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1",
)
def fd_violations(spark, sf_dir):
    """Names carried by more than one brand."""
    return Q.fd_violations(V.table(spark, sf_dir, "part"), "p_name", "p_brand", "n_brands")


@register(
    "group_name_ids",
    """
SELECT group_name, count(DISTINCT group_id) AS n_group_ids FROM facts_raw
GROUP BY group_name HAVING count(DISTINCT group_id) > 1""",
)
def group_name_ids(spark, sf_dir):
    """Q5: a group name with more than one group id."""
    return Q.fd_violations(V.raw_facts(spark, sf_dir), "group_name", "group_id", "n_group_ids")


@register(
    "group_ids_of_name",
    "SELECT DISTINCT group_id, group_name FROM facts_raw WHERE group_name = 'purchase'",
)
def group_ids_of_name(spark, sf_dir):
    """The ids one named group is carried by (a SQL-text
    predicate on a constant, a column subset, distinct)."""
    return V.raw_facts(spark, sf_dir).where("group_name = 'purchase'").select("group_id", "group_name").distinct()


@register(
    "multi_count_distinct",
    """
SELECT group_name,
       count(DISTINCT CASE WHEN user_id IS NOT NULL AND song_name IS NOT NULL THEN row(user_id, song_name) END) AS n_user_songs
FROM facts_raw GROUP BY group_name""",
)
def multi_count_distinct(spark, sf_dir):
    """A5: ``count(DISTINCT a, b)`` skips rows where any argument is null."""
    f = V.raw_facts(spark, sf_dir)
    return f.groupBy("group_name").agg(F.count_distinct("user_id", "song_name").alias("n_user_songs"))


@register(
    "duplicate_naming",
    """
SELECT group_name, song_name,
       count(DISTINCT CASE WHEN group_id IS NOT NULL AND song_id IS NOT NULL THEN row(group_id, song_id) END) AS n_id_pairs
FROM facts_curated GROUP BY group_name, song_name
HAVING count(DISTINCT CASE WHEN group_id IS NOT NULL AND song_id IS NOT NULL THEN row(group_id, song_id) END) > 1""",
)
def duplicate_naming(spark, sf_dir):
    """Q6, A5: (group, song) names carried by several (group id, song id) pairs."""
    return Q.duplicate_naming(_facts_curated(spark, sf_dir))


@register(
    "filter_impact",
    """
SELECT (SELECT count(*) FROM facts_raw) AS rows_before, (SELECT count(*) FROM facts_curated) AS rows_after,
       (SELECT count(*) FROM facts_raw) - (SELECT count(*) FROM facts_curated) AS rows_removed""",
)
def filter_impact(spark, sf_dir):
    """Facts before and after the exclusion, one row."""
    bad = invalid_users(V.raw_users(spark, sf_dir))
    return Q.filter_impact(V.raw_facts(spark, sf_dir), bad, "user_id", "#id")


@register(
    "dup_dimension_rows",
    """SELECT " name" AS country, count(*) AS copies FROM countries_raw GROUP BY " name" HAVING count(*) > 1""",
)
def dup_dimension_rows(spark, sf_dir):
    """Q10, F1: countries on more than one raw row (before de-duplication)."""
    return Q.duplicate_keys(_countries_by_name(spark, sf_dir), "country")


@register(
    "dup_dimension_rows_after",
    """
SELECT country, count(*) AS copies FROM (
  SELECT country, pais, continente, continent FROM countries_curated UNION SELECT 'NATION_3', 'NACION_3', 'X', 'Y'
) GROUP BY country HAVING count(*) > 1""",
)
def dup_dimension_rows_after(spark, sf_dir):
    """Q10: after curation only a country with rows that differ remains (one
    is added here); the rows that differ in codes alone are gone."""
    added = (*D.ADDED_COUNTRIES, ("NACION_3", "NATION_3", "X", "Y"))
    return Q.duplicate_keys(clean_countries(V.raw_countries(spark, sf_dir), V.DRIVER_CONTINENT_MAP, added), "country")


@register(
    "preview_rows",
    "SELECT * FROM facts_raw ORDER BY event_id LIMIT 20",
)
def preview_rows(spark, sf_dir):
    """The 20 lowest event ids (a top-k report)."""
    return Q.preview(V.raw_facts(spark, sf_dir), 20, "event_id")


# Profiling reports (E3) ------------------------------------------------------------

_FACT_COLUMNS = ("user_id", "fact_date", "group_id", "group_name", "song_id", "song_name", "fact_timestamp")
_DRIVER_GROUP, _DRIVER_SONG = "purchase", '{"k": 7}'


def _rows_sql(query: str) -> dict[str, str]:
    return {"rows": f"SELECT count(*) FROM ({query})"}


def _nulls_sql(view: str, columns) -> dict[str, str]:
    return {"rows": f"SELECT count(*) FROM {view}", **{f"{c}_nulls": f"SELECT count(*) FROM {view} WHERE {c} IS NULL" for c in columns}}


_REDUCED_USERS = f"SELECT country, {V._prefix_sql('country', V.DRIVER_PREFIX_RULES)} AS country_name FROM users_raw"
_RAW_PROFILE_SQL = {
    "unmatched_countries_before": _rows_sql("""SELECT DISTINCT country FROM users_raw u
        WHERE NOT EXISTS (SELECT 1 FROM countries_raw k WHERE k." name" = u.country)"""),
    "unmatched_countries_after": _rows_sql(f"""SELECT DISTINCT country FROM ({_REDUCED_USERS}) u
        WHERE NOT EXISTS (SELECT 1 FROM countries_curated k WHERE k.country = u.country_name)"""),
    "duplicate_countries_before": _rows_sql('SELECT " name" FROM countries_raw GROUP BY 1 HAVING count(*) > 1'),
    "duplicate_countries_after": _rows_sql("SELECT country FROM countries_curated GROUP BY 1 HAVING count(*) > 1"),
    "countries_without_continent": _rows_sql("SELECT 1 FROM countries_raw WHERE continente IS NULL"),
    "countries_without_continent_after": _rows_sql("SELECT 1 FROM countries_curated WHERE continente IS NULL OR continent IS NULL"),
    "user_key_uniqueness": {
        "total_ids": "SELECT count(*) FROM users_raw",
        "distinct_ids": 'SELECT count(*) FROM (SELECT DISTINCT "#id" FROM users_raw)',
        "duplicate_ids": 'SELECT (SELECT count(*) FROM users_raw) - (SELECT count(*) FROM (SELECT DISTINCT "#id" FROM users_raw))',
    },
    "users_profile": {
        **_nulls_sql("users_raw", ["registered", "country"]),
        "country_missing_registered_present": "SELECT count(*) FROM users_raw WHERE country IS NULL AND registered IS NOT NULL",
    },
    "users_without_registration": _rows_sql("SELECT 1 FROM users_raw WHERE registered IS NULL"),
    "users_without_country": _rows_sql("SELECT 1 FROM users_raw WHERE country IS NULL AND registered IS NOT NULL"),
    "unparsed_timestamps": _rows_sql("SELECT 1 FROM facts_parsed WHERE fact_date IS NOT NULL AND fact_timestamp IS NULL"),
    "facts_per_user": {
        "users": "SELECT count(*) FROM (SELECT DISTINCT user_id FROM facts_raw)",
        "facts": "SELECT count(user_id) FROM facts_raw",
        "most": "SELECT max(n) FROM (SELECT count(user_id) AS n FROM facts_raw GROUP BY user_id)",
    },
    "facts_profile": {
        **_nulls_sql("facts_parsed", _FACT_COLUMNS),
        "unparsed_timestamps": "SELECT count(*) FROM facts_parsed WHERE fact_date IS NOT NULL AND fact_timestamp IS NULL",
    },
    "facts_without_date": _rows_sql("SELECT 1 FROM facts_raw WHERE fact_date IS NULL"),
    "facts_without_song": _rows_sql("SELECT 1 FROM facts_raw WHERE song_name IS NULL"),
    "facts_without_group": _rows_sql("SELECT 1 FROM facts_raw WHERE group_name IS NULL"),
    "group_name_ids": _rows_sql("SELECT group_name FROM facts_raw GROUP BY 1 HAVING count(DISTINCT group_id) > 1"),
    "audited_group_ids": _rows_sql(f"SELECT DISTINCT group_id, group_name FROM facts_raw WHERE group_name = '{_DRIVER_GROUP}'"),
    "audited_song_ids": _rows_sql(f"SELECT DISTINCT song_id, song_name, group_name FROM facts_raw WHERE song_name = '{_DRIVER_SONG}'"),
    "filter_impact": {
        "rows_before": "SELECT count(*) FROM facts_raw",
        "rows_after": "SELECT count(*) FROM facts_curated",
        "rows_removed": "SELECT (SELECT count(*) FROM facts_raw) - (SELECT count(*) FROM facts_curated)",
    },
    "users_preview": _rows_sql("SELECT 1 FROM users_raw LIMIT 20"),
    "countries_preview": _rows_sql("SELECT 1 FROM countries_curated LIMIT 20"),
    "facts_preview": _rows_sql("SELECT 1 FROM facts_raw LIMIT 20"),
    "horoscopes_preview": _rows_sql("SELECT 1 FROM calendar LIMIT 20"),
}

_CURATED_PROFILE_SQL = {
    "users_without_sign": _rows_sql("""SELECT 1 FROM users_curated u WHERE NOT EXISTS (SELECT 1 FROM calendar h
        WHERE TRY_CAST(h."Day" AS INTEGER) = day(u.register_date) AND TRY_CAST(h."Month" AS INTEGER) = month(u.register_date))"""),
    "users_without_continent": _rows_sql("""SELECT DISTINCT country_name FROM users_curated u
        WHERE NOT EXISTS (SELECT 1 FROM countries_curated k WHERE k.country = u.country_name)"""),
    "group_counts": {
        "group_names": "SELECT count(*) FROM (SELECT DISTINCT group_name FROM facts_curated)",
        "group_name_id_pairs": "SELECT count(*) FROM (SELECT DISTINCT group_name, group_id FROM facts_curated)",
        "name_id_quadruples": "SELECT count(*) FROM (SELECT DISTINCT group_name, song_name, group_id, song_id FROM facts_curated)",
    },
    "group_name_ids": _rows_sql("SELECT group_name FROM facts_curated GROUP BY 1 HAVING count(DISTINCT group_id) > 1"),
    "duplicate_naming": _rows_sql("""SELECT group_name, song_name FROM facts_curated GROUP BY 1, 2
        HAVING count(DISTINCT CASE WHEN group_id IS NOT NULL AND song_id IS NOT NULL THEN row(group_id, song_id) END) > 1"""),
    "facts_profile": _nulls_sql("facts_curated", ["group_id", "user_id"]),
    "facts_without_group_id": _rows_sql("SELECT 1 FROM facts_curated WHERE group_id IS NULL"),
    "facts_without_user": _rows_sql("SELECT 1 FROM facts_curated WHERE user_id IS NULL"),
    "users_preview": _rows_sql("SELECT 1 FROM users_curated LIMIT 20"),
    "countries_preview": _rows_sql("SELECT 1 FROM countries_curated LIMIT 20"),
    "facts_preview": _rows_sql("SELECT 1 FROM facts_curated LIMIT 20"),
    "horoscopes_preview": _rows_sql("SELECT 1 FROM calendar LIMIT 20"),
}


def _summary_sql(checks: dict[str, dict[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"check\", '{metric}' AS metric, CAST(({sql}) AS BIGINT) AS value"
        for name, metrics in checks.items()
        for metric, sql in metrics.items()
    )


@register("profile_raw_summary", _summary_sql(_RAW_PROFILE_SQL))
def profile_raw_summary(spark, sf_dir):
    """The raw-layer profiling report's numbers; the parsed facts are
    staged once as Parquet, as the CLI does."""
    checks = profile_raw(
        V.raw_users(spark, sf_dir),
        V.raw_countries(spark, sf_dir),
        V.raw_facts(spark, sf_dir),
        prefix_rules=V.DRIVER_PREFIX_RULES,
        continent_map=V.DRIVER_CONTINENT_MAP,
        stage_path=scratch_path(spark, "profile-stage"),
        group_name=_DRIVER_GROUP,
        song_name=_DRIVER_SONG,
        horoscopes=V.raw_horoscopes(spark),
    )
    return profile_summary(checks)


@register("profile_curated_summary", _summary_sql(_CURATED_PROFILE_SQL))
def profile_curated_summary(spark, sf_dir):
    """The curated-layer profiling report's numbers over staged facts."""
    checks = profile_curated(
        users=_users_curated(spark, sf_dir),
        countries=_countries_curated(spark, sf_dir),
        horoscopes=V.raw_horoscopes(spark),
        facts=_facts_curated(spark, sf_dir),
        stage_path=scratch_path(spark, "profile-curated-stage"),
    )
    return profile_summary(checks)


# Sinks and sources round trips (K1-K5, S1-S4, C8, C9) ---------------------------


@register(
    "partitioned_round_trip",
    "SELECT * FROM facts_parsed",
)
def partitioned_round_trip(spark, sf_dir):
    """Facts written partitioned by user (null user -> the
    default partition), read back whole with a string key."""
    path = scratch_path(spark, "facts-partitioned")
    facts = _facts_parsed(spark, sf_dir)
    write_table(facts, path, partition_by=["user_id"])
    return read_partitioned_strings(spark, path).select(*facts.columns)


@register(
    "bucketed_round_trip",
    "SELECT * FROM facts_curated",
)
def bucketed_round_trip(spark, sf_dir):
    """K2 alternative layout: curated facts partitioned by a bounded hash
    bucket of the user (16 directories however many users), read back whole."""
    path = scratch_path(spark, "facts-bucketed")
    facts = _facts_curated(spark, sf_dir)
    write_table(with_key_bucket(facts, buckets=16), path, partition_by=["user_id_bucket"])
    return spark.read.parquet(path).select(*facts.columns)


@register(
    "key_bucket_lookup",
    """
SELECT 'bigint' AS kind, user_id, event_id FROM events WHERE user_id = 5
UNION ALL SELECT 'int', user_id, event_id FROM events WHERE user_id = 7
UNION ALL SELECT 'string', user_id, event_id FROM events WHERE user_id = 11
UNION ALL SELECT 'null', NULL, event_id FROM events WHERE event_type = 'error'""",
)
def key_bucket_lookup(spark, sf_dir):
    """K2: the rows of one key in a bucketed table, for keys of each type and null."""
    events = V.table(spark, sf_dir, "events").select("event_id", "event_type", F.col("user_id").cast("bigint").alias("user_id"))
    no_user = events.withColumn("user_id", F.when(F.col("event_type") == "error", None).otherwise(F.col("user_id")))
    path = scratch_path(spark, "keys")
    parts = []
    for kind, value, frame, key_type in (("bigint", 5, events, "bigint"), ("int", 7, events, "int"), ("string", "11", events, "string"), ("null", None, no_user, "bigint")):
        keyed = frame.select("event_id", F.col("user_id").cast(key_type).alias("user_id"))
        write_table(with_key_bucket(keyed, buckets=16), f"{path}/{kind}", partition_by=["user_id_bucket"])
        found = spark.read.parquet(f"{path}/{kind}").where(key_bucket_filter(value, buckets=16))
        parts.append(found.select(F.lit(kind).alias("kind"), F.col("user_id").cast("bigint").alias("user_id"), "event_id"))
    return reduce(DataFrame.unionByName, parts)


_NO_TRIM = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _write_raw_files(spark: SparkSession, sf_dir: str, tables=("users", "countries", "horoscopes", "facts")) -> dict[str, str]:
    """Driver tables written as the raw delimited files of the dataset."""
    root = scratch_path(spark, "raw")
    paths = {k: f"{root}/{k}" for k in tables}
    if "users" in paths:
        V.raw_users(spark, sf_dir).write.options(sep="\t", header="true", **_NO_TRIM).csv(paths["users"])
    if "countries" in paths:
        V.raw_countries(spark, sf_dir).write.options(sep=",", header="true", **_NO_TRIM).csv(paths["countries"])
    if "horoscopes" in paths:
        V.raw_horoscopes(spark).write.options(sep=",", header="true", **_NO_TRIM).csv(paths["horoscopes"])
    if "facts" in paths:
        V.raw_facts(spark, sf_dir).write.options(sep="\t", header="false", quote="", **_NO_TRIM).csv(paths["facts"])
    return paths


@register(
    "delimited_round_trip",
    "SELECT user_id, fact_date, group_id, group_name, song_id, song_name, event_id FROM facts_raw",
)
def delimited_round_trip(spark, sf_dir):
    """Headerless tab-separated facts (song names opening an
    unclosed quote) read back by position without shifting columns."""
    paths = _write_raw_files(spark, sf_dir, ["facts"])
    back = read_facts(spark, paths["facts"], extra_columns=["event_id"])
    return back.withColumn("event_id", col("event_id").cast("bigint"))


@register(
    "delimited_users_round_trip",
    "SELECT * FROM users_curated",
)
def delimited_users_round_trip(spark, sf_dir):
    """Headered tab-separated users read back, then curated."""
    paths = _write_raw_files(spark, sf_dir, ["users"])
    return clean_users(read_users(spark, paths["users"]), V.DRIVER_PREFIX_RULES)


@register(
    "csv_header_round_trip",
    "SELECT * FROM countries_curated",
)
def csv_header_round_trip(spark, sf_dir):
    """Comma-separated countries whose headers carry a leading
    space, read back and curated."""
    paths = _write_raw_files(spark, sf_dir, ["countries"])
    return clean_countries(read_countries(spark, paths["countries"]), V.DRIVER_CONTINENT_MAP)


@register(
    "catalog_round_trip",
    "SELECT * FROM users_curated",
)
def catalog_round_trip(spark, sf_dir):
    """Curated users saved as a catalog table, read back by name."""
    root = scratch_path(spark, "catalog")
    ensure_database(spark, "strata_curated", f"{root}/_db")
    save_catalog_table(_users_curated(spark, sf_dir), "strata_curated", "users", path=f"{root}/users")
    return spark.table(table_name("strata_curated", "users"))


@register(
    "catalog_partitioned_round_trip",
    "SELECT * FROM facts_curated",
)
def catalog_partitioned_round_trip(spark, sf_dir):
    """K2, K3: curated facts saved as a catalog table partitioned by user, read back by name."""
    root = scratch_path(spark, "catalog-facts")
    ensure_database(spark, "strata_curated", f"{root}/_db")
    facts = _facts_curated(spark, sf_dir)
    save_catalog_table(facts, "strata_curated", "facts", path=f"{root}/facts", partition_by=["user_id"])
    return spark.table(table_name("strata_curated", "facts")).select(*facts.columns)


def publish_layers(spark: SparkSession, sf_dir: str, names=D.TABLES, **layout) -> str:
    """Raw files -> curated layer -> refined layer of the tables named; returns the root of both."""
    paths = _write_raw_files(spark, sf_dir)
    root = scratch_path(spark, "layers")
    rules = {"prefix_rules": V.DRIVER_PREFIX_RULES, "continent_map": V.DRIVER_CONTINENT_MAP}
    needed = {*names, *(("countries", "horoscopes") if "users" in names else ())}
    run_curated(spark, paths, f"{root}/curated", log_path=f"{root}/run_log", names=needed, **layout, **rules)
    run_refined(spark, f"{root}/curated", f"{root}/refined", log_path=f"{root}/run_log", names=names, **layout)
    return root


def _refined(spark: SparkSession, sf_dir: str, name: str, **layout) -> DataFrame:
    """One refined table, published by a run of both jobs for it."""
    return read_layer(spark, f"{publish_layers(spark, sf_dir, [name], **layout)}/refined", names=[name])[name]


@register("refined_users_published", "SELECT * FROM users_refined")
def refined_users_published(spark, sf_dir):
    """E1 + E2, C8, C9: raw files -> curated layer -> refined layer, the
    refined users read back from the published table."""
    return _refined(spark, sf_dir, "users")


@register(
    "refined_facts_published",
    "SELECT user_id, fact_date, group_id, group_name, song_id, song_name, fact_timestamp FROM facts_curated",
)
def refined_facts_published(spark, sf_dir):
    """The refined facts table (copied from curated, partitioned by user)."""
    return _refined(spark, sf_dir, "facts").select(*_FACT_COLUMNS)


@register("refined_countries_published", "SELECT * FROM countries_curated")
def refined_countries_published(spark, sf_dir):
    """The refined countries table."""
    return _refined(spark, sf_dir, "countries")


@register("refined_horoscopes_published", 'SELECT "Date", "Day", "Month", "Horocope" AS horoscope FROM calendar')
def refined_horoscopes_published(spark, sf_dir):
    """The refined calendar, its sign column renamed."""
    return _refined(spark, sf_dir, "horoscopes")


@register("facts_curated_stream", "SELECT * FROM facts_curated")
def facts_curated_stream(spark, sf_dir):
    """C4 on Structured Streaming: raw fact files cleaned incrementally into
    the partitioned curated table in two runs, read back."""
    raw, target = scratch_path(spark, "stream-raw"), scratch_path(spark, "facts-stream")
    facts = V.raw_facts(spark, sf_dir)
    late = F.col("event_id") % 2 == 1
    for part in (facts.where(~late), facts.where(late)):
        part.write.mode("append").options(sep="\t", header="false", quote="", **_NO_TRIM).csv(raw)
        start_curated_facts(spark, raw, V.raw_users(spark, sf_dir), target, extra_columns=["event_id"]).awaitTermination()
    back = read_streamed_facts(spark, target)
    return back.withColumn("event_id", col("event_id").cast("bigint"))


# Layouts and joins for large tables ---------------------------------------------

_FACTS_SQL = "SELECT user_id, fact_date, group_id, group_name, song_id, song_name, fact_timestamp FROM facts_curated"


@register("refined_facts_bucketed", _FACTS_SQL)
def refined_facts_bucketed(spark, sf_dir):
    """Both layer jobs with the facts as native bucketed tables; the refined copy is not shuffled."""
    return _refined(spark, sf_dir, "facts", bucketed=16).select(*_FACT_COLUMNS)


@register("refined_facts_switched", _FACTS_SQL)
def refined_facts_switched(spark, sf_dir):
    """Both layers published as versions that readers are switched to."""
    return _refined(spark, sf_dir, "facts", switch=True).select(*_FACT_COLUMNS)


def _bucketed_facts(spark, sf_dir) -> DataFrame:
    """All parsed facts in a native bucketed table."""
    path = scratch_path(spark, "facts-native")
    write_bucketed(_facts_parsed(spark, sf_dir), path, buckets=16)
    return read_bucketed(spark, path, most_skew=float("inf"))


@register("bucketed_facts_per_user", "SELECT user_id, count(user_id) AS total_facts FROM facts_parsed GROUP BY user_id")
def bucketed_facts_per_user(spark, sf_dir):
    """A4, Q7 over a bucketed table: facts per user without a shuffle."""
    return Q.group_counts(_bucketed_facts(spark, sf_dir), "user_id")


@register("bucketed_exclusion", "SELECT * FROM facts_curated")
def bucketed_exclusion(spark, sf_dir):
    """J5, F6 over a bucketed table: a list of any size is excluded without a shuffle of the facts."""
    facts = _bucketed_facts(spark, sf_dir)
    return exclude_keys(facts, invalid_users(V.raw_users(spark, sf_dir)), "user_id", "#id", broadcast_max_rows=None)


@register("exclusion_by_bitmap", "SELECT * FROM facts_curated")
def exclusion_by_bitmap(spark, sf_dir):
    """J5, F6 with a list above the broadcast bound: a bitmap of it keeps other facts out of the shuffle."""
    return exclude_keys(_facts_parsed(spark, sf_dir), invalid_users(V.raw_users(spark, sf_dir)), "user_id", "#id", broadcast_max_rows=1)


@register("enrich_users_above_bound", "SELECT * FROM users_refined")
def enrich_users_above_bound(spark, sf_dir):
    """J3, J4, C6 with lookups above the broadcast bound: hot keys are joined apart from the shuffle joins."""
    users, countries = _users_curated(spark, sf_dir), _countries_curated(spark, sf_dir)
    return enrich_users(users, V.raw_horoscopes(spark), countries, broadcast_max_rows=1)


_NAME_SETS = {
    "group_names": ["group_name"],
    "group_name_id_pairs": ["group_name", "group_id"],
    "song_names": ["song_name"],
    "name_id_quadruples": ["group_name", "song_name", "group_id", "song_id"],
    "users": ["user_id"],
}


def _distinct_sql(levels: dict[str, list[str]], view: str) -> str:
    parts = []
    for level, keys in levels.items():
        for name, cols in _NAME_SETS.items():
            each = f"SELECT DISTINCT {', '.join([*keys, *cols])} FROM {view}"
            shown = ", ".join(k if k in keys else f"CAST(NULL AS INTEGER) AS {k}" for k in ("year", "month"))
            parts.append(f"SELECT '{level}' AS level, {shown}, '{name}' AS column_set, count(*) AS n FROM ({each}) GROUP BY {'ALL' if keys else '()'} HAVING count(*) > 0")
    return "\nUNION ALL ".join(parts)


_LEVELS = {"month": ["year", "month"], "year": ["year"], "all": []}
_DATED = "(SELECT *, CAST(year(fact_timestamp) AS INTEGER) AS year, CAST(month(fact_timestamp) AS INTEGER) AS month FROM facts_parsed)"


def _rolled_up(bitmaps: DataFrame) -> DataFrame:
    parts = []
    for level, keys in _LEVELS.items():
        n = count_bitmaps(bitmaps, keys)
        shown = [F.col(k) if k in keys else F.lit(None).cast("int").alias(k) for k in ("year", "month")]
        parts.append(n.select(F.lit(level).alias("level"), *shown, "column_set", "n"))
    return reduce(DataFrame.unionByName, parts)


@register("distinct_by_bitmap", _distinct_sql(_LEVELS, _DATED))
def distinct_by_bitmap(spark, sf_dir):
    """Distinct names, ids and users a month, year and in all; one shuffle of the facts, the rest from bitmaps."""
    return _rolled_up(distinct_bitmaps(facts_with_year_month(_facts_parsed(spark, sf_dir)), _NAME_SETS, ["year", "month"]))


@register("distinct_bitmaps_published", _distinct_sql(_LEVELS, _DATED))
def distinct_bitmaps_published(spark, sf_dir):
    """A2, A3 over several runs: the second run adds its facts' bits, the first one's facts are not read again."""
    path = scratch_path(spark, "distinct")
    facts = facts_with_year_month(_facts_parsed(spark, sf_dir))
    for run in (facts.where("event_id % 3 = 0"), facts.where("event_id % 3 <> 0")):
        publish_bitmaps(run, path, _NAME_SETS, ["year", "month"])
    return _rolled_up(read_bitmaps(spark, path))


@register(
    "catalog_evolved_facts",
    """
SELECT user_id, fact_date, song_id, CAST(NULL AS VARCHAR) AS group_id FROM facts_parsed WHERE event_id % 3 <> 0 AND event_id % 8 < 4
UNION ALL SELECT user_id, fact_date, NULL, group_id FROM facts_parsed WHERE event_id % 8 >= 4""",
)
def catalog_evolved_facts(spark, sf_dir):
    """K3: two runs into one catalog table; the second brings a column, lacks another and replaces its own partitions."""
    root = scratch_path(spark, "catalog-evolved")
    ensure_database(spark, "strata_evolved", f"{root}/_db")
    spark.sql("DROP TABLE IF EXISTS strata_evolved.facts")
    facts = _facts_parsed(spark, sf_dir).withColumn("part", F.expr("CAST(event_id % 8 AS INT)"))
    first = facts.where("event_id % 3 <> 0").select("user_id", "fact_date", "song_id", "part")
    second = facts.where("part >= 4").select("user_id", "group_id", "fact_date", "part")
    for run in (first, second):
        update_catalog_table(run, "strata_evolved", "facts", f"{root}/facts", partition_by=["part"])
    return spark.table("strata_evolved.facts").select("user_id", "fact_date", "song_id", "group_id")


@register(
    "rejected_lines",
    """
SELECT CASE WHEN event_id % 50 = 0 THEN 'short' WHEN event_id % 50 = 1 THEN 'long' ELSE 'row' END AS kind, count(*) AS n, count(DISTINCT event_id) AS events
FROM events GROUP BY kind""",
)
def rejected_lines(spark, sf_dir):
    """Raw fact lines with fields missing or too many, quarantined with their text; rows and lines add up."""
    root = scratch_path(spark, "rejected")
    kind = F.expr("CASE WHEN event_id % 50 = 0 THEN 'short' WHEN event_id % 50 = 1 THEN 'long' ELSE 'row' END")
    fields = [F.col("event_id").cast("string"), F.lit("2009-05-04T23:08:57Z"), F.lit("g"), F.lit("G"), F.lit("s")]
    line = F.when(kind == "short", F.concat_ws("\t", *fields)).when(kind == "long", F.concat_ws("\t", *fields, F.lit("S"), F.lit("more"))).otherwise(F.concat_ws("\t", *fields, F.lit("S")))
    V.table(spark, sf_dir, "events").select(line).write.text(f"{root}/raw")
    good, bad = split_rejected(read_facts_checked(spark, f"{root}/raw"))
    quarantine(bad, f"{root}/quarantine")
    held = spark.read.parquet(f"{root}/quarantine").select(F.when(F.size(F.split("line", "\t")) < 6, "short").otherwise("long").alias("kind"), F.split("line", "\t")[0].alias("id"))
    every = good.select(F.lit("row").alias("kind"), F.col("user_id").alias("id")).unionByName(held)
    return every.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("id").alias("events"))


@register(
    "published_counts",
    """
SELECT place, metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'users_raw' AS place, 'rows' AS metric, count(*) AS value FROM users_raw
  UNION ALL SELECT 'users_raw', 'country_nulls', count(*) FROM users_raw WHERE country IS NULL
  UNION ALL SELECT 'users_raw', 'registered_nulls', count(*) FROM users_raw WHERE registered IS NULL
  UNION ALL SELECT 'users_raw', 'missing_country_with_date', count(*) FROM users_raw WHERE country IS NULL AND registered IS NOT NULL
  UNION ALL SELECT 'users', 'rows', count(*) FROM users_curated
  UNION ALL SELECT 'users', 'country_name_nulls', count(*) FROM users_curated WHERE country_name IS NULL
  UNION ALL SELECT 'users', 'unparsed_dates', count(*) FROM users_curated WHERE register_date IS NULL
  UNION ALL SELECT 'facts_raw', 'rows', count(*) FROM facts_raw
  UNION ALL SELECT 'facts_raw', c || '_nulls', n FROM (
    UNPIVOT (SELECT count(*) - count(user_id) AS user_id, count(*) - count(fact_date) AS fact_date, count(*) - count(group_id) AS group_id,
      count(*) - count(group_name) AS group_name, count(*) - count(song_id) AS song_id, count(*) - count(song_name) AS song_name FROM facts_raw)
    ON COLUMNS(*) INTO NAME c VALUE n)
  UNION ALL SELECT 'facts', 'rows', count(*) FROM facts_curated
  UNION ALL SELECT 'facts', 'group_id_nulls', count(*) FROM facts_curated WHERE group_id IS NULL
  UNION ALL SELECT 'facts', 'song_id_nulls', count(*) FROM facts_curated WHERE song_id IS NULL
  UNION ALL SELECT 'facts', 'unparsed_timestamps', count(*) FROM facts_curated WHERE fact_date IS NOT NULL AND fact_timestamp IS NULL
)""",
)
def published_counts(spark, sf_dir):
    """The reports' counts, taken while the curated layer is written, without another scan."""
    probes = Probes()
    root = scratch_path(spark, "counted")
    rules = {"prefix_rules": V.DRIVER_PREFIX_RULES, "continent_map": V.DRIVER_CONTINENT_MAP}
    run_curated(spark, _write_raw_files(spark, sf_dir), f"{root}/curated", bucketed=16, probes=probes, **rules)
    return probes.frame(spark)


def _run_log_sql() -> str:
    entries = []
    for job, first, users in (("curated", "read_raw", "users_curated"), ("refined", "read_curated", "users_refined")):
        tables = (("countries", "countries_curated"), ("horoscopes", "calendar"), ("users", users), ("facts", "facts_curated"))
        steps = [(first, None), ("transform", None)] + [(f"write_{t}", view) for t, view in tables]
        for i, (step, view) in enumerate(steps):
            rows = f"(SELECT count(*) FROM {view})" if view else "CAST(NULL AS BIGINT)"
            entries.append(f"('{job}', {2 * i + 1}, '{step}', 'INFO', 'started', CAST(NULL AS BIGINT))")
            entries.append(f"('{job}', {2 * i + 2}, '{step}', 'INFO', 'finished', {rows})")
    return "SELECT * FROM (VALUES\n  " + ",\n  ".join(entries) + "\n) AS t(job, seq, step, level, message, rows)"


@register("run_log_rows", _run_log_sql())
def run_log_rows(spark, sf_dir):
    """K5: run-log rows of a curated and a refined run, with the rows each
    write step published (time and run id left out)."""
    log = spark.read.parquet(f"{publish_layers(spark, sf_dir)}/run_log")
    return log.select("job", "seq", "step", "level", "message", "rows")


__all__ = ["ORACLE_SQL", "PUBLISHING", "QUERIES", "as_ntz", "register"]
