"""Raw -> curated layer jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.functions.columns import col, drop_columns, rename_columns, trim_headers
from strata.functions.dates import REGISTERED_DATE_PATTERN, month_of, parse_date, parse_timestamp, year_of
from strata.functions.mapping import fill_null, map_exact, map_prefix
from strata.operators.observed import Probes
from strata.operators.relational import FROM_SESSION, drop_duplicate_rows, exclude_keys, union_rows
from strata.plans import defaults as D
from strata.sources.readers import literal_rows
from strata.sources.schemas import COUNTRIES_REQUIRED, HOROSCOPES_REQUIRED, USERS_REQUIRED, require_columns


def clean_countries(
    raw: DataFrame,
    continent_map: Mapping[str, str] = D.CONTINENT_ES_TO_EN,
    added_rows: Sequence[Sequence[str]] = D.ADDED_COUNTRIES,
    no_continent: tuple[str, str] = (D.NO_CONTINENT_ES, D.NO_CONTINENT_EN),
    code_columns: Sequence[str] = D.COUNTRY_CODE_COLUMNS,
) -> DataFrame:
    """Curated countries ``(pais, country, continente, continent)``.

    Header clean-up, English continent, code columns dropped, fixed rows
    added, exact duplicates removed (rows that differed only in codes
    collapse), and missing continents replaced by stand-ins.
    """
    df = require_columns(trim_headers(raw), COUNTRIES_REQUIRED, "countries")
    df = df.withColumn("continent", map_exact("continente", continent_map))
    df = rename_columns(df, {"name": "country", "nombre": "pais"})
    df = drop_columns(df, code_columns)
    front = ["pais", "country", "continente", "continent"]
    df = df.select(*[col(c) for c in front], *[col(c) for c in df.columns if c not in front])
    if added_rows:
        df = union_rows(df, literal_rows(df.sparkSession, added_rows, front), allow_missing=True)
    df = drop_duplicate_rows(df)
    return df.withColumns(
        {
            "continente": fill_null("continente", no_continent[0]),
            "continent": fill_null("continent", no_continent[1]),
        }
    )


def load_horoscopes(raw: DataFrame) -> DataFrame:
    """Curated horoscope calendar: the raw table as it is."""
    return require_columns(trim_headers(raw), HOROSCOPES_REQUIRED, "horoscopes")


def clean_users(
    raw: DataFrame,
    prefix_rules: Sequence[tuple[str, str]] = D.COUNTRY_PREFIX_RULES,
    date_pattern: str = REGISTERED_DATE_PATTERN,
) -> DataFrame:
    """Curated users (C3): ``country_name`` for the country join, rows
    without a registration text removed, ``register_date`` parsed (null when
    the text does not parse)."""
    df = require_columns(raw, USERS_REQUIRED, "users")
    df = df.withColumn("country_name", map_prefix("country", prefix_rules))
    df = df.where(col("registered").isNotNull())
    return df.withColumn("register_date", parse_date("registered", date_pattern))


def invalid_users(raw_users: DataFrame, id_column: str = "#id") -> DataFrame:
    """Ids of users without a registration text, taken from the raw
    (unfiltered) users table."""
    return raw_users.where(col("registered").isNull()).select(col(id_column))


def clean_facts(
    raw_facts: DataFrame,
    raw_users: DataFrame,
    id_column: str = "#id",
    timestamp_pattern: str | None = None,
    broadcast_max_rows: int | str | None = FROM_SESSION,
    cluster_by_user: bool = False,
) -> DataFrame:
    """Curated facts (C4): ``fact_timestamp`` parsed from ``fact_date``;
    facts without a user or of an invalid user removed.

    ``cluster_by_user`` returns the facts clustered by user for the
    partitioned write, with a single shuffle of the facts whichever join
    the exclusion uses (publish them with ``rebalance=False``)."""
    facts = raw_facts.select("*", parse_timestamp("fact_date", timestamp_pattern).alias("fact_timestamp"))
    return exclude_keys(
        facts,
        invalid_users(raw_users, id_column),
        key="user_id",
        excluded_key=id_column,
        broadcast_max_rows=broadcast_max_rows,
        cluster_output=cluster_by_user,
    )


def facts_with_year_month(facts: DataFrame, timestamp_column: str = "fact_timestamp") -> DataFrame:
    """Facts with ``year`` and ``month`` of the fact time."""
    return facts.withColumns({"year": year_of(timestamp_column), "month": month_of(timestamp_column)})


def build_curated(
    raw_users: DataFrame,
    raw_countries: DataFrame,
    raw_horoscopes: DataFrame,
    raw_facts: DataFrame,
    prefix_rules: Sequence[tuple[str, str]] = D.COUNTRY_PREFIX_RULES,
    continent_map: Mapping[str, str] = D.CONTINENT_ES_TO_EN,
    added_countries: Sequence[Sequence[str]] = D.ADDED_COUNTRIES,
    cluster_facts: bool = False,
    probes: Probes | None = None,
) -> dict[str, DataFrame]:
    """The four curated tables as lazy DataFrames (facts clustered by user
    for publishing when ``cluster_facts``).

    With ``probes`` the reports' counts of the users and facts (missing
    values, texts that do not parse, rows before and after the exclusion) are
    taken as the tables are written: places ``users_raw``, ``users``,
    ``facts_raw`` and ``facts``.
    """
    tables = {
        "countries": clean_countries(raw_countries, continent_map, added_countries),
        "horoscopes": load_horoscopes(raw_horoscopes),
    }
    if probes is None:
        tables["users"] = clean_users(raw_users, prefix_rules)
        tables["facts"] = clean_facts(raw_facts, raw_users, cluster_by_user=cluster_facts)
        return tables
    no_country = {"missing_country_with_date": col("country").isNull() & col("registered").isNotNull()}
    users = clean_users(probes.watch(raw_users, "users_raw", ["country", "registered"], no_country), prefix_rules)
    tables["users"] = probes.watch(users, "users", ["country_name"], {"unparsed_dates": col("register_date").isNull()})
    facts = probes.watch(raw_facts, "facts_raw", [c for c in raw_facts.columns])
    facts = clean_facts(facts, raw_users, cluster_by_user=cluster_facts)
    bad_time = col("fact_date").isNotNull() & col("fact_timestamp").isNull()
    tables["facts"] = probes.watch(facts, "facts", ["group_id", "song_id"], {"unparsed_timestamps": bad_time})
    return tables


def run_curated(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    target_root: str,
    database: str | None = None,
    log_path: str | None = None,
    target_file_bytes: int | None = None,
    buckets: int | None = None,
    bucketed: int | None = None,
    switch: bool = False,
    names: Sequence[str] = D.TABLES,
    probes: Probes | None = None,
    **rules,
):
    """Raw files -> published curated layer (E1). Returns the run log.

    ``raw_paths`` names the users, countries, horoscopes and facts files;
    ``buckets``, ``bucketed`` and ``switch`` are those of ``publish_layer``,
    ``names`` the tables to publish, and ``probes`` counts as they are written.
    """
    from strata.plans.layers import publish_layer
    from strata.sinks.run_log import RunLog
    from strata.sources.readers import read_countries, read_facts, read_horoscopes, read_users

    log = RunLog("curated")
    try:
        with log.step("read_raw"):
            raw_users = read_users(spark, raw_paths["users"])
            raw_countries = read_countries(spark, raw_paths["countries"])
            raw_horoscopes = read_horoscopes(spark, raw_paths["horoscopes"])
            raw_facts = read_facts(spark, raw_paths["facts"])
        with log.step("transform"):
            tables = build_curated(raw_users, raw_countries, raw_horoscopes, raw_facts, cluster_facts=not (buckets or bucketed), probes=probes, **rules)
        # Facts arrive clustered by user: no second shuffle before the write.
        publish_layer(
            spark,
            {name: tables[name] for name in D.TABLES if name in names},
            target_root,
            database=database,
            log=log,
            log_path=log_path,
            buckets=buckets,
            bucketed=bucketed,
            switch=switch,
            rebalance={"facts": bool(bucketed)},
            target_file_bytes=target_file_bytes,
        )
    finally:
        if log_path:
            log.flush(spark, log_path)
    return log


__all__ = [
    "build_curated",
    "clean_countries",
    "clean_facts",
    "clean_users",
    "facts_with_year_month",
    "invalid_users",
    "load_horoscopes",
    "run_curated",
]
