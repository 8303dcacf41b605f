"""The driver's generated tables presented as the listening dataset.

The relational tables play the raw layer:

* ``customer`` (+ first ``orders`` date, ``nation``, ``region``) -> users
* ``nation`` + ``region`` -> countries (Spanish/English names, codes,
  continent), with the African nations listed twice under other codes
* a 366-day calendar of leap year 2000 -> horoscopes
* ``events`` -> listening facts

The tables hold no nulls, so missing values are derived by rules on
ordinary columns (a market segment, an event type, a value range). Every
rule is written twice below: as Spark expressions and as DuckDB SQL views
(``SQL_VIEWS``) for the oracle comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.defaults import ADDED_COUNTRIES

# Rules used with these tables (the dataset defaults live in plans.defaults).
DRIVER_PREFIX_RULES = (("NATION_1", "NATION_1"), ("NATION_2", "NATION_2"))
DRIVER_CONTINENT_MAP = {"AFRICA": "Africa", "AMERICA": "America", "EUROPE": "Europe"}

# Western zodiac signs with the (month, day) each one starts on.
ZODIAC_STARTS = (
    (1, 20, "Aquarius"),
    (2, 19, "Pisces"),
    (3, 21, "Aries"),
    (4, 20, "Taurus"),
    (5, 21, "Gemini"),
    (6, 21, "Cancer"),
    (7, 23, "Leo"),
    (8, 23, "Virgo"),
    (9, 23, "Libra"),
    (10, 23, "Scorpio"),
    (11, 22, "Sagittarius"),
    (12, 22, "Capricorn"),
)

ADDED_COUNTRY = ADDED_COUNTRIES[0][1]
FACT_TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
REGISTERED_TEXT = "MMM d, yyyy"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``#id``, ``c_name`` (pass-through), ``country``, ``registered``.

    ``registered`` is the customer's first order date as ``Mon d, yyyy``;
    null for the AUTOMOBILE segment (the invalid users). ``country`` is the
    nation name, null for the HOUSEHOLD segment, a country that only an added
    row of the curated countries knows for some FURNITURE customers, and a long
    form (``NATION_7 Federation``) for Asian nations.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    first = (
        table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    )
    nations = _nation_region(spark, sf_dir)
    joined = customer.join(first, customer.c_custkey == first.o_custkey, "left").join(
        nations, customer.c_nationkey == nations.n_nationkey, "left"
    )
    return joined.select(
        F.col("c_custkey").cast("string").alias("#id"),
        "c_name",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
        .when((F.col("c_mktsegment") == "FURNITURE") & (F.col("n_nationkey") == 5), F.lit(ADDED_COUNTRY))
        .when(F.col("r_name") == "ASIA", F.concat(F.col("n_name"), F.lit(" Federation")))
        .otherwise(F.col("n_name"))
        .alias("country"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("string"))
        .otherwise(F.date_format("first_order", REGISTERED_TEXT))
        .alias("registered"),
    )


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries as the raw file has them: five headers with a leading
    space; ``continente`` null for the Middle East; African nations listed
    twice with different codes."""
    nations = _nation_region(spark, sf_dir)

    def shape(df: DataFrame, iso2_prefix: str) -> DataFrame:
        return df.select(
            F.replace(F.col("n_name"), F.lit("NATION"), F.lit("NACION")).alias("nombre"),
            F.col("n_name").alias(" name"),
            F.lower("n_name").alias(" nom"),
            F.concat(F.lit(iso2_prefix), F.col("n_nationkey").cast("string")).alias(" iso2"),
            F.concat(F.lit("NAT"), F.col("n_nationkey").cast("string")).alias(" iso3"),
            (F.col("n_nationkey") + 100).cast("string").alias(" phone_code"),
            F.when(F.col("r_name") == "MIDDLE EAST", F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("continente"),
        )

    return shape(nations, "N").unionByName(shape(nations.where(F.col("r_name") == "AFRICA"), "X"))


def zodiac_sign(month: Column, day: Column) -> Column:
    """Sign of a (month, day), from ``ZODIAC_STARTS``."""
    key = month * 100 + day
    expr = None
    for m, d, sign in sorted(ZODIAC_STARTS, reverse=True):
        cond = key >= m * 100 + d
        expr = F.when(cond, F.lit(sign)) if expr is None else expr.when(cond, F.lit(sign))
    return expr.otherwise(F.lit("Capricorn"))


def raw_horoscopes(spark: SparkSession) -> DataFrame:
    """366-row calendar ``Date, Day, Month, Horocope`` (all text); days of
    January-June are zero-padded (``04``), later ones are not (``4``)."""
    days = spark.range(366).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    m, d = F.month("d"), F.dayofmonth("d")
    return days.select(
        F.date_format("d", "MM-dd").alias("Date"),
        F.when(m <= 6, F.lpad(d.cast("string"), 2, "0")).otherwise(d.cast("string")).alias("Day"),
        m.cast("string").alias("Month"),
        zodiac_sign(m, d).alias("Horocope"),
    )


def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts from events: the six positional columns plus ``event_id``.

    ``user_id`` null for errors; unparsable time text for low-value
    signups; a second group id for expensive purchases; a second song id for
    high-value views; no song name below value 1; song names opening an
    unclosed quote for high-value clicks.
    """
    ev = table(spark, sf_dir, "events")
    et, value = F.col("event_type"), F.col("value")
    song_key = F.replace(F.replace(F.col("props"), F.lit('{"k": '), F.lit("T")), F.lit("}"), F.lit(""))
    return ev.select(
        F.when(et == "error", F.lit(None).cast("string")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when((et == "signup") & (value < 5), F.lit("n/a")).otherwise(F.date_format("ts", FACT_TIME_TEXT)).alias("fact_date"),
        F.when((et == "purchase") & (value >= 100), F.lit("G-purchase-2")).otherwise(F.concat(F.lit("G-"), et)).alias("group_id"),
        et.alias("group_name"),
        F.when((et == "view") & (value >= 200), F.concat(song_key, F.lit("b"))).otherwise(song_key).alias("song_id"),
        F.when(value < 1, F.lit(None).cast("string"))
        .when((et == "click") & (value >= 300), F.concat(F.lit('"'), F.col("props")))
        .otherwise(F.col("props"))
        .alias("song_name"),
        "event_id",
    )


def _zodiac_sql(month: str, day: str) -> str:
    arms = " ".join(
        f"WHEN {month} * 100 + {day} >= {m * 100 + d} THEN '{sign}'" for m, d, sign in sorted(ZODIAC_STARTS, reverse=True)
    )
    return f"CASE {arms} ELSE 'Capricorn' END"


def _prefix_sql(column: str, rules) -> str:
    arms = " ".join(f"WHEN starts_with({column}, '{p}') THEN '{v}'" for p, v in rules)
    return f"CASE {arms} ELSE {column} END"


def _continent_sql(column: str, mapping) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {column} END"


# DuckDB mirrors of the views above, plus the curated tables built from them.
SQL_VIEWS = {
    "users_raw": """
  SELECT CAST(c.c_custkey AS VARCHAR) AS "#id", c.c_name,
         CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL
              WHEN c.c_mktsegment = 'FURNITURE' AND n.n_nationkey = 5 THEN 'Cote D''Ivoire'
              WHEN r.r_name = 'ASIA' THEN n.n_name || ' Federation'
              ELSE n.n_name END AS country,
         CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN NULL
              ELSE strftime(f.first_order, '%b %-d, %Y') END AS registered
  FROM customer c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
         ON f.o_custkey = c.c_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "countries_raw": """
  SELECT replace(n.n_name, 'NATION', 'NACION') AS nombre, n.n_name AS " name", lower(n.n_name) AS " nom",
         'N' || CAST(n.n_nationkey AS VARCHAR) AS " iso2", 'NAT' || CAST(n.n_nationkey AS VARCHAR) AS " iso3",
         CAST(n.n_nationkey + 100 AS VARCHAR) AS " phone_code",
         CASE WHEN r.r_name = 'MIDDLE EAST' THEN NULL ELSE r.r_name END AS continente
  FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
  UNION ALL
  SELECT replace(n.n_name, 'NATION', 'NACION'), n.n_name, lower(n.n_name),
         'X' || CAST(n.n_nationkey AS VARCHAR), 'NAT' || CAST(n.n_nationkey AS VARCHAR),
         CAST(n.n_nationkey + 100 AS VARCHAR),
         CASE WHEN r.r_name = 'MIDDLE EAST' THEN NULL ELSE r.r_name END
  FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE r.r_name = 'AFRICA'""",
    "calendar": f"""
  SELECT strftime(d, '%m-%d') AS "Date",
         CASE WHEN month(d) <= 6 THEN lpad(CAST(day(d) AS VARCHAR), 2, '0') ELSE CAST(day(d) AS VARCHAR) END AS "Day",
         CAST(month(d) AS VARCHAR) AS "Month",
         {_zodiac_sql('month(d)', 'day(d)')} AS "Horocope"
  FROM (SELECT CAST(DATE '2000-01-01' + CAST(range AS INTEGER) AS DATE) AS d FROM range(366))""",
    "facts_raw": """
  SELECT CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_type = 'signup' AND value < 5 THEN 'n/a'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS fact_date,
         CASE WHEN event_type = 'purchase' AND value >= 100 THEN 'G-purchase-2' ELSE 'G-' || event_type END AS group_id,
         event_type AS group_name,
         CASE WHEN event_type = 'view' AND value >= 200 THEN replace(replace(props, '{"k": ', 'T'), '}', '') || 'b'
              ELSE replace(replace(props, '{"k": ', 'T'), '}', '') END AS song_id,
         CASE WHEN value < 1 THEN NULL
              WHEN event_type = 'click' AND value >= 300 THEN '"' || props
              ELSE props END AS song_name,
         event_id
  FROM events""",
    "facts_parsed": """
  SELECT *, try_strptime(fact_date, '%Y-%m-%dT%H:%M:%SZ') AS fact_timestamp FROM facts_raw""",
    "facts_curated": """
  SELECT * FROM facts_parsed
  WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT "#id" FROM users_raw WHERE registered IS NULL)""",
    "users_curated": f"""
  SELECT "#id", c_name, country, registered,
         {_prefix_sql('country', DRIVER_PREFIX_RULES)} AS country_name,
         CAST(try_strptime(registered, '%b %-d, %Y') AS DATE) AS register_date
  FROM users_raw WHERE registered IS NOT NULL""",
    "countries_curated": f"""
  SELECT pais, country, coalesce(continente, 'Sin continente') AS continente,
         coalesce(continent, 'Without continent') AS continent
  FROM (SELECT DISTINCT * FROM (
          SELECT nombre AS pais, " name" AS country, continente,
                 {_continent_sql('continente', DRIVER_CONTINENT_MAP)} AS continent
          FROM countries_raw
          UNION ALL
          SELECT 'Cote D''Ivoire', 'Cote D''Ivoire', 'África', 'Africa'))""",
    "users_refined": """
  SELECT u."#id" AS user_id, u.c_name, u.country, u.registered, u.country_name, u.register_date,
         CAST(month(u.register_date) AS INTEGER) AS register_month,
         CAST(day(u.register_date) AS INTEGER) AS register_day,
         h."Horocope" AS horoscope, k.continent
  FROM users_curated u
  LEFT JOIN calendar h
         ON TRY_CAST(h."Day" AS INTEGER) = day(u.register_date)
        AND TRY_CAST(h."Month" AS INTEGER) = month(u.register_date)
  LEFT JOIN countries_curated k ON k.country = u.country_name""",
}


def with_views(body: str) -> str:
    """Prefix an oracle query with the view definitions (unused CTEs cost
    nothing in DuckDB)."""
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in SQL_VIEWS.items())
    return f"WITH {ctes}\n{body.strip()}"
