import datetime as dt

import pytest

from helpers import rows
from strata.operators import DuplicateKeyError, filter_impact
from strata.plans import (
    build_curated,
    build_refined,
    clean_countries,
    clean_facts,
    clean_users,
    enrich_users,
    invalid_users,
    facts_with_year_month,
    profile_curated,
    profile_raw,
    read_layer,
    refine_horoscopes,
    run_curated,
    run_refined,
    users_without_sign,
)
from strata.session import scratch_path


def test_clean_countries(raw):
    out = clean_countries(raw["countries"])
    assert out.columns == ["pais", "country", "continente", "continent"]
    got = rows(out)
    assert got == sorted(
        [
            ("España", "Spain", "Europa", "Europe"),
            ("Congo", "Congo", "África", "Africa"),
            ("Rusia", "Russia", "Europa", "Europe"),
            ("Estados Unidos", "United States of America", "América", "America"),
            ("Corea del Sur", "South Korea", "Asia", "Asia"),
            ("Francia", "France", "Europa", "Europe"),
            ("Isla Heard", "Heard Island", "Sin continente", "Without continent"),
            ("Australia", "Australia", "Australia y Oceanía", "Australia and Oceania"),
            ("Cote D'Ivoire", "Cote D'Ivoire", "África", "Africa"),
        ],
        key=lambda t: tuple((x is not None, str(x)) for x in t),
    )
    # invariants: one row per country, no null continent after the fill
    assert out.select("country").distinct().count() == out.count()
    assert out.where("continent IS NULL OR continente IS NULL").count() == 0


def test_clean_users(raw):
    out = clean_users(raw["users"])
    got = {r["#id"]: (r.country_name, r.register_date) for r in out.collect()}
    assert "u7" not in got  # no registration text
    assert got["u1"] == ("Spain", dt.date(2005, 2, 4))
    assert got["u2"] == ("Congo", dt.date(2006, 8, 13))
    assert got["u3"] == ("Russia", dt.date(2006, 8, 4))
    assert got["u4"] == ("United States of America", None)
    assert got["u5"] == ("South Korea", None)
    assert got["u6"] == (None, None)
    assert got["u8"][1] is None  # the month's case counts
    assert got["u9"][1] == got["u10"][1] == dt.date(2006, 8, 4)  # comma and further parts do not
    assert "gender" in out.columns  # pass-through column kept


def test_clean_facts_exclusion_and_quotes(raw):
    out = clean_facts(raw["facts"], raw["users"])
    got = rows(out, "user_id", "song_name", "fact_timestamp")
    users = [g[0] for g in got]
    assert sorted(users) == ["u1", "u1", "u2", "u3", "u4", "u99"]
    # an unclosed opening quote does not swallow the following columns
    rez = out.where(out.song_name == '"Rez').first()
    assert (rez.user_id, rez.group_name, rez.song_id) == ("u1", "Underworld", "s2")
    assert rez.fact_timestamp is not None
    u2 = out.where("user_id = 'u2'").first()
    assert u2.fact_timestamp is None
    u4 = out.where("user_id = 'u4'").first()
    assert (u4.group_id, u4.group_name, u4.song_name) == (None, None, None)
    # removed + kept = before
    assert out.count() == 6
    impact = filter_impact(raw["facts"], invalid_users(raw["users"]), "user_id", "#id").first()
    assert (impact.rows_before, impact.rows_after, impact.rows_removed) == (8, 6, 2)


def test_facts_with_year_month(raw):
    out = facts_with_year_month(clean_facts(raw["facts"], raw["users"]))
    r = out.where("user_id = 'u3'").first()
    assert (r.year, r.month) == (2009, 5)


def test_enrich_users(raw):
    users = clean_users(raw["users"])
    out = enrich_users(users, raw["horoscopes"], clean_countries(raw["countries"]))
    assert out.count() == users.count()  # lookups never multiply rows
    got = {r.user_id: (r.register_month, r.register_day, r.horoscope, r.continent) for r in out.collect()}
    assert got["u1"] == (2, 4, "Aquarius", "Europe")  # day "04" in the calendar matches 4
    assert got["u3"] == (8, 4, "Leo", "Europe")  # day "4" matches too
    assert got["u2"] == (8, 13, "Leo", "Africa")
    assert got["u11"] == (1, 1, None, "Europe")  # no calendar row
    assert got["u6"] == (None, None, None, None)
    assert got["u10"][3] is None  # unknown country
    for c in ("user_id", "register_month", "register_day", "horoscope", "continent"):
        assert c in out.columns
    for c in ("#id", "Date", "Day", "Month", "pais", "continente", "Horocope"):
        assert c not in out.columns


def test_enrich_users_rejects_duplicate_calendar_rows(spark, raw):
    dup = raw["horoscopes"].unionByName(raw["horoscopes"].limit(1))
    with pytest.raises(DuplicateKeyError):
        enrich_users(clean_users(raw["users"]), dup, clean_countries(raw["countries"]))


def test_users_without_sign(raw):
    out = users_without_sign(clean_users(raw["users"]), raw["horoscopes"])
    ids = {r.user_id for r in out.collect()}
    assert "u11" in ids and "u1" not in ids
    assert {"u4", "u5", "u6"} <= ids  # no date, never matches


def test_refine_horoscopes(raw):
    assert "horoscope" in refine_horoscopes(raw["horoscopes"]).columns


def test_profiles_run(raw):
    cur = build_curated(raw["users"], raw["countries"], raw["horoscopes"], raw["facts"])
    before = profile_raw(raw["users"], raw["countries"], raw["facts"], horoscopes=raw["horoscopes"])
    assert rows(before["horoscopes_preview"]) == rows(raw["horoscopes"].limit(20))
    checks = {**before, **profile_curated(**cur)}
    assert checks["horoscopes_preview"].columns == cur["horoscopes"].columns
    counts = {k: v.count() for k, v in checks.items()}
    assert counts["unmatched_countries_before"] > counts["unmatched_countries_after"]
    assert rows(checks["unmatched_countries_after"]) == [(None,), ("Narnia",)]
    assert counts["duplicate_countries_before"] == 1 and counts["duplicate_countries_after"] == 0
    assert counts["users_without_registration"] == 1
    assert rows(checks["users_without_country"], "#id") == [("u12",), ("u6",)]
    assert counts["unparsed_timestamps"] == 1
    assert rows(checks["group_name_ids"]) == [("Underworld", 2)]
    assert rows(checks["filter_impact"]) == [(8, 6, 2)]
    assert counts["users_without_sign"] >= 1


def test_profile_raw_staged_matches_unstaged(spark, raw):
    from strata.plans import profile_summary

    plain = profile_summary(profile_raw(raw["users"], raw["countries"], raw["facts"]))
    staged_checks = profile_raw(raw["users"], raw["countries"], raw["facts"], stage_path=scratch_path(spark, "t-stage"))
    assert rows(profile_summary(staged_checks)) == rows(plain)
    # the fact checks read the staged Parquet copy, not the raw text
    plan = staged_checks["facts_profile"]._jdf.queryExecution().executedPlan().toString()
    assert "Parquet" in plan and "csv" not in plan.lower()


def test_layers_round_trip_and_rerun(spark, raw_paths):
    root = scratch_path(spark, "test-layers")
    log_c = run_curated(spark, raw_paths, f"{root}/curated", log_path=f"{root}/log")
    log_r = run_refined(spark, f"{root}/curated", f"{root}/refined", log_path=f"{root}/log")
    cur = read_layer(spark, f"{root}/curated")
    ref = read_layer(spark, f"{root}/refined")
    assert dict(cur["facts"].dtypes)["user_id"] == "string"
    assert cur["facts"].count() == 6
    assert ref["users"].count() == cur["users"].count() == 11
    assert "horoscope" in ref["horoscopes"].columns
    expected = build_refined(cur)["users"]
    assert rows(ref["users"].select(*expected.columns)) == rows(expected)
    # rerun: same tables, no duplication (a DataFrame keeps its file listing,
    # so the earlier result is materialised before the overwrite)
    facts_before = rows(cur["facts"])
    facts_columns = cur["facts"].columns
    run_curated(spark, raw_paths, f"{root}/curated")
    again = read_layer(spark, f"{root}/curated")
    assert rows(again["facts"].select(*facts_columns)) == facts_before
    # run log: one start and one finish per step, nothing failed
    log = spark.read.parquet(f"{root}/log")
    assert log.where("level = 'ERROR'").count() == 0
    steps = {r.step for r in log.collect()}
    assert {"read_raw", "transform", "write_facts", "read_curated", "write_users"} <= steps
    assert len(log_c.entries) + len(log_r.entries) == log.count()
    written = {(r.job, r.step): r.rows for r in log.where("message = 'finished'").collect()}
    assert written[("curated", "write_facts")] == 6
    assert written[("refined", "write_users")] == 11
    assert written[("curated", "read_raw")] is None


def test_catalog_publish(spark, raw):
    cur = build_curated(raw["users"], raw["countries"], raw["horoscopes"], raw["facts"])
    from strata.plans import publish_layer

    root = scratch_path(spark, "test-catalog")
    publish_layer(spark, cur, root, database="strata_test_curated")
    back = read_layer(spark, root, database="strata_test_curated")
    assert back["users"].count() == 11
    assert back["facts"].count() == 6


def test_run_log_records_errors(spark):
    from strata.sinks import RunLog

    log = RunLog("t")
    with pytest.raises(ZeroDivisionError):
        with log.step("boom"):
            1 / 0
    assert [e[4] for e in log.entries] == ["INFO", "ERROR"]
    assert log.to_dataframe(spark).count() == 2


def test_register_views_for_sql(spark, raw):
    from strata.plans import register_views

    cur = build_curated(raw["users"], raw["countries"], raw["horoscopes"], raw["facts"])
    assert register_views(cur, "cur_") == ["cur_countries", "cur_horoscopes", "cur_users", "cur_facts"]
    got = spark.sql("SELECT count(*) AS n FROM cur_facts WHERE user_id = 'u1'").first().n
    assert got == 2


def test_failed_run_is_logged(spark, raw_paths):
    root = scratch_path(spark, "t-fail")
    bad_paths = dict(raw_paths, countries=f"{root}/no-such-file.csv")
    with pytest.raises(Exception):
        run_curated(spark, bad_paths, f"{root}/curated", log_path=f"{root}/log")
    log = spark.read.parquet(f"{root}/log")
    errors = log.where("level = 'ERROR'").collect()
    assert [e.step for e in errors] == ["read_raw"]
    assert "no-such-file" in errors[0].message


def test_added_country_present_once_when_source_has_it(spark, raw):
    from pyspark.sql import functions as F

    extra = raw["countries"].limit(1).select(
        F.lit("Cote D'Ivoire").alias("nombre"),
        F.lit("Cote D'Ivoire").alias("name"),
        F.lit("Cote d'Ivoire").alias("nom"),
        F.lit("CI").alias("iso2"),
        F.lit("CIV").alias("iso3"),
        F.lit("225").alias("phone_code"),
        F.lit("África").alias("continente"),
    )
    out = clean_countries(raw["countries"].unionByName(extra))
    assert out.where("country = 'Cote D''Ivoire'").count() == 1
    assert out.count() == 9


def test_refined_run_keeps_no_list_of_files(spark, raw_paths):
    """What the run opened is free when it ends, not when Python's collector happens to run."""
    import gc

    from py4j.java_gateway import JavaObject

    def held():
        return sum(type(o) is JavaObject for o in gc.get_objects())

    root = scratch_path(spark, "t-released")
    run_curated(spark, raw_paths, f"{root}/curated")
    gc.collect()
    gc.disable()
    try:
        before = held()
        run_refined(spark, f"{root}/curated", f"{root}/refined")
        assert held() <= before
    finally:
        gc.enable()
