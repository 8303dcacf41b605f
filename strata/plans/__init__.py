"""Composite jobs: curated and refined layers, layer I/O, profiling."""

from strata.plans.curated import (
    build_curated,
    clean_countries,
    clean_facts,
    clean_users,
    facts_with_year_month,
    invalid_users,
    load_horoscopes,
    run_curated,
)
from strata.plans.layers import publish_layer, read_layer, register_views
from strata.plans.profiling import profile_curated, profile_raw, profile_summary
from strata.plans.refined import (
    add_continent,
    add_horoscope,
    build_refined,
    enrich_users,
    refine_horoscopes,
    run_refined,
    users_without_sign,
    with_register_parts,
)

__all__ = [
    "add_continent",
    "add_horoscope",
    "build_curated",
    "build_refined",
    "clean_countries",
    "clean_facts",
    "clean_users",
    "enrich_users",
    "facts_with_year_month",
    "invalid_users",
    "load_horoscopes",
    "profile_curated",
    "profile_raw",
    "profile_summary",
    "publish_layer",
    "read_layer",
    "refine_horoscopes",
    "register_views",
    "run_curated",
    "run_refined",
    "users_without_sign",
    "with_register_parts",
]
