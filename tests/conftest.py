from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import COUNTRIES_CSV, FACTS_TSV, HOROSCOPES_CSV, USERS_TSV  # noqa: E402

from strata.session import build_session  # noqa: E402


def _write(path, rows, sep):
    with open(path, "w", encoding="utf-8") as fh:
        for r in rows:
            fh.write(sep.join(r) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = tmp_path_factory.mktemp("ckpt")
    s = build_session(
        "local[4]",
        app_name="strata-tests",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(ckpt))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_paths(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    return {
        "users": _write(d / "users.tsv", USERS_TSV, "\t"),
        "countries": _write(d / "countries.csv", COUNTRIES_CSV, ","),
        "horoscopes": _write(d / "horoscopes.csv", HOROSCOPES_CSV, ","),
        "facts": _write(d / "facts.tsv", FACTS_TSV, "\t"),
    }


@pytest.fixture(scope="session")
def raw(spark, raw_paths):
    from strata.sources import read_countries, read_facts, read_horoscopes, read_users

    return {
        "users": read_users(spark, raw_paths["users"]),
        "countries": read_countries(spark, raw_paths["countries"]),
        "horoscopes": read_horoscopes(spark, raw_paths["horoscopes"]),
        "facts": read_facts(spark, raw_paths["facts"]),
    }
