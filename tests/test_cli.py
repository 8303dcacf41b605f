from helpers import rows
from strata.__main__ import main
from strata.session import scratch_path


def test_cli_runs_both_layers_and_profiles(spark, raw_paths):
    root = scratch_path(spark, "t-cli")
    assert main(["curated", "--target", f"{root}/curated"] + [f"--{k}={v}" for k, v in raw_paths.items()]) == 0
    assert main(["refined", "--curated", f"{root}/curated", "--target", f"{root}/refined"]) == 0
    users = spark.read.parquet(f"{root}/refined/users")
    assert users.count() == 11 and "horoscope" in users.columns
    log = spark.read.parquet(f"{root}/refined/_run_log")
    assert log.where("level = 'ERROR'").count() == 0
    assert main(["profile-curated", "--curated", f"{root}/curated", "--out", f"{root}/checks"]) == 0
    assert rows(spark.read.parquet(f"{root}/checks/group_name_ids")) == [("Underworld", 2)]
    args = ["profile-raw", "--out", f"{root}/raw-checks"] + [f"--{k}={raw_paths[k]}" for k in ("users", "countries", "facts", "horoscopes")]
    assert main(args) == 0
    assert rows(spark.read.parquet(f"{root}/raw-checks/filter_impact")) == [(8, 6, 2)]


def test_cli_stream_facts(spark, raw_paths, tmp_path):
    import shutil

    incoming = tmp_path / "incoming"
    incoming.mkdir()
    shutil.copy(raw_paths["facts"], incoming / "part1.tsv")
    root = scratch_path(spark, "t-cli-stream")
    args = ["stream-facts", "--facts-dir", str(incoming), "--users", raw_paths["users"], "--target", f"{root}/facts"]
    assert main(args + ["--checkpoint", f"{root}/ckpt"]) == 0
    from strata.sources.readers import read_partitioned_strings

    assert read_partitioned_strings(spark, f"{root}/facts").count() == 6


def test_cli_rules_file(spark, raw_paths, tmp_path):
    import json

    rules = tmp_path / "rules.json"
    rules.write_text(json.dumps({"prefix_rules": [["Spa", "Spain"]], "continent_map": {"Europa": "EU"}, "added_countries": []}))
    root = scratch_path(spark, "t-cli-rules")
    args = ["curated", "--target", f"{root}/curated", "--rules", str(rules)] + [f"--{k}={v}" for k, v in raw_paths.items()]
    assert main(args) == 0
    users = spark.read.parquet(f"{root}/curated/users")
    assert users.where("`#id` = 'u2'").first().country_name == "Congo, the Democratic Republic of the"  # default rule replaced
    countries = spark.read.parquet(f"{root}/curated/countries")
    assert countries.where("country = 'Spain'").first().continent == "EU"
    assert countries.where("country = 'Cote D''Ivoire'").count() == 0
