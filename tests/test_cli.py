"""Command-line jobs with the original option names."""

import json
import os

import pytest

from geonest.cli import main
from tests.test_io import DOC, write_doc_file


def test_convert_then_elt(spark, tmp_dir, capsys):
    raw, pre, tables = f"{tmp_dir}/raw", f"{tmp_dir}/pre", f"{tmp_dir}/tables"
    write_doc_file(raw, [DOC, {**DOC, "id": 2, "iso3": "GHA", "states": []}])
    assert main(["convert", "--input_path", raw, "--output_path", pre], spark=spark) == 0
    assert spark.read.parquet(pre).count() == 2
    rc = main(
        ["elt", "--dataset", "states_cities", "--preprocess_data_path", pre,
         "--location", tables, "--database", "geonest_cli"],
        spark=spark,
    )
    assert rc == 0
    out = capsys.readouterr().out
    assert "row_count" in out and "duplicate_keys" in out
    assert spark.table("geonest_cli.states").count() == 2  # outer: GHA kept with no state
    assert spark.table("geonest_cli.cities").count() == 2
    assert not spark.sparkContext._jsc.sc().isStopped()  # a passed-in session is left running


def test_errors_propagate(spark, tmp_dir):
    with pytest.raises(Exception):
        main(["convert", "--input_path", f"{tmp_dir}/missing", "--output_path", f"{tmp_dir}/out"], spark=spark)
    with pytest.raises(SystemExit):
        main(["elt", "--dataset", "planets", "--preprocess_data_path", tmp_dir], spark=spark)


def test_news_load_and_stream_once(spark, tmp_dir):
    d = os.path.join(tmp_dir.replace("file:", ""), "files", "NG", "tech")
    os.makedirs(d)
    with open(os.path.join(d, "r.json"), "w") as f:
        json.dump({"status": "ok", "articles": [{"id": 1, "text": "x", "n_chars": 1}]}, f)
    landing = f"{tmp_dir}/files"
    assert main(["news-load", "--landing", landing, "--table", f"{tmp_dir}/t1", "--landing_kind", "files"], spark=spark) == 0
    assert spark.read.parquet(f"{tmp_dir}/t1").count() == 1
    args = ["news-stream", "--landing", landing, "--table", f"{tmp_dir}/t2", "--checkpoint", f"{tmp_dir}/ck",
            "--landing_kind", "files", "--once"]
    assert main(args, spark=spark) == 0 and main(args, spark=spark) == 0
    assert spark.read.parquet(f"{tmp_dir}/t2").count() == 1


def test_pipeline_command(spark, tmp_dir, capsys):
    raw_loc, raw_pop = f"{tmp_dir}/raw_loc", f"{tmp_dir}/raw_pop"
    write_doc_file(raw_loc, [DOC, {**DOC, "id": 2, "iso3": "GHA", "states": []}])
    os.makedirs(raw_pop.replace("file:", ""), exist_ok=True)
    with open(os.path.join(raw_pop.replace("file:", ""), "pop.json"), "w") as f:
        json.dump([{"Alpha_2": "NG", "Alpha_3": "NGA", "Population": 5}], f)
    args = ["pipeline", "--raw_locations", raw_loc, "--raw_population", raw_pop,
            "--work_dir", f"{tmp_dir}/work", "--database", "geonest_cli_pipe"]
    assert main(args, spark=spark) == 0
    got = {(r.country_code, r.population) for r in spark.table("geonest_cli_pipe.countries").collect()}
    assert got == {("NGA", 5), ("GHA", None)}
    assert spark.table("geonest_cli_pipe.cities").count() == 2


def test_convert_keeps_undeclared_fields(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    state = {**DOC["states"][0], "motto": "m"}
    write_doc_file(raw, [{**DOC, "wiki": {"id": 5}, "states": [state]}, {**DOC, "id": 2}])
    for flags, kept in ((["--output_path", f"{tmp_dir}/all"], True), (["--output_path", f"{tmp_dir}/few", "--declared_only"], False)):
        assert main(["convert", "--input_path", raw, *flags], spark=spark) == 0
        df = spark.read.parquet(flags[1])
        assert ("wiki" in df.columns) == kept and ("motto" in df.schema["states"].dataType.elementType.names) == kept
        assert dict(df.dtypes)["latitude"] == "string" and df.count() == 2
    row = spark.read.parquet(f"{tmp_dir}/all").where("id = 1").first()
    assert row.wiki.id == 5 and row.states[0].motto == "m"


def test_convert_lines_and_elt_options(spark, tmp_dir):
    raw, pre = f"{tmp_dir}/lines", f"{tmp_dir}/pre"
    spark.createDataFrame([(json.dumps(DOC),), (json.dumps({**DOC, "id": 2}),)], "value string").write.text(raw)
    assert main(["convert", "--input_path", raw, "--output_path", pre, "--lines"], spark=spark) == 0
    args = ["elt", "--dataset", "cities", "--preprocess_data_path", pre, "--location", f"{tmp_dir}/t", "--database", "geonest_cli_opt",
            "--partition_by", "cities=country_code,city_name", "--replace", "swap"]
    assert main(args, spark=spark) == 0
    assert spark.table("geonest_cli_opt.cities").count() == 2
    physical = [t.name for t in spark.catalog.listTables("geonest_cli_opt") if t.name.startswith("cities__")]
    assert spark.sql(f"SHOW PARTITIONS geonest_cli_opt.{physical[0]}").first()[0] == "country_code=NGA/city_name=Ikeja"
