"""Readers and writers on small files, and operators that no registered query reaches."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from brindle.functions import text, urls
from brindle.operators import merges, priors, ranking
from brindle.plans.fixtures import view
from brindle.sources import readers, writers
from tests.conftest import DATA


def test_uploads_and_text_tables(spark, tmp_path):
    (tmp_path / "leads.csv").write_text("email, Email ,name\n a@b.c , x@y.z, Ann \n\nd@e.f,,Bob\n")
    before = spark.conf.get("spark.sql.caseSensitive")
    try:
        leads = readers.read_leads_csv(spark, str(tmp_path / "leads.csv"))
        assert leads.columns == ["email", "Email", "name"] and [tuple(r) for r in leads.collect()] == [("a@b.c", "x@y.z", "Ann"), ("d@e.f", None, "Bob")]
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2\n3,y,z\n")
    table = readers.read_text_table(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in table.dtypes] == ["string", "string"] and [tuple(r) for r in table.collect()] == [("1", "x"), ("2", None), ("3", "y")]
    assert readers.first_columns(table, 1).columns == ["a"] and readers.first_columns(table, 9).columns == ["a", "b"]


def test_tables_by_their_readers(spark):
    history = readers.read_history(spark, f"{DATA}/lineitem.parquet")
    assert history.count() == spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    assert readers.read_pages(spark, f"{DATA}/pages.parquet").columns == ["page_id", "url", "html"]
    assert "embedding" in readers.read_candidates(spark, f"{DATA}/embeddings.parquet").columns
    one = readers.lookup(spark.read.parquet(f"{DATA}/customer.parquet"), "c_custkey", 7)
    assert [r["c_custkey"] for r in one.collect()] == [7] and "EqualTo(c_custkey,7)" in one._jdf.queryExecution().executedPlan().toString()
    assert readers.lookup(spark.range(3), "id", 9).collect() == []


def test_seeds_lines_and_folders(spark, tmp_path):
    (tmp_path / "seeds.json").write_text(json.dumps({"3": {"folder": "f", "game": "g", "ids": ["x", "y"]}, "4": {"folder": "h", "game": "i", "ids": []}}))
    assert [tuple(r) for r in readers.explode_seeds(spark, str(tmp_path / "seeds.json")).orderBy("place").collect()] == [(3, "f", "g", 0, "x"), (3, "f", "g", 1, "y")]
    (tmp_path / "lines.jsonl").write_text('{"a": 1, "b": "x"}\nnoise\n\n{"a": 2}\n{"a": \n')
    lines = readers.read_jsonl_lenient(spark, str(tmp_path / "lines.jsonl"), "a int, b string").orderBy("file_pos")
    assert [(r["a"], r["b"]) for r in lines.collect()] == [(1, "x"), (2, None)]
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "one.csv").write_text("k,v\n1,UNKNOWN\n2, b \n3,c\n4,d\n")
    (folder / "two.csv").write_text("k,v\n5,\n")
    rows = readers.read_dir_with_source(spark, str(folder))
    assert {(r["k"], r["file"], r["bytes"]) for r in rows.collect()} == {(str(k), "one.csv", 28) for k in range(1, 5)} | {("5", "two.csv", 7)}
    # The profile of a folder: each file's columns with samples of its first rows, and the summary of all.
    summary = priors.profile_summary(rows, "file").first()
    assert (summary["files"], summary["n_rows"]) == (2, 5)
    ordered = readers.with_file_pos(rows.filter("file = 'one.csv'"))
    profile = {r["column"]: r for r in priors.profile_table(ordered.select("k", "v", "file_pos"), max_cols=2, order=F.col("file_pos"), sample_cols=2).collect()}
    assert (profile["v"]["n_rows"], profile["v"]["n_nullish"], profile["v"]["n_distinct"]) == (4, 1, 4)
    assert sorted(profile["v"]["samples"]) == ["UNKNOWN", "b", "c"] and sorted(profile["k"]["samples"]) == ["1", "2", "3"]
    out = str(tmp_path / "profile")
    writers.write_profile(priors.profile_table(ordered.select("k", "v")), out)
    writers.write_profile(priors.profile_table(ordered.select("k", "v")), out)  # replaces what was there
    assert {r["column"]: r["n_rows"] for r in spark.read.json(out).collect()} == {"k": 4, "v": 4}


def test_appended_logs_are_read_by_day(spark, tmp_path):
    path = str(tmp_path / "logs")
    logs = view(spark, DATA, "fx_email_logs").withColumn("variant", F.when(F.col("log_id") % 2 == 0, F.col("variant")))
    days = [r["d"] for r in logs.select(F.to_date("sent_at").alias("d")).distinct().orderBy("d").collect()]
    for d in days[:2]:
        writers.append_logs(logs.filter(F.to_date("sent_at") == F.lit(d)), path)
    back = spark.read.parquet(path)
    expected = writers.log_defaults(logs.filter(F.to_date("sent_at") <= F.lit(days[1])))
    columns = logs.columns
    assert sorted(map(tuple, back.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect())) and back.count() > 10
    one = back.filter(F.col("sent_date") == F.lit(days[0]))
    assert "PartitionFilters: [isnotnull(sent_date" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == logs.filter(F.to_date("sent_at") == F.lit(days[0])).count() and back.filter("variant is null").count() == 0


def test_manifest_and_summary(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", 0.5), (1, "a, c", None)], "number int, title string, score double")
    writers.write_manifest(rows, str(tmp_path / "m"))
    assert {tuple(r) for r in spark.read.schema(rows.schema).json(str(tmp_path / "m/json")).collect()} == {(2, "b", 0.5), (1, "a, c", None)}
    table = spark.read.csv(str(tmp_path / "m/csv"), header=True, inferSchema=True)
    assert table.columns == ["number", "title", "score"] and {tuple(r) for r in table.collect()} == {(2, "b", 0.5), (1, "a, c", None)}
    writers.write_summary(spark.createDataFrame([(3, 1)], "groups int, complete int"), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first().asDict() == {"groups": 3, "complete": 1}


def test_priors_document_in_parts(spark, tmp_path):
    cells = spark.createDataFrame([("DE", "45", 30, 4, 2), ("F\"R", "09", 25, 3, -1)], "country string, division string, sample_size long, unique_buyers long, priority_bonus int")
    buyers = spark.createDataFrame([("DE", f"buyer {k}\n", 9 + k, 2, 0) for k in range(50)], "country string, buyer_key string, sample_size long, cpv_diversity long, priority_bonus int")
    path = str(tmp_path / "priors")
    writers.write_priors_document(cells, buyers, {"cpv": "main_cpv"}, path)
    back = writers.read_priors_document(spark, path).collect()
    assert {(r["section"], r["key"]): json.loads(r["cell"]) for r in back} == {(r["section"], r["key"]): json.loads(r["cell"]) for r in writers.prior_cells(cells, buyers).collect()} and len(back) == 52
    lines = [json.loads(line) for f in sorted((tmp_path / "priors/cells").glob("part-*")) for line in f.read_text().splitlines()]
    assert [(x["section"], x["key"]) for x in lines] == sorted((x["section"], x["key"]) for x in lines) and lines[-1]["cell"]["sample_size"] == 25
    head = json.loads(spark.read.text(f"{path}/head").first()[0])
    assert head == {"columns": {"cpv": "main_cpv"}, "cells": {"country_cpv": 2, "buyers": 50}}
    plans = writers.prior_cells(cells, buyers)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plans
    whole = json.loads(writers.priors_document(cells, buyers, {"cpv": "main_cpv"}).first()[0])
    assert whole["buyers"]["de|buyer 3\n"]["sample_size"] == 12 and set(whole["country_cpv"]) == {"DE|45", "F\"R|09"}
    with pytest.raises(ValueError, match="write_priors_document"):
        writers.priors_document(cells, buyers, {}, most=10)


def test_values_without_their_columns(spark):
    rows = spark.createDataFrame([("DE", "45", "5")], "country string, division string, value string")
    assert priors.value_stats(rows).collect() == [] and priors.value_stats(rows).columns == ["country", "division", "currency", "n", "median", "p75"]
    many = spark.range(30).select(F.lit("DE").alias("country"), F.lit("45").alias("division"), F.lit(" eur ").alias("currency"), (F.col("id") + 2).cast("string").alias("value"))
    assert tuple(priors.value_stats(many).first()) == ("DE", "45", "EUR", 30, 16.5, 23.75)
    assert abs(priors.value_stats(many, accuracy=100).first()["median"] - 16.5) <= 1
    with pytest.raises(priors.MissingRolesError):
        priors.resolve_roles(rows)


def test_orders_and_sets(spark):
    rows = spark.createDataFrame([("b", "x", 1), ("A", "y", 2), ("c", "x", 3), (None, "z", 4)], "title string, category string, k int")
    assert [r["k"] for r in ranking.ordered(rows, F.desc("category"), F.asc("k")).collect()] == [4, 2, 1, 3]
    assert [r["k"] for r in ranking.category_order(rows, ["y"], "category", "title", "k").collect()] == [2, 4, 1, 3]
    assets = spark.createDataFrame([(["a", "b", "a", None, "b"],)], "u array<string>")
    assert assets.select(urls.ordered_distinct(F.col("u"))).first()[0] == ["a", "b", None]
    assert spark.range(1).select(text.drop_keys(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), ["a"])).first()[0] == {"b": "2"}


def test_suffixes_of_urls(spark):
    cases = {"https://a/x.PNG?w=1": ".png", "https://a/x.jpeg": ".jpeg", "https://a/x.webp": ".webp", "https://a/x.gif": ".jpg", "https://a/x": ".jpg", "https://a/x.jpg/": ".jpg"}
    rows = spark.createDataFrame([(k,) for k in cases], "u string").select("u", urls.url_suffix(F.col("u")).alias("s")).collect()
    assert {r["u"]: r["s"] for r in rows} == cases


def test_references_and_folds(spark):
    given = ["&lt;b&gt; &amp;amp; &eacute;&#233;&#xe9;&hellip;", "&nosuch;", None, "&euro"]
    rows = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    got = {r["i"]: (r["a"], r["f"]) for r in rows.select("i", text.unescape_all("t").alias("a"), text.ascii_fold("t").alias("f")).collect()}
    assert [got[i][0] for i in range(4)] == ["<b> &amp; ééé…", "&nosuch;", None, "&euro"] and got[2][1] is None


def test_children_with_defaults(spark):
    child = spark.createDataFrame([(1, 1, "old", 1), (2, 1, "stays", 1), (3, 1, "goes", 1)], "parent int, place int, name string, weight int")
    parents = spark.createDataFrame([(1, [("new", None), (None, 3), (" ", 3), ("last", 5)]), (3, [("", 1)])], "parent int, items array<struct<name:string,weight:int>>")
    got = merges.replace_children(child, parents, "parent", "items", "place", filled="name", defaults={"weight": 7})
    assert sorted(map(tuple, got.collect())) == [(1, 1, "new", 7), (1, 2, "last", 5), (2, 1, "stays", 1)]


def test_paths_that_are_not_there(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_history(spark, str(tmp_path / "nothing")).count()
