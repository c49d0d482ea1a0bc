"""Tiny files written by the tests into fresh folders (S-1..S-5, S-8, K-1..K-7)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vigil.sinks.tables import export, jdbc_write_options, read_exported_csv, write_daily, write_fact
from vigil.sources.files import (read_cases, read_long_outbreak, read_vaccinations, read_wide_outbreak,
                                 read_wordlist)
from vigil.sources.sql import jdbc_options, read_sql


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_read_cases_first_column_is_key(spark, tmp_dir):
    p = f"{tmp_dir}/cases/owid.csv"
    _write(p, "iso_code,continent,location,date,total_cases,new_cases,new_deaths\n"
              "AFG,Asia,Afghanistan,2021-01-02,10,5,-1\nOWID_WRL,,World,2021-01-02,99,x,3\n")
    rows = {r.id: r for r in read_cases(spark, f"{tmp_dir}/cases").collect()}
    assert rows["AFG"].date == dt.date(2021, 1, 2) and rows["AFG"].new_deaths == -1.0
    assert rows["OWID_WRL"].continent is None and rows["OWID_WRL"].new_cases is None


def test_read_vaccinations(spark, tmp_dir):
    _write(f"{tmp_dir}/v/v.csv", "location,iso_code,date,people_fully_vaccinated\nPeru,PER,2021-03-01,\n")
    r = read_vaccinations(spark, f"{tmp_dir}/v").first()
    assert (r.iso_code, r.people_fully_vaccinated) == ("PER", None)


def test_read_long_with_separator(spark, tmp_dir):
    _write(f"{tmp_dir}/l/e.csv", "Indicator;Country;Date;value\nX;Guinea 2;2014-08-29;3\n")
    r = read_long_outbreak(spark, f"{tmp_dir}/l", sep=";").first()
    assert (r.country, r.value) == ("Guinea 2", 3.0)


def test_read_latin1(spark, tmp_dir):
    _write(f"{tmp_dir}/h/h.csv", "Country,Cases,Deaths,Update Time\nCôte d'Ivoire,3,0,2009-07-06\n",
           encoding="iso-8859-1")
    r = read_wide_outbreak(spark, f"{tmp_dir}/h", ["country", "tt_cases", "tt_deaths", "date"],
                           encoding="ISO-8859-1").first()
    assert r.country == "Côte d'Ivoire" and r.date == dt.date(2009, 7, 6)


def test_read_wordlist(spark, tmp_dir):
    _write(f"{tmp_dir}/w/w.txt", "The\n  and \n\nthe\n")
    assert sorted(r.token for r in read_wordlist(spark, f"{tmp_dir}/w").collect()) == ["and", "the"]


def test_daily_write_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2021, 5, 9), "a b", 2), (dt.date(2021, 5, 10), "c d", 1)],
                               "date date, words string, total int")
    path = f"{tmp_dir}/mart"
    write_daily(df, path)
    write_daily(df.where("date = DATE'2021-05-10'"), path)
    write_daily(df.where("date = DATE'2021-05-10'"), path)
    assert spark.read.parquet(path).count() == 2


def _table(tmp_dir):
    return "t_" + os.path.basename(tmp_dir).replace("-", "_")


DAYS = [(dt.date(2021, 5, 9), "a b", 2), (dt.date(2021, 5, 10), "c d", 1), (dt.date(2021, 5, 10), "e", 5), (dt.date(2021, 5, 11), "f", 7)]


@pytest.mark.parametrize("as_table", [True, False])
def test_daily_load_keeps_other_days_and_empties_its_own(spark, tmp_dir, as_table):
    df = spark.createDataFrame(DAYS, "date date, words string, total int")
    path = f"{tmp_dir}/mart"
    to = {"table": _table(tmp_dir)} if as_table else {"path": path}
    write_daily(df, **({"path": path} | to))
    write_daily(df.where("date = DATE'2021-05-10'").withColumn("total", F.lit(9)), **to)
    rows = lambda: sorted((str(r.date), r.words, r.total) for r in spark.read.parquet(path).collect())
    want = [("2021-05-09", "a b", 2), ("2021-05-10", "c d", 9), ("2021-05-10", "e", 9), ("2021-05-11", "f", 7)]
    assert rows() == want
    write_daily(df.where("date = DATE'2021-05-09'"), days=["2021-05-09", dt.date(2021, 5, 10)], **to)
    assert rows() == [want[0], want[3]]
    write_daily(df.limit(0), days=["2021-05-11", "2021-06-01"], **to)
    assert rows() == want[:1]
    if as_table:
        assert spark.table(to["table"]).count() == 1


def test_daily_load_refuses_other_tables(spark, tmp_dir):
    df = spark.createDataFrame(DAYS, "date date, words string, total int")
    for i, parts in enumerate(([], ["words"], ["date", "words"])):
        table = _table(tmp_dir) + f"_{i}"
        df.write.partitionBy(*parts).option("path", f"{tmp_dir}/{i}").saveAsTable(table)
        with pytest.raises(ValueError, match="partitioned by"):
            write_daily(df.where("date = DATE'2021-05-10'"), table=table)
        assert spark.table(table).count() == 4
    table = _table(tmp_dir) + "_ok"
    write_daily(df, f"{tmp_dir}/ok", table=table)
    with pytest.raises(ValueError, match="don't fit"):
        write_daily(df.drop("total"), table=table)
    with pytest.raises(ValueError, match="a path or a table"):
        write_daily(df)


def test_exported_texts_come_back(spark, tmp_dir):
    rows = [(1, 'a "b", c\nd\\'), (2, ""), (3, None), (4, " x ")]
    export(spark.createDataFrame(rows, "id long, t string"), f"{tmp_dir}/csv", "csv")
    assert sorted(tuple(r) for r in read_exported_csv(spark, f"{tmp_dir}/csv", "id long, t string").collect()) == rows


def test_fact_overwrite(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "x int")
    write_fact(df, f"{tmp_dir}/fact")
    write_fact(df, f"{tmp_dir}/fact")
    assert spark.read.parquet(f"{tmp_dir}/fact").count() == 1


def test_export_columns(spark, tmp_dir):
    df = spark.createDataFrame([(1, "u", "secret")], "id long, username string, other string")
    export(df, f"{tmp_dir}/csv", "csv", ["id", "username"])
    export(df, f"{tmp_dir}/json", "json", ["id", "username"])
    assert spark.read.option("header", True).csv(f"{tmp_dir}/csv").columns == ["id", "username"]
    assert sorted(spark.read.json(f"{tmp_dir}/json").columns) == ["id", "username"]


def test_read_sql_binds_frames(spark):
    df = spark.createDataFrame([("covid", 1.0), ("sars", 2.0)], "category string, v double")
    assert read_sql(spark, "SELECT SUM(v) s FROM {t} WHERE category = 'covid'", t=df).first().s == 1.0


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://db/x", query="SELECT 1", user="u")
    assert o["query"] == "SELECT 1" and "dbtable" not in o
    p = jdbc_options("jdbc:postgresql://db/x", table="t", partition_column="id", lower=0, upper=100, num_partitions=4)
    assert p["numPartitions"] == "4"
    w = jdbc_write_options("jdbc:postgresql://db/x", "tb_pandemics", num_partitions=8)
    assert w["dbtable"] == "tb_pandemics" and w["numPartitions"] == "8"
