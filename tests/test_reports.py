"""Reports are read once, by as many tasks as there are partitions, and short lists of targets take no join."""

import re

import pytest
from ledgerleaf.fixed_values import TARGETS
from ledgerleaf.plans import rendered
from ledgerleaf.plans.documents import all_rows_of
from ledgerleaf.plans.formats import SPECS
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(repr(r) for r in df.collect())


@pytest.mark.parametrize("name", ["report_asteria", "report_asteria_2023", "report_eurizon", "report_eurizon_old", "report_fideuram", "report_amundi2", "report_arca", "report_mediolanum", "report_all_formats"])
def test_no_filter_reads_pages_once_more(spark, name):
    text = plan(rendered.QUERIES[name](spark, SF))
    assert "from_xml" in text and not [x for x in text.splitlines() if re.search(r"Filter", x) and "from_xml" in x]
    assert len(re.findall(r"Generate inline\((?:CASE|element)", text)) == 1 and "Join" not in text


def test_pages_are_dealt_out_to_all_partitions(spark):
    assert rendered.report_pages(spark, SF, "EURIZON").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_short_and_long_lists_of_targets_give_the_same_rows(spark, tmp_path):
    names = ["ANIMA", "ARCA", "MEDIOLANUM"]
    made = [rendered.report_pages(spark, SF, n).withColumn("format", F.lit(n)) for n in names]
    made[0].unionByName(made[1]).unionByName(made[2]).write.parquet(str(tmp_path / "pages"))
    read = spark.read.parquet(str(tmp_path / "pages"))
    targets = [*rendered.ISSUERS, " ", "Alder", *TARGETS[:20]]
    short, long = (all_rows_of(read, targets + more, [SPECS[n] for n in names]) for more in ([], [f"nobody {k} zzz" for k in range(300)]))
    assert short.count() > 0 and rows(short) == rows(long.select(*short.columns))
