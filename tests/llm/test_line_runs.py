"""Line runs against their SQL and by hand."""

import pytest
from pyspark.sql import functions as F

from kontora.llm import line_runs
from kontora.llm.common import documents, keyed
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_equals_sql(spark):
    got = line_runs.report(documents(spark, FOLDER)).drop("runs")
    assert compare(got, connect(FOLDER), line_runs.SQL) == ""


def say(tag, n):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_by_hand(spark):
    a, b, c, d = say("a", 30), say("b", 30), say("c", 10), say("d", 70)
    rows = [
        (1, f"{a}\n{b}\n{c}\nown one", "k"),
        (2, f"own two\n{a}\n\n{b}\n{c}\nmore", "k"),  # a run of three lines with a blank one in it
        (3, f"{a}\n{c}\n{b}", "k"),  # a and c, or c and b, have too few words
        (4, f"{d}\n{d}\n{d}", "k"),  # repeats inside a text
        (5, f"{c}\n{d}\n{c}", "k"),
        (6, None, "k"), (7, "", "k"), (8, " \n\t", "k"), (9, f"{a}\n{b}", "k"), (9, f"{a}\n{b}", "k"), (None, f"x\n{d}", "k"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in line_runs.report(docs).collect()), key=str)
    assert got == sorted([
        (1, 4, 0, rows[0][1]), (2, 6, 4, "own two\nmore"), (3, 3, 0, rows[2][1]), (4, 3, 2, d), (5, 3, 1, f"{c}\n{c}"),
        (6, 0, 0, None), (7, 1, 0, ""), (8, 2, 0, " \n\t"), (9, 2, 2, ""), (9, 2, 2, ""), (None, 2, 1, "x"),
    ], key=str)
    clean = line_runs.deduplicated(docs)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, 7, 8, None]))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.report(docs).collect() == [] and line_runs.deduplicated(docs).collect() == []


def test_repeated_rows_are_combined_before_the_shuffle(spark):
    text = "\n".join(" ".join(f"w{k}{x}" for x in range(9)) for k in range(12))
    docs = spark.range(20_000).select(F.lit(7).alias("doc_id"), F.lit(text).alias("text")).unionByName(spark.createDataFrame([(8, text), (9, "other")], "doc_id int, text string"))
    rows = line_runs.lines(keyed(docs))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in below and "h#" in below  # the copies of a row are combined before they are sent
    assert rows.count() == 12 + 12 + 1
    got = {r.doc_id: r for r in line_runs.report(docs).drop("runs").distinct().collect()}
    assert set(got) == {7, 8, 9} and got[7].n_removed == 0 and got[8].n_removed == 12
