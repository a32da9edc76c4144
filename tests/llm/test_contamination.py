"""Benchmarks of several automata."""

from pyspark.sql import functions as F

from smeltery.llm import contamination


def test_one_automaton_a_pass(spark):
    """Each pass of a benchmark beyond the limit is a table of its own; no stage holds two automata."""
    items = [(i, f"only{i} few{i} words{i}") for i in range(60)] + [(100, "only1 few1 words1"), (None, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    groups = list(contamination.pattern_groups(benchmark, limit=500))
    windows = [w for g in groups for w in g]
    assert len(groups) > 2 and len(windows) == len(set(windows)) == 60
    assert [g[" only1 few1 words1 "] for g in groups if " only1 few1 words1 " in g] == [["1", "100"]]
    docs = spark.createDataFrame([(i, f"a only{i} few{i} words{i} only{i + 1} few{i + 1} words{i + 1} b") for i in range(70)], "doc_id long, text string")
    found = contamination.scanned(docs, benchmark, ["doc_id"], "seen", limit=500)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = {r["doc_id"]: (r["hit"], r["n"]) for r in found.select("doc_id", contamination.n_hit("seen").alias("hit"), F.size("seen.items").alias("n")).collect()}
    assert got == {i: (3 * ((i < 60) + (i < 59)), (i < 60) + (i < 59) + (i in (0, 1))) for i in range(70)}
