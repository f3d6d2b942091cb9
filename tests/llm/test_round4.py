"""Components in few jobs, and the same ones from blocks of links."""

import pytest

from meterspan.llm import near_dedup

EDGES = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7), (200, 200), (300, 5), (None, 9)]


def brute(edges):
    up = {}
    for a, b in edges:
        if a is not None and b is not None:
            up.setdefault(a, a), up.setdefault(b, b)
            low, high = sorted((up[a], up[b]))
            up = {x: low if y == high else y for x, y in up.items()}
    return up


@pytest.mark.parametrize("block", [near_dedup.FOREST, 9])
def test_components_of_one_block_and_of_several(spark, block):
    edges = spark.createDataFrame(EDGES, "a long, b long").repartition(8)
    got = near_dedup.components(edges, block).collect()
    assert {r["class"]: r.root for r in got} == brute(EDGES)
    assert len(got) == len(brute(EDGES))


def test_components_of_few_links_need_few_jobs(spark):
    """Before, every round of labels was two jobs over all shuffle partitions."""
    edges = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in EDGES[:40]], "a binary, b binary")
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "components")
    got = near_dedup.components(edges).collect()
    jobs = context.statusTracker().getJobIdsForGroup("few-jobs")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert {bytes(r.root) for r in got} == {bytes([0])} and len(got) == 41
    assert len(jobs) <= 6
