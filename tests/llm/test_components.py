import random

from linkseek.llm.components import components, grown_components


def labels(df):
    return {r.node: r.label for r in df.collect()}


def test_grown_components_are_those_of_all_edges(spark, work):
    rng = random.Random(2)
    batches = [[(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (12, 0, 9, 15)]
    grown, edges = None, []
    for batch in batches:
        edges += batch
        grown = grown_components(grown, spark.createDataFrame(batch, "a long, b long"), work)
        want = labels(components(spark.createDataFrame(edges, "a long, b long"), work))
        got = labels(grown)
        # A link of a node to itself makes no node in what grows.
        assert {n: got.get(n, n) for n in want} == want and len(got) == grown.count()


def test_old_links_are_not_gone_through_again(spark, work, monkeypatch):
    from linkseek.llm import components as module

    seen, plain = [], components
    monkeypatch.setattr(module, "components", lambda edges, w: (seen.append(edges.count()), plain(edges, w))[1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    first = grown_components(None, chain, work)
    further = spark.createDataFrame([(3, 9), (5, 50), (41, 42)], "a long, b long")
    assert labels(grown_components(first, further, work)) == {**{i: 0 for i in range(41)}, 50: 0, 41: 41, 42: 41}
    assert seen == [40, 2]
