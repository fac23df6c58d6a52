from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from carelattice.llm.components import connected_components


def brute(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return sorted((x, root(x)) for x in parent)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), max_size=40))
def test_random_links(spark, pairs):
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert sorted(map(tuple, connected_components(links).collect())) == brute(pairs)


def test_long_chain_and_hot_node_and_null_ends(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(None, 3), (4, None), (7, 7)]
    links = spark.createDataFrame(pairs + pairs[:5], "a bigint, b bigint")
    assert sorted(map(tuple, connected_components(links).collect())) == brute(pairs)
