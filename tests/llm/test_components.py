"""Both ways to the roots, against a walk over the neighbours."""

import random

import pytest

from faultline.llm.components import connected


def walked(edges):
    near, roots = {}, {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for start in sorted(near):
        todo = [start] if start not in roots else []
        while todo:
            node = todo.pop()
            if node not in roots:
                roots[node] = start
                todo += near[node]
    return roots


SHUFFLED = list(range(-40, 40))
random.Random(3).shuffle(SHUFFLED)
CASES = {
    "none": [], "loop": [(7, 7)], "knotted": list(zip(SHUFFLED, SHUFFLED[1:])), "repeated": [(2, 1), (1, 2), (2, 1), (5, 4)],
    "star": [(900, i) for i in range(50)], "random": [(random.Random(i).randrange(80), random.Random(-i).randrange(80)) for i in range(1, 60)],
}


@pytest.mark.parametrize("one_task", [1 << 18, -1])
@pytest.mark.parametrize("name", ["none", "loop", "knotted", "repeated", "star", "random"])
def test_roots(spark, name, one_task):
    rows = connected(spark.createDataFrame(CASES[name], "a bigint, b bigint"), one_task).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.root for r in rows} == walked(CASES[name])
