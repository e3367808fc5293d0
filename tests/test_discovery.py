import json
import random

from pyspark.sql import functions as F

from lodestrand.operators import discovery
from lodestrand.sources import nested


def plain(graph, pages, seeds, excluded, depth, most_sub, most_pages):
    """The same walk, category by category."""
    level, seen, found = sorted({s for s in seeds if s and not excluded(s)}), {}, set()
    for d in range(depth + 1):
        seen |= {c: d for c in level}
        for c in level:
            found |= {(c, i + 1, p) for i, p in enumerate(pages.get(c, [])[:most_pages])}
        below = {b for c in level for b in graph.get(c, []) if b not in seen and not excluded(b)}
        level = sorted(below, key=lambda c: (c.lower(), c))[:most_sub]
    return found, seen


def test_walk_of_random_graphs(spark):
    rng = random.Random(2)
    names = [f"{rng.choice('aAbB')}{i}" for i in range(40)]
    graph = {c: rng.sample(names, rng.randint(0, 9)) for c in names}
    pages = {c: [rng.randrange(1000) for _ in range(rng.randint(0, 25))] for c in names}
    rows = [("subcat", c, n, 0, b) for c, below in graph.items() for n, b in enumerate(below, 1)] + [("page", c, n, p, f"t{p}") for c, own in pages.items() for n, p in enumerate(own, 1)]
    members = spark.createDataFrame(rows, "kind string, category string, n int, id long, title string").cache()
    asked, api = [], discovery.table_api(members)

    def ask(requests):
        asked.extend(map(tuple, requests.select("kind", "category", "start").collect()))
        assert requests.filter("size > 7 or size < 1").count() == 0
        return api(requests)

    seeds = spark.createDataFrame([(names[0],), (names[1],), (names[1],), (None,), ("missing",)], "category string")
    for depth, most_sub, most_pages in ((0, None, None), (2, None, 10), (3, 4, None)):
        asked.clear()
        found, seen = discovery.discover(ask, seeds, lambda c: c.endswith("3"), depth=depth, max_subcategories=most_sub, max_pages=most_pages, part=7)
        want, known = plain(graph, pages, [r.category for r in seeds.collect()], lambda c: c.endswith("3"), depth, most_sub, most_pages)
        assert {(r.category, r.n, r.id) for r in found.collect()} == want and {r.category: r.depth for r in seen.collect()} == known
        assert len(asked) == len(set(asked))  # nothing is asked twice, cycles or not
    assert discovery.discover(ask, seeds.limit(0), lambda c: F.lit(False))[0].count() == 0


def leaves(value, path=""):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in leaves(v, f"{path}[{i}]")]
    return [(path, "" if value is None else str(value))]


def test_nested_json(spark):
    rng = random.Random(4)

    def value(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([None, True, False, 0, -7, 12.5, "", "text", "[1]", '{"a": 1}', "é.[0]", "null"])
        if rng.random() < 0.5:
            return [value(depth - 1) for _ in range(rng.randint(0, 4))]
        return {rng.choice(["a", "b", "key with space", "x.y", "ü", "", "[0]"]) + str(i): value(depth - 1) for i in range(rng.randint(0, 4))}

    texts = [json.dumps(value(7), ensure_ascii=False) for _ in range(200)] + ["[" * 60 + "1" + "]" * 60, '"root"', "null", "{}", "[]", "[[], {}]"]
    rows = list(enumerate(texts)) + [(1000, None), (1001, "{broken"), (1002, "")]
    got = {}
    for r in nested.flatten(spark.createDataFrame([(*r, "x") for r in rows], "id int, json string, `key` string").repartition(4), "json").collect():
        got.setdefault(r.id, []).append((r.path, r.value))
        assert r.key == "x"
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(leaves(json.loads(t))) for i, t in enumerate(texts) if leaves(json.loads(t))}
    assert nested.flatten(spark.createDataFrame([], "id int, json string"), "json").count() == 0


def test_member_ids_equal_the_id_of_the_whole_list(spark):
    from lodestrand.operators import dedup
    from lodestrand.operators.passages import stable_id

    rng = random.Random(1)
    rows = [(c, f"{rng.choice('aé\"')}{i}") for i, c in enumerate(rng.choice([1, 2, 3, 4, 5]) for _ in range(300))] + [(9, "alone"), (10, "x"), (10, "y")]
    got = {r.component: r.id for r in dedup.member_ids(spark.createDataFrame(rows, "component long, node string").repartition(5), "g").collect()}
    assert got == {c: stable_id("g", *sorted(n for k, n in rows if k == c)) for c in {c for c, _ in rows}}
    assert dedup.member_ids(spark.createDataFrame([], "component long, node string"), "g").count() == 0
