import random

from lodestrand.sources import profiles, sections


def test_sections_equal_a_plain_loop(spark):
    rng = random.Random(6)
    docs, marks, blocks, want = [], [], [], {}
    for d in range(60):
        path, checksum = f"f{d}", f"{rng.getrandbits(256):064x}"
        own = sorted({(rng.randrange(8), float(rng.randrange(0, 700, 50))) for _ in range(rng.randint(0, 40))})
        lines = [(p, y, rng.choice(["  text of the block ", "one", "", " ", "two words", "x y z w v u"])) for p, y in own]
        places = sorted((rng.randrange(8), float(rng.randrange(0, 700, 50))) for _ in range(rng.randint(0, 9)))
        book = [(rng.randint(1, 4), rng.choice(["CS-E 10", " AMC to  CS-E", "amc 2 Appendix A", "GENERAL", "CS-E\t3  of all", "CS-EX"]), p, y) for p, y in places]
        docs.append((path, checksum))
        marks += [(path, i, *b) for i, b in enumerate(book)]
        blocks += [(path, *b) for b in lines]
        try:
            got = profiles.chosen_section(book, lines, 5, checksum)
            want[path] = (got["title"], got["chosen"], got["eligible"], got["text"])
        except ValueError as e:
            want[path] = str(e)
    frames = (spark.createDataFrame(docs, "path string, checksum string"), spark.createDataFrame(marks, "path string, n int, level int, title string, page int, y double"), spark.createDataFrame(blocks, "path string, page int, y double, text string"))
    made = sections.drawn_sections(*frames, seed=5)
    rows = {r.path: r.error or (r.title, r.chosen, r.eligible, r.markdown) for r in made.collect()}
    assert rows == want and sum(isinstance(x, tuple) for x in want.values()) > 15
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
    assert sections.drawn_sections(frames[0].limit(0), *frames[1:]).count() == 0
