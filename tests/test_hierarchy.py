from archivolt.operators import hierarchy


def test_long_redirect_chains_and_cycles(spark):
    hops = [(f"a{i}", f"a{i + 1}", "301") for i in range(24)] + [(f"c{i}", f"c{(i + 1) % 23}", "302") for i in range(23)]
    got = {r.url: r for r in hierarchy.redirect_chains(spark.createDataFrame(hops, "source string, target string, status string"), "source", "target", "status").collect()}
    assert len(got) == 47
    for i in range(24):
        r = got[f"a{i}"]
        assert ([h["to"] for h in r.hops], r.final_url, r.is_loop) == ([f"a{k}" for k in range(i + 1, 25)], "a24", False)
    for i in range(23):
        r = got[f"c{i}"]
        assert (len(r.hops), r.final_url, r.is_loop) == (22, f"c{(i + 22) % 23}", True)


def test_deep_chains_cycles_and_trees(spark):
    hops = [(f"a{i:03d}", f"a{i + 1:03d}", "301") for i in range(500)] + [(f"c{i}", f"c{(i + 1) % 500}", "302") for i in range(500)]
    hops += [("self", "self", "301"), ("in", "self", "301"), ("rho", "c7", "301")]
    chains = hierarchy.redirect_chains(spark.createDataFrame(hops, "source string, target string, status string"), "source", "target", "status")
    got = {r.url: (len(r.hops), r.final_url, r.is_loop) for r in chains.collect()}
    assert len(got) == 1003
    assert all(got[f"a{i:03d}"] == (500 - i, "a500", False) for i in range(500))
    assert all(got[f"c{i}"] == (499, f"c{(i + 499) % 500}", True) for i in range(500))
    assert got["self"] == (1, "self", True) and got["in"] == (1, "self", True) and got["rho"] == (500, "c6", True)
    nodes = spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else None, f"l{i}") for i in range(1000)], "ref string, parent string, title string")
    depth = {r.ref: r.depth for r in hierarchy.node_paths(nodes, "ref", "parent", "title").collect()}
    assert all(depth[f"n{i}"] == i + 1 for i in range(1000))


def test_chains_against_a_walk(spark):
    import random

    rnd = random.Random(2)
    for _ in range(3):
        to = {i: rnd.randrange(40) for i in rnd.sample(range(40), 30)}
        chains = hierarchy.redirect_chains(spark.createDataFrame([(str(a), str(b), "301") for a, b in to.items()], "source string, target string, status string"), "source", "target", "status")
        for r in chains.collect():
            at, seen, hops = to[int(r.url)], {int(r.url), to[int(r.url)]}, [to[int(r.url)]]
            while at in to and to[at] not in seen:
                at = to[at]
                seen.add(at)
                hops.append(at)
            assert ([int(h["to"]) for h in r.hops], int(r.final_url), r.is_loop) == (hops, at, at in to)
