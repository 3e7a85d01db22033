import random
import time

from siltstone.operators import history as H


def brute_paths(parents, tip, goal):
    """All simple paths from tip towards goal, at most two."""
    found = []

    def walk(at, seen, trail):
        if len(found) > 1:
            return
        if at == goal:
            found.append(list(reversed(trail)))
        elif at not in seen:
            for p in parents.get(at, ()):
                walk(p, seen | {at}, [*trail, at])

    walk(tip, frozenset(), [])
    return found[0] if len(found) == 1 else None


def table(spark, graphs):
    rows = [(w, c, p) for w, parents in graphs.items() for c, ps in parents.items() for p in (ps or [None])]
    return spark.createDataFrame(rows, "workflow string, revision string, parent string")


def test_unique_paths_over_all_pairs_of_random_graphs(spark):
    rng = random.Random(5)
    graphs = {}
    for w in range(4):
        parents = {"c0": []}
        for k in range(1, 26):
            parents[f"c{k}"] = sorted({f"c{max(0, k - d)}" for d in ([1] if rng.random() < 0.7 else [1, rng.randrange(2, 6)])})
        graphs[f"w{w}"] = parents
    graphs["loop"] = {"a": ["b"], "b": ["c"], "c": ["a", "d"], "d": []}
    graphs["alone"] = {"x": []}
    wanted = [(w, b, a) for w, parents in graphs.items() for b in parents for a in parents if w != "loop" or "d" in (a, b)]
    got = H.unique_paths(table(spark, graphs), spark.createDataFrame(wanted, "workflow string, before string, after string")).collect()
    expected = {(w, b, a): tuple(path) for w, b, a in wanted if (path := brute_paths(graphs[w], a, b)) is not None}
    assert {(r.workflow, r.before, r.after): tuple(r.path) for r in got} == expected and len(got) == len(expected)


def test_a_path_of_5000_commits_takes_rounds_by_its_logarithm(spark):
    chain = table(spark, {"w": {f"c{k}": [f"c{k - 1}"] if k else [] for k in range(5001)}}).repartition(4)
    wanted = spark.createDataFrame([("w", "c0", "c5000"), ("w", "c17", "c4242")], "workflow string, before string, after string")
    began = time.time()
    got = {r.before: r.path for r in H.unique_paths(chain, wanted).collect()}
    assert got == {"c0": [f"c{k}" for k in range(1, 5001)], "c17": [f"c{k}" for k in range(18, 4243)]}
    assert time.time() - began < 120


def brute_next(failed, runs, parents):
    w, rev, attempt, run = failed
    known = lambda a: a if a is not None and a >= 1 else None
    same, later = [], []
    for w2, rev2, a2, r2 in runs:
        if r2 == run or w2 != w:
            continue
        if rev2 == rev and (known(attempt) is None or known(a2) is None or known(a2) > known(attempt)):
            same.append((known(a2) or 0, r2))
        elif rev is not None and rev2 is not None and rev2 != rev and (path := brute_paths(parents, rev2, rev)):
            later.append((len(path), r2))
    if same:
        return min(same)[1], 0
    return (min(later)[1], min(later)[0]) if later else None


def test_next_runs_with_unknown_attempts_and_far_descendants(spark):
    rng = random.Random(6)
    parents = {"c0": []}
    for k in range(1, 30):
        parents[f"c{k}"] = sorted({f"c{k - 1}", *([f"c{max(0, k - 3)}"] if k % 11 == 0 else [])})
    runs = [("w", rng.choice([f"c{k}" for k in range(30)]), rng.choice([None, 0, 1, 2, 3]), k) for k in range(25)]
    runs += [("w", "c29", 2, 25), ("w", None, 1, 26), ("w", None, None, 27), (None, None, 1, 28), (None, None, 2, 29), ("w", "elsewhere", 1, 30)]
    frame = spark.createDataFrame(runs, "workflow string, revision string, attempt int, run_id long")
    commits = table(spark, {"w": parents})
    nearest = H.nearest_descendants(commits, frame.where("revision is not null"), frame.where("revision is not null"))
    got = {r.run_id: (r.next_run_id, r.distance) for r in H.next_runs(frame, frame, nearest).collect()}
    assert got == {r[3]: found for r in runs if (found := brute_next(r, runs, parents))}


def test_next_runs_read_the_runs_once_and_failures_once(spark):
    frame = spark.createDataFrame([("w", "c0", None, 1), ("w", "c0", None, 1), ("w", "c0", 1, 2), ("w", "c0", 1, 3), ("w", "c0", 4, 4)], "workflow string, revision string, attempt int, run_id long")
    found = H.next_runs(frame, frame, spark.createDataFrame([], "workflow string, before string, after string, distance long"))
    assert {(r.run_id, r.next_run_id) for r in found.collect()} == {(1, 2), (2, 1), (3, 1), (4, 1)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2


def test_work_on_long_histories_ends_at_merges_that_all_walks_pass(spark):
    """Every fifth commit merges the two before it: no unique path is longer than six steps, however long the history."""
    rows = [("w", f"c{k}", f"c{k - d}" if k else None) for k in range(200) for d in ((1, 2) if k and k % 5 == 0 else (1,))]
    commits = spark.createDataFrame(rows, "workflow string, revision string, parent string")
    nodes, edges, cyclic = H.graph_of(commits, commits.limit(0).select("workflow", commits.revision.alias("node")))
    assert cyclic is None
    assert {r.node: (r.height, r.floor) for r in nodes.collect()} == {f"c{k}": (k, k - k % 5 - 2 if k >= 5 else -1) for k in range(200)}
    tables = H.jumps(edges)
    assert len(tables) == 3
    goals = nodes.selectExpr("id as goal", "height as base", "cast(null as bigint) as top")
    assert H.counted_paths(tables, goals).count() == sum(min(k, k % 5 + 1 if k >= 5 else k) + 1 for k in range(200))  # of 20,100 pairs
