"""History: commit graph paths, next runs, flakiness, equivalence, attribution and repair episodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import identity
from siltstone.operators.ordered import tree_digest
from siltstone.session import written as cut


def flake_classes(runs: DataFrame) -> DataFrame:
    """Per (revision, workflow): alternations of failure and success in order of attempt, and the class.

    Runs without a conclusion leave before neighbours are compared; unknown attempts and times come first.
    """
    order = Window.partitionBy("revision", "workflow").orderBy(F.coalesce("attempt", F.lit(0)), F.coalesce("updated_at", F.lit("")), "run_id")
    seen = runs.where("conclusion is not null").withColumn("before", F.lag("conclusion").over(order))
    decided = F.col("before").isin("failure", "success") & F.col("conclusion").isin("failure", "success")
    counts = seen.groupBy("revision", "workflow").agg(
        F.count_if(decided & (F.col("before") != F.col("conclusion"))).alias("alternations"),
        F.count_if(F.col("conclusion") == "failure").alias("failures"),
        F.count_if(F.col("conclusion") == "success").alias("successes"),
        F.count_if(F.col("conclusion").isin("cancelled", "timed_out")).alias("interrupted"),
    )
    kind = F.when(F.col("alternations") >= 2, "verified").when((F.col("failures") > 0) & (F.col("successes") > 0), "suspected").otherwise("none")
    return counts.withColumn("flake_class", kind)


MOST = 2  #: Paths are counted to two: what matters is whether there is exactly one.


def generations(edges: DataFrame, longest: int) -> tuple[DataFrame, DataFrame | None]:
    """(node, generation): the steps of the longest walk from a commit to a root; and the commits (at) of walks without an
    end (None without any). Walks double in each round; one of more steps than ``longest`` is in a cycle."""
    generation = cut(edges.select(F.explode(F.array("at", "to")).alias("node")).distinct().withColumn("generation", F.lit(0).cast("long")))
    walks, step = edges.select("at", "to"), 1
    while not walks.isEmpty():
        if step > longest:
            return generation, walks.select("at").distinct()
        further = walks.join(generation.select(F.col("node").alias("to"), F.col("generation").alias("g")), "to").groupBy(F.col("at").alias("node")).agg((F.max("g") + step).alias("g"))
        generation = cut(generation.join(further, "node", "left").select("node", F.greatest("generation", F.coalesce("g", F.lit(0))).alias("generation")))
        walks = cut(walks.join(walks.select(F.col("at").alias("to"), F.col("to").alias("end")), "to").select("at", F.col("end").alias("to")).distinct())
        step *= 2
    return generation, None


def floors(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(workflow, height, floor): the generation at or below which a commit of this generation has no unique path.

    A generation is narrow if it has one commit and no edge passes it by, so that all walks go through that commit. If it is
    a merge, two paths at least lead from it to the next narrow generation below, and so to all that is further down.
    ``edges``: workflow, height, deep (of both ends); ``nodes``: workflow, height, a row per commit.
    """
    mark = lambda level, parents, over: F.struct(level.cast("long").alias("height"), F.lit(0).alias("commits"), F.lit(parents).alias("parents"), over.alias("over"))
    past = F.when(F.col("height") > F.col("deep") + 1, 1).otherwise(0)
    marks = edges.select("workflow", F.explode(F.array(mark(F.col("height"), 1, -past), mark(F.col("deep") + 1, 0, past))).alias("m")).select("workflow", "m.*")
    marks = marks.unionByName(nodes.select("workflow", "height", F.lit(1).alias("commits"), F.lit(0).alias("parents"), F.lit(0).alias("over")))
    levels = marks.groupBy("workflow", "height").agg(*(F.sum(x).alias(x) for x in ("commits", "parents", "over")))
    order = Window.partitionBy("workflow").orderBy("height")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    narrow = (F.col("commits") == 1) & (F.col("passing") == 0)
    levels = levels.withColumn("passing", F.sum("over").over(so_far))
    levels = levels.withColumn("under", F.last(F.when(narrow, F.col("height")), ignorenulls=True).over(before))
    return levels.select("workflow", "height", F.coalesce(F.max(F.when(narrow & (F.col("parents") > 1), F.col("under"))).over(so_far), F.lit(-1)).alias("floor"))


def graph_of(commits: DataFrame, named: DataFrame, tips: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The nodes and edges of a commit table by number, so that rounds move numbers instead of names, and the workflows whose
    graph has a cycle (None without any), which are left out.

    Nodes: id, workflow, node, height (generation), floor (see ``floors``), tip (whether it is among ``tips``), of commits
    with an edge and of those ``named`` (workflow, node). Edges: at, to, once each, with height, floor and tip of the upper
    end and the depth of the lower.
    """
    edges = cut(commits.where("parent is not null").select("workflow", F.col("revision").alias("at"), F.col("parent").alias("to")).distinct())
    longest = edges.groupBy("workflow").count().agg(F.max("count")).first()[0] or 0
    nodes = edges.select("workflow", F.explode(F.array("at", "to")).alias("node")).unionByName(named.select("workflow", "node")).dropna().distinct()
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("id"), "workflow", "node"))
    for end in ("at", "to"):
        edges = edges.join(nodes.select("workflow", F.col("node").alias(end), F.col("id").alias(f"{end}_id")), ["workflow", end])
    edges = cut(edges.select(F.col("at_id").alias("at"), F.col("to_id").alias("to")))
    generation, cyclic = generations(edges, longest + 1)
    if cyclic is not None:
        cyclic = cut(nodes.join(cyclic.select(F.col("at").alias("id")), "id").select("workflow").distinct())
        nodes = nodes.join(cyclic, "workflow", "left_anti")
    nodes = cut(nodes.join(generation.select(F.col("node").alias("id"), F.col("generation").alias("height"), F.lit(True).alias("joined")), "id", "left"))
    edges = edges.join(nodes.select(F.col("id").alias("at"), "workflow", "height"), "at").join(nodes.select(F.col("id").alias("to"), F.col("height").alias("deep")), "to")
    edges = cut(edges)
    nodes = nodes.join(floors(edges, nodes.where("joined").select("workflow", "height")), ["workflow", "height"], "left")
    if tips is None:
        nodes = nodes.withColumn("tip", F.lit(False))
    else:
        nodes = nodes.join(tips.select("workflow", "node").distinct().withColumn("tip", F.lit(True)), ["workflow", "node"], "left")
    nodes = cut(nodes.select("id", "workflow", "node", F.coalesce("height", F.lit(0)).alias("height"), F.coalesce("floor", F.lit(-1)).alias("floor"), F.coalesce("tip", F.lit(False)).alias("tip")))
    return nodes, edges.join(nodes.select(F.col("id").alias("at"), "floor", "tip"), "at").select("at", "to", "height", "floor", "tip", "deep"), cyclic


def jumps(edges: DataFrame) -> list[DataFrame]:
    """Jump tables of a graph without cycles. Table k has a row (at, to, n, mid) for commits that are 2^k steps apart: n
    paths, and if it is one, the commit in its middle. What is at or below the floor of its upper end is left out: it is
    no part of a unique path, nor can it make one look unique, as floors never rise on the way down."""
    tables = [cut(edges.where("deep > floor").withColumns({"n": F.lit(1), "mid": F.lit(None).cast("long")}))]
    while not tables[-1].isEmpty():
        there = tables[-1].select(F.col("at").alias("to"), F.col("to").alias("end"), F.col("deep").alias("end_deep"), F.col("n").alias("m"))
        twice = tables[-1].join(there, "to").where("end_deep > floor").groupBy("at", F.col("end").alias("below"))
        twice = twice.agg(F.least(F.lit(MOST), F.sum(F.col("n") * F.col("m"))).cast("int").alias("n"), F.min("to").alias("mid"), F.max("end_deep").alias("deep"), *(F.max(c).alias(c) for c in ("height", "floor", "tip")))
        tables.append(cut(twice.withColumnRenamed("below", "to")))
    return tables[:-1]


def counted_paths(tables: list[DataFrame], goals: DataFrame, settled=None) -> DataFrame:
    """(at, goal, base, top, height, tip, n, far, level, via) for commits above a goal's floor that it can be reached from.

    ``goals``: goal, base (its generation), top: commits of a higher generation than top are of no interest (null: all are).
    n paths (to two); if it is one, it has ``far`` steps, and begins with a jump of 2^level steps to ``via`` (level -1:
    none). Round k adds the paths of 2^k to 2^(k+1) - 1 steps as a jump and a shorter path. ``settled(steps)`` may be a
    condition on all rows of a goal for that no longer paths are needed.
    """
    found = cut(goals.select(F.col("goal").alias("at"), "goal", "base", "top", F.col("base").alias("height"), F.lit(False).alias("tip"), F.lit(1).alias("n"), F.lit(0).cast("long").alias("far"), F.lit(-1).alias("level"), F.lit(None).cast("long").alias("via")))
    done = None
    for k, table in enumerate(tables):
        jump = table.select(F.col("at").alias("from"), F.col("to").alias("at"), F.col("n").alias("m"), F.col("height").alias("high"), "floor", F.col("tip").alias("tested"))
        longer = found.join(jump, "at").where("base > floor and (top is null or high <= top)")
        longer = longer.select(F.col("from").alias("at"), "goal", "base", "top", F.col("high").alias("height"), F.col("tested").alias("tip"), F.least(F.lit(MOST), F.col("n") * F.col("m")).alias("n"), (F.col("far") + 2**k).alias("far"), F.lit(k).alias("level"), F.col("at").alias("via"))
        both = found.unionByName(longer)
        if settled is not None:  # a goal's rows in one place serve the sums and the condition
            both = both.repartition("goal")
        both = both.groupBy("at", "goal").agg(F.least(F.lit(MOST), F.sum("n")).cast("int").alias("n"), *(F.max(c).alias(c) for c in ("base", "top", "height", "tip", "level")), *(F.min(c).alias(c) for c in ("far", "via")))
        if settled is None or k + 1 == len(tables):
            found = cut(both)
        else:
            both = cut(both.withColumn("ready", settled(2 ** (k + 1))))
            out, found = both.where("ready").drop("ready"), both.where("not ready").drop("ready")
            done = out if done is None else done.unionByName(out)
    return found if done is None else done.unionByName(found)


def spelled(pairs: DataFrame, found: DataFrame, tables: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """(workflow, before, after, path) of pairs (goal, tip, level, via) that one path joins, from the jumps that it is made of.

    From the largest jumps down, each is split in its middle, until single steps with their place in the path are left. A
    head is the commit that the rest of a path begins at; it waits for the round of its own jump.
    """
    key = ["goal", "tip"]
    pairs = cut(pairs)
    origin = found.where("n = 1 and level >= 0").select("goal", "at", "level", "via")
    heads = pairs.where("level >= 0").select(*key, F.col("tip").alias("at"), "level", "via", F.lit(0).cast("long").alias("place"))
    parts, most = None, pairs.agg(F.max("level")).first()[0]
    for k in reversed(range(0 if most is None else most + 1)):
        step = 2**k
        if parts is not None:
            middle = tables[k + 1].where("n = 1").select("at", "to", "mid")
            halves = F.explode(F.array(F.struct(F.col("at"), F.col("mid").alias("to"), F.col("place")), F.struct(F.col("mid").alias("at"), F.col("to"), (F.col("place") + step).alias("place"))))
            parts = parts.join(middle, ["at", "to"]).select(*key, halves.alias("h")).select(*key, "h.*")
        taken = heads.where(F.col("level") == k).select(*key, "at", F.col("via").alias("to"), "place")
        parts = cut(taken if parts is None else parts.unionByName(taken))
        if k:
            moved = heads.where(F.col("level") == k).select(*key, F.col("via").alias("at"), (F.col("place") + step).alias("place")).join(origin.where(F.col("level") < k), ["goal", "at"])
            heads = cut(heads.where(F.col("level") < k).unionByName(moved.select(heads.columns)))
    rows = pairs.select(*key, F.col("goal").alias("id"), F.lit(None).cast("long").alias("place"))  # the goal itself comes first
    if parts is not None:
        rows = rows.unionByName(parts.select(*key, F.col("at").alias("id"), "place"))
    rows = rows.join(nodes.select("id", "workflow", "node"), "id").select(*key, F.when(F.col("place").isNull(), F.col("workflow")).alias("workflow"), F.struct((-F.col("place")).alias("place"), "node").alias("x"))
    rows = rows.groupBy(*key).agg(F.max("workflow").alias("workflow"), F.transform(F.array_sort(F.collect_list("x")), lambda x: x["node"]).alias("names"))
    return rows.select("workflow", F.col("names")[0].alias("before"), F.element_at("names", -1).alias("after"), F.slice("names", F.lit(2), F.size("names")).alias("path"))


def unique_paths(commits: DataFrame, wanted: DataFrame) -> DataFrame:
    """(workflow, before, after, path) for pairs whose commits are joined by exactly one chain of parents.

    ``commits``: workflow, revision, parent (null at the root). ``wanted``: workflow, before, after. The path leaves out
    ``before`` and ends in ``after``; equal ends have an empty path. Rounds grow with the logarithm of the longest path;
    only commits between a goal and the highest generation of its wanted tips are counted, and none that a merge through
    which all walks go already joins by two paths. Workflows whose graph has a cycle, which no history of commits has, are
    walked step by step.
    """
    wanted = wanted.select("workflow", "before", "after")
    nodes, edges, cyclic = graph_of(commits, wanted.where("before = after").select("workflow", F.col("before").alias("node")))
    end = lambda name, new, *more: nodes.select("workflow", F.col("node").alias(name), F.col("id").alias(new), *more)
    pairs = wanted.join(end("before", "goal", F.col("height").alias("base")), ["workflow", "before"]).join(end("after", "tip", "height", "floor"), ["workflow", "after"])
    pairs = cut(pairs.where("goal = tip or (base < height and base > floor)").select("goal", "tip", "base", "height").distinct())
    tables = jumps(edges)
    found = counted_paths(tables, pairs.groupBy("goal", "base").agg(F.max("height").alias("top")))
    one = found.where("n = 1").select("goal", F.col("at").alias("tip"), "level", "via").join(pairs.select("goal", "tip"), ["goal", "tip"])
    out = spelled(one, found, tables, nodes)
    return out if cyclic is None else out.unionByName(walked_paths(commits.join(cyclic, "workflow", "left_semi"), wanted.join(cyclic, "workflow", "left_semi")))


def walked_paths(commits: DataFrame, wanted: DataFrame) -> DataFrame:
    """``unique_paths`` by walking from ``after`` towards the parents a step at a time; walks end where they meet themselves.

    Walks that meet in a commit are counted together, so merges don't multiply them: two are as good as many.
    """
    edges = cut(commits.where("parent is not null").select("workflow", F.col("revision").alias("at"), "parent").distinct())
    key = ["workflow", "goal", "tip"]
    front = wanted.select("workflow", F.col("before").alias("goal"), F.col("after").alias("tip")).distinct()
    front = cut(front.withColumns({"at": F.col("tip"), "path": F.array("tip"), "n": F.lit(1)}))
    hits = front.where("at = goal")
    while not front.isEmpty():
        walked = front.where("at != goal").join(edges, ["workflow", "at"]).where(~F.array_contains("path", F.col("parent")))
        walked = walked.groupBy(*key, F.col("parent").alias("at")).agg(F.min(F.array_append("path", F.col("parent"))).alias("path"), F.least(F.lit(MOST), F.sum("n")).cast("int").alias("n"))
        front = cut(walked.select(*key, "at", "path", "n"))
        hits = cut(hits.unionByName(front.where("at = goal")))
    found = hits.groupBy(*key).agg(F.sum("n").alias("n"), F.min("path").alias("path")).where("n = 1")
    return found.select("workflow", F.col("goal").alias("before"), F.col("tip").alias("after"), F.reverse(F.slice("path", 1, F.size("path") - 1)).alias("path"))


def nearest_descendants(commits: DataFrame, failed: DataFrame, tested: DataFrame) -> DataFrame:
    """(workflow, before, after, distance): for each failed revision the revisions among ``tested`` (workflow, revision)
    that are nearest by a unique path; several if they are equally near.

    Paths are counted for all goals at once, in rounds of doubled length. A goal leaves as soon as a pair is final (no
    path can be longer than the difference of generations) and no pair that is still open could be nearer, so the work
    depends on how far away the next run is, not on the length of the history.
    """
    goals = failed.select("workflow", F.col("revision").alias("node")).distinct()
    tips = tested.select("workflow", F.col("revision").alias("node"))
    nodes, edges, cyclic = graph_of(commits, goals.limit(0), tips)
    hit = F.col("tip") & (F.col("n") == 1) & (F.col("far") > 0)

    def settled(steps: int) -> Column:
        final, goal = F.col("height") - F.col("base") < steps, Window.partitionBy("goal")
        nearest, still_open = F.min(F.when(hit & final, F.col("far"))).over(goal), F.min(F.when(hit & ~final, F.col("far"))).over(goal)
        return nearest.isNotNull() & (still_open.isNull() | (still_open > nearest))

    known = nodes.join(goals, ["workflow", "node"]).select(F.col("id").alias("goal"), F.col("height").alias("base"), F.lit(None).cast("long").alias("top"))
    out = counted_paths(jumps(edges), known, settled).where(hit).select("goal", F.col("at").alias("tip"), F.col("far").alias("distance"))
    out = out.withColumn("best", F.min("distance").over(Window.partitionBy("goal"))).where("distance = best").drop("best")
    named = lambda old, new: nodes.select(F.col("id").alias(old), F.col("node").alias(new))
    out = out.join(nodes.select(F.col("id").alias("goal"), "workflow", F.col("node").alias("before")), "goal").join(named("tip", "after"), "tip").select("workflow", "before", "after", "distance")
    if cyclic is None:
        return out
    pairs = goals.join(cyclic, "workflow", "left_semi").select("workflow", F.col("node").alias("before")).join(tips.distinct().select("workflow", F.col("node").alias("after")), "workflow")
    walked = walked_paths(commits.join(cyclic, "workflow", "left_semi"), pairs)
    walked = walked.select("workflow", "before", "after", F.size("path").cast("long").alias("distance")).where("distance > 0")
    walked = walked.withColumn("best", F.min("distance").over(Window.partitionBy("workflow", "before"))).where("distance = best").drop("best")
    return out.unionByName(walked)


def known_attempt(attempt: Column) -> Column:
    """An attempt from one on, else null: unknown."""
    return F.when(attempt >= 1, attempt)


def next_runs(failures: DataFrame, runs: DataFrame, nearest: DataFrame, *kept: str) -> DataFrame:
    """(run_id, next_run_id, distance; if columns of the failures are ``kept``, next_revision and these): for each failed
    run the next of its workflow: another run at the same revision with a later attempt first, where an unknown attempt on
    either side counts as later; else a run at the nearest descendant revision. Ties by attempt (unknown first) and run id; missing workflows or revisions are one of their kind.

    ``failures`` are rows of ``runs``; ``nearest``: workflow, before, after, distance (commits on the unique path). Runs
    of a revision meet as attempts, combined before the shuffle, never as pairs.
    """
    f = failures.select("workflow", F.col("revision").alias("before"), known_attempt(F.col("attempt")).alias("attempt0"), F.col("run_id").alias("failed_run"), *(F.col(n).alias(f"kept_{n}") for n in kept))
    r = runs.select(F.col("workflow").alias("w"), F.col("revision").alias("after"), known_attempt(F.col("attempt")).alias("attempt"), "run_id")
    candidate = lambda kind, far, run: F.struct(F.lit(kind).alias("kind"), far.cast("long").alias("far"), run.alias("run_id"))
    group = ["w", "after"]
    ranked = r.repartition(*group).withColumn("place", F.dense_rank().over(Window.partitionBy(*group, "attempt").orderBy(F.col("run_id").asc_nulls_last()))).where("place <= 2")
    first = ranked.groupBy(*group, "attempt").agg(F.min("run_id").alias("run_id"), F.max(F.when(F.col("place") == 2, F.col("run_id"))).alias("second"))
    whole, unknown = Window.partitionBy(*group), F.col("attempt").isNull()
    # The attempt after the unknown ones, which come first, is the lowest.
    after_it = F.lead(candidate(0, F.col("attempt"), F.col("run_id"))).over(whole.orderBy(F.col("attempt").asc_nulls_first()))
    first = cut(first.withColumns({"u1": F.min(F.when(unknown, F.col("run_id"))).over(whole), "u2": F.min(F.when(unknown, F.col("second"))).over(whole), "next": after_it}))
    rows = f.join(first.drop("run_id", "second"), F.col("workflow").eqNullSafe(F.col("w")) & F.col("before").eqNullSafe(F.col("after")) & F.col("attempt0").eqNullSafe(F.col("attempt")), "left")
    other = F.when(F.col("u1") != F.col("failed_run"), F.col("u1")).otherwise(F.col("u2"))
    same = F.when(other.isNotNull(), candidate(0, F.lit(0), other)).otherwise(F.col("next"))
    near = nearest.where("distance > 0").join(first.groupBy(F.col("w").alias("workflow"), "after").agg(F.min("run_id").alias("run_id")), ["workflow", "after"])
    near = near.groupBy("workflow", "before").agg(F.min(F.struct(candidate(1, F.col("distance"), F.col("run_id")).alias("c"), "after")).alias("near"))
    best = rows.select("workflow", "before", "failed_run", same.alias("same"), *(f"kept_{n}" for n in kept)).join(near, ["workflow", "before"], "left").withColumn("c", F.coalesce("same", "near.c")).where("c is not null")
    at = F.when(F.col("c.kind") == 0, F.col("before")).otherwise(F.col("near.after"))
    more = (at.alias("next_revision"), *(F.col(f"kept_{n}").alias(n) for n in kept)) if kept else ()
    return best.select(F.col("failed_run").alias("run_id"), F.col("c.run_id").alias("next_run_id"), F.when(F.col("c.kind") == 0, F.lit(0).cast("long")).otherwise(F.col("c.far")).alias("distance"), *more)


def strings(*pairs: tuple[Column, str]) -> Column:
    """The texts whose condition holds, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for c, t in pairs)))))


def equivalence(pairs: DataFrame) -> DataFrame:
    """``pairs`` with equivalence_reasons, equivalent and completeness of the validation after a repair.

    Columns: before_workflow, after_workflow, before_job, after_job (null: removed), before_steps, after_steps
    (arrays of names), step_skipped, workflow_changed, environment_changed, weakening (array).
    """
    c = F.col
    gone = c("after_job").isNull()
    named = (F.size("before_steps") > 0) & (F.size("after_steps") > 0)
    contract = ~gone & ((named & (c("before_steps") != c("after_steps"))) | F.coalesce(c("step_skipped"), F.lit(False)))
    # The names of the reasons.
    reasons = strings(
        (~c("before_workflow").eqNullSafe(c("after_workflow")), "workflow_identity_changed"),
        (gone, "job_removed"),
        (~gone & (c("before_job") != c("after_job")), "job_semantics_changed"),
        (c("workflow_changed"), "workflow_definition_changed"),
        (c("environment_changed"), "material_environment_change_unaccounted"),
        (contract, "validation_contract_changed"),
    )
    reasons = F.array_sort(F.array_union(reasons, F.coalesce("weakening", F.array().cast("array<string>"))))
    partial = F.when(~gone & ~contract & ~named, 15).otherwise(0)
    out = pairs.withColumn("equivalence_reasons", reasons).withColumn("equivalent", F.size("equivalence_reasons") == 0)
    return out.withColumn("completeness", F.greatest(F.lit(0), F.lit(100) - partial - F.when(c("equivalent"), 0).otherwise(35)))


def confounders(rows: DataFrame) -> DataFrame:
    """``rows`` with the sorted set of what else may explain the change of result."""
    c = F.col
    # The names of the confounders.
    found = strings(
        (c("change_count") > 1, "multiple_commits_between_failure_and_success"),
        (c("before_failure_count") > 1, "multiple_failure_fingerprints"),
        (c("same_revision"), "rerun_without_code_change"),
        (c("lockfile_changed"), "dependency_lockfile_change"),
        (c("workflow_changed"), "workflow_definition_change"),
        (c("environment_changed"), "environment_change"),
        (c("test_changed"), "test_change"),
        (c("is_merge"), "merge_commit"),
        (c("attempt_history_missing"), "provider_missing_attempt_history"),
        ((c("before_conclusion") == "cancelled") | (c("after_conclusion") == "cancelled"), "concurrency_cancellation"),
    )
    extra = F.coalesce("extra_confounders", F.array().cast("array<string>"))
    return rows.withColumn("confounders", F.array_sort(F.array_union(found, extra)))


#: Confounders that limit the attribution of an otherwise clean transition.
MATERIAL = ("multiple_commits_between_failure_and_success", "multiple_failure_fingerprints", "dependency_lockfile_change", "workflow_definition_change", "environment_change", "test_change", "base_branch_update", "merge_commit", "squash_merge", "force_updated_pr_branch", "concurrency_cancellation", "provider_missing_attempt_history")


def attribution(rows: DataFrame) -> DataFrame:
    """``rows`` (with equivalence and confounders) with grade, attribution_class, outcome, evidence_completeness and
    limitations; confounders gain what the case itself shows.

    The first case that holds decides: a rerun that passes, no equivalent validation, no intervention on record,
    no result; then the result names the outcome, and reruns and material confounders cap the grade. Flaky
    workflows (flake_class other than none) lose a clean result afterwards.
    """
    c = F.col
    result, same = c("target_conclusion"), c("same_revision")
    missing = F.array_contains("confounders", "intervention_evidence_missing") | (~same & ((c("change_count") == 0) | F.coalesce(c("empty_change"), F.lit(False))))
    outcome = (
        F.when(c("target_failure_present"), "repeated_failure")
        .when((c("new_failure_count") > 0) | c("other_failure"), "new_failure")
        .when(result == "success", "clean_verified")
        .when(result == "failure", "partial_resolution")
        .otherwise("outcome_unknown")
    )
    material = F.arrays_overlap("confounders", F.array(*map(F.lit, MATERIAL))) | (c("change_count") > 1)
    case = (
        F.when(same & (result == "success"), "rerun_passed")
        .when(~c("equivalent"), "not_equivalent")
        .when(missing, "no_intervention")
        .when(result.isNull() | result.isin("cancelled", "timed_out", "skipped"), "no_result")
        .when(same, "rerun")
        .when(material, "confounded")
        .otherwise("direct")
    )
    out = rows.withColumn("case", case).withColumn("raw_outcome", outcome)
    cap = {"rerun_passed": 70, "not_equivalent": 50, "no_intervention": 50, "no_result": 60, "rerun": 75, "confounded": 85, "direct": 100}
    pick = lambda values: F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), c("case"))
    grade = pick({"rerun_passed": "C", "not_equivalent": "U", "no_intervention": "U", "no_result": "U", "rerun": "C", "confounded": "C", "direct": "B"})
    kind = pick({k: "unresolved" if k in ("not_equivalent", "no_intervention", "no_result") else "direct_transition_verified" if k == "direct" else "transition_inferred" for k in cap})
    final = (
        F.when(c("case").isin("rerun_passed", "not_equivalent", "no_intervention"), "outcome_unknown")
        .when(c("case") == "no_result", "unresolved")
        .when((c("case") == "rerun") & (c("raw_outcome") == "clean_verified"), "outcome_unknown")
        .otherwise(c("raw_outcome"))
    )
    # What a case adds to the confounders, and why it limits the attribution.
    adds = {"rerun_passed": ("flaky_failure_pattern", "rerun_without_code_change"), "no_intervention": ("intervention_evidence_missing",), "rerun": ("rerun_without_code_change",)}
    why = {"rerun_passed": "same revision fail/pass cannot receive repair credit", "no_intervention": "revision changed without complete intervention evidence", "no_result": "validation_outcome_unavailable", "rerun": "rerun without revision change carries no repair credit", "confounded": "material confounders cap attribution strength"}
    none = F.array().cast("array<string>")
    by_case = lambda values, default: F.coalesce(*(F.when(c("case") == k, F.array(*map(F.lit, v))) for k, v in values.items()), default)
    unproved = F.array_sort(F.array_union("equivalence_reasons", F.array(F.lit("validation_equivalence_not_proved"))))
    reasons = F.when(c("case") == "not_equivalent", unproved).otherwise(by_case({k: (v,) for k, v in why.items()}, none))
    out = out.withColumns({"grade": grade, "attribution_class": kind, "outcome": final, "evidence_completeness": F.least("completeness", pick(cap)), "suspected_flake": c("case") == "rerun_passed", "limitations": reasons, "confounders": F.array_sort(F.array_union("confounders", by_case(adds, none)))})
    flaky = (F.coalesce("flake_class", F.lit("none")) != "none") & (c("outcome") == "clean_verified")
    also = lambda name, text: F.when(flaky, F.array_sort(F.array_union(name, F.array(F.lit(text))))).otherwise(c(name))
    return out.withColumns({
        "grade": F.when(flaky, "U").otherwise(c("grade")),
        "attribution_class": F.when(flaky, "unresolved").otherwise(c("attribution_class")),
        "evidence_completeness": F.when(flaky, F.least(F.lit(50), c("evidence_completeness"))).otherwise(c("evidence_completeness")),
        "suspected_flake": c("suspected_flake") | flaky,
        "confounders": also("confounders", "verified_flaky_failure"),
        "limitations": also("limitations", "verified flaky failure cannot receive repair credit"),
        "outcome": F.when(flaky, "outcome_unknown").otherwise(c("outcome")),
    }).drop("case", "raw_outcome")


def strength(grade: Column) -> Column:
    return F.when(grade.isin("A", "B"), "strong").when(grade == "C", "moderate").when(grade == "D", "weak").otherwise("unknown")


def episode_events(episodes: DataFrame) -> DataFrame:
    """Three chained events per episode: the failure, the repair that has it as parent, and the verification."""
    kinds = F.array(*(F.struct(F.lit(k).alias("step"), F.lit(name).alias("observation_kind")) for k, name in enumerate(("failure", "repair", "verification"))))
    rows = episodes.select("*", F.explode(kinds).alias("k")).select("*", "k.*").drop("k")
    name = lambda step: F.concat("episode_id", F.lit(":"), step.cast("string"))
    return rows.withColumn("event_id", name(F.col("step"))).withColumn("parent_event_id", F.when(F.col("step") > 0, name(F.col("step") - 1)))


def graph(runs: DataFrame, commits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed vertices (type, id) and edges (type, source, target) of the evidence graph, each once."""
    node = lambda kind, c: F.struct(F.lit(kind).alias("type"), c.cast("string").alias("id"))
    nodes = runs.select(F.explode(F.array(node("run", F.col("run_id")), node("workflow", F.col("workflow")), node("revision", F.col("revision")))).alias("n")).select("n.*")
    nodes = nodes.unionByName(commits.select(node("revision", F.col("revision")).alias("n")).select("n.*")).distinct()
    edge = lambda kind, a, b: F.struct(F.lit(kind).alias("type"), a.cast("string").alias("source"), b.cast("string").alias("target"))
    edges = runs.select(F.explode(F.array(edge("executes", F.col("run_id"), F.col("workflow")), edge("tests", F.col("run_id"), F.col("revision")))).alias("e")).select("e.*")
    edges = edges.unionByName(commits.where("parent is not null").select(edge("parent", F.col("revision"), F.col("parent")).alias("e")).select("e.*")).distinct()
    return nodes, edges


def graph_digest(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(row_count, digest) of an evidence graph, by a hash tree over its vertices and edges."""
    rows = nodes.select(F.to_json(F.struct("type", "id")).alias("row")).unionByName(edges.select(F.to_json(F.struct("type", "source", "target")).alias("row")))
    return tree_digest(rows, "row")


# What kind of change a path stands for, and added lines that skip a validation.
WORKFLOW_PATH = r"^\.github/workflows/"
TEST_PATH = r"(?i)^tests/|/tests/|_test\.py$|^test_"
ENVIRONMENT_PATH = r"(?i)(^|/)(pyproject\.toml|poetry\.lock|uv\.lock|package-lock\.json|pnpm-lock\.yaml|yarn\.lock|requirements\.txt|dockerfile|requirements-[^/]*)$"
LOCK_PATH = r"(?i)(\.lock|(^|/)(package-lock\.json|pnpm-lock\.yaml|yarn\.lock))$"
SKIP_MARKERS = ("pytest.mark.skip", "pytest.mark.xfail", "pytest.skip(", "unittest.skip", "skiptests(", "if: false", "if: ${{ false }}")


def change_flags(files: Column) -> dict[str, Column]:
    """What a change touches and how it weakens checks, from its files (array of path, status, patch; null: not observed)."""
    seen = F.coalesce(files, F.array().cast("array<struct<path:string,status:string,patch:string>>"))
    touches = lambda pattern: F.exists(seen, lambda f: f["path"].rlike(pattern))
    removed = F.exists(seen, lambda f: (f["status"] == "removed") & (f["path"].rlike(TEST_PATH) | f["path"].rlike(WORKFLOW_PATH)))
    added = F.filter(F.flatten(F.transform(seen, lambda f: F.split(F.coalesce(f["patch"], F.lit("")), r"\r\n|\r|\n"))), lambda x: F.startswith(x, F.lit("+")) & ~F.startswith(x, F.lit("+++")))
    marked = lambda x: F.array(*(F.contains(F.lower(x), F.lit(m)) for m in SKIP_MARKERS))
    skips = F.exists(added, lambda x: F.array_contains(marked(x), True))
    names = ((removed, "validation_file_removed"), (skips, "validation_skip_added"), (files.isNull(), "files_unobserved"))
    rows = F.array_sort(F.transform(seen, lambda f: F.struct(f["path"].alias("path"), F.coalesce(f["status"], F.lit("unknown")).alias("status"), f["patch"].alias("patch"))))
    document = F.transform(rows, lambda f: F.to_json(F.struct(f["patch"].alias("patch"), f["path"].alias("path"), f["status"].alias("status")), {"ignoreNullFields": "false"}))
    return {
        "file_count": F.size(seen), "workflow_changed": touches(WORKFLOW_PATH), "test_changed": touches(TEST_PATH), "environment_changed": touches(ENVIRONMENT_PATH),
        "lockfile_changed": touches(LOCK_PATH), "weakening": strings(*names), "change_fingerprint": F.sha2(F.concat(F.lit("["), F.array_join(document, ","), F.lit("]")), 256),
    }


def change_features(changes: DataFrame) -> DataFrame:
    """``changes`` with the flags of ``change_flags`` of their ``files``."""
    return changes.withColumns(change_flags(F.col("files")))


def normalized_runs(objects: DataFrame) -> DataFrame:
    """Typed runs from provider objects (JSON text): the execution is named by run and attempt, the workflow by path,
    else id, else name; blanks are null, attempts below one unknown."""
    get = lambda key: F.get_json_object("payload", f"$.{key}")
    text = lambda key: F.when(F.trim(get(key)) != "", get(key))
    attempt = F.when(get("run_attempt").cast("int") >= 1, get("run_attempt").cast("int"))
    return objects.select(
        text("id").alias("provider_run_ref"),
        F.concat(F.lit("run:"), text("id"), F.lit(":attempt:"), F.coalesce(attempt, F.lit(1)).cast("string")).alias("execution_ref"),
        text("head_sha").alias("revision"),
        F.coalesce(text("path"), text("workflow_id"), text("name")).alias("workflow_identity"),
        attempt.alias("attempt"), text("conclusion").alias("conclusion"),
    )


def hydrated(episodes: DataFrame, jobs: DataFrame, runs: DataFrame, commits: DataFrame) -> DataFrame:
    """Episodes with times: the failure's from its job, else its run; the repair's from its commit, else the run after."""
    job = jobs.select("job_ref", F.coalesce("completed_at", "started_at").alias("job_time"))
    run = runs.select("run_ref", F.coalesce("updated_at", "created_at").alias("run_time"))
    before, after = run.withColumnsRenamed({"run_ref": "before_run", "run_time": "before_time"}), run.withColumnsRenamed({"run_ref": "after_run", "run_time": "after_time"})
    out = episodes.join(job, "job_ref", "left").join(before, "before_run", "left").join(after, "after_run", "left").join(commits, "revision", "left")
    return out.select("episode_id", F.coalesce("job_time", "before_time").alias("failure_at"), F.coalesce("committed_at", "after_time").alias("repair_at"), F.col("after_time").alias("validated_at"))


RAN = ("success", "failure", "cancelled", "timed_out")


def step_became_skipped(before: Column, after: Column) -> Column:
    """Whether a step that ran before is skipped after, by name; of steps of one name the last counts."""
    last = lambda steps, name: F.try_element_at(F.filter(steps, lambda s: s["name"] == name), F.lit(-1))["state"]
    return F.exists(after, lambda s: (last(after, s["name"]) == "skipped") & F.coalesce(last(F.filter(before, lambda b: b["name"] == s["name"]), s["name"]).isin(*RAN), F.lit(False)))


def packed(name: Column) -> Column:
    """An observation's name as the bytes of its hash, half as long and in the same order; other texts stay as they are,
    and come first."""
    hashed = F.coalesce(name.rlike("^hno_[0-9a-f]{64}$"), F.lit(False))
    return F.struct(F.when(hashed, F.unhex(F.substring(name, 5, 64))).alias("hash"), F.when(~hashed, name).alias("text"))


def unpacked(name: Column) -> Column:
    return F.coalesce(F.concat(F.lit("hno_"), F.lower(F.hex(name["hash"]))), name["text"])


def episodes(seen: DataFrame) -> DataFrame:
    """Repair episodes from the observations of ``objects.normalized``, a scope (a pull request) at a time: each failure
    with the run after it, what changed on the path between, and what that proves.

    The failures of both runs are compared by semantic identity: whether the target is still there, how many others are
    new, how many there were before. Jobs are matched by name, steps by job, changes by the commits of the path; a commit
    on the path without a change is missing evidence. Failures without run, job, name or identity, and those with no run
    after them, give no episode.
    """
    c = F.col
    used = ("scope", "kind", "ref", "execution_ref", "revision", "workflow", "name", "attempt", "conclusion", "finished_at", "parents", "is_merge", "steps", "file_count", "workflow_changed", "test_changed", "environment_changed", "lockfile_changed", "weakening", "change_fingerprint", "semantic_identity")
    kinds = ("ci_execution", "ci_job", "failure", "commit", "change", "pull_request", "review_signal")
    gap = F.array_contains("limitations", "provider_attempt_history_missing")
    seen = cut(seen.where(c("kind").isin(*kinds)).select(*used, packed(c("observation_id")).alias("id"), F.when(c("kind") == "ci_execution", gap).alias("gap")))
    of = lambda kind: seen.where(c("kind") == kind)
    latest = lambda rows, keys, *values: rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "id").alias("x")).select(*keys, "x.*")
    lane = F.concat_ws("\0", "scope", "workflow")
    run = ["scope", "execution_ref"]
    runs = cut(latest(of("ci_execution").where("execution_ref is not null"), run, "revision", "workflow", "attempt", "conclusion", "finished_at", "gap"))
    as_runs = runs.select(lane.alias("workflow"), "revision", "attempt", F.concat_ws("\0", *run).alias("run_id"), "conclusion", c("finished_at").alias("updated_at"), *run, c("workflow").alias("named_workflow"), "gap")
    jobs = of("ci_job").select(*run, c("ref").alias("job_ref"), "name", "steps", "conclusion", "id")
    failures = of("failure").where("execution_ref is not null and ref is not null and name is not null and semantic_identity is not null")
    edges = cut(latest(of("commit").where("revision is not null"), ("scope", "revision"), "parents").select(c("scope").alias("workflow"), "revision", F.explode_outer("parents").alias("parent")))
    # Next runs, in lanes of scope and workflow; each lane has the commits of its scope.
    lanes = runs.select("scope", lane.alias("lane")).distinct()
    lane_edges = edges.join(lanes.withColumnRenamed("scope", "workflow"), "workflow").select(c("lane").alias("workflow"), "revision", "parent")
    failed = failures.select(*run).distinct().join(as_runs, run)
    near = nearest_descendants(lane_edges, failed.where("revision is not null"), as_runs.where("revision is not null"))
    pairs = next_runs(failed, as_runs, near, *run, "named_workflow", "revision", "conclusion", "gap").where("revision is not null and next_revision is not null")
    # A run's name begins with its scope.
    pairs = cut(pairs.select("scope", c("execution_ref").alias("before_execution_ref"), F.substr("next_run_id", F.length("scope") + 2).alias("after_execution_ref"), c("revision").alias("before_revision"), c("next_revision").alias("after_revision"), c("conclusion").alias("before_conclusion"), c("named_workflow").alias("before_workflow"), c("gap").alias("gap0")))
    # What changed on the way.
    ways = unique_paths(edges, pairs.select(c("scope").alias("workflow"), c("before_revision").alias("before"), c("after_revision").alias("after")))
    ways = cut(ways.select(c("workflow").alias("scope"), c("before").alias("before_revision"), c("after").alias("after_revision"), "path"))
    ends = ["scope", "before_revision", "after_revision"]
    flags = ("workflow_changed", "environment_changed", "test_changed", "lockfile_changed", "is_merge")
    changes = latest(of("change"), ("scope", "revision"), *flags, "file_count", "weakening", "change_fingerprint")
    steps = ways.select(*ends, F.posexplode("path").alias("place", "revision")).join(changes, ["scope", "revision"])
    made = F.transform(F.array_sort(F.collect_list(F.struct("place", "change_fingerprint"))), lambda x: x["change_fingerprint"])
    summed = steps.groupBy(*ends).agg(
        F.count(F.lit(1)).alias("change_count"), F.bool_or(c("file_count") == 0).alias("empty_change"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("weakening")))).alias("weakening"),
        F.sha2(F.concat(F.lit('["'), F.array_join(made, '","'), F.lit('"]')), 256).alias("change_fingerprint"), *(F.bool_or(f).alias(f) for f in flags))
    notes = seen.where("kind in ('pull_request', 'review_signal')").groupBy("scope").agg(
        F.bool_or((c("kind") == "review_signal") & (c("name") == "base_ref_changed")).alias("rebased"), F.bool_or((c("kind") == "review_signal") & (c("name") == "head_ref_force_pushed")).alias("forced"),
        F.bool_or((c("kind") == "pull_request") & (c("name") == "squash")).alias("squashed"), F.bool_or(c("kind") == "pull_request").alias("known"))
    classes = flake_classes(as_runs).select(c("workflow").alias("lane"), c("revision").alias("before_revision"), "flake_class")
    spots = runs.select("scope", lane.alias("lane"), c("revision").alias("before_revision")).distinct().join(classes, ["lane", "before_revision"], "left")
    spots = spots.join(notes.where("known"), "scope")  # without the pull request there is no context
    pairs = pairs.withColumn("lane", F.concat_ws("\0", "scope", "before_workflow")).join(spots, ["scope", "lane", "before_revision"]).drop("lane")
    pairs = pairs.join(ways.select(*ends, F.size("path").alias("way")).join(summed, ends, "left"), ends, "left")
    # Each failure with its job and the pair of its run, then with the jobs and failures of the run after. All that is told of
    # a run moves to one place once, where windows do what would be a join for each key.
    over = lambda value, *keys: value.over(Window.partitionBy(*run, *keys))
    only = lambda name: over(F.first(name, ignorenulls=True))
    together = lambda *parts: reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).repartition(*run)
    of_pair = [n for n in pairs.columns if n not in ("scope", "before_execution_ref", "after_execution_ref")]
    broke = failures.where("scope is not null").select(*run, c("ref").alias("job_ref"), "semantic_identity", F.struct("name", "id").alias("failure"))
    began = jobs.where("job_ref is not null").select(*run, "job_ref", F.struct("steps").alias("job"))
    paired = pairs.select("scope", c("before_execution_ref").alias("execution_ref"), F.struct("after_execution_ref", *of_pair).alias("pair"))
    rows = together(broke, began, paired).withColumns({
        "jobs": over(F.collect_list("job"), "job_ref"), "pair": only("pair"), "place": F.row_number().over(Window.partitionBy(*run, "semantic_identity").orderBy(c("failure").isNull())),
    }).withColumn("before_failure_count", over(F.count_if(c("failure").isNotNull() & (c("place") == 1)))).where("failure is not null and pair is not null")
    rows = rows.withColumn("job", F.explode("jobs"))
    first = F.struct(c("execution_ref").alias("before_execution_ref"), "job_ref", "failure.id", "before_failure_count", c("job.steps").alias("first_steps"), *(f"pair.{n}" for n in of_pair))
    rows = rows.select("scope", c("pair.after_execution_ref").alias("execution_ref"), "failure.name", "semantic_identity", first.alias("first"))
    ended = jobs.select(*run, "name", F.struct("steps", "conclusion", "name").alias("job"), "id")
    marks = failures.groupBy(*run, "semantic_identity").agg(F.count(F.lit(1)).alias("n"))
    rows = together(rows, ended, marks, runs.select(*run, F.struct("conclusion", "gap").alias("run"))).withColumns({
        "after_job": over(F.min_by("job", "id"), "name"), "same_failures": over(F.sum("n"), "semantic_identity"), "all_failures": over(F.sum("n")), "broken_jobs": over(F.count_if(c("job.conclusion") == "failure")), "run": only("run"),
    }).where("first is not null and run is not null")
    rows = rows.select("scope", c("execution_ref").alias("after_execution_ref"), "name", "semantic_identity", "after_job", "same_failures", "all_failures", "broken_jobs", c("run.conclusion").alias("after_conclusion"), c("run.gap").alias("gap1"), "first.*")
    no, none = F.lit(False), F.array().cast("array<string>")
    same = c("before_revision") == c("after_revision")
    way = F.coalesce("way", F.lit(0))
    names = lambda steps: F.transform(F.coalesce(steps, F.array().cast("array<struct<name:string,state:string>>")), lambda s: s["name"])
    other_broken = F.coalesce("broken_jobs", F.lit(0)) - F.when(c("after_job.conclusion") == "failure", 1).otherwise(0)
    rows = rows.withColumns({f: F.coalesce(f, no) for f in (*flags, "empty_change")} | {
        "change_count": F.coalesce("change_count", F.lit(0)), "weakening": F.coalesce("weakening", none), "same_revision": same, "after_workflow": c("before_workflow"), "before_job": c("name"),
        "target_failure_present": F.coalesce("same_failures", F.lit(0)) > 0, "new_failure_count": F.coalesce("all_failures", F.lit(0)) - F.coalesce("same_failures", F.lit(0)), "other_failure": other_broken > 0,
        "target_conclusion": c("after_job.conclusion"), "attempt_history_missing": F.coalesce("gap0", no) | F.coalesce("gap1", no), "before_steps": names(c("first_steps")), "after_steps": names(c("after_job.steps")),
        "step_skipped": F.coalesce(step_became_skipped(F.coalesce("first_steps", F.from_json(F.lit("[]"), "array<struct<name:string,state:string>>")), c("after_job.steps")), no),
    })
    rows = rows.withColumn("extra_confounders", strings((c("rebased"), "base_branch_update"), (c("forced"), "force_updated_pr_branch"), (c("squashed"), "squash_merge"), (c("change_count") != way, "intervention_evidence_missing")))
    rows = rows.withColumn("after_job", c("after_job.name"))
    # Only what is read below goes through the joins above and is written.
    needed = ("scope", "id", "before_execution_ref", "after_execution_ref", "job_ref", "name", "semantic_identity", "before_revision", "after_revision", "change_fingerprint", "before_workflow", "after_workflow", "before_job", "after_job", "before_steps", "after_steps", "step_skipped", "weakening", *flags, "empty_change", "change_count",
              "before_failure_count", "same_revision", "attempt_history_missing", "before_conclusion", "after_conclusion", "extra_confounders", "target_conclusion", "target_failure_present", "new_failure_count", "other_failure", "flake_class")
    out = attribution(confounders(equivalence(cut(rows.select(*needed)))))
    state = F.when(c("target_failure_present"), "present").when(c("after_job").isNotNull(), "absent").otherwise("unknown")
    out = out.withColumn("failure_after", state).withColumn("failure_id", unpacked(c("id")))
    shown = ("scope", "failure_id", "before_execution_ref", "after_execution_ref", "job_ref", "name", "semantic_identity", "before_revision", "after_revision", "change_count", "before_failure_count", "new_failure_count", "failure_after", "equivalent", "equivalence_reasons", "confounders", "limitations", "grade", "attribution_class", "outcome", "evidence_completeness", "suspected_flake", "flake_class", "change_fingerprint")
    return out.select(identity("hep_", {n: c(n).cast("string") for n in ("scope", "failure_id", "after_execution_ref", "outcome")}).alias("episode_id"), *shown)
