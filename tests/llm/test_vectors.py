import numpy as np

from quarry.llm import ann
from quarry.llm.nn_descent import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, v string, n long"


def table(n=600, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    x = rng.standard_normal((n, dim))
    x[:200] = centres[rng.integers(0, 12, 200)] + 0.08 * rng.standard_normal((200, dim))
    x[200:260] = centres[0] + 0.01 * rng.standard_normal((60, dim))
    x[260:330] = x[5]
    x = x.astype(np.float32)
    rows = [(i, [float(c) for c in v], "", 0) for i, v in enumerate(x)]
    odd = [(2000, None, "", 0), (2100, [0.0] * dim, "", 0), (2200, [float("nan")] * dim, "", 0), (2300, [None] * dim, "", 0),
           (2400, [float("inf")] + [1.0] * (dim - 1), "", 0), (2500, [], "", 0), (2600, [1.0, 2.0], "", 0), rows[7], (None, rows[3][1], "", 0)]
    return x.astype(np.float64), rows + odd


def test_nearest_against_brute_force(spark):
    x, rows = table()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=10, per_block=200).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(abs(s - d[i]) < 1e-12 for _, i, s in found) and [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hits += len(set(want) & {i for _, i, _ in found})
        if q in range(260, 330):
            assert [i for _, i, _ in found] == want
    assert hits >= 0.95 * 10 * len(got)
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def piece(x, projections=256, width=1.5, miss=0.02):
    lines, half = ann.frames(x.shape[1], projections), width / np.sqrt(x.shape[1])
    return ann.SortedLines(x, lines, ann.threshold(lines, half, miss), half)


def test_collisions_select_few_rows_and_keep_the_neighbours():
    """Random directions, the hardest case: two thirds of the rows were verified before."""
    x = np.random.default_rng(12).standard_normal((4096, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    queries = x[::64]
    d = np.sqrt(((queries[:, None] - x[None]) ** 2).sum(2))
    q, r = piece(x).search(queries, np.sort(d, axis=1)[:, 10])
    want = np.argsort(d, axis=1)[:, :11]
    found = set(zip(q.tolist(), r.tolist()))
    assert len(found) == len(q) <= 0.1 * d.size
    assert np.mean([(i, int(j)) in found for i, row in enumerate(want) for j in row]) >= 0.98


def test_no_collision_is_lost_by_counting_bit_strings():
    rng = np.random.default_rng(13)
    for n, dim, projections in ((1, 3, 4), (77, 5, 13), (1000, 24, 64)):
        x, queries = rng.standard_normal((n, dim)), rng.standard_normal((9, dim))
        index, radius = piece(x, projections), np.array([0.0, 0.1, 0.5, 1, 2, 3, 5, 50, np.inf])
        apart = np.abs((x @ index.lines)[None] - (queries @ index.lines)[:, None])
        sure = (apart <= radius[:, None, None] * index.half).sum(2) >= index.least
        got = np.zeros((9, n), bool)
        got[index.search(queries, radius)] = True
        assert (got | ~sure).all() and got[-2:].all()
    strings = [rng.integers(0, 2 ** 63, 20).astype(np.uint64) for _ in range(37)]
    ones = lambda s: np.unpackbits(s.view(np.uint8), bitorder="little").astype(int)
    assert (sum(ones(d) << i for i, d in enumerate(ann.added(strings))) == sum(ones(s) for s in strings)).all()


def test_nearest_over_many_blocks_with_bounds_from_a_part(spark):
    rng = np.random.default_rng(14)
    x = rng.standard_normal((5000, 24))
    x[1000:1400] = x[7] + 1e-3 * rng.standard_normal((400, 24))
    x[2000:3000] = x[9]
    x[4000] = 1e200
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 40 = 0"), k=10, per_block=700).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 5000, 40))
    hits = 0
    for q, found in got.items():
        with np.errstate(over="ignore"):
            d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and all(s == d[i] for _, i, s in found)
        if 2000 <= q < 3000:
            assert [i for _, i, _ in found] == want
        hits += len(set(want) & {i for _, i, _ in found})
    assert hits >= 0.99 * 10 * len(got)


def test_nearest_of_small_tables_and_of_ids_that_repeat(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)] + [(7, [1.0])], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(few, few, k=10).collect())
    assert got == [(q, n + 1, i, float(abs(i - q))) for q in range(5) for n, i in enumerate(sorted(set(range(5)) - {q}, key=lambda i: (abs(i - q), i)))]
    rng = np.random.default_rng(15)
    x = rng.standard_normal((3000, 8))
    x[1:30] = x[0] + np.repeat(np.eye(8) * 1e-3, 4, axis=0)[:29]  # ids 1 to 29, ten of which come twice at one distance
    ids = np.arange(3000)
    ids[1:21] = np.repeat(np.arange(1, 11), 2)
    ids[2990:] = 0
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], schema).repartition(3)
    d = np.sqrt(((x[None] - x[ids == 0][:, None]) ** 2).sum(2))
    want = sorted({(s, int(i)) for row in d for s, i in zip(row, ids) if i != 0})[:10]
    got = sorted((r["rank"], r.score, r.vec_id) for r in ann.nearest(df, df.filter("vec_id = 0"), k=10).collect())
    assert [(s, i) for _, s, i in got] == want


def test_links_and_components_against_brute_force(spark):
    x, rows = table()
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), k=6, leaf=16, per_block=50).collect()}
    assert len(got) == 607
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(link, root[None], len(x)).min(1, initial=len(x)))
        if (new == root).all():
            break
        root = new
    assert [got[i].n_links for i in range(600)] == link.sum(1).tolist()
    assert [got[i].component_id for i in range(600)] == root.tolist()
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert all(got[i].n_links == 0 and got[i].kept for i in (2000, 2100, 2200, 2300, 2400, 2500, 2600))
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def brute(x, least=0.9):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= least
    np.fill_diagonal(link, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(link, root[None], len(x)).min(1, initial=len(x)))
        if (new == root).all():
            return link.sum(1).tolist(), root.tolist()
        root = new


def test_links_between_groups_that_fill_their_own_lists(spark):
    rng = np.random.default_rng(8)
    dim, groups = 16, 3
    x = rng.standard_normal((150, dim))
    centre, other = np.eye(dim)[0], np.eye(dim)[1]
    for g in range(groups):  # 0.99 within a group, about 0.92 between neighbours in the chain
        angle = 0.4 * g
        at = np.cos(angle) * centre + np.sin(angle) * other
        x[20 * g:20 * g + 20] = at + 0.018 * rng.standard_normal((20, dim))
    want_links, want_root = brute(x)
    assert want_root[0] == want_root[20] == want_root[40] == 0
    df = spark.createDataFrame([(i, [float(c) for c in v], "", 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, v string, n long")
    got = {r.vec_id: r for r in near_duplicates(df, sample=1).collect()}
    assert [got[i].n_links for i in range(150)] == want_links
    assert [got[i].component_id for i in range(150)] == want_root


def test_rare_links_are_audited_and_a_failed_audit_compares_all(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 16))
    x[200:204] = x[:4] + 0.05 * rng.standard_normal((4, 16))  # four linked pairs in 400
    x[204:208] = 0.93 * x[200:204] / np.linalg.norm(x[200:204], axis=1, keepdims=True) + 0.09 * rng.standard_normal((4, 16))
    want_links, want_root = brute(x)
    assert 8 <= sum(n > 0 for n in want_links) < 20
    df = spark.createDataFrame([(i, [float(c) for c in v], "", 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, v string, n long")
    got = {r.vec_id: r for r in near_duplicates(df, trees=1, leaf=2, k=1, most_rounds=1, sample=1, per_block=100).collect()}
    assert [got[i].n_links for i in range(400)] == want_links
    assert [got[i].component_id for i in range(400)] == want_root


def test_audit_of_a_table_without_links_takes_a_bounded_number_of_jobs(spark):
    from pyspark.sql import functions as F

    from quarry.llm import nn_descent

    x = np.random.default_rng(10).standard_normal((20_000, 24))
    nodes = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "gid long, x array<double>").repartition(4).cache()
    none = spark.createDataFrame([], "u long, v long")
    roots, wanted = spark.createDataFrame([], "node long, component long"), spark.createDataFrame([], "component long")
    links = none.withColumn("s", F.lit(1.0))
    sc = spark.sparkContext
    nodes.count()
    sc.setJobGroup("audit", "audit")
    try:
        assert nn_descent._audit(nodes, 20_000, links, roots, wanted, 0.9, 512, 128, 2048, 0) == 1.0
        jobs = len(sc.statusTracker().getJobIdsForGroup("audit"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        nodes.unpersist()
    assert 0 < jobs <= 40


def test_saturated_lists_double_until_all_groups_are_joined(spark):
    """More linked groups around one than a list has places: added places fill up and double."""
    rng = np.random.default_rng(11)
    dim, groups, size = 32, 9, 8
    x = rng.standard_normal((120, dim))
    for g in range(groups):  # 0.99 within a group, about 0.93 between any two groups
        at = np.eye(dim)[0] + 0.27 * np.eye(dim)[g + 1]
        x[size * g:size * g + size] = at + 0.012 * rng.standard_normal((size, dim))
    want_links, want_root = brute(x)
    assert set(want_root[:groups * size]) == {0} and min(want_links[:groups * size]) >= size * (groups - 1)
    df = spark.createDataFrame([(i, [float(c) for c in v], "", 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, v string, n long")
    got = {r.vec_id: r for r in near_duplicates(df, k=5, leaf=16).collect()}
    assert [got[i].n_links for i in range(120)] == want_links
    assert [got[i].component_id for i in range(120)] == want_root


def test_files_of_steps_that_ended_are_deleted(spark):
    """Shuffle files and intermediate tables of all rounds stayed on disk: over 100 times the vectors."""
    import gc
    import os

    x, rows = table(300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2).cache()
    df.count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles().toList()  # one look: others may delete files meanwhile
        return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().endswith(".data"))

    top = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")

    def kept():
        return {f"{d}/{f}": os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(top) for f in names if not f.endswith(".crc")}

    shuffle, files = shuffled(), set(kept())
    out = near_duplicates(df, k=6, leaf=16, per_block=50)
    assert shuffled() <= shuffle
    left = {f: n for f, n in kept().items() if f not in files and "/nn-" in f}
    assert left and sum(left.values()) < 300 * 16 * 8
    assert not [f for f in kept() if f not in files and "/nn-" not in f and os.path.getsize(f) > 300 * 16 * 8]
    assert out.count() == len({r[0] for r in rows} - {None})
    df.unpersist()


def test_passes_change_no_list_and_no_count(spark):
    from quarry.llm import nn_descent

    rng = np.random.default_rng(21)
    x = rng.standard_normal((240, 12))
    x[:150] = x[0] + 0.05 * rng.standard_normal((150, 12))
    shelf = nn_descent.Shelf(spark)
    nodes = spark.createDataFrame([(i, 1 + i % 3, [float(c) for c in v], i) for i, v in enumerate(x)], "gid long, n long, x array<double>, own long")
    lists = shelf.put("start", nn_descent._leaves(shelf, "lists", nodes, 240, 2, 16, 5))
    once = nn_descent._refine(shelf, "once", lists, nodes, 240, 5)
    passes = nn_descent._refine(shelf, "passes", lists, nodes, 240, 5, sent=300)
    assert sorted((r.u, r.v) for r in once.collect()) == sorted((r.u, r.v) for r in passes.collect())
    roots = spark.createDataFrame([(i, 0 if i < 150 else 150) for i in range(240)], "node long, component long")
    wanted = roots.select("component").distinct()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    link[:150, 150:] = link[150:, :150] = False
    want = (link @ (1 + np.arange(240) % 3)).tolist()
    for sent in (None, 500):
        got = nn_descent._component_counts(shelf, nodes, 240, roots, wanted, 40, 0.9, sent=sent)
        assert [n for _, n in sorted((r.u, r.links) for r in got.collect())] == want
