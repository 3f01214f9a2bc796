import numpy as np
import pytest

from ordermill.llm import covertree

ROWS = "vec_id long, embedding array<float>, label int, n_links string, node int"


def plain(rows):
    ok = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(np.array(v)):
            x = np.array(v, np.float64)
            ok[i] = x / np.sqrt(x @ x)
    links = {i: set() for i, _ in rows}
    for i, x in ok.items():
        links[i] = {j for j, y in ok.items() if j != i and len(x) == len(y) and x @ y >= 0.95}
    root = {}
    for i, _ in sorted(rows):
        if i not in root:
            group, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            root |= dict.fromkeys(group, min(group))
    return {i: (len(links[i]), root[i], root[i] == i) for i, _ in rows}


def vectors(seed, n, dim=24):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    # Clusters of copies, of near copies, and chains whose ends are far apart.
    x[10:60] = x[10] + 0.13 * np.linalg.norm(x[10]) / np.sqrt(dim) * r.normal(size=(50, dim))
    x[60:140] = x[60] + 0.3 * np.linalg.norm(x[60]) / np.sqrt(dim) * r.normal(size=(80, dim))
    x[140:160] = x[140]
    for i in range(161, 200):
        x[i] = x[i - 1] + 0.25 * np.linalg.norm(x[i - 1]) / np.sqrt(dim) * r.normal(size=dim)
    return x.astype(np.float32)


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_links_equal_brute_force(spark, block_rows):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors(3, 400))]
    odd = [None, [], [0.0] * 24, [1.0] * 23 + [None], [float("nan")] * 24, [float("inf")] * 24, [1.0] * 3, [2.0] * 3, [1e-30] * 24, [3e30] * 24]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], ROWS).repartition(4)
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in covertree.near_duplicates(df, block_rows=block_rows).collect()}
    # float32 values, as the column stores them
    expected = plain([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    assert found == expected


def test_traversal_equals_all_pairs():
    x, y = (vectors(s, 300).astype(float) for s in (5, 6))
    y[:100] = x[:100] + 0.01
    a, b = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    ones = np.ones(300, np.int64)
    links = covertree.Links(600)
    ta, tb = covertree.CoverTree(a, ones), covertree.CoverTree(b, ones)
    assert len(ta.levels) > 1
    covertree.traverse(ta, tb, links, 0, 300)
    near = a @ b.T >= 0.95
    assert (links.count[:300] == near.sum(axis=1)).all() and (links.count[300:] == near.sum(axis=0)).all()
    own = covertree.Links(300)
    covertree.traverse(ta, ta, own, 0, 0)
    assert (own.count == (a @ a.T >= 0.95).sum(axis=1) - 1).all()


@pytest.mark.parametrize("many_open", [0, 4, 64])
def test_nested_clusters_in_one_tree(monkeypatch, many_open):
    monkeypatch.setattr(covertree, "_MANY_OPEN", many_open)
    r = np.random.default_rng(8)

    def around(points, n, far):
        step = r.normal(size=(len(points) * n, 32))
        return np.repeat(points, n, axis=0) + far * step / np.linalg.norm(step, axis=1)[:, None]

    # One cluster within the widest radius, in it some of half and quarter width, and their points.
    points = around(around(around(np.ones((1, 32)) / np.sqrt(32), 8, 0.5), 12, 0.3), 10, 0.12)
    points = points[r.permutation(len(points))]
    points /= np.linalg.norm(points, axis=1)[:, None]
    weights = r.integers(1, 4, len(points))
    tree = covertree.CoverTree(points, weights)
    assert len(tree.levels) > 2
    near = points @ points.T >= 0.95
    np.fill_diagonal(near, False)
    links = covertree.Links(len(points))
    covertree.traverse(tree, tree, links, 0, 0)
    assert (links.count == near @ weights).all()
    x, y = np.nonzero(near)
    assert (links.root[x] == links.root[y]).all()


@pytest.mark.parametrize("far", [0.16, 0.22, 0.25])
def test_crowded_blocks(far):
    r = np.random.default_rng(12)
    middle = r.normal(size=64)
    points = np.concatenate([middle / np.linalg.norm(middle) + far / 8 * r.normal(size=(900, 64)), r.normal(size=(300, 64))])
    points = points[r.permutation(len(points))]
    points /= np.linalg.norm(points, axis=1)[:, None]
    weights = r.integers(1, 4, len(points))
    near = points @ points.T >= 0.95
    np.fill_diagonal(near, False)

    def check(links):
        assert (links.count == near @ weights).all()
        group = np.arange(len(points))
        for _ in range(len(points)):
            lowest = np.where(near, group, len(points)).min(axis=1)
            if (group <= lowest).all():
                break
            group = np.minimum(group, lowest)
        assert (links.root == group).all()

    whole, links = covertree.CoverTree(points, weights), covertree.Links(len(points))
    covertree.traverse(whole, whole, links, 0, 0)
    check(links)
    a, b = (covertree.CoverTree(points[s], weights[s]) for s in (slice(0, 500), slice(500, None)))
    links = covertree.Links(len(points))
    for x, y, from_x, from_y in ((a, a, 0, 0), (b, b, 500, 500), (a, b, 0, 500)):
        covertree.traverse(x, y, links, from_x, from_y)
    check(links)


def test_repeated_rows_null_ids_and_empty_table(spark):
    v = [1.0, 2.0]
    rows = [(5, v), (5, v), (None, v), (7, [2.0, 4.0]), (None, [-1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(str, (tuple(r) for r in covertree.near_duplicates(df).collect())))
    assert found == sorted(map(str, [(5, 3, 5, True)] * 2 + [(None, 3, 5, False), (7, 3, 5, False), (None, 0, None, True)]))
    assert covertree.near_duplicates(df.limit(0)).collect() == []


def test_disk_grows_with_rows_and_not_with_meetings_of_blocks(spark):
    # Vectors in no order: all blocks meet, and every vector has to be compared with all blocks.
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 64)).astype(np.float32)
    x[1500:1600] = x[1500] + 0.1 * np.linalg.norm(x[1500]) / 8 * r.normal(size=(100, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").repartition(4)

    def on_disk():
        """Lengths of the files of Spark's own folder and of the checkpoint folder, by name."""
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        lengths = {files.apply(i).getPath(): files.apply(i).length() for i in range(files.size())}
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
        each = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
        while each.hasNext():
            file = each.next()
            lengths[file.getPath().toString()] = file.getLen()
        return lengths

    covertree.stored(df.limit(1))  # so that there is a checkpoint folder
    before = on_disk()
    found = {r["vec_id"]: r["n_links"] for r in covertree.near_duplicates(df, block_rows=100).collect()}
    written = sum(length for name, length in on_disk().items() if name not in before)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    assert [found[i] for i in range(len(x))] == ((unit @ unit.T >= 0.95).sum(axis=1) - 1).tolist()
    # Copies for each block would be 30 times the vectors and more; most of what is left doesn't depend on the rows.
    assert written < 16 * x.nbytes
