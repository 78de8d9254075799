"""Links of vectors against the whole product in plain numpy."""

import glob
import os

import numpy as np
import pytest

from legajo.llm import embeddings


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(8):
        base = rng.normal(size=48)
        spread = rng.choice([0.05, 0.15, 0.25])
        rows += [base * rng.uniform(0.1, 9) + spread * rng.normal(size=48) for _ in range(rng.integers(2, 40))]
    rows += list(rng.normal(size=(80, 48))) + [rows[0]] * 50
    # Doubles on either side of the threshold, to the last bits.
    for angle in (0.95 + 1e-12, 0.95 - 1e-12):
        a = np.zeros(48)
        a[0] = 1
        b = np.zeros(48)
        b[:2] = angle, np.sqrt(1 - angle**2)
        rows += [a * 10 + 0.0, b]
    return [r.tolist() for r in rows]


@pytest.mark.parametrize("block", [4096, 16])
def test_links_and_components(spark, block):
    given = vectors(block)
    odd = [None, [], [0.0] * 48, [float("nan")] + [1.0] * 47, [1.0, None], [float("inf")] * 48]
    rows = list(enumerate(given + odd))
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, weight int").repartition(4)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df, block=block).collect()}
    x = np.array(given)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    comp = np.arange(len(x))
    for _ in range(len(x)):
        comp = np.minimum(comp, np.where(link, comp, len(x)).min(1))
    assert len(got) == len(rows)
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (link[i].sum(), comp[i])
        assert got[i]["kept"] == (comp[i] == i)
    for i in range(len(x), len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_null_and_repeated_ids_and_shorter_vectors(spark):
    rows = [(None, [1.0, 0.0]), (4, [1.0]), (4, [2.0, 0.0, 0.0]), (7, [0.0, 1.0]), (None, [0.0, -1.0])]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"]) for r in got) == [(-1, 0), (-1, 2), (4, 2), (4, 2), (7, 0)]
    assert {r["component_id"] for r in got} == {None, 4, 7}
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vectors_are_not_copied_to_what_they_are_compared_with(spark):
    # Without structure nearly all of the 32 blocks are compared with all others.
    x = np.random.default_rng(3).normal(size=(2000, 64)).astype(np.float32)
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>").repartition(4)
    local = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    scratch = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")

    def used():
        files = [f for d in local for f in glob.glob(f"{d}/*/shuffle_*.data")] + glob.glob(f"{scratch}/**/*.parquet", recursive=True)
        return sum(os.path.getsize(f) for f in files)

    before = used()
    assert embeddings.near_duplicates(df, block=64).filter("n_links = 0").count() == 2000
    assert used() - before < 6 * x.nbytes


@pytest.mark.parametrize("threshold,spread", [(0.95, 0.03), (0.95, 0.3), (0.2, 0.3), (-0.5, 1.0)])
def test_links_of_two_strips_against_all_pairs(threshold, spread):
    # From hardly any to nearly all pairs of a block linked, with weights, in one strip and between two.
    rng = np.random.default_rng(11)
    x = (rng.normal(size=(6, 24))[rng.integers(0, 6, 900)] + spread * rng.normal(size=(900, 24))) * rng.uniform(0.1, 5, (900, 1))
    places, weights = embeddings.Places(embeddings._unit(x), threshold, 4), rng.integers(1, 5, 900)

    def strip(rows):
        blocks = embeddings._halved(places.of(embeddings._unit(x[rows])), 64)
        order, cuts = rows[np.concatenate(blocks)], np.cumsum([0, *map(len, blocks)])
        row = {"i_cuts": cuts.astype(np.int64).tobytes(), "i_given": x[order].tobytes(), "i_weights": weights[order].tobytes()}
        return order, embeddings._Strip(row, "i", places, "<f8", 24)

    (at, a), (other, b) = strip(np.arange(500)), strip(np.arange(500, 900))
    unit = embeddings._unit(x)
    for one, order, same in ((embeddings._Links(a, a, True, threshold), at, True), (embeddings._Links(a, b, False, threshold), np.r_[at, other], False)):
        link = np.einsum("ik,jk->ij", unit[order], unit[order]) >= threshold
        if not same:
            link[:500, :500] = link[500:, 500:] = False
        np.fill_diagonal(link, False)
        assert (one.n == (link * weights[order]).sum(1)).all()
        comp = np.arange(len(order))
        for _ in range(len(order)):
            comp = np.minimum(comp, np.where(link, comp, len(order)).min(1))
        assert len(set(zip(comp, one.low, strict=True))) == len(set(comp)) == len(set(one.low))


def test_equal_vectors_share_a_leaf():
    x = np.random.default_rng(4).normal(size=(3000, 16))
    places = embeddings.Places(embeddings._unit(x), 0.95, 64)
    whole = places.leaf(embeddings._unit(x))
    assert places.leaves == 64 and (np.bincount(whole, minlength=64) > 0).all()
    for size in (1, 7, 1500):
        assert (places.leaf(embeddings._unit(x[-size:])) == whole[-size:]).all()
