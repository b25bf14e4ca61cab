import random

from plumbline.llm import packing


def naive(sizes, sources, clusters, capacity):
    bins, out = [], []
    for s, a, b in zip(sizes, sources, clusters):
        fit = [(x["left"], i) for i, x in enumerate(bins) if x["left"] >= s and x["left"] > 0 and (a < 0 or a not in x["a"]) and (b < 0 or b not in x["b"])]
        if fit:
            i = min(fit)[1]
        else:
            bins.append({"left": capacity, "a": set(), "b": set()})
            i = len(bins) - 1
        out.append((i, capacity - bins[i]["left"]))
        bins[i]["left"] -= s
        bins[i]["a"].add(a)
        bins[i]["b"].add(b)
    return out


def test_best_fit_against_naive():
    r = random.Random(1)
    for _ in range(50):
        n = r.randint(0, 60)
        args = ([r.randint(0, 30) for _ in range(n)], [r.randint(-1, 5) for _ in range(n)], [r.randint(-1, 9) for _ in range(n)])
        assert packing.best_fit(*args, 40) == naive(*args, 40)


def test_pack_is_whole_and_without_conflicts(spark):
    r = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 17}", f"c{i % 40}", r.choice([0, 1, 50, 99, 100, 101, 250, 1000])) for i in range(600)]
    rows += [(None, None, None, None), (7, None, None, -4), (8, "hot", "c1", 20), (8, "hot", "c1", 20)]
    items = spark.createDataFrame([(*x, "extra") for x in rows], "id long, source string, cluster string, size long, bin_id string")
    got = packing.pack(items, capacity=100, group_rows=100).collect()
    assert sorted(x.id for x in got if x.part == 0 and x.id is not None) == sorted(x[0] for x in rows if x[0] is not None)
    assert sum(x["size"] for x in got) == sum(max(0, x[3] or 0) for x in rows)
    by = {i: (s, c) for i, s, c, _ in rows[:600]}
    bins = {}
    for x in got:
        bins.setdefault(x.bin_id, []).append(x)
    for parts in bins.values():
        assert sum(x["size"] for x in parts) <= 100
        parts = sorted(parts, key=lambda x: (x.start, x["size"]))
        assert all(a.start + a["size"] <= b.start for a, b in zip(parts, parts[1:]))
        known = [by[x.id] for x in parts if x.id is not None and x.id > 8]
        assert len({s for s, _ in known}) == len(known) == len({c for _, c in known})
    assert packing.pack(items.limit(0)).collect() == []
    assert sorted(map(str, packing.pack(items, 100, 100).collect())) == sorted(map(str, got))


def test_items_of(spark):
    docs = spark.createDataFrame([(1, "A b\n c", "s", 1), (2, " a B c ", "s", 1), (3, "", None, 1), (4, None, "t", 1)], "doc_id long, text string, source string, size int")
    got = {r.id: r for r in packing.items_of(docs).collect()}
    assert [got[i]["size"] for i in (1, 2, 3, 4)] == [3, 3, 0, 0] and got[1].cluster == got[2].cluster != got[3].cluster


def test_equal_rows_are_dealt_over_groups(spark):
    items = spark.createDataFrame([(7, "hot", "c", 10)] * 400, "id long, source string, cluster string, size long")
    got = packing.pack(items, capacity=100, group_rows=50).collect()
    groups = [x.bin_id >> 32 for x in got]
    assert len(got) == len({x.bin_id for x in got}) == 400 and len(set(groups)) == 8 and max(map(groups.count, set(groups))) < 90
