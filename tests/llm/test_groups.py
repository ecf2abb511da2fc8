"""Operators that compare documents, vectors or items, against brute force."""

import random
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from gridspark.llm import decontamination, minhash, multi_index, queries, suffix_array, suffix_dedup
from gridspark.llm import components as module
from gridspark.llm.components import components
from gridspark.llm.words import Words, overlap

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (300, 300)] + [(500, k) for k in range(501, 560)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(41), 100]} | {200: 200, 201: 200} | {i: 500 for i in range(500, 560)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limit", [0, 5, 1_000_000])
def test_components_in_tasks_and_in_rounds(spark, monkeypatch, limit):
    """The same whatever one task may hold; what one task can hold takes two writes, however long the chains are."""
    monkeypatch.setattr(module, "EDGES", limit)
    writes, real = [], module.cut
    monkeypatch.setattr(module, "cut", lambda df, tag: writes.append(tag) or real(df, tag))
    r = random.Random(3)
    chain = r.sample(range(1000, 1040), 40)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + list(zip(chain, chain[1:], strict=False)) + [(-5, 2**60), (2**60, 70), (70, 70)]
    forest = module.Forest(2000)
    place = {x: i for i, x in enumerate(sorted({x for e in edges if e[0] != e[1] for x in e}))}
    for a, b in edges:
        if a != b:
            forest.link(place[a], place[b])
    ids = sorted(place)
    table = spark.createDataFrame(edges * 2, "a long, b long").repartition(5)
    got = [tuple(x) for x in components(table).collect()]
    assert sorted(got) == [(x, ids[forest.root(place[x])]) for x in ids]
    assert limit < 100 or len(writes) == 2


def test_table_of_wanted_ids_takes_few_jobs(spark):
    """Its pieces come in one job, not in one for each partition."""
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    ids = spark.range(0, 200, 50).toDF("id")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("wanted", "wanted")
        out = minhash.texts_of(docs, ids)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("wanted")) < 10
        assert {0, 50, 100, 150} <= {r.id for r in out.collect()} and out.join(ids, "id", "left_anti").count() < 100
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    z = []
    for _ in range(60):
        u = rng.integers(1, 2**63, 40).astype(np.uint64)
        a = rng.integers(1, 12, 40)
        b = np.where(rng.random(40) < 0.6, a, rng.integers(1, 12, 40))
        j = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        s = minhash.signatures(np.concatenate([u, u]), np.repeat([0, 1], 40), np.concatenate([a, b]), 2)
        z.append(((s[0] == s[1]).mean() - j) / np.sqrt(j * (1 - j) / minhash.HASHES))
        order = np.argsort(u)
        assert abs(overlap((u[order], a[order]), (u[order], b[order])) - j) < 1e-12
    assert abs(np.mean(z)) < 0.5 and 0.6 < np.std(z) < 1.4


def test_near_duplicates(spark, rows):
    r = random.Random(2)
    base = rows[0][1].split()[:120]
    copies = [(10_000 + k, " ".join(w if r.random() > 0.01 else "zz" for w in base)) for k in range(40)]
    odd = [(20_000, None), (20_001, ""), (20_002, "..."), (20_003, "one two"), (20_004, "One, two."), (None, "one two"), (20_005, "w " * 20_000), (20_006, "w " * 20_001)]
    every = rows + copies + odd
    docs = spark.createDataFrame([(*x, "c") for x in [*every, copies[0]]], "doc_id long, text string, component_id string")
    got = minhash.near_duplicates(docs).collect()
    want = brute.near_components([x for x in every if x[0] is not None])
    assert {x.doc_id: x.component_id for x in got if x.doc_id is not None} == want
    assert len(got) == len(every) + 1 and all(x.kept == (x.doc_id == x.component_id) for x in got if x.doc_id is not None)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_tiles_of_a_crowd(spark, monkeypatch):
    """Members of different components are joined whatever tiles they are in, also where the centre is like neither."""
    monkeypatch.setattr(minhash, "TILE", 3)
    texts = {i: " ".join(f"w{i % 2}x{k}" for k in range(60)) + f" own{i}" for i in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rest = spark.createDataFrame([(0, 7, i, i, bytes([i % 2] * 8)) for i in range(20)], "band int, key long, id long, label long, places binary")
    got = {r.id: r.root for r in components(minhash.apart(docs, rest)).collect()}
    assert got == {i: i % 2 for i in range(20)}


def test_suffix_array():
    r = random.Random(3)
    text = np.frombuffer(bytes(r.choice(b"ab") for _ in range(1500)) + b"q" * 300, np.uint8)
    raw = text.tobytes()
    order = suffix_array.suffix_array(text)
    assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
    got = suffix_array.common_prefixes(text, order, 100)
    for k in range(1, len(raw), 7):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert got[k] == min(n, 100)


@pytest.mark.parametrize("limit", [1 << 20, 400])
def test_parts_of_a_shard_merge(limit):
    r = random.Random(4)
    base = bytes(r.choice(b"abcde ") for _ in range(700))
    for _ in range(8):
        segments = [bytes(r.choice(b"xyz") for _ in range(r.randrange(30))) + base[(a := r.randrange(500)) : a + r.randrange(100, 200)] + b"ab" * r.randrange(90) for _ in range(12)]
        place = np.array(r.sample(range(99), 12)) << 32
        starts = sorted((p + i, k, i) for k, (p, s) in enumerate(zip(place.tolist(), segments, strict=True)) for i in range(len(s) - 99))
        seen, marks = set(), [np.zeros(len(s), bool) for s in segments]
        for _, k, i in starts:
            marks[k][i] = (g := segments[k][i : i + 100]) in seen
            seen.add(g)
        got = suffix_dedup.repeats(np.array([len(s) for s in segments]), b"".join(segments), place, limit)
        assert (got == np.concatenate(marks)).all()


@pytest.mark.parametrize("limit", [1 << 20, 600, 150])
def test_only_parts_of_one_name_merge(limit):
    r = random.Random(6)
    segments, name = [], []
    for k in range(6):
        base = bytes(r.choice(b"abcde ") for _ in range(400))
        for _ in range(r.choice([1, 2, 9])):
            segments.append(base[(a := r.randrange(250)) : a + r.randrange(100, 150)])
            name.append(k)
    place = np.array(r.sample(range(99), len(segments))) << 32
    starts = sorted((p + i, k, i) for k, (p, s) in enumerate(zip(place.tolist(), segments, strict=True)) for i in range(len(s) - 99))
    seen, marks = set(), [np.zeros(len(s), bool) for s in segments]
    for _, k, i in starts:
        marks[k][i] = (g := segments[k][i : i + 100]) in seen
        seen.add(g)
    size = np.array([len(s) for s in segments])
    assert (suffix_dedup.repeats(size, b"".join(segments), place, limit, np.array(name, np.uint64)) == np.concatenate(marks)).all()


@pytest.mark.parametrize("alike", [1, 2])
def test_a_large_shard_takes_bounded_memory(alike):
    """Segments of 12 MB, of names that occur once or twice, are judged in parts."""
    r, n = np.random.default_rng(6), 40_000
    data = r.integers(97, 123, 300 * n // alike, np.uint8).tobytes()
    segments = [data[k * 300 : k * 300 + 300 - i] for k in range(n // alike) for i in range(alike)]
    name = np.repeat(np.arange(n // alike, dtype=np.uint64), alike)
    size = np.array([len(s) for s in segments], np.uint32)
    row = {"shard": 0, "name": name.tobytes(), "uid": np.arange(n).tobytes(), "start": np.zeros(n, np.uint32).tobytes(), "size": size.tobytes(), "bytes": b"".join(segments)}
    table = pa.Table.from_batches([suffix_dedup.batch_of([row], suffix_dedup.SEGMENTS)])
    tracemalloc.start()
    try:
        out = suffix_dedup.judge(1, types.SimpleNamespace(value=np.zeros(0, np.uint64)))(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(x) // 8 for x in out.column("uid").to_pylist()) == n - n // alike
    assert peak < 350e6, peak


def test_remove_repeats(spark, rows):
    line = "Mañana será otro día — " * 6
    odd = [(9_000, None), (9_001, ""), (9_002, "x" * 99), (9_003, "x" * 100), (9_004, "x" * 101), (9_005, line), (9_006, "é" + line + "ü"), (9_007, "ab" * 70), (9_008, rows[3][1] * 2)]
    every = rows + odd
    docs = spark.createDataFrame([(*x, 1) for x in every], "doc_id long, text string, n_bytes int")
    got = suffix_dedup.remove_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.without_repeats(every)
    assert {r.doc_id: r.kept_text for r in got}[9_003] == "x" * 100
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_rows_that_share_an_id(spark):
    text = "abcdefghij" * 15
    docs = spark.createDataFrame([(1, text), (1, text), (None, text + "!"), (2, "short")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect())
    assert [n for _, n in got].count(150) == 2 and got[-1] == (2, 0)
    assert got[0][1] < 150


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 8))
    x[100:180] = x[0] + 0.15 * rng.standard_normal((80, 8))
    x[180:200] = x[5] * 3
    rows = [(i, v.astype("float32").tolist(), i % 3 if i < 100 else 0) for i, v in enumerate(x)]
    rows += [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0), (903, [None] + [1.0] * 7, 0), (904, x[0].tolist(), None), (905, [], 0), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0), (908, [float("inf")] * 8, 0)]
    return rows


def test_near_vectors(spark, vectors, monkeypatch):
    monkeypatch.setattr(multi_index, "TILE", 16)
    df = spark.createDataFrame([(*v, "k") for v in vectors], "vec_id long, embedding array<float>, label int, kept string")
    good = {i: np.array(v, "float32").astype(float) for i, v, lab in vectors if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: lab for i, _, lab in vectors}
    near = {i: [j for j in good if j != i and label[i] == label[j] and len(good[i]) == len(good[j]) and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.93] for i in good}
    got = {r.vec_id: r for r in multi_index.near_vectors(df).collect()}
    for i, *_ in vectors:
        reach, todo = {i}, [i]
        while todo:
            todo += [j for j in near.get(todo.pop(), []) if j not in reach and not reach.add(j)]
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(near.get(i, [])), min(reach), i == min(reach))
    assert multi_index.near_vectors(df.limit(0)).count() == 0


def test_traversal_is_in_order_and_bounds_hold():
    rng = np.random.default_rng(7)
    a, b = rng.random(9), rng.random(7)
    seen = list(multi_index.traverse(a, b, 1.1))
    sums = [a[i] + b[j] for i, j in seen]
    assert sums == sorted(sums) and len(seen) == len(set(seen)) == (a[:, None] + b <= 1.1).sum()
    assert len(list(multi_index.traverse(a, b, float("inf")))) == 63


def near_pairs(rng, n, dim, cosine):
    """n unit vectors, and behind them as many at about the cosine."""
    x = multi_index.units(rng.standard_normal((n, dim)))
    turn = rng.standard_normal((n, dim))
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    return np.vstack([x, cosine * x + np.sqrt(1 - cosine**2) * multi_index.units(turn)])


def test_reach_covers_the_target_recall():
    rng = np.random.default_rng(12)
    x = near_pairs(rng, 4000, 64, 0.931)
    books = multi_index.codebook(x[:4000, :32], 32), multi_index.codebook(x[:4000, 32:], 32)
    most = multi_index.reach(x[:4000], books, 0.93, 0.999)
    d = multi_index.halves(x, books)
    home = [y.argmin(axis=1) for y in d]
    mine, theirs = [y[:4000] for y in d], [y[4000:] for y in d]
    found = np.minimum(multi_index.excess(mine, [h[4000:] for h in home]), multi_index.excess(theirs, [h[:4000] for h in home])) <= most
    assert found.mean() > 0.997 and multi_index.reach(x[:10], books, 0.93, 1.0) == np.inf
    visited = ((d[0] - d[0].min(axis=1, keepdims=True))[:200, home[0]] + (d[1] - d[1].min(axis=1, keepdims=True))[:200, home[1]] <= most).mean()
    assert visited < 1 / 3


@pytest.fixture(scope="module")
def linked(spark, tmp_path_factory):
    """embeddings with links, near and just at the least cosine, within labels and across them; and a hot label."""
    rng = np.random.default_rng(13)
    x = near_pairs(rng, 500, 64, 0.935)
    x = np.vstack([x, x[:100] + 0.01 * rng.standard_normal((100, 64)), np.repeat(x[:3], 30, axis=0), x[7] + 0.03 * rng.standard_normal((80, 64))])
    label = np.concatenate([np.arange(500) % 3, np.arange(500) % 3, np.arange(100) % 4, np.zeros(170)]).astype(int)
    rows = [(int(i), v.astype("float32").tolist(), int(k)) for i, v, k in zip(rng.permutation(len(x)), x, label, strict=True)]
    folder = str(tmp_path_factory.mktemp("linked"))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


def test_links_equal_the_sql(spark, linked):
    import duckdb

    duck = duckdb.connect()
    duck.sql(f"create view embeddings as from '{linked}/embeddings.parquet/*.parquet'")
    want = sorted(duck.sql(queries.SQL["op2_multi_index"]).fetchall())
    got = sorted(tuple(r) for r in queries.QUERIES["op2_multi_index"](spark, linked).select("vec_id", "n_links", "component_id", "kept").collect())
    assert sum(n for _, n, *_ in want) > 1000 and got == want


def test_rows_that_share_a_vec_id(spark):
    v, w = [1.0, 0.0, 0.2, 0.0], [0.0, 1.0, 0.0, 0.3]
    rows = [(1, v, 0), (1, w, 1), (3, [1.0, 0.01, 0.2, 0.0], 0), (1, v, 0), (5, w, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in multi_index.near_vectors(df).collect())
    assert got == [(1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (3, 2, 1, False), (5, 0, 5, True)]


def test_sketch_sums_weights_within_passages():
    r, n = np.random.default_rng(2), 40
    size = np.array([0, 3, 5, 12, 1, 0, 11])
    f, column, weight = r.integers(0, n, size.sum()), r.integers(0, decontamination.WIDE, n), r.integers(-9, 9, n).astype(float)
    want, first = np.zeros((n, decontamination.WIDE)), 0
    for m in size.tolist():
        for a in range(first, first + m, decontamination.BLOCK):
            passage = f[a : min(a + decontamination.BLOCK, first + m)]
            for i in passage:
                for j in passage:
                    want[i, column[j]] += weight[j]
        first += m
    got = np.zeros(want.size)
    decontamination.folded(f, size, column, weight, got)
    assert (got.reshape(want.shape) == want).all()


def test_projection_is_fitted_on_every_document(spark):
    """Each of 4000 documents has a word of its own; the projection knows all of them, however the rows are dealt."""
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (2, "red green blue")], "item_id long, text string")
    docs = spark.createDataFrame([(d, f"one own{d} red" if d % 3 else None if d % 2 else f"own{d}") for d in range(4000)], "doc_id long, text string")
    own = Words().hashes([f"own{d}" for d in range(4000) if d % 3 or not d % 2])[0]
    one, many = decontamination.fit(docs.coalesce(1), bench), decontamination.fit(docs.repartition(7), bench)
    assert np.abs(one.table[one.features.of(own)]).max(axis=1).min() > 0
    assert (one.table == many.table).all()


def test_longest_common_subsequence():
    r = random.Random(8)
    for _ in range(100):
        a, b = ([r.randrange(6) for _ in range(r.randrange(1, 40))] for _ in range(2))
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        assert decontamination.common_subsequence(masks, len(a), b) == brute.longest_common(a, b)


def test_decontamination(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    r = random.Random(9)
    items = {x.item_id: x.text for x in bench.collect()}
    clean = " ".join(docs.where("doc_id = 5").first().text.split()[:200])
    planted = []
    for k, (i, t) in enumerate(sorted(items.items())):
        words = [w for w in t.split() if r.random() > 0.1] if k % 2 else t.split()
        planted.append((100_000 + k, f"{clean} {' '.join(words)} {clean}", i))
    extra = spark.createDataFrame([p[:2] for p in planted] + [(-1, None), (-2, ""), (-3, "...")], "doc_id long, text string")
    found = {(x.doc_id, x.item_id) for x in decontamination.decontaminate(docs.union(extra), bench).collect()}
    hit = [(d, i) in found for d, _, i in planted]
    assert all(hit[0::2]) and sum(hit[1::2]) >= 0.9 * len(hit[1::2])
    assert not {d for d, _ in found} & {-1, -2, -3, 5}
    # every document that holds an item word for word, and no document that shares under half of one
    words = Words()
    plain = {x.doc_id: words.hashes([x.text])[0].tobytes() for x in docs.collect()}
    held = {(d, i) for i, t in items.items() for d, h in plain.items() if words.hashes([t])[0].tobytes() in h}
    assert held <= found and len({d for d, _ in found if d < 100_000} - {d for d, _ in held}) <= 2
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0
    assert decontamination.decontaminate(docs.limit(5), bench.limit(0)).count() == 0


def test_leaks_make_no_stop_words(spark):
    """An item in a third of the rows is found in each of them, whole or with words dropped, and so is one in two of few rows."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))
    items = [[word() for _ in range(40)] for _ in range(3)]
    items.append([*items[0][:25], *(word() for _ in range(15))])
    clean = lambda: [word() for _ in range(60)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    some, seldom = clean(), []
    rows, want = [], set()
    for d in range(300):
        if d % 3 == 0:
            rows.append((d, " ".join([*some, *items[0], *some])))
            want.add((d, 0))
        elif d in (1, 2):
            rows.append((d, " ".join([*clean(), *items[1], *clean()])))
            want.add((d, 1))
        elif d in (4, 5):
            left = [w for k, w in enumerate(items[0]) if k % 7 != 3]
            rows.append((d, " ".join([*clean(), *left, *clean()])))
            want.add((d, 0))
        else:
            seldom.append(d)
            rows.append((d, " ".join(clean())))
    schema = "doc_id long, text string"
    found = {(x.doc_id, x.item_id) for x in decontamination.decontaminate(spark.createDataFrame(rows, schema), bench).collect()}
    # item 3 has 25 of its 40 words from item 0, in order
    assert want <= found and {(d, i) for d, i in found if i != 3} == want and not {d for d, _ in found} & set(seldom)
    few = [x for x in rows if x[0] in (1, 2, 7, 8, 10)]
    assert {(x.doc_id, x.item_id) for x in decontamination.decontaminate(spark.createDataFrame(few, schema), bench).collect()} == {(1, 1), (2, 1)}
    short = spark.createDataFrame([(0, "Zq xv")], "item_id long, text string")
    assert {x.doc_id for x in decontamination.decontaminate(spark.createDataFrame([(d, "a zq, xv." if d % 2 else "a b") for d in range(100)], schema), short).collect()} == set(range(1, 100, 2))


def test_leaks_at_any_rate(spark):
    """One item word for word in 1 to all of 100 documents, each of 600 words of its own, and a single leak among long documents."""
    r = random.Random(14)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrst") for _ in range(6))
    item = [word() for _ in range(30)]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(word() for _ in range(30)))], "item_id long, text string")
    for n in (1, 11, 100):
        rows = [(d, " ".join([*(word() for _ in range(300)), *(item if d < n else []), *(word() for _ in range(300))])) for d in range(100)]
        found = {(x.doc_id, x.item_id) for x in decontamination.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
        assert found == {(d, 7) for d in range(n)}
    # every hashed feature is frequent
    rows = [(d, " ".join([*(word() for _ in range(20_000)), *([w for k, w in enumerate(item) if k % 6] if d == 3 else [])])) for d in range(30)]
    found = decontamination.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert [(x.doc_id, x.item_id) for x in found] == [(3, 7)] and found[0].cosine > 0


def test_retrieval_against_brute_force(spark):
    """Paraphrases with words dropped and replaced: what every place of every document holds of every item, by the plain subsequence."""
    r = random.Random(15)
    word = lambda: r.choice(vocabulary)
    vocabulary = ["".join(r.choice("abcdefghijklmno") for _ in range(r.randrange(3, 8))) for _ in range(3000)]
    items = {i: [word() for _ in range(r.randrange(20, 40))] for i in range(30)}
    rows = []
    for d in range(150):
        words = [word() for _ in range(80)]
        if d % 2:
            own, drop = items[d % 30], r.choice((0.05, 0.2, 0.3))
            words[40:40] = [w if r.random() > drop / 2 else word() for w in own if r.random() > drop / 2]
        rows.append((d, " ".join(words)))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    found = {(x.doc_id, x.item_id) for x in decontamination.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    best = {(d, i): max(brute.longest_common(t, x.split()[a : a + 2 * len(t)]) for a in range(0, 80, 10)) / len(t) for d, x in rows for i, t in items.items() if len(set(t) & set(x.split())) > 0.5 * len(t)}
    sure = {k for k, v in best.items() if v >= 0.66}
    assert len(sure) > 60 and len(sure - found) <= 0.1 * len(sure) and all(best.get(k, 0) >= 0.55 for k in found)


CLASH = "doc_id long, text string, lang string, n_chars long, uid string, block int, n_removed int, rejected boolean, ids string, __row int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, lang, None if t is None else len(t), f"u{k}", k, -1, None, "x", 5) for k, (i, t, lang) in enumerate(rows)], CLASH)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A small corpus with planted copies, leaks, repeats, clean rows, rows without id or text, and repeated ids."""
    r = random.Random(16)
    base = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").collect()]
    items = [x.text for x in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    clean = lambda n: " ".join(r.choice(words) for _ in range(n))
    words = sorted({w for _, t, lang in base if lang == "en" and t for w in t.lower().split() if w.isascii() and w.isalpha() and len(w) > 3})
    prose = [clean(120) for _ in range(6)]
    shared = clean(70)
    rows = [*base]
    rows += [(50_000, prose[0], "en"), (50_001, prose[0], "en"), (50_002, prose[0] + " " + clean(2), "en")]  # copies
    rows += [(50_010, f"{prose[1]} {items[0]} {clean(60)}", "en"), (50_011, prose[2], "en")]  # a leak, clean
    rows += [(50_020, f"{prose[3]} {shared}", "en"), (50_021, f"{prose[4]} {shared} {clean(30)}", "en")]  # a repeated passage
    rows += [(50_030, None, "en"), (50_031, "", "en"), (None, prose[5], "en"), (None, clean(90), "en"), (50_040, clean(100), "en"), (50_040, f"{clean(100)} {items[1]}", "en")]
    rows += [(50_050, same := clean(80), "en"), (50_050, same, "en")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    clashing(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_pipeline_against_brute_force(spark, corpus):
    """Each stage's rows from the rows of the stage before it, by plain code; the columns stay whatever their names."""
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [x.text for x in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    names = docs.columns
    before = [tuple(x) for x in docs.collect()]
    order = lambda x: (x[0] is not None, x[0] or 0)
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        after = [tuple(x) for x in docs.collect()]
        if name == "language_id":
            assert set(after) <= set(before) and all(any(c.isalpha() for c in x[1] or "") for x in after)
            assert {x[0] for x in before if x[0] and x[0] >= 50_000 and x[1]} == {x[0] for x in after if x[0] and x[0] >= 50_000}
        elif name == "minhash":
            root = brute.near_components([(k, x[1]) for k, x in enumerate(before)])
            groups = {}
            for k, x in enumerate(before):
                groups.setdefault(root[k], []).append(x)
            assert len(after) == len(groups) and set(after) <= set(before)
            left = {x[4] for x in after}
            for rows in groups.values():
                stays = [x for x in rows if x[4] in left]
                assert len(stays) == 1 and order(stays[0]) == min(map(order, rows))
        elif name == "suffix_dedup":
            assert sorted(x[4] for x in after) == sorted(x[4] for x in before)
            texts = {x[4]: x[1] for x in after}
            ids = [x[0] for x in before if x[0] is not None]
            rows = sorted(before, key=order)
            if len(ids) == len(set(ids)) == len(before):
                want = brute.without_repeats([(x[4], x[1]) for x in rows])
                assert {u: len(t.encode()) for u, t in texts.items()} == {u: n - gone for u, (n, gone, *_) in want.items()} or all(abs(len(texts[u].encode()) - n + gone) < 4 for u, (n, gone, *_) in want.items())
            assert all(x[3] == len(x[1]) for x in after)
        elif name == "decontamination":
            words = Words()
            held = lambda t: any(words.hashes([i])[0].tobytes() in words.hashes([t])[0].tobytes() for i in items)
            assert set(after) <= set(before) and not any(held(x[1]) for x in after)
            gone = set(before) - set(after)
            hs = [words.hashes([i])[0].tolist() for i in items]
            for x in gone:
                text = words.hashes([x[1]])[0].tolist()
                assert any(brute.longest_common(i, text) >= 0.6 * len(i) for i in hs)
            assert not {x[0] for x in gone} & {50_000, 50_011, 50_020, 50_021} and 50_040 in {x[0] for x in after}
        else:
            assert docs.columns == [*(c for c in names if c != "ids"), "n_tokens", "ids", "decoded"]
            assert len(after) == len(before) and all(r.decoded == r.text.replace("▁", " ") for r in docs.collect())
            break
        assert docs.columns == names and after
        before = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash", "suffix_dedup", "decontamination", "sentencepiece"]
    assert corpus_pipeline.run(spark, folder).count() == len(after)


def test_stages_on_odd_rows(spark, corpus):
    """Null and empty texts, repeated rows, an empty table, and no rows but such; defined results of each stage."""
    folder, _ = corpus
    odd = clashing(spark, [(1, None, None), (2, "", "en"), (2, "", "en"), (None, "... 12", None), (3, "w" * 30_000, "en")])
    left = {"language_id": 1, "minhash": 5, "suffix_dedup": 5, "decontamination": 5, "sentencepiece": 5}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, folder).count() == left[name] or name == "language_id"
        assert stage(spark, odd.limit(0), folder).count() == 0
    plain = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, plain, folder).columns == plain.columns


def test_frequent_strings_change_no_result(spark, rows, monkeypatch):
    """A passage in every document with other words around it: the frequent strings are found, and the bytes stay those of brute force."""
    monkeypatch.setattr(suffix_dedup, "OFTEN", 20)
    monkeypatch.setattr(suffix_dedup, "OFTEN_LEAST", 20)
    r = random.Random(17)
    note = "all rights reserved worldwide by the publisher and its many partners, no part may be copied without leave " * 2
    every = [(i, f"{t[: r.randrange(40, 400)]}{note}{t[-r.randrange(40, 400) :]}") for i, t in rows[:120] if t and len(t) > 900]
    docs = spark.createDataFrame(every, "doc_id long, text string")
    seen = docs.withColumn(suffix_dedup.UID, docs.doc_id)
    assert 20 < len(suffix_dedup.frequent(seen, 100_000)) < 2000
    got = suffix_dedup.remove_repeats(docs).collect()
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got} == brute.without_repeats(every)


def test_a_text_signs_the_same_in_any_company():
    r = random.Random(18)
    texts = [" ".join(r.choice("abcdefgh") * r.randrange(1, 4) for _ in range(r.randrange(5, 400))) for _ in range(60)]
    signed = lambda some: minhash.signed_apart(*minhash.multiset(*minhash.shingles(*Words().hashes(some))), len(some))
    whole = signed(texts)
    for k in (0, 7, 59):
        assert (signed([texts[k]])[0] == whole[k]).all()


def test_bags_equal_plain_overlaps():
    r = random.Random(19)
    texts = [" ".join(r.choice("abc") for _ in range(r.randrange(40))) for _ in range(30)] + ["", ""]
    bags = minhash.Bags.of(texts)
    s, of, c = minhash.multiset(*minhash.shingles(*Words().hashes(texts)))
    ends = np.searchsorted(of, np.arange(len(texts) + 1))
    bag = [(s[x:y], c[x:y]) for x, y in zip(ends, ends[1:], strict=False)]
    for k in range(len(texts)):
        others = [d for d in range(len(texts)) if d != k]
        assert np.allclose(bags.overlaps(k, others), [overlap(bag[k], bag[d]) for d in others])
    places = np.random.default_rng(1).integers(0, 3, (50, 128)).astype(np.uint8)
    assert all((minhash.equal_places(places, k) == (places == places[k]).sum(axis=1)).all() for k in range(50))


def test_words_against_a_plain_split():
    from gridspark.llm import words as module

    r = random.Random(20)
    texts = ["", "...", "A b", *("".join(r.choice("ab ,.é\n\t\u3000ß'1日-") for _ in range(r.randrange(80))) for _ in range(200))]
    plain = [[bare for w in t.lower().split() if (bare := "".join(module._ALNUM.findall(w)))] for t in texts]
    h, size = Words().hashes(texts)
    assert size.tolist() == [len(p) for p in plain]
    names = {}
    for x, w in zip(h.tolist(), [w for p in plain for w in p], strict=True):
        assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)


def test_queries_are_named():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 11))
