import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import embeddings, mixing, sharding
from ledgerloom.llm.common import components, dense_index, written


# connected components, numbering ----------------------------------------------------------------------------
def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(150)] + [(5000, 5000), (1, 0), (0, 1)]
    nodes = sorted({x for e in edges for x in e} | {7777})
    n = written(spark.createDataFrame([(x, -x) for x in nodes], "node long, least long"))
    got = {r.node: r.component for r in components(n, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[x] == (-200 if x <= 200 else -1149 if x < 2000 else -x) for x in nodes)
    assert components(n, spark.createDataFrame([], "a long, b long")).where("component <> least").count() == 0


def test_dense_index(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 5 > 0, F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"), (F.col("id") * 7919 % 1000).alias("v"))
    rows = dense_index(df, ["g"], [F.col("v").asc()], "i").collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.v):
        by.setdefault(r.g, []).append(r.i)
    assert len(rows) == 1000 and all(x == list(range(len(x))) for x in by.values())


# embeddings -------------------------------------------------------------------------------------------------
def brute_links(rows):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok(v) and lab is not None else None for _, v, lab in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], n[i], least[find(i)]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block, sifted", [(2048, 256), (40, 5)])
def test_embeddings_against_brute_force(spark, monkeypatch, block, sifted):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "SIFTED", sifted)
    rng = np.random.default_rng(11)
    rows = [rng.standard_normal(64) for _ in range(60)]
    centre = rng.standard_normal(64)
    rows += [centre + 0.12 * rng.standard_normal(64) for _ in range(150)]  # a dense group around the limit
    rows += [rows[3] * 2.5, rows[3], rows[3], rows[4] + 0.05 * rng.standard_normal(64)]
    data = [(i, [float(np.float32(x)) for x in v], int(i % 7 == 0)) for i, v in enumerate(rows)]
    data += [(900, None, 1), (901, [], 1), (902, [0.0] * 64, 1), (903, [float("nan")] + [1.0] * 63, 1), (904, [None] + [1.0] * 63, 1), (905, data[3][1], None), (906, [float("inf")] * 64, 1), (907, [1.0, 2.0], 1), (908, [1.0, 2.0], 1)]
    df = spark.createDataFrame([(*r, "x", 5) for r in data], "vec_id long, embedding array<float>, label int, copies string, uid int")
    out = embeddings.near_embeddings(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute_links(data))
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert embeddings.near_embeddings(df.limit(0)).count() == 0


def test_decoding_lists_every_filter():
    f = embeddings.Filters(16, 1 << 17, tables=2, passes=500, blocks=4)
    assert f.blocks == 4
    x = np.random.default_rng(0).standard_normal((3, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i, ids in enumerate(f.decode(x)):
        want = []
        for t, book in enumerate(f.codes):
            s = [x[i] @ c for c in book]
            total = s[0][:, None, None, None] + s[1][:, None, None] + s[2][:, None] + s[3]
            want += (t * f.total + np.nonzero(total.ravel() >= f.limit)[0]).tolist()
        assert abs(len(set(want) ^ set(ids.tolist()))) <= 1 and ids.tolist() == sorted(ids)


@pytest.mark.parametrize("dim, count", [(64, 65_537), (64, 1_000_000), (8, 1_000_000), (3, 1_000_000), (1, 1024)])
def test_embeddings_recall_of_many_filters(spark, monkeypatch, dim, count):
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((200, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((200, dim))
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-9)
    y = 0.9801 * x + np.sqrt(1 - 0.9801**2) * side if dim > 1 else 2 * x
    data = [(i, [float(np.float32(v)) for v in r], 1) for i, r in enumerate(np.vstack([x, y]))]
    monkeypatch.setattr(embeddings, "BUCKET", len(data) * embeddings.PASSES / count)  # as many filters as a label of count / 3
    out = embeddings.near_embeddings(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute_links(data))


@pytest.mark.parametrize("cosine", [0.0, 0.2, 0.5, 0.7])
def test_vectors_with_a_common_direction(cosine):
    """Vectors of a mean cosine: no link is lost, and candidates stay few."""
    rng = np.random.default_rng(13)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    m, n, k = unit(rng.standard_normal((1, 64))), 4000, 400
    y = rng.standard_normal((n, 64))
    x = unit(np.sqrt(cosine) * m + np.sqrt(1 - cosine) * unit(y - (y @ m.T) * m))
    side = rng.standard_normal((k, 64))
    near = 0.9801 * x[:k] + np.sqrt(1 - 0.9801**2) * unit(side - (side * x[:k]).sum(axis=1, keepdims=True) * x[:k])
    every = np.vstack([x, near])
    f = embeddings.Filters(64, 3 * len(every), embeddings.TABLES, embeddings.PASSES, embeddings.SPLIT, embeddings.LEAST)
    ids, sketches = f.both(every, np.tile(every.mean(axis=0), (len(every), 1)))
    assert all(np.intersect1d(ids[i], ids[n + i]).size for i in range(k))
    times = np.unique(np.concatenate(ids), return_counts=True)[1]
    assert (times * (times - 1) / 2).sum() < 0.2 * n * n / 2 and times.max() < 60


def test_a_dense_group_beside_its_mean(spark):
    rng = np.random.default_rng(14)
    centre = rng.standard_normal(64)
    rows = [centre + 0.1 * rng.standard_normal(64) for _ in range(160)] + [centre + 0.5 * rng.standard_normal(64) for _ in range(80)] + [rng.standard_normal(64) for _ in range(20)]
    data = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(rows)]
    out = embeddings.near_embeddings(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute_links(data))


# mixing -----------------------------------------------------------------------------------------------------
def slow_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        each = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * each > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else w[s] * each
        if not full:
            break
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def test_source_targets(spark):
    rng = np.random.default_rng(1)
    for k in range(4):
        sizes = {f"s{i}": int(rng.integers(0, 10 ** rng.integers(1, 6))) for i in range(9)} | {None: 50, "é": 7, "𝄞": 30}
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = slow_targets(sizes)
        assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in sizes)
    zero = mixing.source_targets(spark.createDataFrame([("a", 0)], "source string, source_size long")).first()
    assert zero.target == 0


def test_flight_keeps_the_constraints():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 500):
        p, x = rng.random(n), rng.integers(0, 200, n).astype(float)
        q = mixing.flight(p, x, rng.random(n))
        assert ((q > 0) & (q < 1)).sum() <= 2 and abs(q.sum() - p.sum()) < 1e-6 and abs((q * x).sum() - (p * x).sum()) < 1e-4 * max(1, x.max())
    tied = mixing.flight(np.full(30, 0.3), np.full(30, 5.0), rng.random(30))
    assert abs(tied.sum() - 9) < 1e-6
    draws = np.mean([mixing.flight(np.array([0.2, 0.5, 0.7, 0.4]), np.array([3.0, 1, 2, 8]), np.random.default_rng(i).random(4)) for i in range(3000)], axis=0)
    assert np.abs(draws - [0.2, 0.5, 0.7, 0.4]).max() < 0.03


def test_mix(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(n)), ["big", "big", "small", None][i % 4], "clash") for i, n in enumerate(rng.integers(0, 60, 1200))]
    rows += [(None, None, "small", "x"), (5, "a b", "small", "x"), (5, "a b", "small", "x"), (6, "", "void", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, p string")
    got = mixing.mix(df, chunk=50).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        s = by.setdefault(r.source, [0, r.source_size, r.target])
        s[0] += r.taken
    assert all(abs(t - target) <= 60 for t, _, target in by.values()) and by["void"] == [0, 0, 0.0]
    again = mixing.mix(df.repartition(7), chunk=50).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.text_hash, r.copies)
    assert sorted(got, key=key) == sorted(again, key=key)
    assert mixing.mix(df.limit(0)).count() == 0


def slow_flight(p, x, u):
    """The flight with the constraints' null space from a singular value decomposition."""
    p, held = [float(v) for v in p], []
    for i in range(len(p)):
        if not 1e-9 <= p[i] <= 1 - 1e-9:
            p[i] = round(p[i])
            continue
        held.append(i)
        if len(held) == 3:
            rows = np.array([[1.0, 1.0, 1.0], [x[k] for k in held]])
            space = np.linalg.svd(rows)[2][np.linalg.matrix_rank(rows) :]
            if len(space) == 2:  # equal sizes: any direction that keeps the count
                d = np.array([1.0, -1.0, 0.0])
            else:
                d = space[0] * np.sign(x[held[2]] - x[held[1]] or 1.0) * np.sign(space[0][0] or 1.0)
                if x[held[2]] == x[held[1]]:
                    d = space[0] * np.sign(x[held[0]] - x[held[2]]) * np.sign(space[0][1])
            ups = [(1 - p[k]) / v if v > 0 else p[k] / -v for k, v in zip(held, d) if abs(v) > 1e-12]
            downs = [p[k] / v if v > 0 else (1 - p[k]) / -v for k, v in zip(held, d) if abs(v) > 1e-12]
            step = min(ups) if u[i] * (min(ups) + min(downs)) < min(downs) else -min(downs)
            for k, v in zip(held, d):
                p[k] += step * v
                if not 1e-9 <= p[k] <= 1 - 1e-9:
                    p[k] = round(p[k])
            held = [k for k in held if 0 < p[k] < 1]
    return np.array(p)


def test_flight_against_null_space():
    rng = np.random.default_rng(21)
    for n in (3, 4, 7, 40):
        for _ in range(20):
            p, x, u = rng.random(n), rng.integers(0, 9, n).astype(float), rng.random(n)
            assert np.abs(mixing.flight(p, x, u) - slow_flight(p, x, u)).max() < 1e-6


def test_mix_against_brute_force(spark):
    """The same draws by a plain loop over the rows of each source and chunk."""
    rng = np.random.default_rng(22)
    rows = [(int(i), " ".join(["w"] * int(n)), ["a", "b", "c"][i % 3]) for i, n in enumerate(rng.integers(0, 40, 500))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    h = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64("doc_id", F.xxhash64("text")).alias("h")).collect()}
    size = {i: len(t.split()) for i, t, _ in rows}
    totals = {s: sum(size[i] for i, _, z in rows if z == s) for s in "abc"}
    target = slow_targets(totals)
    want = {}
    for s in "abc":
        mine = [i for i, _, z in rows if z == s]
        rate = min(target[s] / totals[s], 2.0)
        whole = int(np.floor(rate))
        p, chunks, level = {i: rate - whole for i in mine}, -(-len(mine) // 50), 0
        at = {i: h[i] % chunks for i in mine}
        while True:
            for c in sorted(set(at.values())):
                group = sorted((i for i in at if at[i] == c), key=lambda i: (h[i], size[i], p[i]))
                x = np.array([float(size[i]) for i in group])
                before = np.array([p[i] for i in group])
                after = slow_flight(before, x, mixing._draw(f"={s} {c} {level}").random(len(group)))
                if chunks <= 1:
                    after = mixing.landing(after, x, float((before * x).sum()))
                p.update(zip(group, after))
            if chunks <= 1:
                break
            level, chunks = level + 1, -(-chunks // mixing.FAN)
            at = {i: c // mixing.FAN for i, c in at.items() if 0 < p[i] < 1}
        want.update({i: whole + round(p[i]) for i in mine})
    assert {r.doc_id: r.copies for r in mixing.mix(df, chunk=50).collect()} == want


def test_repeated_rows_are_spread_over_chunks(spark, monkeypatch):
    seen = []
    rows = [(7, "same words here", "s")] * 3000 + [(i, f"text {i}", "s") for i in range(1000)]
    monkeypatch.setattr(mixing, "balanced", lambda r: (seen.append(r.withColumn("at", F.pmod("h", "chunks")).groupBy("at").count().agg(F.max("count")).first()[0]), r)[1])
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), chunk=500)
    assert got.count() == 4000 and seen[0] < 700


# shards -----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("shards", [16, 5])
def test_shards(spark, shards):
    rng = np.random.default_rng(6)
    rows = [(int(i), "é" * int(n), ["en", "de", None][i % 3], ["a", "a", "b"][i % 3], int(n), 3) for i, n in enumerate(rng.integers(0, 100, 3000))]
    rows += [(None, None, None, None, None, None), (1 << 62, "x" * 900, "en", "a", -5, 1), (-(1 << 62), "y", "en", "a", 1, 1)] + [(7, "same", "fr", "c", 4, 0)] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int")
    got = sharding.shard_documents(df, shards).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    total, by = sum(r.size for r in got), {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(shards))
    for rs in by.values():
        assert abs(sum(r.size for r in rs) - total / shards) <= 950 and sorted(r.slot for r in rs) == list(range(len(rs)))
    assert sharding.shard_documents(df.limit(0)).count() == 0
    one = sharding.shard_documents(df.limit(1)).collect()
    assert len(one) == 1 and one[0].slot == 0


def slow_shards(rows, shards):
    """rows: (dimension values, size, tie) of each; the tree by plain recursion."""
    spread = [max(1, max(r[0][d] for r in rows) - min(r[0][d] for r in rows)) for d in range(4)]
    out = {}

    def split(ids, first, n):
        if n == 1 or not ids:
            out.update((i, first) for i in ids)
            return
        width = [(max(rows[i][0][d] for i in ids) - min(rows[i][0][d] for i in ids)) / spread[d] for d in range(4)]
        d = width.index(max(width))
        total, goal = sum(rows[i][1] for i in ids), -(-sum(rows[i][1] for i in ids) * (n // 2) // n)
        ids = sorted(ids, key=lambda i: (rows[i][0][d], rows[i][2]))
        upto, k = 0, 0
        while upto + rows[ids[k]][1] < goal:
            upto += rows[ids[k]][1]
            k += 1
        if upto + rows[ids[k]][1] - goal <= goal - upto:
            k += 1
        split(ids[:k], first, n // 2)
        split(ids[k:], first + n // 2, n - n // 2)

    split(list(range(len(rows))), 0, shards)
    return out


@pytest.mark.parametrize("shards", [16, 7])
def test_shards_against_brute_force(spark, shards):
    rng = np.random.default_rng(23)
    langs, sources = [None, "en", "de", "fr"], ["commoncrawl-2023", "commoncrawl-2024", None]
    rows = [(int(i) * 3, "é" * int(n), langs[int(rng.integers(0, 4)) % 4], sources[int(rng.integers(0, 3))], int(n)) for i, n in enumerate(rng.integers(0, 300, 1500))]
    rows += [(9000, "long " * 60000, "en", "commoncrawl-2024", 300000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    tie = {r.doc_id: r.t for r in df.select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id", F.crc32("text").cast("long")), 64 - sharding.TIE_BITS).alias("t")).collect()}
    rank = lambda c: {v: k for k, v in enumerate(sorted({r[c] for r in rows}, key=lambda v: (v is not None, v or "")))}
    lang, source = rank(2), rank(3)
    plain = [((r[0], lang[r[2]], source[r[3]], r[4]), len(r[1].encode()) + 1, tie[r[0]]) for r in rows]
    want = {rows[i][0]: at for i, at in slow_shards(plain, shards).items()}
    assert {r.doc_id: r.shard for r in sharding.shard_documents(df, shards).collect()} == want


@pytest.mark.parametrize("ids", [list(range(17)), [2**62 + i for i in range(17)], [-(2**63) + i for i in range(9)] + [2**63 - 1 - i for i in range(8)]])
def test_shards_of_neighbouring_numbers(spark, ids):
    """Rows that differ by one are split between them, also at the ends of what a long holds."""
    rows = [(i, "x" * (k % 3), "en", "s", 5) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for shards in (2, 16):
        want = {ids[i]: at for i, at in slow_shards([((r[0], 0, 0, 5), len(r[1]) + 1, 0) for r in rows], shards).items()}
        assert {r.doc_id: r.shard for r in sharding.shard_documents(df, shards).collect()} == want


def test_shards_run_no_python(spark, sf_dir):
    df = sharding.op6_kd_shards(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
