import json

import pytest

from ledgerloom.operators import changes, manifest
from ledgerloom.operators.lookup import UnknownDataset, lookup, parse_selection
from ledgerloom.operators.modules import CarriersModule, Context, Descriptor, WorksModule
from ledgerloom.operators.relational import carry_forward, compose, hash_diff
from ledgerloom.sources import readers, schemas, writers
from ledgerloom.streaming.changes import state_before, stream_module_changes

TIME = "2026-01-01T00:00:00Z"


def csv(names, rows, sep):
    quote = lambda v: '"' + v.replace('"', '""') + '"'
    lines = [sep.join(f"any {n}" for n in names.split())]
    lines += [sep.join(quote(dict(r).get(n, "")) for n in names.split()) for r in rows]
    return "\r\n".join(lines).encode("latin-1") + b"\r\n"


def test_works(spark, tmp_path):
    work = {"cno": "100", "nome": 'OBRA "NOVA"\nBLOCO 2', "ni_responsavel": "12.abc.345/0001-90", "situacao": "02", "qualificacao_responsavel": "0057", "estado": "SP"}
    (tmp_path / "w.csv").write_bytes(csv(schemas.WORKS, [work, {"cno": "101", "ni_responsavel": "123"}], ","))
    links = [{"cno": "100", "ni_responsavel": "99000111000155"}, {"cno": "100", "ni_responsavel": "***456789**"}, {"cno": "404", "ni_responsavel": "99000111000155"}]
    (tmp_path / "l.csv").write_bytes(csv(schemas.LINKS, links, ","))
    inputs = {"works": readers.read_works_csv(spark, str(tmp_path / "w.csv")), "links": readers.read_links_csv(spark, str(tmp_path / "l.csv"))}
    assert inputs["works"].where("cno = '101'").first().nome is None
    rows = {r.cnpj: r for r in WorksModule().build(spark, Context(TIME, inputs)).collect()}
    assert set(rows) == {"12ABC345000190", "99000111000155"} and rows["99000111000155"].cnpj_prefix == "990"
    (obra,) = json.loads(rows["12ABC345000190"].payload_json)["obras"]
    assert obra["situacao"] == {"codigo": "02", "descricao": "ATIVA"} and obra["qualificacao_responsavel"]["descricao"] == "Dono da Obra"
    assert obra["nome"] == work["nome"] and obra["uf"] == "SP" and obra["pais"] == ""
    later = {r.cnpj: r for r in WorksModule().build(spark, Context("2027", inputs)).collect()}
    assert all(later[k].content_hash != rows[k].content_hash and later[k].stable_hash == rows[k].stable_hash for k in rows)


def test_carriers(spark, tmp_path):
    base = {"nome_transportador": "AÇÃO LTDA", "numero_rntrc": "2", "equiparado": "Sim", "cpfcnpjtransportador": "12.345.678/0001-90"}
    rows = [base, base | {"numero_rntrc": "1", "nome_transportador": "ZÊ"}, base | {"numero_rntrc": ""}, base | {"cpfcnpjtransportador": "***.123.456-**"}]
    (tmp_path / "c.csv").write_bytes(csv(schemas.CARRIERS, rows, ";"))
    built = CarriersModule().build(spark, Context(TIME, {"carriers": readers.read_carriers_csv(spark, str(tmp_path / "c.csv"))}))
    (r,) = built.collect()
    payload = json.loads(r.payload_json)
    assert r.cnpj == "12345678000190" and payload["nome"] == "ZÊ" and payload["equiparado"] is True
    writers.write_module(built.drop("stable_hash"), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).columns == schemas.MODULE_SCHEMA.names


def test_descriptor():
    with pytest.raises(ValueError):
        Descriptor("1a", "x")
    with pytest.raises(ValueError):
        Descriptor("a", "x", refresh_hours=0)


def states(spark, pairs):
    return spark.createDataFrame(pairs, "cnpj string, content_hash string")


def test_hash_diff(spark):
    old, new = states(spark, [("a", "1"), ("b", "1"), ("c", "1"), ("d", None)]), states(spark, [("a", "1"), ("b", "2"), ("e", "1"), ("d", None)])
    assert sorted((r.cnpj, r.change) for r in hash_diff(old, new).collect()) == [("b", "changed"), ("c", "removed"), ("e", "added")]
    assert hash_diff(old, old).count() == 0
    assert {r.change for r in hash_diff(old, new, trusted=False).collect()} == {"added"}
    diff = hash_diff(old, new)
    applied = old.join(diff, "cnpj", "left_anti").unionByName(diff.where("change <> 'removed'").selectExpr("cnpj", "current_hash AS content_hash"))
    assert sorted(map(tuple, applied.collect()), key=str) == sorted(map(tuple, new.collect()), key=str)


def test_stream(spark, tmp_path):
    source, state, feed = (str(tmp_path / x) for x in ("in", "state", "feed"))
    run = lambda: stream_module_changes(spark, source, "cnpj string, content_hash string", lambda df: df.groupBy("cnpj").agg({"content_hash": "max"}).toDF("cnpj", "content_hash"), state, feed, str(tmp_path / "cp"))
    states(spark, [("a", "1"), ("b", "1")]).write.mode("append").parquet(source)
    run()
    states(spark, [("a", "1"), ("b", "2"), ("c", "1")]).write.mode("append").parquet(source)
    run()
    run()
    got = sorted((r.batch_id, r.cnpj, r.change) for r in spark.read.parquet(f"{feed}/batch=*").collect())
    assert got == [(0, "a", "added"), (0, "b", "added"), (1, "b", "changed"), (1, "c", "added")]
    assert spark.read.parquet(f"{state}/batch=1").count() == 3


def test_stream_writes_changes_between_whole_states(spark, tmp_path):
    source, state, feed = (str(tmp_path / x) for x in ("in", "state", "feed"))
    want = {}
    for i, rows in enumerate([[("a", "1"), ("b", "1")], [("a", "1"), ("b", "2"), ("c", "1")], [("c", None)], [("d", "1")], [("a", "3")]]):
        states(spark, rows).write.mode("append").parquet(source)
        stream_module_changes(spark, source, "cnpj string, content_hash string", lambda df: df.distinct(), state, feed, str(tmp_path / "cp"), full_every=3)
        want |= dict(rows)
        assert {r.cnpj: r.content_hash for r in state_before(spark, state, i + 1, 3).orderBy("batch").collect()} == want
    assert [spark.read.parquet(f"{state}/batch={i}").count() for i in range(5)] == [2, 2, 1, 4, 1]
    got = sorted((r.batch_id, r.cnpj, r.change) for r in spark.read.parquet(f"{feed}/batch=*").collect())
    assert got == [(0, "a", "added"), (0, "b", "added"), (1, "b", "changed"), (1, "c", "added"), (2, "c", "changed"), (3, "d", "added"), (4, "a", "changed")]


def test_state_versions(spark, tmp_path):
    assert readers.read_state(spark, str(tmp_path / "none")).count() == 0
    df = spark.createDataFrame([("m", "a", "1")], schemas.STATE_SCHEMA)
    path = writers.write_state(df, str(tmp_path), "7")
    assert readers.read_state(spark, path).count() == 1
    with pytest.raises(Exception):
        writers.write_state(df, str(tmp_path), "7")


def test_selection():
    assert parse_selection("CNO, base e rntrc cno", ["cno", "rntrc"]) == ["cno", "base", "rntrc"]
    assert parse_selection(None, ["cno"]) == ["base", "cno"]
    with pytest.raises(UnknownDataset):
        parse_selection(["cno", "other"], ["cno"])


def test_lookup(spark):
    docs = spark.createDataFrame([("123", "12345678000190", "{}")], "prefix string, key string, value string")
    module = spark.createDataFrame([("12345678000190", "{1}")], "cnpj string, payload_json string")
    asked = spark.createDataFrame([("12.345.678/0001-90",), ("12345678000191",), ("x",), (None,)], "raw string")
    got = {r.raw: r for r in lookup(asked, docs, {"cno": module}).collect()}
    assert [got[k].outcome for k in ("12.345.678/0001-90", "12345678000191", "x", None)] == ["ok", "not_found", "invalid", "invalid"]
    assert got["12.345.678/0001-90"].cno == "{1}" and "value" not in lookup(asked, docs, {"cno": module}, "cno").columns
    composed = compose(docs.selectExpr("key AS cnpj"), {"cno": module, "rntrc": module.limit(0)})
    assert composed.first().rntrc is None and composed.columns == ["cnpj", "cno", "rntrc"]


def test_manifest_and_catalog(spark, tmp_path):
    base = spark.createDataFrame([(5, "t", 3, 2, "r0")], "total long, last_updated string, shard_prefix_length int, shard_count int, storage_release_id string")
    row = ("cno", "r1", "cno", "2", "v", "t", 4, True, 9, "u", "m")
    datasets = spark.createDataFrame([row, ("bad", None, *row[2:])], "dataset string, storage_release_id string, json_property_name string, schema_version string, source_version string, updated_at string, record_count long, zip_available boolean, zip_size long, zip_url string, zip_md5checksum string")
    manifest.build_manifest(base, datasets).write.text(str(tmp_path / "m"))
    (r,) = readers.read_manifest(spark, str(tmp_path / "m")).collect()
    assert (r.dataset, r.storage_release_id, r.record_count) == ("cno", "r1", 4)
    kept = manifest.carry_forward_base(base, base.limit(0)).first()
    assert kept.storage_release_id == "r0"
    resources = [{"name": "a", "format": "csv", "url": "old", "last_modified": "2", "position": 3}, {"name": "b", "format": "CSV", "url": "new", "last_modified": "1", "position": "12"}, {"name": "c", "format": "PDF", "url": "pdf", "position": 99}]
    text = json.dumps({"success": True, "result": {"resources": resources}})
    assert readers.latest_resource(spark.createDataFrame([(text,), ("junk",)], "value string")).first().url == "new"
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    assert sorted(map(tuple, carry_forward(old, spark.createDataFrame([("b", 2)], "k string, v int"), ["k"]).collect())) == [("a", 1), ("b", 2)]


def test_periods(spark):
    p = spark.createDataFrame([("2024-05",), ("2024-04",), ("bad",), (None,)], "period string")
    assert readers.select_period(p, current="2024-04").first().selected == "2024-04"
    assert readers.select_period(p, current="2030-01").first().selected == "2024-05"
    with pytest.raises(Exception, match="2030-01 is not there"):
        readers.select_period(p, requested="2030-01").collect()


def test_refresh_of_missing_state(spark):
    catalog = spark.createDataFrame([("m", "1", 24.0)], "module string, schema_version string, refresh_hours double")
    state = readers.empty_like(spark, "module string, source_version string, schema_version string, updated_at string, data_present boolean")
    published = spark.createDataFrame([("m", "v", "1", "2026-01-01T00:00:00Z")], "module string, source_version string, schema_version string, updated_at string")
    r = changes.refresh_decision(catalog, state, published, "2026-01-01T01:00:00Z").first()
    assert (r.not_published, r.cache_differs, r.too_old, r.data_missing, r.refresh, r.trusted) == (False, True, False, True, True, False)


def test_keyed_stream_over_many_batches(spark, tmp_path):
    """The same feed as the batch twin, over restarts; keys that a snapshot lacks are removed, and the state is not rewritten."""
    import numpy as np

    from ledgerloom.operators.relational import hash_diff
    from ledgerloom.streaming.keyed import stream_keyed_changes, tombstones

    rng = np.random.default_rng(1)
    source, feed, check = (str(tmp_path / x) for x in ("in", "feed", "cp"))
    schema = "cnpj string, content_hash string, position long, present boolean"
    previous, want = states(spark, []), []
    for batch in range(5):
        now = {f"k{int(i)}": None if rng.random() < 0.1 else f"h{int(rng.integers(0, 3))}" for i in rng.integers(0, 30, 20)}
        snapshot = states(spark, list(now.items()))
        tombstones(previous, snapshot, batch).coalesce(1).write.mode("append").parquet(source)
        want += [(batch, r.cnpj, r.change) for r in hash_diff(previous, snapshot).collect()]
        previous = snapshot
        stream_keyed_changes(spark, source, lambda df: df, schema, feed, check)
    got = [(r.batch_id, r.cnpj, r.change) for r in spark.read.parquet(f"{feed}/batch=*").collect()]
    assert sorted(got) == sorted(want) and {"added", "changed", "removed"} == {c for _, _, c in got}
    # all files in one go, a file a batch: the same feed
    stream_keyed_changes(spark, source, lambda df: df, schema, str(tmp_path / "feed2"), str(tmp_path / "cp2"), files_a_batch=1)
    again = sorted((r.cnpj, r.change, str(r.content_hash)) for r in spark.read.parquet(str(tmp_path / "feed2") + "/batch=*").collect())
    assert again == sorted((r.cnpj, r.change, str(r.content_hash)) for r in spark.read.parquet(f"{feed}/batch=*").collect())


def test_hot_keys_are_nested_in_pieces(spark):
    from ledgerloom.operators.relational import nest_children, nest_pieces

    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 > 0 THEN concat('k', id % 40) END AS k", "CASE WHEN id % 7 > 0 THEN id % 500 END AS v")
    pieces = nest_pieces(df, ["k"], ["v"], 64, sort_by=["v"])
    got = {}
    for r in pieces.orderBy("piece").collect():
        assert 0 < len(r.children) <= 64 and r.piece == got.setdefault(r.k, [0, []])[0]
        got[r.k][0] += 1
        got[r.k][1] += [c.v for c in r.children]
    want = {r.k: [c.v for c in r.children] for r in nest_children(df, ["k"], ["v"], sort_by=["v"]).collect()}
    assert {k: v for k, (_, v) in got.items()} == want
    # ranges of key and order, not keys, are dealt to tasks
    assert "rangepartitioning(k" in pieces._jdf.queryExecution().executedPlan().toString() and got["hot"][0] >= 3000 / 64
    assert nest_pieces(df.limit(0), ["k"], ["v"], 5).count() == 0


def test_works_move_their_values_only(spark):
    """Owners are moved once, to the works; what a company gathers of a work is one text without the names of its fields."""
    from ledgerloom.operators.modules import works_module

    odd = ['"', "\\", 'a",', "\x1f", "\x1e\x1d", "\n\t\x00", "é😀", "$1\\2", ",", '","', " ", "\x7f "]
    rows = [{c: odd[(i + j) % len(odd)] if (i + j) % 3 else None for j, c in enumerate(schemas.WORKS.split())} | {"cno": f"c{i}", "ni_responsavel": f"{i % 2:014d}"} for i in range(24)]
    works = spark.createDataFrame(rows, schemas.strings(schemas.WORKS))
    built = works_module(works, works.select(*[c for c in schemas.LINKS.split() if c in works.columns]), 'T"\\')
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning(cnpj" in x and "cno" in x.partition("hashpartitioning(")[2].partition(")")[0]]
    of = {r["cno"]: r for r in rows}
    got = {r.cnpj: json.loads(r.payload_json) for r in built.collect()}
    assert sorted(got) == [f"{i:014d}" for i in range(2)]
    for cnpj, payload in got.items():
        assert list(payload) == ["updated_at", "obras"] and payload["updated_at"] == 'T"\\'
        assert [o["cno"] for o in payload["obras"]] == sorted(r["cno"] for r in rows if r["ni_responsavel"] == cnpj)
        for o in payload["obras"]:
            r = of[o["cno"]]
            assert (o["nome"], o["uf"], o["pais"], o["codigo_localizacao"]) == tuple(r[c] or "" for c in ("nome", "estado", "nome_pais", "codigo_localizacao"))
            assert o["qualificacao_responsavel"] == {"codigo": r["qualificacao_responsavel"] or "", "descricao": ""} and len(o) == 24


def test_json_values_are_what_to_json_writes(spark):
    from pyspark.sql import functions as F

    from ledgerloom.functions.exprs import json_objects, json_values

    odd = ["", '"', "\\", 'x",', "\x1f", "\x1e", "\x1d,", "\x00\x01", "ÿ😀", "$0", '\\"', "a/b", "�", "plain text"]
    df = spark.createDataFrame([(a, b) for a in odd for b in odd], "a string, b string").unionByName(spark.sql("SELECT CAST(X'41FF42' AS STRING) AS a, 'x' AS b"))
    s = F.struct("a", F.struct(F.col("b").alias("x"), F.col("a").alias("y")).alias("c"), "b")
    lists = df.groupBy().agg(F.collect_list(json_values(*map(F.col, "abab"))).alias("v"), F.to_json(F.collect_list(s)).alias("want"))
    r = lists.select(json_objects("v", ["a", ("c", "x", "y"), "b"]).alias("got"), "want", json_objects(F.array().cast("array<string>"), ["a"]).alias("none")).first()
    assert r.got == r.want and r.none == "[]"


def test_faults_that_some_items_of_a_list_have(spark):
    """A list's own shape hides what some items lack; works without faults are taken out before, which must hide nothing either."""
    from ledgerloom.operators import quality

    good = json.loads(quality_filled(quality.WORKS_TREE))["obras"][0]
    without = {k: v for k, v in good.items() if k != "cep"}
    long, null = good | {"cep": "é" * 9, "uf": 123}, good | {"pais": None}
    cases = {
        (): [good] * 3,
        ("obras[].cep:required",): [good, without, good],
        ("obras[].pais:type",): [null, good],
        ("obras[].cep:too_long", "obras[].uf:type"): [good, good, long, good],
        ("obras[].cep:required", "obras[].cep:too_long", "obras[].pais:type", "obras[].uf:type"): [without, null, long],
        ("obras[].situacao:type", "obras[]:type"): [good, 1, good | {"situacao": []}],
        tuple(sorted(f"obras[].x{i:02}:unknown" for i in range(20)) + ["obras[].cep:too_long"]): [*(good | {f"x{i:02}": 1} for i in range(20)), good | {"cep": "123456789"}],
    }
    for want, obras in cases.items():
        text = json.dumps({"updated_at": "", "obras": obras}, separators=(",", ":"))
        rows = quality.json_report(spark.createDataFrame([(text,)], "value string"), "value", quality.WORKS_TREE).collect()
        assert sorted(r.rule for r in rows) == sorted(want)
    whole = json.dumps({"updated_at": "", "obras": [good] * 3}, separators=(",", ":"))
    broken = [whole[:-3] + ",]}", whole.replace("},{", "},,{", 1), whole[:-1], whole + "}", '"' + whole, whole.replace('"obras"', 'obras"')]
    (r,) = quality.json_report(spark.createDataFrame([(t,) for t in broken], "value string"), "value", quality.WORKS_TREE).collect()
    assert (r.rule, r.n) == (":no_object", len(broken))


def quality_filled(tree):
    from ledgerloom.plans.registry import _filled

    return _filled(tree)
