import os

from pyspark.sql import types as T

from patchprofile.sources import delimited as D

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.DoubleType())])


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_load_semantics(spark, tmp_path):
    good = _write(tmp_path, "good.txt", "1,x,1.5\n2,,\n3,a\\,b,2\n4,\"q\",3\n5,back\\\\slash,4\n")
    bad = _write(tmp_path, "bad.txt", "6,short\n7,long,1,2\n8,num,abc\n9,ok,5\n")
    empty = _write(tmp_path, "empty.txt", "")
    missing = os.path.join(tmp_path, "missing.txt")
    names = spark.createDataFrame([(n,) for n in (good, bad, empty, missing)], "name string")
    _write(tmp_path, "unnamed.txt", "10,z,1\n")  # not in the manifest: not loaded
    res = D.load_delimited(spark, names, str(tmp_path), SCHEMA)
    assert [r["name"] for r in res.missing.collect()] == [missing]
    got = sorted(tuple(r) for r in res.good.select("a", "b", "c").collect())
    assert got == [(1, "x", 1.5), (2, None, None), (3, "a,b", 2.0), (4, '"q"', 3.0),
                   (5, "back\\slash", 4.0), (9, "ok", 5.0)]
    rej = sorted((r["raw_text"], r["reason"]) for r in res.rejects.collect())
    assert rej == [("6,short", "short row"), ("7,long,1,2", "long row"), ("8,num,abc", "unparsable c")]
    stats = {os.path.basename(r["file"]): (r["rows_loaded"], r["rows_rejected"])
             for r in D.file_stats(res).collect()}
    assert stats == {"good.txt": (5, 0), "bad.txt": (1, 3), "empty.txt": (0, 0)}
    once = res.stored(os.path.join(tmp_path, "lines"))
    assert (once.good.count(), once.rejects.count()) == (6, 3) and once.good.columns == res.good.columns


def test_missing_manifest_means_no_loads(spark, tmp_path):
    nope = os.path.join(tmp_path, "nope.csv")
    assert D.scan_manifest(spark, nope).count() == 0
    _write(tmp_path, "good.txt", "1,x,1.5\n")
    res = D.ingest(spark, nope, str(tmp_path), SCHEMA)
    assert res.good.count() == 0 and res.manifest.count() == 0


def test_an_unreadable_object_is_reported_and_the_rest_loads(spark, tmp_path):
    _write(tmp_path, "good.txt", "1,x,1.5\n")
    _write(tmp_path, "bad.txt.gz", "no archive")
    res = D.load_delimited(spark, D.scan_objects(spark, str(tmp_path)), str(tmp_path), SCHEMA, skip_unreadable=True)
    assert res.good.count() == 1
    assert {os.path.basename(r["file"]): r["state"] for r in D.file_stats(res).collect()} == {"good.txt": "loaded", "bad.txt.gz": "unreadable"}


def test_round_trip_through_writer(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b\\c", 1.25), (2, None, None)], SCHEMA)
    out = str(tmp_path / "objs")
    D.write_objects(df.withColumn("obj", df.a), out, "obj")
    manifest = str(tmp_path / "manifest")
    D.write_manifest(D.scan_objects(spark, out), manifest)
    res = D.ingest(spark, manifest, out, SCHEMA)
    assert sorted(tuple(r) for r in res.good.select("a", "b", "c").collect()) == [(1, "a,b\\c", 1.25), (2, None, None)]


def test_blank_lines_are_rejected_and_control_characters_kept(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    lines = spark.createDataFrame([("", "f"), ("a\x01b\\,c,\x02", "f"), ("x\\\\,y", "f")], "value string, _file string")
    good, bad = D.parse_lines(lines, schema)
    assert sorted((r.a, r.b) for r in good.collect()) == [("a\x01b,c", "\x02"), ("x\\", "y")]
    assert [(r.raw_text, r.reason) for r in bad.collect()] == [("", "short row")]


def _gz(folder, name, text, keep=1.0):
    import gzip

    data = gzip.compress(text.encode())
    path = os.path.join(folder, name)
    with open(path, "wb") as fh:
        fh.write(data[: int(len(data) * keep)])
    return path


def test_a_damaged_archive_leaves_no_row_behind(spark, tmp_path):
    import bz2
    import random

    rng = random.Random(1)
    text = "".join(f"{i},{rng.random()},{rng.random()}\n" for i in range(20_000))
    _gz(tmp_path, "whole.txt.gz", text)
    _gz(tmp_path, "cut.txt.gz", text, 0.5)
    _write(tmp_path, "plain.txt", "1,x,1.5\n")
    with open(tmp_path / "cut.txt.bz2", "wb") as fh:
        fh.write(bz2.compress(text.encode())[:-200])
    res = D.load_delimited(spark, D.scan_objects(spark, str(tmp_path)), str(tmp_path), SCHEMA, skip_unreadable=True)
    stats = {os.path.basename(r["file"]): (r["rows_loaded"], r["state"], r["error"] is None) for r in D.file_stats(res).collect()}
    assert stats == {"whole.txt.gz": (20_000, "loaded", True), "cut.txt.gz": (0, "unreadable", False), "plain.txt": (1, "loaded", True), "cut.txt.bz2": (0, "unreadable", False)}
    assert res.good.count() == 20_001


def test_a_large_archive_is_probed_by_its_own_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "PROBE_BYTES", 10)
    whole, cut = _gz(tmp_path, "whole.txt.gz", "1,x,1.5\n" * 9), _gz(tmp_path, "cut.txt.gz", "".join(f"{i},x,{i * 7919 % 1000}\n" for i in range(5_000)), 0.5)
    got = {r["_key"]: (r["lines"], r["error"] is None) for r in D.probe_objects(spark, [(whole, 100), (cut, 100), ("plain.txt", 5)]).collect()}
    assert got == {whole: (9, True), cut: (None, False)}


def test_only_the_named_objects_are_scanned(spark, tmp_path):
    """Files scanned = objects of the manifest that are present; no line is shuffled; each line is split once."""
    for i in range(4):
        _write(tmp_path, f"o{i}.txt", f"{i},x,1\n")
    names = spark.createDataFrame([(str(tmp_path / "o2.txt"),), (str(tmp_path / "none.txt"),)], "name string")
    res = D.load_delimited(spark, names, str(tmp_path), SCHEMA)
    assert [os.path.basename(f) for f in res.good.inputFiles()] == ["o2.txt"]
    plan = res.good._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert [tuple(r) for r in res.good.select("a", "b", "c").collect()] == [(2, "x", 1.0)]
    assert plan.count("Generate inline") == 1 and "split(" not in plan[: plan.index("Generate inline")]


def test_many_names_are_read_in_several_scans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "PATHS_A_SCAN", 2)
    for i in range(5):
        _write(tmp_path, f"o{i}.txt", f"{i},x,1\n")
    res = D.load_delimited(spark, D.scan_objects(spark, str(tmp_path)), str(tmp_path), SCHEMA)
    assert sorted(r.a for r in res.good.collect()) == [0, 1, 2, 3, 4]


def test_odd_object_names(spark, tmp_path):
    odd = ["a b.txt", "c+d.txt", "e%20f.txt", "[g].txt", "{h,i}.txt", "j*k.txt"]
    for i, n in enumerate(odd):
        _write(tmp_path, n, f"{i},x,1\n")
    names = spark.createDataFrame([(str(tmp_path / n),) for n in odd], "name string")
    res = D.load_delimited(spark, names, str(tmp_path), SCHEMA)
    assert sorted(r.a for r in res.good.collect()) == list(range(len(odd)))
    assert {os.path.basename(r["file"]): r["state"] for r in D.file_stats(res).collect()} == dict.fromkeys(odd, "loaded")


def test_any_number_of_escapes(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    lines = [("\\" * 402 + ",x", "f"), ("\\" * 403 + ",x", "f"), ("y" + "\\,z" * 50_000 + ",w", "f"), ("end\\,\\", "f"), ("a,\\", "f")]
    good, bad = D.parse_lines(spark.createDataFrame(lines, "value string, _file string"), schema)
    assert sorted((r.a, r.b) for r in good.collect()) == sorted([("\\" * 201, "x"), ("y" + ",z" * 50_000, "w"), ("a", "\\")])
    assert sorted(r.raw_text for r in bad.collect()) == sorted(["\\" * 403 + ",x", "end\\,\\"])


def test_objects_have_read_times(spark, tmp_path):
    import time

    from patchprofile.plans.metrics import summarize
    t0 = time.time()
    for i in range(3):
        _write(tmp_path, f"o{i}.txt", f"{i},x,1\n" * 50)
    res = D.load_delimited(spark, D.scan_objects(spark, str(tmp_path)), str(tmp_path), SCHEMA).stored(str(tmp_path / "lines"))
    stats = D.file_stats(res).collect()
    assert all(t0 - 1 <= r["started_at"] <= r["ended_at"] <= time.time() + 1 for r in stats)
    log = D.copy_records(D.file_stats(res), 4)
    assert sorted((r["step"], r["batch_id"], os.path.basename(r["lo"]), r["rows"]) for r in log.collect()) == [("copy", 4, f"o{i}.txt", 50) for i in range(3)]
    assert summarize(log, wall_clock_steps=("copy",)).first()["runs"] == 3


def test_a_writing_task_sorts_a_bounded_number_of_fields(spark, tmp_path, monkeypatch):
    import re

    monkeypatch.setattr(D, "SORTED_FIELDS", 120, raising=False)
    for rows in (400, 1_600):
        out = str(tmp_path / f"objs{rows}")
        df = spark.range(rows).selectExpr("CAST(id AS INT) a", "concat('x', id) b", "CAST(id AS DOUBLE) c", "id div 4 AS obj")
        D.write_objects(df, out, "obj")
        back = spark.read.option("basePath", out).text(out).selectExpr("_metadata.file_name AS f", "obj", "value").collect()
        assert sorted((r.obj, r.value) for r in back) == sorted((i // 4, f"{i},x{i},{float(i)}") for i in range(rows))
        per_task = {}
        for r in back:
            n = re.match(r"part-(\d+)-", r.f)[1]
            per_task[n] = per_task.get(n, 0) + 1
        # 40 rows a task on average; hashing objects of 4 rows deals some more to one
        assert len(per_task) >= rows // 80 and max(per_task.values()) <= 160
    D.write_objects(spark.range(0).selectExpr("CAST(id AS INT) a", "id AS obj"), str(tmp_path / "none"), "obj")
