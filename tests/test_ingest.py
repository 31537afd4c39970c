import os

import pytest
from pyspark.sql import functions as F

from vellum.operators import dedup, report
from vellum.plans import indexing
from vellum.session import scratch_path
from vellum.sources import files as src
from vellum.sources.store import VectorStore, point_schema

LONG = ("Este es un párrafo largo sobre contratos y condiciones generales del servicio. " * 12).strip()
HTML = ("<html><body><h1>Title</h1><p>" + "Alpha beta gamma delta epsilon. " * 10 + "</p>"
        "<h2>Second</h2><p>" + "Zeta eta theta iota kappa. " * 10 + "</p><script>x()</script></body></html>")


def write(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


DECODERS = {"txt": src.TextDecoder(), "html": src.HtmlDecoder()}
SUFFIXES = (".txt", ".html", ".json")


def run(spark, store, folder, **kw):
    files = src.discover_files(spark, folder, SUFFIXES)
    cfg = indexing.IndexConfig(indexed_at="2024-01-01T00:00:00", **kw)
    return indexing.run_index(store, files, decoders=DECODERS, cfg=cfg, failed_at="2024-01-01 00:00:00")


def test_index_twice_and_quarantine(spark, tmp_path):
    folder = str(tmp_path / "docs")
    write(folder, "a.txt", LONG)
    write(folder, "sub/B.HTML", HTML)
    write(folder, "copy/a.txt", LONG)   # same content, other path
    write(folder, "c.txt", "tiny")      # no block of 60 characters
    write(folder, "d.json", "{}")       # no decoder
    store = VectorStore(spark, scratch_path(spark, "store")).ensure(64)
    s1 = run(spark, store, folder)
    assert (s1["total"], s1["processed"], s1["skipped"], s1["errors"]) == (5, 3, 0, 2)
    n1 = store.count()
    assert n1 == s1["chunks"] - store.scan().where(F.col("filepath").endswith("copy/a.txt")).count()
    q = store.load_quarantine().select("filename", "error", "quarantine_name").collect()
    assert sorted(r["quarantine_name"] for r in q) == ["c__20240101_000000.txt", "d__20240101_000000.json"]
    # identical content at two paths -> one set of ids, the later path wins
    paths = {r["filepath"] for r in store.scan(["filepath"]).collect()}
    assert any(p.endswith("copy/a.txt") for p in paths) and not any(p.endswith("docs/a.txt") for p in paths)
    # second run: unchanged files are skipped, failed files are retried
    s2 = run(spark, store, folder)
    assert (s2["processed"], s2["skipped"], s2["errors"], s2["chunks"]) == (0, 3, 2, 0)
    assert store.count() == n1
    # changed content at the same path: re-indexed; old points stay unless clean-up is on
    write(folder, "sub/B.HTML", HTML.replace("Alpha", "Omega"))
    s3 = run(spark, store, folder)
    assert (s3["processed"], s3["skipped"]) == (1, 2)
    assert store.count() > n1
    s4 = run(spark, store, folder, remove_stale=True, skip_already_indexed=False)
    assert s4["processed"] == 3
    assert store.count() == n1
    state = store.load_state().collect()
    assert len(state) == 3 and {os.path.basename(r["path"]) for r in state} == {"a.txt", "B.HTML"}


def test_known_and_changed_semantics(spark):
    files = spark.createDataFrame([("new/a.pdf", "h1"), ("b.pdf", "h2"), ("c.pdf", "h3")], "path string, file_hash string")
    state = spark.createDataFrame([("old/a.pdf", "h1"), ("b.pdf", "h2"), ("c.pdf", "h0")], "path string, file_hash string")
    known = dedup.known_hashes(state)
    # G1: same content at a new path is skipped
    assert sorted(r["path"] for r in dedup.drop_known(files, known).collect()) == ["c.pdf"]
    # Same content at a new path is indexed, changed content too
    todo, skipped = dedup.changed_files(files, state)
    assert sorted(r["path"] for r in todo.collect()) == ["c.pdf", "new/a.pdf"]
    assert [r["path"] for r in skipped.collect()] == ["b.pdf"]
    todo, skipped = dedup.changed_files(files, state, skip_unchanged=False)
    assert todo.count() == 3 and skipped.count() == 0
    # failed file keeps its old state entry
    ok = spark.createDataFrame([("new/a.pdf", "h1")], "path string, file_hash string")
    new = {r["path"]: r["file_hash"] for r in dedup.update_state(state, ok).collect()}
    assert new == {"old/a.pdf": "h1", "b.pdf": "h2", "c.pdf": "h0", "new/a.pdf": "h1"}


def test_run_summary(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, file_hash string")
    skipped = files.where("path = 'b'")
    chunks = spark.createDataFrame([("a",), ("a",)], "filepath string")
    errors = spark.createDataFrame([("c", "boom")], "path string, error string")
    out = report.file_outcome(files, skipped, chunks, errors)
    s = report.run_summary(out).first()
    assert (s["total"], s["processed"], s["skipped"], s["errors"], s["chunks"]) == (3, 1, 1, 1, 2)


def test_outcome_of_chunks_is_the_outcome(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "path string, file_hash string")
    skipped, todo = files.where("path = 'b'"), files.where("path <> 'b'")
    chunks = spark.createDataFrame([("a",), ("a",), ("d",)], "filepath string")
    errors = spark.createDataFrame([("c", "none")], "path string, error string")
    once, slow = report.outcome_of_chunks(todo, skipped, chunks, "none"), report.file_outcome(files, skipped, chunks, errors)
    assert once.columns == slow.columns and sorted(once.collect()) == sorted(slow.collect())
    assert report.outcome_of_chunks(todo.limit(0), skipped, chunks.limit(0), "none").count() == 1


def test_upsert_idempotent(spark):
    store = VectorStore(spark, scratch_path(spark, "store2"), buckets=4).ensure(2)
    cols = store.scan().columns
    pts = spark.createDataFrame(
        [(1, [1.0, 0.0], "a", "p/a", 0), (2, [0.0, 1.0], "a", "p/a", 1), (1, [1.0, 0.0], "a", "q/a", 0)],
        "point_id bigint, vector array<float>, file_hash string, filepath string, chunk_id int")
    for c in cols:
        if c not in pts.columns:
            pts = pts.withColumn(c, F.lit(None).cast(store.scan().schema[c].dataType))
    store.upsert(pts.select(*cols))
    first = sorted((r["point_id"], r["filepath"]) for r in store.scan().collect())
    store.upsert(pts.select(*cols))
    assert sorted((r["point_id"], r["filepath"]) for r in store.scan().collect()) == first == [(1, "q/a"), (2, "p/a")]
    bad = pts.withColumn("vector", F.array(F.lit(1.0).cast("float")))
    try:
        store.upsert(bad.select(*cols))
        raise AssertionError("size check did not fire")
    except Exception as e:  # noqa: BLE001
        assert "vector size" in str(e)


def test_token_ingest_g1(spark):
    from vellum.plans.indexing import run_token_ingest, token_store_schema

    store = VectorStore(spark, scratch_path(spark, "g1"), buckets=4).ensure(64, token_store_schema())
    body = "Una frase de prueba para el indice de fragmentos por tokens. " * 40
    pages = spark.createDataFrame(
        [("a.pdf", 1, body, "h-a"), ("a.pdf", 2, body, "h-a"), ("blank.pdf", 1, "   ", "h-b")],
        "path string, page int, text string, file_hash string")
    r1 = run_token_ingest(store, pages, failed_at="2024-01-01 00:00:00")
    assert r1 == {"chunks": store.count(), "empty": 1} and r1["chunks"] > 1
    ids = [r["point_id"] for r in store.scan(["point_id"]).collect()]
    assert len(set(ids)) == len(ids) and all(len(i) == 36 for i in ids)
    # same content at another path is known: nothing new
    again = pages.withColumn("path", F.concat(F.lit("copy/"), F.col("path")))
    r2 = run_token_ingest(store, again)
    assert r2["chunks"] == 0 and store.count() == r1["chunks"]
    q = {r["filename"] for r in store.load_quarantine().collect()}
    assert q == {"blank.pdf"}


def test_plan_is_lazy_and_complete(spark):
    # every DataFrame of the plan evaluates on its own (no checkpoint needed)
    rows = [("d/a.txt", LONG), ("d/b.html", HTML), ("d/c.txt", "tiny"), ("d/e.json", "{}")]
    files = src.with_hash(src.files_from_table(spark.createDataFrame(rows, "p string, c string"), F.col("p"), F.col("c")))
    state = spark.createDataFrame([], "path string, file_hash string")
    plan = indexing.plan_index(files, state, decoders=DECODERS, cfg=indexing.IndexConfig(indexed_at="t"))
    n_points = plan.points.count()
    out = {r["path"]: (r["status"], r["chunks"]) for r in plan.outcome.collect()}
    assert out["d/c.txt"] == ("error", 0) and out["d/e.json"] == ("error", 0)
    assert out["d/a.txt"][0] == "processed" and out["d/b.html"][0] == "processed"
    assert n_points == out["d/a.txt"][1] + out["d/b.html"][1] == plan.chunks.count()
    assert {r["path"] for r in plan.new_state.collect()} == {"d/a.txt", "d/b.html"}
    # a heading met by an empty section is body text: the leading <h1> opens
    # "Sección 1" as its first line; <h2> after body text names the next one
    ch = plan.chunks.where(F.col("filepath") == "d/b.html").orderBy("chunk_id").collect()
    assert [r["section"] for r in ch] == ["Sección 1", "Second"]
    assert ch[0]["text"].startswith("Title\nAlpha")


def test_reopened_store_keeps_its_buckets_and_prunes(spark, tmp_path):
    """Another bucket count given on opening changes nothing; an upsert reads
    and rewrites only the buckets of its points; readers see whole writes."""
    from pyspark.sql import functions as F

    def points(ids, text="x"):
        rows = [(int(i), [1.0, 0.0], f"p{i}", f"h{i}", text) for i in ids]
        d = spark.createDataFrame(rows, "point_id bigint, vector array<float>, filepath string, file_hash string, text string")
        return d.select(*[F.col(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in point_schema()])

    root = str(tmp_path / "store")
    VectorStore(spark, root, buckets=16).ensure(2).upsert(points(range(50)))
    store = VectorStore(spark, root)
    assert store.buckets == 16
    before = store.scan(["point_id", "text"])
    old = before.collect()
    store.upsert(points(range(50), "y"))
    assert store.count() == 50 and {r.text for r in store.scan(["text"]).collect()} == {"y"}
    assert sorted(before.collect()) == sorted(old)  # an opened snapshot stays readable
    first = store.manifest()["points"]
    store.upsert(points([1], "z"))
    changed = {b for v, bs in store.manifest()["points"].items() if v not in first for b in bs}
    assert len(changed) == 1 and store.count() == 50
    store.upsert(points([1000]))  # nothing replaced: its bucket only gets one more write
    assert store.count() == 51
    plan = store.scan(["point_id", "filename"]).where("filename = 'a'")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(filename), EqualTo(filename,a)]" in plan
    store.vacuum()
    assert store.count() == 51


def test_state_survives_damage_and_quarantine_does_not_repeat(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "s")).ensure(2)
    assert store.load_state().count() == 0
    store.save_state(spark.createDataFrame([("a", "1")], "path string, file_hash string"))
    assert store.load_state().count() == 1
    folder = f"{store.state_path}/v={store.manifest()['state']}"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"damaged")
            if os.path.exists(f"{folder}/.{name}.crc"):
                os.remove(f"{folder}/.{name}.crc")
    with pytest.warns(UserWarning, match="unreadable"):
        assert store.load_state().count() == 0
    bad = spark.createDataFrame([("a.pdf", "broken")], "path string, error string")
    store.quarantine(bad, "2024-01-01 00:00:00")
    store.quarantine(bad, "2024-01-02 00:00:00")
    assert store.load_quarantine().count() == 1


def test_listing_reports_what_it_cannot_read(spark, tmp_path):
    from vellum.plans.indexing import run_token_ingest_files, token_store_schema
    from vellum.sources.files import TextDecoder, discover_files, unreadable_files

    for name in ("a.txt", "_b.TXT", ".c.txt", "_sub/d.txt", ".hid/e.txt", "x y%20z.txt", "big.txt", "blank.txt"):
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("   \n" if name == "blank.txt" else name * (50 if name == "big.txt" else 1))
    folder = str(tmp_path / "in")
    read = {r.filename for r in discover_files(spark, folder, (".txt",), max_bytes=100).select("filename").collect()}
    assert read == {"a.txt", "x y%20z.txt", "blank.txt"}
    errors = {r.path.split("/in/")[1]: r.error for r in unreadable_files(spark, folder, (".txt",), max_bytes=100).collect()}
    assert set(errors) == {"_b.TXT", ".c.txt", "_sub/d.txt", ".hid/e.txt", "big.txt"}
    assert "too large" in errors["big.txt"] and "hidden" in errors["_b.TXT"]
    store = VectorStore(spark, str(tmp_path / "g1")).ensure(64, token_store_schema())
    out = run_token_ingest_files(store, discover_files(spark, folder, (".txt",), max_bytes=100), TextDecoder(),
                                 unreadable=unreadable_files(spark, folder, (".txt",), max_bytes=100))
    assert out == {"chunks": 2, "empty": 1, "errors": 5}
    assert store.load_quarantine().count() == 6
    again = run_token_ingest_files(store, discover_files(spark, folder, (".txt",), max_bytes=100), TextDecoder())
    assert again["chunks"] == 0


def test_unchanged_files_are_not_opened(spark, tmp_path):
    folder = str(tmp_path / "docs")
    for name in ("a.txt", "sub/b b.txt", "c.txt", "d[1].txt"):
        write(folder, name, LONG + name)
    write(folder, "tiny.txt", "tiny")
    store = VectorStore(spark, scratch_path(spark, "store")).ensure(64)

    def go(**kw):
        cfg = indexing.IndexConfig(indexed_at="2024-01-01T00:00:00", skip_already_indexed=kw.pop("skip", True))
        s = indexing.run_index_folder(store, folder, suffixes=SUFFIXES, decoders=DECODERS, cfg=cfg, **kw)
        return s["total"], s["processed"], s["skipped"], s["errors"]

    assert go() == (5, 4, 0, 1)
    n = store.count()
    assert go() == (5, 0, 4, 1)  # the failed one is tried again
    # rewritten within length and time of change: only a run that opens it can tell
    path = os.path.join(folder, "a.txt")
    before = os.stat(path)
    write(folder, "a.txt", (LONG + "a.txt").replace("contratos", "CONTRATOS"))
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    assert go() == (5, 0, 4, 1) and store.count() == n
    assert go(always_hash=True) == (5, 1, 3, 1) and store.count() > n
    assert go() == (5, 0, 4, 1)
    # touched, not changed: read once, skipped by its hash, and unopened from then on
    os.utime(os.path.join(folder, "c.txt"), (1, 1))
    assert go() == (5, 0, 4, 1)
    assert {os.path.basename(r.path): r.modified.year for r in store.load_seen().collect()}["c.txt"] == 1970
    # changed, new and names that look like patterns
    write(folder, "d[1].txt", LONG + "changed")
    write(folder, "new.txt", LONG + "new")
    assert go() == (6, 2, 3, 1)
    store.vacuum()
    assert go() == (6, 0, 5, 1) and store.load_seen().count() == 5
    assert go(skip=False) == (6, 5, 0, 1)


def test_only_touched_paths_are_read(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "docs")
    for i in range(6):
        write(folder, f"f{i}.txt", LONG + str(i))
    listing = src.list_files(spark, folder, SUFFIXES)
    some = listing.where(F.col("path").rlike("f[23]"))
    files = src.read_files(spark, folder, some, SUFFIXES)
    assert len(files.inputFiles()) == 2 and files.count() == 2
    assert src.read_files(spark, folder, some.limit(0), SUFFIXES).count() == 0
    monkeypatch.setattr(src, "MAX_PATHS", 1)
    assert sorted(r.filename for r in src.read_files(spark, folder, some, SUFFIXES).collect()) == ["f2.txt", "f3.txt"]


def test_last_wins_by_keys(spark, tmp_path):
    rows = [(1, "a", "x"), (1, "c", "y"), (1, "b", "z"), (2, None, "n"), (2, "a", "m"), (3, "p", "same"), (3, "p", "same"), (4, "only", None), (None, "a", "k"), (None, "b", "l"), (5, None, "q")]
    p = spark.createDataFrame(rows, "point_id long, filepath string, text string")
    p.write.parquet(str(tmp_path / "p"))
    p = spark.read.parquet(str(tmp_path / "p"))
    out = dedup.last_wins_by_keys(p)
    assert out.columns == p.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, dedup.last_wins(p).select(*p.columns).collect()))
    assert {(r.point_id, r.filepath) for r in out.collect()} == {(1, "c"), (2, "a"), (3, "p"), (4, "only"), (None, "b"), (5, None)}
    assert dedup.last_wins_by_keys(p.limit(0)).count() == 0


def test_text_files_as_the_writer_leaves_them(spark, tmp_path):
    """One file a key: null texts, empty ones, several rows of a key, no key."""
    rows = [(i, f"text {i}\nläst") for i in range(300)] + [(7, "more"), (300, None), (301, ""), (None, "no key")]
    df = spark.createDataFrame(rows, "id long, text string")
    src.write_text_files(df, str(tmp_path / "own"), "id", "text")
    df.repartition("id").sortWithinPartitions("id", "text").write.partitionBy("id").text(str(tmp_path / "spark"))

    def files(folder):
        found = src.discover_files(spark, str(tmp_path / folder), (".txt",)).select(F.regexp_extract("path", "id=([^/]*)/", 1), "content").collect()
        return sorted((r[0], bytes(r[1])) for r in found)

    assert len(files("own")) == 303
    assert {k: sorted(v.split(b"\n")) for k, v in files("own")} == {k: sorted(v.split(b"\n")) for k, v in files("spark")}


def test_tasks_list_a_mounted_folder_as_the_source_does(spark, tmp_path, monkeypatch):
    """The driver holds no file of the tree, however its folders are dealt; the rows are those of Spark's reader."""
    root = tmp_path / "in"
    names = ["a.txt", "deep/er/est/b.TXT", "deep/c.html", "x y%20z.txt", "k=1/_v=2/d.txt", "_k=1.txt", "é/ü.txt", "no.pdf",
             "_metadata/m.txt", "_metadata.txt", "_h/e.txt", ".h/f.txt", "_g.txt", "half.txt._COPYING_", "half._COPYING_/n.txt", *(f"many/{i % 7}/{i}.txt" for i in range(60))]
    for i, name in enumerate(names):
        write(str(root), name, name * (i % 3 + 1))
        os.utime(root / name, ns=(0, (10**9 + i) * 10**9 + 123_456_789))
    write(str(root), "empty.txt", "")
    (root / "hollow").mkdir()
    (root / "link").symlink_to(root / "deep", target_is_directory=True)
    (root / "broken.txt").symlink_to(tmp_path / "nothing")
    sums = spark.range(3).select(F.col("id").cast("string")).coalesce(1)
    sums.write.text(str(root / "spark"))  # with Hadoop's sums beside it

    def rows(df):
        return sorted(map(str, df.select("path", "length", "modificationTime").collect()))

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(root)).where(src._suffix_filter(SUFFIXES))
    contents = sorted((r.path, bytes(r.content)) for r in reader.collect())
    assert len(contents) > 70
    for folder, entries in ((str(root), 10_000), (f"file://{root}/", 10_000), (str(root), 1), (str(root), 20)):
        monkeypatch.setattr(src, "DEAL_ENTRIES", entries)
        found = src.discover_files(spark, folder, SUFFIXES, sort=True)
        assert found.inputFiles() == [] and found.columns == ["path", "filename", "file_type", "length", "content"]
        assert sorted((r.path, bytes(r.content)) for r in found.collect()) == contents
        assert rows(src._listing(spark, folder, SUFFIXES)) == rows(reader)
    assert {d for d, _ in src._dealt(str(root), 1)} == {str(root)} and len(src._dealt(str(root), 5)) >= 5
    monkeypatch.setattr(src, "READ_BYTES", 20)
    assert sorted((r.path, bytes(r.content)) for r in src.discover_files(spark, str(root), SUFFIXES).collect()) == contents
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        src.discover_files(spark, str(tmp_path / "nowhere"))
    part = next(p for p in (root / "spark").iterdir() if p.name.startswith("part-"))
    part.write_text("0\n1\n3\n")  # the sums are those of 0, 1 and 2
    with pytest.raises(Exception, match="checksum error"):
        src.discover_files(spark, str(root), SUFFIXES).collect()


def test_flat_text_files_take_no_folder_each(spark, tmp_path):
    rows = [(i, f"text {i}\nläst") for i in range(3000)] + [(7, "more"), (3000, None), (3001, ""), (None, "no key")]
    df = spark.createDataFrame(rows, "id long, text string")
    src.write_text_files(df, str(tmp_path / "flat"), "id", "text", flat=True)
    src.write_text_files(df, str(tmp_path / "own"), "id", "text")

    def files(folder):
        found = src.discover_files(spark, str(tmp_path / folder), (".TXT",)).select(F.regexp_extract("path", "id=([^/.]*)", 1), "file_type", "content").collect()
        return sorted((r[0], r[1], bytes(r[2])) for r in found)

    assert len(files("flat")) == 3003 and files("flat") == files("own")
    assert sum(len(d) for _, d, _ in os.walk(tmp_path / "flat")) <= src.WRITE_FOLDERS


def test_discovered_rows_stay_off_the_driver(spark, tmp_path):
    """Neither a listing that is held nor a size that looks fit to broadcast."""
    write(str(tmp_path / "in"), "a.txt", LONG)
    found = src.discover_files(spark, str(tmp_path / "in"), SUFFIXES)
    plan, names = (x._jdf.queryExecution().optimizedPlan() for x in (found, found.select("filename")))
    assert "binaryFile" not in plan.toString()
    assert plan.stats().sizeInBytes() > 1 << 40
    assert "read(path" in plan.toString() and "read(path" not in names.toString()  # contents that aren't asked for


def test_texts_of_one_row_are_written_where_they_are(spark, tmp_path, monkeypatch):
    """Only rows of repeated keys meet, whether these are few or many; each key has one file."""
    def written(name, rows):
        df = spark.createDataFrame(rows, "id long, text string").repartition(5)
        src.write_text_files(df, str(tmp_path / name), "id", "text", flat=True)
        found = src.discover_files(spark, str(tmp_path / name), (".txt",)).select("filename", "content").collect()
        assert len({r.filename for r in found}) == len(found)
        return {r.filename: bytes(r.content).decode() for r in found}

    some = [(i, f"text {i}") for i in range(50)]
    more = [(i % 4, f"b{i:02}") for i in range(20)] + [(None, "n2"), (None, "n1"), (7, None), (60, None), (60, "")]
    want = {f"id={i}.txt": f"{t}\n" for i, t in some}
    shuffled, real = [], type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda self, *a: (shuffled.append("id") if a == ("id",) else None, real(self, *a))[1])
    assert written("single", some) == want and not shuffled
    want |= {f"id={k}.txt": "".join(f"{x}\n" for x in (*(f"b{i:02}" for i in range(k, 20, 4)), f"text {k}")) for k in range(4)}
    want |= {"id=7.txt": "\ntext 7\n", "id=60.txt": "\n\n", "id=__HIVE_DEFAULT_PARTITION__.txt": "n1\nn2\n"}
    assert written("few", some + more) == want and len(shuffled) == 1
    monkeypatch.setattr(src, "MAX_REPEATED", 3)
    assert written("many", some + more) == want
    assert written("none", []) == {}
