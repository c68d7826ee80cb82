"""JSON array files: read in splits, copied byte by byte, cleaned and written back."""

import hashlib
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from pagemill.plans import jobs
from pagemill.sources import arrays, files, io

SPLIT = "spark.sql.files.maxPartitionBytes"


def scratch():
    return tempfile.mkdtemp(prefix="pagemill-arr-", dir="/tmp")


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode() if isinstance(text, str) else text)
    return path


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "3000")
    yield
    spark.conf.set(SPLIT, old)


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 4 else 6)
    if kind < 3:
        return "".join(rng.choice(['a', ' ', '"', '\\', '[', ']', '{', '}', ',', '\n', 'é', '日', ' ', '\t'])
                       for _ in range(rng.randrange(60)))
    if kind < 6:
        return rng.choice([None, True, False, 0, -7, 1.5, 10**14, "x" * 900])
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(5))}


def elements(spark, path):
    return [(r["name"], json.loads(r["json"])) for r in arrays.read_elements(spark, path).orderBy("pos").collect()]


def test_splits_give_the_elements_of_the_array(spark, small_splits):
    rng = random.Random(4)
    d = scratch()
    want = []
    for i, style in enumerate([{"indent": 4}, {}, {"indent": 1}, {"indent": 0}, {"separators": (",\n", ":\r\n")}]):
        data = [value(rng) for _ in range(150)]
        put(d, f"f{i} %41.json", json.dumps(data, ensure_ascii=bool(i % 2), **style))
        want += [(f"f{i} %41.json", v) for v in data]
    put(d, "f7.json", " \n[\n\n]\n ")
    put(d, "sub/f8.json", json.dumps([value(rng)]))
    got = elements(spark, d)
    assert got[:-1] == want and got[-1][0] == "sub/f8.json"
    pos = [r["pos"] for r in arrays.read_elements(spark, d).collect()]
    assert len(set(pos)) == len(pos) == max(pos)          # one number for the empty array
    assert arrays._lines(spark, d).rdd.getNumPartitions() > 20


def test_one_large_file_is_read_by_many_tasks(spark, small_splits):
    d = scratch()
    rows = [{"link": f"l{i}", "Title": "t", "Text": "words, [and] \"marks\" " * (1 + i % 50)} for i in range(400)]
    rows[200]["Text"] = "long " * 4000                    # an element over several splits
    path = put(d, "articles.json", json.dumps(rows, indent=4))
    seen = arrays._lines(spark, path).select(F.spark_partition_id().alias("p")).distinct().count()
    assert seen > 10
    got = io.read_articles(spark, path).orderBy("pos").collect()
    assert [(r["pos"], r["link"], r["text"]) for r in got] == [
        (i, r["link"], r["Text"]) for i, r in enumerate(rows)]


BAD = ["", "  \n ", "7", '{"a": 1}', "[1, 2", "[1, 2]]", '[1] garbage {{{', "garbage [1]", "[1,]", "[,1]",
       "[1,,2]", '["a\nb"]', '["a]', "[1 2]", '[{"a": 1} {"b": 2}]', '[{"a": 1]}', "[}", "][", "[tru]", '[{"a" 1}]',
       "[]x"]
BAD_IN_SPLITS = ["[1]\n[2]", "[1\n,\n\n,2]", "[1]\n,", "[1,\n2\n3]", "\n[1\n]\n]"]


@pytest.mark.parametrize("split,texts", [("128m", BAD + BAD_IN_SPLITS), ("2", BAD_IN_SPLITS)])
def test_text_that_is_not_one_array_raises(spark, split, texts):
    old = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, split)
    try:
        for text in texts:
            d = scratch()
            put(d, "good.json", "[1, 2]")
            put(d, "bad.json", text)
            with pytest.raises(Exception):
                print(text, io.read_mixed_articles(spark, d).collect())
    finally:
        spark.conf.set(SPLIT, old)


def test_a_malformed_file_stops_the_clean_run(spark):
    d = os.path.join(scratch(), "articles")
    put(d, "good.json", "[1, 2]")
    put(d, "bad.json", '[{"link": "a"}]\n[2]')
    before = tree(d)
    for job in (jobs.clean_dataset, jobs.clean_json_files):
        with pytest.raises(Exception):
            job(spark, d, d)
        assert tree(d) == before


def tree(folder):
    out = {}
    for at, _, names in os.walk(folder):
        for n in names:
            if not n.startswith((".", "_")) and "/_" not in at:
                with open(os.path.join(at, n), "rb") as f:
                    out[os.path.relpath(os.path.join(at, n), folder)] = f.read()
    return out


def test_backup_is_a_copy_that_can_be_restored(spark):
    d = os.path.join(scratch(), "articles")
    for i in range(40):
        put(d, f"a{i:02d}.json", json.dumps([{"link": f"l{i}.{k}", "Text": "x", "Extra": k} for k in (0, 1)],
                                            indent=4 if i % 2 else None))
    before = tree(d)
    jobs.clean_dataset(spark, d, d)
    backup = d + "_backup"
    assert tree(backup) == before and len(before) == 40
    assert io.read_mixed_articles(spark, backup).count() == 80
    files.verify_files(spark, backup)
    restored = os.path.join(scratch(), "articles")
    files.copy_files(spark, backup, restored)
    assert tree(restored) == before


def test_copies_are_exact_and_replace_the_older(spark):
    d, t = scratch(), os.path.join(scratch(), "copy")
    put(d, "empty.bin", b"")
    put(d, "deep/er/raw.bin", bytes(range(256)) * 70_000)
    put(d, "sp ace%20é.txt", "no line end")
    put(t, "old.txt", "goes")
    manifest = {r["name"]: (r["length"], r["sha256"]) for r in files.copy_files(spark, d, t).collect()}
    assert tree(t) == tree(d)
    assert manifest == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in tree(d).items()}
    files.verify_files(spark, t)
    put(t, "empty.bin", b"changed")
    with pytest.raises(OSError):
        files.verify_files(spark, t)
    with pytest.raises(Exception):
        files.copy_files(spark, os.path.join(d, "missing"), t)
    assert "deep/er/raw.bin" in tree(t)


def reference(data):
    """The files that the crawler's own clean run leaves, for these articles."""
    for a in data:
        if isinstance(a, dict) and not a.get("_error") and a.get("Text"):
            a["Text"] = "body"
            if "May" in a["Link text"]:
                a["Publish Date"] = "May 1"
    return json.dumps(data, indent=4, ensure_ascii=False)


def test_clean_files_keep_what_the_cleaner_does_not_know(spark):
    d = os.path.join(scratch(), "articles")
    one = [{"Zeta": {"b": [1, 1.50, None], "a": "é "}, "link": "l1", "Text": "T\n\nPublished May 1\n\n**body**",
            "Link text": "May"}, 5, None, "text", [1, {"Text": "**x**"}], {},
           {"_error": "down", "Text": "**x**", "big": 12345678901234567890123, "Link text": ""},
           {"Text": "", "Link text": ""}, {"Text": "body", "Publish Date": "kept", "Link text": ""}]
    put(d, "one.json", json.dumps(one))
    put(d, "sub/two.json", json.dumps([{"Text": "**body**", "Link text": "", "x": True}], indent=2))
    put(d, "none.json", "[]")
    before = tree(d)
    stats = jobs.clean_json_files(spark, d, d).first().asDict()
    assert stats == {"total": 10, "cleaned": 3, "date_extracted": 1, "skipped_errors": 5, "skipped_no_text": 2}
    assert {n: b.decode() for n, b in tree(d).items()} == {
        n: reference(json.loads(b)) for n, b in before.items()}
    assert tree(d + "_backup") == before
    # cleaning is idempotent on these, and the files are of the form that splits
    jobs.clean_json_files(spark, d, d + "_again")
    assert tree(d + "_again") == tree(d)


def test_long_files_become_numbered_arrays(spark):
    d = os.path.join(scratch(), "out")
    rows = spark.range(0, 100).selectExpr("'sub/a.json' as name", "id + 7 as pos", "cast(id as string) as json")
    manifest = arrays.write_arrays(rows, d, bits=5).collect()
    assert sorted(r["name"] for r in manifest) == [f"sub/a-{i:06d}.json" for i in range(4)]
    assert [v for _, v in elements(spark, d)] == list(range(100))


def test_files_of_many_bytes_become_numbered_arrays(spark):
    d = os.path.join(scratch(), "out")
    rows = spark.range(0, 4000).selectExpr(
        "if(id % 4 = 0, 'b.json', 'sub/a.json') as name", "id - 3 as pos",
        "concat('\"', id, repeat('x', 100), '\"') as json")
    manifest = arrays.write_arrays(rows.repartition(7), d, most=50_000).collect()
    assert max(r["length"] for r in manifest) < 50_000 + 256 * 120      # no task writes more
    names = sorted(r["name"] for r in manifest)
    assert names == [*(f"b-{i:06d}.json" for i in range(3)), *(f"sub/a-{i:06d}.json" for i in range(7))]
    got = [json.loads(v) if isinstance(v, str) and v[0] == '"' else v for _, v in elements(spark, d)]
    want = [f"{i}" + "x" * 100 for i in range(4000) if i % 4 == 0] + [f"{i}" + "x" * 100 for i in range(4000) if i % 4]
    assert got == want


def test_a_split_changed_between_the_passes_raises(spark):
    d = scratch()
    path = put(d, "a.json", "[1,\n2]")
    df = arrays.read_elements(spark, path)
    put(d, "a.json", "[1,\n2]]")
    with pytest.raises(Exception):
        df.collect()
