"""Round trips through files."""

import json

import pytest
from pyspark.sql import types as T, functions as F

from marquee.operators import reviews as review_ops
from marquee.sources import keyed_json, manifest, review_files
from marquee.sources.locations import Location

RECORD = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("links", T.MapType(T.StringType(), T.StringType())),
        T.StructField("n", T.IntegerType()),
    ]
)


def records(n):
    return {
        f"/title/tt{i}/": {"name": f'q"}},{{ {i}', "links": {"1": f"/title/tt{i + 1}/"} if i % 2 else {}, "n": i}
        for i in range(n)
    }


@pytest.mark.parametrize("prefix", [None, "/title/"])
def test_keyed_object(spark, tmp_path, prefix):
    text = json.dumps(records(300), separators=(",", ":")).replace("/", "\\/")
    (tmp_path / "one.json").write_text(text)
    reader = keyed_json.read_keyed(spark, str(tmp_path / "one.json"), RECORD, key_prefix=prefix)
    got = {r["id"]: (r["name"], r["links"], r["n"]) for r in reader.collect()}
    assert got == {k: (v["name"], v["links"], v["n"]) for k, v in records(300).items()}


def test_huge_keyed_object_is_split(spark, tmp_path):
    text = json.dumps(records(3000), separators=(",", ":")).replace("/", "\\/")
    (tmp_path / "one.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        reader = keyed_json.read_keyed(spark, str(tmp_path / "one.json"), RECORD, key_prefix="/title/")
        assert reader.rdd.getNumPartitions() > 4
        assert reader.select(F.sum("n"), F.count("*"), F.countDistinct("id")).first() == (3000 * 2999 // 2, 3000, 3000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_column_layout(spark, tmp_path):
    (tmp_path / "ids.json").write_text('{"main_genre":{"\\/title\\/a\\/":"Drama","\\/title\\/b\\/":null},"other":{"x":1}}')
    rows = keyed_json.read_by_column(spark, str(tmp_path), ["main_genre"]).collect()
    assert {tuple(r) for r in rows} == {("/title/a/", "Drama"), ("/title/b/", None)}


def test_keyed_lines_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", {"1": "b"}, 1), ("b", None, None, None)], "id string, name string, links map<string,string>, n int")
    keyed_json.write_keyed(rows, str(tmp_path / "out"))
    back = keyed_json.read_keyed_lines(spark, str(tmp_path / "out"), RECORD)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


RAW = [
    ("/title/tt1/", 'He said "no",\nthen left', "8", "14 August 2016", "a\n", "/user/ur1/?x", "1 out of 2"),
    ("/title/tt1/", None, None, "1 May 2001", "b, c", None, None),
    ("/title/tt2/", "plain", "3", "2 May 2001", "d", "/user/ur2/", "3 out of 4"),
]


def test_raw_review_files(spark, tmp_path):
    import pandas as pd

    table = pd.DataFrame(RAW, columns=review_ops.RAW_REVIEW.fieldNames())
    for name, group in table.groupby("id"):
        group.reset_index(drop=True).to_csv(tmp_path / f"{name.split('/')[-2]}.csv")
    rows = review_files.read_raw_reviews(spark, str(tmp_path))
    assert rows.columns == review_ops.RAW_REVIEW.fieldNames()
    assert {tuple(r) for r in rows.collect()} == set(RAW)


def test_id_from_the_file_name(spark, tmp_path):
    (tmp_path / "tt7.csv").write_text(",text,rating\n0,fine,8\n")
    assert review_files.read_raw_reviews(spark, str(tmp_path)).first()["id"] == "/title/tt7/"


def test_write_raw_reviews(spark, tmp_path):
    rows = spark.createDataFrame([(r[0].split("/")[-2], *r[1:]) for r in RAW], review_ops.RAW_REVIEW)
    review_files.write_raw_reviews(rows, str(tmp_path / "raw"))
    assert {p.name for p in (tmp_path / "raw").glob("title_id=*")} == {"title_id=tt1", "title_id=tt2"}
    back = review_files.read_raw_reviews(spark, str(tmp_path / "raw"))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in rows.collect()}


def spaced(value, rng):
    """JSON text with blanks wherever they may stand."""
    def gap():
        return rng.choice(["", "", " ", "\n", "\t ", "\r\n  "])

    if isinstance(value, dict):
        inside = (gap() + ",").join(gap() + json.dumps(k) + gap() + ":" + spaced(v, rng) for k, v in value.items())
        return gap() + "{" + inside + gap() + "}" + gap()
    if isinstance(value, list):
        return gap() + "[" + ",".join(spaced(v, rng) for v in value) + gap() + "]" + gap()
    return gap() + json.dumps(value, ensure_ascii=rng.random() < 0.5) + gap()


TRICKY = ['", "x": {', "}}}", "{{[", '\\', '\\"', 'a\\\\"},', "\n,\t", "é{ü", "", "]", "plain, text", '"', "{}", "},{"]


@pytest.fixture(params=[20, 83, 1 << 20])
def small_ranges(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_keyed_files_of_any_spacing_in_any_ranges(spark, tmp_path, small_ranges):
    import random

    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("inner", T.StructType([T.StructField("a", T.StringType())]))])
    expected = {}
    for seed in range(3):
        rng = random.Random(seed)
        made = {
            f'{rng.choice(["", "q}}", "k{", chr(34)])}{seed}-{i}': {
                "name": rng.choice(TRICKY), "tags": rng.sample(TRICKY, rng.randrange(3)), "inner": {"a": rng.choice(TRICKY)}
            }
            for i in range([7, 1, 0][seed])
        }
        (tmp_path / f"{seed}.json").write_text(spaced(made, rng) + "\n")
        expected |= made
    rows = keyed_json.read_keyed(spark, str(tmp_path), kind).collect()
    assert {r["id"]: (r["name"], r["tags"], r["inner"]["a"]) for r in rows} == {k: (v["name"], v["tags"], v["inner"]["a"]) for k, v in expected.items()}
    assert len(rows) == len(expected)


def test_column_files_of_any_spacing_in_any_ranges(spark, tmp_path, small_ranges):
    import random

    expected = {}
    for seed in range(3):
        rng = random.Random(10 + seed)
        ids = [f'{rng.choice(["", "q}}", ",", chr(34)])}{seed}-{i}' for i in range([6, 1, 0][seed])]
        made = {"empty": {}, **{f: {i: rng.choice([*TRICKY, None]) for i in ids} for f in ("genre", 'odd "name", {', "url")}, "n": {i: 5 for i in ids}}
        (tmp_path / f"{seed}.json").write_text(spaced(made, rng))
        expected |= {i: (made["genre"][i], made["url"][i], "5") for i in ids}
    # Objects one after the other in one file, as they are written row by row.
    (tmp_path / "lines.json").write_text('{"genre":{"x":"1"},"url":{"x":"2"}}\n{"genre":{"y":"}{"}}\n\n{"n":{"y":5}}')
    expected |= {"x": ("1", "2", None), "y": ("}{", None, "5")}
    rows = keyed_json.read_by_column(spark, str(tmp_path), ["genre", "url", "n"]).collect()
    assert {r["id"]: (r["genre"], r["url"], r["n"]) for r in rows} == expected and len(rows) == len(expected)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    from marquee.sources import json_ranges

    (tmp_path / "one.json").write_text(json.dumps(records(4000), indent=1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert json_ranges.pieces(spark, str(tmp_path), json_ranges.BY_ID).rdd.getNumPartitions() > 8
        rows = keyed_json.read_keyed_at(spark, Location("local", str(tmp_path)), "one.json", RECORD)
        assert rows.select(F.sum("n"), F.count("*"), F.countDistinct("id")).first() == (4000 * 3999 // 2, 4000, 4000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text", ['{"a": {"name": "x"}, "b": {"name": "y"', '{"a": {"name": "x"}', '{"a": {"name": "x'])
def test_a_file_that_ends_too_early_is_an_error(spark, tmp_path, text):
    (tmp_path / "one.json").write_text(text)
    with pytest.raises(Exception, match="ends within an object"):
        keyed_json.read_keyed(spark, str(tmp_path), RECORD).collect()


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_parts(spark, tmp_path, form):
    rows = spark.createDataFrame(RAW, review_ops.RAW_REVIEW)
    for name in ("tt1", "tt2"):
        part = rows.where(F.col("id") == f"/title/{name}/").toPandas()
        part.to_csv(tmp_path / f"{name}.csv", index=False)
    titles = spark.createDataFrame([("/title/tt1/",), ("/title/tt2/",), ("/title/tt3/",)], "id string")
    target = str(tmp_path / "out")
    review_files.run_reviews_job(spark, str(tmp_path / "*.csv"), titles, target, parts=4, form=form)
    stored = review_files.read_parts(spark, target).select("id", "part", "author")
    assert stored.count() == 3
    expected = {r["id"]: r["p"] for r in titles.select("id", review_ops.review_part(4).alias("p")).collect()}
    assert all(expected[r["id"]] == r["part"] for r in stored.collect())
    # A second run finds every partition finished and leaves the rows as they are.
    review_files.run_reviews_job(spark, str(tmp_path / "*.csv"), titles, target, parts=4, form=form)
    assert review_files.read_parts(spark, target).count() == 3
    assert len(list((tmp_path / "out").glob("run=*"))) == 1


def test_only_known_titles(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    kept = review_ops.reviews_of_titles(rows, spark.createDataFrame([("b",)], "id string"), 3).collect()
    assert [r["id"] for r in kept] == ["b"]


def pairs(spark, target):
    return sorted((r["id"], int(r["v"])) for r in review_files.read_parts(spark, target).collect())


def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    """Stopped after each of its steps, before the last of them."""
    target = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    review_files.write_parts(rows.where("v < 3"), target, 2)
    grown = rows.unionByName(spark.createDataFrame([("a", 9)], "id string, v int"))

    def die(*_):
        raise RuntimeError("stopped")

    def write_then_die(*args):
        written(*args)
        die()

    written, renamed = review_files._write_rows, review_files.Manifests._rename
    for owner, name, step in (
        (review_files, "_write_rows", die),
        (review_files, "_write_rows", write_then_die),
        (review_files.Manifests, "publish", die),
        (review_files.Manifests, "_rename", die),
    ):
        with monkeypatch.context() as patch:
            patch.setattr(owner, name, step)
            with pytest.raises(RuntimeError, match="stopped"):
                review_files.write_parts(grown, target, 2)
        assert pairs(spark, target) == [("a", 1), ("b", 2)]
    assert review_files.Manifests._rename is renamed
    # A later run that is given the new title only, then one with everything.
    review_files.write_parts(rows.where("v = 3"), target, 2)
    assert pairs(spark, target) == [("a", 1), ("b", 2), ("c", 3)]
    review_files.write_parts(grown, target, 2)
    assert pairs(spark, target) == [("a", 1), ("a", 9), ("b", 2), ("c", 3)]
    review_files.forget_old_runs(spark, target)
    assert pairs(spark, target) == [("a", 1), ("a", 9), ("b", 2), ("c", 3)]
    assert len(list((tmp_path / "out" / "_manifests").glob("*"))) == 1


def test_of_two_writers_one_is_told(spark, tmp_path):
    target = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1)], "id string, v int")
    review_files.write_parts(rows, target, 1)
    manifests = review_files.Manifests(spark, target)
    with pytest.raises(manifest.Conflict):
        manifests.publish({"parts": rows}, 0)
    assert pairs(spark, target) == [("a", 1)] and manifests.latest() == 1


def test_new_titles_of_a_finished_part_are_written(spark, tmp_path):
    target = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    assert review_files.read_parts(spark, target) is None and review_files.finished_titles(spark, target) is None
    review_files.write_parts(rows.where("v < 3"), target, 1)
    review_files.write_parts(rows, target, 1)
    assert pairs(spark, target) == [("a", 1), ("b", 2), ("c", 3)]
    with pytest.raises(ValueError, match="partitions"):
        review_files.write_parts(rows, target, 2)


@pytest.mark.parametrize("form", ["parquet", "csv"])
@pytest.mark.parametrize("parts", [1, 3])
def test_grown_and_removed_titles_and_batches_of_new_ones(spark, tmp_path, form, parts):
    target = str(tmp_path / "out")

    def run(*rows, gone=()):
        lost = spark.createDataFrame([(g,) for g in gone], "unit string") if gone else None
        review_files.write_parts(spark.createDataFrame(rows, "id string, v int"), target, parts, form, gone=lost)
        return pairs(spark, target)

    assert run(("a", 1), ("b", 2)) == [("a", 1), ("b", 2)]
    assert run(("a", 1), ("a", 7)) == [("a", 1), ("a", 7), ("b", 2)]  # grown
    assert run(("c", 3)) == [("a", 1), ("a", 7), ("b", 2), ("c", 3)]  # new titles only
    assert run(("a", 1)) == [("a", 1), ("b", 2), ("c", 3)]  # as it was at first
    assert run(("d", 4), ("b", 5), gone=("a", "b", "x")) == [("c", 3), ("d", 4)]  # removed, though one of them was given
    assert run(("b", 6)) == [("b", 6), ("c", 3), ("d", 4)]


@pytest.mark.parametrize("slash", ["/", "\\/"])
@pytest.mark.parametrize("separators", [(",", ":"), (", ", ": ")])
def test_keyed_object_in_every_form(spark, tmp_path, slash, separators):
    for n in (1, 5):
        (tmp_path / f"{n}.json").write_text(json.dumps(records(n), separators=separators).replace("/", slash))
        reader = keyed_json.read_keyed(spark, str(tmp_path / f"{n}.json"), RECORD, key_prefix="/title/")
        assert {r["id"]: r["name"] for r in reader.collect()} == {k: v["name"] for k, v in records(n).items()}


def test_formats_and_locations():
    with pytest.raises(ValueError):
        review_files.check_format("orc")
    assert Location("cloud", "bucket").path("reviews/x") == "s3a://bucket/reviews/x"
    assert Location("local", "/data/").path("/x") == "file:/data/x"
    with pytest.raises(ValueError):
        Location("ftp", "x")
    with pytest.raises(ValueError):
        Location("cloud", "")


def test_export_table(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0)], "id string, flag double")
    review_files.export_table(rows, str(tmp_path / "t"), {"flag": "smallint"})
    assert dict(spark.read.parquet(str(tmp_path / "t")).dtypes)["flag"] == "smallint"


def test_raw_reviews_are_stored_compressed(spark, tmp_path):
    rows = [("tt1", f'said "{i}",\nagain', "7", "2 May 2001", "y\n", "/user/ur8/?x", "2 out of 3") for i in range(50)]
    raw = spark.createDataFrame(rows, "id string, text string, rating string, date string, title string, author string, helpfulness string")
    target = str(tmp_path / "raw")
    review_files.write_raw_reviews(raw, target)
    files = [p for p in (tmp_path / "raw").rglob("part-*") if not p.name.endswith(".crc")]
    assert files and all(p.name.endswith(".csv.gz") for p in files)
    back = review_files.read_raw_reviews(spark, target)
    assert sorted(r["text"] for r in back.collect()) == sorted(r[1] for r in rows)
