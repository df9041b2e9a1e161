"""Incremental loads give the same rows as a batch run, once."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import reviews as review_ops, titles as title_ops
from marquee.sources.review_files import read_parts, read_raw_reviews
from marquee.streaming import loads


def write_reviews(spark, folder, first, last, index=False):
    for i in range(first, last):
        rows = spark.createDataFrame(
            [(f"/title/tt{i}/", f"text {i}\nline", str(i % 10), "14 August 2016", "t\n", f"/user/ur{j}/?x", f"{j} out of {i}")
             for j in range(3)],
            review_ops.RAW_REVIEW,
        )
        rows.toPandas().to_csv(f"{folder}/tt{i}.csv", index=index)


@pytest.mark.parametrize("index", [False, True])
def test_reviews_stream_equals_batch(spark, tmp_path, index):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_reviews(spark, raw, 0, 5, index)
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        query = loads.load_reviews(spark, str(raw), target, progress, parts=3, files_per_step=2)
        query.awaitTermination(120)
        assert query.exception() is None
        return len([p for p in query.recentProgress if p["numInputRows"]])

    def stored():
        return sorted(map(repr, spark.read.parquet(target).drop("part").collect()))

    def batch():
        named = read_raw_reviews(spark, str(raw))
        return sorted(map(repr, review_ops.clean_reviews(named).collect()))

    assert run() == 3
    assert stored() == batch() and len(stored()) == 15
    assert run() == 0
    write_reviews(spark, raw, 5, 7)
    run()
    assert stored() == batch() and len(stored()) == 21


def test_titles_log_keeps_the_last_record(spark, tmp_path):
    raw = tmp_path / "raw"
    log, progress = str(tmp_path / "log"), str(tmp_path / "progress")
    schema = title_ops.T.StructType([title_ops.T.StructField(n, title_ops.T.StringType()) for n in ("id", "original_title")])

    def load(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(raw))
        query = loads.load_titles(spark, str(raw), schema, log, progress)
        query.awaitTermination(120)
        assert query.exception() is None

    load([("a", "old"), ("b", "kept")])
    load([("a", "new"), ("c", None)])
    assert {tuple(r) for r in loads.current_titles(spark, log).collect()} == {("a", "new"), ("b", "kept"), ("c", None)}
    assert spark.read.parquet(log).agg(F.count("*")).first()[0] == 4


def test_refresh_takes_grown_rewritten_and_lost_files(spark, tmp_path, monkeypatch):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write_reviews(spark, raw, 0, 5)

    def stored():
        return sorted(map(repr, read_parts(spark, target).drop("part", "file").collect()))

    def batch():
        return sorted(map(repr, review_ops.clean_reviews(read_raw_reviews(spark, str(raw))).collect()))

    def refresh():
        return loads.refresh_reviews(spark, str(raw), target, parts=3, files_per_step=2)

    assert refresh() == 3 and stored() == batch() and len(stored()) == 15
    assert refresh() == 0
    # A file grows, a second file brings rows of a title that has some, one is emptied, one is lost.
    with open(raw / "tt1.csv", "a") as file:
        file.write('/title/tt1/,more,9,1 May 2001,x,/user/ur9/?x,1 out of 1\n')
    header = (raw / "tt2.csv").read_text().splitlines()[0]
    (raw / "extra.csv").write_text(f"{header}\n/title/tt2/,again,7,2 May 2001,y,/user/ur8/?x,2 out of 3\n")
    (raw / "tt3.csv").write_text(header + "\n")
    (raw / "tt4.csv").unlink()
    # The run dies before its second step is published, and is started again.
    publish, calls = loads.Manifests.publish, []

    def once(self, *args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return publish(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(loads.Manifests, "publish", once)
        with pytest.raises(RuntimeError, match="stopped"):
            refresh()
    assert refresh() >= 1
    assert stored() == batch() and len(stored()) == 11
    assert refresh() == 0


def test_fifty_steps_are_folded_into_few_files(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    expected, steps = {}, []
    for number in range(50):
        rows = [(f"t{number % 7}", f"name {number}", number), (f"only{number}", None, number)]
        expected |= {r[0]: r[1] for r in rows}
        steps.append(rows)

    def write(number):
        spark.createDataFrame(steps[number], "id string, name string, n int").coalesce(1).write.mode("overwrite").parquet(f"{log}/step={number}")

    def current():
        return {r["id"]: r["name"] for r in loads.current_titles(spark, log).collect()}

    for number in range(50):
        write(number)
        if number % 10 == 9:
            if number == 29:  # it dies when everything is written but the manifest
                with monkeypatch.context() as patch:
                    patch.setattr(loads.Manifests, "_rename", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
                    with pytest.raises(RuntimeError):
                        loads.compact_titles(spark, log, buckets=4)
            assert loads.compact_titles(spark, log, buckets=4)
            assert len(list((tmp_path / "log").glob("step=*"))) == 0
    assert current() == expected
    assert not loads.compact_titles(spark, log)
    # A step that had been folded in is repeated; a later one wins.
    write(49)
    spark.createDataFrame([("t0", "newest", 50)], "id string, name string, n int").write.parquet(f"{log}/step=50")
    assert current() == expected | {"t0": "newest"}
    assert len(list((tmp_path / "log").rglob("*.parquet"))) < 20
