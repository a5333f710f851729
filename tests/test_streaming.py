import os

from reelkpi.operators.cleaning import clean_films
from reelkpi.sources import landing
from reelkpi.sources.fixture import films_from_tables
from reelkpi.streaming.landing_stream import start_clean_stream, start_reject_stream


def test_stream_cleaning_equals_batch(spark, tmp_dir):
    raw = films_from_tables(spark, "/root/testdata/sf0.001")
    land, out, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "out", "ckpt"))
    landing.write_raw_json(raw, land)

    q = start_clean_stream(spark, land, out, checkpoint=ckpt)
    q.awaitTermination(300)
    assert q.exception() is None

    streamed = sorted(spark.read.parquet(out).collect(), key=lambda r: r.id)
    batch = sorted(clean_films(raw).collect(), key=lambda r: r.id)
    assert streamed == batch

    # a restart over the same checkpoint adds nothing
    q2 = start_clean_stream(spark, land, out, checkpoint=ckpt)
    q2.awaitTermination(300)
    assert spark.read.parquet(out).count() == len(batch)


def test_stream_picks_up_new_files_exactly_once(spark, tmp_dir):
    raw = films_from_tables(spark, "/root/testdata/sf0.001")
    land, out, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "out", "ckpt"))
    first, second = raw.where("id % 2 = 0"), raw.where("id % 2 = 1")
    landing.write_raw_json(first, os.path.join(land, "batch1"))

    src = os.path.join(land, "*")
    q = start_clean_stream(spark, src, out, checkpoint=ckpt)
    q.awaitTermination(300)
    assert spark.read.parquet(out).count() == clean_films(first).count()

    landing.write_raw_json(second, os.path.join(land, "batch2"))
    q = start_clean_stream(spark, src, out, checkpoint=ckpt)
    q.awaitTermination(300)
    streamed = sorted(spark.read.parquet(out).collect(), key=lambda r: r.id)
    assert streamed == sorted(clean_films(raw).collect(), key=lambda r: r.id)


def test_restart_without_a_named_checkpoint_finds_new_files(spark, tmp_dir):
    raw = films_from_tables(spark, "/root/testdata/sf0.001")
    land, out = (os.path.join(tmp_dir, d) for d in ("landing", "out"))
    for k in range(3):
        landing.write_raw_json(raw.where(f"id % 3 = {k}"), os.path.join(land, f"batch{k}"))
        start_clean_stream(spark, os.path.join(land, "*"), out, max_files_per_trigger=2).awaitTermination(300)
        done = clean_films(raw.where(f"id % 3 <= {k}"))
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == sorted(r.id for r in done.collect())


def test_rejects_of_a_stream(spark, tmp_dir):
    land, out, bad = (os.path.join(tmp_dir, d) for d in ("landing", "out", "bad"))
    for k, lines in enumerate((['{"id": 1, "status": "Released"}', '{"id": 2, "sta'],
                               ["{]", '{"id": 3, "status": "Released", "runtime": "long"}'])):
        os.makedirs(land, exist_ok=True)
        with open(os.path.join(land, f"part-{k}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
        start_clean_stream(spark, land, out).awaitTermination(300)
        start_reject_stream(spark, land, bad).awaitTermination(300)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 3]
    assert sorted((r.id or 0, r.reason) for r in spark.read.parquet(bad).collect()) == [
        (0, "malformed"), (2, "malformed"), (3, "mistyped")]
