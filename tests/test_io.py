import json
import os

import pytest

from reelkpi.operators.cleaning import clean_films
from reelkpi.schema import CLEAN_SCHEMA
from reelkpi.sources import landing
from reelkpi.sources.fixture import films_from_tables

SF = "/root/testdata/sf0.001"


def _sorted(df):
    return sorted(df.collect(), key=lambda r: r.id)


def test_raw_json_round_trip_keeps_records(spark, tmp_dir):
    raw = films_from_tables(spark, SF)
    path = os.path.join(tmp_dir, "raw")
    landing.write_raw_json(raw, path)
    back = landing.read_raw_json(spark, path)
    assert landing.rejects(back).groupBy("reason").count().collect() == []
    back = back.drop("_corrupt_record")
    assert back.schema.simpleString() == raw.schema.simpleString()
    assert _sorted(back) == _sorted(raw)


@pytest.mark.parametrize("header", [True, False])
def test_clean_csv_round_trip(spark, tmp_dir, header):
    clean = clean_films(films_from_tables(spark, SF))
    path = os.path.join(tmp_dir, "csv")
    landing.write_clean_csv(clean, path, header=header)
    assert _sorted(landing.read_clean_csv(spark, path, header=header)) == _sorted(clean)


TEXTS = ["", None, " ", "  padded\t", "two\nlines", "cr\rlf\r\nend\n", 'a "quoted", text', '"', '""', ",", "\\", "\\N",
         "\\\\N", "\\\\\\N", "N", "\\n", "x\\N", "null", "\ufeffé ☃", "'single'", "tab\tin", "#", "a\\\"b"]


@pytest.mark.parametrize("header", [True, False])
def test_csv_keeps_every_character(spark, tmp_dir, header):
    fields = {f.name: None for f in CLEAN_SCHEMA.fields}
    rows = [tuple({**fields, "id": i, "overview": t, "director": t, "roi": 0.5}.values()) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, CLEAN_SCHEMA)
    path = os.path.join(tmp_dir, "csv")
    landing.write_clean_csv(df, path, header=header)
    back = landing.read_clean_csv(spark, path, header=header)
    assert [(r.id, r.overview, r.director) for r in _sorted(back)] == [(i, t, t) for i, t in enumerate(TEXTS)]


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("first", ["a\r\nb", "x\r", "\r", "\n", "\r\n", "two\nlines\r"])
def test_csv_first_row_holds_line_breaks(spark, tmp_dir, header, first):
    """The first line break of a file is inside a value, in any form."""
    fields = {f.name: None for f in CLEAN_SCHEMA.fields}
    texts = [first, "plain", "cr\rlf\r\nend\n", "\r\n\r", None, ""]
    rows = [tuple({**fields, "id": i, "title": t, "overview": t}.values()) for i, t in enumerate(texts)]
    path = os.path.join(tmp_dir, "csv")
    landing.write_clean_csv(spark.createDataFrame(rows, CLEAN_SCHEMA).coalesce(1), path, header=header)
    back = landing.read_clean_csv(spark, path, header=header)
    assert [(r.id, r.title, r.overview) for r in _sorted(back)] == [(i, t, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("header", [True, False])
def test_csv_query_starts_each_file_with_a_carriage_return(spark, header):
    from reelkpi.plans.registry import QUERIES

    df = QUERIES["sink_clean_csv" if header else "sink_clean_csv_noheader"](spark, SF)
    head = {f: open(f.removeprefix("file://"), newline="").read(4000) for f in df.inputFiles()}
    assert head and all("\r\n" in h for h in head.values())


def test_csv_with_empty_nulls(spark, tmp_dir):
    df = clean_films(films_from_tables(spark, SF)).where("overview is null").limit(5)
    path = os.path.join(tmp_dir, "plain")
    landing.write_clean_csv(df, path, null_marker="")
    assert "\\N" not in "".join(r.value for r in spark.read.text(path).collect())


def test_rejects_are_kept_and_told_apart(spark, tmp_dir):
    path = os.path.join(tmp_dir, "landed")
    os.makedirs(path)
    lines = ['{"id": 1, "status": "Released"}', '{"id": 2, "status": "Rel', "not json", "",
             '{"id": 3, "status": "Released", "budget": "much"}', '{"id": "x4", "status": "Released"}',
             '{"status": "Released", "budget": "much"}', '[1, 2]']
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    raw = landing.read_raw_json(spark, path)
    got = sorted((r.id or 0, r.reason, r.line) for r in landing.rejects(raw).collect())
    assert got == [(0, "malformed", lines[7]), (0, "malformed", "not json"), (0, "mistyped", lines[5]),
                   (0, "mistyped", lines[6]), (2, "malformed", lines[1]), (3, "mistyped", lines[4])]
    assert sorted(r.id or 0 for r in clean_films(raw).collect()) == [0, 0, 1, 3]


def test_a_changed_input_gives_the_new_answer(spark, tmp_dir):
    from reelkpi.plans.registry import QUERIES

    sf = os.path.join(tmp_dir, "sf")
    for name in ("orders", "lineitem", "part", "supplier", "nation", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    before = QUERIES["clean_row_count"](spark, sf).first()[0]
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.withColumn("o_orderkey", orders.o_orderkey + 10_000_000).write.mode("append").parquet(f"{sf}/orders.parquet")
    assert QUERIES["clean_row_count"](spark, sf).first()[0] == 2 * before
    assert QUERIES["sink_clean_csv"](spark, sf).count() == 2 * before


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from reelkpi.session import shared_root

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *d: d[0] if d else "/warehouse"),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
    assert shared_root(session("local[4]")) == "/warehouse/reelkpi"
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError):
            shared_root(session(master))


def test_json_int_for_double_and_mistyped_field(spark, tmp_dir):
    path = os.path.join(tmp_dir, "landed")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write(json.dumps({"id": 1, "status": "Released", "popularity": 5, "vote_count": 3}) + "\n")
        f.write(json.dumps({"id": 2, "status": "Released", "popularity": 1.5, "vote_count": "many"}) + "\n")
    df = landing.read_raw_json(spark, path, keep_corrupt=True).cache()
    rows = {r.id: r for r in df.collect()}
    assert rows[1].popularity == 5.0 and rows[1]._corrupt_record is None
    assert rows[2].vote_count is None and "many" in rows[2]._corrupt_record


def test_materialize_writes_below_checkpoint_dir(spark):
    from reelkpi.session import shared_root

    df = spark.range(10)
    back = landing.materialize(df, "unit")
    assert back.count() == 10
    assert back.inputFiles()[0].replace("file://", "").replace("file:", "").startswith(
        shared_root(spark).replace("file://", "").replace("file:", ""))


def test_indented_array_export_is_read_with_multi_line(spark, tmp_dir):
    raw = films_from_tables(spark, SF).limit(20)
    records = [json.loads(j) for j in raw.toJSON().collect()]
    path = os.path.join(tmp_dir, "export")
    os.makedirs(path)
    with open(os.path.join(path, "films_raw.json"), "w") as f:
        json.dump(records, f, indent=4)
    back = landing.read_raw_json(spark, path, keep_corrupt=False, multi_line=True)
    assert _sorted(back) == _sorted(raw)


@pytest.mark.parametrize("name", ["source_raw_json", "sink_raw_json", "ingest_rejects"])
def test_landed_json_is_compressed_and_whole(spark, name):
    """The queries land every film as JSON lines in compressed files of bounded length."""
    from reelkpi.plans import registry
    from reelkpi.plans.registry import QUERIES, raw_films

    QUERIES[name](spark, SF).count()
    path = {"ingest_rejects": registry._landed_with_faults}.get(name, registry._landed_json)(spark, SF)
    files = [f for f in os.listdir(path.removeprefix("file://")) if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert spark.read.text(path).count() == raw_films(spark, SF).count()


def test_compressed_json_is_cut_into_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(landing, "JSON_FILE_ROWS", 100)
    raw = films_from_tables(spark, SF).limit(450).coalesce(1)
    path = os.path.join(tmp_dir, "raw")
    landing.write_raw_json(raw, path, compression="gzip")
    assert len([f for f in os.listdir(path) if f.endswith(".json.gz")]) == 5
    back = landing.read_raw_json(spark, path)
    assert back.count() == 450 and _sorted(back.drop("_corrupt_record")) == _sorted(raw)
