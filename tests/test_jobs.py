import json

import pytest

from playledger.__main__ import main
from playledger.schemas import REPLY
from playledger.sources import MissingTable, shared_folder
from tests.test_ingest import play


def test_jobs_from_pages_to_report(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    page = {"items": [play("2024-07-01T10:00:00.000Z", "s1")]}
    (tmp_path / "pages" / "1.json").write_text(json.dumps(page))
    payloads = {
        "song": ("s1", {"name": "One", "duration_ms": 120_000}),
        "album": ("a1", {"name": "Album", "images": []}),
        "artist": ("r1", {"name": "Artist", "images": []}),
    }
    for kind, (key, payload) in payloads.items():
        spark.createDataFrame(
            [(key, json.dumps(payload))], f"{kind}_id string, payload string"
        ).write.parquet(str(tmp_path / "entities" / kind))
    (tmp_path / "reply.txt").write_text("```json\n" + json.dumps(dict.fromkeys(REPLY.names, "hi")))

    def at(name):
        return str(tmp_path / name)

    common = ["--warehouse", at("warehouse"), "--topics", at("topics"), "--once"]
    main(["ingest", *common, "--pages", at("pages"), "--entities", at("entities"),
          "--checkpoint", at("c1")])
    main(["dispatch", *common, "--checkpoint", at("c2")])
    week = ["--warehouse", at("warehouse"), "--as-of", "2024-07-03"]
    main(["recap", *week, "--out", at("recap")])
    main(["report", *week, "--out", at("report"), "--replies", at("reply.txt")])

    recap = spark.read.parquet(at("recap")).filter("section_no = 1").collect()
    assert [(r["rank"], r.song_name, r.total_minute_listened) for r in recap] == [(1, "One", 2)]
    (report,) = spark.read.parquet(at("report")).collect()
    assert report.is_valid and "2m listened" in report.html


@pytest.mark.parametrize("args", [["recap", "--out", "x"],
                                  ["dispatch", "--warehouse", "w", "--checkpoint", "c"],
                                  ["recap", "--jdbc", "url=x", "--out", "x"]])
def test_missing_arguments(args):
    with pytest.raises(SystemExit):
        main(args)


def test_a_wrong_warehouse_is_an_error(spark, tmp_path):
    with pytest.raises(MissingTable, match="fact_history"):
        main(["recap", "--warehouse", str(tmp_path / "none"), "--as-of", "2024-07-03", "--out", str(tmp_path / "o")])


def test_only_a_local_session_gets_a_local_scratch_folder(spark):
    class Fake:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "local-cluster[2,1,1024]"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Fake, "x")
    Fake.sparkContext.master = "local[4]"
    assert "/x-" in shared_folder(Fake, "x")
