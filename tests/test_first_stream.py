"""First-wins over a stream that stops and goes on, against one batch."""

import json
import os

from jurispark.streaming.first import first_wins, first_wins_stream

SCHEMA = "title string, revid long, note string"


def put(folder, k, rows):
    path = folder / f"{k:03d}.json"
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))
    os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def run(spark, base):
    query = first_wins_stream(spark, str(base / "in"), SCHEMA, str(base / "out"), str(base / "state"), key="title", order="revid", otherwise="revid", files_per_batch=1)
    query.awaitTermination()


def test_a_stop_between_batches(spark, tmp_path):
    rows = [{"title": ["甲", "hot", "hot", "", None, f"t{i % 11}"][i % 6], "revid": i, "note": f"n{i}"} for i in range(120)]
    seen, wanted = set(), []
    for r in rows:
        key = r["title"] or f"revid:{r['revid']}"
        if key not in seen:
            seen.add(key)
            wanted.append((r["title"], r["revid"], r["note"]))
    (tmp_path / "in").mkdir()
    files = [rows[i : i + 30][::-1] for i in range(0, 120, 30)]
    for k, part in enumerate(files[:2]):
        put(tmp_path / "in", k, part)
    run(spark, tmp_path)
    for k, part in enumerate(files[2:], 2):
        put(tmp_path / "in", k, part)
    run(spark, tmp_path)
    run(spark, tmp_path)
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(map(str, ((r.title, r.revid, r.note) for r in found))) == sorted(map(str, wanted))


def test_no_code_runs_key_by_key(spark, tmp_path):
    """A Python call for each key made the time of a stream that of its keys; least rows are kept whatever batch they lie in."""
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", 0, [{"title": f"t{i % 5}", "revid": 1000 - i, "note": ""} for i in range(1000)])
    found = first_wins(spark.readStream.schema(SCHEMA).json(str(tmp_path / "in")), "title", "revid")
    assert "WithState" not in found._jdf.queryExecution().logical().toString()
    run(spark, tmp_path)
    assert sorted(r.revid for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4, 5]
