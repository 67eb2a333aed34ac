import pytest
from pyspark.sql import functions as F

from jurispark.sources.early import first_line, first_rows


@pytest.fixture
def folder(tmp_path):
    """Eight files of unequal size; some with a byte order mark, odd bytes, carriage returns, no last line end."""
    for i in range(8):
        lines = [f"{i}:{j} 张".encode() + (b"\xff" if j % 5 == 0 else b"") + (b"\r" if j % 7 == 0 else b"") for j in range(1 if i == 3 else 40 * (i + 1))]
        (tmp_path / f"part-{i}.txt").write_bytes((b"\xef\xbb\xbf" if i % 2 else b"") + b"\n".join(lines) + (b"\n" if i % 3 else b""))
    (tmp_path / "part-8.txt").write_bytes(b"")
    return tmp_path


@pytest.mark.parametrize("split", ["134217728", "700"])
@pytest.mark.parametrize("wanted", ["0:0", "1:33", "3:0", "7:319"])
def test_first_line_tells_its_place(spark, folder, wanted, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = first_line(spark, str(folder), F.col("value").startswith(f"{wanted} "), first=1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    i, j = map(int, wanted.split(":"))
    text = (folder / f"part-{i}.txt").read_bytes()
    at = text.index(f"{wanted} ".encode())
    assert (found.path.endswith(f"part-{i}.txt"), found.line, found.offset) == (True, j + 1, at)
    assert found.value.startswith(f"{wanted} 张")
    assert found.total_line == found.line + sum(1 if n == 3 else 40 * (n + 1) for n in range(i))
    assert found.files == 9 and found.files_read == (1 if i < 1 else 3 if i < 3 else 7 if i < 7 else 9)


def test_nothing_found_and_null_conditions(spark, folder):
    assert first_line(spark, str(folder), F.lit(None).cast("boolean")) is None
    assert first_line(spark, str(folder / "part-8.txt"), F.lit(True)) is None


def test_first_rows_stop_when_all_are_found(spark, folder):
    key = F.regexp_extract("value", r":(\d+)", 1)
    ask = lambda *ids: first_rows(spark, str(folder), key, spark.createDataFrame([(i,) for i in ids], "id string"), first=1)
    found, read = ask("0", "39", "39", None)
    assert read == 1 and {r.id: r.value[:4].strip() for r in found.collect()} == {"0": "0:0", "39": "0:39"}
    found, read = ask("5", "45")
    assert read == 3 and {r.id: r.path[-5] for r in found.collect()} == {"5": "0", "45": "1"}
    found, read = ask("none")
    assert read == 9 and found.count() == 0
    found, read = ask()
    assert read == 0 and found.count() == 0
