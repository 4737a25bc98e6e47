"""What cannot be read is counted, not skipped."""

import pytest

from wattlake.sources import rejects, sinks

SCHEMA = "id long, v double"


def test_bad_records_of_json_and_csv(spark, tmp_path):
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "a.json").write_text('{"id": 1, "v": 1.5}\n{"id": 2, "v": oops}\nnot json\n\n{"id": 3}\n')
    (tmp_path / "json" / "b.json").write_bytes(bytes(range(1, 200)))
    rows, bad = rejects.read_with_rejects(spark, str(tmp_path / "json"), SCHEMA, "json")
    assert sorted((r.id, r.v) for r in rows.collect()) == [(1, 1.5), (3, None)]
    found = bad.collect()
    assert {"not json", '{"id": 2, "v": oops}'} <= {r.record for r in found} and {r.path.rsplit("/", 1)[-1] for r in found} == {"a.json", "b.json"}
    assert rejects.reject_counts(bad).first().files == 2
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("id,v\n1,1.5\n2,oops\n3,3.5,9\n4,\n")
    rows, bad = rejects.read_with_rejects(spark, str(tmp_path / "csv"), SCHEMA, "csv", header=True)
    assert sorted((r.id, r.v) for r in rows.select("id", "v").collect()) == [(1, 1.5), (4, None)]
    assert sorted(r.id for r in rows.select("id").collect()) == [1, 4]  # whatever columns are asked for
    assert sorted(r.record for r in bad.collect()) == ["2,oops", "3,3.5,9"]


def test_bad_parquet_files(spark, tmp_path):
    folder = str(tmp_path / "p")
    spark.range(10).selectExpr("id", "cast(id AS double) AS v").repartition(3).write.parquet(folder)
    spark.range(0).selectExpr("id", "cast(id AS double) AS v").write.mode("append").parquet(folder)  # empty is no fault
    (tmp_path / "p" / "broken.parquet").write_bytes(b"PAR1 this is no footer")
    (tmp_path / "p" / "nothing.parquet").write_bytes(b"")
    rows, bad = rejects.read_with_rejects(spark, folder, SCHEMA)
    assert rows.count() == 10
    found = bad.collect()
    assert sorted(r.path.rsplit("/", 1)[-1] for r in found) == ["broken.parquet", "nothing.parquet"]
    assert all(r.reason.startswith(rejects.BAD_FILE) for r in found)
    sinks.append_quarantine(bad, f"{folder}-quarantine", "r1")
    assert spark.read.parquet(f"{folder}-quarantine").count() == 2


def test_nothing_there_and_nothing_wrong(spark, tmp_path):
    rows, bad = rejects.read_with_rejects(spark, str(tmp_path / "none"), SCHEMA)
    assert rows.count() == 0 and bad.count() == 0
    folder = str(tmp_path / "q")
    spark.range(5).selectExpr("id", "0.5D AS v").write.parquet(folder)
    rows, bad = rejects.read_with_rejects(spark, folder, SCHEMA)
    assert rows.count() == 5 and bad.count() == 0
    with pytest.raises(ValueError):
        rejects.read_with_rejects(spark, folder, SCHEMA, "xlsx")
