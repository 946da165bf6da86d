import pytest
from pyspark.sql import functions as F

from oddlens.sources import StageStore, load_metadata, load_table, read_trial_log, restore_split, write_metric_csv, write_partitioned


def test_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.123456789), (2, "b", None)], "id int, t string, v double")
    write_metric_csv(df, str(tmp_path / "m.csv"))
    back = load_table(spark, str(tmp_path / "m.csv")).orderBy("id").collect()
    assert back[0].v == 0.12346 and back[1].v is None
    write_partitioned(df.withColumn("dataset", F.lit("train")), str(tmp_path / "p.parquet"))
    read = load_table(spark, str(tmp_path / "p.parquet"))
    assert load_metadata(read, "x/p.parquet").first().row_count == 2
    with pytest.raises(ValueError):
        load_table(spark, "table.xlsx")


def test_csv_encoding(spark, tmp_path):
    (tmp_path / "g.csv").write_bytes("id,名\n1,中\n".encode("gbk"))
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        assert load_table(spark, str(tmp_path / "g.csv"), encoding="GBK").columns == ["id", "名"]
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_trial_log_skips_bad_lines(spark, tmp_path):
    lines = [
        '{"iteration": 2, "status": "complete", "metrics": {"validate": {"ks": 0.3}}}',
        '{"iteration": 1, "accepted": true, "parameters": {"max_depth": "3"}}',
        '{"iteration": "3"}',
        '{"status": "no number"}',
        '{"iteration": 4, "stat',
        "",
    ]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    rows = read_trial_log(spark, str(tmp_path / "log.jsonl")).collect()
    assert [r.iteration for r in rows] == [1.0, 2.0] and rows[1].metrics["validate"]["ks"] == 0.3


def test_restore_split(spark):
    df = spark.createDataFrame([(1, "2025-01-03"), (2, "20250203"), (3, None), (4, "202503")], "id int, d string")
    rows = {r.id: r.dataset for r in restore_split(df, "d", {"202501": "train", "202502": "oot"}).collect()}
    assert rows == {1: "train", 2: "oot"}


def test_stage_store(spark):
    store = StageStore(spark)
    store.put("a", spark.range(5))
    assert "a" in store and store.get("a").count() == 5
    with pytest.raises(ValueError):
        store.put("a", spark.range(1))
    store.drop_all()
    assert "a" not in store
