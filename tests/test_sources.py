import os

from pyspark.sql import functions as F

from packetloom.schemas import ALERT, LABEL_ROW, PACKET, ensure_columns
from packetloom.session import settle, shared_root
from packetloom.sources import readers, writers


def write(path, text, age=0):
    path.write_text(text)
    stamp = 1_700_000_000 - age
    os.utime(path, (stamp, stamp))


def test_absent_paths_are_empty(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert readers.read_csv(spark, missing, PACKET).count() == 0
    assert readers.read_jsonl(spark, missing).columns == ALERT.names
    pool = readers.read_pool(spark, missing, PACKET, "local_normal")
    assert pool.count() == 0 and pool.columns[-2:] == ["__timestamp", "source_type"]
    assert readers.read_pool(spark, missing, PACKET, "local_normal", max_files=2).count() == 0
    assert writers.SnapshotTable(spark, missing, LABEL_ROW).load().count() == 0


def test_newest_files(spark, tmp_path):
    header = ",".join(PACKET.names)
    for i in range(4):
        write(tmp_path / f"f{i}.csv", f"{header}\n{i}.5,1.1.1.{i},2.2.2.2,TCP,60,S,64,0\n", age=i * 1000)
    write(tmp_path / "other.txt", "x")
    newest = readers.read_pool(spark, str(tmp_path), PACKET, "local_normal", max_files=2)
    got = {(r["src_ip"], r["__timestamp"], r["source_type"]) for r in newest.collect()}
    assert got == {("1.1.1.0", 1.7e9, "local_normal"), ("1.1.1.1", 1.7e9 - 1000, "local_normal")}
    assert readers.read_pool(spark, str(tmp_path), PACKET, "local_attack").count() == 4
    since = readers.read_pool(spark, str(tmp_path), PACKET, "local_normal", since="2023-11-14T21:50:00")
    assert since.count() == 2


def test_jsonl_skips_only_broken_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"src": "a", "risk_score": 1.5}\n{"src": "b", \nnonsense\n{"src": "c", "risk_score": "text"}\n{"src": "d"}\n')
    rows = {r["src"]: r["risk_score"] for r in readers.read_jsonl(spark, str(path)).collect()}
    assert rows == {"a": 1.5, "c": None, "d": None}
    assert "src" in readers.read_jsonl_inferred(spark, str(path)).columns


def test_nested_alert_explanations(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"src": "a", "shap_explanation": [{"feature": "x", "value": 1.0, "shap_value": 0.5, "impact": "Positive"}]}\n')
    got = readers.read_jsonl(spark, str(path)).select(F.inline("shap_explanation")).first()
    assert got["feature"] == "x" and got["impact"] == "Positive"


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.5, "a", None, "TCP", 60, None, 64, 0)], PACKET)
    writers.write_csv(df, str(tmp_path / "out"))
    assert readers.read_csv(spark, str(tmp_path / "out"), PACKET).collect() == df.collect()


def test_append_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("m", 0.5)], "model string, f1 double")
    for _ in range(2):
        writers.append_jsonl(df, str(tmp_path / "log"))
        writers.append_history(df, str(tmp_path / "history"), "2024-01-01")
        writers.write_report(df, str(tmp_path / "report"))
    counts = [spark.read.json(str(tmp_path / n)).count() for n in ("log", "history", "report")]
    assert counts == [2, 2, 1]


def test_parquet_snapshots(spark, tmp_path):
    store = writers.SnapshotTable(spark, str(tmp_path / "labels"), PACKET, "parquet")
    store.save(spark.createDataFrame([(1.5, "a", None, "TCP", 60, None, 64, 0)], PACKET))
    assert store.load().first()["src_ip"] == "a"


def test_alert_folders_have_few_files(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 16).select(F.timestamp_seconds(F.col("id") * 60).alias("at"), "id")
    writers.append_alerts(rows, str(tmp_path / "alerts"))
    folders = [f for f in (tmp_path / "alerts").iterdir() if f.name.startswith("dt=")]
    assert len(folders) == 3 and all(len(list(f.glob("*.parquet"))) <= 2 for f in folders)


def test_snapshot_table_reads_only_committed_versions(spark, tmp_path):
    store = writers.SnapshotTable(spark, str(tmp_path / "labels"), LABEL_ROW)
    base = ensure_columns(spark.createDataFrame([("f1",)], "flow_id string"), {"label": ("string", "NORMAL")})
    store.save(base)
    store.save(store.load().withColumn("label", F.lit("DoS")))
    spark.createDataFrame([("half",)], "flow_id string").write.json(str(tmp_path / "labels" / "version-000003-broken"))
    assert [r["label"] for r in store.load().collect()] == ["DoS"] and len(store.versions()) == 2


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = spark.range(10)
    assert settle(df).count() == 10



def test_requests(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"timestamp": 1.0, "src_ip": "a", "dst_ip": "b", "protocol": "TCP", "length": 60, "flags": "S"}\n')
    assert readers.read_requests(spark, str(path)).first()["length"] == 60
