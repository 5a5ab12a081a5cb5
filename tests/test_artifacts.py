import json
import os
import tempfile

from panelcast.sources import store as ST


def test_artifacts_written_and_read_back(spark):
    out = tempfile.mkdtemp(prefix="panelcast-art-")
    preds = spark.createDataFrame(
        [("2026-01-01", 1, 0.6, 1), ("2026-01-02", 0, 0.4, 0)], "trade_date string, y_true int, up_prob double, y_pred int"
    )
    metrics = spark.createDataFrame([(1.0, 1.0, [[1, 0], [0, 1]])], "accuracy double, f1 double, confusion_matrix array<array<bigint>>")
    scaler = spark.createDataFrame([(f"f{i}", 0.0, 1.0) for i in range(9)], "feature string, mean double, scale double")
    ST.write_table(preds, f"{out}/predictions", fmt="csv")
    ST.write_records(metrics, f"{out}/metrics")
    ST.write_table(scaler, f"{out}/scaler")
    assert spark.read.option("header", True).csv(f"{out}/predictions").count() == 2
    rec = [json.loads(l) for f in os.listdir(f"{out}/metrics") if f.endswith(".json") for l in open(f"{out}/metrics/{f}")]
    assert rec[0]["confusion_matrix"] == [[1, 0], [0, 1]]
    assert spark.read.parquet(f"{out}/scaler").count() == 9
    fp1 = ST.table_fingerprint(preds).first()
    fp2 = ST.table_fingerprint(preds.orderBy("up_prob").repartition(3)).first()
    assert fp1 == fp2
