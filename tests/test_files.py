"""Readers and writers round-trip through a temporary folder."""

import json
import struct

import numpy as np
import pytest

from mortarline import schemas as S
from mortarline.operators import modelfiles as B
from mortarline.sources import readers as R
from mortarline.sources import writers as W
from mortarline.streaming import monitors as X


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","prompt":"p"}\n\n  \n{bad\n{"id":"2"}\n')
    good, bad = R.read_jsonl(spark, str(tmp_path), S.EVAL_CASE)
    assert sorted(r["id"] for r in good.collect()) == ["1", "2"]
    assert [r["value"] for r in bad.collect()] == ["{bad"]
    with pytest.raises(Exception):
        R.read_jsonl(spark, str(tmp_path), S.EVAL_CASE, strict=True)[0].collect()


def test_result_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "failure_reason": null}, {"id": 2}]')
    (tmp_path / "b.json").write_text('{"results": [{"id": 3}]}')
    (tmp_path / "c.json").write_text('{"id": 4,\n "errors": []}')
    (tmp_path / "d.json").write_text("{broken")
    (tmp_path / "e.json").write_text('{"per_case_results": [{"id": 5}, {"id": 6}]}')
    entries, rejected = R.read_results(spark, str(tmp_path))
    rows = sorted((r["source_file"], r["entry_pos"], json.loads(r["entry"])) for r in entries.collect())
    assert [r[2].get("id") for r in rows] == [1, 2, 3, 4, None]
    assert "failure_reason" in rows[0][2] and rows[3][2]["errors"] == []
    assert [r["source_file"] for r in rejected.collect()] == ["d.json"]
    entries, _ = R.read_results(spark, str(tmp_path), accept_case_results=True)
    assert entries.count() == 6


def test_model_files(spark, tmp_path):
    rows = [("m1", c, float(x), 24.0, 0.25, "1 0 0 0 1 0 0 0 1", "3001.dat", "walls") for c, x in [(4, 10.0), (5, 30.5)]]
    placed = spark.createDataFrame(rows, "model string, color int, x double, y double, z double, rot string, part string, submodel string")
    W.write_models(B.framed_lines(placed, ["x"], author="tester"), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out" / "model=m1").glob("part-*.txt"))).splitlines()
    assert text[:6] == ["0 FILE m1.ldr", "0 m1", "0 Name: m1.ldr", "0 Author: tester", "0 !LDRAW_ORG Model", ""]
    assert text[6:9] == ["1 16 0 0 0 1 0 0 0 1 0 0 0 1 walls.ldr", "0 NOFILE", ""]
    assert sorted(text[-4:-2]) == ["1 4 10 24 0.2 1 0 0 0 1 0 0 0 1 3001.dat", "1 5 30.5 24 0.2 1 0 0 0 1 0 0 0 1 3001.dat"]
    assert text[-2:] == ["0 STEP", "0 NOFILE"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "A.LDR").write_text("\n".join(text))
    (folder / "skip.txt").write_text("1 x")
    back = R.read_model_lines(spark, str(folder))
    assert {r["model"] for r in back.collect()} == {"A.LDR"}
    report = B.validate(back).collect()[0]
    assert (report["file_count"], report["nofile_count"], report["submodels"], report["bad_refs"]) == (2, 2, "PASS", 0)
    assert B.parse_placements(back).count() == 3


def test_features_labels_thresholds(spark, tmp_path):
    rows = [("a.ldr", 0.5, 1, 2.0, 0.0, 1)]
    df = spark.createDataFrame(rows, "filename string, overhang_ratio double, collision_count int, height_to_base_ratio double, layer_density double, label int")
    W.write_features(df, str(tmp_path / "f"), S.FEATURE_COLUMNS)
    back = R.read_features(spark, str(tmp_path / "f"), None)
    assert back.columns == S.FEATURE_COLUMNS and back.collect()[0]["overhang_ratio"] == 0.5
    (tmp_path / "l.csv").write_text("filename,label\na.ldr,1\n")
    assert [tuple(r) for r in R.read_labels(spark, str(tmp_path / "l.csv")).collect()] == [("a.ldr", 1)]
    (tmp_path / "t.json").write_text('{"fluency": 0.85,\n "safety_pass_rate": 1.0}')
    assert dict(map(tuple, R.read_thresholds(spark, str(tmp_path / "t.json")).collect())) == {"fluency": 0.85, "safety_pass_rate": 1.0}


def test_reports_versions_metrics(spark, tmp_path):
    df = spark.createDataFrame([("f", None)], "feature string, psi double")
    W.write_report(df, str(tmp_path / "r"))
    assert json.loads(spark.read.text(str(tmp_path / "r")).collect()[0]["value"]) == {"feature": "f", "psi": None}
    assert [W.publish_version(spark, df, str(tmp_path / "v")) for _ in range(3)] == [1, 2, 3]
    assert spark.read.parquet(str(tmp_path / "v")).count() == 3
    metric = spark.createDataFrame([("max_psi", 0.5, {"a": "b"})], "name string, value double, dims map<string,string>")
    for day in ("2024-01-01 01:00:00", "2024-01-02 01:00:00"):
        W.append_metrics(metric, str(tmp_path / "m"), day)
    log = R.read_telemetry(spark, str(tmp_path / "m"), "customMetrics")
    assert log.count() == 2
    stream = R.read_telemetry(spark, str(tmp_path / "m"), "customMetrics", stream=True)
    assert X.run_available(stream, mode="append").count() == 2


def test_json_array_and_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"prompt": "p", "spec": {"height": 3, "features": ["a"]}}]')
    assert R.read_json_array(spark, str(tmp_path / "s.json"), S.SPEC_EXAMPLE).collect()[0]["spec"]["height"] == 3
    (tmp_path / "d.md").write_text("line 1\nline 2")
    assert [r["text"] for r in R.read_documents(spark, str(tmp_path), "*.md").collect()] == ["line 1\nline 2"]


def bmp(pixels: np.ndarray) -> bytes:
    h, w, _ = pixels.shape
    pad = b"\0" * (-w * 3 % 4)
    body = b"".join(pixels[y, :, ::-1].tobytes() + pad for y in reversed(range(h)))
    head = struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def test_images(spark, tmp_path):
    pixels = np.zeros((4, 8, 3), dtype=np.uint8)
    pixels[:, 4:, 0] = 255
    for label in ("brick", "glass"):
        (tmp_path / label).mkdir()
        (tmp_path / label / "x.bmp").write_bytes(bmp(pixels))
    (tmp_path / "glass" / "broken.bmp").write_bytes(b"no image")
    images = R.read_images(spark, str(tmp_path))
    rows = R.flat_pixels(images).collect()
    assert sorted(r["label"] for r in rows) == ["brick", "glass"]
    flat = np.array(rows[0]["features"]).reshape(64, 64, 3)
    assert flat[:, :32].sum() == 0 and (flat[:, 32:, 0] == 255).all() and flat[:, :, 1:].sum() == 0
    f = R.image_features(images).collect()[0]
    assert (f["image_width"], f["image_height"], f["color_histogram_r"]) == (8.0, 4.0, 0.5)
    assert f["edge_density"] == pytest.approx(1 / 7)
