import gzip
import shutil
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeworks.functions.pixels import select_channel
from ridgeworks.plans.hourly import clean_hourly, clean_hourly_csv
from ridgeworks.plans.images import image_sweep
from ridgeworks.plans.record import record_sweep
from ridgeworks.plans.sweep import ridge_sweep
from ridgeworks.sources import idx, images, tables


def write_idx(path, array):
    header = struct.pack(">HBB", 0, 8, array.ndim) + struct.pack(f">{array.ndim}I", *array.shape)
    body = header + array.astype(np.uint8).tobytes()
    path.write_bytes(gzip.compress(body) if str(path).endswith(".gz") else body)
    return str(path)


def write_png(path, pixels):
    """8-bit PNG, grey (h, w) or colour (h, w, 3 or 4) in red-green-blue(-alpha) order."""
    pixels = np.asarray(pixels, dtype=np.uint8)
    h, w = pixels.shape[:2]
    kind = 0 if pixels.ndim == 2 else {3: 2, 4: 6}[pixels.shape[2]]
    lines = b"".join(b"\0" + pixels[r].tobytes() for r in range(h))

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(lines))
        + chunk(b"IEND", b"")
    )


@pytest.mark.parametrize("suffix", ["", ".gz"])
def test_idx_images_and_labels(spark, tmp_path, suffix):
    rng = np.random.default_rng(0)
    pixels, labels = rng.integers(0, 256, (100, 4, 3)), rng.integers(0, 10, 100)
    images_path = write_idx(tmp_path / f"images{suffix}", pixels)
    labels_path = write_idx(tmp_path / f"labels{suffix}", labels)
    raw = idx.read_idx(spark, images_path, partition_bytes=12 * 30)
    assert raw.rdd.getNumPartitions() == (1 if suffix else 4)
    rows = idx.read_idx_images(spark, images_path, labels_path, partition_bytes=12 * 30).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(100))
    assert [r["label"] for r in rows] == labels.tolist()
    assert (np.array([r["features"] for r in rows]) == pixels.reshape(100, 12)).all()
    sweep = ridge_sweep(idx.read_idx_images(spark, images_path, labels_path), lambdas=[1.0])
    assert 0 <= sweep.first()["accuracy"] <= 1


def test_idx_labels_must_fit(spark, tmp_path):
    images_path = write_idx(tmp_path / "images", np.zeros((5, 2, 2)))
    labels_path = write_idx(tmp_path / "labels", np.zeros(4))
    with pytest.raises(Exception, match="one label for each of 5"):
        idx.read_idx_images(spark, images_path, labels_path).collect()
    (tmp_path / "short").write_bytes((tmp_path / "images").read_bytes()[:-1])
    with pytest.raises(Exception, match="ends early"):
        idx.read_idx(spark, str(tmp_path / "short")).collect()


def test_idx_labels_alone(spark, tmp_path):
    path = write_idx(tmp_path / "labels", np.arange(9))
    rows = idx.read_idx(spark, path, partition_bytes=4).orderBy("row_id").collect()
    assert [(r["row_id"], r["label"]) for r in rows] == [(i, i) for i in range(9)]


def test_idx_folder(spark, tmp_path):
    (tmp_path / "images").mkdir(), (tmp_path / "labels").mkdir()
    for name, n in (("a", 3), ("b", 0), ("c", 5)):
        write_idx(tmp_path / "images" / name, np.full((n, 2, 2), n))
        write_idx(tmp_path / "labels" / name, np.arange(n))
    (tmp_path / "images" / "_SUCCESS").write_bytes(b"")
    rows = idx.read_idx_images(spark, str(tmp_path / "images"), f"file:{tmp_path}/labels", partition_bytes=8)
    found = [tuple(r) for r in rows.orderBy("row_id").collect()]
    labels = [(3, i) for i in range(3)] + [(5, i) for i in range(5)]
    assert found == [(row, label, [n] * 4) for row, (n, label) in enumerate(labels)]
    write_idx(tmp_path / "images" / "d", np.zeros((1, 3, 3)))
    with pytest.raises(Exception, match="differ in shape"):
        idx.read_idx(spark, str(tmp_path / "images")).collect()


def test_features_must_be_finite(spark):
    rows = [(i, i % 2, [float(i), float("nan") if i == 7 else 1.0]) for i in range(20)]
    with pytest.raises(Exception, match="not finite"):
        ridge_sweep(spark.createDataFrame(rows, "row_id long, label int, features array<double>")).collect()


def test_idx_rejects_other_files(spark, tmp_path):
    path = tmp_path / "other"
    path.write_bytes(b"not an index file")
    with pytest.raises(Exception, match="IDX"):
        idx.read_idx(spark, str(path)).collect()


def test_image_layers_and_labels(spark, tmp_path):
    colour = np.zeros((2, 3, 3), int)
    colour[0, 0] = [255, 0, 0]
    colour[1, 2] = [128, 0, 0]
    colour[1, 1] = [0, 255, 255]
    write_png(tmp_path / "class_4" / "a.png", colour)
    grey = np.array([[0, 127, 128]])
    write_png(tmp_path / "class_12" / "b.png", grey)
    alpha = np.concatenate([colour, np.full((2, 3, 1), 255)], axis=2)
    write_png(tmp_path / "class_5" / "c.png", alpha)
    (tmp_path / "class_4" / "notes.txt").write_text("not an image")
    write_png(tmp_path / "elsewhere" / "d.png", grey)
    rows = images.image_vectors(images.read_image_tree(spark, str(tmp_path))).collect()
    found = {r["label"]: r["features"] for r in rows}
    assert found == {4: [1, 0, 0, 0, 0, 1], 12: [0, 0, 1], 5: [1, 0, 0, 0, 0, 1]}


def test_image_tree_to_sweep(spark, tmp_path):
    rng = np.random.default_rng(2)
    for label in range(3):
        for i in range(12):
            picture = rng.integers(0, 60, (12, 18))
            picture[:, 6 * label : 6 * label + 6] += 190
            write_png(tmp_path / f"class_{label}" / f"{i}.png", picture)
    rows = images.image_features(spark, str(tmp_path), (4, 6), seed=1)
    collected = rows.orderBy("row_id").collect()
    assert [r["row_id"] for r in collected] == list(range(36))
    assert all(len(r["features"]) == 24 and set(r["features"]) <= {0.0, 0.5, 1.0} for r in collected)
    assert [r["label"] for r in collected] != sorted(r["label"] for r in collected)
    result = image_sweep(spark, str(tmp_path), (4, 6), seed=1, lambdas=[0.1, 1.0])
    assert [r["accuracy"] for r in result.collect()] == [1.0, 1.0]
    by_position = ridge_sweep(rows, lambdas=[0.1, 1.0], drop_last=True, center="train")
    by_hash = image_sweep(
        spark, str(tmp_path), (4, 6), seed=1, lambdas=[0.1, 1.0], drop_last=True, center="train"
    )
    assert sorted(by_position.collect()) == sorted(by_hash.collect())


def test_rejected_files_have_a_reason(spark, tmp_path):
    grey = np.array([[0, 127, 128]])
    write_png(tmp_path / "tree" / "class_1" / "a b.png", grey)
    whole = (tmp_path / "tree" / "class_1" / "a b.png").read_bytes()
    (tmp_path / "tree" / "class_1" / "cut.png").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "tree" / "class_1" / "notes.txt").write_text("not an image")
    write_png(tmp_path / "tree" / "other" / "deep" / "d.png", grey)
    tree = images.ImageTree(spark, str(tmp_path / "tree"), None)
    assert [(r["name"], r["label"], r["features"]) for r in tree.vectors.collect()] == [("class_1/a b.png", 1, [0, 0, 1])]
    assert sorted((r["name"], r["reason"]) for r in tree.rejects.collect()) == [
        ("class_1/cut.png", images.UNREADABLE),
        ("class_1/notes.txt", images.UNREADABLE),
        ("other/deep/d.png", images.OUTSIDE),
    ]
    assert tree.counts() == (1, 3)


def test_a_copied_tree_is_split_alike(spark, tmp_path):
    rng = np.random.default_rng(4)
    for i in range(60):
        write_png(tmp_path / "one" / f"class_{i % 2}" / f"{i}.png", rng.integers(0, 256, (4, 6)))
    shutil.copytree(tmp_path / "one", tmp_path / "far" / "away" / "two")
    (tmp_path / "far" / "away" / "two" / "class_1" / "readme").write_text("no image")
    found = [
        sorted(map(tuple, image_sweep(spark, path, None, seed=3, lambdas=[0.1, 10.0]).collect()))
        for path in (str(tmp_path / "one"), f"file://{tmp_path}/far/away/two/")
    ]
    assert found[0] == found[1]
    counted = image_sweep(spark, str(tmp_path / "far"), None, counts=True, lambdas=[1.0]).first()
    assert (counted["images"], counted["rejected"]) == (60, 1)


def test_channels_of_images_of_many_sizes(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        c = int(rng.integers(1, 5))
        rows.append((i, bytes(rng.integers(0, 256, int(rng.integers(0, 30))).tolist()), c, int(rng.integers(0, c))))
    df = spark.createDataFrame(rows, "i long, data binary, c int, k int")
    found = df.select("i", select_channel(F.col("data"), F.col("c"), F.col("k")).alias("v")).collect()
    for r in found:
        _, data, c, k = rows[r["i"]]
        assert r["v"] == list(data[: len(data) // c * c][k::c])


def test_csv_headers_with_blanks(spark, tmp_path):
    path = tmp_path / "runs.csv"
    path.write_text("thread, tp, tMPI, t_tot\n1,77.5, 11.5,88.5\n2, 39.9,12.9,NA")
    df = tables.read_csv(spark, str(path), "threads int, parallel_s double, overhead_s double, total_s double")
    assert [tuple(r) for r in df.collect()] == [(1, 77.5, 11.5, 88.5), (2, 39.9, 12.9, None)]


def test_log_clean_up_and_csv_round_trip(spark, tmp_path):
    log = tmp_path / "readings.log"
    log.write_text(
        "12/03/14 01:00  AM 55.5 1 2 3 4\n  12/03/2014\t13:00 PM NoData 1 2 3 4\n\n1/1/2014 2:00 AM -999 1 2 3 4\n"
    )
    cleaned = clean_hourly(tables.read_log(spark, str(log)))
    expected = [("2014-03-12", 1.0, 55.5), ("2014-03-12", 13.0, None), ("2014-01-01", 2.0, None)]
    assert [tuple(r) for r in cleaned.collect()] == expected
    tables.write_csv(cleaned, str(tmp_path / "out"))
    back = tables.read_csv(spark, str(tmp_path / "out"), "DATES string, HH double, pm25 double")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(expected, key=str)
    tables.write_csv(cleaned, str(tmp_path / "numbered"), number_by="HH")
    back = tables.read_csv(spark, str(tmp_path / "numbered"), "row int, DATES string, HH double, pm25 double")
    assert sorted((r["row"], r["HH"]) for r in back.collect()) == [(1, 1.0), (2, 2.0), (3, 13.0)]


def test_csv_clean_up(spark, tmp_path):
    path = tmp_path / "readings.csv"
    path.write_text("DATES,HH,PM2.5\n12/03/14,5,-999\n1/2/15,23,7.25\n")
    raw = tables.read_csv(spark, str(path), "DATES string, HH string, `PM2.5` string")
    rows = [tuple(r) for r in clean_hourly_csv(raw).collect()]
    assert rows == [("2014-12-03", 5.0, None), ("2015-01-02", 23.0, 7.25)]


def test_a_run_is_recorded_once(spark, tmp_path):
    path = str(tmp_path / "results")
    rows = spark.createDataFrame([(i, i % 2, [float(i % 2), 1.0]) for i in range(20)], "row_id long, label int, features array<double>")
    first = record_sweep(rows, path, "a", lambdas=[1.0, 2.0]).first()
    record_sweep(rows, path, "b", lambdas=[2.0], drop_last=True)
    record_sweep(rows, path, "a", lambdas=[1.0, 2.0])
    found = sorted(tables.read_results(spark, path, runs=True).collect(), key=lambda r: r["run"])
    assert [(r["run"], r["n"], r["lambda"], r["accuracy"]) for r in found] == [("a", 20, 1.0, 1.0), ("b", 20, 2.0, 1.0)]
    assert all(r["elapsed_s"] > 0 for r in [*found, first])
    one = spark.createDataFrame([(0, 0, [1.0])], "row_id long, label int, features array<double>")
    empty = record_sweep(one, str(tmp_path / "more"), "c", drop_last=True).first()
    assert (empty["n"], empty["accuracy"], empty["lambda"]) == (1, None, None)


def test_results_are_appended(spark, tmp_path):
    path = str(tmp_path / "results")
    for n in (1000, 11000):
        row = spark.range(1).select(
            F.lit(n).alias("n"), F.lit(0.85).alias("accuracy"), F.lit(0.1).alias("lambda"), F.lit(2).alias("elapsed_s")
        )
        tables.append_results(row, path)
    found = spark.read.parquet(path).orderBy("n").collect()
    assert [tuple(r) for r in found] == [(1000, 0.85, 0.1, 2.0), (11000, 0.85, 0.1, 2.0)]
