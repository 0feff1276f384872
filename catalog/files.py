"""Readers and writers, through tables kept in the shared checkpoint folder."""

from __future__ import annotations

import struct
import zlib
from functools import partial

import pyarrow as pa
from pyspark.sql import functions as F

from catalog import features, models
from catalog.common import VECTORS, table, vectors
from catalog.hourly import CLEAN, log_lines
from catalog.ridge_sql import accuracy_ctes, weights_ctes
from ridgeworks.plans import images
from ridgeworks.plans.hourly import clean_hourly
from ridgeworks.plans.record import record_sweep
from ridgeworks.session import shared_path
from ridgeworks.sources.idx import place_of, read_idx_images
from ridgeworks.sources.images import ImageTree, image_vectors, read_image_tree
from ridgeworks.sources.tables import append_results, read_csv, read_log, read_results, write_csv


def csv_numbered(spark, folder):
    """Orders written as CSV with row numbers in key order, and read back."""
    orders = table(spark, folder, "orders")
    missing = F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_totalprice"))
    rows = orders.select("o_orderkey", "o_orderpriority", missing.alias("price"))
    path = shared_path(spark, "orders-csv")
    write_csv(rows, path, number_by="o_orderkey")
    return read_csv(spark, path, "row long, o_orderkey long, o_orderpriority string, price double")


def csv_plain(spark, folder):
    """The supplier table written as CSV without row numbers, and read back."""
    rows = table(spark, folder, "supplier")
    path = shared_path(spark, "supplier-csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


def log_file(spark, folder):
    """Log lines written as text, read as a log and cleaned."""
    path = shared_path(spark, "hourly-log")
    log_lines(spark, folder).write.text(path)
    return clean_hourly(read_log(spark, path))


def results_appended(spark, folder):
    """Result rows added to one table in two goes."""
    events = table(spark, folder, "events")
    rows = events.select(
        F.col("event_id").alias("n"),
        (F.col("value") / 1000).alias("accuracy"),
        F.lit(0.5).alias("lambda"),
        F.col("value").alias("elapsed_s"),
    )
    path = shared_path(spark, "results")
    early = events.agg((F.count("*") / 2).cast("long")).first()[0]
    append_results(rows.where(F.col("n") < early), path)
    append_results(rows.where(F.col("n") >= early), path)
    return spark.read.parquet(path).withColumnRenamed("lambda", "lam")


def sweep_recorded(spark, folder):
    """The outcome of a sweep in a result table; the first run is made twice and leaves one row."""
    path = shared_path(spark, "recorded")
    rows = vectors(spark, folder)
    for run, options in (("whole", {}), ("whole", {}), ("drop", {"drop_last": True})):
        record_sweep(rows, path, run, columns=VECTORS, **options)
    found = read_results(spark, path, runs=True).where(F.col("elapsed_s") > 0)
    return found.select("run", "n", F.round("lambda", 9).alias("lam"), F.round("accuracy", 6).alias("accuracy"))


def _put(path, body):
    where, inner = place_of(path)
    where.create_dir(inner.rsplit("/", 1)[0])
    with where.open_output_stream(inner) as stream:
        stream.write(body)


def _write_idx(path, part):
    """One image file of 8 x 8 pixels and its label file; the rows in order of vec_id."""
    part = part.sort_by("vec_id")
    name, n = f"{part.column('part')[0].as_py():09d}", part.num_rows
    pixels = b"".join(bytes(x) for x in part.column("pixels").to_pylist())
    _put(f"{path}/images/{name}", struct.pack(">HBB3I", 0, 8, 3, n, 8, 8) + pixels)
    _put(f"{path}/labels/{name}", struct.pack(">HBBI", 0, 8, 1, n) + bytes(part.column("label").to_pylist()))
    return pa.table({"n": pa.array([n], pa.int64())})


def _pixels():
    return F.transform("embedding", lambda x: F.pmod(F.floor(x.cast("double") * 65536), F.lit(256)).cast("int"))


def idx_images(spark, folder):
    """Embeddings written by tasks as a folder of IDX images and one of labels, 256 rows a file, and read."""
    path = shared_path(spark, "idx")
    rows = table(spark, folder, "embeddings").select("vec_id", "label", _pixels().alias("pixels"))
    parts = rows.withColumn("part", F.floor(F.col("vec_id") / 256)).groupBy("part")
    parts.applyInArrow(partial(_write_idx, path), "n long").agg(F.sum("n")).collect()
    read = read_idx_images(spark, f"{path}/images", f"{path}/labels")
    return read.select("row_id", "label", F.posexplode("features").alias("pos", "v"))


def _png(width, height, pixels):
    """An 8-bit red-green-blue PNG file."""
    lines = b"".join(b"\0" + pixels[i : i + 3 * width] for i in range(0, 3 * width * height, 3 * width))

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def _write_pngs(path, batches):
    for batch in batches:
        for name, red in zip(batch.column("name").to_pylist(), batch.column("pixels").to_pylist(), strict=True):
            _put(f"{path}/{name}", _png(8, 8, b"".join(bytes([v, v // 2, 255 - v]) for v in red)))
        yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})


def _image_rows(spark, folder):
    name = F.concat(F.lit("class_"), F.col("label"), F.lit("/"), F.col("vec_id"), F.lit(".png")).alias("name")
    return table(spark, folder, "embeddings").select("vec_id", name, _pixels().alias("pixels"))


def image_tree(spark, folder):
    """A tree of PNG files, one per embedding, written by tasks and read to black and white vectors."""
    path = shared_path(spark, "images")
    _image_rows(spark, folder).mapInArrow(partial(_write_pngs, path), "n long").agg(F.sum("n")).collect()
    found = image_vectors(read_image_tree(spark, path), (4, 6))
    vec_id = F.regexp_extract("name", "/([0-9]+)[.]png$", 1).cast("long").alias("vec_id")
    return found.select(vec_id, "label", F.posexplode("features").alias("pos", "v"))


def _write_others(path, batches):
    """Files that are no examples: a text among the images, and an image beside the classes."""
    for batch in batches:
        for vec_id in batch.column("vec_id").to_pylist():
            _put(f"{path}/class_0/{vec_id}.txt", b"notes")
            _put(f"{path}/others/{vec_id}.png", _png(8, 8, bytes(192)))
        yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})


def _image_job(spark, folder):
    """The folder of a tree of PNG files, one per embedding, with two other files for every fiftieth."""
    path = shared_path(spark, "sweep-images")
    rows = _image_rows(spark, folder)
    rows.mapInArrow(partial(_write_pngs, path), "n long").agg(F.sum("n")).collect()
    rows.where("vec_id % 50 = 0 OR vec_id % 50 = 7").mapInArrow(partial(_write_others, path), "n long").agg(F.sum("n")).collect()
    return path


def image_sweep(spark, folder):
    """From a tree of image files to accuracies, with the numbers of images and of other files."""
    sweep = images.image_sweep(spark, _image_job(spark, folder), (4, 6), counts=True)
    return sweep.select("lambda_id", F.round("accuracy", 6).alias("accuracy"), "images", "rejected")


def image_rejects(spark, folder):
    """The files of the tree that are no examples, and why."""
    return ImageTree(spark, _image_job(spark, folder), (4, 6)).rejects


QUERIES = {
    "idx_images": idx_images,
    "image_tree": image_tree,
    "csv_numbered": csv_numbered,
    "csv_plain": csv_plain,
    "log_file": log_file,
    "results_appended": results_appended,
    "sweep_recorded": sweep_recorded,
    "image_sweep": image_sweep,
    "image_rejects": image_rejects,
}

def _recorded(rows):
    """The best lambda over some rows, as the SQL of a table."""
    return f"""{weights_ctes(rows)}, {accuracy_ctes()}
        SELECT (SELECT count(*) FROM embeddings) AS n, round(lam, 9) AS lam, round(accuracy, 6) AS accuracy
        FROM acc JOIN l USING (lambda_id) ORDER BY accuracy DESC, lambda_id LIMIT 1"""


# images split by the hash of their names
IMAGE_FILE_ROWS = f"""
    SELECT 0 AS fold, CASE WHEN place <= 4 * n // 5 THEN 'train' ELSE 'validation' END AS part, name AS row_id, label,
           pos, v AS x
    FROM (SELECT p.*, replace(origin, 'images/', '') AS name FROM ({features.ORACLES["image_pixels"]}) p)
    JOIN (SELECT *, row_number() OVER (ORDER BY md5('0:' || name)) AS place, count(*) OVER () AS n
          FROM (SELECT 'class_' || label || '/' || vec_id || '.png' AS name FROM embeddings)) USING (name)"""

ORACLES = {
    "idx_images": """
        SELECT vec_id AS row_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
               CAST((CAST(floor(CAST(unnest(embedding) AS DOUBLE) * 65536) AS BIGINT) % 256 + 256) % 256 AS INTEGER) AS v
        FROM embeddings""",
    "image_tree": f"""
        SELECT CAST(regexp_extract(origin, '/([0-9]+)[.]png$', 1) AS BIGINT) AS vec_id, label, pos, v
        FROM ({features.ORACLES["image_pixels"]})""",
    "csv_numbered": """
        SELECT row_number() OVER (ORDER BY o_orderkey) AS row, o_orderkey, o_orderpriority,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
        FROM orders""",
    "csv_plain": "SELECT * FROM supplier",
    "log_file": CLEAN,
    "results_appended": """
        SELECT event_id AS n, value / 1000 AS accuracy, 0.5::DOUBLE AS lam, value AS elapsed_s FROM events""",
    "sweep_recorded": f"""
        SELECT 'whole' AS run, n, lam, accuracy FROM ({_recorded(models.SINGLE)})
        UNION ALL SELECT 'drop', n, lam, accuracy FROM ({_recorded(models.DROPPED)})""",
    "image_sweep": f"""{weights_ctes(IMAGE_FILE_ROWS)}, {accuracy_ctes()}
        SELECT lambda_id, round(accuracy, 6) AS accuracy, (SELECT count(*) FROM embeddings) AS images,
               2 * (SELECT count(*) FROM embeddings WHERE vec_id % 50 IN (0, 7)) AS rejected
        FROM acc""",
    "image_rejects": """
        SELECT 'class_0/' || vec_id || '.txt' AS name, CAST(0 AS INTEGER) AS label, 'not an image' AS reason
        FROM embeddings WHERE vec_id % 50 IN (0, 7)
        UNION ALL
        SELECT 'others/' || vec_id || '.png', NULL, 'outside a class directory'
        FROM embeddings WHERE vec_id % 50 IN (0, 7)""",
}
